"""Connected components of links between numbers, as shrinking joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fallowfunds.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """(id, comp): every number in ``links`` (a, b) with the least it is connected to.

    Each step gives every number the least label among its own and its neighbours', then the label
    of that label, so paths halve. Steps are stored; only counts come to the driver.
    """
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    both = stored(both, "links")
    labels = stored(both.groupBy(F.col("a").alias("id")).agg(F.least(F.col("a"), F.min("b")).alias("comp")), "labels")
    while True:
        seen = both.join(labels.select(F.col("id").alias("b"), "comp"), "b").groupBy("a").agg(F.min("comp").alias("near"))
        better = labels.join(seen, labels["id"] == seen["a"]).select(
            "id", F.least("comp", "near").alias("comp"), F.col("comp").alias("old")
        )
        roots = labels.select(F.col("id").alias("comp"), F.col("comp").alias("root"))
        step = stored(
            better.join(roots, "comp", "left").select(
                "id", F.least("comp", F.coalesce("root", "comp")).alias("comp"), "old"
            ),
            "labels",
        )
        if step.filter(F.col("comp") < F.col("old")).isEmpty():
            return step.select("id", "comp")
        labels = step.select("id", "comp")
