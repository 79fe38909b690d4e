"""Claims across publications: identity, observations, parties and persistence."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fallowfunds.functions.identifiers import (
    canonical_court_account,
    canonical_document_number,
    claim_id,
    hash_id,
)
from fallowfunds.operators.combine import one_row

# The period whose rows are case actions and not deposits, and the claim type.
EXCLUDED_PERIODS = ("2017-1",)
CLAIM_TYPE = "judicial_deposit"


def claim_rows(
    staging: DataFrame, excluded_periods: Sequence[str] = EXCLUDED_PERIODS
) -> DataFrame:
    """Staging rows that can carry a claim, with its id. Prunes period partitions.

    A stored :func:`claim_base` is taken as it is, so ids are made once for all that is built of them.
    """
    if "claim_id" in staging.columns:
        return staging
    usable = staging.filter("deposit_no IS NOT NULL")
    if excluded_periods:
        usable = usable.filter(~F.col("period").isin(*excluded_periods))
    return usable.withColumn("claim_id", claim_id(F.col("court_account"), F.col("deposit_no")))


# What claims, observations, links and persistence are made of.
BASE = (
    "claim_id", "capture_id", "sheet", "source_row", "period", "court_account", "deposit_no", "deposit_type",
    "amount_cop", "origin_date", "classification", "source_extra", "plaintiff_id", "defendant_id", "court_name",
)


def claim_base(
    staging: DataFrame, excluded_periods: Sequence[str] = EXCLUDED_PERIODS
) -> DataFrame:
    """The narrow table to store when several of the operators below follow: staging is then read, and
    every claim id worked out, a single time."""
    return claim_rows(staging, excluded_periods).select(*BASE)


def build_claims(
    staging: DataFrame, excluded_periods: Sequence[str] = EXCLUDED_PERIODS
) -> DataFrame:
    """One row per claim with the values of its newest observation.

    The rank keeps one row per claim before the shuffle as well as after it, so a claim repeated
    without end sends one row per task. Ties are broken down to the content of the row.
    """
    newest_first = Window.partitionBy("claim_id").orderBy(
        F.desc("period"),
        F.desc("source_row"),
        F.desc("capture_id"),
        F.desc("sheet"),
        F.desc("court_account"),
        F.desc("amount_cop"),
        F.desc("origin_date"),
        F.desc("deposit_type"),
        F.desc("classification"),
        F.desc("source_extra"),
    )
    newest = (
        claim_rows(staging, excluded_periods)
        .withColumn("nth", F.row_number().over(newest_first))
        .filter("nth = 1")
    )
    nothing = F.lit(None).cast("string")
    return newest.select(
        "claim_id",
        F.lit(CLAIM_TYPE).alias("type"),
        hash_id(canonical_court_account(F.col("court_account"))).alias("court_id"),
        "deposit_no",
        "deposit_type",
        "amount_cop",
        "origin_date",
        nothing.alias("case_number"),
        nothing.alias("legal_basis"),
        nothing.alias("claim_route"),
        claim_attributes(F.col("classification"), F.col("source_extra")).alias("attributes"),
    )


def claim_attributes(classification: Column, source_extra: Column) -> Column:
    """JSON text of what the contract has no column for; absent values stay as null."""
    return F.to_json(
        F.struct(classification.alias("classification"), source_extra.alias("source_extra")),
        {"ignoreNullFields": "false"},
    )


def build_observations(
    staging: DataFrame, excluded_periods: Sequence[str] = EXCLUDED_PERIODS
) -> DataFrame:
    """One row per published row of a claim; repeated publication stays repeated. No shuffle."""
    return claim_rows(staging, excluded_periods).select(
        "capture_id", "sheet", "source_row", "claim_id"
    )


def build_claim_parties(
    staging: DataFrame, excluded_periods: Sequence[str] = EXCLUDED_PERIODS
) -> DataFrame:
    """Distinct (claim, party, role). The party id is computed in place, so there is no join."""
    sides = F.array(
        F.struct(F.lit("plaintiff").alias("role"), F.col("plaintiff_id").alias("number")),
        F.struct(F.lit("defendant").alias("role"), F.col("defendant_id").alias("number")),
    )
    return (
        claim_rows(staging, excluded_periods)
        .select("claim_id", F.explode(sides).alias("side"))
        .filter("side.number IS NOT NULL")
        .select(
            "claim_id",
            hash_id(canonical_document_number(F.col("side.number"))).alias("party_id"),
            F.col("side.role").alias("procedural_role"),
        )
        .distinct()
        .withColumn("attributes", F.lit(None).cast("string"))
    )


def measure_persistence(
    staging: DataFrame, excluded_periods: Sequence[str] = EXCLUDED_PERIODS
) -> DataFrame:
    """For each two consecutive published periods, how many claims of the first recur.

    One shuffle, by claim: each claim becomes the set of its periods (a handful of values), and
    equal sets are counted together. All that follows works on those few counted sets.
    """
    histories = (
        claim_rows(staging, excluded_periods)
        .groupBy("claim_id")
        .agg(F.array_sort(F.collect_set("period")).alias("periods"))
        .groupBy("periods")
        .agg(F.count(F.lit(1)).alias("claims"))
    )
    counted = histories.select(
        F.explode("periods").alias("period"), "periods", "claims"
    )
    # One row per published period; the ordering below therefore handles a few dozen rows.
    published = counted.groupBy("period").agg(F.sum("claims").alias("count"))
    in_order = Window.orderBy("period")
    steps = published.select(
        F.lag("period").over(in_order).alias("prev_period"),
        "period",
        F.lag("count").over(in_order).alias("prev_count"),
        "count",
    ).filter("prev_period IS NOT NULL")
    overlaps = (
        counted.join(steps.select("prev_period", "period"), "period")
        .filter(F.array_contains("periods", F.col("prev_period")))
        .groupBy("period")
        .agg(F.sum("claims").alias("overlap"))
    )
    return (
        steps.join(overlaps, "period", "left")
        .withColumn("overlap", F.coalesce("overlap", F.lit(0).cast("bigint")))
        .select(
            "prev_period",
            "period",
            "prev_count",
            "count",
            "overlap",
            F.when(
                F.col("prev_count") > 0,
                F.round(F.col("overlap") / F.col("prev_count") * 100, 2),
            ).alias("overlap_pct"),
        )
    )


def lifecycle_summary(
    claims: DataFrame, observations: DataFrame, claim_parties: DataFrame
) -> DataFrame:
    """One row: table sizes and observations per claim."""
    sizes = one_row(
        claims.agg(F.count(F.lit(1)).alias("claims")),
        observations.agg(F.count(F.lit(1)).alias("observations")),
        claim_parties.agg(F.count(F.lit(1)).alias("claim_party_links")),
    )
    per_claim = F.when(F.col("claims") > 0, F.col("observations") / F.col("claims"))
    return sizes.withColumn(
        "avg_observations", F.round(F.coalesce(per_claim, F.lit(0.0)), 2)
    )


def key_collisions(
    staging: DataFrame, excluded_periods: Sequence[str] = EXCLUDED_PERIODS
) -> DataFrame:
    """Per period: claim keys published more than once, and those whose rows differ in content.

    Content is compared through two independent 64-bit digests of it. Their minimum and maximum
    tell "all equal" from "not all equal", so no group is ever gathered.
    """
    content = (
        "deposit_type", "amount_cop", "origin_date", "classification", "source_extra",
        "plaintiff_id", "defendant_id", "court_name",
    )
    # A NULL does not change xxhash64's running value, so flags for it are hashed too.
    values = [F.col(c) for c in content] + [F.col(c).isNull() for c in content]
    rows = claim_rows(staging, excluded_periods).select(
        "period",
        "claim_id",
        F.xxhash64(*values).alias("a"),
        F.xxhash64(F.lit(1), *values).alias("b"),
    )
    keys = rows.groupBy("period", "claim_id").agg(
        F.count(F.lit(1)).alias("n"),
        ((F.min("a") != F.max("a")) | (F.min("b") != F.max("b"))).alias("differs"),
    )
    return keys.groupBy("period").agg(
        F.count_if(F.col("n") > 1).alias("repeated_keys"),
        F.sum(F.when(F.col("n") > 1, F.col("n")).otherwise(0)).alias("repeated_rows"),
        F.count_if((F.col("n") > 1) & F.col("differs")).alias("differing_keys"),
    )
