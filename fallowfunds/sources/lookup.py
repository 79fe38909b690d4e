"""Reading few rows of large tables by key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

AT_ONCE = 1000  # keys that are sent to the scan as a list


def narrowed(frame: DataFrame, column: str, wanted: DataFrame, at_once: int = AT_ONCE) -> DataFrame:
    """The rows of ``frame`` whose column is among the first column of ``wanted``.

    Keys are counted first. Few go to the scan as a list, which skips files, row groups and pages by
    their statistics and Bloom filters; no more than ``at_once`` and one come to the driver for that.
    Many are joined, which gives the same rows.
    """
    keys = wanted.select(F.col(wanted.columns[0]).alias(column)).filter(F.col(column).isNotNull()).distinct()
    few = [r[0] for r in keys.limit(at_once + 1).collect()]
    if len(few) <= at_once:
        return frame.filter(F.col(column).isin(few))
    return frame.join(keys, column, "left_semi").select(*frame.columns)
