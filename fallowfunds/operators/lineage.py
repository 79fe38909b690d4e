"""Files, captures, and how a capture went."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fallowfunds.contracts import SCHEMA_VERSION
from fallowfunds.functions.identifiers import hash_id
from fallowfunds.functions.parsing import period_from_key

# Source name, version mark of rebuilt captures, and the reasons of unreadable input.
SOURCE = "judicial_deposits"
BACKFILL = "backfill"
FILE_UNREADABLE = "file unreadable"
SHEET_UNREADABLE = "sheet unreadable"


def build_files(objects: DataFrame, uri_prefix: str = "", source: str = SOURCE) -> DataFrame:
    """One row per raw object of ``objects(key, content_hash, modified_at)``."""
    return objects.select(
        hash_id(F.col("key")).alias("file_id"),
        F.lit(source).alias("source"),
        period_from_key(F.col("key")).alias("period"),
        F.concat(F.lit(uri_prefix), F.col("key")).alias("uri"),
        "content_hash",
        F.col("modified_at").cast("timestamp_ntz").alias("detected_at"),
    )


def build_captures(
    keys: DataFrame,
    staging: DataFrame,
    rejects: DataFrame,
    executed_at: Column | dt.datetime,
    code_version: str = BACKFILL,
    schema_version: str = SCHEMA_VERSION,
) -> DataFrame:
    """One row per raw key, also for a key without rows.

    Staging knows a capture by id and rejects by key. Both are counted with map-side combine
    before they meet the list of keys, so no capture is gathered, however large.
    """
    ok = staging.groupBy("capture_id").agg(F.count(F.lit(1)).alias("rows_ok"))
    unreadable = F.startswith(F.col("reason"), F.lit(FILE_UNREADABLE)) | F.startswith(
        F.col("reason"), F.lit(SHEET_UNREADABLE)
    )
    rejected = (
        rejects.groupBy("key")
        .agg(F.count(F.lit(1)).alias("rows_rejected"), F.bool_or(unreadable).alias("unreadable"))
        .select(hash_id(F.col("key")).alias("capture_id"), "rows_rejected", "unreadable")
    )
    none = F.lit(0).cast("bigint")
    stamp = executed_at if isinstance(executed_at, Column) else F.lit(executed_at)
    return (
        keys.select(hash_id(F.col("key")).alias("capture_id"))
        .join(ok, "capture_id", "left")
        .join(rejected, "capture_id", "left")
        .withColumn("rows_ok", F.coalesce("rows_ok", none))
        .withColumn("rows_rejected", F.coalesce("rows_rejected", none))
        .select(
            "capture_id",
            F.col("capture_id").alias("file_id"),
            F.lit(code_version).alias("code_version"),
            F.lit(schema_version).alias("schema_version"),
            stamp.cast("timestamp_ntz").alias("executed_at"),
            (F.col("rows_ok") + F.col("rows_rejected")).alias("rows_read"),
            "rows_ok",
            "rows_rejected",
            F.when(F.col("unreadable"), "read_error").otherwise("ok").alias("status"),
        )
    )


def capture_status(captures: DataFrame) -> DataFrame:
    """Captures per status."""
    return (
        captures.groupBy("status").agg(F.count(F.lit(1)).alias("captures")).orderBy("status")
    )
