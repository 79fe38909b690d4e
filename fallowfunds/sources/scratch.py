"""Intermediate tables in the folder all executors share."""

from __future__ import annotations

import hashlib
import tempfile
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import ArrayType, MapType, StructType

CHECKPOINT_DIR = "spark.checkpoint.dir"
# Narrow tables, ids for the most part, are smaller with differences from the value before than with values in full.
# Lists come out larger, so tables with them are left.
DIFFERENCES = "OPTIONS ('parquet.writer.version' 'v2')"


class NoSharedFolder(RuntimeError):
    """The cluster names no folder that all its machines share."""


def scratch_dir(spark: SparkSession) -> str:
    """The cluster's checkpoint folder. Without one only a local session gets a folder of its own."""
    configured = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getCheckpointDir()
    if not configured:
        if not spark.sparkContext.master.startswith("local["):
            raise NoSharedFolder(f"set {CHECKPOINT_DIR} to a folder all executors share")
        configured = tempfile.mkdtemp(prefix="fallowfunds-")
        spark.sparkContext.setCheckpointDir(configured)
        configured = spark.sparkContext.getCheckpointDir()
    return f"{configured.rstrip('/')}/{spark.sparkContext.applicationId}"


def written(spark: SparkSession, name: str, frame: DataFrame) -> DataFrame:
    """A frame several steps of one run read, written to a folder of this call's own."""
    path = f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


@dataclass(frozen=True)
class Buckets:
    """Rows of one key lie in one bucket, so joining or grouping by the key moves none of them."""

    keys: tuple[str, ...]
    number: int


def _place(spark: SparkSession, name: str, of: str) -> tuple[str, str]:
    digest = hashlib.sha256(of.encode()).hexdigest()[:16]
    return f"{scratch_dir(spark)}/{name}-{digest}", f"{name}_{digest}"


def _file(spark: SparkSession, path: str):
    """A path, and the file system it is in."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def dropped(spark: SparkSession, name: str, of: str) -> None:
    """Delete a table of :func:`staged` that no later step reads. Asked for again, it is written again."""
    path, table = _place(spark, name, of)
    at, files = _file(spark, path)
    files.delete(at, True)
    spark.sql(f"DROP TABLE IF EXISTS {table}")


def staged(
    spark: SparkSession, name: str, of: str, build: Callable[[], DataFrame], buckets: Buckets | None = None
) -> DataFrame:
    """A frame made of inputs that never change, written once per application and read from there.

    For inputs that may grow use :func:`written`, which never takes up an earlier run's table. Later steps then prune columns and push filters into it, and a lost executor costs a re-read
    of files rather than the whole lineage. ``of`` tells apart tables made of different inputs.

    With ``buckets`` it is a table of the application's catalog, which alone can tell Spark of buckets. Let
    ``build`` deal its rows to that many partitions by the keys, or each task writes a file a bucket.
    """
    path, table = _place(spark, name, of)
    done, files = _file(spark, f"{path}/_SUCCESS")
    if buckets:
        if not files.exists(done) or not spark.catalog.tableExists(table):
            frame = build()
            fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in frame.schema.fields)
            place = path.replace("\\", "\\\\").replace("'", "\\'")
            nested = any(isinstance(f.dataType, ArrayType | MapType | StructType) for f in frame.schema.fields)
            spark.sql(
                f"CREATE TABLE IF NOT EXISTS {table} ({fields}) USING parquet {'' if nested else DIFFERENCES} "
                f"CLUSTERED BY ({', '.join(buckets.keys)}) INTO {buckets.number} BUCKETS LOCATION '{place}'"
            )
            frame.write.insertInto(table, overwrite=True)
        return spark.table(table)
    if not files.exists(done):
        build().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
