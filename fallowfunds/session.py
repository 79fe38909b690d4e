"""Session settings the jobs are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# HotSpot leaves methods beyond 8000 bytes uncompiled. A stage whose single generated method would
# be larger than that is generated in small methods instead, several times as fast.
SETTINGS = {
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Keys of a lookup are compared with statistics and Bloom filters one by one up to this many.
    "spark.sql.parquet.pushdown.inFilterThreshold": "1000",
    # Ids are hex digits, which snappy leaves at their full length and zstd halves.
    "spark.sql.parquet.compression.codec": "zstd",
    # Shuffle files go when the statement that made them ends, not when the driver happens to collect its garbage:
    # a step of a long chain leaves only its table. What is read once more later is made once more.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    # A bucket is a partition of every scan, so tables built of one in buckets keep them without a shuffle.
    "spark.sql.sources.bucketing.autoBucketedScan.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A join whose smaller side has at most so much in each partition hashes that side and leaves the
    # wider one unsorted: sheet rows would spill a multiple of what they are stored in.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the settings to a session; all of them may change while it runs."""
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark

