"""Raw objects of a bucket or folder: listed and hashed by tasks.

Folders are listed level by level: a task lists some folders, what it finds is stored, and the folders
among it are the next level's rows. Nothing but the first folder's name comes from the driver. Contents
are read in blocks, so an object may be larger than memory and than a row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from functools import reduce

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fallowfunds.sources.scratch import written

BLOCK = 8 << 20  # bytes of an object in memory at once
PER_TASK = 200  # folders that a task lists, objects that it hashes

FileSystemOf = Callable[[str], tuple[fs.FileSystem, str]]


def file_system(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system and path of a URI. Pass a function of your own for other stores or keys."""
    scheme, _, rest = uri.partition(":")
    authority, _, path = rest.removeprefix("//").partition("/") if rest.startswith("//") else ("", "", rest.lstrip("/"))
    # Names are taken as they are, not as parts of a URI with escapes.
    system, base = fs.FileSystem.from_uri(f"{'s3' if scheme in ('s3a', 's3n') else scheme}://{authority}/")
    return system, f"{base.rstrip('/')}/{path}"


def qualified(spark: SparkSession, path: str) -> str:
    """The path as a full URI without a closing slash."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    system = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return system.makeQualified(hadoop).toString().rstrip("/")


def _spread(frame: DataFrame) -> DataFrame:
    return frame.repartition(-(-frame.count() // PER_TASK) or 1)


def _listed(folders: DataFrame, systems: FileSystemOf) -> DataFrame:
    """(uri, folder, millis, length) of everything in some folders, one level deep."""

    def run(batches):
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                system, path = systems(uri)
                found = system.get_file_info(fs.FileSelector(path))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([f"{uri}/{i.base_name}" for i in found], pa.string()),
                        pa.array([i.type == fs.FileType.Directory for i in found], pa.bool_()),
                        pa.array([i.mtime_ns and i.mtime_ns // 1_000_000 for i in found], pa.int64()),
                        pa.array([i.size for i in found], pa.int64()),
                    ],
                    ["uri", "folder", "millis", "length"],
                )

    return _spread(folders).mapInArrow(run, "uri string, folder boolean, millis long, length long")


def listing(spark: SparkSession, path: str, systems: FileSystemOf = file_system) -> DataFrame:
    """(uri, millis, length) of every object below a path, hidden and empty ones too."""
    folders = spark.createDataFrame([(qualified(spark, path),)], "uri string")
    levels = []
    while True:
        level = written(spark, "listing", _listed(folders, systems))
        levels.append(level.filter("NOT folder").select("uri", "millis", "length"))
        folders = level.filter("folder").select("uri")
        if folders.isEmpty():
            return reduce(DataFrame.unionByName, levels)


def _key(base: str) -> Column:
    return F.replace(F.col("uri"), F.lit(f"{base}/"), F.lit(""))


def _modified_at() -> Column:
    return F.to_utc_timestamp(F.timestamp_millis("millis"), F.current_timezone()).cast("timestamp_ntz")


def discover(spark: SparkSession, path: str, root: str | None = None, systems: FileSystemOf = file_system) -> DataFrame:
    """(key, modified_at, length) of every object under a path; folder markers are left out.

    Keys are relative to ``root`` (the bucket or folder that publications are keyed in; by default
    the path's own), so they are the keys that decoded rows carry. Only listings are read.
    """
    base = qualified(spark, path if root is None else root)
    return listing(spark, path, systems).select(_key(base).alias("key"), _modified_at().alias("modified_at"), "length")


def digest(stream, block: int = BLOCK) -> str:
    """SHA-256 of a stream, in lower-case hex, a block at a time."""
    state = hashlib.sha256()
    while data := stream.read(block):
        state.update(data)
    return state.hexdigest()


def read_objects(
    spark: SparkSession, path: str, root: str | None = None, systems: FileSystemOf = file_system, block: int = BLOCK
) -> DataFrame:
    """:func:`discover` plus ``content_hash``, in one pass over the objects, joined to nothing.

    Empty objects and those with a hidden name (``_`` or ``.``) are no publications: they are listed
    with a NULL hash, so they are seen and can be reported.
    """
    base = qualified(spark, path if root is None else root)

    def run(batches):
        for batch in batches:
            hashes = []
            for uri, length in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
                if not length or uri.rsplit("/", 1)[1][0] in "_.":
                    hashes.append(None)
                    continue
                system, name = systems(uri)
                with system.open_input_stream(name) as stream:
                    hashes.append(digest(stream, block))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(hashes, pa.string())], [*batch.schema.names, "content_hash"])

    hashed = _spread(listing(spark, path, systems)).mapInArrow(run, "uri string, millis long, length long, content_hash string")
    return hashed.select(_key(base).alias("key"), _modified_at().alias("modified_at"), "length", "content_hash")
