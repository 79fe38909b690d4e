"""The attempt history, as batches and laid out by party.

``root/enrichment`` holds the batches, each a folder that a rerun of its id replaces. They stay what is
true. ``root/enrichment_by_party/<build>`` is a copy of all batches of one moment, in buckets of
``party_id``, so that grouping the history by party, or joining it with parties, moves no row of it.
``root/enrichment_by_party/published`` says which files of which batches a copy holds; a reader compares
that with the files there are now. It takes newer files from the batches, laid out alike, and leaves
out of the copy what belongs to batches replaced or removed since. So its rows are those of the
batches, whenever the last copy was made.
"""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from fallowfunds.contracts import ENRICHMENT
from fallowfunds.sources.builds import new_build

KEY = "party_id"
BUCKET_ROWS = 1_000_000  # a bucket is read by one task
FEWEST = 16  # buckets
LOG_SCHEMA = "build string, buckets int, batch string, file string"


def _missing(error: AnalysisException) -> bool:
    return "PATH_NOT_FOUND" in str(error)


def _batches(spark: SparkSession, root: str) -> DataFrame | None:
    """All batches, None if there is none. Columns that a batch lacks read as NULL."""
    try:
        return spark.read.schema(ENRICHMENT.schema).parquet(f"{root}/enrichment")
    except AnalysisException as error:
        if not _missing(error):
            raise
        return None


def _files(batches: DataFrame) -> set[tuple[str, str]]:
    """(batch folder, file name) of all batch files: the names that the session's file index holds."""
    found = [f.rsplit("/", 3)[-3:] for f in batches.inputFiles()]
    return {(f"{source}/{batch}", name) for source, batch, name in found}


def _of(spark: SparkSession, root: str, files: set[tuple[str, str]]) -> DataFrame:
    """The rows of given batch files. Names are those of URLs, paths are not."""
    path = f"{root}/enrichment"
    reader = spark.read.schema(ENRICHMENT.schema).option("basePath", path)
    return reader.parquet(*[f"{path}/{unquote(batch)}/{unquote(name)}" for batch, name in sorted(files)])


def _newest(spark: SparkSession, root: str) -> list:
    """The files the newest copy holds, one row each; none if there is no copy."""
    try:
        log = spark.read.schema(LOG_SCHEMA).parquet(f"{root}/enrichment_by_party/published")
    except AnalysisException as error:
        if not _missing(error):
            raise
        return []
    newest = log.agg(F.max("build").alias("build"))
    return log.join(F.broadcast(newest), "build").collect()


def _name(build: str) -> str:
    return f"attempts_by_party_{build.replace('-', '_')}"


def _table(spark: SparkSession, root: str, build: str, buckets: int) -> DataFrame:
    """A copy as a table of this session's catalog, which alone can tell Spark of buckets."""
    name = _name(build)
    fields = ", ".join(f"`{f.name}` {f.type.simpleString()}" for f in ENRICHMENT.fields)
    place = f"{root}/enrichment_by_party/{build}".replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({fields}, batch string) USING parquet "
        f"CLUSTERED BY ({KEY}) SORTED BY ({KEY}) INTO {buckets} BUCKETS LOCATION '{place}'"
    )
    return spark.table(name)


def compact(spark: SparkSession, root: str, bucket_rows: int = BUCKET_ROWS) -> str | None:
    """Copy all batches there are now into buckets of parties. Returns the copy's name, None if there are
    no batches. The copy counts from the moment its one log file is there; a run that dies changes nothing.

    The number of buckets grows with the rows, so that none holds many more than ``bucket_rows``; each is
    one sorted file.
    """
    batches = _batches(spark, root)
    files = _files(batches) if batches is not None else set()
    if not files:
        return None
    rows = _of(spark, root, files)
    buckets = max(FEWEST, -(-rows.count() // bucket_rows))
    build = new_build()
    folder = F.regexp_extract("_metadata.file_path", "([^/]+/[^/]+)/[^/]+$", 1)
    held = rows.select(*[F.col(f.name).cast(f.type).alias(f.name) for f in ENRICHMENT.fields], folder.alias("batch"))
    # The table exists first, so that rows are written into its buckets; inserts go by position.
    _table(spark, root, build, buckets)
    held.repartition(buckets, KEY).write.insertInto(_name(build))
    log = spark.createDataFrame([(build, buckets, *f) for f in sorted(files)], LOG_SCHEMA)
    log.coalesce(1).write.mode("append").parquet(f"{root}/enrichment_by_party/published")
    return build


def read(spark: SparkSession, root: str) -> DataFrame:
    """All attempts of all batches, in the history's columns.

    With a copy at hand the rows are spread by party already: the copy is read bucket by bucket, and only
    files that came after it are shuffled. No batch reads as empty.
    """
    batches = _batches(spark, root)
    if batches is None:
        return spark.createDataFrame([], ENRICHMENT.schema)
    copied = _newest(spark, root)
    if not copied:
        return ENRICHMENT.project(batches)
    present, held = _files(batches), {(r["batch"], r["file"]) for r in copied}
    build, buckets = copied[0]["build"], copied[0]["buckets"]
    # A batch is replaced as a whole: where a file of it has gone, its rows in the copy are old.
    gone = sorted({batch for batch, _ in held - present})
    copy = _table(spark, root, build, buckets)
    if gone:
        copy = copy.filter(~F.col("batch").isin(gone))
    later = {(batch, name) for batch, name in present if (batch, name) not in held or batch in gone}
    rows = ENRICHMENT.project(copy)
    return rows.unionByName(ENRICHMENT.project(_of(spark, root, later)).repartition(buckets, KEY)) if later else rows
