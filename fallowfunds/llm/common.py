"""Reading, storing and text helpers shared by the operators."""

from __future__ import annotations

import ctypes
import string
import uuid
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fallowfunds.sources.scratch import scratch_dir

# Fixed values of the query contracts: white space, and the share of rows no label is learned from.
SPACES = " \t\n\x0b\f\r"
HELD_OUT_OF, HELD_OUT = 4, 2


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def small_batches(spark: SparkSession) -> SparkSession:
    """Rows go to Python in batches of whole texts; this many keep a worker in tens of megabytes."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    return spark


def stored(frame: DataFrame, name: str) -> DataFrame:
    """The frame written to the shared folder and read back: later steps do not recompute it.

    Every call writes a folder of its own, so nothing of an earlier run is taken up.
    """
    spark = frame.sparkSession
    path = f"{scratch_dir(spark)}/llm/{name}-{uuid.uuid4().hex}"
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def released(run: Callable) -> Callable:
    """A task's function that gives freed memory back to the system when it ends. Python workers stay
    for later tasks, and several of them in an executor would each keep the size of their largest moment."""

    def task(batches):
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only some C libraries have it
            if trim is not None:
                trim(0)

    return task


def whole(text: str | Column) -> Column:
    """The text, empty where it is NULL."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, everything else as it is."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def held_out(doc_id: str | Column = "doc_id") -> Column:
    """True for rows whose labels are for testing only."""
    key = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    rest = F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % HELD_OUT_OF
    return rest == HELD_OUT


def quoted(name: str) -> Column:
    """The column of just this name, whatever characters it holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def packed(docs: DataFrame, **own: Column) -> DataFrame:
    """An operator's ``own`` columns, and all of the caller's as one, ``row``: their names cannot meet."""
    fields = [quoted(c).alias(f"c{i}") for i, c in enumerate(docs.columns)]
    return docs.select(F.struct(*fields, F.lit(0).alias("end")).alias("row"), *[c.alias(n) for n, c in own.items()])


def field(docs: DataFrame, name: str) -> Column:
    """A column of ``docs`` in its packed form."""
    return F.col("row")[f"c{[c.lower() for c in docs.columns].index(name.lower())}"]


def unpacked(docs: DataFrame, *new: str) -> list[Column]:
    """The columns of ``docs`` from its packed form, except those whose names an operator's results take."""
    taken = {n.lower() for n in new}
    return [F.col("row")[f"c{i}"].alias(c) for i, c in enumerate(docs.columns) if c.lower() not in taken]


def passed(frame: DataFrame, *new: str) -> list[Column]:
    """The columns of a frame except those whose names an operator's own results take."""
    return [quoted(c) for c in frame.columns if c.lower() not in {n.lower() for n in new}]
