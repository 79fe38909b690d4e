"""The training-data pipeline: from ``documents`` to files of token ids.

Each stage takes the documents its predecessor kept. All but the last return the columns of
``documents``; the last writes the token files and returns what it reads back from them.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fallowfunds.llm import (
    decontamination,
    near_dedup,
    quality,
    queries,
    source_mixing,
    token_files,
)
from fallowfunds.llm.common import quoted, small_batches, stored, table

# Neither a trained classifier nor sketches nor a tokenizer can be put in SQL; tests hold each stage
# against a brute-force version.
ORACLE_SQL = None


def _carried(docs: DataFrame, *used: str) -> DataFrame:
    """The used columns, and all others in one, under names that no operator knows."""
    others = [c for c in docs.columns if c not in used]
    row = F.struct(*[quoted(c).alias(f"c{i}") for i, c in enumerate(others)], F.lit(0).alias("end"))
    return docs.select(*used, row.alias("carried"))


def _restored(found: DataFrame, docs: DataFrame, *used: str) -> DataFrame:
    """The columns of ``docs`` again, with the caller's values whatever their names."""
    others = [c for c in docs.columns if c not in used]
    return found.select(*[c if c in used else F.col("carried")[f"c{others.index(c)}"].alias(c) for c in docs.columns])


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject."""
    small_batches(spark)
    used = ("doc_id", "text")
    judged = quality.classify(_carried(docs, *used), table(spark, sf_dir, "labels").select("doc_id", "quality"))
    return _restored(judged.filter("predicted = 1"), docs, *used)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row, of the document with the smallest id, of each group of near duplicates."""
    small_batches(spark)
    return near_dedup.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    used = ("doc_id", "text")
    found = decontamination.contamination(_carried(docs, *used), table(spark, sf_dir, "benchmark"))
    return _restored(found.filter("NOT contaminated"), docs, *used)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document once, those of small sources up to about twice."""
    used = ("doc_id", "source", "text")
    return _restored(source_mixing.mix(_carried(docs, *used)), docs, *used)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of the written files, a row for each document read."""
    small_batches(spark)
    path = queries.token_folder(spark)
    token_files.write(token_files.encode(docs, public_tokenizers.path(queries.TOKENIZER), queries.END_ID), path)
    return token_files.checksums(token_files.with_starts(token_files.read(spark, path)))


STAGES = [
    ("quality classifier", keep_quality),
    ("near-dedup", drop_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("source mixing", mix_sources),
    ("token files", write_tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's documents are stored for the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if stage is not write_tokens:
            docs = stored(docs, name.replace(" ", "-"))
    return docs
