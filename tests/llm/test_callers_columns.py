"""Every operator that passes the caller's columns through: names that clash or need quoting, odd rows, empty tables."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from fallowfunds.llm import (
    bpe,
    decontamination,
    fingerprints,
    line_dedup,
    near_dedup,
    quality,
    repeat_dedup,
    source_mixing,
    token_files,
    toxicity,
)

SF = "/root/testdata/sf0.001"
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
EXTRA = ["a b", "a.b", "a:b", "a`b", "__text", "__key", "__row", "__source", "row", "key", "at", "text2", "c0", "toxic", "good"]
RESULTS = {
    "near": ["n_shingles", "component_id", "kept"],
    "toxic": ["held_out", "score", "predicted", "n_words", "best", "found"],
    "quality": ["held_out", "score", "predicted", "n_passages", "attention"],
    "leaks": ["n_words", "n_hit", "items", "n_items", "contaminated"],
    "prints": ["fingerprint"],
    "lines": ["kept_text", "n_lines", "n_dropped"],
    "mixed": ["epoch", "n_tokens", "weight", "block", "order_key"],
    "repeats": ["kept", "n_bytes", "n_removed", "n_spans"],
    "ids": ["ids"],
}


def run(spark, name, docs):
    table = lambda t: spark.read.parquet(f"{SF}/{t}.parquet")
    return {
        "near": lambda: near_dedup.near_duplicates(docs),
        "toxic": lambda: toxicity.classify(docs, table("labels")),
        "quality": lambda: quality.classify(docs, table("labels")),
        "leaks": lambda: decontamination.contamination(docs, table("benchmark")),
        "prints": lambda: fingerprints.fingerprint(docs),
        "lines": lambda: line_dedup.drop_shared_lines(docs),
        "mixed": lambda: source_mixing.mix(docs),
        "repeats": lambda: repeat_dedup.remove_repeats(docs),
        "ids": lambda: bpe.encode(docs, TOKENIZER),
    }[name]()


@pytest.fixture(scope="module")
def rows(spark, tmp_path_factory):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(120)
    none = docs.limit(2).withColumns({c: F.lit(None).cast(t) for c, t in docs.dtypes})
    docs = docs.unionByName(docs.limit(3)).unionByName(none).withColumn("n_chars", F.lit(7))
    path = str(tmp_path_factory.mktemp("rows") / "docs")
    docs.write.parquet(path)
    return spark.read.parquet(path)


@pytest.mark.parametrize("name", RESULTS)
def test_other_columns_change_nothing_and_come_back(spark, rows, name):
    plain = run(spark, name, rows)
    new = RESULTS[name]
    wide = rows.withColumns(
        {c: F.concat_ws("/", F.lit(c), "doc_id") for c in EXTRA} | {c: F.lit("mine") for c in new}
    )
    found = run(spark, name, wide)
    assert len(set(found.columns)) == len(found.columns)
    assert set(found.columns) == set(plain.columns) | set(EXTRA)
    got = found.collect()
    for r in got:
        assert [r[c] for c in EXTRA] == ["/".join([c, str(r["doc_id"])]) if r["doc_id"] is not None else c for c in EXTRA]
    columns = plain.columns
    digest = lambda frame_rows: sorted(str([round(r[c], 5) if isinstance(r[c], float) else str(r[c])[:80] for c in columns if c not in ("attention", "found")]) for r in frame_rows)
    assert digest(got) == digest(plain.collect())
    assert run(spark, name, wide.limit(0)).collect() == []


def test_token_files_read_two_columns(spark, rows):
    wide = rows.withColumns({c: F.lit(1) for c in [*EXTRA, "shard", "ids", "n_tokens", "local_start"]})
    a, b = (token_files.encode(d, TOKENIZER, 2).drop("shard", "local_start").collect() for d in (rows, wide))
    assert sorted(map(str, a)) == sorted(map(str, b))


@pytest.mark.parametrize("name,module", [("lines", line_dedup), ("mixed", source_mixing)])
def test_tables_too_large_to_send_are_joined(spark, rows, monkeypatch, name, module):
    sent = sorted(map(str, run(spark, name, rows).collect()))
    monkeypatch.setattr(module, "SENT", -1)
    assert sorted(map(str, run(spark, name, rows).collect())) == sent
