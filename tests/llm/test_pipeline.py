import corpus_pipeline as cp
from pyspark.sql import functions as F

from .test_near_dedup import brute as near_brute
from .test_decontamination import brute as leak_brute
from .test_token_files import want

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    names = []
    for name, stage in cp.STAGES:
        out = cp.stored(stage(spark, docs, SF), "test")
        before, after = docs.collect(), out.collect()
        texts = {r.doc_id: r.text for r in before}
        kept = [r.doc_id for r in after]
        if stage is cp.keep_quality:
            labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
            known = [i for i in texts if i in labels]
            assert sum((i in set(kept)) == (labels[i] == 1) for i in known) > 0.95 * len(known)
        elif stage is cp.drop_near_duplicates:
            groups = near_brute(list(texts.items()), 80)
            assert sorted(kept) == sorted({g for _, g in groups.values()})
        elif stage is cp.drop_contaminated:
            leaks = {i for i, *_, hit in leak_brute(list(texts.items()), items) if hit}
            assert sorted(kept) == sorted(set(texts) - leaks)
        elif stage is cp.mix_sources:
            assert set(kept) == set(texts) and max(kept.count(i) for i in texts) <= 3
        else:
            rows = [(r.doc_id, r.text) for r in before]
            found = sorted((r.start, r.doc_id, r.n_tokens, r.ids_crc32) for r in after)
            assert [(i, s, n, c) for s, i, n, c in found] == want(rows)
        if stage is not cp.write_tokens:
            assert out.columns == COLUMNS
        docs = out
        names.append(name)
    assert len(names) == 5
    assert cp.run(spark, SF).count() == docs.count()


def test_callers_columns_come_back_as_they_were(spark):
    """Names that operators use for their own results, names to be quoted, NULLs and repeated rows."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(60)
    extra = ["score", "n_words", "block", "row", "key", "carried", "__text", "__key", "__row", "a.b", "a b", "a:b"]
    docs = docs.withColumns({c: F.concat_ws("/", F.lit(c), "doc_id") for c in extra})
    docs = docs.unionByName(docs.limit(2)).unionByName(
        docs.limit(2).withColumns({"text": F.lit(None).cast("string"), "source": F.lit(None).cast("string")})
    )
    docs = cp.stored(docs, "test")
    for _, stage in cp.STAGES[:-1]:
        out = cp.stored(stage(spark, docs, SF), "test")
        assert out.columns == docs.columns
        rows = out.collect()
        assert rows
        for r in rows:
            assert [r[c] for c in extra] == [f"{c}/{r['doc_id']}" for c in extra]
    assert cp.write_tokens(spark, docs, SF).count() == 64
    none = docs.limit(0)
    for _, stage in cp.STAGES:
        assert stage(spark, none, SF).collect() == []
