import datetime as dt
import hashlib
import io
import json
import time
from pathlib import Path

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from checks import driver_tables, queries
from fallowfunds import contracts as c
from fallowfunds.mappings import pinned_mapping
from fallowfunds.operators import enrichment, identity, lifecycle, normalize, search, sheets
from fallowfunds.plans import jobs
from fallowfunds.session import tune
from fallowfunds.sources import builds, history, lookup, objects, reading, writing

LATER = dt.datetime(2999, 1, 1)


def judged(spark, *rows):
    """Accepted rows of (capture, deposit number)."""
    made = spark.createDataFrame([(f"raw/2024-1/{k}", n) for k, n in rows], "key string, deposit_no string")
    fields = {"period": F.lit("2024-1"), "sheet": F.lit("S"), "source_row": F.lit(0).cast("bigint"),
              "capture_id": F.regexp_extract("key", "[^/]+$", 0), "deposit_no": F.col("deposit_no")}
    return made.select(
        "key", *[fields.get(f.name, F.lit(None)).cast(f.type).alias(f.name) for f in c.STAGING.fields],
        F.lit(None).cast("string").alias("reason"), F.lit(None).cast("string").alias("raw_row"), F.lit(True).alias("accepted"),
    )


def seen(spark, root, at=None):
    return sorted((r["capture_id"], r["deposit_no"]) for r in reading.read_staging(spark, root, at).collect())


def put(spark, root, *rows, present=()):
    build = builds.write(judged(spark, *rows), root)
    named = spark.createDataFrame([(p, "2024-1") for p in present], "capture_id string, period string")
    builds.publish(spark, root, build, named)
    return build


def test_nothing_is_seen_before_it_is_published(spark, tmp_path):
    root = str(tmp_path)
    with pytest.raises(builds.NothingPublished):
        reading.read_staging(spark, root)
    build = builds.write(judged(spark, ("a", "1")), root)
    with pytest.raises(builds.NothingPublished):
        reading.read_staging(spark, root)
    builds.publish(spark, root, build)
    assert seen(spark, root) == [("a", "1")]


def test_a_job_that_dies_half_way_leaves_the_old_rows(spark, tmp_path):
    root = str(tmp_path)
    put(spark, root, ("a", "1"), ("b", "2"))
    broken = judged(spark, ("a", "7"), ("b", "8")).withColumn(
        "deposit_no", F.when(F.col("capture_id") == "b", F.raise_error(F.lit("lost"))).otherwise(F.col("deposit_no"))
    )
    with pytest.raises(Exception, match="lost"):
        builds.write(broken, root)
    assert seen(spark, root) == [("a", "1"), ("b", "2")]


def test_a_commit_that_fails_leaves_the_old_rows(spark, tmp_path, monkeypatch):
    """All rows are written, then the run dies while it appends to the log."""
    root = str(tmp_path)
    put(spark, root, ("a", "1"))
    build = builds.write(judged(spark, ("a", "2"), ("b", "3")), root)
    failing = F.when(F.lit(True), F.raise_error(F.lit("died"))).cast("timestamp")
    with monkeypatch.context() as patch:
        patch.setattr(F, "current_timestamp", lambda: failing)
        with pytest.raises(Exception, match="died"):
            builds.publish(spark, root, build)
    assert seen(spark, root) == [("a", "1")]
    builds.publish(spark, root, build)
    assert seen(spark, root) == [("a", "2"), ("b", "3")]


def test_captures_are_replaced_as_a_whole_and_siblings_stay(spark, tmp_path):
    root = str(tmp_path)
    put(spark, root, ("a", "1"), ("a", "2"), ("b", "3"), ("c", "4"))
    put(spark, root, ("a", "5"), present=("a", "c"))
    assert seen(spark, root) == [("a", "5"), ("b", "3")]
    put(spark, root, ("c", "6"), ("b", "7"))
    assert seen(spark, root) == [("a", "5"), ("b", "7"), ("c", "6")]
    at = builds.version(spark, root)
    assert len(at.builds) == 2 and not at.mixed  # the first build is not even listed
    assert seen(spark, root, builds.version(spark, root, 2)) == [("a", "5"), ("b", "3")]
    assert seen(spark, root, builds.version(spark, root, 1)) == [("a", "1"), ("a", "2"), ("b", "3"), ("c", "4")]


def test_a_reader_keeps_its_version(spark, tmp_path):
    root = str(tmp_path)
    put(spark, root, ("a", "1"), ("b", "2"))
    old = reading.read_staging(spark, root)
    put(spark, root, ("a", "9"))
    assert sorted(r["deposit_no"] for r in old.collect()) == ["1", "2"]
    assert seen(spark, root) == [("a", "9"), ("b", "2")]


def test_runs_that_publish_at_once_lose_nothing(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    put(spark, root, ("a", "1"), ("b", "1"), ("c", "1"))
    one, two = builds.write(judged(spark, ("a", "2"), ("c", "2")), root), builds.write(judged(spark, ("b", "3"), ("c", "3")), root)
    log = builds._log(spark, root)
    with monkeypatch.context() as patch:
        patch.setattr(builds, "_log", lambda *_: log)  # both have seen the same last number
        builds.publish(spark, root, one)
        builds.publish(spark, root, two)
    rows = dict(seen(spark, root))
    assert (rows["a"], rows["b"], len(rows)) == ("2", "3", 3) and rows["c"] in "23"


def test_folders_are_pruned(spark, tmp_path):
    root = str(tmp_path)
    put(spark, root, ("a", "1"), ("b", "2"))
    put(spark, root, ("b", "3"))
    plan = reading.read_staging(spark, root).filter("capture_id = 'a'")
    assert [r["deposit_no"] for r in plan.collect()] == ["1"]
    shown = plan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in shown and "(capture_id" in shown.split("PartitionFilters")[1][:200]


def test_captures_get_no_folders_of_their_own(spark, tmp_path):
    root = str(tmp_path)
    rows = [(f"c{i}", str(i)) for i in range(60)]
    build = put(spark, root, *rows)
    files = list(tmp_path.glob(f"normalized/rows/build={build}/**/*.parquet"))
    assert 1 <= len(files) <= int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert seen(spark, root) == sorted(rows)


def test_builds_with_a_folder_for_each_capture_are_still_read(spark, tmp_path):
    root = str(tmp_path)
    former = builds.new_build()
    judged(spark, ("a", "1"), ("b", "1")).write.partitionBy("period", "capture_id").parquet(
        f"{root}/normalized/rows/build={former}"
    )
    builds.publish(spark, root, former)
    assert seen(spark, root) == [("a", "1"), ("b", "1")]
    put(spark, root, ("b", "2"), ("c", "2"))
    assert seen(spark, root) == [("a", "1"), ("b", "2"), ("c", "2")]


def test_rows_are_dealt_unsorted(spark):
    rows = spark.range(200).selectExpr("id AS o", "id % 3 AS n", "cast(NULL AS string) AS flag")
    out = driver_tables.dealt(rows)
    shown = out._jdf.queryExecution().executedPlan().toString()
    # Dealing in turns sorts rows by their bytes first, and how it deals depends on their order.
    assert "RoundRobin" not in shown and "hashpartitioning(o" in shown
    assert sorted(r["o"] for r in out.collect()) == list(range(200))


def test_wide_rows_are_not_sorted_to_meet_their_sheets(spark):
    tune(spark)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # sheets too many to send to all
    try:
        cell = "array(struct('text' AS kind, concat('v', id) AS text))"
        rows = spark.range(100).selectExpr("'k' AS key", "concat('s', id % 20) AS sheet", "id AS row_idx", f"{cell} AS cells")
        columns = spark.range(20).selectExpr(
            "'k' AS key", "concat('s', id) AS sheet", "0 AS header_row", "array('a') AS names", "array('text') AS kinds"
        )
        out = sheets.data_rows(rows, columns)
        assert out.count() == 99
        out.collect()
        shown = out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        assert "ShuffledHashJoin" in shown and "SortMergeJoin" not in shown
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_dead_builds_are_removed(spark, tmp_path):
    root = str(tmp_path)
    first = put(spark, root, ("a", "1"))
    orphan = builds.write(judged(spark, ("a", "0")), root)
    put(spark, root, ("a", "2"))
    assert builds.remove_dead(spark, root, dt.datetime(2000, 1, 1)) == []
    assert builds.remove_dead(spark, root, LATER, keep=2) == [orphan]
    assert seen(spark, root, builds.version(spark, root, 1)) == [("a", "1")]
    assert builds.remove_dead(spark, root, LATER) == [first]
    assert seen(spark, root) == [("a", "2")]


def test_a_run_without_rows(spark, tmp_path):
    root = str(tmp_path)
    put(spark, root, ("a", "1"))
    put(spark, root, present=("a",))
    assert seen(spark, root) == []
    assert reading.read_rejects(spark, root).count() == 0


def test_rules_are_counted_by_the_write(spark, tmp_path):
    good = spark.createDataFrame([("a", "1", None, None, None)], c.PARTY.schema)
    bad = spark.createDataFrame([("b", "2", "alien", 7.0, "r"), (None, "2", "alien", 1.0, "r")], c.PARTY.schema)
    reads = []
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(type(spark), "read", property(lambda s: reads.append(1)))
        writing.write_core(good, c.PARTY, str(tmp_path))
        with pytest.raises(c.ContractViolation) as problem:
            writing.write_core(bad, c.PARTY, str(tmp_path))
    assert str(problem.value) == (
        "party: document_type:one_of: 2 row(s); document_type_confidence:at_most: 1 row(s); party_id:not_null: 1 row(s)"
    )
    assert not reads
    assert reading.read_core(spark, str(tmp_path), c.PARTY).count() == 1
    writing.write_core(good.filter("false"), c.PARTY, str(tmp_path))


def tree(tmp_path, n):
    want = {}
    for i in range(n):
        name = f"raw/{2000 + i % 7}-1/{'deep/er/' * (i % 3)}list {i}%20é.xlsx"
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        data = bytes([i % 251]) * (i * 37)
        (tmp_path / name).write_bytes(data)
        want[name] = (len(data), hashlib.sha256(data).hexdigest() if data else None)
    return want


def test_objects_of_many_folders(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(objects, "PER_TASK", 3)
    want = tree(tmp_path, 40)
    (tmp_path / "raw/empty folder").mkdir()
    found = reading.read_objects(spark, str(tmp_path), block=100)
    rows = {r["key"]: (r["length"], r["content_hash"]) for r in found.collect()}
    assert rows == want
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan
    below = reading.discover(spark, str(tmp_path / "raw" / "2003-1"), str(tmp_path))
    assert {r["key"] for r in below.collect()} == {k for k in want if k.startswith("raw/2003-1/")}
    at = {r["key"]: r["modified_at"] for r in below.collect()}
    for key, when in at.items():
        real = dt.datetime.fromtimestamp((tmp_path / key).stat().st_mtime, dt.UTC).replace(tzinfo=None)
        assert abs((real - when).total_seconds()) < 0.01


def test_objects_of_an_empty_folder(spark, tmp_path):
    assert reading.read_objects(spark, str(tmp_path)).collect() == []


def test_a_digest_holds_one_block(spark):
    """An object of any size: no more than a block is asked for at once."""

    class Long(io.RawIOBase):
        left, asked = 3 << 30, 0

        def read(self, size=-1):
            assert 0 < size <= 1 << 24
            self.asked = max(self.asked, size)
            n = min(size, self.left)
            self.left -= n
            return bytes(n)

    stream = Long()
    assert len(objects.digest(stream, 1 << 24)) == 64
    assert stream.left == 0 and stream.asked == 1 << 24


def rows_read(frame):
    """Rows that the scan of a frame's plan gave on, after skipping."""
    execution = frame._jdf.queryExecution()
    execution.toRdd().count()
    leaves = execution.executedPlan().collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


def test_lookups_skip_what_cannot_hold_their_keys(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(writing, "ROW_GROUP", 1 << 16)
    tune(spark)
    n = 200_000
    parties = spark.range(n).select(
        F.sha2(F.col("id").cast("string"), 256).alias("party_id"), (F.col("id") + 900_000_000).cast("string").alias("document_number"),
        *[F.lit(None).cast(f.type).alias(f.name) for f in c.PARTY.fields[2:]],
    )
    root = str(tmp_path)
    writing.write_core(parties, c.PARTY, root)
    stored = reading.read_core(spark, root, c.PARTY)
    asked = spark.createDataFrame([(str(900_000_000 + i * 19_999),) for i in range(10)] + [("1",), (None,)], "n string")
    found = lookup.narrowed(stored, "document_number", asked)
    assert found.count() == 10
    assert rows_read(lookup.narrowed(stored, "document_number", asked)) < n / 4
    # Ids are in no order in the files, so only Bloom filters can tell.
    ids = parties.join(asked.withColumnRenamed("n", "document_number"), "document_number").select("party_id")
    assert rows_read(lookup.narrowed(stored, "party_id", ids.limit(1))) < n / 4
    joined = lookup.narrowed(stored, "document_number", asked, at_once=3)
    assert sorted(r["party_id"] for r in joined.collect()) == sorted(r["party_id"] for r in found.collect())
    assert joined.columns == stored.columns


def test_registry_numbers_of_any_length(spark, tmp_path):
    long = "12345678901234567890123"
    for name, rows, kind in (("text", [(long, None, None, None)], "string"), ("old", [(7, None, None, None)], "bigint")):
        spark.createDataFrame(rows, f"nit {kind}, response string, detail string, error string").write.parquet(str(tmp_path / name))
    assert reading.read_registry(spark, str(tmp_path / "text")).first()["nit"] == long
    assert reading.read_registry(spark, str(tmp_path / "old")).first()["nit"] == "7"


def test_claims_are_built_of_one_stored_table(spark, tmp_path):
    root = str(tmp_path)
    put(spark, root, ("a", "1"), ("b", "2"), ("c", "2"))
    staging = reading.read_staging(spark, root)
    base = lifecycle.claim_base(staging)
    for build in (lifecycle.build_claims, lifecycle.build_observations, lifecycle.build_claim_parties, lifecycle.measure_persistence):
        assert sorted(build(base).collect()) == sorted(build(staging).collect())
    reads = []
    real = reading.read_staging
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(reading, "read_staging", lambda *a: reads.append(1) or real(*a))
        jobs.build_lifecycle(spark, root)
    plan = reading.read_core(spark, root, c.CLAIM).count(), len(reads)
    assert plan == (2, 1)


def test_rejects_keep_numbers_as_numbers(spark):
    names = spark.createDataFrame(
        [(["a \"q\"", "n", "m", "x", "e", "t"], ["text", "number", "number", "text", "number", "number"],
          [("text", "é\n"), ("number", "12.0"), ("number", "-1.25"), None, ("number", "5.8092044001E10"), ("number", "n/a")])],
        "names array<string>, kinds array<string>, cells array<struct<kind:string,text:string>>",
    )
    json = names.select(normalize.row_json(F.col("names"), F.col("kinds"), F.col("cells"))).first()[0]
    assert json == '{"a \\"q\\"":"é\\n","n":12.0,"m":-1.25,"x":null,"e":58092044001.0,"t":"n/a"}'


def test_written_rows_are_counted_apart(spark, tmp_path, monkeypatch):
    """Files that lose rows between writing and reading fail the run, though both sides agree on keys."""
    counts = Observation()
    builds.write(judged(spark, ("a", "1"), ("b", "2")).withColumn("accepted", F.col("capture_id") == "a"), str(tmp_path), counts)
    assert counts.get == {"rows_ok": 1, "rows_rejected": 1}


def attempts(spark, *rows):
    """Found attempts of (party, day of January, name)."""
    made = spark.createDataFrame(rows, "party_id string, day int, name string")
    known = {"party_id": F.col("party_id"), "name": F.col("name"), "source": F.lit("RUES"), "status": F.lit("found"),
             "result": F.lit("{}"), "document_type": F.lit("legal_entity"),
             "queried_at": F.make_timestamp_ntz(F.lit(2026), F.lit(1), F.col("day"), F.lit(0), F.lit(0), F.lit(0))}
    return made.select(*[known.get(f.name, F.lit(None)).cast(f.type).alias(f.name) for f in c.ENRICHMENT.fields])


def names(spark, root):
    return sorted((r["party_id"], r["name"]) for r in reading.read_enrichment(spark, root).collect())


def test_a_compacted_history_has_the_rows_of_its_batches(spark, tmp_path):
    root = str(tmp_path / "a folder")
    assert history.compact(spark, root) is None and names(spark, root) == []
    writing.append_enrichment(attempts(spark, ("p", 1, "old"), ("q", 1, "q1"), (None, 1, "nobody")), root, "b 1")
    writing.append_enrichment(attempts(spark, ("p", 2, "mid")), root, "b2")
    before = [("p", "mid"), ("p", "old"), ("q", "q1")]
    first = history.compact(spark, root)
    held = reading.read_enrichment(spark, root)
    assert sorted((r["party_id"] or "", r["name"]) for r in held.collect()) == [("", "nobody"), *before]
    assert held.columns == list(c.ENRICHMENT.columns)
    # A batch after the copy, and one replaced since.
    writing.append_enrichment(attempts(spark, ("p", 3, "new")), root, "b3")
    writing.append_enrichment(attempts(spark, ("p", 1, "again")), root, "b 1")
    assert names(spark, root) == [("p", "again"), ("p", "mid"), ("p", "new")]
    # A session that did not make the copy finds it by its log.
    spark.sql(f"DROP TABLE attempts_by_party_{first.replace('-', '_')}")
    assert names(spark, root) == [("p", "again"), ("p", "mid"), ("p", "new")]
    assert history.compact(spark, root) != first
    assert names(spark, root) == [("p", "again"), ("p", "mid"), ("p", "new")]


def test_a_copy_that_dies_half_way_is_not_read(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    writing.append_enrichment(attempts(spark, ("p", 1, "kept")), root, "b1")
    monkeypatch.setattr(history, "LOG_SCHEMA", "no such type")
    with pytest.raises(Exception):
        history.compact(spark, root)
    monkeypatch.undo()
    assert names(spark, root) == [("p", "kept")]


def test_the_history_is_not_moved_once_it_is_compacted(spark, tmp_path):
    root = str(tmp_path)
    batch = spark.range(3000).select(F.col("id").cast("string").alias("p"), F.lit(1).alias("day"), F.lit("n").alias("name"))
    rows = [(str(i), 1, f"n{i}") for i in range(300)]
    writing.append_enrichment(attempts(spark, *rows), root, "b1")
    history.compact(spark, root, bucket_rows=10)  # 30 buckets
    parties = batch.select(F.col("p").alias("party_id"), F.col("p").alias("document_number"))
    few = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for later in (False, True):
            if later:
                writing.append_enrichment(attempts(spark, ("5", 2, "later")), root, "b2")
            held = reading.read_enrichment(spark, root)
            for found in (
                identity.latest_classification(held), search.latest_enrichment(held),
                enrichment.parties_to_enrich(parties, held, None),
                identity.apply_classification(
                    parties.withColumns({n: F.lit(None).cast(t) for n, t in (("document_type", "string"), ("document_type_confidence", "double"), ("document_type_rule_id", "string"))}),
                    identity.latest_classification(held),
                ),
            ):
                plan = found._jdf.queryExecution().executedPlan().toString()
                assert "Bucketed: true" in plan and above(plan, "Bucketed: true", "Exchange") == 0
            assert identity.latest_classification(held).count() == 300
            assert enrichment.parties_to_enrich(parties, held, None).count() == 2700
            newest = {r["party_id"]: r["party_name"] for r in search.latest_enrichment(held).collect()}
            assert newest["5"] == ("later" if later else "n5")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", few)


def above(plan, leaf, node):
    """How many ``node`` lie between the plan's ``leaf`` and its root."""
    lines = plan.splitlines()
    at = next(i for i, line in enumerate(lines) if leaf in line)
    deep = lambda line: len(line) - len(line.lstrip(" :+-*"))
    found, depth = 0, deep(lines[at])
    for line in reversed(lines[:at]):
        if deep(line) < depth:
            depth = deep(line)
            found += line.lstrip(" :+-*").startswith(node)
    return found


def test_profiles_come_back_as_they_were(spark, tmp_path):
    rows = [("f", "S", ' a "b"\n, ', 0, "object", 0.25, 3), ("f", "S", "", 1, "int64", 0.0, 0), ("g\\", "T", "ñ", 2, "x", 1 / 3, 1)]
    made = spark.createDataFrame(rows, c.PROFILE.schema)
    writing.write_profile(made, str(tmp_path / "p"))
    assert sorted(map(tuple, reading.read_profile(spark, str(tmp_path / "p")).collect())) == sorted(rows)


def test_rows_meet_their_sheets_unmoved(spark, tmp_path):
    """Rows and columns of sheets lie in the same buckets: neither is shuffled or sorted to judge or profile a row."""
    tune(spark)
    spark.range(3000).selectExpr(
        "id * 7 AS l_orderkey", "id % 90 AS l_partkey", "id % 40 AS l_suppkey", "cast(id % 7 AS int) AS l_linenumber",
        "id * 1.25D AS l_extendedprice", "'R' AS l_returnflag", "'O' AS l_linestatus",
        "cast(timestamp'1995-01-03' + make_interval(0, cast(id % 80 AS int)) AS timestamp_ntz) AS l_shipdate",
    ).write.parquet(f"{tmp_path}/lineitem.parquet")
    sf = str(tmp_path)
    rows, columns = driver_tables.raw_rows(spark, sf), driver_tables.sheet_columns(spark, sf)
    plain = driver_tables.print_sheets(spark, sf)
    assert rows.exceptAll(plain).isEmpty() and plain.exceptAll(rows).isEmpty()
    assert columns.exceptAll(sheets.sheet_columns(plain)).isEmpty() and columns.count() == plain.select("key", "sheet").distinct().count()
    parsed = normalize.normalize(rows, pinned_mapping(spark), columns)
    hashed = columns.hint("shuffle_hash")
    for out in (parsed, sheets.assemble_rows(rows, hashed), sheets.profile_columns(rows, hashed)):
        shown = out._jdf.queryExecution().executedPlan().toString()
        assert "Bucketed: true" in shown and "ShuffledHashJoin" in shown
        assert "hashpartitioning" not in shown and "SortMergeJoin" not in shown
    # A second call takes up the stored table.
    again = driver_tables.raw_rows(spark, sf)
    assert sorted(again.inputFiles()) == sorted(rows.inputFiles())


def test_tables_are_stored_in_zstd(spark, tmp_path):
    tune(spark)
    spark.range(10).selectExpr("sha2(cast(id AS string), 256) AS id").write.parquet(f"{tmp_path}/ids")
    (part,) = list((tmp_path / "ids").glob("*.parquet"))[:1]
    assert ".zstd." in part.name


def test_sheets_are_printed_from_two_scans(spark, tmp_path):
    """Lines are read for their cells, and once more for titles and headers together."""
    tune(spark)
    spark.range(40).selectExpr(
        "id * 100 AS l_orderkey", "id AS l_partkey", "id AS l_suppkey", "1 AS l_linenumber", "1.5D AS l_extendedprice",
        "'R' AS l_returnflag", "'O' AS l_linestatus", "timestamp_ntz'1995-01-03' AS l_shipdate",
    ).write.parquet(f"{tmp_path}/lineitem.parquet")
    sf = str(tmp_path)
    plain = driver_tables.print_sheets(spark, sf)
    assert plain._jdf.queryExecution().optimizedPlan().toString().count("] parquet") == 2
    sheets_of = {(r["key"], r["sheet"]) for r in plain.collect()}
    # Lists 0 to 3 have as many titles above the header.
    top = {(r["key"], r["sheet"], r["row_idx"]): r["cells"] for r in plain.collect() if r["row_idx"] <= int(r["key"][-6])}
    assert len(sheets_of) == 8 and set(top) == {(k, s, i) for k, s in sheets_of for i in range(int(k[-6]) + 1)}
    for (key, _, i), cells in top.items():
        assert {x["kind"] for x in cells} == {"text"}
        assert ([x["text"] for x in cells] == [f"Publicación {i}"]) == (i < int(key[-6]))


def test_names_are_made_json_once_per_sheet(spark):
    names = ["a", 'q"', "b\\", "ñ", "t\t", "", "l\n", "\x7f", "x y", "</a>"]
    columns = spark.createDataFrame(
        [("raw/deposits/2023-2/list-1.xlsx", "S", 0, names, ["text"] * len(names))],
        "key string, sheet string, header_row int, names array<string>, kinds array<string>",
    )
    by_spark = [
        F.expr(f"substring(to_json(named_struct('v', names[{i}])), 6, length(to_json(named_struct('v', names[{i}]))) - 6)")
        for i in range(len(names))
    ]
    labels = normalize.locate_fields(columns, pinned_mapping(spark)).first()["labels"]
    assert labels == list(columns.select(*[c.alias(f"c{i}") for i, c in enumerate(by_spark)]).first())
    assert [json.loads(label) for label in labels] == names


def few_tables(spark, sf):
    """Rows as the queries' tables have them, with a deposit published again by later files."""
    spark.range(600).selectExpr(
        "id % 150 * 7 AS l_orderkey", "id % 90 AS l_partkey", "id % 40 AS l_suppkey", "cast(id % 5 AS int) AS l_linenumber",
        "id * 1.25D AS l_extendedprice", "'R' AS l_returnflag", "'O' AS l_linestatus",
        "cast(timestamp'1996-01-03' + make_interval(0, cast(id % 60 AS int)) AS timestamp_ntz) AS l_shipdate",
    ).write.parquet(f"{sf}/lineitem.parquet")
    spark.sql("SELECT timestamp_ntz'1996-01-03' AS o_orderdate, '1-URGENT' AS o_orderpriority").write.parquet(f"{sf}/orders.parquet")
    spark.range(2).selectExpr("id AS n_nationkey").write.parquet(f"{sf}/nation.parquet")


def test_claims_meet_their_parties_and_observations_unmoved(spark, tmp_path):
    """Claims, observations and links lie in the same buckets of claims; only periods are dealt into them."""
    tune(spark)
    sf = str(tmp_path)
    few_tables(spark, sf)
    core, staging = queries._core(spark, sf), driver_tables.staging(spark, sf)
    for stored, built in (
        (core.claims, lifecycle.build_claims(staging)),
        (core.observations, lifecycle.build_observations(staging)),
        (core.claim_parties, lifecycle.build_claim_parties(staging)),
    ):
        assert stored.count() > 0 and sorted(map(str, stored.collect())) == sorted(map(str, built.collect()))
    met = core.claim_parties.join(core.claims, "claim_id")
    shown = met._jdf.queryExecution().executedPlan().toString()
    assert shown.count("Bucketed: true") == 2 and "ShuffledHashJoin" in shown and "Exchange" not in shown
    # Claim rows are gone with the step that read them, and made again if they are asked for.
    (claims,) = {Path(f.removeprefix("file:")).parent for f in core.claims.inputFiles()}
    assert claims.exists() and not claims.with_name(claims.name.replace("claim-", "claim_rows-")).exists()
    assert core.deposits.count() == core.claim_parties.count()
    # Last periods are stored in the same buckets, so finding deposits shuffles nothing but names of courts.
    shown = core.deposits._jdf.queryExecution().executedPlan().toString()
    assert shown.count("Bucketed: true") == 3 and "hashpartitioning(claim_id" not in shown and "hashpartitioning(capture_id" not in shown
    plain = search.party_deposits(
        lifecycle.build_claim_parties(staging), lifecycle.build_claims(staging), lifecycle.build_observations(staging),
        core.captures, core.files, core.court_names,
    )
    assert sorted(map(str, core.deposits.collect())) == sorted(map(str, plain.collect()))


def test_shuffle_files_go_with_their_statement(spark, tmp_path):
    tune(spark)
    sums = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).agg(F.sum("id").alias("s"))

    def shuffled():
        local = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {local.apply(i).getName() for i in range(local.size()) if local.apply(i).getName().endswith(".data")}

    before = shuffled()
    sums.write.parquet(f"{tmp_path}/sums")
    until = time.monotonic() + 20
    while shuffled() - before and time.monotonic() < until:
        time.sleep(0.1)
    assert not shuffled() - before
    # A frame can still be read as often as one likes.
    assert sums.collect() == sums.collect() and len(list(sums.toLocalIterator())) == 7


def test_builds_move_no_row(spark, tmp_path):
    """A build's rows stay in the tasks that judged them, each a file for a period, sorted by capture."""
    tune(spark)
    rows = judged(spark, *[(f"c{i % 7}", f"{i:03d}") for i in range(60)]).withColumn("source_row", F.col("deposit_no").cast("bigint"))
    dealt = rows.repartition(3, "source_row")
    of_task = {r["source_row"]: r["task"] for r in dealt.select("source_row", F.spark_partition_id().alias("task")).collect()}
    build = builds.write(dealt, str(tmp_path))
    files = list(tmp_path.glob(f"normalized/rows/build={build}/period=2024-1/*.parquet"))
    held = [[(r["capture_id"], r["source_row"]) for r in spark.read.parquet(str(f)).collect()] for f in files]
    assert sorted(sorted({of_task[n] for _, n in file}) for file in held) == [[0], [1], [2]]
    assert sum(map(len, held)) == 60 and all([k for k, _ in file] == sorted(k for k, _ in file) for file in held)
