import datetime as dt

import pytest
from pyspark.sql import functions as F

from fallowfunds import contracts as c
from fallowfunds.mappings import pinned_mapping
from fallowfunds.operators import enrichment, normalize, sheets
from fallowfunds.plans import jobs
from fallowfunds.sources import reading, writing

KEY = "raw/deposits/2024-1/list.xlsx"
OTHER = "raw/deposits/2024-1/second.xlsx"
HEADER = [
    "No. Depósito", "Despacho Judicial", "Cuenta Judicial", "Identificación Demandante",
    "Identificación Demandado", "Valor", "Fecha Constitución", "Seccional", "Departamento",
    "Ciudad",
]
ROW_1 = ["1", "Juzgado 1", "58092044001", "1234567896", "80123456", "135.000,00", "26/08/2016",
         "S", "D", "C"]
ROW_2 = ["2", "Juzgado 1", "058092044001", "Desconocido", "80123456", "not a number",
         "26/08/2016", "S", "D", "C"]
ROW_3 = ["3", "Juzgado 1", None, "123456789", None, "5", "2016-08-26", "S", "D", "C"]


def sheet_rows(spark, key, sheet, table, start=0):
    rows = [
        (key, sheet, start + i, [("text", v) for v in values]) for i, values in enumerate(table)
    ]
    return spark.createDataFrame(rows, reading.RAW_ROWS_SCHEMA)


@pytest.fixture
def raw(spark, tmp_path):
    rows = sheet_rows(
        spark, KEY, "Busqueda", [["Listado"], [], HEADER, ROW_1, ROW_2, ROW_3]
    ).unionByName(sheet_rows(spark, OTHER, "Busqueda", [HEADER, ROW_1]))
    rows.write.parquet(str(tmp_path / "rows"))
    spark.createDataFrame(
        [("raw/deposits/2024-2/bad.xlsx", None, "BadZipFile: x")], reading.RAW_ERRORS_SCHEMA
    ).write.parquet(str(tmp_path / "errors"))
    return str(tmp_path / "rows"), str(tmp_path / "errors"), str(tmp_path / "out")


def objects_of(spark):
    return spark.createDataFrame(
        [
            (k, "h", dt.datetime(2024, 7, 1))
            for k in (KEY, OTHER, "raw/deposits/2024-2/bad.xlsx")
        ],
        "key string, content_hash string, modified_at timestamp_ntz",
    )


def test_pipeline_end_to_end(spark, raw):
    rows, errors, root = raw
    checked = jobs.normalize_publications(spark, rows, root, errors)
    by_key = {r["key"]: (r["rows_read"], r["rows_ok"], r["rows_rejected"]) for r in checked.collect()}
    assert by_key == {
        KEY: (3, 2, 1), OTHER: (1, 1, 0), "raw/deposits/2024-2/bad.xlsx": (1, 0, 1),
    }
    rejects = {r["key"]: r for r in reading.read_rejects(spark, root).collect()}
    assert rejects[KEY]["reason"] == "could not parse amount_cop from 'not a number'"
    assert rejects[KEY]["source_row"] == 1
    bad = rejects["raw/deposits/2024-2/bad.xlsx"]
    assert (bad["sheet"], bad["source_row"], bad["raw_row"]) == ("<unknown>", None, None)
    assert bad["reason"] == "file unreadable: BadZipFile: x"

    # A rerun replaces its captures and nothing else.
    jobs.normalize_publications(spark, rows, root, errors)
    assert reading.read_staging(spark, root).count() == 3

    status = jobs.build_lineage(spark, objects_of(spark), root, "s3://b/")
    assert {r["status"]: r["captures"] for r in status.collect()} == {"ok": 2, "read_error": 1}

    totals = jobs.build_identity(spark, root).first().asDict()
    assert totals == {
        "parties": 2, "legal_entities": 0, "natural_persons": 0, "unclassified": 2, "courts": 1,
        "rows_without_account": 1,
    }
    totals, _ = jobs.build_lifecycle(spark, root)
    assert totals.first().asDict() == {
        "claims": 2, "observations": 3, "claim_party_links": 3, "avg_observations": 1.5,
    }

    registry = spark.createDataFrame(
        [(123456789, '{"registros":[{"razon_social":"ACME","estado_matricula":"activa",'
          '"categoria":"PERSONA JURÍDICA","id_rm":7}]}', '{"b":1}', None),
         (80123456, None, None, "Timeout: t")],
        reading.REGISTRY_SCHEMA,
    )
    at = dt.datetime(2026, 1, 1, 10, 0, 0)
    summary = jobs.enrich_parties(spark, registry, root, limit=10, at=at).first().asDict()
    assert summary == {
        "queried": 2, "found": 1, "not_found_or_error": 1, "legal_entities": 1,
        "natural_persons": 0,
    }
    # The failed lookup stays pending, the answered one does not.
    later = at + dt.timedelta(days=1)
    again = jobs.enrich_parties(spark, registry, root, limit=10, at=later).first().asDict()
    assert again["queried"] == 1 and again["found"] == 0
    assert reading.read_enrichment(spark, root).count() == 3

    jobs.build_identity(spark, root)
    typed = {
        r["document_number"]: r["document_type"]
        for r in reading.read_core(spark, root, c.PARTY).collect()
    }
    assert typed == {"123456789": "legal_entity", "80123456": None}

    windows = spark.createDataFrame(
        [("2024-1", None, dt.date(2024, 8, 1))], reading.WINDOWS_SCHEMA
    )
    requests = spark.createDataFrame([("123.456.789-6",), ("nobody",)], "raw_value string")
    answer = jobs.search_parties(spark, requests, windows, root, dt.date(2024, 8, 1)).collect()
    by_request = {r["raw_value"]: r.asDict() for r in answer}
    assert len(answer) == 2 and by_request["nobody"]["found"] is False
    assert by_request["nobody"]["deposit_count"] is None
    found = by_request["123.456.789-6"]
    assert found["found"] is True and found["last_period_deposit_count"] >= 1
    assert found["document_number"] == "123456789" and found["party_name"] == "ACME"
    assert found["deposit_count"] == 2 and found["total_amount_cop"] == 135005
    # One deposit has no known court, which counts as one office.
    assert found["court_office_count"] == 2
    assert found["claim_status"] == "reclamable" and found["rues_active"] is True

    stats = jobs.corpus_stats(spark, root).first().asDict()
    assert stats["observation_count"] == 3 and stats["latest_period"] == "2024-2"


def test_core_build_that_breaks_its_contract_is_not_published(spark, tmp_path):
    root = str(tmp_path)
    good = spark.createDataFrame([("a", "1", None, None, None)], c.PARTY.schema)
    writing.write_core(good, c.PARTY, root)
    bad = spark.createDataFrame([("b", "2", "alien", 1.0, "r")], c.PARTY.schema)
    with pytest.raises(c.ContractViolation, match="document_type:one_of: 1 row"):
        writing.write_core(bad, c.PARTY, root)
    with pytest.raises(c.ContractViolation, match="missing"):
        writing.write_core(good.drop("document_number"), c.PARTY, root)
    with pytest.raises(c.ContractViolation, match="unexpected"):
        writing.write_core(good.withColumn("x", F.lit(1)), c.PARTY, root)
    assert [r["party_id"] for r in reading.read_core(spark, root, c.PARTY).collect()] == ["a"]
    with pytest.raises(reading.NothingPublished):
        reading.read_core(spark, root, c.CLAIM)


def test_read_enrichment_batches_of_several_ages(spark, tmp_path):
    root = str(tmp_path)
    assert reading.read_enrichment(spark, root).count() == 0
    at = dt.datetime(2024, 1, 1)
    spark.createDataFrame(
        [("p1", "RUES", "old", at, '{"registros":[]}')],
        "party_id string, source string, batch_id string, queried_at timestamp_ntz, result string",
    ).write.partitionBy("source", "batch_id").parquet(f"{root}/enrichment")
    newer = spark.createDataFrame([("p2", "RUES", at, "{}", "N", True, None, "found", None, None,
                                    None, None)], c.ENRICHMENT.schema)
    writing.append_enrichment(newer, root, writing.batch_id(at))
    writing.append_enrichment(newer, root, writing.batch_id(at))
    rows = {r["party_id"]: r["status"] for r in reading.read_enrichment(spark, root).collect()}
    assert rows == {"p1": None, "p2": "found"}
    assert reading.read_enrichment(spark, root).count() == 2


def test_discover_and_hash(spark, tmp_path):
    folder = tmp_path / "raw" / "2024-1"
    folder.mkdir(parents=True)
    (folder / "a.xlsx").write_bytes(b"abc")
    (folder / "b.xlsx").write_bytes(b"defg")
    found = {r["key"].rsplit("/", 1)[1]: r for r in reading.discover(spark, str(tmp_path)).collect()}
    assert set(found) == {"a.xlsx", "b.xlsx"} and found["a.xlsx"]["length"] == 3
    (folder / "_hidden.xlsx").write_bytes(b"h")
    (folder / "empty.xlsx").write_bytes(b"")
    hashed = {
        r["key"]: r["content_hash"] for r in reading.read_objects(spark, str(tmp_path)).collect()
    }
    assert hashed == {
        "raw/2024-1/a.xlsx": "ba7816bf8f01cfea414140de5dae2223b00361a396177a9cb410ff61f20015ad",
        "raw/2024-1/b.xlsx": "4c8a43980498636e9c1d1595fa5d115af7937c2422dfe68a2520a52b7a5fb4de",
        "raw/2024-1/_hidden.xlsx": None,
        "raw/2024-1/empty.xlsx": None,
    }
    below = reading.discover(spark, str(folder), str(tmp_path)).collect()
    assert {r["key"] for r in below} == set(hashed)


def test_files_on_disk_join_their_captures(spark, tmp_path):
    """Discovery, normalisation and lineage agree on a file's id."""
    for key in (KEY, OTHER):
        (tmp_path / "bucket" / key).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / "bucket" / key).write_bytes(key.encode())
    rows = sheet_rows(spark, KEY, "Busqueda", [HEADER, ROW_1, ROW_3]).unionByName(
        sheet_rows(spark, OTHER, "Busqueda", [HEADER, ROW_2])
    )
    rows.write.parquet(str(tmp_path / "rows"))
    root = str(tmp_path / "out")
    jobs.normalize_publications(spark, str(tmp_path / "rows"), root)
    found = reading.read_objects(spark, str(tmp_path / "bucket"))
    jobs.build_lineage(spark, found, root, "s3://b/")
    files = {r["file_id"]: r["uri"] for r in reading.read_core(spark, root, c.FILE).collect()}
    captures = reading.read_core(spark, root, c.CAPTURE).collect()
    assert {(files[r["file_id"]], r["rows_ok"], r["rows_rejected"]) for r in captures} == {
        (f"s3://b/{KEY}", 2, 0), (f"s3://b/{OTHER}", 0, 1),
    }
    staging = reading.read_staging(spark, root)
    assert {r["capture_id"] for r in captures if r["rows_ok"]} == {
        r["capture_id"] for r in staging.select("capture_id").distinct().collect()
    }


def test_rerun_after_new_publications(spark, tmp_path):
    """What was appended between two runs is parsed, and an unmapped sheet is rejected."""
    path, root = str(tmp_path / "rows"), str(tmp_path / "out")
    sheet_rows(spark, KEY, "Busqueda", [HEADER, ROW_1]).write.parquet(path)
    jobs.normalize_publications(spark, path, root)
    new, odd = "raw/deposits/2025-1/new.xlsx", "raw/deposits/2025-2/odd.xlsx"
    sheet_rows(spark, new, "Busqueda", [HEADER, ROW_3]).write.mode("append").parquet(path)
    sheet_rows(spark, odd, "Nueva", [HEADER, ROW_1]).write.mode("append").parquet(path)
    total = normalize.reconciliation_total(jobs.normalize_publications(spark, path, root)).first()
    assert tuple(total) == (3, 3, 2, 1, 0)
    added = reading.read_staging(spark, root).filter("period = '2025-1'").first()
    assert (added["deposit_no"], added["amount_cop"]) == ("3", 5)
    (reject,) = reading.read_rejects(spark, root).collect()
    assert reject["reason"] == "no column mapping for period='2025-2' sheet='Nueva'"


def test_rows_without_columns_are_not_accepted(spark):
    """A column table that is out of date, and blank rows of an unmapped sheet."""
    rows = sheet_rows(spark, KEY, "Busqueda", [HEADER, ROW_1]).unionByName(
        sheet_rows(spark, "raw/deposits/2025-2/odd.xlsx", "Nueva", [[], [None]])
    )
    mapping = pinned_mapping(spark)
    stale = sheets.sheet_columns(rows).filter("false")
    judged = {r["key"]: r["reject_reason"] for r in normalize.normalize(rows, mapping, stale).collect()}
    assert judged == {
        KEY: "no columns known for sheet='Busqueda'",
        "raw/deposits/2025-2/odd.xlsx": "no column mapping for period='2025-2' sheet='Nueva'",
    }


def test_failed_runs_change_nothing(spark, tmp_path, monkeypatch):
    path, root = str(tmp_path / "rows"), str(tmp_path / "out")
    sheet_rows(spark, KEY, "Busqueda", [HEADER, ROW_1]).write.parquet(path)
    jobs.normalize_publications(spark, path, root)
    before = reading.read_staging(spark, root).collect()
    sheet_rows(spark, OTHER, "Busqueda", [HEADER, ROW_1, ROW_3]).write.mode("append").parquet(path)
    lose = normalize.accepted
    monkeypatch.setattr(normalize, "accepted", lambda n: lose(n).filter("deposit_no <> '3'"))
    with pytest.raises(jobs.ReconciliationError, match=f"{OTHER}: 1 ok . 0 rejected != 2 read"):
        jobs.normalize_publications(spark, path, root)
    assert reading.read_staging(spark, root).collect() == before


def test_a_capture_without_rows_replaces_its_former_ones(spark, tmp_path):
    root = str(tmp_path / "out")
    for name, table in (("one", [HEADER, ROW_1]), ("two", [HEADER])):
        path = str(tmp_path / name)
        sheet_rows(spark, KEY, "Busqueda", table).write.parquet(path)
        jobs.normalize_publications(spark, path, root)
    assert reading.read_staging(spark, root).count() == reading.read_rejects(spark, root).count() == 0


def test_a_bad_batch_stays_out_of_the_history(spark, tmp_path):
    root = str(tmp_path / "out")
    parties = spark.createDataFrame([("p1", "123456789", None, None, None)], c.PARTY.schema)
    writing.write_core(parties, c.PARTY, root)
    registry = spark.createDataFrame([(123456789, '{"registros":[]}', None, None)], reading.REGISTRY_SCHEMA)
    broken = enrichment.enrich

    def without_ids(*args):
        return c.ENRICHMENT.project(broken(*args).withColumn("party_id", F.lit(None).cast("string")))

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(enrichment, "enrich", without_ids)
        with pytest.raises(c.ContractViolation):
            jobs.enrich_parties(spark, registry, root)
    assert reading.read_enrichment(spark, root).count() == 0
    assert jobs.enrich_parties(spark, registry, root).first()["queried"] == 1


def test_profile_csv(spark, raw, tmp_path):
    rows, errors, _ = raw
    jobs.profile_publications(spark, rows, str(tmp_path / "csv"), errors)
    back = spark.read.option("header", True).option("escape", '"').csv(str(tmp_path / "csv"))
    assert back.columns == c.PROFILE.columns
    lines = {(r["file"], r["column"]): r for r in back.collect()}
    account = lines[(KEY, "Cuenta Judicial")]
    # Two spellings and a blank.
    assert (account["null_rate"], account["distinct_count"]) == ("0.3333", "3")
    error = lines[("raw/deposits/2024-2/bad.xlsx", "<READ_ERROR>")]
    assert (error["position"], error["sheet"], error["dtype"]) == ("-1", "<unknown>", "BadZipFile: x")


def test_header_below_titles_and_ties(spark):
    tall = sheet_rows(spark, KEY, "A", [["t"]] * 7 + [HEADER, ROW_1])
    tie = sheet_rows(spark, KEY, "B", [["a", "b"], ["c", "d"]])
    late = sheet_rows(spark, KEY, "C", [["x", "y"]] * 30, start=40)
    rows = tall.unionByName(tie).unionByName(late)
    heads = {r["sheet"]: r["header_row"] for r in sheets.detect_header_row(rows).collect()}
    assert heads == {"A": 7, "B": 0}
    columns = {r["sheet"]: r["names"] for r in sheets.sheet_columns(rows).collect()}
    assert columns["C"] == ["__UNNAMED__0", "__UNNAMED__1"]
    # No row of the sheet without a header is lost.
    assert sheets.assemble_rows(rows).filter("sheet = 'C'").count() == 30


def test_duplicate_and_blank_headers(spark):
    rows = sheet_rows(spark, KEY, "A", [["a", "a_1", "a", None, "a"], ["1", "2", None, None, None, "6"]])
    names = sheets.sheet_columns(rows).first()["names"]
    assert names[:2] == ["a", "a_1"] and len(set(names)) == 6
    assert names[3] == "__UNNAMED__3" and names[5] == "__UNNAMED__5"


def test_long_form_cells_give_the_same_rows(spark):
    cells = spark.createDataFrame(
        [
            (KEY, "A", 0, 0, "text", "h"), (KEY, "A", 0, 1, "text", "h2"),
            (KEY, "A", 1, 0, "text", "x"), (KEY, "A", 1, 2, "number", "3"),
        ],
        "key string, sheet string, row_idx bigint, col_idx int, kind string, text string",
    )
    rows = {r["row_idx"]: r["cells"] for r in sheets.rows_from_cells(cells).collect()}
    assert rows[1][0]["text"] == "x" and rows[1][1] is None and rows[1][2]["text"] == "3"
    named = sheets.assemble_rows(sheets.rows_from_cells(cells)).first()["cells"]
    assert {k: v["text"] for k, v in named.items()} == {
        "h": "x", "h2": None, "__UNNAMED__2": "3",
    }
