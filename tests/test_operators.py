import datetime as dt

import pytest
from pyspark.sql import functions as F

from fallowfunds import contracts as c
from fallowfunds.operators import enrichment, identity, lifecycle, lineage, normalize, search

TEXT_DEFAULTS = {f.name: None for f in c.STAGING.fields}


def staging(spark, *rows):
    """Staging rows from the given columns; the place of a row follows its position."""
    full = []
    for i, row in enumerate(rows):
        place = {
            "period": "2019-1", "sheet": "Busqueda", "source_row": i,
            "capture_id": f"cap-{row.get('period', '2019-1')}",
        }
        full.append(tuple({**TEXT_DEFAULTS, **place, **row}[f.name] for f in c.STAGING.fields))
    return spark.createDataFrame(full, c.STAGING.schema)


def values(frame, *columns):
    return sorted(
        (tuple(r[x] for x in columns) for r in frame.collect()),
        key=lambda t: tuple((v is None, str(v)) for v in t),
    )


def test_one_party_on_both_sides(spark):
    dep = staging(
        spark, {"plaintiff_id": "80123456", "period": "2020-1"},
        {"defendant_id": "80123456", "period": "2021-1"},
    )
    parties = identity.build_parties(dep)
    assert values(parties, "document_number", "document_type") == [("80123456", None)]
    c.validate(parties, c.PARTY)


def test_check_digit_collapses_spellings(spark):
    dep = staging(
        spark, {"plaintiff_id": "1234567896"}, {"plaintiff_id": "123456789"},
        {"defendant_id": "1234567890"},
    )
    assert values(identity.build_parties(dep), "document_number") == [
        ("1234567890",), ("123456789",),
    ] or values(identity.build_parties(dep), "document_number") == [
        ("123456789",), ("1234567890",),
    ]
    assert identity.resolve_document_numbers(dep).count() == 3


def test_courts_and_names(spark):
    dep = staging(
        spark,
        {"court_account": "58092044001", "court_name": "A", "period": "2020-1", "city": "x"},
        {"court_account": "058092044001", "court_name": "A", "period": "2021-1", "city": "y"},
        {"court_account": "58-092044001", "court_name": "B", "period": "2022-1", "city": "y"},
        {"court_account": "5", "court_name": "C"},
        {"court_account": None, "court_name": "D"},
    )
    courts = identity.build_courts(dep)
    assert values(courts, "court_account", "city", "seccional", "row_count") == [
        ("058092044001", "y", None, 3)
    ]
    names = identity.build_court_names(dep)
    assert values(names, "name", "first_period", "last_period", "row_count") == [
        ("A", "2020-1", "2021-1", 2), ("B", "2022-1", "2022-1", 1),
    ]
    c.validate(courts, c.COURT)
    c.validate(names, c.COURT_NAME)


def test_court_mode_tie_takes_the_lowest(spark):
    dep = staging(*[spark, *[
        {"court_account": "58092044001", "city": v} for v in ("b", "a", "b", "a", "c")
    ]])
    assert values(identity.build_courts(dep), "city") == [("a",)]


def test_classification_fills_only_known_parties(spark):
    parties = spark.createDataFrame(
        [(f"p{i}", str(i), None, None, None) for i in (1, 2, 3)], c.PARTY.schema
    )
    history = spark.createDataFrame(
        [
            ("p1", "RUES", dt.datetime(2024, 1, 1), "natural_person", 1.0, "r"),
            ("p1", "RUES", dt.datetime(2024, 2, 1), "legal_entity", 1.0, "r"),
            ("p1", "RUES", dt.datetime(2024, 3, 1), None, None, "rues_not_found"),
            ("p2", "OTHER", dt.datetime(2024, 3, 1), "legal_entity", 1.0, "r"),
        ],
        "party_id string, source string, queried_at timestamp_ntz, document_type string, "
        "document_type_confidence double, document_type_rule_id string",
    )
    typed = identity.apply_classification(parties, identity.latest_classification(history))
    assert values(typed, "party_id", "document_type") == [
        ("p1", "legal_entity"), ("p2", None), ("p3", None),
    ]


def test_repeated_row_is_one_claim_two_observations(spark):
    row = {"court_account": "58092044001", "deposit_no": "7", "amount_cop": 5}
    dep = staging(spark, row, row)
    assert lifecycle.build_claims(dep).count() == 1
    assert lifecycle.build_observations(dep).count() == 2
    c.validate(lifecycle.build_claims(dep), c.CLAIM)
    c.validate(lifecycle.build_observations(dep), c.OBSERVATION)


def test_newest_values_win(spark):
    key = {"court_account": "58092044001", "deposit_no": "7"}
    dep = staging(
        spark, {**key, "amount_cop": 200000, "period": "2020-1", "classification": 'a"b'},
        {**key, "amount_cop": 100000, "period": "2019-1"},
    )
    claim = lifecycle.build_claims(dep).collect()
    assert [r["amount_cop"] for r in claim] == [200000]
    assert claim[0]["attributes"] == '{"classification":"a\\"b","source_extra":null}'


def test_claim_without_account_and_excluded_period(spark):
    dep = staging(
        spark, {"deposit_no": "7", "period": "2018-1"}, {"deposit_no": "7", "period": "2018-2"},
        {"deposit_no": "9", "period": "2017-1"}, {"deposit_no": None},
    )
    assert values(lifecycle.build_claims(dep), "deposit_no", "court_id") == [("7", None)]
    assert lifecycle.build_claims(dep, excluded_periods=()).count() == 2


def test_claim_parties(spark):
    dep = staging(
        spark, {"deposit_no": "7", "plaintiff_id": "1234567896", "defendant_id": "80123456"},
        {"deposit_no": "7", "plaintiff_id": "123456789"},
    )
    links = lifecycle.build_claim_parties(dep)
    assert values(links, "procedural_role") == [("defendant",), ("plaintiff",)]
    c.validate(links, c.CLAIM_PARTY)


def test_persistence(spark):
    dep = staging(
        spark,
        *[{"deposit_no": n, "period": p} for n, p in (
            ("1", "2019-1"), ("2", "2019-1"), ("1", "2020-1"), ("1", "2020-1"), ("3", "2021-2"),
        )],
    )
    got = values(
        lifecycle.measure_persistence(dep),
        "prev_period", "period", "prev_count", "count", "overlap", "overlap_pct",
    )
    assert got == [("2019-1", "2020-1", 2, 1, 1, 50.0), ("2020-1", "2021-2", 1, 1, 0, 0.0)]
    one = staging(spark, {"deposit_no": "1"})
    assert lifecycle.measure_persistence(one).count() == 0


def test_key_collisions(spark):
    key = {"deposit_no": "7"}
    dep = staging(
        spark, {**key, "amount_cop": 1}, {**key, "amount_cop": 2},
        {"deposit_no": "8", "amount_cop": None}, {"deposit_no": "8", "amount_cop": None},
        {"deposit_no": "9"},
    )
    assert values(
        lifecycle.key_collisions(dep), "repeated_keys", "repeated_rows", "differing_keys"
    ) == [(2, 4, 1)]


def test_captures(spark):
    keys = spark.createDataFrame([("k/2020-1/a",), ("k/2020-1/b",), ("k/2020-1/c",)], "key string")
    ids = {r["key"]: r["id"] for r in keys.select("key", lineage.hash_id(F.col("key")).alias("id")).collect()}
    dep = staging(spark, *[{"capture_id": ids["k/2020-1/a"]}] * 2)
    rejects = spark.createDataFrame(
        [("k/2020-1/a", "bad cell"), ("k/2020-1/b", "file unreadable: x")],
        "key string, reason string",
    )
    got = lineage.build_captures(keys, dep, rejects, dt.datetime(2024, 1, 1))
    c.validate(got, c.CAPTURE)
    assert {r["capture_id"]: (r["rows_read"], r["rows_ok"], r["rows_rejected"], r["status"])
            for r in got.collect()} == {
        ids["k/2020-1/a"]: (3, 2, 1, "ok"),
        ids["k/2020-1/b"]: (1, 0, 1, "read_error"),
        ids["k/2020-1/c"]: (0, 0, 0, "ok"),
    }


HISTORY = [
    ("not_found", "{}", False), ("found", "{}", False), ("error", "{}", True),
    (None, '{"error":"x"}', True), (None, '{"registros":[]}', False),
]


@pytest.mark.parametrize("status,result,pending", HISTORY)
def test_pending(spark, status, result, pending):
    parties = spark.createDataFrame([("p1", "1"), ("p2", "2")], "party_id string, document_number string")
    history = spark.createDataFrame(
        [("p1", "RUES", status, result)], "party_id string, source string, status string, result string"
    )
    todo = {r["party_id"] for r in enrichment.parties_to_enrich(parties, history, None).collect()}
    assert todo == ({"p1", "p2"} if pending else {"p2"})
    assert enrichment.parties_to_enrich(parties, history, 1).count() == 1


def test_lookup_order_and_errors(spark):
    targets = spark.createDataFrame(
        [("fallback", "1234567896"), ("direct", "987654321"), ("miss", "5"),
         ("late_error", "1111111111"), ("hit_first", "2222222222")],
        "party_id string, document_number string",
    )
    record = '{"registros":[{"razon_social":"%s","estado_matricula":"CANCELADA","n":1.5,"x":null},{"razon_social":"no"}]}'
    registry = spark.createDataFrame(
        [
            (123456789, record % "base", '{"z":1}', None),
            (1234567896, '{"registros":[]}', None, None),
            (987654321, record % "exact", None, None),
            (98765432, record % "shorter", None, None),
            (111111111, None, None, "Timeout: t"),
            (2222222222, record % "first", None, None),
            (222222222, None, None, "never asked"),
        ],
        "nit bigint, response string, detail string, error string",
    )
    at = dt.datetime(2026, 1, 1)
    rows = {r["party_id"]: r for r in enrichment.enrich(targets, registry, at).collect()}
    assert {k: (r["status"], r["name"]) for k, r in rows.items()} == {
        "fallback": ("found", "base"), "direct": ("found", "exact"), "miss": ("not_found", None),
        "late_error": ("error", None), "hit_first": ("found", "first"),
    }
    assert rows["fallback"]["attributes"] == '{"n":1.5,"x":null,"detail":{"z":1}}'
    assert rows["fallback"]["active"] is False
    assert rows["fallback"]["document_type_rule_id"] == "rues_categoria_missing"
    assert rows["miss"]["document_type_rule_id"] == "rues_not_found"
    assert '"registros"' in rows["miss"]["result"] and rows["miss"]["active"] is None
    assert rows["late_error"]["result"] == '{"error":"Timeout: t"}'
    assert rows["late_error"]["document_type_rule_id"] is None


def test_broken_answers_are_errors_and_misses_are_kept(spark):
    targets = spark.createDataFrame(
        [("html", "1"), ("detail", "2"), ("list", "3"), ("miss", "444444444"), ("long", "9" * 20)],
        "party_id string, document_number string",
    )
    record = '{"registros":[{"razon_social":"x"}]}'
    registry = spark.createDataFrame(
        [
            (1, "<html>", None, None), (2, record, "{broken", None), (3, "[1]", None, None),
            (444444444, '{"registros":[],"n":1}', None, None), (44444444, '{"registros":[],"n":2}', None, None),
        ],
        "nit bigint, response string, detail string, error string",
    ).withColumn("nit", F.col("nit").cast("string")).unionByName(
        spark.createDataFrame([("9" * 20, record, None, None)], "nit string, response string, detail string, error string")
    )
    rows = {r["party_id"]: r for r in enrichment.enrich(targets, registry, dt.datetime(2026, 1, 1)).collect()}
    assert {k: r["status"] for k, r in rows.items()} == {
        "html": "error", "detail": "error", "list": "error", "miss": "not_found", "long": "found",
    }
    assert rows["miss"]["result"] == '{"registros":[],"n":2}'
    assert rows["detail"]["name"] is None and "detail" in rows["detail"]["result"]


def test_summary_counts_unknown_court_once(spark):
    deposits = spark.createDataFrame(
        [("p", "c1", None, 5, "plaintiff", "2020-1"), ("p", "c2", None, None, "defendant", "2020-2"),
         ("p", "c3", "J", 7, "defendant", None)],
        "party_id string, claim_id string, court_office string, amount_cop bigint, "
        "procedural_role string, period string",
    )
    row = search.party_summary(deposits).first().asDict()
    assert (row["court_office_count"], row["total_amount_cop"], row["last_period"]) == (2, 12, "2020-2")
    assert (row["plaintiff_count"], row["defendant_count"], row["defendant_amount_cop"]) == (1, 2, 7)
    assert search.party_period_summary(deposits).count() == 2


def test_claim_status(spark):
    summary = spark.createDataFrame([("a", "2020-1"), ("b", "2020-2"), ("c", None)], "party_id string, last_period string")
    windows = spark.createDataFrame([("2020-1", dt.date(2020, 8, 1))], "period string, closes_on date")

    def status(day):
        return dict(values(search.claim_status(summary, windows, day), "party_id", "claim_status"))

    assert status(dt.date(2020, 8, 1)) == {"a": "reclamable", "b": None, "c": None}
    assert status(dt.date(2020, 8, 2))["a"] == "no_reclamable"


def test_last_mapped_column_wins_even_if_blank(spark):
    cells = [("text", "first"), ("text", None)]
    rows = spark.createDataFrame(
        [("r/2030-1/a", "S", 0, [("text", "A"), ("text", "B")]), ("r/2030-1/a", "S", 1, cells)],
        "key string, sheet string, row_idx bigint, cells array<struct<kind:string,text:string>>",
    )
    mapping = spark.createDataFrame(
        [("2030-1", "S", None, [("A", "source_extra"), ("B", "source_extra"), ("gone", "city")])],
        "period string, sheet string, skip_reason string, column_map array<struct<source:string,field:string>>",
    )
    row = normalize.accepted(normalize.normalize(rows, mapping)).first()
    assert (row["source_extra"], row["city"], row["source_row"]) == (None, None, 0)


def test_results_do_not_depend_on_partitioning(spark):
    rows = [
        {"court_account": f"5809204400{i % 3}", "deposit_no": str(i % 5), "amount_cop": i,
         "period": f"20{18 + i % 4}-1", "plaintiff_id": "860034313" if i % 3 else str(900000000 + i),
         "city": "abc"[i % 3]}
        for i in range(60)
    ]
    dep = staging(spark, *rows)
    for build in (
        identity.build_parties, identity.build_courts, lifecycle.build_claims,
        lifecycle.build_claim_parties, lifecycle.measure_persistence,
    ):
        a, b = build(dep.repartition(1)), build(dep.repartition(7, "deposit_no"))
        assert values(a, *a.columns) == values(b, *b.columns)
