import datetime as dt

import pytest
from pyspark.sql import functions as F

from fallowfunds import functions as fn

# Values seen in published lists, with the amount each one means.
# Amounts as published and what they mean; the builder's own cases follow.
TEXT_AMOUNTS = [
    ("20501", 20501),
    ("121378.11", 121378),
    ("2681947.56", 2681947),
    ("115,258,00", 115258),
    ("19,775,00", 19775),
    ("$ 88.000,oo", 88000),
    ("$ 250.000,oo", 250000),
    (" $260.000.00 ", 260000),
    ("$150.000.oo", 150000),
    ("$10.000.oo", 10000),
    ("135.000,00", 135000),
    ("24.356.33", 24356),
    ("166.642.83", 166642),
    ("\xa0$ \xa0 2.863.837,00\xa0", 2863837),
    ("700,000,00", 700000),
    ("2,570,334,72", 2570334),
    ("9044965.199999999", 9044965),
    ("1043912.5", 1043912),
    ("1043913.5", 1043914),
    ("-135.000,00", -135000),
    ("-12.5", -12),
    ("1.234.567", 1234567),
    ("1234.5678,9", None),
    ("12,5", None),
    ("123.", 123),
    ("99999999999999999999", None),
    ("--5", None),
    ("5-5", None),
    (".50", None),
    ("$", None),
    ("1\t2", None),
    ("\t12\n", 12),
    ("foo", None),
    ("12 oo", None),
    (None, None),
    ("", None),
    ("abc", None),
]

NUMBER_AMOUNTS = [
    ("1500000", 1500000),
    ("1500000.0", 1500000),
    ("121378.75", 121379),
    ("2.5", 2),
    ("3.5", 4),
    ("-2.5", -2),
    ("1.5E6", 1500000),
    ("NaN", None),
    ("1E30", None),
]

# Dates as published and what they mean; the builder's own cases follow.
TEXT_DATES = [
    ("2011-03-13 00:00:00", dt.date(2011, 3, 13)),
    ("2019-12-09 00:00:00", dt.date(2019, 12, 9)),
    ("02/11/1963", dt.date(1963, 11, 2)),
    ("2/1/1963", dt.date(1963, 1, 2)),
    ("29/10/2015", dt.date(2015, 10, 29)),
    ("26/08/2016", dt.date(2016, 8, 26)),
    ("19991004", dt.date(1999, 10, 4)),
    ("20130617", dt.date(2013, 6, 17)),
    ("2026-01-15", dt.date(2026, 1, 15)),
    (" 2026-01-15 and more", dt.date(2026, 1, 15)),
    ("not a date", None),
    ("2026-13-01", None),
    ("30/02/2016", None),
    ("0000-01-01", None),
    ("01/01/0000", None),
    ("56634-01-01 00:00:00", None),
    ("199910041", None),
    ("", None),
    (None, None),
]


def column_of(spark, values, expr, source="string"):
    rows = [(i, v) for i, v in enumerate(values)]
    frame = spark.createDataFrame(rows, f"i int, v {source}").repartition(3)
    return [r.x for r in frame.select("i", expr(F.col("v")).alias("x")).orderBy("i").collect()]


def test_currency_text(spark):
    got = column_of(spark, [v for v, _ in TEXT_AMOUNTS], fn.parse_currency)
    assert list(zip([v for v, _ in TEXT_AMOUNTS], got)) == TEXT_AMOUNTS


def test_currency_number_and_bool(spark):
    got = column_of(
        spark, [v for v, _ in NUMBER_AMOUNTS], lambda c: fn.amount_from_cell(F.lit("number"), c)
    )
    assert list(zip([v for v, _ in NUMBER_AMOUNTS], got)) == NUMBER_AMOUNTS
    assert column_of(spark, ["1"], lambda c: fn.amount_from_cell(F.lit("bool"), c)) == [None]


def test_dates(spark):
    got = column_of(spark, [v for v, _ in TEXT_DATES], fn.parse_date)
    assert list(zip([v for v, _ in TEXT_DATES], got)) == TEXT_DATES
    numbers = ["20080417.0", "19991020", "1.9991004E7", "123", "NaN", "20081332", "-20080417"]
    expected = [dt.date(2008, 4, 17), dt.date(1999, 10, 20), dt.date(1999, 10, 4)] + [None] * 4
    assert column_of(spark, numbers, lambda c: fn.date_from_cell(F.lit("number"), c)) == expected


def number_id(c):
    kind = F.lit("number")
    return fn.id_from_cell(kind, fn.stringify_cell(kind, c))


def test_ids(spark):
    texts = ["900123456", "80.123.456", "Desconocido", "desconocido", None, ""]
    expected = ["900123456", "80123456", None, None, None, None]
    assert column_of(spark, texts, fn.normalize_id) == expected
    numbers = ["900123456", "900123456.0", "5.8092044001E10", "7.6E22", "12.9", "NaN", "-5.5"]
    expected = ["900123456", "900123456", "58092044001", "76000000000000000000000", "12", None, "5"]
    assert column_of(spark, numbers, number_id) == expected


def test_stringify(spark):
    numbers = ["5.8092044001E10", "900.0", "12.50", "7", "1.25E1", None, "7.6E22", "-3.0"]
    expected = ["58092044001", "900", "12.50", "7", "12.5", None, "76000000000000000000000", "-3"]
    numbers += ["1.0E40", "-1.25E45"]
    expected += ["1" + "0" * 40, "-125" + "0" * 43]
    assert column_of(spark, numbers, lambda c: fn.stringify_cell(F.lit("number"), c)) == expected
    assert column_of(spark, ["900.0"], lambda c: fn.stringify_cell(F.lit("text"), c)) == ["900.0"]


# Check digits worked out by hand: the published example, short and long numbers, both edge digits.
CHECK_DIGITS = {
    "123456789": "6", "1": "8", "80123456": "4", "900123456": "8", "000000001": "8",
    "1" * 15: "1", "9" * 20: "2",
}


def test_check_digit(spark):
    assert column_of(spark, list(CHECK_DIGITS), fn.check_digit) == list(CHECK_DIGITS.values())


def test_canonical_document_number(spark):
    expected = {
        "1234567896": "123456789", "123456789": "123456789", "1234567890": "1234567890",
        "80123456": "80123456", "7": "7", "1" * 23: "1" * 23,
    }
    assert column_of(spark, list(expected), fn.canonical_document_number) == list(expected.values())


def test_canonical_court_account(spark):
    raw = ["58092044001", "058092044001", "58-092-044001", "5", "1234567890123", None, "x"]
    expected = ["058092044001"] * 3 + [None] * 4
    assert column_of(spark, raw, fn.canonical_court_account) == expected


def test_claim_id_namespaces(spark):
    frame = spark.createDataFrame(
        [("58092044001", "7"), ("058092044001", "7"), (None, "7"), ("5", "7")], "a string, d string"
    )
    keys = [r[0] for r in frame.select(fn.claim_key(F.col("a"), F.col("d"))).collect()]
    assert keys == ["058092044001:7", "058092044001:7", "no_court_account:7", "no_court_account:7"]


@pytest.mark.parametrize("missing", ["raise", "null"])
def test_period_from_key(spark, missing):
    ok = column_of(spark, ["raw/x/2024-2/a.xlsx"], lambda c: fn.period_from_key(c, missing))
    assert ok == ["2024-2"]
    if missing == "null":
        assert column_of(spark, ["raw/x/a.xlsx"], lambda c: fn.period_from_key(c, missing)) == [None]
    else:
        with pytest.raises(Exception, match="no period in key"):
            column_of(spark, ["raw/x/a.xlsx"], lambda c: fn.period_from_key(c, missing))


def test_candidates(spark):
    numbers = ["1234567896", "80123456", "000000001", None, "1" * 25]
    assert column_of(spark, numbers, fn.lookup_candidates) == [
        ["1234567896", "123456789"], ["80123456"], ["1", "0"], [], ["1" * 25],
    ]
    assert column_of(spark, ["1234567896", "8", None], fn.search_candidates) == [
        ["1234567896", "123456789"], ["8"], [],
    ]


def test_classify_category(spark):
    values = [
        "Persona Natural", "PERSONA JURÍDICA NACIONAL", "persona juridica", "ESTABLECIMIENTO", None,
        "Jurídica y natural",
    ]
    got = [tuple(x) for x in column_of(spark, values, fn.classify_category)]
    assert got == [
        ("natural_person", 1.0, "rues_categoria"),
        ("legal_entity", 1.0, "rues_categoria"),
        ("legal_entity", 1.0, "rues_categoria"),
        (None, None, "rues_categoria_unrecognized"),
        (None, None, "rues_categoria_missing"),
        ("legal_entity", 1.0, "rues_categoria"),
    ]


def test_display(spark):
    assert column_of(spark, [84500000, 5, -1234, None], fn.format_cop, "bigint") == [
        "$ 84.500.000", "$ 5", "$ -1.234", None,
    ]
    assert column_of(spark, ["legal_entity", "natural_person", None, "x"], fn.document_type_label) == [
        "Persona jurídica", "Persona natural", "Sin clasificar", "x",
    ]


def test_python_repr(spark):
    values = ["abc", "it's", 'say "hi"', "it's \"x\"", "a\\b"]
    assert column_of(spark, values, fn.python_repr) == [repr(v) for v in values]


def test_period_code(spark):
    periods = ["2017-1", "2026-2", None]
    assert column_of(spark, periods, lambda c: fn.period_of_code(fn.period_code(c))) == periods
    with pytest.raises(Exception, match="not a period"):
        column_of(spark, ["2017-10"], fn.period_code)
