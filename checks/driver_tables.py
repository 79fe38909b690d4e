"""The driver's tables seen as this domain's inputs.

Every row of ``lineitem`` is one published deposit, every row of ``events`` one registry attempt,
every ``customer`` and ``supplier`` one registry record. All of it is projection: no sampling, no
numbering, and a third of all rows shares one plaintiff, as mass creditors do.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fallowfunds import functions as fn
from fallowfunds.contracts import STAGING
from fallowfunds.functions.identifiers import numeric_check_digit
from fallowfunds.mappings import PINNED
from fallowfunds.operators import sheets
from fallowfunds.operators.normalize import CANONICAL_FIELDS
from fallowfunds.sources.scratch import Buckets, staged

# Periods the shipping dates 1995..2001 become when moved 22 years on.
PERIODS = [f"{year}-{half}" for year in range(2017, 2024) for half in (1, 2)]
MASS_CREDITOR = 860034313

# Sheet each period's rows are on; a rule on the part key where a publication has two.
SHEET_RULE = """CASE
  WHEN period = '2017-1' THEN CASE WHEN p % 2 = 0 THEN 'D J EN CONDICION ESPECIAL' ELSE 'D J NO RECLAMADOS' END
  WHEN period = '2018-1' THEN 'Consolidado Publicar'
  WHEN period = '2018-2' THEN CASE WHEN p % 5 = 0 THEN 'Hoja1' ELSE 'Publicar' END
  WHEN period = '2019-1' THEN 'Listado Publicación'
  WHEN period = '2020-1' THEN 'Consolidado'
  WHEN period = '2020-2' THEN 'Publicación'
  WHEN period = '2021-1' THEN 'Depósitos a Prescribir 2021-1a'
  WHEN period = '2021-2' THEN 'Detalle'
  WHEN period = '2022-1' THEN 'Base Publicación'
  WHEN period = '2022-2' THEN 'Consolidado'
  WHEN period = '2023-1' THEN 'Inventario Publicar'
  WHEN period = '2023-2' THEN 'Busqueda'
  ELSE 'Hoja1' END"""


PERIOD = "concat(year(d) + 22, '-', if(month(d) <= 6, 1, 2))"
KEY = "concat('raw/deposits/', period, '/list-', o div 1000, '.xlsx')"

# Sheets are dealt into buckets, each read by one task; there are as many as the rows need.
BUCKET_ROWS = 100_000
FEWEST = 8


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def dealt(frame: DataFrame) -> DataFrame:
    """Rows of a table that is one row group, dealt to all cores before they are made wide.

    They go by a hash of their values: dealing in turns sorts every row first, which spills.
    """
    return frame.repartition(*frame.columns)


def published(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem with short names and the place of each row: key, period, sheet, source_row."""
    return _placed(_lines(spark, sf_dir))


def published_dealt(spark: SparkSession, sf_dir: str, buckets: Buckets | None = None) -> DataFrame:
    """:func:`published`, its rows dealt to all cores, or into buckets of sheets, while they are narrow."""
    lines = _lines(spark, sf_dir)
    if buckets is None:
        return _placed(dealt(lines))
    # Key and sheet are worked out to deal the rows by, but do not travel with them.
    period = f"({PERIOD})"
    by = {"key": KEY.replace("period", period), "sheet": SHEET_RULE.replace("period", period)}
    return _placed(lines.repartition(buckets.number, *[F.expr(by[k]) for k in buckets.keys]))


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey AS o",
        "l_partkey AS p",
        "l_suppkey AS s",
        "l_linenumber AS n",
        "l_returnflag AS flag",
        "l_linestatus AS line_status",
        "cast(round(l_extendedprice * 100) AS bigint) AS cents",
        "cast(l_shipdate AS date) AS d",
    )


def _placed(lines: DataFrame) -> DataFrame:
    return lines.withColumn("period", F.expr(PERIOD)).selectExpr(
        "*",
        f"{KEY} AS key",
        f"{SHEET_RULE} AS sheet",
        # Spread out, so that no global numbering is needed.
        "(p * 100 + s % 100) * 10000 + (o % 1000) * 10 + n AS source_row",
    )


def _account(format_by: str) -> Column:
    number = "58092000000 + o % 4999"
    return F.expr(
        f"""CASE {format_by} % 3
          WHEN 0 THEN cast({number} AS string)
          WHEN 1 THEN concat('0', {number})
          ELSE concat('58-092-', lpad(cast(o % 4999 AS string), 6, '0')) END"""
    )


def staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The staging table as a normalisation run would have left it, in storage."""
    return staged(spark, "staging", sf_dir, lambda: staged_rows(spark, sf_dir))


def staged_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = published_dealt(spark, sf_dir)
    base = F.expr("900000000 + p")
    values = {
        "capture_id": fn.hash_id(F.col("key")),
        "deposit_no": F.expr("if(o % 97 = 0, NULL, cast(o * 10 + n AS string))"),
        "deposit_type": F.col("flag"),
        "classification": F.expr(
            "CASE WHEN p % 17 = 0 THEN NULL WHEN line_status = 'O' THEN 'Ordinario' ELSE 'Especial' END"
        ),
        "court_account": F.when(F.expr("o % 7 = 0"), F.lit(None))
        .when(F.expr("o % 7 = 1"), F.expr("cast(o % 10 AS string)"))
        .otherwise(_account("p")),
        "court_name": F.expr(
            "if(p % 29 = 0, NULL, concat('Juzgado ', o % 4999, if(period < '2020-1', ' Civil', ' Civil Municipal')))"
        ),
        "plaintiff_id": F.when(F.expr("p % 13 = 0"), F.lit(None))
        .when(F.expr("p % 3 = 0"), F.concat(base.cast("string"), numeric_check_digit(base, 9)))
        .when(F.expr("p % 3 = 1"), F.lit(str(MASS_CREDITOR)))
        .otherwise(base.cast("string")),
        "defendant_id": F.expr(
            "CASE WHEN s % 9 = 0 THEN NULL WHEN s % 10 = 1 THEN cast(900000000 + s AS string) "
            "ELSE cast(80000000 + s AS string) END"
        ),
        "amount_cop": F.expr("if(p % 31 = 0, NULL, cents div 100)"),
        "origin_date": F.expr("if(s % 33 = 0, NULL, d)"),
        "seccional": F.expr(
            "CASE WHEN p % 7 = 0 THEN NULL WHEN p % 5 = 0 THEN concat('Seccional X', p % 3) "
            "ELSE concat('Seccional ', o % 4999 % 23) END"
        ),
        "department": F.expr(
            "if(p % 4 = 0, concat('Dpto X', p % 2), concat('Dpto ', o % 4999 % 32))"
        ),
        "city": F.expr("if(p % 11 = 0, NULL, concat('Ciudad ', o % 4999 % 100))"),
        "judicial_district": F.expr("concat('Distrito ', p % 6)"),
        "source_extra": F.expr("""if(p % 19 = 0, concat('nota "', n, '"'), NULL)"""),
    }
    kept = {"period", "sheet", "source_row"}
    return rows.select(
        *[
            (F.col(f.name) if f.name in kept else values.get(f.name, F.lit(None)))
            .cast(f.type)
            .alias(f.name)
            for f in STAGING.fields
        ]
    )


def objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The listing of raw objects: one per key, stamped with its newest row.

    The tables hold no bytes; a digest of the key and row count stands for the content hash.
    """
    return (
        published(spark, sf_dir)
        .groupBy("key")
        .agg(F.max("d").cast("timestamp_ntz").alias("modified_at"), F.count(F.lit(1)).alias("n"))
        .select(
            "key",
            F.sha2(F.concat_ws(":", "key", "n"), 256).alias("content_hash"),
            "modified_at",
        )
    )


def enrichment_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attempts of all kinds, old batches without a status among them."""
    number = fn.canonical_document_number(F.expr("cast(900000000 + event_id div 3 AS string)"))
    return table(spark, sf_dir, "events").select(
        fn.hash_id(number).alias("party_id"),
        F.expr("if(event_id % 10 = 9, 'OTHER', 'RUES')").alias("source"),
        F.col("ts").alias("queried_at"),
        F.expr(
            """CASE event_type
              WHEN 'view' THEN concat('{"registros":[{"razon_social":"Empresa ', user_id, '"}]}')
              WHEN 'signup' THEN '{"registros":[]}'
              WHEN 'click' THEN '{"registros":[]}'
              ELSE '{"error":"Timeout"}' END"""
        ).alias("result"),
        F.expr("if(event_type = 'view', concat('Empresa ', user_id), NULL)").alias("name"),
        F.expr("if(event_type = 'view', value > 50, NULL)").alias("active"),
        F.lit(None).cast("string").alias("attributes"),
        F.expr(
            "CASE event_type WHEN 'view' THEN 'found' WHEN 'signup' THEN 'not_found' "
            "WHEN 'error' THEN 'error' END"
        ).alias("status"),
        F.expr(
            "if(event_type = 'view', CASE user_id % 3 WHEN 0 THEN 'PERSONA JURIDICA' "
            "WHEN 1 THEN 'Persona Natural' ELSE 'OTRA' END, NULL)"
        ).alias("categoria"),
        F.expr(
            "if(event_type = 'view', CASE user_id % 3 WHEN 0 THEN 'legal_entity' "
            "WHEN 1 THEN 'natural_person' END, NULL)"
        ).alias("document_type"),
        F.expr("if(event_type = 'view' AND user_id % 3 < 2, 1.0D, NULL)").alias(
            "document_type_confidence"
        ),
        F.expr(
            "CASE event_type WHEN 'view' THEN if(user_id % 3 < 2, 'rues_categoria', "
            "'rues_categoria_unrecognized') WHEN 'signup' THEN 'rues_not_found' END"
        ).alias("document_type_rule_id"),
    )


def registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registry answers: customers under 9-digit numbers (some only without the last digit),
    suppliers under 8-digit ones. Some answers and details of customers are broken."""
    columns = ["nit", "response", "detail", "error"]
    from_customers = table(spark, sf_dir, "customer").selectExpr(
        "if(c_custkey % 10 = 3, (900000000 + c_custkey) div 10, 900000000 + c_custkey) AS nit",
        """CASE WHEN c_custkey % 29 = 7 THEN '<html>busy</html>'
          WHEN c_custkey % 23 = 0 THEN concat('{"registros":[],"total":', c_custkey, '}') ELSE concat(
          '{"registros":[{"razon_social":"', c_name, '","estado_matricula":',
          CASE c_custkey % 4 WHEN 0 THEN '" activa "' WHEN 1 THEN '"CANCELADA"' WHEN 2 THEN '"ACTIVA"' ELSE 'null' END,
          CASE c_custkey % 5 WHEN 0 THEN ',"categoria":"Persona Natural"'
            WHEN 1 THEN ',"categoria":"PERSONA JURÍDICA NACIONAL"'
            WHEN 2 THEN ',"categoria":"ESTABLECIMIENTO DE COMERCIO"'
            WHEN 3 THEN ',"categoria":"persona juridica"' ELSE '' END,
          ',"id_rm":', c_custkey, '}', if(c_custkey % 6 = 0, ',{"razon_social":"second"}', ''), ']}') END AS response""",
        """CASE WHEN c_custkey % 31 = 11 THEN '{"empleados":'
          WHEN c_custkey % 2 = 0 THEN concat('{"empleados":', c_nationkey, ',"ciiu":["a","b"]}') END AS detail""",
        "if(c_custkey % 17 = 5, concat('Timeout: read ', c_custkey), NULL) AS error",
    )
    from_suppliers = table(spark, sf_dir, "supplier").selectExpr(
        "80000000 + s_suppkey AS nit",
        """concat('{"registros":[{"razon_social":"', s_name, '","estado_matricula":"Activa","categoria":"Persona Natural Comerciante","id_rm":', s_suppkey, '}]}') AS response""",
        "cast(NULL AS string) AS detail",
        "cast(NULL AS string) AS error",
    )
    return from_customers.select(columns).unionByName(from_suppliers.select(columns))


def search_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What people type: with and without dots, check digit and words."""
    base = F.expr("cast(900000000 + c_custkey AS string)")
    dotted = F.expr(
        "translate(format_number(900000000 + c_custkey, 0), ',', '.')"
    )
    value = (
        F.when(F.expr("c_custkey % 5 = 0"), base)
        .when(F.expr("c_custkey % 5 = 1"), F.concat(
                dotted, F.lit("-"), numeric_check_digit(F.expr("900000000 + c_custkey"), 9)
            ))
        .when(F.expr("c_custkey % 5 = 2"), F.concat(F.lit("NIT "), dotted))
        .when(F.expr("c_custkey % 5 = 3"), F.expr("concat('8', lpad(cast(c_custkey AS string), 7, '0'))"))
        .otherwise(F.lit("sin numero"))
    )
    return table(spark, sf_dir, "customer").select(value.alias("raw_value"))


def claim_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows of some periods, closing a month after the period's last order."""
    return (
        table(spark, sf_dir, "orders")
        .selectExpr(
            "concat(year(o_orderdate) + 22, '-', if(month(o_orderdate) <= 6, 1, 2)) AS period",
            "cast(o_orderdate AS date) AS d",
        )
        .groupBy("period")
        .agg(F.min("d").alias("opens_on"), F.date_add(F.max("d"), 30).alias("closes_on"))
        .filter("period NOT LIKE '%9-2'")
    )


# --- raw sheets ---------------------------------------------------------------------------


# Amounts and dates as lists have printed them, the last of each kind unreadable.
AMOUNT_TEXT = """CASE (p + n) % 12
  WHEN 0 THEN concat('$ ', dots, ',oo')
  WHEN 1 THEN concat(dots, ',', ff)
  WHEN 2 THEN concat(commas, '.', ff)
  WHEN 3 THEN dots
  WHEN 4 THEN concat(whole, '.5')
  WHEN 5 THEN concat(char(160), '$ ', char(160), ' ', dots, ',00', char(160))
  WHEN 6 THEN 'abc'
  WHEN 7 THEN NULL
  WHEN 8 THEN concat('-', dots, ',00')
  WHEN 9 THEN concat(whole, '.199999999')
  WHEN 10 THEN concat('$', dots, '.oO ')
  ELSE concat(dots, '.1234,5') END"""
AMOUNT_NUMBER = "if(p % 2 = 0, concat(whole, '.5'), concat(whole, '.', ff))"
# A text among the numbers of a column, which makes text of the whole column.
ODD_AMOUNT = "o div 1000 % 3 = 0 AND n = 7 AND p % 12 = 6"
DATE_TEXT = """CASE s % 6
  WHEN 0 THEN concat(iso, ' 00:00:00')
  WHEN 1 THEN date_format(d, 'dd/MM/yyyy')
  WHEN 2 THEN dmy
  WHEN 3 THEN date_format(d, 'yyyyMMdd')
  WHEN 4 THEN if(p % 5 = 0, NULL, iso)
  ELSE if(p % 8 = 0, '2026-13-01', concat(iso, 'T10:20')) END"""


PRINTED = (
    "*",
    "cast(cents div 100 AS string) AS whole",
    "translate(format_number(cents div 100, 0), ',', '.') AS dots",
    "format_number(cents div 100, 0) AS commas",
    "lpad(cast(cents % 100 AS string), 2, '0') AS ff",
    "date_format(d, 'yyyy-MM-dd') AS iso",
    "concat(day(d), '/', month(d), '/', year(d)) AS dmy",
)


def printed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Published rows with the pieces the text rules above are made of."""
    return published(spark, sf_dir).selectExpr(*PRINTED)


# What a published row can print; no sheet prints all of it.
RAW_FIELDS = (*CANONICAL_FIELDS, "source_extra_2", "remark")


def raw_fields(spark: SparkSession, sf_dir: str, buckets: Buckets | None = None) -> DataFrame:
    """Each published row with ``by_field``, its cells in the order of RAW_FIELDS."""
    rows = published_dealt(spark, sf_dir, buckets).selectExpr(*PRINTED)
    base = F.expr("cast(900000000 + p AS string)")
    texts = {
        "deposit_no": F.expr(
            "CASE WHEN period IN ('2020-1', '2020-2') THEN concat(o * 10 + n, '.0') "
            "WHEN o % 97 = 0 THEN 'S/N' ELSE concat('D-', o, '.', n) END"
        ),
        "deposit_type": F.col("flag"),
        "classification": F.expr("if(line_status = 'O', 'Ordinario', 'Especial')"),
        "court_account": F.when(
            F.col("period") == "2021-1",
            F.expr("cast(cast(58092000000 + o % 4999 AS double) AS string)"),
        )
        .when(F.expr("o % 7 = 0"), F.lit(None))
        .when(F.expr("o % 7 = 1"), F.expr("cast(o % 10 AS string)"))
        .otherwise(_account("p")),
        "court_name": F.expr("concat('Juzgado ', o % 4999)"),
        "plaintiff_id": F.when(F.expr("p % 13 = 0"), F.lit("Desconocido"))
        .when(F.expr("p % 3 = 0"), F.concat(base, F.lit("-"), numeric_check_digit(F.expr("900000000 + p"), 9)))
        .when(F.expr("p % 3 = 1"), F.lit("860.034.313"))
        .otherwise(base),
        "plaintiff_id_type": F.expr("if(p % 3 = 0, 'NIT', 'CC')"),
        "plaintiff_name": F.expr("concat('Señor \"P', p % 100, '\"')"),
        "defendant_id": F.expr(
            "if(s % 9 = 0, NULL, concat(80000000 + s, if(period = '2022-1', '.0', '')))"
        ),
        "defendant_id_type": F.lit("CC"),
        "defendant_name": F.expr("concat('D', s % 100)"),
        "amount_cop": F.when(
            F.col("period") == "2022-2",
            F.when(F.expr(ODD_AMOUNT), F.lit("abc")).otherwise(F.expr(AMOUNT_NUMBER)),
        ).otherwise(F.expr(AMOUNT_TEXT)),
        "origin_date": F.when(
            F.col("period") == "2023-2",
            F.expr("concat(if(p % 50 = 0, '56634-01-01', iso), ' 00:00:00')"),
        )
        .when(F.col("period") == "2020-1", F.expr("concat(date_format(d, 'yyyyMMdd'), '.0')"))
        .otherwise(F.expr(DATE_TEXT)),
        "case_action_date": F.expr("if(p % 9 = 0, '31/02/2016', dmy)"),
        "case_number": F.expr("lpad(cast(o AS string), 23, '0')"),
        "seccional": F.expr("concat('Seccional ', o % 23)"),
        "department": F.expr("concat('Dpto ', o % 32)"),
        "city": F.expr("concat('Ciudad ', o % 100)"),
        "judicial_district": F.expr("concat('Distrito ', o % 6)"),
        "source_extra": F.expr("if(p % 4 = 1, NULL, concat('extra A', n))"),
        # Second column of the field on the sheet that maps two, and a column nothing maps.
        "source_extra_2": F.expr("if(p % 4 = 3, NULL, concat('extra B', n))"),
        "remark": F.expr("if(p % 3 = 0, NULL, 'x')"),
    }
    kinds = {
        "deposit_no": "if(period IN ('2020-1', '2020-2'), 'number', 'text')",
        "court_account": "if(period = '2021-1', 'number', 'text')",
        "defendant_id": "if(period = '2022-1', 'number', 'text')",
        "amount_cop": f"if(period = '2022-2' AND NOT ({ODD_AMOUNT}), 'number', 'text')",
        "origin_date": "CASE period WHEN '2023-2' THEN 'datetime' WHEN '2020-1' THEN 'number' "
        "ELSE 'text' END",
    }
    cells = [
        F.struct(F.expr(kinds.get(f, "'text'")).alias("kind"), texts[f].alias("text"))
        for f in RAW_FIELDS
    ]
    return rows.select("key", "period", "sheet", "source_row", F.array(*cells).alias("by_field"))


def sheet_layouts() -> list[dict]:
    """Header texts and the field under each, per (period, sheet); blank headers are None."""
    layouts = []
    for period, sheet, columns, _ in PINNED:
        if period not in PERIODS:
            continue
        names = [None if c.startswith("__UNNAMED__") else c for c in columns]
        fields = list(columns.values())
        if fields.count("source_extra") == 2:
            fields[-1] = "source_extra_2"
        if not columns:
            names, fields = ["MUNICIPIO", "VALOR"], ["city", "amount_cop"]
        if period >= "2019-1":
            # A column no mapping knows, under a name the sheet already has.
            names, fields = names + [names[0]], fields + ["remark"]
        layouts.append({"period": period, "sheet": sheet, "names": names, "fields": fields})
    for period in ("2017-2", "2019-2"):
        layouts.append(
            {
                "period": period,
                "sheet": "Hoja1",
                "names": ["No. DEPÓSITO", "VALOR"],
                "fields": ["deposit_no", "amount_cop"],
            }
        )
    return layouts


def sheet_buckets(spark: SparkSession, sf_dir: str) -> Buckets:
    """The layout of rows and columns of sheets: a sheet is in one bucket."""
    rows = table(spark, sf_dir, "lineitem").count()
    return Buckets(tuple(sheets.SHEET), max(FEWEST, -(-rows // BUCKET_ROWS)))


def raw_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All sheets as rows of cells, stored as decoded publications would be, whole sheets together."""
    buckets = sheet_buckets(spark, sf_dir)
    return staged(spark, "raw_rows", sf_dir, lambda: print_sheets(spark, sf_dir, buckets), buckets)


def sheet_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of those sheets, stored as the jobs store them."""
    buckets = sheet_buckets(spark, sf_dir)
    return staged(
        spark, "sheet_columns", sf_dir,
        lambda: sheets.sheet_columns(raw_rows(spark, sf_dir)).repartition(buckets.number, *buckets.keys),
        buckets,
    )


def print_sheets(spark: SparkSession, sf_dir: str, buckets: Buckets | None = None) -> DataFrame:
    """0..7 title rows per sheet, the header, then the data."""
    layouts = sheet_layouts()
    strings = pa.list_(pa.string())
    layout = spark.createDataFrame(
        pa.table(
            {
                "period": [v["period"] for v in layouts],
                "sheet": [v["sheet"] for v in layouts],
                "names": pa.array([v["names"] for v in layouts], strings),
                "layout": pa.array(
                    [[RAW_FIELDS.index(f) for f in v["fields"]] for v in layouts],
                    pa.list_(pa.int32()),
                ),
            }
        )
    )
    widest = max(len(v["fields"]) for v in layouts)
    titles = "cast(regexp_extract(key, 'list-([0-9]+)', 1) AS bigint) % 8"
    data = (
        raw_fields(spark, sf_dir, buckets)
        .join(layout, ["period", "sheet"])
        .select(
            "key",
            "sheet",
            (F.expr(titles) + 1 + F.col("source_row")).alias("row_idx"),
            F.slice(
                F.array(*[F.get("by_field", F.get("layout", F.lit(i))) for i in range(widest)]),
                F.lit(1),
                F.size("layout"),
            ).alias("cells"),
        )
    )
    present = published(spark, sf_dir).select("key", "period", "sheet").distinct()
    above = present.join(layout, ["period", "sheet"]).withColumn("titles", F.expr(titles))
    cell = "struct<kind:string,text:string>"

    def shown(text: Column) -> Column:
        return F.struct(F.lit("text").alias("kind"), text.alias("text"))

    # Titles and header in one pass: lines are searched for their sheets a single time.
    blurb = F.array(shown(F.concat(F.lit("Publicación "), F.col("row_idx").cast("string"))))
    top = above.select(
        "key", "sheet", "titles", "names", F.explode(F.expr("sequence(0, titles)")).alias("row_idx")
    ).select(
        "key",
        "sheet",
        "row_idx",
        F.when(F.col("row_idx") == F.col("titles"), F.transform("names", shown))
        .otherwise(blurb)
        .cast(f"array<{cell}>")
        .alias("cells"),
    )
    return data.unionByName(top.repartition(buckets.number, *buckets.keys) if buckets else top)


def raw_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files and sheets that could not be opened, one per order priority and period."""
    return (
        table(spark, sf_dir, "orders")
        .selectExpr(
            "concat(year(o_orderdate) + 22, '-', if(month(o_orderdate) <= 6, 1, 2)) AS period",
            "o_orderpriority AS priority",
        )
        .distinct()
        .selectExpr(
            "concat('raw/deposits/', period, '/bad-', left(priority, 1), '.xlsx') AS key",
            "if(left(priority, 1) IN ('1', '2'), NULL, concat('Hoja', left(priority, 1))) AS sheet",
            "concat('CalamineError: broken ', priority) AS error",
        )
    )
