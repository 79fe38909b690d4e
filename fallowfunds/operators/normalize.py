"""Sheet rows to staging rows and rejects, with no row lost.

Column mappings are resolved per sheet, into the position of each canonical field. A data row
then only picks its cells by position and parses them, all in native expressions.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fallowfunds.contracts import REJECT, STAGING
from fallowfunds.functions.identifiers import hash_id
from fallowfunds.functions.parsing import (
    NUMBER,
    amount_from_cell,
    clean_currency,
    clean_date,
    date_from_clean,
    id_from_cell,
    period_from_key,
    number_repr,
    number_text,
    python_repr,
    stringify_cell,
)
from fallowfunds.operators.lineage import FILE_UNREADABLE, SHEET_UNREADABLE
from fallowfunds.operators.sheets import SHEET, UNKNOWN_SHEET, data_rows, sheet_columns

# The canonical fields in their order, by how they are read.
CANONICAL_FIELDS = (
    "deposit_no",
    "deposit_type",
    "classification",
    "court_account",
    "court_name",
    "plaintiff_id",
    "plaintiff_id_type",
    "plaintiff_name",
    "defendant_id",
    "defendant_id_type",
    "defendant_name",
    "amount_cop",
    "origin_date",
    "case_action_date",
    "case_number",
    "seccional",
    "department",
    "city",
    "judicial_district",
    "source_extra",
)
ID_FIELDS = ("deposit_no", "plaintiff_id", "defendant_id")
AMOUNT_FIELDS = ("amount_cop",)
DATE_FIELDS = ("origin_date", "case_action_date")
RAW_KEPT = (*ID_FIELDS, *AMOUNT_FIELDS, *DATE_FIELDS)

# Why a row is rejected whose sheet has cells but no columns: its column table is out of date.
NO_COLUMNS = "no columns known for sheet="

# Printable ASCII without quote and backslash, and a text inside the object that JSON is made through.
PLAIN_TEXT = r"^[ !#-\[\]-~]*\z"
JSON_OF_TEXT = r"(?s)^\{\"v\":(.*)\}\z"
JSON_NUMBER = r"^-?(0|[1-9][0-9]*)(\.[0-9]+)?([eE][-+]?[0-9]+)?$"

MAPPED = "mapped"
SKIPPED = "skipped"
UNMAPPED = "unmapped"


def mapping_outcome(sheets: DataFrame, mapping: DataFrame) -> DataFrame:
    """Add period, outcome and column map to ``sheets(key, sheet, ...)``, by exact match.

    ``mapping(period, sheet, skip_reason, column_map array<struct<source,field>>)`` is the
    pinned reference table.
    """
    # A flag marks the match, as a mapping may have neither reason nor columns.
    pinned = mapping.select(
        "period", "sheet", "skip_reason", "column_map", F.lit(True).alias("pinned")
    )
    return (
        sheets.withColumn("period", period_from_key(F.col("key")))
        .join(pinned, ["period", "sheet"], "left")
        .withColumn(
            "outcome",
            F.when(F.col("pinned").isNull(), UNMAPPED)
            .when(F.col("skip_reason").isNotNull(), SKIPPED)
            .otherwise(MAPPED),
        )
        .drop("pinned")
    )


def _sheet_reason() -> Column:
    unknown = F.concat(
        F.lit("no column mapping for period="),
        python_repr(F.col("period")),
        F.lit(" sheet="),
        python_repr(F.col("sheet")),
    )
    return F.when(F.col("outcome") == UNMAPPED, unknown).when(
        F.col("outcome") == SKIPPED, F.col("skip_reason")
    )


def _position(field: str) -> Column:
    """Position of a field's source column; of several sources the last in mapping order."""
    sources = F.filter("column_map", lambda m: m["field"] == field)
    source = F.try_element_at(sources, F.lit(-1))["source"]
    at = F.array_position("names", source)
    return F.when(at > 0, (at - 1).cast("int"))


def locate_fields(columns: DataFrame, mapping: DataFrame) -> DataFrame:
    """Per sheet: where each canonical field is, its column kind, and the columns' names as JSON."""
    outcomes = mapping_outcome(columns, mapping)
    return outcomes.withColumn(
        "at", F.array(*[_position(f) for f in CANONICAL_FIELDS])
    ).withColumn(
        "field_kinds", F.transform("at", lambda p: F.get("kinds", p))
    ).withColumn("labels", F.transform("names", _json_text)).drop(
        "column_map", "skip_reason", "outcome"
    )


def _picked(rows: DataFrame, mapping: DataFrame, columns: DataFrame | None) -> DataFrame:
    """Data rows with ``values array<string>``: the text of each canonical field, in order."""
    located = locate_fields(sheet_columns(rows) if columns is None else columns, mapping)
    value = F.transform(
        "at",
        lambda p: stringify_cell(F.get("cells", p)["kind"], F.get("cells", p)["text"]),
    )
    # A sheet of blank rows only has no columns to find a period or names with.
    period = F.coalesce("period", period_from_key(F.col("key")))
    nothing = F.array().cast("array<string>")
    # The planner takes the sheets joined with their mapping for too large to broadcast. Hashed a partition at a
    # time they leave the wide rows unsorted, and unmoved where both are stored in buckets of sheets.
    placed = data_rows(rows, located.hint("shuffle_hash")).withColumn("period", period)
    # Whether a sheet is mapped is asked of the rows themselves: a row whose sheet ``columns`` does
    # not know must not pass as one without values.
    pinned = mapping.select("period", "sheet", "skip_reason", F.lit(True).alias("pinned"))
    judged = placed.join(pinned, ["period", "sheet"], "left").withColumn(
        "outcome",
        F.when(F.col("pinned").isNull(), UNMAPPED)
        .when(F.col("skip_reason").isNotNull(), SKIPPED)
        .otherwise(MAPPED),
    )
    unknown = F.col("names").isNull() & F.exists("cells", lambda c: c["text"].isNotNull())
    reason = F.coalesce(
        _sheet_reason(),
        F.when(unknown, F.concat(F.lit(NO_COLUMNS), python_repr(F.col("sheet")))),
    )
    return judged.select(
        *SHEET,
        "period",
        "source_row",
        F.coalesce("labels", nothing).alias("labels"),
        F.coalesce("kinds", nothing).alias("kinds"),
        "cells",
        reason.alias("sheet_reason"),
        "field_kinds",
        "at",
        value.alias("values"),
    )


def _value(field: str) -> Column:
    return F.get("values", F.lit(CANONICAL_FIELDS.index(field)))


def _kind(field: str) -> Column:
    return F.get("field_kinds", F.lit(CANONICAL_FIELDS.index(field)))


def project_canonical(
    rows: DataFrame, mapping: DataFrame, columns: DataFrame | None = None
) -> DataFrame:
    """Data rows with the text of every canonical field.

    An unmapped field, or one whose source column a sheet lacks, is NULL. A number shows without
    exponent and without ``.0``.
    """
    return _picked(rows, mapping, columns).select(
        *SHEET, "period", "source_row", *[_value(f).alias(f) for f in CANONICAL_FIELDS]
    )


def _json_text(text: Column) -> Column:
    """A text as JSON. One that needs no escape is only put in quotes."""
    escaped = F.regexp_extract(F.to_json(F.struct(text.alias("v"))), JSON_OF_TEXT, 1)
    return F.when(text.rlike(PLAIN_TEXT), F.concat(F.lit('"'), text, F.lit('"'))).otherwise(escaped)


def row_json(names: Column, kinds: Column, cells: Column) -> Column:
    """A sheet row as a JSON object in the order of its columns. Cells of number columns are numbers,
    whole ones with ``.0``; blanks are null; all else is text."""
    return _labelled_json(F.transform(names, _json_text), kinds, cells)


def _labelled_json(labels: Column, kinds: Column, cells: Column) -> Column:
    """:func:`row_json` from names that are JSON already, as they are once per sheet."""

    def member(label: Column, i: Column) -> Column:
        text = F.get(cells, i)["text"]
        number = number_repr(number_text(text))
        value = (
            F.when(text.isNull(), "null")
            .when((F.get(kinds, i) == NUMBER) & number.rlike(JSON_NUMBER), number)
            .otherwise(_json_text(text))
        )
        return F.concat(label, F.lit(":"), value)

    return F.concat(F.lit("{"), F.array_join(F.transform(labels, member), ","), F.lit("}"))


def normalize(
    rows: DataFrame, mapping: DataFrame, columns: DataFrame | None = None
) -> DataFrame:
    """Every data row once, parsed, with ``reject_reason`` NULL where it is accepted.

    ``columns`` is the stored result of ``sheets.sheet_columns``, worked out here if not given.

    Holds the staging columns, the key, and the original row as JSON where rejected. Split it
    with :func:`accepted` and :func:`rejected`.

    Each step below is a projection of its own whose columns the next one reads more than once,
    so that every value is picked, cleaned and parsed a single time.
    """
    picked = _picked(rows, mapping, columns)
    staged = picked.withColumns(
        {f"{f}_clean": clean_currency(_value(f)) for f in AMOUNT_FIELDS}
        | {f"{f}_clean": clean_date(_kind(f), _value(f)) for f in DATE_FIELDS}
    )
    parsed = staged.withColumns(
        {
            **{
                f: amount_from_cell(_kind(f), _value(f), F.col(f"{f}_clean"))
                for f in AMOUNT_FIELDS
            },
            **{f: date_from_clean(F.col(f"{f}_clean")) for f in DATE_FIELDS},
        }
    )

    def unreadable(field: str) -> Column:
        return F.when(_value(field).isNotNull() & F.col(field).isNull(), F.lit(field))

    bad_field = F.coalesce(*[unreadable(f) for f in (*AMOUNT_FIELDS, *DATE_FIELDS)])
    judged = parsed.withColumn(
        "bad_field", F.when(F.col("sheet_reason").isNull(), bad_field)
    ).withColumn("accepted", F.col("sheet_reason").isNull() & F.col("bad_field").isNull())
    # A fence for the optimizer, not a count that anything reads: the split into accepted and
    # rejected rows stays above it. Pushed below the projections, its condition would parse every
    # value again.
    judged = judged.observe(
        f"normalize-{uuid.uuid4()}",
        F.count(F.lit(1)).alias("rows_read"),
        F.count_if(F.col("accepted")).alias("rows_ok"),
    )

    at = F.array_position(F.array(*[F.lit(f) for f in CANONICAL_FIELDS]), F.col("bad_field")) - 1
    bad_value = F.get("values", at.cast("int"))
    shown = F.when(
        F.get("field_kinds", at.cast("int")) == NUMBER, number_repr(bad_value)
    ).otherwise(python_repr(bad_value))
    reason = F.coalesce(
        "sheet_reason",
        F.concat(F.lit("could not parse "), "bad_field", F.lit(" from "), shown),
    )
    original = _labelled_json(F.col("labels"), F.col("kinds"), F.col("cells"))
    fields = {f: _value(f) for f in CANONICAL_FIELDS}
    fields |= {f"{f}_raw": _value(f) for f in RAW_KEPT}
    fields |= {f: F.col(f) for f in (*AMOUNT_FIELDS, *DATE_FIELDS)}
    fields |= {f: id_from_cell(_kind(f), _value(f)) for f in ID_FIELDS}
    fields["capture_id"] = hash_id(F.col("key"))
    fields |= {f: F.col(f) for f in ("period", "sheet", "source_row")}
    return judged.select(
        "key",
        *[fields[c].alias(c) for c in STAGING.columns],
        F.when(~F.col("accepted"), reason).alias("reject_reason"),
        F.when(~F.col("accepted"), original).alias("raw_row"),
        "accepted",
    )


def accepted(normalized: DataFrame) -> DataFrame:
    """The staging table."""
    return STAGING.project(normalized.filter("accepted"))


def unreadable_rejects(errors: DataFrame) -> DataFrame:
    """Exactly one reject per unreadable file or sheet of ``errors(key, sheet, error)``."""
    what = F.when(F.col("sheet").isNull(), FILE_UNREADABLE).otherwise(SHEET_UNREADABLE)
    return REJECT.project(
        errors.select(
            "key",
            period_from_key(F.col("key")).alias("period"),
            F.coalesce("sheet", F.lit(UNKNOWN_SHEET)).alias("sheet"),
            F.lit(None).cast("bigint").alias("source_row"),
            F.concat(what, F.lit(": "), F.col("error")).alias("reason"),
            F.lit(None).cast("string").alias("raw_row"),
        )
    )


def rejected(normalized: DataFrame, errors: DataFrame | None = None) -> DataFrame:
    """The reject table, unreadable input included when ``errors`` is given."""
    rows = REJECT.project(
        normalized.filter("NOT accepted").withColumn("reason", F.col("reject_reason"))
    )
    return rows if errors is None else rows.unionByName(unreadable_rejects(errors))


def reconcile(
    rows: DataFrame,
    errors: DataFrame,
    staging: DataFrame,
    rejects: DataFrame,
    columns: DataFrame | None = None,
) -> DataFrame:
    """Per key: rows read, accepted, rejected, and a message where they do not add up.

    Rows read are counted at the source, apart from the other two. Each count is reduced on the
    map side before the counts of a key are added up.
    """
    columns = sheet_columns(rows) if columns is None else columns
    read = data_rows(rows, columns).select("key").unionByName(errors.select("key"))
    none = F.lit(0).cast("bigint")
    n = F.count(F.lit(1))

    def tally(counted: DataFrame, column: str) -> DataFrame:
        return counted.select(
            "capture_id",
            "key",
            *[
                (F.col("n") if c == column else none).alias(c)
                for c in ("rows_read", "rows_ok", "rows_rejected")
            ],
        )

    with_id = hash_id(F.col("key")).alias("capture_id")
    tallies = (
        tally(read.groupBy("key").agg(n.alias("n")).select("*", with_id), "rows_read")
        .unionByName(
            tally(
                staging.groupBy("capture_id")
                .agg(n.alias("n"))
                .withColumn("key", F.lit(None).cast("string")),
                "rows_ok",
            )
        )
        .unionByName(
            tally(rejects.groupBy("key").agg(n.alias("n")).select("*", with_id), "rows_rejected")
        )
    )
    message = F.concat(
        F.col("rows_ok").cast("string"),
        F.lit(" ok + "),
        F.col("rows_rejected").cast("string"),
        F.lit(" rejected != "),
        F.col("rows_read").cast("string"),
        F.lit(" read"),
    )
    return (
        tallies.groupBy("capture_id")
        .agg(
            F.max("key").alias("key"),
            *[F.sum(c).alias(c) for c in ("rows_read", "rows_ok", "rows_rejected")],
        )
        .withColumn(
            "error",
            F.when(F.col("rows_ok") + F.col("rows_rejected") != F.col("rows_read"), message),
        )
    )


def reconciliation_total(checked: DataFrame) -> DataFrame:
    """One row: files, rows read, accepted and rejected over all of them, and files in error."""
    total = lambda c: F.coalesce(F.sum(c), F.lit(0).cast("bigint")).alias(c)
    return checked.agg(
        F.count(F.lit(1)).alias("files"),
        *[total(c) for c in ("rows_read", "rows_ok", "rows_rejected")],
        F.count("error").alias("files_in_error"),
    )
