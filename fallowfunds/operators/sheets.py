"""From sheet cells to rows with named, typed columns; schema-drift profiles.

Input is ``rows(key, sheet, row_idx, cells array<struct<kind,text>>)``, one row per sheet row and
a cell per column position, NULL where blank. Everything that concerns a whole sheet (header,
names, column kinds) is worked out once per sheet and joined on; a data row is never rebuilt
from single cells.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fallowfunds.functions.parsing import BOOL, DATETIME, NUMBER, TEXT, stringify_cell

# Rows searched for the header, and the name of a column without one.
HEADER_SCAN_ROWS = 25
UNNAMED = "__UNNAMED__"
READ_ERROR = "<READ_ERROR>"
UNKNOWN_SHEET = "<unknown>"

# Column types as profiles name them.
DTYPE_OF_KIND = {
    TEXT: "String",
    NUMBER: "Float64",
    DATETIME: "Datetime(time_unit='ms', time_zone=None)",
    BOOL: "Boolean",
}

SHEET = ["key", "sheet"]
_KIND_BIT = {TEXT: 1, NUMBER: 2, DATETIME: 4, BOOL: 8}


def rows_from_cells(cells: DataFrame) -> DataFrame:
    """Rows from the long form ``cells(key, sheet, row_idx, col_idx, kind, text)``.

    A group is one sheet row, bounded by the columns a sheet can have.
    """
    by_position = F.map_from_entries(
        F.collect_list(F.struct("col_idx", F.struct("kind", "text")))
    )
    return (
        cells.groupBy(*SHEET, "row_idx")
        .agg(by_position.alias("at"), F.max("col_idx").alias("last"))
        .select(
            *SHEET,
            "row_idx",
            F.transform(F.sequence(F.lit(0), "last"), lambda i: F.col("at")[i]).alias("cells"),
        )
    )


def _texts(cells: Column) -> Column:
    return F.transform(cells, lambda c: c["text"])


def detect_header_row(rows: DataFrame, max_rows: int = HEADER_SCAN_ROWS) -> DataFrame:
    """(key, sheet, header_row, header): the first of the rows that name the most columns."""
    named = F.size(F.filter(F.col("cells"), lambda c: c["text"].isNotNull() & (c["text"] != "")))
    return (
        rows.filter(F.col("row_idx") < max_rows)
        .select(
            *SHEET,
            F.struct(
                (-named).alias("unnamed"), "row_idx", _texts(F.col("cells")).alias("header")
            ).alias("choice"),
        )
        .groupBy(*SHEET)
        .agg(F.min("choice").alias("best"))
        .select(*SHEET, F.col("best.row_idx").alias("header_row"), "best.header")
    )


def _column_kinds(rows: DataFrame, headers: DataFrame, max_rows: int) -> DataFrame:
    """(key, sheet, pos, kind) over the data rows.

    Rows past the header window are data whatever the header is, so the join touches only the
    first rows of each sheet. The kinds seen are or-ed as bits, which combines on the map side.
    """
    late = rows.filter(F.col("row_idx") >= max_rows).select(*SHEET, "cells")
    early = (
        rows.filter(F.col("row_idx") < max_rows)
        .join(headers.select(*SHEET, "header_row"), SHEET)
        .filter("row_idx > header_row")
        .select(*SHEET, "cells")
    )
    bit = F.lit(_KIND_BIT[TEXT])
    for kind, value in _KIND_BIT.items():
        bit = F.when(F.col("cell.kind") == kind, F.lit(value)).otherwise(bit)
    seen = (
        late.unionByName(early)
        .select(*SHEET, F.posexplode("cells").alias("pos", "cell"))
        .filter("cell.text IS NOT NULL")
        .groupBy(*SHEET, "pos")
        .agg(F.bit_or(bit).alias("bits"))
    )
    only = F.lit(TEXT)
    for kind, value in _KIND_BIT.items():
        only = F.when(F.col("bits") == value, F.lit(kind)).otherwise(only)
    return seen.select(*SHEET, "pos", only.alias("kind"))


def _unique_names(names: Column) -> Column:
    """Repeated names get the first free suffix ``_1``, ``_2``, ..."""

    def take(taken: Column, name: Column) -> Column:
        suffixed = F.transform(
            F.sequence(F.lit(1), F.size(taken) + 1),
            lambda i: F.concat(name, F.lit("_"), i.cast("string")),
        )
        free = F.filter(suffixed, lambda s: ~F.array_contains(taken, s))
        return F.array_append(
            taken, F.when(F.array_contains(taken, name), free[0]).otherwise(name)
        )

    return F.aggregate(names, F.array().cast("array<string>"), take)


def sheet_columns(rows: DataFrame, max_rows: int = HEADER_SCAN_ROWS) -> DataFrame:
    """(key, sheet, header_row, names, kinds): the columns of every sheet, by position.

    A name is taken verbatim; a blank one becomes ``__UNNAMED__<position>``. A column is of a
    kind only if all its cells are, else it is text.
    """
    headers = detect_header_row(rows, max_rows)
    kinds = (
        _column_kinds(rows, headers, max_rows)
        .groupBy(*SHEET)
        .agg(
            F.map_from_entries(F.collect_list(F.struct("pos", "kind"))).alias("kind_at"),
            F.max("pos").alias("last"),
        )
    )
    # A sheet that starts below the header window has columns, but no names for them.
    header = F.coalesce("header", F.array().cast("array<string>"))
    width = F.greatest(F.size(header), F.coalesce(F.col("last") + 1, F.lit(0)))
    positions = F.when(width > 0, F.sequence(F.lit(0), width - 1)).otherwise(
        F.array().cast("array<int>")
    )

    def name(i: Column) -> Column:
        text = F.get(header, i)
        return F.when(
            text.isNull() | (text == ""), F.concat(F.lit(UNNAMED), i.cast("string"))
        ).otherwise(text)

    return headers.join(kinds, SHEET, "full_outer").select(
        *SHEET,
        F.coalesce("header_row", F.lit(0)).alias("header_row"),
        _unique_names(F.transform(positions, name)).alias("names"),
        F.transform(
            positions, lambda i: F.coalesce(F.try_element_at("kind_at", i), F.lit(TEXT))
        ).alias("kinds"),
    )


def data_rows(rows: DataFrame, columns: DataFrame) -> DataFrame:
    """The rows below the header with their 0-based number and their sheet's columns.

    Pass ``columns`` as a stored table: its size is then known when the join is planned, and the
    rows are not shuffled unless it is too large to broadcast. Beyond that, adaptive execution
    splits oversized sheets. Only a sheet of blank rows has no columns; it keeps its rows.
    """
    start = F.coalesce(F.col("header_row"), F.lit(0))
    return (
        rows.join(columns, SHEET, "left")
        .filter(F.col("row_idx") > start)
        .withColumn("source_row", (F.col("row_idx") - start - 1).cast("bigint"))
        .drop("row_idx", "header_row")
    )


def assemble_rows(rows: DataFrame, columns: DataFrame | None = None) -> DataFrame:
    """(key, sheet, source_row, cells map<name, struct<kind,text>>), the kind being the column's."""
    named = data_rows(rows, sheet_columns(rows) if columns is None else columns)
    cell = F.transform(
        F.sequence(F.lit(0), F.size("names") - 1),
        lambda i: F.struct(
            F.col("kinds")[i].alias("kind"), F.get("cells", i)["text"].alias("text")
        ),
    )
    return named.select(
        *SHEET, "source_row", F.map_from_arrays("names", cell).alias("cells")
    )


def profile_columns(rows: DataFrame, columns: DataFrame | None = None) -> DataFrame:
    """Per column: position, type, share of blanks (4 decimals) and exact distinct values.

    A blank counts as one distinct value. Values are first reduced to distinct ones on the map
    side, keyed by value, so neither a long column nor a frequent value lands in one task.
    """
    columns = sheet_columns(rows) if columns is None else columns
    # One pass: every row also has a cell that stands for the row itself, at a place of its own.
    cells = F.concat(F.array(F.lit(None).cast("struct<kind:string,text:string>")), F.col("cells"))
    kind = F.get("kinds", F.col("pos") - 1)
    value = F.when(
        kind == NUMBER, F.col("cell.text").try_cast("double").cast("string")
    ).otherwise(stringify_cell(F.col("cell.kind"), F.col("cell.text")))
    counts = (
        data_rows(rows, columns)
        .select(*SHEET, "kinds", F.posexplode(cells).alias("pos", "cell"))
        .filter("pos = 0 OR cell.text IS NOT NULL")
        .select(*SHEET, "pos", value.alias("value"))
        .groupBy(*SHEET, "pos", "value")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy(*SHEET, "pos")
        .agg(F.sum("n").alias("present"), F.count(F.lit(1)).alias("distinct"))
        # As many entries as a sheet has columns.
        .groupBy(*SHEET)
        .agg(F.map_from_entries(F.collect_list(F.struct("pos", F.struct("present", "distinct")))).alias("at"))
    )
    dtype = F.lit(None).cast("string")
    for code, label in DTYPE_OF_KIND.items():
        dtype = F.when(F.col("c.kinds") == code, F.lit(label)).otherwise(dtype)
    described = (
        columns.join(counts, SHEET, "left")
        .select(*SHEET, "at", F.posexplode(F.arrays_zip("names", "kinds")).alias("pos", "c"))
        .withColumns(
            {
                "height": F.try_element_at("at", F.lit(0))["present"],
                "present": F.try_element_at("at", F.col("pos") + 1)["present"],
                "distinct": F.try_element_at("at", F.col("pos") + 1)["distinct"],
            }
        )
    )
    height = F.coalesce("height", F.lit(0).cast("bigint"))
    blank = height - F.coalesce("present", F.lit(0).cast("bigint"))
    return (
        described.select(
            F.col("key").alias("file"),
            "sheet",
            F.col("c.names").alias("column"),
            F.col("pos").cast("bigint").alias("position"),
            dtype.alias("dtype"),
            F.round(F.when(height > 0, blank / height).otherwise(0.0), 4).alias("null_rate"),
            (
                F.coalesce("distinct", F.lit(0).cast("bigint"))
                + F.when(blank > 0, 1).otherwise(0)
            ).alias("distinct_count"),
        )
    )


def profile_read_errors(errors: DataFrame) -> DataFrame:
    """One profile row per unreadable file or sheet of ``errors(key, sheet, error)``."""
    return errors.select(
        F.col("key").alias("file"),
        F.coalesce("sheet", F.lit(UNKNOWN_SHEET)).alias("sheet"),
        F.lit(READ_ERROR).alias("column"),
        F.lit(-1).cast("bigint").alias("position"),
        F.col("error").alias("dtype"),
        F.lit(0.0).alias("null_rate"),
        F.lit(0).cast("bigint").alias("distinct_count"),
    )


def profile(
    rows: DataFrame, errors: DataFrame, columns: DataFrame | None = None
) -> DataFrame:
    """Profile of every readable column, and a row for whatever could not be read."""
    return profile_columns(rows, columns).unionByName(profile_read_errors(errors))


def schema_matrix(profiles: DataFrame, period: Column, periods: Sequence[str]) -> DataFrame:
    """Column by period: the types a column name had, ``|`` between several, NULL when absent.

    ``periods`` are the columns to make. A profile of any other period fails the query.
    """
    other = F.concat(F.lit("period not listed: "), F.coalesce(F.col("period"), F.lit("NULL")))
    listed = F.when(F.col("period").isin(list(periods)), F.col("period")).otherwise(
        F.raise_error(other).cast("string")
    )
    return (
        profiles.withColumn("period", period)
        .withColumn("period", listed)
        .groupBy("column")
        .pivot("period", list(periods))
        .agg(F.concat_ws("|", F.array_sort(F.collect_set("dtype"))))
    )
