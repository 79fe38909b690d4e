"""Parsers for the text and number cells of a published list.

A cell has a ``kind``, which belongs to its whole column: the same digits mean
different things in a number column (121378.75 rounds to 121379) and in a text
column (the decimals are cut, 121378). Whatever cannot be read gives NULL; the
caller turns NULL from a non-NULL cell into a reject.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Cell kinds.
TEXT = "text"
NUMBER = "number"
DATETIME = "datetime"
BOOL = "bool"

# What counts as white space at the ends of a cell.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Accepted shapes. Year 0 is no calendar year.
HANDWRITTEN_CENTS = r"(?U)[.,]+\s*[oO]{2}\s*$"
CURRENCY_SHAPE = r"^-?[0-9][0-9.,]*$"
ISO_PREFIX = r"^(?!0000)[0-9]{4}-[0-9]{2}-[0-9]{2}"
DAY_MONTH_YEAR = r"^[0-9]{1,2}/[0-9]{1,2}/(?!0000)[0-9]{4}$"
COMPACT_DATE = r"^(?!0000)[0-9]{8}$"
PERIOD_IN_KEY = r"/([0-9]{4}-[0-9])/"


def strip(text: Column) -> Column:
    """Drop white space, non-breaking space included, from both ends."""
    return F.btrim(text, F.lit(WHITESPACE))


def period_from_key(key: Column, on_missing: str = "raise") -> Column:
    """The ``yyyy-s`` folder of a raw object's path.

    ``on_missing`` is ``raise`` (fail the job, naming the key) or ``null``.
    """
    period = F.nullif(F.regexp_extract(key, PERIOD_IN_KEY, 1), F.lit(""))
    if on_missing == "null":
        return period
    failure = F.raise_error(F.concat(F.lit("no period in key: "), key)).cast("string")
    return F.when(key.isNull(), F.lit(None)).otherwise(F.coalesce(period, failure))


def period_code(period: Column) -> Column:
    """A ``yyyy-s`` period as the integer yyyys, which orders alike.

    Minimum and maximum of an integer aggregate in a hash table; of a text they need a sort.
    """
    shaped = (F.length(period) == 6) & (F.substring(period, 5, 1) == "-")
    failure = F.raise_error(F.concat(F.lit("not a period: "), period)).cast("int")
    code = F.translate(period, "-", "").cast("int")
    return F.when(shaped, code).when(period.isNotNull(), failure)


def period_of_code(code: Column) -> Column:
    """Inverse of :func:`period_code`."""
    text = code.cast("string")
    return F.concat(F.left(text, F.lit(4)), F.lit("-"), F.right(text, F.lit(1)))


def clean_currency(text: Column) -> Column:
    """First half of :func:`parse_currency`: drop the sign and spaces, mend handwritten cents.

    Kept apart so that a plan can stage it as its own column and have it evaluated once.
    """
    plain = strip(F.translate(strip(F.translate(text, "\xa0", " ")), "$", ""))
    mended = F.when(
        F.contains(F.lower(plain), F.lit("oo")), F.regexp_replace(plain, HANDWRITTEN_CENTS, ",00")
    ).otherwise(plain)
    return F.translate(mended, " ", "")


def currency_from_clean(clean: Column) -> Column:
    """Second half of :func:`parse_currency`: decide what the last separator means."""
    dotted = F.translate(clean, ",-", ".")
    digits = F.translate(clean, ",.-", "")
    separators = F.length(dotted) - F.length(digits)
    trailing = F.length(F.substring_index(dotted, ".", -1))
    whole = digits.try_cast("bigint")
    magnitude = (
        F.when(separators == 0, whole)
        .when(trailing == 2, F.left(digits, F.length(digits) - 2).try_cast("bigint"))
        .when(trailing == 3, whole)
        .when(
            (separators == 1) & F.contains(clean, F.lit(".")),
            F.rint(dotted.try_cast("double")).try_cast("bigint"),
        )
    )
    signed = F.when(F.startswith(clean, F.lit("-")), -magnitude).otherwise(magnitude)
    return F.when(clean.rlike(CURRENCY_SHAPE), signed)


def parse_currency(text: Column) -> Column:
    """Peso amount in text to whole pesos; cents are cut."""
    return currency_from_clean(clean_currency(text))


def round_number(text: Column) -> Column:
    """Number cell to whole pesos, halves to even."""
    return F.rint(text.try_cast("double")).try_cast("bigint")


def amount_from_cell(kind: Column, text: Column, clean: Column | None = None) -> Column:
    """Amount of a cell of any kind. ``clean`` may carry a staged :func:`clean_currency`."""
    from_text = parse_currency(text) if clean is None else currency_from_clean(clean)
    return (
        F.when(kind == NUMBER, round_number(text))
        .when(kind == BOOL, F.lit(None).cast("bigint"))
        .otherwise(from_text)
    )


def clean_date(kind: Column, text: Column) -> Column:
    """First half of :func:`date_from_cell`: a number cut to its integer digits, a text stripped.

    Kept apart for the same reason as :func:`clean_currency`.
    """
    return (
        F.when(kind == NUMBER, text.try_cast("double").try_cast("bigint").cast("string"))
        .when(kind == BOOL, F.lit(None).cast("string"))
        .otherwise(strip(text))
    )


def date_from_clean(clean: Column) -> Column:
    """Second half: ISO prefix, d/m/yyyy or yyyyMMdd. A day not in the calendar gives NULL.

    An integer can only have the third shape, so the kind does not matter any more.
    """
    day = F.substring_index(clean, "/", 1)
    month = F.substring_index(F.substring_index(clean, "/", 2), "/", -1)
    year = F.substring_index(clean, "/", -1)
    iso = (
        F.when(clean.rlike(ISO_PREFIX), F.left(clean, F.lit(10)))
        .when(
            clean.rlike(DAY_MONTH_YEAR),
            F.concat_ws("-", year, F.lpad(month, 2, "0"), F.lpad(day, 2, "0")),
        )
        .when(
            clean.rlike(COMPACT_DATE),
            F.concat_ws(
                "-", F.substring(clean, 1, 4), F.substring(clean, 5, 2), F.substring(clean, 7, 2)
            ),
        )
    )
    return iso.try_cast("date")


def parse_date(text: Column) -> Column:
    """Date in text to a date."""
    return date_from_clean(strip(text))


def date_from_cell(kind: Column, text: Column) -> Column:
    """Date of a cell of any kind; a number is cut to an integer and read as yyyyMMdd."""
    return date_from_clean(clean_date(kind, text))


def normalize_digits(text: Column) -> Column:
    return F.nullif(F.regexp_replace(text, "[^0-9]", ""), F.lit(""))


def _shifted(text: Column) -> Column:
    """A number with a positive exponent, of any size, written out by moving its decimal point."""
    pattern = r"^(-?)([0-9]+)(?:\.([0-9]+))?[eE][+]?([0-9]{1,3})$"
    sign, whole, part = (F.regexp_extract(text, pattern, i) for i in (1, 2, 3))
    zeros = F.regexp_extract(text, pattern, 4).try_cast("int") - F.length(part)
    digits = F.regexp_replace(F.concat(whole, part, F.repeat(F.lit("0"), zeros)), "^0+(?=.)", "")
    return F.when(zeros >= 0, F.concat(sign, digits))


def number_text(text: Column) -> Column:
    """A number cell's text as kept: no exponent, and no ``.0`` on an integral value."""
    expanded = F.coalesce(
        F.regexp_replace(text.try_cast("decimal(38,10)").cast("string"), r"\.?0+$", ""),
        text.try_cast("decimal(38,0)").cast("string"),
        _shifted(text),
        text,
    )
    exponent = F.contains(text, F.lit("E")) | F.contains(text, F.lit("e"))
    return F.when(exponent, expanded).otherwise(
        F.regexp_replace(text, r"\.0+$", "")
    )


def number_repr(shown: Column) -> Column:
    """A number as reject reasons show it: an integral one with ``.0``. Takes the stringified cell."""
    return F.when(shown.rlike(r"^-?[0-9]{1,16}$"), F.concat(shown, F.lit(".0"))).otherwise(shown)


def stringify_cell(kind: Column, text: Column) -> Column:
    """Text of a cell as kept in the ``_raw`` and pass-through columns."""
    return F.when(kind == NUMBER, number_text(text)).otherwise(text)


def id_from_cell(kind: Column, text: Column) -> Column:
    """Digits of an id cell; a number is cut to an integer first. Takes the stringified cell."""
    readable = (
        F.when(kind == NUMBER, F.substring_index(text, ".", 1))
        .when(kind == BOOL, F.lit(None).cast("string"))
        .otherwise(text)
    )
    return normalize_digits(readable)


def python_repr(text: Column) -> Column:
    """Text in quotes as reject reasons show it: single quotes unless the text holds only those."""
    escaped = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    has_single = F.contains(text, F.lit("'"))
    has_double = F.contains(text, F.lit('"'))
    in_double = F.concat(F.lit('"'), escaped, F.lit('"'))
    in_single = F.concat(F.lit("'"), F.replace(escaped, F.lit("'"), F.lit("\\'")), F.lit("'"))
    return F.when(has_single & ~has_double, in_double).otherwise(in_single)
