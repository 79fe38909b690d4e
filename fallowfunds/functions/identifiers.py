"""Deterministic ids and canonical forms of document numbers and court accounts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from fallowfunds.functions.parsing import normalize_digits

# Published mod-11 weights, right to left over the number without its check digit.
CHECK_DIGIT_WEIGHTS = (3, 7, 13, 17, 19, 23, 29, 37, 41, 43, 47, 53, 59, 67, 71)

# The digit for each remainder 0..10 (0 and 1 stand, others are taken from 11).
DIGIT_OF_REMAINDER = "01987654321"

# Shared by every table that carries these keys.
ID_LENGTH = 16
NO_ACCOUNT = "no_court_account"
ACCOUNT_LENGTH = 12


def hash_id(natural_key: Column) -> Column:
    """First 16 hex digits of the SHA-256 of a natural key."""
    return F.substring(F.sha2(natural_key, 256), 1, ID_LENGTH)


def normalize_id(text: Column) -> Column:
    """Digits of an id, NULL when it has none (an unknown party is not party zero)."""
    return normalize_digits(text)


def numeric_check_digit(number: Column, positions: int, skip: int = 0) -> Column:
    """Mod-11 check digit, as text, of a long with at most ``positions`` digits.

    ``skip`` leaves out that many digits at the right. Digits are taken by division and the
    remainder is looked up once, which keeps the generated code small enough to be compiled.
    """

    def digit(i: int) -> Column:
        power = 10 ** (i + skip)
        shifted = number if power == 1 else F.call_function("div", number, F.lit(power))
        return shifted % 10

    total = reduce(
        lambda a, b: a + b, (digit(i) * CHECK_DIGIT_WEIGHTS[i] for i in range(positions))
    )
    return F.substring(F.lit(DIGIT_OF_REMAINDER), (total % 11 + 1).cast("int"), F.lit(1))


def check_digit(base: Column) -> Column:
    """Check digit, as text, of a number that does not carry one yet."""
    positions = len(CHECK_DIGIT_WEIGHTS)
    return numeric_check_digit(F.right(base, F.lit(positions)).try_cast("bigint"), positions)


def canonical_document_number(number: Column) -> Column:
    """Drop the last digit of a 9 or 10 digit number when it is the check digit of the rest."""
    expected = numeric_check_digit(number.try_cast("bigint"), 9, skip=1)
    carries_check = F.length(number).isin(9, 10) & (expected == F.right(number, F.lit(1)))
    return F.when(carries_check, F.left(number, F.length(number) - 1)).otherwise(number)


def canonical_court_account(raw: Column) -> Column:
    """Account digits padded to 12; NULL unless the source gave 11 or 12 of them."""
    digits = F.regexp_replace(raw, "[^0-9]", "")
    usable = F.length(digits).isin(ACCOUNT_LENGTH - 1, ACCOUNT_LENGTH)
    return F.when(usable, F.lpad(digits, ACCOUNT_LENGTH, "0"))


def claim_key(court_account: Column, deposit_no: Column) -> Column:
    """Natural key of a claim; deposits without a usable account share one name space."""
    account = F.coalesce(canonical_court_account(court_account), F.lit(NO_ACCOUNT))
    return F.concat(account, F.lit(":"), deposit_no)


def claim_id(court_account: Column, deposit_no: Column) -> Column:
    return hash_id(claim_key(court_account, deposit_no))


def _with_shorter_form(number: Column, shorter: Column) -> Column:
    both = F.array_distinct(F.array(number, shorter))
    return F.filter(
        F.when(F.length(number).isNull(), F.array().cast("array<string>")).otherwise(both),
        lambda c: c.isNotNull(),
    )


def _last_digit_dropped(number: Column) -> Column:
    return F.when(F.length(number).isin(9, 10), F.left(number, F.length(number) - 1))


def search_candidates(digits: Column) -> Column:
    """Numbers to look a typed value up under, best first, as text."""
    return _with_shorter_form(digits, _last_digit_dropped(digits))


def lookup_candidates(number: Column) -> Column:
    """Numbers to look a party up under in the registry, best first, as digits of any length."""

    def plain(digits: Column) -> Column:
        return F.when(digits.rlike("^[0-9]+$"), F.regexp_replace(digits, "^0+(?=.)", ""))

    both = F.array(plain(number), plain(_last_digit_dropped(number)))
    return F.array_compact(F.array_distinct(both))
