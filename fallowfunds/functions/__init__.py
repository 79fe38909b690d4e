"""Column-to-column functions. Every one is a native Spark expression, so it stays inside codegen."""

from fallowfunds.functions.display import document_type_label, format_cop
from fallowfunds.functions.identifiers import (
    canonical_court_account,
    canonical_document_number,
    check_digit,
    claim_id,
    claim_key,
    hash_id,
    lookup_candidates,
    normalize_id,
    search_candidates,
)
from fallowfunds.functions.parsing import (
    amount_from_cell,
    clean_currency,
    clean_date,
    currency_from_clean,
    date_from_cell,
    date_from_clean,
    id_from_cell,
    parse_currency,
    parse_date,
    period_code,
    period_from_key,
    period_of_code,
    python_repr,
    stringify_cell,
    strip,
)
from fallowfunds.functions.registry import classify_category

__all__ = [
    "amount_from_cell",
    "canonical_court_account",
    "canonical_document_number",
    "check_digit",
    "claim_id",
    "claim_key",
    "classify_category",
    "clean_currency",
    "clean_date",
    "currency_from_clean",
    "date_from_cell",
    "date_from_clean",
    "document_type_label",
    "format_cop",
    "hash_id",
    "id_from_cell",
    "lookup_candidates",
    "normalize_id",
    "parse_currency",
    "parse_date",
    "period_code",
    "period_from_key",
    "period_of_code",
    "python_repr",
    "search_candidates",
    "stringify_cell",
    "strip",
]
