"""Reading a business-registry record."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Classes and the rules that give them.
LEGAL_ENTITY = "legal_entity"
NATURAL_PERSON = "natural_person"
RULE_CATEGORY = "rues_categoria"
RULE_CATEGORY_MISSING = "rues_categoria_missing"
RULE_CATEGORY_UNRECOGNIZED = "rues_categoria_unrecognized"
RULE_NOT_FOUND = "rues_not_found"


def _mentions(category: Column, word: str) -> Column:
    """Substring test that ignores case and accents."""
    return F.contains(F.collate(category, "UNICODE_CI_AI"), F.collate(F.lit(word), "UNICODE_CI_AI"))


def classify_category(category: Column) -> Column:
    """Struct (document_type, confidence, rule_id) from the registry's own category text."""
    document_type = F.when(_mentions(category, "juridica"), F.lit(LEGAL_ENTITY)).when(
        _mentions(category, "natural"), F.lit(NATURAL_PERSON)
    )
    return F.struct(
        document_type.alias("document_type"),
        F.when(document_type.isNotNull(), F.lit(1.0)).alias("confidence"),
        F.when(category.isNull(), F.lit(RULE_CATEGORY_MISSING))
        .when(document_type.isNotNull(), F.lit(RULE_CATEGORY))
        .otherwise(F.lit(RULE_CATEGORY_UNRECOGNIZED))
        .alias("rule_id"),
    )
