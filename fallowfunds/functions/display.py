"""Presentation of amounts and classes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Labels shown to readers.
TYPE_LABELS = {"legal_entity": "Persona jurídica", "natural_person": "Persona natural"}
UNCLASSIFIED_LABEL = "Sin clasificar"


def format_cop(amount: Column) -> Column:
    """Whole pesos with dots between thousands: ``$ 84.500.000``."""
    return F.concat(F.lit("$ "), F.translate(F.format_number(amount, 0), ",", "."))


def document_type_label(document_type: Column) -> Column:
    """Label of a document type; unknown types pass through."""
    label = F.lit(None).cast("string")
    for code, text in TYPE_LABELS.items():
        label = F.when(document_type == code, F.lit(text)).otherwise(label)
    return F.coalesce(label, document_type, F.lit(UNCLASSIFIED_LABEL))
