"""Parties and courts: one row per real-world entity, with a deterministic id."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fallowfunds.functions.identifiers import (
    canonical_court_account,
    canonical_document_number,
    hash_id,
)
from fallowfunds.functions.parsing import period_code, period_of_code
from fallowfunds.functions.registry import LEGAL_ENTITY, NATURAL_PERSON
from fallowfunds.operators.combine import one_row

# Fixed value: name of the registry whose answers classify parties.
REGISTRY = "RUES"

COURT_ATTRIBUTES = ("seccional", "department", "city", "judicial_district")


def _document_numbers(staging: DataFrame) -> DataFrame:
    """Every raw id of either side, from a single scan."""
    return staging.select(
        F.explode(F.array("plaintiff_id", "defendant_id")).alias("document_number_raw")
    ).filter("document_number_raw IS NOT NULL")


def resolve_document_numbers(staging: DataFrame) -> DataFrame:
    """Distinct raw ids with their canonical number and party id.

    Distinct comes first (its map side shrinks mass creditors to one row per task), so the hash
    is paid once per id and not once per row.
    """
    return (
        _document_numbers(staging)
        .distinct()
        .withColumn("document_number", canonical_document_number(F.col("document_number_raw")))
        .withColumn("party_id", hash_id(F.col("document_number")))
    )


def build_parties(staging: DataFrame) -> DataFrame:
    """One row per canonical document number, not classified yet."""
    return (
        _document_numbers(staging)
        .select(canonical_document_number(F.col("document_number_raw")).alias("document_number"))
        .distinct()
        .select(
            hash_id(F.col("document_number")).alias("party_id"),
            "document_number",
            F.lit(None).cast("string").alias("document_type"),
            F.lit(None).cast("double").alias("document_type_confidence"),
            F.lit(None).cast("string").alias("document_type_rule_id"),
        )
    )


def latest_classification(enrichment: DataFrame, source: str = REGISTRY) -> DataFrame:
    """The newest attempt of each party that gave a class. Equal times are ordered by content."""
    newest_first = Window.partitionBy("party_id").orderBy(
        F.desc("queried_at"),
        F.desc("document_type"),
        F.desc("document_type_confidence"),
        F.desc("document_type_rule_id"),
    )
    return (
        enrichment.filter((F.col("source") == source) & F.col("document_type").isNotNull())
        .withColumn("nth", F.row_number().over(newest_first))
        .filter("nth = 1")
        .select(
            "party_id", "document_type", "document_type_confidence", "document_type_rule_id"
        )
    )


def apply_classification(parties: DataFrame, classification: DataFrame) -> DataFrame:
    """Fill the class columns of parties from the registry's answers, column by column."""
    columns = ("document_type", "document_type_confidence", "document_type_rule_id")
    found = classification.select("party_id", *[F.col(c).alias(f"found_{c}") for c in columns])
    return parties.join(found, "party_id", "left").select(
        "party_id",
        "document_number",
        *[F.coalesce(f"found_{c}", c).alias(c) for c in columns],
    )


def with_court_account(staging: DataFrame, *columns: str | Column) -> DataFrame:
    """Rows whose account is usable, with the account in canonical form."""
    return (
        staging.filter("court_account IS NOT NULL")
        .select(canonical_court_account(F.col("court_account")).alias("court_account"), *columns)
        .filter("court_account IS NOT NULL")
    )


def build_courts(staging: DataFrame) -> DataFrame:
    """One row per account with its most frequent attributes; the lowest value wins a tie.

    Three aggregations of shrinking size: rows to distinct attribute combinations, those to
    (account, attribute, value) counts, those to one row per account. All combine on the map
    side, and none holds a court's values in one buffer, so a court with a third of all rows
    costs no more than any other.
    """
    combinations = (
        with_court_account(staging, *COURT_ATTRIBUTES)
        .groupBy("court_account", *COURT_ATTRIBUTES)
        .agg(F.count(F.lit(1)).alias("n"))
    )
    # The row count rides along as one more "attribute" with a NULL value.
    tagged = F.array(
        *[
            F.struct(F.lit(i).alias("slot"), F.col(c).alias("value"))
            for i, c in enumerate(COURT_ATTRIBUTES)
        ],
        F.struct(F.lit(-1).alias("slot"), F.lit(None).cast("string").alias("value")),
    )
    votes = (
        combinations.select("court_account", "n", F.explode(tagged).alias("t"))
        .select("court_account", "n", "t.slot", "t.value")
        .filter("slot = -1 OR value IS NOT NULL")
        .groupBy("court_account", "slot", "value")
        .agg(F.sum("n").alias("n"))
    )

    def winner(slot: int) -> Column:
        # min over (-votes, value): most votes first, then the lowest value.
        ballot = F.when(F.col("slot") == slot, F.struct((-F.col("n")).alias("rank"), "value"))
        return F.min(ballot)["value"]

    return votes.groupBy("court_account").agg(
        *[winner(i).alias(c) for i, c in enumerate(COURT_ATTRIBUTES)],
        F.sum(F.when(F.col("slot") == -1, F.col("n"))).alias("row_count"),
    ).select(
        hash_id(F.col("court_account")).alias("court_id"),
        "court_account",
        *COURT_ATTRIBUTES,
        "row_count",
    )


def build_court_names(staging: DataFrame) -> DataFrame:
    """Every name an account was published under, with the periods it spans."""
    return (
        with_court_account(
            staging.filter("court_name IS NOT NULL"),
            F.col("court_name").alias("name"),
            period_code(F.col("period")).alias("code"),
        )
        .groupBy("court_account", "name")
        .agg(
            period_of_code(F.min("code")).alias("first_period"),
            period_of_code(F.max("code")).alias("last_period"),
            F.count(F.lit(1)).alias("row_count"),
        )
        .select(
            hash_id(F.col("court_account")).alias("court_id"),
            "court_account",
            "name",
            "first_period",
            "last_period",
            "row_count",
        )
    )


def identity_summary(parties: DataFrame, courts: DataFrame, staging: DataFrame) -> DataFrame:
    """One row: parties by class, courts, and staging rows that carry no account at all."""
    by_class = parties.agg(
        F.count(F.lit(1)).alias("parties"),
        F.count_if(F.col("document_type") == LEGAL_ENTITY).alias("legal_entities"),
        F.count_if(F.col("document_type") == NATURAL_PERSON).alias("natural_persons"),
    ).withColumn(
        "unclassified", F.col("parties") - F.col("legal_entities") - F.col("natural_persons")
    )
    court_count = courts.agg(F.count(F.lit(1)).alias("courts"))
    no_account = staging.agg(
        F.count_if(F.col("court_account").isNull()).alias("rows_without_account")
    )
    return one_row(by_class, court_count, no_account)
