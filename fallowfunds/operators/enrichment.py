"""Parties against a snapshot of registry answers, recorded as a dated batch of attempts.

The snapshot ``registry(nit bigint, response string, detail string, error string)`` holds, per
number, the registry's search answer (JSON with a list ``registros``), the detail answer for its
first record, or the error either of the two ran into.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fallowfunds.contracts import ENRICHMENT
from fallowfunds.functions.identifiers import lookup_candidates
from fallowfunds.functions.parsing import strip
from fallowfunds.functions.registry import (
    LEGAL_ENTITY,
    NATURAL_PERSON,
    RULE_NOT_FOUND,
    classify_category,
)
from fallowfunds.operators.identity import REGISTRY

# Keys of a registry answer, the active state, and the answer without records.
RECORDS_KEY = '"registros"'
FIRST_RECORD = "$.registros[0]"
NAME_KEY = "razon_social"
STATE_KEY = "estado_matricula"
CATEGORY_KEY = "categoria"
DETAIL_KEY = "detail"
ACTIVE_STATE = "ACTIVA"
NO_RECORDS = '{"registros":[]}'
MALFORMED_ANSWER = "ValueError: the answer is no JSON object"
MALFORMED_DETAIL = "ValueError: the detail is no JSON"


def answered_parties(enrichment: DataFrame, source: str = REGISTRY) -> DataFrame:
    """Parties with a real answer. Old batches have no status: there the answer's shape tells."""
    answered = F.col("status").isin("found", "not_found") | (
        F.col("status").isNull() & F.contains(F.col("result"), F.lit(RECORDS_KEY))
    )
    return enrichment.filter((F.col("source") == source) & answered).select("party_id").distinct()


def parties_to_enrich(
    parties: DataFrame, enrichment: DataFrame, limit: int | None, source: str = REGISTRY
) -> DataFrame:
    """The next parties without an answer, by party id. Failed attempts do not count as answers.

    ``limit`` is the size of the batch to look up; None takes every pending party.
    """
    pending = (
        parties.select("party_id", "document_number")
        .join(answered_parties(enrichment, source), "party_id", "left_anti")
    )
    return pending if limit is None else pending.orderBy("party_id").limit(limit)


def read_answers(registry: DataFrame) -> DataFrame:
    """Registry rows with ``record`` (the first one, if any) and ``error``.

    What the registry gave back is an error as well if it is no JSON object, or if the detail of its
    record is no JSON: such a party has no answer and is asked again.
    """
    response = strip(F.col("response"))
    broken = response.isNotNull() & (
        ~F.startswith(response, F.lit("{")) | F.try_parse_json("response").isNull()
    )
    read = registry.withColumn("record", F.get_json_object("response", FIRST_RECORD))
    no_detail = F.col("record").isNotNull() & F.col("detail").isNotNull() & F.try_parse_json("detail").isNull()
    return read.withColumn(
        "error",
        F.coalesce("error", F.when(broken, MALFORMED_ANSWER), F.when(no_detail, MALFORMED_DETAIL)),
    )


def lookup_registry(targets: DataFrame, registry: DataFrame) -> DataFrame:
    """The decisive registry answer of each target: the first candidate with a record or an error.

    Without one it is the answer to the last candidate the snapshot holds, kept as it is. ``response``
    and ``error`` are NULL for a target of which the snapshot knows nothing. Candidates are weighed
    as numbers alone; the answers, which are wide, are joined once to the chosen ones.
    """
    tries = targets.select(
        "party_id",
        F.posexplode(lookup_candidates(F.col("document_number"))).alias("pos", "nit"),
    )
    answers = read_answers(registry.withColumn("nit", F.col("nit").cast("string")))
    decided = F.col("error").isNotNull() | F.col("record").isNotNull()
    choice = F.struct(
        (~F.col("decided")).alias("undecided"),
        F.when(F.col("decided"), F.col("pos")).otherwise(-F.col("pos")).alias("order"),
        "nit",
    )
    chosen = (
        tries.join(answers.select("nit", decided.alias("decided")), "nit")
        .groupBy("party_id")
        .agg(F.min(choice).alias("choice"))
        .select("party_id", F.col("choice.nit").alias("nit"))
    )
    found = chosen.join(answers.select("nit", "response", "record", "detail", "error"), "nit")
    return targets.join(found, "party_id", "left").select(
        "party_id",
        "document_number",
        F.when(F.col("record").isNotNull() | F.col("error").isNotNull(), F.col("nit")).alias("matched_nit"),
        "response",
        "record",
        "detail",
        "error",
    )


def attempt_rows(
    lookups: DataFrame, queried_at: Column | dt.datetime, source: str = REGISTRY
) -> DataFrame:
    """One attempt row per lookup, in a single pass: found, not found, or failed.

    An answer without records gives no class: absence is no evidence. A failure gives nothing
    but its reason.
    """
    stamp = queried_at if isinstance(queried_at, Column) else F.lit(queried_at)
    failed = F.col("error").isNotNull()
    found = F.col("record").isNotNull()
    opened = lookups.withColumn("record", F.when(~failed, F.col("record"))).withColumn(
        "fields", F.from_json("record", "map<string,variant>")
    )

    def field(key: str) -> Column:
        return F.element_at("fields", F.lit(key)).cast("string")

    rest = F.map_filter("fields", lambda k, _: ~k.isin(NAME_KEY, STATE_KEY))
    detail = F.try_parse_json("detail")
    attributes = F.when(detail.isNull(), rest).otherwise(
        F.map_concat(
            F.map_filter(rest, lambda k, _: k != DETAIL_KEY),
            F.create_map(F.lit(DETAIL_KEY), detail),
        )
    )
    active = F.coalesce(F.upper(strip(field(STATE_KEY))) == ACTIVE_STATE, F.lit(False))
    classed = opened.withColumn("category", field(CATEGORY_KEY)).withColumn(
        "reading", classify_category(F.col("category"))
    )
    return ENRICHMENT.project(
        classed.select(
            "party_id",
            F.lit(source).alias("source"),
            stamp.alias("queried_at"),
            F.when(failed, F.to_json(F.struct("error")))
            .otherwise(F.coalesce("response", F.lit(NO_RECORDS)))
            .alias("result"),
            field(NAME_KEY).alias("name"),
            F.when(found, active).alias("active"),
            F.when(found, F.to_json(attributes)).alias("attributes"),
            F.when(failed, "error").when(found, "found").otherwise("not_found").alias("status"),
            F.col("category").alias("categoria"),
            F.col("reading.document_type").alias("document_type"),
            F.col("reading.confidence").alias("document_type_confidence"),
            F.when(found, F.col("reading.rule_id"))
            .when(~failed, RULE_NOT_FOUND)
            .alias("document_type_rule_id"),
        )
    )


def result_rows(
    lookups: DataFrame, queried_at: Column | dt.datetime, source: str = REGISTRY
) -> DataFrame:
    """Attempt rows of the lookups that got an answer."""
    return attempt_rows(lookups.filter("error IS NULL"), queried_at, source)


def error_rows(
    lookups: DataFrame, queried_at: Column | dt.datetime, source: str = REGISTRY
) -> DataFrame:
    """Attempt rows of the lookups that failed."""
    return attempt_rows(lookups.filter("error IS NOT NULL"), queried_at, source)


def enrich(
    targets: DataFrame,
    registry: DataFrame,
    queried_at: Column | dt.datetime,
    source: str = REGISTRY,
) -> DataFrame:
    """The batch of attempts for the targets, one row each."""
    return attempt_rows(lookup_registry(targets, registry), queried_at, source)


def union_batches(*batches: DataFrame) -> DataFrame:
    """Batches of different ages as one history: columns by name, absent ones as typed NULLs."""
    aligned = []
    for batch in batches:
        present = set(batch.columns)
        aligned.append(
            batch.select(
                *[
                    (F.col(f.name) if f.name in present else F.lit(None)).cast(f.type).alias(f.name)
                    for f in ENRICHMENT.fields
                ]
            )
        )
    history = aligned[0]
    for batch in aligned[1:]:
        history = history.unionByName(batch)
    return history


def enrichment_summary(batch: DataFrame) -> DataFrame:
    """One row: attempts, those that gave a name, the rest, and parties by class."""
    found = F.count_if(F.col("name").isNotNull())
    return batch.agg(
        F.count(F.lit(1)).alias("queried"),
        found.alias("found"),
        (F.count(F.lit(1)) - found).alias("not_found_or_error"),
        F.count_if(F.col("document_type") == LEGAL_ENTITY).alias("legal_entities"),
        F.count_if(F.col("document_type") == NATURAL_PERSON).alias("natural_persons"),
    )
