"""Schemas of the published tables and the check that a frame keeps to one."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Version of the staging shape, class codes, states and roles.
SCHEMA_VERSION = "1"
DOCUMENT_TYPES = ("legal_entity", "natural_person")
ROLES = ("plaintiff", "defendant")
ATTEMPT_STATES = ("found", "not_found", "error")
CAPTURE_STATES = ("ok", "reconciliation_mismatch", "read_error")


class ContractViolation(ValueError):
    """A frame does not keep to its contract."""


@dataclass(frozen=True)
class Field:
    name: str
    type: T.DataType
    nullable: bool = False
    at_least: float | None = None
    at_most: float | None = None
    one_of: tuple[str, ...] | None = None

    def rules(self) -> list[tuple[str, Column]]:
        """(rule name, condition under which a row breaks it)."""
        value = F.col(self.name)
        rules = []
        if not self.nullable:
            rules.append((f"{self.name}:not_null", value.isNull()))
        if self.at_least is not None:
            rules.append((f"{self.name}:at_least", value < self.at_least))
        if self.at_most is not None:
            rules.append((f"{self.name}:at_most", value > self.at_most))
        if self.one_of is not None:
            rules.append((f"{self.name}:one_of", ~value.isin(*self.one_of)))
        return rules


@dataclass(frozen=True)
class Contract:
    name: str
    fields: tuple[Field, ...]
    strict: bool = True

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(f.name, f.type) for f in self.fields])

    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.fields]

    def project(self, frame: DataFrame) -> DataFrame:
        """The contract's columns, in its order and types."""
        return frame.select(*[F.col(f.name).cast(f.type).alias(f.name) for f in self.fields])


def _text(name: str, nullable: bool = False, one_of: tuple[str, ...] | None = None) -> Field:
    return Field(name, T.StringType(), nullable, one_of=one_of)


def _long(name: str, nullable: bool = False, at_least: int | None = None) -> Field:
    return Field(name, T.LongType(), nullable, at_least=at_least)


def _optional(*names: str) -> tuple[Field, ...]:
    return tuple(_text(n, nullable=True) for n in names)


_CLASSIFICATION = (
    _text("document_type", nullable=True, one_of=DOCUMENT_TYPES),
    Field("document_type_confidence", T.DoubleType(), True, at_least=0, at_most=1),
    _text("document_type_rule_id", nullable=True),
)

STAGING = Contract(
    "stg_deposit",
    (
        _text("capture_id"),
        _text("period"),
        _text("sheet"),
        _long("source_row", at_least=0),
        *_optional("deposit_no_raw", "deposit_no", "deposit_type", "classification"),
        *_optional("court_account", "court_name"),
        *_optional("plaintiff_id_raw", "plaintiff_id", "plaintiff_id_type", "plaintiff_name"),
        *_optional("defendant_id_raw", "defendant_id", "defendant_id_type", "defendant_name"),
        _text("amount_cop_raw", nullable=True),
        _long("amount_cop", nullable=True),
        _text("origin_date_raw", nullable=True),
        Field("origin_date", T.DateType(), True),
        _text("case_action_date_raw", nullable=True),
        Field("case_action_date", T.DateType(), True),
        *_optional("case_number", "seccional", "department", "city", "judicial_district"),
        _text("source_extra", nullable=True),
    ),
)

REJECT = Contract(
    "stg_reject",
    (
        _text("key"),
        _text("period"),
        _text("sheet"),
        _long("source_row", nullable=True),
        _text("reason"),
        _text("raw_row", nullable=True),
    ),
)

PARTY = Contract("party", (_text("party_id"), _text("document_number"), *_CLASSIFICATION))

COURT = Contract(
    "court",
    (
        _text("court_id"),
        _text("court_account"),
        *_optional("seccional", "department", "city", "judicial_district"),
        _long("row_count", at_least=1),
    ),
)

COURT_NAME = Contract(
    "court_name",
    (
        _text("court_id"),
        _text("court_account"),
        _text("name"),
        _text("first_period"),
        _text("last_period"),
        _long("row_count", at_least=1),
    ),
)

CLAIM = Contract(
    "claim",
    (
        _text("claim_id"),
        _text("type"),
        _text("court_id", nullable=True),
        _text("deposit_no"),
        _text("deposit_type", nullable=True),
        _long("amount_cop", nullable=True),
        Field("origin_date", T.DateType(), True),
        *_optional("case_number", "legal_basis", "claim_route", "attributes"),
    ),
)

OBSERVATION = Contract(
    "observation",
    (_text("capture_id"), _text("sheet"), _long("source_row", at_least=0), _text("claim_id")),
)

CLAIM_PARTY = Contract(
    "claim_party",
    (
        _text("claim_id"),
        _text("party_id"),
        _text("procedural_role", one_of=ROLES),
        _text("attributes", nullable=True),
    ),
)

# Open to further columns, as batches of different ages are read together.
ENRICHMENT = Contract(
    "enrichment",
    (
        _text("party_id"),
        _text("source"),
        Field("queried_at", T.TimestampNTZType()),
        _text("result"),
        _text("name", nullable=True),
        Field("active", T.BooleanType(), True),
        _text("attributes", nullable=True),
        _text("status", one_of=ATTEMPT_STATES),
        _text("categoria", nullable=True),
        *_CLASSIFICATION,
    ),
    strict=False,
)

FILE = Contract(
    "file",
    (
        _text("file_id"),
        _text("source"),
        _text("period"),
        _text("uri"),
        _text("content_hash"),
        Field("detected_at", T.TimestampNTZType()),
    ),
)

CAPTURE = Contract(
    "capture",
    (
        _text("capture_id"),
        _text("file_id"),
        _text("code_version"),
        _text("schema_version"),
        Field("executed_at", T.TimestampNTZType()),
        _long("rows_read", at_least=0),
        _long("rows_ok", at_least=0),
        _long("rows_rejected", at_least=0),
        _text("status", one_of=CAPTURE_STATES),
    ),
)

PROFILE = Contract(
    "profile",
    (
        _text("file"),
        _text("sheet"),
        _text("column"),
        _long("position"),
        _text("dtype"),
        Field("null_rate", T.DoubleType()),
        _long("distinct_count"),
    ),
)


def schema_problems(frame: DataFrame, contract: Contract) -> list[str]:
    """Missing, surplus or mistyped columns. Needs no job."""
    actual = {f.name: f.dataType for f in frame.schema.fields}
    problems = [f"{f.name}: missing" for f in contract.fields if f.name not in actual]
    if contract.strict:
        known = set(contract.columns)
        problems += [f"{name}: unexpected" for name in actual if name not in known]
    problems += [
        f"{f.name}: {actual[f.name].simpleString()} instead of {f.type.simpleString()}"
        for f in contract.fields
        if f.name in actual and actual[f.name] != f.type
    ]
    return problems


def violations(frame: DataFrame, contract: Contract) -> DataFrame:
    """(rule, violations) for every row rule, counted in one pass over only the ruled columns."""
    rules = [rule for field in contract.fields for rule in field.rules()]
    counts = frame.agg(*[F.count_if(broken).alias(rule) for rule, broken in rules])
    pairs = F.array(
        *[F.struct(F.lit(rule).alias("rule"), F.col(f"`{rule}`").alias("n")) for rule, _ in rules]
    )
    return counts.select(F.explode(pairs).alias("p")).select(
        "p.rule", F.col("p.n").alias("violations")
    )


def observed(frame: DataFrame, contract: Contract) -> tuple[DataFrame, Callable[[], None]]:
    """The frame with its rules counted by whatever job reads it to the end, and the check to call
    after that job, which raises where rules are broken. Columns and types are checked at once."""
    problems = schema_problems(frame, contract)
    if problems:
        raise ContractViolation(f"{contract.name}: " + "; ".join(problems))
    rules = [rule for field in contract.fields for rule in field.rules()]
    counts = Observation(f"{contract.name}-{uuid.uuid4().hex}")
    watched = frame.observe(counts, *[F.count_if(broken).alias(rule) for rule, broken in rules])

    def check() -> None:
        found = counts.get
        listed = "; ".join(f"{rule}: {found[rule]} row(s)" for rule in sorted(found) if found[rule])
        if listed:
            raise ContractViolation(f"{contract.name}: {listed}")

    return watched, check


def validate(frame: DataFrame, contract: Contract) -> DataFrame:
    """Return the frame when it keeps to the contract, raise otherwise."""
    problems = schema_problems(frame, contract)
    if problems:
        raise ContractViolation(f"{contract.name}: " + "; ".join(problems))
    rules = [rule for field in contract.fields for rule in field.rules()]
    any_broken = reduce(
        lambda a, b: a | b, (F.coalesce(broken, F.lit(False)) for _, broken in rules)
    )
    # One row per rule at most comes back, never data rows.
    if not frame.filter(any_broken).isEmpty():
        broken = violations(frame, contract).filter("violations > 0").orderBy("rule").collect()
        listed = "; ".join(f"{r['rule']}: {r['violations']} row(s)" for r in broken)
        raise ContractViolation(f"{contract.name}: {listed}")
    return frame
