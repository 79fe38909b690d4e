"""Every operator as a query over the driver's tables."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType

from checks import driver_tables as d
from fallowfunds import contracts
from fallowfunds import functions as fn
from fallowfunds.mappings import pinned_mapping
from fallowfunds.operators import (
    enrichment,
    identity,
    lifecycle,
    lineage,
    normalize,
    search,
    sheets,
)
from fallowfunds.sources import builds, history, reading, writing
from fallowfunds.sources.scratch import Buckets, dropped, scratch_dir, staged, written

AS_OF = dt.date(1999, 6, 30)
RUN_AT = dt.datetime(2026, 1, 15, 12, 0, 0)
BATCH = 100
# Claim rows in a bucket, which one task reads and whose claims it hashes.
CLAIM_BUCKET_ROWS = 500_000

ROW = ["o", "p", "s", "n", "source_row"]


# --- scalars ------------------------------------------------------------------------------


def period_from_key(spark: SparkSession, sf: str) -> DataFrame:
    return d.published(spark, sf).select(
        *ROW, "key", fn.period_from_key(F.col("key")).alias("found_period")
    )


def hash_ids(spark: SparkSession, sf: str) -> DataFrame:
    return d.published(spark, sf).select(*ROW, fn.hash_id(F.col("key")).alias("file_id"))


def parse_currency(spark: SparkSession, sf: str) -> DataFrame:
    text = d.printed(spark, sf).withColumn("text", F.expr(d.AMOUNT_TEXT))
    staged = text.withColumn("clean", fn.clean_currency(F.col("text")))
    return staged.select(*ROW, fn.currency_from_clean(F.col("clean")).alias("amount"))


def parse_currency_numeric(spark: SparkSession, sf: str) -> DataFrame:
    text = d.printed(spark, sf).withColumn("text", F.expr(d.AMOUNT_NUMBER))
    return text.select(
        *ROW,
        fn.amount_from_cell(F.lit("number"), F.col("text")).alias("amount"),
        fn.amount_from_cell(F.lit("bool"), F.col("text")).alias("amount_of_bool"),
    )


def parse_date(spark: SparkSession, sf: str) -> DataFrame:
    text = d.printed(spark, sf).withColumn("text", F.expr(d.DATE_TEXT))
    number = F.expr("concat(date_format(d, 'yyyyMMdd'), '.0')")
    return text.select(
        *ROW,
        fn.parse_date(F.col("text")).alias("text_date"),
        fn.date_from_cell(F.lit("number"), number).alias("number_date"),
    )


def normalize_id(spark: SparkSession, sf: str) -> DataFrame:
    text = F.expr("if(p % 13 = 0, 'Desconocido', concat('D-', o, '.', n, ' x'))")
    number = F.expr("cast(cast(58092000000 + o AS double) AS string)")
    return d.published(spark, sf).select(
        *ROW,
        fn.normalize_id(text).alias("text_id"),
        fn.id_from_cell(F.lit("number"), fn.stringify_cell(F.lit("number"), number)).alias(
            "number_id"
        ),
    )


def stringify_values(spark: SparkSession, sf: str) -> DataFrame:
    number = F.expr(
        "CASE p % 4 WHEN 0 THEN cast(cast(58092000000 + o AS double) AS string) "
        "WHEN 1 THEN concat(o, '.0') WHEN 2 THEN concat(o, '.25') "
        "ELSE concat('1.', lpad(o, 9, '0'), 'E', 40 + n) END"
    )
    return d.published(spark, sf).select(
        *ROW, fn.stringify_cell(F.lit("number"), number).alias("shown")
    )


def nit_check_digit(spark: SparkSession, sf: str) -> DataFrame:
    return d.published(spark, sf).select(
        *ROW, fn.check_digit(F.expr("cast(900000000 + p * 7919 + s AS string)")).alias("digit")
    )


def canonical_document_number(spark: SparkSession, sf: str) -> DataFrame:
    staged = d.staging(spark, sf)
    return staged.select(
        "capture_id",
        "sheet",
        "source_row",
        fn.canonical_document_number(F.col("plaintiff_id")).alias("plaintiff"),
        fn.canonical_document_number(F.col("defendant_id")).alias("defendant"),
    )


def canonical_court_account(spark: SparkSession, sf: str) -> DataFrame:
    return d.staging(spark, sf).select(
        "capture_id",
        "sheet",
        "source_row",
        fn.canonical_court_account(F.col("court_account")).alias("account"),
    )


def claim_ids(spark: SparkSession, sf: str) -> DataFrame:
    account, deposit = F.col("court_account"), F.col("deposit_no")
    return d.staging(spark, sf).select(
        "capture_id",
        "sheet",
        "source_row",
        fn.claim_key(account, deposit).alias("claim_key"),
        fn.claim_id(account, deposit).alias("claim_id"),
    )


def claim_attributes(spark: SparkSession, sf: str) -> DataFrame:
    return d.staging(spark, sf).select(
        "capture_id",
        "sheet",
        "source_row",
        lifecycle.claim_attributes(F.col("classification"), F.col("source_extra")).alias("json"),
    )


def classify_category(spark: SparkSession, sf: str) -> DataFrame:
    category = F.expr(
        "CASE c_custkey % 7 WHEN 0 THEN 'Persona Natural' WHEN 1 THEN 'PERSONA JURÍDICA NACIONAL' "
        "WHEN 2 THEN concat('establecimiento ', c_mktsegment) WHEN 3 THEN 'persona juridica' "
        "WHEN 4 THEN 'jurídica y natural' WHEN 5 THEN 'Náturál' END"
    )
    return d.table(spark, sf, "customer").select(
        "c_custkey", fn.classify_category(category).alias("reading")
    ).select("c_custkey", "reading.document_type", "reading.confidence", "reading.rule_id")


def lookup_candidates(spark: SparkSession, sf: str) -> DataFrame:
    return (
        _parties(spark, sf)
        .select(
            "document_number",
            F.posexplode(fn.lookup_candidates(F.col("document_number"))).alias("pos", "nit"),
        )
    )


def format_cop(spark: SparkSession, sf: str) -> DataFrame:
    return d.published(spark, sf).select(
        *ROW, fn.format_cop(F.expr("(cents - 5000000) * 37")).alias("shown")
    )


def document_type_label(spark: SparkSession, sf: str) -> DataFrame:
    history = d.enrichment_history(spark, sf)
    code = F.coalesce("document_type", F.when(F.col("source") == "OTHER", F.col("status")))
    return history.groupBy(fn.document_type_label(code).alias("label")).agg(
        F.count(F.lit(1)).alias("attempts")
    )


# --- sources and contracts ----------------------------------------------------------------


def enrichment_union_by_name(spark: SparkSession, sf: str) -> DataFrame:
    """Batches of three ages: the oldest without status, the next without a class."""
    history = d.enrichment_history(spark, sf)
    old = "source = 'OTHER' OR status IS NULL"
    oldest = history.filter(old).select("party_id", "source", "queried_at", "result")
    older = history.filter(f"NOT ({old}) AND status = 'error'").select(
        "status", "party_id", "source", "queried_at", "result", "name", "active"
    )
    newest = history.filter(f"NOT ({old}) AND status <> 'error'")
    return enrichment.union_batches(oldest, older, newest).select(
        "party_id", "source", "queried_at", "result", "name", "active", "status", "document_type"
    )


def contract_violations(spark: SparkSession, sf: str) -> DataFrame:
    """Rule breaks in the attempt history, whose old batches lack a status."""
    return contracts.violations(d.enrichment_history(spark, sf), contracts.ENRICHMENT)


# --- raw sheets ---------------------------------------------------------------------------


def detect_header_row(spark: SparkSession, sf: str) -> DataFrame:
    return sheets.detect_header_row(d.raw_rows(spark, sf)).select("key", "sheet", "header_row")


def _columns(spark: SparkSession, sf: str) -> DataFrame:
    """Columns of sheets, hashed where rows meet them: both are in buckets of sheets, so no row is moved or sorted."""
    return d.sheet_columns(spark, sf).hint("shuffle_hash")


def assemble_rows(spark: SparkSession, sf: str) -> DataFrame:
    rows = sheets.assemble_rows(d.raw_rows(spark, sf), _columns(spark, sf))
    return rows.select(
        "key", "sheet", "source_row", F.explode("cells").alias("column", "cell")
    ).select(
        "key", "sheet", "source_row", "column",
        F.col("cell.kind").alias("kind"), F.col("cell.text").alias("text"),
    )


def profile_columns(spark: SparkSession, sf: str) -> DataFrame:
    return sheets.profile_columns(d.raw_rows(spark, sf), _columns(spark, sf))


def profile_read_errors(spark: SparkSession, sf: str) -> DataFrame:
    return sheets.profile_read_errors(d.raw_errors(spark, sf))


def schema_matrix(spark: SparkSession, sf: str) -> DataFrame:
    profiles = sheets.profile_columns(d.raw_rows(spark, sf), _columns(spark, sf))
    return sheets.schema_matrix(profiles, fn.period_from_key(F.col("file")), d.PERIODS)


def mapping_outcome(spark: SparkSession, sf: str) -> DataFrame:
    present = d.published(spark, sf).select("key", "sheet").distinct()
    return normalize.mapping_outcome(present, pinned_mapping(spark)).select(
        "key", "sheet", "period", "outcome", "skip_reason"
    )


def project_canonical(spark: SparkSession, sf: str) -> DataFrame:
    rows = normalize.project_canonical(
        d.raw_rows(spark, sf), pinned_mapping(spark), d.sheet_columns(spark, sf)
    )
    return rows.select("key", "sheet", "source_row", *normalize.CANONICAL_FIELDS)


def _normalized(spark: SparkSession, sf: str) -> DataFrame:
    return normalize.normalize(
        d.raw_rows(spark, sf), pinned_mapping(spark), d.sheet_columns(spark, sf)
    )


def normalize_ok(spark: SparkSession, sf: str) -> DataFrame:
    return normalize.accepted(_normalized(spark, sf))


def normalize_rejects(spark: SparkSession, sf: str) -> DataFrame:
    return normalize.rejected(_normalized(spark, sf)).filter(
        F.startswith(F.col("reason"), F.lit("could not parse"))
    )


def sheet_rejects(spark: SparkSession, sf: str) -> DataFrame:
    return normalize.rejected(_normalized(spark, sf)).filter(
        ~F.startswith(F.col("reason"), F.lit("could not parse"))
    )


def unreadable_rejects(spark: SparkSession, sf: str) -> DataFrame:
    return normalize.unreadable_rejects(d.raw_errors(spark, sf))


def _stored_normalized(spark: SparkSession, sf: str) -> DataFrame:
    """The judged rows as the job stores them: both outcomes in one table."""
    return staged(spark, "normalized", sf, lambda: _normalized(spark, sf))


def reconciliation(spark: SparkSession, sf: str) -> DataFrame:
    rows, errors = d.raw_rows(spark, sf), d.raw_errors(spark, sf)
    normalized = _stored_normalized(spark, sf)
    return normalize.reconcile(
        rows, errors, normalize.accepted(normalized), normalize.rejected(normalized, errors),
        _columns(spark, sf),
    )


def reconciliation_total(spark: SparkSession, sf: str) -> DataFrame:
    return normalize.reconciliation_total(reconciliation(spark, sf))


# --- lineage ------------------------------------------------------------------------------


def build_files(spark: SparkSession, sf: str) -> DataFrame:
    return lineage.build_files(d.objects(spark, sf), "s3://bucket/")


def build_captures(spark: SparkSession, sf: str) -> DataFrame:
    errors = d.raw_errors(spark, sf)
    normalized = _stored_normalized(spark, sf)
    keys = (
        d.objects(spark, sf).select("key")
        .unionByName(errors.select("key").distinct())
        .unionByName(
            # Objects nothing was read from.
            d.table(spark, sf, "nation").selectExpr(
                "concat('raw/deposits/2024-1/empty-', n_nationkey, '.xlsx') AS key"
            )
        )
    )
    return lineage.build_captures(
        keys, normalize.accepted(normalized), normalize.rejected(normalized, errors), RUN_AT
    )


def capture_status(spark: SparkSession, sf: str) -> DataFrame:
    return lineage.capture_status(build_captures(spark, sf))


# --- identity -----------------------------------------------------------------------------


def _parties(spark: SparkSession, sf: str) -> DataFrame:
    return identity.build_parties(d.staging(spark, sf))


def resolve_document_numbers(spark: SparkSession, sf: str) -> DataFrame:
    return identity.resolve_document_numbers(d.staging(spark, sf))


def build_parties(spark: SparkSession, sf: str) -> DataFrame:
    return _parties(spark, sf)


def latest_classification(spark: SparkSession, sf: str) -> DataFrame:
    return identity.latest_classification(d.enrichment_history(spark, sf))


def apply_classification(spark: SparkSession, sf: str) -> DataFrame:
    return identity.apply_classification(_parties(spark, sf), latest_classification(spark, sf))


def build_courts(spark: SparkSession, sf: str) -> DataFrame:
    return identity.build_courts(d.staging(spark, sf))


def build_court_names(spark: SparkSession, sf: str) -> DataFrame:
    return identity.build_court_names(d.staging(spark, sf))


def identity_summary(spark: SparkSession, sf: str) -> DataFrame:
    return identity.identity_summary(
        apply_classification(spark, sf), build_courts(spark, sf), d.staging(spark, sf)
    )


# --- lifecycle ----------------------------------------------------------------------------


def build_claims(spark: SparkSession, sf: str) -> DataFrame:
    return lifecycle.build_claims(d.staging(spark, sf))


def build_observations(spark: SparkSession, sf: str) -> DataFrame:
    return lifecycle.build_observations(d.staging(spark, sf))


def build_claim_parties(spark: SparkSession, sf: str) -> DataFrame:
    return lifecycle.build_claim_parties(d.staging(spark, sf))


def measure_persistence(spark: SparkSession, sf: str) -> DataFrame:
    return lifecycle.measure_persistence(d.staging(spark, sf))


def lifecycle_summary(spark: SparkSession, sf: str) -> DataFrame:
    return lifecycle.lifecycle_summary(
        build_claims(spark, sf), build_observations(spark, sf), build_claim_parties(spark, sf)
    )


def key_collisions(spark: SparkSession, sf: str) -> DataFrame:
    return lifecycle.key_collisions(d.staging(spark, sf))


# --- enrichment ---------------------------------------------------------------------------


def parties_to_enrich(spark: SparkSession, sf: str) -> DataFrame:
    return enrichment.parties_to_enrich(
        _parties(spark, sf), d.enrichment_history(spark, sf), BATCH
    )


def _pending(spark: SparkSession, sf: str) -> DataFrame:
    return enrichment.parties_to_enrich(_parties(spark, sf), d.enrichment_history(spark, sf), None)


def registry_lookup(spark: SparkSession, sf: str) -> DataFrame:
    found = enrichment.lookup_registry(_parties(spark, sf), d.registry(spark, sf))
    return found.select("party_id", "document_number", "matched_nit", "response", "detail", "error")


def enrichment_rows(spark: SparkSession, sf: str) -> DataFrame:
    lookups = enrichment.lookup_registry(_pending(spark, sf), d.registry(spark, sf))
    return enrichment.result_rows(lookups, RUN_AT)


def enrichment_errors(spark: SparkSession, sf: str) -> DataFrame:
    lookups = enrichment.lookup_registry(_pending(spark, sf), d.registry(spark, sf))
    return enrichment.error_rows(lookups, RUN_AT)


def enrichment_summary(spark: SparkSession, sf: str) -> DataFrame:
    return enrichment.enrichment_summary(
        enrichment.enrich(_pending(spark, sf), d.registry(spark, sf), RUN_AT)
    )


# --- search -------------------------------------------------------------------------------


@dataclass
class Core:
    """The core tables searches read."""

    files: DataFrame
    captures: DataFrame
    claims: DataFrame
    observations: DataFrame
    claim_parties: DataFrame
    court_names: DataFrame
    stored_periods: Callable[[], DataFrame]

    @property
    def deposits(self) -> DataFrame:
        """Deposits of all parties. Last periods of claims are stored first, so that finding them leaves nothing
        on disk but them, and lie in the buckets of claims."""
        return self.deposits_of(None, self.stored_periods())

    def deposits_of(self, parties: DataFrame | None, periods: DataFrame | None = None) -> DataFrame:
        return search.party_deposits(
            self.claim_parties, self.claims, self.observations, self.captures, self.files,
            self.court_names, parties, periods,
        )


def _core(spark: SparkSession, sf: str) -> Core:
    """Core tables as the builds store them, each written once by the operator that builds it."""

    def stored(name: str, build: Callable[[SparkSession, str], DataFrame]) -> DataFrame:
        return staged(spark, name, sf, lambda: build(spark, sf))

    files = stored("file", build_files)
    captures = stored("capture", build_captures)
    # What is made of claim rows lies in buckets of claims, as they do: rows are dealt and claim ids made a single
    # time, and neither building these tables nor joining them by claim moves a row.
    buckets = _claim_buckets(spark, sf)

    def of_claims(name: str, build: Callable[[DataFrame], DataFrame]) -> DataFrame:
        return staged(spark, name, sf, lambda: build(_claim_base(spark, sf, buckets)), buckets)

    # Of the tables that meet, claims and their last periods have a row for each key.
    claims = of_claims("claim", lifecycle.build_claims).hint("shuffle_hash")
    observations = of_claims("observation", lifecycle.build_observations)
    links = of_claims("claim_party", lifecycle.build_claim_parties)

    def periods() -> DataFrame:
        found = search.claim_last_period(observations, captures, files)
        return staged(
            spark, "claim_period", sf, lambda: found.repartition(buckets.number, *buckets.keys), buckets
        ).hint("shuffle_hash")

    core = Core(files, captures, claims, observations, links, stored("court_name", build_court_names), periods)
    # Nothing reads the claim rows from here on, and they are as large as the three tables made of them.
    dropped(spark, "claim_rows", sf)
    return core


def _claim_buckets(spark: SparkSession, sf: str) -> Buckets:
    """At least as many as a shuffle has partitions, or joins would deal these tables anew into more."""
    rows = d.staging(spark, sf).count()
    fewest = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return Buckets(("claim_id",), max(fewest, -(-rows // CLAIM_BUCKET_ROWS)))


def _claim_base(spark: SparkSession, sf: str, buckets: Buckets) -> DataFrame:
    """Claim rows as the lifecycle job stores them for all that is built of them, in buckets of claims."""
    return staged(
        spark, "claim_rows", sf,
        lambda: lifecycle.claim_base(d.staging(spark, sf)).drop("court_name").repartition(buckets.number, *buckets.keys),
        buckets,
    )


def _stored_parties(spark: SparkSession, sf: str) -> DataFrame:
    return staged(spark, "party", sf, lambda: apply_classification(spark, sf))


def find_party(spark: SparkSession, sf: str) -> DataFrame:
    return search.find_party(d.search_requests(spark, sf), _stored_parties(spark, sf))


def latest_enrichment(spark: SparkSession, sf: str) -> DataFrame:
    return search.latest_enrichment(d.enrichment_history(spark, sf))


def claim_last_period(spark: SparkSession, sf: str) -> DataFrame:
    core = _core(spark, sf)
    return search.claim_last_period(core.observations, core.captures, core.files)


def current_court_name(spark: SparkSession, sf: str) -> DataFrame:
    return search.current_court_name(_core(spark, sf).court_names)


def party_deposits(spark: SparkSession, sf: str) -> DataFrame:
    return _core(spark, sf).deposits


def party_summary(spark: SparkSession, sf: str) -> DataFrame:
    return search.party_summary(_core(spark, sf).deposits)


def party_period_summary(spark: SparkSession, sf: str) -> DataFrame:
    return search.party_period_summary(_core(spark, sf).deposits)


def corpus_stats(spark: SparkSession, sf: str) -> DataFrame:
    core = _core(spark, sf)
    return search.corpus_stats(
        core.files,
        core.observations,
        staged(spark, "court", sf, lambda: build_courts(spark, sf)),
        _stored_parties(spark, sf),
        core.claims,
    )


def claim_status(spark: SparkSession, sf: str) -> DataFrame:
    return search.claim_status(
        party_summary(spark, sf), d.claim_windows(spark, sf), AS_OF
    ).select("party_id", "last_period", "closes_on", "claim_status")


def party_currency(spark: SparkSession, sf: str) -> DataFrame:
    core = _core(spark, sf)
    return search.party_currency(search.party_summary(core.deposits), core.files).select(
        "party_id", "last_period", "corpus_latest_period", "is_current_publication"
    )


def party_search(spark: SparkSession, sf: str) -> DataFrame:
    core = _core(spark, sf)
    requests, parties = d.search_requests(spark, sf), _stored_parties(spark, sf)
    matched = written(spark, "matched", search.find_party(requests, parties))
    return search.search_parties(
        matched,
        core.deposits_of(matched.filter("party_id IS NOT NULL").select("party_id").distinct()),
        d.enrichment_history(spark, sf),
        core.files,
        d.claim_windows(spark, sf),
        AS_OF,
    ).select(
        "raw_value", "found", "document_number", "document_type", "party_name", "rues_active",
        "deposit_count", "total_amount_cop", "court_office_count", "last_period",
        "plaintiff_count", "defendant_count", "last_period_deposit_count",
        "last_period_amount_cop", "claim_status", "is_current_publication",
    )


def raw_to_party_summary(spark: SparkSession, sf: str) -> DataFrame:
    """From sheet cells to party totals: all steps computed, the accepted rows stored between."""
    staging = normalize.accepted(_stored_normalized(spark, sf))
    files = lineage.build_files(d.objects(spark, sf))
    captures = files.select(F.col("file_id").alias("capture_id"), "file_id")
    deposits = search.party_deposits(
        lifecycle.build_claim_parties(staging),
        lifecycle.build_claims(staging),
        lifecycle.build_observations(staging),
        captures,
        files,
        identity.build_court_names(staging),
    )
    return search.party_summary(deposits)


# --- written, written again, read back ----------------------------------------------------


def _root(spark: SparkSession) -> str:
    return f"{scratch_dir(spark)}/round-trip-{uuid.uuid4().hex}"


def staging_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    root, judged, errors = _root(spark), _stored_normalized(spark, sf), d.raw_errors(spark, sf)
    for _ in range(2):
        writing.write_normalized(judged, errors, root)
    return reading.read_staging(spark, root)


def core_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    root = _root(spark)
    for _ in range(2):
        writing.write_core(_stored_parties(spark, sf), contracts.PARTY, root)
    return reading.read_core(spark, root, contracts.PARTY)


def core_tables_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """All eight core tables, each built twice under one root; a digest of every row read back."""
    root, core = _root(spark), _core(spark, sf)
    tables = {
        contracts.FILE: core.files,
        contracts.CAPTURE: core.captures,
        contracts.PARTY: _stored_parties(spark, sf),
        contracts.COURT: staged(spark, "court", sf, lambda: build_courts(spark, sf)),
        contracts.COURT_NAME: core.court_names,
        contracts.CLAIM: core.claims,
        contracts.OBSERVATION: core.observations,
        contracts.CLAIM_PARTY: core.claim_parties,
    }
    back = []
    for contract, frame in tables.items():
        for _ in range(2):
            writing.write_core(frame, contract, root)
        rows = reading.read_core(spark, root, contract)
        shown = [
            F.coalesce(
                F.date_format(f.name, "yyyy-MM-dd HH:mm:ss") if isinstance(f.type, TimestampNTZType)
                else F.col(f.name).cast("string"),
                F.lit("~"),
            )
            for f in contract.fields
        ]
        back.append(rows.select(F.lit(contract.name).alias("table"), F.sha2(F.concat_ws("|", *shown), 256).alias("row_sha256")))
    return reduce(DataFrame.unionByName, back)


def staging_versions(spark: SparkSession, sf: str) -> DataFrame:
    """Accepted rows per period after three publications: all captures, then the even years' without
    their first sheet rows, then the last year's captures emptied; and after the first one alone."""
    root, judged = _root(spark), _stored_normalized(spark, sf)
    none = d.raw_errors(spark, sf).filter("false")
    even = judged.filter("cast(left(period, 4) AS int) % 2 = 0")
    writing.write_normalized(judged, none, root)
    writing.write_normalized(
        even.filter("source_row % 3 > 0"), none, root, even.select("key").distinct()
    )
    last = judged.filter("period >= '2023-1'")
    writing.write_normalized(last.filter("false"), none, root, last.select("key").distinct())
    counts = [
        reading.read_staging(spark, root, builds.version(spark, root, number))
        .groupBy("period").agg(F.count(F.lit(1)).alias("n"), F.sum("amount_cop").alias("total"))
        .select(F.lit(number).cast("bigint").alias("version"), "period", "n", "total")
        for number in (1, 3)
    ]
    return counts[0].unionByName(counts[1])


def read_objects(spark: SparkSession, sf: str) -> DataFrame:
    """One object for each order day and priority, listed and hashed as raw publications are."""
    root = _root(spark)
    lines = d.table(spark, sf, "orders").selectExpr(
        "concat(year(o_orderdate) + 22, '-', if(month(o_orderdate) <= 6, 1, 2)) AS period",
        "left(o_orderpriority, 1) AS list",
        "concat_ws(',', o_orderkey, o_custkey, o_orderstatus) AS value",
    )
    folders = ["period", "list"]
    (
        lines.repartition(*folders).sortWithinPartitions(*folders, "value")
        .write.partitionBy(*folders).text(f"{root}/raw")
    )
    found = reading.read_objects(spark, f"{root}/raw", root)
    # Spark names its files itself; its marker of success is a hidden, empty object.
    return found.filter("content_hash IS NOT NULL").select(
        F.regexp_extract("key", "(raw/.*)/", 1).alias("folder"), "length", "content_hash"
    )


def enrichment_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """Every pending party's attempt, the batch appended twice under one id."""
    root = _root(spark)
    batch = written(
        spark, "batch", enrichment.enrich(_pending(spark, sf), d.registry(spark, sf), RUN_AT)
    )
    for _ in range(2):
        writing.append_enrichment(batch, root, writing.batch_id(RUN_AT))
    return reading.read_enrichment(spark, root)


def history_by_party(spark: SparkSession, sf: str) -> DataFrame:
    """The newest class of each party from a history laid out by party: three batches, of which one came
    after the copy was made and one, copied without its classes, was replaced since."""
    root = _root(spark)
    attempts = d.enrichment_history(spark, sf).withColumn("third", F.pmod(F.xxhash64("party_id", "queried_at"), F.lit(3)))

    def append(third: int, frame: DataFrame) -> None:
        writing.append_enrichment(frame.filter(F.col("third") == third).drop("third"), root, f"batch-{third}")

    append(0, attempts)
    append(1, attempts.withColumn("document_type", F.lit(None).cast("string")))
    history.compact(spark, root)
    append(1, attempts)
    append(2, attempts)
    return identity.latest_classification(reading.read_enrichment(spark, root))


def profile_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    path = f"{_root(spark)}/profile"
    writing.write_profile(profile_columns(spark, sf), path)
    return reading.read_profile(spark, path)


ALL: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        period_from_key, hash_ids, parse_currency, parse_currency_numeric, parse_date,
        normalize_id, stringify_values, nit_check_digit, canonical_document_number,
        canonical_court_account, claim_ids, claim_attributes, classify_category,
        lookup_candidates, format_cop, document_type_label,
        enrichment_union_by_name, contract_violations,
        detect_header_row, assemble_rows, profile_columns, profile_read_errors, schema_matrix,
        mapping_outcome, project_canonical, normalize_ok, normalize_rejects, sheet_rejects,
        unreadable_rejects, reconciliation, reconciliation_total,
        build_files, build_captures, capture_status,
        resolve_document_numbers, build_parties, latest_classification, apply_classification,
        build_courts, build_court_names, identity_summary,
        build_claims, build_observations, build_claim_parties, measure_persistence,
        lifecycle_summary, key_collisions,
        parties_to_enrich, registry_lookup, enrichment_rows, enrichment_errors,
        enrichment_summary,
        find_party, latest_enrichment, claim_last_period, current_court_name, party_deposits,
        party_summary, party_period_summary, corpus_stats, claim_status, party_currency,
        party_search, raw_to_party_summary,
        staging_round_trip, staging_versions, core_round_trip, core_tables_round_trip,
        enrichment_round_trip, read_objects, history_by_party, profile_round_trip,
    )
}
