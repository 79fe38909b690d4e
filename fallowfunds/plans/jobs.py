"""The pipeline's steps, each from stored tables to stored tables.

``root`` holds ``normalized``, ``core`` and ``enrichment``. Raw sheets come decoded, see
``sources.reading``.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from fallowfunds import contracts as c
from fallowfunds.mappings import pinned_mapping
from fallowfunds.operators import enrichment, identity, lifecycle, lineage, normalize, search, sheets
from fallowfunds.sources import builds, history, lookup, reading, writing
from fallowfunds.sources.scratch import written


LISTED = 20  # files that an error names


class ReconciliationError(RuntimeError):
    """Rows read and rows kept do not add up."""


def _columns(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """The columns of every sheet, stored for this run, as each step joins the rows with them."""
    return written(spark, "sheet_columns", sheets.sheet_columns(rows))


def profile_publications(
    spark: SparkSession, raw_rows: str, out: str, raw_errors: str | None = None
) -> None:
    """Profile every column of every sheet into a CSV."""
    rows = reading.read_raw_rows(spark, raw_rows)
    errors = reading.read_raw_errors(spark, raw_errors)
    writing.write_profile(sheets.profile(rows, errors, _columns(spark, rows)), out)


def normalize_publications(
    spark: SparkSession,
    raw_rows: str,
    root: str,
    raw_errors: str | None = None,
    mapping: DataFrame | None = None,
) -> DataFrame:
    """Sheets to staging and rejects; fails if any file does not reconcile.

    Rows are judged into a build of their own, checked and reconciled there, and published only then,
    without being written again. A failed run changes nothing that readers see. Returns the
    reconciliation per file; ``normalize.reconciliation_total`` sums it up.
    """
    rows = reading.read_raw_rows(spark, raw_rows)
    errors = reading.read_raw_errors(spark, raw_errors)
    columns = _columns(spark, rows)
    normalized = normalize.normalize(
        rows, pinned_mapping(spark) if mapping is None else mapping, columns
    )
    counts = Observation(f"build-{uuid.uuid4().hex}")
    build = writing.write_build(normalized, errors, root, counts)
    judged = builds.read(spark, root, build).withColumnRenamed("reason", "reject_reason")
    accepted = normalize.accepted(judged)
    c.validate(accepted, c.STAGING)
    checked = normalize.reconcile(rows, errors, accepted, normalize.rejected(judged), columns)
    wrong = checked.filter("error IS NOT NULL").select("key", "error").orderBy("key")
    first = wrong.limit(LISTED).collect()
    if first:
        said = "; ".join(f"{r['key']}: {r['error']}" for r in first)
        more = wrong.count() - len(first)
        raise ReconciliationError(f"{said}; and {more} more" if more else said)
    # A third count, of what the writing job put into files, against what is read back from them.
    total = normalize.reconciliation_total(checked).first()
    for name, n in counts.get.items():
        if n != total[name]:
            raise ReconciliationError(f"{name}: {n} written, {total[name]} read back")
    present = rows.select("key").unionByName(errors.select("key")).distinct()
    builds.publish(spark, root, build, writing.captures_of(present))
    return checked


def build_lineage(
    spark: SparkSession, objects: DataFrame, root: str, uri_prefix: str = ""
) -> DataFrame:
    """File and capture tables from ``objects(key, content_hash, modified_at)``.

    Returns captures per status.
    """
    at = builds.version(spark, root)
    staging, rejects = reading.read_staging(spark, root, at), reading.read_rejects(spark, root, at)
    captures = lineage.build_captures(
        objects.select("key"), staging, rejects, dt.datetime.now(dt.UTC).replace(tzinfo=None)
    )
    writing.write_core(lineage.build_files(objects, uri_prefix), c.FILE, root)
    writing.write_core(captures, c.CAPTURE, root)
    return lineage.capture_status(reading.read_core(spark, root, c.CAPTURE))


def build_identity(spark: SparkSession, root: str) -> DataFrame:
    """Party, court and court_name tables; classes come from the attempt history. Returns totals."""
    staging = reading.read_staging(spark, root)
    attempts = reading.read_enrichment(spark, root)
    parties = identity.apply_classification(
        identity.build_parties(staging), identity.latest_classification(attempts)
    )
    writing.write_core(parties, c.PARTY, root)
    writing.write_core(identity.build_courts(staging), c.COURT, root)
    writing.write_core(identity.build_court_names(staging), c.COURT_NAME, root)
    return identity.identity_summary(
        reading.read_core(spark, root, c.PARTY), reading.read_core(spark, root, c.COURT), staging
    )


def build_lifecycle(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    """Claim, observation and claim_party tables. Returns totals and persistence."""
    base = written(spark, "claim_rows", lifecycle.claim_base(reading.read_staging(spark, root)))
    writing.write_core(lifecycle.build_claims(base), c.CLAIM, root)
    writing.write_core(lifecycle.build_observations(base), c.OBSERVATION, root)
    writing.write_core(lifecycle.build_claim_parties(base), c.CLAIM_PARTY, root)
    totals = lifecycle.lifecycle_summary(
        *[reading.read_core(spark, root, t) for t in (c.CLAIM, c.OBSERVATION, c.CLAIM_PARTY)]
    )
    return totals, lifecycle.measure_persistence(base)


def enrich_parties(
    spark: SparkSession, registry: DataFrame, root: str, limit: int = 1000,
    at: dt.datetime | None = None,
) -> DataFrame:
    """Look the next pending parties up in a registry snapshot and append the batch.

    The batch is checked before it joins the history. Returns its totals.
    """
    at = at or dt.datetime.now(dt.UTC).replace(tzinfo=None)
    targets = enrichment.parties_to_enrich(
        reading.read_core(spark, root, c.PARTY), reading.read_enrichment(spark, root), limit
    )
    batch = written(spark, "batch", enrichment.enrich(targets, registry, at))
    c.validate(batch, c.ENRICHMENT)
    writing.append_enrichment(batch, root, writing.batch_id(at))
    return enrichment.enrichment_summary(batch)


def compact_history(spark: SparkSession, root: str) -> str | None:
    """Lay the attempt history out by party, so that classes, newest names and pending parties are found
    without moving it. Later batches count at once; run it again when they have become many."""
    return history.compact(spark, root)


def core_deposits(
    spark: SparkSession, root: str, parties: DataFrame | None = None
) -> DataFrame:
    """Deposits of all parties, or of the given ones only, from the core tables.

    For given parties the bridge is read first, then the claims and observations it names; what cannot
    hold any of them is skipped by statistics and Bloom filters.
    """
    links, claims, observations = (
        reading.read_core(spark, root, t) for t in (c.CLAIM_PARTY, c.CLAIM, c.OBSERVATION)
    )
    if parties is not None:
        links = written(spark, "links", lookup.narrowed(links, "party_id", parties))
        wanted = links.select("claim_id")
        claims = lookup.narrowed(claims, "claim_id", wanted)
        observations = lookup.narrowed(observations, "claim_id", wanted)
    rest = [reading.read_core(spark, root, t) for t in (c.CAPTURE, c.FILE, c.COURT_NAME)]
    return search.party_deposits(links, claims, observations, *rest, parties=parties)


def search_parties(
    spark: SparkSession, requests: DataFrame, windows: DataFrame, root: str, as_of: dt.date
) -> DataFrame:
    """Answer ``requests(raw_value)`` from the core tables; one row for each distinct request."""
    parties = lookup.narrowed(
        reading.read_core(spark, root, c.PARTY), "document_number", search.wanted_numbers(requests)
    )
    matched = written(spark, "matched", search.find_party(requests, parties))
    wanted = matched.filter("party_id IS NOT NULL").select("party_id").distinct()
    return search.search_parties(
        matched,
        core_deposits(spark, root, wanted),
        reading.read_enrichment(spark, root),
        reading.read_core(spark, root, c.FILE),
        windows,
        as_of,
    )


def corpus_stats(spark: SparkSession, root: str) -> DataFrame:
    """Figures about the whole data set."""
    return search.corpus_stats(
        *[
            reading.read_core(spark, root, t)
            for t in (c.FILE, c.OBSERVATION, c.COURT, c.PARTY, c.CLAIM)
        ]
    )
