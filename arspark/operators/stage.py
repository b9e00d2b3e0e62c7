"""raw -> staging: parse, typed projection, newest version per key, upsert.

``stage(raw_text, spec)`` is the whole per-entity transform as one lazy plan:

    try_parse_json -> (good, quarantine) -> typed projection -> key NOT NULL
      -> latest_per_key(key, load time, tie-breakers) [-> merge into target]

Rows without a key go to the quarantine instead of being merged (the warehouse
inserted a NULL-key row on every run).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arspark.operators.latest import latest_batch, latest_per_key, latest_snapshot, recent_window
from arspark.operators.sinks import merge_latest
from arspark.operators.spec import EntitySpec
from arspark.sources.raw import parse_raw


@dataclass
class Staged:
    rows: DataFrame        # typed, one row per key (plus _office, lastLoadTime)
    bad_json: DataFrame    # raw text rows that are not JSON
    null_keys: DataFrame   # parsed rows without a key


def project_raw(raw_text: DataFrame, spec: EntitySpec, now=None, hours: int | None = None):
    """Accepts landed text (``RawDataString``) or an already parsed raw table
    (``RawData``); ``now``/``hours`` keep only recent loads (partition pruning
    on a raw table partitioned by load time)."""
    if now is not None and hours:
        raw_text = recent_window(raw_text, now, hours)
    if "RawData" not in raw_text.columns:
        good, bad = parse_raw(raw_text)
    else:
        good, bad = raw_text, raw_text.limit(0)
    typed = spec.project(good)
    has_key = None
    for k in spec.keys:
        c = F.col(k).isNotNull()
        has_key = c if has_key is None else has_key & c
    return typed.filter(has_key), bad, typed.filter(~has_key)


def stage(raw_text: DataFrame, spec: EntitySpec, target: DataFrame | None = None, now=None,
          hours: int | None = None) -> Staged:
    """Typed newest-version rows of one entity. With ``target`` the result is
    the merged table (newest of target and batch per key). ``now``/``hours``
    restrict the batch to recent loads (incremental run)."""
    typed, bad, nulls = project_raw(raw_text, spec, now, hours)
    latest = latest_per_key(typed, spec.keys, "lastLoadTime", spec.tie_breakers)
    if target is not None:
        latest = merge_latest(target, latest, spec.keys, "lastLoadTime", spec.tie_breakers)
    return Staged(latest, bad, nulls)


def stage_dimension(raw_text: DataFrame, spec: EntitySpec, as_written: bool = False) -> DataFrame:
    """Dimension refresh. Default: newest version per key. ``as_written``:
    only the rows of the single newest load, DISTINCT (drops offices loaded
    at another instant - kept for parity with the original job)."""
    typed, _, _ = project_raw(raw_text, spec)
    if as_written:
        scalar = [c for c in typed.columns if c not in ("lastLoadTime", "_office")]
        return latest_snapshot(typed, "lastLoadTime").select(*scalar).dropDuplicates()
    return latest_per_key(typed, spec.keys, "lastLoadTime", spec.tie_breakers)


def cancellation_reasons_from_raw(raw_customers: DataFrame, spec: EntitySpec, reasons: DataFrame) -> DataFrame:
    """(office, customer, reason) from each office's newest customer batch:
    explode the reason-id array (non-empty only), describe via the reason
    dimension (broadcast: a fixed lookup), unknown ids labelled, DISTINCT."""
    typed, _, _ = project_raw(raw_customers, spec)
    newest = latest_batch(typed, "_office", "lastLoadTime")
    ids = newest.filter(F.size("cancellationReasonIDs") > 0).select(
        F.col("_office").alias("OfficeID"), F.col("customerID").alias("CustomerID"),
        F.col("dateCancelled").alias("DateCancelled"),
        F.explode("cancellationReasonIDs").alias("_rid"))
    ids = ids.withColumn("CancellationReasonID", F.try_variant_get("_rid", "$", "bigint")).drop("_rid")
    dim = F.broadcast(reasons.select(F.col("reasonID").alias("CancellationReasonID"), "description"))
    j = ids.join(dim, "CancellationReasonID", "left")
    return j.select("OfficeID", "CustomerID", "CancellationReasonID",
                    F.coalesce(F.col("description"), F.lit("Unknown Reason")).alias("CancellationReasonDescription"),
                    "DateCancelled").dropDuplicates()


def ticket_item_details(tickets: DataFrame) -> DataFrame:
    """One row per invoice line: array position is the line number; typed
    item fields; empty/missing arrays give no rows."""
    ex = tickets.select("ticketID", "customerID", "officeID", F.col("invoiceDate").alias("ticketDate"),
                        F.posexplode_outer("items").alias("lineNumber", "item")).filter(F.col("item").isNotNull())
    it = F.col("item")
    return ex.select("ticketID", "customerID", "officeID", "ticketDate", F.col("lineNumber").cast("bigint"),
                     F.try_variant_get(it, "$.description", "string").alias("itemDescription"),
                     F.try_variant_get(it, "$.quantity", "bigint").alias("quantity"),
                     F.try_variant_get(it, "$.rate", "decimal(18,2)").alias("rate"),
                     F.try_variant_get(it, "$.amount", "decimal(18,2)").alias("amount"),
                     F.try_variant_get(it, "$.taxable", "boolean").alias("isTaxable"),
                     F.try_variant_get(it, "$.productID", "bigint").alias("productID"),
                     F.try_variant_get(it, "$.glAccountID", "bigint").alias("glAccountID"))
