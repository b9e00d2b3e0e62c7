"""Staging jobs: raw JSON log -> typed newest-version tables, per entity.

Each builder lands the raw log derived from the driver tables (see
``sources.rawlog``) and runs the generic ``stage`` operator with the entity's
spec. The typed output of a correct pipeline equals the entity computed
directly from the tables, which is what the oracle checks.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arspark.operators.latest import changed_or_added
from arspark.operators.stage import cancellation_reasons_from_raw, project_raw, stage, stage_dimension, ticket_item_details
from arspark.plans import ar, customer, ops, revenue
from arspark.plans.quality import load_log
from arspark.session import scratch_path
from arspark.sources import rawlog as R
from arspark.sources import specs as S
from arspark.sources.adapter import Domain
from arspark.sources.raw import bad_json_count
from arspark.sources.staged import DIMS, FACTS, StagedDomain
from arspark.sources.tables import pieces
from arspark.streaming.ingest import current_rows, land_files, run_upsert_stream

# entity -> columns left out of the typed output (nested values that have queries of their own, fixture-only fields)
LEFT_OUT = {"applied_payment": ("listPrice",), "ticket": ("items",), "customer": ("cancellationReasonIDs",)}


def _typed(spec, df, drop=()):
    """The entity's columns; nested values as JSON text."""
    return df.select(*[F.to_json(c.name).alias(c.name) if c.type == "variant" else F.col(c.name)
                       for c in spec.columns if c.name not in drop])


def stage_fact(entity: str):
    build, spec = FACTS[entity]

    def run(d: Domain) -> DataFrame:
        return _typed(spec, stage(build(d), spec).rows, LEFT_OUT.get(entity, ()))
    run.__name__ = f"stage_{entity}"
    return run


def stage_landed_fact(entity: str):
    spec = S.LANDED_FACTS[entity]

    def run(d: Domain) -> DataFrame:
        return _typed(spec, stage(R.raw_landed_fact(d, spec), spec).rows)
    run.__name__ = f"stage_{entity}"
    return run


def dim(entity: str):
    build, spec = DIMS[entity]

    def run(d: Domain) -> DataFrame:
        return _typed(spec, stage_dimension(build(d), spec))
    run.__name__ = f"dim_{entity}"
    return run


def stage_ticket_incremental(d: Domain, cutoff: str = "1998-01-01") -> DataFrame:
    """Two runs: everything loaded before ``cutoff``, then the later loads
    merged into that target. Must equal a single full run."""
    raw = R.raw_ticket(d)
    first = stage(raw.filter(F.col("LoadDatetimeUTC") < F.lit(cutoff).cast("timestamp_ntz")), S.TICKET).rows
    merged = stage(raw.filter(F.col("LoadDatetimeUTC") >= F.lit(cutoff).cast("timestamp_ntz")), S.TICKET,
                   target=first).rows
    return _typed(S.TICKET, merged, ("items",))


def stage_ticket_streamed(d: Domain, cutoff: str = "1996-01-01") -> DataFrame:
    """The ticket log landed as files and merged by the stream into a bucketed
    target, in two runs of several micro-batches: later loads first, then the
    earlier ones with a tenth of the later ones once more. Must equal a full run.

    Landed files go once they are merged, and of the target only the newest
    version stays; files and buckets are as many as the tables ask for."""
    spark = d.t.spark
    root = scratch_path(spark, f"ticket-stream-{uuid.uuid4().hex}")
    n = pieces(spark, d.t.root)
    files, landed = max(8, 2 * -(-n // 4)), spark._jvm.org.apache.hadoop.fs.Path(f"{root}/landed")
    raw = R.raw_ticket(d, files).select("OfficeID", "LoadDatetimeUTC", "RawDataString")  # a file for each of its partitions
    late = F.col("LoadDatetimeUTC") >= F.lit(cutoff).cast("timestamp_ntz")
    again = late & (F.pmod(F.xxhash64("RawDataString"), F.lit(10)) == 0)
    for part in (late, ~late | again):
        land_files(raw.filter(part), f"{root}/landed", n_files=None)
        run_upsert_stream(spark, f"{root}/landed", S.TICKET, f"{root}/target", f"{root}/bad", checkpoint=f"{root}/progress",
                          buckets=max(16, n), max_files_per_trigger=files // 2, keep=1)
        landed.getFileSystem(spark._jsc.hadoopConfiguration()).delete(landed, True)
    return _typed(S.TICKET, current_rows(spark, f"{root}/target", S.TICKET.names), ("items",))


def over_staged(mart, first: tuple[str, ...] = ()):
    """A mart over tables that the staging jobs write: those it reads are staged first, into the shared folder.
    ``first``: those of them whose staging takes the most disk, staged while the others' tables don't lie there yet."""
    def run(d: Domain) -> DataFrame:
        spark = d.t.spark
        staged = StagedDomain(spark, scratch_path(spark, f"staged-{uuid.uuid4().hex}"), d)
        for entity in first:
            staged.table(entity)
        return mart(staged)
    run.__name__ = f"{mart.__name__}_staged"
    return run


def stage_ticket_item(d: Domain) -> DataFrame:
    """Invoices with their item arrays, newest version per ticket."""
    spec = S.ticket_item_spec()
    rows = stage(R.raw_ticket(d), spec).rows
    return rows.select(*_typed(spec, rows, ("items",)).columns,
                       F.coalesce(F.size("items"), F.lit(0)).cast("bigint").alias("itemCount"))


def view_ticket_item_details(d: Domain) -> DataFrame:
    return ticket_item_details(stage(R.raw_ticket(d), S.TICKET.only("customerID", "officeID", "invoiceDate", "items")).rows)


def fact_customer_cancellation_reasons_raw(d: Domain) -> DataFrame:
    reasons = stage_dimension(R.raw_cancellation_reason(d), S.CANCELLATION_REASON)
    return cancellation_reasons_from_raw(R.raw_customer(d), S.CUSTOMER.only("dateCancelled", "cancellationReasonIDs"), reasons)


def changed_tasks(d: Domain, lo: str = "2024-01-10", hi: str = "2024-01-12") -> DataFrame:
    """Tasks added or updated from ``lo`` to ``hi``, the newest such version of each."""
    versions, _, _ = project_raw(R.raw_landed_fact(d, S.TASK), S.TASK.only("DateAdded", "DateUpdated"))
    bounds = (F.lit(x).cast("timestamp_ntz") for x in (lo, hi))
    return changed_or_added(versions, "TaskID", "DateUpdated", "DateAdded", *bounds).select("TaskID", "DateAdded", "DateUpdated")


def dim_office_as_written(d: Domain) -> DataFrame:
    """Offices of the single newest load, as the first form of the refresh has it."""
    return _typed(S.OFFICE, stage_dimension(R.raw_office(d), S.OFFICE, as_written=True))


def json_bad_count(d: Domain) -> DataFrame:
    return bad_json_count(R.raw_ticket(d))


def load_watermark_report(d: Domain) -> DataFrame:
    """Per office and raw table: the last load with a readable record, readable records, unreadable ones."""
    log = load_log(d).withColumn("good", F.col("records") - F.col("bad"))
    marks = log.groupBy("OfficeID", "entity").agg(F.max(F.when(F.col("good") > 0, F.col("LoadDatetimeUTC"))).alias("lastRunTimestamp"),
                                                  F.sum("good").alias("rowsLoaded"), F.sum("bad").alias("badRows"))
    return marks.filter("rowsLoaded > 0")


def registry_entries() -> dict:
    out = {f"stage_{e}": stage_fact(e) for e in FACTS}
    out.update({f"stage_{e}": stage_landed_fact(e) for e in S.LANDED_FACTS})
    out.update({f"dim_{e}": dim(e) for e in DIMS})
    out.update({f"{m.__name__}_staged": over_staged(m) for m in (ar.ar_bucket_summary, customer.customer_acquisition, ops.route_efficiency)})
    out["payment_velocity_staged"] = over_staged(revenue.payment_velocity, first=("payment", "ticket"))
    out.update({"stage_ticket_incremental": stage_ticket_incremental, "stage_ticket_streamed": stage_ticket_streamed,
                "view_ticket_item_details": view_ticket_item_details, "stage_ticket_item": stage_ticket_item,
                "fact_customer_cancellation_reasons_raw": fact_customer_cancellation_reasons_raw,
                "json_bad_count": json_bad_count, "changed_tasks": changed_tasks,
                "dim_office_as_written": dim_office_as_written, "load_watermarks": load_watermark_report})
    return out
