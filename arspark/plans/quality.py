"""Data-quality checks and load monitoring.

Checks run on the typed entities; monitoring of all raw tables runs on the load
log (``operators.loadlog``), which has a row for each load and never the records.
"""

from __future__ import annotations

import datetime as _dt
import hashlib
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arspark.functions.dates import hours_between, minutes_between
from arspark.operators import loadlog
from arspark.operators.joins import not_in
from arspark.operators.latest import changes_since, recent_window
from arspark.operators.sinks import read_raw_table, replace_batch
from arspark.session import scratch_path
from arspark.sources import rawlog as R
from arspark.sources.adapter import Domain
from arspark.sources.specs import LANDED_FACTS
from arspark.sources.staged import DIMS, FACTS
from arspark.sources.tables import TABLE_NAMES

DEFAULT_NOW = "2001-08-02 01:00:00"
STALE_CHECK_NOW = "2001-08-03 06:00:00"  # a day later: some tables are overdue


def _now(now=DEFAULT_NOW):
    if isinstance(now, str):
        now = _dt.datetime.fromisoformat(now)
    return F.lit(now).cast("timestamp_ntz")


# ----------------------------------------------------------- quality checks
def dq_checks(d: Domain, now=DEFAULT_NOW) -> dict[str, DataFrame]:
    """Each check as a one-row count (anti-joins for referential checks)."""
    t, c, ap = d.ticket(), d.customer(), d.applied_payment()
    return {
        "Orphaned Tickets": t.join(c.select("customerID"), "customerID", "left_anti").agg(F.count(F.lit(1)).alias("n")),
        "Unlinked Applied Payments": ap.join(t.select("ticketID"), "ticketID", "left_anti")
        .agg(F.count(F.lit(1)).alias("n")),
        "Negative Customer Balances": c.filter(F.col("balance") < 0).agg(F.count(F.lit(1)).alias("n")),
        "Future Dated Tickets": t.filter(F.col("completedOn") > _now(now)).agg(F.count(F.lit(1)).alias("n")),
    }


def dq_report(d: Domain, now=DEFAULT_NOW) -> DataFrame:
    """(check, issues, status): status WARN when a check finds rows."""
    parts = [df.select(F.lit(name).alias("check"), F.col("n").alias("issues")) for name, df in dq_checks(d, now).items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("status", F.when(F.col("issues") > 0, "WARN").otherwise("OK"))


def dq_customer_orphans(d: Domain) -> DataFrame:
    return dq_checks(d)["Orphaned Tickets"]


def dq_payment_without_ticket(d: Domain) -> DataFrame:
    return dq_checks(d)["Unlinked Applied Payments"]


def dq_negative_balances(d: Domain) -> DataFrame:
    return dq_checks(d)["Negative Customer Balances"]


def dq_future_tickets(d: Domain) -> DataFrame:
    return dq_checks(d)["Future Dated Tickets"]


def not_in_subquery(d: Domain) -> DataFrame:
    """NOT IN with each of its NULL rules, over all customers: (rule, customerID) of those that pass."""
    c, p = d.customer(), d.payment_profile()
    cases = {
        # customers whose autopay profile isn't among the clean ones; one without a profile doesn't pass
        "null key": not_in(c, "autopayPaymentProfileID", p.filter("failedAttempts = 0"), "paymentProfileID"),
        # a list with NULLs in it: nobody passes
        "null in list": not_in(c, "customerID", c.select(F.col("autopayPaymentProfileID").alias("listed")), "listed"),
        # an empty list: everybody passes
        "empty list": not_in(c, "autopayPaymentProfileID", p.filter("failedAttempts < 0"), "paymentProfileID"),
        "plain": not_in(c, "customerID", c.filter("autopayPaymentProfileID IS NOT NULL").select(F.col("autopayPaymentProfileID").alias("listed")), "listed"),
    }
    return _union([df.select(F.lit(rule).alias("rule"), "customerID") for rule, df in cases.items()])


# --------------------------------------------------------------- monitoring
def _title(entity: str) -> str:
    return "".join(x.capitalize() for x in entity.split("_"))


#: Every entity that is pulled, by the name of its raw table: builder of its raw log.
RAW_TABLES = {f"{_title(e)}_Fact": build for e, (build, _) in FACTS.items() if e not in ("customer", "employee")} \
    | {f"{_title(e)}_Dim": build for e, (build, _) in FACTS.items() if e in ("customer", "employee")} \
    | {f"{_title(e)}_Fact": (lambda d, spec=spec: R.raw_landed_fact(d, spec)) for e, spec in LANDED_FACTS.items()} \
    | {f"{_title(e)}_Dim": build for e, (build, _) in DIMS.items()} | {"TicketItem_Fact": R.raw_ticket}


def _log_path(d: Domain) -> str:
    """The log's folder: one for each session and state of the driver's table files."""
    spark, t = d.t.spark, d.t
    jvm, seen = spark._jvm, []
    for name in TABLE_NAMES:
        p = jvm.org.apache.hadoop.fs.Path(f"{t.root.rstrip('/')}/{name}.parquet")
        fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
        if fs.exists(p):
            seen.append((name, fs.getContentSummary(p).getLength(), fs.getFileStatus(p).getModificationTime()))
    state = hashlib.sha256(repr((t.root, seen)).encode()).hexdigest()[:16]
    return scratch_path(spark, f"load-log-{spark.sparkContext.applicationId}-{state}")


def load_log(d: Domain, entity: str | None = None, checked: bool = True) -> DataFrame:
    """The load log of all raw tables, or of one. The fixture's raw logs are landed as one batch each when the first report asks for them.

    ``checked=False``: for reports that count loads and records but name no unreadable ones. Tables that aren't
    in the log yet are counted in a log of loads beside it, for which no text is read; ``bad`` is NULL there."""
    spark, path = d.t.spark, _log_path(d)
    names = [name for name in RAW_TABLES if entity in (None, name)]
    full = [name for name in names if loadlog.committed(spark, path, name, "0")]
    at, count = (path, loadlog.counts) if checked else (f"{path}-loads", loadlog.loads)
    asked: dict = {}  # tables with the same raw log are counted in one pass
    for name in names:
        if name not in full and not loadlog.committed(spark, at, name, "0"):
            asked.setdefault(RAW_TABLES[name], []).append(name)

    def land(item) -> None:
        build, missing = item
        logged = [x for x, b in RAW_TABLES.items() if b is build and loadlog.committed(spark, at, x, "0")]
        for name in missing:
            if logged:
                loadlog.append_same(spark, at, name, "0", logged[0])
            else:
                loadlog.append(spark, at, name, "0", build(d), count)
                logged = [name]
    with ThreadPoolExecutor(4) as pool:  # many of the tables are too small to keep a cluster busy one by one
        list(pool.map(inheritable_thread_target(spark)(land), asked.items()))
    logs = {path: names} if checked else {path: full, at: [name for name in names if name not in full]}
    return _union([loadlog.read(spark, p, some) for p, some in logs.items() if some])


def raw_log(d: Domain, name: str) -> DataFrame:
    """Landed raw rows (office, load time) of a raw table."""
    return RAW_TABLES[name](d).select("OfficeID", "LoadDatetimeUTC")


def offices_lookup(d: Domain) -> DataFrame:
    """Office control table: offices of region 4 are switched off."""
    return d.office().select(F.col("officeID").alias("office_id"), F.col("officeName").alias("office_name"),
                             (F.col("regionID") != 4).alias("active"))


def of_active_offices(df: DataFrame, offices: DataFrame, ids=None, office_col: str = "OfficeID") -> DataFrame:
    """Rows of active (and, if given, listed) offices: a semi join against the
    office control table, which is a fixed-size lookup and is broadcast."""
    o = offices.filter(F.col("active"))
    if ids is not None:
        o = o.filter(F.col("office_id").isin(list(ids)))
    return df.join(F.broadcast(o.select(F.col("office_id").alias(office_col))), office_col, "left_semi")


def _union(parts):
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def watermarks(d: Domain) -> DataFrame:
    """Per (office, entity): last run, last run that brought a readable row, rows loaded, unreadable rows."""
    return loadlog.watermarks(load_log(d))


def etl_monitoring(d: Domain, now=DEFAULT_NOW) -> DataFrame:
    """Hours since last success per active office and entity; STALE after 24 h,
    ERROR after more than 3 errors, else OK."""
    w = watermarks(d)
    o = F.broadcast(offices_lookup(d).filter(F.col("active")))
    hours = hours_between("last_success_utc", _now(now))
    j = w.join(o, "office_id")
    out = j.select("office_id", "office_name", "entity_name", "last_run_utc", "last_success_utc", "records_loaded",
                   "error_count", hours.alias("hours_since_last_success"),
                   F.when(hours > 24, "STALE").when(F.col("error_count") > 3, "ERROR").otherwise("OK").alias("status"))
    return out.orderBy(F.col("status").desc(), F.col("hours_since_last_success").desc_nulls_first())


def recent_loads(d: Domain, now=DEFAULT_NOW, hours: int = 2) -> DataFrame:
    n = _now(now)
    w = watermarks(d).filter(F.col("last_run_utc") >= n - F.make_interval(hours=F.lit(hours)))
    return w.select("entity_name", "office_id", "last_run_utc", "records_loaded",
                    minutes_between("last_run_utc", n).alias("minutes_ago")).orderBy(F.col("last_run_utc").desc())


def _every_table(d: Domain, found: DataFrame, column: str) -> DataFrame:
    """``found`` with a row for each raw table, as many as there are names."""
    names = d.t.spark.range(0, 1, 1, 1).select(F.explode(F.array(*map(F.lit, RAW_TABLES))).alias(column))
    return names.join(found.withColumnRenamed("entity", column), column, "left")


def loads_today(d: Domain, now=DEFAULT_NOW) -> DataFrame:
    day = F.to_date(_now(now))
    today = load_log(d, checked=False).filter(F.col("LoadDatetimeUTC") >= day.cast("timestamp_ntz")).groupBy("entity").agg(
        F.sum("records").alias("n"), F.countDistinct("OfficeID").alias("offices"), F.max("LoadDatetimeUTC").alias("last_load_time"))
    return _every_table(d, today, "entity").select("entity", F.coalesce("n", F.lit(0)).alias("records_loaded"),
                                                   F.coalesce("offices", F.lit(0)).alias("offices_loaded"), "last_load_time")


def load_detail(d: Domain) -> DataFrame:
    """Per table and office: rows, newest load, distinct load times and rows of the newest load."""
    return load_log(d).groupBy(F.col("entity").alias("table_name"), "OfficeID").agg(
        F.sum("records").alias("total_rows"), F.max("LoadDatetimeUTC").alias("most_recent_load"),
        F.count(F.lit(1)).alias("distinct_load_times"), F.max_by("records", "LoadDatetimeUTC").alias("rows_from_latest_load"))


def table_freshness(d: Domain, now=DEFAULT_NOW) -> DataFrame:
    found = load_log(d, checked=False).groupBy("entity").agg(F.sum("records").alias("n"), F.max("LoadDatetimeUTC").alias("LastUpdate"))
    return _every_table(d, found, "TableName").select("TableName", F.coalesce("n", F.lit(0)).alias("RecordCount"), "LastUpdate",
                                                      hours_between("LastUpdate", _now(now)).alias("HoursSinceUpdate"))


def stale_tables(d: Domain, now=DEFAULT_NOW, max_hours: int = 25) -> DataFrame:
    return table_freshness(d, now).filter(F.col("HoursSinceUpdate") > max_hours) \
        .select("TableName", "HoursSinceUpdate")


def load_date_histogram(d: Domain) -> DataFrame:
    log = load_log(d, "Customer_Dim")
    return log.groupBy(F.to_date("LoadDatetimeUTC").alias("LoadDate")).agg(F.sum("records").alias("RecordCount")) \
        .orderBy(F.col("LoadDate").desc())


def rows_per_office(d: Domain) -> DataFrame:
    log = load_log(d, "Ticket_Fact")
    return log.groupBy("OfficeID").agg(F.sum("records").alias("row_count"),
                                       F.max("LoadDatetimeUTC").alias("last_load")).orderBy("OfficeID")


def layer_row_counts(d: Domain) -> DataFrame:
    """Rows per table in the raw layer vs the typed layer, and the difference."""
    from arspark.operators.stage import stage
    from arspark.sources import specs as S
    pairs = [("ticket", R.raw_ticket, S.TICKET), ("payment", R.raw_payment, S.PAYMENT),
             ("customer", R.raw_customer, S.CUSTOMER)]
    parts = []
    for name, build, spec in pairs:
        raw = build(d)
        # a count needs no more than what tells versions apart: other fields of the records aren't read
        staged = stage(raw, spec.only(*spec.tie_breakers)).rows.agg(F.count(F.lit(1))).scalar()  # scalar subquery
        rc = raw.agg(F.count(F.lit(1)).alias("raw_rows")).withColumn("staged_rows", staged)
        parts.append(rc.select(F.lit(name).alias("table_name"), "raw_rows", "staged_rows",
                               (F.col("raw_rows") - F.col("staged_rows")).alias("difference")))
    return _union(parts)


def _loads_by_office(raw: DataFrame) -> DataFrame:
    return raw.groupBy("OfficeID").agg(F.count(F.lit(1)).alias("loaded"), F.min("LoadDatetimeUTC").alias("first_load"))


def recent_ticket_loads(d: Domain, now=DEFAULT_NOW) -> DataFrame:
    """Ticket rows of the last two days, per office."""
    return _loads_by_office(recent_window(raw_log(d, "Ticket_Fact"), _now(now)))


def ticket_change_window(d: Domain, seen="1998-01-01 00:00:00", now="1998-02-01 00:00:00") -> DataFrame:
    """Ticket rows that a run at ``now`` reads, per office, if the run before saw
    all loads below ``seen``; a fifth of the offices has not been run yet."""
    raw = raw_log(d, "Ticket_Fact")
    before = raw.filter((F.col("LoadDatetimeUTC") < _now(seen)) & (F.col("OfficeID") % 5 != 4))
    marks = before.groupBy(F.col("OfficeID").alias("office_id")).agg(F.max("LoadDatetimeUTC").alias("last_success_utc"))
    return _loads_by_office(changes_since(raw, marks.withColumn("entity_name", F.lit("Ticket_Fact")), "Ticket_Fact", _now(now)))


def ticket_changes_landed(d: Domain, landed="1997-12-20 00:00:00", seen="1998-01-25 00:00:00", now="1998-02-01 00:00:00") -> DataFrame:
    """The same over a raw table: loads since ``landed`` are landed (the last day's twice), the next run reads each office's window only."""
    spark = d.t.spark
    path = scratch_path(spark, f"raw-tickets-{uuid.uuid4().hex}")
    raw = R.raw_ticket(d).filter(F.col("LoadDatetimeUTC").between(_now(landed), _now(now)))
    replace_batch(raw, path)
    replace_batch(raw.filter(F.col("LoadDatetimeUTC") >= F.date_sub(_now(now), 1)), path)
    table = read_raw_table(spark, path)
    before = table.filter((F.col("LoadDate") <= F.to_date(_now(seen))) & (F.col("LoadDatetimeUTC") < _now(seen)) & (F.col("OfficeID") % 5 != 4))
    marks = before.groupBy(F.col("OfficeID").alias("office_id")).agg(F.max("LoadDatetimeUTC").alias("last_success_utc"))
    return _loads_by_office(changes_since(table, marks.withColumn("entity_name", F.lit("Ticket_Fact")), "Ticket_Fact", _now(now)))


def active_office_tickets(d: Domain) -> DataFrame:
    """Raw ticket rows restricted to active offices (scan_active_offices)."""
    raw = raw_log(d, "Ticket_Fact")
    return of_active_offices(raw, offices_lookup(d)).groupBy("OfficeID").agg(F.count(F.lit(1)).alias("rows"))


REGISTRY = {
    "dq_report": dq_report, "dq_customer_orphans": dq_customer_orphans,
    "dq_payment_without_ticket": dq_payment_without_ticket, "dq_negative_balances": dq_negative_balances,
    "dq_future_tickets": dq_future_tickets, "etl_monitoring": etl_monitoring, "recent_loads": recent_loads,
    "loads_today": loads_today, "load_detail": load_detail, "table_freshness": table_freshness,
    "stale_tables": lambda d: stale_tables(d, now=STALE_CHECK_NOW), "load_date_histogram": load_date_histogram, "rows_per_office": rows_per_office,
    "layer_row_counts": layer_row_counts, "scan_active_offices": active_office_tickets,
    "not_in_subquery": not_in_subquery, "recent_ticket_loads": recent_ticket_loads, "ticket_change_window": ticket_change_window, "ticket_changes_landed": ticket_changes_landed,
}
