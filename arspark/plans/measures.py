"""BI measures as aggregate expressions evaluated under a grouping.

A dashboard measure is "an aggregate under the current filter context". Here a
filter context is ``by`` (grouping keys: none, ``OfficeID`` or ``RegionID``)
plus an optional ``where`` predicate per source. Each source is aggregated once
per group (partial aggregation on the map side), and the per-source results -
one row per group - are joined on the group keys. Ratios follow DIVIDE(a, b, 0):
0 when the denominator is 0 or blank.

Time intelligence (previous month, trailing 30/90 days) is applied as date
predicates relative to the group's latest date; receivables of the past are
looked up in a daily balance series.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arspark.functions.dates import month_start
from arspark.plans.ar import DEFAULT_AS_OF, ar_aging_prod
from arspark.plans.common import as_date, avg_exact, count_when, sum_when
from arspark.plans.revenue import payment_velocity
from arspark.sources.adapter import Domain

GROUPINGS = {(): [], ("OfficeID",): ["OfficeID"], ("RegionID",): ["RegionID"]}


def divide(a, b, alt=0.0) -> Column:
    """DAX DIVIDE(a, b, alt): alt when b is 0 or blank."""
    a = F.col(a) if isinstance(a, str) else a
    b = F.col(b) if isinstance(b, str) else b
    return F.when(b.isNull() | (b == 0), F.lit(alt)).otherwise(a.cast("double") / b.cast("double"))


ALL = "__all"  # constant grouping key of the company-wide context


def _keyed(d: Domain, df: DataFrame, by: Sequence[str], office_col: str) -> DataFrame:
    """Attach the grouping key(s) to a source keyed by office."""
    df = df.withColumnRenamed(office_col, "OfficeID") if office_col != "OfficeID" else df
    if ALL in by:
        df = df.withColumn(ALL, F.lit(0))
    if "RegionID" in by:
        office = F.broadcast(d.office().select(F.col("officeID").alias("OfficeID"), F.col("regionID").alias("RegionID")))
        df = df.join(office, "OfficeID", "left")
    return df


def _agg(df: DataFrame, by, *aggs) -> DataFrame:
    return df.groupBy(*by).agg(*aggs)


def _with_group_max(df: DataFrame, by, col: str, name: str) -> DataFrame:
    """Attach the group's latest ``col`` (one row per group - bounded by the
    office dimension - broadcast and joined back on the group key)."""
    if list(by) == [ALL]:  # company-wide: a scalar subquery
        return df.withColumn(name, df.agg(F.max(col)).scalar())
    mx = _agg(df, by, F.max(col).alias(name))
    return df.join(F.broadcast(mx), list(by), "left")


def daily_ar(d: Domain, by: Sequence[str] = ("OfficeID",), as_of=DEFAULT_AS_OF, where=None) -> DataFrame:
    """Receivables at the end of each day that changed them: one row per group and day.

    An invoice raises a group's receivables by its total on the day it is completed, a payment
    lowers them by what it applies on the day it is applied. The last day's balance is what is open
    now, so each day's is that less the changes after it: the opening balance plus a running sum over
    the group's days, of which there are as many as the calendar has, however many invoices."""
    by = list(by) or [ALL]
    today, where = as_date(as_of), where or {}

    def src(name, df):
        return df.filter(where[name]) if name in where else df
    done = (F.col("status") == "Completed") & (F.col("completedOn") <= today)
    t = _keyed(d, src("ticket", d.ticket()).filter(done), by, "officeID").groupBy(*by, F.col("completedOn").alias("Day")).agg(F.sum("total").alias("Invoiced"))
    p = _keyed(d, src("applied_payment", d.applied_payment()).filter(F.col("dateApplied") <= today), by, "officeID")
    p = p.groupBy(*by, F.col("dateApplied").alias("Day")).agg(F.sum("appliedAmount").alias("Applied"))
    days = t.unionByName(p, allowMissingColumns=True).groupBy(*by, "Day").agg(F.sum("Invoiced").alias("Invoiced"), F.sum("Applied").alias("Applied"))
    aging = _keyed(d, src("aging", ar_aging_prod(d, as_of).filter(F.col("IsCurrent"))), by, "OfficeID")
    now = _agg(aging, by, F.sum("BalanceAmount").alias("_now"))
    money = "decimal(28,2)"
    change = F.coalesce(F.col("Invoiced").cast(money), F.lit(0).cast(money)) - F.coalesce(F.col("Applied").cast(money), F.lit(0).cast(money))
    # company-wide: a scalar subquery
    days = days.withColumn("_now", now.select("_now").scalar()) if by == [ALL] else days.join(now, by, "left")
    days = days.withColumn("_change", change.cast(money))
    group, run = Window.partitionBy(*by), Window.partitionBy(*by).orderBy("Day").rowsBetween(Window.unboundedPreceding, 0)
    opening = F.coalesce(F.col("_now").cast(money), F.lit(0).cast(money)) - F.sum("_change").over(group).cast(money)
    days = days.withColumn("OpeningAR", opening.cast(money))
    return days.withColumn("EndingAR", (F.col("OpeningAR") + F.sum("_change").over(run).cast(money)).cast(money)).select(
        *by, "Day", "Invoiced", "Applied", "OpeningAR", "EndingAR")


DAYS_IN_PERIOD = 30


def ar_over_time(days: DataFrame, by: Sequence[str]) -> DataFrame:
    """Per group, from :func:`daily_ar`: the latest day with an invoice (``anchor``), the balances' sum over the
    30 days that end on it and over those that end a month before, and the balance a month before it."""
    by = list(by)
    group = Window.partitionBy(*by)
    far = F.lit("9999-12-31").cast("date")
    held = days.withColumn("anchor", F.max(F.when(F.col("Invoiced").isNotNull(), F.col("Day"))).over(group)) \
        .withColumn("_to", F.coalesce(F.date_sub(F.lead("Day").over(group.orderBy("Day")), 1), far)) \
        .withColumn("before", F.add_months("anchor", -1))

    def overlap(end):  # days of the period that ends on `end` on which a row's balance holds
        return F.greatest(F.lit(0), F.datediff(F.least(F.col("_to"), end), F.greatest(F.col("Day"), F.date_sub(end, DAYS_IN_PERIOD - 1))) + 1)
    out = held
    for name, end in (("_n", F.col("anchor")), ("_n_prev", F.col("before"))):
        out = out.withColumn(name, overlap(end))
    opening = F.min("OpeningAR")
    total = lambda n: F.sum(F.col("EndingAR") * F.col(n)) + opening * (F.lit(DAYS_IN_PERIOD) - F.sum(n))
    return out.groupBy(*by).agg(
        F.max("anchor").alias("anchor"), total("_n").alias("ar_days"), total("_n_prev").alias("ar_days_prev"),
        F.coalesce(F.max_by("EndingAR", F.when(F.col("Day") <= F.col("before"), F.col("Day"))), opening).alias("ar_month_ago"))


def base_aggregates(d: Domain, by: Sequence[str] = ("OfficeID",), as_of=DEFAULT_AS_OF, where=None) -> DataFrame:
    """Per-group aggregates every measure is computed from."""
    by = list(by) or [ALL]
    where = where or {}

    def src(name, df):
        return df.filter(where[name]) if name in where else df

    aging = _keyed(d, src("aging", ar_aging_prod(d, as_of).filter(F.col("IsCurrent"))), by, "OfficeID")
    b = F.col("BalanceAmount")
    a = _agg(aging, by,
             F.sum(b).alias("total_ar"),
             *[sum_when(F.col("AgeBucket") == lbl, b, None).alias(nm) for nm, lbl in
               [("ar_0_30", "0-30 Days"), ("ar_31_60", "31-60 Days"), ("ar_61_90", "61-90 Days"),
                ("ar_over_90", "Over 90 Days")]],
             F.countDistinct(F.when(b > 0, F.col("CustomerID"))).alias("active_customers"),
             F.countDistinct(F.when((F.col("AgeBucket") == "Over 90 Days") & (b > 1000), F.col("CustomerID")))
             .alias("high_risk_customers"))

    t = _keyed(d, src("ticket", d.ticket()), by, "officeID")
    t = _with_group_max(t, by, "completedOn", "_tmax")
    tm = month_start("_tmax")
    ta = _agg(t, by,
              F.sum("total").alias("invoiced"), avg_exact("total").alias("avg_invoice"),
              sum_when((F.col("completedOn") > F.date_add("_tmax", -30)) & (F.col("completedOn") <= F.col("_tmax")),
                       "total", None).alias("rev30"),
              sum_when((F.col("completedOn") > F.date_add(F.add_months("_tmax", -1), -30))
                       & (F.col("completedOn") <= F.add_months("_tmax", -1)), "total", None).alias("rev30_prev"),
              sum_when(month_start("completedOn") == tm, "total", None).alias("rev_cur_month"),
              sum_when(month_start("completedOn") == F.add_months(tm, -1), "total", None).alias("rev_prev_month"))

    p = _keyed(d, src("payment", d.payment()), by, "officeID")
    p = _with_group_max(p, by, "paymentDate", "_pmax")
    pa = _agg(p, by,
              F.sum("amount").alias("payments"),
              sum_when(F.col("writeoff") == F.lit(True), "amount", None).alias("writeoffs"),
              sum_when((F.col("paymentDate") > F.date_add("_pmax", -90)) & (F.col("paymentDate") <= F.col("_pmax")),
                       "amount", None).alias("pay90"))

    ap = _keyed(d, src("applied_payment", d.applied_payment()), by, "officeID")
    apa = _agg(ap, by, F.sum("appliedAmount").alias("collected"))

    v = _keyed(d, src("velocity", payment_velocity(d)), by, "OfficeID")
    va = _agg(v, by, avg_exact("DaysToPay").alias("avg_days_to_pay"),
              count_when(F.col("DaysToPay") <= 30).alias("on_time"), F.count(F.lit(1)).alias("velocity_rows"))

    series = ar_over_time(daily_ar(d, [k for k in by if k != ALL], as_of, where), by)
    # what was invoiced and collected in the calendar month of the series' latest day
    ends = series.select(*by, month_start("anchor").alias("_month"))

    def in_month(df, day, amount, name):
        monthly = df.groupBy(*by, month_start(day).alias("_month")).agg(F.sum(amount).alias(name))  # a row per group and month
        return monthly.join(ends, [*by, "_month"]).select(*by, name)
    ti = in_month(_keyed(d, src("ticket", d.ticket()), by, "officeID"), "completedOn", "total", "month_invoiced")
    pi = in_month(_keyed(d, src("payment", d.payment()), by, "officeID"), "paymentDate", "amount", "month_collections")

    parts = [a, ta, pa, apa, va, series, ti, pi]
    if by == [ALL]:
        # company-wide: each source aggregate is one row; attach the others to
        # the first as scalar subqueries (one struct per source)
        out = parts[0].drop(ALL)
        for i, x in enumerate(parts[1:]):
            cols = [c for c in x.columns if c != ALL]
            out = out.withColumn(f"__p{i}", x.select(F.struct(*cols)).scalar())
            out = out.select("*", *[F.col(f"__p{i}.{c}").alias(c) for c in cols]).drop(f"__p{i}")
        return out
    keys = d.office().select(F.col("officeID").alias("OfficeID"), F.col("regionID").alias("RegionID"))
    keys = keys.select(*by).distinct()
    out = keys
    for x in parts:
        out = out.join(x, by, "left")
    return out


def measures(d: Domain, by: Sequence[str] = ("OfficeID",), as_of=DEFAULT_AS_OF, where=None) -> DataFrame:
    """25 measures, one row per group; :func:`m_ar_by_office` and :func:`m_dso_by_region` are two of them with the grouping fixed.

    Receivables at a past date are those of :func:`daily_ar`. DSO takes their mean over the 30 days that
    end on the group's latest invoice day; its trend the same a month earlier, with the revenue of the 30 days
    before that; CEI starts from the balance a month before that day, and AR growth compares with it."""
    g = base_aggregates(d, by, as_of, where)
    c = F.col
    mean_ar = lambda name: c(name).cast("double") / float(DAYS_IN_PERIOD)
    dso = divide(mean_ar("ar_days"), c("rev30").cast("double") / float(DAYS_IN_PERIOD))
    dso_prev = divide(mean_ar("ar_days_prev"), c("rev30_prev").cast("double") / float(DAYS_IN_PERIOD))
    projected = c("ar_0_30").cast("double") * divide(c("pay90"), c("ar_0_30"))
    cols = [
        c("total_ar").alias("m_total_ar"),
        c("ar_0_30").alias("m_ar_0_30"), c("ar_31_60").alias("m_ar_31_60"), c("ar_61_90").alias("m_ar_61_90"),
        c("ar_over_90").alias("m_ar_over_90"),
        divide(c("ar_over_90"), c("total_ar")).alias("m_ar_over_90_pct"),
        dso.alias("m_dso"),
        (dso - dso_prev).alias("m_dso_trend"),
        (divide(c("month_collections"),
                c("ar_month_ago") + F.coalesce(c("month_invoiced"), F.lit(0)) - F.coalesce(c("ar_0_30"), F.lit(0)))
         * 100.0).alias("m_cei"),
        (divide(c("payments"), c("invoiced")) * 100.0).alias("m_collections_rate"),
        c("invoiced").alias("m_total_invoiced"), c("collected").alias("m_total_collected"),
        (c("invoiced") - c("collected")).alias("m_collection_gap"),
        c("avg_invoice").alias("m_avg_invoice"),
        c("active_customers").alias("m_active_ar_customers"),
        c("high_risk_customers").alias("m_high_risk_customers"),
        divide(c("total_ar"), c("active_customers")).alias("m_avg_customer_balance"),
        c("avg_days_to_pay").alias("m_avg_days_to_pay"),
        (divide(c("on_time"), c("velocity_rows")) * 100.0).alias("m_on_time_rate"),
        c("writeoffs").alias("m_total_writeoffs"),
        (divide(c("writeoffs"), c("invoiced")) * 100.0).alias("m_writeoff_rate"),
        (divide(c("total_ar").cast("double") - c("ar_month_ago").cast("double"), c("ar_month_ago")) * 100.0).alias("m_ar_mom_growth"),
        (divide(c("rev_cur_month").cast("double") - F.coalesce(c("rev_prev_month"), F.lit(0)).cast("double"),
                c("rev_prev_month")) * 100.0).alias("m_revenue_mom_growth"),
        projected.alias("m_projected_collections_30d"),
        (projected - F.coalesce(c("writeoffs"), F.lit(0)).cast("double")).alias("m_cash_flow_forecast"),
    ]
    return g.select(*list(by), *cols)


def measures_by_office(d: Domain) -> DataFrame:
    return measures(d, ("OfficeID",))


def measures_company(d: Domain) -> DataFrame:
    return measures(d, ())


def m_ar_by_office(d: Domain) -> DataFrame:
    """Total AR with every filter removed except the office."""
    return measures(d, ("OfficeID",)).select("OfficeID", F.col("m_total_ar").alias("m_ar_by_office"))


def m_dso_by_region(d: Domain) -> DataFrame:
    """DSO with every filter removed except the region (office -> region)."""
    return measures(d, ("RegionID",)).select("RegionID", F.col("m_dso").alias("m_dso_by_region"))


def ar_daily_balance(d: Domain) -> DataFrame:
    """Receivables of each office at the end of each day that changed them."""
    return daily_ar(d, ("OfficeID",))
