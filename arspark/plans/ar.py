"""Receivables marts: aging, DSO, CEI, waterfall, declines, leakage, agency,
rep productivity, program performance, data-quality flags, DSO trend.

Each function returns a lazy DataFrame; money stays DECIMAL until the caller
converts the output (see ``common.decimals_to_double``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from arspark.functions.dates import days_between, month_start, months_between_boundaries
from arspark.operators.latest import lag_split
from arspark.functions.scalars import (
    AGE_BUCKET_4_LAST, AGE_BUCKETS_4, age_bucket, age_bucket_sort, bad_email, bad_phone, pct, safe_div,
)
from arspark.plans.common import as_date, avg_exact, count_when, sum_when
from arspark.sources.adapter import Domain

DEFAULT_AS_OF = "2001-08-01"


# ----------------------------------------------------------------- aging
def open_tickets(d: Domain, as_of=DEFAULT_AS_OF) -> DataFrame:
    """Open, active invoices with their age in days; marts that need no attributes start here."""
    t = d.ticket().filter((F.col("balance") > 0) & (F.col("isActive") == F.lit(True)))
    return t.select("ticketID", "customerID", "officeID", "invoiceDate", F.col("total").alias("invoiceAmount"),
                    F.col("balance").alias("currentBalance"), "serviceID",
                    days_between("invoiceDate", as_date(as_of)).alias("ageDays"))


def ar_aging(d: Domain, as_of=DEFAULT_AS_OF) -> DataFrame:
    """Open, active invoices with age in days, 5 buckets and customer/office/
    service attributes (left joins; office is a fixed-size dimension -> broadcast)."""
    age = F.col("ageDays")
    tb = open_tickets(d, as_of).select("*", age_bucket(age).alias("ageBucket"), age_bucket_sort(age).alias("ageBucketSort"))
    c = d.customer().select("customerID", "fName", "lName", "companyName", "regionID", "phone1", "email",
                            "address", "city", "state", F.col("status").alias("customerStatus"))
    o = F.broadcast(d.office().select("officeID", "officeName"))
    st = d.service_type().select(F.col("serviceTypeID").alias("serviceID"), "serviceTypeName",
                                 F.col("category").alias("serviceCategory"))
    return tb.join(c, "customerID", "left").join(o, "officeID", "left").join(st, "serviceID", "left")


def ar_aging_prod(d: Domain, as_of=DEFAULT_AS_OF) -> DataFrame:
    """Production aging: completed tickets, 4 buckets on completion date, inner
    joins to customer and office, name concatenation (NULL if a part is NULL)."""
    today = as_date(as_of)
    t = d.ticket().filter((F.col("balance") > 0) & (F.col("status") == "Completed"))
    age = days_between("completedOn", today)
    ta = t.select(F.col("customerID").alias("CustomerID"), F.col("officeID").alias("OfficeID"),
                  F.col("ticketID").alias("TicketID"), F.col("completedOn").alias("CompletedOn"),
                  F.col("total").alias("TotalAmount"), F.col("balance").alias("BalanceAmount"),
                  age.alias("DaysOutstanding"),
                  age_bucket(age, AGE_BUCKETS_4, AGE_BUCKET_4_LAST).alias("AgeBucket"),
                  today.alias("AsOfDate"), F.lit(True).alias("IsCurrent"))
    c = d.customer().select(F.col("customerID").alias("CustomerID"),
                            F.concat(F.col("fName"), F.lit(" "), F.col("lName")).alias("CustomerName"),
                            F.col("companyName").alias("CompanyName"), F.col("status").alias("CustomerStatus"))
    o = F.broadcast(d.office().select(F.col("officeID").alias("OfficeID"), F.col("officeName").alias("OfficeName")))
    return ta.join(c, "CustomerID", "inner").join(o, "OfficeID", "inner")


def ar_bucket_summary(d: Domain, as_of=DEFAULT_AS_OF) -> DataFrame:
    """Count and balance per age bucket (current aging rows)."""
    a = ar_aging_prod(d, as_of).filter(F.col("IsCurrent"))
    return a.groupBy("AgeBucket").agg(F.count(F.lit(1)).alias("CustomerCount"),
                                      F.sum("BalanceAmount").alias("TotalBalance"))


def ar_summary_by_customer(d: Domain, as_of=DEFAULT_AS_OF) -> DataFrame:
    """Open balance and age of the oldest open invoice per customer."""
    t = d.ticket().filter(F.col("balance") > 0)
    return t.groupBy(F.col("customerID").alias("CustomerID")).agg(
        F.sum("balance").alias("TotalBalance"),
        days_between(F.min("completedOn"), as_date(as_of)).alias("OldestInvoiceAge"))


def ticket_totals_12m(d: Domain, as_of=DEFAULT_AS_OF) -> DataFrame:
    """Tickets, revenue and open AR for tickets completed in the last 12 months."""
    t = d.ticket().filter(F.col("completedOn") >= F.add_months(as_date(as_of), -12))
    return t.agg(F.count(F.lit(1)).alias("TotalTickets"), F.sum("total").alias("TotalRevenue"),
                 F.sum("balance").alias("OutstandingAR"))


# ------------------------------------------------------------------- DSO
def dso_metrics(d: Domain, as_of=DEFAULT_AS_OF) -> DataFrame:
    """Per office: AR total and split at 60 days, counts, 90-day average daily
    applied revenue, DSO = AR / average daily revenue."""
    today = as_date(as_of)
    m = open_tickets(d, as_of).groupBy("officeID").agg(
        F.sum("currentBalance").alias("totalAR"),
        sum_when(F.col("ageDays") <= 60, "currentBalance").alias("arUnder60"),
        sum_when(F.col("ageDays") > 60, "currentBalance").alias("arOver60"),
        count_when(F.col("ageDays") > 60).alias("accountsOver60"),
        F.count(F.lit(1)).alias("totalAccounts"))
    r = d.applied_payment().filter(F.col("dateApplied") >= F.date_add(today, -90)) \
        .groupBy("officeID").agg((F.sum("appliedAmount").cast("double") / F.lit(90.0)).alias("avgDailyRevenue"))
    o = F.broadcast(d.office().select("officeID", "officeName"))
    j = m.join(r, "officeID", "left").join(o, "officeID", "left")
    return j.select(month_start(today).alias("reportMonth"), "officeID", "officeName", "totalAR",
                    "arUnder60", "arOver60", pct("arOver60", "totalAR").alias("percentOver60Days"),
                    "accountsOver60", "totalAccounts", "avgDailyRevenue",
                    safe_div("totalAR", "avgDailyRevenue").alias("dso"))


def dso_metrics_prod(d: Domain, as_of=DEFAULT_AS_OF) -> DataFrame:
    """Daily revenue and AR per office with 30-row moving average/sum and
    DSO = avg AR / 30-row revenue * 30 (rows, not days, as written).

    The window runs over the (office, day) pre-aggregate, never over tickets."""
    t = d.ticket().filter(F.col("status") == "Completed")
    daily = t.groupBy(F.col("completedOn").alias("CalculationDate"), F.col("officeID").alias("OfficeID")).agg(
        F.sum("total").alias("DailyRevenue"), F.sum("balance").alias("DailyARBalance"))
    w = Window.partitionBy("OfficeID").orderBy("CalculationDate").rowsBetween(-29, 0)
    avg_ar = F.sum("DailyARBalance").over(w).cast("double") / F.count("DailyARBalance").over(w)
    rev30 = F.sum("DailyRevenue").over(w)
    out = daily.select("CalculationDate", "OfficeID", "DailyRevenue", "DailyARBalance",
                       avg_ar.alias("AvgARBalance30Days"), rev30.alias("TotalRevenue30Days"))
    return out.withColumn("DSO", F.when(F.col("TotalRevenue30Days") > 0,
                                        (F.col("AvgARBalance30Days") / F.col("TotalRevenue30Days").cast("double"))
                                        * F.lit(30.0)).otherwise(F.lit(0.0)))


def month_series(spark, as_of, n: int = 12) -> DataFrame:
    """n report months back from ``as_of`` (GENERATOR(ROWCOUNT => n))."""
    today = as_date(as_of)
    s = spark.range(n).select(F.col("id").cast("int").alias("n"))
    shifted = F.add_months(today, -F.col("n"))
    return s.select("n", month_start(shifted).alias("reportMonth"), F.last_day(shifted).alias("monthEnd"))


def dso_trend(d: Domain, as_of=DEFAULT_AS_OF, months: int = 12) -> DataFrame:
    """12-month DSO by office and service.

    The warehouse joins every open ticket to a 12-row month series on
    ``invoiceDate <= LAST_DAY(month)``. Here tickets are first pre-aggregated by
    (office, service, months-before-as_of); each pre-aggregate row then expands
    to the report months it belongs to (at most ``months`` rows) - a generator
    instead of a nested-loop join, and the shuffle carries aggregates, not tickets.
    """
    today = as_date(as_of)
    t = d.ticket().filter(F.col("balance") > 0)
    lag_m = months_between_boundaries("invoiceDate", today)  # 0 = invoiced in the as_of month
    pre = t.filter(lag_m >= 0).groupBy("officeID", "serviceID",
                                        F.least(lag_m, F.lit(months - 1)).alias("k")) \
        .agg(F.sum("balance").alias("bal"))
    exp = pre.select("officeID", "serviceID", "bal", F.explode(F.sequence(F.lit(0), F.col("k"))).alias("n"))
    mar = exp.groupBy(month_start(F.add_months(today, -F.col("n"))).alias("reportMonth"),
                      "officeID", "serviceID").agg(F.sum("bal").alias("monthEndAR"))
    ap = d.applied_payment().filter(F.col("dateApplied") >= F.add_months(today, -months))
    mr = ap.groupBy(month_start("dateApplied").alias("reportMonth"), "officeID").agg(
        F.sum("appliedAmount").alias("monthlyRevenue"))
    mr = mr.withColumn("avgDailyRevenue", F.col("monthlyRevenue").cast("double") /
                       F.dayofmonth(F.last_day("reportMonth")))
    o = F.broadcast(d.office().select("officeID", "officeName"))
    st = d.service_type().select(F.col("serviceTypeID").alias("serviceID"), "serviceTypeName",
                                 F.col("category").alias("serviceCategory"))
    j = mar.join(mr, ["officeID", "reportMonth"], "left").join(o, "officeID", "left") \
        .join(st, "serviceID", "left").filter(F.col("avgDailyRevenue") > 0)
    return j.select("reportMonth", "officeID", "officeName", "serviceID", "serviceTypeName", "serviceCategory",
                    "monthEndAR", "monthlyRevenue", "avgDailyRevenue",
                    safe_div("monthEndAR", "avgDailyRevenue").alias("dso"))


# -------------------------------------------------------------- CEI etc.
def cei_metrics(d: Domain, as_of=DEFAULT_AS_OF) -> DataFrame:
    """Collection effectiveness per office (application rows joined to their
    ticket; ticket amounts repeat per application as written)."""
    ms = month_start(as_date(as_of))
    ap = d.applied_payment().select("officeID", "ticketID", "dateApplied", "appliedAmount")
    t = d.ticket().select("ticketID", "invoiceDate", "balance", "total")
    j = ap.join(t, "ticketID", "left")
    g = j.groupBy("officeID").agg(
        sum_when(F.col("invoiceDate") < ms, "balance").alias("beginningAR"),
        sum_when(month_start("invoiceDate") == ms, "total").alias("currentMonthSales"),
        sum_when(month_start("dateApplied") == ms, "appliedAmount").alias("monthlyCollections"))
    tc = F.col("beginningAR") + F.col("currentMonthSales")
    return g.select(ms.alias("reportMonth"), "officeID", "beginningAR", "currentMonthSales",
                    "monthlyCollections", tc.alias("totalCollectable"),
                    pct("monthlyCollections", tc).alias("cei"))


def cei_metrics_prod(d: Domain, as_of=DEFAULT_AS_OF) -> DataFrame:
    """Invoiced vs collected this month per office, from completed tickets."""
    ms = month_start(as_date(as_of))
    t = d.ticket().filter(F.col("status") == "Completed").select("ticketID", "officeID", "completedOn", "total")
    ap = d.applied_payment().select("ticketID", "paymentID", "appliedAmount")
    p = d.payment().select("paymentID", "paymentDate")
    j = t.join(ap, "ticketID", "left").join(p, "paymentID", "left")
    g = j.groupBy(F.col("officeID").alias("OfficeID")).agg(
        sum_when(F.col("completedOn") >= ms, "total").alias("MonthlyInvoiced"),
        sum_when(F.col("paymentDate") >= ms, "appliedAmount").alias("MonthlyCollected"))
    cei = F.when(F.col("MonthlyInvoiced") > 0,
                 (F.col("MonthlyCollected").cast("double") / F.col("MonthlyInvoiced").cast("double"))
                 * F.lit(100.0)).otherwise(F.lit(0.0))
    return g.select(ms.alias("CalculationDate"), "OfficeID", "MonthlyInvoiced", "MonthlyCollected",
                    cei.alias("CollectionEfficiencyIndex"))


def ar_waterfall(d: Domain, as_of=DEFAULT_AS_OF) -> DataFrame:
    """Per office: beginning AR, new sales, collected, write-offs, ending AR."""
    ms = month_start(as_date(as_of))
    t = d.ticket()
    mv = t.groupBy("officeID").agg(
        sum_when(F.col("invoiceDate") < ms, F.col("total") - (F.col("total") - F.col("balance"))).alias("beginningAR"),
        sum_when(month_start("invoiceDate") == ms, "total").alias("newSales"))
    col = d.applied_payment().filter(month_start("dateApplied") == ms) \
        .groupBy("officeID").agg(F.sum("appliedAmount").alias("totalCollected"))
    wo = d.payment().filter((F.col("writeoff") == F.lit(True)) & (month_start("paymentDate") == ms)) \
        .groupBy("officeID").agg(F.sum("amount").alias("totalWriteoffs"))
    j = mv.join(col, "officeID", "left").join(wo, "officeID", "left")
    c = F.coalesce(F.col("totalCollected"), F.lit(0))
    w = F.coalesce(F.col("totalWriteoffs"), F.lit(0))
    return j.select(ms.alias("reportMonth"), "officeID", "beginningAR", "newSales", c.alias("collected"),
                    w.alias("writeoffs"),
                    (F.col("beginningAR") + F.col("newSales") - c - w).alias("endingAR"))


def ar_waterfall_prod(d: Domain, as_of=DEFAULT_AS_OF) -> DataFrame:
    """Company-wide waterfall as five labelled rows (UNION ALL of aggregates).

    The three ticket aggregates come from one scan and are unpivoted with
    ``stack``; the two payment aggregates share one filtered payment scan."""
    ms = month_start(as_date(as_of))
    t = d.ticket().filter(F.col("status") == "Completed")
    ta = t.agg(sum_when(F.col("completedOn") < ms, "balance").alias("b"),
               sum_when(F.col("completedOn") >= ms, "total").alias("n"),
               F.sum("balance").alias("e"))
    tickets = ta.select(F.expr("stack(3, 'Beginning AR', 1, b, 'New Invoices', 2, n, 'Ending AR', 5, e)")
                        .alias("Category", "SortOrder", "Amount"))
    p = d.payment().filter(F.col("paymentDate") >= ms)
    coll = d.applied_payment().select("paymentID", "appliedAmount").join(p.select("paymentID"), "paymentID") \
        .agg((F.lit(-1) * F.sum("appliedAmount")).alias("Amount")) \
        .select(F.lit("Collections").alias("Category"), F.lit(3).alias("SortOrder"), "Amount")
    wo = p.agg((F.lit(-1) * sum_when(F.col("writeoff") == F.lit(True), "amount")).alias("Amount")) \
        .select(F.lit("Write-offs").alias("Category"), F.lit(4).alias("SortOrder"), "Amount")
    out = tickets.unionByName(coll.withColumn("Amount", F.col("Amount").cast("decimal(38,2)"))) \
        .unionByName(wo.withColumn("Amount", F.col("Amount").cast("decimal(38,2)")))
    return out.select("Category", "SortOrder", F.col("Amount").cast("decimal(38,2)").alias("Amount"))


# -------------------------------------------------------------- payments
def payment_declines(d: Domain, as_of=DEFAULT_AS_OF) -> DataFrame:
    """Attempts, successes, declines and retry successes by office, month,
    method and card type. The previous status is the one of the same
    customer+method ordered by payment date (payment id breaks ties)."""
    p = d.payment()
    pp = d.payment_profile().groupBy("customerID").agg(
        F.max("failedAttempts").alias("failedAttempts"), F.max("lastDeclineType").alias("lastDeclineType"),
        F.max("retryPoints").alias("retryPoints"))
    # lag(status) over (customer, method order by date, id), split per day so a
    # customer with a huge payment history is not processed by one task
    pa = lag_split(p.join(pp, "customerID", "left"), ["customerID", "paymentMethod"], "paymentDate", "paymentID",
                   "status", "previousStatus")
    ok, dec = F.col("status") == 1, F.col("status") == 2
    retry_ok = ok & (F.col("previousStatus") == 2)
    g = pa.groupBy("officeID", month_start("paymentDate").alias("paymentMonth"), "paymentMethod", "cardType").agg(
        F.count(F.lit(1)).alias("totalAttempts"),
        count_when(ok).alias("successfulPayments"),
        count_when(dec).alias("declinedPayments"),
        count_when(retry_ok).alias("retrySuccesses"),
        count_when(F.col("previousStatus") == 2).alias("_retries"),
        sum_when(ok, "amount").alias("successfulRevenue"),
        sum_when(dec, "amount").alias("declinedRevenue"))
    return g.select("officeID", "paymentMonth", "paymentMethod", "cardType", "totalAttempts",
                    "successfulPayments", "declinedPayments", "retrySuccesses",
                    safe_div(F.col("declinedPayments").cast("double") * 100.0, "totalAttempts").alias("declineRate"),
                    safe_div(F.col("retrySuccesses").cast("double") * 100.0, "_retries").alias("retrySuccessRate"),
                    "successfulRevenue", "declinedRevenue")


def revenue_leakage(d: Domain, as_of=DEFAULT_AS_OF) -> DataFrame:
    """Discounts + write-offs + declines by office/month/category/service.
    Month payment totals repeat for every service line of the month (as written).
    Tickets are summed per office, month and service before any join."""
    st = d.service_type().select(F.col("serviceTypeID").alias("serviceID"), "serviceTypeName",
                                 F.col("category").alias("serviceCategory"))
    discount = F.when(F.col("subtotal") > F.col("total"), F.col("subtotal") - F.col("total")).otherwise(F.lit(0))
    by_service = d.ticket().groupBy("officeID", month_start("invoiceDate").alias("revenueMonth"), "serviceID").agg(
        F.count("ticketID").alias("n"), F.sum("subtotal").alias("gross"), F.sum("total").alias("net"),
        F.sum(discount).alias("discount"))
    td = by_service.join(st, "serviceID", "left").groupBy("officeID", "revenueMonth", "serviceCategory", "serviceTypeName").agg(
        F.sum("n").alias("ticketCount"), F.sum("gross").alias("grossRevenue"), F.sum("net").alias("netRevenue"),
        F.sum("discount").alias("totalDiscounts"))
    pd_ = d.payment().groupBy("officeID", month_start("paymentDate").alias("revenueMonth")).agg(
        sum_when(F.col("writeoff") == F.lit(True), "amount").alias("writeoffAmount"),
        sum_when(F.col("status") == 2, "amount").alias("declinedAmount"))
    g = td.join(pd_, ["officeID", "revenueMonth"], "left")
    wo = F.coalesce(F.col("writeoffAmount"), F.lit(0))
    de = F.coalesce(F.col("declinedAmount"), F.lit(0))
    leak = F.col("totalDiscounts") + wo + de
    return g.select("officeID", "revenueMonth", "serviceCategory", "serviceTypeName", "ticketCount",
                    "grossRevenue", "netRevenue", "totalDiscounts",
                    pct("totalDiscounts", "grossRevenue").alias("discountPercentage"),
                    wo.alias("writeoffs"), de.alias("declines"), leak.alias("totalLeakage"),
                    pct(leak, "grossRevenue").alias("leakagePercentage"))


def agency_performance(d: Domain, as_of=DEFAULT_AS_OF) -> DataFrame:
    """Accounts over 120 days, recoveries after placement, rates, net of fee."""
    today = as_date(as_of)
    aa = open_tickets(d, as_of).filter(F.col("ageDays") > 120).groupBy("customerID", "officeID").agg(
        F.sum("currentBalance").alias("placedAmount"), F.min("invoiceDate").alias("oldestInvoiceDate"),
        F.count("ticketID").alias("placedInvoices"))
    ap = d.applied_payment().select("customerID", "paymentID", "dateApplied", "appliedAmount")
    after = F.col("dateApplied") > F.date_add("oldestInvoiceDate", 120)
    rec = aa.join(ap, "customerID", "left").groupBy("customerID", "officeID", "placedAmount", "placedInvoices").agg(
        sum_when(after, "appliedAmount").alias("recoveredAmount"),
        F.countDistinct(F.when(after, F.col("paymentID"))).alias("recoveryPayments"))
    g = rec.groupBy("officeID").agg(
        F.countDistinct("customerID").alias("accountsPlaced"), F.sum("placedAmount").alias("totalPlacedAmount"),
        F.sum("placedInvoices").alias("totalPlacedInvoices"), F.sum("recoveredAmount").alias("totalRecoveredAmount"),
        F.sum("recoveryPayments").alias("totalRecoveryPayments"),
        F.countDistinct(F.when(F.col("recoveredAmount") > 0, F.col("customerID"))).alias("accountsRecovered"))
    return g.select("officeID", month_start(today).alias("reportMonth"), "accountsPlaced", "totalPlacedAmount",
                    "totalPlacedInvoices", "totalRecoveredAmount", "totalRecoveryPayments", "accountsRecovered",
                    pct("totalRecoveredAmount", "totalPlacedAmount").alias("recoveryRateDollars"),
                    pct("accountsRecovered", "accountsPlaced").alias("recoveryRateAccounts"),
                    (F.col("totalRecoveredAmount") * F.lit(0.75).cast("decimal(3,2)")).alias("netBackAfterFees"))


def ar_rep_productivity(d: Domain, as_of=DEFAULT_AS_OF) -> DataFrame:
    """Dials, contacts and collections per rep and day over the last 30 days.
    Payment amounts repeat per note of the (employee, day), as written: both
    sides are summed first and the day's amount is taken once a note, so notes
    never meet payments row by row."""
    first_day = F.date_add(as_date(as_of), -30)
    key = ["employeeID", "activityDate"]
    n = d.note().filter(F.col("dateCreated") >= first_day).groupBy(
        "employeeID", F.to_date("dateCreated").alias("activityDate")).agg(
        F.count(F.lit(1)).alias("_notes"), count_when(F.col("typeID").isin(1, 2, 3)).alias("totalDials"),
        count_when(F.col("typeID") == 4).alias("totalContacts"))
    c = d.customer().select("customerID", "autopayPaymentProfileID")
    p = d.payment().filter(F.col("paymentDate") >= first_day).join(c, "customerID", "left").groupBy(
        "employeeID", F.col("paymentDate").alias("activityDate")).agg(
        F.count("paymentID").alias("_n"), F.sum("amount").alias("_amount"),
        count_when(F.col("autopayPaymentProfileID").isNotNull()).alias("_auto"))
    da = n.join(p, key, "left").select(
        *key, "totalDials", "totalContacts", F.coalesce("_n", F.lit(0)).alias("paymentsCollected"),
        (F.col("_amount") * F.col("_notes")).alias("amountCollected"), F.coalesce("_auto", F.lit(0)).alias("autopayPayments"))
    e = d.employee().select("employeeID", "fName", "lName")
    j2 = da.join(e, "employeeID", "left")
    return j2.select("employeeID", "fName", "lName", "activityDate", "totalDials", "totalContacts",
                     (F.col("totalDials").cast("double") / 8.0).alias("dialsPerHour"),
                     (F.col("totalContacts").cast("double") / 8.0).alias("contactsPerHour"),
                     pct("totalContacts", "totalDials").alias("contactRate"),
                     "paymentsCollected", "amountCollected",
                     (F.col("amountCollected").cast("double") / 8.0).alias("collectedPerHour"),
                     pct("autopayPayments", "paymentsCollected").alias("autopayPercentage"))


def ar_program_performance(d: Domain, as_of=DEFAULT_AS_OF) -> DataFrame:
    """Daily collections (6 months) rolled up per month and office, against
    currently available AR."""
    today = as_date(as_of)
    pm = d.applied_payment().filter(F.col("dateApplied") >= F.add_months(today, -6)) \
        .groupBy(month_start("dateApplied").alias("reportMonth"), "officeID",
                 F.col("dateApplied").alias("collectionDate")) \
        .agg(F.sum("appliedAmount").alias("dailyCollected"))
    aar = open_tickets(d, as_of).groupBy("officeID").agg(F.sum("currentBalance").alias("totalAvailableAR")) \
        .withColumn("reportMonth", month_start(today))
    g = pm.groupBy("reportMonth", "officeID").agg(
        avg_exact("dailyCollected").alias("avgDailyCollected"), F.sum("dailyCollected").alias("monthlyCollected"))
    g = g.join(aar, ["officeID", "reportMonth"], "left")
    return g.select("reportMonth", "officeID", "avgDailyCollected",
                    (F.col("avgDailyCollected") * 5.0).alias("avgWeeklyCollected"), "monthlyCollected",
                    pct("monthlyCollected", "totalAvailableAR").alias("collectedPercentOfAvailable"),
                    "totalAvailableAR",
                    (F.col("monthlyCollected").cast("double") / 5000.0).alias("variableROI"),
                    (F.col("monthlyCollected").cast("double") / 8000.0).alias("totalROI"))


def data_quality_flags(d: Domain, as_of=DEFAULT_AS_OF) -> DataFrame:
    """Seven per-customer data-quality flags and a score (lower is better).
    The cycling check correlates to the outer customer (intended semantics)."""
    today = as_date(as_of)
    c = d.customer()
    pdx = d.payment().filter(F.col("paymentDate") >= F.add_months(today, -6)).groupBy("customerID").agg(
        count_when(F.col("status") == 2).alias("declineCount"))
    ar = open_tickets(d, as_of).groupBy("customerID").agg(F.max("ageDays").alias("maxAgeDays"))
    svc = d.appointment().filter(F.col("status") == 4).groupBy("customerID").agg(
        F.max("dateCompleted").alias("lastServiceDate"))
    svc = svc.withColumn("daysSinceLastService", days_between("lastServiceDate", today))
    c2 = c.select(F.col("customerID").alias("c2_id"), F.col("dateAdded").alias("c2_added"))
    cyc = c.select("customerID", "dateCancelled").filter(F.col("dateCancelled").isNotNull()).join(
        c2, (F.col("c2_id") == F.col("customerID")) & (F.col("c2_added") > F.col("dateCancelled"))
        & (F.col("c2_added") < F.add_months("dateCancelled", 12)), "left_semi") \
        .select("customerID", F.lit(1).alias("_cyc"))
    j = c.join(pdx, "customerID", "left").join(ar, "customerID", "left").join(svc, "customerID", "left") \
        .join(cyc, "customerID", "left")
    addr = F.when(F.col("address").isNull() | F.col("city").isNull() | F.col("state").isNull()
                  | F.col("zip").isNull(), 1).otherwise(0)
    decl = F.when(F.col("declineCount") > 3, 1).otherwise(0)
    aged = F.when(F.col("maxAgeDays") > 180, 1).otherwise(0)
    unsv = F.when((F.col("daysSinceLastService") > 90) & F.col("dateCancelled").isNull(), 1).otherwise(0)
    cycl = F.when(F.col("dateCancelled").isNotNull() & F.col("_cyc").isNotNull(), 1).otherwise(0)
    return j.select("customerID", "officeID", "fName", "lName", "companyName",
                    addr.alias("badAddressFlag"), bad_phone("phone1").alias("badPhoneFlag"),
                    bad_email("email").alias("badEmailFlag"), decl.alias("declineOutlierFlag"),
                    aged.alias("ageOutlierFlag"), unsv.alias("unservicedFlag"), cycl.alias("accountCyclingFlag"),
                    (addr + bad_phone("phone1") + bad_email("email") + decl + aged + unsv).alias("dataQualityScore"))
