"""Customer marts: lifetime value, acquisition, cancellations, recurring revenue."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arspark.functions.dates import days_between, month_start, months_between_boundaries
from arspark.operators.latest import exact_median
from arspark.plans.common import as_date, avg_exact, count_when
from arspark.sources.adapter import Domain

ORDERS_AS_OF = "2001-08-01"
EVENTS_AS_OF = "2024-01-31"

# Billing frequency (months per bill) -> divisor to a monthly amount.
BILLING_FREQUENCIES = [1, 3, 6, 12]


def customer_lifetime_value(d: Domain, as_of=ORDERS_AS_OF) -> DataFrame:
    """Tenure, lifetime revenue and payments, service counts per customer.
    Both sides are aggregated per customer before the joins."""
    today = as_date(as_of)
    c = d.customer()
    rev = d.applied_payment().groupBy("customerID").agg(
        F.sum("appliedAmount").alias("totalRevenue"), F.countDistinct("paymentID").alias("paymentCount"),
        F.min("dateApplied").alias("firstPaymentDate"), F.max("dateApplied").alias("lastPaymentDate"))
    svc = d.appointment().groupBy("customerID").agg(
        count_when(F.col("status") == 4).alias("completedServices"),
        count_when(F.col("status") == 6).alias("cancelledServices"),
        F.max(F.when(F.col("status") == 4, F.col("dateCompleted"))).alias("lastServiceDate"))
    j = c.join(rev, "customerID", "left").join(svc, "customerID", "left")
    end = F.coalesce(F.col("dateCancelled"), today)
    months = months_between_boundaries("dateAdded", end)
    lifetime = F.coalesce(F.col("totalRevenue"), F.lit(0))
    return j.select(
        "customerID", "officeID", "fName", "lName", "companyName", "dateAdded", "dateCancelled", "status", "regionID",
        days_between("dateAdded", end).alias("customerTenureDays"), months.alias("customerTenureMonths"),
        lifetime.alias("lifetimeRevenue"), F.coalesce(F.col("paymentCount"), F.lit(0)).alias("lifetimePayments"),
        F.coalesce(F.col("firstPaymentDate"), F.col("dateAdded")).alias("firstPaymentDate"),
        F.coalesce(F.col("lastPaymentDate"), F.col("dateAdded")).alias("lastPaymentDate"),
        F.when(months > 0, lifetime.cast("double") / months).otherwise(F.lit(0.0)).alias("avgMonthlyRevenue"),
        F.coalesce(F.col("completedServices"), F.lit(0)).alias("completedServices"),
        F.coalesce(F.col("cancelledServices"), F.lit(0)).alias("cancelledServices"),
        "lastServiceDate")


def customer_lifetime_value_prod(d: Domain, as_of=ORDERS_AS_OF) -> DataFrame:
    """Tickets, revenue, outstanding balance and tenure per customer."""
    today = as_date(as_of)
    c = d.customer().drop("balance")
    t = d.ticket().select("customerID", "ticketID", "total", "balance")
    g = c.join(t, "customerID", "left").groupBy(
        "customerID", "officeID", "fName", "lName", "companyName", "dateAdded", "dateCancelled", "status").agg(
        F.countDistinct("ticketID").alias("TotalTickets"), F.sum("total").alias("LifetimeRevenue"),
        F.sum("balance").alias("OutstandingBalance"), avg_exact("total").alias("AvgTicketValue"))
    return g.select(
        F.col("customerID").alias("CustomerID"), F.col("officeID").alias("OfficeID"),
        F.concat(F.col("fName"), F.lit(" "), F.col("lName")).alias("CustomerName"),
        F.col("companyName").alias("CompanyName"), F.col("dateAdded").alias("DateAdded"),
        F.col("dateCancelled").alias("DateCancelled"), F.col("status").alias("Status"),
        "TotalTickets", "LifetimeRevenue", "OutstandingBalance", "AvgTicketValue",
        months_between_boundaries("dateAdded", F.coalesce(F.col("dateCancelled"), today)).alias("TenureMonths"))


def customer_cancellation_reasons_fact(d: Domain) -> DataFrame:
    """(office, customer, reason) rows: reason-id arrays exploded, described by
    the (fixed-size, broadcast) reason dimension, unknown ids labelled."""
    ids = d.customer_cancellation_reason_ids()
    ex = ids.filter(F.size("cancellationReasonIDs") > 0).select(
        "officeID", "customerID", "dateCancelled", F.explode("cancellationReasonIDs").alias("reasonID"))
    dim = F.broadcast(d.cancellation_reason())
    j = ex.join(dim, "reasonID", "left")
    return j.select(F.col("officeID").alias("OfficeID"), F.col("customerID").alias("CustomerID"),
                    F.col("reasonID").alias("CancellationReasonID"),
                    F.coalesce(F.col("description"), F.lit("Unknown Reason")).alias("CancellationReasonDescription"),
                    F.col("dateCancelled").alias("DateCancelled")).dropDuplicates()


def customer_cancellation_reasons_view(d: Domain) -> DataFrame:
    """The fact joined to its customer, with lifetime days."""
    f = customer_cancellation_reasons_fact(d)
    c = d.customer().select(F.col("customerID").alias("CustomerID"), "fName", "lName", "companyName", "regionID",
                            "dateAdded")
    j = f.join(c, "CustomerID", "left")
    return j.select("OfficeID", "CustomerID", "CancellationReasonID", "CancellationReasonDescription", "DateCancelled",
                    "fName", "lName", "companyName", "regionID",
                    days_between("dateAdded", "DateCancelled").alias("customerLifetimeDays"))


def cancellation_analysis(d: Domain, as_of=ORDERS_AS_OF) -> DataFrame:
    """Cancelled customers, lifetime days and lost revenue by month and reason."""
    ccr = customer_cancellation_reasons_view(d)
    clv = customer_lifetime_value(d, as_of).select(F.col("customerID").alias("CustomerID"), "lifetimeRevenue",
                                                   "avgMonthlyRevenue")
    j = ccr.join(clv, "CustomerID", "left")
    n_mrr = F.count("avgMonthlyRevenue")
    return j.groupBy("OfficeID", month_start("DateCancelled").alias("cancellationMonth"), "CancellationReasonID",
                     "CancellationReasonDescription").agg(
        F.countDistinct("CustomerID").alias("cancelledCustomers"),
        avg_exact("customerLifetimeDays").alias("avgLifetimeDays"),
        F.sum("lifetimeRevenue").alias("totalLostRevenue"), avg_exact("lifetimeRevenue").alias("avgCustomerValue"),
        F.when(n_mrr > 0, F.sum("avgMonthlyRevenue") / n_mrr).alias("avgMonthlyRevenueLost"))


def customer_acquisition(d: Domain) -> DataFrame:
    """New customers per office, month and source; revenue conversion, days to
    first payment and first-month revenue.

    First-month revenue is computed with two partial aggregations - per
    (customer, month) then ``min_by`` per customer - instead of a window over
    each customer's payments, so a customer with a huge payment history never
    lands in one task."""
    c = d.customer()
    cs = F.broadcast(d.customer_source().select("sourceID", "sourceName"))
    ap = d.applied_payment()
    pm = ap.groupBy("customerID", month_start("dateApplied").alias("m")).agg(
        F.min("dateApplied").alias("firstInMonth"), F.sum("appliedAmount").alias("monthRevenue"))
    rev = pm.groupBy("customerID").agg(F.min("firstInMonth").alias("firstPaymentDate"),
                                       F.min_by("monthRevenue", "m").alias("firstMonthRevenue")) \
        .withColumn("hasRevenue", F.lit(1))
    j = c.join(cs, "sourceID", "left").join(rev, "customerID", "left")
    days = days_between("dateAdded", "firstPaymentDate")
    return j.groupBy("officeID", month_start("dateAdded").alias("acquisitionMonth"), "sourceID", "source",
                     "sourceName").agg(
        F.countDistinct("customerID").alias("newCustomers"),
        F.countDistinct(F.when(F.col("hasRevenue").isNotNull(), F.col("customerID"))).alias("customersWithRevenue"),
        avg_exact(days).alias("avgDaysToFirstPayment"),
        F.sum("firstMonthRevenue").alias("totalFirstMonthRevenue"),
        avg_exact("firstMonthRevenue").alias("avgFirstMonthRevenue"))


def monthly_recurring_revenue(d: Domain, as_of=EVENTS_AS_OF) -> DataFrame:
    """Active subscriptions normalised to a monthly amount: total, average and
    median per office.

    The total is the exact DECIMAL sum per billing frequency divided once, so
    it does not depend on the order rows are summed in."""
    s = d.subscription().filter(F.col("isActive") == F.lit(True))
    f = F.col("billingFrequency")
    known = f.isin(BILLING_FREQUENCIES)
    div = F.when(known, f).otherwise(F.lit(1))
    s = s.withColumn("monthlyValue", F.col("recurringCharge").cast("double") / div)
    aggs = [F.sum(F.when(f == k if k != 1 else (f == 1) | ~known, F.col("recurringCharge"))).alias(f"_s{k}")
            for k in BILLING_FREQUENCIES]
    g = s.groupBy("officeID").agg(
        F.countDistinct("customerID").alias("activeCustomers"),
        F.countDistinct("subscriptionID").alias("activeSubscriptions"),
        F.count("monthlyValue").alias("_n"), *aggs)
    g = g.join(exact_median(s, ["officeID"], "monthlyValue", "medianMRR"), "officeID", "left")
    total = None
    for k in BILLING_FREQUENCIES:
        part = F.coalesce(F.col(f"_s{k}").cast("double") / F.lit(float(k)), F.lit(0.0))
        total = part if total is None else total + part
    return g.select("officeID", month_start(as_date(as_of)).alias("mrrMonth"), "activeCustomers",
                    "activeSubscriptions", total.alias("totalMRR"),
                    F.when(F.col("_n") > 0, total / F.col("_n")).alias("avgMRR"), "medianMRR")
