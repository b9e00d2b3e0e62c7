"""Revenue and payment marts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arspark.functions.dates import days_between, month_end, month_start
from arspark.plans.common import avg_exact, count_when
from arspark.sources.adapter import Domain

# Payment method code -> label.
PAYMENT_METHOD_NAMES = [(1, "Cash"), (2, "Check"), (3, "Credit Card"), (4, "ACH")]


def payment_method_name(code) -> F.Column:
    c = F.col(code) if isinstance(code, str) else code
    expr = None
    for k, label in PAYMENT_METHOD_NAMES:
        expr = F.when(c == k, label) if expr is None else expr.when(c == k, label)
    return expr.otherwise("Other")


def daily_revenue_summary(d: Domain) -> DataFrame:
    """Per office and day: distinct customers/payments, applications, revenue, tax, net."""
    ap = d.applied_payment()
    return ap.groupBy("officeID", F.col("dateApplied").alias("revenueDate")).agg(
        F.countDistinct("customerID").alias("uniqueCustomers"),
        F.countDistinct("paymentID").alias("paymentCount"),
        F.count("appliedPaymentID").alias("applicationCount"),
        F.sum("appliedAmount").alias("totalRevenue"),
        F.sum("taxCollected").alias("totalTax"),
        F.sum(F.col("appliedAmount") - F.col("taxCollected")).alias("netRevenue"))


def payment_method_analysis(d: Domain) -> DataFrame:
    """Counts, amounts, success/failure/write-off by office, month and method."""
    p = d.payment()
    g = p.groupBy("officeID", month_start("paymentDate").alias("paymentMonth"), "paymentMethod").agg(
        F.countDistinct("paymentID").alias("paymentCount"),
        F.countDistinct("customerID").alias("uniqueCustomers"),
        F.sum("amount").alias("totalAmount"), F.sum("appliedAmount").alias("totalApplied"),
        avg_exact("amount").alias("avgPaymentAmount"),
        count_when(F.col("status") == 1).alias("successfulPayments"),
        count_when(F.col("status") == 2).alias("failedPayments"),
        count_when(F.col("writeoff") == F.lit(True)).alias("writeoffs"))
    return g.withColumn("paymentMethodName", payment_method_name("paymentMethod"))


def collection_performance(d: Domain) -> DataFrame:
    """Paying customers, payments and totals per method and month (production
    view; the numeric method code is labelled before the comparison)."""
    p = d.payment().filter(F.col("paymentDate").isNotNull()) \
        .withColumn("methodName", payment_method_name("paymentMethod"))

    def by(label):
        return count_when(F.col("methodName") == label)

    return p.groupBy(month_start("paymentDate").alias("CollectionMonth"), F.col("officeID").alias("OfficeID")).agg(
        F.countDistinct("customerID").alias("PayingCustomers"), F.count("paymentID").alias("TotalPayments"),
        F.sum("amount").alias("TotalCollected"), avg_exact("amount").alias("AvgPaymentAmount"),
        by("Credit Card").alias("CreditCardPayments"), by("Check").alias("CheckPayments"),
        by("Cash").alias("CashPayments"), by("ACH").alias("ACHPayments"))


def payment_velocity(d: Domain) -> DataFrame:
    """Days from invoice (completion) to payment for every application."""
    ap = d.applied_payment().select("appliedPaymentID", "ticketID", "paymentID", "officeID", "appliedAmount")
    t = d.ticket().filter(F.col("status") == "Completed").select("ticketID", "customerID", "completedOn", "total")
    p = d.payment().filter(F.col("paymentDate").isNotNull()).select("paymentID", "paymentDate")
    j = ap.join(t, "ticketID").join(p, "paymentID")
    return j.select(F.col("appliedPaymentID").alias("AppliedPaymentID"), F.col("ticketID").alias("TicketID"),
                    F.col("paymentID").alias("PaymentID"), F.col("officeID").alias("OfficeID"),
                    F.col("customerID").alias("CustomerID"), F.col("completedOn").alias("InvoiceDate"),
                    F.col("paymentDate").alias("PaymentDate"),
                    days_between("completedOn", "paymentDate").alias("DaysToPay"),
                    F.col("appliedAmount").alias("AppliedAmount"), F.col("total").alias("InvoiceAmount"))


def revenue_leakage_prod(d: Domain) -> DataFrame:
    """Completed vs cancelled tickets and revenue per month and office."""
    t = d.ticket()
    done, canc = F.col("status") == "Completed", F.col("status") == "Cancelled"
    g = t.groupBy(month_start("completedOn").alias("ServiceMonth"), F.col("officeID").alias("OfficeID")).agg(
        F.count("ticketID").alias("TotalServices"), count_when(done).alias("CompletedServices"),
        count_when(canc).alias("CancelledServices"),
        F.sum(F.when(done, F.col("total")).otherwise(F.lit(0))).alias("CompletedRevenue"),
        F.sum(F.when(canc, F.col("total")).otherwise(F.lit(0))).alias("LostRevenue"))
    rate = F.when(F.col("TotalServices") > 0,
                  (F.col("CancelledServices").cast("double") / F.col("TotalServices")) * 100.0).otherwise(F.lit(0.0))
    return g.withColumn("CancellationRate", rate)


def revenue_by_ticket(d: Domain) -> DataFrame:
    """Per active ticket: coupon (method 0) vs revenue (method > 0) split of
    applied payments, invoiced service/tax, revenue and balances.

    Join shape as written: the LEFT join to applications followed by an INNER
    join to payments drops tickets without a payment."""
    t = d.ticket().filter(F.col("isActive") == F.lit(True))
    a = d.appointment().select(F.col("ticketID"), F.col("subscriptionID").alias("a_sub"))
    s = d.subscription().select(F.col("subscriptionID").alias("a_sub"), F.col("subscriptionID"))
    st = d.service_type().select(F.col("serviceTypeID").alias("serviceID"), F.col("description").alias("service_type"))
    ap = d.applied_payment().select("ticketID", "paymentID", "taxCollected", "appliedAmount")
    p = d.payment().select("paymentID", "paymentMethod")
    j = t.join(a, "ticketID", "left").join(s, "a_sub", "left").join(st, "serviceID", "inner") \
        .join(ap, "ticketID", "left").join(p, "paymentID", "inner")
    svc = F.when((F.col("serviceCharge") == 0) & ((F.col("total") - F.col("taxAmount")) > 0),
                 F.col("total") - F.col("taxAmount")).otherwise(F.col("serviceCharge"))
    coupon, paid = F.col("paymentMethod") == 0, F.col("paymentMethod") > 0
    g = j.groupBy("ticketID", "customerID", "subscriptionID", "officeID", "invoiceDate",
                  month_start("invoiceDate").alias("month_start"), month_end("invoiceDate").alias("month_end"),
                  svc.alias("svccharge"), "taxAmount", "total", "isActive", "service_type").agg(
        F.coalesce(F.sum(F.when(coupon, F.col("taxCollected"))) * -1, F.lit(0)).alias("tax_couponed"),
        F.coalesce(F.sum(F.when(coupon, F.col("appliedAmount"))) * -1, F.lit(0)).alias("_applied_couponed"),
        F.coalesce(F.sum(F.when(paid, F.col("taxCollected"))), F.lit(0)).alias("tax_revenue"),
        F.coalesce(F.sum(F.when(paid, F.col("appliedAmount"))), F.lit(0)).alias("_applied_revenue"))
    g = g.withColumn("invoice_couponed", F.col("_applied_couponed") - F.col("tax_couponed")) \
        .withColumn("service_revenue", F.col("_applied_revenue") - F.col("tax_revenue")) \
        .withColumn("service_invoiced", F.col("svccharge") + F.col("invoice_couponed")) \
        .withColumn("tax_invoiced", F.col("taxAmount") + F.col("tax_couponed")) \
        .withColumn("service_balance", F.col("service_invoiced") - F.col("service_revenue")) \
        .withColumn("tax_balance", F.col("tax_invoiced") - F.col("tax_revenue"))
    return g.drop("_applied_couponed", "_applied_revenue")
