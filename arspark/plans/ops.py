"""Field-operations marts: technicians, routes, service types, subscriptions.

Record ids are unique in the entities (``latest_per_key``), so they are counted
plainly; appointments are summed per key before the small side is joined.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arspark.functions.dates import minutes_between
from arspark.plans.common import avg_exact, count_when
from arspark.sources.adapter import Domain


def technician_productivity(d: Domain) -> DataFrame:
    """Appointments, completions, cancellations, minutes and charges per
    technician and day."""
    a = d.appointment().filter(F.col("employeeID").isNotNull())
    e = d.employee().select("employeeID", F.col("fName").alias("techFirstName"), F.col("lName").alias("techLastName"))
    t = d.ticket().select("ticketID", "serviceCharge", "productionValue")
    g = a.join(t, "ticketID", "left").groupBy("employeeID", "appointmentDate").agg(
        F.count("appointmentID").alias("appointmentCount"), count_when(F.col("status") == 4).alias("completedAppointments"),
        count_when(F.col("status") == 6).alias("cancelledAppointments"),
        F.countDistinct("customerID").alias("uniqueCustomers"),
        F.sum("duration").alias("totalScheduledMinutes"), avg_exact("duration").alias("avgScheduledMinutes"),
        F.sum("serviceCharge").alias("totalServiceCharges"), F.sum("productionValue").alias("totalProductionValue"))
    return g.join(e, "employeeID", "left").select(
        "employeeID", "techFirstName", "techLastName", "appointmentDate", *g.columns[2:])


def route_efficiency(d: Domain) -> DataFrame:
    """Stops, distance per stop and actual service minutes per route and day."""
    r = d.route()
    keys = ["routeID", "routeDate", "officeID", "assignedTech", "routeTitle", "totalDistance",
            "appointmentDurationEstimate", "drivingDurationEstimate"]
    stops = d.appointment().groupBy("routeID", F.col("appointmentDate").alias("routeDate")).agg(
        F.count("appointmentID").alias("appointmentCount"), count_when(F.col("status") == 4).alias("completedCount"),
        F.countDistinct("customerID").alias("uniqueCustomers"),
        F.sum(minutes_between("timeIn", "timeOut")).alias("actualServiceMinutes"))
    g = r.select(*keys).join(stops, ["routeID", "routeDate"], "left") \
        .fillna(0, ["appointmentCount", "completedCount", "uniqueCustomers"])
    return g.select(*keys, "appointmentCount", "completedCount", "uniqueCustomers",
                    F.when(F.col("appointmentCount") > 0,
                           F.col("totalDistance").cast("double") / F.col("appointmentCount")).alias("avgDistancePerStop"),
                    "actualServiceMinutes", F.col("appointmentDurationEstimate").alias("estimatedServiceMinutes"))


def service_type_performance(d: Domain) -> DataFrame:
    """Appointments, completion rate and revenue per service type."""
    st = d.service_type()
    a = d.appointment()
    t = d.ticket().select("ticketID", "serviceCharge")
    used = a.join(t, "ticketID", "left").groupBy(F.col("appointmentType").alias("serviceTypeID")).agg(
        F.count("appointmentID").alias("appointmentCount"), count_when(F.col("status") == 4).alias("completedCount"),
        F.countDistinct("customerID").alias("uniqueCustomers"),
        F.sum("serviceCharge").alias("totalRevenue"), avg_exact("serviceCharge").alias("avgServiceCharge"))
    g = st.join(used, "serviceTypeID", "left").fillna(0, ["appointmentCount", "completedCount", "uniqueCustomers"])
    return g.select("serviceTypeID", "officeID", F.col("description").alias("serviceTypeName"), "category",
                    "defaultCharge", "appointmentCount", "completedCount", "uniqueCustomers", "totalRevenue",
                    "avgServiceCharge",
                    (F.col("avgServiceCharge") - F.col("defaultCharge").cast("double")).alias("avgVarianceFromDefault"),
                    F.when(F.col("appointmentCount") > 0, (F.col("completedCount").cast("double") * 100.0) / F.col("appointmentCount"))
                    .otherwise(F.lit(0.0)).alias("completionRate"))


def subscription_performance(d: Domain) -> DataFrame:
    """Subscriptions with their service type (joined on service and office)."""
    s = d.subscription()
    st = d.service_type().select(F.col("serviceTypeID").alias("ServiceID"), F.col("officeID").alias("OfficeID"),
                                 F.col("serviceTypeName").alias("ServiceName"),
                                 F.col("category").alias("ServiceCategory"))
    s = s.select(F.col("subscriptionID").alias("SubscriptionID"), F.col("officeID").alias("OfficeID"),
                 F.col("customerID").alias("CustomerID"), F.col("serviceTypeID").alias("ServiceID"),
                 F.col("billingFrequency").alias("Frequency"), F.col("dateAdded").alias("DateAdded"),
                 F.when(F.col("isActive"), "Active").otherwise("Inactive").alias("SubscriptionStatus"),
                 F.col("recurringCharge").alias("Price"))
    return s.join(st, ["ServiceID", "OfficeID"], "left")
