"""Domain entities (tickets, payments, customers, ...) over the driver tables.

The warehouse the marts were written for is not available, so every entity is
derived from the TPC-H-like driver tables with plain DataFrame transformations.
The mapping is fixed and documented in FIXTURES.md section 4; each entity is a
lazy DataFrame, built once per :class:`Domain` so plans that use an entity twice
share one sub-plan (Spark's exchange reuse then computes it once).

Scale notes
-----------
* ``applied_payment`` is the only entity over ``lineitem``; its dedupe is a
  key-partitioned window with a partial group limit before the shuffle.
* dimension-like entities over ``nation``/``region`` have a fixed, tiny row
  count and are broadcast by the marts; everything else is left to AQE, which
  only broadcasts a side after measuring it (autoBroadcastJoinThreshold) and
  otherwise keeps the sort-merge join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arspark.operators.latest import latest_per_key
from arspark.sources.tables import Tables

E = F.expr

# Labels of the lookup dimensions (id -> label).
CUSTOMER_SOURCE_NAMES = [(1, "Auto dealers"), (2, "Builders"), (3, "Furniture stores"), (4, "Door to door"),
                         (5, "Trade shows")]
CANCELLATION_REASON_NAMES = [(1, "Moved"), (2, "Price too high")]


def _label(col, pairs):
    expr = None
    for k, v in pairs:
        expr = F.when(col == k, v) if expr is None else expr.when(col == k, v)
    return expr


class Domain:
    """Entity DataFrames derived from the driver tables (built lazily, once for each instance)."""

    def __init__(self, tables: Tables):
        self.t = tables
        self._memo: dict[str, DataFrame] = {}

    @classmethod
    def of(cls, tables: Tables) -> "Domain":
        return cls(tables)

    def persist(self, *names: str) -> "Domain":
        """Keep entities that several marts of one dashboard read (memory, then
        local disk). A lost block is recomputed from its lineage, so this is a
        cache, not a durability point; call :meth:`unpersist` when done."""
        from pyspark import StorageLevel
        for n in names or ("applied_payment", "payment", "ticket", "customer"):
            self._memo[n] = getattr(self, n)().persist(StorageLevel.MEMORY_AND_DISK)
        return self

    def unpersist(self) -> None:
        for df in self._memo.values():
            df.unpersist()

    def _get(self, name, build):
        if name not in self._memo:
            self._memo[name] = build()
        return self._memo[name]

    # ------------------------------------------------------------------ facts
    def applied_payment(self) -> DataFrame:
        return self._get("applied_payment", self._applied_payment)

    def _applied_payment(self) -> DataFrame:
        t = self.t
        # One shuffle of lineitem by order key serves both the version dedupe
        # (clustered on (orderkey, linenumber), satisfied by hash(orderkey)) and
        # the join to orders; orders+customer are joined first (orders-sized
        # shuffles only). An order has at most 7 lines, so no partition is hot.
        li = t.lineitem.repartition("l_orderkey")
        li = latest_per_key(li, ["l_orderkey", "l_linenumber"], "l_shipdate",
                            tie_breakers=["l_partkey", "l_suppkey", "l_extendedprice"])
        oc = t.orders.select("o_orderkey", "o_custkey").join(
            t.customer.select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
        j = li.join(oc, F.col("l_orderkey") == F.col("o_orderkey"))
        net = E("CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))")
        return j.select(
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("appliedPaymentID"),
            (F.col("l_orderkey") * 10 + F.col("l_linenumber") % 3).alias("paymentID"),
            F.col("l_orderkey").alias("ticketID"),
            F.col("o_custkey").alias("customerID"),
            F.col("c_nationkey").alias("officeID"),
            F.col("l_suppkey").alias("appliedByEmployeeID"),
            F.to_date("l_shipdate").alias("dateApplied"),
            net.cast("decimal(18,2)").alias("appliedAmount"),
            (net * E("CAST(l_tax AS DECIMAL(4,2))")).cast("decimal(18,2)").alias("taxCollected"),
            F.col("l_partkey").alias("serviceID"),
            (F.col("l_linenumber") % 5).alias("lineMethod"),
            "l_returnflag", "l_linestatus",
        )

    def payment(self) -> DataFrame:
        return self._get("payment", self._payment)

    def _payment(self) -> DataFrame:
        ap = self.applied_payment()
        g = ap.groupBy("paymentID").agg(
            F.min("customerID").alias("customerID"),
            F.min("officeID").alias("officeID"),
            F.min("dateApplied").alias("paymentDate"),
            F.sum("appliedAmount").alias("amount"),
            F.min("lineMethod").alias("paymentMethod"),
            F.min("l_returnflag").alias("_rf"),
            F.min("l_linestatus").alias("_ls"),
            F.min("appliedByEmployeeID").alias("employeeID"),
        )
        return g.select(
            "paymentID", "customerID", "officeID", "paymentDate", "amount",
            F.col("amount").alias("appliedAmount"), "paymentMethod",
            F.when(F.col("_rf") == "A", 1).when(F.col("_rf") == "R", 2).otherwise(3).alias("status"),
            ((F.col("_ls") == "F") & (F.col("_rf") == "R")).alias("writeoff"),
            F.when(F.col("paymentMethod") == 3, "Visa").otherwise("None").alias("cardType"),
            "employeeID",
        )

    def ticket(self) -> DataFrame:
        return self._get("ticket", self._ticket)

    def _ticket(self) -> DataFrame:
        t = self.t
        svc = t.lineitem.groupBy("l_orderkey").agg(F.min("l_partkey").alias("serviceID"))
        o = t.orders.join(t.customer.select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
        o = o.join(svc, F.col("o_orderkey") == svc.l_orderkey, "left")
        tot = E("CAST(o_totalprice AS DECIMAL(18,2))")
        return o.select(
            F.col("o_orderkey").alias("ticketID"),
            F.col("o_custkey").alias("customerID"),
            F.col("c_nationkey").alias("officeID"),
            F.to_date("o_orderdate").alias("invoiceDate"),
            F.to_date("o_orderdate").alias("completedOn"),
            "serviceID",
            tot.alias("total"),
            E("CAST(CAST(o_totalprice AS DECIMAL(18,2)) * 1.08 AS DECIMAL(18,2))").alias("subtotal"),
            E("CAST(CAST(o_totalprice AS DECIMAL(18,2)) * 0.05 AS DECIMAL(18,2))").alias("taxAmount"),
            E("CAST(CAST(o_totalprice AS DECIMAL(18,2)) * 0.9 AS DECIMAL(18,2))").alias("serviceCharge"),
            E("CAST(CAST(o_totalprice AS DECIMAL(18,2)) * 0.8 AS DECIMAL(18,2))").alias("productionValue"),
            E("CAST(CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN CAST(o_totalprice AS DECIMAL(18,2)) "
              "ELSE CAST(o_totalprice AS DECIMAL(18,2)) * 0.5 END AS DECIMAL(18,2))").alias("balance"),
            (F.col("o_orderpriority") != "5-LOW").alias("isActive"),
            F.when(F.col("o_orderpriority") == "5-LOW", "Cancelled").otherwise("Completed").alias("status"),
        )

    def appointment(self) -> DataFrame:
        return self._get("appointment", self._appointment)

    def _appointment(self) -> DataFrame:
        ev = self.t.events.filter(F.col("event_type").isin("click", "error", "view"))
        status = F.when(F.col("event_type") == "click", 4).when(F.col("event_type") == "error", 6).otherwise(1)
        return ev.select(
            F.col("event_id").alias("appointmentID"),
            F.col("user_id").alias("customerID"),
            (F.col("event_id") % 50).alias("employeeID"),
            (F.col("event_id") % 20).alias("routeID"),
            F.col("event_id").alias("ticketID"),
            (F.col("event_id") + 1).alias("subscriptionID"),
            (F.col("event_id") % 200 + 1).alias("appointmentType"),
            F.to_date("ts").alias("appointmentDate"),
            F.col("ts").alias("timeIn"),
            E("timestampadd(MINUTE, CAST(event_id % 90 AS INT), ts)").alias("timeOut"),
            (F.col("event_id") % 60 + 30).alias("duration"),
            status.alias("status"),
            F.when(status == 4, F.col("ts")).alias("dateCompleted"),
        )

    def subscription(self) -> DataFrame:
        return self._get("subscription", self._subscription)

    def _subscription(self) -> DataFrame:
        ev = self.t.events.filter(F.col("event_type") == "signup")
        return ev.select(
            F.col("event_id").alias("subscriptionID"),
            F.col("user_id").alias("customerID"),
            (F.col("user_id") % 25).cast("int").alias("officeID"),
            (F.col("event_id") % 200 + 1).alias("serviceTypeID"),
            E("CAST(value AS DECIMAL(18,2))").alias("recurringCharge"),
            E("CASE event_id % 4 WHEN 0 THEN 1 WHEN 1 THEN 3 WHEN 2 THEN 6 ELSE 12 END").alias("billingFrequency"),
            (F.col("event_id") % 10 != 0).alias("isActive"),
            F.to_date("ts").alias("dateAdded"),
        )

    def note(self) -> DataFrame:
        return self._get("note", lambda: self.t.orders.select(
            F.col("o_orderkey").alias("noteID"),
            E("(o_orderkey div 7) % 100").alias("employeeID"),  # an employee makes notes of every type
            F.col("o_custkey").alias("customerID"),
            (F.col("o_orderkey") % 5 + 1).alias("typeID"),
            F.col("o_orderdate").alias("dateCreated"),
        ))

    def route(self) -> DataFrame:
        return self._get("route", self._route)

    def _route(self) -> DataFrame:
        ev = self.t.events.select((F.col("event_id") % 20).alias("routeID"),
                                  F.to_date("ts").alias("routeDate"),
                                  E("CAST(value AS DECIMAL(18,2))").alias("v"))
        g = ev.groupBy("routeID", "routeDate").agg(F.sum("v").alias("totalDistance"),
                                                   F.count(F.lit(1)).alias("n"))
        return g.select(
            "routeID", "routeDate",
            (F.col("routeID") % 5).cast("int").alias("officeID"),
            (F.col("routeID") + 1).alias("assignedTech"),
            F.concat(F.lit("Route "), F.col("routeID").cast("string")).alias("routeTitle"),
            F.col("totalDistance").cast("decimal(18,2)").alias("totalDistance"),
            (F.col("n") * 30).alias("appointmentDurationEstimate"),
            (F.col("n") * 10).alias("drivingDurationEstimate"),
        )

    def payment_profile(self) -> DataFrame:
        return self._get("payment_profile", lambda: self.t.customer.select(
            F.col("c_custkey").alias("paymentProfileID"),
            F.col("c_custkey").alias("customerID"),
            (F.col("c_custkey") % 4).alias("failedAttempts"),
            F.when(F.col("c_custkey") % 3 == 0, "insufficient_funds")
             .when(F.col("c_custkey") % 3 == 1, "expired_card").alias("lastDeclineType"),
            (F.col("c_custkey") % 5).alias("retryPoints"),
        ))

    def customer(self) -> DataFrame:
        return self._get("customer", self._customer)

    def _customer(self) -> DataFrame:
        t = self.t
        d = t.orders.groupBy("o_custkey").agg(F.to_date(F.min("o_orderdate")).alias("dateAdded"),
                                              F.to_date(F.max("o_orderdate")).alias("lastDate"))
        n = F.broadcast(t.nation.select("n_nationkey", "n_name", "n_regionkey"))
        c = t.customer.join(n, F.col("c_nationkey") == F.col("n_nationkey")) \
            .join(d, F.col("c_custkey") == d.o_custkey, "left")
        k = F.col("c_custkey")
        digits = F.lpad((k % 10000).cast("string"), 4, "0")
        handle = F.lower(F.regexp_replace(F.col("c_name"), "#", ""))
        return c.select(
            k.alias("customerID"),
            F.col("c_nationkey").alias("officeID"),
            F.col("n_regionkey").alias("regionID"),
            F.col("c_name").alias("fName"),
            F.when(k % 9 != 0, F.concat(F.lit("Family "), (k % 97).cast("string"))).alias("lName"),
            F.when(F.col("c_mktsegment") == "BUILDING", F.col("c_name")).alias("companyName"),
            F.col("c_acctbal").cast("decimal(18,2)").alias("balance"),
            F.col("c_mktsegment").alias("source"),
            E("CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 1 WHEN 'BUILDING' THEN 2 WHEN 'FURNITURE' THEN 3 "
              "WHEN 'HOUSEHOLD' THEN 4 ELSE 5 END").alias("sourceID"),
            "dateAdded",
            F.when(F.col("c_acctbal") < 0, F.col("lastDate")).alias("dateCancelled"),
            F.when(F.col("c_acctbal") < 0, 0).otherwise(1).alias("status"),
            F.when(k % 4 == 0, F.lit(None).cast("string"))
             .when(k % 4 == 1, F.concat(F.lit("555-"), digits))
             .otherwise(F.concat(F.lit("(206) 555-"), digits)).alias("phone1"),
            F.when(k % 5 == 0, F.lit(None).cast("string"))
             .when(k % 5 == 1, handle)
             .otherwise(F.concat(handle, F.lit("@example.com"))).alias("email"),
            F.concat(F.col("c_name"), F.lit(" Main St")).alias("address"),
            F.col("n_name").alias("city"),
            F.when(k % 6 == 0, F.lit(None).cast("string")).otherwise(F.substring("n_name", 1, 2)).alias("state"),
            F.lpad((k % 100000).cast("string"), 5, "0").alias("zip"),
            F.when(k % 3 == 0, k).alias("autopayPaymentProfileID"),
        )

    # ------------------------------------------------------------ dimensions
    def service_type(self) -> DataFrame:
        return self._get("service_type", lambda: self.t.part.select(
            F.col("p_partkey").alias("serviceTypeID"),
            (F.col("p_partkey") % 25).cast("int").alias("officeID"),
            F.col("p_name").alias("serviceTypeName"),
            F.col("p_name").alias("description"),
            F.col("p_type").alias("category"),
            F.col("p_retailprice").cast("decimal(18,2)").alias("defaultCharge"),
        ))

    def office(self) -> DataFrame:
        return self._get("office", lambda: self.t.nation.select(
            F.col("n_nationkey").alias("officeID"),
            F.col("n_name").alias("officeName"),
            F.col("n_regionkey").alias("regionID"),
        ))

    def region(self) -> DataFrame:
        return self._get("region", lambda: self.t.region.select(
            F.col("r_regionkey").alias("regionID"), F.col("r_name").alias("regionName")))

    def employee(self) -> DataFrame:
        return self._get("employee", lambda: self.t.supplier.select(
            F.col("s_suppkey").alias("employeeID"),
            F.col("s_name").alias("fName"),
            F.when(F.col("s_suppkey") % 7 != 0, F.concat(F.lit("Crew "), (F.col("s_suppkey") % 13).cast("string"))).alias("lName"),
            F.col("s_nationkey").alias("officeID"),
        ))

    def customer_source(self) -> DataFrame:
        """Sources present among customers (at most 5 rows: the source id is a
        5-way CASE of the market segment)."""
        def build():
            c = self.customer().groupBy("sourceID").agg(F.min("source").alias("source"))
            return c.select("sourceID", "source",
                            _label(F.col("sourceID"), CUSTOMER_SOURCE_NAMES).alias("sourceName"))
        return self._get("customer_source", build)

    def cancellation_reason(self) -> DataFrame:
        """Known cancellation reasons that occur in the data (at most 2 rows)."""
        def build():
            ids = self.customer_cancellation_reason_ids().select(F.explode("cancellationReasonIDs").alias("reasonID"))
            known = ids.filter(F.col("reasonID").isin([k for k, _ in CANCELLATION_REASON_NAMES])).distinct()
            return known.select("reasonID", _label(F.col("reasonID"), CANCELLATION_REASON_NAMES).alias("description"))
        return self._get("cancellation_reason", build)

    def customer_cancellation_reason_ids(self) -> DataFrame:
        """Cancelled customers with their reason-id array (1 + custkey % 3, and
        a second reason for every other customer)."""
        c = self.customer().filter(F.col("dateCancelled").isNotNull())
        k = F.col("customerID")
        ids = F.when(k % 2 == 0, F.array(k % 3 + 1, F.lit(3).cast("bigint"))).otherwise(F.array(k % 3 + 1))
        return c.select("officeID", "customerID", "dateCancelled", ids.alias("cancellationReasonIDs"))
