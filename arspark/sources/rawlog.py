"""Raw JSON logs derived from the driver tables.

The pipeline starts from landed API records. For tests and benchmarks those
records are produced from the driver tables with Spark itself: each entity row
is serialised to JSON and landed twice - a stale version and the current one a
bit later - so staging has real versions to resolve. ``lineitem`` is already a
re-load log and is landed as is. A few stale records are truncated to invalid
JSON to exercise the quarantine. Everything scales with the input tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, TimestampNTZType, TimestampType

from arspark.operators.spec import Col, EntitySpec
from arspark.sources.adapter import Domain
from arspark.sources.columns import further

FIXED_LOAD = "2001-08-01 03:00:00"


def _fmt(c: Column, dtype) -> Column:
    """Dates/timestamps as the API's text formats (keeps microseconds)."""
    if isinstance(dtype, (TimestampNTZType, TimestampType)):
        return F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    if isinstance(dtype, DateType):
        return F.date_format(c, "yyyy-MM-dd")
    return c


def _jsonable(df: DataFrame, skip=()) -> list[Column]:
    return [_fmt(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in df.schema.fields
            if f.name not in skip and not f.name.startswith("__")]


def two_versions(df: DataFrame, load: Column, stale: dict[str, Column], office: Column | None = None,
                 corrupt: Column | None = None, lag: Column | None = None,
                 other: tuple[Column, dict[str, str]] | None = None) -> DataFrame:
    """Land every row twice in one pass over ``df``: the stale version
    (``stale`` overrides) at ``load`` and the current version at ``load + lag``.
    Stale rows flagged by ``corrupt`` are landed as truncated, unparsable text.

    Callers deal the records out by key (:func:`dealt`) before they widen them. ``other``: (which
    rows, names) of records that spell some of their fields otherwise."""
    lag = lag if lag is not None else F.expr("INTERVAL 1 DAY")
    office = office if office is not None else (F.col("officeID") if "officeID" in df.columns else F.lit(0))
    payload = [f.name for f in df.schema.fields if not f.name.startswith("__")]
    d2 = df.withColumn("__office", office).withColumn("__load", load.cast("timestamp_ntz"))
    d2 = d2.withColumn("__corrupt", F.lit(False) if corrupt is None else corrupt)
    cond, names = other or (F.lit(False), {})
    d2 = d2.withColumn("__other", cond)
    for k, v in stale.items():
        d2 = d2.withColumn(f"__st_{k}", v)
    types = {f.name: f.dataType for f in d2.schema.fields}

    def record(old: bool, spelled: dict[str, str]) -> Column:
        held = [(f"__st_{f}" if old and f in stale else f, f) for f in payload]
        return F.to_json(F.struct(*[_fmt(F.col(f"`{c}`"), types[c]).alias(spelled.get(f, f)) for c, f in held]))

    def text(old: bool) -> Column:
        return F.when(F.col("__other"), record(old, names)).otherwise(record(old, {})) if other else record(old, {})
    before = text(True) if corrupt is None else F.when(F.col("__corrupt"), F.left(text(True), F.lit(20))).otherwise(text(True))
    versions = F.array(F.struct((F.col("__load") + lag).alias("l"), text(False).alias("j")),
                       F.struct(F.col("__load").alias("l"), before.alias("j")))
    return d2.select(F.col("__office").cast("bigint").alias("OfficeID"), F.explode(versions).alias("__v")) \
        .select("OfficeID", F.col("__v.l").cast("timestamp_ntz").alias("LoadDatetimeUTC"),
                F.col("__v.j").alias("RawDataString"))


def dealt(df: DataFrame, key: str, parts: int | None = None) -> DataFrame:
    """Rows dealt out by key, as the driver's tables are a single row group each and would become text in
    one task. This comes before the records get their further fields, which then aren't shuffled.
    ``parts``: into so many partitions (default: the session's number)."""
    return df.repartition(parts, key) if parts else df.repartition(key)


def _further_value(kind: str, field: str, k: Column) -> Column:
    """Value of a record's further field: follows the record's id and the field's name."""
    n = len(field)
    if field == "officeID":
        return k % 25
    none = k % 10 == 3  # every tenth time is the source's marker of no time
    later = lambda unit: F.lit("2001-01-01").cast("timestamp_ntz") + F.make_interval(**{unit: (k % 1000 + n).cast("int")})
    shown = lambda unit: F.date_format(later(unit), "yyyy-MM-dd HH:mm:ss")
    text = F.concat(F.lit(f"{field.lower()}-"), (k % 7).cast("string"))
    return {
        "n": lambda: k * n % 997, "s": lambda: text, "x": lambda: text, "b": lambda: (k + n) % 2 == 0,
        "t": lambda: F.when(none, F.lit("0000-00-00 00:00:00")).otherwise(shown("hours")),
        "d": lambda: F.when(none, F.lit("0000-00-00")).otherwise(F.left(shown("days"), F.lit(10))),
        "o": lambda: F.when(none, F.lit("")).otherwise(shown("mins")),
        "f": lambda: (k * n % 180 - 90).cast("double") + 0.25, "a": lambda: F.array(k % 50, F.lit(n).cast("bigint")),
    }[kind]()


def with_further(df: DataFrame, entity: str, key: str) -> DataFrame:
    """Records with the fields that the domain adapter, which serves the marts, doesn't have."""
    k = F.col(key).cast("bigint")
    return df.select("*", *(_further_value(kind, f, k).alias(f) for _, kind, f in further(entity) if f not in df.columns))


def raw_applied_payment(d: Domain) -> DataFrame:
    """The lineitem re-load log as applied-payment records (all versions)."""
    t = d.t
    # orders+customer first (orders-sized shuffles), then one lineitem shuffle by order key
    oc = t.orders.select("o_orderkey", "o_custkey").join(t.customer.select("c_custkey", "c_nationkey"),
                                                         F.col("o_custkey") == F.col("c_custkey"))
    # dealt out by order, as all of its lines would else become text in one task
    li = t.lineitem.repartition("l_orderkey").join(oc, F.col("l_orderkey") == F.col("o_orderkey"))
    net = F.expr("CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))")
    rec = li.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("appliedPaymentID"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber") % 3).alias("paymentID"),
        F.col("l_orderkey").alias("ticketID"), F.col("o_custkey").alias("customerID"),
        F.col("c_nationkey").alias("officeID"), F.col("l_suppkey").alias("appliedBy"),
        F.col("l_shipdate").alias("dateApplied"), net.cast("decimal(18,2)").alias("appliedAmount"),
        (net * F.expr("CAST(l_tax AS DECIMAL(4,2))")).cast("decimal(18,2)").alias("taxCollected"),
        F.col("l_partkey").alias("serviceID"), F.col("l_extendedprice").cast("decimal(18,2)").alias("listPrice"),
        F.col("l_shipdate").alias("__load"))
    rec = with_further(rec, "applied_payment", "appliedPaymentID")
    return rec.select(F.col("officeID").cast("bigint").alias("OfficeID"),
                   F.col("__load").cast("timestamp_ntz").alias("LoadDatetimeUTC"),
                   F.to_json(F.struct(*[F.col(c) if c != "dateApplied" else
                                        F.date_format("dateApplied", "yyyy-MM-dd HH:mm:ss").alias("dateApplied")
                                        for c in rec.columns if c != "__load"])).alias("RawDataString"))


def ticket_items(d: Domain) -> DataFrame:
    """Invoice lines per ticket, ordered by line. A ticket has at most seven
    lines (line numbers 1-7), so the per-ticket list has a fixed bound."""
    ap = d.applied_payment()
    item = F.struct((F.col("appliedPaymentID") % 10).alias("line"),
                    F.concat(F.lit("Service "), F.col("serviceID").cast("string")).alias("description"),
                    F.lit(1).alias("quantity"), F.col("appliedAmount").alias("rate"),
                    F.col("appliedAmount").alias("amount"), (F.col("taxCollected") > 0).alias("taxable"),
                    F.col("serviceID").alias("productID"), F.col("officeID").cast("bigint").alias("glAccountID"))
    return ap.groupBy("ticketID").agg(F.array_sort(F.collect_list(item)).alias("items"))


def raw_ticket(d: Domain, parts: int | None = None) -> DataFrame:
    t = d.ticket().join(ticket_items(d), "ticketID", "left") \
        .withColumnRenamed("isActive", "active")
    t = with_further(with_further(dealt(t, "ticketID", parts), "ticket", "ticketID"), "ticket_item", "ticketID")
    return two_versions(t, F.col("invoiceDate"), {"balance": F.col("total"), "status": F.lit("Completed"),
                                                   "active": F.lit(True)},
                        corrupt=(F.col("ticketID") % 101 == 0))


def raw_customer(d: Domain) -> DataFrame:
    c = d.customer()
    ids = d.customer_cancellation_reason_ids().select("customerID", "cancellationReasonIDs")
    c = c.join(ids, "customerID", "left").withColumn(
        "cancellationReasonIDs",
        F.when(F.col("cancellationReasonIDs").isNull() & (F.col("customerID") % 2 == 0),
               F.array().cast("array<bigint>")).otherwise(F.col("cancellationReasonIDs")))
    load = F.lit(FIXED_LOAD).cast("timestamp_ntz") - F.expr("INTERVAL 1 DAY")
    # Half of the records still use the older field names.
    c = with_further(dealt(c, "customerID").withColumnsRenamed({"fName": "fname", "lName": "lname"}), "customer", "customerID")
    return two_versions(c, load, {"balance": F.lit(0).cast("decimal(18,2)")},
                        other=(F.col("customerID") % 2 == 0, {"fname": "firstName", "lname": "lName", "phone1": "phoneNumber"}))


def _fixed(df: DataFrame, stale: dict, entity: str, key: str) -> DataFrame:
    """Records of a lookup or of another small entity, landed at one instant."""
    return two_versions(with_further(df, entity, key), F.lit(FIXED_LOAD).cast("timestamp_ntz") - F.expr("INTERVAL 1 DAY"), stale)


def raw_payment(d):
    return two_versions(with_further(dealt(d.payment(), "paymentID"), "payment", "paymentID"), F.col("paymentDate"),
                        {"status": F.lit(3), "writeoff": F.lit(False)})


def raw_appointment(d):
    return two_versions(with_further(dealt(d.appointment(), "appointmentID"), "appointment", "appointmentID"), F.col("timeIn"),
                        {"status": F.lit(1), "dateCompleted": F.lit(None)}, office=F.col("customerID") % 25,
                        lag=F.expr("INTERVAL 1 HOUR"))


def raw_subscription(d):
    return two_versions(with_further(dealt(d.subscription(), "subscriptionID"), "subscription", "subscriptionID"), F.col("dateAdded"),
                        {"isActive": F.lit(True)})


def raw_note(d):
    return two_versions(with_further(dealt(d.note(), "noteID"), "note", "noteID"), F.col("dateCreated"), {"typeID": F.lit(0)},
                        office=F.lit(0))


def raw_route(d):
    return two_versions(with_further(dealt(d.route(), "routeDate"), "route", "routeID"), F.col("routeDate"),
                        {"totalDistance": F.lit(0).cast("decimal(18,2)")})


def raw_employee(d):
    return _fixed(d.employee(), {"fName": F.lit("unknown")}, "employee", "employeeID")


def raw_payment_profile(d):
    p = dealt(d.payment_profile(), "paymentProfileID").withColumn("accountNumber", F.lpad(F.col("customerID").cast("string"), 12, "0"))
    load = F.lit(FIXED_LOAD).cast("timestamp_ntz") - F.expr("INTERVAL 1 DAY")
    return two_versions(with_further(p, "payment_profile", "paymentProfileID"), load, {"failedAttempts": F.lit(0)})


def raw_office(d):
    return _fixed(d.office(), {"officeName": F.lit("pending")}, "office", "officeID")


def raw_region(d):
    return _fixed(d.region(), {"regionName": F.lit("pending")}, "region", "regionID")


def raw_service_type(d):
    return _fixed(d.service_type(), {"defaultCharge": F.lit(0).cast("decimal(18,2)")}, "service_type", "serviceTypeID")


def raw_customer_source(d):
    return _fixed(d.customer_source(), {"sourceName": F.lit("pending")}, "customer_source", "sourceID")


def raw_cancellation_reason(d):
    return _fixed(d.cancellation_reason(), {"description": F.lit("pending")}, "cancellation_reason", "reasonID")


def raw_product(d):
    p = d.t.part.select(F.col("p_partkey").alias("productID"), F.col("p_name").alias("description"),
                        F.col("p_brand").alias("code"), F.col("p_retailprice").cast("decimal(18,2)").alias("amount"))
    return _fixed(p, {"amount": F.lit(0).cast("decimal(18,2)")}, "product", "productID")


def raw_generic_flag(d):
    g = d.t.events.groupBy("event_type").agg(F.min("event_id").alias("genericFlagID")).select(
        "genericFlagID", F.col("event_type").alias("code"), F.initcap("event_type").alias("description"))
    return _fixed(g, {"description": F.lit("pending")}, "generic_flag", "genericFlagID")


def raw_reservice_reason(d):
    n = d.t.nation.select(F.col("n_nationkey").cast("bigint").alias("reserviceReasonID"), F.col("n_name").alias("reason"))
    return _fixed(n, {"reason": F.lit("pending")}, "reservice_reason", "reserviceReasonID")


def _event_field(c: Col) -> Column:
    """Value of a record's field: follows the event, and differs with the field's name."""
    name, n = c.paths[0], len(c.paths[0])
    if name in ("officeID", "customerID"):
        return F.col("user_id") % 25 if name == "officeID" else F.col("user_id")
    if c.type == "timestamp":  # every tenth is the source's marker of no time
        at = F.date_format(F.col("ts") + F.make_interval(hours=F.lit(n)), "yyyy-MM-dd HH:mm:ss.SSSSSS")
        return F.when(F.col("event_id") % 10 == 3, F.lit("0000-00-00 00:00:00")).otherwise(at)
    return {"string": F.concat("event_type", F.lit(f" {name.lower()}")), "boolean": F.col("event_type") != "error",
            "money": (F.col("value").cast("decimal(18,2)") + n).cast("decimal(18,2)"),
            "double": (F.col("event_id") * n % 180 - 90).cast("double") + 0.25}.get(c.type, F.col("event_id") * n % 997)


def raw_landed_fact(d: Domain, spec: EntitySpec) -> DataFrame:
    """One record per event with the entity's own fields. Events of even ids
    are spelled as the API documents its fields, those of odd ids in lower case."""
    field = {c.paths[0]: F.col("event_id") if c.name == spec.key else _event_field(c) for c in spec.columns}
    kinds = {c.paths[0]: c.type for c in spec.columns if c.name != spec.key}
    before = {"string": F.lit("pending"), "money": F.lit(0).cast("decimal(18,2)"), "bigint": F.lit(0).cast("bigint")}
    stale = {f: before[t] for f, t in kinds.items() if t in before}
    rows = dealt(d.t.events, "event_id").select(*(v.alias(f) for f, v in field.items()), F.col("ts").alias("__ts"), F.col("event_id").alias("__id"),
                             (F.col("user_id") % 25).alias("__branch"))
    return two_versions(rows, F.col("__ts"), stale, office=F.col("__branch"), corrupt=F.col("__id") % 101 == 0,
                        lag=F.expr("INTERVAL 1 HOUR"), other=(F.col("__id") % 2 == 1, {f: f.lower() for f in field}))
