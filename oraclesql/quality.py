"""Oracle SQL for quality checks and load monitoring (DuckDB)."""

from oraclesql.entities import with_entities

NOW = "TIMESTAMP '2001-08-02 01:00:00'"


def _log(source, office, first, again, bad="FALSE"):
    """Each row of ``source`` landed twice; the first landing may be unreadable."""
    return (f"SELECT CAST({office} AS BIGINT) AS OfficeID, {first} AS LoadDatetimeUTC, {bad} AS bad FROM {source} "
            f"UNION ALL SELECT CAST({office} AS BIGINT), {again}, FALSE FROM {source}")


_FIXED = ("TIMESTAMP '2001-07-31 03:00:00'", "TIMESTAMP '2001-08-01 03:00:00'")
def _daily(column):
    return f"CAST({column} AS TIMESTAMP)", f"CAST({column} AS TIMESTAMP) + INTERVAL 1 DAY"


def _hourly(column):
    return column, f"{column} + INTERVAL 1 HOUR"


_EVENT_FACTS = "AppointmentReminder Knock GenericFlagAssignment DisbursementItem AdditionalContacts Chargeback Disbursement Door Task".split()
RAW_LOGS = {
    "Ticket_Fact": _log("ticket", "officeID", *_daily("invoiceDate"), "ticketID % 101 = 0"),
    "TicketItem_Fact": _log("ticket", "officeID", *_daily("invoiceDate"), "ticketID % 101 = 0"),
    "Payment_Fact": _log("payment", "officeID", *_daily("paymentDate")),
    "AppliedPayment_Fact": "SELECT CAST(c_nationkey AS BIGINT) AS OfficeID, CAST(l_shipdate AS TIMESTAMP) AS LoadDatetimeUTC, FALSE AS bad "
                           "FROM lineitem, orders, customer WHERE l_orderkey = o_orderkey AND o_custkey = c_custkey",
    "Customer_Dim": _log("customer_v", "officeID", *_FIXED), "Employee_Dim": _log("employee", "officeID", *_FIXED),
    "Appointment_Fact": _log("appointment", "customerID % 25", *_hourly("timeIn")),
    "Subscription_Fact": _log("subscription", "officeID", *_daily("dateAdded")),
    "Note_Fact": _log("note", "0", *_daily("dateCreated")), "Route_Fact": _log("route", "officeID", *_daily("routeDate")),
    "PaymentProfile_Fact": _log("payment_profile", "paymentProfileID % 25", *_FIXED),
    "Office_Dim": _log("office", "officeID", *_FIXED), "Region_Dim": _log("region_d", "regionID % 25", *_FIXED),
    "ServiceType_Dim": _log("service_type", "officeID", *_FIXED), "CustomerSource_Dim": _log("customer_source", "sourceID % 25", *_FIXED),
    "CancellationReason_Dim": _log("cancellation_reason", "0", *_FIXED), "Product_Dim": _log("part", "p_partkey % 25", *_FIXED),
    "GenericFlag_Dim": _log("(SELECT MIN(event_id) AS id FROM events GROUP BY event_type)", "id % 25", *_FIXED),
    "ReserviceReason_Dim": _log("nation", "n_nationkey % 25", *_FIXED),
} | {f"{name}_Fact": _log("events", "user_id % 25", *_hourly("ts"), "event_id % 101 = 0") for name in _EVENT_FACTS}
RAW_CTES = {f"raw_{k.lower()}": v for k, v in RAW_LOGS.items()}


def _each(template):
    return "\nUNION ALL\n".join(template.format(name=n, raw=f"raw_{n.lower()}") for n in RAW_LOGS)


WATERMARKS = _each("SELECT OfficeID AS office_id, '{name}' AS entity_name, MAX(LoadDatetimeUTC) AS last_run_utc, "
                   "MAX(LoadDatetimeUTC) FILTER (NOT bad) AS last_success_utc, COUNT(*) AS records_loaded, COUNT(*) FILTER (bad) AS error_count "
                   "FROM {raw} GROUP BY OfficeID")
OFFICES = "SELECT officeID AS office_id, officeName AS office_name, regionID <> 4 AS active FROM office"


def q(sql, extra=None):
    return with_entities(sql, {**RAW_CTES, "wm": WATERMARKS, "offices": OFFICES, **(extra or {})})


Q: dict[str, str] = {}
_DQ = {
    "Orphaned Tickets": "SELECT COUNT(*) AS n FROM ticket t LEFT JOIN customer_v c ON t.customerID = c.customerID WHERE c.customerID IS NULL",
    "Unlinked Applied Payments": "SELECT COUNT(*) AS n FROM applied_payment ap LEFT JOIN ticket t ON ap.ticketID = t.ticketID WHERE t.ticketID IS NULL",
    "Negative Customer Balances": "SELECT COUNT(*) AS n FROM customer_v WHERE balance < 0",
    "Future Dated Tickets": f"SELECT COUNT(*) AS n FROM ticket WHERE completedOn > {NOW}",
}
Q["dq_report"] = with_entities(
    "SELECT check_name AS \"check\", issues, CASE WHEN issues > 0 THEN 'WARN' ELSE 'OK' END AS status FROM ("
    + " UNION ALL ".join(f"SELECT '{k}' AS check_name, n AS issues FROM ({v})" for k, v in _DQ.items()) + ")")
for _key, _name in [("dq_customer_orphans", "Orphaned Tickets"), ("dq_payment_without_ticket", "Unlinked Applied Payments"),
                    ("dq_negative_balances", "Negative Customer Balances"), ("dq_future_tickets", "Future Dated Tickets")]:
    Q[_key] = with_entities(_DQ[_name])

Q["not_in_subquery"] = with_entities("""
SELECT 'null key' AS rule, customerID FROM customer_v WHERE autopayPaymentProfileID NOT IN (SELECT paymentProfileID FROM payment_profile WHERE failedAttempts = 0)
UNION ALL SELECT 'null in list', customerID FROM customer_v WHERE customerID NOT IN (SELECT autopayPaymentProfileID FROM customer_v)
UNION ALL SELECT 'empty list', customerID FROM customer_v WHERE autopayPaymentProfileID NOT IN (SELECT paymentProfileID FROM payment_profile WHERE failedAttempts < 0)
UNION ALL SELECT 'plain', customerID FROM customer_v
WHERE customerID NOT IN (SELECT autopayPaymentProfileID FROM customer_v WHERE autopayPaymentProfileID IS NOT NULL)""")

Q["etl_monitoring"] = q(f"""
SELECT w.office_id, o.office_name, w.entity_name, w.last_run_utc, w.last_success_utc, w.records_loaded, w.error_count,
       date_diff('hour', w.last_success_utc, {NOW}) AS hours_since_last_success,
       CASE WHEN date_diff('hour', w.last_success_utc, {NOW}) > 24 THEN 'STALE' WHEN w.error_count > 3 THEN 'ERROR'
            ELSE 'OK' END AS status
FROM wm w JOIN offices o ON w.office_id = o.office_id WHERE o.active = TRUE""")
Q["recent_loads"] = q(f"""
SELECT entity_name, office_id, last_run_utc, records_loaded, date_diff('minute', last_run_utc, {NOW}) AS minutes_ago
FROM wm WHERE last_run_utc >= {NOW} - INTERVAL 2 HOUR""")
Q["loads_today"] = q(_each(f"SELECT '{{name}}' AS entity, COUNT(*) AS records_loaded, COUNT(DISTINCT OfficeID) AS offices_loaded, "
                           f"MAX(LoadDatetimeUTC) AS last_load_time FROM {{raw}} WHERE LoadDatetimeUTC >= CAST(CAST({NOW} AS DATE) AS TIMESTAMP)"))
Q["load_detail"] = q(_each(
    "SELECT '{name}' AS table_name, g.OfficeID, g.total_rows, g.most_recent_load, g.distinct_load_times, l.rows_from_latest_load "
    "FROM (SELECT OfficeID, COUNT(*) AS total_rows, MAX(LoadDatetimeUTC) AS most_recent_load, "
    "COUNT(DISTINCT LoadDatetimeUTC) AS distinct_load_times FROM {raw} GROUP BY OfficeID) g "
    "LEFT JOIN (SELECT r.OfficeID, COUNT(*) AS rows_from_latest_load FROM {raw} r JOIN "
    "(SELECT OfficeID, MAX(LoadDatetimeUTC) AS mx FROM {raw} GROUP BY OfficeID) m ON r.OfficeID = m.OfficeID "
    "AND r.LoadDatetimeUTC = m.mx GROUP BY r.OfficeID) l ON g.OfficeID = l.OfficeID"))
_FRESH = _each(f"SELECT '{{name}}' AS TableName, COUNT(*) AS RecordCount, MAX(LoadDatetimeUTC) AS LastUpdate, "
               f"date_diff('hour', MAX(LoadDatetimeUTC), {NOW}) AS HoursSinceUpdate FROM {{raw}}")
Q["table_freshness"] = q(_FRESH)
Q["stale_tables"] = q("SELECT TableName, HoursSinceUpdate FROM fresh WHERE HoursSinceUpdate > 25",
                      {"fresh": _FRESH.replace(NOW, "TIMESTAMP '2001-08-03 06:00:00'")})
Q["load_date_histogram"] = q("SELECT CAST(LoadDatetimeUTC AS DATE) AS LoadDate, COUNT(*) AS RecordCount "
                             "FROM raw_customer_dim GROUP BY 1")
Q["rows_per_office"] = q("SELECT OfficeID, COUNT(*) AS row_count, MAX(LoadDatetimeUTC) AS last_load "
                         "FROM raw_ticket_fact GROUP BY OfficeID")
Q["layer_row_counts"] = with_entities("""
SELECT 'ticket' AS table_name, 2 * COUNT(*) AS raw_rows, COUNT(*) AS staged_rows, COUNT(*) AS difference FROM ticket
UNION ALL SELECT 'payment', 2 * COUNT(*), COUNT(*), COUNT(*) FROM payment
UNION ALL SELECT 'customer', 2 * COUNT(*), COUNT(*), COUNT(*) FROM customer_v""")
Q["scan_active_offices"] = q("SELECT r.OfficeID, COUNT(*) AS \"rows\" FROM raw_ticket_fact r "
                             "WHERE r.OfficeID IN (SELECT office_id FROM offices WHERE active) GROUP BY r.OfficeID")
Q["recent_ticket_loads"] = q(f"""SELECT OfficeID, COUNT(*) AS loaded, MIN(LoadDatetimeUTC) AS first_load FROM raw_ticket_fact
WHERE LoadDatetimeUTC >= {NOW} - INTERVAL 48 HOUR GROUP BY OfficeID""")
Q["ticket_change_window"] = q("""
SELECT l.OfficeID, COUNT(*) AS loaded, MIN(l.LoadDatetimeUTC) AS first_load
FROM raw_ticket_fact l
LEFT JOIN (SELECT OfficeID, MAX(LoadDatetimeUTC) AS seen FROM raw_ticket_fact
           WHERE LoadDatetimeUTC < TIMESTAMP '1998-01-01' AND OfficeID % 5 <> 4 GROUP BY OfficeID) w USING (OfficeID)
WHERE l.LoadDatetimeUTC >= CASE WHEN w.seen IS NULL THEN TIMESTAMP '1998-02-01' - INTERVAL 2 HOUR ELSE w.seen - INTERVAL 15 MINUTE END
  AND l.LoadDatetimeUTC <= TIMESTAMP '1998-02-01'
GROUP BY l.OfficeID""")

Q["load_watermarks"] = q(_each("SELECT OfficeID, '{name}' AS entity, MAX(LoadDatetimeUTC) FILTER (NOT bad) AS lastRunTimestamp, "
                               "COUNT(*) FILTER (NOT bad) AS rowsLoaded, COUNT(*) FILTER (bad) AS badRows FROM {raw} GROUP BY OfficeID "
                               "HAVING COUNT(*) FILTER (NOT bad) > 0"))

Q["ticket_changes_landed"] = q("""
SELECT OfficeID, COUNT(*) AS loaded, MIN(LoadDatetimeUTC) AS first_load FROM landed LEFT JOIN marks USING (OfficeID)
WHERE LoadDatetimeUTC >= IFNULL(since, TIMESTAMP '1998-02-01' - INTERVAL 2 HOUR) GROUP BY ALL""", {
    "landed": "SELECT * FROM raw_ticket_fact WHERE LoadDatetimeUTC BETWEEN TIMESTAMP '1997-12-20' AND TIMESTAMP '1998-02-01'",
    "marks": "SELECT OfficeID, MAX(LoadDatetimeUTC) - INTERVAL 15 MINUTE AS since FROM landed "
             "WHERE LoadDatetimeUTC < TIMESTAMP '1998-01-25' AND OfficeID % 5 <> 4 GROUP BY ALL"})
