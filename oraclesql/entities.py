"""Entity CTEs over the driver tables, in DuckDB SQL."""

from __future__ import annotations

import re

ENTITIES: dict[str, str] = {}
DEPS: dict[str, list[str]] = {}


def _def(name, sql, deps=()):
    ENTITIES[name] = sql.strip()
    DEPS[name] = list(deps)


_def("applied_payment", """
SELECT l_orderkey*10+l_linenumber AS appliedPaymentID, l_orderkey*10+(l_linenumber % 3) AS paymentID,
       l_orderkey AS ticketID, o_custkey AS customerID, c_nationkey AS officeID, l_suppkey AS appliedByEmployeeID,
       CAST(l_shipdate AS DATE) AS dateApplied,
       CAST(CAST(l_extendedprice AS DECIMAL(18,2))*(1-CAST(l_discount AS DECIMAL(4,2))) AS DECIMAL(18,2)) AS appliedAmount,
       CAST(CAST(l_extendedprice AS DECIMAL(18,2))*(1-CAST(l_discount AS DECIMAL(4,2)))*CAST(l_tax AS DECIMAL(4,2)) AS DECIMAL(18,2)) AS taxCollected,
       l_partkey AS serviceID, l_linenumber % 5 AS lineMethod, l_returnflag, l_linestatus
FROM (SELECT l.*, o.o_custkey, c.c_nationkey,
             ROW_NUMBER() OVER (PARTITION BY l_orderkey, l_linenumber
                                ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC) AS rn
      FROM lineitem l JOIN orders o ON l.l_orderkey=o.o_orderkey JOIN customer c ON o.o_custkey=c.c_custkey) x
WHERE rn=1""")

_def("payment", """
SELECT paymentID, MIN(customerID) AS customerID, MIN(officeID) AS officeID, MIN(dateApplied) AS paymentDate,
       SUM(appliedAmount) AS amount, SUM(appliedAmount) AS appliedAmount, MIN(lineMethod) AS paymentMethod,
       CASE MIN(l_returnflag) WHEN 'A' THEN 1 WHEN 'R' THEN 2 ELSE 3 END AS status,
       MIN(l_linestatus)='F' AND MIN(l_returnflag)='R' AS writeoff,
       CASE WHEN MIN(lineMethod)=3 THEN 'Visa' ELSE 'None' END AS cardType,
       MIN(appliedByEmployeeID) AS employeeID
FROM applied_payment GROUP BY paymentID""", ["applied_payment"])

_def("ticket", """
SELECT o_orderkey AS ticketID, o_custkey AS customerID, c_nationkey AS officeID,
       CAST(o_orderdate AS DATE) AS invoiceDate, CAST(o_orderdate AS DATE) AS completedOn, s.serviceID,
       CAST(o_totalprice AS DECIMAL(18,2)) AS total,
       CAST(CAST(o_totalprice AS DECIMAL(18,2))*1.08 AS DECIMAL(18,2)) AS subtotal,
       CAST(CAST(o_totalprice AS DECIMAL(18,2))*0.05 AS DECIMAL(18,2)) AS taxAmount,
       CAST(CAST(o_totalprice AS DECIMAL(18,2))*0.9 AS DECIMAL(18,2)) AS serviceCharge,
       CAST(CAST(o_totalprice AS DECIMAL(18,2))*0.8 AS DECIMAL(18,2)) AS productionValue,
       CAST(CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN CAST(o_totalprice AS DECIMAL(18,2))
            ELSE CAST(o_totalprice AS DECIMAL(18,2))*0.5 END AS DECIMAL(18,2)) AS balance,
       o_orderpriority<>'5-LOW' AS isActive,
       CASE WHEN o_orderpriority='5-LOW' THEN 'Cancelled' ELSE 'Completed' END AS status
FROM orders JOIN customer ON o_custkey=c_custkey
LEFT JOIN (SELECT l_orderkey, MIN(l_partkey) AS serviceID FROM lineitem GROUP BY l_orderkey) s ON o_orderkey=s.l_orderkey""")

_def("customer_v", """
SELECT c_custkey AS customerID, c_nationkey AS officeID, n_regionkey AS regionID, c_name AS fName,
       CASE WHEN c_custkey % 9 <> 0 THEN 'Family ' || (c_custkey % 97) END AS lName, CASE WHEN c_mktsegment='BUILDING' THEN c_name END AS companyName,
       CAST(c_acctbal AS DECIMAL(18,2)) AS balance, c_mktsegment AS source,
       CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 1 WHEN 'BUILDING' THEN 2 WHEN 'FURNITURE' THEN 3
            WHEN 'HOUSEHOLD' THEN 4 ELSE 5 END AS sourceID,
       d.dateAdded, CASE WHEN c_acctbal<0 THEN d.lastDate END AS dateCancelled,
       CASE WHEN c_acctbal<0 THEN 0 ELSE 1 END AS status,
       CASE WHEN c_custkey % 4 = 0 THEN NULL
            WHEN c_custkey % 4 = 1 THEN '555-' || lpad(CAST(c_custkey % 10000 AS VARCHAR), 4, '0')
            ELSE '(206) 555-' || lpad(CAST(c_custkey % 10000 AS VARCHAR), 4, '0') END AS phone1,
       CASE WHEN c_custkey % 5 = 0 THEN NULL
            WHEN c_custkey % 5 = 1 THEN lower(replace(c_name, '#', ''))
            ELSE lower(replace(c_name, '#', '')) || '@example.com' END AS email,
       c_name || ' Main St' AS address, n_name AS city,
       CASE WHEN c_custkey % 6 = 0 THEN NULL ELSE substring(n_name, 1, 2) END AS state,
       lpad(CAST(c_custkey % 100000 AS VARCHAR), 5, '0') AS zip,
       CASE WHEN c_custkey % 3 = 0 THEN c_custkey END AS autopayPaymentProfileID
FROM customer JOIN nation ON c_nationkey=n_nationkey
LEFT JOIN (SELECT o_custkey, CAST(MIN(o_orderdate) AS DATE) AS dateAdded, CAST(MAX(o_orderdate) AS DATE) AS lastDate
           FROM orders GROUP BY o_custkey) d ON c_custkey=d.o_custkey""")

_def("service_type", """
SELECT p_partkey AS serviceTypeID, CAST(p_partkey % 25 AS INTEGER) AS officeID, p_name AS serviceTypeName,
       p_name AS description, p_type AS category, CAST(p_retailprice AS DECIMAL(18,2)) AS defaultCharge
FROM part""")

_def("appointment", """
SELECT event_id AS appointmentID, user_id AS customerID, event_id % 50 AS employeeID, event_id % 20 AS routeID,
       event_id AS ticketID, event_id + 1 AS subscriptionID, event_id % 200 + 1 AS appointmentType,
       CAST(ts AS DATE) AS appointmentDate, ts AS timeIn, ts + to_minutes(CAST(event_id % 90 AS BIGINT)) AS timeOut,
       event_id % 60 + 30 AS duration,
       CASE event_type WHEN 'click' THEN 4 WHEN 'error' THEN 6 ELSE 1 END AS status,
       CASE WHEN event_type = 'click' THEN ts END AS dateCompleted
FROM events WHERE event_type IN ('click','error','view')""")

_def("subscription", """
SELECT event_id AS subscriptionID, user_id AS customerID, CAST(user_id % 25 AS INTEGER) AS officeID,
       event_id % 200 + 1 AS serviceTypeID, CAST(value AS DECIMAL(18,2)) AS recurringCharge,
       CASE event_id % 4 WHEN 0 THEN 1 WHEN 1 THEN 3 WHEN 2 THEN 6 ELSE 12 END AS billingFrequency,
       event_id % 10 <> 0 AS isActive, CAST(ts AS DATE) AS dateAdded
FROM events WHERE event_type='signup'""")

_def("note", """
SELECT o_orderkey AS noteID, o_orderkey // 7 % 100 AS employeeID, o_custkey AS customerID,
       o_orderkey % 5 + 1 AS typeID, o_orderdate AS dateCreated
FROM orders""")

_def("route", """
SELECT routeID, routeDate, CAST(routeID % 5 AS INTEGER) AS officeID, routeID + 1 AS assignedTech,
       'Route ' || CAST(routeID AS VARCHAR) AS routeTitle, CAST(SUM(v) AS DECIMAL(18,2)) AS totalDistance,
       COUNT(*) * 30 AS appointmentDurationEstimate, COUNT(*) * 10 AS drivingDurationEstimate
FROM (SELECT event_id % 20 AS routeID, CAST(ts AS DATE) AS routeDate, CAST(value AS DECIMAL(18,2)) AS v FROM events) e
GROUP BY routeID, routeDate""")

_def("payment_profile", """
SELECT c_custkey AS paymentProfileID, c_custkey AS customerID, c_custkey % 4 AS failedAttempts,
       CASE WHEN c_custkey % 3 = 0 THEN 'insufficient_funds' WHEN c_custkey % 3 = 1 THEN 'expired_card' END AS lastDeclineType,
       c_custkey % 5 AS retryPoints
FROM customer""")

_def("office", "SELECT n_nationkey AS officeID, n_name AS officeName, n_regionkey AS regionID FROM nation")
_def("region_d", "SELECT r_regionkey AS regionID, r_name AS regionName FROM region")
_def("employee", "SELECT s_suppkey AS employeeID, s_name AS fName, CASE WHEN s_suppkey % 7 <> 0 THEN 'Crew ' || (s_suppkey % 13) END AS lName, "
                 "s_nationkey AS officeID FROM supplier")
_def("customer_source", """
SELECT sourceID, MIN(source) AS source,
       CASE sourceID WHEN 1 THEN 'Auto dealers' WHEN 2 THEN 'Builders' WHEN 3 THEN 'Furniture stores'
            WHEN 4 THEN 'Door to door' WHEN 5 THEN 'Trade shows' END AS sourceName
FROM customer_v GROUP BY sourceID""", ["customer_v"])
_def("cancellation_reason", """
SELECT DISTINCT reasonID, CASE reasonID WHEN 1 THEN 'Moved' WHEN 2 THEN 'Price too high' END AS description
FROM customer_cancellation_ids WHERE reasonID IN (1, 2)""", ["customer_cancellation_ids"])
_def("customer_cancellation_ids", """
SELECT officeID, customerID, dateCancelled, customerID % 3 + 1 AS reasonID FROM customer_v WHERE dateCancelled IS NOT NULL
UNION ALL
SELECT officeID, customerID, dateCancelled, CAST(3 AS BIGINT) AS reasonID FROM customer_v
WHERE dateCancelled IS NOT NULL AND customerID % 2 = 0""", ["customer_v"])


def _needed(sql: str, extra=()) -> list[str]:
    found = set(extra)
    for name in ENTITIES:
        if re.search(rf"\b{name}\b", sql):
            found.add(name)
    order: list[str] = []

    def visit(n):
        if n in order:
            return
        for dep in DEPS[n]:
            visit(dep)
        order.append(n)

    for n in sorted(found):
        visit(n)
    return order


def with_entities(sql: str, ctes: dict[str, str] | None = None) -> str:
    """Prefix ``sql`` with the entity CTEs it mentions; ``ctes`` adds query-local
    CTEs (name -> body) after the entities, in the given order."""
    ctes = ctes or {}
    text = sql + " " + " ".join(ctes.values())
    names = _needed(text)
    parts = [f"{n} AS ({ENTITIES[n]})" for n in names]
    parts += [f"{k} AS ({v.strip()})" for k, v in ctes.items()]
    return "WITH " + ",\n".join(parts) + "\n" + sql.strip()
