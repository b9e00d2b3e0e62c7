"""Oracle SQL for the staging jobs: the typed output of staging a raw log must
equal the entity computed directly from the driver tables."""

from arspark.sources.columns import further
from oraclesql.entities import with_entities
from oraclesql.marts import CCR_FACT_CTE


# What a record's further fields hold: the record's id (k) and the length of the field's name (n) make the value.
_FURTHER = {
    "n": "{k} * {n} % 997", "s": "'{f}-' || ({k} % 7)", "x": "sha256('{f}-' || ({k} % 7))", "b": "({k} + {n}) % 2 = 0",
    "t": "CASE WHEN {k} % 10 <> 3 THEN TIMESTAMP '2001-01-01' + ({k} % 1000 + {n}) * INTERVAL 1 HOUR END",
    "d": "CASE WHEN {k} % 10 <> 3 THEN DATE '2001-01-01' + CAST({k} % 1000 + {n} AS INTEGER) END",
    "o": "CASE WHEN {k} % 10 <> 3 THEN strftime(TIMESTAMP '2001-01-01' + ({k} % 1000 + {n}) * INTERVAL 1 MINUTE, '%H:%M:%S') END",
    "f": "CAST({k} * {n} % 180 - 90 AS DOUBLE) + 0.25", "a": "'[' || ({k} % 50) || ',{n}]'",
}


def more(entity, key, has=()):
    """SELECT items of an entity's further columns; ``has``: fields that its record has of its own (column, SQL)."""
    own = dict(has)
    return ", ".join(f"{own.get(name, f'CAST({key} AS BIGINT) % 25' if field == 'officeID' else _FURTHER[kind].format(k=f'CAST({key} AS BIGINT)', n=len(field), f=field.lower()))} AS {name}"
                     for name, kind, field in further(entity))


def proj(entity, cols, money=(), of=None, key=None):
    sel = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" if c in money else c for c in cols)
    return with_entities(f"SELECT {sel}{', ' + more(of, key or cols[0]) if of else ''} FROM {entity}")


Q: dict[str, str] = {}
Q["stage_applied_payment"] = proj("applied_payment", ["appliedPaymentID", "paymentID", "ticketID", "customerID",
                                                      "officeID", "appliedByEmployeeID", "dateApplied",
                                                      "appliedAmount", "taxCollected", "serviceID"],
                                  ["appliedAmount", "taxCollected"], of="applied_payment")
_TICKET = ["ticketID", "customerID", "officeID", "invoiceDate", "completedOn", "serviceID", "total", "subtotal",
           "taxAmount", "serviceCharge", "productionValue", "balance", "isActive", "status"]
_TICKET_MONEY = ["total", "subtotal", "taxAmount", "serviceCharge", "productionValue", "balance"]
Q["stage_ticket"] = proj("ticket", _TICKET, _TICKET_MONEY, of="ticket")
Q["stage_ticket_incremental"] = Q["stage_ticket_streamed"] = Q["stage_ticket"]
Q["stage_customer"] = proj("customer_v", ["customerID", "officeID", "regionID", "fName", "lName", "companyName",
                                          "balance", "source", "sourceID", "dateAdded", "dateCancelled", "status",
                                          "phone1", "email", "address", "city", "state", "zip",
                                          "autopayPaymentProfileID"], ["balance"], of="customer")
Q["stage_payment"] = proj("payment", ["paymentID", "customerID", "officeID", "paymentDate", "amount", "appliedAmount",
                                      "paymentMethod", "status", "writeoff", "cardType", "employeeID"],
                          ["amount", "appliedAmount"], of="payment")
Q["stage_appointment"] = proj("appointment", ["appointmentID", "customerID", "employeeID", "routeID", "ticketID",
                                              "subscriptionID", "appointmentType", "appointmentDate", "timeIn",
                                              "timeOut", "duration", "status", "dateCompleted"], of="appointment")
Q["stage_subscription"] = proj("subscription", ["subscriptionID", "customerID", "officeID", "serviceTypeID",
                                                "recurringCharge", "billingFrequency", "isActive", "dateAdded"],
                               ["recurringCharge"], of="subscription")
Q["stage_note"] = proj("note", ["noteID", "employeeID", "customerID", "typeID", "dateCreated"], of="note")
Q["stage_route"] = proj("route", ["routeID", "routeDate", "officeID", "assignedTech", "routeTitle", "totalDistance",
                                  "appointmentDurationEstimate", "drivingDurationEstimate"], ["totalDistance"], of="route")
Q["stage_employee"] = proj("employee", ["employeeID", "fName", "lName", "officeID"], of="employee")
Q["stage_payment_profile"] = with_entities(
    "SELECT paymentProfileID, customerID, failedAttempts, lastDeclineType, retryPoints, "
    "sha256(lpad(CAST(customerID AS VARCHAR), 12, '0')) AS accountNumber, " + more("payment_profile", "paymentProfileID") + " FROM payment_profile")



# One record per event: each output column with the field of the record it must come from.
_LANDED = {
    "appointment_reminder": """ReminderID key, OfficeID office, AppointmentID num appointmentid, ReminderText str text,
        ReminderDate time datesent, EmailDate time emailsent, VoiceDate time voicesent, Status str status,
        ResponseText str response, ResponseDate time responsetime, SentToSMS str sendto, SentToEmail str emailaddress,
        SentToPhone str voicenumber, DateUpdated time dateupdated""",
    "knock": """KnockID key, DoorID num doorid, EmployeeID num employeeid, DateAdded time dateadded,
        DateUpdated time dateupdated, KnockType num knocktype, ServiceID num serviceid""",
    "generic_flag_assignment": """GenericFlagAssignmentID key, OfficeID office, GenericFlagID num genericflagid,
        RelatedTableRecordID num relatedtablerecordid, TableName str tablename,
        AssignedByEmployeeID num assignedbyemployeeid, DateAssigned time dateassigned""",
    "disbursement_item": """GatewayDisbursementEntryID key, GatewayDisbursementID num gatewaydisbursementid,
        DateCreated time datecreated, DateUpdated time dateupdated, BillingFirstName str billingfirstname,
        BillingLastName str billinglastname, Amount money amount, ActualAmount money actualamount,
        Description str description, IsFee num isfee, GatewayEventID str gatewayeventid,
        GatewayEventType str gatewayeventtype, GatewayEventFeeType str gatewayeventfeetype,
        GatewayEventDescription str gatewayeventdescription""",
    "additional_contacts": """AdditionalContactID key, CustomerID customer, Name str name, Phone str phone,
        Relationship str relationship, IsActive flag""",
    "chargeback": """ChargebackID key, TransactionID num transactionid, OfficeID office, CustomerID customer,
        TransactionType str transactiontype, ResponseDescription str responsedescription, Status str status,
        DateCreated time datecreated, DateUpdated time dateupdated, Amount money amount""",
    "disbursement": """GatewayDisbursementID key, DateCreated time datecreated, DateUpdated time dateupdated,
        Amount money amount""",
    "door": """DoorID key, OfficeID office, Latitude angle latitude, Longitude angle longitude,
        DateCreated time datecreated, EmployeeID num employeeid, Name str name, Address str address, City str city,
        State str state, Zip str zip, Phone str phone, Status str status, Notes str notes, Email str email,
        CallbackTime str callbacktime, KnockCounter num knockcounter""",
    "task": """TaskID key, OfficeID office, CustomerID customer, AddedByEmployeeID num addedbyemployeeid,
        AssignedToEmployeeID num assignedtoemployeeid, CompletedByEmployeeID num completedbyemployeeid, Type str type,
        DueDate time duedate, DateAdded time dateadded, DateCompleted time datecompleted, CategoryID num categoryid,
        CategoryDescription str categorydescription, Description str description, CompletionNotes str completionnotes,
        ReferenceID num referenceid, Phone str phone, DateUpdated time dateupdated, Status str status""",
}
_KINDS = {
    "key": "event_id", "office": "CAST(user_id % 25 AS INTEGER)", "customer": "user_id", "flag": "event_type <> 'error'",
    "num": "event_id * length('{f}') % 997", "str": "event_type || ' {f}'",
    "time": "CASE WHEN event_id % 10 <> 3 THEN ts + length('{f}') * INTERVAL 1 HOUR END",
    "money": "CAST(CAST(value AS DECIMAL(18,2)) + length('{f}') AS DOUBLE)",
    "angle": "CAST(event_id * length('{f}') % 180 - 90 AS DOUBLE) + 0.25",
}
for _e, _columns in _LANDED.items():
    _parts = [c.split() for c in _columns.split(",")]
    Q[f"stage_{_e}"] = "SELECT " + ", ".join(f"{_KINDS[k].format(f=''.join(f))} AS {n}" for n, k, *f in _parts) + " FROM events"

Q["dim_office"] = proj("office", ["officeID", "officeName", "regionID"], of="office")
Q["dim_region"] = proj("region_d", ["regionID", "regionName"], of="region")
Q["dim_service_type"] = proj("service_type", ["serviceTypeID", "officeID", "serviceTypeName", "description",
                                              "category", "defaultCharge"], ["defaultCharge"], of="service_type")
Q["dim_customer_source"] = proj("customer_source", ["sourceID", "source", "sourceName"], of="customer_source")
Q["dim_cancellation_reason"] = proj("cancellation_reason", ["reasonID", "description"], of="cancellation_reason")
Q["dim_product"] = ("SELECT p_partkey AS productID, p_name AS description, p_brand AS code, "
                    "CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS DOUBLE) AS amount, " + more("product", "p_partkey") + " FROM part")
Q["dim_generic_flag"] = ("SELECT MIN(event_id) AS genericFlagID, event_type AS code, "
                         "upper(substring(event_type, 1, 1)) || lower(substring(event_type, 2)) AS description, "
                         + more("generic_flag", "MIN(event_id)") + " FROM events GROUP BY event_type")
Q["dim_reservice_reason"] = "SELECT CAST(n_nationkey AS BIGINT) AS reserviceReasonID, n_name AS reason, " + more("reservice_reason", "n_nationkey") + " FROM nation"

Q["view_ticket_item_details"] = with_entities("""
SELECT t.ticketID, t.customerID, t.officeID, t.invoiceDate AS ticketDate,
       ROW_NUMBER() OVER (PARTITION BY ap.ticketID ORDER BY ap.appliedPaymentID % 10) - 1 AS lineNumber,
       'Service ' || CAST(ap.serviceID AS VARCHAR) AS itemDescription, CAST(1 AS BIGINT) AS quantity,
       CAST(ap.appliedAmount AS DOUBLE) AS rate, CAST(ap.appliedAmount AS DOUBLE) AS amount,
       ap.taxCollected > 0 AS isTaxable, ap.serviceID AS productID, CAST(ap.officeID AS BIGINT) AS glAccountID
FROM ticket t JOIN applied_payment ap ON t.ticketID = ap.ticketID""")

Q["fact_customer_cancellation_reasons_raw"] = with_entities(
    "SELECT CAST(OfficeID AS BIGINT) AS OfficeID, * EXCLUDE (OfficeID) FROM ccr_fact", {"ccr_fact": CCR_FACT_CTE})

Q["json_bad_count"] = with_entities("""
SELECT CAST(officeID AS BIGINT) AS OfficeID, COUNT(CASE WHEN ticketID % 101 = 0 THEN 1 END) AS badRows,
       2 * COUNT(*) AS totalRows
FROM ticket GROUP BY officeID""")

Q["view_applied_payment"] = with_entities("""
SELECT appliedPaymentID, officeID, paymentID, ticketID, customerID, CAST(appliedAmount AS DOUBLE) AS appliedAmount,
       CAST(taxCollected AS DOUBLE) AS taxCollected, appliedByEmployeeID, dateApplied, dateApplied AS dateAppliedDate,
       year(dateApplied) AS appliedYear, month(dateApplied) AS appliedMonth, quarter(dateApplied) AS appliedQuarter,
       weekofyear(dateApplied) AS appliedWeek, dayofweek(dateApplied) AS appliedDayOfWeek
FROM applied_payment""")
Q["view_employee"] = with_entities("SELECT employeeID, fName, lName, officeID, fName || ' ' || lName AS FullName FROM employee")
Q["stage_ticket_item"] = with_entities("""
SELECT t.ticketID, t.customerID, t.officeID, t.invoiceDate AS ticketDate, CAST(t.subtotal AS DOUBLE) AS subtotal,
       CAST(t.taxAmount AS DOUBLE) AS taxAmount, CAST(t.total AS DOUBLE) AS total,
       CAST(t.balance AS DOUBLE) AS remainingBalance, COALESCE(n.c, 0) AS itemCount, """ + more("ticket_item", "t.ticketID", {
    "IsActive": "t.isActive", "ServiceCharge": "CAST(t.serviceCharge AS DOUBLE)", "ProductionValue": "CAST(t.productionValue AS DOUBLE)",
    "ServiceID": "t.serviceID"}) + """
FROM ticket t LEFT JOIN (SELECT ticketID, COUNT(*) AS c FROM applied_payment GROUP BY ticketID) n ON t.ticketID = n.ticketID""")
Q["changed_tasks"] = """
SELECT event_id AS TaskID, ts + INTERVAL 9 HOUR AS DateAdded, ts + INTERVAL 11 HOUR AS DateUpdated FROM events
WHERE event_id % 10 <> 3 AND ts + INTERVAL 11 HOUR >= TIMESTAMP '2024-01-10' AND ts + INTERVAL 9 HOUR <= TIMESTAMP '2024-01-12'
  AND (ts + INTERVAL 11 HOUR <= TIMESTAMP '2024-01-12' OR ts + INTERVAL 9 HOUR >= TIMESTAMP '2024-01-10')"""
Q["dim_office_as_written"] = Q["dim_office"]
