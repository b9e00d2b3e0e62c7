"""Entity specs: JSON field candidates -> typed columns for every pulled entity.

Field names follow the current API names; older spellings are listed as extra
candidates (paths are case-sensitive). Listed here are the columns that marts and
views use; ``sources.columns`` has the others.
"""

from __future__ import annotations

from arspark.operators.spec import Col, EntitySpec
from arspark.sources.columns import further_columns, hashed


def C(name, *paths, t="bigint"):
    return Col(name, paths or (name,), t)


APPLIED_PAYMENT = EntitySpec("applied_payment", "appliedPaymentID", [
    C("appliedPaymentID"), C("paymentID"), C("ticketID"), C("customerID"), C("officeID", t="int"),
    C("appliedByEmployeeID", "appliedBy", "appliedByEmployeeID"), C("dateApplied", t="date"),
    C("appliedAmount", t="money"), C("taxCollected", t="money"), C("serviceID"), C("listPrice", t="money"),
    *further_columns("applied_payment"),
], plural="appliedPayments", tie_breakers=("serviceID", "appliedByEmployeeID", "listPrice"))

TICKET = EntitySpec("ticket", "ticketID", [
    C("ticketID"), C("customerID"), C("officeID", t="int"), C("invoiceDate", t="date"),
    C("completedOn", "completedOn", "CompletedOn", "invoiceDate", t="date"), C("serviceID"),
    C("total", t="money"), C("subtotal", t="money"), C("taxAmount", t="money"), C("serviceCharge", t="money"),
    C("productionValue", t="money"), C("balance", t="money"), C("isActive", "active", "isActive", t="boolean"),
    C("status", t="string"), C("items", t="array"),
    *further_columns("ticket"),
], plural="tickets")

def ticket_item_spec(key: str = "ticketID") -> EntitySpec:
    """Ticket line items as one record per invoice. The original job keyed
    them by ticket id (kept as default); pass another key to stage per item."""
    return EntitySpec("ticket_item", key, [
        C("ticketID"), C("customerID"), C("officeID", t="int"), C("ticketDate", "invoiceDate", "ticketDate", t="date"),
        C("subtotal", t="money"), C("taxAmount", t="money"), C("total", t="money"),
        C("remainingBalance", "balance", t="money"), C("items", t="array"), *further_columns("ticket_item")], plural="ticketItems")


CUSTOMER = EntitySpec("customer", "customerID", [
    C("customerID"), C("officeID", t="int"), C("regionID", t="int"),
    C("fName", "fname", "fName", "firstName", t="string"), C("lName", "lname", "lName", "lastName", t="string"),
    C("companyName", t="string"), C("balance", t="money"), C("source", t="string"), C("sourceID", t="int"),
    C("dateAdded", t="date"), C("dateCancelled", t="date"), C("status", t="int"),
    C("phone1", "phone1", "phoneNumber", t="string"), C("email", t="string"), C("address", t="string"),
    C("city", t="string"), C("state", t="string"), C("zip", t="string"), C("autopayPaymentProfileID"),
    C("cancellationReasonIDs", t="array"),
    *further_columns("customer"),
], plural="customers")

PAYMENT = EntitySpec("payment", "paymentID", [
    C("paymentID"), C("customerID"), C("officeID", t="int"), C("paymentDate", "date", "paymentDate", t="date"),
    C("amount", t="money"), C("appliedAmount", t="money"), C("paymentMethod", t="int"), C("status", t="int"),
    C("writeoff", t="boolean"), C("cardType", t="string"), C("employeeID"),
    *further_columns("payment"),
], plural="payments")

APPOINTMENT = EntitySpec("appointment", "appointmentID", [
    C("appointmentID"), C("customerID"), C("employeeID"), C("routeID"), C("ticketID"), C("subscriptionID"),
    C("appointmentType", "type", "appointmentType"), C("appointmentDate", "date", "appointmentDate", t="date"),
    C("timeIn", t="timestamp"), C("timeOut", t="timestamp"), C("duration"), C("status", t="int"),
    C("dateCompleted", t="timestamp"),
    *further_columns("appointment"),
], plural="appointments")

SUBSCRIPTION = EntitySpec("subscription", "subscriptionID", [
    C("subscriptionID"), C("customerID"), C("officeID", t="int"), C("serviceTypeID", "serviceID", "serviceTypeID"),
    C("recurringCharge", t="money"), C("billingFrequency", t="int"), C("isActive", "active", "isActive", t="boolean"),
    C("dateAdded", t="date"),
    *further_columns("subscription"),
], plural="subscriptions")

NOTE = EntitySpec("note", "noteID", [
    C("noteID"), C("employeeID"), C("customerID"), C("typeID"), C("dateCreated", "date", "dateCreated", t="timestamp"),
    *further_columns("note"),
], plural="notes")

ROUTE = EntitySpec("route", ("routeID", "routeDate"), [
    C("routeID"), C("routeDate", "date", "routeDate", t="date"), C("officeID", t="int"),
    C("assignedTech"), C("routeTitle", "title", "routeTitle", t="string"), C("totalDistance", t="money"),
    C("appointmentDurationEstimate"), C("drivingDurationEstimate"),
    *further_columns("route"),
], plural="routes")

EMPLOYEE = EntitySpec("employee", "employeeID", [
    C("employeeID"), C("fName", "fname", "fName", "firstName", t="string"),
    C("lName", "lname", "lName", "lastName", t="string"), C("officeID", t="int"),
    *further_columns("employee"),
], plural="employees")

PAYMENT_PROFILE = EntitySpec("payment_profile", "paymentProfileID", [
    C("paymentProfileID"), C("customerID"), C("failedAttempts"), C("lastDeclineType", t="string"),
    C("retryPoints"), C("accountNumber", t="string"),
    *further_columns("payment_profile"),
], plural="paymentProfiles", sensitive=("accountNumber", *hashed("payment_profile")))

OFFICE = EntitySpec("office", "officeID", [C("officeID", t="int"), C("officeName", t="string"),
                                            C("regionID", t="int"),
    *further_columns("office"),
], plural="offices")
REGION = EntitySpec("region", "regionID", [C("regionID", t="int"), C("regionName", "region", "regionName", t="string"),
    *further_columns("region"),
],
                    plural="regions")
SERVICE_TYPE = EntitySpec("service_type", "serviceTypeID", [
    C("serviceTypeID", "typeID", "serviceTypeID"), C("officeID", t="int"),
    C("serviceTypeName", "serviceTypeName", "description", t="string"), C("description", t="string"),
    C("category", t="string"), C("defaultCharge", t="money"),
    *further_columns("service_type"),
], plural="serviceTypes")
CUSTOMER_SOURCE = EntitySpec("customer_source", "sourceID", [
    C("sourceID", t="int"), C("source", t="string"), C("sourceName", t="string"),
    *further_columns("customer_source"),
], plural="customerSources")
CANCELLATION_REASON = EntitySpec("cancellation_reason", "reasonID", [
    C("reasonID", "reasonID", "cancellationReasonID"), C("description", "description", "reason", t="string"),
    *further_columns("cancellation_reason"),
],
    plural="cancellationReasons")

# Output columns of the facts that no mart reads, and the record fields they come from.
APPOINTMENT_REMINDER = EntitySpec("appointment_reminder", "ReminderID", [
    C("ReminderID", "reminderID"), C("OfficeID", "officeID", t="int"), C("AppointmentID", "appointmentID"),
    C("ReminderText", "text", t="string"), C("ReminderDate", "dateSent", t="timestamp"),
    C("EmailDate", "emailSent", t="timestamp"), C("VoiceDate", "voiceSent", t="timestamp"),
    C("Status", "status", t="string"), C("ResponseText", "response", t="string"),
    C("ResponseDate", "responseTime", t="timestamp"), C("SentToSMS", "sendTo", t="string"),
    C("SentToEmail", "emailAddress", t="string"), C("SentToPhone", "voiceNumber", t="string"),
    C("DateUpdated", "dateUpdated", t="timestamp"),
], plural="appointmentReminders", tie_breakers=("DateUpdated", "Status"))

KNOCK = EntitySpec("knock", "KnockID", [
    C("KnockID", "knockID"), C("DoorID", "doorID"), C("EmployeeID", "employeeID"),
    C("DateAdded", "dateAdded", t="timestamp"), C("DateUpdated", "dateUpdated", t="timestamp"),
    C("KnockType", "knockType"), C("ServiceID", "serviceID"),
], plural="knocks", tie_breakers=("DateUpdated", "KnockType", "ServiceID"))

GENERIC_FLAG_ASSIGNMENT = EntitySpec("generic_flag_assignment", "GenericFlagAssignmentID", [
    C("GenericFlagAssignmentID", "genericFlagAssignmentID"), C("OfficeID", "officeID", t="int"),
    C("GenericFlagID", "genericFlagID"), C("RelatedTableRecordID", "relatedTableRecordID"),
    C("TableName", "tableName", t="string"), C("AssignedByEmployeeID", "assignedByEmployeeID"),
    C("DateAssigned", "dateAssigned", t="timestamp"),
], plural="genericFlagAssignments", tie_breakers=("DateAssigned", "GenericFlagID"))

DISBURSEMENT_ITEM = EntitySpec("disbursement_item", "GatewayDisbursementEntryID", [
    C("GatewayDisbursementEntryID", "gatewayDisbursementEntryID"), C("GatewayDisbursementID", "gatewayDisbursementID"),
    C("DateCreated", "dateCreated", t="timestamp"), C("DateUpdated", "dateUpdated", t="timestamp"),
    C("BillingFirstName", "billingFirstName", t="string"), C("BillingLastName", "billingLastName", t="string"),
    C("Amount", "amount", t="money"), C("ActualAmount", "actualAmount", t="money"),
    C("Description", "description", t="string"), C("IsFee", "isFee"), C("GatewayEventID", "gatewayEventID", t="string"),
    C("GatewayEventType", "gatewayEventType", t="string"), C("GatewayEventFeeType", "gatewayEventFeeType", t="string"),
    C("GatewayEventDescription", "gatewayEventDescription", t="string"),
], plural="disbursementItems", tie_breakers=("DateUpdated", "Amount", "ActualAmount"))

ADDITIONAL_CONTACTS = EntitySpec("additional_contacts", "AdditionalContactID", [
    C("AdditionalContactID", "additionalContactID"), C("CustomerID", "customerID"), C("Name", "name", t="string"),
    C("Phone", "phone", t="string"), C("Relationship", "relationship", t="string"),
    C("IsActive", "isActive", t="boolean"),
], plural="additionalContacts", tie_breakers=("IsActive", "Name", "Phone", "Relationship"))

CHARGEBACK = EntitySpec("chargeback", "ChargebackID", [
    C("ChargebackID", "chargebackID"), C("TransactionID", "transactionID"), C("OfficeID", "officeID", t="int"),
    C("CustomerID", "customerID"), C("TransactionType", "transactionType", t="string"),
    C("ResponseDescription", "responseDescription", t="string"), C("Status", "status", t="string"),
    C("DateCreated", "dateCreated", t="timestamp"), C("DateUpdated", "dateUpdated", t="timestamp"),
    C("Amount", "amount", t="money"),
], plural="chargebacks", tie_breakers=("DateUpdated", "Status", "Amount"))

DISBURSEMENT = EntitySpec("disbursement", "GatewayDisbursementID", [
    C("GatewayDisbursementID", "gatewayDisbursementID"), C("DateCreated", "dateCreated", t="timestamp"),
    C("DateUpdated", "dateUpdated", t="timestamp"), C("Amount", "amount", t="money"),
], plural="disbursements", tie_breakers=("DateUpdated", "Amount"))

DOOR = EntitySpec("door", "DoorID", [
    C("DoorID", "doorID"), C("OfficeID", "officeID", t="int"), C("Latitude", "latitude", t="double"),
    C("Longitude", "longitude", t="double"), C("DateCreated", "dateCreated", t="timestamp"),
    C("EmployeeID", "employeeID"), C("Name", "name", t="string"), C("Address", "address", t="string"),
    C("City", "city", t="string"), C("State", "state", t="string"), C("Zip", "zip", t="string"),
    C("Phone", "phone", t="string"), C("Status", "status", t="string"), C("Notes", "notes", t="string"),
    C("Email", "email", t="string"), C("CallbackTime", "callbackTime", t="string"), C("KnockCounter", "knockCounter"),
], plural="doors", tie_breakers=("KnockCounter", "Status", "CallbackTime", "Notes"))

TASK = EntitySpec("task", "TaskID", [
    C("TaskID", "taskID"), C("OfficeID", "officeID", t="int"), C("CustomerID", "customerID"),
    C("AddedByEmployeeID", "addedByEmployeeID"), C("AssignedToEmployeeID", "assignedToEmployeeID"),
    C("CompletedByEmployeeID", "completedByEmployeeID"), C("Type", "type", t="string"),
    C("DueDate", "dueDate", t="timestamp"), C("DateAdded", "dateAdded", t="timestamp"),
    C("DateCompleted", "dateCompleted", t="timestamp"), C("CategoryID", "categoryID"),
    C("CategoryDescription", "categoryDescription", t="string"), C("Description", "description", t="string"),
    C("CompletionNotes", "completionNotes", t="string"), C("ReferenceID", "referenceID"),
    C("Phone", "phone", t="string"), C("DateUpdated", "dateUpdated", t="timestamp"), C("Status", "status", t="string"),
], plural="tasks", tie_breakers=("DateUpdated", "Status", "DateCompleted"))

#: Facts landed from the ``events`` table, which no mart reads.
LANDED_FACTS = {s.name: s for s in (APPOINTMENT_REMINDER, KNOCK, GENERIC_FLAG_ASSIGNMENT, DISBURSEMENT_ITEM,
                                    ADDITIONAL_CONTACTS, CHARGEBACK, DISBURSEMENT, DOOR, TASK)}


PRODUCT = EntitySpec("product", "productID", [C("productID"), C("description", t="string"), C("code", t="string"),
                                              C("amount", t="money"),
    *further_columns("product"),
], plural="products")
GENERIC_FLAG = EntitySpec("generic_flag", "genericFlagID", [C("genericFlagID"), C("code", t="string"),
                                                             C("description", t="string"),
    *further_columns("generic_flag"),
], plural="genericFlags")
RESERVICE_REASON = EntitySpec("reservice_reason", "reserviceReasonID", [
    C("reserviceReasonID"), C("reason", t="string"),
    *further_columns("reservice_reason"),
], plural="reserviceReasons")
