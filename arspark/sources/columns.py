"""Columns of the staged entities that no mart reads, and the record fields they come from.

Fixed values. Each entry: output column, kind, and the record's field where
that isn't the column's name with a small first letter. Kinds: n bigint,
s string, b boolean, t timestamp, d date, o time of day, f double, a array or
other nested value, x string that is only kept as its SHA-256.
"""

from __future__ import annotations

from arspark.operators.spec import Col

KINDS = {"n": "bigint", "s": "string", "b": "boolean", "t": "timestamp", "d": "date", "o": "time", "f": "double", "a": "variant", "x": "string"}

FURTHER = {
    "customer": """BillToAccountID n, Spouse s, IsCommercial n commercialAccount, StatusText s, Phone1_Ext s ext1, Phone2 s,
        Phone2_Ext s ext2, BillingCompanyName s, BillingFName s, BillingLName s, BillingAddress s, BillingCity s,
        BillingState s, BillingZip s, BillingPhone s, BillingEmail s, Latitude f lat, Longitude f lng, SqFeet n squareFeet,
        AddedByEmployeeID n addedByID, DateUpdated t, APay s, PreferredTechID n, PaidInFull n, SubscriptionIDs a,
        BalanceAge n, ResponsibleBalance f, ResponsibleBalanceAge n, MasterAccount n, PreferredBillingDate s,
        PaymentHoldDate d, LatestCCLastFour s mostRecentCreditCardLastFour,
        LatestCCExpDate s mostRecentCreditCardExpirationDate, AppointmentIDs a, TicketIDs a, PaymentIDs a,
        SpecialScheduling s, TaxRate f, StateTax f, CityTax f, CountyTax f, DistrictTax f, DistrictTax1 f, DistrictTax2 f,
        DistrictTax3 f, DistrictTax4 f, DistrictTax5 f, CustomTax f, ZipTaxID n, SMSReminders n smsReminders,
        PhoneReminders n, EmailReminders n, CustomerSource s, CustomerSourceID n, MaxMonthlyCharge f, County s,
        DivisionID n, AgingDate d, ResponsibleAgingDate d, SalesmanAPay s, TermiteMonitoring n, PendingCancel n""",
    "subscription": """BilltoAccountID n billToAccountID, ContractAdded s, InitialQuote f, InitialDiscount f,
        InitialServiceTotal f, ContractValue f, AnnualCV f annualRecurringValue, ServiceFrequency s frequency,
        FollowupService n, AgreementLength n, ServiceDue s nextService, LastCompleted s, ServiceType s,
        SoldByEmployeeID n soldBy, SoldByEmployeeID_2 n soldBy2, SoldByEmployeeID_3 n soldBy3,
        PreferredTechID n preferredTech, AddedByEmployeeID n addedBy, InitialAppointmentID n, InitialStatus b,
        DateCancelled t, DateUpdated t, NextAppointmentDue s, CxlNotes s, CancelledByEmployeeID n cancelledBy, PoNumber s,
        AppointmentIDs s, CompletedAppointmentIDs s, AddOns s, LeadID n, LeadDateAdded s, LeadDateUpdated s leadUpdated,
        LeadAddedByEmployeeID n leadAddedBy, LeadSourceID n, LeadSource s, LeadStatus b, LeadStageID n, LeadStage s,
        LeadAssignedToEmployeeID n leadAssignedTo, LeadDateAssigned s, LeadValue f, LeadDateClosed s,
        LeadLostReasonID n leadLostReason, LeadLostReasonText s, SourceID n, Source s, SubSourceID n, SubSource s,
        AnnualRecurringServices n, UnitIDs s, RegionID n, InitialInvoice f, InitialBillingDate s, RenewalFrequency n,
        NextRenewalDate s renewalDate, CustomApptDate s customDate, SentriconConnected b, SentriconSiteID s,
        SeasonalStart s, SeasonalEnd s, NextBillingDate s, MaxMonthlyCharge f, ExpirationDate s,
        LastApptCompleted s lastAppointment, Duration s, PreferredDays s, PreferredStart s, PreferredEnd s, CallAhead n,
        AutopayPaymentProfileID n, BillingTermsDays n, OnHold b, CustomScheduleID s, CapacityEstimate n""",
    "employee": """IsActive b active, EmployeeTypeText s type, Phone s, Email s, Experience s, SkillIDs a, SkillDescriptions a,
        LinkedEmployeeIDs a, EmployeeLink s, LicenseNumber s, SupervisorID n, RoamingRep n, RegionalManagerOfficeIDs a,
        LastLogin t, TeamIDs a, PrimaryTeam s, AccessControlProfileID n, StartAddress s, StartCity s, StartState s,
        StartZip s, StartLatitude f startLat, StartLongitude f startLng, EndAddress s, EndCity s, EndState s, EndZip s,
        EndLatitude f endLat, EndLongitude f endLng, DateUpdated t""",
    "ticket": """BillToAccountID n, DateCreated t, DateUpdated t, ServiceTaxable n, TaxRate f, AppointmentID n,
        SubscriptionID n, CreatedByEmployeeID n createdBy""",
    "payment": """UnassignedAmount f, InvoiceIDs a, PaymentApplications a, IsOfficePayment n officePayment,
        IsCollectionPayment n collectionPayment, CreditMemo a, PaymentOrigin s, OriginalPaymentID n, LastFour s,
        PaymentNotes s notes, BatchOpened t, BatchClosed t, PaymentSource s, DateUpdated t, TransactionID s,
        SubscriptionID n""",
    "applied_payment": "DateUpdated t",
    "appointment": """OfficeID n, SubscriptionRegionID n, SpotID n, StartTime o start, EndTime o end, TimeWindow s, DateAdded t,
        StatusText s, CallAhead n, IsInitial b, SubscriptionPreferredTech n, CompletedBy n, ServicedBy s,
        AppointmentNotes s notes, OfficeNotes s, CheckIn s, CheckOut s, WindSpeed f, WindDirection s, Temperature f,
        IsInterior n servicedInterior, DateCancelled t, AdditionalTechs a,
        AppointmentCancelReason s appointmentCancellationReason, CancellationReason s, CancellationReasonID n,
        RescheduleReasonID n, ReserviceReasonID n, TargetPests a, DateUpdated t""",
    "note": """OfficeID n, CustomerName s, CustomerSpouse s, CompanyName s, EmployeeName s, IsVisibleCustomer n showCustomer,
        IsVisibleTechnician n showTech, CancellationReasonID n, CancellationReason s, TypeDescription s type,
        ContactTypeCategories a, Text s notes, ReferenceID n, DateAdded t, DateUpdated t, OpenCount n,
        ClickCount n clicksCount, EmailStatus s""",
    "payment_profile": """OfficeID n, CreatedByEmployeeID n createdBy, PaymentDescription s description, DateCreated t,
        DateUpdated t, Status s, StatusNotes s, BillingName s, BillingAddress s billingAddress1, BillingCity s,
        BillingState s, BillingZip s, BillingPhone s, BillingEmail s, PaymentMethod s, GatewayName s gateway, MerchantID s,
        MerchantToken x, LastFour s, ExpMonth n, ExpYear n, CardType s, BankName s, BankRoutingNumber x routingNumber,
        CheckType s, BankAccountType s accountType, SentFailureDate t, LastAttemptDate t, PaymentHoldDate d,
        InitialTransactionID s""",
    "route": """RouteTemplateID n templateID, DateAdded t, AddedByEmployeeID n addedBy, RouteGroupID n groupID,
        RouteGroupTitle s groupTitle, DayNotes s, DayAlert s, DayID n, AdditionalTechs a, APICanSchedule n apiCanSchedule,
        ScheduleTeams a, ScheduleTypes a, AvgLatitude f averageLatitude, AvgLongitude f averageLongitude,
        AvgDistance f averageDistance, DateUpdated t, DistanceScore f, CapacityValueEstimate f capacityEstimateValue,
        IsLocked n lockedRoute""",
    "ticket_item": """BillToAccountID n, DateCreated t, DateUpdated t, IsActive b active, ServiceCharge f, ServiceTaxable n,
        ProductionValue f, TaxRate f, AppointmentID n, SubscriptionID n, ServiceID n, GLNumber s glNumber,
        CreatedByEmployeeID n createdBy""",
    "office": """CompanyID n, LicenseNumber s, ContactNumber s, ContactEmail s, Timezone s, Address s, City s, State s,
        ZipCode s zip, CautionStatements s, OfficeLatitude f, OfficeLongitude f""",
    "region": "OfficeID n, DateCreated t created, DateDeleted t deleted, LatAndLong a points, RegionType s type, IsActive b active",
    "service_type": """Frequency s, IsReserviceType n reservice, DefaultAppointmentLength n defaultLength, DefaultInitialCharge f,
        InitialID n, MinRecurringCharge f minimumRecurringCharge, MinInitialCharge f minimumInitialCharge,
        IsRegularService n regularService, IsInitialService n initial, SeasonStart s, SeasonEnd s,
        SentriconServiceType s sentricon, IsVisible b visible, DefaultFollowupDelay n, SalesVisible b""",
    "customer_source": "OfficeID n, IsSalesroutesDefault n salesroutesDefault, IsVisible b visible, IsDealsSource n dealsSource",
    "cancellation_reason": "IsActive b",
    "product": """OfficeID n, GLAccountID n glAccountID, Taxable n, ProductCategory s category, IsVisible b visible,
        IsSalesVisible n salesVisible, IsRecurring n recurring""",
    "generic_flag": "OfficeID n, FlagStatus s status, FlagType s type, DateCreated t, DateUpdated t",
    "reservice_reason": "OfficeID n, IsVisible b visible",
}


def further(entity: str) -> list[tuple[str, str, str]]:
    """(column, kind, field) of an entity's further columns, in order."""
    out = []
    for entry in FURTHER.get(entity, "").split(","):
        if entry.strip():
            name, kind, *field = entry.split()
            out.append((name, kind, field[0] if field else name[0].lower() + name[1:]))
    return out


def further_columns(entity: str) -> list[Col]:
    return [Col(name, (field,), KINDS[kind]) for name, kind, field in further(entity)]


def hashed(entity: str) -> tuple[str, ...]:
    return tuple(name for name, kind, _ in further(entity) if kind == "x")
