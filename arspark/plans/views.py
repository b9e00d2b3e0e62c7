"""Entity views with derived columns (the plain entity views are the staged
entities themselves: ``stage_<entity>``)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arspark.functions.dates import day_of_week0
from arspark.operators.stage import stage
from arspark.sources import rawlog as R
from arspark.sources import specs as S
from arspark.sources.adapter import Domain


def view_applied_payment(d: Domain) -> DataFrame:
    """Applied payments with reporting date parts (ISO week, 0 = Sunday)."""
    ap = stage(R.raw_applied_payment(d), S.APPLIED_PAYMENT).rows
    da = F.col("dateApplied")
    return ap.select("appliedPaymentID", "officeID", "paymentID", "ticketID", "customerID", "appliedAmount",
                     "taxCollected", "appliedByEmployeeID", "dateApplied", da.alias("dateAppliedDate"),
                     F.year(da).cast("bigint").alias("appliedYear"), F.month(da).cast("bigint").alias("appliedMonth"),
                     F.quarter(da).cast("bigint").alias("appliedQuarter"),
                     F.weekofyear(da).cast("bigint").alias("appliedWeek"),
                     day_of_week0(da).cast("bigint").alias("appliedDayOfWeek"))


def view_employee(d: Domain) -> DataFrame:
    """Employees with the display name (NULL when a name part is missing)."""
    e = stage(R.raw_employee(d), S.EMPLOYEE.only("fName", "lName", "officeID")).rows
    return e.select("employeeID", "fName", "lName", "officeID",
                    F.concat(F.col("fName"), F.lit(" "), F.col("lName")).alias("FullName"))


REGISTRY = {"view_applied_payment": view_applied_payment, "view_employee": view_employee}
