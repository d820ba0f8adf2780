"""Customers, sign-ups, alerts, pre-alerts and users."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harborline.functions.dates import shift
from harborline.functions.text import address, fixed_width, flag_when, int_or, join_text
from harborline.operators.joins import decode, find_missing, not_in
from harborline.operators.load import add_identity, upsert
from harborline.operators.project import with_constants
from harborline.plans import lookups as L

CUSTOMER_KEY = ["CustomerAccountNumber", "CustomerAgentPrefix"]

# Written when a customer is first seen and never updated.
CUSTOMER_INSERT_ONLY = ["CustomerBirthDate", "CustomerImageProfile", "CustomerPassword"]

# Target column <- landing column.
CUSTOMER_COLUMNS = {
    "CustomerAccountNumber": "AccountNumber",
    "CustomerAgentPrefix": "AgentPrefix",
    "CustomerTitle": "Title",
    "CustomerFirstName": "FirstName",
    "CustomerLastName": "LastName",
    "CustomerStartedDate": "DateStarted",
    "CustomerPassword": "CustomerPassword",
    "CustomerEmail": "Email",
    "CompanyName": "Company",
    "CustomerMainPhone": "Tel1",
    "CustomerSecondPhone": "Tel2",
    "CustomerThirdPhone": "Tel3",
    "CustomerWorkPhone": "Work_tel",
    "CustomerFax": "Fax",
    "CustomerDefaultRouteId": "RouteID",
    "CustomerResidentialStreet1": "ResidentialStreet1",
    "CustomerResidentialStreet2": "ResidentialStreet2",
    "CustomerResidentialCity": "ResidentialCity",
    "CustomerPrimaryDeliveryStreet1": "Primary_DeliveryStreet1",
    "CustomerPrimaryDeliveryStreet2": "Primary_DeliveryStreet2",
    "CustomerPrimaryDeliveryCity": "Primary_DeliveryCity",
    "CustomerSecDeliveryStreet1": "Secondary_DeliveryStreet1",
    "CustomerSecDeliveryStreet2": "Secondary_DeliveryStreet2",
    "CustomerSecondaryDeliveryCity": "Secondary_DeliveryCity",
    "CustomerIdNumber": "IDNumber",
    "IdTypeId": "IDTypeID",
}
CUSTOMER_FLAGS = {
    "CustomerHasContact": "HasContact",
    "CustomerInsuranceAccepted": "InsuranceAccepted",
    "CustomerCreditCardOnFile": "CreditCardOnFile",
    "CustomerIsActive": "Active",
    "CustomerAvailableSaturday": "AvailableSaturday",
}


def customer_rows(landing: DataFrame) -> DataFrame:
    """Distinct landing customers in the target's columns."""
    name = join_text(F.col("AgentPrefix"), F.col("AccountNumber"), F.lit(" "), F.col("FirstName"), F.lit(" "),
                     F.col("LastName"))
    rows = landing.select(
        *[F.col(source).alias(target) for target, source in CUSTOMER_COLUMNS.items()],
        *[flag_when(F.col(source), "yes").alias(target) for target, source in CUSTOMER_FLAGS.items()],
        name.alias("CustomerName")).distinct()
    return with_constants(rows, {
        "CustomerBirthDate": (L.NO_BIRTH_DATE, "string"), "CustomerImageProfile": (" ", "string"),
        "CustomerReference": ("", "string"),
    })


def missing_customers(landing: DataFrame, customers: DataFrame) -> DataFrame:
    """Landing customers whose account and agent prefix the target lacks."""
    missing = find_missing(customer_rows(landing), customers, CUSTOMER_KEY, ci=True)
    return with_constants(missing, {"CustomerCountryId": (L.COUNTRY_ID, "int")})


def upsert_customers(customers: DataFrame, source: DataFrame) -> DataFrame:
    return upsert(customers, source, CUSTOMER_KEY, CUSTOMER_INSERT_ONLY)


# Target column <- landing column.
SIGN_UP_COLUMNS = {
    "SignUpLoggedDate": "DateLogged",
    "SignUpLoggedTime": "TimeLogged",
    "SignUpIPAddress": "IpAddress",
    "IdTypeId": "IdTypeId",
    "SignUpFirstName": "FirstName",
    "SignUpLastName": "LastName",
    "SignUpContactFirstName": "ContactFirstName",
    "SignUpContactLastName": "ContactLastName",
    "SignUpEmail": "Email",
    "SignUpCompany": "Company",
    "SignUpMainPhone": "Tel1",
    "SignUpSecondPhone": "Tel2",
    "SignUpThirdPhone": "Tel3",
    "SignUpFax": "Fax",
    "SignUpInsuranceAccepted": "insuranceaccepted",
    "SignUpAccountNumber": "accountnumber",
    "SignUpProcessed": "processed",
    "SignUpReference": "reference",
    "SignUpCreatedAt": "created_at",
    "SignUpUpdatedAt": "updated_at",
}


def sign_ups(landing: DataFrame) -> DataFrame:
    """Sign-ups with one-line addresses and a gapless ``SignUpId``."""
    def line(place: str) -> Column:
        return address(*[F.col(f"{place}{part}") for part in ("Street1", "Street2", "City")])

    rows = landing.select(
        *[F.col(source).alias(target) for target, source in SIGN_UP_COLUMNS.items()],
        line("Primary_Delivery").alias("SignUpPrimaryDeliveryAddress"),
        line("Residential").alias("SignUpResidentialAddress"))
    rows = with_constants(rows, {
        "SignUpAccountTypeId": (1, "int"), "SignUpIDImage": ("", "string"), "SignUpImage": ("", "string"),
        "SignUpContactIdTypeId": (None, "string"), "SignUpContactEmail": (None, "string"),
        "SignUpSecondContactEmail": (None, "string"), "SignUpSecondContactFirstName": (None, "string"),
        "SignUpSecondContactLastName": (None, "string"),
    })
    return add_identity(rows, ["SignUpLoggedDate", "SignUpLoggedTime"], "SignUpId")


def alerts(landing: DataFrame, users: Mapping | DataFrame) -> DataFrame:
    """Alerts with the ids of the users who set and disabled them, and a gapless ``AlertId``.

    ``users`` maps a login to its id: a dict, or a table with columns ``code`` and ``id``.
    """
    rows = decode(landing, "SetBy", users, "UserId", ci=True)
    rows = decode(rows, "DisabledBy", users, "AlertDisabledByUserId", ci=True)
    shaped = rows.select(
        F.col("Active").alias("AlertActive"), F.col("RelatedRecordID").alias("AlertRelatedRecordId"),
        F.col("MainInstruction").alias("AlertmainInstruction"), F.col("Details").alias("AlertDetails"),
        F.col("EndDate").alias("AlertEndDate"), F.col("UserId").cast("int").alias("UserId"),
        F.col("DateSet").alias("AlertStartDate"), F.col("AlertDisabledByUserId").cast("int").alias("AlertDisabledByUserId"),
        F.col("DateDisabled").alias("AlertDisabledDate"), F.col("TimeDisabled").alias("AlertDisabledTime"),
        F.col("ReasonDisabled").alias("AlertDisabledReason"))
    return add_identity(shaped, ["AlertStartDate", "AlertRelatedRecordId"], "AlertId")


def pre_alerts(landing: DataFrame, now: Column | None = None) -> DataFrame:
    """Pre-alerts with a gapless ``PreAlertId``; ``now`` stands in for a missing last update."""
    moment = (F.current_timestamp() if now is None else now).cast("timestamp_ntz")

    def text(name: str, width: int | None = None) -> Column:
        filled = F.coalesce(F.col(name), F.lit(""))
        return filled if width is None else fixed_width(filled, width)

    rows = landing.select(
        F.col("AccountNumber").alias("CustomerAccountNumber"),
        text("AgentPrefix", 3).alias("CustomerAgentPrefix"),
        F.col("Value").alias("PreAlertAmount"),
        F.col("Shipper").alias("PreAlertCourierName"),
        F.col("created_at").cast("timestamp_ntz").alias("PreAlertCreatedAt"),
        F.col("DateSet").cast("timestamp_ntz").alias("PreAlertDateSet"),
        text("Description", 200).alias("PreAlertDescription"),
        (flag_when(F.col("Displayed"), "yes") == 1).alias("PreAlertDisplayed"),
        int_or(F.col("UserId"), 0).alias("PreAlertUserId"),
        text("InternationalTrackingNumber", 50).alias("PreAlertInternationalTrackingN"),
        F.coalesce(F.col("LastUpdate").cast("timestamp_ntz"), moment).alias("PreAlertLastUpdate"),
        text("Notes").alias("PreAlertNotes"),
        text("Supplier", 100).alias("PreAlertSupplierName"))
    rows = with_constants(rows, {"PreAlertInvoicePDF": (None, "binary"), "PreAlertSentAMAD": (False, "boolean"),
                                 "PreAlertStatus": (None, "string")})
    return add_identity(rows, ["PreAlertCreatedAt", "CustomerAccountNumber"], "PreAlertId")


def name_guid(text: Column) -> Column:
    """A 36-character id made from the text, so that a repeated run or task gives the same id."""
    return F.regexp_replace(F.md5(text), "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")


def bootstrap_users(users: DataFrame, logins: DataFrame, as_of: dt.date) -> DataFrame:
    """The users plus one for every login they lack, valid for a year from ``as_of``."""
    today, login = F.lit(as_of), F.col("input_by")
    fresh = not_in(logins.filter(login.isNotNull()), "input_by", users, "UserName").select(
        F.left(login, F.lit(1)).alias("UserFirstName"),
        F.expr("substring(input_by, 2)").alias("UserLastName"),
        name_guid(login).alias("UserGUID"),
        today.alias("UserValidFromDate"),
        shift(today, "year", 1).cast("date").alias("UserValidUntilDate"),
        F.lit(1).alias("UserIsActive"),
        login.alias("UserName"))
    return users.select(fresh.columns).union(fresh)
