"""Invoices, invoice lines, payments and other charges."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harborline.functions.text import fixed_width, flag_unless, flag_when, same_text
from harborline.operators.joins import decode
from harborline.operators.load import add_identity, merge_by_key, new_rows
from harborline.operators.project import with_constants
from harborline.plans import lookups as L

Lookup = Mapping | DataFrame
IDENTITY = "decimal(11,0)"


def invoice_headers(landing: DataFrame, routes: Lookup = L.ROUTE_IDS) -> DataFrame:
    """Invoice headers in the target's columns, ready to be merged by package number."""
    rows = decode(landing, "Route", routes, "RouteId", ci=True)
    paid = F.when(same_text(F.col("InvoiceStatus"), "PAID"), F.lit("Paid")).otherwise(F.lit("Unpaid"))
    headers = rows.select(
        "InvoiceNumber", "InvoiceDate", "PackageNumber",
        F.col("Consignee").alias("InvoiceConsignee"),
        F.col("Shipper").alias("InvoiceShipper"),
        paid.alias("InvoiceStatus"),
        F.col("RouteId").cast("int").alias("RouteId"),
        "InvoiceWeight", "InvoicePieces",
        F.when(F.col("Printed") == 1, F.lit(1)).otherwise(F.lit(0)).alias("InvoicePrinted"),
        flag_when(F.col("emailed"), "1").alias("InvoiceEmailed"),
        flag_unless(F.col("Uploaded"), "no").alias("InvoiceUploaded"),
        flag_unless(F.col("AllowEmail"), "no").alias("InvoiceAllowEmail"),
        flag_unless(F.col("AllowPrint"), "no").alias("InvoiceAllowPrint"),
        F.col("TimePaidOff").alias("InvoicePaidOffDate"),
        F.col("TimePaidOff").alias("InvoicePaidOffTime"))
    return with_constants(headers, {"UnKnownId": (None, "int"), "InvoiceUserId": (L.INVOICE_USER_ID, "int")})


def merge_invoices(target: DataFrame | None, landing: DataFrame, routes: Lookup = L.ROUTE_IDS) -> DataFrame:
    return merge_by_key(target, invoice_headers(landing, routes), ["PackageNumber"], ci=True)


def invoice_lines(landing: DataFrame, loaded: DataFrame | None = None) -> DataFrame:
    """Invoice lines the target lacks; of the target only the range of the landing line ids is read."""
    lines = landing.select(
        F.col("InvoiceNumber").cast("decimal(11,0)").alias("InvoiceNumber"),
        F.col("id").cast("decimal(11,0)").alias("InvoiceDetailId"),
        fixed_width(F.col("ChargeDescription"), 100).alias("InvoiceDetailChargeName"),
        F.col("ChargeValue").cast("decimal(19,4)").alias("InvoiceDetailChargeAmount"),
        F.lit(0).cast("decimal(19,4)").alias("InvoiceDetailChargeVat"))
    return new_rows(loaded, lines, ["InvoiceNumber", "InvoiceDetailId"], prune_by="InvoiceDetailId")


def payments(landing: DataFrame, users: Lookup, routes: Lookup = L.ROUTE_IDS) -> DataFrame:
    """Payments with user and location ids (NULL where unknown) and a gapless ``PaymentId``.

    ``users`` maps a login to its id: a dict, or a table with columns ``code`` and ``id``.
    """
    rows = decode(landing, "CreatedBy", users, "PaymentUserId", ci=True)
    rows = decode(rows, "Route", routes, "LocationId", ci=True)
    shaped = rows.select(
        "PaymentDate", "PaymentTime", F.col("amount").alias("PaymentAmount"), "InvoiceNumber",
        F.col("PaymentTime").alias("PaymentCreatedDateTime"),
        F.col("PaymentUserId").cast("int").alias("PaymentUserId"), F.col("LocationId").cast("int").alias("LocationId"),
        F.col("PaymentMethod").alias("PaymentMethodName"))
    return add_identity(shaped, ["PaymentDate", "PaymentTime", "InvoiceNumber"], "PaymentId", IDENTITY)


def other_charges(landing: DataFrame) -> DataFrame:
    shaped = landing.select(
        F.col("DateCreated").alias("OtherChargeCreatedDate"), F.col("TimeCreated").alias("OtherChargeCreatedTime"),
        F.col("Amount").alias("OtherChargeAmount"), "InvoiceNumber", F.col("UserId").alias("OtherChargeUserId"),
        F.col("PaymentMethod").alias("PaymentMethodName"))
    order = ["OtherChargeCreatedDate", "OtherChargeCreatedTime", "InvoiceNumber"]
    return add_identity(shaped, order, "OtherChargeId", IDENTITY)
