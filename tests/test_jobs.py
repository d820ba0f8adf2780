"""The jobs on invented landing rows with NULLs, mixed case, trailing blanks and unknown codes."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from harborline.plans import billing, packages, people


def landing(spark, defaults, *data):
    """Rows given as dicts over typed defaults ``name -> SQL``."""
    rows = []
    for i, given in enumerate(data):
        columns = {**defaults, **given}
        rows.append("select " + ", ".join(f"{v} as `{k}`" for k, v in columns.items()) + f", {i} as pos")
    return spark.sql(" union all ".join(rows)).orderBy("pos").drop("pos")


PACKAGE = {
    "PackageNumber": "'AIR-0001-rest-of-number'", "InternationalTrackingNumber": "'T1'", "prealert_tracking_number": "cast(null as string)",
    "SupplierInvoiceNumber": "cast(null as string)", "PackageDescription": "'d'", "TariffDescription": "'t'",
    "hazmat": "cast(null as string)", "Consolidation": "cast(null as string)", "ConsolidationPackageNumber": "'c'",
    "shipper": "'Acme'", "agent_prefix": "'BSL'", "LocationLastSeen": "cast(null as string)", "notes": "'n'",
    "packed_in_shipment": "''", "PackageStatus": "cast(null as string)", "TotalPieces": "1", "length": "1.5D", "width": "2D",
    "height": "3D", "TotalWeight": "4D", "PackageValue": "5D", "DateFirstSeen": "date'2024-01-02'",
    "TimeFirstSeen": "'03:04:05'", "AccountNumber": "'100'", "created_at": "timestamp_ntz'2024-01-02 00:00:00'",
}


def loaded_packages(spark, *data, known=None, loaded=None, customers="('100', 'bsl', 1)"):
    rows = landing(spark, PACKAGE, *data)
    accounts = spark.sql(f"select * from values {customers} "
                         "t(CustomerAccountNumber, CustomerAgentPrefix, CustomerAvailableSaturday)")
    known = rows.select("PackageNumber") if known is None else spark.createDataFrame([(k,) for k in known], "PackageNumber string")
    if loaded is not None:
        loaded = spark.createDataFrame([(k,) for k in loaded], "PackageNumber string")
    return packages.load_packages(rows, known, accounts, loaded)


def test_package_columns_and_defaults(spark):
    row = loaded_packages(spark, {}).first()
    assert len(row) == 46
    assert (row.PackagePrealertTrackingNumber, row.PackageSupplierInvoiceNumber) == ("", "")
    assert (row.PackageHazmat, row.PackageConsolidation, row.PackagePartMultiplePiece) == (0, 1, 1)
    assert row.PackageFirstSeenDateTime == dt.datetime(2024, 1, 2, 3, 4, 5)
    assert (row.PackageActualStatusName, row.PackageAirwayBillNumber, row.PackageOcean) == ("Received", "0001-rest-of", 0)
    assert (row.UserId, row.DestinationName, row.ManifestId, row.AvailableSaturdayFlag) == (12, "Saint Lucia", None, 1)


@pytest.mark.parametrize("label, last_seen, location, number, kind", [
    ("CASTRIES ", 1, 1, None, None), ("RB BOX 10", 2, 2, 10, "BOX"), ("RB AREA 2", None, 2, 2, "AREA"),
    ("VF SHELF 2", None, 5, 2, "SHELF"), ("Old Vieux Fort shed", None, 5, None, None), ("Front Counter", 6, 1, None, None),
    ("Nowhere", None, None, None, None),
])
def test_package_places(spark, label, last_seen, location, number, kind):
    row = loaded_packages(spark, {"LocationLastSeen": f"'{label}'"}).first()
    assert (row.PackageLocationLastSeenId, row.PackageLocationId, row.PackageLocationLastStorageType) == (last_seen, location, kind)
    assert row.PackageLocationLastStorageId == number


def test_package_statuses_and_flags(spark):
    row = loaded_packages(spark, {"PackageStatus": "'Is Scheduled for delivery'", "hazmat": "'YES'", "Consolidation": "'No '",
                                  "PackageNumber": "'oce1'", "notes": "repeat('x', 300)"}).first()
    assert (row.PackageActualStatusName, row.PackageHazmat, row.PackageConsolidation) == ("ScheduledForDelivery", 1, 0)
    assert row.PackageOcean == 1 and len(row.PackageNotes) == 255


def test_package_selection(spark):
    data = [{"PackageNumber": f"'{n}'"} for n in ("p1", "p2", "p3")] + [{"PackageNumber": "'p4'", "AccountNumber": "'999'"}]
    found = loaded_packages(spark, *data, known=["P1 ", "p2", "p4"], loaded=["P2"])
    assert [r.PackageNumber for r in found.collect()] == ["p1"]
    twice = loaded_packages(spark, {}, customers="('100', 'BSL', 1), ('100', 'BSL', 0), ('100', 'XYZ', 0)")
    assert sorted(r.AvailableSaturdayFlag for r in twice.collect()) == [0, 1]


EVENT = {"PackageNumber": "'p1'", "EventDescription": "'In Transit'", "EventDate": "date'2024-01-02'", "EventTime": "'10:00:00'"}


def test_event_history(spark):
    rows = landing(spark, EVENT, {}, {}, {"EventDescription": "'Detained at Customs'"}, {"EventDescription": "'was DELIVERED'"},
                   {"EventTime": "cast(null as string)"}, {"PackageNumber": "'unknown'"}, {"PackageNumber": "cast(null as string)"})
    known = spark.sql("select 'P1 ' as PackageNumber")
    first = packages.event_history(rows, known)
    status = sorted((r.PackageStatusName, r.EventDate is None) for r in first.collect())
    assert status == [("Delivered", False), ("In Transit", False), ("In Transit", True), ("Received", False)]
    again = packages.event_history(rows, known, first).collect()
    assert [(r.PackageStatusName, r.EventDate) for r in again] == [("In Transit", None)]
    assert (again[0].PackageEventUserId, again[0].PackageEventInvoiceVerified, again[0].PackageEventInvoiceNumber) == (100, False, None)


def test_dimension_fill(spark, rows):
    shippers = spark.createDataFrame([("Acme",), ("ACME ",), ("Zed",), (None,), ("Known",)], "shipper string")
    have = spark.createDataFrame([("known ",), (None,)], "CourierName string")
    assert rows(packages.missing_couriers(shippers, have)) == [(None,), ("ACME ",), ("Zed",)]
    assert packages.missing_suppliers(shippers, have.toDF("SupplierName")).columns == ["SupplierName"]


def test_package_import(spark, tmp_path):
    base = {k: None for k in packages.IMPORT_KEYS} | {"PackageNumber": "a", "Notes": "n" * 300}
    lines = [base | {"Hazmat": "Yes", "Consolidation": "yes", "Shipper": " acme\t", "LocationLastSeen": "Miami"},
             base | {"PackageNumber": "b", "Notes": None}, {k: v for k, v in base.items() if k != "Supplier"}]
    path = tmp_path / "x.jsonl"
    path.write_text("\n".join(map(json.dumps, lines)) + "\nnot json\n")
    good, rejects = packages.import_packages(spark, str(path))
    row = good.first()
    assert good.count() == 1 and len(good.columns) == 27
    assert (row.Hazmat, row.Consolidation, row.Shipper, row.PackageLocationLastSeenId, len(row.Notes)) == (True, False, "ACME", 6, 255)
    assert sorted(r.reason for r in rejects.collect()) == ["malformed", "missing: Supplier", "null: Notes"]


INVOICE = {
    "InvoiceNumber": "cast(1 as bigint)", "InvoiceDate": "date'2024-01-01'", "PackageNumber": "'p1'", "Consignee": "'c'", "Shipper": "'s'",
    "Route": "'Hold at office'", "InvoiceStatus": "'Paid'", "InvoiceWeight": "2D", "InvoicePieces": "1", "Printed": "1",
    "emailed": "'1'", "Uploaded": "'NO'", "AllowEmail": "cast(null as string)", "AllowPrint": "'yes'",
    "TimePaidOff": "timestamp_ntz'2024-02-01 00:00:00'",
}


def test_invoices(spark):
    rows = landing(spark, INVOICE, {}, {"PackageNumber": "'p2'", "Route": "'?'", "InvoiceStatus": "cast(null as string)",
                                        "Printed": "cast(null as int)", "emailed": "cast(null as string)"})
    first = billing.merge_invoices(None, rows)
    a, b = first.orderBy("PackageNumber").collect()
    assert (a.RouteId, a.InvoiceStatus, a.InvoicePrinted, a.InvoiceEmailed, a.InvoiceUploaded, a.InvoiceAllowEmail) == (263, "Paid", 1, 1, 0, 1)
    assert (b.RouteId, b.InvoiceStatus, b.InvoicePrinted, b.InvoiceEmailed, b.UnKnownId, b.InvoiceUserId) == (None, "Unpaid", 0, 0, None, 1)
    assert "RouteName" not in first.columns
    merged = billing.merge_invoices(first, landing(spark, INVOICE, {"InvoiceStatus": "'open'"}))
    assert {r.PackageNumber: r.InvoiceStatus for r in merged.collect()} == {"p1": "Unpaid", "p2": "Unpaid"}


def test_invoice_lines(spark):
    rows = spark.sql("select * from values (1L, 1L, 'a', 1.23456), (1L, 2L, repeat('x', 120), 2.0), (null, 3L, 'n', 0) "
                     "t(InvoiceNumber, id, ChargeDescription, ChargeValue)")
    loaded = billing.invoice_lines(rows.filter("id = 1"))
    new = billing.invoice_lines(rows, loaded).orderBy("InvoiceDetailId").collect()
    assert [int(r.InvoiceDetailId) for r in new] == [2, 3] and len(new[0].InvoiceDetailChargeName) == 100
    assert str(loaded.first().InvoiceDetailChargeAmount) == "1.2346" and str(loaded.first().InvoiceDetailChargeVat) == "0.0000"


def test_payments_and_charges(spark):
    rows = spark.sql("""select * from values
        (date'2024-01-02', '09:00:00', 5.0, 'i1', 'Castries', 'Ann', 'cash'), (date'2024-01-01', '09:00:00', 6.0, 'i2', null, 'who', 'card'),
        (date'2024-01-02', '08:00:00', 7.0, 'i3', 'Moon', null, null)
        t(PaymentDate, PaymentTime, amount, InvoiceNumber, Route, CreatedBy, PaymentMethod)""")
    got = billing.payments(rows, {"ann": 5}).orderBy("PaymentId").collect()
    assert [(int(r.PaymentId), r.InvoiceNumber, r.PaymentUserId, r.LocationId) for r in got] == [
        (1, "i2", None, None), (2, "i3", None, None), (3, "i1", 5, 253)]
    charges = rows.selectExpr("PaymentDate as DateCreated", "PaymentTime as TimeCreated", "amount as Amount", "InvoiceNumber",
                              "1 as UserId", "PaymentMethod")
    assert [int(r.OtherChargeId) for r in billing.other_charges(charges).orderBy("OtherChargeCreatedDate", "OtherChargeCreatedTime").collect()] == [1, 2, 3]


def test_alerts(spark):
    rows = spark.sql("""select * from values ('a', 1, 'm', 'd', date'2024-02-01', 'ANN ', date'2024-01-02', 'bob', date'2024-01-03', '1', 'r'),
        ('b', 2, 'm', 'd', null, 'who', date'2024-01-01', null, null, null, null)
        t(Active, RelatedRecordID, MainInstruction, Details, EndDate, SetBy, DateSet, DisabledBy, DateDisabled, TimeDisabled, ReasonDisabled)""")
    users = spark.sql("select * from values ('Ann', 1), ('Bob', 2) t(code, id)")
    got = people.alerts(rows, users).orderBy("AlertId").collect()
    assert [(r.AlertId, r.AlertActive, r.UserId, r.AlertDisabledByUserId) for r in got] == [(1, "b", None, None), (2, "a", 1, 2)]


def test_pre_alerts(spark):
    rows = spark.sql("""select '1' as AccountNumber, cast(null as string) as AgentPrefix, 1.0 as Value, 's' as Shipper,
        timestamp_ntz'2024-01-01 00:00:00' as created_at, date'2024-01-01' as DateSet, cast(null as string) as Description,
        'Yes' as Displayed, 'x' as UserId, cast(null as string) as InternationalTrackingNumber,
        cast(null as timestamp_ntz) as LastUpdate, cast(null as string) as Notes, repeat('s', 120) as Supplier""")
    row = people.pre_alerts(rows, F.lit("2024-05-05").cast("timestamp_ntz")).first()
    assert (row.CustomerAgentPrefix, row.PreAlertDescription, row.PreAlertDisplayed, row.PreAlertUserId) == ("", "", True, 0)
    assert row.PreAlertLastUpdate == dt.datetime(2024, 5, 5) and len(row.PreAlertSupplierName) == 100
    assert (row.PreAlertInvoicePDF, row.PreAlertStatus, row.PreAlertId) == (None, None, 1)


CUSTOMER = {v: f"'{v[:3]}'" for v in people.CUSTOMER_COLUMNS.values()} | {v: "cast(null as string)" for v in people.CUSTOMER_FLAGS.values()}


def test_customers(spark):
    rows = landing(spark, CUSTOMER, {"AccountNumber": "'1'"}, {"AccountNumber": "'1'"}, {"AccountNumber": "'2'"},
                   {"AccountNumber": "'3'", "AgentPrefix": "cast(null as string)", "FirstName": "cast(null as string)", "Active": "'Yes'"})
    have = spark.sql("select '2' as CustomerAccountNumber, 'AGE ' as CustomerAgentPrefix")
    missing = people.missing_customers(rows, have).orderBy("CustomerAccountNumber").collect()
    assert [(r.CustomerAccountNumber, r.CustomerName, r.CustomerIsActive) for r in missing] == [("1", "Age1 Fir Las", 0), ("3", "3  Las", 1)]
    assert (missing[0].CustomerCountryId, missing[0].CustomerBirthDate) == (758, "1900-01-01")


def test_customer_upsert_keeps_insert_only_columns(spark):
    columns = "CustomerAccountNumber string, CustomerAgentPrefix string, CustomerName string, CustomerBirthDate string, CustomerPassword string"
    target = spark.createDataFrame([("1", "A", "old", "1980", "secret")], columns)
    source = spark.createDataFrame([("1", "A", None, "1900", "x"), ("1", "B", "new", "1901", "y")], columns)
    got = {r.CustomerAgentPrefix: tuple(r)[2:] for r in people.upsert_customers(target, source).collect()}
    assert got == {"A": (None, "1980", "secret"), "B": ("new", "1901", "y")}


def test_sign_ups(spark):
    names = {v: "'x'" for v in people.SIGN_UP_COLUMNS.values()}
    parts = {f"{p}{x}": "cast(null as string)" for p in ("Primary_Delivery", "Residential") for x in ("Street1", "Street2", "City")}
    rows = landing(spark, names | parts, {"DateLogged": "'2024-01-02'", "Primary_DeliveryStreet1": "'a'", "Primary_DeliveryCity": "'c'"},
                   {"DateLogged": "'2024-01-01'", "ResidentialCity": "'town'"})
    a, b = people.sign_ups(rows).orderBy("SignUpId").collect()
    assert (a.SignUpLoggedDate, a.SignUpResidentialAddress, a.SignUpPrimaryDeliveryAddress) == ("2024-01-01", " town", "")
    assert (b.SignUpId, b.SignUpPrimaryDeliveryAddress, b.SignUpAccountTypeId, b.SignUpContactEmail) == (2, "a c", 1, None)


def test_current_year_packages(spark):
    rows = spark.sql("""select * from values ('p1', 'Y', 'n', '1.005', date'2024-12-31', '10:00', 'Miami'),
        ('p2', null, 'Y', '2', date'2023-12-31', null, 'x'), ('p3', 'N', null, null, null, null, null)
        t(PackageNumber, Hazmat, Consolidation, Length, DateLastSeen, TimeLastSeen, LocationLastSeen)""").selectExpr(
        "*", "Length as Width", "Length as Height", "Length as TotalWeight", "Length as VolumetricWeight", "'n' as Notes",
        "cast(null as string) as DateFirstSeen", "'08:00' as TimeFirstSeen")
    got = packages.current_year_packages(rows, dt.date(2024, 3, 1)).collect()
    assert len(got) == 1 and (got[0].Hazmat, got[0].Consolidation, str(got[0].Length)) == (True, False, "1.01")
    assert (got[0].last_seen_datetime, got[0].PackageFirstSeenDateTime, got[0].package_location_last_seen_id) == ("2024-12-31 10:00", " 08:00", 6)


def test_bootstrap_users(spark):
    users = spark.sql("""select 'a' as UserFirstName, 'nn' as UserLastName, 'g' as UserGUID, date'2020-01-01' as UserValidFromDate,
                      date'2021-01-01' as UserValidUntilDate, 1 as UserIsActive, 'ann' as UserName""")
    logins = spark.createDataFrame([("ann",), ("bob",), (None,)], "input_by string")
    got = {r.UserName: r for r in people.bootstrap_users(users, logins, dt.date(2024, 2, 29)).collect()}
    assert set(got) == {"ann", "bob"} and (got["bob"].UserFirstName, got["bob"].UserLastName) == ("b", "ob")
    assert got["bob"].UserValidUntilDate == dt.date(2025, 2, 28)
    assert len(got["bob"].UserGUID) == 36 and got["bob"].UserGUID.count("-") == 4
    nobody = users.withColumn("UserName", F.lit(None).cast("string"))
    assert people.bootstrap_users(nobody, logins, dt.date(2024, 1, 1)).count() == 1  # NOT IN a list with NULL
