"""The migration jobs on landing tables derived from the test tables.

The landing columns are expressions both engines read; what the jobs make of them is stated in each
query's own SQL.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harborline.operators.suite import run_suite
from harborline.plans import billing, packages, people
from harborline.plans.constraints import REFERENCES, REQUIRED, UNIQUE, target_checks
from harborline.session import staging_path
from workload.registry import Tables, query


def columns(landing: list[str]) -> str:
    return ",\n           ".join(landing)


# A parcel per order.
PACKAGES = [
    "concat(case when o_orderstatus = 'F' then 'oce-' else 'AIR-' end, cast(o_orderkey as string)) as PackageNumber",
    "concat('T', cast(o_orderkey as string)) as InternationalTrackingNumber",
    "nullif(o_orderpriority, '5-LOW') as prealert_tracking_number",
    "nullif(o_orderstatus, 'O') as SupplierInvoiceNumber",
    "o_orderpriority as PackageDescription",
    "o_orderstatus as TariffDescription",
    "case o_orderstatus when 'F' then 'Yes' when 'O' then 'no' end as hazmat",
    "case o_orderstatus when 'F' then 'NO' when 'O' then 'yes' end as Consolidation",
    "cast(null as string) as ConsolidationPackageNumber",
    "case o_orderpriority when '1-URGENT' then 'Fast Freight' when '2-HIGH' then 'fast freight ' when '3-MEDIUM' "
    "then 'Slow Boat' when '4-NOT SPECIFIED' then 'Customer#000000003' end as shipper",
    "'BSL' as agent_prefix",
    "case o_orderpriority when '1-URGENT' then 'castries' when '2-HIGH' then 'RB BOX 10' when '3-MEDIUM' then "
    "'VF SHELF 2' when '4-NOT SPECIFIED' then 'Miami' end as LocationLastSeen",
    "concat('note ', o_orderpriority) as notes",
    "o_orderstatus as packed_in_shipment",
    "case o_orderpriority when '1-URGENT' then 'DELIVERED' when '2-HIGH' then 'Was in transit today' when '3-MEDIUM' "
    "then 'Detained at Customs' when '4-NOT SPECIFIED' then 'elsewhere' end as PackageStatus",
    "1 as TotalPieces",
    "1 as length",
    "2 as width",
    "3 as height",
    "o_totalprice as TotalWeight",
    "o_totalprice as PackageValue",
    "cast(o_orderdate as date) as DateFirstSeen",
    "case when o_orderstatus <> 'P' then '08:30:00' end as TimeFirstSeen",
    "o_custkey as AccountNumber",
    "o_orderdate as created_at",
]
PACKAGES_SQL = f"select {columns(PACKAGES)} from orders"


@query(f"""
    with landing as ({PACKAGES_SQL})
    select PackageNumber, InternationalTrackingNumber as PackageInternationalTrackingNu,
           coalesce(prealert_tracking_number, '') as PackagePrealertTrackingNumber,
           coalesce(SupplierInvoiceNumber, '') as PackageSupplierInvoiceNumber, PackageDescription,
           TariffDescription as PackageTariffDescription,
           case when hazmat = 'Yes' then 1 else 0 end as PackageHazmat,
           case when Consolidation = 'NO' then 0 else 1 end as PackagePartMultiplePiece,
           TotalPieces as PackageTotalPieces, case when Consolidation = 'NO' then 0 else 1 end as PackageConsolidation,
           ConsolidationPackageNumber as PackageConsolidationPackageNum, length as PackageLength,
           width as PackageWidth, height as PackageHeight, TotalWeight as PackageTotalWeight,
           shipper as PackageShipper, PackageValue,
           case when TimeFirstSeen is not null then created_at + interval 510 minute end as PackageFirstSeenDateTime,
           AccountNumber as CustomerAccountNumber, agent_prefix as CustomerAgentPrefix,
           case LocationLastSeen when 'castries' then 1 when 'RB BOX 10' then 2 when 'Miami' then 6 end::bigint
               as PackageLocationLastSeenId,
           notes as PackageNotes, packed_in_shipment as PackagePackedInShipment,
           case PackageStatus when 'DELIVERED' then 'Delivered' when 'Was in transit today' then 'In Transit'
                when 'Detained at Customs' then 'Detained' else 'Received' end as PackageActualStatusName,
           substring(PackageNumber, 5, 12) as PackageAirwayBillNumber,
           case when left(PackageNumber, 3) = 'oce' then 1 else 0 end as PackageOcean,
           created_at as PackageCreationDate, TotalWeight as PackageWeight,
           case LocationLastSeen when 'castries' then 1 when 'RB BOX 10' then 2 when 'VF SHELF 2' then 5
                when 'Miami' then 6 end as PackageLocationId,
           case LocationLastSeen when 'RB BOX 10' then 10 when 'VF SHELF 2' then 2 end::bigint
               as PackageLocationLastStorageId,
           case LocationLastSeen when 'RB BOX 10' then 'BOX' when 'VF SHELF 2' then 'SHELF' end
               as PackageLocationLastStorageType,
           shipper as CourierName, shipper as SupplierName,
           case when c_acctbal > 5000 then 1 else 0 end as AvailableSaturdayFlag, 12 as UserId, 1 as PackageDuration,
           null::integer as ManifestId, null::integer as RepositoryNumber, null::varchar as RepositoryType,
           '' as PackageInvoicePDF, 0 as PackageMarked, '' as PackageTransactionIdentifier, '' as PackageSpiToken,
           null::integer as ConsigneeId, 'Saint Lucia' as DestinationName, '' as PackagePhoto
    from landing join customer on c_custkey = AccountNumber and c_mktsegment <> 'FURNITURE'
    where created_at >= timestamp '1996-01-01' and (created_at < timestamp '1999-01-01' or created_at >= timestamp '2000-01-01')
    """)
def job_packages(t: Tables) -> DataFrame:
    """Orders from 1996 on are the known packages; those of 1999 are loaded already."""
    return packages_job(t)


def packages_job(t: Tables, stored_key: str | None = None) -> DataFrame:
    landing = t.orders.selectExpr(*PACKAGES)
    known = landing.filter("created_at >= timestamp_ntz '1996-01-01'").select(F.upper("PackageNumber").alias("PackageNumber"))
    loaded = landing.filter("year(created_at) = 1999").select("PackageNumber")
    if stored_key:
        loaded = loaded.withColumn(stored_key, F.lower(F.rtrim("PackageNumber")))
    customers = t.customer.selectExpr(
        "c_custkey as CustomerAccountNumber", "case when c_mktsegment = 'FURNITURE' then 'XYZ' else 'bsl' end "
        "as CustomerAgentPrefix", "if(c_acctbal > 5000, 1, 0) as CustomerAvailableSaturday")
    rows = packages.load_packages(landing, known, customers, loaded, stored_key=stored_key)
    rows = rows.drop(stored_key) if stored_key else rows
    return rows.withColumn("PackageLocationLastStorageId", F.col("PackageLocationLastStorageId").cast("bigint"))


EVENTS = [
    "concat('U', cast(user_id as string)) as PackageNumber",
    "case event_type when 'view' then 'IN TRANSIT to port' when 'purchase' then 'Out for Delivery' when 'signup' then "
    "'Received at Warehouse' when 'error' then 'Detained at Customs' when 'click' then 'Was Delivered' "
    "end as EventDescription",
    "cast(ts as date) as EventDate",
    "case when event_type <> 'error' then substring(cast(ts as string), 12, 8) end as EventTime",
    "ts",
]
EVENT_STATUS = """case event_type when 'view' then 'In Transit' when 'purchase' then 'Out For Delivery'
                  when 'signup' then 'ReceivedWarehouse' when 'click' then 'Delivered' else 'Received' end"""


@query(f"""
    with e as (select 'U' || user_id as PackageNumber, {EVENT_STATUS} as PackageStatusName,
                      case when event_type <> 'error' then date_trunc('second', ts) end as EventDate, ts
               from events where user_id in (select c_custkey from customer where c_mktsegment <> 'BUILDING'))
    select distinct PackageNumber, PackageStatusName, EventDate, 100 as PackageEventUserId,
           false as PackageEventInvoiceVerified, null::varchar as PackageEventInvoiceNumber
    from e where not exists (
        select 1 from e l where l.ts < timestamp '2024-01-15' and l.PackageNumber = e.PackageNumber
        and l.PackageStatusName = e.PackageStatusName and l.EventDate = e.EventDate)""")
def job_event_history(t: Tables) -> DataFrame:
    """Events before 15 January are loaded already; the ones without a time come again every run."""
    landing = t.events.selectExpr(*EVENTS)
    known = t.customer.filter("c_mktsegment <> 'BUILDING'").selectExpr("concat('u', c_custkey, ' ') as PackageNumber")
    loaded = packages.event_history(landing.filter("ts < timestamp_ntz '2024-01-15'"), known)
    return packages.event_history(landing, known, loaded)


@query(f"""
    with e as (select 'U' || user_id as PackageNumber, {EVENT_STATUS} as PackageStatusName,
                      case when event_type <> 'error' then date_trunc('second', ts) end as EventDate, ts
               from events where user_id in (select c_custkey from customer where c_mktsegment <> 'BUILDING')),
    fresh as (select distinct PackageNumber, PackageStatusName, EventDate from e where not exists (
        select 1 from e l where l.ts < timestamp '2024-01-15' and l.PackageNumber = e.PackageNumber
        and l.PackageStatusName = e.PackageStatusName and l.EventDate = e.EventDate))
    select cast(EventDate as date) as day, PackageStatusName as status, count(*) as n_events
    from fresh group by 1, 2""")
def event_history_by_day(t: Tables) -> DataFrame:
    """The event history job end to end, then the new events per day and status."""
    return (job_event_history(t).groupBy(F.to_date("EventDate").alias("day"), F.col("PackageStatusName").alias("status"))
            .agg(F.count(F.lit(1)).alias("n_events")))


@query(f"""
    with landing as ({PACKAGES_SQL})
    select min(shipper) as CourierName from landing
    where shipper is null or lower(rtrim(shipper)) not in (select lower(c_name) from customer)
    group by lower(rtrim(shipper))""")
def job_couriers(t: Tables) -> DataFrame:
    landing = t.orders.selectExpr(*PACKAGES)
    return packages.missing_couriers(landing, t.customer.select(F.upper("c_name").alias("CourierName")))


@query(f"""
    with landing as ({PACKAGES_SQL})
    select min(shipper) as SupplierName from landing
    where shipper is null or lower(rtrim(shipper)) not in (select lower(s_name) from supplier)
    group by lower(rtrim(shipper))""")
def job_suppliers(t: Tables) -> DataFrame:
    landing = t.orders.selectExpr(*PACKAGES)
    return packages.missing_suppliers(landing, t.supplier.selectExpr("s_name as SupplierName"))


INVOICES = [
    "o_orderkey as InvoiceNumber",
    "cast(o_orderdate as date) as InvoiceDate",
    "concat('p', cast(o_orderkey as string)) as PackageNumber",
    "concat('Customer ', cast(o_custkey as string)) as Consignee",
    "'Acme' as Shipper",
    "case o_orderpriority when '1-URGENT' then 'CASTRIES' when '2-HIGH' then 'Hold at Office' when '3-MEDIUM' then "
    "'Micoud ' when '4-NOT SPECIFIED' then 'Nowhere' end as Route",
    "case o_orderstatus when 'F' then 'paid' when 'O' then 'open' end as InvoiceStatus",
    "o_totalprice as InvoiceWeight",
    "1 as InvoicePieces",
    "case o_orderstatus when 'F' then 1 when 'O' then 0 end as Printed",
    "case o_orderstatus when 'F' then '1' when 'O' then '0' end as emailed",
    "case o_orderstatus when 'F' then 'No' when 'O' then 'yes' end as Uploaded",
    "'no' as AllowEmail",
    "cast(null as string) as AllowPrint",
    "case when o_orderstatus = 'F' then o_orderdate end as TimePaidOff",
]


@query(f"""
    with landing as (select {columns(INVOICES)} from orders)
    select InvoiceNumber, InvoiceDate, Consignee as InvoiceConsignee,
           case when InvoiceDate >= date '1998-01-01' then PackageNumber else upper(PackageNumber) end as PackageNumber,
           Shipper as InvoiceShipper,
           case when InvoiceStatus = 'paid' then 'Paid' else 'Unpaid' end as InvoiceStatus,
           case Route when 'CASTRIES' then 253 when 'Hold at Office' then 263 when 'Micoud ' then 255 end as RouteId,
           case when InvoiceDate >= date '1998-01-01' then InvoiceWeight else InvoiceWeight + 5 end as InvoiceWeight,
           InvoicePieces, case when Printed = 1 then 1 else 0 end as InvoicePrinted,
           case when emailed = '1' then 1 else 0 end as InvoiceEmailed,
           case when Uploaded = 'No' then 0 else 1 end as InvoiceUploaded, 0 as InvoiceAllowEmail,
           1 as InvoiceAllowPrint, TimePaidOff as InvoicePaidOffDate, TimePaidOff as InvoicePaidOffTime,
           null::integer as UnKnownId, 1 as InvoiceUserId
    from landing""")
def job_invoices(t: Tables) -> DataFrame:
    """Invoices loaded with another weight, and numbers in upper case, up to 1998; merged with those from 1998 on."""
    landing = t.orders.selectExpr(*INVOICES)
    before = (landing.filter("InvoiceDate < date '1999-01-01'")
              .withColumns({"InvoiceWeight": F.col("InvoiceWeight") + 5, "PackageNumber": F.upper("PackageNumber")}))
    target = billing.merge_invoices(None, before)
    return billing.merge_invoices(target, landing.filter("InvoiceDate >= date '1998-01-01'"))


@query("""
    select l_orderkey::decimal(11,0) as InvoiceNumber, l_linenumber::decimal(11,0) as InvoiceDetailId,
           l_returnflag as InvoiceDetailChargeName, l_extendedprice::decimal(19,4) as InvoiceDetailChargeAmount,
           0::decimal(19,4) as InvoiceDetailChargeVat
    from lineitem l where not exists (
        select 1 from lineitem r where r.l_shipdate < timestamp '1998-01-01' and r.l_orderkey = l.l_orderkey
        and r.l_linenumber = l.l_linenumber)""")
def job_invoice_lines(t: Tables) -> DataFrame:
    """Lines whose invoice and number were not shipped before 1998."""
    landing = t.lineitem.selectExpr("l_orderkey as InvoiceNumber", "l_linenumber as id",
                                    "l_returnflag as ChargeDescription", "l_extendedprice as ChargeValue", "l_shipdate")
    loaded = billing.invoice_lines(landing.filter("l_shipdate < timestamp_ntz '1998-01-01'"))
    return billing.invoice_lines(landing, loaded)


@query("""
    select cast(o_orderdate as date) as PaymentDate, '08:00:00' as PaymentTime, o_totalprice as PaymentAmount,
           o_orderkey as InvoiceNumber, '08:00:00' as PaymentCreatedDateTime,
           case when c_nationkey < 20 then c_nationkey end as PaymentUserId,
           case o_orderpriority when '1-URGENT' then 253 when '2-HIGH' then 316 end as LocationId,
           o_orderstatus as PaymentMethodName,
           row_number() over (order by cast(o_orderdate as date), o_orderkey)::decimal(11,0) as PaymentId
    from orders join customer on c_custkey = o_custkey""")
def job_payments(t: Tables) -> DataFrame:
    """The login map is a table: nation names as logins."""
    landing = (t.orders.join(t.customer, F.col("c_custkey") == F.col("o_custkey")).selectExpr(
        "cast(o_orderdate as date) as PaymentDate", "'08:00:00' as PaymentTime", "o_totalprice as amount",
        "o_orderkey as InvoiceNumber", "concat('nation_', c_nationkey) as CreatedBy", "o_orderstatus as PaymentMethod",
        "case o_orderpriority when '1-URGENT' then 'castries' when '2-HIGH' then 'Vieux Fort Office' "
        "when '3-MEDIUM' then 'elsewhere' end as Route"))
    users = t.nation.filter("n_nationkey < 20").selectExpr("n_name as code", "n_nationkey as id")
    return billing.payments(landing, users)


@query("""
    select cast(o_orderdate as date) as OtherChargeCreatedDate, '10:00:00' as OtherChargeCreatedTime,
           o_totalprice as OtherChargeAmount, o_orderkey as InvoiceNumber, 7 as OtherChargeUserId,
           o_orderstatus as PaymentMethodName,
           row_number() over (order by o_orderdate, o_orderkey)::decimal(11,0) as OtherChargeId
    from orders""")
def job_other_charges(t: Tables) -> DataFrame:
    landing = t.orders.selectExpr(
        "cast(o_orderdate as date) as DateCreated", "'10:00:00' as TimeCreated", "o_totalprice as Amount",
        "o_orderkey as InvoiceNumber", "7 as UserId", "o_orderstatus as PaymentMethod")
    return billing.other_charges(landing)


@query("""
    select event_type as AlertActive, event_id as AlertRelatedRecordId, 'hold' as AlertmainInstruction,
           props as AlertDetails, cast(ts as date) + 7 as AlertEndDate, set_by.id as UserId,
           cast(ts as date) as AlertStartDate, disabled_by.id as AlertDisabledByUserId,
           cast(ts as date) + 3 as AlertDisabledDate, '12:00:00' as AlertDisabledTime, null::varchar as AlertDisabledReason,
           row_number() over (order by cast(ts as date), event_id)::integer as AlertId
    from events
    left join (values ('view', 10), ('click', 11), ('error', 12)) set_by(code, id) on set_by.code = event_type
    left join (values ('view', 10), ('click', 11), ('error', 12)) disabled_by(code, id)
      on disabled_by.code = case when value > 50 then 'error' end""")
def job_alerts(t: Tables) -> DataFrame:
    landing = t.events.selectExpr(
        "event_type as Active", "event_id as RelatedRecordID", "'hold' as MainInstruction", "props as Details",
        "date_add(cast(ts as date), 7) as EndDate", "upper(event_type) as SetBy", "cast(ts as date) as DateSet",
        "case when value > 50 then 'Error ' end as DisabledBy", "date_add(cast(ts as date), 3) as DateDisabled",
        "'12:00:00' as TimeDisabled", "cast(null as string) as ReasonDisabled")
    return people.alerts(landing, {"view": 10, "click": 11, "error": 12})


@query("""
    select o_orderkey as CustomerAccountNumber, left(coalesce(nullif(o_orderpriority, '5-LOW'), ''), 3) as CustomerAgentPrefix,
           o_totalprice as PreAlertAmount, 'Acme' as PreAlertCourierName, o_orderdate as PreAlertCreatedAt,
           date_trunc('day', o_orderdate) as PreAlertDateSet, coalesce(nullif(o_orderstatus, 'F'), '') as PreAlertDescription,
           o_orderstatus = 'O' as PreAlertDisplayed, case when o_orderstatus = 'P' then 0 else 42 end as PreAlertUserId,
           left(repeat('x', 60), 50) as PreAlertInternationalTrackingN,
           case when o_orderstatus = 'F' then timestamp '2024-06-01' else o_orderdate end as PreAlertLastUpdate,
           '' as PreAlertNotes, o_orderpriority as PreAlertSupplierName, null::blob as PreAlertInvoicePDF,
           false as PreAlertSentAMAD, null::varchar as PreAlertStatus,
           row_number() over (order by o_orderdate, o_orderkey)::integer as PreAlertId
    from orders""")
def job_pre_alerts(t: Tables) -> DataFrame:
    landing = t.orders.selectExpr(
        "o_orderkey as AccountNumber", "nullif(o_orderpriority, '5-LOW') as AgentPrefix", "o_totalprice as Value",
        "'Acme' as Shipper", "o_orderdate as created_at", "cast(o_orderdate as date) as DateSet",
        "nullif(o_orderstatus, 'F') as Description", "case o_orderstatus when 'O' then 'YES' when 'F' then 'no' end as Displayed",
        "case when o_orderstatus = 'P' then 'nobody' else '42' end as UserId",
        "repeat('x', 60) as InternationalTrackingNumber",
        "case when o_orderstatus <> 'F' then o_orderdate end as LastUpdate", "cast(null as string) as Notes",
        "o_orderpriority as Supplier")
    return people.pre_alerts(landing, F.lit("2024-06-01").cast("timestamp_ntz"))


SIGN_UPS = [
    "cast(c_custkey as string) as TimeLogged", "c_nationkey as DateLogged", "'10.0.0.1' as IpAddress",
    "'1' as IdTypeId", "c_mktsegment as FirstName", "c_name as LastName", "'a' as ContactFirstName",
    "'b' as ContactLastName", "concat(lower(c_mktsegment), '@example.com') as Email", "'Acme' as Company", "'1' as Tel1",
    "'2' as Tel2", "'3' as Tel3", "'4' as Fax", "'yes' as insuranceaccepted", "c_custkey as accountnumber",
    "'no' as processed", "'r' as reference", "'2024' as created_at", "'2025' as updated_at",
    "nullif(c_mktsegment, 'BUILDING') as Primary_DeliveryStreet1", "nullif(c_mktsegment, 'MACHINERY') as Primary_DeliveryStreet2",
    "'Town' as Primary_DeliveryCity", "c_name as ResidentialStreet1", "cast(null as string) as ResidentialStreet2",
    "nullif(c_mktsegment, 'HOUSEHOLD') as ResidentialCity",
]


@query(f"""
    with landing as (select {columns(SIGN_UPS)} from customer)
    select DateLogged as SignUpLoggedDate, TimeLogged as SignUpLoggedTime, IpAddress as SignUpIPAddress, IdTypeId,
           FirstName as SignUpFirstName, LastName as SignUpLastName, ContactFirstName as SignUpContactFirstName,
           ContactLastName as SignUpContactLastName, Email as SignUpEmail, Company as SignUpCompany,
           Tel1 as SignUpMainPhone, Tel2 as SignUpSecondPhone, Tel3 as SignUpThirdPhone, Fax as SignUpFax,
           insuranceaccepted as SignUpInsuranceAccepted, accountnumber as SignUpAccountNumber,
           processed as SignUpProcessed, reference as SignUpReference, created_at as SignUpCreatedAt,
           updated_at as SignUpUpdatedAt,
           coalesce(Primary_DeliveryStreet1, '') || coalesce(' ' || Primary_DeliveryStreet2, '') || ' Town'
               as SignUpPrimaryDeliveryAddress,
           ResidentialStreet1 || coalesce(' ' || ResidentialCity, '') as SignUpResidentialAddress,
           1 as SignUpAccountTypeId, '' as SignUpIDImage, '' as SignUpImage, null::varchar as SignUpContactIdTypeId,
           null::varchar as SignUpContactEmail, null::varchar as SignUpSecondContactEmail,
           null::varchar as SignUpSecondContactFirstName, null::varchar as SignUpSecondContactLastName,
           row_number() over (order by DateLogged, TimeLogged)::integer as SignUpId
    from landing""")
def job_sign_ups(t: Tables) -> DataFrame:
    return people.sign_ups(t.customer.selectExpr(*SIGN_UPS))


CUSTOMERS = [
    "c_custkey as AccountNumber", "case when c_nationkey < 20 then 'BSL' end as AgentPrefix", "'Ms' as Title",
    "nullif(c_mktsegment, 'BUILDING') as FirstName", "c_name as LastName", "date '2020-02-02' as DateStarted",
    "case when c_acctbal > 0 then 'Yes' when c_acctbal > -500 then 'no' end as HasContact", "'a@example.com' as Email",
    "'Acme' as Company", "'1' as Tel1", "'2' as Tel2", "'3' as Tel3", "'4' as Work_tel", "'5' as Fax",
    "c_nationkey as RouteID", "'s1' as ResidentialStreet1", "'s2' as ResidentialStreet2", "'rc' as ResidentialCity",
    "'p1' as Primary_DeliveryStreet1", "'p2' as Primary_DeliveryStreet2", "'pc' as Primary_DeliveryCity",
    "'d1' as Secondary_DeliveryStreet1", "'d2' as Secondary_DeliveryStreet2", "'dc' as Secondary_DeliveryCity",
    "'id' as IDNumber", "'1' as IDTypeID", "'yes' as InsuranceAccepted", "'no' as CreditCardOnFile",
    "'YES ' as Active", "cast(null as string) as AvailableSaturday", "concat('pw', c_custkey) as CustomerPassword",
]


@query(f"""
    with landing as (select {columns(CUSTOMERS)} from customer)
    select AccountNumber as CustomerAccountNumber, AgentPrefix as CustomerAgentPrefix, Title as CustomerTitle,
           FirstName as CustomerFirstName, LastName as CustomerLastName, DateStarted as CustomerStartedDate,
           CustomerPassword, Email as CustomerEmail, Company as CompanyName, Tel1 as CustomerMainPhone, Tel2 as CustomerSecondPhone,
           Tel3 as CustomerThirdPhone, Work_tel as CustomerWorkPhone, Fax as CustomerFax,
           RouteID as CustomerDefaultRouteId, ResidentialStreet1 as CustomerResidentialStreet1,
           ResidentialStreet2 as CustomerResidentialStreet2, ResidentialCity as CustomerResidentialCity,
           Primary_DeliveryStreet1 as CustomerPrimaryDeliveryStreet1,
           Primary_DeliveryStreet2 as CustomerPrimaryDeliveryStreet2, Primary_DeliveryCity as CustomerPrimaryDeliveryCity,
           Secondary_DeliveryStreet1 as CustomerSecDeliveryStreet1, Secondary_DeliveryStreet2 as CustomerSecDeliveryStreet2,
           Secondary_DeliveryCity as CustomerSecondaryDeliveryCity, IDNumber as CustomerIdNumber, IDTypeID as IdTypeId,
           case when HasContact = 'Yes' then 1 else 0 end as CustomerHasContact, 1 as CustomerInsuranceAccepted,
           0 as CustomerCreditCardOnFile, 1 as CustomerIsActive, 0 as CustomerAvailableSaturday,
           coalesce(AgentPrefix, '') || AccountNumber || ' ' || coalesce(FirstName, '') || ' ' || LastName as CustomerName,
           '1900-01-01' as CustomerBirthDate, ' ' as CustomerImageProfile, '' as CustomerReference,
           758 as CustomerCountryId
    from landing where AgentPrefix is null or not exists (
        select 1 from orders where o_custkey = AccountNumber and o_totalprice > 450000)""")
def job_missing_customers(t: Tables) -> DataFrame:
    """Customers without a very large order are missing from the target; one without a prefix always is."""
    known = t.orders.filter("o_totalprice > 450000").selectExpr("o_custkey as CustomerAccountNumber",
                                                                "'bsl' as CustomerAgentPrefix")
    return people.missing_customers(t.customer.selectExpr(*CUSTOMERS), known)


CUSTOMER_TARGET = [
    "c_custkey as CustomerAccountNumber", "'BSL' as CustomerAgentPrefix", "c_name as CustomerName",
    "'1980-01-01' as CustomerBirthDate", "'x' as CustomerImageProfile", "'secret' as CustomerPassword",
    "c_acctbal as CustomerBalance",
]


@query("""
    with known as (select * from customer where c_acctbal > 1000),
         source as (select c_custkey, 'BSL' || c_custkey || ' ' || c_mktsegment || ' ' || c_name as name
                    from customer where c_nationkey > 5)
    select coalesce(k.c_custkey, s.c_custkey) as CustomerAccountNumber, 'BSL' as CustomerAgentPrefix,
           case when s.c_custkey is null then k.c_name else s.name end as CustomerName,
           case when k.c_custkey is null then '1900-01-01' else '1980-01-01' end as CustomerBirthDate,
           case when k.c_custkey is null then ' ' else 'x' end as CustomerImageProfile,
           case when k.c_custkey is null then 'pw-' || s.c_custkey else 'secret' end as CustomerPassword,
           k.c_acctbal as CustomerBalance
    from known k full join source s on s.c_custkey = k.c_custkey""")
def job_customer_upsert(t: Tables) -> DataFrame:
    """Birth date, image and password stay for known customers; a column the source lacks stays too."""
    given = {"AccountNumber": "c_custkey", "AgentPrefix": "'BSL'", "FirstName": "c_mktsegment", "LastName": "c_name",
             "CustomerPassword": "concat('pw-', c_custkey)"}
    wanted = [*people.CUSTOMER_COLUMNS.values(), *people.CUSTOMER_FLAGS.values()]
    landing = t.customer.filter("c_nationkey > 5").selectExpr(
        *[f"{given.get(c, 'cast(null as string)')} as {c}" for c in wanted])
    return people.upsert_customers(t.customer.filter("c_acctbal > 1000").selectExpr(*CUSTOMER_TARGET),
                                   people.customer_rows(landing))


# An export line's values, as expressions both engines read; other keys are NULL.
EXPORT = {
    "PackageNumber": "concat('P', o_orderkey)", "InternationalTrackingNumber": "concat('T', o_orderkey)",
    "SupplierInvoiceNumber": "nullif(o_orderstatus, 'O')", "PackageDescription": "o_orderpriority",
    "TariffDescription": "o_orderstatus", "Hazmat": "case when o_orderstatus = 'F' then 'Yes' else 'yes' end",
    "TotalPieces": "'2'", "Consolidation": "case when o_orderstatus = 'O' then 'Yes' end",
    "ConsolidationPackageNumber": "concat('C', o_custkey)", "Length": "'1'", "Width": "'2'", "Height": "'3'",
    "TotalWeight": "'4.5'", "Shipper": "case when o_orderstatus = 'P' then null else ' Acme ' end", "PackageValue": "'9'",
    "PackageFirstSeenDateTime": "'2020-01-01 00:00:00'", "AccountNumber": "concat('', o_custkey)",
    "LocationLastSeen": "case o_orderpriority when '1-URGENT' then 'Castries' when '2-HIGH' then 'Miami' end",
    "PackageStatus": "o_orderstatus", "Supplier": "nullif(o_orderpriority, '2-HIGH')", "created_at": "'2020-02-02'",
}
EXPORT_KEPT = ["PackageNumber", "InternationalTrackingNumber", "SupplierInvoiceNumber", "PackageDescription", "TariffDescription",
               "TotalPieces", "ConsolidationPackageNumber", "Length", "Width", "Height", "TotalWeight", "PackageValue",
               "PackageFirstSeenDateTime", "PackageStatus"]


@query(f"""
    with line as (select {", ".join(f"{EXPORT.get(k, 'null')} as e_{k}" for k in packages.IMPORT_KEYS if k != "Notes")},
                         o_orderpriority as priority from orders)
    select {", ".join(f"e_{k} as {k}" for k in EXPORT_KEPT)}, e_Hazmat = 'Yes' as Hazmat,
           coalesce(e_Consolidation = 'Yes', false) as Consolidation, coalesce(upper(trim(e_Shipper)), '') as Shipper,
           e_AccountNumber as CustomerAccountNumber,
           case priority when '1-URGENT' then 1 when '2-HIGH' then 6 end::bigint as PackageLocationLastSeenId,
           'note ' || priority as Notes, e_Supplier as SupplierName, e_created_at as PackageCreationDate,
           ' ' as PrealertTrackingNumber, 12 as UserId, '' as PackedInShipment, null as CourierName, 1 as ManifestId
    from line where priority not in ('4-NOT SPECIFIED', '5-LOW')
    union all by name
    select 'rejects' as PackageNumber, reason as Shipper, n as PackageLocationLastSeenId from (
        select case when o_orderpriority = '5-LOW' then 'null: Notes' else 'missing: Notes' end as reason, count(*) as n
        from orders where o_orderpriority in ('4-NOT SPECIFIED', '5-LOW') group by 1)""")
def job_package_import(t: Tables) -> DataFrame:
    """A JSON-lines export: some packages lack the notes, in others they are NULL."""
    fields = [F.expr(EXPORT.get(k, "cast(null as string)")).alias(k) for k in packages.IMPORT_KEYS if k != "Notes"]
    notes = F.expr("nullif(concat('note ', o_orderpriority), 'note 5-LOW')").alias("Notes")
    keep_nulls = {"ignoreNullFields": "false"}
    line = F.when(F.col("o_orderpriority") == "4-NOT SPECIFIED", F.to_json(F.struct(*fields), keep_nulls))
    path = staging_path(t.spark, "packages-jsonl")
    t.orders.select(line.otherwise(F.to_json(F.struct(*fields, notes), keep_nulls)).alias("value")).write.text(path)
    good, rejects = packages.import_packages(t.spark, path)
    reasons = rejects.groupBy(F.col("reason").alias("Shipper")).agg(
        F.count(F.lit(1)).alias("PackageLocationLastSeenId")).withColumn("PackageNumber", F.lit("rejects"))
    return good.unionByName(reasons, allowMissingColumns=True)


@query("""
    select o_orderkey as PackageNumber, o_orderstatus = 'F' as Hazmat, false as Consolidation,
           1.5::decimal(10,2) as Length, 2::decimal(10,2) as Width, 3::decimal(10,2) as Height,
           o_totalprice::decimal(10,2) as TotalWeight, null::decimal(10,2) as VolumetricWeight,
           left(repeat(o_orderpriority, 40), 255) as Notes,
           case o_orderpriority when '1-URGENT' then 1 when '2-HIGH' then 7 end::bigint as package_location_last_seen_id,
           '2020-01-01 08:00:00' as PackageFirstSeenDateTime, cast(cast(o_orderdate as date) as varchar) || ' '
               as last_seen_datetime
    from orders where year(o_orderdate) = 1999""")
def job_current_year_packages(t: Tables) -> DataFrame:
    landing = t.orders.selectExpr(
        "o_orderkey as PackageNumber", "if(o_orderstatus = 'F', 'Y', null) as Hazmat", "'N' as Consolidation",
        "'1.5' as Length", "'2' as Width", "'3' as Height", "o_totalprice as TotalWeight",
        "cast(null as string) as VolumetricWeight", "repeat(o_orderpriority, 40) as Notes",
        "case o_orderpriority when '1-URGENT' then 'castries' when '2-HIGH' then 'Local Warehouse' end as LocationLastSeen",
        "'2020-01-01' as DateFirstSeen", "'08:00:00' as TimeFirstSeen", "cast(o_orderdate as date) as DateLastSeen",
        "cast(null as string) as TimeLastSeen")
    return packages.current_year_packages(landing, dt.date(1999, 7, 1))


@query("""
    with u as (select * from customer where c_acctbal >= 0)
    select left(c_name, 1) as UserFirstName, substring(c_name, 2) as UserLastName, 'guid' as UserGUID,
           date '2020-01-01' as UserValidFromDate, date '2021-01-01' as UserValidUntilDate, 1 as UserIsActive,
           c_name as UserName from u
    union all
    select left(login, 1), substring(login, 2),
           regexp_replace(md5(login), '^(.{8})(.{4})(.{4})(.{4})(.{12})$', '\\1-\\2-\\3-\\4-\\5'),
           date '2024-02-29', date '2025-02-28', 1, login
    from (select nullif(c_name, 'Customer#000000001') as login from customer)
    where login is not null and login not in (select c_name from u)""")
def job_user_bootstrap(t: Tables) -> DataFrame:
    users = t.customer.filter("c_acctbal >= 0").selectExpr(
        "left(c_name, 1) as UserFirstName", "substring(c_name, 2) as UserLastName", "'guid' as UserGUID",
        "date '2020-01-01' as UserValidFromDate", "date '2021-01-01' as UserValidUntilDate", "1 as UserIsActive",
        "c_name as UserName")
    logins = t.customer.selectExpr("nullif(c_name, 'Customer#000000001') as input_by")
    return people.bootstrap_users(users, logins, dt.date(2024, 2, 29))


# The targets of the declared keys and references, with flaws made on purpose: name -> (columns, where they come from).
TARGETS = {
    "Customer": ("nullif(c_mktsegment, 'BUILDING') as CustomerAgentPrefix, c_custkey as CustomerAccountNumber", "customer"),
    "ImportPackage": ("o_orderkey as PackageNumber, nullif(o_custkey % 25, 3) as UserId, "
                      "concat('s', cast(o_custkey % 30 as varchar(9))) as SupplierName, "
                      "concat('c', cast(o_custkey % 7 as varchar(9))) as CourierName",
                      "orders where o_orderdate < timestamp '2000-01-01'"),
    "PackagePackageEvent": ("event_id as PackageNumber, nullif(event_type, 'error') as PackageStatusName, ts as EventDate",
                            "events"),
    "Invoice": ("nullif(o_orderkey, o_custkey) as InvoiceNumber, o_orderkey as PackageNumber", "orders"),
    "InvoiceDetail": ("l_orderkey as InvoiceNumber, nullif(l_linenumber, 7) as InvoiceDetailId", "lineitem"),
    "Payment": ("l_orderkey as PaymentId, l_orderkey + l_linenumber as InvoiceNumber, nullif(l_quantity, 5) as PaymentAmount",
                "lineitem where l_linenumber < 3"),
    "PreAlert": ("nullif(c_custkey, 5) as CustomerAccountNumber, c_mktsegment as CustomerAgentPrefix", "customer"),
    "SignUp": ("c_custkey as SignUpId, nullif(c_nationkey, 4) as SignUpAccountNumber, nullif(c_name, 'Customer#000000002') "
               "as SignUpEmail", "customer"),
    "User": ("n_nationkey as UserId", "nation where n_nationkey < 20"),
    "Supplier": ("concat('s', cast(n_nationkey as varchar(9))) as SupplierName", "nation"),
    "Courier": ("concat('c', cast(r_regionkey as varchar(9))) as CourierName", "region"),
}


def target_checks_sql() -> str:
    made = ",\n".join(f"t_{name} as (select {columns} from {source})" for name, (columns, source) in TARGETS.items())
    found = [f"select '{t}.{c} not null' as \"check\", count(*) as failures from t_{t} where {c} is null"
             for t, names in REQUIRED.items() for c in names]
    found += [f"select '{t}.{c} unique', count(*) from (select 1 from t_{t} where {c} is not null group by {c} having count(*) > 1)"
              for t, names in UNIQUE.items() for c in names]
    found += [f"select '{t}.{c} in {to}', count(*) from t_{t} where {c} is not null "
              f"and not exists (select 1 from t_{to} r where r.{c} = t_{t}.{c})"
              for t, names in REFERENCES.items() for c, to in names.items()]
    checks = "\nunion all ".join(found)
    return (f"with {made},\nfound as ({checks})\nselect \"check\", failures, "
            "case when failures = 0 then 'pass' else 'error' end as status from found")


@query(target_checks_sql())
def job_target_checks(t: Tables) -> DataFrame:
    """The declared keys and references of all eight tables."""
    for source in ("customer", "orders", "events", "lineitem", "nation", "region"):
        getattr(t, source).createOrReplaceTempView(f"checked_{source}")

    def made(columns: str, source: str) -> DataFrame:
        source = source.replace("timestamp '", "timestamp_ntz '")
        return t.spark.sql(f"select {columns} from checked_{source}")

    targets = {name: made(*spec) for name, spec in TARGETS.items()}
    return run_suite(targets, target_checks(targets))
