"""Packages, their events, and the courier and supplier dimensions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from harborline.functions.dates import combine, in_year_of
from harborline.functions.text import (ci_key, fixed_width, flag_unless, flag_when, join_text, recode, same_text,
                                       storage_kind, storage_number, upper_trim)
from harborline.operators.aggregate import distinct_ci
from harborline.operators.joins import decode, find_missing, keep_known
from harborline.operators.load import ends_of, within
from harborline.operators.project import with_constants
from harborline.plans import lookups as L
from harborline.sources.files import read_json_lines


_KEY = "__package"


def _with_key(df: DataFrame) -> DataFrame:
    return df.withColumn(_KEY, ci_key(F.col("PackageNumber")))


def load_packages(landing: DataFrame, known: DataFrame, customers: DataFrame,
                  loaded: DataFrame | None = None, stored_key: str | None = None) -> DataFrame:
    """Packages to add to the target.

    ``known`` names the valid packages, ``customers`` the accounts; ``loaded`` is the target, None on the
    first run.  An account listed twice under the agent prefix doubles its packages.  ``stored_key`` names a column
    in which the target keeps the package number without case and trailing blanks: the scan of the target is then
    limited to the range of the landing keys (a job finds it), and the new packages carry the column too.
    """
    seen, place = F.col("LocationLastSeen"), "PackageLocationLastSeenId"
    # The key is made once per table, so that both joins below share one shuffle of the landing rows.
    landing, known = _with_key(landing), _with_key(known)
    rows = keep_known(landing, known, [_KEY])
    if loaded is not None:
        if stored_key:
            loaded = loaded.filter(within(stored_key, *ends_of(landing, F.col(_KEY)))).withColumn(_KEY, F.col(stored_key))
        else:
            loaded = _with_key(loaded)
        stored = keep_known(loaded.select(_KEY), landing, [_KEY])
        rows = find_missing(rows, stored, [_KEY], spread_nulls=False)
    accounts = (customers.filter(same_text(F.col("CustomerAgentPrefix"), L.AGENT_PREFIX))
                .select(F.col("CustomerAccountNumber").alias("__account"), "CustomerAvailableSaturday"))
    rows = rows.join(accounts, F.col("AccountNumber") == F.col("__account"))
    rows = decode(rows, "LocationLastSeen", L.LAST_SEEN_IDS, place, ci=True)
    packages = rows.select(
        "PackageNumber",
        F.col("InternationalTrackingNumber").alias("PackageInternationalTrackingNu"),
        F.coalesce("prealert_tracking_number", F.lit("")).alias("PackagePrealertTrackingNumber"),
        F.coalesce("SupplierInvoiceNumber", F.lit("")).alias("PackageSupplierInvoiceNumber"),
        "PackageDescription",
        F.col("TariffDescription").alias("PackageTariffDescription"),
        flag_when(F.col("hazmat"), "yes").alias("PackageHazmat"),
        flag_unless(F.col("Consolidation"), "no").alias("PackagePartMultiplePiece"),
        F.col("TotalPieces").alias("PackageTotalPieces"),
        flag_unless(F.col("Consolidation"), "no").alias("PackageConsolidation"),
        F.col("ConsolidationPackageNumber").alias("PackageConsolidationPackageNum"),
        *[F.col(c).alias(f"Package{c.capitalize()}") for c in ("length", "width", "height")],
        F.col("TotalWeight").alias("PackageTotalWeight"),
        F.col("shipper").alias("PackageShipper"),
        "PackageValue",
        combine(F.col("DateFirstSeen"), F.col("TimeFirstSeen")).alias("PackageFirstSeenDateTime"),
        F.col("AccountNumber").alias("CustomerAccountNumber"),
        F.col("agent_prefix").alias("CustomerAgentPrefix"),
        place,
        fixed_width(F.col("notes"), L.NOTES_WIDTH).alias("PackageNotes"),
        F.col("packed_in_shipment").alias("PackagePackedInShipment"),
        recode(F.col("PackageStatus"), L.PACKAGE_STATUS_ARMS, L.DEFAULT_STATUS).alias("PackageActualStatusName"),
        F.substring("PackageNumber", 5, 12).alias("PackageAirwayBillNumber"),
        flag_when(F.left(F.col("PackageNumber"), F.lit(3)), L.OCEAN_PREFIX).alias("PackageOcean"),
        F.col("created_at").alias("PackageCreationDate"),
        F.col("TotalWeight").alias("PackageWeight"),
        recode(seen, L.LOCATION_ARMS).cast("int").alias("PackageLocationId"),
        storage_number(seen, L.STORAGE_SITES, L.STORAGE_KINDS).alias("PackageLocationLastStorageId"),
        storage_kind(seen, L.STORAGE_KINDS).alias("PackageLocationLastStorageType"),
        F.col("shipper").alias("CourierName"),
        F.col("shipper").alias("SupplierName"),
        F.when(F.col("CustomerAvailableSaturday") == 1, F.lit(1)).otherwise(F.lit(0)).alias("AvailableSaturdayFlag"),
        *([F.col(_KEY).alias(stored_key)] if stored_key else []),
    )
    return with_constants(packages, {
        "UserId": (L.PACKAGE_USER_ID, "int"), "PackageDuration": (1, "int"), "ManifestId": (None, "int"),
        "RepositoryNumber": (None, "int"), "RepositoryType": (None, "string"), "PackageInvoicePDF": ("", "string"),
        "PackageMarked": (0, "int"), "PackageTransactionIdentifier": ("", "string"),
        "PackageSpiToken": ("", "string"), "ConsigneeId": (None, "int"), "DestinationName": (L.DESTINATION, "string"),
        "PackagePhoto": ("", "string"),
    })


def event_history(landing: DataFrame, known: DataFrame, loaded: DataFrame | None = None) -> DataFrame:
    """Distinct events of known packages that the target lacks; an event without a moment is always new.

    Of the target only the days of the landing events are read (a job finds the first and the last).
    """
    rows = keep_known(landing, known, ["PackageNumber"], ci=True).filter(F.col("PackageNumber").isNotNull())
    events = rows.select(
        fixed_width(F.col("PackageNumber"), 40).alias("PackageNumber"),
        fixed_width(recode(F.col("EventDescription"), L.EVENT_STATUS_ARMS, L.DEFAULT_STATUS),
                    20).alias("PackageStatusName"),
        combine(F.col("EventDate"), F.col("EventTime")).alias("EventDate"))
    if loaded is not None:
        first, last = ends_of(landing, F.col("EventDate").cast("date"))
        past = last + dt.timedelta(days=1) if last else None
        stored = loaded.filter((F.col("EventDate") >= F.lit(first)) & (F.col("EventDate") < F.lit(past)))
        stored = keep_known(stored, landing, ["PackageNumber"], ci=True)
        events = find_missing(events, stored, ["PackageNumber", "PackageStatusName", "EventDate"], ci=True)
    return with_constants(events.distinct(), {
        "PackageEventUserId": (L.EVENT_USER_ID, "int"), "PackageEventInvoiceVerified": (False, "boolean"),
        "PackageEventInvoiceNumber": (None, "string"),
    })


def missing_names(landing: DataFrame, column: str, existing: DataFrame, name: str) -> DataFrame:
    """Names in a landing column that the dimension lacks, one spelling each; a NULL name stays."""
    return find_missing(distinct_ci(landing, column, name), existing, [name], ci=True)


def missing_couriers(landing: DataFrame, couriers: DataFrame) -> DataFrame:
    return missing_names(landing, "shipper", couriers, "CourierName")


def missing_suppliers(landing: DataFrame, suppliers: DataFrame) -> DataFrame:
    return missing_names(landing, "shipper", suppliers, "SupplierName")


# Keys of a package in the JSON-lines export.
IMPORT_KEYS = [
    "PackageNumber", "InternationalTrackingNumber", "SupplierInvoiceNumber", "PackageDescription",
    "TariffDescription", "Hazmat", "TotalPieces", "Consolidation", "ConsolidationPackageNumber", "Length", "Width",
    "Height", "TotalWeight", "Shipper", "PackageValue", "PackageFirstSeenDateTime", "AccountNumber",
    "LocationLastSeen", "Notes", "PackageStatus", "Supplier", "created_at",
]
IMPORT_SCHEMA = T.StructType([T.StructField(k, T.StringType()) for k in IMPORT_KEYS])


def import_packages(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """``(packages, rejects)`` of a JSON-lines export; every key must be there and ``Notes`` not NULL."""
    good, rejects = read_json_lines(spark, path, IMPORT_SCHEMA, IMPORT_KEYS, ["Notes"])
    rows = decode(good, "LocationLastSeen", L.LAST_SEEN_IDS, "PackageLocationLastSeenId")
    kept = [k for k in IMPORT_KEYS if k not in ("Hazmat", "Consolidation", "Shipper", "AccountNumber", "Notes",
                                                "LocationLastSeen", "Supplier", "created_at")]
    packages = rows.select(
        *kept,
        *[F.coalesce(F.col(c) == "Yes", F.lit(False)).alias(c) for c in ("Hazmat", "Consolidation")],
        F.coalesce(upper_trim(F.col("Shipper")), F.lit("")).alias("Shipper"),
        F.col("AccountNumber").alias("CustomerAccountNumber"),
        "PackageLocationLastSeenId",
        fixed_width(F.col("Notes"), L.NOTES_WIDTH).alias("Notes"),
        F.col("Supplier").alias("SupplierName"),
        F.col("created_at").alias("PackageCreationDate"))
    packages = with_constants(packages, {
        "PrealertTrackingNumber": (" ", "string"), "UserId": (L.PACKAGE_USER_ID, "int"),
        "PackedInShipment": ("", "string"), "CourierName": (None, "string"), "ManifestId": (1, "int"),
    })
    return packages, rejects


def current_year_packages(landing: DataFrame, as_of: dt.date) -> DataFrame:
    """Packages last seen in the year of ``as_of``, with flags, sizes and moments recoded; other columns stay."""
    rows = landing.filter(in_year_of(F.col("DateLastSeen"), as_of))
    rows = decode(rows, "LocationLastSeen", L.LAST_SEEN_IDS, "package_location_last_seen_id", ci=True)
    sizes = ("Length", "Width", "Height", "TotalWeight", "VolumetricWeight")
    return rows.withColumns({
        **{c: F.coalesce(ci_key(F.col(c)) == "y", F.lit(False)) for c in ("Hazmat", "Consolidation")},
        **{c: F.col(c).cast("decimal(10,2)") for c in sizes},
        "PackageFirstSeenDateTime": join_text(F.col("DateFirstSeen"), F.lit(" "), F.col("TimeFirstSeen")),
        "last_seen_datetime": join_text(F.col("DateLastSeen"), F.lit(" "), F.col("TimeLastSeen")),
        "Notes": fixed_width(F.col("Notes"), L.NOTES_WIDTH),
    }).drop("DateFirstSeen", "TimeFirstSeen", "DateLastSeen", "TimeLastSeen", "LocationLastSeen")
