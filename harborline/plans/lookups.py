"""Codes and texts of the target tables."""

# They must equal the codes already stored in the target tables.

# Where a package was last seen -> location id.
LAST_SEEN_IDS = {
    "Castries": 1,
    "Head Office": 1,
    "Rodney Bay Office": 2,
    "RB BOX 10": 2,
    "Vieux Fort Office": 5,
    "Miami": 6,
    "Front Counter": 6,
    "Local Warehouse": 7,
}

# Where a package is now -> location id; the first match counts.
LOCATION_ARMS = [
    ("Castries", 1),
    ("Front Counter", 1),
    ("Head Office", 1),
    ("Rodney Bay Office", 2),
    ("%RB %", 2),
    ("%Vieux Fort%", 5),
    ("%VF %", 5),
    ("Miami", 6),
    ("Local Warehouse", 7),
]

STORAGE_SITES = ["RB", "VF"]
STORAGE_KINDS = ["AREA", "BOX", "SHELF"]

# Delivery route -> route (location) id of invoices and payments.
ROUTE_IDS = {
    "Castries Office": 1,
    "Rodney Bay Office": 263,
    "Hold at Office": 263,
    "Vieux Fort Office": 316,
    "Castries": 253,
    "Dennery": 254,
    "Micoud": 255,
    "Vieux Fort": 256,
    "Gros Islet": 252,
    "Soufriere": 258,
    "Anse La Raye": 260,
    "Choiseul": 257,
    "Canaries": 259,
}

DEFAULT_STATUS = "Received"

# Status of a package; the first match counts.
PACKAGE_STATUS_ARMS = [
    ("Delivered", "Delivered"),
    ("%Scheduled for Delivery%", "ScheduledForDelivery"),
    ("Received At Warehouse", "ReceivedWareHouse"),
    ("Scanned at Warehouse", "ScannedWareHouse"),
    ("Detained at Customs", "Detained"),
    ("Delivery Cancelled", "DeliveryCancelled"),
    ("%Transit%", "In Transit"),
    ("Returned to Warehouse", "Returned"),
    ("Out for Delivery", "OutForDelivery"),
    ("Received from shipper", "Received"),
    ("Released from Customs", "Released"),
]

# Status of a package event; the first match counts.
EVENT_STATUS_ARMS = [
    ("%Delivered%", "Delivered"),
    ("%Detain at Custom%", "Detained"),
    ("%Transit%", "In Transit"),
    ("%Received at Ware%", "ReceivedWarehouse"),
    ("%Received from Shipper%", "Received"),
    ("%Scanned at Ware%", "ScannedWarehouse"),
    ("%Released from Custom%", "Released"),
    ("%Delivery Cancel%", "Delivery Cancelled"),
    ("%Out for Deliver%", "Out For Delivery"),
    ("%Scheduled for Deliver%", "ScheduledDelivery"),
    ("%Returned to Warehouse%", "Returned"),
]

AGENT_PREFIX = "BSL"
OCEAN_PREFIX = "OCE"
DESTINATION = "Saint Lucia"
PACKAGE_USER_ID = 12
EVENT_USER_ID = 100
INVOICE_USER_ID = 1
COUNTRY_ID = 758
NO_BIRTH_DATE = "1900-01-01"
NOTES_WIDTH = 255
