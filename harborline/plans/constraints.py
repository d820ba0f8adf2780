"""Keys and references the target tables must satisfy, as checks for the suite."""

from __future__ import annotations

from collections.abc import Iterable

from harborline.operators.suite import Check

# Table -> columns that must not be NULL, columns that must be unique, column -> referenced table.
REQUIRED = {
    "Customer": ["CustomerAgentPrefix", "CustomerAccountNumber"],
    "ImportPackage": ["PackageNumber", "UserId"],
    "PackagePackageEvent": ["PackageNumber", "PackageStatusName", "EventDate"],
    "Invoice": ["InvoiceNumber", "PackageNumber"],
    "InvoiceDetail": ["InvoiceNumber", "InvoiceDetailId"],
    "Payment": ["PaymentId", "InvoiceNumber", "PaymentAmount"],
    "PreAlert": ["CustomerAccountNumber", "CustomerAgentPrefix"],
    "SignUp": ["SignUpId", "SignUpAccountNumber", "SignUpEmail"],
}
UNIQUE = {
    "ImportPackage": ["PackageNumber"],
    "Invoice": ["InvoiceNumber"],
    "Payment": ["PaymentId"],
    "SignUp": ["SignUpId"],
}
REFERENCES = {
    "ImportPackage": {"UserId": "User", "SupplierName": "Supplier", "CourierName": "Courier"},
    "PackagePackageEvent": {"PackageNumber": "ImportPackage"},
    "Invoice": {"PackageNumber": "ImportPackage"},
    "InvoiceDetail": {"InvoiceNumber": "Invoice"},
    "Payment": {"InvoiceNumber": "Invoice"},
}


def target_checks(tables: Iterable[str]) -> list[Check]:
    """The checks of the given target tables; a reference to a table that is not given is left out."""
    given = set(tables)
    found = []
    for table in sorted(given):
        found += [Check(f"{table}.{c} not null", table, "not_null", {"column": c}) for c in REQUIRED.get(table, [])]
        found += [Check(f"{table}.{c} unique", table, "unique", {"column": c}) for c in UNIQUE.get(table, [])]
        found += [Check(f"{table}.{c} in {to}", table, "relationships", {"column": c, "to": to, "field": c})
                  for c, to in REFERENCES.get(table, {}).items() if to in given]
    return found
