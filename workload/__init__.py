"""Every operator of the library as a query over the test tables."""

from workload import checks, increments, joins, jobs, loads, rows, shapes  # noqa: F401
from workload.registry import ENTRIES, Tables

__all__ = ["ENTRIES", "Tables"]
