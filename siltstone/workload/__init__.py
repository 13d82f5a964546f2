"""The registered queries: operators applied to the given tables, with SQL to check them by."""

from siltstone.workload import builders, relations, scalars, scans, sinks, statistics  # noqa: F401
from siltstone.workload.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
