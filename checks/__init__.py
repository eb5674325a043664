"""The library's operators and jobs run on the test tables, each beside independent SQL."""

from checks import columns, jobs, relations, scans, sinks  # noqa: F401  (register their queries)
from checks.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
