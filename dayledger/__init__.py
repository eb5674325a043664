"""Warehouse-job operators for PySpark: daily snapshots, increments and the jobs built from them."""

from dayledger.rundate import RunDate

__all__ = ["RunDate"]
