"""Python workers that stay small: Arrow batches bounded in bytes, and memory given back.

Spark uses a worker again for other operators of the session. What an operator keeps in it (encoders
with what they remember, permutations) is dropped when another one comes, and freed memory goes back
to the system at the end of each task.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

BATCH_BYTES = 8 << 20
BYTES_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"

Run = Callable[[Iterator[pa.RecordBatch]], Iterable[pa.RecordBatch]]
_caches: list[Callable[[], None]] = []
_owner: list[str] = []


def kept(cached):
    """Register a cached function whose values go when another operator comes."""
    _caches.append(cached.cache_clear)
    return cached


def settle(owner: str) -> None:
    """`owner` uses this worker now."""
    if _owner != [owner]:
        if _owner:
            for clear in _caches:
                clear()
            give_back()
        _owner[:] = [owner]


def give_back() -> None:
    """Return freed memory to the system, where the C library can."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def in_arrow(rows: DataFrame, run: Run, schema, owner: str) -> DataFrame:
    """`rows.mapInArrow`, in batches of about BATCH_BYTES: the session is set to that unless it has less,
    since both sides hold a batch whole."""
    conf = rows.sparkSession.conf
    if _bytes(conf.get(BYTES_SETTING)) > BATCH_BYTES:
        conf.set(BYTES_SETTING, str(BATCH_BYTES))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        settle(owner)
        try:
            yield from run(batches)
        finally:
            give_back()

    return rows.mapInArrow(task, schema)


def _bytes(size: str) -> int:
    """A size as Spark writes it; one that is not set to a plain number of bytes or megabytes counts as large."""
    units = {"": 1, "b": 1, "k": 1 << 10, "kb": 1 << 10, "m": 1 << 20, "mb": 1 << 20}
    number = size.strip().lower().rstrip("bkmgtp")
    unit = size.strip().lower()[len(number):]
    limit = int(number) if number.isdigit() else 0
    return limit * units[unit] if limit > 0 and unit in units else 1 << 62
