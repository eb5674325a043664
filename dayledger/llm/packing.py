"""Packing of documents into training sequences by cutting-stock column generation.

A document's ids are cut into full sequences and a rest. The lengths of all pieces, rounded up a
little, form a histogram of at most a few hundred sizes; the linear program over it runs on the
driver and knows nothing else of the data. Its rounded patterns say how many pieces of which size
share a sequence, and pieces are dealt to them by their rank within their size. What rounding adds is
bounded by a share of all tokens: where short pieces make up much of them, sizes are finer.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dayledger.llm.chunks import REMEMBERED, library_encoder, sliced
from dayledger.llm.patterns import Pattern, cutting_stock
from dayledger.llm.workers import in_arrow
from dayledger.sinks.staging import stage

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def pieces(
    docs: DataFrame, tokenizer: str, end_id: int, capacity: int = 4096, with_ids: bool = False, remembered: int = REMEMBERED
) -> DataFrame:
    """One row per piece of at most `capacity` ids of `text` and the end id. A null or empty text is
    its end id alone. `with_ids` adds the ids. A worker remembers about so many bytes of pieces of text.
    Other columns of `docs` are not read."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = library_encoder(tokenizer, remembered)
        for batch in sliced(batches, "text"):
            flat, bounds = encode(batch.column("text"))
            out: list[tuple] = []
            for row, doc_id in enumerate(batch.column("doc_id").to_pylist()):
                ids = np.append(flat[bounds[row] : bounds[row + 1]], np.uint32(end_id)).astype("<u4")
                for start in range(0, len(ids), capacity):
                    piece = ids[start : start + capacity]
                    out.append((doc_id, start, len(piece), zlib.crc32(piece.tobytes()), len(ids), piece))
            columns = list(zip(*out, strict=True)) if out else [[]] * 6
            arrays = [pa.array(c, pa.int64()) for c in columns[:5]]
            if with_ids:
                arrays.append(pa.array([p.astype(np.int64) for p in columns[5]], pa.list_(pa.int64())))
            yield pa.RecordBatch.from_arrays(arrays, NAMES[: len(arrays)])

    schema = PIECES + (", ids array<long>" if with_ids else "")
    return in_arrow(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), cut, schema, "packing")


NAMES = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids"]


COARSE = 16  # tokens: the widest size class
EXACT = 128  # lengths up to it are exact where the unit is 1; classes beyond are at most a 64th of their size wide


def size_classes(lengths: dict[int, int], capacity: int, rounding: float) -> list[tuple[int, int]]:
    """(longest length, width) of ranges of lengths: a length is rounded up to a multiple of its range's
    width. The unit, the least width, is the largest power of two up to COARSE by which rounding adds at
    most `rounding` of all tokens."""
    total = sum(length * n for length, n in lengths.items())
    unit = COARSE
    while True:
        ranges = []
        width = unit
        while width < COARSE and EXACT * width < capacity:
            ranges.append((EXACT * width, width))
            width *= 2
        ranges.append((capacity, width))
        added = sum((rounded(length, ranges, capacity) - length) * n for length, n in lengths.items())
        if unit == 1 or added <= rounding * total:
            return ranges
        unit //= 2


def rounded(length: int, ranges: list[tuple[int, int]], capacity: int) -> int:
    width = next(w for longest, w in ranges if length <= longest)
    return min(capacity, -(-length // width) * width)


def pack(pieces: DataFrame, capacity: int = 4096, rounding: float = 0.005) -> DataFrame:
    """`pieces` with sequence_id, offset and padded_length.

    `pieces` needs doc_id, start and length (1 to `capacity`), and is read four times: stage it.
    Offsets are gapless from 0. A sequence is padded to `capacity`, or not at all where it holds a
    power of two of ids. Repeated rows are pieces of their own. No pieces give no rows. Rounding lengths
    adds at most about `rounding` of all tokens to the sequences that are needed.
    """
    spark = pieces.sparkSession
    parts = max(64, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    # a row per length that occurs, `capacity` at most
    lengths = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    ranges = size_classes(lengths, capacity, rounding)
    unit = ranges[0][1]
    width = F.lit(ranges[-1][1])
    for longest, w in ranges[-2::-1]:
        width = F.when(F.col("length") <= longest, w).otherwise(width)
    size = F.least(F.lit(capacity // unit), F.ceil(F.col("length") / width) * width / unit).cast("int")
    sized = pieces.withColumns({
        "_size": size,
        "_part": F.pmod(F.xxhash64("doc_id", "start", "length"), F.lit(parts)).cast("int"),
    })
    counts = sized.groupBy("_size", "_part").agg(F.count("*").alias("_n"))
    histogram: dict[int, int] = {}
    for length, n in lengths.items():
        at = min(capacity // unit, rounded(length, ranges, capacity) // unit)
        histogram[at] = histogram.get(at, 0) + n
    slots = spark.createDataFrame(
        _slots(cutting_stock(histogram, capacity // unit)),
        "_size int, _from long, _to long, _copies long, _first long, _at long",
    )
    before = Window.partitionBy("_size").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    in_part = Window.partitionBy("_size", "_part").orderBy(F.desc("length"), "doc_id", "start")
    ranked = (
        sized.withColumn("_rank", F.row_number().over(in_part) - 1)
        .join(counts, ["_size", "_part"])
        .withColumn("_rank", F.col("_rank") + F.col("_before"))
    )
    # at most a few thousand slots: one per size of each pattern, and patterns are as many as sizes
    nth = F.col("_rank") - F.col("_from")
    placed = ranked.join(
        F.broadcast(slots.withColumnRenamed("_size", "_slot_size")),
        (F.col("_size") == F.col("_slot_size")) & F.col("_rank").between(F.col("_from"), F.col("_to")),
    ).select(
        *pieces.columns,
        (F.col("_first") + F.floor(nth / F.col("_copies"))).alias("sequence_id"),
        (F.col("_at") + nth % F.col("_copies")).alias("_place"),
    )
    in_sequence = Window.partitionBy("sequence_id")
    so_far = in_sequence.orderBy("_place").rowsBetween(Window.unboundedPreceding, 0)
    total = F.sum("length").over(in_sequence)
    return placed.withColumns({
        "offset": F.sum("length").over(so_far) - F.col("length"),
        "padded_length": F.when(F.bit_count(total) == 1, total).otherwise(F.lit(capacity).cast("long")),
    }).drop("_place")


def _slots(plan: list[tuple[Pattern, int]]) -> list[tuple[int, int, int, int, int, int]]:
    """Which ranks of a size go to which pattern: (size, first rank, last rank, copies in a sequence,
    first sequence, place of the first copy)."""
    rows, given, first = [], {}, 0
    for pattern, times in plan:
        place = 0
        for size, copies in pattern:
            start = given.get(size, 0)
            given[size] = start + copies * times
            rows.append((size, start, given[size] - 1, copies, first, place))
            place += copies
        first += times
    return rows


def packed_documents(
    docs: DataFrame, tokenizer: str, end_id: int, capacity: int = 4096, remembered: int = REMEMBERED
) -> DataFrame:
    """Documents cut and packed: `pieces`, written once to the shared folder, then `pack`."""
    return pack(stage(pieces(docs, tokenizer, end_id, capacity, remembered=remembered), "pieces"), capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """The sequences themselves, unpadded: sequence_id and ids. `packed` must carry `ids`."""
    in_order = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(in_order, lambda p: p["ids"])).alias("ids"))
