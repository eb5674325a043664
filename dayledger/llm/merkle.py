"""A Merkle manifest of a table: trees of digests over its rows, as append logs, and proofs from them.

Leaves of a tree are ranked and dealt to aligned builders, SPAN leaves each. A builder takes its leaves
in order and appends every node to a log when it is complete, a parent right behind its last child:
postorder. Where a node lies then follows from the sizes of the subtrees before it (`position`), so a
log needs no index, and the siblings of a proof are read by their places. The roots of a tree's
builders are the leaves of the next tier, up to one builder; the trees' roots are the leaves of one
last tree in the same way.

All leaves of a tree lie equally deep: while more than one node remains, every ARITY consecutive
ones, and the rest even if it is one, become the digest of their joined hex digests.
"""

from __future__ import annotations

import hashlib
import string
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dayledger.llm.files import open_file, write_file
from dayledger.sinks.staging import fresh_path, stage

ARITY = 8
HEIGHT = 4  # levels of a builder above its leaves
SPAN = ARITY**HEIGHT
SIZE = 32  # bytes of a node in a log
FILE_BYTES = 64 << 20
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
BLOCKS = "tree string, block long, leaves long, height int, n long, path string, base long, top string"
Step = tuple[int, str]  # place among the run's nodes, digests of the others


def digest(joined: str) -> str:
    return hashlib.sha256(joined.encode()).hexdigest()


def levels(n: int) -> int:
    """Levels above `n` leaves until one node remains."""
    count = 0
    while n > 1:
        n, count = -(-n // ARITY), count + 1
    return count


class Builder:
    """Appends leaves and completed nodes to a log in postorder."""

    def __init__(self, height: int):
        self.height = height
        self.log = bytearray()
        self.leaves = 0
        self.runs: list[list[str]] = [[] for _ in range(height)]
        self.root = ""

    def append(self, leaf: str) -> None:
        self.leaves += 1
        self._put(0, leaf)

    def _put(self, level: int, node: str) -> None:
        self.log += bytes.fromhex(node)
        if level == self.height:
            self.root = node
            return
        run = self.runs[level]
        run.append(node)
        if len(run) == ARITY:
            self._close(level)

    def _close(self, level: int) -> None:
        joined = "".join(self.runs[level])
        self.runs[level] = []
        self._put(level + 1, digest(joined))

    def close(self) -> None:
        """Complete the nodes that have fewer children than others."""
        for level in range(self.height):
            if self.runs[level]:
                self._close(level)


def position(level: int, index: int, leaves: int, height: int) -> int:
    """Where a log of `leaves` leaves has the index-th node of a level: as many nodes complete before it."""
    end = min((index + 1) * ARITY**level, leaves)  # leaves that are there when it is complete
    below = sum(-(-end // ARITY**k) for k in range(level))
    above = sum(index // ARITY ** (k - level) for k in range(level + 1, height + 1))
    return below + index + above


def log_path(read, leaf: int, leaves: int, height: int) -> list[Step]:
    """The steps from a leaf to the root of its log. `read(place)` gives the node at a place in hex."""
    steps: list[Step] = []
    index, count = leaf, leaves
    for level in range(height):
        run = range(index // ARITY * ARITY, min(index // ARITY * ARITY + ARITY, count))
        steps.append((index % ARITY, "".join(read(position(level, k, leaves, height)) for k in run if k != index)))
        index, count = index // ARITY, -(-count // ARITY)
    return steps


def fold(leaf: str, steps) -> str:
    """The root that a leaf and the siblings of its steps give."""
    for place, others in steps:
        leaf = digest(others[: 2 * SIZE * place] + leaf + others[2 * SIZE * place :])
    return leaf


def leaf_digest(fields: dict[str, Column]) -> Column:
    """sha256 over each field's UTF-8 byte count, `:` and value, or `-` where it is null."""
    def part(value: Column) -> Column:
        value = value.cast("string")
        return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value))

    return F.sha2(F.concat(*[part(fields[name]) for name in FIELDS]), 256)


def tampering() -> Column:
    """Whether a row's text is tampered with in a trial of the proofs. Rows without an id are not."""
    h = F.crc32(F.col("doc_id").cast("long").cast("string").cast("binary"))
    return F.coalesce(h % 3 == 0, F.lit(False))


def leaves_of(docs: DataFrame) -> DataFrame:
    """One leaf per row: tree (its lang, marked so that null comes first), doc_id, digest, and trial: the
    digest after tampering, null where there is none. Columns other than FIELDS are not read."""
    fields = {name: F.col(name).cast("long" if name in ("doc_id", "n_chars") else "string") for name in FIELDS}
    lower = F.translate(fields["text"], string.ascii_uppercase, string.ascii_lowercase)
    return docs.select(
        F.coalesce(F.concat(F.lit("="), fields["lang"]), F.lit("-")).alias("tree"), fields["doc_id"].alias("doc_id"),
        leaf_digest(fields).alias("digest"), F.when(tampering(), leaf_digest(fields | {"text": lower})).alias("trial"),
    )


def ranked(leaves: DataFrame, order: list[str]) -> DataFrame:
    """`leaves` with rank (from 0, within their tree, by `order` and then by digest), n (leaves of the
    tree) and block (their builder), staged. Rows are sorted by range, so one large tree is spread, and
    equal rows are told apart by where they lie. The driver gets a sample of the keys, of bounded size."""
    parts = int(leaves.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # sixty bits of the digest, in its order: the keys that are sampled stay short
    keys = ["tree", *order, "_start", "_lies"]
    leaves = leaves.withColumns({"_start": F.conv(F.substring("digest", 1, 15), 16, 10).cast("long"), "_lies": F.monotonically_increasing_id()})
    spread = leaves.repartitionByRange(parts, *keys).sortWithinPartitions("tree", *order, "_start", "digest", "_lies")
    rows = stage(spread.drop("_start", "_lies").withColumn("_at", F.monotonically_increasing_id()), "ranked")
    rows = rows.withColumn("_part", F.shiftright("_at", 33))
    counts = rows.groupBy("tree", "_part").agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))
    tree = Window.partitionBy("tree")  # one row per part of the shuffle at most
    before = tree.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(
        "tree", "_part", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"), F.sum("_n").over(tree).alias("n")
    )
    return (
        rows.join(counts, ["tree", "_part"]).withColumn("rank", F.col("_at") + F.col("_shift"))
        .withColumn("block", F.floor(F.col("rank") / SPAN)).drop("_at", "_part", "_shift")
    )


def build(leaves: DataFrame, folder: str) -> DataFrame:
    """Write the logs of a tier. `leaves`: tree, rank, n, digest. One row per builder (BLOCKS): its log is
    `leaves` leaves high `height` at byte `base` of the file `path`. Write the rows down before using them."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, files = TaskContext.get().partitionId(), 0
        data, rows = bytearray(), []
        key, builder, n = None, None, 0

        def end_block() -> None:
            builder.close()
            rows.append((*key, builder.leaves, builder.height, n, f"{folder}/{part:06d}-{files:04d}.log", len(data), builder.root))
            data.extend(builder.log)

        def end_file() -> pa.RecordBatch:
            write_file(rows[0][5], bytes(data))
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*rows, strict=True), TYPES, strict=True)], NAMES)

        for batch in batches:
            for tree, block, total, node in zip(*(batch.column(c).to_pylist() for c in ("tree", "block", "n", "digest")), strict=True):
                if (tree, block) != key:
                    if key is not None:
                        end_block()
                        if len(data) >= FILE_BYTES:
                            yield end_file()
                            data, rows, files = bytearray(), [], files + 1
                    key, n, builder = (tree, block), total, Builder(min(HEIGHT, levels(total)))
                builder.append(node)
        if key is not None:
            end_block()
            yield end_file()

    parts = int(leaves.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = leaves.select("tree", F.floor(F.col("rank") / SPAN).alias("block"), "rank", "n", "digest")
    return rows.repartition(parts, "tree", "block").sortWithinPartitions("tree", "block", "rank").mapInArrow(write, BLOCKS)


NAMES = [c.split()[0] for c in BLOCKS.split(", ")]
TYPES = [pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.string(), pa.int64(), pa.string()]


def tiers(leaves: DataFrame, folder: str) -> list[DataFrame]:
    """The blocks of all tiers, the lowest first. Empty without leaves."""
    most = leaves.agg(F.max("n")).first()[0]
    out: list[DataFrame] = []
    while most:
        blocks = stage(build(leaves, f"{folder}/tier-{len(out)}"), "blocks")
        out.append(blocks)
        if most <= SPAN:
            break
        leaves = blocks.where(F.col("n") > SPAN).select("tree", F.col("block").alias("rank"), F.ceil(F.col("n") / SPAN).alias("n"), F.col("top").alias("digest"))
        most = -(-most // SPAN)
    return out


STEPS = "array<struct<place:int,others:string>>"


def leaf_steps(blocks: DataFrame) -> DataFrame:
    """tree, rank and steps to the root for every leaf of `blocks`, a tier above the documents with
    `above`, the steps from its builder's root on. Siblings are read from the logs one by one."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                with open_file(row["path"]) as file:

                    def node(place: int, base: int = row["base"], file=file) -> str:
                        file.seek(base + place * SIZE)
                        return file.read(SIZE).hex()

                    above = [(s["place"], s["others"]) for s in row["above"]]
                    found = [log_path(node, leaf, row["leaves"], row["height"]) + above for leaf in range(row["leaves"])]
                first = row["block"] * SPAN
                for at in range(0, len(found), 256):
                    some = found[at : at + 256]
                    yield pa.RecordBatch.from_pylist(
                        [{"tree": row["tree"], "rank": first + at + k, "steps": [{"place": p, "others": o} for p, o in steps]} for k, steps in enumerate(some)],
                        pa.schema({"tree": pa.string(), "rank": pa.int64(), "steps": pa.list_(pa.struct([("place", pa.int32()), ("others", pa.string())]))}),
                    )

    return blocks.select(*NAMES, "above").mapInArrow(read, f"tree string, rank long, steps {STEPS}")


def with_above(low: list[DataFrame], tops: DataFrame | None = None) -> DataFrame:
    """The blocks of the lowest tier with `above`, the steps from their root to the last one, and the
    other columns of `tops` (tree, above), which has one row per tree. Without it a tree's own root is
    the last one."""
    out = None
    for blocks in reversed(low):
        ended = blocks.where(F.col("n") <= SPAN)
        ended = ended.join(tops, "tree") if tops is not None else ended.withColumn("above", F.array().cast(STEPS))
        if out is not None:
            steps = leaf_steps(out).withColumnRenamed("rank", "block").withColumnRenamed("steps", "above")
            lower = blocks.where(F.col("n") > SPAN).join(steps, ["tree", "block"])
            ended = ended.unionByName(lower.join(tops.drop("above"), "tree") if tops is not None else lower)
        out = ended
    return out


def proofs(leaves: DataFrame, blocks: DataFrame) -> DataFrame:
    """The proof of every leaf, digested, and what its trial folds to. `leaves`: tree, block, rank,
    doc_id, digest, trial; `blocks`: of the lowest tier, with above, subroot and root. A block's log is
    read once."""

    def prove(key: tuple, rows: pa.Table, block: pa.Table) -> pa.Table:
        info = block.to_pylist()[0]
        with open_file(info["path"]) as file:
            file.seek(info["base"])
            log = file.read(SIZE * (position(info["height"], 0, info["leaves"], info["height"]) + 1))
        # from the top down: a node's steps are its own and its parent's
        paths = [([(s["place"], s["others"]) for s in info["above"]], "".join(s["others"] for s in info["above"]))]
        for level in reversed(range(info["height"])):
            count = -(-info["leaves"] // ARITY**level)
            places = [SIZE * position(level, k, info["leaves"], info["height"]) for k in range(count)]
            nodes = [log[p : p + SIZE].hex() for p in places]
            lower = []
            for k in range(count):
                run = k // ARITY * ARITY
                others = "".join(nodes[run:k]) + "".join(nodes[k + 1 : run + ARITY])
                steps, joined = paths[k // ARITY]
                lower.append(([(k % ARITY, others), *steps], others + joined))
            paths = lower
        first = info["block"] * SPAN
        out = []
        for doc_id, rank, leaf, trial in zip(*(rows.column(c).to_pylist() for c in ("doc_id", "rank", "digest", "trial")), strict=True):
            steps, joined = paths[rank - first]
            folded = fold(trial or leaf, steps)
            out.append((doc_id, leaf, info["subroot"], info["root"], digest(joined), folded, folded == info["root"]))
        return pa.Table.from_arrays([pa.array(v, t) for v, t in zip(zip(*out, strict=True), PROOF_TYPES, strict=True)], PROOF_NAMES)

    mine = leaves.select("tree", "block", "rank", "doc_id", "digest", "trial").groupBy("tree", "block")
    return mine.cogroup(blocks.groupBy("tree", "block")).applyInArrow(prove, PROOFS)


PROOFS = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
PROOF_NAMES = [c.split()[0] for c in PROOFS.split(", ")]
PROOF_TYPES = [pa.int64(), *[pa.string()] * 5, pa.bool_()]


def manifest(docs: DataFrame) -> DataFrame:
    """Trees over all rows of `docs`, one per lang by ascending doc_id (null first, equal ids by
    digest), and one over their roots by lang; logs in a fresh shared folder. Every row is then proved
    against the last root, some after tampering: doc_id, leaf, subroot, root, proof_sha256,
    folded_root and verified. Repeated rows are leaves of their own; no rows give no rows."""
    spark = docs.sparkSession
    folder = fresh_path(spark, "merkle")
    # written first: dealing by range looks at the rows twice, and no text is to be hashed twice
    leaves = stage(ranked(stage(leaves_of(docs), "digests"), ["doc_id"]), "leaves")
    low = tiers(leaves, f"{folder}/trees")
    if not low:
        return spark.createDataFrame([], PROOFS)
    ends = [blocks.where(F.col("n") <= SPAN).select(F.lit("").alias("tree"), F.col("tree").alias("of"), F.col("top").alias("digest")) for blocks in low]
    subroots = stage(ranked(reduce(DataFrame.unionByName, ends), ["of"]), "subroots")
    high = tiers(subroots, f"{folder}/root")
    steps = leaf_steps(with_above(high)).select("rank", F.col("steps").alias("above"))
    root = high[-1].select("tree", F.col("top").alias("root"))
    tops = subroots.join(steps, "rank").join(root, "tree").select(F.col("of").alias("tree"), F.col("digest").alias("subroot"), "root", "above")
    return proofs(leaves, with_above(low, tops))
