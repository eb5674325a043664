"""Near-duplicate documents: circulant MinHash, banding, and exact Jaccard on full shingle sets.

Documents with the same words are one class and go on as one. Classes that share a band's key meet
in a bucket. First each class is compared with its bucket's smallest, which gathers groups of any
size without pairing them up. Then only buckets that still hold several components are compared
across components, in blocks of bounded size, by signature and then by their sets of shingle hashes;
what comes out is only links, at most one less than a block has documents. Every link is confirmed
on the two full sets.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayledger.llm import minhash
from dayledger.llm.chunks import sliced
from dayledger.llm.components import components
from dayledger.llm.exact_dedup import GONE_BYTES
from dayledger.llm.workers import in_arrow
from dayledger.operators.sizing import checked_broadcast
from dayledger.sinks.staging import stage


@dataclass(frozen=True)
class Settings:
    """40 bands of 6: two sets of Jaccard 0.8 share no band with probability 5e-6, of 0.9 with 4e-14.

    `slack` is by how many standard deviations two signatures may agree less than expected at the
    threshold before the pair is not looked at; at 6.5 that loses one such pair in 10^10."""

    size: int = 4
    percent: int = 80
    bands: int = 40
    rows: int = 6
    block: int = 512
    slack: float = 6.5

    @property
    def coordinates(self) -> int:
        return self.bands * self.rows

    @property
    def least_equal(self) -> int:
        """Coordinates, kept as one byte, in which two similar signatures agree at least."""
        p = self.percent / 100
        p += (1 - p) / 256
        n = self.coordinates
        return int(n * p - self.slack * (n * p * (1 - p)) ** 0.5)


def signed(docs: DataFrame, settings: Settings) -> DataFrame:
    """doc_id, n_shingles, class (digest of the words), keys (of the bands) and signature (one byte a
    coordinate) of every row; null for a text without words."""
    s = settings

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text", 2 << 20):
            texts = [minhash.words(t or b"") for t in batch.column("text").to_pylist()]
            sets = minhash.shingle_hashes(texts, s.size)
            signature = minhash.signatures(sets, s.coordinates)
            keys, low = minhash.band_keys(signature, s.bands), signature.astype(np.uint8)
            some = [bool(w) for w in texts]
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array([len(x) for x in sets], pa.int64()),
                pa.array([hashlib.blake2b(b" ".join(w), digest_size=16).digest() if w else None for w in texts], pa.binary()),
                pa.array([k if x else None for k, x in zip(keys, some, strict=True)], pa.list_(pa.int64())),
                pa.array([k.tobytes() if x else None for k, x in zip(low, some, strict=True)], pa.binary()),
            ], ["doc_id", "n_shingles", "class", "keys", "signature"])

    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string").cast("binary").alias("text"))
    return in_arrow(texts, run, "doc_id long, n_shingles long, class binary, keys array<long>, signature binary", "near_dedup")


def near_dedup(docs: DataFrame, settings: Settings | None = None) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of `docs` (doc_id, text).

    component_id is the smallest doc_id reachable over links, or the row's own. A text that is null or
    has no words is linked with nothing; so is a row without an id, whose component_id is null and
    which is kept. Rows of one id are one document. Other columns are not read.
    """
    s = settings or Settings()
    rows = stage(signed(docs, s), "signed")
    linkable = rows.where("doc_id IS NOT NULL AND class IS NOT NULL")
    classes = linkable.groupBy("class").agg(
        F.min(F.struct("doc_id", "n_shingles", "keys", "signature")).alias("first"), F.count("*").alias("copies")
    )
    # a class goes by its smallest doc_id
    nodes = stage(classes.select("class", "copies", F.col("first.doc_id").alias("node"), F.col("first.n_shingles").alias("n"), "first.keys", "first.signature"), "nodes")
    texts = docs.select(F.col("doc_id").cast("long").alias("node"), F.col("text").cast("string").cast("binary").alias("text"))

    member = nodes.select("node", F.explode("keys").alias("key"))
    hubs = member.groupBy("key").agg(F.min("node").alias("hub"), F.max("node").alias("last")).where("hub < last").drop("last")
    shared = stage(member.join(hubs, "key").select("key", "hub", "node"), "buckets")
    # ids that stand for several classes are linked to themselves by their id
    stars = _once(shared.where("hub < node").select(F.col("hub").alias("a"), F.col("node").alias("b")))
    # of the whole texts only those of documents that share a bucket move, once
    texts = stage(texts.join(shared.select("node").distinct(), "node", "left_semi"), "texts")
    links = stage(_confirmed(_alike(stars, nodes, s), texts, s), "links")

    label = components(links)
    labelled = shared.select("key", "node").join(label, "node", "left").select("key", "node", F.coalesce("component", "node").alias("component"))
    mixed = labelled.groupBy("key").agg(F.count("*").alias("members"), F.min("component").alias("low"), F.max("component").alias("high"))
    mixed = mixed.where("low < high").select("key", "members")
    across = stage(_confirmed(_across(labelled.join(mixed, "key"), nodes, texts, s), texts, s), "links")

    # these links join whole components: only the ends of theirs and what those stand in go on
    ends = across.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    joined = stage(across.union(label.join(ends, "node", "left_semi").select("node", "component")), "links")
    whole = components(joined).select(F.col("node").alias("first"), F.col("component").alias("whole"))
    found = nodes.join(label, "node", "left").select("class", "copies", "node", F.coalesce("component", "node").alias("first"), "component")
    found = found.join(whole, "first", "left").where("copies > 1 OR component IS NOT NULL OR whole IS NOT NULL")
    found = stage(found.select("class", F.coalesce("whole", "first").alias("component")), "components")
    out = rows.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.col("class")).alias("class"))
    component = F.coalesce("component", "doc_id")
    return out.join(found, "class", "left").select(
        "doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept")
    )


def _alike(pairs: DataFrame, nodes: DataFrame, s: Settings) -> DataFrame:
    """Pairs (a, b) whose sizes and signatures allow a link."""
    of = nodes.select("node", "n", "signature")
    for side in "ba":  # dealt by b as they come
        pairs = pairs.join(of.select(F.col("node").alias(side), F.col("n").alias(f"n_{side}"), F.col("signature").alias(f"s_{side}")), side)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                a, b = (_matrix(batch.column(c), s) for c in ("s_a", "s_b"))
                alike = (a == b).sum(axis=1) >= s.least_equal
                yield batch.select(["a", "b"]).filter(pa.array(alike))

    sized = pairs.where(F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * s.percent)
    return _once(in_arrow(sized.select("a", "b", "s_a", "s_b"), keep, "a long, b long", "near_dedup"))


def _once(pairs: DataFrame) -> DataFrame:
    """Each pair (a, b) once, dealt by b, the larger id, as the join with b wants it: hubs are an a."""
    return pairs.repartition("b").distinct()


def _matrix(column: pa.Array, s: Settings) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, s.coordinates)


GROUP = ["key", "low", "high"]
MEMBER = "key long, low int, high int, block int, node long, component long, n long, signature binary"


def _across(members: DataFrame, nodes: DataFrame, texts: DataFrame, s: Settings) -> DataFrame:
    """Links between different components of a bucket (key, node, component, members), by shingle
    hashes. A bucket is dealt into blocks of about `block`; two blocks meet in one task. Documents
    that by signature are like none of another component are left out before texts are fetched."""
    parts = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = (
        members.withColumn("blocks", F.ceil(F.col("members") / s.block).cast("int"))
        .withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("key", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", "node", "component")
        .join(nodes.select("node", "n", "signature"), "node")
        .select(*(c.split()[0] for c in MEMBER.split(", ")))
    )

    def partners(rows: pa.Table) -> Iterator[tuple[int, np.ndarray]]:
        """Each row with the later ones it may be linked with."""
        n, component, block = (rows.column(c).to_numpy() for c in ("n", "component", "block"))
        signature = _matrix(rows.column("signature"), s)
        one_block = rows.column("low")[0].as_py() == rows.column("high")[0].as_py()
        for i in range(len(n)):
            j = np.arange(i + 1, len(n))
            j = j[(component[j] != component[i]) & (one_block | (block[j] != block[i]))]
            j = j[np.minimum(n[j], n[i]) * 100 >= np.maximum(n[j], n[i]) * s.percent]
            j = j[(signature[j] == signature[i]).sum(axis=1) >= s.least_equal]
            if len(j):
                yield i, j

    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _groups(batches):
            some = np.zeros(len(rows), bool)
            for i, j in partners(rows):
                some[i] = some[j] = True
            if some.any():
                yield from rows.filter(pa.array(some)).combine_chunks().to_batches()

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _groups(batches):
            node, component = rows.column("node").to_numpy(), rows.column("component").to_numpy()
            sets = minhash.shingle_hashes([minhash.words(t or b"") for t in rows.column("text").to_pylist()], s.size)
            joined: dict[int, int] = {}

            def root(c: int) -> int:
                while c in joined:
                    c = joined[c]
                return c

            found: list[tuple[int, int]] = []
            for i, j in partners(rows):
                j = j[[root(component[k]) != root(component[i]) for k in j]]
                if not len(j):
                    continue
                sizes = np.array([len(sets[k]) for k in j])
                others = np.concatenate([sets[k] for k in j])
                at = np.minimum(np.searchsorted(sets[i], others), len(sets[i]) - 1)
                common = np.add.reduceat((sets[i][at] == others).astype(np.int64), np.cumsum(sizes) - sizes)
                for k in j[100 * common >= s.percent * (sizes + len(sets[i]) - common)].tolist():
                    x, y = root(component[i]), root(component[k])
                    if x != y:
                        joined[max(x, y)] = min(x, y)
                        found.append((min(node[i], node[k]), max(node[i], node[k])))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array([int(p[x]) for p in found], pa.int64()) for x in (0, 1)], ["a", "b"])

    together = in_arrow(dealt.repartition(parts, *GROUP).sortWithinPartitions(*GROUP), candidates, MEMBER, "near_dedup")
    with_text = stage(together, "candidates").join(texts, "node")
    grouped = with_text.repartition(parts, *GROUP).sortWithinPartitions(*GROUP)
    pairs = in_arrow(grouped, links, "a long, b long", "near_dedup").where("a < b")
    return _once(pairs)


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of each group, from rows in order of their group."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in GROUP], 1)
        cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
        edges = [0, *cuts.tolist(), batch.num_rows]
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            key = keys[a].tolist()
            if held and key != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
            last = key
    if held:
        yield pa.Table.from_batches(held)


def _confirmed(pairs: DataFrame, texts: DataFrame, s: Settings) -> DataFrame:
    """The pairs (a, b) whose full shingle sets are similar; some more than once where ids repeat."""
    for side in "ba":  # a is the smaller id, a hub perhaps: its rows come last and lie together
        pairs = pairs.join(texts.select(F.col("node").alias(side), F.col("text").alias(f"text_{side}")), side)

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, last_set = None, set()
        for batch in sliced(batches, "text_b", 4 << 20):
            a, b = [], []
            for x, y, text_x, text_y in zip(*(batch.column(c).to_pylist() for c in ("a", "b", "text_a", "text_b")), strict=True):
                if text_x != last:
                    last, last_set = text_x, minhash.shingle_set(text_x or b"", s.size)
                other = minhash.shingle_set(text_y or b"", s.size)
                common = len(last_set & other)
                if common and 100 * common >= s.percent * (len(last_set) + len(other) - common):
                    a.append(x)
                    b.append(y)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return in_arrow(pairs.select("a", "b", "text_a", "text_b"), confirm, "a long, b long", "near_dedup")


def deduplicated(docs: DataFrame, settings: Settings | None = None) -> DataFrame:
    """The rows of `docs`, all columns as they are, that `near_dedup` keeps: one id of each component.
    Rows without an id stay. What goes is broadcast where it was measured to fit, so that the documents
    are not shuffled to drop a few."""
    gone = stage(near_dedup(docs, settings).where("NOT kept").select("doc_id").distinct(), "gone")
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("id"))
    return rows.join(checked_broadcast(gone, GONE_BYTES), F.col("id") == F.col("doc_id"), "left_anti").select("row.*")
