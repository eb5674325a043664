"""Every registered query of the training-data operators, through the entry, and the pipeline as a whole."""

import base64
import hashlib
import re
import zlib
from itertools import combinations

import __spark_entry__ as entry
import corpus_pipeline
import duckdb
import numpy as np
import public_tokenizers
import pytest
import tiktoken
from odd import LONG, ODD, documents
from pyspark.sql import functions as F
from test_llm_dedup import brute_likeness, edited
from test_llm_structure import by_text, run_row
from tokenizers import Tokenizer

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def texts(spark):
    return {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def rows(spark, key):
    return entry.queries()[key](spark, SF).collect()


def test_all_operators_are_registered():
    keys = [k for k in entry.queries() if re.match(r"op\d+_", k)]
    assert sorted(int(k[2:].split("_")[0]) for k in keys) == list(range(1, 14)) and "pipeline" in entry.queries()


@pytest.mark.parametrize("key", [k for k in entry.oracle_sql() if re.match(r"op\d+_", k)])
def test_query_beside_its_sql(spark, key):
    db = duckdb.connect()
    for table in ("documents", "pages", "conversations"):
        db.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    df = entry.queries()[key](spark, SF)
    columns = sorted(df.columns)
    found = db.sql(entry.oracle_sql()[key])
    assert sorted(found.columns) == columns
    assert by_text(map(tuple, df.select(columns).collect())) == by_text(found.select(", ".join(columns)).fetchall())


def library(name, values, end=()):
    found = Tokenizer.from_file(public_tokenizers.path(name)).encode_batch([t or "" for t in values], add_special_tokens=False)
    return [[*e.ids, *end] for e in found]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def check_pieces(pieces, texts):
    ids = dict(zip(texts, library("word_bpe_49k.json", texts.values(), [2]), strict=True))
    taken, used = {}, {}
    for r in sorted(pieces, key=lambda r: (r["doc_id"], r["start"])):
        assert r["start"] == taken.get(r["doc_id"], 0) and r["doc_tokens"] == len(ids[r["doc_id"]])
        taken[r["doc_id"]] = r["start"] + r["length"]
        assert r["ids_crc32"] == crc(ids[r["doc_id"]][r["start"] : taken[r["doc_id"]]])
    assert taken == {i: len(x) for i, x in ids.items()}
    for r in sorted(pieces, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == used.get(r["sequence_id"], 0)
        used[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(used.values()) <= 4096
    return sum(4096 - n for n in used.values() if n & (n - 1)) / (4096 * len(used))


def test_op1(spark, texts):
    assert check_pieces(rows(spark, "op1_packing"), texts) < 0.05


def test_op2(spark, texts):
    got = sorted(rows(spark, "op2_token_archive"), key=lambda r: r["doc_id"])
    start = 0
    for r, ids in zip(got, library("byte_bpe_50k.json", [texts[i] for i in sorted(texts)], [0]), strict=True):
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (start, len(ids), crc(ids))
        start += len(ids)
    assert [r["doc_id"] for r in got] == sorted(texts)


def test_op3(spark, texts):
    langs = dict(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang").collect())
    got = {r["doc_id"]: r for r in rows(spark, "op3_language")}
    assert got.keys() == texts.keys()
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1) and 0 <= r["score"] <= 1 for i, r in got.items())
    held = [i for i in got if got[i]["held_out"] and langs[i]]
    assert np.mean([got[i]["lang_pred"] == langs[i] for i in held]) > 0.95


def test_op7(spark, texts):
    labels = dict(spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "quality").collect())
    got = {r["doc_id"]: r for r in rows(spark, "op7_quality")}
    assert got.keys() == texts.keys() and np.mean([got[i]["kept"] == bool(q) for i, q in labels.items()]) > 0.95


def test_op8(spark, texts):
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    tik = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for r in rows(spark, "op8_bpe"):
        text = texts[r["doc_id"]] or ""
        ids = tik.encode_ordinary(text)
        spelled = ",".join(map(str, ids)).encode()
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (len(ids), hashlib.sha256(spelled).hexdigest(), hashlib.sha256(text.encode()).hexdigest())


def test_op9(spark, texts):
    after, ids = edited([(i, t or "") for i, t in texts.items()]), sorted(texts)
    got = rows(spark, "op9_syncmers")
    assert sorted(r["doc_id"] for r in got) == ids
    for r in got:
        text = texts[r["doc_id"]] or ""
        follows = texts[ids[(ids.index(r["doc_id"]) + 1) % len(ids)]] or ""
        assert r["n_chars"] == len(text) and r["edited_sha256"] == hashlib.sha256(after[r["doc_id"]].encode()).hexdigest()
        assert r["near_edited"] == pytest.approx(brute_likeness(text, after[r["doc_id"]]))
        assert r["near_next"] == pytest.approx(brute_likeness(text, follows))


def test_op10(spark, texts):
    counts = dict(zip(texts, map(len, library("word_bpe_49k.json", texts.values())), strict=True))
    got = {r["doc_id"]: (r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in rows(spark, "op10_token_counts")}
    assert got == {i: (len((t or "").encode()), counts[i], counts[i] > 2048) for i, t in texts.items()}


def test_op12(spark, texts):
    got = by_text(tuple(r)[:8] for r in rows(spark, "op12_periodic_runs"))
    assert got == by_text(run_row(i, t) for i, t in texts.items())


def kept_by_near_dedup(texts):
    """The smallest id of each component of texts linked by shingles of five words."""
    sets = {}
    for i, t in texts.items():
        words = re.findall(r"[^\x20\x09-\x0D]+", t.translate({c: c + 32 for c in range(65, 91)}))
        sets[i] = {tuple(words[k : k + 5]) for k in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} if words else set()
    least = {i: i for i in sets}

    def root(i):
        while least[i] != i:
            i = least[i]
        return i

    for a, b in combinations(sorted(sets), 2):
        if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]) > 0:
            x, y = sorted((root(a), root(b)))
            least[y] = x
    return {i for i in sets if root(i) == i}


def test_the_pipeline_is_that_of_brute_force(spark, texts):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    first = docs
    for name, apply in corpus_pipeline.STAGES[:2]:
        first = corpus_pipeline.stage(apply(spark, first, SF), f"brute-{name}")
    kept = {r["doc_id"]: texts[r["doc_id"]] for r in first.select("doc_id").collect()}
    groups = {}
    for i, t in kept.items():
        groups.setdefault(t.translate({c: c + 32 for c in range(65, 91)}), []).append(i)
    distinct = {max(g): kept[max(g)] for g in groups.values()}
    unlike = kept_by_near_dedup(distinct)
    assert len(unlike) < len(distinct) < len(kept)
    pieces = corpus_pipeline.run(spark, SF).collect()
    assert {r["doc_id"] for r in pieces} == unlike
    check_pieces(pieces, {i: texts[i] for i in unlike})


def through(spark, docs):
    for name, apply in corpus_pipeline.STAGES:
        before = docs
        docs = corpus_pipeline.stage(apply(spark, docs, SF), f"odd-{name}")
        if name != "packing":
            assert docs.columns == before.columns
    return docs


def test_the_pipeline_takes_odd_rows(spark):
    # the clashing columns travel with their rows; null and empty texts have no language
    lang = lambda i, text: "en" if text else None
    pieces = through(spark, documents(spark, [*ODD, (6, LONG)], lang))
    found = {r["doc_id"] for r in pieces.collect()}
    assert found <= {i for i, _ in ODD} and not found & {1, 2, 3, 17}
    assert len({i for i in (2**53 + 1, -7, 14) if i in found}) <= 1  # one text


def test_the_pipeline_takes_an_empty_table(spark):
    assert through(spark, documents(spark, [])).count() == 0
    assert through(spark, documents(spark, [(1, None), (2, ""), (3, " \n")])).count() <= 3


def test_arrow_batches_are_bounded(spark):
    from dayledger.llm import workers

    spark.conf.set(workers.BYTES_SETTING, "64mb")
    through(spark, documents(spark, [(1, "a b c d e f g")]))
    assert spark.conf.get(workers.BYTES_SETTING) == str(workers.BATCH_BYTES)
    spark.conf.set(workers.BYTES_SETTING, "1mb")
    workers.in_arrow(spark.range(3), lambda batches: batches, "id long", "test").collect()
    assert spark.conf.get(workers.BYTES_SETTING) == "1mb"
    sizes = spark.range(20_000).select(F.repeat(F.lit("x"), 2000).alias("t")).coalesce(1)

    def measure(batches):
        import pyarrow as pa

        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], ["n"])

    assert max(r["n"] for r in workers.in_arrow(sizes, measure, "n long", "test").collect()) < 2 << 20
    assert [workers._bytes(x) for x in ("64MB", "1024", "67108864b", "-1", "2g")][:3] == [64 << 20, 1024, 64 << 20]
