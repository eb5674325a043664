"""Exact dedup, near dedup and fingerprints against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest
import xxhash
from odd import LONG, ODD, documents, prose
from pyspark.sql import functions as F

from dayledger.llm import components, exact_dedup, minhash, near_dedup, syncmers
from dayledger.sinks.staging import stage


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def exact(rows):
    """One tuple per row, as the contract says."""
    out = []
    for i, text in rows:
        group = [j for j, t in rows if lower(t) == lower(text)]
        keep = max((j for j in group if j is not None), default=None)
        out.append((i, keep, len(group), i == keep, hashlib.sha256(lower(text).encode()).hexdigest()))
    return sorted(out, key=str)


def test_exact_dedup_of_odd_rows(spark):
    got = exact_dedup.exact_dedup(documents(spark))
    assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert sorted(map(tuple, got.collect()), key=str) == exact(ODD)


def test_exact_dedup_over_many_partitions(spark):
    rows = [(i, "Same Text" if i % 3 else f"text {i % 40}") for i in range(900)]
    docs = documents(spark, rows).repartition(70)  # three rounds of runs
    assert sorted(map(tuple, exact_dedup.exact_dedup(docs).collect()), key=str) == exact(rows)


def test_exact_dedup_runs_no_python(spark):
    text = exact_dedup.exact_dedup(documents(spark))._jdf.queryExecution().toString()
    assert "Python" not in text and "Arrow" not in text


def test_one_row_of_each_text_stays(spark):
    docs = documents(spark)
    left = exact_dedup.deduplicated(docs)
    assert left.columns == docs.columns
    texts = [lower(r["text"]) for r in left.collect()]
    assert sorted(texts) == sorted({lower(t) for _, t in ODD})
    assert {r["doc_id"] for r in left.where(F.col("text").isNull() | (F.col("text") == "")).collect()} == {2}


def shingles(text, size):
    w = lower(text).encode().split()
    return {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} or ({tuple(w)} if w else set())


def near(rows, size=4):
    """doc_id -> (n_shingles, component) of distinct ids."""
    sets = {i: shingles(t, size) for i, t in rows}
    ids = sorted(sets)
    parent = {i: i for i in ids}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= 80 * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), root(i)) for i in ids}


def near_copies():
    """Chains and groups of copies of several bases, which share a long passage."""
    rng = random.Random(3)
    passage = prose(60, 100)
    rows = []
    for base in range(12):
        words = (passage + " " + prose(40 + 10 * base, base)).split()
        for copy in range(14):
            edited = list(words)
            for _ in range(copy % 7):
                edited[rng.randrange(len(edited))] = f"edit{rng.randrange(10**6)}"
            rows.append((len(rows) + 1, " ".join(edited) if copy % 2 else " ".join(edited).upper()))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("block", [512, 5])
def test_near_dedup_finds_all_links(spark, block):
    rows = near_copies()
    got = near_dedup.near_dedup(documents(spark, rows), near_dedup.Settings(block=block)).collect()
    want = near(rows)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == want
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_links_across_components_of_a_bucket_are_found(spark):
    """The smallest document of a bucket is like neither of two others that are like each other."""
    rng = random.Random(8)
    rows = []
    for base in range(30):
        words = prose(120, 500 + base).split()
        hub, a = list(words), list(words)
        for k in rng.sample(range(120), 4):
            hub[k] = f"h{base}x{k}"
        for k in rng.sample(range(120), 4):
            a[k] = f"a{base}x{k}"
        b = list(a)
        b[rng.randrange(120)] = "last"
        rows += [(3 * base + 1, " ".join(hub)), (3 * base + 2, " ".join(a)), (3 * base + 3, " ".join(b))]
    want = near(rows)
    assert any(c not in (i, 3 * ((i - 1) // 3) + 1) for i, (_, c) in want.items())
    got = near_dedup.near_dedup(documents(spark, rows)).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == want


def test_near_dedup_of_odd_rows(spark):
    got = near_dedup.near_dedup(documents(spark)).collect()
    assert len(got) == len(ODD)
    want = near([(i, t) for i, t in dict(reversed([(i, t) for i, t in ODD if i is not None])).items()])
    for r in got:
        if r["doc_id"] is None:
            assert r["component_id"] is None and r["kept"]
        else:
            assert (r["n_shingles"], r["component_id"]) == want[r["doc_id"]] and r["kept"] == (r["doc_id"] == r["component_id"])


def test_one_document_of_a_component_stays(spark):
    docs = documents(spark, near_copies())
    left = near_dedup.deduplicated(docs)
    assert left.columns == docs.columns
    assert {r["doc_id"] for r in left.collect()} == {c for _, c in near(near_copies()).values()}


def test_signatures_are_those_of_shifted_permutations():
    rng = np.random.default_rng(1)
    sets = [rng.integers(0, 2**63, n).astype(np.uint64) for n in (1, 5, 300, 0)]
    first, second = minhash.permutations(24)
    got = minhash.signatures(sets, 24, most=64)
    size = 1 << minhash.UNIVERSE_BITS
    for s, row in zip(sets, got, strict=True):
        places = [int(first[int(x) >> (64 - minhash.UNIVERSE_BITS)]) for x in s]
        want = [min((int(second[(p + k) % size]) for p in places), default=2**32 - 1) for k in range(24)]
        assert row.tolist() == want


def test_signatures_estimate_the_similarity():
    rng = np.random.default_rng(2)
    both = rng.integers(0, 2**63, 1000).astype(np.uint64)
    a, b = both[:900], both[100:]
    rows = minhash.signatures([a, b], 1000)
    assert (rows[0] == rows[1]).mean() == pytest.approx(0.8, abs=0.06)


def test_shingle_hashes_are_as_many_as_shingles():
    texts = [t.encode() for _, t in ODD if t]
    words = [minhash.words(t) for t in texts]
    for size in (1, 4, 5):
        got = minhash.shingle_hashes(words, size)
        assert [len(x) for x in got] == [len(minhash.shingle_set(t, size)) for t in texts]
    # the same shingle has the same hash wherever it stands, over segments too
    one, two = minhash.shingle_hashes([minhash.words(LONG.encode()), minhash.words(LONG.encode())[5000:]], 4)
    assert np.isin(two, one).all()


def test_components_of_long_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(1, 60)] + [(1000, 1000 + i) for i in range(1, 300)] + [(5000, 5000), (7001, 7000)]
    got = components.components(spark.createDataFrame(edges, "a long, b long"))
    found = {r["node"]: r["component"] for r in got.collect()}
    assert found == {i: 1 for i in range(1, 61)} | {i: 1000 for i in range(1000, 1300)} | {7000: 7000, 7001: 7000}
    assert got.count() == len(found)
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_stars_take_no_round_and_chains_few(spark, monkeypatch):
    rounds = []
    monkeypatch.setattr(components, "stage", lambda df, name: rounds.append(name) or stage(df, name))
    stars = [(1000 * k, 1000 * k + i) for k in range(1, 4) for i in range(1, 40)]
    found = components.components(stage(spark.createDataFrame([*stars, *stars, (7, 7)], "a long, b long"), "stars"))
    assert {tuple(r) for r in found.collect()} == {(b, a) for a, b in stars} | {(a, a) for a, _ in stars} and not rounds
    found = components.components(stage(spark.createDataFrame([(2, 1), (2, 3), (9, 8)], "a long, b long"), "chain"))
    assert {tuple(r) for r in found.collect()} == {(1, 1), (2, 1), (3, 1), (8, 8), (9, 8)} and len(rounds) == 1


def test_links_found_before_are_not_joined_again(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(near_dedup, "components", lambda links: seen.append(links.count()) or components.components(links))
    rows = []
    for base in range(6):
        text = prose(150, 900 + base)
        rows += [(10 * base + k, f"{text} end{k}") for k in range(1, 5)]
    got = near_dedup.near_dedup(documents(spark, rows)).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == near(rows)
    assert seen[0] >= 18 and seen[1] == 0


def signed(x):
    return x - 2**64 if x >= 2**63 else x


def chain(*hashes):
    seed = 42
    for h in hashes:
        seed = xxhash.xxh64_intdigest((h % 2**64).to_bytes(8, "little"), seed=seed)
    return signed(seed)


def anchors(units, text, inner, wide):
    """Hash -> place, by the definition; a hash that comes again is told apart by how often it came."""
    unit = [signed(xxhash.xxh64_intdigest(u.encode(), seed=42)) for u in units]
    parts = unit
    for i in range(1, inner):
        parts = [chain(a, b) for a, b in zip(parts, unit[i:], strict=False)]
    out, seen = {}, {}
    for i in range(len(parts) - wide + 1):
        k = parts[i : i + wide]
        if min(k) in (k[0], k[-1]):
            h = chain(*k[::inner], k[-1]) >> 32
            n = seen[h] = seen.get(h, -1) + 1
            out[again(h, n) if n else h] = i + 1
    return out or {signed(xxhash.xxh64_intdigest(text.encode(), seed=42)) >> 32: 0}


def again(h, n):
    return signed(xxhash.xxh64_intdigest(n.to_bytes(4, "little"), seed=xxhash.xxh64_intdigest((h % 2**64).to_bytes(8, "little"), seed=42))) >> 32


def likeness(x, y):
    """Of the anchors of both, the share at matching places."""
    shared = sorted((x[h], y[h]) for h in x.keys() & y.keys())
    shifts = [a - b for a, b in shared]
    agree = [abs(a - b) <= syncmers.DRIFT for a, b in zip(shifts, shifts[1:], strict=False)]
    n = len(shared) if len(shared) < 2 else sum(a or b for a, b in zip([False, *agree], [*agree, False], strict=True))
    return n / len(x.keys() | y.keys())


def brute_likeness(a, b):
    by_characters = all(len(t) <= syncmers.LONG or len(re.split("\\s+", t)) * syncmers.UNSPACED < len(t) for t in (a, b))
    units, shape = (list, syncmers.CHARACTERS) if by_characters else (lambda t: re.split("[ \\t\\n\\x0b\\f\\r]+", t), syncmers.WORDS)
    return likeness(anchors(units(a), a, *shape), anchors(units(b), b, *shape))


def test_likeness_is_that_of_brute_force(spark):
    rows = [(i, prose(3 + i * 7 % 160, i)) for i in range(40)] + [(100, "na " * 700), (101, "na " * 300 + prose(300, 1)), (102, "abc" * 90), (103, "x y " * 100), (104, prose(60, 5) + " " + prose(60, 5)), (105, prose(60, 5))]
    after = edited(rows)
    texts = dict(rows)
    ids = sorted(texts)
    for r in syncmers.compared(documents(spark, rows)).collect():
        i = r["doc_id"]
        follows = texts[ids[(ids.index(i) + 1) % len(ids)]]
        assert r["near_edited"] == pytest.approx(brute_likeness(texts[i], after[i])), i
        assert r["near_next"] == pytest.approx(brute_likeness(texts[i], follows)), i


def test_a_repeated_text_scores_like_a_plain_one(spark):
    once, words = plain_words(9, 3), plain_words(3600, 8)
    rows = [(1, " ".join(once * 400)), (2, " ".join(words)), (3, " ".join(plain_words(3600, 2))), (4, "na " * 3000), (5, " ".join(plain_words(3000, 9)))]
    got = {r["doc_id"]: r["near_edited"] for r in syncmers.compared(documents(spark, rows)).collect()}
    assert 0.55 < got[2] < 0.65
    assert 0.5 < got[1] < 0.7  # of nine different k-mers, three to six are anchors
    # 2250 of 3000 words are left, and 321 longer ones came, every second of which is an anchor
    assert 0.66 < got[4] < 0.74


def test_fingerprints_are_shorter_than_their_texts(spark):
    rows = [(i, prose(200 + 37 * i, i)) for i in range(20)]
    for r in syncmers.compared(documents(spark, rows)).collect():
        assert len(r["fingerprint"]) < 0.75 * r["n_chars"]


def test_anchors_are_the_closed_syncmers(spark):
    texts = [prose(90, 1), prose(40, 2), "Short text.", "abc", "a b " * 200, LONG]
    rows = syncmers.fingerprinted(spark.createDataFrame([(t,) for t in texts], "text string"), "text", "f").collect()
    assert len(rows) == len(texts)
    for r in rows:
        text = r["text"]
        assert (r["f_w"] is not None) == (len(text) > 300) and (r["f_c"] is not None) == (len(text) <= 600)
        for unit, units, (inner, wide) in (("w", text.split(" "), syncmers.WORDS), ("c", list(text), syncmers.CHARACTERS)):
            if r[f"f_{unit}"] is not None:
                assert dict(zip(r[f"f_{unit}"], r[f"f_{unit}p"], strict=True)) == anchors(units, text, inner, wide)


def edited(rows):
    rows = sorted(rows)
    out = {}
    for k, (i, text) in enumerate(rows):
        cut = len(text) // 4
        out[i] = text[: len(text) - cut] + rows[(k + 1) % len(rows)][1][:cut]
    return out


def test_edited_texts_over_many_ranges(spark):
    rows = [(i * 97 - 5000 + 10**15 * (i // 150), prose(5 + i % 50, i)) for i in range(300)]
    got = syncmers.compared(documents(spark, rows)).collect()
    want = edited(rows)
    assert {r["doc_id"]: r["edited_sha256"] for r in got} == {i: hashlib.sha256(t.encode()).hexdigest() for i, t in want.items()}
    assert all(0 <= r["near_next"] <= r["near_edited"] <= 1 for r in got)
    assert np.median([r["near_edited"] for r in got]) > 0.4 and np.median([r["near_next"] for r in got]) < 0.1


def test_fingerprints_of_odd_rows(spark):
    got = syncmers.compared(documents(spark)).collect()
    assert len(got) == len(ODD)
    by_text = {}
    for r in got:
        texts = [t or "" for i, t in ODD if i == r["doc_id"]]
        assert r["n_chars"] in {len(t) for t in texts} and 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
        if len(texts) == 1:
            by_text.setdefault(texts[0], set()).add(r["fingerprint"])
    assert all(len(f) == 1 for f in by_text.values())
    assert len({r["fingerprint"] for r in got if r["doc_id"] in (2**53 + 1, -7, 14)}) == 1


def test_a_single_document_follows_itself(spark):
    row = syncmers.compared(documents(spark, [(5, "abcdefgh")])).first()
    assert row["edited_sha256"] == hashlib.sha256(b"abcdefab").hexdigest() and row["near_next"] == 1.0
    assert syncmers.compared(documents(spark, [])).count() == 0


def test_anchors_of_a_text_are_found_once(spark, monkeypatch):
    """They go to the row before with the text. A row without an id has the empty text behind it."""
    found, real = [], syncmers._anchors
    monkeypatch.setattr(syncmers, "_anchors", lambda df, units, text, *rest: found.append(text) or real(df, units, text, *rest))
    rows = [(None, ""), (None, "some words"), (7, "some words"), (7, "some words"), (300, ""), (900, "some words")]
    got = sorted((r["doc_id"] or 0, r["n_chars"], r["near_next"]) for r in syncmers.compared(documents(spark, rows)).collect())
    assert sorted(found) == ["edited", "edited", "text", "text"]
    assert got == [(0, 0, 1.0), (0, 10, 0.0), (7, 10, 0.0), (7, 10, 1.0), (300, 0, 0.0), (900, 10, 1.0)]


def test_fingerprints_run_no_python(spark):
    text = syncmers.compared(documents(spark))._jdf.queryExecution().toString()
    assert "Python" not in text and "Arrow" not in text


def test_dedup_of_tables_without_rows(spark):
    none = documents(spark, [])
    assert exact_dedup.exact_dedup(none).count() == 0 and exact_dedup.deduplicated(none).count() == 0
    assert near_dedup.near_dedup(none).count() == 0 and near_dedup.deduplicated(none).count() == 0


def near_next(spark, first, second):
    """Likeness of a text to the next one."""
    rows = syncmers.compared(documents(spark, [(1, first), (2, second)])).collect()
    return next(r["near_next"] for r in rows if r["doc_id"] == 1)


def plain_words(n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choices("abcdefghijklmnop", k=6)) for _ in range(n)]


def test_copies_with_paragraphs_inserted_and_removed_stay_alike(spark):
    text, more = plain_words(2000, 1), plain_words(120, 2)
    inserted = text[:500] + more[:40] + text[500:1000] + more[40:80] + text[1000:1500] + more[80:] + text[1500:]
    removed = text[:700] + text[760:1300] + text[1350:]
    got = [near_next(spark, " ".join(text), " ".join(t)) for t in (inserted, removed)]
    got.append(near_next(spark, " ".join(text[:1000]), " ".join(text[:500] + more[:40] + text[500:1000])))
    assert min(got) > 0.8, got
    assert near_next(spark, " ".join(text), " ".join(plain_words(2000, 3))) == 0.0


def test_fingerprints_hold_all_anchors_of_long_texts(spark):
    first, second = plain_words(4000, 4), plain_words(4000, 5)
    second[1000:1200] = first[2500:2700]
    assert 0.015 < near_next(spark, " ".join(first), " ".join(second)) < 0.04  # 200 of 7800 words
    rows = [(1, " ".join(first)), (2, " ".join(second))]
    got = {r["doc_id"]: r for r in syncmers.compared(documents(spark, rows)).collect()}
    assert 0.57 < got[1]["near_edited"] < 0.63  # three quarters of both, of five quarters
    want = anchors(first, " ".join(first), *syncmers.WORDS)
    assert len(got[1]["fingerprint"].split(":")[2]) == len(want) > 1000


def test_short_texts_are_compared_with_long_ones(spark):
    short = " ".join(plain_words(43, 6))[:300]
    long = short + " " + " ".join(plain_words(43, 7))[:300]
    assert len(short) == 300 and len(long) == 601
    assert 0.4 < near_next(spark, short, long) < 0.6 and 0.4 < near_next(spark, long, short) < 0.6
    assert near_next(spark, "", long) == 0.0 and near_next(spark, "", "") == 1.0


@pytest.mark.parametrize("dedup", [exact_dedup.deduplicated, near_dedup.deduplicated])
def test_documents_are_not_shuffled_to_drop_a_few(spark, dedup):
    docs = documents(spark, near_copies())
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for a list of ids that is over it
    try:
        left = dedup(docs)
        assert re.search("BroadcastHashJoin.*LeftAnti", left._jdf.queryExecution().toString())
        assert 0 < left.count() <= docs.count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
