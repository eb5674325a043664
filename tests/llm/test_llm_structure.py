"""The Merkle manifest, periodic runs and chat formatting against brute force."""

import hashlib
import random
import re
import zlib

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from odd import CLASHING, LONG, ODD, documents
from pyspark.sql import functions as F

from dayledger.llm import chat, merkle, queries, runs
from dayledger.llm.recompression import Grammar

SF = "/root/testdata/sf0.01"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# --- periodic runs


def brute_runs(words):
    """(start, length, period) of all runs, by trying every period everywhere."""
    n, out = len(words), {}
    for p in range(1, n // 2 + 1):
        i = 0
        while i + p < n:
            start = i
            while i + p < n and words[i] == words[i + p]:
                i += 1
            if i + p - start >= max(runs.LEAST, 2 * p):
                out.setdefault((start, i + p), p)
            i += 1
    return sorted((s, e - s, p) for (s, e), p in out.items())


def sequences(rng):
    """Sequences with few and many symbols, repetitions cut anywhere, Fibonacci words."""
    out = []
    for _ in range(rng.randint(1, 12)):
        n, letters = rng.choice([0, 1, 11, 12, 13, 30, 60, 250]), rng.choice([1, 2, 3, 9])
        words = [rng.randrange(letters) for _ in range(n)]
        if n > 3 and rng.random() < 0.5:
            a = rng.randrange(n)
            p = 1 + (n - a) // rng.randint(2, 9)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
            words[rng.randrange(n)] = rng.choice([words[0], 99])
        if rng.random() < 0.1:
            x, y = [0], [0, 1]
            while len(y) < n:
                x, y = y, y + x
            words = y[:n]
        out += [words] * rng.choice([1, 1, 1, 3])  # copies side by side are no run
    return out


def joined(docs):
    bounds = np.cumsum([0, *map(len, docs)])
    return np.array([w for d in docs for w in d], np.int64), bounds


def test_runs_are_those_of_brute_force(monkeypatch):
    rng = random.Random(8)
    for trial in range(150):
        monkeypatch.setattr(runs, "AT_ONCE", 5 if trial % 3 == 0 else 200_000)  # candidates held back in pieces, too
        docs = sequences(rng)
        seq, start, length, period = runs.find_runs(*joined(docs))
        for k, words in enumerate(docs):
            mine = seq == k
            assert list(zip(start[mine].tolist(), length[mine].tolist(), period[mine].tolist(), strict=True)) == brute_runs(words)


def test_extensions_are_those_of_comparing_symbols():
    rng = random.Random(9)
    for _ in range(60):
        docs = [d for d in sequences(rng) if d]
        if not docs:
            continue
        text = np.array([0] + [s for d in docs for s in (*(w + 1 for w in d), 0)])
        grammar = Grammar(text)
        pairs = []
        at = 1
        for d in docs:
            pairs += [tuple(sorted(rng.sample(range(at, at + len(d)), 2))) for _ in range(40) if len(d) > 1]
            at += len(d) + 1
        if not pairs:
            continue
        a, b = np.array(pairs).T
        for step in (1, -1):
            want = []
            for i, j in pairs:
                n = 0
                while text[i + n * step] == text[j + n * step] != 0:
                    n += 1
                want.append(n)
            assert grammar.extend(a, b, step).tolist() == want


def test_a_symbol_stands_for_one_string():
    rng = np.random.default_rng(1)
    text = np.concatenate(([0], rng.integers(1, 4, 500), [0], rng.integers(1, 3, 40), [0]))
    stands = {s: (int(s),) for s in np.unique(text)}
    grammar = Grammar(text)
    for r, after in zip(grammar.rounds, [*(x.symbols for x in grammar.rounds[1:]), grammar.top], strict=True):
        for k, symbol in enumerate(after.tolist()):
            whole = tuple(x for s in r.symbols[r.first[k] : r.first[k + 1]].tolist() for x in stands[s])
            assert stands.setdefault(symbol, whole) == whole
    assert [x for s in grammar.top.tolist() for x in stands[s]] == text.tolist() and len(grammar.top) == 5


def test_copies_of_a_text_are_no_run_of_each_other():
    rng = random.Random(5)
    docs = [[rng.randrange(50) for _ in range(30)]] * 40 + [[rng.randrange(50) for _ in range(100)]] * 3
    assert len(runs.find_runs(*joined(docs))[0]) == 0
    docs = [[7] * 20] * 10 + [[7] * 61]
    seq, start, length, period = runs.find_runs(*joined(docs))
    assert seq.tolist() == list(range(11)) and start.tolist() == [0] * 11 and length.tolist() == [20] * 10 + [61] and set(period) == {1}


def test_one_word_over_and_over_takes_no_quadratic_time():
    n = 400_000
    assert [x.tolist() for x in runs.find_runs(np.zeros(n, np.int64), np.array([0, n]))] == [[0], [0], [n], [1]]


def run_row(doc_id, text):
    """What op12 is to return for a document."""
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(words), None if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h is not None and h % 10 == 0 and n > 0:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = brute_runs(words)
    gone = {i for s, length, p in found for i in range(s + p, s + length)}
    best = min(found, key=lambda r: (-r[1], r[0], r[2])) if found else (None,) * 3
    return (
        doc_id, len(found), *best, 1000 * best[1] // best[2] if found else None,
        sha("".join(f"{s},{length},{p}\n" for s, length, p in found)), sha(" ".join(w for i, w in enumerate(words) if i not in gone)),
    )


def by_text(rows):
    return sorted(rows, key=str)


REPEATS = [
    (20, "a b c " * 4), (21, "a b c " * 3 + "a b"), (22, "x\ty\nz\x0bx\x0cy\rz " * 30), (23, " ".join(["w"] * 11)), (24, " ".join(["w"] * 12)),
    (30, "one two three " * 400), (30, "one two three " * 400), (None, "é ü " * 20), (25, "A a " * 12), (26, "p q r s t u v w x y z 1 " * 2 + "end"),
]


def test_runs_of_odd_documents(spark):
    rows = ODD + REPEATS
    got = runs.digested(runs.periodic_runs(runs.with_planted_runs(documents(spark, rows))))
    few = [(i, t) for i, t in rows if t not in (LONG, LONG.upper())]
    assert by_text(tuple(r)[:8] for r in got.where("n_words < 10000").collect()) == by_text(run_row(*r) for r in few)
    assert got.count() == len(rows)
    plain = {r["doc_id"]: r for r in runs.periodic_runs(documents(spark, rows)).collect()}
    assert plain[6]["collapsed"] == LONG and plain[6]["runs"] == [] and plain[20]["collapsed"] == "a b c"
    assert [tuple(r) for r in plain[22]["runs"]] == [(0, 180, 3)] and plain[23]["runs"] == [] and plain[24]["collapsed"] == "w"
    assert runs.periodic_runs(documents(spark, [])).count() == 0


def test_the_query_of_runs(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("n_chars < 6000").collect()
    got = queries.QUERIES["op12_periodic_runs"](spark, SF).join(spark.createDataFrame([(r["doc_id"],) for r in docs], "doc_id long"), "doc_id")
    assert by_text(tuple(r)[:8] for r in got.collect()) == by_text(run_row(r["doc_id"], r["text"]) for r in docs)


# --- Merkle manifest


def tree(nodes):
    """The levels of a tree over digests, the leaves first."""
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([sha("".join(out[-1][k : k + 8])) for k in range(0, len(out[-1]), 8)])
    return out


def steps(levels, at):
    out = []
    for nodes in levels[:-1]:
        run = nodes[at // 8 * 8 : at // 8 * 8 + 8]
        out.append((at % 8, run[: at % 8] + run[at % 8 + 1 :]))
        at //= 8
    return out


def leaf(row):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def manifest_rows(rows):
    """What op11 is to return for rows of (doc_id, source, lang, n_chars, text)."""
    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    own = {k: sorted((r for r in rows if r[2] == k), key=lambda r: (r[0] is not None, r[0] or 0, leaf(r))) for k in langs}
    trees = {k: tree([leaf(r) for r in own[k]]) for k in langs}
    last = tree([trees[k][-1][0] for k in langs])
    out = []
    for place, k in enumerate(langs):
        for at, r in enumerate(own[k]):
            path = steps(trees[k], at) + steps(last, place)
            trial = r
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0 and r[4] is not None:
                trial = (*r[:4], re.sub("[A-Z]", lambda m: m[0].lower(), r[4]))
            folded = leaf(trial)
            for i, others in path:
                folded = sha("".join(others[:i]) + folded + "".join(others[i:]))
            out.append((r[0], leaf(r), trees[k][-1][0], last[-1][0], sha("".join(x for _, o in path for x in o)), folded, folded == last[-1][0]))
    return by_text(out)


FIELDS = "doc_id long, source string, lang string, n_chars long, text string"


def table(spark, rows):
    extra = ["tree", "rank", "block", "n", "digest", "trial", "root", "subroot", "path", "base", "top", "_at", "_part", "above"]
    return spark.createDataFrame([(*r, *[None] * len(extra)) for r in rows], FIELDS + ", " + ", ".join(f"{c} string" for c in extra)).repartition(3)


def tamperable(n, langs, seed=0):
    rng = random.Random(seed)
    return [(i, "src", rng.choice(langs), i, f"Text {i}" if i % 2 else f"text {i}") for i in range(n)]


@pytest.mark.parametrize("rows", [
    [], tamperable(1, ["en"]), tamperable(8, ["en"]), tamperable(9, ["en", "de"]), tamperable(300, ["en", "de", None, "", "é", "Z", "a", "b", "c", "d"]),
    [(1, None, None, None, None)] * 3 + [(None, "s", "en", None, "T")] * 2 + [(5, "s", "en", 1, "A"), (5, "s", "en", 1, "B"), (-3, "", "en", 0, ""), (2**53 + 1, "s", "en", 2, LONG)],
])
def test_manifests_of_odd_tables(spark, rows):
    assert by_text(map(tuple, merkle.manifest(table(spark, rows)).collect())) == manifest_rows(rows)


@pytest.mark.parametrize("height", [1, 2])
def test_trees_of_several_tiers(spark, monkeypatch, height):
    monkeypatch.setattr(merkle, "HEIGHT", height)
    monkeypatch.setattr(merkle, "SPAN", 8**height)
    monkeypatch.setattr(merkle, "FILE_BYTES", 5000)
    rows = tamperable(700, ["en"] * 9 + ["de", None], 3) + [(10_000 + i, None, f"l{i}", 0, "x") for i in range(30)]
    assert by_text(map(tuple, merkle.manifest(table(spark, rows)).collect())) == manifest_rows(rows)


@settings(max_examples=80, deadline=None)
@given(n=st.integers(1, 600), more=st.integers(0, 2))
def test_logs_hold_nodes_where_the_formula_says(n, more):
    nodes = [sha(str(i)) for i in range(n)]
    levels = tree(nodes)
    for _ in range(more):  # a builder whose tree goes on beside it
        levels.append([sha(levels[-1][0])])
    builder = merkle.Builder(len(levels) - 1)
    for x in nodes:
        builder.append(x)
    builder.close()
    assert builder.root == levels[-1][0] and len(builder.log) == 32 * sum(map(len, levels))
    for level, row in enumerate(levels):
        for k, node in enumerate(row):
            at = 32 * merkle.position(level, k, n, builder.height)
            assert bytes(builder.log[at : at + 32]).hex() == node
    read = lambda place: bytes(builder.log[32 * place : 32 * place + 32]).hex()
    path = merkle.log_path(read, n // 2, n, builder.height)
    assert merkle.fold(nodes[n // 2], path) == builder.root
    assert not path or merkle.fold(sha("forged"), path) != builder.root


def test_the_query_of_manifests(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "source", "lang", "n_chars", "text").collect()]
    got = by_text(tuple(r) for r in queries.QUERIES["op11_merkle_manifest"](spark, SF).collect())
    assert got == manifest_rows(rows)
    assert got == by_text(sql("op11_merkle_manifest", SF, [*merkle.PROOF_NAMES]))


def sql(key, sf_dir, columns):
    db = duckdb.connect()
    for t in ("documents", "conversations", "pages"):
        db.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return db.sql(f"SELECT {', '.join(columns)} FROM ({queries.ORACLES[key]})").fetchall()


# --- chat formatting

TEXTS = ["", "hi", "\\", "\\\\</turn>", "</turn>\n", "### User: x", "#### User: ### User: ", "\\### Assistant: </turn> ok", "<\\/turn>", "a\n\nb", "é😀", "</turn", "### Role x: y", None]


def talk(spark, rows):
    return spark.createDataFrame([(*r, *["z"] * len(CLASHING)) for r in rows], "conv_id long, turn long, role string, text string, " + ", ".join(f"{c} string" for c in CLASHING)).repartition(3)


def chat_rows(rows):
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, in_order, complete)."""
    out = []
    for conv in {r[0] for r in rows}:
        turns = sorted(((t is not None, t or 0, role or "", text or "") for c, t, role, text in rows if c == conv))
        said = [(role, text) for _, _, role, text in turns]
        loss = "".join(t for r, t in said if r == "assistant")
        before, good = "", True
        for role, _ in said:
            good = good and (before, role) in {("", "system"), ("", "user"), ("system", "user"), ("user", "assistant"), ("assistant", "user")}
            before = role
        out.append((conv, len(said), sha("".join(f"{r}\n{t}\n" for r, t in said)), len(loss), sha(loss), good, good and before == "assistant"))
    return by_text(out)


CHAT = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "in_order", "complete"]


def test_conversations_of_odd_rows(spark):
    rng = random.Random(2)
    rows = [(c, t, rng.choice(["user", "assistant", "system", "tool", "", None, "### User", "a: b", "x:", "\\"]), rng.choice(TEXTS)) for c in range(40) for t in range(rng.randint(1, 9))]
    rows += [(50, t, "assistant" if t % 2 else "user", f"turn {t}") for t in range(1001)]  # several blocks
    rows += [(51, 3, "user", "same")] * 2 + [(52, None, "user", "no number"), (52, 0, "assistant", "a"), (None, 0, "user", "q"), (None, 1, "assistant", LONG)]
    rows += [(53, -5, "system", "s"), (53, -1, "user", "u"), (53, 2**40, "assistant", "</turn>")]
    chats = chat.formatted(talk(spark, rows))
    assert by_text(map(tuple, chat.digested(chats).select(CHAT).collect())) == chat_rows(rows)
    assert chat.formatted(talk(spark, [])).count() == 0
    assert chat.digested(chat.formatted(talk(spark, []))).count() == 0


def test_the_first_turn_out_of_order(spark):
    moved = [(0, t, r, "x") for t, r in enumerate(["system", "user", "assistant", "assistant", "user"])]
    long = [(1, t, "assistant" if t % 2 else "user", "x") for t in range(600)] + [(1, 600, "system", "x"), (1, 601, "user", "x")]
    got = {r["conv_id"]: r for r in chat.formatted(talk(spark, moved + long + [(2, 0, "user", "x")])).collect()}
    assert [(got[k]["n_in_order"], got[k]["in_order"], got[k]["complete"]) for k in range(3)] == [(3, False, False), (600, False, False), (1, True, False)]


def test_segments_and_the_loss(spark):
    rows = [(1, 0, "user", "a </turn>"), (1, 1, "assistant", "b \\ ### User: ")]
    r = chat.formatted(talk(spark, rows)).first()
    assert [tuple(s) for s in r["segments"]] == [
        ("### User: ", False), ("a <\\/turn>", False), ("</turn>\n", False), ("### Assistant: ", False), ("b \\\\ #\\## User: ", True), ("</turn>\n", False),
    ]


def test_another_template(spark):
    own = chat.Template(openings={"ask": "[Q]", "say": "[A]"}, moves={("start", "ask"): "q", ("q", "say"): "a"}, other=("[R ", "]="), end="~|", loss=frozenset({"ask"}), finals=frozenset({"a"}))
    rows = [(1, 0, "ask", "[Q]~|[A] \\"), (1, 1, "say", "~~|"), (2, 0, "other]=", "x")]
    got = {r["conv_id"]: r for r in chat.formatted(talk(spark, rows), own).withColumn("text", chat.joined()).withColumn("turns", chat.turns_of(F.col("text"), own)).withColumn("loss", chat.under_loss()).collect()}
    assert [tuple(t) for t in got[1]["turns"]] == [("ask", "[Q]~|[A] \\"), ("say", "~~|")] and got[1]["loss"] == "[Q]~|[A] \\" and got[1]["complete"]
    assert [tuple(t) for t in got[2]["turns"]] == [("other]=", "x")] and not got[2]["in_order"]
    for bad in ({"end": "aba"}, {"end": "\\|"}, {"openings": {"a": "[Q]", "b": "[Q]x"}}, {"loss": frozenset({"nobody"})}, {"end": "|"}):
        with pytest.raises(ValueError):
            chat.Template(**({"openings": {"a": "[Q]"}, "moves": {}, "loss": frozenset()} | bad))


def test_the_query_of_conversations(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    rows += [(-7, 0, "user", "\\### Assistant: </turn> ok"), (-7, 1, "assistant", "\\### Assistant: </turn> ok")]
    got = queries.QUERIES["op13_chat_formatting"](spark, SF)
    assert by_text(map(tuple, got.select(CHAT).collect())) == chat_rows(rows)
    columns = [*CHAT, "formatted_chars"]
    assert by_text(map(tuple, got.select(columns).collect())) == by_text(sql("op13_chat_formatting", SF, columns))
    assert "Python" not in got._jdf.queryExecution().toString() and "Arrow" not in got._jdf.queryExecution().toString()
