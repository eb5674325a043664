"""The operators with production settings over whole tables, as queries, and SQL where it can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from dayledger.llm import bpe, chat, exact_dedup, language, merkle, near_dedup, packing, quality, repair, runs, syncmers, token_counts, warc
from dayledger.sinks.staging import fresh_path, stage

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(table: str, sql: str | None = None):
    """Register a function of a whole table under its name."""

    def register(build: Callable[[DataFrame], DataFrame]):
        QUERIES[build.__name__] = lambda spark, sf_dir: build(spark.read.parquet(f"{sf_dir}/{table}.parquet"))
        if sql:
            ORACLES[build.__name__] = sql
        return build

    return register


@query("documents")
def op1_packing(documents: DataFrame) -> DataFrame:
    return packing.packed_documents(documents, public_tokenizers.path("word_bpe_49k.json"), end_id=2)


@query("documents")
def op2_token_archive(documents: DataFrame) -> DataFrame:
    return repair.token_archive(documents, public_tokenizers.path("byte_bpe_50k.json"), end_id=0, terminals=50257)


@query("documents")
def op8_bpe(documents: DataFrame) -> DataFrame:
    return bpe.encode_documents(documents, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


@query("documents")
def op10_token_counts(documents: DataFrame) -> DataFrame:
    cache = fresh_path(documents.sparkSession, "token-counts")  # empty at first: every distinct text is encoded
    return token_counts.count_tokens(documents, public_tokenizers.path("word_bpe_49k.json"), cache)


LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@query("pages", """
    WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
    last AS (SELECT page_id, html, max(page_id) OVER (PARTITION BY html) AS last FROM p)
    SELECT page_id, strlen(html)::BIGINT AS payload_bytes, sha1(html) AS payload_digest,
           CASE WHEN strlen(html) >= 1000 AND page_id <> last THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN strlen(html) >= 1000 AND page_id <> last THEN last END AS refers_to
    FROM last""")
def op4_warc(pages: DataFrame) -> DataFrame:
    return warc.archived(pages).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("documents", f"""
    SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
           doc_id = max(doc_id) OVER same AS kept, sha256(text) AS text_sha256
    FROM (SELECT doc_id, {LOWER} AS text FROM documents)
    WINDOW same AS (PARTITION BY text)""")
def op6_exact_dedup(documents: DataFrame) -> DataFrame:
    return exact_dedup.exact_dedup(documents)


WORDS = r"regexp_extract_all(" + LOWER + r", '[^\x20\x09-\x0D]+')"


@query("documents", f"""
    WITH RECURSIVE w AS MATERIALIZED (SELECT doc_id, {WORDS} AS w FROM documents),
    shingle AS MATERIALIZED (
        SELECT DISTINCT doc_id, unnest(CASE
            WHEN len(w) >= 4 THEN list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i : i + 3], ' '))
            WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s
        FROM w),
    n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id),
    common AS MATERIALIZED (
        SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c
        FROM shingle x JOIN shingle y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL),
    link AS MATERIALIZED (
        SELECT a, b FROM common JOIN n AS na ON na.doc_id = a JOIN n AS nb ON nb.doc_id = b
        WHERE 100 * c >= 80 * (na.n + nb.n - c)),
    reach AS (SELECT a, b FROM link UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a),
    least AS (SELECT a AS doc_id, min(b) AS low FROM reach GROUP BY a)
    SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, least(d.doc_id, coalesce(least.low, d.doc_id)) AS component_id,
           d.doc_id <= coalesce(least.low, d.doc_id) AS kept
    FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN least USING (doc_id)""")
def op5_near_dedup(documents: DataFrame) -> DataFrame:
    return near_dedup.near_dedup(documents)


@query("documents")
def op9_syncmers(documents: DataFrame) -> DataFrame:
    return syncmers.compared(documents)


@query("documents")
def op3_language(documents: DataFrame) -> DataFrame:
    model = language.learn(documents.where(language.in_training()))
    predicted = language.predict(documents, model)
    return predicted.select("doc_id", (~language.in_training()).alias("held_out"), "lang_pred", "score")


@query("documents")
def op7_quality(documents: DataFrame) -> DataFrame:
    return quality.judged(documents, quality.learn(documents))


# crc32 of the decimal id, bit by bit: DuckDB has no function for it
CRC32 = """xor(4294967295, list_reduce(
    [4294967295] || list_transform(range(1, strlen(doc_id::VARCHAR) + 1), lambda i: ascii(substr(doc_id::VARCHAR, i::BIGINT, 1))::BIGINT),
    lambda crc, byte: list_reduce([xor(crc, byte)] || [0::BIGINT, 0, 0, 0, 0, 0, 0, 0],
                                  lambda c, _: xor(c >> 1, (c & 1) * 3988292384))))"""


def _field(value: str) -> str:
    return f"CASE WHEN {value} IS NULL THEN '-' ELSE strlen({value}::VARCHAR)::VARCHAR || ':' || {value}::VARCHAR END"


def _leaf(text: str) -> str:
    return f"sha256({' || '.join(_field(c) for c in ('doc_id', 'source', 'lang', 'n_chars', text))})"


def _levels(name: str, levels: int) -> str:
    """Levels of the trees of table {name}0 (tree, pos, n, node, left, right: what stands beside the node in its run)."""
    out = []
    for k in range(levels):
        out.append(f"""{name}{k} AS MATERIALIZED (
            SELECT tree, pos, n, node,
                   CASE WHEN n = 1 THEN '' ELSE coalesce(string_agg(node, '') OVER (run ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') END AS before,
                   CASE WHEN n = 1 THEN '' ELSE coalesce(string_agg(node, '') OVER (run ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') END AS behind
            FROM {name}{k}_nodes WINDOW run AS (PARTITION BY tree, pos // 8 ORDER BY pos))""")
        out.append(f"""{name}{k + 1}_nodes AS MATERIALIZED (
            SELECT tree, pos // 8 AS pos, (max(n) + 7) // 8 AS n,
                   CASE WHEN max(n) = 1 THEN max(node) ELSE sha256(string_agg(node, '' ORDER BY pos)) END AS node
            FROM {name}{k}_nodes GROUP BY tree, pos // 8)""")
    return ", ".join(out)


def _steps(name: str, levels: int, pos: str, tree: str) -> str:
    return " ".join(
        f"JOIN {name}{k} AS {name}s{k} ON {name}s{k}.tree = {tree} AND {name}s{k}.pos = {pos} // {8**k}" for k in range(levels)
    )


D, L = 7, 2  # levels of the SQL: up to 8^7 rows of a lang and 64 langs


def _merkle_sql() -> str:
    nodes = [f"ds{k}" for k in range(D)] + [f"rs{k}" for k in range(L)]
    proof = " || ".join(f"{n}.before || {n}.behind" for n in nodes)
    steps, last = [], "l.trial"
    for k, n in enumerate(nodes):
        last = f"f{k + 1}"
        steps.append(f"q{k + 1} AS (SELECT *, CASE WHEN alone[{k + 1}] THEN f{k} ELSE sha256(befores[{k + 1}] || f{k} || behinds[{k + 1}]) END AS f{k + 1} FROM q{k})")
    listed = {c: ", ".join(f"{n}.{c}" for n in nodes) for c in ("before", "behind")}
    alone = ", ".join(f"{n}.n = 1" for n in nodes)
    return f"""
    WITH leaf AS MATERIALIZED (
        SELECT doc_id, lang, coalesce('=' || lang, '-') AS tree, {_leaf('text')} AS leaf,
               CASE WHEN coalesce({CRC32} % 3 = 0, false) THEN {_leaf(f"translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")}
                    ELSE {_leaf('text')} END AS trial
        FROM documents),
    l AS MATERIALIZED (
        SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY tree) AS n FROM leaf),
    d0_nodes AS (SELECT tree, pos, n, leaf AS node FROM l), {_levels('d', D)},
    r0_nodes AS (SELECT '' AS tree, row_number() OVER (ORDER BY tree) - 1 AS pos, count(*) OVER () AS n, node FROM d{D}_nodes), {_levels('r', L)},
    place AS (SELECT tree, node, row_number() OVER (ORDER BY tree) - 1 AS nth FROM d{D}_nodes),
    q0 AS MATERIALIZED (
        SELECT l.doc_id, l.leaf, place.node AS subroot, sha256({proof}) AS proof_sha256, l.trial AS f0,
               [{alone}] AS alone, [{listed['before']}] AS befores, [{listed['behind']}] AS behinds
        FROM l JOIN place ON place.tree = l.tree {_steps('d', D, 'l.pos', 'l.tree')} {_steps('r', L, 'place.nth', "''")}),
    {', '.join(steps)}
    SELECT doc_id, leaf, subroot, r{L}_nodes.node AS root, proof_sha256, {last} AS folded_root, {last} = r{L}_nodes.node AS verified
    FROM q{len(nodes)}, r{L}_nodes"""


@query("documents", _merkle_sql())
def op11_merkle_manifest(documents: DataFrame) -> DataFrame:
    return merkle.manifest(documents)


@query("documents")
def op12_periodic_runs(documents: DataFrame) -> DataFrame:
    return runs.digested(runs.periodic_runs(runs.with_planted_runs(documents)))


def _escaped(text: str) -> str:
    out = f"replace({text}, '\\', '\\\\')"
    for control in chat.TURNS.controls:
        out = f"replace({out}, '{control}', '{control[0]}\\{control[1:]}')"
    return out


def _opening() -> str:
    named = f"replace({_escaped('role')}, '{chat.TURNS.other[1]}', '{chat.TURNS.other[1][0]}\\{chat.TURNS.other[1][1:]}')"
    known = " ".join(f"WHEN role = '{r}' THEN '{o}'" for r, o in chat.TURNS.openings.items())
    return f"CASE {known} ELSE '{chat.TURNS.other[0]}' || {named} || '{chat.TURNS.other[1]}' END"


_MOVES = " ".join(f"WHEN (before = '{s}' AND role = '{r}') THEN true" for s, r in [
    ("", "system"), ("", "user"), ("system", "user"), ("user", "assistant"), ("assistant", "user")])


@query("conversations", f"""
    WITH t AS (
        SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
        UNION ALL SELECT -7, 0, 'user', '\\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\\### Assistant: </turn> ok'),
    o AS (SELECT *, coalesce(lag(role) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text), '') AS before FROM t)
    SELECT conv_id, count(*) AS n_turns,
           sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
           coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
           sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
           sum(length({_opening()}) + length({_escaped('text')}) + {len(chat.TURNS.end)})::BIGINT AS formatted_chars,
           bool_and(CASE {_MOVES} ELSE false END) AS in_order,
           bool_and(CASE {_MOVES} ELSE false END) AND arg_max(role, (coalesce(turn, -1), role, text)) = 'assistant' AS complete
    FROM o GROUP BY conv_id""")
def op13_chat_formatting(conversations: DataFrame) -> DataFrame:
    written = stage(chat.formatted(chat.with_hard_case(conversations)), "chats")
    return chat.digested(written)
