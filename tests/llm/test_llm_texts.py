"""Archives, language, quality and the pipeline: round trips, brute force and held-out accuracy."""

import hashlib
import io
import itertools

import corpus_pipeline
import numpy as np
import pyarrow as pa
import pytest
import zstandard
from odd import CLASHING, ODD, documents, prose
from pyspark.sql import functions as F

from dayledger.llm import language, quality, warc

SF = "/root/testdata/sf0.01"


def pages(spark, rows):
    data = [(i, url, html, *[None] * len(CLASHING)) for i, url, html in rows]
    return spark.createDataFrame(data, "page_id long, url string, html string, " + ", ".join(f"{c} string" for c in CLASHING)).repartition(2)


LARGE = "<p>é " + "x" * 1200
PAGES = [
    (1, "http://a/ b\r\nc", LARGE), (5, None, LARGE), (3, "http://a", LARGE), (2, "u", None), (4, "u", ""), (6, "u", "short"), (7, "u", "short"),
    (None, "u", LARGE), (None, None, None), (8, "u", "y" * 999), (9, "u", "y" * 999), (10, "u", "z" * 1000), (11, "u", "z" * 1000),
    (5, None, LARGE), (12, "u", "\r\n\r\n" * 400), (13, "é", prose(20_000, 4)),
]


def test_archives_of_odd_rows(spark):
    got = warc.archived(pages(spark, PAGES))
    want = []
    for i, _, html in PAGES:
        payload = (html or "").encode()
        last = max((j for j, _, h in PAGES if (h or "") == (html or "") and j is not None), default=None)
        refers = last if len(payload) >= 1000 and last != i else None
        want.append((i, len(payload), hashlib.sha1(payload).hexdigest(), "response" if refers is None else "revisit", refers))
    assert sorted((tuple(r)[:5] for r in got.collect()), key=str) == sorted(want, key=str)
    assert {r["url"] for r in got.where("page_id = 1").collect()} == {"http://a/%20b%0D%0Ac"}


def test_no_pages(spark):
    assert warc.archived(pages(spark, [])).count() == 0


def records(n=300):
    return [warc.record(i, "u", prose(60, i).encode(), hashlib.sha1(prose(60, i).encode()).hexdigest(), None, "2024-01-01T00:00:00Z") for i in range(n)]


def test_an_archive_has_a_dictionary_and_a_frame_per_record():
    data = warc.archive_bytes(records())
    assert int.from_bytes(data[:4], "little") == warc.DICTIONARY_FRAME
    found = list(warc.read_archive(io.BytesIO(data)))
    assert [r for _, r in found] == records()
    with pytest.raises(zstandard.ZstdError):  # the frames need it
        zstandard.ZstdDecompressor().decompressobj().decompress(data[found[0][0] :])
    # without one, with a compressed one, and with other skippable frames between
    plain = b"".join(zstandard.ZstdCompressor().compress(r) for r in records(3))
    assert [r for _, r in warc.read_archive(io.BytesIO(plain))] == records(3)
    size = int.from_bytes(data[4:8], "little")
    packed = zstandard.ZstdCompressor().compress(data[8 : 8 + size])
    head = data[:4] + len(packed).to_bytes(4, "little") + packed
    gap = (0x184D2A51).to_bytes(4, "little") + (100_000).to_bytes(4, "little") + b"\0" * 100_000
    assert [r for _, r in warc.read_archive(io.BytesIO(head + gap + data[8 + size :] + gap))] == records()
    assert list(warc.read_archive(io.BytesIO(b""))) == []


def test_damage_is_found():
    data = warc.archive_bytes(records())
    for bad in (data[:-10], data[:4000], data[:-200] + bytes([data[-200] ^ 1]) + data[-199:], data + b"xx"):
        with pytest.raises(warc.BadArchive):
            list(warc.read_archive(io.BytesIO(bad)))
    good = records(1)[0]
    assert warc.parse(good)["page_id"] == 0
    for a, b in ((b"WARC/1.1", b"WARC/9"), (b"Content-Length: ", b"Content-Length: 1"), (b"WARC-Date", b"X-Date"), (b"sha1:", b"md5:"), (b"response\r\nWARC-R", b"revisit\r\nWARC-R")):
        with pytest.raises(ValueError):
            warc.parse(good.replace(a, b, 1))
    with pytest.raises(ValueError):
        warc.parse(good[:-4] + b"!" + good[-4:])


def best_path(scores, penalty):
    """Viterbi by trying all labellings."""
    def value(path):
        return sum(s[k] for s, k in zip(scores, path, strict=True)) - penalty * sum(a != b for a, b in zip(path, path[1:], strict=False))
    return max(value(p) for p in itertools.product(range(scores.shape[1]), repeat=len(scores))), value


def test_viterbi_finds_the_best_labelling():
    rng = np.random.default_rng(4)
    scores = rng.normal(size=(9, 3)) * 2
    sizes = np.array([3, 0, 6, 1, 5])
    flat = rng.integers(0, 9, sizes.sum())
    labels = language.viterbi(scores, flat, sizes, 1.5)
    at = 0
    for n in sizes:
        if n:
            best, value = best_path(scores[flat[at : at + n]], 1.5)
            assert value(labels[at : at + n].tolist()) == pytest.approx(best)
        at += n


@pytest.fixture(scope="module")
def model(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    return language.learn(docs.where(language.in_training()))


def test_held_out_languages_are_found(spark, model):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where(~language.in_training())
    right = language.predict(docs, model).join(docs.select("doc_id", "lang"), "doc_id").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right > 0.97


def test_spans_of_a_mixed_text(spark, model):
    docs = {r["lang"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").where("n_chars > 2000 AND n_chars < 4000 AND lang IN ('en', 'de') AND text NOT LIKE '%!!%' AND text NOT LIKE '%&&%'").orderBy("doc_id").limit(40).collect()}
    en, de = docs["en"].split()[:150], docs["de"].split()[:100]
    _, share, spans = language.judge(pa.array([" ".join(en + de)]), model)
    assert [s[0] for s in spans[0]] == ["en", "de"] and abs(spans[0][0][2] - 150) <= 3 and 0.4 < share[0] < 0.75


def test_scripts_rule_languages_out(spark):
    rows = [(0, "привет мир это текст на русском языке", "ru"), (2, "hello world this is english text", "en"), (3, "καλημέρα κόσμε", "el")] * 3
    learned = language.learn(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    got, share, _ = language.judge(pa.array(["слово", "κόσμος", "world", "12 !! 3", "日本語", None]), learned)
    assert got[:4] == ["ru", "el", "en", "und"] and got[4] in ("ru", "el", "en") and got[5] == "und" and share[3] == 0


def test_languages_of_odd_rows(spark, model):
    got = language.predict(documents(spark), model, with_spans=True).collect()
    assert len(got) == len(ODD)
    for r in got:
        texts = [t or "" for i, t in ODD if i == r["doc_id"]]
        und = [not any(map(str.isalpha, t)) for t in texts]
        if len(set(und)) == 1:
            assert (r["lang_pred"] == "und") == und[0]
        assert 0 <= r["score"] <= 1 and sum(s["words"] for s in r["spans"]) >= 0
    assert language.predict(documents(spark, []), model).count() == 0
    none = language.learn(documents(spark, []))
    assert {r["lang_pred"] for r in language.predict(documents(spark), none).collect()} == {"und"}
    kept = language.with_language(documents(spark), model)
    assert kept.columns == documents(spark).columns and 2 not in {r["doc_id"] for r in kept.collect()}


def test_a_column_that_is_no_language_is_refused(spark):
    rows = [(i, f"text {i}", f"l{i}") for i in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    with pytest.raises(ValueError, match="more than 10 values"):
        language.learn(docs, language.Settings(languages=10))
    assert len(language.learn(docs, language.Settings(languages=12)).languages) == 12


def test_em_finds_the_accuracies_of_labellers():
    rng = np.random.default_rng(6)
    good = rng.random(20_000) < 0.85
    k = len(quality.LABELLERS)
    fires = rng.uniform(0.3, 0.7, k)
    votes = np.where(rng.random((len(good), k)) < np.where(good[:, None], 0.005, fires), 1, np.where(rng.random((len(good), k)) < np.where(good[:, None], 0.5, 0.05), 2, 0))
    patterns = {}
    for row in votes:
        name = "".join("_bg"[v] for v in row)
        patterns[name] = patterns.get(name, 0) + 1
    posterior, accuracy = quality.accuracies(patterns, quality.Settings())
    told = np.array([posterior["".join("_bg"[v] for v in row)] > 0.5 for row in votes])
    assert (told == good).mean() > 0.98
    for i, x in enumerate(quality.LABELLERS):
        cast = votes[:, i] == 1
        assert accuracy[x.name]["bad"] == pytest.approx((~good[cast]).mean(), abs=0.03)
    assert quality.accuracies({}, quality.Settings()) == ({}, {})


def test_quality_agrees_with_labels_it_never_saw(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    learned = quality.learn(docs)
    got = quality.judged(docs, learned).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id")
    rates = {r["quality"]: r["kept"] for r in got.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("kept")).collect()}
    assert rates[1] > 0.99 and rates[0] < 0.1
    odd = quality.judged(documents(spark), learned).collect()
    assert len(odd) == len(ODD) and all(0 <= r["score"] <= 1 and 0 <= r["weak_posterior"] <= 1 for r in odd)
    assert {r["score"] for r in odd if r["doc_id"] in (1, 2, 3, 17)} == {0.0}
    kept = quality.good_texts(documents(spark), learned)
    assert kept.columns == documents(spark).columns
    assert quality.judged(documents(spark, []), learned).count() == 0
    nothing = quality.learn(documents(spark, []))
    assert quality.judged(documents(spark), nothing).count() == len(ODD)


def test_the_pipeline_keeps_one_of_each_clean_document(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language", "quality", "exact_dedup", "near_dedup", "packing"]
    kept = docs
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for name, apply in corpus_pipeline.STAGES:
        before = {r["doc_id"] for r in kept.select("doc_id").collect()}
        kept = corpus_pipeline.stage(apply(spark, kept, SF), f"test-{name}")
        after = {r["doc_id"] for r in kept.select("doc_id").collect()}
        assert after <= before
        if name != "packing":
            assert kept.columns == docs.columns
        if name == "quality":
            clean = [i for i in before if labels.get(i) == 1]
            assert sum(i in after for i in clean) >= 0.99 * len(clean) and sum(i in after for i in before if labels.get(i) == 0) <= 6
        if name == "exact_dedup":
            groups = {}
            for i in before:
                groups.setdefault(texts[i].translate({c: c + 32 for c in range(65, 91)}), []).append(i)
            assert after == {max(g) for g in groups.values()}
        if name == "near_dedup":
            sets = {i: set(zip(*(texts[i].lower().split()[k:] for k in range(5)), strict=False)) for i in before}
            for gone in before - after:
                assert any(5 * len(sets[gone] & sets[i]) >= 4 * len(sets[gone] | sets[i]) - 2 for i in before - {gone})
        if name == "packing":
            assert after == before


CLEAN = {
    "Hindi": "भारत एक विशाल देश है। यहाँ अनेक भाषाएँ बोली जाती हैं और लोग मिलकर रहते हैं। सुबह बच्चे विद्यालय जाते हैं।",
    "Tamil": "தமிழ் மொழி மிகவும் பழமையானது. மக்கள் இதனை பல நாடுகளில் பேசுகிறார்கள். குழந்தைகள் பள்ளிக்குச் செல்கிறார்கள்.",
    "Thai": "ประเทศไทยเป็นประเทศที่สวยงาม ผู้คนใจดีและอาหารอร่อย เด็กไปโรงเรียนทุกวัน",
    "Chinese": "今天天气很好，我们去公园散步。孩子们在草地上玩耍，老人坐在树下聊天。 晚上，大家一起吃饭。",
    "Japanese": "今日は天気がいいので、公園へ行きました。「楽しいですね。」と母は言いました。 夜はみんなで夕食を食べました。",
    "Arabic": "ذهب الأولاد إلى المدرسة في الصباح، ثم عادوا إلى البيت. هل كان اليوم جميلاً؟ نعم، كان جميلاً.",
    "Persian": "او هر روز می‌رود و کتاب‌ها را می‌خواند. ما نیز می‌خوانیم.",
    "French": "Il m’a dit : « Bonjour, mon ami… » — puis il est parti. Nous étions “contents” de le voir – enfin – chez nous.",
}
JUNK = ["#$%& ^^^ {{}} || <<>> ~~~ $$$ *** ### ==+ %%% &^%$", "★☆★ ►►► ◄◄ ■□■ ☺☻ ♥♦♣ ▲▼ ○●○ €¥£ "]


def test_quality_takes_no_script_for_symbols(spark):
    statistics, _, _ = quality.word_statistics(pa.array([*CLEAN.values(), *JUNK]))
    bad = [[x.name for x in quality.LABELLERS if x.vote(statistics)[k] == quality.BAD] for k in range(len(CLEAN) + len(JUNK))]
    assert bad[: len(CLEAN)] == [[]] * len(CLEAN) and all({"symbols", "symbol_words", "odd_words"} <= set(b) for b in bad[len(CLEAN) :])
    phrases = " ".join(a + b + "ี่" for a in "กขคงจฉชซ" for b in "ดตถทธนบปผฝ")  # eighty, without a mark at the end of sentences
    hindi = " ".join(f"राम {'कखगघचछजझ'[i % 8]}{'तथदधनपफब'[i // 8 % 8]}ि घर जाता है।" for i in range(40))
    chinese = " ".join(f"我们第{i}天去了公园，看到了花。" for i in range(80))
    by_name = {x.name: x for x in quality.LABELLERS}
    long_texts, _, _ = quality.word_statistics(pa.array([phrases, hindi, chinese]))
    assert by_name["no_sentences"].vote(long_texts).tolist() == [quality.ABSTAIN, quality.GOOD, quality.GOOD]
    learned = quality.learn(spark.read.parquet(f"{SF}/documents.parquet"))
    kept = {r["doc_id"] for r in quality.judged(documents(spark, list(enumerate([*CLEAN.values(), *JUNK]))), learned).where("kept").collect()}
    assert kept == set(range(len(CLEAN)))


def test_short_texts_get_no_vote_on_sentences():
    # sixty words or fewer say nothing of sentences, whatever they are; sixty-one do
    short = [*JUNK, *CLEAN.values(), prose(60, 3), prose(5, 4)]
    statistics, _, _ = quality.word_statistics(pa.array([*short, prose(63, 3), prose(90, 5).replace(".", "")]))
    labeller = next(x for x in quality.LABELLERS if x.name == "no_sentences")
    assert labeller.vote(statistics).tolist() == [quality.ABSTAIN] * len(short) + [quality.GOOD, quality.BAD]
