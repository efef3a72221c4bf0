"""Row-wise operators against brute force, on odd and on given texts."""

import hashlib
import os
import random
import sys
import time
import zlib

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import brute  # noqa: E402

from taxaloom.llm import decontamination, langid, licenses, pii, sentencepiece_bpe  # noqa: E402
from taxaloom.llm.queries import QUERIES, model_file, table  # noqa: E402

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string"


@pytest.fixture(scope="module")
def documents(spark):
    if not os.path.isdir(SF):
        pytest.skip("test tables not there")
    return {r.doc_id: r for r in table(spark, SF, "documents").collect()}


# --- personal data -------------------------------------------------------------------------------

PRIVATE = [
    None,
    "",
    "a@b.c_x@d.e.f a@b a@b.c@d.e @x.y",
    "1.2.3.4.5.6.7.8 256.1.1.1 001.0002.255.0 1.2.3 1.2.3.4",
    "4111 1111 1111 1111, 4111-1111-1111-1112 411111111111111141111111 0000000000000",
    "+1 (578) 555-6437 4918187128635271 +49 30 1234567 +123 +1 234",
    "é😀 a.b@c.de 😀 10.0.0.1 +33 1 23 45 67 89",
    "x" * 3000 + "@" + "y.z" * 500,
    "1 " * 2000,
    "+" + "1" * 3000,
    " ".join(f"u{i}@h{i}.org" for i in range(200)),
]


def test_base_spans_equal_brute_force(spark):
    random.seed(4)
    alphabet = "0123456789 .-+()@ab%é"
    texts = PRIVATE + ["".join(random.choice(alphabet) for _ in range(random.randint(0, 80))) for _ in range(400)]
    df = spark.createDataFrame(list(enumerate(texts)), DOCS)
    found = {r.doc_id: r for r in pii.base_spans(df).select("doc_id", pii.joined(F.col("base")).alias("s"), "blanked").collect()}
    for i, text in enumerate(texts):
        spans = brute.base_spans(text)
        assert found[i].s == ",".join(f"{k}:{a}:{b}" for k, a, b in spans), text
        blanked = list(text or "")
        for _, a, b in spans:
            blanked[a:b] = "\x01" * (b - a)
        assert found[i].blanked == "".join(blanked)


def test_private_data_query(spark, documents):
    rows = QUERIES["op1_pii"](spark, SF).collect()
    assert sorted(r.doc_id for r in rows) == sorted(documents)
    for r in rows:
        spans = brute.base_spans(documents[r.doc_id].text)
        text = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        assert r.base_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[0] == k for s in spans) for k in brute.BASE]
        assert set(filter(None, text.split(","))) <= set(r.spans.split(","))


def test_model_finds_what_the_base_swallows_and_redacts(spark):
    good = ["so +1 (578) 555-64{:02d} now", "mail joe.{0}@mail{0}.example.com soon", "from 10.0.{0}.7 here", "card 4111 1111 1111 1111 {0}x"]
    bad = ["version 10.{0}.999.4 number 1234 5678 9012 3456 no", "part 123456789012{:02d}45 of 12-34", "serial +12 345"]
    rows = [(i, form.format(i % 90)) for i, form in enumerate((good + bad) * 60)]
    docs = spark.createDataFrame(rows, DOCS)
    model = pii.fit(docs)
    assert model.thresholds
    probe = [
        (0, "thus +1 (578) 555-6437 4111111111111111 end", "x"),
        (1, "plain text without anything, 12 of 34", "y"),
        (2, None, "z"),
        (3, "a@b.de", "w"),
    ]
    df = spark.createDataFrame(probe, DOCS + ", base string")
    out = {r.doc_id: r for r in pii.redact(df.withColumnRenamed("base", "note"), model).collect()}
    assert "4111111111111111" not in out[0].text and "555-6437" not in out[0].text
    assert out[1].text == probe[1][1] and out[2].text is None and out[3].text == "<EMAIL>"
    assert out[0].note == "x"


def test_every_text_is_learned_from(spark, monkeypatch):
    """Candidates of all rows are counted, however many there are; equal ones are one row."""
    seen = []
    real = pii.stage
    monkeypatch.setattr(pii, "stage", lambda df, tag: seen.append(real(df, tag)) or seen[-1])
    docs = spark.range(25_000).selectExpr("id AS doc_id", "if(id = 24999, 'from 10.0.0.7 or 10.0.0.999', 'mail joe@mail.example.com') AS text")
    pii.fit(docs)
    weights = {r.kind: (r.n, r.rows) for r in seen[-1].groupBy("kind").agg(F.sum("weight").alias("n"), F.count("*").alias("rows")).collect()}
    # an address as it is, in another format, with numbers around it, and corrupted
    assert weights[0] == (4 * 24_999, 4) and weights[1][0] > 4


def test_private_data_of_empty_and_unfit_tables(spark):
    empty = spark.createDataFrame([], DOCS)
    assert pii.find(empty, pii.fit(empty)).count() == 0
    plain = spark.createDataFrame([(1, "no data"), (1, "no data"), (None, None)], DOCS)
    assert [r.spans for r in pii.find(plain, pii.fit(plain)).collect()] == [[], [], []]


# --- sentencepiece -------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=model_file())


def test_tokens_equal_the_library(spark, library):
    random.seed(2)
    alphabet = " ▁abcdeté日\n.<>0x4s/😀"
    texts = [None, "", " ", "  a  b   ", "▁x▁▁y", "a▁", " \n\t x", "日本語 テスト", "x" * 3000, " " * 200, "a\x00b", "</s><unk><0x41>"]
    texts += ["".join(random.choice(alphabet) for _ in range(random.randint(0, 60))) for _ in range(300)]
    df = spark.createDataFrame([(i, t, "kept") for i, t in enumerate(texts)], DOCS + ", ids string")
    out = {r.doc_id: r for r in sentencepiece_bpe.encode_decode(df.withColumnRenamed("ids", "note"), model_file()).collect()}
    for i, text in enumerate(texts):
        want = library.encode(text or "")
        assert out[i].ids == want and out[i].n_tokens == len(want) and out[i].decoded == library.decode(want), text
        assert out[i].note == "kept"


def test_token_query(spark, documents, library):
    rows = QUERIES["op3_sentencepiece"](spark, SF).collect()
    assert sorted(r.doc_id for r in rows) == sorted(documents)
    for r in rows:
        ids = library.encode(documents[r.doc_id].text or "")
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_generations_of_chunks(library, monkeypatch):
    """Chunks that are met again stay, the others of an old generation go, and ids stay those of the library."""
    monkeypatch.setattr(sentencepiece_bpe, "CACHE_CHUNKS", 50)
    coder = sentencepiece_bpe.Coder(model_file())
    rng = random.Random(21)
    words = [f"wörd{i}" for i in range(400)] + ["日本\u3000x", "\x00\x01", "▁", "a▁b", "tab\tx"]
    learnt = []
    monkeypatch.setattr(coder, "learn", lambda new, learn=coder.learn: (learnt.append(len(new)), learn(new))[1])
    for k in range(12):
        texts = ["often " + " ".join(rng.choice(words[k * 30 :]) for _ in range(20)) + rng.choice(["", " ", "  "]) for _ in range(5)] + ["", None, "  x  "]
        for text, (ids, back) in zip(texts, coder.code(texts), strict=True):
            want = library.encode(text or "")
            assert ids == ",".join(map(str, want)) and back == library.decode(want)
        assert "often" in coder.young and len(coder.young) <= 50 + 150 and len(coder.old) <= 50 + 150
        assert all(c in coder.young or c in coder.old for c in coder.odd)
    assert sum(learnt) < 12 * 105 and len(learnt) > 5


def test_long_chunks_and_heap_agree(library):
    own = sentencepiece_bpe.Vocabulary(model_file())
    random.seed(3)
    chunks = ["▁" + "".join(random.choice("aeinrst") for _ in range(random.randint(1, 40))) for _ in range(500)]
    assert own.encode_short(chunks) == [own.encode_chunk(c) for c in chunks] == [library.encode(c[1:]) for c in chunks]


# --- decontamination -----------------------------------------------------------------------------


def test_hits_equal_brute_force(spark):
    random.seed(5)
    vocabulary = ["ab", "Cd", "é", "x1", "q"]
    sentence = lambda n: " ".join(random.choice(vocabulary) for _ in range(n))
    items = [(i, sentence(random.choice([1, 3, 5, 14, 20]))) for i in range(12)] + [(12, ""), (13, None), (3, sentence(15))]
    texts = [sentence(random.randint(0, 60)) for _ in range(120)] + [None, "", "!!", items[3][1] + "; " + items[5][1]]
    docs = spark.createDataFrame([(i, t, 7) for i, t in enumerate(texts)], DOCS + ", n_words int")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    for group_words in (200_000, 20):
        out = decontamination.scan(docs, benchmark, window=4, group_words=group_words)
        for r in out.withColumn("hits", decontamination.n_hit()).collect():
            n, hit, found = brute.contamination(texts[r.doc_id], items, 4)
            assert (r.n_words, r.hits, r.hit_items) == (n, len(hit), sorted(map(str, found)))


def test_items_of_one_repeated_word_are_linear():
    start = time.process_time()
    for items in ([(1, [b"a"] * 50_000)], [(1, [b"a", b"b"] * 25_000), (2, [b"a"] * 5)]):
        automaton = decontamination.ItemAutomaton(items)
        for tokens in ([b"a"] * 50_000, [b"a", b"b"] * 25_000, [b"x"] + [b"b", b"a"] * 10):
            text = b" ".join(tokens).decode()
            if len(tokens) < 100:
                _, hit, found = brute.contamination(text, [(i, b" ".join(w).decode()) for i, w in items])
                spans, names = automaton.scan(tokens)
                assert sum(b - a for a, b in spans) == len(hit) and names == found
            else:
                automaton.scan(tokens)
    assert time.process_time() - start < 5


def test_ten_groups_give_the_rows_of_one(spark):
    rng = random.Random(12)
    words_ = [f"w{i}" for i in range(12)]
    items = [(i, " ".join(rng.choice(words_) for _ in range(rng.randint(1, 12)))) for i in range(60)]
    texts = [" ".join(rng.choice(words_) for _ in range(rng.randint(0, 80))) for _ in range(100)] + [None, None, "w1", "w1"]
    docs = spark.createDataFrame([(i % 50, t, "r") for i, t in enumerate(texts)], DOCS + ", row_ string")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    one = decontamination.scan(docs, benchmark, window=4)
    ten = decontamination.scan(docs, benchmark, window=4, group_words=40)
    assert sorted(map(str, one.collect())) == sorted(map(str, ten.collect())) and ten.columns == one.columns
    assert ten._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 1


def test_empty_benchmark_and_documents(spark):
    docs, none = spark.createDataFrame([(1, "a b")], DOCS), spark.createDataFrame([], "item_id long, text string")
    assert decontamination.scan(docs, none).first().hit_spans == []
    assert decontamination.scan(docs.limit(0), none).count() == 0


def test_cut_spans(spark):
    item = "one two three four five six seven eight nine ten eleven twelve thirteen"
    docs = spark.createDataFrame([(1, f"Before: {item.title()}! After é."), (2, "clean"), (3, None)], DOCS)
    scanned = decontamination.scan(docs, spark.createDataFrame([(1, item)], "item_id long, text string"))
    out = {r.doc_id: r.text for r in decontamination.cut_spans(scanned).collect()}
    assert out == {1: "Before: ! After é.", 2: "clean", 3: None}


# --- languages -----------------------------------------------------------------------------------


def phrases(text, sample):
    """Greedy phrases of a text against a sample."""
    n = at = 0
    while at < len(text):
        end = at
        while end < len(text) and text[at : end + 1] in sample:
            end += 1
        n, at = n + 1, max(end, at + 1)
    return n


def test_phrases_equal_brute_force():
    random.seed(6)
    samples = {"aa": "the cat sat on the mat and the dog", "bb": "der hund und die katze auf der matte"}
    parser = langid.Parser(samples)
    plain = {k: " " + s + " " for k, s in samples.items()}
    texts = ["".join(random.choice("abcdehimnortu sz") for _ in range(random.randint(1, 60))) + "k" for _ in range(200)]
    sizes, counts = parser.phrases(texts)
    for i, text in enumerate(texts):
        spaced = " " + " ".join(text.split()) + " "
        assert sizes[i] == len(spaced)
        assert counts[i].tolist() == [phrases(spaced, plain["aa"]), phrases(spaced, plain["bb"])]


def test_phrases_of_long_texts_are_one_parse():
    """Long texts go on alone when the others have ended; no phrase is cut."""
    rng = random.Random(16)
    samples = {"aa": "the cat sat on the mat and the dog" * 3, "bb": "der hund und die katze auf der matte", "cc": "日本 " + "xyz"}
    parser = langid.Parser(samples)
    plain = {k: " " + s + " " for k, s in samples.items()}
    words = "the cat sat on mat and dog der hund die katze auf matte 日 本日 x".split()
    long = " ".join(rng.choice(words) for _ in range(25_000))
    texts = [" ".join(rng.choice(words) for _ in range(rng.randint(1, 30))) for _ in range(150)] + [long, long[:9_000], "the " * 5_000]
    assert len(long) > 80_000
    for part in (texts, texts[-3:]):
        sizes, counts = parser.phrases(part)
        for i, text in enumerate(part):
            spaced = f" {text.strip()} "
            assert sizes[i] == len(spaced) and counts[i].tolist() == [phrases(spaced, plain[k]) for k in samples]


def test_too_many_languages(spark):
    rows = [(i, "text", f"l{i}") for i in range(langid.MOST_LANGUAGES * 2)]
    with pytest.raises(ValueError, match="different languages"):
        langid.labelled_sample(spark.createDataFrame(rows, DOCS + ", lang string"))


def test_letters_of_large_alphabets_are_told_apart():
    random.seed(7)
    blocks = {"han": (0x4E00, 3000), "hangul": (0xAC00, 2000), "kyr": (0x430, 32), "lat": (0x61, 26), "other": (0x4E00, 3000)}
    texts, samples = {}, {}
    for lang, (start, n) in blocks.items():
        words = ["".join(chr(start + random.randrange(n)) for _ in range(random.randint(2, 5))) for _ in range(400)]
        samples[lang] = " ".join(random.choice(words) for _ in range(2_000))
        texts[lang] = [" ".join(random.choice(words) for _ in range(20)) for _ in range(10)]
    parser = langid.Parser(samples)
    for lang, own in texts.items():
        langs, scores, _ = parser.predict(own)
        assert langs == [lang] * len(own) and min(scores) > 0.2
    mixed = [" ".join(random.choice(random.choice(list(texts.values()))).split()[:3]) + "\u4e00\u3042x" for _ in range(40)]
    _, counts = parser.phrases(mixed)
    for i, text in enumerate(mixed):
        assert counts[i].tolist() == [phrases(f" {text} ", f" {samples[lang]} ") for lang in parser.languages]


def test_sample_of_all_parts_of_many_rows(spark):
    rows = [(i, "".join(chr(97 + k // 1_000) for k in range(20_000)), "xx") for i in range(300)]
    docs = spark.createDataFrame(rows, DOCS + ", lang string")
    sample = langid.labelled_sample(docs)["xx"]
    assert 59_000 <= len(sample) <= 60_000 and len(set(sample)) > 15 and len(sample.split()) > 150
    assert langid._shared(["abc", "d", "efgh"], 100) == "abc d efgh" and langid._shared(["abc", "d", "efgh"], 7) == "ab d ef"


def test_language_stage_without_labels(spark):
    import corpus_pipeline

    docs = spark.createDataFrame([(1, "text", None), (2, "12 !", None), (3, None, None), (4, "日本", None)], DOCS + ", lang string")
    assert sorted(r.doc_id for r in corpus_pipeline.known_languages(spark, docs, SF).collect()) == [1, 4]


def test_language_stage_keeps_wanted_languages(spark):
    import corpus_pipeline

    rows = [(i, "the cat and the dog", "en", i) for i in range(30)] + [(30 + i, "der hund und die katze", "de", i) for i in range(30)]
    rows += [(60, "die katze und der hund", None, 1), (61, "the dog", None, 2), (62, "12", "en", 3), (63, None, "de", None)]
    docs = spark.createDataFrame(rows, DOCS + ", lang string, score int")
    every = {r.doc_id: r.lang for r in corpus_pipeline.known_languages(spark, docs, SF).collect()}
    assert sorted(every) == list(range(62)) and every[60] == "de" and every[61] == "en" and every[3] == "en"
    wanted = corpus_pipeline.known_languages(spark, docs, SF, keep=["de"])
    assert wanted.columns == docs.columns and sorted(r.doc_id for r in wanted.collect()) == list(range(30, 61))
    assert corpus_pipeline.known_languages(spark, docs, SF, least_score=1.01).count() == 0


def test_languages_of_held_out_rows(spark, documents):
    rows = QUERIES["op8_language"](spark, SF).collect()
    assert sorted(r.doc_id for r in rows) == sorted(documents)
    held = [r for r in rows if r.held_out]
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1
    assert sum(r.lang_pred == documents[r.doc_id].lang for r in held) / len(held) > 0.95


def test_language_of_odd_texts(spark):
    rows = [(i, "the cat and the dog", "en") for i in range(30)] + [(30 + i, "der hund und die katze", "de") for i in range(30)]
    odd = [(60, None, "en"), (61, "", None), (62, "12 !?", "de"), (63, "日本", "en"), (64, "the " * 40_000, None), (64, "die katze", None), (None, "und", "de")]
    docs = spark.createDataFrame(rows + odd, DOCS + ", lang string")
    out = langid.identify(docs, langid.labelled_sample(docs)).collect()
    assert len(out) == len(rows + odd)
    found = {(r.doc_id, r.text): r.lang_pred for r in out}
    assert [found[i, t] for i, t, _ in odd[:3]] == ["und"] * 3
    assert found[64, odd[4][1]] == "en" and found[64, "die katze"] == "de" and found[63, "日本"] in ("de", "en")
    none = docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in langid.identify(none, langid.labelled_sample(none)).collect()} == {"und"}
    assert langid.identify(docs.limit(0), {}).count() == 0


# --- licenses ------------------------------------------------------------------------------------


def test_licenses(spark):
    mit = next(t for name, t in licenses.KNOWN if name == "MIT" and len(t) > 300)
    rows = [
        (1, "Copyright (c) 2020 Someone\n" + mit.upper().replace("SUBLICENSE", "SUBLICENCE")),
        (2, "text\nReleased under the MIT licence!\nAll rights reserved.\n"),
        (3, "text released under the MIT License."),
        (4, None),
        (5, ""),
        (None, "All rights reserved."),
        (2, "Licensed under CC0 1.0"),
    ]
    out = {r.doc_id: r for r in licenses.scan(spark.createDataFrame(rows, DOCS)).collect()}
    assert (out[1].license, out[1].n_lines) == ("MIT", 1)
    assert (out[2].license, out[2].line_licenses, out[2].n_lines) == ("CC0-1.0", "CC0-1.0,MIT,reserved", 3)
    assert out[None].license == "reserved"
    assert all((out[i].license, out[i].line_licenses) == (None, "") for i in (3, 4, 5))
    assert licenses.scan(spark.createDataFrame([], DOCS)).count() == 0


def test_wrapped_license_texts(spark):
    import textwrap

    rows, want = [], []
    for name, text in licenses.full_texts():
        for width in (72, 60):
            # texts that state a copyright of their own are published with these line breaks
            own = name.startswith(("GPL", "LGPL"))
            parts = [text] if own else ["\n".join(textwrap.wrap(p, width)) for p in text.split("\n\n")]
            first = [textwrap.fill(t, width) for t in licenses.TITLES.get(name, [])[:1]]
            rows.append((len(rows), "\n\n".join([] if own else ["Copyright (c) 2020, Some Holder", "Copyright Other Holder"]) + "\n\n" + "\n\n".join(parts)))
            want.append(name)
            if first and not text.startswith(tuple(licenses.TITLES[name])):
                rows.append((len(rows), "\r\n".join([*first, "", "Copyright 2020 Holder", "", *parts])))
                want.append(name)
    rows.append((len(rows), "Copyright notice and this permission notice"))
    out = {r.doc_id: r.license for r in licenses.scan(spark.createDataFrame(rows, DOCS)).collect()}
    assert [out[i] for i in range(len(want))] == want and out[len(want)] is None
    assert {"Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "MPL-2.0", "Unlicense"} <= set(want)
