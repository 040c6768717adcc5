"""Operators on single texts against plain versions and the tokenizer libraries."""

import hashlib
import itertools
import random
import re
import time
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from crosslex.llm import (
    common, decontamination, html_parse, language_id, license_rules, licenses, pieces, sharding,
    token_counts, token_files, unigram)
from crosslex.sources import workspace

SF = "/root/testdata/sf0.001"
MODEL = public_tokenizers.path("piece_bpe_32k.model")
WORD_MODEL = public_tokenizers.path("word_bpe_49k.json")

#: Nulls, empty and blank texts, repeated rows, a long text; columns with clashing names.
ODD = [
    (1, None, "x"), (2, "", "x"), (3, "  \n\t ", "x"), (4, "The end.", "x"), (4, "The end.", "x"),
    (None, "The end.", "x"), (5, "word " * 30_000, "x"), (6, "naïve ▁ 漢字 😀  two", None),
    (7, "x" * 20_000, "x"),
]
CLASH = ["id", "n", "cls", "size", "shard", "found", "base", "spans", "items", "language",
         "contamination", "component"]


@pytest.fixture(scope="module")
def odd(spark):
    frame = spark.createDataFrame(ODD, "doc_id long, text string, lang string")
    return frame.withColumn("source", F.lit("s")).withColumns({c: F.lit("?") for c in CLASH})


@pytest.fixture(scope="module")
def empty(odd):
    return odd.where("false")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def random_texts(n, seed=1, letters="abct  eh\n\t▁éß漢字😀<s></s>.,0'!"):
    rng = random.Random(seed)
    return ["".join(rng.choice(letters) for _ in range(rng.randint(0, 30))) for _ in range(n)]


# --- token counts ------------------------------------------------------------

@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def test_counts_are_the_librarys(library):
    counter = token_counts.Counter(pieces.load(MODEL))
    for text in random_texts(3_000):
        assert counter.count(text) == len(library.encode(text)), repr(text)


def test_token_counts(docs, odd, empty, library):
    for frame in (docs, odd):
        got = sorted(token_counts.token_counts(frame, MODEL).collect(), key=str)
        texts = [(r["doc_id"], r["text"] or "") for r in frame.collect()]
        want = sorted(((i, len(t.encode()), n := len(library.encode(t)), n > 4096)
                       for i, t in texts), key=str)
        assert sorted(map(tuple, got), key=str) == want
    assert token_counts.token_counts(empty, MODEL).count() == 0


def test_memo_is_bounded():
    memo = common.Memo(len, limit=10, longest=5)
    for i in range(1_000):
        assert memo[str(i)] == len(str(i))
    assert memo["longer than five"] == 16
    assert len(memo) <= 10 and len(memo.older) <= 10 and "longer than five" not in memo


# --- unigram -----------------------------------------------------------------

@pytest.fixture(scope="module")
def unigram_model(tmp_path_factory):
    """The pieces as a unigram model for the library, with scores it can add exactly."""
    from sentencepiece import sentencepiece_model_pb2

    model = sentencepiece_model_pb2.ModelProto()
    with open(MODEL, "rb") as file:
        model.ParseFromString(file.read())
    model.trainer_spec.model_type = 1
    for piece in model.pieces:
        piece.score = max(piece.score, -40_000.0)
    path = tmp_path_factory.mktemp("model") / "unigram.model"
    path.write_bytes(model.SerializeToString())
    return str(path)


def test_unigram_is_the_librarys(unigram_model):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=unigram_model)
    loaded = pieces.load(unigram_model)
    encoder = unigram.Encoder(loaded, unigram.Trie(
        {t.encode(): i for t, i in loaded.normal.items()}))
    for text in random_texts(3_000):
        if "▁" not in text:
            ids = encoder.encode(text).tolist()
            assert ids == library.encode(text), repr(text)
            assert encoder.decode(ids) == text


def test_unigram_takes_many_texts_at_once(unigram_model):
    """Texts of a slice are those of the library each, and new words take little time."""
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=unigram_model)
    loaded = pieces.load(unigram_model)
    encoder = unigram.Encoder(loaded, unigram.Trie(
        {t.encode(): i for t, i in loaded.normal.items()}))
    texts = ["", "\n", " ", "the" * 500, "x" * 5_000, "漢字" * 300, "é" * 64 + "a\0b" * 50, "a\n\na  b",
             *(t for t in random_texts(500) if "▁" not in t)]
    ids, begins = encoder.ids_of(pa.array(["left out", *texts])[1:])
    spelled = encoder.texts_of(ids, begins).to_pylist()
    for text, start, stop, again in zip(texts, begins, begins[1:], spelled):
        assert ids[start:stop].tolist() == library.encode(text), repr(text)
        assert again.removeprefix(" ") == text
    rng = random.Random(3)
    words = pa.array([" ".join("".join(rng.choices("etaoinshr", k=12)) for _ in range(100_000))])
    start = time.process_time()
    encoder.ids_of(words)
    assert time.process_time() - start < 2.5


def test_trie_finds_every_key():
    rng = random.Random(4)
    keys = {bytes(rng.choices(range(256), k=rng.randint(1, 6))): i for i in range(2_000)}
    trie = unigram.Trie(keys)

    def value(key):
        node = 0
        for byte in key:
            to = trie.base[node] + byte
            if trie.check[to] != node:
                return -1
            node = to
        return trie.value[node]

    assert all(value(k) == i for k, i in keys.items())
    assert all(value(k[:-1] + b"\0\0") == keys.get(k[:-1] + b"\0\0", -1) for k in keys)


def test_encode_and_decode(docs, odd, empty):
    coded = unigram.encode(docs, MODEL)
    assert coded.where("not restored").count() == 0
    back = unigram.decode(coded, MODEL).join(
        docs.withColumnRenamed("text", "was"), "doc_id")
    assert back.where("text != was").count() == 0
    rows = {(r["doc_id"], r["n_tokens"]): r["restored"] for r in unigram.encode(odd, MODEL).collect()}
    assert rows[(1, 0)] and rows[(2, 0)] and len(rows) == 8  # the repeated row is one key here
    assert [v for (i, _), v in rows.items() if i == 6] == [False]  # a marker in the text
    assert unigram.encode(empty, MODEL).count() == 0
    ids = odd.limit(1).select("doc_id", F.lit(None).cast("array<int>").alias("ids"))
    assert unigram.decode(ids, MODEL).first()["text"] is None


# --- token files -------------------------------------------------------------

@pytest.mark.parametrize("top", [1, 2, 100, 49_408, 1 << 32, 1 << 60, (1 << 64) - 1])
@pytest.mark.parametrize("n", [0, 1, 59, 61, 5_000])
def test_pack_round_trip(n, top):
    ids = np.random.default_rng(n).integers(0, top, n, dtype=np.uint64)
    ids[::3] = 0
    words, escapes = token_files.pack(ids)
    assert (token_files.unpack(words, escapes, n) == ids).all()
    if top <= 1 << 60:
        assert len(escapes) == 0


def test_ids_are_the_librarys():
    encoder = token_files.Encoder(**{k: tuple(v) if k == "specials" else v for k, v in
                                     token_files._model(WORD_MODEL).items()})
    extra = ["<|endoftext|>", "'ll", "é", "é", "\xa0", "İ", "ſ", "\x1c", "A"]
    rng = random.Random(2)
    for text in random_texts(2_000):
        text += "".join(rng.choices(extra, k=3)) + text[:4]
        assert encoder.ids(text).tolist() == encoder.library.encode(
            text, add_special_tokens=False).ids, repr(text)


def test_ids_of_many_stretches():
    """New stretches of known words and signs are put together without a look at each by itself."""
    encoder = token_files.Encoder(**{k: tuple(v) if k == "specials" else v for k, v in
                                     token_files._model(WORD_MODEL).items()})
    rng = random.Random(6)
    words = ["".join(rng.choices("aeioubdklmnrst", k=rng.randint(1, 9))) for _ in range(2_000)]
    ends = ["".join(rng.choices(token_files.SIGNS, k=rng.randint(0, 3))) for _ in range(300)]
    made = [word + end for word in words for end in set(ends)]
    texts = [" ".join(made[i::400]) for i in range(400)]
    start = time.process_time()
    found = encoder.ids_of(pa.array(texts))
    took = time.process_time() - start
    for n in range(0, 400, 100):
        assert found[n].tolist() == encoder.library.encode(texts[n], add_special_tokens=False).ids
    assert took < 1.5


def test_words_are_looked_up_together():
    """Known words take no step of Python each, what is held of them is bounded, and ids do not
    depend on what is held."""
    encoder = token_files.Encoder(**{k: tuple(v) if k == "specials" else v for k, v in
                                     token_files._model(WORD_MODEL).items()})
    rng = random.Random(7)
    words = list({"".join(rng.choices("aeioubdklmnrst", k=9)) for _ in range(100_000)})
    texts = pa.array([" ".join(words[i::50]) for i in range(50)])
    first = encoder.ids_of(texts)
    start = time.process_time()
    for _ in range(5):
        again = encoder.ids_of(texts)
    took = time.process_time() - start
    assert all((a == b).all() for a, b in zip(first, again))
    assert took < 1.2
    encoder.words = token_files.Words(limit=1_000, longest=8)
    for part in [*texts, pa.scalar(" ".join(w[:5] for w in words[:5_000]))]:
        found = encoder.ids(part.as_py())
        assert found.tolist() == encoder.library.encode(
            part.as_py(), add_special_tokens=False).ids
    held = [encoder.words.recent[0], encoder.words.older[0]]
    assert all(0 < len(own) <= 1_000 for own in held)
    assert all(len(word) <= 8 for own in held for word in own.to_pylist())


@pytest.mark.parametrize("frame", ["docs", "odd", "empty"])
def test_token_files(spark, request, frame):
    from tokenizers import Tokenizer

    given = request.getfixturevalue(frame)
    library = Tokenizer.from_file(WORD_MODEL)
    files = token_files.write_ids(given, WORD_MODEL, workspace.new_path(spark, "ids"), end_id=1)
    got = token_files.read_ids(spark, files, ids=True).collect()
    rows = sorted(((r["doc_id"], r["text"] or "") for r in given.collect()),
                  key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode()))
    want, start = [], 0
    for doc, text in rows:
        ids = [*library.encode(text, add_special_tokens=False).ids, 1]
        want.append((doc, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), ids))
        start += len(ids)
    key = lambda r: (r[1], str(r[0]))
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


# --- decontamination ---------------------------------------------------------

def plain_hits(words, items, window):
    hit, found = set(), set()
    for item, own in items:
        n = min(window, len(own))
        for a, p in itertools.product(range(len(own) - n + 1), range(len(words) - n + 1)):
            if n and words[p:p + n] == own[a:a + n]:
                hit |= set(range(p, p + n))
                found.add(item)
    return hit, found


def test_automaton():
    rng = random.Random(5)
    for _ in range(600):
        window, letters = rng.choice([2, 3, 4]), [b"a", b"b", b"c"][:rng.choice([2, 3])]
        items = [(i, rng.choices(letters, k=rng.randint(0, 8))) for i in range(rng.randint(1, 4))]
        words = rng.choices([*letters, b"x"], k=rng.randint(0, 20))
        spans, found = decontamination.Automaton(items, window).match(words)
        assert ({w for a, b in spans for w in range(a, b)}, found) == plain_hits(words, items, window)


def test_contamination_report(spark, docs):
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    own = [(r["item_id"], decontamination.words_of(r["text"])) for r in items.collect()]
    got = {r["doc_id"]: r for r in decontamination.contamination_report(docs, items).collect()}
    blocks = decontamination.contamination_report(docs, items, block_words=200)
    assert {r["doc_id"]: tuple(r) for r in blocks.collect()} == {i: tuple(r) for i, r in got.items()}
    for r in docs.collect():
        words = re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub(
            rb"[A-Z]", lambda m: m[0].lower(), r["text"].encode()))
        hit, found = plain_hits(words, own, 10)
        named = ",".join(sorted(map(str, found)))
        assert tuple(got[r["doc_id"]])[1:] == (
            len(words), len(hit), len(found), hashlib.sha256(named.encode()).hexdigest(), bool(hit))


def test_decontaminate(spark, odd, empty):
    items = spark.createDataFrame(
        [(1, "a b c d"), (2, None), (None, "q r s"), (3, "the end"), (3, "the end")],
        "item_id long, text string")
    docs = spark.createDataFrame(
        [(1, "x A, b c! d y z w v u"), (2, "a b c d"), (3, None), (4, "p q-r s t u v w")],
        "doc_id long, text string")
    cut = {r["doc_id"]: r["text"] for r in decontamination.decontaminate(docs, items, 3).collect()}
    assert cut == {1: "x  y z w v u", 3: None, 4: "p  t u v w"}  # the second was all passage
    report = decontamination.contamination_report(odd, items, 3).collect()
    assert len(report) == len(ODD) and sum(r["contaminated"] for r in report) == 3
    assert decontamination.contamination_report(empty, items).count() == 0
    none = decontamination.contamination_report(odd, items.where("false")).collect()
    assert not any(r["contaminated"] for r in none)
    kept = decontamination.decontaminate(odd, items, 3)
    assert kept.columns == [c for c in odd.columns if c != "contamination"]
    assert kept.count() == len(ODD) - 3


# --- licences ----------------------------------------------------------------

def plain_places(text, phrase):
    word = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    words = re.findall(word, re.sub("[A-Z]", lambda m: m[0].lower(), text))
    own = phrase.split(" ")
    return [i for i in range(len(words)) if words[i:i + len(own)] == own], len(words)


def test_license_base(docs, odd):
    extra = odd.sparkSession.createDataFrame([
        (90, "CC BY-SA 4.0. All  Rights--reserved! éall rights reserved all rights reservedé"),
        (91, "cc by cc-by\nGeneral Public\tLicense " * 400), (92, "Kc by; CC,BY"),
    ], "doc_id long, text string")
    frame = docs.select("doc_id", "text").unionByName(odd.select("doc_id", "text")).unionByName(extra)
    got = sorted(licenses.license_report(frame).drop("detections").collect(), key=str)
    want = []
    for doc, text in [(r["doc_id"], r["text"] or "") for r in frame.collect()]:
        found = {p: plain_places(text, p)[0] for p in license_rules.BASE}
        every = sorted(i for places in found.values() for i in places)
        want.append((doc, plain_places(text, "")[1], len(every), every[0] if every else None,
                     every[-1] if every else None,
                     ",".join(sorted(license_rules.BASE[p] for p, x in found.items() if x))))
    assert sorted((tuple(r)[:6] for r in got), key=str) == sorted(want, key=str)
    assert all(0 <= r["score"] <= 1 for r in got)


def test_license_overlaps(spark):
    text = ("Licensed under the Apache License, Version 2.0. MIT License. "
            "SPDX-License-Identifier: GPL-3.0-only; see the GNU General Public License v3.")
    [row] = licenses.license_report(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()
    assert [(d["label"], text[d["start"]:d["stop"]]) for d in row["detections"]] == [
        ("apache-2.0", "Licensed under the Apache License, Version 2.0"), ("mit", "MIT License"),
        ("gpl-3.0", "SPDX-License-Identifier: GPL-3.0-only"),
        ("gpl-3.0", "General Public License v3")]
    assert row["base_labels"] == "gpl" and row["labels"] == "apache-2.0,gpl,gpl-3.0,mit"


def matched_text(parsed, rng):
    """A text that a parsed pattern matches; line breaks between its words."""
    out = ""
    for op, value in parsed:
        op = str(op)
        if op == "LITERAL":
            out += chr(value)
        elif op == "IN":
            kind, what = value[0]
            # Of what is no word character a line break; of classes the first member.
            out += "\n" if str(kind) == "NEGATE" or str(what) == "CATEGORY_SPACE" else (
                "7" if str(kind) == "CATEGORY" else chr(what if isinstance(what, int) else what[0]))
        elif op == "ANY":
            out += "x"
        elif op == "BRANCH":
            out += matched_text(rng.choice(value[1]), rng)
        elif op == "SUBPATTERN":
            out += matched_text(value[3], rng)
        elif op.endswith("REPEAT"):
            low, high, inner = value
            for _ in range(rng.randint(low, min(int(high), low + 1))):
                out += matched_text(inner, rng)
        else:
            assert op.startswith("ASSERT") or op == "AT", op
    return out


def test_license_gates():
    """Whatever a rule's pattern matches opens the rule's gate."""
    rng = random.Random(6)
    for rule in license_rules.build():
        pattern = rule.pattern.replace(r"\x{10FFFF}", "\U0010ffff")
        seen = 0
        for _ in range(60):
            text = matched_text(re._parser.parse(pattern), rng)
            if found := re.search(pattern, text):
                seen += 1
                lowered = found[0].lower()
                assert rule.keyword in lowered and rule.also in lowered, (rule, text)
        assert seen, rule


def test_license_without_keywords(spark):
    """Names without the word licence, and notices whose lines are broken."""
    texts = {
        "Released under the GPLv3.": "gpl-3.0", "Distributed under GPL 3.0": "gpl-3.0",
        "It is Apache 2.0 all through": "apache-2.0", "available under the terms of the MIT": "mit",
        "THE SOFTWARE IS PROVIDED \"AS\nIS\", WITHOUT WARRANTY OF ANY KIND": "as-is",
        "Permission is hereby\ngranted, free of charge, to any person obtaining a copy": "mit-text",
        "Creative\nCommons Attribution 4.0": "cc-by-4.0", "in the public\n domain": "public-domain",
        "Redistribution\nand use in source and binary forms": "bsd-text", "see our terms\tof use": "terms",
        "no\nrights reserved": "cc0", "without written consent": "no-copying",
    }
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["labels"] for r in licenses.license_report(frame).collect()}
    assert [got[i] for i in range(len(texts))] == list(texts.values())


def test_license_scan_keeps_columns(odd, empty):
    seen = licenses.scan(odd)
    assert seen.columns == [*[c for c in odd.columns if c not in ("found", "base")], "found", "base"]
    assert licenses.license_report(empty).count() == 0


# --- shards ------------------------------------------------------------------

@pytest.mark.parametrize("frame", ["docs", "odd", "empty"])
def test_shards(request, frame):
    given = request.getfixturevalue(frame)
    rows = sorted(((r["doc_id"], len((r["text"] or "").encode()) + 8,
                    zlib.crc32((r["text"] or "").encode())) for r in given.collect()),
                  key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    total, end, want, count = sum(r[1] for r in rows), 0, [], {}
    for doc, size, crc in rows:
        end += size
        shard = min(4, (2 * end - size) * 5 // (2 * total))
        slot = count.get(shard, 0)
        count[shard] = slot + 1
        want.append((doc, size, crc, "bytes", shard, slot, None))
    got = sharding.shard_by_bytes(given, shards=5).collect()
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


# --- language ----------------------------------------------------------------

def test_language_held_out(docs):
    model = language_id.train(docs.where("doc_id % 2 = 0"))
    found = language_id.language_report(
        docs.where("doc_id % 2 = 1 and length(text) > 40"), model=model)
    right = found.agg(F.avg((F.col("by_text") == F.col("declared")).cast("int"))).first()[0]
    assert right >= 0.97


def test_language_fusion(spark, docs):
    """A wrong declaration gives way to the text; a short text to what its host holds."""
    model = language_id.train(docs)
    german = docs.where("lang = 'de'").limit(30).select("doc_id", "text", F.lit("en").alias("lang"))
    hosted = german.withColumn("source", F.lit("https://WWW.x.de:80/a")).unionByName(
        spark.createDataFrame([(-1, "qq", None, "http://www.x.de/b")],
                              "doc_id long, text string, lang string, source string"))
    found = {r["doc_id"]: r for r in language_id.language_report(hosted, model=model).collect()}
    assert {r["language"] for i, r in found.items()} == {"de"}
    kept = language_id.keep_identified(hosted, model=model, wanted=["fr"])
    assert kept.count() == 0 and kept.columns == hosted.columns


def test_language_odd(odd, empty, docs):
    model = language_id.train(docs)
    rows = language_id.language_report(odd, model=model).collect()
    assert len(rows) == len(ODD)
    assert all((r["language"] is None) == (r["n_trigrams"] == 0) for r in rows)
    assert not any(r["kept"] for r in rows if r["doc_id"] in (1, 2, 3))
    assert language_id.language_report(empty).count() == 0
    assert not any(r["kept"] for r in language_id.language_report(
        odd.withColumn("lang", F.lit(None).cast("string"))).collect())


def test_language_few_labelled(spark, docs):
    """Labels on few rows of a large table: among unlabelled rows, and beside common ones."""
    some = docs.where("length(text) > 40").groupBy("lang").agg(
        F.slice(F.collect_list("text"), 1, 10).alias("texts")).select(
        "lang", F.explode("texts").alias("text"))
    few = some.unionByName(spark.range(45_000).select(
        F.when(F.col("id") % 2 == 0, "").alias("lang"), F.lit("").alias("text")))
    model = language_id.train(few)
    assert model.languages == sorted(r["lang"] for r in docs.select("lang").distinct().collect())

    rare = [(i, "ugu xaxo bogu zuxi " * 5 + str(i), "xx", "s") for i in range(12)]
    table = spark.range(100, 15_100).select(
        F.col("id").alias("doc_id"), F.lit("the end of the story is here").alias("text"),
        F.lit("en").alias("lang"), F.lit("s").alias("source")).unionByName(
        spark.createDataFrame(rare, "doc_id long, text string, lang string, source string"))
    found = language_id.language_report(table).groupBy("declared", "language", "kept").count()
    assert sorted(map(tuple, found.collect())) == [("en", "en", True, 15_000), ("xx", "xx", True, 12)]


def test_language_many_labels(spark, monkeypatch):
    """A task hands over its counts where it has many languages; nothing is lost."""
    rows = [(f"{chr(97 + i)}{chr(98 + i)} " * 9, f"l{i}") for i in range(9)] * 4
    frame = spark.createDataFrame(rows, "text string, lang string").coalesce(1)
    once = language_id.train(frame)
    monkeypatch.setattr(language_id, "HELD_LANGUAGES", 2)
    again = language_id.train(frame)
    assert again.languages == once.languages and len(once.languages) == 9
    assert (again.logs == once.logs).all()


# --- pages -------------------------------------------------------------------

@pytest.mark.parametrize("html, text", [
    ("", ""), ("plain text", "plain text"), ("<p>a<p>b &amp; c&nbsp;d", "a b & c d"),
    ("<body><header>H</header><div id=main><p>x <b>y</b>z</p><ul><li>1<li>2</ul></div>"
     "<div class='comments'>c</div><footer>f</footer>", "x yz 1 2"),
    ("<form><article><p>q</p><aside>s</aside><div class='share-box'>t</div></article></form>"
     "<p>out</p>", "q"),
    ("<main><p>m</p><!-- x --><script>if(a<b){}</script></main>", "m"),
    ("<html><head><title>T</title><p>body</p>", "body"), ("<div>" * 5_000 + "deep", "deep"),
    ("<article><table><tr><td>a<td>b<tr><td>c</table></article>", "a b c"),
    ("a<br>b", "a b"), ("x < y and <3", "x < y and <3"),
    ("<article>1</article><section class=comments><article>2</article></section>", "1"),
    ("<div class='ad'>ad</div><p title='a>b'>t</p>", "t"), ("<p>open &lt;b&gt; <i>x", "open <b> x"),
])
def test_page_text(html, text):
    assert html_parse.parse(html).text == text


@pytest.mark.parametrize("names", [
    "content no-sidebar", "main has-header", "post-body hide-comments", "ad-free", "share-enabled"])
def test_page_compound_class(names):
    """A mark inside a compound class is none, in an article or without one."""
    wrapped = f"<div class='{names}'>running <p>text</p></div>"
    for page in (wrapped, f"<article>{wrapped}</article>", f"<div id='{names.split()[-1]}'>running <p>text</p></div>"):
        assert html_parse.parse(f"<body>{page}<div class='site-footer'>f</div></body>").text == "running text"


def test_page_marked_wrapper():
    """A marked wrapper stays where it holds most of the text as prose."""
    page = "<div class='related'><div class='widget'><p>{}</p></div></div><div>{}</div>"
    assert html_parse.parse(page.format("long text " * 9, "x")).text == "long text " * 9 + "x"
    assert html_parse.parse(page.format("more", "a text of its own")).text == "a text of its own"
    assert html_parse.parse("<div class='ad-300x250'>ad</div><ul id=main-menu><li>m</ul>t").text == "t"
