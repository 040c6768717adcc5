"""Operators that compare rows, and the pipeline, against plain versions."""

import collections
import itertools
import random
import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from crosslex.llm import (
    common, components, decontamination, embeddings, html_extract, html_parse, jaccard, queries)

SF = "/root/testdata/sf0.001"


class Union(dict):
    def root(self, x):
        while self.setdefault(x, x) != x:
            x = self[x]
        return x

    def join(self, a, b):
        a, b = self.root(a), self.root(b)
        self[max(a, b)] = min(a, b)


# --- components --------------------------------------------------------------

def test_components(spark):
    rng = random.Random(3)
    links = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(180)]
    links += [(i, i + 1) for i in range(1_000, 1_064)] + [(5, 5)] + links[:20]
    union = Union()
    for a, b in links:
        if a != b:
            union.join(a, b)
    made = components.components(spark.createDataFrame(links, "a long, b long"))
    assert {r["node"]: r["component"] for r in made.collect()} == {x: union.root(x) for x in list(union)}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- shared shingles ---------------------------------------------------------

def plain_links(rows, words, percent):
    sets = {}
    for doc, text in rows:
        own = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets[doc] = {tuple(own[i:i + words]) for i in range(max(1, len(own) - words + 1))} if own else set()
    by, common, union = collections.defaultdict(list), collections.Counter(), Union()
    for doc, own in sets.items():
        for shingle in own:
            by[shingle].append(doc)
    for holders in by.values():
        common.update(itertools.combinations(holders, 2))
    for (a, b), n in common.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            union.join(a, b)
    return {doc: (len(own), union.root(doc)) for doc, own in sets.items()}


def joined(frame, words, percent):
    return {r["doc_id"]: tuple(r)[1:] for r in jaccard.linked(frame, words, percent).collect()}


@pytest.mark.parametrize("words, percent", [(3, 90), (5, 80)])
def test_links_of_documents(spark, words, percent):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert joined(docs, words, percent) == plain_links(rows, words, percent)


def test_links_of_varied_copies(spark):
    """Groups whose members differ more and more: chains, members that do not meet the first."""
    rng = random.Random(7)
    rows, doc = [], 0
    for size in (1, 2, 5, 12, 40, 150, 400):
        base = [f"w{rng.randint(0, 900)}" for _ in range(size)]
        for _ in range(14):
            rows.append((doc, " ".join(base)))
            doc += 1
            base = list(base)
            for _ in range(max(1, size // 60)):
                base[rng.randrange(len(base))] = f"n{rng.randint(0, 10_000)}"
            if rng.random() < 0.3 and len(base) > 2:
                base = base[:-1]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    for words, percent in ((2, 80), (1, 60)):
        assert joined(frame, words, percent) == plain_links(rows, words, percent)


def test_pieces_never_lose_a_pair():
    """The pigeonhole holds for the pieces that are given, at every size."""
    rng = np.random.default_rng(1)
    for percent in (60, 80, 90):
        bands = jaccard.Bands(percent)
        for _ in range(300):
            n = int(rng.integers(1, 120))
            a = np.unique(rng.integers(0, 1 << 64, n, dtype=np.uint64))
            drop = int(rng.integers(0, bands.allowed(2 * len(a)) + 2))
            b = np.unique(np.concatenate([a[drop // 2:], rng.integers(
                0, 1 << 64, drop - drop // 2, dtype=np.uint64)]))
            common = len(np.intersect1d(a, b))
            if not len(b) or 100 * common < percent * (len(a) + len(b) - common):
                continue
            large = max(a, b, key=len)
            every = frozenset([bands.band(len(large))] if bands.lacks(large) else [])
            assert np.intersect1d(bands.keys(a, every), bands.keys(b, every)).size
            sa, sb = jaccard.sketch(a), jaccard.sketch(b)
            width = min(len(sa), len(sb))
            bits = jaccard.fold(sa, width) ^ jaccard.fold(sb, width)
            assert int(np.bitwise_count(bits).sum()) <= len(a) + len(b) - 2 * common


def test_links_odd(spark):
    rows = [(1, None), (2, ""), (3, " \t"), (4, "One"), (5, "one"), (5, "one"), (6, "one two"),
            (None, "one"), (7, "w " * 40_000), (8, "w " * 40_001), (9, "a b c d e"), (10, "A b\nc d e")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumns(
        {c: F.lit("?") for c in ("cls", "n", "id", "rep", "component_id", "key")})
    got = sorted(map(tuple, jaccard.linked(frame, 3, 90).collect()), key=str)
    assert got == sorted([
        (1, 0, 1), (2, 0, 2), (3, 0, 3), (4, 1, 4), (5, 1, 4), (5, 1, 4), (6, 1, 6), (None, 1, None),
        (7, 1, 7), (8, 1, 7), (9, 3, 9), (10, 3, 9)], key=str)
    kept = jaccard.keep_one(frame, 3, 90)
    assert sorted((r["doc_id"] or 0 for r in kept.collect())) == [0, 1, 2, 3, 4, 6, 7, 9]
    assert kept.columns == frame.columns
    repeated = spark.createDataFrame([(1, "a b"), (1, "a b"), (2, "c")], "doc_id long, text string")
    assert sorted(map(tuple, jaccard.keep_one(repeated, 3, 90).collect())) == [(1, "a b"), (2, "c")]
    assert jaccard.linked(frame.where("false")).count() == 0


def test_long_groups_are_streamed(spark, monkeypatch):
    """Groups beyond what a task holds back, and blocks of a group, lose nothing."""
    monkeypatch.setattr(jaccard, "BLOCK", 8)
    rng = random.Random(2)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for doc in range(60):
        own = list(base)
        for _ in range(4):
            own[rng.randrange(60)] = f"x{doc}-{rng.random()}"
        rows.append((doc, " ".join(own)))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert joined(frame, 1, 90) == plain_links(rows, 1, 90)


@pytest.mark.parametrize("block", [6, 2_048])
def test_second_look_is_at_pairs_that_failed(spark, monkeypatch, block):
    """Unlike documents of a group are not looked at again for a pair that was no link; documents
    about as similar as asked for keep all their links."""
    rng, rows = random.Random(5), []
    base = [f"w{i}" for i in range(60)]
    for doc in range(60):
        rows.append((doc, " ".join(base + [f"x{doc}-{i}" for i in range(40)])))
    for doc in range(60, 84):  # four to a family, most of them 0.79 or 0.8 alike
        own = base + [f"y{doc // 4}-{i}" for i in range(40)]
        for place in rng.sample(range(60, 100), 11 + doc % 2):
            own[place] = f"z{doc}-{place}" if doc % 4 else own[place]
        rows.append((doc, " ".join(own)))
    looked, between = [], jaccard._between

    def watched(members, *rest, **named):
        looked.append(members.count())
        return between(members, *rest, **named)

    monkeypatch.setattr(jaccard, "BLOCK", block)
    monkeypatch.setattr(jaccard, "_between", watched)
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert joined(frame, 1, 80) == plain_links(rows, 1, 80)
    if block == 2_048:
        assert len(looked) > 1 and max(looked[1:]) < looked[0] / 4


# --- vectors -----------------------------------------------------------------

def plain_vectors(rows, cosine):
    sound = {i: np.array(v, float) for i, v in rows if v and None not in v
             and np.isfinite(np.array(v, float)).all() and np.any(v)}
    links, union = collections.Counter(), Union()
    for (i, a), (j, b) in itertools.combinations(sound.items(), 2):
        if len(a) == len(b) and a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= cosine:
            links.update([i, j])
            union.join(i, j)
    return {i: (links[i], union.root(i), union.root(i) == i) for i, _ in rows}


def test_vectors_of_the_table(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in table.collect()]
    got = {r["vec_id"]: tuple(r)[1:] for r in embeddings.near_vectors(table).collect()}
    assert got == plain_vectors(rows, 0.95)


def test_vectors_near_the_threshold(spark):
    """Recall over pairs of all cosines from 0.95 on, and whole clusters."""
    rng = np.random.default_rng(5)
    rows = []
    for _ in range(120):
        base = rng.standard_normal(32)
        rows += [base, base + rng.standard_normal(32) * rng.uniform(0.0, 0.33)]
    rows += [rows[0] + rng.standard_normal(32) * 0.01 for _ in range(40)] + [rows[0]] * 5
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(rows)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {r["vec_id"]: r["n_links"] for r in embeddings.near_vectors(frame).collect()}
    want = {i: v[0] for i, v in plain_vectors(rows, 0.95).items()}
    assert all(got[i] <= want[i] for i in want)
    assert sum(got.values()) >= 0.9 * sum(want.values())


@pytest.mark.parametrize("common", [0.0, 0.57, 0.71, 0.95, 0.999])
def test_vectors_with_a_common_part(common):
    """Pairs just above the least cosine share a key, however much all vectors have in common."""
    rng = np.random.default_rng(8)

    def unit(v):
        return v / np.linalg.norm(v, axis=1, keepdims=True)

    own = unit(rng.standard_normal((4_000, 64))) * np.sqrt(1 - common ** 2)
    own[:, 0] += common
    own = unit(own)
    first = own[2_000:]
    noise = rng.standard_normal(first.shape)
    noise = unit(noise - (noise * first).sum(axis=1, keepdims=True) * first)
    second = 0.951 * first + np.sqrt(1 - 0.951 ** 2) * noise
    for vectors in (20_000, 10_000_000):
        codes = embeddings.learn(own[:2_000], vectors, 0.95)
        assert (codes.keys(first) == codes.keys(second)).any(axis=1).mean() >= 0.9


def test_vectors_odd(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [nan, 1.0]), (6, [inf, 1.0]),
            (7, [1.0, 0.0]), (8, [2.0, 0.0]), (9, [1.0, 0.0]), (10, [1.0]), (11, [-1.0, 0.0]),
            (12, [1e-30, 0.0]), (13, [1e30, 1e29])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumns(
        {c: F.lit("?") for c in ("id", "cls", "vector", "links", "rep", "component")})
    got = {r["vec_id"]: tuple(r)[1:] for r in embeddings.near_vectors(frame).collect()}
    assert got == plain_vectors(rows, 0.95)
    assert embeddings.near_vectors(frame.where("false")).count() == 0
    none = frame.limit(1).select(F.lit(None).cast("long").alias("vec_id"), "embedding")
    assert tuple(embeddings.near_vectors(none).first()) == (None, 0, None, False)


# --- templates of sites ------------------------------------------------------

def test_template_removal(spark):
    """What recurs on unlike pages goes; an article that is copied stays."""
    def page(body):
        return f"<body><div><span>Site</span> motto</div><section>{body}</section><p>unlike</p></body>"

    rows = [(i, f"http://Host.org/{i}", page(f"<p>text {i}</p>")) for i in range(8)]
    rows += [(100 + i, f"http://host.org/copy{i}", page("<p>copied</p>")) for i in range(30)]
    rows += [(200, "http://other.org/", page("<p>alone</p>")), (201, None, None), (202, "x", "")]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("host", F.lit(1))
    got = {r["page_id"]: r["text"] for r in html_extract.extract(frame).collect()}
    # The last paragraph recurs as well.
    assert {got[i] for i in range(8)} == {f"text {i}" for i in range(8)}
    assert {got[100 + i] for i in range(30)} == {"copied"}
    assert got[200] == "Site motto alone unlike" and got[201] == got[202] == ""
    assert html_extract.extract(frame.where("false")).count() == 0


def test_template_of_a_section(spark):
    """What recurs in one section of a large host goes, whatever its share of the host."""
    rows = [(i, f"http://host.org/{i}", f"<div class=x{i}>text {i}</div>" + (
        "<div><span>Shop</span> offers</div>" if i < 60 else "")) for i in range(600)]
    rows += [(1_000, "http://host.org/few", "<div>few</div><div class=y>a</div>"),
             (1_001, "http://host.org/few2", "<div>few</div><div class=z>b</div>")]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in html_extract.extract(frame).collect()}
    assert all(got[i] == f"text {i}" for i in range(600))
    assert got[1_000] == "few a" and got[1_001] == "few b"


def test_template_removal_by_join(spark, monkeypatch):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    once = sorted(map(tuple, html_extract.extract(pages).collect()))
    monkeypatch.setattr(html_extract, "BROADCAST_TREES", -1)
    assert sorted(map(tuple, html_extract.extract(pages).collect())) == once


def test_pages_of_the_table(spark):
    from html import unescape

    pages = spark.read.parquet(f"{SF}/pages.parquet")
    got = {r["page_id"]: (r["text"], r["n_chars"]) for r in html_extract.extract(pages).collect()}
    for r in pages.collect():
        article = re.search(r"<article>(.*)</article>", r["html"], re.S)[1]
        text = " ".join(unescape(re.sub(r"</?b>", "", re.sub(r"</?p>|</?h1>|<br>", " ", article))).split())
        assert got[r["page_id"]] == (text, len(text))


# --- the pipeline and the registry ------------------------------------------

def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    lettered = {i for i, t in rows if re.search("[A-Za-z\x80-\U0010FFFF]", t or "")}
    near = plain_links([(i, t) for i, t in rows if i in lettered], 5, 80)
    first = {i for i, (n, c) in near.items() if i == c or not n}
    report = {r["doc_id"]: r for r in decontamination.contamination_report(docs, items).collect()}
    kept = {i for i in first if 2 * report[i]["n_hit"] <= report[i]["n_words"]}
    out = {r["doc_id"]: r for r in corpus_pipeline.run(spark, SF).collect()}
    assert set(out) == kept and all(r["restored"] for r in out.values())


def test_stages_keep_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        made = stage(spark, docs, SF)
        assert made.columns == docs.columns
        assert stage(spark, docs.where("false"), SF).count() == 0


def test_registry():
    import __spark_entry__ as entry

    names = [f"op{n}_" for n in range(1, 11)]
    assert all(any(q.startswith(n) for q in queries.QUERIES) for n in names)
    assert {"pipeline", *queries.QUERIES} <= set(entry.queries())


# --- one of a group ------------------------------------------------------------

def test_keep_one_tells_rows_of_one_id_apart(spark):
    words = [f"w{i}" for i in range(60)]
    a, b = " ".join(words), " ".join([*words[:-1], "other"])
    clean, last = " ".join(f"c{i}" for i in range(40)), " ".join(f"d{i}" for i in range(40))
    rows = [(1, a), (5, b), (5, clean), (5, clean), (7, a), (8, last), (8, last + " more"), (9, None),
            (9, None), (None, a), (10, "")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumn("group", F.lit("?"))
    kept = sorted(((r["doc_id"], r["text"]) for r in jaccard.keep_one(frame).collect()), key=str)
    assert [r for r in kept if r[0] != 8] == sorted(
        [(1, a), (5, clean), (9, None), (9, None), (None, a), (10, "")], key=str)
    assert len([r for r in kept if r[0] == 8]) == 1
    assert jaccard.keep_one(frame.where("false")).count() == 0


# --- pages: the article whole, in time that grows with the page -------------------

def test_articles_keep_what_is_theirs():
    def text(inner):
        return html_parse.parse(f"<article>{inner}</article>").text

    assert text('<h2 class="section-header">Head</h2>t') == "Head t"
    assert text('<h2 id="related">Related work</h2><h3 id="discussion">On it</h3>') == "Related work On it"
    assert text('<div class="entry-header"><h1>Title</h1></div>x') == "Title x"
    assert text("a <math><mi>x</mi></math> b") == "a x b"
    assert text("<xmp>raw <b></xmp>") == "raw <b>"
    assert text('<div class="comments">no</div><p class="ad">no</p><nav>no</nav>yes') == "yes"
    assert html_parse.parse('<div class="header">no</div><p>yes</p>').text == "yes"


def test_text_around_articles_stays():
    parse = html_parse.parse
    assert parse("<main><p>intro</p><article>one</article><p>tail</p></main><p>out</p>").text == (
        "intro one tail")
    assert parse("<nav>n</nav><article>one</article><p>mid</p><article>two</article><p>out</p>").text == (
        "one mid two")
    assert parse("<main><article>one</article><nav>no</nav></main>").text == "one"


def test_open_ends():
    parse = html_parse.parse
    assert parse("x <!-- no").text == "x"
    assert parse("<p>a<![CDATA[ q").text == "a q"
    assert parse("a < b").text == "a < b" and parse("<p>1 < 2 <b>x</b>").text == "1 < 2 x"


def test_long_pages_take_time_in_proportion():
    for page in ("<a " * 300_000, "<div>text " * 100_000, "<div>" * 100_000 + "x",
                 "<li><div>" * 50_000, '<a ">' * 100_000, "<!--" * 100_000,
                 "<p>" + "<span>" * 100_000 + "<div>" * 1_000):
        start = time.process_time()
        html_parse.parse(page)
        assert time.process_time() - start < 10, page[:20]


def test_tasks_leave_no_freed_memory_behind():
    """Blocks below the allocator's bound, freed beneath one that stays, go back to the system."""
    def resident():
        with open("/proc/self/statm") as file:
            return int(file.read().split()[1]) * 4_096 >> 20

    kept = []

    def run(batches):
        import ctypes

        libc = ctypes.CDLL(None)
        libc.malloc.restype, libc.free.argtypes = ctypes.c_void_p, [ctypes.c_void_p]
        before = resident()
        blocks = [libc.malloc(100_000) for _ in range(3_000)]
        for block in blocks:
            ctypes.memset(block, 1, 100_000)
        libc.malloc(100_000)  # stays, above all others
        for block in blocks:
            libc.free(block)
        kept.append((before, resident()))
        yield from batches

    assert list(common.lean(run)(iter([1, 2]))) == [1, 2]
    [(before, within)] = kept
    assert within > before + 200 and resident() < before + 100
