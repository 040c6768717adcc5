"""Work that grows with distinct words and not with all, and files that go when they are of no use."""

import random
import time

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from crosslex.functions import stemmers, text
from crosslex.functions.analysis import CZECH, HUNGARIAN, PLAIN, analyze, finishers
from crosslex.operators import index
from crosslex.sources import workspace


def made_words(endings, many):
    """Words of random letters and endings, the same in every run."""
    draw = random.Random(7)
    found = set()
    for _ in range(many):
        word = "".join(draw.choice("aeiouáéíóöőúüűů" if draw.random() < 0.5 else "bcčdgklmnstšvzž")
                       for _ in range(draw.randint(1, 6)))
        found.add(word + "".join(draw.choice(endings) for _ in range(draw.randint(0, 3))))
    return sorted(found)


@pytest.mark.parametrize("language", ["czech", "hungarian"])
def test_stems_of_single_words(spark, language):
    endings = stemmers.HU_DOUBLES + [s for _, rules in stemmers.HU_RULES for g in rules.values()
                                     for s in g.split()]
    if language == "czech":
        endings = [e for _, group in stemmers.CS_CASE for e in group.split()] + [
            *stemmers.CS_POSSESSIVE[1].split(), "čt", "št", "ec", "ez", "ůz"]
    words = ["a", "é", *made_words(endings, 5_000)]
    df = spark.createDataFrame([(w,) for w in words], "w string")
    stem = stemmers.word_stemmer(language)
    for word, want in df.select("w", stemmers.stem(F.col("w"), language)).collect():
        assert (word, stem(word)) == (word, want)


def test_unknown_stemmer():
    with pytest.raises(ValueError, match="no stemmer"):
        stemmers.word_stemmer("slovak")


def test_each_word_is_stemmed_once():
    calls = []
    finish = [(frozenset({"the"}), lambda w: calls.append(w) or w[:3])]
    part = pa.RecordBatch.from_pydict({
        "words": [["the", "houses", "the", "house"], ["the"], ["houses"] * 50],
        "analyzer": pa.array([0, 0, 0], pa.int32())})
    terms, row, number, pos, dl = index._numberer(finish, 100)()(part, np.array([4, 1, 50]))
    assert sorted(calls) == ["house", "houses"]
    assert terms.to_pylist() == ["hou"]
    assert pos.to_pylist()[:2] == [1, 3]
    assert dl.to_pylist() == [2, 0, 50]


def test_postings_are_the_analyzed_tokens(spark):
    """Several analyzers, stop words and stems in one slice: the terms that queries have."""
    analyzers = {"cs": CZECH, "hu": HUNGARIAN, "en": PLAIN}
    assert len(finishers(analyzers | {"sk": CZECH})) == 3
    rows = [("cs", "1", "Praze a Praha", "testech testů, klasická v.Praze 👍"),
            ("hu", "2", "", "A házakkal és a házak könyveim"), ("en", "3", "The the", "it's A testech"),
            ("cs", "4", "a", "a"), ("hu", "5", "x" * 300, "ő")]
    docs = index.unique_documents(spark.createDataFrame(
        rows, "lang string, id string, title string, text string"))
    fields = [F.struct(F.lit(f).alias("field"), analyze(F.col(f), F.col("lang"), analyzers).alias("tokens"))
              for f in index.FIELDS]
    want = docs.select("lang", "id", "dup_no", "copies", F.inline(F.array(*fields))).withColumn(
        "dl", F.size("tokens"))
    names = ["lang", "field", "term", "id", "dup_no", "copies", "tf", "dl", "first", "positions"]
    found = index.build_postings(docs, analyzers).select(names).collect()
    assert sorted(map(tuple, found)) == sorted(map(tuple, index.group_terms(want).select(names).collect()))
    assert {r["lang"] for r in found} == {"cs", "hu", "en"}


def test_words_are_found_once(spark):
    """The pattern is not run again for the test whether a word is too long."""
    df = spark.createDataFrame([("Some words.",)], "t string")
    plan = df.select(text.unicode_words(F.col("t")).alias("w"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all(lower(t") == 1


def shuffle_files(spark):
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    names = blocks.getAllFiles().mkString(" ")
    return {n for n in names.split() if "shuffle_" in n}


def test_written_tables_leave_no_shuffles(spark):
    before = shuffle_files(spark)
    rows = spark.range(1000).repartition(3, "id")
    settled = workspace.settle(rows, "rows")
    path = workspace.new_path(spark, "folders")
    index.write_folders(rows.withColumn("f", F.col("id") % 2), path, ["f"], F.col("id"))
    for _ in range(20):  # they are removed beside what follows
        if not (left := shuffle_files(spark) - before):
            break
        time.sleep(0.5)
    assert not left
    assert settled.count() == spark.read.parquet(path).count() == 1000
    assert spark.conf.get(workspace.FREE_SHUFFLES, None) != "true"


def plain_pairs(group, percent, forest):
    """Pairs that pass the tests, one after the other."""
    from crosslex.llm.jaccard import fold

    width = min(len(r["value"]) for r in group) // 8
    bits = [fold(np.frombuffer(r["value"], np.uint64), width) for r in group]
    comp, apart = [r["comp"] for r in group], group[0]["lo"] != group[0]["hi"]
    for i, a in enumerate(group):
        passed = []
        for j in range(i + 1, len(group)):
            b = group[j]
            both, unlike = a["n"] + b["n"], int(np.bitwise_count(bits[i] ^ bits[j]).sum())
            if (comp[i] != comp[j] and (not apart or a["block"] != b["block"])
                    and 100 * min(a["n"], b["n"]) >= percent * max(a["n"], b["n"])
                    and unlike * (100 + percent) <= both * (100 - percent)
                    and not (forest and any(comp[j] == comp[x] for x in passed))):
                passed.append(j)
        if forest:
            joined = {comp[j] for j in passed}
            comp = [comp[i] if c in joined else c for c in comp]
        for j in passed:
            yield a["gid"], min(a["cls"], group[j]["cls"]), max(a["cls"], group[j]["cls"])


@pytest.mark.parametrize("forest", [True, False])
@pytest.mark.parametrize("step", [3, 100_000])
def test_groups_are_compared_together(monkeypatch, forest, step):
    """Small groups of one size at once, larger ones by themselves: the pairs of plain loops."""
    from crosslex.llm import jaccard

    monkeypatch.setattr(jaccard, "SMALL", 6)
    monkeypatch.setattr(jaccard, "AT_ONCE", 50)
    draw, hashes = random.Random(5), np.random.default_rng(5)
    names = ["gid", "lo", "hi", "block", "cls", "comp", "n", "value"]
    groups = []
    for gid in range(150):
        base, apart, group = hashes.integers(0, 2**63, 120), draw.random() < 0.3, []
        for m in range(draw.choice([1, 2, 2, 3, 4, 6, 7, 12])):
            own = np.unique(np.concatenate([
                base[:draw.choice([20, 90, 110]) - draw.randint(0, 8)],
                hashes.integers(0, 2**63, draw.randint(0, 9))])).astype(np.uint64)
            comp = draw.randint(0, 3) if draw.random() < 0.5 else m + 10
            group.append(dict(zip(names, (gid - 70, 0, int(apart), draw.randint(0, 1), draw.randint(
                -10**17, 10**17), comp, len(own), jaccard.sketch(own).tobytes()))))
        groups.append(group)
    rows = pa.RecordBatch.from_pylist([r for g in groups for r in g])
    batches = [rows.slice(i, step) for i in range(0, rows.num_rows, step)]
    found, parts = [], 0
    for part in jaccard.whole_groups(iter(batches)):
        parts += 1
        for pairs in jaccard._met(part, 80, forest):
            found += zip(*(x.tolist() for x in pairs))
    want = sorted(p for g in groups for p in plain_pairs(g, 80, forest))
    assert sorted(found) == want and len(want) > 100
    assert (parts > 5) == (step == 3)
    assert list(jaccard.whole_groups(iter([rows.slice(0, 0)]))) == []
