"""Analyzers: how a language's text becomes index terms."""

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from crosslex.functions import stopwords
from crosslex.functions.stemmers import stem_array, word_stemmer
from crosslex.functions.text import MAX_WORD_LENGTH, plain_words, unicode_words


@dataclass(frozen=True)
class Analyzer:
    """Word segmentation, stop words and stemming of one language.

    Unicode words longer than ``longest`` are cut into pieces of that length.
    """

    tokenizer: str = "plain"
    stop: tuple = ()
    stemmer: str | None = None
    longest: int = MAX_WORD_LENGTH

    def words(self, text: Column) -> Column:
        if self.tokenizer == "plain":
            return plain_words(text)
        return unicode_words(text, self.longest)

    def tokens(self, text: Column) -> Column:
        """``array<struct<term, pos>>``; removed stop words leave position gaps."""
        words = self.words(text)
        stems = words if self.stemmer is None else stem_array(words, self.stemmer)
        if not self.stop:
            return F.transform(stems, lambda t, i: F.struct(t.alias("term"), i.alias("pos")))
        stop = list(self.stop)
        if self.stemmer is None:
            tokens = F.transform(words, lambda t, i: F.struct(t.alias("term"), i.alias("pos")))
            return F.filter(tokens, lambda t: ~t["term"].isin(stop))
        # Stop words are compared before stemming.
        kept = F.filter(
            F.transform(words, lambda t, i: F.struct(t.alias("word"), i.alias("pos"))),
            lambda t: ~t["word"].isin(stop),
        )
        return F.arrays_zip(
            stem_array(F.transform(kept, lambda t: t["word"]), self.stemmer).alias("term"),
            F.transform(kept, lambda t: t["pos"]).alias("pos"),
        )


PLAIN = Analyzer()
CZECH = Analyzer("unicode", tuple(stopwords.CZECH), "czech")
HUNGARIAN = Analyzer("unicode", tuple(stopwords.HUNGARIAN), "hungarian")

#: Language to analyzer. Slovak has no analyzer of its own and uses the Czech one.
ANALYZERS = {"sk": CZECH, "cs": CZECH, "hu": HUNGARIAN}


def analyzer_for(lang: str, analyzers=ANALYZERS) -> Analyzer:
    """Analyzer of a language; an unknown language is an error."""
    if lang not in analyzers:
        raise ValueError(f"no analyzer for language {lang!r}, known: {sorted(analyzers)}")
    return analyzers[lang]


def analyze(text: Column, lang: Column, analyzers=ANALYZERS) -> Column:
    """Index terms of a text column by the language beside it.

    The same call serves documents and queries. Rows of a language without an
    analyzer fail the job, as they would otherwise be lost from the index.
    """
    return _by_language(lang, {a: a.tokens(text) for a in analyzers.values()}, analyzers,
                        "array<struct<term string, pos int>>")


def analyze_words(text: Column, lang: Column, analyzers=ANALYZERS) -> Column:
    """The words that :func:`analyze` would take terms from, as ``array<string>``: in order,
    stop words among them and not stemmed."""
    # One expression a tokenizer, whatever differs otherwise.
    words = {key: Analyzer(key[0], longest=key[1]) for key in {
        (a.tokenizer, a.longest) for a in analyzers.values()}}
    keys = {code: (a.tokenizer, a.longest) for code, a in analyzers.items()}
    return _by_language(lang, {k: a.words(text) for k, a in words.items()}, keys, "array<string>")


def analyzer_number(lang: Column, analyzers=ANALYZERS) -> Column:
    """Number of a language's analyzer among :func:`finishers`."""
    different = list(dict.fromkeys(analyzers.values()))
    return _by_language(lang, {a: F.lit(n) for n, a in enumerate(different)}, analyzers, "int")


def finishers(analyzers=ANALYZERS) -> list[tuple[frozenset, Callable[[str], str] | None]]:
    """Of every different analyzer its stop words and what makes a term of a word, for tasks
    that see distinct words; None if words are terms."""
    return [(frozenset(a.stop), a.stemmer and word_stemmer(a.stemmer))
            for a in dict.fromkeys(analyzers.values())]


def _by_language(lang: Column, values: dict, keys: dict, kind: str) -> Column:
    """For each language the value of its key, an error for others."""
    codes: dict = {}
    for code, key in keys.items():
        codes.setdefault(key, []).append(code)
    out = None
    for key, theirs in codes.items():
        test = lang.isin(theirs)
        out = F.when(test, values[key]) if out is None else out.when(test, values[key])
    return out.otherwise(
        F.raise_error(F.concat(F.lit("no analyzer for language "), lang)).cast(kind))


def remove_stopwords(words: Column, lang: Column, stop_by_lang: dict) -> Column:
    """Words without the stop words of the language beside them."""
    def without(stop):
        return F.filter(words, lambda w: ~w.isin(list(stop)))

    out = None
    for code, stop in stop_by_lang.items():
        kept = without(stop)
        out = F.when(lang == code, kept) if out is None else out.when(lang == code, kept)
    return words if out is None else out.otherwise(words)
