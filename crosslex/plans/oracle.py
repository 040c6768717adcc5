"""SQL that must give the same rows as the queries, written for DuckDB.

It spells the derived tables and every operator a second time, plainly: copies are
rows, statistics are counted where they are used, nothing is bucketed or salted.
"""

from crosslex.functions import stemmers, stopwords, text
from crosslex.functions.text import (
    ACCENTED, EMOJI_WORD, EXTEND, KATAKANA, MID_LETTER, MID_NUMBER, PLAIN_WORD, SIGNS, UNACCENTED)
from crosslex.operators.corpus import ENTITIES, HTML_DROPPED
from crosslex.operators.search import B, K1, SCOPES
from crosslex.operators.titles import BLOCK
from crosslex.plans.derived import LANGS, LINK_BLOCK
from crosslex.plans.queries import ANALYZED, ASKED, CLAUSES, MARKUP_SIGNS, SAME_QID


def quote(value: str) -> str:
    return "'" + str(value).replace("'", "''") + "'"


def listed(values) -> str:
    return ", ".join(quote(v) for v in values)


# --- derived tables ----------------------------------------------------------

CTES = {
    "article": """
        SELECT CAST(doc_id AS VARCHAR) AS id, doc_id AS num_id, lang, source,
            trim(split_part(text, chr(10), 1)) AS title,
            CASE WHEN position(chr(10) IN text) = 0 THEN ''
                 ELSE substr(text, position(chr(10) IN text) + 1) END AS text
        FROM documents""",
    "page": """
        SELECT num_id AS page_id, lang, replace(title, ' ', '_') AS page_title FROM article""",
    "placed": f"""
        SELECT num_id, lang, source, title, num_id // {LINK_BLOCK} AS block,
            row_number() OVER (PARTITION BY num_id // {LINK_BLOCK}, lang ORDER BY num_id) AS nth
        FROM article""",
    "langlinks": """
        SELECT p.num_id AS ll_from, t.lang AS ll_lang,
            CASE t.source WHEN 'src13' THEN 'Category:'
                 WHEN 'src11' THEN concat('Missing ', t.num_id)
                 WHEN 'src17' THEN concat('A:B:', t.title)
                 WHEN 'src7' THEN concat('Category:', t.title)
                 ELSE t.title END AS ll_title
        FROM placed p JOIN placed t ON p.block = t.block AND p.nth = t.nth
        WHERE p.lang = 'en' AND t.lang <> 'en'""",
    "keyed": """
        SELECT ll_from, ll_lang AS lang, ll_title,
            replace(regexp_replace(ll_title, '^[^:]*:', ''), ' ', '_') AS title_key
        FROM langlinks""",
    "title_ids": """
        SELECT lang, page_title, min(page_id) AS target_id FROM page GROUP BY ALL""",
    "pairs": """
        SELECT CAST(ll_from AS VARCHAR) AS pivot_id, k.lang,
            CAST(target_id AS VARCHAR) AS target_id
        FROM keyed k JOIN title_ids t ON k.lang = t.lang AND k.title_key = t.page_title
        WHERE title_key <> ''""",
    "triples": """
        SELECT d.pivot_id AS en_id, d.target_id AS de_id, f.target_id AS fr_id
        FROM pairs d JOIN pairs f ON d.pivot_id = f.pivot_id
        WHERE d.lang = 'de' AND f.lang = 'fr'""",
    "corpus": """
        SELECT * FROM article WHERE num_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)""",
    "changed": """
        SELECT lang, id, title, split_part(text, '.', 1) || ' zusatz ' || title AS text FROM article
        WHERE lang IN ('en', 'de') AND num_id % 3 = 0
        UNION ALL SELECT lang, id, title, text FROM article
        WHERE num_id % 5 <> 4 AND NOT (lang IN ('en', 'de') AND num_id % 3 = 0)""",
    "renumbered": """
        SELECT CAST(num_id // 4 AS VARCHAR) AS id, lang, title, text FROM article""",
    "complete": """
        SELECT DISTINCT * FROM triples t
        WHERE EXISTS (SELECT 1 FROM corpus c WHERE c.lang = 'en' AND c.id = t.en_id)
          AND EXISTS (SELECT 1 FROM corpus c WHERE c.lang = 'de' AND c.id = t.de_id)
          AND EXISTS (SELECT 1 FROM corpus c WHERE c.lang = 'fr' AND c.id = t.fr_id)""",
    "extracted": """
        SELECT lang, c.id, title, text FROM corpus c JOIN complete t ON c.id = t.en_id
        WHERE lang = 'en'
        UNION ALL SELECT lang, c.id, title, text FROM corpus c JOIN complete t ON c.id = t.de_id
        WHERE lang = 'de'
        UNION ALL SELECT lang, c.id, title, text FROM corpus c JOIN complete t ON c.id = t.fr_id
        WHERE lang = 'fr'""",
    "tuples": """
        SELECT 'en' AS lang, en_id AS id, CAST(de_id AS BIGINT) AS n1, CAST(fr_id AS BIGINT) AS n2,
            'de' AS l1, 'fr' AS l2 FROM triples
        UNION ALL SELECT 'de', de_id, CAST(en_id AS BIGINT), CAST(fr_id AS BIGINT), 'en', 'fr'
        FROM triples
        UNION ALL SELECT 'fr', fr_id, CAST(en_id AS BIGINT), CAST(de_id AS BIGINT), 'en', 'de'
        FROM triples""",
    "best_tuple": """
        SELECT * FROM tuples
        QUALIFY row_number() OVER (PARTITION BY lang, id ORDER BY n1 DESC, n2 DESC) = 1""",
    "id_map": """
        SELECT lang, id, l1 AS other_lang, CAST(n1 AS VARCHAR) AS other_id FROM best_tuple
        UNION ALL SELECT lang, id, l2, CAST(n2 AS VARCHAR) FROM best_tuple""",
}


def with_ctes(body: str, ctes: dict) -> str:
    return "WITH " + ",\n".join(f"{n} AS ({q})" for n, q in ctes.items()) + "\n" + body


def over_links(body: str, more: dict | None = None) -> str:
    return with_ctes(body, {**CTES, **(more or {})})


# --- index tables ------------------------------------------------------------

def index_ctes(source: str) -> dict:
    return {
        "doc": f"""SELECT lang, id, title, text,
            row_number() OVER (PARTITION BY lang, id) AS dup_no FROM {source}""",
        "field_value": """
            SELECT lang, id, dup_no, 'title' AS field, title AS value FROM doc
            UNION ALL SELECT lang, id, dup_no, 'text', text FROM doc""",
        "word_list": f"""SELECT lang, id, dup_no, field,
            regexp_extract_all(lower(value), '{PLAIN_WORD}') AS words FROM field_value""",
        "token": """SELECT lang, id, dup_no, field, unnest(words) AS term,
            unnest(range(len(words))) AS pos FROM word_list""",
        "posting": """SELECT lang, field, term, id, dup_no, count(*) AS tf,
            list(pos ORDER BY pos) AS positions FROM token GROUP BY ALL""",
        "doc_length": """SELECT lang, field, id, dup_no, CAST(sum(tf) AS BIGINT) AS dl
            FROM posting GROUP BY ALL""",
        "stats": """SELECT lang, field, count(*) AS n_docs,
            CAST(sum(dl) AS DOUBLE) / count(*) AS avgdl FROM doc_length GROUP BY ALL""",
        "freq": "SELECT lang, field, term, count(*) AS df FROM posting GROUP BY ALL",
    }


def over_index(body: str, source: str = "article", more: dict | None = None) -> str:
    return over_links(body, {**index_ctes(source), **(more or {})})


IDF = "ln(1 + (n_docs - df + 0.5) / (df + 0.5))"
LOSSY = ("(CASE WHEN dl < 40 THEN dl ELSE 24 + ((dl - 24) >> (length(bin(dl - 24)) - 4)) "
         "* (1 << (length(bin(dl - 24)) - 4)) END)")


def tf_norm(tf="tf", dl=LOSSY):
    return f"{tf} / ({tf} + {K1} * (1 - {B} + {B} * {dl} / avgdl))"


def valid(parts="parts", reason_only=True, langs=LANGS):
    return f"""CASE WHEN len({parts}) < 3 THEN 'syntax'
        WHEN {parts}[1] NOT IN ({listed(langs)}) THEN 'language'
        WHEN {parts}[2] NOT IN ({listed(SCOPES)}) THEN 'scope'
        WHEN trim({parts}[3]) = '' THEN 'empty text' END"""


def search_ctes(asked: str, dl: str = LOSSY, langs=LANGS) -> dict:
    return {
        "query_row": asked,
        "split_row": """SELECT qid, string_split(regexp_replace(q, ':+$', ''), ':') AS parts
            FROM query_row""",
        "decoded": f"""SELECT qid, parts[1] AS lang, parts[2] AS "at", parts[3] AS qtext
            FROM split_row WHERE ({valid(langs=langs)}) IS NULL""",
        "query_word": f"""SELECT qid, lang, "at" AS scope, unnest(
            regexp_extract_all(lower(qtext), '{PLAIN_WORD}')) AS term FROM decoded""",
        "query_term": """SELECT qid, lang, scope LIKE '%&%' AS in_both, 'title' AS field, term
            FROM query_word WHERE scope LIKE '%T%'
            UNION ALL SELECT qid, lang, scope LIKE '%&%', 'text', term
            FROM query_word WHERE scope LIKE '%t%'""",
        "scored": f"""
            SELECT qid, p.lang, p.id, p.dup_no,
                round(sum({IDF} * {tf_norm(dl=dl)}), 6) AS score
            FROM query_term q
            JOIN posting p ON q.lang = p.lang AND q.field = p.field AND q.term = p.term
            JOIN doc_length l ON l.lang = p.lang AND l.field = p.field AND l.id = p.id
                AND l.dup_no = p.dup_no
            JOIN stats s ON s.lang = p.lang AND s.field = p.field
            JOIN freq f ON f.lang = p.lang AND f.field = p.field AND f.term = p.term
            GROUP BY qid, p.lang, p.id, p.dup_no, in_both
            HAVING NOT in_both OR count(DISTINCT p.field) = 2""",
        "hit": """SELECT *, row_number() OVER (PARTITION BY qid
            ORDER BY score DESC, CAST(id AS BIGINT), lang, dup_no) AS rank FROM scored
            QUALIFY rank <= 10""",
    }


def rows(values) -> str:
    return "SELECT * FROM (VALUES " + ", ".join(
        f"({qid}, {quote(q)})" for qid, q in values) + ") AS t(qid, q)"


ALL = [*LANGS, "es"]


def one_search(q: str, body="SELECT rank, lang, id, score FROM hit", dl=LOSSY) -> str:
    return over_index(body, more=search_ctes(rows([(1, q)]), dl, ALL))


SCORES = "SELECT CAST(qid AS INTEGER) AS qid, lang, id, score FROM scored"

# --- translations ------------------------------------------------------------

TRANSLATED = {
    **index_ctes("extracted"),
    **search_ctes(rows(ASKED)),
    "wanted": """
        SELECT qid, rank, score, 0 AS pos, lang, id FROM hit
        UNION ALL SELECT qid, rank, score,
            row_number() OVER (PARTITION BY qid, rank
                ORDER BY list_position(['en', 'de', 'fr'], other_lang)), other_lang, other_id
        FROM hit JOIN id_map USING (lang, id)""",
    "shown": """SELECT DISTINCT lang, id, title, text FROM extracted""",
    "translated": """SELECT CAST(qid AS BIGINT) AS qid, rank, score, CAST(pos AS BIGINT) AS pos,
        lang, id, title, text FROM wanted LEFT JOIN shown USING (lang, id)""",
}


def over_translations(body: str) -> str:
    return over_links(body, TRANSLATED)


# --- clauses -----------------------------------------------------------------

def _scoring(where: str, weight: str = "1.0") -> str:
    return f"""SELECT p.lang, p.id, p.dup_no, sum({weight} * {IDF} * {tf_norm()}) AS part
        FROM posting p JOIN doc_length l USING (lang, field, id, dup_no)
        JOIN stats USING (lang, field) JOIN freq USING (lang, field, term)
        WHERE {where} GROUP BY ALL"""


def _constant(where: str) -> str:
    return f"SELECT DISTINCT lang, id, dup_no, 1.0 AS part FROM posting p WHERE {where}"


def _words(c):
    return [w for w in c.value.lower().split()]


def _phrase(lang, c) -> str:
    words = _words(c)
    joins = " ".join(
        f"JOIN token t{i} ON t{i}.lang = t0.lang AND t{i}.field = t0.field AND t{i}.id = t0.id "
        f"AND t{i}.dup_no = t0.dup_no AND t{i}.pos = t0.pos + {i} AND t{i}.term = {quote(w)}"
        for i, w in enumerate(words) if i)
    starts = (f"SELECT t0.lang, t0.field, t0.id, t0.dup_no, CAST(count(*) AS DOUBLE) AS tf "
              f"FROM token t0 {joins} WHERE t0.lang = {quote(lang)} AND t0.field = "
              f"{quote(c.field)} AND t0.term = {quote(words[0])} GROUP BY ALL")
    return _phrase_score(lang, c, words, starts)


def _phrase_score(lang, c, words, starts) -> str:
    weight = " + ".join(
        f"(SELECT {IDF} FROM freq f JOIN stats s USING (lang, field) WHERE lang = {quote(lang)} "
        f"AND field = {quote(c.field)} AND term = {quote(w)})" for w in words)
    return f"""SELECT lang, id, dup_no, ({weight}) * {tf_norm()} AS part
        FROM ({starts}) JOIN doc_length USING (lang, field, id, dup_no)
        JOIN stats USING (lang, field)"""


def _slop(lang, c) -> str:
    words = _words(c)
    which = " ".join(f"WHEN {quote(w)} THEN {i}" for i, w in enumerate(words))
    # The next place of every other word, from a place on.
    ahead = ", ".join(f"""min(CASE WHEN which = {i} THEN place END) OVER (
        PARTITION BY lang, field, id, dup_no ORDER BY place, which
        ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS next{i}""" for i in range(len(words)))
    farthest = ", ".join(f"CASE WHEN which = {i} THEN place ELSE next{i} END"
                         for i in range(len(words)))
    every = " AND ".join(f"(which = {i} OR next{i} IS NOT NULL)" for i in range(len(words)))
    starts = f"""SELECT lang, field, id, dup_no,
            sum(1.0::DOUBLE / (1 + greatest({farthest}) - place)) AS tf FROM (
            SELECT *, lead(which) OVER (PARTITION BY lang, field, id, dup_no
                ORDER BY place, which) AS next_which, {ahead} FROM (
                SELECT lang, field, id, dup_no, CASE term {which} END AS which,
                    pos - (CASE term {which} END) AS place
                FROM token WHERE lang = {quote(lang)} AND field = {quote(c.field)}
                    AND term IN ({listed(words)})))
        WHERE which <> next_which AND {every} AND greatest({farthest}) - place <= {c.slop}
        GROUP BY ALL"""
    return _phrase_score(lang, c, words, starts)


def _slop_repeat(lang, c) -> str:
    """All ways to give each word a place; of those that begin at one place the shortest."""
    words, doc = _words(c), "lang, field, id, dup_no"
    n = len(words)
    joins = " ".join(
        f"JOIN place t{i} USING ({doc})" for i in range(1, n))
    tests = [f"t{i}.term = {quote(w)}" for i, w in enumerate(words)]
    tests += [f"abs((t{i}.pos - {i}) - (t0.pos - 0)) <= {c.slop}" for i in range(1, n)]
    tests += [f"t{i}.pos < t{j}.pos" for i in range(n) for j in range(i + 1, n) if words[i] == words[j]]
    keys = [f"(t{i}.pos - {i}) * {n} + {i}" for i in range(n)]
    first = f"least({', '.join(keys)})"
    second = f"list_sort([{', '.join(keys)}])[2]"
    after = "CASE " + " ".join(
        f"WHEN {k} = {first} THEN (t{i}.again - {i}) * {n} + {i}" for i, k in enumerate(keys)) + " END"
    last = f"greatest({', '.join(f't{i}.pos - {i}' for i in range(n))})"
    begin = f"least({', '.join(f't{i}.pos - {i}' for i in range(n))})"
    starts = f"""SELECT {doc}, sum(1.0::DOUBLE / (1 + reach)) AS tf FROM (
            SELECT {doc}, first, min(reach) AS reach, min(second) AS second, any_value(after) AS after
            FROM (WITH place AS (SELECT *, lead(pos) OVER (
                        PARTITION BY {doc}, term ORDER BY pos) AS again
                    FROM token WHERE lang = {quote(lang)} AND field = {quote(c.field)}
                        AND term IN ({listed(words)}))
                SELECT {doc}, {first} AS first, {second} AS second, {after} AS after,
                    {last} - {begin} AS reach
                FROM place t0 {joins} WHERE {" AND ".join(tests)})
            WHERE reach <= {c.slop} GROUP BY {doc}, first)
        WHERE after IS NULL OR second < after GROUP BY {doc}"""
    return _phrase_score(lang, c, words, starts)


def _fuzzy(lang, c) -> str:
    w, word, size = c.value.lower(), quote(c.value.lower()), len(c.value)
    swapped = " ".join(f"""WHEN list_bool_or(list_transform(range(length(term)), lambda k:
            substr(term, k + 1, 2) = {quote(w[i + 1] + w[i])}
            AND levenshtein(substr(term, 1, k), {quote(w[:i])})
                + levenshtein(substr(term, k + 3), {quote(w[i + 2:])}) <= {n}))
            THEN {n + 1}""" for n in range(c.edits) for i in range(len(w) - 1) if w[i] != w[i + 1])
    near = f"""SELECT *, CASE WHEN edits = 0 THEN 1.0
            ELSE 1.0 - edits::DOUBLE / least(length(term), {size}) END AS weight
        FROM (SELECT lang, field, term, df, least(
                levenshtein(term, {word}), CASE {swapped} ELSE 9 END) AS edits FROM freq
            WHERE lang = {quote(lang)} AND field = {quote(c.field)})
        WHERE edits <= {c.edits} AND (edits = 0 OR edits < least(length(term), {size}))
        """
    return f"""SELECT p.lang, p.id, p.dup_no, sum(weight * {IDF} * {tf_norm()}) AS part
        FROM (SELECT lang, field, term, weight, max(df) OVER () AS df FROM ({near})) n
        JOIN posting p USING (lang, field, term)
        JOIN doc_length l USING (lang, field, id, dup_no) JOIN stats USING (lang, field)
        GROUP BY ALL"""


def clause_sql(lang, c) -> str:
    scope = f"p.lang = {quote(lang)} AND p.field = {quote(c.field)} AND "
    if c.kind == "term":
        return _scoring(scope + f"p.term IN ({listed(_words(c))})")
    if c.kind == "phrase":
        if c.slop and len(set(_words(c))) < len(_words(c)):
            return _slop_repeat(lang, c)
        return _slop(lang, c) if c.slop else _phrase(lang, c)
    if c.kind == "prefix":
        return _constant(scope + f"starts_with(term, {quote(c.value)})")
    if c.kind == "wildcard":
        return _constant(scope + f"term LIKE {quote(c.value.replace('?', '_').replace('*', '%'))}")
    if c.kind == "regex":
        return _constant(scope + f"regexp_full_match(term, {quote(c.value)})")
    if c.kind == "range":
        low, high = (">=", "<=") if c.inclusive else (">", "<")
        return _constant(scope + f"term {low} {quote(c.value)} AND term {high} {quote(c.upper)}")
    return _fuzzy(lang, c)


def clauses_sql(name: str) -> str:
    lang, given = CLAUSES[name]
    parts, excluded, must = [], [], set()
    for i, c in enumerate(given):
        group = f"clause {i}" if c.group is None else f"group {c.group}"
        if c.occur == "must_not":
            excluded.append(clause_sql(lang, c))
            continue
        if c.occur == "must":
            must.add(group)
        parts.append(f"SELECT lang, id, dup_no, {c.boost} * part AS part, {quote(group)} AS grp "
                     f"FROM ({clause_sql(lang, c)})")
    having = [f"bool_or(grp = {quote(g)})" for g in sorted(must)] or ["true"]
    without = " ".join(f"AND (lang, id) NOT IN (SELECT (lang, id) FROM ({x}))" for x in excluded)
    return over_index(f"""
        SELECT lang, id, round(sum(part), 6) AS score FROM ({" UNION ALL ".join(parts)})
        WHERE true {without} GROUP BY lang, id, dup_no HAVING {" AND ".join(having)}""")


# --- clauses of many queries ---------------------------------------------------

def _passage_clauses() -> str:
    def word(n):
        return f"words[{n + 1}]"

    def several(*numbers):
        return f"concat_ws(' ', {', '.join(word(n) for n in numbers)})"

    plain = {"field": "'text'", "occur": "'should'", "boost": "1.0", "grp": "NULL", "upper": "NULL",
             "inclusive": "true", "slop": "0", "edits": "2", "expansions": "NULL"}
    given = [
        {"kind": "term", "value": several(0, 1, 2, 3, 4), "occur": "'must'", "grp": "1"},
        {"kind": "term", "value": several(5, 6, 7), "occur": "'must'", "grp": "1", "field": "'title'"},
        {"kind": "phrase", "value": several(1, 2), "boost": "2.0"},
        {"kind": "phrase", "value": several(3, 4, 3), "slop": "4"},
        {"kind": "prefix", "value": f"left({word(5)}, 4)"},
        {"kind": "wildcard", "value": f"left({word(6)}, 2) || '%' || right({word(6)}, 1)", "boost": "0.5"},
        {"kind": "fuzzy", "value": word(7)},
        {"kind": "fuzzy", "value": word(8), "edits": "1", "expansions": "3"},
        {"kind": "range", "value": word(9), "upper": f"{word(9)} || 'e'", "inclusive": "qid % 2 = 0"},
        {"kind": "regex", "value": f"left({word(10)}, 1) || '.+' || right({word(10)}, 2)"},
        {"kind": "term", "value": word(11), "occur": "'must_not'", "field": "'title'"},
        {"kind": "prefix", "value": "'the'", "occur": "'must'", "grp": "2"},
        {"kind": "term", "value": word(12), "occur": "'must'", "grp": "2"},
    ]
    rows_ = []
    for n, c in enumerate(given):
        values = plain | c | {"kind": quote(c["kind"]), "clause": str(n), "lang": "'en'"}
        rows_.append("{" + ", ".join(f"{quote(k)}: {v}" for k, v in sorted(values.items())) + "}")
    return f"""SELECT * FROM (SELECT qid, unnest(c, recursive := true) FROM (
        SELECT qid, unnest([{', '.join(rows_)}]) AS c FROM (
            SELECT item_id AS qid, regexp_extract_all(lower(text), '{PLAIN_WORD}') AS words
            FROM benchmark))) WHERE value IS NOT NULL"""


def clause_batch_ctes() -> dict:
    doc, slots = "lang, field, id, dup_no", range(3)
    same = " AND ".join(f"t{{i}}.{c} = t0.{c}" for c in ("lang", "field", "id", "dup_no"))
    keys = [f"(t{i}.pos - {i}) * 3 + {i}" for i in slots]
    ends = ", ".join(f"t{i}.pos - {i}" for i in slots)
    after = "CASE " + " ".join(
        f"WHEN {k} = least({', '.join(keys)}) THEN (t{i}.again - {i}) * 3 + {i}"
        for i, k in enumerate(keys)) + " END"
    order = " AND ".join(f"(c.words[{i + 1}] <> c.words[{j + 1}] OR t{i}.pos < t{j}.pos)"
                         for i in slots for j in slots if i < j)
    near = " AND ".join(f"abs((t{i}.pos - {i}) - t0.pos) <= c.slop" for i in (1, 2))
    others = " ".join(f"JOIN place t{i} ON t{i}.term = c.words[{i + 1}] AND {same.format(i=i)}"
                      for i in (1, 2))
    first = "JOIN place t0 ON t0.term = c.words[1] AND t0.lang = c.lang AND t0.field = c.field"
    # The distance of DuckDB is one of bytes: other signs become single bytes, alike where they are.
    bytes_ = "left(array_to_string(list_transform(range(1, 32), lambda i: chr(i::INTEGER)), ''), length(beyond))"
    swap = """list_min(list_concat([9], flatten(list_transform(range(1, length(v)),
        lambda i: list_transform(range(1, length(t)), lambda k: CASE
            WHEN substr(v, i, 1) <> substr(v, i + 1, 1)
                AND substr(t, k, 2) = substr(v, i + 1, 1) || substr(v, i, 1)
            THEN 1 + levenshtein(substr(t, 1, k - 1), substr(v, 1, i - 1))
                + levenshtein(substr(t, k + 2), substr(v, i + 2)) ELSE 9 END)))))"""
    size = "least(length(term), length(value))"
    return {
        "clause_row": _passage_clauses(),
        "clause_word": """SELECT qid, clause, lang, field, unnest(string_split(value, ' ')) AS term
            FROM clause_row WHERE kind IN ('term', 'phrase')""",
        "by_word": f"""SELECT qid, clause, lang, id, dup_no, sum({IDF} * {tf_norm()}) AS part
            FROM clause_word JOIN (SELECT qid, clause FROM clause_row WHERE kind = 'term') USING (qid, clause)
            JOIN posting USING (lang, field, term) JOIN doc_length USING ({doc})
            JOIN stats USING (lang, field) JOIN freq USING (lang, field, term)
            GROUP BY ALL""",
        "spelt": """SELECT qid, clause, lang, field, term FROM clause_row JOIN freq USING (lang, field)
            WHERE CASE kind WHEN 'prefix' THEN starts_with(term, value)
                WHEN 'wildcard' THEN term LIKE value WHEN 'regex' THEN regexp_full_match(term, value)
                WHEN 'range' THEN CASE WHEN inclusive THEN term >= value AND term <= upper
                    ELSE term > value AND term < upper END ELSE false END""",
        "by_spelling": """SELECT DISTINCT qid, clause, lang, id, dup_no, 1.0::DOUBLE AS part
            FROM spelt JOIN posting USING (lang, field, term)""",
        "met": """SELECT *, regexp_replace(value, '[\x00-\x7F]', '', 'g') AS beyond
            FROM clause_row JOIN freq USING (lang, field)
            WHERE kind = 'fuzzy' AND abs(length(term) - length(value)) <= edits""",
        "in_bytes": f"""SELECT *, translate(value, beyond, {bytes_}) AS v,
                regexp_replace(translate(term, beyond, {bytes_}), '[^\x00-\x7E]', chr(127), 'g') AS t
            FROM met""",
        "close": f"""SELECT *, least(levenshtein(t, v), {swap}) AS distance FROM in_bytes""",
        "alike": f"""SELECT *, CASE WHEN distance = 0 THEN 1.0::DOUBLE
                ELSE 1.0 - distance::DOUBLE / {size} END AS weight
            FROM close WHERE distance <= edits AND (distance = 0 OR distance < {size})""",
        "blended": """SELECT qid, clause, lang, field, term, weight,
                max(df) OVER (PARTITION BY qid, clause) AS df
            FROM (SELECT * FROM alike QUALIFY expansions IS NULL OR row_number() OVER (
                PARTITION BY qid, clause ORDER BY weight DESC, term) <= expansions)""",
        "by_nearness": f"""SELECT qid, clause, lang, id, dup_no, sum(weight * {IDF} * {tf_norm()}) AS part
            FROM blended JOIN posting USING (lang, field, term) JOIN doc_length USING ({doc})
            JOIN stats USING (lang, field) GROUP BY ALL""",
        "phrase_row": """SELECT qid, clause, lang, field, slop, string_split(value, ' ') AS words
            FROM clause_row WHERE kind = 'phrase'""",
        "phrase_weight": f"""SELECT qid, clause, sum({IDF}) AS weight FROM clause_word
            JOIN phrase_row USING (qid, clause, lang, field) JOIN freq USING (lang, field, term)
            JOIN stats USING (lang, field) GROUP BY ALL""",
        "place": f"""SELECT *, lead(pos) OVER (PARTITION BY {doc}, term ORDER BY pos) AS again
            FROM token WHERE term IN (SELECT term FROM clause_word)""",
        "in_sequence": f"""SELECT c.qid, c.clause, t0.lang, t0.field, t0.id, t0.dup_no,
                count(*)::DOUBLE AS tf
            FROM phrase_row c {first}
            JOIN place t1 ON t1.term = c.words[2] AND {same.format(i=1)} AND t1.pos = t0.pos + 1
            WHERE c.slop = 0 GROUP BY ALL""",
        "near_match": f"""SELECT c.qid, c.clause, c.slop, t0.lang, t0.field, t0.id, t0.dup_no,
                least({', '.join(keys)}) AS first, list_sort([{', '.join(keys)}])[2] AS second,
                {after} AS after, greatest({ends}) - least({ends}) AS reach
            FROM phrase_row c {first} {others} WHERE c.slop > 0 AND {near} AND {order}""",
        "nearby": f"""SELECT qid, clause, {doc}, sum(1.0::DOUBLE / (1 + reach)) AS tf FROM (
                SELECT qid, clause, {doc}, first, min(reach) AS reach, min(second) AS second,
                    any_value(after) AS after
                FROM near_match WHERE reach <= slop GROUP BY ALL)
            WHERE after IS NULL OR second < after GROUP BY ALL""",
        "by_phrase": f"""SELECT qid, clause, lang, id, dup_no, weight * {tf_norm()} AS part
            FROM (SELECT * FROM in_sequence UNION ALL BY NAME SELECT * FROM nearby)
            JOIN phrase_weight USING (qid, clause) JOIN doc_length USING ({doc})
            JOIN stats USING (lang, field)""",
        "part": """SELECT * FROM by_word UNION ALL BY NAME SELECT * FROM by_spelling
            UNION ALL BY NAME SELECT * FROM by_nearness UNION ALL BY NAME SELECT * FROM by_phrase""",
        "needed": """SELECT qid, count(DISTINCT grp) AS groups FROM clause_row
            WHERE occur = 'must' GROUP BY qid""",
    }


CLAUSE_BATCH = """SELECT qid, p.lang, id, round(sum(part * boost) FILTER (occur <> 'must_not'), 6) AS score
    FROM part p JOIN clause_row USING (qid, clause) JOIN needed USING (qid)
    GROUP BY qid, p.lang, id, dup_no, groups
    HAVING count(*) FILTER (occur = 'must_not') = 0
        AND count(DISTINCT grp) FILTER (occur = 'must') = groups"""


# --- text --------------------------------------------------------------------

def stem_cs_ctes() -> dict:
    """``stemmed_cs(term, stem)`` of the words in ``vocabulary``."""
    def case(branches):
        return "CASE " + " ".join(f"WHEN {t} THEN {v}" for t, v in branches) + " ELSE w END"

    def cut(n):
        return f"left(w, length(w) - {n})"

    case_step = case([
        (f"length(w) > {n} AND right(w, {len(e.split()[0])}) IN ({listed(e.split())})",
         cut(len(e.split()[0])))
        for n, e in stemmers.CS_CASE])
    longer, endings = stemmers.CS_POSSESSIVE
    possessive = case([(f"length(w) > {longer} AND right(w, 2) IN ({listed(endings.split())})",
                        cut(2))])
    normalize = case([
        ("w = ''", "w"),
        ("right(w, 2) = 'čt'", f"{cut(2)} || 'ck'"),
        ("right(w, 2) = 'št'", f"{cut(2)} || 'sk'"),
        ("right(w, 1) IN ('c', 'č')", f"{cut(1)} || 'k'"),
        ("right(w, 1) IN ('z', 'ž')", f"{cut(1)} || 'h'"),
        ("length(w) > 1 AND substr(w, length(w) - 1, 1) = 'e'", f"{cut(2)} || right(w, 1)"),
        ("length(w) > 2 AND substr(w, length(w) - 1, 1) = 'ů'", f"{cut(2)} || 'o' || right(w, 1)"),
    ])
    return {
        "s1": f"SELECT term, {case_step} AS w FROM (SELECT term, term AS w FROM vocabulary)",
        "s2": f"SELECT term, {possessive} AS w FROM s1",
        "stemmed_cs": f"SELECT term, {normalize} AS stem FROM s2",
    }


VOCABULARY = {"vocabulary": f"""SELECT DISTINCT unnest(
    regexp_extract_all(lower(text), '{PLAIN_WORD}')) AS term FROM documents"""}


def stem_hu_ctes() -> dict:
    """``stemmed_hu(term, stem)`` of the words in ``vocabulary``."""
    region = quote(stemmers.HU_REGION)
    ctes = {"h0": f"""
        SELECT term, term AS w, CASE WHEN regexp_matches(term, {region})
            THEN length(regexp_extract(term, {region})) ELSE length(term) END AS r
        FROM vocabulary"""}
    doubles = "|".join(stemmers.HU_DOUBLES)
    for i, (name, rules) in enumerate(stemmers.HU_RULES):
        groups = {new: s.split() for new, s in rules.items()}
        every = "|".join(s for g in groups.values() for s in g)
        ctes[f"f{i}"] = f"SELECT *, regexp_extract(w, '(?:{every})$') AS suffix FROM h{i}"
        ctes[f"g{i}"] = f"""SELECT *, left(w, length(w) - length(suffix)) AS head,
            suffix <> '' AND length(w) - length(suffix) >= r AS fits FROM f{i}"""
        if name in stemmers.HU_DOUBLE_STEPS:
            new = f"""CASE WHEN fits AND regexp_matches(head, '(?:{doubles})$')
                THEN left(head, length(head) - 2) || right(head, 1) ELSE w END"""
        elif name == "case":
            new = """CASE WHEN fits AND length(head) > r AND right(head, 1) = 'á'
                    THEN left(head, length(head) - 1) || 'a'
                WHEN fits AND length(head) > r AND right(head, 1) = 'é'
                    THEN left(head, length(head) - 1) || 'e'
                WHEN fits THEN head ELSE w END"""
        else:
            new = "CASE WHEN NOT fits THEN w " + " ".join(
                f"WHEN suffix IN ({listed(g)}) THEN head || {quote(n)}"
                for n, g in groups.items()) + " END"
        ctes[f"h{i + 1}"] = f"SELECT term, {new} AS w, r FROM g{i}"
    ctes["stemmed_hu"] = f"SELECT term, w AS stem FROM h{len(stemmers.HU_RULES)}"
    return ctes


def stem_sql(name: str, ctes: dict) -> str:
    return with_ctes(f"SELECT term, stem FROM {name}", {**VOCABULARY, **ctes})


def analyzed_ctes() -> dict:
    """The tables of the index with stop words and stems: Czech ones on English, Hungarian
    ones on German."""
    words = unicode_words("value")
    asked_words = unicode_words("value")
    asked = ("SELECT qid, lang, CASE WHEN \"at\" LIKE '%&%' THEN 1 ELSE 0 END AS in_both, "
             "unnest(fields) AS field, qtext AS value FROM (SELECT *, list_filter(["
             "CASE WHEN \"at\" LIKE '%T%' THEN 'title' END, "
             "CASE WHEN \"at\" LIKE '%t%' THEN 'text' END], lambda f: f IS NOT NULL) AS fields "
             "FROM decoded)")

    def kept(rows: str) -> str:
        return f"""SELECT * FROM ({rows}) WHERE NOT (lang = 'en' AND word IN (
            {listed(stopwords.CZECH)})) AND NOT (lang = 'de' AND word IN ({listed(stopwords.HUNGARIAN)}))"""

    stem = """CASE lang WHEN 'en' THEN c.stem ELSE h.stem END AS term"""
    stems = "JOIN stemmed_cs c ON c.term = word JOIN stemmed_hu h ON h.term = word"
    base = index_ctes("(SELECT * FROM article WHERE lang IN ('en', 'de'))")
    search = search_ctes(rows(ANALYZED), langs=["en", "de"])
    return {
        "doc": base["doc"], "field_value": base["field_value"],
        **{k: search[k] for k in ("query_row", "split_row", "decoded")},
        "word_list": f"SELECT lang, id, dup_no, field, {words} AS words FROM field_value",
        "kept_word": kept("""SELECT lang, id, dup_no, field, unnest(words) AS word,
            unnest(range(len(words))) AS pos FROM word_list"""),
        "asked_word": kept(f"SELECT qid, lang, in_both, field, unnest({asked_words}) AS word FROM ({asked})"),
        "vocabulary": "SELECT word AS term FROM kept_word UNION SELECT word FROM asked_word",
        **stem_cs_ctes(), **stem_hu_ctes(),
        "token": f"SELECT lang, id, dup_no, field, {stem}, pos FROM kept_word {stems}",
        "query_term": f"SELECT qid, lang, in_both = 1 AS in_both, field, {stem} FROM asked_word {stems}",
        **{k: base[k] for k in ("posting", "doc_length", "stats", "freq")},
        **{k: search[k] for k in ("scored", "hit")},
    }


def unicode_words(column: str) -> str:
    """Words by Unicode word breaks: blanks are put where classes part, then what is left
    between blanks is cut."""
    cut = f"lower({column})"
    for pattern, new in (
            (f"([{SIGNS}][{EXTEND}]*)", r" \1 "), (f"([{KATAKANA}][{EXTEND}]*)([^{KATAKANA}{EXTEND}_])", r"\1 \2"),
            (f"([^{KATAKANA}{EXTEND}_][{EXTEND}]*)([{KATAKANA}])", r"\1 \2")):
        cut = f"regexp_replace({cut}, {quote(pattern)}, {quote(new)}, 'g')"
    letters, digits = rf"(?:\p{{L}}[{EXTEND}]*)+", rf"(?:\p{{N}}[{EXTEND}]*)+"
    kana = rf"[{KATAKANA}][{EXTEND}]*"
    word = (rf"(?:{letters}(?:[{MID_LETTER}][{EXTEND}]*{letters})*|"
            rf"{digits}(?:[{MID_NUMBER}][{EXTEND}]*{digits})*|(?:{kana})+|_+)+")
    return (f"list_filter(regexp_extract_all({cut}, {quote(EMOJI_WORD + '|' + word)}), "
            "lambda w: trim(w, '_') <> '')")


def words_sql(words: str) -> str:
    return f"""SELECT doc_id, CAST(len(words) AS BIGINT) AS n,
        coalesce(array_to_string(words, ' '), '') AS words
        FROM (SELECT doc_id, {words} AS words FROM documents)"""


def decoded_entities(column: str) -> str:
    for entity, sign in ENTITIES:
        column = f"replace({column}, {quote(entity)}, {quote(sign)})"
    return column


def plain_markup() -> str:
    """The text of an article whose lines were marked up, without the markup."""
    lines = f"string_split(translate(text, {quote(MARKUP_SIGNS)}, repeat(' ', {len(MARKUP_SIGNS)})), chr(10))"
    joined = f"""array_to_string(list_transform({lines}, lambda line, i: CASE (i - 1) % 5
        WHEN 3 THEN line || ' ' || lang WHEN 4 THEN line || ' ' || lang ELSE line END), chr(10))"""
    single = f"regexp_replace({joined}, '[ \\t]+', ' ', 'g')"
    return f"trim(regexp_replace({single}, '\\n{{3,}}', chr(10) || chr(10), 'g'))"


def articles_sql() -> str:
    body = "regexp_replace(html, '(?s)<!--.*?-->', ' ', 'g')"
    for element in HTML_DROPPED:
        body = f"regexp_replace({body}, '(?is)<{element}\\b[^>]*>.*?</{element}>', ' ', 'g')"
    body = decoded_entities(f"regexp_replace({body}, '<[^>]*>', ' ', 'g')")
    title = decoded_entities("regexp_extract(html, '(?is)<title>(.*?)</title>', 1)")
    return f"""SELECT CAST(page_id AS VARCHAR) AS id,
        lower(regexp_extract(html, '(?i)<html[^>]*\\blang="([^"]+)"', 1)) AS lang, url,
        trim({title}) AS title, trim(regexp_replace({body}, '\\s+', ' ', 'g')) AS text
        FROM pages"""


# --- title dictionary --------------------------------------------------------

TITLES = {
    "usable": """SELECT ll_from, ll_lang, regexp_replace(ll_title, '^[^:]*:', '') AS title
        FROM langlinks WHERE regexp_replace(ll_title, '^[^:]*:', '') <> ''""",
    "dictionary": """SELECT row_number() OVER (ORDER BY d.ll_from) AS dict_id,
        replace(p.page_title, '_', ' ') AS en_title, de_title, fr_title
        FROM (SELECT ll_from, min(title) AS de_title FROM usable WHERE ll_lang = 'de' GROUP BY 1) d
        JOIN (SELECT ll_from, min(title) AS fr_title FROM usable WHERE ll_lang = 'fr' GROUP BY 1) f
            ON d.ll_from = f.ll_from
        JOIN page p ON p.lang = 'en' AND p.page_id = d.ll_from""",
    "long_title": """SELECT dict_id, 'en' AS lang, en_title AS title FROM dictionary
        UNION ALL SELECT dict_id, 'de', de_title FROM dictionary
        UNION ALL SELECT dict_id, 'fr', fr_title FROM dictionary""",
    "title_token": f"""SELECT DISTINCT lang, dict_id, unnest(regexp_extract_all(
        translate(lower(title), '{ACCENTED}', '{UNACCENTED}'), '{PLAIN_WORD}')) AS token
        FROM long_title""",
    "asked_token": """SELECT * FROM (VALUES (1, 'en', 'the'), (1, 'en', 'that'), (2, 'de', 'der'),
        (2, 'de', 'und'), (3, 'fr', 'etion'), (3, 'fr', 'la')) AS t(qid, lang, token)""",
    "ranked": """SELECT CAST(qid AS BIGINT) AS qid, lang, dict_id, count(*) AS matched,
        row_number() OVER (PARTITION BY qid ORDER BY count(*) DESC, dict_id) AS n
        FROM asked_token JOIN title_token USING (lang, token) GROUP BY qid, lang, dict_id""",
}


def over_titles(body: str) -> str:
    return over_links(body, TITLES)


ASKED_TITLES = """SELECT num_id AS qid, concat(
        CASE source WHEN 'src8' THEN upper(lang) ELSE lang END, ':',
        CASE source WHEN 'src1' THEN 't' WHEN 'src2' THEN 'T&t' WHEN 'src3' THEN 't&T'
            WHEN 'src4' THEN 'T|t' WHEN 'src5' THEN 't|T' WHEN 'src6' THEN 'Q' ELSE 'T' END, ':',
        CASE source WHEN 'src9' THEN '' WHEN 'src10' THEN title || ':more'
            WHEN 'src12' THEN ':' || title ELSE title END) AS q FROM article"""


# --- all of them -------------------------------------------------------------

def build() -> dict[str, str]:
    triple_rows = "SELECT en_id, de_id, fr_id FROM triples"
    missing = " UNION ALL ".join(
        f"""SELECT t.*, '{lang}' AS lang FROM triples t WHERE {lang}_id NOT IN
            (SELECT id FROM corpus WHERE lang = '{lang}')""" for lang in LANGS)
    asked = search_ctes(ASKED_TITLES)
    passages = search_ctes("SELECT item_id AS qid, 'en:T|t:' || text AS q FROM benchmark",
                           langs=ALL)
    lines = """SELECT qid, n, concat(n, '. ', CASE lang
        WHEN 'en' THEN concat(en_title, ' (en) = ', de_title, ' (de) = ', fr_title, ' (fr)')
        WHEN 'de' THEN concat(de_title, ' (de) = ', en_title, ' (en) = ', fr_title, ' (fr)')
        ELSE concat(fr_title, ' (fr) = ', en_title, ' (en) = ', de_title, ' (de)') END) AS line
        FROM ranked JOIN dictionary USING (dict_id)"""
    stop = " ".join(
        f"WHEN '{lang}' THEN list_filter(words, lambda w: w NOT IN ({listed(words)}))"
        for lang, words in (("en", stopwords.CZECH), ("de", stopwords.HUNGARIAN)))
    return {
        "scan_links_by_lang": over_links(
            "SELECT ll_from, ll_title FROM langlinks WHERE ll_lang = 'de'"),
        "normalize_links": over_links(
            "SELECT ll_from, lang, ll_title, title_key FROM keyed WHERE title_key <> ''"),
        "resolve_links": over_links("SELECT pivot_id, lang, target_id FROM pairs"),
        "unresolved_links": over_links("""
            SELECT ll_from, k.lang, ll_title,
                CASE WHEN title_key = '' THEN 'Title missing' ELSE 'No page_id' END AS reason
            FROM keyed k LEFT JOIN title_ids t ON k.lang = t.lang AND k.title_key = t.page_title
            WHERE title_key = '' OR target_id IS NULL"""),
        "pivot_join": over_links(triple_rows),
        "pivot_join_nway": over_links("""
            SELECT en_id, de_id, fr_id, target_id AS es_id FROM triples
            JOIN pairs ON pivot_id = en_id WHERE lang = 'es'"""),
        "id_map": over_links("SELECT lang, id, other_lang, other_id FROM id_map"),
        "missing_triples": over_links(missing),
        "complete_triples": over_links("SELECT * FROM complete"),
        "complete_triples_except": over_links("SELECT * FROM complete"),
        "extract_documents": over_links("SELECT lang, id, title, text FROM extracted"),
        "corpus_counts": over_links("SELECT lang, count(*) AS n_docs FROM extracted GROUP BY lang"),
        "extract_articles": articles_sql(),
        "strip_wiki": over_links(f"SELECT id, {plain_markup()} AS text FROM article"),
        "extract_dump": over_links(f"""
            SELECT id, CAST(num_id + 1 AS VARCHAR) AS revid, 'https://en.example.org/' || id AS url,
                {plain_markup()} AS text
            FROM article WHERE source NOT IN ('src2', 'src3')"""),
        "csv_roundtrip": over_links(triple_rows),
        "jsonl_articles": over_links("""
            SELECT lang, id, 'r' || id AS revid, '/' || lang || '/' || id AS url, title, text
            FROM article"""),
        "jsonl_documents": over_links("SELECT lang, id, title, text FROM extracted"),
        "id_map_json": over_links("SELECT lang, id, other_lang, other_id FROM id_map"),
        "tokenize": words_sql(f"regexp_extract_all(lower(text), '{PLAIN_WORD}')"),
        "tokenize_standard": words_sql(unicode_words("text")),
        "stopwords": f"""SELECT doc_id, coalesce(array_to_string(
            CASE lang {stop} ELSE words END, ' '), '') AS words
            FROM (SELECT doc_id, lang, regexp_extract_all(lower(text), '{PLAIN_WORD}') AS words
                FROM documents)""",
        "stem_cs": stem_sql("stemmed_cs", stem_cs_ctes()),
        "stem_hu": stem_sql("stemmed_hu", stem_hu_ctes()),
        "fold_accents": over_links(
            f"SELECT id, translate(lower(title), '{ACCENTED}', '{UNACCENTED}') AS folded "
            "FROM article"),
        "postings": over_index("""SELECT lang, field, term, id, tf,
            array_to_string(positions, ',') AS positions FROM posting"""),
        "doc_freq": over_index("SELECT lang, field, term, df FROM freq"),
        "doc_lengths": over_index("SELECT lang, field, id, dl FROM doc_length"),
        "field_stats": over_index(
            "SELECT lang, field, n_docs, round(avgdl, 6) AS avgdl FROM stats"),
        "index_roundtrip": over_index("""
            SELECT lang, field, term, id, count(*) AS copies, min(tf) AS tf, min(dl) AS dl
            FROM posting JOIN doc_length USING (lang, field, id, dup_no)
            GROUP BY lang, field, term, id""", "extracted"),
        "index_analyzed": over_links("""SELECT lang, field, term, id, tf, dl,
            array_to_string(positions, ',') AS positions
            FROM posting JOIN doc_length USING (lang, field, id, dup_no)""", analyzed_ctes()),
        "search_analyzed": over_links("""SELECT CAST(qid AS BIGINT) AS qid,
            CAST(rank AS BIGINT) AS rank, lang, id, score FROM hit""", analyzed_ctes()),
        "lookup_id": over_links("""
            SELECT DISTINCT a.lang, a.id, title, text FROM article a
            JOIN pairs p ON a.lang = p.lang AND a.id = p.target_id"""),
        "decode_queries": over_links('SELECT qid, lang, "at", qtext FROM decoded', asked),
        "validate_queries": over_links(f"SELECT qid, {valid()} AS reason FROM split_row", asked),
        "search_title": one_search("en:T:the that"),
        "search_text": one_search("en:t:the that then"),
        "search_title_and_text": one_search("en:T&t:there with the"),
        "search_title_or_text": one_search("de:t|T:der und der nicht"),
        "bm25_scores": one_search("en:T|t:the that", SCORES),
        "bm25_exact": one_search("en:T|t:the that", SCORES, "dl"),
        "accent_sensitive": over_index(SCORES, more=search_ctes(
            rows([(1, "fr:t:étion"), (2, "fr:t:etion")]), langs=ALL)),
        "search_batch": over_index("SELECT qid, rank, id, score FROM hit", more=passages),
        "search_pruned": over_index("SELECT qid, rank, id, score FROM hit", more=search_ctes(
            f"""SELECT item_id AS qid, 'en:T|t:' || array_to_string(
                regexp_extract_all(lower(text), '{PLAIN_WORD}')[1:3], ' ') AS q FROM benchmark""",
            langs=ALL)),
        "index_update": over_index("""
            SELECT lang, field, term, id, tf, dl, df, ttf, n_docs, tf AS weight_tf,
                round(avgdl, 6) AS avgdl
            FROM posting JOIN doc_length USING (lang, field, id, dup_no)
            JOIN freq USING (lang, field, term) JOIN stats USING (lang, field)
            JOIN (SELECT lang, field, term, CAST(sum(tf) AS BIGINT) AS ttf FROM posting GROUP BY ALL)
                USING (lang, field, term)""", "changed"),
        "search_batch_large": over_index("SELECT qid, rank, id, score FROM hit", more=passages),
        "search_same_qid": over_index(
            "SELECT CAST(rank AS BIGINT) AS rank, lang, id, score FROM hit", "renumbered",
            search_ctes(rows(SAME_QID), langs=ALL)),
        "known_lang": over_links(f"""SELECT qid, CASE WHEN lower(parts[1]) IN ({listed(LANGS)})
            THEN lower(parts[1]) END AS lang FROM split_row""", asked),
        "cross_search": over_translations(
            "SELECT qid, rank, score, pos, lang, id, title FROM translated"),
        "expand_translations": over_links(f"""
            SELECT w.qid, CAST(w.pos AS BIGINT) AS pos, w.lang, w.id, title, text FROM (
                SELECT num_id AS qid, 0 AS pos, lang, id FROM article WHERE lang IN ({listed(LANGS)})
                UNION ALL SELECT num_id, row_number() OVER (PARTITION BY num_id
                    ORDER BY list_position(['en', 'de', 'fr'], other_lang)), other_lang, other_id
                FROM article JOIN id_map USING (lang, id)) w
            LEFT JOIN article a ON a.lang = w.lang AND a.id = w.id"""),
        "result_json": over_translations("""
            SELECT qid, '{"searchResult":[' || string_agg(hit, ',' ORDER BY rank) || ']}' AS json
            FROM (SELECT qid, rank, '{' || string_agg(concat(
                    '"', lang, '":{"id":', to_json(id),
                    CASE WHEN title IS NULL THEN '' ELSE concat(',"title":', to_json(title)) END,
                    CASE WHEN text IS NULL THEN '' ELSE concat(',"text":', to_json(text)) END,
                    '}'), ',' ORDER BY pos) || '}' AS hit FROM translated GROUP BY qid, rank)
            GROUP BY qid"""),
        "result_lines": over_translations("""
            SELECT qid, rank, pos, concat_ws(' ', id, upper(lang), title) AS line
            FROM translated"""),
        **{name: clauses_sql(name) for name in CLAUSES},
        "clause_batch": over_index(CLAUSE_BATCH, more=clause_batch_ctes()),
        "title_dictionary": over_titles("SELECT * FROM dictionary"),
        "title_token_index": over_titles(f"""
            SELECT lang, token, dict_id // {BLOCK} AS block,
                string_agg(CAST(dict_id AS VARCHAR), ',' ORDER BY dict_id) AS ids
            FROM title_token GROUP BY ALL"""),
        "title_search": over_titles("SELECT qid, n, dict_id, matched FROM ranked"),
        "title_lines": over_titles(lines),
    }
