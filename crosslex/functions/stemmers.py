"""Light Czech and Snowball Hungarian stemming as steps of column expressions.

Each stemmer is a list of steps, a step being a function from a word column to a
word column. A step tests word endings with plain string comparisons, so it needs
no pattern matching; the steps are applied one after the other by
:func:`apply_steps` or, over arrays, by one ``transform`` per step, which keeps a
step's result from being spelled out many times inside the next one.
"""

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def _ends(word: Column, endings) -> Column:
    size = len(endings[0])
    return F.right(word, F.lit(size)).isin(list(endings))


def _cut(word: Column, size: int) -> Column:
    return F.left(word, F.length(word) - size)


# --- Czech (Dolamic and Savoy, light stemmer) --------------------------------

# Case endings, as (word must be longer than, endings).
CS_CASE = [
    (7, "atech"),
    (6, "ětem etem atům"),
    (5, "ech ich ích ého ěmi emi ému ěte ete ěti eti ího iho ími ímu imu ách ata "
        "aty ých ama ami ové ovi ými"),
    (4, "em es ém ím ům at ám os us ým mi ou"),
    (3, "a e i o u ů y á é í ý ě"),
]

# Possessive endings, for words longer than five letters.
CS_POSSESSIVE = (5, "ov in ův")


def _cs_case(word: Column) -> Column:
    out = None
    for longer_than, endings in CS_CASE:
        endings = endings.split()
        test = (F.length(word) > longer_than) & _ends(word, endings)
        stem = _cut(word, len(endings[0]))
        out = F.when(test, stem) if out is None else out.when(test, stem)
    return out.otherwise(word)


def _cs_possessive(word: Column) -> Column:
    longer_than, endings = CS_POSSESSIVE
    test = (F.length(word) > longer_than) & _ends(word, endings.split())
    return F.when(test, _cut(word, 2)).otherwise(word)


def _cs_normalize(word: Column) -> Column:
    size = F.length(word)
    before_last = F.substring(word, size - 1, F.lit(1))
    head = F.left(word, size - 2)
    last = F.right(word, F.lit(1))
    return (
        F.when(size == 0, word)
        .when(_ends(word, ["čt"]), F.concat(_cut(word, 2), F.lit("ck")))
        .when(_ends(word, ["št"]), F.concat(_cut(word, 2), F.lit("sk")))
        .when(last.isin("c", "č"), F.concat(_cut(word, 1), F.lit("k")))
        .when(last.isin("z", "ž"), F.concat(_cut(word, 1), F.lit("h")))
        .when((size > 1) & (before_last == "e"), F.concat(head, last))
        .when((size > 2) & (before_last == "ů"), F.concat(head, F.lit("o"), last))
        .otherwise(word)
    )


CZECH_STEPS = [_cs_case, _cs_possessive, _cs_normalize]


# --- Hungarian (Snowball) ----------------------------------------------------

# Vowels, digraphs, double consonants.
HU_VOWELS = "aeiouáéíóöőúüű"
HU_DIGRAPHS = "dzs cs gy ly ny sz ty zs".split()
HU_DOUBLES = ("bb cc ccs dd ff gg ggy jj kk ll lly mm nn nny pp rr ss ssz tt tty "
              "vv zz zzs").split()

# The nine steps in order, as suffix lists by what replaces the
# suffix. ``double`` steps need a double consonant before the suffix and then
# simplify it; the ``case`` step also shortens a final á or é that it uncovers.
HU_RULES = [
    ("instrumental", {"": "al el"}),
    ("case", {"": "ban ben ba be ra re nak nek val vel tól től ról ről ból ből hoz "
                  "hez höz nál nél ig at et ot öt ért képp képpen kor ul ül vá vé "
                  "onként enként anként ként en on an ön n t"}),
    ("special case", {"e": "én", "a": "án ánként"}),
    ("other case", {"": "astul estül stul stül", "a": "ástul", "e": "éstül"}),
    ("factive", {"": "á é"}),
    ("owned", {"": "oké öké aké eké ké éi é", "e": "éké ééi éé", "a": "áké áéi"}),
    ("singular owner", {"": "ünk unk nk juk jük uk ük em om am m od ed ad öd d ja je "
                            "a e o",
                        "a": "ánk ájuk ám ád á", "e": "énk éjük ém éd é"}),
    ("plural owner", {"": "jaim jeim aim eim im jaid jeid aid eid id jai jei ai ei i "
                          "jaink jeink eink aink ink jaitok jeitek aitok eitek itek "
                          "jeik jaik aik eik ik",
                      "a": "áim áid ái áink áitok áik",
                      "e": "éim éid éi éink éitek éik"}),
    ("plural", {"": "ök ok ek ak k", "a": "ák", "e": "ék"}),
]
HU_DOUBLE_STEPS = {"instrumental", "factive"}

# First vowel/consonant transition; the suffix region starts after it.
HU_REGION = (
    f"^(?:[{HU_VOWELS}]+(?:{'|'.join(HU_DIGRAPHS)}|[^{HU_VOWELS}])"
    f"|[^{HU_VOWELS}]+[{HU_VOWELS}])"
)


#: Stands at the start of the suffix region while a word is being stemmed.
BAR = "|"
#: Follows an á or é that is to be shortened.
TAG = "\t"


def hu_mark_region(word: Column) -> Column:
    """The word with a bar where the region of its suffixes starts."""
    marked = F.regexp_replace(word, HU_REGION, "$0" + BAR)
    return F.when(marked == word, F.concat(word, F.lit(BAR))).otherwise(marked)


def _across_bar(suffix: str) -> list[str]:
    return [re.escape(suffix[:i] + BAR + suffix[i:]) for i in range(1, len(suffix))]


def _hu_step(name: str, rules: dict):
    """One step on a marked word.

    The longest suffix decides, even where it reaches across the bar and nothing
    happens; that is what the look-behind at the end checks.
    """
    groups = {new: suffixes.split() for new, suffixes in rules.items()}
    every = [s for group in groups.values() for s in group]
    across = "|".join(form for s in every for form in _across_bar(s))
    guard = f"(?<!{across})" if across else ""

    if name in HU_DOUBLE_STEPS:
        doubles = "|".join(
            form for d in HU_DOUBLES
            for form in [d, *_across_bar(d), re.escape(d + BAR)])
        pattern = (rf".(\|?)(.)(\|?)(?=(?:{'|'.join(every)})$)(?<={doubles})"
                   rf"(?:{'|'.join(every)})$")
        return lambda word: F.regexp_replace(word, pattern, "$1$2$3")

    def ends(suffixes):
        # Most words end in none of the last letters and need no further search.
        return rf"(?=[^|]*[{''.join(sorted({x[-1] for x in suffixes}))}]$)"

    def any_of(suffixes):
        return f"(?:{'|'.join(suffixes)})"

    shorten = cut = None
    if "a" in groups:
        # These suffixes begin with á or é, which stays, short. The tag left behind
        # keeps the suffixes that are cut from matching as well.
        rests = {new: any_of(s[1:] for s in groups[new]) for new in "ae"}
        shorten = (rf"\|{ends(groups['a'] + groups['e'])}(.*?)"
                   rf"(?:(á){rests['a']}|(é){rests['e']})${guard}")
    if "" in groups:
        cut = rf"\|{ends(groups[''])}(.*?){any_of(groups[''])}${guard}"

    def step(word: Column) -> Column:
        if shorten:
            word = F.regexp_replace(word, shorten, f"{BAR}$1$2$3{TAG}")
        if cut:
            word = F.regexp_replace(word, cut, f"{BAR}$1" + (TAG if name == "case" else ""))
        word = F.replace(word, F.lit("á" + TAG), F.lit("a"))
        word = F.replace(word, F.lit("é" + TAG), F.lit("e"))
        return F.replace(word, F.lit(TAG), F.lit(""))

    return step


HUNGARIAN_STEPS = [_hu_step(name, rules) for name, rules in HU_RULES]


# --- application -------------------------------------------------------------

def stem_array(words: Column, language: str) -> Column:
    """Stem an array of lower-cased words, keeping order and length."""
    if language == "czech":
        for step in CZECH_STEPS:
            words = F.transform(words, step)
        return words
    if language == "hungarian":
        words = F.transform(words, hu_mark_region)
        for step in HUNGARIAN_STEPS:
            words = F.transform(words, step)
        return F.transform(words, lambda w: F.replace(w, F.lit(BAR), F.lit("")))
    raise ValueError(f"no stemmer for {language!r}")


def stem(word: Column, language: str) -> Column:
    """Stem one lower-cased word."""
    return stem_array(F.array(word), language)[0]


# --- one word in Python ------------------------------------------------------

def word_stemmer(language: str):
    """The same stemmer for one word at a time, for tasks that stem distinct words only.

    All it needs is in the function returned, which so can be sent to Python workers.
    """
    if language == "czech":
        return _czech_stemmer()
    if language == "hungarian":
        return _hungarian_stemmer()
    raise ValueError(f"no stemmer for {language!r}")


def _czech_stemmer():
    cases = [(n, len(e.split()[0]), tuple(e.split())) for n, e in CS_CASE]
    longer_than, owners = CS_POSSESSIVE[0], tuple(CS_POSSESSIVE[1].split())

    def stem_word(word):
        size = len(word)
        for least, cut, endings in cases:
            if size > least and word.endswith(endings):
                word = word[:-cut]
                break
        if len(word) > longer_than and word.endswith(owners):
            word = word[:-2]
        if word.endswith("čt"):
            return word[:-2] + "ck"
        if word.endswith("št"):
            return word[:-2] + "sk"
        if word.endswith(("c", "č")):
            return word[:-1] + "k"
        if word.endswith(("z", "ž")):
            return word[:-1] + "h"
        if len(word) > 1 and word[-2] == "e":
            return word[:-2] + word[-1]
        if len(word) > 2 and word[-2] == "ů":
            return word[:-2] + "o" + word[-1]
        return word

    return stem_word


def _hungarian_stemmer():
    def with_bars(form):
        return [form[:i] + BAR + form[i:] for i in range(1, len(form))]

    def by_size(suffixes):
        return [(n, tuple(s for s in suffixes if len(s) == n))
                for n in sorted({len(s) for s in suffixes}, reverse=True)]

    region = re.compile(HU_REGION)
    doubles = tuple(form for d in HU_DOUBLES for form in [d, *with_bars(d), d + BAR])
    steps = []
    for name, rules in HU_RULES:
        groups = {new: suffixes.split() for new, suffixes in rules.items()}
        every = [s for group in groups.values() for s in group]
        # Suffixes that keep their first letter, and those that go, by their sizes.
        steps.append((name, tuple(every), tuple(b for s in every for b in with_bars(s)),
                      by_size([*groups.get("a", []), *groups.get("e", [])]),
                      by_size(groups.get("", []))))
    double_steps, bar = frozenset(HU_DOUBLE_STEPS), BAR

    def simplified(word, every):
        """Without the suffix and the first of the two consonants before it."""
        if not word.endswith(every):
            return word
        head = word[:-len(every[0])]
        if not head.endswith(doubles):
            return word
        first = 3 if bar in head[-2:] else 2
        return head[:-first] + head[len(head) - first + 1:]

    def stem_word(word):
        found = region.match(word)
        at = found.end() if found else len(word)
        word = word[:at] + bar + word[at:]
        for name, every, across, shortened, gone in steps:
            if not word.endswith(every):
                continue
            if name in double_steps:
                word = simplified(word, every)
                continue
            if word.endswith(across):
                continue
            kept = next((n for n, suffixes in shortened if word.endswith(suffixes)), 0)
            cut = next((n for n, suffixes in gone if word.endswith(suffixes)), 0)
            if kept:
                word = word[:-kept] + ("a" if word[-kept] == "á" else "e")
            elif cut:
                word = word[:-cut]
                if name == "case" and word[-1] in "áé":
                    word = word[:-1] + ("a" if word[-1] == "á" else "e")
        return word.replace(bar, "")

    return stem_word
