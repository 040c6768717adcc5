"""Title keys, accent folding and word segmentation as Spark columns."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accented letters of the three languages and their base letters.
ACCENTED = "áäčďéěíĺľňóöőôŕřšťúůüűýž"
UNACCENTED = "aacdeeillnoooorrstuuuuyz"

# What joins letters (L) or digits (N) into one word.
MID_LETTER = "'’.:·"
MID_NUMBER = "'’.,;"

#: Runs of letters, marks and digits. Same language in Java and RE2 syntax.
PLAIN_WORD = r"[\p{L}\p{M}\p{N}]+"


# Classes of word breaks, as the inside of character classes. Signs of Han and
# Hiragana are words each; Katakana joins with Katakana only; other letters, Hangul among them,
# join with letters and digits; underscores join any of them. Marks and joiners go with what
# stands before them.
SIGNS = r"\x{3041}-\x{3096}\x{309D}-\x{309F}\x{3400}-\x{4DBF}\x{4E00}-\x{9FFF}\x{F900}-\x{FAFF}\x{20000}-\x{2FA1F}"
KATAKANA = (r"\x{3031}-\x{3035}\x{309B}\x{309C}\x{30A0}-\x{30FA}\x{30FC}-\x{30FF}"
            r"\x{31F0}-\x{31FF}\x{FF66}-\x{FF9D}")
EXTEND = r"\p{M}\x{AD}\x{200C}\x{200D}\x{2060}"
# Pictographs that are shown as emoji, those that are if a selector follows,
# regional letters (two are a flag), skin tones, signs of a key cap, tags.
EMOJI = (r"\x{231A}\x{231B}\x{23E9}-\x{23EC}\x{23F0}\x{23F3}\x{25FD}\x{25FE}\x{2614}\x{2615}"
         r"\x{2648}-\x{2653}\x{267F}\x{2693}\x{26A1}\x{26AA}\x{26AB}\x{26BD}\x{26BE}\x{26C4}\x{26C5}"
         r"\x{26CE}\x{26D4}\x{26EA}\x{26F2}\x{26F3}\x{26F5}\x{26FA}\x{26FD}\x{2705}\x{270A}\x{270B}"
         r"\x{2728}\x{274C}\x{274E}\x{2753}-\x{2755}\x{2757}\x{2795}-\x{2797}\x{27B0}\x{27BF}\x{2B1B}"
         r"\x{2B1C}\x{2B50}\x{2B55}\x{1F004}\x{1F0CF}\x{1F18E}\x{1F191}-\x{1F19A}\x{1F201}\x{1F21A}"
         r"\x{1F22F}\x{1F232}-\x{1F236}\x{1F238}-\x{1F23A}\x{1F250}\x{1F251}\x{1F300}-\x{1F3FA}"
         r"\x{1F400}-\x{1F64F}\x{1F680}-\x{1F6FF}\x{1F7E0}-\x{1F7EB}\x{1F90C}-\x{1F9FF}\x{1FA70}-\x{1FAFF}")
PICTOGRAPH = EMOJI + (r"\x{A9}\x{AE}\x{203C}\x{2049}\x{2122}\x{2139}\x{2194}-\x{21AA}\x{2300}-\x{23FF}"
                      r"\x{24C2}\x{25AA}-\x{27BF}\x{2934}\x{2935}\x{2B05}-\x{2B07}\x{3030}\x{303D}")
#: What an emoji can begin with, and more.
EMOJI_BEGIN = r"0-9#*\x{A9}\x{AE}\x{2000}-\x{10FFFF}"
# Small Latin letters, ASCII signs with which no word begins.
LATIN = r"a-z\x{DF}-\x{F6}\x{F8}-\x{FF}"
NO_BEGIN = r"\x00-\x22\x24-\x29\x2B-\x2F\x3A-\x40\x5B-\x5E\x60\x7B-\x7F"
REGIONAL, TONES, TAGS = r"\x{1F1E6}-\x{1F1FF}", r"\x{1F3FB}-\x{1F3FF}", r"\x{E0020}-\x{E007F}"

#: An emoji with what belongs to it: a tone, tags, others joined to it; a flag; a key cap.
EMOJI_WORD = (
    rf"[{REGIONAL}]{{2}}|[0-9#*]\x{{FE0F}}?\x{{20E3}}"
    rf"|(?:[{EMOJI}]\x{{FE0F}}?|[{PICTOGRAPH}]\x{{FE0F}})[{TONES}]?[{TAGS}]*"
    rf"(?:\x{{200D}}[{PICTOGRAPH}]\x{{FE0F}}?[{TONES}]?)*")


def _unicode_word() -> str:
    """Words by Unicode word breaks, for Java: possessive, so that a very long word cannot
    exhaust the stack."""
    extend = rf"[{EXTEND}]*+"
    # Latin letters are named as well, as these are found without a search through the rest.
    letters = rf"(?:[{LATIN}[\p{{L}}&&[^{SIGNS}{KATAKANA}]]]{extend})++"
    digits = rf"(?:\p{{N}}{extend})++"
    words = rf"{letters}(?:[{MID_LETTER}]{extend}{letters})*+"
    numbers = rf"{digits}(?:[{MID_NUMBER}]{extend}{digits})*+"
    part = rf"(?:(?:{words}|{numbers})++|(?:[{KATAKANA}]{extend})++)"
    whole = rf"(?=[{EMOJI_BEGIN}])(?:{EMOJI_WORD})|[{SIGNS}]{extend}|_*+{part}(?:_++{part})*+_*+"
    # Most words are Latin letters before a blank or a sign that ends a clause, and most other
    # places ASCII signs with which no word begins: both are told before the rest is tried.
    return rf"[{LATIN}]++(?=[.,;:!?]*+(?:\s|\z))|(?![{NO_BEGIN}])(?:{whole})"


UNICODE_WORD = _unicode_word()

#: By default longer words are cut into pieces of this many characters; nothing is lost.
MAX_WORD_LENGTH = 255


def strip_prefix(title: Column, namespaces=None) -> Column:
    """Text after the first colon; a title without a colon is kept.

    With ``namespaces`` only those prefixes are removed.
    """
    parts = F.split(title, ":", 2)
    rest = F.element_at(parts, -1)
    if namespaces is None:
        return rest
    return F.when(parts[0].isin(list(namespaces)), rest).otherwise(title)


def title_key(title: Column, namespaces=None) -> Column:
    """Link title in the spelling of the page table."""
    return F.replace(strip_prefix(title, namespaces), F.lit(" "), F.lit("_"))


def fold_accents(text: Column) -> Column:
    """Lower case without the accents of the three languages."""
    return F.translate(F.lower(text), ACCENTED, UNACCENTED)


def plain_words(text: Column) -> Column:
    """Lower-cased runs of letters and digits, in order."""
    return F.regexp_extract_all(F.lower(text), F.lit(PLAIN_WORD), F.lit(0))


def unicode_words(text: Column, longest: int = MAX_WORD_LENGTH) -> Column:
    """Lower-cased words by Unicode word breaks, in order, of at most ``longest`` characters.

    Emoji, with what is joined to them, are words.
    """
    # A second pass over every word only where one is too long: cutting inside
    # the pattern would make it backtrack.
    def cut(words):
        pieces = F.flatten(F.transform(
            words,
            lambda w: F.regexp_extract_all(w, F.lit(f"(?s).{{1,{longest}}}"), F.lit(0)),
        ))
        return F.when(F.exists(words, lambda w: F.length(w) > longest), pieces).otherwise(words)

    # As the one element of an array the words are worked out once, however often they are named.
    words = F.regexp_extract_all(F.lower(text), F.lit(UNICODE_WORD), F.lit(0))
    return F.get(F.transform(F.array(words), cut), F.lit(0))
