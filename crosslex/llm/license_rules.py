"""Signature rules for licence statements, in order of their priority.

A rule has a label, a keyword that a text must hold before the rule is tried, a
pattern and a priority. Whatever a pattern matches holds the rule's keywords, each a part
of one word, as there may be anything between words. Most rules come from a few hand-written forms in which
licences are stated (tag, address, sentence, notice), filled with the names of the
licences; a licence with versions has rules for each version and some without.
"""

import re
from dataclasses import dataclass

#: What a word is made of, inside a character class: digits, letters, all beyond ASCII.
WORD_CHARS = r"0-9A-Za-z\x80-\x{10FFFF}"
GAP = rf"[^{WORD_CHARS}]+"
START, END = rf"(?<![{WORD_CHARS}])", rf"(?![{WORD_CHARS}])"


@dataclass(frozen=True)
class Rule:
    label: str
    keyword: str
    also: str  # a second keyword, asked for where the first one was found
    pattern: str
    priority: int
    base: int = 0  # words of the phrase for the phrases that are always reported


def words(phrase: str) -> str:
    """Pattern for the phrase's words standing consecutively, in either case of A-Z."""
    return "(?i)" + START + GAP.join(phrase.split(" ")) + END


# Phrases that are always reported, and their labels.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
BASE_KEYWORDS = {"cc by": "cc", "general public license": "licen", "all rights reserved": "reserved"}

# Public licence names as they stand in running text, and their versions.
FAMILIES = {
    "apache": (["apache"], ["1.0", "1.1", "2.0"]),
    "gpl": (["gnu gpl", "gpl", "general public license"], ["1.0", "2.0", "3.0"]),
    "lgpl": (["lgpl", "lesser general public license", "library general public license"],
             ["2.0", "2.1", "3.0"]),
    "agpl": (["agpl", "affero general public license"], ["1.0", "3.0"]),
    "gfdl": (["gfdl", "gnu free documentation license"], ["1.1", "1.2", "1.3"]),
    "mpl": (["mpl", "mozilla public license"], ["1.0", "1.1", "2.0"]),
    "epl": (["epl", "eclipse public license"], ["1.0", "2.0"]),
    "cddl": (["cddl", "common development and distribution license"], ["1.0", "1.1"]),
    "cpl": (["cpl", "common public license"], ["1.0"]),
    "eupl": (["eupl", "european union public licence"], ["1.0", "1.1", "1.2"]),
    "afl": (["afl", "academic free license"], ["1.1", "2.0", "2.1", "3.0"]),
    "osl": (["osl", "open software license"], ["1.0", "2.0", "2.1", "3.0"]),
    "artistic": (["artistic"], ["1.0", "2.0"]),
    "ofl": (["ofl", "open font license"], ["1.0", "1.1"]),
    "odbl": (["odbl", "open database license"], ["1.0"]),
    "ogl": (["ogl", "open government licence"], ["1.0", "2.0", "3.0"]),
    "boost": (["boost software"], ["1.0"]),
    "bsd-2-clause": (["bsd 2 clause"], []),
    "bsd-3-clause": (["bsd 3 clause"], []),
    "bsd-4-clause": (["bsd 4 clause"], []),
    "bsd": (["bsd", "new bsd", "simplified bsd"], []),
    "mit": (["mit"], []),
    "x11": (["x11"], []),
    "isc": (["isc"], []),
    "zlib": (["zlib"], []),
    "libpng": (["libpng"], ["2.0"]),
    "unlicense": (["the unlicense"], []),
    "wtfpl": (["wtfpl"], ["2.0"]),
    "postgresql": (["postgresql"], []),
    "python": (["python", "psf"], ["2.0"]),
    "ruby": (["ruby"], []),
    "php": (["php"], ["3.0", "3.01"]),
    "zpl": (["zpl", "zope public license"], ["1.1", "2.0", "2.1"]),
    "ms-pl": (["ms pl", "microsoft public license"], []),
    "ms-rl": (["ms rl", "microsoft reciprocal license"], []),
    "cecill": (["cecill"], ["1.0", "2.0", "2.1"]),
    "ncsa": (["ncsa"], []),
    "upl": (["upl", "universal permissive license"], ["1.0"]),
    "bsl": (["business source license"], ["1.1"]),
    "sspl": (["sspl", "server side public license"], ["1.0"]),
}

# The Creative Commons licences, by the letters of their elements.
COMMONS = {
    "by": "attribution",
    "by-sa": "attribution share ?alike",
    "by-nd": "attribution no ?deriv(?:ative)?s?",
    "by-nc": "attribution non ?commercial",
    "by-nc-sa": "attribution non ?commercial share ?alike",
    "by-nc-nd": "attribution non ?commercial no ?deriv(?:ative)?s?",
}
COMMONS_VERSIONS = ["1.0", "2.0", "2.5", "3.0", "4.0"]

#: Sentences and notices that name no licence family: label, one keyword or two, pattern, priority.
STATEMENTS = [
    ("mit-text", "hereby granted", "permission is hereby granted free of charge to any person obtaining a copy", 90),
    ("isc-text", "permission", "permission to use copy modify and or distribute this software for any purpose", 90),
    ("bsd-text", "redistribution", "redistribution and use in source and binary forms", 88),
    ("bsd-text", "endorse promote", "may be used to endorse or promote products derived from this software", 89),
    ("as-is", "warranty provided", "this software is provided as is without any express or implied warranty", 70),
    ("as-is", "warranty provided", "the software is provided as is without warranty of any kind", 60),
    ("wtfpl", "what want", "do what the (?:fuck|hell) you want to", 80),
    ("public-domain", "domain public", "(?:released |dedicated |placed )?(?:in|into|to) the public domain", 75),
    ("cc0", "cc0", "cc0(?: 1 0)?(?: universal)?", 75),
    ("cc0", "reserved rights", "no rights reserved", 74),
    ("unlicense", "unencumbered", "free and unencumbered software released into the public domain", 92),
    ("some-reserved", "reserved some", "some rights reserved", 40),
    ("copyright", "copyright", r"copyright (?:c )?[12]\d\d\d", 30),
    ("copyright", "copyright", "(?:all )?copyrights? (?:is|are|by|of|holders?)", 20),
    ("confidential", "confidential", "(?:proprietary and confidential|confidential and proprietary)", 35),
    ("no-copying", "without", "may not be (?:reproduced|copied|distributed|republished) .{0,60}?without", 45),
    ("no-copying", "without", "without (?:the )?(?:prior |express |written )+(?:permission|consent)", 44),
    ("terms", "terms", "(?:subject to|see) (?:our|the) terms of use", 15),
]


def _loose(name: str) -> str:
    """A name's pattern, with anything but word characters where it has a space."""
    return name.replace(" ?", "@").replace(" ", GAP).replace("@", rf"[^{WORD_CHARS}]*")


def _keywords(name: str) -> tuple[str, str]:
    """The longest of a name's words, and another of them, if any; a licence has either spelling."""
    parts = [re.sub("licen[cs]e$", "licen", word) for word in name.split(" ")]
    key = max(parts, key=lambda word: (word != "licen", len(word)))
    rest = [word for word in parts if word != key]
    return key, "licen" if "licen" in rest else rest[0] if rest else ""


def _version(version: str) -> str:
    major, _, minor = version.partition(".")
    # 2.0 is written 2 as well
    small = rf"(?:\.{minor})?" if minor == "0" else rf"\.{minor}"
    return rf"(?:v(?:er(?:sion|\.)?)?)?[\s.-]{{0,2}}{major}{small}(?![.]?\d)"


def _any_case(pattern: str) -> str:
    return "(?i)" + START + pattern + END


def build() -> list[Rule]:
    """All rules, those of the higher priority first."""
    rules = [Rule(label, BASE_KEYWORDS[phrase], "", words(phrase), 50, len(phrase.split(" ")))
             for phrase, label in BASE.items()]
    under = (rf"(?:licen[cs]ed|released|distributed|available){GAP}under{GAP}(?:the{GAP})?"
             rf"(?:terms{GAP}of{GAP}the{GAP})?")
    for label, (names, versions) in FAMILIES.items():
        rules.append(Rule(label, "spdx", label, _any_case(
            rf"spdx-license-identifier:\s*{label}[-0-9a-z.+]*"), 98))
        rules += [Rule(f"{label}-{version}", "spdx", label, _any_case(
            rf"spdx-license-identifier:\s*{label}-{version}(?:-only|-or-later|\+)?"), 100)
            for version in versions]
        for name in names:
            own = _loose(name.replace("license", "licen[cs]e").replace("licence", "licen[cs]e"))
            own += rf"(?:{GAP}licen[cs]e)?" * (not own.endswith("licen[cs]e"))
            key, more = _keywords(name)
            rules.append(Rule(label, key, more or "under", _any_case(under + own), 80))
            rules.append(Rule(label, key, "licen", _any_case(own.replace(")?", ")")), 65))
            for version in versions:
                rules += [
                    Rule(f"{label}-{version}", key, more or "under", _any_case(
                        rf"{under}{own}[\s,]{{0,3}}{_version(version)}"), 95),
                    Rule(f"{label}-{version}", key, more or version[0], _any_case(
                        rf"{own}[\s,]{{0,3}}{_version(version)}"), 85),
                ]
    for letters, name in COMMONS.items():
        short = letters.replace("-", r"[\s_-]{1,2}")
        for version in COMMONS_VERSIONS:
            tagged = f"cc-{letters}-{version}"
            rules += [
                Rule(tagged, "creativecommons.org", letters, _any_case(
                    rf"creativecommons\.org/licenses/{letters}/{version}"), 99),
                Rule(tagged, "cc", "by", _any_case(
                    rf"cc[\s_-]{{1,2}}{short}[\s_-]{{1,2}}{_version(version)}"), 96),
                Rule(tagged, "commons", "attribution", _any_case(
                    rf"creative{GAP}commons{GAP}{_loose(name)}[\s,]{{0,3}}{_version(version)}"), 97),
            ]
        rules += [
            Rule(f"cc-{letters}", "creativecommons.org", letters, _any_case(
                rf"creativecommons\.org/licenses/{letters}(?=/|\s|$)"), 82),
            Rule(f"cc-{letters}", "commons", "attribution", _any_case(
                rf"creative{GAP}commons{GAP}{_loose(name)}"), 81),
        ]
        if letters != "by":  # that one is a base phrase
            rules.append(Rule(f"cc-{letters}", "cc", "by", _any_case(rf"cc[\s_-]{{1,2}}{short}"), 79))
    rules += [Rule(label, *keywords.partition(" ")[::2], _any_case(pattern.replace(" ", GAP)), priority)
              for label, keywords, pattern, priority in STATEMENTS]
    return sorted(rules, key=lambda rule: (-rule.priority, rule.label, rule.pattern))
