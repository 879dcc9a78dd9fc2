"""Signature rules for licence mentions, over lower-case words joined by single spaces.

Written by hand: sentences of licence texts (``license_texts``), and families of names, a name, its versions,
and the forms in which it is mentioned. Every rule carries the keyword that must occur in a text before its
pattern is tried, a priority and a confidence.
"""

from __future__ import annotations

import itertools
import re
from dataclasses import dataclass

from siltstone.llm.license_texts import BODIES, KEYWORDS

_OPTIONAL = re.compile(r"\(\?:[^()]*\)\?")
# Groups, classes, and letters or words that may be missing or vary.
_CHOICE = re.compile(r"\(\?:[^()]*\)(?:\?|\{[0-9,]+\})?")
_ANY = re.compile(r"\\S\+|\[[^\]]*\](?:\{[0-9,]+\})?|.\?")


@dataclass(frozen=True)
class Rule:
    label: str
    keyword: str
    pattern: str
    priority: int
    confidence: float

    @property
    def gate(self) -> str:
        """A string that every match holds; shared by as many rules as possible."""
        return "licen" if "licen" in _OPTIONAL.sub("", self.pattern) else self.keyword


#: Places that every scan reports, whatever the other rules say: words and label.
BASE_PHRASES = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}

# Priorities: a machine-readable tag beats a full name with a version, which beats a sentence of a licence's own
# text, which beats a name alone, which beats a hint.
TAG, VERSIONED, BODY, NAMED, HINT = 40, 30, 25, 20, 10
_LICENCE = "licen[sc]es?"
_VERSION = "(?: version)?(?: v)?"


def _words(version: str) -> str:
    """A version as words: 2.0 is cut into 2 and 0, and a trailing 0 may be missing."""
    major, _, minor = version.partition(".")
    if not minor:
        return f"v?{major}(?: 0)?"
    return f"v?{major}(?: 0)?" if minor == "0" else f"v?{major} {minor}"


# Label stem, keyword, names in words, tag stem, versions.
_VERSIONED = [
    ("gpl", "general public", "(?:gnu )?general public licen[sc]e", "gpl", ["1.0", "2.0", "3.0"]),
    ("gpl", "gpl", "(?:gnu )?gpl", "gpl", ["1.0", "2.0", "3.0"]),
    ("lgpl", "lesser general", "(?:gnu )?lesser general public licen[sc]e", "lgpl", ["2.1", "3.0"]),
    ("lgpl", "library general", "(?:gnu )?library general public licen[sc]e", "lgpl", ["2.0"]),
    ("lgpl", "lgpl", "(?:gnu )?lgpl", "lgpl", ["2.0", "2.1", "3.0"]),
    ("agpl", "affero", "(?:gnu )?affero general public licen[sc]e", "agpl", ["1.0", "3.0"]),
    ("agpl", "agpl", "(?:gnu )?agpl", "agpl", ["1.0", "3.0"]),
    ("gfdl", "free documentation", "(?:gnu )?free documentation licen[sc]e", "gfdl", ["1.1", "1.2", "1.3"]),
    ("apache", "apache", "apache(?: software)? licen[sc]e", "apache", ["1.0", "1.1", "2.0"]),
    ("mpl", "mozilla", "mozilla public licen[sc]e", "mpl", ["1.0", "1.1", "2.0"]),
    ("epl", "eclipse", "eclipse public licen[sc]e", "epl", ["1.0", "2.0"]),
    ("cddl", "common development", "common development and distribution licen[sc]e", "cddl", ["1.0", "1.1"]),
    ("cpl", "common public", "common public licen[sc]e", "cpl", ["1.0"]),
    ("eupl", "european union", "european union public licen[sc]e", "eupl", ["1.0", "1.1", "1.2"]),
    ("osl", "open software", "open software licen[sc]e", "osl", ["1.0", "2.0", "2.1", "3.0"]),
    ("afl", "academic free", "academic free licen[sc]e", "afl", ["1.1", "1.2", "2.0", "2.1", "3.0"]),
    ("artistic", "artistic", "artistic licen[sc]e", "artistic", ["1.0", "2.0"]),
    ("ofl", "open font", "(?:sil )?open font licen[sc]e", "ofl", ["1.0", "1.1"]),
    ("bsl", "boost", "boost software licen[sc]e", "bsl", ["1.0"]),
    ("odbl", "open database", "open (?:data commons open )?database licen[sc]e", "odbl", ["1.0"]),
    ("busl", "business source", "business source licen[sc]e", "busl", ["1.0", "1.1"]),
    ("zpl", "zope", "zope public licen[sc]e", "zpl", ["1.1", "2.0", "2.1"]),
    ("psf", "python software", "python software foundation licen[sc]e", "psf", ["2.0"]),
    ("lppl", "latex project", "latex project public licen[sc]e", "lppl", ["1.0", "1.1", "1.2", "1.3"]),
    ("npl", "netscape", "netscape public licen[sc]e", "npl", ["1.0", "1.1"]),
    ("ms-pl", "microsoft public", "microsoft public licen[sc]e", "ms pl", ["1.0"]),
    ("ms-rl", "microsoft reciprocal", "microsoft reciprocal licen[sc]e", "ms rl", ["1.0"]),
]

# Label, keyword, words: names without versions.
_PLAIN = [
    ("mit", " mit licen", "mit licen[sc]e"),
    ("mit", "d under", "licen[sc]ed under (?:the )?mit"),
    ("mit", "permission", "permission is hereby granted free of charge to any person obtaining a copy"),
    ("isc", " isc ", "isc licen[sc]e"),
    ("isc", "permission", "permission to use copy modify and or distribute this software"),
    ("bsd", " bsd ", "bsd licen[sc]e"),
    ("bsd", " bsd ", "bsd style licen[sc]e"),
    ("bsd", "redistribution and use", "redistribution and use in source and binary forms"),
    ("bsd-2-clause", " bsd ", "(?:simplified bsd|bsd 2 clause|2 clause bsd)(?: licen[sc]e)?"),
    ("bsd-3-clause", " bsd ", "(?:new bsd|modified bsd|bsd 3 clause|3 clause bsd)(?: licen[sc]e)?"),
    ("bsd-4-clause", " bsd ", "(?:original bsd|bsd 4 clause|4 clause bsd)(?: licen[sc]e)?"),
    ("0bsd", "0bsd", "0bsd(?: licen[sc]e)?"),
    ("zlib", "zlib", "zlib (?:libpng )?licen[sc]e"),
    ("libpng", "libpng", "libpng licen[sc]e"),
    ("unlicense", "unlicense", "(?:the )?unlicense"),
    ("wtfpl", "wtfpl", "wtfpl"),
    ("postgresql", "postgresql", "postgresql licen[sc]e"),
    ("openssl", "openssl", "openssl licen[sc]e"),
    ("php", " php ", "php licen[sc]e"),
    ("ruby", " ruby ", "ruby licen[sc]e"),
    ("x11", " x11 ", "x11 licen[sc]e"),
    ("curl", " curl ", "curl licen[sc]e"),
    ("beerware", "beerware", "beerware(?: licen[sc]e)?"),
    ("beerware", "beer ware", "beer ware(?: licen[sc]e)?"),
    ("public-domain", "public domain", "public domain"),
    ("public-domain", "public domain", "(?:released|dedicated|placed) (?:in|in to|into|to) the public domain"),
    ("cc0", " cc0", "cc0(?: 1 0)?(?: universal)?"),
    ("cc0", " cc zero", "cc zero"),
    ("copyright", "copyright", "copyright(?: c)? (?:19|20)[0-9]{2}(?: (?:19|20)[0-9]{2})*"),
    ("copyright", "copyright", "(?:protected by|under) copyright"),
    ("reserved", "rights reserved", "(?:all|some|no) rights reserved"),
    ("proprietary", "proprietary", "proprietary and confidential"),
    ("proprietary", "proprietary", "proprietary licen[sc]e"),
    ("proprietary", "permission", "(?:reproduction|redistribution|copying) without permission"),
    ("proprietary", "not for", "not for (?:redistribution|resale|commercial use)"),
]

# Forms in which a name with a version stands.
_FORMS = [
    ("{name}{version} {number}", VERSIONED, 0.95, ""),
    ("{name}{version} {number} only", VERSIONED + 2, 0.97, "-only"),
    ("{name}{version} {number} or(?: any)? later(?: version)?", VERSIONED + 2, 0.97, "-or-later"),
    ("{name} as published by the (?:\\S+ ){{1,4}}(?:either )?version {number}", VERSIONED + 3, 0.99, ""),
]

_CC_PARTS = {"": [""], "-nc": ["noncommercial", "non commercial"], "-nd": ["noderivs", "no derivatives", "noderivatives"], "-sa": ["sharealike", "share alike"]}
_CC_KINDS = ["", "-sa", "-nd", "-nc", "-nc-sa", "-nc-nd"]
_CC_VERSIONS = ["1.0", "2.0", "2.5", "3.0", "4.0"]


def _keyword(pattern: str) -> str:
    """A string that every match of a sentence's pattern holds: a stem that many sentences share, or its longest stretch."""
    certain, before = pattern, ""
    while certain != before:  # the innermost choices first
        before, certain = certain, _CHOICE.sub("#", certain)
    certain = _ANY.sub("#", certain)
    shared = (k for k in KEYWORDS if k in certain)
    return next(shared, None) or max(certain.split("#"), key=len).strip()


def _creative_commons() -> list[Rule]:
    found = []
    for kind in _CC_KINDS:
        parts = [p for p in kind.split("-") if p]
        tag = " ".join(["cc by", *parts])
        spoken = [_CC_PARTS[f"-{p}"] for p in parts]
        for words in itertools.product(["attribution"], *spoken):
            name = f"(?:creative commons )?{' '.join(words)}"
            found.append(Rule(f"cc-by{kind}", "attribution", f"creative commons {' '.join(words)}", NAMED, 0.9))
            for version in _CC_VERSIONS:
                pattern = f"{name} {_words(version)}(?: international| unported| generic)?"
                found.append(Rule(f"cc-by{kind}-{version}", "attribution", pattern, VERSIONED, 0.95))
        found.append(Rule(f"cc-by{kind}", "cc by", tag, TAG if parts else NAMED, 0.9))
        for version in _CC_VERSIONS:
            pattern = f"{tag} {_words(version)}"
            found.append(Rule(f"cc-by{kind}-{version}", "cc by", pattern, TAG, 0.99))
    return found


def rules() -> list[Rule]:
    """All rules, in a stable order."""
    found = []
    for stem, keyword, name, tag, versions in _VERSIONED:
        found.append(Rule(stem, keyword, name, NAMED, 0.8))
        under = f"licen[sc]ed under (?:the )?(?:terms of (?:the )?)?{name}"
        found.append(Rule(stem, keyword, under, NAMED + 1, 0.9))
        for version in versions:
            for form, priority, confidence, ending in _FORMS:
                pattern = form.format(name=name, version=_VERSION, number=_words(version))
                found.append(Rule(f"{stem}-{version}{ending}", keyword, pattern, priority, confidence))
            pattern = f"{under}{_VERSION} {_words(version)}"
            found.append(Rule(f"{stem}-{version}", keyword, pattern, VERSIONED + 1, 0.97))
            tagged = f"spdx licen[sc]e identifier {tag} {version.replace('.', ' ')}"
            for ending, words in (("", ""), ("-only", " only"), ("-or-later", " or later")):
                found.append(Rule(f"{stem}-{version}{ending}", "spdx", tagged + words, TAG + len(words), 1.0))
    for label, keyword, pattern in _PLAIN:
        found.append(Rule(label, keyword, pattern, NAMED, 0.8))
        found.append(Rule(label, "spdx", f"spdx licen[sc]e identifier {label.replace('-', ' ')}", TAG, 1.0))
    for label, pattern in BODIES:
        priority, confidence = (HINT, 0.4) if label == "license-mention" else (BODY, 0.9)
        found.append(Rule(label, _keyword(pattern), pattern, priority, confidence))
    found += _creative_commons()
    for verb in ("licen[sc]ed under", "distributed under", "released under", "subject to", "see the"):
        found.append(Rule("license-mention", "licen", f"{verb} (?:the |a )?(?:terms of (?:the |this )?)?{_LICENCE}", HINT, 0.4))
    return list(dict.fromkeys(found))
