"""Signature rules for license texts, written from families and phrasings.

Fixed values: the names and versions of public licenses and the usual ways to refer to them.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Rule:
    """``pattern`` runs over words joined by single blanks; ``keyword`` is a plain text every match holds."""

    label: str
    keyword: str
    pattern: str
    priority: int
    weight: float


# label, keyword, pattern of the name; more precise names have a higher priority.
FAMILIES = [
    ("mit", "mit license", "mit license", 20),
    ("mit", "expat", "expat license", 20),
    ("mit-0", "mit no attribution", "mit no attribution(?: license)?", 40),
    ("apache", "apache", "apache(?: software)? license", 20),
    ("apache-1.1", "apache", "apache(?: software)? license(?: version)? 1 1", 40),
    ("apache-2.0", "apache", "apache(?: software)? license(?: version)? 2(?: 0)?", 40),
    ("gpl", "general public license", "(?:gnu )?general public license", 20),
    ("gpl-2.0", "general public license", "(?:gnu )?general public license(?: as published by the free software foundation)?(?: either)? v(?:ersion )?2", 40),
    ("gpl-3.0", "general public license", "(?:gnu )?general public license(?: as published by the free software foundation)?(?: either)? v(?:ersion )?3", 40),
    ("gpl-2.0", "gpl", "gpl ?v?2(?: 0)?", 35),
    ("gpl-3.0", "gpl", "gpl ?v?3(?: 0)?", 35),
    ("lgpl", "lesser general public", "(?:gnu )?lesser general public license", 45),
    ("lgpl", "library general public", "(?:gnu )?library general public license", 45),
    ("lgpl-2.1", "lesser general public", "(?:gnu )?lesser general public license v(?:ersion )?2 1", 50),
    ("lgpl-3.0", "lesser general public", "(?:gnu )?lesser general public license v(?:ersion )?3", 50),
    ("agpl", "affero", "(?:gnu )?affero general public license", 45),
    ("agpl-3.0", "affero", "(?:gnu )?affero general public license v(?:ersion )?3", 50),
    ("bsd", "bsd", "bsd(?: style)? license", 20),
    ("bsd-2-clause", "bsd", "(?:bsd 2|2 clause bsd|two clause bsd|simplified bsd|freebsd)(?: clause)?(?: license)?", 40),
    ("bsd-3-clause", "bsd", "(?:bsd 3|3 clause bsd|three clause bsd|modified bsd|new bsd)(?: clause)?(?: license)?", 40),
    ("bsd-4-clause", "bsd", "(?:bsd 4|4 clause bsd|four clause bsd|original bsd)(?: clause)?(?: license)?", 40),
    ("isc", "isc license", "isc license", 20),
    ("mpl", "mozilla public", "mozilla public license", 20),
    ("mpl-1.1", "mozilla public", "mozilla public license(?: version)? v?1 1", 40),
    ("mpl-2.0", "mozilla public", "mozilla public license(?: version)? v?2(?: 0)?", 40),
    ("epl", "eclipse public", "eclipse public license", 20),
    ("epl-1.0", "eclipse public", "eclipse public license(?: version)? v?1(?: 0)?", 40),
    ("epl-2.0", "eclipse public", "eclipse public license(?: version)? v?2(?: 0)?", 40),
    ("cddl", "common development and distribution", "common development and distribution license", 20),
    ("eupl", "european union public", "european union public licence", 20),
    ("artistic", "artistic license", "artistic license", 20),
    ("artistic-2.0", "artistic license", "artistic license(?: version)? 2(?: 0)?", 40),
    ("boost", "boost software", "boost software license", 20),
    ("zlib", "zlib", "zlib(?: libpng)? license", 20),
    ("python", "python software foundation", "python software foundation license", 20),
    ("unlicense", "unlicense", "(?:the )?unlicense", 20),
    ("wtfpl", "wtfpl", "wtfpl", 20),
    ("ms-pl", "microsoft public", "microsoft public license", 20),
    ("ofl", "open font", "(?:sil )?open font license", 20),
    ("odbl", "open database", "open database license", 20),
    ("cc0", "cc0", "cc0(?: 1 0)?", 40),
    ("cc0", "creative commons zero", "creative commons zero", 40),
    ("public-domain", "public domain", "public domain", 10),
    ("proprietary", "all rights reserved", "all rights reserved", 5),
    ("proprietary", "confidential", "confidential and proprietary", 10),
]

# How a text says that a license holds, as a pattern around the name; the share of certainty it adds.
PHRASINGS = [
    ("{name}", 0.6),
    ("(?:is|are) licensed under (?:the )?(?:terms of )?(?:the )?{name}", 1.0),
    ("licensed under (?:the )?(?:terms of )?(?:the )?{name}", 0.95),
    ("released under (?:the )?(?:terms of )?(?:the )?{name}", 0.95),
    ("distributed under (?:the )?(?:terms of )?(?:the )?{name}", 0.95),
    ("(?:available|provided|published|covered) under (?:the )?(?:terms of )?(?:the )?{name}", 0.9),
    ("subject to (?:the )?(?:terms of )?(?:the )?{name}", 0.9),
    ("(?:under|by) the terms of (?:the )?{name}", 0.9),
    ("spdx license identifier {name}", 1.0),
]

# Parts of the Creative Commons names, versions and spellings: one rule each.
CC_TERMS = [("by", "attribution"), ("by-sa", "attribution share ?alike"), ("by-nc", "attribution non ?commercial"), ("by-nd", "attribution no ?deriv(?:ative)?s"), ("by-nc-sa", "attribution non ?commercial share ?alike"), ("by-nc-nd", "attribution non ?commercial no ?deriv(?:ative)?s")]
CC_VERSIONS = ["1.0", "2.0", "2.5", "3.0", "4.0"]


def rules() -> list[Rule]:
    made = [
        Rule(label, keyword, phrase.format(name=f"(?:{name})"), priority + round(10 * weight), weight)
        for label, keyword, name, priority in FAMILIES
        for phrase, weight in PHRASINGS
    ]
    for terms, long in CC_TERMS:
        short = "cc " + terms.replace("-", " ")
        made.append(Rule(f"cc-{terms}", short, short, 30 + len(terms), 0.7))
        made.append(Rule(f"cc-{terms}", "creative commons", f"creative commons {long}", 30 + len(terms), 0.7))
        for version in CC_VERSIONS:
            number = version.replace(".", " ")
            made.append(Rule(f"cc-{terms}-{version}", short, f"(?:licensed under )?{short} {number}", 60 + len(terms), 1.0))
            made.append(Rule(f"cc-{terms}-{version}", "creative commons", f"(?:licensed under )?creative commons {long} {number}", 60 + len(terms), 1.0))
    return made
