"""License scans by ordered signature rules.

A rule is a regular expression over normalized words, with groups of keywords, one of each of which
must occur before it is tried, a priority and a weight. A detection inside the interval of a kept one of at least the same
priority is suppressed. The rules are a few phrasings for each license family, and signatures written one by one
(``license_rules``) for notices, identifiers, choices of licenses and licenses outside the families.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veritable.llm.license_rules import SIGNATURES

#: Phrases whose every place counts, and their labels.
BASE = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))

#: Label, name as normalized words (a regular expression), keyword or keywords, whether it has versions.
#: Every alternative of a name must hold one of the keywords.
FAMILIES = (
    ("agpl", "(?:gnu )?affero general public", "affero", True),
    ("agpl", "agpl", "agpl", True),
    ("apache", "apache(?: software)?", "apache", True),
    ("artistic", "artistic", "artistic", True),
    ("beerware", "beer ?ware", "beer", False),
    ("bsd-2-clause", "(?:bsd 2 clause|2 clause bsd|simplified bsd|freebsd)", "bsd", False),
    ("bsd-3-clause", "(?:bsd 3 clause|3 clause bsd|new bsd|modified bsd)", "bsd", False),
    ("bsd-4-clause", "(?:bsd 4 clause|4 clause bsd|original bsd)", "bsd", False),
    ("bsd", "bsd", "bsd", False),
    ("boost", "boost(?: software)?", "boost", True),
    ("cc-by-nc-nd", "(?:cc by nc nd|creative commons attribution non ?commercial no ?deriv(?:ative)?s)",
     ("cc by nc nd", "creative commons"), True),
    ("cc-by-nc-sa", "(?:cc by nc sa|creative commons attribution non ?commercial share ?alike)",
     ("cc by nc sa", "creative commons"), True),
    ("cc-by-nc", "(?:cc by nc|creative commons attribution non ?commercial)", ("cc by nc", "creative commons"), True),
    ("cc-by-nd", "(?:cc by nd|creative commons attribution no ?deriv(?:ative)?s)",
     ("cc by nd", "creative commons"), True),
    ("cc-by-sa", "(?:cc by sa|creative commons attribution share ?alike)", ("cc by sa", "creative commons"), True),
    ("cc-by", "(?:cc by|creative commons attribution)", ("cc by", "creative commons"), True),
    ("cc0", "(?:cc0|cc zero|creative commons zero)", ("cc0", "cc zero", "creative commons"), True),
    ("cddl", "(?:cddl|common development and distribution)", ("cddl", "common development"), True),
    ("cecill", "cecill", "cecill", True),
    ("cpl", "common public", "common", True),
    ("epl", "eclipse public", "eclipse", True),
    ("eupl", "(?:eupl|european union public)", ("eupl", "european union"), True),
    ("gfdl", "(?:gnu )?free documentation", "documentation", True),
    ("gpl", "(?:gnu )?general public", "general", True),
    ("gpl", "(?:gnu )?gpl", "gpl", True),
    ("isc", "isc", "isc", False),
    ("lgpl", "(?:gnu )?(?:lesser|library) general public", "general", True),
    ("lgpl", "(?:gnu )?lgpl", "lgpl", True),
    ("lppl", "latex project public", "latex", True),
    ("mit", "(?:mit|expat)", ("mit", "expat"), False),
    ("mpl", "mozilla public", "mozilla", True),
    ("ms-pl", "microsoft public", "microsoft", False),
    ("ncsa", "(?:ncsa|university of illinois)", ("ncsa", "illinois"), False),
    ("odbl", "(?:odbl|open database)", ("odbl", "open database"), True),
    ("ofl", "(?:sil )?open font", "font", True),
    ("openssl", "openssl", "openssl", False),
    ("osl", "open software", "software", True),
    ("php", "php", "php", True),
    ("postgresql", "postgresql", "postgresql", False),
    ("psf", "(?:psf|python software foundation)", ("psf", "python"), True),
    ("unlicense", "unlicense", "unlicense", False),
    ("w3c", "w3c", "w3c", False),
    ("wtfpl", "(?:wtfpl|do what the fuck you want to public)", ("wtfpl", "do what the"), True),
    ("zlib", "zlib(?: libpng)?", "zlib", False),
    ("zope", "zope public", "zope", True),
)
VERSION = "(?: (?:version|v) ?[0-9]+(?: [0-9]+)?(?: or (?:any )?later(?: version)?)?| v?[0-9]+(?: [0-9]+)?)?"
LICENSE = "(?: (?:public )?licen[sc]es?)?"
#: Phrasing, keyword, priority, weight; {name} and {version} come from the family.
PHRASINGS = (
    ("spdx licen[sc]e identifier {name}{version}(?: (?:only|or later))?", "spdx", 5, 0.99),
    ("(?:licen[sc]ed|available|distributed) under (?:the terms of )?(?:the |a |an )?{name}" + LICENSE
     + "{version}", "under", 4, 0.95),
    ("(?:released|published|provided|covered) (?:under|by) (?:the terms of )?(?:the |a |an )?{name}"
     + LICENSE + "{version}", "ed ", 4, 0.95),
    ("(?:subject to|terms of|accordance with) the {name}" + LICENSE + "{version}", "the ", 4, 0.9),
    ("permission is granted under the {name}" + LICENSE + "{version}", "permission", 4, 0.9),
    ("{name} licen[sc]ed?{version}", "licen", 3, 0.8),
    ("licen[sc]es? (?:is |are )?(?:the )?{name}{version}", "licen", 2, 0.7),
)
#: Notices that belong to no family: label, regular expression, keyword, priority, weight.
NOTICES = (
    ("public-domain", "(?:released|placed|dedicated) (?:in|into|to) the public domain", "public domain", 4, 0.9),
    ("public-domain", "public domain", "public domain", 1, 0.4),
    ("proprietary", "proprietary and confidential", "proprietary", 3, 0.8),
    ("proprietary", "unauthorized (?:copying|reproduction|distribution)", "unauthorized", 3, 0.7),
    ("copyright", "copyright (?:c )?(?:19|20)[0-9][0-9]", "copyright", 2, 0.5),
    ("mit", "permission is hereby granted free of charge to any person", "hereby granted", 5, 0.98),
    ("bsd", "redistribution and use in source and binary forms", "redistribution", 5, 0.98),
    ("no-warranty", "provided as is without warranty", "warranty", 1, 0.5),
)
BASE_WEIGHT = 0.6

_SPACE = bytes(c if chr(c).isdigit() or chr(c).islower() and c < 128 or c > 127 else 32
               for c in range(256))


@dataclass(frozen=True)
class Rule:
    label: str
    pattern: re.Pattern
    #: Groups of which one keyword each must occur.
    keywords: tuple[tuple[bytes, ...], ...]
    priority: int
    weight: float


@cache
def rules() -> tuple[Rule, ...]:
    """All rules, by falling priority."""
    made = []
    for phrase, keyword, priority, weight in PHRASINGS:
        for label, name, own, versioned in FAMILIES:
            text = phrase.format(name=name, version=VERSION if versioned else "")
            made.append((label, text, (keyword, own), priority, weight))
    made += [(label, text, (keyword,), *rest) for label, text, keyword, *rest in (*NOTICES, *SIGNATURES)]
    return tuple(sorted(
        (Rule(label, re.compile(f" (?:{text})(?= )".encode()), tuple(_group(k) for k in keys),
              priority, weight) for label, text, keys, priority, weight in made),
        key=lambda r: -r.priority))


def _group(keywords: str | tuple[str, ...]) -> tuple[bytes, ...]:
    return tuple(k.encode() for k in ([keywords] if isinstance(keywords, str) else keywords))


def words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").lower().translate(_SPACE).split()


def word_numbers(joined: bytes, places: list[int]) -> list[int]:
    """The number of the word after the space at each place."""
    spaces = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32) if places else []
    return np.searchsorted(spaces, places).tolist()


def base_places(joined: bytes) -> list[tuple[int, str]]:
    """``word, label`` of every place of a base phrase, overlapping ones too."""
    places = []
    for phrase, label in BASE:
        at = joined.find(found := f" {phrase} ".encode())
        while at >= 0:
            places.append((at, label))
            at = joined.find(found, at + 1)
    places.sort()
    return list(zip(word_numbers(joined, [at for at, _ in places]), [x for _, x in places]))


def _unsuppressed(found: list[tuple[int, int, Rule]]) -> list[tuple[int, int, Rule]]:
    """Detections outside every interval of at least their priority (equal intervals: one stays).

    One sweep per priority: what lies inside a suppressed detection lies inside a kept one too.
    """
    kept = []
    for priority in {rule.priority for _, _, rule in found}:
        pool = sorted((f for f in found if f[2].priority >= priority),
                      key=lambda f: (f[0], -f[1], -f[2].priority, f[2].label))
        reach = -1
        for first, end, rule in pool:
            if rule.priority == priority and end > reach:
                kept.append((first, end, rule))
            reach = max(reach, end)
    return kept


def detections(joined: bytes) -> list[tuple[int, int, str, float]]:
    """``first word, end word, label, weight`` of what is left after suppression, by place."""
    present: dict[tuple[bytes, ...], bool] = {}
    found = []
    for rule in rules():
        for group in rule.keywords:
            if group not in present:
                present[group] = any(k in joined for k in group)
            if not present[group]:
                break
        else:
            found += [(m.start(), m.end(), rule) for m in rule.pattern.finditer(joined)]
    kept = _unsuppressed(found)
    firsts = word_numbers(joined, [a for a, _, _ in kept])
    return sorted((first, first + joined.count(b" ", a, b), rule.label, rule.weight)
                  for first, (a, b, rule) in zip(firsts, kept))


_PLACES = pa.list_(pa.struct([("word", pa.int64()), ("label", pa.string())]))
_FOUND = pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64()),
                             ("label", pa.string()), ("weight", pa.float64())]))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, n_words, base, found, score`` per row.

    ``base`` holds every place of a base phrase; rules never remove it. ``found`` holds the
    detections left after suppression. The score is 1 less the chance that all of them err: 0
    without any. Null counts as empty text. A text of any length is scanned whole. Repeated rows
    stay repeated; an empty table gives an empty result.
    """
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, base, found, scores = [], [], [], []
            for text in batch.column(1):
                each = words(text.as_py())
                joined = b" " + b" ".join(each) + b" "
                places, rest = base_places(joined), detections(joined)
                doubt = 1.0
                for weight in [BASE_WEIGHT] * bool(places) + [w for *_, w in rest]:
                    doubt *= 1 - weight
                sizes.append(len(each))
                base.append([{"word": w, "label": x} for w, x in places])
                found.append([dict(zip(("first", "end", "label", "weight"), r)) for r in rest])
                scores.append(1 - doubt)
            yield pa.record_batch(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(base, _PLACES),
                 pa.array(found, _FOUND), pa.array(scores, pa.float64())],
                ["id", "n_words", "base", "found", "score"])

    plain = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return plain.mapInArrow(
        task, "id long, n_words long, base array<struct<word: long, label: string>>, "
        "found array<struct<first: long, end: long, label: string, weight: double>>, score double")
