from __future__ import annotations

import re
from dataclasses import replace

from veritable.llm import licenses
from veritable.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}


def brute(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
    places = [(i, label) for phrase, label in PHRASES.items() for i in range(len(words))
              if words[i:i + len(phrase.split())] == phrase.split()]
    starts = [i for i, _ in places]
    return (len(words), len(places), min(starts, default=None), max(starts, default=None),
            ",".join(sorted({x for _, x in places})))


def test_query_matches_brute_force(spark):
    rows = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    got = QUERIES["op8_license_scan"](spark, SMALL).collect()
    assert len(got) == len(rows)
    for r in got:
        assert tuple(r[1:6]) == brute(rows[r.doc_id])
        assert set(r.base_labels.split(",")) - {""} <= set(r.labels.split(","))
        assert 0 <= r.score <= 1


def labels(text):
    joined = b" " + b" ".join(licenses.words(text)) + b" "
    return [(label, first, end) for first, end, label, _ in licenses.detections(joined)]


def test_rules_and_suppression():
    assert len(licenses.rules()) > 200
    assert labels("Released under the MIT License.") == [("mit", 0, 5)]
    assert labels("Licensed under CC BY-NC 4.0.") == [("cc-by-nc", 0, 7)]
    assert labels("x Licensed under the Apache License, Version 2.0.") == [("apache", 1, 9)]
    assert labels("This work is licensed under the GNU General Public License, version 3.") == [
        ("gpl", 3, 12)]
    assert labels("GNU Lesser General Public License v2.1 or later")[0][0] == "lgpl"
    assert labels("the permit of summit licenses") == []


def test_edge_rows(spark):
    rows = [(1, None), (2, ""), (3, "cc by cc by"), (3, "cc by cc by"), (None, "All rights\nRESERVED"),
            (4, "General Public License " * 20_000), (5, "ccby éCC BY"), (6, "!!! ---")]
    df = spark.createDataFrame([(d, t, 9) for d, t in rows], "doc_id long, text string, score int")
    got = licenses.scan(df).collect()
    assert [(r["id"], r.n_words, len(r.base)) for r in got] == [
        (d, brute(t)[0], brute(t)[1]) for d, t in rows]
    assert got[0].score == 0 and got[2].score >= 0.6
    assert licenses.scan(df.limit(0)).collect() == []


def spellings(parsed):
    """Strings of a parsed pattern: every alternative of every choice at least once."""
    out = [b""]
    for op, arg in parsed:
        name = str(op)
        if name == "LITERAL":
            each = [bytes([arg])]
        elif name == "IN":
            each = [bytes([x if str(o) == "LITERAL" else x[0]]) for o, x in arg]
        elif name == "MAX_REPEAT":
            each = [*([b""] if arg[0] == 0 else []), *spellings(arg[2])]
        elif name == "BRANCH":
            each = [s for branch in arg[1] for s in spellings(branch)]
        elif name == "SUBPATTERN":
            each = spellings(arg[3])
        else:
            assert name == "ASSERT", name
            each = [b" "]
        n = max(len(out), len(each))
        if len(out) > 1 and len(each) > 1:  # each of both, not all pairs
            out = [out[i % len(out)] + e for i, e in enumerate(each)] + [
                o + each[i % len(each)] for i, o in enumerate(out)]
        else:
            out = [out[i % len(out)] + each[i % len(each)] for i in range(n)]
    return list(dict.fromkeys(out))


def test_every_spelling_passes_the_keywords(monkeypatch):
    rules = licenses.rules()
    cases = [(rule, s) for rule in rules for s in spellings(re._parser.parse(rule.pattern.pattern))]
    assert len(cases) > 5 * len(rules)
    for rule, s in cases:
        assert rule.pattern.match(s), s
        assert all(any(k in s for k in group) for group in rule.keywords), (rule, s)
    fast = [licenses.detections(s) for _, s in cases]
    assert all(fast)
    monkeypatch.setattr(licenses, "rules", lambda: tuple(replace(r, keywords=()) for r in rules))
    assert fast == [licenses.detections(s) for _, s in cases]


def test_spelled_out_names():
    by = "licensed under the Creative Commons Attribution"
    assert labels(f"{by} 4.0 International License") == [("cc-by", 0, 8)]
    assert labels(f"{by}-NonCommercial-NoDerivatives 4.0") == [("cc-by-nc-nd", 0, 10)]
    assert labels(f"{by} Non-Commercial Share Alike") == [("cc-by-nc-sa", 0, 10)]
    assert labels("Available under the Open Database License") == [("odbl", 0, 6)]


def test_wordings_outside_the_families():
    """Sentences that the lists were not made from one by one: found, under these labels."""
    cases = {
        "Licensed under either of Apache-2.0 or MIT at your option": {"apache", "mit"},
        "provided under GPLv3": {"gpl"},
        "dual licensed GPLv2 and GPLv3": {"gpl"},
        "Creative Commons BY-SA 4.0": {"cc-by-sa"},
        "SPDX-License-Identifier: 0BSD": {"0bsd"},
        "SPDX-License-Identifier: BSL-1.0": {"bsl"},
        "This is free and unencumbered software released into the public domain.": {"unlicense"},
        "Tous droits r\u00e9serv\u00e9s": {"reserved"},
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0": {"apache"},
        "https://creativecommons.org/licenses/by-nc-sa/4.0/": {"cc-by-nc-sa"},
        "No part of this book may be reproduced": {"proprietary"},
        "subject to the terms of the Mozilla Public License, v. 2.0": {"mpl"},
    }
    for text, wanted in cases.items():
        assert wanted <= {label for label, _, _ in labels(text)}, (text, labels(text))


def test_plain_prose_has_no_license():
    for text in ("The apache helicopter landed near the lake.", "She took a common road to the open door.",
                 "Boost your mood with a walk, and python snakes are not venomous.", "He paid by card.",
                 "The general public may visit the museum free of charge.", "mit dem Zug nach Hause",
                 "An academic wrote a free book on elastic bands and curl patterns."):
        assert labels(text) == [], text


def test_signatures_are_distinct():
    assert len(licenses.SIGNATURES) > 150
    assert len({s[1] for s in licenses.SIGNATURES}) == len(licenses.SIGNATURES)
