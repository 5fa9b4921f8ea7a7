"""Personal data by weak supervision, in column expressions only.

Patterns propose spans. Labelers (patterns, gazetteers, contexts) vote yes, no or nothing on each.
Expectation-maximisation over all documents' votes estimates how reliable each labeler is and how
likely each vote pattern is personal data; a logistic classifier learns these likelihoods and
accepts or rejects the spans that no base rule decides. Spans that pass a base rule always stay.

Votes reach the driver only as counts per vote pattern; there are at most 3^6 patterns per kind.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veritable.llm.words import let

#: Spans of one text whose places are added up together; see ``_running``.
BLOCK = 512
CONTEXT = 32
ACCEPT_FROM = 0.5

# The patterns accept the same spans as their plain forms. The possessive quantifiers and the
# look-behinds keep a long run of letters or digits from being tried once per character.
_LOCAL = "[A-Za-z0-9._%+-]"


@dataclass(frozen=True)
class Kind:
    """Spans of one pattern; ``base`` tells which of them stay whatever the votes say."""

    name: str
    pattern: str
    #: Cheap test of the whole text, without which the pattern cannot match.
    guard: Callable[[Column], Column]
    base: Callable[[Column], Column] | None = None
    #: Votes by format: yes, no or null.
    shape: Callable[[Column], Column] = field(default=lambda s: F.lit(None).cast("int"))


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def _luhn(s: Column) -> Column:
    def total(d: Column) -> Column:
        n = F.length(d)
        def digit(i: Column) -> Column:
            x = F.substring(d, n - i, F.lit(1)).cast("int")
            twice = F.when(x > 4, 2 * x - 9).otherwise(2 * x)
            return F.when(i % 2 == 1, twice).otherwise(x)
        return F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), lambda t, i: t + digit(i))

    return let(_digits(s), lambda d: F.when(F.length(d).between(13, 19), total(d) % 10 == 0)
               .otherwise(False))


def _yes_no(test: Column) -> Column:
    return F.when(test, 1).otherwise(0)


_PART = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
KINDS = (
    Kind("email",
         rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
         lambda t: F.contains(t, F.lit("@")), lambda s: F.lit(True),
         lambda s: _yes_no(s.rlike(r"\.[A-Za-z]{2,}$"))),
    Kind("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
         lambda t: t.rlike(r"[0-9]\.[0-9]"), lambda s: s.rlike(rf"^{_PART}(?:\.{_PART}){{3}}$"),
         lambda s: _yes_no(~s.rlike(r"(?:^|\.)0[0-9]"))),
    Kind("card", r"[0-9](?:[ -]?[0-9]){12,}+", lambda t: t.rlike("[0-9][0-9 -]{8}"), _luhn,
         lambda s: _yes_no(s.rlike(r"^(?:[0-9]+|[0-9]{4}(?:([ -])[0-9]{4})(?:\1[0-9]{1,4})+)$"))),
    Kind("phone", r"\+[0-9][ ().0-9-]+[0-9]", lambda t: F.contains(t, F.lit("+")),
         lambda s: F.length(_digits(s)).between(9, 15),
         lambda s: _yes_no(~s.rlike(r"[ ().-]{4}"))),
    # Kinds of the method alone: every span needs the classifier's word.
    Kind("phone_national", r"(?<![0-9+(.-])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9])",
         lambda t: t.rlike("[0-9]{3}[ .-][0-9]{4}"), None,
         lambda s: _yes_no(s.rlike(r"^(?:\(|[0-9]{3}([.-])[0-9]{3}\1)"))),
    Kind("email_spelled", r"(?<![A-Za-z0-9._-])[A-Za-z0-9._-]{1,64}+ ?[\[(]at[\])] ?"
         r"[A-Za-z0-9-]{1,63}+(?: ?[\[(]dot[\])] ?[A-Za-z0-9-]{1,63}+|\.[A-Za-z0-9-]{1,63}+)+",
         lambda t: t.rlike(r"[\[(]at[\])]"), None, lambda s: F.lit(1)),
    Kind("national_id", "(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
         lambda t: t.rlike("[0-9]-[0-9]{2}-[0-9]"), None,
         lambda s: _yes_no(~s.rlike("^(?:000|666|9)|-00-|0000$"))),
    Kind("iban", "(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
         lambda t: t.rlike("[A-Z]{2}[0-9]{2} ?[A-Z0-9]{4}"), None,
         lambda s: _yes_no(s.rlike("[0-9]{6}"))),
)
RANK = {kind.name: i for i, kind in enumerate(KINDS)}

#: Words before a span that speak for and against personal data.
CUES = ("mail", "phone", "tel", "call", "mobile", "fax", "contact", "reach", "card", "visa",
        "mastercard", "account", "iban", "ssn", "social security", "address", "login", "from", "host")
COUNTER_CUES = ("version", "isbn", "issn", "doi", "order", "invoice", "item", "part", "serial",
                "model", "release", "section", "figure", "page", "price", "total", "sku")
#: Starts and ends of spans by which each kind is known.
GAZETTEER = {
    "email": r"(?i)\.(?:com|org|net|edu|gov|io|info|biz|de|fr|es|uk|it|nl|eu)$",
    "email_spelled": r"(?i)(?:com|org|net|edu|gov|io|info|de|fr|es|uk|it|nl|eu)$",
    "card": "^(?:4|5[1-5]|2[2-7]|3[47]|6(?:011|5))",
    "phone": r"^\+(?:1|2[07]|3[0-469]|4[0-13-9]|5[1-8]|6[0-6]|7|8[1246]|9[0-58])[^0-9]?",
    "iban": "^(?:AT|BE|CH|DE|DK|ES|FI|FR|GB|IE|IT|LU|NL|NO|PL|PT|SE)",
    "ip": "^(?!0|127\\.|255\\.|10\\.|192\\.168\\.)",
}
LABELERS = ("rule", "shape", "gazetteer", "cue", "border", "variety")


def _running(lengths: Column) -> Column:
    """Running totals. Whole blocks are summed first, so that long arrays are not copied per entry."""
    def sums(values: Column, first: Column) -> Column:
        return F.aggregate(values, F.array(first), lambda done, x: F.concat(
            done, F.array(F.element_at(done, -1) + x)))

    def blocks(values: Column) -> Column:
        number = F.greatest(F.ceil(F.size(values) / BLOCK), F.lit(1)).cast("int")
        return F.transform(F.sequence(F.lit(0), number - 1),
                           lambda b: F.slice(values, b * BLOCK + 1, BLOCK))

    def joined(parts: Column) -> Column:
        totals = F.transform(parts, lambda p: F.aggregate(p, F.lit(0), lambda t, x: t + x))
        firsts = F.slice(sums(totals, F.lit(0)), 1, F.size(parts))
        return F.flatten(F.zip_with(parts, firsts, lambda p, first: F.slice(
            sums(p, first), 2, BLOCK)))

    return let(lengths, lambda v: let(blocks(v), joined))


_SPAN = "struct<kind: string, start: int, end: int, text: string, before: string, after: string>"
_NONE = f"array<{_SPAN}>"


def _matches(text: Column, kind: Kind) -> Column:
    """All leftmost, non-overlapping matches with their places in code points.

    The text is split at the matches; lengths of gaps and matches add up to the places.
    """
    def places(pair: Column) -> Column:
        gaps, found = pair["gaps"], pair["found"]
        steps = F.transform(found, lambda m, i: F.length(m) + F.length(F.get(gaps, i)))
        return let(_running(steps), lambda ends: F.transform(found, lambda m, i: F.struct(
            F.lit(kind.name).alias("kind"), (F.get(ends, i) - F.length(m)).alias("start"),
            F.get(ends, i).alias("end"), m.alias("text"),
            F.right(F.get(gaps, i), F.lit(CONTEXT)).alias("before"),
            F.left(F.get(gaps, i + 1), F.lit(1)).alias("after"))))

    pair = F.struct(F.split(text, kind.pattern, -1).alias("gaps"),
                    F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0)).alias("found"))
    none = F.array().cast(_NONE)
    found = let(pair, lambda p: F.when(F.size(p["found"]) > 0, places(p)).otherwise(none))
    return F.when(kind.guard(text), found.cast(_NONE)).otherwise(none)


def _cue(span: Column) -> Column:
    before = F.lower(span["before"])
    one = lambda words: rf"\b(?:{'|'.join(words)})s?\b[^a-z]*(?:[a-z]+[^a-z]+){{0,2}}$"
    return F.when(before.rlike(one(COUNTER_CUES)), 0).when(before.rlike(one(CUES)), 1)


def _votes(span: Column, kind: Kind) -> Column:
    """What each labeler says of a span: 1 yes, 0 no, null nothing."""
    text, nothing = span["text"], F.lit(None).cast("int")
    known = GAZETTEER.get(kind.name)
    glued = span["before"].rlike(r"[A-Za-z0-9_]$") | span["after"].rlike("^[A-Za-z0-9_]")
    return F.struct(
        (_yes_no(kind.base(text)) if kind.base else nothing).alias("rule"),
        kind.shape(text).cast("int").alias("shape"),
        (_yes_no(text.rlike(known)) if known else nothing).alias("gazetteer"),
        _cue(span).cast("int").alias("cue"),
        F.when(glued, 0).cast("int").alias("border"),
        F.when(_digits(text).rlike(r"^(?:([0-9])\1{5,}|0?123456|987654)"), 0).cast("int").alias("variety"))


def candidates(text: Column, kinds: Sequence[Kind] = KINDS) -> Column:
    """Every proposed span with ``base`` (it stays anyway) and ``votes``. Null is empty text."""
    whole = F.coalesce(text, F.lit(""))

    def voted(kind: Kind) -> Column:
        return F.transform(_matches(whole, kind), lambda s: F.struct(
            *[s[c].alias(c) for c in ("kind", "start", "end")],
            (kind.base(s["text"]) if kind.base else F.lit(False)).alias("base"),
            _votes(s, kind).alias("votes")))

    return F.concat(*[voted(kind) for kind in kinds])


def _sigmoid(x: float) -> float:
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, x))))


@dataclass(frozen=True)
class Model:
    """Weights of the final classifier, and the labelers' estimated reliabilities."""

    bias: float
    kinds: Mapping[str, float]
    votes: Mapping[tuple[str, int], float]
    reliability: Mapping[str, tuple[float, float]]

    def probability(self, span: Column) -> Column:
        score = F.lit(self.bias)
        for kind, weight in sorted(self.kinds.items()):
            score = score + F.when(span["kind"] == kind, weight).otherwise(0.0)
        for (labeler, vote), weight in sorted(self.votes.items()):
            score = score + F.when(span["votes"][labeler] == vote, weight).otherwise(0.0)
        return 1 / (1 + F.exp(-score))


def _expectation_maximisation(patterns: Sequence[tuple[str, tuple, int]], rounds: int = 50):
    """Posterior of each vote pattern and each labeler's yes-rates, one prior per kind.

    Every labeler starts out as better than chance; pseudo-counts keep rates inside (0, 1).
    """
    rates = {name: (0.8, 0.2) for name in LABELERS}
    priors = {kind: 0.5 for kind, _, _ in patterns}
    posterior: list[float] = []
    for _ in range(rounds):
        posterior = []
        for kind, votes, _ in patterns:
            odds = math.log(priors[kind] / (1 - priors[kind]))
            for name, vote in zip(LABELERS, votes):
                if vote is not None:
                    yes, no = rates[name]
                    odds += math.log(yes / no) if vote else math.log((1 - yes) / (1 - no))
            posterior.append(_sigmoid(odds))
        for at, name in enumerate(LABELERS):
            sums = [[8.0, 10.0], [2.0, 10.0]]
            for p, (_, votes, n) in zip(posterior, patterns):
                if votes[at] is not None:
                    for side, share in ((0, p), (1, 1 - p)):
                        sums[side][0] += share * n * votes[at]
                        sums[side][1] += share * n
            yes, no = (min(0.99, max(0.01, a / b)) for a, b in sums)
            rates[name] = (max(yes, no), min(yes, no))
        for kind in priors:
            rows = [(p, n) for p, (k, _, n) in zip(posterior, patterns) if k == kind]
            share = (sum(p * n for p, n in rows) + 1) / (sum(n for _, n in rows) + 2)
            priors[kind] = min(0.95, max(0.05, share))
    return posterior, rates


def _classifier(patterns, posterior, rounds: int = 400, rate: float = 2.0):
    """Logistic weights for kinds and votes, learned from the posteriors of the patterns."""
    keys = sorted({k for k, _, _ in patterns})
    names = [(name, vote) for name in LABELERS for vote in (0, 1)]
    place = {f: i for i, f in enumerate([None, *keys, *names])}
    rows = [[0, place[k], *(place[f] for f in zip(LABELERS, votes) if f[1] is not None)]
            for k, votes, _ in patterns]
    total = math.fsum(math.sqrt(n) for _, _, n in patterns) or 1.0
    weights = [0.0] * len(place)
    for _ in range(rounds):
        push = [-1e-3 * w for w in weights]
        for row, p, (_, _, n) in zip(rows, posterior, patterns):
            error = (p - _sigmoid(sum(weights[i] for i in row))) * math.sqrt(n) / total
            for i in row:
                push[i] += error
        weights = [w + rate * g for w, g in zip(weights, push)]
    return weights, place, keys, names


def fit(docs: DataFrame, text_col: str = "text", kinds: Sequence[Kind] = KINDS) -> Model:
    """Count vote patterns over all documents, estimate reliabilities, train the classifier.

    With no candidate at all the classifier accepts nothing.
    """
    span = docs.select(F.explode(candidates(F.col(text_col), kinds)).alias("s"))
    rows = (
        span.groupBy(F.col("s.kind").alias("kind"), F.col("s.votes").alias("votes"))
        .agg(F.count(F.lit(1)).alias("n")).collect())
    patterns = sorted(((r.kind, tuple(r.votes), r.n) for r in rows), key=repr)
    posterior, rates = _expectation_maximisation(patterns)
    weights, place, keys, names = _classifier(patterns, posterior)
    return Model(weights[0] if patterns else -30.0, {k: weights[place[k]] for k in keys},
                 {f: weights[place[f]] for f in names}, rates)


def _overlaps(a: Column, b: Column) -> Column:
    return (a["start"] < b["end"]) & (b["start"] < a["end"])


def spans(model: Model, text: Column, kinds: Sequence[Kind] = KINDS) -> Column:
    """Accepted spans ``kind, start, end, base`` by kind as listed, then by start.

    A span that passes its base rule is always in. Any other is in if the classifier accepts it
    and no base span, nor an accepted span of an earlier kind, overlaps it.
    """
    def slim(s: Column) -> Column:
        return F.struct(*[s[c].alias(c) for c in ("kind", "start", "end", "base")])

    def adding(name: str, extra: Column) -> Callable[[Column], Column]:
        return lambda done: F.concat(done, F.filter(extra, lambda s: (
            s["kind"] == name) & ~F.exists(done, lambda d: _overlaps(s, d))))

    def chosen(proposed: Column) -> Column:
        base = F.transform(F.filter(proposed, lambda s: s["base"]), slim)
        extra = F.transform(F.filter(
            proposed, lambda s: ~s["base"] & (model.probability(s) >= ACCEPT_FROM)), slim)
        def merged(both: Column) -> Column:
            kept = both["base"]
            for kind in kinds:
                kept = let(kept, adding(kind.name, both["extra"]))
            rank = F.create_map(*[F.lit(x) for k, v in RANK.items() for x in (k, v)])
            keyed = F.transform(kept, lambda s: F.struct(
                F.coalesce(rank[s["kind"]], F.lit(99)).alias("rank"), s["start"].alias("start"),
                s["end"].alias("end"), s["kind"].alias("kind"), s["base"].alias("base")))
            return F.transform(F.array_sort(keyed), slim)

        return let(F.struct(base.alias("base"), extra.alias("extra")), lambda both: F.when(
            F.size(both["extra"]) > 0, merged(both)).otherwise(both["base"]))

    none = F.array().cast("array<struct<kind: string, start: int, end: int, base: boolean>>")
    return let(candidates(text, kinds), lambda p: F.when(F.size(p) > 0, chosen(p)).otherwise(none))


def written_spans(found: Column) -> Column:
    """``kind:start:end``, comma-joined in the order of the array."""
    return F.array_join(F.transform(found, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redacted(text: Column, found: Column) -> Column:
    """The text with each span replaced by its kind in brackets; overlapping spans make one gap."""
    by_place = F.array_sort(F.transform(found, lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    begin = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))

    def add(done: Column, s: Column) -> Column:
        gap = F.substring(text, done["at"] + 1, s["start"] - done["at"])
        parts = F.when(s["start"] < done["at"], done["parts"]).otherwise(F.concat(
            done["parts"], F.array(gap, F.concat(F.lit("["), s["kind"], F.lit("]")))))
        return F.struct(F.greatest(done["at"], s["end"]).alias("at"), parts.alias("parts"))

    rest = lambda done: F.array_join(F.concat(done["parts"], F.array(
        F.substring(text, done["at"] + 1, F.length(text)))), "")
    return F.when(F.size(found) > 0, F.aggregate(by_place, begin, add, rest)).otherwise(text)


def redact(docs: DataFrame, model: Model, text_col: str = "text",
           count_col: str | None = None) -> DataFrame:
    """``docs`` with personal data replaced in the text; the length column follows if it is named."""
    clean = let(F.struct(F.col(text_col).alias("t"), spans(model, F.col(text_col)).alias("s")),
                lambda x: redacted(x["t"], x["s"]))
    out = docs.select(*[clean.alias(c) if c == text_col else F.col(c) for c in docs.columns])
    return out.withColumn(count_col, F.length(text_col).cast("long")) if count_col else out
