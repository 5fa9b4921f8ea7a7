"""Language identification by error-correcting output codes.

Each language has a codeword. One logistic classifier per bit, on hashed character n-grams, predicts
that bit; a text gets the language whose codeword has the least loss, the bits weighted by how
reliable they were in training. A text that lies about as near to a second codeword is flagged.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNDETERMINED = "und"
DIMENSIONS = 1 << 13
ORDERS = (1, 2, 3)
#: Labelled rows to learn from: so many of each language, and of all languages together.
ROWS_PER_LANGUAGE = 300
ROWS = 6000
#: A second codeword whose posterior is over this share of the best one's makes a text ambiguous.
AMBIGUITY = 0.5
CHARS_AT_ONCE = 1 << 20
DOCS_AT_ONCE = 64
EXHAUSTIVE_UP_TO = 6

_LETTER = regex.compile(r"\p{L}")
_FOLD = np.array([c if chr(c).isalpha() else 32 for c in range(128)], np.uint32)


def has_letter(text: str | None) -> bool:
    return bool(text) and _LETTER.search(text) is not None


def _grams(codes: np.ndarray, starts: int) -> Iterator[np.ndarray]:
    """Hashed n-grams that begin in the first ``starts`` positions."""
    h = np.zeros(len(codes), np.uint32)
    for order in ORDERS:
        h = h[:len(codes) - order + 1] * np.uint32(0x9E3779B1) + codes[order - 1:] + np.uint32(order)
        mixed = h ^ (h >> np.uint32(15))
        yield (mixed * np.uint32(0x85EBCA6B) >> np.uint32(19))[:starts]


def features(text: str) -> np.ndarray:
    """Square roots of hashed n-gram counts over the whole text, with norm 1."""
    counts = np.zeros(DIMENSIONS, np.int64)
    lowered = text.lower()
    for at in range(0, len(lowered), CHARS_AT_ONCE):
        part = lowered[at:at + CHARS_AT_ONCE + max(ORDERS) - 1]
        codes = np.frombuffer(part.encode("utf-32-le", "surrogatepass"), "<u4")
        codes = np.where(codes < 128, _FOLD[np.minimum(codes, 127)], codes)
        for grams in _grams(codes, CHARS_AT_ONCE):
            counts += np.bincount(grams, minlength=DIMENSIONS)
    row = np.sqrt(counts, dtype=np.float32)
    return row / max(float(np.sqrt(row @ row)), 1e-9)


def codewords(classes: int, seed: int = 7) -> np.ndarray:
    """A row of ±1 per class: all splits of the classes if they are few, else random and far apart."""
    if classes <= 1:
        return np.ones((classes, 0), np.float32)
    if classes <= EXHAUSTIVE_UP_TO:
        bits = [[1 if c == 0 or s >> c - 1 & 1 else -1 for c in range(classes)]
                for s in range(2 ** (classes - 1) - 1)]
        return np.array(bits, np.float32).T
    rng, width = np.random.default_rng(seed), 8 * math.ceil(math.log2(classes)) + 7
    tries = (rng.choice(np.array([-1, 1], np.float32), (classes, width)) for _ in range(100))
    return max(tries, key=lambda m: -(m @ m.T - 2 * width * np.eye(classes)).max())


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    codes: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    trust: np.ndarray

    def posteriors(self, rows: np.ndarray) -> np.ndarray:
        """Per row and language, from the weighted loss of its codeword."""
        margins = rows @ self.weights + self.bias
        loss = np.logaddexp(0, -margins[:, None, :] * self.codes[None]) @ self.trust
        odds = np.exp(loss.min(axis=1, keepdims=True) - loss)
        return odds / odds.sum(axis=1, keepdims=True)

    def predict(self, texts: list[str | None]) -> list[tuple[str, float, bool]]:
        out = [(UNDETERMINED, 0.0, True)] * len(texts)
        known = [i for i, t in enumerate(texts) if self.languages and has_letter(t)]
        for at in range(0, len(known), DOCS_AT_ONCE):
            block = known[at:at + DOCS_AT_ONCE]
            found = self.posteriors(np.stack([features(texts[i]) for i in block]))
            for i, p in zip(block, found):
                best = int(p.argmax())
                second = float(np.delete(p, best).max(initial=0))
                out[i] = (self.languages[best], min(1.0, float(p[best])),
                          second > AMBIGUITY * p[best])
        return out


def train(rows: np.ndarray, labels: np.ndarray, languages: tuple[str, ...],
          rounds: int = 150, rate: float = 12.0, decay: float = 1e-4) -> Model:
    """One logistic classifier per bit, all by the same full-batch steps with momentum."""
    codes = codewords(len(languages))
    target = codes[labels] if len(labels) else np.ones((0, codes.shape[1]), np.float32)
    sizes = np.bincount(labels, minlength=len(languages))
    share = (1 / np.maximum(sizes[labels], 1) / max(len(languages), 1)).astype(np.float32)
    weights = np.zeros((DIMENSIONS, codes.shape[1]), np.float32)
    bias, speed, push = np.zeros(codes.shape[1], np.float32), weights.copy(), 0.0
    for _ in range(rounds):
        margin = (rows @ weights + bias) * target
        pull = -target * share[:, None] / (1 + np.exp(np.clip(margin, -30, 30)))
        speed = 0.9 * speed - rate * (rows.T @ pull + decay * weights)
        push = 0.9 * push - rate * pull.sum(axis=0)
        weights, bias = weights + speed, bias + 0.1 * push
    right = ((rows @ weights + bias) * target > 0).astype(np.float32).T @ share
    trust = np.maximum(2 * right - 1, 0.01)
    return Model(languages, codes, weights, bias, trust.astype(np.float32))


def sample(docs: DataFrame, lang_col: str, text_col: str, id_col: str) -> DataFrame:
    """``lang, text`` of at most about ``ROWS_PER_LANGUAGE`` labelled rows of each language.

    Rows are chosen by a hash of id and text, at a rate that follows the language's row count.
    """
    labelled = docs.select(
        F.col(lang_col).alias("lang"), F.col(text_col).alias("text"), F.col(id_col).alias("id")
    ).where("lang is not null and text is not null")
    sizes = {r.lang: r["n"] for r in
             labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes:
        return labelled.select("lang", "text").limit(0)
    each = max(4, min(ROWS_PER_LANGUAGE, ROWS // len(sizes)))
    rate = F.create_map(*[F.lit(x) for lang, n in sorted(sizes.items())
                          for x in (lang, min(1.0, each / n))])
    unit = F.pmod(F.xxhash64("id", "text", F.lit("sample")), F.lit(1 << 30)) / float(1 << 30)
    return labelled.where(unit < rate[F.col("lang")]).select("lang", "text").limit(2 * ROWS)


def _sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lang, text in zip(*(c.to_pylist() for c in batch.columns)):
            if has_letter(text):
                row = features(text)
                at = np.flatnonzero(row)
                yield pa.record_batch([
                    pa.array([lang]), pa.array([at.astype("<u2").tobytes()], pa.binary()),
                    pa.array([row[at].tobytes()], pa.binary())], ["lang", "at", "value"])


def fit(docs: DataFrame, lang_col: str = "lang", text_col: str = "text",
        id_col: str = "doc_id") -> Model:
    """Learn from a bounded sample of the labelled rows; only their features reach the driver."""
    found = sorted((r.lang, bytes(r["at"]), bytes(r["value"])) for r in sample(
        docs, lang_col, text_col, id_col).mapInArrow(
            _sparse, "lang string, at binary, value binary").collect())
    languages = tuple(sorted({lang for lang, _, _ in found}))
    rows = np.zeros((len(found), DIMENSIONS), np.float32)
    for i, (_, at, value) in enumerate(found):
        rows[i, np.frombuffer(at, "<u2")] = np.frombuffer(value, np.float32)
    labels = np.array([languages.index(lang) for lang, _, _ in found], np.int64)
    return train(rows, labels, languages)


def predict(model: Model, text: Column) -> Column:
    """``lang, score, ambiguous``. ``und`` with score 0 for null, for text without letters, and if
    there was no language to learn; else the score is the best language's posterior."""
    @F.pandas_udf("lang string, score double, ambiguous boolean")
    def named(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame(model.predict(texts.tolist()), columns=["lang", "score", "ambiguous"])

    return named(text)


#: A text whose language is ambiguous must be made of letters by this part at least.
LETTER_SHARE = 0.2


def determined(model: Model, text: Column) -> Column:
    """Whether a text is in some language: it has a letter, and unless letters are few among its
    characters (``LETTER_SHARE``), or its language is not ambiguous, it is kept.

    Short texts keep the nearest language. Without a learned language nothing can be said against a
    text, so every one with a letter is kept. Null and empty texts are not; rows are judged one by one.
    """
    letters = F.length(F.regexp_replace(text, r"\P{L}+", ""))
    worded = F.coalesce(letters > 0, F.lit(False))
    if not model.languages:
        return worded
    told = predict(model, text)
    mostly = letters >= LETTER_SHARE * F.length(F.regexp_replace(text, r"\s+", ""))
    return worded & (told["lang"] != UNDETERMINED) & (~told["ambiguous"] | mostly)
