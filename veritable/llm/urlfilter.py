"""URL filters: rules first, then logistic regression on hashed character n-grams.

The model learns from a small labelled table of URLs. Features, training data and scores are
column expressions; only the hashed rows of the small table reach the driver, which fits the weights.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veritable.llm.url_labels import UNWANTED, WANTED
from veritable.llm.words import ascii_lower, let

DIMENSIONS = 4096
ORDERS = (3, 4)
#: Rows of the labelled table that may be learned from; more raise an error.
LABELLED_ROWS = 20_000
BLOCK_FROM = 0.5

#: Rules as verdict, host, path.
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)

def labelled_urls(spark: SparkSession, held_out: bool | None = None) -> DataFrame:
    """``url, blocked``: the labelled table that is used if none is given.

    ``held_out`` picks the fifth of it (by a digest of the url) on which precision and recall are
    measured, or the rest; by default all of it.
    """
    groups = F.array(*[F.struct(F.lit(urls.strip()).alias("urls"), F.lit(blocked).alias("blocked"))
                       for blocked, urls in ((1, UNWANTED), (0, WANTED))])
    table = spark.range(1).select(F.explode(groups).alias("g")).select(
        F.explode(F.split("g.urls", "\n")).alias("url"), "g.blocked")
    if held_out is None:
        return table
    return table.where((F.crc32("url") % 5 == 0) == held_out)


def host(url: Column) -> Column:
    """From the first :// up to /, ? or #, lower-cased; empty for null or without ://."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return ascii_lower(rest)


def path(url: Column) -> Column:
    """What follows the host up to ? or #; empty for null or without ://."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule(host_: Column, path_: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> Column:
    """``verdict, rule`` of the longest rule that fits (ties: longer host, then text), else null."""
    out = F.lit(None).cast("struct<verdict: string, rule: string>")
    for verdict, name, start in sorted(rules, key=lambda r: (len(r[1] + r[2]), len(r[1]), r[1:])):
        fits = ((host_ == name) | host_.endswith("." + name)) & path_.startswith(start)
        here = F.struct(F.lit(verdict).alias("verdict"), F.lit(name + start).alias("rule"))
        out = F.when(fits, here).otherwise(out)
    return out


def features(host_: Column, path_: Column) -> Column:
    """Hashed n-grams of host and path as an array of feature numbers, repeats included.

    Host and path hash apart, and digits count as one sign.
    """
    def grams(part: str, text: Column, order: int) -> Column:
        marked = F.concat(F.lit("^"), F.regexp_replace(text, "[0-9]+", "0"), F.lit("$"))
        return let(F.array_remove(F.split(marked, ""), ""), lambda s: F.when(
            F.size(s) >= order,
            F.transform(F.sequence(F.lit(1), F.size(s) - (order - 1)),
                        lambda i: F.pmod(F.xxhash64(F.lit(part), F.slice(s, i, order)),
                                         F.lit(DIMENSIONS)).cast("int"))
        ).otherwise(F.array().cast("array<int>")))

    return F.concat(*[grams(p, t, n) for p, t in (("h", host_), ("p", path_)) for n in ORDERS])


def train(labelled: DataFrame, url_col: str = "url", label_col: str = "blocked",
          rounds: int = 300, rate: float = 1.0, decay: float = 1e-4) -> list[float]:
    """Weights of the logistic model, the intercept last. Null urls and labels are left out.

    A text's score is the mean of its n-grams' weights times the square root of their number.
    """
    url = F.col(url_col)
    rows = (
        labelled.where(url.isNotNull() & F.col(label_col).isNotNull())
        .select(F.col(label_col).cast("int").alias("y"), features(host(url), path(url)).alias("x"))
        .limit(LABELLED_ROWS + 1).collect())
    if len(rows) > LABELLED_ROWS:
        raise ValueError(f"over {LABELLED_ROWS} labelled urls")
    rows.sort(key=lambda r: (r.y, r.x))
    at = np.concatenate([np.array(r.x, int) for r in rows]) if rows else np.zeros(0, int)
    sizes = np.array([len(r.x) for r in rows], int)
    owner = np.repeat(np.arange(len(rows)), sizes)
    scale = 1 / np.sqrt(np.maximum(sizes, 1))
    y = np.array([r.y for r in rows], float)
    weights, bias = np.zeros(DIMENSIONS), 0.0
    for _ in range(rounds if rows else 0):
        score = np.bincount(owner, weights[at], len(rows)) * scale + bias
        error = y - 1 / (1 + np.exp(-score))
        push = np.bincount(at, (error * scale)[owner], DIMENSIONS)
        weights += rate * (push / len(rows) * 20 - decay * weights)
        bias += rate * error.mean()
    return [*weights.tolist(), bias]


def probability(weights: Sequence[float], host_: Column, path_: Column) -> Column:
    """The model's probability that a url is unwanted. The weights are one constant of the plan."""
    table = F.split(F.lit(",".join(map(repr, weights[:-1]))), ",").cast("array<double>")
    total = let(features(host_, path_), lambda x: F.aggregate(
        x, F.lit(0.0), lambda so_far, i: so_far + F.get(table, i)
    ) / F.sqrt(F.greatest(F.size(x), F.lit(1)).cast("double")))
    return 1 / (1 + F.exp(-(total + float(weights[-1]))))


def judge(pages: DataFrame, weights: Sequence[float], id_col: str = "page_id", url_col: str = "url",
          rules: Sequence[tuple[str, str, str]] = RULES) -> DataFrame:
    """``id, host, path, rule, verdict, probability`` per row, with no shuffle.

    The rule's verdict holds; where none fits, the model decides, and ``probability`` is what
    it says of any url. A url without host is judged by the intercept and the empty text. Repeated rows
    get equal results; an empty table gives an empty one.
    """
    cut = pages.select(F.col(id_col).alias("id"), host(F.col(url_col)).alias("host"),
                       path(F.col(url_col)).alias("path"))
    host_, path_ = F.col("host"), F.col("path")
    judged = cut.select("*", rule(host_, path_, rules).alias("fit"),
                        probability(weights, host_, path_).alias("probability"))
    by_model = F.when(F.col("probability") >= BLOCK_FROM, "block").otherwise("allow")
    return judged.select("id", "host", "path", F.col("fit.rule").alias("rule"),
                         F.coalesce(F.col("fit.verdict"), by_model).alias("verdict"), "probability")
