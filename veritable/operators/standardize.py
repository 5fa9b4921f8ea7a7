"""Standardization and enrichment of products, purchase orders and inventory.

Raw columns are kept next to the clean ones (the audit frame); ``final_*`` picks the clean
columns and ``to_staging`` gives them their types.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veritable.functions import dates, text
from veritable.functions.numbers import to_number
from veritable.operators import keyed
from veritable.operators.evaluate import union_all
from veritable.operators.rules import CANONICAL_PREFIX
from veritable.sources.schemas import Entity
from veritable.sources.scratch import written

# Keyword in the product name -> category, tried in this order.
CATEGORY_KEYWORDS = {
    "software": "Software",
    "app": "Software",
    "circuit": "Components",
    "board": "Components",
    "pcb": "Components",
    "wrench": "Tools",
    "drill": "Tools",
    "multimeter": "Tools",
    "cable": "Accessories",
    "mount": "Accessories",
    "case": "Accessories",
    "steel": "Materials",
    "wood": "Materials",
    "plastic": "Materials",
    "server": "Hardware",
    "drive": "Hardware",
    "processor": "Electronics",
    "phone": "Electronics",
    "monitor": "Electronics",
}

# table -> date column -> formats, the primary one first
DATE_FALLBACKS: dict[str, dict[str, tuple[str, ...]]] = {
    "purchase_orders": {
        "order_date": (dates.DMY, dates.MDY, dates.YMD),
        "expected_delivery_date": (dates.DMY, dates.MDY, dates.YMD),
    },
    "inventory": {"last_updated": (dates.YMD, dates.DMY, dates.MDY)},
}


# --- category -------------------------------------------------------------------------


def infer_category(name: Column, keywords: Mapping[str, str]) -> Column:
    """The category of the first keyword that occurs anywhere in the lower-cased name."""
    lowered = F.lower(name)
    return F.coalesce(*[F.when(lowered.contains(k), F.lit(c)) for k, c in keywords.items()])


def infer_by_table(names: DataFrame, keywords: DataFrame) -> DataFrame:
    """``name`` (distinct, lower-cased) and a table of ``keyword, category, priority`` → ``name, category``.

    The category is that of the keyword of least priority (ties: the first in order) among those that
    occur anywhere in the name. Names are cut into their substrings of the lengths that keywords have,
    and these meet the keywords in an equi-join, so a name costs its own length however many keywords
    there are. The lengths are one small array; an empty keyword occurs in every name.
    """
    lengths = keywords.agg(F.collect_set(F.length("keyword"))).scalar()
    longest = F.length("name")
    pieces = F.array_distinct(F.flatten(F.transform("lengths", lambda size: F.transform(
        F.sequence(F.lit(1), F.greatest(longest - size + 1, F.lit(1))),
        lambda at: F.substr(F.col("name"), at, size)))))
    cut = names.withColumn("lengths", lengths).select("name", F.explode(pieces).alias("keyword"))
    return cut.join(keywords, "keyword").groupBy("name").agg(
        F.min_by("category", F.struct("priority", "keyword")).alias("category"))


def keyword_table(spark: SparkSession, keywords: Mapping[str, str]) -> DataFrame:
    """An ordered keyword map as the table that ``infer_by_table`` takes."""
    rows = [(k, c, i) for i, (k, c) in enumerate(keywords.items())]
    return spark.createDataFrame(rows, "keyword string, category string, priority long")


def standardize_categories(
    products: DataFrame, keywords: Mapping[str, str] | DataFrame = CATEGORY_KEYWORDS
) -> DataFrame:
    """Add ``category_clean``: trimmed and title-cased, or inferred where it was NULL.

    A map of keywords becomes one expression, for the few keywords of a rule book; a table of any
    size (``infer_by_table``) is joined with the distinct names of products without a category.
    """
    cleaned = text.title(text.strip(F.col("category")))
    if not isinstance(keywords, DataFrame):
        inferred = infer_category(F.col("product_name"), keywords)
        return products.withColumn("category_clean", F.coalesce(cleaned, inferred))
    missing = products.where("category IS NULL")
    names = missing.where("product_name IS NOT NULL").select(
        F.lower("product_name").alias("name")).distinct()
    found = written(infer_by_table(names, keywords), "inferred")
    guessed = keyed.attach(
        missing.withColumn("_lowered", F.lower("product_name")),
        found.select(F.col("name").alias("_lowered"), F.col("category").alias("category_clean")),
        ["_lowered"], "left").drop("_lowered")
    known = products.where("category IS NOT NULL").withColumn("category_clean", cleaned)
    return known.unionByName(guessed)


# --- key prefix -----------------------------------------------------------------------


def standardize_sku_prefix(products: DataFrame, prefix: str = CANONICAL_PREFIX) -> DataFrame:
    """Add ``sku_clean``: the key under one canonical prefix."""
    return products.withColumn("sku_clean", text.replace_prefix(F.col("sku"), prefix))


def key_problems(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once or hold a NULL, with their row count ``n``.

    Nearly every key is one of its own, so a task's partial counts are as many as its rows. Rows are
    dealt out by all their columns first: a task then holds the keys of its share, however large
    the input's splits, and a hot key is still counted in many tasks.
    """
    has_null = F.greatest(*[F.col(k).isNull() for k in keys], F.lit(False))
    dealt = df.select(*keys, F.xxhash64(*df.columns).alias("_share")).repartition("_share")
    return keyed.group_sizes(dealt, keys).filter((F.col("n") > 1) | has_null)


def collisions(products: DataFrame) -> DataFrame:
    """Rewritten keys that more than one product would get."""
    return keyed.group_sizes(products, ["sku_clean"]).filter("n > 1")


def assert_no_collisions(products: DataFrame) -> None:
    """Raise when the prefix rewrite would merge keys. Run before anything is written."""
    n = keyed.surplus_count(products, ["sku_clean"]).first()["violation_count"]
    if n:
        raise ValueError(f"the prefix rewrite creates {n} duplicate key(s)")


def assert_key(df: DataFrame, keys: Sequence[str]) -> None:
    """Raise when ``keys`` cannot be the primary key of ``df``."""
    bad = key_problems(df, keys).limit(5).collect()
    if bad:
        raise ValueError(f"({', '.join(keys)}) is no key: {[tuple(r) for r in bad]}")


# --- price ----------------------------------------------------------------------------

#: Distinct values of a group that are ranked in one task; a group with more is narrowed first.
RANKED_VALUES = 100_000
#: Ranges that a group is cut into when it is narrowed, and the accuracy of their borders.
RANGES = 64
ACCURACY = 10_000


def _around_the_median(rows: Column, upto: Column) -> Column:
    """Whether ``rows`` rows that end at position ``upto`` hold one of the middle positions."""
    return (upto >= F.floor((F.col("total") + 1) / 2)) & (
        upto - rows < F.floor(F.col("total") / 2) + 1)


def _narrowed(values: DataFrame, group: str, value: str) -> DataFrame:
    """The distinct values of the one or two ranges per group that the median lies in.

    The borders are approximate quantiles, the rows of each range are counted. So poor borders make
    ranges of unequal size, but never a wrong one.
    """
    at = [i / RANGES for i in range(1, RANGES)]
    borders = written(
        values.groupBy(group).agg(
            F.percentile_approx(value, F.array(*map(F.lit, at)), ACCURACY).alias("borders")),
        "borders")
    dealt = keyed.attach(values, borders, [group], "inner").withColumn(
        "range", F.size(F.filter("borders", lambda b: b < F.col(value)))).drop("borders")
    in_order = Window.partitionBy(group).orderBy("range")  # at most RANGES rows a group
    ranges = (
        dealt.groupBy(group, "total", "before", "range").agg(F.sum("n").alias("rows"))
        .withColumn("upto", F.col("before") + F.sum("rows").over(in_order))
        .filter(_around_the_median(F.col("rows"), F.col("upto")))
        .withColumn("start", F.min(F.col("upto") - F.col("rows")).over(Window.partitionBy(group))))
    chosen = written(ranges.select(group, "range", "start"), "ranges")
    return keyed.attach(dealt, chosen, [group, "range"], "inner").select(
        group, value, "n", "total", F.col("start").alias("before"))


def exact_medians(
    df: DataFrame, group: str, value: str, ranked: int = RANKED_VALUES
) -> DataFrame:
    """Exact median of ``value`` per non-NULL ``group``, whatever the size of a group.

    Equal values of a group collapse into a count, in a shuffle by group and value. While a group
    has over ``ranked`` distinct values, groups are narrowed to the range around the median; what is
    left is ranked. Each narrowing leaves about a thirtieth of the values at most.
    """
    present = df.select(group, value).filter(F.col(group).isNotNull() & F.col(value).isNotNull())
    counts = written(keyed.group_sizes(present, [group, value]), "values")
    totals = written(counts.groupBy(group).agg(F.sum("n").alias("total")), "totals")
    values = keyed.attach(counts, totals, [group], "inner").withColumn(
        "before", F.lit(0).cast("long"))
    largest = counts.groupBy(group).count().agg(F.max("count"))
    while (largest.first()[0] or 0) > ranked:
        values = written(_narrowed(values, group, value), "narrowed")
        largest = values.groupBy(group).count().agg(F.max("count"))

    by_value = Window.partitionBy(group).orderBy(value)  # at most ``ranked`` rows a group
    middle = values.withColumn("upto", F.col("before") + F.sum("n").over(by_value)).filter(
        _around_the_median(F.col("n"), F.col("upto")))
    return middle.groupBy(group).agg(((F.min(value) + F.max(value)) / 2).alias("median"))


#: Size of a quantile sketch. The rank of a sketched median is off by 1.65 % of the rows at most, in 99 %
#: of cases, at 200; twice the size halves that.
SKETCH_K = 200


def median_sketches(df: DataFrame, group: str, value: str, k: int = SKETCH_K) -> DataFrame:
    """``group, n, sketch``: a quantile sketch per non-NULL group, which later loads can be added to.

    One partial aggregation: a task sends one sketch per group however many rows it has, while
    ``exact_medians`` shuffles the distinct values. For medians that may be off by a stated rank.
    """
    present = df.select(group, F.col(value).cast("double").alias("_v")).where(
        F.col(group).isNotNull() & F.col("_v").isNotNull())
    return present.groupBy(group).agg(
        F.count(F.lit(1)).alias("n"), F.kll_sketch_agg_double("_v", F.lit(k)).alias("sketch"))


def sketched_medians(sketches: DataFrame, group: str) -> DataFrame:
    """Medians of ``median_sketches`` of any number of loads."""
    merged = sketches.groupBy(group).agg(
        F.sum("n").alias("n"), F.kll_merge_agg_double("sketch").alias("sketch"))
    return merged.select(
        group, "n", F.kll_sketch_get_quantile_double("sketch", F.lit(0.5)).alias("median"))


def category_medians(products: DataFrame) -> DataFrame:
    """Median price per clean category. NULL categories have none."""
    priced = products.withColumn("price", to_number(F.col("price")))
    return exact_medians(priced, "category_clean", "price")


def impute_price(products: DataFrame, medians: DataFrame) -> DataFrame:
    """Make ``price`` a number and add ``price_clean``, filled with the category's median."""
    joined = keyed.attach(products, medians, ["category_clean"], "left")
    price = to_number(F.col("price"))
    return joined.withColumn("price_clean", F.coalesce(price, F.col("median"))).withColumn(
        "price", price).drop("median")


def standardize_products(
    products: DataFrame,
    keywords: Mapping[str, str] | DataFrame = CATEGORY_KEYWORDS,
    prefix: str = CANONICAL_PREFIX,
    sketch_k: int | None = None,
) -> DataFrame:
    """The product audit frame: raw columns, then category, key and price made clean.

    Medians are exact unless ``sketch_k`` asks for sketches of that size. The medians are written first, so that Spark knows their size when it plans the join: one
    row per category is broadcast and the products are not shuffled.
    """
    tagged = standardize_sku_prefix(standardize_categories(products, keywords), prefix)
    if sketch_k:
        sketches = median_sketches(
            tagged.withColumn("price", to_number(F.col("price"))), "category_clean", "price", sketch_k)
        medians = sketched_medians(sketches, "category_clean").drop("n")
    else:
        medians = category_medians(tagged)
    medians = written(medians, "category_medians")
    return impute_price(tagged, medians).select(
        *products.columns, "category_clean", "sku_clean", "price_clean")


def final_products(audit: DataFrame) -> DataFrame:
    return audit.select(
        F.col("sku_clean").alias("sku"), "product_name",
        F.col("category_clean").alias("category"),
        F.col("price_clean").alias("price"), "supplier_id",
    )


# --- dates ----------------------------------------------------------------------------


def standardize_dates(df: DataFrame, column: str, formats: Sequence[str]) -> DataFrame:
    """Add ``<column>_standardized``: a DATE by the first format that fits."""
    return df.withColumn(f"{column}_standardized", dates.parse_first(F.col(column), formats))


def standardize_table_dates(
    df: DataFrame, table: str, formats: Mapping[str, Mapping[str, Sequence[str]]] = DATE_FALLBACKS
) -> DataFrame:
    """The audit frame of a table with dates."""
    for column, fmts in formats[table].items():
        df = standardize_dates(df, column, fmts)
    return df


def final_dates(audit: DataFrame, table: str) -> DataFrame:
    """Raw columns, with each date replaced by its standardized form."""
    columns = DATE_FALLBACKS[table]
    return audit.select(*[
        F.col(f"{c}_standardized").alias(c) if c in columns else F.col(c)
        for c in audit.columns if not c.endswith("_standardized")
    ])


def date_recovery_counts(
    df: DataFrame, table: str, formats: Mapping[str, Sequence[str]]
) -> DataFrame:
    """Per date column: values present, read by the primary format, recovered, unresolved."""
    aggs, rows = [], []
    for c, fmts in formats.items():
        which = dates.matched_format(F.col(c), fmts)
        aggs += [
            F.count(c).alias(f"{c}_present"),
            F.count_if(which == 0).alias(f"{c}_primary"),
            F.count_if(which > 0).alias(f"{c}_recovered"),
            F.count_if(F.col(c).isNotNull() & which.isNull()).alias(f"{c}_unresolved"),
        ]
        rows.append(F.struct(
            F.lit(table).alias("table"), F.lit(c).alias("column"),
            F.col(f"{c}_present").alias("non_null"), F.col(f"{c}_primary").alias("primary_ok"),
            F.col(f"{c}_recovered").alias("recovered"),
            F.col(f"{c}_unresolved").alias("unresolved"),
        ))
    return df.agg(*aggs).select(F.inline(F.array(*rows)))


def all_date_recovery_counts(frames: Mapping[str, DataFrame]) -> DataFrame:
    return union_all([
        date_recovery_counts(frames[t], t, columns) for t, columns in DATE_FALLBACKS.items()
    ])


# --- typed staging --------------------------------------------------------------------


def to_staging(df: DataFrame, entity: Entity) -> DataFrame:
    """The entity's columns under their staging types; text that does not fit becomes NULL."""
    return df.select(*[c.alias(name) for name, c in staged_columns(entity).items()])


def lost_casts(df: DataFrame, entity: Entity) -> DataFrame:
    """Per typed column, how many values ``to_staging`` would turn into NULL or round."""
    return df.agg(*[c.alias(n) for n, c in lost_counts(df, entity).items()]).unpivot(
        [], list(entity.typed), "column", "lost")


def lost_counts(df: DataFrame, entity: Entity) -> dict[str, Column]:
    """The aggregates of ``lost_casts``, for a job that writes ``df`` to compute on its way."""
    return {c: F.count_if(_inexact(df, c, t)) for c, t in entity.typed.items()}


def _altered(df: DataFrame, column: str, typed: str) -> Column:
    """Whether a value that can be cast comes out as another. Plain digits are compared as text."""
    value, cast = F.col(column), F.col(column).try_cast(typed)
    if not typed.startswith("decimal"):
        return F.lit(False)
    wide, scale = map(int, re.findall("[0-9]+", typed))
    altered = cast.cast("double") != value.try_cast("double")
    if dict(df.dtypes)[column] == "string":
        plain = rf"^\s*[+-]?0*[0-9]{{0,{wide - scale}}}(?:\.[0-9]{{0,{scale}}}0*)?\s*$"
        altered = ~value.rlike(plain) & (~F.lower(value).contains("e") | altered)
    return altered


def _inexact(df: DataFrame, column: str, typed: str) -> Column:
    """Whether a value is lost or altered by its type."""
    value, cast = F.col(column), F.col(column).try_cast(typed)
    return value.isNotNull() & (cast.isNull() | _altered(df, column, typed))


def assert_no_lost_casts(report: DataFrame) -> None:
    """Stop when a staging column would lose or round a value."""
    bad = report.where("lost > 0").limit(20).collect()
    if bad:
        found = ", ".join(f"{r.table_name}.{r.column}: {r.lost}" for r in bad)
        raise ValueError(f"values that do not fit their staging types: {found}")


#: Staging tables whose key must be there and unique.
PRIMARY_KEYS = ("products", "purchase_orders")
#: What ``governance.staging_rejects`` says of a row that staging cannot take; one row per reason.
STAGING_REJECTS = T.StructType(
    [T.StructField(c, T.StringType()) for c in ("key", "column", "raw_value", "reason")])


def with_repeats(df: DataFrame, entity: Entity, unique: bool = True) -> DataFrame:
    """Mark the rows whose primary key other rows have too (``_repeated``).

    Keys are counted first; unless some are repeated, no row is joined.
    """
    repeated = None
    if unique:
        known = " AND ".join(f"`{k}` IS NOT NULL" for k in entity.key)
        repeated = written(key_problems(df, entity.key).where(known).select(*entity.key), "repeated")
    if repeated is None or not repeated.head(1):
        return df.withColumn("_repeated", F.lit(False))
    marked = keyed.attach(df, repeated.withColumn("_again", F.lit(True)), entity.key, "left")
    return marked.withColumn("_repeated", F.coalesce("_again", F.lit(False))).drop("_again")


def staging_faults(df: DataFrame, entity: Entity, unique: bool = True) -> Column:
    """All reasons why staging cannot take a row of ``with_repeats``; an empty array if it can.

    A typed value that its type cannot hold, and for a table with a primary key (``unique``) a NULL
    in it, or a key that several rows have: which of these is right is not known here, so none is
    taken.
    """
    key = F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in entity.key])

    def fault(column: str, reason: str, wrong: Column) -> Column:
        return F.when(wrong, F.struct(
            key.alias("key"), F.lit(column).alias("column"),
            F.col(column).cast("string").alias("raw_value"), F.lit(reason).alias("reason")))

    faults = []
    if unique:
        faults += [fault(k, "key is null", F.col(k).isNull()) for k in entity.key]
        faults.append(fault(entity.key[0], "key is repeated", F.col("_repeated")))
    for c, typed in entity.typed.items():
        unread = F.col(c).isNotNull() & F.col(c).try_cast(typed).isNull()
        faults.append(fault(c, f"no {typed}", unread))
        faults.append(fault(c, f"not exact as {typed}", ~unread & _altered(df, c, typed)))
    return F.filter(F.array(*faults), lambda f: f.isNotNull())


def staged_columns(entity: Entity) -> dict[str, Column]:
    return {c: F.col(c).try_cast(entity.typed[c]) if c in entity.typed else F.col(c)
            for c in entity.columns}
