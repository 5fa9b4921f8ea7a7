"""Key-based building blocks that hold up when one key owns a large part of the rows.

Counts are always taken before a shuffle (partial aggregation), so a hot key arrives as one
row per task. Where rows themselves must meet a per-key result, they do so in an equi-join
that the adaptive planner can split; nothing gathers a key's rows in one task.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

COPIES_PER_TASK_ROW = 1_000_000


def attach(rows: DataFrame, per_key: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Join ``rows`` with a frame that has one row per key; NULL keys match each other.

    No size hint: Spark broadcasts ``per_key`` only when its measured size allows. Otherwise
    both sides are shuffled for this join. The null-safe condition matters for that: with plain
    equality Spark would reuse the partitioning of the aggregation under ``per_key``, and
    adaptive execution splits a hot key only when both inputs are shuffles of the join itself.
    """
    right = per_key.select([F.col(k).alias(f"_{k}") for k in keys]
                           + [c for c in per_key.columns if c not in keys])
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
    return rows.join(right, same, how).drop(*[f"_{k}" for k in keys])


def group_sizes(df: DataFrame, keys: Sequence[str], *aggs: Column) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), *aggs)


def surplus_count(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: how many rows repeat a key that another row already has."""
    surplus = F.coalesce(F.sum(F.col("n") - 1), F.lit(0))
    return group_sizes(df, keys).agg(surplus.alias("violation_count"))


def duplicated(df: DataFrame, keys: Sequence[str], record_id: str) -> DataFrame:
    """Ids of all rows whose key occurs more than once."""
    groups = group_sizes(df, keys).filter("n > 1").select(*keys)
    return attach(df.select(record_id, *keys), groups, keys, "left_semi").select(record_id)


def surplus(df: DataFrame, keys: Sequence[str], record_id: str, order: Column) -> DataFrame:
    """Ids of all rows but the first of each key; the first has the least (order, id).

    Ids of all members are counted, less one for each key that the id comes first in. So no
    ranking over a whole group is needed, and copies of a first row are kept. All rows are only
    counted by key; the first row is sought among the rows of repeated keys.
    """
    groups = group_sizes(df, keys).filter("n > 1").select(*keys)
    members = attach(df.select(record_id, *keys, order.alias("_order")), groups, keys, "left_semi")
    position = F.struct(F.col("_order").alias("o"), F.col(record_id).alias("id"))
    firsts = members.groupBy(*keys).agg(F.min(position).alias("first")).select(
        F.col("first.id").alias(record_id))
    signed = members.select(record_id, F.lit(1).alias("n")).unionByName(
        firsts.withColumn("n", F.lit(-1)))
    later = signed.groupBy(record_id).agg(F.sum("n").alias("n"))
    once = later.filter("n = 1").select(record_id)
    return once.unionByName(repeat_rows(later.filter("n > 1")))


def repeat_rows(df: DataFrame) -> DataFrame:
    """Each row ``n`` times. Large counts are cut into pieces and spread over tasks first."""
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    piece = F.lit(COPIES_PER_TASK_ROW).cast("long")
    last = F.floor((F.col("n") - 1) / piece)
    pieces = df.withColumn("_piece", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    size = F.least(piece, F.col("n") - F.col("_piece") * piece)
    return (
        pieces.withColumn("_size", size)
        .repartition(tasks)
        .withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_size"))))
        .drop("n", "_piece", "_size", "_copy")
    )


def missing_keys(
    child: DataFrame, child_key: Column, parent: DataFrame, parent_key: Column
) -> DataFrame:
    """Distinct child keys with their row count ``n`` and whether a parent ``found`` them.

    NULL counts as a key (``no_key``): it is found only when the parent has a NULL key too.
    Both sides are grouped by what they are joined on, so the join adds no shuffle.
    """
    def parts(key: Column) -> list[Column]:
        text = F.coalesce(key.cast("string"), F.lit(""))
        return [text.alias("key"), key.isNull().alias("no_key")]

    on = ["key", "no_key"]
    keys = group_sizes(child.select(parts(child_key)), on)
    parents = parent.select(parts(parent_key)).distinct().withColumn("found", F.lit(True))
    return keys.join(parents, on, "left")
