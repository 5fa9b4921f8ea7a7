"""Exact top-k by inner product in M-trees.

With one more coordinate, sqrt(M - |x|^2), all vectors lie on a sphere, and the largest inner product
with a query is the least distance to it. The space is cut into cells around pivots; each cell has its
covering radius and its tree, built once and stored: leaf pages around pivots, and pages of pages above
them, each with a covering radius and its distance to the parent's pivot. A query is run through the
tree of its nearest cell; its k-th score there decides by the radii which other cells it has to visit.
All queries of a task go through a tree together: each first to the leaf with the best bound, then
to every node that its k-th score cannot rule out, where one matrix product serves all of them.
Stored distances rule out nodes before a distance is computed. Scores are exact integer products, and
bounds get slack for rounding, so ties are never cut off.
"""

from __future__ import annotations

import heapq
import math
import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veritable.sources.scratch import written

TOP = 5
PAGE = 64
#: Vectors that one tree holds, and queries that one task runs through it.
BLOCK_ROWS = 16_384
BLOCK_QUERIES = 2_048
#: Rows for one more cell, and the most bytes that all pivots may take; every task holds them.
CELL_ROWS = 1024
ROWS_AT_ONCE = 256
PIVOT_BYTES = 32 << 20
SCALE = 256
#: Stands for scores that are far from fitting a long.
BEYOND = 10 ** 37


def quantized(vector: Column) -> Column:
    """floor(256 x) per component, as a double, which holds it exactly; null if the vector is null or
    holds null, NaN or infinity. From 2 ** 53 on every double is an integer."""
    x = vector.cast("array<double>")
    good = vector.isNotNull() & F.forall(x, lambda v: F.coalesce(
        ~F.isnan(v) & (F.abs(v) < float("inf")), F.lit(False)))
    return F.when(good, F.transform(x, lambda v: F.when(
        F.abs(v) < 2.0 ** 44, F.floor(v * SCALE).cast("double")).otherwise(v * SCALE)))


def products(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Exact inner products of vectors of integers, in the narrowest arithmetic that holds them."""
    most = float(np.abs(rows).max(initial=0.0)) * float(np.abs(queries).max(initial=0.0))
    if most * max(rows.shape[1], 1) < 2.0 ** 53:
        return queries @ rows.T
    wide = [[(i, int(x)) for i, x in enumerate(row) if x] for row in rows.tolist()]
    out = np.zeros((len(queries), len(rows)), object)
    for row, query in zip(out, queries.tolist()):
        whole = [int(x) for x in query]
        row[:] = [sum(x * whole[i] for i, x in some) for some in wide]
    return out


@dataclass
class Node:
    """A page: its entries' distances to its pivot bound them before they are looked at."""

    pivot: np.ndarray
    radius: float
    rows: np.ndarray | None
    children: list[Node]
    to_pivot: np.ndarray
    pivots: np.ndarray | None = None
    radii: np.ndarray | None = None


def _distances(points: np.ndarray, pivot: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(((points - pivot) ** 2).sum(axis=1), 0))


def _all_distances(points: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """From each point to each pivot; rounding stays within the slack of ``reach``."""
    squares = (points ** 2).sum(axis=1)[:, None] + (pivots ** 2).sum(axis=1) - 2 * (points @ pivots.T)
    return np.sqrt(np.maximum(squares, 0, out=squares), out=squares)


def _lowered(score):
    """A bit less than a score, so that no equal one is lost by rounding."""
    return score - 1e-9 * np.abs(score)


def _split(points: np.ndarray, rows: np.ndarray, size: int) -> list[np.ndarray]:
    """Groups of at most ``size`` rows, halved along the line through two far points."""
    done, todo = [], [rows]
    while todo:
        part = todo.pop()
        if len(part) <= size:
            done.append(part)
            continue
        here = points[part]
        a = here[_distances(here, here.mean(axis=0)).argmax()]
        b = here[_distances(here, a).argmax()]
        order = np.argsort((here @ (b - a)), kind="stable")
        half = len(part) // 2
        todo += [part[order[:half]], part[order[half:]]]
    return done


def build(points: np.ndarray, page: int = PAGE) -> Node | None:
    """A tree over the rows of ``points``."""
    if not len(points):
        return None
    level = []
    for rows in _split(points, np.arange(len(points)), page):
        pivot = points[rows].mean(axis=0)
        far = _distances(points[rows], pivot)
        level.append(Node(pivot, float(far.max()), rows, [], far))
    while len(level) > 1:
        pivots = np.stack([n.pivot for n in level])
        above = []
        for group in _split(pivots, np.arange(len(level)), page):
            inside = [level[i] for i in group]
            pivot = pivots[group].mean(axis=0)
            far = _distances(pivots[group], pivot)
            radii = np.array([n.radius for n in inside])
            above.append(Node(pivot, float((far + radii).max()), None, inside, far,
                              pivots[group], radii))
        level = above
    return level[0]


class Tree:
    """Some vectors of whole doubles, searched for the largest integer inner products.

    ``most`` is the square of the sphere's radius, at least the largest squared length.
    """

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, page: int = PAGE, most: float | None = None):
        order = np.argsort(ids, kind="stable")
        self.ids, self.vectors = ids[order], vectors[order].astype(np.float64)
        self.most = float((self.vectors ** 2).sum(axis=1).max(initial=0.0)) if most is None else most
        self.root = build(lifted(self.vectors, self.most), page)

    def search(self, query: np.ndarray, own: int | None, top: int,
               known: float = -math.inf) -> tuple[list[tuple[int, int]], int]:
        """``search_all`` for one query."""
        return self.search_all(np.asarray(query, np.float64)[None], [own], top, np.array([known]))[0]

    def search_all(self, queries: np.ndarray, own: list[int | None], top: int,
                   known: np.ndarray) -> list[tuple[list[tuple[int, int]], int]]:
        """Per query: ``score, id`` of the best rows but ``own``, best first, and how many rows were
        looked at.

        Ties go to the smaller id. Rows that score less than ``known`` need not be found.
        """
        best: list[list[tuple[int, int]]] = [[] for _ in queries]
        visited = np.zeros(len(queries), np.int64)
        if self.root is None:
            return list(zip(best, visited.tolist()))
        at = np.column_stack([queries, np.zeros(len(queries))])
        total = (at ** 2).sum(axis=1) + self.most
        least = _lowered(np.asarray(known, np.float64))
        far_off = reach(total, least)

        def look(leaf: Node, active: np.ndarray) -> None:
            """Multiply the queries with the leaf's rows."""
            scores = products(queries[active], self.vectors[leaf.rows])
            visited[active] += len(leaf.rows)
            some, rows = np.nonzero(scores >= least[active][:, None])
            for q, score, row in zip(active[some].tolist(), scores[some, rows].tolist(),
                                     leaf.rows[rows].tolist()):
                i, mine = int(self.ids[row]), best[q]
                if i == own[q]:
                    continue
                if len(mine) < top:
                    heapq.heappush(mine, (int(score), -i))
                elif (int(score), -i) > mine[0]:
                    heapq.heapreplace(mine, (int(score), -i))
            for q in set(active[some].tolist()):
                if len(best[q]) == top:
                    least[q] = max(least[q], _lowered(float(best[q][0][0])))
                    far_off[q] = reach(total[q], least[q])

        everyone = np.arange(len(queries))
        to_root = _distances(at, self.root.pivot)
        first = np.zeros(len(queries), np.int64)
        todo = [(self.root, everyone)]
        while todo:  # the leaf with the best bound of each query
            node, active = todo.pop()
            if node.rows is not None:
                first[active] = id(node)
                look(node, active)
                continue
            nearest = (_all_distances(at[active], node.pivots) - node.radii).argmin(axis=1)
            todo += [(node.children[i], active[nearest == i]) for i in np.unique(nearest).tolist()]
        todo = [(self.root, everyone, to_root)]
        while todo:
            node, active, to_pivot = todo.pop()
            open_ = to_pivot - node.radius <= far_off[active]
            if node.rows is not None:
                open_ &= first[active] != id(node)
            active, to_pivot = active[open_], to_pivot[open_]
            if not len(active):
                continue
            if node.rows is not None:
                near = np.abs(to_pivot[:, None] - node.to_pivot).min(axis=1) <= far_off[active]
                if near.any():
                    look(node, active[near])
                continue
            limit = far_off[active][:, None]
            far = _all_distances(at[active], node.pivots)
            near = (np.abs(to_pivot[:, None] - node.to_pivot) - node.radii <= limit) & (
                far - node.radii <= limit)
            # the nearest child comes last on the stack, so it is opened first
            for i in np.argsort(-(far - node.radii).mean(axis=0), kind="stable").tolist():
                if near[:, i].any():
                    todo.append((node.children[i], active[near[:, i]], far[near[:, i], i]))
        return [(sorted(((s, -i) for s, i in mine), key=lambda x: (-x[0], x[1])), seen)
                for mine, seen in zip(best, visited.tolist())]


def lifted(vectors: np.ndarray, most: float) -> np.ndarray:
    """Vectors with the coordinate that puts them on the sphere."""
    return np.column_stack([vectors, np.sqrt(np.maximum(most - (vectors ** 2).sum(axis=1), 0))])


def reach(total, score):
    """No row farther than this from a query has ``score`` or more."""
    slack = 1e-7 * (1 + total)
    return np.sqrt(np.maximum(0.0, total - 2 * score + 2 * slack)) + np.sqrt(slack) * 1e-3


# --- cells ----------------------------------------------------------------------------


def _plain(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    return vectors.select(F.col(id_col).cast("long").alias("id"),
                          quantized(F.col(vector_col)).alias("v")).where("id is not null and v is not null")


def _stack(vectors: list, width: int) -> np.ndarray:
    """Rows of equal length; missing components count as zero."""
    out = np.zeros((len(vectors), width))
    for row, v in zip(out, vectors):
        row[:len(v)] = v
    return out


def _vectors(column: pa.Array, width: int) -> np.ndarray:
    return _stack([v.values.to_numpy() for v in column], width)


@dataclass(frozen=True)
class Space:
    """What all tasks know: width of the vectors, square of the sphere's radius, and the pivots."""

    width: int
    most: float
    pivots: np.ndarray

    def distances(self, points: np.ndarray) -> np.ndarray:
        """From each point to each pivot."""
        return _all_distances(points, self.pivots)


def _space(rows: DataFrame, cell_rows: int) -> Space | None:
    square = F.aggregate("v", F.lit(0.0), lambda done, x: done + x * x)
    told = rows.agg(F.max(F.size("v")).alias("width"), F.max(square).alias("most"),
                    F.count(F.lit(1)).alias("n")).first()
    if not told.n:
        return None
    if not math.isfinite(told.most):
        raise OverflowError("squared lengths of the vectors are beyond a double")
    cells = min(math.ceil(told.n / cell_rows), max(1, PIVOT_BYTES // (8 * (told.width + 1))))
    chosen = rows.select("v", F.xxhash64("id", "v").alias("h")).orderBy("h").limit(cells).collect()
    points = _stack([r.v for r in chosen], told.width)
    return Space(told.width, told.most, np.unique(lifted(points, told.most), axis=0))


def _sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Some rows at once, since each has a distance to every pivot."""
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS_AT_ONCE):
            yield batch.slice(start, ROWS_AT_ONCE)


def _dealt(space):
    """``id, v`` → the nearest cell and the distance to its pivot."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here = space.value
        for batch in _sliced(batches):
            points = lifted(_vectors(batch.column(1), here.width), here.most)
            cell = here.distances(points).argmin(axis=1)
            far = np.sqrt(((points - here.pivots[cell]) ** 2).sum(axis=1))
            yield pa.record_batch(
                [batch.column(0), batch.column(1), pa.array(cell.astype(np.int64)), pa.array(far)],
                ["id", "v", "cell", "far"])

    return task


def _built(space, page: int):
    def build_one(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        here = space.value
        tree = Tree(rows["id"].to_numpy(), _stack(list(rows["v"]), here.width), page, here.most)
        return pd.DataFrame({"cell": [key[0]], "tile": [key[1]], "tree": [pickle.dumps(tree)]})

    return build_one


def _visits(space, radii: dict[int, float], home: bool):
    """``id, v, digest, known`` → a row per cell to visit: the nearest, or later all others in reach."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here = space.value
        cells = np.array(sorted(radii))
        radius = np.array([radii[c] for c in cells.tolist()])
        for batch in _sliced(batches):
            vectors = _vectors(batch.column(1), here.width)
            at = np.column_stack([vectors, np.zeros(len(vectors))])
            bound = np.maximum(here.distances(at)[:, cells] - radius, 0)
            first = bound.argmin(axis=1)
            if home:
                row, place = np.arange(len(at)), first
            else:
                known = batch.column(3).to_numpy(zero_copy_only=False)
                inside = bound <= reach((at ** 2).sum(axis=1) + here.most, known)[:, None]
                inside[np.arange(len(at)), first] = False
                row, place = np.nonzero(inside)
            taken = pa.array(row)
            yield pa.record_batch([*(c.take(taken) for c in batch.columns), pa.array(cells[place])],
                                  ["id", "v", "digest", "known", "cell"])

    return task


_FOUND = "query_id long, digest long, id long, score string, visited long"


def _searched(space, top: int):
    def run(key: tuple, ask: pd.DataFrame, have: pd.DataFrame) -> pd.DataFrame:
        out = []
        for packed in have["tree"]:
            tree = pickle.loads(packed)
            queries = _stack(list(ask["v"]), space.value.width)
            each = tree.search_all(queries, ask["id"].tolist(), top, ask["known"].to_numpy())
            for own, digest, known, (found, visited) in zip(ask["id"], ask["digest"], ask["known"], each):
                # scores are text until the best are known, since only these have to fit a long
                out += [(int(own), int(digest), i, str(max(-BEYOND, min(s, BEYOND))), 0)
                        for s, i in found if s >= _lowered(known)]
                out.append((int(own), int(digest), None, None, visited))
        return pd.DataFrame(out, columns=["query_id", "digest", "id", "score", "visited"]).astype(
            {"id": "Int64"})

    return run


def _best(found: DataFrame, top: int) -> DataFrame:
    """The ``top`` rows of each query with their rank; a query has few rows in each cell."""
    order = Window.partitionBy("query_id", "digest").orderBy(F.desc("number"), "id")
    return found.where("score is not null").withColumn("number", F.col("score").cast("decimal(38,0)")).select(
        "*", F.row_number().over(order).alias("rank")).where(F.col("rank") <= top)


def search(vectors: DataFrame, queries: DataFrame, top: int = TOP, id_col: str = "vec_id",
           vector_col: str = "embedding", block_rows: int = BLOCK_ROWS,
           block_queries: int = BLOCK_QUERIES, cell_rows: int = CELL_ROWS,
           page: int = PAGE) -> DataFrame:
    """``query_id, rank, id, score, visited``: each query's ``top`` rows with another id than its own.

    ``visited`` says how many rows were multiplied with the query. Pivots are rows chosen by a hash; a
    cell of over ``block_rows`` rows, as around a hot vector, is dealt over several trees, and its
    queries over several tasks. Null ids, null vectors and vectors with null or non-finite components
    take no part; of vectors of unequal length the shorter ones count as padded with zeros. Repeated
    rows are candidates each; equal queries are one query. A score among the best that does not fit a
    long raises an error.
    """
    context = vectors.sparkSession.sparkContext
    rows = written(_plain(vectors, id_col, vector_col), "vectors")
    empty = rows.limit(0).selectExpr(
        "id AS query_id", "CAST(0 AS INT) AS rank", "id", "id AS score", "id AS visited")
    asked = written(_plain(queries, id_col, vector_col).distinct().select(
        "id", "v", F.xxhash64("v").alias("digest"), F.lit(-math.inf).alias("known")), "queries")
    whole = _space(rows.unionByName(asked.select("id", "v")), cell_rows)
    if whole is None:
        return empty
    space = context.broadcast(whole)
    dealt = written(rows.mapInArrow(_dealt(space), "id long, v array<double>, cell long, far double"), "cells")
    sizes = dealt.groupBy("cell").agg(F.max("far").alias("far"), F.count(F.lit(1)).alias("n")).collect()
    if not sizes:
        return empty
    radii = {r.cell: r.far * (1 + 1e-9) + 1e-9 for r in sizes}  # as many as pivots
    tiles = F.coalesce(*[F.when(F.col("cell") == r.cell, math.ceil(r.n / block_rows)) for r in sizes
                         if r.n > block_rows], F.lit(1))
    spread = F.pmod(F.xxhash64("id", "v", F.monotonically_increasing_id()), tiles).alias("tile")
    trees = written(
        dealt.select("cell", spread, "id", "v").groupBy("cell", "tile").applyInPandas(
            _built(space, page), "cell long, tile long, tree binary"), "trees")

    def run(ask: DataFrame, home: bool) -> DataFrame:
        pairs = written(ask.select("id", "v", "digest", "known").mapInArrow(
            _visits(space, radii, home), "id long, v array<double>, digest long, known double, cell long"),
            "visits")
        blocks = written(pairs.groupBy("cell").agg(
            F.ceil(F.count(F.lit(1)) / block_queries).alias("blocks")), "blocks")
        placed = pairs.join(blocks, "cell").withColumn(
            "block", F.pmod(F.xxhash64("id", "digest"), "blocks"))
        met = placed.join(trees.select("cell", "tile"), "cell")
        each = trees.join(blocks, "cell").select(
            F.col("cell").alias("c"), F.col("tile").alias("t"),
            F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("b"), "tree")
        return written(
            met.groupBy("cell", "tile", "block").cogroup(each.groupBy("c", "t", "b"))
            .applyInPandas(_searched(space, top), _FOUND), "found")

    near = run(asked, True)
    least = _best(near, top).where(F.col("rank") == top).select(
        F.col("query_id").alias("id"), "digest", F.col("number").cast("double").alias("kth"))
    again = written(asked.drop("known").join(least, ["id", "digest"], "left").withColumn(
        "known", F.coalesce("kth", F.lit(-math.inf))), "queries")
    found = near.unionByName(run(again, False))
    looked = found.groupBy("query_id", "digest").agg(F.sum("visited").alias("visited"))
    best = _best(found.drop("visited"), top).join(looked, ["query_id", "digest"])
    fits = F.abs("number") < F.lit(2 ** 63 - 1).cast("decimal(38,0)")
    told = F.raise_error(F.concat_ws(" ", F.lit("a score does not fit a long:"), "query_id", "id", "score"))
    return best.select("query_id", "rank", "id", F.when(fits, F.col("number").cast("long")).otherwise(
        told.cast("long")).alias("score"), "visited")
