"""Nearest neighbours by stable projections and kd-trees.

Vectors are projected on ``DIMENSIONS`` random normal directions. The squared
projected distance of two vectors, over their squared distance, follows the
chi-square law, so a vector that is nearer than the ``k`` best found so far is
projected within ``quantile * (k-th distance) ** 2`` with probability ``SURE``.

A kd-tree over projections, fitted on at most ``sample`` vectors, cuts space into
cells; every vector is indexed in its cell, in blocks of about ``block_rows``
vectors with a kd-tree of their own. Each query first searches its own cell. The
``k``-th distance found there bounds the cells that it goes on to. Within a block
the buckets of the kd-tree are taken in the order of projected distance, and their
vectors verified on the originals, until the chi-square test says that a nearer
one is unlikely to be left.

Equal vectors are indexed once, with their ``k + 1`` smallest ids (all that any
query can return), so a vector that is very common is no hot block.

Defined results: NULL and zero vectors and those with NULL or non-finite
components take no part, nor do NULL ids or vectors whose length is not the most
common one (the smaller of two). An id on several rows counts once, with its
smallest vector. Fewer than ``k`` other vectors give fewer rows; an empty table
gives none. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from socialog.llm.base import tidy
from socialog.session import written

DIMENSIONS = 8
QUANTILE = 20.090  # of the chi-square law with 8 degrees of freedom at SURE
SURE = 0.99
BUCKET = 64  # vectors in a bucket of a block's kd-tree
SEED = 20_240
FOUND = "query_id long, vec_id long, score double"


def directions(length: int) -> np.ndarray:
    return np.random.default_rng(SEED).standard_normal((length, DIMENSIONS))


def stacked(vectors: pd.Series) -> np.ndarray:
    return np.array([np.asarray(v, dtype=np.float64) for v in vectors])


def split_points(points: np.ndarray, most: int) -> list[np.ndarray]:
    """Places of the points of each bucket: halved at the median of the widest axis."""
    todo, done = [np.arange(len(points))], []
    while todo:
        own = todo.pop()
        if len(own) <= most:
            done.append(own)
            continue
        axis = int(np.argmax(np.ptp(points[own], axis=0)))
        half = np.argsort(points[own, axis], kind="stable")
        todo += [own[half[: len(own) // 2]], own[half[len(own) // 2 :]]]
    return done


class Cells:
    """A kd-tree as plain lists: the cells of projected space, numbered."""

    def __init__(self, points: np.ndarray, cells: int):
        self.axis: list[int] = []
        self.value: list[float] = []
        self.next: list[list[int]] = []  # the two sides; a cell is ~number
        self.low: list[np.ndarray] = []
        self.high: list[np.ndarray] = []
        whole = np.full(DIMENSIONS, np.inf)
        todo = [(np.arange(len(points)), cells, -whole, whole, None)]
        while todo:
            own, wanted, low, high, parent = todo.pop()
            axis = int(np.argmax(np.ptp(points[own], axis=0))) if len(own) > 1 and wanted > 1 else 0
            value = float(np.median(points[own, axis])) if len(own) else 0.0
            left = own[points[own, axis] < value]
            if wanted < 2 or not len(left) or len(left) == len(own):
                number = ~len(self.low)
                self.low.append(low)
                self.high.append(high)
            else:
                number = len(self.axis)
                self.axis.append(axis)
                self.value.append(value)
                self.next.append([0, 0])
                for side, part in ((0, left), (1, own[points[own, axis] >= value])):
                    a, b = low.copy(), high.copy()
                    (b if side == 0 else a)[axis] = value
                    todo.append((part, wanted // 2 + side * (wanted % 2), a, b, (number, side)))
            if parent is not None:
                self.next[parent[0]][parent[1]] = number
            elif number < 0:
                self.next.append([number, number])
        self.boxes = np.stack(self.low), np.stack(self.high)

    def of(self, points: np.ndarray) -> np.ndarray:
        """Cell of each point."""
        if not self.axis:
            return np.zeros(len(points), np.int32)
        axis, value, after = np.array(self.axis), np.array(self.value), np.array(self.next)
        at = np.zeros(len(points), np.int64)
        while (inner := np.flatnonzero(at >= 0)).size:
            here = at[inner]
            at[inner] = after[here, (points[inner, axis[here]] >= value[here]).astype(int)]
        return (~at).astype(np.int32)

    def within(self, point: np.ndarray, squared: float) -> np.ndarray:
        """Cells at most that far from a point."""
        return np.flatnonzero(apart(point, *self.boxes) <= squared)


def apart(point: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Squared distance of a point from each box."""
    return (np.maximum(np.maximum(low - point, point - high), 0.0) ** 2).sum(axis=1)


class Block:
    """Vectors of a block under their own kd-tree."""

    def __init__(self, vectors: np.ndarray, ids: list, axes: np.ndarray):
        self.vectors, self.ids = vectors, ids
        self.points = vectors @ axes
        self.buckets = split_points(self.points, BUCKET)
        self.low = np.stack([self.points[b].min(axis=0) for b in self.buckets])
        self.high = np.stack([self.points[b].max(axis=0) for b in self.buckets])

    def search(
        self, query: int, vector: np.ndarray, point: np.ndarray, bound: float, k: int
    ) -> list[tuple[float, int]]:
        """The ``k`` nearest other ids that are no farther than ``bound``."""
        far = apart(point, self.low, self.high)
        best: list[tuple[float, int]] = []
        for at in np.argsort(far, kind="stable"):
            if far[at] > QUANTILE * bound * bound:
                break  # the chi-square test: what is left is unlikely to be nearer
            own = self.buckets[at]
            near = ((self.points[own] - point) ** 2).sum(axis=1) <= QUANTILE * bound * bound
            own = own[near]
            distances = np.sqrt(((self.vectors[own] - vector) ** 2).sum(axis=1))
            for j in np.flatnonzero(distances <= bound):
                best += [(float(distances[j]), int(i)) for i in self.ids[own[j]] if i != query]
            best = sorted(best)[:k]
            if len(best) == k:
                bound = min(bound, best[-1][0])
        return best


def usable(vector: Column) -> Column:
    """Not NULL or zero, all components finite."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & fine & F.exists(vector, lambda x: x != 0)


def _udf(make, returned, inputs: int = 1):
    """A pandas UDF over one or two columns, prepared once a task."""

    def one(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        f = make()
        for batch in batches:
            yield pd.Series(f(batch))

    def two(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        f = make()
        for batch in batches:
            yield pd.Series(f(*batch))

    run, kind = (one, pd.Series) if inputs == 1 else (two, tuple[pd.Series, pd.Series])
    run.__annotations__ = {"batches": Iterator[kind], "return": Iterator[pd.Series]}
    return F.pandas_udf(tidy(run), returned)


def search(
    vectors: DataFrame,
    queries: Column,
    k: int = 10,
    sample: int = 20_000,
    block_rows: int = 4096,
    query_rows: int = 20_000,
) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest to each row of ``vectors`` (vec_id,
    embedding) for which ``queries`` (of vec_id) holds."""
    spark = vectors.sparkSession
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").filter(
        F.col("vec_id").isNotNull() & usable(F.col("embedding"))
    )
    sizes = rows.groupBy(F.size("embedding").alias("n")).count()
    common = sizes.orderBy(F.desc("count"), "n").limit(1).collect()
    if not common:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    length = common[0]["n"]
    rows = written(
        rows.filter(F.size("embedding") == length).groupBy("vec_id").agg(F.min("embedding").alias("embedding")),
        "vectors",
    )
    same = Window.partitionBy("embedding").orderBy("vec_id")
    points = (
        rows.withColumn("_at", F.row_number().over(same))
        .filter(F.col("_at") <= k + 1)
        .groupBy("embedding")
        .agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    )
    axes = directions(length)

    chosen = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).select("embedding").toPandas()
    cells = max(1, min(-(-rows.count() // block_rows), sample // 8))
    tree = Cells(stacked(chosen["embedding"]) @ axes, cells)
    shared = spark.sparkContext.broadcast(vars(tree))

    def opened():
        found = Cells.__new__(Cells)
        found.__dict__ = shared.value
        return found

    def homes():
        found = opened()
        return lambda own: found.of(stacked(own) @ axes)

    def reached():
        found = opened()

        def cells_of(own: pd.Series, bounds: pd.Series) -> list[np.ndarray]:
            at = stacked(own) @ axes
            squared = QUANTILE * bounds.to_numpy(float) ** 2
            return [found.within(p, s).astype(np.int32) for p, s in zip(at, squared, strict=True)]

        return cells_of

    home = _udf(homes, T.IntegerType())
    reach = _udf(reached, T.ArrayType(T.IntegerType()), 2)

    indexed = written(points.withColumn("cell", home("embedding")), "indexed")
    # One row for each cell: at most sample / 8, whatever the table.
    filled = {r["cell"]: -(-r["count"] // block_rows) for r in indexed.groupBy("cell").count().collect()}

    def searched(asked: DataFrame) -> DataFrame:
        """``asked``: query_id, embedding, bound, cell."""
        visits = {r["cell"]: -(-r["count"] // query_rows) for r in asked.groupBy("cell").count().collect()}
        cuts = spark.createDataFrame(
            [(c, filled[c], n) for c, n in visits.items() if c in filled],
            "cell int, _blocks long, _groups long",
        )
        there = (
            indexed.join(F.broadcast(cuts), "cell")
            .withColumn("block", F.pmod(F.xxhash64("embedding"), "_blocks"))
            .withColumn("group", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_groups") - 1)))
            .select("cell", "block", "group", "embedding", "ids")
        )
        here = (
            asked.join(F.broadcast(cuts), "cell")
            .withColumn("group", F.pmod(F.xxhash64("query_id"), "_groups"))
            .withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_blocks") - 1)))
            .select("cell", "block", "group", "query_id", "embedding", "bound")
        )
        key = ["cell", "block", "group"]

        def one_block(own: pd.DataFrame, wanted: pd.DataFrame) -> pd.DataFrame:
            out = []
            if len(own) and len(wanted):
                block = Block(stacked(own["embedding"]), own["ids"].tolist(), axes)
                asking = stacked(wanted["embedding"])
                for query, vector, point, bound in zip(
                    wanted["query_id"], asking, asking @ axes, wanted["bound"], strict=True
                ):
                    out += [(query, i, d) for d, i in block.search(query, vector, point, bound, k)]
            return pd.DataFrame(out, columns=["query_id", "vec_id", "score"])

        return (
            there.groupBy(*key).cogroup(here.groupBy(*key)).applyInPandas(one_block, FOUND)
        )

    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    asked = rows.filter(queries).select(F.col("vec_id").alias("query_id"), "embedding")
    first = written(
        searched(asked.withColumn("bound", F.lit(float("inf"))).withColumn("cell", home("embedding"))),
        "nearest",
    )
    ranked = first.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") == k)
    bounded = asked.join(ranked.select("query_id", F.col("score").alias("bound")), "query_id", "left")
    onward = written(
        bounded.fillna(float("inf"), "bound")
        .withColumn("home", home("embedding"))
        .withColumn("cell", F.explode(reach("embedding", "bound")))
        .filter("cell <> home")
        .select("query_id", "embedding", "bound", "cell"),
        "visits",
    )
    return (
        first.unionByName(searched(onward))
        .withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )
