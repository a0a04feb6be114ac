"""Nearest vectors by inner product, from a few random projections and a kd-tree.

Vectors get one more component so that they all have the largest norm, and a query is
stretched to it; the nearest of those by distance has the largest inner product. A stable
projection multiplies by ``DIMS`` Gaussian vectors: the squared projected distance over the
squared distance then follows the chi-square distribution with ``DIMS`` degrees of freedom,
whatever the vectors.

The projections are indexed by a kd-tree. Its upper levels cut the table into cells; they are
fitted on ``SAMPLE`` rows, every row is put into its cell, and a cell of more than ``BLOCK``
rows is cut further by a hash of the row, so equal or crowded vectors make no long task. Each
block builds its lower levels in the task that searches it.

A query takes its own cell's leaves in order of their projected distance and verifies rows by
the inner product. With its ``k`` best so far at distance ``d``, it stops where a row's
projected distance exceeds ``d`` times the square root of the chi-square quantile of
``confidence``: a row that is still nearer than ``d`` lies beyond that with a probability of
``1 - confidence`` at most. Then it visits the other cells whose boxes come within that
distance, in the same way. So each of the true nearest is missed with that probability at
most: there is no cap on candidates. Rows of queries stream past a block's tree, so their
number is not bounded by memory.

Defined cases: a row with a null id takes no part, nor do vectors that are null, empty or
zero, or hold a null or a component that isn't finite; shorter vectors count as filled up
with zeros; rows with one id are rows of their own, and a query skips its own row only. With
fewer rows than ``k`` all are returned, with one row or none nothing. Other columns of the
input are ignored, whatever their names. Ties go to the smaller id.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fieldgauge.llm.frames import stored

DIMS = 8
#: Rows that the upper levels are fitted on, and the most cells they make.
SAMPLE, MOST_CELLS = 65_536, 4096
#: Rows of a block, of a leaf, and queries that are searched together.
BLOCK, LEAF, TOGETHER = 8192, 128, 512
_SEED = 20240229

_PROJECTED = "row long, vec_id long, vector array<double>, point array<double>, ask array<double>"
_FOUND = "row long, vec_id long, score double, found_row long, found_id long"
_NOTHING = float("-inf")


def search(
    vectors: DataFrame, is_query, k: int = 20, confidence: float = 0.97,
    id_column: str = "vec_id", vector_column: str = "embedding", block: int = BLOCK,
) -> DataFrame:
    """query_id, rank, vec_id and score of the ``k`` nearest rows of each query row."""
    spark = vectors.sparkSession
    sound = _sound(vectors, id_column, vector_column, is_query)
    size, norm, rows = _measure(sound)
    if not rows:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    gaussian = np.random.default_rng(_SEED).standard_normal((size + 1, DIMS))
    projected = stored(spark, sound.mapInArrow(_projection(gaussian, size, norm), _PROJECTED), "projections")
    cuts = _fit(projected, rows, block)
    index = stored(
        spark, projected.mapInArrow(_cells(cuts), f"{_PROJECTED}, cell int, ask_cell int"), "cells"
    )
    boxes, parts = _boxes(spark, index, block)
    asked = index.where("ask IS NOT NULL").select(
        "row", "vec_id", "vector", F.col("ask").alias("point"), F.col("ask_cell").alias("cell")
    )
    radius = chi_square_quantile(confidence, DIMS)
    searcher = _searcher(k, radius, norm)
    near_home = asked.withColumn("floor", F.lit(_NOTHING))
    found = stored(spark, _best(_visit(index, near_home, parts, searcher), k), "own-cell")
    if len(boxes) > 1 or asked.join(parts, "cell", "left_anti").limit(1).count():
        elsewhere = _others(asked, found, boxes, k, radius, norm)
        found = found.unionByName(_visit(index, elsewhere, parts, searcher))
    ranked = _best(found, k, rank="rank")
    return ranked.select(
        F.col("vec_id").alias("query_id"), F.col("rank").cast("int").alias("rank"), F.col("found_id").alias("vec_id"), "score"
    )


def chi_square_quantile(p: float, n: int) -> float:
    """Where the chi-square distribution with ``n`` degrees of freedom reaches ``p``."""

    def reached(x):
        x, a = x / 2, n / 2
        term = total = 1 / a
        i = a
        while term > 1e-16 * total:
            i += 1
            term *= x / i
            total += term
        return total * math.exp(a * math.log(x) - x - math.lgamma(a))

    low, high = 1e-9, 1.0
    while reached(high) < p:
        high *= 2
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if reached(middle) < p else (low, middle)
    return high


def _sound(vectors: DataFrame, id_column: str, vector_column: str, is_query) -> DataFrame:
    """Numbered rows that take part; an id that the table repeats is told apart by row."""
    made = vectors.select(
        F.col(f"`{id_column}`").cast("long").alias("vec_id"),
        F.col(f"`{vector_column}`").cast("array<double>").alias("vector"),
        F.coalesce(is_query, F.lit(False)).alias("query"),
    )
    finite = F.expr("forall(vector, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('Infinity'))")
    zero = F.expr("forall(vector, x -> x = 0)")
    return made.where(F.col("vec_id").isNotNull() & F.col("vector").isNotNull() & finite & ~zero).select(
        F.monotonically_increasing_id().alias("row"), "*"
    )


def _measure(sound: DataFrame) -> tuple[int, float, int]:
    squares = F.aggregate("vector", F.lit(0.0), lambda total, x: total + x * x)
    found = sound.agg(F.max(F.size("vector")), F.max(squares), F.count(F.lit(1))).first()
    return found[0] or 0, math.sqrt(found[1] or 0.0), found[2]


def _fit(projected: DataFrame, rows: int, block: int) -> list[tuple[int, np.ndarray]]:
    """The kd-tree's upper levels: for each level, the dimension and the cuts of its nodes.

    Fitted on about ``SAMPLE`` rows, chosen by a hash of the id. Every level cuts at the
    median, so there are as many cells as blocks, up to ``MOST_CELLS``.
    """
    levels = max(0, math.ceil(math.log2(max(1, min(rows / block, MOST_CELLS)))))
    if not levels:
        return []
    share = min(1.0, SAMPLE / rows)
    chosen = projected.where(F.pmod(F.xxhash64("vec_id", "row"), F.lit(1 << 30)) <= int(share * (1 << 30)))
    points = chosen.select("point").limit(2 * SAMPLE).toArrow().column(0)
    sample = _matrix(points.combine_chunks(), DIMS)
    cuts, of = [], np.zeros(len(sample), np.int64)
    for level in range(levels):
        axis = level % DIMS
        at = np.array([
            np.median(sample[of == node, axis]) if (of == node).any() else 0.0 for node in range(1 << level)
        ])
        cuts.append((axis, at))
        of = 2 * of + (sample[:, axis] > at[of])
    return cuts


def _boxes(spark: SparkSession, index: DataFrame, block: int):
    """Each cell's box, and (cell, blocks) with the blocks its rows are cut into.

    There are ``MOST_CELLS`` of both at most, so they may be held and sent to all tasks."""
    bounds = [f(F.col("point")[d]) for f in (F.min, F.max) for d in range(DIMS)]
    found = index.groupBy("cell").agg(F.count(F.lit(1)), *bounds).collect()
    boxes = {r[0]: (np.array(r[2 : 2 + DIMS]), np.array(r[2 + DIMS :])) for r in found}
    parts = spark.createDataFrame([(r[0], -(-r[1] // block)) for r in found], "cell int, blocks int")
    return boxes, F.broadcast(parts)


def _others(asked: DataFrame, own: DataFrame, boxes, k: int, radius: float, norm: float) -> DataFrame:
    """Each query once for each other cell that the stopping test does not rule out."""
    least = own.groupBy("row").agg(F.min("score").alias("least"), F.count(F.lit(1)).alias("size"))
    floor = F.when(F.col("size") == k, F.col("least")).otherwise(_NOTHING)
    known = asked.join(least, "row", "left").select(*asked.columns, floor.alias("floor"))
    numbers = np.array(sorted(boxes), np.int32)
    low = np.array([boxes[c][0] for c in numbers.tolist()])
    high = np.array([boxes[c][1] for c in numbers.tolist()])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors, points = _wide(batch.column(2)), _matrix(batch.column(3), DIMS)
            home, floor = batch.column(4).to_numpy(), batch.column(5).to_numpy()
            reach = radius * _squared_distance(floor, np.linalg.norm(vectors, axis=1), norm)
            rows, cells, size = [], [], 0
            for at in range(batch.num_rows):
                gap = np.maximum(0, np.maximum(low - points[at], points[at] - high))
                wanted = numbers[((gap**2).sum(axis=1) <= reach[at]) & (numbers != home[at])]
                rows.append(np.full(len(wanted), at))
                cells.append(wanted)
                size += len(wanted)
                if size > MOST_CELLS or at == batch.num_rows - 1:
                    sent = batch.take(pa.array(np.concatenate(rows)))
                    yield sent.set_column(4, "cell", pa.array(np.concatenate(cells)))
                    rows, cells, size = [], [], 0

    return known.mapInArrow(
        run, "row long, vec_id long, vector array<double>, point array<double>, cell int, floor double"
    )


def _visit(index: DataFrame, queries: DataFrame, parts: DataFrame, searcher) -> DataFrame:
    """The nearest in each block that a query is sent to. A block's rows reach its task
    before the queries, which then stream past its tree."""
    part = F.expr("int(pmod(xxhash64(row), blocks))")
    held = index.join(parts, "cell").select(
        "cell", part.alias("part"), F.lit(0).alias("kind"), "row", "vec_id", "vector", "point", F.lit(0.0).alias("floor")
    )
    sent = queries.join(parts, "cell").select(
        "cell", F.explode(F.expr("sequence(0, blocks - 1)")).alias("part"), F.lit(1).alias("kind"),
        "row", "vec_id", "vector", "point", "floor",
    )
    together = held.unionByName(sent).repartition("cell", "part").sortWithinPartitions("cell", "part", "kind")
    return together.mapInArrow(searcher, _FOUND)


def _best(found: DataFrame, k: int, rank: str | None = None) -> DataFrame:
    order = Window.partitionBy("row").orderBy(F.desc("score"), F.asc("found_id"), F.asc("found_row"))
    ranked = found.withColumn(rank or "place", F.row_number().over(order)).where(F.col(rank or "place") <= k)
    return ranked if rank else ranked.drop("place")


# -- numbers, an Arrow batch at a time ------------------------------------------


def _matrix(lists: pa.Array, width: int) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), width)


def _wide(lists: pa.Array, width: int = 0) -> np.ndarray:
    """Vectors as rows, filled up with zeros to the longest or to ``width``."""
    sizes = np.diff(lists.offsets.to_numpy())
    width = max(width, int(sizes.max(initial=0)))
    if (sizes == width).all():
        return _matrix(lists, width)
    made = np.zeros((len(lists), width))
    made[np.arange(width) < sizes[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
    return made


def _squared_distance(score, length, norm: float):
    """Between a stretched query and a filled-up vector whose inner product is ``score``."""
    return np.maximum(0.0, 2 * norm * norm - 2 * np.asarray(score) * norm / length)


def _projection(gaussian: np.ndarray, size: int, norm: float):
    """Adds a row's projection, and for a query that of its stretched vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = _wide(batch.column(2), size)
            squares = (vectors**2).sum(axis=1)
            rest = np.sqrt(np.maximum(0.0, norm * norm - squares))
            plain = vectors @ gaussian[:-1]
            points = plain + rest[:, None] * gaussian[-1]
            asks = _lists(plain * (norm / np.sqrt(squares))[:, None], batch.column(3).to_numpy(zero_copy_only=False))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), _lists(vectors), _lists(points), asks],
                ["row", "vec_id", "vector", "point", "ask"],
            )

    return run


def _lists(rows: np.ndarray, present: np.ndarray | None = None) -> pa.Array:
    """Rows as lists; those that are not ``present`` are null."""
    n, width = rows.shape
    if present is not None:
        sizes = np.where(present, width, 0)
        offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32), mask=np.append(~present, False))
        rows = rows[present]
    else:
        offsets = pa.array(np.arange(n + 1, dtype=np.int32) * width)
    return pa.ListArray.from_arrays(offsets, pa.array(np.ascontiguousarray(rows).reshape(-1)))


def _cells(cuts):
    def cell(points: np.ndarray) -> np.ndarray:
        of = np.zeros(len(points), np.int64)
        for axis, at in cuts:
            of = 2 * of + (points[:, axis] > at[of])
        return of.astype(np.int32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            present = batch.column(4).is_valid().to_numpy(zero_copy_only=False)
            asked = np.zeros(batch.num_rows, np.int32)
            asked[present] = cell(_matrix(batch.column(4).filter(pa.array(present)), DIMS))
            yield batch.append_column("cell", pa.array(cell(_matrix(batch.column(3), DIMS)))).append_column(
                "ask_cell", pa.array(asked, mask=~present)
            )

    return run


class _Tree:
    """The lower levels of the kd-tree over a block's projections: leaves and their boxes."""

    def __init__(self, pieces: list[pa.RecordBatch]):
        table = pa.Table.from_batches(pieces).combine_chunks().to_batches()[0]
        points = _matrix(table.column("point"), DIMS)
        leaves = [np.arange(len(points))]
        while len(leaves[0]) > LEAF:
            halves = []
            for rows in leaves:
                axis = np.ptp(points[rows], axis=0).argmax()
                order = rows[np.argpartition(points[rows, axis], len(rows) // 2)]
                halves += [order[: len(rows) // 2], order[len(rows) // 2 :]]
            leaves = sorted(halves, key=len, reverse=True)
        order = np.concatenate(leaves)
        self.ends = np.concatenate([[0], np.cumsum([len(rows) for rows in leaves])])
        self.vectors = _wide(table.column("vector"))[order]
        self.points = points[order]
        self.rows = table.column("row").to_numpy()[order]
        self.ids = table.column("vec_id").to_numpy()[order]
        self.low = np.array([points[rows].min(axis=0) for rows in leaves])
        self.high = np.array([points[rows].max(axis=0) for rows in leaves])
        self.lengths = (self.points**2).sum(axis=1)


def _searcher(k: int, radius: float, norm: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, pieces, tree = None, [], None
        for batch in batches:
            place = np.stack([batch.column(c).to_numpy() for c in range(3)], axis=1)
            edges = np.flatnonzero((place[1:] != place[:-1]).any(axis=1)) + 1
            for at, to in zip([0, *edges.tolist()], [*edges.tolist(), len(place)], strict=True):
                if at == to:
                    continue
                if tuple(place[at, :2]) != key:
                    key, pieces, tree = tuple(place[at, :2]), [], None
                if place[at, 2] == 0:
                    pieces.append(batch.slice(at, to - at))
                elif pieces:
                    tree = tree or _Tree(pieces)
                    for q in range(at, to, TOGETHER):
                        yield _searched(tree, batch.slice(q, min(TOGETHER, to - q)), k, radius, norm)

    return run


def _searched(tree: _Tree, batch: pa.RecordBatch, k: int, radius: float, norm: float) -> pa.RecordBatch:
    """Incremental search for some queries at once, a few more leaves of each in every round."""
    width = tree.vectors.shape[1]
    rows, vectors = batch.column("row").to_numpy(), _wide(batch.column("vector"), width)
    points, floor = _matrix(batch.column("point"), DIMS), batch.column("floor").to_numpy().copy()
    length = np.linalg.norm(vectors, axis=1)
    own = (points**2).sum(axis=1)
    gap = np.maximum(0, np.maximum(tree.low[None] - points[:, None], points[:, None] - tree.high[None]))
    gap = (gap**2).sum(axis=2)
    order = np.argsort(gap, axis=1, kind="stable")
    none = np.zeros(0, np.int64)
    best = (none, none, np.zeros(0))  # query, place and score of the best so far
    slack = 1e-9 * norm * length
    at, step = 0, 1
    active = np.arange(len(rows))
    while at < order.shape[1] and len(active):
        taken = order[active, at : at + step]
        reach = radius * _squared_distance(floor[active], length[active], norm) * (1 + 1e-9)
        within = gap[active[:, None], taken] <= reach[:, None]
        found_q, found_at = [best[0]], [best[1]]
        for leaf in np.unique(taken[within]).tolist():
            asked = active[((taken == leaf) & within).any(axis=1)]
            begin, end = tree.ends[leaf], tree.ends[leaf + 1]
            close = vectors[asked] @ tree.vectors[begin:end].T >= (floor - slack)[asked, None]
            q, p = np.nonzero(close)
            if len(q):
                seen = own[asked[q]] + tree.lengths[begin + p] - 2 * (points[asked[q]] * tree.points[begin + p]).sum(axis=1)
                limit = radius * _squared_distance(floor[asked], length[asked], norm)
                fits = (seen <= limit[q] * (1 + 1e-9) + 1e-9) & (tree.rows[begin + p] != rows[asked[q]])
                found_q.append(asked[q[fits]])
                found_at.append(begin + p[fits])
        best = _nearest(tree, vectors, np.concatenate(found_q), np.concatenate(found_at), k)
        full = np.bincount(best[0], minlength=len(rows)) == k
        last = np.full(len(rows), np.inf)
        np.minimum.at(last, best[0], best[2])
        floor = np.where(full, np.maximum(floor, last), floor)
        at, step = at + step, 2 * step
        if at < order.shape[1]:
            reach = radius * _squared_distance(floor[active], length[active], norm) * (1 + 1e-9)
            active = active[gap[active, order[active, at]] <= reach]
    q, p, score = best
    ids = batch.column("vec_id").to_numpy()
    return pa.RecordBatch.from_arrays(
        [pa.array(x) for x in (rows[q], ids[q], score, tree.rows[p], tree.ids[p])],
        ["row", "vec_id", "score", "found_row", "found_id"],
    )


def _nearest(tree: _Tree, vectors: np.ndarray, q: np.ndarray, p: np.ndarray, k: int):
    """The ``k`` best of each query, by the exact inner product summed in one fixed order."""
    score = np.empty(len(q))
    for at in range(0, len(q), 16384):
        part = slice(at, at + 16384)
        score[part] = (vectors[q[part]] * tree.vectors[p[part]]).sum(axis=1)
    order = np.lexsort((tree.rows[p], tree.ids[p], -score, q))
    q, p, score = q[order], p[order], score[order]
    first = np.searchsorted(q, q)
    kept = np.arange(len(q)) - first < k
    return q[kept], p[kept], score[kept]
