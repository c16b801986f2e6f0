"""Nearest neighbours by adaptive dimension scan over probed lists.

Vectors are turned into points whose Euclidean order is that of the inner
product (one more component makes all norms equal), rotated at random, and put
into the list of their nearest centroid. A query scans its nearest lists. In a
list the components are read in column blocks; after each block the partial
distance, scaled to all dimensions, is tested against the query's current k-th
best distance, and candidates that are worse with high confidence are abandoned
before their other components are read.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import cut
from tidemark.llm.vectors import matrix, sample, usable

#: Rows that the index is fitted on, at most about; every row is indexed.
FIT_ROWS = 16_384
#: Dimensions of a column block, and the test's width (larger: fewer abandoned wrongly).
BLOCK, WIDTH = 16, 2.1
#: Share of the sample's true neighbours that the probed lists must hold.
COVER = 0.97
#: Rows and queries of one scan task.
TILE_ROWS, TILE_QUERIES = 8192, 4096


@dataclass
class Index:
    """The lists of the vectors of one length. Vectors are scaled by a power of
    two so that no component exceeds 1: squares neither overflow nor vanish."""

    rotation: np.ndarray
    exponent: int
    top: float  # the largest squared norm after scaling
    centroids: np.ndarray
    probes: int = 1
    offset: int = 0  # number of its first list

    def points(self, x: np.ndarray, query: bool = False) -> np.ndarray:
        x = np.ldexp(x, -self.exponent)
        extra = np.zeros(len(x)) if query else np.sqrt(np.maximum(0.0, self.top - (x * x).sum(1)))
        return np.column_stack([x, extra]) @ self.rotation

    def ranked(self, points: np.ndarray, n: int) -> np.ndarray:
        """The n nearest lists of each point, nearest first."""
        d = (self.centroids**2).sum(1)[None, :] - 2 * points @ self.centroids.T
        return np.argsort(d, axis=1, kind="stable")[:, :n]

    def probed(self, points: np.ndarray, sizes: np.ndarray, k: int) -> list[np.ndarray]:
        """The lists each query reads: ``probes`` of them, and more until they
        hold ``k`` rows besides the query itself, or all there are."""
        order = self.ranked(points, len(self.centroids))
        held = np.cumsum(sizes[order], axis=1)
        need = np.minimum(len(self.centroids), np.maximum(self.probes, (held < k + 1).sum(1) + 1))
        return [o[:n] + self.offset for o, n in zip(order, need, strict=True)]


def fit(x: np.ndarray, dim: int, peak: float, top: float, rows: int, k: int, seed: int = 11) -> Index:
    """Index of ``rows`` vectors of length ``dim``, with largest component
    ``peak`` and largest squared norm ``top`` in units of it, from a sample
    ``x``: centroids by k-means, a list for about 200 rows, and as many probes
    as the sample's own neighbours need. Without a sample there is one list."""
    rng = np.random.default_rng(seed)
    rotation = np.linalg.qr(rng.normal(size=(dim + 1, dim + 1)))[0]
    mantissa, exponent = math.frexp(peak)
    index = Index(rotation, exponent, top * mantissa**2, np.zeros((1, dim + 1)))
    lists = int(max(1, min(rows / 200, len(x) / 64)))
    if lists == 1:
        return index
    points = index.points(x)
    index.centroids = points[rng.choice(len(points), lists, replace=False)]
    for _ in range(8):
        own = index.ranked(points, 1)[:, 0]
        held = np.bincount(own, minlength=lists)
        sums = np.zeros_like(index.centroids)
        np.add.at(sums, own, points)
        index.centroids[held > 0] = sums[held > 0] / held[held > 0, None]
    own = index.ranked(points, 1)[:, 0]
    ask = rng.choice(len(x), min(512, len(x)), replace=False)
    asking = index.points(x[ask], query=True)
    near = -(asking @ points.T)
    near[np.arange(len(ask)), ask] = np.inf
    near = np.argsort(near, axis=1, kind="stable")[:, : max(1, min(k, len(x) - 1))]
    place = np.argsort(index.ranked(asking, lists), axis=1)  # list -> how early it is probed
    needed = np.sort(np.take_along_axis(place, own[near], 1).ravel())
    index.probes = min(lists, int(needed[min(len(needed) - 1, int(np.ceil(COVER * len(needed))))]) + 1)
    return index


def scan(candidates: np.ndarray, queries: np.ndarray, own: np.ndarray, k: int, chunk: int = 1024):
    """(query, candidate) pairs holding each query's k nearest candidates, and
    any that tie with the k-th. ``own`` (query x candidate) marks pairs to leave
    out: a query's own row, and the rows of lists that it does not read."""
    n, dim = candidates.shape
    marks = [*range(0, dim, BLOCK), dim]
    limit = np.full(len(queries), np.inf)  # squared distance of the k-th best so far
    best_q, best_c, best_d = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    squares = [((queries[:, a:b] ** 2).sum(1), (candidates[:, a:b] ** 2).sum(1)) for a, b in zip(marks, marks[1:], strict=False)]
    for at in range(0, n, chunk):
        part = candidates[at : at + chunk]
        asked = np.flatnonzero(~own[:, at : at + chunk].all(1))  # the others read nothing here
        alive = ~own[asked, at : at + chunk]
        far, q, mine, best = np.zeros(alive.shape), None, queries[asked], limit[asked]
        for (a, b), (xx, yy) in zip(zip(marks, marks[1:], strict=False), squares, strict=True):
            bound = best
            if b < dim:  # a partial distance: reject if it is too large by the test
                bound = bound * (b / dim) * (1 + WIDTH / np.sqrt(b)) ** 2
            if q is not None:  # few are alive: pair by pair
                d = d + ((mine[q, a:b] - part[c, a:b]) ** 2).sum(1)
                stay = d <= bound[q] + 1e-9
                q, c, d = q[stay], c[stay], d[stay]
                continue
            far += xx[asked, None] + yy[None, at : at + chunk] - 2 * mine[:, a:b] @ part[:, a:b].T
            alive &= far <= bound[:, None] + 1e-9
            if b == dim and k <= alive.shape[1]:  # the k best of this chunk, and ties
                own_best = np.partition(np.where(alive, far, np.inf), k - 1, axis=1)[:, k - 1]
                alive &= far <= own_best[:, None] + 1e-9
            if b == dim or np.count_nonzero(alive) * 10 < alive.size:
                q, c = np.nonzero(alive)
                d = far[q, c]
        best_q, best_c, best_d = np.concatenate([best_q, asked[q]]), np.concatenate([best_c, c + at]), np.concatenate([best_d, d])
        order = np.lexsort((best_d, best_q))
        best_q, best_c, best_d = best_q[order], best_c[order], best_d[order]
        first = np.searchsorted(best_q, np.arange(len(queries)))
        count = np.bincount(best_q, minlength=len(queries))
        full = count >= k
        limit[full] = best_d[first[full] + k - 1]
        stay = best_d <= limit[best_q] + 1e-9
        best_q, best_c, best_d = best_q[stay], best_c[stay], best_d[stay]
    return best_q, best_c


def search(df: DataFrame, queries: DataFrame, k: int = 20, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k rows of ``df`` with the largest
    inner product to each row of ``queries`` (same columns), its own key left
    out; all, if there are fewer. Ties go to the smaller key; score is the inner
    product of the original vectors in double precision.

    Vectors that are null, empty, zero or hold null or non-finite components and
    rows without a key take no part; a query's candidates are the vectors of its
    length. A score beyond the range of a double is infinite, or NaN and last.
    Of rows with one key the least vector counts. Other columns are not read. An
    empty table gives no rows. Lists and query sets are cut into tiles of at
    most about TILE_ROWS x TILE_QUERIES, so a list of near-equal vectors is no
    single task. The number of probed lists follows from the sample, so data
    without clusters is scanned for the most part; a query reads further lists
    while those it has read hold fewer than k rows.
    """
    spark = df.sparkSession
    schema = "query_id long, rank int, vec_id long, score double"

    def clean(x: DataFrame) -> DataFrame:
        x = x.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"))
        return x.where("id IS NOT NULL").where(usable("v")).groupBy("id").agg(F.min("v").alias("v"))

    rows, asked = cut(clean(df), "ann-rows"), clean(queries)
    # one row a vector length: rows, largest component, largest squared norm in its units
    peaks = {r["dim"]: r for r in rows.groupBy(F.size("v").alias("dim")).agg(F.count("*").alias("n"), F.max(F.array_max(F.transform("v", F.abs))).alias("peak")).collect()}
    if not peaks:
        return spark.createDataFrame([], schema)
    peak = F.element_at(F.create_map(*[F.lit(x) for d, r in peaks.items() for x in (d, r["peak"])]), F.size("v"))
    tops = dict(rows.withColumn("p", peak).groupBy(F.size("v")).agg(F.max(F.expr("aggregate(v, 0D, (a, x) -> a + (x / p) * (x / p))"))).collect())
    indexes: dict[int, Index] = {}
    offset = 0
    for dim, r in sorted(peaks.items()):
        own = sample(rows.where(F.size("v") == dim), "id", FIT_ROWS).orderBy("id").toPandas() if r["n"] > TILE_ROWS // 8 else pd.DataFrame({"v": []})
        indexes[dim] = fit(matrix(own["v"]), dim, r["peak"], tops[dim], r["n"], k)
        indexes[dim].offset, offset = offset, offset + len(indexes[dim].centroids)

    def by_length(x: pd.DataFrame):
        for dim, own in x.groupby(x["v"].map(len)):
            if dim in indexes:
                yield indexes[dim], own, matrix(own["v"])

    def into_lists(frames):
        for x in frames:
            for index, own, m in by_length(x):
                yield own.assign(list=(index.ranked(index.points(m), 1)[:, 0] + index.offset).astype(np.int32))

    stored = cut(rows.mapInPandas(into_lists, "id long, v array<double>, list int"), "ann-lists")
    sizes = np.zeros(offset, np.int64)
    for r in stored.groupBy("list").count().collect():  # one number a list
        sizes[r["list"]] = r["count"]

    # neighbouring lists share a cell of at most about TILE_ROWS rows, so that a query is sent, and answers, once a cell
    cell_of = np.zeros(offset, np.int64)
    last, held = -1, TILE_ROWS
    for index in indexes.values():
        main = np.linalg.svd(index.centroids - index.centroids.mean(0), full_matrices=False)[2][0]
        last, held = last + 1, 0
        for i in np.argsort(index.centroids @ main, kind="stable") + index.offset:
            if held and held + sizes[i] > TILE_ROWS:
                last, held = last + 1, 0
            cell_of[i], held = last, held + sizes[i]
    cells_n = last + 1
    cell_rows = np.bincount(cell_of, weights=sizes, minlength=cells_n)

    def to_cells(frames):
        for x in frames:
            for index, own, m in by_length(x):
                near = index.probed(index.points(m, True), sizes[index.offset : index.offset + len(index.centroids)], k)
                row = np.repeat(np.arange(len(own)), list(map(len, near)))
                near = np.concatenate(near)
                near, row = near[sizes[near] > 0], row[sizes[near] > 0]
                order = np.lexsort((near, cell_of[near], row))
                near, row, cell = near[order], row[order], cell_of[near[order]]
                first = np.flatnonzero(np.concatenate([[True], (np.diff(row) != 0) | (np.diff(cell) != 0)])) if len(row) else np.zeros(0, np.int64)
                lists = np.split(near.astype(np.int32), first[1:]) if len(first) else []
                yield own.iloc[row[first]].assign(cell=cell[first].astype(np.int32), lists=lists)

    asking = cut(asked.mapInPandas(to_cells, "id long, v array<double>, cell int, lists array<int>"), "ann-asking")
    # a cell's rows are cut into tiles, and a tile's queries into parts
    row_parts = F.array(*[F.lit(int(max(1, -(-n // TILE_ROWS)))) for n in cell_rows])
    parts = np.ones(cells_n, np.int64)
    for r in asking.groupBy("cell").agg(F.ceil(F.count("*") / TILE_QUERIES).cast("int").alias("n")).collect():  # one number a cell
        parts[r["cell"]] = r["n"]
    query_parts = F.array(*[F.lit(int(n)) for n in parts])
    cell = F.get(F.array(*[F.lit(int(c)) for c in cell_of]), F.col("list"))
    stored = stored.withColumn("cell", cell).withColumns({"rp": F.pmod(F.xxhash64("id"), F.get(row_parts, F.col("cell"))).cast("int"),
                                                           "qp": F.explode(F.sequence(F.lit(0), F.get(query_parts, F.col("cell")) - 1))})
    asking = asking.withColumns({"qp": F.pmod(F.xxhash64("id"), F.get(query_parts, F.col("cell"))).cast("int"),
                                 "rp": F.explode(F.sequence(F.lit(0), F.get(row_parts, F.col("cell")) - 1))})

    def tile(have: pd.DataFrame, ask: pd.DataFrame) -> pd.DataFrame:
        none = pd.DataFrame({"query_id": np.zeros(0, np.int64), "vec_id": np.zeros(0, np.int64), "score": np.zeros(0)})
        if not len(have) or not len(ask):
            return none
        have, ask = have.sort_values(["list", "id"]), ask.sort_values("id")
        x, y = matrix(have["v"]), matrix(ask["v"])
        index = indexes[x.shape[1]]
        points, asked_points = index.points(x), index.points(y, True)
        ids, asks = have["id"].to_numpy(), ask["id"].to_numpy()
        names, of = np.unique(have["list"].to_numpy(), return_inverse=True)
        read = np.zeros((len(ask), len(names)), bool)
        for r, lists in enumerate(ask["lists"]):
            read[r] = np.isin(names, lists)
        out = []
        for at in range(0, len(y), 256):  # bounds the query x candidate matrices
            own = (asks[at : at + 256, None] == ids[None, :]) | ~read[at : at + 256][:, of]
            q, c = scan(points, asked_points[at : at + 256], own, k)
            with np.errstate(over="ignore", invalid="ignore"):
                score = (y[at + q] * x[c]).sum(1)
            order = np.lexsort((ids[c], -score, q))
            q, c, score = q[order], c[order], score[order]
            rank = np.arange(len(q)) - np.searchsorted(q, q)
            best = rank < k
            out.append(pd.DataFrame({"query_id": asks[at + q[best]], "vec_id": ids[c[best]], "score": score[best]}))
        return pd.concat(out)

    cells = ["cell", "rp", "qp"]
    found = stored.groupBy(*cells).cogroup(asking.groupBy(*cells)).applyInPandas(tile, "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")  # limited to k before the shuffle, too
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
