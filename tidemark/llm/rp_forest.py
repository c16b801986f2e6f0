"""Near-equal vectors by a forest of random-projection trees.

Every tree splits the vectors again and again at the median of a random
projection; vectors near a split go to both sides (spill), so a near pair is
seldom parted in one tree and hardly ever in all. Vectors are compared inside
the leaves, the links are verified by exact cosine, and linked vectors united.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import components, cut
from tidemark.llm.vectors import matrix, sample, unit, usable

#: Vectors that the splits are fitted on, at most about; all are routed.
FIT_ROWS = 16_384
TREES, LEAF_ROWS, MAX_DEPTH = 6, 2048, 24
#: Rows of one comparison block, and its components; larger leaves are compared block by block.
BLOCK_ROWS, BLOCK_CELLS = 8192, 1 << 20
#: Pairs whose products are held at once.
STRIP_CELLS = 1 << 19
#: Leaves that are looked up at once, rows whose leaves are.
LEAF_COLUMNS, ROUTE_ROWS = 256, 1024


class Forest:
    """Per tree and level one random direction; per node a threshold."""

    def __init__(self, x: np.ndarray, depth: int, cosine: float, seed: int = 3):
        rng = np.random.default_rng(seed)
        dim = x.shape[1]
        g = rng.normal(size=(TREES, max(1, depth), dim))
        self.directions = g / np.linalg.norm(g, axis=2, keepdims=True)
        # a pair at the least cosine is apart by sqrt(2 - 2c); along a direction by 1/sqrt(dim) of it
        self.margin = np.sqrt(max(0.0, 2 - 2 * cosine) / dim)
        self.splits: list[list[tuple[np.ndarray, np.ndarray, float]]] = []
        for t in range(TREES):
            node, levels = np.zeros(len(x), np.int64), []
            for level in range(depth):
                p = self._along(x, t, level)
                order = np.argsort(node, kind="stable")
                names, starts = np.unique(node[order], return_index=True)
                own = [(n, np.median(part)) for n, part in zip(names, np.split(p[order], starts[1:]), strict=True) if len(part) >= 32]
                rest = float(np.median(p)) if len(p) else 0.0
                levels.append((np.array([n for n, _ in own], np.int64), np.array([m for _, m in own], float), rest))
                node = 2 * node + (p > self._threshold(levels[-1], node))
            self.splits.append(levels)

    def _along(self, x: np.ndarray, tree: int, level: int) -> np.ndarray:
        """A row's result does not depend on the rows beside it, as a product of
        matrices does in the last bit: a row gets the same leaves in every call."""
        return (x * self.directions[tree, level]).sum(1)

    @staticmethod
    def _threshold(level: tuple[np.ndarray, np.ndarray, float], node: np.ndarray) -> np.ndarray:
        names, medians, rest = level
        if not len(names):
            return np.full(len(node), rest)
        at = np.minimum(np.searchsorted(names, node), len(names) - 1)
        return np.where(names[at] == node, medians[at], rest)

    def leaves(self, x: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows and their leaves ``depth`` levels down over all trees, by row and
        leaf ascending; a leaf's number begins with its tree's."""
        rows, names = [], []
        for t in range(TREES if depth else 1):  # without splits one tree holds all
            row, node = np.arange(len(x)), np.zeros(len(x), np.int64)
            for level in range(depth):
                off = self._along(x, t, level)[row] - self._threshold(self.splits[t][level], node)
                low, high = off <= self.margin, off > -self.margin
                row = np.concatenate([row[low], row[high]])
                node = np.concatenate([2 * node[low], 2 * node[high] + 1])
            rows.append(row)
            names.append(node + (t << (MAX_DEPTH + 2)))
        row, name = np.concatenate(rows), np.concatenate(names)
        order = np.lexsort((name, row))
        return row[order], name[order]


def _unite(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least row linked to each row, by repeated minima."""
    low = np.arange(n)
    while True:
        new = low.copy()
        np.minimum.at(new, a, low[b])
        np.minimum.at(new, b, low[a])
        new = new[new]
        if (new == low).all():
            return low
        low = new


def _near_strips(m: np.ndarray, left: np.ndarray, right: np.ndarray, cosine: float):
    """(rows, rows, links between them as a matrix), a strip of ``left`` against
    ``right`` at a time; a pair of rows comes once. Products in single precision
    decide all but the pairs within their rounding error of the least cosine,
    those are taken again in double precision."""
    small, own = m.astype(np.float32), left is right
    slack = np.float32((m.shape[1] + 16) * 2.0**-23)
    height = max(1, STRIP_CELLS // max(1, len(right)))
    for at in range(0, len(left), height):
        a, b = left[at : at + height], right[at:] if own else right
        g = small[a] @ small[b].T
        near = g >= np.float32(cosine) - slack
        if own:
            near[:, : len(a)] = np.triu(near[:, : len(a)], 1)
        if not near.any():
            continue
        x, y = np.nonzero(near & (g < np.float32(cosine) + slack))
        for k in range(0, len(x), 4096):
            i, j = x[k : k + 4096], y[k : k + 4096]
            near[i, j] = (m[a[i]] * m[b[j]]).sum(1) >= cosine
        up, across = near.any(1), near.any(0)
        if up.any():
            yield a[up], b[across], near[np.ix_(up, across)]


def _meet(a: np.ndarray, b: np.ndarray, starts: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Which rows of ``a`` and ``b`` share a code, a number from 0 on; row r has
    codes[starts[r] : starts[r + 1]]."""

    def held(rows):
        n = starts[rows + 1] - starts[rows]
        at = np.arange(n.sum()) + np.repeat(starts[rows] - (np.cumsum(n) - n), n)
        return np.repeat(np.arange(len(rows)), n), codes[at]

    (ra, ca), (rb, cb) = held(a), held(b)
    names, place = np.unique(ca), np.full(codes.max(initial=-1) + 1, -1)
    place[names] = np.arange(len(names))
    ca, cb = place[ca], place[cb]  # -1: in no row of a
    met = np.zeros((len(a), len(b)), bool)
    for k in range(0, len(names), LEAF_COLUMNS):
        sides = []
        for row, col, n in ((ra, ca - k, len(a)), (rb, cb - k, len(b))):
            has = (col >= 0) & (col < LEAF_COLUMNS)
            sides.append(np.zeros((n, LEAF_COLUMNS), np.float32))
            sides[-1][row[has], col[has]] = 1
        met |= sides[0] @ sides[1].T > 0.5
    return met


def leaf_links(m: np.ndarray, copies: np.ndarray, left: np.ndarray, right: np.ndarray, cosine: float, leaf: int, forest: Forest | None, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(links, least linked row) of each row of ``m`` in ``leaf``, between the rows
    ``left`` and ``right`` (the same array: among them). Pairs that meet in a
    lesser leaf are left to it. Holds a bit a pair at most, and the leaves of
    rows that have links."""
    n, low = np.zeros(len(m)), np.arange(len(m))
    found, hit = [], np.zeros(len(m), bool)
    for a, b, near in _near_strips(m, left, right, cosine):
        found.append((a, b, np.packbits(near, axis=1)))
        hit[a] = hit[b] = True
    starts, codes = np.zeros(len(m) + 1, np.int64), np.zeros(0, np.int64)
    if found and depth and leaf:
        rows, some = np.flatnonzero(hit), []
        for k in range(0, len(rows), ROUTE_ROWS):
            row, name = forest.leaves(m[rows[k : k + ROUTE_ROWS]], depth)
            some.append((rows[k + row[name < leaf]], name[name < leaf]))
        starts[1:] = np.cumsum(np.bincount(np.concatenate([r for r, _ in some]), minlength=len(m)))
        codes = np.unique(np.concatenate([c for _, c in some]), return_inverse=True)[1]
    for a, b, bits in found:
        near = np.unpackbits(bits, axis=1, count=len(b)).astype(bool)
        if len(codes):
            near &= ~_meet(a, b, starts, codes)
        one = near.astype(np.float64)
        n[a] += one @ copies[b]
        n[b] += copies[a] @ one
        x, y = np.nonzero(near & (low[a][:, None] != low[b][None, :]))
        if len(x):
            low = _unite(len(m), low[a[x]], low[b[y]])[low]
    return n.astype(np.int64), low


def _vectors(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Lists of one length as a matrix."""
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(flat), -1)


def links(df: DataFrame, cosine: float = 0.98, key: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """(key, n_links, component_id, kept), one row a row of ``df``.

    Two rows are linked when their labels are equal and not null and the cosine
    of their vectors, in double precision, is at least ``cosine``; n_links
    counts the other rows linked directly, component_id is the least key
    reachable by links (itself included), kept says whether that is the row's
    own. Vectors that are null, empty, zero or hold null or non-finite
    components, and rows without a label or a key link with nothing (their
    component is their own key, null for a null key); vectors of different
    lengths are not compared, each length has its own trees. Equal vectors of a label are one class, so thousands of copies
    are one row in the trees; equal keys on different vectors count as linked
    classes of one component. A pair that meets in several leaves counts in the
    first of them only. Other columns are not read; an empty table gives no rows.
    """
    spark = df.sparkSession
    kind = "array<float>" if df.select(vector).dtypes[0][1] == "array<float>" else "array<double>"  # a float's double tells no more
    rows = df.select(F.col(key).cast("long").alias("id"), F.col(vector).cast(kind).alias("v"), F.col(label).alias("label"))
    rows = rows.withColumn("ok", usable("v") & F.col("label").isNotNull() & F.col("id").isNotNull())
    classes = rows.where("ok").groupBy("label", "v").agg(F.min("id").alias("class"), F.count("*").alias("copies"))
    classes = cut(classes.withColumn("dim", F.size("v")), "vector-classes")
    # trees part the rows of a label down to LEAF_ROWS; labels of fewer rows are one leaf, so at most one row in LEAF_ROWS is broadcast
    sizes = classes.groupBy("label", "dim").agg(F.count("*").alias("rows")).where(F.col("rows") > LEAF_ROWS)
    depth = F.least(F.ceil(F.log2(F.col("rows") / LEAF_ROWS)), F.lit(MAX_DEPTH)).cast("int")
    sizes = cut(sizes.select("label", "dim", depth.alias("depth")), "large-labels")
    forests = {}
    for dim, most in sizes.groupBy("dim").agg(F.max("depth")).collect():  # one row a vector length
        learn = sample(classes.where(F.col("dim") == dim), "class", FIT_ROWS).orderBy("class", "label").toPandas()["v"]
        forests[dim] = Forest(unit(matrix(learn)), most, cosine)
    classes_deep = classes.join(F.broadcast(sizes), ["label", "dim"], "left").fillna(0, ["depth"])

    def route(batches):
        for x in batches:
            dims, depths = x.column("dim").to_numpy(), x.column("depth").to_numpy()
            for dim, depth in sorted(set(zip(dims.tolist(), depths.tolist(), strict=True))):
                alike, step = x.filter(pa.array((dims == dim) & (depths == depth))), max(1, min(ROUTE_ROWS, BLOCK_CELLS // dim))
                for own in (alike.slice(k, step) for k in range(0, alike.num_rows, step)):
                    row, leaf = forests[dim].leaves(unit(_vectors(own.column("v"))), depth) if depth else (np.arange(own.num_rows), np.zeros(own.num_rows, np.int64))
                    leaves = pa.ListArray.from_arrays(np.searchsorted(row, np.arange(own.num_rows + 1)).astype(np.int32), leaf)
                    yield pa.RecordBatch.from_arrays([*own.columns, leaves], [*own.schema.names, "leaves"])

    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in classes_deep.schema.fields)
    placed = classes_deep.mapInArrow(route, f"{columns}, leaves array<long>").withColumn("leaf", F.explode("leaves")).drop("leaves")
    # leaves of more than a block: every pair of blocks is a tile of its own
    block = F.greatest(F.lit(1), F.least(F.lit(BLOCK_ROWS), F.floor(F.lit(BLOCK_CELLS) / F.col("dim"))))
    big = placed.groupBy("leaf", "label", "dim").agg(F.count("*").alias("rows")).withColumn("blocks", F.ceil(F.col("rows") / block).cast("int")).where("blocks > 1")
    big = cut(big.drop("rows"), "big-leaves")
    placed = placed.join(F.broadcast(big), ["leaf", "label", "dim"], "left").fillna(1, ["blocks"]).withColumn("b", F.pmod(F.xxhash64("class", "leaf"), F.col("blocks")).cast("int"))
    placed = placed.withColumn("o", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    placed = placed.withColumns({"i": F.least("b", "o"), "j": F.greatest("b", "o")}).drop("blocks", "o")

    def compare(x: pa.Table) -> pa.Table:
        x = x.sort_by("class")
        leaf, dim, depth, i, j = (x.column(c)[0].as_py() for c in ("leaf", "dim", "depth", "i", "j"))
        own_class, block = x.column("class").to_numpy(), x.column("b").to_numpy()
        left = np.flatnonzero(block == i)
        right = left if i == j else np.flatnonzero(block == j)
        n, low = leaf_links(unit(_vectors(x.column("v"))), x.column("copies").to_numpy().astype(np.float64), left, right, cosine, leaf, forests.get(dim), depth)
        hit = np.flatnonzero(n > 0)
        return pa.table({"class": own_class[hit], "n": n[hit], "root": own_class[low[hit]]})

    found = cut(placed.groupBy("leaf", "label", "dim", "i", "j").applyInArrow(compare, "class long, n long, root long"), "vector-links")
    linked = found.groupBy("class").agg(F.sum("n").alias("linked"))
    united = components(found.select(F.col("class").alias("a"), F.col("root").alias("b"))).withColumnRenamed("node", "class")
    state = cut(linked.join(united, "class", "left").withColumnRenamed("class", "s"), "vector-state")
    known = classes.select(F.col("label").alias("l"), F.col("v").alias("w"), "class", "copies")
    out = rows.join(known, (F.col("label") == F.col("l")) & (F.col("v") == F.col("w")) & F.col("ok"), "left")
    # the vectors stay behind; rows without a class are dealt by their own key and match nothing
    out = out.select("id", "class", "copies", F.coalesce("class", "id").alias("dealt"))
    out = out.join(state, (F.col("dealt") == F.col("s")) & F.col("class").isNotNull(), "left")
    out = out.select(F.col("id").alias(key), (F.coalesce(F.col("copies") - 1, F.lit(0)) + F.coalesce("linked", F.lit(0))).cast("long").alias("n_links"),
                     F.coalesce("component_id", "class", "id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col(key) == F.col("component_id"), F.lit(True)))
