"""Near-duplicate documents by Order MinHash.

A text's k-mers (five words) are labelled by occurrence, so repeats stay apart.
Each of several sketches takes the few k-mers with the least hash and hashes
them in the order in which they stand in the text: texts agree in a sketch when
they share these k-mers in the same order, which follows edit similarity. Texts
that agree in a sketch are candidates; a banded alignment of their words decides.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import components, cut, text_slices
from tidemark.llm.words import Words, mix, salted

#: Words of a k-mer, sketches, and k-mers of a sketch.
K, SKETCHES, TAKE = 5, 64, 2
FAR = np.int32(1 << 28)
_FACTORS = np.random.default_rng(20240605).integers(1, 2**63, SKETCHES, np.uint64) * np.uint64(2) + np.uint64(1)
#: Texts on a side of a tile of a bucket, about; pairs a text and component are first given.
TILE, FIRST_PAIRS = 2048, 8
#: Members from which an open bucket is divided by its texts' rare words.
LARGE = 8 * TILE
#: Texts on a side of a block of a tile's pairs that is verified at once; words of the pairs aligned at once.
BLOCK, PAIR_WORDS = 64, 1 << 20


def _occurrences(doc: np.ndarray, gram: np.ndarray) -> np.ndarray:
    """How often the same k-mer stood earlier in the same text."""
    order = np.lexsort((np.arange(len(doc)), gram, doc))
    d, g = doc[order], gram[order]
    new = np.ones(len(d), bool)
    new[1:] = (d[1:] != d[:-1]) | (g[1:] != g[:-1])
    at = np.arange(len(d))
    out = np.empty(len(d), np.int64)
    out[order] = at - np.maximum.accumulate(np.where(new, at, 0))
    return out


def sketch(texts: list[bytes | None]) -> np.ndarray:
    """Sketch keys (text x SKETCHES, int64); texts without words get zeros."""
    w = Words(texts)
    out = np.zeros((len(texts), SKETCHES), np.int64)
    size = np.diff(w.first)
    grams = np.maximum(size - K + 1, (size > 0).astype(np.int64))  # a shorter text is one k-mer
    doc = np.repeat(np.arange(len(texts)), grams)
    if not len(doc):
        return out
    begin = np.cumsum(grams) - grams
    start = w.first[doc] + np.arange(len(doc)) - begin[doc]
    gram = w.spans(start, np.minimum(K, size[doc]))
    label = mix(gram + _occurrences(doc, gram).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    own = np.flatnonzero(grams)
    heads = begin[own]
    for s in range(SKETCHES):
        rank = label * _FACTORS[s]  # labels are mixed; another odd factor orders them anew
        taken = []
        for _ in range(TAKE):
            least = np.minimum.reduceat(rank, heads)
            at = np.flatnonzero(rank == np.repeat(least, grams[own]))
            _, first = np.unique(doc[at], return_index=True)
            taken.append(at[first])
            rank[at[first]] = np.uint64(2**64 - 1)
        place = np.sort(np.stack(taken, 1), axis=1)  # text order
        key = np.zeros(len(own), np.uint64)
        for c in range(TAKE):
            key = salted(key ^ label[place[:, c]], SKETCHES + 1)
        out[own, s] = salted(key, s + 1).view(np.int64)
    return out


def _band(a: np.ndarray, n: np.ndarray, b: np.ndarray, m: np.ndarray, width: int) -> np.ndarray:
    """Edit distances of padded int32 rows a, b (lengths n, m), exact where they
    are at most ``width``: only cells within ``width`` of the diagonal are computed."""
    rows, top = len(n), int(n.max(initial=0))
    # a cell within the band is at most the row's number and the width away from 0
    kind, far = (np.int16, 1 << 14) if top + 4 * width < 1 << 14 else (np.int32, 1 << 28)
    k = np.arange(2 * width + 1, dtype=kind)
    padded = np.full((rows, top + 2 * width + 1), np.int32(-2))
    padded[:, width : width + min(b.shape[1], top + width + 1)] = b[:, : top + width + 1]
    now = np.broadcast_to(np.where(k >= width, k - kind(width), kind(far)).astype(kind), (rows, len(k))).copy()
    out = np.where(n == 0, m, FAR).astype(np.int32)
    ends = {int(i): np.flatnonzero(n == i) for i in np.unique(n)}
    for i in range(1, top + 1):
        step = now + (padded[:, i - 1 : i + 2 * width] != a[:, i - 1 : i])
        np.minimum(step[:, :-1], now[:, 1:] + kind(1), out=step[:, :-1])
        step -= k
        now = np.minimum.accumulate(step, axis=1)
        now += k
        np.minimum(now, kind(far), out=now)
        if i in ends:
            end = ends[i]
            at = m[end] - i + width
            ok = (at >= 0) & (at <= 2 * width)
            out[end[ok]] = now[end[ok], at[ok]]
    return out


def _common(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """Words that each pair of rows has in common, repeats counted (at least
    that many: two words may share a 40-bit key)."""
    def counted(rows):
        pair = np.repeat(np.arange(len(rows), dtype=np.uint64), [len(r) for r in rows])
        word = mix(np.concatenate([np.zeros(0, np.uint64), *[r.astype(np.uint64) for r in rows]]))
        return np.unique((pair << np.uint64(40)) | (word >> np.uint64(24)), return_counts=True)

    (u, ux), (v, vy) = counted(a), counted(b)
    if not len(u) or not len(v):
        return np.zeros(len(a), np.int64)
    at = np.minimum(np.searchsorted(u, v), len(u) - 1)
    both = np.where(u[at] == v, np.minimum(ux[at], vy), 0)
    return np.bincount((v >> np.uint64(40)).astype(np.int64), weights=both, minlength=len(a)).astype(np.int64)


def similar(a: list[np.ndarray], b: list[np.ndarray], least: float) -> np.ndarray:
    """For each pair of word-hash rows: is 1 - edit distance / longer length at
    least ``least``? Words in common bound the distance from below; the band
    begins beyond that bound and is widened until the distance fits into it or
    it is beyond the limit."""
    n, m = np.array([len(x) for x in a], np.int64), np.array([len(x) for x in b], np.int64)
    longer = np.maximum(n, m)
    limit = np.floor((1 - least) * longer + 1e-9).astype(np.int64)
    out = np.zeros(len(n), bool)
    todo = np.flatnonzero((np.abs(n - m) <= limit) & (longer > 0))
    low = longer[todo] - _common([a[i] for i in todo], [b[i] for i in todo])
    todo, low = todo[low <= limit[todo]], low[low <= limit[todo]]
    width = np.zeros(len(n), np.int64)
    width[todo] = np.minimum(limit[todo], np.maximum(16, 1 << np.ceil(np.log2(low * 5 // 4 + 2)).astype(np.int64)))
    while len(todo):
        todo = todo[np.lexsort((longer[todo], width[todo]))]
        left = []
        at = 0
        while at < len(todo):
            to, first = at + 1, int(width[todo[at]])
            while to < len(todo) and width[todo[to]] <= first + first // 8 and (to - at) * int(longer[todo[to]] + 2 * width[todo[to]]) < 400_000:
                to += 1
            part = todo[at:to]
            wide, band = int(longer[part].max()), int(width[part].max())
            x, y = np.full((len(part), wide), np.int32(-1)), np.full((len(part), wide), np.int32(-3))
            for r, i in enumerate(part):
                x[r, : n[i]], y[r, : m[i]] = a[i], b[i]
            distance = _band(x, n[part], y, m[part], band)
            out[part] = distance <= np.minimum(limit[part], band)
            left.append(part[(distance > band) & (limit[part] > band)])
            width[left[-1]] = np.minimum(limit[left[-1]], 2 * band)
            at = to
        todo = np.concatenate(left)
    return out


def _shared(words: list[np.ndarray], x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """At least the number of words that the texts ``x`` (rows) and ``y``
    (columns) of ``words`` have in common (repeats counted), and about that:
    words are counted in cells, a few cells of all texts at a time."""
    size = np.array([len(w) for w in words], np.int64)
    doc = np.repeat(np.arange(len(words)), size)
    flat = np.concatenate([np.zeros(0, np.int64), *words]).astype(np.uint64)
    cells = 1 << max(10, int(16 * size.max(initial=1)).bit_length())
    while cells > 1024 and cells * len(words) > 1 << 24:
        cells >>= 1
    at = (mix(flat + _occurrences(doc, flat).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) & np.uint64(cells - 1)).astype(np.int64)
    return _held_by_both(doc, at, cells, len(words), x, y)


def _held_by_both(doc: np.ndarray, at: np.ndarray, cells: int, texts: int, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """What the texts ``x`` (rows) and ``y`` (columns) both hold: the texts
    ``doc`` hold the cells ``at``; a few cells of all texts at a time."""
    order = np.argsort(at, kind="stable")
    doc, at = doc[order], at[order]
    wide = min(cells, max(64, (1 << 20) // max(texts, 1)))
    out, part = (np.zeros((len(x), len(y)), np.float32) for _ in range(2))
    for first in range(0, cells, wide):
        a, b = np.searchsorted(at, [first, first + wide])
        held = np.bincount(doc[a:b] * wide + at[a:b] - first, minlength=texts * wide).reshape(texts, wide).astype(np.float32)
        out += np.matmul(held[x], held[y].T, out=part)
    return out


def _met(own: pa.ChunkedArray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Do the texts ``x`` (rows) and ``y`` (columns) have one of the buckets ``own`` in common?"""
    lists = own.to_pylist()
    doc = np.repeat(np.arange(len(lists)), [len(r) for r in lists])
    _, at, n = np.unique(np.concatenate([np.zeros(0, np.int64), *[np.array(r, np.int64) for r in lists]]), return_inverse=True, return_counts=True)
    some = n[at] > 1
    _, at = np.unique(at[some], return_inverse=True)
    return _held_by_both(doc[some], at, int(at.max(initial=0)) + 1, len(lists), x, y) > 0.5


def _tile(t: pa.Table, least: float, cap: int) -> pa.Table:
    """The pairs of a tile that are in two components and that lengths and words
    in common do not rule out, and that met in one of the buckets ``own``, if
    there is such a column; of a text and a component at most ``cap``, those
    with the most words in common, and ``more`` says that there were others."""
    t = t.sort_by("id")
    ids, comp, left, other = (t.column(c).to_numpy() for c in ("id", "comp", "left", "other"))
    words = [np.frombuffer(x, "<i4").astype(np.int64) for x in t.column("words").to_pylist()]
    size = np.array([len(x) for x in words], np.int64)
    x, y = np.flatnonzero(left), np.flatnonzero(~left)
    met = _met(t.column("own"), x, y) if "own" in t.column_names else None
    shared = _shared(words, x, y)
    at_x, at_y, in_common = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for first in range(0, len(x), 128):  # the rules need several tables of a row and column each
        r = x[first : first + 128]
        common = np.rint(shared[first : first + 128]).astype(np.int64)
        longer = np.maximum(size[r][:, None], size[y])
        limit = np.floor((1 - least) * longer + 1e-9).astype(np.int64)
        ok = (np.abs(size[r][:, None] - size[y]) <= limit) & (longer - common <= limit) & (comp[r][:, None] != comp[y])
        ok &= (ids[r][:, None] < ids[y]) | ~other[y]  # two texts outside the largest component meet twice
        if met is not None:
            ok &= met[first : first + 128]
        i, j = np.nonzero(ok)
        at_x.append(i + first)
        at_y.append(j)
        in_common.append(common[i, j])
    i, j, common = np.concatenate(at_x), np.concatenate(at_y), np.concatenate(in_common)
    order = np.lexsort((-common, comp[y[j]], i))
    i, j = i[order], j[order]
    new = np.ones(len(i), bool)
    new[1:] = (i[1:] != i[:-1]) | (comp[y[j[1:]]] != comp[y[j[:-1]]])
    at = np.arange(len(i))
    rank = at - np.maximum.accumulate(np.where(new, at, 0))
    i, j, last = i[rank < cap], j[rank < cap], (rank >= cap).any()
    a, b = ids[x[i]], ids[y[j]]
    return pa.table({"a": np.minimum(a, b), "b": np.maximum(a, b), "bucket": np.full(len(a), t.column("bucket")[0].as_py(), np.int64), "more": np.full(len(a), last)})


_PACKET = T.StructType([T.StructField("bucket", T.LongType()), T.StructField("more", T.BooleanType()), T.StructField("ids", T.ArrayType(T.LongType())),
                        T.StructField("words", T.ArrayType(T.BinaryType())), T.StructField("x", T.ArrayType(T.IntegerType())), T.StructField("y", T.ArrayType(T.IntegerType()))])


def _packets(t: pa.Table, least: float, cap: int) -> Iterator[pa.RecordBatch]:
    """The pairs of a tile (see ``_tile``) with their texts' words, a block of
    BLOCK texts against BLOCK a row: ``x`` and ``y`` number the row's ``ids``."""
    t = t.sort_by("id")
    ids, words = t.column("id").to_numpy(), t.column("words")
    found = _tile(t, least, cap)
    a, b = (np.searchsorted(ids, found.column(c).to_numpy()) for c in ("a", "b"))
    order = np.lexsort((b // BLOCK, a // BLOCK))
    a, b = a[order], b[order]
    starts = np.flatnonzero(np.diff(np.stack([a, b]) // BLOCK, axis=1, prepend=-1).any(0))
    for i, j in zip(starts, [*starts[1:], len(a)], strict=False):
        own, at = np.unique(np.concatenate([a[i:j], b[i:j]]), return_inverse=True)
        at = at.astype(np.int32)
        row = {"bucket": found.column("bucket")[0].as_py(), "more": found.column("more")[0].as_py(), "ids": ids[own], "words": words.take(pa.array(own)).to_pylist(),
               "x": at[: j - i], "y": at[j - i :]}
        kinds = (pa.int64(), pa.bool_(), pa.list_(pa.int64()), pa.list_(pa.binary()), pa.list_(pa.int32()), pa.list_(pa.int32()))
        yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row.values(), kinds, strict=True)], names=list(row))


def _linked(packets: DataFrame, least: float) -> DataFrame:
    """(a, b): the pairs of the packets whose alignment is good enough. Packets
    are dealt round-robin: a tile with many pairs occupies more than one task."""

    def run(batches):
        for batch in batches:
            for p in batch.to_pylist():
                ids, x, y = (np.array(p[c], np.int64) for c in ("ids", "x", "y"))
                rows = [np.frombuffer(r, "<i4").astype(np.int64) for r in p["words"]]
                part = np.cumsum(np.array([len(rows[i]) + len(rows[j]) for i, j in zip(x, y, strict=True)], np.int64)) // PAIR_WORDS
                for k in np.unique(part):
                    i, j = x[part == k], y[part == k]
                    ok = similar([rows[v] for v in i], [rows[v] for v in j], least)
                    yield pa.RecordBatch.from_arrays([pa.array(ids[i[ok]]), pa.array(ids[j[ok]])], names=["a", "b"])

    parts = int(packets.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return packets.select("ids", "words", "x", "y").repartition(parts).mapInArrow(run, "a long, b long")


def _rare_words(part: DataFrame, words: DataFrame, least: float) -> DataFrame:
    """(bucket, id, own, comp): the texts of ``part`` dealt anew, by their rare words.

    A text's words are labelled by occurrence and ordered by the texts of
    ``part`` that hold them, rarest first. If an edit similarity of ``least`` or
    more is possible, the texts have so many words in common that they share one
    of the first floor((1 - least) * words) + 1 of each. So no pair that may be
    linked is lost, while texts that only share what is common in the bucket
    part ways."""

    def run(batches):
        for batch in batches:
            for piece in text_slices(batch, "words", 1 << 20):
                rows = [np.frombuffer(x, "<i4").astype(np.uint64) for x in piece.column("words").to_pylist()]
                size = np.array([len(x) for x in rows], np.int64)
                doc, flat = np.repeat(np.arange(len(rows)), size), np.concatenate([np.zeros(0, np.uint64), *rows])
                label = mix(flat + _occurrences(doc, flat).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)).view(np.int64)
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(size)]), pa.int32()), pa.array(label))
                yield pa.RecordBatch.from_arrays([piece.column("id"), lists], names=["id", "labels"])

    ids = part.groupBy("id").agg(F.array_distinct(F.flatten(F.collect_list("own"))).alias("own"), F.min("comp").alias("comp"))
    labels = words.join(ids.select("id"), "id", "left_semi").mapInArrow(run, "id long, labels array<long>")
    labels = cut(labels.select("id", F.size("labels").alias("size"), F.explode("labels").alias("label")), "omh-labels")
    held = cut(labels.groupBy("label").agg(F.count("*").alias("texts")).where("texts > 1"), "omh-labels")
    # a label that no other text holds comes before all others and makes no group
    first = labels.join(held, "label", "left").withColumn("place", F.row_number().over(Window.partitionBy("id").orderBy(F.asc_nulls_first("texts"), "label")))
    first = first.where(F.col("texts").isNotNull() & (F.col("place") <= F.floor((1 - least) * F.col("size") + 1e-9) + 1))
    return first.select("id", F.col("label").alias("bucket")).join(ids, "id").select("bucket", "id", "own", "comp")


def _sizes(part: DataFrame) -> DataFrame:
    """Of each bucket in more than one component: members, the component with
    most of them (``top``), those in others, and a mark of its members."""
    sizes = part.groupBy("bucket", "comp").agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("id")).alias("mark"))
    sizes = sizes.groupBy("bucket").agg(F.sum("n").alias("n"), F.count("*").alias("comps"), F.max(F.struct("n", "comp")).alias("top"), F.bit_xor("mark").alias("mark"))
    return sizes.where("comps > 1")


def _merged(members: DataFrame, known: DataFrame) -> DataFrame:
    """(bucket, id, own): the members (bucket, id, n) of buckets in more than one
    component, where buckets that hold much the same texts are one; ``own`` are
    the buckets of the text in it.

    Texts near each other meet in many buckets. A text's home is its largest
    bucket; buckets whose members mostly have one home are merged. A merged bucket
    of over twice its largest bucket's texts is left as its buckets, so merging
    never adds rows, and to a bucket's pairs at most three times as many."""
    part = members.join(known.select(F.col("node").alias("id"), "component_id"), "id", "left")
    part = cut(part.select("bucket", "id", "n", F.coalesce("component_id", "id").alias("comp")), "omh-members")
    part = part.join(cut(_sizes(part).select("bucket"), "omh-open"), "bucket", "left_semi")
    part = cut(part.withColumn("home", F.max(F.struct("n", "bucket")).over(Window.partitionBy("id"))["bucket"]), "omh-home")
    votes = part.groupBy("bucket", "home").agg(F.count("*").alias("votes")).groupBy("bucket").agg(F.max(F.struct("votes", "home"))["home"].alias("into"))
    part = cut(part.join(cut(votes, "omh-home"), "bucket"), "omh-home")
    merged = cut(part.groupBy("into", "id").agg(F.collect_set("bucket").alias("own"), F.max("n").alias("n")), "omh-home")
    wide = cut(merged.groupBy("into").agg(F.count("*").alias("held"), F.max("n").alias("n")).where("held > 2 * n").select("into"), "omh-home")
    alone = part.join(wide, "into", "left_semi").select(F.xxhash64("bucket", F.lit("alone")).alias("bucket"), "id", F.array("bucket").alias("own"))
    return cut(merged.join(wide, "into", "left_anti").select(F.col("into").alias("bucket"), "id", "own").unionByName(alone), "omh-home")


def _open_pairs(members: DataFrame, known: DataFrame, words: DataFrame, least: float, cap: int) -> tuple[DataFrame, DataFrame]:
    """Packets of pairs (see ``_packets``), and the open buckets' members: pairs of ``members`` (bucket, id, own) that may
    still join components. Buckets inside one component have none, and buckets with
    the same members count once. Buckets of more than LARGE members are divided by
    rare words. A bucket is cut into tiles, texts outside its largest component
    against all."""
    part = members.join(known.select(F.col("node").alias("id"), "component_id"), "id", "left")
    part = cut(part.select("bucket", "id", "own", F.coalesce("component_id", "id").alias("comp")), "omh-members")
    sizes = cut(_sizes(part), "omh-open")
    large = sizes.where(F.col("n") > LARGE).select("bucket")
    if not large.isEmpty():
        divided = _rare_words(part.join(large, "bucket", "left_semi"), words, least)
        part = cut(part.join(large, "bucket", "left_anti").unionByName(divided), "omh-members")
        sizes = _sizes(part)
    blocks = lambda n: F.ceil(n / F.lit(TILE)).cast("int")
    sizes = sizes.groupBy("mark", "n").agg(F.min(F.struct("bucket", F.col("top.comp").alias("top"), blocks(F.col("n") - F.col("top.n")).alias("rows"), blocks(F.col("n")).alias("cols"))).alias("s"))
    part = cut(part.join(cut(sizes.select("s.*"), "omh-open"), "bucket").withColumn("other", F.col("comp") != F.col("top")), "omh-open")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    row, col = F.pmod(F.xxhash64("id", "bucket"), "rows").cast("int"), F.pmod(F.xxhash64("id"), "cols").cast("int")
    own = ["bucket", "id", "own", "comp", "other"]
    tiles = part.where("other").select(*own, F.lit(True).alias("left"), row.alias("i"), every("cols").alias("j"))
    tiles = tiles.union(part.select(*own, F.lit(False), every("rows"), col)).join(words, "id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _packets(pa.Table.from_batches(batches), least, cap)

    return tiles.groupBy("bucket", "i", "j").applyInArrow(run, _PACKET), part


def _hashes(df: DataFrame) -> DataFrame:
    """(id, words): the words of each text as 31-bit hashes, little-endian int32."""

    def run(batches):
        for batch in batches:
            for part in text_slices(batch, "text", 1 << 20):
                w = Words(part.column("text").cast(pa.binary()).to_pylist())
                flat = (w.hash >> np.uint64(33)).astype("<i4")
                words = [flat[a:b].tobytes() for a, b in zip(w.first, w.first[1:], strict=False)]
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(words, pa.binary())], names=["id", "words"])

    return df.mapInArrow(run, "id long, words binary")


def _verified(pairs: DataFrame, words: DataFrame, least: float) -> DataFrame:
    """The pairs (a, b) whose alignment is good enough."""

    def run(batches):
        for batch in batches:
            for part in text_slices(batch, "x", 8 << 20):
                x, y = ([np.frombuffer(r, "<i4").astype(np.int64) for r in part.column(c).to_pylist()] for c in ("x", "y"))
                yield part.select(["a", "b"]).filter(pa.array(similar(x, y, least)))

    both = pairs.join(words.select(F.col("id").alias("a"), F.col("words").alias("x")), "a").join(words.select(F.col("id").alias("b"), F.col("words").alias("y")), "b")
    return both.select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text", least: float = 0.8) -> DataFrame:
    """(key, class_id, component_id, kept), one row a row of ``df``.

    class_id is the least key with exactly the same text. Two texts are linked
    when the edit similarity of their whole word sequences (1 - word edits /
    words of the longer) is at least ``least``; component_id is the least key
    reachable by links, itself included, and kept says whether it is the row's
    own. Candidates are all pairs that agree in a sketch; thousands of copies of
    a text are one text. First every member of a bucket is paired with one
    member, another in each sketch; of these pairs the most often shared one of
    each member is verified, then those that share several sketches or a bucket
    of two. Then all pairs of a bucket that are still in two
    components are ruled out by their lengths and words in common or verified,
    a few for each text and component at first, until none is left.

    Null texts and texts without words link with nothing; rows without a key
    neither (their class is null). Rows with one key are one document. Other
    columns are not read; an empty table gives no rows.
    """
    rows = df.select(F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{text}`").alias("text"))
    part = rows.where("id IS NOT NULL AND text IS NOT NULL").where(F.col("text").rlike(r"[^\x20\x09-\x0D]"))

    def run(batches):
        for batch in batches:
            for piece in text_slices(batch, "text", 1 << 20):
                keys = sketch(piece.column("text").cast(pa.binary()).to_pylist())
                flat = pa.ListArray.from_arrays(pa.array(np.arange(0, keys.size + 1, SKETCHES, dtype=np.int32)), pa.array(keys.ravel()))
                yield pa.RecordBatch.from_arrays([piece.column("id"), piece.column("digest"), flat], names=["id", "digest", "keys"])

    digested = part.select("id", F.md5("text").alias("digest"), "text")
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("digest", T.StringType()), T.StructField("keys", T.ArrayType(T.LongType()))])
    classes = cut(digested.mapInArrow(run, schema).groupBy("digest").agg(F.min("id").alias("id"), F.min("keys").alias("keys")), "omh-classes")
    keyed = classes.select("id", F.explode("keys").alias("bucket")).where("bucket <> 0")
    # any member can be the centre; its choice by a hash with the bucket differs between sketches
    centres = keyed.groupBy("bucket").agg(F.min(F.struct(F.xxhash64("bucket", "id").alias("h"), "id")).alias("c"), F.count("*").alias("n"))
    centres = cut(centres.where("n > 1").select("bucket", F.col("c.id").alias("centre"), "n"), "omh-centres")
    members = cut(keyed.join(centres, "bucket"), "omh-members")
    pairs = (members.where("id <> centre").groupBy(F.least("id", "centre").alias("a"), F.greatest("id", "centre").alias("b"))
             .agg(F.count("*").alias("shared"), F.min("n").alias("n")))
    pairs = cut(pairs, "omh-pairs")
    wanted = pairs.select(F.col("a").alias("id")).union(pairs.select(F.col("b").alias("id"))).distinct()
    # one plan at every size: a broadcast of the few ids of a small table would not hold for a large one
    # written before it is hashed: sorting texts and handing them to Python do not share a task's memory
    reps = cut(part.join(wanted.hint("merge"), "id", "left_semi").groupBy("id").agg(F.min("text").alias("text")), "omh-texts")
    words = cut(_hashes(reps), "omh-words")
    both = pairs.select("a", "b", "shared").union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"), "shared"))
    best = both.withColumn("r", F.row_number().over(Window.partitionBy("a").orderBy(F.desc("shared"), "b"))).where("r = 1")
    first = cut(best.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "omh-pairs")
    links = cut(_verified(first, words, least), "omh-links")
    known = components(links)
    side = lambda c: known.select(F.col("node").alias(c), F.col("component_id").alias(f"c{c}"))
    # pairs that met more than once, and those that no larger bucket holds; the others come with their buckets
    likely = cut(pairs.where("shared > 1 OR n = 2").select("a", "b").join(first, ["a", "b"], "left_anti"), "omh-pairs")
    open_ = likely.join(side("a"), "a", "left").join(side("b"), "b", "left").where(F.coalesce("ca", "a") != F.coalesce("cb", "b")).select("a", "b")
    links = cut(links.union(_verified(open_, words, least)), "omh-links")
    known, cap, more = components(links), FIRST_PAIRS, True
    members = _merged(members.where("n > 2"), known)
    while more:
        found, part = _open_pairs(members, known, words, least, cap)
        found = cut(found, "omh-found")
        new = cut(_linked(found, least), "omh-links")
        # all pairs of the other buckets have been seen
        again = found.where("more").select("bucket").distinct()
        more = bool(again.head(1))
        members, cap = part.join(again, "bucket", "left_semi").select("bucket", "id", "own"), 256 * cap
        if new.head(1):
            links = links.union(new)
            known = components(links)
    ids = classes.select("digest", F.col("id").alias("class_id")).join(known.select(F.col("node").alias("class_id"), "component_id"), "class_id", "left")
    out = rows.select("id", F.when(F.col("id").isNotNull(), F.md5("text")).alias("digest")).join(ids, "digest", "left")
    component = F.coalesce("component_id", "class_id", "id")
    return out.select(F.col("id").alias(key), F.coalesce("class_id", "id").alias("class_id"), component.alias("component_id"),
                      F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))
