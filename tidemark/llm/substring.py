"""Removal of word windows that occur more than once, level by level.

A window of ``length`` words can only repeat if the windows inside it repeat, so
the search starts at short windows and only what repeats is extended:

1. base windows (a quarter of the length). One base window stands for each
   window of full length: the one with the least hash in it. Equal windows have
   the same one, so only about one word in fourteen starts a base window (an
   *anchor*). Anchors that occur once are done.
2. twice that length: the surviving anchors are extended to the left and to the
   right; windows of full length around an extension that occurs once are done.
3. full length. Neighbouring windows with the same anchor form a *run*; runs
   whose whole text repeats are settled at once. The others, at the edges of
   copied passages, are settled window by window.

Counts are grouped aggregates of 64-bit hashes (two at the last level and for
runs), so a window that a third of all texts share is counted before the
shuffle, and its occurrences are only joined, never gathered.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import cut, text_slices
from tidemark.llm.words import Words

KEY = "__row_key"


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def runs_of(words: Words, length: int, base: int):
    """(anchor, first start, last start) of every run, as word numbers."""
    reach = length - base + 1  # base windows inside a full window
    n = len(words) - length + 1
    if n <= 0:
        return (np.zeros(0, np.int64),) * 3
    grams = words.spans(np.arange(len(words) - base + 1), base)
    stop = words.first[1:][words.document()]
    starts = np.flatnonzero(np.arange(n) + length <= stop[:n])
    anchor = np.empty(len(starts), np.int64)
    view = np.lib.stride_tricks.sliding_window_view(grams, reach)
    for at in range(0, len(starts), 1 << 16):
        s = starts[at : at + (1 << 16)]
        anchor[at : at + len(s)] = s + view[s].argmin(1)
    cuts = np.flatnonzero(np.diff(anchor, prepend=-1) != 0)
    last = np.append(cuts[1:], len(anchor)) - 1
    return anchor[cuts], starts[cuts], starts[last]


ANCHORS = T.StructType([T.StructField(c, T.LongType()) for c in ("h", "sides", "run", KEY)]
                       + [T.StructField(c, T.IntegerType()) for c in ("anchor", "lo", "hi")])


def _anchors(keyed: DataFrame, length: int, base: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            for part in text_slices(batch, "__text", 1 << 20):
                w = Words(part.column("__text").cast(pa.binary()).to_pylist())
                at, lo, hi = runs_of(w, length, base)
                if not len(at):
                    continue
                doc = w.document()
                first, stop = w.first[doc[at]], w.first[doc[at] + 1]
                left = right = np.zeros(len(at), np.uint64)  # 0 where a text ends before the extension does
                if len(w) >= 2 * base:
                    left = np.where((at - base >= first) & (at + base <= stop), w.spans(np.clip(at - base, 0, len(w) - 2 * base), 2 * base), left)
                    right = np.where(at + 2 * base <= stop, w.spans(np.minimum(at, len(w) - 2 * base), 2 * base), right)
                sides = (left >> np.uint64(32) << np.uint64(32)) | (right >> np.uint64(32))
                # a run is told by its words and by where its anchor and its windows lie
                shape = ((at - lo) * length + (hi - lo)).astype(np.uint64)
                whole = w.spans(lo, hi - lo + length) + shape * np.uint64(0x9E3779B97F4A7C15)
                keys = part.column(KEY).to_numpy(zero_copy_only=False)[doc[at]]
                yield pa.RecordBatch.from_arrays(
                    [_signed(w.spans(at, base, 1)), _signed(sides), _signed(whole), pa.array(keys),
                     *[pa.array((x - first).astype(np.int32)) for x in (at, lo, hi)]], names=ANCHORS.names)

    return keyed.select(KEY, "__text").mapInArrow(run, ANCHORS)


WINDOWS = T.StructType([T.StructField(c, T.LongType()) for c in ("a", "b", KEY)] + [T.StructField("at", T.IntegerType()), T.StructField("weight", T.IntegerType())])


def _windows(joined: DataFrame, length: int) -> DataFrame:
    """The full-length windows of the runs listed with each text."""

    def run(batches):
        for batch in batches:
            for part in text_slices(batch, "__text", 1 << 20):
                w = Words(part.column("__text").cast(pa.binary()).to_pylist())
                at, key, weight = [], [], []
                for d, (k, spans) in enumerate(zip(part.column(KEY).to_pylist(), part.column("spans").to_pylist(), strict=True)):
                    for s in spans:
                        own = np.arange(s["lo"], s["hi"] + 1) + w.first[d]
                        at.append(own)
                        key.append(np.full(len(own), k))
                        weight.append(np.full(len(own), s["weight"], np.int32))
                if at:
                    at, key = np.concatenate(at), np.concatenate(key)
                    inside = (at - w.first[w.document()[at]]).astype(np.int32)
                    yield pa.RecordBatch.from_arrays([_signed(w.spans(at, length)), _signed(w.spans(at, length, 1)), pa.array(key), pa.array(inside),
                                                      pa.array(np.concatenate(weight))], names=WINDOWS.names)

    return joined.select(KEY, "__text", "spans").mapInArrow(run, WINDOWS)


def repeated_spans(keyed: DataFrame, length: int) -> DataFrame:
    """(row key, lo, hi): windows of ``length`` words that start at words
    lo..hi of the row's text and occur more than once. ``keyed`` has KEY and
    ``__text``."""
    base = max(1, -(-length // 4))
    found = _anchors(keyed, length, base)
    # level 1: base windows
    often = cut(found.groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h"), "often")
    alive = cut(found.join(often, "h", "left_semi"), "anchors")
    # level 3 for whole runs, so that only their remainder needs level 2
    kinds = cut(alive.groupBy("h", "run").agg(F.count("*").alias("n"), F.min(F.struct(KEY, "anchor", "lo", "hi", "sides")).alias("one")), "runs")
    whole = kinds.where("n > 1")
    settled = alive.join(whole.select("h", "run"), ["h", "run"], "left_semi").select(KEY, "lo", "hi")
    edges = kinds.where("n = 1").select("h", "one.*")
    # level 2: the doubled windows on either side of the anchor
    left, right = F.shiftright("sides", 32), F.col("sides").bitwiseAND((1 << 32) - 1)

    def twice(side, name):
        counted = kinds.select("h", "n", "one.sides").groupBy("h", side.alias(name)).agg(F.sum("n").alias("n"))
        return cut(counted.where("n > 1").select("h", name, F.lit(True).alias(f"{name}_again")), "twice")

    edges = (edges.withColumns({"l": left, "r": right}).join(twice(left, "l"), ["h", "l"], "left").join(twice(right, "r"), ["h", "r"], "left"))
    # a window that reaches `base` words before the anchor holds the left extension,
    # one that reaches 2*base words from the anchor the right one
    lo = F.when(F.col("l_again"), F.col("lo")).otherwise(F.greatest(F.col("lo"), F.col("anchor") - (base - 1)))
    hi = F.when(F.col("r_again"), F.col("hi")).otherwise(F.least(F.col("hi"), F.col("anchor") + (2 * base - 1 - length)))
    edges = edges.select("h", KEY, lo.alias("lo"), hi.alias("hi")).where("lo <= hi")
    # a settled run is one more place where an edge's window may start
    witness = whole.join(edges.select("h").distinct(), "h", "left_semi").select(f"one.{KEY}", "one.lo", "one.hi", F.lit(2).alias("weight"))
    spans = (edges.select(KEY, "lo", "hi", F.lit(1).alias("weight")).union(witness)
             .groupBy(KEY).agg(F.collect_list(F.struct("lo", "hi", "weight")).alias("spans")))
    single = cut(_windows(keyed.join(spans, KEY), length), "windows")
    again = cut(single.groupBy("a", "b").agg(F.sum("weight").alias("n")).where("n > 1").select("a", "b"), "again")
    late = single.where("weight = 1").join(again, ["a", "b"], "left_semi").select(KEY, F.col("at").alias("lo"), F.col("at").alias("hi"))
    return settled.union(late)


def remove_repeats(df: DataFrame, length: int = 35, text: str = "text") -> DataFrame:
    """``df`` with its text reduced to the words that no repeated window covers
    (joined by one space), and n_words, n_removed.

    A window is ``length`` consecutive words of one text; it is repeated when
    its words also start anywhere else, in the same text included, judged on the
    input. Words are runs of anything but space and 0x09-0x0D, unchanged. A null
    text has no words and becomes empty; texts shorter than a window lose
    nothing. Repeated rows are occurrences of their own, so equal texts of at
    least ``length`` words lose all words. A null in any other column passes
    through; columns named n_words or n_removed are replaced. Rows are told
    apart by a 64-bit hash of all columns.
    """
    names = [c for c in df.columns if c.lower() not in ("n_words", "n_removed")]
    df = df.select(*[F.col(f"`{c}`") for c in names])
    keyed = df.withColumns({KEY: F.xxhash64(F.to_json(F.struct(*[F.col(f"`{c}`") for c in names if c != text])), F.col(f"`{text}`")), "__text": F.col(f"`{text}`")})
    # rows that are equal throughout lose every window; one of them stands for all among the windows
    copies = cut(keyed.groupBy(KEY).agg(F.count("*").alias("n")).where("n > 1").select(KEY, F.lit(True).alias("__copied")), "copies")
    once = keyed.select(KEY, "__text")
    if not copies.isEmpty():
        once = cut(once.groupBy(KEY).agg(F.min("__text").alias("__text")), "texts")
    spans = repeated_spans(once, length).groupBy(KEY).agg(F.collect_list(F.struct("lo", "hi")).alias("__spans"))
    spans = spans.join(copies, KEY, "full")
    joined = keyed.drop("__text").join(spans, KEY, "left").drop(KEY)
    schema = T.StructType([*df.schema.fields, T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType())])

    def run(batches):
        for batch in batches:
            for part in text_slices(batch, text, 1 << 20):
                w = Words(part.column(text).cast(pa.binary()).to_pylist())
                gone = np.zeros(len(w) + 1, np.int32)
                for d, (spans, copied) in enumerate(zip(part.column("__spans").to_pylist(), part.column("__copied").to_pylist(), strict=True)):
                    first, size = w.first[d], w.first[d + 1] - w.first[d]
                    if copied and size >= length:
                        gone[first] += 1
                        gone[first + size] -= 1
                    elif spans:
                        np.add.at(gone, [s["lo"] + first for s in spans], 1)
                        np.add.at(gone, [s["hi"] + first + length for s in spans], -1)
                removed = np.cumsum(gone)[: len(w)] > 0
                kept, counts, lost = [], [], []
                for d in range(part.num_rows):
                    a, b = w.first[d], w.first[d + 1]
                    stay = a + np.flatnonzero(~removed[a:b])
                    kept.append(b" ".join([w.data[i:j] for i, j in zip(w.start[stay].tolist(), w.end[stay].tolist(), strict=True)]).decode())
                    counts.append(int(b - a))
                    lost.append(int(b - a - len(stay)))
                cols = [pa.array(kept, pa.string()) if c == text else part.column(c) for c in names]
                yield pa.RecordBatch.from_arrays([*cols, pa.array(counts, pa.int64()), pa.array(lost, pa.int64())], names=schema.names)

    return joined.mapInArrow(run, schema)
