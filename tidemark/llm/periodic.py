"""Periodic runs of words, found as maximal pairs.

A maximal pair is a stretch of words that occurs at two places and can be
extended neither to the left nor to the right: the words before the two places
differ, and so do the words behind. If the places are ``q`` words apart and the
stretch is ``n`` words long, the words from the first place to the second one's
end are a run of period ``q`` and length ``n + q``, which no neighbouring word
extends. So the runs of exponent 4 or more are exactly the maximal pairs at a
distance of at most a third of their length; of several with the same start and
end the least distance is the period.

The pairs are enumerated on the tree of LCP intervals, bottom-up. Each interval
holds its occurrences in order, with the class of the word to the left of each.
Children are joined smaller into larger; each occurrence of the smaller looks up
the occurrences of the larger within the distance. Those occurrences are one
arithmetic progression (occurrences of a stretch within half its length of each
other always are), and all of its members but the first have the same left word:
so one look to each side finds every pair of different classes, and words spent
on pairs that are not maximal are bounded. Words are numbered exactly, not hashed.

Main entry point: :func:`find_runs`.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import text_slices

#: The least exponent and the least length of a run, in periods and words.
EXPONENT, LEAST = 4, 6
#: Words that both places of a maximal pair share at least.
SHARED = LEAST - 1


def words_of(text: str | None) -> list[bytes]:
    """Runs of characters other than space and 0x09-0x0D, as UTF-8."""
    return (text or "").encode().split()


def suffix_order(codes: np.ndarray, doc: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places, shared): the places whose first SHARED words occur again in
    their document, in the order of their suffixes, and how many words each
    shares with the one before it (0 where fewer than SHARED). ``end[i]`` is the
    end of the document of word i.

    Prefix doubling. A place's rank is the number of suffixes known to be
    smaller, so a place whose beginning is unique has its final rank and drops
    out: intervals of fewer than SHARED words hold no pair that is wanted."""
    n = len(codes)
    _, group, count = np.unique(doc * (int(codes.max(initial=0)) + 1) + codes, return_inverse=True, return_counts=True)
    rank = (np.cumsum(count) - count)[group]
    at = np.flatnonzero(count[group] > 1)

    def refine(at: np.ndarray, step: int) -> np.ndarray:
        """Rank by the words ``step`` further on, too; the places still equal to others."""
        to = at + step
        inside = to < end[at]
        key = rank[at] * (n + 1) + np.where(inside, rank[np.where(inside, to, 0)] + 1, 0)
        order = np.argsort(key, kind="stable")
        at, key = at[order], key[order]
        new = np.concatenate([[True], np.diff(key) != 0])
        head = key // (n + 1)
        block = np.concatenate([[True], np.diff(head) != 0])
        here = np.arange(len(at))
        first = np.maximum.accumulate(np.where(new, here, 0))
        rank[at] = head + first - np.maximum.accumulate(np.where(block, here, 0))
        lone = new & np.concatenate([new[1:], [True]])
        return at[~lone]

    for step in (1, 2, SHARED - 4):  # ranks by 2, 4 and SHARED words
        if not len(at):
            break
        at = refine(at, step)
    if not len(at):
        return at, at
    kept = np.sort(at)
    family, width = rank[kept].copy(), SHARED
    while len(at):
        at, width = refine(at, width), width * 2
    order = np.argsort(rank[kept], kind="stable")
    at, family = kept[order], family[order]
    # Kasai's walk over the kept places: the place after i shares one word less
    shared = np.zeros(len(at), np.int64)
    spot = {int(p): k for k, p in enumerate(at)}
    words, same, stop = codes.tolist(), family.tolist(), end.tolist()
    got, before, last = 0, at.tolist(), -2
    for i in sorted(spot):
        k = spot[i]
        got = got - 1 if i == last + 1 and got else 0
        last = i
        if k == 0 or same[k] != same[k - 1]:
            got = 0
            continue
        j = before[k - 1]
        got = max(got, SHARED)
        most = stop[i] - max(i, j)
        while got < most and words[i + got] == words[j + got]:
            got += 1
        shared[k] = got
    return at, shared


def maximal_pairs(places: np.ndarray, shared: np.ndarray, left: list[int]) -> dict[tuple[int, int], int]:
    """(start, length) -> period of the runs among the maximal pairs of the LCP
    intervals over ``places``; ``left[i]`` is the class of the word before i."""
    runs: dict[tuple[int, int], int] = {}

    def pair(i: int, j: int, n: int) -> None:
        key = (i, j - i + n)
        if runs.get(key, n) > j - i:
            runs[key] = j - i

    def joined(one: list[int], two: list[int], n: int) -> list[int]:
        """Both lists as one; reports the maximal pairs of ``n`` words between them."""
        gap = n // (EXPONENT - 1)
        small, large = (one, two) if len(one) < len(two) else (two, one)
        size = len(large)
        for v in small:
            own = left[v]
            k = bisect_left(large, v - gap)
            if k < size and (u := large[k]) < v:
                if left[u] != own:
                    pair(u, v, n)
                k = bisect_right(large, v, k)
            if k < size and large[k] <= v + gap and left[large[k]] != own:
                while k < size and large[k] <= v + gap:
                    pair(v, large[k], n)
                    k += 1
        if len(small) * 8 < size:
            for v in small:
                insort(large, v)
        else:
            large += small
            large.sort()
        return large

    stack: list[tuple[int, list[int]]] = []
    held: list[int] = []
    for p, n in zip([*places.tolist(), -1], [*shared.tolist(), 0], strict=True):
        while stack and stack[-1][0] > n:
            words, members = stack.pop()
            held = joined(members, held, words)
        if n and stack and stack[-1][0] == n:
            words, members = stack.pop()
            stack.append((n, joined(members, held, n)))
        elif n:
            stack.append((n, held))
        held = [p]
    return runs


def runs_of(docs: list[list[bytes]]) -> list[list[tuple[int, int, int]]]:
    """(start, length, period) of the runs of each list of words, by start, then period."""
    sizes = np.array([len(d) for d in docs], np.int64)
    codes = pd.factorize(np.array([w for d in docs for w in d], object))[0].astype(np.int64)
    first = np.cumsum(sizes) - sizes
    doc = np.repeat(np.arange(len(docs)), sizes)
    end = np.repeat(first + sizes, sizes)
    out: list[list[tuple[int, int, int]]] = [[] for _ in docs]
    if not len(codes):
        return out
    places, shared = suffix_order(codes, doc, end)
    left = np.concatenate([[-1], codes[:-1]])
    left[first[sizes > 0]] = -1
    for (start, length), period in maximal_pairs(places, shared, left.tolist()).items():
        d = int(doc[start])
        out[d].append((start - int(first[d]), length, period))
    for runs in out:
        runs.sort(key=lambda r: (r[0], r[2]))
    return out


def best_run(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run with the greatest length / period, compared exactly; ties go to
    the smaller start, then period."""
    best = None
    for r in runs:
        if best is None or (c := r[1] * best[2] - best[1] * r[2]) > 0 or (c == 0 and (r[0], r[2]) < (best[0], best[2])):
            best = r
    return best


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words that no run contains after its first period, joined by one space."""
    if runs:
        edge = np.zeros(len(words) + 1, np.int64)
        start, length, period = np.array(runs).T
        np.add.at(edge, start + period, 1)
        np.add.at(edge, start + length, -1)
        words = [words[i] for i in np.flatnonzero(np.cumsum(edge[:-1]) == 0).tolist()]
    return b" ".join(words)


RUN = T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")])
ADDED = [T.StructField("n_words", T.LongType()), T.StructField("runs", T.ArrayType(RUN)), T.StructField("best", RUN), T.StructField("collapsed", T.StringType())]


def find_runs(df: DataFrame, text: str = "text") -> DataFrame:
    """The columns of ``df`` except ``text``, and per row

    * ``n_words``: words (runs of characters other than space and 0x09-0x0D);
    * ``runs``: every run (start, length, period), in words, by start, then
      period: consecutive words whose smallest period is ``period``, of at least
      6 words and 4 periods, that no neighbouring word extends;
    * ``best``: the run with the greatest length / period (ties: smallest start,
      then period), null without runs;
    * ``collapsed``: the words left when every run is cut to its first period,
      joined by one space.

    A text is always taken whole, in one task; time is n log n in its words.
    Null and empty texts have no words and no runs. Rows are independent:
    repeated rows give repeated results, an empty table gives none. Columns of
    ``df`` named like an output column are replaced.
    """
    taken = {f.name.lower() for f in ADDED} | {text.lower()}
    keep = [f for f in df.schema.fields if f.name.lower() not in taken]
    schema = T.StructType([*keep, *ADDED])
    source = df.select(*[F.col(f"`{f.name}`") for f in keep], F.col(f"`{text}`").alias("text"))

    def triples(runs):
        flat = np.array(runs, np.int64).reshape(-1, 3)
        return pa.StructArray.from_arrays([pa.array(flat[:, k]) for k in range(3)], names=RUN.names)

    def run(batches):
        for batch in batches:
            for part in text_slices(batch, "text", 2 << 20):
                words = [words_of(t) for t in part.column("text").to_pylist()]
                found = runs_of(words)
                ends = np.cumsum([0, *map(len, found)])
                best = [best_run(r) for r in found]
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), triples([r for d in found for r in d]))
                tops = pa.array([None if b is None else dict(zip(RUN.names, b, strict=True)) for b in best], lists.type.value_type)
                texts = pa.array([collapsed(w, r).decode() for w, r in zip(words, found, strict=True)], pa.string())
                yield pa.RecordBatch.from_arrays([*[part.column(f.name) for f in keep], pa.array([len(w) for w in words], pa.int64()), lists, tops, texts], names=schema.names)

    return source.mapInArrow(run, schema)
