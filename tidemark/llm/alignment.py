"""Alignment of two tokenizers over a corpus, each distinct text once.

Rows are shuffled by their full text and counted; each distinct text is encoded
by both tokenizers and aligned by the byte offsets where their tokens end. A
pair of ids is linked wherever a token of the one overlaps a token of the other;
its corpus count weighs every text's links by the text's copies.

Distinct texts are worked on in slices of a bounded number of bytes. A slice
sums its pairs before anything is shuffled, so the pair counts are added up from
one row a slice and pair, and go back to the slice the same way: no text is
joined with the table of counts, and no table of counts is sent to every task.
The measures of a text are joined to its rows by its SHA-256.

Main entry point: :func:`align`.
"""

from __future__ import annotations

import functools
import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.bpe import encoder
from tidemark.llm.common import cut, small_batches, text_slices

#: Bytes of distinct text in a slice (one text at least).
SLICE_BYTES = 2 << 20
#: Bytes of text encoded in one call.
ENCODED_BYTES = 1 << 18
MEASURES = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")


class Pair:
    """Both tokenizers, the bytes of their tokens and the strings of their ids."""

    def __init__(self, path_a: str, pattern_a: str, path_b: str):
        import sentencepiece

        self.a, self.b = encoder(path_a, pattern_a), sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.bytes_a = self.a.vocabulary.tokens
        size = len(self.bytes_a)
        self.bytes_b = []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            self.bytes_b.append(bytes([int(piece[1:-1], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode())
        self.length_a, self.length_b = (np.array([len(x) for x in t], np.int32) for t in (self.bytes_a, self.bytes_b))
        # every id as text, with the sign that follows it: 0 within a side, 1 at the side's end
        self.strings = [f"{i}{sign}".encode() for n, end in ((size, "|"), (len(self.bytes_b), ";")) for sign in (",", end) for i in range(n)]

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Ids of each text by A (behind a space) and by B; none where the
        tokens' bytes are not the text behind a space."""
        none = np.zeros(0, np.int32)
        spaced, out = [" " + t for t in texts], []
        for text, one, two in zip(spaced, self.a.encode(spaced), self.b.encode(texts, num_threads=1), strict=True):
            raw, ids = text.encode(), np.frombuffer(one, "<i4")
            same = b"".join(map(self.bytes_a.__getitem__, ids.tolist())) == raw == b"".join(map(self.bytes_b.__getitem__, two))
            out.append((ids, np.array(two, np.int32)) if same else (none, none))
        return out


@functools.lru_cache(maxsize=2)
def tokenizer_pair(path_a: str, pattern_a: str, path_b: str) -> Pair:
    return Pair(path_a, pattern_a, path_b)


def _before(mark: np.ndarray) -> np.ndarray:
    """How many marks lie before each place."""
    n = np.cumsum(mark, dtype=np.int32 if len(mark) < 1 << 31 else np.int64)
    n -= mark
    return n


class Slice:
    """The alignment of some texts, all at once on one line of bytes. A text
    boundary is an end of both tokenizers, so no group or link crosses it."""

    def __init__(self, pair: Pair, ids: list[tuple[np.ndarray, np.ndarray]]):
        none = [np.zeros(0, np.int32)]
        self.n_a, self.n_b = (np.array([len(x[k]) for x in ids], np.int64) for k in (0, 1))
        self.a, self.b = (np.concatenate([x[k] for x in ids] or none) for k in (0, 1))
        self.pair, self.end_a, self.end_b = pair, np.cumsum(pair.length_a[self.a], dtype=np.int64), np.cumsum(pair.length_b[self.b], dtype=np.int64)
        total = int(self.end_a[-1]) if len(self.end_a) else 0
        at_a, at_b = np.zeros(total + 1, bool), np.zeros(total + 1, bool)
        at_a[self.end_a], at_b[self.end_b] = True, True
        self.before_a, self.before_b = _before(at_a), _before(at_b)
        self.both = at_a & at_b
        # each stretch between neighbouring ends lies in one token of each side: one link
        link = np.flatnonzero(at_a | at_b)
        self.codes = (self.b[self.before_b[link]].astype(np.int64) << 32) | self.a[self.before_a[link]]
        last = np.concatenate([[0], np.cumsum(self.n_a)])
        edge = np.concatenate([[0], self.end_a])[last]  # where each text begins and ends
        self.link_text = np.repeat(np.arange(len(ids)), np.diff(np.searchsorted(link, edge, "right")))
        self.n_links = np.bincount(self.link_text, minlength=len(ids))
        self.n_groups = np.diff(np.searchsorted(np.flatnonzero(self.both), edge, "right"))

    def groups(self) -> list[bytes]:
        """``a1,a2|b1;a3|b2,b3`` of every text, empty without tokens."""
        before = _before(self.both)
        ends = np.flatnonzero(self.both)
        group_a, group_b = before[self.end_a], before[self.end_b]
        b_before = np.concatenate([[0], self.before_b[ends] + 1])  # B tokens up to the end of the group before
        a_until = self.before_a[ends] + 1
        place_a = np.arange(len(self.a)) + b_before[group_a]
        place_b = np.arange(len(self.b)) + a_until[group_b]
        which = np.empty(len(self.a) + len(self.b), np.int64)
        size_a, size_b = len(self.pair.bytes_a), len(self.pair.bytes_b)
        which[place_a] = self.a + size_a * self.both[self.end_a]
        which[place_b] = self.b + 2 * size_a + size_b * self.both[self.end_b]
        parts = list(map(self.pair.strings.__getitem__, which.tolist()))
        marks = np.concatenate([[0], np.cumsum(self.n_a + self.n_b)]).tolist()
        return [b"".join(parts[a:b])[:-1] for a, b in zip(marks, marks[1:], strict=False)]

    def sums(self, copies: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
        """The slice's pairs, each with its links times the copies of their
        text, and per text its pairs (places in that list) with their links."""
        pairs, place = np.unique(self.codes, return_inverse=True)
        total = np.zeros(len(pairs), np.int64)
        np.add.at(total, place, copies[self.link_text])
        keys, count = np.unique(self.link_text * max(1, len(pairs)) + place, return_counts=True)
        text, which = np.divmod(keys, max(1, len(pairs)))
        marks = np.searchsorted(text, np.arange(len(self.n_a) + 1))
        rows = np.stack([which, count]).astype("<u4")
        return pairs, total, [rows[:, a:b].tobytes() for a, b in zip(marks, marks[1:], strict=False)]


TEXTS = "slice long, key string, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, groups string, links binary, pairs array<long>, sums array<long>"


def _squeeze(raw: bytes) -> bytes:
    """Length and compressed bytes of a text's pairs."""
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def _spread(packed: bytes) -> np.ndarray:
    raw = pa.decompress(packed[8:], int.from_bytes(packed[:8], "little"), codec="zstd", asbytes=True)
    return np.frombuffer(raw, "<u4").reshape(2, -1)


def align_distinct(texts: DataFrame, path_a: str, pattern_a: str, path_b: str, keep_groups: bool) -> DataFrame:
    """Rows of :data:`TEXTS` from distinct (text, copies, key): one a text, and
    one a slice with the slice's pairs (key null)."""
    schema = T._parse_datatype_string(TEXTS)
    types = [pa.int64(), pa.string(), *[pa.int64()] * 4, pa.string(), pa.string(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64())]

    def run(batches):
        pair = tokenizer_pair(path_a, pattern_a, path_b)
        number, held, size = TaskContext.get().partitionId() << 32, [], 0

        def finish():
            keys, copies = [k for x in held for k in x[0]], np.array([c for x in held for c in x[1]], np.int64)
            done = Slice(pair, [i for x in held for i in x[2]])
            groups = done.groups()
            pairs, total, links = done.sums(copies)
            hashes = [hashlib.sha256(g).hexdigest() if g else "" for g in groups]
            n = len(keys)
            rows = [[number] * n, keys, done.n_a, done.n_b, done.n_groups, done.n_links, hashes,
                    [g.decode() for g in groups] if keep_groups else [None] * n, list(map(_squeeze, links)), [None] * n, [None] * n]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows, types, strict=True)], names=schema.names)
            rows = [[number], *[[None]] * 8, [pairs], [total]]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows, types, strict=True)], names=schema.names)

        for batch in batches:
            for part in text_slices(batch, "text", ENCODED_BYTES):
                raw = part.column("text").to_pylist()
                held.append((part.column("key").to_pylist(), part.column("copies").to_pylist(), pair.encode(raw)))
                size += sum(map(len, raw))
                if size >= SLICE_BYTES:
                    yield from finish()
                    number, held, size = number + 1, [], 0
        if held:
            yield from finish()

    return texts.mapInArrow(run, schema)


def _measured(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
    """A slice's texts with ``n_best`` and ``count_sum``, from its pairs' counts."""
    order = right["place"].to_numpy(np.int64)
    total, best = np.zeros(len(order), np.int64), np.zeros(len(order), np.int64)
    total[order], best[order] = right["total"].to_numpy(np.int64), right["best"].to_numpy(np.int64)
    out = left.drop(columns=["links", "slice"])
    rows = [_spread(x).astype(np.int64) for x in left["links"]]
    out["n_best"] = [int((best[w] * n).sum()) for w, n in rows]
    out["count_sum"] = [int((total[w] * n).sum()) for w, n in rows]
    return out


def align(df: DataFrame, path_a: str, pattern_a: str, path_b: str, text: str = "text", keep_groups: bool = False) -> DataFrame:
    """The columns of ``df`` except ``text``, and per row

    * ``n_a``, ``n_b``: tokens of the text behind a space by the tokenizer file
      ``path_a`` with split pattern ``pattern_a``, and of the text by the SentencePiece model ``path_b`` (which
      adds that space); special-token strings in a text are plain text;
    * ``n_groups``: groups cut at byte offsets where tokens of both end;
    * ``n_links``: pairs of token occurrences that overlap;
    * ``n_best``: links whose pair count is the highest of their B id, ties
      included; ``count_sum``: the sum of the links' pair counts. A pair's count
      is the number of its links in all rows of ``df``;
    * ``groups_sha256`` of ``a1,a2|b1;a3|b2,b3``, and that string itself as
      ``groups`` with ``keep_groups``.

    Texts that are null, empty, or not reproduced by the bytes of both
    tokenizers' tokens have no tokens: zeros and an empty string. Repeated texts
    are aligned once and count as often as they occur. A very long text is a
    slice of its own. An empty table gives no rows. Columns of ``df`` named like
    an output column are replaced. Both files must be readable on executors.
    """
    made = [*MEASURES, "groups_sha256", *(["groups"] if keep_groups else [])]
    taken = {n.lower() for n in [*made, text]}
    keep = [c for c in df.columns if c.lower() not in taken]
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in keep] or [F.lit(0)]).alias("row"), F.col(f"`{text}`").alias("text"))
    some = F.coalesce(F.col("text") != "", F.lit(False))
    distinct = rows.where(some).groupBy("text").agg(F.count("*").alias("copies"))
    with small_batches(df.sparkSession):
        done = cut(align_distinct(distinct.select("text", "copies", F.sha2("text", 256).alias("key")), path_a, pattern_a, path_b, keep_groups), "aligned")
    pairs = done.where("pairs IS NOT NULL").select("slice", F.posexplode(F.arrays_zip("pairs", "sums")).alias("place", "p"))
    pairs = pairs.select("slice", "place", F.col("p.pairs").alias("code"), F.col("p.sums").alias("links"))
    counts = cut(pairs.groupBy("code").agg(F.sum("links").alias("total")), "pair-counts")
    of_b = F.shiftright("code", 32).alias("b")
    high = counts.groupBy(of_b).agg(F.max("total").alias("high"))
    counts = cut(counts.withColumn("b", of_b).join(high, "b").select("code", "total", (F.col("total") == F.col("high")).cast("int").alias("best")), "pair-best")
    known = pairs.select("slice", "place", "code").join(counts, "code").select(F.col("slice").alias("of"), "place", "total", "best")
    texts = done.where("key IS NOT NULL").select("slice", "key", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", *(["groups"] if keep_groups else []), "links")
    out = "key string, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, " + ("groups string, " if keep_groups else "") + "n_best long, count_sum long"
    measured = texts.groupBy("slice").cogroup(known.groupBy("of")).applyInPandas(_measured, out)
    found = rows.where(some).select("row", F.sha2("text", 256).alias("key")).join(measured, "key")
    nothing = [F.lit("").alias(c) if c.startswith("groups") else F.lit(0).cast("long").alias(c) for c in made]
    empty = rows.where(~some).select("row", *nothing)
    both = found.select("row", *made).union(empty)
    return both.select(*[F.col(f"row.`{c}`").alias(c) for c in keep], *made)
