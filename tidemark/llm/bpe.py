"""Byte-level BPE encoding and decoding.

Pieces of text (matches of a split pattern) are encoded many at a time: pieces
of similar byte length form one padded matrix of token ids, and in each round
every row merges its leftmost minimum-rank pair. A merge only changes the two
neighbouring pairs, so a round makes two lookups a row in a hash table of pairs
and compacts the row by one column; rows with nothing left to merge leave the
matrix. Encoded pieces are kept in a bounded table per Python worker.

Main entry points: :func:`encode`, :func:`decode`.
"""

from __future__ import annotations

import base64
import functools
import heapq
import json
import re

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import text_slices

NO_RANK = np.int32(2**31 - 1)
#: Pieces longer than this are merged with a heap: a matrix row costs its length squared.
LONG_PIECE = 1024
#: Cells of one padded matrix.
MATRIX_CELLS = 1 << 20
#: Encoded chunks kept per Python worker; later chunks are encoded again.
KEPT_CHUNKS = 500_000


class PairTable:
    """Hash table from a pair of token ids to (rank, merged id); open
    addressing, built and probed with whole arrays."""

    def __init__(self, left: np.ndarray, right: np.ndarray, rank: np.ndarray, merged: np.ndarray):
        self.bits = max(8, int(np.ceil(np.log2(max(1, len(left)) * 4))))
        size = 1 << self.bits
        self.keys = np.full(size, np.uint64(2**64 - 1))
        self.rank = np.full(size, NO_RANK)
        self.merged = np.zeros(size, np.int32)
        keys = self._key(left, right)
        todo, slot = np.arange(len(keys)), self._slot(keys)
        while len(todo):
            free = self.keys[slot] == np.uint64(2**64 - 1)
            at, first = np.unique(slot[free], return_index=True)
            won = todo[free][first]
            self.keys[at], self.rank[at], self.merged[at] = keys[won], rank[won], merged[won]
            left_over = np.ones(len(todo), bool)
            left_over[np.flatnonzero(free)[first]] = False
            todo, slot = todo[left_over], (slot[left_over] + 1) & (size - 1)

    @staticmethod
    def _key(left, right):
        return (left.astype(np.uint64) << np.uint64(32)) | right.astype(np.uint64)

    def _slot(self, keys):
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def lookup(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rank, merged id) of each pair; rank NO_RANK where there is none."""
        keys = self._key(left, right)
        slot = self._slot(keys)
        seen = self.keys[slot]
        open_ = np.flatnonzero((seen != keys) & (seen != np.uint64(2**64 - 1)))
        while len(open_):
            slot[open_] = (slot[open_] + 1) & ((1 << self.bits) - 1)
            seen = self.keys[slot[open_]]
            open_ = open_[(seen != keys[open_]) & (seen != np.uint64(2**64 - 1))]
        hit = self.keys[slot] == keys
        return np.where(hit, self.rank[slot], NO_RANK), self.merged[slot]


class Vocabulary:
    """Token bytes by id, the pair table, and tokens that a whole piece takes
    without merging (``whole``: rank files only)."""

    def __init__(self, tokens: dict[bytes, int], pairs, whole: bool):
        self.tokens = [b""] * (max(tokens.values()) + 1)
        for t, i in tokens.items():
            self.tokens[i] = t
        self.byte_ids = np.array([tokens[bytes([b])] for b in range(256)], np.int32)
        self.whole = tokens if whole else {}
        left, right, rank, merged = (np.array(x, np.int64) for x in zip(*pairs, strict=True))
        self.pairs = PairTable(left, right, rank.astype(np.int32), merged.astype(np.int32))


def _printable_bytes() -> dict[str, int]:
    """The published byte-to-character rule of byte-level vocabularies: visible
    Latin-1 characters stand for themselves, the others follow from U+0100."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(visible)]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}


@functools.lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    """From a rank file (``.tiktoken``: base64 token and rank a line; a pair's
    rank is that of its joined bytes) or a tokenizer file (``.json``: vocabulary
    and merge list)."""
    with open(path, "rb") as f:
        if not path.endswith(".json"):
            tokens = {base64.b64decode(t): int(r) for t, r in map(bytes.split, f.read().splitlines())}
            pairs = [(tokens[t[:i]], tokens[t[i:]], r, r) for t, r in tokens.items()
                     for i in range(1, len(t)) if t[:i] in tokens and t[i:] in tokens]
            return Vocabulary(tokens, pairs, whole=True)
        model = json.load(f)["model"]
    to_byte = _printable_bytes()
    raw = {t: bytes(to_byte[c] for c in t) for t in model["vocab"] if all(c in to_byte for c in t)}
    tokens = {raw[t]: i for t, i in model["vocab"].items() if t in raw}
    merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    pairs = [(model["vocab"][a], model["vocab"][b], k, model["vocab"][a + b]) for k, (a, b) in enumerate(merges)]
    return Vocabulary(tokens, pairs, whole=False)


def merge_rows(ids: np.ndarray, lengths: np.ndarray, pairs: PairTable) -> list[bytes]:
    """Merge every row of a padded id matrix to its end; returns the rows as
    little-endian unsigned 32-bit ids."""
    n, width = ids.shape
    out: list = [None] * n
    row = np.arange(n)
    rank = np.full((n, max(1, width - 1)), NO_RANK)
    if width > 1:
        got, _ = pairs.lookup(ids[:, :-1].ravel(), ids[:, 1:].ravel())
        inside = np.arange(width - 1)[None, :] < (lengths - 1)[:, None]
        rank = np.where(inside, got.reshape(n, width - 1), NO_RANK)
    while len(row):
        at = rank.argmin(1)
        here = np.arange(len(row))
        done = rank[here, at] == NO_RANK
        if done.any():
            ended = ids[done].astype("<u4", copy=False)
            raw, step = ended.tobytes(), 4 * ended.shape[1]
            for k, (i, n) in enumerate(zip(row[done].tolist(), lengths[done].tolist(), strict=True)):
                out[i] = raw[k * step : k * step + 4 * n]
            keep = ~done
            ids, rank, lengths, row, at = ids[keep], rank[keep], lengths[keep], row[keep], at[keep]
            if not len(row):
                break
            here = np.arange(len(row))
        _, joined = pairs.lookup(ids[here, at], ids[here, at + 1])
        ids[here, at] = joined
        cols = np.arange(ids.shape[1] - 1)[None, :]
        ids = np.take_along_axis(ids, cols + (cols > at[:, None]), 1)
        lengths = lengths - 1
        if ids.shape[1] == 1:
            rank = np.full((len(row), 1), NO_RANK)
            continue
        cols = cols[:, :-1]
        rank = np.take_along_axis(rank, cols + (cols >= at[:, None]), 1)
        for p in (at - 1, at):  # the pairs beside the merged token
            ok = np.flatnonzero((p >= 0) & (p < lengths - 1))
            if len(ok):
                rank[ok, p[ok]], _ = pairs.lookup(ids[ok, p[ok]], ids[ok, p[ok] + 1])
        tail = lengths - 1
        short = np.flatnonzero(tail < rank.shape[1])
        rank[short, tail[short]] = NO_RANK
    return out


def merge_long(ids: list[int], pairs: dict) -> np.ndarray:
    """The same merges for one long piece, with a heap over a linked list."""
    n = len(ids)
    nxt, prv = [*range(1, n), -1], [-1, *range(n - 1)]
    heap = [(*p, i, ids[i], ids[i + 1]) for i in range(n - 1) if (p := pairs.get((ids[i], ids[i + 1])))]
    heap = [(rank, i, merged, a, b) for rank, merged, i, a, b in heap]
    heapq.heapify(heap)
    while heap:
        _, i, merged, a, b = heapq.heappop(heap)
        j = nxt[i]
        if ids[i] != a or j < 0 or ids[j] != b:
            continue
        ids[i], ids[j], nxt[i] = merged, -1, nxt[j]
        if nxt[j] >= 0:
            prv[nxt[j]] = i
        for k in (prv[i], i):
            if k >= 0 and nxt[k] >= 0 and (p := pairs.get((ids[k], ids[nxt[k]]))):
                heapq.heappush(heap, (p[0], k, p[1], ids[k], ids[nxt[k]]))
    return np.array([x for x in ids if x >= 0], np.int32)


class Encoder:
    """Encodes texts to little-endian unsigned 32-bit ids."""

    #: A space next to other white space, where splitting at spaces would differ from the pattern.
    ODD_SPACE = re.compile(r"\s (?:\s|\Z)")

    def __init__(self, path: str, pattern: str):
        self.vocabulary = vocabulary(path)
        self.pattern = regex.compile(pattern)
        self.kept: dict[str, bytes] = {}

    @functools.cached_property
    def pair_dict(self) -> dict:
        t = self.vocabulary.pairs
        at = np.flatnonzero(t.rank != NO_RANK)
        keys = t.keys[at]
        return dict(zip(zip((keys >> np.uint64(32)).tolist(), (keys & np.uint64(2**32 - 1)).tolist(), strict=True),
                        zip(t.rank[at].tolist(), t.merged[at].tolist(), strict=True), strict=True))

    def encode_pieces(self, pieces: list[bytes]) -> list[bytes]:
        v, out = self.vocabulary, [b""] * len(pieces)
        todo = []
        for i, p in enumerate(pieces):
            if (whole := v.whole.get(p)) is not None:
                out[i] = np.uint32(whole).tobytes()
            elif len(p) > LONG_PIECE:
                ids = v.byte_ids[np.frombuffer(p, np.uint8)].tolist()
                out[i] = merge_long(ids, self.pair_dict).astype("<u4").tobytes()
            elif p:
                todo.append(i)
        size = np.array([len(pieces[i]) for i in todo])
        order = np.argsort(size, kind="stable")
        todo, size = np.array(todo)[order], size[order]
        start = 0
        while start < len(todo):  # neighbours in length share a matrix
            low = int(size[start])
            end = min(int(np.searchsorted(size, low + max(1, low // 4), "right")), start + max(1, MATRIX_CELLS // low))
            part, lengths, width = todo[start:end].tolist(), size[start:end], int(size[end - 1])
            raw = np.frombuffer(b"".join([pieces[i].ljust(width, b"\0") for i in part]), np.uint8).reshape(len(part), width)
            for i, ids in zip(part, merge_rows(v.byte_ids[raw], lengths, v.pairs), strict=True):
                out[i] = ids
            start = end
        return out

    def encode_chunks(self, chunks: list[str]) -> list[bytes]:
        """Ids of each chunk; a space and letters is one piece as it stands."""
        split = []
        for c in chunks:
            if c[:1] != " ":
                split.append(self.pattern.findall(c))
            elif c[1:].isalpha():
                split.append([c])
            elif c[1:-1].isalpha() and c[-1] in ".,":
                split.append([c[:-1], c[-1]])
            else:
                split.append(self.pattern.findall(c))
        ids = {p: self.kept.get(p[1:]) if p[0] == " " else None for s in split for p in s}
        new = [p for p, x in ids.items() if x is None]
        ids.update(zip(new, self.encode_pieces([p.encode() for p in new]), strict=True))
        return [ids[s[0]] if len(s) == 1 else b"".join([ids[p] for p in s]) for s in split]

    def encode(self, texts: list[str]) -> list[bytes]:
        """A space after a character that is no white space always begins a
        piece, so texts are cut there and each distinct chunk is encoded once.
        A chunk's key is its text after that space, or ``\\n `` and its whole
        text where no space was cut off."""
        keys, ends = [], [0]
        for t in texts:
            if self.ODD_SPACE.search(t):
                keys += ["\n " + p for p in self.pattern.findall(t)]
            elif t:
                own = t.split(" ")
                own[0] = "\n " + own[0]
                keys += own
            ends.append(len(keys))
        kept = self.kept
        ids = list(map(kept.get, keys))
        missing = [i for i, x in enumerate(ids) if x is None]
        if missing:
            new = list({keys[i] for i in missing})
            coded = dict(zip(new, self.encode_chunks([k[2:] if k[:2] == "\n " else " " + k for k in new]), strict=True))
            for i in missing:
                ids[i] = coded[keys[i]]
            if len(kept) < KEPT_CHUNKS:  # what comes first stays: frequent chunks come early
                kept.update(coded)
        return [b"".join(ids[a:b]) for a, b in zip(ends, ends[1:], strict=False)]


@functools.lru_cache(maxsize=4)
def encoder(path: str, pattern: str) -> Encoder:
    return Encoder(path, pattern)


def _with_binary(schema: T.StructType, name: str) -> T.StructType:
    return T.StructType([f for f in schema.fields if f.name.lower() != name.lower()] + [T.StructField(name, T.BinaryType())])


def add_binary(df: DataFrame, source: str, name: str, make) -> DataFrame:
    """``df`` with binary column ``name`` = ``make(list of values)`` of column
    ``source``, a slice of a record batch at a time. A column that already has
    that name is replaced."""
    schema = _with_binary(df.schema, name)
    keep = schema.names[:-1]

    def run(batches):
        call = make()
        for batch in batches:
            for part in text_slices(batch, source):
                values = pa.array(call(part.column(source).to_pylist()), pa.binary())
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in keep], values], names=schema.names)

    return df.mapInArrow(run, schema)


def decode_all(tokens: list[bytes], rows: list[bytes | None]) -> list[bytes]:
    return [b"".join(map(tokens.__getitem__, np.frombuffer(r, "<u4").tolist())) if r else b"" for r in rows]


def encode(df: DataFrame, path: str, pattern: str, text: str = "text", ids: str = "token_ids") -> DataFrame:
    """``df`` with column ``ids``: the token ids of the whole text as
    little-endian unsigned 32-bit integers. ``path`` names a vocabulary file
    that every executor has; null and empty texts have no ids. Special-token
    strings in a text are ordinary text. Extra columns pass through; an
    existing column ``ids`` is replaced. Rows are independent, so repeated
    rows give repeated results and an empty table an empty one."""

    def make():
        enc = encoder(path, pattern)
        return lambda texts: enc.encode([t or "" for t in texts])

    return add_binary(df, text, ids, make)


def decode(df: DataFrame, path: str, ids: str = "token_ids", out: str = "decoded") -> DataFrame:
    """``df`` with binary column ``out``: the bytes of the ids (null: empty).
    An id outside the vocabulary is an error."""

    def make():
        tokens = vocabulary(path).tokens
        return lambda rows: decode_all(tokens, rows)

    return add_binary(df, ids, out, make)


def round_trip(df: DataFrame, path: str, pattern: str, text: str = "text", ids: str = "token_ids", out: str = "decoded") -> DataFrame:
    """``decode(encode(df))`` in one pass over the text."""
    schema = _with_binary(_with_binary(df.schema, ids), out)
    keep = schema.names[:-2]

    def run(batches):
        enc = encoder(path, pattern)
        for batch in batches:
            for part in text_slices(batch, text):
                coded = enc.encode([t or "" for t in part.column(text).to_pylist()])
                both = [pa.array(x, pa.binary()) for x in (coded, decode_all(enc.vocabulary.tokens, coded))]
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in keep], *both], names=schema.names)

    return df.mapInArrow(run, schema)


def digests(df: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every document."""
    both = round_trip(df.select("doc_id", "text"), path, pattern)
    return both.select("doc_id", F.expr("length(token_ids) div 4").cast("long").alias("n_tokens"),
                       F.sha2("token_ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
