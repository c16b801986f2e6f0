"""Byte-level BPE by dynamic programming over prefixes.

Every prefix of a piece of text has exactly one encoding, hence one last token.
For each prefix, in order of length, the tokens that end there are read off a
suffix automaton of the vocabulary, longest first. A token is the last one of
the prefix if it may stand after the last token of what is left before it: the
two, merged on their own bytes, stay two. One stored token a prefix is enough
to emit the ids by following back-pointers. Time is proportional to the length
of the piece, whatever merges it holds, so pieces of any length take one path.

Main entry points: :func:`encode`, :func:`decode`, :func:`round_trip`.
"""

from __future__ import annotations

import functools
import json

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.bpe import _printable_bytes, decode_all
from tidemark.llm.common import text_slices

#: Encoded pieces kept a Python worker; only pieces of at most KEPT_BYTES are kept.
KEPT_PIECES, KEPT_BYTES = 400_000, 64
#: Answers of the pair test kept a Python worker.
KEPT_PAIRS = 1_000_000


class SuffixAutomaton:
    """Suffix automaton of a set of byte strings: ``step`` keeps the longest
    suffix of what was read that occurs in a string of the set.

    A whole string of the set is the longest member of its state, since at its
    own start nothing comes before it. So at state ``s`` with ``n`` bytes matched
    the strings that end here are that of ``s`` if ``n`` is the state's length,
    and those of the states up its suffix links (``up``: the nearest with one).
    """

    def __init__(self, strings: dict[bytes, int]):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length, self.string = [-1], [0], [-1]
        for s, number in strings.items():
            at = 0
            for c in s:
                at = self._extend(at, c)
            self.string[at] = number
        self.up = [-1] * len(self.link)
        for s in sorted(range(1, len(self.link)), key=self.length.__getitem__):
            above = self.link[s]
            self.up[s] = above if self.string[above] >= 0 else self.up[above]

    def _state(self, length: int, after: dict[int, int], link: int) -> int:
        self.next.append(after)
        self.link.append(link)
        self.length.append(length)
        self.string.append(-1)
        return len(self.link) - 1

    def _split(self, p: int, c: int, q: int) -> int:
        """A state for the members of ``q`` no longer than those of ``p`` and ``c``."""
        copy = self._state(self.length[p] + 1, dict(self.next[q]), self.link[q])
        self.link[q] = copy
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = copy
            p = self.link[p]
        return copy

    def _extend(self, p: int, c: int) -> int:
        q = self.next[p].get(c)
        if q is not None:
            return q if self.length[q] == self.length[p] + 1 else self._split(p, c, q)
        new = self._state(self.length[p] + 1, {}, 0)
        while p >= 0 and c not in self.next[p]:
            self.next[p][c] = new
            p = self.link[p]
        if p >= 0:
            q = self.next[p][c]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, c, q)
        return new


class PrefixEncoder:
    """Encodes texts with a tokenizer file (``.json``: vocabulary, merge list
    and added tokens).

    ``special``: strings of added tokens in a text become those tokens, as the
    file says; otherwise they are ordinary text. Raises ValueError for a merge
    list in which a token is not made later than its parts, or made twice: the
    pair test rests on that order.
    """

    def __init__(self, path: str, pattern: str, special: bool = True):
        with open(path, "rb") as f:
            spec = json.load(f)
        model, to_byte = spec["model"], _printable_bytes()
        vocabulary = model["vocab"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        added = {t["content"]: t for t in spec.get("added_tokens") or []}
        if special and any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in added.values()):
            raise ValueError(f"{path}: added tokens that strip or match whole words")
        self.added = {c: t["id"] for c, t in added.items()} if special else {}
        self.split = regex.compile("(" + "|".join(map(regex.escape, sorted(self.added, key=len, reverse=True))) + ")") if self.added else None
        self.pattern = regex.compile(pattern)
        ids = {bytes(to_byte[c] for c in t): i for t, i in vocabulary.items() if all(c in to_byte for c in t)}
        size = max([*vocabulary.values(), *(t["id"] for t in added.values())]) + 1
        self.tokens: list[bytes] = [b""] * size
        for t, i in ids.items():
            self.tokens[i] = t
        for c, t in added.items():
            self.tokens[t["id"]] = c.encode()
        self.size = size
        self.merge: dict[int, int] = {}  # left * size + right -> rank
        self.made, self.left, self.right = [-2] * size, [-1] * size, [-1] * size  # -1: a byte, -2: never made
        for b in range(256):
            self.made[ids[bytes([b])]] = -1
        usable = [ids[bytes([b])] for b in range(256)]
        for rank, (a, b) in enumerate(merges):
            x, y, whole = vocabulary[a], vocabulary[b], vocabulary[a + b]
            if self.made[whole] != -2 or -2 in (self.made[x], self.made[y]):
                raise ValueError(f"{path}: merge {rank} makes a token twice, or from parts not made before")
            self.merge[x * size + y] = rank
            self.made[whole], self.left[whole], self.right[whole] = rank, x, y
        valid = set(usable)
        for rank, (a, b) in enumerate(merges):  # tokens whose own bytes merge to themselves
            x, y = vocabulary[a], vocabulary[b]
            if x in valid and y in valid and self._built_apart(x, y):
                valid.add(vocabulary[a + b])
        self.automaton = SuffixAutomaton({self.tokens[i]: i for i in sorted(valid)})
        self.apart_memo: dict[int, bool] = {}
        self.kept: dict[str, bytes] = {}

    def _built_apart(self, a: int, b: int) -> bool:
        """True if no merge crosses the border while ``a`` and ``b`` are made
        side by side. Their merges are undone from the last one back; between
        two of them the tokens at the border are fixed, and would have merged if
        their pair came before the merge just undone. Of equal merges the one
        on the left goes first."""
        made, merge, size = self.made, self.merge, self.size
        at, bt = made[a], made[b]
        while at >= 0 or bt >= 0:
            if at > bt:
                limit, a = at, self.right[a]
                at = made[a]
            else:
                limit, b = bt + 1, self.left[b]
                bt = made[b]
            if merge.get(a * size + b, limit) < limit:
                return False
        return True

    def apart(self, a: int, b: int) -> bool:
        """True if the bytes of ``a`` and ``b``, merged together, give ``a, b``."""
        key = a * self.size + b
        known = self.apart_memo.get(key)
        if known is None:
            known = key not in self.merge and self._built_apart(a, b)
            if len(self.apart_memo) >= KEPT_PAIRS:
                self.apart_memo.clear()
            self.apart_memo[key] = known
        return known

    def encode_piece(self, piece: bytes) -> list[int]:
        a, tokens, apart, memo, size = self.automaton, self.tokens, self.apart, self.apart_memo, self.size
        after, link, length, string, up = a.next, a.link, a.length, a.string, a.up
        last = [-1] * (len(piece) + 1)  # the last token of each prefix
        state = matched = 0
        for end, c in enumerate(piece, 1):
            to = after[state].get(c)
            while to is None:
                state = link[state]
                matched = length[state]
                to = after[state].get(c)
            state, matched = to, matched + 1
            at = state if matched == length[state] and string[state] >= 0 else up[state]
            while True:
                token, start = string[at], end - length[at]
                if not start:
                    break
                known = memo.get(last[start] * size + token)
                if apart(last[start], token) if known is None else known:
                    break
                at = up[at]
            last[end] = token
        out, end = [], len(piece)
        while end:
            out.append(last[end])
            end -= len(tokens[last[end]])
        return out[::-1]

    def _plain(self, text: str) -> list[bytes]:
        kept = self.kept
        pieces = self.pattern.findall(text)
        ids = list(map(kept.get, pieces))
        if None in ids:
            new: dict[str, bytes] = {}
            for i, piece in enumerate(pieces):
                if ids[i] is None:
                    if piece not in new:
                        raw = piece.encode()
                        new[piece] = np.array(self.encode_piece(raw), "<u4").tobytes()
                        if len(raw) <= KEPT_BYTES and len(kept) < KEPT_PIECES:
                            kept[piece] = new[piece]
                    ids[i] = new[piece]
        return ids

    def encode(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids of a text."""
        if self.split is None:
            return b"".join(self._plain(text))
        out: list[bytes] = []
        for k, part in enumerate(self.split.split(text)):
            if k % 2:
                out.append(np.array([self.added[part]], "<u4").tobytes())
            elif part:
                out += self._plain(part)
        return b"".join(out)


@functools.lru_cache(maxsize=2)
def encoder(path: str, pattern: str, special: bool = True) -> PrefixEncoder:
    return PrefixEncoder(path, pattern, special)


def _with(df: DataFrame, *added: T.StructField) -> tuple[list[str], T.StructType]:
    """Columns of ``df`` that stay, and the schema with ``added`` at its end."""
    taken = {f.name.lower() for f in added}
    keep = [f for f in df.schema.fields if f.name.lower() not in taken]
    return [f.name for f in keep], T.StructType([*keep, *added])


def _lists(rows: list[bytes]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, rows)]) // 4
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(rows), "<i4")))


def _strings(enc: PrefixEncoder, rows: list[bytes]) -> pa.Array:
    texts = decode_all(enc.tokens, rows)
    return pa.array([t.decode("utf-8", "replace") for t in texts], pa.string())


IDS = T.ArrayType(T.IntegerType())


def encode(df: DataFrame, path: str, pattern: str, text: str = "text", ids: str = "token_ids", special: bool = True) -> DataFrame:
    """``df`` with column ``ids`` (array of int): the ids of the whole text.
    ``path`` names a tokenizer file that every executor has. Null and empty
    texts have no ids. A text is never cut: pieces of any length are encoded by
    the same pass. Rows are independent, so repeated rows give repeated results
    and an empty table an empty one. Extra columns pass through; an existing
    column ``ids`` is replaced."""
    keep, schema = _with(df, T.StructField(ids, IDS))

    def run(batches):
        enc = encoder(path, pattern, special)
        for batch in batches:
            for part in text_slices(batch, text):
                coded = [enc.encode(t or "") for t in part.column(text).to_pylist()]
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in keep], _lists(coded)], names=schema.names)

    return df.mapInArrow(run, schema)


def decode(df: DataFrame, path: str, pattern: str, ids: str = "token_ids", out: str = "decoded") -> DataFrame:
    """``df`` with string column ``out``: the text of the ids, strings of added
    tokens included; bytes that are no UTF-8 become U+FFFD (null: empty). An id
    outside the vocabulary is an error. An existing column ``out`` is replaced."""
    keep, schema = _with(df, T.StructField(out, T.StringType()))

    def run(batches):
        enc = encoder(path, pattern)
        for batch in batches:
            coded = [np.array(x or [], "<u4").tobytes() for x in batch.column(ids).to_pylist()]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], _strings(enc, coded)], names=schema.names)

    return df.mapInArrow(run, schema)


def round_trip(df: DataFrame, path: str, pattern: str, text: str = "text", ids: str = "token_ids", out: str = "decoded", special: bool = True) -> DataFrame:
    """``decode(encode(df))`` in one pass over the text, with the same columns
    and the same results for null, empty, repeated and very long texts."""
    keep, schema = _with(df, T.StructField(ids, IDS), T.StructField(out, T.StringType()))

    def run(batches):
        enc = encoder(path, pattern, special)
        for batch in batches:
            for part in text_slices(batch, text):
                coded = [enc.encode(t or "") for t in part.column(text).to_pylist()]
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in keep], _lists(coded), _strings(enc, coded)], names=schema.names)

    return df.mapInArrow(run, schema)


def digests(df: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (decimal ids joined by commas) and
    decoded_sha256 of every row of ``df`` (doc_id, text, others are ignored)."""
    both = round_trip(df.select("doc_id", "text"), path, pattern)
    return both.select("doc_id", F.size("token_ids").cast("long").alias("n_tokens"),
                       F.sha2(F.concat_ws(",", F.col("token_ids").cast("array<string>")), 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))
