"""Packing of tokenised documents into windows of a fixed capacity.

Full windows are cut off a document first. What remains is cut into a few
near-equal pieces, and the pieces of a block of documents are spread over
windows by Karmarkar-Karp multiway differencing: every piece starts as a
partial partition over all windows, and the two partial partitions with the
largest imbalance are merged largest bin on smallest bin, so that opposing
imbalances cancel. The block takes the fewest windows its tokens can fill; when
the largest bin would exceed the capacity, the window count rises by one.
"""

from __future__ import annotations

import heapq
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.bpe import encoder
from tidemark.llm.common import text_slices


def difference(sizes: list[int], windows: int) -> list[tuple[int, list[int]]]:
    """Karmarkar-Karp: (sum, item numbers) of ``windows`` bins with near-equal
    sums. A partial partition keeps only its used bins; the rest are empty."""
    heap = [(-n, i, [(n, [i])]) for i, n in enumerate(sizes)]
    heapq.heapify(heap)
    order = len(sizes)
    while len(heap) > 1:
        (_, _, a), (_, _, b) = heapq.heappop(heap), heapq.heappop(heap)
        free = windows - len(a)
        # b's smallest bins go to a's largest; b's largest go to a's empty bins
        a.sort(key=lambda x: -x[0])
        b.sort(key=lambda x: -x[0])
        into, rest = b[:free], b[free:]
        merged = [(x[0] + y[0], x[1] + y[1]) for x, y in zip(a[len(a) - len(rest):], reversed(rest), strict=True)]
        bins = a[: len(a) - len(rest)] + merged + into
        low = min(x[0] for x in bins) if len(bins) == windows else 0
        heapq.heappush(heap, (low - max(x[0] for x in bins), order, bins))
        order += 1
    return heap[0][2] if heap else []


def pack_block(sizes: list[int], capacity: int) -> list[list[int]]:
    """Windows (item numbers) of at most ``capacity`` for items of at most ``capacity``."""
    windows = max(1, -(-sum(sizes) // capacity))
    while True:
        bins = difference(sizes, windows)
        if max((x[0] for x in bins), default=0) <= capacity:
            return [x[1] for x in bins]
        windows += 1


PIECES = T.StructType([
    T.StructField("start", T.LongType()), T.StructField("length", T.LongType()), T.StructField("ids_crc32", T.LongType()),
    T.StructField("doc_tokens", T.LongType()), T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType()),
    T.StructField("sequence_tokens", T.LongType()), T.StructField("padded_to", T.LongType())])


def pack(df: DataFrame, path: str, pattern: str, end_id: int = 0, capacity: int = 1024, cut: int = 256, block: int = 512,
         text: str = "text", ids: str | None = None) -> DataFrame:
    """One row a piece: the columns of ``df`` except ``text``, the piece's start
    and length in its document, the CRC-32 of its little-endian unsigned 32-bit
    ids, the document's tokens (with the final ``end_id``), the sequence and the
    place there, gapless from 0.

    A document is cut into full windows and a remainder of near-equal pieces of
    at most ``cut`` tokens; ``block`` such pieces are spread at once. Every
    partition packs on its own, so nothing is shuffled; a partition's last block
    may leave part of a window empty. A sequence id is the partition number and
    a count, so it depends on the partitioning of ``df``. A sequence is padded
    to ``capacity``, except when its length is a power of two (``padded_to``).
    With ``ids``, a binary column of that name holds the piece's ids. Null and
    empty texts are one token, ``end_id``. Repeated rows are packed each; an
    empty table gives no rows. Columns of ``df`` named like an output column are
    replaced by it.
    """
    tail = T.StructType(PIECES.fields + ([T.StructField(ids, T.BinaryType())] if ids else []))
    taken = {n.lower() for n in tail.names} | {text.lower()}
    keep = [f for f in df.schema.fields if f.name.lower() not in taken]
    source = df.select(*[F.col(f"`{f.name}`") for f in keep], F.col(f"`{text}`").alias("text"))
    schema = T.StructType(keep + tail.fields)
    end = np.array([end_id], "<u4").tobytes()

    def run(batches):
        enc = encoder(path, pattern)
        base = TaskContext.get().partitionId() << 33
        made = 0
        held: list = []  # remainder pieces waiting for a full block: (row, piece)

        def place(pieces):
            nonlocal made
            at = [None] * len(pieces)
            for window in pack_block([p[2] for p in pieces], capacity):
                total, offset = sum(pieces[i][2] for i in window), 0
                padded = total if total & (total - 1) == 0 else capacity
                for i in window:
                    at[i] = (base + made, offset, total, padded)
                    offset += pieces[i][2]
                made += 1
            return at

        def rows(pieces, at):
            kept = [pa.array([p[0][c] for p in pieces], type=kinds[c]) for c in range(len(keep))]
            cols = [[p[1] for p in pieces], [p[2] for p in pieces], [p[4] for p in pieces], [p[3] for p in pieces], *map(list, zip(*at, strict=True))]
            out = kept + [pa.array(c, pa.int64()) for c in cols] + ([pa.array([p[5] for p in pieces], pa.binary())] if ids else [])
            return pa.RecordBatch.from_arrays(out, names=schema.names)

        for batch in batches:
            kinds = [batch.schema.field(f.name).type for f in keep]
            for part in text_slices(batch, "text"):
                values = [part.column(f.name).to_pylist() for f in keep]
                # the encoder's lists of a text's chunks take many times the text
                coded = [raw for few in text_slices(part, "text", 1 << 19) for raw in enc.encode([t or "" for t in few.column("text").to_pylist()])]
                whole, at = [], []
                for k, raw in enumerate(coded):
                    raw += end
                    n = len(raw) // 4
                    row, full = tuple(v[k] for v in values), n // capacity
                    marks = [i * capacity for i in range(full + 1)]
                    count = -(-(n - marks[-1]) // cut)
                    marks += [marks[full] + (n - marks[full]) * (i + 1) // count for i in range(count)]
                    for i, (a, b) in enumerate(zip(marks, marks[1:], strict=False)):
                        own = raw[4 * a : 4 * b]
                        piece = (row, a, b - a, n, zlib.crc32(own), own if ids else None)
                        if i < full:
                            whole.append(piece)
                            at.append((base + made, 0, capacity, capacity))
                            made += 1
                        else:
                            held.append(piece)
                if whole:
                    yield rows(whole, at)
                while len(held) >= block:
                    now, held = held[:block], held[block:]
                    yield rows(now, place(now))
        if held:
            yield rows(held, place(held))

    return source.mapInArrow(run, schema)
