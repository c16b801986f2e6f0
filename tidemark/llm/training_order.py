"""Training-order materialisation of tokenised documents.

Documents are encoded, joined with an end id and cut into sequences of a fixed
length. A keyed Feistel network permutes the sequences' numbers; where the
number space is no power of two, values outside it are encrypted again until
they fall inside (cycle-walking). The permuted space is cut into equal ranges:
one shuffle brings each range to one task, which sorts it and writes a shard of
fixed-stride records. A record's global slot is its shard's first slot in the
manifest plus its place, so a reader resumes at any slot with one seek.
"""

from __future__ import annotations

import json
import struct
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.bpe import encoder
from tidemark.llm.common import text_slices
from tidemark.llm.words import salted

#: Sequence numbers kept for each input partition.
PER_PARTITION = 1 << 32
#: A record: number (int64), tokens in use (uint32), CRC-32 of those ids (uint32), ids (uint16).
HEAD, HEAD_BYTES = "<qII", struct.calcsize("<qII")


def feistel(x: np.ndarray, size: int, key: int, rounds: int = 6) -> np.ndarray:
    """Keyed permutation of 0 .. size-1, at the places ``x``."""
    half = max(1, -(-int(size - 1).bit_length() // 2))
    mask, shift = np.uint64((1 << half) - 1), np.uint64(half)
    x = np.asarray(x, np.uint64).copy()
    todo = np.arange(len(x))
    while len(todo):
        left, right = x[todo] >> shift, x[todo] & mask
        for r in range(rounds):
            left, right = right, left ^ (salted(right, key * rounds + r + 1) & mask)
        x[todo] = (left << shift) | right
        todo = todo[x[todo] >= np.uint64(size)]  # cycle-walking
    return x.astype(np.int64)


def _sequences(path: str, pattern: str, tokens: int, end_id: int):
    """A function from batches of texts to batches (number, n, ids): a
    partition's sequences, numbered from partition * PER_PARTITION. ids are
    little-endian unsigned 16-bit, filled up with the end id in the last one."""

    def run(batches):
        enc, base, made, rest = encoder(path, pattern), TaskContext.get().partitionId() * PER_PARTITION, 0, np.zeros(0, "<u2")
        if len(enc.vocabulary.tokens) > 1 << 16 or end_id >= 1 << 16:
            raise ValueError("ids do not fit in 16 bits")

        def rows(flat, n):
            raw = flat.tobytes()
            ids = [raw[2 * tokens * i : 2 * tokens * (i + 1)] for i in range(len(n))]
            return pa.RecordBatch.from_arrays([pa.array(base + made + np.arange(len(n)), pa.int64()), pa.array(n, pa.int32()), pa.array(ids, pa.binary())], names=["number", "n", "ids"])

        end = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            for part in text_slices(batch, "text"):
                coded = np.frombuffer(end.join([*enc.encode([t or "" for t in part.column("text").to_pylist()]), b""]), "<u4")
                rest = np.concatenate([rest, coded.astype("<u2")])
                full = len(rest) // tokens
                if full:
                    yield rows(rest[: full * tokens], np.full(full, tokens))
                    made, rest = made + full, rest[full * tokens :]
        if len(rest):
            yield rows(np.pad(rest, (0, tokens - len(rest)), constant_values=end_id), np.array([len(rest)]))

    return run


def _store(out: str) -> tuple[pa.fs.FileSystem, str]:
    if out.startswith("file:"):
        return pa.fs.LocalFileSystem(), out[5:].replace("///", "/", 1)
    return pa.fs.FileSystem.from_uri(out) if "://" in out else (pa.fs.LocalFileSystem(), out)


def write(df: DataFrame, out: str, path: str, pattern: str, tokens: int = 1024, end_id: int = 0, key: int = 1, shards: int | None = None,
          shard_mb: int = 48, text: str = "text") -> DataFrame:
    """Write shards and a manifest to the shared folder ``out``; returns the
    manifest as a table (shard, first_slot, records).

    ``df`` must give the same partitions whenever it is computed (a file scan or
    a written table does). Null and empty texts are one token, ``end_id``;
    repeated rows are written each; other columns are not read; an empty table
    writes an empty manifest. A shard is written under another name and renamed
    when complete, so a task that is run again leaves one whole shard.
    """
    spark = df.sparkSession
    source = df.select(F.col(f"`{text}`").alias("text"))
    counted = source.select(F.spark_partition_id().alias("part"), F.octet_length("text").alias("bytes"))
    parts, size = counted.agg(F.max("part"), F.sum("bytes")).first()
    space = ((parts or 0) + 1) * PER_PARTITION
    count = shards or max(1, -(-int(size or 0) // (shard_mb << 20)))
    cut = _sequences(path, pattern, tokens, end_id)

    def place(batches):  # in the same Python worker as the encoding
        for b in cut(batches):
            number = b.column("number").to_numpy()
            if len(number) and number.max() >= space:
                raise ValueError("the input's partitions changed between two passes")
            order = feistel(number, space, key)
            shard = (order.astype(object) * count // space).astype(np.int32) if len(order) else np.zeros(0, np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(shard), pa.array(order), *b.columns], names=["shard", "order", *b.schema.names])

    def save(batches):
        fs, folder = _store(out)
        shard, written, file = -1, 0, None
        attempt = TaskContext.get().taskAttemptId()

        def close():
            file.close()
            fs.move(f"{folder}/.{shard}-{attempt}", f"{folder}/shard-{shard:06d}.bin")
            return pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([written], pa.int64())], names=["shard", "records"])

        for b in batches:
            for own, number, n, ids in zip(*(b.column(c).to_pylist() for c in ("shard", "number", "n", "ids")), strict=True):
                if own != shard:
                    if file:
                        yield close()
                    shard, written, file = own, 0, fs.open_output_stream(f"{folder}/.{own}-{attempt}")
                file.write(struct.pack(HEAD, number, n, zlib.crc32(ids[: 2 * n])) + ids)
                written += 1
        if file:
            yield close()

    fs, folder = _store(out)
    fs.create_dir(folder, recursive=True)
    placed = source.mapInArrow(place, "shard int, order long, number long, n int, ids binary")
    dealt = placed.repartitionById(count, F.col("shard")).sortWithinPartitions("shard", "order")
    made = sorted((r.shard, r.records) for r in dealt.mapInArrow(save, "shard int, records long").collect())  # one row a shard
    first, rows = 0, []
    for shard, records in made:
        rows.append((shard, first, records))
        first += records
    with fs.open_output_stream(f"{folder}/manifest.json") as f:
        f.write(json.dumps({"tokens": tokens, "record": HEAD_BYTES + 2 * tokens, "end_id": end_id, "key": key, "shards": rows}).encode())
    return spark.createDataFrame(rows, "shard int, first_slot long, records long")


def read_slots(out: str, start: int, count: int) -> list[np.ndarray]:
    """``count`` sequences from slot ``start`` on, by one seek a shard."""
    fs, folder = _store(out)
    with fs.open_input_stream(f"{folder}/manifest.json") as f:
        m = json.loads(f.read())
    got = []
    for shard, first, records in m["shards"]:
        low, high = max(start, first), min(start + count, first + records)
        if low < high:
            with fs.open_input_file(f"{folder}/shard-{shard:06d}.bin") as f:
                f.seek((low - first) * m["record"])
                raw = f.read((high - low) * m["record"])
            for i in range(high - low):
                own = raw[i * m["record"] : (i + 1) * m["record"]]
                got.append(np.frombuffer(own[HEAD_BYTES :], "<u2")[: struct.unpack(HEAD, own[: HEAD_BYTES])[1]])
    return got


def slots(spark: SparkSession, out: str, manifest: DataFrame, tokens: int = 1024) -> DataFrame:
    """(slot, shard, place, number, n_tokens, ids_crc32, intact) of every record,
    read from the shards; intact: the ids still have their stored CRC-32."""
    record = HEAD_BYTES + 2 * tokens
    firsts = F.broadcast(manifest)  # one row a shard

    def run(batches):
        fs, folder = _store(out)
        for b in batches:
            for shard, first, records in zip(*(b.column(c).to_pylist() for c in ("shard", "first_slot", "records")), strict=True):
                with fs.open_input_file(f"{folder}/shard-{shard:06d}.bin") as f:
                    for at in range(0, records, 4096):
                        n = min(4096, records - at)
                        raw = f.read(n * record)
                        heads = [struct.unpack_from(HEAD, raw, i * record) for i in range(n)]
                        sums = [zlib.crc32(raw[i * record + HEAD_BYTES : i * record + HEAD_BYTES + 2 * h[1]]) for i, h in enumerate(heads)]
                        place = np.arange(at, at + n)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(first + place), pa.array(np.full(n, shard, np.int32)), pa.array(place), pa.array([h[0] for h in heads], pa.int64()),
                             pa.array([h[1] for h in heads], pa.int64()), pa.array(sums, pa.int64()), pa.array([s == h[2] for s, h in zip(sums, heads, strict=True)])],
                            names=["slot", "shard", "place", "number", "n_tokens", "ids_crc32", "intact"])

    listed = firsts.repartition(max(1, spark.sparkContext.defaultParallelism), "shard")
    return listed.mapInArrow(run, "slot long, shard int, place long, number long, n_tokens long, ids_crc32 long, intact boolean")
