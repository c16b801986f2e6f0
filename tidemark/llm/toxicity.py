"""Toxicity by a factorization machine over hashed terms.

score = sigmoid(b + sum of w_i + sum over pairs of <v_i, v_j>) over the terms i
that a text contains, so a pair of terms can weigh what neither does alone.
Terms are lower-cased runs of letters and their beginnings (STEMS bytes long),
hashed to 30 bits. Terms without a significant link to the label (likelihood ratio over the training texts) have
no parameters.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import cut, text_slices
from tidemark.llm.words import Words, letters, salted

HASH_BITS = 30
#: Labelled rows that training sees at most.
TRAIN_ROWS = 20_000
#: Terms with parameters at most, and the least likelihood ratio (chance under
#: 1e-7 for a term that is unrelated to the label).
TERMS, LEAST_RATIO = 4096, 28.0
#: Lengths of word beginnings, in bytes: inflected forms share them.
STEMS = (4, 5, 6, 7, 8)


@dataclass
class Model:
    terms: np.ndarray  # sorted hashes
    bias: float
    weight: np.ndarray
    factors: np.ndarray

    def logits(self, doc: np.ndarray, term: np.ndarray, n: int) -> np.ndarray:
        """doc, term: the distinct (text, term number) pairs of n texts."""
        out = self.bias + np.bincount(doc, self.weight[term], n)
        for f in self.factors.T:
            own = f[term]
            out += 0.5 * (np.bincount(doc, own, n) ** 2 - np.bincount(doc, own * own, n))
        return out


def _terms(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(text number, term hash) of every word and word beginning."""
    w = Words(letters(texts))
    raw = np.frombuffer(w.data, np.uint8)
    doc, size = w.document(), w.end - w.start
    docs, terms = [doc], [w.hash]
    for n in STEMS:
        own = np.flatnonzero(size > n)
        stem = np.zeros(len(own), np.uint64)
        for j in range(n):
            stem = (stem << np.uint64(8)) | raw[w.start[own] + j]
        docs.append(doc[own])
        terms.append(salted(stem, n))
    return np.concatenate(docs), (np.concatenate(terms) >> np.uint64(64 - HASH_BITS)).astype(np.int64)


def features(df: DataFrame, text: str, label: str) -> DataFrame:
    """(y, terms): the distinct term hashes of each text, ascending."""
    schema = T.StructType([T.StructField("y", T.IntegerType()), T.StructField("terms", T.ArrayType(T.IntegerType()))])

    def run(batches):
        for batch in batches:
            for part in text_slices(batch, "text", 1 << 20):
                doc, term = _terms(part.column("text").to_pylist())
                pair = np.unique((doc << HASH_BITS) | term)
                offsets = np.searchsorted(pair >> HASH_BITS, np.arange(part.num_rows + 1)).astype(np.int32)
                values = pa.ListArray.from_arrays(pa.array(offsets), pa.array((pair & ((1 << HASH_BITS) - 1)).astype(np.int32)))
                yield pa.RecordBatch.from_arrays([part.column("y"), values], names=schema.names)

    return df.select(F.col(f"`{text}`").alias("text"), F.col(f"`{label}`").cast("int").alias("y")).mapInArrow(run, schema)


def _telling_terms(seen: DataFrame, n: int, positive: int) -> np.ndarray:
    """Terms by likelihood ratio of their presence against the label."""
    per = seen.select("y", F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").cast("double").alias("k"), F.sum("y").cast("double").alias("p"))

    def part(o, e):
        return F.when(o > 0, o * F.log(o / e)).otherwise(0.0)

    k, p, rate = F.col("k"), F.col("p"), positive / n
    rest, rest_p = F.lit(float(n)) - k, F.lit(float(positive)) - p
    ratio = 2 * (part(p, k * rate) + part(k - p, k * (1 - rate)) + part(rest_p, rest * rate) + part(rest - rest_p, rest * (1 - rate)))
    best = per.select("term", ratio.alias("ratio")).where(F.col("ratio") >= LEAST_RATIO).orderBy(F.desc("ratio"), "term").limit(TERMS)
    return np.sort(np.array([r.term for r in best.collect()], np.int64))


def fit(df: DataFrame, text: str = "text", label: str = "toxic", rank: int = 4, steps: int = 300, penalty: float = 1e-4, seed: int = 7) -> Model:
    """Train on rows with a label (null labels are left out) of a table of at
    most about TRAIN_ROWS rows (see :func:`bounded`). Equal texts with equal
    terms count once. Without both classes the score is the share of ones, or
    0.5 without rows."""
    seen = cut(features(df.where(F.col(f"`{label}`").isNotNull()), text, label).dropDuplicates(["y", "terms"]), "toxic-terms")
    n, positive = seen.agg(F.count("*"), F.coalesce(F.sum("y"), F.lit(0))).first()
    prior = (positive + 0.5) / (n + 1)
    none = Model(np.zeros(0, np.int64), float(np.log(prior / (1 - prior))), np.zeros(0), np.zeros((0, rank)))
    if positive in (0, n):
        return none
    terms = _telling_terms(seen, n, positive)
    if not len(terms):
        return none
    known = F.array(*[F.lit(int(t)) for t in terms])
    rows = seen.select("y", F.array_intersect("terms", known).alias("terms")).groupBy("y", "terms").agg(F.count("*").alias("n")).collect()
    rows.sort(key=lambda r: (r.y, r.terms))
    y, times = np.array([r.y for r in rows], float), np.array([r.n for r in rows], float) / n
    doc = np.repeat(np.arange(len(rows)), [len(r.terms) for r in rows])
    term = np.searchsorted(terms, np.array([t for r in rows for t in r.terms], np.int64))
    rng = np.random.default_rng(seed)
    m = Model(terms, none.bias, np.zeros(len(terms)), rng.normal(0, 0.05, (len(terms), rank)))
    state = [np.zeros(1), np.zeros_like(m.weight), np.zeros_like(m.factors)]
    squares = [np.zeros(1), np.zeros_like(m.weight), np.zeros_like(m.factors)]
    for step in range(1, steps + 1):  # full-batch Adam on the weighted rows
        off = times * (1 / (1 + np.exp(-m.logits(doc, term, len(rows)))) - y)
        per = off[doc]
        grads = [np.array([off.sum()]), np.bincount(term, per, len(terms)) + penalty * m.weight, np.empty_like(m.factors)]
        for f in range(rank):
            own = m.factors[term, f]
            total = np.bincount(doc, own, len(rows))
            grads[2][:, f] = np.bincount(term, per * (total[doc] - own), len(terms)) + penalty * m.factors[:, f]
        moves = []
        for i, g in enumerate(grads):
            state[i] = 0.9 * state[i] + 0.1 * g
            squares[i] = 0.99 * squares[i] + 0.01 * g * g
            moves.append(0.05 * (state[i] / (1 - 0.9**step)) / (np.sqrt(squares[i] / (1 - 0.99**step)) + 1e-8))
        m.bias, m.weight, m.factors = m.bias - float(moves[0][0]), m.weight - moves[1], m.factors - moves[2]
    return m


def bounded(labels: DataFrame, key: str = "doc_id", rows: int = TRAIN_ROWS) -> DataFrame:
    """At most ``rows`` rows, those with the least hash of ``key``."""
    return labels.orderBy(F.xxhash64(key), key).limit(rows)


def score(df: DataFrame, model: Model, text: str = "text", out: str = "score") -> DataFrame:
    """``df`` with double column ``out`` (0 to 1, higher: label 1 likelier) of
    each whole text. Null and empty texts, or texts without a known term, get
    the bias alone. Rows are scored one by one; extra columns pass through, an
    existing column ``out`` is replaced."""
    names = [c for c in df.columns if c.lower() != out.lower()]
    df = df.select(*[F.col(f"`{c}`") for c in names])
    schema = T.StructType([*df.schema.fields, T.StructField(out, T.DoubleType())])
    quick = np.zeros(1 << 16, bool)
    quick[model.terms & 0xFFFF] = True

    def run(batches):
        for batch in batches:
            for part in text_slices(batch, text, 1 << 20):
                doc, term = _terms(part.column(text).to_pylist())
                maybe = np.flatnonzero(quick[term & 0xFFFF])
                doc, term = doc[maybe], term[maybe]
                at = np.searchsorted(model.terms, term)
                hit = at < len(model.terms)
                hit[hit] = model.terms[at[hit]] == term[hit]
                pair = np.unique(doc[hit] * (len(model.terms) + 1) + at[hit])
                doc, at = np.divmod(pair, len(model.terms) + 1)
                p = 1 / (1 + np.exp(-model.logits(doc, at, part.num_rows)))
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in names], pa.array(p)], names=schema.names)

    return df.mapInArrow(run, schema)


def labelled(docs: DataFrame, labels: DataFrame, key: str = "doc_id") -> DataFrame:
    """Texts of a bounded set of labels. The labels are broadcast: at most
    TRAIN_ROWS small rows, so no text is shuffled."""
    return docs.join(F.broadcast(labels), key).select("text", "toxic")


def fold(key: str, parts: int) -> Column:
    """crc32 of the key as text, modulo ``parts`` (null for a null key)."""
    return F.crc32(F.col(key).cast("string")) % parts
