"""Language identification by a linear-chain conditional random field.

Every word of a text has a label. A word's scores sum learned weights of its
beginnings, endings, byte trigrams and of the word itself; learned transitions
tie neighbouring words, so a code-switched text falls into runs. The posterior of
each word comes from forward-backward; the text's language is the label with the
largest share of posterior mass, and that share is its score.

Training texts carry one label each. So that the transitions see switches, they
are cut into runs of words, and runs of different texts are strung together to
the training sequences.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import text_slices
from tidemark.llm.words import Words, letters, salted

UNKNOWN = "und"
FEATURE_BITS = 18
#: Training texts per language, about (chosen by a hash of the text).
TRAIN_TEXTS = 600
AFFIXES = (1, 2, 3, 4)
#: A longer run of bytes without white space takes a place in the chain for every so many bytes, about.
TOKEN_BYTES = 32


def tokens(texts: list[str | None]) -> tuple[Words, np.ndarray]:
    """(words in lower case, the place in its text of the word each comes from).
    A long run without white space, as in scripts that do not part words, is cut
    between characters, so that it has many places in the chain."""
    texts = letters(texts)
    w = Words(texts)
    place = np.arange(len(w)) - w.first[:-1][w.document()]
    long = np.flatnonzero(w.end - w.start >= TOKEN_BYTES * 3 // 2)
    if not len(long):
        return w, place
    parts = np.ones(len(w), np.int64)
    cut: dict[int, list[bytes]] = {}
    for i in long:
        word, at = w.word(i), 0
        pieces = cut[int(i)] = []
        while at < len(word):
            to = at + TOKEN_BYTES if len(word) - at >= TOKEN_BYTES * 3 // 2 else len(word)
            while to < len(word) and word[to] & 0xC0 == 0x80:  # inside a character
                to += 1
            pieces.append(word[at:to])
            at = to
        parts[i] = len(pieces)
    for d in np.unique(np.searchsorted(w.first, long, "right") - 1):
        texts[d] = b" ".join(b" ".join(cut.get(i) or [w.word(i)]) for i in range(int(w.first[d]), int(w.first[d + 1])))
    return Words(texts), np.repeat(place, parts)


def _buckets(x: np.ndarray, kind: int) -> np.ndarray:
    return (salted(x, kind + 1) >> np.uint64(64 - FEATURE_BITS)).astype(np.int32)


def word_features(w: Words, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number in ``which``, feature) pairs of the chosen words."""
    raw = np.frombuffer(w.data, np.uint8)
    start, size = w.start[which], w.end[which] - w.start[which]
    rows, cols = [np.arange(len(which))], [_buckets(w.hash[which], 0)]
    for n in AFFIXES:
        own = np.flatnonzero(size >= n)
        for kind, at in ((n, start[own]), (8 + n, start[own] + size[own] - n)):
            x = np.zeros(len(own), np.uint64)
            for j in range(n):
                x = (x << np.uint64(8)) | raw[at + j]
            rows.append(own)
            cols.append(_buckets(x, kind))
    grams = np.maximum(size - 2, 0)
    own = np.repeat(np.arange(len(which)), grams)
    at = start[own] + np.arange(len(own)) - np.repeat(np.cumsum(grams) - grams, grams)
    x = np.zeros(len(own), np.uint64)
    for i in range(3):
        x = (x << np.uint64(8)) | raw[at + i]
    rows.append(own)
    cols.append(_buckets(x, 3))  # the same feature wherever it stands
    return np.concatenate(rows), np.concatenate(cols)


@dataclass
class Model:
    labels: list[str]
    weight: np.ndarray  # feature x label
    transition: np.ndarray  # label x label
    first: np.ndarray

    def emissions(self, w: Words) -> tuple[np.ndarray, np.ndarray]:
        """(scores of the distinct words, the distinct word of each word)."""
        _, which, back = np.unique(w.hash, return_index=True, return_inverse=True)
        rows, cols = word_features(w, which)
        out = np.stack([np.bincount(rows, self.weight[cols, k], len(which)) for k in range(len(self.labels))], 1)
        return out, back


def forward_backward(score: np.ndarray, start: np.ndarray, size: np.ndarray, m: Model, pairs: bool = False):
    """Posterior of each word (word x label); ``start`` and ``size`` give the
    sequences inside ``score``. All sequences move one word a step, longest
    first, in scaled probabilities. With ``pairs`` also the expected number of
    transitions and of first labels."""
    e = np.exp(score - score.max(1, keepdims=True))
    a = np.exp(m.transition)
    order = np.argsort(-size, kind="stable")
    start, size = start[order], size[order]
    alpha = np.empty_like(e)
    live = np.searchsorted(-size, -np.arange(size.max(initial=0)), "left")  # sequences longer than t
    for t, n in enumerate(live):
        at = start[:n] + t
        x = e[at] * (np.exp(m.first) if t == 0 else alpha[at - 1] @ a)
        alpha[at] = x / x.sum(1, keepdims=True)
    out = np.empty_like(e)
    moves, firsts = np.zeros_like(a), np.zeros(a.shape[0])
    beta = np.ones((len(size), a.shape[0]))
    for t in range(len(live) - 1, -1, -1):
        n = live[t]
        at = start[:n] + t
        x = alpha[at] * beta[:n]
        out[at] = x / x.sum(1, keepdims=True)
        if t == 0:
            firsts = out[at].sum(0)
            break
        b = e[at] * beta[:n]
        if pairs:
            back = b / ((alpha[at - 1] @ a) * b).sum(1, keepdims=True)
            moves += a * (alpha[at - 1].T @ back)
        new = b @ a.T
        beta[:n] = new / new.sum(1, keepdims=True)
    return (out, moves, firsts) if pairs else out


def train(texts: list[str], langs: list[str], epochs: int = 3, batch: int = 600, penalty: float = 1e-5, seed: int = 5) -> Model:
    """Stochastic gradient (Adagrad) on the conditional likelihood."""
    labels = sorted(set(langs))
    m = Model(labels, np.zeros((1 << FEATURE_BITS, len(labels))), np.zeros((len(labels),) * 2), np.zeros(len(labels)))
    w, _ = tokens(texts)
    if not len(w) or len(labels) < 2:
        return m
    truth = np.array([labels.index(x) for x in langs])[w.document()]
    rng = np.random.default_rng(seed)
    squares = [np.full_like(x, 1e-6) for x in (m.weight, m.transition, m.first)]
    _, which, back = np.unique(w.hash, return_index=True, return_inverse=True)
    rows, cols = word_features(w, which)
    by_word = np.searchsorted(rows[(order := np.argsort(rows, kind="stable"))], np.arange(len(which) + 1))
    cols = cols[order]
    for _ in range(epochs):
        # runs of 4 to 60 words; two to four runs make a sequence
        cuts = np.unique(np.concatenate([w.first[:-1], np.minimum(np.cumsum(rng.integers(4, 61, len(w) // 4 + 2)), len(w))]))
        cuts = cuts[cuts < len(w)]
        stop = np.append(cuts[1:], len(w))
        shuffled = rng.permutation(len(cuts))
        joins = np.cumsum(rng.integers(1, 4, len(cuts) + 1))
        sequences = [s for s in np.split(shuffled, joins[joins < len(shuffled)]) if len(s)]
        for at in range(0, len(sequences), batch):
            part = sequences[at : at + batch]
            words = [np.concatenate([np.arange(cuts[r], stop[r]) for r in s]) for s in part]
            size = np.array([len(x) for x in words])
            start, word = np.cumsum(size) - size, np.concatenate(words)
            distinct, own = np.unique(back[word], return_inverse=True)
            spans = by_word[distinct + 1] - by_word[distinct]
            feature = cols[np.repeat(by_word[distinct] - np.cumsum(spans) + spans, spans) + np.arange(spans.sum())]
            row = np.repeat(np.arange(len(distinct)), spans)
            k = range(len(labels))
            score = np.stack([np.bincount(row, m.weight[feature, j], len(distinct)) for j in k], 1)[own]
            posterior, moves, firsts = forward_backward(score, start, size, m, pairs=True)
            y = truth[word]
            off = posterior
            off[np.arange(len(y)), y] -= 1
            per_word = np.stack([np.bincount(own, off[:, j], len(distinct)) for j in k], 1)
            inner = np.ones(len(y), bool)
            inner[start] = False
            seen = np.zeros_like(moves)
            np.add.at(seen, (y[np.flatnonzero(inner) - 1], y[inner]), 1)
            touched, slot = np.unique(feature, return_inverse=True)
            g = np.stack([np.bincount(slot, per_word[row, j], len(touched)) for j in k], 1) / len(y) + penalty * m.weight[touched]
            squares[0][touched] += g * g
            m.weight[touched] -= 0.1 * g / np.sqrt(squares[0][touched])
            for i, (x, g) in enumerate(((m.transition, (moves - seen) / len(y)), (m.first, (firsts - np.bincount(y[start], minlength=len(labels))) / len(y))), 1):
                squares[i] += g * g
                x -= 0.1 * g / np.sqrt(squares[i])
    return m


def fit(df: DataFrame, text: str = "text", lang: str = "lang", texts: int = TRAIN_TEXTS) -> Model:
    """Train on about ``texts`` whole texts of every language, those with the
    least hash of the text. Rows with a null text or language are left out;
    equal texts hash alike and count once, also for the share that is chosen. Without labelled rows the model has
    no label and predicts ``und``."""
    known = df.where(F.col(f"`{text}`").isNotNull() & F.col(f"`{lang}`").isNotNull()).select(F.col(f"`{text}`").alias("text"), F.col(f"`{lang}`").alias("lang"))
    part = F.pmod(F.xxhash64("text"), F.lit(1 << 30)) / float(1 << 30)
    distinct = known.select("lang", F.xxhash64("text").alias("h")).distinct().groupBy("lang").count()
    share = {r["lang"]: min(1.0, texts / r["count"]) for r in distinct.collect()}
    if not share:
        return Model([], np.zeros((1 << FEATURE_BITS, 0)), np.zeros((0, 0)), np.zeros(0))
    limit = F.coalesce(*[F.when(F.col("lang") == k, F.lit(v)) for k, v in share.items()])
    rows = known.where(part < limit).distinct().collect()
    rows.sort(key=lambda r: (r["lang"], r["text"]))
    return train([r["text"] for r in rows], [r["lang"] for r in rows])


def _posteriors(m: Model, texts: list[str | None]) -> tuple[Words, np.ndarray, np.ndarray]:
    w, place = tokens(texts)
    if not len(w) or not m.labels:
        return w, place, np.zeros((len(w), len(m.labels)))
    score, back = m.emissions(w)
    size = np.diff(w.first)
    own = size > 0
    return w, place, forward_backward(score[back], w.first[:-1][own], size[own], m)


def predict(df: DataFrame, m: Model, text: str = "text", lang: str = "lang_pred", score: str = "score", spans: str | None = None) -> DataFrame:
    """``df`` with the language of each whole text and its share of the words'
    posterior mass. A null text, or one without letters, is ``und`` with score
    0; ties go to the first label in order. With ``spans``, an array column of
    that name lists the runs of words with one most likely label: (lang, first
    word, words); a long word that is cut can be in several runs. Rows are judged one by one; extra columns pass through, those
    named like an output are replaced."""
    made = {x.lower() for x in (lang, score, spans or lang)}
    names = [c for c in df.columns if c.lower() not in made]
    span = T.ArrayType(T.StructType([T.StructField("lang", T.StringType()), T.StructField("first", T.IntegerType()), T.StructField("words", T.IntegerType())]))
    df = df.select(*[F.col(f"`{c}`") for c in names])
    schema = T.StructType([*df.schema.fields, T.StructField(lang, T.StringType()), T.StructField(score, T.DoubleType())]
                          + ([T.StructField(spans, span)] if spans else []))
    labels = np.array([*m.labels, UNKNOWN], dtype=object)

    def run(batches):
        import regex

        letter = regex.compile(r"\p{L}")
        for batch in batches:
            for part in text_slices(batch, text, 1 << 20):
                texts = part.column(text).to_pylist()
                w, place, p = _posteriors(m, texts)
                n = np.diff(w.first)
                ok = np.array([bool(t and letter.search(t)) for t in texts], bool) & (n > 0) & bool(m.labels)
                mass = np.stack([np.bincount(w.document(), p[:, k], len(n)) for k in range(len(m.labels))], 1) if m.labels else np.zeros((len(n), 1))
                best = np.where(ok, mass.argmax(1), len(m.labels))
                value = np.where(ok, np.minimum(1.0, mass.max(1) / np.maximum(n, 1)), 0.0)
                out = [pa.array(labels[best].tolist(), pa.string()), pa.array(value)]
                if spans:
                    top = p.argmax(1) if m.labels else np.zeros(len(w), int)
                    runs = []
                    for d, good in enumerate(ok):
                        own = top[w.first[d] : w.first[d + 1]]
                        cuts = np.flatnonzero(np.diff(own, prepend=-1)) if good else []
                        at = place[w.first[d] : w.first[d + 1]]
                        runs.append([{"lang": m.labels[own[a]], "first": int(at[a]), "words": int(at[b - 1] - at[a] + 1)} for a, b in zip(cuts, [*cuts[1:], len(own)], strict=True)] if good else [])
                    out.append(pa.array(runs, pa.list_(pa.struct([("lang", pa.string()), ("first", pa.int32()), ("words", pa.int32())]))))
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in names], *out], names=schema.names)

    return df.mapInArrow(run, schema)
