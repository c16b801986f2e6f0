"""URL filter rules as one bit-parallel wildcard automaton.

Every rule is a glob over the canonical url ``.host/path``. All globs are laid
side by side in 64-bit words: bit j of a word says that the first j+1 symbols of
its pattern have been read (Shift-And). One step shifts every pattern at once,
and a star keeps its bit while the characters it may stand for go by. A batch of
urls is a matrix of bytes, so one step moves all patterns over all urls.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: (rule, verdict): a rule is a host and a path prefix.
Rule = tuple[str, str]
LABEL_STAR, ANY_STAR = 256, 257  # a star within the host; a star over anything


class Automaton:
    """Patterns are lists of symbols: a byte, LABEL_STAR (any run of bytes but
    ``/``) or ANY_STAR (any run). A pattern matches a whole string."""

    def __init__(self, patterns: Sequence[Sequence[int]]):
        patterns = [self._single_stars(p) for p in patterns]
        total = sum(len(p) for p in patterns)
        self.words = words = max(1, -(-total // 64))
        self.step = np.zeros((256, words), np.uint64)  # byte -> bits that it may enter
        self.stay = np.zeros((256, words), np.uint64)  # byte -> star bits that survive it
        self.first = np.zeros(words, np.uint64)
        self.star = np.zeros(words, np.uint64)
        self.ends = []
        at = 0
        for p in patterns:
            for k, s in enumerate(p):
                w, bit = divmod(at, 64)
                bit = np.uint64(1 << bit)
                if k == 0:
                    self.first[w] |= bit
                if s == ANY_STAR:
                    self.stay[:, w] |= bit
                elif s == LABEL_STAR:
                    self.stay[np.arange(256) != ord("/"), w] |= bit
                else:
                    self.step[s, w] |= bit
                if s >= 256:
                    self.star[w] |= bit
                at += 1
            self.ends.append(at - 1)

    @staticmethod
    def _single_stars(pattern: Sequence[int]) -> list[int]:
        """Neighbouring stars as one: the widest of them."""
        out: list[int] = []
        for s in pattern:
            if out and out[-1] >= 256 and s >= 256:
                out[-1] = max(out[-1], s)
            else:
                out.append(s)
        return out

    def _shift(self, state: np.ndarray) -> np.ndarray:
        """One place up over all words; a pattern's first bit takes nothing over."""
        out = state << np.uint64(1)
        out[:, 1:] |= state[:, :-1] >> np.uint64(63)
        return out & ~self.first

    def _skip(self, state: np.ndarray) -> np.ndarray:
        """A star may stand for nothing: its bit is set with the bit before it."""
        return state | (self._shift(state) & self.star)

    def match(self, strings: list[bytes]) -> np.ndarray:
        """Boolean matrix (string, pattern). Strings of like length go together."""
        out = np.zeros((len(strings), len(self.ends)), bool)
        order = np.argsort([len(s) for s in strings], kind="stable")
        for part in np.array_split(order, max(1, -(-len(order) // 4096))):
            lengths = np.array([len(strings[i]) for i in part])
            width = int(lengths.max(initial=0))
            text = np.frombuffer(b"".join(strings[i].ljust(width, b"\0") for i in part), np.uint8).reshape(len(part), width)
            state = np.zeros((len(part), self.words), np.uint64)
            start = np.broadcast_to(self.first & self.star, state.shape)
            state |= start
            for t in range(width):
                live = np.flatnonzero(lengths > t)  # a suffix: sorted by length
                live = slice(int(live[0]), None)
                c, now = text[live, t], state[live]
                entered = self._shift(now) | (self.first if t == 0 else np.uint64(0))
                # a first symbol after a leading star is entered through the star's bit
                state[live] = self._skip((entered & self.step[c]) | (now & self.stay[c]))
            for k, e in enumerate(self.ends):
                out[part, k] = (state[:, e // 64] >> np.uint64(e % 64)) & np.uint64(1) != 0
        return out


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    rest = _after_scheme(url)
    host = F.regexp_extract(rest, r"(?s)^[^/?#]*", 0)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_after_scheme(url), r"(?s)^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.coalesce(F.when(at > 0, url.substr(at + 3, F.length(url))), F.lit(""))


def compile_rules(rules: Sequence[Rule]) -> Automaton:
    """Rule ``host/path`` fits the host, its subdomains and paths that begin so:
    ``*.host/path*`` over ``.`` + host + path."""
    return Automaton([[LABEL_STAR, *f".{rule}".encode(), ANY_STAR] for rule, _ in rules])


def judge(df: DataFrame, rules: Sequence[Rule], default: str = "allow", url: str = "url") -> DataFrame:
    """``df`` with host, path, rule and verdict of each url. Among the rules that
    fit, the longest wins (among equals, the first given); without one, rule is
    null and the verdict is ``default``. A null url, or one without ``://``, has
    an empty host and path and fits no rule. Rows are judged one by one, so
    repeated rows repeat and an empty table stays empty; columns of ``df`` named
    like an output column are replaced."""
    rules = list(rules)
    out = df.withColumns({"host": host_of(F.col(url)), "path": path_of(F.col(url))})
    ranked = sorted(range(len(rules)), key=lambda i: (-len(rules[i][0].encode()), i))

    @F.pandas_udf("int")
    def which(host, path):
        import pandas as pd

        machine = compile_rules(rules)
        fits = machine.match([f".{h}{p}".encode() for h, p in zip(host, path, strict=True)])
        best = np.full(len(host), -1)
        for i in reversed(ranked):
            best[fits[:, i]] = i
        return pd.Series(best, dtype="int32")

    kind = "array<struct<rule string, verdict string>>"
    table = F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(v).alias("verdict")) for r, v in rules]) if rules else F.array().cast(kind)
    out = out.withColumn("rule", which("host", "path")) if rules else out.withColumn("rule", F.lit(-1))
    hit = F.get(table, F.col("rule"))
    return out.withColumns({"verdict": F.coalesce(hit["verdict"], F.lit(default)), "rule": hit["rule"]})
