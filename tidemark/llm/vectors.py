"""Shared pieces of the vector operators."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(vector: str) -> Column:
    """Not null, not empty, all components finite, and not all zero."""
    v = F.col(vector)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(v.isNotNull() & finite & F.exists(v, lambda x: x != 0), F.lit(False))


def unit(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1; scaled by their largest component first, so that
    no square overflows or vanishes."""
    x = x / np.abs(x).max(axis=1, keepdims=True, initial=0)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def sample(df: DataFrame, key: str, rows: int) -> DataFrame:
    """About ``rows`` rows (all, if fewer), chosen by a hash of ``key``."""
    n = df.count()
    if n <= rows:
        return df
    return df.where(F.pmod(F.xxhash64(F.lit("sample"), key), F.lit(1 << 30)) < int((1 << 30) * rows / n))


def matrix(column: pd.Series, dtype=np.float64) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(dtype) if len(column) else np.zeros((0, 0), dtype)
