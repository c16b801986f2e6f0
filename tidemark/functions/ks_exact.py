"""Exact two-sided p-value of the two-sample Kolmogorov-Smirnov statistic
for small samples (both sides at most EXACT_MAX_N values).

Under the null every interleaving of the m reference and n current values is
equally likely: a random lattice path from (0, 0) to (m, n). The p-value is
the probability that the path touches |i*n - j*m| >= H, H = round(D*m*n);
it is computed as 1 - P(path stays strictly inside), walking anti-diagonals
with the step probabilities (m - i)/(m + n - s) and (n - j)/(m + n - s), so
every intermediate value is a probability (no large binomials)."""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle

# Fixed value: the largest sample size per side that gets the exact p-value.
EXACT_MAX_N = 10_000

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def ks_exact_pvalue(d: float, m: int, n: int) -> float | None:
    if d is None or m <= 0 or n <= 0:
        return None
    h = int(round(d * m * n))
    if h <= 0:
        return 1.0
    dp = np.zeros(m + 1)
    dp[0] = 1.0
    for s in range(1, m + n + 1):
        i = np.arange(max(0, s - n), min(m, s) + 1)
        j = s - i
        rem = float(m + n - (s - 1))
        from_x = np.where(i >= 1, dp[np.maximum(i - 1, 0)] * (m - (i - 1)) / rem, 0.0)
        from_y = np.where(j >= 1, dp[i] * (n - (j - 1)) / rem, 0.0)
        nxt = np.zeros(m + 1)
        nxt[i] = np.where(np.abs(i * n - j * m) < h, from_x + from_y, 0.0)
        dp = nxt
    return float(min(max(1.0 - dp[m], 0.0), 1.0))


def exact_pvalues(pdf: pd.DataFrame) -> pd.DataFrame:
    """applyInPandas body: (column, statistic, n_reference, n_current) ->
    (column, p_exact); NULL when a side is empty or larger than EXACT_MAX_N."""
    out = []
    for c, d, m, n in zip(pdf["column"], pdf["statistic"], pdf["n_reference"], pdf["n_current"]):
        small = m is not None and n is not None and 0 < m <= EXACT_MAX_N and 0 < n <= EXACT_MAX_N
        ok = small and d is not None and not pd.isna(d)
        out.append((c, ks_exact_pvalue(float(d), int(m), int(n)) if ok else None))
    return pd.DataFrame(out, columns=["column", "p_exact"])
