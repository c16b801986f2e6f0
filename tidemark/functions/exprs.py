"""Column expressions shared by the operators. All are native Spark SQL
expressions, so they stay inside whole-stage codegen."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the monitored behaviour.
JS_EPSILON = 1e-10          # floor applied to both shares before the log
KS_SERIES_TERMS = 100       # terms of the Kolmogorov series
KS_SMALL_LAMBDA = 0.2       # below this the series is 1 to double precision
ROUND_DIGITS = 9            # result rounding shared with the SQL oracle


def qcol(name: str) -> Column:
    """The column of exactly this name, whatever characters it holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def round9(c: Column) -> Column:
    return F.round(c, ROUND_DIGITS)


def safe_div(num: Column, den: Column) -> Column:
    """num / den, NULL when den is 0 or NULL (ANSI mode would raise)."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def relative_change(current: Column, baseline: Column) -> Column:
    """(current - baseline) / |baseline|; a zero baseline gives +inf when the
    current value differs from zero and 0 otherwise."""
    return (F.when(baseline != 0, (current - baseline) / F.abs(baseline))
            .when(current != 0, F.lit(float("inf")))
            .otherwise(F.lit(0.0)))


def pct_change(current: Column, baseline: Column) -> Column:
    """relative_change x 100; the zero-baseline values are not scaled."""
    return (F.when(baseline != 0, (current - baseline) / F.abs(baseline) * 100.0)
            .when(current != 0, F.lit(float("inf")))
            .otherwise(F.lit(0.0)))


def js_term(p: Column, q: Column) -> Column:
    """One value's contribution to the Jensen-Shannon divergence (natural log),
    with both shares floored at JS_EPSILON and not renormalised."""
    pf = F.greatest(F.coalesce(p, F.lit(0.0)), F.lit(JS_EPSILON))
    qf = F.greatest(F.coalesce(q, F.lit(0.0)), F.lit(JS_EPSILON))
    return 0.5 * (pf * F.ln(2.0 * pf / (pf + qf)) + qf * F.ln(2.0 * qf / (pf + qf)))


def ks_pvalue(d: Column, n: Column, m: Column) -> Column:
    """Two-sided p-value of the two-sample KS statistic d for sample sizes n
    and m, from the limiting Kolmogorov distribution:
    lambda = d * sqrt(n*m/(n+m)); p = 2 * sum_{k>=1} (-1)^(k-1) exp(-2 k^2 lambda^2),
    1 for small lambda, clamped to [0, 1]."""
    lam = d * F.sqrt(n.cast("double") * m.cast("double") / (n + m).cast("double"))
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(KS_SERIES_TERMS)),
        F.lit(0.0),
        lambda acc, k: acc + F.pow(F.lit(-1.0), k - 1) * F.exp(-2.0 * k * k * lam * lam),
    )
    p = F.when(lam < KS_SMALL_LAMBDA, F.lit(1.0)).otherwise(2.0 * series)
    return F.when(d.isNull(), F.lit(None).cast("double")).otherwise(
        F.least(F.greatest(p, F.lit(0.0)), F.lit(1.0)))


def _erfc(x: Column) -> Column:
    """Complementary error function of x >= 0: the Maclaurin series of erf below
    2, Laplace's continued fraction from there on."""
    small = F.aggregate(
        F.sequence(F.lit(1), F.lit(60)),
        F.struct(x.alias("term"), x.alias("sum")),
        lambda acc, n: F.struct((acc["term"] * -1.0 * x * x / n).alias("term"),
                                (acc["sum"] + acc["term"] * -1.0 * x * x / n / (2 * n + 1)).alias("sum")),
        lambda acc: 1.0 - 2.0 / F.sqrt(F.lit(math.pi)) * acc["sum"])
    tail = F.aggregate(F.sequence(F.lit(80), F.lit(1), F.lit(-1)), x, lambda acc, k: x + k / 2.0 / acc)
    return F.when(x < 2.0, small).otherwise(F.exp(-x * x) / F.sqrt(F.lit(math.pi)) / tail)


def normal_two_sided(z: Column) -> Column:
    """Probability that a standard normal value is further from 0 than z."""
    return _erfc(F.abs(z) / math.sqrt(2.0))


def chi_square_pvalue(x: Column, dof: Column) -> Column:
    """Upper tail of the chi-square distribution. For whole degrees of freedom k
    it is a finite sum: exp(-x/2) (x/2)^i / Gamma(i+1) over i = 0, 1, .. below k/2
    for even k; for odd k, over i = 1/2, 3/2, .. and erfc(sqrt(x/2)) besides. The
    terms are taken by their logarithms, so that large x and k neither overflow
    nor vanish early."""
    h = x / 2.0
    odd = (dof % 2).cast("double")
    start = F.struct((-h + F.when(odd == 1, 0.5 * F.ln(h) - math.log(math.sqrt(math.pi) / 2)).otherwise(F.lit(0.0))).alias("log"), F.lit(0.0).alias("sum"))
    terms = F.floor(dof / 2).cast("int")
    series = F.aggregate(
        F.when(terms > 0, F.sequence(F.lit(1), terms)).otherwise(F.array().cast("array<int>")), start,
        lambda acc, j: F.struct((acc["log"] + F.ln(h) - F.ln(j + odd / 2.0)).alias("log"), (acc["sum"] + F.exp(acc["log"])).alias("sum")),
        lambda acc: acc["sum"])
    tail = series + F.when(odd == 1, _erfc(F.sqrt(h))).otherwise(F.lit(0.0))
    p = F.when(x <= 0, 1.0).when(x == F.lit(float("inf")), 0.0).otherwise(tail)
    return F.least(F.greatest(p, F.lit(0.0)), F.lit(1.0))
