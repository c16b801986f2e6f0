"""Kolmogorov-Smirnov bounds from counts at and between fixed cut points.

The cut points of a column are the reference's values at every ``pieces``-th part
of its rows. A value's place is 2 * i - 1 when it equals the i-th cut and 2 * i
when it lies strictly between the i-th and the next (0 below the first), so a
table shrinks to at most 2 * ``pieces`` + 1 counts a column, which add up over
any parts of the table. At the cuts both distributions are known exactly: the
largest difference there is a lower bound of the statistic. Strictly between two
cuts neither share leaves the range it has at the ends: that gives an upper bound,
less than 1 / ``pieces`` above, since the reference has less than that there
(infinite values are no cuts; with many of them the bounds hold but are wider).
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.exprs import ks_pvalue, qcol
from tidemark.operators.drift import DEFAULT_DRIFT_THRESHOLD
from tidemark.operators.ordered import quantile_cuts


@dataclass
class ReferenceCuts:
    values: dict[str, list[float]]  # ascending cut points of each column

    @classmethod
    def of(cls, reference: DataFrame, columns: list[str], pieces: int = 256) -> "ReferenceCuts":
        """The cut points of ``columns``; at most ``pieces`` a column reach the driver."""
        if pieces < 1:
            raise ValueError("pieces must be at least 1")
        names = {f"c{i}": c for i, c in enumerate(columns)}
        wide = reference.select(*[(qcol(c).cast("double") + F.lit(0.0)).alias(k) for k, c in names.items()])
        long = wide.unpivot([], list(names), "column", "value").where("value IS NOT NULL AND NOT isnan(value)")
        found = quantile_cuts(long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n")), pieces).collect()
        return cls({c: sorted(r.value for r in found if r.column == k and math.isfinite(r.value)) for k, c in names.items()})

    def counts(self, df: DataFrame, keys: list[str]) -> DataFrame:
        """(keys..., column, place int, n): rows of ``df`` at each place; nulls and
        NaN are left out. One pass, a binary search a value."""
        names = {f"c{i}": c for i, c in enumerate(self.values)}
        nan = F.lit(float("nan"))
        # adding zero makes one value of 0.0 and -0.0
        rows = df.select(*keys, *[F.coalesce(qcol(c).cast("double") + F.lit(0.0), nan).alias(k) for k, c in names.items()])
        cut = {k: self.values[c] for k, c in names.items() if self.values[c]}
        if cut:
            rows = Bucketizer(splitsArray=[[-math.inf, *v, math.inf] for v in cut.values()], inputCols=list(cut),
                              outputCols=[f"b_{k}" for k in cut], handleInvalid="keep").transform(rows)

        def place(k: str):
            if k not in cut:
                return F.when(~F.isnan(k), F.lit(0))
            piece = F.col(f"b_{k}").cast("int")
            at = F.coalesce(F.get(F.array(*[F.lit(v) for v in cut[k]]), piece - 1) == F.col(k), F.lit(False))
            return F.when(~F.isnan(k), 2 * piece - at.cast("int"))

        places = rows.select(*keys, *[place(k).alias(k) for k in names])
        named = F.create_map(*[F.lit(x) for kc in names.items() for x in kc])
        long = places.unpivot(keys, list(names), "key", "place").where("place IS NOT NULL")
        counts = long.groupBy(*keys, "key", "place").agg(F.count(F.lit(1)).alias("n"))
        return counts.select(*keys, named[F.col("key")].alias("column"), "place", "n")

    def bounds(self, reference_counts: DataFrame, counts: DataFrame, group: str, p_threshold: float = DEFAULT_DRIFT_THRESHOLD) -> DataFrame:
        """(group, column, statistic, statistic_max, p_value, n_reference,
        n_current, drift_detected, decided) of every (group, column) in ``counts``."""
        ref = reference_counts.select("column", "place", F.col("n").alias("n_ref"))
        seen = counts.select(group, "column").distinct()
        # at most 2 * pieces + 1 places a column, copied to the groups
        both = seen.join(F.broadcast(ref), "column").select(group, "column", "place", "n_ref", F.lit(0).cast("long").alias("n_cur"))
        both = both.unionByName(counts.select(group, "column", "place", F.lit(0).cast("long").alias("n_ref"), F.col("n").alias("n_cur")))
        grid = both.groupBy(group, "column", "place").agg(F.sum("n_ref").alias("n_ref"), F.sum("n_cur").alias("n_cur"))
        whole = Window.partitionBy(group, "column")
        up = whole.orderBy("place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        for c in ("ref", "cur"):
            total = F.sum(f"n_{c}").over(whole)
            grid = grid.withColumn(f"tot_{c}", total).withColumn(f"up_{c}", F.try_divide(F.sum(f"n_{c}").over(up).cast("double"), total)) \
                .withColumn(f"low_{c}", F.try_divide((F.sum(f"n_{c}").over(up) - F.col(f"n_{c}")).cast("double"), total))
        least = F.abs(F.col("up_ref") - F.col("up_cur"))
        between = F.when(F.col("place") % 2 == 0, F.greatest(F.abs(F.col("up_ref") - F.col("low_cur")), F.abs(F.col("up_cur") - F.col("low_ref"))))
        out = grid.groupBy(group, "column").agg(F.max(least).alias("statistic"), F.max(F.greatest(least, between)).alias("statistic_max"),
                                                F.first("tot_ref").alias("n_reference"), F.first("tot_cur").alias("n_current"))
        p = ks_pvalue(F.col("statistic"), F.col("n_reference"), F.col("n_current"))
        surest = ks_pvalue(F.col("statistic_max"), F.col("n_reference"), F.col("n_current"))
        drift = F.coalesce(p < F.lit(p_threshold), F.lit(False))
        return out.select(group, "column", "statistic", "statistic_max", p.alias("p_value"), "n_reference", "n_current",
                          drift.alias("drift_detected"), (drift == F.coalesce(surest < F.lit(p_threshold), F.lit(False))).alias("decided"))
