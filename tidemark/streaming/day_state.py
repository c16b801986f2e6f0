"""Counts a day, kept as a table over micro-batches in a bounded number of files.

    <path>/batches/batch_id=<id>/d=<day>/       one micro-batch's counts
    <path>/generations/g=<n>/d=<day>/           counts folded so far
    <path>/manifest-<n>                         which generation holds a day, and
                                                the last batch that is folded

A replayed batch overwrites its own folder, so it counts once. Every
``fold_after`` batches the days that these touched are added up into a new
generation; days they did not touch stay where they are. The new manifest
appears by one rename, and only then are the folded batches and the day folders
that nothing refers to any more deleted. A fold takes batches before the current
one only, so the one batch that may be replayed is never folded. After a crash
between any two steps the newest manifest still names a whole state; leftovers go
with the next fold.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources import files


class DayState:
    """``schema``: the columns of a count apart from ``day`` and ``n``.
    ``combine`` joins the counts of several batches: ``F.sum`` for additions,
    ``F.max`` for counts that only grow."""

    def __init__(self, spark: SparkSession, path: str, schema: str, combine: Callable[[str], Column] = F.sum, fold_after: int = 16):
        if fold_after < 1:
            raise ValueError("fold_after must be at least 1")
        self.spark, self.path, self.combine, self.fold_after = spark, path.rstrip("/"), combine, fold_after
        self.schema = f"{schema}, day date, n long"
        self.keys = ["day", *[part.split()[0] for part in schema.split(",")]]

    def add(self, batch_id: int, counts: DataFrame) -> DataFrame:
        """Store a micro-batch's counts (rows without a day are left out) and
        return the counts so far of the days it holds."""
        own = f"{self.path}/batches/batch_id={batch_id}"
        self._write(counts.where(F.col("day").isNotNull()), own)
        self._fold(batch_id)
        manifest = self._manifest()
        return self._combined(self._days(own), manifest, self._live(manifest))

    def totals(self) -> DataFrame:
        """The counts so far of all days."""
        manifest = self._manifest()
        live = self._live(manifest)
        return self._combined(sorted({*manifest["days"], *self._days_of(live)}), manifest, live)

    def _write(self, counts: DataFrame, path: str) -> None:
        rows = counts.select(*self.keys, "n").withColumn("d", F.col("day").cast("string"))
        rows.write.mode("overwrite").partitionBy("d").parquet(path)

    def _manifest(self) -> dict:
        numbers = [int(n[9:]) for n in files.names(self.spark, self.path) if n.startswith("manifest-") and n[9:].isdigit()]
        if not numbers:
            return {"generation": 0, "through": -1, "days": {}}
        return json.loads(self.spark.read.text(f"{self.path}/manifest-{max(numbers)}", wholetext=True).first()[0])

    def _days(self, folder: str) -> list[str]:
        return [n[2:] for n in files.names(self.spark, folder) if n.startswith("d=")]

    def _days_of(self, batches: list[int]) -> set[str]:
        return {d for b in batches for d in self._days(f"{self.path}/batches/batch_id={b}")}

    def _batches(self) -> list[int]:
        return sorted(int(n[9:]) for n in files.names(self.spark, f"{self.path}/batches") if n.startswith("batch_id="))

    def _live(self, manifest: dict) -> list[int]:
        """Batches that are not folded."""
        return [b for b in self._batches() if b > manifest["through"]]

    def _combined(self, days: list[str], manifest: dict, batches: list[int]) -> DataFrame:
        paths = [f"{self.path}/generations/g={manifest['days'][d]}/d={d}" for d in days if d in manifest["days"]]
        for b in batches:
            folder = f"{self.path}/batches/batch_id={b}"
            paths += [f"{folder}/d={d}" for d in sorted(set(self._days(folder)) & set(days))]
        if not paths:
            return self.spark.createDataFrame([], self.schema).select(*self.keys, "n")
        return self.spark.read.schema(self.schema).parquet(*paths).groupBy(*self.keys).agg(self.combine("n").alias("n"))

    def _fold(self, before: int) -> None:
        manifest = self._manifest()
        batches = [b for b in self._live(manifest) if b < before]
        if len(batches) < self.fold_after:
            return
        days, number = sorted(self._days_of(batches)), manifest["generation"] + 1
        if days:
            self._write(self._combined(days, manifest, batches), f"{self.path}/generations/g={number}")
        folded = {"generation": number, "through": batches[-1], "days": {**manifest["days"], **dict.fromkeys(days, number)}}
        files.publish(self.spark, f"{self.path}/manifest-{number}", json.dumps(folded))
        self._retire(folded)

    def _retire(self, manifest: dict) -> None:
        """Delete what the manifest does not refer to."""
        gone = [f"batches/batch_id={b}" for b in self._batches() if b <= manifest["through"]]
        gone += [n for n in files.names(self.spark, self.path) if n.startswith("manifest-") and n != f"manifest-{manifest['generation']}"]
        for name in files.names(self.spark, f"{self.path}/generations"):
            folder = f"generations/{name}"
            held = [d for d in self._days(f"{self.path}/{folder}") if f"g={manifest['days'].get(d)}" == name]
            others = [f"{folder}/d={d}" for d in self._days(f"{self.path}/{folder}") if d not in held]
            gone += others if held else [folder]
        for name in gone:
            files.delete(self.spark, f"{self.path}/{name}")
