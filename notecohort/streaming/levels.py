"""The first batch of each key, as a table in levels that a stream adds to.

A micro-batch writes one run: the keys that it found first, with their batch.  When ``FAN``
runs of a level are there they are merged into one run of the next level, as the digits of a
number carry, so a key is written once in every level (a logarithm of the micro-batches) and
a micro-batch writes as many bytes as it has new keys, but for the merges.  At any time at
most ``FAN - 1`` runs a level are read.

A run is a folder ``{level}-{first}-{last}`` named by the micro-batches it covers and counts
once it has its ``_SUCCESS``.  A replayed micro-batch overwrites its own run and merges; runs
that a merge has replaced go only when the next micro-batch begins, as a replay needs them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.readers import _fs_glob

FAN = 8


class KeyLevels:
    def __init__(self, spark: SparkSession, root: str, key: str, fan: int = FAN):
        self.spark, self.root, self.key, self.fan = spark, root.rstrip("/"), key, fan

    def runs(self) -> list[tuple[int, int, int]]:
        """``(level, first, last)`` of every finished run."""
        names = [p.rsplit("/", 2)[1] for p in _fs_glob(self.spark, f"{self.root}/*/_SUCCESS")]
        return sorted(tuple(map(int, name.split("-"))) for name in names)

    def last(self) -> int:
        """The last micro-batch with a finished run, -1 if there is none."""
        return max((hi for _, _, hi in self.runs()), default=-1)

    def cover(self, first: int, last: int) -> list[str]:
        """The fewest finished runs that hold the micro-batches from ``first`` to ``last``."""
        found, at, known = [], first, self.runs()
        while at <= last:
            fits = [r for r in known if r[1] == at and r[2] <= last]
            if not fits:
                raise RuntimeError(f"{self.root}: no finished run begins at micro-batch {at}")
            run = max(fits, key=lambda r: r[2])
            found.append(f"{self.root}/{run[0]}-{run[1]}-{run[2]}")
            at = run[2] + 1
        return found

    def read(self, first: int, last: int) -> DataFrame:
        """``key, batch``; a key stands in several runs if a later one found an earlier batch."""
        return self.spark.read.schema(f"`{self.key}` string, batch long").parquet(*self.cover(first, last))

    def first_batches(self, last: int) -> DataFrame:
        return self.read(0, last).groupBy(self.key).agg(F.min("batch").alias("batch"))

    def add(self, number: int, found: DataFrame) -> DataFrame:
        """Write the run of a micro-batch, then the merges that it completes; returns the run."""
        path = f"{self.root}/0-{number}-{number}"
        rows = found.select(F.col(self.key).cast("string").alias(self.key), "batch", "fresh")
        rows.write.mode("overwrite").parquet(path)
        level, span = 1, self.fan
        while (number + 1) % span == 0:
            first = number + 1 - span
            merged = self.read(first, number).groupBy(self.key).agg(F.min("batch").alias("batch"))
            merged.write.mode("overwrite").parquet(f"{self.root}/{level}-{first}-{number}")
            level, span = level + 1, span * self.fan
        return self.spark.read.schema(rows.schema).parquet(path)

    def sweep(self, number: int) -> None:
        """Remove the runs that a merge up to micro-batch ``number``, which is committed, replaced."""
        known = self.runs()
        for level, first, last in known:
            if any(up > level and lo <= first and last <= hi <= number for up, lo, hi in known):
                path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{level}-{first}-{last}")
                path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
