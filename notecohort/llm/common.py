"""Helpers shared by the training-data operators: written tables, a hash for packed keys,
connected components over an edge table, and star-shaped contraction of links in a task."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_dir, ship_package

#: White space of the word and line contracts.
SPACE = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"


#: What is handed to a Python worker at once, at most; long texts make large batches.
BATCH_BYTES, BATCH_ROWS = 4 << 20, 2000
_BYTES, _ROWS = "spark.sql.execution.arrow.maxBytesPerBatch", "spark.sql.execution.arrow.maxRecordsPerBatch"


def prepare(spark: SparkSession) -> SparkSession:
    """Ship the package to the Python workers and bound their batches for the rest of the session
    (a smaller setting of the session's own stays)."""
    ship_package(spark)
    to_bytes = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes  # "64m" and the like
    if not 0 < to_bytes(spark.conf.get(_BYTES)) <= BATCH_BYTES:
        spark.conf.set(_BYTES, f"{BATCH_BYTES}b")
    if not 0 < int(spark.conf.get(_ROWS)) <= BATCH_ROWS:
        spark.conf.set(_ROWS, str(BATCH_ROWS))
    return spark


#: How rows of a megabyte are written.  Parquet looks at the sizes of pages and row groups only
#: every 100 rows unless told to, and its readers and codecs hold whole pages and row groups.
WIDE_ROWS = {"parquet.block.size": str(8 << 20), "parquet.page.size.row.check.min": "1", "parquet.page.size.row.check.max": "4",
             "parquet.enable.dictionary": "false"}


def saved(df: DataFrame, name: str, options: dict[str, str] | None = None) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    Cuts the lineage, gives later stages exact sizes, and survives the loss of executors.
    """
    path = scratch_dir(prepare(df.sparkSession), name)
    df.write.mode("overwrite").options(**(options or {})).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def give_back() -> None:
    """Hand a worker's unused memory back to the system at the end of a task: idle workers live
    on beside the tasks of later stages."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc alone has it
    if trim is not None:
        trim(0)


def shuffle_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (uint64 in, uint64 out)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def star(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Component label (smallest index) of 0..n-1 under the links a[i]-b[i]."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        label = label[label]
        if np.array_equal(before, label):
            break
    return label


def components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 200) -> DataFrame:
    """``(node, label)`` for every node of ``edges``; label is the smallest node reachable.

    Alternating large-star and small-star rounds: a round takes the smallest neighbour of
    each node (partial aggregation) and hangs the other neighbours on it, so the edge
    count never grows and the depth falls by a constant factor.  Each round is a written
    table; nothing is gathered to the driver but a three-number checksum.
    """
    u, v = F.greatest(a, b).alias("u"), F.least(a, b).alias("v")
    now = saved(edges.where(F.col(a) != F.col(b)).select(u, v).distinct(), "edges")
    last = None
    for _ in range(max_rounds):
        mark = now.agg(F.count(F.lit(1)), F.sum(F.hash("u", "v").cast("long")),
                       F.sum(F.hash("v", "u").cast("long"))).first()
        if mark == last or not mark[0]:
            break
        last = mark
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        rest = large.join(low, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = saved(rest.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "edges")
    else:
        raise RuntimeError("components: no fixed point within max_rounds")
    return now.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())


def runs(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[tuple, pa.Table]]:
    """The stretches of sorted rows that agree in the first ``keys`` columns (integers, no
    nulls), across batches; one stretch is held at a time."""
    held: list[pa.RecordBatch] = []
    now: tuple | None = None
    for b in batches:
        if not b.num_rows:
            continue
        cols = [b.column(k).to_numpy(zero_copy_only=False) for k in range(keys)]
        new = np.zeros(b.num_rows, bool)
        for c in cols:
            new[1:] |= c[1:] != c[:-1]
        cuts = np.r_[0, np.nonzero(new)[0], b.num_rows]
        for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            key = tuple(c[lo].item() for c in cols)
            if key != now and held:
                yield now, pa.Table.from_batches(held)
                held = []
            now = key
            held.append(b.slice(lo, hi - lo))
    if held:
        yield now, pa.Table.from_batches(held)


def matrix(column: pa.ChunkedArray) -> np.ndarray:
    """Equal-length lists of numbers as a float64 matrix."""
    flat = column.combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def usable(vector: Column) -> Column:
    """Whether a vector takes part: not null, not empty or zero, all components finite."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(~bad & F.exists(vector, lambda x: x != 0), F.lit(False))
