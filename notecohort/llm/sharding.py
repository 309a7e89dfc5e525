"""Sharding on a consistent-hash ring with bounded loads (operator 1).

Every shard owns ``vnodes`` points of a 64-bit ring; a row hangs at the hash of its doc_id
and belongs to the next point clockwise.  A shard takes its own rows up to its capacity;
the rest of an arc continues clockwise to the next shard with room.  Capacities add up to
the number of rows, ``n // shards`` or one more, so counts are at most one apart (the law
``rows``), and only overflowing keys leave the place that a plain ring gives them.

Scale: the text is read once for its size and checksum.  Rows get their position on the
ring from a distributed range index, so that an arc is an interval of positions.  The ring
itself (``shards * vnodes`` arcs, a number that does not depend on the data) is filled on
the driver from one count per arc; the result is a table of position intervals, which is
joined back through a coarse bucket of the arc's number.  Nothing is gathered per shard.

Defined cases: a null text has size 1 (zero bytes plus one) and the checksum of the empty
string; a null doc_id hangs at a fixed place of the ring; equal doc_ids hang at one place
and are told apart by checksum and size; repeated rows are interchangeable and get
neighbouring slots; extra columns are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.index import with_row_index
from .common import mix64, saved

LAW = "rows"


def ring(shards: int, vnodes: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted points (int64) of the ring and the shard of each."""
    at = mix64(np.arange(1, shards * vnodes + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)).view(np.int64)
    order = np.argsort(at, kind="stable")
    return at[order], (np.arange(shards * vnodes) // vnodes)[order]


def fill(counts: np.ndarray, owner: np.ndarray, shards: int) -> list[tuple[int, int, int, int, int]]:
    """Bounded loads: ``(arc, from, to, shard, slot of from)`` over global row positions.

    Rows of arc k (those before its point) go to its owner while it has room; first every
    shard takes from its own arcs, then the rest of each arc walks on clockwise.
    """
    total, arcs = int(counts.sum()), len(counts)
    room = np.array([total // shards + (s < total % shards) for s in range(shards)])
    used = np.zeros(shards, np.int64)
    start = np.cumsum(counts) - counts
    out, rest = [], []

    def take(arc: int, lo: int, hi: int, shard: int) -> int:
        n = int(min(hi - lo, room[shard] - used[shard]))
        if n > 0:
            out.append((arc, lo, lo + n, shard, int(used[shard])))
            used[shard] += n
        return lo + max(n, 0)

    for k in range(arcs):
        lo, hi = int(start[k]), int(start[k] + counts[k])
        lo = take(k, lo, hi, owner[k])
        if lo < hi:
            rest.append((k, lo, hi))
    for k, lo, hi in rest:
        step = 1
        while lo < hi:
            lo = take(k, lo, hi, owner[(k + step) % arcs])
            step += 1
    return [(int(a), lo, hi, int(s), slot) for a, lo, hi, s, slot in out]


def bounded_ring(docs: DataFrame, shards: int = 16, vnodes: int = 128) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` for every row."""
    spark = docs.sparkSession
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       (F.octet_length(text) + 1).cast("long").alias("size"),
                       F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"))
    rows = saved(rows.withColumn("at", F.xxhash64(F.coalesce("doc_id", F.lit(0)), F.col("doc_id").isNull())), "ring-rows")
    # the last column only splits a range of identical rows over tasks
    placed = with_row_index(rows.withColumn("tie", F.monotonically_increasing_id()),
                            ["at", "doc_id", "text_crc32", "size", "tie"], "pos", written=True)
    points, owner = ring(shards, vnodes)
    # rows up to and including a point are its arc; those beyond the last point wrap to the first
    span = len(points) + 1
    table = spark.createDataFrame(
        [(i, int(points[i - 1]) if i else -(1 << 63), int(points[i]) if i < len(points) else (1 << 63) - 1)
         for i in range(span)], "arc int, after long, upto long")
    cells = table.select("arc", "after", "upto", F.explode(F.sequence(
        F.shiftright("after", 52), F.shiftright("upto", 52))).alias("cell"))
    inside = (F.col("at") <= F.col("upto")) & ((F.col("at") > F.col("after")) | ((F.col("arc") == 0) & (F.col("at") == F.col("after"))))
    arced = placed.withColumn("cell", F.shiftright("at", 52)).join(F.broadcast(cells), "cell")
    got = dict.fromkeys(range(span), 0) | {r["arc"]: r["n"] for r in arced.where(inside).groupBy("arc").agg(
        F.count(F.lit(1)).alias("n")).collect()}  # one row per arc at most
    plan = fill(np.array([got[i] for i in range(span)], np.int64), np.r_[owner, owner[:1]], shards)
    # a proven bound: an arc is split into at most ``shards`` intervals
    plan = spark.createDataFrame(plan, "arc int, lo long, hi long, shard int, slot0 long")
    return (arced.where(inside).join(F.broadcast(plan), "arc").where("pos >= lo AND pos < hi")
            .select("doc_id", "size", "text_crc32", F.lit(LAW).alias("law"), "shard",
                    (F.col("slot0") + F.col("pos") - F.col("lo")).alias("slot"), F.lit(None).cast("int").alias("grown_shard")))
