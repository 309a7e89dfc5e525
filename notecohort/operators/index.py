"""A distributed, deterministic row index (position in a global order).

Used where the reference numbers rows of a sorted list (patient partition map, metadata
chunks).  No single-partition window: the data is range-partitioned and sorted, and the
same job writes each row with its partition id and position inside the partition to the
shared checkpoint folder (a fixed, re-readable result, so later counts and joins agree
even if tasks are re-run).  Partitions are counted, and each row gets
``offset(partition) + position``.  The offsets table has one row per partition, a proven
bound, and is broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .sizing import write_table


def range_sorted(df: DataFrame, order_cols: list[str], written: bool = False) -> DataFrame:
    """``df`` range-partitioned and sorted by ``order_cols``, with ``_pid`` and ``_local``.

    The range sampler runs its input once before the sort does, so the input is written
    first unless ``written`` says that it is a table already.  The number of ranges follows
    from the table's bytes (its scan splits), and is at least the shuffle setting.
    """
    source = df if written else write_table(df, "unsorted")
    n = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), source.rdd.getNumPartitions())
    # An explicit partition count: AQE does not coalesce it, so partition ids follow the
    # range order.
    ordered = source.repartitionByRange(n, *order_cols).sortWithinPartitions(*order_cols)
    pid = F.spark_partition_id()
    local = F.monotonically_increasing_id() - F.shiftleft(pid.cast("long"), 33)
    return ordered.select("*", pid.alias("_pid"), local.alias("_local"))


def with_row_index(df: DataFrame, order_cols: list[str], index_col: str = "row_index",
                   written: bool = False) -> DataFrame:
    """Add ``index_col`` = 0-based position of each row in ``order_cols`` ascending order.

    ``order_cols`` must order the rows totally (ties would make positions arbitrary).
    """
    stored = write_table(range_sorted(df, order_cols, written), "row-index")
    counts = stored.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_offset"))
    return (stored.join(F.broadcast(offsets), "_pid")
                  .withColumn(index_col, (F.col("_offset") + F.col("_local")).cast("long"))
                  .drop("_pid", "_local", "_offset"))
