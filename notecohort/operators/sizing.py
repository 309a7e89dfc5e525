"""Plan helpers: written tables, a filter that stays where it is put, an explicit spread."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import scratch_dir

#: Parquet codec of tables that are read again by the same job.
SCRATCH_CODEC = "zstd"


def write_table(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` as parquet under the shared checkpoint folder and read it back.

    Cuts lineage in one job (``Dataset.checkpoint`` computes its input twice unless it is
    cached first), survives executor loss, and gives the optimizer exact sizes (parquet
    footers) for later plans, so it picks broadcast joins from real bytes.  ``zstd`` takes about
    two thirds of the bytes of Spark's default for tables of texts.
    """
    path = scratch_dir(df.sparkSession, name)
    df.write.mode("overwrite").option("compression", SCRATCH_CODEC).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, partitions: int | None) -> DataFrame:
    """Round-robin ``df`` over ``partitions`` tasks, if a number is given.

    For inputs whose files hold one huge row group, which one task would read; tables with
    ordinary splits need none.
    """
    return df.repartition(partitions) if partitions else df


def table_bytes(df: DataFrame) -> int:
    """Bytes of the rows, not compressed: 8 a column, and those of strings."""
    strings = [F.coalesce(F.octet_length(f"`{c}`"), F.lit(0)).cast("long") for c, kind in df.dtypes if kind == "string"]
    return df.agg(F.sum(reduce(add, strings, F.lit(8 * len(df.columns)).cast("long")))).first()[0] or 0


def spread_coarse(scan: DataFrame, partitions: int | None) -> DataFrame:
    """``spread`` for a table just scanned, if fewer than half of ``partitions`` tasks would have rows.

    Splits are cut by bytes but only the one that holds a row group's middle gets its rows, so the
    tasks with rows are counted (no column is read).  A table of enough row groups is left as it
    is: spreading it would shuffle every byte of it once more.
    """
    if not partitions:
        return scan
    busy = scan.select(F.spark_partition_id().alias("task")).distinct().count()
    return spread(scan, partitions) if 2 * busy < partitions else scan


def filter_here(df: DataFrame, condition: Column) -> DataFrame:
    """``df.where(condition)``, evaluated at this point of the plan.

    Catalyst pushes a filter below projections by substituting their expressions, so a
    filter on a costly computed column (a chain of regex scans) would be re-inlined and
    computed twice.  A nondeterministic marker column (the partition id, always >= 0)
    referenced by the condition keeps the filter above the projection that computes it.
    """
    marked = df.withColumn("_here", F.spark_partition_id() >= 0)
    return marked.where(condition & F.col("_here")).drop("_here")
