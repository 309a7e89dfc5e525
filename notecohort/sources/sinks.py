"""Sinks: partitioned, chunked, twin parquet+CSV, fixed-schema findings, CSV, combined
batch results, and stage resume markers."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.notes import chunk_assign
from ..operators.sizing import write_table
from .readers import _fs_glob, list_files

# Rows that a task which writes several chunks takes at most, if a chunk is not larger.
TASK_ROWS = 1_000_000
FINDINGS_COLUMNS = ("patientdurablekey", "stage", "system", "evidence")


def write_partitioned(df: DataFrame, path: str, col: str = "partition_key", mode: str = "overwrite") -> None:
    """Hive-style ``col=value/`` folders.  Rows are clustered by the partition column
    first so each task writes few folders; the rebalance hint lets AQE split a hot value."""
    df.hint("rebalance", col).write.mode(mode).partitionBy(col).parquet(path)


def read_partitioned(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """Read back an A8 table; the partition column stays a string (no type inference)."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.option("basePath", path).parquet(path)


def write_chunked(df: DataFrame, path: str, chunk_rows: int = 100_000, mode: str = "overwrite") -> None:
    """Files of at most ``chunk_rows`` rows each."""
    df.write.mode(mode).option("maxRecordsPerFile", chunk_rows).parquet(path)


def write_chunk_files(df: DataFrame, path: str, order_cols: list[str], chunk_rows: int = 100_000, mode: str = "overwrite") -> None:
    """A9 with E2: numbered files, ``part-00000`` being chunk 1, each of exactly ``chunk_rows`` rows
    in ``order_cols`` order but the last, which holds the rest.

    Rows go to the task of their chunk number.  Of more chunks than shuffle partitions a task takes
    several in a row, up to ``TASK_ROWS`` rows, and cuts its rows into files of ``chunk_rows``
    (``part-00000-…-c000``, ``-c001``, …, then ``part-00001-…-c000``): a task a chunk would be as many
    shuffle blocks as chunks times map tasks.
    """
    numbered = write_table(chunk_assign(df, order_cols, chunk_rows), "numbered-chunks")
    last = numbered.agg(F.max("chunk_no")).first()[0] or 1
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    each = max(1, min(-(-last // tasks), TASK_ROWS // chunk_rows))
    dealt = numbered.repartitionById(-(-last // each), F.floor((F.col("chunk_no") - 1) / each).cast("int"))
    dealt.sortWithinPartitions("chunk_no", *order_cols).drop("chunk_no").write.mode(mode).option("maxRecordsPerFile", chunk_rows).parquet(path)


def read_chunk_files(spark: SparkSession, path: str) -> DataFrame:
    """The rows of ``write_chunk_files`` with ``chunk_no``, the number of the file they stand in."""
    of_name = lambda name, what: F.regexp_extract(name, what, 1).cast("long")
    task, file = r"^part-(\d+)", r"-c(\d+)\."
    names = list_files(spark, path).select(F.element_at(F.split("_path", "/"), -1).alias("name"))
    each = names.agg(F.max(of_name("name", file))).first()[0] + 1  # all tasks but the last wrote so many files
    name = F.col("_metadata.file_name")
    return spark.read.parquet(path).withColumn("chunk_no", of_name(name, task) * each + of_name(name, file) + 1)


def write_results(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """A10: the same rows to ``{path}.parquet/`` and ``{path}.csv/`` (header, no index).

    The CSV is made from the parquet just written, so nothing is computed twice.
    """
    base = path.removesuffix(".parquet")
    df.write.mode(mode).parquet(f"{base}.parquet")
    df.sparkSession.read.schema(df.schema).parquet(f"{base}.parquet").write.mode(mode).option("header", True).csv(f"{base}.csv")


def write_findings(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """The fixed schema of four string columns."""
    df.select(*[F.col(c).cast("string").alias(c) for c in FINDINGS_COLUMNS]).write.mode(mode).parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Header CSV (a folder of part files; Spark never funnels it through one task)."""
    df.write.mode(mode).option("header", True).csv(path)


def combine_results(spark: SparkSession, path: str, glob: str = "staging_results_batch_*") -> DataFrame:
    """All batch result tables under ``path`` as one table (UNION ALL by name)."""
    matches = _fs_glob(spark, f"{path.rstrip('/')}/{glob}")
    if not matches:
        raise FileNotFoundError(f"No result tables matching {glob!r} in {path}")
    return spark.read.option("mergeSchema", True).parquet(*matches)


MANIFEST = "_MANIFEST.json"


def stage_manifest(spark: SparkSession, inputs: Sequence[str] = (), params: dict | None = None) -> dict:
    """What a stage's output depends on: its parameters, and of each input folder the number of
    files, their bytes and a digest over all paths, sizes and times (listed by Spark, not read)."""
    listed = {}
    for path in inputs:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "length", "modificationTime")
        one = files.agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"),
                        F.bit_xor(F.xxhash64("path", "length", "modificationTime")).alias("digest")).first()
        listed[path] = [one["files"], one["bytes"], one["digest"]]
    return {"inputs": listed, "params": params or {}}


def _manifest_file(spark: SparkSession, path: str):
    file = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{MANIFEST}")
    return file, file.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def stage_done(spark: SparkSession, path: str, manifest: dict | None = None) -> bool:
    """A stage's output is complete when its ``_SUCCESS`` marker exists and, given a
    manifest, when it was made from just those inputs and parameters."""
    if not _fs_glob(spark, f"{path.rstrip('/')}/_SUCCESS"):
        return False
    if manifest is None:
        return True
    file, fs = _manifest_file(spark, path)
    if not fs.exists(file):
        return False
    stored = spark.sparkContext._jvm.org.apache.hadoop.io.IOUtils.readFullyToByteArray(fs.open(file))  # some hundred bytes
    return bytes(stored).decode("utf-8") == json.dumps(manifest, sort_keys=True)


def run_stage(spark: SparkSession, path: str, build: Callable[[], DataFrame],
              write: Callable[[DataFrame, str], None] | None = None,
              inputs: Sequence[str] | None = None, params: dict | None = None) -> bool:
    """Build and write a stage unless its output is already complete.

    Returns True when the stage ran, False when it was skipped.  A rerun starts at the first
    stage without a ``_SUCCESS`` marker.  With ``inputs`` (folders that the stage reads) or
    ``params``, a manifest is kept beside the output, and a changed input or parameter makes
    the stage run again; its new files then make the stages after it, which list its folder
    among their inputs, run again too.
    """
    manifest = None if inputs is None and params is None else stage_manifest(spark, inputs or (), params)
    if stage_done(spark, path, manifest):
        return False
    (write or (lambda d, p: d.write.mode("overwrite").parquet(p)))(build(), path)
    if manifest is not None:
        file, fs = _manifest_file(spark, path)
        out = fs.create(file, True)
        out.write(bytearray(json.dumps(manifest, sort_keys=True).encode("utf-8")))
        out.close()
    return True
