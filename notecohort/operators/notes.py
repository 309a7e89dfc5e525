"""Note operators: metadata/encounter and text/metadata joins, key filters, note-type
filter, first-batch-wins de-duplication, chunk numbers, coverage and row-count reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import non_blank
from .index import with_row_index
from .sizing import filter_here, table_bytes

# The note types worth extracting (the reference's to-do list, in its order).
ALLOWED_NOTE_TYPES = ("Progress Notes", "Imaging", "Consults", "Plan of Care", "Lab", "Interdisciplinary",
                      "H&P", "Assessment & Plan Note", "Pathology and Cytology", "Discharge Summary",
                      "Operative Report", "Significant Event")
# Metadata columns read, encounter columns carried into the join, rows per chunk,
# text files per batch.
METADATA_COLUMNS = ("patientdurablekey", "patientepicid", "encounterkey", "deid_note_key", "deid_note_id",
                    "note_type")
ENCOUNTER_JOIN_COLUMNS = ("patientdurablekey", "encounterkey", "datekeyvalue", "enddatekeyvalue")
CHUNK_ROWS = 100_000
FILES_PER_BATCH = 3
# Bytes of rows, not compressed, that a bucket holds: a task sorts one bucket.
BUCKET_BYTES = 256 << 20


def prune_metadata(metadata: DataFrame) -> DataFrame:
    """A4: only the six metadata columns (Catalyst prunes the scan to them)."""
    return metadata.select(*METADATA_COLUMNS)


def join_metadata_encounters(metadata: DataFrame, encounters: DataFrame) -> DataFrame:
    """Inner join on ``encounterkey`` only.

    Both sides carry a patient key; the metadata's stays ``patientdurablekey`` and the
    encounter's becomes ``encounter_patientdurablekey`` (rows where they disagree are
    kept, as in the reference).  Null keys never match: pairing every null with every null
    would be a product in one task.  Repeated encounter rows multiply.  The shuffle join gets
    AQE skew splitting; the runtime bloom filter prunes the metadata scan by the (smaller)
    encounter side.
    """
    enc = encounters.select(
        F.col("encounterkey").alias("_ek"),
        F.col("patientdurablekey").alias("encounter_patientdurablekey"),
        "datekeyvalue", "enddatekeyvalue")
    meta = prune_metadata(metadata)
    return meta.join(enc, meta["encounterkey"] == enc["_ek"], "inner").drop("_ek")


def distinct_note_keys(metadata: DataFrame, key: str = "deid_note_key") -> DataFrame:
    """Distinct non-null note keys."""
    return metadata.select(key).where(F.col(key).isNotNull()).distinct()


def filter_note_text(note_text: DataFrame, keys: DataFrame, key: str = "deid_note_key") -> DataFrame:
    """B2: texts whose key is wanted; a semi join, never ``isin`` over a collected list."""
    k = keys.select(key).where(F.col(key).isNotNull()).distinct()
    return note_text.join(k, key, "left_semi")


def join_text_metadata(note_text: DataFrame, metadata: DataFrame, key: str = "deid_note_key") -> DataFrame:
    """C4: inner join on the note key; several metadata rows per text multiply."""
    return note_text.join(metadata, key, "inner")


def unmatched_note_keys(keys: DataFrame, note_text: DataFrame, key: str = "deid_note_key") -> DataFrame:
    """Wanted note keys with no text."""
    k = keys.select(key).where(F.col(key).isNotNull()).distinct()
    return k.join(note_text.select(key), key, "left_anti")


def nonblank_notes(notes: DataFrame, text_col: str = "note_text") -> DataFrame:
    """Drop null and white-space-only texts (Unicode white space)."""
    return notes.where(non_blank(F.col(text_col)))


def note_type_filter(notes: DataFrame, allowed=ALLOWED_NOTE_TYPES, col: str = "note_type") -> DataFrame:
    """Keep the listed note types (a constant list, so ``isin`` is right here)."""
    return notes.where(F.col(col).isin(list(allowed)))


def first_batch_notes(notes: DataFrame, metadata: DataFrame, key: str = "deid_note_key",
                      file_rank_col: str = "file_no", files_per_batch: int = FILES_PER_BATCH) -> DataFrame:
    """E3 + C4: the winning text rows of each file batch joined with their metadata, with
    ``batch``; one batch of the reference's output is the rows of one ``batch`` value."""
    return first_batch_wins(notes, metadata, key, file_rank_col, files_per_batch).join(metadata, key, "inner")


def with_file_batch(notes: DataFrame, file_rank_col: str = "file_no",
                    files_per_batch: int = FILES_PER_BATCH) -> DataFrame:
    """Batch number of each text row: its file's rank (by sorted path) div ``files_per_batch``."""
    return notes.withColumn("batch", F.floor(F.col(file_rank_col) / files_per_batch).cast("long"))


def first_batch_wins(notes: DataFrame, keys: DataFrame | None = None, key: str = "deid_note_key",
                     file_rank_col: str = "file_no", files_per_batch: int = FILES_PER_BATCH) -> DataFrame:
    """A key found in one batch of files is not taken from later batches; every row of
    the key inside the winning batch stays.

    The earliest batch per key is a partial aggregation (a hot key is combined map-side).  Rows
    meet it by the key, as they met the wanted keys and may meet metadata next, so the texts are
    moved once for all of these; the batches are compared after the join.
    """
    rows = with_file_batch(notes, file_rank_col, files_per_batch)
    if keys is not None:
        rows = filter_note_text(rows, keys, key)
    first = rows.groupBy(key).agg(F.min("batch").alias("_first"))
    # not a join on (key, batch), for which the texts would be moved again
    won = filter_here(rows.join(first, key, "inner"), F.col("batch") == F.col("_first"))
    return won.select(key, "batch", *[c for c in rows.columns if c not in (key, "batch")])


def note_key_coverage(notes: DataFrame, keys: DataFrame, key: str = "deid_note_key",
                      file_rank_col: str = "file_no", files_per_batch: int = FILES_PER_BATCH) -> DataFrame:
    """Per file batch, keys newly found, running total, wanted total and percent.

    One row per batch: the running sum is a window over the (tiny) per-batch table.
    """
    wanted = keys.select(key).where(F.col(key).isNotNull()).distinct()
    rows = with_file_batch(notes.select(key, file_rank_col), file_rank_col, files_per_batch)
    found = rows.join(wanted, key, "left_semi").groupBy(key).agg(F.min("batch").alias("batch"))
    per_batch = found.groupBy("batch").agg(F.count(F.lit(1)).alias("found_new"))
    n_wanted = wanted.agg(F.count(F.lit(1)).alias("wanted"))  # one row
    w = Window.orderBy("batch").rowsBetween(Window.unboundedPreceding, 0)
    running = per_batch.withColumn("found_total", F.sum("found_new").over(w))
    return (running.join(F.broadcast(n_wanted))
                   .withColumn("percent", F.when(F.col("wanted") > 0,
                                                 F.col("found_total").cast("double") / F.col("wanted") * 100.0)
                               .otherwise(F.lit(0.0))))


def chunk_assign(rows: DataFrame, order_cols: list[str], chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """``chunk_no`` = position in ``order_cols`` order div ``chunk_rows`` + 1."""
    indexed = with_row_index(rows, order_cols, "_pos")
    return indexed.withColumn("chunk_no", (F.floor(F.col("_pos") / chunk_rows) + 1).cast("long")).drop("_pos")


def bucket_count(*tables: DataFrame, least: int = 1, bucket_bytes: int = BUCKET_BYTES) -> int:
    """Buckets for tables that are joined bucket by bucket, so that one holds about ``bucket_bytes`` of
    the largest table at any size (8 bytes a column, and those of strings); a power of two times ``least``."""
    most = max(table_bytes(t) for t in tables)
    buckets = least
    while buckets * bucket_bytes < most:
        buckets *= 2
    return buckets


def write_bucketed(rows: DataFrame, table: str, key: str, buckets: int, path: str) -> DataFrame:
    """``rows`` as a table in ``buckets`` buckets of ``key``, sorted in each, with its files under
    ``path``; written once, it is joined by ``key`` in every later run without a shuffle.

    Rows are dealt by the key before the write, so a bucket is one file.
    """
    dealt = rows.repartition(buckets, key)
    dealt.write.mode("overwrite").bucketBy(buckets, key).sortBy(key).option("path", path).format("parquet").saveAsTable(table)
    return rows.sparkSession.table(table)


def sample_keys(rows: DataFrame, keys: list[str], n: int = 3) -> DataFrame:
    """E5: the first ``n`` keys in key order (the limit is the feature: a head sample)."""
    return rows.select(*keys).orderBy(*keys).limit(n)


class StepCounts:
    """D3: row counts of named steps, gathered while the steps run (``observe``): no step is
    executed a second time to be counted.

    ``of(name, df)`` gives the step to go on with.  ``table()`` waits for an action that runs
    all steps and gives one row per step, in the order in which they were named.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.seen: dict[str, Observation] = {}

    def of(self, name: str, step: DataFrame) -> DataFrame:
        self.seen[name] = Observation(name)
        return step.observe(self.seen[name], F.count(F.lit(1)).alias("row_count"))

    def table(self) -> DataFrame:
        rows = [(name, seen.get["row_count"]) for name, seen in self.seen.items()]
        return self.spark.createDataFrame(rows, "step string, row_count long")
