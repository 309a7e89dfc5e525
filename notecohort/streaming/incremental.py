"""H1: file-batch incremental note extraction.

The reference walks the note-text files three at a time, keeps rows whose key is still
wanted, joins them with metadata, and drops a key from the search once a batch has found
it.  Here that is a Structured Streaming query over the file source, the files
of some batches per micro-batch (``maxFilesPerTrigger``, ``availableNow``):

* a file's batch number is its rank by sorted path, not its time of arrival;
* the keys of a micro-batch, a small table, go to the wanted keys, to the keys found before and
  to the metadata, which are read but never moved for it;
* the first batch of each key so far is a table in levels (see ``levels``): a micro-batch
  reads the few runs there are for its own keys and writes a run of the keys it found first;
* a micro-batch takes the files of ``batches_per_trigger`` batches; batch numbers do not depend on
  it, as rows keep the number of their own file's batch;
* a micro-batch writes the rows of keys for which its files hold the first batch known,
  their findings, and (given metadata) their notes; a later file of an earlier batch may
  still win, so readers drop the rows of batches that lost;
* every output is a folder of the micro-batch's number that is overwritten on a replay;
* the query ends early once every wanted key is found, if files arrive in path order.
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.patterns import RULES
from ..operators.notes import FILES_PER_BATCH
from ..operators.sizing import write_table
from ..operators.staging import findings_table
from ..sources.readers import coarse_listing, file_ranks, with_file_ranks
from .levels import KeyLevels

TEXTS, FINDINGS, NOTES, KEYS = "texts", "findings", "notes", "keys"


def _in_path_order(spark: SparkSession, source_dir: str, glob: str) -> bool:
    """Whether each file is younger than the one before it in path order (the file source
    takes the oldest first)."""
    with coarse_listing(spark):
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(source_dir)
    before = F.lag("modificationTime").over(Window.orderBy("path"))  # one row per file
    return not files.select("path", "modificationTime").withColumn("_before", before).where(
        "_before >= modificationTime").limit(1).count()


def stream_first_batch(spark: SparkSession, source_dir: str, schema: StructType, wanted_keys: DataFrame,
                       out_dir: str, checkpoint_dir: str, key: str = "deid_note_key", text_col: str = "note_text",
                       files_per_batch: int = FILES_PER_BATCH, glob: str = "*.parquet", metadata: DataFrame | None = None,
                       rules=RULES, batches_per_trigger: int = 1) -> int:
    """Run the incremental extraction over the files present; returns the micro-batches run.

    A micro-batch costs a fixed number of jobs, so ``batches_per_trigger`` batches of small files
    go into one; a batch is never cut by the end of a micro-batch of files in path order.
    """
    out_dir = out_dir.rstrip("/")
    wanted = write_table(wanted_keys.select(key).where(F.col(key).isNotNull()).distinct(), "wanted-keys")
    ranks = write_table(file_ranks(spark, source_dir, glob, "_rank"), "file-ranks")  # every micro-batch asks for them
    levels = KeyLevels(spark, f"{out_dir}/{KEYS}", key)
    may_end, n_wanted = _in_path_order(spark, source_dir, glob), wanted.count()
    all_found, run = threading.Event(), []
    last = levels.last()
    found = levels.first_batches(last).count() if may_end and last >= 0 else 0
    if may_end and last >= 0 and found == n_wanted:
        return 0  # an earlier run found them all
    total = {last: found}  # keys found up to a micro-batch
    with coarse_listing(spark):
        stream = (spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch * batches_per_trigger)
                  .option("recursiveFileLookup", True).option("pathGlobFilter", glob).parquet(source_dir))
    located = with_file_ranks(stream.select("*", F.col("_metadata.file_path").alias("_path")), ranks, "_rank", "left")
    # a file that came after the listing belongs behind all others
    batch_no = F.floor(F.coalesce("_rank", F.lit((1 << 62) - 1)) / files_per_batch).cast("long")
    rows = located.withColumn("batch", batch_no).drop("_path", "_rank")

    def write_batch(batch: DataFrame, number: int) -> None:
        here = batch.sparkSession
        levels.sweep(number - 1)
        first = batch.where(F.col(key).isNotNull()).groupBy(key).agg(F.min("batch").alias("batch"))
        first = wanted.join(write_table(first, "batch-keys"), key).withColumn("fresh", F.lit(True))
        if number:
            first = write_table(first.drop("fresh"), "batch-keys")
            known = levels.read(0, number - 1).join(first.select(key), key, "left_semi").groupBy(key).agg(F.min("batch").alias("_known"))
            first = first.join(known, key, "left").where("_known IS NULL OR batch <= _known").select(
                key, "batch", F.col("_known").isNull().alias("fresh"))
        first = levels.add(number, first)
        texts = batch.join(first.drop("fresh"), [key, "batch"])
        texts.write.mode("overwrite").parquet(f"{out_dir}/{TEXTS}/part={number}")
        texts = here.read.schema(texts.schema).parquet(f"{out_dir}/{TEXTS}/part={number}")
        ids = [c for c in texts.columns if c != text_col]
        findings_table(texts, ids, text_col, rules).write.mode("overwrite").parquet(f"{out_dir}/{FINDINGS}/part={number}")
        if metadata is not None:  # C4 inside the batch
            # the keys of the micro-batch go to the metadata, which then is not moved as a whole
            here_too = metadata.join(first.select(key), key, "left_semi")
            texts.join(here_too, key).write.mode("overwrite").parquet(f"{out_dir}/{NOTES}/part={number}")
        run.append(number)
        if may_end:
            if number - 1 not in total:  # a replay of the last run
                total[number - 1] = levels.first_batches(number - 1).count() if number else 0
            total[number] = total[number - 1] + first.where("fresh").count()
            if total[number] == n_wanted:
                all_found.set()

    with coarse_listing(spark):  # the source lists the folder once and the files of each micro-batch
        query = (rows.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint_dir)
                 .trigger(availableNow=True).start())
        while not query.awaitTermination(1):
            if all_found.is_set():
                query.stop()
    return len(run)


def read_output(spark: SparkSession, out_dir: str, what: str = TEXTS, key: str = "deid_note_key") -> DataFrame:
    """The rows of an output (texts, findings or notes) that belong to their key's first batch.

    The batches that lost are looked up among the keys of the texts, so the rows themselves are
    not moved as long as the few keys that a later file improved can go to them.
    """
    out_dir = out_dir.rstrip("/")
    levels = KeyLevels(spark, f"{out_dir}/{KEYS}", key)
    if (last := levels.last()) < 0:
        raise FileNotFoundError(f"no finished batch in {out_dir}")
    written = spark.read.option("basePath", f"{out_dir}/{TEXTS}").parquet(f"{out_dir}/{TEXTS}").select(key, "batch").distinct()
    lost = write_table(written.join(levels.first_batches(last), [key, "batch"], "left_anti"), "lost-batches")
    rows = spark.read.option("basePath", f"{out_dir}/{what}").parquet(f"{out_dir}/{what}")
    return rows.drop("part").join(lost, [key, "batch"], "left_anti")
