"""The query registry: one Spark plan per operator of the inventory, each over the
fixture views of a test-data folder, with its DuckDB oracle SQL."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import cached_property

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.patterns import BASIC_RULES, RULES, RULES_BY_NAME, TITLE, Rule, rule_set
from ..functions.prompts import CHAT_TEMPLATE, FINDINGS_TEMPLATE, render
from ..functions.responses import parse_response
from ..operators import batching, cohort, notes, staging, timeline
from ..operators.inference import infer
from ..operators.sizing import SCRATCH_CODEC, write_table
from ..session import ensure_checkpoint_dir, scratch_dir, ship_package
from ..sources import readers, sinks
from ..streaming import incremental
from . import oracle as O
from .fixtures import Fixtures, with_fixture_ctes
from .models import failing_model_factory, keyword_model_factory, word_counter_factory

# A context for G3 that some patients pass by estimate and miss by count.
TOKEN_LIMIT = 2000
# A user override for G1: components must be adjacent and comma-separated, and a new rule.
OVERRIDES = {
    "tnm_components": r"\b(T[0-4isX]{1,3}),\s*(N[0-3MX]{1,3}),\s*(M[0-1X]{1})\b",
    "stage_arabic": Rule("stage_arabic", r"\b(Stage\s+[1-4][A-C]?)\b", "General", TITLE),
}


class Chain:
    """The cohort chain over the fixtures: ids -> durable keys -> encounters -> metadata
    -> texts -> notes.  Each step is a lazy DataFrame built once per chain."""

    def __init__(self, spark: SparkSession, sf_dir: str, partitions: int | None = None):
        self.spark = spark
        self.fx = Fixtures(spark, sf_dir, partitions)

    @cached_property
    def mapped_counts(self) -> DataFrame:
        return cohort.map_ids(self.fx.patient_ids, self.fx.patdurabledim, keep_counts=True)

    @cached_property
    def mapped(self) -> DataFrame:
        return self.mapped_counts.drop("rows_in_file")

    @cached_property
    def cohort_keys(self) -> DataFrame:
        """Written once: several steps use it, and a plan over two encounter tables twice."""
        return write_table(cohort.cohort_keys(self.mapped), "cohort-keys")

    @cached_property
    def enc(self) -> DataFrame:
        return cohort.filter_encounters(self.fx.encounterfact, self.cohort_keys)

    @cached_property
    def enc_stage(self) -> DataFrame:
        """Step-1 output as the later steps use it (cheap to recompute: one scan and a
        semi-join, so it is not written)."""
        return self.enc

    @cached_property
    def meta_enc(self) -> DataFrame:
        return notes.join_metadata_encounters(self.fx.note_metadata, self.enc_stage)

    @cached_property
    def meta_stage(self) -> DataFrame:
        """Step-2 output (filtered metadata), written once for its two consumers."""
        return write_table(self.meta_enc, "filtered-metadata")

    @cached_property
    def note_keys(self) -> DataFrame:
        return write_table(notes.distinct_note_keys(self.meta_stage), "note-keys")

    @cached_property
    def texts(self) -> DataFrame:
        return notes.filter_note_text(self.fx.note_text, self.note_keys)

    @cached_property
    def notes(self) -> DataFrame:
        return notes.join_text_metadata(self.texts, self.meta_stage)

    @cached_property
    def text_findings(self) -> DataFrame:
        return staging.findings_table(self.texts, TEXT_ROW)


CHUNK_ORDER = ["deid_note_id", "deid_note_key", "note_type", "patientdurablekey", "patientepicid", "encounterkey",
               "encounter_patientdurablekey", "datekeyvalue", "enddatekeyvalue"]
# A text row is known by its key and its number: a key may have several text rows.
TEXT_ROW = ["deid_note_key", "note_no"]
# Small enough that the fixtures give several partitions and chunks.
PER_PARTITION, CHUNK_ROWS = 100, 1000
# The least number of buckets; larger tables get more (``notes.bucket_count``).
BUCKETS = 8
# Rows of a file where the fixtures are written as files: their number grows with the table.
ROWS_PER_FILE = 150
# Such files that a task writes, if there are more than shuffle partitions.
FILES_PER_TASK = 100
# Batches of such files that a micro-batch of the streams takes (1,200 files, 180,000 rows).
BATCHES_PER_TRIGGER = 400
# Rows of a row group in the files of which one is broken.
GROUP_ROWS = 10
# A date key that some encounters come before.
SINCE = 19980101
NOTE_OUT = ["deid_note_key", "deid_note_id", "patientdurablekey", "note_type", "stage", "system"]


# ---- Spark side ---------------------------------------------------------------------------------
def q_encounter_projection(c: Chain) -> DataFrame:
    return c.fx.encounterfact.select(*cohort.ENCOUNTER_COLUMNS)


def q_id_mapping(c: Chain) -> DataFrame:
    return c.mapped.select("person_source_value", "patientdurablekey")


def q_id_match_report(c: Chain) -> DataFrame:
    return cohort.id_match_report(c.mapped_counts)


def q_unmatched_ids(c: Chain) -> DataFrame:
    best = cohort.best_dim_rows(c.fx.patdurabledim, c.fx.patient_ids)
    return cohort.unmatched_ids(c.fx.patient_ids, best)


def q_encounter_cohort(c: Chain) -> DataFrame:
    return c.enc


def q_partition_assign(c: Chain) -> DataFrame:
    # all encounters: those of patients outside the list go to the unknown partition
    return cohort.partition_assign(c.fx.encounterfact.select(*cohort.ENCOUNTER_COLUMNS), c.cohort_keys, per_partition=PER_PARTITION)


def q_sample_keys(c: Chain) -> DataFrame:
    return notes.sample_keys(c.enc, ["patientdurablekey", "encounterkey"])


def q_scan_pruned_metadata(c: Chain) -> DataFrame:
    return notes.prune_metadata(c.fx.note_metadata)


def q_metadata_encounter_join(c: Chain) -> DataFrame:
    return c.meta_enc


def q_chunk_assign(c: Chain) -> DataFrame:
    # every column: the note id alone repeats, and identical rows are interchangeable
    return notes.chunk_assign(c.meta_stage, CHUNK_ORDER, CHUNK_ROWS)


def q_distinct_note_keys(c: Chain) -> DataFrame:
    return c.note_keys


def q_note_text_semi(c: Chain) -> DataFrame:
    return c.texts


def q_unmatched_note_keys(c: Chain) -> DataFrame:
    return notes.unmatched_note_keys(c.note_keys, c.fx.note_text)


def q_note_text_join(c: Chain) -> DataFrame:
    return c.notes


def q_nonblank_notes(c: Chain) -> DataFrame:
    return notes.nonblank_notes(c.fx.note_text)


def q_note_type_filter(c: Chain) -> DataFrame:
    return notes.note_type_filter(c.fx.note_metadata)


def _all_note_keys(c: Chain) -> DataFrame:
    return notes.distinct_note_keys(c.fx.note_metadata)


def q_first_batch_wins(c: Chain) -> DataFrame:
    return notes.first_batch_wins(c.fx.note_text_files, _all_note_keys(c))


def q_note_key_coverage(c: Chain) -> DataFrame:
    return notes.note_key_coverage(c.fx.note_text_files, _all_note_keys(c))


def q_stage_counts(c: Chain) -> DataFrame:
    counts = notes.StepCounts(c.spark)
    matched = cohort.filter_encounters(counts.of("encounters_loaded", c.fx.encounterfact), c.cohort_keys)
    merged = notes.join_metadata_encounters(c.fx.note_metadata, counts.of("encounters_matched", matched))
    merged = write_table(counts.of("metadata_merged", merged), "filtered-metadata")
    texts = notes.filter_note_text(c.fx.note_text, write_table(notes.distinct_note_keys(merged), "note-keys"))
    joined = counts.of("notes_joined", notes.join_text_metadata(texts, merged))
    joined.write.format("noop").mode("overwrite").save()
    return counts.table()


def _bucketed(c: Chain, rows: DataFrame, name: str, key: str, buckets: int) -> DataFrame:
    path = scratch_dir(c.spark, name)
    return notes.write_bucketed(rows, path.rsplit("/", 1)[1].replace("-", "_"), key, buckets, path)


def q_metadata_encounter_bucketed(c: Chain) -> DataFrame:
    metadata = write_table(notes.prune_metadata(c.fx.note_metadata), "metadata")
    n = notes.bucket_count(metadata, c.enc_stage, least=BUCKETS)
    return notes.join_metadata_encounters(_bucketed(c, metadata, "metadata-buckets", "encounterkey", n),
                                          _bucketed(c, c.enc_stage, "encounter-buckets", "encounterkey", n))


def q_note_text_join_bucketed(c: Chain) -> DataFrame:
    n = notes.bucket_count(c.fx.note_text, c.meta_stage, least=BUCKETS)
    texts = _bucketed(c, c.fx.note_text, "text-buckets", "deid_note_key", n)
    return notes.join_text_metadata(texts, _bucketed(c, c.meta_stage, "metadata-buckets", "deid_note_key", n))


def _rule_query(name: str) -> Callable[[Chain], DataFrame]:
    return lambda c: staging.rule_findings(c.fx.note_text, name, TEXT_ROW)


def q_findings_basic(c: Chain) -> DataFrame:
    return staging.basic_findings(c.fx.note_text, TEXT_ROW)


def q_findings_override(c: Chain) -> DataFrame:
    return staging.override_findings(c.fx.note_text, OVERRIDES, TEXT_ROW)


def q_findings_all(c: Chain) -> DataFrame:
    return staging.findings_table(c.fx.note_text, TEXT_ROW)


def q_findings_exploded(c: Chain) -> DataFrame:
    return staging.patient_findings(c.texts, c.meta_stage)


def q_findings_exploded_all(c: Chain) -> DataFrame:
    return staging.patient_findings(c.texts, c.meta_stage, rules=RULES)


def q_model_plus_regex(c: Chain) -> DataFrame:
    out = staging.model_and_basic_findings(c.texts.select(*TEXT_ROW, "note_text"), TEXT_ROW, keyword_model_factory(FINDINGS_TEMPLATE))
    return out.drop("error")


def _first(c: Chain, keep_all: bool = False) -> DataFrame:
    return staging.first_findings(c.texts.select(*TEXT_ROW, "note_text"), keep_all=keep_all).drop("note_text")


def q_notes_first_finding(c: Chain) -> DataFrame:
    return _first(c).join(c.meta_stage, "deid_note_key").select(*NOTE_OUT)


def q_finding_summary(c: Chain) -> DataFrame:
    return staging.finding_summary(_first(c, keep_all=True), c.meta_stage)


def _asked(c: Chain) -> DataFrame:
    """The metadata columns that requests and their results use."""
    return c.meta_stage.select("deid_note_key", "deid_note_id", "patientdurablekey", "note_type")


def _pairs(c: Chain) -> tuple[DataFrame, DataFrame]:
    stored = batching.stored_texts(c.texts)
    return stored, batching.note_pairs(stored, _asked(c))


def q_patient_gate(c: Chain) -> DataFrame:
    return batching.patient_budget(_pairs(c)[1])


def q_patient_concat(c: Chain) -> DataFrame:
    stored, pairs = _pairs(c)
    return batching.patient_concat(stored, pairs, batching.patient_budget(pairs), order_cols=["note_no", "deid_note_id"])


def q_render_prompt(c: Chain) -> DataFrame:
    nb = notes.nonblank_notes(c.fx.note_text)
    return nb.select("deid_note_key", render(F.col("note_text"), CHAT_TEMPLATE).alias("prompt"),
                     render(F.col("note_text"), FINDINGS_TEMPLATE).alias("findings_prompt"))


def q_parse_response(c: Chain) -> DataFrame:
    r = c.fx.llm_responses
    return r.select("event_id", parse_response(F.col("response")).alias("p")).select("event_id", "p.stage", "p.system")


def q_parse_conversations(c: Chain) -> DataFrame:
    p = parse_response(F.col("text"))
    return c.fx.conversations.select("conv_id", "turn", p.alias("p")).select("conv_id", "turn", "p.stage", "p.system")


MODE_OUT = [*NOTE_OUT, "request_mode"]


def q_llm_per_note(c: Chain) -> DataFrame:
    return batching.extract_per_note(c.texts, _asked(c), keyword_model_factory()).select(*MODE_OUT)


def q_llm_patient_mode(c: Chain) -> DataFrame:
    out = batching.extract_by_patient(c.texts, _asked(c), keyword_model_factory(), order_cols=["note_no", "deid_note_id"])
    return out.select(*MODE_OUT)


def q_llm_token_gate(c: Chain) -> DataFrame:
    out = batching.extract_by_patient(c.texts, _asked(c), keyword_model_factory(), order_cols=["note_no", "deid_note_id"],
                                      token_counter=word_counter_factory(), max_context=TOKEN_LIMIT)
    return out.select(*MODE_OUT)


def q_llm_two_models(c: Chain) -> DataFrame:
    """Two models in one session: each note's answer of both, and the second one's errors."""
    asked = notes.nonblank_notes(c.texts).select(*TEXT_ROW, render(F.col("note_text"), CHAT_TEMPLATE).alias("prompt"))
    one = infer(asked, TEXT_ROW, "prompt", keyword_model_factory())
    two = infer(asked, TEXT_ROW, "prompt", failing_model_factory("IIB carcinoma"))
    return one.drop("error").withColumnRenamed("response", "first").join(two.withColumnRenamed("response", "second"), TEXT_ROW)


def q_staging_timeline(c: Chain) -> DataFrame:
    return timeline.staging_timeline(c.text_findings, c.meta_stage)


# ---- sources and sinks: write fixtures to the shared scratch folder, read them back -------------
def q_scan_csv_ids(c: Chain) -> DataFrame:
    path = scratch_dir(c.spark, "ids-csv")
    sinks.write_csv(c.fx.patient_ids, path)
    return readers.read_id_csv(c.spark, path).select("person_source_value")


def q_scan_recursive(c: Chain) -> DataFrame:
    path = scratch_dir(c.spark, "encounters-nested")
    enc = c.fx.encounterfact.withColumn("y", F.year("datekeyvalue")).withColumn("m", F.month("datekeyvalue"))
    enc.write.mode("overwrite").partitionBy("y", "m").parquet(path)
    return readers.read_recursive_parquet(c.spark, path, list(cohort.ENCOUNTER_COLUMNS))


def _write_corrupt(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out = fs.create(target, True)
    out.write(bytearray(b"this is not a parquet file"))
    out.close()


def q_scan_glob(c: Chain) -> DataFrame:
    path = scratch_dir(c.spark, "encounters-named")
    c.fx.encounterfact.write.option("compression", "snappy").parquet(path)
    c.fx.encounterfact.write.option("compression", "gzip").mode("append").parquet(path)
    return readers.read_glob_parquet(c.spark, path, "*.snappy.parquet", ["patientdurablekey", "encounterkey", "datekeyvalue"])


def q_scan_required(c: Chain) -> DataFrame:
    path = scratch_dir(c.spark, "dim-files")
    dim = c.fx.patdurabledim.withColumn("patientdurablekey", F.when(F.col("row_no") % 10 > 0, F.col("patientdurablekey")))
    dim.write.parquet(path)
    dim.drop("patientdurablekey").write.mode("append").parquet(path)  # files without the column
    return readers.read_with_required(c.spark, path, "*.parquet", ["patientepicid", "patientdurablekey"])


def q_input_guard(c: Chain) -> DataFrame:
    path = scratch_dir(c.spark, "guarded")
    c.fx.encounterfact.write.parquet(path)
    found = {}
    for glob in ("*.parquet", "*.orc"):
        try:
            readers.require_input(c.spark, path, glob)
            found[glob] = True
        except FileNotFoundError:
            found[glob] = False
    counts = c.spark.read.parquet(path).agg(F.count(F.lit(1)).alias("row_count"))
    return counts.select(F.lit(found["*.parquet"]).alias("parquet_found"), F.lit(found["*.orc"]).alias("orc_found"), "row_count")


def _tolerant(c: Chain) -> str:
    path = scratch_dir(c.spark, "texts-tolerant")
    c.fx.note_text_files.write.mode("overwrite").parquet(path)
    _write_corrupt(c.spark, f"{path}/part-corrupt.parquet")
    return path


def q_scan_tolerant(c: Chain) -> DataFrame:
    return readers.read_tolerant(c.spark, _tolerant(c))


def _second_group(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``at, bytes`` of the columns in the second row group of parquet files."""
    import pyarrow.parquet as pq
    from pyarrow import fs

    for b in batches:
        for path in b.column(0).to_pylist():
            store, name = fs.FileSystem.from_uri(path)
            with store.open_input_file(name) as f:
                group = pq.ParquetFile(f).metadata.row_group(1)
            columns = [group.column(k) for k in range(group.num_columns)]
            at = [min(x for x in (c.dictionary_page_offset, c.data_page_offset) if x) for c in columns]
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array([c.total_compressed_size for c in columns], pa.int64())], ["at", "bytes"])


def _break_second_group(spark: SparkSession, path: str) -> None:
    """Overwrite the second row group of a parquet file with zeros; the footer stays.

    An executor looks up where the group is; the bytes around it go from stream to stream, so
    the driver never holds the file.
    """
    ship_package(spark)
    columns = sorted(readers.list_files(spark, path).mapInArrow(_second_group, "at long, bytes long").collect())
    jvm = spark.sparkContext._jvm
    target, whole = (jvm.org.apache.hadoop.fs.Path(p) for p in (path, f"{path}.whole"))
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.rename(target, whole):
        raise OSError(f"cannot rename {path}")
    copy, at = jvm.org.apache.commons.io.IOUtils.copyLarge, 0
    source, out = fs.open(whole), fs.create(target, True)
    for column in columns:
        copy(source, out, 0, column["at"] - at)
        out.write(bytearray(column["bytes"]))
        at = column["at"] + column["bytes"]
        source.seek(at)
    copy(source, out)
    out.close()
    source.close()
    fs.delete(whole, False)


def q_skipped_files(c: Chain) -> DataFrame:
    """One file per ``file_no`` in row groups of ten; the third breaks in its second group, and
    one more is no parquet file.  Statistics would put two texts a row group into the footers."""
    path = scratch_dir(c.spark, "texts-broken")
    dealt = c.fx.note_text_files.repartitionById(7, F.col("file_no").cast("int"))
    dealt.write.option("parquet.block.row.count.limit", GROUP_ROWS).option("parquet.column.statistics.enabled", False).parquet(path)
    _break_second_group(c.spark, readers._fs_glob(c.spark, f"{path}/part-00002*")[0])
    _write_corrupt(c.spark, f"{path}/part-corrupt.parquet")
    name = F.regexp_extract("file_name", r"^part-\w+", 0)
    return readers.skipped_files(c.spark, path).select(name.alias("file_name"), "promised", "rows_read", "status")


def q_sink_partitioned(c: Chain) -> DataFrame:
    path = scratch_dir(c.spark, "encounters-partitioned")
    part = q_partition_assign(c)
    sinks.write_partitioned(part, path)
    schema = T.StructType([f for f in part.schema.fields])
    return sinks.read_partitioned(c.spark, path, schema).select(*part.columns)


def q_sink_chunked(c: Chain) -> DataFrame:
    path = scratch_dir(c.spark, "metadata-chunks")
    sinks.write_chunked(c.meta_enc, path, CHUNK_ROWS)
    rows = c.spark.read.parquet(path)
    in_file = Window.partitionBy("_file")
    sized = rows.withColumn("_file", F.col("_metadata.file_path")).withColumn("within_limit", F.count(F.lit(1)).over(in_file) <= CHUNK_ROWS)
    return sized.drop("_file")


def q_chunk_files(c: Chain) -> DataFrame:
    path = scratch_dir(c.spark, "metadata-chunk-files")
    sinks.write_chunk_files(c.meta_enc, path, CHUNK_ORDER, CHUNK_ROWS)
    return sinks.read_chunk_files(c.spark, path)


def q_sink_twin(c: Chain) -> DataFrame:
    path = scratch_dir(c.spark, "twin")
    out = c.enc.select("patientdurablekey", "encounterkey")
    sinks.write_results(out, f"{path}.parquet")
    twins = [c.spark.read.parquet(f"{path}.parquet").withColumn("fmt", F.lit("parquet")),
             c.spark.read.option("header", True).csv(f"{path}.csv").withColumn("fmt", F.lit("csv"))]
    return twins[0].unionByName(twins[1])


def q_sink_csv(c: Chain) -> DataFrame:
    path = scratch_dir(c.spark, "mapped-csv")
    sinks.write_csv(c.mapped, path)
    return c.spark.read.option("header", True).csv(path)


def q_resume_stages(c: Chain) -> DataFrame:
    root = scratch_dir(c.spark, "stages")
    stages = {"encounters": lambda: c.enc, "metadata": lambda: notes.join_metadata_encounters(
        c.fx.note_metadata, c.spark.read.parquet(f"{root}/encounters"))}
    ran = {name: [sinks.run_stage(c.spark, f"{root}/{name}", build) for _ in range(2)] for name, build in stages.items()}
    parts = [c.spark.read.parquet(f"{root}/{name}").agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit(name).alias("step"), F.lit(once).alias("ran_first"), F.lit(again).alias("ran_again"), "row_count")
        for name, (once, again) in ran.items()]
    return parts[0].unionByName(parts[1])


def q_resume_changed(c: Chain) -> DataFrame:
    """Four runs of two stages: the first; nothing changed; a parameter changed; an input changed.

    The metadata, which no run changes, are written once in buckets of the join's key; runs move
    the encounters alone."""
    root = scratch_dir(c.spark, "stages-changed")
    metadata = write_table(notes.prune_metadata(c.fx.note_metadata), "metadata")
    # with fewer buckets than shuffle partitions Spark would move the metadata too
    n = notes.bucket_count(metadata, least=int(c.spark.conf.get("spark.sql.shuffle.partitions")))
    metadata = _bucketed(c, metadata, "metadata-buckets", "encounterkey", n)
    c.enc.write.parquet(f"{root}/in")
    out = []
    for run, since in ((1, 0), (2, 0), (3, SINCE), (4, SINCE)):
        if run == 4:
            c.enc.write.mode("append").parquet(f"{root}/in")
        ran = {"encounters": sinks.run_stage(
            c.spark, f"{root}/encounters", lambda since=since: c.spark.read.parquet(f"{root}/in").where(F.col("datekey") >= since),
            inputs=[f"{root}/in"], params={"since": since})}
        ran["metadata"] = sinks.run_stage(
            c.spark, f"{root}/metadata", lambda: notes.join_metadata_encounters(metadata, c.spark.read.parquet(f"{root}/encounters")),
            inputs=[f"{root}/encounters"])
        out += [(run, step, did, c.spark.read.parquet(f"{root}/{step}").count()) for step, did in ran.items()]
    return c.spark.createDataFrame(out, "run int, step string, ran boolean, row_count long")


def q_combine_results(c: Chain) -> DataFrame:
    root = scratch_dir(c.spark, "staging-results")
    rows = notes.with_file_batch(c.fx.note_text_files)
    found = staging.findings_table(rows, [*TEXT_ROW, "file_no", "batch"])
    found = found.withColumn("result_batch", F.col("batch"))
    found.write.mode("overwrite").partitionBy("batch").parquet(root)
    return sinks.combine_results(c.spark, root, "batch=*")


def _files(c: Chain, df: DataFrame, name: str, row: str) -> str:
    """``df`` as files that sort by (``file_no``, part), rows in order of ``row``, without the
    made-up numbers.  A ``file_no`` has so many parts that a file holds about ``ROWS_PER_FILE``
    rows at any size of the table; a task writes whole files, ``FILES_PER_TASK`` of them where
    there are more than shuffle partitions, as a task a file would be as many shuffle blocks as
    files times map tasks."""
    path = scratch_dir(c.spark, name)
    n = df.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("file_no").alias("files")).first()
    parts = 1 + n["n"] // (ROWS_PER_FILE * max(n["files"], 1))
    named = df.withColumn("f", F.format_string("%03d-%09d", F.col("file_no").cast("int"), F.pmod(F.col(row), F.lit(parts))))
    files = max(n["files"] * parts, 1)
    tasks = min(files, max(int(c.spark.conf.get("spark.sql.shuffle.partitions")), -(-files // FILES_PER_TASK)))
    dealt = named.drop("file_no").repartition(tasks, "f").sortWithinPartitions("f", row)
    dealt.drop("row_no").write.partitionBy("f").option("compression", SCRATCH_CODEC).parquet(path)
    return path


def q_id_mapping_files(c: Chain) -> DataFrame:
    path = _files(c, c.fx.patdurabledim, "dim-ordered", "row_no")
    dim = readers.read_with_file_order(c.spark, path).select("patientepicid", "patientdurablekey", "file_no", "row_no")
    return cohort.map_ids(c.fx.patient_ids, dim).select("person_source_value", "patientdurablekey")


def q_first_batch_files(c: Chain) -> DataFrame:
    path = _files(c, c.fx.note_text_files, "texts-ordered", "note_no")
    rows = readers.read_with_file_order(c.spark, path)
    out = notes.first_batch_notes(rows, c.meta_stage)
    return out.select(*TEXT_ROW, "note_text", "batch", "deid_note_id", "encounterkey")


def _streamed(c: Chain, what: str) -> DataFrame:
    src = _files(c, c.fx.note_text_files, "stream-src", "note_no")
    schema = T.StructType([T.StructField("deid_note_key", T.StringType()), T.StructField("note_no", T.LongType()),
                           T.StructField("note_text", T.StringType())])
    out = scratch_dir(c.spark, "stream-out")
    incremental.stream_first_batch(c.spark, src, schema, c.note_keys, out, scratch_dir(c.spark, "stream-ckpt"),
                                   metadata=c.meta_stage, batches_per_trigger=BATCHES_PER_TRIGGER)
    return incremental.read_output(c.spark, out, what)


def q_stream_findings(c: Chain) -> DataFrame:
    return _streamed(c, incremental.FINDINGS)


def q_stream_notes(c: Chain) -> DataFrame:
    return _streamed(c, incremental.NOTES).select(*TEXT_ROW, "note_text", "batch", "deid_note_id", "encounterkey")


SPARK: dict[str, Callable[[Chain], DataFrame]] = {
    "encounter_projection": q_encounter_projection,
    "id_mapping": q_id_mapping,
    "id_match_report": q_id_match_report,
    "unmatched_ids": q_unmatched_ids,
    "encounter_cohort": q_encounter_cohort,
    "partition_assign": q_partition_assign,
    "sample_keys": q_sample_keys,
    "scan_pruned_metadata": q_scan_pruned_metadata,
    "metadata_encounter_join": q_metadata_encounter_join,
    "chunk_assign": q_chunk_assign,
    "distinct_note_keys": q_distinct_note_keys,
    "note_text_semi": q_note_text_semi,
    "unmatched_note_keys": q_unmatched_note_keys,
    "note_text_join": q_note_text_join,
    "nonblank_notes": q_nonblank_notes,
    "note_type_filter": q_note_type_filter,
    "first_batch_wins": q_first_batch_wins,
    "note_key_coverage": q_note_key_coverage,
    "stage_counts": q_stage_counts,
    "find_tnm_standard": _rule_query("tnm_standard"),
    "find_tnm_prefixed": _rule_query("tnm_prefixed"),
    "find_tnm_components": _rule_query("tnm_components"),
    "find_stage_standard": _rule_query("stage_standard"),
    "find_stage_ajcc": _rule_query("stage_ajcc"),
    "find_stage_colon": _rule_query("stage_colon"),
    "find_roman_numeral": _rule_query("roman_numeral_stage"),
    "findings_all": q_findings_all,
    "findings_basic": q_findings_basic,
    "findings_override": q_findings_override,
    "findings_exploded": q_findings_exploded,
    "findings_exploded_all": q_findings_exploded_all,
    "model_plus_regex": q_model_plus_regex,
    "notes_first_finding": q_notes_first_finding,
    "finding_summary": q_finding_summary,
    "patient_gate": q_patient_gate,
    "patient_concat": q_patient_concat,
    "render_prompt": q_render_prompt,
    "parse_response": q_parse_response,
    "parse_conversations": q_parse_conversations,
    "llm_per_note": q_llm_per_note,
    "llm_patient_mode": q_llm_patient_mode,
    "llm_token_gate": q_llm_token_gate,
    "llm_two_models": q_llm_two_models,
    "staging_timeline": q_staging_timeline,
    "scan_csv_ids": q_scan_csv_ids,
    "scan_recursive": q_scan_recursive,
    "scan_tolerant": q_scan_tolerant,
    "scan_glob": q_scan_glob,
    "scan_required": q_scan_required,
    "input_guard": q_input_guard,
    "skipped_files": q_skipped_files,
    "sink_partitioned": q_sink_partitioned,
    "sink_chunked": q_sink_chunked,
    "chunk_files": q_chunk_files,
    "metadata_encounter_bucketed": q_metadata_encounter_bucketed,
    "note_text_join_bucketed": q_note_text_join_bucketed,
    "resume_changed": q_resume_changed,
    "sink_twin": q_sink_twin,
    "sink_csv": q_sink_csv,
    "resume_stages": q_resume_stages,
    "combine_results": q_combine_results,
    "id_mapping_files": q_id_mapping_files,
    "first_batch_files": q_first_batch_files,
    "stream_findings": q_stream_findings,
    "stream_notes": q_stream_notes,
}


def build(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    # a small test file is one row group, which one task would read
    return SPARK[name](Chain(spark, sf_dir, spark.sparkContext.defaultParallelism))


# ---- DuckDB side -------------------------------------------------------------------------------
def _nb(t: str = "note_text") -> str:
    return O.NONBLANK.format(t=t)


def _oracles() -> dict[str, str]:
    fx = with_fixture_ctes
    enc_cols = ", ".join(cohort.ENCOUNTER_COLUMNS)
    meta_cols = ", ".join(notes.METADATA_COLUMNS)
    types = ", ".join(O.q(t) for t in notes.ALLOWED_NOTE_TYPES)
    texts_findings = ("f", O.findings_sql("texts", TEXT_ROW))
    basic_findings = ("f", O.findings_sql("texts", TEXT_ROW, BASIC_RULES))
    wanted = "select distinct deid_note_key from note_metadata where deid_note_key is not null"
    e3 = (f"with wanted as ({wanted}), rows as (select *, file_no // 3 as batch from note_text_files "
          "where deid_note_key in (select deid_note_key from wanted)) "
          "select deid_note_key, note_no, file_no, note_text, batch from "
          "(select *, min(batch) over (partition by deid_note_key) as mb from rows) where batch = mb")
    piece = O.piece_sql("note_no", "note_text")
    total = "(sum(length(piece)) + 2 * (count(*) - 1))"
    budget = (f"select patientdurablekey, count(*) as n_notes, cast({total} as bigint) as request_chars, "
              f"cast(floor(cast({total} as double) / 3.5) as bigint) as est_tokens, "
              f"floor(cast({total} as double) / 3.5) + 200 <= 8092 as fits from "
              f"(select patientdurablekey, {piece} as piece from notes where patientdurablekey is not null "
              f"and {_nb()}) group by patientdurablekey")
    count = "len(regexp_extract_all(prompt, '\\S+'))"
    concat = (f"select patientdurablekey, string_agg({piece}, chr(10) || chr(10) order by note_no, deid_note_id) "
              f"as request_text from notes where {_nb()} and patientdurablekey in "
              f"(select patientdurablekey from budget where fits) group by patientdurablekey")
    note_out = ", ".join(NOTE_OUT)
    exploded = ("select m.patientdurablekey, f.stage, f.system, f.evidence from f "
                "join meta_enc m on f.deid_note_key = m.deid_note_key")
    patient_mode = [
        ("bres", f"select patientdurablekey, {O.stub_stage('request_text')} as stage, "
                 f"{O.stub_system('request_text')} as system from req"),
        ("batched", "select n.deid_note_key, n.deid_note_id, n.patientdurablekey, n.note_type, b.stage, b.system "
                    "from notes n join bres b on n.patientdurablekey = b.patientdurablekey where b.stage is not null"),
        ("single", f"select deid_note_key, deid_note_id, patientdurablekey, note_type, "
                   f"{O.stub_stage('note_text')} as stage, {O.stub_system('note_text')} as system from notes "
                   f"where {_nb()} and patientdurablekey in (select patientdurablekey from budget where not fits)")]
    both_modes = ("select *, 'patient' as request_mode from batched "
                  "union all select *, 'note' from single where stage is not null")
    parts = "(select 1 + count(*) // ({} * count(distinct file_no)) as parts from {{}})".format(ROWS_PER_FILE)
    won = ("select deid_note_key, note_no, note_text, batch from (select *, min(batch) over (partition by deid_note_key) as mb from "
           "(select *, (dense_rank() over (order by file_no, note_no % parts) - 1) // 3 as batch "
           f"from note_text_files, {parts.format('note_text_files')}) "
           "where deid_note_key in (select deid_note_key from meta_enc)) where batch = mb")
    won_notes = "select won.*, m.deid_note_id, m.encounterkey from won join meta_enc m using (deid_note_key)"
    stage_r, system_r = O.parse_sql("response")
    out = {
        "encounter_projection": fx(f"select {enc_cols} from encounterfact"),
        "id_mapping": O.chain("mapped", body="select person_source_value, patientdurablekey from mapped"),
        "id_match_report": O.chain("mapped", body=(
            "select count(*) as total_rows, cast(coalesce(sum(rows_in_file), 0) as bigint) as matches_found, "
            "count(rows_in_file) as matched_rows, case when count(*) > 0 then "
            "cast(coalesce(sum(rows_in_file), 0) as double) / count(*) * 100.0 else 0.0 end as match_percentage "
            "from mapped")),
        "unmatched_ids": O.chain("dim_cut", body=(
            "select distinct person_source_value from patient_ids p where person_source_value is not null and "
            "not exists (select 1 from dim_cut d where d.patientepicid = p.person_source_value)")),
        "encounter_cohort": O.chain("enc", body="select * from enc"),
        "partition_assign": O.chain("enc", [("pos", (
            "select patientdurablekey, cast((row_number() over (order by patientdurablekey) - 1) // 100 as varchar) "
            "as partition_key from cohort"))], body=(
            f"select {', '.join('e.' + x for x in cohort.ENCOUNTER_COLUMNS)}, coalesce(pos.partition_key, 'unknown') as partition_key "
            "from encounterfact e left join pos on e.patientdurablekey = pos.patientdurablekey")),
        "sample_keys": O.chain("enc", body=(
            "select patientdurablekey, encounterkey from enc order by patientdurablekey, encounterkey limit 3")),
        "scan_pruned_metadata": fx(f"select {meta_cols} from note_metadata"),
        "metadata_encounter_join": O.chain("meta_enc", body="select * from meta_enc"),
        "chunk_assign": O.chain("meta_enc", body=(
            "select *, cast((row_number() over (order by " + ", ".join(f"{c} nulls first" for c in CHUNK_ORDER) +
            ") - 1) // 1000 + 1 as bigint) as chunk_no "
            "from meta_enc")),
        "distinct_note_keys": O.chain("note_keys", body="select * from note_keys"),
        "note_text_semi": O.chain("texts", body="select * from texts"),
        "unmatched_note_keys": O.chain("note_keys", body=(
            "select deid_note_key from note_keys k where not exists "
            "(select 1 from note_text t where t.deid_note_key = k.deid_note_key)")),
        "note_text_join": O.chain("notes", body="select * from notes"),
        "nonblank_notes": fx(f"select * from note_text where {_nb()}"),
        "note_type_filter": fx(f"select * from note_metadata where note_type in ({types})"),
        "first_batch_wins": fx(e3),
        "note_key_coverage": fx(
            f"with wanted as ({wanted}), found as (select deid_note_key, min(file_no // 3) as batch "
            "from note_text_files where deid_note_key in (select deid_note_key from wanted) group by deid_note_key), "
            "per as (select batch, count(*) as found_new from found group by batch), "
            "run as (select batch, found_new, cast(sum(found_new) over (order by batch rows between unbounded "
            "preceding and current row) as bigint) as found_total, (select count(*) from wanted) as wanted from per) "
            "select batch, found_new, found_total, wanted, case when wanted > 0 then "
            "cast(found_total as double) / wanted * 100.0 else 0.0 end as percent from run"),
        "stage_counts": O.chain("notes", body=(
            "select 'encounters_loaded' as step, count(*) as row_count from encounterfact "
            "union all select 'encounters_matched', count(*) from enc "
            "union all select 'metadata_merged', count(*) from meta_enc "
            "union all select 'notes_joined', count(*) from notes")),
        "findings_all": fx(O.findings_sql("note_text", TEXT_ROW)),
        "findings_basic": fx(O.findings_sql("note_text", TEXT_ROW, BASIC_RULES)),
        "findings_override": fx(O.findings_sql("note_text", TEXT_ROW, rule_set(OVERRIDES))),
        "findings_exploded": O.chain("texts", [basic_findings], body=exploded),
        "findings_exploded_all": O.chain("texts", [texts_findings], body=exploded),
        "model_plus_regex": O.chain("texts", [basic_findings, ("m", (
            f"select deid_note_key, note_no, {O.stub_stage('note_text')} as stage, {O.stub_system('note_text')} as system from texts "
            f"where {_nb()}"))], body=(
            "select deid_note_key, note_no, 0 as finding_no, 'model' as source, stage, system, "
            "case system when 'TNM' then 'TNM: ' else 'Stage: ' end || stage as evidence from m where stage is not null "
            "union all select f.deid_note_key, f.note_no, f.finding_no + case when m.stage is not null then 1 else 0 end, 'regex', "
            "f.stage, f.system, f.evidence from f left join m using (deid_note_key, note_no)")),
        "notes_first_finding": O.chain("texts", [texts_findings], body=(
            "select m.deid_note_key, m.deid_note_id, m.patientdurablekey, m.note_type, f.stage, f.system from f "
            "join meta_enc m on f.deid_note_key = m.deid_note_key where f.finding_no = 0")),
        # by rows of notes, each asked whether its text row has any finding
        "finding_summary": O.chain("notes", [texts_findings, ("told", (
            "select patientdurablekey, exists (select 1 from f where f.note_no = n.note_no) as staged from notes n"))], body=(
            "select count(*) filter (where staged) as notes_with_staging, "
            "count(distinct patientdurablekey) filter (where staged) as patients_with_staging, "
            "count(distinct patientdurablekey) as unique_patients from told")),
        "patient_gate": O.chain("notes", body=budget),
        "patient_concat": O.chain("notes", [("budget", budget)], body=concat),
        "render_prompt": fx(
            f"select deid_note_key, {O.template_sql(CHAT_TEMPLATE, 'note_text')} as prompt, "
            f"{O.template_sql(FINDINGS_TEMPLATE, 'note_text')} as findings_prompt from note_text where {_nb()}"),
        "parse_response": fx(f"select event_id, {stage_r} as stage, {system_r} as system from llm_responses"),
        "parse_conversations": "select conv_id, turn, {} as stage, {} as system from conversations".format(*O.parse_sql("text")),
        "llm_per_note": O.chain("notes", body=(
            f"select {note_out}, 'note' as request_mode from (select *, {O.stub_stage('note_text')} as stage, "
            f"{O.stub_system('note_text')} as system from notes where {_nb()}) where stage is not null")),
        "llm_patient_mode": O.chain("notes", [("budget", budget), ("req", concat), *patient_mode], body=both_modes),
        "llm_token_gate": O.chain("notes", [
            ("estimate", budget.replace("<= 8092", f"<= {TOKEN_LIMIT - 100}")),
            ("ask", concat.replace("from budget", "from estimate")),
            ("exact", f"select patientdurablekey, {count} < {TOKEN_LIMIT - 100} as ok from (select patientdurablekey, "
                      f"{O.template_sql(CHAT_TEMPLATE, 'request_text')} as prompt from ask)"),
            ("budget", "select e.patientdurablekey, coalesce(x.ok, false) as fits from estimate e left join exact x using (patientdurablekey)"),
            ("req", "select * from ask where patientdurablekey in (select patientdurablekey from budget where fits)"),
            *patient_mode], body=both_modes),
        "llm_two_models": O.chain("texts", body=(
            f"select deid_note_key, note_no, case {O.stub_system('note_text')} when 'TNM' then 'TNM: ' || {O.stub_stage('note_text')} "
            f"when 'General' then 'Stage: ' || {O.stub_stage('note_text')} else 'NA' end as first, "
            "case when contains(note_text, 'IIB carcinoma') then null else 'Stage: X' end as second, "
            "case when contains(note_text, 'IIB carcinoma') then 'ValueError: IIB carcinoma' end as error "
            f"from texts where {_nb()}")),
        "staging_timeline": O.chain("texts", [texts_findings, ("rows", (
            "select m.patientdurablekey, m.datekeyvalue, m.deid_note_id, m.deid_note_key, f.note_no, f.finding_no, f.stage, "
            "f.system from f join meta_enc m on f.deid_note_key = m.deid_note_key"))], body=(
            "select *, row_number() over w as seq, lag(stage) over w as previous_stage from rows window w as "
            "(partition by patientdurablekey order by datekeyvalue nulls first, deid_note_id, deid_note_key, note_no, finding_no)")),
        "scan_glob": fx("select patientdurablekey, encounterkey, datekeyvalue from encounterfact"),
        "scan_required": fx("select patientepicid, case when row_no % 10 > 0 then patientdurablekey end as patientdurablekey, "
                            "file_no, row_no from patdurabledim"),
        "input_guard": fx("select true as parquet_found, false as orc_found, count(*) as row_count from encounterfact"),
        "skipped_files": fx(
            f"select 'part-00002' as file_name, count(*) as promised, cast({GROUP_ROWS} as bigint) as rows_read, 'partial' as status "
            "from note_text_files where file_no = 2 union all select 'part-corrupt', null, 0, 'unreadable'"),
        "resume_changed": O.chain("meta_enc", [
            ("since", f"select * from enc where datekey >= {SINCE}"),
            ("n", "select (select count(*) from enc) as e, (select count(*) from meta_enc) as m, (select count(*) from since) as f, "
                  "(select count(*) from note_metadata join since using (encounterkey)) as k")], body=" union all ".join(
            f"select {run} as run, '{step}' as step, {ran} as ran, {count} as row_count from n" for run, step, ran, count in (
                (1, "encounters", "true", "e"), (1, "metadata", "true", "m"), (2, "encounters", "false", "e"), (2, "metadata", "false", "m"),
                (3, "encounters", "true", "f"), (3, "metadata", "true", "k"), (4, "encounters", "true", "2 * f"), (4, "metadata", "true", "2 * k")))),
        "sink_twin": O.chain("enc", body=(
            "select patientdurablekey, encounterkey, 'parquet' as fmt from enc union all select patientdurablekey, encounterkey, 'csv' from enc")),
        "sink_csv": O.chain("mapped", body="select person_source_value, patientdurablekey, patientepicid from mapped".replace(", patientepicid", "")),
        "resume_stages": O.chain("meta_enc", body=(
            "select 'encounters' as step, true as ran_first, false as ran_again, count(*) as row_count from enc "
            "union all select 'metadata', true, false, count(*) from meta_enc")),
        "id_mapping_files": O.chain("mapped", body="select person_source_value, patientdurablekey from mapped").replace(
            "order by file_no, row_no desc", "order by file_no, row_no % parts, row_no desc").replace(
            "from dim_cut", f"from dim_cut, {parts.format('patdurabledim')}", 1),
        "first_batch_files": O.chain("meta_enc", [("won", won)], body=won_notes),
        "stream_notes": O.chain("meta_enc", [("won", won)], body=won_notes),
        "stream_findings": O.chain("meta_enc", [("won", won), ("f", O.findings_sql("won", [*TEXT_ROW, "batch"]))], body="select * from f"),
        "scan_csv_ids": fx("select person_source_value from patient_ids"),
        "scan_recursive": fx(f"select {enc_cols} from encounterfact"),
        "scan_tolerant": fx("select * from note_text_files"),
        "sink_chunked": O.chain("meta_enc", body="select *, true as within_limit from meta_enc"),
        "combine_results": fx(O.findings_sql("(select *, file_no // 3 as batch from note_text_files)",
                                             [*TEXT_ROW, "file_no", "batch"]).replace(
            "select deid_note_key, note_no, file_no, batch, cast(row_number()",
            "select deid_note_key, note_no, file_no, batch as result_batch, cast(row_number()", 1)),
    }
    out["sink_partitioned"] = out["partition_assign"]
    out["chunk_files"] = out["chunk_assign"]  # the number of the file is the number of the chunk
    out["metadata_encounter_bucketed"] = out["metadata_encounter_join"]
    out["note_text_join_bucketed"] = out["note_text_join"]
    for rname, key in (("tnm_standard", "find_tnm_standard"), ("tnm_prefixed", "find_tnm_prefixed"),
                       ("tnm_components", "find_tnm_components"), ("stage_standard", "find_stage_standard"),
                       ("stage_ajcc", "find_stage_ajcc"), ("stage_colon", "find_stage_colon"),
                       ("roman_numeral_stage", "find_roman_numeral")):
        out[key] = fx(O.findings_sql("note_text", TEXT_ROW, (RULES_BY_NAME[rname],)))
    return out


ORACLE: dict[str, str] = _oracles()
