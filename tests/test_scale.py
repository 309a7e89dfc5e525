"""Figures that must not grow with the tables: shuffles of scans, buckets, tasks, micro-batches."""

import contextlib
import io
import os
import re
import types

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from notecohort.operators import batching, notes, sizing, staging
from notecohort.operators.inference import infer, token_counts
from notecohort.plans import fixtures, registry
from notecohort.sources import readers, sinks
from notecohort.streaming import incremental

SCHEMA = T.StructType([T.StructField("deid_note_key", T.StringType()), T.StructField("note_no", T.LongType()),
                       T.StructField("note_text", T.StringType())])


def plan(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("simple")
    return out.getvalue()


def test_only_coarse_scans_are_spread(spark, tmp_dir):
    spark.range(1000).repartition(8).write.parquet(f"{tmp_dir}/fine")
    spark.range(1000).coalesce(1).write.parquet(f"{tmp_dir}/coarse")
    fine, coarse = (sizing.spread_coarse(spark.read.parquet(f"{tmp_dir}/{n}"), 4) for n in ("fine", "coarse"))
    assert "Exchange" not in plan(fine) and "RoundRobin" in plan(coarse)
    assert fine.count() == coarse.count() == 1000


def test_scratch_tables_are_zstd(spark):
    table = sizing.write_table(spark.range(10), "t")
    assert all(f.endswith(".zstd.parquet") for f in table.inputFiles())


def test_buckets_follow_the_bytes(spark):
    rows = spark.range(1000).select("id", F.repeat(F.lit("x"), 84).alias("t"), F.lit(None).cast("string").alias("none"))
    assert sizing.table_bytes(rows) == 1000 * (3 * 8 + 84) and sizing.table_bytes(rows.limit(0)) == 0
    counts = [notes.bucket_count(rows.limit(n), rows.limit(1), least=2, bucket_bytes=10_800) for n in (0, 200, 201, 1000)]
    assert counts == [2, 2, 4, 16]


def test_bucketed_metadata_stay_where_they_are(spark, tmp_dir):
    """With as many buckets as shuffle partitions only the other side of a join is moved."""
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df = spark.range(100).select(F.col("id").cast("string").alias("k"), "id")
    table = f"buckets_{os.path.basename(tmp_dir).replace('-', '_')}"
    bucketed = notes.write_bucketed(df, table, "k", notes.bucket_count(df, least=n), f"{tmp_dir}/b")
    joined = bucketed.hint("merge").join(df.withColumnRenamed("id", "other"), "k")
    assert plan(joined).count("Exchange hashpartitioning") == 1 and joined.count() == 100


def test_first_batch_moves_texts_once(spark):
    rows = spark.createDataFrame([("a", 1, 0), ("a", 2, 4), ("a", 3, 1), (None, 4, 0), ("b", 5, 5), ("c", 6, None)],
                                 "deid_note_key string, note_no long, file_no long")
    won = notes.first_batch_wins(rows)
    assert sorted((r.deid_note_key, r.batch, r.note_no) for r in won.collect()) == [("a", 0, 1), ("a", 0, 3), ("b", 1, 5)]
    assert won.columns == ["deid_note_key", "batch", "note_no", "file_no"]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "batch" not in " ".join(x for x in plan(won).splitlines() if "hashpartitioning" in x)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_summary_counts_by_key_and_patient(spark):
    first = spark.createDataFrame([("a", "II"), ("a", None), ("a", "I"), ("b", None), (None, "I"), ("z", "I")], "deid_note_key string, stage string")
    meta = spark.createDataFrame([("a", "p"), ("a", "p"), ("a", None), ("b", "q"), ("b", "p"), (None, "r"), ("y", "s")],
                                 "deid_note_key string, patientdurablekey string")
    out = staging.finding_summary(first, meta)
    assert tuple(out.first()) == (6, 1, 2)
    assert tuple(staging.finding_summary(first.limit(0), meta).first()) == (0, 0, 0)
    assert "Expand" not in plan(out)
    assert [f.dataType.typeName() for f in out.schema] == ["long"] * 3


def test_a_task_writes_several_chunk_files(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(sinks, "TASK_ROWS", 30)
    rows = spark.range(257).select(F.col("id"), (F.col("id") * 7919 % 257).alias("k")).repartition(5)
    sinks.write_chunk_files(rows, f"{tmp_dir}/k", ["k"], chunk_rows=10)
    names = sorted(f for f in os.listdir(f"{tmp_dir}/k") if f.endswith(".parquet"))
    assert len(names) == 26 and len({f[:10] for f in names}) == 9  # three chunks a task
    for i, f in enumerate(names):
        assert [r.k for r in spark.read.parquet(f"{tmp_dir}/k/{f}").collect()] == list(range(10 * i, min(10 * i + 10, 257)))
    back = sinks.read_chunk_files(spark, f"{tmp_dir}/k")
    assert back.count() == 257 and back.where("chunk_no <> floor(k / 10) + 1").count() == 0


def test_prompts_cross_as_arrow(spark):
    """No batch of prompts becomes a table of Python strings; a null prompt is an empty one."""
    df = spark.createDataFrame([(i, f"p{i}" if i % 7 else None) for i in range(100)], "i long, prompt string")

    def factory():
        return lambda prompts: [f"{len(prompts) <= 4} {p}" for p in prompts]

    out = infer(df, ["i"], "prompt", factory, batch_rows=4)
    assert {r.i: (r.response, r.error) for r in out.collect()} == {i: (f"True p{i}" if i % 7 else "True ", None) for i in range(100)}
    counted = token_counts(df.where("prompt IS NOT NULL"), "prompt", lambda: lambda prompts: [len(p) if len(prompts) <= 4 else -1 for p in prompts], batch_rows=4)
    assert counted.where("n_tokens <> length(prompt)").count() == 0
    assert all("MapInArrow" in plan(x) and "MapInPandas" not in plan(x) for x in (out, counted))


@pytest.mark.parametrize("order", ["path", "reverse"])
def test_micro_batches_of_many_batches(spark, tmp_dir, order):
    """Fewer micro-batches, the same batches of three files."""
    src = f"{tmp_dir}/src"
    df = spark.createDataFrame([(f"k{i % 9}", i, f"stage II {i}", i % 14) for i in range(90)], "deid_note_key string, note_no long, note_text string, file_no long")
    df.withColumn("file_no", F.format_string("%02d", "file_no")).repartition("file_no").write.partitionBy("file_no").parquet(src)
    paths = sorted(os.path.join(d, f) for d, _, fs in os.walk(src) for f in fs if f.endswith(".parquet"))
    for i, p in enumerate(paths if order == "path" else paths[::-1]):
        os.utime(p, (1_600_000_000 + 10 * i, 1_600_000_000 + 10 * i))
    keys = spark.createDataFrame([(f"k{i}",) for i in range(7)] + [("none",)], "deid_note_key string")
    meta = spark.createDataFrame([("k1", "n1"), ("k1", "n2"), ("k9", "n3")], "deid_note_key string, deid_note_id string")
    ran = incremental.stream_first_batch(spark, src, SCHEMA, keys, f"{tmp_dir}/out", f"{tmp_dir}/ckpt", metadata=meta, batches_per_trigger=2)
    assert ran == 3  # 14 files, six at a time
    rows = readers.read_with_file_order(spark, src)
    key = lambda r: (r.deid_note_key, r.note_no, r.batch)
    assert sorted(map(key, incremental.read_output(spark, f"{tmp_dir}/out").collect())) == sorted(map(key, notes.first_batch_wins(rows, keys).collect()))
    joined = incremental.read_output(spark, f"{tmp_dir}/out", incremental.NOTES)
    assert joined.count() == notes.first_batch_notes(rows, meta.where("deid_note_key = 'k1'")).count() > 0


def test_wanted_texts_are_found_without_moving_texts(spark):
    ids = [0, 1, 63, 64, 65, 200, (1 << 33) + 7, (1 << 33) + 63, (5 << 33) + 64]
    stored = sizing.write_table(spark.createDataFrame([(i, f"t{i}") for i in ids], f"{batching.ROW} long, note_text string"), "texts")
    rows = spark.createDataFrame([(i,) for i in [63, 63, 64, 2, (1 << 33) + 63, (5 << 33) + 64, (2 << 33)]], f"{batching.ROW} long")
    found = batching.texts_of(stored, rows)
    assert sorted(r[0] for r in found.collect()) == [63, 64, (1 << 33) + 63, (5 << 33) + 64]
    assert "Exchange hashpartitioning" not in plan(found) and found.columns == stored.columns
    assert batching.texts_of(stored, rows.limit(0)).count() == 0
    texts = spark.createDataFrame([("k", 1, "one"), ("k", 2, "two")], SCHEMA)
    metadata = spark.createDataFrame([("k", "n", "p")], "deid_note_key string, deid_note_id string, patientdurablekey string")
    stored = batching.stored_texts(texts)
    pairs = sizing.write_table(batching.note_pairs(stored, metadata), "pairs")
    requests = batching.patient_concat(stored, pairs, sizing.write_table(batching.patient_budget(pairs), "budget"))
    moved = [x for x in plan(requests).splitlines() if "Exchange hashpartitioning" in x]
    assert len(moved) == 1 and "patientdurablekey" in moved[0] and requests.count() == 1  # texts move to their patient alone


def test_metadata_move_once_for_orders_and_encounters(spark):
    """The metadata view joined with encounters: one shuffle of each of its tables, one of the encounters."""
    sf = "/root/testdata/sf0.001"
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fx = fixtures.Fixtures(spark, sf)
        joined = notes.join_metadata_encounters(fx.note_metadata, fx.encounterfact)
        assert plan(joined).count("Exchange hashpartitioning") == 3
        plain = spark.sql(fixtures.FIXTURE_SQL["note_metadata"])
        assert fx.note_metadata.exceptAll(plain).count() == 0 == plain.exceptAll(fx.note_metadata).count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_requests_read_only_the_metadata_columns_that_they_use(spark):
    pairs = registry._pairs(registry.Chain(spark, "/root/testdata/sf0.001"))[1]
    assert {"encounterkey", "patientepicid", "datekeyvalue", "enddatekeyvalue"}.isdisjoint(pairs.columns)


def test_a_task_writes_several_files(spark, monkeypatch):
    """The files of the streams: as many as before, by a few tasks, each file whole."""
    monkeypatch.setattr(registry, "ROWS_PER_FILE", 5)
    rows = spark.range(700).select(F.format_string("k%d", F.col("id") % 90).alias("k"), F.col("id").alias("n"), F.floor(F.col("id") / 100).alias("file_no"))
    path = registry._files(types.SimpleNamespace(spark=spark), rows, "several", "n")
    found = [os.path.join(d, f) for d, _, fs in os.walk(path.removeprefix("file:")) for f in fs if f.endswith(".parquet")]
    parts = 1 + 700 // (5 * 7)
    assert len(found) == rows.select("file_no", F.col("n") % parts).distinct().count() > 100
    assert len({re.search(r"/part-(\d+)-", f)[1] for f in found}) <= 8  # shuffle partitions
    back = readers.read_with_file_order(spark, path, file_rank_col="rank")
    ranks = rows.selectExpr("n", f"dense_rank() over (order by file_no, n % {parts}) - 1 as want")
    assert back.join(ranks, "n").where("rank = want").count() == 700
    in_file = back.selectExpr("row_no = row_number() over (partition by rank order by n) - 1 as sorted")
    assert in_file.where("sorted").count() == 700


def test_folders_are_listed_in_few_tasks(spark, tmp_dir):
    for i in range(60):
        os.makedirs(f"{tmp_dir}/l/f={i:02d}")
        open(f"{tmp_dir}/l/f={i:02d}/x.parquet", "wb").write(b"x")
    sc, before = spark.sparkContext, spark.conf.get(readers.LISTING_TASKS)
    sc.setJobGroup("listing", "listing")
    try:
        files = readers.list_files(spark, f"{tmp_dir}/l")
        status = sc.statusTracker()
        tasks = [status.getStageInfo(s).numTasks for j in status.getJobIdsForGroup("listing") for s in status.getJobInfo(j).stageIds]
    finally:
        sc._jsc.clearJobGroup()
    assert tasks and max(tasks) <= 4 * sc.defaultParallelism < 60 and files.count() == 60
    assert spark.conf.get(readers.LISTING_TASKS) == before


def test_rows_of_the_stream_stay_where_they_are(spark, tmp_dir):
    """Batches that lost go to the rows that are read, and the rows are right."""
    src = f"{tmp_dir}/src"
    df = spark.createDataFrame([(f"k{i % 9}", i, f"stage II {i}", i % 14) for i in range(90)] + [(None, 900, "stage I", 3)],
                               "deid_note_key string, note_no long, note_text string, file_no long")
    df.withColumn("file_no", F.format_string("%02d", "file_no")).repartition("file_no").write.partitionBy("file_no").parquet(src)
    paths = sorted(os.path.join(d, f) for d, _, fs in os.walk(src) for f in fs if f.endswith(".parquet"))
    for i, p in enumerate(paths[::-1]):  # later batches come first and lose
        os.utime(p, (1_600_000_000 + 10 * i, 1_600_000_000 + 10 * i))
    keys = spark.createDataFrame([(f"k{i}",) for i in range(7)] * 2 + [("none",), (None,)], "deid_note_key string")
    incremental.stream_first_batch(spark, src, SCHEMA, keys, f"{tmp_dir}/out", f"{tmp_dir}/ckpt")
    won = incremental.read_output(spark, f"{tmp_dir}/out")
    assert "Exchange hashpartitioning" not in plan(won) and won.columns == ["deid_note_key", "batch", "note_no", "note_text"]
    key = lambda r: (r.deid_note_key, r.note_no, r.batch)
    assert sorted(map(key, won.collect())) == sorted(map(key, notes.first_batch_wins(readers.read_with_file_order(spark, src), keys).collect()))
    assert spark.read.parquet(f"{tmp_dir}/out/{incremental.TEXTS}").count() > won.count()
