"""Incremental extraction (H1): the stream gives the batch operator's first-batch-wins rows."""

import os
import random

import pytest
from pyspark.sql import types as T

from notecohort.operators import notes, staging
from notecohort.sources import readers
from notecohort.streaming import incremental
from notecohort.streaming import levels as levels_module
from notecohort.streaming.levels import KeyLevels

SCHEMA = T.StructType([T.StructField("deid_note_key", T.StringType()), T.StructField("note_no", T.LongType()),
                       T.StructField("note_text", T.StringType())])


def _files(spark, folder, rows):
    df = spark.createDataFrame(rows, "deid_note_key string, note_no long, note_text string, file_no long")
    df.repartition("file_no").write.partitionBy("file_no").parquet(folder)
    return sorted(os.path.join(d, f) for d, _, fs in os.walk(folder) for f in fs if f.endswith(".parquet"))


@pytest.mark.parametrize("order", ["path", "reverse"])
def test_stream_equals_batch_in_any_order_of_arrival(spark, tmp_dir, order):
    src = f"{tmp_dir}/src"
    paths = _files(spark, src, [(f"k{i % 9}", i, f"text {i} stage II", i % 7) for i in range(60)])
    for i, p in enumerate(paths if order == "path" else paths[::-1]):
        os.utime(p, (1_600_000_000 + 10 * i, 1_600_000_000 + 10 * i))
    keys = spark.createDataFrame([(f"k{i}",) for i in range(7)], "deid_note_key string")
    metadata = spark.createDataFrame([("k1", "n1"), ("k1", "n2"), ("k9", "n3")], "deid_note_key string, deid_note_id string")
    args = (spark, src, SCHEMA, keys, f"{tmp_dir}/out", f"{tmp_dir}/ckpt")
    incremental.stream_first_batch(*args, metadata=metadata)
    streamed = incremental.read_output(spark, f"{tmp_dir}/out")
    rows = readers.read_with_file_order(spark, src)
    batch = notes.first_batch_wins(rows, keys)
    got = sorted((r.deid_note_key, r.note_no, r.batch) for r in streamed.collect())
    assert got == sorted((r.deid_note_key, r.note_no, r.batch) for r in batch.collect()) and got
    found = incremental.read_output(spark, f"{tmp_dir}/out", incremental.FINDINGS)
    want = staging.findings_table(batch, ["deid_note_key", "note_no", "batch"])
    key = lambda r: (r.deid_note_key, r.note_no, r.batch, r.finding_no, r.stage, r.start)
    assert sorted(map(key, found.collect())) == sorted(map(key, want.collect()))
    joined = incremental.read_output(spark, f"{tmp_dir}/out", incremental.NOTES)
    assert joined.count() == notes.first_batch_notes(rows, metadata.where("deid_note_key = 'k1'")).count()
    # a rerun with the same checkpoint has nothing new to do
    assert incremental.stream_first_batch(*args, metadata=metadata) == 0
    assert streamed.count() == len(got)


def test_stream_ends_when_all_keys_are_found(spark, tmp_dir):
    src = f"{tmp_dir}/src"
    paths = _files(spark, src, [("a" if i < 3 else f"z{i}", i, "t", i) for i in range(9)])
    for i, p in enumerate(paths):
        os.utime(p, (1_600_000_000 + 10 * i, 1_600_000_000 + 10 * i))
    keys = spark.createDataFrame([("a",)], "deid_note_key string")
    ran = incremental.stream_first_batch(spark, src, SCHEMA, keys, f"{tmp_dir}/out", f"{tmp_dir}/ckpt", files_per_batch=1)
    assert ran < 9 and incremental.read_output(spark, f"{tmp_dir}/out").count() == 1


def test_errors_are_not_swallowed(spark, tmp_dir):
    with pytest.raises(FileNotFoundError):
        incremental.read_output(spark, f"{tmp_dir}/none")


def test_key_levels(spark, tmp_dir):
    """Runs merge as digits carry; replays and improved batches are handled; the bytes of a run
    follow its own keys."""
    levels = KeyLevels(spark, f"{tmp_dir}/keys", "k", fan=2)
    first, size = {}, []
    for number in range(11):
        rows = [(f"{number}-{i}", 100 + number, True) for i in range(3)] + ([("0-0", 50 - number, False)] if number % 3 == 1 else [])
        for _ in range(2 if number in (3, 7) else 1):  # a replay
            levels.sweep(number - 1)
            run = levels.add(number, spark.createDataFrame(rows, "k string, batch long, fresh boolean"))
        size.append(run.count())
        for k, b, _ in rows:
            first[k] = min(b, first.get(k, b))
        assert {(r.k, r.batch) for r in levels.first_batches(number).collect()} == set(first.items())
        assert len(levels.cover(0, number)) == bin(number + 1).count("1") and levels.last() == number
    levels.sweep(10)
    assert len(levels.runs()) == 3  # 8 + 2 + 1
    assert size == [3, 4, 3, 3, 4, 3, 3, 4, 3, 3, 4]
    with pytest.raises(RuntimeError):
        levels.cover(0, 99)


@pytest.mark.parametrize("files_per_batch", [1, 3])
def test_stream_of_many_micro_batches(spark, tmp_dir, files_per_batch, monkeypatch):
    """Enough micro-batches for merges of two levels, over two runs of the stream, with files in any order."""
    monkeypatch.setattr(levels_module.KeyLevels.__init__, "__defaults__", (2,))
    src, rnd = f"{tmp_dir}/src", random.Random(files_per_batch)
    rows = [(f"k{rnd.randrange(25)}", i, "stage II", i % 11) for i in range(120)]
    paths = _files(spark, src, rows)
    order = rnd.sample(range(len(paths)), len(paths))
    for i, p in enumerate(paths):
        os.utime(p, (1_600_000_000 + 10 * order[i], 1_600_000_000 + 10 * order[i]))
    keys = spark.createDataFrame([(f"k{i}",) for i in range(20)], "deid_note_key string")
    args = (spark, src, SCHEMA, keys, f"{tmp_dir}/out", f"{tmp_dir}/ckpt")
    incremental.stream_first_batch(*args, files_per_batch=files_per_batch)
    streamed = incremental.read_output(spark, f"{tmp_dir}/out")
    batch = notes.first_batch_wins(readers.read_with_file_order(spark, src), keys, files_per_batch=files_per_batch)
    key = lambda r: (r.deid_note_key, r.note_no, r.batch)
    assert sorted(map(key, streamed.collect())) == sorted(map(key, batch.collect()))
    assert incremental.stream_first_batch(*args, files_per_batch=files_per_batch) == 0
