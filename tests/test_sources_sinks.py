"""Readers and sinks: round trips into temporary folders."""

import os

import pytest
from pyspark.sql import functions as F

from notecohort.sources import readers, sinks


def test_csv_ids_keep_text(spark, tmp_dir):
    path = f"{tmp_dir}/ids.csv"
    with open(path, "w") as f:
        f.write("person_source_value,other\n0123,a\n123,b\n,c\n")
    df = readers.read_id_csv(spark, path)
    assert [r.person_source_value for r in df.collect()] == ["0123", "123", None]
    with pytest.raises(ValueError):
        readers.read_id_csv(spark, path, id_col="missing")


def test_recursive_glob_and_guard(spark, tmp_dir):
    df = spark.range(10).withColumn("g", F.col("id") % 3)
    df.write.partitionBy("g").parquet(f"{tmp_dir}/nested")
    assert readers.read_recursive_parquet(spark, f"{tmp_dir}/nested").count() == 10
    assert "g" not in readers.read_recursive_parquet(spark, f"{tmp_dir}/nested").columns
    with pytest.raises(FileNotFoundError):
        readers.require_input(spark, f"{tmp_dir}/nested", "*.snappy.parquet")
    readers.require_input(spark, f"{tmp_dir}/nested", "g=*")


def test_tolerant_read_skips_bad_file(spark, tmp_dir):
    spark.range(5).write.parquet(f"{tmp_dir}/t")
    with open(f"{tmp_dir}/t/broken.parquet", "wb") as f:
        f.write(b"not parquet")
    assert readers.read_tolerant(spark, f"{tmp_dir}/t").count() == 5


def test_required_columns_gate(spark, tmp_dir):
    import pandas as pd

    os.makedirs(f"{tmp_dir}/r")
    pd.DataFrame({"patientepicid": ["1"], "patientdurablekey": ["a"]}).to_parquet(f"{tmp_dir}/r/f1.parquet")
    pd.DataFrame({"patientepicid": ["2"]}).to_parquet(f"{tmp_dir}/r/f2.parquet")
    pd.DataFrame({"patientepicid": ["3", None], "patientdurablekey": [None, "b"]}).to_parquet(f"{tmp_dir}/r/f3.parquet")
    both = ["patientepicid", "patientdurablekey"]
    df = readers.read_with_required(spark, f"{tmp_dir}/r", "*.parquet", both)
    # the gate is on files: rows with nulls stay
    assert {(r.patientepicid, r.patientdurablekey) for r in df.collect()} == {("1", "a"), ("3", None), (None, "b")}
    assert readers.read_with_required(spark, f"{tmp_dir}/r", "f2*", both).count() == 0
    assert [r.file_name for r in readers.skipped_files(spark, f"{tmp_dir}/r").collect()] == []
    # names that a URI spells otherwise; with no file to skip the folder is read as a whole
    odd = f"{tmp_dir}/a b+c%20d"
    os.makedirs(odd)
    pd.DataFrame({"patientepicid": ["1"], "patientdurablekey": ["a"]}).to_parquet(f"{odd}/f 1.parquet")
    pd.DataFrame({"patientdurablekey": ["c"], "patientepicid": ["2"], "more": [1]}).to_parquet(f"{odd}/f2.parquet")
    assert sorted(r.patientepicid for r in readers.read_with_required(spark, odd, "*.parquet", both).collect()) == ["1", "2"]
    pd.DataFrame({"patientepicid": [5]}).to_parquet(f"{odd}/f3.parquet")  # another type, and a column is missing
    assert sorted(r.patientepicid for r in readers.read_with_required(spark, odd, "*.parquet", both).collect()) == ["1", "2"]


def test_report_of_partly_read_files(spark, tmp_dir):
    from notecohort.plans.registry import _break_second_group

    rows = spark.range(100).select("id", F.concat(F.lit("text "), F.col("id").cast("string")).alias("t"))
    rows.repartition(1).sortWithinPartitions("id").write.option("parquet.block.row.count.limit", 30).parquet(f"{tmp_dir}/q")
    rows.limit(7).coalesce(1).write.mode("append").parquet(f"{tmp_dir}/q")
    assert {r.status for r in readers.file_report(spark, f"{tmp_dir}/q").collect()} == {"whole"}
    long = [r["_path"] for r in readers.file_report(spark, f"{tmp_dir}/q").collect() if r.promised == 100]
    _break_second_group(spark, long[0])
    with open(f"{tmp_dir}/q/none.parquet", "wb") as f:
        f.write(b"not parquet")
    got = {(r.promised, r.rows_read, r.status) for r in readers.file_report(spark, f"{tmp_dir}/q").collect()}
    assert got == {(100, 30, "partial"), (7, 7, "whole"), (None, 0, "unreadable")}
    assert sorted(r.status for r in readers.skipped_files(spark, f"{tmp_dir}/q").collect()) == ["partial", "unreadable"]


def test_report_of_files_in_several_splits(spark, tmp_dir):
    """Rows behind a break that another split reads are not counted; only the broken group is changed."""
    from notecohort.plans.registry import _break_second_group

    rows = spark.range(1000).select("id", F.sha2(F.col("id").cast("string"), 512).alias("t"))
    rows.repartition(1).sortWithinPartitions("id").write.option("parquet.block.row.count.limit", 30).parquet(f"{tmp_dir}/q")
    path = [f"{tmp_dir}/q/{f}" for f in os.listdir(f"{tmp_dir}/q") if f.endswith(".parquet")][0]
    with open(path, "rb") as f:
        whole = f.read()
    was = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        assert readers.read_tolerant(spark, f"{tmp_dir}/q").rdd.getNumPartitions() > 3
        report = lambda: [(r.promised, r.rows_read, r.status) for r in readers.file_report(spark, f"{tmp_dir}/q").collect()]
        assert report() == [(1000, 1000, "whole")]
        _break_second_group(spark, path)
        assert report() == [(1000, 30, "partial")]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", was)
    with open(path, "rb") as f:
        broken = f.read()
    changed = [i for i, (a, b) in enumerate(zip(whole, broken, strict=True)) if a != b]
    assert 0 < changed[-1] - changed[0] < len(whole) / 20 and not any(broken[i] for i in changed)
    assert len([f for f in os.listdir(f"{tmp_dir}/q") if "part-" in f and not f.startswith(".")]) == 1


def test_file_ranks_by_broadcast_and_by_join(spark, tmp_dir):
    for name in ("b", "a", "c"):
        spark.range(3).coalesce(1).write.parquet(f"{tmp_dir}/o/{name}")
    ranks = readers.file_ranks(spark, f"{tmp_dir}/o", file_rank_col="n")
    rows = readers.list_files(spark, f"{tmp_dir}/o").union(spark.createDataFrame([("new",)], "_path string"))
    for limit in (10, 0):
        got = {(r["_path"].split("/")[-2] if "/" in r["_path"] else None, r.n) for r in readers.with_file_ranks(rows, ranks, "n", "left", limit).collect()}
        assert got == {("a", 0), ("b", 1), ("c", 2), (None, None)}


def test_chunk_files(spark, tmp_dir):
    rows = spark.range(250).select(F.col("id"), (F.col("id") * 7919 % 250).alias("k")).repartition(5)
    sinks.write_chunk_files(rows, f"{tmp_dir}/k", ["k"], chunk_rows=100)
    names = sorted(f for f in os.listdir(f"{tmp_dir}/k") if f.endswith(".parquet"))
    assert [f[:10] for f in names] == ["part-00000", "part-00001", "part-00002"]
    for i, f in enumerate(names):
        assert [r.k for r in spark.read.parquet(f"{tmp_dir}/k/{f}").collect()] == list(range(100 * i, min(100 * i + 100, 250)))
    back = sinks.read_chunk_files(spark, f"{tmp_dir}/k")
    assert back.count() == 250 and back.where("chunk_no <> floor(k / 100) + 1").count() == 0
    sinks.write_chunk_files(rows.limit(0), f"{tmp_dir}/none", ["k"])
    assert sinks.read_chunk_files(spark, f"{tmp_dir}/none").count() == 0


def test_resume_sees_changes(spark, tmp_dir):
    spark.range(5).write.parquet(f"{tmp_dir}/in")

    def run(limit, path="one"):
        return sinks.run_stage(spark, f"{tmp_dir}/{path}", lambda: spark.read.parquet(f"{tmp_dir}/in").where(F.col("id") < limit),
                               inputs=[f"{tmp_dir}/in"], params={"limit": limit})

    def after():
        return sinks.run_stage(spark, f"{tmp_dir}/two", lambda: spark.read.parquet(f"{tmp_dir}/one"), inputs=[f"{tmp_dir}/one"])

    assert (run(3), after()) == (True, True) and (run(3), after()) == (False, False)
    assert (run(4), after()) == (True, True) and (run(4), after()) == (False, False)
    spark.range(1).write.mode("append").parquet(f"{tmp_dir}/in")
    assert (run(4), after()) == (True, True) and spark.read.parquet(f"{tmp_dir}/two").count() == 5
    assert sinks.stage_done(spark, f"{tmp_dir}/one")  # without a manifest the marker alone decides


def test_file_order(spark, tmp_dir):
    for name in ("b", "a", "c"):
        spark.createDataFrame([(name, i) for i in range(3)], "f string, i int").coalesce(1).write.parquet(f"{tmp_dir}/o/{name}")
    rows = readers.read_with_file_order(spark, f"{tmp_dir}/o").collect()
    assert {(r.f, r.i, r.file_no, r.row_no) for r in rows} == {(n, i, k, i) for k, n in enumerate("abc") for i in range(3)}


def test_partitioned_chunked_twin_findings_csv(spark, tmp_dir):
    df = spark.range(250).select(F.col("id").cast("string").alias("patientdurablekey"),
                                 (F.col("id") % 3).cast("string").alias("partition_key"),
                                 F.lit("Stage I").alias("stage"), F.lit("General").alias("system"),
                                 F.lit("ev").alias("evidence"))
    sinks.write_partitioned(df, f"{tmp_dir}/p")
    back = sinks.read_partitioned(spark, f"{tmp_dir}/p", df.schema)
    assert back.count() == 250 and dict(back.dtypes)["partition_key"] == "string"
    assert sorted(d for d in os.listdir(f"{tmp_dir}/p") if d.startswith("partition_key=")) == [
        "partition_key=0", "partition_key=1", "partition_key=2"]
    sinks.write_chunked(df.repartition(1), f"{tmp_dir}/c", chunk_rows=100)
    files = [f for f in os.listdir(f"{tmp_dir}/c") if f.endswith(".parquet")]
    assert sorted(spark.read.parquet(f"{tmp_dir}/c/{f}").count() for f in files) == [50, 100, 100]
    assert spark.read.parquet(f"{tmp_dir}/c").count() == 250
    sinks.write_results(df, f"{tmp_dir}/res.parquet")
    assert spark.read.parquet(f"{tmp_dir}/res.parquet").count() == spark.read.option("header", True).csv(f"{tmp_dir}/res.csv").count()
    sinks.write_findings(df, f"{tmp_dir}/f")
    assert spark.read.parquet(f"{tmp_dir}/f").dtypes == [(c, "string") for c in sinks.FINDINGS_COLUMNS]
    sinks.write_csv(df.select("patientdurablekey"), f"{tmp_dir}/csv")
    assert spark.read.option("header", True).csv(f"{tmp_dir}/csv").count() == 250


def test_combine_and_resume(spark, tmp_dir):
    for b in range(3):
        spark.range(b + 1).write.parquet(f"{tmp_dir}/out/staging_results_batch_{b}.parquet")
    assert sinks.combine_results(spark, f"{tmp_dir}/out").count() == 6
    calls = []

    def build():
        calls.append(1)
        return spark.range(3)

    assert sinks.run_stage(spark, f"{tmp_dir}/stage1", build) is True
    assert sinks.run_stage(spark, f"{tmp_dir}/stage1", build) is False  # resume: already complete
    assert len(calls) == 1 and sinks.stage_done(spark, f"{tmp_dir}/stage1")
