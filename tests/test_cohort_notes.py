"""Cohort and note operators: invariants and brute-force checks on small tables."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from notecohort.operators import cohort, notes
from notecohort.operators.index import with_row_index
from notecohort.operators.staging import finding_summary
from notecohort.operators.timeline import staging_timeline
from notecohort.sources.readers import read_with_file_order


def _ids(spark, values):
    return spark.createDataFrame([(v,) for v in values], "person_source_value string")


def test_id_mapping_first_file_then_last_row(spark):
    ids = _ids(spark, ["1", "2", "2", "3", None, "9"])
    dim = spark.createDataFrame([
        ("1", "K1-late", 2, 0), ("1", "K1-a", 0, 5), ("1", "K1-b", 0, 7),  # file 0 wins, last row (7)
        ("2", "K2", 1, 0), ("3", "K3-x", 1, 3), ("3", "K3-y", 1, 1), (None, "KN", 0, 0)],
        "patientepicid string, patientdurablekey string, file_no int, row_no long")
    mapped = cohort.map_ids(ids, dim, keep_counts=True)
    rows = sorted((r.person_source_value or "", r.patientdurablekey or "", r.rows_in_file or 0) for r in mapped.collect())
    assert rows == [("", "", 0), ("1", "K1-b", 2), ("2", "K2", 1), ("2", "K2", 1), ("3", "K3-x", 2), ("9", "", 0)]
    assert mapped.count() == ids.count()  # every input row kept
    report = cohort.id_match_report(mapped).collect()[0]
    assert (report.total_rows, report.matches_found, report.matched_rows) == (6, 6, 4)
    assert abs(report.match_percentage - 100.0) < 1e-9
    best = cohort.best_dim_rows(dim, ids)
    assert [r.person_source_value for r in cohort.unmatched_ids(ids, best).collect()] == ["9"]


def test_id_mapping_from_files(spark, tmp_dir):
    """File order from sorted paths and row index inside each file."""
    for i, rows in enumerate([[("5", "A"), ("6", "B")], [("5", "C"), ("7", "D"), ("7", "E")]]):
        spark.createDataFrame(rows, "patientepicid string, patientdurablekey string").coalesce(1) \
            .write.parquet(f"{tmp_dir}/part{i}.snappy.parquet")
    dim = read_with_file_order(spark, tmp_dir)
    mapped = cohort.map_ids(_ids(spark, ["5", "7"]), dim)
    assert sorted((r.person_source_value, r.patientdurablekey) for r in mapped.collect()) == [("5", "A"), ("7", "E")]


def test_encounter_filter_semi_join(spark):
    enc = spark.createDataFrame([(k, f"e{i}") + (None,) * 8 for i, k in enumerate(["a", "a", "b", "c", None])],
                                ", ".join(f"{c} string" for c in cohort.ENCOUNTER_COLUMNS))
    keys = spark.createDataFrame([("a",), ("a",), ("c",), (None,)], "patientdurablekey string")
    out = cohort.filter_encounters(enc, keys)
    assert out.columns == list(cohort.ENCOUNTER_COLUMNS)
    assert sorted(r.encounterkey for r in out.collect()) == ["e0", "e1", "e3"]  # once each, never doubled


def test_row_index_and_partition_assign(spark):
    keys = spark.createDataFrame([(f"k{i:05d}",) for i in range(2500)] + [("k00001",)], "patientdurablekey string")
    pos = cohort.patient_positions(keys, per_partition=1000).collect()
    got = {r.patientdurablekey: r.partition_key for r in pos}
    assert got["k00000"] == "0" and got["k00999"] == "0" and got["k01000"] == "1" and got["k02499"] == "2"
    df = spark.range(0, 5000).select(((F.col("id") * 7919) % 5000).alias("v"))
    idx = with_row_index(df, ["v"], "pos").collect()
    assert all(r.v == r.pos for r in idx) and len(idx) == 5000


def test_first_batch_wins_and_coverage(spark):
    rows = [("k1", 0, "a"), ("k1", 1, "b"), ("k1", 4, "c"), ("k2", 5, "d"), ("k2", 5, "e"), ("k3", 2, "f"),
            ("kx", 0, "g")]
    texts = spark.createDataFrame(rows, "deid_note_key string, file_no long, note_text string")
    keys = spark.createDataFrame([("k1",), ("k2",), ("k3",), ("k4",), (None,)], "deid_note_key string")
    out = notes.first_batch_wins(texts, keys)
    assert sorted((r.deid_note_key, r.note_text) for r in out.collect()) == [
        ("k1", "a"), ("k1", "b"), ("k2", "d"), ("k2", "e"), ("k3", "f")]
    again = notes.first_batch_wins(out.drop("batch"), keys)  # idempotent
    assert again.count() == out.count()
    cov = [(r.batch, r.found_new, r.found_total, r.wanted) for r in
           notes.note_key_coverage(texts, keys).orderBy("batch").collect()]
    assert cov == [(0, 2, 2, 4), (1, 1, 3, 4)]


def test_blank_and_note_type_filters(spark):
    df = spark.createDataFrame([(1, "x"), (2, " \t\n"), (3, "  "), (4, None), (5, "\x1c"), (6, " y ")],
                               "i int, note_text string")
    assert sorted(r.i for r in notes.nonblank_notes(df).collect()) == [1, 6]
    meta = spark.createDataFrame([("Imaging",), ("Telephone Encounter",), ("H&P",)], "note_type string")
    assert sorted(r.note_type for r in notes.note_type_filter(meta).collect()) == ["H&P", "Imaging"]


def test_metadata_join_null_keys(spark):
    meta = spark.createDataFrame([("p", "e", None, "n1", "d", "t"), ("p", "e", "E1", "n2", "d", "t")],
                                 "patientdurablekey string, patientepicid string, encounterkey string, "
                                 "deid_note_key string, deid_note_id string, note_type string")
    enc = spark.createDataFrame([("q", None, None, None), ("q", "E1", None, None)],
                                "patientdurablekey string, encounterkey string, datekeyvalue timestamp, "
                                "enddatekeyvalue timestamp")
    assert notes.join_metadata_encounters(meta, enc).count() == 1
    row = notes.join_metadata_encounters(meta, enc).collect()[0]
    assert (row.patientdurablekey, row.encounter_patientdurablekey) == ("p", "q")


def test_hot_key_holds_a_third_of_rows(spark):
    """One key with a third of all rows: winners per key come from partial aggregations,
    and the results equal a brute-force computation."""
    rows = [("hot", i, f"h{i}", i % 7) for i in range(3000)] + \
           [(f"k{i % 500}", 10_000 + i, f"t{i}", (i * 3) % 7) for i in range(6000)]
    texts = spark.createDataFrame(rows, "deid_note_key string, note_no long, note_text string, file_no long")
    keys = spark.createDataFrame([("hot",)] + [(f"k{i}",) for i in range(500)], "deid_note_key string")
    got = sorted((r.deid_note_key, r.note_no) for r in notes.first_batch_wins(texts, keys).collect())
    first = {}
    for k, n, _, f in rows:
        first[k] = min(first.get(k, 99), f // 3)
    assert got == sorted((k, n) for k, n, _, f in rows if f // 3 == first[k])

    ids = _ids(spark, ["hot"] * 2000 + [str(i) for i in range(1000)])
    dim = spark.createDataFrame([("hot", f"H{j}", j % 3, j) for j in range(3000)] +
                                [(str(i), f"K{i}", 1, i) for i in range(1000)],
                                "patientepicid string, patientdurablekey string, file_no int, row_no long")
    mapped = cohort.map_ids(ids, dim, keep_counts=True)
    hot = mapped.where("person_source_value = 'hot'").select("patientdurablekey", "rows_in_file").distinct().collect()
    assert [(r.patientdurablekey, r.rows_in_file) for r in hot] == [("H2997", 1000)]  # file 0, last row
    assert mapped.count() == 3000


@pytest.mark.parametrize("max_run", [1_000_000, 100, 1])
def test_timeline_over_many_ranges(spark, max_run):
    """A patient that fills several ranges, repeated encounters and null dates and patients."""
    rows = []
    for i in range(3000):
        patient = "hot" if i % 3 else (None if i % 5 == 0 else f"p{i % 40}")
        rows.append((f"k{i % 700}", patient, i % 11 if i % 13 else None, f"n{i % 900}"))
    schema = "deid_note_key string, patientdurablekey string, datekeyvalue int, deid_note_id string"
    metadata = spark.createDataFrame(rows + rows[:200], schema)
    found = [(f"k{i}", i, n, f"Stage {n}", "General") for i in range(700) for n in range(i % 3)]
    findings = spark.createDataFrame(found, "deid_note_key string, note_no long, finding_no int, stage string, system string")
    plan = staging_timeline(findings, metadata, max_run=max_run)
    assert "Python" not in (text := plan._jdf.queryExecution().toString()) and "InArrow" not in text
    out = plan.collect()
    low = lambda *x: tuple((v is not None, v) for v in x)  # noqa: E731  nulls first
    every = sorted(((p, d, n, k, no, fi, s) for k, p, d, n in rows + rows[:200] for k2, no, fi, s, _ in found if k == k2),
                   key=lambda r: low(r[0], r[1], r[2], r[3]) + r[4:6])
    want, last, seq = [], object(), 0
    for i, r in enumerate(every):
        seq = seq + 1 if r[0] == last else 1
        want.append((*r, seq, every[i - 1][6] if seq > 1 else None))
        last = r[0]
    got = [(r.patientdurablekey, r.datekeyvalue, r.deid_note_id, r.deid_note_key, r.note_no, r.finding_no, r.stage, r.seq, r.previous_stage)
           for r in out]
    assert Counter(got) == Counter(want)


def test_summary_with_repeated_keys(spark):
    first = spark.createDataFrame([("k", "Stage I"), ("k", None), ("m", None)], "deid_note_key string, stage string")
    metadata = spark.createDataFrame([("k", "p"), ("k", "q"), ("m", "r")], "deid_note_key string, patientdurablekey string")
    assert tuple(finding_summary(first, metadata).first()) == (2, 2, 3)


def test_partition_ids_and_chunks_take_several_values(spark):
    enc = spark.range(1000).select(*[F.concat(F.lit("p"), F.lpad((F.col("id") % 70).cast("string"), 3, "0")).alias("patientdurablekey"),
                                     F.col("id").cast("string").alias("encounterkey")])
    keys = enc.where("patientdurablekey < 'p050'").select("patientdurablekey")
    got = {(r.patientdurablekey, r.partition_key) for r in cohort.partition_assign(enc, keys, per_partition=10).collect()}
    assert got == {(f"p{i:03d}", str(i // 10) if i < 50 else "unknown") for i in range(70)}
    sizes = notes.chunk_assign(enc, ["encounterkey"], 300).groupBy("chunk_no").count().collect()
    assert {(r.chunk_no, r["count"]) for r in sizes} == {(1, 300), (2, 300), (3, 300), (4, 100)}


def test_step_counts_without_a_second_run(spark):
    """Steps are counted while they run: a row of a step is computed once."""
    seen = spark.sparkContext.accumulator(0)

    @F.udf("long")
    def tick(x):
        seen.add(1)
        return x

    counts = notes.StepCounts(spark)
    first = counts.of("first", spark.range(100).select(tick("id").alias("id")))
    second = counts.of("second", first.where(F.col("id") % 4 == 0))
    joined = counts.of("joined", second.join(spark.range(50), "id"))
    joined.write.format("noop").mode("overwrite").save()
    assert [tuple(r) for r in counts.table().collect()] == [("first", 100), ("second", 25), ("joined", 13)]
    assert seen.value == 100


def test_bucketed_text_is_not_shuffled(spark, tmp_dir):
    text = spark.range(500).select((F.col("id") % 90).cast("string").alias("deid_note_key"), F.col("id").alias("note_no"),
                                   F.lit("words").alias("note_text"))
    meta = spark.range(120).select((F.col("id") % 95).cast("string").alias("deid_note_key"), F.col("id").cast("string").alias("deid_note_id"))
    want = Counter(map(tuple, notes.join_text_metadata(text, meta).collect()))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        joined = notes.join_text_metadata(notes.write_bucketed(text, "bucketed_text", "deid_note_key", 4, f"{tmp_dir}/t"),
                                          notes.write_bucketed(meta, "bucketed_meta", "deid_note_key", 4, f"{tmp_dir}/m"))
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
        assert Counter(map(tuple, joined.collect())) == want
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP TABLE bucketed_text")
        spark.sql("DROP TABLE bucketed_meta")
