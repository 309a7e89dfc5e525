"""Per-patient batching, budget boundary, prompt rendering, inference hook and fan-out."""

import os

from pyspark.sql import functions as F

from notecohort.functions.prompts import CHAT_TEMPLATE, over_budget, render
from notecohort.operators import batching
from notecohort.operators.inference import infer, token_counts
from notecohort.plans.models import keyword_model_factory


def test_budget_boundary(spark):
    df = spark.createDataFrame([(27625,), (27626,)], "n long")
    assert [r.o for r in df.select(over_budget(F.col("n")).alias("o")).collect()] == [False, True]


def _tables(spark, rows):
    """Texts and metadata, one of each per note; the key is the note id."""
    notes = spark.createDataFrame(rows, "patientdurablekey string, note_no long, deid_note_id string, note_text string")
    notes = notes.withColumn("deid_note_key", F.col("deid_note_id"))
    return notes.select("deid_note_key", "note_no", "note_text"), notes.select("deid_note_key", "deid_note_id", "patientdurablekey")


def test_concat_format_and_order(spark):
    texts, metadata = _tables(spark, [("p", 2, "b", "second"), ("p", 1, "a", "first"), ("p", 3, "c", "  "), (None, 4, "d", "x")])
    stored = batching.stored_texts(texts)
    pairs = batching.note_pairs(stored, metadata)
    budget = batching.patient_budget(pairs)
    assert [(r.patientdurablekey, r.n_notes) for r in budget.collect()] == [("p", 2)]
    text = batching.patient_concat(stored, pairs, budget).collect()[0].request_text
    assert text == "--- NOTE 1 ---\nfirst\n\n--- NOTE 2 ---\nsecond"
    assert budget.collect()[0].request_chars == len(text)
    tight = batching.patient_budget(pairs, max_context=10)  # nothing is gathered beyond the budget
    assert batching.patient_concat(stored, pairs, tight).count() == 0


def test_patient_mode_fans_out_and_per_note_fallback(spark):
    big = "y" * 30000 + " Stage IV"
    texts, metadata = _tables(spark, [("p1", 1, "a", "Stage IIB noted"), ("p1", 2, "b", " "),   # batched, blank kept
                                      ("p2", 3, "c", "no staging"),                              # batched, no hit: dropped
                                      ("p3", 4, "d", big), ("p3", 5, "e", "T2N1M0 seen"), ("p3", 6, "f", "nothing")])
    out = batching.extract_by_patient(texts, metadata, keyword_model_factory())
    got = sorted((r.deid_note_id, r.stage, r.system, r.request_mode) for r in out.collect())
    assert got == [("a", "IIB", "General", "patient"), ("b", "IIB", "General", "patient"), ("d", "IV", "General", "note"),
                   ("e", "T2N1M0", "TNM", "note")]
    per_note = batching.extract_per_note(texts, metadata, keyword_model_factory())
    assert sorted(r.deid_note_id for r in per_note.collect()) == ["a", "d", "e"]


def test_model_sees_each_text_once(spark, tmp_dir):
    """Many metadata rows and repeated text rows: one call per distinct non-blank text row."""
    def _recording_factory(folder=tmp_dir):
        import os
        import uuid

        def respond(prompts):
            for _ in prompts:
                open(os.path.join(folder, uuid.uuid4().hex), "w").close()
            return ["Stage: II"] * len(prompts)

        return respond

    texts = spark.createDataFrame([("k", 1, "one"), ("k", 2, "two"), ("b", 3, " "), ("other", 4, "unwanted")],
                                  "deid_note_key string, note_no long, note_text string")
    metadata = spark.createDataFrame([("k", f"n{i}", "p") for i in range(50)] + [("b", "n", "p")],
                                     "deid_note_key string, deid_note_id string, patientdurablekey string")
    out = batching.extract_per_note(texts, metadata, _recording_factory)
    assert out.count() == 100 and len(os.listdir(tmp_dir)) == 2


def test_two_models_in_one_session(spark):
    def says(answer):
        return lambda: (lambda prompts: [answer] * len(prompts))

    df = spark.range(20).select(F.col("id").alias("i"), F.lit("x").alias("prompt"))
    one, two = infer(df, ["i"], "prompt", says("Stage: I")), infer(df, ["i"], "prompt", says("Stage: IV"))
    assert {r.response for r in one.collect()} == {"Stage: I"} and {r.response for r in two.collect()} == {"Stage: IV"}
    counts = [token_counts(df, "prompt", lambda n=n: (lambda prompts: [n] * len(prompts))) for n in (3, 5)]
    assert [{r.n_tokens for r in c.collect()} for c in counts] == [{3}, {5}]


def test_inference_errors_are_kept(spark):
    def _flaky_factory():  # nested: pickled by value for the Python workers
        def respond(prompts):
            if any("boom" in p for p in prompts):
                raise RuntimeError("model failure")
            return ["Stage: I" for _ in prompts]
        return respond

    df = spark.createDataFrame([(i, "boom" if i % 3 == 0 else "fine") for i in range(10)], "i int, t string")
    out = infer(df.select("i", render(F.col("t"), CHAT_TEMPLATE).alias("prompt")), ["i"], "prompt", _flaky_factory, batch_rows=4)
    got = {r.i: (r.response, r.error) for r in out.collect()}
    assert all(got[i] == ((None, "RuntimeError: model failure") if i % 3 == 0 else ("Stage: I", None)) for i in range(10))
    texts, metadata = _tables(spark, [("p", 1, "a", "boom"), ("p", 2, "b", "fine")])
    rows = batching.extract_per_note(texts, metadata, _flaky_factory).collect()
    assert sorted((r.deid_note_id, r.stage, r.error) for r in rows) == [("a", None, "RuntimeError: model failure"), ("b", "I", None)]


def test_exact_token_gate(spark):
    """A patient that fits the estimate but not the exact count goes note by note."""
    def _word_counter():
        return lambda prompts: [len(p.split()) for p in prompts]

    texts, metadata = _tables(spark, [("p", 1, "a", "x " * 3000 + "Stage IV"), ("p", 2, "b", "T1N0M0")])
    out = batching.extract_by_patient(texts, metadata, keyword_model_factory(), token_counter=_word_counter, max_context=3000)
    assert sorted((r.deid_note_id, r.stage, r.request_mode) for r in out.collect()) == [("a", "IV", "note"), ("b", "T1N0M0", "note")]
