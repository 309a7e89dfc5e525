"""Per-patient request batching for model extraction: context budget (F12), per-patient
concatenation (D5), prompt rendering (F13), result fan-out to notes (F15), per-note mode
(B7).

A note is a text row paired with a metadata row of its key.  Texts are written once, with
a row id, their length and whether they are blank; pairs and budgets use those narrow
columns alone.  The text itself is read again only to build requests: once for patients
whose whole request fits the budget, and once for the distinct text rows that go note by
note; which rows these are is a bit a text row, so texts are not shuffled to be found
(``texts_of``).  So the model sees each text row at most once per mode, however many metadata rows
share it, and no table of texts multiplied by metadata is ever made.

Scale: the budget is a sum of lengths per patient (partial aggregation; a patient with a
third of all notes is summed map-side).  Text is gathered only for patients within the
budget, so every gathered group is bounded (at most ~27.6k characters by default).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.prompts import (CHARS_PER_TOKEN, CHAT_TEMPLATE, MAX_CONTEXT_TOKENS, NOTE_JOINER, RESPONSE_TOKENS,
                                 note_header_length, note_piece, over_budget, render)
from ..functions.responses import parse_response
from ..functions.text import estimated_tokens, non_blank
from .inference import ERROR, infer, token_counts
from .sizing import write_table

ROW, SPOKEN, CHARS = "_row", "_spoken", "_chars"
BY_PATIENT, BY_NOTE = "patient", "note"


def stored_texts(texts: DataFrame, key: str = "deid_note_key", text_col: str = "note_text",
                 index_col: str = "note_no") -> DataFrame:
    """The texts written once with a row id, a not-blank flag and their length.

    Text tables have no reliable unique key, and an id made by
    ``monotonically_increasing_id`` is only stable once written.
    """
    return write_table(texts.select(
        key, index_col, text_col, F.monotonically_increasing_id().alias(ROW), non_blank(F.col(text_col)).alias(SPOKEN),
        F.length(text_col).cast("long").alias(CHARS)), "texts")


def note_pairs(stored: DataFrame, metadata: DataFrame, key: str = "deid_note_key", text_col: str = "note_text") -> DataFrame:
    """C4 without the text: every text row paired with every metadata row of its key."""
    return stored.drop(text_col).join(metadata, key, "inner")


def texts_of(stored: DataFrame, rows: DataFrame) -> DataFrame:
    """The rows of ``stored`` whose row id is among those of ``rows`` (repeats allowed).

    The wanted ids are written as masks of 64, about a byte a text row before compression, so
    Spark sends them to the scan of the texts (up to its broadcast threshold, beyond it both
    sides are shuffled) and only wanted texts go on.
    """
    word, bit = F.expr(f"{ROW} div 64").alias("_word"), f"cast({ROW} % 64 as int)"
    masks = rows.groupBy(word).agg(F.bit_or(F.expr(f"shiftleft(1L, {bit})")).alias("_mask"))
    found = stored.withColumn("_word", word).join(write_table(masks, "wanted-rows"), "_word")
    return found.where(F.getbit("_mask", F.expr(bit)) == 1).select(*stored.columns)


def patient_budget(pairs: DataFrame, patient_col: str = "patientdurablekey", index_col: str = "note_no",
                   max_context: int = MAX_CONTEXT_TOKENS) -> DataFrame:
    """F12 per patient: non-blank notes, request length, estimated tokens and the gate.

    The request length is computed from lengths alone (sum of header+text lengths plus
    the joiners), never by building the text.  Patients without a non-blank note are
    absent (the reference skips them).
    """
    nb = pairs.where(F.col(patient_col).isNotNull() & F.col(SPOKEN))
    per = nb.groupBy(patient_col).agg(
        F.count(F.lit(1)).alias("n_notes"),
        F.sum(note_header_length(F.col(index_col)) + F.col(CHARS)).alias("_sum"))
    total = (F.col("_sum") + F.lit(len(NOTE_JOINER)) * (F.col("n_notes") - 1)).cast("long")
    return per.select(patient_col, "n_notes", total.alias("request_chars"),
                      estimated_tokens(total, CHARS_PER_TOKEN).alias("est_tokens"),
                      (~over_budget(total, max_context)).alias("fits"))


def patient_concat(stored: DataFrame, pairs: DataFrame, budget: DataFrame, patient_col: str = "patientdurablekey",
                   text_col: str = "note_text", index_col: str = "note_no",
                   order_cols: list[str] | None = None) -> DataFrame:
    """``(patient, request_text)`` for the patients whose ``budget`` row fits.

    Non-blank notes, each as ``--- NOTE {idx} ---\\n{text}``, joined by a blank line, in
    ``order_cols`` order (default: the index column).
    """
    order_cols = order_cols or [index_col]
    wanted = pairs.where(F.col(SPOKEN)).join(budget.where("fits").select(patient_col), patient_col, "left_semi")
    wanted = wanted.select(ROW, patient_col, *[F.col(c).alias(f"_o{i}") for i, c in enumerate(order_cols)])
    wanted = write_table(wanted, "wanted-notes")
    rows = wanted.join(texts_of(stored.select(ROW, index_col, text_col), wanted), ROW)
    item = F.struct(*[f"_o{i}" for i in range(len(order_cols))], note_piece(F.col(index_col), F.col(text_col)).alias("piece"))
    grouped = rows.groupBy(patient_col).agg(F.array_sort(F.collect_list(item)).alias("_items"))
    return grouped.select(patient_col, F.array_join(F.transform("_items", lambda x: x["piece"]), NOTE_JOINER)
                          .alias("request_text"))


def _parsed(responses: DataFrame) -> DataFrame:
    """Answers with a finding or an error."""
    out = responses.withColumn("_p", parse_response(F.col("response")))
    out = out.select(*[c for c in responses.columns if c not in ("response", ERROR)],
                     F.col("_p.stage").alias("stage"), F.col("_p.system").alias("system"), ERROR)
    return write_table(out, "answers").where(F.col("stage").isNotNull() | F.col(ERROR).isNotNull())


def _by_note(stored: DataFrame, pairs: DataFrame, model_factory: Callable, text_col: str, template: str) -> DataFrame:
    """The model's answer for every distinct non-blank text row of ``pairs``, copied to its notes."""
    wanted = pairs.where(F.col(SPOKEN))
    texts = texts_of(stored.select(ROW, text_col), wanted)
    answers = infer(texts.select(ROW, render(F.col(text_col), template).alias("_prompt")), [ROW], "_prompt", model_factory)
    return wanted.join(_parsed(answers), ROW)


def _notes(rows: DataFrame, pairs: DataFrame, mode: str | Column) -> DataFrame:
    keep = [c for c in pairs.columns if c not in (ROW, SPOKEN, CHARS)]
    return rows.select(*keep, "stage", "system", ERROR, (F.lit(mode) if isinstance(mode, str) else mode).alias("request_mode"))


def extract_per_note(texts: DataFrame, metadata: DataFrame, model_factory: Callable, key: str = "deid_note_key",
                     text_col: str = "note_text", index_col: str = "note_no", template: str = CHAT_TEMPLATE) -> DataFrame:
    """B7 / per-note mode: one request per distinct non-blank text row; the notes with a
    finding (or a failed call), with key, index and metadata columns, ``stage, system,
    error, request_mode``."""
    stored = stored_texts(texts, key, text_col, index_col)
    pairs = note_pairs(stored, metadata, key, text_col)
    return _notes(_by_note(stored, pairs, model_factory, text_col, template), pairs, BY_NOTE)


def extract_by_patient(texts: DataFrame, metadata: DataFrame, model_factory: Callable, key: str = "deid_note_key",
                       patient_col: str = "patientdurablekey", text_col: str = "note_text",
                       index_col: str = "note_no", order_cols: list[str] | None = None,
                       template: str = CHAT_TEMPLATE, max_context: int = MAX_CONTEXT_TOKENS,
                       token_counter: Callable | None = None) -> DataFrame:
    """Patient mode: one request per patient whose notes fit ``max_context``, else per note.

    Which of the two a note went through is its ``request_mode``.  A patient's single result
    is copied to all of its notes, blank ones included (F15); a patient request without a
    finding drops the patient.  Notes with a null patient key are not processed (grouping
    drops null keys in the reference).  ``token_counter`` adds the exact gate (G3).
    """
    stored = stored_texts(texts, key, text_col, index_col)
    pairs = write_table(note_pairs(stored, metadata, key, text_col).where(F.col(patient_col).isNotNull()), "pairs")
    budget = write_table(patient_budget(pairs, patient_col, index_col, max_context), "budget")
    requests = patient_concat(stored, pairs, budget, patient_col, text_col, index_col, order_cols)
    requests = requests.select(patient_col, render(F.col("request_text"), template).alias("prompt"))
    single = budget.where("NOT fits").select(patient_col)
    if token_counter is not None:  # G3: exact check for the candidates only, run once
        counted = write_table(token_counts(requests, "prompt", token_counter), "requests")
        fits = F.col("n_tokens") < max_context - RESPONSE_TOKENS
        single = single.unionByName(counted.where(~fits).select(patient_col))
        requests = counted.where(fits).drop("n_tokens")
    answers = _parsed(infer(requests, [patient_col], "prompt", model_factory))
    batched = _notes(pairs.join(answers, patient_col), pairs, BY_PATIENT)
    alone = pairs.join(single, patient_col, "left_semi")
    return batched.unionByName(_notes(_by_note(stored, alone, model_factory, text_col, template), pairs, BY_NOTE))
