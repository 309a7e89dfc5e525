"""Findings operators over note tables: per-rule and all-rule findings (F1-F11), the
fixed-schema finding table (A11), first finding per note (E4 + B5), rule overrides (G1)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.findings import add_findings, add_first_finding
from ..functions.patterns import BASIC_RULES, RULES, RULES_BY_NAME, rule_set
from ..functions.prompts import FINDINGS_TEMPLATE, render
from ..functions.responses import parse_response
from ..functions.text import non_blank
from .inference import ERROR, infer
from .sizing import filter_here, spread, write_table


def findings_table(notes: DataFrame, key_cols: list[str], text_col: str = "note_text", rules=RULES,
                   partitions: int | None = None) -> DataFrame:
    """One row per finding: ``key_cols``, finding_no (0-based, rule order then text order),
    rule, stage, system, evidence, start.  ``partitions`` spreads a coarsely split input."""
    with_f = add_findings(spread(notes.select(*key_cols, text_col), partitions), text_col, rules, "_findings")
    # posexplode_outer, not posexplode: for an inner generator Catalyst infers a
    # ``size(_findings) > 0`` filter and pushes it below the projection, which re-inlines
    # every regex pass of the findings expression into that filter.
    exploded = (with_f.select(*key_cols, F.posexplode_outer("_findings").alias("finding_no", "_f"))
                      .where(F.col("finding_no").isNotNull()))
    return exploded.select(*key_cols, "finding_no", "_f.rule", "_f.stage", "_f.system", "_f.evidence", "_f.start")


def rule_findings(notes: DataFrame, rule_name: str, key_cols: list[str], text_col: str = "note_text") -> DataFrame:
    """Findings of a single rule (F1..F7)."""
    return findings_table(notes, key_cols, text_col, (RULES_BY_NAME[rule_name],))


def basic_findings(notes: DataFrame, key_cols: list[str], text_col: str = "note_text") -> DataFrame:
    """the smaller extractor (TNM standard, then stage standard)."""
    return findings_table(notes, key_cols, text_col, BASIC_RULES)


def override_findings(notes: DataFrame, overrides: dict, key_cols: list[str], text_col: str = "note_text") -> DataFrame:
    """G1: findings with user rule overrides applied."""
    return findings_table(notes, key_cols, text_col, rule_set(overrides))


def patient_findings(texts: DataFrame, metadata: DataFrame, key: str = "deid_note_key",
                     patient_col: str = "patientdurablekey", text_col: str = "note_text", rules=BASIC_RULES) -> DataFrame:
    """The fixed four-string-column finding table (patient, stage, system, evidence), by
    default of the basic rules.

    Findings depend on the text alone, so they are computed once per distinct text row
    and then joined to the metadata rows (which multiply them), instead of scanning each
    text once per metadata row.
    """
    f = findings_table(texts, [key], text_col, rules)
    joined = f.join(metadata.select(key, patient_col), key, "inner")
    return joined.select(F.col(patient_col).cast("string").alias("patientdurablekey"),
                         F.col("stage").cast("string"), F.col("system").cast("string"),
                         F.col("evidence").cast("string"))


def first_findings(notes: DataFrame, text_col: str = "note_text", rules=RULES, keep_all: bool = False) -> DataFrame:
    """E4 + B5: note columns plus ``stage``/``system`` of the first finding; only notes
    with a finding unless ``keep_all``."""
    out = add_first_finding(notes, text_col, rules, "_ff")
    out = out.select(*notes.columns, F.col("_ff.stage").alias("stage"), F.col("_ff.system").alias("system"))
    return out if keep_all else filter_here(out, F.col("stage").isNotNull())


def finding_summary(first: DataFrame, metadata: DataFrame, key: str = "deid_note_key",
                    patient_col: str = "patientdurablekey") -> DataFrame:
    """Notes with staging, patients with staging, unique patients.

    ``first`` holds one row per text row (null stage when it has no finding).  A note is a
    text row paired with a metadata row of its key, so one join makes the notes, also where
    a key has several text rows.  Both
    sides are counted by key before it, so a key's notes are never made one by one, and a patient is
    one row (the null patient's too, which counts in notes alone) when the totals are taken.
    """
    staged = first.groupBy(key).agg(F.count_if(F.col("stage").isNotNull()).alias("_staged"))
    of_patient = metadata.where(F.col(key).isNotNull()).groupBy(key, patient_col).agg(F.count(F.lit(1)).alias("_rows"))
    per = staged.join(of_patient, key, "inner").groupBy(patient_col).agg(F.sum(F.col("_staged") * F.col("_rows")).alias("_notes"))
    known = F.col(patient_col).isNotNull()
    return per.agg(F.coalesce(F.sum("_notes"), F.lit(0)).alias("notes_with_staging"),
                   F.count_if(known & (F.col("_notes") > 0)).alias("patients_with_staging"),
                   F.count_if(known).alias("unique_patients"))


def model_and_basic_findings(notes: DataFrame, key_cols: list[str], model_factory, text_col: str = "note_text",
                             template: str = FINDINGS_TEMPLATE) -> DataFrame:
    """Per note, the finding parsed from the model's response, then the basic rules' findings.

    Columns: ``key_cols``, finding_no, source (``model`` or ``regex``), stage, system,
    evidence (the response for the model's finding), error (of a failed model call, which
    then has no stage).
    """
    asked = notes.where(non_blank(F.col(text_col))).select(*key_cols, render(F.col(text_col), template).alias("_prompt"))
    answers = infer(asked, key_cols, "_prompt", model_factory).withColumn("_p", parse_response(F.col("response")))
    by_model = write_table(answers.select(*key_cols, F.lit("model").alias("source"), "_p.stage", "_p.system",
                                          F.col("response").alias("evidence"), ERROR), "model-findings")
    by_model = by_model.where(F.col("stage").isNotNull() | F.col(ERROR).isNotNull())
    has = by_model.where(F.col("stage").isNotNull()).select(*[F.col(c).alias(f"_{c}") for c in key_cols], F.lit(1).alias("_one"))
    by_rule = basic_findings(notes, key_cols, text_col)
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in key_cols]
    by_rule = by_rule.join(has, same, "left")  # key columns name a text row
    number = F.col("finding_no") + F.coalesce("_one", F.lit(0))
    return by_model.select(*key_cols, F.lit(0).alias("finding_no"), "source", "stage", "system", "evidence", ERROR).unionByName(
        by_rule.select(*key_cols, number.alias("finding_no"), F.lit("regex").alias("source"), "stage", "system", "evidence",
                       F.lit(None).cast("string").alias(ERROR)))
