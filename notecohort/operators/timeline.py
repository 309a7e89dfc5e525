"""Per-patient staging timeline (E6): findings in date order with a sequence number and
the previous stage.

Most patients are one window each, ordered by (date, note, finding).  A patient with more
than ``MAX_RUN`` rows would sort in one task: such patients are range-partitioned in (patient,
date, note, finding) order instead, a window runs over each patient's part of a range, and
what the patient brings along from earlier ranges comes from one row per range.  All of it
is native Spark; which patients are long is one narrow aggregation over a written table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .index import range_sorted
from .sizing import write_table

MAX_RUN = 1_000_000


def _in_windows(rows: DataFrame, by: list[str], order: list[str]) -> DataFrame:
    w = Window.partitionBy(*by).orderBy(*order)
    return rows.select("*", F.row_number().over(w).cast("long").alias("seq"), F.lag("stage").over(w).alias("previous_stage"))


def _in_ranges(rows: DataFrame, patient: str, order: list[str]) -> DataFrame:
    """The same for patients of any length: windows over ranges of the written table ``rows``."""
    ordered = range_sorted(rows, [patient, *order], written=True).drop("_local")
    local = write_table(_in_windows(ordered, ["_pid", patient], order), "timeline")
    # one row for each patient's part of a range; a patient with several parts spans whole ranges
    place = F.struct(*order)
    parts = local.groupBy(patient, "_pid").agg(F.count(F.lit(1)).alias("n"), F.max_by("stage", F.struct(place, "seq")).alias("last"))
    before = Window.partitionBy(patient).orderBy("_pid")
    carry = parts.select(F.col(patient).alias("_who"), F.col("_pid").alias("_at"),
                         F.coalesce(F.sum("n").over(before.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"),
                         F.lag("last").over(before).alias("_last"))
    out = local.join(carry, F.col(patient).eqNullSafe(F.col("_who")) & (F.col("_pid") == F.col("_at")))
    first: Column = (F.col("seq") == 1) & (F.col("_before") > 0)
    return out.withColumn("previous_stage", F.when(first, F.col("_last")).otherwise(F.col("previous_stage"))).withColumn(
        "seq", F.col("seq") + F.col("_before")).drop("_who", "_at", "_before", "_last", "_pid")


def staging_timeline(findings: DataFrame, metadata: DataFrame, key: str = "deid_note_key",
                     patient_col: str = "patientdurablekey", date_col: str = "datekeyvalue",
                     note_id_col: str = "deid_note_id", row_cols: tuple[str, ...] = ("note_no",), max_run: int = MAX_RUN) -> DataFrame:
    """``findings``: (key, ``row_cols`` of the text row, finding_no, stage, system) per text
    row; ``metadata``: rows joined with their encounters, which carry the date.

    Output: patient, date, note id, key, ``row_cols``, finding_no, stage, system, seq
    (1-based per patient), previous_stage (null for the patient's first finding).
    """
    order = [date_col, note_id_col, key, *row_cols, "finding_no"]
    f = findings.select(key, *row_cols, "finding_no", "stage", "system")
    rows = f.join(metadata.select(key, patient_col, date_col, note_id_col), key, "inner")
    rows = write_table(rows.select(patient_col, *order, "stage", "system"), "patient-findings")
    n = rows.groupBy(patient_col).agg(F.count(F.lit(1)).alias("_n"))
    long = write_table(n.where(F.col("_n") > max_run).select(F.col(patient_col).alias("_long")), "long-patients")
    if not long.limit(1).count():
        return _in_windows(rows, [patient_col], order)
    # at most rows / max_run patients
    is_long = F.col(patient_col).eqNullSafe(F.col("_long"))
    short, rest = rows.join(long, is_long, "left_anti"), rows.join(long, is_long, "left_semi")
    return _in_windows(short, [patient_col], order).unionByName(_in_ranges(write_table(rest, "long-findings"), patient_col, order))
