"""Cohort operators: identifier lookup (C1), cohort encounter filter (C2), unmatched ids
(C5), match report (D1), distinct cohort keys (D4) and patient partition ids (E1)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .index import with_row_index

# The ten encounter columns, in order, and the patient partition rule.
ENCOUNTER_COLUMNS = ("patientdurablekey", "encounterkey", "datekey", "datekeyvalue", "enddatekey",
                     "enddatekeyvalue", "admissiondatekey", "admissiondatekeyvalue", "dischargedatekey",
                     "dischargedatekeyvalue")
PATIENTS_PER_PARTITION = 1000
UNKNOWN_PARTITION = "unknown"


def best_dim_rows(dim: DataFrame, wanted_ids: DataFrame, dim_id: str = "patientepicid",
                  dim_key: str = "patientdurablekey", file_order: str = "file_no",
                  row_order: str = "row_no", id_col: str = "person_source_value") -> DataFrame:
    """One dim row per wanted id: the first file holding the id, the last row in that file.

    Also returns ``rows_in_file``: how many rows of that id the winning file holds (the
    reference counts every one of them as a match event).  Two partial aggregations, no
    window, so a hot id is combined map-side instead of landing in one task.
    """
    ids = wanted_ids.select(F.col(id_col).alias(dim_id)).where(F.col(dim_id).isNotNull()).distinct()
    cut = dim.where(F.col(dim_id).isNotNull()).join(ids, dim_id, "left_semi")
    per_file = cut.groupBy(dim_id, file_order).agg(
        F.count(F.lit(1)).alias("rows_in_file"),
        F.max_by(F.col(dim_key), F.col(row_order)).alias(dim_key))
    best = per_file.groupBy(dim_id).agg(
        F.min_by(F.struct(dim_key, "rows_in_file"), F.col(file_order)).alias("_b"))
    return best.select(dim_id, F.col(f"_b.{dim_key}").alias(dim_key), F.col("_b.rows_in_file").alias("rows_in_file"))


def map_ids(ids: DataFrame, dim: DataFrame, id_col: str = "person_source_value",
            dim_id: str = "patientepicid", dim_key: str = "patientdurablekey",
            file_order: str = "file_no", row_order: str = "row_no", keep_counts: bool = False) -> DataFrame:
    """Every input row kept (duplicates too), ``dim_key`` null when the id is unknown."""
    best = best_dim_rows(dim, ids, dim_id, dim_key, file_order, row_order, id_col)
    # at most one row per requested id; a left join lets AQE broadcast it from runtime size
    mapped = ids.join(best, ids[id_col] == best[dim_id], "left").drop(best[dim_id])
    return mapped if keep_counts else mapped.drop("rows_in_file")


def id_match_report(mapped_with_counts: DataFrame, dim_key: str = "patientdurablekey") -> DataFrame:
    """Total input rows, match events and percentage (0 when there is no input).

    ``matches_found`` counts dim-row x input-row events like the reference, so a dim with
    repeated ids in the winning file can exceed 100 %.
    """
    total = F.count(F.lit(1))
    found = F.coalesce(F.sum("rows_in_file"), F.lit(0)).cast("long")
    matched_rows = F.count(F.col("rows_in_file"))
    return mapped_with_counts.agg(
        total.alias("total_rows"), found.alias("matches_found"), matched_rows.alias("matched_rows"),
        F.when(total > 0, found.cast("double") / total * 100.0).otherwise(F.lit(0.0)).alias("match_percentage"))


def unmatched_ids(ids: DataFrame, mapped_best: DataFrame, id_col: str = "person_source_value",
                  dim_id: str = "patientepicid") -> DataFrame:
    """Distinct requested ids that no dim file holds."""
    wanted = ids.select(id_col).where(F.col(id_col).isNotNull()).distinct()
    return wanted.join(mapped_best, wanted[id_col] == mapped_best[dim_id], "left_anti")


def cohort_keys(mapped: DataFrame, key: str = "patientdurablekey") -> DataFrame:
    """Distinct non-null durable keys of the cohort."""
    return mapped.select(key).where(F.col(key).isNotNull()).distinct()


def filter_encounters(encounters: DataFrame, keys: DataFrame, key: str = "patientdurablekey",
                      columns=ENCOUNTER_COLUMNS) -> DataFrame:
    """C2 (with B1): encounters of cohort patients, the ten columns in order.

    A left-semi join against the distinct keys: each encounter appears once however often
    an id is listed (the reference's 500-id batches could double it).  Whether the keys are
    broadcast is left to Spark's byte threshold and AQE.
    """
    k = keys.select(key).where(F.col(key).isNotNull()).distinct()
    return encounters.select(*columns).join(k, key, "left_semi")


def patient_positions(keys: DataFrame, key: str = "patientdurablekey",
                      per_partition: int = PATIENTS_PER_PARTITION) -> DataFrame:
    """E1 helper: ``(key, partition_key)`` with the position in the sorted distinct keys."""
    distinct = keys.select(key).where(F.col(key).isNotNull()).distinct()
    indexed = with_row_index(distinct, [key], "_pos")
    return indexed.select(key, F.floor(F.col("_pos") / per_partition).cast("long").cast("string")
                          .alias("partition_key"))


def partition_assign(encounters: DataFrame, keys: DataFrame, key: str = "patientdurablekey",
                     per_partition: int = PATIENTS_PER_PARTITION) -> DataFrame:
    """Add ``partition_key`` = position of the patient in the sorted requested keys
    div ``per_partition``, as a string; ``"unknown"`` for a patient outside the list."""
    positions = patient_positions(keys, key, per_partition)
    joined = encounters.join(positions, key, "left")
    part = F.coalesce(F.col("partition_key"), F.lit(UNKNOWN_PARTITION)).alias("partition_key")
    return joined.select(*encounters.columns, part)
