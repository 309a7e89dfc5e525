"""Model-response parser (F14): the reference's eight cases, edge cases, differential."""

import random

from pyspark.sql import functions as F

from notecohort.functions.responses import parse_response

import pyoracle

CASES = [
    ("NA", (None, None)), ("Stage: IIB", ("IIB", "General")), ("TNM: T2N1M0", ("T2N1M0", "TNM")),
    ("TNM: T3N2M1\n", ("T3N2M1", "TNM")), ("Stage: IV\nAdditional notes", ("IV", "General")),
    ("T3N2M1", ("T3N2M1", "TNM")), ("Based on the clinical note, TNM: T2N0M0", ("T2N0M0", "TNM")),
    ("After reviewing the note, Stage: IIIA", ("IIIA", "General")),
    # edge cases
    ("TNM:", ("", "TNM")), ("DNA Stage: II", (None, None)), ("Stage: II TNM: T1N1M1", ("T1N1M1", "TNM")),
    ("(T1N0M0).", (None, None)), ("see T1N0M0).", ("T1N0M0", "TNM")), ("TNM classification", ("TNM", "TNM")),
    ("TNM:\n\n  T4N0M1  \nx", ("T4N0M1", "TNM")), ("nothing here", (None, None)), (None, (None, None)),
]


def _parse(spark, responses):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(responses)], "i int, r string")
    rows = df.select("i", parse_response(F.col("r")).alias("p")).orderBy("i").collect()
    return [(r.p.stage, r.p.system) for r in rows]


def test_cases(spark):
    got = _parse(spark, [c for c, _ in CASES])
    assert got == [e for _, e in CASES]


def test_differential(spark):
    rnd = random.Random(7)
    parts = ["NA", "TNM:", "Stage:", "T2N1M0", "T3", "N", "M", " ", "\n", "(", ")", ".", ",", "x", "IIB", "  ",
             "\t", "Tn", "TxNyMz;", "na"]
    responses = ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 12))) for _ in range(500)]
    assert _parse(spark, responses) == [pyoracle.parse(r) for r in responses]
