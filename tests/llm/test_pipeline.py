"""The pipeline against a brute-force version of all its stages."""

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import brute
import corpus_pipeline
from notecohort.llm import toxicity
from notecohort.llm.common import saved

SF = "/root/testdata/sf0.001"


def test_run_equals_brute_force(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.train(docs, labels, ~toxicity.held_out(F.col("doc_id")))
    rows = [(r.doc_id, r.text, r.source) for r in docs.collect()]
    rows = [r for r in rows if brute.toxic_score(model, r[1], toxicity.context, toxicity.Lexicon.edits) < 0.3]
    kept = brute.dedup_lines([r[:2] for r in rows])
    rows = [(d, None if t is None else x[2], s) for (d, t, s), x in zip(rows, kept, strict=True)]
    rows = [r for r, g in zip(rows, brute.groups([r[:2] for r in rows]), strict=True) if r[0] == g]
    n, *_ = brute.copies(rows)
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = Counter()
    for (d, t, _), k in zip(rows, n, strict=True):
        ids = library.encode(t or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        want[d, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()] += k
    out = corpus_pipeline.run(spark, SF)
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert Counter(map(tuple, out.collect())) == +want and len(want) > 50


def test_stages_bear_odd_and_empty_tables(spark, odd, none):
    for first in (odd, none):
        docs = first
        for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
            out = saved(stage(spark, docs, SF), "stage")
            assert k == 4 or out.columns == docs.columns
            assert (out.count() > 0) == (first is odd)
            docs = out
