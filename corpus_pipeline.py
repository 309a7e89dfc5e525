"""A corpus pipeline over the dealt operators: toxicity, line deduplication, SimHash near
duplicates, mixing sources to target weights, BPE encoding and decoding.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; ``run`` writes each
stage's rows as Parquet in the shared folder and reads them again as the next stage's docs.
All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from notecohort.llm import bpe, linededup, mixing, simhash, toxicity
from notecohort.llm.common import saved
from notecohort.llm.queries import vocabulary


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: documents with a score of 0.3 or more go.

    Null or empty texts have the base score and stay, as do null ids; repeated rows fare
    alike; more columns than those of ``documents`` pass through.
    """
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")
    return toxicity.reject_toxic(docs, labels, threshold=0.3)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: lines of at least 20 code points found in at least 3 documents stay only
    in the document with the largest id.

    A document all of whose lines go keeps its row with an empty text; a null text stays
    null; ``n_chars`` is counted anew.
    """
    return linededup.drop_repeated_lines(docs, min_chars=20, min_docs=3)


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: of documents whose fingerprints link at 3 bits or fewer, over shingles of
    three words, the one with the smallest id stays.

    Empty texts have one fingerprint, so one of them stays; null ids stay.
    """
    return simhash.keep_one(docs, words_per_shingle=3, max_bits=3)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: as many copies of each document as the mix takes, none to three.

    Copies are rows of their own with equal columns; a source without words takes nothing,
    so its documents go.
    """
    return mixing.take(docs)


def encode_and_decode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: ids and decoded text of each row, as digests beside ``doc_id``.

    A null text is an empty one; repeated rows give equal rows.
    """
    texts = bpe.encode(docs, vocabulary(), decoded=True)
    return texts.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"))


STAGES = [
    ("toxicity", reject_toxic),
    ("line dedup", drop_repeated_lines),
    ("SimHash near-dedup", keep_one_of_near_copies),
    ("mixing sources to target weights", mix_sources),
    ("BPE encoding and decoding", encode_and_decode),
]

#: A learned score and a tokenizer's merges are beyond SQL; tests hold run() against a
#: brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = saved(stage(spark, docs, sf_dir), f"stage-{k + 1}")
    return docs
