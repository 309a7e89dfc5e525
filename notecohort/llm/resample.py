"""Target-distribution importance resampling (operator 13).

Features are all runs of 1 to ``orders`` consecutive words of a text (ASCII lower case, words
of letters, digits and anything beyond ASCII), hashed by CRC-32 into ``buckets``.  The gain of
a bucket is the scaled logarithm of how much likelier the target texts use it than the source
texts, both counted in full with one added to each bucket.  A document's weight is the sum of
the gains of its features; with Gumbel noise drawn from its id the k highest scores are a
sample without replacement in proportion to the exponentials of the weights.

* Counts: an array of ``buckets`` sums in each task, added up by bucket.
* Weights: the array of gains goes to every task (``buckets`` numbers, a fixed size) and is
  read by feature; the checksums of word runs come from those of words, as CRC-32 is linear.
* Selection: a distributed quickselect over the composite key (score from high to low, id,
  feature count).  A round draws ``PIVOTS`` random rows of the interval that still holds the
  k-th key and counts, exactly and in one pass over the narrow written table, the rows before,
  at and behind each; the interval narrows until a pivot is the k-th key.  Only rows up to it
  are sorted and ranked, by a distributed row index.

Defined cases: a null or empty text has no features and weight 0; a null doc_id draws noise
as an empty id and loses every tie; repeated rows are rows of their own, and of equal keys
at the cut as many are drawn as fit (they are alike in all columns); target rows with null
texts are ignored; with no target text, or no source text, the smoothed counts decide; extra
columns are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.index import with_row_index
from .bpe import text_blocks
from .common import prepare, saved

BUCKETS = 10_000
ORDERS = 3
SCALE = 1000
PIVOTS = 15
#: Longest word whose checksum shift is tabulated; longer words go through zlib.
_TABLED = 48
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_IN_WORD = np.array([48 <= c <= 57 or 97 <= c <= 122 or c >= 128 for c in range(256)])


def _byte_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1).astype(np.uint32)
    return table


_CRC = _byte_table()


def _shifts() -> np.ndarray:
    """``[n, k, b]``: what byte k of a checksum, if it is b, becomes after n more zero bytes."""
    out = np.zeros((_TABLED + 1, 4, 256), np.uint32)
    for k in range(4):
        out[0, k] = np.arange(256, dtype=np.uint32) << np.uint32(8 * k)
    for n in range(_TABLED):
        out[n + 1] = _CRC[out[n] & 0xFF] ^ (out[n] >> np.uint32(8))
    return out


_SHIFTS = _shifts()


class Words:
    """The words of a block of texts: bytes, where each begins, its length, checksum and text."""

    def __init__(self, texts: list[bytes]):
        self.data = b"\n".join(texts).translate(_LOWER)
        raw = np.frombuffer(self.data, np.uint8)
        inside = np.zeros(len(raw) + 2, bool)
        inside[1:-1] = _IN_WORD[raw]
        turns = np.nonzero(inside[1:] != inside[:-1])[0]
        self.start, end = turns[::2], turns[1::2]
        self.length = end - self.start
        sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
        self.text = np.searchsorted(np.cumsum(sizes), self.start, side="right")
        state = np.full(len(self.start), 0xFFFFFFFF, np.uint32)
        at = np.nonzero(self.length <= _TABLED)[0]
        for j in range(_TABLED):
            at = at[self.length[at] > j]
            if not len(at):
                break
            state[at] = _CRC[(state[at] ^ raw[self.start[at] + j]) & 0xFF] ^ (state[at] >> np.uint32(8))
        self.crc = ~state
        for i in np.nonzero(self.length > _TABLED)[0].tolist():
            self.crc[i] = zlib.crc32(self.word(i))

    def word(self, i: int) -> bytes:
        return self.data[self.start[i]:self.start[i] + self.length[i]]

    def longer(self, crc: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Checksums of runs with ``crc``, a space and the words ``last`` behind them."""
        spaced = ~(_CRC[(~crc ^ np.uint32(32)) & 0xFF] ^ (~crc >> np.uint32(8)))
        n = self.length[last]
        t = _SHIFTS[np.minimum(n, _TABLED)[:, None], np.arange(4), (spaced[:, None] >> np.arange(0, 32, 8, dtype=np.uint32)) & 0xFF]
        out = t[:, 0] ^ t[:, 1] ^ t[:, 2] ^ t[:, 3] ^ self.crc[last]
        for i in np.nonzero(n > _TABLED)[0].tolist():
            out[i] = zlib.crc32(self.word(int(last[i])), int(spaced[i]))
        return out

    def runs(self, orders: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each number of words: the texts and the checksums of all runs."""
        first, crc = np.arange(len(self.start)), self.crc
        for k in range(orders):
            if k:
                fits = first + k < len(self.start)
                fits[fits] = self.text[first[fits] + k] == self.text[first[fits]]
                first = first[fits]
                crc = self.longer(crc[fits], first + k)
            yield self.text[first], crc


def bucket_counts(texts: DataFrame, buckets: int, orders: int) -> DataFrame:
    """``bucket, n`` over the features of all rows of the one column."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for _, some in text_blocks(b.select([0, 0]) for b in batches):
            for _, crc in Words(some.cast(pa.binary()).to_pylist()).runs(orders):
                total += np.bincount(crc % buckets, minlength=buckets)
        at = np.nonzero(total)[0]
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["bucket", "n"])

    return texts.mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(source: np.ndarray, target: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """The floored, scaled logarithms of the smoothed likelihood ratios."""
    n, s, t = len(source), int(source.sum()), int(target.sum())
    return np.array([math.floor(scale * math.log((b + 1.0) * (s + n) / ((a + 1.0) * (t + n))))
                     for a, b in zip(source.tolist(), target.tolist(), strict=True)], np.int64)


def weigh(docs: DataFrame, gain: np.ndarray, orders: int = ORDERS) -> DataFrame:
    """``doc_id, n_words, n_features, weight`` for every row."""
    shared = prepare(docs.sparkSession).sparkContext.broadcast(gain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = shared.value
        for ids, texts in text_blocks(batches):
            words = Words(texts.cast(pa.binary()).to_pylist())
            out = np.zeros((3, len(ids)), np.int64)
            for k, (text, crc) in enumerate(words.runs(orders)):
                counts = np.bincount(text, minlength=len(ids))
                out[0] += counts * (k == 0)
                out[1] += counts
                # sums of whole numbers far below 2**53 are exact
                out[2] += np.bincount(text, gain[crc % len(gain)], len(ids)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([ids, *map(pa.array, out)], names=["doc_id", "n_words", "n_features", "weight"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_words long, n_features long, weight long")


def noise(doc_id: Column, seed: int, scale: int = SCALE) -> Column:
    """Floored, scaled Gumbel noise from the first 32 bits of a digest of seed and id."""
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    u = (F.conv(F.substring(F.sha2(F.encode(named, "UTF-8"), 256), 1, 8), 16, 10).cast("double") + 0.5) / float(1 << 32)
    return F.floor(-float(scale) * F.log(-F.log(u))).cast("long")


def _key() -> Column:
    """The composite key as a struct that orders rows from the best on; nulls of the id last."""
    return F.struct((-F.col("score")).alias("a"), F.col("doc_id").isNull().alias("b"), F.coalesce("doc_id", F.lit(0)).alias("c"),
                    F.col("n_features").alias("d"))


def _literal(key: tuple) -> Column:
    a, b, c, d = key
    return F.struct(F.lit(a).cast("long").alias("a"), F.lit(b).alias("b"), F.lit(c).cast("long").alias("c"), F.lit(d).cast("long").alias("d"))


def kth_key(rows: DataFrame, k: int, seed: int = 0, pivots: int = PIVOTS) -> tuple[tuple, int]:
    """The key of the k-th row (from 1) in key order, and how many rows come before that key.

    ``rows`` is a written table; a round reads its key columns once or twice.  Every round
    settles at least one key, and on average leaves a ``pivots``-th part of the interval.
    """
    keyed, low, high, before, round_ = rows.select(_key().alias("key")), None, None, 0, 0
    while True:
        inside = keyed
        if low is not None:
            inside = inside.where(F.col("key") > _literal(low))
        if high is not None:
            inside = inside.where(F.col("key") < _literal(high))
        drawn = inside.select("key", F.rand(seed + round_).alias("r")).orderBy("r").limit(pivots).collect()  # a fixed number
        chosen = sorted({tuple(r["key"]) for r in drawn})
        line = F.array(*map(_literal, chosen))
        counted = inside.select(F.size(F.filter(line, lambda p: p < F.col("key"))).alias("passed"),
                                F.array_contains(line, F.col("key")).alias("at")).groupBy("passed", "at").count().collect()
        n = {(r["passed"], r["at"]): r["count"] for r in counted}
        for i, key in enumerate(chosen):
            between, equal = n.get((i, False), 0), n.get((i, True), 0)
            if before + between >= k:
                high = key
                break
            if before + between + equal >= k:
                return key, before + between
            before, low = before + between + equal, key
        round_ += 1


def resample(docs: DataFrame, target: DataFrame, percent: int = 5, min_words: int = 20, seed: int = 42,
             buckets: int = BUCKETS, orders: int = ORDERS, scale: int = SCALE) -> DataFrame:
    """``doc_id, n_words, n_features, weight, score, rank`` for every row of ``docs``; ``rank``
    is null for rows that are not drawn.

    ``percent`` of the rows with at least ``min_words`` words are drawn.  ``target`` holds
    texts in its column ``text``.
    """
    prepare(docs.sparkSession)
    counts = []
    for table in (docs, target):
        at = np.zeros(buckets, np.int64)
        for r in bucket_counts(table.select(F.col("text").cast("string").alias("text")), buckets, orders).collect():  # a row a bucket
            at[r["bucket"]] = r["n"]
        counts.append(at)
    scored = weigh(docs, gains(*counts, scale), orders).withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed, scale))
    scored = saved(scored, "resample-scores")
    fit = scored.where(F.col("n_words") >= min_words)
    k = percent * fit.count() // 100
    columns = ["doc_id", "n_words", "n_features", "weight", "score"]
    if not k:
        return scored.select(*columns, F.lit(None).cast("long").alias("rank"))
    last, ahead = kth_key(fit, k, seed)
    key, cut = _key(), _literal(last)
    best = fit.where(key < cut).withColumn("down", -F.col("score")).withColumn("blank", F.col("doc_id").isNull())
    ranked = with_row_index(best, ["down", "blank", "doc_id", "n_features", "n_words"], "rank0").select(
        *columns, (F.col("rank0") + 1).alias("rank"))
    # rows at the cut are alike: they are counted, and so many are drawn as fit
    at_cut = fit.where(key == cut).groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))
    at_cut = at_cut.select(*columns, F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))).alias("i"))
    at_cut = at_cut.select(*columns, F.when(F.col("i") <= k - ahead, F.col("i") + ahead).alias("rank"))
    rest = scored.where((F.col("n_words") < min_words) | (key > cut)).select(*columns, F.lit(None).cast("long").alias("rank"))
    return ranked.unionByName(at_cut).unionByName(rest)
