"""Line deduplication with two Bloom filters (operator 6).

A line's key is the line stripped of ASCII white space at both ends with A-Z lower-cased.
Keys of at least ``min_chars`` code points found in at least ``min_docs`` documents lose all
their lines except those of the largest doc_id holding the key.

Pass 1 hashes the keys of each document and fills two Bloom filters per task, one for
hashes seen once and one for hashes seen again.  Filters of different tasks merge bit by
bit: a bit of the second filter is set where either task set it, or where both tasks set it
in the first.  Pass 2 looks every key up in the merged second filter.  Documents without a
suspect are finished there and then; only suspected lines shuffle, as full keys, for the
exact count of documents and the choice of the surviving document, and only documents with
a suspect are shuffled to have their lines removed.  False positives of a filter cost a
shuffled line and never change the result.

Scale: the filters take ``bits_per_key`` bits for each line, counted first, and at most
``max_filter_bits`` (a documented bound, 64 MB at the default, which is also the bound of
what is broadcast).  Beyond it suspects become more numerous and the result stays exact.
Filters travel compressed and in segments, and each segment is merged in a task of its own.

Defined cases: a null or empty text is one empty line; rows with one doc_id are one
document for counting; a null doc_id is a document that orders before all others;
repeated rows get the same result; extra columns are ignored (or kept, in
``drop_repeated_lines``); an empty table gives an empty table.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, mix64, saved, shuffle_partitions

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
HASHES = 3
BITS_PER_KEY = 12
MAX_FILTER_BITS = 1 << 29
SEGMENT_BITS = 1 << 20


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(SPACE)), UPPER, LOWER)


def long_keys(text: Column, min_chars: int) -> Column:
    """The distinct keys of a text that are long enough."""
    keys = F.transform(lines_of(text), line_key)
    return F.array_distinct(F.filter(keys, lambda k: F.char_length(k) >= min_chars))


def _positions(hashes: np.ndarray, bits: int) -> np.ndarray:
    """Bit positions (n, HASHES) of 64-bit hashes in a filter of ``bits`` (a power of two)."""
    h = mix64(hashes.view(np.uint64))
    step = (h >> np.uint64(32)) | np.uint64(1)
    k = np.arange(HASHES, dtype=np.uint64)
    return ((h[:, None] + k * step[:, None]) & np.uint64(bits - 1)).astype(np.int64)


def _test(bitmap: np.ndarray, pos: np.ndarray) -> np.ndarray:
    return ((bitmap[pos >> 3] >> (pos & 7).astype(np.uint8)) & 1).all(axis=1)


def _set(bitmap: np.ndarray, pos: np.ndarray) -> None:
    pos = pos.ravel()
    np.bitwise_or.at(bitmap, pos >> 3, (1 << (pos & 7)).astype(np.uint8))


def _hash_batches(batches: Iterator[pa.RecordBatch], rows: int = 1 << 16) -> Iterator[np.ndarray]:
    for b in batches:
        values = b.column(0).flatten().to_numpy(zero_copy_only=False)
        for i in range(0, len(values), rows):
            yield values[i:i + rows]


def seen_twice(hashes: DataFrame, bits: int) -> DataFrame:
    """Segments ``(segment, twice)`` of the merged second filter, from rows of hash arrays.

    A hash is never left out that occurs in two rows, of the same task or of two.
    """
    segment = min(bits, SEGMENT_BITS)

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once, twice = np.zeros(bits >> 3, np.uint8), np.zeros(bits >> 3, np.uint8)
        for values in _hash_batches(batches):
            one, n = np.unique(values, return_counts=True)
            pos = _positions(one, bits)
            again = (n > 1) | _test(once, pos)
            _set(twice, pos[again])
            _set(once, pos)
        size = segment >> 3
        for s in range(bits // segment):
            a, b = once[s * size:(s + 1) * size], twice[s * size:(s + 1) * size]
            if a.any():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([s], pa.int32()), pa.array([zlib.compress(a, 1)], pa.binary()),
                     pa.array([zlib.compress(b, 1)], pa.binary())], names=["segment", "once", "twice"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[np.ndarray]] = {}
        for b in batches:
            for s, x, y in zip(*(c.to_pylist() for c in b.columns), strict=True):
                once, twice = (np.frombuffer(zlib.decompress(v), np.uint8) for v in (x, y))
                if s not in held:
                    held[s] = [once.copy(), twice.copy()]
                    continue
                acc = held[s]
                acc[1] |= twice | (acc[0] & once)
                acc[0] |= once
        for s, (_, twice) in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([s], pa.int32()), pa.array([zlib.compress(twice, 1)], pa.binary())],
                                             names=["segment", "twice"])

    filters = hashes.mapInArrow(fill, "segment int, once binary, twice binary")
    return filters.repartition(min(bits // segment, shuffle_partitions(hashes)), "segment").mapInArrow(merge, "segment int, twice binary")


def _suspects_udf(spark, segments: DataFrame, bits: int):
    """A column function array<long> -> array<int>: places of hashes in the second filter."""
    size = min(bits, SEGMENT_BITS) >> 3
    whole = bytearray(bits >> 3)
    for row in segments.toLocalIterator():  # max_filter_bits / 8 bytes at most
        whole[row["segment"] * size:(row["segment"] + 1) * size] = zlib.decompress(row["twice"])
    shared = spark.sparkContext.broadcast(bytes(whole))

    @F.pandas_udf("array<int>")
    def places(hashes: pd.Series) -> pd.Series:
        twice = np.frombuffer(shared.value, np.uint8)
        sizes = hashes.map(len).to_numpy()
        flat = np.concatenate([np.zeros(0, np.int64), *hashes])
        hit = _test(twice, _positions(flat, bits)) if len(flat) else np.zeros(0, bool)
        return pd.Series([np.nonzero(x)[0].astype(np.int32) for x in np.split(hit, np.cumsum(sizes)[:-1])], dtype=object)

    return places


_TO_LOWER = str.maketrans(UPPER, LOWER)


def _without_udf():
    """A column function (text, keys): the text without the lines of those keys, in one pass over
    its lines, and how many went; nulls for a null text."""

    @F.pandas_udf("kept string, n_dropped long")
    def without(text: pd.Series, drop: pd.Series) -> pd.DataFrame:
        out = []
        for t, keys in zip(text, drop, strict=True):
            if t is None:
                out.append((None, None))
                continue
            keys, lines = frozenset(keys), t.split("\n")
            kept = [x for x in lines if x.strip(SPACE).translate(_TO_LOWER) not in keys]
            out.append(("\n".join(kept), len(lines) - len(kept)))
        return pd.DataFrame(out, columns=["kept", "n_dropped"]).astype({"kept": object, "n_dropped": "Int64"})

    return without


def _scan(docs: DataFrame, keep: list[str], min_chars: int = 20, min_docs: int = 3, bits_per_key: int = BITS_PER_KEY,
          max_filter_bits: int = MAX_FILTER_BITS) -> DataFrame:
    """``row`` (a struct of the columns ``keep``, doc_id and text among them), ``n_lines,
    n_dropped, kept`` for every row."""
    text, doc = F.col("row.text").cast("string"), F.col("row.doc_id").cast("long")
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in keep)).alias("row"))
    keys = long_keys(text, min_chars)
    hashes = saved(rows.select(F.transform(keys, lambda k: F.xxhash64(k)).alias("hashes")), "line-hashes")
    lines = hashes.agg(F.sum(F.size("hashes"))).first()[0] or 1
    bits = max(1 << 13, min(max_filter_bits, 1 << (lines * bits_per_key - 1).bit_length()))
    places = _suspects_udf(docs.sparkSession, seen_twice(hashes, bits), bits)

    found = rows.select("*", keys.alias("keys")).withColumn("at", places(F.transform("keys", lambda k: F.xxhash64(k))))
    suspects = F.transform("at", lambda i: F.element_at("keys", i + 1))
    clean = F.size("at") == 0
    # a clean text is finished; a suspected one is kept with its suspected keys
    table = saved(found.select("row", clean.alias("clean"), F.when(~clean, suspects).alias("keys")), "line-suspects")
    done = table.where("clean").select(
        "row", F.size(lines_of(text)).cast("long").alias("n_lines"), F.lit(0).cast("long").alias("n_dropped"),
        F.coalesce(text, F.lit("")).alias("kept"))
    suspected = table.where("NOT clean").select("row", doc.alias("id"), "keys")
    holding = suspected.select("id", F.explode("keys").alias("key")).distinct()
    winners = holding.groupBy("key").agg(F.count(F.lit(1)).alias("docs"), F.max("id").alias("winner")).where(F.col("docs") >= min_docs)
    drops = (holding.join(winners, "key").where(~F.col("id").eqNullSafe(F.col("winner")))
             .groupBy("id").agg(F.collect_set("key").alias("drop")).withColumnRenamed("id", "of"))
    joined = suspected.drop("keys").join(drops, F.col("id").eqNullSafe(F.col("of")), "left")
    left = joined.select("row", "drop", _without_udf()(F.when(F.col("drop").isNotNull(), text), F.col("drop")).alias("left"))
    rest = left.select("row", F.size(lines_of(text)).cast("long").alias("n_lines"),
                       F.coalesce("left.n_dropped", F.lit(0)).cast("long").alias("n_dropped"),
                       F.coalesce("left.kept", text, F.lit("")).alias("kept"))
    return done.unionByName(rest)


def repeated_lines(docs: DataFrame, **options) -> DataFrame:
    """``doc_id, n_lines, n_dropped, kept`` (the remaining text, never null) for every row."""
    return _scan(docs, ["doc_id", "text"], **options).select("row.doc_id", "n_lines", "n_dropped", "kept")


def drop_repeated_lines(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with the repeated lines gone from ``text`` (null stays null) and ``n_chars``,
    where there is one, counted anew."""
    out = _scan(docs, docs.columns, **options)
    row = {c: F.col(f"row.`{c}`") for c in docs.columns}
    new = {"text": F.when(row["text"].isNotNull(), F.col("kept"))}
    if "n_chars" in row:
        new["n_chars"] = F.char_length("kept").cast(docs.schema["n_chars"].dataType)
    return out.select(*(new.get(c, x).alias(c) for c, x in row.items()))
