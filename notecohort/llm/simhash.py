"""SimHash near-duplicate groups with pivot distance tables (operator 4).

A document's fingerprint is the bitwise majority over the XXH64 hashes of its word
shingles.  Fingerprints at most ``max_bits`` apart are linked, and a group is a connected
component.

Pairs are found with pivots.  Sixteen reference fingerprints are fixed by a seed, and for
every distinct fingerprint the Hamming distances to them are computed once, both over all
64 bits and over each of ``max_bits + 2`` disjoint bit blocks.  A pair within ``max_bits``
differs in at most that many blocks, so its distances to all references are equal in at
least two blocks: the pair meets under the key "coordinates of these two blocks".  Among
the pairs that meet, those whose largest coordinate difference over the full distances
exceeds ``max_bits`` are discarded (triangle inequality), and the survivors are verified on
the fingerprints themselves.  No link is lost and none is guessed.

Scale: equal fingerprints are one row before any pair is formed, a key's rows are compared
in numpy blocks inside one task, and a key with more than ``TILE`` rows is cut into tiles
whose pairs are dealt over the cluster.  A compared block hands on a star per component,
never its pairs.

Defined cases: a null or empty text, or one of white space only, has fingerprint zero and
is linked like any other; fewer words than the shingle length make one shingle; a null
doc_id takes part in linking but never names a component (a component of null ids alone
has a null id); repeated rows give repeated rows; extra columns are ignored; an empty
table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, mix64, prepare, saved, shuffle_partitions, star

REFERENCES = 16
TILE = 4096
#: Runs up to this length are compared by shifts over the whole batch at once.
SHORT = 64
BLOCK = 1 << 16
SEED = 42


def fingerprint(text: str | None, words_per_shingle: int = 3) -> int:
    """The 64-bit fingerprint of one text (whole text, any length)."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) < words_per_shingle:
        words, words_per_shingle = [b" ".join(words)], 1
    n = len(words) - words_per_shingle + 1
    digest, counts = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    grams = map(b" ".join, zip(*(words[i:] for i in range(words_per_shingle)), strict=False))
    hashes = np.fromiter((digest(g, SEED) for g in grams), np.uint64, n)
    for i in range(0, n, BLOCK):
        bits = np.unpackbits(hashes[i:i + BLOCK].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * counts > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, words_per_shingle: int = 3) -> DataFrame:
    """``doc_id`` and ``fp`` (the 64 bits as a signed long) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.fromiter((fingerprint(t.as_py(), words_per_shingle) for t in b.column(1)), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps.view(np.int64))], names=["doc_id", "fp"])

    prepare(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, fp long")


def _references() -> np.ndarray:
    return mix64(np.arange(1, REFERENCES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def _masks(parts: int) -> list[np.uint64]:
    edges = [round(64 * i / parts) for i in range(parts + 1)]
    return [np.uint64(((1 << hi) - 1) ^ ((1 << lo) - 1)) for lo, hi in zip(edges, edges[1:], strict=False)]


def pivot_table(fps: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """Distances of each fingerprint to the references: per block (n, parts, R) and in all (n, R)."""
    refs = _references()
    per = np.stack([np.bitwise_count((fps[:, None] ^ refs) & m) for m in _masks(parts)], axis=1)
    return per, per.sum(axis=1, dtype=np.uint8)


def _pairs(fps: np.ndarray, table: np.ndarray, i: np.ndarray, j: np.ndarray, max_bits: int) -> np.ndarray:
    """Which pairs survive the pivot test and are verified."""
    near = np.abs(table[i].astype(np.int8) - table[j].astype(np.int8)).max(axis=1) <= max_bits
    near[near] = np.bitwise_count(fps[i[near]] ^ fps[j[near]]) <= max_bits
    return near


def _tile_links(fa, ta, fb, tb, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of verified links between two tiles; coordinates are tested one by one."""
    step, out_a, out_b = max(1, (1 << 20) // max(1, len(fb))), [], []
    for s in range(0, len(fa), step):
        a = fa[s:s + step]
        near = np.abs(ta[s:s + step, None, 0].astype(np.int8) - tb[None, :, 0].astype(np.int8)) <= max_bits
        i, j = np.nonzero(near)
        for k in range(1, REFERENCES):
            if not len(i):
                break
            keep = np.abs(ta[s + i, k].astype(np.int8) - tb[j, k].astype(np.int8)) <= max_bits
            i, j = i[keep], j[keep]
        keep = np.bitwise_count(a[i] ^ fb[j]) <= max_bits
        out_a.append(s + i[keep])
        out_b.append(j[keep])
    return np.concatenate(out_a), np.concatenate(out_b)


FOUND = "key long, chunk int, chunks int, members binary, a long, b long"
_FOUND_ARROW = pa.schema([("key", pa.int64()), ("chunk", pa.int32()), ("chunks", pa.int32()),
                          ("members", pa.binary()), ("a", pa.int64()), ("b", pa.int64())])


def _edges(fps: np.ndarray, a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    n = len(a)
    nil = [pa.nulls(n, t) for t in (pa.int64(), pa.int32(), pa.int32(), pa.binary())]
    return pa.RecordBatch.from_arrays([*nil, pa.array(fps[a].view(np.int64)), pa.array(fps[b].view(np.int64))],
                                      schema=_FOUND_ARROW)


def _star_edges(fps: np.ndarray, a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    label = star(len(fps), a, b)
    i = np.nonzero(label != np.arange(len(fps)))[0]
    return _edges(fps, i, label[i])


def near_pairs(reps: DataFrame, max_bits: int = 3) -> DataFrame:
    """Edges ``(a, b)`` whose connected components are those of all links among the
    distinct fingerprints ``fp`` of ``reps``."""
    parts = max_bits + 2
    pairs = list(combinations(range(parts), 2))

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 8192):
                fps = batch.column(0).slice(lo, 8192).to_numpy(zero_copy_only=False).view(np.uint64)
                per, total = pivot_table(fps, parts)
                # sixteen coordinates of 0..15 make the eight bytes of a block's key
                block = (per[:, :, 0::2] << 4 | per[:, :, 1::2]).astype(np.uint8)
                block = np.ascontiguousarray(block).view(np.uint64)[:, :, 0]
                keys = np.stack([mix64(mix64(block[:, i] + np.uint64(k + 1)) ^ block[:, j])
                                 for k, (i, j) in enumerate(pairs)], axis=1)
                rows = np.repeat(np.arange(len(fps)), len(pairs))
                t = total[rows].view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys.reshape(-1).view(np.int64)), pa.array(fps[rows].view(np.int64)),
                     pa.array(np.ascontiguousarray(t[:, 0])), pa.array(np.ascontiguousarray(t[:, 1]))],
                    names=["key", "fp", "t0", "t1"])

    def run_of(key: int, fps: np.ndarray, table: np.ndarray) -> Iterator[pa.RecordBatch]:
        if len(fps) <= TILE:
            yield _star_edges(fps, *_tile_links(fps, table, fps, table, max_bits))
            return
        cuts = range(0, len(fps), TILE)
        for c, s in enumerate(cuts):
            packed = fps[s:s + TILE].tobytes() + table[s:s + TILE].tobytes()
            yield pa.RecordBatch.from_arrays(
                [pa.array([key]), pa.array([c], pa.int32()), pa.array([len(cuts)], pa.int32()),
                 pa.array([packed], pa.binary()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64())], schema=_FOUND_ARROW)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []  # rows of the key that the last batch ended in

        def closed(keys, fps, table) -> Iterator[pa.RecordBatch]:
            starts = np.nonzero(np.r_[True, keys[1:] != keys[:-1]])[0]
            sizes = np.diff(np.r_[starts, len(keys)])
            for s, n in zip(starts[sizes > SHORT], sizes[sizes > SHORT], strict=True):
                yield from run_of(int(keys[s]), fps[s:s + n], table[s:s + n])
            short = np.repeat((sizes > 1) & (sizes <= SHORT), sizes)
            keys, fps, table = keys[short], fps[short], table[short]
            for d in range(1, SHORT):
                i = np.nonzero(keys[d:] == keys[:-d])[0] if d < len(keys) else []
                if not len(i):
                    break
                keep = _pairs(fps, table, i, i + d, max_bits)
                if keep.any():
                    yield _edges(fps, i[keep], i[keep] + d)

        for batch in batches:
            if not batch.num_rows:
                continue
            cols = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(4)]
            table = np.ascontiguousarray(np.stack(cols[2:], axis=1)).view(np.uint8)
            got = (cols[0], cols[1].view(np.uint64), table)
            if held and held[-1][0][-1] == got[0][-1]:
                held.append(got)
                continue
            rows = tuple(np.concatenate(x) for x in zip(*held, got, strict=True))
            cut = np.searchsorted(rows[0], rows[0][-1])
            if cut:
                yield from closed(*(x[:cut] for x in rows))
            held = [tuple(x[cut:] for x in rows)]
        if held:
            yield from closed(*(np.concatenate(x) for x in zip(*held, strict=True)))

    def tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                (fa, ta), (fb, tb) = ((np.frombuffer(x, np.uint64, len(x) // 24), np.frombuffer(x, np.uint8, offset=len(x) // 24 * 8).reshape(-1, 16)) for x in (a, b))
                i, j = _tile_links(fa, ta, fb, tb, max_bits)
                yield _star_edges(np.concatenate([fa, fb]), i, len(fa) + j)

    keys = reps.select("fp").mapInArrow(keyed, "key long, fp long, t0 long, t1 long")
    met = keys.repartition(shuffle_partitions(reps), "key").sortWithinPartitions("key", "fp")
    found = saved(met.mapInArrow(compare, FOUND), "pivot-pairs")
    # tiles of hot keys: each pair of tiles is one row, dealt by (key, low, high)
    hot = found.where(F.col("members").isNotNull()).select(
        "key", "chunk", "members", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("other"))
    hot = hot.select("key", F.least("chunk", "other").alias("lo"), F.greatest("chunk", "other").alias("hi"), "chunk", "members")
    low = hot.where("chunk = lo").select("key", "lo", "hi", F.col("members").alias("ma"))
    high = hot.where("chunk = hi").select("key", "lo", "hi", F.col("members").alias("mb"))
    more = low.join(high, ["key", "lo", "hi"]).select("ma", "mb").mapInArrow(tiles, FOUND)
    return found.where(F.col("members").isNull()).select("a", "b").unionByName(more.select("a", "b"))


def simhash_groups(docs: DataFrame, words_per_shingle: int = 3, max_bits: int = 3) -> DataFrame:
    """``doc_id, fingerprint, component_id`` for every row of ``docs``."""
    fps = saved(fingerprints(docs, words_per_shingle), "fingerprints")
    reps = saved(fps.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "distinct-fingerprints")
    label = components(near_pairs(reps, max_bits))
    named = reps.join(label, reps["fp"] == label["node"], "left").select(
        "fp", "first_id", F.coalesce("label", "fp").alias("label"))
    first = named.groupBy("label").agg(F.min("first_id").alias("component_id"))
    of_fp = named.join(first, "label").select("fp", "component_id")
    return fps.join(of_fp, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, words_per_shingle: int = 3, max_bits: int = 3) -> DataFrame:
    """The rows of ``docs`` whose doc_id names their group: one document of each group.

    Rows with a null doc_id stay (nothing names them), and so do repeated rows of the
    document that is kept.  Rows that share a doc_id but differ in text are told apart by
    their fingerprints; only such rows are fingerprinted again.
    """
    groups = simhash_groups(docs.select("doc_id", "text"), words_per_shingle, max_bits)
    names = F.collect_set(F.when(F.col("doc_id") == F.col("component_id"), F.col("fingerprint")))
    goes = groups.groupBy("doc_id").agg(F.bool_or(F.col("doc_id") != F.col("component_id")).alias("goes"), names.alias("named by"))
    goes = saved(goes.where("goes").drop("goes"), "ids-that-go")
    kept = docs.join(goes.select("doc_id"), "doc_id", "left_anti").select(*docs.columns)
    several = saved(goes.where(F.size("named by") > 0), "ids-that-go-and-stay")
    if several.isEmpty():
        return kept
    where = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            stays = [f"{fingerprint(t, words_per_shingle):016x}" in n
                     for t, n in zip(b.column(where).to_pylist(), b.column(b.num_columns - 1).to_pylist(), strict=True)]
            yield b.select(docs_columns).filter(pa.array(stays, pa.bool_()))

    docs_columns = list(range(len(docs.columns)))
    rows = docs.join(several, "doc_id").select(*docs.columns, "named by")
    return kept.unionByName(rows.mapInArrow(run, docs.schema))
