"""Token files as wavelet matrices (operator 3).

A shard of token ids is stored as one bit-plane per bit of the largest id, highest first;
after each plane the ids are stably parted by that bit.  With rank and select on the
planes, one file answers ``access`` (the id at a place), ``count`` (occurrences of an id in
a range), ``locate`` (places of an id) and full reading, and needs no second copy of the
ids.  Planes are compressed one by one.

File format (a binary value, little-endian): magic ``WVM1``, a header of four unsigned
64-bit numbers (ids, planes, documents, bytes of the document table), the compressed
document table (doc_id, 0/1 for a null id, number of ids), then for each plane the number
of zero bits and of compressed bytes, then the planes.

Scale: documents are dealt by ranges of doc_id and sorted within a range, so shards are in
ascending doc_id order; a task closes a shard after ``shard_tokens`` ids and holds one
shard at a time.  Files are written through Spark as one row each, so a lost executor
leaves no half-written file behind.  Starts come from one number per shard.

Defined cases: a null text is an empty one, which has its end id alone; null doc_ids come
first; rows with equal doc_id follow each other in the order of the table; repeated rows are stored
each; extra columns are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bpe import codec, text_blocks
from .common import prepare, saved, shuffle_partitions

MAGIC = b"WVM1"
END_ID = 2
#: The planes of a shard of this size are parted within a core's cache.
SHARD_TOKENS = 1 << 18
#: A worker's caches and blocks of text are larger here than for encoding alone: this stage
#: holds little else.
CACHED_CHUNKS, BLOCK_BYTES = 300_000, 3 << 22
_WORD_BITS = 64


class BitPlane:
    """A bit vector with rank and select over 64-bit words."""

    def __init__(self, packed: np.ndarray, n: int):
        words = np.zeros(-(-n // _WORD_BITS) + 1, np.uint64)
        words.view(np.uint8)[:len(packed)] = packed
        self.n, self.words = n, words
        self.before = np.r_[0, np.cumsum(np.bitwise_count(words), dtype=np.int64)]

    def get(self, i: int) -> int:
        return int(self.words[i >> 6] >> np.uint64(i & 63)) & 1

    def rank1(self, i: int) -> int:
        """Ones among the first i bits."""
        low = int(self.words[i >> 6]) & ((1 << (i & 63)) - 1)
        return int(self.before[i >> 6]) + low.bit_count()

    def rank(self, bit: int, i: int) -> int:
        return self.rank1(i) if bit else i - self.rank1(i)

    def select(self, bit: int, k: int) -> int:
        """Place of the k-th (from 0) one or zero."""
        before = self.before if bit else np.arange(len(self.before)) * _WORD_BITS - self.before
        w = int(np.searchsorted(before, k, side="right")) - 1
        word, k = int(self.words[w]), k - int(before[w])
        for i in range(_WORD_BITS):
            if (word >> i) & 1 == bit:
                if not k:
                    return w * _WORD_BITS + i
                k -= 1
        raise IndexError(k)


class WaveletMatrix:
    def __init__(self, n: int, packed: list[np.ndarray], zeros: list[int]):
        self.n, self.packed, self.zeros = n, packed, zeros
        self._planes: list[BitPlane] | None = None

    @classmethod
    def build(cls, ids: np.ndarray) -> WaveletMatrix:
        levels = max(1, int(ids.max()).bit_length()) if len(ids) else 1
        now = ids.astype(np.uint16 if levels <= 16 else np.uint32)
        packed, zeros = [], []
        for level in range(levels - 1, -1, -1):
            one = (now & now.dtype.type(1 << level)) != 0
            packed.append(np.packbits(one, bitorder="little"))
            low = now.take(np.flatnonzero(~one))
            zeros.append(len(low))
            now = np.concatenate([low, now.take(np.flatnonzero(one))])
        return cls(len(ids), packed, zeros)

    @property
    def planes(self) -> list[BitPlane]:
        if self._planes is None:
            self._planes = [BitPlane(p, self.n) for p in self.packed]
        return self._planes

    def read(self) -> np.ndarray:
        """All ids in order: the partings are undone from the lowest plane up."""
        now = np.zeros(self.n, np.uint16 if len(self.packed) <= 16 else np.uint32)
        for level, packed in enumerate(reversed(self.packed)):
            one = np.unpackbits(packed, count=self.n, bitorder="little").view(bool)
            zeros, out = self.zeros[len(self.packed) - 1 - level], np.empty_like(now)
            out[np.flatnonzero(~one)] = now[:zeros]
            out[np.flatnonzero(one)] = now[zeros:] | now.dtype.type(1 << level)
            now = out
        return now.astype(np.uint32)

    def access(self, i: int) -> int:
        value = 0
        for plane, zeros in zip(self.planes, self.zeros, strict=True):
            bit = plane.get(i)
            value = value << 1 | bit
            i = zeros + plane.rank1(i) if bit else plane.rank(0, i)
        return value

    def _range(self, value: int, lo: int, hi: int) -> tuple[int, int]:
        if value >> len(self.packed):
            return 0, 0
        for k, (plane, zeros) in enumerate(zip(self.planes, self.zeros, strict=True)):
            bit = value >> (len(self.packed) - 1 - k) & 1
            lo, hi = (zeros + plane.rank1(lo), zeros + plane.rank1(hi)) if bit else (plane.rank(0, lo), plane.rank(0, hi))
        return lo, hi

    def count(self, value: int, lo: int = 0, hi: int | None = None) -> int:
        """Occurrences of an id among the places lo..hi-1."""
        a, b = self._range(value, lo, self.n if hi is None else hi)
        return b - a

    def locate(self, value: int, k: int) -> int:
        """Place of the k-th (from 0) occurrence of an id."""
        lo, hi = self._range(value, 0, self.n)
        if not 0 <= k < hi - lo:
            raise IndexError(k)
        i = lo + k
        for level, (plane, zeros) in enumerate(zip(reversed(self.planes), reversed(self.zeros), strict=True)):
            bit = value >> level & 1
            i = plane.select(1, i - zeros) if bit else plane.select(0, i)
        return i


def to_file(doc_ids: list[int | None], lengths: list[int], ids: np.ndarray) -> bytes:
    m, pack = WaveletMatrix.build(ids), zstandard.ZstdCompressor(level=1).compress
    table = np.array([[d or 0, d is None, n] for d, n in zip(doc_ids, lengths, strict=True)], "<i8").reshape(-1, 3)
    docs, planes = pack(table.T.tobytes()), [pack(p.tobytes()) for p in m.packed]
    sizes = [x for z, p in zip(m.zeros, planes, strict=True) for x in (z, len(p))]
    return b"".join([MAGIC, struct.pack("<4Q", m.n, len(planes), len(doc_ids), len(docs)), docs,
                     struct.pack(f"<{len(sizes)}Q", *sizes), *planes])


def from_file(raw: bytes) -> tuple[list[int | None], np.ndarray, WaveletMatrix]:
    """Document ids, ids of each document, and the matrix."""
    if raw[:4] != MAGIC:
        raise ValueError("not a wavelet token file")
    unpack = zstandard.ZstdDecompressor().decompress
    n, levels, n_docs, n_table = struct.unpack_from("<4Q", raw, 4)
    table = np.frombuffer(unpack(raw[36:36 + n_table]), "<i8").reshape(3, n_docs)
    at = 36 + n_table
    sizes = struct.unpack_from(f"<{2 * levels}Q", raw, at)
    at += 16 * levels
    packed = []
    for size in sizes[1::2]:
        packed.append(np.frombuffer(unpack(raw[at:at + size]), np.uint8))
        at += size
    docs = [None if null else int(d) for d, null in zip(table[0], table[1], strict=True)]
    return docs, table[2], WaveletMatrix(n, packed, list(sizes[::2]))


def write_shards(docs: DataFrame, vocabulary: str, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """Encode and write the token files; returns the written table ``part, shard, n_tokens,
    first_doc, file`` (one row a file, in ascending doc_id order of ``part, shard``)."""
    shared = prepare(docs.sparkSession).sparkContext.broadcast(vocabulary)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c, part, shard = codec(shared.value, CACHED_CHUNKS), TaskContext.get().partitionId(), 0
        ids, doc_ids, lengths, held = [], [], [], 0
        end = np.array([END_ID], "<u4")

        def close() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([{"part": part, "shard": shard, "n_tokens": held, "first_doc": doc_ids[0],
                                                "file": to_file(doc_ids, lengths, np.concatenate(ids))}], _SHARDS)

        for names, texts in text_blocks(batches, BLOCK_BYTES):
            found, at = c.encode(texts)
            for name, lo, hi in zip(names.to_pylist(), at[:-1].tolist(), at[1:].tolist(), strict=True):
                n = hi - lo + 1
                if held and held + n > shard_tokens:
                    yield close()
                    shard, held = shard + 1, 0
                    ids, doc_ids, lengths = [], [], []
                ids += [found[lo:hi], end]
                doc_ids.append(name)
                lengths.append(n)
                held += n
        if held:
            yield close()

    # the second column only splits a range of equal ids over tasks
    order = ["doc_id", "tie"]
    dealt = rows.select("*", F.monotonically_increasing_id().alias("tie"))
    dealt = dealt.repartitionByRange(shuffle_partitions(docs), *order).sortWithinPartitions(*order)
    files = dealt.select("doc_id", "text").mapInArrow(run, "part int, shard int, n_tokens long, first_doc long, file binary")
    return saved(files, "token-files")


_SHARDS = pa.schema([("part", pa.int32()), ("shard", pa.int32()), ("n_tokens", pa.int64()), ("first_doc", pa.int64()),
                     ("file", pa.binary())])


def read_shards(files: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids`` of every document, from the files alone."""
    # one row a file, then one a part: neither window sees a document
    sizes = files.select("part", "shard", "n_tokens")
    before = lambda w: F.coalesce(F.sum("n_tokens").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = sizes.groupBy("part").agg(F.sum("n_tokens").alias("n_tokens"))
    parts = parts.select("part", before(Window.orderBy("part")).alias("ahead"))
    starts = sizes.select("part", "shard", before(Window.partitionBy("part").orderBy("shard")).alias("within")).join(parts, "part").select(
        "part", "shard", (F.col("ahead") + F.col("within")).cast("long").alias("start"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for raw, start in zip(b.column(0), b.column(1).to_pylist(), strict=True):
                docs, lengths, matrix = from_file(raw.as_py())
                ids, ends = matrix.read(), np.cumsum(lengths)
                for lo in range(0, len(docs), 512):
                    to = ends[lo:lo + 512]
                    at = to - lengths[lo:lo + 512]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(docs[lo:lo + 512], pa.int64()), pa.array(start + at, pa.int64()), pa.array(to - at, pa.int64()),
                         pa.array([ids[i:j].astype("<u4").tobytes() for i, j in zip(at, to, strict=True)], pa.binary())],
                        names=["doc_id", "start", "n_tokens", "ids"])

    return files.select("part", "shard", "file").join(starts, ["part", "shard"]).select("file", "start").mapInArrow(
        run, "doc_id long, start long, n_tokens long, ids binary")
