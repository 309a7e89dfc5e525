"""BPE encoding and decoding by tree concatenation (operator 2).

The vocabulary is a file of the ``tokenizers`` library; ids equal those of the library on
the whole text, without special tokens, truncation or padding.  The tokenizer must drop
ASCII white space between pieces, so that a text's ids are those of its chunks between
white space, one after the other; ``Codec`` refuses a vocabulary that does not.

Texts of up to ``leaf_chars`` code points are encoded in the task that reads them.  A
longer text is cut into leaves, which are spread over the cluster and encoded in parallel,
and joined pairwise in a tree.  White space is a safe joint.  Where a cut falls inside an
unsplit run, a window around the joint is encoded again and grows until its outer tokens,
over at least ``MARGIN`` characters on both sides, are exactly those of the two halves
(same ids at the same offsets).  Token sequences whose neighbours all agree are the BPE
encoding of the whole, so the window's tokens then replace those at the joint.  If no such
window exists, the window becomes the whole run.

Defined cases: a null text encodes like an empty one, to no ids; null doc_ids and repeated
rows are rows of their own; extra columns are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import give_back, prepare, shuffle_partitions

LEAF_CHARS = 1 << 14
#: Longer than any special token or contraction of the vocabulary.
MARGIN = 32
FIRST_WINDOW = 8
#: Entries of each of the two generations of a worker's caches; one takes about 200 bytes.
CACHED_CHUNKS = 50_000
_SLAB = 1 << 14
BLOCK_BYTES = 1 << 22
#: Of texts that are encoded at once: larger blocks share few more chunks, and a worker's and the
#: JVM's buffers grow with them.
CODED_BYTES = 1 << 20
_ASCII_SPACE = " \t\n\x0b\x0c\r"


#: Chunks that the short way may take: Latin-1 without controls, spaces and "<", which may
#: begin a special token.  They are in NFC, and lower case is one letter for one.
_PLAIN = re.compile(rb"(?:[\x21-\x3b\x3d-\x7e]|\xc2[\xa1-\xac\xae-\xbf]|\xc3[\x80-\xbf])+").fullmatch
_MARKS = frozenset(".,;:!?")
#: The steps before the merges that the short way knows; any other vocabulary goes the long way.
_STEPS = ([("NFC", None), ("Replace", "\\s+"), ("Lowercase", None)], [("Split", True), ("ByteLevel", False)])


def _byte_chars() -> dict[int, str]:
    """The character that stands for a byte in a byte-level vocabulary: itself if it is
    printable, else the next unused one from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


_BYTE_CHARS = _byte_chars()


class Codec:
    """The library's tokenizer with a cache of encoded chunks.

    New chunks of plain Latin-1 text go straight to the library's BPE model, piece by piece
    (the split pattern is the vocabulary's own); all others go through the whole library.
    """

    def __init__(self, vocabulary: str, cached: int = CACHED_CHUNKS):
        self.cached = cached
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(vocabulary)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.cache: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        self.pieces: dict[str, bytes] = {}
        self.old_pieces: dict[str, bytes] = {}
        self.split = self._short_way(json.loads(vocabulary))
        for c in _ASCII_SPACE:
            if self._ids([f"a{c}b{c}{c}'s."])[0] != b"".join(self._ids(["a", "b", "'s."])):
                raise ValueError("the vocabulary's ids depend on white space; chunks cannot be encoded alone")

    def _ids(self, texts: list[str]) -> list[bytes]:
        got = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in got]

    @staticmethod
    def _short_way(spec: dict):
        try:
            normal = [(n["type"], n.get("pattern", {}).get("Regex")) for n in spec["normalizer"]["normalizers"]]
            split, level = spec["pre_tokenizer"]["pretokenizers"]
            known = (normal, [(split["type"], split["invert"]), (level["type"], level["use_regex"])]) == _STEPS
            plain = known and split["behavior"] == "Removed" and not level["add_prefix_space"] and spec["model"]["type"] == "BPE"
            return regex.compile(split["pattern"]["Regex"]).findall if plain else None
        except (KeyError, TypeError, ValueError):
            return None

    def _piece(self, piece: str) -> bytes:
        """Ids of a lower-case piece, from the caches or the library's model."""
        ids = self.old_pieces.get(piece)
        if ids is None:
            shown = piece if piece.isascii() else piece.encode("utf-8").decode("latin-1").translate(_BYTE_CHARS)
            ids = array("I", [t.id for t in self.tokenizer.model.tokenize(shown)]).tobytes()
        self.pieces[piece] = ids
        return ids

    def _new(self, chunks: list[bytes]) -> dict[bytes, bytes]:
        if len(self.pieces) > self.cached:
            self.old_pieces, self.pieces = self.pieces, {}
        known, make, split, out, slow = self.pieces.get, self._piece, self.split, {}, []
        for chunk in chunks:
            if not (split and _PLAIN(chunk)):
                slow.append(chunk)
                continue
            text = chunk.decode("utf-8").lower()
            word, mark = (text, "") if text.isalpha() else (text[:-1], text[-1])
            # letters are one piece, and a mark after them is another
            if not mark or mark in _MARKS and word.isalpha():
                ids = known(word) or make(word)
                out[chunk] = ids + (known(mark) or make(mark)) if mark else ids
            else:
                out[chunk] = b"".join([known(x) or make(x) for x in split(text)])
        out.update(zip(slow, self._ids([c.decode("utf-8") for c in slow]), strict=True))
        return out

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts (no nulls) in a row, and where each text's ids begin and end."""
        chunks = pc.ascii_split_whitespace(texts)
        coded = chunks.flatten().dictionary_encode()
        words = coded.dictionary.cast(pa.binary()).to_pylist()
        ids = self._lookup(words)
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) >> 2
        flat, first = np.frombuffer(b"".join(ids), "<u4"), np.cumsum(sizes) - sizes
        pick = coded.indices.to_numpy(zero_copy_only=False)
        ends = np.r_[0, np.cumsum(sizes[pick])]
        out = np.empty(ends[-1], "<u4")
        for lo in range(0, len(pick), _SLAB):  # few enough ids at a time for a core's cache
            some = pick[lo:lo + _SLAB]
            at = np.repeat(first[some] - ends[lo:lo + len(some)] + ends[lo], sizes[some])
            at += np.arange(len(at))
            flat.take(at, out=out[ends[lo]:ends[lo + len(some)]])
        return out, ends[np.r_[0, np.cumsum(pc.list_value_length(chunks).to_numpy(zero_copy_only=False))]]

    def _lookup(self, chunks: list[bytes]) -> list[bytes]:
        """Ids of distinct chunks.  The cache has two generations: a chunk that is met again
        moves to the younger one, and the older is dropped when the younger is full."""
        if len(self.cache) > self.cached:
            self.older, self.cache = self.cache, {}
        young, older = self.cache, self.older
        out = list(map(young.get, chunks))
        missing = [i for i, x in enumerate(out) if x is None]
        met = [older.get(chunks[i]) for i in missing]
        found = self._new([chunks[i] for i, x in zip(missing, met, strict=True) if x is None])
        for i, x in zip(missing, met, strict=True):
            c = chunks[i]
            out[i] = young[c] = found[c] if x is None else x
        return out

    def release(self) -> None:
        """Forget all chunks: workers live on, and their next task may be another stage's."""
        self.cache, self.older, self.pieces, self.old_pieces = {}, {}, {}, {}
        give_back()

    def spans(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, starts and ends (in code points) of a text."""
        e = self.tokenizer.encode(text, add_special_tokens=False)
        at = np.array(e.offsets, np.int64).reshape(-1, 2)
        return np.array(e.ids, "<u4"), at[:, 0], at[:, 1]

    def decode(self, ids: bytes) -> str:
        return self.tokenizer.decode(np.frombuffer(ids, "<u4").tolist(), skip_special_tokens=False)


_CODECS: dict[tuple[int, int], Codec] = {}


def codec(vocabulary: str, cached: int = CACHED_CHUNKS) -> Codec:
    """One codec for each vocabulary and Python worker."""
    key = hash(vocabulary), cached
    if key not in _CODECS:
        _CODECS[key] = Codec(vocabulary, cached)
    return _CODECS[key]


def read_vocabulary(path: str) -> str:
    """The vocabulary's JSON, read on the driver (a few MB) and sent with the tasks."""
    with open(path, encoding="utf-8") as f:
        return f.read()


class Node:
    """An encoded stretch of text.

    ``head`` and ``tail`` are its texts up to the first and from the last ASCII white space
    (the whole stretch, if there is none: ``solid``).  ``starts`` and ``ends`` hold offsets
    for the ``n_head`` first and ``n_tail`` last tokens, from the stretch's beginning for
    the head and from the beginning of ``tail`` for the tail.
    """

    def __init__(self, ids: np.ndarray, head, tail, solid: bool):
        self.ids, self.head, self.tail, self.solid = ids, head, tail, solid


class Run:
    """Text without white space at an edge of a node: its characters and its tokens' spans."""

    def __init__(self, text: str, ids: np.ndarray, starts: np.ndarray, ends: np.ndarray):
        self.text, self.ids, self.starts, self.ends = text, ids, starts, ends


def leaf(c: Codec, text: str) -> Node:
    first = next((i for i, x in enumerate(text) if x in _ASCII_SPACE), None)
    if first is None:
        run = Run(text, *c.spans(text))
        return Node(run.ids, run, run, True)
    last = len(text) - next(i for i, x in enumerate(reversed(text)) if x in _ASCII_SPACE)
    head, tail = text[:first], text[last:]
    return Node(c.encode(pa.array([text]))[0], Run(head, *c.spans(head)), Run(tail, *c.spans(tail)), False)


def join_runs(c: Codec, a: Run, b: Run) -> Run:
    """The encoding of ``a.text + b.text`` from those of both, by growing windows."""
    text, shift = a.text + b.text, len(a.text)
    if not len(a.ids) or not len(b.ids):
        ids, starts, ends = (a.ids, a.starts, a.ends) if len(a.ids) else (b.ids, b.starts + shift, b.ends + shift)
        if not (a.text and b.text):
            return Run(text, ids, starts, ends)
    w = FIRST_WINDOW
    while w < max(len(a.ids), len(b.ids)):
        i, j = max(0, len(a.ids) - w), min(len(b.ids), w)
        lo = int(a.starts[i]) if i else 0
        hi = int(b.ends[j - 1]) + shift if j < len(b.ids) else len(text)
        ids, starts, ends = c.spans(text[lo:hi])
        starts, ends = starts + lo, ends + lo
        left = _same(a.ids[i:], a.starts[i:], a.ends[i:], ids, starts, ends)
        right = _same(b.ids[:j][::-1], b.starts[:j][::-1] + shift, b.ends[:j][::-1] + shift, ids[::-1], starts[::-1], ends[::-1])
        fits = left + right <= len(ids)
        left_ok = not i or (left and ends[left - 1] - lo >= MARGIN and not unicodedata.combining(text[lo]))
        right_ok = j == len(b.ids) or (right and hi - starts[-right] >= MARGIN and not unicodedata.combining(text[hi]))
        if fits and left_ok and right_ok:
            return Run(text, np.concatenate([a.ids[:i], ids, b.ids[j:]]),
                       np.concatenate([a.starts[:i], starts, b.starts[j:] + shift]),
                       np.concatenate([a.ends[:i], ends, b.ends[j:] + shift]))
        w *= 2
    return Run(text, *c.spans(text))


def _same(ids_a, starts_a, ends_a, ids_b, starts_b, ends_b) -> int:
    """How many first tokens are equal, with equal spans."""
    n = min(len(ids_a), len(ids_b))
    equal = (ids_a[:n] == ids_b[:n]) & (starts_a[:n] == starts_b[:n]) & (ends_a[:n] == ends_b[:n])
    return n if equal.all() else int(np.argmin(equal))


def concatenate(c: Codec, a: Node, b: Node) -> Node:
    mid = join_runs(c, a.tail, b.head)
    ids = np.concatenate([a.ids[:len(a.ids) - len(a.tail.ids)], mid.ids, b.ids[len(b.head.ids):]])
    return Node(ids, mid if a.solid else a.head, mid if b.solid else b.tail, a.solid and b.solid)


def tree(c: Codec, nodes: list[Node]) -> Node:
    while len(nodes) > 1:
        nodes = [concatenate(c, *nodes[i:i + 2]) if i + 1 < len(nodes) else nodes[i] for i in range(0, len(nodes), 2)]
    return nodes[0]


def _pack(n: Node) -> dict:
    runs = [n.head] if n.solid else [n.head, n.tail]
    return {"ids": n.ids.tobytes(), "solid": n.solid, "texts": [r.text for r in runs],
            "spans": [np.stack([r.ids.astype(np.int64), r.starts, r.ends]).tobytes() for r in runs]}


def _unpack(r: dict) -> Node:
    runs = []
    for t, s in zip(r["texts"], r["spans"], strict=True):
        ids, starts, ends = np.frombuffer(s, np.int64).reshape(3, -1)
        runs.append(Run(t, ids.astype("<u4"), starts, ends))
    return Node(np.frombuffer(r["ids"], "<u4"), runs[0], runs[-1], r["solid"])


_NODE = "ids binary, solid boolean, texts array<string>, spans array<binary>"
_NODE_ARROW = [("ids", pa.binary()), ("solid", pa.bool_()), ("texts", pa.list_(pa.string())), ("spans", pa.list_(pa.binary()))]


def text_blocks(batches: Iterator[pa.RecordBatch], most: int = BLOCK_BYTES) -> Iterator[tuple[pa.Array, pa.Array]]:
    """``(doc_ids, texts)`` of rows ``doc_id, text`` in blocks of about ``most`` bytes (one row
    at least), across batches; null is the empty text."""
    held, size = [], 0
    for b in batches:
        texts = pc.fill_null(b.column(1), "")
        upto = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < len(texts):
            before = int(upto[start - 1]) if start else 0
            stop = max(start + 1, int(np.searchsorted(upto, before + most - size, side="right")))
            held.append((b.column(0).slice(start, stop - start), texts.slice(start, stop - start)))
            size += int(upto[stop - 1]) - before
            start = stop
            if size >= most or start < len(texts):
                yield tuple(pa.concat_arrays(x) for x in zip(*held, strict=True))
                held, size = [], 0
    if held:
        yield tuple(pa.concat_arrays(x) for x in zip(*held, strict=True))


def as_binary(ids: np.ndarray, at: np.ndarray) -> pa.Array:
    """One binary value for each stretch ``at[i]:at[i + 1]`` of the ids."""
    data = pa.py_buffer(np.ascontiguousarray(ids, "<u4"))
    return pa.Array.from_buffers(pa.binary(), len(at) - 1, [None, pa.py_buffer((at * 4).astype(np.int32)), data])


def encode(docs: DataFrame, vocabulary: str, leaf_chars: int = LEAF_CHARS, decoded: bool = False) -> DataFrame:
    """``doc_id, ids, n_tokens`` for every row; ids are binary, little-endian unsigned 32-bit.

    With ``decoded`` the ids are decoded in the same pass (as ``decode`` does in one of its
    own, which takes a second Python worker for each task).
    """
    columns = "doc_id long, ids binary" + ", decoded string" * decoded
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary())] + [("decoded", pa.string())] * decoded)

    def finished(c: Codec, doc_ids: pa.Array, ids: pa.Array) -> pa.RecordBatch:
        texts = [pa.array([c.decode(x.as_py()) for x in ids], pa.string())] if decoded else []
        return pa.RecordBatch.from_arrays([doc_ids, ids, *texts], schema=schema)

    shared = prepare(docs.sparkSession).sparkContext.broadcast(vocabulary)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    is_long = F.char_length("text") > leaf_chars

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(shared.value)
        for doc_ids, texts in text_blocks(batches, CODED_BYTES):
            yield finished(c, doc_ids, as_binary(*c.encode(texts)))
        c.release()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for doc, row, text in zip(*(x.to_pylist() for x in b.columns), strict=True):
                for k in range(0, len(text), leaf_chars):
                    yield pa.RecordBatch.from_pylist(
                        [{"doc_id": doc, "row": row, "leaf": k // leaf_chars, "text": text[k:k + leaf_chars]}],
                        pa.schema([("doc_id", pa.int64()), ("row", pa.int64()), ("leaf", pa.int32()), ("text", pa.string())]))

    def leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(shared.value)
        schema = pa.schema([("doc_id", pa.int64()), ("row", pa.int64()), ("leaf", pa.int32()), *_NODE_ARROW])
        for b in batches:
            for r in b.to_pylist():
                yield pa.RecordBatch.from_pylist(
                    [{"doc_id": r["doc_id"], "row": r["row"], "leaf": r["leaf"], **_pack(leaf(c, r["text"]))}], schema)
        c.release()

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(shared.value)
        now, doc, nodes = None, None, []

        def done() -> pa.RecordBatch:
            return finished(c, pa.array([doc], pa.int64()), pa.array([tree(c, nodes).ids.tobytes()], pa.binary()))

        for b in batches:
            for i in range(b.num_rows):
                r = b.slice(i, 1).to_pylist()[0]
                if r["row"] != now:
                    if nodes:
                        yield done()
                    now, doc, nodes = r["row"], r["doc_id"], []
                nodes.append(_unpack(r))
        if nodes:
            yield done()
        nodes.clear()
        c.release()

    short = rows.where(~is_long).mapInArrow(whole, columns)
    # every long row gets a number of its own, as a doc_id may repeat
    long_rows = rows.where(is_long).select("doc_id", F.monotonically_increasing_id().alias("row"), "text")
    n = shuffle_partitions(docs)
    parts = long_rows.mapInArrow(cut, "doc_id long, row long, leaf int, text string").repartition(n, "row", "leaf")
    parts = parts.mapInArrow(leaves, f"doc_id long, row long, leaf int, {_NODE}")
    joined = parts.repartition(n, "row").sortWithinPartitions("row", "leaf").mapInArrow(merge, columns)
    return short.unionByName(joined).withColumn("n_tokens", (F.octet_length("ids") / 4).cast("long"))


def decode(encoded: DataFrame, vocabulary: str) -> DataFrame:
    """``encoded`` with ``decoded``: the library's text for ``ids``, special tokens included."""
    shared = prepare(encoded.sparkSession).sparkContext.broadcast(vocabulary)
    where = encoded.columns.index("ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(shared.value)
        for b in batches:
            for lo in range(0, b.num_rows, 256):
                part = b.slice(lo, 256)
                texts = [c.decode(x.as_py() or b"") for x in part.column(where)]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], names=[*part.schema.names, "decoded"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema.fields)
    return encoded.mapInArrow(run, f"{schema}, decoded string")
