"""Cross-tokenizer alignment by whitespace-token anchors (operator 12).

Two tokenizers encode every whole text: A, a byte-level BPE file of the ``tokenizers``
library, a space and the text; B, a ``sentencepiece`` model that adds that space itself.
Tokens are taken as the bytes they stand for.  Where the joined bytes of both are those of
the text, they cover it alike, and byte offsets at which tokens of both end cut it into
groups; a token of A and one of B are linked if their bytes overlap.

1. After full tokenisation the anchors are found: offsets at which a space-marked token
   begins in A and in B, both having a token end there.  They split a text into windows of
   token ids.  Equal windows (the tuple of both id lists) of a block of texts are stored
   once, the texts as numbers of windows.
2. A window is aligned once a block, all windows of the block in one vectorised pass; the
   result is looked up for every place at which the window stands.  This gives the counts of
   linked id pairs over the corpus, which are summed by pair with partial sums in each task.
3. The counts score the links of every text.  They are broadcast if there are at most
   ``broadcast_pairs`` of them (16 bytes each); otherwise each block's distinct pairs are
   joined with them and come back to the block by a cogroup.

A's merges are applied by ``tiktoken``, from the ranks in the vocabulary file itself, to texts of
characters that every Unicode version classes alike (up to U+024F and general punctuation);
all other texts, and vocabularies of another make, go through the ``tokenizers`` library.  B's
ids of a word are remembered: no piece of its vocabulary has a space behind another character,
so no merge crosses one (texts with stray spaces, and other models, are encoded whole).

Defined cases: null and empty texts, and those whose joined bytes differ from the space and
the text in A or B, have no tokens, zeros and an empty string of groups; null doc_ids and
repeated rows are rows of their own, and repeated texts count each time; strings of special
tokens are ordinary text; a text without spaces is one window; extra columns are ignored; an
empty table gives an empty table.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import _BYTE_CHARS, text_blocks
from .common import WIDE_ROWS, give_back, mix64, prepare, saved

BROADCAST_PAIRS = 1 << 22
#: Words whose ids in B a worker remembers.
CACHED_PIECES = 50_000
#: Small enough that the arrays of a block are no large objects to the JVM.
BLOCK_BYTES = 1 << 19
#: Held by a task before it hands its counts on.
_HELD_PAIRS = 1 << 20
#: Characters whose class as letter, number, space or other is the same in all Unicode versions in use.
_STABLE = re.compile(r"[\x00-\u024f\u2010-\u2027\u2030-\u205e]*").fullmatch
_PROBES = ["Ａ ﬁ é① ½ x", "the first\nline and\tmore", "漢字 カタ。 ö e\u0301 \u0301", "don't I'll 123 4,5", "\U0001F600 ok \u200b z", "a <s> </s> <0x41>"]
_BLOCK = "block string, docs binary, sizes binary, windows binary, a_ids binary, a_n binary, b_ids binary, b_n binary"


class Pieces:
    """What each id of a vocabulary stands for: all bytes in a row, where they begin, how many
    there are, and whether a space comes first."""

    def __init__(self, pieces: list[bytes]):
        self.data = np.frombuffer(b"".join(pieces) + b"\0", np.uint8)
        self.length = np.fromiter(map(len, pieces), np.int64, len(pieces))
        self.first = (np.cumsum(self.length) - self.length).astype(np.int32)
        self.marked = np.fromiter((p[:1] == b" " for p in pieces), bool, len(pieces))

    def joined(self, ids: np.ndarray) -> bytes:
        """The bytes of all tokens in a row."""
        n = self.length[ids]
        ends = np.cumsum(n)
        at = np.repeat(self.first[ids] - (ends - n).astype(np.int32), n)
        at += np.arange(len(at), dtype=np.int32)
        return self.data[at].tobytes()


class TokenizerA:
    def __init__(self, vocabulary: str):
        self.vocabulary = vocabulary
        spec = json.loads(vocabulary)
        byte_of = {c: b for b, c in _BYTE_CHARS.items()}
        names = {i: t for t, i in spec["model"]["vocab"].items()} | {t["id"]: t["content"] for t in spec.get("added_tokens", [])}
        self.pieces = Pieces([bytes(byte_of[c] for c in t) if all(c in byte_of for c in t) else t.encode("utf-8")
                              for t in (names.get(i, "") for i in range(max(names) + 1))])
        self.short = self._short_way(spec, byte_of)

    @staticmethod
    def _short_way(spec: dict, byte_of: dict[str, int]):
        """The merges as ranks, if every token but the single bytes is what one merge makes, in the order of the merges."""
        split, model = spec.get("pre_tokenizer") or {}, spec["model"]
        vocab, merges = model["vocab"], [m if isinstance(m, list) else m.split(" ") for m in model.get("merges", [])]
        plain = (spec.get("normalizer") is None and split.get("type") == "ByteLevel" and split.get("use_regex") and not split.get("add_prefix_space")
                 and model["type"] == "BPE" and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix",
                                                                              "end_of_word_suffix", "byte_fallback", "ignore_merges")))
        if not plain or any(vocab.get(x + y) != 256 + i for i, (x, y) in enumerate(merges)) or any(vocab.get(c, 256) > 255 for c in byte_of):
            return None
        import tiktoken

        ranks = {bytes(byte_of[c] for c in t): i for t, i in vocab.items() if i < 256 + len(merges)}
        # how the library splits a text before the merges: fixed by its ByteLevel step
        pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
        return tiktoken.Encoding("a", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    @cached_property
    def library(self):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        whole = Tokenizer.from_str(self.vocabulary)
        whole.encode_special_tokens = True
        whole.no_truncation()
        whole.no_padding()
        return whole

    def encode(self, text: str) -> np.ndarray:
        """Ids of a space and the text."""
        if self.short is not None and _STABLE(text):
            return self.short.encode_to_numpy(" " + text, disallowed_special=())
        return np.array(self.library.encode(" " + text, add_special_tokens=False).ids, np.uint32)


class TokenizerB:
    def __init__(self, model: bytes):
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_proto=model)
        names = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        names_as_bytes = [bytes([int(t[3:5], 16)]) if self.model.is_byte(i) else t.replace("▁", " ").encode("utf-8") for i, t in enumerate(names)]
        self.pieces = Pieces(names_as_bytes)


        self.by_pieces = not any(" " in p.lstrip(b" ").decode("utf-8", "replace") for p in names_as_bytes) and all(
            self.model.encode(t) == [i for w in t.split(" ") for i in self.model.encode(w)] for t in _PROBES)
        self.cache: dict[str, bytes] = {}

    def encode(self, text: str) -> np.ndarray:
        if not self.by_pieces or text.startswith(" ") or text.endswith(" ") or "  " in text:
            return np.array(self.model.encode(text), np.uint32)
        cache = self.cache = {} if len(self.cache) > CACHED_PIECES else self.cache
        parts = text.split(" ")
        new = [p for p in set(parts) if p not in cache]
        for lo in range(0, len(new), CACHED_PIECES):
            some = new[lo:lo + CACHED_PIECES]
            cache.update(zip(some, [np.array(x, np.uint32).tobytes() for x in self.model.encode(some, num_threads=1)], strict=True))
        return np.frombuffer(b"".join(map(cache.__getitem__, parts)), np.uint32)


class Both:
    """Both tokenizers."""

    def __init__(self, a: str, b: bytes):
        self.a, self.b = TokenizerA(a), TokenizerB(b)

    def encode(self, texts: list[str | None]) -> list[tuple[np.ndarray, np.ndarray] | None]:
        """Ids of each text in A and B; None for a text without tokens."""
        whole = [b" " + t.encode("utf-8") if t else b"" for t in texts]
        ids = [(self.a.encode(t), self.b.encode(t)) if t else None for t in texts]
        for k, pieces in enumerate((self.a.pieces, self.b.pieces)):
            ids = [c if c is not None and int(pieces.length[c[k]].sum()) == len(w) else None for c, w in zip(ids, whole, strict=True)]
            joined, at = pieces.joined(np.concatenate([np.zeros(0, np.uint32), *(c[k] for c in ids if c is not None)])), 0
            for i, c in enumerate(ids):
                if c is not None:
                    if joined[at:at + len(whole[i])] != whole[i]:
                        ids[i] = None
                    at += len(whole[i])
        return ids


_LOADED: dict[int, Both] = {}


def tokenizers(a: str, b: bytes) -> Both:
    """Both tokenizers, loaded once in a Python worker."""
    key = hash((a, b))
    if key not in _LOADED:
        _LOADED[key] = Both(a, b)
    return _LOADED[key]


def read_model(path: str) -> bytes:
    """A model file, read on the driver (some hundred KB) and sent with the tasks."""
    with open(path, "rb") as f:
        return f.read()


def cut(a: np.ndarray, b: np.ndarray, pieces_a: Pieces, pieces_b: Pieces) -> tuple[np.ndarray, np.ndarray]:
    """First tokens of all windows in A and in B, of texts one after the other.

    A text's first tokens both begin with the space before it, so each text begins a window.
    """
    start_a, start_b = np.cumsum(pieces_a.length[a]) - pieces_a.length[a], np.cumsum(pieces_b.length[b]) - pieces_b.length[b]
    anchors = np.intersect1d(start_a[pieces_a.marked[a]], start_b[pieces_b.marked[b]], assume_unique=True)
    return np.searchsorted(start_a, anchors), np.searchsorted(start_b, anchors)


_NAMES: list[np.ndarray] = []


def _names(ids: int) -> np.ndarray:
    """Each id with each of the marks that may stand behind it, made once in a worker."""
    if not _NAMES or len(_NAMES[0]) < ids:
        _NAMES[:] = [np.array([[f"{i}{m}" for m in ",|;\n"] for i in range(max(ids, 1 << 16))], object)]
    return _NAMES[0]


class Windows:
    """Aligned windows: both id lists of all of them in a row, and the links between them."""

    def __init__(self, a: np.ndarray, a_n: np.ndarray, b: np.ndarray, b_n: np.ndarray, pieces_a: Pieces, pieces_b: Pieces):
        self.a, self.b = a.astype(np.int64), b.astype(np.int64)
        self.first_a, self.first_b = np.r_[0, np.cumsum(a_n)].astype(np.int64), np.r_[0, np.cumsum(b_n)].astype(np.int64)
        self.end_a, self.end_b = np.cumsum(pieces_a.length[self.a]), np.cumsum(pieces_b.length[self.b])
        self.start_a, self.start_b = self.end_a - pieces_a.length[self.a], self.end_b - pieces_b.length[self.b]
        self.shared = np.intersect1d(self.end_a, self.end_b, assume_unique=True)
        closing = self.end_a[self.first_a[1:] - 1]  # windows end together in A and B
        self.n_groups = np.diff(np.searchsorted(self.shared, closing, side="right"), prepend=0)
        lo, hi = np.searchsorted(self.end_b, self.start_a, side="right"), np.searchsorted(self.start_b, self.end_a)
        n = hi - lo
        at_b = np.repeat(lo - np.cumsum(n) + n, n) + np.arange(n.sum())
        #: a linked pair is A's id in the high and B's id in the low 32 bits
        self.pairs = np.repeat(self.a, n) << 32 | self.b[at_b]
        links = np.r_[0, np.cumsum(n)]
        self.first_link = links[self.first_a]
        self.n_links = np.diff(self.first_link)

    def per_window(self, of_link: np.ndarray) -> np.ndarray:
        total = np.r_[0, np.cumsum(of_link)]
        return total[self.first_link[1:]] - total[self.first_link[:-1]]

    @cached_property
    def texts(self) -> list[str]:
        """The groups of each window as ``a1,a2|b1;a3|b2,b3``."""
        n = len(self.a) + len(self.b)
        # tokens in the order of groups, those of A before those of B
        group = np.r_[np.searchsorted(self.shared, self.end_a), np.searchsorted(self.shared, self.end_b)]
        side = np.r_[np.zeros(len(self.a), np.int64), np.ones(len(self.b), np.int64)]
        order = np.argsort(group << 1 | side, kind="stable")
        group, side, ids = group[order], side[order], np.r_[self.a, self.b][order]
        mark = np.zeros(n, np.int64)  # behind a token: "," or "|" or ";" or the window's end
        mark[:-1] = np.where(group[1:] != group[:-1], 2, np.where(side[1:] != side[:-1], 1, 0))
        mark[(self.first_a + self.first_b)[1:] - 1] = 3
        table = _names(int(ids.max(initial=0)) + 1)
        return "".join(table[ids, mark].tolist()).split("\n")[:-1]


def _hashes(ids: np.ndarray, first: np.ndarray, n: np.ndarray, salt: int) -> np.ndarray:
    """A 64-bit hash of each window's ids and their places."""
    place = np.arange(len(ids)) - np.repeat(first, n)
    return np.add.reduceat(mix64((ids.astype(np.uint64) << np.uint64(32)) ^ (place + (salt << 20)).astype(np.uint64)), first)


def _slices(first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The places of all tokens of the windows that begin at ``first``."""
    return np.repeat(first - np.cumsum(n) + n, n) + np.arange(n.sum())


def distinct_windows(a: np.ndarray, at_a: np.ndarray, b: np.ndarray, at_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first of all equal windows, and for each window which of those it equals.

    Windows are told apart by a hash, and each is then compared with the first of its hash, id
    by id; should two differ, another hash is taken.
    """
    if not len(at_a):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    n_a, n_b, salt = np.diff(at_a, append=len(a)), np.diff(at_b, append=len(b)), 1
    while True:
        h = mix64(_hashes(a, at_a, n_a, salt)) ^ _hashes(b, at_b, n_b, salt + 1)
        _, first, which = np.unique(h, return_index=True, return_inverse=True)
        same = first[which]
        if (np.array_equal(n_a, n_a[same]) and np.array_equal(n_b, n_b[same])
                and np.array_equal(a, a[_slices(at_a[same], n_a)]) and np.array_equal(b, b[_slices(at_b[same], n_b)])):
            return first, which
        salt += 2


def _pack(x: np.ndarray, kind) -> bytes:
    return x.astype(kind).tobytes()


def windows_of(docs: DataFrame, a: str, b: bytes) -> DataFrame:
    """Blocks of texts as numbers of their windows, and the ids of the distinct windows."""
    models = prepare(docs.sparkSession).sparkContext.broadcast((a, b))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import uuid

        both = tokenizers(*models.value)
        pieces_a, pieces_b = both.a.pieces, both.b.pieces
        for doc_ids, column in text_blocks(batches, BLOCK_BYTES):
            coded = both.encode(column.to_pylist())
            sound = np.array([c is not None for c in coded], bool)
            kept = [c for c in coded if c is not None]
            ids_a, ids_b = (np.concatenate([np.zeros(0, np.uint32), *(c[k] for c in kept)]) for k in (0, 1))
            tokens = np.cumsum([0] + [len(x) for x, _ in kept])
            at_a, at_b = cut(ids_a, ids_b, pieces_a, pieces_b)
            # the windows of a text are those from its first token on
            n_windows = np.zeros(len(coded), np.int64)
            n_windows[sound] = np.diff(np.searchsorted(at_a, tokens))
            first, windows = distinct_windows(ids_a, at_a, ids_b, at_b)
            n_a, n_b = np.diff(at_a, append=len(ids_a))[first], np.diff(at_b, append=len(ids_b))[first]
            null = doc_ids.is_null().to_numpy(zero_copy_only=False)
            docs_ = np.stack([doc_ids.fill_null(0).to_numpy(), null.astype(np.int64)])
            yield pa.RecordBatch.from_pylist([{
                "block": uuid.uuid4().hex, "docs": _pack(docs_, "<i8"), "sizes": _pack(n_windows, "<i8"), "windows": _pack(windows, "<u4"),
                "a_ids": _pack(ids_a[_slices(at_a[first], n_a)], "<u4"), "a_n": _pack(n_a, "<u4"),
                "b_ids": _pack(ids_b[_slices(at_b[first], n_b)], "<u4"), "b_n": _pack(n_b, "<u4")}], _BLOCK_ARROW)
        give_back()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, _BLOCK)


_BLOCK_ARROW = pa.schema([("block", pa.string())] + [(f.split()[0], pa.binary()) for f in _BLOCK.split(", ")[1:]])


def _blocks(batches: Iterator[pa.RecordBatch], both: Both) -> Iterator[tuple[dict, Windows, np.ndarray]]:
    """Each block, its aligned windows and the windows of its texts one after the other."""
    for batch in batches:
        for i in range(batch.num_rows):
            row = {name: batch.column(name)[i].as_py() for name in batch.schema.names}
            ids = [np.frombuffer(row[name], "<u4") for name in ("a_ids", "a_n", "b_ids", "b_n")]
            yield row, Windows(*ids, both.a.pieces, both.b.pieces), np.frombuffer(row["windows"], "<u4").astype(np.int64)


def pair_counts(blocks: DataFrame, a: str, b: bytes) -> DataFrame:
    """``pair, links, best``: how many links hold an id pair, and whether none of its B id has more."""
    models = prepare(blocks.sparkSession).sparkContext.broadcast((a, b))

    def merged(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        pairs, at = np.unique(np.concatenate([p for p, _ in held]), return_inverse=True)
        return pairs, np.bincount(at, np.concatenate([n for _, n in held]), len(pairs)).astype(np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        for _, w, placed in _blocks(batches, tokenizers(*models.value)):
            times = np.bincount(placed, minlength=len(w.n_links))
            held.append(merged([(w.pairs, np.repeat(times, w.n_links))]))
            if sum(len(p) for p, _ in held) > 2 * _HELD_PAIRS:
                held = [merged(held)]
                if len(held[0][0]) > _HELD_PAIRS:
                    yield pa.RecordBatch.from_arrays([*map(pa.array, held[0])], names=["pair", "links"])
                    held = []
        if held:
            yield pa.RecordBatch.from_arrays([*map(pa.array, merged(held))], names=["pair", "links"])
        held.clear()
        give_back()

    counts = blocks.select("windows", "a_ids", "a_n", "b_ids", "b_n").mapInArrow(run, "pair long, links long")
    counts = saved(counts.groupBy("pair").agg(F.sum("links").alias("links")), "pair-links")
    b_id = F.col("pair").bitwiseAND(0xFFFFFFFF)
    most = counts.groupBy(b_id.alias("b")).agg(F.max("links").alias("most"))
    return counts.join(most, b_id == F.col("b")).select("pair", "links", (F.col("links") == F.col("most")).alias("best"))


_OUT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups string"


def _scored(row: dict, w: Windows, placed: np.ndarray, links: np.ndarray, best: np.ndarray) -> pa.RecordBatch:
    """The rows of a block, given count and mark of each link of its windows."""
    doc_ids, null = np.frombuffer(row["docs"], "<i8").reshape(2, -1)
    upto = np.r_[0, np.cumsum(np.frombuffer(row["sizes"], "<i8"))]

    def per_text(of_window: np.ndarray) -> pa.Array:
        total = np.r_[0, np.cumsum(of_window[placed])]
        return pa.array(total[upto[1:]] - total[upto[:-1]], pa.int64())

    texts = np.array(w.texts, object)[placed].tolist() if len(placed) else []
    groups = [";".join(texts[i:j]) for i, j in zip(upto[:-1].tolist(), upto[1:].tolist(), strict=True)]
    return pa.RecordBatch.from_arrays(
        [pa.array(doc_ids, pa.int64(), mask=null.astype(bool)), per_text(np.diff(w.first_a)), per_text(np.diff(w.first_b)), per_text(w.n_groups),
         per_text(w.n_links), per_text(w.per_window(best)), per_text(w.per_window(links)), pa.array(groups, pa.string())],
        names=[f.split()[0] for f in _OUT.split(", ")])


def align(docs: DataFrame, a: str, b: bytes, broadcast_pairs: int = BROADCAST_PAIRS) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups`` for every row.

    ``groups`` spells the groups as ``a1,a2|b1;a3|b2,b3`` in ids of A and B.  ``n_best`` is the
    number of links whose id pair no other pair of its B id exceeds in links over the corpus,
    ``count_sum`` the sum of the corpus-wide counts over the links.
    """
    spark = prepare(docs.sparkSession)
    models = spark.sparkContext.broadcast((a, b))
    blocks = saved(windows_of(docs, a, b), "token-windows", WIDE_ROWS)
    pairs = saved(pair_counts(blocks, a, b), "pair-counts")
    if pairs.count() <= broadcast_pairs:
        got = pairs.orderBy("pair").toArrow()
        table = spark.sparkContext.broadcast([got.column(k).to_numpy() for k in range(3)])

        def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known, links, best = table.value
            for row, w, placed in _blocks(batches, tokenizers(*models.value)):
                at = np.searchsorted(known, w.pairs)
                yield _scored(row, w, placed, links[at], best[at])
            give_back()

        return blocks.mapInArrow(score, _OUT)

    def distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, w, _ in _blocks(batches, tokenizers(*models.value)):
            found = np.unique(w.pairs)
            yield pa.RecordBatch.from_arrays([pa.array([row["block"]] * len(found)), pa.array(found)], names=["block", "pair"])

    def scored_block(left: pa.Table, right: pa.Table) -> pa.Table:
        known = right.sort_by("pair")
        known, links, best = (known.column(k).to_numpy() for k in ("pair", "links", "best"))
        out = []
        for row, w, placed in _blocks(iter(left.to_batches()), tokenizers(*models.value)):
            at = np.searchsorted(known, w.pairs)
            out.append(_scored(row, w, placed, links[at], best[at]))
        return pa.Table.from_batches(out, _OUT_ARROW)

    # a block and its distinct pairs are bounded by the block's bytes
    of_blocks = blocks.select("block", "windows", "a_ids", "a_n", "b_ids", "b_n").mapInArrow(distinct, "block string, pair long")
    found = of_blocks.join(pairs, "pair").groupBy("block")
    return blocks.groupBy("block").cogroup(found).applyInArrow(scored_block, _OUT)


_OUT_ARROW = pa.schema([(f.split()[0], pa.string() if f.endswith("string") else pa.int64()) for f in _OUT.split(", ")])
