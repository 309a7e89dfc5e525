"""Language identification by interpolated Kneser-Ney character models (operator 11).

A text is read as lower-case letters (and their marks), every stretch of other characters
being one space.  Each language has a model of four-character sequences: the probability of a
character after the three before it, with one absolute discount per order (n1 / (n1 + 2 n2)),
interpolated down to the uniform distribution; lower orders use continuation counts, the
number of different characters seen before a sequence.  The language with the lowest
cross-entropy per character wins.

* Counts cover every document that ``is_train`` admits: sequences are counted in each task and
  summed by Spark, and the lower orders and the contexts are aggregations of that table.
* A sequence stands in a model as a slot, the low ``hash_bits`` bits of its XXH64; sequences
  of one slot share their counts.  Each language and order is a sorted array of slots beside
  the arrays of counts.  The model goes to every task by broadcast: at most
  7 * 2**hash_bits * 12 to 20 bytes a language (30 MB at 18 bits), whatever the input.
* Calibration: one eighth of the training documents (by a hash of the text, so that copies
  stay together) adds nothing to the counts; its documents are scored, and a monotone fit of
  correct answers over the lead of the best language gives the score, the probability that
  the answer is right.  Per language and length the highest usual cross-entropy is kept, as
  far above the ``quantile`` as that is above the median; a text beyond it, or with a score
  under ``min_score``, is marked as rejected: junk, or a language that was not learned.

Defined cases: a null text, and one without a letter, is ``und`` with score 0, rejected; a
null doc_id is predicted like any other and is never held out; null languages teach nothing;
repeated rows get equal rows; ties go to the first language in code-point order; with no
training documents every text is ``und``; extra columns are ignored; an empty table gives an
empty table.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bpe import text_blocks
from .common import prepare, saved

ORDER = 4
HASH_BITS = 18
FOLD = 8
QUANTILE = 0.999
MIN_SCORE = 0.5
UNKNOWN = "und"
_SPACE = 0x20
_BLOCK = 1 << 21
_LEAD_STEPS = 8  # bins of the lead for each doubling
_P1, _P2, _P3, _P4, _P5 = (np.uint64(x) for x in (
    0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))  # the constants of XXH64


def hash_long(x: np.ndarray, seed: int = 42) -> np.ndarray:
    """XXH64 of each 64-bit number, as Spark's ``xxhash64`` of a long."""
    turn = lambda v, r: (v << np.uint64(r)) | (v >> np.uint64(64 - r))
    with np.errstate(over="ignore"):
        h = np.uint64(seed) + _P5 + np.uint64(8)
        h = turn(h ^ (turn(x.astype(np.uint64) * _P2, 31) * _P1), 27) * _P1 + _P4
        h = (h ^ (h >> np.uint64(33))) * _P2
        h = (h ^ (h >> np.uint64(29))) * _P3
    return h ^ (h >> np.uint64(32))


def _kinds() -> tuple[np.ndarray, np.ndarray]:
    kind = np.array([unicodedata.category(chr(i))[0] for i in range(1 << 16)])
    return kind == "L", (kind == "L") | (kind == "M")


_LETTER, _KEPT = _kinds()


def sequences(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All four-character sequences as 64-bit numbers, the text of each, and which texts have a letter."""
    lower = [t.lower() for t in texts]
    sizes = np.fromiter(map(len, lower), np.int64, len(lower)) + 1
    chars = np.frombuffer(("\n".join(lower) + "\n").encode("utf-32-le", "surrogatepass"), "<u4") if texts else np.zeros(0, "<u4")
    of = np.repeat(np.arange(len(texts)), sizes)
    letter, kept = _LETTER[chars & 0xFFFF], _KEPT[chars & 0xFFFF]
    wide = np.nonzero(chars > 0xFFFF)[0]
    for c in np.unique(chars[wide]).tolist():
        at, kind = wide[chars[wide] == c], unicodedata.category(chr(c))[0]
        letter[at], kept[at] = kind == "L", kind in "LM"
    after = np.zeros(len(chars), bool)
    after[1:] = kept[:-1]
    stays = kept | after  # a letter, or the first of a stretch of others behind one
    code = np.where(kept, (chars ^ (chars >> 16) * 40503) & 0xFFFF, _SPACE).astype(np.uint64)[stays]
    text = of[stays]
    out = code.copy()
    for k in range(1, ORDER):  # characters before the first are spaces
        before = np.full(len(code), _SPACE, np.uint64)
        same = text[k:] == text[:-k] if len(code) > k else np.zeros(0, bool)
        before[k:][same] = code[:-k][same]
        out |= before << np.uint64(16 * k)
    return out, text, np.bincount(of[letter], minlength=len(texts)) > 0


def count_sequences(docs: DataFrame) -> DataFrame:
    """``lang, order, gram, n`` of the rows ``lang, text``: counts of the highest order and
    continuation counts of the lower ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for langs, texts in text_blocks(batches, _BLOCK):
            grams, text, _ = sequences(texts.to_pylist())
            coded = langs.dictionary_encode()
            lang_of = coded.indices.to_numpy()[text]
            for i, lang in enumerate(coded.dictionary.to_pylist()):
                got = pa.array(grams[lang_of == i].view(np.int64)).value_counts()
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(got)), got.field("values"), got.field("counts")], names=["lang", "gram", "n"])

    top = docs.select("lang", "text").mapInArrow(run, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    now = saved(top, "char-sequences")
    out = now.select("lang", F.lit(ORDER).alias("order"), "gram", "n")
    for order in range(ORDER - 1, 0, -1):
        now = now.groupBy("lang", F.col("gram").bitwiseAND((1 << 16 * order) - 1).alias("gram")).agg(F.count(F.lit(1)).alias("n"))
        out = out.unionByName(now.select("lang", F.lit(order).alias("order"), "gram", "n"))
    return saved(out, "char-counts")


@dataclass
class Model:
    """Languages; per order the discounts, totals and numbers of types of each language, sorted
    slots with a row of counts for each, and contexts with rows of totals and types."""

    langs: list[str] = field(default_factory=list)
    bits: int = HASH_BITS
    discount: np.ndarray = field(default_factory=lambda: np.zeros((ORDER + 1, 0)))
    total: np.ndarray = field(default_factory=lambda: np.zeros(0))
    types: np.ndarray = field(default_factory=lambda: np.zeros(0))
    grams: dict[int, tuple[np.ndarray, np.ndarray]] = field(default_factory=dict)
    contexts: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=dict)
    #: calibration: leads and the share of right answers; (language, log2 length) -> highest usual entropy
    leads: np.ndarray = field(default_factory=lambda: np.zeros(0))
    right: np.ndarray = field(default_factory=lambda: np.zeros(0))
    usual: dict[tuple[str, int], float] = field(default_factory=dict)

    def _rows(self, slots: np.ndarray, keys: np.ndarray, tables: list[np.ndarray]) -> list[np.ndarray]:
        wanted = hash_long(keys) & np.uint64((1 << self.bits) - 1)
        at = np.minimum(np.searchsorted(slots, wanted), max(len(slots) - 1, 0))
        there = slots[at] == wanted if len(slots) else np.zeros(len(keys), bool)
        return [np.where(there[:, None], t[at], 0) if len(t) else np.zeros((len(keys), len(self.langs))) for t in tables]

    def log_probability(self, grams: np.ndarray) -> np.ndarray:
        """log2 of the last character's probability after the others, a column for each language."""
        p = np.broadcast_to(1 / (self.types + 1), (len(grams), len(self.langs)))
        for order in range(1, ORDER + 1):
            key = grams & np.uint64((1 << 16 * order) - 1 if order < ORDER else 0xFFFFFFFFFFFFFFFF)
            n, = self._rows(self.grams[order][0], key, [self.grams[order][1]])
            if order == 1:
                total, types = self.total[None, :], self.types[None, :]
            else:
                total, types = self._rows(self.contexts[order][0], key >> np.uint64(16), list(self.contexts[order][1:]))
            d = self.discount[order]
            p = np.where(total > 0, (np.maximum(n - d, 0) + d * types * p) / np.maximum(total, 1), p)
        return np.log2(np.maximum(p, 1e-300))

    def entropies(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Bits per character in each language, number of characters, and which texts have a letter."""
        grams, text, lettered = sequences(texts)
        coded = pa.array(grams.view(np.int64)).dictionary_encode()
        at = coded.indices.to_numpy(zero_copy_only=False)
        table = self.log_probability(coded.dictionary.to_numpy(zero_copy_only=False).view(np.uint64))
        n = np.bincount(text, minlength=len(texts))
        sums = [np.bincount(text, table[:, k][at], len(texts)) for k in range(len(self.langs))]
        return -np.stack(sums, axis=1).reshape(len(texts), -1) / np.maximum(n, 1)[:, None], n, lettered

    def answer(self, texts: list[str]) -> list[np.ndarray]:
        """Best language (its number, -1: none), its entropy, lead, and log2 of the length, of each text."""
        if not self.langs or not texts:
            return [np.full(len(texts), -1), *(np.zeros(len(texts)) for _ in range(3))]
        h, n, lettered = self.entropies(texts)
        best = h.argmin(axis=1)
        first = h[np.arange(len(h)), best]
        second = np.partition(h, 1, axis=1)[:, 1] if h.shape[1] > 1 else first
        return [np.where(lettered, best, -1), first, (second - first) * np.sqrt(n), np.floor(np.log2(np.maximum(n, 1)))]

    def score(self, lead: np.ndarray) -> np.ndarray:
        return np.interp(np.log2(1 + lead), self.leads, self.right) if len(self.leads) else np.full(len(lead), 0.5)

    def limits(self) -> np.ndarray:
        """The highest usual entropy of each language by log2 of the length, that of the nearest length seen."""
        out = np.full((len(self.langs) + 1, 64), np.inf)
        for k, lang in enumerate(self.langs):
            known = [n for name, n in self.usual if name == lang]
            for n in range(64 if known else 0):
                out[k, n] = self.usual[lang, min(known, key=lambda x: (abs(x - n), x))]
        return out


def _pack(rows: DataFrame, values: list[str]) -> list:
    """``lang, order, slot`` and values as one row of sorted arrays for each language and order;
    a group holds at most 2**hash_bits rows."""
    schema = "lang string, order int, slot binary" + "".join(f", {v} binary" for v in values)

    def run(t: pa.Table) -> pa.Table:
        t = t.sort_by("slot")
        data = [t.column("slot").to_numpy().astype("<u4"), *(t.column(v).to_numpy().astype("<i8") for v in values)]
        return pa.table({"lang": [t.column("lang")[0].as_py()], "order": pa.array([t.column("order")[0].as_py()], pa.int32()),
                         **{n: pa.array([d.tobytes()], pa.binary()) for n, d in zip(["slot", *values], data, strict=True)}})

    return rows.groupBy("lang", "order").applyInArrow(run, schema).collect()


def _dense(packed: list, langs: list[str], order: int, values: list[str]) -> tuple[np.ndarray, ...]:
    """Sorted slots of any language, and a table of each value with a column for each language."""
    own = {r["lang"]: r for r in packed if r["order"] == order}
    slots = {lang: np.frombuffer(r["slot"], "<u4") for lang, r in own.items()}
    every = np.unique(np.concatenate([np.zeros(0, "<u4"), *slots.values()]))
    tables = []
    for v in values:
        table = np.zeros((len(every), len(langs)), np.float32)
        for lang, r in own.items():
            table[np.searchsorted(every, slots[lang]), langs.index(lang)] = np.frombuffer(r[v], "<i8")
        tables.append(table)
    return every.astype(np.uint64), *tables


def learn(docs: DataFrame, hash_bits: int = HASH_BITS) -> Model:
    """The models of all languages of the rows ``lang, text`` (no nulls), uncalibrated."""
    counts = count_sequences(docs)
    slot = lambda key: F.xxhash64(key).bitwiseAND((1 << hash_bits) - 1)
    grams = _pack(counts.groupBy("lang", "order", slot(F.col("gram")).alias("slot")).agg(F.sum("n").alias("n")), ["n"])
    context = slot(F.shiftrightunsigned("gram", 16)).alias("slot")
    contexts = _pack(counts.where(F.col("order") > 1).groupBy("lang", "order", context).agg(
        F.sum("n").alias("total"), F.count(F.lit(1)).alias("types")), ["total", "types"])
    sums = counts.groupBy("lang", "order").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("types"),
                                               F.count_if(F.col("n") == 1).alias("n1"), F.count_if(F.col("n") == 2).alias("n2")).collect()
    langs = sorted({r["lang"] for r in sums})
    m = Model(langs, hash_bits, np.full((ORDER + 1, len(langs)), 0.5), np.zeros(len(langs)), np.zeros(len(langs)))
    for r in sums:
        k = langs.index(r["lang"])
        if r["n1"]:
            m.discount[r["order"], k] = r["n1"] / (r["n1"] + 2 * r["n2"])
        if r["order"] == 1:
            m.total[k], m.types[k] = r["total"], r["types"]
    m.grams = {o: _dense(grams, langs, o, ["n"]) for o in range(1, ORDER + 1)}
    m.contexts = {o: _dense(contexts, langs, o, ["total", "types"]) for o in range(2, ORDER + 1)}
    return m


def _answers(rows: DataFrame, model: Model, key: str, kind: str) -> DataFrame:
    """``key, lang_pred, entropy, lead, length, score, most`` of the rows ``key, text``: the answer (null:
    none), and the highest usual entropy of such texts."""
    shared = prepare(rows.sparkSession).sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        names, limits = pa.array([*m.langs, None], pa.string()), m.limits()
        for ids, texts in text_blocks(batches, _BLOCK):
            best, entropy, lead, length = m.answer(texts.to_pylist())
            pick = np.where(best < 0, len(m.langs), best)
            score = np.where(best < 0, 0.0, m.score(lead))
            yield pa.RecordBatch.from_arrays([ids, names.take(pa.array(pick)), *map(pa.array, (entropy, lead, length, score)),
                                              pa.array(limits[pick, length.astype(int)])], names=[key, "lang_pred", *numbers])

    numbers = ["entropy", "lead", "length", "score", "most"]
    return rows.select(key, "text").mapInArrow(run, f"{key} {kind}, lang_pred string, " + ", ".join(f"{n} double" for n in numbers))


def calibrate(model: Model, docs: DataFrame, quantile: float = QUANTILE) -> Model:
    """Score and limits of the model from documents ``lang, text`` that it has not learned from."""
    got = saved(_answers(docs, model, "lang", "string").where("lang_pred IS NOT NULL"), "calibration")
    bins = got.groupBy(F.floor(F.log2(1 + F.col("lead")) * _LEAD_STEPS).alias("bin")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("lang") == F.col("lang_pred")).alias("right")).orderBy("bin").collect()  # some hundred bins
    pools: list[tuple[int, int, int]] = []  # right answers never get rarer with the lead: bins that say so are pooled
    for r in bins:
        pools.append((r["right"], r["n"], 1))
        while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
            pools[-2:] = [tuple(map(sum, zip(*pools[-2:], strict=True)))]
    model.leads = np.array([(r["bin"] + 0.5) / _LEAD_STEPS for r in bins])
    model.right = np.repeat([(right + 1) / (n + 2) for right, n, _ in pools], [k for _, _, k in pools])
    usual = got.where("lang = lang_pred").groupBy("lang", F.col("length").cast("int").alias("length")).agg(
        F.percentile_approx("entropy", [0.5, quantile], 10_000).alias("h")).collect()  # a row for each language and doubling
    model.usual = {(r["lang"], r["length"]): 2 * r["h"][1] - r["h"][0] for r in usual}
    return model


def train(docs: DataFrame, is_train: Column, hash_bits: int = HASH_BITS) -> Model:
    """A calibrated model from the documents ``lang, text`` that ``is_train`` admits."""
    rows = docs.where(is_train & F.col("lang").isNotNull() & F.col("text").isNotNull()).select(
        F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    aside = F.pmod(F.xxhash64("text"), F.lit(FOLD)) == 0
    return calibrate(learn(rows.where(~aside), hash_bits), rows.where(aside))


def identify(docs: DataFrame, model: Model, min_score: float = MIN_SCORE) -> DataFrame:
    """``doc_id, lang_pred, score, cross_entropy, rejected`` for every row."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rejected = F.col("lang_pred").isNull() | (F.col("score") < min_score) | (F.col("entropy") > F.col("most"))
    return _answers(rows, model, "doc_id", "long").select(
        "doc_id", F.coalesce("lang_pred", F.lit(UNKNOWN)).alias("lang_pred"), "score",
        F.when(F.col("lang_pred").isNotNull(), F.col("entropy")).alias("cross_entropy"), rejected.alias("rejected"))
