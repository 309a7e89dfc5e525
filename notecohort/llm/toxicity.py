"""Toxicity by misspelling-tolerant lexicon matching in context (operator 9).

The lexicon is a trie of words and word beginnings learned from labelled rows.  A
Levenshtein automaton is intersected with the trie: its states are sets of (trie node,
edits spent), built as they are met, so a word of the text is matched against all terms in
one walk over its letters and is dropped at the first letter that no term can follow.
Whole words tolerate one edit from ``EDIT_1`` letters on and two from ``EDIT_2``, two letters
that change places being one edit; word beginnings are matched exactly, and the whole words
of the lexicon that start with one stay beside it with their own edits.  Words that clean
training texts hold about as often as toxic ones stand for no term but themselves, and a term
with more than ``RARE`` such words beside it that are found in one clean text only tolerates
no edits: other texts hold others (the estimate of Good and Turing).  A match with an edit
has the fixed share ``MISSPELT`` of its term's weight, so that it counts as much where the
labelled rows hold no misspelling; the model is fitted on matches without edits.

Every match is weighed by its context: within ``WINDOW`` characters, a match inside a
quotation (a mark that opens after white space, is still open at the match and is closed
behind it) or after a reporting word counts as quoted, one beside another match or a direct
address as abuse.  A quoted match has the fixed share ``QUOTED`` of its weight, whether or not
the labelled rows hold any.  A logistic model over the summed weights gives the score.

Learning uses labelled rows only where ``is_train`` holds.  Half of them, all of that half,
choose the lexicon: words and beginnings are counted over their whole texts, and every one that
passes a test of significance is a term.  At most ``max_per_class`` rows of each class of the
other half (the documented bound of the sample, taken in the order of a hash of the id) fit the
few weights of the model.  Labels, language, source
and id are no inputs of a score.  Scoring reads every whole text.

Defined cases: a null or empty text has no match and gets the model's base score; a null
doc_id is scored like any other and is never held out; repeated rows get equal scores;
with several labels for one id, or for equal texts, the toxic one holds; labels without text are ignored;
without toxic training rows the lexicon is empty and every score is 0; extra columns are
ignored; an empty table gives an empty table.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from math import erfc, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import prepare, saved

EDIT_1, EDIT_2 = 5, 9
PREFIXES = (4, 5, 6, 7, 8)
WINDOW = 48
MAX_PER_CLASS = 2000
MIN_ROWS, ODDS = 3, 10
FALSE_TERMS = 0.02
PART = 0.1
#: Stronger terms beside which a term has no row of its own, and the share of its rows that have to be.
COVER, OWN = 8, 0.2
#: Ids, or keys, that are sent to all tasks at most (some 30 bytes each); more are joined.
BROADCAST_IDS = 2_000_000
THRESHOLD = 0.3
FEATURES = 5
#: The model's inputs that ``design`` makes of them.
INPUTS = FEATURES - 2
QUOTED = 0.25
MISSPELT = 0.8
RARE = 1
_WORDS = re.compile(r"[^\W_]+").findall
_CACHED_WORDS = 200_000
_CACHED_STATES = 50_000
#: Marks and words of reported speech, and of address, in the languages of the corpus.
QUOTES = {'"': '"”', "'": "'’", "“": "”\"", "„": "“”\"", "«": "»", "»": "«", "‘": "’'", "‚": "‘’'"}
REPORTING = frozenset("said says called wrote quote quoted word term sagte nannte schrieb dit appelé écrit dijo llamó escribió".split())
ADDRESS = frozenset("you your du dein ihr tu toi vous ton votre tú usted vosotros".split())


class Lexicon:
    """A trie of terms and the automaton over it.  A term is (text, is_prefix, weight).

    ``swaps`` counts two letters that change places as one edit; the words of ``clean`` are
    matched without edits only, the terms of ``strict`` tolerate none.
    """

    def __init__(self, terms: list[tuple[str, bool, float]], swaps: bool = False, clean: frozenset[str] = frozenset(),
                 strict: frozenset[str] = frozenset()):
        self.terms, self.swaps, self.clean = terms, swaps, clean
        self.limit = [0 if prefix or text in strict else self.edits(text) for text, prefix, _ in terms]
        self.next: list[dict[str, int]] = [{}]
        self.ends: list[list[int]] = [[]]
        self.slack = [0]  # most edits that a term below a node tolerates
        for t, (text, _, _) in enumerate(terms):
            node, slack = 0, self.limit[t]
            self.slack[0] = max(self.slack[0], slack)
            for c in text:
                if c not in self.next[node]:
                    self.next[node][c] = len(self.next)
                    self.next.append({})
                    self.ends.append([])
                    self.slack.append(0)
                node = self.next[node][c]
                self.slack[node] = max(self.slack[node], slack)
            self.ends[node].append(t)
        self._reset()

    @staticmethod
    def edits(text: str) -> int:
        return (len(text) >= EDIT_1) + (len(text) >= EDIT_2)

    def _reset(self) -> None:
        self.states: dict[frozenset, int] = {}
        self.sets: list[frozenset] = []
        self.moves: list[dict[str, int]] = []
        self.starts_with: list[int | None] = []  # term whose beginning has just been completed
        self.words: dict[str, tuple[int, int] | None] = {}
        self.start = self._state({(0, 0, "")})

    def _state(self, pairs: set[tuple[int, int, str]]) -> int:
        """The state of (node, edits spent, letter that must come next after a swap, or "")."""
        todo = list(pairs)
        while todo:  # a letter of the term may be missing from the word
            node, spent, due = todo.pop()
            for child in self.next[node].values() if not due else ():
                if spent < self.slack[child] and (child, spent + 1, "") not in pairs:
                    pairs.add((child, spent + 1, ""))
                    todo.append((child, spent + 1, ""))
        least: dict[tuple[int, str], int] = {}
        for node, spent, due in pairs:
            least[node, due] = min(spent, least.get((node, due), spent))
        key = frozenset((node, spent, due) for (node, due), spent in least.items())
        if not key:
            return -1
        if key not in self.states:
            self.states[key] = len(self.sets)
            self.sets.append(key)
            self.moves.append({})
            done = [t for node, spent, due in key if not spent and not due for t in self.ends[node] if self.terms[t][1]]
            self.starts_with.append(min(done, default=None))
        return self.states[key]

    def _move(self, state: int, c: str) -> int:
        pairs = set()
        for node, spent, due in self.sets[state]:
            if due:
                if c == due:
                    pairs.add((node, spent, ""))
                continue
            child = self.next[node].get(c)
            if child is not None:
                pairs.add((child, spent, ""))
            if spent < self.slack[node]:  # a letter too many, or another letter
                pairs.add((node, spent + 1, ""))
            for k, x in self.next[node].items():
                if k != c and spent < self.slack[x]:
                    pairs.add((x, spent + 1, ""))
                    y = self.next[x].get(c) if self.swaps else None
                    if y is not None and spent < self.slack[y]:
                        pairs.add((y, spent + 1, k))
        to = self.moves[state][c] = self._state(pairs)
        return to

    def match(self, word: str) -> tuple[int, int] | None:
        """The term that a lower-case word stands for and the edits between them."""
        if word in self.words:
            return self.words[word]
        if len(self.words) > _CACHED_WORDS or len(self.sets) > _CACHED_STATES:
            self._reset()
        state, found = self.start, None
        for c in word:
            to = self.moves[state].get(c)
            state = self._move(state, c) if to is None else to
            if state < 0:
                break
            if self.starts_with[state] is not None:
                found = (self.starts_with[state], 0)
                break
        if found is None and state >= 0:
            ended = [(spent, t) for node, spent, due in self.sets[state] if not due for t in self.ends[node]
                     if not self.terms[t][1] and spent <= (0 if word in self.clean else self.limit[t])]
            if ended:
                spent, t = min(ended)
                found = (t, spent)
        self.words[word] = found
        return found


def _closed(text: str, marks: str) -> bool:
    """Whether one of the marks ends a quotation in ``text``: behind a letter or a point, and
    not inside a word as an apostrophe is."""
    return any(c in marks and not (text[i - 1:i] or "x").isspace() and not text[i + 1:i + 2].isalnum() for i, c in enumerate(text))


def context(text: str, start: int, end: int) -> tuple[bool, bool]:
    """Whether a match stands in quotation, and whether it addresses someone."""
    before = text[max(0, start - WINDOW):start].rpartition("\n")[2]
    after = text[end:end + WINDOW + 1].partition("\n")[0]
    lo, marks = start - len(before), False
    for i, c in enumerate(before):
        if c in QUOTES and (lo + i == 0 or text[lo + i - 1].isspace()) and not (text[lo + i + 1:lo + i + 2] or " ").isspace():
            marks = marks or not _closed(before[i + 1:] + "x", QUOTES[c]) and _closed(after, QUOTES[c])
    words, after = _WORDS(before)[-4:], after[:WINDOW]
    return marks or not REPORTING.isdisjoint(words), not ADDRESS.isdisjoint(words + _WORDS(after)[:4])


def features(lexicon: Lexicon, text: str) -> list[float]:
    """Summed weights of direct, of misspelt and of quoted matches, density, and address."""
    text = text.lower()
    words = _WORDS(text)
    hits = {w: m for w in set(words) if (m := lexicon.match(w))}
    if not hits:
        return [0.0] * FEATURES
    spots = sorted((m.start(), m.end(), m.group()) for m in re.finditer(
        r"(?<![^\W_])(?:" + "|".join(map(re.escape, sorted(hits, key=len, reverse=True))) + r")(?![^\W_])", text))
    direct = misspelt = quoted = aimed = 0.0
    for i, (start, end, word) in enumerate(spots):
        term, spent = hits[word]
        weight = lexicon.terms[term][2]
        inside, address = context(text, start, end)
        near = any(abs(spots[k][0] - start) <= WINDOW for k in (i - 1, i + 1) if 0 <= k < len(spots))
        if inside and not near:
            quoted += weight
        else:
            share = MISSPELT ** spent
            direct += 0 if spent else weight
            misspelt += share * weight if spent else 0
            aimed += share * (near or address)
    return [float(np.log1p(direct)), float(np.log1p(misspelt)), float(np.log1p(quoted)),
            100 * (direct + misspelt + QUOTED * quoted) / (len(words) + 20), float(np.log1p(aimed))]


def design(x: np.ndarray) -> np.ndarray:
    """The model's inputs: misspelt matches, by their share, and quoted ones are added to the direct ones."""
    return np.c_[np.log1p(np.expm1(x[:, 0]) + np.expm1(x[:, 1]) + QUOTED * np.expm1(x[:, 2])), x[:, 3:]]


@dataclass
class Model:
    terms: list[tuple[str, bool, float]] = field(default_factory=list)
    mean: np.ndarray = field(default_factory=lambda: np.zeros(INPUTS))
    scale: np.ndarray = field(default_factory=lambda: np.ones(INPUTS))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(INPUTS + 1))
    trained: bool = False
    clean: frozenset[str] = frozenset()
    strict: frozenset[str] = frozenset()

    def lexicon(self) -> Lexicon:
        return Lexicon(self.terms, True, self.clean, self.strict)

    def score(self, x: np.ndarray) -> np.ndarray:
        if not self.trained:
            return np.zeros(len(x))
        z = np.c_[np.ones(len(x)), (design(x) - self.mean) / self.scale] @ self.weights
        return 1 / (1 + np.exp(-np.clip(z, -50, 50)))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % 4 == 2, F.lit(False))


def _labelled(docs: DataFrame, labels: DataFrame, is_train: Column) -> DataFrame:
    """``doc_id, h, toxic, turn, lexical`` of one row for each distinct labelled training text (``h`` is its
    hash): equal texts take the toxic label, and a turn and a half by their hash.  Narrow rows only."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & is_train).groupBy("doc_id").agg(
        F.max(F.col("toxic").cast("int")).alias("toxic"))
    texts = docs.select("doc_id", _hash().alias("h")).join(known, "doc_id").groupBy("h").agg(
        F.min("doc_id").alias("doc_id"), F.max("toxic").alias("toxic"))
    turn = F.xxhash64("h")
    return saved(texts.select("doc_id", "h", "toxic", turn.alias("turn"), (F.shiftright(turn, 20) % 2 == 0).alias("lexical")), "training-ids")


def _hash() -> Column:
    return F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))


def _texts(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """``text, toxic`` of the chosen texts: their ids go to the rows while they are few."""
    ids = ids.select("doc_id", "h", "toxic")
    ids = F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids
    rows = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), _hash().alias("h"))
    # rows that repeat an id and its text are one text
    return rows.join(ids, ["doc_id", "h"])


def _starts(n: int) -> Column:
    return F.transform(F.filter("w", lambda x: F.length(x) > n), lambda x: F.substring(x, 1, n))


_SPLIT = r"[^\p{L}\p{N}]+"


def _significant(t: Column, c: Column, n1: int, n0: int) -> Column:
    """The likelihood ratio (G squared) of a key that ``t`` of ``n1`` toxic and ``c`` of ``n0`` clean rows hold."""
    share = (t + c) / F.lit(float(n1 + n0))
    part = lambda seen, all_, p: F.when(seen > 0, seen * F.log(seen / (all_ * p))).otherwise(0.0)
    return 2 * (part(t, n1, share) + part(c, n0, share) + part(n1 - t, n1, 1 - share) + part(n0 - c, n0, 1 - share))


def _keys(rows: DataFrame) -> DataFrame:
    """``row, key``: the distinct words (marked with ``$``) and beginnings of each row."""
    starts = [_starts(n) for n in PREFIXES]
    whole = F.transform(F.filter("w", lambda x: F.length(x) >= PREFIXES[0]), lambda x: F.concat(x, F.lit("$")))
    words = rows.select(F.monotonically_increasing_id().alias("row"), F.array_distinct(F.split(F.lower("text"), _SPLIT)).alias("w"))
    return words.select("row", F.explode(F.array_distinct(F.concat(whole, *starts))).alias("key"))


def _own_rows(toxic: DataFrame, terms: list[str]) -> dict[str, int]:
    """Of each term the toxic rows in which at most ``COVER - 1`` terms come before it in the list."""
    number = F.broadcast(toxic.sparkSession.createDataFrame([(k, i) for i, k in enumerate(terms)], "key string, term int"))
    in_rows = _keys(toxic).join(number, "key").groupBy("row").agg(F.slice(F.sort_array(F.collect_list("term")), 1, COVER).alias("first"))
    got = in_rows.select(F.explode("first").alias("term")).groupBy("term").count().collect()  # a row a term
    return {terms[r["term"]]: r["count"] for r in got}


def _terms(toxic: DataFrame, clean: DataFrame, n1: int, n0: int) -> list[tuple[str, bool, float]]:
    """The terms that rows of ``text`` tell to be toxic, of ``n1`` toxic and ``n0`` clean ones.

    A term is held by ``MIN_ROWS`` toxic rows and by ``ODDS`` times the share of toxic rows as of clean
    ones; of the keys that are, those are taken whose likelihood ratio is so high that at most a share
    ``FALSE_TERMS`` of the taken would be so by chance, of all keys of the toxic rows (Benjamini and
    Hochberg).  Clean rows are counted for the keys that enough toxic rows hold.
    """
    if not n1:
        return []
    counts = saved(_keys(toxic).groupBy("key").agg(F.count(F.lit(1)).alias("t")), "toxic-keys")
    held = counts.where(F.col("t") >= MIN_ROWS)
    # hashes are enough to leave the other keys of clean rows out
    wanted = held.select(F.xxhash64("key").alias("k"))
    wanted = F.broadcast(wanted) if held.count() <= BROADCAST_IDS else wanted
    beside = _keys(clean).withColumn("k", F.xxhash64("key")).join(wanted, "k", "left_semi").groupBy("key").agg(F.count(F.lit(1)).alias("c"))
    t, c = F.col("t"), F.col("c")
    odds = ((t + 0.5) / (n1 + 1)) / ((c + 0.5) / (n0 + 1))
    ratio = F.floor(_significant(t, c, n1, n0) * 8).cast("int")
    both = held.join(beside, "key", "left").select("key", "t", F.coalesce("c", F.lit(0)).alias("c"))
    good = saved(both.withColumn("odds", odds).withColumn("ratio", ratio).where(F.col("odds") >= ODDS), "term-counts")
    tested, least, taken = counts.count(), np.inf, 0
    for r in good.groupBy("ratio").count().orderBy(F.desc("ratio")).collect():  # some hundred steps
        taken += r["count"]
        if tested * erfc(sqrt(r["ratio"] / 16)) / 2 <= FALSE_TERMS * taken:
            least = r["ratio"]
    good = {r["key"]: r for r in good.where(F.col("ratio") >= float(least)).orderBy(F.desc("t"), "key").collect()}
    # a beginning that one word accounts for is left to the word, and a longer one to a shorter
    best: Counter = Counter()
    for k, r in good.items():
        for m in PREFIXES:
            if k.endswith("$") and len(k) - 1 > m:
                best[k[:m]] = max(best[k[:m]], r["t"])
    stems = {k for k, r in good.items() if not k.endswith("$") and best[k] < 0.8 * r["t"]}
    stems = {k for k in stems if not any(k[:m] in stems for m in PREFIXES if m < len(k))}
    # whole words that make up a good part of a beginning stay beside it: they tolerate edits
    above = lambda k: next((k[:m] for m in PREFIXES if m < len(k) - 1 and k[:m] in stems), None)
    chosen = [k for k in good if k in stems or k.endswith("$") and (above(k) is None or good[k]["t"] >= PART * good[above(k)]["t"])]
    # near copies of toxic texts share all their words: what counts is a term's rows without stronger terms
    own = _own_rows(toxic, chosen) if chosen else {}
    chosen = [k for k in chosen if own.get(k, 0) >= max(MIN_ROWS, OWN * good[k]["t"])]
    return [(k.rstrip("$"), not k.endswith("$"), float(np.log(good[k]["odds"]))) for k in chosen]


def _clean_words(rows: DataFrame, n1: int, n0: int, terms: list[tuple[str, bool, float]]) -> tuple[frozenset[str], frozenset[str]]:
    """Words within the edits of a term that clean rows of ``text, toxic`` hold about as often as toxic ones,
    and the terms that have more than ``RARE`` of them that are found in one clean row only."""
    terms_of = rows.sparkSession.sparkContext.broadcast(terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon, found = Lexicon(terms_of.value, True), Counter()
        for b in batches:
            for text, toxic in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                found.update((w, toxic) for w in set(_WORDS(text.lower())) if (m := lexicon.match(w)) is not None and m[1] > 0)
        yield pa.RecordBatch.from_pylist([{"word": w, "toxic": x, "n": n} for (w, x), n in found.items()], _NEAR)

    near = rows.select("text", "toxic").mapInArrow(run, "word string, toxic int, n long")  # words that differ from a term by its edits
    counts = near.groupBy("word").agg(F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("t"),
                                      F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("c"))
    odds = ((F.col("t") + 0.5) / (n1 + 1)) / ((F.col("c") + 0.5) / (n0 + 1))
    found = counts.where((F.col("c") > 0) & (odds < 5)).select("word", "c").collect()
    clean, strict = frozenset(r["word"] for r in found), frozenset()
    rare = [r["word"] for r in found if r["c"] == 1]
    while True:  # a word beside a strict term may stand beside another term too
        lexicon = Lexicon(terms, True, strict=strict)
        beside = Counter(terms[m[0]][0] for w in rare if (m := lexicon.match(w)) and m[1])
        more = {t for t, n in beside.items() if n > RARE}
        if not more:
            return clean, strict
        strict |= more


_NEAR = pa.schema([("word", pa.string()), ("toxic", pa.int32()), ("n", pa.int64())])


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 50) -> np.ndarray:
    x, w = np.c_[np.ones(len(x)), x], np.zeros(x.shape[1] + 1)
    keep = np.diag([1e-6] + [ridge] * (len(w) - 1))
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + keep, x.T @ (y - p) - keep @ w)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return w


def train(docs: DataFrame, labels: DataFrame, is_train: Column, max_per_class: int = MAX_PER_CLASS) -> Model:
    ids = _labelled(docs, labels, is_train)
    choose, fit = ids.where("lexical"), ids.where("NOT lexical")
    n = {r["toxic"]: r["count"] for r in choose.groupBy("toxic").count().collect()}
    n1, n0 = n.get(1, 0), n.get(0, 0)
    terms = _terms(_texts(docs, choose.where("toxic = 1")), _texts(docs, choose.where("toxic = 0")), n1, n0)
    clean, strict = _clean_words(_texts(docs, choose), n1, n0, terms) if terms else (frozenset(), frozenset())
    parts = [fit.where(F.col("toxic") == c).orderBy("turn").limit(max_per_class) for c in (0, 1)]
    sample = saved(_texts(docs, parts[0].unionByName(parts[1])), "training-texts")  # 2 * max_per_class rows
    lexicon_of = docs.sparkSession.sparkContext.broadcast(terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Lexicon(lexicon_of.value, strict=frozenset(t for t, _, _ in lexicon_of.value))  # no edits
        for b in batches:
            rows = [features(lexicon, t) for t in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.float64())), b.column(1)], names=["x", "toxic"])

    got = sample.select("text", "toxic").mapInArrow(run, "x array<double>, toxic int").collect()  # bounded sample
    y = np.array([r["toxic"] for r in got], float)
    if not terms or not 0 < y.sum() < len(y):
        return Model()
    x = design(np.array([r["x"] for r in got]))
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    scale[scale < 1e-6] = 1.0
    return Model(terms, mean, scale, _logistic((x - mean) / scale, y), True, clean, strict)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, score`` for every row."""
    shared = prepare(docs.sparkSession).sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        lexicon = m.lexicon()
        for b in batches:
            x = np.array([features(lexicon, t.as_py() or "") for t in b.column(1)]).reshape(-1, FEATURES)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(m.score(x))], names=["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        run, "doc_id long, score double")


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs``."""
    model = train(docs, labels, ~held_out(F.col("doc_id")))
    return score(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                                     (F.col("score") >= threshold).cast("int").alias("predicted"))


def reject_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the rows whose text scores ``threshold`` or more.

    The text is scored once, beside its row; a null doc_id needs no join.
    """
    model = train(docs, labels, ~held_out(F.col("doc_id")))
    shared = prepare(docs.sparkSession).sparkContext.broadcast(model)
    where = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        lexicon = m.lexicon()
        for b in batches:
            x = np.array([features(lexicon, t.as_py() or "") for t in b.column(where)]).reshape(-1, FEATURES)
            yield b.filter(pa.array(m.score(x) < threshold))

    return docs.mapInArrow(run, docs.schema)
