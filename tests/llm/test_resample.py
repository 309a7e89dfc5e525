"""Importance resampling against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest

from notecohort.llm import queries, resample
from notecohort.llm.common import saved

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def features(text):
    words = WORDS.findall((text or "").translate(LOWER))
    return len(words), [zlib.crc32(" ".join(words[i:i + n]).encode()) % 10_000 for n in (1, 2, 3) for i in range(len(words) - n + 1)]


def brute(rows, target, percent=5, min_words=20):
    each, s, t = [features(x) for _, x in rows], Counter(), Counter()
    for _, f in each:
        s.update(f)
    for x in target:
        t.update(features(x)[1])
    n_s, n_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (n_s + 10_000) / ((s[b] + 1) * (n_t + 10_000)))) for b in range(10_000)]
    out = []
    for (d, _), (n, f) in zip(rows, each, strict=True):
        w = sum(gain[b] for b in f)
        h = int(hashlib.sha256(f"42:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        out.append([d, n, len(f), w, w + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    fit = sorted((o for o in out if o[1] >= min_words), key=lambda o: (-o[4], o[0] is None, o[0] or 0, o[2]))
    for i, o in enumerate(fit[:percent * len(fit) // 100]):
        o[5] = i + 1
    return Counter(map(tuple, out))


def given(df):
    return [(r.doc_id, r.text) for r in df.collect()]


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    docs, target = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "benchmark"))
    want = Counter({(d, f, w, s, r): n for (d, _, f, w, s, r), n in brute(given(docs), [r.text for r in target.collect()]).items()})
    assert Counter(map(tuple, queries.op13_importance_resampling(spark, sf).collect())) == want


def test_checksums_of_long_words_and_blocks():
    rnd = random.Random(3)
    texts = ["a" * 49 + " " + "b" * 48 + " c " + "é" * 200, "", "  x  ", "Z-9_a`b~\x7fc\x80d", "y" * 100_000,
             " ".join("".join(rnd.choice("abcé0Z") for _ in range(rnd.randint(1, 60))) for _ in range(500))]
    words = resample.Words([t.encode() for t in texts])
    got = [[] for _ in texts]
    for text, crc in words.runs(3):
        for i, c in zip(text.tolist(), crc.tolist(), strict=True):
            got[i].append(c % 10_000)
    assert got == [features(t)[1] for t in texts]


@pytest.mark.parametrize("percent", [0, 5, 37, 100])
def test_odd_rows(spark, odd, none, percent):
    target = spark.createDataFrame([(1, "word1 word2 word3", 2), (2, None, 3), (None, "", None)], "item_id int, text string, score int")
    got = resample.resample(odd, target, percent=percent, min_words=2)
    assert Counter(map(tuple, got.collect())) == brute(given(odd), ["word1 word2 word3"], percent, 2)
    assert resample.resample(none, target).collect() == []


def test_no_target(spark, odd):
    empty = spark.createDataFrame([], "text string")
    assert Counter(map(tuple, resample.resample(odd, empty, percent=50, min_words=1).collect())) == brute(given(odd), [], 50, 1)


def test_hot_equal_rows_at_the_cut(spark):
    """A third of all rows are one row: as many of it are drawn as fit."""
    rows = [(i, f"w{i} " * 21) for i in range(200)] + [(1000, "hot " * 30)] * 100
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    target = spark.createDataFrame([("hot hot hot w3",)], "text string")
    for percent in (10, 20, 90):
        got = resample.resample(docs, target, percent=percent)
        assert Counter(map(tuple, got.collect())) == brute(rows, ["hot hot hot w3"], percent)


def test_kth_key_is_that_of_a_sort(spark):
    rnd = random.Random(5)
    rows = [(rnd.choice([None, rnd.randint(0, 40)]), rnd.randint(0, 3), rnd.randint(-9, 9)) for _ in range(700)]
    table = saved(spark.createDataFrame(rows, "doc_id long, n_features long, score long").repartition(6), "keys")
    keys = sorted((-s, d is None, d or 0, f) for d, f, s in rows)
    for k in (1, 2, 350, 699, 700):
        for pivots in (1, 15):
            assert resample.kth_key(table, k, seed=k, pivots=pivots) == (keys[k - 1], keys.index(keys[k - 1]))
