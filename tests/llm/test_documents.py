"""Sharding, BPE, token files, SimHash, mixing and line dedup against brute force."""

import hashlib
import os
import random
import subprocess
import sys
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import brute
from notecohort.llm import bpe, linededup, mixing, sharding, simhash, wavelet

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)
VOCABULARY = bpe.read_vocabulary(PATH)


def ids_of(text):
    return np.array(LIBRARY.encode(text or "", add_special_tokens=False).ids, "<u4")


def given(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


# ---- sharding ------------------------------------------------------------------------------
def check_shards(rows, out, shards):
    want = Counter((d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in rows)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in out) == want
    slots = defaultdict(list)
    for r in out:
        slots[r.shard].append(r.slot)
        assert r.law == "rows" and r.grown_shard is None
    counts = [len(slots[s]) for s in range(shards)]
    assert max(counts) - min(counts) <= 1 and set(slots) <= set(range(shards))
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())


def test_shards_of_odd_rows(odd, none):
    check_shards(given(odd), sharding.bounded_ring(odd, 4).collect(), 4)
    assert sharding.bounded_ring(none, 4).collect() == []


def test_shards_with_a_hot_key_and_few_moves(spark):
    docs = spark.range(2000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("doc_id"), F.lit("t").alias("text"))
    check_shards(given(docs), sharding.bounded_ring(docs, 16).collect(), 16)
    # only overflowing rows leave the place that the plain ring gives them
    docs = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"))
    out = sharding.bounded_ring(docs, 8).collect()
    points, owner = sharding.ring(8, 128)
    at = docs.select("doc_id", F.xxhash64("doc_id", F.lit(False)).alias("at")).collect()
    home = {r.doc_id: owner[np.searchsorted(points, r["at"]) % len(points)] for r in at}
    assert sum(home[r.doc_id] == r.shard for r in out) > 0.85 * len(out)


def test_fill_walks_clockwise():
    plan = sharding.fill(np.array([5, 0, 1]), np.array([0, 1, 0]), 2)
    assert sorted(plan) == [(0, 0, 3, 0, 0), (0, 3, 5, 1, 0), (2, 5, 6, 1, 2)]


# ---- BPE -----------------------------------------------------------------------------------
def test_tree_concatenation_equals_the_library():
    rnd, codec = random.Random(5), bpe.Codec(VOCABULARY)
    parts = ["the", "ing", "aaaa", "e", "́", "!", "'s", "'", "é", "ß", "İ", "日本", "1", "22", "<|endoftext|>", "<|startoftext|>",
             "<|", "|>", " ", "\x1c", "zz", "가", "ᄀ", "ᅡ", "ᆨ", "̣", "̂", "\n", "\x85", " ", "º", "²"]
    for _ in range(500):
        pick = parts if rnd.random() < 0.5 else [p for p in parts if not p.isspace()]
        text = "".join(rnd.choice(pick) for _ in range(rnd.randrange(1, 300)))
        if rnd.random() < 0.2:
            text = rnd.choice("abc'!") * rnd.randrange(1, 2000)
        n = rnd.choice([1, 3, 7, 50])
        node = bpe.tree(codec, [bpe.leaf(codec, text[i:i + n]) for i in range(0, len(text), n)])
        assert np.array_equal(node.ids, ids_of(text)), text
        found, at = codec.encode(pa.array([text, "", text[::-1]]))
        assert np.array_equal(found[at[0]:at[1]], ids_of(text)) and at[1] == at[2]
        assert np.array_equal(found[at[2]:], ids_of(text[::-1]))


@pytest.mark.parametrize("leaf", [16_384, 50])
def test_encode_and_decode_odd_rows(odd, none, leaf):
    out = bpe.decode(bpe.encode(odd, VOCABULARY, leaf), VOCABULARY).collect()
    got = Counter((r.doc_id, r.n_tokens, bytes(r.ids), r.decoded) for r in out)
    want = Counter((d, len(i := ids_of(t)), i.tobytes(), LIBRARY.decode(i.tolist(), skip_special_tokens=False)) for d, t in given(odd))
    assert got == want
    both = bpe.encode(odd, VOCABULARY, leaf, decoded=True).collect()
    assert Counter((r.doc_id, r.n_tokens, bytes(r.ids), r.decoded) for r in both) == want
    assert bpe.decode(bpe.encode(none, VOCABULARY), VOCABULARY).collect() == []


# ---- token files ---------------------------------------------------------------------------
@pytest.mark.parametrize("shard_tokens", [1, 1000, 1 << 21])
def test_token_files_round_trip(odd, none, shard_tokens):
    files = wavelet.write_shards(odd, VOCABULARY, shard_tokens)
    out = sorted(wavelet.read_shards(files).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in out] == sorted((d for d, _ in given(odd)), key=lambda d: (d is not None, d or 0))
    assert [r.start for r in out] == [sum(x.n_tokens for x in out[:i]) for i in range(len(out))]
    want = Counter((d, np.r_[ids_of(t), 2].astype("<u4").tobytes()) for d, t in given(odd))
    assert Counter((r.doc_id, bytes(r.ids)) for r in out) == want and all(4 * r.n_tokens == len(r.ids) for r in out)
    assert wavelet.read_shards(wavelet.write_shards(none, VOCABULARY)).collect() == []


def test_wavelet_matrix_answers():
    rng = np.random.default_rng(0)
    for top, n in ((5, 1), (49_408, 3000), (2, 100), (1 << 20, 777), (1, 64)):
        ids = rng.integers(0, top, n).astype(np.uint32)
        ids[rng.random(n) < 0.3] = ids[0]
        docs, lengths, m = wavelet.from_file(wavelet.to_file([1, None], [n // 2, n - n // 2], ids))
        assert docs == [1, None] and lengths.tolist() == [n // 2, n - n // 2] and np.array_equal(m.read(), ids)
        assert [m.access(int(i)) for i in range(0, n, 37)] == ids[::37].tolist()
        for value in [*ids[:5].tolist(), top + 5]:
            lo, hi = sorted(rng.integers(0, n + 1, 2).tolist())
            assert m.count(value, lo, hi) == (ids[lo:hi] == value).sum()
            places = np.nonzero(ids == value)[0]
            assert [m.locate(value, k) for k in range(0, len(places), 9)] == places[::9].tolist()
        with pytest.raises(IndexError):
            m.locate(top + 5, 0)
    with pytest.raises(ValueError):
        wavelet.from_file(b"none of this")


# ---- SimHash -------------------------------------------------------------------------------
def test_simhash_of_odd_rows(odd, none):
    rows = given(odd)
    want = Counter((d, f"{brute.fingerprint(t):016x}", c) for (d, t), c in zip(rows, brute.groups(rows), strict=True))
    assert Counter(map(tuple, simhash.simhash_groups(odd).collect())) == want
    assert simhash.simhash_groups(none).collect() == [] and simhash.keep_one(none).collect() == []


def test_an_id_that_repeats_with_another_text_keeps_its_group(spark):
    a, b = (" ".join(f"{c}{i}" for i in range(60)) for c in ("left", "right"))
    rows = [(1, a, 7), (5, a, 7), (5, b, 7), (5, b, 7), (9, b, 7), (None, b, 7), (6, None, 7), (None, None, 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, goes int")
    want = [(1, a, 7), (5, b, 7), (5, b, 7), (None, b, 7), (6, None, 7), (None, None, 7)]
    assert Counter(map(tuple, simhash.keep_one(docs).collect())) == Counter(want)


def test_keep_one_keeps_one(odd):
    rows = given(odd)
    want = Counter(d for (d, _), c in zip(rows, brute.groups(rows), strict=True) if d is None or d == c)
    kept = simhash.keep_one(odd)
    assert kept.columns == odd.columns and Counter(r.doc_id for r in kept.collect()) == want


def test_pivots_lose_no_link(spark):
    # one bucket of more than a tile (26 common bits), chains, and strangers
    rng = np.random.default_rng(3)
    hot = (np.uint64(0x2ABCDEF) << np.uint64(38) | rng.integers(0, 1 << 38, simhash.TILE + 900, dtype=np.uint64))
    for i in range(0, 600, 2):
        hot[i + 1] = hot[i] ^ np.uint64(sum({1 << int(b) for b in rng.integers(0, 38, 3)}))
    far = rng.integers(0, 1 << 64, 3000, dtype=np.uint64)
    for i in range(0, 1500):
        far[i + 1500] = far[i] ^ np.uint64(sum({1 << int(b) for b in rng.integers(0, 64, int(rng.integers(1, 6)))}))
    fps = np.unique(np.r_[hot, far])
    reps = spark.createDataFrame([(int(x),) for x in fps.view(np.int64)], "fp long")
    edges = simhash.near_pairs(reps, 3).collect()
    at = {int(x): i for i, x in enumerate(fps.view(np.int64))}
    got = brute.components(len(fps), [(at[r.a], at[r.b]) for r in edges])
    pairs = brute.near(fps)
    assert got == brute.components(len(fps), pairs) and len(pairs) > 1000


# ---- mixing --------------------------------------------------------------------------------
def test_mix_of_odd_rows(odd, none):
    rows = [(r.doc_id, r.text, r.source) for r in odd.collect()]
    n, size, total, want = brute.copies(rows)
    out = mixing.mix(odd).collect()
    assert Counter((r.doc_id, r.size, r.source, r.source_size, r.copies) for r in out) == Counter(
        (d, z, s, total[s], k) for (d, _, s), z, k in zip(rows, size, n, strict=True))
    assert all(abs(r.target - want[r.source]) < 1e-6 and r.taken == r.copies * r.size for r in out)
    assert Counter(map(tuple, mixing.mix(odd).collect())) == Counter(map(tuple, out))  # reruns agree
    taken = mixing.take(odd)
    assert taken.columns == odd.columns
    assert Counter(r.doc_id for r in taken.collect()) == Counter(d for (d, _, _), k in zip(rows, n, strict=True) for _ in range(k))
    assert mixing.mix(none).collect() == [] and mixing.take(none).collect() == []


def test_mix_comes_near_its_targets(spark):
    docs = spark.range(5000).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 7)).alias("source"),
        F.repeat(F.lit("w "), (F.col("id") * 7919 % 200).cast("int")).alias("text"))
    got = mixing.mix(docs).groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target"), F.max("copies").alias("most")).collect()
    assert all(abs(r.taken - r.target) <= 600 and r.most <= 3 for r in got) and abs(sum(r.taken - r.target for r in got)) < 2000
    sizes = {r.source: r.n for r in docs.groupBy("source").agg(F.sum(mixing.word_count(F.col("text"))).alias("n")).collect()}
    want = brute.targets(sizes)
    assert all(abs(r.target - want[r.source]) < 1e-6 for r in got)


# ---- line dedup ----------------------------------------------------------------------------
@pytest.mark.parametrize("bits", [1 << 29, 1 << 13])
def test_lines_of_odd_rows(odd, none, bits):
    rows = given(odd)
    want = Counter((d, *x) for (d, _), x in zip(rows, brute.dedup_lines(rows), strict=True))
    assert Counter(map(tuple, linededup.repeated_lines(odd, max_filter_bits=bits).collect())) == want
    assert linededup.repeated_lines(none).collect() == []


def test_lines_over_many_tasks_and_full_filters(spark):
    docs = spark.range(0, 3000, 1, 7).select(F.col("id").alias("doc_id"), F.concat_ws(
        "\n", F.concat(F.lit("a common line number "), F.col("id") % 40), F.concat(F.lit("an own line of document "), F.col("id")),
        F.when(F.col("id") % 1000 < 2, F.concat(F.lit("a line shared by a few: "), F.col("id") % 1000))).alias("text"))
    rows = given(docs)
    want = Counter((d, *x) for (d, _), x in zip(rows, brute.dedup_lines(rows), strict=True))
    for bits in (1 << 13, 1 << 29):  # the small filter takes nearly every line for a repeat
        assert Counter(map(tuple, linededup.repeated_lines(docs, max_filter_bits=bits).collect())) == want


def test_drop_repeated_lines_keeps_columns(odd, none):
    out = linededup.drop_repeated_lines(odd)
    assert out.columns == odd.columns
    rows = given(odd)
    want = Counter((d, None if t is None else x[2], len(x[2])) for (d, t), x in zip(rows, brute.dedup_lines(rows), strict=True))
    assert Counter((r.doc_id, r.text, r.n_chars) for r in out.collect()) == want
    assert linededup.drop_repeated_lines(none).collect() == []


def test_digest_columns_of_the_queries(spark):
    from notecohort.llm import queries

    sf = "/root/testdata/sf0.001"
    rows = given(spark.read.parquet(f"{sf}/documents.parquet"))
    out = {r.doc_id: r for r in queries.op2_tree_bpe(spark, sf).collect()}
    for d, t in rows:
        i = ids_of(t)
        text = LIBRARY.decode(i.tolist(), skip_special_tokens=False)
        assert tuple(out[d]) == (d, len(i), hashlib.sha256(i.tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())
    out = {r.doc_id: r for r in queries.op3_wavelet_tokens(spark, sf).collect()}
    start = 0
    for d, t in sorted(rows):
        i = np.r_[ids_of(t), 2].astype("<u4")
        assert tuple(out[d]) == (d, start, len(i), zlib.crc32(i.tobytes()))
        start += len(i)


def test_time_grows_with_a_texts_repeated_lines(spark):
    """Three equal documents of n lines each: four times the lines take about four times the time."""
    def seconds(n):
        text = "\n".join(f"line number {i} of a long text" for i in range(n))
        docs = spark.createDataFrame([(i, text) for i in range(3)], "doc_id long, text string").repartition(3)
        best = 1e9
        for _ in range(2):
            begun = time.perf_counter()
            got = linededup.repeated_lines(docs).select("doc_id", "n_lines", "n_dropped", F.length("kept").alias("n")).collect()
            best = min(best, time.perf_counter() - begun)
            assert {(r.doc_id, r.n_lines, r.n_dropped, r.n) for r in got} == {(0, n, n, 0), (1, n, n, 0), (2, n, 0, len(text))}
        return best

    assert seconds(100_000) < 8 * seconds(25_000)


_MEMORY = """
import random, re
import pyarrow as pa
from notecohort.llm import bpe, queries

def used():
    return sum(map(int, re.findall(r"\\nPss_(?:Anon|Shmem):\\s+(\\d+)", open("/proc/self/smaps_rollup").read()))) / 1024

c, rng = bpe.Codec(queries.vocabulary()), random.Random(1)
before = used()
for _ in range(6):
    texts = pa.array([" ".join(rng.choice("abcdefgh") + "%x" % rng.getrandbits(40) for _ in range(300)) for _ in range(1000)])
    ids = bpe.as_binary(*c.encode(texts))
    decoded = pa.array([c.decode(x.as_py()) for x in ids], pa.string())
del texts, ids, decoded
c.release()
print(used() - before)
"""


@pytest.mark.skipif(not os.path.exists("/proc/self/smaps_rollup"), reason="no memory figures")
def test_a_codec_gives_its_memory_back():
    """Idle workers stand beside the tasks of later stages; caches of long words held some 100 MB."""
    env = os.environ | {"PYTHONPATH": os.pathsep.join(sys.path)}
    got = subprocess.run([sys.executable, "-c", _MEMORY], capture_output=True, text=True, env=env, timeout=120, check=True)
    assert float(got.stdout) < 25
