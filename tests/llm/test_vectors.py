"""Vector search and embedding dedup against brute force."""

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import brute
from notecohort.llm import ann, embdedup

SCHEMA = "vec_id long, embedding array<float>, label int, id long, v int, side int, dim int, `key` int"


def table(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], None, 1, 2, 3, 4, 5) for i, v in rows], SCHEMA)


def odd_vectors(n=400, d=12):
    rng = np.random.default_rng(1)
    base = rng.standard_normal((n, d)).astype(np.float32)
    for i in range(0, n, 4):  # near copies, at many angles
        base[i + 1] = base[i] + rng.normal(0, 0.05 * (1 + i / 40), d)
    rows = [(i, base[i]) for i in range(n)]
    rows += [(n + i, base[3]) for i in range(60)]  # a group of equal vectors
    rows += [(2 * n + i, base[8] + rng.normal(0, 0.02, d)) for i in range(80)]  # and one of near ones
    rows += [(900, base[3] * 2), (950, base[7])]  # ties
    rows += [(50_000, None), (50_050, []), (50_100, [0.0] * d), (50_150, [None, *base[0][1:]]), (50_200, [float("nan"), *base[0][1:]]),
             (50_250, [float("inf"), *base[0][1:]]), (None, base[0]), (51_000, [1.0, 2.0]), (51_001, [1.0, 2.1])]
    return rows + [rows[50], rows[50]]


def usable(i, v):
    return i is not None and v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(x != 0 for x in v)


def cosine(a, b):
    a, b = np.array(a, np.float32).astype(float), np.array(b, np.float32).astype(float)
    return float(a @ b / (np.sqrt(a @ a) * np.sqrt(b @ b))) if len(a) == len(b) else None


@pytest.mark.parametrize("query_block,candidate_block", [(2048, 16_384), (3, 40)])
def test_nearest_is_exact(spark, query_block, candidate_block):
    rows = odd_vectors()
    got = ann.nearest(table(spark, rows), F.col("vec_id") % 50 == 0, 5, query_block=query_block, candidate_block=candidate_block).collect()
    good = [(k, i, v) for k, (i, v) in enumerate(rows) if usable(i, v)]
    want = []
    for k, i, v in good:
        if i % 50 == 0:
            best = sorted((-round(s, 12), j) for m, j, w in good if m != k and (s := cosine(v, w)) is not None)[:5]
            want += [(i, r + 1, j, -s) for r, (s, j) in enumerate(best)]
    assert Counter((r.query_id, r.rank, r.vec_id, round(r.score, 12)) for r in got) == Counter(want)


def test_nearest_of_few_rows(spark):
    assert ann.nearest(table(spark, []), F.col("vec_id") % 50 == 0).collect() == []
    assert ann.nearest(table(spark, [(0, [1.0, 2.0])]), F.col("vec_id") % 50 == 0).collect() == []
    got = ann.nearest(table(spark, [(0, [1.0, 2.0]), (7, [2.0, 4.0])]), F.col("vec_id") % 50 == 0).collect()
    assert [(r.query_id, r.rank, r.vec_id) for r in got] == [(0, 1, 7)] and abs(got[0].score - 1) < 1e-12


def test_int8_bounds_hold():
    rng = np.random.default_rng(2)
    u = embdedup.unit(rng.standard_normal((300, 64)))
    codes, scale, norm, lost = ann.quantise(u)
    product = (codes.astype(float) @ codes.T) * scale[:, None] * scale
    assert (np.abs(u @ u.T - product) <= lost[:, None] + norm[:, None] * lost + 1e-12).all()


def brute_groups(rows, least=0.95):
    good = [i for i, (d, v) in enumerate(rows) if usable(d, v)]
    pairs = [(a, b) for k, a in enumerate(good) for b in good[k + 1:] if (s := cosine(rows[a][1], rows[b][1])) is not None and s >= least]
    same = {}  # rows with one id are one node
    for a in good:
        same.setdefault(rows[a][0], a)
    comp = brute.components(len(rows), pairs + [(same[rows[a][0]], a) for a in good])
    first = {c: min(rows[a][0] for a in good if comp[a] == c) for c in {comp[a] for a in good}}
    links = Counter(x for p in pairs for x in p)
    return [(d, links[i], first[comp[i]] if i in links or usable(d, rows[i][1]) else d) for i, (d, _) in enumerate(rows)]


def test_near_duplicates_of_odd_vectors(spark):
    rows = odd_vectors()
    got = embdedup.near_duplicates(table(spark, rows)).collect()
    want = brute_groups(rows)
    assert Counter((r.vec_id, r.n_links, r.component_id) for r in got) == Counter(want)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)
    assert embdedup.near_duplicates(table(spark, [])).collect() == []


def test_links_outside_the_core_are_counted_in_tiles(spark):
    # a fan of vectors within one plane: the first vector's core does not hold them all
    angles = np.deg2rad(np.arange(60) * 1.5)
    v = np.stack([np.cos(angles), np.sin(angles)], axis=1)
    members = spark.createDataFrame([(0, i, 1 + i % 3, 2, x.tolist()) for i, x in enumerate(v)], "label long, id long, weight long, dim int, v array<double>")
    got = {r.id: r.links for r in embdedup.count_links(members, 0.95, tile=7).collect()}
    hit = v @ v.T >= 0.95
    weight = 1 + np.arange(60) % 3
    assert got == {i: int(hit[i] @ weight) - 1 for i in range(60)}


def test_recall_on_the_given_vectors(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").collect()]
    rng = np.random.default_rng(4)
    rows += [(10_000 + i, np.array(v) + rng.normal(0, 0.015, len(v))) for i, v in rows]
    got = {r.vec_id: (r.n_links, r.component_id) for r in embdedup.near_duplicates(table(spark, rows)).collect()}
    want = brute_groups(rows)
    assert sum(x[0] for x in got.values()) >= 0.99 * sum(n for _, n, _ in want) > 0
    assert sum(got[d] == (n, c) for d, n, c in want) >= 0.99 * len(want)


def planted(n, mean_cosine, pairs, seed=8, dim=64):
    """``n`` vectors around a shared direction; vector ``pairs + i`` is a partner of vector i just above the threshold."""
    rng = np.random.default_rng(seed)
    shared = np.eye(dim)[0]
    v = embdedup.unit(np.sqrt(mean_cosine) * shared + np.sqrt(1 - mean_cosine) * rng.standard_normal((n, dim)) / np.sqrt(dim))
    other = rng.standard_normal((pairs, dim))
    other = embdedup.unit(other - np.einsum("ij,ij->i", other, v[:pairs])[:, None] * v[:pairs])
    cos = rng.uniform(0.9505, 0.953, pairs)[:, None]
    v[pairs:2 * pairs] = cos * v[:pairs] + np.sqrt(1 - cos**2) * other
    return v


@pytest.mark.parametrize("mean_cosine", [0.0, 0.5, 0.7, 0.85])
def test_recall_of_planted_pairs_holds_as_the_table_grows(mean_cosine):
    """Measured passes and windows over whole orders, at two sizes."""
    for n in (10_000, 60_000):
        v, pairs = planted(n, mean_cosine, 1_000), 1_000
        plan = embdedup.measure(v[np.random.default_rng(1).permutation(n)[:8_000]], n, 0.95)
        hit = np.zeros(pairs, bool)
        for p in range(plan.passes):
            place = np.empty(n, int)
            place[np.argsort(embdedup.project(v, plan.mean, embdedup.planes(64, p, 0)), kind="stable")] = np.arange(n)
            hit |= abs(place[:pairs] - place[pairs:2 * pairs]) <= plan.window
        assert hit.mean() >= 0.99, (n, plan.window, plan.passes)


@pytest.mark.parametrize("n, mean_cosine", [(3_000, 0.85), (12_000, 0.7), (12_000, 0.0)])
def test_planted_pairs_are_united(spark, n, mean_cosine):
    v, pairs = planted(n, mean_cosine, 500), 500
    got = {r.vec_id: r.component_id for r in embdedup.near_duplicates(table(spark, enumerate(v))).collect()}
    assert np.mean([got[i] == got[pairs + i] for i in range(pairs)]) >= 0.99


def test_windows_reach_over_several_ranges(spark):
    """One pass whose window holds the whole table, dealt over more ranges than it has windows: nothing is lost."""
    rng = np.random.default_rng(6)
    v = rng.standard_normal((300, 4))
    rows = [(i, x) for i, x in enumerate(v)]
    want = {i: (n, c) for i, n, c in brute_groups(rows)}
    for passes, window in ((1, 300), (40, 20)):
        got = {r.vec_id: (r.n_links, r.component_id) for r in embdedup.near_duplicates(table(spark, rows).repartition(3), passes=passes, window=window).collect()}
        assert {i: (n, c) for i, (n, c) in want.items()} == got


def test_passes_follow_what_is_measured():
    rng = np.random.default_rng(2)
    even = rng.standard_normal((4_000, 64))
    plans = [embdedup.measure(even, n, 0.95) for n in (10**4, 10**6, 10**8)]
    assert plans[0].passes < plans[1].passes < plans[2].passes
    assert embdedup.measure(even[:20], 20, 0.95).passes == 1  # one window holds all
    assert embdedup.measure(even, 10**6, 1.0).passes == 1  # equal directions have equal keys
    skewed = embdedup.measure(even + 12 * np.eye(64)[0], 10**6, 0.95)
    assert skewed.passes * skewed.window > plans[1].passes * plans[1].window


def test_window_links_are_all_close_pairs():
    v = planted(700, 0.8, 200, dim=8)
    cos = embdedup.unit(v) @ embdedup.unit(v).T
    for window, new_from, strip in ((5, 0, 64), (100, 0, 64), (40, 300, 7), (1000, 0, 1000), (3, 699, 10)):
        got = {(lo + i, lo + j) for lo, _, a, b in embdedup.window_links(v, window, 0.95, new_from, strip) for i, j in zip(a.tolist(), b.tolist())}
        assert got == {(i, j) for i in range(700) for j in range(i + 1, min(i + window, 699) + 1) if cos[i, j] >= 0.95 and j >= new_from}


def test_plans_come_from_all_vectors(spark):
    """Mean, group sizes and chances of every vector, counted over the ends of ranges, against counting prefix by prefix."""
    rng = np.random.default_rng(5)
    crowd = embdedup.unit(np.eye(8)[0] + rng.normal(0, 0.02, (700, 8)))  # some fit no narrow window
    v = {16: planted(2_000, 0.6, 50, dim=16), 8: np.concatenate([rng.standard_normal((500, 8)), crowd]), 3: rng.standard_normal((20, 3))}
    rows = [(dim, 10_000 * dim + i, x.tolist()) for dim, of_dim in v.items() for i, x in enumerate(of_dim)]
    got = embdedup.plan_passes(spark.createDataFrame(rows, "dim int, id long, v array<double>").repartition(5), 0.95)
    assert set(got) == {16, 8, 3} and (got[3].window, got[3].passes) == (32, 1)
    for dim in (16, 8):
        u, found = embdedup.unit(v[dim]), np.zeros((len(embdedup.WINDOWS), len(v[dim])))
        same = embdedup.together(u, 10_000 * dim + np.arange(len(u)), u.mean(axis=0), 0.95, 0)
        for r in range(embdedup.ROUNDS):
            keys = embdedup.project(u, u.mean(axis=0), embdedup.planes(dim, r, 1)).tolist()
            sizes = [Counter(k >> (embdedup.BITS - bits) for k in keys) for bits in range(embdedup.BITS + 1)]
            for w, window in enumerate(embdedup.WINDOWS):
                bits = [next((b for b in range(embdedup.BITS + 1) if sizes[b][k >> (embdedup.BITS - b)] <= window), None) for k in keys]
                found[w] += [0 if b is None else same[i] ** b / embdedup.ROUNDS for i, b in enumerate(bits)]
        found, plans = np.maximum(found, 1e-4), []
        for window, q in zip(embdedup.WINDOWS, found):
            passes = next((m for m in range(1, 3_000) if np.mean((1 - q) ** m) <= embdedup.MISS), 3_000)
            plans.append((passes * (embdedup.PASS_COST + window), window, passes))
        assert (got[dim].window, got[dim].passes) == min(plans)[1:]
        assert np.allclose(got[dim].mean, u.mean(axis=0), atol=1e-12)
