"""Embedding near-duplicates by sorted projection passes (operator 8).

Each pass draws ``BITS`` random hyperplanes through the mean of the unit vectors (embeddings of
texts often share a direction; planes through the origin would leave them on one side) and
orders the vectors lexicographically by the sides they lie on, read as one number.  Similar
vectors share long prefixes, so each vector is compared with the ``window`` that follow it in
the order; pairs with a cosine of at least ``min_cosine`` (double precision) are united across
all passes.

Passes and window are measured, not given (``plan_passes``), and on all vectors: in ``ROUNDS``
sorted orders of all keys the sizes of the groups that share a prefix with a vector tell how
many bits separate it from all but ``window`` others, and its distance from the mean of all tells
with which probability a partner at the threshold shares a bit.  The number of passes is such that
the mean probability, over all vectors, that a lone pair at the threshold is never within a window
is at most ``MISS``; of all windows the one is taken that makes the passes cheapest in all.
Orders are range shuffles of narrow rows; groups that reach over the ends of ranges are counted
from the prefixes of each range's first and last key.

Within a component links are counted exactly, beyond the windows: members closer to the
component's first vector than half the threshold angle are linked to each other for sure
and are counted without a comparison; only the others are compared, in tiles, with all (for
a long chain of vectors that are not close to its first, that is all pairs of the chain).

Scale: equal vectors are one row with a weight before the first pass; a pass is a range
shuffle, with the last rows of a range compared to the first of the next in a second step;
a task hands on a star per block it compares, not its pairs.

Defined cases: vectors that are null, empty, zero or hold null or non-finite components
link with nothing: 0 links, their own component, kept; a null vec_id makes a vector take no
part, with a null component, kept; vectors are compared with those of their own length;
rows that share a vec_id are one node, so their links join; extra columns are ignored; an
empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import components, matrix, mix64, runs, saved, shuffle_partitions, star, usable

BITS = 60
MISS = 0.001
#: Sorted orders whose prefix groups are counted, and directions in which partners are supposed.
ROUNDS, DIRECTIONS = 8, 256
#: Vectors that ``measure`` measures against the part of a table that it is given.
MEASURED = 500
WINDOWS = tuple(32 << k for k in range(8))
#: Numbers of passes that are tried at once, at most; no more passes are made.
TRIES, MOST_PASSES = 32, 1 << 20
#: What handing a vector to a pass costs, in comparisons.
PASS_COST = 500
TILE, LEAST_TILE = 2048, 128
STRIP = 1024
#: First vectors of components, in bytes, that are sent to all tasks.
BROADCAST_BYTES = 8 << 20
_COUNTED = "dim int, round int, part int, id long, same double, head int, tail int, bits array<int>, first boolean, depth int, prefix long, n long"
_COUNTED_ARROW = pa.schema([("dim", pa.int32()), ("round", pa.int32()), ("part", pa.int32()), ("id", pa.int64()), ("same", pa.float64()), ("head", pa.int32()),
                            ("tail", pa.int32()), ("bits", pa.list_(pa.int32())), ("first", pa.bool_()), ("depth", pa.int32()), ("prefix", pa.int64()), ("n", pa.int64())])
_LINK = "edge int, tail boolean, dim int, pass int, key long, id long, v array<double>, a long, b long"
_LINK_ARROW = pa.schema([("edge", pa.int32()), ("tail", pa.bool_()), ("dim", pa.int32()), ("pass", pa.int32()), ("key", pa.int64()),
                         ("id", pa.int64()), ("v", pa.list_(pa.float64())), ("a", pa.int64()), ("b", pa.int64())])


def planes(dim: int, number: int, seed: int) -> np.ndarray:
    return np.random.default_rng([seed, number, dim]).standard_normal((dim, BITS))


@dataclass
class Plan:
    """Mean of the unit vectors, window and number of passes for the vectors of one length."""

    mean: np.ndarray
    window: int
    passes: int


def together(u: np.ndarray, turn: np.ndarray, mean: np.ndarray, min_cosine: float, seed: int) -> np.ndarray:
    """The chance that a plane through the mean has a unit vector and a partner at the threshold, in a
    direction chosen by ``turn``, on one side."""
    side = np.random.default_rng([seed, 1, u.shape[1]]).standard_normal((DIRECTIONS, u.shape[1]))[(mix64(turn) % DIRECTIONS).astype(int)]
    side = unit(side - np.einsum("ij,ij->i", side, u)[:, None] * u + 1e-300)
    centred, partner = u - mean, min_cosine * u + np.sqrt(max(1 - min_cosine ** 2, 0)) * side - mean
    norms = np.linalg.norm(centred, axis=1) * np.linalg.norm(partner, axis=1)
    cos = np.einsum("ij,ij->i", centred, partner) / np.maximum(norms, 1e-300)
    return 1 - np.arccos(np.clip(cos, -1, 1)) / np.pi


def missed(found: np.ndarray, tries: np.ndarray) -> np.ndarray:
    """For each vector, window and number of passes in ``tries`` (windows x numbers), the chance that a partner is
    never within the window; ``found`` (windows x vectors) is the chance that it is in one pass."""
    # vectors that no window separates from their group lie in a crowd at the threshold itself
    with np.errstate(divide="ignore"):
        return np.exp(np.log1p(-np.clip(found, 1e-4, 1)).T[:, :, None] * tries)


def fewest(means: dict[int, np.ndarray], rate: Callable[[dict[int, np.ndarray]], dict[int, np.ndarray]], miss: float,
           windows: tuple[int, ...]) -> dict[int, Plan]:
    """The cheapest plan for each length; ``rate`` gives the mean chances of a miss (windows x numbers) for numbers of passes."""
    cost, hi, lo = PASS_COST + np.array(windows), {}, {}
    tries = {dim: np.tile(1 << np.arange(MOST_PASSES.bit_length()), (len(windows), 1)) for dim in means}
    while tries:
        for dim, rates in rate(tries).items():
            t, enough = tries[dim], rates <= miss
            enough[:, -1] = True
            at, row = enough.argmax(axis=1), np.arange(len(windows))
            lo[dim] = np.where(at > 0, t[row, at - 1], lo.get(dim, 0))
            hi[dim] = t[row, at]
        tries = {}
        for dim in means:
            # a window that cannot be the cheapest any more need not be known better
            span = np.where(lo[dim] * cost >= (hi[dim] * cost).min(), 0, hi[dim] - lo[dim])
            if (span > 1).any():
                step = -(-span[:, None] * np.arange(1, TRIES + 1) // TRIES)
                tries[dim] = np.where(span[:, None] > 1, lo[dim][:, None] + step, hi[dim][:, None])
                lo[dim] = np.where(span > 1, lo[dim], hi[dim] - 1)
    best = {dim: int((hi[dim] * cost).argmin()) for dim in means}
    return {dim: Plan(mean, windows[best[dim]], int(hi[dim][best[dim]])) for dim, mean in means.items()}


def measure(sample: np.ndarray, n: int, min_cosine: float, miss: float = MISS, windows: tuple[int, ...] = WINDOWS, seed: int = 0) -> Plan:
    """The plan to expect for a table of ``n`` vectors of which only ``sample`` are at hand (``plan_passes`` counts a whole table)."""
    u = unit(sample)
    mean, some = u.mean(axis=0), min(len(u), MEASURED)
    if n <= windows[0] or min_cosine >= 1 or len(u) < 2:
        return Plan(mean, windows[0], 1)
    same = together(u[:some], np.arange(some), mean, min_cosine, seed)
    # bits after which a vector's group is no larger than a window, in some passes
    found = np.zeros((len(windows), some))
    for r in range(ROUNDS):
        keys = np.sort(project(u, mean, planes(u.shape[1], r, seed + 1)))
        own = project(u[:some], mean, planes(u.shape[1], r, seed + 1))
        bits, size = np.full((len(windows), some), np.inf), np.full(some, float(n))
        for k in range(BITS + 1):
            low = own >> (BITS - k) << (BITS - k)
            group = (np.searchsorted(keys, low + (1 << (BITS - k)) - 1, side="right") - np.searchsorted(keys, low)) * n / len(u)
            # a group that the sample cannot see any more halves with every bit
            size = np.where(group > 1.5 * n / len(u), group, np.minimum(size / 2, group)) if k else size
            for w, window in enumerate(windows):
                bits[w] = np.where((size <= window) & np.isinf(bits[w]), k, bits[w])
        found += np.where(np.isinf(bits), 0, same ** np.where(np.isinf(bits), 0, bits)) / ROUNDS
    return fewest({0: mean}, lambda tries: {0: missed(found, tries[0]).mean(axis=0)}, miss, windows)[0]


def unit(v: np.ndarray) -> np.ndarray:
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def project(u: np.ndarray, mean: np.ndarray, normals: np.ndarray) -> np.ndarray:
    """The sides of unit vectors as numbers of ``BITS`` bits."""
    return (u @ normals > mean @ normals).astype(np.int64) @ (1 << np.arange(BITS - 1, -1, -1, dtype=np.int64))


def window_links(v: np.ndarray, window: int, min_cosine: float, new_from: int = 0, strip: int = STRIP) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Strips ``(lo, hi, a, b)`` of rows and their linked pairs (lo + a, lo + b), b - a up to ``window``
    and lo + b >= new_from."""
    u = unit(v)
    for lo in range(0, len(u) - 1, strip):
        mid, hi = min(lo + strip, len(u)), min(lo + strip + window, len(u))
        if hi <= new_from:
            continue
        a, b = np.nonzero(u[lo:mid] @ u[lo:hi].T >= min_cosine)
        keep = (b > a) & (b - a <= window) & (b + lo >= new_from)
        if keep.any():
            yield lo, hi, a[keep], b[keep]


def _star_rows(ids: np.ndarray, a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    label = star(len(ids), a, b)
    i = np.nonzero(label != np.arange(len(ids)))[0]
    nil = [pa.nulls(len(i), f.type) for f in list(_LINK_ARROW)[:7]]
    return pa.RecordBatch.from_arrays([*nil, pa.array(ids[i]), pa.array(ids[label[i]])], schema=_LINK_ARROW)


def _further(sizes: list, tail, plans: dict[int, Plan]) -> list[int]:
    """Edges beyond its own for which a range's last rows come within the window: those behind
    ranges that hold fewer rows of the same order, from end to end."""
    rows = {(r["edge"], r["tail"], r["dim"], r["pass"]): r["count"] for r in sizes}
    dim, number = tail["dim"], tail["pass"]
    out, at, between = [], tail["edge"], 0
    while True:  # range ``at`` lies behind edge ``at`` and before edge ``at + 1``
        between += rows.get((at, False, dim, number), 0)
        if between >= plans[dim].window or (at + 1, True, dim, number) not in rows or (at, False, dim, number) not in rows:
            return out
        at += 1
        out.append(at)


def linked(reps: DataFrame, min_cosine: float, plans: dict[int, Plan], seed: int) -> DataFrame:
    """Edges ``(a, b)`` found by the sorted passes among the vectors ``(id, dim, v)``."""
    shared = reps.sparkSession.sparkContext.broadcast(plans)  # a mean for each length

    def keyed_passes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (dim,), t in runs(batches, 1):
            plan = shared.value[dim]
            for lo in range(0, t.num_rows, 2048):
                part = t.slice(lo, 2048).combine_chunks()
                u, n = unit(matrix(part.column("v"))), part.num_rows
                for p in range(plan.passes):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(n, dim, np.int32)), pa.array(np.full(n, p, np.int32)), pa.array(project(u, plan.mean, planes(dim, p, seed))),
                         part.column("id").chunk(0), part.column("v").chunk(0)], names=["dim", "pass", "key", "id", "v"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        me, last, window = TaskContext.get().partitionId(), None, 0

        def ends(t: pa.Table, edge: int, tail: bool) -> pa.RecordBatch:
            t, n = t.combine_chunks(), t.num_rows
            cols = [c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in t.columns]
            return pa.RecordBatch.from_arrays([pa.array(np.full(n, edge, np.int32)), pa.array(np.full(n, tail)), *cols, pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64())],
                                              schema=_LINK_ARROW)

        for (dim, _), t in runs(batches, 2):
            window = shared.value[dim].window
            if last is None:  # the first order that this range continues
                yield ends(t.slice(0, window), me, False)
            ids, v = t.column("id").to_numpy(), matrix(t.column("v"))
            for lo, hi, a, b in window_links(v, window, min_cosine):
                yield _star_rows(ids[lo:hi], a, b)
            last = t
        if last is not None:
            yield ends(last.slice(max(0, last.num_rows - window)), me + 1, True)

    def across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (_, dim, _), t in runs(batches, 3):
            ids = t.column("id").to_numpy()
            for lo, hi, a, b in window_links(matrix(t.column("v")), shared.value[dim].window, min_cosine):
                yield _star_rows(ids[lo:hi], a, b)

    n = shuffle_partitions(reps)
    keyed = reps.select("dim", "id", "v").sortWithinPartitions("dim").mapInArrow(
        keyed_passes, "dim int, pass int, key long, id long, v array<double>")
    order = ["dim", "pass", "key", "id"]
    found = keyed.repartitionByRange(n, *order).sortWithinPartitions(*order).mapInArrow(compare, _LINK)
    found = saved(found, "sorted-passes")
    edge = found.where(F.col("edge").isNotNull())
    sizes = edge.groupBy("edge", "tail", "dim", "pass").count().collect()  # two rows a range
    further = [(r["edge"], r["dim"], r["pass"], to) for r in sizes if r["tail"] for to in _further(sizes, r, plans)]
    if further:
        tails = reps.sparkSession.createDataFrame(further, "edge int, dim int, pass int, to int")
        again = edge.where("tail").join(F.broadcast(tails), ["edge", "dim", "pass"]).withColumn("edge", F.col("to"))
        edge = edge.unionByName(again.drop("to"))
    edge = edge.repartition(n, "edge", "dim", "pass")
    more = edge.select("edge", "dim", "pass", "key", "id", "v").sortWithinPartitions("edge", *order[:2], "key", "id").mapInArrow(across, _LINK)
    return found.where(F.col("edge").isNull()).select("a", "b").unionByName(more.select("a", "b")).distinct()


def count_links(members: DataFrame, min_cosine: float, tile: int = TILE) -> DataFrame:
    """``(id, links)``: the weight linked to each member of ``(label, id, weight, dim, v)``, its own
    other copies included."""
    angle = float(np.arccos(min_cosine)) / 2 - 1e-9
    lead = members.where("id = label").select("label", F.col("v").alias("lead"))
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p * q), F.lit(0.0), lambda s, z: s + z)
    cos = dot("v", "lead") / F.sqrt(dot("v", "v") * dot("lead", "lead"))
    size = lead.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("lead")).alias("dim")).first()
    few = size["n"] * ((size["dim"] or 0) + 4) * 8 <= BROADCAST_BYTES
    rows = members.join(F.broadcast(lead) if few else lead, "label").withColumn("core", (F.acos(F.least(cos, F.lit(1.0))) <= angle) | (F.col("id") == F.col("label"))).drop("lead")
    rows = saved(rows, "members")
    sizes = rows.groupBy("label").agg(F.sum(F.when(F.col("core"), F.col("weight")).otherwise(0)).alias("core_weight"),
                                      F.count(F.lit(1)).alias("n"), F.count_if(~F.col("core")).alias("n_out"))
    rows = rows.join(F.broadcast(sizes) if few else sizes, "label")
    sure = rows.select("id", F.when(F.col("core"), F.col("core_weight") - 1).otherwise(F.col("weight") - 1).alias("links"))
    # the members outside the core against all, tile by tile
    far = rows.where("n_out > 0")
    # also a small component is several tiles, so that no task has it alone
    each = F.greatest(F.least(F.col("n") / 8, F.lit(tile)), F.lit(min(LEAST_TILE, tile)))
    lefts, rights = F.ceil(F.col("n_out") / each).cast("int"), F.ceil(F.col("n") / each).cast("int")
    spot = F.xxhash64("id")
    all_of = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    cols = ["id", "weight", "core", "v"]
    left = far.where("NOT core").select("label", F.pmod(spot, lefts).cast("int").alias("l"), all_of(rights).alias("r"), F.lit(0).alias("side"), *cols)
    right = far.select("label", all_of(lefts).alias("l"), F.pmod(spot, rights).cast("int").alias("r"), F.lit(1).alias("side"), *cols)

    def tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, t in runs(batches, 3):
            side = t.column("side").to_numpy()
            cut = int(np.searchsorted(side, 1))
            if not 0 < cut < len(side):
                continue
            ids, weight, core = (t.column(c).to_numpy() for c in ("id", "weight", "core"))
            u = unit(matrix(t.column("v")))
            hit = (u[:cut] @ u[cut:].T >= min_cosine) & (ids[:cut, None] != ids[None, cut:])
            links = np.r_[hit @ weight[cut:], np.where(core[cut:], weight[:cut] @ hit, 0)]
            some = np.nonzero(links)[0]
            yield pa.RecordBatch.from_arrays([pa.array(ids[some]), pa.array(links[some].astype(np.int64))], names=["id", "links"])

    tiled = left.unionByName(right).repartition(shuffle_partitions(members), "label", "l", "r")
    more = tiled.sortWithinPartitions("label", "l", "r", "side").mapInArrow(tiles, "id long, links long")
    return sure.unionByName(more).groupBy("id").agg(F.sum("links").alias("links"))


def by_length(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.Table]]:
    """The rows of each length, ``dim``, in each batch."""
    for b in batches:
        dims = b.column("dim").to_numpy()
        for dim in np.unique(dims).tolist():
            yield dim, pa.Table.from_batches([b]).filter(pa.array(dims == dim))


def sums(rows: DataFrame, of: Callable[[int, pa.Table], np.ndarray]) -> dict[int, np.ndarray]:
    """The sum of ``of(dim, rows)`` over all rows of each length; a task hands on its sums alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got: dict[int, np.ndarray] = {}
        for dim, t in by_length(batches):
            got[dim] = got.get(dim, 0) + of(dim, t)
        for dim, x in got.items():
            yield pa.RecordBatch.from_arrays([pa.array([dim], pa.int32()), pa.array([x], pa.list_(pa.float64()))], names=["dim", "x"])

    out: dict[int, np.ndarray] = {}
    for r in rows.mapInArrow(run, "dim int, x array<double>").collect():  # a row a task and length
        out[r["dim"]] = out.get(r["dim"], 0) + np.array(r["x"])
    return out


def shared_bits(keys: np.ndarray, key: int) -> np.ndarray:
    """The number of leading bits that each key shares with ``key``."""
    return sum(((keys ^ key) >> (BITS - k) == 0).astype(np.int32) for k in range(1, BITS + 1))


def fitting_bits(keys: np.ndarray, after: np.ndarray, windows: tuple[int, ...]) -> np.ndarray:
    """For each sorted key and window the least number of bits above ``after`` whose group of keys is no
    larger than the window; BITS + 1 if there is none."""
    bits = np.full((len(keys), len(windows)), BITS + 1, np.int32)
    for k in range(BITS + 1):
        group = np.cumsum(np.r_[False, (keys[1:] ^ keys[:-1]) >> (BITS - k) != 0])
        size = np.bincount(group)[group]
        for w, window in enumerate(windows):
            bits[(size <= window) & (k > after) & (bits[:, w] > BITS), w] = k
        if (bits <= BITS).all():
            break
    return bits


def found_chances(distinct: DataFrame, means: dict[int, np.ndarray], min_cosine: float, windows: tuple[int, ...], seed: int) -> DataFrame:
    """``dim, id, n, q0, q1, ...``: for every vector the chances that a partner at the threshold is within each
    window in a pass, over ``ROUNDS`` orders of all vectors; ``n`` is 1, or the vectors that share the id."""
    shared = distinct.sparkSession.sparkContext.broadcast(means)

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for dim, t in by_length(batches):
            if dim not in shared.value:
                continue
            mean, u, ids = shared.value[dim], unit(matrix(t.column("v"))), t.column("id").to_numpy()
            same, n = together(u, ids, mean, min_cosine, seed), len(ids)
            for r in range(ROUNDS):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(n, dim, np.int32)), pa.array(np.full(n, r, np.int32)), pa.array(project(u, mean, planes(dim, r, seed + 1))),
                                                  pa.array(ids), pa.array(same)], names=["dim", "round", "key", "id", "same"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        for (dim, number), t in runs(batches, 2):
            keys, n = t.column("key").to_numpy(), t.num_rows
            head, tail = shared_bits(keys, keys[0]), shared_bits(keys, keys[-1])
            # groups of no more bits than these hold the first or last key, and may go on in other ranges
            bits = fitting_bits(keys, np.maximum(head, tail), windows)
            own = [pa.array(np.full(n, x, np.int32)) for x in (dim, number, part)]
            lists = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * len(windows)), pa.array(bits.ravel()))
            cols = [*own, *[t.column(c).combine_chunks() for c in ("id", "same")], pa.array(head), pa.array(tail), lists]
            yield pa.RecordBatch.from_arrays([*cols, *[pa.nulls(n, f.type) for f in list(_COUNTED_ARROW)[8:]]], schema=_COUNTED_ARROW)
            depth = np.arange(BITS + 1)
            for first, key, same in ((True, keys[0], head), (False, keys[-1], tail)):
                # a group of both ends is counted at the first
                rows = np.where(first or (depth > head[-1]), (same[:, None] >= depth).sum(axis=0), 0)
                own = [pa.array(np.full(BITS + 1, x, np.int32)) for x in (dim, number, part)]
                ends = [pa.array(np.full(BITS + 1, first)), pa.array(depth.astype(np.int32)), pa.array(key >> (BITS - depth)), pa.array(rows)]
                yield pa.RecordBatch.from_arrays([*own, *[pa.nulls(BITS + 1, f.type) for f in list(_COUNTED_ARROW)[3:8]], *ends], schema=_COUNTED_ARROW)

    order = ["dim", "round", "key", "id"]
    keys = distinct.select("dim", "id", "v").mapInArrow(keyed, "dim int, round int, key long, id long, same double")
    counted = keys.repartitionByRange(shuffle_partitions(distinct), *order).sortWithinPartitions(*order).mapInArrow(count, _COUNTED)
    counted = saved(counted, "prefix-groups")
    ends = counted.where(F.col("id").isNull()).select("dim", "round", "part", "first", "depth", "prefix", "n")
    ends = ends.join(ends.groupBy("dim", "round", "depth", "prefix").agg(F.sum("n").alias("size")), ["dim", "round", "depth", "prefix"])
    fit = lambda first, window: F.min(F.when((F.col("first") == first) & (F.col("size") <= window), F.col("depth")))
    ends = ends.groupBy("dim", "round", "part").agg(*[fit(first, w).alias(f"{name}{i}") for name, first in (("h", True), ("t", False)) for i, w in enumerate(windows)])
    # one row a range of an order
    rows = counted.where(F.col("id").isNotNull()).join(F.broadcast(ends), ["dim", "round", "part"])

    def chance(i: int) -> Column:
        bits = F.when(F.col(f"h{i}") <= F.col("head"), F.col(f"h{i}")).when(F.col(f"t{i}") <= F.col("tail"), F.col(f"t{i}")).otherwise(F.col("bits")[i])
        return F.avg(F.when(bits <= BITS, F.pow("same", bits)).otherwise(0.0)).alias(f"q{i}")

    return saved(rows.groupBy("dim", "id").agg((F.count(F.lit(1)) / ROUNDS).alias("n"), *[chance(i) for i in range(len(windows))]), "chances")


def plan_passes(distinct: DataFrame, min_cosine: float, seed: int = 0, miss: float = MISS, windows: tuple[int, ...] = WINDOWS) -> dict[int, Plan]:
    """A plan for each length of the vectors ``(dim, id, v)``, from all of them."""
    totals = sums(distinct.select("dim", "v"), lambda _, t: np.r_[unit(matrix(t.column("v"))).sum(axis=0), t.num_rows])
    means = {dim: x[:-1] / x[-1] for dim, x in totals.items()}
    many = {dim: means[dim] for dim, x in totals.items() if x[-1] > windows[0] and min_cosine < 1}
    plans = {dim: Plan(mean, windows[0], 1) for dim, mean in means.items()}
    if not many:
        return plans
    chances = found_chances(distinct, many, min_cosine, windows, seed)
    shape = (len(windows), -1)

    def rate(tries: dict[int, np.ndarray]) -> dict[int, np.ndarray]:
        def of(dim: int, t: pa.Table) -> np.ndarray:
            if dim not in tries:
                return np.zeros(1)
            n = t.column("n").to_numpy()
            found = np.stack([t.column(f"q{i}").to_numpy() for i in range(len(windows))])
            return np.r_[np.tensordot(n, missed(found, tries[dim]), 1).ravel(), n.sum()]

        return {dim: (x[:-1] / x[-1]).reshape(shape) for dim, x in sums(chances, of).items() if dim in tries}

    return plans | fewest(many, rate, miss, windows)


def near_duplicates(vectors: DataFrame, min_cosine: float = 0.95, passes: int | None = None, window: int | None = None,
                    vector_col: str = "embedding", seed: int = 0) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row; ``passes`` and ``window`` are measured if not given."""
    v = F.col(vector_col).cast("array<double>")
    rows = saved(vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.when(F.col("vec_id").isNotNull() & usable(v), v).alias("v")), "vectors")
    distinct = rows.where("v IS NOT NULL").groupBy("v").agg(F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("weight"))
    distinct = saved(distinct.withColumn("dim", F.size("v")), "distinct-vectors")
    plans = {dim: Plan(p.mean, window or p.window, passes or p.passes) for dim, p in plan_passes(distinct, min_cosine, seed).items()}
    label = components(linked(distinct, min_cosine, plans, seed))
    members = distinct.join(label, distinct["id"] == label["node"]).select("label", "id", "weight", "dim", "v")
    links = count_links(members, min_cosine)
    reps = distinct.join(label, distinct["id"] == label["node"], "left").join(links, "id", "left").select(
        F.col("v").alias("of"), F.coalesce("links", F.col("weight") - 1).cast("long").alias("n_links"), F.coalesce("label", "id").alias("component"))
    out = rows.join(reps, F.col("v") == F.col("of"), "left")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      F.coalesce("component", "vec_id").alias("component_id"),
                      F.col("vec_id").eqNullSafe(F.coalesce("component", "vec_id")).alias("kept"))
