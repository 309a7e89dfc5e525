"""Mixing sources to target weights by systematic sampling (operator 5).

Sources in code-point order (null last) weigh 5, 2, 1, repeating, and share the total size
by weight; a target stops at ``max_repeat`` times its source's size, and what is over is
shared again by weight among the rest until none is above.  Every document of a source
expects ``target / source_size`` copies.  Within a source the documents are put in order,
their expected copies are prefix-summed from one offset per source, and a document is
emitted once per integer boundary that its own share crosses.  The order is by size, so
the words taken are spread over short and long documents alike and miss the target by
about one document.

Scale: sizes are computed in one scan; the prefix sum is the row's position in a
distributed range index (a hot source is split over many ranges), not a window over a
source; only the table of sources (one row each) is windowed.

Defined cases: a null or empty text has size 0 and is taken with its copies, at no words;
a null source is a source of its own, after all others; repeated rows count each; a null
doc_id is a row like any other; extra columns are ignored; a source or table without words
has target 0 and takes nothing; an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.index import with_row_index
from .common import WORD, saved

WEIGHTS = (5, 2, 1)
MAX_REPEAT = 3


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights=WEIGHTS, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """``source, source_size, n_docs, target`` from ``source, source_size, n_docs``.

    The repeated re-sharing has a closed form: with sources in ascending order of
    cap / weight, the first ones are held at their caps as long as the even share of what
    is left, per unit of weight, is not below their ratio.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    pick = (F.row_number().over(by_name) - 1) % len(weights)
    weighed = sizes.withColumn("w", F.element_at(F.array(*map(F.lit, weights)), (pick + 1).cast("int")))
    ratio = F.col("source_size") * max_repeat / F.col("w")
    order = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    before, whole = order.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    shared = weighed.withColumn("ratio", ratio).select(
        "*", F.sum("source_size").over(whole).alias("total"), F.sum("w").over(whole).alias("w_all"),
        F.coalesce(F.sum("source_size").over(before), F.lit(0)).alias("held"),
        F.coalesce(F.sum("w").over(before), F.lit(0)).alias("w_held"))
    level = (F.col("total") - F.col("held") * max_repeat) / (F.col("w_all") - F.col("w_held"))
    shared = shared.withColumn("level", F.when(F.col("ratio") >= level, level))
    # the first source that is not held sets the level of all that follow
    shared = shared.withColumn("level", F.first("level", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    target = F.coalesce(F.col("level") * F.col("w"), (F.col("source_size") * max_repeat).cast("double"))
    return shared.select("source", "source_size", "n_docs", target.cast("double").alias("target"))


def offset(source: Column, seed: int = 0) -> Column:
    """The one random offset of a source, in [0, 1): fixed by its name and the seed."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.concat(F.lit("="), source), F.lit("")))
    return F.conv(F.substring(F.md5(name), 1, 8), 16, 10).cast("double") / float(1 << 32)


def _mixed(docs: DataFrame, keep: list[str], seed: int, weights, max_repeat: int) -> DataFrame:
    """``row`` (a struct of ``keep``), ``size, source, source_size, target, copies``.

    The rows, which are narrow, are written before they are ranged.
    """
    text = F.col("text").cast("string")
    rows = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in keep)).alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"), word_count(text).alias("size"), F.crc32(F.encode(text, "UTF-8")).alias("crc"))
    rows = saved(rows, "mix-sizes")
    sources = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    plan = targets(sources, weights, max_repeat)
    # rows before the source in the index order (nulls first), for positions within it
    ahead = Window.orderBy(F.col("source").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    plan = plan.select("*", F.coalesce(F.sum("n_docs").over(ahead), F.lit(0)).alias("first_pos"))
    # written, the table of sources shows its real bytes, and Spark broadcasts it if they are few
    plan = saved(plan, "mix-plan")
    # the last column only splits a range of identical rows over tasks
    placed = with_row_index(rows.withColumn("tie", F.monotonically_increasing_id()),
                            ["source", "size", "doc_id", "crc", "tie"], "pos", written=True)
    placed = placed.join(plan.withColumnRenamed("source", "name"), F.col("source").eqNullSafe(F.col("name")))
    each = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    k = (F.col("pos") - F.col("first_pos")).cast("double")
    crossed = F.floor(offset(F.col("source"), seed) + each * (k + 1)) - F.floor(offset(F.col("source"), seed) + each * k)
    copies = F.least(F.greatest(crossed, F.lit(0)), F.lit(max_repeat)).cast("long")
    return placed.select("row", "size", "source", "source_size", "target", copies.alias("copies"))


def mix(docs: DataFrame, seed: int = 0, weights=WEIGHTS, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """``doc_id, size, source, source_size, target, copies, taken`` for every row."""
    out = _mixed(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", "text"), ["doc_id"], seed, weights, max_repeat)
    return out.select("row.doc_id", "size", "source", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def take(docs: DataFrame, seed: int = 0, weights=WEIGHTS, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """``docs`` with each row as often as the mix takes it.

    Rows are written once with a number of their own, so neither null nor repeated ids matter:
    only narrow rows are ranged by size, and the copies come back to the whole rows by number
    (by broadcast while they are few, else by a join that deals the rows evenly).
    """
    whole = saved(docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.monotonically_increasing_id().alias("id")), "mix-rows")
    narrow = whole.select("id", "row.doc_id", "row.source", "row.text")
    copies = _mixed(narrow, ["id"], seed, weights, max_repeat).where("copies > 0").select("row.id", "copies")
    return whole.join(copies, "id").select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("row.*")
