"""The separate T, N, M components rule in linear time.

As written the rule is greedy over a whole line and backtracks over every pair of T and N
candidates.  What it matches can be said line by line.  ``.`` stops at a line feed, but the
delimiter after T or N may be one, so a T at the end of a line belongs to the next line,
and an N at the end of a line takes its M from the line after.  For a line, the greedy
``.*`` picks

* the last N: one at the line's very end if the next line has an M, else the last N (with
  its delimiter) before the line's last M;
* the last M of the line that the N points to;
* the first T, from where the last match ended, whose delimiter comes before that N.

So each line gives at most one match, and only if it or the next line has an M.  The other
lines are left out by one cheap search each.  What remains is a scan over the candidate
lines that carries where the last match ended; it runs block by block, so that appending a
match copies a block's matches and never those of the whole text, and the blocks are
flattened once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from .patterns import JAVA_FLAGS

_T, _N, _M, _DELIMITER = r"T[0-4isX]{1,3}", r"N[0-3MX]{1,3}", r"M[0-1X]{1}", r"[,\s.]"
# Any M token holds one of these pairs.
SOME_M = r"[mM][01xX]"
_THROUGH_LAST_M = JAVA_FLAGS + rf"\A.*\b{_M}\b"
_LAST_N = JAVA_FLAGS + rf"\A(.*)\b({_N}){_DELIMITER}"
_END_N = JAVA_FLAGS + rf"\b{_N}\z"
_END_T = JAVA_FLAGS + rf"\b{_T}\z"
_FIRST_T = JAVA_FLAGS + rf"\A(.*?)\b({_T}){_DELIMITER}"
# The first line with an M token, two lines before it and two behind it.
_FIRST_M_LINES = rf"(?iUdm)^(?:[^\n]*\n){{0,2}}[^\n]*\b{_M}\b[^\n]*(?:\n[^\n]*){{0,2}}"
MATCH = "struct<start:int,end:int,groups:string>"
BLOCK = 256


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), 0)


def in_blocks(items: Column) -> Column:
    """An array cut into arrays of ``BLOCK`` elements (none for an empty array)."""
    def cut(x):
        n = F.ceil(F.size(x) / BLOCK).cast("int")
        return F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), lambda b: F.slice(x, b * BLOCK + 1, BLOCK))).otherwise(
            F.slice(F.array(x), 1, 0))

    return let(items, cut)


def scan(items: Column, first: Column, step: Callable[[Column, Column], Column], kind: str) -> Column:
    """A fold over ``items`` that carries a value and puts out at most one result an element.

    ``step(carried, item)`` gives ``struct<carry, item>``; a null item puts out nothing.
    """
    none = F.array().cast(f"array<{kind}>")

    def put(state, x):
        return let(step(state["carry"], x), lambda s: F.struct(
            s["carry"].alias("carry"),
            F.when(s["item"].isNull(), state["out"]).otherwise(F.concat(state["out"], F.array(s["item"]))).alias("out")))

    def block(state, some):
        return let(F.aggregate(some, F.struct(state["carry"].alias("carry"), none.alias("out")), put), lambda s: F.struct(
            s["carry"].alias("carry"), F.concat(state["out"], F.array(s["out"])).alias("out")))

    start = F.struct(first.alias("carry"), F.array().cast(f"array<array<{kind}>>").alias("out"))
    return F.flatten(F.aggregate(in_blocks(items), start, block, lambda s: s["out"]))


def _placed(lines: Column) -> Column:
    """Each line with its offset and the end of its last M (0: it has none)."""
    def place(at, line):
        m_end = F.when(line.rlike(SOME_M), F.length(F.regexp_extract(line, _THROUGH_LAST_M, 0))).otherwise(0)
        return F.struct((at + F.length(line) + 1).alias("carry"), F.struct(line.alias("line"), at.alias("at"), m_end.alias("m_end")).alias("item"))

    return scan(lines, F.lit(0), place, "struct<line:string,at:int,m_end:int>")


def _candidates(placed: Column) -> Column:
    """The lines that may match: the N and M they would take, and the T before them."""
    n = F.size(placed)
    none = F.array(F.struct(F.lit("").alias("line"), F.lit(0).alias("at"), F.lit(0).alias("m_end")))
    around = F.zip_with(
        F.zip_with(F.concat(none, F.slice(placed, F.lit(1), n - 1)), placed, lambda b, h: F.struct(b["line"].alias("before"), h.alias("here"))),
        F.concat(F.slice(placed, F.lit(2), n - 1), none),
        lambda pair, after: F.struct(pair["before"].alias("before"), pair["here"].alias("here"), after["line"].alias("after"), after["m_end"].alias("after_m")))
    near = F.filter(around, lambda x: (x["here"]["m_end"] > 0) | (x["after_m"] > 0))

    def tokens(x):
        here = x["here"]
        line, m_end = here["line"], here["m_end"]
        n_last = F.when(x["after_m"] > 0, F.regexp_extract(line, _END_N, 0)).otherwise("")

        def chosen(last):
            own = F.substring(line, F.lit(1), F.greatest(m_end - 2, F.lit(0)))
            to_next = last != ""
            return F.struct(
                line.alias("line"), here["at"].alias("at"), F.regexp_extract(x["before"], _END_T, 0).alias("t_last"),
                F.when(to_next, last).otherwise(F.regexp_extract(own, _LAST_N, 2)).alias("n"),
                F.when(to_next, F.length(line) - F.length(last)).otherwise(F.length(F.regexp_extract(own, _LAST_N, 1))).alias("n_start"),
                F.when(to_next, here["at"] + F.length(line) + 1 + x["after_m"]).otherwise(here["at"] + m_end).alias("end"),
                F.when(to_next, F.substring(x["after"], x["after_m"] - 1, F.lit(2))).otherwise(F.substring(line, m_end - 1, F.lit(2))).alias("m"))

        return let(n_last, chosen)

    return F.filter(F.transform(near, tokens), lambda x: x["n"] != "")


def _step(done: Column, x: Column) -> Column:
    """The match of a candidate line, if it has a T that is free."""
    t_before = x["at"] - 1 - F.length(x["t_last"])  # the T at the end of the line before comes first
    early = (x["t_last"] != "") & (t_before >= done)
    skip = F.greatest(done - x["at"], F.lit(0))
    region = F.when(x["n_start"] > skip, F.substring(x["line"], skip + 1, x["n_start"] - skip)).otherwise("")
    here = let(region, lambda r: F.struct((x["at"] + skip + F.length(F.regexp_extract(r, _FIRST_T, 1))).alias("start"),
                                          F.regexp_extract(r, _FIRST_T, 2).alias("t")))
    first = F.when(early, F.struct(t_before.alias("start"), x["t_last"].alias("t"))).otherwise(here)

    def found(t):
        item = F.struct(t["start"].cast("int").alias("start"), x["end"].cast("int").alias("end"), F.concat(t["t"], x["n"], x["m"]).alias("groups"))
        return F.struct(F.when(t["t"] != "", x["end"]).otherwise(done).alias("carry"), F.when(t["t"] != "", item).alias("item"))

    return let(first, found)


def component_matches(text: Column) -> Column:
    """``array<struct<start, end, groups>>``: offsets of each match and its three tokens joined."""
    placed = lambda lines: let(_placed(lines), lambda p: scan(_candidates(p), F.lit(0), _step, MATCH))
    return let(F.split(text, "\n", -1), placed)


def first_component(text: Column) -> Column:
    """The three tokens of the first match, joined; null if there is none.

    Only the lines around the first M token are looked at, if they decide: a match that
    ends before the last of them has all the lines that it depends on.
    """
    def decided(near):
        return let(F.get(component_matches(near), 0), lambda m: F.when(F.position(F.lit("\n"), near, m["end"] + 1) > 0, m["groups"]))

    return F.coalesce(let(F.regexp_extract(text, _FIRST_M_LINES, 0), decided), F.get(component_matches(text), 0)["groups"])
