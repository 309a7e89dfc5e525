"""Staging findings as native Spark expressions (rules F1-F11, evidence F9, first finding E4).

A finding is ``struct<rule, stage, system, evidence, start>``; ``start`` is the 0-based
code-point offset of the match.  Per rule, in separate projections (so no scan is
re-run inside a lambda):

1. guards: short literal searches for what any match must hold (``N`` digits ``M`` digit, a
   lone M token, ``stag``); most notes stop here, and each rule runs only where its own
   trigger stands;
2. pieces: one ``regexp_replace`` pass marks every match and its groups in the text, and
   cheap splits at the marks give the text before each match, the match and the groups
   (a text that holds the marks itself goes by ``regexp_extract_all`` and ``split``);
3. offsets: start(k) = sum(len(piece j) + len(match j), j < k) + len(piece k), a scan
   over blocks (linear in the number of matches, not quadratic);
4. findings: stage string, system, evidence window (+-50 characters) per match.

The roman-numeral rule runs in linear time on a masked copy of the text (see
``roman_search_text``) instead of with look-aheads, and the components rule line by line
(see ``components``).  Evidence windows are cut from the text, or from blocks of a long one.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import MATCH, SOME_M, component_matches, first_component, let, scan
from .patterns import (EVIDENCE_CHARS, ROMAN_NUMERAL, RULES, STAGE_AJCC, STAGE_COLON, STAGE_STANDARD,
                       TITLE, TITLE_STAGE_PREFIX, TNM_COMPONENTS, TNM_PREFIXED, TNM_STANDARD, UPPER,
                       UPPER_GROUPS, Rule)
from .text import non_blank, python_title

FINDING_TYPE = "struct<rule:string,stage:string,system:string,evidence:string,start:int>"

# Guards: necessary conditions for a rule to match, with the same case folding (no other
# letter folds to t, n, m, x, a or g; the long s folds to s).
_GUARD_TNM = r"[nN][0-3mMxX]{1,3}[mM][01xX]"
_GUARD_STAGE = r"[sS\x{17F}][tT][aA][gG]"
# tnm_components needs a whole M token.
_GUARD_M = r"(?iUd)\bM[0-1X]\b"

# Marks around a match and its groups; private-use characters, which texts hardly ever hold.
_OPEN, _GROUP, _CLOSE = "\ue0f1", "\ue0f2", "\ue0f3"
_ANY_MARK = f"[{_OPEN}{_GROUP}{_CLOSE}]"

# Roman-numeral rule, linear form: a line holding a stage word, the part of a line before
# its last stage word, the part through its last "century", and a numeral token.
STAGE_WORD = r"(?iU)\b(?:stage|staging)\b"
BEFORE_LAST_STAGE = r"(?iUd)\A(.*)\b(?:stage|staging)\b"
THROUGH_LAST_CENTURY = r"(?iUd)\A.*century"
FIRST_STAGE_LINE = r"(?iUdm)^.*\b(?:stage|staging)\b.*"
NUMERAL_TOKEN = r"(?iU)\b[IVX]{1,4}[A-C]?\b"

# Guards and the group shortcut apply only to the built-in patterns, whose structure is
# known; user patterns (overrides) always take the exact path.
_GUARD_OF_PATTERN = {TNM_STANDARD: "_g_tnm", TNM_PREFIXED: "_g_tnm", TNM_COMPONENTS: "_g_comp",
                     STAGE_STANDARD: "_g_stage", STAGE_AJCC: "_g_stage", STAGE_COLON: "_g_stage",
                     ROMAN_NUMERAL: "_g_stage"}
_GROUP1_IS_MATCH = {TNM_STANDARD, TNM_PREFIXED, STAGE_STANDARD, STAGE_AJCC, ROMAN_NUMERAL}
# Texts of up to so many characters are one block for evidence windows, longer ones are cut.
_ONE_BLOCK, _CUT = 4096, 512
_BLOCK_PATTERN = rf"(?s).{{1,{_CUT}}}"


def _guard_for(rule: Rule) -> str | None:
    """Name of the guard column whose truth is necessary for ``rule`` to match."""
    return _GUARD_OF_PATTERN.get(rule.pattern)


def _group_is_match(rule: Rule) -> bool:
    """For built-in rules whose group 1 spans the whole match no group pass is needed."""
    return rule.pattern in _GROUP1_IS_MATCH and rule.stage_form != UPPER_GROUPS


def _is_roman(rule: Rule) -> bool:
    return rule.pattern == ROMAN_NUMERAL


def _is_components(rule: Rule) -> bool:
    return rule.pattern == TNM_COMPONENTS


def _component_findings(rule: Rule, matches: Column) -> Column:
    return F.transform(matches, lambda x: _finding(rule, F.upper(x["groups"]), x["start"], x["end"]))


def roman_search_text(t: Column) -> Column:
    """The text with every character that cannot be part of a roman-numeral match
    replaced by a space (same length, so offsets carry over).

    A numeral matches when a whole-word stage/staging follows it on its line and no
    "century" follows it there.  So on each line holding a stage word, the matches are
    exactly the numeral tokens between the end of the line's last "century" and the start
    of its last stage word; everything else is blanked.  One character before that region
    is kept so the word-boundary test at its start sees the same neighbour as in the full
    text; the region always ends before a non-word character.  Every step is one pass.
    """
    def mask(line):
        pre = F.regexp_extract(line, BEFORE_LAST_STAGE, 1)
        cen = F.length(F.regexp_extract(line, THROUGH_LAST_CENTURY, 0))
        rs = F.greatest(cen - 1, F.lit(0))
        kept = F.concat(F.repeat(F.lit(" "), rs), F.substring(pre, rs + 1, F.length(pre) - rs),
                        F.repeat(F.lit(" "), F.length(line) - F.length(pre)))
        blank = F.repeat(F.lit(" "), F.length(line))
        return F.when(line.rlike(STAGE_WORD) & (cen <= F.length(pre)), kept).otherwise(blank)

    return F.array_join(F.transform(F.split(t, "\n", -1), mask), "\n")


def _stage_of(rule: Rule, match: Column, groups: list[Column]) -> Column:
    g1 = match if not groups else groups[0]
    if rule.stage_form == UPPER:
        return F.upper(g1)
    if rule.stage_form == TITLE:
        return python_title(g1)
    if rule.stage_form == TITLE_STAGE_PREFIX:
        return python_title(F.concat(F.lit("Stage "), g1))
    if rule.stage_form == UPPER_GROUPS:
        return F.upper(F.concat(*groups))
    raise ValueError(f"unknown stage form {rule.stage_form}")


def _search(rule: Rule) -> tuple[str | None, str]:
    """(column searched, Java pattern) for a rule."""
    return ("_roman_text", NUMERAL_TOKEN) if _is_roman(rule) else (None, rule.java)


def _pieces(src: Column, pattern: str, groups: int) -> Column:
    """``array<struct<p, m, g1...>>``: the text before each match, the match, its groups."""
    names = [f"g{g}" for g in range(1, groups + 1)]
    kind = "array<struct<" + ",".join(f"{n}:string" for n in ["p", "m", *names]) + ">>"
    marked = F.regexp_replace(src, pattern, _OPEN + "$0" + "".join(f"{_GROUP}${g}" for g in range(1, groups + 1)) + _CLOSE)

    def fields(piece):
        def cut(parts):
            found = F.split(F.get(parts, 1), _GROUP, -1) if groups else F.array(F.get(parts, 1))
            return let(found, lambda x: F.struct(F.get(parts, 0).alias("p"), F.get(x, 0).alias("m"),
                                                 *[F.get(x, k + 1).alias(n) for k, n in enumerate(names)]))
        return let(F.split(piece, _OPEN, -1), cut)

    one_pass = let(F.split(marked, _CLOSE, -1), lambda x: F.transform(F.slice(x, F.lit(1), F.size(x) - 1), fields))
    # a text with marks of its own
    values = [F.regexp_extract_all(src, F.lit(pattern), g).alias(n) for g, n in enumerate(["m", *names])]
    zipped = F.arrays_zip(F.slice(F.split(src, pattern, -1), F.lit(1), F.size(values[0])).alias("p"), *values)
    return F.when(src.rlike(_ANY_MARK), zipped.cast(kind)).otherwise(one_pass.cast(kind))


def _with_guards(df: DataFrame, text_col: str, rules) -> DataFrame:
    t = F.col(text_col)
    staged = df.select("*", *_guard_columns(t))
    if any(_is_roman(r) for r in rules):
        staged = staged.withColumn("_roman_text", F.when(F.col("_g_stage"), roman_search_text(t)))
    return staged


def _guard_columns(t: Column) -> list[Column]:
    return [t.rlike(_GUARD_TNM).alias("_g_tnm"), t.rlike(_GUARD_STAGE).alias("_g_stage"),
            (t.rlike(SOME_M) & t.rlike(_GUARD_M)).alias("_g_comp")]


def _located(pieces: Column, names: list[str]) -> Column:
    """``array<struct<m, start, g...>>`` from pieces: a scan that carries the offset reached."""
    kind = "struct<" + ",".join(["m:string", "start:int", *(f"{n}:string" for n in names)]) + ">"

    def place(at, x):
        return let(at + F.length(x["p"]), lambda start: F.struct(
            (start + F.length(x["m"])).alias("carry"),
            F.struct(x["m"].alias("m"), start.alias("start"), *[x[n].alias(n) for n in names]).alias("item")))

    return scan(pieces, F.lit(0), place, kind)


def _evidence(start: Column, end: Column) -> Column:
    """The match with its window, from the text's blocks: finding a character by its number
    walks the text from its beginning, which the blocks keep short."""
    cut = F.col("_cut")
    lo, hi = F.greatest(start - EVIDENCE_CHARS, F.lit(0)), end + EVIDENCE_CHARS
    first = F.floor(lo / cut).cast("int")
    around = F.array_join(F.slice(F.col("_blocks"), first + 1, F.floor((hi - 1) / cut).cast("int") - first + 1), "")
    return F.substring(around, lo - first * cut + 1, hi - lo)


def _finding(rule: Rule, stage: Column, start: Column, end: Column) -> Column:
    return F.struct(F.lit(rule.name).alias("rule"), stage.alias("stage"), F.lit(rule.system).alias("system"),
                    _evidence(start, end).alias("evidence"), start.cast("int").alias("start"))


def _finding_builder(rule: Rule, group_names: list[str]):
    def build(x):
        stage = _stage_of(rule, x["m"], [x[g] for g in group_names])
        return _finding(rule, stage, x["start"], x["start"] + F.length(x["m"]))

    return build


def add_findings(df: DataFrame, text_col: str = "note_text", rules=RULES,
                 out_col: str = "findings") -> DataFrame:
    """Add ``out_col``: all findings of the rule set, rule order then text order.

    Blank or null texts give an empty array (the reference skips them).
    """
    rules = tuple(rules)
    t = F.col(text_col)
    k = len(rules)
    staged = _with_guards(df, text_col, rules)
    # pieces, and matches of the components rule
    cols, groups_of = [], {}
    for i, rule in enumerate(rules):
        col, pattern = _search(rule)
        groups_of[i] = [] if _group_is_match(rule) or _is_components(rule) else [f"g{g}" for g in range(1, rule.groups + 1)]
        found = component_matches(t) if _is_components(rule) else _pieces(F.col(col) if col else t, pattern, len(groups_of[i]))
        guard = _guard_for(rule)
        cols.append((found if guard is None else F.when(F.col(guard), found)).alias(f"_z{i}"))
    staged = staged.select("*", *cols)
    any_match = functools.reduce(lambda a, b: a | b, [F.coalesce(F.size(f"_z{i}") > 0, F.lit(False)) for i in range(k)])
    short = F.length(t) <= _ONE_BLOCK
    blocks = F.when(short, F.array(t)).otherwise(F.regexp_extract_all(t, F.lit(_BLOCK_PATTERN), 0))
    staged = staged.select("*", F.when(any_match, blocks).alias("_blocks"), F.when(short, _ONE_BLOCK).otherwise(_CUT).alias("_cut"))
    # offsets and findings
    cols = []
    empty = F.array().cast(f"array<{FINDING_TYPE}>")
    for i, rule in enumerate(rules):
        z = F.col(f"_z{i}")
        if _is_components(rule):
            found = _component_findings(rule, z)
        else:
            found = F.transform(_located(z, groups_of[i]), _finding_builder(rule, groups_of[i]))
        cols.append(F.when(F.size(z) > 0, found).otherwise(empty).alias(f"_f{i}"))
    staged = staged.select("*", *cols)
    allf = F.concat(*[F.col(f"_f{i}") for i in range(k)]) if k > 1 else F.col("_f0")
    allf = F.when(non_blank(t), allf).otherwise(empty)
    drop = ["_g_tnm", "_g_stage", "_g_comp", "_roman_text", "_blocks", "_cut"] + [f"_{p}{i}" for p in "zf" for i in range(k)]
    return staged.withColumn(out_col, allf).drop(*[c for c in drop if c in staged.columns])


def add_first_finding(df: DataFrame, text_col: str = "note_text", rules=RULES,
                      out_col: str = "first_finding") -> DataFrame:
    """Add ``out_col``: ``struct<stage, system>`` of the first finding, or null.

    Evaluated lazily: ``coalesce`` stops at the first rule with a match, and a rule costs one
    scan up to its first match; the components and roman rules look at the first lines that
    may hold one, and at the whole text only if those do not.  The winning rule index is
    tagged onto the match so group values are read only for that rule.
    """
    rules = tuple(rules)
    t = F.col(text_col)
    tagged = []
    for i, rule in enumerate(rules):
        if _is_components(rule):
            first = first_component(t)
        elif _is_roman(rule):
            first = F.coalesce(*[F.nullif(F.regexp_extract(roman_search_text(part), NUMERAL_TOKEN, 0), F.lit(""))
                                 for part in (F.regexp_extract(t, FIRST_STAGE_LINE, 0), t)])
        else:
            first = F.nullif(F.regexp_extract(t, rule.java, 0), F.lit(""))
        guard = _guard_for(rule)
        if guard is not None:
            first = F.when(F.col(guard), first)
        tagged.append(F.when(first.isNotNull(), F.struct(F.lit(i).alias("rule"), first.alias("match"))))
    hit = F.when(non_blank(t), F.coalesce(*tagged))
    base = df.select("*", *_guard_columns(t))
    staged = base.select("*", hit.alias("_hit")).drop("_g_tnm", "_g_stage", "_g_comp")
    match = F.col("_hit.match")
    branches = None
    for i, rule in enumerate(rules):
        groups = []
        if not (_group_is_match(rule) or _is_components(rule)):
            groups = [F.regexp_extract(t, rule.java, g) for g in range(1, rule.groups + 1)]
        stage = F.upper(match) if _is_components(rule) else _stage_of(rule, match, groups)
        value = F.struct(stage.alias("stage"), F.lit(rule.system).alias("system"))
        here = F.col("_hit.rule") == i
        branches = F.when(here, value) if branches is None else branches.when(here, value)
    return staged.withColumn(out_col, branches).drop("_hit")
