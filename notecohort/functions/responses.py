"""Model-response parser (F14) as one native expression.

Precedence: the text ``NA`` anywhere (case-sensitive) -> no staging; else the text after
the first ``TNM:`` (stripped, first line, stripped) with system TNM; else the same after
``Stage:`` with system General; else the first white-space-separated word that starts
with ``T`` and contains ``N`` and ``M``, stripped of ``.,;:()`` at both ends, system TNM.
An empty stage string is still a finding.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .components import let

# The markers and the characters stripped from a bare TNM word.
NA_MARK, TNM_MARK, STAGE_MARK = "NA", "TNM:", "Stage:"
STRIP_CHARS = ".,;:()"

_WS = r"[\s\x{1C}-\x{1F}]"  # Python's str.strip()/split() white space
_FIRST_LINE = r"(?U)\A" + _WS + r"*([^\n]*?)" + _WS + r"*(?:\n|\z)"
# The first word that starts with T and holds an N and an M.
_WORD_CHAR = r"[^\s\x{1C}-\x{1F}]"
_TNM_WORD = rf"(?U)(?<!{_WORD_CHAR})T(?={_WORD_CHAR}*N)(?={_WORD_CHAR}*M){_WORD_CHAR}*"
RESPONSE_TYPE = "struct<stage:string,system:string>"


def _after(r: Column, mark: str) -> Column:
    tail = F.get(F.split(r, mark, 2), 1)  # the marks hold no pattern characters
    return F.regexp_extract(tail, _FIRST_LINE, 1)


def parse_response(response: Column) -> Column:
    """``struct<stage, system>``; both null when the response carries no staging.

    One CASE over structs, so each response is searched by its own branch only, once.
    """
    r = response
    both = lambda stage, system: F.struct(stage.alias("stage"), system.alias("system"))
    none = F.lit(None).cast("string")
    word = F.nullif(F.regexp_extract(r, _TNM_WORD, 0), F.lit(""))
    bare = let(F.btrim(word, F.lit(STRIP_CHARS)), lambda w: both(w, F.when(w.isNotNull(), F.lit("TNM"))))
    return (F.when(r.isNull() | r.contains(NA_MARK), both(none, none))
             .when(r.contains(TNM_MARK), both(_after(r, TNM_MARK), F.lit("TNM")))
             .when(r.contains(STAGE_MARK), both(_after(r, STAGE_MARK), F.lit("General")))
             .otherwise(bare))
