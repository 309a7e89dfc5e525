"""DuckDB oracle SQL for the registered queries.

Written independently of the Spark plans where that is possible (windows where Spark
aggregates, a rest-of-line filter where Spark uses look-arounds), so agreement is
evidence.  DuckDB's RE2 has ASCII ``\\b``/``\\s`` and no look-around; the planted phrases
are ASCII, and the roman-numeral rule is re-expressed as "numeral token whose rest of
line has a stage word and no 'century'".
"""

from __future__ import annotations

from ..functions.patterns import (EVIDENCE_CHARS, ROMAN_NUMERAL, RULES, TITLE, TITLE_STAGE_PREFIX, UPPER,
                                  UPPER_GROUPS, Rule)
from ..functions.prompts import CHAT_TEMPLATE, FINDINGS_TEMPLATE
from .fixtures import with_fixture_ctes


def q(s: str) -> str:
    """A SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def title_sql(expr: str) -> str:
    """Python ``str.title()`` for the stage strings (letters restart after non-letters)."""
    return ("array_to_string(list_transform(regexp_extract_all(" + expr + ", '[A-Za-z]+|[^A-Za-z]+', 0), "
            "lambda x: case when regexp_matches(x, '^[A-Za-z]') then upper(x[1]) || lower(x[2:]) else x end), '')")


NONBLANK = "regexp_matches({t}, '\\S')"


def _rule_sql(rel: str, keys: list[str], rule: Rule, ordinal: int, text: str) -> str:
    kc = ", ".join(keys)
    if rule.pattern == ROMAN_NUMERAL:
        pat = r"(?i)\b([IVX]{1,4}[A-C]?)\b"
    else:
        pat = "(?i)" + rule.pattern
    groups = "".join(f", regexp_extract_all({text}, {q(pat)}, {g}) as g{g}s" for g in range(1, rule.groups + 1)) \
        if rule.stage_form in (TITLE_STAGE_PREFIX, UPPER_GROUPS) and rule.pattern != ROMAN_NUMERAL else ""
    base = (f"select {kc}, {text} as t, regexp_extract_all({text}, {q(pat)}, 0) as ms, "
            f"regexp_split_to_array({text}, {q(pat)}) as pc{groups} from {rel} "
            f"where {NONBLANK.format(t=text)}")
    gsel = "".join(f", g{g}s[k] as g{g}" for g in range(1, rule.groups + 1)) if groups else ""
    located = (f"select {kc}, t, k, ms[k] as mt{gsel}, "
               f"cast(coalesce(list_sum(list_transform(list_slice(pc, 1, k), lambda x: length(x))), 0) + "
               f"coalesce(list_sum(list_transform(list_slice(ms, 1, k - 1), lambda x: length(x))), 0) as bigint) as s "
               f"from (select *, unnest(generate_series(1, len(ms))) as k from ({base}))")
    if rule.pattern == ROMAN_NUMERAL:
        rest = "regexp_extract(substring(t, s + length(mt) + 1), '^[^\\n]*', 0)"
        located = (f"select * from ({located}) where regexp_matches({rest}, '(?i)\\b(?:stage|staging)\\b') "
                   f"and not regexp_matches({rest}, '(?i)century')")
    if rule.stage_form == UPPER:
        stage = "upper(mt)"
    elif rule.stage_form == TITLE:
        stage = title_sql("mt")
    elif rule.stage_form == TITLE_STAGE_PREFIX:
        stage = title_sql("'Stage ' || " + ("mt" if rule.pattern == ROMAN_NUMERAL else "g1"))
    else:
        stage = "upper(" + " || ".join(f"g{g}" for g in range(1, rule.groups + 1)) + ")"
    lo = f"greatest(s - {EVIDENCE_CHARS}, 0)"
    evidence = f"substring(t, {lo} + 1, s + length(mt) + {EVIDENCE_CHARS} - {lo})"
    return (f"select {kc}, {ordinal} as rule_ord, {q(rule.name)} as rule, {stage} as stage, "
            f"{q(rule.system)} as system, {evidence} as evidence, cast(s as integer) as start from ({located})")


def findings_sql(rel: str, keys: list[str], rules=RULES, text: str = "note_text") -> str:
    """Findings table (keys, finding_no, rule, stage, system, evidence, start) over ``rel``."""
    parts = " union all ".join(_rule_sql(rel, keys, r, i, text) for i, r in enumerate(rules))
    kc = ", ".join(keys)
    return (f"select {kc}, cast(row_number() over (partition by {kc} order by rule_ord, start) - 1 as integer) "
            f"as finding_no, rule, stage, system, evidence, start from ({parts})")


# ---- the cohort chain as CTE text (C1 -> C2 -> C3 -> B2 -> C4) -------------------------------
CHAIN = {
    "dim_cut": "select * from patdurabledim where patientepicid in (select person_source_value from patient_ids)",
    "dim_ranked": "select *, row_number() over (partition by patientepicid order by file_no, row_no desc) as rn, "
                  "min(file_no) over (partition by patientepicid) as first_file from dim_cut",
    "best": "select patientepicid, patientdurablekey from dim_ranked where rn = 1",
    "best_counts": "select patientepicid, count(*) as rows_in_file from dim_ranked where file_no = first_file "
                   "group by patientepicid",
    "mapped": "select p.person_source_value, b.patientdurablekey, c.rows_in_file from patient_ids p "
              "left join best b on p.person_source_value = b.patientepicid "
              "left join best_counts c on p.person_source_value = c.patientepicid",
    "cohort": "select distinct patientdurablekey from mapped where patientdurablekey is not null",
    "enc": "select patientdurablekey, encounterkey, datekey, datekeyvalue, enddatekey, enddatekeyvalue, "
           "admissiondatekey, admissiondatekeyvalue, dischargedatekey, dischargedatekeyvalue from encounterfact "
           "where patientdurablekey in (select patientdurablekey from cohort)",
    "meta_enc": "select m.patientdurablekey, m.patientepicid, m.encounterkey, m.deid_note_key, m.deid_note_id, "
                "m.note_type, e.patientdurablekey as encounter_patientdurablekey, e.datekeyvalue, e.enddatekeyvalue "
                "from note_metadata m join enc e on m.encounterkey = e.encounterkey",
    "note_keys": "select distinct deid_note_key from meta_enc where deid_note_key is not null",
    "texts": "select * from note_text where deid_note_key in (select deid_note_key from note_keys)",
    "notes": "select * from texts join meta_enc using (deid_note_key)",
}
CHAIN_ORDER = tuple(CHAIN)


def chain(upto: str, extra: list[tuple[str, str]] | None = None, body: str = "") -> str:
    """CTEs of the chain up to ``upto`` (inclusive), plus ``extra`` CTEs, then ``body``;
    fixture views are prepended as needed."""
    names = CHAIN_ORDER[: CHAIN_ORDER.index(upto) + 1]
    ctes = [(n, CHAIN[n]) for n in names] + list(extra or [])
    sql = "with " + ",\n".join(f"{n} as ({s})" for n, s in ctes) + "\n" + body
    return with_fixture_ctes(sql)


# ---- stub model and parser rules (mirror of plans.models) ---------------------------------------
STUB_TNM = "T[0-4]N[0-3]M[01]"
STUB_STAGE = "Stage ([IV]+[ABC]?)"


def stub_stage(t: str) -> str:
    return (f"case when regexp_matches({t}, {q(STUB_TNM)}) then regexp_extract({t}, {q(STUB_TNM)}, 0) "
            f"when regexp_matches({t}, {q(STUB_STAGE)}) then regexp_extract({t}, {q(STUB_STAGE)}, 1) end")


def stub_system(t: str) -> str:
    return (f"case when regexp_matches({t}, {q(STUB_TNM)}) then 'TNM' "
            f"when regexp_matches({t}, {q(STUB_STAGE)}) then 'General' end")


def parse_sql(r: str) -> tuple[str, str]:
    first_line = "'^\\s*([^\\n]*?)\\s*(?:\\n|$)'"
    after_tnm = f"regexp_extract(substring({r}, instr({r}, 'TNM:') + 4), {first_line}, 1)"
    after_stage = f"regexp_extract(substring({r}, instr({r}, 'Stage:') + 6), {first_line}, 1)"
    word = (f"list_filter(string_split_regex({r}, '\\s+'), lambda w: starts_with(w, 'T') and contains(w, 'N') "
            f"and contains(w, 'M'))[1]")
    bare = f"trim({word}, '.,;:()')"
    stage = (f"case when contains({r}, 'NA') then null when contains({r}, 'TNM:') then {after_tnm} "
             f"when contains({r}, 'Stage:') then {after_stage} else {bare} end")
    system = (f"case when contains({r}, 'NA') then null when contains({r}, 'TNM:') then 'TNM' "
              f"when contains({r}, 'Stage:') then 'General' when {word} is not null then 'TNM' end")
    return stage, system


def piece_sql(idx: str, text: str) -> str:
    return f"'--- NOTE ' || cast({idx} as varchar) || ' ---' || chr(10) || {text}"


def template_sql(template: str, text: str) -> str:
    head, tail = template.split("{text}", 1)
    return f"{q(head)} || {text} || {q(tail)}"


CHAT = CHAT_TEMPLATE
FINDINGS = FINDINGS_TEMPLATE
