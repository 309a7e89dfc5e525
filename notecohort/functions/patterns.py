"""The staging rule table.

The rule names, their order (which is the priority of findings), the pattern texts,
the staging systems and how each stage string is formed are fixed values that must equal
the reference's to give the same findings.  They are stated below as the reference
writes them, in Python ``re`` syntax (case-insensitive, Unicode), in rule order.
"""

from __future__ import annotations

from dataclasses import dataclass

# Fixed values, in rule order (which is the priority).  Evidence is the match with up to 50
# characters on each side; the basic rule set is tnm_standard, then stage_standard.
TNM_STANDARD = r"\b(T[0-4isX]{1,3}N[0-3MX]{1,3}M[0-1X]{1})\b"
TNM_PREFIXED = r"\b([cp]T[0-4isX]{1,3}N[0-3MX]{1,3}M[0-1X]{1})\b"
TNM_COMPONENTS = r"\b(T[0-4isX]{1,3})[,\s.].*\b(N[0-3MX]{1,3})[,\s.].*\b(M[0-1X]{1})\b"
STAGE_STANDARD = r"\b(Stage\s+[0IVX]{1,4}[A-C]?)\b"
STAGE_AJCC = r"\b(AJCC\s+Stage\s+[0IVX]{1,4}[A-C]?)\b"
STAGE_COLON = r"\bStage\s*:\s*([0IVX]{1,4}[A-C]?)\b"
EVIDENCE_CHARS = 50

# Our rewrite of the roman-numeral rule: the look-ahead moved behind the numeral.  The
# numeral cannot overlap the word "stage", so the matches are the same, but each position
# no longer scans to the end of its line (quadratic on long lines as written).  The
# ``.{0,100}`` of the original constrains nothing and is dropped.
ROMAN_NUMERAL = r"\b([IVX]{1,4}[A-C]?)\b(?=.*?\b(?:stage|staging)\b)(?!.*?century)"

# Java flags that reproduce Python's Unicode, case-insensitive ``re``:
#   i = case-insensitive, U = Unicode classes and case folding (\b, \s, \w),
#   d = UNIX_LINES, so ``.`` stops only at \n as in Python (not at \r).
JAVA_FLAGS = "(?iUd)"

# How the stage string is formed from the match.
UPPER, TITLE, TITLE_STAGE_PREFIX, UPPER_GROUPS = "upper", "title", "title_stage", "upper_groups"


@dataclass(frozen=True)
class Rule:
    name: str
    pattern: str          # Python/Java syntax without flags
    system: str
    stage_form: str       # one of UPPER, TITLE, TITLE_STAGE_PREFIX, UPPER_GROUPS
    groups: int = 1

    @property
    def java(self) -> str:
        return JAVA_FLAGS + self.pattern


RULES: tuple[Rule, ...] = (
    Rule("tnm_standard", TNM_STANDARD, "TNM", UPPER),
    Rule("tnm_prefixed", TNM_PREFIXED, "TNM", UPPER),
    Rule("tnm_components", TNM_COMPONENTS, "TNM", UPPER_GROUPS, groups=3),
    Rule("stage_standard", STAGE_STANDARD, "General", TITLE),
    Rule("stage_ajcc", STAGE_AJCC, "AJCC", TITLE),
    Rule("stage_colon", STAGE_COLON, "General", TITLE_STAGE_PREFIX),
    Rule("roman_numeral_stage", ROMAN_NUMERAL, "General", TITLE_STAGE_PREFIX),
)
RULES_BY_NAME = {r.name: r for r in RULES}
BASIC_RULES: tuple[Rule, ...] = (RULES_BY_NAME["tnm_standard"], RULES_BY_NAME["stage_standard"])


def rule_set(overrides: dict | None = None, base: tuple[Rule, ...] = RULES) -> tuple[Rule, ...]:
    """Apply user overrides to a rule set (operator G1).

    ``overrides`` maps a rule name to either a pattern string (replaces the pattern of a
    known rule, keeping its system and stage form) or a ``Rule`` (replaces or, for a new
    name, appends a rule).  A bare string for an unknown name is ignored, as the
    reference ignores unknown names; pass a ``Rule`` to add one.
    """
    if not overrides:
        return base
    out = list(base)
    index = {r.name: i for i, r in enumerate(out)}
    for name, value in overrides.items():
        if isinstance(value, Rule):
            rule = value if value.name == name else Rule(name, value.pattern, value.system,
                                                         value.stage_form, value.groups)
            if name in index:
                out[index[name]] = rule
            else:
                index[name] = len(out)
                out.append(rule)
        elif name in index:
            old = out[index[name]]
            out[index[name]] = Rule(old.name, str(value), old.system, old.stage_form, old.groups)
    return tuple(out)
