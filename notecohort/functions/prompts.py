"""Prompt templates (F13) and the context-budget rule."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import estimated_tokens

# The two prompt templates, verbatim ({text} marks where the note goes).
CHAT_TEMPLATE = """<|system|>
You are a medical assistant that extracts cancer staging information from clinical notes.
<|user|>
Analyze this clinical note and extract cancer staging information:

{text}

Respond with EXACTLY ONE of these formats (no additional text):
1. "NA" if no staging information exists
2. "Stage: [stage]" for general staging (e.g., "Stage: IIB") 
3. "TNM: [classification]" for TNM classifications (e.g., "TNM: T2N1M0")
<|assistant|>"""

FINDINGS_TEMPLATE = """Analyze this clinical note and extract cancer staging information:
        {text}

        Output format:
        - Stage: [detected stage or TNM classification]
        - System: [staging system used]
        - Evidence: [exact text snippet]"""

# Note separator format and joiner for per-patient requests, and the budget.
NOTE_HEADER = "--- NOTE {idx} ---\n"
NOTE_JOINER = "\n\n"
MAX_CONTEXT_TOKENS = 8192
CHARS_PER_TOKEN = 3.5
PROMPT_TOKENS = 200
RESPONSE_TOKENS = 100


def render(text: Column, template: str = CHAT_TEMPLATE) -> Column:
    """The template with the text in place of ``{text}`` (plain concatenation, so braces or
    percent signs in notes are safe)."""
    head, tail = template.split("{text}", 1)
    return F.concat(F.lit(head), text, F.lit(tail))


def template_parts(template: str = CHAT_TEMPLATE) -> tuple[str, str]:
    head, tail = template.split("{text}", 1)
    return head, tail


def note_piece(idx: Column, text: Column) -> Column:
    """One note inside a per-patient request: header line, then the text."""
    head, tail = NOTE_HEADER.split("{idx}", 1)
    return F.concat(F.lit(head), idx.cast("string"), F.lit(tail), text)


def note_header_length(idx: Column) -> Column:
    """Characters that a note's header takes in a per-patient request."""
    return F.length(note_piece(idx, F.lit("")))


def over_budget(total_chars: Column, max_context: int = MAX_CONTEXT_TOKENS,
                chars_per_token: float = CHARS_PER_TOKEN) -> Column:
    """True when ``int(chars / 3.5) + 200 > max_context - 100``: the request goes per note.

    With the defaults a request of up to 27,625 characters is sent whole.
    """
    return estimated_tokens(total_chars, chars_per_token) + PROMPT_TOKENS > max_context - RESPONSE_TOKENS
