"""A deterministic stand-in model for tests and the query registry.

It answers like the prompt asks: ``TNM: <token>`` for the first ``T?N?M?`` token in the
note part of the prompt, else ``Stage: <numeral>`` for the first ``Stage <roman>``, else
``NA``.  Only the note part is searched (the template's own examples are cut off).
"""

from __future__ import annotations

from ..functions.prompts import CHAT_TEMPLATE, template_parts

STUB_TNM = r"T[0-4]N[0-3]M[01]"
STUB_STAGE = r"Stage ([IV]+[ABC]?)"


def keyword_model_factory(template: str = CHAT_TEMPLATE):
    """Return a factory (called once per Python worker) for the keyword model."""

    def factory():
        import re

        head, tail = template_parts(template)
        tnm, stage = re.compile(STUB_TNM), re.compile(STUB_STAGE)

        def respond(prompts: list[str]) -> list[str]:
            out = []
            for p in prompts:
                note = p[len(head): len(p) - len(tail)] if p.startswith(head) and p.endswith(tail) else p
                m = tnm.search(note)
                if m:
                    out.append("TNM: " + m.group(0))
                    continue
                m = stage.search(note)
                out.append("Stage: " + m.group(1) if m else "NA")
            return out

        return respond

    return factory


def failing_model_factory(on: str):
    """A model that fails on prompts holding ``on`` and answers ``Stage: X`` to all others."""

    def factory():
        def respond(prompts: list[str]) -> list[str]:
            if any(on in p for p in prompts):
                raise ValueError(on)
            return ["Stage: X"] * len(prompts)

        return respond

    return factory


def word_counter_factory():
    """A tokenizer for G3 that counts runs of other than ASCII white space."""

    def factory():
        import re

        words = re.compile(r"\S+", re.ASCII).findall
        return lambda prompts: [len(words(p)) for p in prompts]

    return factory
