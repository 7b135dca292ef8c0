"""What a question asks for: its class by patterns, and terms to widen it with."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from vellumine.functions.text import canon, text_of

#: Words that mark a question about the process, and what to widen it with.
PROCESS_WORDS = ("n2s", r"navigate\s+to\s+saas", "navigate-to-saas", "lifecycle", "methodology", r"sprint\s+0", r"sprint\s+zero", "discovery", "build", "optimize")
PROCESS_TITLES = ("n2s", "navigate to saas", "methodology", "playbook", "runbook")


@dataclass(frozen=True)
class Rule:
    """If the pattern is in the question, these terms are added."""

    pattern: str
    terms: tuple[str, ...]


#: Patterns of questions, and the terms that each adds.
RULES = (
    Rule(r"\bn2s\b|\bnavigate.+saas\b", ("N2S", "Navigate to SaaS")),
    Rule(r"\blifecycle\b|\bmethodology\b", ("Discovery", "Build", "Optimize", "Start", "Prepare", "Sprint 0", "Plan")),
    Rule(r"\bgovernance\b|\bcriteria\b|\bcheckpoint\b", ("governance checkpoints", "entry criteria", "exit criteria")),
)


def is_process(question: Column, words: tuple[str, ...] = PROCESS_WORDS) -> Column:
    """Does any of the words stand in the question? Null gives false."""
    return F.lower(text_of(question)).rlike(r"(?U)\b(" + "|".join(words) + r")\b")


def expand(question: str, rules: tuple[Rule, ...] = RULES, words: tuple[str, ...] = PROCESS_WORDS) -> list[str]:
    """The question and the terms to search besides; alone where it isn't about the process. For match='any' searches."""
    low = question.lower()
    if not any(re.search(rf"\b{w}\b", low) for w in words):
        return [question]
    return [question, *dict.fromkeys(t for r in rules if re.search(r.pattern, low) for t in r.terms)]


def process_documents(title: Column, meta: Column, titles: tuple[str, ...] = PROCESS_TITLES) -> Column:
    """Is a document about the process, by its title or any of its metadata (JSON text)?"""
    t, m = F.lower(text_of(title)), F.lower(text_of(meta))
    hit = F.lit(False)
    for x in titles:
        hit = hit | t.contains(x)
    for x in titles[:3]:
        hit = hit | m.contains(x)
    return hit


def has_phrase(hits: Column, phrases: list[str], synonyms: dict[str, list[str]] | None = None) -> Column:
    """Does any of an array of texts hold one of the phrases or its synonyms, in canonical form?"""
    wanted = [x for p in phrases for x in (p, *(synonyms or {}).get(p.lower(), []))]
    if not wanted:
        return F.lit(True)
    return F.exists(hits, lambda h: F.array_contains(F.array(*[F.concat(F.lit(" "), canon(h), F.lit(" ")).contains(F.concat(F.lit(" "), canon(F.lit(w)), F.lit(" "))) for w in wanted]), True))
