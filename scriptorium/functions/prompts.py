"""Texts for, and answers from, an external checking model."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DEFAULT_TASK = "Decide which of the candidate concepts really occur in the passage below."
DEFAULT_RULES = (
    "Name a concept only if the passage shows it, and quote one example for each. "
    'Answer as JSON {"tropes": [...], "examples": [...]}, or with nothing at all if none fits.'
)
RESPONSE_SCHEMA = "tropes array<string>, examples array<string>"


def build_prompt(text: Column, candidates: Column, task: str = DEFAULT_TASK, rules: str = DEFAULT_RULES) -> Column:
    """One prompt per row; an empty candidate list reads "None"."""
    listed = F.when(F.size(candidates) > 0, F.array_join(candidates, ", ")).otherwise(F.lit("None"))
    return F.concat(
        F.lit(f"{task}\n\nPassage:\n"), F.coalesce(text, F.lit("")),
        F.lit("\n\nCandidates: "), listed, F.lit(f"\n\n{rules}\n"),
    )


def parse_response(c: Column) -> Column:
    """The answer as a struct; null for an empty or unreadable one."""
    parsed = F.from_json(c, RESPONSE_SCHEMA, {"mode": "PERMISSIVE"})
    return F.when(parsed["tropes"].isNotNull(), parsed)
