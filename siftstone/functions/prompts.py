"""Requests to teachers and students, built from the schema of their answers.

What a label means is data of a run, not of the engine: a guide is a mapping of field and
value to a text, read from a file that the settings name. Without one a teacher gets the
schema alone.
"""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import ENUMS
from .contract import triage_schema

#: Characters of a rejected answer that a repair quotes.
QUOTED = 4000

Guide = Mapping[str, Mapping[str, str]]


def checked_guide(guide: Guide | None) -> Guide:
    """The guide, if its fields and values are those of the schema; rules of free fields go under ``""``."""
    guide = guide or {}
    known = {**{f: {*v, ""} for f, v in ENUMS.items()}, "order_id": {""}, "summary": {""}}
    for name, values in guide.items():
        if wrong := set(values) - known.get(name, set()):
            raise ValueError(f"the guide explains {name}: {', '.join(sorted(wrong))}, which the schema doesn't have")
    return guide


def explained(guide: Guide | None, names: tuple[str, ...]) -> str:
    """What the guide says of these fields, a line a value; empty without a guide."""
    lines = [f"{n}.{value}: {text}" if value else f"{n}: {text}" for n in names for value, text in checked_guide(guide).get(n, {}).items()]
    return "".join(f"\n{line}" for line in lines)


def label_system(guide: Guide | None = None) -> str:
    schema = json.dumps(triage_schema(True))
    return f"Triage support tickets. Answer with JSON of this schema only: {schema}{explained(guide, (*ENUMS, 'order_id', 'summary'))}"


def zero_shot_system(student_system: str, guide: Guide | None = None) -> str:
    """What an untrained student is told: what a teacher is, and then the form of its own answer."""
    return f"{label_system(guide)}\n{student_system}"


def generation_system(guide: Guide | None = None) -> str:
    return f"Write support tickets as customers would. Answer with JSON of this schema only: {json.dumps(generation_schema())}{explained(guide, ('intent',))}"


def ticket_blocks(items: Column) -> Column:
    """Items array<struct<id, text>> as marked blocks."""
    blocks = F.transform(items, lambda x: F.concat(F.lit('<ticket id="'), x["id"], F.lit('">\n'), F.coalesce(x["text"], F.lit("")), F.lit("\n</ticket>")))
    return F.array_join(blocks, "\n")


def label_request(items: Column) -> Column:
    """The user part of a batch: its size and its tickets."""
    return F.concat(F.lit("Tickets: "), F.size(items).cast("string"), F.lit("\n"), ticket_blocks(items))


def repair_request(items: Column, errors: Column, answer: Column) -> Column:
    """The batch of failed tickets again, with the errors of the last answer and that answer."""
    listed = F.array_join(errors, "\n")
    quoted = F.substring(F.coalesce(answer, F.lit("")), 1, QUOTED)
    return F.concat(label_request(items), F.lit("\nErrors of the last answer:\n"), listed, F.lit("\nLast answer:\n"), quoted)


def generation_request(specs: Column) -> Column:
    """The user part of a generation call: one specification in JSON a line."""
    return F.concat(F.lit("Specifications, one a ticket:\n"), F.array_join(specs, "\n"))


def generation_schema() -> dict:
    """The JSON schema of a generation answer."""
    item = {"type": "object", "properties": {"id": {"type": "string"}, "text": {"type": "string"}}, "required": ["id", "text"], "additionalProperties": False}
    return {"type": "object", "properties": {"items": {"type": "array", "items": item}}, "required": ["items"], "additionalProperties": False}
