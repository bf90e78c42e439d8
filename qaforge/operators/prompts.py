"""Prompt templates: routing and rendering.

A template is split once into literals and slots; a render is one concat. Inserted text is never scanned for slots.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T

_SLOT = re.compile(r"\{\{|\}\}|\{([A-Za-z_][A-Za-z0-9_]*)\}")


def pieces(template: str) -> list[tuple[bool, str]]:
    """(is a slot, text) pieces of a template; '{{' and '}}' stand for braces. ValueError for a stray brace."""
    out: list[tuple[bool, str]] = []
    at, literal = 0, ""
    for m in _SLOT.finditer(template):
        literal += _plain(template[at : m.start()])
        at = m.end()
        if m.group(1) is None:
            literal += m.group()[0]
        else:
            out += [(False, literal)] * bool(literal) + [(True, m.group(1))]
            literal = ""
    literal += _plain(template[at:])
    return out + [(False, literal)] * bool(literal)


def _plain(s: str) -> str:
    if "{" in s or "}" in s:
        raise ValueError(f"stray brace in template: {s[:40]!r}")
    return s


def render(template: str, slots: dict[str, Column]) -> Column:
    """The template with its slots filled (G4); NULL counts as empty. KeyError for a slot without a Column."""
    parts = [T.filled(slots[s]) if is_slot else F.lit(s) for is_slot, s in pieces(template)]
    return F.concat(*parts) if parts else F.lit("")


def limited(df_cols: dict[str, tuple[Column, int]], missing: str = "N/A") -> dict[str, Column]:
    """Slots cut to a length each, with a placeholder for empty ones."""
    return {k: F.coalesce(F.nullif(T.clip(c, n), F.lit("")), F.lit(missing)) for k, (c, n) in df_cols.items()}


def route(rules: list[tuple[dict[str, str], str]], columns: dict[str, Column], default: str) -> Column:
    """Name of the template of the first rule whose conditions all hold (G1). A condition compares a column, lower-cased, with
    a value; '*' and absent ones hold for any."""
    out: Column | None = None
    for want, name in rules:
        cond = F.lit(True)
        for k, v in want.items():
            if v != "*":
                cond = cond & (F.lower(T.strip(columns[k])) == v.lower())
        out = F.when(cond, name) if out is None else out.when(cond, name)
    return F.lit(default) if out is None else out.otherwise(default)


def render_routed(df: DataFrame, route_col: str, templates: dict[str, str], slots: dict[str, Column], out: str = "prompt") -> DataFrame:
    """df with the prompt of each row's template; NULL for a name without a template."""
    col = F.lit(None).cast("string")
    for name, t in templates.items():
        col = F.when(F.col(route_col) == name, render(t, slots)).otherwise(col)
    return df.withColumn(out, col)


#: Metadata keys that prompts show (G2), in order.
METADATA_KEYS = ("file_name", "raw_split", "agreement_split", "current_turn_key")


def metadata_note(metadata: Column, keys: tuple[str, ...] = METADATA_KEYS, limit: int = 4000) -> Column:
    """The chosen keys of a JSON metadata text that are not empty, as 'key: value' lines of at most limit characters."""
    lines = F.array(*(F.when(T.strip(F.get_json_object(metadata, f"$.{k}")) != "", F.concat(F.lit(f"{k}: "), T.strip(F.get_json_object(metadata, f"$.{k}")))) for k in keys))
    return T.clip(F.array_join(F.array_compact(lines), "\n"), limit)


#: Short templates of our own for the built-in task kinds; slots: question, context, options, history, note.
TEMPLATES = {
    "reasoning": "Work out the answer from the material.\n\nMaterial:\n{context}\n\nQuestion:\n{question}\n\nReply as JSON: {{\"reasoning\": \"...\", \"final_answer\": \"...\"}}",
    "dialogue": "Answer the last question of this dialogue.\n\nMaterial:\n{context}\n\nEarlier turns:\n{history}\n\nQuestion:\n{question}\n\nReply as JSON: {{\"reasoning\": \"...\", \"final_answer\": \"...\"}}",
    "mcq": "Choose one option.\n\nQuestion:\n{question}\n\nOptions:\n{options}\n\nReply as JSON: {{\"reasoning\": \"...\", \"final_answer\": \"letter\"}}",
    "sentiment": "Name the sentiment (negative, neutral or positive).\n\nText:\n{context}\n\nReply as JSON: {{\"reasoning\": \"...\", \"final_answer\": \"label\"}}",
    "instruction": "Carry out the task.\n\nTask:\n{question}\n\nInput:\n{context}\n\nReply as JSON: {{\"reasoning\": \"...\", \"final_answer\": \"...\"}}",
}
RULES = [({"source": "convfinqa"}, "dialogue"), ({"task_type": "mcq"}, "mcq"), ({"task_type": "sentiment"}, "sentiment"), ({"task_type": "reasoning"}, "reasoning")]
