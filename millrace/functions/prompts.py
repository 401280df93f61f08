"""Prompt configurations: a system prompt, examples and a template, rendered into messages per row."""

from __future__ import annotations

import json
import re
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.functions.parsing import sample_count
from millrace.functions.text import MESSAGE, render

#: Ways in which a reply's samples can be written, each with a parser in functions.parsing.
STYLES = ("numbered", "structured_qa")
_PLACE = re.compile(r"\{\{|\}\}|\{(\w+)\}")


def _fill(template: str, values: dict[str, Any], where: str) -> str:
    """A template with its names filled in and doubled braces made single; a name without a value is an error."""
    if missing := {m[1] for m in _PLACE.finditer(template) if m[1]} - set(values):
        raise ValueError(f"{where} lacks {', '.join(sorted(missing))}")
    return _PLACE.sub(lambda m: str(values[m[1]]) if m[1] else m[0][0], template)


def format_instruction(instructions: dict[str, str], style: str, num_samples: int | str) -> str:
    """The user's instruction of a style, with the number of samples in it."""
    if style not in STYLES:
        raise ValueError(f"unknown style {style!r}; there are {', '.join(STYLES)}")
    if not isinstance(instructions.get(style), str):
        raise ValueError(f"no instruction of the style {style!r}")
    return _fill(instructions[style], {"num_samples": sample_count(num_samples)}, f"the instruction {style!r}")


@dataclass
class Prompt:
    """A configuration with the values that all rows share. The system prompt is rendered once, at construction; the
    template per row, where a column wins over a shared value of its name. Examples stay as they are."""

    config: dict[str, Any]
    values: dict[str, Any] = field(default_factory=dict)
    style: str | None = None
    instructions: dict[str, str] = field(default_factory=dict)
    few_shot: bool = True
    name: str = "prompt"

    def __post_init__(self) -> None:
        self.system = _fill(self.config.get("system_prompt") or "", self.values, f"{self.name}: system_prompt")
        if self.style:
            self.system += format_instruction(self.instructions, self.style, self.values.get("num_samples"))
        self.template = self.config.get("template") or ""
        self.examples = [dict(m) for m in self.config.get("few_shot_examples") or []] if self.few_shot else []

    @classmethod
    def load(cls, document: str, **given: Any) -> Prompt:
        """From JSON text, which must be an object."""
        config = json.loads(document)
        if not isinstance(config, dict):
            raise ValueError("a prompt must be a JSON object")
        return cls(config, **given)

    def messages(self, **columns: Column) -> Column:
        """array of struct(role, content): system, examples, then the user's message; empty ones are left out."""
        values = {k: F.lit(str(v)) for k, v in self.values.items()} | columns
        if missing := {m[1] for m in _PLACE.finditer(self.template) if m[1]} - set(values):
            raise ValueError(f"{self.name}: template lacks {', '.join(sorted(missing))}")
        one = lambda role, content: F.struct(role.alias("role"), content.alias("content"))
        fixed = ([{"role": "system", "content": self.system}] if self.system else []) + self.examples
        head = F.array(*[one(F.lit(m["role"]), F.lit(m["content"])) for m in fixed]).cast(f"array<{MESSAGE}>")
        said = render(F.lit(self.template), **values)
        return F.when(said != "", F.concat(head, F.array(one(F.lit("user"), said)))).otherwise(head)
