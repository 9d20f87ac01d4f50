"""Chat layouts as data, compiled to column expressions.

A layout is a format string per role, in Python's format syntax, with the field ``{content}``. ``folded`` is for layouts that have no system
turn of their own: the format of the first user turn when a system message stands before it, with ``{system}`` and ``{content}``.
Anything else in a format (another field, a conversion, a format specification) is an error when the layout is made, and a message of a role that the layout
does not know is an error where it is rendered.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from string import Formatter

from pyspark.sql import Column
from pyspark.sql import functions as F

from sftlake.functions.once import bind
from sftlake.functions.text import strip

SYSTEM, USER = "system", "user"


def _compiled(text: str, fields: Mapping[str, Column]) -> Column:
    """The format string as a concatenation of literals and columns."""
    parts = []
    for literal, field, spec, conversion in Formatter().parse(text):
        if literal:
            parts.append(F.lit(literal))
        if field is not None:
            if field not in fields or spec or conversion:
                raise ValueError(f"layout knows {', '.join(f'{{{f}}}' for f in fields)}, not {field!r} in {text!r}")
            parts.append(fields[field])
    return F.concat(*parts) if parts else F.lit("")


@dataclass(frozen=True)
class ChatLayout:
    """``begin`` opens the text, ``opening`` the answer that is to be generated; ``trim`` strips white space off contents."""

    turns: Mapping[str, str]
    opening: str
    begin: str = ""
    folded: str | None = None
    trim: bool = False

    def __post_init__(self):
        for text in self.turns.values():
            self._fields(text, ("content",))
        if self.folded is not None:
            self._fields(self.folded, ("system", "content"))
            if SYSTEM in self.turns:
                raise ValueError("a layout either has a system turn or folds it")

    @staticmethod
    def _fields(text: str, known: tuple[str, ...]) -> None:
        """Raise unless the format has nothing but the known fields."""
        for _, field, spec, conversion in Formatter().parse(text):
            if field is not None and (field not in known or spec or conversion):
                raise ValueError(f"layout knows {', '.join(f'{{{f}}}' for f in known)}, not {field!r} in {text!r}")

    def _text(self, content: Column) -> Column:
        text = F.coalesce(content, F.lit(""))
        return strip(text) if self.trim else text

    def turn(self, role: Column, content: Column) -> Column:
        """One message of a role that has a format."""
        out = None
        for name, text in self.turns.items():
            value = _compiled(text, {"content": self._text(content)})
            out = F.when(role == name, value) if out is None else out.when(role == name, value)
        unknown = F.raise_error(F.concat(F.lit("layout has no role "), F.coalesce(role, F.lit("null"))))
        return unknown.cast("string") if out is None else out.otherwise(unknown)

    def render(self, messages: Column, generate: bool = True) -> Column:
        """An ``array<struct<role, content>>`` as text, with the opening of the answer unless ``generate`` is false."""
        end = F.lit(self.opening if generate else "")
        if self.folded is None:
            blocks = F.transform(messages, lambda m: self.turn(m["role"], m["content"]))
            return F.concat(F.lit(self.begin), F.array_join(blocks, ""), end)
        folds = F.coalesce(F.get(messages, F.lit(0))["role"] == SYSTEM, F.lit(False)) & F.coalesce(
            F.get(messages, F.lit(1))["role"] == USER, F.lit(False)
        )
        system = self._text(F.get(messages, F.lit(0))["content"])

        def block(m: Column, i: Column) -> Column:
            both = _compiled(self.folded, {"system": system, "content": self._text(m["content"])})
            return F.when(folds & (i == 0), F.lit("")).when(folds & (i == 1), both).otherwise(self.turn(m["role"], m["content"]))

        return F.concat(F.lit(self.begin), F.array_join(F.transform(messages, block), ""), end)

    def render_prompt(self, prompt: Column, system: str) -> Column:
        """System and user message plus the opening of the answer."""
        message = lambda role, content: F.struct(F.lit(role).alias("role"), content.alias("content"))
        return bind(F.array(message(SYSTEM, F.lit(system)), message(USER, prompt)), lambda messages: self.render(messages))


# Public layouts.
CHATML = ChatLayout(
    turns={role: f"<|im_start|>{role}\n{{content}}<|im_end|>\n" for role in (SYSTEM, USER, "assistant", "tool")},
    opening="<|im_start|>assistant\n",
)
HEADERS = ChatLayout(
    begin="<|begin_of_text|>",
    turns={
        role: f"<|start_header_id|>{role}<|end_header_id|>\n\n{{content}}<|eot_id|>" for role in (SYSTEM, USER, "assistant")
    },
    opening="<|start_header_id|>assistant<|end_header_id|>\n\n", trim=True,
)
INST = ChatLayout(
    begin="<s>", turns={USER: "[INST] {content} [/INST]", "assistant": " {content} </s>"}, opening="",
    folded="[INST] <<SYS>>\n{system}\n<</SYS>>\n\n{content} [/INST]", trim=True,
)
MODEL_TURNS = ChatLayout(
    begin="<bos>",
    turns={USER: "<start_of_turn>user\n{content}<end_of_turn>\n", "assistant": "<start_of_turn>model\n{content}<end_of_turn>\n"},
    opening="<start_of_turn>model\n", folded="<start_of_turn>user\n{system}\n\n{content}<end_of_turn>\n", trim=True,
)
LAYOUTS = {"chatml": CHATML, "headers": HEADERS, "inst": INST, "model_turns": MODEL_TURNS}
