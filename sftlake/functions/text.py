"""Text functions over string columns.

Everything here is built from JVM string functions; the two places that need a
regular expression (fences and tokens) are guarded or single-pass.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from sftlake.functions.once import bind

# The tags of a formatted response.
THINK_OPEN, THINK_CLOSE = "<think>", "</think>"
ANSWER_OPEN, ANSWER_CLOSE = "<answer>", "</answer>"
TAGS = (THINK_OPEN, THINK_CLOSE, ANSWER_OPEN, ANSWER_CLOSE)

# The characters Python's str.strip() and str.split() treat as whitespace.
WHITESPACE = "".join(map(chr, (
    *range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680,
    *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
)))

# Unicode whitespace and the four separators that Python counts too.
_BLANKS = r"[\s\x1c-\x1f]*+"
_WORD = r"[^\s\x1c-\x1f]++"
_FENCE = r"```[\s\S]*?```"
_CODE_FENCE = r"```(?:python)?\n([\s\S]*?)```"
_CONTROL = r"<\|[^|]*+\|>"
# No two of them can start with the same character, but for a control token and "<".
_PIECES = (r"\p{L}++", r"[^\s\p{L}\p{N}<]++", r"\p{N}", _CONTROL, "<")


def strip(text: Column) -> Column:
    """Remove whitespace of any Unicode kind from both ends."""
    return F.btrim(text, F.lit(WHITESPACE))


def _after(text: Column, opening: str) -> Column:
    """The rest of ``text`` behind the first ``opening`` (which must occur)."""
    return F.substring(text, F.instr(text, opening) + F.lit(len(opening)), F.length(text))


def _has_pair(text: Column, opening: str, closing: str) -> Column:
    """True when the first ``opening`` is followed by a ``closing``."""
    return text.contains(opening) & _after(text, opening).contains(closing)


def _body(text: Column, opening: str, closing: str) -> Column:
    return F.substring_index(_after(text, opening), closing, 1)


def extract_think(output: Column) -> Column:
    """Reasoning trace of a raw output.

    The body of the first closed ``<think>`` pair, even when empty; else the text
    without fenced blocks; else, when nothing is left, the text itself.
    """
    prose = bind(
        strip(F.regexp_replace(output, _FENCE, "")),
        lambda p: F.when(p != "", p).otherwise(strip(output)),
    )
    return (
        F.when(_has_pair(output, THINK_OPEN, THINK_CLOSE), strip(_body(output, THINK_OPEN, THINK_CLOSE)))
        .when(output.contains("```"), prose)
        .otherwise(strip(output))
    )


def format_response(think: Column, code: Column) -> Column:
    """Reasoning and code in the tagged layout a training response must have."""
    return F.concat(
        F.lit(f"{THINK_OPEN}\n"), think,
        F.lit(f"\n{THINK_CLOSE}\n{ANSWER_OPEN}\n"), code,
        F.lit(f"\n{ANSWER_CLOSE}"),
    )


def strip_control_tokens(text: Column) -> Column:
    """Remove ``<|...|>`` control tokens."""
    return F.when(text.contains("<|"), F.regexp_replace(text, _CONTROL, "")).otherwise(text)


def has_all_tags(text: Column) -> Column:
    flag = text.contains(TAGS[0])
    for tag in TAGS[1:]:
        flag = flag & text.contains(tag)
    return flag


def has_answer_tags(text: Column) -> Column:
    return text.contains(ANSWER_OPEN) & text.contains(ANSWER_CLOSE)


def _count(text: Column, pattern: str, blanks: str) -> Column:
    """Number of matches of a pattern that covers all but blanks; null text has none.

    Every match becomes one letter together with the blanks around it, so the length is
    the count and no array of strings is built. Text of blanks alone is left over, and trimmed.
    """
    letters = F.regexp_replace(text, f"{blanks}(?:{pattern}){blanks}", "x")
    return F.coalesce(F.length(strip(letters)), F.lit(0))


def word_count(text: Column) -> Column:
    """Number of whitespace-separated words; null text has none."""
    return _count(text, _WORD, "(?U)" + _BLANKS)


def token_pattern(special_tokens: Sequence[str] = ()) -> str:
    """Pre-token pattern; special tokens win over the pieces they consist of."""
    specials = sorted(special_tokens, key=len, reverse=True)
    return "|".join([*(re.escape(s) for s in specials), *_PIECES])


def tokens(text: Column, special_tokens: Sequence[str] = ()) -> Column:
    """Deterministic native pre-tokens: letter runs, single digits, punctuation runs, ``<`` alone."""
    return F.regexp_extract_all(text, F.lit(token_pattern(special_tokens)), F.lit(0))


def pieces(text: Column, special_tokens: Sequence[str] = ()) -> Column:
    """`tokens` with the runs of white space between them, so that the pieces of a text joined are the text."""
    return F.regexp_extract_all(text, F.lit(token_pattern(special_tokens) + r"|\s++"), F.lit(0))


def token_count(text: Column, special_tokens: Sequence[str] = ()) -> Column:
    """Length of `tokens`, without making them."""
    return _count(text, token_pattern(special_tokens), r"\s*+")


def check_format(text: Column) -> Column:
    """Six layout flags of a model output as a struct."""
    think_open, think_close = text.contains(THINK_OPEN), text.contains(THINK_CLOSE)
    answer_open, answer_close = text.contains(ANSWER_OPEN), text.contains(ANSWER_CLOSE)
    tail = strip(strip_control_tokens(F.substring_index(text, ANSWER_CLOSE, -1)))
    clean_end = ~answer_close | (tail == "")
    order_ok = think_open & answer_open & (F.instr(text, THINK_OPEN) < F.instr(text, ANSWER_OPEN))
    return F.struct(
        (think_open & think_close).alias("has_think"),
        (answer_open & answer_close).alias("has_answer"),
        (~think_open | F.ltrim(text, F.lit(WHITESPACE)).startswith(THINK_OPEN)).alias("clean_start"),
        clean_end.alias("clean_end"),
        order_ok.alias("order_ok"),
        (think_open & think_close & answer_open & answer_close & clean_end & order_ok).alias("fully_valid"),
    )


def extract_answer_code(text: Column) -> Column:
    """Code of a model output and where it came from, as ``struct<code, source>``.

    The first closed ``<answer>`` pair wins (``tag``, even when empty), then the last
    plain or python fence (``markdown``), else null and ``none``.
    """
    def found(code: Column, source: Column) -> Column:
        return F.struct(code.alias("code"), source.alias("source"))

    none = found(F.lit(None).cast("string"), F.lit("none"))
    fence = bind(
        F.try_element_at(F.regexp_extract_all(text, F.lit(_CODE_FENCE), F.lit(1)), F.lit(-1)),
        lambda last: F.when(last.isNotNull(), found(strip(last), F.lit("markdown"))).otherwise(none),
    )
    return (
        F.when(
            _has_pair(text, ANSWER_OPEN, ANSWER_CLOSE),
            found(strip(_body(text, ANSWER_OPEN, ANSWER_CLOSE)), F.lit("tag")),
        )
        .when(text.contains("```"), fence)
        .otherwise(none)
    )


def uses_stdin(code: Column) -> Column:
    """Code that would wait for input."""
    return code.contains("input(") | code.contains("sys.stdin")


def chat_block(role: Column, text: Column) -> Column:
    """One message in the public ChatML layout."""
    return F.concat(F.lit("<|im_start|>"), role, F.lit("\n"), text, F.lit("<|im_end|>\n"))


GENERATION_PROMPT = "<|im_start|>assistant\n"


def render_chat(prompt: Column, system: str) -> Column:
    """System and user message plus the opening of the assistant's turn."""
    return F.concat(
        chat_block(F.lit("system"), F.lit(system)),
        chat_block(F.lit("user"), F.coalesce(prompt, F.lit(""))),
        F.lit(GENERATION_PROMPT),
    )


def render_messages(messages: Column) -> Column:
    """Render an ``array<struct<role, content>>`` column, generation prompt included."""
    blocks = F.transform(messages, lambda m: chat_block(m["role"], m["content"]))
    return F.concat(F.array_join(blocks, ""), F.lit(GENERATION_PROMPT))
