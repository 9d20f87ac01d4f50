import pytest
from pyspark.sql import functions as F

from conftest import plan, rows
from sftlake.functions.text import token_count
from sftlake.operators import examples as ex


def built(spark, ids, prompt_len, max_length):
    df = spark.createDataFrame([(ids, prompt_len)], "full_ids array<int>, prompt_len int")
    return tuple(ex.build_example(df, max_length).select("input_ids", "labels", "attention_mask").first())


@pytest.mark.parametrize("ids, prompt_len, max_length, want", [
    ([1, 2, 3, 4, 9], 2, 10, ([1, 2, 3, 4, 9], [-100, -100, 3, 4, 9], [1] * 5)),
    ([1, 2, 3, 4, 9], 2, 5, ([1, 2, 3, 4, 9], [-100, -100, 3, 4, 9], [1] * 5)),
    ([1, 2, 3, 4, 9], 2, 4, ([1, 2, 3, 4], [-100, -100, 3, 4], [1] * 4)),
    ([1, 2, 3, 4, 9], 4, 3, ([1, 2, 3], [-100] * 3, [1] * 3)),
    ([1, 2, 3], 3, 3, ([1, 2, 3], [-100] * 3, [1] * 3)),
    ([1, 2, 3], 0, 3, ([1, 2, 3], [1, 2, 3], [1] * 3)),
])
def test_build_example(spark, ids, prompt_len, max_length, want):
    assert built(spark, ids, prompt_len, max_length) == want


def test_eos_rules(spark):
    # the last one is cut inside the prompt, exactly at an EOS id: kept, as only the last id is looked at
    df = spark.createDataFrame([([1, 9],), ([1, 2],), ([],), ([9],)], "input_ids array<int>")
    assert sorted(r[0] for r in rows(ex.drop_overlong(df, 9))) == [[1, 9], [9]]
    assert tuple(ex.eos_coverage(df, 9).first()) == (4, 2, 0.5, True)
    assert tuple(ex.drop_report(df, 9).first()) == (4, 2, 50.0)
    assert tuple(ex.eos_coverage(df.limit(0), 9).first()) == (0, 0, 0.0, True)


def test_collate(spark):
    df = spark.createDataFrame(
        [(0, [1, 2, 3], [-100, 2, 3], [1, 1, 1]), (0, [4], [4], [1]), (1, [5], [5], [1])],
        "batch_id int, input_ids array<int>, labels array<int>, attention_mask array<int>",
    )
    assert sorted(rows(ex.collate_pad(df, pad_id=7))) == [
        (0, [1, 2, 3], [-100, 2, 3], [1, 1, 1], 2, 3),
        (0, [4, 7, 7], [4, -100, -100], [1, 0, 0], 2, 3),
        (1, [5], [5], [1], 1, 1),
    ]


def test_encode_by_join_and_in_memory(spark):
    df = spark.createDataFrame([(1, ["a", "b", "a"]), (2, []), (3, None), (4, ["zz", "b"])], "k int, t array<string>")
    vocab = spark.createDataFrame([("a", 7), ("a", 5), ("b", 6)], "token string, id int")  # a token given twice
    want = [(1, [5, 6, 5]), (2, []), (3, None), (4, [0, 6])]
    assert sorted(rows(ex.encode_tokens(df, vocab, "t", "k", "ids").select("k", "ids"))) == want
    assert sorted(rows(ex.encode_tokens_in_memory(df, {"a": 5, "b": 6}, "t", "ids").select("k", "ids"))) == want


def test_held_vocabulary_has_the_tokens_of_all_conversations(spark, tmp_path):
    from sftlake.plans import catalog

    spark.createDataFrame([(0, "alpha")], "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    said = [(c, t, ("user", "assistant")[t % 2], f"word{'abcdefgh'[c]} beta{'xy'[t % 2]} again") for c in range(8) for t in range(4)]
    spark.createDataFrame(said, "conv_id bigint, turn bigint, role string, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    held, joined = (sorted(rows(catalog.QUERIES[q](spark, str(tmp_path)).select("ord", "input_ids"))) for q in ("encode_tokens_in_memory", "encode_tokens"))
    assert held == joined and len(held) == 16
    assert len({i for _, ids in held for i in ids.split()}) > 8  # words that no benchmark item has are known


def test_null_and_repeated_keys_lose_and_mix_nothing(spark):
    df = spark.createDataFrame(
        [(None, "p q", "r"), (None, "q", "r r"), (7, "p", "q"), (7, "r", None), (7, "r", None), (8, None, "p"), (9, "q", "p")],
        "ord bigint, prompt string, response string",
    )
    table = spark.createDataFrame([("p", 1), ("q", 2), ("r", 3), ("user", 4)], "token string, id int")
    held = {r.token: r.id for r in table.collect()}
    joined, in_memory = (
        sorted(rows(ex.tokenised_examples(df, v, "S", ex.EOS, 100).select("ord", "prompt", "response", "input_ids", "labels")), key=str)
        for v in (table, held)
    )
    assert len(joined) == 7 and joined == in_memory
    words = spark.createDataFrame([(None, ["p", "q"]), (None, ["r"]), (1, ["q"]), (1, ["p", "p"]), (1, ["q"]), (None, [])], "k int, t array<string>")
    by_join, by_map = (
        sorted(rows(f.select("k", "t", "ids")), key=str)
        for f in (ex.encode_tokens(words, table, "t", "k", "ids"), ex.encode_tokens_in_memory(words, held, "t", "ids"))
    )
    assert by_join == by_map


def test_examples_with_a_plugged_tokenizer(spark):
    from sftlake.functions.tokenizer import with_tokenizer

    df = spark.createDataFrame([(1, "p q", "r"), (2, "", None)], "ord int, prompt string, response string")
    encode = with_tokenizer(lambda: lambda texts: [list(t.encode()) for t in texts])
    got = {r.ord: r for r in ex.plugged_examples(df, encode, "S", "<end>", 1000).collect()}
    texts = {r.ord: (r.rendered, r.full_text) for r in ex.example_text(df, "S", "<end>").collect()}
    for i, (prompt, full) in texts.items():
        assert got[i].input_ids == list(full.encode())
        assert got[i].labels == [-100] * len(prompt.encode()) + list(full.encode())[len(prompt.encode()) :]


def test_conversation_in_all_forms(spark):
    turns = spark.createDataFrame(
        [(1, 1, "assistant", "b <|x"), (1, 0, "user", "a"), (2, 0, "user", None), *((3, i, "user", str(i)) for i in range(10))],
        "conv_id int, turn bigint, role string, text string",
    )
    whole = {r.conv_id: r.text for r in ex.render_conversation(turns).collect()}
    assert whole[1] == "<|im_start|>user\na<|im_end|>\n<|im_start|>assistant\nb <|x<|im_end|>\n<|im_start|>assistant\n"
    blocks = {}
    for r in sorted(ex.render_turns(turns).collect()):
        blocks[r.conv_id] = blocks.get(r.conv_id, "") + r.block
    assert whole == blocks
    count = token_count(F.col("text"), ex.SPECIAL_TOKENS)
    assert dict(rows(ex.conversation_tokens(turns))) == dict(rows(ex.render_conversation(turns).select("conv_id", count)))


@pytest.mark.parametrize("first, n", [(0, 4096), (4090, 10)])
def test_a_conversation_is_one_row(spark, first, n):
    turns = spark.range(first, first + n).selectExpr("7 conv_id", "id turn", "'user' role", "cast(id as string) text")
    (r,) = ex.render_conversation(turns).collect()
    assert r.text == "".join(f"<|im_start|>user\n{i}<|im_end|>\n" for i in range(first, first + n)) + "<|im_start|>assistant\n"


def test_step_plan(spark):
    df = spark.createDataFrame([("train",)] * 37 + [("val",)] * 5, "split string")
    one = {r.split: tuple(r)[1:] for r in ex.step_plan(df, 4, 1, 3, 2).collect()}
    assert one == {"train": (37, 10, 8, 12), "val": (5, 2, 2, 12)}
    two = {r.split: tuple(r)[1:] for r in ex.step_plan(df, 4, 2, 3, 2).collect()}
    assert two == {"train": (37, 4, 4, 24), "val": (5, 0, 0, 24)}


@pytest.mark.parametrize("n, drop_last", [(1, False), (700, False), (700, True), (703, True)])
def test_batch_and_pad_equals_two_steps(spark, monkeypatch, n, drop_last):
    from sftlake.operators import ordering

    df = spark.range(n).select(
        F.col("id").alias("ord"), F.sequence(F.lit(1), (F.col("id") % 9 + 1).cast("int")).alias("input_ids")
    ).withColumn("labels", F.col("input_ids")).withColumn("attention_mask", F.col("input_ids"))
    for digits in (1, 4):  # long prefixes with inner batches, and short ones with edges only
        monkeypatch.setattr(ordering, "DIGEST_DIGITS", digits)
        one = ex.batch_and_pad(df, 8, drop_last=drop_last)
        two = ex.collate_pad(ex.assign_batches(df, 8, drop_last=drop_last))
        assert sorted(rows(one.select(two.columns))) == sorted(rows(two))


def test_batch_and_pad_shuffles_examples_once(spark):
    df = spark.range(100).select(
        F.col("id").alias("ord"), F.array(F.lit(1)).alias("input_ids"), F.array(F.lit(1)).alias("labels"),
        F.array(F.lit(1)).alias("attention_mask"),
    )
    out = ex.batch_and_pad(df, 8)
    out.collect()
    final = plan(out).split("== Initial Plan ==")[0]
    assert "ReusedExchange" in final
