"""Training examples: chat rendering, encoding, label masks, batches and padding."""

from __future__ import annotations

from collections.abc import Callable, Mapping

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W
from pyspark.sql.window import WindowSpec

from sftlake.functions import text as tx
from sftlake.functions.layouts import ChatLayout
from sftlake.operators.ordering import digest, int_div, number_by_digest, number_by_position
from sftlake.session import stored

#: Label of a position that takes no part in the loss.
MASKED = -100
EOS = "<|im_end|>"
SPECIAL_TOKENS = (*tx.TAGS, "<|im_start|>", EOS)


def _block() -> Column:
    return tx.chat_block(F.col("role"), F.coalesce("text", F.lit("")))


def render_turns(turns: DataFrame) -> DataFrame:
    """One rendered block per turn of ``(conv_id, turn, role, text)``, and one more that
    opens the assistant's answer. The blocks of a conversation in turn order are its text."""
    opening = turns.groupBy("conv_id").agg((F.max("turn") + F.lit(1)).alias("turn")).withColumn(
        "block", F.lit(tx.GENERATION_PROMPT)
    )
    return turns.select("conv_id", "turn", _block().alias("block")).unionByName(opening)


def render_conversation(turns: DataFrame) -> DataFrame:
    """The whole text of each conversation, one row each.

    Blocks are joined per 1,024 turn numbers first, then these parts in order, so no group holds more
    than parts until the row that is the result. `render_turns` suits conversations without bound.
    """
    def joined(order: str, text: str) -> Column:
        return F.array_join(F.array_sort(F.collect_list(F.struct(order, text))).getField(text), "").alias(text)

    part = int_div(F.col("turn"), 1024).alias("part")
    parts = render_turns(turns).withColumnRenamed("block", "text").groupBy("conv_id", part).agg(joined("turn", "text"))
    return parts.groupBy("conv_id").agg(joined("part", "text"))


def conversation_tokens(turns: DataFrame) -> DataFrame:
    """Token count of every rendered conversation, without assembling it.

    Each block starts and ends with a control token or line, so counts of blocks add up.
    """
    opening = tx.token_count(F.lit(tx.GENERATION_PROMPT), SPECIAL_TOKENS)
    counts = turns.select("conv_id", tx.token_count(_block(), SPECIAL_TOKENS).cast("bigint").alias("n"))
    return counts.groupBy("conv_id").agg((F.sum("n") + opening).alias("tokens"))


def encode_tokens(
    df: DataFrame, vocab: DataFrame, tokens: str, key: str | None = None, ids: str = "input_ids", unknown_id: int = 0
) -> DataFrame:
    """Replace a token array by ids of a vocabulary ``(token, id)``; rows keep their place.

    The vocabulary is joined, whatever its size; of a token's several ids the smallest counts. Rows are written once with a number of
    their own, so the tokens are made once, and a null or repeated ``key`` (which is not looked at) is no different from others;
    what moves is (row, place, token), then an array of ids per row. Tokens that most rows hold are split by the adaptive skew join.
    """
    table = vocab.groupBy("token").agg(F.min("id").cast("int").alias("id"))
    rows = stored(df.withColumn("_row", F.monotonically_increasing_id()), "encode-rows")
    words = rows.select(F.col("_row").alias("_at"), F.posexplode(tokens).alias("_pos", "token"))
    code = F.coalesce(F.col("id"), F.lit(unknown_id)).cast("int")
    coded = words.join(table, "token", "left").groupBy("_at").agg(
        F.array_sort(F.collect_list(F.struct("_pos", code.alias("id")))).getField("id").alias(ids)
    )
    empty = F.when(F.col(tokens).isNotNull(), F.array().cast("array<int>"))
    return rows.join(coded, F.col("_row") == F.col("_at"), "left").withColumn(ids, F.coalesce(F.col(ids), empty)).drop("_row", "_at")


def encode_tokens_in_memory(
    df: DataFrame, vocab: Mapping[str, int], tokens: str, ids: str = "input_ids", unknown_id: int = 0
) -> DataFrame:
    """`encode_tokens` with a vocabulary that the caller holds, as a tokenizer does.

    It travels to the tasks, where whole Arrow batches are looked up; nothing is shuffled or joined.
    """
    known, codes = pa.array(list(vocab), pa.string()), pa.array(list(vocab.values()), pa.int32())

    @F.arrow_udf("array<int>")
    def lookup(batch: pa.Array) -> pa.Array:
        found = codes.take(pc.index_in(pc.list_flatten(batch), value_set=known)).fill_null(unknown_id)
        ends = pc.cumulative_sum(pc.list_value_length(batch).fill_null(0))
        offsets = pa.concat_arrays([pa.array([0], pa.int32()), ends.cast(pa.int32())])
        return pa.ListArray.from_arrays(offsets, found, mask=batch.is_null())

    return df.withColumn(ids, lookup(F.col(tokens)))


def rendered_prompt(system: str, layout: ChatLayout | None = None) -> Column:
    """The ``prompt`` column in a chat layout, ChatML unless another is given."""
    return tx.render_chat(F.col("prompt"), system) if layout is None else layout.render_prompt(F.col("prompt"), system)


def example_text(df: DataFrame, system: str, eos: str = EOS, layout: ChatLayout | None = None) -> DataFrame:
    """Add ``rendered`` (the prompt in chat layout) and ``full_text`` (with answer and EOS)."""
    return df.withColumn("rendered", rendered_prompt(system, layout)).withColumn(
        "full_text", F.concat("rendered", F.coalesce("response", F.lit("")), F.lit(eos))
    )


def build_example(
    df: DataFrame, max_length: int, ids: str = "full_ids", prompt_len: str = "prompt_len"
) -> DataFrame:
    """Cut to ``max_length``, mask the prompt in the labels, add the attention mask.

    Input is the whole encoded sequence and the number of prompt tokens. A prompt that
    fills the window leaves every label masked.
    """
    kept = F.slice(F.col(ids), 1, max_length)
    size = F.size("input_ids")
    masked = F.least(F.col(prompt_len), size)
    return (
        df.withColumn("input_ids", kept)
        .withColumn(
            "labels",
            F.concat(
                F.array_repeat(F.lit(MASKED), masked),
                F.slice(F.col("input_ids"), masked + F.lit(1), size),
            ),
        )
        .withColumn("attention_mask", F.array_repeat(F.lit(1), size))
        .drop(ids, prompt_len)
    )


def tokenised_examples(
    df: DataFrame, vocab: DataFrame | Mapping[str, int], system: str, eos: str, max_length: int, unknown_id: int = 0,
    key: str = "ord",
) -> DataFrame:
    """SFT records to examples: render, tokenise natively, encode, truncate and mask.

    A vocabulary table is joined, one that the caller holds travels along; both keep every record, also of a null or repeated ``key``.
    """
    answer = F.concat(F.coalesce("response", F.lit("")), F.lit(eos))
    # No token reaches over the end of the rendered prompt: it ends in a newline, which only
    # a control token could contain, and that would have to contain the one before it.
    parts = df.withColumns({
        "_prompt": tx.tokens(tx.render_chat(F.col("prompt"), system), SPECIAL_TOKENS),
        "_answer": tx.tokens(answer, SPECIAL_TOKENS),
    })
    pieces = parts.select(
        *df.columns,
        F.slice(F.concat("_prompt", "_answer"), 1, max_length).alias("_tokens"),
        F.size("_prompt").alias("prompt_len"),
    )
    if isinstance(vocab, DataFrame):
        coded = encode_tokens(pieces, vocab, "_tokens", key, "full_ids", unknown_id).drop("_tokens")
    else:
        coded = encode_tokens_in_memory(pieces, vocab, "_tokens", "full_ids", unknown_id).drop("_tokens")
    return build_example(coded, max_length)


def plugged_examples(
    df: DataFrame, encode: Callable[[Column], Column], system: str, eos: str, max_length: int, layout: ChatLayout | None = None
) -> DataFrame:
    """`tokenised_examples` with any tokenizer, as a column function ``text -> array<int>``
    (`with_tokenizer` makes one). Whole text and prompt are encoded separately, since a
    trained tokenizer may merge across their boundary; only the prompt's length is used."""
    texts = example_text(df, system, eos, layout)
    coded = texts.select(*df.columns, encode(F.col("full_text")).alias("full_ids"), encode(F.col("rendered")).alias("_prompt"))
    return build_example(coded.withColumn("prompt_len", F.size("_prompt")).drop("_prompt"), max_length)


def ends_with(eos_id: int, ids: str = "input_ids") -> Column:
    return F.coalesce(F.try_element_at(F.col(ids), F.lit(-1)) == F.lit(eos_id), F.lit(False))


def drop_overlong(examples: DataFrame, eos_id: int) -> DataFrame:
    """Keep examples that still end in EOS, as an untruncated one does."""
    return examples.where(ends_with(eos_id))


def eos_coverage(examples: DataFrame, eos_id: int, threshold: float = 0.95) -> DataFrame:
    """Share of examples that keep their EOS, with a warning below ``threshold``."""
    share = F.col("with_eos").cast("double") / F.greatest(F.col("examples"), F.lit(1))
    return examples.agg(
        F.count(F.lit(1)).alias("examples"), F.count_if(ends_with(eos_id)).alias("with_eos")
    ).select("examples", "with_eos", share.alias("share"), (share < threshold).alias("warn"))


def drop_report(examples: DataFrame, eos_id: int) -> DataFrame:
    """What `drop_overlong` removes."""
    total = F.greatest(F.col("total"), F.lit(1)).cast("double")
    return examples.agg(
        F.count(F.lit(1)).alias("total"), F.count_if(~ends_with(eos_id)).alias("dropped")
    ).withColumn("kept_pct", F.lit(100.0) * (F.col("total") - F.col("dropped")) / total)


def _numbered(
    df: DataFrame, batch_size: int, order: str, shuffle: bool, seed: int, drop_last: bool
) -> DataFrame:
    if shuffle:
        rows = number_by_digest(df, digest(F.col(order), seed), order)
    else:
        rows = number_by_position(df, order)
    if drop_last:
        rows = rows.where(F.col("_rn") < F.col("_total") - F.pmod(F.col("_total"), F.lit(batch_size)))
    return rows.withColumn("batch_id", int_div(F.col("_rn"), batch_size)).withColumn(
        "pos_in_batch", F.pmod(F.col("_rn"), F.lit(batch_size)).cast("int")
    )


def assign_batches(
    df: DataFrame, batch_size: int, order: str = "ord", shuffle: bool = True,
    seed: int = 42, drop_last: bool = False,
) -> DataFrame:
    """Add ``batch_id`` and ``pos_in_batch``; batches have ``batch_size`` rows.

    A shuffle orders rows by a seeded digest of ``order``, else they keep its order.
    ``drop_last`` removes the last batch when it is not full.
    """
    rows = _numbered(df, batch_size, order, shuffle, seed, drop_last)
    return rows.select(*df.columns, "batch_id", "pos_in_batch")


_FILLED = ("input_ids", "labels", "attention_mask")


def _pad(examples: DataFrame, peers: WindowSpec, pad_id: int) -> DataFrame:
    """Pad to the longest example of the window and report the batch's shape."""
    def padded(column: str, value: int) -> Column:
        return F.concat(F.col(column), F.array_repeat(F.lit(value), F.col("_padding"))).alias(column)

    return (
        examples.withColumn("batch_width", F.max(F.size("input_ids")).over(peers))
        .withColumn("batch_rows", F.count(F.lit(1)).over(peers))
        .withColumn("_padding", F.col("batch_width") - F.size("input_ids"))
        .select(
            *(c for c in examples.columns if c not in _FILLED),
            padded("input_ids", pad_id), padded("labels", MASKED), padded("attention_mask", 0),
            "batch_rows", "batch_width",
        )
    )


def collate_pad(examples: DataFrame, pad_id: int = 0, batch: str = "batch_id") -> DataFrame:
    """Pad every example to the longest of its batch and report the batch's shape.

    The window holds one batch, so its size is bounded by the batch size.
    """
    return _pad(examples, W.partitionBy(batch), pad_id)


def batch_and_pad(
    examples: DataFrame, batch_size: int, pad_id: int = 0, order: str = "ord", seed: int = 42,
    drop_last: bool = False,
) -> DataFrame:
    """Shuffled batches and their padding, with one shuffle of the examples.

    Numbering puts examples together by digest prefix, and all but the batches at the
    edges of a prefix lie within one. Those are padded where they are; only the edge
    batches, at most 65,536 of them, are brought together.
    """
    rows = _numbered(examples, batch_size, order, True, seed, drop_last)
    whole = (F.col("batch_id") * batch_size >= F.col("_from")) & (
        F.least((F.col("batch_id") + F.lit(1)) * batch_size, F.col("_total")) <= F.col("_to")
    )
    inner = _pad(rows.where(whole), W.partitionBy("_bucket", "batch_id"), pad_id)
    edges = _pad(rows.where(~whole), W.partitionBy("batch_id"), pad_id)
    kept = [*examples.columns, "batch_id", "pos_in_batch", "batch_rows", "batch_width"]
    return inner.select(kept).unionByName(edges.select(kept))


def step_plan(
    df: DataFrame, batch_size: int, workers: int, accum: int, epochs: int, split: str = "split"
) -> DataFrame:
    """Batches per worker, optimizer steps and effective batch size of each split.

    With several workers an incomplete last batch, and batches that do not go round, are dropped.
    """
    rows = F.col("rows")
    if workers > 1:
        batches = F.floor(F.floor(rows / F.lit(batch_size)) / F.lit(workers))
    else:
        batches = F.ceil(rows / F.lit(batch_size))
    return df.groupBy(split).agg(F.count(F.lit(1)).alias("rows")).withColumn(
        "batches", batches.cast("bigint")
    ).withColumn(
        "optimizer_steps", (F.ceil(F.col("batches") / F.lit(accum)) * F.lit(epochs)).cast("bigint")
    ).withColumn("effective_batch", F.lit(batch_size * workers * accum).cast("bigint"))
