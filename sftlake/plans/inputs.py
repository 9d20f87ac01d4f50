"""The inputs of the queries, derived from the given tables.

The tables hold prose, chats, events and orders; these functions shape them into a raw
corpus, model outputs, run logs and checkpoints. All of it is computed by Spark from the
whole tables. `SQL` has the same derivations as common table expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sftlake.functions import text as tx
from sftlake.functions.once import computed
from sftlake.functions.schedule import checkpoint_name, lr_cosine, wall_micros
from sftlake.operators.checkpoints import REQUIRED_FILES
from sftlake.operators.decode import byte_vocabulary
from sftlake.operators.examples import SPECIAL_TOKENS
from sftlake.operators.losses import with_target
from sftlake.operators.ordering import int_div
from sftlake.operators.sharded import shard_logits
from sftlake.session import shared_dir, stored
from sftlake.sources.folders import write_text_files

SYSTEM = "You fix code. Think first, then answer."
WARMUP, TOTAL, PEAK = 50, 189, 2e-5  # fixed values: the published run's schedule, which the learning-rate audit looks for
FILES = (*REQUIRED_FILES, "training_state.pt")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    if name == "documents":
        # The small fixtures are one row group, which one task would read and work on alone.
        df = df.repartition(spark.sparkContext.defaultParallelism, "doc_id")
    return df


def cases(selector: Column, *values: Column | str | None) -> Column:
    """``CASE selector WHEN 0 THEN values[0] ...``; strings are literals."""
    out = None
    for i, value in enumerate(values):
        value = value if isinstance(value, Column) else F.lit(value)
        out = F.when(selector == i, value) if out is None else out.when(selector == i, value)
    return out


def raw_from_documents(docs: DataFrame, once: bool = True) -> DataFrame:
    """The corpus; ``once`` computes ``output`` as if it were stored, instead of where it is used."""
    doc, text = F.col("doc_id"), F.col("text")
    output = cases(
        F.pmod(int_div(doc, 20), F.lit(8)),
        "", None, text,
        F.concat(text, F.lit("\n```python\nprint(1)\n```")),
        F.concat(F.lit("```python\n"), text, F.lit("\n```")),
        F.concat(F.lit("<think></think>"), text),
        F.concat(F.lit("<think>"), text),
        F.concat(F.lit("<think>\n"), text, F.lit("\n</think>tail")),
    )
    solution = F.when(doc % 11 == 0, "").when(doc % 13 != 0, F.concat(F.lit("print("), doc, F.lit(")")))
    shaped = computed(docs, output=output) if once else docs.withColumn("output", output)
    return shaped.select(
        doc.alias("ord"),
        F.concat_ws("/", "source", "lang", doc % 7).alias("input"), "output", solution.alias("solution"),
        F.concat(F.lit("L"), F.col("n_chars") % 5).alias("difficulty"), "source",
    )


def raw_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_from_documents(table(spark, sf_dir, "documents"))


def raw_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus for queries on its short columns: the texts are not read."""
    return raw_from_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"), once=False).drop("output")


def model_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, tasks = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    doc, text = F.col("doc_id"), F.col("text")
    think = F.concat(F.lit("<think>"), text, F.lit("</think>"))
    output = cases(
        F.pmod(int_div(doc, 20), F.lit(9)),
        F.concat(F.lit("<think>\n"), text, F.lit("\n</think>\n<answer>\nprint("), doc, F.lit(")\n</answer><|im_end|>")),
        F.concat(F.lit("Sure. "), think, F.lit("<answer>x = input()\n</answer>")),
        F.concat(F.lit("<answer>print(1)</answer>"), think),
        F.concat(text, F.lit("\n```python\nprint('a')\n```\nor\n```\nprint('b')\n```")),
        F.concat(think, F.lit("<answer></answer>")),
        F.concat(F.lit("<think>"), text),
        F.concat(think, F.lit("<answer>print(2)</answer> and some more words")),
        "",
        F.concat(think, F.lit("<answer>print(3)</answer></answer><|endoftext|>")),
    )
    shown = tasks.select(F.col("item_id").alias("_item"), F.col("text").alias("_task_text"))
    items = tasks.agg(F.count(F.lit(1))).scalar()
    return (
        computed(docs.withColumn("_item", doc % items).join(shown, "_item"), output=output)
        .select(
            "doc_id", F.concat(F.lit("task"), "_item").alias("name"), "output",
            F.when(doc % 3 == 0, F.col("_task_text")).otherwise(text).alias("stdout"),
            (doc % 17 == 0).alias("timed_out"),
            F.when(doc % 50 == 0, F.lit(0)).otherwise(F.col("n_chars")).cast("bigint").alias("elapsed_ms"),
        )
        .withColumn("elapsed", (F.col("elapsed_ms").cast("decimal(15,0)") * F.expr("0.001BD")).cast("decimal(18,3)"))
        .drop("elapsed_ms")
    )


def eval_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "benchmark").select(
        F.concat(F.lit("task"), "item_id").alias("name"), F.col("text").alias("prompt"),
        F.col("text").alias("expected_output"),
    )


def sft_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User turns that are answered by the next turn; joined on the turn, so that a long
    conversation is no hot key."""
    turns = table(spark, sf_dir, "conversations")
    asked = turns.where("role = 'user'").select("conv_id", "turn", F.col("text").alias("prompt"))
    answered = turns.where("role = 'assistant'").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("response")
    )
    return asked.join(answered, ["conv_id", "turn"]).select(
        (F.shiftleft("conv_id", 32) + F.col("turn")).alias("ord"), "prompt", "response",
        F.concat(F.lit("print("), "turn", F.lit(")")).alias("solution"),
        F.concat(F.lit("L"), F.col("turn") % 3).alias("difficulty"),
        F.concat(F.lit("c"), F.col("conv_id") % 5).alias("source"),
    )


def vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Special tokens and the tokens of the benchmark and of all conversations, with ids from a digest; an eighth of the
    tokens, by digest, is left out, so that there are unknown ones."""
    texts = table(spark, sf_dir, "benchmark").select("text").unionByName(table(spark, sf_dir, "conversations").select("text"))
    known = texts.select(F.explode(tx.tokens(F.col("text"))).alias("token")).distinct().where(~F.right(F.md5("token"), F.lit(1)).isin("0", "1"))
    return _with_ids(known)


def _with_ids(words: DataFrame) -> DataFrame:
    code = F.conv(F.substring(F.md5("token"), 1, 5), 16, 10).cast("int") + F.lit(1000)
    fixed = words.sparkSession.createDataFrame([(t, i + 1) for i, t in enumerate(SPECIAL_TOKENS)], "token string, id int")
    return words.select("token", code.alias("id")).unionByName(fixed)


def piece_vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vocabulary for exact ids: the bytes, the special tokens, and the pieces of all conversations but an eighth by digest."""
    said = table(spark, sf_dir, "conversations").select(F.explode(tx.pieces(F.col("text"), SPECIAL_TOKENS)).alias("piece")).distinct()
    return byte_vocabulary(said.where(~F.right(F.md5("piece"), F.lit(1)).isin("0", "1")), SPECIAL_TOKENS)


EOS_ID = len(SPECIAL_TOKENS)


def logits(spark: SparkSession, sf_dir: str) -> DataFrame:
    vec = F.col("vec_id")
    return table(spark, sf_dir, "embeddings").select(
        int_div(vec, 10).alias("seq_id"), (vec % 10).cast("int").alias("pos"),
        F.when(vec % 10 < 3, F.lit(-100)).otherwise(F.col("label")).cast("int").alias("label"),
        F.col("embedding").alias("logits"),
    )


def targeted_logits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The logits as a trainer writes them that knows the next label: a stored table with ``target``."""
    return stored(with_target(logits(spark, sf_dir)), "logits-with-target")


def logit_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same in blocks of 16 classes, without the labels."""
    return stored(shard_logits(with_target(logits(spark, sf_dir)).drop("label"), 16), "logit-shards")


def batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Micro-batches of two workers: 4,000 events make a run, 400 an epoch."""
    event, user = F.col("event_id"), F.col("user_id")

    def hundredths(x: Column) -> Column:
        # few digits, so that sums are added up as plain longs
        return (x.cast("decimal(8,0)") * F.expr("0.01BD")).cast("decimal(8,2)")

    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("run"), int_div(event, 4000)).alias("run_id"),
        (int_div(event % 4000, 400) + F.lit(1)).alias("epoch"),
        (event % 2).alias("rank"), int_div(event % 400, 2).alias("idx"),
        (F.round(F.col("value") * F.lit(100.0)).cast("decimal(8,0)") * F.expr("0.0001BD")).cast("decimal(8,4)").alias("loss"),
        (user + F.lit(1)).alias("tokens"), wall_micros(F.col("ts")).alias("ts_us"),
        hundredths(user).alias("entropy"), hundredths(event % 100).alias("token_acc"),
        hundredths(event % 7).alias("grad_norm"),
        (user * F.lit(100000000)).alias("mem_alloc"), (user * F.lit(150000000)).alias("mem_reserved"),
    )


START_US = 1_704_067_200_000_000  # 2024-01-01, the first day of the events


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One logged row per event; every tenth has a validation loss instead of a training loss."""
    step = F.col("event_id")
    is_val = step % 10 == 9
    loss = F.col("value") / F.lit(100.0)
    speed = F.when(F.col("event_type").isin("click", "view"), F.lit(2)).otherwise(F.lit(1))
    intended = lr_cosine(step % (TOTAL + 1) * speed, WARMUP, TOTAL, PEAK)
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("run_id"), step.alias("_step"),
        ((wall_micros(F.col("ts")) - F.lit(START_US)) / F.lit(1e6)).alias("_runtime"),
        F.when(~is_val, loss).alias("train_loss"), F.when(is_val, loss).alias("val_loss"),
        F.when(~is_val, intended).alias("train_lr"),
    )


def validation_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three validation passes an epoch, of 70, 70 and 60 batches per worker; the last one ends the epoch."""
    rows = batches(spark, sf_dir)
    at = int_div(F.col("idx"), 70)
    return rows.withColumn("step", F.col("epoch") * 3 + at).withColumn("mid", at < 2).withColumn("idx", F.col("idx") % 70)


def checkpoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    epoch = (key % 5).cast("int")
    return table(spark, sf_dir, "orders").select(
        (F.col("o_custkey") % 50).alias("run_id"), epoch.alias("epoch"), key.alias("step"),
        F.when(F.col("o_orderstatus") == "F", "mid").otherwise("epoch").alias("kind"),
        F.when(key % 11 != 0, F.floor(F.col("o_totalprice") / F.lit(1000.0)) / F.lit(100.0)).alias("val_loss"),
        checkpoint_name(epoch, key).alias("name"),
        F.concat(F.when(key % 13 == 0, "/elsewhere/").otherwise("/out/"), checkpoint_name(epoch, key)).alias("path"),
        (key % 4 != 0).alias("optimizer"),
        F.col("o_orderdate").cast("date").alias("mtime"),
    )


FOLDER_LAYOUT = r"run_id=([^/]+)/checkpoint=([^/]+)/file=([^/]+)/"
STATE_FILE = "training_state.json"


def checkpoint_folders(spark: SparkSession, sf_dir: str) -> str:
    """The root of a tree of checkpoint folders, written from the suppliers: a folder each, some lacking files, some with malformed documents."""
    k = F.col("s_suppkey")
    config = cases(k % 5, '{"model_type": "m"}', "not json").otherwise(F.concat(F.lit('{"model_type": "m", "vocab_size": '), k, F.lit("}")))
    told = F.concat(F.lit('{"epoch": '), k % 3, F.lit(', "global_step": '), F.when(k % 6 == 0, k + F.lit(1)).otherwise(k))
    once = F.lit(1)
    texts = {
        "config.json": (config, once), "tokenizer.json": (F.lit("{}"), once),
        "tokenizer_config.json": (F.when(k % 4 == 0, '{"other": 1}').otherwise('{"tokenizer_class": "t"}'), once),
        "model.safetensors": (F.lit("w"), k.cast("int")),
        STATE_FILE: (F.concat(told, F.when(k % 6 == 1, "}").otherwise(', "optimizer_state_dict": {}}')), once),
    }
    files = F.array(*(
        F.struct(F.lit(i).alias("i"), F.lit(name).alias("file"), text.alias("value"), times.alias("times")) for i, (name, (text, times)) in enumerate(texts.items())
    ))
    # Files are made one after another in a task, so the folders are dealt out before their texts are made.
    dealt = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey").repartition(4 * spark.sparkContext.defaultParallelism, "s_suppkey")
    rows = dealt.select(
        F.concat(F.lit("run"), "s_nationkey").alias("run_id"), checkpoint_name((k % 3).cast("int"), k).alias("checkpoint"), k.alias("_k"), F.inline(files)
    ).where((F.col("_k") * 7 + F.col("i")) % 11 != 0).drop("_k", "i")
    root = shared_dir(spark, "checkpoint-folders")
    write_text_files(rows, root)
    return root


def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("checkpoint"),
        cases(F.col("l_linenumber") % 5, *FILES).alias("file"),
        F.round(F.col("l_extendedprice") * F.lit(100.0)).cast("bigint").alias("bytes"),
    )


# -- the same derivations in SQL -------------------------------------------------------

_WS = tx.WHITESPACE
TOKENS = r"<\|[^|]*\|>|<|\p{L}+|\p{N}|[^\s\p{L}\p{N}<]+"
TAG_TOKENS = r"</?think>|</?answer>|" + TOKENS
ALL_TOKENS = TAG_TOKENS
NL = "chr(10)"


def sql_strip(x: str) -> str:
    return f"trim({x}, '{_WS}')"


def sql_count(x: str, pattern: str = TOKENS) -> str:
    return f"coalesce(len(regexp_extract_all({x}, '{pattern}')), 0)::INTEGER"


def sql_block(role: str, text: str) -> str:
    return f"'<|im_start|>' || {role} || {NL} || {text} || '<|im_end|>' || {NL}"


def sql_chat(prompt: str) -> str:
    return f"""({sql_block("'system'", f"'{SYSTEM}'")} || {sql_block("'user'", prompt)} || '<|im_start|>assistant' || {NL})"""


SQL = {
    "raw": f"""raw AS (
  SELECT doc_id AS ord, source || '/' || lang || '/' || (doc_id % 7) AS input,
    CASE (doc_id // 20) % 8 WHEN 0 THEN '' WHEN 1 THEN NULL WHEN 2 THEN text
      WHEN 3 THEN text || {NL} || '```python' || {NL} || 'print(1)' || {NL} || '```'
      WHEN 4 THEN '```python' || {NL} || text || {NL} || '```'
      WHEN 5 THEN '<think></think>' || text WHEN 6 THEN '<think>' || text
      ELSE '<think>' || {NL} || text || {NL} || '</think>tail' END AS output,
    CASE WHEN doc_id % 11 = 0 THEN '' WHEN doc_id % 13 = 0 THEN NULL ELSE 'print(' || doc_id || ')' END AS solution,
    'L' || (n_chars % 5) AS difficulty, source
  FROM documents)""",
    "think": f"""think AS (
  SELECT *, CASE
      WHEN regexp_matches(output, '(?s)<think>.*?</think>')
        THEN {sql_strip("regexp_extract(output, '(?s)<think>(.*?)</think>', 1)")}
      WHEN {sql_strip("regexp_replace(output, '(?s)```.*?```', '', 'g')")} <> ''
        THEN {sql_strip("regexp_replace(output, '(?s)```.*?```', '', 'g')")}
      ELSE {sql_strip("output")} END AS think
  FROM raw)""",
    "resp": f"""resp AS (
  SELECT *, '<think>' || {NL} || think || {NL} || '</think>' || {NL} || '<answer>' || {NL} || solution || {NL} || '</answer>' AS response
  FROM think)""",
    "judged": f"""judged AS (
  SELECT *, CASE WHEN coalesce(output, '') = '' OR coalesce(solution, '') = '' THEN 'no_solution'
      WHEN NOT {sql_count("response")} BETWEEN 32 AND 512 THEN 'length' ELSE 'kept' END AS outcome
  FROM resp)""",
    "curated": """curated AS (
  SELECT ord, coalesce(input, '') AS prompt, response, solution, difficulty, source FROM judged WHERE outcome = 'kept')""",
    "sft": """sft AS (
  SELECT conv_id * 4294967296 + turn AS ord, text AS prompt, answer AS response, 'print(' || turn || ')' AS solution,
    'L' || (turn % 3) AS difficulty, 'c' || (conv_id % 5) AS source
  FROM (SELECT *, lead(text) OVER w AS answer, lead(role) OVER w AS next_role FROM conversations
        WINDOW w AS (PARTITION BY conv_id ORDER BY turn))
  WHERE role = 'user' AND next_role = 'assistant')""",
    "outputs": f"""outputs AS (
  SELECT d.doc_id, 'task' || b.item_id AS name, CASE (d.doc_id // 20) % 9
      WHEN 0 THEN '<think>' || {NL} || d.text || {NL} || '</think>' || {NL} || '<answer>' || {NL} || 'print(' || d.doc_id || ')' || {NL} || '</answer><|im_end|>'
      WHEN 1 THEN 'Sure. <think>' || d.text || '</think><answer>x = input()' || {NL} || '</answer>'
      WHEN 2 THEN '<answer>print(1)</answer><think>' || d.text || '</think>'
      WHEN 3 THEN d.text || {NL} || '```python' || {NL} || 'print(''a'')' || {NL} || '```' || {NL} || 'or' || {NL} || '```' || {NL} || 'print(''b'')' || {NL} || '```'
      WHEN 4 THEN '<think>' || d.text || '</think><answer></answer>'
      WHEN 5 THEN '<think>' || d.text
      WHEN 6 THEN '<think>' || d.text || '</think><answer>print(2)</answer> and some more words'
      WHEN 7 THEN ''
      ELSE '<think>' || d.text || '</think><answer>print(3)</answer></answer><|endoftext|>' END AS output,
    CASE WHEN d.doc_id % 3 = 0 THEN b.text ELSE d.text END AS stdout, d.doc_id % 17 = 0 AS timed_out,
    CASE WHEN d.doc_id % 50 = 0 THEN 0 ELSE d.n_chars END AS elapsed_ms
  FROM documents d JOIN benchmark b ON b.item_id = d.doc_id % (SELECT count(*) FROM benchmark))""",
    "checked": f"""checked AS (
  SELECT *, contains(output, '<think>') AND contains(output, '</think>') AS has_think,
    contains(output, '<answer>') AND contains(output, '</answer>') AS has_answer,
    NOT contains(output, '<think>') OR starts_with({sql_strip("output")}, '<think>') AS clean_start,
    NOT contains(output, '</answer>') OR
      {sql_strip("regexp_replace(list_extract(string_split(output, '</answer>'), -1), '<[|][^|]*[|]>', '', 'g')")} = '' AS clean_end,
    contains(output, '<think>') AND contains(output, '<answer>')
      AND strpos(output, '<think>') < strpos(output, '<answer>') AS order_ok,
    CASE WHEN regexp_matches(output, '(?s)<answer>.*?</answer>')
        THEN {sql_strip("regexp_extract(output, '(?s)<answer>(.*?)</answer>', 1)")}
      ELSE {sql_strip(r"list_extract(regexp_extract_all(output, '(?s)```(?:python)?\n(.*?)```', 1), -1)")} END AS code,
    CASE WHEN regexp_matches(output, '(?s)<answer>.*?</answer>') THEN 'tag'
      WHEN regexp_matches(output, '(?s)```(?:python)?\\n.*?```') THEN 'markdown' ELSE 'none' END AS code_src
  FROM outputs)""",
    "graded": f"""graded AS (
  SELECT c.doc_id, c.name, has_think AND has_answer AND clean_end AND order_ok AS format_ok, has_think, has_answer, code_src,
    CASE WHEN coalesce(code, '') = '' THEN NULL
      WHEN contains(code, 'input(') OR contains(code, 'sys.stdin') THEN false WHEN timed_out THEN false
      ELSE contains(stdout, b.text) END AS exec_pass,
    elapsed_ms, {sql_count("output", TAG_TOKENS)} AS tokens
  FROM checked c JOIN benchmark b ON c.name = 'task' || b.item_id)""",
    "vocab": f"""vocab AS (
  SELECT token, (('0x' || left(md5(token), 5))::INTEGER + 1000)::INTEGER AS id
  FROM (SELECT DISTINCT unnest(regexp_extract_all(text, '{TOKENS}')) AS token
        FROM (SELECT text FROM benchmark UNION ALL SELECT text FROM conversations))
  WHERE right(md5(token), 1) NOT IN ('0', '1')
  UNION ALL SELECT * FROM (VALUES {", ".join(f"('{t}', {i + 1})" for i, t in enumerate(SPECIAL_TOKENS))}) s(token, id))""",
    "pieces": f"""pieces AS (
  SELECT *, {sql_count("rendered", ALL_TOKENS)} AS prompt_len,
    regexp_extract_all(rendered || response || '<|im_end|>', '{ALL_TOKENS}') AS toks
  FROM (SELECT *, {sql_chat("prompt")} AS rendered FROM sft))""",
    "coded": """coded AS (
  SELECT ord, list(coalesce(id, 0) ORDER BY pos) AS full_ids
  FROM (SELECT ord, unnest(toks) AS token, generate_subscripts(toks, 1) AS pos FROM pieces) LEFT JOIN vocab USING (token)
  GROUP BY ord)""",
    "examples": """examples AS (
  SELECT ord, prompt_len, full_ids[1:160] AS input_ids,
    list_transform(full_ids[1:160], lambda x, i: CASE WHEN i <= prompt_len THEN -100 ELSE x END) AS labels,
    list_transform(full_ids[1:160], lambda x: 1) AS attention_mask
  FROM pieces JOIN coded USING (ord))""",
    "logits": """logits AS (
  SELECT vec_id // 10 AS seq_id, (vec_id % 10)::INTEGER AS pos,
    CASE WHEN vec_id % 10 < 3 THEN -100 ELSE label END::INTEGER AS label, embedding::DOUBLE[] AS logits
  FROM embeddings)""",
    "scored": """scored AS (
  SELECT *, lead(label, 1, -100) OVER (PARTITION BY seq_id ORDER BY pos) AS target,
    list_max(logits) + ln(list_sum(list_transform(logits, lambda x: exp(x - list_max(logits))))) AS lse
  FROM logits)""",
    "batches": """batches AS (
  SELECT 'run' || (event_id // 4000) AS run_id, event_id % 4000 // 400 + 1 AS epoch, event_id % 2 AS rank, event_id % 400 // 2 AS idx,
    (value::DECIMAL(12,2) * 0.01)::DECIMAL(14,4) AS loss, user_id + 1 AS tokens, epoch_us(ts) AS ts_us, user_id, event_id
  FROM events)""",
    "passes": """passes AS (
  SELECT * EXCLUDE (idx), epoch * 3 + idx // 70 AS step, idx // 70 < 2 AS mid, idx % 70 AS idx FROM batches)""",
    "before": """before AS (
  SELECT run_id, epoch, coalesce(sum(n) OVER (PARTITION BY run_id ORDER BY epoch
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS steps_before
  FROM (SELECT run_id, epoch, max(idx) // 7 + 1 AS n FROM batches GROUP BY run_id, epoch))""",
    "steps": """steps AS (
  SELECT run_id, epoch, idx // 7 + 1 + steps_before AS step,
    sum(loss) FILTER (rank = 0) AS loss_sum, count(*) FILTER (rank = 0) AS batches, sum(tokens)::BIGINT AS tokens,
    max(ts_us) AS end_us, arg_max(user_id, idx) FILTER (rank = 0) AS last_user,
    arg_max(event_id, idx) FILTER (rank = 0) AS last_event, max(user_id) AS top_user
  FROM batches JOIN before USING (run_id, epoch) GROUP BY run_id, epoch, idx // 7, steps_before)""",
    "windows": """windows AS (
  SELECT *, coalesce(lag(end_us) OVER (PARTITION BY run_id, epoch ORDER BY step), start_us) AS prev_us,
    sum(loss_sum) OVER w AS cum_loss, sum(batches) OVER w AS cum_batches
  FROM (SELECT run_id, epoch, max(step) AS step, sum(loss_sum) AS loss_sum, sum(batches) AS batches,
          sum(tokens)::BIGINT AS tokens, max(end_us) AS end_us, arg_max(last_user, step) AS last_user,
          arg_max(last_event, step) AS last_event, max(top_user) AS top_user
        FROM steps GROUP BY run_id, epoch, (step + 4) // 5 HAVING max(step) % 5 = 0)
    JOIN (SELECT run_id, epoch, min(ts_us) AS start_us FROM batches GROUP BY run_id, epoch) USING (run_id, epoch)
  WINDOW w AS (PARTITION BY run_id, epoch ORDER BY step ROWS UNBOUNDED PRECEDING))""",
    "history": f"""history AS (
  SELECT event_type AS run_id, event_id AS _step, (epoch_us(ts) - {START_US}) / 1e6::DOUBLE AS _runtime,
    CASE WHEN event_id % 10 <> 9 THEN value / 100 END AS train_loss, CASE WHEN event_id % 10 = 9 THEN value / 100 END AS val_loss,
    CASE WHEN event_id % 10 = 9 THEN NULL WHEN s < 50 THEN 2e-5::DOUBLE * s / 50
      ELSE 2e-5::DOUBLE * greatest(0, 0.5::DOUBLE * (1 + cos(pi() * (s - 50) / 139))) END AS train_lr
  FROM (SELECT *, ((event_id % 190) * CASE WHEN event_type IN ('click', 'view') THEN 2 ELSE 1 END)::DOUBLE AS s FROM events))""",
    "ckpts": """ckpts AS (
  SELECT o_custkey % 50 AS run_id, (o_orderkey % 5)::INTEGER AS epoch, o_orderkey AS step,
    CASE WHEN o_orderstatus = 'F' THEN 'mid' ELSE 'epoch' END AS kind,
    CASE WHEN o_orderkey % 11 <> 0 THEN floor(o_totalprice / 1000) / 100 END AS val_loss, o_orderkey % 13 = 0 AS elsewhere, o_orderkey % 4 <> 0 AS optimizer,
    'checkpoint-epoch' || (o_orderkey % 5 + 1) || '-step' || o_orderkey AS name, o_orderdate::DATE AS mtime
  FROM orders)""",
    "manifest": f"""manifest AS (
  SELECT l_orderkey AS checkpoint, [{", ".join(f"'{f}'" for f in FILES)}][l_linenumber % 5 + 1] AS file,
    round(l_extendedprice * 100)::BIGINT AS bytes
  FROM lineitem)""",
}

_NEEDS = {
    "think": ["raw"], "resp": ["think"], "judged": ["resp"], "curated": ["judged"], "checked": ["outputs"],
    "graded": ["checked"], "pieces": ["sft"], "coded": ["pieces", "vocab"], "examples": ["coded"],
    "scored": ["logits"], "passes": ["batches"], "before": ["batches"], "steps": ["before"], "windows": ["steps"],
}


def with_inputs(select: str, *names: str) -> str:
    """A query over derived inputs: their expressions, dependencies first, then ``select``."""
    order: list[str] = []

    def add(name: str) -> None:
        for need in _NEEDS.get(name, []):
            add(need)
        if name not in order:
            order.append(name)

    for name in names:
        add(name)
    return "WITH " + ",\n".join(SQL[n] for n in order) + "\n" + select
