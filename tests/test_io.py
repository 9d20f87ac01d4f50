import json

import pytest
from pyspark.sql import functions as F

from conftest import plan, rows
from sftlake.functions.tokenizer import with_tokenizer
from sftlake.operators import curate as cu
from sftlake.plans import inputs as inp
from sftlake.session import shared_dir
from sftlake.sources import io
from sftlake.streaming.curate import curate_stream

RECORDS = [{"prompt": "é 你好", "response": "a\nb", "solution": None}, {"prompt": "p", "extra": 1, "source": "s"}]


def test_jsonl(spark, tmp_path):
    path = tmp_path / "in.jsonl"
    path.write_text("".join(json.dumps(r, ensure_ascii=False) + "\n" for r in RECORDS), encoding="utf-8")
    df = io.read_sft_jsonl(spark, str(path))
    want = [("é 你好", "a\nb", None, None, None), ("p", None, None, None, "s")]
    assert rows(df) == want
    out = str(tmp_path / "out")
    io.write_sft_jsonl(df, out)
    assert rows(io.read_sft_jsonl(spark, out)) == want
    text = "\n".join(r.value for r in spark.read.text(out).collect())
    assert "你好" in text and '"solution":null' in text


def test_malformed_line(spark, tmp_path):
    path = tmp_path / "bad.jsonl"
    path.write_text('{"prompt": "a"}\nnot json\n')
    with pytest.raises(Exception, match="(?i)malformed"):
        io.read_sft_jsonl(spark, str(path)).collect()
    loose = io.read_sft_jsonl(spark, str(path), strict=False).select("prompt", "_corrupt_record").cache()
    assert rows(loose) == [("a", None), (None, "not json")]


def test_histories_of_many_runs(spark, tmp_path):
    for run, shift in (("abc", 0), ("xyz", 1)):
        points = [
            {"_step": 0, "_runtime": 1.5, "epoch": 1, "train/loss": shift, "train/lr": 0, "val/loss": None},
            {"_step": 3, "_runtime": 3600, "epoch": 1, "train/loss": 0.5},
        ]
        (tmp_path / f"run_history_{run}.json").write_text(json.dumps(points))
    df = io.read_run_history(spark, str(tmp_path))
    assert sorted(rows(df.select("run_id", "_step", "_runtime", "train_loss", "train_lr", "val_loss"))) == [
        ("abc", 0, 1.5, 0.0, 0.0, None), ("abc", 3, 3600.0, 0.5, None, None),
        ("xyz", 0, 1.5, 1.0, 0.0, None), ("xyz", 3, 3600.0, 0.5, None, None),
    ]


def test_one_split_is_one_folder(spark, tmp_path):
    path = str(tmp_path / "corpus")
    spark.range(10).withColumn("split", F.concat(F.lit("split_"), F.col("id") % 2)).write.partitionBy("split").parquet(path)
    df = io.read_raw_corpus(spark, path, "split_1")
    assert df.count() == 5 and "PartitionFilters: [isnotnull(split" in plan(df)


def test_metrics_keep_the_latest_write(spark, tmp_path):
    path = str(tmp_path / "metrics")
    make = lambda *data: spark.createDataFrame(list(data), io.METRIC_SCHEMA)
    io.append_metrics(make(("r", 1, "loss", 0.5, 1), ("r", 2, "loss", 0.4, 1), ("q", 1, "loss", 9.0, 1)), path)
    io.append_metrics(make(("r", 2, "loss", 0.3, 2)), path)
    assert sorted(rows(io.read_metrics(spark, path))) == [("q", 1, "loss", 9.0), ("r", 1, "loss", 0.5), ("r", 2, "loss", 0.3)]


def test_quota_path():
    assert io.quota_path("out/data.jsonl", 4096, 10000) == "out/data_sl4096_10000.jsonl"


def test_shared_dir_follows_the_session(spark):
    own = spark.conf.get("spark.checkpoint.dir")
    assert shared_dir(spark, "x").startswith(own)


def test_writes_at_the_same_time_have_one_winner(spark, tmp_path):
    path = str(tmp_path / "metrics")
    for value in (0.5, 0.7, 0.6):
        io.append_metrics(spark.createDataFrame([("r", 1, "loss", value, 4)], io.METRIC_SCHEMA), path)
    assert rows(io.read_metrics(spark, path)) == [("r", 1, "loss", 0.7)]


def test_order_of_json_lines(spark, tmp_path):
    lines = [json.dumps({"prompt": f"p{i}", "response": "r" * (i % 7)}) for i in range(500)]
    (tmp_path / "b.jsonl").write_text("\n".join(lines[200:]))
    (tmp_path / "a.jsonl").write_text("\n".join(lines[:200]) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        got = rows(io.read_sft_jsonl(spark, str(tmp_path), order="derived").select("ord", "prompt"))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert sorted(got) == [(i, f"p{i}") for i in range(500)]


def test_curated_lines_keep_their_order_to_the_batches(spark, tmp_path):
    from sftlake.operators import examples as ex
    from sftlake.operators.split import group_split

    raw = inp.raw_corpus(spark, "/root/testdata/sf0.001")
    kept = cu.curate_quota(raw, 60, 32, 512)
    out = str(tmp_path / "sft")
    io.write_sft_jsonl(cu.project_sft_fields(kept, order="ord"), out)
    back = io.read_sft_jsonl(spark, out, order="stored")
    assert sorted(rows(back)) == sorted(rows(cu.project_sft_fields(kept, order="ord")))
    train = group_split(back).where("split = 'train'").select("ord", "prompt", "response")
    vocab = inp.vocabulary(spark, "/root/testdata/sf0.001")
    padded = ex.collate_pad(ex.assign_batches(ex.tokenised_examples(train, vocab, "S", ex.EOS, 200), 8, shuffle=False))
    got = sorted((r.batch_id, r.pos_in_batch, r.ord, len(r.input_ids) == r.batch_width) for r in padded.collect())
    assert [o for _, _, o, _ in got] == sorted(r.ord for r in train.collect()) and all(w for *_, w in got)


def test_stream_of_json_lines(spark, tmp_path):
    raw, out, log = (str(tmp_path / n) for n in ("raw", "out", "log"))
    docs = inp.raw_corpus(spark, "/root/testdata/sf0.001")
    docs.write.json(raw)
    curate_stream(spark, raw, out, log, 32, 512, source_format="json").awaitTermination()
    assert sorted(rows(spark.read.parquet(out))) == sorted(rows(cu.curate(docs, 32, 512)))


def test_tokenizer_is_built_in_the_worker(spark):
    def factory():
        table = {}
        return lambda texts: [[table.setdefault(w, len(table)) for w in t.split()] for t in texts]

    df = spark.createDataFrame([("a b a",), ("",), (None,)], "t string").coalesce(1)
    assert [r[0] for r in rows(df.select(with_tokenizer(factory)(F.col("t"))))] == [[0, 1, 0], [], []]


def test_stream_takes_up_new_files_only(spark, tmp_path):
    raw, out, log = str(tmp_path / "raw"), str(tmp_path / "out"), str(tmp_path / "log")
    docs = inp.raw_corpus(spark, "/root/testdata/sf0.001")

    def run():
        query = curate_stream(spark, raw, out, log, 32, 512, files_per_batch=2)
        query.awaitTermination()
        return query

    docs.where("ord < 100").repartition(3).write.parquet(raw)
    first = run()
    assert sum(p["observedMetrics"]["curation"]["checked"] for p in map(lambda p: json.loads(p.json), first.recentProgress) if "curation" in p["observedMetrics"]) == 100
    docs.where("ord >= 100").write.mode("append").parquet(raw)
    run()
    run()
    assert sorted(rows(spark.read.parquet(out))) == sorted(rows(cu.curate(docs, 32, 512)))


def test_encoder_gets_bounded_slices(spark):
    from sftlake.functions import tokenizer

    most_rows, most_bytes = tokenizer.SLICE_ROWS, tokenizer.SLICE_BYTES

    def factory():
        def encode(texts):
            if len(texts) > most_rows or len(texts) > 1 and sum(map(len, texts)) > most_bytes:
                raise ValueError("too much at once")
            return [t.encode() for t in texts]
        return encode

    sizes = [*[1] * 3000, 700_000, 0, 600_000, 1_500_000, 1_500_000, *[5000] * 600]
    df = spark.range(len(sizes), numPartitions=1).withColumn("n", F.element_at(F.lit(sizes), (F.col("id") + 1).cast("int")))
    df = df.withColumn("t", F.when(F.col("id") % 1000 != 7, F.repeat(F.chr(F.lit(97) + F.col("id") % 26), F.col("n"))))
    coded = df.select("id", "n", with_tokenizer(factory)(F.col("t")).alias("ids"))
    got = rows(coded.select("id", F.size("ids"), F.size(F.array_distinct("ids")), F.try_element_at("ids", F.lit(1))).orderBy("id"))
    want = [0 if i % 1000 == 7 else n for i, n in enumerate(sizes)]
    assert got == [(i, n, min(n, 1), 97 + i % 26 if n else None) for i, n in enumerate(want)]
