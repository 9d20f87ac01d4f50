import pytest
from pyspark.sql import functions as F

from conftest import plan
from sftlake.operators import curate as cu
from sftlake.operators import evals as ev
from sftlake.operators import profile as pr

GOOD = "<think>a</think><answer>{}</answer>"


@pytest.fixture(scope="module")
def outputs(spark):
    return spark.createDataFrame([
        (1, "t1", GOOD.format("print(7)"), "the 7 is", False, 2.0),
        (2, "t1", GOOD.format("print(8)"), "8", False, 2.0),
        (3, "t1", GOOD.format("input()"), "7", False, 0.0),
        (4, "t2", GOOD.format("loop"), "", True, 10.0),
        (5, "t2", GOOD.format(""), "x", False, 1.0),
        (6, "t2", "nothing", "x", False, 1.0),
        (7, "t2", "```python\nprint('x')\n```", "x", False, 1.0),
    ], "i int, name string, output string, stdout string, timed_out boolean, elapsed double")


@pytest.fixture(scope="module")
def tasks(spark):
    return spark.createDataFrame([("t1", "7"), ("t2", "x")], "name string, expected_output string")


def test_grading(outputs, tasks):
    graded = ev.grade_results(outputs, tasks)
    got = {r.i: (r.exec_pass, r.code_src) for r in graded.collect()}
    assert got == {
        1: (True, "tag"), 2: (False, "tag"), 3: (False, "tag"), 4: (False, "tag"), 5: (None, "tag"), 6: (None, "none"), 7: (True, "markdown"),
    }
    one = ev.eval_summary(graded).first()
    assert (one.n, one.executed, one.passed, one.via_tag, one.via_markdown) == (7, 5, 2, 5, 1)
    assert one.pass_pct == 40.0 and one.avg_elapsed == 17 / 7
    capped = ev.eval_summary(graded, max_new_tokens=8).first()
    tokens = [r.tokens for r in graded.collect()]
    assert capped.stopped == sum(t < 8 for t in tokens) and 0 < capped.stopped < 7 and capped.stop_pct == 100.0 * capped.stopped / 7
    labels = {r.i: (r.format, r.code_source, r.exec) for r in ev.eval_labels(graded).collect()}
    assert labels[1] == ("OK", "tag", "PASS") and labels[6] == ("FAIL", "-", "skip") and labels[7][1:] == ("md", "PASS")


def test_no_executed_task(outputs, tasks):
    one = ev.eval_summary(ev.grade_results(outputs, tasks, skip_exec=True)).first()
    assert one.executed == 0 and one.pass_pct is None
    assert ev.eval_summary(ev.grade_results(outputs.limit(0), tasks)).first().format_pct == 0.0


def test_large_task_table_is_not_broadcast(spark, outputs, tasks):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        graded = ev.grade_results(outputs, tasks)
        assert "Broadcast" not in plan(graded)
        assert graded.where("exec_pass").count() == 2
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_length_stats_equal_pandas(spark):
    import numpy as np
    import pandas as pd

    lengths = [int(x) for x in np.random.default_rng(1).integers(0, 300, 501)]
    df = spark.createDataFrame([(("hot" if i % 3 else "b"), x) for i, x in enumerate(lengths)], "g string, x int")
    for name, part in (("hot", [x for i, x in enumerate(lengths) if i % 3]), ("b", lengths[::3])):
        s = pd.Series(part)
        got = pr.length_stats(df, "x", ["g"]).where(F.col("g") == name).first()
        assert (got.rows, got.min, got.max) == (len(part), s.min(), s.max())
        assert got["mean"] == pytest.approx(s.mean()) and got["std"] == pytest.approx(s.std()) and got["median"] == s.median()
        assert [got[f"p{p}"] for p in pr.PERCENTILES] == pytest.approx([s.quantile(p / 100) for p in pr.PERCENTILES])
    one = pr.length_stats(df.limit(1), "x").first()
    assert one["std"] is None and one["p99"] == one["mean"]


RAW = "ord bigint, input string, output string, solution string, difficulty string, source string"


def test_curation_stops_at_the_quota(spark):
    data = [(i, f"p{i}", None if i % 4 == 0 else "word " * (50 if i % 3 else 1), "" if i % 5 == 0 else "x", None, "s") for i in range(100)]
    df = spark.createDataFrame(data, RAW).repartition(5)
    kept = [i for i in range(100) if i % 4 and i % 5 and i % 3]
    for n in (1, 10, len(kept), 1000):
        got = cu.curate_quota(df, n, 32, 512)
        assert sorted(r.ord for r in got.collect()) == kept[:n]
        seen = [i for i in range(100) if n > len(kept) or i <= kept[n - 1]]
        counts = cu.curation_counters(df, n, 32, 512).first()
        assert counts.checked == len(seen) and counts.kept == min(n, len(kept))
        assert counts.skipped_no_solution == sum(1 for i in seen if i % 4 == 0 or i % 5 == 0)
        assert counts.checked == counts.kept + counts.skipped_no_solution + counts.skipped_length
    record = cu.curate(df, 32, 512).orderBy("ord").first()
    assert record.difficulty == "" and record.prompt == "p1"


def test_length_bounds_are_inclusive(spark):
    df = spark.createDataFrame([(1, "a b c"), (2, "a b"), (3, "a b c d"), (4, "a")], "ord int, response string")
    assert sorted(r.ord for r in cu.filter_token_length(df, 2, 3).collect()) == [1, 2]


def test_text_is_tokenised_once_and_without_shuffle(spark, tmp_path):
    spark.createDataFrame([(1, "p", "some output", "x", "d", "s")], RAW).write.parquet(str(tmp_path / "raw"))
    text = plan(cu.curate(spark.read.parquet(str(tmp_path / "raw")), 1, 512))
    assert "Exchange" not in text and text.count("regexp_replace(response") == 1
    quota = plan(cu.curate_quota(spark.read.parquet(str(tmp_path / "raw")), 1, 1, 512))
    assert "LessThanOrEqual(ord,1)" in quota


def test_tags(spark):
    df = spark.createDataFrame([(2, "none"), (1, "<think>\na\n</think>\n<answer>\nb\n</answer>")], "ord int, response string")
    gate = cu.format_gate(df).first()
    assert (gate.records, gate.records_ok, gate.first_record) == (2, 1, "OK")
    probe = cu.tag_coverage(df, probe=5, width=7).first()
    assert tuple(probe) == (2, 1, "<think>", "answer>")
    found = {r.token: (r.occurrences, r.missing) for r in ev.special_token_coverage(df, "response", ("<think>", "<x>")).collect()}
    assert found == {"<think>": (1, False), "<x>": (0, True)}


def test_every_task_is_graded(spark):
    from sftlake.plans import inputs as inp

    sf = "/root/testdata/sf0.1"
    graded = ev.grade_results(inp.model_outputs(spark, sf), inp.eval_tasks(spark, sf)).select("name", "exec_pass")
    items = inp.table(spark, sf, "benchmark").count()
    assert graded.select("name").distinct().count() == items == 200
    assert graded.count() == inp.table(spark, sf, "documents").count()


def test_texts_of_a_round_trip_do_not_move(spark):
    from sftlake.operators import decode as de

    texts = ["<think>a</think>", "b<answer>1", None, "", "x<think>"]
    df = spark.createDataFrame(list(enumerate(texts)), "k bigint, text string")
    vocab = de.byte_vocabulary(spark.createDataFrame([("a",), ("x",)], "piece string"), ("<think>", "</think>"))
    found = ev.tag_round_trip(df, "text", vocab=vocab, key="k")
    assert tuple(found.first()) == (5, 2, 1, 0, 0)
    # Only what a text has is joined.
    plan = found._jdf.queryExecution().optimizedPlan()
    top = plan
    while top.nodeName() != "Join":
        top = top.children().apply(0)
    assert "string" not in top.schema().json()
    # Without a vocabulary as before.
    assert tuple(ev.tag_round_trip(df, "text").first()) == (5, 2, 1, 0, 0)
