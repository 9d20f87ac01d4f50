import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import plan, rows
from sftlake.functions import schedule as sd
from sftlake.operators import checkpoints as ck
from sftlake.operators import runs as ru

# Figures published for the final training run.
WARMUP, TOTAL, PEAK = 50, 189, 2e-5
LOGGED_LR = {10: 8.0e-6, 20: 1.6e-5, 30: 1.9734380543606932e-05}
VAL_LOSS = {63: 0.02991, 126: 0.02906, 189: 0.02730}


def test_published_lr_fits_the_double_speed_schedule(spark):
    df = spark.createDataFrame([("r", s, lr) for s, lr in LOGGED_LR.items()], "run_id string, _step bigint, train_lr double")
    audit = ru.lr_audit(df, WARMUP, TOTAL, PEAK).first()
    assert audit.best_speed == 2.0 and audit.gap_2x < 1.2e-6 and audit.gap_1x > 7e-6


def test_lr_ends(spark):
    steps = spark.createDataFrame([(s,) for s in (0, 25, 50, 189, 300)], "s bigint")
    cos = [r[0] for r in rows(steps.select(sd.lr_cosine(F.col("s"), WARMUP, TOTAL, PEAK)))]
    assert cos[:3] == [0.0, 1e-5, 2e-5] and cos[3] == pytest.approx(0, abs=1e-12) and cos[4] > 1e-6
    lin = [r[0] for r in rows(steps.select(sd.lr_linear(F.col("s"), WARMUP, TOTAL, PEAK)))]
    assert lin == [0.0, 1e-5, 2e-5, 0.0, 0.0]


def make_batches(spark, run_sizes, ranks=2, seed=3):
    rng = random.Random(seed)
    data, clock = [], 0
    for run, sizes in run_sizes.items():
        for epoch, size in enumerate(sizes, 1):
            for idx in range(size):
                for rank in range(ranks):
                    clock += rng.randrange(1, 5_000_000)
                    data.append((
                        run, epoch, rank, idx, Decimal(rng.randrange(1, 9999)) / 10000, rng.randrange(1, 500), clock,
                        rng.random(), rng.random(), rng.random(), rng.randrange(10**10), rng.randrange(10**10),
                    ))
    return data, spark.createDataFrame(
        data, "run_id string, epoch int, rank int, idx bigint, loss decimal(10,4), tokens bigint, ts_us bigint, "
        "entropy double, token_acc double, grad_norm double, mem_alloc bigint, mem_reserved bigint",
    )


def simulated_log(data, accum, every):
    """The log as a training loop would write it."""
    out = []
    for run in sorted({d[0] for d in data}):
        step = 0
        for epoch in sorted({d[1] for d in data if d[0] == run}):
            part = [d for d in data if d[0] == run and d[1] == epoch]
            total, tokens, last_log = Decimal(0), 0, min(d[6] for d in part)
            n = max(d[3] for d in part) + 1
            for idx in range(n):
                now = [d for d in part if d[3] == idx]
                main = next(d for d in now if d[2] == 0)
                total += main[4]
                tokens += sum(d[5] for d in now)
                if (idx + 1) % accum == 0 or idx == n - 1:
                    step += 1
                    if step % every == 0:
                        end = max(d[6] for d in now)
                        out.append((run, epoch, step, float(total) / (idx + 1), main[7], main[8], main[9],
                                    tokens / max((end - last_log) / 1e6, 1e-6)))
                        tokens, last_log = 0, end
    return out


@pytest.mark.parametrize("accum, every", [(1, 1), (4, 3), (16, 1), (3, 10)])
def test_train_log_equals_the_loop(spark, accum, every):
    data, batches = make_batches(spark, {"a": [50, 37, 8], "b": [5], "c": [64, 64]})
    log = ru.train_log(batches, accum, every)
    got = rows(log.select("run_id", "epoch", "step", "loss", "entropy", "token_acc", "grad_norm", "tokens_per_sec"))
    want = simulated_log(data, accum, every)
    assert len(got) == len(want)
    for g, w in zip(sorted(got), sorted(want)):
        assert g[:3] == w[:3] and g[3:] == pytest.approx(w[3:])


def test_running_loss_ends_in_the_epoch_mean(spark):
    data, batches = make_batches(spark, {"a": [40, 3]})
    last = {(r.epoch, r.rank): r.running_loss for r in ru.running_loss(batches).collect() if r.idx == (39 if r.epoch == 1 else 2)}
    for (epoch, rank), value in last.items():
        losses = [d[4] for d in data if d[1] == epoch and d[2] == rank]
        assert value == float(sum(losses)) / len(losses)
    means = {r.epoch: r.train_loss for r in ru.epoch_summary(batches).collect()}
    assert means[1] == pytest.approx((last[1, 0] + last[1, 1]) / 2)


def test_validation_is_a_mean_of_means(spark):
    df = spark.createDataFrame(
        [(*p, mid, step) for step, mid in ((5, True), (9, False))
         for p in (("r", 1, 0, 0, 1.0, 0.0, 1.0), ("r", 1, 0, 1, 3.0, 0.0, 1.0), ("r", 1, 1, 0, 10.0, 0.0, 1.0))],
        "run_id string, epoch int, rank int, idx int, loss double, entropy double, token_acc double, mid boolean, step int",
    )
    full = {r.step: r for r in ru.validation_summary(df).collect()}
    capped = {r.step: r for r in ru.validation_summary(df, 1).collect()}
    assert all(full[s].loss == full[s].nll == 6.0 and full[s].n_batches == 2 for s in (5, 9))
    # Only the pass in mid-epoch is cut.
    assert (capped[5].loss, capped[5].n_batches, capped[9].loss, capped[9].n_batches) == (5.5, 1, 6.0, 2)


def test_train_log_reads_the_rows_once(spark, tmp_path, monkeypatch):
    _, batches = make_batches(spark, {"a": [50, 37]})
    batches.write.parquet(str(tmp_path / "batches"))
    plans, stored = [], ru.stored
    monkeypatch.setattr(ru, "stored", lambda df, name: (plans.append(plan(df)), stored(df, name))[1])
    log = ru.train_log(spark.read.parquet(str(tmp_path / "batches")), 4, 3)
    log.collect()
    plans.append(plan(log))
    # Only the rows themselves have an idx.
    assert sum("FileScan" in line and "idx#" in line for p in plans for line in p.splitlines()) == 1


def test_a_huge_run_is_no_hot_key(spark, monkeypatch):
    """Windows over one row per epoch, and blocks of bounded size for the log: no window holds a run's steps."""
    _, batches = make_batches(spark, {"a": [400, 400], "b": [3]})
    steps = ru.optimizer_steps(batches, 4)
    text = plan(steps)
    windows = [line for line in text.splitlines() if "windowspecdefinition" in line]
    assert len(windows) == 1 and "_steps" in windows[0]
    assert steps.where("run_id = 'a'").agg(F.max("step"), F.count("*")).first()[:] == (200, 200)
    from sftlake.operators import ordering

    whole = sorted(map(tuple, ru.throughput_windows(batches, 4, 3).collect()))
    running = ordering.running
    monkeypatch.setattr(ru, "running", lambda *a, **k: running(*a, **k, block=5))
    assert sorted(map(tuple, ru.throughput_windows(batches, 4, 3).collect())) == whole


def test_losses_that_are_null_or_nan(spark):
    df = spark.createDataFrame([
        ("r", 0, 10, "epoch", 0.5, "a", 1), ("r", 1, 20, "epoch", None, "b", 2), ("r", 2, 30, "epoch", 0.4, "c", 3),
        ("r", 3, 40, "epoch", float("nan"), "d", 4), (None, 0, 50, "epoch", 0.7, "e", 5), ("none", 0, 60, "epoch", None, "f", 6),
    ], CKPTS)
    best = {r.step: (r.new_best, r.is_best) for r in ck.best_checkpoint(df).collect()}
    assert best == {10: (True, False), 20: (False, False), 30: (True, True), 40: (False, False), 50: (True, True), 60: (False, False)}
    assert {r.step for r in ck.retain_best_k(df, 1).collect() if r.keep} == {30, 50}
    assert ck.retain_best_k(df, 1).count() == 6 and ck.retention_plan(df, 1).count() == 6


def test_checkpoints_outside_the_output_folder_are_left_alone(spark):
    df = spark.createDataFrame(
        [("r", i, i, "epoch", 0.5 + i, "checkpoint-epoch1-step1", 1, p) for i, p in enumerate(("/out/a", "/out/b", "/outer/c", "/out/../d", None))],
        CKPTS + ", path string",
    )
    assert [r.reason for r in ck.retention_plan(df, 1, "/out/").orderBy("step").collect()] == ["best-k", "superseded", *["outside-output-dir"] * 3]


def test_published_best_checkpoint(spark):
    df = spark.createDataFrame(
        [("r", i, s, "epoch", v, f"checkpoint-epoch{i + 1}-step{s}", s) for i, (s, v) in enumerate(VAL_LOSS.items())],
        "run_id string, epoch int, step bigint, kind string, val_loss double, name string, mtime bigint",
    )
    best = {r.step: (r.new_best, r.is_best) for r in ck.best_checkpoint(df).collect()}
    assert best == {63: (True, False), 126: (True, False), 189: (True, True)}
    assert {r.step for r in ck.retain_best_k(df, 2).collect() if r.keep} == {126, 189}
    assert {r.step for r in ck.retain_best_k(df, 0).collect() if r.keep} == {189}
    latest = ck.latest_checkpoint(df).first()
    assert (latest.name, latest.resume_epoch, latest.resume_step) == ("checkpoint-epoch3-step189", 3, 189)


CKPTS = "run_id string, epoch int, step bigint, kind string, val_loss double, name string, mtime bigint"


def test_retention_with_ties_and_mid_epoch_saves(spark):
    df = spark.createDataFrame([
        ("r", 0, 10, "epoch", 0.5, "checkpoint-epoch1-step10", 1), ("r", 1, 20, "epoch", 0.5, "checkpoint-epoch2-step20", 2),
        ("r", 2, 30, "epoch", 0.5, "checkpoint-epoch3-step30", 3), ("r", 3, 40, "epoch", 0.9, "elsewhere", 4),
        ("r", 0, 5, "mid", None, "checkpoint-epoch1-step5", 1), ("r", 2, 25, "mid", None, "checkpoint-epoch3-step25", 2),
        ("only-mid", 0, 7, "mid", None, "checkpoint-epoch1-step7", 2),
    ], CKPTS)
    why = {(r.run_id, r.step): r.reason for r in ck.retention_plan(df, 2).collect()}
    assert why == {
        ("r", 10): "best-k", ("r", 20): "best-k", ("r", 30): "superseded", ("r", 40): "not-a-checkpoint",
        ("r", 5): "superseded", ("r", 25): "latest-mid", ("only-mid", 7): "latest-mid",
    }
    best = {r.step: (r.new_best, r.is_best) for r in ck.best_checkpoint(df).collect()}
    assert best == {10: (True, True), 20: (False, False), 30: (False, False), 40: (False, False)}


def test_latest_checkpoint_is_not_lexicographic(spark):
    df = spark.createDataFrame([("r", 0, 50, "mid", None, "checkpoint-epoch1-step50", 9), ("r", 0, 150, "mid", None, "checkpoint-epoch1-step150", 9)], CKPTS)
    assert ck.latest_checkpoint(df).first().name == "checkpoint-epoch1-step150"


def test_state_check(spark):
    df = spark.createDataFrame(
        [("checkpoint-epoch1-step5", 0, 5, True), ("checkpoint-epoch1-step5", 0, 6, False), ("x", 0, 1, None), ("checkpoint-epoch1-step5", None, 5, True), ("checkpoint-epoch1-step5", -1, -5, True)],
        "name string, epoch int, step bigint, optimizer boolean",
    )
    assert [tuple(r)[1:] for r in ck.state_check(df).collect()] == [
        (True, True, True, True, True), (True, True, True, False, False), (True, True, True, False, False), (False, False, True, True, True),
        (True, False, False, False, True),
    ]


def test_files(spark):
    files = spark.createDataFrame(
        [("c1", f, 10**6) for f in ck.REQUIRED_FILES] + [("c2", "config.json", 5), ("c2", "config.json", 5), ("c2", "extra", 1)],
        "checkpoint string, file string, bytes bigint",
    )
    assert sorted(rows(ck.required_files_check(files))) == [("c2", f) for f in sorted(ck.REQUIRED_FILES) if f != "config.json"]
    assert {r.checkpoint: (r.files, r.mb) for r in ck.checkpoint_inventory(files).collect()} == {
        "c1": (sorted(ck.REQUIRED_FILES), 4.0), "c2": (["config.json", "extra"], 11 / 1e6),
    }


def test_notes_and_final_loss(spark):
    runs = spark.createDataFrame(
        [(1, "a", 1, 0.5, 0.7), (2, "a", 2, None, 0.25), (3, "b", 3, None, None)],
        "run_id int, name string, created int, val_loss double, train_loss double",
    )
    assert ru.final_loss_of_run(runs, "a").first().final_loss == "0.2500"
    assert ru.final_loss_of_run(runs, "b").first().final_loss == "n/a"
    notes = spark.sql("select 'r1' run, date'2026-01-02' day, 0.0273D loss union all select 'r2', date'2026-01-02', null")
    assert [r.note for r in ru.version_notes(notes, "T").collect()] == [
        "T | 2026-01-02 | run: r1 | final loss: 0.0273", "T | 2026-01-02 | run: r2 | final loss: n/a",
    ]
