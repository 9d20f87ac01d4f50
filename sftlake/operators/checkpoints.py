"""Checkpoints: what is in them, which one is best or latest, which ones to keep.

``ckpts`` has ``run_id, epoch`` (from 0)``, step, kind`` (``epoch``/``mid``)``, val_loss,
name, mtime``. Nothing here deletes files; retention is a plan.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from sftlake.functions.schedule import checkpoint_step, megabytes
from sftlake.operators.ordering import null_safe, running

# Files every checkpoint must contain.
REQUIRED_FILES = ("config.json", "tokenizer.json", "tokenizer_config.json", "model.safetensors")
# Keys of which a document must have all (first) and one at least (second).
DOCUMENT_KEYS = {
    "config.json": (("model_type", "vocab_size"), ()),
    "tokenizer_config.json": ((), ("tokenizer_class", "model_max_length")),
}


def _measured() -> Column:
    """Has a validation loss that can be compared: neither null nor NaN."""
    return F.col("val_loss").isNotNull() & ~F.isnan("val_loss")


def best_checkpoint(ckpts: DataFrame) -> DataFrame:
    """Mark the epoch checkpoints that beat every earlier one of their run (strictly), and
    the final best: the earliest with the lowest validation loss. One without a loss is neither."""
    epochs = ckpts.where(F.col("kind") == "epoch")
    rows = running(
        epochs, ["run_id"], "step",
        {"_best_before": ("min", F.when(_measured(), F.col("val_loss")))}, exclusive=["_best_before"],
    )
    best = epochs.where(_measured()).groupBy("run_id").agg(F.min(F.struct("val_loss", "step")).alias("_best"))
    new_best = _measured() & (F.col("_best_before").isNull() | (F.col("val_loss") < F.col("_best_before")))
    return null_safe(rows, best, ["run_id"], "left").select(
        "run_id", "step", "name", "val_loss", new_best.alias("new_best"),
        F.coalesce(F.col("step") == F.col("_best.step"), F.lit(False)).alias("is_best"),
    )


def _kth_best(ckpts: DataFrame, k: int) -> DataFrame:
    """Per run, the rank key of the last epoch checkpoint among the best ``k``.

    The row-number filter is applied in every task before the shuffle, so a run
    contributes ``k`` rows per task however many checkpoints it has.
    """
    rank = F.row_number().over(W.partitionBy("run_id").orderBy("val_loss", "epoch", "step"))
    best = ckpts.where((F.col("kind") == "epoch") & _measured()).withColumn("_rank", rank).where(F.col("_rank") <= k)
    return best.groupBy("run_id").agg(F.max(F.struct("val_loss", "epoch", "step")).alias("_kth"))


def retain_best_k(ckpts: DataFrame, k: int) -> DataFrame:
    """Keep/drop decision for epoch checkpoints: the ``k`` lowest losses, earlier ones first. One
    without a loss takes no place and is not kept."""
    rows = null_safe(ckpts.where(F.col("kind") == "epoch"), _kth_best(ckpts, max(k, 1)), ["run_id"], "left")
    return rows.select("run_id", "step", "name", "val_loss", _within_best().alias("keep"))


def _within_best() -> Column:
    return _measured() & F.coalesce(F.struct("val_loss", "epoch", "step") <= F.col("_kth"), F.lit(False))


def retain_latest_mid(ckpts: DataFrame) -> DataFrame:
    """Keep/drop decision for mid-epoch checkpoints: only a run's newest stays."""
    mids = ckpts.where(F.col("kind") == "mid")
    newest = mids.groupBy("run_id").agg(F.max("step").alias("_newest"))
    return null_safe(mids, newest, ["run_id"]).select(
        "run_id", "step", "name", (F.col("step") == F.col("_newest")).alias("keep")
    )


def retention_plan(ckpts: DataFrame, k: int, out_dir: str | None = None) -> DataFrame:
    """Both rules together, with the reason for each decision.

    With ``out_dir``, a checkpoint whose ``path`` does not lie below that folder is left alone.
    """
    newest = ckpts.where(F.col("kind") == "mid").groupBy("run_id").agg(F.max("step").alias("_newest"))
    kth = _kth_best(ckpts, max(k, 1))
    # One row per run with both marks, so the checkpoints are joined once.
    marks = kth.select("run_id", "_kth", F.lit(None).cast("bigint").alias("_newest")).unionByName(
        newest.select("run_id", F.lit(None).cast(kth.schema["_kth"].dataType).alias("_kth"), "_newest")
    ).groupBy("run_id").agg(F.max("_kth").alias("_kth"), F.max("_newest").alias("_newest"))
    rows = null_safe(ckpts, marks, ["run_id"], "left")
    best = (F.col("kind") == "epoch") & _within_best()
    latest = (F.col("kind") == "mid") & (F.col("step") == F.col("_newest"))
    ours = F.col("name").startswith("checkpoint-")
    below = F.lit(True) if out_dir is None else F.coalesce(
        F.col("path").startswith(out_dir.rstrip("/") + "/") & ~F.col("path").contains("/../"), F.lit(False)
    )
    reason = (
        F.when(best, "best-k").when(latest, "latest-mid").when(~ours, "not-a-checkpoint")
        .when(~below, "outside-output-dir").otherwise("superseded")
    )
    return rows.select("run_id", "step", "name", reason.alias("reason")).withColumn(
        "keep", F.col("reason") != "superseded"
    )


def latest_checkpoint(ckpts: DataFrame) -> DataFrame:
    """Newest checkpoint of each run by modification time, then epoch and step, with the
    epoch and step training resumes at."""
    newest = F.max_by(F.struct("name", "epoch", "step"), F.struct("mtime", "epoch", "step"))
    return ckpts.groupBy("run_id").agg(newest.alias("c")).select(
        "run_id", "c.name", (F.col("c.epoch") + F.lit(1)).alias("resume_epoch"),
        F.col("c.step").alias("resume_step"),
    )


def checkpoint_inventory(manifest: DataFrame) -> DataFrame:
    """Files of each checkpoint and their size; a file listed more than once is one file."""
    return manifest.groupBy("checkpoint").agg(
        F.array_sort(F.collect_set("file")).alias("files"), F.sum("bytes").alias("bytes")
    ).select(
        "checkpoint", "files", F.size("files").cast("bigint").alias("n_files"), "bytes", megabytes(F.col("bytes")).alias("mb")
    )


def required_files_check(manifest: DataFrame, required: Sequence[str] = REQUIRED_FILES) -> DataFrame:
    """The required files each checkpoint lacks, one row per missing file."""
    absent = [
        F.when(F.count_if(F.col("file") == F.lit(name)) == 0, F.lit(name)) for name in required
    ]
    return (
        manifest.groupBy("checkpoint")
        .agg(F.array_compact(F.array(*absent)).alias("missing"))
        .select("checkpoint", F.explode("missing").alias("missing"))
    )


def _key_check(document: Column, all_of: Sequence[str], any_of: Sequence[str]) -> tuple[Column, Column]:
    """The keys of ``all_of`` that a JSON document lacks, and whether it is an object that has them and one of ``any_of``."""
    keys = F.json_object_keys(document)
    missing = F.array_except(F.array(*map(F.lit, all_of)).cast("array<string>"), keys)
    has_any = F.arrays_overlap(keys, F.array(*map(F.lit, any_of))) if any_of else F.lit(True)
    return missing, F.coalesce(keys.isNotNull() & (F.size(missing) == 0) & has_any, F.lit(False))


def json_required_keys(
    df: DataFrame, column: str, all_of: Sequence[str] = (), any_of: Sequence[str] = ()
) -> DataFrame:
    """Flag JSON documents that lack one of ``all_of``, or all of ``any_of``.

    A document that is not a JSON object is not valid.
    """
    missing, valid = _key_check(F.col(column), all_of, any_of)
    return df.withColumns({"missing": missing, "valid": valid})


def state_check(states: DataFrame) -> DataFrame:
    """Checks of a training state: fields present and not negative, step as in the name, and
    the optimizer's state (``optimizer``, boolean) saved with it. Step 0 is a valid step."""
    present = F.col("epoch").isNotNull() & F.col("step").isNotNull()
    return states.select(
        "name",
        present.alias("present"),
        F.coalesce(F.col("epoch") >= 0, F.lit(False)).alias("epoch_ok"),
        F.coalesce(F.col("step") >= 0, F.lit(False)).alias("step_ok"),
        F.coalesce(F.col("step") == checkpoint_step(F.col("name")), F.lit(False)).alias("name_ok"),
        F.coalesce(F.col("optimizer"), F.lit(False)).alias("optimizer_ok"),
    )


def folder_audit(
    files: DataFrame, documents: DataFrame, required: Sequence[str] = REQUIRED_FILES,
    keys: Mapping[str, tuple[Sequence[str], Sequence[str]]] = DOCUMENT_KEYS, state: str = "training_state.json",
) -> DataFrame:
    """One row per checkpoint folder: inventory, missing files, malformed documents, the state's checks, and the run's newest.

    ``files`` is a listing ``(run_id, checkpoint, file, bytes, mtime)``, ``documents`` the JSON texts ``(run_id, checkpoint, file, document)`` beside it.
    A document that is listed but malformed is named in ``malformed``; one that is not there is only missing. A folder
    without the state file predates resuming: its ``state_ok`` is null. ``resume_epoch`` and ``resume_step`` are where a sound state goes on.
    ``newest`` marks the checkpoint of a run that was written last, by time of its last file, then step in its name.
    """
    by = ["run_id", "checkpoint"]
    held = files.groupBy(*by).agg(
        F.array_sort(F.collect_set("file")).alias("files"), F.sum("bytes").alias("bytes"), F.max("mtime").alias("_written"),
        F.array_compact(F.array(*(F.when(F.count_if(F.col("file") == F.lit(f)) == 0, F.lit(f)) for f in required))).alias("missing"),
    )
    malformed = F.lit(None).cast("string")
    for name, (all_of, any_of) in keys.items():
        _, valid = _key_check(F.col("document"), all_of, any_of)
        malformed = F.when((F.col("file") == name) & ~valid, F.lit(name)).otherwise(malformed)
    number = lambda field: F.get_json_object("document", f"$.{field}").try_cast("bigint")
    step, epoch = number("global_step"), number("epoch")
    sound = (step >= 0) & (epoch >= 0) & (step == checkpoint_step(F.col("checkpoint"))) & F.array_contains(
        F.json_object_keys("document"), "optimizer_state_dict"
    )
    checked = documents.select(
        *by, malformed.alias("malformed"), F.when(F.col("file") == state, F.coalesce(sound, F.lit(False))).alias("ok"), epoch.alias("epoch"), step.alias("step")
    ).groupBy(*by).agg(
        F.array_sort(F.collect_set("malformed")).alias("malformed"), F.min("ok").alias("state_ok"),
        F.max_by("epoch", "ok").alias("_epoch"), F.max_by("step", "ok").alias("_step"),
    )
    audited = null_safe(held, checked, by, "left")
    rank = F.struct("_written", checkpoint_step(F.col("checkpoint")).alias("step"), "checkpoint")
    last = audited.groupBy("run_id").agg(F.max(rank).alias("_last"))
    return null_safe(audited, last, ["run_id"]).select(
        *by, "files", F.size("files").cast("bigint").alias("n_files"), "bytes", megabytes(F.col("bytes")).alias("mb"), "missing",
        F.coalesce("malformed", F.array().cast("array<string>")).alias("malformed"), "state_ok",
        F.when(F.col("state_ok"), F.col("_epoch") + F.lit(1)).alias("resume_epoch"), F.when(F.col("state_ok"), F.col("_step")).alias("resume_step"),
        (F.col("_last.checkpoint") == F.col("checkpoint")).alias("newest"),
    )
