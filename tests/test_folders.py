"""Checkpoint folders on disk: listing, documents and audit."""

import os

import pytest

from conftest import plan
from sftlake.operators import checkpoints as ck
from sftlake.sources import folders as fo

STATE = "training_state.json"


def write(folder, files, mtime):
    folder.mkdir(parents=True)
    for name, text in files.items():
        path = folder / name
        path.parent.mkdir(exist_ok=True)
        path.write_text(text)
        os.utime(path, (mtime, mtime))


@pytest.fixture
def root(tmp_path):
    whole = {"config.json": '{"model_type": "m", "vocab_size": 5}', "tokenizer.json": "{}", "tokenizer_config.json": '{"model_max_length": 9}', "model.safetensors": "w" * 1000}
    state = lambda epoch, step, more=', "optimizer_state_dict": {"a": 1}': f'{{"epoch": {epoch}, "global_step": {step}{more}}}'
    write(tmp_path / "run a+b" / "checkpoint-epoch1-step10", {**whole, STATE: state(0, 10)}, 2000)
    write(tmp_path / "run a+b" / "checkpoint-epoch2-step20", {**whole, STATE: state(1, 21)}, 1000)  # written before, step is not that of the name
    write(tmp_path / "r2" / "checkpoint-epoch1-step5", {"config.json": "not json", "tokenizer_config.json": "{}", STATE: state(0, 5, "")}, 1000)
    write(tmp_path / "r2" / "checkpoint-epoch1-step6", {"config.json": '{"model_type": null, "vocab_size": null}', "deep/part.bin": "12345"}, 1000)
    write(tmp_path / "r2" / "logs", {"log.txt": "no checkpoint"}, 3000)
    return str(tmp_path)


def audit(spark, root):
    files = fo.read_checkpoint_files(spark, root)
    return files, ck.folder_audit(files, fo.read_checkpoint_documents(spark, root, [*ck.DOCUMENT_KEYS, STATE]))


def test_audit_of_written_folders(spark, root):
    rows = {(r.run_id, r.checkpoint): r for r in audit(spark, root)[1].collect()}
    assert len(rows) == 4
    good, odd = rows["run a+b", "checkpoint-epoch1-step10"], rows["run a+b", "checkpoint-epoch2-step20"]
    assert (good.missing, good.malformed, good.state_ok, good.resume_epoch, good.resume_step, good.newest) == ([], [], True, 1, 10, True)
    assert good.n_files == 5 and good.bytes == sum(os.path.getsize(os.path.join(root, "run a+b", good.checkpoint, f)) for f in good.files)
    assert (odd.state_ok, odd.resume_step, odd.newest) == (False, None, False)
    bad, old = rows["r2", "checkpoint-epoch1-step5"], rows["r2", "checkpoint-epoch1-step6"]
    assert bad.malformed == ["config.json", "tokenizer_config.json"] and bad.missing == ["tokenizer.json", "model.safetensors"] and bad.state_ok is False
    # Without a state file it predates resuming; of two written at the same time the higher step is the newest.
    assert (old.state_ok, old.malformed, old.files, old.newest, bad.newest) == (None, [], ["config.json", "deep/part.bin"], True, False)


def test_no_weight_byte_is_read(spark, root):
    files, found = audit(spark, root)
    found.collect()
    text = plan(files)
    assert "content" not in text and "length" in text
    # The text scan is of documents only.
    documents = fo.read_checkpoint_documents(spark, root, ["config.json", STATE])
    assert sorted(os.path.basename(f) for f in documents.inputFiles()) == ["config.json"] * 4 + [STATE] * 3
    # A file that cannot be read is listed all the same.
    weights = os.path.join(root, "r2", "checkpoint-epoch1-step6", "model.safetensors")
    with open(weights, "wb") as f:
        f.truncate(3 << 30)  # beyond what the scan could hold as one value
    again = fo.read_checkpoint_files(spark, root)
    assert again.where("file = 'model.safetensors'").agg({"bytes": "max"}).first()[0] == 3 << 30


def test_no_folders(spark, tmp_path):
    (tmp_path / "empty").mkdir()
    files, found = audit(spark, str(tmp_path))
    assert files.count() == 0 and found.count() == 0


def test_folders_are_written_and_listed_by_several_tasks(spark, tmp_path):
    from sftlake.plans import catalog
    from sftlake.plans import inputs as inp

    suppliers = spark.createDataFrame([(k, k % 3) for k in range(1, 121)], "s_suppkey bigint, s_nationkey int").coalesce(1)
    suppliers.write.parquet(str(tmp_path / "supplier.parquet"))
    root = inp.checkpoint_folders(spark, str(tmp_path))
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).select("path").collect()
    assert len({r.path.split("/part-")[1].split("-")[0] for r in found}) > 4  # files of many writing tasks
    # A weight file that could not be held as one value is not opened for the documents, and folders do not get a task each.
    local = root.removeprefix("file:")
    weight = next(os.path.join(d, f) for d, _, names in os.walk(local) for f in names if "file=model.safetensors" in d and f.startswith("part-"))
    os.unlink(os.path.join(os.path.dirname(weight), f".{os.path.basename(weight)}.crc"))
    with open(weight, "ab") as f:
        f.truncate(3 << 30)
    tracker, group = spark.sparkContext.statusTracker(), "listing"
    spark.sparkContext.setJobGroup(group, group)
    try:
        documents = fo.read_checkpoint_documents(spark, root, [*ck.DOCUMENT_KEYS, STATE], inp.FOLDER_LAYOUT, inside="*")
        stages = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(j).stageIds]
    finally:
        spark.sparkContext._jsc.clearJobGroup()
    assert stages and max(s.numTasks for s in stages) <= 4 * spark.sparkContext.defaultParallelism
    assert spark.conf.get(fo._LISTING) == "10000"
    want = sum((k * 7 + i) % 11 != 0 for k in range(1, 121) for i in (0, 2, 4))
    assert documents.count() == want == len(documents.collect())
    assert catalog.QUERIES["folder_audit"](spark, str(tmp_path)).count() == 120


def test_text_files_are_those_of_sparks_writer(spark, tmp_path):
    rows = [("r 1", "a/b=c%", "x", 1), ("r 1", "a/b=c%", "y", 3), (None, "ü", "wé", 400_000), ("", "ü", None, 1), ("r2", None, "z", 0), ("r2", "z", "z", 511), ("r 1", "a/b=c%", "x", 1), ("", "a", "1", 1), (None, "a", "2", 1)]
    df = spark.createDataFrame(rows, "k string, l string, value string, times int").coalesce(1)
    fo.write_text_files(df, str(tmp_path / "own"))
    df.selectExpr("k", "l", "repeat(value, times) AS value").write.partitionBy("k", "l").text(str(tmp_path / "spark"))

    def files(top):
        found = {}
        for folder, _, names in os.walk(top):
            for name in (n for n in names if "part-" in n):
                with open(os.path.join(folder, name), "rb") as f:
                    found[os.path.relpath(folder, top), "crc" if name.endswith(".crc") else "data"] = f.read()
        return found

    own, theirs = files(tmp_path / "own"), files(tmp_path / "spark")
    assert own.keys() == theirs.keys() and len(own) == 10
    lines = lambda found: {k: sorted(v.split(b"\n")) for k, v in found.items() if k[1] == "data"}
    assert lines(own) == lines(theirs)
    assert {k: v for k, v in own.items() if k[0].startswith("k=r2")} == {k: v for k, v in theirs.items() if k[0].startswith("k=r2")}
    assert not [n for _, _, names in os.walk(tmp_path / "own") for n in names if "part-" not in n]  # nothing half made is left
    # Read with the checksums checked.
    assert sorted(r.value or "" for r in spark.read.text(str(tmp_path / "own")).collect()) == sorted((v or "") * n for _, _, v, n in rows)


def test_one_listing_serves_files_and_documents(spark, root):
    listed, names = fo.listing(spark, root), [*ck.DOCUMENT_KEYS, STATE]
    assert sorted(fo.read_checkpoint_files(spark, listed).collect()) == sorted(fo.read_checkpoint_files(spark, root).collect())
    documents = fo.read_checkpoint_documents(spark, listed, names)
    assert sorted(documents.collect()) == sorted(fo.read_checkpoint_documents(spark, root, names).collect())
    # A weight file that could not be held as one value is not opened.
    with open(os.path.join(root, "run a+b", "checkpoint-epoch1-step10", "model.safetensors"), "wb") as f:
        f.truncate(3 << 30)
    again = fo.listing(spark, root)
    assert fo.read_checkpoint_documents(spark, again, names).count() == len(documents.collect())


def test_audit_reads_many_files_in_a_task(spark, tmp_path):
    from sftlake.plans import catalog

    suppliers = spark.createDataFrame([(k, k % 3) for k in range(1, 601)], "s_suppkey bigint, s_nationkey int")
    suppliers.write.parquet(str(tmp_path / "supplier.parquet"))
    cost = spark.conf.get("spark.sql.files.openCostInBytes")
    tracker, group = spark.sparkContext.statusTracker(), "audit"
    spark.sparkContext.setJobGroup(group, group)
    try:
        assert catalog.QUERIES["folder_audit"](spark, str(tmp_path)).count() == 600
        stages = {s: tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(j).stageIds}
    finally:
        spark.sparkContext._jsc.clearJobGroup()
    # Some 2,700 files; three runs are listed once.
    tasks = [s.numTasks for s in stages.values() if s is not None]
    assert max(tasks) <= 4 * spark.sparkContext.defaultParallelism and sum(tasks) < 150
    assert spark.conf.get("spark.sql.files.openCostInBytes") == cost


def test_text_files_in_another_store(spark, tmp_path):
    # A store that only Hadoop reaches gets Spark's writer.
    spark._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.texts.link./in", f"file://{tmp_path}")
    df = spark.createDataFrame([("r1", "x", 2), ("r2", "y", 1)], "k string, value string, times int")
    fo.write_text_files(df, "viewfs://texts/in/some")
    assert sorted(tuple(r) for r in spark.read.text(str(tmp_path / "some")).collect()) == [("xx", "r1"), ("y", "r2")]
