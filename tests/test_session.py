"""Scratch space lives below the cluster's checkpoint folder."""

from lakeshore.session import ensure_checkpoint_dir, scratch_dir


def test_scratch_below_checkpoint_dir(spark):
    ckpt = ensure_checkpoint_dir(spark)
    assert ckpt
    configured = spark.conf.get("spark.checkpoint.dir", None)
    a, b = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    assert a != b                                           # a fresh folder per use
    base = (configured or ckpt).rstrip("/")
    assert a.startswith(base + "/lakeshore-work/x-")


def test_existing_checkpoint_dir_is_kept(spark):
    before = spark.sparkContext.getCheckpointDir()
    assert ensure_checkpoint_dir(spark) == before          # never replaced once set


def test_a_cluster_must_name_its_shared_folder(spark):
    import pytest

    class Context:
        master = "spark://host:7077"
        getCheckpointDir = staticmethod(lambda: None)
        getConf = staticmethod(dict)

    class Session:
        sparkContext = Context
        conf = {}

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session)


def test_old_work_folders_are_swept(spark, monkeypatch, tmp_path):
    import os

    from lakeshore import session
    monkeypatch.setattr(session, "scratch_dir", lambda s, name: f"file://{tmp_path}/work/{name}-1")
    assert session.sweep_scratch(spark) == 0
    for name, age in (("old", 30 * 3600), ("new", 0)):
        os.makedirs(tmp_path / "work" / name / "inner")
        os.utime(tmp_path / "work" / name, (1_700_000_000,) * 2 if age else None)
    assert session.sweep_scratch(spark) == 1
    assert os.listdir(tmp_path / "work") == ["new"]


def test_folders_of_small_files_are_listed_by_a_few_tasks(spark, tmp_path):
    from lakeshore.session import LISTING, few_listing_tasks
    from lakeshore.sources.landed_csv import read_landed_csv
    folders = 8 * spark.sparkContext.defaultParallelism + 40
    for k in range(folders):
        (tmp_path / f"dt=2026-03-01/city=c{k}").mkdir(parents=True)
        (tmp_path / f"dt=2026-03-01/city=c{k}/part-0.csv").write_text("location_name,location_id\n")
    before = spark.conf.get(LISTING)
    group = f"listing-{tmp_path.name}"
    spark.sparkContext.setJobGroup(group, "listing")
    try:
        read_landed_csv(spark, str(tmp_path))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    tracker = spark.sparkContext.statusTracker()
    tasks = [tracker.getStageInfo(s).numTasks for j in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(j).stageIds]
    assert tasks and max(tasks) <= 4 * spark.sparkContext.defaultParallelism
    assert spark.conf.get(LISTING) == before
    spark.conf.set(LISTING, "3")
    try:
        with few_listing_tasks(spark):
            assert spark.conf.get(LISTING) == "3"  # no more than the session asks for
    finally:
        spark.conf.set(LISTING, before)
