"""Work per file that must not grow into work per task or per frame."""

import os

from pyspark.sql import functions as F

from acopio.operators.discovery import manifest_from_paths
from acopio.sources import listing, readers
from queries import landed


def _jobs(spark, work):
    """Tasks of the largest stage of each job that ``work`` starts."""
    sc, group = spark.sparkContext, os.urandom(4).hex()
    sc.setJobGroup(group, group)
    done = work()
    tracker = sc.statusTracker()
    stages = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(j).stageIds]
    sc.setLocalProperty("spark.jobGroup.id", None)
    return done, [s.numTasks for s in stages if s is not None]


def test_directories_share_frames(tmp_path):
    """A tree of directories with a file each is listed in frames of many entries, in the old order and with errors."""
    for i in range(30):
        (tmp_path / f"d{i}").mkdir()
        (tmp_path / f"d{i}" / "x").write_text("x" * i)
    found = [e for i in range(30) for e in listing._list_one(listing.Store(), f"{tmp_path}/d{i}")]
    frame = listing._entries(found)
    assert len(frame) == 30 and frame["remote_size"].tolist() == list(range(30)) and set(frame["kind"]) == {"file"}
    (lost,) = listing._list_one(listing.Store(), f"{tmp_path}/none")
    assert lost[2] == "error" and listing._entries([lost])["remote_size"].isna().all() and listing._entries([]).empty


def test_paths_of_a_scan_are_listed_in_few_tasks(spark, tmp_path):
    paths = []
    for i in range(150):
        (tmp_path / f"f{i}.csv").write_text(f"v\n{i}\n")
        paths.append((f"{tmp_path}/f{i}.csv",))
    name = listing._LISTING_TASKS
    assert spark.conf.get(name, None) is None
    manifest = manifest_from_paths(spark.createDataFrame(paths, "path string"))
    read = lambda: readers.read_files(manifest, {"csv": {"header": "true"}}, run_id="r", unzip_to="")
    result, tasks = _jobs(spark, read)
    assert tasks and max(tasks) < 150 and spark.conf.get(name, None) is None
    assert sorted(int(r["v"]) for r in result.rows.collect()) == list(range(150))
    spark.conf.set(name, "3")
    try:
        with listing.few_listing_tasks(spark):
            assert spark.conf.get(name) == "3"
        assert spark.conf.get(name) == "3"
    finally:
        spark.conf.unset(name)


def test_what_is_held_is_found_by_tasks(spark, tmp_path, monkeypatch):
    for i in range(40):
        (tmp_path / "lake" / "held" / f"d{i}").mkdir(parents=True)
        (tmp_path / "lake" / "held" / f"d{i}" / "x.txt").write_text(str(i % 3))
    (tmp_path / "lake" / "held" / "d0" / "empty.txt").write_text("")
    monkeypatch.setattr(type(spark.read), "format", lambda *a: (_ for _ in ()).throw(AssertionError("listed by the driver")))
    held = landed._held(spark, f"{tmp_path}/lake/held", f"{tmp_path}/lake")
    assert held.count() == 40 and held.agg(F.count_distinct("hash")).first()[0] == 3
    assert held.where("path = 'held/d7/x.txt'").first()["hash"] == "6b86b273ff34fce19d6b804eff5a3f5747ada4eaa22f1d49c01e52ddb7875b4b"
