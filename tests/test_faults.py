"""Which faults become rows and which end the run; files dealt by bytes; discovery by tasks."""

import errno
import os
import random
import zipfile

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from acopio import contracts as C
from acopio.operators import discovery
from acopio.plans.discovery import discover
from acopio.sources import faults, readers
from acopio.sources.deal import OPENING, by_bytes
from acopio.sources.faults import MISSING, REFUSED, UNREACHABLE, UNREADABLE, StoreUnreachable, fault_of, refuses_a_file, tried
from acopio.sources.store import Store


@pytest.mark.parametrize(
    "exc, kind",
    [
        (FileNotFoundError(errno.ENOENT, "no"), MISSING),
        (FileNotFoundError("[PATH_NOT_FOUND] x"), MISSING),
        (PermissionError(errno.EACCES, "no"), REFUSED),
        (OSError("When reading key 'a' in bucket 'b': AWS Error ACCESS_DENIED during HeadObject"), REFUSED),
        (OSError("AWS Error NETWORK_CONNECTION during GetObject: curlCode: 28, Timeout was reached"), UNREACHABLE),
        (OSError("AWS Error SLOW_DOWN during GetObject"), UNREACHABLE),
        (ConnectionResetError("x"), UNREACHABLE),
        (OSError(errno.ETIMEDOUT, "x"), UNREACHABLE),
        (zipfile.BadZipFile("x"), UNREADABLE),
        (EOFError("Compressed file ended"), UNREADABLE),
        (ValueError("connection of columns"), UNREADABLE),
        (OSError("Couldn't deserialize thrift"), UNREADABLE),
    ],
)
def test_kinds(exc, kind):
    assert fault_of(exc) == kind


def test_tries_are_bounded():
    calls = []

    def work(fail):
        calls.append(1)
        if len(calls) <= fail:
            raise ConnectionError("down")
        return "done"

    assert tried(lambda: work(2), (0, 0, 0)) == "done" and len(calls) == 3
    calls.clear()
    with pytest.raises(StoreUnreachable):
        tried(lambda: work(99), (0, 0, 0))
    assert len(calls) == 4
    with pytest.raises(ValueError):
        tried(lambda: int("x"), (0,))


def test_what_spark_refuses():
    assert refuses_a_file(AnalysisException("[PATH_NOT_FOUND] Path does not exist: file:/x"))
    assert refuses_a_file(RuntimeError("[FAILED_READ_FILE.CANNOT_READ_FILE_FOOTER] Could not read footer for file: x"))
    assert not refuses_a_file(RuntimeError("Job aborted due to stage failure: ExecutorLostFailure"))
    assert not refuses_a_file(RuntimeError("[FAILED_READ_FILE] x: java.net.UnknownHostException: store"))


def test_an_outage_is_not_halved(spark, monkeypatch):
    asked = []

    def down(*args):
        asked.append(args)
        raise RuntimeError("Job aborted: java.net.ConnectException")

    monkeypatch.setattr(readers, "_load", down)
    with pytest.raises(RuntimeError):
        readers._scan(spark, "csv", {}, [f"/f{i}" for i in range(100)], [])
    assert len(asked) == 1


def test_an_unreachable_store_fails_the_look(spark, tmp_path, monkeypatch):
    (tmp_path / "a.csv").write_text("k\n1\n")
    manifest = discovery.manifest_from_paths(spark.createDataFrame([(f"{tmp_path}/a.csv",), (f"{tmp_path}/b.csv",)], "path string"))
    read = lambda: readers.read_files(manifest, {"csv": {"header": "true"}}, run_id="r", unzip_to=f"{tmp_path}/z")
    assert read().errors.count() == 1

    def look(store, path, ext, options):
        raise ConnectionError("down")

    from acopio.sources import probe

    monkeypatch.setattr(probe, "_look", look)
    monkeypatch.setattr(faults, "WAITS", ())
    with pytest.raises(Exception, match="store not reached|down"):
        read()


@pytest.mark.parametrize("seed", range(4))
def test_shares_of_bytes(spark, seed):
    rng = random.Random(seed)
    sizes = [rng.choice([0, 10, 1000, 10**6, rng.randint(0, 10**7), 10**8 if rng.random() < 0.02 else 5]) for _ in range(rng.choice([2, 30, 3000]))]
    files = spark.createDataFrame([(f"/f{i}", s if i % 9 else None) for i, s in enumerate(sizes)], "path string, remote_size long")
    dealt = by_bytes(files).withColumn("task", F.spark_partition_id())
    assert sorted(r.path for r in dealt.collect()) == sorted(r.path for r in files.collect())
    loads = dealt.groupBy("task").agg(F.sum(F.coalesce("remote_size", F.lit(0)) + OPENING).alias("load"), F.count(F.lit(1)).alias("n")).collect()
    total = sum(r.load for r in loads)
    tasks = max(spark.sparkContext.defaultParallelism, 8)
    assert all(r.n == 1 or r.load <= 1.2 * total / tasks + 1 for r in loads)
    assert by_bytes(files.limit(0)).count() == 0 and by_bytes(files.limit(1)).count() == 1


def test_discovery_lists_by_tasks(spark, tmp_path):
    raw = tmp_path / "lake/ventas/original"
    for n in ("a/b/x.csv", "a/y.csv", "z é.csv", "a/_hidden.csv", ".part", "a/_tmp/q.csv"):
        (raw / n).parent.mkdir(parents=True, exist_ok=True)
        (raw / n).write_text("1")
    p = spark.createDataFrame([(str(tmp_path / "lake"), str(tmp_path / "lake"))], "BUCKET_BLOB string, BUCKET_RAW string")
    options = {"relative_upload_file_path": "ventas", "checkpoint_prefix": "control/leidos"}
    found = discover(spark, None, p, options).collect()
    assert sorted(r.path for r in found) == sorted(f"file:{raw}/{n}" for n in ("a/b/x.csv", "a/y.csv", "z é.csv"))
    assert {r.discovery_status for r in found} == {C.PENDIENTE}
    if os.geteuid() != 0:
        (raw / "a/b").chmod(0)
        failed = [r for r in discover(spark, None, p, options).collect() if r.discovery_status == C.ERROR_DESCUBRIMIENTO]
        assert len(failed) == 1 and failed[0].source_file.endswith("/a/b")
        (raw / "a/b").chmod(0o755)
    missing = spark.createDataFrame([(str(tmp_path / "none"), str(tmp_path))], "BUCKET_BLOB string, BUCKET_RAW string")
    with pytest.raises(FileNotFoundError):
        discover(spark, None, missing, options)


def test_unlistable_directory_is_a_row(spark, tmp_path, monkeypatch):
    from acopio.sources import listing

    (tmp_path / "lake/ventas/original/a").mkdir(parents=True)
    (tmp_path / "lake/ventas/original/a/x.csv").write_text("1")
    real = Store.at

    def at(self, uri):
        if uri.endswith("/a"):
            raise PermissionError("access denied")
        return real(self, uri)

    monkeypatch.setattr(listing.Store, "at", at)
    p = spark.createDataFrame([(str(tmp_path / "lake"), str(tmp_path / "lake"))], "BUCKET_BLOB string, BUCKET_RAW string")
    found = discover(spark, None, p, {"relative_upload_file_path": "ventas", "checkpoint_prefix": "c"}).collect()
    assert [(r.path, r.discovery_status, r.error_message) for r in found] in (
        [(None, C.ERROR_DESCUBRIMIENTO, "access denied")],
        [(f"file:{tmp_path}/lake/ventas/original/a/x.csv", C.PENDIENTE, None)],  # workers that do not see the patch
    )
