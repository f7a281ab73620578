"""Landing real files: decisions, zones, checkpoint, outcome."""

import gzip
import hashlib
import os
import time

import pytest

from acopio import contracts as C
from acopio.operators import landing
from acopio.plans.discovery import commit, discover
from acopio.plans.landing import land

OPTIONS = {
    "relative_upload_file_path": "ventas",
    "relative_upload_control_path": "control",
    "readiness_wait_seconds": "0",
    "checkpoint_prefix": "control/leidos",
}


@pytest.fixture
def place(tmp_path):
    (tmp_path / "src").mkdir()
    (tmp_path / "lake").mkdir()
    return tmp_path


def put(place, name, data=b"a,b\n1,2\n", age=3600):
    path = place / "src" / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(data)
    then = time.time() - age
    os.utime(path, (then, then))
    return path


def params(spark, place, name="v.csv", first=None, last=None):
    return spark.createDataFrame(
        [(str(place / "src"), str(place / "lake"), name, first, last)],
        "source_uri string, landing_uri string, NOMBRE_ARCHIVO string, FECHA_DESDE string, FECHA_HASTA string",
    )


def states(run):
    return {r.source.rsplit("/src/", 1)[-1]: (r.status, r.message) for r in run.results.collect()}


def test_land_zones_checkpoint_and_second_run(spark, place):
    put(place, "a/v.csv", b"uno")
    put(place, "b/v.csv", b"dos")
    put(place, "c/v.csv", b"uno")  # same content, later path
    put(place, "d/other.csv", b"zzz")
    put(place, "e/v.csv", b"")
    run = land(spark, params(spark, place), OPTIONS)
    lake = place / "lake" / "ventas" / "original"
    assert [r.path for r in run.outcome.collect()] == [str(lake / "a/v.csv"), str(lake / "b/v.csv")]
    assert (lake / "a/v.csv").read_bytes() == b"uno" and not (lake / "c/v.csv").exists()
    assert states(run) == {
        "a/v.csv": ("PROCESADO", ""),
        "b/v.csv": ("PROCESADO", ""),
        "c/v.csv": ("OMITIDO_YA_PROCESADO", C.MSG_KNOWN_HASH),
        "e/v.csv": ("OMITIDO_NO_LISTO", C.MSG_NOT_READY),
    }
    check = spark.read.parquet(str(place / "lake/control/checkpoints/files")).orderBy("relative_path").collect()
    assert [(r.relative_path, r.hash, r.s3_key, r.remote_size) for r in check] == [
        ("a/v.csv", hashlib.sha256(b"uno").hexdigest(), "ventas/original/a/v.csv", 3),
        ("b/v.csv", hashlib.sha256(b"dos").hexdigest(), "ventas/original/b/v.csv", 3),
    ]

    again = land(spark, params(spark, place), OPTIONS)
    assert states(again)["a/v.csv"] == ("OMITIDO_YA_PROCESADO", C.MSG_KNOWN_SIGNATURE)
    assert again.outcome.first().estado == "FALLIDO"
    assert again.outcome.first().error == C.MSG_LANDING_SKIPPED.format(n=4)

    put(place, "a/v.csv", b"tres")  # changed content, new signature
    assert states(land(spark, params(spark, place), OPTIONS))["a/v.csv"] == ("PROCESADO", "")


def test_gzip_is_known_by_content(spark, place):
    put(place, "x/v.gz.d/v.csv", gzip.compress(b"plano"))
    run = land(spark, params(spark, place), OPTIONS)
    assert run.results.first().status == "PROCESADO"
    assert (place / "lake/ventas/uncompressed/x/v.gz.d/v.csv").read_bytes() == b"plano"
    put(place, "y/v.gz", gzip.compress(b"otro"))
    put(place, "z/v.gz", b"not gzip")
    land(spark, params(spark, place, "v.gz"), OPTIONS)
    assert (place / "lake/ventas/uncompressed/y/v").read_bytes() == b"otro"
    assert not (place / "lake/ventas/uncompressed/z").exists()


def test_damaged_gzip_goes_to_quarantine(spark, place):
    whole = gzip.compress(os.urandom(5000))
    put(place, "v.gz", whole[:2000])
    put(place, "w/v.gz", gzip.compress(b"bien"))
    run = land(spark, params(spark, place, "v.gz"), OPTIONS)
    assert states(run)["v.gz"][0] == "ERROR_CARGA"
    assert (place / "lake/ventas/quarantine/v.gz").read_bytes() == whole[:2000]
    # the run is reported as failed, yet what was landed is known and recorded
    assert run.outcome.first().error == C.MSG_LANDING_ERRORS.format(n=1)
    assert [r.path for r in run.landed.collect()] == [str(place / "lake/ventas/original/w/v.gz")]


def test_young_files_are_looked_at_twice(spark, place):
    put(place, "v.csv", b"x", age=0)
    assert states(land(spark, params(spark, place), OPTIONS))["v.csv"] == ("PROCESADO", "")


def test_daily_window(spark, place):
    for day in ("20240227", "20240228", "20240229", "20240301", "20240302"):
        put(place, f"v_{day}.csv", day.encode())
    run = land(spark, params(spark, place, "v.csv", "2024-02-28", "2024-03-01"), OPTIONS)
    assert sorted(states(run)) == ["v_20240228.csv", "v_20240229.csv", "v_20240301.csv"]


@pytest.mark.parametrize(
    "first, last, message",
    [
        ("2024-01-01", "YYYY-MM-DD", C.MSG_WINDOW_HALF),
        ("2024-13-01", "2024-01-01", C.MSG_WINDOW_FORMAT),
        ("2024-02-01", "2024-01-01", C.MSG_WINDOW_ORDER),
    ],
)
def test_bad_windows(spark, place, first, last, message):
    assert land(spark, params(spark, place, "v.csv", first, last), OPTIONS).outcome.first().error == message


def test_refused_parameters(spark, place):
    run = land(spark, spark.createDataFrame([("x",)], "source_uri string"), OPTIONS)
    assert run.outcome.first().error == C.MSG_MISSING_COLUMNS + "NOMBRE_ARCHIVO, landing_uri"
    run = land(spark, params(spark, place).limit(0), OPTIONS)
    assert run.outcome.first().error == C.MSG_NO_PARAMETERS
    run = land(spark, params(spark, place, "  "), OPTIONS)
    assert run.outcome.first().error == "Falta parámetro requerido 'NOMBRE_ARCHIVO'"
    run = land(spark, params(spark, place), {})
    assert run.outcome.first().error == "Falta parámetro requerido 'relative_upload_file_path'"


def test_nothing_found_and_missing_source(spark, place):
    assert land(spark, params(spark, place), OPTIONS).outcome.first().error == C.MSG_LANDING_NONE
    gone = spark.createDataFrame(
        [(str(place / "none"), str(place / "lake"), "v.csv")], "source_uri string, landing_uri string, NOMBRE_ARCHIVO string"
    )
    assert land(spark, gone, OPTIONS).outcome.first().error == C.MSG_LANDING_ERRORS.format(n=1)


def test_old_checkpoint_without_sizes(spark, place):
    put(place, "v.csv", b"uno")
    digest = hashlib.sha256(b"uno").hexdigest()
    old = spark.createDataFrame([("z.csv", digest, "k")], "relative_path string, hash string, s3_key string")
    old.write.parquet(str(place / "lake/control/checkpoints/files"))
    assert states(land(spark, params(spark, place), OPTIONS))["v.csv"] == ("OMITIDO_YA_PROCESADO", C.MSG_KNOWN_HASH)


def test_damaged_checkpoint_is_an_error(spark, place):
    put(place, "v.csv", b"uno")
    bad = place / "lake/control/checkpoints/files"
    bad.mkdir(parents=True)
    (bad / "part-0.parquet").write_bytes(b"junkjunkjunk")
    assert land(spark, params(spark, place), OPTIONS).outcome.first().estado == "FALLIDO"
    assert not (place / "lake/ventas").exists()


def test_hot_content_keeps_one_first(spark):
    files = spark.range(5000).selectExpr(
        "format_string('p%05d', id) AS path", "CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('h', id) END AS hash"
    )
    done = spark.createDataFrame([("h1",), (None,), ("",)], "hash string")
    first = landing.first_per_content(files, done)
    assert first.count() == 5000
    assert [r.path for r in first.where("hash = 'hot' AND is_first").collect()] == ["p00000"]
    assert first.where("hash = 'h1' AND is_first").count() == 0
    assert first.where("is_first").count() == 1 + 5000 - 1667 - 1


def test_discover(spark, place):
    raw = place / "lake/ventas/original/x"
    raw.mkdir(parents=True)
    for n in ("a.csv", "b.csv", "c.zip"):
        (raw / n).write_text("1")
    p = spark.createDataFrame([(str(place / "lake"), str(place / "lake"))], "BUCKET_BLOB string, BUCKET_RAW string")
    pending = discover(spark, None, p, OPTIONS)
    assert pending.columns == C.MANIFEST.fieldNames() and pending.count() == 3
    path = {r.path.rsplit("/", 1)[-1]: r.path for r in pending.collect()}
    done = spark.createDataFrame(
        [(path["a.csv"], path["a.csv"]), (path["c.zip"] + "::m.csv", path["c.zip"])], "path string, source_file string"
    )
    commit(done, str(place / "lake/control/leidos"))
    assert [r.path for r in discover(spark, None, p, OPTIONS).collect()] == [path["b.csv"]]
    # paths handed over by landing
    upload = spark.createDataFrame([(path["a.csv"],), ("/n.csv",), ("/n.csv",), ("",), (None,)], "path string")
    assert [r.path for r in discover(spark, upload, p, OPTIONS).collect()] == ["/n.csv"]


def test_discover_with_a_checkpoint_of_two_layouts(spark, place):
    at = str(place / "lake/control/leidos")
    spark.createDataFrame([("/a",)], "path string").write.parquet(at)
    spark.createDataFrame([("/z.zip::m", "/z.zip")], "path string, source_file string").write.mode("append").parquet(at)
    p = spark.createDataFrame([(str(place / "lake"),)], "BUCKET_RAW string")
    upload = spark.createDataFrame([("/a",), ("/b",), ("/z.zip",)], "path string")
    assert [r.path for r in discover(spark, upload, p, OPTIONS).collect()] == ["/b"]


def test_discover_contracts(spark, place):
    p = spark.createDataFrame([(str(place), " ")], "BUCKET_BLOB string, BUCKET_RAW string")
    failed = C.status_frame(spark, "fallido", "red")
    assert discover(spark, failed, p, OPTIONS).first().error == "red"
    assert discover(spark, C.status_frame(spark, "FINALIZADO"), p, OPTIONS).first().error == C.MSG_STATUS_WITHOUT_PATHS
    up = spark.createDataFrame([("/a",)], "path string")
    assert discover(spark, up, p, OPTIONS).first().error == "Falta parámetro requerido 'BUCKET_RAW' en tri_parametros_discovery"
    assert discover(spark, None, None, OPTIONS).first().error == "Falta parámetro requerido 'BUCKET_BLOB' en tri_parametros_discovery"
    assert discover(spark, None, p, {}).first().error == "Falta parámetro requerido 'relative_upload_file_path'"
