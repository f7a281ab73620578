"""Column functions case by case, against plain Python where that is shorter."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from acopio import contracts as C
from acopio.functions import (
    base_name, blank, dataset_name, file_type, local_time, loose_bool, loose_int, reader_options, relative_path,
)
from acopio.operators import landing
from acopio.operators.shaping import extra_expressions, union_all
from acopio.sinks.tables import is_constant


def values(spark, column, cases, kind="string"):
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cases)], f"i int, x {kind}")
    return [r.y for r in df.select("i", column(F.col("x")).alias("y")).orderBy("i").collect()]


def test_file_type(spark):
    cases = {
        "a.csv": "csv", "A.CSV.GZ": "csv", "a.csv.gzip": "csv", "a.txt.bz2": "txt", "a.json.zip": "json", "a.parquet": "parquet",
        "a.xlsx": "excel", "a.XLS": "excel", "a.csv.gz.gz": "unknown", "a.gz": "unknown", "csv": "unknown", "a.csv.bak": "unknown",
    }
    assert values(spark, file_type, cases) == list(cases.values())


def test_dataset_name(spark):
    cases = ["s3a://b/x/ventas_2024_01.csv.gz", "ventas.csv", "_x.csv", "a.b_c.csv", "dir_1/plain", "dir/", "f:/z.zip::in/ñ_uno.csv"]

    def expected(path):
        stem = path.split("/")[-1].split(".")[0]
        return stem.split("_")[0]

    assert values(spark, dataset_name, cases) == [expected(c) for c in cases]


def test_base_name_and_relative_path(spark):
    assert values(spark, base_name, ["/a/b c.csv", "x", "a/"]) == ["b c.csv", "x", ""]
    rel = lambda c: relative_path(c, "s3a://b/in")
    assert values(spark, rel, ["s3a://b/in/x/y.csv", "s3a://b/in//y.csv", "s3a://b/in"]) == ["x/y.csv", "y.csv", ""]


def test_loose_values(spark):
    flags = [" TRUE ", "1", "Yes", "y", "si", "SÍ", "false", "0", "no", "N", "", None, "maybe"]
    assert values(spark, lambda c: loose_bool(c, True), flags) == [True] * 6 + [False] * 4 + [True] * 3
    numbers = ["5", " -7 ", "+3", "", None, "1.5", "x", "99999999999"]
    assert values(spark, lambda c: loose_int(c, 9), numbers) == [5, -7, 3, 9, 9, 9, 9, 9]
    assert values(spark, blank, [None, "", "  ", "x"]) == [True, True, True, False]


def test_reader_options(spark):
    got = values(spark, reader_options, ['{"csv":{"header":true,"sep":";"},"json":{}}', "", "{bad"])
    assert got == [{"csv": {"header": "true", "sep": ";"}, "json": {}}, {}, None]


def test_local_time(spark):
    df = spark.sql("SELECT TIMESTAMP '2024-03-01 02:30:00' AS t").select(local_time("t").cast("string").alias("t"))
    assert df.first().t == "2024-02-29 21:30:00"


def test_expected_names(spark):
    names = lambda *a: sorted(r.file_name for r in landing.expected_names(spark, *a).collect())
    assert names("ventas.csv") == ["ventas.csv"]
    assert names("ventas.tar.gz", "2024-02-28", "2024-03-01") == [
        "ventas.tar_20240228.gz", "ventas.tar_20240229.gz", "ventas.tar_20240301.gz"
    ]
    assert len(names("v", "2000-01-01", "2019-12-31")) == (dt.date(2019, 12, 31) - dt.date(2000, 1, 1)).days + 1


def test_readiness(spark):
    listing = spark.createDataFrame(
        [("old", 5, 100), ("young_same", 5, 990), ("young_grown", 5, 990), ("young_gone", 5, 990), ("empty", 0, 100), ("edge", 1, 970)],
        "path string, remote_size long, remote_mtime long",
    )
    again = spark.createDataFrame([("young_same", 5), ("young_grown", 6)], "path string, remote_size long")
    ready = lambda second: {r.path for r in landing.readiness(listing, 1000, second).where("ready").collect()}
    assert ready(again) == {"old", "young_same", "edge"}
    assert ready(None) == {"old", "edge"}


@pytest.mark.parametrize(
    "results, estado, error",
    [
        (["PROCESADO", "ERROR_CARGA", "ERROR_DESCUBRIMIENTO"], "FALLIDO", C.MSG_LANDING_ERRORS.format(n=2)),
        (["PROCESADO", "OMITIDO_NO_LISTO"], "FINALIZADO", ""),
        (["OMITIDO_NO_LISTO", "OMITIDO_YA_PROCESADO"], "FALLIDO", C.MSG_LANDING_SKIPPED.format(n=2)),
        ([], "FALLIDO", C.MSG_LANDING_NONE),
    ],
)
def test_landing_state(spark, results, estado, error):
    df = spark.createDataFrame([(r,) for r in results], "status string")
    row = landing.landing_state(landing.landing_tally(df)).first()
    assert (row.estado, row.error) == (estado, error)


def test_extras_and_constants():
    assert extra_expressions("a AS b; ;c;") == ["a AS b", "c"]
    assert extra_expressions(["concat(a, ';') AS b", " "]) == ["concat(a, ';') AS b"]
    assert extra_expressions(None) == []
    assert is_constant("DATE'2024-01-31' AS periodo", ["k", "fecha"])
    assert is_constant("'fecha' AS periodo", ["fecha"])
    assert not is_constant("date_format(FECHA, 'yyyy-MM') AS periodo", ["fecha"])


def test_union_all(spark):
    assert union_all([]) is None
    frames = [spark.createDataFrame([(i,)], f"c{i % 3} int") for i in range(7)]
    out = union_all(frames)
    assert out.count() == 7 and sorted(out.columns) == ["c0", "c1", "c2"]
