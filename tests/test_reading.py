"""Files of every kind in one folder, read by one call."""

import bz2
import gzip
import json
import zipfile

import pytest

from acopio.operators.discovery import manifest_from_paths
from acopio.plans.reading import read_backlog, read_normalise, read_waves
from acopio.sources.listing import list_files, walk_tree
from acopio.sources.readers import read_files

OPTIONS = {
    "csv": {"header": "true"},
    "txt": {"delimiter": "|", "header": "true"},
    "json": {},
    "parquet": {},
    "excel": {"sheet_name": "Hoja1"},
}

XLSX_BOOK = """<?xml version="1.0"?><workbook xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"
 xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><sheets>
 <sheet name="Otra" sheetId="1" r:id="rId1"/><sheet name="Hoja1" sheetId="2" r:id="rId2"/></sheets></workbook>"""
XLSX_RELS = """<?xml version="1.0"?><Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">
<Relationship Id="rId1" Target="worksheets/sheet1.xml"/><Relationship Id="rId2" Target="worksheets/sheet2.xml"/></Relationships>"""
XLSX_STRINGS = """<?xml version="1.0"?><sst xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main">
<si><t>nombre</t></si><si><r><t>va</t></r><r><t>lor</t></r></si><si><t>uno</t></si></sst>"""
XLSX_STYLES = """<?xml version="1.0"?><styleSheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main">
<cellXfs><xf numFmtId="0"/><xf numFmtId="14"/></cellXfs></styleSheet>"""
SHEET = """<?xml version="1.0"?><worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetData>{}</sheetData></worksheet>"""
SHEET2 = """<row r="1"><c r="A1" t="s"><v>0</v></c><c r="B1" t="s"><v>1</v></c><c r="C1" t="inlineStr"><is><t>fecha</t></is></c></row>
<row r="2"><c r="A2" t="s"><v>2</v></c><c r="B2"><v>1</v></c><c r="C2" s="1"><v>45292</v></c></row>
<row r="4"><c r="B4"><v>2.5</v></c></row>"""


def xlsx(path):
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("xl/workbook.xml", XLSX_BOOK)
        z.writestr("xl/_rels/workbook.xml.rels", XLSX_RELS)
        z.writestr("xl/sharedStrings.xml", XLSX_STRINGS)
        z.writestr("xl/styles.xml", XLSX_STYLES)
        z.writestr("xl/worksheets/sheet1.xml", SHEET.format(""))
        z.writestr("xl/worksheets/sheet2.xml", SHEET.format(SHEET2))


def put(folder, name, text):
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text if isinstance(text, bytes) else text.encode())
    return path


def manifest(spark, folder):
    return manifest_from_paths(list_files(spark, str(folder)).select("path"))


def read(spark, folder, options=OPTIONS, **kw):
    return read_files(manifest(spark, folder), options, run_id="r1", unzip_to=f"{folder}-unzip/original/descomprimido", **kw)


def rows(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=str)


def errors(result):
    return {r.path.rsplit("/", 1)[-1]: r.error_message for r in result.errors.collect()}


def test_listing_deep_and_flat(spark, tmp_path):
    put(tmp_path, "a.csv", "a\n1\n")
    put(tmp_path, "x/y/b c+ñ.csv", "a\n1\n")
    assert list_files(spark, str(tmp_path)).count() == 2
    assert list_files(spark, str(tmp_path), recursive=False).count() == 1
    files, bad = walk_tree(spark, str(tmp_path))
    assert rows(files, "relative_path", "remote_size") == [("a.csv", 4), ("x/y/b c+ñ.csv", 4)]
    assert bad.count() == 0


def test_listing_error_is_a_row(spark, tmp_path):
    files, bad = walk_tree(spark, str(tmp_path / "none"))
    assert files.count() == 0
    assert [(r.status, r.stage) for r in bad.collect()] == [("ERROR_DESCUBRIMIENTO", "DESCUBRIMIENTO")]


def test_csv_columns_follow_their_header(spark, tmp_path):
    put(tmp_path, "ventas_20240101.csv", "a,b\n1,2\n")
    put(tmp_path, "ventas_20240102.csv", "b,a,c\n3,4,5\n")
    put(tmp_path, "ventas_20240103.csv", "\na,b\n6,7\n")
    put(tmp_path, "vacio.csv", "")
    put(tmp_path, "raro [1]{x}.csv", "a,b\n8,9\n")
    r = read(spark, tmp_path)
    assert rows(r.rows, "a", "b", "c") == [
        ("1", "2", None), ("4", "3", "5"), ("6", "7", None), ("8", "9", None)
    ]
    assert errors(r) == {}
    out = r.output()
    assert out.columns == ["a", "b", "c", "fecha_ingesta", "batch_id", "nombre_archivo"]
    assert {x.nombre_archivo for x in out.collect()} == {
        "ventas_20240101.csv", "ventas_20240102.csv", "ventas_20240103.csv", "raro [1]{x}.csv"
    }
    assert out.select("batch_id").distinct().count() == 4


def test_csv_without_header_by_width(spark, tmp_path):
    put(tmp_path, "a.csv", '1,"x,y"\n')
    put(tmp_path, "b.csv", "1,2,3\n")
    r = read(spark, tmp_path, {"csv": {}})
    assert rows(r.rows, "_c0", "_c1", "_c2") == [("1", "2", "3"), ("1", "x,y", None)]


def test_csv_types_are_inferred_per_file(spark, tmp_path):
    put(tmp_path, "a.csv", "v\n007\n")
    put(tmp_path, "b.csv", "v\nabc\n010\n")
    put(tmp_path, "c.csv", "v\n1\n1.5\n")
    r = read(spark, tmp_path, {"csv": {"header": "true", "inferSchema": "true"}})
    assert rows(r.rows, "v") == [("010",), ("1.0",), ("1.5",), ("7",), ("abc",)]


def test_txt_plain_and_delimited(spark, tmp_path):
    put(tmp_path, "clientes.txt", "k|v\n1|uno\n")
    assert rows(read(spark, tmp_path).rows, "k", "v") == [("1", "uno")]
    assert rows(read(spark, tmp_path, {"txt": {}}).rows, "value") == [("1|uno",), ("k|v",)]


def test_json_keeps_each_files_types(spark, tmp_path):
    put(tmp_path, "x_1.json", '{"n":1,"z":{"q":1.5}}\n{"n":2}\n')
    put(tmp_path, "x_2.json", '{"n":1.5,"y":[1,2]}\n')
    put(tmp_path, "x_3.json", "garbage\n")
    put(tmp_path, "x_4.json", "")
    r = read(spark, tmp_path)
    assert rows(r.rows, "n", "y", "z") == [("1", None, "{1.5}"), ("1.5", "[1, 2]", None), ("2", None, None)]
    assert set(errors(r)) == {"x_3.json"}
    r = read(spark, tmp_path, {"json": {"primitivesAsString": "true"}})
    assert rows(r.rows, "n")[:2] == [("1",), ("1.5",)]


def test_json_that_only_sparks_reader_takes(spark, tmp_path):
    put(tmp_path, "a.json", "{'n':1}\n{'n':2,'s':'x'}\n")
    put(tmp_path, "b.json", "nothing\nat all\n")
    put(tmp_path, "c.json", '{"n":3}\n{"n":4,"t":null}\n')
    r = read(spark, tmp_path, {"json": {}})
    assert rows(r.rows, "n", "s") == [("1", None), ("2", "x"), ("3", None), ("4", None)]
    assert set(errors(r)) == {"b.json"}
    wide = tmp_path / "wide"
    wide.mkdir()
    (wide / "u.json").write_bytes('{"n":5}\n{"n":6}\n'.encode("utf-16-le"))
    r = read(spark, wide, {"json": {"encoding": "UTF-16LE", "lineSep": "\n"}})
    assert rows(r.rows, "n") == [("5",), ("6",)] and not errors(r)


def test_json_files_that_lack_keys_share_a_scan(spark, tmp_path):
    for i in range(6):
        put(tmp_path, f"f_{i}.json", json.dumps({"n": i, f"k{i}": "v"}))
    r = read(spark, tmp_path, {"json": {}})
    assert rows(r.rows, "n", "k3") == sorted([(str(i), "v" if i == 3 else None) for i in range(6)], key=str)
    assert r.rows._jdf.queryExecution().optimizedPlan().collectLeaves().size() == 1


def test_json_multiline(spark, tmp_path):
    put(tmp_path, "a.json", json.dumps([{"a": 1}, {"a": 2}], indent=1))
    assert rows(read(spark, tmp_path, {"json": {"multiLine": "true"}}).rows, "a") == [("1",), ("2",)]


def test_parquet_type_clash_and_truncated(spark, tmp_path):
    spark.range(2).selectExpr("id AS a").coalesce(1).write.parquet(str(tmp_path / "p1"))
    spark.range(2).selectExpr("concat('t', id) AS a").coalesce(1).write.parquet(str(tmp_path / "p2"))
    put(tmp_path, "bad.parquet", b"PAR1xxxxPAR1")
    empty = put(tmp_path, "empty.parquet", b"")
    # a file listing leaves out files without bytes, a path list may name one
    named = manifest(spark, tmp_path).unionByName(manifest_from_paths(spark.createDataFrame([(str(empty),)], "path string")))
    r = read_files(named, OPTIONS, run_id="r1", unzip_to="")
    assert rows(r.rows, "a") == [("0",), ("1",), ("t0",), ("t1",)]
    assert set(errors(r)) == {"bad.parquet", "empty.parquet"}


def test_folder_given_as_a_path(spark, tmp_path):
    target = str(tmp_path / "tabla.parquet")
    spark.range(3).repartition(2).write.parquet(target)
    m = spark.createDataFrame([(target,)], "path string")
    r = read_files(m, OPTIONS, run_id="r", unzip_to="")
    assert rows(r.rows, "id", "path", "dataset") == [(str(i), target, "tabla") for i in range(3)]


def test_compression(spark, tmp_path):
    put(tmp_path, "a.csv.gz", gzip.compress(b"a,b\n1,1\n"))
    put(tmp_path, "b.csv.gzip", gzip.compress(b"a,b\n2,2\n"))
    put(tmp_path, "c.csv.bz2", bz2.compress(b"a,b\n3,3\n"))
    put(tmp_path, "fake.csv.gz", "a,b\n4,4\n")
    put(tmp_path, "x.dat.gz", gzip.compress(b"1"))
    r = read(spark, tmp_path)
    assert rows(r.rows, "a") == [("1",), ("2",), ("3",)]
    e = errors(r)
    assert set(e) == {"fake.csv.gz", "x.dat.gz"}
    assert e["x.dat.gz"].startswith("No hay reader_options definidos para archivo comprimido: ")


def test_zip(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "datos_1.zip", "w") as z:
        z.writestr("in/ñ uno.csv", "a,b\n5,6\n")
        z.writestr("dos.json", '{"n":3}')
        z.writestr("readme.md", "x")
    with zipfile.ZipFile(tmp_path / "nada.zip", "w") as z:
        z.writestr("readme.md", "x")
    put(tmp_path, "roto.zip", "no zip")
    r = read(spark, tmp_path)
    got = {(x.path.rsplit("/", 1)[-1] if "::in" not in x.path else x.path.split("::")[1], x.a, x.n, x.dataset) for x in r.rows.collect()}
    assert got == {("in/ñ uno.csv", "5", None, "datos"), ("datos_1.zip::dos.json", None, "3", "datos")}
    e = errors(r)
    assert set(e) == {"nada.zip", "roto.zip"}
    assert e["nada.zip"].startswith("El ZIP no contiene archivos legibles")
    assert {x.source_file.rsplit("/", 1)[-1] for x in r.files.collect()} == {"datos_1.zip"}


def test_zip_with_damaged_member_fails_whole(spark, tmp_path):
    path = tmp_path / "d.zip"
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("a.csv", "a\n" + "1\n" * 50)
        z.writestr("b.csv", "a\n2\n")
    raw = bytearray(path.read_bytes())
    at = raw.index(b"1\n1\n")
    raw[at : at + 2] = b"9\n"
    path.write_bytes(bytes(raw))
    r = read(spark, tmp_path)
    assert r.rows is None
    assert set(errors(r)) == {"d.zip"}


def test_excel(spark, tmp_path):
    xlsx(tmp_path / "libro.xlsx")
    put(tmp_path, "viejo.xls", b"\xd0\xcf\x11\xe0")
    put(tmp_path, "roto.xlsx", "zz")
    r = read(spark, tmp_path)
    assert rows(r.rows, "nombre", "valor", "fecha") == [("uno", "1", "2024-01-01"), (None, "2.5", None)]
    assert set(errors(r)) == {"viejo.xls", "roto.xlsx"}
    r = read(spark, tmp_path, {"excel": {"sheetName": "Hoja1", "useHeader": "false"}})
    assert rows(r.rows, "_c0", "_c1")[0] == ("nombre", "valor")
    assert set(errors(read(spark, tmp_path, {"excel": {"sheetName": "Nada"}}))) == {"libro.xlsx", "viejo.xls", "roto.xlsx"}


def test_missing_options_unknown_type_and_inherited(spark, tmp_path):
    put(tmp_path, "a.csv", "a\n1\n")
    put(tmp_path, "b.json", '{"n":1}')
    put(tmp_path, "c.dat", "z")
    m = manifest(spark, tmp_path).unionByName(
        spark.createDataFrame(
            [("/x/d_1.csv", "error_carga", "sin red", "/x/d_1.csv"), ("/x/no.csv", "PENDIENTE", None, "/x/no.csv"),
             ("/x/skip.csv", "OMITIDO_NO_LISTO", None, None)],
            "path string, discovery_status string, error_message string, source_file string",
        )
    )
    r = read_files(m, {"csv": {"header": "true"}}, run_id="r", unzip_to="")
    e = errors(r)
    assert e["b.json"] == "No hay reader_options definidos para extensión 'json'"
    assert e["c.dat"] == "No hay reader_options definidos para extensión 'unknown'"
    assert e["d_1.csv"] == "sin red"
    assert "no.csv" in e and "skip.csv" not in e
    both = r.output()
    assert {x.record_status for x in both.collect()} == {"PROCESADO", "ERROR_LECTURA", "ERROR_UPSTREAM"}
    assert {x.error_stage for x in both.where("record_status <> 'PROCESADO'").collect()} == {"LECTURA_NORMALIZACION"}
    assert "ingestion_ts" in both.columns


def test_user_columns_named_like_contract_ones_survive(spark, tmp_path):
    put(tmp_path, "a.csv", "estado,path,error\nx,y,z\n")
    out = read(spark, tmp_path).output()
    assert rows(out, "origen_estado", "origen_path", "origen_error") == [("x", "y", "z")]


def test_nothing_to_read(spark):
    m = spark.createDataFrame([], "path string")
    out = read_files(m, OPTIONS, run_id="r", unzip_to="").output()
    assert out.count() == 0 and len(out.columns) == 8


def test_several_scans_per_layout_give_the_same_rows(spark, tmp_path):
    for i in range(7):
        put(tmp_path, f"v_{i}.csv", f"a\n{i}\n")
        put(tmp_path, f"j_{i}.json", json.dumps({"n": i}))
    r = read(spark, tmp_path, files_per_scan=2)
    assert rows(r.rows, "a", "n") == rows(read(spark, tmp_path).rows, "a", "n")
    assert r.rows.count() == 14


def test_waves_cover_every_file_once(spark, tmp_path):
    for i in range(9):
        put(tmp_path, f"v_{i}.csv", f"a\n{i}\n")
    params = spark.createDataFrame([(str(tmp_path), json.dumps(OPTIONS))], "BUCKET_BLOB string, READER_OPTIONS string")
    seen = []
    for wave in read_waves(spark, manifest(spark, tmp_path), params, {}, files_per_wave=4):
        seen += [] if wave.rows is None else [x.a for x in wave.rows.collect()]
    assert sorted(seen) == [str(i) for i in range(9)]
    together = read_backlog(spark, manifest(spark, tmp_path), params, {}, files_per_wave=4)
    assert sorted(x.a for x in together.collect()) == [str(i) for i in range(9)]


@pytest.mark.parametrize(
    "raw, message",
    [("{", "no es un JSON válido"), ("[1]", "debe ser dict o JSON string"), (None, "debe ser dict o JSON string")],
)
def test_bad_reader_options(spark, raw, message):
    m = spark.createDataFrame([("/x.csv",)], "path string")
    out = read_normalise(spark, m, spark.createDataFrame([(raw,)], "READER_OPTIONS string"))
    row = out.first()
    assert row.estado == "FALLIDO" and message in row.error


def test_read_stage_contracts(spark, tmp_path):
    put(tmp_path, "pre/a.csv", "a\n1\n")
    put(tmp_path, "pre/deep/b.csv", "a\n2\n")
    failed = spark.createDataFrame([("fallido", "e", "c", "d")], "estado string, error string, log_control string, log_detail string")
    fine = failed.selectExpr("'FINALIZADO' AS estado", "error", "log_control", "log_detail")
    params = spark.createDataFrame([(str(tmp_path), '{"csv":{"header":true}}')], "BUCKET_BLOB string, READER_OPTIONS string")
    assert read_normalise(spark, failed, params).first().error == "e"
    # a status that did not fail: the prefix itself is listed, not its folders
    r = read_normalise(spark, fine, params, {"relative_upload_file_path": "pre"})
    assert rows(r.rows, "a") == [("1",)]
    assert read_normalise(spark, fine, params, {}).first().error == "Falta parámetro requerido 'relative_upload_file_path'"
    assert "'path'" in read_normalise(spark, spark.range(1), params).first().error
    assert read_normalise(spark, None, params).first().estado == "FALLIDO"


def test_lenient_json_keeps_each_files_types(spark, tmp_path):
    put(tmp_path, "a_1.json", "{'n': 1}\n")
    put(tmp_path, "a_2.json", "{'n': 1.5}\n")
    r = read(spark, tmp_path)
    assert rows(r.rows, "n") == [("1",), ("1.5",)]
