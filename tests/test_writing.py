"""Targets of every kind, their audit rows, and what a second run does."""

import json

import pytest

from acopio import contracts as C
from acopio.functions import checksum, row_hash, row_md5
from acopio.operators import shaping
from acopio.operators.consolidate import consolidate
from acopio.operators.snapshot import apply_delta, snapshot_delta
from acopio.plans.flow import run_flow
from acopio.plans.writing import write_tables
from acopio.sinks import tables as sinks
from acopio.sources import tables
from acopio.streaming.feed import append_batch, drain, drain_to_tables, file_stream

SPEC = (
    "p_id_ingesta string, id_control int, coleccion_salida string, p_nombre_tabla string, p_ruta_salida string, "
    "tipo_escritura string, tipo_tabla string, p_requiere_shist int, p_condicion_reproceso string, "
    "p_expresion_campos_extras string, p_columna_delta string, p_columna_delta_tipo_dato string, p_last_control string, "
    "log1 string, error1 string, root_metada_path string"
)


def spec(spark, *rows):
    base = {
        "p_id_ingesta": "i1", "id_control": 7, "coleccion_salida": "zr", "p_nombre_tabla": "t", "tipo_escritura": "parquet",
        "tipo_tabla": "history", "p_requiere_shist": 0, "p_columna_delta": "k", "p_columna_delta_tipo_dato": "int",
        "p_last_control": "", "log1": "", "error1": "", "root_metada_path": "/m",
    }
    names = [f.split()[0] for f in SPEC.split(", ")]
    return spark.createDataFrame([tuple({**base, **r}.get(n) for n in names) for r in rows], SPEC)


def data(spark, *rows):
    return spark.createDataFrame(list(rows), "k string, v string")


def history(tmp_path, period, **kw):
    return {
        "p_ruta_salida": str(tmp_path), "p_expresion_campos_extras": f"'{period}' AS periodo",
        "p_condicion_reproceso": f"periodo = '{period}'", **kw,
    }


def stock(tmp_path, period, **kw):
    return {
        "p_ruta_salida": str(tmp_path), "tipo_tabla": "stock",
        "p_expresion_campos_extras": f"'{period}' AS periodo; k AS SDELTA_ID", **kw,
    }


def rows(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=str)


def test_history_keeps_other_periods_and_reconciles(spark, tmp_path):
    one = write_tables(spark, data(spark, ("1", "a"), ("2", "b")), spec(spark, history(tmp_path, "2024-01"))).first()
    assert one.estado == "FINALIZADO", one.error
    assert (one.cantidad_leidos, one.cantidad_insertados, one.rango_ini_procesado, one.rango_fin_procesado) == (2, 2, "1", "2")
    assert one.checksum_source == one.checksum_destination != 0
    assert one.fecha_fin >= one.fecha_inicio and one.objeto_existe == 0 and one.tiene_shist == "0"
    write_tables(spark, data(spark, ("3", "c")), spec(spark, history(tmp_path, "2024-02")))
    again = write_tables(spark, data(spark, ("9", "z")), spec(spark, history(tmp_path, "2024-01"))).first()
    assert again.checksum_source == again.checksum_destination
    assert rows(spark.read.parquet(f"{tmp_path}/t"), "periodo", "k") == [("2024-01", "9"), ("2024-02", "3")]


def test_history_of_many_periods(spark, tmp_path):
    s = history(tmp_path, "")
    s["p_expresion_campos_extras"] = "concat('2024-0', k) AS periodo"
    s["p_condicion_reproceso"] = None
    a = write_tables(spark, data(spark, ("1", "a"), ("2", "b"), ("2", "c")), spec(spark, s)).first()
    assert a.estado == "FINALIZADO" and a.checksum_source == a.checksum_destination
    assert rows(spark.read.parquet(f"{tmp_path}/t"), "periodo", "v") == [("2024-01", "a"), ("2024-02", "b"), ("2024-02", "c")]


def test_period_text_with_leading_zero_stays(spark, tmp_path):
    for _ in range(2):
        a = write_tables(spark, data(spark, ("1", "a")), spec(spark, history(tmp_path, "01"))).first()
        assert a.estado == "FINALIZADO" and a.checksum_source == a.checksum_destination
    assert [p.name for p in (tmp_path / "t").iterdir() if p.is_dir()] == ["periodo=01"]


def test_replace_where_removes_matching_periods_only(spark, tmp_path):
    t = str(tmp_path / "h")
    frame = lambda *r: spark.createDataFrame(list(r), "v int, periodo string")
    sinks.write_history(frame((1, "2024-01"), (2, "2024-02"), (3, "2024-03"), (4, "2024 x/4")), t)
    sinks.replace_where(frame((9, "2024-02")), t, "periodo BETWEEN '2024-02' AND '2024-03'")
    read = spark.read.schema("v int, periodo string").parquet(t)
    assert rows(read, "v", "periodo") == [(1, "2024-01"), (4, "2024 x/4"), (9, "2024-02")]
    with pytest.raises(ValueError, match="outside"):
        sinks.replace_where(frame((9, "2024-05")), t, "periodo = '2024-02'")
    with pytest.raises(ValueError, match="periodo only"):
        sinks.replace_where(frame((9, "2024-02")), t, "v = 1")
    used = sinks.replace_where_or_range(
        frame((5, "2024-05")), "periodo = '2024-02'", lambda c: sinks.replace_where(frame((5, "2024-05")), t, c)
    )
    assert used == "periodo between '2024-05' and '2024-05'"
    assert rows(spark.read.schema("v int, periodo string").parquet(t), "v") == [(1,), (4,), (5,), (9,)]


def test_a_failed_replacement_widens_nothing(spark):
    asked = []

    def lost(condition):
        asked.append(condition)
        raise RuntimeError("executor lost")

    with pytest.raises(RuntimeError, match="lost"):
        sinks.replace_where_or_range(spark.createDataFrame([("a",)], "periodo string"), "periodo = 'a'", lost)
    assert asked == ["periodo = 'a'"]


def test_parameter_rows_have_no_limit(spark):
    assert sum(1 for _ in tables.parameter_rows(spark.range(10_001).toDF("p_id_ingesta"))) == 10_001
    assert list(tables.parameter_rows(None)) == [] and tables.first_row(None) is None


def test_read_back_leaves_untouched_periods_out(spark, tmp_path):
    df = spark.createDataFrame([("1", "a"), ("2", "b"), ("3", "c")], "k string, p string")
    s = history(tmp_path, "x")
    s["p_expresion_campos_extras"] = "p AS periodo"
    write_tables(spark, df, spec(spark, s))
    again = write_tables(spark, df.where("p <> 'b'"), spec(spark, s)).first()
    assert again.estado == "FINALIZADO" and "Conciliado" in again.log_detail + again.log_control
    assert again.checksum_source == again.checksum_destination


def test_parquet_history_by_condition(spark, tmp_path):
    write_tables(spark, data(spark, ("1", "a")), spec(spark, history(tmp_path, "2024-01")))
    s = history(tmp_path, "2024-02", p_condicion_reproceso="periodo >= '2024-01'")
    a = write_tables(spark, data(spark, ("2", "b")), spec(spark, s), {"reemplazo_parquet": "si"}).first()
    assert a.estado == "FINALIZADO" and a.checksum_source == a.checksum_destination and a.cantidad_insertados == 1
    assert rows(spark.read.parquet(f"{tmp_path}/t"), "periodo") == [("2024-02",)]


def test_stock_delta_over_loads(spark, tmp_path):
    def load(period, *r, **kw):
        a = write_tables(spark, data(spark, *r), spec(spark, stock(tmp_path, period, **kw))).first()
        assert a.estado == "FINALIZADO", a.error
        assert a.checksum_source == a.checksum_destination and a.is_stock_delta == 1
        return a

    def delta(period):
        read = spark.read.schema("SDELTA_ID string, v string, sdelta_operacion string, sdelta_periodo_compararacion string, periodo string")
        d = read.parquet(f"{tmp_path}/t_sdelta").where(f"periodo = '{period}'")
        return rows(d, "SDELTA_ID", "v", "sdelta_operacion", "sdelta_periodo_compararacion")

    load("2024-01", ("1", "a"), ("2", "b"), ("3", "c"), p_requiere_shist=1)
    assert delta("2024-01") == [("1", "a", "I", ""), ("2", "b", "I", ""), ("3", "c", "I", "")]
    load("2024-02", ("1", "a"), ("2", "x"), ("4", "d"), p_requiere_shist=1)
    want = [("2", "x", "U", "2024-01"), ("3", "c", "D", "2024-01"), ("4", "d", "I", "2024-01")]
    assert delta("2024-02") == want
    assert delta("2024-01") == [("1", "a", "I", ""), ("2", "b", "I", ""), ("3", "c", "I", "")]
    load("2024-02", ("1", "a"), ("2", "y"), ("4", "d"))  # same period again: changes are added
    assert delta("2024-02") == sorted(want + [("2", "y", "U", "2024-02")], key=str)
    load("2024-01", ("1", "q"))  # an earlier period is stored but not compared
    assert len(delta("2024-01")) == 3
    assert rows(spark.read.parquet(f"{tmp_path}/t"), "k", "v") == [("1", "q")]
    assert rows(spark.read.parquet(f"{tmp_path}/t_shist"), "periodo", "k") == [
        ("2024-01", "1"), ("2024-01", "2"), ("2024-01", "3"), ("2024-02", "1"), ("2024-02", "2"), ("2024-02", "4")
    ]


def test_stock_snapshot_of_two_periods_fails(spark, tmp_path):
    s = stock(tmp_path, "")
    s["p_expresion_campos_extras"] = "k AS periodo; k AS SDELTA_ID"
    a = write_tables(spark, data(spark, ("1", "a"), ("2", "b")), spec(spark, s)).first()
    assert a.estado == "FALLIDO" and "one periodo" in a.error


def test_reload_with_new_batch_ids_changes_nothing(spark, tmp_path):
    for period, batch in (("2024-01", "b1"), ("2024-02", "b2")):
        df = data(spark, ("1", "a"), ("2", None)).selectExpr("*", f"'{batch}' AS batch_id", f"'{batch}.csv' AS nombre_archivo")
        write_tables(spark, df, spec(spark, stock(tmp_path, period)))
    assert spark.read.parquet(f"{tmp_path}/t_sdelta").where("sdelta_periodo_compararacion <> ''").count() == 0


def test_target_types_are_kept(spark, tmp_path):
    spark.createDataFrame([(1, 2.5, "old")], "K int, v double, extra string").write.parquet(str(tmp_path / "t"))
    a = write_tables(
        spark, data(spark, ("7", "1.5"), ("x", "z")), spec(spark, stock(tmp_path, "p", p_expresion_campos_extras="'n' AS nueva"))
    ).first()
    assert a.estado == "FINALIZADO" and "Valores nulos por Cast Destino: 2" in a.log_detail
    out = spark.read.parquet(str(tmp_path / "t"))
    assert dict(out.dtypes)["k"] == "int" and dict(out.dtypes)["v"] == "double" and dict(out.dtypes)["nueva"] == "string"
    assert rows(out, "k", "v") == [(7, 1.5), (None, None)]


def test_cast_without_target_changes_nothing(spark):
    df = data(spark, ("1", "a"))
    assert shaping.cast_to_target(df, df.schema).schema == df.schema


def test_many_targets_one_failing(spark, tmp_path):
    specs = spec(
        spark,
        history(tmp_path, "2024-01", p_nombre_tabla="a"),
        history(tmp_path, "2024-01", p_nombre_tabla="b", tipo_escritura="orc", p_id_ingesta="i2"),
        history(tmp_path, "2024-01", p_nombre_tabla="c", p_expresion_campos_extras="nope AS periodo", p_id_ingesta="i3"),
        stock(tmp_path, "2024-01", p_nombre_tabla="d", p_id_ingesta="i4"),
        history(tmp_path, "2024-01", p_nombre_tabla="e", tipo_escritura="delta", p_id_ingesta="i5"),
    )
    out = write_tables(spark, data(spark, ("1", "a")), specs, {"calcula_md5": "SI"})
    assert out.schema == C.AUDIT
    by = {r.nombre_tabla: r for r in out.collect()}
    assert {n: r.estado for n, r in by.items()} == {
        "a": "FINALIZADO", "b": "FALLIDO", "c": "FALLIDO", "d": "FINALIZADO", "e": "FALLIDO"
    }
    assert by["b"].cantidad_leidos == 1 and by["b"].cantidad_insertados == 0
    assert by["b"].error == "Combinación no soportada para escritura: tipo_escritura=orc, tipo_tabla=history"
    assert "ingesta_md5" in spark.read.parquet(f"{tmp_path}/a").columns
    status = consolidate(spark, {"guardado": out}).first()
    assert status.estado == "FALLIDO" and status.error.count(" | ") == 2


def test_empty_input_passthrough_and_nameless(spark, tmp_path):
    a = write_tables(spark, data(spark, ("1", "a")).limit(0), spec(spark, history(tmp_path, "p"))).first()
    assert (a.estado, a.error1, a.log1) == ("FALLIDO", "SIN DATOS", f"{tmp_path}/t")
    up = spark.createDataFrame([("FALLIDO", "red", "c", "d")], C.STATUS)
    a = write_tables(spark, up, spec(spark, history(tmp_path, "p"))).first()
    assert (a.estado, a.error, a.id_ingesta, a.log_control, a.log_detail) == ("FALLIDO", "red", "", "c", "d")
    with pytest.raises(ValueError, match="p_id_ingesta"):
        write_tables(spark, data(spark, ("1", "a")), spec(spark, history(tmp_path, "p", p_id_ingesta=" ")))


def test_staged_rows_go_on_success_and_stay_on_failure(spark):
    from acopio.session import staged
    from acopio.sources.tables import path_exists

    folder = lambda df: df.inputFiles()[0].rsplit("/", 1)[0]
    with staged(data(spark, ("1", "a")), "kept") as df:
        gone = folder(df)
        assert df.count() == 1
    assert not path_exists(spark, gone)
    with pytest.raises(RuntimeError):
        with staged(data(spark, ("1", "a")), "kept") as df:
            stays = folder(df)
            raise RuntimeError
    assert path_exists(spark, stays)


def test_catalog_lookup(spark, tmp_path):
    from acopio.sources.tables import table_exists

    data(spark, ("1", "a")).createOrReplaceTempView("known_view")
    assert table_exists(spark, "no_such_db", "t") == 0
    assert table_exists(spark, None, "known_view") == 1


# --- fingerprints and snapshots -------------------------------------------------


def test_fingerprints_tell_rows_apart(spark):
    df = spark.createDataFrame(
        [("ab", "c"), ("a", "bc"), ("a\x1fb", "c"), ("a", "b\x1fc"), (None, "c"), ("", "c"), ("c", None), ("c", ""),
         ("\x1e0", "c"), ("\x1es", "c"), ("\x1f", "c")], "a string, b string"
    )
    n = df.count()
    assert df.select(row_md5(df).alias("m")).distinct().count() == n
    assert df.select(row_hash(df).alias("m")).distinct().count() == n
    # the old form cannot
    assert df.select(row_md5(df, legacy=True).alias("m")).distinct().count() < n


def test_legacy_hash_is_plain_concatenation(spark):
    df = spark.createDataFrame([("a", 1, None)], "a string, b int, c string")
    got = df.select(row_hash(df, legacy=True).alias("h")).first().h
    assert got == df.selectExpr("hash(concat(coalesce(string(a),''),coalesce(string(b),''),coalesce(string(c),''))) AS h").first().h


def test_checksum_ignores_order_and_never_overflows(spark):
    df = spark.range(1000).selectExpr("cast(id AS string) AS a")
    total = lambda d: d.agg(checksum(d).alias("c")).first().c
    assert total(df) == total(df.orderBy("a", ascending=False).repartition(7))
    assert total(df) == df.select(row_hash(df).alias("h")).groupBy().sum("h").first()[0]
    assert total(df.limit(0)) == 0
    big = spark.createDataFrame([(2147483647,), (-2147483648,)], "ingesta_hash int")
    assert total(big) == -1


def brute_delta(new, old):
    """Pair comparison by hand; each changed new row once."""
    out = []
    for k, m in new:
        same_key = [mo for ko, mo in old if k is not None and ko == k]
        if k is None:
            out.append((k, m, "-"))
        elif not same_key:
            out.append((k, m, "I"))
        elif any(mo != m for mo in same_key):
            out.append((k, m, "U"))
    for k, m in old:
        if k is None:
            out.append((k, m, "-"))
        elif all(kn != k for kn, _ in new):
            out.append((k, m, "D"))
    return sorted(out, key=str)


@pytest.mark.parametrize("staged", [True, False])
def test_snapshot_delta_by_brute_force(spark, staged):
    import random

    rnd = random.Random(3)
    for _ in range(4):
        side = lambda: [(rnd.choice([None, "hot", "hot"] + [f"k{i}" for i in range(12)]), rnd.choice("abc")) for _ in range(30)]
        new, old = side(), side()
        frame = lambda r: spark.createDataFrame(r, "SDELTA_ID string, ingesta_md5 string")
        d = snapshot_delta(frame(new), frame(old), new_period="2", old_period="1", staged=staged)
        assert rows(d, "SDELTA_ID", "ingesta_md5", "sdelta_operacion") == brute_delta(new, old)


def test_snapshot_delta_with_drifted_columns(spark):
    new = spark.createDataFrame([("1", "m1", "n", 5), ("2", "m2", "n", 6)], "SDELTA_ID string, ingesta_md5 string, fresh string, v int")
    old = spark.createDataFrame([("1", "m0", "g", "x"), ("3", "m3", "g", "y")], "SDELTA_ID string, ingesta_md5 string, gone string, v string")
    d = snapshot_delta(new, old, new_period="2", old_period="1")
    assert rows(d, "SDELTA_ID", "fresh", "gone", "v", "sdelta_operacion", "periodo") == [
        ("1", "n", None, "5", "U", "2"), ("2", "n", None, "6", "I", "2"), ("3", None, "g", "y", "D", "2")
    ]
    assert snapshot_delta(new, old, new_period="1", old_period="2").count() == 0


def test_delta_applied_to_old_gives_new(spark):
    new = spark.createDataFrame([("1", "a"), ("2", "x"), ("4", "d")], "SDELTA_ID string, ingesta_md5 string")
    old = spark.createDataFrame([("1", "a"), ("2", "b"), ("3", "c")], "SDELTA_ID string, ingesta_md5 string")
    d = snapshot_delta(new, old, period_column=None)
    assert rows(apply_delta(old, d), "SDELTA_ID", "ingesta_md5") == rows(new, "SDELTA_ID", "ingesta_md5")


# --- consolidation, flow, streaming ------------------------------------------------


def test_consolidate(spark):
    bad = lambda e: C.status_frame(spark, "fallido", e)
    first, second, third = C.STAGES
    out = consolidate(spark, {first: bad("uno"), second: spark.range(1), third: bad("")}).first()
    assert out.log_control == "Errores consolidados: 2"
    assert out.estado == "FALLIDO" and out.error == f"{first}: uno | {third}: Error no especificado"
    assert consolidate(spark, {first: C.status_frame(spark, "FINALIZADO"), second: None}).first().estado == "FINALIZADO"
    assert consolidate(spark, {first: spark.range(1)}).first().estado == "FINALIZADO"
    assert consolidate(spark, bad("x")).first().error == f"{first}: x"
    assert consolidate(spark, spark.range(1)).first().estado == "FINALIZADO"


def test_flow_end_to_end_and_again(spark, tmp_path):
    src, lake = tmp_path / "src", tmp_path / "lake"
    src.mkdir(), lake.mkdir()
    (src / "v_20240101.csv").write_text("k,v\n1,a\n2,b\n")
    (src / "v_20240102.csv").write_text("v,k\nc,3\n")
    options = {
        "relative_upload_file_path": "ventas", "relative_upload_control_path": "control",
        "checkpoint_prefix": "control/leidos", "readiness_wait_seconds": 0,
    }
    land = spark.createDataFrame(
        [(str(src), str(lake), "v.csv", "2024-01-01", "2024-01-31")],
        "source_uri string, landing_uri string, NOMBRE_ARCHIVO string, FECHA_DESDE string, FECHA_HASTA string",
    )
    disc = spark.createDataFrame([(str(lake), str(lake))], "BUCKET_BLOB string, BUCKET_RAW string")
    read = spark.createDataFrame([(str(lake), json.dumps({"csv": {"header": "true"}}))], "BUCKET_BLOB string, READER_OPTIONS string")
    specs = spec(spark, history(tmp_path / "out", "2024-01"))
    run = run_flow(spark, land, disc, read, specs, options)
    assert run.status.first().estado == "FINALIZADO"
    assert rows(spark.read.parquet(f"{tmp_path}/out/t"), "k", "v") == [("1", "a"), ("2", "b"), ("3", "c")]
    again = run_flow(spark, land, disc, read, specs, options)
    assert again.status.first().estado == "FALLIDO" and "omitido" in again.status.first().error
    assert spark.read.parquet(f"{tmp_path}/out/t").count() == 3
    (src / "v_20240103.csv").write_text("k,v\n4,d\n")
    run = run_flow(spark, land, disc, read, spec(spark, history(tmp_path / "out", "2024-02")), options)
    assert run.audit.first().cantidad_insertados == 1
    # a run whose write fails leaves its files to be read by the next one, though nothing new lands then
    (src / "v_20240104.csv").write_text("k,v\n5,e\n")
    bad = spec(spark, history(tmp_path / "out", "2024-03", tipo_escritura="orc"))
    assert run_flow(spark, land, disc, read, bad, options).status.first().estado == "FALLIDO"
    run = run_flow(spark, land, disc, read, spec(spark, history(tmp_path / "out", "2024-03")), options)
    assert run.audit.first().estado == "FINALIZADO"
    assert rows(spark.read.parquet(f"{tmp_path}/out/t").where("periodo = '2024-03'"), "k") == [("5",)]


def test_feed_takes_each_file_once(spark, tmp_path):
    src, target, ck = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "ck")
    src.mkdir()

    def run():
        stream = file_stream(spark, str(src), "csv", "k string, v string", {"header": "true"}, max_files_per_trigger=1)
        drain(stream, ck, append_batch(target))

    (src / "a b.csv").write_text("k,v\n1,a\n")
    (src / "c.csv").write_text("k,v\n2,b\n")
    run()
    assert rows(spark.read.parquet(target), "k", "nombre_archivo") == [("1", "a b.csv"), ("2", "c.csv")]
    run()
    (src / "d.csv").write_text("k,v\n3,c\n")
    run()
    assert rows(spark.read.parquet(target), "k") == [("1",), ("2",), ("3",)]
    # a batch that is repeated leaves the table as it was
    append_batch(target)(spark.createDataFrame([("2", "b")], "k string, v string"), 1)
    assert spark.read.parquet(target).count() == 3


def test_feed_through_the_table_writer(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    (src / "a.csv").write_text("k,v\n1,a\n")
    s = history(tmp_path, "", p_expresion_campos_extras="concat('lote-', lote_numero) AS periodo", p_condicion_reproceso=None)
    audits = []
    for name in (None, "b.csv"):
        if name:
            (src / name).write_text("k,v\n2,b\n")
        stream = file_stream(spark, str(src), "csv", "k string, v string", {"header": "true"})
        audits.append(drain_to_tables(stream, str(tmp_path / "ck"), str(tmp_path / "held"), spec(spark, s)))
    assert rows(spark.read.parquet(f"{tmp_path}/t"), "k", "periodo") == [("1", "lote-0"), ("2", "lote-1")]
    for audit in audits:
        assert rows(audit, "estado", "cantidad_insertados") == [("FINALIZADO", 1)]
    stream = file_stream(spark, str(src), "csv", "k string, v string", {"header": "true"})
    assert drain_to_tables(stream, str(tmp_path / "ck"), str(tmp_path / "held"), spec(spark, s)).isEmpty()


def test_micro_batches_of_one_period_do_not_replace_each_other(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    for i in range(5):
        (src / f"{i}.csv").write_text(f"k,v\n{i},a\n")
    bad = history(tmp_path, "p", p_expresion_campos_extras="no_such_column AS periodo")
    good = history(tmp_path, "p")
    for target, state in ((bad, "FALLIDO"), (good, "FINALIZADO")):  # what failed waits for the next run
        stream = file_stream(spark, str(src), "csv", "k string, v string", {"header": "true"}, max_files_per_trigger=2)
        audit = drain_to_tables(stream, str(tmp_path / "ck"), str(tmp_path / "held"), spec(spark, target))
        assert rows(audit, "estado") == [(state,)]
    assert rows(spark.read.parquet(f"{tmp_path}/t"), "k") == [(str(i),) for i in range(5)]
