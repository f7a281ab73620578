"""A stock with change rows is written once, beside the old table."""

import pytest

from acopio.plans import writing
from acopio.sinks import tables as sinks
from acopio.sources import tables

_SPEC = "p_id_ingesta string, p_ruta_salida string, p_nombre_tabla string, tipo_escritura string, tipo_tabla string, p_requiere_shist int, p_expresion_campos_extras string"


def test_rows_of_a_stock_delta_are_written_once(spark, tmp_path, monkeypatch):
    copies = []
    kept = writing.staged
    monkeypatch.setattr(writing, "staged", lambda df, label: (copies.append(label), kept(df, label))[1])
    for period, rows in (("2024-01", [(1, "a"), (2, "b"), (None, "n")]), ("2024-02", [(2, "c"), (3, "d"), (3, "d")])):
        extras = f"'{period}' AS periodo; k AS SDELTA_ID"
        specs = spark.createDataFrame([("i1", str(tmp_path), "t", "parquet", "stock", 0, extras)], _SPEC)
        audit = writing.write_tables(spark, spark.createDataFrame(rows, "k long, v string"), specs).first()
        assert (audit.estado, audit.cantidad_leidos, audit.checksum_source) == ("FINALIZADO", 3, audit.checksum_destination)
    changes = tables.read_table(spark, f"{tmp_path}/t_sdelta").where("periodo = '2024-02'").select("SDELTA_ID", "v", "sdelta_operacion")
    assert sorted(map(tuple, changes.collect()), key=str) == sorted([(2, "c", "U"), (3, "d", "I"), (3, "d", "I"), (1, "a", "D"), (None, "n", "-")], key=str)
    assert sorted(r["v"] for r in tables.read_table(spark, f"{tmp_path}/t").collect()) == ["c", "d", "d"]
    assert copies == []


def test_stock_stays_when_what_comes_before_fails(spark, tmp_path):
    target = f"{tmp_path}/t"
    sinks.write_stock(spark.range(3), target)
    seen = []

    def before(new):
        seen.append((new.count(), tables.read_table(spark, target).count()))
        raise ValueError("no changes")

    with pytest.raises(ValueError):
        sinks.write_stock(spark.range(5), target, before)
    assert seen == [(5, 3)] and tables.read_table(spark, target).count() == 3
    sinks.write_stock(spark.range(4), target)
    assert tables.read_table(spark, target).count() == 4
