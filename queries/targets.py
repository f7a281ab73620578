"""Targets replaced by condition and range, loads that are repeated, and all fields of the audit."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from acopio import contracts as C
from acopio.functions import reader_options
from acopio.operators import landing, snapshot
from acopio.plans.writing import write_stock_delta, write_tables
from acopio.session import scratch_path
from acopio.sources import tables as sources

from .files import _CHANGE_COLUMNS, _SPEC, _finished, _plain, _spec
from .inputs import CHANGES_SQL, NEW_ORDERS_SQL, OLD_ORDERS_SQL, files, labelled, new_orders, old_orders, table
from .registry import query

_BY_YEAR = "concat('y', year(o_orderdate)) AS periodo"
_YEAR = "'y' || year(o_orderdate)"
_ROWS = "SDELTA_ID AS o_orderkey, o_custkey, cast(o_totalprice AS double) AS o_totalprice"


def _history(spark: SparkSession, sf: str, label: str, condition: str, late: DataFrame) -> DataFrame:
    root = scratch_path(spark, label)
    _finished(write_tables(spark, _plain(old_orders(spark, sf)), _spec(spark, root, "history", _BY_YEAR)))
    _finished(write_tables(spark, _plain(late), _spec(spark, root, "history", _BY_YEAR, condition=condition)))
    return sources.read_table(spark, f"{root}/orders").select("o_orderkey", "o_custkey", "o_totalprice", "periodo")


_LATE = "year(o_orderdate) IN (1997, 1999)"


@query(
    f"""SELECT {_ROWS}, {_YEAR} AS periodo FROM ({OLD_ORDERS_SQL}) WHERE {_YEAR} NOT BETWEEN 'y1996' AND 'y1999'
    UNION ALL SELECT {_ROWS}, {_YEAR} FROM ({NEW_ORDERS_SQL}) WHERE {_LATE}"""
)
def history_by_condition(spark: SparkSession, sf: str) -> DataFrame:
    """Two years of new orders replace all years that the condition names, in one step."""
    late = new_orders(spark, sf).where(_LATE)
    return _history(spark, sf, "by-condition", "periodo BETWEEN 'y1996' AND 'y1999'", late)


@query(
    f"""SELECT {_ROWS}, {_YEAR} AS periodo FROM ({OLD_ORDERS_SQL}) WHERE {_YEAR} NOT BETWEEN 'y1997' AND 'y1999'
    UNION ALL SELECT {_ROWS}, {_YEAR} FROM ({NEW_ORDERS_SQL}) WHERE {_LATE}"""
)
def history_by_range(spark: SparkSession, sf: str) -> DataFrame:
    """The condition does not cover the new orders: the range of their years is replaced, 1998 with it."""
    late = new_orders(spark, sf).where(_LATE)
    return _history(spark, sf, "by-range", "periodo = 'y1997'", late)


@query(
    f"""SELECT {_CHANGE_COLUMNS}, 'I' AS sdelta_operacion, '' AS compared, '2024-01' AS periodo FROM ({OLD_ORDERS_SQL})
    UNION ALL SELECT {_CHANGE_COLUMNS}, sdelta_operacion, '2024-01', '2024-02' FROM ({CHANGES_SQL})"""
)
def stock_delta_repeated(spark: SparkSession, sf: str) -> DataFrame:
    """Two loads; the second wrote its change rows twice before it went through, and was then run once more."""
    root = scratch_path(spark, "repeated")
    load = lambda df, period: _finished(
        write_tables(spark, _plain(df), _spec(spark, root, "stock", f"'{period}' AS periodo; o_orderkey AS SDELTA_ID"))
    )
    old, new = old_orders(spark, sf), new_orders(spark, sf)
    load(old, "2024-01")
    died = _plain(new).selectExpr("*", "'2024-02' AS periodo", "o_orderkey AS SDELTA_ID")
    for _ in range(2):
        write_stock_delta(spark, died, f"{root}/orders", "parquet", C.StepLog())
    load(new, "2024-02")
    load(new, "2024-02")
    changes = sources.read_table(spark, f"{root}/orders_sdelta").withColumnRenamed("sdelta_periodo_compararacion", "compared")
    return changes.select(
        "SDELTA_ID", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority",
        "sdelta_operacion", "compared", F.col("periodo").cast("string").alias("periodo"),
    )


@query(
    f"""SELECT 'forth' AS direction, SDELTA_ID, sdelta_operacion FROM ({CHANGES_SQL})"""
)
def period_going_back(spark: SparkSession, sf: str) -> DataFrame:
    """Snapshots compared in the order of their periods, and not at all when the new one is the earlier."""
    new, old = new_orders(spark, sf), old_orders(spark, sf)
    forth = snapshot.snapshot_delta(new, old, new_period="2024-02", old_period="2024-01")
    back = snapshot.snapshot_delta(new, old, new_period="2023-12", old_period="2024-01")
    each = [d.select(F.lit(n).alias("direction"), "SDELTA_ID", "sdelta_operacion") for n, d in (("forth", forth), ("back", back))]
    return each[0].unionByName(each[1])


# --- audit rows ------------------------------------------------------------------------

_AUDIT_SPEC = _SPEC + ", coleccion_salida string, p_columna_delta_tipo_dato string, p_last_control string, log1 string, error1 string, root_metada_path string"
_SHOWN = (
    "id_ingesta", "id_control", "punto_control", "estado", "cantidad_leidos", "cantidad_insertados", "rango_ini_procesado", "rango_fin_procesado",
    "p_columna_delta_tipo_dato", "log1", "error1", "coleccion_salida", "nombre_tabla", "root_metada_path", "tiene_shist", "objeto_existe", "is_stock_delta",
)
_FACTS = f"(SELECT count(*) AS n, cast(min(SDELTA_ID) AS varchar) AS low, cast(max(SDELTA_ID) AS varchar) AS high FROM ({NEW_ORDERS_SQL}))"


@query(
    f"""SELECT t.id AS id_ingesta, 7::INTEGER AS id_control, 'p' AS punto_control, CASE WHEN t.fine THEN 'FINALIZADO' ELSE 'FALLIDO' END AS estado,
    n AS cantidad_leidos, CASE WHEN t.fine THEN n ELSE 0 END AS cantidad_insertados, CASE WHEN t.fine THEN low ELSE '' END AS rango_ini_procesado,
    CASE WHEN t.fine THEN high ELSE '' END AS rango_fin_procesado, 'long' AS p_columna_delta_tipo_dato, 'l' AS log1, 'e' AS error1, 'global_temp' AS coleccion_salida,
    t.name AS nombre_tabla, '/m' AS root_metada_path, t.shist AS tiene_shist, t.known AS objeto_existe, t.delta AS is_stock_delta, t.fine AS reconciled,
    CASE WHEN t.id = 'i4' THEN 'Combinación no soportada para escritura: tipo_escritura=orc, tipo_tabla=history' ELSE '' END AS error
    FROM (VALUES ('i1', 'acopio_orders', '0', 1::BIGINT, 0::BIGINT, true), ('i2', 'orders_stock', '1', 0, 1, true), ('i3', 'orders_plain', '0', 0, 0, true), ('i4', 'orders_orc', '0', 0, 0, false)) t(id, name, shist, known, delta, fine), {_FACTS} f"""
)
def audit_fields(spark: SparkSession, sf: str) -> DataFrame:
    """Audit rows of a history, two stocks and a target that cannot be written, with every field that does not tell the time."""
    root = scratch_path(spark, "audit-fields")
    df = _plain(new_orders(spark, sf))
    df.createOrReplaceGlobalTempView("acopio_orders")
    common = ("global_temp", "long", "p", "l", "e", "/m")
    stock = "'2024-02' AS periodo"
    specs = spark.createDataFrame(
        [
            ("i1", 7, "acopio_orders", root, "parquet", "history", 0, None, _BY_YEAR, "o_orderkey", *common),
            ("i2", 7, "orders_stock", root, "parquet", "stock", 1, None, f"{stock}; o_orderkey AS SDELTA_ID", "o_orderkey", *common),
            ("i3", 7, "orders_plain", root, "parquet", "stock", 0, None, stock, "o_orderkey", *common),
            ("i4", 7, "orders_orc", root, "orc", "history", 0, None, _BY_YEAR, "o_orderkey", *common),
        ],
        _AUDIT_SPEC,
    )
    audit = write_tables(spark, df, specs)
    same = (F.col("checksum_source") == F.col("checksum_destination")) & (F.col("checksum_source") != 0)
    return audit.select(*_SHOWN, same.alias("reconciled"), F.regexp_extract("error", "(Combinación.*)", 1).alias("error"))


@query(
    f"""SELECT 'stock' AS target, 'i2' AS made_by, SDELTA_ID AS o_orderkey, cast(o_totalprice AS double) AS o_totalprice, '2024-02' AS periodo FROM ({NEW_ORDERS_SQL})
    UNION ALL SELECT 'history', 'i1', SDELTA_ID, cast(o_totalprice AS double), {_YEAR} FROM ({NEW_ORDERS_SQL})
    UNION ALL SELECT 'shist', 'i2', SDELTA_ID, cast(o_totalprice AS double), '2024-02' FROM ({NEW_ORDERS_SQL})"""
)
def many_targets(spark: SparkSession, sf: str) -> DataFrame:
    """One input written to a history and to a stock with its history."""
    root = scratch_path(spark, "many-targets")
    specs = spark.createDataFrame(
        [
            ("i1", 1, "history", root, "parquet", "history", 0, None, _BY_YEAR, "o_orderkey"),
            ("i2", 1, "stock", root, "parquet", "stock", 1, None, "'2024-02' AS periodo", "o_orderkey"),
        ],
        _SPEC,
    )
    _finished(write_tables(spark, _plain(new_orders(spark, sf)), specs))
    parts = []
    for name, maker, folder in (("history", "i1", "history"), ("stock", "i2", "stock"), ("shist", "i2", "stock_shist")):
        held = sources.read_table(spark, f"{root}/{folder}")
        parts.append(held.select(F.lit(name).alias("target"), F.lit(maker).alias("made_by"), "o_orderkey", "o_totalprice", F.col("periodo").cast("string").alias("periodo")))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(
    """SELECT CASE WHEN bad > 0 THEN 'FALLIDO' ELSE 'FINALIZADO' END AS estado, CASE WHEN bad > 0 THEN 'Se encontraron ' || bad || ' errores durante la carga' ELSE '' END AS error,
    0::BIGINT AS cantidad_leidos, 0::BIGINT AS cantidad_insertados FROM (SELECT count(*) FILTER (toxic = 1) AS bad FROM documents JOIN labels USING (doc_id))"""
)
def passed_failure(spark: SparkSession, sf: str) -> DataFrame:
    """A landing with errors, seen by the writer as a failed status: one audit row passes it on, and nothing is written."""
    root = scratch_path(spark, "passed")
    status = F.when(F.col("toxic") == 1, C.ERROR_CARGA).otherwise(C.PROCESADO)
    results = files(spark, sf).join(labelled(spark, sf), "doc_id").select("path", status.alias("status"))
    state = landing.landing_state(landing.landing_tally(results)).first()
    outcome = C.status_frame(spark, state.estado, state.error, C.StepLog())
    audit = write_tables(spark, outcome, _spec(spark, root, "history", _BY_YEAR))
    if sources.has_files(spark, f"{root}/orders"):
        raise RuntimeError("a failed status was written as rows")
    return audit.select("estado", "error", "cantidad_leidos", "cantidad_insertados")


@query(
    """SELECT c_custkey, CASE WHEN c_nationkey % 4 = 3 THEN 2 ELSE 0 END AS types, CASE WHEN c_nationkey % 4 = 3 THEN ';' END AS sep FROM customer"""
)
def blank_options(spark: SparkSession, sf: str) -> DataFrame:
    """Reader options that are absent, empty or blank are no options; the others are read."""
    given = F.when(F.col("c_nationkey") % 4 == 1, "").when(F.col("c_nationkey") % 4 == 2, "   ").when(F.col("c_nationkey") % 4 == 3, '{"csv": {"sep": ";"}, "json": {}}')
    options = reader_options(given)
    rows = table(spark, sf, "customer").select("c_custkey", options.alias("options"))
    return rows.select("c_custkey", F.size("options").alias("types"), F.col("options")["csv"]["sep"].alias("sep"))


_STEPS = (
    "Inicio", "Leído", "Aplicar campos extras", "Aplicar Cast Destino omitido, destino aún no existe", "Guardar PARQUET - HISTORY", "Conciliado", "Obtener Resumen",
)


@query(
    f"""SELECT i::INTEGER AS place, step, true AS timed, (SELECT count(*) FROM ({NEW_ORDERS_SQL}))::BIGINT AS rows
    FROM (SELECT unnest([{", ".join(f"'{s}'" for s in _STEPS)}]) AS step, generate_subscripts([{", ".join(f"'{s}'" for s in _STEPS)}], 1) AS i)"""
)
def step_log(spark: SparkSession, sf: str) -> DataFrame:
    """What a write did, step by step, each with its time."""
    root = scratch_path(spark, "step-log")
    audit = write_tables(spark, _plain(new_orders(spark, sf)), _spec(spark, root, "history", _BY_YEAR))
    steps = F.posexplode(F.split(F.substring_index("log_detail", " Ubicacion: ", 1), r" \| "))
    each = audit.select(F.col("cantidad_insertados").alias("rows"), steps.alias("at", "entry"))
    timed = r"^(\d{4}-\d\d-\d\d \d\d:\d\d:\d\d) (.*)$"
    return each.select((F.col("at") + 1).alias("place"), F.regexp_extract("entry", timed, 2).alias("step"), F.col("entry").rlike(timed).alias("timed"), "rows")
