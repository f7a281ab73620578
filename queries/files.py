"""Round trips: tables written as files or as targets by Spark, then read back through the library."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from acopio import contracts as C
from acopio.operators import discovery, shaping
from acopio.plans.reading import read_backlog
from acopio.plans.writing import write_tables
from acopio.session import scratch_path
from acopio.sinks import tables as sinks
from acopio.sources import tables as sources
from acopio.sources.listing import as_listing, list_files
from acopio.sources.readers import read_files
from acopio.streaming.feed import append_batch, drain, drain_to_tables, file_stream

from .inputs import (
    CHANGES_SQL,
    NEW_ORDERS_SQL,
    OLD_ORDERS_SQL,
    new_orders,
    old_orders,
    table,
)
from .registry import query


def _read(spark: SparkSession, folder: str, options: dict) -> DataFrame:
    manifest = discovery.manifest_from_paths(list_files(spark, folder).select("path"))
    result = read_files(manifest, options, run_id="run-1", unzip_to=f"{folder}/original/descomprimido")
    return result.output().drop("fecha_ingesta", "batch_id", "nombre_archivo")


_TEXT_ORDERS = """SELECT cast(o_orderkey AS varchar) AS o_orderkey, cast(o_custkey AS varchar) AS o_custkey, o_orderstatus,
    cast(o_totalprice AS varchar) AS o_totalprice, cast(o_orderdate AS varchar) AS o_orderdate,
    CASE WHEN o_orderstatus = 'F' THEN NULL ELSE o_orderpriority END AS o_orderpriority FROM orders"""


@query(_TEXT_ORDERS)
def csv_files(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as csv, each status with another column order or fewer columns, one of them gzipped."""
    folder = scratch_path(spark, "csv-files")
    text = shaping.strings(table(spark, sf, "orders"))
    cols = text.columns
    for status, names, codec in (("O", cols, "none"), ("P", cols[::-1], "gzip"), ("F", cols[:-1], "none")):
        part = text.where(F.col("o_orderstatus") == status).select(*names)
        part.write.option("header", "true").option("compression", codec).csv(f"{folder}/{status}")
    return _read(spark, folder, {"csv": {"header": "true"}})


@query(
    """SELECT cast(c_custkey AS varchar) AS c_custkey, c_name, cast(c_acctbal AS varchar) AS c_acctbal, c_mktsegment,
    cast(NULL AS varchar) AS s_name, cast(NULL AS varchar) AS s_acctbal FROM customer UNION ALL BY NAME
    SELECT s_name, cast(s_acctbal AS varchar) AS s_acctbal, cast(s_suppkey AS varchar) AS c_custkey FROM supplier"""
)
def json_files(spark: SparkSession, sf: str) -> DataFrame:
    """Customers and suppliers as json files with different keys."""
    folder = scratch_path(spark, "json-files")
    table(spark, sf, "customer").drop("c_nationkey").write.json(f"{folder}/c")
    table(spark, sf, "supplier").selectExpr("s_suppkey AS c_custkey", "s_name", "s_acctbal").write.json(f"{folder}/s")
    return _read(spark, folder, {"json": {}})


@query("SELECT unnest(string_split(text, chr(10))) AS value FROM documents")
def text_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Every line of every document, read as plain text."""
    folder = scratch_path(spark, "text-lines")
    table(spark, sf, "documents").select("text").write.text(folder)
    return _read(spark, folder, {"txt": {}})


@query(
    """SELECT cast(s_suppkey AS varchar) AS s_suppkey, s_name, cast(s_nationkey AS varchar) AS s_nationkey,
    cast(s_acctbal AS varchar) AS s_acctbal FROM supplier"""
)
def delimited_text(spark: SparkSession, sf: str) -> DataFrame:
    folder = scratch_path(spark, "delimited-text")
    text = shaping.strings(table(spark, sf, "supplier"))
    lines = text.select(F.concat_ws("|", *text.columns).alias("value"))
    # no header row: the columns are named by position and renamed here
    lines.write.text(folder)
    return _read(spark, folder, {"txt": {"delimiter": "|"}}).toDF(*text.columns)


@query(
    """SELECT cast(p_partkey AS varchar) AS id, p_name AS name, cast(p_retailprice AS varchar) AS price, cast(NULL AS varchar) AS nation
    FROM part UNION ALL SELECT c_name, c_name, NULL, cast(c_nationkey AS varchar) FROM customer"""
)
def parquet_files(spark: SparkSession, sf: str) -> DataFrame:
    """Two parquet layouts in one folder, ``id`` a number in one and text in the other."""
    folder = scratch_path(spark, "parquet-files")
    table(spark, sf, "part").selectExpr("p_partkey AS id", "p_name AS name", "p_retailprice AS price").write.parquet(f"{folder}/p")
    table(spark, sf, "customer").selectExpr("c_name AS id", "c_name AS name", "c_nationkey AS nation").write.parquet(f"{folder}/c")
    return _read(spark, folder, {"parquet": {}})


@query(
    """SELECT lang, cast(sum(octet_length(encode(text)) + 1) AS bigint) AS bytes, true AS has_relative_path FROM documents GROUP BY lang"""
)
def listed_bytes(spark: SparkSession, sf: str) -> DataFrame:
    """Sizes of the files below a folder, from the listing alone."""
    folder = scratch_path(spark, "listed-bytes")
    table(spark, sf, "documents").select("lang", "text").write.partitionBy("lang").text(folder)
    root = list_files(spark, folder)
    listing = as_listing(root, folder if ":" in folder else f"file:{folder}")
    lang = F.regexp_extract("path", r"lang=([^/]+)/", 1)
    return listing.groupBy(lang.alias("lang")).agg(
        F.sum("remote_size").alias("bytes"), F.min(F.col("relative_path").startswith("lang=")).alias("has_relative_path")
    )


@query(
    """SELECT doc_id || '.txt' AS relative_path, sha256(text) AS hash, cast(NULL AS varchar) AS s3_key,
    CASE WHEN lang = 'en' THEN NULL ELSE n_chars END AS remote_size,
    CASE WHEN lang = 'en' THEN NULL ELSE doc_id END AS remote_mtime FROM documents"""
)
def checkpoint_layouts(spark: SparkSession, sf: str) -> DataFrame:
    """A landing checkpoint of old rows (no size, no time) and new ones, appended over two runs."""
    path = scratch_path(spark, "checkpoint")
    docs = table(spark, sf, "documents").selectExpr(
        "concat(doc_id, '.txt') AS relative_path", "sha2(cast(text AS binary), 256) AS hash",
        "n_chars AS remote_size", "doc_id AS remote_mtime", "lang",
    )
    docs.where("lang = 'en'").select("relative_path", "hash").write.parquet(path)
    docs.where("lang <> 'en'").drop("lang").write.mode("append").parquet(path)
    return sources.read_checkpoint(spark, path, C.LANDING_CHECKPOINT).drop("ingestion_ts")


# --- targets ---------------------------------------------------------------------

_SPEC = (
    "p_id_ingesta string, id_control int, p_nombre_tabla string, p_ruta_salida string, tipo_escritura string, "
    "tipo_tabla string, p_requiere_shist int, p_condicion_reproceso string, p_expresion_campos_extras string, p_columna_delta string"
)


def _spec(spark: SparkSession, root: str, kind: str, extras: str, shist: int = 0, condition: str | None = None) -> DataFrame:
    row = ("i1", 1, "orders", root, "parquet", kind, shist, condition, extras, "o_orderkey")
    return spark.createDataFrame([row], _SPEC)


def _finished(audit: DataFrame) -> None:
    bad = audit.where("estado <> 'FINALIZADO'").select("error", "error1").first()
    if bad is not None:
        raise RuntimeError(f"write failed: {tuple(bad)}")


def _plain(df: DataFrame) -> DataFrame:
    """Orders with their own key name and price as a double."""
    return df.withColumnRenamed("SDELTA_ID", "o_orderkey").withColumn("o_totalprice", F.col("o_totalprice").cast("double"))


@query(
    f"""SELECT SDELTA_ID AS o_orderkey, o_custkey, o_orderstatus, cast(o_totalprice AS double) AS o_totalprice, o_orderdate,
    o_orderpriority, 'y' || year(o_orderdate) AS periodo FROM ({OLD_ORDERS_SQL}) WHERE year(o_orderdate) NOT IN
      (SELECT year(o_orderdate) FROM ({NEW_ORDERS_SQL}))
    UNION ALL SELECT SDELTA_ID, o_custkey, o_orderstatus, cast(o_totalprice AS double), o_orderdate,
    o_orderpriority, 'y' || year(o_orderdate) FROM ({NEW_ORDERS_SQL})"""
)
def history_table(spark: SparkSession, sf: str) -> DataFrame:
    """Two loads of a history by year: years of the second load are replaced, others stay."""
    root = scratch_path(spark, "history")
    spec = _spec(spark, root, "history", "concat('y', year(o_orderdate)) AS periodo")
    for df in (old_orders(spark, sf), new_orders(spark, sf)):
        _finished(write_tables(spark, _plain(df), spec))
    return sources.read_table(spark, f"{root}/orders").drop("ingesta_hash", "fecha_ingesta")


@query(
    f"""SELECT 'FINALIZADO' AS estado, count(*) AS cantidad_leidos, count(*) AS cantidad_insertados,
    cast(min(SDELTA_ID) AS varchar) AS rango_ini_procesado, cast(max(SDELTA_ID) AS varchar) AS rango_fin_procesado,
    true AS reconciled, 0::bigint AS is_stock_delta FROM ({NEW_ORDERS_SQL})"""
)
def write_audit(spark: SparkSession, sf: str) -> DataFrame:
    """Audit row of a history write: counts, range, and equal checksums on both sides."""
    root = scratch_path(spark, "audit")
    audit = write_tables(
        spark, _plain(new_orders(spark, sf)), _spec(spark, root, "history", "concat('y', year(o_orderdate)) AS periodo")
    )
    return audit.select(
        "estado", "cantidad_leidos", "cantidad_insertados", "rango_ini_procesado", "rango_fin_procesado",
        (F.col("checksum_source") == F.col("checksum_destination")).alias("reconciled"), "is_stock_delta",
    )


def _two_stock_loads(spark: SparkSession, sf: str) -> str:
    root = scratch_path(spark, "stock")
    for df, period in ((old_orders(spark, sf), "2024-01"), (new_orders(spark, sf), "2024-02")):
        extras = f"'{period}' AS periodo; o_orderkey AS SDELTA_ID"
        _finished(write_tables(spark, _plain(df), _spec(spark, root, "stock", extras, shist=1), {"calcula_md5": True}))
    return f"{root}/orders"


_CHANGE_COLUMNS = "SDELTA_ID, o_custkey, o_orderstatus, cast(o_totalprice AS double) AS o_totalprice, o_orderdate, o_orderpriority"


@query(
    f"""SELECT {_CHANGE_COLUMNS}, 'I' AS sdelta_operacion, '' AS compared, '2024-01' AS periodo FROM ({OLD_ORDERS_SQL})
    UNION ALL SELECT {_CHANGE_COLUMNS}, sdelta_operacion, '2024-01', '2024-02' FROM ({CHANGES_SQL})"""
)
def stock_delta_table(spark: SparkSession, sf: str) -> DataFrame:
    """Change rows a stock target keeps over two loads."""
    return (
        sources.read_table(spark, f"{_two_stock_loads(spark, sf)}_sdelta")
        .withColumnRenamed("sdelta_periodo_compararacion", "compared")
        .select(
            "SDELTA_ID", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority",
            "sdelta_operacion", "compared", F.col("periodo").cast("string").alias("periodo"),
        )
    )


@query(
    f"""SELECT SDELTA_ID AS o_orderkey, cast(o_totalprice AS double) AS o_totalprice, '2024-01' AS periodo, 'shist' AS kept
    FROM ({OLD_ORDERS_SQL}) UNION ALL SELECT SDELTA_ID, cast(o_totalprice AS double), '2024-02', 'shist' FROM ({NEW_ORDERS_SQL})
    UNION ALL SELECT SDELTA_ID, cast(o_totalprice AS double), '2024-02', 'stock' FROM ({NEW_ORDERS_SQL})"""
)
def stock_and_its_history(spark: SparkSession, sf: str) -> DataFrame:
    """The stock after two loads, and both snapshots in its history."""
    target = _two_stock_loads(spark, sf)
    columns = ["o_orderkey", "o_totalprice", F.col("periodo").cast("string").alias("periodo")]
    stock = sources.read_table(spark, target).select(*columns, F.lit("stock").alias("kept"))
    return stock.unionByName(sources.read_table(spark, f"{target}_shist").select(*columns, F.lit("shist").alias("kept")))


@query(
    f"""SELECT SDELTA_ID, o_custkey, 'y' || year(o_orderdate) AS periodo FROM ({OLD_ORDERS_SQL})
    WHERE NOT ('y' || year(o_orderdate) BETWEEN 'y1996' AND 'y2000') UNION ALL
    SELECT SDELTA_ID, o_custkey, 'y1998' FROM ({NEW_ORDERS_SQL})"""
)
def replace_by_condition(spark: SparkSession, sf: str) -> DataFrame:
    """A range of periods replaced by rows that bring one of them only."""
    target = scratch_path(spark, "replace")
    period = F.concat(F.lit("y"), F.year("o_orderdate"))
    sinks.write_history(sinks.by_period(old_orders(spark, sf).select("SDELTA_ID", "o_custkey", period.alias("periodo"))), target)
    fresh = new_orders(spark, sf).select("SDELTA_ID", "o_custkey", F.lit("y1998").alias("periodo"))
    sinks.replace_where(fresh, target, "periodo BETWEEN 'y1996' AND 'y2000'")
    return sources.read_table(spark, target)


@query(_TEXT_ORDERS.replace("CASE WHEN o_orderstatus = 'F' THEN NULL ELSE o_orderpriority END AS o_orderpriority", "o_orderpriority"))
def file_feed(spark: SparkSession, sf: str) -> DataFrame:
    """Orders arriving as csv files in two deliveries, taken by a stream that is started three times."""
    folder, target, state = (scratch_path(spark, n) for n in ("feed-in", "feed-out", "feed-state"))
    text = shaping.strings(table(spark, sf, "orders"))
    late = F.col("o_orderdate") >= "1999-01-01"

    def deliver(rows: DataFrame) -> None:
        rows.write.mode("append").option("header", "true").csv(folder)

    def take() -> None:
        stream = file_stream(spark, folder, "csv", text.schema, {"header": "true"})
        drain(stream, state, append_batch(target))

    deliver(text.where(~late))
    take()
    deliver(text.where(late))
    take()
    take()
    return sources.read_table(spark, target).select(*text.columns)


_BY_YEAR = "concat('y', substr(o_orderdate, 1, 4)) AS periodo"
_ORDERS_BY_YEAR = """SELECT cast(o_orderkey AS varchar) AS o_orderkey, cast(o_custkey AS varchar) AS o_custkey, o_orderstatus,
    cast(o_totalprice AS varchar) AS o_totalprice, cast(o_orderdate AS varchar) AS o_orderdate, o_orderpriority,
    'y' || year(o_orderdate) AS periodo FROM orders"""


def _orders_in_files(spark: SparkSession, sf: str, label: str, n: int = 8) -> tuple[str, DataFrame]:
    """All orders as text, dealt over ``n`` csv files that share their years."""
    folder = scratch_path(spark, label)
    text = shaping.strings(table(spark, sf, "orders"))
    text.repartition(n).write.option("header", "true").csv(folder)
    return folder, text


@query(_ORDERS_BY_YEAR)
def history_in_waves(spark: SparkSession, sf: str) -> DataFrame:
    """A backlog read in rounds of about three files and written once: no round replaces another's years."""
    folder, text = _orders_in_files(spark, sf, "waves-in")
    root = scratch_path(spark, "waves-out")
    manifest = discovery.manifest_from_paths(list_files(spark, folder).select("path"))
    params = spark.createDataFrame([('{"csv": {"header": "true"}}',)], "READER_OPTIONS string")
    rows = read_backlog(spark, manifest, params, files_per_wave=3)
    _finished(write_tables(spark, rows, _spec(spark, root, "history", _BY_YEAR)))
    return sources.read_table(spark, f"{root}/orders").select(*text.columns, "periodo")


@query(_ORDERS_BY_YEAR)
def feed_through_writer(spark: SparkSession, sf: str) -> DataFrame:
    """A stream of several micro-batches that share their years, written to a history by year."""
    folder, text = _orders_in_files(spark, sf, "writer-in")
    root, state, held = (scratch_path(spark, n) for n in ("writer-out", "writer-state", "writer-held"))
    stream = file_stream(spark, folder, "csv", text.schema, {"header": "true"}, max_files_per_trigger=3)
    _finished(drain_to_tables(stream, state, held, _spec(spark, root, "history", _BY_YEAR)))
    return sources.read_table(spark, f"{root}/orders").select(*text.columns, "periodo")


@query(_ORDERS_BY_YEAR.replace(",\n    'y' || year(o_orderdate) AS periodo", ""))
def feed_archived(spark: SparkSession, sf: str) -> DataFrame:
    """Orders of three deliveries, each taken by a stream of its own; files that were taken leave the folder."""
    folder, target, state, archive = (scratch_path(spark, n) for n in ("arrive-in", "arrive-out", "arrive-state", "arrive-kept"))
    text = shaping.strings(table(spark, sf, "orders"))
    present = lambda: list_files(spark, folder).count()
    for i in range(3):
        text.where(F.pmod(F.xxhash64("o_orderkey"), F.lit(3)) == i).repartition(4).write.mode("append").option("header", "true").csv(folder)
        stream = file_stream(spark, folder, "csv", text.schema, {"header": "true"}, max_files_per_trigger=2, archive=archive)
        drain(stream, state, append_batch(target))
    drain(file_stream(spark, folder, "csv", text.schema, {"header": "true"}, archive=archive), state, append_batch(target))
    if present() > 4:
        raise RuntimeError(f"{present()} files stayed in the folder")
    return sources.read_table(spark, target).select(*text.columns)
