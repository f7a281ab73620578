"""Shaping rows for a table, fingerprints, snapshots and reconciliation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from acopio import contracts as C
from acopio.functions import batch_id, dataset_name, local_time, md5_word, row_md5, wrapping_sum
from acopio.operators import shaping, snapshot, summary

from .inputs import (
    CHANGES_SQL,
    LINE_MD5_SQL,
    LINES_SQL,
    NEW_ORDERS_SQL,
    ORDER_MD5_SQL,
    ORDERS_SQL,
    lines,
    new_orders,
    old_orders,
    orders,
    table,
)
from .registry import query

_ORDER_FILE = "'s3a://raw/original/ventas_' || strftime(o_orderdate, '%Y%m%d') || '.csv'"
_RUN = "run-1"


def _read_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as rows read from one file per day."""
    raw = table(spark, sf, "orders").withColumn(
        "_file", F.concat(F.lit("s3a://raw/original/ventas_"), F.date_format("o_orderdate", "yyyyMMdd"), F.lit(".csv"))
    )
    own = shaping.strings(raw.drop("_file"))
    # keep the file beside the all-text row until lineage is added
    rows = raw.select(F.col("_file"), *[F.col(c).cast("string").alias(c) for c in own.columns])
    file = F.col("_file")
    decorated = shaping.lineage(
        rows,
        source_file=file,
        path=file,
        batch=batch_id(_RUN, file),
        dataset=dataset_name(file),
        ingestion_ts=F.lit("2024-02-01 10:00:00"),
    )
    return decorated.drop("_file")


_READ_SQL = f"""SELECT cast(o_orderkey AS varchar) AS o_orderkey, cast(o_custkey AS varchar) AS o_custkey, o_orderstatus,
    cast(o_totalprice AS varchar) AS o_totalprice, cast(o_orderdate AS varchar) AS o_orderdate, o_orderpriority,
    '2024-02-01 10:00:00' AS ingestion_ts, {_ORDER_FILE} AS source_file, {_ORDER_FILE} AS path,
    md5('{_RUN}' || chr(31) || {_ORDER_FILE}) AS batch_id, 'ventas' AS dataset, 'PROCESADO' AS record_status,
    cast(NULL AS varchar) AS error_stage, cast(NULL AS varchar) AS error_message FROM orders"""


@query(
    f"""SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
    ingestion_ts AS fecha_ingesta, batch_id, regexp_extract(source_file, '([^/]+)$', 1) AS nombre_archivo FROM ({_READ_SQL})"""
)
def normalise_rows(spark: SparkSession, sf: str) -> DataFrame:
    return shaping.finish(_read_orders(spark, sf))


@query(
    f"""SELECT * FROM ({_READ_SQL}) UNION ALL BY NAME
    SELECT 's3a://raw/' || c_name || '.dat' AS path, 'ERROR_LECTURA' AS record_status,
      'No hay reader_options definidos para extensión ''unknown''' AS error_message, cast(NULL AS varchar) AS ingestion_ts,
      's3a://raw/' || c_name || '.dat' AS source_file, cast(NULL AS varchar) AS batch_id, c_name AS dataset,
      'LECTURA_NORMALIZACION' AS error_stage FROM customer"""
)
def rows_with_errors(spark: SparkSession, sf: str) -> DataFrame:
    """Read rows together with one error row per unreadable file."""
    bad = table(spark, sf, "customer").select(F.concat(F.lit("s3a://raw/"), "c_name", F.lit(".dat")).alias("path"))
    errors = bad.select(
        "path",
        F.lit(C.ERROR_LECTURA).alias("record_status"),
        F.lit(C.MSG_NO_OPTIONS.format(ext="unknown")).alias("error_message"),
        F.col("path").alias("source_file"),
        dataset_name("path").alias("dataset"),
    )
    return shaping.union_all([_read_orders(spark, sf), shaping.error_rows(errors)])


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def drop_control_columns(spark: SparkSession, sf: str) -> DataFrame:
    df = table(spark, sf, "orders").select(
        "o_orderkey",
        "o_custkey",
        "o_totalprice",
        F.col("o_orderdate").alias("PERIODO"),
        F.col("o_orderstatus").alias("Fecha_Ingesta"),
        F.col("o_orderpriority").alias("sdelta_id"),
        F.lit("x").alias("Ingesta_MD5"),
        F.lit(1).alias("ingesta_hash"),
    )
    return shaping.drop_control(df)


@query(
    """SELECT *, strftime(o_orderdate, '%Y-%m') AS periodo, o_orderkey AS SDELTA_ID,
    CASE WHEN o_totalprice > 250000 THEN 'A' ELSE 'B' END AS segmento FROM orders"""
)
def extra_expressions(spark: SparkSession, sf: str) -> DataFrame:
    return shaping.with_extras(
        table(spark, sf, "orders"),
        "date_format(o_orderdate, 'yyyy-MM') AS periodo; o_orderkey AS SDELTA_ID;"
        " CASE WHEN o_totalprice > 250000 THEN 'A' ELSE 'B' END AS segmento; ",
    )


@query(
    """SELECT try_cast(c_custkey AS bigint) AS C_CUSTKEY, try_cast(c_acctbal AS double) AS c_acctbal,
    try_cast(tag AS integer) AS tag, c_name,
    (CASE WHEN tag IS NOT NULL AND try_cast(tag AS integer) IS NULL THEN 1 ELSE 0 END) AS lost
    FROM (SELECT cast(c_custkey AS varchar) AS c_custkey, cast(c_acctbal AS varchar) AS c_acctbal, c_name,
      CASE WHEN c_mktsegment = 'MACHINERY' THEN c_mktsegment ELSE cast(c_nationkey AS varchar) END AS tag FROM customer)"""
)
def cast_to_target(spark: SparkSession, sf: str) -> DataFrame:
    """All-text rows to the types of a target; values that do not fit become NULL and are counted."""
    text = table(spark, sf, "customer").selectExpr(
        "cast(c_custkey AS string) AS C_CUSTKEY",
        "cast(c_acctbal AS string) AS c_acctbal",
        "CASE WHEN c_mktsegment = 'MACHINERY' THEN c_mktsegment ELSE cast(c_nationkey AS string) END AS tag",
        "c_name",
    )
    target = spark.createDataFrame([], "c_custkey bigint, C_ACCTBAL double, Tag int, other date").schema
    counted = text.withColumn("lost", shaping.lost_values(text, target))
    return shaping.cast_to_target(counted, target)


@query(
    "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, cast(NULL AS bigint) AS s_suppkey, "
    "cast(NULL AS varchar) AS s_name, cast(NULL AS integer) AS s_nationkey, cast(NULL AS double) AS s_acctbal FROM customer "
    "UNION ALL BY NAME SELECT * FROM supplier"
)
def union_by_name(spark: SparkSession, sf: str) -> DataFrame:
    return shaping.union_all([table(spark, sf, "customer"), table(spark, sf, "supplier")])


@query("SELECT event_id, ts - INTERVAL 5 HOUR AS local_ts FROM events")
def local_times(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events")
    return events.select("event_id", local_time(F.col("ts").cast("timestamp")).cast("timestamp_ntz").alias("local_ts"))


# --- fingerprints --------------------------------------------------------------


@query(f"SELECT SDELTA_ID AS o_orderkey, {ORDER_MD5_SQL} AS ingesta_md5 FROM ({ORDERS_SQL})")
def row_fingerprint(spark: SparkSession, sf: str) -> DataFrame:
    df = orders(spark, sf)
    return df.select(F.col("SDELTA_ID").alias("o_orderkey"), row_md5(df).alias("ingesta_md5"))


@query(
    f"""SELECT l_returnflag, l_linestatus, count(*) AS n, cast(sum(('0x' || substr(m, 1, 8))::bigint) AS bigint) AS checksum
    FROM (SELECT l_returnflag, l_linestatus, {LINE_MD5_SQL} AS m FROM ({LINES_SQL})) GROUP BY 1, 2"""
)
def md5_checksum(spark: SparkSession, sf: str) -> DataFrame:
    df = lines(spark, sf)
    return (
        df.withColumn("m", row_md5(df))
        .groupBy("l_returnflag", "l_linestatus")
        .agg(F.count(F.lit(1)).alias("n"), wrapping_sum(md5_word("m")).alias("checksum"))
    )


# --- snapshots -------------------------------------------------------------------

_FP_NEW = f"SELECT *, {ORDER_MD5_SQL} AS ingesta_md5 FROM ({NEW_ORDERS_SQL})"


def _fingerprinted(df: DataFrame) -> DataFrame:
    return df.withColumn("ingesta_md5", row_md5(df))


@query(
    f"""SELECT * REPLACE (cast(o_totalprice AS double) AS o_totalprice), '2024-01' AS sdelta_periodo_compararacion, '2024-02' AS periodo
    FROM ({CHANGES_SQL})"""
)
def snapshot_delta(spark: SparkSession, sf: str) -> DataFrame:
    delta = snapshot.snapshot_delta(
        new_orders(spark, sf), old_orders(spark, sf), new_period="2024-02", old_period="2024-01"
    )
    return delta.withColumn("o_totalprice", F.col("o_totalprice").cast("double"))


@query(
    f"""SELECT SDELTA_ID, o_custkey, o_orderstatus, cast(o_totalprice AS double) AS o_totalprice, o_orderdate, o_orderpriority,
    ingesta_md5, 'I' AS sdelta_operacion, '' AS sdelta_periodo_compararacion FROM ({_FP_NEW})"""
)
def first_delta(spark: SparkSession, sf: str) -> DataFrame:
    delta = snapshot.first_delta(_fingerprinted(new_orders(spark, sf)))
    return delta.withColumn("o_totalprice", F.col("o_totalprice").cast("double"))


@query(
    f"""SELECT SDELTA_ID, o_custkey, o_orderstatus, cast(o_totalprice AS double) AS o_totalprice, o_orderdate, o_orderpriority,
    ingesta_md5 FROM ({_FP_NEW})"""
)
def apply_delta(spark: SparkSession, sf: str) -> DataFrame:
    """The old snapshot with the delta applied is the new snapshot."""
    new, old = _fingerprinted(new_orders(spark, sf)), _fingerprinted(old_orders(spark, sf))
    delta = snapshot.snapshot_delta(new, old, period_column=None)
    return snapshot.apply_delta(old, delta).select(
        *[F.col(c).cast("double").alias(c) if c == "o_totalprice" else F.col(c) for c in new.columns]
    )


# --- summaries -------------------------------------------------------------------


@query(
    """SELECT count(*) AS cantidad_insertados, cast(min(o_orderdate) AS varchar) AS rango_ini_procesado,
    cast(max(o_orderdate) AS varchar) AS rango_fin_procesado FROM orders"""
)
def write_summary(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").agg(*summary.write_summary("o_orderdate"))


@query(
    """SELECT strftime(min(l_shipdate), '%Y-%m-%d') AS rango_ini, strftime(max(l_shipdate), '%Y-%m-%d') AS rango_fin
    FROM lineitem"""
)
def period_range(spark: SparkSession, sf: str) -> DataFrame:
    return summary.period_range(table(spark, sf, "lineitem"), "l_shipdate")


@query("SELECT coalesce(cast(max(l_shipdate) AS varchar), '') AS periodo FROM lineitem")
def last_period(spark: SparkSession, sf: str) -> DataFrame:
    return summary.last_period(table(spark, sf, "lineitem"), "l_shipdate")


def _word_sum(sql: str) -> str:
    return (
        "SELECT strftime(o_orderdate, '%Y-%m') AS periodo, count(*) AS n, "
        f"cast(sum(('0x' || substr({ORDER_MD5_SQL}, 1, 8))::bigint) AS bigint) AS c FROM ({sql}) GROUP BY 1"
    )


@query(
    f"""SELECT coalesce(s.periodo, t.periodo) AS periodo, coalesce(s.n, 0) AS rows_source,
    coalesce(t.n, 0) AS rows_destination, coalesce(s.c, 0) AS checksum_source, coalesce(t.c, 0) AS checksum_destination,
    coalesce(s.n, 0) = coalesce(t.n, 0) AND coalesce(s.c, 0) = coalesce(t.c, 0) AS reconciled
    FROM ({_word_sum(ORDERS_SQL)}) s FULL OUTER JOIN ({_word_sum(NEW_ORDERS_SQL)}) t ON s.periodo = t.periodo"""
)
def reconcile(spark: SparkSession, sf: str) -> DataFrame:
    """All orders against today's stock, month by month; months with archived or dearer orders differ."""

    def side(df: DataFrame) -> DataFrame:
        return df.select(
            F.date_format("o_orderdate", "yyyy-MM").alias("periodo"), md5_word(row_md5(df)).alias("ingesta_hash")
        )

    return summary.reconcile(side(orders(spark, sf)), side(new_orders(spark, sf)), by=["periodo"])
