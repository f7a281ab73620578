"""Frames the queries start from, and the same frames in SQL.

All are derived from whole tables: no row is left out to make a check cheap.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

ROOT = "s3a://raw/original/"
SOURCE_ROOT = "s3a://remote/inbox/"
MTIME0 = 1700000000


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


# --- documents seen as files: path, size, modification time ------------------

_EXT = (
    "CASE WHEN right(source, 1) IN ('0', '1') THEN '.csv' WHEN right(source, 1) IN ('2', '3') THEN '.txt.gz' "
    "WHEN right(source, 1) = '4' THEN '.json' WHEN right(source, 1) = '5' THEN '.parquet' "
    "WHEN right(source, 1) IN ('6', '7') THEN '.xlsx' ELSE '.dat' END"
)


def files(spark: SparkSession, sf: str, root: str = ROOT) -> DataFrame:
    """One file per document. Its content hash covers the whole text."""
    rel = f"concat(source, '/', lang, '_', cast(doc_id AS string), {_EXT})"
    return table(spark, sf, "documents").selectExpr(
        "doc_id",
        f"concat('{root}', {rel}) AS path",
        f"{rel} AS relative_path",
        "n_chars AS remote_size",
        f"{MTIME0} + doc_id AS remote_mtime",
        "sha2(cast(text AS binary), 256) AS hash",
    )


def files_sql(root: str = ROOT) -> str:
    rel = f"source || '/' || lang || '_' || cast(doc_id AS varchar) || {_EXT}"
    return (
        f"SELECT doc_id, '{root}' || {rel} AS path, {rel} AS relative_path, n_chars AS remote_size, "
        f"{MTIME0} + doc_id AS remote_mtime, sha256(text) AS hash FROM documents"
    )


def labelled(spark: SparkSession, sf: str) -> DataFrame:
    """Documents a reviewer has judged: the ones already processed."""
    return table(spark, sf, "labels").select("doc_id", "quality", "toxic")


# --- two snapshots of the orders stock ---------------------------------------

OLD_UNTIL = "2001-01-01"  # the old snapshot was taken then
ARCHIVED_BEFORE = "1996-01-01"  # finished orders before this have left the new snapshot
ORDER_TEXT = ("o_orderstatus", "o_orderpriority")


def orders(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").selectExpr(
        "o_orderkey AS SDELTA_ID",
        "o_custkey",
        "o_orderstatus",
        "cast(o_totalprice AS decimal(18,2)) AS o_totalprice",
        "o_orderdate",
        "o_orderpriority",
    )


def new_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Today's stock: archived orders gone, urgent orders one unit dearer."""
    return (
        orders(spark, sf)
        .where(f"NOT (o_orderstatus = 'F' AND o_orderdate < TIMESTAMP_NTZ '{ARCHIVED_BEFORE}')")
        .withColumn(
            "o_totalprice",
            F.expr("cast(o_totalprice + CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END AS decimal(18,2))"),
        )
    )


def old_orders(spark: SparkSession, sf: str) -> DataFrame:
    return orders(spark, sf).where(f"o_orderdate < TIMESTAMP_NTZ '{OLD_UNTIL}'")


ORDERS_SQL = (
    "SELECT o_orderkey AS SDELTA_ID, o_custkey, o_orderstatus, cast(o_totalprice AS decimal(18,2)) AS o_totalprice, "
    "o_orderdate, o_orderpriority FROM orders"
)
NEW_ORDERS_SQL = (
    "SELECT SDELTA_ID, o_custkey, o_orderstatus, cast(o_totalprice + CASE WHEN o_orderpriority = '1-URGENT' "
    f"THEN 1 ELSE 0 END AS decimal(18,2)) AS o_totalprice, o_orderdate, o_orderpriority FROM ({ORDERS_SQL}) "
    f"WHERE NOT (o_orderstatus = 'F' AND o_orderdate < TIMESTAMP '{ARCHIVED_BEFORE}')"
)
OLD_ORDERS_SQL = f"SELECT * FROM ({ORDERS_SQL}) WHERE o_orderdate < TIMESTAMP '{OLD_UNTIL}'"


def row_text_sql(columns: list[str], text_columns: tuple[str, ...]) -> str:
    """The fingerprint text in DuckDB SQL, parts joined by chr(31), NULL marked by chr(30)."""

    def part(c: str) -> str:
        v = f"cast({c} AS varchar)"
        if c in text_columns:
            v = f"replace(replace({v}, chr(30), chr(30) || 'e'), chr(31), chr(30) || 's')"
        return f"coalesce({v}, chr(30) || '0')"

    return "concat_ws(chr(31), " + ", ".join(part(c) for c in columns) + ")"


ORDER_COLUMNS = ["o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
ORDER_MD5_SQL = f"md5({row_text_sql(ORDER_COLUMNS, ORDER_TEXT)})"

# what changed between the two snapshots, one statement for each way a key can have changed
CHANGES_SQL = f"""WITH new_stock AS (SELECT *, {ORDER_MD5_SQL} AS ingesta_md5 FROM ({NEW_ORDERS_SQL})),
    old_stock AS (SELECT *, {ORDER_MD5_SQL} AS ingesta_md5 FROM ({OLD_ORDERS_SQL}))
    SELECT *, 'I' AS sdelta_operacion FROM new_stock WHERE SDELTA_ID NOT IN (SELECT SDELTA_ID FROM old_stock)
    UNION ALL SELECT *, 'D' FROM old_stock WHERE SDELTA_ID NOT IN (SELECT SDELTA_ID FROM new_stock)
    UNION ALL SELECT n.*, 'U' FROM new_stock n, old_stock o WHERE n.SDELTA_ID = o.SDELTA_ID AND n.ingesta_md5 IS DISTINCT FROM o.ingesta_md5"""

LINE_COLUMNS = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
]
_LINE_MONEY = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


def lines(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").select(
        *[F.col(c).cast("decimal(18,2)").alias(c) if c in _LINE_MONEY else F.col(c) for c in LINE_COLUMNS]
    )


LINES_SQL = (
    "SELECT "
    + ", ".join(f"cast({c} AS decimal(18,2)) AS {c}" if c in _LINE_MONEY else c for c in LINE_COLUMNS)
    + " FROM lineitem"
)
LINE_MD5_SQL = f"md5({row_text_sql(LINE_COLUMNS, ('l_returnflag', 'l_linestatus'))})"
