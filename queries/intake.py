"""Finding files and deciding what happens to them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from acopio import contracts as C
from acopio.functions import base_name, dataset_name, file_type, loose_bool, loose_int, reader_options, relative_path
from acopio.operators import consolidate as cons, discovery, landing
from acopio.session import stage

from .inputs import MTIME0, ROOT, SOURCE_ROOT, files, files_sql, labelled, table
from .registry import query

M = files_sql()
REMOTE = files_sql(SOURCE_ROOT)


@query(
    f"""SELECT DISTINCT path, 'PENDIENTE' AS discovery_status, cast(NULL AS varchar) AS error_message,
    path AS source_file, ltrim(substr(path, {len(ROOT) + 1}), '/') AS relative_path
    FROM ({M}) WHERE path IS NOT NULL AND path <> ''"""
)
def manifest(spark: SparkSession, sf: str) -> DataFrame:
    found = discovery.manifest_from_paths(files(spark, sf).select("path"))
    return found.withColumn("relative_path", relative_path("path", ROOT))


@query(
    f"""SELECT path, CASE WHEN regexp_matches(p, '[.](xlsx|xls)$') THEN 'excel' WHEN regexp_matches(p, '[.]csv$') THEN 'csv'
    WHEN regexp_matches(p, '[.]txt$') THEN 'txt' WHEN regexp_matches(p, '[.]json$') THEN 'json'
    WHEN regexp_matches(p, '[.]parquet$') THEN 'parquet' ELSE 'unknown' END AS ext
    FROM (SELECT path, regexp_replace(lower(path), '[.](gzip|gz|bz2|zip)$', '') AS p FROM ({M}))"""
)
def file_types(spark: SparkSession, sf: str) -> DataFrame:
    return files(spark, sf).select("path", file_type("path").alias("ext"))


@query(
    """SELECT page_id, regexp_extract(url, '([^/]+)$', 1) AS name,
    split_part(split_part(list_extract(string_split(url, '/'), -1), '.', 1), '_', 1) AS dataset,
    ltrim(substr(url, strpos(url, '//') + 2), '/') AS relative_path FROM pages"""
)
def page_names(spark: SparkSession, sf: str) -> DataFrame:
    """File name, dataset and relative path of every page address."""
    url = F.col("url")
    return table(spark, sf, "pages").select(
        "page_id",
        base_name("url").alias("name"),
        dataset_name("url").alias("dataset"),
        F.ltrim(F.substr(url, F.instr(url, "//") + 2), F.lit("/")).alias("relative_path"),
    )


@query(
    """SELECT event_id,
    CASE WHEN lower(trim(word)) IN ('true', '1', 'yes', 'y', 'si', 'sí') THEN true
         WHEN lower(trim(word)) IN ('false', '0', 'no', 'n') THEN false ELSE true END AS flag,
    coalesce(CASE WHEN regexp_full_match(trim(number), '[+-]?[0-9]+') THEN try_cast(trim(number) AS integer) END, 5) AS number,
    json_extract_string(options, '$.csv.k') AS option_k
    FROM (SELECT event_id,
      CASE event_type WHEN 'view' THEN ' Sí ' WHEN 'signup' THEN 'N' WHEN 'error' THEN '' WHEN 'click' THEN 'TRUE'
                      ELSE event_type END AS word,
      CASE WHEN event_type = 'error' THEN ' ' || cast(value AS varchar) ELSE ' ' || cast(user_id AS varchar) || ' ' END AS number,
      '{"csv":' || props || '}' AS options FROM events)"""
)
def parameter_values(spark: SparkSession, sf: str) -> DataFrame:
    """Loose booleans, loose integers and reader options as JSON, one set per event."""
    raw = table(spark, sf, "events").selectExpr(
        "event_id",
        "CASE event_type WHEN 'view' THEN ' Sí ' WHEN 'signup' THEN 'N' WHEN 'error' THEN '' WHEN 'click' THEN 'TRUE' "
        "ELSE event_type END AS word",
        "CASE WHEN event_type = 'error' THEN concat(' ', cast(value AS string)) "
        "ELSE concat(' ', cast(user_id AS string), ' ') END AS number",
        """concat('{"csv":', props, '}') AS options""",
    )
    return raw.select(
        "event_id",
        loose_bool("word", True).alias("flag"),
        loose_int("number", 5).alias("number"),
        reader_options("options")["csv"]["k"].alias("option_k"),
    )


@query(
    f"""SELECT m.path, 'PENDIENTE' AS discovery_status, cast(NULL AS varchar) AS error_message, m.path AS source_file
    FROM (SELECT DISTINCT path FROM ({M})) m
    WHERE NOT EXISTS (SELECT 1 FROM (SELECT path FROM ({M}) f JOIN labels l USING (doc_id) WHERE l.quality = 1
      UNION ALL SELECT path FROM ({M}) f JOIN labels l USING (doc_id) WHERE l.quality = 0) p WHERE p.path = m.path)"""
)
def pending_files(spark: SparkSession, sf: str) -> DataFrame:
    """Files not in the checkpoint, which names some as path and some as source file."""
    f = files(spark, sf).select("doc_id", "path")
    checkpoint = f.join(labelled(spark, sf), "doc_id").select(
        F.when(F.col("quality") == 1, F.col("path")).alias("path"),
        F.when(F.col("quality") == 0, F.col("path")).alias("source_file"),
    )
    return discovery.exclude_processed(discovery.manifest_from_paths(f), checkpoint)


@query(
    f"""SELECT path, status, source_file, status = 'PENDIENTE' AND trim(path) <> '' AS pending,
    upper(status) LIKE 'ERROR%' AS inherited FROM (
      SELECT f.path, coalesce(CASE WHEN l.toxic = 1 THEN 'error_descubrimiento' WHEN l.quality = 0 THEN 'OMITIDO_NO_LISTO' END,
        'PENDIENTE') AS status, f.path AS source_file
      FROM ({M}) f LEFT JOIN labels l USING (doc_id))"""
)
def manifest_split(spark: SparkSession, sf: str) -> DataFrame:
    """Default state and source file, then pending files and inherited errors."""
    raw = files(spark, sf).join(labelled(spark, sf), "doc_id", "left").select(
        "path",
        F.when(F.col("toxic") == 1, "error_descubrimiento")
        .when(F.col("quality") == 0, C.OMITIDO_NO_LISTO)
        .alias("discovery_status"),
    )
    full = stage(discovery.with_defaults(raw), "manifest")
    told = lambda rows, name: rows.select("path", F.lit(True).alias(name))
    split = full.join(told(discovery.pending_files(full), "pending"), "path", "left").join(told(discovery.inherited_errors(full), "inherited"), "path", "left")
    return split.select(
        "path", F.col("discovery_status").alias("status"), "source_file",
        F.coalesce("pending", F.lit(False)).alias("pending"), F.coalesce("inherited", F.lit(False)).alias("inherited"),
    )


_ORDER_FILES = (
    "SELECT DISTINCT '/in/' || lower(substr(o_orderpriority, 3)) || '/ventas_' || strftime(o_orderdate, '%Y%m%d') || "
    "CASE o_orderstatus WHEN 'P' THEN '.txt' ELSE '.csv' END AS path FROM orders"
)


@query(
    f"""SELECT path FROM ({_ORDER_FILES}) WHERE list_extract(string_split(path, '/'), -1) IN (
    SELECT 'ventas_' || strftime(d, '%Y%m%d') || '.csv'
    FROM (SELECT unnest(generate_series(DATE '1995-12-20', DATE '1996-03-02', INTERVAL 1 DAY)) AS d))"""
)
def expected_files(spark: SparkSession, sf: str) -> DataFrame:
    """Daily files inside a window that spans a year end and a leap day."""
    found = table(spark, sf, "orders").selectExpr(
        "concat('/in/', lower(substr(o_orderpriority, 3)), '/ventas_', date_format(o_orderdate, 'yyyyMMdd'), "
        "CASE o_orderstatus WHEN 'P' THEN '.txt' ELSE '.csv' END) AS path"
    ).distinct()
    return landing.expected_only(found, landing.expected_names(spark, "ventas.csv", "1995-12-20", "1996-03-02"))


# --- landing: documents as remote files, reviewed ones already landed ---------
# "Now" is 20 s after the newest file, so the last files are still young; the
# second listing sees English files unchanged and the others still growing.


def _remote(spark: SparkSession, sf: str) -> DataFrame:
    """The remote files; every text is hashed once, however often the files are looked at."""
    return stage(files(spark, sf, SOURCE_ROOT), "remote-files")


def _landing_checkpoint(remote: DataFrame, sf: str) -> DataFrame:
    """Good reviewed files were landed as they are, the others under another name, with the same content."""
    done = remote.join(labelled(remote.sparkSession, sf), "doc_id")
    return done.select(
        F.when(F.col("quality") == 1, F.col("relative_path"))
        .otherwise(F.concat(F.lit("old/"), F.col("relative_path")))
        .alias("relative_path"),
        "hash",
        "remote_size",
        "remote_mtime",
    )


def _now(spark: SparkSession, sf: str) -> int:
    newest = table(spark, sf, "documents").agg(F.max("doc_id")).first()[0]
    return MTIME0 + newest + 20


def _decisions(remote: DataFrame, sf: str) -> DataFrame:
    now = _now(remote.sparkSession, sf)
    young = remote.where(F.lit(now) - F.col("remote_mtime") < C.READINESS_SKIP_WAIT_AGE_SECONDS)
    again = young.withColumn(
        "remote_size", F.when(F.col("relative_path").contains("/en_"), F.col("remote_size")).otherwise(F.col("remote_size") + 1)
    )
    return landing.decide_by_metadata(
        remote.drop("doc_id"), _landing_checkpoint(remote, sf), now, again.select("path", "remote_size")
    )


_CHECKPOINT_SQL = (
    "SELECT CASE WHEN l.quality = 1 THEN f.relative_path ELSE 'old/' || f.relative_path END AS relative_path, "
    f"f.hash, f.remote_size, f.remote_mtime FROM ({REMOTE}) f JOIN labels l USING (doc_id)"
)
_DECISION_SQL = f"""SELECT f.path, f.relative_path, f.remote_size, f.remote_mtime, f.hash,
    CASE WHEN k.relative_path IS NOT NULL THEN 'OMITIDO_YA_PROCESADO' WHEN NOT f.ready THEN 'OMITIDO_NO_LISTO' END AS status,
    CASE WHEN k.relative_path IS NOT NULL THEN 'CARGA' WHEN NOT f.ready THEN 'READINESS' END AS stage,
    CASE WHEN k.relative_path IS NOT NULL THEN 'Archivo ya procesado por checkpoint de metadata'
         WHEN NOT f.ready THEN 'Archivo en copia activa o vacío' END AS message
    FROM (SELECT *, remote_size > 0 AND ((SELECT {MTIME0} + max(doc_id) + 20 FROM documents) - remote_mtime >= 30
            OR contains(relative_path, '/en_')) AS ready FROM ({REMOTE})) f
    LEFT JOIN (SELECT DISTINCT relative_path, remote_size, remote_mtime FROM ({_CHECKPOINT_SQL})) k
      ON k.relative_path = f.relative_path AND k.remote_size = f.remote_size AND k.remote_mtime = f.remote_mtime"""


@query(f"SELECT path, status, stage, message FROM ({_DECISION_SQL})")
def landing_decision(spark: SparkSession, sf: str) -> DataFrame:
    # from metadata alone: nothing is hashed
    return _decisions(files(spark, sf, SOURCE_ROOT), sf).select("path", "status", "stage", "message")


_RESULT_SQL = f"""SELECT path AS source,
    CASE WHEN status IS NULL AND is_first THEN 's3a://lake/ventas/original/' || relative_path ELSE '' END AS target,
    CASE WHEN status IS NOT NULL THEN status WHEN is_first THEN 'PROCESADO' ELSE 'OMITIDO_YA_PROCESADO' END AS status,
    coalesce(stage, 'CARGA') AS stage,
    CASE WHEN status IS NOT NULL THEN message WHEN is_first THEN '' ELSE 'Archivo ya procesado por hash' END AS message
    FROM (SELECT *, status IS NULL AND hash NOT IN (SELECT hash FROM ({_CHECKPOINT_SQL})) AND
      row_number() OVER (PARTITION BY hash, status IS NULL ORDER BY path) = 1 AS is_first FROM ({_DECISION_SQL}))"""


def _results(spark: SparkSession, sf: str) -> DataFrame:
    """Landing results up to the copy itself."""
    remote = _remote(spark, sf)
    decided = stage(_decisions(remote, sf), "decided")
    checkpoint = _landing_checkpoint(remote, sf)
    candidates = decided.where(F.col("status").isNull())
    fresh = landing.first_per_content(candidates, checkpoint)
    landed = fresh.select(
        F.col("path").alias("source"),
        F.when(F.col("is_first"), F.concat(F.lit("s3a://lake/ventas/original/"), "relative_path")).otherwise("").alias("target"),
        F.when(F.col("is_first"), C.PROCESADO).otherwise(C.OMITIDO_YA_PROCESADO).alias("status"),
        F.lit(C.STEP_LOAD).alias("stage"),
        F.when(F.col("is_first"), "").otherwise(C.MSG_KNOWN_HASH).alias("message"),
    )
    skipped = decided.where(F.col("status").isNotNull()).select(
        F.col("path").alias("source"), F.lit("").alias("target"), "status", "stage", "message"
    )
    return landed.unionByName(skipped)


@query(
    f"""SELECT path, hash, row_number() OVER (PARTITION BY hash ORDER BY path) = 1
    AND hash NOT IN (SELECT sha256(d.text) FROM documents d JOIN labels l USING (doc_id) WHERE l.quality = 0) AS is_first
    FROM ({M})"""
)
def content_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """First path per content over every file, contents landed earlier excluded."""
    f = stage(files(spark, sf).select("doc_id", "path", "hash"), "hashed-files")
    done = f.join(labelled(spark, sf).where("quality = 0"), "doc_id").select("hash")
    return landing.first_per_content(f.select("path", "hash"), done)


@query(f"SELECT * FROM ({_RESULT_SQL})")
def landing_results(spark: SparkSession, sf: str) -> DataFrame:
    return _results(spark, sf)


@query(
    f"""SELECT ok, errors, omitted, CASE WHEN errors = 0 AND ok > 0 THEN 'FINALIZADO' ELSE 'FALLIDO' END AS estado,
    CASE WHEN errors > 0 THEN 'Se encontraron ' || errors || ' errores durante la carga' WHEN ok > 0 THEN ''
         WHEN omitted > 0 THEN 'No se cargaron archivos: ' || omitted ||
              ' archivo(s) omitido(s) por reglas de readiness/checkpoint/filtro'
         ELSE 'No se encontraron archivos válidos para cargar según la parametría recibida' END AS error
    FROM (SELECT count(*) FILTER (status = 'PROCESADO') AS ok, count(*) FILTER (status LIKE 'ERROR%') AS errors,
      count(*) FILTER (status LIKE 'OMITIDO%') AS omitted FROM ({_RESULT_SQL}))"""
)
def landing_outcome(spark: SparkSession, sf: str) -> DataFrame:
    return landing.landing_state(landing.landing_tally(_results(spark, sf)))


@query(f"SELECT DISTINCT target AS path FROM ({_RESULT_SQL}) WHERE status = 'PROCESADO' ORDER BY path")
def landed_paths(spark: SparkSession, sf: str) -> DataFrame:
    return landing.landed_paths(_results(spark, sf))


@query(
    f"""SELECT split_part(split_part(list_extract(string_split(path, '/'), -1), '.', 1), '_', 1) AS dataset, count(*) AS files
    FROM ({M}) GROUP BY 1"""
)
def files_per_dataset(spark: SparkSession, sf: str) -> DataFrame:
    return files(spark, sf).groupBy(dataset_name("path").alias("dataset")).agg(F.count(F.lit(1)).alias("files"))


_STAGE_OF = "CASE event_type WHEN 'view' THEN 0 WHEN 'click' THEN 1 ELSE 2 END"
_STAGE_NAMES = "CASE stage_order WHEN 0 THEN 'subida' WHEN 1 THEN 'descubrimiento' ELSE 'lectura' END"


@query(
    f"""SELECT user_id, CASE WHEN count(*) FILTER (estado = 'FALLIDO') > 0 THEN 'FALLIDO' ELSE 'FINALIZADO' END AS estado,
    coalesce(string_agg(stage || ': ' || CASE WHEN error = '' THEN 'Error no especificado' ELSE error END, ' | '
      ORDER BY stage_order) FILTER (estado = 'FALLIDO'), '') AS error
    FROM (SELECT user_id, stage_order, {_STAGE_NAMES} AS stage, CASE WHEN n > 12 THEN 'FALLIDO' ELSE 'FINALIZADO' END AS estado,
        CASE WHEN n > 20 THEN n || ' errores' ELSE '' END AS error
      FROM (SELECT user_id, {_STAGE_OF} AS stage_order, count(*) AS n FROM events GROUP BY 1, 2)) GROUP BY 1"""
)
def consolidate_status(spark: SparkSession, sf: str) -> DataFrame:
    """Each user's activity as one run of three stages; busy stages count as failed."""
    per_stage = (
        table(spark, sf, "events")
        .groupBy("user_id", F.expr(_STAGE_OF).alias("stage_order"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    stages = per_stage.selectExpr(
        "user_id",
        "stage_order",
        f"{_STAGE_NAMES} AS stage",
        "CASE WHEN n > 12 THEN 'FALLIDO' ELSE 'FINALIZADO' END AS estado",
        "CASE WHEN n > 20 THEN concat(n, ' errores') ELSE '' END AS error",
    )
    return cons.consolidate_runs(stages, ["user_id"])
