"""Stage 4: rows to their target tables, with one audit row per target."""

from __future__ import annotations

import re
from contextlib import ExitStack
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, Observation, Row, SparkSession, functions as F

from .. import contracts as C
from ..functions import blank, checksum, fingerprint_columns, local_time, row_hash, row_md5
from ..functions.fingerprint import quoted
from ..operators import shaping, snapshot, summary
from ..session import staged
from ..sinks import tables as sinks
from ..sources import tables

_BOOL = {**{w: True for w in C.TRUE_WORDS}, **{w: False for w in C.FALSE_WORDS}}


def loose_flag(value: object, default: bool = False) -> bool:
    return value if isinstance(value, bool) else _BOOL.get(str(value).strip().lower(), default)


def _local_now(spark: SparkSession, zone: str) -> datetime:
    return spark.range(1).select(local_time(F.current_timestamp(), zone)).first()[0]


def _audit(**given: object) -> dict:
    row: dict = {}
    for field in C.AUDIT:
        kind = field.dataType.typeName()
        row[field.name] = 0 if kind == "long" else "" if kind == "string" else None
    row["tiene_shist"] = "0"
    return {**row, **given}


def write_tables(
    spark: SparkSession, df: DataFrame, specs: DataFrame, options: dict | None = None
) -> DataFrame:
    """Write ``df`` to every target of ``specs``; one audit row each, failures kept apart.

    ``options``: ``calcula_md5``, ``zona_horaria``, ``hash_heredado`` (fingerprints
    without separator, as in old tables), ``reemplazo_parquet`` (parquet history
    replaces by condition instead of by the periods it brings).
    """
    options = options or {}
    zone = options.get("zona_horaria", C.LOCAL_ZONE)
    if C.is_status(df.columns) and C.failed_status(df):
        upstream = df.select(*C.STATUS.fieldNames()).first()
        now = _local_now(spark, zone)
        passed = _audit(
            fecha_inicio=now,
            fecha_fin=now,
            estado=upstream.estado,
            error=upstream.error,
            log_control=upstream.log_control,
            log_detail=upstream.log_detail,
        )
        return spark.createDataFrame([Row(**passed)], C.AUDIT)

    if specs is not None:
        named = "p_id_ingesta" in specs.columns
        nameless = (specs.where(blank(F.col("p_id_ingesta").cast("string"))) if named else specs).count()
        if nameless:
            raise ValueError(f"{nameless} write parameter row(s) without p_id_ingesta")
    audits = []
    with ExitStack() as stack:
        if specs is not None and specs.limit(2).count() > 1:
            # read and parsed once, whatever the number of targets
            df = stack.enter_context(staged(df, "write-input"))
        for spec in tables.parameter_rows(specs):
            audits.append(_write_one(spark, df, spec, options, zone))
    return spark.createDataFrame([Row(**a) for a in audits], C.AUDIT)


def _write_one(spark: SparkSession, df: DataFrame, spec: Row, options: dict, zone: str) -> dict:
    log = C.StepLog()
    log.add(C.LOG_START)

    def given(name: str, default: object = None) -> object:
        return spec[name] if name in spec.__fields__ else default

    target = f"{given('p_ruta_salida')}/{given('p_nombre_tabla')}"
    audit = _audit(
        id_ingesta=str(given("p_id_ingesta")),
        fecha_inicio=_local_now(spark, zone),
        estado=C.INICIADO,
        id_control=given("id_control"),
        punto_control=given("p_last_control"),
        p_columna_delta_tipo_dato=given("p_columna_delta_tipo_dato"),
        log1=given("log1"),
        error1=given("error1"),
        coleccion_salida=given("coleccion_salida"),
        nombre_tabla=given("p_nombre_tabla"),
        root_metada_path=given("root_metada_path"),
        tiene_shist=str(given("p_requiere_shist")),
        objeto_existe=tables.table_exists(spark, given("coleccion_salida"), given("p_nombre_tabla")),
    )
    try:
        if df.isEmpty():
            audit.update(estado=C.FALLIDO, log1=target, error1=C.MSG_NO_DATA)
        else:
            log.add(C.LOG_READ)
            audit.update(_write_rows(spark, df, spec, target, options, zone, log))
            audit["estado"] = C.FINALIZADO
            log.add(C.LOG_SUMMARY)
    except Exception as exc:
        audit.update(estado=C.FALLIDO, error=C.error_text(exc), cantidad_leidos=_count_or_zero(df))
    audit["fecha_fin"] = _local_now(spark, zone)
    audit.update(log.report())
    if audit["estado"] == C.FINALIZADO:
        audit["log_detail"] += f" Ubicacion: {target}"
    return audit


def _count_or_zero(df: DataFrame) -> int:
    """Rows read, for the audit row of a failed write; a frame that cannot be read has none."""
    try:
        return df.count()
    except Exception:
        return 0


def prepared_rows(df: DataFrame, extras: str | None, *, md5: bool, zone: str, legacy: bool = False) -> DataFrame:
    """Rows as they go to a table: no control columns, extras, fingerprints, local load time."""
    base = shaping.drop_control(df)
    columns = base.columns if legacy else fingerprint_columns(base)
    columns = [c for c in columns if c.lower() != C.READ_PARTITION_COLUMN.lower()]
    prints = [row_hash(base, columns, legacy).alias("ingesta_hash")]
    if md5:
        prints.append(row_md5(base, columns, legacy).alias("ingesta_md5"))
    extra = [F.expr(e) for e in shaping.extra_expressions(extras)]
    return base.select("*", *extra, *prints, local_time(F.current_timestamp(), zone).alias("fecha_ingesta"))


def _write_rows(
    spark: SparkSession, df: DataFrame, spec: Row, target: str, options: dict, zone: str, log: C.StepLog
) -> dict:
    fmt, kind = str(spec["tipo_escritura"]), str(spec["tipo_tabla"])
    if (fmt, kind) not in WRITERS:
        raise ValueError(C.MSG_UNSUPPORTED_WRITE.format(fmt=fmt, kind=kind))
    if fmt == "delta" and not tables.delta_available(spark):
        raise ValueError("the Delta connector is not on the class path")
    extras = tables.parameter(spec, "p_expresion_campos_extras", "")
    condition = tables.parameter(spec, "p_condicion_reproceso")
    stock_delta = kind == "stock" and "SDELTA_ID" in extras
    rows = prepared_rows(
        df,
        extras,
        md5=stock_delta or loose_flag(options.get("calcula_md5", False)),
        zone=zone,
        legacy=loose_flag(options.get("hash_heredado", False)),
    )
    log.add(C.LOG_EXTRAS)

    schema = tables.target_schema(spark, target, fmt)
    partitioned = kind == "history"
    if schema is not None and partitioned:
        # the period of a history is the name of a folder; the rows keep their own type of it
        schema = type(schema)([f for f in schema if f.name.lower() != sinks.PERIOD])
    one_period = _one_period(extras, df.columns)
    if partitioned and not one_period:
        rows = sinks.by_period(rows)

    # count, range, checksum and lost values are taken while the rows are written
    seen = Observation()
    unseen = rows  # the same rows for checks: an observation must see one whole run
    control = tables.parameter(spec, "p_columna_delta")
    rows = rows.observe(
        seen,
        *summary.write_summary(control),
        checksum(rows).alias("checksum_source"),
        F.coalesce(F.sum(shaping.lost_values(rows, schema)), F.lit(0)).alias("lost"),
        *_periods(rows),
    )
    if schema is not None:
        rows, unseen = shaping.cast_to_target(rows, schema), shaping.cast_to_target(unseen, schema)
        log.add(C.LOG_CAST)
    else:
        log.add(C.LOG_NO_CAST)

    job = Job(target, condition, stock_delta, str(spec["p_requiere_shist"]) == "1", one_period, options, log)
    WRITERS[(fmt, kind)](rows, unseen, job)
    facts = seen.get
    if facts["lost"]:
        log.add(C.LOG_LOST.format(n=facts["lost"]))

    # exactly what was written, with the rows' own schema: an untouched period is none of this
    # write, and a period is not guessed from folder names
    if job.entries is not None:
        back = tables.read_entries(spark, target, job.entries, rows.schema)
    else:
        back = tables.read_table(spark, target, fmt, rows.schema if fmt == "parquet" else None)
        if partitioned:
            period = quoted(sinks.PERIOD).cast("string")
            written = period.isin(*facts["periods"]) if facts["periods"] else F.lit(False)
            back = back.where(written | period.isNull() if facts["without_period"] else written)
    arrived = back.agg(F.count(F.lit(1)).alias("n"), checksum(back).alias("c")).first()
    agree = arrived.n == facts["cantidad_insertados"] and arrived.c == facts["checksum_source"]
    log.add(C.LOG_AGREE if agree else C.LOG_DIFFER)
    return {
        "cantidad_leidos": facts["cantidad_insertados"],
        "cantidad_insertados": facts["cantidad_insertados"],
        "rango_ini_procesado": facts["rango_ini_procesado"],
        "rango_fin_procesado": facts["rango_fin_procesado"],
        "checksum_source": facts["checksum_source"],
        "checksum_destination": arrived.c,
        "is_stock_delta": int(stock_delta),
    }


def _one_period(extras: str, columns: list[str]) -> bool:
    """True when the period of the rows is a constant of the extra expressions."""
    for expression in shaping.extra_expressions(extras):
        if re.search(rf"(?<!\w){sinks.PERIOD}`?\s*$", expression.lower()):
            return sinks.is_constant(expression, columns)
    return False


def _periods(rows: DataFrame) -> list:
    """The periods of the rows, which are as few as the folders they go to, and whether some have none."""
    has = any(c.lower() == sinks.PERIOD for c in rows.columns)
    period = quoted(sinks.PERIOD).cast("string") if has else F.lit(None).cast("string")
    return [F.collect_set(period).alias("periods"), F.coalesce(F.max(period.isNull()), F.lit(False)).alias("without_period")]


# --- one function per (format, kind) -------------------------------------------


@dataclass
class Job:
    """What a writer needs besides the rows."""

    target: str
    condition: str | None
    stock_delta: bool
    keep_history: bool
    one_period: bool
    options: dict
    log: C.StepLog
    #: folders of a history that were written, where the writer knows them
    entries: list[str] | None = None


def _parquet_history(rows: DataFrame, unseen: DataFrame, job: Job) -> None:
    if job.condition and loose_flag(job.options.get("reemplazo_parquet", True)):
        used, job.entries = sinks.replace_covered(rows, job.target, job.condition)
        job.log.add(C.LOG_RANGE.format(range=used))
    else:
        job.entries = sinks.write_history(rows, job.target)
    job.log.add(C.LOG_SAVED.format(form="PARQUET", table="HISTORY"))


def _parquet_stock(rows: DataFrame, unseen: DataFrame, job: Job) -> None:
    spark = rows.sparkSession
    # written once, beside the old table: the comparison starts from these files, and the
    # old table is still whole while the changes are worked out
    compare = lambda new: write_stock_delta(spark, new, job.target, "parquet", job.log)
    sinks.write_stock(rows, job.target, compare if job.stock_delta else None)
    job.log.add(C.LOG_SAVED.format(form="PARQUET", table="STOCK"))
    if job.keep_history:
        current = tables.read_table(spark, job.target)
        sinks.write_history(current if job.one_period else sinks.by_period(current), f"{job.target}_shist")
        job.log.add(C.LOG_SAVED.format(form="PARQUET", table="STOCK_SHIST"))


def _delta_history(rows: DataFrame, unseen: DataFrame, job: Job) -> None:
    used = sinks.replace_where_or_range(unseen, job.condition, lambda c: sinks.delta_replace(rows, c, job.target))
    job.log.add(C.LOG_RANGE.format(range=used))
    job.log.add(C.LOG_SAVED.format(form="DELTA", table="HISTORY"))


def _delta_stock(rows: DataFrame, unseen: DataFrame, job: Job) -> None:
    spark = rows.sparkSession
    with ExitStack() as stack:
        if job.stock_delta:
            rows = stack.enter_context(staged(rows, "new-stock"))
            write_stock_delta(spark, rows, job.target, "delta", job.log)
        sinks.delta_stock(rows, job.target)
        job.log.add(C.LOG_SAVED.format(form="DELTA", table="STOCK"))
    if job.keep_history:
        current = tables.read_table(spark, job.target, "delta")
        sinks.replace_where_or_range(
            current, job.condition, lambda c: sinks.delta_replace(current, c, f"{job.target}_shist")
        )
        job.log.add(C.LOG_SAVED.format(form="DELTA", table="STOCK_SHIST"))


WRITERS = {
    ("parquet", "history"): _parquet_history,
    ("parquet", "stock"): _parquet_stock,
    ("delta", "history"): _delta_history,
    ("delta", "stock"): _delta_stock,
}


def period_of(df: DataFrame) -> str | None:
    """The one period of a stock snapshot, as text; None without rows. More than one is an error."""
    return _period_and_count(df)[0]


def _period_and_count(df: DataFrame) -> tuple[str | None, int]:
    text = quoted(sinks.PERIOD).cast("string")
    ends = df.agg(F.min(text).alias("low"), F.max(text).alias("high"), F.count(F.lit(1)).alias("n")).first()
    if ends.n == 0:
        return None, 0
    if ends.low != ends.high:
        raise ValueError(f"a stock snapshot must hold one periodo, found {ends.low} to {ends.high}")
    return ends.low or "", ends.n


def write_stock_delta(spark: SparkSession, new: DataFrame, target: str, fmt: str, log: C.StepLog) -> None:
    """Change rows of the new stock against the current one, into ``<target>_sdelta``.

    The first time there is nothing to compare with, and every row counts as inserted. Run
    again before the stock itself was replaced, it leaves the same rows: they belong to the
    version of the stock they start from.
    """
    new_period = period_of(new) or ""
    log.add(C.LOG_NEW_PERIOD.format(period=new_period))
    changes_at = f"{target}_sdelta"
    previous = max((value or "" for _, value in sinks.period_folders(spark, changes_at)), default="")
    log.add(C.LOG_LAST_DELTA.format(period=previous))

    old, old_period = None, None
    if tables.target_schema(spark, target, fmt) is not None:
        old = tables.read_table(spark, target, fmt)
        old_period, count = _period_and_count(old)
        log.add(C.LOG_LAST_COUNT.format(n=count))
    version = sinks.stock_version(spark, target)
    if previous == "" or old_period is None:
        first = snapshot.first_delta(new).withColumn(sinks.PERIOD, F.lit(new_period))
        sinks.write_sdelta(first, target, append=False, new_period=new_period, version=version)
        log.add(C.LOG_FIRST_DELTA.format(path=changes_at))
        return
    delta = snapshot.snapshot_delta(new, old, new_period=new_period, old_period=old_period)
    # few changes come from many tasks: gathered into files of a sensible size, counted on the way.
    # without changes nothing is written, and no period is replaced
    seen = Observation()
    changes = delta.hint("rebalance").observe(seen, F.count(F.lit(1)).alias("n"))
    append = previous == new_period
    sinks.write_sdelta(changes, target, append=append, new_period=new_period, version=version)
    log.add(C.LOG_DELTA_COUNT.format(n=seen.get["n"]))
    log.add(C.LOG_DELTA_MODE.format(mode="append" if append else "overwrite"))
