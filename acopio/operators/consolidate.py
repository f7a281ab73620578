"""One status out of the statuses of many stages."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import contracts as C


def consolidate_runs(stages: DataFrame, by: list[str], count: str | None = None) -> DataFrame:
    """Status per run from rows of ``stage_order, stage, estado, error`` and the run's ``by`` columns.

    FALLIDO when any stage failed, its errors in stage order; FINALIZADO otherwise.
    The list of a run is as long as its failed stages, not its rows of data.
    ``count`` names a column for how many there are.
    """
    failed = F.upper(F.col("estado")) == C.FALLIDO
    text = F.concat(
        F.col("stage"),
        F.lit(": "),
        F.when(F.coalesce(F.col("error"), F.lit("")) == "", F.lit(C.MSG_UNSPECIFIED)).otherwise(F.col("error")),
    )
    entry = F.when(failed, F.struct(F.col("stage_order"), text.alias("text")))
    found = F.array_sort(F.collect_list(entry))
    return stages.groupBy(*by).agg(found.alias("found")).select(
        *by,
        F.when(F.size("found") > 0, F.lit(C.FALLIDO)).otherwise(F.lit(C.FINALIZADO)).alias("estado"),
        F.array_join(F.transform("found", lambda e: e["text"]), " | ").alias("error"),
        *([F.size("found").alias(count)] if count else []),
    )


def consolidate(spark: SparkSession, stages: Mapping[str, DataFrame | None] | DataFrame) -> DataFrame:
    """One status row for a flow.

    ``stages`` maps the name of each stage to its output, in flow order; outputs
    that are not a status count as success. A bare status frame is taken as the
    first stage. Audit rows of the table writer may be given too: each failed
    table is reported.
    """
    if isinstance(stages, DataFrame):
        stages = {C.STAGES[0]: stages}
    log = C.StepLog()
    log.add(C.LOG_START)
    parts = []
    for order, (name, df) in enumerate(stages.items()):
        if df is None:
            continue
        if set(C.AUDIT.fieldNames()) <= set(df.columns):  # also holds the status columns
            error = F.when(F.col("error") != "", F.col("error")).otherwise(F.col("error1"))
            found = df.select("estado", error.alias("error"))
        elif C.is_status(df.columns):
            found = df.select("estado", "error").limit(1)
        else:
            log.add(C.LOG_NO_CONTRACT.format(stage=name))
            continue
        parts.append(found.select(F.lit(order).alias("stage_order"), F.lit(name).alias("stage"), "estado", "error"))
    if not parts:
        log.add(C.LOG_NO_ERRORS)
        return C.status_frame(spark, C.FINALIZADO, "", log)

    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    before, after = C.LOG_CONSOLIDATED.split("{n}")
    last = F.when(
        F.col("errors") > 0, F.concat(F.lit(before), F.col("errors").cast("string"), F.lit(after))
    ).otherwise(F.lit(C.LOG_NO_ERRORS))
    return consolidate_runs(rows, [], count="errors").select(
        "estado", "error", last.alias("log_control"), F.lit(log.report()["log_detail"]).alias("log_detail")
    )
