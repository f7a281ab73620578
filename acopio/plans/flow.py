"""The stages in a row: land, discover, read, write, record, report."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from .. import contracts as C
from ..operators.consolidate import consolidate
from ..sources import tables
from ..sources.readers import ReadResult
from .backlog import Backlog, read_in_rounds, settle
from .discovery import checkpoint_path, discover
from .landing import LandingRun, land, landed_so_far
from .reading import read_normalise
from .writing import write_tables


@dataclass
class FlowRun:
    status: DataFrame
    landing: LandingRun
    discovery: DataFrame
    read: ReadResult | DataFrame
    audit: DataFrame


def run_flow(
    spark: SparkSession,
    landing_params: DataFrame,
    discovery_params: DataFrame,
    read_params: DataFrame,
    write_specs: DataFrame,
    options: dict,
    store_options: dict | None = None,
    stage_names: tuple[str, str, str] = C.STAGES,
    files_per_round: int = 100_000,
) -> FlowRun:
    """One ingestion run. Files count as read only once every target has been written.

    Files are read from everything landed and not yet read, so those of an earlier
    run that ended with errors are not forgotten. They are read in rounds of about
    ``files_per_round`` and written once to every target. A run that was killed goes
    on after its last whole round (see ``backlog``); one whose write failed is begun anew.
    What the rounds kept is removed when the run ends, so ``read`` of the result tells the
    run, and its frames can no longer be read.
    """
    landed = land(spark, landing_params, options, store_options)
    raw = tables.parameter(tables.first_row(discovery_params), "BUCKET_RAW")
    prefix = options.get("checkpoint_prefix")
    checkpoint = None if raw is None or C.is_missing(prefix) else checkpoint_path(raw, prefix)
    if checkpoint is not None:
        settle(spark, checkpoint)
    pending = discover(spark, landed.outcome, discovery_params, options)
    if landed.results is not None:
        uri = tables.parameter(tables.first_row(landing_params), "landing_uri")
        unread = discover(spark, landed_so_far(spark, uri, options), discovery_params, options)
        if not unread.isEmpty():
            pending = unread
    if checkpoint is None:
        read = read_normalise(spark, pending, read_params, options, store_options=store_options)
    else:
        read = read_in_rounds(
            spark, pending, read_params, options, checkpoint, files_per_round=files_per_round, store_options=store_options
        )
    rows = read.output() if isinstance(read, ReadResult) else read
    audit = write_tables(spark, rows, write_specs, options)
    stages = dict(zip(stage_names, (landed.outcome, pending, rows)))
    status = consolidate(spark, {**stages, C.AUDIT_STAGE: audit})
    if isinstance(read, Backlog):
        if audit.where(audit.estado != C.FINALIZADO).isEmpty():
            read.written()
        else:
            read.failed()
    return FlowRun(status, landed, pending, read, audit)
