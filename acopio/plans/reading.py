"""Stage 3: pending files to normalised rows."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import contracts as C
from ..operators import discovery, shaping
from ..session import stage
from ..sources import tables
from ..sources.listing import list_files
from ..sources.readers import Options, ReadResult, read_files
from .discovery import root_uri


class ReadRefused(Exception):
    """The stage cannot start; ``status`` is what it reports instead."""

    def __init__(self, status: DataFrame) -> None:
        super().__init__("read stage refused its input")
        self.status = status


def parse_reader_options(raw: object) -> Options:
    """Reader options from JSON text or a mapping: extension -> (option -> value)."""
    if isinstance(raw, str):
        if not raw.strip():
            return {}
        try:
            raw = json.loads(raw)
        except json.JSONDecodeError as exc:
            raise ValueError(C.MSG_BAD_JSON.format(detail=exc)) from exc
    if not isinstance(raw, dict):
        raise ValueError(C.MSG_BAD_OPTIONS)

    def text(value: object) -> str:
        return str(value).lower() if isinstance(value, bool) else str(value)

    return {ext: {k: text(v) for k, v in (opts or {}).items() if v is not None} for ext, opts in raw.items()}


def prepare(
    spark: SparkSession, manifest: DataFrame | None, params: DataFrame | None, options: dict
) -> tuple[DataFrame, Options, str]:
    """Manifest, reader options and the folder zip members go to; raises ReadRefused with a status."""
    log = C.StepLog()
    log.add(C.LOG_START)

    def refuse(message: str) -> ReadRefused:
        return ReadRefused(C.status_frame(spark, C.FALLIDO, message, log))

    if manifest is None:
        raise refuse(C.MSG_NO_INPUT)
    status = C.is_status(manifest.columns)
    if status and C.failed_status(manifest):
        raise ReadRefused(manifest.select(*C.STATUS.fieldNames()))
    row = tables.first_row(params)
    raw = row["READER_OPTIONS"] if row is not None and "READER_OPTIONS" in row.__fields__ else None
    try:
        reader_options = parse_reader_options(raw)
    except ValueError as exc:
        raise refuse(str(exc)) from exc
    bucket, prefix = tables.parameter(row, "BUCKET_BLOB"), options.get("relative_upload_file_path")
    if "path" not in manifest.columns:
        if not status:
            raise refuse(C.MSG_NO_PATH_COLUMN)
        if bucket is None:
            raise refuse(C.MSG_MISSING_PARAMETER_IN.format(name="BUCKET_BLOB", frame=C.FRAME_READ))
        if C.is_missing(prefix):
            raise refuse(C.MSG_MISSING_PARAMETER.format(name="relative_upload_file_path"))
        files = list_files(spark, f"{root_uri(bucket)}/{prefix.strip('/')}", recursive=False)
        manifest = discovery.manifest_from_paths(files)
    unzip_to = ""
    if bucket is not None and not C.is_missing(prefix):
        unzip_to = f"{root_uri(bucket)}/{prefix.strip('/')}/{C.ZONE_UNZIPPED}"
    return manifest, reader_options, unzip_to


def read_normalise(
    spark: SparkSession,
    manifest: DataFrame | None,
    params: DataFrame | None = None,
    options: dict | None = None,
    *,
    run_id: str | None = None,
    store_options: dict | None = None,
) -> ReadResult | DataFrame:
    """Read the pending files of a manifest; a status frame when the stage cannot run.

    ``params`` holds ``BUCKET_BLOB, READER_OPTIONS``. ``ReadResult.output()`` gives
    the frame for the next stage.
    """
    try:
        files, reader_options, unzip_to = prepare(spark, manifest, params, options or {})
    except ReadRefused as refused:
        return refused.status
    return read_files(
        files, reader_options, run_id=run_id or uuid.uuid4().hex, unzip_to=unzip_to, store_options=store_options
    )


def read_waves(
    spark: SparkSession,
    manifest: DataFrame,
    params: DataFrame | None = None,
    options: dict | None = None,
    *,
    files_per_wave: int = 100_000,
    run_id: str | None = None,
    store_options: dict | None = None,
) -> Iterator[ReadResult]:
    """The same reading in several rounds of about ``files_per_wave`` files.

    Spark lists the files of a scan on the driver. Rounds bound that list
    whatever the size of the backlog; every file is in exactly one round.
    """
    files, reader_options, unzip_to = prepare(spark, manifest, params, options or {})
    files = stage(discovery.with_defaults(files), "read-backlog")
    waves = max(1, -(-files.count() // files_per_wave))
    run = run_id or uuid.uuid4().hex
    for i in range(waves):
        part = files.where(F.pmod(F.xxhash64("path"), F.lit(waves)) == i)
        yield read_files(
            part, reader_options, run_id=run, unzip_to=unzip_to, store_options=store_options
        )


def gather_waves(
    spark: SparkSession, manifest: DataFrame, params: DataFrame | None = None, options: dict | None = None, **rounds
) -> ReadResult:
    """A backlog read in rounds (see ``read_waves``), its rows, errors and files put together.

    Each round is written to the shared folder, so that the table writer sees every row of a
    period at once: it replaces the periods it gets, and rounds written one by one would
    replace each other. For a run that can be gone on with, see ``backlog.read_in_rounds``.
    """
    rows, errors, files = [], [], []
    for result in read_waves(spark, manifest, params, options, **rounds):
        if result.rows is not None:
            rows.append(stage(result.rows, "wave"))
        errors.append(stage(result.errors, "wave-errors"))
        files.append(stage(result.files, "wave-files"))
    return ReadResult(shaping.union_all(rows), shaping.union_all(errors), shaping.union_all(files))


def read_backlog(
    spark: SparkSession, manifest: DataFrame, params: DataFrame | None = None, options: dict | None = None, **rounds
) -> DataFrame:
    """What the next stage takes of a backlog read in rounds."""
    return gather_waves(spark, manifest, params, options, **rounds).output()
