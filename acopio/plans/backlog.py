"""A backlog of files read in rounds, with a ledger that says how far a run came.

Rounds bound what one reading job lists and holds. Each is written down with its rows, errors
and files before the ledger names it, so a run that was killed goes on after its last whole
round; its targets are written once, from all rounds together, and its files are recorded as
read after that. The ledger lies beside the reader checkpoint:

    <checkpoint>_rondas/abiertas/<run>/ledger     one row per step of an open run
    <checkpoint>_rondas/abiertas/<run>/ronda=<n>  rows, errors, files and entries of a round
    <checkpoint>_rondas/cerradas                  one row per run that was committed

What an open run wrote goes when it ends, so a start looks at open runs only.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections import defaultdict
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import contracts as C
from ..operators import discovery, shaping
from ..session import stage
from ..sources import tables
from ..sources.readers import ReadResult, read_files
from .discovery import commit
from .reading import ReadRefused, prepare

LEDGER = "run string, round int, files bigint, state string, options string, at timestamp"
CLOSED = "run string, rounds int, files bigint, at timestamp"
#: States of a run: begun, a round read, all targets written.
BEGUN, READ, WRITTEN = "begun", "read", "written"


def ledger_path(checkpoint: str) -> str:
    return f"{checkpoint.rstrip('/')}_rondas"


class Ledger:
    """The open runs below a folder. One driver at a time works on it."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self._spark = spark
        self._open, self._closed = f"{folder}/abiertas", f"{folder}/cerradas"

    def runs(self) -> list[str]:
        """Open runs, oldest first. There is more than one only if drivers ran side by side."""
        return sorted(tables.child_folders(self._spark, self._open)) if tables.path_exists(self._spark, self._open) else []

    def begin(self, options: str) -> str:
        now = self._spark.range(1).select(F.date_format(F.current_timestamp(), "yyyyMMddHHmmss")).first()[0]
        run = f"{now}-{uuid.uuid4().hex[:8]}"
        self.note(run, BEGUN, options=options)
        return run

    def note(self, run: str, state: str, number: int | None = None, files: int = 0, options: str | None = None) -> None:
        """One row, in one file, which appears when it is whole."""
        row = self._spark.range(1).select(
            F.lit(run).alias("run"), F.lit(number).cast("int").alias("round"), F.lit(files).cast("bigint").alias("files"),
            F.lit(state).alias("state"), F.lit(options).cast("string").alias("options"), F.current_timestamp().alias("at"),
        )
        row.coalesce(1).write.mode("append").parquet(f"{self._open}/{run}/ledger")

    def steps(self, run: str) -> DataFrame:
        folder = f"{self._open}/{run}/ledger"
        if not tables.has_files(self._spark, folder):
            return self._spark.createDataFrame([], LEDGER)
        return self._spark.read.schema(LEDGER).parquet(folder)

    def options_of(self, run: str) -> str | None:
        begun = self.steps(run).where(F.col("state") == BEGUN).first()
        return begun.options if begun else None

    def rounds(self, run: str) -> list[int]:
        """Numbers of the rounds read whole."""
        read = self.steps(run).where(F.col("state") == READ).select("round").distinct()
        return sorted(r["round"] for r in read.collect())

    def written(self, run: str) -> bool:
        return not self.steps(run).where(F.col("state") == WRITTEN).isEmpty()

    def round_folder(self, run: str, number: int) -> str:
        return f"{self._open}/{run}/ronda={number}"

    def close(self, run: str) -> None:
        """Keep one row about a committed run and remove the rest."""
        steps = self.steps(run).where(F.col("state") == READ).groupBy("round").agg(F.max("files").alias("files"))
        summed = steps.agg(F.count(F.lit(1)).cast("int").alias("rounds"), F.coalesce(F.sum("files"), F.lit(0)).alias("files"))
        row = summed.select(F.lit(run).alias("run"), "rounds", "files", F.current_timestamp().alias("at"))
        row.coalesce(1).write.mode("append").parquet(self._closed)
        self.drop(run)

    def drop(self, run: str) -> None:
        tables.delete_path(self._spark, f"{self._open}/{run}")

    def closed(self) -> DataFrame:
        if not tables.has_files(self._spark, self._closed):
            return self._spark.createDataFrame([], CLOSED)
        return self._spark.read.schema(CLOSED).parquet(self._closed)


@dataclass
class Backlog(ReadResult):
    """All rounds of a run put together, and the run they belong to."""

    run: str = ""
    ledger: Ledger | None = None
    checkpoint: str = ""

    def written(self) -> None:
        """Every target holds the rows: record the files as read and end the run."""
        self.ledger.note(self.run, WRITTEN)
        _commit(self.files.sparkSession, self.ledger, self.run, self.checkpoint)

    def failed(self) -> None:
        """A target could not be written: the next run reads the files again, whatever was mended meanwhile."""
        self.ledger.drop(self.run)


def _commit(spark: SparkSession, ledger: Ledger, run: str, checkpoint: str) -> None:
    files = _together(spark, ledger, run, "files")
    if files is not None:
        commit(files, checkpoint)
    ledger.close(run)


def settle(spark: SparkSession, checkpoint: str) -> None:
    """End runs that were killed after their targets were written and before their files were recorded.

    To be called before discovery, which would otherwise find those files again. A file
    recorded twice counts once.
    """
    ledger = Ledger(spark, ledger_path(checkpoint))
    for run in ledger.runs():
        if ledger.written(run):
            _commit(spark, ledger, run, checkpoint)


def _together(spark: SparkSession, ledger: Ledger, run: str, part: str) -> DataFrame | None:
    """One part of all rounds: a scan for each different set of columns, not for each round."""
    found = defaultdict(list)
    for number in ledger.rounds(run):
        folder = f"{ledger.round_folder(run, number)}/{part}"
        if tables.has_files(spark, folder):
            schema = spark.read.parquet(folder).schema
            found[schema.json()].append((schema, folder))
    frames = [spark.read.schema(same[0][0]).parquet(*(folder for _, folder in same)) for same in found.values()]
    return shaping.union_all(frames)


def _entry() -> F.Column:
    """What tells the entries of a manifest apart: an inherited error may have no path."""
    return F.md5(F.concat_ws("\x1f", *[F.coalesce(F.col(c), F.lit("\x1e")) for c in C.MANIFEST.fieldNames()]))


def read_in_rounds(
    spark: SparkSession,
    manifest: DataFrame | None,
    params: DataFrame | None,
    options: dict,
    checkpoint: str,
    *,
    files_per_round: int = 100_000,
    store_options: dict | None = None,
) -> Backlog | DataFrame:
    """Read the pending files of a manifest in rounds of about ``files_per_round``; a status frame when the stage cannot run.

    An open run with the same reader options is gone on with: entries of its rounds are not
    read again, others get new rounds. Open runs with other options are dropped. Every entry
    is in exactly one round.
    """
    try:
        files, reader_options, unzip_to = prepare(spark, manifest, params, options)
    except ReadRefused as refused:
        return refused.status
    ledger = Ledger(spark, ledger_path(checkpoint))
    told = hashlib.sha256(json.dumps(reader_options, sort_keys=True).encode()).hexdigest()
    alike = [run for run in ledger.runs() if ledger.options_of(run) == told]
    for run in ledger.runs():
        if run not in alike[-1:]:
            ledger.drop(run)
    run = alike[-1] if alike else ledger.begin(told)

    done = ledger.rounds(run)
    todo = discovery.with_defaults(files).withColumn("entry", _entry())
    read = _together(spark, ledger, run, "entries")
    if read is not None:
        todo = todo.join(read, "entry", "left_anti")
    todo = stage(todo, "read-backlog")
    count = todo.count()
    rounds = -(-count // files_per_round)
    first = max(done, default=-1) + 1
    for i in range(rounds):
        part = todo.where(F.pmod(F.xxhash64("entry"), F.lit(rounds)) == i)
        result = read_files(part.drop("entry"), reader_options, run_id=run, unzip_to=unzip_to, store_options=store_options)
        _keep(ledger, run, first + i, part, result)

    rows, errors, taken = (_together(spark, ledger, run, p) for p in ("rows", "errors", "files"))
    nothing = spark.createDataFrame([], "path string, source_file string")
    return Backlog(
        rows=rows,
        errors=errors if errors is not None else shaping.error_rows(spark.createDataFrame([], "path string, record_status string, error_message string, source_file string, dataset string")),
        files=taken if taken is not None else nothing,
        run=run,
        ledger=ledger,
        checkpoint=checkpoint,
    )


def _keep(ledger: Ledger, run: str, number: int, part: DataFrame, result: ReadResult) -> None:
    """Write a round down, then name it in the ledger. Half a round of an earlier attempt goes first."""
    folder = ledger.round_folder(run, number)
    tables.delete_path(part.sparkSession, folder)
    parts = {"rows": result.rows, "errors": result.errors, "files": result.files, "entries": part.select("entry")}
    for name, df in parts.items():
        if df is not None:
            df.write.parquet(f"{folder}/{name}")
    ledger.note(run, READ, number, part.count())
