"""Files of one fixed format as an incremental feed: each file once, also across restarts.

The streaming checkpoint remembers which files were taken, so this needs no
reader checkpoint of its own. For mixed formats use ``plans``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from .. import contracts as C
from ..functions import batch_id, dataset_name, metadata_path
from ..operators import shaping
from ..plans.writing import write_tables
from ..sinks.tables import write_history
from ..sources import tables


def file_stream(
    spark: SparkSession,
    source: str,
    fmt: str,
    schema: T.StructType | str,
    options: dict[str, str] | None = None,
    run_id: str = "stream",
    max_files_per_trigger: int = 10_000,
    archive: str | None = None,
    max_age: str = "3650d",
) -> DataFrame:
    """New files below ``source`` as all-text rows with lineage.

    ``max_files_per_trigger`` bounds one micro-batch, not the run: with
    ``availableNow`` all files present are taken, over as many batches as needed.

    Files of batches that were committed move to ``archive``, a folder outside ``source``, so
    a start lists what arrived since and not the whole past; those of a run's last batch move
    when the next one starts. Without it they stay. ``max_age`` bounds what the checkpoint
    has to remember: files that are older than the newest one by more are not looked at, so it
    must exceed the time a delivery may be late.
    """
    reader = spark.readStream.format(fmt).schema(schema).option("maxFilesPerTrigger", max_files_per_trigger)
    reader = reader.option("maxFileAge", max_age)
    if archive is not None:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    for name, value in (options or {}).items():
        reader = reader.option(name, value)
    raw = reader.load(source)
    own = raw.columns
    rows = raw.select(
        *[F.col(f"`{c}`").cast("string").alias(c) for c in own],
        metadata_path().alias("__file"),
        F.current_timestamp().cast("string").alias("__now"),
    )
    file = F.col("__file")
    decorated = shaping.lineage(
        rows, source_file=file, path=file, batch=batch_id(run_id, file), dataset=dataset_name(file), ingestion_ts=F.col("__now")
    )
    return shaping.finish(decorated.drop("__file", "__now"))


def drain(stream: DataFrame, checkpoint: str, each: Callable[[DataFrame, int], None]) -> StreamingQuery:
    """Run ``each`` over everything that has arrived and stop."""
    query = (
        stream.writeStream.foreachBatch(each)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def append_batch(target: str) -> Callable[[DataFrame, int], None]:
    """Batch writer that leaves the same table when a batch is repeated after a failure.

    Each batch owns the partition ``lote=<id>`` and replaces it.
    """

    def write(batch: DataFrame, number: int) -> None:
        write_history(batch.withColumn("lote", F.lit(number)), target, "lote")

    return write


def drain_to_tables(stream: DataFrame, checkpoint: str, held: str, specs: DataFrame, options: dict | None = None) -> DataFrame:
    """Take everything that has arrived and write it once to every target; returns the audit rows.

    The table writer replaces the periods it gets, so micro-batches written one by one would
    replace each other. They are kept in ``held``, a table by batch, until all targets are
    written. Batches of a run that died or failed stay there and go with the next one. The
    number of the last batch written is marked before its rows are removed, so a run that
    dies in between neither loses nor repeats any. ``lote_numero`` is the number of a row's
    batch and may be used in extra expressions. Without new rows there are no audit rows.
    """
    spark = stream.sparkSession
    drain(stream, checkpoint, append_batch(held))
    folders = tables.child_folders(spark, held) if tables.path_exists(spark, held) else []
    batches = {int(f.split("=")[1]): f for f in folders if f.startswith("lote=")}
    written = max([int(f.rsplit("-", 1)[1]) for f in folders if f.startswith("_written-")], default=-1)
    waiting = [n for n in batches if n > written]
    audit = spark.createDataFrame([], C.AUDIT)
    if waiting:
        layout = T.StructType([*stream.schema, T.StructField("lote", T.IntegerType())])
        rows = tables.read_table(spark, held, schema=layout).where(F.col("lote") > written)
        audit = write_tables(spark, rows.withColumnRenamed("lote", "lote_numero"), specs, options)
        if not audit.where(F.col("estado") != C.FINALIZADO).isEmpty():
            return audit
        written = max(waiting)
        tables.make_folder(spark, f"{held}/_written-{written}")
    for number, folder in batches.items():
        if number <= written:
            tables.delete_path(spark, f"{held}/{folder}")
    return audit
