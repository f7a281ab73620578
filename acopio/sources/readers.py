"""Mixed files to all-text rows with lineage, one Spark scan per layout.

A dataset may hold files of different types and column orders. Files are
grouped by layout, each group is read by one Spark scan, and lineage comes from
the scan's own file metadata. A file that cannot be read becomes an error row
and the others go on.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F

from .. import contracts as C
from ..functions import batch_id, dataset_name, file_type, metadata_path
from ..operators import discovery, shaping
from ..session import stage
from .archives import unpack
from .excel import excel_options, sheet_rows
from .faults import refuses_a_file
from .listing import few_listing_tasks, qualified, small_files_together
from .probe import EMPTY, flag, probe, reader_for
from .store import Store, spread

Options = dict[str, dict[str, str]]
#: Files of scans that are left to be read later: the driver keeps an entry for each. With more, scans are written one by one.
FILES_HELD = 100_000


@dataclass
class ReadResult:
    """``rows`` with lineage (None when nothing was read), ``errors``, and the ``files`` read."""

    rows: DataFrame | None
    errors: DataFrame
    files: DataFrame

    def combined(self) -> DataFrame:
        """Read rows and error rows in one frame."""
        return shaping.union_all([f for f in (self.rows, self.errors) if f is not None])

    def output(self) -> DataFrame:
        """What the next stage takes: clean rows, or rows and errors together if there were errors."""
        if not self.errors.isEmpty():
            return self.combined()
        if self.rows is None:
            return self.errors.sparkSession.createDataFrame([], C.LINEAGE)
        return shaping.finish(self.rows)


def targets_of(
    manifest: DataFrame, options: Options, *, unzip_to: str, run_id: str, store_options: dict | None = None
) -> tuple[DataFrame, DataFrame]:
    """``read_path, path, source_file, ext`` of everything to read, and ``path, source_file, message`` of what cannot be."""
    lower = F.lower("path")
    pending = discovery.pending_files(manifest).select("path").distinct()
    # names are judged once and by many tasks; a manifest is few bytes and would be one task's
    names = spread(pending, F.xxhash64("path")).select("path", file_type("path").alias("ext"), lower.endswith(".zip").alias("is_zip"))
    named = stage(names, "read-names")
    compressed = lower.endswith(".gz") | lower.endswith(".gzip") | lower.endswith(".bz2")
    plain = named.where("NOT is_zip").select(F.col("path").alias("read_path"), "path", F.col("path").alias("source_file"), "ext")
    zips = named.where("is_zip").select("path")
    refused: DataFrame | None = None
    if not zips.isEmpty():
        members, broken = unpack(zips, unzip_to, run_id, store_options)
        plain = plain.unionByName(members.select("read_path", "path", "source_file", file_type("read_path").alias("ext")))
        refused = broken.select("path", F.col("path").alias("source_file"), "message")

    before, after = C.MSG_NO_OPTIONS_COMPRESSED.split("{path}")
    no_before, no_after = C.MSG_NO_OPTIONS.split("{ext}")
    un_before, un_after = C.MSG_UNSUPPORTED_EXTENSION.split("{ext}")
    known = F.col("ext").isin(*options) if options else F.lit(False)
    message = (
        F.when((F.col("ext") == "unknown") & compressed, F.concat(F.lit(before), "path", F.lit(after)))
        .when(~known, F.concat(F.lit(no_before), "ext", F.lit(no_after)))
        .when(F.col("ext") == "unknown", F.concat(F.lit(un_before), "ext", F.lit(un_after)))
    )
    judged = stage(plain.withColumn("message", message), "read-judged")
    bad = judged.where(F.col("message").isNotNull()).select("path", "source_file", "message")
    good = judged.where(F.col("message").isNull()).drop("message")
    return good, bad if refused is None else bad.unionByName(refused)


def read_files(
    manifest: DataFrame,
    options: Options,
    *,
    run_id: str,
    unzip_to: str,
    ingestion_ts: str | None = None,
    files_per_scan: int = 20_000,
    files_held: int | None = None,
    store_options: dict | None = None,
) -> ReadResult:
    """Read the pending files of a manifest.

    Spark keeps one entry per file of a scan on the driver, so a layout with
    more than ``files_per_scan`` files is read by several scans. With more than
    ``files_held`` files (``FILES_HELD``) in all, the rows of each scan are written to the shared
    folder before the next one is planned, so that the driver holds one scan at a time.
    """
    spark = manifest.sparkSession
    # the manifest is looked at several times below; how it came about is worked out once
    full = stage(discovery.with_defaults(manifest), "read-manifest")
    targets, refused = targets_of(full, options, unzip_to=unzip_to, run_id=run_id, store_options=store_options)
    stamp = F.lit(ingestion_ts) if ingestion_ts else F.lit(spark.range(1).select(F.current_timestamp().cast("string")).first()[0])

    # one row per file: what it is, its layout, whether it opened
    looked = probe(targets, options, store_options)
    catalogue = stage(looked.withColumn("file_key", qualified(F.col("read_path"), spark)), "read-catalogue")
    catalogue = _json_layouts(catalogue, options, files_per_scan)
    catalogue = _inferred_csv_layouts(catalogue, options, files_per_scan)
    # metadata gives the path of an ordinary file; archive members are looked up,
    # and a folder is read under its own name
    kind = (
        F.when(F.col("is_dir"), F.col("read_path"))
        .when(F.col("file_key") == F.col("path"), F.lit("direct"))
        .otherwise(F.lit("mapped"))
    )
    readable = catalogue.where(F.col("error").isNull()).withColumn("kind", kind)
    to_scan = readable.where(F.col("layout") != EMPTY)

    frames: list[DataFrame] = []
    late_errors: list[tuple[str, str]] = []
    groups = _groups(to_scan)
    several = sum(g.files for g in groups) > (FILES_HELD if files_held is None else files_held)
    for group in groups:
        opts = dict(options.get(group.ext) or {})
        if reader_for(group.ext, opts) == "excel":
            frames.append(_excel_rows(to_scan, group, opts, run_id, stamp, store_options))
            continue
        for paths in _paths(_of_group(to_scan, group), files_per_scan):
            for scan in _scan(spark, group.ext, opts, paths, late_errors):
                rows = _with_lineage(scan, to_scan, group, run_id, stamp)
                frames.append(_written(rows, "read-scan") if several else rows)

    read = readable.select("read_path", "path", "source_file")
    failed = refused.unionByName(
        catalogue.where(F.col("error").isNotNull()).select("path", "source_file", F.col("error").alias("message"))
    )
    if late_errors:
        late = spark.createDataFrame(late_errors, "read_path string, message string")
        failed = failed.unionByName(read.join(late, "read_path").select("path", "source_file", "message"))
        read = read.join(late, "read_path", "left_anti")
    errors = failed.select(
        "path",
        F.lit(C.ERROR_LECTURA).alias("record_status"),
        F.col("message").alias("error_message"),
        "source_file",
        dataset_name("source_file").alias("dataset"),
    ).unionByName(_inherited(full))
    return ReadResult(
        rows=shaping.union_all(frames),
        errors=shaping.error_rows(errors),
        files=read.select("path", "source_file"),
    )


def _inherited(manifest: DataFrame) -> DataFrame:
    source = F.when(~(F.trim("source_file") == ""), F.col("source_file"))
    return discovery.inherited_errors(manifest).select(
        source.alias("path"),
        F.lit(C.ERROR_UPSTREAM).alias("record_status"),
        F.coalesce(
            F.when(F.col("error_message") != "", F.col("error_message")), F.col("discovery_status"), F.lit(C.MSG_INHERITED)
        ).alias("error_message"),
        source.alias("source_file"),
        dataset_name(source).alias("dataset"),
    )


def _groups(files: DataFrame) -> list[Row]:
    """One row per layout. There are as many as there are distinct layouts, not files."""
    return files.groupBy("ext", "layout", "kind").agg(F.count(F.lit(1)).alias("files")).orderBy("ext", "layout", "kind").collect()


def _of_group(files: DataFrame, group: Row) -> DataFrame:
    return files.where(
        (F.col("ext") == group.ext) & (F.col("layout") == group.layout) & (F.col("kind") == group.kind)
    )


def _paths(files: DataFrame, size: int) -> Iterator[list[str]]:
    """The read paths, at most ``size`` at a time. A scan needs its paths on the driver."""
    first = [r.read_path for r in files.select("read_path").limit(size + 1).collect()]
    if len(first) <= size:
        yield from [first] if first else []
        return
    batch: list[str] = []
    for row in files.select("read_path").toLocalIterator():
        batch.append(row.read_path)
        if len(batch) == size:
            yield batch
            batch = []
    if batch:
        yield batch


def _written(rows: DataFrame, label: str) -> DataFrame:
    """Rows of a scan, read at once, so that nothing of its files stays on the driver. Names are those of users: they go by place."""
    with small_files_together(rows.sparkSession):
        return stage(rows.toDF(*(f"c{i}" for i in range(len(rows.columns)))), label).toDF(*rows.columns)


def _literal(path: str) -> str:
    """A path whose special characters are not taken for a glob pattern."""
    return "".join("\\" + ch if ch in "*?[]{}\\" else ch for ch in path)


def _load(spark: SparkSession, ext: str, options: dict[str, str], paths: list[str]) -> DataFrame:
    reader = spark.read
    form = reader_for(ext, options)
    if form != "parquet":  # parquet takes no options
        for name, value in options.items():
            reader = reader.option(name, value)
    where = [_literal(p) for p in paths]
    if form == "csv" and not flag(options, "inferSchema"):
        # all files of a scan have one layout: one file names the columns, and the
        # others are listed once and not once more to look for a header
        return reader.schema(reader.csv(where[0]).schema).csv(where)
    if form == "csv":
        return reader.csv(where)
    if form == "text":
        return reader.text(where)
    if form == "json":
        return reader.json(where)
    return reader.parquet(*where)


def _scan(
    spark: SparkSession, ext: str, options: dict[str, str], paths: list[str], errors: list[tuple[str, str]]
) -> list[DataFrame]:
    """The scan of some files. If Spark refuses it for a file in it, halve until only such files are left out.

    Any other failure, such as a store that cannot be reached, is the caller's: it would
    otherwise turn every file into an error row.
    """
    try:
        with few_listing_tasks(spark):
            return [_load(spark, ext, options, paths)]
    except Exception as exc:
        if not refuses_a_file(exc):
            raise
        if len(paths) == 1:
            errors.append((paths[0], C.error_text(exc)))
            return []
        middle = len(paths) // 2
        return [s for part in (paths[:middle], paths[middle:]) for s in _scan(spark, ext, options, part, errors)]


def _with_lineage(scan: DataFrame, files: DataFrame, group: Row, run_id: str, stamp: Column) -> DataFrame:
    own = scan.columns
    if group.kind == "direct":
        rows = scan.select(*_text(own), metadata_path().alias("__file"))
        path = source = F.col("__file")
    elif group.kind == "mapped":
        # few files are looked up (archive members, unqualified paths); the table
        # is read from disk, so the join strategy follows its true size
        names = _of_group(files, group).select("file_key", F.col("path").alias("__path"), F.col("source_file").alias("__source"))
        rows = (
            scan.select(*_text(own), metadata_path().alias("__file"))
            .join(names, F.col("__file") == F.col("file_key"))
            .drop("file_key", "__file")
        )
        path, source = F.col("__path"), F.col("__source")
    else:
        rows = scan.select(*_text(own))
        path = source = F.lit(group.kind)
    return _decorate(rows, own, path, source, run_id, stamp)


def _text(columns: list[str]) -> list[Column]:
    return [F.col("`" + c.replace("`", "``") + "`").cast("string").alias(c) for c in columns]


def _decorate(rows: DataFrame, own: list[str], path: Column, source: Column, run_id: str, stamp: Column) -> DataFrame:
    decorated = shaping.lineage(
        rows,
        source_file=source,
        path=path,
        batch=batch_id(run_id, path),
        dataset=dataset_name(source),
        ingestion_ts=stamp,
    )
    helpers = [c for c in decorated.columns if c in ("__file", "__path", "__source", "__cells") and c not in own]
    return decorated.drop(*helpers)


# --- json: the types of a file come from all its rows --------------------------


#: Begins the layout of a JSON file that only Spark's own reader can judge; the file's name ends it.
_SPARK_JUDGED = "spark:"


def _json_layouts(catalogue: DataFrame, options: Options, files_per_scan: int) -> DataFrame:
    """JSON files get the types of their disputed keys as layout.

    A column that is whole in one file and fractional in another is read as
    whole text from the first: such files must not share a scan, which would
    infer one type for both. Files that merely lack some keys may share one. Not needed
    where the reader keeps values as text. A file of which the look can parse nothing (other
    encodings, lenient syntax, very large documents) is left to Spark's own reader with the
    caller's options; it is an error only if that finds no valid row either.
    """
    opts = options.get("json") or {}
    if "json" not in options:
        return catalogue
    todo = catalogue.where((F.col("ext") == "json") & F.col("error").isNull() & ~F.col("is_dir"))
    if flag(opts, "primitivesAsString") or todo.isEmpty():
        return catalogue
    spark = catalogue.sparkSession
    parts = []
    for paths in _paths(todo, files_per_scan):
        with few_listing_tasks(spark):
            text = spark.read.option("wholetext", str(flag(opts, "multiLine")).lower()).text([_literal(p) for p in paths])
        looked = text.where(F.trim("value") != "").select(metadata_path().alias("file_key"), F.try_parse_json(F.col("value")).alias("v"))
        each = looked.lateralJoin(spark.tvf.variant_explode_outer(F.col("v").outer()))
        types = each.groupBy("file_key", "key").agg(
            F.schema_of_variant_agg("value").alias("type"), F.count_if(F.col("v").isNotNull()).alias("parsed")
        )
        parts.append(_bounded(types, paths, files_per_scan, "json-types"))
    # digits of a decimal do not matter, all fractions are read as double; a null has no type
    plain = F.regexp_replace("type", r"DECIMAL\(\d+,\d+\)", "DOUBLE")
    keys = stage(shaping.union_all(parts).select("file_key", "key", F.nullif(plain, F.lit("VOID")).alias("type"), "parsed"), "json-keys")
    disputed = keys.groupBy("key").agg(F.min("type").alias("low"), F.max("type").alias("high")).where("low <> high").select(F.coalesce("key", F.lit("")).alias("k"), F.lit(True).alias("split"))
    marked = keys.withColumn("k", F.coalesce("key", F.lit(""))).join(disputed, "k", "left")
    told = F.array_sort(F.collect_list(F.when(F.col("split") & F.col("type").isNotNull(), F.concat_ws(":", "k", "type"))))
    found = marked.groupBy("file_key").agg(F.to_json(told).alias("types"), F.sum("parsed").alias("parsed"))
    is_json = (F.col("ext") == "json") & F.col("error").isNull() & ~F.col("is_dir")
    judged = F.concat(F.lit(_SPARK_JUDGED), "file_key")
    types = F.when(F.col("parsed") == 0, judged).otherwise(F.coalesce("types", F.lit(EMPTY)))
    joined = catalogue.join(found, "file_key", "left")
    seen = stage(
        joined.select(*[c for c in catalogue.columns if c != "layout"], F.when(is_json, types).otherwise(F.col("layout")).alias("layout")),
        "read-catalogue",
    )
    invalid = _invalid_json(seen.where(is_json & F.col("layout").startswith(_SPARK_JUDGED)), opts, files_per_scan)
    if invalid is None:
        return seen
    nothing = F.when(F.col("invalid"), F.lit("no row of the file is valid JSON"))
    error = F.coalesce("error", nothing).alias("error")
    return stage(seen.join(invalid, "file_key", "left").select(*[error if c == "error" else F.col(c) for c in seen.columns]), "read-catalogue")


def _bounded(part: DataFrame, paths: list[str], files_per_scan: int, label: str) -> DataFrame:
    """What a scan says of its files; written if more scans may follow, as the driver keeps the files of a plan."""
    return _written(part, label) if len(paths) == files_per_scan else part


def _invalid_json(files: DataFrame, opts: dict[str, str], files_per_scan: int) -> DataFrame | None:
    """``file_key, invalid`` of the files in which Spark's reader finds rows, but no valid one; None if there are none."""
    spark = files.sparkSession
    corrupt = opts.get("columnNameOfCorruptRecord") or spark.conf.get("spark.sql.columnNameOfCorruptRecord")
    parts = []
    for paths in _paths(files, files_per_scan):
        for scan in _scan(spark, "json", opts, paths, []):
            if corrupt not in scan.columns:
                continue  # every row of these files is valid
            own = [c for c in scan.columns if c != corrupt]
            if own:
                # Spark refuses to look at nothing but the corrupt column
                bad, beside = F.col(f"`{corrupt}`").isNotNull(), F.col("`" + own[0].replace("`", "``") + "`")
                by_file = scan.select(metadata_path().alias("file_key"), bad.alias("bad"), beside.alias("beside")).groupBy("file_key")
                judged = by_file.agg(F.min("bad").alias("invalid"), F.count("beside").alias("beside")).where(F.col("invalid") & (F.col("beside") >= 0))
                parts.append(_bounded(judged.select("file_key", "invalid"), paths, files_per_scan, "json-invalid"))
            else:
                names = spark.createDataFrame([(p,) for p in paths], "read_path string")
                none = files.join(names, "read_path", "left_semi").select("file_key", F.lit(True).alias("invalid"))
                parts.append(_bounded(none, paths, files_per_scan, "json-invalid"))
    return shaping.union_all(parts)


# --- csv with inferSchema: likewise --------------------------------------------

_KINDS = (
    "CASE WHEN {c} IS NULL OR trim({c}) = '' THEN 0"
    " WHEN try_cast({c} AS int) IS NOT NULL AND {c} NOT LIKE '%.%' THEN 1"
    " WHEN try_cast({c} AS bigint) IS NOT NULL AND {c} NOT LIKE '%.%' THEN 2"
    " WHEN {c} RLIKE '^[+-]?[0-9]+$' THEN 4"
    " WHEN try_cast({c} AS double) IS NOT NULL THEN 8"
    " WHEN lower({c}) IN ('true', 'false') THEN 16"
    " WHEN {c} RLIKE '^[0-9]{{4}}-[0-9]{{1,2}}-[0-9]{{1,2}}$' THEN 32"
    " WHEN try_cast({c} AS timestamp) IS NOT NULL THEN 64 ELSE 128 END"
)


def _inferred_csv_layouts(catalogue: DataFrame, options: Options, files_per_scan: int) -> DataFrame:
    """With ``inferSchema``, the kinds of value in each column of a file join its layout.

    Types are inferred per file, so files whose columns hold different kinds of
    value are read by different scans.
    """
    inferring = [
        e for e in ("csv", "txt") if reader_for(e, options.get(e) or {}) == "csv" and flag(options.get(e) or {}, "inferSchema")
    ]
    if not inferring:
        return catalogue
    spark = catalogue.sparkSession
    todo = catalogue.where(
        F.col("ext").isin(*inferring) & F.col("error").isNull() & ~F.col("is_dir") & (F.col("layout") != EMPTY)
    )
    parts = []
    for group in _groups(todo.withColumn("kind", F.lit(""))):
        opts = {**(options.get(group.ext) or {}), "inferSchema": "false"}
        mine = todo.where((F.col("ext") == group.ext) & (F.col("layout") == group.layout))
        for paths in _paths(mine, files_per_scan):
            for scan in _scan(spark, group.ext, opts, paths, []):
                names = ["`" + c.replace("`", "``") + "`" for c in scan.columns]
                bits = [F.bit_or(F.expr(_KINDS.format(c=c))).cast("string") for c in names]
                types = scan.select("*", metadata_path().alias("file_key")).groupBy("file_key").agg(F.concat_ws(",", *bits).alias("types"))
                parts.append(_bounded(types, paths, files_per_scan, "csv-types"))
    if not parts:
        return catalogue
    layout = F.concat_ws("\x1f", "layout", "types")
    joined = catalogue.join(shaping.union_all(parts), "file_key", "left")
    return stage(joined.select(*[c for c in catalogue.columns if c != "layout"], layout.alias("layout")), "read-catalogue")


# --- excel ---------------------------------------------------------------------


def _excel_rows(
    files: DataFrame, group: Row, options: dict[str, str], run_id: str, stamp: Column, store_options: dict | None
) -> DataFrame:
    """Rows of all workbooks with one header. The workbooks stay a distributed table."""
    opts = excel_options(options)
    names: list[str] = json.loads(group.layout)
    skip = 1 if flag(opts, "header") else 0
    width = len(names)

    def rows_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store = Store(store_options)
        for batch in batches:
            for read, path, source in zip(batch["read_path"], batch["path"], batch["source_file"]):
                with store.seekable(read) as raw:
                    yield from _frames(sheet_rows(raw, opts), path, source, skip, width)

    books = spread(_of_group(files, group).select("read_path", "path", "source_file"), "read_path")

    def widest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store = Store(store_options)
        for batch in batches:
            for read in batch["read_path"]:
                with store.seekable(read) as raw:
                    yield pd.DataFrame({"width": [max((len(row) for row in sheet_rows(raw, opts)), default=0)]})

    # rows may go on to the right of the header's last cell: those columns are named by their place
    most = books.mapInPandas(widest, "width int").agg(F.max("width")).first()[0] or 0
    names = [*names, *(f"_c{i}" if f"_c{i}" not in names else f"_c{i}_" for i in range(width, most))]
    width = len(names)
    cells = books.mapInPandas(rows_of, "__path string, __source string, __cells array<string>")
    rows = cells.select(
        *[F.col("__cells")[i].alias(n) for i, n in enumerate(names)], F.col("__path"), F.col("__source")
    )
    return _decorate(rows, names, F.col("__path"), F.col("__source"), run_id, stamp)


def _frames(
    rows: Iterator[list[str | None]], path: str, source: str, skip: int, width: int, size: int = 1000
) -> Iterator[pd.DataFrame]:
    batch: list[list[str | None]] = []
    for i, row in enumerate(rows):
        if i < skip:
            continue
        batch.append((row + [None] * width)[:width])
        if len(batch) == size:
            yield pd.DataFrame({"__path": path, "__source": source, "__cells": batch})
            batch = []
    if batch:
        yield pd.DataFrame({"__path": path, "__source": source, "__cells": batch})


