"""A cheap look at each file before it is read: can it be opened, and which layout has it?

Files of one layout can share one Spark scan. The look reads the first lines
of a text file, the footer of a parquet file, the first row of a workbook.
"""

from __future__ import annotations

import csv
import io
import json
from collections.abc import Iterator

import pandas as pd
import pyarrow.parquet as pq
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, types as T

from .. import contracts as C
from .excel import excel_options, header_names, sheet_rows
from .faults import StoreUnreachable, tried
from .store import Store, spread

EMPTY = "empty"  # a text file without a single line: no rows, and no error
_TRUE = {"true", "1", "yes"}


def flag(options: dict[str, str], name: str, default: str = "false") -> bool:
    return str(options.get(name, default)).strip().lower() in _TRUE


def reader_for(ext: str, options: dict[str, str]) -> str:
    """The Spark reader a file type goes through: txt with a delimiter is read as csv."""
    return ("csv" if options.get("delimiter") else "text") if ext == "txt" else ext


def _option(options: dict[str, str], *names: str, default: str | None = None) -> str | None:
    lower = {k.lower(): v for k, v in options.items()}
    return next((lower[n] for n in names if lower.get(n)), default)


def _first_record(stream: io.BufferedIOBase, options: dict[str, str]) -> str | None:
    """First line that is neither blank nor a comment; more lines while a quoted field stays open."""
    encoding = _option(options, "encoding", "charset", default="utf-8")
    comment = _option(options, "comment")
    quote = _option(options, "quote", default='"')
    several = flag(options, "multiLine")
    text = io.TextIOWrapper(stream, encoding=encoding, errors="replace", newline=None)
    record = ""
    for line in text:
        if not record and (not line.strip() or (comment and line.startswith(comment))):
            continue
        record += line
        if not several or record.count(quote) % 2 == 0:
            break
    return record.rstrip("\r\n") or None


def _csv_layout(store: Store, path: str, options: dict[str, str]) -> str:
    with store.plain(path) as stream:
        record = _first_record(stream, options)
    if record is None:
        return EMPTY
    if flag(options, "header"):
        return record
    sep = _option(options, "delimiter", "sep", default=",")
    if len(sep) != 1:
        return str(record.count(sep) + 1)
    quote = _option(options, "quote", default='"')
    return str(len(next(csv.reader([record], delimiter=sep, quotechar=quote))))


def _parquet_layout(store: Store, path: str) -> str:
    fs, inner = store.at(path)
    info = fs.get_file_info(inner)
    if info.type == pafs.FileType.Directory:
        parts = fs.get_file_info(pafs.FileSelector(inner, recursive=True))
        named = [f.path for f in parts if f.type == pafs.FileType.File and not f.base_name.startswith(("_", "."))]
        if not named:
            raise FileNotFoundError(f"no data files in {path}")
        inner = sorted(named)[0]
    schema = pq.read_schema(inner, filesystem=fs)
    return json.dumps([(f.name, str(f.type)) for f in schema])


def _excel_layout(store: Store, path: str, options: dict[str, str]) -> str:
    if path.lower().endswith(".xls"):
        raise ValueError("binary .xls workbooks are not supported; save as .xlsx")
    with store.seekable(path) as raw:
        first = next(sheet_rows(raw, options), None)
    return EMPTY if first is None else json.dumps(header_names(first, flag(options, "header")))


def _opens(store: Store, path: str) -> None:
    with store.plain(path) as stream:
        stream.read(1)


def _look(store: Store, path: str, ext: str, options: dict[str, dict[str, str]]) -> tuple[str, bool]:
    """Layout of a file, and whether it is a folder."""
    info = store.info(path)
    if info.type == pafs.FileType.NotFound:
        raise FileNotFoundError(f"[PATH_NOT_FOUND] {path}")
    is_dir = info.type == pafs.FileType.Directory
    opts = options.get(ext) or {}
    reader = reader_for(ext, opts)
    if reader == "parquet":
        return _parquet_layout(store, path), is_dir
    if is_dir:
        return "", is_dir
    if reader == "excel":
        return _excel_layout(store, path, excel_options(opts)), is_dir
    if reader == "csv":
        return _csv_layout(store, path, opts), is_dir
    _opens(store, path)
    return "", is_dir


def probe(targets: DataFrame, options: dict[str, dict[str, str]], store_options: dict | None = None) -> DataFrame:
    """The targets (``read_path, ext`` and any other text columns) with ``layout, is_dir, error``.

    An error is a fact about the file: it is missing, refused or unreadable. A store that
    cannot be reached in a few tries fails the job.
    """
    probed = T.StructType(list(targets.schema)).add("layout", "string").add("is_dir", "boolean").add("error", "string")

    def look(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store = Store(store_options)
        for batch in batches:
            rows = []
            for path, ext in zip(batch["read_path"], batch["ext"]):
                try:
                    rows.append((*tried(lambda: _look(store, path, ext, options)), None))
                except StoreUnreachable:
                    raise
                except Exception as exc:  # a missing, refused or unreadable file is a result row
                    rows.append((None, False, C.error_text(exc)))
            found = pd.DataFrame(rows, columns=["layout", "is_dir", "error"], index=batch.index)
            yield pd.concat([batch, found], axis=1)

    return spread(targets, "read_path").mapInPandas(look, probed)
