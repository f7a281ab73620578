"""Zip archives: members are listed, then unpacked one member per row of work."""

from __future__ import annotations

import hashlib
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from .. import contracts as C
from ..functions import file_type
from ..session import stage
from .store import CHUNK, Store, spread

_MEMBERS = "source_file string, member string, error string"
_UNPACKED = "source_file string, path string, read_path string, error string"


def zip_members(zips: DataFrame, store_options: dict | None = None) -> DataFrame:
    """``source_file, member, error``: the files in each zip at ``path``, from its directory alone."""

    def members(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store = Store(store_options)
        for batch in batches:
            for path in batch["path"]:
                try:
                    with store.seekable(path) as raw, zipfile.ZipFile(raw) as archive:
                        found = [(path, m.filename, None) for m in archive.infolist() if not m.is_dir()]
                except Exception as exc:
                    found = [(path, None, C.error_text(exc))]
                yield pd.DataFrame(found, columns=["source_file", "member", "error"])

    return spread(zips.select("path"), "path").mapInPandas(members, _MEMBERS)


def unpack(zips: DataFrame, target: str, run_id: str, store_options: dict | None = None) -> tuple[DataFrame, DataFrame]:
    """Readable members written under ``target``, and the archives that failed.

    Returns ``source_file, path (zip::member), read_path`` and ``path, message``.
    Members are spread over tasks, so a huge archive is unpacked in parallel. An
    archive with an unreadable member fails as a whole; one with no readable
    file type in it fails too.
    """
    listed = stage(zip_members(zips, store_options), "zip-members")
    readable = listed.where(F.col("error").isNull() & (file_type("member") != "unknown"))

    def extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store = Store(store_options)
        for batch in batches:
            rows = []
            for source, member in zip(batch["source_file"], batch["member"]):
                trace = f"{source}::{member}"
                name = hashlib.md5(f"{run_id}\x1f{trace}".encode()).hexdigest()
                out = f"{target.rstrip('/')}/{run_id}/{name}_{member.rsplit('/', 1)[-1]}"
                try:
                    with store.seekable(source) as raw, zipfile.ZipFile(raw) as archive:
                        with archive.open(member) as content:
                            store.write(out, iter(lambda: content.read(CHUNK), b""))
                    rows.append((source, trace, out, None))
                except Exception as exc:
                    rows.append((source, trace, None, C.error_text(exc)))
            yield pd.DataFrame(rows, columns=["source_file", "path", "read_path", "error"])

    unpacked = stage(spread(readable, "source_file", "member").mapInPandas(extract, _UNPACKED), "zip-unpacked")
    broken = (
        listed.select("source_file", "error")
        .unionByName(unpacked.select("source_file", "error"))
        .where(F.col("error").isNotNull())
        .groupBy("source_file")
        .agg(F.min("error").alias("message"))
    )
    before, after = C.MSG_EMPTY_ZIP.split("{path}")
    empty = (
        zips.select(F.col("path").alias("source_file"))
        .join(readable.select("source_file").distinct(), "source_file", "left_anti")
        .join(broken, "source_file", "left_anti")
        .withColumn("message", F.concat(F.lit(before), F.col("source_file"), F.lit(after)))
    )
    failed = broken.unionByName(empty).select(F.col("source_file").alias("path"), "message")
    good = unpacked.where(F.col("error").isNull()).join(broken, "source_file", "left_anti")
    return good.select("source_file", "path", "read_path"), failed
