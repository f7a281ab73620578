"""Bytes into the landing zones, from tasks: original, uncompressed, quarantine."""

from __future__ import annotations

import gzip
import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, types as T

from .. import contracts as C
from ..sources.deal import by_bytes
from ..sources.faults import StoreUnreachable, tried
from ..sources.store import CHUNK, GZIP_MAGIC, Store


def with_content_hash(files: DataFrame, store_options: dict | None = None) -> DataFrame:
    """Adds ``hash`` (SHA-256 of the bytes) and ``hash_error``.

    Files are read in chunks, so their size does not matter; each is one row of work, and
    tasks get equal shares of the bytes. A store that cannot be reached fails the job.
    """
    schema = T.StructType(list(files.schema)).add("hash", "string").add("hash_error", "string")

    def digest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store = Store(store_options)
        for batch in batches:
            found = []
            for path in batch["path"]:
                try:
                    found.append((tried(lambda: content_hash(store, path)), None))
                except StoreUnreachable:
                    raise
                except Exception as exc:
                    found.append((None, C.error_text(exc)))
            yield pd.concat(
                [batch, pd.DataFrame(found, columns=["hash", "hash_error"], index=batch.index)], axis=1
            )

    return by_bytes(files).mapInPandas(digest, schema)


def content_hash(store: Store, path: str) -> str:
    h = hashlib.sha256()
    for chunk in store.chunks(path):
        h.update(chunk)
    return h.hexdigest()


_COPIED = (
    "relative_path string, hash string, s3_key string, remote_size bigint, remote_mtime bigint, "
    "source string, target string, status string, stage string, message string"
)


def copy_files(files: DataFrame, landing_uri: str, prefix: str, store_options: dict | None = None) -> DataFrame:
    """Copy each file to ``original``; content that really is gzip also goes to ``uncompressed``.

    A file that fails goes to ``quarantine`` and its row says why. Targets are
    written whole or not at all, so a task may run twice.
    """
    root, prefix = landing_uri.rstrip("/"), prefix.strip("/")

    def zone(name: str, relative: str) -> str:
        return f"{root}/{prefix}/{name}/{relative}"

    def copy_one(store: Store, path: str, relative: str) -> None:
        store.write(zone(C.ZONE_ORIGINAL, relative), store.chunks(path))
        if _is_gzip(store, path):
            plain = relative[:-3] if relative.lower().endswith(".gz") else relative
            with store.seekable(path) as raw, gzip.GzipFile(fileobj=raw) as content:
                store.write(zone(C.ZONE_UNCOMPRESSED, plain), iter(lambda: content.read(CHUNK), b""))

    def copy(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store = Store(store_options)
        for batch in batches:
            out = []
            for row in batch.itertuples(index=False):
                key = f"{prefix}/{C.ZONE_ORIGINAL}/{row.relative_path}"
                facts = (row.relative_path, row.hash, key, row.remote_size, row.remote_mtime, row.path)
                try:
                    if row.hash_error is not None:
                        raise OSError(row.hash_error)
                    tried(lambda: copy_one(store, row.path, row.relative_path))
                    out.append((*facts, f"{root}/{key}", C.PROCESADO, C.STEP_LOAD, ""))
                except StoreUnreachable:
                    raise
                except Exception as exc:
                    _quarantine(store, row.path, zone(C.ZONE_QUARANTINE, row.relative_path))
                    out.append((*facts, "", C.ERROR_CARGA, C.STEP_LOAD, C.error_text(exc)))
            yield pd.DataFrame(out, columns=[f.split()[0] for f in _COPIED.split(", ")])

    return by_bytes(files).mapInPandas(copy, _COPIED)


def _is_gzip(store: Store, path: str) -> bool:
    with store.seekable(path) as raw:
        if raw.read(2) != GZIP_MAGIC:
            return False
        raw.seek(0)
        try:
            gzip.GzipFile(fileobj=raw).read(1)
        except Exception:
            return False
    return True


def _quarantine(store: Store, path: str, target: str) -> None:
    try:
        store.write(target, store.chunks(path))
    except Exception:
        pass  # a file that cannot even be read has nothing to keep; its row already says so
