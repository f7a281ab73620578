"""Opening files inside tasks, through Arrow file systems.

Spark's own readers do all row reading. This is only for what they cannot do:
copy bytes, hash a file of any size, look at its first lines, seek in a zip.
"""

from __future__ import annotations

import bz2
import gzip
import io
import uuid
from collections.abc import Iterator

from pyarrow import fs as pafs

CHUNK = 1024 * 1024
GZIP_MAGIC = b"\x1f\x8b"
_ALIAS = {"s3a": "s3", "s3n": "s3"}
_BUCKETED = {"s3", "gs", "gcs"}


def split_uri(uri: str) -> tuple[str, str, str]:
    """scheme, authority, path; a bare path has scheme ''."""
    head, colon, rest = uri.partition(":")
    if not colon or "/" in head:
        return "", "", uri
    if rest.startswith("//"):
        authority, _, path = rest[2:].partition("/")
        return head, authority, "/" + path
    return head, "", rest


class Store:
    """One file system per scheme and authority, opened once per task.

    ``options`` are passed to the Arrow file system (region, endpoint and so on).
    Credentials come from the executor's environment unless given there.
    """

    def __init__(self, options: dict | None = None) -> None:
        self._options = dict(options or {})
        self._open: dict[tuple[str, str], pafs.FileSystem] = {}

    def at(self, uri: str) -> tuple[pafs.FileSystem, str]:
        scheme, authority, path = split_uri(uri)
        scheme = _ALIAS.get(scheme, scheme)
        key = (scheme, authority)
        if key not in self._open:
            if scheme in ("", "file"):
                self._open[key] = pafs.LocalFileSystem()
            elif scheme == "s3":
                self._open[key] = pafs.S3FileSystem(**self._options)
            else:
                self._open[key] = pafs.FileSystem.from_uri(f"{scheme}://{authority}")[0]
        return self._open[key], (authority + path if scheme in _BUCKETED else path)

    def info(self, uri: str) -> pafs.FileInfo:
        fs, path = self.at(uri)
        return fs.get_file_info(path)

    def chunks(self, uri: str) -> Iterator[bytes]:
        fs, path = self.at(uri)
        with fs.open_input_stream(path, compression=None) as src:
            while chunk := src.read(CHUNK):
                yield chunk

    def seekable(self, uri: str):
        fs, path = self.at(uri)
        return fs.open_input_file(path)

    def write(self, uri: str, chunks: Iterator[bytes]) -> None:
        """Write whole or not at all, so that a re-run task never leaves half a file."""
        fs, path = self.at(uri)
        if not isinstance(fs, (pafs.LocalFileSystem, pafs.HadoopFileSystem)):
            with fs.open_output_stream(path, compression=None) as out:  # appears on close
                for chunk in chunks:
                    out.write(chunk)
            return
        fs.create_dir(path.rsplit("/", 1)[0], recursive=True)
        part = f"{path}.{uuid.uuid4().hex}.part"
        try:
            with fs.open_output_stream(part, compression=None) as out:
                for chunk in chunks:
                    out.write(chunk)
            fs.move(part, path)
        except BaseException:
            if fs.get_file_info(part).type != pafs.FileType.NotFound:
                fs.delete_file(part)
            raise

    def plain(self, uri: str) -> io.BufferedIOBase:
        """The file's bytes as its readers see them, decompressed by suffix."""
        lower = uri.lower()
        raw = self.seekable(uri)
        if lower.endswith((".gz", ".gzip")):
            return gzip.GzipFile(fileobj=raw)
        if lower.endswith(".bz2"):
            return bz2.BZ2File(raw)
        return raw


def spread(df, *keys: str):
    """One row is one file's worth of work, so rows are spread by number and not packed by size."""
    spark = df.sparkSession
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return df.repartition(tasks, *keys)
