"""Replacing parts of a table without a moment in which rows are lost.

New files are written beside the old ones, below a hidden folder of the table. Then an intent
is recorded: which entries of the table go and which come. From then on the replacement counts
as done, and what is left are renames, each of which may be repeated: whoever next writes the
table, or reads it through ``tables.read_table``, finishes them first. Before the intent
stands, the table is the old one.

    <table>/_swap/<id>/new/...     entries to come (files, or folders of a partition)
    <table>/_swap/<id>/intent      JSON: entries that go, entries that come
    <table>/_swap/<id>/old/...     entries on their way out

Spark does not look into folders whose names start with an underscore. A plain reader that
lists the table during the renames may see less than the whole table, never an entry twice.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable

from pyspark.sql import SparkSession

SWAPS = "_swap"


def hadoop_path(spark: SparkSession, path: str):
    """The Hadoop file system of a path, and the path."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()), jvm_path


class Folder:
    """File operations on one folder through Hadoop's file system."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self._fs, self._path = hadoop_path(spark, path)
        self._jvm = spark._jvm

    def at(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(self._path, name)

    def exists(self, name: str) -> bool:
        return bool(self._fs.exists(self.at(name)))

    def children(self, name: str = ".") -> list[str]:
        """Names below a folder of the table; hidden ones are not part of it."""
        path = self._path if name == "." else self.at(name)
        if not self._fs.exists(path):
            return []
        names = [s.getPath().getName() for s in self._fs.listStatus(path)]
        return [n for n in names if not n.startswith(("_", "."))]

    def move(self, source: str, target: str) -> None:
        """Rename, unless it was done before, here or by someone who finishes the same swap."""
        came, to = self.at(source), self.at(target)
        if self._fs.exists(to) or not self._fs.exists(came):
            return
        self._fs.mkdirs(to.getParent())
        try:
            moved = self._fs.rename(came, to)
        except Exception:
            moved = False
        if not moved and self._fs.exists(came):
            raise OSError(f"could not rename {came} to {to}")

    def delete(self, name: str) -> None:
        self._fs.delete(self.at(name), True)

    def drop(self, swap: str) -> None:
        self.delete(f"{SWAPS}/{swap}")
        if not self.swaps():
            self.delete(SWAPS)

    def write_text(self, name: str, text: str) -> None:
        """A small file that appears when it is whole."""
        part = self.at(f"{name}.part")
        out = self._fs.create(part, True)
        out.write(bytearray(text.encode()))
        out.close()
        if not self._fs.rename(part, self.at(name)):
            raise OSError(f"could not record {self.at(name)}")

    def read_text(self, name: str) -> str:
        stream = self._fs.open(self.at(name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def swaps(self) -> list[str]:
        if not self._fs.exists(self.at(SWAPS)):
            return []
        found = sorted(self._fs.listStatus(self.at(SWAPS)), key=lambda s: (s.getModificationTime(), s.getPath().getName()))
        return [s.getPath().getName() for s in found]


def settle(spark: SparkSession, table: str, clean: bool = False) -> None:
    """Finish replacements whose intent was recorded. ``clean`` also drops those that never came that far.

    Readers must not clean: what they see without an intent may belong to a writer at work.
    """
    folder = Folder(spark, table)
    for swap in folder.swaps():
        if folder.exists(f"{SWAPS}/{swap}/intent"):
            _finish(folder, swap)
        elif clean:
            folder.drop(swap)


def _finish(folder: Folder, swap: str) -> None:
    at = f"{SWAPS}/{swap}"
    intent = json.loads(folder.read_text(f"{at}/intent"))
    comes = set(intent["comes"])
    for name in intent["goes"]:
        # an entry of the same name that has come already is a new one
        if name not in comes or folder.exists(f"{at}/new/{name}"):
            folder.move(name, f"{at}/old/{name}")
    for name in intent["comes"]:
        folder.move(f"{at}/new/{name}", name)
    folder.delete(f"{at}/intent")
    folder.drop(swap)


def replace(
    spark: SparkSession,
    table: str,
    write: Callable[[str], None],
    goes: Callable[[list[str]], Iterable[str]],
    entries: Callable[[Folder, str], list[str]] = Folder.children,
) -> list[str]:
    """Write new entries with ``write(folder)`` and swap them for those that ``goes(new names)`` names. Returns the new names.

    ``entries`` tells which names below the written folder come: its children by default.
    Names that go and do not exist are left out. If ``goes`` refuses, the table stays as it is.
    """
    settle(spark, table, clean=True)
    folder, swap = Folder(spark, table), uuid.uuid4().hex
    at = f"{SWAPS}/{swap}"
    write(f"{table}/{at}/new")
    comes = sorted(entries(folder, f"{at}/new"))
    try:
        leaving = sorted({name for name in goes(comes) if folder.exists(name)})
    except BaseException:
        folder.drop(swap)
        raise
    folder.write_text(f"{at}/intent", json.dumps({"goes": leaving, "comes": comes}))
    _finish(folder, swap)
    return comes
