"""Tables and workbooks that change all at once: a manifest names the folders that hold the present state.

New data goes to folders that nobody reads yet. Then one small file, ``_manifest/<version>.json``, names the folder
of every entry; it is written under another name and renamed, and that rename is the commit. Readers go by the
newest manifest, so they see all of a version or none of it, and a run that fails half way leaves the last version
as it was. Folders that a version does not replace keep their place, and so do their files.
"""

import json
import re
import uuid
from collections.abc import Callable, Iterable, Mapping
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from dealreports.sinks.reports import folder_name

FOLDER = "_manifest"


class Conflict(RuntimeError):
    """Somebody else committed the version first."""


class State(NamedTuple):
    """A version: where each entry lies, and what its writer noted."""

    version: int
    entries: dict[str, str]
    notes: dict


EMPTY = State(0, {}, {})


class Files:
    """The few things done with single files, on whatever file system the path belongs to."""

    def __init__(self, spark: SparkSession, root: str):
        self._hadoop = spark._jvm.org.apache.hadoop
        self._path = self._hadoop.fs.Path
        self._fs = self._path(root).getFileSystem(spark._jsc.hadoopConfiguration())

    def listed(self, folder: str) -> list[tuple[str, int, int]]:
        """Name, length and time of change of everything in a folder; nothing if there is no such folder."""
        if not self._fs.exists(self._path(folder)):
            return []
        return sorted((s.getPath().getName(), s.getLen(), s.getModificationTime()) for s in self._fs.listStatus(self._path(folder)))

    def read(self, path: str) -> str:
        stream = self._fs.open(self._path(path))
        try:
            return self._hadoop.io.IOUtils.readFullyToByteArray(stream).decode("utf-8")
        finally:
            stream.close()

    def write(self, path: str, text: str) -> None:
        stream = self._fs.create(self._path(path), True)
        try:
            stream.write(text.encode("utf-8"))
        finally:
            stream.close()

    def rename(self, old: str, new: str) -> bool:
        return not self._fs.exists(self._path(new)) and self._fs.rename(self._path(old), self._path(new))

    def remove(self, path: str) -> None:
        self._fs.delete(self._path(path), True)


def _manifest(root: str, version: int) -> str:
    return f"{root.rstrip('/')}/{FOLDER}/{version:012d}.json"


def versions(spark: SparkSession, root: str) -> list[int]:
    names = [name for name, _, _ in Files(spark, root).listed(f"{root.rstrip('/')}/{FOLDER}")]
    return sorted(int(n[:12]) for n in names if re.fullmatch(r"\d{12}\.json", n))


def state(spark: SparkSession, root: str, version: int | None = None) -> State:
    """The newest version, or the one asked for; version 0, without entries, where nothing was committed."""
    known = versions(spark, root)
    if version is None:
        version = known[-1] if known else 0
    if version == 0:
        return EMPTY
    if version not in known:
        raise ValueError(f"{root} has no version {version}")
    found = json.loads(Files(spark, root).read(_manifest(root, version)))
    return State(version, found["entries"], found["notes"])


def staged() -> str:
    """The name of a folder that nobody reads yet."""
    return f"data-{uuid.uuid4().hex}"


def commit(spark: SparkSession, root: str, before: State, entries: Mapping[str, str], notes: Mapping | None = None) -> State:
    """Makes ``entries`` (name: folder below ``root``) the version after ``before``."""
    files, version = Files(spark, root), before.version + 1
    written = f"{root.rstrip('/')}/{FOLDER}/.{uuid.uuid4().hex}"
    files.write(written, json.dumps({"entries": dict(entries), "notes": dict(notes or {})}, sort_keys=True))
    if not files.rename(written, _manifest(root, version)):
        files.remove(written)
        raise Conflict(f"{root} has a version {version} already")
    return State(version, dict(entries), dict(notes or {}))


def read(spark: SparkSession, root: str, schema: T.StructType, names: Iterable[str] | None = None, version: int | None = None) -> DataFrame:
    """The rows of the entries (all, or those named) of one version."""
    entries = state(spark, root, version).entries
    chosen = entries if names is None else {n: entries[n] for n in names if n in entries}
    paths = [f"{root.rstrip('/')}/{folder}" for folder in chosen.values()]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def expire(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Removes all but the newest ``keep`` versions, and the folders that none of those names; gives their names.

    Not while a writer or a reader of an older version is at work.
    """
    known, files, top = versions(spark, root), Files(spark, root), root.rstrip("/")
    if not known:
        return []
    kept = {folder.split("/")[0] for v in known[-keep:] for folder in state(spark, root, v).entries.values()}
    gone = [n for n, _, _ in files.listed(top) if n.startswith("data-") and n not in kept]
    for version in known[:-keep]:
        files.remove(_manifest(root, version))
    for name in gone:
        files.remove(f"{top}/{name}")
    return gone


# --- workbooks ----------------------------------------------------------------------------------


def workbook_root(root: str, workbook: str) -> str:
    return f"{root.rstrip('/')}/workbook={folder_name(workbook)}"


def publish(spark: SparkSession, root: str, workbook: str, write: Callable[[str], Mapping[str, str]], keep: bool = False) -> State:
    """Runs a report writer in a folder of its own and makes the sheets it gives the workbook, all at once.

    ``write`` takes a root and gives the path of each sheet below it, as the writers of ``plans.workbooks`` do.
    With ``keep`` sheets of the last version that it does not give stay.
    """
    top = workbook_root(root, workbook)
    before, folder = state(spark, top), staged()
    paths = write(f"{top}/{folder}")
    outside = [p for p in paths.values() if not p.startswith(f"{top}/{folder}/")]
    if outside:
        raise ValueError(f"{outside[0]} is not below the folder of the run")
    entries = {title: path[len(top) + 1 :] for title, path in paths.items()}
    return commit(spark, top, before, (before.entries if keep else {}) | entries, {"workbook": workbook})


def sheets(spark: SparkSession, root: str, workbook: str) -> dict[str, str]:
    """The path of each sheet of the workbook as it is now."""
    top = workbook_root(root, workbook)
    return {title: f"{top}/{folder}" for title, folder in state(spark, top).entries.items()}
