"""Table manifests: which immutable commit folder holds each month of a table.

``{table}/_manifests/v000000000007.json`` is version 7 of the table: for every
month its commit, rows, schema and the metrics gathered by its write. Data files
are written once, below ``{table}/data_version=M/commit=<id>/``, and never moved.
A version is published by one create-if-absent of its file, complete when it
appears; readers take the highest version, so they see the table before or
after a publish and nothing between. Of two publishers of the same version one
wins; the other starts again from the new version, and gives up when its own
month was changed meanwhile.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Callable
from dataclasses import asdict, dataclass, field, replace

from pyspark.sql import SparkSession
from pyspark.sql import types as T

FOLDER = "_manifests"


class TableNotFound(LookupError):
    """No version of the table has been published."""


class PublishConflict(RuntimeError):
    """Another publisher changed the same month first."""


@dataclass(frozen=True)
class Month:
    """One published month: its commit folder, rows and write metrics.

    A month built from arrivals has ``parts`` instead of one commit: for every
    batch or bucket its folder below the month, its rows and further counts.
    """

    commit: str
    rows: int
    schema: str
    levels: tuple[str, ...] = ()
    metrics: dict = field(default_factory=dict)
    parts: dict[str, list] = field(default_factory=dict)


@dataclass(frozen=True)
class Manifest:
    version: int = 0
    months: dict[str, Month] = field(default_factory=dict)
    last_schema: str = ""  # of the latest month written, which may be dropped by now

    def schema(self) -> T.StructType:
        """Columns of all months by name, in order of their first appearance."""
        fields: dict[str, T.StructField] = {}
        for schema in [e.schema for _, e in sorted(self.months.items())] or [self.last_schema]:
            for f in T.StructType.fromJson(json.loads(schema)).fields:
                if fields.setdefault(f.name, f).dataType != f.dataType:
                    raise TypeError(f"column {f.name} is {fields[f.name].dataType.simpleString()} and {f.dataType.simpleString()} in different months")
        return T.StructType(list(fields.values()))


class Folder:
    """A path on the file system Spark uses for it (local, HDFS, object store)."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm = spark._jvm
        self.path = self.jvm.org.apache.hadoop.fs.Path(path)
        self.conf = spark._jsparkSession.sessionState().newHadoopConf()
        self.fs = self.path.getFileSystem(self.conf)

    def below(self, name: str) -> "Folder":
        """A path below this one, on the same file system object."""
        out = Folder.__new__(Folder)
        out.jvm, out.conf, out.fs = self.jvm, self.conf, self.fs
        out.path = self.jvm.org.apache.hadoop.fs.Path(self.path, name)
        return out

    def exists(self) -> bool:
        return self.fs.exists(self.path)

    def delete(self) -> bool:
        return self.fs.delete(self.path, True)

    def names(self) -> list[str]:
        """Names directly below; none when the folder is missing."""
        if not self.exists():
            return []
        return [s.getPath().getName() for s in self.fs.listStatus(self.path)]

    def move_to(self, other: "Folder") -> None:
        self.fs.mkdirs(other.path.getParent())
        if not self.fs.rename(self.path, other.path):
            raise OSError(f"could not move {self.path} to {other.path}")

    def read_text(self) -> str:
        stream = self.fs.open(self.path)
        try:
            return bytes(stream.readAllBytes()).decode("utf-8")
        finally:
            stream.close()

    def write_text(self, text: str) -> None:
        stream = self.fs.create(self.path, False)
        try:
            stream.write(bytearray(text.encode("utf-8")))
        finally:
            stream.close()

    def create_whole(self, text: str) -> bool:
        """The file with this text, unless it exists: it appears complete, and one of two callers gets False."""
        draft = self.below(f"../.draft-{uuid.uuid4().hex}")
        draft.write_text(text)
        try:
            if self.fs.getUri().getScheme() == "file":  # a hard link is atomic here, a checked rename is not
                try:
                    os.link(draft.path.toUri().getPath(), self.path.toUri().getPath())
                except FileExistsError:
                    return False
                return True
            context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.fs.getUri(), self.conf)
            try:
                context.rename(draft.path, self.path, _no_overwrite(self.jvm))
            except Exception as exc:  # noqa: BLE001 - the JVM's own type, told by its name
                if "FileAlreadyExists" in str(exc):
                    return False
                raise
            return True
        finally:
            draft.delete()


def _no_overwrite(jvm):
    from pyspark import SparkContext

    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    options = SparkContext._gateway.new_array(rename, 1)
    options[0] = rename.NONE
    return options


def _version_name(version: int) -> str:
    return f"v{version:012d}.json"


def read_manifest(spark: SparkSession, table: str) -> Manifest:
    """The latest published version; version 0 without months for a table that has none."""
    folder = Folder(spark, f"{table}/{FOLDER}")
    names = [n for n in folder.names() if n.startswith("v") and n.endswith(".json")]
    if not names:
        return Manifest()
    body = json.loads(folder.below(max(names)).read_text())
    months = {m: Month(**{**e, "levels": tuple(e["levels"])}) for m, e in body["months"].items()}
    return Manifest(int(body["version"]), months, body["last_schema"])


def commit(spark: SparkSession, table: str, base: Manifest, changes: dict[str, Month | None],
           attempts: int = 50, meanwhile: Callable[[], None] = lambda: None) -> Manifest:
    """Publish ``changes`` (month to its new entry, None to drop it) on top of the latest version.

    ``base`` is the version the caller worked from: a month that somebody else
    changed since then is a :class:`PublishConflict`, other months are kept as
    they are now. ``meanwhile`` runs between reading and writing (tests).
    """
    for _ in range(attempts):
        now = read_manifest(spark, table)
        for month in changes:
            if now.months.get(month) != base.months.get(month):
                raise PublishConflict(f"{month} of {table} was changed by another publisher")
        months = {m: e for m, e in {**now.months, **changes}.items() if e is not None}
        schema = next((e.schema for e in changes.values() if e is not None), now.last_schema)
        new = replace(now, version=now.version + 1, months=months, last_schema=schema)
        meanwhile()
        body = json.dumps({"version": new.version, "last_schema": schema, "months": {m: asdict(e) for m, e in sorted(months.items())}}, default=str)
        if Folder(spark, f"{table}/{FOLDER}/{_version_name(new.version)}").create_whole(body):
            return new
    raise PublishConflict(f"{table}: no version could be published in {attempts} attempts")
