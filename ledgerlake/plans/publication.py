"""Refreshes as releases: all tables are written, then tested, then published at once.

A release has a folder of its own and tables of its own in the catalog, so nothing of the release in use is touched
while the next one is made. A manifest says which tables make a release; writing it is the publication, and the
newest readable manifest is the release in use. It is created under a number that must be free: of two refreshes
that end together one fails, and one that dies before leaves the old release whole. Names in SQL are views on the
tables of the release in use. They move one by one after the manifest, each at once; ``open_release`` moves them
again, for a session that died in between or one that has another catalog.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Mapping
from dataclasses import asdict, dataclass, field

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ledgerlake.plans.storage import Layout, save

MANIFESTS, RELEASES = "_manifests", "_releases"
# Parameters: releases that are kept, and hours after which the files of a refresh that never ended may go.
KEEP, GRACE_HOURS = 2, 24.0


class PublicationError(RuntimeError):
    """A release that could not be published; the one in use stays in use."""


@dataclass
class Release:
    """Tables by ``layer.name``: their catalog table, path, columns and layout."""

    name: str
    number: int | None = None
    tables: dict[str, dict] = field(default_factory=dict)


def _file(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def _children(spark: SparkSession, folder: str) -> list:
    files, at = _file(spark, folder)
    return list(files.listStatus(at)) if files.exists(at) else []


def _numbers(spark: SparkSession, folder: str) -> list[int]:
    """The numbers of all manifests, the newest first."""
    names = [s.getPath().getName() for s in _children(spark, f"{folder}/{MANIFESTS}")]
    return sorted((int(n.removesuffix(".json")) for n in names if n.removesuffix(".json").isdigit()), reverse=True)


def _read(spark: SparkSession, folder: str, number: int) -> Release | None:
    """A manifest; None for one whose writer died while it wrote."""
    files, at = _file(spark, f"{folder}/{MANIFESTS}/{number:012d}.json")
    stream = files.open(at)
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    try:
        said = json.loads(text)
    except ValueError:
        return None
    return Release(said["name"], number, said["tables"])


def releases(spark: SparkSession, folder: str) -> list[Release]:
    """The published releases of a folder, the one in use first."""
    found = (_read(spark, folder, n) for n in _numbers(spark, folder))
    return [r for r in found if r]


class Draft:
    """A release in the making."""

    def __init__(self, spark: SparkSession, folder: str, prefix: str = "") -> None:
        self.spark, self.folder, self.prefix = spark, folder.rstrip("/"), prefix
        self.release = Release(f"{time.strftime('%Y%m%dt%H%M%S', time.gmtime())}_{uuid.uuid4().hex[:12]}")
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {prefix}releases")

    def write(self, layer: str, name: str, frame: DataFrame, layout: Layout | None = None) -> DataFrame:
        """Write a table into the release and return it as stored, with the columns it was given."""
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.prefix}{layer}")
        path = f"{self.folder}/{RELEASES}/{self.release.name}/{layer}/{name}"
        table = f"{self.prefix}releases.{layer}_{name}_{self.release.name}"
        save(frame, table, path, layout)
        stored = self.spark.table(table)
        self.release.tables[f"{layer}.{name}"] = {
            "table": table, "path": path, "schema": json.loads(stored.schema.json()), "layout": asdict(layout) if layout else None,
        }
        return stored.select(*frame.columns)

    def publish(self) -> Release:
        """Make this the release in use."""
        body = json.dumps({"name": self.release.name, "tables": self.release.tables}).encode()
        number = max(_numbers(self.spark, self.folder), default=0) + 1
        files, at = _file(self.spark, f"{self.folder}/{MANIFESTS}/{number:012d}.json")
        try:
            stream = files.create(at, False)
        except Exception as taken:  # the JVM's own error, by way of the bridge
            raise PublicationError(f"another refresh has published release {number} of {self.folder}") from taken
        try:
            stream.write(bytearray(body))
        finally:
            stream.close()
        self.release.number = number
        _move_names(self.spark, self.release, self.prefix)
        return self.release


def _move_names(spark: SparkSession, release: Release, prefix: str) -> None:
    for name, said in release.tables.items():
        layer, _, short = name.partition(".")
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {prefix}{layer}")
        if spark.catalog.tableExists(f"{prefix}{name}") and spark.catalog.getTable(f"{prefix}{name}").tableType != "VIEW":
            spark.sql(f"DROP TABLE {prefix}{name}")  # from before there were releases
        spark.sql(f"CREATE OR REPLACE VIEW {prefix}{layer}.{short} AS SELECT * FROM {said['table']}")


def open_release(spark: SparkSession, folder: str, prefix: str = "", number: int | None = None) -> Mapping[str, DataFrame]:
    """The tables of the release in use, or of an older one that is kept, by ``layer.name``; names in SQL move to it.

    The session need not be the one that wrote them: what its catalog lacks is entered from the manifest.
    """
    found = next((r for r in releases(spark, folder) if number in (None, r.number)), None)
    if found is None:
        raise PublicationError(f"no release{'' if number is None else f' {number}'} in {folder}")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {prefix}releases")
    for said in found.tables.values():
        if not spark.catalog.tableExists(said["table"]):
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in StructType.fromJson(said["schema"]).fields)
            layout = Layout(**said["layout"]).clauses() if said["layout"] else ""
            spark.sql(f"CREATE TABLE {said['table']} ({columns}) USING parquet {layout} LOCATION '{said['path']}'")
            if layout:
                spark.sql(f"MSCK REPAIR TABLE {said['table']}")
    _move_names(spark, found, prefix)
    return {name: spark.table(said["table"]) for name, said in found.tables.items()}


def retire(spark: SparkSession, folder: str, keep: int = KEEP, grace_hours: float = GRACE_HOURS) -> list[str]:
    """Remove the releases behind the newest ``keep``, and refreshes that never ended and are older than the grace.

    A reader of a removed release fails, so ``keep`` should cover the longest query and ``grace_hours`` the longest
    refresh. Manifests go first: a removal that dies half way leaves no manifest of a broken release. Returns the names
    of the releases removed.
    """
    if keep < 1:
        raise ValueError("the release in use must be kept")
    published = releases(spark, folder)
    for old in published[keep:]:
        files, at = _file(spark, f"{folder}/{MANIFESTS}/{old.number:012d}.json")
        files.delete(at, False)
    kept = {r.name for r in published[:keep]}
    gone = {r.name for r in published[keep:]}
    removed = []
    for status in _children(spark, f"{folder.rstrip('/')}/{RELEASES}"):
        name = status.getPath().getName()
        young = time.time() - status.getModificationTime() / 1000 < grace_hours * 3600
        if name in kept or (name not in gone and young):
            continue
        for layer in _children(spark, status.getPath().toString()):
            for table in _children(spark, layer.getPath().toString()):
                _forget(spark, f"{layer.getPath().getName()}_{table.getPath().getName()}_{name}")
        _file(spark, folder)[0].delete(status.getPath(), True)
        removed.append(name)
    return sorted(removed)


def _forget(spark: SparkSession, table: str) -> None:
    for database in spark.catalog.listDatabases("*releases"):
        try:
            spark.sql(f"DROP TABLE IF EXISTS {database.name}.{table}")
        except PySparkException:  # another session did it
            continue

