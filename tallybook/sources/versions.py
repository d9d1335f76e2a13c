"""Tables by version: written beside the current one, seen once all is there.

A table's folder holds a data folder per version and ``_versions``, a small JSON
file per published version. A writer writes its data folder first and publishes
last, by renaming the finished JSON file to its number; a reader takes the
greatest number there is. So a reader sees a whole version or the one before,
whenever a writer fails, and an open frame of an older version stays readable
until ``drop_old_versions``. A number is given once: of two writers that start
from the same version, the later one to publish fails and its data stays unseen.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark.errors import PySparkRuntimeError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_DIGITS = 12


@dataclass(frozen=True)
class Version:
    number: int
    #: Names of the data folders, below the table's.
    folders: tuple[str, ...]
    schema: str
    columns: tuple[str, ...] = ()
    #: Whatever the writer wants to know again: versions of its inputs, covered batches.
    notes: dict = field(default_factory=dict)


class Conflict(PySparkRuntimeError):
    """Another writer has published the version first."""


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm.org.apache.hadoop.fs.Path


def published(spark: SparkSession, table: str) -> list[int]:
    """The numbers of the versions there are."""
    fs, at, _ = _fs(spark, f"{table}/_versions")
    if not fs.exists(at):
        return []
    names = [f.getPath().getName() for f in fs.listStatus(at)]
    return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())


def current_version(spark: SparkSession, table: str, number: int | None = None) -> Version | None:
    """The version ``number``, by default the latest; ``None`` if nothing is published."""
    known = published(spark, table)
    if not known or (number is not None and number not in known):
        return None
    fs, at, path = _fs(spark, f"{table}/_versions/{known[-1] if number is None else number:0{_DIGITS}d}.json")
    stream = fs.open(at)
    try:
        said = json.loads(bytes(stream.readAllBytes()).decode())
    finally:
        stream.close()
    return Version(said["number"], tuple(said["folders"]), said["schema"], tuple(said["columns"]), said["notes"])


def publish(spark: SparkSession, table: str, version: Version) -> Version:
    """Make a version whose data folders are complete the current one."""
    fs, final, path = _fs(spark, f"{table}/_versions/{version.number:0{_DIGITS}d}.json")
    started = path(f"{table}/_versions/.{uuid.uuid4().hex}")
    said = {"number": version.number, "folders": list(version.folders), "schema": version.schema,
            "columns": list(version.columns), "notes": version.notes}
    out = fs.create(started, False)
    try:
        out.write(json.dumps(said).encode())
    finally:
        out.close()
    if fs.exists(final) or not fs.rename(started, final):
        fs.delete(started, False)
        raise Conflict(f"{table}: version {version.number} is already published")
    return version


def next_number(version: Version | None) -> int:
    return 0 if version is None else version.number + 1


def new_folder(number: int) -> str:
    return f"v{number:0{_DIGITS}d}-{uuid.uuid4().hex[:8]}"


def content_of(df: DataFrame) -> str:
    """Number of rows and sum of their hashes: equal for equal rows in any order."""
    got = df.agg(F.count(F.lit(1)), F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)"))).first()
    return f"{got[0]}:{got[1]}"


def save_version(df: DataFrame, table: str, partition_by: list[str] | None = None, notes: dict | None = None,
                 onto: Version | None | str = "current", unless_same: bool = False) -> Version:
    """Write ``df`` as the next version of ``table`` and publish it.

    ``unless_same``: a version that would hold the rows of the current one is not
    published (what is made from the table then needs no rebuild), and its data goes.

    ``onto`` is the version that the data was made from (``None``: there was none):
    publishing fails with ``Conflict`` if another one came in between. By default it
    is the one that is current now.
    """
    spark = df.sparkSession
    base = current_version(spark, table) if onto == "current" else onto
    number = next_number(base)
    folder = new_folder(number)
    w = df.write
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(f"{table}/{folder}")
    version = Version(number, (folder,), df.schema.json(), tuple(df.columns), dict(notes or {}))
    if unless_same:
        version.notes["content"] = content_of(frame_of(spark, table, version))
        if base is not None and base.schema == version.schema and base.notes.get("content") == version.notes["content"]:
            fs, _, path = _fs(spark, table)
            fs.delete(path(f"{table}/{folder}"), True)
            return base
    return publish(spark, table, version)


def read_version(spark: SparkSession, table: str, number: int | None = None) -> DataFrame | None:
    """The table as of a version, by default the latest; ``None`` if there is none."""
    version = current_version(spark, table, number)
    return None if version is None else frame_of(spark, table, version)


def frame_of(spark: SparkSession, table: str, version: Version) -> DataFrame:
    """All rows of a version, its folders read by one scan."""
    schema = T.StructType.fromJson(json.loads(version.schema))
    if not version.folders:
        return spark.createDataFrame([], schema).select(*version.columns)
    return spark.read.schema(schema).parquet(*(f"{table}/{f}" for f in version.folders)).select(*version.columns)


def drop_old_versions(spark: SparkSession, table: str, keep: int = 2) -> list[str]:
    """Delete the data that none of the last ``keep`` versions uses, and older pointers.

    For a time when no reader holds an older version and no writer is at work: data
    that is not published yet counts as unused.
    """
    known = published(spark, table)
    kept = known[-keep:]
    used = {f for n in kept for f in current_version(spark, table, n).folders}
    fs, top, path = _fs(spark, table)
    gone = []
    for f in fs.listStatus(top) if kept else ():
        name = f.getPath().getName()
        if f.isDirectory() and not name.startswith(("_", ".")) and name not in used:
            fs.delete(f.getPath(), True)
            gone.append(name)
    for n in known[:-keep]:
        fs.delete(path(f"{table}/_versions/{n:0{_DIGITS}d}.json"), False)
    return gone
