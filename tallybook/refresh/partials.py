"""Partials by batch, merged level by level.

A batch of changes adds one small table (a segment). ``fanout`` segments of a level
are merged into one of the next, so a reader unions some ``fanout`` segments a
level, however many batches there were, and a row is rewritten once a level.

Segments are listed by the table's version (``sources.versions``): a merge writes
its segment first and publishes the list without its inputs last, so a reader sees
the inputs or the merged segment, never both and never a part. A merge that dies
leaves an unlisted folder behind and nothing else.

Replays: a batch that is listed on its own is replaced by its replay; one that is
merged already is left as it is. The newest batch is never merged, since it is the
one that a stream may deliver again. Batch numbers may have gaps.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..sources.versions import Conflict, Version, current_version, frame_of, next_number, publish

#: Attempts of a writer that others overtake.
TRIES = 20


@dataclass(frozen=True, order=True)
class Segment:
    lo: int
    hi: int
    level: int
    folder: str


def segments(version: Version | None) -> list[Segment]:
    return sorted(Segment(*s) for s in version.notes["segments"]) if version else []


def _edit(spark: SparkSession, table: str, schema: T.StructType,
          change: Callable[[list[Segment]], list[Segment] | None]) -> Version | None:
    """Publish what ``change`` makes of the listed segments; again, if another writer
    was faster. ``None`` from ``change``: nothing to do."""
    for _ in range(TRIES):
        base = current_version(spark, table)
        after = change(segments(base))
        if after is None:
            return base
        after = sorted(after)
        version = Version(next_number(base), tuple(s.folder for s in after), schema.json(), tuple(schema.fieldNames()),
                          {"segments": [[s.lo, s.hi, s.level, s.folder] for s in after]})
        try:
            return publish(spark, table, version)
        except Conflict:
            continue
    raise Conflict(f"{table}: overtaken {TRIES} times")


def write_partial(partial: DataFrame, table: str, batch: int) -> str:
    """The folder with a batch's partial, written but not listed."""
    folder = f"batch_id={batch}-{uuid.uuid4().hex[:8]}"
    partial.write.parquet(f"{table}/{folder}")
    return folder


def list_batches(spark: SparkSession, table: str, schema: T.StructType, folders: dict[int, str]) -> Version | None:
    """List written partials by batch, in place of earlier deliveries; those merged already stay as they are."""
    def change(listed: list[Segment]) -> list[Segment] | None:
        fresh = {n: f for n, f in folders.items() if not any(s.level and s.lo <= n <= s.hi for s in listed)}
        kept = [s for s in listed if s.level or s.lo not in fresh]
        after = kept + [Segment(n, n, 0, f) for n, f in fresh.items()]
        return None if set(after) == set(listed) else after

    return _edit(spark, table, schema, change)


def add_batch(partial: DataFrame, table: str, batch: int) -> Version | None:
    """Write a batch's partial and list it, in place of an earlier delivery of the batch."""
    spark = partial.sparkSession
    if any(s.level and s.lo <= batch <= s.hi for s in segments(current_version(spark, table))):
        return current_version(spark, table)
    return list_batches(spark, table, partial.schema, {batch: write_partial(partial, table, batch)})


def due(listed: list[Segment], fanout: int) -> list[Segment]:
    """The oldest segments of the lowest level that has ``fanout`` side by side, the
    newest batch not among them; empty if there are none."""
    listed = sorted(listed)[:-1]
    for level in sorted({s.level for s in listed}):
        run: list[Segment] = []
        for s in listed:
            run = [*run, s] if s.level == level else []
            if len(run) == fanout:
                return run
    return []


def compact(spark: SparkSession, table: str, merge: Callable[[DataFrame], DataFrame], fanout: int = 8) -> int:
    """Merge until no level has ``fanout`` segments side by side; how many merges.

    ``merge`` adds up the rows of several partials; it is a Spark job over the
    merged segments alone.
    """
    done = 0
    while (version := current_version(spark, table)) and (run := due(segments(version), fanout)):
        part = Version(version.number, tuple(s.folder for s in run), version.schema, version.columns)
        rows = frame_of(spark, table, part)
        folder = f"level_{run[0].level + 1}-{run[0].lo}-{run[-1].hi}-{uuid.uuid4().hex[:8]}"
        merge(rows).select(*rows.columns).write.parquet(f"{table}/{folder}")
        new = Segment(run[0].lo, run[-1].hi, run[0].level + 1, folder)

        def change(listed: list[Segment], run=run, new=new) -> list[Segment] | None:
            return [s for s in listed if s not in run] + [new] if set(run) <= set(listed) else None

        _edit(spark, table, rows.schema, change)
        done += 1
    return done


def read_partials(spark: SparkSession, table: str, schema: str, version: Version | None = None,
                  more: tuple[str, ...] = ()) -> DataFrame:
    """All rows listed (now, or by ``version``), not added up, and those of the written
    folders ``more``; empty where there are none."""
    version = version or current_version(spark, table)
    folders = (*(version.folders if version else ()), *more)
    empty = spark.createDataFrame([], schema)
    return frame_of(spark, table, Version(0, folders, empty.schema.json(), tuple(empty.columns))) if folders else empty
