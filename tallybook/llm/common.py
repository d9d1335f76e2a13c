"""Helpers shared by the text operators: typed input, Arrow maps, stage tables."""

from __future__ import annotations

import ctypes
import hashlib
import os
import shutil
import sys
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybook.session import ensure_checkpoint_dir
from tallybook.sources.tables import drop_table

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per context, so that they
    can import it wherever the driver itself found it."""
    sc = spark.sparkContext
    if not getattr(sc, "_tallybook_shipped", False):
        top = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
        made = shutil.make_archive(os.path.join(tempfile.mkdtemp(), "tallybook"), "zip", top, "tallybook")
        sc.addPyFile(made)
        sc._tallybook_shipped = True


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def numbered(docs: DataFrame) -> DataFrame:
    """``docs`` with its columns called __c0, __c1, ...: no names clash, in any case."""
    ship_package(docs.sparkSession)
    return docs.toDF(*(f"__c{k}" for k in range(len(docs.columns))))


def column(docs: DataFrame, name: str) -> str:
    """The numbered name of the first column called exactly ``name``, or else the
    first that differs in case only."""
    names = docs.columns
    lower = [n.lower() for n in names]
    return f"__c{names.index(name) if name in names else lower.index(name.lower())}"


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Just (doc_id long, text string): further columns never reach an operator."""
    return numbered(docs).select(F.col(column(docs, id_col)).cast("long").alias("doc_id"),
                                 F.col(column(docs, text_col)).cast("string").alias("text"))


def keep_rows(docs: DataFrame, judge: Callable[[], Callable[..., bool]], cols: list[str]) -> DataFrame:
    """The rows, with all columns, that the predicate keeps: ``judge()`` makes it
    once a task, and it gets the values of ``cols``. One pass, no shuffle."""
    at = [int(column(docs, c)[3:]) for c in cols]
    plain = numbered(docs)

    def run(batches):
        keep = judge()
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                part = batch.slice(k, 256)
                yield part.filter(pa.array([keep(*v) for v in zip(*(part.column(i).to_pylist() for i in at))], pa.bool_()))

    return plain.mapInArrow(tidy(run), plain.schema).toDF(*docs.columns)


def map_texts(docs: DataFrame, row: Callable[[str], tuple], fields: list[tuple[str, pa.DataType]],
              ddl: str, slice_rows: int = 256) -> DataFrame:
    """doc_id and ``row(text)`` for every document of (doc_id, text); null text: ''.

    One pass, no shuffle. ``slice_rows`` bounds the strings held at a time.
    """
    schema = pa.schema([("doc_id", pa.int64()), *fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, slice_rows):
                part = batch.slice(at, slice_rows)
                rows = [row(t if t is not None else "") for t in part.column(1).to_pylist()]
                cols = list(zip(*rows)) if rows else [()] * len(fields)
                arrays = [part.column(0)] + [pa.array(c, type=t) for c, (_, t) in zip(cols, fields)]
                yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    return docs.mapInArrow(tidy(run), f"doc_id long, {ddl}")


#: What this worker process keeps from task to task: (whose, by which parameters, object).
_HELD: list[tuple] = []


def held(whose: str, key, make: Callable[[], object]):
    """An object that the tasks of one operator share in a worker process. It goes when
    another operator's tasks, or those with other parameters, come to the process: a
    worker never holds the memory of two."""
    if not _HELD or _HELD[0][0] != whose or _HELD[0][1] != key:
        _HELD.clear()
        _HELD.append((whose, key, make()))
    return _HELD[0][2]


def let_go() -> None:
    """Free what earlier tasks of other operators have left in this worker process."""
    _HELD.clear()


def slices(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """The batches in pieces of ``rows`` rows: what a task makes of a piece is all it holds."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def tidy(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``run`` for ``mapInArrow``, after which the worker process, which waits for its next
    task with what it has, gives freed memory back to the system."""
    def tidied(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            if sys.platform == "linux":
                getattr(ctypes.CDLL(None), "malloc_trim", lambda _: 0)(0)  # of the GNU C library

    return tidied


def sha(text: str | bytes) -> str:
    return hashlib.sha256(text.encode() if isinstance(text, str) else text).hexdigest()


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared checkpoint folder and read it again.

    Cuts lineage for good: a lost executor costs no recomputation before it. The
    shuffle files of the write are let go at once, nothing reads them again.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(CLEANUP)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    out._staged = path
    return out


def release(*frames: DataFrame) -> None:
    """Delete what ``stage`` has written for these frames. For tables that nothing reads any
    more, also no task that may run again: all that was made from them is written."""
    for df in frames:
        path = getattr(df, "_staged", None)
        if path:
            drop_table(df.sparkSession, path)
