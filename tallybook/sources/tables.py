"""Table persistence: snapshots, materialized views, live views, drops.

PostgreSQL tables and views map onto Spark as follows: a derived snapshot or
materialized view is a Parquet table by version, rebuilt explicitly and seen
when it is whole; a live view is a temp view over a lazy plan, recomputed on every
read. Written tables go below the shared folder of the cluster
(``spark.checkpoint.dir``) unless a path is given.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import shared_path
from .adapter import Ledger
from .loader import OK, parse_records
from .schemas import LEDGER_SCHEMAS
from .versions import frame_of, read_version, save_version


def read_tables(spark: SparkSession, names: list[str], fmt: str = "parquet",
                location: str | None = None, options: dict | None = None,
                partitioning: dict[str, dict] | None = None) -> dict[str, DataFrame]:
    """Read named ledger tables from files (``location/name``) or a database.

    For ``fmt="jdbc"`` each table is read in parallel slices: pass, per table,
    ``partitionColumn``, ``lowerBound``, ``upperBound`` and ``numPartitions``
    in ``partitioning``; without them JDBC reads a table in one task.
    """
    out = {}
    for name in names:
        r = spark.read.format(fmt).options(**(options or {}))
        if fmt == "jdbc":
            r = r.option("dbtable", name).options(**(partitioning or {}).get(name, {}))
            out[name] = r.load()
        else:
            out[name] = _open(spark, f"{location.rstrip('/')}/{name}", fmt, options)
    return out


def _open(spark: SparkSession, path: str, fmt: str, options: dict | None = None) -> DataFrame:
    """A table of files, or the current version of a table by version."""
    versioned = read_version(spark, path) if fmt == "parquet" else None
    return spark.read.format(fmt).options(**(options or {})).load(path) if versioned is None else versioned


def save_table(df: DataFrame, path: str, mode: str = "overwrite", fmt: str = "parquet",
               partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` and return a frame that reads the written files."""
    w = df.write.mode(mode).format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)
    # with the schema given, a table without rows reads back as well
    return df.sparkSession.read.format(fmt).schema(df.schema).load(path).select(*df.columns)


def materialize(df: DataFrame, name: str, path: str | None = None,
                partition_by: list[str] | None = None) -> DataFrame:
    """CREATE MATERIALIZED VIEW / CREATE TABLE AS: snapshot ``df`` and register it.

    The snapshot is the next version of the table at ``path`` (``sources.versions``): readers
    see it when it is whole, and a build that fails leaves the one before. Writing also
    cuts the lineage: readers no longer replay the source plan, and a lost executor
    re-reads files instead of recomputing the stage.
    """
    spark = df.sparkSession
    target = path or shared_path(spark, "tables", name)
    out = frame_of(spark, target, save_version(df, target, partition_by))
    out.createOrReplaceTempView(name)
    return out


def create_or_replace_view(df: DataFrame, name: str) -> DataFrame:
    """CREATE OR REPLACE VIEW: a live view, re-evaluated on each read."""
    df.createOrReplaceTempView(name)
    return df


def insert_into(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """INSERT INTO .. SELECT: append rows to an existing table path."""
    df.write.mode("append").format(fmt).save(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    """True when ``path`` exists on its filesystem (local, HDFS, object store)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def create_table_if_not_exists(spark: SparkSession, path: str, schema: T.StructType,
                               fmt: str = "parquet") -> DataFrame:
    """CREATE TABLE IF NOT EXISTS: an empty table with ``schema`` unless one is there."""
    if not path_exists(spark, path):
        spark.createDataFrame([], schema).write.format(fmt).save(path)
    return spark.read.format(fmt).schema(schema).load(path)


def drop_table(spark: SparkSession, path: str) -> None:
    """DROP TABLE IF EXISTS for a path table (silent when absent).

    Spark has no CASCADE for dependents; callers rebuild dependents in order.
    """
    if path_exists(spark, path):
        jvm = spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def _stored(spark: SparkSession, location: str, name: str, fmt: str) -> DataFrame:
    df = _open(spark, f"{location.rstrip('/')}/{name}", fmt)
    missing = [f.name for f in LEDGER_SCHEMAS[name].fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"{name}: missing columns {missing}")
    return df


def read_ledger(spark: SparkSession, location: str, fmt: str = "parquet") -> Ledger:
    """Open stored ledger tables ``location/{sales,purchases,payments,loans}``.

    Columns are selected by name (S1, table scan): extra columns are ignored, a
    missing one is an error. Where a column has another type than the ledger's,
    rows whose value does not fit are left out; ``read_ledger_rejects`` lists
    them. Nothing is read until a query runs; filters and column pruning still
    reach the scan.
    """
    frames = {}
    for name, schema in LEDGER_SCHEMAS.items():
        df = _stored(spark, location, name, fmt).select(*schema.fieldNames())
        if df.dtypes != [(f.name, f.dataType.simpleString()) for f in schema.fields]:
            df = parse_records(df, schema).filter(F.col("_status") == OK).select(*schema.fieldNames())
        frames[name] = df
    return Ledger(**frames)


def read_ledger_rejects(spark: SparkSession, location: str, fmt: str = "parquet") -> DataFrame:
    """(table_name, reason, record) of the stored rows that ``read_ledger`` leaves out."""
    out = None
    for name, schema in LEDGER_SCHEMAS.items():
        rows = parse_records(_stored(spark, location, name, fmt), schema).filter(F.col("_status") != OK).select(
            F.lit(name).alias("table_name"), F.col("_reason").alias("reason"), F.col("_record").alias("record"))
        out = rows if out is None else out.unionByName(rows)
    return out
