"""Loading raw ledger records: typed tables plus a rejects table.

The reference replays a SQL dump statement by statement and skips any
statement that fails, so one bad record never aborts the load. Here each raw
record is parsed against the ledger schema. A record that has not as many
fields as its table, a field that does not parse, or one whose value would
change under the cast (cents cut off, a time of day dropped) goes to the
rejects with the reason; the rest load. It is a single pass over the input:
typed rows and rejects are written together, split by a partition column.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .schemas import LEDGER_SCHEMAS
from .versions import frame_of, save_version

OK, REJECTED = "ok", "rejected"
#: The reason of a record with too few or too many fields.
FIELD_COUNT = "field_count"
_CORRUPT = "_corrupt_record"


def _changed(src: Column, val: Column, kind: T.DataType) -> Column:
    """Whether a value that parsed is no longer the one that was given. The whole value is
    parsed only where it may be another: a number spelled unlike the one kept, a date with
    something after its day."""
    text = src.cast("string")
    if isinstance(kind, T.DecimalType):
        exact = src.try_cast("decimal(38,18)") != val.cast("decimal(38,18)")
        return (text != val.cast("string")) & F.coalesce(exact, F.lit(False))
    if isinstance(kind, T.DateType):
        exact = src.try_cast("timestamp_ntz") != val.cast("timestamp_ntz")
        return (text.contains(" ") | text.contains("T")) & F.coalesce(exact, F.lit(False))
    return F.lit(False)


def parse_records(raw: DataFrame, schema: T.StructType) -> DataFrame:
    """Typed columns of ``schema`` plus ``_status``, ``_reason`` and ``_record``.

    Missing columns load as NULL; a column that has its type already is taken
    as it is. ``_record`` (the raw line, or else the raw row as JSON) is kept
    only for rejects.

    In steps: each field is parsed once, and what follows reads the parsed value. As one
    expression a wide table's code is beyond what the JVM compiles (8000 bytes a method).
    """
    have = {f.name: f.dataType for f in raw.schema.fields}
    parsed, typed, failed = {}, [], []
    for f in schema.fields:
        if f.name not in have:
            typed.append(F.lit(None).cast(f.dataType).alias(f.name))
        elif have[f.name] == f.dataType:
            typed.append(F.col(f.name))
        else:
            src, val = F.col(f.name), F.col(f"__parsed_{f.name}")
            parsed[f"__parsed_{f.name}"] = src.try_cast(f.dataType)
            typed.append(val.alias(f.name))
            wrong = src.isNotNull() & (val.isNull() | _changed(src, val, f.dataType))
            failed.append(F.when(wrong, F.lit(f.name)))
    reason = F.concat_ws(",", *failed) if failed else F.lit("")
    record = F.to_json(F.struct(*[F.col(c) for c in raw.columns if c != _CORRUPT]))
    if _CORRUPT in have:
        reason = F.when(F.col(_CORRUPT).isNotNull(), F.lit(FIELD_COUNT)).otherwise(reason)
        record = F.coalesce(F.col(_CORRUPT), record)
    bad = F.col("__reason") != ""
    return raw.withColumns(parsed).withColumn("__reason", reason).select(
        *typed,
        F.when(bad, F.lit(REJECTED)).otherwise(F.lit(OK)).alias("_status"),
        F.when(bad, F.col("__reason")).alias("_reason"),
        # serialised only for rejected rows (CASE evaluates lazily)
        F.when(bad, record).alias("_record"),
    )


def _text_schema(columns: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in [*columns, _CORRUPT]])


def records_from_lines(lines: DataFrame, columns: list[str], sep: str = ",") -> DataFrame:
    """Raw records of a column of delimited lines; a line with another number of
    fields keeps its text in ``_corrupt_record``."""
    ddl = ", ".join(f"`{f.name}` string" for f in _text_schema(columns).fields)
    options = {"sep": sep, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}
    return lines.select(F.from_csv(F.col(lines.columns[0]), ddl, options).alias("r")).select("r.*")


def read_raw(spark: SparkSession, src: DataFrame | str, fmt: str, options: dict) -> DataFrame:
    """Raw records of a frame or a path; of CSV as text, lines with another number of fields kept whole."""
    if isinstance(src, DataFrame):
        return src
    if fmt != "csv":
        return spark.read.format(fmt).options(**options).load(src)
    options = {"header": True, **options}
    # The header names the columns; only it is read here, for no type is inferred.
    columns = spark.read.options(**options).csv(src).columns
    if not columns:
        return spark.createDataFrame([], _text_schema([]))
    return (spark.read.options(**options).option("mode", "PERMISSIVE").option("columnPruning", False)
            .option("columnNameOfCorruptRecord", _CORRUPT).schema(_text_schema(columns)).csv(src))


def load_ledger(spark: SparkSession, sources: dict[str, DataFrame | str],
                target_dir: str | None = None, fmt: str = "csv", mode: str = "overwrite",
                options: dict | None = None, versioned: bool = False) -> tuple[dict[str, DataFrame], DataFrame]:
    """Full refresh of the raw ledger tables.

    ``sources`` maps table name to a DataFrame or a path. Absent tables are
    skipped silently. With ``target_dir`` every table is written once (typed
    rows and rejects in one pass, partitioned by status) and read back, so the
    returned frames no longer depend on the raw input. ``versioned``: as the next
    version of the table (``sources.versions``), unless its records are those of the
    last one; readers of that one never see a half-written table. Returns the typed
    tables and one rejects frame ``(table_name, reason, record)``.
    """
    options = options or {}
    tables: dict[str, DataFrame] = {}
    rejects: list[DataFrame] = []
    for name, schema in LEDGER_SCHEMAS.items():
        if name not in sources:
            continue
        parsed = parse_records(read_raw(spark, sources[name], fmt, options), schema)
        if target_dir:
            path = os.path.join(target_dir, name)
            if versioned:
                parsed = frame_of(spark, path, save_version(parsed, path, ["_status"], unless_same=True))
            else:
                parsed.write.mode(mode).partitionBy("_status").parquet(path)
                # the schema is known: a table without rows leaves no file to read it from
                parsed = spark.read.schema(parsed.schema).parquet(path)
        tables[name] = parsed.filter(F.col("_status") == OK).select(*schema.fieldNames())
        rejects.append(parsed.filter(F.col("_status") == REJECTED).select(
            F.lit(name).alias("table_name"), F.col("_reason").alias("reason"),
            F.col("_record").alias("record")))
    if rejects:
        rej = rejects[0]
        for r in rejects[1:]:
            rej = rej.unionByName(r)
    else:
        rej = spark.createDataFrame([], "table_name string, reason string, record string")
    return tables, rej


def as_text(df: DataFrame) -> DataFrame:
    """Every column as a string: what a text dump or a CSV file delivers."""
    return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])


def load_summary(spark: SparkSession, sources: dict[str, DataFrame]) -> DataFrame:
    """Per table: loaded rows, rejected rows and the loaded money total.

    One pass per table; a check that the parse kept every value.
    """
    money = {"sales": F.col("quantity") * F.col("price"),
             "purchases": F.col("quantity") * F.col("amount"),
             "payments": F.col("amount"), "loans": F.col("value")}
    rows = None
    for name, schema in LEDGER_SCHEMAS.items():
        if name not in sources:
            continue
        p = parse_records(sources[name], schema).select(
            F.lit(name).alias("table_name"), "_status",
            money[name].cast("decimal(38,2)").alias("money"))
        rows = p if rows is None else rows.unionByName(p)
    ok = F.col("_status") == OK
    # one aggregate over all tables: partial counts per partition, one shuffle
    return rows.groupBy("table_name").agg(
        F.sum(F.when(ok, 1).otherwise(0)).cast("long").alias("loaded_rows"),
        F.sum(F.when(~ok, 1).otherwise(0)).cast("long").alias("rejected_rows"),
        F.sum(F.when(ok, F.col("money"))).cast("decimal(38,2)").alias("loaded_total"),
    )


def reject_summary(sources: dict[str, DataFrame]) -> DataFrame:
    """Records per table and reason of rejection; the reason of loaded ones is ``ok``."""
    rows = None
    for name, schema in LEDGER_SCHEMAS.items():
        if name in sources:
            p = parse_records(sources[name], schema).select(
                F.lit(name).alias("table_name"), F.coalesce("_reason", F.lit(OK)).alias("reason"))
            rows = p if rows is None else rows.unionByName(p)
    return rows.groupBy("table_name", "reason").agg(F.count(F.lit(1)).alias("n_records"))
