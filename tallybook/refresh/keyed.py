"""Keyed incremental loads: last writer wins, by record key and load number.

A load writes only its own records, as one more folder of the table, with the load's
number; nothing already there is rewritten. Of each key the record of the greatest
load number counts (within a load the greatest ``_seq``, then the greatest record, so
that the choice never depends on the order of arrival). A deletion (``_op`` = ``D``) is
a record too: a later number brings the key back, an earlier one that arrives late
does not. So loads may arrive in any order and more than once.

Rejected records, also those without a key, stay with their load: a load that is
delivered again replaces its own records and rejects.

``fold`` replaces the folders by one with the winners and all rejects; loads that
are folded may still be delivered again, which then changes nothing unless the
records differ.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.loader import OK, REJECTED, parse_records
from ..sources.schemas import LEDGER_SCHEMAS
from ..sources.versions import Conflict, Version, current_version, frame_of, next_number, publish
from .partials import TRIES

LOAD, SEQ, OP, DELETED = "_load", "_seq", "_op", "_deleted"
NO_KEY = "no_key"


def typed_load(raw: DataFrame, schema: T.StructType, load: int | Column, key: str = "id") -> DataFrame:
    """The load's records typed, with their load, place, deletion mark, status and reason."""
    mark = F.coalesce(F.upper(F.trim(F.col(OP))) == "D", F.lit(False)) if OP in raw.columns else F.lit(False)
    place = F.coalesce(F.col(SEQ).try_cast("long"), F.lit(0)) if SEQ in raw.columns else F.lit(0)
    number = F.lit(load) if isinstance(load, int) else load
    with_marks = raw.withColumns({"__load": number.cast("long"), "__seq": place.cast("long"), "__deleted": mark})
    kept = T.StructType([*schema.fields, T.StructField("__load", T.LongType()), T.StructField("__seq", T.LongType()),
                         T.StructField("__deleted", T.BooleanType())])
    parsed = parse_records(with_marks.drop(*(c for c in (OP, SEQ) if c in raw.columns)), kept)
    lacks = (F.col("_status") == OK) & F.col(key).isNull()
    return parsed.select(
        *schema.fieldNames(), F.col("__load").alias(LOAD), F.col("__seq").alias(SEQ), F.col("__deleted").alias(DELETED),
        F.when(lacks, F.lit(REJECTED)).otherwise(F.col("_status")).alias("_status"),
        F.when(lacks, F.lit(NO_KEY)).otherwise(F.col("_reason")).alias("_reason"),
        F.when(lacks, F.to_json(F.struct(*schema.fieldNames()))).otherwise(F.col("_record")).alias("_record"))


def _record(columns: list[str]) -> Column:
    """A record as one value that orders by load, place, deletion and content."""
    return F.struct(LOAD, SEQ, DELETED, *columns)


def winners(records: DataFrame, key: str = "id") -> DataFrame:
    """The counting record of each key, deletions among them.

    One aggregate keyed by record: a key with very many records is reduced on the
    map side, and no window sorts it."""
    columns = [c for c in records.columns if c not in ("_status", "_reason", "_record", LOAD, SEQ, DELETED)]
    ok = records.filter(F.col("_status") == OK) if "_status" in records.columns else records
    return ok.groupBy(F.col(key).alias("__key")).agg(F.max(_record(columns)).alias("r")).select(
        *(F.col(f"r.{c}").alias(c) for c in [*columns, LOAD, SEQ, DELETED]))


def live(records: DataFrame, key: str = "id") -> DataFrame:
    """The rows of the table as it stands."""
    return winners(records, key).filter(~F.col(DELETED)).drop(LOAD, SEQ, DELETED)


def settled(records: DataFrame, key: str = "id") -> DataFrame:
    """``winners`` and, each once a load, the rejects of typed records, in one pass over them: the
    winners of status ``ok`` with their record, the rejects with their load, reason and record.

    One aggregate, grouped by key or by reject, so that the records are made and
    shuffled once and rejects without a key are spread."""
    columns = [c for c in records.columns if c not in ("_status", "_reason", "_record", LOAD, SEQ, DELETED)]
    ok = F.col("_status") == OK
    reject = F.when(F.col("_status") == REJECTED, F.struct(LOAD, "_reason", "_record"))
    groups = records.groupBy(F.when(ok, F.col(key)).alias("__key"), reject.alias("__reject")).agg(
        F.max(F.when(ok, _record(columns))).alias("r"))
    return groups.select(
        *(F.col(f"r.{c}").alias(c) for c in columns), F.coalesce(f"r.{LOAD}", f"__reject.{LOAD}").alias(LOAD),
        *(F.col(f"r.{c}").alias(c) for c in (SEQ, DELETED)),
        F.when(F.col("__reject").isNull(), F.lit(OK)).otherwise(F.lit(REJECTED)).alias("_status"),
        F.col("__reject._reason").alias("_reason"), F.col("__reject._record").alias("_record"))


def load_changes(others: DataFrame, load: DataFrame, earlier: DataFrame | None = None, key: str = "id") -> DataFrame:
    """What a load changes, as ledger rows with ``w``: -1 for a row that no longer
    stands, +1 for one that stands now. Records of unchanged keys yield nothing, and
    so does a load that comes again or too late.

    ``others``: the records that are there; ``earlier``: those of an earlier delivery of the
    load, which this one replaces (not among ``others``).
    """
    columns = [c for c in others.columns if c not in ("_status", "_reason", "_record", LOAD, SEQ, DELETED)]

    def tagged(df: DataFrame, was: bool, now: bool) -> DataFrame:
        return df.filter(F.col("_status") == OK).select(*columns, LOAD, SEQ, DELETED, F.lit(was).alias("__was"), F.lit(now).alias("__now"))

    new = tagged(load, False, True)
    if earlier is not None:
        new = new.unionByName(tagged(earlier, True, False))
    touched = new.select(F.col(key).alias("__touched")).distinct()
    rest = tagged(others, True, True).join(touched, F.col(key) == F.col("__touched"), "left_semi")
    both = rest.unionByName(new).groupBy(F.col(key).alias("__key")).agg(
        F.max(F.when(F.col("__was"), _record(columns))).alias("old"), F.max(F.when(F.col("__now"), _record(columns))).alias("now"))
    stood = F.col("old").isNotNull() & ~F.col(f"old.{DELETED}")
    stands = F.col("now").isNotNull() & ~F.col(f"now.{DELETED}")
    same = F.lit(True)
    for c in columns:
        same = same & F.col(f"old.{c}").eqNullSafe(F.col(f"now.{c}"))
    unchanged = stood & stands & same
    sides = F.array(F.when(stood & ~unchanged, F.struct(F.lit(-1).cast("long").alias("w"), F.col("old").alias("r"))),
                    F.when(stands & ~unchanged, F.struct(F.lit(1).cast("long").alias("w"), F.col("now").alias("r"))))
    return (both.select(F.explode(F.filter(sides, lambda x: x.isNotNull())).alias("x"))
            .select(*(F.col(f"x.r.{c}").alias(c) for c in columns), F.col("x.w").alias("w")))


# --- stored tables ------------------------------------------------------------

def stored_records(spark: SparkSession, table: str, version: Version | None = None) -> DataFrame | None:
    """All stored records of a table, rejects among them; ``None`` if there is no load yet."""
    version = version or current_version(spark, table)
    return None if version is None else frame_of(spark, table, version)


def write_load(raw: DataFrame, table: str, name: str, load: int, key: str = "id") -> tuple[str, DataFrame]:
    """The folder with the load's typed records and rejects, written but not listed, and its frame."""
    typed = typed_load(raw, LEDGER_SCHEMAS[name], load, key)
    folder = f"load={load}-{uuid.uuid4().hex[:8]}"
    typed.write.parquet(f"{table}/{folder}")
    return folder, raw.sparkSession.read.schema(typed.schema).parquet(f"{table}/{folder}").select(*typed.columns)


def with_load(base: Version | None, load: int, folder: str, records: DataFrame) -> Version:
    """The version after ``base`` that lists the load, in place of an earlier delivery of it."""
    loads = dict(base.notes["loads"]) if base else {}
    folders = [f for f in (base.folders if base else ()) if f != loads.get(str(load))]
    loads[str(load)] = folder
    return Version(next_number(base), (*folders, folder), records.schema.json(), tuple(records.columns), {"loads": loads})


def add_load(raw: DataFrame, table: str, name: str, load: int, key: str = "id") -> Version:
    """Load records of ledger table ``name`` into the stored ``table``."""
    spark = raw.sparkSession
    folder, records = write_load(raw, table, name, load, key)
    for _ in range(TRIES):
        try:
            return publish(spark, table, with_load(current_version(spark, table), load, folder, records))
        except Conflict:
            continue
    raise Conflict(f"{table}: overtaken {TRIES} times")


def fold(spark: SparkSession, table: str, key: str = "id") -> Version | None:
    """One folder of the winners and the rejects in place of the folders that are listed
    now. A load that arrives meanwhile stays listed beside it."""
    base = current_version(spark, table)
    if base is None or len(base.folders) < 2:
        return base
    records = frame_of(spark, table, base)
    rejected = records.filter(F.col("_status") == REJECTED)
    won = winners(records, key).select("*", F.lit(OK).alias("_status"), F.lit(None).cast("string").alias("_reason"),
                                       F.lit(None).cast("string").alias("_record"))
    folder = f"folded-{uuid.uuid4().hex[:8]}"
    won.select(*base.columns).unionByName(rejected).write.parquet(f"{table}/{folder}")
    for _ in range(TRIES):
        now = current_version(spark, table)
        if not set(base.folders) <= set(now.folders):  # a folded load was delivered anew: leave it all
            return now
        loads = {k: f for k, f in now.notes["loads"].items() if f not in base.folders}
        try:
            return publish(spark, table, Version(next_number(now), (folder, *(f for f in now.folders if f not in base.folders)),
                                                 now.schema, now.columns, {"loads": loads}))
        except Conflict:
            continue
    raise Conflict(f"{table}: overtaken {TRIES} times")


def read_live(spark: SparkSession, table: str, name: str, key: str = "id") -> DataFrame:
    """The stored ledger table as it stands; empty before the first load."""
    records = stored_records(spark, table)
    return spark.createDataFrame([], LEDGER_SCHEMAS[name]) if records is None else live(records, key)


def rejects(records: DataFrame, name: str) -> DataFrame:
    """(table_name, load, reason, record) of the rejected records, a record once a load."""
    return records.filter(F.col("_status") == REJECTED).select(
        F.lit(name).alias("table_name"), F.col(LOAD).alias("load"), F.col("_reason").alias("reason"),
        F.col("_record").alias("record")).distinct()


def read_rejects(spark: SparkSession, table: str, name: str) -> DataFrame:
    """The rejects of a stored table."""
    records = stored_records(spark, table)
    none = "table_name string, load long, reason string, record string"
    return spark.createDataFrame([], none) if records is None else rejects(records, name)
