"""Statements kept up to date by keyed loads, without reading the ledger again.

Below one folder: ``raw/<table>``, the keyed loads of each ledger table; ``states/<table>``,
per applied load the state that its changes add (``operators.changes``), merged level
by level. A load is compared with the records of its own keys, turned into weighted rows and
reduced; the statements are made from the states alone.

Publishing the version that lists a load's records is the one step that counts: the
version names the folder of its state, written before. The state is listed among the
others afterwards, by this or any later writer, and read from the version's note until
then. So a load that dies is either not there or there as a whole, and states add up to
what stands, in whatever order loads came, and however often.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.changes import STATES, merged, postings_from, state_of
from ..operators.postings import PIPELINE, RuleSet
from ..operators.statements import DASHBOARD_END_YEAR, dashboard, yearly_summaries
from ..sources.adapter import Ledger
from ..sources.versions import Conflict, Version, current_version, frame_of, publish, published
from .keyed import fold, load_changes, read_live, with_load, write_load
from .partials import TRIES, compact, list_batches, read_partials, segments, write_partial


def apply_load(raw: DataFrame, folder: str, name: str, load: int, rules: RuleSet = PIPELINE) -> Version:
    """Load records of ledger table ``name`` and add what they change to its state."""
    spark = raw.sparkSession
    table, states = f"{folder}/raw/{name}", f"{folder}/states/{name}"
    written, records = write_load(raw, table, name, load)
    for _ in range(TRIES):
        base = current_version(spark, table)
        version = with_load(base, load, written, records)
        before = base.folders if base else ()
        kept = [f for f in before if f in version.folders]
        gone = [f for f in before if f not in version.folders]

        def stored(folders: list[str]) -> DataFrame:
            return frame_of(spark, table, Version(version.number, tuple(folders), version.schema, version.columns))

        changes = load_changes(stored(kept), records, stored(gone) if gone else None)
        version.notes["state"] = write_partial(state_of(name, changes, rules), f"{folder}/states/{name}", version.number)
        try:
            publish(spark, table, version)
        except Conflict:  # another load came first: compare again with what stands now
            continue
        list_states(spark, folder, name)
        return version
    raise Conflict(f"{table}: overtaken {TRIES} times")


def _unlisted(spark: SparkSession, folder: str, name: str, listed: Version | None) -> dict[int, str]:
    """Published states beyond those of ``listed``, which are listed in order."""
    last = max((s.hi for s in segments(listed)), default=-1)
    table, out = f"{folder}/raw/{name}", {}
    for n in published(spark, table):
        if n > last and (state := current_version(spark, table, n).notes.get("state")):
            out[n] = state
    return out


def list_states(spark: SparkSession, folder: str, name: str) -> None:
    """List the published states that are not listed yet."""
    if pending := _unlisted(spark, folder, name, current_version(spark, f"{folder}/states/{name}")):
        schema = spark.createDataFrame([], STATES[name]).schema
        list_batches(spark, f"{folder}/states/{name}", schema, pending)


def current_states(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """Each table's state as of the loads that are published."""
    out = {}
    for name, ddl in STATES.items():
        table = f"{folder}/states/{name}"
        listed = current_version(spark, table)  # one version: a state is listed or pending, never both
        pending = tuple(_unlisted(spark, folder, name, listed).values())
        none = Version(0, (), "", ()) if listed is None else listed
        out[name] = merged(name, read_partials(spark, table, ddl, none, pending))
    return out


def compact_states(spark: SparkSession, folder: str, fanout: int = 8) -> dict[str, int]:
    """Merge the states of each table, ``fanout`` at a time; merges done by table."""
    for t in STATES:
        list_states(spark, folder, t)
    return {t: compact(spark, f"{folder}/states/{t}", lambda rows, t=t: merged(t, rows), fanout) for t in STATES}


def maintain(spark: SparkSession, folder: str, fanout: int = 8, most_folders: int = 32) -> None:
    """What a schedule runs beside loads and readers: merge states, and fold the records of
    tables with more than ``most_folders`` loads since their last fold."""
    compact_states(spark, folder, fanout)
    for t in STATES:
        version = current_version(spark, f"{folder}/raw/{t}")
        if version is not None and len(version.folders) > most_folders:
            fold(spark, f"{folder}/raw/{t}")


def loaded_ledger(spark: SparkSession, folder: str) -> Ledger:
    """The ledger tables as they stand."""
    return Ledger(**{t: read_live(spark, f"{folder}/raw/{t}", t) for t in STATES})


def current_statements(spark: SparkSession, folder: str, years: DataFrame, end_year: int = DASHBOARD_END_YEAR,
                       rules: RuleSet = PIPELINE) -> DataFrame:
    """The yearly dashboard from the states; ``years`` bound the depreciation."""
    posts = postings_from(current_states(spark, folder), years, rules, end_year, by_rule=False)
    return dashboard(yearly_summaries(posts), end_year, rules)
