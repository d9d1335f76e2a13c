"""Live statements: keep the postings up to date from streams of ledger changes.

The reference's dashboard is a view, so edits to the raw tables reach the
statements on the next read. Here each raw table is a Structured Streaming
source (new Parquet files in a folder) of ledger rows, with a weight ``w`` where
a row is withdrawn (-1) rather than put in (+1, or no ``w``): an edit is the old row
with -1 and the new one with +1. Every micro-batch is reduced once to the state
that its changes add (``operators.changes``) and listed as one small partial.

A batch replayed after a failure replaces its own partial: exactly once.
``compact_live_postings`` merges partials level by level, beside running streams and
readers. Balances are computed when the statements are read (``live_statements``),
because a late row changes every later balance, and a purchase that comes or goes
may change past COGS (the reference joins every sale to every distinct cost of its
product).
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.changes import STATES, WEIGHT, merged, postings_from, state_of
from ..operators.postings import PIPELINE, RuleSet
from ..operators.statements import dashboard, yearly_summaries
from ..plans.pipeline import default_years
from ..refresh.partials import add_batch, compact, read_partials
from ..sources.schemas import LEDGER_SCHEMAS


def start_live_postings(spark: SparkSession, sources: dict[str, str], sink: str,
                        checkpoint: str | None = None, rules: RuleSet = PIPELINE,
                        available_now: bool = False, files_per_trigger: int = 1000) -> list[StreamingQuery]:
    """One streaming query per raw table folder in ``sources``.

    The progress is kept in ``checkpoint``, by default a folder of the sink, so
    each sink sees all of the input. ``available_now`` processes what is there
    and stops (a scheduled incremental refresh). ``files_per_trigger`` bounds a
    micro-batch; a backlog is worked off in as many as it takes.
    """
    queries = []
    for table, path in sources.items():
        def write(batch: DataFrame, batch_id: int, table: str = table) -> None:
            add_batch(state_of(table, batch, rules), os.path.join(sink, table), batch_id)

        stream = (spark.readStream.schema(T.StructType([*LEDGER_SCHEMAS[table].fields, T.StructField(WEIGHT, T.LongType())]))
                  .option("maxFilesPerTrigger", files_per_trigger).parquet(path))
        at = os.path.join(checkpoint or os.path.join(sink, "_checkpoints"), table)
        w = stream.writeStream.foreachBatch(write).option("checkpointLocation", at)
        w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
        queries.append(w.queryName(f"live_{table}").start())
    return queries


def compact_live_postings(spark: SparkSession, sink: str, fanout: int = 8) -> dict[str, int]:
    """Merge the partials of every table, ``fanout`` at a time; merges done by table.

    A scheduled job; streams may go on writing and readers reading meanwhile."""
    return {t: compact(spark, os.path.join(sink, t), lambda rows, t=t: merged(t, rows), fanout) for t in STATES}


def live_statements(spark: SparkSession, sink: str, end_year: int = 2023,
                    rules: RuleSet = PIPELINE, years: DataFrame | None = None) -> DataFrame:
    """The statements from all partials written so far."""
    states = {t: merged(t, read_partials(spark, os.path.join(sink, t), ddl)) for t, ddl in STATES.items()}
    posts = postings_from(states, default_years(spark) if years is None else years, rules, end_year, by_rule=False)
    return dashboard(yearly_summaries(posts), end_year, rules)
