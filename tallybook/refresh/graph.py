"""Refresh order: derived tables and what they are made from.

Each derived table names its inputs. A refresh goes through them in an order in which
inputs come first, and rebuilds a table only if it was made from other versions of
its inputs, or under other settings, than those of now. The versions that a table was
made from are part of its own version, so they cannot disagree.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass
from graphlib import TopologicalSorter

from pyspark.sql import DataFrame, SparkSession

from ..sources.versions import current_version, read_version, save_version

Build = Callable[[SparkSession, Mapping[str, DataFrame]], DataFrame]


@dataclass(frozen=True)
class Derived:
    """A table made by ``build`` from the tables ``inputs``; ``settings`` says by which
    parameters, as text."""
    name: str
    inputs: tuple[str, ...]
    build: Build
    partition_by: tuple[str, ...] = ()
    settings: str = ""


def in_order(tables: Iterable[Derived]) -> list[Derived]:
    """Inputs before what is made from them; a cycle is a ``graphlib.CycleError``."""
    by_name = {t.name: t for t in tables}
    sorter = TopologicalSorter({t.name: [i for i in t.inputs if i in by_name] for t in by_name.values()})
    return [by_name[n] for n in sorter.static_order()]


def refresh(spark: SparkSession, folder: str, tables: Iterable[Derived],
            at: Mapping[str, str] | None = None) -> list[str]:
    """Rebuild the stale tables below ``folder``; their names, in order.

    Inputs that are no derived tables are versioned tables of the same names, below
    ``folder`` or where ``at`` says. Each table is published by itself when it is
    whole; a refresh that fails goes on from there the next time.
    """
    at = dict(at or {})
    rebuilt = []
    for t in in_order(tables):
        paths = {i: at.get(i, f"{folder}/{i}") for i in t.inputs}
        seen = {i: current_version(spark, p) for i, p in paths.items()}
        missing = [i for i, v in seen.items() if v is None]
        if missing:
            raise ValueError(f"{t.name}: no version of {', '.join(missing)}")
        made_from = {"inputs": {i: v.number for i, v in seen.items()}, "settings": t.settings}
        now = current_version(spark, f"{folder}/{t.name}")
        if now is not None and now.notes == made_from:
            continue
        frames = {i: read_version(spark, paths[i], v.number) for i, v in seen.items()}
        save_version(t.build(spark, frames), f"{folder}/{t.name}", list(t.partition_by), made_from, onto=now)
        rebuilt.append(t.name)
    return rebuilt
