"""Small corpora for the text operators, and their edge cases."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"

WORDS = ("the of and to in that is was for it with as be by on not he his are at this from or an "
         "which but all were when we there can who will more no if out so said what").split()


def prose(rnd: random.Random, n: int) -> str:
    out = []
    for _ in range(n):
        out.append(rnd.choice(WORDS) if rnd.random() < 0.5 else
                   "".join(rnd.choice("abcdefghijklmnoprstuvwé") for _ in range(rnd.randint(2, 9))))
        if rnd.random() < 0.08:
            out[-1] += rnd.choice(".,;") + rnd.choice(["", "\n"])
    return " ".join(out)


def frame(spark, rows):
    """documents of (doc_id, text) pairs."""
    return spark.createDataFrame([(i, t, "en", "s", len(t) if t is not None else None) for i, t in rows], SCHEMA)


def clashing(docs, more=()):
    """``docs`` with further columns called like the operators' own, in any case."""
    from pyspark.sql import functions as F

    names = ["Text", "DOC_ID", "key", "keys", "ids", "n", "node", "kept", "spans", "group", "range", "set_key", *more]
    return docs.select("*", *(F.lit("x").alias(n) for n in names))


def edge_rows(rnd: random.Random):
    """Null and empty texts, null and repeated ids, a long text, equal rows."""
    long = prose(rnd, 20_000)
    return [(1, None), (2, ""), (3, " \n \t\n"), (None, prose(rnd, 60)), (None, None), (4, "one"), (4, "one"),
            (5, long), (6, long), (7, "a" * 30_000), (8, prose(rnd, 80)), (8, prose(rnd, 80))]


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def write_docs(docs, path):
    """A table for a query; Parquet holds no names that differ in case only."""
    first = {n.lower(): k for k, n in reversed(list(enumerate(docs.columns)))}
    names = [docs.columns[k] for k in sorted(first.values())]
    docs = docs.toDF(*(f"c{k}" for k in range(len(docs.columns)))).select(*(f"c{k}" for k in sorted(first.values()))).toDF(*names)
    docs.write.parquet(f"{path}/documents.parquet")
    return str(path)
