"""Operator 9: line dedup by sharded minimal perfect hashes.

1. Every long enough line's key is hashed to 128 bits; rows (hash, count of
   documents, largest doc_id) are added up before and after one shuffle.
2. Keys of ``min_docs`` documents or more are dealt to shards. A shard is one
   row: a minimal perfect hash over the low 64 bits, and behind it compact
   arrays of fingerprints (the high 64 bits), counts and largest doc_ids.
3. Documents probe the arrays: each task packs its distinct (hash, doc_id)
   probes by shard; shard and probes meet by number, and no line is joined
   with a line. A shard's probes are salted by doc_id into cells of bounded
   size, however often a single line occurs.
4. The keys that a document loses go back to it by doc_id, and its lines are
   filtered.

Tables between the steps are written to the shared folder.

Defined results: every row is a document, also where doc_ids repeat (rows of
the largest doc_id all keep the line). A null doc_id counts as smaller than
any other; such documents are told apart by their texts, so no group of theirs meets
in one task. Null and empty texts have one empty line. An empty table gives an
empty result. Further columns of the input, whatever their names, are left
alone.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallybook.llm.common import column, documents, id_text, numbered, slices, stage, tidy
from tallybook.llm.perfect_hash import PerfectHash

BLANKS = b" \t\n\x0b\x0c\r"
#: Keys in a shard and probes in a cell, about, at the most.
SHARD_KEYS, CELL_PROBES = 250_000, 250_000
_NONE = np.iinfo(np.int64).min  # a null doc_id in a packed array


def line_key(line: bytes, min_chars: int) -> bytes | None:
    """128-bit hash of a line's key; None if the key is too short."""
    key = line.strip(BLANKS).lower()  # of bytes: A-Z only
    if len(key) < min_chars or (len(key) < 4 * min_chars and len(key.decode()) < min_chars):
        return None
    return xxhash.xxh3_128_digest(key)


def _keys(text: str | None, min_chars: int) -> set[bytes]:
    out = {line_key(x, min_chars) for x in (text or "").encode().split(b"\n")}
    out.discard(None)
    return out


def _halves(keys: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(keys), np.uint64).reshape(-1, 2)


def shared_keys(docs: DataFrame, min_chars: int, min_docs: int) -> DataFrame:
    """lo, hi, n, last: the keys of ``min_docs`` documents or more."""
    def run(batches):
        for batch in slices(batches, 2048):
            ids, keys = [], []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own = _keys(text, min_chars)
                ids += [doc] * len(own)
                keys += own
            half = _halves(keys).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(half[:, 0]), pa.array(half[:, 1]), pa.array(ids, pa.int64())],
                                             names=["lo", "hi", "doc_id"])

    return (docs.mapInArrow(tidy(run), "lo long, hi long, doc_id long").groupBy("lo", "hi")
            .agg(F.count("*").alias("n"), F.max("doc_id").alias("last")).where(F.col("n") >= min_docs))


def build_shards(keys: DataFrame, n_shards: int) -> DataFrame:
    """shard, data: the hash and the arrays of each shard's keys."""
    def build(table: pa.Table) -> pa.Table:
        lo, hi = (table[c].to_numpy().view(np.uint64) for c in ("lo", "hi"))
        lo, first, back = np.unique(lo, return_index=True, return_inverse=True)
        # Keys that share their low half stay in a list beside the arrays.
        extra = np.setdiff1d(np.arange(len(hi)), first)
        ph = PerfectHash.build(lo)
        slot = ph.lookup(lo)
        last = pc.fill_null(table["last"], int(_NONE)).to_numpy()
        arrays = [np.empty(len(lo), np.uint64), np.empty(len(lo), np.int64), np.empty(len(lo), np.int64)]
        for array, col in zip(arrays, (hi, last, table["n"].to_numpy())):
            array[slot] = col[first]
        rest = np.stack([lo[back[extra]].view(np.int64), hi[extra].view(np.int64), last[extra]], 1)
        return pa.table({"shard": table["shard"][:1].cast(pa.int64()),
                         "hash": pa.array([ph.to_bytes()], pa.binary()),
                         **{n: pa.array([a.tobytes()], pa.binary())
                            for n, a in zip(("prints", "last", "n", "rest"), [*arrays, rest])}})

    return (keys.withColumn("shard", _shard(n_shards)).groupBy("shard")
            .applyInArrow(build, "shard long, hash binary, prints binary, last binary, n binary, rest binary"))


def _shard(n_shards: int):
    return F.pmod(F.shiftrightunsigned("lo", 20), F.lit(n_shards)).cast("long")


def _text_id(text: str | None) -> int:
    """What stands for a null doc_id: equal texts lose equal lines. As Spark's xxhash64."""
    n = xxhash.xxh64_intdigest((text or "").encode(), 42)
    return n - (1 << 64) if n >> 63 else n


def _pack_probes(docs: DataFrame, min_chars: int, n_shards: int, cells_of: np.ndarray) -> DataFrame:
    """shard, cell, none, keys, ids: a task's probes, packed by cell; ``none``: of null
    doc_ids, whose texts' hashes are the ids."""
    def run(batches):
        for batch in batches:
            ids, none, keys = [], [], []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own = _keys(text, min_chars)
                ids += [_text_id(text) if doc is None else doc] * len(own)
                none += [doc is None] * len(own)
                keys += own
            if not keys:
                continue
            half, doc, none = _halves(keys), np.array(ids, np.int64), np.array(none)
            shard = ((half[:, 0] >> np.uint64(20)) % np.uint64(n_shards)).astype(np.int64)
            cell = ((doc.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)).astype(np.int64) % cells_of[shard]
            order = np.lexsort((none, cell, shard))
            half, doc, none, shard, cell = half[order], doc[order], none[order], shard[order], cell[order]
            cut = np.flatnonzero(np.r_[True, (shard[1:] != shard[:-1]) | (cell[1:] != cell[:-1]) | (none[1:] != none[:-1])])
            stop = np.r_[cut[1:], len(doc)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(shard[cut]), pa.array(cell[cut]), pa.array(none[cut]),
                 pa.array([half[a:b].tobytes() for a, b in zip(cut, stop)], pa.binary()),
                 pa.array([doc[a:b].tobytes() for a, b in zip(cut, stop)], pa.binary())],
                names=["shard", "cell", "none", "keys", "ids"])

    return docs.mapInArrow(tidy(run), "shard long, cell long, none boolean, keys binary, ids binary")


def _probe(probes: pa.Table, shards: pa.Table) -> pa.Table:
    """doc_id, none, key for each probe whose line goes: shared, and not in its last document."""
    out_ids, out_none, out_keys = [], [], []
    if shards.num_rows:
        s = shards.slice(0, 1).to_pylist()[0]
        ph = PerfectHash.from_bytes(s["hash"])
        prints, last = np.frombuffer(s["prints"], np.uint64), np.frombuffer(s["last"], np.int64)
        rest = {(a, b): c for a, b, c in np.frombuffer(s["rest"], np.int64).reshape(-1, 3).tolist()}
        for none, keys, ids in zip(*(probes[c].to_pylist() for c in ("none", "keys", "ids"))):
            half, doc = np.frombuffer(keys, np.uint64).reshape(-1, 2), np.frombuffer(ids, np.int64)
            own = np.full(len(doc), _NONE) if none else doc  # as the largest doc_id would say it
            slot = ph.lookup(half[:, 0])
            gone = (prints[slot] == half[:, 1]) & (last[slot] != own)
            if rest:
                for k, (a, b) in enumerate(half.view(np.int64).tolist()):
                    gone[k] |= rest.get((a, b), own[k]) != own[k]
            out_ids.append(doc[gone])
            out_none += [none] * int(gone.sum())
            out_keys += [half[k].tobytes() for k in np.flatnonzero(gone)]
    doc = np.concatenate(out_ids) if out_ids else np.empty(0, np.int64)
    return pa.table({"doc_id": pa.array(doc), "none": pa.array(out_none, pa.bool_()), "key": pa.array(out_keys, pa.binary())})


def lost_keys(docs: DataFrame, min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """doc_id, none, keys: the hashed line keys that each document loses, of (doc_id, text).
    ``none``: the doc_id is null, and its text's hash stands for it."""
    spark = docs.sparkSession
    keys = stage(shared_keys(docs, min_chars, min_docs), "lines")
    n_shards = max(-(-keys.count() // SHARD_KEYS), 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    # Probes of shared lines by shard, from the counts. What is not shared spreads over
    # the shards by its hash and needs no salt. A task needs the number of cells of
    # every shard: eight bytes for SHARD_KEYS keys.
    cells = stage(keys.groupBy(_shard(n_shards).alias("shard")).agg(F.sum("n").alias("n")).where(F.col("n") > CELL_PROBES)
                  .selectExpr("shard", f"bigint(ceil(n / {CELL_PROBES})) as cells"), "cells")
    cells_of = np.ones(n_shards, np.int64)
    heavy = cells.toArrow()
    cells_of[heavy["shard"].to_numpy()] = heavy["cells"].to_numpy()
    shards = (build_shards(keys, n_shards).join(cells, "shard", "left")
              .withColumn("cell", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("cells", F.lit(1)) - 1))).drop("cells"))
    probes = _pack_probes(docs, min_chars, n_shards, cells_of)
    gone = (probes.groupBy("shard", "cell").cogroup(shards.groupBy("shard", "cell"))
            .applyInArrow(_probe, "doc_id long, none boolean, key binary"))
    return gone.groupBy("doc_id", "none").agg(F.collect_set("key").alias("keys"))


def drop_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """All columns of ``docs`` with the shared lines gone from the text, then
    ``__n_lines`` (before) and ``__n_dropped``."""
    lost = lost_keys(id_text(docs, id_col, text_col), min_chars, min_docs)
    names = [f"__c{k}" for k in range(len(docs.columns))]
    plain, key, text = numbered(docs), column(docs, id_col), names.index(column(docs, text_col))
    lost = lost.withColumnsRenamed({"doc_id": "__id", "none": "__none", "keys": "__keys"}).hint("shuffle_hash")
    ident = F.col(key).cast("long")
    ident = F.when(ident.isNull(), F.xxhash64(F.coalesce(F.col(f"__c{text}").cast("string"), F.lit("")))).otherwise(ident)
    on = (ident == F.col("__id")) & (F.col(key).cast("long").isNull() == F.col("__none"))
    joined = plain.join(lost, on, "left").drop("__id", "__none")
    schema = T.StructType([*plain.schema.fields, T.StructField("__n_lines", T.LongType()),
                           T.StructField("__n_dropped", T.LongType())])

    def run(batches):
        for batch in slices(batches, 2048):
            kept, before, dropped = [], [], []
            for t, gone in zip(batch.column(text).to_pylist(), batch.column(len(names)).to_pylist()):
                lines = (t or "").encode().split(b"\n")
                left = lines
                if gone:
                    lose = set(gone)
                    left = [x for x in lines if line_key(x, min_chars) not in lose]
                kept.append(t if len(left) == len(lines) else b"\n".join(left).decode())
                before.append(len(lines))
                dropped.append(len(lines) - len(left))
            cols = [batch.column(k) for k in range(len(names))]
            cols[text] = pa.array(kept, cols[text].type)
            yield pa.RecordBatch.from_arrays([*cols, pa.array(before, pa.int64()), pa.array(dropped, pa.int64())],
                                             names=[*names, "__n_lines", "__n_dropped"])

    return joined.mapInArrow(tidy(run), schema).toDF(*docs.columns, "__n_lines", "__n_dropped")


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's digest of every document's kept text."""
    return drop_lines(id_text(documents(spark, sf_dir))).selectExpr(
        "doc_id", "__n_lines as n_lines", "__n_dropped as n_dropped",
        "sha2(coalesce(text, ''), 256) as kept_sha256")


ORACLE = r"""
with lines as (select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line,
    generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as pos from documents),
keyed as (select *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key from lines),
shared as (select key, max(doc_id) as last from keyed where length(key) >= 20
    group by key having count(distinct doc_id) >= 3),
judged as (select k.*, s.key is not null and k.doc_id <> s.last as gone from keyed k left join shared s using (key))
select doc_id, count(*) as n_lines, count(*) filter (gone) as n_dropped,
    sha256(coalesce(string_agg(line, chr(10) order by pos) filter (not gone), '')) as kept_sha256
from judged group by doc_id"""
