"""Operator 1: removal of repeated 200-byte strings by a difference-cover sort.

The difference-cover scheme, bounded to the 200 bytes that matter:

1. Sample. A position is sampled if its place in its group of documents,
   modulo 91, is in a difference cover: for any two positions some shift below
   91 makes both sampled ones. About one position in nine is sampled.
2. Names. Triples of 8-byte words get 24-byte names, triples of these 72-byte
   names: the recursion on names, as deep as the length needs. A name is a
   fingerprint. Any total order puts equal strings side by side, so the order
   of fingerprints stands for the alphabetical one.
3. Sort the samples' names, dealt by range, and compare neighbours. Two
   occurrences of a 200-byte string have samples at one shift below 91 at
   least, and the 72 bytes from there lie inside the string: that name is
   repeated.
4. Merge the remaining suffixes: only positions with a repeated sample among
   the next 91 can start a repeated string. They are sorted by a triple of
   their names, at 0, 64 and 128, which together are the first 200 bytes;
   equal neighbours are repeated strings.
5. Mark 200 bytes from each of them and cut what is marked.

Documents are dealt to groups of about GROUP_BYTES by a hash of the row. A
group sends each key once, as packed sorted arrays, one row per range, and
gets one bit a key back. So a string that a third of all documents hold is
sent once a group, a range holds no more keys than any other, and nothing
grows with the square of a repeat. What is exchanged is 8 bytes a sample, then
8 bytes a candidate; a key has 64 bits besides the bits that choose its range,
and the number of ranges grows with the input.

Judged on the input: bytes of UTF-8, never across documents. Null text: empty.
Repeated rows repeat each other's strings. Null and repeated doc_ids are
treated like any other row; an empty table gives an empty result. Texts of
less than 200 bytes are kept whole. Memory grows with a group, and with the
longest single document.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybook.llm.common import documents, id_text, stage, tidy

WINDOW = 200
#: A perfect difference set: each difference modulo 91 occurs once.
MODULUS, COVER = 91, (0, 1, 3, 9, 27, 49, 56, 61, 77, 81)
NAME = 72
GROUP_BYTES = 8 << 20
#: Bytes of keys in a range, about, at the most.
RANGE_BYTES = 16 << 20
_CHUNK = 1 << 15  # whose arrays stay in a core's cache
_SEEDS = tuple(tuple(np.uint64(c) for c in s) for s in (
    (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xFF51AFD7ED558CCD),
    (0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0xC4CEB9FE1A85EC53)))


def _triple(a: np.ndarray, b: np.ndarray, c: np.ndarray, seed: tuple) -> np.ndarray:
    x = a * seed[0]
    x += b * seed[1]
    x ^= x >> np.uint64(29)
    x += c * seed[2]
    x ^= x >> np.uint64(32)
    x *= seed[3]
    x ^= x >> np.uint64(31)
    return x


def names(data: bytes, start: int, stop: int, seed: tuple) -> np.ndarray:
    """Names of the 72 bytes from each position of start..stop."""
    n = stop - start
    word = np.ndarray((n + NAME - 8,), "<u8", data, start, (1,)).astype(np.uint64)
    one = _triple(word[:-16], word[8:-8], word[16:], seed)
    return _triple(one[:-48], one[24:-24], one[48:], seed)


class Group:
    """Documents of a group, one after the other."""

    def __init__(self, texts: list[str | None]):
        raw = [(t or "").encode() for t in texts]
        self.raw = raw
        self.long = [k for k, b in enumerate(raw) if len(b) >= WINDOW]
        sizes = np.array([len(raw[k]) for k in self.long], np.int64)
        self.starts = np.r_[0, np.cumsum(sizes)]
        self.data = b"".join(raw[k] for k in self.long)
        self.size = len(self.data)
        room = np.repeat(self.starts[1:].astype(np.int32), sizes) - np.arange(self.size, dtype=np.int32)
        places = np.sort(np.concatenate([np.arange(c, self.size, MODULUS) for c in COVER]))
        self.samples = places[room[places] >= NAME]
        self.starts_window = room >= WINDOW

    def _chunks(self):
        """(start, stop) of positions that have a whole name after them."""
        for at in range(0, self.size - NAME + 1, _CHUNK):
            yield at, min(at + _CHUNK, self.size - NAME + 1)

    def sample_keys(self) -> Keys:
        out = [np.empty(0, np.uint64)]
        for a, b in self._chunks():
            lo, hi = np.searchsorted(self.samples, (a, b))
            out.append(names(self.data, a, b, _SEEDS[0])[self.samples[lo:hi] - a])
        key = np.concatenate(out)
        return Keys(key, key)

    def candidates(self, repeated: np.ndarray) -> np.ndarray:
        """Window starts with a repeated sample at a shift below the modulus."""
        mark = np.zeros(self.size + 1, np.int32)
        mark[self.samples[repeated] + 1] = 1
        before = np.cumsum(mark, dtype=np.int32)  # repeated samples before each position
        ok = self.starts_window.copy()
        n = max(0, self.size - MODULUS)
        ok[:n] &= before[MODULUS:MODULUS + n] > before[:n]
        return np.flatnonzero(ok)

    def window_keys(self, at: np.ndarray) -> Keys:
        """Keys of the windows that start at the sorted positions ``at``."""
        ranges, keys = [np.empty(0, np.uint64)], [np.empty(0, np.uint64)]
        for a in range(0, self.size, _CHUNK):
            lo, hi = np.searchsorted(at, (a, a + _CHUNK))
            if lo < hi:
                base, stop = int(at[lo]), int(at[hi - 1]) + WINDOW - NAME + 1
                here = at[lo:hi] - base
                for out, seed in zip((ranges, keys), _SEEDS):
                    n = names(self.data, base, stop, seed)
                    out.append(_triple(n[here], n[here + 64], n[here + 128], seed))
        return Keys(np.concatenate(ranges), np.concatenate(keys))


class Keys:
    """Keys of a group in the order in which they are dealt and sorted."""

    def __init__(self, dealt: np.ndarray, key: np.ndarray):
        self.dealt, self.key = dealt, key

    def sort(self, n_ranges: int) -> None:
        bits = n_ranges.bit_length() - 1
        place = (self.dealt >> np.uint64(64 - bits)).astype(np.uint16 if bits <= 16 else np.uint32) if bits else \
            np.zeros(len(self.key), np.uint16)
        order = np.argsort(self.key, kind="quicksort")
        order = order[np.argsort(place[order], kind="stable")]
        place, key = place[order], self.key[order]
        first = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (place[1:] != place[:-1])][:len(key)])
        self.order, self.times = order, np.diff(np.r_[first, len(key)])
        self.unique, self.place = key[first], place[first]

    def rows(self, group: int) -> pa.Table:
        """range, group, keys, twice: each range's distinct keys, and a bit for
        those that the group has more than once."""
        cut = np.flatnonzero(np.r_[True, self.place[1:] != self.place[:-1]][:len(self.place)])
        stop = np.r_[cut[1:], len(self.place)] if len(cut) else cut
        twice = self.times > 1
        return pa.table({"range": pa.array(self.place[cut].astype(np.int64)),
                         "group": pa.array(np.full(len(cut), group, np.int64)),
                         "keys": pa.array([self.unique[a:b].tobytes() for a, b in zip(cut, stop)], pa.binary()),
                         "twice": pa.array([np.packbits(twice[a:b]).tobytes() for a, b in zip(cut, stop)], pa.binary())})

    def spread(self, masks: list[tuple[int, bytes]]) -> np.ndarray:
        """The answers, by range, as a flag for each key in its first order."""
        cut = np.flatnonzero(np.r_[True, self.place[1:] != self.place[:-1]][:len(self.place)])
        sizes = np.diff(np.r_[cut, len(self.place)])
        bits = [np.unpackbits(np.frombuffer(m, np.uint8), count=n) for (_, m), n in zip(sorted(masks), sizes.tolist())]
        flags = np.concatenate([np.empty(0, np.uint8), *bits]).astype(bool)
        out = np.empty(len(self.key), bool)
        out[self.order] = np.repeat(flags, self.times)
        return out


def repeated(table: pa.Table) -> pa.Table:
    """Of one range: group, range, mask, with a bit for each key that occurs again."""
    keys = [np.frombuffer(k, np.uint64) for k in table["keys"].to_pylist()]
    sizes = [len(k) for k in keys]
    every = np.concatenate(keys)
    again = np.concatenate([np.unpackbits(np.frombuffer(t, np.uint8), count=n)
                            for t, n in zip(table["twice"].to_pylist(), sizes)]).astype(bool)
    order = np.argsort(every)
    same = np.flatnonzero(every[order[1:]] == every[order[:-1]])
    again[order[same]] = True
    again[order[same + 1]] = True
    stops = np.cumsum(sizes)
    return pa.table({"group": table["group"], "range": table["range"],
                     "mask": pa.array([np.packbits(again[b - n:b]).tobytes() for b, n in zip(stops, sizes)], pa.binary())})


def _packed(rows: DataFrame) -> DataFrame:
    """group, docs: the documents of a task by group, compressed together."""
    def run(batches):
        options = pa.ipc.IpcWriteOptions(compression="zstd")
        for batch in batches:
            group = batch.column("group").to_numpy()
            order = np.argsort(group, kind="stable")
            group, docs = group[order], batch.select(["doc_id", "text"]).take(pa.array(order))
            cut = np.flatnonzero(np.r_[True, group[1:] != group[:-1]][:len(group)])
            blobs = []
            for a, b in zip(cut, np.r_[cut[1:], len(group)]):
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, docs.schema, options=options) as out:
                    out.write_batch(docs.slice(a, b - a))
                blobs.append(sink.getvalue().to_pybytes())
            yield pa.RecordBatch.from_arrays([pa.array(group[cut]), pa.array(blobs, pa.binary())], names=["group", "docs"])

    return rows.mapInArrow(tidy(run), "group long, docs binary")


def _sorted(table: pa.Table) -> pa.Table:
    """The documents of a group, in an order of their own."""
    docs = pa.concat_tables([pa.ipc.open_stream(blob).read_all() for blob in table["docs"].to_pylist()])
    return docs.sort_by([("doc_id", "ascending"), ("text", "ascending")])


def _cover(group: Group, at: np.ndarray) -> np.ndarray:
    edge = np.zeros(group.size + 1, np.int32)
    edge[at] = 1
    edge[:-1] = np.cumsum(edge[:-1])
    # A byte is marked if a marked start lies among the 200 positions up to it.
    before = np.r_[np.zeros(WINDOW, np.int32), edge[:-1]][:group.size]
    return edge[:-1] > before


def cut_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, spans (array of removed [start, end) in bytes), kept (binary)."""
    spark = docs.sparkSession
    docs = id_text(docs, id_col, text_col)
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    n_groups = max(width, -(-total // GROUP_BYTES))
    # a sample in nine positions, at the most every position a candidate
    sample_ranges, window_ranges = (1 << (max(width, share * total // RANGE_BYTES) - 1).bit_length() for share in (1, 8))
    by_group = _packed(docs.withColumn("group", F.pmod(F.xxhash64("doc_id", "text"), F.lit(n_groups)))).groupBy("group")
    ddl = "range long, group long, keys binary, twice binary"

    def samples(table: pa.Table) -> pa.Table:
        keys = Group(_sorted(table)["text"].to_pylist()).sample_keys()
        keys.sort(sample_ranges)
        return keys.rows(table["group"][0].as_py())

    def answers(keys: DataFrame, name: str) -> DataFrame:
        return stage(keys.groupBy("range").applyInArrow(repeated, "group long, range long, mask binary"), name)

    def marked(docs: pa.Table, masks: pa.Table) -> tuple[Group, np.ndarray, Keys]:
        group = Group(docs["text"].to_pylist())
        keys = group.sample_keys()
        keys.sort(sample_ranges)
        at = group.candidates(keys.spread(_of(masks, 0)))
        windows = group.window_keys(at)
        windows.sort(window_ranges)
        return group, at, windows

    def _of(masks: pa.Table, step: int) -> list[tuple[int, bytes]]:
        return [(r["range"], r["mask"]) for r in masks.to_pylist() if r["step"] == step]

    def candidates(table: pa.Table, masks: pa.Table) -> pa.Table:
        if not table.num_rows:
            return pa.table({c: pa.array([], t) for c, t in zip(("range", "group", "keys", "twice"),
                                                               (pa.int64(), pa.int64(), pa.binary(), pa.binary()))})
        return marked(_sorted(table), masks)[2].rows(table["group"][0].as_py())

    def cut(table: pa.Table, masks: pa.Table) -> pa.Table:
        docs = _sorted(table)
        group, at, windows = marked(docs, masks)
        hit = _cover(group, at[windows.spread(_of(masks, 1))])
        spans, kept = [[] for _ in group.raw], list(group.raw)
        for k, a, b in zip(group.long, group.starts[:-1].tolist(), group.starts[1:].tolist()):
            own = hit[a:b]
            if own.any():
                edge = np.flatnonzero(np.diff(np.r_[False, own, False].astype(np.int8)))
                spans[k] = [{"start": s, "end": e} for s, e in edge.reshape(-1, 2).tolist()]
                kept[k] = np.frombuffer(group.raw[k], np.uint8)[~own].tobytes()
        span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
        return pa.table({"doc_id": docs["doc_id"], "n_bytes": pa.array([len(b) for b in group.raw], pa.int64()),
                         "spans": pa.array(spans, pa.list_(span)), "kept": pa.array(kept, pa.binary())})

    first = answers(by_group.applyInArrow(samples, ddl), "names").withColumn("step", F.lit(0))
    second = answers(by_group.cogroup(first.groupBy("group")).applyInArrow(candidates, ddl), "windows")
    both = first.unionAll(second.withColumn("step", F.lit(1)))
    return by_group.cogroup(both.groupBy("group")).applyInArrow(
        cut, "doc_id long, n_bytes long, spans array<struct<start:long,end:long>>, kept binary")


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's digest of what each document keeps."""
    return cut_repeats(documents(spark, sf_dir)).selectExpr(
        "doc_id", "n_bytes", "n_bytes - octet_length(kept) as n_removed", "cast(size(spans) as long) as n_spans",
        "sha2(kept, 256) as kept_sha256")


ORACLE = r"""
with docs as (select doc_id, hex(encode(coalesce(text, ''))) as h, cast(strlen(coalesce(text, '')) as bigint) as n from documents),
chunks as (select doc_id, n, base, h[2 * base + 1 : 2 * base + 598] as c
    from (select doc_id, h, n, unnest(range(0, n, 100)) as base from docs)),
places as (select doc_id, n, base + k as p, c[2 * k + 1 : 2 * k + 2] as x, case when base + k + 200 <= n then md5_number(c[2 * k + 1 : 2 * k + 400]) end as s
    from (select *, unnest(range(0, least(100, n - base))) as k from chunks)),
again as (select s from places where s is not null group by s having count(*) > 1),
marked as (select doc_id, p, x, coalesce(max(case when a.s is not null then p end) over (partition by doc_id order by p) > p - 200, false) as gone
    from places left join again a using (s)),
runs as (select *, gone and not coalesce(lag(gone) over (partition by doc_id order by p), false) as first from marked),
cut as (select doc_id, count(*) filter (gone) as n_removed, count(*) filter (first) as n_spans,
    sha256(unhex(coalesce(string_agg(x, '' order by p) filter (not gone), ''))) as kept_sha256 from runs group by doc_id)
select doc_id, n as n_bytes, coalesce(n_removed, 0) as n_removed, coalesce(n_spans, 0) as n_spans,
    coalesce(kept_sha256, sha256('')) as kept_sha256
from docs left join cut using (doc_id)"""
