"""Operator 2: MinHash near-dedup with odd sketches.

1. One pass makes, per document, the number of its shingles, a 128-bit hash of
   the whole set, the hashes of ``bands`` bands of ``rows`` minima, and an odd
   sketch: each of the minima flips one of 512 bits. XOR of two sketches keeps
   the bits of minima that differ, and its population count estimates how many
   do, sharply so at high similarity.
2. Documents of equal sets are one class from here on, however many there are.
3. Classes that share a band's hash are a bucket. Its pivot is the class with
   the most company over all its buckets: the middle of a group of copies. Each
   class proposes the pivot that it shares most bands with; set sizes, then
   the sketches, rule out what is too far, and the rest is confirmed on the full
   sets. So a group costs its size, not its square.
4. Pairs of a bucket that are still in different components may be linked
   nonetheless. All classes of such buckets are compared exactly, by prefix
   filtering: with shingles in order of rarity, a pair similar enough shares a
   shingle early enough in both, and odd sketches of the whole sets, which
   differ in no more bits than the sets in shingles, do not differ in too many.
   Sets meet by shingle and size, so texts that share a frame, but less than the
   threshold, do not meet in it. Pairs within a component are never listed, and
   far fewer pairs pass than share a bucket. These are confirmed as well.
5. Components by star steps; the smallest doc_id of each names it.

A pair at similarity s is missed by all bands with probability
(1 - s^rows)^bands: 2e-10 at 0.85, 1e-7 at 0.8 with the defaults. A sketch
rules out pairs it puts more than 0.2 below the threshold, 5 standard errors.

Defined results: null and empty texts, and texts without words, have no
shingles and are linked with nothing. A null doc_id takes part; a component of
null ids only has a null component_id, and its rows are kept. Rows that repeat
a doc_id are documents of their own with that id. An empty table gives an
empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallybook.llm.common import column, documents, id_text, numbered, release, slices, stage, tidy
from tallybook.llm.components import stars
from tallybook.llm.perfect_hash import mix

SKETCH_BITS = 512
#: Words whose hashes a task remembers.
KNOWN = 150_000
#: What a sketch's estimate may lie below the threshold.
MARGIN = 0.2
_C = [np.uint64(c) for c in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]


def shingles(text: str, k: int, hashes: dict[bytes, int]) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's k-word shingles."""
    words = text.encode().lower().split()  # of bytes: A-Z only, at ASCII blanks only
    if not words:
        return np.empty(0, np.uint64)
    for w in set(words):
        if w not in hashes:
            hashes[w] = xxhash.xxh3_64_intdigest(w)
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    n = max(1, len(h) - k + 1)
    out = np.full(n, min(k, len(h)), np.uint64)
    for j in range(min(k, len(h))):
        out = mix((out ^ h[j:j + n]) * _C[0], j)
    return np.unique(out)


def minima(sets: np.ndarray, seeds: np.ndarray, block: int = 2048) -> np.ndarray:
    out = np.full(len(seeds), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(sets), block):
        out = np.minimum(out, ((sets[at:at + block] ^ seeds[:, :1]) * seeds[:, 1:]).min(1))
    return out


def odd_sketch(low: np.ndarray) -> np.ndarray:
    """Of minima, each of which counts with its number."""
    return parity(low + np.arange(len(low), dtype=np.uint64) * _C[1])


def parity(members: np.ndarray) -> np.ndarray:
    """Odd sketch of a set: a bit is set if an odd number of members hash to it. Two
    sketches differ in no more bits than the sets have members not in common."""
    bit = mix(members, 77) % np.uint64(SKETCH_BITS)
    odd = np.bincount(bit.astype(np.int64), minlength=SKETCH_BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def sketch_limit(percent: int, minima_: int) -> int:
    """Most differing bits of the sketches of a pair worth confirming."""
    differ = 2 * minima_ * (1 - (percent / 100 - MARGIN))
    return math.ceil(SKETCH_BITS / 2 * (1 - (1 - 2 / SKETCH_BITS) ** differ))


def signatures(docs: DataFrame, k: int, bands: int, rows: int) -> DataFrame:
    """doc_id, n_shingles, set_key, bands, sketch, of (doc_id, text)."""
    def run(batches):
        rng = np.random.default_rng(11)
        seeds = rng.integers(0, 1 << 63, (bands * rows, 2), dtype=np.uint64)
        seeds[:, 1] |= np.uint64(1)
        number = np.arange(bands, dtype=np.uint64)
        hashes: dict[bytes, int] = {}
        for batch in slices(batches, 512):
            if len(hashes) > KNOWN:
                hashes.clear()
            out = []
            for text in batch.column(1).to_pylist():
                s = shingles(text or "", k, hashes)
                if not len(s):
                    out.append((0, None, None, None))
                    continue
                low = minima(s, seeds)
                key = number * _C[2]
                for j in range(rows):
                    key = mix(key ^ low[j::rows], j)
                out.append((len(s), xxhash.xxh3_128_digest(s.tobytes()), key.view(np.int64), odd_sketch(low)))
            cols = list(zip(*out)) if out else [()] * 4
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.binary()),
                 pa.array(cols[2], pa.list_(pa.int64())), pa.array(cols[3], pa.list_(pa.int64()))],
                names=["doc_id", "n_shingles", "set_key", "bands", "sketch"])

    return docs.mapInArrow(tidy(run), "doc_id long, n_shingles long, set_key binary, bands array<long>, sketch array<long>")


def _sets(docs: DataFrame, nodes: DataFrame, k: int) -> DataFrame:
    """node, words, parity: the whole set of each node, from the text of a row that
    has it, and the odd sketch of the whole set."""
    def run(batches):
        hashes: dict[bytes, int] = {}
        for batch in slices(batches, 512):
            if len(hashes) > KNOWN:
                hashes.clear()
            sets = [shingles(t or "", k, hashes) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
                                              pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64())),
                                              pa.array([parity(s) for s in sets], pa.list_(pa.int64()))],
                                             names=["set_key", "words", "parity"])

    text = docs.join(nodes.select("first_id").hint("shuffle_hash"), F.col("doc_id").eqNullSafe(F.col("first_id")),
                     "left_semi").select("text")
    return (text.mapInArrow(tidy(run), "set_key binary, words array<long>, parity array<long>")
            .join(nodes.select("set_key", "node"), "set_key")
            .groupBy("node").agg(F.first("words").alias("words"), F.first("parity").alias("parity")))


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b) of the pairs whose whole sets are similar enough."""
    def arrays(column: pa.ListArray) -> list[np.ndarray]:
        return np.split(column.flatten().to_numpy(), np.cumsum(column.value_lengths().to_numpy())[:-1])

    def run(batches):
        for batch in batches:
            good = []
            for x, y in zip(arrays(batch.column(2)), arrays(batch.column(3))) if batch.num_rows else ():
                both = len(np.intersect1d(x, y, assume_unique=True))
                good.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(good, pa.bool_()))

    sets = sets.select("node", "words")
    return (pairs.select("a", "b").join(sets.toDF("a", "x"), "a").join(sets.toDF("b", "y"), "b")
            .select("a", "b", "x", "y").mapInArrow(tidy(run), "a long, b long"))


#: Sizes of one band differ by 2 % at the most.
_BAND = math.log(1.02)


def prefix_rows(sets: DataFrame, percent: int) -> DataFrame:
    """w, node, root, n, left, parity: the shingles that a set may share first with another
    one similar enough, ``left`` of them from this one on. Rare shingles come first,
    those of one set only before all others; these take places but need no rows."""
    each = sets.select("node", "root", F.size("words").alias("n"), F.explode("words").alias("w"))
    shared = each.groupBy("w").agg(F.count("*").alias("times")).where("times > 1")
    of_node = Window.partitionBy("node")  # no more rows than its text has words
    rows = (each.join(shared, "w")
            .withColumn("left", F.count("*").over(of_node) - F.row_number().over(of_node.orderBy("times", "w")) + 1)
            .where(f"100 * left >= {percent} * n").select("w", "node", "root", "n", "left"))
    return rows.join(sets.select("node", "parity"), "node").select("w", "node", "root", "n", "left", "parity")


def prefix_pairs(rows: DataFrame, percent: int) -> DataFrame:
    """(a, b), a the smaller set, a pair once: sets of different roots that can be similar enough.

    ``rows``: the sets' ``prefix_rows``. Exact: sets of n and m shingles are asked for an
    overlap of percent * (n + m) / (100 + percent), so both still have to hold that many
    from a first common shingle on, and the odd sketches of the whole sets differ in no
    more bits than the sets may in shingles, (100 - percent) * (n + m) / (100 + percent).

    With ``left`` shingles from there on, a set has partners up to a certain size only:
    the smaller set goes to the bands of these sizes, the larger one to its own. A
    shingle that very many sets share brings together only those of fitting sizes:
    sets that have too much of their own before it have no fitting size at all.
    """
    def band(n: str) -> str:
        return f"int(floor(ln({n}) / {_BAND}))"

    most = f"least(100 * n div {percent}, {100 + percent} * left div {percent} - n)"
    small = (rows.withColumn("most", F.expr(most)).where("most >= n")
             .withColumn("band", F.explode(F.expr(f"sequence({band('n')}, {band('most')})"))))
    large = rows.withColumn("band", F.expr(band("n")))
    # Of each shingle and band, the root with the most rows needs no pairs among its own.
    big = (large.groupBy("w", "band", "root").agg(F.count("*").alias("m")).groupBy("w", "band")
           .agg(F.max_by("root", "m").alias("big")))
    differ = "+".join(f"bit_count(pa[{j}] ^ pb[{j}])" for j in range(SKETCH_BITS // 64))
    fits = (f"ra <> rb and (na < nb or (na = nb and a < b)) and nb <= most "
            f"and {100 + percent} * least(la, lb) >= {percent} * (na + nb) "
            f"and {100 + percent} * ({differ}) <= {100 - percent} * (na + nb)")
    one = small.join(big, ["w", "band"]).toDF("w", "band", "a", "ra", "na", "la", "pa", "most", "big")
    two = large.join(big, ["w", "band"]).toDF("w", "band", "b", "rb", "nb", "lb", "pb", "big")
    met = (one.where("ra <> big").join(two.drop("big"), ["w", "band"]).where(fits).select("a", "b")
           .unionAll(one.where("ra = big").join(two.where("rb <> big").drop("big"), ["w", "band"]).where(fits).select("a", "b")))
    return met.distinct()


def components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, percent: int = 80,
               bands: int = 30, rows: int = 4) -> DataFrame:
    """doc_id, n_shingles, component_id, kept."""
    docs = id_text(docs, id_col, text_col)
    sig = stage(signatures(docs, k, bands, rows), "signatures")
    full = sig.where("set_key is not null")
    nodes = stage(full.groupBy("set_key").agg(F.min("doc_id").alias("first_id"), F.first("n_shingles").alias("n"),
                                              F.first("bands").alias("bands"), F.first("sketch").alias("sketch"))
                  .withColumn("node", F.monotonically_increasing_id()), "classes")
    links = _links(docs, nodes, k, percent, bands * rows)
    named = nodes.select("set_key", "first_id", "node").join(links.toDF("node", "root"), "node", "left")
    named = named.withColumn("root", F.coalesce("root", "node"))
    least = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = named.join(least, "root").select("set_key", "component_id")
    out = full.select("doc_id", "n_shingles", "set_key").join(named, "set_key").drop("set_key")
    out = out.unionAll(sig.where("set_key is null").selectExpr("doc_id", "n_shingles", "doc_id as component_id"))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def _links(docs: DataFrame, nodes: DataFrame, k: int, percent: int, minima_: int) -> DataFrame:
    """Stars (a, b) over the nodes that have a link."""
    bucketed = nodes.select("node", F.explode("bands").alias("bucket"))
    shared = bucketed.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    members = stage(bucketed.join(shared, "bucket"), "members")
    company = members.groupBy("node").agg(F.sum("n").alias("company"))
    pivots = members.join(company, "node").groupBy("bucket").agg(F.max_by("node", "company").alias("pivot"))
    sets = stage(_sets(docs, nodes.join(company.select("node"), "node", "left_semi"), k), "sets")

    one, two = (nodes.select(F.col("node").alias(x), F.col("n").alias(f"n{x}"), F.col("sketch").alias(f"s{x}"))
                for x in "ab")
    differ = "+".join(f"bit_count(sa[{j}] ^ sb[{j}])" for j in range(SKETCH_BITS // 64))
    proposed = (members.join(pivots, "bucket").where("node <> pivot").groupBy(F.col("node").alias("a"), F.col("pivot").alias("b"))
                .count().groupBy("a").agg(F.max_by("b", "count").alias("b"))
                .join(one, "a").join(two, "b")
                .where(f"{differ} <= {sketch_limit(percent, minima_)} and 100 * least(na, nb) >= {percent} * greatest(na, nb)"))
    proposed = stage(proposed.select("a", "b"), "proposed")
    links = stars(_confirmed(proposed, sets, percent))
    release(proposed)

    # Buckets over more than one component, and all who are in them.
    placed = members.join(links.toDF("node", "root"), "node", "left").withColumn("root", F.coalesce("root", "node"))
    mixed = placed.groupBy("bucket").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high")
    apart = placed.join(mixed, "bucket").select("node", "root").distinct()
    prefixes = stage(prefix_rows(sets.join(apart, "node"), percent), "prefixes")
    rest = stage(prefix_pairs(prefixes, percent), "rest")
    release(prefixes)
    out = stars(links.unionAll(_confirmed(rest, sets, percent)))
    release(members, sets, links, rest)
    return out


def one_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, percent: int = 80) -> DataFrame:
    """One document of each component, its smallest doc_id, with all its columns.
    Rows that repeat that doc_id stay, too."""
    kept = components(docs, id_col, text_col, k, percent).where("kept").select(F.col("doc_id").alias("__id")).distinct()
    key = F.col(column(docs, id_col)).cast("long").eqNullSafe(F.col("__id"))
    return numbered(docs).join(kept.hint("shuffle_hash"), key, "left_semi").toDF(*docs.columns)


def op2_minhash_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's near-duplicate components of all documents."""
    return components(documents(spark, sf_dir), k=3, percent=85)


ORACLE = r"""
with recursive words as (select doc_id, list_filter(string_split_regex(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') as w from documents),
shingles as (select distinct doc_id, unnest(case when len(w) >= 3
    then list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])
    when len(w) > 0 then [array_to_string(w, ' ')] else [] end) as s from words),
sizes as (select doc_id, count(*) as n from shingles group by doc_id),
common as (select a.doc_id as a, b.doc_id as b, count(*) as n from shingles a join shingles b on a.s = b.s and a.doc_id <> b.doc_id
    group by 1, 2),
links as (select a, b from common c join sizes x on x.doc_id = a join sizes y on y.doc_id = b
    where 100 * c.n >= 85 * (x.n + y.n - c.n)),
reach as (select doc_id as a, doc_id as b from documents union select r.a, l.b from reach r join links l on l.a = r.b),
least as (select a, min(b) as component_id from reach group by a)
select d.doc_id, coalesce(s.n, 0) as n_shingles, l.component_id, d.doc_id = l.component_id as kept
from documents d join least l on l.a = d.doc_id left join sizes s on s.doc_id = d.doc_id"""
