"""Operator 13: a Merkle manifest of a table by butterfly exchange.

1. A leaf is the digest of a record's fields. Leaves are sorted by group, key and
   digest over range partitions and numbered in there; with the counts of the
   partitions before, each has its place among its group's.
2. A block is ``FANOUT ** block_levels`` leaves of a group at aligned places: a
   subtree of the group's tree, whose root its task makes.
3. Butterfly: in round r, the blocks of a group whose numbers differ in digit r
   (to base ``FANOUT``) alone swap the roots of their subtrees. Each of them hashes
   the ancestor for itself, so all blocks below a node know its digest and its
   siblings: after the last round every block holds the upper part of its leaves'
   proofs, and nothing is sent down. The last subtree of a round may have fewer
   blocks than the others; each of its blocks then answers for several numbers.
4. The groups' roots, in order of the groups, are the leaves of the tree above,
   made in the same way.
5. Each block's task makes the lower part of the proofs and folds every leaf.

A digest is the lowercase hex SHA-256 of what it covers, digests as hex text. Up to
``FANOUT`` consecutive nodes have one parent, also a last one alone, while a level
has more than one node. A group with one leaf has that leaf as its root.

Rows through the exchanges are digests, not texts. A round moves a row a block (two
at the most), a block's task holds ``FANOUT ** block_levels`` digests.

Defined results: any field may be null and counts as ``-``. Null keys come first;
rows of one key follow the order of their digests, rows that are equal throughout
are leaves of their own, side by side. A null group is a group like any other and
comes first. An empty table gives an empty result. Further columns, whatever
their names, are left alone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallybook.llm.common import column, documents, numbered, release, stage

FANOUT = 8
#: Leaves in a range partition, about.
RANGE_ROWS = 500_000
_PATH = "array<struct<left:string,right:string>>"


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_digest(fields: list[Column]) -> Column:
    """Digest of the fields: ``-`` for null, else UTF-8 byte count, ``:``, value."""
    parts = [F.coalesce(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c), F.lit("-"))
             for c in (f.cast("string") for f in fields)]
    return F.sha2(F.concat(*parts), 256)


def climb(nodes: list[str], levels: int | None) -> list[list[str]]:
    """The nodes and the levels above: ``levels`` of them, or up to a single node."""
    out = [nodes]
    while len(out) <= levels if levels is not None else len(out[-1]) > 1:
        below = out[-1]
        out.append([digest("".join(below[k:k + FANOUT])) for k in range(0, len(below), FANOUT)])
    return out


def local_paths(levels: list[list[str]]) -> Iterator[list[tuple[str, str]]]:
    """Per leaf, the siblings to the left and to the right of its ancestors, joined,
    level by level up to the topmost, which has none here."""
    sides = []
    for nodes in levels[:-1]:
        runs = [nodes[k:k + FANOUT] for k in range(0, len(nodes), FANOUT)]
        sides.append([("".join(run[:k]), "".join(run[k + 1:])) for run in runs for k in range(len(run))])
    for place in range(len(levels[0])):
        path = []
        for side in sides:
            path.append(side[place])
            place //= FANOUT
        yield path


def fold(leaf: str, path: list[tuple[str, str]]) -> str:
    """The root that a leaf and the siblings of its path make."""
    for left, right in path:
        leaf = digest(left + leaf + right)
    return leaf


def placed(leaves: DataFrame, name: str, block_levels: int) -> DataFrame:
    """``leaves`` (grp, key, leaf, ...) with ``place`` in the group, ``total`` of the
    group and ``block``, written. Equal rows are told apart by a number of their own."""
    leaves = stage(leaves.withColumn("__at", F.monotonically_increasing_id()), f"{name}-leaves")
    spark = leaves.sparkSession
    wide = max(-(-leaves.count() // RANGE_ROWS), int(spark.conf.get("spark.sql.shuffle.partitions")))
    order = [F.col("grp").asc_nulls_first(), F.col("key").asc_nulls_first(), F.col("leaf").asc(), F.col("__at").asc()]
    dealt = (leaves.repartitionByRange(wide, *order).sortWithinPartitions(*order).drop("__at")
             .withColumn("part", F.spark_partition_id()))

    def run(batches):
        last, seen = (), 0
        for batch in batches:
            if not batch.num_rows:
                continue
            runs = pc.run_end_encode(batch.column(0))
            ends = runs.run_ends.to_numpy().astype(np.int64)
            starts = np.r_[0, ends[:-1]]
            values = runs.values.to_pylist()
            base = np.zeros(len(ends), np.int64)
            if (values[0],) == last:
                base[0] = seen
            nth = np.arange(batch.num_rows) - np.repeat(starts - base, ends - starts)
            last, seen = (values[-1],), int(nth[-1]) + 1
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(nth)], names=[*batch.schema.names, "nth"])

    ddl = ", ".join(f"{n} {t}" for n, t in dealt.dtypes)
    dealt = stage(dealt.mapInArrow(run, f"{ddl}, nth long"), f"{name}-sorted")
    release(leaves)
    counts = dealt.groupBy("grp", "part").agg(F.count("*").alias("n"))
    group = Window.partitionBy("grp")
    before = group.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(F.col("grp").alias("g"), F.col("part").alias("p"), F.sum("n").over(group).alias("total"),
                           F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    return (dealt.join(counts, F.col("grp").eqNullSafe(F.col("g")) & (F.col("part") == F.col("p")))
            .withColumn("place", F.col("base") + F.col("nth")).drop("g", "p", "base", "part", "nth")
            .withColumn("block", F.expr(f"place div {FANOUT ** block_levels}")))


def _levels_of(block: pa.Table, block_levels: int) -> tuple[pa.Table, list[list[str]]]:
    """The block in order, and its levels; a group of a single block climbs to its root."""
    block, alone = block.sort_by("place"), block["total"][0].as_py() <= FANOUT ** block_levels
    return block, climb([x.hex() for x in block["leaf"].to_pylist()], None if alone else block_levels)


def block_roots(leaves: DataFrame, block_levels: int) -> DataFrame:
    """grp, block, blocks (of the group), root (of the block's subtree), upper (nothing yet)."""
    def make(block: pa.Table) -> pa.Table:
        block, levels = _levels_of(block, block_levels)
        return pa.table({"grp": block["grp"][:1], "block": block["block"][:1], "total": block["total"][:1],
                         "root": pa.array(levels[-1], pa.string())})

    return (leaves.select("grp", "leaf", "place", "total", "block").groupBy("grp", "block")
            .applyInArrow(make, "grp string, block long, total long, root string")
            .selectExpr("grp", "block", f"(total + {FANOUT ** block_levels - 1}) div {FANOUT ** block_levels} as blocks",
                        "root", f"cast(array() as {_PATH}) as upper"))


def exchange(blocks: DataFrame, r: int) -> DataFrame:
    """Round ``r``: swap subtree roots between the blocks that differ in digit ``r`` alone."""
    s = FANOUT ** r  # blocks below a node of this round
    nodes = f"(blocks + {s - 1}) div {s}"
    state = blocks.selectExpr("*", f"block div {s} as node", f"block % {s} as low", f"{nodes} as nodes")
    done = state.where("nodes = 1").select(blocks.columns)
    # A short last subtree answers for the numbers it lacks, if it has siblings.
    sent = state.where("nodes > 1").selectExpr(
        "*", f"node div {FANOUT} as high", f"""explode(if(least({s}, blocks - node * {s}) = {s} or
            least({FANOUT}, nodes - node div {FANOUT} * {FANOUT}) = 1,
            array(low), sequence(low, {s - 1}L, least({s}, blocks - node * {s})))) as line""")
    met = sent.groupBy("grp", "blocks", "high", "line").agg(F.sort_array(F.collect_list(
        F.struct("node", "root", F.expr("line = low").alias("own"), "block", "upper"))).alias("run"))

    def side(sign: str) -> str:
        return f"array_join(transform(filter(run, x -> x.node {sign} me.node), x -> x.root), '')"

    return done.unionByName(
        met.selectExpr("grp", "blocks", "run", "explode(filter(run, x -> x.own)) as me").selectExpr(
            "grp", "me.block as block", "blocks", "sha2(array_join(transform(run, x -> x.root), ''), 256) as root",
            f"concat(me.upper, array(named_struct('left', {side('<')}, 'right', {side('>')}))) as upper"))


def butterfly(blocks: DataFrame, name: str) -> DataFrame:
    """All rounds: ``root`` is the group's, ``upper`` the path from the block's root to it."""
    start = blocks = stage(blocks, f"{name}-blocks")
    most, r = blocks.agg(F.max("blocks")).first()[0] or 0, 0
    while most > FANOUT ** r:
        blocks, r = exchange(blocks, r), r + 1
    if r:
        blocks = stage(blocks, f"{name}-met")
        release(start)
    return blocks


def manifest(docs: DataFrame, fields: list[str], group_col: str, key_col: str,
             changed: dict[str, str] | None = None, when: str = "false", with_path: bool = True,
             block_levels: int = 4) -> DataFrame:
    """key, leaf, subroot, root, proof_sha256, folded_root, verified of every row and, ``with_path``, path.

    ``fields`` are the columns that a leaf covers. A path is, level by level up to the
    root, the left and the right siblings, joined. ``folded_root`` is what the path
    makes of the row as it is now: where ``when`` holds, with the values of the
    expressions of ``changed`` (column name to SQL over the columns' names in
    ``fields``); the others fold their own leaf.
    """
    plain = numbered(docs)
    at = {f: column(docs, f) for f in {*fields, group_col, key_col}}
    known = plain.select(*(F.col(c).alias(f) for f, c in at.items()))
    original = leaf_digest([F.col(f) for f in fields])
    now = leaf_digest([F.expr((changed or {}).get(f, f"`{f}`")) for f in fields])
    leaves = known.select(
        F.col(group_col).cast("string").alias("grp"), F.col(key_col).cast("long").alias("key"),
        F.unhex(original).alias("leaf"),
        F.when(F.expr(when), F.unhex(now)).alias("now"))
    leaves = placed(leaves, "rows", block_levels)
    blocks = butterfly(block_roots(leaves, block_levels), "rows")

    # The tree over the groups: its rows are few, its making is the same.
    tops = placed(blocks.where("block = 0").select(F.lit(None).cast("string").alias("grp"), F.col("grp").alias("key"),
                                                   F.unhex("root").alias("leaf")), "groups", block_levels)
    top_blocks = butterfly(block_roots(tops, block_levels), "groups")

    def top_paths(nodes: pa.Table, above: pa.Table) -> pa.Table:
        if not nodes.num_rows:
            return pa.table({"g": pa.array([], pa.string()), "top": pa.array([], pa.string()),
                             "above": pa.array([], _path_type())})
        nodes, levels = _levels_of(nodes, block_levels)
        upper = [(x["left"], x["right"]) for x in above["upper"][0].as_py()]
        paths = [_structs([*p, *upper]) for p in local_paths(levels)]
        return pa.table({"g": nodes["key"], "top": pa.array([above["root"][0].as_py()] * len(paths), pa.string()),
                         "above": pa.array(paths, _path_type())})

    tops = (tops.groupBy("grp", "block").cogroup(top_blocks.groupBy("grp", "block"))
            .applyInArrow(top_paths, f"g string, top string, above {_PATH}"))
    blocks = blocks.join(tops, F.col("grp").eqNullSafe(F.col("g"))).selectExpr(
        "grp", "block", "root as subroot", "top as root", "concat(upper, above) as upper")

    def prove(rows: pa.Table, above: pa.Table) -> pa.Table:
        if not rows.num_rows:
            return empty
        rows, levels = _levels_of(rows, block_levels)
        root = above["root"][0].as_py()
        upper = [(x["left"], x["right"]) for x in above["upper"][0].as_py()]
        upper_text = "".join(a + b for a, b in upper)
        proofs, folded, paths = [], [], []
        for leaf, new, lower in zip(levels[0], rows["now"].to_pylist(), local_paths(levels)):
            proofs.append(digest("".join(a + b for a, b in lower) + upper_text))
            folded.append(fold(leaf if new is None else new.hex(), lower + upper))
            if with_path:
                paths.append(_structs(lower + upper))
        out = {"key": rows["key"], "leaf": pa.array(levels[0], pa.string()),
               "subroot": pa.array([above["subroot"][0].as_py()] * len(folded), pa.string()),
               "root": pa.array([root] * len(folded), pa.string()), "proof_sha256": pa.array(proofs, pa.string()),
               "folded_root": pa.array(folded, pa.string()), "verified": pa.array([f == root for f in folded], pa.bool_())}
        return pa.table(out | ({"path": pa.array(paths, _path_type())} if with_path else {}))

    names = ["leaf", "subroot", "root", "proof_sha256", "folded_root"]
    empty = pa.table({"key": pa.array([], pa.int64()), **{n: pa.array([], pa.string()) for n in names},
                      "verified": pa.array([], pa.bool_()), **({"path": pa.array([], _path_type())} if with_path else {})})
    return (leaves.groupBy("grp", "block").cogroup(blocks.groupBy("grp", "block"))
            .applyInArrow(prove, "key long, " + ", ".join(f"{n} string" for n in names) + ", verified boolean"
                          + (f", path {_PATH}" if with_path else "")))


def _path_type() -> pa.DataType:
    return pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))


def _structs(path: list[tuple[str, str]]) -> list[dict[str, str]]:
    return [{"left": a, "right": b} for a, b in path]


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, roots, proof and check of every document, a third of them lower-cased before the check."""
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return manifest(documents(spark, sf_dir), ["doc_id", "source", "lang", "n_chars", "text"], "lang", "doc_id",
                    changed={"text": lower}, when="crc32(encode(string(doc_id), 'UTF-8')) % 3 = 0",
                    with_path=False).withColumnRenamed("key", "doc_id")


#: The same in DuckDB: all levels of the trees one after the other, all leaves folded by recursion.
ORACLE = r"""
with recursive fields as (select row_number() over () as row, doc_id, source, lang, n_chars, text,
    (select list_reduce(list_concat([4294967295::ubigint], list_transform(range(0, 8 * length(doc_id::varchar)), lambda k: k::ubigint)),
      lambda c, k: (case when xor(c, case when k % 8 = 0 then ascii(substr(doc_id::varchar, (k // 8)::int + 1, 1))::ubigint else 0::ubigint end) % 2 = 1
        then xor(xor(c, case when k % 8 = 0 then ascii(substr(doc_id::varchar, (k // 8)::int + 1, 1))::ubigint else 0::ubigint end) // 2, 3988292384::ubigint)
        else xor(c, case when k % 8 = 0 then ascii(substr(doc_id::varchar, (k // 8)::int + 1, 1))::ubigint else 0::ubigint end) // 2 end))) as c
  from documents),
known as (select row, doc_id, lang, doc_id is not null and xor(c, 4294967295::ubigint) % 3 = 0 as other,
    coalesce(strlen(doc_id::varchar) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
      || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::varchar) || ':' || n_chars, '-') as head,
    text, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as low from fields),
leaves as (select row, doc_id, lang, sha256(head || coalesce(strlen(text) || ':' || text, '-')) as leaf,
    case when other then sha256(head || coalesce(strlen(low) || ':' || low, '-'))
      else sha256(head || coalesce(strlen(text) || ':' || text, '-')) end as now from known),
placed as (select *, row_number() over (partition by lang order by doc_id nulls first, leaf) - 1 as place,
    count(*) over (partition by lang) as n from leaves),
tree as (select lang, 0 as level, place, n, leaf as h from placed
  union all select lang, level + 1, place // 8, (max(n) + 7) // 8, sha256(string_agg(h, '' order by place))
    from tree where n > 1 group by lang, level, place // 8),
subroots as (select lang, h as subroot, level as height, row_number() over (order by lang nulls first) - 1 as place,
    count(*) over () as n from tree where n = 1),
top as (select 0 as level, place, n, subroot as h from subroots
  union all select level + 1, place // 8, (max(n) + 7) // 8, sha256(string_agg(h, '' order by place))
    from top where n > 1 group by level, place // 8),
near as (select p.row, t.level, coalesce(string_agg(t.h, '' order by t.place) filter (t.place < p.place // pow(8, t.level)::bigint), '') as l,
    coalesce(string_agg(t.h, '' order by t.place) filter (t.place > p.place // pow(8, t.level)::bigint), '') as r
  from placed p join tree t on t.lang is not distinct from p.lang and t.n > 1
    and t.place // 8 = p.place // pow(8, t.level + 1)::bigint group by p.row, t.level
  union all select p.row, s.height + t.level,
    coalesce(string_agg(t.h, '' order by t.place) filter (t.place < s.place // pow(8, t.level)::bigint), ''),
    coalesce(string_agg(t.h, '' order by t.place) filter (t.place > s.place // pow(8, t.level)::bigint), '')
  from placed p join subroots s on s.lang is not distinct from p.lang join top t on t.n > 1
    and t.place // 8 = s.place // pow(8, t.level + 1)::bigint group by p.row, s.height, t.level),
proofs as (select row, sha256(string_agg(l || r, '' order by level)) as proof from near group by row),
folded as (select row, 0 as level, now as h from placed
  union all select f.row, f.level + 1, sha256(n.l || f.h || n.r) from folded f join near n on n.row = f.row and n.level = f.level),
ends as (select row, arg_max(h, level) as h from folded group by row)
select p.doc_id, p.leaf, s.subroot, t.h as root, coalesce(pr.proof, sha256('')) as proof_sha256, e.h as folded_root,
    e.h = t.h as verified
from placed p join subroots s on s.lang is not distinct from p.lang join ends e on e.row = p.row
left join proofs pr on pr.row = p.row cross join (select h from top where n = 1) t"""
