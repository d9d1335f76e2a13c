"""Shards, hard negatives and the manifest, against plain versions."""

from __future__ import annotations

import hashlib
import math
import random
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tallybook.llm import hard_negatives, merkle, sharding

from .helpers import SCHEMA, clashing, edge_rows, frame, prose, rows_of, write_docs


# --- shards ---------------------------------------------------------------

def shards_plain(rows, n_buckets, n_shards, seed):
    """(id, text, shard, slot) of (at, key, id, text): buckets shuffled one by one, then cut."""
    stream = []
    for bucket in range(n_buckets):
        own = sorted(r for r in rows if r[1] % n_buckets == bucket)
        own.sort(key=lambda r: (r[1], r[0]))
        rng = np.random.default_rng([seed, bucket])
        place = list(range(len(own)))
        draws = rng.integers(0, np.arange(len(own) - 1, 0, -1) + 1) if len(own) > 1 else []
        for i, j in zip(range(len(own) - 1, 0, -1), draws):
            place[i], place[int(j)] = place[int(j)], place[i]
        stream += [own[p] for p in place]
    out, at = [], 0
    for s in range(n_shards):
        size = len(stream) // n_shards + (s < len(stream) % n_shards)
        out += [(r[2], r[3], s, k) for k, r in enumerate(stream[at:at + size])]
        at += size
    return sorted(out, key=repr)


def corpus(n=300):
    rnd = random.Random(4)
    rows = edge_rows(rnd) + [(k, prose(rnd, rnd.randint(1, 60))) for k in range(100, 100 + n)]
    return rows + [(7, "the same text of a third")] * (n // 2) + [(None, None)] * 20


def test_shards_against_a_plain_shuffle(spark):
    docs = frame(spark, corpus())
    got = sharding.sharded(docs, n_shards=7, seed=3, bucket_bytes=5000).cache()
    keyed = sharding.scattered(docs.toDF(*(f"__c{k}" for k in range(5))), "__c0", 1, 3).collect()
    n_buckets = math.ceil(sum(8 + 8 * 2 + sum(len((r[f"__c{k}"] or "").encode()) for k in (1, 2, 3)) for r in keyed) / 5000)
    assert n_buckets > 10
    plain = shards_plain([(r["__at"], r["__key"], r["__c0"], r["__c1"]) for r in keyed], n_buckets, 7, 3)
    assert sorted(((r["doc_id"], r["text"], r["__shard"], r["__slot"]) for r in got.collect()), key=repr) == plain


def test_law_of_rows_and_spread_of_a_hot_id(spark):
    docs = frame(spark, corpus(600))
    rows = sharding.sharded(docs, bucket_bytes=3000).collect()
    count = Counter(r["__shard"] for r in rows)
    assert set(count) == set(range(24)) and max(count.values()) - min(count.values()) <= 1
    for s in count:
        assert sorted(r["__slot"] for r in rows if r["__shard"] == s) == list(range(count[s]))
    assert Counter((r["doc_id"], r["text"]) for r in rows) == Counter((r["doc_id"], r["text"]) for r in docs.collect())
    hot = Counter(r["__shard"] for r in rows if r["text"] == "the same text of a third")
    assert len(hot) == 24 and max(hot.values()) < 3 * sum(hot.values()) / 24
    again, other = (sharding.sharded(docs, bucket_bytes=3000, seed=s).collect() for s in (7, 8))
    order = [[(r["__shard"], r["__slot"], r["doc_id"]) for r in x] for x in (rows, again, other)]
    assert sorted(order[0], key=repr) == sorted(order[1], key=repr) != sorted(order[2], key=repr)


def test_first_rows_over_groups_of_buckets(spark):
    counts = {b: (b * 7) % 5 + 1 for b in range(0, 60, 2)}
    buckets = spark.createDataFrame([(b,) for b, n in counts.items() for _ in range(n)], "__bucket long")
    want, at = {}, 0
    for b, n in sorted(counts.items()):
        want[b], at = at, at + n
    assert {r["__bucket"]: r["__first"] for r in sharding.first_rows(buckets, together=8).collect()} == want


def test_sharding_query_and_files(spark, tmp_path):
    docs = clashing(frame(spark, corpus()), more=["__shard", "slot"])
    rows = entry.queries()["op11_sharding"](spark, write_docs(docs, tmp_path / "in")).collect()
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == Counter(
        (i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in corpus())
    assert {(r["law"], r["grown_shard"]) for r in rows} == {("rows", None)}
    small = frame(spark, [(k, f"text {k}") for k in range(10)])
    sharding.write_shards(small, f"{tmp_path}/shards", n_shards=4)
    back = spark.read.parquet(f"{tmp_path}/shards")
    assert sorted(back.groupBy("__shard").count().collect()) == [(0, 3), (1, 3), (2, 2), (3, 2)]
    assert back.count() == 10 and {r["text"] for r in back.collect()} == {f"text {k}" for k in range(10)}


def test_few_rows_and_none(spark):
    rows = sharding.sharded(frame(spark, [(1, "a"), (2, None), (3, "")])).collect()
    assert sorted((r["__shard"], r["__slot"]) for r in rows) == [(0, 0), (1, 0), (2, 0)]
    empty = sharding.sharded(frame(spark, []))
    assert empty.collect() == [] and empty.columns == ["doc_id", "text", "lang", "source", "n_chars", "__shard", "__slot"]


# --- hard negatives ---------------------------------------------------------

def negatives_plain(rows, anchor, n_pos=5, n_neg=3, low=50, high=95):
    """rows: (id, vector, label) that take part, ids may repeat."""
    whole = [(i, [math.floor(256 * x) for x in v], lab) for i, v, lab in rows
             if lab is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    last = 1 << 63
    out = []
    for a, (ident, q, lab) in enumerate(whole):
        if ident is None or not anchor(ident, lab):
            continue
        scored = sorted((-sum(x * y for x, y in zip(q, p)), last if i is None else i, b, i, other)
                        for b, (i, p, other) in enumerate(whole) if b != a)
        for s, _, _, i, other in [x for x in scored if x[4] == lab][:n_pos]:
            band = [x for x in scored if x[4] != lab and low * -s <= 100 * -x[0] <= high * -s][:n_neg]
            out += [(ident, i, k + 1, x[3], -s, -x[0]) for k, x in enumerate(band)]
    return sorted(out, key=repr)


VECTORS = "vec_id long, embedding array<float>, label int"


def vectors(rnd, n, dim=6, centres=5, spread=0.3):
    at = [[rnd.gauss(0, 1) for _ in range(dim)] for _ in range(centres)]
    out = []
    for k in range(n):
        c = rnd.randrange(centres)
        v = [float(np.float32(x + rnd.gauss(0, spread))) for x in at[c]]
        out.append((k, v, rnd.randrange(3) if rnd.random() < 0.9 else None))
    return out


@pytest.mark.parametrize("part", [40, 100_000])
def test_negatives_against_all_pairs(spark, part):
    rnd = random.Random(6)
    rows = vectors(rnd, 300)
    hot = rows[10][1]
    rows += [(1000 + k, hot, k % 4) for k in range(100)]  # a third is one vector
    rows += [(7, rows[7][1], rows[7][2]), (7, rows[7][1], rows[7][2]), (None, hot, 1), (None, [1.0] * 6, 2),
             (2000, None, 1), (2001, [1.0, None, 2.0, 0.0, 0.0, 0.0], 1), (2002, [float("nan")] * 6, 1),
             (2003, [float("inf")] * 6, 1), (2004, [], 1), (2005, [0.0] * 6, 1), (2006, [1.0, -2.0], 1),
             (2010, [-0.001] * 9, 0), (-10, hot, 0)]
    df = spark.createDataFrame(rows, VECTORS).select("*", *(F.lit("x").alias(n) for n in ("LABEL", "Vec_Id", "row", "q", "slots", "grp")))
    got = hard_negatives.hard_negatives(df, F.col("vec_id") % 10 == 0, part=part)
    assert rows_of(got) == negatives_plain(rows, lambda i, lab: i % 10 == 0)


def test_scores_beyond_doubles(spark):
    rnd = random.Random(8)
    rows = [(k, [rnd.gauss(0, 1e6) for _ in range(4)], k % 2) for k in range(40)]
    assert max(abs(math.floor(256 * x)) for _, v, _ in rows for x in v) ** 2 > 2 ** 53
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = hard_negatives.hard_negatives(df, F.col("vec_id") % 5 == 0)
    assert rows_of(got) == negatives_plain(rows, lambda i, lab: i % 5 == 0)


def test_walk_stops_early_on_clustered_vectors():
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(20, 32))
    own = rng.integers(0, 20, 20_000)
    q = np.floor(256 * (centres[own] + 0.05 * rng.normal(size=(20_000, 32))))
    cands = {"row": np.arange(20_000), "ident": np.arange(20_000), "label": own % 3, "q": q}
    at = np.flatnonzero(own == 4)[:50]
    members = {"row": at, "label": own[at] % 3, "q": q[at], "low": np.full((50, 1), -np.inf, object), "high": np.full((50, 1), np.inf, object)}
    centroid = hard_negatives.fit(q[at], 1)[0]
    found, scored = hard_negatives.walk(members, cands, centroid, True, 5)
    assert scored <= 50 * 4096  # of 50 * 20,000 pairs
    small, _ = hard_negatives.walk(members, cands, centroid, True, 5, block=100)
    assert (small.place == found.place).all() and (small.member == found.member).all()
    s = q[at] @ q.T
    for m in range(50):
        ok = [c for c in np.lexsort((np.arange(20_000), -s[m])) if own[c] % 3 == own[at[m]] % 3 and c != at[m]][:5]
        assert cands["row"][found.place[found.member == m]].tolist() == ok


def test_negatives_query_and_sql(spark, tmp_path):
    rnd = random.Random(9)
    rows = vectors(rnd, 400, dim=8)
    spark.createDataFrame(rows, VECTORS).write.parquet(f"{tmp_path}/embeddings.parquet")
    twisted = [(i, v, (lab + 1) % 10 if lab is not None and i % 7 == 0 else lab) for i, v, lab in rows]
    got = entry.queries()["op12_hard_negatives"](spark, str(tmp_path))
    assert dict(got.dtypes) == {"anchor_id": "bigint", "positive_id": "bigint", "rank": "int", "negative_id": "bigint",
                                "positive_score": "bigint", "negative_score": "bigint"}
    want = negatives_plain(twisted, lambda i, lab: i % 50 == 0)
    assert rows_of(got) == want and want
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from '{tmp_path}/embeddings.parquet/*.parquet'")
    assert sorted(con.sql(entry.oracle_sql()["op12_hard_negatives"]).fetchall(), key=repr) == want


def test_negatives_of_nothing(spark):
    empty = spark.createDataFrame([], VECTORS)
    assert hard_negatives.hard_negatives(empty, F.col("vec_id") % 2 == 0).collect() == []
    alone = spark.createDataFrame([(0, [1.0], 1), (1, None, 2)], VECTORS)
    assert hard_negatives.hard_negatives(alone, F.col("vec_id") % 2 == 0).collect() == []


# --- manifest ---------------------------------------------------------------

def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def tree_plain(nodes):
    """The root, and per leaf the (left, right) siblings level by level."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for k, a in enumerate(at):
            start = a // 8 * 8
            paths[k].append(("".join(nodes[start:a]), "".join(nodes[a + 1:start + 8])))
        nodes = [sha("".join(nodes[k:k + 8])) for k in range(0, len(nodes), 8)]
        at = [a // 8 for a in at]
    return nodes[0], paths


def manifest_plain(rows):
    """rows: (doc_id, text, lang, source, n_chars)."""
    def leaf(i, text, lang, source, n):
        said = [None if x is None else str(x) for x in (i, source, lang, n, text)]
        return sha("".join("-" if x is None else f"{len(x.encode())}:{x}" for x in said))

    langs = sorted({r[2] for r in rows}, key=lambda g: (g is not None, (g or "").encode()))
    trees, out = {}, []
    for g in langs:
        own = sorted((r for r in rows if r[2] == g), key=lambda r: (r[0] is not None, r[0] or 0, leaf(*r)))
        trees[g] = (own, *tree_plain([leaf(*r) for r in own]))
    root, above = tree_plain([trees[g][1] for g in langs]) if langs else (None, [])
    for g, top in zip(langs, above):
        own, sub, paths = trees[g]
        for r, path in zip(own, paths):
            whole, now = path + top, r
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0 and r[1] is not None:
                now = (r[0], "".join(c.lower() if "A" <= c <= "Z" else c for c in r[1]), *r[2:])
            at = leaf(*now)
            for a, b in whole:
                at = sha(a + at + b)
            out.append((r[0], leaf(*r), sub, root, sha("".join(a + b for a, b in whole)), at, at == root))
    return sorted(out, key=repr)


def manifest_of(spark, rows, **options):
    df = spark.createDataFrame(rows, SCHEMA).select("doc_id", "text", "lang", "source", "n_chars")
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return merkle.manifest(clashing(df, more=["leaf", "root"]).select("*", F.lit(1).alias("grp")),
                           ["doc_id", "source", "lang", "n_chars", "text"], "lang", "doc_id", changed={"text": lower},
                           when="crc32(encode(string(doc_id), 'UTF-8')) % 3 = 0", **options)


def records(rnd, sizes):
    rows = []
    for lang, n in sizes.items():
        rows += [(rnd.randrange(-50, 10_000), rnd.choice(["Some Text", "é Übung", None, "", "x" * 50]) if rnd.random() < 0.5
                  else prose(rnd, 3).title(), lang, rnd.choice(["s", None]), rnd.choice([1, None, 77])) for _ in range(n)]
    return rows


@pytest.mark.parametrize("levels,sizes", [
    (1, {"en": 700, "de": 65, None: 8, "": 9, "z": 1, "é": 513}), (2, {"en": 700, "de": 64, None: 1}),
    (4, {"en": 300}), (1, {f"l{k}": k % 11 + 1 for k in range(70)}), (1, {"en": 1}), (1, {"en": 8}), (1, {"en": 4097})])
def test_manifest_against_a_plain_tree(spark, levels, sizes):
    rnd = random.Random(levels)
    rows = records(rnd, sizes) + [(6, "A Very Long Text " * 20_000, next(iter(sizes)), "s", 1), (5, "Twice", next(iter(sizes)), "s", 1)] * 3 + [(None, "No Id", next(iter(sizes)), None, None)] * 2
    got = manifest_of(spark, rows, with_path=False, block_levels=levels).collect()
    assert sorted((tuple(r) for r in got), key=repr) == manifest_plain(rows)


def test_paths_fold_to_the_root(spark):
    rows = records(random.Random(2), {"en": 90, "de": 30})
    for r in manifest_of(spark, rows, block_levels=1).collect():
        path = [(x["left"], x["right"]) for x in r["path"]]
        assert merkle.fold(r["leaf"], path) == r["root"] and sha("".join(a + b for a, b in path)) == r["proof_sha256"]
        assert (merkle.fold("0" * 64, path) == r["root"]) is False


def test_a_hot_row_and_no_rows(spark):
    rows = [(3, "The same", "en", "s", 8)] * 200 + records(random.Random(3), {"en": 300})
    got = manifest_of(spark, rows, with_path=False, block_levels=1).collect()
    assert sorted((tuple(r) for r in got), key=repr) == manifest_plain(rows)
    assert manifest_of(spark, []).collect() == []


def test_rounds_move_two_rows_a_block_at_the_most(spark):
    """The exchange sends each block's root to as many lines as its subtree answers for."""
    blocks = spark.createDataFrame([("g", b, 701, sha(str(b))) for b in range(701)], "grp string, block long, blocks long, root string")
    blocks = blocks.selectExpr("*", "cast(array() as array<struct<left:string,right:string>>) as upper")
    for r in range(4):
        blocks = merkle.exchange(blocks, r)
    rows = blocks.collect()
    root, paths = tree_plain([sha(str(b)) for b in range(701)])
    assert len(rows) == 701 and {r["root"] for r in rows} == {root}
    assert {r["block"]: [(x["left"], x["right"]) for x in r["upper"]] for r in rows} == dict(enumerate(paths))


def test_manifest_query_and_sql(spark, tmp_path):
    rows = records(random.Random(5), {"en": 120, "de": 9, None: 2, "fr": 1}) + [(None, "No Id", "en", "s", 1)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    rows = [(r["doc_id"], r["text"], r["lang"], r["source"], r["n_chars"]) for r in spark.createDataFrame(rows, SCHEMA).collect()]
    got = entry.queries()["op13_merkle_manifest"](spark, str(tmp_path))
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    want = manifest_plain(rows)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == want
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    assert sorted(con.sql(entry.oracle_sql()["op13_merkle_manifest"]).fetchall(), key=repr) == want
