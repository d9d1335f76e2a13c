"""Operator 12: hard negatives from lists shared by clusters of anchors.

1. Vectors are made whole: each component x becomes floor(256 * x), so that scores
   (inner products) are exact integers. Rows that take no part go.
2. Anchors are clustered by angle. Centroids are fitted on ``FIT`` anchors at the
   most, those of the least hashes; every anchor goes to its nearest centroid. The
   fit decides how long the lists are walked, never what is found.
3. Anchors in order of their clusters are cut into groups, candidates by a hash into
   parts; a task has a group and a part. For each cluster in the group it sorts its
   candidates once by the most that any member could score with them,

       |x| * cos(max(0, angle(centroid, x) - widest angle of a member)),

   and all members walk this list together, block by block. A member stops as soon as
   its own norm times the bound of the next candidate is below all that it still
   looks for: no candidate further down can belong to its result.
4. The first part is walked before the others, whose members start with what it found.
5. Positives first; then the negatives within the bands that the positives' scores set.
   What the parts found is ranked per anchor.

A group's candidates are sent once a group, an anchor once a part; a task holds
``GROUP`` anchors, ``PART`` candidates and a block of scores. Nothing but the
sample of the fit and 32 counts comes to the driver.

Defined results: rows with a null label, a null vector, or a null or non-finite
component take no part. Vectors of different lengths meet as if the shorter one went on
with zeros; empty vectors score 0. Rows are told apart, also where ids repeat: an
anchor's twin is another row. A null id is no anchor and comes last among ties. Scores
beyond 2 ** 53 are computed in whole numbers of any size; one beyond a long fails. An
empty table gives an empty result. Further columns, whatever their names, are left alone.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallybook.llm.common import column, numbered, stage

#: Anchors that the centroids are fitted on, centroids, anchors of a group, candidates of a part.
FIT, CLUSTERS, GROUP, PART = 2048, 32, 20_000, 65_536
#: Scores that a task holds at a time.
SCORES = 4 << 20
_LAST = np.iinfo(np.int64).max  # stands for a null id among ties


def prepared(vectors: DataFrame, id_col: str, vec_col: str, label_col: str, scale: int) -> DataFrame:
    """row, vec_id, label, q of the rows that take part, written."""
    plain = numbered(vectors)
    ident, vec, label = (plain[column(vectors, c)] for c in (id_col, vec_col, label_col))
    known = plain.select(ident.cast("long").alias("vec_id"), label.cast("long").alias("label"),
                         vec.cast("array<double>").alias("v"))
    # A double floor: a whole number as long as a double holds it.
    known = known.where("label is not null and v is not null and forall(v, x -> x is not null and not isnan(x) "
                        "and abs(x) < double('Infinity'))")
    return stage(known.selectExpr("monotonically_increasing_id() as row", "vec_id", "label",
                                  f"transform(v, x -> {scale} * x) as q"), "vectors")


def matrix(column_: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Rows of whole numbers, as doubles, the shorter ones followed by zeros."""
    if isinstance(column_, pa.ChunkedArray):
        column_ = column_.combine_chunks()
    sizes = column_.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = np.floor(column_.flatten().to_numpy(zero_copy_only=False))
    width = int(sizes.max(initial=0))
    if len(sizes) and (sizes == width).all():
        return flat.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width))
    out[np.arange(width) < sizes[:, None]] = flat
    return out


def _unit(m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of length one (or zero), and their lengths."""
    top = np.abs(m).max(1, initial=0)[:, None]
    safe = m / np.where(top > 0, top, 1)  # no overflow in the squares
    size = np.sqrt((safe * safe).sum(1))
    return safe / np.where(size > 0, size, 1)[:, None], size * top[:, 0]


def _wide(m: np.ndarray, width: int) -> np.ndarray:
    return m if m.shape[1] == width else np.pad(m, ((0, 0), (0, width - m.shape[1])))


def fit(m: np.ndarray, k: int, rounds: int = 5) -> np.ndarray:
    """Unit centroids of the rows' directions; the first ones are spread by farthest choice."""
    unit = _unit(m)[0]
    near = np.full(len(unit), -2.0)
    chosen = [0]
    for _ in range(1, min(k, len(unit))):
        near = np.maximum(near, unit @ unit[chosen[-1]])
        chosen.append(int(near.argmin()))
    centroids = unit[chosen]
    for _ in range(rounds):
        own = (unit @ centroids.T).argmax(1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, own, unit)
        found, size = _unit(sums)
        centroids = np.where(size[:, None] > 0, found, centroids)
    return centroids


@dataclass
class Found:
    """The best ``k`` of each slot so far: by score, then the smaller id."""
    slots: int
    k: int
    member: np.ndarray  # the slot of each
    score: np.ndarray
    ident: np.ndarray
    place: np.ndarray  # of the candidate

    @classmethod
    def none(cls, slots: int, k: int, kind) -> Found:
        return cls(slots, k, np.empty(0, np.int64), np.empty(0, kind), np.empty(0, np.int64), np.empty(0, np.int64))

    def add(self, member, score, ident, place) -> None:
        member, score = np.r_[self.member, member], np.r_[self.score, score]
        ident, place = np.r_[self.ident, ident], np.r_[self.place, place]
        order = np.lexsort((place, ident, -score, member))
        slot = member[order]
        first = np.flatnonzero(np.r_[True, slot[1:] != slot[:-1]])
        nth = np.arange(len(slot)) - np.repeat(first, np.diff(np.r_[first, len(slot)]))
        keep = order[nth < self.k]
        self.member, self.score, self.ident, self.place = member[keep], score[keep], ident[keep], place[keep]

    def last(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Slots that have ``k``, and the score and id of their last."""
        if not len(self.member):
            return self.member, self.score, self.ident
        full = np.bincount(self.member, minlength=self.slots)[self.member] == self.k
        end = np.r_[self.member[1:] != self.member[:-1], True] & full
        return self.member[end], self.score[end], self.ident[end]


def walk(members: dict, cands: dict, centroid: np.ndarray, same: bool, k: int, block: int = 2048) -> tuple[Found, int]:
    """The best ``k`` candidates of every member and slot, and how many pairs were scored.

    ``members``: row, label, q, low and high (scores of a slot's band, a column a
    slot; +inf as low: no slot). ``cands``: row, ident, label, q. Both ``q`` are as
    wide. ``same``: candidates of the member's own label, else of all others.
    """
    unit, norm = _unit(members["q"])
    cand_unit, cand_norm = cands["unit"] if "unit" in cands else _unit(cands["q"])
    block = max(1, min(block, SCORES // max(1, len(norm))))
    # Exact products: doubles where they hold every sum, whole numbers of any size elsewhere.
    top = np.abs(members["q"]).max(initial=0) * np.abs(cands["q"]).max(initial=0) * max(1, members["q"].shape[1])
    exact = (lambda m: m) if top < 2 ** 53 else np.vectorize(int, otypes=[object])
    kind = np.float64 if top < 2 ** 53 else object
    mq, cq = exact(members["q"]), exact(cands["q"])

    def angle(u):
        return np.arccos(np.clip(u @ centroid, -1, 1))

    theta = angle(unit).max(initial=0) if norm.all() else np.pi  # a zero vector has no angle
    bound = cand_norm * np.cos(np.clip(angle(cand_unit) - theta, 0, np.pi))
    order = np.lexsort((cands["ident"], -bound))
    slack = 1e-9 * norm * cand_norm.max(initial=0) + 1e-6
    n, slots = members["low"].shape
    need, tie = members["low"].astype(kind), np.full((n, slots), _LAST)
    high = members["high"].astype(kind)
    found, scored = Found.none(n * slots, k, kind), 0
    for at in range(0, len(order), block):
        live = np.flatnonzero(norm * bound[order[at]] + slack >= need.min(1).astype(float))
        if not len(live):
            break
        part = order[at:at + block]
        ident = cands["ident"][part]
        s = mq[live] @ cq[part].T
        scored += s.size
        usable = (members["label"][live, None] == cands["label"][part]) == same
        usable &= members["row"][live, None] != cands["row"][part]
        for slot in range(slots):
            least = need[live, slot, None]
            hit = usable & ((s > least) | ((s == least) & (ident <= tie[live, slot, None]))) & (s <= high[live, slot, None])
            r, c = np.nonzero(hit)
            if len(r):
                found.add(live[r] * slots + slot, s[r, c], ident[c], part[c])
        which, score, ident = found.last()
        need.flat[which], tie.flat[which] = score, ident
    return found, scored


def _slots(column_: pa.ChunkedArray, name: str, none: float) -> np.ndarray:
    lists = column_.to_pylist()
    wide = max((len(x) for x in lists), default=0)
    free = np.inf if name == "low" else -np.inf  # no such slot
    return np.array([[none if s[name] is None else s[name] for s in x] + [free] * (wide - len(x)) for x in lists],
                    object).reshape(len(lists), wide)


def _cell(centroids: np.ndarray, same: bool, k: int):
    schema = pa.schema([(n, pa.int64()) for n in ("row", "slot", "score", "vec_id", "found_row")])

    def run(anchors: pa.Table, cands: pa.Table) -> pa.Table:
        out = [pa.table({n: pa.array([], pa.int64()) for n in schema.names})]
        if anchors.num_rows and cands.num_rows:
            c = {"row": cands["row"].to_numpy(), "label": cands["label"].to_numpy(), "q": matrix(cands["q"]),
                 "ident": cands["vec_id"].fill_null(int(_LAST)).to_numpy()}
            width = max(c["q"].shape[1], centroids.shape[1], int(pc.max(pc.list_value_length(anchors["q"])).as_py()))
            c["q"] = _wide(c["q"], width)
            c["unit"] = _unit(c["q"])  # for all clusters
            cluster = anchors["cluster"].to_numpy()
            for number in np.unique(cluster):
                own = anchors.take(pa.array(np.flatnonzero(cluster == number)))
                m = {"row": own["row"].to_numpy(), "label": own["label"].to_numpy(), "q": _wide(matrix(own["q"]), width),
                     "low": _slots(own["slots"], "low", -np.inf), "high": _slots(own["slots"], "high", np.inf)}
                got, _ = walk(m, c, _wide(centroids[[number]], width)[0], same, k)
                slots = m["low"].shape[1]
                ident = cands["vec_id"].take(pa.array(got.place))
                out.append(pa.table({"row": pa.array(m["row"][got.member // max(slots, 1)]), "slot": pa.array(got.member % max(slots, 1)),
                                     "score": pa.array([int(x) for x in got.score], pa.int64()),
                                     "vec_id": ident.combine_chunks() if isinstance(ident, pa.ChunkedArray) else ident,
                                     "found_row": pa.array(c["row"][got.place])}))
        return pa.concat_tables([t.cast(schema) for t in out]).combine_chunks()

    return run


def best(anchors: DataFrame, vectors: DataFrame, centroids: np.ndarray, same: bool, k: int, n_parts: int, name: str) -> DataFrame:
    """row, slot, nth, score, vec_id, found_row: the first ``k`` of every anchor's slots.

    ``anchors``: row, label, q, cluster, grp, slots (array of low and high)."""
    groups = anchors.agg(F.max("grp")).first()[0]
    cands = (vectors.withColumn("part", F.pmod(F.xxhash64("row"), F.lit(n_parts)).cast("int"))
             .withColumn("grp", F.explode(F.sequence(F.lit(0), F.lit(groups or 0)))))

    def found(anchors: DataFrame, first: bool) -> DataFrame:
        low, high = (0, 0) if first else (1, n_parts - 1)
        dealt = anchors.withColumn("part", F.explode(F.sequence(F.lit(low), F.lit(high))))
        return (dealt.groupBy("grp", "part").cogroup(cands.where(F.col("part").between(low, high)).groupBy("grp", "part"))
                .applyInArrow(_cell(centroids, same, k), "row long, slot long, score long, vec_id long, found_row long"))

    def ranked(df: DataFrame) -> DataFrame:
        order = Window.partitionBy("row", "slot").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "found_row")
        return df.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= k)

    if groups is None:
        return ranked(found(anchors, True))
    start = stage(ranked(found(anchors, True)), f"{name}-first")
    if n_parts == 1:
        return start
    known = start.where(F.col("nth") == k).groupBy("row").agg(F.map_from_entries(F.collect_list(F.struct("slot", "score"))).alias("at"))
    better = (anchors.join(known.withColumnRenamed("row", "r"), F.col("row") == F.col("r"), "left")
              .withColumn("slots", F.expr("transform(slots, (s, i) -> struct(greatest(s.low, try_element_at(at, bigint(i))) as low, s.high as high))"))
              .drop("r", "at"))
    return stage(ranked(start.drop("nth").unionByName(found(better, False))), f"{name}-found")


def clustered(anchors: DataFrame) -> tuple[DataFrame, np.ndarray]:
    """Anchors with ``cluster`` and ``grp`` (``GROUP`` of them, about), and the centroids."""
    sample = anchors.select("row", "q").orderBy(F.xxhash64("row"), "row").limit(FIT).toArrow()
    if not sample.num_rows:
        none = anchors.withColumn("cluster", F.lit(0).cast("long")).withColumn("grp", F.lit(0))
        return stage(none, "anchors"), np.zeros((1, 0))
    centroids = fit(matrix(sample["q"]), min(CLUSTERS, -(-sample.num_rows // 32)))

    def run(batches):
        for batch in batches:
            q = matrix(batch.column(batch.schema.get_field_index("q")))
            width = max(q.shape[1], centroids.shape[1])
            own = (_unit(_wide(q, width))[0] @ _wide(centroids, width).T).argmax(1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(own.astype(np.int64))], names=[*batch.schema.names, "cluster"])

    ddl = ", ".join(f"{n} {t}" for n, t in anchors.dtypes)
    out = stage(anchors.mapInArrow(run, f"{ddl}, cluster long"), "anchors")
    counts = {r["cluster"]: r["count"] for r in out.groupBy("cluster").count().collect()}  # CLUSTERS at the most
    start, at = F.lit(0), 0
    size = F.lit(0)
    for number in sorted(counts):
        start = F.when(F.col("cluster") == number, at).otherwise(start)
        size = F.when(F.col("cluster") == number, counts[number]).otherwise(size)
        at += counts[number]
    # A place within the cluster by hash: groups hold neighbours, also where a cluster is all.
    place = start + size * F.pmod(F.xxhash64("row"), F.lit(1 << 20)) / (1 << 20)
    return out.withColumn("grp", F.floor(place / GROUP).cast("int")), centroids


def hard_negatives(vectors: DataFrame, is_anchor: Column, id_col: str = "vec_id", vec_col: str = "embedding",
                   label_col: str = "label", n_positives: int = 5, n_negatives: int = 3, low: int = 50, high: int = 95,
                   scale: int = 256, part: int = PART) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``is_anchor`` is over vec_id and label. Of each anchor the first ``n_positives``
    other rows of its label, and for each of these the first ``n_negatives`` rows of
    other labels with ``low`` * positive <= 100 * negative <= ``high`` * positive.
    """
    known = prepared(vectors, id_col, vec_col, label_col, scale)
    n = known.count()
    n_parts = max(1, -(-n // part), min(64, -(-n // 4096)))
    anchors, centroids = clustered(known.where(is_anchor))
    open_band = F.array(F.struct(F.lit(None).cast("long").alias("low"), F.lit(None).cast("long").alias("high")))
    positives = best(anchors.withColumn("slots", open_band), known, centroids, True, n_positives, n_parts, "positives")
    exact = "cast(score as decimal(19, 0))"
    band = f"struct(bigint(ceil({exact} * {low} / 100)) as low, bigint(floor({exact} * {high} / 100)) as high)"
    own = (positives.withColumn("at", F.struct("nth", F.expr(band).alias("band"))).groupBy(F.col("row").alias("r"))
           .agg(F.expr("transform(sort_array(collect_list(at)), x -> x.band)").alias("slots")))
    banded = anchors.join(own, F.col("row") == F.col("r")).drop("r")
    negatives = best(banded, known, centroids, False, n_negatives, n_parts, "negatives")
    return (negatives.select("row", (F.col("slot") + 1).alias("nth"), F.col("nth").cast("int").alias("rank"),
                             F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
            .join(positives.select("row", F.col("nth").cast("long").alias("nth"), F.col("vec_id").alias("positive_id"),
                                   F.col("score").alias("positive_score")), ["row", "nth"])
            .join(anchors.select("row", F.col("vec_id").alias("anchor_id")), "row")
            .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's negatives: labels of every seventh id moved on by one, every fiftieth id an anchor."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").selectExpr(
        "vec_id", "embedding", "if(vec_id % 7 = 0, (label + 1) % 10, label) as label")
    return hard_negatives(vectors, F.col("vec_id") % 50 == 0)


#: The same in DuckDB: all pairs of anchors and rows.
ORACLE = """
with rows as (select row_number() over () as row, vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
    list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as q
  from embeddings where label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0),
scores as (select a.row as a, a.vec_id as anchor_id, a.label = b.label as same, b.row as b, b.vec_id,
    cast(coalesce(list_sum(list_transform(range(1, least(len(a.q), len(b.q)) + 1), lambda i: a.q[i] * b.q[i])), 0) as bigint) as score
  from rows a join rows b on a.row <> b.row where a.vec_id % 50 = 0),
positives as (select *, row_number() over (partition by a order by score desc, vec_id, b) as nth from scores where same
  qualify nth <= 5),
negatives as (select p.anchor_id, p.vec_id as positive_id, n.vec_id as negative_id, p.score as positive_score, n.score as negative_score,
    cast(row_number() over (partition by p.a, p.nth order by n.score desc, n.vec_id, n.b) as integer) as rank
  from positives p join scores n on n.a = p.a and not n.same and 50 * p.score <= 100 * n.score and 100 * n.score <= 95 * p.score)
select anchor_id, positive_id, rank, negative_id, positive_score, negative_score from negatives where rank <= 3"""
