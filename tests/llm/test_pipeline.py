"""The corpus pipeline, stage by stage, against plain versions."""

from __future__ import annotations

import random

import corpus_pipeline
import __spark_entry__ as entry
from tallybook.llm import quality

from .helpers import SCHEMA, edge_rows, frame, prose
from .test_across_documents import components_plain, leaks_plain, lines_plain, sha


def corpus(rnd):
    rows = [(k, prose(rnd, rnd.randint(60, 200)) + "\n" + rnd.choice(["a line that many documents share", "b line"])) for k in range(40)]
    rows += [(50 + k, rows[k][1].replace("the", "thee", 1)) for k in range(10)]
    rows += [(70 + k, "$$$ %%% " * 60) for k in range(3)]
    return rows + [(200 + k, t) for k, (_, t) in enumerate(edge_rows(rnd)) if t is None or len(t) < 31_000]


def test_stages_against_plain_versions(spark, tmp_path):
    rnd = random.Random(11)
    rows = corpus(rnd)
    items = [(1, prose(rnd, 20)), (2, rows[3][1].split("\n")[0][:150]), (3, "nothing of the kind appears in here at all")]
    frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    sf_dir, docs = str(tmp_path), spark.read.parquet(f"{tmp_path}/documents.parquet")
    names = docs.columns
    judge = quality.Judge(quality.references(docs))
    at = dict(rows)

    def ran(k, docs):
        out = corpus_pipeline.STAGES[k][1](spark, docs, sf_dir)
        if k < 4:
            assert out.columns == names
            path = f"{tmp_path}/stage{k}"
            out.write.parquet(path)
            out = spark.read.parquet(path)
        return out, {r["doc_id"]: r["text"] for r in out.collect()} if k < 4 else {r["doc_id"]: r for r in out.collect()}

    docs, left = ran(0, docs)
    assert left == {i: t for i, t in at.items() if judge(t or "", "en")[-1]} and set(range(40)) <= set(left)
    before = list(left.items())
    docs, left = ran(1, docs)
    assert sorted((i, sha(t.encode())) for i, t in left.items()) == [(i, h) for i, _, _, h in sorted(lines_plain(before))]
    assert all(r["n_chars"] == len(r["text"]) for r in docs.collect())
    before = list(left.items())
    docs, left = ran(2, docs)
    assert set(left) == {i for i, _, _, kept in components_plain(before, 5, 80) if kept} and len(left) < len(before)
    before = list(left.items())
    docs, left = ran(3, docs)
    assert set(left) == {i for i, _ in before} - {w[0] for w in leaks_plain(before, items)} and len(left) < len(before)
    _, last = ran(4, docs)
    assert {i: r["decoded_sha256"] for i, r in last.items()} == {i: sha(t.encode()) for i, t in left.items()}
    whole = {r["doc_id"]: r["ids_sha256"] for r in corpus_pipeline.run(spark, sf_dir).collect()}
    assert whole == {i: r["ids_sha256"] for i, r in last.items()}


def test_empty_documents(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_all_are_registered():
    names = list(entry.queries())
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)] == [1] * 13 and "pipeline" in names
    assert len(corpus_pipeline.STAGES) == 5
