"""What Python workers hold: one worker per task, nothing kept for another operator."""

from __future__ import annotations

import re

import pyarrow as pa

from capsight.llm import bpe, common, ngram_join


def python_steps(plan: str) -> int:
    """The most Python steps between two exchanges: the workers that one task needs at once."""
    most = now = 0
    for line in plan.splitlines():
        if re.search(r"\b(Exchange|Scan)\b", line):
            now = 0
        elif re.search(r"MapInArrow|FlatMapGroupsInArrow|MapInPandas|ArrowEvalPython", line):
            now += 1
            most = max(most, now)
    return most


def test_tasks_of_the_ngram_join_need_one_worker(spark, monkeypatch):
    plans = {}

    def noting(df, name, write=common.materialize):
        plans.setdefault(name, []).append(python_steps(df._jdf.queryExecution().executedPlan().toString()))
        return write(df, name)

    monkeypatch.setattr(common, "materialize", noting)
    monkeypatch.setattr(ngram_join, "materialize", noting)
    words = [f"w{i}" for i in range(200)]
    texts = [" ".join(words[k:k + 60]) for k in (0, 1, 2, 100, 101)] + ["alone " * 3, "", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    rows = {r["doc_id"]: (r["component_id"], r["n_links"]) for r in ngram_join.ngram_join(docs).collect()}
    assert rows == {0: (0, 2), 1: (0, 2), 2: (0, 2), 3: (3, 1), 4: (3, 1), 5: (5, 0), 6: (6, 0), 7: (7, 0)}
    assert "edges" in plans and max(max(x) for x in plans.values()) == 1, plans


def test_contracted_edges_give_the_same_components(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (7, 5), (5, 7), (9, 9), (-4, 8), (8, 7)], "u long, v long").repartition(2)
    both = [{r["node"]: r["component"] for r in common.connected_components(x, done).collect()}
            for x, done in ((edges, False), (edges.mapInArrow(common.contract, "u long, v long"), True), (edges, True))]
    assert both == [{1: 1, 2: 1, 3: 1, 5: -4, 7: -4, 8: -4, -4: -4}] * 3


def test_another_operators_task_drops_the_codec():
    path = bpe.vocabulary_path()
    coder = bpe.codec(path)
    bpe._slice(coder, pa.array(["kept between tasks of one operator"]))
    common.release("bpe")
    assert bpe.codec(path) is coder and coder.seen
    common.release()
    assert not common.KEPT["bpe"]
    again = bpe.codec(path)
    assert again is not coder and bpe.codec(path) is again
    assert [x.tolist() for x in bpe._slice(again, pa.array(["a b", None]))["ids"]] == [x.tolist() for x in bpe._slice(coder, pa.array(["a b", None]))["ids"]]


class Stage:
    """Stands for a frame: gives back the function that its tasks would run."""

    def select(self, *_):
        return self

    def mapInArrow(self, run, _):
        return run


def test_the_ngram_join_begins_without_a_codec():
    batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array(["a b c d e f"])], ["doc_id", "text"])
    bpe.codec(bpe.vocabulary_path())
    first = next(ngram_join.classes(Stage(), "text", "doc_id", 5)(iter([batch])))
    assert first.column(1).to_pylist() == [2] and not common.KEPT["bpe"]
