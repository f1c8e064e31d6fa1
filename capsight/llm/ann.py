"""Approximate nearest neighbours: a forest of random-projection trees, one priority queue, exact reranking.

``fit`` builds ``trees`` trees on the driver from a bounded sample (``SAMPLE`` distinct vectors, the least hashes of their ids); the model
has at most ``trees * SAMPLE / LEAF * 2`` nodes whatever the table's size and is what gets broadcast.  Every vector is indexed: routed
to its leaf in each tree.  A query walks all trees through one priority queue until the leaves it has reached hold ``share`` of all
rows (a row counts once per tree that reaches it), then is compared exactly, in double precision, with the rows of these leaves: queries
and vectors meet in tasks of one leaf (large leaves are dealt into blocks of ``BLOCK_ROWS`` by a hash), each returns its best.

``share`` sets recall against work and is measured in the tests against brute force.  The default suits vectors without
structure (the hardest case: distances hardly differ), where a forest has to look at much of the table; clustered
vectors need a few hundredths.

Equal vectors are one point that carries its least ``neighbours + 1`` ids, so a group of copies costs no more than
one vector; equal queries are answered once.  Vectors that are null, zero, of another length than most, or that hold null or
non-finite components take no part, nor do rows without id.  Rows that repeat an id count as one candidate (its nearest vector).  Ties
go to the smaller id.  A table with no usable vector gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from capsight.llm import rp_forest as R
from capsight.llm.common import materialize, release, table, workers_import

TREES = 16
SAMPLE = 16_384
LEAF = 32
SHARE = 1.5
NEIGHBOURS = 10
BLOCK_ROWS = 20_000
CELLS = 500_000  # distances a leaf's task holds at a time


def points(rows: DataFrame, vector: str, key: str, keep: int) -> tuple[DataFrame, int]:
    """Distinct usable vectors: ``cid`` (least id), ``v``, ``ids`` (the least ``keep``); and the vectors' width."""
    width = R.common_width(rows, vector)
    use = rows.filter(R.usable(F.col(vector), width) & F.col(key).isNotNull())
    use = use.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"))
    first = Window.partitionBy("v").orderBy("id")  # limited per task before the shuffle
    some = use.distinct().withColumn("k", F.row_number().over(first)).filter(F.col("k") <= keep)
    return materialize(some.groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids"), F.min("id").alias("cid")), "ann-points"), width


def fit(vectors: DataFrame, width: int, trees: int, sample: int = SAMPLE, leaf: int = LEAF, seed: int = 11) -> list[R.Tree]:
    """Trees from the ``sample`` vectors (``cid, v``) with the least hashes."""
    some = vectors.select("cid", "v").orderBy(F.xxhash64("cid", F.lit(seed)), "cid").limit(sample).toArrow()
    rows = R.matrix(some.column("v"), width) if some.num_rows else np.zeros((0, width))
    return [R.build(rows, leaf, [seed, t]) for t in range(trees)]


def _best(distance: np.ndarray, slack: np.ndarray, exact, keep: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Per query the points among the ``keep`` nearest (ties included) with exact distances; ``slack``: what the squares may be off by."""
    k = min(keep, distance.shape[1]) - 1
    edge = np.partition(distance, k, axis=1)[:, k]
    for q in range(len(distance)):
        at = np.flatnonzero(distance[q] <= edge[q] + slack[q])
        yield q, at, exact(q, at)


def _leaf_search(width: int, keep: int):
    def run(queries: pa.Table, vectors: pa.Table) -> pa.Table:
        none = pa.table({"qid": pa.array([], pa.int64()), "cid": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        if not queries.num_rows or not vectors.num_rows:
            return none
        a, b = R.matrix(queries.column("v"), width), R.matrix(vectors.column("v"), width)
        qid, cid = queries.column("qid").to_numpy(), vectors.column("cid").to_numpy()
        out = []
        scale = max(np.abs(a).max(), np.abs(b).max())  # squares neither overflow nor vanish, and a common offset costs no digits
        centre = (b / scale).mean(0)
        c = b / scale - centre
        sizes = (c * c).sum(1)
        some = max(1, min(256, CELLS // len(b)))
        for at in range(0, len(a), some):
            part = a[at:at + some]
            p = part / scale - centre
            own = (p * p).sum(1)
            near = sizes[None, :] - 2 * (p @ c.T) + own[:, None]
            slack = 8e-16 * (width + 8) * (own + sizes.max() + 4 * (centre * centre).sum() + 1e-300)
            for q, i, d in _best(near, slack, lambda q, i: R.lengths(b[i] - part[q]), keep):
                first = np.lexsort((cid[i], d))[:keep]
                out.append((np.full(len(first), qid[at + q]), cid[i][first], d[first]))
        return pa.table({"qid": np.concatenate([x[0] for x in out]), "cid": np.concatenate([x[1] for x in out]), "score": np.concatenate([x[2] for x in out])})
    return run


def nearest(rows: DataFrame, queries: Column, neighbours: int = NEIGHBOURS, trees: int = TREES, share: float = SHARE,
            vector: str = "embedding", key: str = "vec_id") -> DataFrame:
    """``query_id, rank, vec_id, score`` of the rows for which ``queries`` holds, against all rows."""
    spark = rows.sparkSession
    workers_import(spark)
    keep = neighbours + 1  # a query's own id is left out at the end
    vectors, width = points(rows, vector, key, keep)
    forest = fit(vectors, width, trees)
    shared = spark.sparkContext.broadcast([t.dump() for t in forest])

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = [R.Tree.load(t) for t in shared.value]
        for batch in batches:
            v = R.matrix(batch.column(1), width)
            for t, tree in enumerate(known):
                row, leaf = R.route(tree, v)
                pick = batch.take(pa.array(row))
                yield pa.RecordBatch.from_arrays([pick.column(0), pick.column(1), pa.array(np.full(len(row), t, dtype=np.int32)), pa.array(leaf.astype(np.int32))],
                                                 ["cid", "v", "tree", "leaf"])
            batch = v = row = leaf = pick = None
            release()

    leaves = materialize(vectors.select("cid", "v").mapInArrow(index, "cid long, v array<double>, tree int, leaf int"), "ann-leaves")
    sizes = leaves.groupBy("tree", "leaf").count()
    counts = [np.zeros(t.leaves, dtype=np.int64) for t in forest]
    for r in sizes.collect():  # at most the leaves of the model
        counts[r["tree"]][r["leaf"]] = r["count"]
    wanted = share * sum(int(c.sum()) for c in counts[:1])
    sized = spark.sparkContext.broadcast(counts)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = [R.Tree.load(t) for t in shared.value]
        for batch in batches:
            v = R.matrix(batch.column(1), width)
            for at in range(0, len(v), 256):
                found = [R.search(known, sized.value, q, wanted) for q in v[at:at + 256]]
                pick = batch.slice(at, 256).take(pa.array(np.repeat(np.arange(len(found)), [len(f) for f in found])))
                place = np.array([x for f in found for x in f], dtype=np.int32).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays([pick.column(0), pick.column(1), pa.array(place[:, 0]), pa.array(place[:, 1])], ["qid", "v", "tree", "leaf"])
            batch = v = found = pick = place = None
            release()

    width_ok = R.usable(F.col(vector), width) & F.col(key).isNotNull()
    asked = (rows.filter(queries & width_ok).select(F.col(key).cast("long").alias("query_id"), F.col(vector).cast("array<double>").alias("v")).distinct()
             .join(vectors.select("v", F.col("cid").alias("qid")), "v").select("query_id", "qid", "v"))
    asked = materialize(asked, "ann-queries")
    blocks = F.broadcast(sizes.withColumn("blocks", F.ceil(F.col("count") / BLOCK_ROWS)).drop("count"))  # at most the model's leaves
    probes = (asked.select("qid", "v").dropDuplicates(["qid"]).mapInArrow(walk, "qid long, v array<double>, tree int, leaf int")
              .join(blocks, ["tree", "leaf"]).withColumn("block", F.explode(F.expr("sequence(0L, blocks - 1)"))).drop("blocks"))
    stored = leaves.join(blocks, ["tree", "leaf"]).withColumn("block", F.pmod(F.xxhash64("cid"), F.col("blocks"))).drop("blocks")
    by = ["tree", "leaf", "block"]
    best = probes.groupBy(*by).cogroup(stored.groupBy(*by)).applyInArrow(_leaf_search(width, keep), "qid long, cid long, score double")
    order = Window.partitionBy("qid").orderBy("score", "cid")
    best = best.groupBy("qid", "cid").agg(F.min("score").alias("score")).withColumn("k", F.row_number().over(order)).filter(F.col("k") <= keep)
    best = best.join(vectors.select("cid", "ids"), "cid").select("qid", "score", F.explode("ids").alias("vec_id"))
    order = Window.partitionBy("qid").orderBy("score", "vec_id")
    best = best.groupBy("qid", "vec_id").agg(F.min("score").alias("score")).withColumn("k", F.row_number().over(order)).filter(F.col("k") <= keep).drop("k")
    pairs = asked.select("query_id", "qid").join(best, "qid").filter("query_id <> vec_id").groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")  # at most neighbours + 1 rows of each vector of a query
    return pairs.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= neighbours).select("query_id", "rank", "vec_id", "score")


def op1_rp_forest_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


QUERY = {"op1_rp_forest_ann": op1_rp_forest_ann}
