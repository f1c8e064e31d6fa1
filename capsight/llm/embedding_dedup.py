"""Embedding near-duplicates: a forest of random-projection trees with spill, comparison within leaves, union.

Every vector, scaled to length 1, goes down ``TREES`` trees of recursive median splits on random projections; rows in the overlap around a median
(a share ``SPILL`` of the rows) go both ways.  Splitting runs in rounds on Spark: in each round every group that is still over
``LEAF_ROWS`` gets a subtree fitted to a sample of its rows (the ``SAMPLE`` least hashes) and its rows, dealt into tasks of ``TASK_ROWS``, are routed
through it.  So trees deepen with the table and no step holds a whole group.

Rows that link with more rows than fit into a leaf are not cut at medians: where a node's sample shows such a group, the node is
divided by the angle to the group's mean, and the rows within the link angle of the border go both ways, which loses no link.  A node that the
group fills, so that nothing divides it, is closed whole.

Within a leaf all pairs are compared exactly in double precision, leaves over ``PAIR_ROWS`` as pairs of blocks.  A pair that
several leaves share is counted in the first of them only: each row carries the list of its leaves.  Tasks return a forest of the links
and link counts, never the pairs; connected components unite them.

Equal vectors are one point with its number of copies (they link with each other).  Vectors that are null, zero, of
another length than most or that hold null or non-finite components link with nothing and keep themselves.  Rows that repeat an id are
copies or separate points under one id; a null id stays null and its row takes no part.  An empty table gives an empty result; extra
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from capsight.llm import rp_forest as R
from capsight.llm.common import connected_components, materialize, table, workers_import

COSINE = 0.95
TREES = 10
SPILL = 0.1
LEAF_ROWS = 1024
SAMPLE = 4096
SAMPLE_LEAF = 32
TASK_ROWS = 20_000
PAIR_ROWS = 1500
ROUNDS = 12
PROBES = 1024  # rows of a node's sample whose links are counted to find large groups
SEEN = 8  # linked sample rows that show a group
SHARE = 8  # a group that nothing divides keeps a node whole if a row links with at least one in so many of its rows


def _divide(scale: float, leaf_rows: int, cosine: float):
    """How a node of unit rows, each standing for ``scale`` rows, is divided if one of its groups is too large for leaves."""
    reach = np.arccos(np.clip(cosine, -1, 1))

    def run(rows: np.ndarray):
        narrow = rows.astype(np.float32)
        degree = (narrow[:PROBES] @ narrow.T >= cosine).sum(1)
        top = int(degree.argmax())
        if degree[top] < SEEN or degree[top] * scale * SHARE < leaf_rows:
            return None
        centre = rows[narrow @ narrow[top] >= cosine].mean(0)
        centre /= np.linalg.norm(centre)
        angle = np.sort(np.arccos(np.clip(rows @ centre, -1, 1)))
        n = len(rows)
        core = np.searchsorted(angle, angle, "right")
        near = np.searchsorted(angle, angle + reach, "right")
        fits = (2 * core >= degree[top]) & (near < 0.95 * n) & (angle + reach < np.pi)
        cheap = fits & (2 * (near - core) <= core)
        if not cheap.any():
            cheap = fits & (near ** 2 + (n - core) ** 2 <= 0.75 * n ** 2)  # fewer pairs than in the whole node
        if cheap.any():
            at = np.flatnonzero(cheap)[np.argmin((near / core)[cheap])]
            edge = (angle[at] + angle[min(core[at], n - 1)]) / 2
            return centre, np.cos(edge + reach) - 1e-9, np.cos(edge)
        return "whole" if degree[top] * SHARE >= n else None
    return run


def _fit(width: int, leaf_rows: int, spill: float, seed: int, cosine: float):
    """A subtree of a group from its sample; the group's size tells how deep."""
    def run(sample: pa.Table) -> pa.Table:
        tree, path, total = (sample.column(c)[0].as_py() for c in ("tree", "path", "total"))
        order = np.argsort(sample.column("cid").to_numpy())
        rows = R.unit(R.matrix(sample.column("v"), width)[order])
        leaf = max(SAMPLE_LEAF, int(len(rows) * leaf_rows / (2 * max(total, 1))))
        made = R.build(rows, leaf, [seed, tree, path], spill, _divide(max(1, total / len(rows)), leaf_rows, cosine))
        return pa.table({"tree": pa.array([tree], pa.int32()), "path": pa.array([path], pa.int64()), "total": pa.array([total], pa.int64()),
                         "model": pa.array([made.dump()], pa.binary())})
    return run


def _route(width: int):
    """Rows of a group's task with the subtree: a new path for every leaf that a row reaches."""
    def run(rows: pa.Table, models: pa.Table) -> pa.Table:
        tree = R.Tree.load(models.column("model")[0].as_py())
        row, leaf = R.route(tree, R.unit(R.matrix(rows.column("v"), width)))
        pick = rows.take(pa.array(row))
        path = pick.column("path").to_numpy()
        # paths are hashed positions in the tree, so they stay 64 bits wide at any depth
        new = (path.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + leaf.astype(np.uint64) + np.uint64(1))
        new = ((new ^ (new >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)).view(np.int64)
        stuck = np.isin(leaf, tree.whole) if tree.leaves > 1 else np.full(len(row), True)
        return pa.table({"cid": pick.column("cid"), "v": pick.column("v"), "copies": pick.column("copies"), "tree": pick.column("tree"),
                         "path": pa.array(new), "stuck": pa.array(stuck)})
    return run


def leaves(points: DataFrame, width: int, trees: int, spill: float, leaf_rows: int, seed: int, cosine: float = COSINE) -> DataFrame:
    """``cid, v, copies, tree, path``: every point in the leaves it reaches."""
    rows = points.select("cid", "v", "copies", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree"))
    rows = rows.select("cid", "v", "copies", F.col("tree").cast("int").alias("tree"), F.col("tree").cast("long").alias("path"), F.lit(False).alias("stuck"))
    rows = materialize(rows, "rp-rows")
    done = None
    for level in range(ROUNDS):
        sizes = rows.groupBy("tree", "path").agg(F.count("*").alias("total"), F.max("stuck").alias("stuck"))
        large = materialize(sizes.filter((F.col("total") > leaf_rows) & ~F.col("stuck")).select("tree", "path", "total"), "rp-large")
        if not large.head(1):
            break
        order = Window.partitionBy("tree", "path").orderBy(F.xxhash64("cid", F.lit(seed + level)), "cid")  # limited per task before the shuffle
        open_ = rows.join(large, ["tree", "path"])
        sample = open_.withColumn("k", F.row_number().over(order)).filter(F.col("k") <= SAMPLE).select("cid", "v", "tree", "path", "total")
        models = sample.groupBy("tree", "path").applyInArrow(_fit(width, leaf_rows, spill, seed + level, cosine), "tree int, path long, total long, model binary")
        tasks = F.ceil(F.col("total") / TASK_ROWS)
        models = materialize(models, "rp-models")
        models = models.withColumn("task", F.explode(F.sequence(F.lit(0).cast("long"), tasks - 1))).drop("total")
        dealt = open_.withColumn("task", F.pmod(F.xxhash64("cid"), tasks)).drop("total")
        by = ["tree", "path", "task"]
        split = dealt.groupBy(*by).cogroup(models.groupBy(*by)).applyInArrow(
            _route(width), "cid long, v array<double>, copies long, tree int, path long, stuck boolean")
        closed = rows.join(large.select("tree", "path"), ["tree", "path"], "left_anti").select(*rows.columns)
        done = closed if done is None else done.unionByName(closed)
        rows = materialize(split.dropDuplicates(["cid", "tree", "path"]), "rp-rows")
    return (rows if done is None else done.unionByName(rows)).drop("stuck")


def _forest(linked: np.ndarray, cid: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(node, smallest node of its component)`` rows of a symmetric matrix of links, roots left out."""
    root = np.full(len(cid), -1)
    order = np.argsort(cid)
    for start in order[linked.any(1)[order]].tolist():
        if root[start] < 0:
            root[start] = start
            front = np.array([start])
            while len(front):
                front = np.flatnonzero(linked[front].any(0) & (root < 0))
                root[front] = start
    keep = (root >= 0) & (root != np.arange(len(cid)))
    return cid[keep], cid[root[keep]]


def _compare(width: int, cosine: float):
    """Links of a pair of blocks of one leaf, each pair in its first common leaf only."""
    def run(block: pa.Table) -> pa.Table:
        left, right, leaf = (block.column(c)[0].as_py() for c in ("i", "j", "leaf"))
        cid, copies, own = (block.column(c).to_numpy() for c in ("cid", "copies", "own"))
        v = R.matrix(block.column("v"), width)
        v = v / np.abs(v).max(1, keepdims=True)  # squares neither overflow nor vanish
        size = np.linalg.norm(v, axis=1)
        unit = v / size[:, None]
        linked = np.zeros((len(v), len(v)), dtype=bool)
        for k in range(0, len(v), 512):
            near = unit[k:k + 512] @ unit.T
            linked[k:k + 512] = near >= cosine
            a, b = np.nonzero(np.abs(near - cosine) <= 1e-9)
            linked[a + k, b] = (v[a + k] * v[b]).sum(1) / (size[a + k] * size[b]) >= cosine
        np.fill_diagonal(linked, False)
        if left != right:
            linked &= own[:, None] != own
        u, w = _forest(linked, cid)
        # pairs that meet in an earlier leaf are counted there
        paths = block.column("paths").combine_chunks()
        owner = np.repeat(np.arange(len(cid)), np.diff(paths.offsets.to_numpy()))
        flat = paths.flatten().to_numpy(zero_copy_only=False)
        earlier = flat < leaf
        some = np.flatnonzero(linked.any(1))
        place = np.full(len(cid), -1)
        place[some] = np.arange(len(some))
        earlier &= place[owner] >= 0
        names, column = np.unique(flat[earlier], return_inverse=True)
        met = np.zeros((len(some), len(some)), dtype=bool)
        for k in range(0, len(names), 1024):
            use = (column >= k) & (column < k + 1024)
            m = np.zeros((len(some), min(1024, len(names) - k)), dtype=np.float32)
            m[place[owner[earlier][use]], column[use] - k] = 1
            met |= (m @ m.T) > 0
        links = np.zeros(len(cid), dtype=np.int64)
        for k in range(0, len(some), 512):
            links[some[k:k + 512]] = (linked[np.ix_(some[k:k + 512], some)] & ~met[k:k + 512]) @ copies[some]
        has = links > 0
        return pa.table({"u": np.concatenate([u, cid[has]]), "v": np.concatenate([w, cid[has]]), "links": np.concatenate([np.zeros(len(u), dtype=np.int64), links[has]])})
    return run


def near_duplicates(rows: DataFrame, cosine: float = COSINE, trees: int = TREES, spill: float = SPILL, leaf_rows: int = LEAF_ROWS,
                    vector: str = "embedding", key: str = "vec_id", seed: int = 23) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every row."""
    spark = rows.sparkSession
    workers_import(spark)
    width = R.common_width(rows, vector)
    use = F.when(R.usable(F.col(vector), width) & F.col(key).isNotNull(), F.col(vector).cast("array<double>"))
    every = rows.select(F.col(key).cast("long").alias("id"), use.alias("v"))
    points = materialize(every.filter("v IS NOT NULL").groupBy("v").agg(F.min("id").alias("low"), F.count("*").alias("copies"))
                         .withColumn("cid", F.xxhash64("v")), "rp-points")
    # two vectors with one hash would be one node: the id keeps them apart
    clash = points.groupBy("cid").count().filter("count > 1").select("cid")
    points = points.join(clash.withColumn("clash", F.lit(True)), "cid", "left").withColumn("cid", F.when(F.col("clash"), F.xxhash64("cid", "low")).otherwise(F.col("cid"))).drop("clash")
    points = materialize(points, "rp-points")
    placed = materialize(leaves(points.select("cid", "v", "copies"), width, trees, spill, leaf_rows, seed, cosine).withColumn("leaf", F.xxhash64("tree", "path")), "rp-leaves")
    member = placed.groupBy("cid").agg(F.collect_set("leaf").alias("paths"))  # at most a few leaves per tree
    cuts = placed.groupBy("leaf").agg(F.ceil(F.count("*") / PAIR_ROWS).cast("long").alias("cuts"))
    own = placed.join(cuts, "leaf").withColumn("own", F.pmod(F.xxhash64("cid"), F.col("cuts"))).join(member, "cid")
    pairs = own.withColumn("other", F.explode(F.expr("sequence(0L, cuts - 1)")))
    pairs = pairs.select("leaf", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "cid", "copies", "v", "paths")
    found = materialize(pairs.groupBy("leaf", "i", "j").applyInArrow(_compare(width, cosine), "u long, v long, links long"), "rp-links")
    roots = connected_components(found.filter("u <> v").select("u", "v"))
    links = found.filter("u = v").groupBy(F.col("u").alias("cid")).agg(F.sum("links").alias("links"))
    known = points.join(roots.select(F.col("node").alias("cid"), "component"), "cid", "left").withColumn("component", F.coalesce("component", "cid"))
    least = known.groupBy("component").agg(F.min("low").alias("component_id"))
    known = known.join(least, "component").join(links, "cid", "left").select("v", "component_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    out = every.join(known, "v", "left")
    component = F.coalesce("component_id", "id")
    return out.select(F.col("id").alias("vec_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
                      (F.col("id") == component).alias("kept"))


def op2_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"))


QUERY = {"op2_embedding_dedup": op2_embedding_dedup}
