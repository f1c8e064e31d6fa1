"""Shared helpers: written tables, table reads, connected components, packed arrays.

``materialize`` is the only way lineage is cut here: a Parquet table in the shared folder the cluster
names in ``spark.checkpoint.dir``, so a lost executor never loses an intermediate result.
"""

from __future__ import annotations

import ctypes
import os
import tempfile
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import capsight

_LIBC = ctypes.CDLL(None)
ROOT = os.path.dirname(os.path.dirname(os.path.abspath(capsight.__file__)))


def shared_dir(spark: SparkSession) -> str:
    """The shared folder of the session; a scratch folder only for a local master without one."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="capsight-shared-"))
        folder = context.getCheckpointDir()
    return folder.rstrip("/")


def workers_import(spark: SparkSession) -> None:
    """Let Python workers started from now on import this package where it is not installed."""
    env = spark.sparkContext.environment
    paths = env.get("PYTHONPATH", "").split(os.pathsep)
    if ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([ROOT, *filter(None, paths)])


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: cuts lineage, survives executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/capsight/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until no column of ``df`` is called that."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def arrow_type(kind: str) -> pa.DataType:
    return {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "binary": pa.binary(),
            "string": pa.string(), "boolean": pa.bool_()}[kind]


def arrow_schema(ddl: str) -> pa.Schema:
    """The Arrow schema of a flat ``name type, ...`` list."""
    return pa.schema([(n, arrow_type(t)) for n, t in (c.split() for c in ddl.split(","))])


#: What operators keep in a Python worker from task to task, by operator: pure caches.
KEPT: dict[str, dict] = {}


def release(keep: str = "") -> None:
    """Give memory that Arrow and the C library keep for reuse back to the machine: Python workers outlive their tasks.

    What operators other than ``keep`` have kept in this worker goes too.
    """
    for name, kept in KEPT.items():
        if name != keep:
            kept.clear()
    pa.default_memory_pool().release_unused()
    if trim := getattr(_LIBC, "malloc_trim", None):
        trim(0)


def local_forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges ``(a, b)`` reduced to ``(node, smallest node of its component)`` rows, roots left out."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    u, v = at[:len(a)], at[len(a):]
    root = np.arange(len(nodes))
    while len(u):
        low = np.minimum(root[u], root[v])
        np.minimum.at(root, root[u], low)
        np.minimum.at(root, root[v], low)
        while not np.array_equal(jump := root[root], root):
            root = jump
        open_ = root[u] != root[v]
        u, v = u[open_], v[open_]
    keep = root != np.arange(len(nodes))
    return nodes[keep], nodes[root[keep]]


def contract(batches):
    """Edges of a partition as the star forest of their components (a map-side combine)."""
    a, b = [], []
    for batch in batches:
        a.append(batch.column(0).to_numpy(zero_copy_only=False))
        b.append(batch.column(1).to_numpy(zero_copy_only=False))
    if a:
        node, root = local_forest(np.concatenate(a), np.concatenate(b))
        for i in range(0, len(node), 65536):
            yield pa.RecordBatch.from_arrays([pa.array(node[i:i + 65536]), pa.array(root[i:i + 65536])], ["u", "v"])


def connected_components(edges: DataFrame, contracted: bool = False) -> DataFrame:
    """``(node, component)`` of the undirected long edges ``(u, v)``; component = smallest node.

    Large-star / small-star rounds.  Edges are first contracted inside each partition (``contracted``: the Python task that made
    them did so by ``contract``, so that no task needs two workers at once), each round is two aggregations with map-side combine and
    two joins on the node (skew is split by AQE), and a round's edges are written to the shared folder.  Stops when a round changes no edge.
    """
    spark = edges.sparkSession
    workers_import(spark)
    u, v = F.col("u"), F.col("v")
    narrow = edges.select(u.cast("long").alias("u"), v.cast("long").alias("v")).filter("u <> v")
    now = materialize((narrow if contracted else narrow.mapInArrow(contract, "u long, v long")).distinct(), "edges")
    mark = None
    while True:
        both = now.unionAll(now.select(v.alias("u"), u.alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(low, "u").filter("v > u").select(v.alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        down = large.select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v"))
        low = down.groupBy("u").agg(F.min("v").alias("m"))
        small = down.join(low, "u").select(F.explode(F.array(F.struct(u, F.col("m").alias("v")),
                                                             F.struct(v.alias("u"), F.col("m").alias("v")))).alias("e"))
        now = materialize(small.select("e.*").filter("u <> v").distinct(), "edges")
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")),
                       F.count_distinct("u")).first()
        if tuple(seen) == mark or seen[0] == 0:
            break
        mark = tuple(seen)
    roots = now.select(v.alias("node")).distinct().select("node", F.col("node").alias("component"))
    return now.select(u.alias("node"), v.alias("component")).unionAll(roots)
