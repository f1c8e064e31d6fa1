"""Whitening of embeddings: eigenpairs of the covariance by contour integration (FEAST), checked by inertia counts.

1. ``covariance``: two narrow passes.  The first sums the whole-number vectors; the second centres each by the rounded mean and multiplies in
   doubles that hold the products exactly.  Sums are exact whole numbers, so the covariance is rounded once.
2. ``spectrum``: the covariance, in tridiagonal form, has as many eigenvalues above a shift as the shifted matrix has positive pivots (its
   inertia).  Bisection on these counts lays intervals around groups of eigenvalues, cut at the gaps (equal ones stay together).
3. Per interval a circle is drawn around it.  Each Gauss-Legendre node is a task on Spark that solves the complex shifted system
   ``(z I - V) X = Y``; the weighted sum projects the block ``Y`` onto the interval's eigenvectors.  Rayleigh-Ritz extracts pairs, which
   start the next round until the residuals are at rounding level.
4. Every interval must yield as many pairs as its inertia says; an interval that does not is repeated with a wider block.
5. ``whiten`` projects the centred rows, narrow.  A last pass takes the covariance of the result.

The driver holds matrices of width x width and below; nothing there grows with the rows.

Rows whose vector is null, empty or holds null or non-finite components are dropped, as are rows of another length than most.  Components
beyond ``LIMIT`` count as the limit, so that products stay exact.  Components whose eigenvalue is not above ``RANK`` times the largest have
no spread to scale and give no rows (one row, or equal vectors only: none at all).  Equal eigenvalues: any orthonormal basis.  Each
component's sign makes its largest entry positive.  Repeated rows count as often as they occur; an empty table gives an empty result.
A ``deviation`` beyond a long is null.  Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from capsight.llm import rp_forest as R
from capsight.llm.common import materialize, table, workers_import
from capsight.llm.vector_codes import usable

SCALE = 64
SHIFT = 1_000_000
LIMIT = 8192.0  # |x - mean| < 2^20.1: products of 4,096 rows are exact in doubles
COMPONENTS = 32
PER_INTERVAL = 12
NODES = 8
ROUNDS = 12
RANK = 1e-9
STEP = 4096


def whole_numbers(column: pa.Array, width: int) -> np.ndarray:
    return np.floor(np.clip(R.matrix(column, width), -LIMIT, LIMIT) * SCALE).astype(np.int64) + SHIFT


def _sums(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros(width, dtype=np.int64)
        for batch in batches:
            n, total = n + batch.num_rows, total + whole_numbers(batch.column(0), width).sum(0)
        if n:
            yield pa.RecordBatch.from_pydict({"i": pa.array(np.arange(-1, width, dtype=np.int32)), "s": pa.array(np.append(n, total))})
    return run


def _products(width: int, centre: np.ndarray):
    upper = np.triu_indices(width)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, some = np.zeros(len(upper[0]), dtype=np.int64), False
        for batch in batches:
            for at in range(0, batch.num_rows, STEP):
                z = (whole_numbers(batch.column(0).slice(at, STEP), width) - centre).astype(np.float64)
                total, some = total + (z.T @ z)[upper].astype(np.int64), True
        if some:
            yield pa.RecordBatch.from_pydict({"i": pa.array(upper[0].astype(np.int32)), "j": pa.array(upper[1].astype(np.int32)), "s": pa.array(total)})
    return run


def covariance(vectors: DataFrame, width: int) -> tuple[int, list[int], np.ndarray]:
    """Number of rows, sums per dimension and covariance of the column ``v``; one row per task and matrix entry goes through the shuffle."""
    sums = dict(vectors.mapInArrow(_sums(width), "i int, s long").groupBy("i").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect())
    n, total = int(sums.get(-1, 0)), [int(sums.get(i, 0)) for i in range(width)]
    matrix = np.zeros((width, width))
    if n:
        centre = np.array([s // n for s in total], dtype=np.int64)
        rest = [s - n * int(c) for s, c in zip(total, centre)]
        entries = vectors.mapInArrow(_products(width, centre), "i int, j int, s long").groupBy("i", "j").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))
        for i, j, s in entries.collect():  # width x width
            matrix[i, j] = matrix[j, i] = (n * int(s) - rest[i] * rest[j]) / (n * n)
    return n, total, matrix


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Diagonal and off-diagonal of an orthogonally similar tridiagonal matrix (Householder reflections)."""
    a = matrix.astype(np.float64).copy()
    for k in range(len(a) - 2):
        v = a[k + 1:, k].copy()
        size = np.linalg.norm(v)
        if size == 0:
            continue
        v[0] += np.copysign(size, v[0])
        v /= np.linalg.norm(v)
        a[k + 1:, :] -= 2 * np.outer(v, v @ a[k + 1:, :])
        a[:, k + 1:] -= 2 * np.outer(a[:, k + 1:] @ v, v)
    return np.diag(a).copy(), np.diag(a, -1).copy()


def above(form: tuple[np.ndarray, np.ndarray], shifts: np.ndarray) -> np.ndarray:
    """Eigenvalues above each of the ``shifts``: positive pivots of the shifted tridiagonal matrix."""
    diagonal, off = form
    tiny = np.finfo(float).eps * (np.abs(diagonal).max(initial=0) + np.abs(off).max(initial=0)) + 1e-300
    shifts = np.asarray(shifts, dtype=np.float64)
    count, pivot = np.zeros(shifts.shape, dtype=np.int64), np.ones(shifts.shape)
    for k in range(len(diagonal)):
        pivot = diagonal[k] - shifts - (off[k - 1] ** 2 / pivot if k else 0.0)
        pivot = np.where(np.abs(pivot) < tiny, -tiny, pivot)
        count += pivot > 0
    return count


def located(form: tuple[np.ndarray, np.ndarray], reach: float, steps: int = 64) -> np.ndarray:
    """All eigenvalues, falling, to rounding: bisection on the inertia counts."""
    place = np.arange(1, len(form[0]) + 1)
    low, high = np.full(len(place), -reach), np.full(len(place), reach)
    for _ in range(steps):
        middle = (low + high) / 2
        more = above(form, middle) >= place
        low, high = np.where(more, middle, low), np.where(more, high, middle)
    return (low + high) / 2


def intervals(matrix: np.ndarray, wanted: int, most: int = PER_INTERVAL) -> list[tuple[float, float, int]]:
    """``(low, high, eigenvalues)`` around the ``wanted`` largest of those above ``RANK``, from the top.

    Groups end at gaps: where one is wider than half of the other gaps together, and else at the widest near the middle of a group
    of more than ``most``.  A circle reaches half of the way to its neighbours, or as far as its own spread.
    """
    form = tridiagonal(matrix)
    reach = float(np.abs(matrix).sum(1).max(initial=0)) * 1.01 + 1e-300  # all eigenvalues lie within (Gershgorin)
    close = 1e-12 * reach  # nearer ones are equal and stay together
    at = located(form, reach)
    end = min(wanted, int((at > RANK * at[0]).sum())) if len(at) else 0
    while end and end < len(at) and at[end - 1] - at[end] <= close:
        end += 1
    gaps = at[:-1] - at[1:]
    groups, todo = [], [(0, end)] if end else []
    while todo:
        a, b = todo.pop()
        inner = gaps[a:b - 1]
        widest = int(inner.argmax()) if len(inner) else 0
        if b - a > 1 and inner[widest] > max(close, (inner.sum() - inner[widest]) / 2):
            cut = a + widest + 1
        elif b - a > most:
            middle = np.arange(a + (b - a) // 4, b - 1 - (b - a) // 4)
            cut = int(middle[gaps[middle].argmax()]) + 1
            if gaps[cut - 1] <= close:
                cut = a + widest + 1 if inner[widest] > close else 0
        else:
            cut = 0
        if cut:
            todo += [(cut, b), (a, cut)]
        else:
            groups.append((a, b))
    out = []
    for a, b in groups:
        up = gaps[a - 1] / 2 if a else np.inf
        down = gaps[b - 1] / 2 if b < len(at) else np.inf
        spread = max(at[a] - at[b - 1], min(up, down, at[0]), close)
        low, high = at[b - 1] - min(down, spread), at[a] + min(up, spread)
        out.append((float(low), float(high), int(above(form, low) - above(form, high))))
    if sum(count for *_, count in out) != end:
        raise ArithmeticError("the intervals do not hold the eigenvalues that were located")
    return out


def _solves(shared, count: int):
    """One task per (interval, node): the weighted solution of its shifted system."""
    points, weights = np.polynomial.legendre.leggauss(count)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matrix, work = shared.value
        for batch in batches:
            for task in batch.column(0).to_pylist():
                k, node = divmod(task, count)
                low, high, block = work[k]
                radius, angle = (high - low) / 2, np.pi / 2 * (1 - points[node])
                turn = radius * np.exp(1j * angle)
                solved = np.linalg.solve((low + radius + turn) * np.eye(len(matrix)) - matrix, block)
                part = weights[node] / 2 * (turn * solved).real  # the lower half circle gives the conjugate
                yield pa.RecordBatch.from_pydict({"interval": pa.array([k], pa.int32()), "part": pa.array([part.tobytes()], pa.binary())})
    return run


def _project(spark: SparkSession, matrix: np.ndarray, work: list[tuple[float, float, np.ndarray]], nodes: int) -> list[np.ndarray]:
    """Each block projected onto its interval's eigenvectors."""
    tasks = len(work) * nodes
    shared = spark.sparkContext.broadcast((matrix, work))  # width x width, and blocks of width x block
    rows = spark.range(0, tasks, 1, tasks).mapInArrow(_solves(shared, nodes), "interval int, part binary").collect()
    shared.unpersist()
    out = [np.zeros(block.shape) for _, _, block in work]
    for r in sorted(rows):
        out[r["interval"]] += np.frombuffer(r["part"]).reshape(out[r["interval"]].shape)
    return out


def spectrum(spark: SparkSession, matrix: np.ndarray, wanted: int = COMPONENTS, nodes: int = NODES, seed: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues (of those above ``RANK`` times the largest), falling, and their unit eigenvectors as columns."""
    workers_import(spark)
    size = len(matrix)
    scale = float(np.abs(matrix).max(initial=0))
    if not scale:
        return np.zeros(0), np.zeros((size, 0))
    rng = np.random.Generator(np.random.PCG64(seed))
    todo = {k: (low, high, count, rng.normal(size=(size, min(size, 3 * count // 2 + 4)))) for k, (low, high, count) in enumerate(intervals(matrix, wanted)) if count}
    best: dict[int, tuple[float, np.ndarray, np.ndarray]] = {}
    for _ in range(ROUNDS):
        blocks = _project(spark, matrix, [(low, high, block) for low, high, _, block in todo.values()], nodes)
        again = {}
        for (k, (low, high, count, block)), projected in zip(todo.items(), blocks):
            basis, sizes, _ = np.linalg.svd(projected, full_matrices=False)
            basis = basis[:, sizes > sizes[0] * 1e-13]
            basis, _ = np.linalg.qr(basis)
            values, turns = np.linalg.eigh(basis.T @ matrix @ basis)
            vectors = basis @ turns
            inside = np.flatnonzero((values > low) & (values <= high))
            off = np.linalg.norm(matrix @ vectors[:, inside] - vectors[:, inside] * values[inside], axis=0) / scale
            some = inside[np.argsort(off)[:count]]  # mixtures of pairs outside can have values inside, but not small residuals
            found, pairs = values[some], vectors[:, some]
            residual = np.sort(off)[count - 1] if len(inside) >= count else np.inf
            if residual < best.get(k, (np.inf,))[0]:
                best[k] = residual, found, pairs
            elif residual < 1e-11:
                continue  # at rounding level: no better than the round before
            if residual > 1e-15 * size:
                fill = min(size, block.shape[1] + (4 if len(inside) < count else 0)) - vectors.shape[1]
                again[k] = low, high, count, np.hstack([vectors, rng.normal(size=(size, max(0, fill)))])
        todo = again
        if not todo:
            break
    missed = [k for k, (low, high, count, _) in todo.items() if best.get(k, (np.inf,))[0] > 1e-9]
    if missed:
        raise ArithmeticError(f"{len(missed)} intervals hold eigenvalues that the contour did not find")
    # once more over all intervals together: pairs of different intervals are orthogonal too
    basis, _ = np.linalg.qr(np.hstack([best[k][2] for k in sorted(best)]))
    values, turns = np.linalg.eigh(basis.T @ matrix @ basis)
    order = np.argsort(-values)[:wanted]
    values, vectors = values[order], basis @ turns[:, order]
    return values, vectors * np.sign(vectors[np.abs(vectors).argmax(0), np.arange(len(order))])


def whiten(rows: DataFrame, components: int = COMPONENTS, vector: str = "embedding", key: str = "vec_id") -> tuple[DataFrame, int, np.ndarray]:
    """``(<key>, n, deviation, whitened)`` with one array per usable row, the width, and the shares of variance explained."""
    spark = rows.sparkSession
    workers_import(spark)
    width = R.common_width(rows.filter(F.size(vector) > 0), vector)
    use = rows.filter(usable(F.col(vector), width)).select(F.col(vector).cast("array<double>").alias("v"), F.col(key).alias("key"))
    kind = use.schema["key"].dataType.simpleString()
    n, total, matrix = covariance(use.select("v"), width)
    values, vectors = spectrum(spark, matrix, min(components, width))
    some = values > RANK * values.max(initial=0)
    values, vectors = values[some], vectors[:, some]
    centre = np.array([s // n for s in total] if n else [], dtype=np.int64)
    rest = [s - n * int(c) for s, c in zip(total, centre)]
    turn = vectors / np.sqrt(values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left = np.array(rest, dtype=np.int64)
        for batch in batches:
            z = whole_numbers(batch.column(0), width) - centre
            if n * (int(np.abs(z).max(initial=0)) + 1) < 2 ** 31 // max(1, width) ** 0.5:
                off = ((n * z - left) ** 2).sum(1).tolist()
            else:
                off = [d if d < 2 ** 63 else None for d in (((n * z.astype(object)) - left.astype(object)) ** 2).sum(1)]
            out = (z - left / n) @ turn
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(out) + 1, dtype=np.int32) * out.shape[1]), pa.array(out.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(off, pa.int64()), lists], ["key", "deviation", "whitened"])

    out = use.filter(F.lit(len(values) > 0)).mapInArrow(run, f"key {kind}, deviation long, whitened array<double>")
    shares = values / np.trace(matrix) if len(values) else values
    return out.select(F.col("key").alias(key), F.lit(n).cast("long").alias("n"), "deviation", "whitened"), width, shares


def identity_error(whitened: DataFrame, count: int) -> float:
    """The largest absolute entry of the covariance of ``whitened`` minus the identity."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total, products = 0, np.zeros(count), np.zeros((count, count))
        for batch in batches:
            w = R.matrix(batch.column(0), count)
            n, total, products = n + len(w), total + w.sum(0), products + w.T @ w
        if n:
            i, j = np.indices((count + 1, count)).reshape(2, -1)
            yield pa.RecordBatch.from_pydict({"i": pa.array(i.astype(np.int32)), "j": pa.array(j.astype(np.int32)), "n": pa.array(np.full(len(i), n, dtype=np.int64)),
                                              "s": pa.array(np.vstack([products, total]).ravel())})

    rows = whitened.select("whitened").mapInArrow(run, "i int, j int, n long, s double").groupBy("i", "j").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).collect()
    out = np.zeros((count + 1, count))
    for i, j, n, s in rows:  # components x components
        out[i, j] = s / n
    return float(np.abs(out[:count] - np.outer(out[count], out[count]) - np.eye(count)).max(initial=0))


def op12_feast_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, _, shares = whiten(table(spark, sf_dir, "embeddings"))
    out = materialize(out, "whitened")
    error = identity_error(out, len(shares))
    explained = F.get(F.array(*map(F.lit, shares.tolist())), F.col("at")) if len(shares) else F.lit(None).cast("double")
    return (out.select("vec_id", "n", "deviation", F.posexplode("whitened").alias("at", "whitened"))
            .select("vec_id", (F.col("at") + 1).alias("component"), "n", "deviation", "whitened", explained.alias("explained"), F.lit(error).alias("identity_error")))


QUERY = {"op12_feast_whitening": op12_feast_whitening}
