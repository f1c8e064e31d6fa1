"""Vector codes: product quantisation by member-resident Lloyd rounds, in whole numbers.

Vectors become whole numbers ``floor(SCALE * x)`` and are cut into ``parts`` consecutive parts (padded with zeros where the width is no
multiple).  Every part position has a codebook of at most ``entries`` entries, at first the parts of the rows with the smallest ids.

A part is a member of the cell (position, entry, salt) and lies in the partition that owns the cell: in the segment (a written table
dealt out by cell) of the round in which it came there.  A round is one narrow pass over the segments.  Members that stay are summed where
they lie, one row per task and cell.  Members whose nearest entry has changed are emitted and alone go through the shuffle, together with
these sums, into the next segment, from which the owners' new entries come: residents' sums plus arrivals.  Segments are never rewritten: a
member has left its segment as soon as one of the codebooks since then names another entry, which the pass finds by trying them in turn.
So all rounds together write the members once, and once more each time one moves.  ``salts`` grows with the rows, so that an entry with
all parts (equal vectors) is dealt into cells of about ``CELL_ROWS`` members.  The driver holds codebooks only (positions x entries x part width).

Rows whose vector is null, empty or holds null or non-finite components are dropped, as are rows of another length than most.  Components
beyond ``LIMIT`` count as the limit, so that errors fit a long.  Zero vectors, equal vectors and repeated ids are rows like others; of rows
with one id the smaller vector seeds first, and null ids seed last.  Fewer rows than ``entries`` give smaller codebooks; an empty table
an empty result.  Other columns pass through ``encode``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from capsight.llm import rp_forest as R
from capsight.llm.common import materialize, table, workers_import

PARTS = 8
ENTRIES = 16
ROUNDS = 6
SCALE = 4096
LIMIT = 8192.0
CELL_ROWS = 4096
CELL = ["position", "entry", "salt"]


def usable(v: Column, width: int) -> Column:
    """Vectors of ``width`` finite components."""
    return v.isNotNull() & (F.size(v) == width) & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.lit(width > 0)


def whole_numbers(rows: np.ndarray, parts: int, scale: int = SCALE) -> np.ndarray:
    """``(row, part, component)`` whole numbers of rows of doubles."""
    x = np.floor(np.clip(rows, -LIMIT, LIMIT) * scale).astype(np.int64)
    return np.pad(x, ((0, 0), (0, -x.shape[1] % parts))).reshape(len(x), parts, -1)


def nearest(x: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Entry (ties to the lower) and squared distance of each row of ``x``, exactly."""
    entry, best = np.zeros(len(x), dtype=np.int64), np.full(len(x), np.iinfo(np.int64).max)
    for k, c in enumerate(book):
        distance = ((x - c) ** 2).sum(1)
        closer = distance < best
        entry[closer], best[closer] = k, distance[closer]
    return entry, best


def _rows(position, entry, salt, resident, n, x) -> pa.RecordBatch:
    values = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]), pa.array(x.ravel()))
    return pa.RecordBatch.from_arrays([pa.array(position.astype(np.int32)), pa.array(entry.astype(np.int32)), pa.array(salt.astype(np.int32)),
                                       pa.array(resident), pa.array(n.astype(np.int64)), values], ["position", "entry", "salt", "resident", "n", "x"])


MEMBERS = "position int, entry int, salt int, resident boolean, n long, x array<long>"


def _settle(books: np.ndarray, salts: int, parts: int, width: int):
    """Rows of vectors as members of their first cells, salts in turn."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn = 97 * TaskContext.get().partitionId()
        for batch in batches:
            for at in range(0, batch.num_rows, 8192):
                x = whole_numbers(R.matrix(batch.column(0).slice(at, 8192), width), parts)
                salt = (turn + np.arange(len(x))) % salts
                turn += len(x)
                for p in range(parts):
                    entry, _ = nearest(x[:, p], books[p])
                    yield _rows(np.full(len(x), p), entry, salt, np.zeros(len(x), dtype=bool), np.ones(len(x)), x[:, p])
    return run


def _round(history: list[np.ndarray]):
    """A pass over members of one segment: movers, and the sums of those that stay.

    ``history``: the codebooks since the segment was written, the newest last.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stays: dict[tuple[int, int, int], tuple[int, np.ndarray]] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            position, entry, salt = (batch.column(k).to_numpy() for k in range(3))
            x = R.matrix(batch.column(5), history[0].shape[2]).astype(np.int64)
            for p in np.unique(position):
                some = np.flatnonzero(position == p)
                for book in history[:-1]:  # members that left in an earlier round
                    some = some[nearest(x[some], book[p])[0] == entry[some]]
                new, _ = nearest(x[some], history[-1][p])
                move = new != entry[some]
                if move.any():
                    go = some[move]
                    yield _rows(position[go], new[move], salt[go], np.zeros(len(go), dtype=bool), np.ones(len(go)), x[go])
                stay = some[~move]
                cell = entry[stay].astype(np.int64) << 32 | salt[stay]
                for c in np.unique(cell):
                    of = stay[cell == c]
                    n, total = stays.get(at := (int(p), int(c >> 32), int(c & 0xFFFFFFFF)), (0, 0))
                    stays[at] = n + len(of), total + x[of].sum(0)
        if stays:
            keys = np.array(list(stays))
            yield _rows(keys[:, 0], keys[:, 1], keys[:, 2], np.ones(len(keys), dtype=bool), np.array([n for n, _ in stays.values()]), np.array([t for _, t in stays.values()]))
    return run


def _updated(segment: DataFrame, book: np.ndarray) -> tuple[np.ndarray, int]:
    """The owners' new entries (floor of the mean; unused ones stay), and the number of members that came."""
    width = book.shape[2]
    total = [F.sum(F.get("x", F.lit(i))).alias(f"x{i}") for i in range(width)]
    by = segment.groupBy("position", "entry").agg(F.sum("n").alias("n"), F.sum(F.when(F.col("resident"), 0).otherwise(F.col("n"))).alias("came"), *total)
    new, came = book.copy(), 0
    for r in by.collect():  # at most positions x entries rows
        new[r["position"], r["entry"]] = [r[f"x{i}"] // r["n"] for i in range(width)]
        came += r["came"]
    return new, came


def seeds(rows: DataFrame, vector: str, key: str, width: int, parts: int, entries: int) -> np.ndarray:
    """The first codebooks: the parts of the rows with the smallest ids."""
    first = rows.select(F.col(key).alias("k"), F.col(vector).cast("array<double>").alias("v")).orderBy(F.asc_nulls_last("k"), "v").limit(entries).collect()
    return whole_numbers(np.array([r["v"] for r in first], dtype=np.float64).reshape(-1, width), parts).transpose(1, 0, 2)


def fit(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, vector: str = "embedding", key: str = "vec_id") -> tuple[np.ndarray, int]:
    """Codebooks ``(position, entry, component)`` of all usable rows, and the vectors' width."""
    workers_import(rows.sparkSession)
    width = R.common_width(rows.filter(F.size(vector) > 0), vector)
    use = rows.filter(usable(F.col(vector), width))
    book = seeds(use, vector, key, width, parts, entries) if width else np.zeros((parts, 0, 0), dtype=np.int64)
    if not book.shape[1]:
        return book, width
    salts = max(8, -(-use.count() // CELL_ROWS))
    members = use.select(F.col(vector).cast("array<double>").alias("v")).mapInArrow(_settle(book, salts, parts, width), MEMBERS)
    segments, books = [materialize(members.repartition(*CELL), "codes-0")], [book]
    book, _ = _updated(segments[0], book)
    for k in range(1, rounds):
        books.append(book)
        passes = [s.filter("NOT resident").mapInArrow(_round(books[at + 1:]), MEMBERS) for at, s in enumerate(segments)]
        every = passes[0]
        for one in passes[1:]:
            every = every.unionAll(one)
        segments.append(materialize(every.repartition(*CELL), f"codes-{k}"))
        book, came = _updated(segments[-1], book)
        if not came:  # no member moves any more: the remaining rounds change nothing
            break
    return book, width


def encode(rows: DataFrame, books: np.ndarray, width: int, vector: str = "embedding", code: str = "code", error: str = "error") -> DataFrame:
    """The usable ``rows`` with ``code`` (two hex digits per part) and ``error`` (squared distance over all parts)."""
    workers_import(rows.sparkSession)
    rows = rows.drop(code, error)
    place = rows.columns.index(vector)
    parts = len(books)
    schema = StructType([*rows.schema.fields, StructField(code, StringType()), StructField(error, LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = whole_numbers(R.matrix(batch.column(place), width), parts)
            entry, distance = zip(*(nearest(x[:, p], books[p]) for p in range(parts)))
            codes = [bytes(r).hex() for r in np.stack(entry, 1).astype(np.uint8)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(codes, pa.string()), pa.array(np.sum(distance, 0, dtype=np.int64))], schema.names)

    use = rows.filter(usable(F.col(vector), width) & F.lit(books.shape[1] > 0))
    return use.mapInArrow(run, schema) if books.shape[1] else use.withColumns({code: F.lit(None).cast("string"), error: F.lit(None).cast("long")})


def decode(codes: DataFrame, books: np.ndarray, width: int, code: str = "code", out: str = "vector") -> DataFrame:
    """``codes`` with the vectors that the codes stand for (null for null codes)."""
    scaled = (books / SCALE).tolist()
    parts = [F.get(F.array(*[F.array(*map(F.lit, c)) for c in scaled[p]]), F.conv(F.substring(code, 2 * p + 1, 2), 16, 10).cast("int")) for p in range(len(books))]
    return codes.withColumn(out, F.slice(F.concat(*parts), 1, width))


def digest(books: np.ndarray) -> str:
    """SHA-256 of all entries' components by part, entry and place, joined by commas."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def op11_resident_lloyd(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    books, width = fit(rows)
    out = encode(rows, books, width).drop("embedding")
    by = out.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    return (out.join(by, F.col("label").eqNullSafe(F.col("of")), "left")
            .select("vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256")))


def _oracle() -> str:
    """The rounds written out: members, squared distances, means."""
    steps = []
    for k in range(1, ROUNDS + 2):
        steps.append(f"""a{k} AS MATERIALIZED (SELECT vec, part, min(d * {ENTRIES} + entry) % {ENTRIES} AS entry, min(d) AS d FROM (
            SELECT x.vec, x.part, c.entry, sum((x.x - c.x) * (x.x - c.x))::BIGINT AS d FROM x JOIN c{k - 1} c USING (part, i) GROUP BY ALL) GROUP BY ALL)""")
        if k <= ROUNDS:
            steps.append(f"""c{k} AS MATERIALIZED (SELECT c.part, c.entry, c.i, coalesce(m.x, c.x) AS x FROM c{k - 1} c LEFT JOIN (
            SELECT part, entry, i, ((s - ((s % n) + n) % n) // n)::BIGINT AS x FROM (SELECT part, a.entry, i, sum(x.x)::BIGINT AS s, count(*) AS n
            FROM x JOIN a{k} a USING (vec, part) GROUP BY ALL)) m USING (part, entry, i))""")
    return f"""
WITH kept AS MATERIALIZED (SELECT row_number() OVER (ORDER BY vec_id, embedding) AS vec, vec_id, label, embedding FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda v: v IS NULL OR NOT isfinite(v))) = 0),
x AS MATERIALIZED (SELECT vec, (k - 1) // (w // {PARTS}) AS part, (k - 1) % (w // {PARTS}) AS i, floor({SCALE} * v::DOUBLE)::BIGINT AS x FROM (
    SELECT vec, len(embedding) AS w, unnest(embedding) AS v, generate_subscripts(embedding, 1) AS k FROM kept)),
c0 AS MATERIALIZED (SELECT part, vec - 1 AS entry, i, x FROM x WHERE vec <= {ENTRIES}),
{", ".join(steps)},
coded AS (SELECT vec, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, sum(d)::BIGINT AS error FROM a{ROUNDS + 1} GROUP BY vec)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
       (SELECT sha256(string_agg(x::VARCHAR, ',' ORDER BY part, entry, i)) FROM c{ROUNDS}) AS codebooks_sha256
FROM kept JOIN coded USING (vec)"""


QUERY = {"op11_resident_lloyd": op11_resident_lloyd}
ORACLE = {"op11_resident_lloyd": _oracle()}
