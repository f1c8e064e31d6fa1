"""Quality classifier: nearest-neighbour voting in a latent semantic space.

Terms of a text are trigrams of its run-length collapsed character classes, word lengths, and counts of repeated and
distinct words (``TERMS`` hashed columns, from the whole text).  ``fit`` weights square roots of term shares by inverse document frequency and
keeps the leading singular directions of labelled rows; the number of directions and of neighbours is the one that judges an inner
split of these rows best (``DIRECTIONS``, ``VOTERS``; never more voters than the rarer label has rows).  ``score`` multiplies every text's vector with all labelled vectors in
blocks (exact cosines), takes the ``neighbours`` nearest and lets them vote by ``similarity ** SHARPNESS``; votes are weighted back
to the labels' shares, since the labelled rows are drawn per label.

The model is fitted on a bounded sample: at most ``per_label`` labelled rows per label (the least hashes of the id), so
what the driver sees and broadcasts has a fixed bound (``2 * per_label`` vectors of ``TERMS`` numbers).  Scoring covers
every row and is one narrow stage.

Null and empty texts have no terms and score 0.  Rows with a null label or id are not learned from; repeated label rows count once
(smallest label), repeated documents once.  Without labels of both kinds the score is the share of label 1 (0.5 without any label).
Repeated rows are scored alike.  Other columns pass through ``score``; one that is named like its output is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from capsight.llm import text_arrays as T
from capsight.llm.common import release, table, workers_import

SHAPES, LENGTHS = 512, 31
TERMS = SHAPES + 4 + LENGTHS + 1
PER_LABEL = 2000
DIRECTIONS = (8, 16, 32)
VOTERS = (1, 3, 5, 8)
FOLDS = 5
SHARPNESS = 8
THRESHOLD = 0.3
BLOCK = 1024

#: Characters as the shapes see them: letters by case (all beyond ASCII are lower), digits and blanks alike, signs as they are.
CLASSES = np.full(256, ord("a"), dtype=np.uint8)
CLASSES[:128] = [ord("a") if c.islower() else ord("A") if c.isupper() else ord("0") if c.isdigit() else ord(" ") if c in " \t\r\v\f" else ord(c)
                 for c in map(chr, range(128))]


def term_counts(texts: pa.Array) -> np.ndarray:
    """One row of term counts per text."""
    data, offsets = T.raw_bytes(texts)
    n = len(offsets) - 1
    out = np.zeros((n, TERMS), dtype=np.float32)
    if not len(data):
        return out
    kind = CLASSES[data]
    keep = np.ones(len(data), dtype=bool)
    keep[1:] = kind[1:] != kind[:-1]
    keep[offsets[:-1][offsets[:-1] < len(data)]] = True
    runs = kind[keep].astype(np.int64)
    owner = np.repeat(np.arange(n), np.diff(np.concatenate([[0], np.cumsum(keep)])[offsets]))
    edge = 10  # a text begins and ends like a line
    before, after = np.full(len(runs), edge), np.full(len(runs), edge)
    same = owner[1:] == owner[:-1]
    before[1:][same] = runs[:-1][same]
    after[:-1][same] = runs[1:][same]
    code = ((before * 131 + runs) * 131 + after) * 2654435761 >> 7
    out[:, :SHAPES] = np.bincount(owner * SHAPES + code % SHAPES, minlength=n * SHAPES).reshape(n, SHAPES)
    found = T.words(data, offsets)
    if len(found.hash):
        total = np.bincount(found.text, minlength=n)
        again = (found.hash[1:] == found.hash[:-1]) & (found.text[1:] == found.text[:-1])
        repeats = np.bincount(found.text[1:][again], minlength=n)
        distinct = np.bincount((T.shingle_keys(found, 1) >> np.uint64(48)).astype(np.int64), minlength=n)
        out[:, SHAPES], out[:, SHAPES + 1] = repeats, total - repeats
        out[:, SHAPES + 2], out[:, SHAPES + 3] = distinct, total - distinct
        sizes = found.text * (LENGTHS + 1) + np.minimum(found.length, LENGTHS)
        out[:, SHAPES + 4:] = np.bincount(sizes, minlength=n * (LENGTHS + 1)).reshape(n, LENGTHS + 1)
    return out


@dataclass
class Model:
    """Weights, directions and labelled vectors; ``share`` of label 1 where there is nothing to vote."""

    weights: np.ndarray
    directions: np.ndarray
    vectors: np.ndarray
    votes: np.ndarray  # weight of each labelled vector's vote
    labels: np.ndarray
    share: float
    neighbours: int = 1

    def vector(self, counts: np.ndarray) -> np.ndarray:
        shares = np.sqrt(counts / np.maximum(1, counts.sum(1, keepdims=True))) * self.weights
        latent = shares @ self.directions
        return latent / np.maximum(1e-9, np.linalg.norm(latent, axis=1, keepdims=True))

    def score(self, counts: np.ndarray) -> np.ndarray:
        out = np.full(len(counts), self.share)
        if len(self.vectors):
            k = min(self.neighbours, len(self.vectors))
            for at in range(0, len(counts), BLOCK):
                cosine = self.vector(counts[at:at + BLOCK]) @ self.vectors.T
                near = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
                weight = np.maximum(np.take_along_axis(cosine, near, 1), 1e-6).astype(np.float64) ** SHARPNESS * self.votes[near]
                out[at:at + BLOCK] = (weight * self.labels[near]).sum(1) / weight.sum(1)
        out[counts.sum(1) == 0] = 0.0
        return np.clip(out, 0.0, 1.0)


def held_out(key: Column, folds: int = 5) -> Column:
    """Rows that are never learned from: crc32 of the id as text is divisible by ``folds``."""
    return F.coalesce(F.crc32(key.cast("string")) % folds == 0, F.lit(False))


def labelled_sample(labels: DataFrame, per_label: int, key: str, label: str) -> tuple[DataFrame, dict[int, int]]:
    """``(doc_id, label)`` of the sample, and the number of rows of each label that it stands for."""
    one = (labels.filter(F.col(key).isNotNull() & F.col(label).isin(0, 1) & ~held_out(F.col(key)))
           .groupBy(F.col(key).alias("_id")).agg(F.min(label).cast("int").alias("_label")))
    counts = {r["_label"]: r["count"] for r in one.groupBy("_label").count().collect()}  # at most two rows
    # twice the expected rows by a hash first, so that the window's input is bounded too
    share = F.lit(0.0)
    for value, n in counts.items():
        share = F.when(F.col("_label") == value, min(1.0, (2 * per_label + 100) / n)).otherwise(share)
    one = one.filter(F.pmod(F.xxhash64("_id", F.lit(1)), F.lit(1 << 30)) < share * (1 << 30))
    order = Window.partitionBy("_label").orderBy(F.xxhash64("_id"), "_id")
    return one.withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= per_label).drop("_n"), counts


def latent(terms: np.ndarray, labels: np.ndarray, per: dict[int, float], share: float) -> tuple[Model, np.ndarray]:
    """A model of term counts without its directions, and all directions, leading first; ``per``: rows that a row of a label stands for."""
    weights = np.log((1 + len(terms)) / (1 + (terms > 0).sum(0))) + 1
    shares = np.sqrt(terms / terms.sum(1, keepdims=True)) * weights
    shares /= np.linalg.norm(shares, axis=1, keepdims=True)
    size, directions = np.linalg.eigh(shares.T @ shares)
    return Model(weights, directions, np.zeros((0, 1)), np.where(labels == 1, per[1], per[0]), labels, share), directions[:, np.argsort(-size)]


def with_directions(model: Model, terms: np.ndarray, directions: np.ndarray, neighbours: int) -> Model:
    out = replace(model, directions=directions, neighbours=neighbours)
    out.vectors = out.vector(terms).astype(np.float32)
    out.weights, out.directions = model.weights.astype(np.float32), directions.astype(np.float32)
    return out


def chosen(terms: np.ndarray, labels: np.ndarray, per: dict[int, float], share: float, directions: Sequence[int], voters: Sequence[int]) -> tuple[int, int]:
    """Directions and neighbours with the least error over an inner split: wrong rows of either label weigh alike at ``THRESHOLD``, then
    the squared error; ties go to fewer directions, then to more neighbours.
    """
    rarest = int(min((labels == 0).sum(), (labels == 1).sum()))
    options = [(d, k) for d in directions for k in voters if k <= max(1, rarest * (FOLDS - 1) // FOLDS)]
    if rarest < 2 or len(options) == 1:
        return options[0]
    fold = np.zeros(len(labels), dtype=np.int64)
    for value in (0, 1):
        fold[labels == value] = np.arange((labels == value).sum()) % FOLDS
    found = {o: np.zeros(len(labels)) for o in options}
    for f in range(FOLDS):
        learn, held = fold != f, fold == f
        if not held.any() or len(set(labels[learn])) < 2:
            continue
        base, every = latent(terms[learn], labels[learn], per, share)
        for d, k in options:
            found[d, k][held] = with_directions(base, terms[learn], every[:, :d], k).score(terms[held])
    weight = np.where(labels == 1, 0.5 / (labels == 1).sum(), 0.5 / (labels == 0).sum())

    def error(option: tuple[int, int]) -> tuple:
        score = found[option]
        return (float((weight * ((score >= THRESHOLD) != (labels == 1))).sum()), round(float((weight * (score - labels) ** 2).sum()), 6), option[0], -option[1])
    return min(options, key=error)


def fit(docs: DataFrame, labels: DataFrame, per_label: int = PER_LABEL, directions: Sequence[int] = DIRECTIONS, voters: Sequence[int] = VOTERS,
        text: str = "text", key: str = "doc_id", label: str = "quality") -> Model:
    """Latent directions and labelled vectors of at most ``2 * per_label`` rows."""
    workers_import(docs.sparkSession)
    sample, counts = labelled_sample(labels, per_label, key, label)
    texts = (docs.select(F.col(key).alias("_id"), F.col(text).alias("_text"))
             .join(F.broadcast(sample), "_id").groupBy("_id", "_label").agg(F.min("_text").alias("_text")))

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in batches:
            for a, b in T.slices(batch.column(2)):
                rows = term_counts(batch.column(2).slice(a, b - a))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a).cast(pa.int64()), batch.column(1).slice(a, b - a).cast(pa.int32()),
                                                  pa.array([r.tobytes() for r in rows], pa.binary())], ["id", "label", "terms"])

    rows = texts.mapInArrow(vectors, "id long, label int, terms binary").toPandas().sort_values("id")
    total = sum(counts.values())
    share = counts.get(1, 0) / total if total else 0.5
    terms = np.array([np.frombuffer(x, dtype=np.float32) for x in rows["terms"]], dtype=np.float64).reshape(len(rows), TERMS)
    label_ = rows["label"].to_numpy(dtype=np.float64)
    some = terms.sum(1) > 0
    terms, label_ = terms[some], label_[some]
    empty = Model(np.ones(TERMS), np.zeros((TERMS, 1)), np.zeros((0, 1)), np.zeros(0), np.zeros(0), share)
    if len(set(label_)) < 2:
        return empty
    per = {c: counts[c] / max(1, int((label_ == c).sum())) for c in (0, 1)}
    rank, neighbours = chosen(terms, label_, per, share, directions, voters)
    model, every = latent(terms, label_, per, share)
    return with_directions(model, terms, every[:, :rank], neighbours)


def score(docs: DataFrame, model: Model, text: str = "text", out: str = "quality_score") -> DataFrame:
    """``docs`` with the score of every whole text as the last column ``out``."""
    spark = docs.sparkSession
    workers_import(spark)
    rows = docs.drop(out)
    place = rows.columns.index(text)
    shared = spark.sparkContext.broadcast(model)
    schema = StructType([*rows.schema.fields, StructField(out, DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        known = shared.value
        for batch in batches:
            for a, b in T.slices(batch.column(place)):
                part = batch.slice(a, b - a)
                values = known.score(term_counts(part.column(place)))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(values, pa.float64())], [*part.schema.names, out])
            release()

    return rows.mapInArrow(run, schema)


def op4_quality_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(docs, table(spark, sf_dir, "labels"))
    out = score(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("quality_score").alias("score"))
    return out.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


QUERY = {"op4_quality_knn": op4_quality_knn}
