"""Exact duplicates: Golomb-coded fingerprint exchange, duplicate bitmaps, byte verification of the suspects.

1. ``blocks``: every task cuts its rows into blocks of bounded rows and bytes.  Equal texts of a block (compared by bytes) become one
   class led by its row with the largest key; classes are numbered by their SHA-256.  The rows are written once, bucketed by block.
2. ``send``: per block and owner the sorted fingerprints (the digest's first bits, ``SPARE_BITS`` more than the table needs) travel as gaps in a
   Golomb code whose divisor is the power of two that fits their density.  Owners hold equal ranges of fingerprints.
3. ``answer``: an owner decodes its messages and returns, per message, a bitmap of the fingerprints that it has received more than once.
4. The bitmaps go to their blocks' buckets, where the texts lie, so no text moves; only leaders with a set bit are suspects.
5. Suspects are shuffled and grouped by their whole bytes.  A false suspect comes out alone.  The verified classes are joined to the rows.

A text with a third of all rows travels at most once per block, and partial aggregation combines it again before the shuffle.  Nothing is
collected; owners and blocks have bounded sizes, since digests spread evenly and a class has one fingerprint per block.

Null texts count as empty and equal empty ones.  Of rows that share a group's largest key one (any) is kept, so each group
keeps exactly one row; null keys are the smallest, and a group of null keys has a null ``keep_id``.  An empty table gives an empty
result.  Other columns are ignored.  Written tables lie in the shared folder; the bucketed one is entered in the session's catalog.
"""

from __future__ import annotations

import hashlib
import math
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from capsight.llm.common import materialize, release, shared_dir, table, workers_import

BLOCK_ROWS = 1 << 15
BLOCK_BYTES = 24 << 20
OWNER_ROWS = 1 << 20
SPARE_BITS = 12
MARK_BITS = 63  # of the digest, as a long that keeps its order
POS_BITS = 16  # places within a block; a block has fewer than two times BLOCK_ROWS rows
CHUNK_BITS = 21  # blocks of a task


def encode(values: np.ndarray, span: int) -> tuple[int, bytes]:
    """Golomb code of sorted numbers in ``[0, span)``: the divisor's exponent, then remainders and unary quotients of the gaps."""
    k = max(0, int(math.log2(max(1.0, span / len(values) * math.log(2)))))
    gaps = np.diff(values, prepend=0)
    rest = (gaps[:, None] >> np.arange(k - 1, -1, -1)) & 1
    ends = np.cumsum((gaps >> k) + 1) - 1
    unary = np.zeros(int(ends[-1]) + 1, dtype=np.uint8)
    unary[ends] = 1
    return k, np.packbits(rest.astype(np.uint8).ravel()).tobytes() + np.packbits(unary).tobytes()


def decode(k: int, count: int, code: bytes) -> np.ndarray:
    """The numbers of ``encode``."""
    data = np.frombuffer(code, dtype=np.uint8)
    cut = -(-count * k // 8)
    rest = np.unpackbits(data[:cut], count=count * k).reshape(count, k).astype(np.int64) @ (1 << np.arange(k - 1, -1, -1, dtype=np.int64))
    ends = np.flatnonzero(np.unpackbits(data[cut:]))[:count]
    return np.cumsum(((np.diff(ends, prepend=-1) - 1) << k) | rest)


def _in_blocks(batches: Iterator[pa.RecordBatch], rows: int, size: int) -> Iterator[pa.Table]:
    held, n, held_bytes = [], 0, 0
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            part = batch.slice(at, rows)
            held.append(part)
            n, held_bytes = n + part.num_rows, held_bytes + part.nbytes
            if n >= rows or held_bytes >= size:
                yield pa.Table.from_batches(held)
                held, n, held_bytes = [], 0, 0
    if n:
        yield pa.Table.from_batches(held)


def _settled(rows: pa.Table, digest: Callable[[bytes], bytes]) -> dict[str, pa.Array]:
    """One block of ``id, text``: its rows by class, classes in the order of their digests."""
    ids, texts = rows.column("id").combine_chunks(), rows.column("text").combine_chunks()
    seen: dict[bytes, int] = {}
    first = np.array([seen.setdefault(t, len(seen)) for t in texts.to_pylist()])
    digests = [digest(t) for t in seen]
    order = sorted(range(len(digests)), key=digests.__getitem__)
    pos = np.empty(len(order), dtype=np.int64)
    pos[order] = np.arange(len(order))
    of = pos[first]
    rank = pc.rank(ids, sort_keys="ascending", null_placement="at_start", tiebreaker="first").to_numpy()
    at = np.lexsort((rank, of))
    lead = np.append(of[at][1:] != of[at][:-1], True)  # the last of a class has its largest id
    top = at[lead][of[at]]
    digests = [digests[k] for k in order]
    marks = np.array([int.from_bytes(d[:8]) >> (64 - MARK_BITS) for d in digests], dtype=np.int64)
    return {"pos": pa.array(of[at].astype(np.int32)), "id": ids.take(pa.array(at)), "text_sha256": pa.array(digests, pa.binary()).take(pa.array(of[at])),
            "mark": pa.array(marks[of[at]]), "copies": pa.array(np.bincount(of)[of[at]]), "top": ids.take(pa.array(top)), "lead": pa.array(lead),
            "text": pc.if_else(pa.array(lead), texts.take(pa.array(at)), pa.scalar(None, texts.type))}


def _sha256(text: bytes) -> bytes:
    return hashlib.sha256(text).digest()


def blocks(docs: DataFrame, text: Column, key: str, buckets: int, digest: Callable[[bytes], bytes] = _sha256) -> DataFrame:
    """The rows in blocks, as a written table bucketed by block; ``text`` stands in the leaders' rows alone."""
    spark = docs.sparkSession
    rows = docs.select(F.col(key).alias("id"), F.coalesce(text.cast("binary"), F.lit(b"")).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        for chunk, part in enumerate(_in_blocks(batches, BLOCK_ROWS, BLOCK_BYTES)):
            block = pa.array(np.full(part.num_rows, (task << CHUNK_BITS) + chunk, dtype=np.int64))
            yield pa.RecordBatch.from_pydict({"block": block, **_settled(part, digest)})
            release()

    out = rows.mapInArrow(run, f"block long, pos int, id {kind}, text_sha256 binary, mark long, copies long, top {kind}, lead boolean, text binary")
    name = f"capsight_exact_{uuid.uuid4().hex}"
    (out.write.format("parquet").option("path", f"{shared_dir(spark)}/capsight/{name}").bucketBy(buckets, "block").sortBy("block", "pos").saveAsTable(name))
    return spark.table(name)


def send(leaders: DataFrame, bits: int, owner_bits: int) -> DataFrame:
    """``owner, block, first, count, k, code``: a message for every run of a block's classes that one owner holds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _in_blocks(batches, 1 << 20, 1 << 30):
            block, pos, mark = (part.column(k).to_numpy() for k in range(3))
            at = np.lexsort((pos, block))
            block, pos, mark = block[at], pos[at], mark[at] >> (MARK_BITS - bits)
            owner = mark >> (bits - owner_bits)
            inside = mark - (owner << (bits - owner_bits))
            cut = np.flatnonzero((np.diff(block) != 0) | (np.diff(owner) != 0) | (np.diff(pos) != 1)) + 1
            starts, stops = np.append(0, cut), np.append(cut, len(block))
            coded = [encode(inside[a:b], 1 << (bits - owner_bits)) for a, b in zip(starts, stops)]
            yield pa.RecordBatch.from_arrays([pa.array(owner[starts].astype(np.int64)), pa.array(block[starts]), pa.array(pos[starts]), pa.array((stops - starts).astype(np.int32)),
                                              pa.array([k for k, _ in coded], pa.int32()), pa.array([c for _, c in coded], pa.binary())],
                                             ["owner", "block", "first", "count", "k", "code"])

    return leaders.select("block", "pos", "mark").mapInArrow(run, "owner long, block long, first int, count int, k int, code binary")


def _answer(messages: pa.Table) -> pa.Table:
    """``block, first, count, bits`` of the messages of one owner that hold a fingerprint received twice."""
    counts = messages.column("count").to_numpy()
    values = np.concatenate([decode(k, n, c) for k, n, c in zip(messages.column("k").to_pylist(), counts.tolist(), messages.column("code").to_pylist())])
    _, at, times = np.unique(values, return_inverse=True, return_counts=True)
    flags = np.split(times[at] > 1, np.cumsum(counts)[:-1])
    some = np.array([f.any() for f in flags])
    bits = [np.packbits(f).tobytes() for f, any_ in zip(flags, some) if any_]
    return messages.select(["block", "first", "count"]).filter(pa.array(some)).append_column("bits", pa.array(bits, pa.binary()))


def _assembled(answers: pa.Table) -> pa.Table:
    """The bitmap of one block from the answers of its owners."""
    first, counts = answers.column("first").to_numpy(), answers.column("count").to_numpy()
    out = np.zeros(int((first + counts).max()), dtype=np.uint8)
    for at, n, bits in zip(first, counts, answers.column("bits").to_pylist()):
        out[at:at + n] = np.unpackbits(np.frombuffer(bits, dtype=np.uint8), count=n)
    return pa.table({"block": answers.column("block").slice(0, 1), "bits": pa.array([np.packbits(out).tobytes()], pa.binary())})


def exact_duplicates(docs: DataFrame, text: str = "text", key: str = "doc_id", normalise: Callable[[Column], Column] | None = None,
                     buckets: int | None = None, digest: Callable[[bytes], bytes] = _sha256, spare_bits: int = SPARE_BITS) -> DataFrame:
    """``<key>, keep_id, group_size, kept, text_sha256`` for every row of ``docs``; ``normalise`` is applied to the text first.

    ``buckets`` (the session's shuffle partitions by default) is the number of parts in which suspects are picked out.
    """
    spark = docs.sparkSession
    workers_import(spark)
    body = normalise(F.col(text)) if normalise else F.col(text)
    rows = blocks(docs, body, key, buckets or int(spark.conf.get("spark.sql.shuffle.partitions")), digest)
    leaders = rows.filter("lead")
    n = max(1, rows.count())  # from the files' footers
    owner_bits = max(5, (-(-n // OWNER_ROWS) - 1).bit_length())
    bits = min(MARK_BITS, max(owner_bits + 1, n.bit_length() + spare_bits))
    answers = send(leaders, bits, owner_bits).groupBy("owner").applyInArrow(_answer, "block long, first int, count int, bits binary")
    bitmaps = materialize(answers.groupBy("block").applyInArrow(_assembled, "block long, bits binary"), "exact-bitmaps")
    bit = F.expr("shiftright(cast(conv(hex(substring(bits, cast(pos div 8 as int) + 1, 1)), 16, 10) as int), 7 - pos % 8) % 2 = 1")
    suspects = leaders.join(bitmaps.hint("shuffle_hash"), "block").filter(bit)
    place = F.shiftleft("block", POS_BITS) + F.col("pos")
    suspects = suspects.select("text_sha256", "text", "id", "copies", place.alias("place"))
    same = ["text_sha256", "text"]
    verified = suspects.groupBy(*same).agg(F.max("id").alias("class_id"), F.sum("copies").alias("class_size"), F.count("*").alias("leads"),
                                           F.coalesce(F.max_by("place", "id"), F.max("place")).alias("class_place"))
    classes = materialize(verified.filter("leads > 1").drop("text", "leads"), "exact-classes")
    if not classes.groupBy("text_sha256").count().filter("count > 1").isEmpty():  # two texts of one digest: told apart by their bytes
        full = verified.join(suspects.select(*same, "place"), same).select("place", "class_id", "class_size", "class_place")
        at_lead = leaders.withColumn("place", place).join(full, "place", "left").select("block", "pos", "class_id", "class_size", "class_place")
        found = rows.drop("text").join(at_lead, ["block", "pos"], "left")
    else:
        found = rows.drop("text").join(classes, "text_sha256", "left")
    single = F.col("class_size").isNull()
    return found.select(F.col("id").alias(key), F.when(single, F.col("top")).otherwise(F.col("class_id")).alias("keep_id"),
                        F.coalesce("class_size", "copies").alias("group_size"), (F.col("lead") & (single | (place == F.col("class_place")))).alias("kept"),
                        F.lower(F.hex("text_sha256")).alias("text_sha256"))


def op13_golomb_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(table(spark, sf_dir, "documents"))


QUERY = {"op13_golomb_exact_dedup": op13_golomb_exact_dedup}
ORACLE = {"op13_golomb_exact_dedup": """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))"""}
