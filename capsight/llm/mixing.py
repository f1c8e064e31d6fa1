"""Mixing sources to target weights: fixed-length token blocks, multinomial shard counts, index permutations.

1. ``pack``: every document is a run of words of its source's token stream; the stream is cut into blocks of
   ``block`` words.  A document's offset comes from running sums in two steps (chunks of ``CHUNK_ROWS`` rows, then
   inside the chunk), so a source with a third of all rows is never summed in one task.
2. ``targets``: the shares of the weights 1, 2, 3, 1, ... over the sources by code point (null last), capped at
   ``cap`` times the source's size, the excess reshared by weight (water filling over one row per source).
3. ``shard_draws``: the mix is written as output shards of ``shard_slots`` slots.  Each shard draws its multinomial
   source counts from a hash seeded generator.  Slots past a source's target are dropped and a missing rest goes to
   one settling shard per source, so that totals hit the targets at any size.
4. slot ``i`` of a source reads block ``permutation(i mod N)`` of pass ``i div N``: a keyed affine permutation per
   source and pass.  A pass reads every block once, so no block is read over ``cap`` times.
5. ``mix`` joins slots to the block pieces of documents by (source, index).

Everything is a function of the rows and ``seed``: reruns agree, lost executors recompute the same values.

Null or empty texts have size 0 and nothing taken; null sources form a source of their own, the last; repeated
rows are documents of their own (also with one ``doc_id``); an empty table gives an empty mix.  Extra columns
pass untouched in ``mixed_documents`` and are left out of ``mix``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from capsight.llm.common import fresh, materialize, table, workers_import

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (1.0, 2.0, 3.0)
BLOCK = 64
CHUNK_ROWS = 1024
SOURCES = 100_000
SHARD_SLOTS = 16_384
CAP = 3.0


def words(text: Column) -> Column:
    """Number of words; zero for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sized: DataFrame, weights: tuple[float, ...] = WEIGHTS, cap: float = CAP) -> DataFrame:
    """``source, rank, source_size, target`` with one row per source of ``(source, size)`` rows.

    Water filling: with ``r = cap * size / weight`` ascending, the sources capped are the ones whose ``r`` is at
    most the level at which the others share what is left.
    """
    by = sized.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    order = Window.orderBy(F.col("source").isNull(), F.col("source"))  # one row per source
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.col("rank"), F.lit(len(weights))) + 1).cast("int"))
    by = by.withColumn("rank", F.row_number().over(order) - 1).withColumn("weight", weight)
    by = by.withColumn("full", F.lit(cap) * F.col("source_size")).withColumn("level", F.col("full") / F.col("weight"))
    up = Window.orderBy("level", "rank").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    every = Window.partitionBy(F.lit(0))
    by = by.withColumns({"done_full": F.sum("full").over(up), "done_weight": F.sum("weight").over(up),
                         "all_weight": F.sum("weight").over(every), "all_size": F.sum("source_size").over(every)})
    # the level if this source and all before it are capped; it holds while it is not under the source's own
    rest = F.greatest(F.col("all_weight") - F.col("done_weight"), F.lit(1e-12))
    level_after = (F.col("all_size") - F.col("done_full")) / rest
    capped = (F.col("all_weight") - F.col("done_weight") > 1e-9) & (level_after >= F.col("level"))
    by = by.withColumn("is_capped", capped)
    left_size = F.col("all_size") - F.coalesce(F.sum(F.when(F.col("is_capped"), F.col("full"))).over(every), F.lit(0.0))
    left_weight = F.col("all_weight") - F.coalesce(F.sum(F.when(F.col("is_capped"), F.col("weight"))).over(every), F.lit(0.0))
    shared = F.try_divide(left_size * F.col("weight"), left_weight)  # null where no source is left to share
    target = F.when(F.col("is_capped"), F.col("full")).otherwise(F.least(F.col("full"), shared))
    return by.withColumn("target", target).select("source", "rank", "source_size", "target")


def pack(sized: DataFrame, sources: DataFrame, block: int = BLOCK) -> DataFrame:
    """``sized`` rows with words as ``rank, at`` (offset of the row in its source's stream)."""
    spark = sized.sparkSession
    n = sized.count()
    chunk = F.pmod(F.xxhash64("uid"), F.lit(max(1, -(-n // CHUNK_ROWS))))
    rows = (sized.filter("size > 0").withColumn("chunk", chunk)
            .join(sources.select(F.col("source").alias("s"), "rank"), F.col("source").eqNullSafe(F.col("s"))).drop("s"))
    # a chunk of one source: at most about CHUNK_ROWS rows
    inside = Window.partitionBy("rank", "chunk").orderBy("uid").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    starts = (rows.groupBy("rank", "chunk").agg(F.sum("size").alias("total"))
              .withColumn("start", F.sum("total").over(Window.partitionBy("rank").orderBy("chunk")) - F.col("total"))
              .select("rank", "chunk", "start"))  # one row per chunk
    rows = rows.withColumn("inside", F.sum("size").over(inside) - F.col("size"))
    return (rows.join(starts, ["rank", "chunk"])
            .select("uid", "rank", "size", (F.col("start") + F.col("inside")).cast("long").alias("at")))


def shard_draws(plan: DataFrame, shard_slots: int = SHARD_SLOTS, seed: int = 7) -> DataFrame:
    """``rank, shard, first, count``: the slots ``[first, first + count)`` of a source that a shard holds.

    ``plan``: ``rank, slots`` with one row per source.  Each shard is drawn from its own seed, in tasks over ranges of shards that hold a
    copy of the plan (up to ``SOURCES`` sources; beyond, one task draws all); running counts give the slot numbers.
    """
    spark = plan.sparkSession
    workers_import(spark)

    def counts(shard: int, size: int, slots: np.ndarray) -> np.ndarray:
        return np.random.Generator(np.random.PCG64([seed, shard])).multinomial(size, slots / slots.sum())

    known = plan.agg(F.count("*").alias("sources"), F.sum("slots").alias("all")).first()
    every = int(known["all"] or 0)
    if known["sources"] <= SOURCES:  # a bounded plan: every task draws its shards from a copy
        shared = spark.sparkContext.broadcast([(r["rank"], r["slots"]) for r in plan.select("rank", "slots").orderBy("rank").collect()])
        shards = spark.range(-(-every // shard_slots)).select(F.col("id").alias("shard"))

        def draw(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            rank, slots = np.array(shared.value, dtype=np.int64).reshape(-1, 2).T
            for pdf in batches:
                for shard in pdf["shard"].tolist():
                    n = counts(shard, min(shard_slots, every - shard * shard_slots), slots.astype(float))
                    yield pd.DataFrame({"rank": rank[n > 0], "shard": shard, "count": n[n > 0]}).astype("int64")
    else:  # the shares travel with the shards' rows, in one task
        shares = plan.agg(F.sort_array(F.collect_list(F.struct("rank", "slots"))).alias("mix"))
        shards = shares.withColumn("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(max(0, -(-every // shard_slots) - 1))))).filter(F.lit(every > 0))

        def draw(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                for shard, mix in zip(pdf["shard"].tolist(), pdf["mix"]):
                    rank, slots = np.array([(m["rank"], m["slots"]) for m in mix], dtype=np.int64).T
                    n = counts(shard, min(shard_slots, every - shard * shard_slots), slots.astype(float))
                    yield pd.DataFrame({"rank": rank[n > 0], "shard": shard, "count": n[n > 0]}).astype("int64")

    drawn = shards.mapInPandas(draw, "rank long, shard long, count long")
    up = Window.partitionBy("rank").orderBy("shard")  # one row per shard and source
    drawn = drawn.withColumn("first", F.sum("count").over(up) - F.col("count")).join(plan.select("rank", "slots"), "rank")
    kept = drawn.filter("first < slots").withColumn("count", F.least("count", F.col("slots") - F.col("first")))
    got = kept.groupBy("rank").agg(F.sum("count").alias("got"))
    settle = (plan.join(got, "rank", "left").withColumn("got", F.coalesce("got", F.lit(0))).filter("slots > got")
              .select("rank", F.lit(-1).cast("long").alias("shard"), F.col("got").alias("first"), (F.col("slots") - F.col("got")).alias("count")))
    return kept.select("rank", "shard", "first", "count").unionByName(settle)


#: Primes just under 2^31: coprime to every smaller number of blocks, so multiplying by one permutes the indexes.
PRIMES = (2147483647, 2147483629, 2147483587, 2147483579, 2147483563, 2147483549, 2147483543, 2147483497)


def permuted(slot: Column, blocks: Column, rank: Column, seed: int) -> Column:
    """Block of a slot: pass ``p = slot div blocks`` maps ``x`` to ``(a x + c) mod blocks``, a keyed affine permutation.

    ``a`` is a prime above ``blocks`` times one of another pick, reduced, and ``c`` a keyed shift, both drawn per source
    and pass.  A bijection on ``[0, blocks)`` for fewer than 2^31 blocks; larger sources take larger blocks.
    """
    turn = F.floor(slot / blocks)
    draw = F.xxhash64(F.lit(seed), rank, turn)
    pick = F.element_at(F.array(*map(F.lit, PRIMES)), (F.pmod(draw, F.lit(len(PRIMES))) + 1).cast("int"))
    second = F.element_at(F.array(*map(F.lit, PRIMES)), (F.pmod(F.shiftright(draw, 8), F.lit(len(PRIMES))) + 1).cast("int"))
    factor = F.pmod(F.pmod(pick, blocks) * F.pmod(second, blocks), blocks)
    return F.pmod(factor * F.pmod(slot, blocks) + F.pmod(F.shiftright(draw, 16), blocks), blocks).cast("long")


def mix_plan(sized: DataFrame, weights: tuple[float, ...] = WEIGHTS, cap: float = CAP, block: int = BLOCK) -> DataFrame:
    """``source, rank, source_size, target, blocks, slots``: one row per source."""
    by = targets(sized, weights, cap)
    blocks = F.ceil(F.col("source_size") / block)
    share = F.coalesce(F.try_divide(F.col("target"), F.col("source_size")), F.lit(0.0))  # a source without words takes nothing
    slots = F.least(F.round(share * blocks), F.floor(F.lit(cap) * blocks))
    return by.withColumn("blocks", blocks.cast("long")).withColumn("slots", F.coalesce(slots, F.lit(0)).cast("long"))


def pieces(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """``rank, index, uid, first_word, n_words``: the part of each document in each block of its source."""
    start, stop = F.floor(F.col("at") / block), F.floor((F.col("at") + F.col("size") - 1) / block)
    cut = rows.withColumn("index", F.explode(F.sequence(start, stop)))
    first = F.greatest(F.col("index") * block, F.col("at"))
    last = F.least((F.col("index") + 1) * block, F.col("at") + F.col("size"))
    return cut.select("rank", F.col("index").cast("long").alias("index"), "uid", (first - F.col("at")).alias("first_word"), (last - first).alias("n_words"))


def block_reads(plan: DataFrame, draws: DataFrame, seed: int = 7) -> DataFrame:
    """``rank, index, shard, slot``: one row per slot of the mix."""
    slots = draws.withColumn("slot", F.explode(F.expr("sequence(first, first + count - 1)")))
    slots = slots.join(plan.select("rank", "blocks"), "rank")
    return slots.select("rank", permuted(F.col("slot"), F.col("blocks"), F.col("rank"), seed).alias("index"), "shard", "slot")


def sized_rows(docs: DataFrame, text: str = "text", key: str = "doc_id", source: str = "source") -> DataFrame:
    """The narrow rows of the mix: ``doc_id, source, size, text_key`` and a ``row`` number of the written table."""
    return materialize(docs.select(F.col(key).alias("doc_id"), F.col(source).alias("source"), words(F.col(text)).alias("size"),
                                   F.xxhash64(text).alias("text_key"), F.monotonically_increasing_id().alias("row")), "sized")


def repeats(rows: DataFrame) -> bool:
    """Whether any (doc_id, source, text) occurs twice."""
    return not rows.groupBy("doc_id", "source", "text_key").count().filter("count > 1").isEmpty()


def numbered(sized: DataFrame) -> DataFrame:
    """Rows of ``sized`` with ``uid``, one number per (doc_id, source, text) so that reruns agree; repeats are told apart.

    Repeats are equal, so any numbers do.  They are numbered in two steps, within the files' chunks (a part of a written table and every
    ``CHUNK_ROWS`` rows of it), then by running counts over the chunks, so a row that repeats often is split.
    """
    what = ["doc_id", "source", "text_key"]
    if not repeats(sized):
        return sized.withColumn("uid", F.xxhash64(*what, F.lit(1).cast("long")))
    rows = sized.withColumn("part", F.floor(F.col("row") / CHUNK_ROWS))
    inside = F.row_number().over(Window.partitionBy(*what, "part").orderBy("row"))
    counts = rows.groupBy(*what, "part").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy(*what).orderBy("part")) - F.col("n")
    offsets = counts.withColumn("before", before).filter("before > 0").select(*[F.col(c).alias(f"_{c}") for c in what], F.col("part").alias("_part"), "before")
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in (*what, "part")]
    rows = rows.withColumn("inside", inside).join(offsets, same, "left")
    return rows.withColumn("uid", F.xxhash64(*what, F.col("inside") + F.coalesce("before", F.lit(0)))).select(*sized.columns, "uid")


def mix(sized: DataFrame, weights: tuple[float, ...] = WEIGHTS, cap: float = CAP, block: int = BLOCK,
        shard_slots: int = SHARD_SLOTS, seed: int = 7) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(rows, plan, reads)``: numbered rows, the plan per source, and ``uid, first_word, n_words, shard, slot``."""
    rows = materialize(numbered(sized), "mix-rows")
    plan = materialize(mix_plan(rows, weights, cap, block), "mix-plan")
    reads = block_reads(plan, shard_draws(plan, shard_slots, seed), seed)
    parts = pieces(pack(rows, plan, block), block)
    # the number of reads grows with the corpus, which the planner cannot see: never broadcast
    return rows, plan, reads.hint("merge").join(parts, ["rank", "index"]).drop("rank", "index")


def taken_words(docs: DataFrame, text: str = "text", key: str = "doc_id", source: str = "source", **options) -> DataFrame:
    """``doc_id, size, source_size, target, taken`` for every row of ``docs``."""
    rows, plan, reads = mix(sized_rows(docs, text, key, source), **options)
    taken = reads.groupBy("uid").agg(F.sum("n_words").alias("taken"))
    plan = plan.select(F.col("source").alias("s"), "source_size", "target")
    return (rows.join(taken, "uid", "left").join(plan, F.col("source").eqNullSafe(F.col("s")), "left")
            .select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken")))


def mixed_documents(docs: DataFrame, text: str = "text", key: str = "doc_id", source: str = "source", **options) -> DataFrame:
    """The documents of the mix with the columns of ``docs``: each text holds the words that the mix takes of it.

    Pieces stand in the order of their pass and their place in the document; a whole document taken once keeps its
    text as it is, otherwise its words are joined by one space.  Documents of which nothing is taken are left out.
    """
    sized = sized_rows(docs, text, key, source)
    rows, _, reads = mix(sized, **options)
    uid, runs, taken, size = (fresh(docs, name) for name in ("_uid", "_reads", "_taken", "_size"))
    order = F.sort_array(F.collect_list(F.struct("slot", "first_word", "n_words")))  # of one document
    per_doc = (rows.join(reads.groupBy("uid").agg(order.alias("reads"), F.sum("n_words").alias("taken")), "uid")
               .select(F.col("uid").alias(uid), F.col("reads").alias(runs), F.col("taken").alias(taken), F.col("size").alias(size)))
    what = [F.col(key), F.col(source), F.xxhash64(text)]
    # without repeats no text goes through a window
    number = F.row_number().over(Window.partitionBy(*what).orderBy(F.lit(0))) if repeats(rows) else F.lit(1)
    whole = docs.withColumn(uid, F.xxhash64(*what, number.cast("long"))).join(per_doc, uid)
    # the words are found once per document: the one-element array binds them for the inner steps
    bound = F.array(F.regexp_extract_all(F.col(text), F.lit(WORD), F.lit(0)))
    taken_text = F.get(F.transform(bound, lambda w: F.array_join(F.flatten(F.transform(
        F.col(runs), lambda r: F.slice(w, (r["first_word"] + 1).cast("int"), r["n_words"].cast("int")))), " ")), 0)
    starts = F.transform(F.col(runs), lambda r: r["first_word"])
    once = (F.col(taken) == F.col(size)) & (F.size(F.array_distinct(starts)) == F.size(runs))
    out = whole.withColumn(text, F.when(once, F.col(text)).otherwise(taken_text))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length(text).cast(dict(docs.dtypes)["n_chars"]))
    return out.select(*docs.columns)


def op8_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return taken_words(table(spark, sf_dir, "documents"))


QUERY = {"op8_source_mix": op8_source_mix}
