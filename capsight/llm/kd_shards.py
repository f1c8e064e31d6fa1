"""K-d tree sharding: recursive splits at distributed weighted medians of the widest metadata dimension.

``kd_shards`` splits the whole table until there are ``shards`` leaves (each node gets its part of the
shards, so any count works, not only powers of two) or, with ``target_bytes``, until the leaves reach that
size.  At each node the dimension with the widest spread, relative to its spread over the whole table, is
cut at the byte-weighted quantile that its shards ask for.  Rows that tie on the dimension are cut further by a hash of
``doc_id`` and then by a row number that the written table gives every row, so a value, a source, a group of copies or of
rows without id that holds a third of all rows is split like any other and the law is ``bytes``: shard sizes differ by
about one document.

The median is exact to ``tolerance`` (a share of a shard) and never gathers a group: each pass histograms
every node's still undecided interval of a key into ``BINS`` bins by one aggregation with map-side
combine, keeps the bin that holds the cut and repeats inside it.  Nodes, histograms and cuts are tables; the driver only
learns whether a cut is still open, so leaves may be as many as the data ask for.
All passes read a narrow written table (id, size, dimensions), never the texts.  A text dimension is ordered by the rank of
its distinct values, whole ones, from a range-partitioned sort of these.

Slots are gapless from 0 in each shard without a window over a whole shard: shards are dealt into buckets of
about ``SLOT_ROWS`` rows by a hash of the row number, buckets are numbered by running counts and rows inside their bucket.

Null texts have size 1 and no checksum (``text_crc32`` null); null and not-a-number metadata count as the smallest value; repeated
rows (also a repeated ``doc_id``) are kept and get slots of their own; an empty table gives an empty result.
Columns of the input that clash with outputs are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from capsight.llm.common import materialize, table

BINS = 512
SLOT_ROWS = 20_000
KEYS = ("value", "tie", "row")  # a node is cut by the first, rows that tie on it by the next

#: Metadata dimensions as columns of the input; each is put on a numeric scale that keeps its order.
DIMENSIONS = ("source", "lang", "n_chars", "doc_id")


def ranks(rows: DataFrame, name: str) -> DataFrame:
    """``<name>, rank``: the distinct values of a column by their place in order."""
    values = rows.select(name).filter(F.col(name).isNotNull()).distinct()
    placed = materialize(values.repartitionByRange(name).sortWithinPartitions(name).withColumn("at", F.monotonically_increasing_id()), "kd-values")
    part, inside = F.shiftright("at", 33), F.col("at").bitwiseAND((1 << 33) - 1)
    counts = placed.groupBy(part.alias("part")).agg(F.count("*").alias("n"))
    before = counts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))  # one row per partition of the sort
    return placed.withColumn("part", part).join(before, "part").select(name, (F.col("before") + inside).cast("double").alias("rank"))


def _narrow(docs: DataFrame, dimensions: tuple[str, ...], text: str, key: str) -> DataFrame:
    """``doc_id, size, text_crc32, tie, row, dims``: ``dims`` holds a number per dimension."""
    body = F.encode(F.col(text), "UTF-8")
    kinds = dict(docs.dtypes)
    words = [i for i, d in enumerate(dimensions) if kinds[d] in ("string", "binary")]
    number = [F.col(d).alias(f"d{i}") if i in words else F.coalesce(F.nanvl(F.col(d).cast("double"), F.lit(-1.0)), F.lit(-1.0)).alias(f"d{i}") for i, d in enumerate(dimensions)]
    rows = docs.select(F.col(key).alias("doc_id"), (F.coalesce(F.octet_length(body), F.lit(0)) + 1).cast("long").alias("size"),
                       F.crc32(body).alias("text_crc32"), F.xxhash64(F.col(key)).cast("double").alias("tie"), *number)
    rows = materialize(rows.withColumn("row", F.monotonically_increasing_id().cast("double")), "kd-rows")
    for i in words:
        rows = rows.join(ranks(rows, f"d{i}"), f"d{i}", "left").drop(f"d{i}").withColumn(f"d{i}", F.coalesce("rank", F.lit(-1.0))).drop("rank")
    return rows.select("doc_id", "size", "text_crc32", "tie", "row", F.array(*[f"d{i}" for i in range(len(dimensions))]).alias("dims"))


def _past(value: Column, bits: int) -> Column:
    """A number just above ``value``."""
    return value + F.greatest(F.abs(value), F.lit(1.0)) * F.lit(2.0 ** -bits)


def _cut(rows: DataFrame, nodes: DataFrame, key: str, tolerance: float) -> DataFrame:
    """``node, low, high, below, bytes`` for the rows of ``nodes`` (``node, wanted, below, low, high``): the interval of the column
    ``key`` in which ``wanted`` bytes are reached, the bytes below it and inside.  Inside are at most ``tolerance`` bytes or one value.
    """
    now = nodes.withColumns({"bytes": F.lit(None).cast("long"), "open": F.lit(True)})
    while True:
        left = now.filter("open").select("node", "wanted", "below", "low", "high")
        inside = rows.join(left, "node").filter((F.col(key) >= F.col("low")) & (F.col(key) < F.col("high")))
        bin_ = F.least(F.floor((F.col(key) - F.col("low")) / ((F.col("high") - F.col("low")) / BINS)), F.lit(BINS - 1)).cast("int")
        bins = inside.groupBy("node", bin_.alias("bin")).agg(F.sum("size").alias("in_bin"), F.min(key).alias("least"), F.max(key).alias("most"))
        up = Window.partitionBy("node").orderBy("bin")  # at most BINS rows of a node
        bins = bins.withColumns({"upto": F.sum("in_bin").over(up), "last": F.lead("bin").over(up).isNull()}).join(left, "node")
        holds = bins.filter((F.col("below") + F.col("upto") >= F.col("wanted")) | F.col("last"))
        found = F.min_by(F.struct("wanted", (F.col("below") + F.col("upto") - F.col("in_bin")).alias("below"), F.col("least").alias("low"), _past(F.col("most"), 51).alias("high"),
                                  F.col("in_bin").alias("bytes"), (F.col("high") - F.col("low")).alias("width"), (F.col("least") == F.col("most")).alias("one")), "bin")
        new = holds.groupBy("node").agg(found.alias("c")).select("node", "c.*")
        new = new.withColumn("open", ~F.col("one") & (F.col("bytes") > tolerance) & (F.col("high") - F.col("low") < F.col("width"))).drop("one", "width")
        now = materialize(now.filter("NOT open").unionByName(new.select(*now.columns)), "kd-cut")
        if now.filter("open").isEmpty():
            return now.drop("open")


def _inside(key: str) -> Column:
    return (F.col(key) >= F.col(f"{key}_low")) & (F.col(key) < F.col(f"{key}_high"))


def _level(rows: DataFrame, nodes: DataFrame, whole: list[float], tolerance: float) -> DataFrame:
    """The cuts of all nodes with more than one shard: ``node`` and per key the interval (null where it is not asked); ``near``: the
    rest inside the last one lies nearer to the lower side.
    """
    dims = range(len(whole))
    spans = [F.min(F.get("dims", F.lit(i))).alias(f"lo{i}") for i in dims] + [F.max(F.get("dims", F.lit(i))).alias(f"hi{i}") for i in dims]
    stats = rows.groupBy("node").agg(F.sum("size").alias("total"), *spans).join(nodes.filter("parts > 1"), "node")
    spread = F.array(*[(F.col(f"hi{i}") - F.col(f"lo{i}")) / F.lit(whole[i]) for i in dims])
    pick = (F.array_position(spread, F.array_max(spread)) - 1).cast("int")
    lows, highs = F.array(*[F.col(f"lo{i}") for i in dims]), F.array(*[F.col(f"hi{i}") for i in dims])
    plan = stats.select("node", pick.alias("widest"), (F.col("total") * F.floor(F.col("parts") / 2) / F.col("parts")).alias("wanted"), F.lit(0).cast("long").alias("below"),
                        F.get(lows, pick).alias("low"), _past(F.get(highs, pick), 50).alias("high"))
    plan = materialize(plan, "kd-plan")
    held = rows.join(plan.select("node", "widest"), "node").withColumn("value", F.get("dims", F.col("widest")))
    cuts, ask = plan.select("node", "widest", "wanted"), plan.drop("widest")
    for key in KEYS:
        found = _cut(held, ask, key, tolerance)
        cuts = cuts.join(found.select("node", F.col("low").alias(f"{key}_low"), F.col("high").alias(f"{key}_high"), F.col("below").alias(f"{key}_below"), F.col("bytes").alias(f"{key}_bytes")), "node", "left")
        if key == KEYS[-1]:
            break
        tied = found.filter(F.col("bytes") > tolerance)
        if tied.isEmpty():
            cuts = cuts.withColumns({f"{k}_{c}": F.lit(None).cast("double") for k in KEYS[KEYS.index(key) + 1:] for c in ("low", "high", "below", "bytes")})
            break
        held = held.join(tied.select("node", F.col("low").alias(f"{key}_low"), F.col("high").alias(f"{key}_high")), "node").filter(_inside(key)).drop(f"{key}_low", f"{key}_high")
        following = KEYS[KEYS.index(key) + 1]
        ends = held.groupBy("node").agg(F.min(following).alias("low"), _past(F.max(following), 50).alias("high"))
        ask = materialize(tied.select("node", "wanted", "below").join(ends, "node"), "kd-ask")
    below, size = (F.coalesce(*[f"{k}_{c}" for k in reversed(KEYS)]) for c in ("below", "bytes"))
    return materialize(cuts.withColumn("near", below + size / 2 < F.col("wanted")), "kd-cuts")


def _lower() -> Column:
    """Whether a row goes to the lower side of its node's cut."""
    side = F.col("near")
    for key in reversed(KEYS):
        asked = F.col(f"{key}_low").isNotNull()
        side = F.when(asked, (F.col(key) < F.col(f"{key}_low")) | (_inside(key) & side)).otherwise(F.col("near"))
    return side


def kd_shards(docs: DataFrame, shards: int = 16, target_bytes: int | None = None,
              dimensions: tuple[str, ...] = DIMENSIONS, text: str = "text", key: str = "doc_id",
              tolerance: float = 0.002) -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot`` for every row of ``docs``."""
    rows = materialize(_narrow(docs, dimensions, text, key), "kd")
    dims = range(len(dimensions))
    spans = [(F.max(F.get("dims", F.lit(i))) - F.min(F.get("dims", F.lit(i)))).alias(f"s{i}") for i in dims]
    total = rows.agg(F.sum("size").alias("size"), F.count("*").alias("n"), *spans).first()
    if target_bytes and total["size"]:
        shards = max(1, -(-total["size"] // target_bytes))
    rows = rows.withColumn("node", F.lit(0).cast("long"))
    nodes = docs.sparkSession.range(1).select(F.col("id").alias("node"), F.lit(shards).cast("long").alias("parts"), F.lit(0).cast("long").alias("first"))
    if total["n"]:
        whole = [max(total[f"s{i}"], 1e-300) for i in dims]
        for _ in range((shards - 1).bit_length()):
            cuts = _level(rows, nodes, whole, tolerance * total["size"] / shards)
            cut = rows.join(cuts, "node", "left").withColumn("value", F.get("dims", F.col("widest")))
            child = F.when(F.col("widest").isNull(), F.col("node")).when(_lower(), F.col("node") * 2 + 1).otherwise(F.col("node") * 2 + 2)
            rows = materialize(cut.withColumn("node", child).select(*rows.columns), "kd")
            half = F.floor(F.col("parts") / 2)
            children = F.when(F.col("parts") > 1, F.array(F.struct((F.col("node") * 2 + 1).alias("node"), half.alias("parts"), F.col("first").alias("first")),
                                                          F.struct((F.col("node") * 2 + 2).alias("node"), (F.col("parts") - half).alias("parts"), (F.col("first") + half).alias("first"))))
            nodes = materialize(nodes.select(F.explode(F.coalesce(children, F.array(F.struct("node", "parts", "first")))).alias("c")).select("c.*"), "kd-nodes")
    rows = rows.join(nodes.select("node", F.col("first").cast("int").alias("shard")), "node")
    buckets = max(1, -(-total["n"] // (SLOT_ROWS * max(1, shards))))
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("row"), F.lit(buckets)))
    counts = rows.groupBy("shard", "bucket").agg(F.count("*").alias("k"))
    before = F.sum("k").over(Window.partitionBy("shard").orderBy("bucket")) - F.col("k")  # one row per bucket
    offsets = counts.select("shard", "bucket", before.alias("before"))
    place = F.row_number().over(Window.partitionBy("shard", "bucket").orderBy("row"))
    return (rows.withColumn("place", place).join(offsets, ["shard", "bucket"])
            .select("doc_id", "size", "text_crc32", "shard", (F.col("place") - 1 + F.col("before")).cast("long").alias("slot")))


def op10_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = kd_shards(table(spark, sf_dir, "documents"), 16)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))


QUERY = {"op10_kd_shards": op10_kd_shards}
