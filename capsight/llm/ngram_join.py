"""N-gram Jaccard join: blocked sparse products of document by n-gram incidence under size-derived bounds.

A document's set holds its distinct shingles of ``width`` lower-cased (A-Z) words; two documents link when
``100 * intersection >= percent * union``.  The result is exact (up to 48-bit shingle identities) at any skew:

1. Documents with one and the same set form a class (``cid``, 64 bits).  Everything after works on classes.
2. Overlap bound.  A class with ``n`` shingles needs ``ceil(n * percent / 100)`` of them in one other class, so at least as many must
   occur in *some* other class.  The incidence matrix is counted in blocks of shingles: tasks send packed blobs per block of the hash
   space; shingles repeated inside a task are combined before the shuffle and sent once, so a passage that a third of all
   documents share costs one entry per task.  Classes under the bound are done.  The rest is counted again among themselves
   until the bound removes little more.
3. Candidates.  Of what is left every class keeps its rarest ``n - ceil(n * percent / 100) + 1`` shingles (any linked pair shares one of
   them).  Classes on one shingle, in order of size, are chained where neighbours' sizes allow a link; the chains' connected
   components are the groups in which all links lie.  No pair is made.
4. Product.  Groups are cut into blocks of bounded size by a hash; every pair of blocks is one task that accumulates the overlap
   counts of its part of the product (dense for frequent columns, pairwise for rare ones) and drops pairs below the size bound.
   It returns a forest of the links and link counts, never the pairs.

Null and empty texts and texts without words have size 0 and link with nothing.  Repeated rows and copies count as documents of their
own (``n_links``) in one class.  An empty table gives an empty result.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from capsight.llm import text_arrays as T
from capsight.llm.common import connected_components, contract, local_forest, materialize, release, table, workers_import

WIDTH, PERCENT = 5, 75
CHUNK = 1_000_000  # shingles that a task packs at once
BLOCK_ENTRIES = 4_000_000  # shingles of a block of the hash space, on average
LEAST_BLOCKS = 64
GROUP_SHINGLES, GROUP_DOCS = 400_000, 1500  # of a block of a group, on average
DENSE = 32  # classes on a shingle from which its column is multiplied densely
FILTER_BITS = 23


def _required(n, percent: int):
    """Least overlap of a set of ``n`` with any set it links to."""
    return -(-n * percent // 100)


def _sets(batch: pa.RecordBatch, place: int, width: int):
    """Per slice of the batch: rows ``a:b``, shingles, their row (from 0), set sizes and class ids."""
    texts = batch.column(place)
    for a, b in T.slices(texts):
        data, offsets = T.raw_bytes(texts.slice(a, b - a))
        keys = T.shingle_keys(T.words(data, offsets, lower=True), width)
        owner = (keys >> np.uint64(48)).astype(np.int64)
        shingles = keys & T.MASK48
        size = np.bincount(owner, minlength=b - a)
        cid = np.zeros(b - a, dtype=np.uint64)
        if len(keys):
            first = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
            cid[owner[first]] = T.mix(np.add.reduceat(T.mix(shingles, 3), first) + size[owner[first]].astype(np.uint64), 4)
        yield a, b, shingles, owner, size, cid.view(np.int64)


def classes(docs: DataFrame, text: str, key: str, width: int) -> DataFrame:
    """``doc_id, n, cid`` of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in batches:
            for a, b, _, _, size, cid in _sets(batch, 1, width):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a).cast(pa.int64()), pa.array(size.astype(np.int64)), pa.array(cid)],
                                                 ["doc_id", "n", "cid"])
            release()
    return docs.select(key, text).mapInArrow(run, "doc_id long, n long, cid long")


_PACKED = "block long, chunk long, body binary, counts binary, repeated binary"


def _pack(shingles: np.ndarray, owner: np.ndarray, cid: np.ndarray, size: np.ndarray, bits: int) -> pa.RecordBatch:
    """A chunk of distinct classes as one row per block of the hash space, and one row about the classes.

    ``body``: the shingles that only one class of the chunk has, in class order, as bytes 0-3 and then 4-5 of each;
    ``counts``: how many of them each class has; ``repeated``: shingles of several classes of the chunk.
    """
    order = np.argsort(shingles, kind="stable")
    h = shingles[order]
    twice = np.zeros(len(h), dtype=bool)
    equal = h[1:] == h[:-1]
    twice[1:] |= equal
    twice[:-1] |= equal
    shared = np.bincount(owner[order][twice], minlength=len(cid))
    many = np.unique(h[twice])
    alone = np.ones(len(h), dtype=bool)
    alone[order[twice]] = False
    h, who = shingles[alone], owner[alone]
    block = (h >> np.uint64(48 - bits)).astype(np.int64)
    order = np.argsort(block * len(cid) + who, kind="stable")
    h, who, block = h[order], who[order], block[order]
    many_block = (many >> np.uint64(48 - bits)).astype(np.int64)
    # classes are named by their place, so chunks of the same classes in another order are other chunks
    placed = T.mix(cid.view(np.uint64) + T.mix(np.arange(len(cid), dtype=np.uint64), 6), 5)
    chunk = int(T.mix(np.array([placed.sum() + np.uint64(len(cid))], dtype=np.uint64), 5).view(np.int64)[0])
    rows = {"block": [], "chunk": [], "body": [], "counts": [], "repeated": []}
    named = np.union1d(block, many_block)
    at, mat = np.searchsorted(block, named), np.searchsorted(many_block, named)
    end, mend = np.searchsorted(block, named, "right"), np.searchsorted(many_block, named, "right")
    for k, b in enumerate(named.tolist()):
        part = np.ascontiguousarray(h[at[k]:end[k]]).view(np.uint8).reshape(-1, 8)
        rows["block"].append(b)
        rows["chunk"].append(chunk)
        rows["body"].append(part[:, :4].tobytes() + part[:, 4:6].tobytes())
        rows["counts"].append(np.bincount(who[at[k]:end[k]], minlength=len(cid)).astype("<u4").tobytes())
        rows["repeated"].append(many[mat[k]:mend[k]].tobytes())
    rows["block"].append(-1 - (chunk & 0xFFFF))
    rows["chunk"].append(chunk)
    rows["body"].append(cid.tobytes())
    rows["counts"].append(size.astype("<i8").tobytes())
    rows["repeated"].append(shared.astype("<i8").tobytes())
    return pa.RecordBatch.from_arrays([pa.array(rows["block"], pa.int64()), pa.array(rows["chunk"], pa.int64()),
                                       *(pa.array(rows[c], pa.binary()) for c in ("body", "counts", "repeated"))],
                                      ["block", "chunk", "body", "counts", "repeated"])


class _Packer:
    """Collects classes of a task, each once, and packs a chunk when it is full."""

    def __init__(self, bits: int):
        self.bits = bits
        self.parts: list[tuple] = []
        self.size = 0

    def add(self, shingles, owner, size, cid) -> Iterator[pa.RecordBatch]:
        self.parts.append((shingles, owner, size, cid))
        self.size += len(shingles)
        if self.size >= CHUNK:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if self.parts:
            base = np.cumsum([0] + [len(p[3]) for p in self.parts])
            shingles = np.concatenate([p[0] for p in self.parts])
            owner = np.concatenate([p[1] + o for p, o in zip(self.parts, base)])
            size, cid = np.concatenate([p[2] for p in self.parts]), np.concatenate([p[3] for p in self.parts])
            _, first = np.unique(cid, return_index=True)
            keep = np.zeros(len(cid), dtype=bool)
            keep[first] = True
            keep &= size > 0
            rows = keep[owner]
            number = np.cumsum(keep) - 1
            if keep.any():
                yield _pack(shingles[rows], number[owner[rows]], cid[keep], size[keep], self.bits)
        self.parts, self.size = [], 0


def _unpack(table_: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Shingles of a block with the number of their class, the classes' chunk and place, and the repeated shingles."""
    hs, who, chunks, places, many, base = [], [], [], [], [], 0
    for chunk, body, counts, repeated in zip(*(table_.column(c).to_pylist() for c in ("chunk", "body", "counts", "repeated"))):
        per = np.frombuffer(counts, dtype="<u4").astype(np.int64)
        k = len(body) // 6
        low = np.frombuffer(body, dtype="<u4", count=k).astype(np.uint64)
        high = np.frombuffer(body, dtype="<u2", offset=4 * k, count=k).astype(np.uint64)
        hs.append(low | high << np.uint64(32))
        some = np.flatnonzero(per)
        who.append(np.repeat(np.arange(len(some)) + base, per[some]))
        chunks.append(np.full(len(some), chunk))
        places.append(some)
        base += len(some)
        many.append(np.frombuffer(repeated, dtype=np.uint64))
    return tuple(np.concatenate(x) for x in (hs, who, chunks, places, many))


def _count_block(table_: pa.Table) -> pa.Table:
    """Per class of a block: how many of its shingles another class has too."""
    if table_.column("block")[0].as_py() < 0:  # what the chunks say of their classes
        out = [(chunk, np.frombuffer(a, dtype=np.int64), np.frombuffer(b, dtype=np.int64), np.frombuffer(c, dtype=np.int64))
               for chunk, a, b, c in zip(*(table_.column(c).to_pylist() for c in ("chunk", "body", "counts", "repeated")))]
        return pa.table({"chunk": np.concatenate([np.full(len(x[1]), x[0]) for x in out]), "place": np.concatenate([np.arange(len(x[1])) for x in out]),
                         "shared": np.concatenate([x[3] for x in out]), "cid": np.concatenate([x[1] for x in out]), "n": np.concatenate([x[2] for x in out])})
    h, who, chunks, places, many = _unpack(table_)
    order = np.argsort(h)
    h, owner = h[order], who[order]
    equal = h[1:] == h[:-1]
    shared = np.zeros(len(h), dtype=bool)
    shared[1:] |= equal
    shared[:-1] |= equal
    shared |= np.isin(h, np.unique(many))
    count = np.bincount(owner[shared], minlength=len(places))
    some = count > 0
    none = pa.nulls(int(some.sum()), pa.int64())
    return pa.table({"chunk": chunks[some].astype(np.int64), "place": places[some], "shared": count[some], "cid": none, "n": none})


def _survivors(packed: DataFrame, percent: int) -> DataFrame:
    """``cid`` of the classes that reach the overlap bound."""
    told = packed.groupBy("block").applyInArrow(_count_block, "chunk long, place long, shared long, cid long, n long")
    per = told.groupBy("chunk", "place").agg(F.sum("shared").alias("shared"), F.max("cid").alias("cid"), F.max("n").alias("n"))
    return per.filter(F.col("shared") * 100 >= F.col("n") * percent).select("cid").distinct()


def _bits(entries: int) -> int:
    return int(np.ceil(np.log2(max(LEAST_BLOCKS, entries / BLOCK_ENTRIES))))


def _pack_texts(docs: DataFrame, bits: int, width: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        packer = _Packer(bits)
        for batch in batches:
            for _, _, shingles, owner, size, cid in _sets(batch, 0, width):
                yield from packer.add(shingles, owner, size, cid)
            release()
        yield from packer.flush()
        release()
    return docs.mapInArrow(run, _PACKED)


def _set_arrays(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Shingles, owners, sizes and class ids of rows ``cid, n, body`` (little-endian 64-bit shingles)."""
    size = batch.column(1).to_numpy(zero_copy_only=False)
    shingles = np.frombuffer(b"".join(batch.column(2).to_pylist()), dtype=np.uint64)
    return shingles, np.repeat(np.arange(len(size)), size), size, batch.column(0).to_numpy(zero_copy_only=False)


def _pack_sets(sets: DataFrame, bits: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = _Packer(bits)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                yield from packer.add(*_set_arrays(batch.slice(at, 500)))
        yield from packer.flush()
    return sets.select("cid", "n", "body").mapInArrow(run, _PACKED)


def _read_sets(docs: DataFrame, left: DataFrame, text: str, key: str, width: int) -> DataFrame:
    """``cid, n, copies, body`` of the classes ``left`` (``cid, doc_id, n, copies``), from one document of each.

    A bitmap of fixed size (hashed ids) keeps most other documents from the shuffle; the join on id and class is exact.
    """
    spot = F.pmod(F.xxhash64("doc_id"), F.lit(1 << FILTER_BITS))
    maps = (left.select(F.bitmap_bucket_number(spot).alias("b"), F.bitmap_bit_position(spot).alias("p"))
            .groupBy("b").agg(F.bitmap_construct_agg("p").alias("bits")).collect())  # at most 2 ** FILTER_BITS bits
    bits = np.zeros((1 << FILTER_BITS) // 8 + 4096, dtype=np.uint8)
    for row in maps:
        bits[(row["b"] - 1) * 4096:row["b"] * 4096] = np.frombuffer(row["bits"], dtype=np.uint8)
    wanted = docs.sparkSession.sparkContext.broadcast(bits.tobytes())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        known = np.frombuffer(wanted.value, dtype=np.uint8)
        for batch in batches:
            at = batch.column(2).to_numpy(zero_copy_only=False)
            hit = (known[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
            part = batch.filter(pa.array(hit))
            for a, b, shingles, owner, size, cid in _sets(part, 1, width):
                ends = np.cumsum(size)
                bodies = [shingles[e - k:e].tobytes() for e, k in zip(ends.tolist(), size.tolist())]
                yield pa.RecordBatch.from_arrays([part.column(0).slice(a, b - a).cast(pa.int64()), pa.array(cid), pa.array(bodies, pa.binary())],
                                                 ["doc_id", "cid", "body"])

    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("_text"))
    place = F.bitmap_bit_position(spot) + (F.bitmap_bucket_number(spot) - 1) * 32768
    read = rows.select("doc_id", "_text", place.alias("_spot")).filter(F.col("doc_id").isNotNull()).mapInArrow(run, "doc_id long, cid long, body binary")
    return read.join(left, ["doc_id", "cid"]).dropDuplicates(["cid"]).select("cid", "n", "copies", "body")


def _rarest(sets: DataFrame, bits: int, percent: int) -> DataFrame:
    """``h, cid, n``: each class's rarest shared shingles, enough that linked classes have one in common."""
    def frequent(table_: pa.Table) -> pa.Table:
        names = ["cid", "n", "shared", "body"]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary()]
        if not table_.num_rows:
            return pa.table([pa.array([], k) for k in kinds], names)
        cid, n = (table_.column(c).to_numpy() for c in ("cid", "n"))
        size = np.array([len(x) // 8 for x in table_.column("body").to_pylist()])
        h = np.frombuffer(b"".join(table_.column("body").to_pylist()), dtype=np.uint64)
        who = np.repeat(np.arange(len(cid)), size)
        _, back, df = np.unique(h, return_inverse=True, return_counts=True)
        df = df[back]
        keep = df > 1
        h, who, df = h[keep], who[keep], df[keep]
        at = np.searchsorted(who, np.arange(len(cid) + 1))
        some = np.flatnonzero(at[1:] > at[:-1])
        body = [np.stack([df[at[i]:at[i + 1]].astype(np.uint64), h[at[i]:at[i + 1]]]).tobytes() for i in some.tolist()]
        return pa.table([pa.array(cid[some]), pa.array(n[some]), pa.array((at[1:] - at[:-1])[some]), pa.array(body, pa.binary())], names)

    def by_block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                shingles, owner, size, cid = _set_arrays(part)
                block = (shingles >> np.uint64(48 - bits)).astype(np.int64)
                edge = np.flatnonzero(np.append(True, (block[1:] != block[:-1]) | (owner[1:] != owner[:-1]))) if len(block) else np.zeros(0, dtype=np.int64)
                stop = np.append(edge[1:], len(block))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(block[edge]), pa.array(cid[owner[edge]]), pa.array(size[owner[edge]]),
                     pa.array([shingles[a:b].tobytes() for a, b in zip(edge.tolist(), stop.tolist())], pa.binary())], ["block", "cid", "n", "body"])

    def choose(table_: pa.Table) -> pa.Table:
        cid, n = table_.column("cid")[0].as_py(), table_.column("n")[0].as_py()
        parts = [np.frombuffer(x, dtype=np.uint64).reshape(2, -1) for x in table_.column("body").to_pylist()]
        df, h = np.concatenate(parts, axis=1)
        prefix = n - _required(n, percent) + 1 - (n - len(h))  # the shingles of one class only come first
        pick = np.lexsort((h, df))[:max(0, prefix)]
        return pa.table({"h": h[pick].view(np.int64), "cid": np.full(len(pick), cid), "n": np.full(len(pick), n)})

    spread = sets.select("cid", "n", "body").mapInArrow(by_block, "block long, cid long, n long, body binary")
    told = spread.groupBy("block").applyInArrow(frequent, "cid long, n long, shared long, body binary")
    return told.groupBy("cid").applyInArrow(choose, "h long, cid long, n long")  # one class: as much as its text


def _chains(percent: int):
    """Edges between neighbours by size on one shingle, contracted to a forest per task; input sorted by (h, n, cid)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, us, vs, size = None, [], [], 0

        def forest() -> Iterator[pa.RecordBatch]:
            nonlocal us, vs, size
            if us:
                u, v = local_forest(np.concatenate(us), np.concatenate(vs))
                us, vs, size = [], [], 0
                yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])

        for batch in batches:
            h, cid, n = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            if last is not None:
                h, cid, n = (np.append(a, b) for a, b in zip(last, (h, cid, n)))
            if not len(h):
                continue
            chain = (h[1:] == h[:-1]) & (n[:-1] * 100 >= n[1:] * percent) & (cid[1:] != cid[:-1])
            us.append(cid[1:][chain])
            vs.append(cid[:-1][chain])
            size += int(chain.sum())
            last = h[-1], cid[-1], n[-1]
            if size > CHUNK:
                yield from forest()
        yield from forest()
    return run


def _groups(percent: int):
    """The chains of a task, contracted in the worker that makes them: a second one would hold as much memory again, also when idle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from contract(_chains(percent)(batches))
    return run


def overlaps(shingles: np.ndarray, owner: np.ndarray, docs: int) -> np.ndarray:
    """``docs x docs`` counts of common shingles: the product of the incidence matrix with its transpose."""
    out = np.zeros((docs, docs), dtype=np.float32)
    order = np.lexsort((owner, shingles))
    h, who = shingles[order], owner[order]
    first = np.flatnonzero(np.append(True, h[1:] != h[:-1])) if len(h) else np.zeros(0, dtype=np.int64)
    df = np.diff(np.append(first, len(h)))
    for d in np.unique(df[(df > 1) & (df < DENSE)]).tolist():
        lists = who[first[df == d][:, None] + np.arange(d)]
        a, b = np.triu_indices(d, 1)
        for at in range(0, len(lists), max(1, 4_000_000 // len(a))):
            part = lists[at:at + max(1, 4_000_000 // len(a))]
            out += np.bincount((part[:, a] * docs + part[:, b]).ravel(), minlength=docs * docs).reshape(docs, docs).astype(np.float32)
    columns = np.flatnonzero(df >= DENSE)
    for at in range(0, len(columns), 2048):
        some = columns[at:at + 2048]
        m = np.zeros((docs, len(some)), dtype=np.float32)
        for j, c in enumerate(some.tolist()):
            m[who[first[c]:first[c] + df[c]], j] = 1
        out += np.triu(m @ m.T, 1)
    return out


def _product(percent: int):
    """Links of a pair of blocks: forest edges (``links`` 0) and each class's linked documents (``u = v``)."""
    def run(table_: pa.Table) -> pa.Table:
        left, right = table_.column("i")[0].as_py(), table_.column("j")[0].as_py()
        size, copies, cid, block = (table_.column(c).to_numpy() for c in ("n", "copies", "cid", "own"))
        shingles = np.frombuffer(b"".join(table_.column("body").to_pylist()), dtype=np.uint64)
        common = overlaps(shingles, np.repeat(np.arange(len(size)), size), len(size))
        a, b = np.nonzero(common)
        both = common[a, b].astype(np.int64)
        linked = both * (100 + percent) >= percent * (size[a] + size[b])
        if left != right:
            linked &= block[a] != block[b]
        a, b = a[linked], b[linked]
        u, v = local_forest(cid[a], cid[b])
        links = (np.bincount(a, copies[b], len(size)) + np.bincount(b, copies[a], len(size))).astype(np.int64)
        some = links > 0
        return pa.table({"u": np.concatenate([u, cid[some]]), "v": np.concatenate([v, cid[some]]),
                         "links": np.concatenate([np.zeros(len(u), dtype=np.int64), links[some]])})
    return run


def ngram_join(docs: DataFrame, text: str = "text", key: str = "doc_id", width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """``doc_id, n_shingles, n_links, component_id`` of every row of ``docs``."""
    spark = docs.sparkSession
    workers_import(spark)
    rows = materialize(classes(docs, text, key, width), "ngram-rows")
    per = rows.filter("n > 0").groupBy("cid").agg(F.min("doc_id").alias("doc_id"), F.max("n").alias("n"), F.count("*").alias("copies"))
    entries = rows.agg(F.sum("n")).first()[0] or 0
    bits = _bits(entries)
    packed = _pack_texts(docs.select(text), bits, width)
    left = materialize(per.join(_survivors(packed, percent), "cid"), "ngram-left")
    sets = materialize(_read_sets(docs, left, text, key, width), "ngram-sets")
    count = sets.count()
    while count:
        fewer = materialize(sets.join(_survivors(_pack_sets(sets, bits), percent), "cid"), "ngram-sets")
        now = fewer.count()
        done, sets, count = now > 0.9 * count, fewer, now
        if done:
            break
    chains = (_rarest(sets, bits, percent).repartition("h").sortWithinPartitions("h", "n", "cid").mapInArrow(_groups(percent), "u long, v long"))
    groups = connected_components(chains, contracted=True).select(F.col("node").alias("cid"), F.col("component").alias("grp"))
    sets = materialize(sets.join(groups, "cid"), "ngram-groups")
    cuts = sets.groupBy("grp").agg(F.greatest(F.ceil(F.sum("n") / GROUP_SHINGLES), F.ceil(F.count("*") / GROUP_DOCS)).cast("long").alias("cuts"))
    own = sets.join(cuts, "grp").withColumn("own", F.pmod(F.xxhash64("cid"), F.col("cuts")))
    pairs = own.withColumn("other", F.explode(F.expr("sequence(0L, cuts - 1)")))
    pairs = pairs.select("grp", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "cid", "n", "copies", "body")
    found = materialize(pairs.groupBy("grp", "i", "j").applyInArrow(_product(percent), "u long, v long, links long"), "ngram-links")
    roots = connected_components(found.filter("u <> v").select("u", "v"))
    links = found.filter("u = v").groupBy(F.col("u").alias("cid")).agg(F.sum("links").alias("links"))
    whole = (per.select("cid", "doc_id", "copies").join(roots.select(F.col("node").alias("cid"), "component"), "cid", "left")
             .withColumn("component", F.coalesce("component", "cid")))
    least = whole.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    known = whole.join(least, "component").join(links, "cid", "left").select("cid", "component_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    own_id = F.when(F.col("n") > 0, F.col("cid"))
    return (rows.withColumn("cid", own_id).join(known, "cid", "left")
            .select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                    F.coalesce("component_id", "doc_id").alias("component_id")))


def op5_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id", "n_links")


QUERY = {"op5_ngram_join": op5_ngram_join}
