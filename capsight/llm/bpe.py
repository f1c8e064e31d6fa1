"""Byte-level BPE encoding and decoding by DuckDB recursive queries inside each partition.

``tokenize`` cuts every whole text into the matches of the split pattern, dictionary-encodes them (Arrow, exact)
and encodes only pieces its worker has not seen: a recursive query holds one row per token position, joins adjacent
pairs with the merge table and contracts each piece's leftmost pair of minimum rank until no pair is left.  A piece that is
itself a token is that token, as in the rank files' own library.  Decoding joins the ids with the vocabulary and
concatenates their bytes by an ordered aggregation; texts are the concatenation of their pieces in order.

Long pieces (``LONG`` bytes and over, such as text without spaces) contract every occurrence of the minimum-rank pair in one round
where no pair made by it can have a lower rank (``safe`` in the merge table), which gives the same ids in far fewer rounds;
all other pairs are contracted one by one.  Pieces over ``HUGE`` bytes, whose rows would overflow the queries' memory, are contracted in the same
order (minimum rank, then leftmost) from a queue over linked arrays, in time that grows little faster than their length.

One narrow stage: no shuffle.  Memory per task is bounded by ``SLICE`` bytes of text (or one document), ``STEPS`` rounds of one recursive query and
two generations of at most ``CACHE`` bytes of cached pieces per Python worker, a pure cache that a lost executor rebuilds and that
another operator's tasks drop.

Null texts count as empty: no ids, the digests of nothing.  Repeated rows are encoded alike.  An empty table gives an empty result.
Extra columns are ignored; output names do not depend on them.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from capsight.llm.common import KEPT, arrow_schema, release, table, workers_import

SLICE = 1 << 20
CACHE = 48 << 20  # bytes of one generation of cached pieces, of two
ENTRY = 140  # bytes that a cached piece takes besides its own
ROUND = 10_000
LONG = 64
HUGE = 30_000
IDS = 400_000  # ids that one query decodes
STEPS = 32  # rounds of one recursive query; further rounds start from its last rows, which bounds what it holds

#: Splits of the rank files' library: contractions, letters, numbers, other signs (each with one space before), white space.
LETTER, NUMBER, SPACE, OTHER = 1, 2, 3, 0
CONTRACTIONS = (b"'s", b"'t", b"'re", b"'ve", b"'m", b"'ll", b"'d")

_RECURSION = """
WITH RECURSIVE step(it, w, p, t) AS (
  SELECT 0, w, p, t FROM tokens
  UNION ALL
  (WITH ranked AS MATERIALIZED (
     SELECT it, w, p, t, pp, r::bigint << 32 | p AS k
     FROM (SELECT it, w, p, t, CASE WHEN lead(w) OVER o = w THEN lead(t) OVER o END AS nt,
                  CASE WHEN lag(w) OVER o = w THEN lag(p) OVER o END AS pp
           FROM step WINDOW o AS (ORDER BY w::bigint << 32 | p)) AS pairs
     LEFT JOIN merges ON pair = t::bigint << 32 | nt
   ), least AS (
     SELECT w, min(k) AS best FROM ranked WHERE k IS NOT NULL GROUP BY w
   )
   SELECT it + 1, w, p, CASE WHEN p = best & 4294967295 THEN (best >> 32)::int ELSE t END
   FROM ranked JOIN least USING (w) WHERE it < {steps} AND (pp IS NULL OR pp <> best & 4294967295))
)"""

# as above; inside a run of overlapping occurrences every other one is contracted, leftmost first
_RECURSION_LONG = """
WITH RECURSIVE step(it, w, p, t) AS (
  SELECT 0, w, p, t FROM tokens
  UNION ALL
  SELECT it + 1, w, p, CASE WHEN hit THEN (best >> 32)::int ELSE t END
  FROM (
    SELECT *, lag(hit) OVER (PARTITION BY w ORDER BY p) AS gone
    FROM (
      SELECT *, CASE WHEN safe THEN is_best AND (row_number() OVER (PARTITION BY w, run, is_best ORDER BY p)) % 2 = 1
                     ELSE p = best & 4294967295 END AS hit
      FROM (
        SELECT *, coalesce(r = best >> 32, false) AS is_best,
               row_number() OVER (PARTITION BY w ORDER BY p) - row_number() OVER (PARTITION BY w, coalesce(r = best >> 32, false) ORDER BY p) AS run
        FROM (
          SELECT *, min(r::bigint << 32 | p) OVER (PARTITION BY w) AS best
          FROM (SELECT it, w, p, t, lead(t) OVER o AS nt FROM step WINDOW o AS (PARTITION BY w ORDER BY p)) AS pairs
          LEFT JOIN merges ON pair = t::bigint << 32 | nt
        ) AS ranked
      ) AS runs LEFT JOIN safety ON rank = best >> 32
      WHERE best IS NOT NULL
    ) AS hits
  ) AS contracted
  WHERE it < {steps} AND NOT coalesce(gone, false)
)"""

_IDS = """
SELECT w, p, t, it FROM step JOIN (SELECT w, max(it) AS it FROM step GROUP BY w) AS last USING (w, it) ORDER BY w, p"""

_DECODE = """
SELECT w, unhex(string_agg(bytes, '' ORDER BY p)) AS piece FROM ids JOIN vocabulary USING (id) GROUP BY w ORDER BY w"""


def read_ranks(path: str) -> dict[bytes, int]:
    """The rank file: one base64 token and its rank per line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (x.split() for x in lines if x.strip())}


class Codec:
    """DuckDB tables of one vocabulary, and the pieces this worker has encoded so far."""

    def __init__(self, path: str):
        import duckdb

        self.ranks = read_ranks(path)
        self.bytes_id = np.array([self.ranks[bytes([i])] for i in range(256)], dtype=np.int32)
        found = array("q")
        for token, rank in self.ranks.items():
            for i in range(1, len(token)):
                if (head := self.ranks.get(token[:i])) is not None and (tail := self.ranks.get(token[i:])) is not None:
                    found.extend((head, tail, rank))
        left, right, rank = np.frombuffer(found, dtype=np.int64).reshape(-1, 3).T
        merges = pa.table({"pair": left << 32 | right, "r": rank.astype(np.int32)})
        lower = np.unique(np.concatenate([left[rank < left], right[rank < right]]))
        made = np.unique(rank)
        safety = pa.table({"rank": made, "safe": ~np.isin(made, lower)})
        vocabulary = pa.table({"id": pa.array(self.ranks.values(), pa.int32()), "bytes": [t.hex() for t in self.ranks]})
        self.db = duckdb.connect(":memory:", config={"threads": 1, "memory_limit": "200MB", "temp_directory": ""})
        for name, rows in (("merges", merges), ("safety", safety), ("vocabulary", vocabulary)):
            self.db.register("given", rows)
            self.db.execute(f"CREATE TABLE {name} AS SELECT * FROM given")
            self.db.unregister("given")
        order = np.argsort(left << 32 | right)
        self.pair, self.pair_rank = (left << 32 | right)[order], rank[order]
        self.rank_of: dict[int, int] = {}  # of pairs, filled for the first huge piece
        # piece -> packed ids (with their decoded bytes where these differ): those of late, and those from before that may come again
        self.seen: dict[bytes, bytes | tuple[bytes, bytes]] = {}
        self.older: dict[bytes, bytes | tuple[bytes, bytes]] = {}
        self.held = 0  # bytes of ``seen``
        del merges, safety, vocabulary, found, left, right, rank, lower, made, order
        release("bpe")

    def _query(self, sql: str, **tables: pa.Table) -> pa.Table:
        for name, rows in tables.items():
            self.db.register(name, rows)
        out = self.db.sql(sql).to_arrow_table()
        for name in tables:
            self.db.unregister(name)
        return out

    def _merge(self, pieces: list[bytes], recursion: str) -> list[bytes]:
        out = []
        at = 0
        while at < len(pieces):
            stop, size = at, 0
            while stop < len(pieces) and (stop == at or size < ROUND * 8):
                size += len(pieces[stop])
                stop += 1
            part = pieces[at:stop]
            lengths = np.array([len(x) for x in part])
            raw = np.frombuffer(b"".join(part), dtype=np.uint8)
            tokens = pa.table({"w": np.repeat(np.arange(len(part), dtype=np.int32), lengths),
                               "p": (np.arange(len(raw)) - np.repeat(np.cumsum(lengths) - lengths, lengths)).astype(np.int32),
                               "t": self.bytes_id[raw]})
            while True:
                ids = self._query(recursion.format(steps=STEPS) + _IDS, tokens=tokens)
                if ids.column("it").to_numpy().max() < STEPS:
                    break
                tokens = ids.select(["w", "p", "t"])
            packed = ids.column("t").to_numpy().astype("<u4").tobytes()
            ends = np.cumsum(np.bincount(ids.column("w").to_numpy(), minlength=len(part))).tolist()
            out += [packed[4 * a:4 * b] for a, b in zip([0, *ends[:-1]], ends)]
            at = stop
        return out

    def _merge_huge(self, piece: bytes) -> bytes:
        """Ids of one piece: pairs by (rank, place), first those of the bytes, in order, and then those that merges make."""
        if not self.rank_of:
            self.rank_of = dict(zip(self.pair.tolist(), self.pair_rank.tolist()))
        rank_of, n = self.rank_of, len(piece)
        raw = self.bytes_id[np.frombuffer(piece, dtype=np.uint8)]
        pair = raw[:-1].astype(np.int64) << 32 | raw[1:]
        at = np.searchsorted(self.pair, pair).clip(0, max(0, len(self.pair) - 1))
        known = np.flatnonzero(self.pair[at] == pair) if len(self.pair) else np.zeros(0, dtype=np.int64)
        first = np.sort(self.pair_rank[at[known]] << 32 | known)
        token, after, before = array("i", raw.tobytes()), array("q", range(1, n + 1)), array("q", range(-1, n - 1))
        made: list[int] = []

        def contract(key: int) -> None:
            rank, p = key >> 32, key & 0xFFFFFFFF
            q = after[p]
            if token[p] < 0 or q >= n or rank_of.get(token[p] << 32 | token[q]) != rank:
                return
            token[p], token[q] = rank, -1
            after[p] = m = after[q]
            if m < n:
                before[m] = p
                if (r := rank_of.get(rank << 32 | token[m])) is not None:
                    heapq.heappush(made, r << 32 | p)
            if (k := before[p]) >= 0 and (r := rank_of.get(token[k] << 32 | rank)) is not None:
                heapq.heappush(made, r << 32 | k)

        for a in range(0, len(first), 65536):
            for key in first[a:a + 65536].tolist():
                while made and made[0] < key:
                    contract(heapq.heappop(made))
                contract(key)
        while made:
            contract(heapq.heappop(made))
        left = np.frombuffer(token, dtype=np.int32)
        return left[left >= 0].astype("<u4").tobytes()

    def learn(self, pieces: list[bytes]) -> None:
        """Encode new pieces (ids as little-endian unsigned 32-bit integers), decode the ids, keep both in ``seen``."""
        whole = [x for x in pieces if x in self.ranks]
        packed = [self.ranks[x].to_bytes(4, "little") for x in whole]
        rest = [x for x in pieces if x not in self.ranks]
        for some, recursion in (([x for x in rest if len(x) < LONG], _RECURSION), ([x for x in rest if LONG <= len(x) <= HUGE], _RECURSION_LONG)):
            whole += some
            packed += self._merge(some, recursion)
        huge = [x for x in rest if len(x) > HUGE]
        whole += huge
        packed += map(self._merge_huge, huge)
        for x, ids, plain in zip(whole, packed, self.decode(packed)):
            self._keep(x, ids if x == plain else (ids, plain))

    def _keep(self, piece: bytes, known: bytes | tuple[bytes, bytes]) -> None:
        self.seen[piece] = known
        self.held += 2 * len(piece) + ENTRY

    def encoded(self, pieces: list[bytes]) -> tuple[list[bytes], list[bytes]]:
        """Packed ids and decoded bytes of ``pieces``, from the cache where it has them.

        When ``seen`` is full it becomes ``older``; pieces found there move back, so that frequent ones stay.
        """
        if self.held > CACHE:
            self.seen, self.older, self.held = {}, self.seen, 0
        new = []
        for x in pieces:
            if x not in self.seen:
                if (known := self.older.get(x)) is not None:
                    self._keep(x, known)
                else:
                    new.append(x)
        if new:
            self.learn(new)
        found = [self.seen[x] for x in pieces]
        return [k if type(k) is bytes else k[0] for k in found], [x if type(k) is bytes else k[1] for x, k in zip(pieces, found)]

    def decode(self, ids: list[bytes]) -> list[bytes]:
        """The bytes of packed id lists; empty lists give empty bytes."""
        lengths = np.array([len(x) // 4 for x in ids], dtype=np.int64)
        if not lengths.sum():
            return [b""] * len(ids)
        flat = np.frombuffer(b"".join(ids), dtype="<u4").astype(np.int32)
        who = np.repeat(np.arange(len(ids), dtype=np.int32), lengths)
        out = [[] for _ in ids]
        for k in range(0, len(flat), IDS):
            rows = pa.table({"w": who[k:k + IDS], "p": np.arange(len(flat[k:k + IDS]), dtype=np.int64), "id": flat[k:k + IDS]})
            found = self._query(_DECODE, ids=rows)
            for w, piece in zip(found.column("w").to_pylist(), found.column("piece").to_pylist()):
                out[w].append(piece)
        return [b"".join(x) for x in out]


_CODECS: dict[str, Codec] = KEPT.setdefault("bpe", {})  # until another operator's task runs in this worker
_CLASSES: list[np.ndarray] = []


def codec(path: str) -> Codec:
    if path not in _CODECS:
        _CODECS[path] = Codec(path)
    return _CODECS[path]


def char_classes() -> np.ndarray:
    """Class of every code point as the split pattern sees it."""
    if not _CLASSES:
        import regex

        points = np.concatenate([np.arange(0xD800), np.arange(0xE000, 0x110000)]).astype("<u4")
        every = points.tobytes().decode("utf-32-le")
        table_ = np.zeros(0x110000, dtype=np.uint8)
        for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\s+")):
            for m in regex.finditer(pattern, every):
                table_[points[m.start():m.end()]] = kind
        _CLASSES.append(table_)
    return _CLASSES[0]


def split(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start bytes of the pattern's matches in UTF-8 ``data`` of texts ``offsets[i]:offsets[i + 1]``, and pieces per text."""
    lead = (data & 0xC0) != 0x80
    at = np.flatnonzero(lead)  # byte position of every character
    points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), dtype="<u4")
    n = len(points)
    if not n:
        return np.zeros(0, dtype=np.int64), np.zeros(len(offsets) - 1, dtype=np.int64)
    kind = char_classes()[points]
    first = np.zeros(n + 1, dtype=bool)  # first character of a text
    first[np.searchsorted(at, offsets)] = True
    first[n] = True
    space = kind == SPACE
    start = first[:n].copy()
    start[1:] |= space[1:] & ~space[:-1]
    start[1:] |= ~space[1:] & (kind[1:] != kind[:-1]) & (points[:-1] != 0x20)
    start[:-1] |= space[:-1] & ~space[1:] & ~first[1:n]
    quotes = np.flatnonzero(points == 0x27)
    if len(quotes):
        follow = np.zeros(0x110000, dtype=bool)
        follow[[ord(c) for c in "strvmld"]] = True
        quotes = quotes[quotes + 1 < n]
        quotes = quotes[follow[points[quotes + 1]] & ~first[quotes + 1]]
        for i in quotes.tolist():
            if not start[i]:
                continue
            head = bytes(points[i:i + 3].clip(0, 255).astype(np.uint8))
            size = next((len(c) for c in CONTRACTIONS if head.startswith(c)), 0)
            if size and not first[i + 1:i + size].any():
                start[i + 1:i + size] = False
                if i + size < n:
                    start[i + size] = True
    where = at[start]
    return where, np.diff(np.searchsorted(where, offsets))


def _slice(coder: Codec, texts: pa.Array) -> dict[str, list]:
    """Ids and decoded bytes of a few megabytes of texts."""
    texts = texts.fill_null("").cast(pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8)[offsets[0]:offsets[-1]] if raw else np.zeros(0, dtype=np.uint8)
    offsets = offsets - offsets[0]
    where, per_text = split(data, offsets)
    bounds = np.concatenate([where, [len(data)]]).astype(np.int64)
    pieces = pa.Array.from_buffers(pa.large_binary(), len(where), [None, pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(data))]).dictionary_encode()
    packed, plain = coder.encoded(pieces.dictionary.to_pylist())
    pick = pieces.indices.to_numpy(zero_copy_only=False)
    out: dict[str, list] = {"ids": [], "decoded": []}
    at = 0
    for n in per_text.tolist():
        mine = pick[at:at + n].tolist()
        out["ids"].append(np.frombuffer(b"".join([packed[k] for k in mine]), dtype="<u4"))
        out["decoded"].append(b"".join([plain[k] for k in mine]))
        at += n
    return out


def _slices(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``SLICE`` bytes, or of one text."""
    import pyarrow.compute as pc

    size = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
    at = 0
    while at < len(texts):
        stop = int(np.searchsorted(size, (size[at - 1] if at else 0) + SLICE, "right"))
        yield at, (stop := max(stop, at + 1))
        at = stop


def tokenize(docs: DataFrame, path: str, text: str = "text", key: str = "doc_id", ids: bool = False, decoded: bool = False) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of every row, with ``ids`` (packed little-endian unsigned
    32-bit integers) and ``decoded`` (bytes) on request."""
    workers_import(docs.sparkSession)
    ddl = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids binary" * ids + ", decoded binary" * decoded
    schema = arrow_schema(ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release("bpe")  # what an earlier stage's tasks left in this worker
        coder = codec(path)
        for batch in batches:
            texts = batch.column(1)
            for a, b in _slices(texts):
                out = _slice(coder, texts.slice(a, b - a))
                columns = [batch.column(0).slice(a, b - a).cast(pa.int64()), pa.array([len(x) for x in out["ids"]], pa.int64()),
                           pa.array([hashlib.sha256(x).hexdigest() for x in out["ids"]]),
                           pa.array([hashlib.sha256(x).hexdigest() for x in out["decoded"]])]
                if ids:
                    columns.append(pa.array([x.tobytes() for x in out["ids"]], pa.binary()))
                if decoded:
                    columns.append(pa.array(out["decoded"], pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, schema=schema)
                del out, columns
            del batch, texts
            release("bpe")

    return docs.select(key, text).mapInArrow(run, ddl)


def decode(encoded: DataFrame, path: str, ids: str = "ids", key: str = "doc_id") -> DataFrame:
    """``doc_id, decoded`` of packed id lists; null ids decode to empty bytes, ids outside the vocabulary fail."""
    workers_import(encoded.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(path)
        known = np.zeros(max(coder.ranks.values()) + 1, dtype=bool)
        known[list(coder.ranks.values())] = True
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                part = [x or b"" for x in batch.column(1).slice(i, 256).to_pylist()]
                flat = np.frombuffer(b"".join(part), dtype="<u4")
                if len(flat) and (flat.max() >= len(known) or not known[flat].all()):
                    raise ValueError("an id is not in the vocabulary")
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, 256).cast(pa.int64()), pa.array(coder.decode(part), pa.binary())], ["doc_id", "decoded"])

    return encoded.select(key, ids).mapInArrow(run, "doc_id long, decoded binary")


def vocabulary_path(name: str = "byte_bpe_multi_50k.tiktoken") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenize(table(spark, sf_dir, "documents"), vocabulary_path())


QUERY = {"op6_byte_bpe": op6_byte_bpe}
