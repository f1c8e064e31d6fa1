"""Vector codes, whitening and exact duplicates against brute-force versions."""

from __future__ import annotations

import collections
import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from capsight.llm import exact_dedup, vector_codes, whitening
from tests.conftest import SF_SMALL
from tests.llm import helpers as H

EDGES = [(900, None, 1), (901, [], 1), (903, [1.0, float("nan")] + [0.0] * 14, 2), (904, [1.0, float("-inf")] + [0.0] * 14, None),
         (905, [1.0, None] + [0.0] * 14, 3), (906, [1.0, 2.0], 3)]


def _vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumns({"n": F.lit(1), "entry": F.lit(2), "code_": F.lit(3), "v": F.lit(4), "whitened": F.lit(5)})


def _rows(n, width=16, seed=4):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, width)).astype(np.float32)
    x[n // 2: n // 2 + n // 3] = x[3]  # one vector holds a third of all rows
    x[5] = 0
    return [(i % (n - 4), [float(v) for v in r], None if i % 7 == 0 else i % 3) for i, r in enumerate(x)]


def _lloyd(rows, parts=8, entries=16, rounds=6):
    """The rounds of the contract, all members looked at in every one."""
    x = [[[int(np.floor(4096 * float(v))) for v in r[1][p * (len(r[1]) // parts):(p + 1) * (len(r[1]) // parts)]] for p in range(parts)] for r in rows]
    first = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, rows[i][1]))[:entries]
    books = [[list(x[i][p]) for i in first] for p in range(parts)]

    def assign():
        return [[min((sum((a - b) ** 2 for a, b in zip(x[i][p], c)), k) for k, c in enumerate(books[p])) for p in range(parts)] for i in range(len(rows))]
    for _ in range(rounds):
        of = assign()
        for p in range(parts):
            for k in range(len(books[p])):
                mine = [x[i][p] for i in range(len(rows)) if of[i][p][1] == k]
                if mine:
                    books[p][k] = [sum(col) // len(mine) for col in zip(*mine)]
    return books, [("".join(f"{k:02x}" for _, k in r), sum(d for d, _ in r)) for r in assign()]


@pytest.mark.parametrize("n", [240, 9])
def test_codes_equal_plain_lloyd(spark, n):
    rows = _rows(n)
    docs = _vectors(spark, rows + EDGES)
    books, width = vector_codes.fit(docs)
    want_books, want = _lloyd(rows)
    assert width == 16 and books.tolist() == want_books
    out = vector_codes.encode(docs, books, width)
    got = sorted((r["vec_id"], tuple(r["embedding"]), r["code"], r["error"]) for r in out.collect())
    assert got == sorted((i, tuple(v), *w) for (i, v, _), w in zip(rows, want))
    assert out.columns == [*docs.columns, "code", "error"]
    back = vector_codes.decode(out, books, width).first()
    assert len(back["vector"]) == 16 and back["vector"][:2] == [c / 4096 for c in books[0][int(back["code"][:2], 16)]]


def test_codes_move_only_members_that_change(spark, monkeypatch):
    """Segments after the first hold the movers and one sum per task and cell, not the table."""
    kept = []
    monkeypatch.setattr(vector_codes, "materialize", lambda df, name, f=vector_codes.materialize: kept.append(f(df, name)) or kept[-1])
    rows = _rows(600, seed=8)
    vector_codes.fit(_vectors(spark, rows))
    members = [s.filter("NOT resident").count() for s in kept]
    assert members[0] == 8 * 600 and all(m < members[0] / 3 for m in members[1:])
    for s in kept[1:]:  # stayers and arrivals are all members, each once
        assert s.agg(F.sum("n")).first()[0] == 8 * 600


def test_codes_of_odd_and_empty_tables(spark):
    docs = _vectors(spark, [])
    books, width = vector_codes.fit(docs)
    assert vector_codes.encode(docs, books, width).count() == 0
    books, width = vector_codes.fit(docs2 := _vectors(spark, EDGES[:2]))
    assert vector_codes.encode(docs2, books, width).count() == 0
    docs = _vectors(spark, [(1, [0.5, 2.0, 1e30], 1), (None, [0.5, 2.0, -1e30], 1), (1, [0.5, 2.0, 1e30], None)])  # fewer dimensions than parts, beyond the limit
    books, width = vector_codes.fit(docs)
    got = vector_codes.encode(docs, books, width).collect()
    assert len(got) == 3 and {r["error"] for r in got} == {0} and len({r["code"] for r in got}) == 2


def _plain_whitening(x):
    v = np.cov(x.T, bias=True).reshape(x.shape[1], x.shape[1])
    e, u = np.linalg.eigh(v)
    return e[::-1], u[:, ::-1], np.trace(v)


def test_whitening_against_dense_eigenvectors(spark):
    rows = _rows(300, width=40)
    out, width, shares = whitening.whiten(_vectors(spark, rows + EDGES))
    x = np.floor(64 * np.array([r[1] for r in rows])) + 1_000_000
    values, vectors, trace = _plain_whitening(x)
    assert width == 40 and np.allclose(shares, values[:32] / trace, rtol=1e-9)
    got = out.collect()
    assert len(got) == 300 and got[0]["n"] == 300
    plain = (x - x.mean(0)) @ vectors[:, :32] / np.sqrt(values[:32])
    by_id = collections.defaultdict(list)
    for i, (k, _, _) in enumerate(rows):
        by_id[k].append(i)
    sign = None
    for r in got:
        w = np.array(r["whitened"])
        at = min(by_id[r["vec_id"]], key=lambda i: np.abs(np.abs(plain[i]) - np.abs(w)).max())
        sign = np.sign(w * plain[at]) if sign is None else sign
        assert np.allclose(w, plain[at] * sign, atol=1e-7)
        exact = [int(v) for v in x[at]]
        total = [int(c) for c in x.sum(0)]
        assert r["deviation"] == sum((300 * a - b) ** 2 for a, b in zip(exact, total))
    assert whitening.identity_error(out, 32) < 1e-9


@pytest.mark.parametrize("kind", ["equal", "low", "decay", "tiny", "apart"])
def test_spectrum_finds_every_eigenvalue(spark, kind):
    rng = np.random.default_rng(2)
    size = 2 if kind == "tiny" else 48
    q, _ = np.linalg.qr(rng.normal(size=(size, size)))
    e = {"equal": np.repeat([5.0, 3.0, 2.0], 16), "low": np.append(np.arange(1.0, 7), np.zeros(42)), "decay": 2.0 ** -np.arange(48).clip(0, 28), "tiny": np.array([1.0, 1e-8]),
         "apart": np.concatenate([[400.0, 130.0], np.linspace(69, 55, 46) + rng.normal(size=46) * 0.05])}[kind]
    matrix = (q * e) @ q.T
    matrix = (matrix + matrix.T) / 2
    values, vectors = whitening.spectrum(spark, matrix, min(32, size))
    want = sorted(e[e > 1e-9 * e.max()], reverse=True)[:32]
    assert len(values) == len(want) and np.allclose(values, want, atol=1e-13 * e.max())
    assert np.abs(matrix @ vectors - vectors * values).max() < 1e-11 * e.max() and np.allclose(vectors.T @ vectors, np.eye(len(want)), atol=1e-9)


def test_inertia_counts():
    rng = np.random.default_rng(1)
    a = rng.normal(size=(30, 30))
    a = a + a.T
    e = np.linalg.eigvalsh(a)
    form = whitening.tridiagonal(a)
    shifts = np.linspace(-20, 20, 81)
    assert whitening.above(form, shifts).tolist() == [(e > s).sum() for s in shifts]
    assert np.allclose(whitening.located(form, 100.0), e[::-1], atol=1e-12)


def test_whitening_without_spread(spark):
    for rows in ([], EDGES[:2], [(1, [1.0, 2.0], 0)], [(1, [1.0, 2.0], 0), (2, [1.0, 2.0], 0), (None, [1.0, 2.0], 0)]):
        out, _, shares = whitening.whiten(_vectors(spark, rows))
        assert out.count() == 0 and not len(shares) and whitening.identity_error(out, 0) == 0.0
    out, _, shares = whitening.whiten(_vectors(spark, [(1, [1e30, 0.0], 0), (2, [0.0, 0.0], 0), (2, [0.0, 0.0], 0)]))  # beyond the limit, repeated
    assert out.count() == 3 and np.allclose(shares, [1.0])


def test_whitening_query(spark):
    out = entry.queries()["op12_feast_whitening"](spark, SF_SMALL)
    assert dict(out.dtypes) == {"vec_id": "bigint", "component": "int", "n": "bigint", "deviation": "bigint", "whitened": "double", "explained": "double", "identity_error": "double"}
    assert out.count() == 32 * 500 and out.agg(F.max("identity_error")).first()[0] < 1e-4


def test_golomb_code_round_trip():
    rng = np.random.default_rng(3)
    for span, n in ((1 << 40, 1), (1 << 40, 1000), (1 << 12, 4000), (1 << 9, 600), (2, 2)):
        values = np.sort(rng.integers(0, span, n))
        k, code = exact_dedup.encode(values, span)
        assert np.array_equal(exact_dedup.decode(k, n, code), values)
    values = np.sort(rng.integers(0, 1 << 40, 1000))
    assert len(exact_dedup.encode(values, 1 << 40)[1]) < 1000 * 33 / 8  # 30 bits of gap and about 1.5 each


def _copies(rows):
    groups = collections.defaultdict(list)
    for i, text in rows:
        groups[text or ""].append(i)
    out = []
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = max(known, default=None)
        kept = [False] * len(ids)
        kept[ids.index(keep)] = True
        out += [(i, keep, len(ids), k, hashlib.sha256(text.encode()).hexdigest()) for i, k in zip(ids, kept)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("weak", [False, True])
def test_exact_duplicates_equal_brute_force(spark, monkeypatch, weak):
    """With a digest of three values, most classes share a fingerprint and the bytes alone tell them apart."""
    monkeypatch.setattr(exact_dedup, "BLOCK_ROWS", 8)
    docs = H.documents(spark)
    docs = docs.unionByName(docs.filter("doc_id < 12").withColumn("doc_id", F.col("doc_id") + 200)).unionByName(docs.filter("doc_id = 3").withColumn("doc_id", F.explode(F.sequence(F.lit(300), F.lit(340)))))
    docs = docs.unionByName(docs.filter("doc_id = 4").withColumn("doc_id", F.lit(None).cast("long"))).repartition(5)
    options = {"digest": lambda t: hashlib.sha256(str(len(t) % 3).encode()).digest()} if weak else {}
    got = [tuple(r) for r in exact_dedup.exact_duplicates(docs, **options).collect()]
    want = _copies([(r["doc_id"], r["text"]) for r in docs.collect()])
    if weak:
        got, want = [r[:4] for r in got], [r[:4] for r in want]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_exact_duplicates_of_other_keys_and_empty_tables(spark):
    docs = spark.createDataFrame([("b", " x "), ("a", "x"), ("c", None), (None, "")], "name string, body string")
    got = {(r["name"], r["keep_id"], r["group_size"], r["kept"]) for r in exact_dedup.exact_duplicates(docs, "body", "name", F.trim).collect()}
    assert got == {("a", "b", 2, False), ("b", "b", 2, True), ("c", "c", 2, True), (None, "c", 2, False)}
    assert exact_dedup.exact_duplicates(docs.limit(0), "body", "name").count() == 0


def test_texts_of_exact_duplicates_move_only_where_suspect(spark):
    """The texts are read from their buckets without an exchange; only bitmaps are dealt to them."""
    out = exact_dedup.exact_duplicates(H.documents(spark))
    rows = out.collect()
    assert sum(r["kept"] for r in rows) == len({r["text_sha256"] for r in rows})
