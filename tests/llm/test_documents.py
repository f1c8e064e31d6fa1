"""The operators over documents: edges, skew, and brute force."""

from __future__ import annotations

import base64
import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from capsight.llm import bpe, kd_shards, mixing, ngram_join, quality, secrets
from tests.llm import helpers as H


@pytest.fixture(scope="module")
def docs(spark):
    return H.documents(spark).cache()


@pytest.fixture(scope="module")
def texts(docs):
    return [(r["doc_id"], r["text"], r["source"]) for r in docs.select("doc_id", "text", "source").collect()]


# --- byte-level BPE -----------------------------------------------------------

@pytest.fixture(scope="module")
def encoding():
    import public_tokenizers as P
    import tiktoken
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(bpe.vocabulary_path(), "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.mark.parametrize("alphabet", ["ab 's'tl\n\r\t .,é日1'dmvre  ", "abcde", "日本é😀 ", "a "])
def test_bpe_equals_tiktoken(encoding, alphabet):
    rnd = random.Random(len(alphabet))
    texts = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 150))) for _ in range(150)] + ["", None, "it's we'll 'tis", "a" * 3000, "ab" * 900]
    out = bpe._slice(bpe.codec(bpe.vocabulary_path()), pa.array(texts, pa.string()))
    for text, ids, plain in zip(texts, out["ids"], out["decoded"]):
        assert list(ids) == encoding.encode_ordinary(text or "") and plain == (text or "").encode()


def test_bpe_over_documents(spark, docs, texts, encoding):
    got = bpe.tokenize(docs.filter("doc_id <> 105"), bpe.vocabulary_path(), ids=True)
    rows = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in got.collect())
    want = []
    for i, t, _ in texts:
        if i != 105:
            ids = encoding.encode_ordinary(t or "")
            want.append((i is None, i or 0, len(ids), hashlib.sha256(b"".join(x.to_bytes(4, "little") for x in ids)).hexdigest(),
                         hashlib.sha256((t or "").encode()).hexdigest()))
    assert rows == sorted(x for x in want if not x[0])
    back = {r["doc_id"]: r["decoded"] for r in bpe.decode(got, bpe.vocabulary_path()).collect()}
    assert all(bytes(back[i]) == (t or "").encode() for i, t, _ in texts if i is not None and i != 105)
    assert bpe.tokenize(docs.limit(0), bpe.vocabulary_path()).count() == 0


def test_bpe_of_huge_pieces(encoding):
    """Letters without a break: the same ids as tiktoken's, and millions of them in bounded memory."""
    rnd = random.Random(3)
    coder = bpe.codec(bpe.vocabulary_path())
    texts = ["".join(rnd.choice("etaoinshrdlu") for _ in range(bpe.HUGE + 5)), "x" * 70_000, "ab" * 20_000 + "é" * 9000]
    for text, ids, plain in zip(texts, *bpe._slice(coder, pa.array(texts)).values()):
        assert list(ids) == encoding.encode_ordinary(text) and plain == text.encode()
    text = "".join(rnd.choices("etaoinshrdlu", k=2_500_000))
    out = bpe._slice(coder, pa.array([text]))
    assert out["decoded"] == [text.encode()] and 500_000 < len(out["ids"][0]) < 2_500_000


def test_bpe_unknown_id_fails(spark):
    with pytest.raises(Exception, match="not in the vocabulary"):
        bpe.decode(spark.createDataFrame([(1, bytearray(b"\xff\xff\xff\x7f"))], "doc_id long, ids binary"), bpe.vocabulary_path()).collect()


# --- n-gram Jaccard join ------------------------------------------------------

def _joined(df):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"], r["n_links"]) for r in df.collect()}


def test_ngram_join_edges(docs, texts):
    rows = docs.filter("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    got = _joined(ngram_join.ngram_join(rows))
    assert got == H.shingle_links({r["doc_id"]: r["text"] for r in rows.collect()})
    every = ngram_join.ngram_join(docs)
    assert every.count() == len(texts)
    twice = [r for r in every.collect() if r["doc_id"] == 107]
    assert len(twice) == 2 and all((r["component_id"], r["n_links"]) == (106, 2) for r in twice)
    assert ngram_join.ngram_join(docs.limit(0)).count() == 0


def test_ngram_join_skewed_group(spark, monkeypatch):
    """Near copies of one text, a passage that all documents share, and blocks of a few rows."""
    rnd = random.Random(4)
    monkeypatch.setattr(ngram_join, "GROUP_DOCS", 12)
    monkeypatch.setattr(ngram_join, "CHUNK", 900)
    base, passage = H.prose(5, 90).split(), H.prose(8, 40)
    rows = []
    for i in range(90):
        w = list(base)
        for _ in range(rnd.randint(0, 9)):
            w[rnd.randrange(len(w))] = f"edit{rnd.randrange(10 ** 6)}"
        rows.append((i, " ".join(w)))
    rows += [(100 + i, f"{passage} " + " ".join(f"own{i}x{k}" for k in range(30 + i))) for i in range(60)]
    rows += [(200 + i, rows[i % 3][1].upper()) for i in range(20)]
    got = _joined(ngram_join.ngram_join(spark.createDataFrame(rows, "doc_id long, text string").repartition(6)))
    assert got == H.shingle_links(dict(rows))


def test_ngram_join_chunks_of_the_same_classes(spark):
    """Two near copies in very many rows: every task holds both classes, in either order."""
    one = H.prose(5, 90)
    two = one + " end"
    parts = [[one, two], [two, one], [one, two], [two, one]]
    rows = [(1000 * k + i, text) for k, part in enumerate(parts) for i, text in enumerate(part * 250)]
    rdd = spark.sparkContext.parallelize(rows, 4)
    got = _joined(ngram_join.ngram_join(spark.createDataFrame(rdd, "doc_id long, text string")))
    assert {(c, n) for _, c, n in got.values()} == {(0, 1999)} and len(got) == 2000


@pytest.mark.parametrize("percent", [50, 75, 100])
def test_ngram_join_bounds(spark, percent):
    """Overlaps right at, over and under the bound."""
    w = [f"w{k}" for k in range(60)]
    rows = [(n, " ".join(w[:n])) for n in range(5, 60, 3)] + [(100 + n, " ".join(w[n:])) for n in range(0, 50, 7)]
    got = _joined(ngram_join.ngram_join(spark.createDataFrame(rows, "doc_id long, text string"), percent=percent))
    assert got == H.shingle_links(dict(rows), percent=percent)


# --- quality classifier -------------------------------------------------------

def test_quality_learns_and_holds_out(spark):
    good = [(i, H.prose(i, 60) + ".", 1) for i in range(150)]
    bad = [(1000 + i, " ".join(f"{x.upper()}!!" for x in H.prose(i, 60).split()), 0) for i in range(60)]
    docs = spark.createDataFrame([x[:2] for x in good + bad], "doc_id long, text string")
    labels = spark.createDataFrame([(i, q) for i, _, q in good + bad], "doc_id long, quality int")
    scored = quality.score(docs, quality.fit(docs, labels)).withColumn("held_out", quality.held_out(F.col("doc_id"))).collect()
    truth = {i: q for i, _, q in good + bad}
    assert {r["doc_id"] for r in scored if r["held_out"]} == {i for i in truth if zlib.crc32(str(i).encode()) % 5 == 0}
    assert all((r["quality_score"] >= 0.3) == truth[r["doc_id"]] for r in scored)
    flipped = labels.withColumn("quality", F.when(quality.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    again = {r["doc_id"]: r["quality_score"] for r in quality.score(docs, quality.fit(docs, flipped)).collect()}
    assert again == {r["doc_id"]: r["quality_score"] for r in scored}  # held-out labels are never read


def test_quality_edges(spark, docs, texts):
    labels = spark.createDataFrame([(i, i % 2) for i in range(24)] + [(None, 1), (1, None), (1, 0), (3, 1), (3, 1)], "doc_id long, quality int")
    out = quality.score(docs, quality.fit(docs, labels))
    rows = out.collect()
    assert len(rows) == len(texts) and out.columns == docs.drop("quality_score").columns + ["quality_score"]
    assert all(0 <= r["quality_score"] <= 1 for r in rows)
    assert {r["quality_score"] for r in rows if r["doc_id"] in (100, 101)} == {0.0}
    nothing = quality.score(docs, quality.fit(docs, labels.limit(0))).filter("doc_id = 5").first()
    assert nothing["quality_score"] == 0.5
    assert quality.score(docs.limit(0), quality.fit(docs, labels)).count() == 0
    assert quality.score(docs, quality.fit(docs.limit(0), labels)).count() == len(texts)


# --- secrets ------------------------------------------------------------------

@pytest.fixture(scope="module")
def forest(spark):
    return secrets.train(secrets.labelled_findings(spark, 3000).filter("id % 5 <> 0"), trees=20)


def test_secret_forest_on_held_out_findings(spark, forest):
    rows = secrets.score(secrets.labelled_findings(spark, 3000).filter("id % 5 = 0"), forest)
    assert rows.filter((F.col("label") == 1) != F.col("is_secret")).count() <= 0.02 * rows.count()


def test_secret_candidates_in_one_pass_and_in_two(spark):
    """Texts that hold the marks are cut in two passes, with the same candidates; the cut parts make up the text."""
    import re
    key = "".join("abcdef0123456789"[(7 * i) % 16] for i in range(40))
    texts = [f'token = "{key}" and https://bob:hunter2pw@host/x {key}', f"x-SG.{key[:12]}.{key[:9]}+/{key} tail", "nothing here", "", f"pwd: {'y' * 300}1 {key}={key}",
             f"https://u:{'p' * 250}@h", f"é{key} ünd password='Tr0ub4dor&3x'"]
    marked = [t + " \x01 " for t in texts] + ["\x02" + t for t in texts]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts + marked)], "doc_id long, text string")
    parts = {r["doc_id"]: r["p"] for r in rows.select("doc_id", secrets._cut(F.col("text"), secrets.RUN).alias("p")).collect()}
    assert all("".join(parts[i]) == t for i, t in enumerate(texts + marked)) and all(len(p) % 2 for p in parts.values())
    for i in range(len(texts)):
        assert parts[i][1::2] == parts[i + len(texts)][1::2] == parts[i + 2 * len(texts)][1::2]
    assert "hunter2pw" in parts[0] and "p" * 250 in parts[5] and "Tr0ub4dor&3x" in parts[6] and parts[2] == ["nothing here"]
    found = {r["doc_id"]: r for r in secrets.candidates(rows.filter("doc_id < 7")).collect()}
    assert set(found) == {0, 1, 4, 5, 6}


def test_secrets_found_and_masked(spark, docs, forest):
    key = hashlib.sha1(b"a").hexdigest()
    rows = [(1, f'so token = "{key}" here', 0), (2, f"commit {key} by", 0), (3, f'é TOKEN = "{key.upper()}"!! and api_key: {key[:32]}, dann', 0),
            (4, "enbereinachheitbe unddasistalles", 0), (5, None, None), (6, "", 0), (7, "4" * 16, 16), (1, f'so token = "{key}" here', 0)]
    some = spark.createDataFrame(rows, "doc_id long, text string, n_chars long").withColumn("_key", F.lit(1)).withColumn("length", F.lit(2))
    found = secrets.scan(some, forest)
    got = sorted((r["doc_id"], r["start"], r["candidate"]) for r in found.filter("is_secret").collect())
    third = rows[2][1]
    assert got == sorted([(1, 12, key)] * 2 + [(3, third.index(key.upper()), key.upper()), (3, third.index(key[:32]), key[:32])])
    out = secrets.redact(some, found)
    assert out.columns == some.columns
    clean = sorted((r["doc_id"], r["text"] or "", r["n_chars"]) for r in out.collect())
    masked = 'so token = "[SECRET]" here'
    assert clean == sorted([(1, masked, len(masked))] * 2 + [(2, rows[1][1], 0), (3, 'é TOKEN = "[SECRET]"!! and api_key: [SECRET], dann', 50), (4, rows[3][1], 0), (5, "", None), (6, "", 0), (7, "4" * 16, 16)])
    whole = secrets.redact(docs, secrets.scan(docs, forest))
    assert whole.count() == docs.count() and secrets.scan(docs.limit(0), forest).count() == 0
    # every candidate of a long text lies where it says
    long = spark.createDataFrame([(1, " ".join(f"{'ab' * 9}{i} é" for i in range(3000)))], "doc_id long, text string")
    text = long.first()["text"]
    at = secrets.scan(long, forest).collect()
    assert len(at) == 3000 and all(text[r["start"]:].startswith(r["candidate"]) for r in at)


def test_short_and_dotted_secrets(spark, forest):
    """Passwords of assignments and urls, tokens with dots."""
    dotted = "SG." + "aB3dE5gH7jK9mN1pQ3sT5u" + "." + "xY2zA4bC6dE8fG0hI1jK3lM5nO7pQ9rS2tU4vW6xY8z"
    lines = [('so password = "Tr0ub4dor&3x" here', "Tr0ub4dor&3x"), ('db_password="s3cr3tPass99"', "s3cr3tPass99"), ("see https://bob:hunter2pw@host/x", "hunter2pw"),
             (f"api_key = '{dotted}'", dotted), ("password: required", None), ("a word: sentence12 goes on", None), ("https://example.com:8080/x@y", None)]
    some = spark.createDataFrame([(i, text) for i, (text, _) in enumerate(lines)], "doc_id long, text string")
    found = secrets.scan(some, forest)
    assert {(r["doc_id"], r["start"], r["candidate"]) for r in found.filter("is_secret").collect()} == {(i, t.index(c), c) for i, (t, c) in enumerate(lines) if c}
    assert {r["doc_id"]: r["text"] for r in secrets.redact(some, found).collect()} == {i: t.replace(c or "\0", "[SECRET]") for i, (t, c) in enumerate(lines)}


def test_neighbourhoods_are_the_texts(spark, forest):
    """Long words beside a candidate stay in its neighbourhood; names are no part of candidates."""
    key, trace = "wJalrXUtnFEMIK7MDENGbPxRfiCYzkdh3k9Qv2Lp", hashlib.md5(b"t").hexdigest()
    lines = [(f'aws_secret_access_key = "{key}"', key), (f"x-request-trace-id: {trace}", None), (f"API_KEY={trace}", trace), (f"{'long-word-' * 9} {'other_words_' * 3}. {trace} {'q' * 70}", None)]
    some = spark.createDataFrame([(i, text) for i, (text, _) in enumerate(lines)], "doc_id long, text string")
    rows = secrets.scan(some, forest).collect()
    for r in rows:
        text, a = lines[r["doc_id"]][0], r["start"]
        b = a + len(r["candidate"])
        assert (text[a:b], r["before"], r["after"]) == (r["candidate"], text[max(0, a - 60):a], text[b:b + 60])
    assert {(r["doc_id"], r["candidate"]) for r in rows if r["is_secret"]} == {(i, c) for i, (_, c) in enumerate(lines) if c}


# --- mixing -------------------------------------------------------------------

def _filled(sizes: dict, cap: float = 3.0) -> dict:
    """Targets by resharing the excess until none is above its cap."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (1, 2, 3)[k % 3] for k, s in enumerate(order)}
    total, full = sum(sizes.values()), set()
    while True:
        left = total - sum(cap * sizes[s] for s in full)
        free = sum(weight[s] for s in order if s not in full)
        target = {s: cap * sizes[s] if s in full else left * weight[s] / free for s in order}
        over = {s for s in order if s not in full and target[s] > cap * sizes[s] * (1 + 1e-12)}
        if not over:
            return target
        full |= over


@pytest.mark.parametrize("sizes", [{"a": 100, "b": 100, "c": 100}, {"a": 5000, "b": 3, "c": 40, None: 900, "z": 0}, {"x": 7}, {"b": 1, "a": 10_000, "é": 300, "B": 2}])
def test_targets_fill_like_resharing(spark, sizes):
    rows = spark.createDataFrame(list(sizes.items()), "source string, size long")
    got = {r["source"]: r["target"] for r in mixing.targets(rows).collect()}
    want = _filled({s: n for s, n in sizes.items()})
    assert got.keys() == want.keys() and all(abs(got[s] - want[s]) < 1e-6 * max(1, want[s]) for s in want)


@pytest.mark.parametrize("blocks", [1, 2, 5, 64, 997, 1024])
def test_passes_are_permutations(spark, blocks):
    rows = spark.range(3 * blocks).select("id", mixing.permuted(F.col("id"), F.lit(blocks), F.lit(2), 7).alias("x")).orderBy("id").collect()
    for p in range(3):
        assert sorted(r["x"] for r in rows[p * blocks:(p + 1) * blocks]) == list(range(blocks))


def test_mix_edges(docs, texts):
    options = {"block": 8, "shard_slots": 100}
    rows = mixing.taken_words(docs, **options).collect()
    assert len(rows) == len(texts)
    assert sorted(r["size"] for r in rows) == sorted(len(H.words(t)) for _, t, _ in texts)
    assert all(r["taken"] <= 3 * r["size"] for r in rows)
    by = {}
    for r in rows:
        by.setdefault((r["source_size"], r["target"]), []).append(r["taken"])
    assert all(abs(sum(v) - target) <= 30 for (size, target), v in by.items())
    again = mixing.taken_words(docs.repartition(5), **options).collect()
    order = lambda rs: sorted((r["doc_id"] is None, r["doc_id"] or 0, r["size"], r["taken"]) for r in rs)
    assert order(rows) == order(again)
    mixed = mixing.mixed_documents(docs, **options)
    assert mixed.columns == docs.columns
    assert sum(len(H.words(r["text"])) for r in mixed.collect()) == sum(r["taken"] for r in rows)
    assert mixing.taken_words(docs.limit(0)).count() == 0 and mixing.mixed_documents(docs.limit(0)).count() == 0


# --- k-d shards ---------------------------------------------------------------

@pytest.mark.parametrize("shards", [1, 3, 16])
def test_shards_balance_and_slots(spark, shards):
    rows = [(i, "w " * (5 + i % 40), "en", "hot" if i % 3 else f"s{i % 7}", i) for i in range(3000)]
    rows += [(5000 + i, "copy of one text", "de", "hot", 1) for i in range(1500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    out = kd_shards.kd_shards(docs, shards).toPandas()
    assert len(out) == len(rows) and sorted(out.shard.unique()) == list(range(shards))
    per = out.groupby("shard")["size"].sum()
    assert per.max() - per.min() <= 2 * out["size"].max() + 0.01 * per.mean()
    for _, g in out.groupby("shard"):
        assert sorted(g.slot) == list(range(len(g)))


def test_shards_edges(spark, docs, texts):
    out = kd_shards.kd_shards(docs, 4).collect()
    assert len(out) == len(texts)
    assert sorted(r["size"] for r in out) == sorted(len((t or "").encode()) + 1 for _, t, _ in texts)
    assert {r["text_crc32"] for r in out if r["doc_id"] == 104} == {zlib.crc32(next(t for i, t, _ in texts if i == 104).encode())}
    for s in {r["shard"] for r in out}:
        assert sorted(r["slot"] for r in out if r["shard"] == s) == list(range(sum(r["shard"] == s for r in out)))
    assert kd_shards.kd_shards(docs.limit(0), 4).count() == 0
    total = sum(r["size"] for r in out)
    assert len({r["shard"] for r in kd_shards.kd_shards(docs.filter("doc_id < 100"), target_bytes=300).collect()}) > 4 and total > 0
    equal = spark.createDataFrame([(1, "same", "en", "s", 4)] * 50, "doc_id long, text string, lang string, source string, n_chars long")
    assert sorted(r["count"] for r in kd_shards.kd_shards(equal, 4).groupBy("shard").count().collect()) == [12, 12, 13, 13]  # a row number tells them apart


def test_shards_keep_their_law_on_repeated_rows_and_null_ids(spark):
    rows = [(1, "same text", "en", "hot", 9)] * 400 + [(None, "no id", "en", "hot", 5)] * 200 + [(i, "w " * (i % 9), None, f"https://host.example/{i % 60}", None) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    for count in (4, 7):
        out = kd_shards.kd_shards(docs, count).toPandas()
        per = out.groupby("shard")["size"].sum()
        assert len(out) == 800 and len(per) == count and per.max() - per.min() <= 2 * out["size"].max() + 0.01 * per.mean()
    assert kd_shards.kd_shards(docs, 4).groupBy("shard", "slot").count().filter("count > 1").count() == 0


def test_text_dimensions_are_ordered_by_their_whole_values(spark):
    values = [f"https://a-long-common-prefix.example/{i:03d}" for i in range(300)]
    rows = spark.createDataFrame([(v,) for v in values[::-1]] * 2 + [(None,)], "d0 string").repartition(7)
    got = sorted((r["d0"], r["rank"]) for r in kd_shards.ranks(rows, "d0").collect())
    assert got == [(v, float(i)) for i, v in enumerate(values)]
    docs = spark.createDataFrame([(i, "x" * 9, None, v, 1) for i, v in enumerate(values)], "doc_id long, text string, lang string, source string, n_chars long").repartition(5)
    out = kd_shards.kd_shards(docs, 2, dimensions=("source",)).join(docs, "doc_id").groupBy("shard").agg(F.min("source"), F.max("source"), F.count("*")).orderBy("shard").collect()
    assert [tuple(r)[1:] for r in out] == [(values[0], values[149], 150), (values[150], values[299], 150)]


def test_mix_of_sources_without_words(spark):
    """A source of empty and null texts takes nothing; a table of such texts gives an empty mix."""
    schema = "doc_id long, text string, source string"
    rows = [(i, " \n", "blank") for i in range(3)] + [(9, None, "blank"), (10, "", None)]
    docs = spark.createDataFrame(rows + [(20 + i, f"some words of {i}", "real") for i in range(8)], schema)
    got = {r["doc_id"]: (r["size"], r["source_size"], r["target"], r["taken"]) for r in mixing.taken_words(docs).collect()}
    assert all(got[i][0] == got[i][1] == got[i][3] == 0 and got[i][2] == 0.0 for i, _, _ in rows) and sum(t for _, _, _, t in got.values()) == 32
    assert {r["doc_id"] for r in mixing.mixed_documents(docs).collect()} == set(range(20, 28))
    none = spark.createDataFrame(rows, schema)
    assert {r["taken"] for r in mixing.taken_words(none).collect()} == {0} and mixing.taken_words(none).count() == 5
    assert mixing.mixed_documents(none).count() == 0


def test_mix_draws_agree_however_they_are_dealt(spark, monkeypatch):
    """Beyond the bound on sources, the draws are the same."""
    plan = spark.createDataFrame([(k, 1000 + 37 * k) for k in range(5)], "rank long, slots long")
    one = sorted(tuple(r) for r in mixing.shard_draws(plan, 100).collect())
    monkeypatch.setattr(mixing, "SOURCES", 2)
    assert sorted(tuple(r) for r in mixing.shard_draws(plan, 100).collect()) == one
    total = {}
    for rank, _, _, count in one:
        total[rank] = total.get(rank, 0) + count
    assert total == {k: 1000 + 37 * k for k in range(5)}


def test_repeated_rows_of_a_mix_are_told_apart(spark, monkeypatch):
    monkeypatch.setattr(mixing, "CHUNK_ROWS", 7)
    docs = spark.createDataFrame([(1, "the same words again", "a")] * 40 + [(2, "others here", "b"), (None, "the same words again", None), (None, "the same words again", None)],
                                 "doc_id long, text string, source string").repartition(4)
    rows = mixing.numbered(mixing.sized_rows(docs))
    assert rows.count() == rows.select("uid").distinct().count() == 43


def test_quality_votes_equal_a_plain_search(spark):
    """Scores of the model against a loop over all labelled vectors."""
    rng = np.random.default_rng(3)
    terms = rng.integers(0, 9, (60, quality.TERMS)).astype(float)
    labels = (np.arange(60) % 3 > 0).astype(float)
    base, every = quality.latent(terms, labels, {0: 2.0, 1: 1.0}, 0.6)
    model = quality.with_directions(base, terms, every[:, :12], 5)
    asked = rng.integers(0, 9, (20, quality.TERMS)).astype(float)
    vectors = model.vector(asked).astype(np.float32)
    for got, v in zip(model.score(asked), vectors):
        near = sorted(((float(v @ w), k) for k, w in enumerate(model.vectors)), reverse=True)[:5]
        votes = [(max(c, 1e-6) ** quality.SHARPNESS * (2.0 if labels[k] == 0 else 1.0), labels[k]) for c, k in near]
        assert abs(got - sum(w * y for w, y in votes) / sum(w for w, _ in votes)) < 1e-4


def test_quality_has_no_more_voters_than_the_rarer_label(spark):
    rng = np.random.default_rng(5)
    terms = np.vstack([rng.poisson(1.0, (50, quality.TERMS)), rng.poisson(np.linspace(0, 3, quality.TERMS), (4, quality.TERMS))]).astype(float)
    labels = np.array([1.0] * 50 + [0.0] * 4)
    directions, voters = quality.chosen(terms, labels, {0: 1.0, 1: 1.0}, 0.9, quality.DIRECTIONS, quality.VOTERS)
    assert voters <= 3 and directions in quality.DIRECTIONS


def test_bpe_worker_memory(tmp_path):
    """One worker's process over mostly new pieces stays within bounds, and frequent pieces are not learned again."""
    import subprocess
    import sys
    code = """
import re, sys
import pyarrow as pa
sys.path.insert(0, %r)
from capsight.llm import bpe
coder = bpe.codec(bpe.vocabulary_path())
learned, learn = [], coder.learn
coder.learn = lambda pieces: learned.extend(p for p in pieces if p == b" frequentlyrepeatedword") or learn(pieces)
bpe.CACHE = 4 << 20
for k in range(12):
    texts = pa.array(["".join(f" {(i * 2654435761 + j * 97 + k) %% 16777216:x} frequentlyrepeatedword" for j in range(40)) for i in range(k * 900, k * 900 + 900)], pa.string())
    for a, b in bpe._slices(texts):
        bpe._slice(coder, texts.slice(a, b - a))
    bpe.release()
print(len(learned), int(re.search(r"VmHWM:[ \t]+([0-9]+)", open("/proc/self/status").read())[1]) // 1024)
""" % str(bpe.__file__.rsplit("/capsight/", 1)[0])
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300)
    assert out.returncode == 0, out.stderr[-1500:]
    times, megabytes = map(int, out.stdout.split())
    assert times == 1 and megabytes < 330
