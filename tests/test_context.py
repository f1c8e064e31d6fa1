"""H1-H4: recent media scan order, dedupe, cap, per-turn view, context text."""
import re

from capsight.operators.context import (
    conversation_context, context_timeout_ms, media_mentions, recent_media, recent_media_by_turn,
)

M = "[media attached: {} | inbound]"


def msgs(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def listed(df, *keys):
    out = {}
    for r in df.orderBy(*keys, "media_pos").collect():
        out.setdefault(tuple(r[k] for k in keys), []).append(r.file_path)
    return out


def test_newest_first_leftmost_kept_reversed(spark):
    df = msgs(spark, [
        (1, 0, "user", M.format("/a.png")),
        (1, 1, "user", M.format("/b.png") + " " + M.format("/c.png") + " " + M.format("/d.png")),
        (1, 2, "user", M.format("/e.png") + " " + M.format("/a.png")),
    ])
    # newest message first: e, a; then b, c (cap 4 reached before d)
    assert listed(recent_media(df, 8, 4), "conv_id") == {(1,): ["/c.png", "/b.png", "/a.png", "/e.png"]}


def test_window_of_last_messages_and_dedupe(spark):
    df = msgs(spark, [(1, t, "user", M.format(f"/p{t % 2}.png")) for t in range(6)])
    assert listed(recent_media(df, 3, 4), "conv_id") == {(1,): ["/p0.png", "/p1.png"]}
    assert listed(recent_media(df, 1, 4), "conv_id") == {(1,): ["/p1.png"]}


def test_path_pattern_details(spark):
    df = msgs(spark, [(1, 0, "user", "[media attached: foo.txt] see bar.png | x] [MEDIA ATTACHED:  /x/y.JPEG (image/jpeg) |"),
                      (2, 0, "user", "[media attached: notes.txt | x]")])
    got = listed(recent_media(df), "conv_id")
    assert got == {(1,): ["/x/y.JPEG", "foo.txt] see bar.png"]}


def test_by_turn_equals_brute_force(spark):
    rows = [(c, t, "user", " ".join(M.format(f"/i{(c * 7 + t * k) % 5}.png") for k in range(t % 3)))
            for c in range(4) for t in range(10)]
    df = msgs(spark, rows)
    got = listed(recent_media_by_turn(df, 3, 2), "conv_id", "turn")
    for c in range(4):
        for t in range(10):
            sub = msgs(spark, [r for r in rows if r[0] == c and r[1] <= t])
            want = listed(recent_media(sub, 3, 2), "conv_id").get((c,))
            assert got.get((c, t)) == want


def test_context_text_and_limits(spark):
    entries = spark.createDataFrame([(1, 2, "B"), (1, 1, "A")], "conv_id long, media_pos int, entry string")
    ctx = conversation_context(entries).collect()[0]
    assert ctx.context.split("\n")[2] == "" and ctx.context.endswith("\n\nA\n\nB") and ctx.n_entries == 2
    assert conversation_context(entries, enabled=False).count() == 0
    assert context_timeout_ms(30000) == 12000 and context_timeout_ms(1000) == 3000 and context_timeout_ms(5000) == 5000


def test_mentions_keep_every_occurrence(spark):
    df = msgs(spark, [(1, 0, "u", M.format("/a.png") + M.format("/a.png"))])
    assert media_mentions(df).count() == 2


def test_recent_media_plan_limits_before_shuffle(spark):
    df = msgs(spark, [(1, 0, "user", M.format("/a.png"))]).repartition(4)
    plan = recent_media(df)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_hot_conversation_matches_brute_force(spark):
    """A third of all messages in one conversation (spread over many partitions)."""
    from pyspark.sql import functions as F
    from capsight.sources import fixtures as fx
    msgs_df = fx.messages(spark, "/root/testdata/sf0.01")
    hot = msgs_df.withColumn("turn", F.when(F.col("conv_id") % 3 == 0, F.col("conv_id") * 100 + F.col("turn"))
                             .otherwise(F.col("turn"))) \
                 .withColumn("conv_id", F.when(F.col("conv_id") % 3 == 0, F.lit(-1)).otherwise(F.col("conv_id"))) \
                 .repartition(7)
    got = listed(recent_media(hot, 8, 4), "conv_id")
    convs = {}
    for r in hot.collect():
        convs.setdefault(r.conv_id, []).append((r.turn, r.text))
    want = {}
    for c, ms in convs.items():
        last = [t for _, t in sorted(ms)][-8:]
        seen = list(dict.fromkeys(p for t in last[::-1] for p in MEDIA.findall(t)))
        paths = seen[:4][::-1]
        if paths:
            want[(c,)] = paths
    assert got == want and len(convs[-1]) > 100


def test_fallback_entries_show_base_name_only(spark):
    from pyspark.sql import functions as F
    from capsight.operators.context import failed_entry, timed_out_entry
    df = spark.createDataFrame([("/tmp/slow-image.png",)], "p string")
    r = df.select(timed_out_entry(F.col("p"), 12000).alias("t"), failed_entry(F.col("p"), F.lit("ENOENT")).alias("f")).collect()[0]
    assert "Kind: analysis_timed_out" in r.t and "slow-image.png" in r.t and "auto_context_timeout_12000ms" in r.t
    assert "Kind: analysis_failed" in r.f and "/tmp/" not in r.f and r.f.endswith("Warnings: ENOENT")


def test_context_entries_status(spark):
    from capsight.plans.queries import entries
    st = {r.status for r in entries(spark, "/root/testdata/sf0.001").collect()}
    assert "ok" in st and "analysis_failed" in st


def test_nested_messages_scan_each_string_on_its_own(spark):
    import json
    msgs_json = [(1, 0, json.dumps({"a": "[media attached:", "b": "/split.png | x"})),
                 (1, 1, json.dumps({"content": [{"text": M.format("/a.png")}, {"text": M.format("/b.png")}]}))]
    df = spark.createDataFrame(msgs_json, "conv_id long, turn long, message string")
    assert listed(recent_media(df, nested="message"), "conv_id") == {(1,): ["/b.png", "/a.png"]}


def test_by_turn_renumbers_gapped_turns(spark):
    rows = [(1, t * 10, "user", M.format(f"/g{t % 3}.png")) for t in range(6)]
    got = listed(recent_media_by_turn(msgs(spark, rows), 2, 4), "conv_id", "turn")
    for t in range(6):
        sub = msgs(spark, [r for r in rows if r[1] <= t * 10])
        assert got.get((1, t * 10)) == listed(recent_media(sub, 2, 4), "conv_id").get((1,))


# the marker, spelled out a second time
MEDIA = re.compile(r"\[media attached:\s*([^\n|]+?[.](?:png|jpe?g|webp|gif|heic|heif|bmp|tiff?|avif|svg))(?:\s*\([^)]+\))?\s*\|", re.IGNORECASE)


def test_messages_without_text_take_their_place(spark):
    """One media message, then nine with numbers only: it has scrolled out; plain text and JSON with a key twice count as text."""
    import json
    rows = [(1, 0, json.dumps({"text": M.format("/old.png")}))] + [(1, t, json.dumps({"n": t})) for t in range(1, 10)]
    rows += [(2, 0, M.format("/plain.png")), (3, 0, '{"a": 1, "a": "' + M.format("/twice.png") + '"}'), (4, 0, None)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, message string")
    assert listed(recent_media(df, nested="message"), "conv_id") == {(2,): ["/plain.png"], (3,): ["/twice.png"]}


def test_positions_split_ranges(spark):
    from pyspark.sql import functions as F
    from capsight.operators.context import with_positions
    rows = spark.range(9000).select(F.lit(1).alias("conv_id"), (F.col("id") * 7 + 3).alias("turn"), F.lit("x").alias("text")).repartition(5)
    got = with_positions(rows).orderBy("turn").select("position").collect()
    assert [r.position for r in got] == list(range(9000))


def test_entries_without_attempts_and_with_two_captures_on_one_path(spark):
    from capsight.operators.context import context_entries
    from tests.conftest import capture_rows
    caps = capture_rows(spark, [{"file_name": "r.png", "ocr_text": "合计 1\n实付 1", "modified_ms": 1}, {"file_name": "r.png", "ocr_text": "合计 2\n实付 2", "modified_ms": 2}])
    media = spark.createDataFrame([(1, 1, "/img/r.png"), (2, 1, "/img/r.png"), (2, 2, "/img/gone.png")], "conv_id long, media_pos int, file_path string")
    out = sorted((r.conv_id, r.media_pos, r.status, "amount=2" in r.entry) for r in context_entries(media, caps, None).collect())
    assert out == [(1, 1, "ok", True), (2, 1, "ok", True), (2, 2, "analysis_failed", False)]


def _as_of(rows, max_messages, max_images):
    """Brute force: per conversation and turn the list after the turn's last message."""
    out = {}
    for c in {r[0] for r in rows}:
        mine = sorted((t, x is not None, x or "") for k, t, _, x in rows if k == c)
        for turn in {t for t, _, _ in mine}:
            upto = [x for t, _, x in mine if t <= turn][-max_messages:]
            paths = list(dict.fromkeys(p for x in upto[::-1] for p in MEDIA.findall(x)))[:max_images][::-1]
            if paths:
                out[(c, turn)] = paths
    return out


def test_large_conversations_in_blocks_equal_brute_force(spark):
    """Epoch turns with ties over block edges, null texts, repeated rows; blocks smaller and larger than the window."""
    import random
    rng = random.Random(5)
    rows = [(1, 1_700_000_000_000 + rng.randrange(60) * 60_000, "u", None if i % 11 == 0 else f"n{rng.randrange(4)} " + (M.format(f"/i{i % 17}.png") if i % 3 == 0 else ""))
            for i in range(230)]
    rows += [(c, t, "u", M.format(f"/s{(c + t) % 5}.png")) for c in range(2, 9) for t in range(c)] + [(1, 1_700_000_000_000, "u", M.format("/i1.png"))] * 3
    df = msgs(spark, rows).repartition(6)
    want = _as_of(rows, 8, 4)
    for range_rows in (3, 20, 10_000):
        assert listed(recent_media_by_turn(df, range_rows=range_rows), "conv_id", "turn") == want, range_rows
    assert listed(recent_media(df), "conv_id") == {(c,): want[(c, max(t for k, t in want if k == c))] for c in {k for k, _ in want}}


def test_ranges_follow_the_rows_not_the_turns(spark):
    """20,000 messages a minute apart in epoch milliseconds: some ten ranges of about equal size."""
    from pyspark.sql import functions as F
    from capsight.operators import context as C
    rows = spark.range(20_000).select(F.lit(1).alias("conv_id"), (F.lit(1_704_067_200_000) + F.col("id") * 60_000).alias("turn"), F.lit("x").alias("text")).repartition(5)
    kept = []
    write, C.write_scratch = C.write_scratch, lambda df, name: kept.append(write(df, name)) or kept[-1]
    try:
        got = C.with_positions(rows, range_rows=2000)
        assert got.where("position <> (turn - 1704067200000) / 60000").count() == 0 and got.count() == 20_000
    finally:
        C.write_scratch = write
    sizes = [r["count"] for r in kept[0].groupBy("_range").count().collect()]
    assert 8 <= len(sizes) <= 10 and max(sizes) < 4000
