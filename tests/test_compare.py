"""G1-G5 on small hand-made groups, and hot groups with ties and gaps against brute force."""
from capsight.operators.compare import compare_groups, compared_members, render_compare, with_member_lists
from tests.conftest import capture_rows


def handoffs(spark, rows):
    from capsight.operators.analyze import analyze
    from capsight.operators.handoff import with_handoff
    return with_handoff(analyze(capture_rows(spark, rows)))


def whole(df):
    """Comparisons with their members' lists."""
    return with_member_lists(compare_groups(df), compared_members(df))


def test_same_kind_group_shares_entities_and_tags(spark):
    df = handoffs(spark, [
        {"file_name": "r1.png", "group_id": 1, "pos": 0, "ocr_text": "合计 10\n实付 10"},
        {"file_name": "r2.png", "group_id": 1, "pos": 1, "ocr_text": "合计 20\n实付 20"},
        {"file_name": "solo.png", "group_id": 2, "pos": 0},
    ])
    out = whole(df).collect()
    assert len(out) == 1  # a group of one is not a comparison
    g = out[0]
    assert g.summary == "Compared 2 images of the same kind: receipt_or_invoice."
    assert g.same_kind and g.kinds == ["receipt_or_invoice"]
    assert g.shared_entities == ["merchant", "total", "date"]
    assert g.similarities[0] == "all images classified as receipt_or_invoice"
    assert g.differences == ["titles differ: receipt_or_invoice:10 vs receipt_or_invoice:20"]
    assert g.save_recommendation == "knowledge"
    assert [tuple(x) for x in g.compared] == [("r1.png", "receipt_or_invoice", "receipt_or_invoice:10"),
                                              ("r2.png", "receipt_or_invoice", "receipt_or_invoice:20")]


def test_mixed_group_differences_and_recommendation(spark):
    df = handoffs(spark, [
        {"file_name": "chat.png", "group_id": 7, "pos": 1, "ocr_text": "Alice\nBob"},
        {"file_name": "IMG.png", "group_id": 7, "pos": 0},
    ])
    g = whole(df).collect()[0]
    assert g.kinds == ["photo_scene", "chat_screenshot"]
    assert g.summary == "Compared 2 images across kinds: photo_scene, chat_screenshot."
    assert g.differences[0] == "kind mismatch: photo_scene vs chat_screenshot"
    assert g.differences[2] == "save targets differ: none vs memory"
    assert g.save_recommendation == "memory"
    block = whole(df).select(render_compare().alias("b")).collect()[0].b
    assert block.split("\n")[2] == "SameKind: false"


def test_all_failed_group(spark):
    from capsight.operators.analyze import analyze
    from capsight.operators.handoff import with_handoff
    from capsight.sources.listing import admit
    caps = capture_rows(spark, [{"file_name": "a.bin", "group_id": 3, "pos": 0},
                                {"file_name": "b.bin", "group_id": 3, "pos": 1}])
    g = whole(with_handoff(analyze(admit(caps)))).collect()[0]
    assert g.same_kind and g.kinds == ["mixed_unknown"] and g.save_recommendation == "none"
    assert [tuple(x) for x in g.compared] == [("", "mixed_unknown", "")] * 2 and g.differences == []


def test_tied_positions_count_every_member(spark):
    """A group with one position for all: facts do not depend on it, nothing is collected for them."""
    from pyspark.sql import functions as F
    rows = spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") + 10).alias("group_id"), F.lit(0).alias("pos"), F.lit("photo_scene").alias("kind"),
        F.concat(F.lit("t"), F.col("id").cast("string")).alias("title"), F.lit("none").alias("save_target"), F.lit("f").alias("file_name"),
        F.array(F.lit("both"), F.concat(F.lit("e"), F.col("id").cast("string"))).alias("entities"), F.array(F.lit("x")).alias("tags"))
    out = compare_groups(rows.repartition(6)).collect()
    assert len(out) == 1 and out[0].n_members == 20_000
    assert out[0].shared_entities == ["both"] and out[0].shared_tags == ["x"] and out[0].differs_in == ["title"]


def test_facts_collect_no_member(spark):
    from capsight.plans.queries import analysis_job
    plan = compare_groups(analysis_job(spark, "/root/testdata/sf0.001"))._jdf.queryExecution().optimizedPlan().toString()
    assert "file_name" not in plan.split("Generate")[0]


def _brute_force(members):
    """Plain restatement of the comparison for one group (members sorted by pos)."""
    kinds = [m["kind"] for m in members]
    uniq_kinds = list(dict.fromkeys(kinds))
    same = len(uniq_kinds) == 1

    def inter(key):
        first = list(dict.fromkeys(members[0][key]))
        return [v for v in first if all(v in m[key] for m in members)]

    diffs = []
    if not same:
        diffs.append("kind mismatch: " + " vs ".join(kinds))
    titles = [m["title"] for m in members]
    if len(set(titles)) > 1:
        diffs.append("titles differ: " + " vs ".join(titles))
    targets = [m["save_target"] for m in members]
    if len(set(targets)) > 1:
        diffs.append("save targets differ: " + " vs ".join(targets))
    rec = "knowledge" if "knowledge" in targets else "memory" if "memory" in targets else "none"
    return (len(members), same, uniq_kinds, inter("entities"), inter("tags"), diffs, rec,
            [(m["file_name"], m["kind"], m["title"]) for m in members])


def test_hot_group_matches_brute_force(spark):
    """A third of all captures in one group, with sparse positions."""
    from pyspark.sql import functions as F
    from capsight.plans.queries import analysis_job
    an = analysis_job(spark, "/root/testdata/sf0.01")
    hot = an.withColumn("group_id", F.when(F.col("capture_id") % 3 == 0, F.lit(-7)).otherwise(F.col("group_id"))) \
            .withColumn("pos", F.when(F.col("capture_id") % 3 == 0, F.col("capture_id").cast("int")).otherwise(F.col("pos")))
    got = {r.group_id: r for r in whole(hot).collect()}
    rows = hot.select("group_id", "pos", "kind", "title", "save_target", F.col("source.file_name").alias("file_name"),
                      "entities", "tags").collect()
    groups = {}
    for r in rows:
        groups.setdefault(r.group_id, []).append(r.asDict())
    want = {g: _brute_force(sorted(ms, key=lambda m: m["pos"])) for g, ms in groups.items() if len(ms) >= 2}
    assert set(got) == set(want) and len(groups[-7]) > 300
    for g, w in want.items():
        r = got[g]
        assert (r.n_members, r.same_kind, r.kinds, r.shared_entities, r.shared_tags, r.differences,
                r.save_recommendation, [tuple(x) for x in r.compared]) == w, g


def test_lines_join_to_the_block(spark):
    """Pieces of groups in ranges smaller than a group, with ties in ``pos``, make up the block of ``render_compare``."""
    from pyspark.sql import functions as F
    from capsight.operators.compare import compare_lines
    names = ["receipt_{}.png", "chart_{}.png", "img_{}.png", "scan_{}.pdf.png"]
    df = handoffs(spark, [{"file_name": names[i % 4].format(i), "group_id": g, "pos": i // 2, "ocr_text": f"合计 {i % 5}\n实付 {i % 5}" if i % 3 else ""}
                          for g, n in ((1, 90), (2, 3), (3, 2), (4, 1)) for i in range(n)] +
                  [{"file_name": "same.png", "group_id": 5, "pos": 0} for _ in range(4)]).repartition(5)
    compared, listed = compare_groups(df), compared_members(df)
    want = {r.group_id: r.b for r in with_member_lists(compared, listed).select("group_id", render_compare().alias("b")).collect()}
    rows = compare_lines(compared, listed, range_rows=20).collect()
    got, numbers = {}, {}
    for r in sorted(rows, key=lambda r: (r.group_id, r.line_no, r.piece_no)):
        got.setdefault(r.group_id, {}).setdefault(r.line_no, []).append(r.piece)
        numbers.setdefault((r.group_id, r.line_no), []).append(r.piece_no)
    assert {g: "\n".join("".join(p) for _, p in sorted(lines.items())) for g, lines in got.items()} == want and set(want) == {1, 2, 3, 5}
    assert all(n == list(range(len(n))) for n in numbers.values())


def test_similar_classes_equal_member_pairs(spark):
    import random
    from capsight.operators.compare import similar_classes
    rng = random.Random(3)
    rows = [(i % 4, rng.sample("abcdef", rng.randrange(5)) + ["a"] * (i % 2)) for i in range(120)] + [(9, None), (9, []), (8, ["x"])]
    out = similar_classes(spark.createDataFrame(rows, "group_id long, tags array<string>")).collect()
    assert sum(r.n_members for r in out) == len(rows)
    for r in out:
        mine, others = set(r.tags), [set(t or []) for g, t in rows if g == r.group_id]
        score = lambda t: len(mine & t) / len(mine | t) if mine | t else 0.0
        assert r.n_members == others.count(mine) and r.n_linked == sum(score(t) >= 0.5 for t in others) - (score(mine) >= 0.5)
        near = sorted((-score(t), sorted(t)) for t in others if t != mine and mine & t)
        assert (r.best_tags, r.best_similarity) == ((near[0][1], -near[0][0]) if near else (None, None))
