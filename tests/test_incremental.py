"""I1-I3 and K1-K2."""
from pyspark.sql import functions as F

from capsight.operators.incremental import analyze_incremental, fingerprint, retain_newest, to_store_rows
from capsight.operators.reports import kind_report, tag_report
from tests.conftest import capture_rows


def test_fingerprint_changes_with_options(spark):
    df = capture_rows(spark, [{"file_name": "a.png"}])
    c = F.col
    base = fingerprint(c("file_path"), c("size_bytes"), c("modified_ms"), c("hint"))
    other = fingerprint(c("file_path"), c("size_bytes"), c("modified_ms"), c("hint"), max_summary_chars=10)
    r = df.select(base.alias("a"), other.alias("b")).collect()[0]
    assert r.a != r.b and len(r.a) == 40


def test_incremental_analyses_only_new_and_retries_failures(spark):
    caps = capture_rows(spark, [{"file_name": "a.png", "ocr_text": "x"}, {"file_name": "b.png"},
                                {"file_name": "bad.bin"}])
    first, new = analyze_incremental(caps, None, None)
    store = to_store_rows(new, F.lit(1))
    assert store.count() == 2  # the failure is not stored
    again, new2 = analyze_incremental(caps, None, store)
    flags = {r.file_name: r.from_store for r in again.select("file_name", "from_store").collect()}
    assert flags == {"a.png": True, "b.png": True, "bad.bin": False}
    assert new2.count() == 0


def test_requests_with_one_fingerprint_all_get_a_row(spark):
    caps = capture_rows(spark, [{"file_name": "a.png", "modified_ms": 5}, {"file_name": "a.png", "modified_ms": 5}])
    res, new = analyze_incremental(caps, None, None)
    assert sorted(r.capture_id for r in res.collect()) == [0, 1] and new.count() == 1
    again, none = analyze_incremental(caps, None, to_store_rows(new, F.lit(1)))
    assert {(r.capture_id, r.from_store) for r in again.collect()} == {(0, True), (1, True)} and none.count() == 0


def test_retain_newest(spark):
    rows = [(f"f{i}", i) for i in range(100)] + [("a_tie", 99)]
    store = spark.createDataFrame(rows, "fingerprint string, analyzed_ms long")
    kept = [r.fingerprint for r in retain_newest(store, 3).collect()]
    assert kept == ["a_tie", "f99", "f98"]


def test_reports(spark):
    from capsight.plans.queries import analysis_job
    an = analysis_job(spark, "/root/testdata/sf0.001")
    k = kind_report(an).collect()
    total = [r for r in k if r.kind is None and r.save_target is None][0]
    assert total.n_captures == an.count() and total.level == 3
    t = {(r.dimension, r.value): r.n_captures for r in tag_report(an).collect()}
    assert t[("tag", "has:ocr")] > 0


def test_fingerprint_tracks_mtime_and_hint(spark):
    df = capture_rows(spark, [{"file_name": "a.png", "modified_ms": 1}, {"file_name": "a.png", "modified_ms": 2001},
                              {"file_name": "a.png", "modified_ms": 1, "hint": "auto_inbound_context"}])
    c = F.col
    fps = [r.f for r in df.select(fingerprint(c("file_path"), c("size_bytes"), c("modified_ms"), c("hint")).alias("f")).collect()]
    assert len(set(fps)) == 3
