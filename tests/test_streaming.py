"""Streams equal the batch jobs."""
from capsight.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_stream_analyze_equals_batch(spark):
    from capsight.plans.queries import analyzed, flat_analysis
    assert rows(QUERIES["j1_stream_analyze"](spark, SF)) == rows(flat_analysis(analyzed(spark, SF)))


def test_stream_dedupe_analyses_each_fingerprint_once(spark):
    out = QUERIES["j2_stream_dedupe"](spark, SF)
    assert out.count() == out.select("fingerprint").distinct().count() == 200


def test_stream_context_equals_latest_batch_view(spark):
    a = rows(QUERIES["j3_stream_context"](spark, SF).select("conv_id", "media_pos", "file_path"))
    b = rows(QUERIES["h1_recent_media"](spark, SF).select("conv_id", "media_pos", "file_path"))
    assert a == b and len(a) > 0


def test_stream_context_state_carries_across_batches(spark):
    import os
    import tempfile
    from pyspark.sql import functions as F
    from capsight.sources import fixtures as fx
    from capsight.streaming.jobs import latest_context, run_available_now, stream_context
    conv = fx.table(spark, SF, "conversations")
    d = tempfile.mkdtemp(prefix="capsight-stream-")
    conv.where(F.col("turn") < 3).coalesce(1).write.parquet(os.path.join(d, "part=0"))
    conv.where(F.col("turn") >= 3).coalesce(1).write.parquet(os.path.join(d, "part=1"))
    stream = (spark.readStream.schema(conv.schema).option("maxFilesPerTrigger", 1)
              .option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").parquet(d))
    out = run_available_now(stream_context(fx.messages_from(stream)), "context-batches")
    emitted = spark.read.parquet(out)
    assert emitted.select("seq").distinct().count() > 1  # conversations were updated more than once
    a = rows(latest_context(emitted).select("conv_id", "media_pos", "file_path"))
    b = rows(QUERIES["h1_recent_media"](spark, SF).select("conv_id", "media_pos", "file_path"))
    assert a == b


def test_old_file_times_are_not_lost(spark):
    """Distinct captures in several batches, one with a year-old time, all come out; copies once."""
    from capsight.streaming.jobs import arriving, dedupe_available_now
    from tests.conftest import capture_rows
    caps = capture_rows(spark, [{"file_name": f"p{i}.png", "modified_ms": 1_700_000_000_000 - i * 10 ** 10} for i in range(9)])
    twice = caps.unionByName(caps)
    out = spark.read.parquet(dedupe_available_now(arriving(twice, "old", 4), "old"))
    assert sorted(r.file_name for r in out.collect()) == [f"p{i}.png" for i in range(9)]


def test_window_that_scrolls_out_is_empty(spark):
    """A media message, then nine plain ones in later batches: nothing is current."""
    import os
    import tempfile
    from capsight.streaming.jobs import latest_context, run_available_now, stream_context
    schema = "conv_id long, turn long, role string, text string"
    d = tempfile.mkdtemp(prefix="capsight-stream-")
    batches = [[(1, 0, "u", "[media attached: /old.png | x]")], [(1, t, "u", "plain") for t in range(1, 6)], [(1, t, "u", "plain") for t in range(6, 10)]]
    for k, rows_ in enumerate(batches):
        spark.createDataFrame(rows_, schema).coalesce(1).write.parquet(os.path.join(d, f"part={k}"))
    stream = (spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").parquet(d))
    emitted = spark.read.parquet(run_available_now(stream_context(stream), "scrolled"))
    assert emitted.count() >= 2 and latest_context(emitted).count() == 0


def _add(folder, k, rows_df):
    rows_df.coalesce(1).write.mode("append").parquet(f"{folder}/part={k}")


def _source(spark, folder, like):
    return (spark.readStream.schema(like.schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true")
            .option("pathGlobFilter", "*.parquet").parquet(folder))


def test_dedupe_resumes_under_its_name(spark, tmp_path):
    """Stopped after two batches, failed once in the third, run again: each fingerprint once, none analysed twice."""
    import pytest
    from pyspark.sql import functions as F
    from capsight.streaming.jobs import dedupe_available_now
    from tests.conftest import capture_rows
    caps = capture_rows(spark, [{"file_name": f"p{i}.png"} for i in range(12)])
    src, seen = str(tmp_path / "in"), spark.sparkContext.accumulator(0)
    broken = [False]

    def analysed(rows):
        def mark(batches):
            for pdf in batches:
                if broken[0]:
                    raise RuntimeError("stopped")
                seen.add(len(pdf))
                yield pdf
        return rows.mapInPandas(mark, rows.schema)

    _add(src, 0, caps.where("capture_id < 6"))
    _add(src, 1, caps.where("capture_id between 3 and 8"))
    name = str(tmp_path / "run")
    assert spark.read.parquet(dedupe_available_now(_source(spark, src, caps), name, analysed)).count() == 9 and seen.value == 9
    _add(src, 2, caps)
    broken[0] = True
    with pytest.raises(Exception):
        dedupe_available_now(_source(spark, src, caps), name, analysed)
    broken[0] = False
    out = spark.read.parquet(dedupe_available_now(_source(spark, src, caps), name, analysed))
    assert sorted(r.file_name for r in out.collect()) == sorted(f"p{i}.png" for i in range(12)) and seen.value == 12
    assert out.select("fingerprint").distinct().count() == 12
    assert spark.read.parquet(dedupe_available_now(_source(spark, src, caps), name, analysed)).count() == 12  # nothing new: nothing happens


def test_analysis_and_context_streams_resume(spark, tmp_path):
    from pyspark.sql import functions as F
    from capsight.sources import fixtures as fx
    from capsight.streaming.jobs import latest_context, run_available_now, stream_analyze, stream_context
    msgs = fx.messages(spark, SF)
    src, name = str(tmp_path / "in"), str(tmp_path / "run")
    _add(src, 0, msgs.where("turn < 2"))
    run_available_now(stream_context(_source(spark, src, msgs)), name)
    _add(src, 1, msgs.where("turn >= 2"))
    emitted = spark.read.parquet(run_available_now(stream_context(_source(spark, src, msgs)), name))
    assert rows(latest_context(emitted).select("conv_id", "media_pos", "file_path")) == rows(QUERIES["h1_recent_media"](spark, SF).select("conv_id", "media_pos", "file_path"))
    assert emitted.agg(F.sum("seq")).first()[0] > msgs.count()  # the second run went on from the first one's counts
    caps = fx.with_ocr(fx.captures(spark, SF))
    src, name = str(tmp_path / "in2"), str(tmp_path / "run2")
    for k in range(2):
        _add(src, k, caps.where(F.col("capture_id") % 2 == k))
        out = run_available_now(stream_analyze(_source(spark, src, caps)), name)
    assert spark.read.parquet(out).count() == 200


def test_ties_are_ordered_alike_in_batch_and_stream(spark):
    from capsight.operators.context import recent_media
    from capsight.streaming.jobs import arriving, latest_context, run_available_now, stream_context
    marks = ["[media attached: /{}.png | x]".format(c) for c in "fabcdeg"]
    df = spark.createDataFrame([(1, 5, "u", m) for m in marks] + [(1, 5, "u", None), (1, 5, "u", "plain"), (1, 5, "u", "zz")], "conv_id long, turn long, role string, text string")
    want = rows(recent_media(df, 4, 4).select("conv_id", "media_pos", "file_path"))
    assert [r[2] for r in want] == ["/f.png", "/g.png"]  # the last four by text: f, g, plain, zz
    for k in range(2):
        emitted = spark.read.parquet(run_available_now(stream_context(arriving(df, f"ties{k}", 3 + k), 4, 4), f"ties{k}"))
        assert rows(latest_context(emitted).select("conv_id", "media_pos", "file_path")) == want


def test_stream_reads_a_table_of_part_files(spark, tmp_path):
    """J1 on ``documents.parquet`` as a folder of part files, beside another table: each document once."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(40)
    docs.repartition(3, "doc_id").write.parquet(str(tmp_path / "documents.parquet"))
    spark.range(3).write.parquet(str(tmp_path / "labels.parquet"))
    out = QUERIES["j1_stream_analyze"](spark, str(tmp_path))
    assert sorted(r.capture_id for r in out.select("capture_id").collect()) == sorted(r.doc_id for r in docs.collect())
