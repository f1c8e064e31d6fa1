"""Listing by metadata, admission messages, unresolved requests, payloads, nested messages, sink."""
import json
import os
import re
import tempfile

from capsight.sources.listing import admit, image_listing, unresolved_requests
from capsight.sources.payloads import message_chunks, read_ocr_payloads


def test_listing_and_admission_on_files(spark):
    d = tempfile.mkdtemp(prefix="capsight-listing-")
    for name, size in (("a.png", 10), ("b.JPG", 5), ("empty.png", 0), ("notes.bin", 3)):
        with open(os.path.join(d, name), "wb") as f:
            f.write(b"x" * size)
    listing = image_listing(spark, d)
    rows = {r.file_name: r for r in admit(listing, max_image_bytes=8).collect()}
    assert set(rows) == {"a.png", "b.JPG", "notes.bin", "empty.png"}
    assert rows["empty.png"].message.startswith("Image file is empty (0 bytes): ") and rows["empty.png"].size_bytes == 0
    assert rows["a.png"].message == f"image too large: 10 bytes > 8"
    assert rows["b.JPG"].message is None and rows["b.JPG"].mime_type == "image/jpeg"
    assert rows["notes.bin"].message.startswith("unsupported image type: ")
    req = spark.createDataFrame([(os.path.join(d, "gone.png"),), (os.path.join(d, "a.png"),)], "file_path string")
    miss = unresolved_requests(req, listing).collect()
    assert [r.file_path for r in miss] == [os.path.join(d, "gone.png")]
    assert miss[0].message.startswith("file not found: ")


def test_listing_reads_no_content(spark):
    plan = image_listing(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[-1].split("\n")[0] if "ReadSchema" in plan else True


def test_ocr_payloads(spark):
    rows = [
        (1, json.dumps({"provider": "paddleocr", "text": "a\nb", "lines": [{"text": "a", "score": 0.9}, {"text": ""}, {"text": 5}, "s", {"text": " "}]})),
        (2, json.dumps({"text": 7, "lines": "nope"})),
        (3, "{not json"),
        (4, json.dumps({"provider": "", "text": "", "lines": [{"text": "x"}]})),
    ]
    df = spark.createDataFrame(rows, "id long, payload string")
    out = {r.id: r for r in read_ocr_payloads(df, default_provider="macos_vision").collect()}
    assert (out[1].provider, out[1].reported_provider) == ("macos_vision", "paddleocr") and out[1].text == "a\nb" and out[1].lines == ["a", " "]
    assert out[2].provider == "macos_vision" and out[2].text == "" and out[2].lines == []
    assert out[2].warnings == ["macOS Vision OCR returned no text"]
    assert out[3].warnings == ["macOS Vision OCR failed: invalid JSON payload"]
    assert out[4].provider == "macos_vision" and out[4].lines == ["x"] and out[4].warnings == []


def test_message_chunks_depth_limit(spark):
    # message object at depth 0, its members at depth 1: a leaf under 7 arrays is
    # at depth 8 (kept), under 8 arrays at depth 9 (dropped)
    deep = "leaf"
    for _ in range(8):
        deep = [deep]
    shallow = "ok"
    for _ in range(7):
        shallow = [shallow]
    msg = {"role": "user", "content": [{"type": "text", "text": "hi"}], "deep": deep, "shallow": shallow}
    df = spark.createDataFrame([(1, 0, json.dumps(msg))], "conv_id long, turn long, message string")
    texts = [r.text for r in message_chunks(df).orderBy("chunk_pos").collect()]
    assert "leaf" not in texts and "ok" in texts and "hi" in texts and "user" in texts


def test_write_results_skips_failures(spark):
    from pyspark.sql import functions as F
    from capsight.operators.analyze import run_analysis
    from capsight.operators.incremental import with_fingerprint
    from capsight.sources import fixtures as fx
    from capsight.sources.sinks import read_results, write_results
    an = run_analysis(with_fingerprint(fx.captures(spark, "/root/testdata/sf0.001")), None)
    path = os.path.join(tempfile.mkdtemp(prefix="capsight-results-"), "t")
    write_results(an, path, F.col("modified_ms"))
    back = read_results(spark, path)
    assert back.count() == an.where("NOT error").count() > 0
    assert set(back.columns) >= {"fingerprint", "schema_id", "analyzed_ms", "kind"}


def _rows(spark, names, kind="photo_scene"):
    return spark.createDataFrame([(n, kind, False, i) for i, n in enumerate(names)], "fingerprint string, kind string, error boolean, analyzed int")


def test_concurrent_writers_leave_one_row(spark, tmp_path):
    """Two writers that have not seen each other stage the same fingerprints; whatever the order of publishing, each stays once."""
    from pyspark.sql import functions as F
    from capsight.operators.incremental import to_store_rows
    from capsight.sources import sinks
    for turn in range(2):
        path = str(tmp_path / f"t{turn}")
        sinks.write_results(_rows(spark, "ab"), path, F.lit(1))
        base = [e["id"] for e in sinks.live_entries(sinks._published(spark, path))]
        staged = [sinks.stage_entry(to_store_rows(_rows(spark, names), F.lit(w + 2)), path, base) for w, names in enumerate(("cd", "de"))]
        for entry in staged[::-1] if turn else staged:
            sinks.publish(spark, path, entry)
        got = sorted((r.fingerprint, r.analyzed_ms) for r in sinks.read_results(spark, path).collect())
        assert got == [("a", 1), ("b", 1), ("c", 2), ("d", 2), ("e", 3)]  # d: the earlier entry's
        sinks.write_results(_rows(spark, "abcdef"), path, F.lit(9))
        assert sorted(r.fingerprint for r in sinks.read_results(spark, path).collect()) == list("abcdef")


def test_a_write_that_stops_leaves_nothing(spark, tmp_path):
    from pyspark.sql import functions as F
    from capsight.operators.incremental import to_store_rows
    from capsight.sources import sinks
    path = str(tmp_path / "t")
    sinks.write_results(_rows(spark, "ab"), path, F.lit(1))
    assert sinks.stage_entry(to_store_rows(_rows(spark, "xyz"), F.lit(2)), path, []) is not None  # never published
    assert sorted(r.fingerprint for r in sinks.read_results(spark, path).collect()) == ["a", "b"]
    assert sinks.existing_results(spark, str(tmp_path / "none")) is None
    sinks.write_results(_rows(spark, "ab"), path, F.lit(3))  # nothing new: no entry
    assert len(sinks._published(spark, path)) == 1


def test_compaction_removes_what_retention_drops(spark, tmp_path):
    import glob
    from pyspark.sql import functions as F
    from capsight.operators.incremental import to_store_rows
    from capsight.sources import sinks
    path = str(tmp_path / "t")
    for k, names in enumerate(("abc", "de", "fgh")):
        sinks.write_results(_rows(spark, names, ("photo_scene", "chart_or_dashboard")[k % 2]), path, F.lit(k))
    base = [e["id"] for e in sinks.live_entries(sinks._published(spark, path))]
    late = sinks.stage_entry(to_store_rows(_rows(spark, "hz"), F.lit(7)), path, base[:2])  # had not seen the third write
    out = sinks.compact_results(spark, path, 4)
    assert sorted(r.fingerprint for r in out.collect()) == ["d", "f", "g", "h"]
    assert len(glob.glob(f"{path}/entry=*")) == 2 and len(glob.glob(f"{path}/_log/*")) == 1  # the compacted one, and the late writer's
    sinks.publish(spark, path, late)
    assert sorted(r.fingerprint for r in sinks.read_results(spark, path).collect()) == ["d", "f", "g", "h", "z"]
    assert sorted(r.fingerprint for r in sinks.compact_results(spark, path).collect()) == ["d", "f", "g", "h", "z"]
    assert len(glob.glob(f"{path}/entry=*")) == 1


def test_of_two_compactions_the_earlier_counts():
    from capsight.sources.sinks import live_entries, unseen
    e = lambda i, base="", replaces="": {"id": i, "base": set(base), "replaces": set(replaces)}
    log = [e("1"), e("2", "1"), e("3", "12", "12"), e("4", "12", "12"), e("5", "12"), e("6", "3")]
    live = live_entries(log)
    assert [x["id"] for x in live] == ["3", "5", "6"]
    assert [unseen(x, live) for x in live] == [[], [], ["5"]]


def _values(node, depth, out):
    """String leaves as ``Object.values`` walks them."""
    if isinstance(node, str):
        out.append(node)
    elif isinstance(node, (list, dict)) and depth < 8:
        children = node
        if isinstance(node, dict):
            index = sorted((k for k in node if re.fullmatch("0|[1-9][0-9]{0,9}", k) and int(k) < 2 ** 32 - 1), key=int)
            children = [node[k] for k in index] + [v for k, v in node.items() if k not in index]
        for child in children:
            _values(child, depth + 1, out)
    return out


def test_leaves_come_in_document_order(spark):
    texts = ['{"z":"1","a":{"y":["2",{"q":"3","b":"4"}],"c":"5"},"10":"i10","9":"i9","b":"6","a":"last"}', '["x",{"n":7,"m":"y","n":"z"},null,true,["w"]]', '"alone"',
             '{"4294967295":"big","4294967294":"index","007":"no","-1":"neg","k\\"ey":"quoted","e":"{\\"not\\":\\"walked\\"}"}', "{}", "[]", '{"a":{"a":{"a":{"a":{"a":{"a":{"a":"d7","b":["d8"]}}}}}}}']
    df = spark.createDataFrame([(i, 0, t) for i, t in enumerate(texts)], "conv_id long, turn long, message string")
    got = {i: [] for i in range(len(texts))}
    for r in message_chunks(df).orderBy("conv_id", "chunk_pos").collect():
        got[r.conv_id].append(r.text)
    assert got == {i: _values(json.loads(t), 0, []) for i, t in enumerate(texts)}


def test_the_last_of_equal_keys_counts_in_payloads(spark):
    df = spark.createDataFrame([(1, '{"text":"first","provider":"p","text":"last","lines":[{"text":"a","text":"b"}],"provider":"q"}')], "id long, payload string")
    r = read_ocr_payloads(df).first()
    assert (r.text, r.lines, r.reported_provider, r.warnings) == ("last", ["b"], "q", [])
