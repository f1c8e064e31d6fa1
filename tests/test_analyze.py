"""E1-E3, F1-F5 and admission (A2) on hand-made rows."""

from capsight.operators.analyze import analyze, render_block
from capsight.operators.handoff import render_handoff, with_handoff
from capsight.sources.listing import admit
from tests.conftest import analyze_rows, capture_rows


def test_summary_notes_characters_and_respects_limit(spark):
    out = analyze_rows(spark, [{"file_name": "IMG.png", "ocr_text": "  hello  "}], max_summary_chars=4000)
    assert out[0]["summary"].endswith(" OCR extracted 5 characters.")
    assert out[0]["ocr_text"] == "hello"
    out = analyze_rows(spark, [{"file_name": "IMG.png", "ocr_text": "hello"}], max_summary_chars=20)
    assert out[0]["summary"] == "Image IMG.png app..." and len(out[0]["summary"]) == 20


def test_cut_counts_code_points(spark):
    out = analyze_rows(spark, [{"file_name": "😀😀😀😀😀😀😀😀.png"}], max_summary_chars=10)
    assert out[0]["summary"] == "Image 😀..."


def test_disabled_vision(spark):
    out = analyze_rows(spark, [{"file_name": "receipt.png", "ocr_text": "total 5"}], vision="disabled")
    r = out[0]
    assert r["summary"].startswith("Vision provider is disabled. File receipt.png was classified as receipt_or_invoice.")
    assert r["entities"] == [] and r["warnings"] == ["Vision provider is disabled"]


def test_handoff_title_tags_and_save_hints(spark):
    out = analyze_rows(spark, [
        {"file_name": "IMG.png", "ocr_text": "合计 12.50\n实付 12.50"},
        {"file_name": "scan.png", "ocr_text": "第一章 Start"},
        {"file_name": "IMG.png", "ocr_text": "GMV 5%\nROI 2"},
        {"file_name": "chat.png", "ocr_text": "Alice\nBob"},
        {"file_name": "IMG.png"},
    ])
    assert out[0]["title"] == "receipt_or_invoice:12.50" and out[0]["save_target"] == "knowledge"
    assert out[1]["title"] == "第一章 Start" and out[1]["save_confidence"] == 0.80
    assert out[2]["save_target"] == "knowledge" and "shape:chart" in out[2]["tags"]
    assert out[3]["save_target"] == "memory" and out[3]["save_confidence"] == 0.86
    assert out[4]["title"] == "photo_scene:IMG.png" and out[4]["tags"] == ["kind:photo_scene"]
    assert out[4]["save_target"] == "none" and out[4]["save_confidence"] == 0.52


def test_render_block(spark):
    df = with_handoff(analyze(capture_rows(spark, [{"file_name": "IMG.png", "ocr_text": "合计 12.50 实付 12.50"}])))
    block = df.select(render_block().alias("b")).collect()[0].b
    lines = block.split("\n")
    assert lines[0] == "[Image]" and lines[1] == "Kind: receipt_or_invoice"
    assert lines[6] == "KeyFields: amount=12.50" and lines[13] == "Confidence: 0.88"
    assert len(lines) == 14
    hand = df.select(render_handoff().alias("h")).collect()[0].h
    assert hand.startswith("[VisionHandoff]\n{\"schema\":\"capture/handoff@v1\"")


def test_admission_rules_and_failure_shape(spark):
    caps = capture_rows(spark, [
        {"file_name": "empty.png", "size_bytes": 0},
        {"file_name": "big.png", "size_bytes": 20_000_000},
        {"file_name": "doc.pdf"},
        {"file_name": "ok.png", "ocr_text": "hello"},
    ])
    adm = admit(caps).select("capture_id", "message").collect()
    msgs = {r.capture_id: r.message for r in adm}
    assert msgs[0] == "Image file is empty (0 bytes): /img/empty.png"
    assert msgs[1] == "image too large: 20000000 bytes > 15728640"
    assert msgs[2] == "unsupported image type: /img/doc.pdf"
    assert msgs[3] is None
    an = {r.capture_id: r for r in with_handoff(analyze(admit(caps))).collect()}
    f = an[0]
    assert f.error and f.kind == "mixed_unknown" and f.confidence == 0.0 and f.summary == ""
    assert f.warnings == [msgs[0]] and f.title == "" and f.tags == [] and f.save_target == "none"
    assert f.source.file_name == "" and f.source.size_bytes == 0
    assert not an[3].error


def test_analysis_is_one_narrow_stage(spark):
    df = with_handoff(analyze(capture_rows(spark, [{"file_name": "a.png"}])))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_minimal_input_columns(spark):
    df = spark.createDataFrame([("a.png", 10, "合计 1\n实付 1")], "file_name string, size_bytes long, ocr_text string")
    r = with_handoff(analyze(df)).collect()[0]
    assert r.kind == "receipt_or_invoice" and r.source.mime_type == "image/png"
