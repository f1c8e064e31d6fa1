"""F1-F5 on normalized rows built directly (as the reproduced tests do)."""
import json

from capsight.operators.handoff import render_handoff, with_handoff

SCHEMA = ("kind string, confidence double, summary string, ocr_text string, error boolean, "
          "key_fields struct<title:string,latest_time:string,amount:string,date:string,phone:string,email:string,url:string>, "
          "entities array<string>, ui_elements array<string>, risk_flags array<string>, table_preview array<string>, "
          "chart_signals array<string>, source struct<file_name:string,mime_type:string,size_bytes:bigint>")


def row(kind="photo_scene", confidence=0.5, ocr_text="", key_fields=None, entities=(), risk=(), preview=(),
        signals=(), file_name="a.png"):
    kf = {k: None for k in ("title", "latest_time", "amount", "date", "phone", "email", "url")}
    kf.update(key_fields or {})
    return (kind, confidence, "s", ocr_text, False, kf, list(entities), [], list(risk), list(preview), list(signals),
            {"file_name": file_name, "mime_type": "image/png", "size_bytes": 3})


def run(spark, *rows):
    return with_handoff(spark.createDataFrame(list(rows), SCHEMA)).collect()


def test_titles(spark):
    a, b, c = run(spark, row(key_fields={"title": "T", "amount": "9"}), row(kind="receipt_or_invoice", key_fields={"amount": "9"}),
                  row(file_name="x.png"))
    assert (a.title, b.title, c.title) == ("T", "receipt_or_invoice:9", "photo_scene:x.png")


def test_tags_order_and_dedupe(spark):
    r = run(spark, row(entities=["total", "total"], risk=["contains_email"], preview=["a: b"], signals=["metric:GMV"],
                       ocr_text="x"))[0]
    assert r.tags == ["kind:photo_scene", "entity:total", "risk:contains_email", "shape:table", "shape:chart", "has:ocr"]
    assert run(spark, row())[0].tags == ["kind:photo_scene"]


def test_save_hints(spark):
    rs = run(spark, row(kind="receipt_or_invoice", confidence=0.6), row(kind="document_scan", confidence=0.9),
             row(kind="chart_or_dashboard", confidence=0.1), row(kind="mixed_unknown", signals=["metric:GMV"]),
             row(kind="chat_screenshot", confidence=0.2), row(kind="photo_scene", confidence=0.3))
    assert [(r.save_target, r.save_confidence) for r in rs] == [
        ("knowledge", 0.70), ("knowledge", 0.90), ("knowledge", 0.72), ("knowledge", 0.72), ("memory", 0.68), ("none", 0.50)]


def test_render_handoff_round_trips(spark):
    df = with_handoff(spark.createDataFrame([row(kind="receipt_or_invoice", key_fields={"amount": "9"}, entities=["merchant"])],
                                            SCHEMA))
    text = df.select(render_handoff().alias("h")).collect()[0].h
    head, body = text.split("\n", 1)
    rec = json.loads(body)
    assert head == "[VisionHandoff]" and rec["schema"] == "capture/handoff@v1"
    assert rec["extracted"]["key_fields"] == {"amount": "9"} and rec["extracted"]["entities"] == ["merchant"]
    assert rec["save_hints"]["suggested_target"] == "knowledge" and rec["source"]["size_bytes"] == 3
