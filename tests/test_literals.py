"""Fixed values spelled out a second time, independent of the rule tables the engine and its oracles share."""
import pytest

from tests.conftest import analyze_rows, capture_rows

# FIXED VALUES: the words of the file-name rules and of the text signals, and what they lead to.
NAMES = {
    ("receipt_or_invoice", 0.82): ["receipt", "invoice", "发票", "小票", "账单"],
    ("chat_screenshot", 0.80): ["screenshot", "截图", "screen", "chat", "telegram", "whatsapp"],
    ("chart_or_dashboard", 0.78): ["chart", "dashboard", "图表", "报表", "panel"],
    ("document_scan", 0.76): ["scan", "document", "pdf", "doc", "文档", "扫描"],
}
TEXTS = {
    "n_receipt_words": ["合计", "实付", "应付", "金额", "税额", "invoice", "receipt", "tax", "subtotal", "total", "订单号", "商户", "收款"],
    "n_chart_words": ["同比", "环比", "增长", "下降", "趋势", "dashboard", "gmv", "dau", "mau", "ctr", "roi", "图表", "报表", "本周", "本月"],
    "n_chat_words": ["telegram", "whatsapp", "chatgpt", "message", "sender", "conversation info", "reply_to_current", "请输入消息", "发送", "对话", "消息"],
    "n_doc_words": ["文档", "说明", "指南", "报告", "协议", "notice"],
}
# --- end of fixed values


def test_every_name_word(spark):
    rows = [(kind, confidence, {"file_name": f"zz_{word.upper()}_1.png"}) for (kind, confidence), words in NAMES.items() for word in words]
    out = analyze_rows(spark, [r[2] for r in rows])
    assert [(out[i]["kind"], out[i]["confidence"]) for i in range(len(rows))] == [(k, c) for k, c, _ in rows]
    hinted = analyze_rows(spark, [{"file_name": "x.png", "hint": r[2]["file_name"]} for r in rows])
    assert [hinted[i]["kind"] for i in range(len(rows))] == [k for k, _, _ in rows]


@pytest.mark.parametrize("signal", sorted(TEXTS))
def test_every_text_word_counts_once(spark, signal):
    from capsight.operators.classify import classify
    from pyspark.sql import functions as F
    words = TEXTS[signal]
    rows = [{"file_name": "x.png", "ocr_text": w} for w in words]
    rows += [{"file_name": "x.png", "ocr_text": " ".join(words + words)}, {"file_name": "x.png", "ocr_text": "zzz"}]
    df = capture_rows(spark, rows).withColumn("ocr_warnings", F.array().cast("array<string>"))
    got = {r["capture_id"]: r[signal] for r in classify(df).select("capture_id", signal).collect()}
    for i, word in enumerate(words):
        assert got[i] == sum(other in word for other in words)
    assert got[len(words)] == len(words) and got[len(words) + 1] == 0


@pytest.mark.parametrize("text, kind", [
    ("subtotal", "receipt_or_invoice"), ("tax", "photo_scene"), ("gmv roi", "chart_or_dashboard"), ("gmv", "photo_scene"), ("12:30", "chat_screenshot"),
    ("发送 对话", "chat_screenshot"), ("Alice\nBob", "chat_screenshot"), ("1. 一\n2. 二", "document_scan")])
def test_text_thresholds(spark, text, kind):
    assert analyze_rows(spark, [{"file_name": "x.png", "ocr_text": text}])[0]["kind"] == kind
