"""C1-C5 on hand-made captures (cases restated from the reproduced rules)."""
import pytest
from pyspark.sql import functions as F

from capsight.operators.classify import infer_mime
from tests.conftest import analyze_rows


@pytest.mark.parametrize("path,mime", [
    ("a.PNG", "image/png"), ("a.jpg", "image/jpeg"), ("a.jpeg", "image/jpeg"), ("a.webp", "image/webp"),
    ("a.gif", "image/gif"), ("a.heic", "image/heic"), ("a.HEIF", "image/heic"), ("a.bmp", "image/bmp"),
    ("a.tif", "image/tiff"), ("a.tiff", "image/tiff"), ("a.avif", "image/avif"), ("a.svg", "image/svg+xml"),
    ("a.pdf", "application/octet-stream"), ("png", "application/octet-stream"),
])
def test_infer_mime(spark, path, mime):
    got = spark.createDataFrame([(path,)], "p string").select(infer_mime(F.col("p")).alias("m")).collect()[0].m
    assert got == mime


def test_name_rules_first_hit_wins(spark):
    out = analyze_rows(spark, [
        {"file_name": "receipt_screenshot.png"},
        {"file_name": "chat.png"},
        {"file_name": "dashboard.png"},
        {"file_name": "scan.png"},
        {"file_name": "IMG_1.png"},
        {"file_name": "x.png", "hint": "this is a 发票"},
    ])
    assert [out[i]["kind"] for i in range(6)] == [
        "receipt_or_invoice", "chat_screenshot", "chart_or_dashboard", "document_scan", "photo_scene",
        "receipt_or_invoice"]
    assert [out[i]["confidence"] for i in range(5)] == [0.82, 0.80, 0.78, 0.76, 0.52]


def test_non_image_type_is_mixed_unknown(spark):
    out = analyze_rows(spark, [{"file_name": "notes.bin"}])
    assert out[0]["kind"] == "mixed_unknown" and out[0]["confidence"] == 0.30
    assert out[0]["reasons"] == ["no strong heuristic match"]


def test_text_refines_kind_and_keeps_both_reasons(spark):
    out = analyze_rows(spark, [{"file_name": "IMG_2.png", "ocr_text": "合计 100\n实付 100"}])
    r = out[0]
    assert r["kind"] == "receipt_or_invoice" and r["confidence"] == 0.88
    assert r["reasons"] == ["generic image mime type", "ocr matched receipt or invoice fields"]


def test_same_kind_is_capped_at_098(spark):
    out = analyze_rows(spark, [{"file_name": "receipt.png", "ocr_text": "invoice total 5"}])
    assert out[0]["kind"] == "receipt_or_invoice" and out[0]["confidence"] == 0.88
    out = analyze_rows(spark, [{"file_name": "receipt.png", "hint": "", "ocr_text": "total tax"}])
    assert out[0]["confidence"] <= 0.98


def test_clock_line_makes_chat_before_chart(spark):
    out = analyze_rows(spark, [{"file_name": "chart.png", "ocr_text": "GMV 12%\nROI 3\n09:15"}])
    assert out[0]["kind"] == "chat_screenshot"


def test_blank_text_keeps_name_result(spark):
    out = analyze_rows(spark, [{"file_name": "scan.png", "ocr_text": "  \n　 "}])
    assert out[0]["kind"] == "document_scan" and out[0]["reasons"] == ["matched document keywords"]


def test_substring_keywords_not_words(spark):
    # "subtotal" hits both subtotal and total: two receipt keywords.
    out = analyze_rows(spark, [{"file_name": "IMG.png", "ocr_text": "subtotal 5"}])
    assert out[0]["kind"] == "receipt_or_invoice"


def test_document_heading_and_numbered_lists(spark):
    out = analyze_rows(spark, [
        {"file_name": "IMG.png", "ocr_text": "第一章 Introduction"},
        {"file_name": "IMG.png", "ocr_text": "1. one\n2) two"},
        {"file_name": "IMG.png", "ocr_text": "1. one"},
    ])
    assert out[0]["kind"] == "document_scan" and out[1]["kind"] == "document_scan"
    assert out[2]["kind"] == "photo_scene"
