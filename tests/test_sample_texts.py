"""A dashboard, a price list and two groups with a fixed classification, spelled out by hand."""
from pyspark.sql import functions as F

from capsight.operators.extract import extraction_columns

CHART = "ROI 7.1\nGMV 88.2\n转化 3.5%\n本周 环比增长 9%\nQ3 Q4"
TABLE = "品名  件数  金额\n铅笔  3  6.50\n本子  2  14.00\n合计  20.50"


def run(spark, kind, reason, file_name, text):
    df = spark.createDataFrame([(kind, [reason], file_name, text, text.split("\n"))],
                               "kind string, reasons array<string>, file_name string, text string, lines array<string>")
    cols = extraction_columns(F.col("kind"), F.col("reasons"), F.col("file_name"), F.col("text"), F.col("lines"))
    return df.select(*[v.alias(k) for k, v in cols.items()]).collect()[0].asDict(recursive=True)


def test_chart_sample(spark):
    r = run(spark, "chart_or_dashboard", "own chart", "weekly.png", CHART)
    assert r["entities"] == ["metric", "trend", "series", "trend_indicator", "business_metric"]
    assert r["ui_elements"] == ["header", "chart_area", "legend"]
    assert r["risk_flags"] == [] and all(v is None for v in r["key_fields"].values())
    assert r["chart_hints"] == ["trend_chart_candidate", "contains_rate_or_growth_signal", "contains_business_metrics"]
    assert r["table_preview"] == ["ROI 7.1", "GMV 88.2", "Q3 Q4"]
    # 本周 at the start of a line has no ASCII word character beside it: not a period
    assert r["chart_signals"] == ["metric:ROI", "metric:GMV", "percent:3.5%", "percent:9%", "period:Q3", "period:Q4"]
    assert r["vision_summary"] == ("Image weekly.png appears to be chart_or_dashboard based on own chart. "
                                   "OCR suggests: ROI 7.1 GMV 88.2 转化 3.5% 本周 环比增长 9% Q3 Q4")


def test_table_sample(spark):
    r = run(spark, "receipt_or_invoice", "own table", "shop.png", TABLE)
    assert r["entities"] == ["merchant", "total", "date"]
    assert r["risk_flags"] == ["contains_financial_fields"]
    assert r["key_fields"]["amount"] == "20.50" and r["key_fields"]["date"] is None
    assert r["layout_hints"] == ["header", "line_items", "summary_footer"]
    assert r["table_hints"] == ["possible_line_items", "possible_totals_block"]
    assert r["table_preview"] == TABLE.split("\n")


def test_compare_samples(spark):
    from capsight.operators.compare import compare_groups, compared_members, render_compare, with_member_lists
    rows = [
        (5, 3, "photo_scene", "harbour", "none", "p1.jpg", ["boat", "sea"], ["kind:photo_scene", "x"]),
        (5, 9, "photo_scene", "harbour", "none", "p2.jpg", ["sea", "boat", "gull"], ["x", "kind:photo_scene"]),
        (6, 0, "chat_screenshot", "talk", "memory", "c.png", ["person"], ["kind:chat_screenshot", "has:ocr"]),
        (6, 1, "document_scan", "rules", "knowledge", "d.png", ["heading"], ["has:ocr", "kind:document_scan"]),
        (6, 2, "chat_screenshot", "talk", "memory", "e.png", [], ["has:ocr"]),
        (7, 0, "photo_scene", "alone", "none", "f.png", ["sea"], []),
    ]
    df = spark.createDataFrame(rows, "group_id long, pos int, kind string, title string, save_target string, "
                                     "file_name string, entities array<string>, tags array<string>")
    whole = with_member_lists(compare_groups(df), compared_members(df))
    blocks = {r.group_id: r.b for r in whole.select("group_id", render_compare().alias("b")).collect()}
    assert blocks.keys() == {5, 6}
    assert blocks[5] == "\n".join([
        "[ImageCompare]",
        "Summary: Compared 2 images of the same kind: photo_scene.",
        "SameKind: true",
        "Kinds: photo_scene",
        "Similarities: all images classified as photo_scene | shared entities: boat, sea | shared tags: kind:photo_scene, x",
        "Differences: (none)",
        "SaveRecommendation: none",
        "Compared: p1.jpg:photo_scene | p2.jpg:photo_scene",
    ])
    assert blocks[6] == "\n".join([
        "[ImageCompare]",
        "Summary: Compared 3 images across kinds: chat_screenshot, document_scan.",
        "SameKind: false",
        "Kinds: chat_screenshot, document_scan",
        "Similarities: shared tags: has:ocr",
        "Differences: kind mismatch: chat_screenshot vs document_scan vs chat_screenshot | titles differ: talk vs rules vs talk | "
        "save targets differ: memory vs knowledge vs memory",
        "SaveRecommendation: knowledge",
        "Compared: c.png:chat_screenshot | d.png:document_scan | e.png:chat_screenshot",
    ])
