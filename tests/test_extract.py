"""D1-D9 restated with our own rows."""
from pyspark.sql import functions as F

from capsight.operators import extract as X


def run(spark, kind, text, lines=None, **extra):
    lines = lines if lines is not None else [x for x in text.split("\n") if x]
    df = spark.createDataFrame([(kind, text, lines, extra.get("file_name", "f.png"), ["why"])],
                               "kind string, text string, lines array<string>, file_name string, reasons array<string>")
    cols = X.extraction_columns(F.col("kind"), F.col("reasons"), F.col("file_name"), F.col("text"), F.col("lines"))
    return df.select(*[v.alias(k) for k, v in cols.items()]).collect()[0].asDict(recursive=True)


def test_key_fields_receipt(spark):
    kf = run(spark, "receipt_or_invoice", "合计 ¥120.50\n2024年3月15日")["key_fields"]
    assert kf["amount"] == "120.50" and kf["date"] == "2024年3月15日"
    kf = run(spark, "receipt_or_invoice", "Item: Apple\ntotal amount 55.00\nDate: 2024-03-15")["key_fields"]
    assert kf["amount"] == "55.00" and kf["date"] == "2024-03-15"


def test_han_label_wins_over_english(spark):
    kf = run(spark, "receipt_or_invoice", "total 9.99\n实付 8.00")["key_fields"]
    assert kf["amount"] == "8.00"


def test_han_date_needs_non_alnum_guards(spark):
    kf = run(spark, "receipt_or_invoice", "x2024年3月15日")["key_fields"]
    assert kf["date"] is None


def test_key_fields_any_kind(spark):
    kf = run(spark, "photo_scene", "联系: 13812345678\nContact: user@example.com\nSee https://example.com/page ok")["key_fields"]
    assert kf["phone"] == "13812345678" and kf["email"] == "user@example.com"
    assert kf["url"] == "https://example.com/page"
    assert kf["title"] is None and kf["amount"] is None


def test_title_and_latest_time(spark):
    assert run(spark, "document_scan", "", ["  ", " Introduction ", "x"])["key_fields"]["title"] == "Introduction"
    assert run(spark, "document_scan", "", [])["key_fields"]["title"] is None
    assert run(spark, "chat_screenshot", "Bob 14:30\nAlice 14:31")["key_fields"]["latest_time"] == "14:30"


def test_risk_flags_order_and_long_number_after_whitespace_removal(spark):
    r = run(spark, "receipt_or_invoice", "Card: 1234 5678 9012 3456\ncall 13812345678 a@b.io")
    assert r["risk_flags"] == ["contains_financial_fields", "contains_phone_number", "contains_email"]
    r = run(spark, "photo_scene", "卡 1234 5678 9012 3456")
    assert r["risk_flags"] == ["contains_long_numeric_identifier"]


def test_entities_by_kind(spark):
    assert run(spark, "receipt_or_invoice", "invoice")["entities"] == ["merchant", "total", "date", "tax_or_invoice"]
    assert run(spark, "chart_or_dashboard", "GMV up 5%")["entities"] == [
        "metric", "trend", "series", "trend_indicator", "business_metric"]
    assert run(spark, "document_scan", "Section 2\n1) item")["entities"] == [
        "title", "section", "heading", "numbered_list", "section_marker"]
    assert run(spark, "photo_scene", "GMV")["entities"] == []


def test_layout_and_table_hints(spark):
    assert run(spark, "document_scan", "1. First item\n2. Second item")["layout_hints"] == [
        "page_block", "paragraph_flow", "list_structure"]
    assert run(spark, "photo_scene", "x")["layout_hints"] == []
    assert run(spark, "document_scan", "col1  col2\nv1  v2")["table_hints"] == [
        "possible_table_rows", "possible_column_alignment"]
    assert run(spark, "document_scan", "Just a paragraph.")["table_hints"] == []


def test_chart_hints(spark):
    assert run(spark, "chart_or_dashboard", "增长 15%\nGMV 100万")["chart_hints"] == [
        "trend_chart_candidate", "contains_rate_or_growth_signal", "contains_business_metrics"]
    assert run(spark, "chat_screenshot", "GMV 15%")["chart_hints"] == []


def test_table_preview_first_five_then_dedupe(spark):
    lines = ["Apple  1.00"] * 3 + [f"Row{i}: {i}" for i in range(6)]
    r = run(spark, "receipt_or_invoice", "\n".join(lines), lines)
    assert r["table_preview"] == ["Apple  1.00", "Row0: 0", "Row1: 1"]
    assert run(spark, "chat_screenshot", "a: b")["table_preview"] == []


def test_chart_signals(spark):
    r = run(spark, "chart_or_dashboard", "GMV gmv 1% 2% -3.5% 4% 5% Q1 2024/03 本周")
    assert r["chart_signals"] == ["metric:GMV", "percent:1%", "percent:2%", "percent:-3.5%", "percent:4%",
                                  "period:Q1", "period:2024/03"]


def test_summary_lead_collapses_whitespace_and_cuts_at_140(spark):
    r = run(spark, "photo_scene", "a　　b\n" + "x" * 200, file_name="p.png")
    lead = r["vision_summary"].split("OCR suggests: ")[1]
    assert lead.startswith("a b x") and len(lead) == 140 and lead.endswith("...")
    assert run(spark, "photo_scene", "  ")["vision_summary"] == "Image f.png appears to be photo_scene based on why."


def test_limits_can_be_changed_and_lifted(spark):
    from pyspark.sql import functions as F
    from capsight.operators.extract import extraction_columns
    lines = [f"Item {i}.0" for i in range(9)] + [" ".join(f"{i}%" for i in range(10, 19))] + ["x" * 300]
    df = spark.createDataFrame([("chart_or_dashboard", ["r"], "f.png", "\n".join(lines), lines)], "k string, r array<string>, f string, t string, l array<string>")

    def run(**limits):
        cols = extraction_columns(F.col("k"), F.col("r"), F.col("f"), F.col("t"), F.col("l"), **limits)
        row = df.select(*[cols[c].alias(c) for c in ("table_preview", "chart_signals", "vision_summary")]).first()
        return len(row.table_preview), len(row.chart_signals), len(row.vision_summary.split("OCR suggests: ")[1])
    assert run() == (5, 4, 140)
    assert run(max_preview=2, max_percents=1, max_lead=30) == (2, 1, 30)
    preview, signals, lead = run(max_preview=None, max_percents=None, max_periods=None, max_lead=None)
    assert preview >= 9 and signals == 9 and lead == len(" ".join(lines))
