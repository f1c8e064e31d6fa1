"""What keeps the analysis linear and cheap per character gives the results of the plain forms."""
from pyspark.sql import functions as F

from capsight.functions import text as T
from capsight.operators import extract
from tests.conftest import analyze_rows, capture_rows

TEXTS = ["", " ", "total 5", "TOTAL: 合计", "Date", "ınvoice", "İnvoice tİme", "a  b", "a　b", "a  b", "a:b", "a：b", "a\tb", "a\r\x0bb", "第一章", "第 章", "第\n章",
         "x12345678901", "12345678901x", "12345678901", "tel 13812345678.", "www.a.com", "xwww.a.com", "WWW.　a.com", "_GMV GMV", "gmv:roi", "x本周x", "本周", "Q3 2024/03", "q1x",
         "2024-03-15", "x2024-03-15", "2024年3月15日", "a2024年3月15日", "12:34", "x12:34 1:23", "摘要", "SECTION 1", "total amount 55.00", "合计 ¥120.50", "实付x",
         "\U0001f600 12345678901", "ſection", "123 456 789 012 345"]


def texts(spark):
    return spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "id int, t string")


def test_patterns_equal_their_plain_form(spark):
    df, t = texts(spark), F.col("t")
    for name in T.PATTERNS:
        plain = T.render(T.PATTERNS[name])
        same = (T.has(t, name) == t.rlike(plain)) & F.regexp_extract_all(t, F.lit(T.rx(name)), 0).eqNullSafe(F.regexp_extract_all(t, F.lit(plain), 0))
        assert [r.t for r in df.where(~same).collect()] == [], name
    for name in ("tabular", "tabular_line"):
        assert [r.t for r in df.where(extract._tabular(t, name) != t.rlike(T.render(T.PATTERNS[name]))).collect()] == [], name


def test_lead_of_long_texts(spark):
    """The lead from the beginning alone equals the one from the whole collapsed text."""
    long = ["ab " * 200, " " * 400 + "x y" * 90, "a" * 139 + " " * 300, "a" * 140 + " " * 300, "a" * 141 + " " * 300, "a" * 140 + " " * 300 + "b", "　x　" * 200, "é " * 60 + " " * 500 + "z" * 50]
    df = spark.createDataFrame([(x,) for x in long + TEXTS], "t string")
    t, kind, none = F.col("t"), F.lit("k"), F.array().cast("array<string>")
    lead = T.js_trim(F.regexp_replace(t, T.rx("ws_run"), " "))
    base = F.lit("Image f appears to be k based on generic image heuristics.")
    whole = F.when(lead != "", F.concat(base, F.lit(" OCR suggests: "), T.cut(lead, 140, 137))).otherwise(base)
    assert [r.t for r in df.where(extract.heuristic_summary(F.lit("f"), kind, none, t) != whole).collect()] == []


def test_keywords_are_searched_by_bytes(spark):
    """No search by character, and one computation of a pattern's match (both took most of the analysis' time)."""
    from capsight.operators.analyze import analyze
    df = analyze(capture_rows(spark, [{"file_name": "a.png", "ocr_text": "total 5"}]))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "instr(" not in plan and plan.count(T.rx("amount_en")) == 1
    assert analyze_rows(spark, [{"file_name": "receipt.png", "ocr_text": "total 5\ntax"}])[0]["key_fields"]["amount"] == "5"
