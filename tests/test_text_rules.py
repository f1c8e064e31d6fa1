"""JS text semantics: ASCII word boundary, Unicode whitespace, order-keeping dedupe."""
from pyspark.sql import functions as F

from capsight.functions.text import clean_lines, js_trim, rx, unique


def one(spark, col, value):
    return spark.createDataFrame([(value,)], "s string").select(col.alias("r")).collect()[0].r


def test_js_trim_strips_unicode_spaces(spark):
    assert one(spark, js_trim(F.col("s")), "　  héllo 世界 \n﻿") == "héllo 世界"


def test_clean_lines_drop_blank_and_trim(spark):
    assert one(spark, clean_lines(F.col("s")), "  a \n　\n b\r\n") == ["a", "b"]


def test_ascii_boundary_next_to_han(spark):
    # Han characters are not word characters: the phone after 联系 and GMV before 同比 match.
    assert one(spark, F.regexp_extract("s", rx("phone"), 0), "联系13812345678") == "13812345678"
    assert one(spark, F.regexp_extract_all("s", F.lit(rx("metric")), 0), "GMV同比 12%") == ["GMV"]


def test_ascii_boundary_between_letters_and_digits(spark):
    assert one(spark, F.regexp_extract("s", rx("clock"), 0), "x12:34") == ""
    assert one(spark, F.regexp_extract("s", rx("clock"), 0), "at 12:34.") == "12:34"


def test_period_boundary_on_han_words(spark):
    # Han period words need ASCII word characters on both sides.
    assert one(spark, F.regexp_extract_all("s", F.lit(rx("period")), 0), "Q1 本周 本月") == ["Q1"]
    assert one(spark, F.regexp_extract_all("s", F.lit(rx("period")), 0), "a本周b") == ["本周"]


def test_unique_keeps_first_seen_order_and_drops_empty(spark):
    arr = F.array(*[F.lit(x) for x in ["b", "a", "b", "", "c", "a"]])
    assert one(spark, unique(arr), "") == ["b", "a", "c"]
