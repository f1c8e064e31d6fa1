"""Capture, OCR-attempt and message views derived from the driver tables.

``documents`` becomes one capture per document and ``conversations`` the
message log.  Signals the raw tables lack (receipt lines, clock times, Han
text, media markers, ...) are added by fixed rules on the ids, so every view is
a pure function of the given tables and grows with them.  Every document and
every message is kept, and each capture's OCR text carries the *whole*
document text (no prefix).

The same text (``CAPTURES_SQL`` / ``MESSAGES_SQL``) runs in Spark and in the DuckDB
oracles; only the table placeholders differ.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from capsight.operators.classify import infer_mime

# FIXED VALUES: the fixture rules (see FIXTURES.md), whole text instead of a prefix.
CAPTURES_SQL = """
WITH base AS (
  SELECT doc_id, n_chars, text,
    CAST(CASE WHEN doc_id % 41 = 0 THEN -1 - doc_id
              WHEN FLOOR(doc_id / 48) % 2 = 0 THEN FLOOR(doc_id / 48) * 100 + doc_id % 12
              ELSE FLOOR(doc_id / 48) * 100 + FLOOR((doc_id % 48) / 4) END AS BIGINT) AS group_id,
    CAST(CASE WHEN doc_id % 41 = 0 THEN 0
              WHEN FLOOR(doc_id / 48) % 2 = 0 THEN FLOOR((doc_id % 48) / 12)
              ELSE doc_id % 4 END AS INT) AS pos,
    CASE WHEN doc_id % 50 = 4 THEN 'this is a receipt' END AS hint,
    CASE CAST(doc_id % 8 AS INT)
      WHEN 0 THEN 'receipt_' || CAST(doc_id AS STRING) || '.png'
      WHEN 1 THEN 'screenshot_' || CAST(doc_id AS STRING) || '.jpg'
      WHEN 2 THEN 'chart_' || CAST(doc_id AS STRING) || '.webp'
      WHEN 3 THEN 'scan_' || CAST(doc_id AS STRING) || '.TIFF'
      WHEN 6 THEN 'IMG_' || CAST(doc_id AS STRING) || '.heic'
      WHEN 7 THEN CASE WHEN doc_id % 16 = 7 THEN 'blob_' || CAST(doc_id AS STRING) || '.bin'
                       ELSE 'anim_' || CAST(doc_id AS STRING) || '.gif' END
      ELSE 'img_' || CAST(doc_id AS STRING) || '.png' END AS file_name,
    CASE CAST(doc_id % 12 AS INT)
      WHEN 0 THEN concat_ws(chr(10), '合计 ¥120.50', '实付 120.50', '2024年3月15日', '苹果  5.00')
      WHEN 1 THEN concat_ws(chr(10), 'Invoice', 'Subtotal 50.00', 'total amount 55.00', 'Date 2024-03-15')
      WHEN 2 THEN concat_ws(chr(10), 'Alice', 'hello', '12:34', 'Bob')
      WHEN 3 THEN concat_ws(chr(10), 'dashboard GMV 125.4', 'ROI 3.2', 'CTR 4.8%', '同比增长 12%', 'Q1 2024/03')
      WHEN 4 THEN concat_ws(chr(10), '第一章 Introduction', '1. First item', '2. Second item')
      WHEN 5 THEN concat_ws(chr(10), 'Contact: user' || CAST(doc_id AS STRING) || '@example.com', 'tel 13812345678',
                            'see https://example.com/p/' || CAST(doc_id AS STRING))
      WHEN 6 THEN 'Card: 1234 5678 9012 3456'
      WHEN 7 THEN ''
      WHEN 8 THEN concat_ws(chr(10), '   ', '  ')
      WHEN 9 THEN concat_ws(chr(10), '项目　　数量　　金额', '报告　', '合计 8')
      WHEN 10 THEN concat_ws(chr(10), '联系13812345678', 'GMV同比 12%', '图表 本周')
      ELSE text END AS head
  FROM {documents})
SELECT doc_id AS capture_id, group_id, pos, hint, '/data/' || file_name AS file_path, file_name,
  CAST(CASE WHEN doc_id % 97 = 0 THEN 0 WHEN doc_id % 89 = 0 THEN 20000000 ELSE n_chars END AS BIGINT) AS size_bytes,
  CAST(1704067200000 + doc_id * 1000 AS BIGINT) AS modified_ms,
  CASE WHEN doc_id % 12 IN (7, 8, 11) THEN head ELSE head || chr(10) || text END AS ocr_text
FROM base
"""

MESSAGES_SQL = """
SELECT conv_id, turn, role, text ||
  CASE WHEN (conv_id * 5 + turn * 3) % 4 = 0 THEN ' [media attached: /data/img_' ||
         CAST(CASE WHEN conv_id % 3 = 0 AND turn % 3 < 2 THEN 4 ELSE (conv_id + turn % 3) * 8 + 4 END AS STRING) ||
         '.png (image/png) | inbound]'
       WHEN (conv_id * 5 + turn * 3) % 4 = 1 THEN ' [media attached: /data/missing_' || CAST(conv_id AS STRING) || '_' ||
         CAST(turn AS STRING) || '.JPG | inbound] and [media attached: /data/img_' ||
         CAST((conv_id + turn % 2) * 8 + 4 AS STRING) || '.png | again]'
       WHEN (conv_id * 5 + turn * 3) % 4 = 2 THEN ' [media attached: /data/notes.txt | inbound]'
       ELSE '' END AS text
FROM {conversations}
"""

# Two OCR providers per capture; the first fails on two of every three captures.
ATTEMPT_PROVIDERS = (("macos_vision", 0), ("paddleocr", 1))
# --- end of fixed values


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def captures_from(documents: DataFrame) -> DataFrame:
    """Captures from a documents DataFrame (batch or stream)."""
    df = documents.sparkSession.sql(CAPTURES_SQL, documents=documents)
    return df.withColumn("mime_type", infer_mime(F.col("file_path")))


def captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One capture per document: ids, group/pos, hint, path, size, mtime, mime, OCR text."""
    return captures_from(table(spark, sf_dir, "documents"))


def attempts(spark: SparkSession, sf_dir: str, caps: DataFrame | None = None) -> DataFrame:
    """OCR attempts ``(capture_id, provider, attempt_no, elapsed_ms, text, lines, warnings)``.

    Built with ``explode`` over the provider list (a narrow Generate, not a join).
    """
    from capsight.functions.text import clean_lines
    caps = caps if caps is not None else captures(spark, sf_dir)
    prov = F.explode(F.array(*[F.struct(F.lit(p).alias("provider"), F.lit(r).alias("rank"))
                               for p, r in ATTEMPT_PROVIDERS])).alias("p")
    df = caps.select("capture_id", "ocr_text", prov)
    failed = (F.col("p.rank") == 0) & (F.col("capture_id") % 3 != 0)
    text = F.when(failed, F.lit("")).otherwise(F.col("ocr_text"))
    return df.select(
        "capture_id",
        F.col("p.provider").alias("provider"),
        F.lit(0).alias("attempt_no"),
        ((F.col("capture_id") * 37 + F.col("p.rank") * 11) % 14000).cast("long").alias("elapsed_ms"),
        text.alias("text"),
        clean_lines(text).alias("lines"),
        F.when(failed, F.array(F.lit("no text"))).otherwise(F.array().cast("array<string>")).alias("warnings"),
    )


def messages_from(conversations: DataFrame) -> DataFrame:
    """The message log from a conversations DataFrame (batch or stream)."""
    return conversations.sparkSession.sql(MESSAGES_SQL, conversations=conversations)


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The message log ``(conv_id, turn, role, text)`` with media markers."""
    return messages_from(table(spark, sf_dir, "conversations"))


def repeated_attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attempts with retries: for every 5th capture each provider first failed, and every 7th was tried twice with a text."""
    att = attempts(spark, sf_dir)
    tries = F.when(F.col("capture_id") % 5 == 0, F.array(F.lit(0), F.lit(1))).when(F.col("capture_id") % 7 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    att = att.withColumn("attempt_no", F.explode(tries))
    blank = F.col("attempt_no") == 0
    none = F.array().cast("array<string>")
    return att.withColumns({
        "elapsed_ms": F.when(blank, F.lit(50).cast("long")).otherwise(F.col("elapsed_ms")),
        "text": F.when(blank, F.lit("")).otherwise(F.concat(F.col("text"), F.when(F.col("attempt_no") == 2, " again").otherwise(""))),
        "lines": F.when(blank, none).otherwise(F.col("lines")),
        "warnings": F.when(blank, F.array(F.concat(F.lit("first try of "), F.col("provider"), F.lit(" failed")))).otherwise(F.col("warnings"))})


def nested_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages in nested form ``(conv_id, turn, message)``: JSON with role, content parts and metadata; in every 5th
    conversation odd turns carry numbers only, in another 5th messages are plain text."""
    msgs = messages(spark, sf_dir)
    parts = F.transform(F.split(F.col("text"), "\n"), lambda line: F.struct(F.lit("text").alias("type"), line.alias("text")))
    msg = F.struct(F.col("role").alias("role"), parts.alias("content"),
                   F.struct(F.col("turn").alias("turn"), F.lit("fixture").alias("channel")).alias("meta"))
    numbers = F.to_json(F.struct(F.col("turn").alias("turn"), F.array(F.col("conv_id"), F.lit(7)).alias("values")))
    five = F.col("conv_id") % 5
    message = F.when((five == 3) & (F.col("turn") % 2 == 1), numbers).when(five == 1, F.col("text")).otherwise(F.to_json(msg))
    return msgs.select("conv_id", "turn", message.alias("message"))


def ocr_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """OCR stdout payloads per attempt, every one with its whole text; lines carry a score.

    Every 7th capture's payloads are malformed (a stray bracket in front), every 5th capture's are labelled by
    another engine's name, and every 11th capture has an earlier attempt with a numeric ``text``.
    """
    att = attempts(spark, sf_dir)
    label = F.when(F.col("capture_id") % 5 == 0, F.lit("my-ocr")).otherwise(F.col("provider"))
    good = F.to_json(F.struct(
        label.alias("provider"), F.col("text").alias("text"),
        F.transform(F.split(F.col("text"), "\n"), lambda l: F.struct(l.alias("text"), F.lit(0.9).alias("score")))
         .alias("lines")))
    numeric = F.to_json(F.struct(F.col("provider").alias("provider"), F.col("elapsed_ms").alias("text")))
    whole = F.struct(F.lit(1).alias("attempt_no"), F.when(F.col("capture_id") % 7 == 0, F.concat(F.lit("}"), good)).otherwise(good).alias("payload"))
    early = F.struct(F.lit(0).alias("attempt_no"), numeric.alias("payload"))
    rows = F.when(F.col("capture_id") % 11 == 0, F.array(early, whole)).otherwise(F.array(whole))
    return att.select("capture_id", "provider", "elapsed_ms", F.explode(rows).alias("r")).select("capture_id", "provider", "elapsed_ms", "r.attempt_no", "r.payload")


def with_ocr(caps: DataFrame) -> DataFrame:
    """Captures whose OCR text is taken as given: lines are its clean lines."""
    from capsight.functions.text import clean_lines
    return caps.withColumns({
        "ocr_provider": F.lit("fixture"),
        "ocr_lines": clean_lines(F.col("ocr_text")),
        "ocr_warnings": F.array().cast("array<string>"),
    })


def png_extractor(data: bytes, path: str) -> str:
    """The first of a chain: reads ``.png`` files, refuses ``.tiff`` and finds nothing in others."""
    if path.lower().endswith(".tiff"):
        raise ValueError("unsupported file type\nat decoder")
    return data.decode("utf-8") if path.endswith(".png") else ""
