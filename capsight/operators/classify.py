"""Mime inference, name and text classification, refinement.

All of it is column expressions: the whole classification is one narrow stage
with no shuffle.  Signals are computed once into columns so that the big
``when`` chains refer to them instead of re-running regexes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from capsight.functions import rules as R
from capsight.functions.text import (
    any_contains, clean_lines, count_contains, count_lines, has, is_ascii, js_trim, per_context, rx, unique,
)


def infer_mime(path: Column) -> Column:
    """Mime type from the lower-cased file suffix."""
    lower = F.lower(path)
    out = None
    for suffixes, mime in R.MIME_BY_SUFFIX:
        cond = None
        for s in suffixes:
            c = lower.endswith("." + s)
            cond = c if cond is None else (cond | c)
        out = F.when(cond, F.lit(mime)) if out is None else out.when(cond, F.lit(mime))
    return out.otherwise(F.lit(R.MIME_DEFAULT))


def _name_text(df_file_name: Column, hint: Column) -> Column:
    return F.lower(F.concat(df_file_name, F.lit(" "), F.coalesce(hint, F.lit(""))))


def name_class_columns(file_name: Column, hint: Column, mime: Column) -> dict[str, Column]:
    """First keyword family found in ``lower(file_name + ' ' + hint)`` wins."""
    text = _name_text(file_name, hint)
    kind = conf = reason = None
    for k, c, why, words in R.NAME_RULES:
        hit = any_contains(text, words)
        if kind is None:
            kind, conf, reason = F.when(hit, k), F.when(hit, c), F.when(hit, why)
        else:
            kind, conf, reason = kind.when(hit, k), conf.when(hit, c), reason.when(hit, why)
    is_image = mime.startswith("image/")
    pk, pc, pr = R.NAME_IMAGE
    uk, uc, ur = R.NAME_FALLBACK
    kind = kind.when(is_image, pk).otherwise(uk)
    conf = conf.when(is_image, pc).otherwise(uc)
    reason = reason.when(is_image, pr).otherwise(ur)
    return {"name_kind": kind, "name_confidence": conf.cast("double"), "name_reason": reason}


def classify_by_name(df: DataFrame) -> DataFrame:
    """C2 as a job: adds name_kind, name_confidence, name_reason."""
    return df.withColumns(name_class_columns(F.col("file_name"), F.col("hint"), F.col("mime_type")))


def text_base_columns(file_name: Column, hint: Column, ocr_text: Column) -> dict[str, Column]:
    """C3 inputs computed once: trimmed text, lowered keyword text, clean lines."""
    trimmed = js_trim(ocr_text)
    return {
        "_text_blank": trimmed == "",
        "_full": F.lower(F.concat(file_name, F.lit(" "), F.coalesce(hint, F.lit("")), F.lit(" "), trimmed)),
        "_cls_lines": clean_lines(ocr_text),
    }


def text_signal_columns(full: Column, lines: Column) -> dict[str, Column]:
    """Counts over the keyword text and the clean lines (see ``text_base_columns``).

    Keyword counts run on ``lower(name + ' ' + hint + ' ' + trimmed text)``; line
    counts run on the trimmed, non-blank lines of the text.
    """
    han = F.when(is_ascii(full), F.lit(False)).otherwise(full.rlike(rx("han")))
    # the lines are parts of ``full``, but for their case
    headed = F.coalesce(any_contains(full, ("第", "chapter", "section", "摘要", "目录")), F.lit(True))
    return {
        "n_receipt_words": count_contains(full, R.RECEIPT_WORDS, han),
        "n_chart_words": count_contains(full, R.CHART_WORDS, han),
        "n_chat_words": count_contains(full, R.CHAT_WORDS, han),
        "n_doc_words": count_contains(full, R.DOC_WORDS, han),
        "n_lines": F.size(lines),
        "n_clock_lines": count_lines(lines, lambda l: has(l, "clock")),
        "n_speaker_lines": count_lines(lines, lambda l: l.rlike(rx("speaker"))),
        "n_numbered_lines": count_lines(lines, lambda l: l.rlike(rx("numbered"))),
        "n_instruction_lines": count_lines(lines, lambda l: any_contains(l, (":", "：", "-")) | l.rlike(r"^\d+\.")),
        "has_heading": F.when(headed, F.exists(lines, lambda l: l.rlike(rx("heading")))).otherwise(F.lit(False)),
        "has_long_line": F.exists(lines, lambda l: F.length(l) >= R.DOC_LONG_LINE[1]),
        "joined_length": F.length(F.array_join(lines, "")),
    }


def text_kind_column() -> Column:
    """C4: receipt > chat > chart > document priority over the C3 columns."""
    c = F.col
    receipt = c("n_receipt_words") >= R.RECEIPT_LIKE_MIN
    chat = (c("n_clock_lines") >= R.CHAT_CLOCK_LINES_MIN) | (c("n_speaker_lines") >= R.CHAT_SPEAKER_LINES_MIN) | (c("n_chat_words") >= R.CHAT_WORDS_MIN)
    chart = c("n_chart_words") >= R.CHART_LIKE_MIN
    doc_words = c("n_doc_words") >= 1
    document = (
        c("has_heading")
        | (c("n_numbered_lines") >= R.DOC_NUMBERED_LINES_MIN)
        | ((c("n_lines") >= R.DOC_INSTRUCTIONS[0]) & (c("n_instruction_lines") >= R.DOC_INSTRUCTIONS[1]))
        | ((c("n_lines") >= R.DOC_LONG_LINE[0]) & c("has_long_line") & doc_words)
        | ((c("n_lines") >= R.DOC_JOINED[0]) & (c("joined_length") >= R.DOC_JOINED[1]) & doc_words)
    )
    return (F.when(c("_text_blank"), F.lit(None).cast("string"))
            .when(receipt, R.RECEIPT).when(chat, R.CHAT).when(chart, R.CHART)
            .when(document, R.DOCUMENT))


def _text_result(kind: Column, idx: int) -> Column:
    out = None
    for k, vals in R.TEXT_RESULTS.items():
        out = F.when(kind == k, F.lit(vals[idx])) if out is None else out.when(kind == k, F.lit(vals[idx]))
    return out


def refine_columns() -> dict[str, Column]:
    """Merge the name result with the text result."""
    tk, nk = F.col("text_kind"), F.col("name_kind")
    tc = _text_result(tk, 0).cast("double")
    nc = F.col("name_confidence")
    reasons = F.when(tk.isNull(), F.array(F.col("name_reason"))).otherwise(
        unique(F.array(F.col("name_reason"), _text_result(tk, 1))))
    conf = (F.when(tk.isNull(), nc)
            .when(tk == nk, F.least(F.lit(R.SAME_KIND_CAP), F.greatest(nc, tc)))
            .otherwise(F.greatest(nc, tc)))
    return {"kind": F.coalesce(tk, nk), "confidence": conf, "reasons": reasons}


def classify(df: DataFrame) -> DataFrame:
    """C2-C5 over ``file_name, hint, mime_type, ocr_text``.

    Adds ``name_*``, the C3 signal columns, ``text_kind`` and the final
    ``kind, confidence, reasons``.  Three projections: signals, text kind, merge.
    """
    base = df.withColumns(_base_columns())
    sig = base.withColumns(_signal_columns()).drop("_full", "_cls_lines")
    return sig.withColumn("text_kind", _text_kind()).withColumns(_refine_columns())


@per_context
def _base_columns() -> dict[str, Column]:
    return text_base_columns(F.col("file_name"), F.col("hint"), F.col("ocr_text"))


@per_context
def _signal_columns() -> dict[str, Column]:
    return {**name_class_columns(F.col("file_name"), F.col("hint"), F.col("mime_type")),
            **text_signal_columns(F.col("_full"), F.col("_cls_lines"))}


@per_context
def _text_kind() -> Column:
    return text_kind_column()


@per_context
def _refine_columns() -> dict[str, Column]:
    return refine_columns()


SIGNAL_COLUMNS = ("n_receipt_words", "n_chart_words", "n_chat_words", "n_doc_words", "n_lines",
                  "n_clock_lines", "n_speaker_lines", "n_numbered_lines", "n_instruction_lines",
                  "has_heading", "has_long_line", "joined_length")
