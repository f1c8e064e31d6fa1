"""Normalize, render and the whole per-capture analysis chain.

``analyze`` is a composition of column expressions over one input row: name
class, text signals, text class, extraction, normalization.  It never shuffles;
on a cluster it runs inside the scan stage of whatever produced the captures.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from capsight.functions import rules as R
from capsight.functions.text import js_trim, lit_array, or_none, per_context
from capsight.operators.classify import SIGNAL_COLUMNS, classify
from capsight.operators.extract import empty, extraction_columns

LIST_COLUMNS = ("entities", "ui_elements", "risk_flags", "layout_hints", "table_hints",
                "chart_hints", "table_preview", "chart_signals")
ANALYSIS_COLUMNS = ("error", "message", "kind", "confidence", "reasons", "summary", "ocr_provider",
                    "ocr_text") + LIST_COLUMNS[:3] + ("key_fields",) + LIST_COLUMNS[3:] + (
                    "warnings", "source")
_INTERNAL = ("name_kind", "name_confidence", "name_reason", "text_kind", "_text_blank",
             "vision_summary", "vision_warnings") + SIGNAL_COLUMNS


def null_key_fields() -> Column:
    return F.struct(*[F.lit(None).cast("string").alias(k) for k in R.KEY_FIELD_NAMES])


def _with_ocr_defaults(df: DataFrame) -> DataFrame:
    from capsight.operators.classify import infer_mime
    cols = {}
    if "hint" not in df.columns:
        cols["hint"] = F.lit(None).cast("string")
    if "mime_type" not in df.columns:
        cols["mime_type"] = infer_mime(F.col("file_path") if "file_path" in df.columns else F.col("file_name"))
    if "message" not in df.columns:
        cols["message"] = F.lit(None).cast("string")
    if "ocr_text" not in df.columns:
        cols["ocr_text"] = F.lit(None).cast("string")
    if "ocr_provider" not in df.columns:
        cols["ocr_provider"] = F.lit(None).cast("string")
    if "ocr_lines" not in df.columns:
        cols["ocr_lines"] = empty()
    if "ocr_warnings" not in df.columns:
        cols["ocr_warnings"] = empty()
    df = df.withColumns(cols) if cols else df
    return df.withColumns({
        "ocr_text": F.coalesce(F.col("ocr_text"), F.lit("")),
        "ocr_lines": F.coalesce(F.col("ocr_lines"), empty()),
        "ocr_warnings": F.coalesce(F.col("ocr_warnings"), empty()),
    })


def _disabled_vision(file_name: Column, kind: Column) -> dict[str, Column]:
    cols = {k: empty() for k in LIST_COLUMNS}
    cols["vision_summary"] = F.concat(F.lit("Vision provider is disabled. File "), file_name,
                                      F.lit(" was classified as "), kind, F.lit("."))
    cols["key_fields"] = null_key_fields()
    cols["vision_warnings"] = lit_array((R.VISION_DISABLED_WARNING,))
    return cols


def normalize_columns(max_summary_chars: int = R.MAX_SUMMARY_CHARS) -> dict[str, Column]:
    """Trimmed text, summary with the character note and the length limit, warnings."""
    if max_summary_chars <= 0:
        raise ValueError("max_summary_chars must be > 0")
    text = js_trim(F.col("ocr_text"))
    summary = F.when(text != "", F.concat(F.col("vision_summary"), F.lit(" OCR extracted "),
                                          F.length(text).cast("string"), F.lit(" characters.")))
    summary = summary.otherwise(F.col("vision_summary"))
    keep = max(0, max_summary_chars - 3)
    summary = F.when(F.length(summary) <= max_summary_chars, summary).otherwise(
        F.concat(F.substring(summary, 1, keep), F.lit("...")))
    return {
        "summary": summary,
        "ocr_text": text,
        "warnings": F.concat(F.col("ocr_warnings"), F.col("vision_warnings")),
        "source": F.struct(F.col("file_name").alias("file_name"),
                           F.col("mime_type").alias("mime_type"),
                           F.col("size_bytes").cast("long").alias("size_bytes")),
    }


def _failure_override(cols: dict[str, Column]) -> dict[str, Column]:
    """Rows rejected before analysis keep the full failure shape."""
    err = F.col("message").isNotNull()
    fail = {
        "kind": F.lit(R.UNKNOWN), "confidence": F.lit(0.0), "reasons": empty(), "summary": F.lit(""),
        "ocr_text": F.lit(""), "key_fields": null_key_fields(),
        "warnings": F.array(F.col("message")),
        "source": F.struct(F.lit("").alias("file_name"), F.lit("").alias("mime_type"),
                           F.lit(0).cast("long").alias("size_bytes")),
        **{k: empty() for k in LIST_COLUMNS},
    }
    out = {k: F.when(err, fail[k]).otherwise(v) if k in fail else v for k, v in cols.items()}
    out["error"] = err
    return out


def analyze(captures: DataFrame, vision: str = "heuristic",
            max_summary_chars: int = R.MAX_SUMMARY_CHARS) -> DataFrame:
    """Classify, extract and normalize every capture.

    ``captures`` needs ``file_name, mime_type, size_bytes, hint, ocr_text`` and may
    carry ``ocr_provider, ocr_lines, ocr_warnings`` (from ``resolve_ocr``) and
    ``message`` (from ``admit``; non-null means rejected).  Other columns pass
    through.  Output adds the ``ANALYSIS_COLUMNS``.
    """
    if vision not in ("heuristic", "disabled"):
        raise ValueError(f"unknown vision provider: {vision}")
    df = _with_ocr_defaults(captures)
    classified = classify(df)
    extracted = classified.withColumns(_vision_columns(vision))
    norm = extracted.withColumns(_normalize_columns(max_summary_chars))
    final = norm.withColumns(_final_columns())
    drop = set(_INTERNAL) | {"ocr_lines", "ocr_warnings"}
    keep = [c for c in final.columns if c not in drop and c not in ANALYSIS_COLUMNS]
    return final.select(*keep, *ANALYSIS_COLUMNS)


@per_context
def _vision_columns(vision: str) -> dict[str, Column]:
    kind = F.col("kind")
    if vision == "heuristic":
        return extraction_columns(kind, F.col("reasons"), F.col("file_name"), F.col("ocr_text"), F.col("ocr_lines"))
    return _disabled_vision(F.col("file_name"), kind)


@per_context
def _normalize_columns(max_summary_chars: int) -> dict[str, Column]:
    return normalize_columns(max_summary_chars)


@per_context
def _final_columns() -> dict[str, Column]:
    return _failure_override({c: F.col(c) for c in ANALYSIS_COLUMNS if c != "error"})


def key_fields_text(kf: Column) -> Column:
    """``k=v; ...`` over the non-empty key fields in their fixed order; ``(none)`` if none."""
    parts = F.array_compact(F.array(*[
        F.when(js_trim(F.coalesce(kf[k], F.lit(""))) != "", F.concat(F.lit(k + "="), kf[k]))
        for k in R.KEY_FIELD_NAMES]))
    return or_none(parts, "; ")


def render_block(df: DataFrame | None = None) -> Column:
    """The 14-line text block (plus a Warnings line); empty for failures."""
    c = F.col
    block = F.concat_ws(
        "\n",
        F.lit(R.IMAGE_HEADER),
        F.concat(F.lit("Kind: "), c("kind")),
        F.concat(F.lit("Summary: "), c("summary")),
        F.concat(F.lit("OCR: "), F.when(c("ocr_text") != "", c("ocr_text")).otherwise(F.lit("(none)"))),
        F.concat(F.lit("Entities: "), or_none(c("entities"))),
        F.concat(F.lit("UI: "), or_none(c("ui_elements"))),
        F.concat(F.lit("KeyFields: "), key_fields_text(c("key_fields"))),
        F.concat(F.lit("Layout: "), or_none(c("layout_hints"))),
        F.concat(F.lit("Table: "), or_none(c("table_hints"))),
        F.concat(F.lit("Chart: "), or_none(c("chart_hints"))),
        F.concat(F.lit("TablePreview: "), or_none(c("table_preview"), " | ")),
        F.concat(F.lit("ChartSignals: "), or_none(c("chart_signals"))),
        F.concat(F.lit("Risks: "), or_none(c("risk_flags"))),
        F.concat(F.lit("Confidence: "), F.format_string("%.2f", c("confidence"))),
        F.when(F.size(c("warnings")) > 0, F.concat(F.lit("Warnings: "), F.array_join(c("warnings"), " | "))),
    )
    return F.when(c("error"), F.lit("")).otherwise(block)


def run_analysis(captures: DataFrame, attempts: DataFrame | None = None, provider: str = "auto",
                 fallback=R.OCR_FALLBACK_ORDER, timeout_ms: int | None = R.OCR_TIMEOUT_MS,
                 vision: str = "heuristic", max_summary_chars: int = R.MAX_SUMMARY_CHARS,
                 max_image_bytes: int = R.MAX_IMAGE_BYTES) -> DataFrame:
    """The whole job: admit (A2), resolve OCR attempts (B1-B3), analyse (E3), hand off.

    ``attempts=None`` means the captures already carry ``ocr_*`` columns.
    One shuffle on ``capture_id`` for the attempt fold; the captures side of the
    left join is shuffled once on the same key (or broadcast by AQE when small).
    Every capture yields one row; rejected captures carry the failure shape.
    """
    from capsight.operators.handoff import with_handoff
    from capsight.operators.ocr import with_resolved_ocr
    from capsight.sources.listing import admit

    admitted = admit(captures.drop("error", "message"), max_image_bytes).drop("error")
    if attempts is None and provider != "disabled":
        with_ocr = admitted  # the captures already carry their OCR columns
    else:
        with_ocr = with_resolved_ocr(admitted, attempts, provider, fallback, timeout_ms)
    return with_handoff(analyze(with_ocr, vision=vision, max_summary_chars=max_summary_chars))
