"""Kind-dependent extraction over the OCR text and OCR lines.

Inputs are the columns ``kind, reasons, file_name, ocr_text`` (raw text as the
OCR step returned it) and ``ocr_lines`` (the OCR step's line list).  Every
output is a column expression; arrays keep first-seen order.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from capsight.functions import rules as R
from capsight.functions.text import (
    DATE_HAN_JAVA, any_contains, cut, extract_all, first_match, has, is_ascii, js_trim, lit_array, once, rx, unique,
)


def empty() -> Column:
    return lit_array(())


def _by_kind(mapping: dict, kind: Column) -> Column:
    out = None
    for k, values in mapping.items():
        arr = lit_array(values)
        out = F.when(kind == k, arr) if out is None else out.when(kind == k, arr)
    return out.otherwise(empty())


def _flags(*pairs) -> Column:
    """Array of the labels whose condition holds, in the given order."""
    return F.array_compact(F.array(*[F.when(cond, F.lit(label)) for cond, label in pairs]))


def key_fields(kind: Column, text: Column, lines: Column) -> Column:
    """struct(title, latest_time, amount, date, phone, email, url)."""
    first_line = F.get(F.filter(lines, lambda l: js_trim(l) != ""), 0)
    title = F.when((kind == R.DOCUMENT) & first_line.isNotNull(), js_trim(first_line))
    latest = F.when(kind == R.CHAT, first_match(text, ("clock", 0)))
    amount = F.when(kind == R.RECEIPT, first_match(text, ("amount_han", 1), ("amount_en", 1)))
    date = F.when(kind == R.RECEIPT, first_match(text, ("date_dash", 0), (DATE_HAN_JAVA, 0)))
    # every phone match is an 11-digit run with ASCII boundaries
    phone = F.when(text.rlike(rx("eleven_digits")), first_match(text, ("phone", 0)))
    email = first_match(text, ("email", 0))
    url = first_match(text, ("url_http", 0), ("url_www", 0))
    return F.struct(title.alias("title"), latest.alias("latest_time"), amount.alias("amount"),
                    date.alias("date"), phone.alias("phone"), email.alias("email"), url.alias("url"))


def risk_flags(kind: Column, text: Column) -> Column:
    """Fixed order; the long-number test runs on the text without whitespace.

    Squeezing is skipped unless the raw text has 15 digits separated only by
    whitespace (without that, the squeezed text has no 15-digit run).
    """
    squeezed = F.regexp_replace(text, rx("ws_run"), "")
    long_id = F.when(text.rlike(rx("digit_run_15")), squeezed.rlike(rx("long_id"))).otherwise(F.lit(False))
    return _flags(
        (kind == R.RECEIPT, R.RISK_FINANCIAL),
        (kind == R.CHAT, R.RISK_PRIVATE),
        (text.rlike(rx("eleven_digits")), R.RISK_PHONE),
        (has(text, "email"), R.RISK_EMAIL),
        (long_id, R.RISK_LONG_ID),
    )


def entities(kind: Column, text: Column, lines: Column) -> Column:
    """D3: base entities per kind plus the ones the text or lines support."""
    receipt = unique(F.concat(lit_array(R.BASE_ENTITIES[R.RECEIPT]), _flags(
        (has(text, "receipt_total"), "total"),
        (has(text, "receipt_date"), "date"),
        (has(text, "receipt_tax"), "tax_or_invoice"))))
    chart = unique(F.concat(lit_array(R.BASE_ENTITIES[R.CHART]), _flags(
        (has(text, "chart_trend"), "trend_indicator"),
        (has(text, "chart_metric"), "business_metric"))))
    first = F.coalesce(F.get(lines, 0), F.lit(""))
    document = unique(F.concat(lit_array(R.BASE_ENTITIES[R.DOCUMENT]), _flags(
        (first != "", "heading"),
        (F.exists(lines, lambda l: js_trim(l).rlike(rx("numbered"))), "numbered_list"),
        (F.exists(lines, lambda l: l.rlike(rx("section_marker"))), "section_marker"))))
    return (F.when(kind == R.RECEIPT, receipt).when(kind == R.CHART, chart)
            .when(kind == R.DOCUMENT, document).otherwise(empty()))


def ui_elements(kind: Column) -> Column:
    """D4 (UI part)."""
    return _by_kind(R.UI_ELEMENTS, kind)


def layout_hints(kind: Column, lines: Column) -> Column:
    """D4 (layout part): documents add ``list_structure`` when a line is a list item."""
    base = _by_kind(R.LAYOUT_HINTS, kind)
    listy = F.exists(lines, lambda l: l.rlike(rx("list_item")))
    return F.when((kind == R.DOCUMENT) & listy,
                  F.concat(base, F.array(F.lit(R.LIST_LAYOUT_HINT)))).otherwise(base)


def _tabular(line: Column, name: str) -> Column:
    """``line.rlike``; an ASCII line without any of these signs has no match."""
    likely = any_contains(line, ("  ", "\t", "\n", "\x0b", "\f", "\r") + ((":",) if name == "tabular_line" else ()))
    return F.when(is_ascii(line), likely & line.rlike(rx(name, "ascii"))).otherwise(line.rlike(rx(name)))


def _collapsed(text: Column) -> Column:
    """White space as single spaces."""
    return F.when(is_ascii(text), F.regexp_replace(text, rx("ws_run", "ascii"), " ")).otherwise(F.regexp_replace(text, rx("ws_run"), " "))


def table_hints(kind: Column, lines: Column) -> Column:
    """D5."""
    tabular = F.exists(lines, lambda l: _tabular(l, "tabular"))
    return (F.when(kind == R.RECEIPT, lit_array(R.RECEIPT_TABLE_HINTS))
            .when((kind == R.DOCUMENT) & tabular, lit_array(R.DOCUMENT_TABLE_HINTS))
            .otherwise(empty()))


def chart_hints(kind: Column, text: Column) -> Column:
    """D6 (chart captures only)."""
    hints = F.concat(F.array(F.lit(R.CHART_BASE_HINT)), _flags(
        (has(text, "chart_rate"), R.CHART_RATE_HINT),
        (has(text, "chart_metric"), R.CHART_METRIC_HINT)))
    return F.when(kind == R.CHART, hints).otherwise(empty())


def first(values: Column, limit: int | None) -> Column:
    """The first ``limit`` values; all for None."""
    return values if limit is None else F.slice(values, 1, limit)


def table_preview(kind: Column, lines: Column, limit: int | None = R.TABLE_PREVIEW_MAX) -> Column:
    """Trimmed tabular or receipt-like lines, first five (``limit``), then de-duplicated."""
    cand = F.filter(
        F.transform(lines, js_trim),
        lambda l: (l != "") & (
            _tabular(l, "tabular_line")
            | (F.substring(l, -1, 1).between("0", "9") & l.rlike(rx("han_or_latin"))))
    )
    wanted = kind.isin(R.DOCUMENT, R.RECEIPT, R.CHART)
    return F.when(wanted, unique(first(cand, limit))).otherwise(empty())


def chart_signals(kind: Column, text: Column, max_percents: int | None = R.CHART_PERCENTS_MAX,
                  max_periods: int | None = R.CHART_PERIODS_MAX) -> Column:
    """Every metric (upper-cased), first 4 percents, first 4 periods (or as given), de-duplicated."""
    def tagged(prefix, arr):
        return F.transform(arr, lambda m: F.concat(F.lit(prefix), m))

    metrics = F.transform(extract_all(text, "metric"), lambda m: F.concat(F.lit("metric:"), F.upper(m)))
    percents = tagged("percent:", first(extract_all(text, "percent"), max_percents))
    periods = tagged("period:", first(extract_all(text, "period"), max_periods))
    return F.when(kind == R.CHART, unique(F.concat(metrics, percents, periods))).otherwise(empty())


def heuristic_summary(file_name: Column, kind: Column, reasons: Column, text: Column, max_lead: int | None = R.OCR_LEAD_MAX) -> Column:
    """Name, kind, first reason and the OCR lead (whitespace collapsed, 140 characters at most, or as given)."""
    reason = F.coalesce(F.get(reasons, 0), F.lit("generic image heuristics"))
    base = F.concat(F.lit("Image "), file_name, F.lit(" appears to be "), kind,
                    F.lit(" based on "), reason, F.lit("."))
    lead = js_trim(_collapsed(text))
    if max_lead is not None:
        keep = max(0, max_lead - (R.OCR_LEAD_MAX - R.OCR_LEAD_CUT))
        # where the beginning alone has more than the lead shows, the rest need not be collapsed
        begin = once(F.substring(text, 1, 2 * max_lead + 8), lambda part: F.ltrim(_collapsed(part)))
        long = once(begin, lambda part: F.when(F.length(part) > max_lead + 1, F.concat(F.substring(part, 1, keep), F.lit("..."))))
        lead = F.coalesce(long, once(lead, lambda whole: cut(whole, max_lead, keep)))
    return once(lead, lambda v: F.when(v != "", F.concat(base, F.lit(" OCR suggests: "), v)).otherwise(base))


def extraction_columns(kind: Column, reasons: Column, file_name: Column, text: Column,
                       lines: Column, max_preview: int | None = R.TABLE_PREVIEW_MAX, max_percents: int | None = R.CHART_PERCENTS_MAX,
                       max_periods: int | None = R.CHART_PERIODS_MAX, max_lead: int | None = R.OCR_LEAD_MAX) -> dict[str, Column]:
    """D1-D9 as one dict of columns (the heuristic vision result); None lifts a limit."""
    return {
        "vision_summary": heuristic_summary(file_name, kind, reasons, text, max_lead),
        "entities": entities(kind, text, lines),
        "ui_elements": ui_elements(kind),
        "risk_flags": risk_flags(kind, text),
        "key_fields": key_fields(kind, text, lines),
        "layout_hints": layout_hints(kind, lines),
        "table_hints": table_hints(kind, lines),
        "chart_hints": chart_hints(kind, text),
        "table_preview": table_preview(kind, lines, max_preview),
        "chart_signals": chart_signals(kind, text, max_percents, max_periods),
        "vision_warnings": empty(),
    }
