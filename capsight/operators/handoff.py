"""The handoff record built from an analysis row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from capsight.functions import rules as R
from capsight.functions.text import per_context
from capsight.operators.extract import empty


def title(kind: Column, key_fields: Column, file_name: Column) -> Column:
    """key title, else ``kind:amount``, else ``kind:file_name``."""
    return F.coalesce(key_fields["title"],
                      F.when(key_fields["amount"].isNotNull(), F.concat(kind, F.lit(":"), key_fields["amount"])),
                      F.concat(kind, F.lit(":"), file_name))


def tags(kind: Column, entities: Column, risk_flags: Column, table_preview: Column,
         chart_signals: Column, ocr_text: Column) -> Column:
    """kind, entities, risks and shape/OCR markers, de-duplicated in order."""
    shape = F.array_compact(F.array(
        F.when(F.size(table_preview) > 0, F.lit("shape:table")),
        F.when(F.size(chart_signals) > 0, F.lit("shape:chart")),
        F.when(ocr_text != "", F.lit("has:ocr")),
    ))
    return F.array_distinct(F.concat(
        F.array(F.concat(F.lit("kind:"), kind)),
        F.transform(entities, lambda v: F.concat(F.lit("entity:"), v)),
        F.transform(risk_flags, lambda v: F.concat(F.lit("risk:"), v)),
        shape,
    ))


def save_hint_columns(kind: Column, tag_list: Column, confidence: Column) -> dict[str, Column]:
    """target, reason and confidence (floored per target)."""
    rules = [
        (kind.isin(R.RECEIPT, R.DOCUMENT), R.SAVE_DOCUMENT),
        ((kind == R.CHART) | F.array_contains(tag_list, "shape:chart"), R.SAVE_CHART),
        (kind == R.CHAT, R.SAVE_CHAT),
    ]
    target = reason = floor = None
    for cond, (t, why, fl) in rules:
        if target is None:
            target, reason, floor = F.when(cond, t), F.when(cond, why), F.when(cond, fl)
        else:
            target, reason, floor = target.when(cond, t), reason.when(cond, why), floor.when(cond, fl)
    t, why, fl = R.SAVE_NONE
    target, reason, floor = target.otherwise(t), reason.otherwise(why), floor.otherwise(fl)
    return {"save_target": target, "save_reason": reason,
            "save_confidence": F.greatest(floor.cast("double"), confidence)}


def with_handoff(analyses: DataFrame) -> DataFrame:
    """F1-F3 as columns ``title, tags, save_target, save_reason, save_confidence``.

    Failed rows get an empty title and tag list, target ``none``, no reason, 0.
    """
    df = analyses.withColumns(_title_tags())
    df = df.withColumns(_save_hints())
    return df.withColumns(_failure_handoff())


@per_context
def _title_tags() -> dict[str, Column]:
    c = F.col
    return {"title": title(c("kind"), c("key_fields"), c("source.file_name")),
            "tags": tags(c("kind"), c("entities"), c("risk_flags"), c("table_preview"), c("chart_signals"),
                         c("ocr_text"))}


@per_context
def _save_hints() -> dict[str, Column]:
    c = F.col
    return save_hint_columns(c("kind"), c("tags"), c("confidence"))


@per_context
def _failure_handoff() -> dict[str, Column]:
    c = F.col
    err = c("error")
    return {
        "title": F.when(err, F.lit("")).otherwise(c("title")),
        "tags": F.when(err, empty()).otherwise(c("tags")),
        "save_target": F.when(err, F.lit("none")).otherwise(c("save_target")),
        "save_reason": F.when(err, F.lit("")).otherwise(c("save_reason")),
        "save_confidence": F.when(err, F.lit(0.0)).otherwise(c("save_confidence")),
    }


def handoff_record() -> Column:
    """the nested handoff record of one analysed row."""
    c = F.col
    return F.struct(
        F.lit(R.HANDOFF_SCHEMA).alias("schema"),
        c("kind").alias("kind"),
        c("title").alias("title"),
        c("summary").alias("summary"),
        c("tags").alias("tags"),
        F.struct(c("save_target").alias("suggested_target"), c("save_reason").alias("reason"),
                 c("save_confidence").alias("confidence")).alias("save_hints"),
        F.struct(c("key_fields").alias("key_fields"), c("entities").alias("entities"),
                 c("ui_elements").alias("ui_elements"), c("risk_flags").alias("risk_flags"),
                 c("table_preview").alias("table_preview"),
                 c("chart_signals").alias("chart_signals")).alias("extracted"),
        c("source").alias("source"),
    )


def render_handoff() -> Column:
    """header line plus the record as JSON (compact; key fields that are absent are omitted)."""
    return F.concat(F.lit(R.HANDOFF_HEADER + "\n"), F.to_json(handoff_record()))
