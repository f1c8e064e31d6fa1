"""A4-A5: OCR payload JSON and nested message JSON, read with Variant functions.

Both stay in the JVM: ``try_parse_json`` gives a Variant; type tests use
``schema_of_variant`` so that, as in the reproduced rules, a number is *not* a
string (``from_json`` with a string schema would turn ``7`` into ``"7"``).

Of a key that an object holds twice the last value counts, at the place of the first.  Spark's Variant parser does so under the session
setting ``spark.sql.variant.allowDuplicateKeys``, which these functions turn on; it is the one setting that the library changes.
Variant sorts an object's keys, so the order of the document comes from ``from_json`` (a map, level by level), the types from Variant.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from capsight.functions import rules as R
from capsight.functions.text import js_trim
from capsight.operators.extract import empty


def _is_string(v: Column) -> Column:
    return F.coalesce(F.schema_of_variant(v) == "STRING", F.lit(False))


def _member(v: Column, path: str) -> Column:
    return F.try_variant_get(v, path, "variant")


def read_ocr_payloads(df: DataFrame, payload: str = "payload", default_provider: str = "ocr") -> DataFrame:
    """A4: parse ``{provider, text, lines: [{text, score|confidence}]}`` payloads.

    ``provider`` stays the engine that was run (a column of ``df``; without one it is ``default_provider``) and is what
    ``resolve_ocr`` ranks; ``reported_provider`` is the payload's own label (missing or empty: the provider).
    Non-string ``text`` -> ``''``; ``lines`` keeps the string ``text`` of each item and drops empty ones (blank but
    non-empty lines stay); of a key given twice the last value counts; an unparsable payload becomes a failed attempt with a
    warning.  A payload without text and lines gets the "returned no text" warning.
    Adds ``provider, reported_provider, text, lines, warnings``.
    """
    _allow_repeated_keys()
    ran = F.coalesce(F.col("provider"), F.lit(default_provider)) if "provider" in df.columns else F.lit(default_provider)
    label = ran
    for name, shown in R.OCR_PROVIDER_LABEL.items():
        label = F.when(ran == name, shown).otherwise(label)
    v = F.try_parse_json(F.col(payload))
    prov = _member(v, "$.provider")
    reported = F.when(_is_string(prov) & (F.try_variant_get(v, "$.provider", "string") != ""),
                      F.try_variant_get(v, "$.provider", "string")).otherwise(ran)
    text_v = _member(v, "$.text")
    text = F.when(_is_string(text_v), F.try_variant_get(v, "$.text", "string")).otherwise(F.lit(""))
    items = F.coalesce(F.try_variant_get(v, "$.lines", "array<variant>"), F.array().cast("array<variant>"))
    lines = F.filter(
        F.transform(items, lambda it: F.when(_is_string(_member(it, "$.text")),
                                             F.try_variant_get(it, "$.text", "string")).otherwise(F.lit(""))),
        lambda s: F.length(s) > 0)
    parsed = df.withColumn("_v", v).withColumn("_label", label)
    bad = F.col("_v").isNull()
    out = parsed.withColumns({
        "provider": ran,
        "reported_provider": F.when(bad, ran).otherwise(reported),
        "text": F.when(bad, F.lit("")).otherwise(text),
        "lines": F.when(bad, empty()).otherwise(lines),
    })
    no_text = (js_trim(F.col("text")) == "") & (F.size("lines") == 0)
    warnings = (F.when(bad, F.array(F.concat(F.col("_label"), F.lit(" failed: invalid JSON payload"))))
                .when(no_text, F.array(F.concat(F.col("_label"), F.lit(" returned no text")))).otherwise(empty()))
    return out.withColumn("warnings", warnings).drop("_v", "_label")


def _allow_repeated_keys() -> None:
    SparkSession.active().conf.set("spark.sql.variant.allowDuplicateKeys", "true")


def _bound(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _is_index(key: Column) -> Column:
    return key.rlike("^(?:0|[1-9][0-9]{0,9})$") & (key.try_cast("long") < 4_294_967_295)


def _in_order(raw: Column) -> Column:
    """``key, value`` of an object's members as ``Object.values`` gives them: index keys by number, then the others as they
    first appear; of equal keys the last value.  Values are text: strings as they are, containers as JSON.
    """
    def last_values(entries: Column) -> Column:
        keys = F.array_distinct(F.transform(entries, lambda e: e["key"]))
        return F.when(F.size(keys) == F.size(entries), entries).otherwise(
            F.transform(keys, lambda k: F.element_at(F.filter(entries, lambda e: e["key"] == k), -1)))

    def numbered_first(once: Column) -> Column:
        index = F.transform(F.filter(once, lambda e: _is_index(e["key"])), lambda e: F.struct(e["key"].try_cast("long").alias("at"), e.alias("e")))
        rest = F.filter(once, lambda e: ~_is_index(e["key"]))
        return F.when(F.size(rest) == F.size(once), once).otherwise(F.concat(F.transform(F.array_sort(index), lambda x: x["e"]), rest))

    return _bound(_bound(F.map_entries(F.from_json(raw, "map<string,string>")), last_values), numbered_first)


def _children_or_self(node: Column) -> Column:
    """One walk step: a container's children in order, or the value itself; nodes are ``raw`` text with its Variant ``v``."""
    items = F.try_variant_get(node["v"], "$", "array<variant>")
    members = F.try_variant_get(node["v"], "$", "map<string,variant>")
    listed = F.zip_with(F.from_json(node["raw"], "array<string>"), items, lambda raw, v: F.struct(raw.alias("raw"), v.alias("v")))
    named = F.transform(_in_order(node["raw"]), lambda e: F.struct(e["value"].alias("raw"), F.try_element_at(members, e["key"]).alias("v")))
    return F.when(items.isNotNull(), listed).when(members.isNotNull(), named).otherwise(F.array(node))


def with_message_leaves(messages: DataFrame, col: str, out: str, max_depth: int = R.MESSAGE_MAX_DEPTH) -> DataFrame:
    """Adds ``out``: all string leaves of the nested message ``col`` in order, depth <= ``max_depth``, as one array.

    Text that is no JSON document is one leaf, as it stands.  The walk replaces
    containers by their children in place, ``max_depth`` times, inside the row: no generator, no window, no row limit.
    Object members come in the order of the document (``_in_order``); containers below ``max_depth`` are left out.
    """
    _allow_repeated_keys()
    message = F.col(col)
    rows = messages.withColumn("_nodes", F.array(F.struct(message.alias("raw"), F.try_parse_json(message).alias("v"))))
    rows = rows.withColumn("_plain", F.col("_nodes")[0]["v"].isNull())
    for _ in range(int(max_depth)):  # a step a column: the analyzer resolves nested lambdas one by one
        rows = rows.withColumn("_nodes", F.flatten(F.transform("_nodes", _children_or_self)))
    texts = F.array_compact(F.transform("_nodes", lambda n: F.when(_is_string(n["v"]), F.try_variant_get(n["v"], "$", "string"))))
    leaves = F.when(message.isNull(), F.array().cast("array<string>")).when(F.col("_plain"), F.array(message)).otherwise(texts)
    return rows.withColumn(out, leaves).drop("_nodes", "_plain")


def message_chunks(messages: DataFrame, col: str = "message", max_depth: int = R.MESSAGE_MAX_DEPTH) -> DataFrame:
    """A5: one row per string leaf: ``conv_id, turn, chunk_pos, text`` (``chunk_pos``: order inside the message); narrow."""
    rows = with_message_leaves(messages.select("conv_id", "turn", col), col, "_leaves", max_depth)
    return rows.select("conv_id", "turn", F.posexplode("_leaves").alias("chunk_pos", "text"))
