"""Registered queries: one per operator of the inventory, each ``(spark, sf_dir) -> DataFrame``.

Every query reads the driver's tables (through ``capsight.sources.fixtures``)
and runs over all rows and whole texts.  Outputs are flat: lists are joined with
``|`` and numbers are cast to ``bigint`` / ``double`` so that the DuckDB oracle
(``capsight.plans.oracles``) can be compared value by value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from capsight.operators.analyze import analyze, key_fields_text, render_block
from capsight.operators.classify import SIGNAL_COLUMNS, classify
from capsight.operators.extract import extraction_columns
from capsight.operators.handoff import render_handoff, with_handoff
from capsight.sources import fixtures as fx

QUERIES: dict = {}


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def j(c: str | Column, sep: str = "|") -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return F.array_join(col, sep)


def _captures_ocr(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.with_ocr(fx.captures(spark, sf_dir))


def _classified(spark, sf_dir) -> DataFrame:
    return classify(_captures_ocr(spark, sf_dir))


def _extracted(spark, sf_dir) -> DataFrame:
    df = _classified(spark, sf_dir)
    c = F.col
    return df.withColumns(extraction_columns(c("kind"), c("reasons"), c("file_name"), c("ocr_text"), c("ocr_lines")))


def analyzed(spark, sf_dir) -> DataFrame:
    """Captures with OCR text as given, analysed, with handoff columns."""
    return with_handoff(analyze(_captures_ocr(spark, sf_dir)))


# --- C. classification --------------------------------------------------------

@query("c1_infer_mime")
def c1(spark, sf_dir):
    return fx.captures(spark, sf_dir).select("capture_id", "file_name", "mime_type")


@query("c2_classify_by_name")
def c2(spark, sf_dir):
    return _classified(spark, sf_dir).select("capture_id", "name_kind", "name_confidence", "name_reason")


@query("c3_text_signals")
def c3(spark, sf_dir):
    df = _classified(spark, sf_dir)
    cols = [F.col(c).cast("long").alias(c) if not c.startswith("has_") else F.col(c) for c in SIGNAL_COLUMNS]
    return df.select("capture_id", *cols)


@query("c4_classify_by_text")
def c4(spark, sf_dir):
    return _classified(spark, sf_dir).select("capture_id", "text_kind")


@query("c5_refine")
def c5(spark, sf_dir):
    return _classified(spark, sf_dir).select("capture_id", "kind", "confidence", j("reasons").alias("reasons"))


# --- D. extraction --------------------------------------------------------------

@query("d1_key_fields")
def d1(spark, sf_dir):
    df = _extracted(spark, sf_dir)
    return df.select("capture_id", "kind", *[F.col("key_fields")[k].alias(k) for k in
                                             ("title", "latest_time", "amount", "date", "phone", "email", "url")])


def _list_query(*cols):
    def run(spark, sf_dir):
        df = _extracted(spark, sf_dir)
        return df.select("capture_id", "kind", *[j(c).alias(c) for c in cols])
    return run


QUERIES["d2_risk_flags"] = _list_query("risk_flags")
QUERIES["d3_entities"] = _list_query("entities")
QUERIES["d4_ui_layout"] = _list_query("ui_elements", "layout_hints")
QUERIES["d5_table_hints"] = _list_query("table_hints")
QUERIES["d6_chart_hints"] = _list_query("chart_hints")
QUERIES["d7_table_preview"] = _list_query("table_preview")
QUERIES["d8_chart_signals"] = _list_query("chart_signals")


@query("d9_summary")
def d9(spark, sf_dir):
    return _extracted(spark, sf_dir).select("capture_id", F.col("vision_summary").alias("summary"))


# --- E. normalize, render, analyze ---------------------------------------------

@query("e1_normalize")
def e1(spark, sf_dir):
    df = analyzed(spark, sf_dir)
    return df.select("capture_id", "summary", "ocr_text", j("warnings").alias("warnings"),
                     F.col("source.file_name").alias("source_file_name"),
                     F.col("source.mime_type").alias("source_mime_type"),
                     F.col("source.size_bytes").alias("source_size_bytes"))


@query("e2_render_block")
def e2(spark, sf_dir):
    return analyzed(spark, sf_dir).select("capture_id", render_block().alias("image_block"))


@query("e3_analyze_disabled")
def e3_disabled(spark, sf_dir):
    df = with_handoff(analyze(_captures_ocr(spark, sf_dir), vision="disabled"))
    return df.select("capture_id", "kind", "summary", j("warnings").alias("warnings"), "title", j("tags").alias("tags"))


# --- F. handoff -----------------------------------------------------------------

@query("f1_title")
def f1(spark, sf_dir):
    return analyzed(spark, sf_dir).select("capture_id", "title")


@query("f2_tags")
def f2(spark, sf_dir):
    return analyzed(spark, sf_dir).select("capture_id", j("tags").alias("tags"))


@query("f3_save_hints")
def f3(spark, sf_dir):
    return analyzed(spark, sf_dir).select("capture_id", "save_target", "save_reason", "save_confidence")


@query("f4_handoff")
def f4(spark, sf_dir):
    df = analyzed(spark, sf_dir)
    return df.select(
        "capture_id", "kind", "title", "summary", j("tags").alias("tags"), "save_target", "save_confidence",
        key_fields_text(F.col("key_fields")).alias("key_fields"),
        *[j(c).alias(c) for c in ("entities", "ui_elements", "risk_flags", "table_preview", "chart_signals")],
        F.col("source.file_name").alias("source_file_name"),
        F.col("source.mime_type").alias("source_mime_type"),
        F.col("source.size_bytes").alias("source_size_bytes"),
    )


@query("f5_render_handoff")
def f5(spark, sf_dir):
    return analyzed(spark, sf_dir).select("capture_id", render_handoff().alias("handoff_block"))


# --- A. sources -------------------------------------------------------------------

@query("a2_admit")
def a2(spark, sf_dir):
    from capsight.sources.listing import admit
    df = admit(fx.captures(spark, sf_dir))
    return df.select("capture_id", "file_path", "mime_type", "error", "message")


def media_requests(spark, sf_dir) -> DataFrame:
    """Every media path named in any message (with repeats)."""
    from capsight.operators.context import media_mentions
    return media_mentions(fx.messages(spark, sf_dir))


@query("a3_unresolved_requests")
def a3(spark, sf_dir):
    from capsight.sources.listing import unresolved_requests
    return unresolved_requests(media_requests(spark, sf_dir), fx.captures(spark, sf_dir))


# --- B. OCR attempts ------------------------------------------------------------

def _ocr_out(df: DataFrame) -> DataFrame:
    return df.select("capture_id", "ocr_provider", "ocr_text", j("ocr_lines", "\n").alias("ocr_lines"),
                     j("ocr_warnings").alias("ocr_warnings"), "ocr_elapsed_ms")


@query("b1_resolve_ocr")
def b1(spark, sf_dir):
    from capsight.operators.ocr import resolve_ocr
    return _ocr_out(resolve_ocr(fx.attempts(spark, sf_dir), timeout_ms=None))


@query("b1_repeated_attempts")
def b1_repeated(spark, sf_dir):
    """B1 with retries: the first success wins, earlier failures of the same provider leave their warnings."""
    from capsight.operators.ocr import resolve_ocr
    return _ocr_out(resolve_ocr(fx.repeated_attempts(spark, sf_dir), timeout_ms=None))


@query("b1_from_payloads")
def b1_payloads(spark, sf_dir):
    """A4 then B1: payloads (malformed, relabelled, numeric) parsed and resolved."""
    from capsight.operators.ocr import resolve_ocr
    from capsight.sources.payloads import read_ocr_payloads
    return _ocr_out(resolve_ocr(read_ocr_payloads(fx.ocr_payloads(spark, sf_dir)), timeout_ms=None))


def _budget(ms):
    def run(spark, sf_dir):
        from capsight.operators.ocr import resolve_ocr
        return _ocr_out(resolve_ocr(fx.attempts(spark, sf_dir), timeout_ms=ms))
    return run


for _ms in (30000, 5000, 1000):
    QUERIES[f"b2_resolve_ocr_budget_{_ms}"] = _budget(_ms)


@query("b3_provider_order_paddleocr")
def b3(spark, sf_dir):
    from capsight.operators.ocr import resolve_ocr
    return _ocr_out(resolve_ocr(fx.attempts(spark, sf_dir), provider="paddleocr"))


@query("b3_provider_disabled")
def b3_disabled(spark, sf_dir):
    from capsight.operators.ocr import with_resolved_ocr
    return _ocr_out(with_resolved_ocr(fx.captures(spark, sf_dir), None, provider="disabled"))


@query("b4_clean_ocr")
def b4(spark, sf_dir):
    from capsight.operators.ocr import clean_ocr
    df = clean_ocr(fx.attempts(spark, sf_dir).withColumn("lines", F.split("text", "\n")))
    return df.select("capture_id", "provider", "clean_text", "lines_text")


@query("b5_merge_warnings")
def b5(spark, sf_dir):
    from capsight.operators.ocr import merge_warnings
    df = fx.attempts(spark, sf_dir)
    extra = F.array(F.when(F.col("elapsed_ms") > 8000, F.lit("slow attempt")), F.lit(" "),
                    F.concat(F.lit("elapsed "), F.col("elapsed_ms").cast("string")), F.lit("a"), F.lit("b"),
                    F.lit("c"), F.lit("d"))
    extra = F.array_compact(extra)
    return df.select("capture_id", "provider",
                     j(merge_warnings(F.col("warnings"), extra)).alias("all_warnings"),
                     j(merge_warnings(F.col("warnings"), extra, limit=5)).alias("first_warnings"))


# --- E3. the whole analysis job ---------------------------------------------------

def analysis_job(spark, sf_dir, **kw) -> DataFrame:
    from capsight.operators.analyze import run_analysis
    return run_analysis(fx.captures(spark, sf_dir), fx.attempts(spark, sf_dir), **kw)


def flat_analysis(df: DataFrame, *extra) -> DataFrame:
    return df.select(*extra,
        "capture_id", "error", "message", "kind", "confidence", j("reasons").alias("reasons"), "summary",
        "ocr_provider", "ocr_text", j("warnings").alias("warnings"),
        *[j(c).alias(c) for c in ("entities", "ui_elements", "risk_flags", "layout_hints", "table_hints",
                                  "chart_hints", "table_preview", "chart_signals")],
        key_fields_text(F.col("key_fields")).alias("key_fields"),
        "title", j("tags").alias("tags"), "save_target", "save_confidence",
    )


@query("e3_analyze")
def e3(spark, sf_dir):
    return flat_analysis(analysis_job(spark, sf_dir))


# --- G. group comparison ------------------------------------------------------------

def _facts(df: DataFrame) -> DataFrame:
    return df.select("group_id", F.col("n_members").cast("long").alias("n_members"), "summary", "same_kind",
                     j("kinds", ", ").alias("kinds"), j("similarities", " | ").alias("similarities"),
                     j("differs_in", " | ").alias("differs_in"), "save_recommendation")


def compared(spark, sf_dir) -> DataFrame:
    from capsight.operators.compare import compare_groups
    return compare_groups(analysis_job(spark, sf_dir))


def compared_whole(spark, sf_dir) -> DataFrame:
    """Comparisons with their members' lists, as the text block shows them; the analysis runs once."""
    from capsight.operators.compare import compare_groups, compared_members, members, with_member_lists
    from capsight.session import write_scratch
    rows = write_scratch(members(analysis_job(spark, sf_dir)), "compare")
    return with_member_lists(compare_groups(rows), compared_members(rows))


@query("g1_compare_groups")
def g1(spark, sf_dir):
    return _facts(compared(spark, sf_dir))


@query("g1_compared_members")
def g1_members(spark, sf_dir):
    """The compared records in long form, one row per member."""
    from capsight.operators.compare import compared_members
    return compared_members(analysis_job(spark, sf_dir))


@query("g1_compare_requests")
def g1_requests(spark, sf_dir):
    """G1 from (group_id, pos, file_path) requests joined to the analyses by path."""
    from capsight.plans.jobs import compare_requests
    req = fx.captures(spark, sf_dir).select("group_id", "pos", "file_path")
    return _facts(compare_requests(req, analysis_job(spark, sf_dir))[0])


@query("g2_shared_values")
def g2(spark, sf_dir):
    df = compared(spark, sf_dir)
    return df.select("group_id", j("shared_entities", ", ").alias("shared_entities"),
                     j("shared_tags", ", ").alias("shared_tags"))


@query("g3_differences")
def g3(spark, sf_dir):
    return compared_whole(spark, sf_dir).select("group_id", j("differences", " | ").alias("differences"))


@query("g4_save_recommendation")
def g4(spark, sf_dir):
    return compared(spark, sf_dir).select("group_id", "save_recommendation")


@query("g5_render_compare")
def g5(spark, sf_dir):
    from capsight.operators.compare import render_compare
    return compared_whole(spark, sf_dir).select("group_id", render_compare().alias("compare_block"))


@query("g5_compare_lines")
def g5_lines(spark, sf_dir):
    """The comparison blocks as numbered pieces, no row holding a group."""
    from capsight.operators.compare import compare_groups, compare_lines, compared_members, members
    from capsight.session import write_scratch
    rows = write_scratch(members(analysis_job(spark, sf_dir)), "compare")
    return compare_lines(compare_groups(rows), compared_members(rows))


@query("g6_similar_classes")
def g6(spark, sf_dir):
    """Similarity of the captures of 24 documents' groups, by their distinct tag sets."""
    from capsight.operators.compare import similar_classes
    rows = analysis_job(spark, sf_dir).select(F.floor(F.col("capture_id") / 24).alias("group_id"), "tags")
    df = similar_classes(rows)
    return df.select("group_id", j("tags").alias("tags"), "n_members", "n_linked", j("best_tags").alias("best_tags"), "best_similarity")


# --- H. recent-media context -----------------------------------------------------------

@query("h1_recent_media")
def h1(spark, sf_dir):
    from capsight.operators.context import recent_media
    return recent_media(fx.messages(spark, sf_dir))


@query("h1_recent_media_3_2")
def h1_small(spark, sf_dir):
    from capsight.operators.context import recent_media
    return recent_media(fx.messages(spark, sf_dir), max_messages=3, max_images=2)


@query("h1_recent_media_nested")
def h1_nested(spark, sf_dir):
    """H1 over nested messages, some without any text: the last messages are chosen before their leaves are walked."""
    from capsight.operators.context import recent_media
    return recent_media(fx.nested_messages(spark, sf_dir), nested="message")


def epoch_messages(spark, sf_dir) -> DataFrame:
    """Turns in epoch milliseconds, three messages a turn; a third of the conversations are one."""
    msgs = fx.messages(spark, sf_dir)
    place = F.when(F.col("conv_id") % 3 == 0, F.col("conv_id") * 40 + F.col("turn")).otherwise(F.col("turn"))
    return msgs.withColumns({"turn": F.lit(1_704_067_200_000) + F.floor(place / 3) * 60_000,
                             "conv_id": F.when(F.col("conv_id") % 3 == 0, F.lit(-1)).otherwise(F.col("conv_id")).cast("long")})


@query("h1_epoch_ties")
def h1_ties(spark, sf_dir):
    from capsight.operators.context import recent_media
    return recent_media(epoch_messages(spark, sf_dir))


@query("h2_epoch_ties")
def h2_ties(spark, sf_dir):
    """H2 on the same messages, the large conversation in blocks of 64 places."""
    from capsight.operators.context import recent_media_by_turn
    return recent_media_by_turn(epoch_messages(spark, sf_dir), range_rows=64)


@query("h2_gapped")
def h2_gapped(spark, sf_dir):
    """H2 on turns with gaps."""
    from capsight.operators.context import recent_media_by_turn
    gapped = fx.messages(spark, sf_dir).withColumn("turn", F.col("turn") * F.col("turn") * 3 + F.col("conv_id") % 5)
    return recent_media_by_turn(gapped)


@query("h2_recent_media_by_turn")
def h2(spark, sf_dir):
    from capsight.operators.context import recent_media_by_turn
    return recent_media_by_turn(fx.messages(spark, sf_dir))


@query("h2_recent_media_by_turn_3_2")
def h2_small(spark, sf_dir):
    from capsight.operators.context import recent_media_by_turn
    return recent_media_by_turn(fx.messages(spark, sf_dir), max_messages=3, max_images=2)


def entries(spark, sf_dir) -> DataFrame:
    from capsight.operators.context import context_entries, recent_media
    media = recent_media(fx.messages(spark, sf_dir))
    return context_entries(media, fx.captures(spark, sf_dir), fx.attempts(spark, sf_dir))


@query("h3_context_entries")
def h3(spark, sf_dir):
    return entries(spark, sf_dir)


@query("h4_conversation_context_by_turn")
def h4_by_turn(spark, sf_dir):
    """The context text as of every turn (what the prompt hook yields over time)."""
    from capsight.operators.context import context_entries, conversation_context, recent_media_by_turn
    media = recent_media_by_turn(fx.messages(spark, sf_dir))
    ent = context_entries(media, fx.captures(spark, sf_dir), fx.attempts(spark, sf_dir))
    df = conversation_context(ent, keys=("conv_id", "turn"))
    return df.select("conv_id", "turn", F.col("n_entries").cast("long").alias("n_entries"), "context")


@query("h4_conversation_context")
def h4(spark, sf_dir):
    from capsight.operators.context import conversation_context
    df = conversation_context(entries(spark, sf_dir))
    return df.select("conv_id", F.col("n_entries").cast("long").alias("n_entries"), "context")


# --- I. incremental processing ---------------------------------------------------------

@query("i1_fingerprint")
def i1(spark, sf_dir):
    from capsight.operators.incremental import with_fingerprint
    return with_fingerprint(fx.captures(spark, sf_dir)).select("capture_id", "fingerprint")


def earlier_store(spark, sf_dir) -> DataFrame:
    """The result table an earlier run wrote (it had seen every third capture).

    Written to the shared checkpoint folder and read back, as a later run finds it.
    """
    import uuid
    from capsight.operators.analyze import run_analysis
    from capsight.operators.incremental import with_fingerprint
    from capsight.session import scratch_path
    from capsight.sources.sinks import read_results, write_results
    caps = with_fingerprint(fx.captures(spark, sf_dir))
    seen = caps.where(F.col("capture_id") % 3 == 0)
    path = scratch_path(spark, f"stores/{uuid.uuid4().hex[:12]}")
    write_results(run_analysis(seen, fx.attempts(spark, sf_dir)), path, F.col("modified_ms") + 5000)
    return read_results(spark, path)


@query("i2_analyze_incremental")
def i2(spark, sf_dir):
    from capsight.operators.incremental import analyze_incremental
    results, _ = analyze_incremental(fx.captures(spark, sf_dir), fx.attempts(spark, sf_dir),
                                     earlier_store(spark, sf_dir))
    return flat_analysis(results, "fingerprint", "from_store")


@query("i2_duplicate_captures")
def i2_duplicates(spark, sf_dir):
    """I2 where every 7th capture is requested twice under another id: each request gets a row."""
    from capsight.operators.incremental import analyze_incremental
    caps = fx.captures(spark, sf_dir)
    again = caps.where(F.col("capture_id") % 7 == 0).withColumn("capture_id", F.col("capture_id") + 1_000_000_000)
    results, _ = analyze_incremental(caps.unionByName(again), fx.attempts(spark, sf_dir), earlier_store(spark, sf_dir))
    return flat_analysis(results, "fingerprint", "from_store")


@query("i3_retain_newest")
def i3(spark, sf_dir):
    from capsight.operators.analyze import run_analysis
    from capsight.operators.incremental import retain_newest, to_store_rows, with_fingerprint
    an = run_analysis(with_fingerprint(fx.captures(spark, sf_dir)), fx.attempts(spark, sf_dir))
    store = to_store_rows(an, F.col("modified_ms"))
    return retain_newest(store, 64).select("fingerprint", "capture_id", "analyzed_ms")


@query("i3_compacted_store")
def i3_compacted(spark, sf_dir):
    """The store after two runs, compacted to its 64 newest rows and read back."""
    import uuid
    from capsight.operators.analyze import run_analysis
    from capsight.operators.incremental import with_fingerprint
    from capsight.session import scratch_path, write_scratch
    from capsight.sources.sinks import compact_results, write_results
    an = write_scratch(run_analysis(with_fingerprint(fx.captures(spark, sf_dir)), fx.attempts(spark, sf_dir)), "analyses")
    path = scratch_path(spark, f"stores/{uuid.uuid4().hex[:12]}")
    write_results(an.where(F.col("capture_id") % 2 == 0), path, F.col("modified_ms"))
    write_results(an, path, F.col("modified_ms"))
    return compact_results(spark, path, 64).select("fingerprint", "capture_id", "analyzed_ms")


# --- K. reports ----------------------------------------------------------------------------

@query("k1_kind_report")
def k1(spark, sf_dir):
    from capsight.operators.reports import kind_report
    df = kind_report(analysis_job(spark, sf_dir))
    return df.select("kind", "save_target", F.col("level").cast("long").alias("level"), "n_captures",
                     F.col("n_failed").cast("long").alias("n_failed"),
                     F.round("mean_confidence", 6).alias("mean_confidence"))


@query("k2_tag_report")
def k2(spark, sf_dir):
    from capsight.operators.reports import tag_report
    return tag_report(analysis_job(spark, sf_dir))


# --- A1, A4-A6, B6: files, payloads, sinks --------------------------------------------

@query("a1_image_listing")
def a1(spark, sf_dir):
    """The documents' texts written as one file per 64 ids, then listed by metadata only and admitted."""
    import uuid
    from capsight.session import scratch_path
    from capsight.sources.listing import admit, image_listing
    path = scratch_path(spark, f"files/{uuid.uuid4().hex[:12]}")
    docs = fx.table(spark, sf_dir, "documents").select("text", F.floor(F.col("doc_id") / 64).alias("bucket"))
    docs.repartition("bucket").write.partitionBy("bucket").text(path)
    df = admit(image_listing(spark, path, glob="*.txt"))
    bucket = F.regexp_extract("file_path", "/bucket=([0-9]+)/part-", 1).cast("long")
    return df.select(bucket.alias("bucket"), F.regexp_extract("file_name", r"([.][^.]*)$", 1).alias("suffix"), "mime_type", "size_bytes",
                     F.split("message", ":")[0].alias("message"))


@query("a4_read_ocr_payloads")
def a4(spark, sf_dir):
    from capsight.sources.payloads import read_ocr_payloads
    df = read_ocr_payloads(fx.ocr_payloads(spark, sf_dir))
    return df.select("capture_id", "provider", F.col("attempt_no").cast("long").alias("attempt_no"), "reported_provider", "text", j("lines", "\n").alias("lines"),
                     j("warnings").alias("warnings"))


@query("a5_message_chunks")
def a5(spark, sf_dir):
    from capsight.sources.payloads import message_chunks
    return message_chunks(fx.nested_messages(spark, sf_dir))


@query("a6_write_results")
def a6(spark, sf_dir):
    """Analyse, append the successful rows to a fresh result table, read it back."""
    import uuid
    from capsight.operators.analyze import run_analysis
    from capsight.operators.incremental import with_fingerprint
    from capsight.session import scratch_path, write_scratch
    from capsight.sources.sinks import read_results, write_results
    an = write_scratch(run_analysis(with_fingerprint(fx.captures(spark, sf_dir)), fx.attempts(spark, sf_dir)), "analyses")
    path = scratch_path(spark, f"results/{uuid.uuid4().hex[:12]}")
    write_results(an, path, F.col("modified_ms"))
    write_results(an, path, F.col("modified_ms"))  # a rerun adds nothing
    return read_results(spark, path).select("capture_id", "fingerprint", "kind", "title", "schema_id", "analyzed_ms")


@query("a6_json_results")
def a6_json(spark, sf_dir):
    """The JSON form of every analysis."""
    from capsight.sources.sinks import as_json
    cols = ["kind", "confidence", "summary", "ocr_text", "entities", "risk_flags", "warnings", "error"]
    return analyzed(spark, sf_dir).select("capture_id", as_json(cols).alias("json"))


@query("b6_extract_text")
def b6(spark, sf_dir):
    """A user text extractor over capture bytes (here: UTF-8 bytes of the document text)."""
    from capsight.operators.ocr import extract_text, utf8_extractor
    images = fx.captures(spark, sf_dir).select("capture_id", "file_path", F.encode("ocr_text", "UTF-8").alias("content"))
    out = extract_text(images, utf8_extractor, provider="utf8")
    return out.select("capture_id", "ocr_provider", "ocr_text", F.size("ocr_lines").alias("n_lines"),
                      j("ocr_warnings").alias("ocr_warnings"))


@query("b6_extractor_chain")
def b6_chain(spark, sf_dir):
    """Two extractors in turn over the capture bytes: the second only where the first gives no text."""
    from capsight.operators.ocr import extract_text, utf8_extractor
    images = fx.captures(spark, sf_dir).select("capture_id", "file_path", F.encode("ocr_text", "UTF-8").alias("content"))
    out = extract_text(images, chain=[("paddleocr", fx.png_extractor), ("utf8", utf8_extractor)], timeout_ms=60_000)
    return out.select("capture_id", "ocr_provider", "ocr_text", F.size("ocr_lines").alias("n_lines"),
                      j("ocr_warnings").alias("ocr_warnings"))


# --- J. streaming ------------------------------------------------------------------

def _once(name: str) -> str:
    """A folder of its own for a run that is not resumed."""
    import uuid
    return f"{name}-{uuid.uuid4().hex[:12]}"


def _doc_stream(spark, sf_dir):
    from capsight.streaming.jobs import file_stream
    return file_stream(spark, sf_dir, fx.table(spark, sf_dir, "documents"), glob="documents.parque[t]")


@query("j1_stream_analyze")
def j1(spark, sf_dir):
    from capsight.streaming.jobs import run_available_now, stream_analyze
    caps = fx.with_ocr(fx.captures_from(_doc_stream(spark, sf_dir)))
    out = run_available_now(flat_analysis(stream_analyze(caps)), _once("analyze"))
    return spark.read.parquet(out)


@query("j2_stream_dedupe")
def j2(spark, sf_dir):
    """Every capture arrives twice, in any of three batches or more; each fingerprint is analysed once."""
    from capsight.streaming.jobs import arriving, dedupe_available_now, stream_analyze
    docs = fx.table(spark, sf_dir, "documents")
    twice = docs.withColumn("arrival", F.explode(F.array(F.lit(1), F.lit(2))))
    caps = fx.captures_from(arriving(twice, "captures").drop("arrival"))
    out = dedupe_available_now(caps, _once("dedupe"), lambda rows: flat_analysis(stream_analyze(fx.with_ocr(rows)), "fingerprint"))
    return spark.read.parquet(out)


@query("j3_stream_context")
def j3(spark, sf_dir):
    """Messages arrive out of order in three batches or more; the result is H1 of all."""
    from capsight.streaming.jobs import arriving, latest_context, run_available_now, stream_context
    conv = arriving(fx.table(spark, sf_dir, "conversations"), "messages")
    out = run_available_now(stream_context(fx.messages_from(conv)), _once("context"))
    return latest_context(spark.read.parquet(out))


@query("j3_epoch_ties")
def j3_ties(spark, sf_dir):
    """J3 on turns in epoch milliseconds with ties, one conversation holding a third of all messages."""
    from capsight.streaming.jobs import arriving, latest_context, run_available_now, stream_context
    out = run_available_now(stream_context(arriving(epoch_messages(spark, sf_dir), "epochs")), _once("epochs"))
    return latest_context(spark.read.parquet(out))
