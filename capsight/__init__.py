"""capsight: capture analysis as Spark DataFrame jobs.

Public entry points (all take and return DataFrames unless noted):

Sources and sinks
    image_listing(spark, path), admit(listing), unresolved_requests(requests, listing),
    read_ocr_payloads(df), message_chunks(messages), write_results(analyses, path),
    compact_results(spark, path, keep)
OCR attempts
    provider_order(provider, fallback) -> list, resolve_ocr(attempts, ...),
    with_resolved_ocr(captures, attempts, ...), clean_ocr(df), merge_warnings(*cols),
    extract_text(images, extractor | chain=[(provider, extractor), ...])
Analysis and handoff
    analyze(captures, vision=..., max_summary_chars=...), run_analysis(captures, attempts, ...),
    render_block() -> Column, with_handoff(analyses), handoff_record() -> Column,
    render_handoff() -> Column
Groups, context, incremental, reports
    compare_groups(handoffs), compared_members(handoffs), with_member_lists(compared, members), render_compare() -> Column,
    compare_lines(compared, members), similar_classes(handoffs),
    recent_media(messages), recent_media_by_turn(messages),
    context_entries(media, captures, attempts), conversation_context(entries),
    fingerprint(...) -> Column, analyze_incremental(captures, attempts, store),
    retain_newest(store, keep), kind_report(analyses), tag_report(analyses)
Streaming
    stream_analyze(stream), stream_dedupe(stream), dedupe_available_now(stream, folder) -> folder, stream_context(messages_stream),
    run_available_now(stream, folder) -> folder,
    latest_context(emitted)
Jobs over files
    analyze_folder(spark, folder, extractor), compare_requests(requests, analyses) -> (comparisons, members)
"""

from capsight.operators.analyze import analyze, render_block, run_analysis
from capsight.operators.compare import compare_groups, compare_lines, compared_members, render_compare, similar_classes, with_member_lists
from capsight.operators.context import (
    context_entries, conversation_context, recent_media, recent_media_by_turn,
)
from capsight.operators.handoff import handoff_record, render_handoff, with_handoff
from capsight.operators.incremental import analyze_incremental, fingerprint, retain_newest
from capsight.operators.ocr import (
    clean_ocr, extract_text, merge_warnings, provider_order, resolve_ocr, with_resolved_ocr,
)
from capsight.operators.reports import kind_report, tag_report
from capsight.plans.jobs import analyze_folder, compare_requests
from capsight.sources.listing import admit, image_listing, unresolved_requests
from capsight.sources.payloads import message_chunks, read_ocr_payloads
from capsight.sources.sinks import compact_results, write_results
from capsight.streaming.jobs import (
    dedupe_available_now, latest_context, run_available_now, stream_analyze, stream_context, stream_dedupe,
)

__all__ = [
    "admit", "analyze", "analyze_folder", "analyze_incremental", "clean_ocr", "compact_results", "compare_groups", "compare_lines", "compared_members",
    "compare_requests", "context_entries", "conversation_context", "dedupe_available_now", "extract_text", "fingerprint", "handoff_record", "image_listing",
    "kind_report", "latest_context", "merge_warnings", "message_chunks", "provider_order", "read_ocr_payloads",
    "recent_media", "recent_media_by_turn", "render_block", "render_compare", "render_handoff",
    "resolve_ocr", "retain_newest", "run_analysis", "run_available_now", "similar_classes", "stream_analyze", "stream_context", "stream_dedupe",
    "tag_report", "unresolved_requests", "with_handoff", "with_member_lists", "with_resolved_ocr", "write_results",
]
