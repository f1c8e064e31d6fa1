"""H1-H4: recent media of every conversation and the context text built from it.

``messages`` is ``(conv_id, turn, role, text)``; ``turn`` orders the messages of a conversation and may have gaps and ties.
Messages of one turn are ordered by their text (null first), in H1, H2 and the streams alike.

Plans:

* H1 ``recent_media``: ``row_number() <= max_messages`` per conversation, which
  Spark runs as a partial ``WindowGroupLimit`` *before* the shuffle, so even a
  conversation holding a third of all messages sends at most ``max_messages``
  rows per map task.  The few rows of a conversation become one list of paths in the same partition.
* H2 ``recent_media_by_turn``: a window over the last ``max_messages`` rows of each message, one shuffle.  Conversations of more than
  ``range_rows`` messages are dealt into blocks of places first; a block also gets the ``max_messages - 1`` rows before it.
  Places come from sampled range boundaries on (conversation, turn, text), counts per range and running offsets, whatever
  the turns' values are.
* H3 ``context_entries``: the media list and the newest capture per path are written once; analyses only of the referenced
  captures, joined back on ``file_path``; AQE broadcasts the analysis side
  when its runtime size is under the broadcast threshold, else sort-merge with skewed paths split.
* H4 ``conversation_context``: per conversation at most ``max_images`` entries.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from capsight.functions import rules as R
from capsight.functions.text import W, js_trim
from capsight.session import write_scratch
from capsight.sources.listing import base_name

MEDIA_JAVA = R.MEDIA_PATH_PATTERN.replace("{W}", W)


RANGE_ROWS = 65_536  # messages of one range, and of one block of a large conversation


def _order(messages: DataFrame) -> list[str]:
    return ["turn", "text"] if "text" in messages.columns else ["turn"]


def with_positions(messages: DataFrame, range_rows: int = RANGE_ROWS, key: str = "conv_id", order: Sequence[str] | None = None) -> DataFrame:
    """Adds ``position``: the 0-based place of the message in its conversation (ties on ``turn``: by text, null first).

    ``key`` and ``order`` number the rows of any other table alike.

    Ranges are cut at boundaries that Spark samples from the rows, so they hold about ``range_rows`` each for any values of
    ``turn``, and are written once, since their boundaries must not move.
    """
    order = list(order or _order(messages))
    ranges = max(1, -(-messages.count() // range_rows))
    ranged = write_scratch(messages.repartitionByRange(ranges, key, *order).withColumn("_range", F.spark_partition_id()), "ranges")
    counts = ranged.groupBy(key, "_range").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.partitionBy(key).orderBy("_range")) - F.col("_n")  # one row per range of a conversation
    offsets = counts.select(key, "_range", before.alias("_before"))
    inside = F.row_number().over(Window.partitionBy(key, "_range").orderBy(*order))
    return (ranged.withColumn("_inside", inside).join(offsets, [key, "_range"])
            .withColumn("position", (F.col("_before") + F.col("_inside") - 1).cast("long")).drop("_range", "_inside", "_before"))


def mention_paths(text: Column) -> Column:
    """All media-marker paths of a text, left to right (untrimmed)."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(MEDIA_JAVA), 1)


def media_mentions(messages: DataFrame, text: str = "text") -> DataFrame:
    """One row per media mention: ``conv_id, turn, idx, file_path`` (idx is 0-based, left to right)."""
    m = messages.select("conv_id", "turn", F.posexplode(mention_paths(F.col(text))).alias("idx", "raw"))
    return m.select("conv_id", "turn", "idx", js_trim(F.col("raw")).alias("file_path")).where(F.col("file_path") != "")


def _trimmed_paths(text: Column) -> Column:
    """The media paths of one text, left to right, trimmed and without blanks."""
    return F.filter(F.transform(mention_paths(text), js_trim), lambda p: p != "")


def _current(newest_first: Column, max_images: int) -> Column:
    """The first ``max_images`` distinct paths of lists that stand newest first, in reverse."""
    return F.reverse(F.slice(F.array_distinct(F.flatten(newest_first)), 1, max_images))


def recent_media(messages: DataFrame, max_messages: int = R.MAX_RECENT_MESSAGES,
                 max_images: int = R.MAX_IMAGE_COUNT, nested: str | None = None) -> DataFrame:
    """H1: ``conv_id, media_pos, file_path`` for the latest turn of every conversation.

    Scan newest message first, left to right inside a message; the first sighting
    of a path counts; stop at ``max_images``; positions run oldest-first (the
    reversed scan order).  Conversations with no media give no rows.

    ``nested`` names a column of nested messages (A5): the last ``max_messages`` messages are chosen first, whether they
    hold text or not, and only then walked; each string leaf is scanned on its own, in order.
    """
    from capsight.sources.payloads import with_message_leaves
    if max_messages <= 0 or max_images <= 0:
        raise ValueError("max_messages and max_images must be > 0")
    w = Window.partitionBy("conv_id").orderBy(F.col("turn").desc(), F.col(nested or "text").desc())
    recent = messages.withColumn("_recency", F.row_number().over(w)).where(F.col("_recency") <= max_messages)
    paths = _trimmed_paths(F.col("text"))
    if nested:
        recent = with_message_leaves(recent, nested, "_leaves")
        paths = F.flatten(F.transform("_leaves", _trimmed_paths))
    seen = F.sort_array(F.collect_list(F.struct(F.col("_recency").alias("recency"), paths.alias("paths"))))
    lists = recent.groupBy("conv_id").agg(seen.alias("_seen"))  # at most max_messages rows, already together
    current = _current(F.transform("_seen", lambda m: m["paths"]), max_images)
    return lists.select("conv_id", F.posexplode(current).alias("_at", "file_path")).select("conv_id", (F.col("_at") + 1).alias("media_pos"), "file_path")


def _blocks(messages: DataFrame, reach: int, range_rows: int) -> DataFrame:
    """``messages`` with ``_block``, ``_own`` and ``_place`` (tells equal rows apart): a window over ``reach`` rows never leaves the block of a row of its own.

    Conversations of at most ``range_rows`` messages are one block.  The rows of others are numbered and also go to the blocks
    of the rows that look back at them, and one row ahead.
    """
    large = messages.groupBy("conv_id").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > range_rows).select("conv_id")
    whole = messages.withColumns({"_block": F.lit(0).cast("long"), "_own": F.lit(True), "_place": F.lit(0).cast("long")})
    if large.isEmpty():
        return whole
    large = write_scratch(large, "large")  # at most one row for every range_rows messages
    size = max(range_rows, reach)
    placed = with_positions(messages.join(large, "conv_id", "left_semi"), range_rows)
    own = F.floor(F.col("position") / size)
    seen = F.array_distinct(F.array(own, F.floor((F.col("position") + reach - 1) / size), F.floor((F.col("position") - 1) / size)))
    copies = placed.withColumn("_block", F.explode(seen)).withColumn("_own", F.col("_block") == own).where("_block >= 0")
    return whole.join(large, "conv_id", "left_anti").unionByName(copies.withColumnRenamed("position", "_place"))


def recent_media_by_turn(messages: DataFrame, max_messages: int = R.MAX_RECENT_MESSAGES,
                         max_images: int = R.MAX_IMAGE_COUNT, range_rows: int = RANGE_ROWS) -> DataFrame:
    """H2: ``conv_id, turn, media_pos, file_path``: H1 as of every turn of every conversation, after the turn's last message."""
    if max_messages <= 0 or max_images <= 0:
        raise ValueError("max_messages and max_images must be > 0")
    rows = _blocks(messages.select("conv_id", "turn", "text"), max_messages, range_rows)
    rows = rows.withColumn("_paths", _trimmed_paths(F.col("text")))
    turn = Window.partitionBy("conv_id", "_block").orderBy("turn", "text", "_place")
    rows = rows.withColumns({"_seen": F.collect_list("_paths").over(turn.rowsBetween(1 - max_messages, Window.currentRow)),
                             "_next": F.lead("turn").over(turn)})
    last = rows.where(F.col("_own") & ~F.col("_next").eqNullSafe(F.col("turn")))
    current = _current(F.reverse("_seen"), max_images)
    return (last.select("conv_id", "turn", F.posexplode(current).alias("_at", "file_path"))
            .select("conv_id", "turn", (F.col("_at") + 1).alias("media_pos"), "file_path"))


def context_timeout_ms(ocr_timeout_ms: int = R.OCR_TIMEOUT_MS) -> int:
    """Per-image time limit of the context step: max(3000, min(ocr timeout, 12000))."""
    return max(R.CONTEXT_MIN_TIMEOUT_MS, min(ocr_timeout_ms, R.CONTEXT_MAX_TIMEOUT_MS))


def failed_entry(path: Column, detail: Column) -> Column:
    return F.concat(F.lit("[Image]\nKind: analysis_failed\nSummary: Failed to analyze "), base_name(path),
                    F.lit(".\nWarnings: "), detail)


def timed_out_entry(path: Column, limit_ms: int) -> Column:
    return F.concat(F.lit("[Image]\nKind: analysis_timed_out\nSummary: Auto image analysis timed out for "),
                    base_name(path), F.lit(f"; continuing without OCR-backed context.\nWarnings: auto_context_timeout_{limit_ms}ms"))


def context_entries(media: DataFrame, captures: DataFrame, attempts: DataFrame | None,
                    ocr_timeout_ms: int = R.OCR_TIMEOUT_MS, **analysis_kw) -> DataFrame:
    """H3: one text entry per media row.

    The referenced captures are analysed with the context hint (only those: a semi-join first; of several captures
    with one path the newest, ties to the larger id); both lists are written to the shared folder once.  A successful analysis gives its image block plus the
    handoff block; a failed or missing one an ``analysis_failed`` block; an
    analysis whose OCR time exceeds the context limit an ``analysis_timed_out``
    block.  ``attempts=None``: the captures carry their OCR columns.  Output: media columns + ``status, entry``.
    """
    from capsight.operators.analyze import render_block, run_analysis
    from capsight.operators.handoff import render_handoff

    limit = context_timeout_ms(ocr_timeout_ms)
    media = write_scratch(media, "context/media")
    paths = media.select("file_path").distinct()
    newest = (captures.select("file_path", "modified_ms", "capture_id").join(paths, "file_path", "left_semi")
              .groupBy("file_path").agg(F.max(F.struct("modified_ms", "capture_id")).alias("_n")))
    newest = write_scratch(newest.select(F.col("_n.capture_id").alias("capture_id")), "context/newest")
    wanted = captures.join(newest, "capture_id", "left_semi").withColumn("hint", F.lit(R.CONTEXT_HINT))
    if attempts is not None:
        # OCR is resolved only for referenced captures.
        attempts = attempts.join(newest, "capture_id", "left_semi")
    an = run_analysis(wanted, attempts, timeout_ms=ocr_timeout_ms, **analysis_kw)
    spent = F.col("ocr_elapsed_ms") if "ocr_elapsed_ms" in an.columns else F.lit(0).cast("long")
    an = an.select("file_path", "error", "message", spent.alias("ocr_elapsed_ms"),
                   render_block().alias("_block"), render_handoff().alias("_handoff"))
    joined = media.join(an, "file_path", "left")
    found = F.col("error").isNotNull()
    timed = found & (F.col("ocr_elapsed_ms") > limit)
    ok = found & ~F.col("error") & (js_trim(F.col("_block")) != "")
    status = (F.when(~found, "analysis_failed").when(timed, "analysis_timed_out")
              .when(ok, "ok").otherwise("analysis_failed"))
    detail = F.coalesce(F.col("message"), F.when(~found, F.concat(F.lit("file not found: "), F.col("file_path"))),
                        F.lit("structured analysis returned no image block"))
    entry = (F.when(status == "ok", F.concat(F.col("_block"), F.lit("\n\n"), F.col("_handoff")))
             .when(status == "analysis_timed_out", timed_out_entry(F.col("file_path"), limit))
             .otherwise(failed_entry(F.col("file_path"), detail)))
    keep = [c for c in media.columns]
    return joined.select(*keep, status.alias("status"), entry.alias("entry"))


def conversation_context(entries: DataFrame, enabled: bool = True, keys=("conv_id",)) -> DataFrame:
    """H4: per conversation the preamble, a blank line and the entries in media order.

    Conversations without media have no entries and therefore no row; a
    disabled context gives no rows at all.
    """
    keys = list(keys)
    if not enabled:
        return entries.select(*keys, F.lit(None).cast("string").alias("context")).where(F.lit(False))
    g = entries.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("media_pos", "entry"))).alias("_e"))
    body = F.array_join(F.transform(F.col("_e"), lambda e: e["entry"]), "\n\n")
    head = "\n".join(R.CONTEXT_PREAMBLE) + "\n\n"
    return g.select(*keys, F.size("_e").alias("n_entries"), F.concat(F.lit(head), body).alias("context"))
