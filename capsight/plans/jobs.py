"""End-to-end jobs over real files: a folder of images in, analyses out.

``analyze_folder`` is the table form of "analyse this image": list the files
(metadata only), admit them, read the bytes of admitted files only (the size and
type tests are metadata filters under the binary-file scan), run the user's text
extractor on the executors (B6), analyse (E3), hand off (F), and optionally skip
files whose fingerprint a result table already holds (I2) and append the new
successes to it (A6).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from capsight.functions import rules as R


def analyze_folder(spark: SparkSession, folder: str, extractor: Callable | None = None, provider: str = "custom",
                   hint: str | None = None, store_path: str | None = None, modified_after: str | None = None,
                   max_image_bytes: int = R.MAX_IMAGE_BYTES, extractor_factory: Callable | None = None,
                   chain: Sequence[tuple[str, Callable]] | None = None, timeout_ms: int | None = None, **analysis_kw) -> DataFrame:
    """Analyse every file under ``folder``; returns one row per file (failures included).

    ``extractor(data: bytes, path: str)`` returns text or ``{"text", "lines"}``;
    ``extractor_factory()`` builds one per task instead (to load a model once); ``chain`` names several that run in turn
    until one gives text (``extract_text``), ``timeout_ms`` is the budget of one image.
    ``store_path``: a result table; files already analysed with the same
    fingerprint are served from it and new successes are appended.
    ``modified_after``: only files modified after this timestamp (listing filter).

    One scan gives metadata and bytes (``length`` is a metadata filter, so files over the limit are not read); no
    join ever moves bytes.  Zero-byte, too large and non-image files come back as failures.  The extractor and
    provider are part of the fingerprint.  With a store, the files it lacks are chosen on metadata first and the scan is
    narrowed to them by a semi-join whose byte side stays in place while the list is small (AQE's size check).
    """
    from capsight.operators.analyze import analyze
    from capsight.operators.handoff import with_handoff
    from capsight.operators.incremental import with_fingerprint
    from capsight.operators.ocr import PerTask, extract_text
    from capsight.sources.listing import admit, binary_files, empty_files, listing_columns
    from capsight.sources.sinks import existing_results, read_results, write_results

    def named(label: str, source: Callable) -> str:
        source = source.factory if isinstance(source, PerTask) else source
        return f"{label}:{getattr(source, '__module__', '')}.{getattr(source, '__qualname__', type(source).__name__)}"

    name = " > ".join(named(*step) for step in chain or [(provider, extractor if extractor is not None else extractor_factory)])
    options = {"provider": name, **({"timeout_ms": timeout_ms} if timeout_ms else {}), **{k: v for k, v in analysis_kw.items() if k in ("vision", "max_summary_chars")}}

    def keyed(files: DataFrame, *extra: str) -> DataFrame:
        rows = listing_columns(files, *extra)
        if modified_after:
            rows = rows.where(F.col("modified_ms") > F.unix_millis(F.to_timestamp(F.lit(modified_after))))
        return admit(with_fingerprint(rows.withColumn("hint", F.lit(hint).cast("string")), **options), max_image_bytes)

    files = binary_files(spark, folder)
    found = files.select("path", "length", "modificationTime")
    every = keyed(found.unionByName(empty_files(spark, files, found)))
    failed = every.where(F.col("message").isNotNull())
    todo = keyed(files.where((F.col("length") > 0) & (F.col("length") <= max_image_bytes)), "content").where(F.col("message").isNull())
    stored = existing_results(spark, store_path) if store_path else None
    if stored is not None:
        todo = todo.join(stored.select("fingerprint"), "fingerprint", "left_anti")
    with_ocr = extract_text(todo, extractor, provider=provider, extractor_factory=extractor_factory, chain=chain, timeout_ms=timeout_ms)
    if not store_path:
        return with_handoff(analyze(with_ocr.unionByName(failed, allowMissingColumns=True), **analysis_kw))
    # The OCR runs once, for the write; the result is then served from the table
    # (new and earlier entries), plus this run's failures, which are never stored.
    write_results(with_handoff(analyze(with_ocr, **analysis_kw)), store_path)
    served = every.select("fingerprint").join(read_results(spark, store_path), "fingerprint")
    failures = with_handoff(analyze(failed, **analysis_kw))
    return served.drop("schema_id", "analyzed_ms").unionByName(failures, allowMissingColumns=True)


def requested(requests: DataFrame, analyses: DataFrame) -> DataFrame:
    """The members of requested groups: ``requests(group_id, pos, file_path)`` with the analysis of each file.

    Joined on ``file_path`` on narrow columns (AQE decides broadcast or sort-merge and splits a file that many ask for); a
    file without an analysis takes part as a failed capture (``mixed_unknown``, empty title, target ``none``).
    """
    an = analyses.select("file_path", "kind", "title", "save_target", "entities", "tags", F.col("source.file_name").alias("file_name"))
    joined = requests.select("group_id", "pos", "file_path").join(an, "file_path", "left")
    none = F.array().cast("array<string>")
    return joined.select(
        "group_id", "pos", F.coalesce("kind", F.lit(R.UNKNOWN)).alias("kind"), F.coalesce("title", F.lit("")).alias("title"),
        F.coalesce("save_target", F.lit("none")).alias("save_target"), F.coalesce("file_name", F.lit("")).alias("file_name"),
        F.coalesce("entities", none).alias("entities"), F.coalesce("tags", none).alias("tags"))


def compare_requests(requests: DataFrame, analyses: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(comparisons, members)`` of requested groups; groups of fewer than two requests give no row.

    The members (narrow rows) are written to the shared folder once, so the analysis runs once for both.
    """
    from capsight.operators.compare import compare_groups, compared_members
    from capsight.session import write_scratch
    rows = write_scratch(requested(requests, analyses), "compare")
    return compare_groups(rows), compared_members(rows)
