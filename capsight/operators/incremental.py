"""Fingerprints, incremental analysis against a result store, retention.

The store is a table of successful analyses keyed by ``fingerprint`` (failures
are never stored, so they are retried).  ``analyze_incremental`` analyses only
fingerprints the store lacks: de-duplicate (partial aggregate), one anti-join
(store keys are unique), analyse, and join the analyses back to all captures.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from capsight.functions import rules as R


def fingerprint(file_path: Column, size_bytes: Column, modified_ms: Column, hint: Column,
                provider: str = "auto", fallback: Sequence[str] = R.OCR_FALLBACK_ORDER,
                timeout_ms: int = R.OCR_TIMEOUT_MS, vision: str = "heuristic",
                max_summary_chars: int = R.MAX_SUMMARY_CHARS) -> Column:
    """SHA-1 of the canonical JSON of the inputs and options that decide the result.

    Unlike the reproduced cache key, the summary limit is part of it, so a changed
    limit never serves a stale summary.
    """
    key = F.struct(
        file_path.alias("file_path"),
        size_bytes.cast("long").alias("size_bytes"),
        modified_ms.cast("long").alias("modified_ms"),
        F.coalesce(hint, F.lit("")).alias("hint"),
        F.struct(F.lit(provider).alias("provider"),
                 F.array(*[F.lit(p) for p in fallback]).alias("fallback_order"),
                 F.lit(timeout_ms).alias("timeout_ms")).alias("ocr"),
        F.struct(F.lit(vision).alias("provider")).alias("vision"),
        F.lit(max_summary_chars).alias("max_summary_chars"),
    )
    return F.sha1(F.to_json(key))


def with_fingerprint(captures: DataFrame, **options) -> DataFrame:
    c = F.col
    return captures.withColumn("fingerprint", fingerprint(c("file_path"), c("size_bytes"), c("modified_ms"),
                                                          c("hint"), **options))


def _options(kw: dict) -> dict:
    return {k: kw[k] for k in ("provider", "fallback", "timeout_ms", "vision", "max_summary_chars") if k in kw}


def analyze_incremental(captures: DataFrame, attempts: DataFrame | None, store: DataFrame | None,
                        **analysis_kw) -> tuple[DataFrame, DataFrame]:
    """``(results, new_entries)``.

    ``results`` has one row per capture: the analysis of its fingerprint, from the store when the store has it
    (``from_store`` true), else a fresh one; captures that share a fingerprint share the analysis.
    ``new_entries`` are the fresh *successful* rows, one per fingerprint, ready to append to the store.

    Fingerprints are de-duplicated before the one anti-join with the store; the narrow list of missing ones and the
    fresh analyses are written to the shared folder once, so neither output computes them again.
    """
    from capsight.operators.analyze import run_analysis
    from capsight.session import write_scratch

    keyed = with_fingerprint(captures, **_options(analysis_kw))
    missing = keyed.groupBy("fingerprint").agg(F.min("capture_id").alias("capture_id"))
    if store is not None:
        missing = missing.join(store.select("fingerprint"), "fingerprint", "left_anti")
    missing = write_scratch(missing, "incremental/missing")
    todo = keyed.join(missing, ["capture_id", "fingerprint"], "left_semi").dropDuplicates(["fingerprint"])
    if attempts is not None:
        # OCR attempts are resolved only for the captures this run analyses.
        attempts = attempts.join(missing.select("capture_id"), "capture_id", "left_semi")
    fresh = write_scratch(run_analysis(todo, attempts, **analysis_kw), "incremental/fresh")
    known = fresh.withColumn("from_store", F.lit(False))
    if store is not None:
        known = known.unionByName(store.withColumn("from_store", F.lit(True)), allowMissingColumns=True)
    own = [c for c in keyed.columns if c in known.columns and c != "fingerprint" and c not in _DERIVED]
    results = keyed.select("fingerprint", *own).join(known.drop(*own), "fingerprint")
    return results, fresh.where(~F.col("error"))


#: Columns of captures that the analysis replaces.
_DERIVED = ("error", "message", "ocr_provider", "ocr_text", "ocr_lines", "ocr_warnings", "ocr_elapsed_ms")


def to_store_rows(analyses: DataFrame, analyzed_ms: Column | None = None) -> DataFrame:
    """Successful analyses as store rows: schema id and write time added."""
    ok = analyses.where(~F.col("error"))
    when_ms = analyzed_ms if analyzed_ms is not None else F.unix_millis(F.current_timestamp())
    return ok.withColumns({"schema_id": F.lit(R.ANALYSIS_SCHEMA), "analyzed_ms": when_ms.cast("long")})


def retain_newest(store: DataFrame, keep: int = 64) -> DataFrame:
    """The ``keep`` newest entries by write time (ties: fingerprint); a global top-k."""
    if keep <= 0:
        raise ValueError("keep must be > 0")
    return store.orderBy(F.col("analyzed_ms").desc(), F.col("fingerprint")).limit(keep)
