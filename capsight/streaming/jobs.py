"""The same jobs on arriving data (Structured Streaming).

* J1 ``stream_analyze``: the per-capture analysis is stateless, so it runs on a
  stream unchanged (same column expressions as the batch job).
* J2 ``stream_dedupe``: a fingerprint is analysed once, whenever it arrives: fingerprints lie in a keyed state store (RocksDB, so the
  state may outgrow memory; a batch reads and writes only its own keys).  No watermark, no event time: a capture with an old
  file time is as new as any other.
* J3 ``stream_context``: media paths are extracted by column expressions before the state; per conversation the path lists
  of the last ``max_messages`` messages live in ``applyInPandasWithState`` state (bounded per key, trimmed after every
  chunk); after every batch the conversation's current media list is emitted with a sequence number, an empty list too.

``run_available_now(df, folder)`` writes rows to ``<folder>/out`` with its checkpoint in ``<folder>/checkpoint``, under the shared
``spark.checkpoint.dir`` unless the folder is a full path.  Run again under the same folder, a stream goes on where it ended or was
stopped: the file sink takes every batch once, the state and the offsets come from the checkpoint.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout

from capsight.functions import rules as R
from capsight.functions.text import js_trim
from capsight.session import scratch_path


#: State beyond memory, and only what has changed goes to the checkpoint.
STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def stream_folder(spark: SparkSession, folder: str) -> str:
    """``folder``, under the shared checkpoint folder unless it is a full path."""
    return folder if folder.startswith("/") or "://" in folder else scratch_path(spark, f"streams/{folder}")


def run_available_now(df: DataFrame, folder: str, output_mode: str = "append") -> str:
    """Run a streaming DataFrame over all that is available into ``<folder>/out``; returns that folder.

    The caller names the folder; the same name resumes the stream.
    """
    spark = df.sparkSession
    base = stream_folder(spark, folder)
    before = {k: spark.conf.get(k, None) for k in STATE_STORE}
    for k, v in STATE_STORE.items():
        spark.conf.set(k, v)
    try:
        q = (df.writeStream.format("parquet").outputMode(output_mode).option("checkpointLocation", f"{base}/checkpoint")
             .trigger(availableNow=True).start(f"{base}/out"))
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return f"{base}/out"


def stream_analyze(captures: DataFrame, **analysis_kw) -> DataFrame:
    """Analysis + handoff columns on a stream of captures carrying their OCR text."""
    from capsight.operators.analyze import analyze
    from capsight.operators.handoff import with_handoff
    return with_handoff(analyze(captures, **analysis_kw))


def stream_dedupe(captures: DataFrame) -> DataFrame:
    """The captures of a stream whose fingerprint has not come before; adds ``fingerprint`` where it is missing."""
    from capsight.operators.incremental import with_fingerprint
    keyed = captures if "fingerprint" in captures.columns else with_fingerprint(captures)
    return keyed.dropDuplicates(["fingerprint"])


def dedupe_available_now(captures: DataFrame, folder: str, transform: Callable[[DataFrame], DataFrame] | None = None) -> str:
    """J2 as a job: run a stream of captures over all that is available; returns the folder of the de-duplicated rows.

    ``transform`` (stateless, such as the analysis) sees each fingerprint once over all runs under the same ``folder``.
    """
    rows = stream_dedupe(captures)
    return run_available_now(transform(rows) if transform else rows, folder)


CONTEXT_STATE = "turns array<bigint>, texts array<string>, paths array<string>, seq bigint"
CONTEXT_OUTPUT = "conv_id bigint, seq bigint, paths array<string>"


def stream_context(messages: DataFrame, max_messages: int = R.MAX_RECENT_MESSAGES,
                   max_images: int = R.MAX_IMAGE_COUNT, idle_timeout: str | None = None) -> DataFrame:
    """``conv_id, seq, paths`` after every batch of each conversation: its current media list, oldest first.

    ``seq`` counts the messages the conversation has seen; the row with the highest ``seq`` is its current list (H1 at
    the latest turn), empty once no recent message names a medium.  Messages may arrive in any order; those of one turn are ordered
    by their text (null first).
    """
    import pandas as pd

    from capsight.operators.context import mention_paths

    def current(newest_first) -> list[str]:
        seen: list[str] = []
        for joined in newest_first:
            for path in joined.split("\n") if joined else ():
                if path not in seen:
                    seen.append(path)
                    if len(seen) == max_images:
                        return seen[::-1]
        return seen[::-1]

    def update(key, batches, state):
        if state.hasTimedOut:
            state.remove()
            return
        kept, seq = (list(zip(*state.get[:3])), state.get[3]) if state.exists else ([], 0)
        for pdf in batches:
            texts = [t if isinstance(t, str) else None for t in pdf["text"]]
            kept = sorted([*kept, *zip(pdf["turn"].tolist(), texts, pdf["paths"].tolist())], key=lambda m: (m[0], m[1] is not None, m[1] or ""))[-max_messages:]
            seq += len(pdf)
        state.update(([int(t) for t, _, _ in kept], [x for _, x, _ in kept], [p for _, _, p in kept], seq))
        if idle_timeout:
            state.setTimeoutDuration(idle_timeout)
        yield pd.DataFrame({"conv_id": [key[0]], "seq": [seq], "paths": [current(p for _, _, p in reversed(kept))]})

    timeout = GroupStateTimeout.ProcessingTimeTimeout if idle_timeout else GroupStateTimeout.NoTimeout
    named = F.filter(F.transform(mention_paths(F.col("text")), js_trim), lambda p: p != "")  # a path holds no line break
    return (messages.select("conv_id", "turn", "text", F.array_join(named, "\n").alias("paths")).groupBy("conv_id")
            .applyInPandasWithState(update, CONTEXT_OUTPUT, CONTEXT_STATE, "append", timeout))


def latest_context(emitted: DataFrame) -> DataFrame:
    """The current media list per conversation from ``stream_context`` output: ``conv_id, media_pos, file_path``."""
    last = emitted.groupBy("conv_id").agg(F.max_by("paths", "seq").alias("paths"))
    return last.select("conv_id", F.posexplode("paths").alias("p", "file_path")).select("conv_id", (F.col("p") + 1).cast("int").alias("media_pos"), "file_path")


def arriving(rows: DataFrame, name: str, batches: int = 3) -> DataFrame:
    """``rows`` as a stream of at least ``batches`` micro-batches, dealt by a hash, so out of any order."""
    spark = rows.sparkSession
    folder = scratch_path(spark, f"streams/{name}-{uuid.uuid4().hex[:12]}/source")
    deal = F.pmod(F.xxhash64(*rows.columns), F.lit(batches))
    for k in range(batches):
        rows.where(deal == k).write.mode("append").parquet(folder)
    files = len(spark.read.parquet(folder).inputFiles())
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", max(1, files // batches)).parquet(folder)


def file_stream(spark: SparkSession, folder: str, like: DataFrame, glob: str | None = None) -> DataFrame:
    """A file-source stream over the parquet files of ``folder``, or over the tables of ``folder`` that match ``glob``, each one file
    or a folder of part files."""
    return spark.readStream.schema(like.schema).parquet(f"{folder}/{glob}" if glob else folder)
