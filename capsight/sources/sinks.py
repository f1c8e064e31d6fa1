"""The durable result table.

Successful analyses only (failures are retried on the next run), with schema id, write time and fingerprint; parquet under
``<path>/entry=<id>/kind=<kind>``.

A write first puts its files into a folder of its own and then publishes them by one small entry under ``<path>/_log``, so a write that
fails on the way leaves nothing to be read.  An entry names the entries that its writer had seen (``base``).  Writers do not wait for each
other: where two that had not seen each other publish one fingerprint, readers take the row of the earlier entry, so the table holds
every fingerprint once.  That costs readers a join for such entries alone; all others are read as they lie.

``compact_results`` writes what is to stay as one new entry that replaces those it has read, and then removes their files: retention
that frees the space.  Of two compactions of one entry the earlier counts.  A folder without a log is read as a plain parquet table.
"""

from __future__ import annotations

import time
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from capsight.operators.incremental import retain_newest, to_store_rows

ENTRY = "id string, base array<string>, replaces array<string>"


def _missing(error: AnalysisException) -> bool:
    return error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def _published(spark: SparkSession, path: str) -> list[dict]:
    """All entries of the log by id; one small row per write since the last compaction."""
    try:
        found = spark.read.schema(ENTRY).json(f"{path}/_log/*").collect()
    except AnalysisException as error:
        if _missing(error):
            return []
        raise
    return sorted(({"id": r["id"], "base": set(r["base"] or ()), "replaces": set(r["replaces"] or ())} for r in found), key=lambda e: e["id"])


def live_entries(entries: list[dict]) -> list[dict]:
    """The entries that count: none that is replaced, and of compactions that replace one entry the earliest."""
    replaced: set[str] = set()
    dead: set[str] = set()
    for e in entries:
        if e["replaces"] & replaced:
            dead.add(e["id"])
        else:
            replaced |= e["replaces"]
    return [e for e in entries if e["id"] not in replaced | dead]


def unseen(entry: dict, live: list[dict]) -> list[str]:
    """Earlier live entries that the writer of ``entry`` did not know."""
    return [e["id"] for e in live if e["id"] < entry["id"] and e["id"] not in entry["base"] and not (e["replaces"] and e["replaces"] <= entry["base"])]


def _read(spark: SparkSession, path: str, ids: list[str]) -> DataFrame:
    return spark.read.option("basePath", path).parquet(*(f"{path}/entry={i}" for i in ids)).drop("entry")


def read_results(spark: SparkSession, path: str) -> DataFrame:
    """The result table: every fingerprint once."""
    live = live_entries(_published(spark, path))
    if not live:
        return spark.read.parquet(path)
    other = {e["id"]: unseen(e, live) for e in live}
    plain = [i for i, late in other.items() if not late]
    out = _read(spark, path, plain)
    for i, late in other.items():
        if late:  # written beside these: rows that they hold too are theirs
            out = out.unionByName(_read(spark, path, [i]).join(_read(spark, path, late).select("fingerprint"), "fingerprint", "left_anti"), allowMissingColumns=True)
    return out


def existing_results(spark: SparkSession, path: str) -> DataFrame | None:
    """The result table, or None where nothing has been written yet; any other error is raised."""
    try:
        return read_results(spark, path)
    except AnalysisException as error:
        if _missing(error):
            return None
        raise


def stage_entry(rows: DataFrame, path: str, base: list[str], replaces: list[str] = ()) -> dict | None:
    """Write ``rows`` into a folder of their own; the entry to publish, or None without rows.

    The rows stay in the partitions of their last shuffle (by fingerprint), so as many tasks write as the data ask for.
    """
    entry = {"id": f"{time.time_ns() // 1_000_000:015d}-{uuid.uuid4().hex[:12]}", "base": list(base), "replaces": list(replaces)}
    folder = f"{path}/entry={entry['id']}"
    rows.write.partitionBy("kind").parquet(folder)
    try:
        rows.sparkSession.read.parquet(folder)
    except AnalysisException as error:
        if _missing(error):
            return None
        raise
    return entry


def publish(spark: SparkSession, path: str, entry: dict) -> None:
    """Make a staged entry part of the table: one file, visible as a whole or not at all."""
    spark.createDataFrame([(entry["id"], entry["base"], entry["replaces"])], ENTRY).coalesce(1).write.json(f"{path}/_log/{entry['id']}")


def write_results(analyses: DataFrame, path: str, analyzed_ms=None) -> DataFrame:
    """Append the successful rows of ``analyses`` (which must carry ``fingerprint``) to the table at ``path``; returns the table.

    One row per fingerprint: repeats within the rows are dropped, and fingerprints that the table already holds are not
    appended again, so a rerun or retry adds nothing.
    """
    spark = analyses.sparkSession
    rows = to_store_rows(analyses, analyzed_ms).dropDuplicates(["fingerprint"])
    known = [e["id"] for e in live_entries(_published(spark, path))]
    if (held := existing_results(spark, path)) is not None:
        rows = rows.join(held.select("fingerprint"), "fingerprint", "left_anti")
    if entry := stage_entry(rows, path, known):
        publish(spark, path, entry)
    return read_results(spark, path)


def compact_results(spark: SparkSession, path: str, keep: int | None = None) -> DataFrame:
    """Rewrite the table as one entry, with the ``keep`` newest rows (all by default), and remove the files it replaces.

    Jobs that still read the old files fail and can be run again; rows that are written meanwhile stay.
    """
    known = [e["id"] for e in live_entries(_published(spark, path))]
    rows = read_results(spark, path)
    entry = stage_entry((retain_newest(rows, keep) if keep else rows).repartition("kind", "fingerprint"), path, known, known)
    if entry is None:
        return rows
    publish(spark, path, entry)
    for i in known:
        _remove(spark, f"{path}/entry={i}")
        _remove(spark, f"{path}/_log/{i}")
    return read_results(spark, path)


def _remove(spark: SparkSession, folder: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(folder)
    where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(where, True)


def as_json(cols: list[str]) -> Column:
    """The JSON form of an analysis row (one object)."""
    return F.to_json(F.struct(*cols))


def write_bucketed(df: DataFrame, table: str, key: str, buckets: int, path: str) -> DataFrame:
    """Write ``df`` as a table bucketed and sorted by ``key`` at ``path``; return the table.

    Jobs that aggregate or join on ``key`` (the OCR fold on ``capture_id``) then
    read co-located data and need no shuffle.
    """
    (df.write.mode("overwrite").bucketBy(buckets, key).sortBy(key)
       .option("path", path).saveAsTable(table))
    return df.sparkSession.table(table)
