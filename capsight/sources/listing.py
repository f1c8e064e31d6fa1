"""A1-A3: file listings, admission and requests that name no listed file.

``image_listing`` reads file *metadata* only (``binaryFile`` with the content
column pruned), so no image bytes move.  ``admit`` is a single projection that
labels every row; accepted and rejected rows are two filters over it.
"""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from capsight.functions import rules as R
from capsight.operators.classify import infer_mime


def base_name(path: Column) -> Column:
    """Last path segment (``path.basename``)."""
    return F.regexp_extract(path, r"([^/]*)$", 1)


def image_listing(spark: SparkSession, path: str, recursive: bool = True,
                  glob: str | None = None) -> DataFrame:
    """A1: one row per file under ``path``: ``file_path, file_name, mime_type, size_bytes, modified_ms``.

    Only the ``path``, ``length`` and ``modificationTime`` columns are selected, so the scan never reads file
    content.  The scan gives no rows for zero-byte files; they are the listed files that the scan lacks and get
    size 0 and no modification time.
    """
    files = binary_files(spark, path, recursive, glob)
    found = files.select("path", "length", "modificationTime")
    empty = empty_files(spark, files, found)
    return listing_columns(found.unionByName(empty))


def binary_files(spark: SparkSession, path: str, recursive: bool = True, glob: str | None = None) -> DataFrame:
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
    return (reader.option("pathGlobFilter", glob) if glob else reader).load(path)


def empty_files(spark: SparkSession, files: DataFrame, found: DataFrame) -> DataFrame:
    """``path, length, modificationTime`` of the zero-byte files: in the file index, but without a row."""
    listed = spark.createDataFrame([(unquote(p) if "%" in p else p,) for p in files.inputFiles()], "path string")
    plain = F.regexp_replace("path", "^file:/+", "/")
    rest = listed.withColumn("_p", plain).join(found.select(plain.alias("_p")), "_p", "left_anti")
    return rest.select("path", F.lit(0).cast("long").alias("length"), F.lit(None).cast("timestamp").alias("modificationTime"))


def listing_columns(files: DataFrame, *extra: str) -> DataFrame:
    fp = F.regexp_replace(F.col("path"), r"^file:/+", "/")
    return files.select(
        fp.alias("file_path"),
        base_name(fp).alias("file_name"),
        infer_mime(fp).alias("mime_type"),
        F.col("length").cast("long").alias("size_bytes"),
        F.unix_millis(F.col("modificationTime")).alias("modified_ms"),
        *extra,
    )


def admission_message(path: Column, size: Column, mime: Column, is_file: Column | None = None,
                      max_image_bytes: int = R.MAX_IMAGE_BYTES) -> Column:
    """A2 rule chain: not a file, empty, too large, unsupported type; null when admitted."""
    if max_image_bytes <= 0:
        raise ValueError("max_image_bytes must be > 0")
    msg = None
    if is_file is not None:
        msg = F.when(~is_file, F.concat(F.lit("not a file: "), path))
    empty_rule = F.concat(F.lit("Image file is empty (0 bytes): "), path)
    large_rule = F.concat(F.lit("image too large: "), size.cast("string"), F.lit(f" bytes > {max_image_bytes}"))
    type_rule = F.concat(F.lit("unsupported image type: "), path)
    msg = F.when(size == 0, empty_rule) if msg is None else msg.when(size == 0, empty_rule)
    return msg.when(size > max_image_bytes, large_rule).when(~mime.startswith("image/"), type_rule)


def admit(listing: DataFrame, max_image_bytes: int = R.MAX_IMAGE_BYTES) -> DataFrame:
    """A2: adds ``message`` (null = accepted) and ``error``; rows are never dropped here."""
    is_file = F.col("is_file") if "is_file" in listing.columns else None
    mime = F.col("mime_type") if "mime_type" in listing.columns else infer_mime(F.col("file_path"))
    df = listing if "mime_type" in listing.columns else listing.withColumn("mime_type", mime)
    msg = admission_message(F.col("file_path"), F.col("size_bytes"), F.col("mime_type"), is_file, max_image_bytes)
    return df.withColumn("message", msg).withColumn("error", F.col("message").isNotNull())


def unresolved_requests(requests: DataFrame, listing: DataFrame, path: str = "file_path") -> DataFrame:
    """A3: requested paths absent from the listing, as failure rows ``(file_path, message)``.

    Requests are de-duplicated first (a partial aggregate, so a path requested
    by a third of all rows is collapsed before the shuffle), then anti-joined.
    """
    req = requests.select(F.col(path).alias("file_path")).where(F.col("file_path").isNotNull()).distinct()
    missing = req.join(listing.select("file_path"), "file_path", "left_anti")
    return missing.select("file_path", F.concat(F.lit("file not found: "), F.col("file_path")).alias("message"))
