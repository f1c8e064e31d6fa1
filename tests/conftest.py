import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from capsight.session import local_session
    s = local_session(cores="*", shuffle_partitions=8, app="capsight-tests")
    yield s


def capture_rows(spark, rows):
    """Captures from dicts: file_name (+ optional hint, ocr_text, ocr_lines, size_bytes, group_id, pos)."""
    from pyspark.sql import functions as F
    from capsight.operators.classify import infer_mime
    full = []
    for i, r in enumerate(rows):
        text = r.get("ocr_text", "")
        full.append({
            "capture_id": r.get("capture_id", i),
            "group_id": r.get("group_id", 0),
            "pos": r.get("pos", i),
            "file_path": "/img/" + r["file_name"],
            "file_name": r["file_name"],
            "size_bytes": r.get("size_bytes", 1000),
            "modified_ms": r.get("modified_ms", 1_700_000_000_000 + i),
            "hint": r.get("hint"),
            "ocr_text": text,
            "ocr_lines": r.get("ocr_lines", [x for x in text.split("\n") if x]),
        })
    schema = ("capture_id long, group_id long, pos int, file_path string, file_name string, size_bytes long, "
              "modified_ms long, hint string, ocr_text string, ocr_lines array<string>")
    df = spark.createDataFrame(full, schema)
    return df.withColumn("mime_type", infer_mime(F.col("file_path")))


def analyze_rows(spark, rows, **kw):
    from capsight.operators.analyze import analyze
    from capsight.operators.handoff import with_handoff
    df = with_handoff(analyze(capture_rows(spark, rows), **kw))
    return {r["capture_id"]: r for r in (x.asDict(recursive=True) for x in df.collect())}
