"""analyze_folder: real files, admission, extractor, incremental store."""
import os
import tempfile

from capsight.operators.ocr import utf8_extractor
from capsight.plans.jobs import analyze_folder


def _shout(data: bytes, path: str) -> str:
    return data.decode("utf-8").upper()


def test_folder_job_shuffles_no_bytes(spark, tmp_path):
    (tmp_path / "a.png").write_bytes(b"x")
    import re
    plan = analyze_folder(spark, str(tmp_path), _shout)._jdf.queryExecution().executedPlan().toString()
    branch = plan[plan.index("MapInPandas"):]
    below = branch[:branch.index("FileScan binaryFile")]  # from the extractor down to its scan
    assert "content#" in below and not re.search("Exchange|Join", below)


def test_analyze_folder_with_store(spark):
    d = tempfile.mkdtemp(prefix="capsight-folder-")
    files = {"receipt_1.png": "合计 12.50\n实付 12.50", "chat.jpg": "Alice\n12:30\nBob", "empty.png": "",
             "notes.bin": "x", "scan.tiff": "第一章 Intro"}
    for name, text in files.items():
        with open(os.path.join(d, name), "wb") as f:
            f.write(text.encode("utf-8"))
    store = os.path.join(tempfile.mkdtemp(prefix="capsight-store-"), "results")
    first = {r.file_name: r for r in analyze_folder(spark, d, utf8_extractor, provider="utf8", store_path=store).collect()}
    assert first["receipt_1.png"].kind == "receipt_or_invoice" and first["receipt_1.png"].title == "receipt_or_invoice:12.50"
    assert first["chat.jpg"].kind == "chat_screenshot" and first["scan.tiff"].kind == "document_scan"
    assert first["notes.bin"].error and first["empty.png"].message.startswith("Image file is empty (0 bytes): ")
    stored = spark.read.parquet(store).count()
    assert stored == 3
    again = analyze_folder(spark, d, utf8_extractor, provider="utf8", store_path=store)
    assert again.count() == 5 and spark.read.parquet(store).count() == 3  # nothing new was written
    other = analyze_folder(spark, d, _shout, provider="utf8", store_path=store)
    texts = {r.file_name: r.ocr_text for r in other.collect()}
    assert texts["chat.jpg"] == "ALICE\n12:30\nBOB" and spark.read.parquet(store).count() == 6  # another extractor, other results


def test_analyze_folder_with_a_chain(spark, tmp_path):
    """The second extractor sees only files without text so far; a chain has results of its own in the store."""
    from capsight.operators.ocr import PerTask
    from capsight.sources.fixtures import png_extractor
    for name in ("a.png", "b.tiff", "c.jpg", "d.png"):
        (tmp_path / name).write_bytes(f"text of {name}".encode() if name != "d.png" else b"  ")
    store = os.path.join(tempfile.mkdtemp(prefix="capsight-store-"), "results")
    chain = [("paddleocr", png_extractor), ("shout", PerTask(lambda: _shout))]
    out = {r.file_name: r for r in analyze_folder(spark, str(tmp_path), chain=chain, store_path=store, timeout_ms=30_000).collect()}
    assert [(n, r.ocr_provider, r.ocr_text, r.warnings) for n, r in sorted(out.items())] == [
        ("a.png", "paddleocr", "text of a.png", []), ("b.tiff", "shout", "TEXT OF B.TIFF", ["PaddleOCR failed: unsupported file type"]),
        ("c.jpg", "shout", "TEXT OF C.JPG", ["PaddleOCR returned no text"]), ("d.png", "paddleocr", "", ["PaddleOCR returned no text", "shout returned no text"])]
    analyze_folder(spark, str(tmp_path), chain=chain[1:], store_path=store)
    assert spark.read.parquet(store).count() == 8


def test_compare_requests_with_missing_file(spark):
    from capsight.operators.analyze import analyze
    from capsight.operators.handoff import with_handoff
    from capsight.plans.jobs import compare_requests
    from tests.conftest import capture_rows
    an = with_handoff(analyze(capture_rows(spark, [{"file_name": "r1.png", "ocr_text": "合计 1\n实付 1"},
                                                  {"file_name": "r2.png", "ocr_text": "合计 2\n实付 2"}])))
    req = spark.createDataFrame([(1, 0, "/img/r1.png"), (1, 1, "/img/r2.png"), (1, 2, "/img/gone.png"),
                                 (2, 0, "/img/r1.png")], "group_id long, pos int, file_path string")
    compared, listed = compare_requests(req, an)
    out = compared.collect()
    assert len(out) == 1 and out[0].n_members == 3
    assert out[0].kinds == ["receipt_or_invoice", "mixed_unknown"]
    assert sorted((r.pos, r.file_name, r.kind) for r in listed.collect()) == [
        (0, "r1.png", "receipt_or_invoice"), (1, "r2.png", "receipt_or_invoice"), (2, "", "mixed_unknown")]


def test_cli_compare_runs(tmp_path):
    import subprocess
    import sys
    (tmp_path / "r1.png").write_bytes("合计 12.50\n实付 12.50".encode())
    (tmp_path / "r2.png").write_bytes("合计 9\n实付 9".encode())
    (tmp_path / "req.csv").write_text(f"group_id,pos,file_path\n1,0,{tmp_path}/r1.png\n1,1,{tmp_path}/r2.png\n")
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    out = subprocess.run([sys.executable, "-m", "capsight", "compare", str(tmp_path / "req.csv"), str(tmp_path),
                          "--master", "local[2]", "--out", str(tmp_path / "out")], cwd=repo, capture_output=True, text=True, timeout=300)
    assert out.returncode == 0, out.stderr[-2000:]
    written = "".join(p.read_text() for p in (tmp_path / "out" / "comparisons").glob("*.json"))
    assert "Summary: Compared 2 images of the same kind: receipt_or_invoice." in written
    members = "".join(p.read_text() for p in (tmp_path / "out" / "members").glob("*.json"))
    assert members.count("handoff_block") == 2 and "image_block" in members
