"""Provider order, fallback fold, time budget, cleaning and warnings."""
from pyspark.sql import functions as F

from capsight.operators.ocr import merge_warnings, provider_order, resolve_ocr, with_resolved_ocr

SCHEMA = "capture_id long, provider string, elapsed_ms long, text string, lines array<string>, warnings array<string>"


def resolve(spark, rows, **kw):
    df = spark.createDataFrame(rows, SCHEMA)
    return {r.capture_id: r for r in resolve_ocr(df, **kw).collect()}


def test_provider_order():
    assert provider_order("auto", ["macos_vision", "paddleocr", "macos_vision"]) == ["macos_vision", "paddleocr"]
    assert provider_order("paddleocr", ["macos_vision", "paddleocr"]) == ["paddleocr", "macos_vision"]
    assert provider_order("disabled") == []


def test_first_attempt_with_text_wins_and_collects_earlier_warnings(spark):
    out = resolve(spark, [
        (1, "paddleocr", 100, "hello", ["hello"], []),
        (1, "macos_vision", 100, "", [], ["macOS Vision OCR returned no text"]),
        (2, "macos_vision", 100, "first", [], ["w"]),
        (3, "macos_vision", 100, "  ", [], ["a"]),
        (3, "paddleocr", 100, "", [], ["b"]),
        (4, "macos_vision", 100, " ", [" "], []),
    ], timeout_ms=None)
    assert out[1].ocr_provider == "paddleocr" and out[1].ocr_text == "hello"
    assert out[1].ocr_warnings == ["macOS Vision OCR returned no text"]
    assert out[2].ocr_provider == "macos_vision" and out[2].ocr_warnings == ["w"]
    assert out[3].ocr_provider == "macos_vision" and out[3].ocr_text == "" and out[3].ocr_warnings == ["a", "b"]
    # lines present with blank text still count as a result
    assert out[4].ocr_text == " " and out[4].ocr_lines == [" "]


def test_no_attempt_result_says_no_text(spark):
    out = resolve(spark, [(1, "macos_vision", 1, "", [], []), (1, "paddleocr", 1, "", [], [])], timeout_ms=None)
    assert out[1].ocr_warnings == ["OCR returned no text"] and out[1].ocr_provider == "macos_vision"


def test_budget_times_out_then_skips(spark):
    rows = [(1, "macos_vision", 6000, "late", [], []), (1, "paddleocr", 100, "ok", [], [])]
    out = resolve(spark, rows, timeout_ms=5000)
    assert out[1].ocr_text == ""
    assert out[1].ocr_warnings == ["macOS Vision OCR failed: timed out",
                                   "Skipped paddleocr: remaining OCR budget 0ms is below 1500ms"]
    assert out[1].ocr_elapsed_ms == 5000
    out = resolve(spark, rows, timeout_ms=1000)
    assert out[1].ocr_warnings == ["Skipped macos_vision: remaining OCR budget 1000ms is below 1500ms"]


def test_budget_caps_each_provider(spark):
    # macos cap 12000: 12500 ms is a timeout even with the default 30000 budget.
    rows = [(1, "macos_vision", 12500, "late", [], []), (1, "paddleocr", 7000, "ok", [], [])]
    out = resolve(spark, rows)
    assert out[1].ocr_text == "ok" and out[1].ocr_warnings == ["macOS Vision OCR failed: timed out"]
    assert out[1].ocr_elapsed_ms == 19000


def test_disabled_and_missing_attempts(spark):
    caps = spark.createDataFrame([(1, "a.png"), (2, "b.png")], "capture_id long, file_name string")
    out = {r.capture_id: r for r in with_resolved_ocr(caps, None, provider="disabled").collect()}
    assert out[1].ocr_provider == "disabled" and out[1].ocr_warnings == ["OCR provider is disabled"]
    att = spark.createDataFrame([(1, "paddleocr", 5, "x", [], [])], SCHEMA)
    out = {r.capture_id: r for r in with_resolved_ocr(caps, att).collect()}
    assert out[1].ocr_text == "x" and out[2].ocr_warnings == ["OCR returned no text"]


def test_merge_warnings(spark):
    df = spark.createDataFrame([(["a", " "], ["b", "", "c", "d", "e", "f"])], "x array<string>, y array<string>")
    r = df.select(merge_warnings(F.col("x"), F.col("y")).alias("all"),
                  merge_warnings(F.col("x"), F.col("y"), limit=5).alias("five")).collect()[0]
    assert r["all"] == ["a", "b", "c", "d", "e", "f"] and r["five"] == ["a", "b", "c", "d", "e"]


def test_fold_holds_no_text(spark):
    df = spark.createDataFrame([(1, "paddleocr", 5, "x", [], [])], SCHEMA)
    plan = resolve_ocr(df.repartition(3))._jdf.queryExecution().optimizedPlan().toString()
    fold = next(line for line in plan.split("\n") if "Aggregate [capture_id" in line and "collect_list" in line)
    gathered = fold.split("collect_list(")[1].split(", 0, 0")[0]  # up to the end of the aggregate's own arguments
    assert "_place" in gathered and " text#" not in gathered


def test_hot_capture_keeps_every_attempt(spark):
    rows = [(9, "macos_vision", 5000 + i, "", [], [f"retry {i}"]) for i in range(3000)]
    rows += [(9, "paddleocr", 900 + i, f"text {i}", [], []) for i in range(3000)]
    rows += [(1, "paddleocr", 10, "x", [], [])]
    df = spark.createDataFrame(rows, SCHEMA).repartition(6)
    out = {r.capture_id: r for r in resolve_ocr(df, timeout_ms=None).collect()}
    assert out[9].ocr_provider == "paddleocr" and out[9].ocr_text == "text 0"
    assert out[9].ocr_warnings == [f"retry {i}" for i in range(3000)] and out[1].ocr_text == "x"


def test_retry_of_one_provider_wins(spark):
    rows = [(1, "paddleocr", 100, "", [], ["failed"]), (1, "paddleocr", 5000, "good", [], [])] * 2
    out = {r.capture_id: r for r in resolve_ocr(spark.createDataFrame(rows, SCHEMA), timeout_ms=None).collect()}
    assert out[1].ocr_text == "good" and out[1].ocr_warnings == ["failed"]
    numbered = spark.createDataFrame([(1, "paddleocr", 1, 10, "second", [], []), (1, "paddleocr", 0, 900, "first", [], [])],
                                     "capture_id long, provider string, attempt_no int, elapsed_ms long, text string, lines array<string>, warnings array<string>")
    assert resolve_ocr(numbered, timeout_ms=None).first().ocr_text == "first"


def test_extract_text_errors_become_warnings_and_factory_runs_per_task(spark):
    from capsight.operators.ocr import extract_text

    def factory():
        def fn(data, path):
            if path.endswith("bad.png"):
                raise RuntimeError("decoder exploded\nstack")
            return {"text": data.decode(), "lines": data.decode().split("\n")}
        return fn

    images = spark.createDataFrame([("/a.png", b"hi\nthere"), ("/bad.png", b"x"), ("/e.png", b"")],
                                   "file_path string, content binary")
    out = {r.file_path: r for r in extract_text(images, extractor_factory=factory, provider="m").collect()}
    assert out["/a.png"].ocr_lines == ["hi", "there"] and out["/a.png"].ocr_warnings == []
    assert out["/bad.png"].ocr_text == "" and out["/bad.png"].ocr_warnings == ["m failed: decoder exploded"]
    assert out["/e.png"].ocr_warnings == ["m returned no text"]


def _answer(text):
    return lambda data, path: text


def test_chain_goes_on_until_one_gives_text():
    from capsight.operators.ocr import run_chain

    def broken(data, path):
        raise RuntimeError("no model\ntrace")

    chain = [("macos_vision", broken), ("paddleocr", _answer("  ")), ("own", _answer({"text": "", "lines": ["x", "", 3], "provider": "engine"})), ("late", broken)]
    assert run_chain(chain, b"", "/a")[:4] == ("engine", "", ["x"], ["macOS Vision OCR failed: no model", "PaddleOCR returned no text"])
    assert run_chain(chain[:2], b"", "/a")[:4] == ("macos_vision", "", [], ["macOS Vision OCR failed: no model", "PaddleOCR returned no text"])
    assert run_chain([("own", _answer(None))], b"", "/a")[:4] == ("own", "", [], ["own returned no text"])


def test_chain_spends_its_budget_like_the_table_fold(spark):
    """The same attempts, once run with a clock that the extractors move, once as rows."""
    from capsight.operators.ocr import run_chain
    names = ["macos_vision", "paddleocr", "third"]
    for budget in (2000, 5000, 9000, 13000, 30000):
        for times in ((100, 200, 300), (9000, 100, 100), (20000, 9000, 100), (4000, 4000, 100), (800, 800, 800)):
            for texts in (("", "", "c"), ("", "b", "c"), ("", "", "")):
                now = [0.0]

                def extractor(ms, text):
                    def fn(data, path):
                        now[0] += ms / 1000
                        return text
                    return fn
                got = run_chain([(n, extractor(t, x)) for n, t, x in zip(names, times, texts)], b"", "/a", budget, lambda: now[0])
                labels = ("macOS Vision OCR", "PaddleOCR", "third")
                rows = [(1, n, t, x, [], [] if x else [f"{label} returned no text"]) for n, label, t, x in zip(names, labels, times, texts)]
                CASES.append((rows, budget, got))
    for budget in {b for _, b, _ in CASES}:
        mine = [(k, rows, got) for k, (rows, b, got) in enumerate(CASES) if b == budget]
        table = spark.createDataFrame([(k, *r[1:]) for k, rows, _ in mine for r in rows], SCHEMA)
        out = {r.capture_id: r for r in resolve_ocr(table, fallback=names, timeout_ms=budget).collect()}
        for k, _, (provider, text, lines, warnings, spent) in mine:
            r = out[k]
            assert (provider, text, lines, warnings, spent) == (r.ocr_provider, r.ocr_text, r.ocr_lines, r.ocr_warnings, r.ocr_elapsed_ms)


CASES: list = []


def test_an_extractor_is_stopped_at_its_limit(spark):
    import time as clock

    from capsight.functions import rules
    from capsight.operators.ocr import PerTask, extract_text

    def slow():
        def fn(data, path):
            if path == "/slow":
                clock.sleep(20)
            return data.decode()
        return fn

    images = spark.createDataFrame([("/slow", b"late", 1), ("/fast", b"soon", 2), ("/null", None, 3)], "file_path string, content binary, ocr_text int").coalesce(1)
    began = clock.time()
    out = {r.file_path: r for r in extract_text(images, chain=[("slow", PerTask(slow)), ("second", lambda data, path: "fallback")], timeout_ms=4000).collect()}
    assert clock.time() - began < 18
    assert out["/slow"].ocr_text == "" and out["/slow"].ocr_warnings[0] == "slow failed: timed out"
    assert out["/slow"].ocr_warnings[1] == f"Skipped second: remaining OCR budget 0ms is below {rules.OCR_MIN_ATTEMPT_MS}ms" and out["/slow"].ocr_elapsed_ms == 4000
    assert out["/fast"].ocr_text == "soon" and out["/fast"].ocr_warnings == [] and out["/null"].ocr_text == "fallback"


def test_bucketed_attempts_fold_without_shuffle(spark):
    import os
    import tempfile
    from capsight.sources import fixtures as fx
    from capsight.sources.sinks import write_bucketed
    att = fx.attempts(spark, "/root/testdata/sf0.001")
    path = os.path.join(tempfile.mkdtemp(prefix="capsight-bucketed-"), "attempts")
    table = write_bucketed(att, "capsight_test_attempts", "capture_id", 4, path)
    folded = resolve_ocr(table, timeout_ms=5000)
    plan = folded._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan
    assert folded.count() == 200


def test_attempts_are_scanned_and_shuffled_once(spark):
    from capsight.operators.ocr import with_resolved_ocr
    from capsight.sources import fixtures as fx
    sf = "/root/testdata/sf0.001"
    from capsight.session import write_scratch
    attempts, captures = write_scratch(fx.attempts(spark, sf), "attempts"), write_scratch(fx.captures(spark, sf).drop("ocr_text"), "captures")
    plan = with_resolved_ocr(captures, attempts, partitions=5)._jdf.queryExecution().executedPlan().toString()
    # one exchange of the attempts with the asked number of parts, one of the captures to meet them
    assert plan.count("Exchange hashpartitioning(capture_id") == 2 and "REPARTITION_BY_NUM" in plan and plan.count("Join") == 1


def test_a_batch_of_images_is_read_in_parts():
    """The first rows come out before the last images of their batch are read; order and nulls stay."""
    import pandas as pd
    from capsight.operators import ocr
    seen = []

    def read(data, path):
        seen.append(path)
        return path

    big = b"x" * (ocr.PART_BYTES // 2)
    pdf = pd.DataFrame({"file_path": [f"p{i}" for i in range(7)], "content": [big, big, big, None, b"", big, big]})
    frames = ocr._extract_parts(iter([pdf, pdf.iloc[:0]]), [("a", read)], ["file_path"], "content", "file_path", None)
    first = next(frames)
    assert len(first) == len(seen) == 2
    rows = pd.concat([first, *frames])
    assert rows["ocr_text"].tolist() == rows["file_path"].tolist() == [f"p{i}" for i in range(7)]
