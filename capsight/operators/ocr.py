"""OCR attempt resolution, cleaning, warnings and the text-extractor hook.

``resolve_ocr`` turns a table of OCR attempts into one OCR result per capture:
the first attempt in provider order that produced text wins, earlier failures
become warnings, and an optional time budget skips or times out attempts.

Plan: one scan, one shuffle of the attempts on ``capture_id`` and one sort in the order (provider rank, ``attempt_no``,
``elapsed_ms``).  Windows of fixed-size values over it (place, running time, first success or end) leave the attempts up to
the winner; one aggregation of these, without a shuffle of its own, keeps the winner's text and the warnings up to it.
No join, and linear in the attempts of a capture.  The provider rank and time caps are literal maps.
"""

from __future__ import annotations

import contextlib
import signal
import threading
import time
from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from capsight.functions import rules as R
from capsight.functions.text import WS_CHARS, js_trim, lit_array
from capsight.operators.extract import empty


def provider_order(provider: str = "auto", fallback: Sequence[str] = R.OCR_FALLBACK_ORDER) -> list[str]:
    """The named provider first, then the fallback order, de-duplicated.

    ``auto`` uses the fallback order alone; ``disabled`` gives no providers.
    """
    if provider == "disabled":
        return []
    names = list(fallback) if provider == "auto" else [provider, *fallback]
    out: list[str] = []
    for n in names:
        if n not in out:
            out.append(n)
    return out


def _literal_map(mapping: dict) -> Column:
    items = []
    for k, v in mapping.items():
        items += [F.lit(k), F.lit(v)]
    return F.create_map(*items)


def clean_text(text: Column) -> Column:
    """Trimmed OCR text."""
    return js_trim(F.coalesce(text, F.lit("")))


def clean_lines(lines: Column) -> Column:
    """Trimmed lines without blanks."""
    return F.filter(F.transform(F.coalesce(lines, empty()), js_trim), lambda x: x != "")


def join_lines(lines: Column) -> Column:
    """Lines joined by LF."""
    return F.array_join(lines, "\n")


def clean_ocr(df: DataFrame, text: str = "text", lines: str = "lines") -> DataFrame:
    """B4 as a job: adds ``clean_text``, ``clean_lines`` and ``lines_text``."""
    return df.withColumns({"clean_text": clean_text(F.col(text)), "clean_lines": clean_lines(F.col(lines))}) \
             .withColumn("lines_text", join_lines(F.col("clean_lines")))


def merge_warnings(*cols: Column, limit: int | None = None) -> Column:
    """Concatenate warning lists and drop blank ones; optionally keep the first ``limit``."""
    merged = F.filter(F.concat(*[F.coalesce(c, empty()) for c in cols]), lambda w: js_trim(w) != "")
    return F.slice(merged, 1, limit) if limit else merged


def _skip_message(provider: Column, remaining: Column) -> Column:
    return F.concat(F.lit("Skipped "), provider, F.lit(": remaining OCR budget "),
                    remaining.cast("string"), F.lit(f"ms is below {R.OCR_MIN_ATTEMPT_MS}ms"))


def _timeout_message(provider: Column) -> Column:
    label = F.coalesce(_literal_map(R.OCR_PROVIDER_LABEL)[provider], provider)
    return F.concat(label, F.lit(" failed: timed out"))


def _spending(turn, timeout_ms: int | None) -> dict[str, Column]:
    """Per attempt: whether it is skipped, timed out or gives the text, and the time spent after it.

    An attempt uses its time up to its provider's cap, so the time spent before it is a running sum, cut at the budget: one that
    is stopped because the rest is used up uses just that rest.
    """
    own = F.greatest(F.lit(0).cast("long"), F.col("elapsed_ms"))
    has_text = (js_trim(F.col("text")) != "") | (F.size("lines") > 0)
    earlier = turn.rowsBetween(Window.unboundedPreceding, -1)
    if timeout_ms is None:
        before = F.coalesce(F.sum(own).over(earlier), F.lit(0))
        return {"_skip": F.lit(False), "_late": F.lit(False), "_ok": has_text, "_rest": F.lit(None).cast("long"), "_spent": (before + own).cast("long")}
    budget = F.lit(timeout_ms).cast("long")
    cap = F.coalesce(_literal_map(R.OCR_ATTEMPT_CAP_MS)[F.col("provider")].cast("long"), budget)
    before = F.least(budget, F.coalesce(F.sum(F.least(own, cap)).over(earlier), F.lit(0)))
    rest = budget - before
    skip = rest < R.OCR_MIN_ATTEMPT_MS
    late = ~skip & (own > F.greatest(F.lit(R.OCR_MIN_ATTEMPT_MS), F.least(rest, cap)))
    spent = F.when(skip, before).otherwise(F.least(budget, before + F.least(own, cap)))
    return {"_skip": skip, "_late": late, "_ok": ~skip & ~late & has_text, "_rest": rest, "_spent": spent.cast("long")}


def _attempt_warnings() -> Column:
    """What an attempt leaves, the winner too."""
    return (F.when(F.col("_skip"), F.array(_skip_message(F.col("provider"), F.col("_rest"))))
            .when(F.col("_late"), F.array(_timeout_message(F.col("provider")))).otherwise(F.col("warnings")))


def resolve_ocr(attempts: DataFrame, provider: str = "auto",
                fallback: Sequence[str] = R.OCR_FALLBACK_ORDER,
                timeout_ms: int | None = R.OCR_TIMEOUT_MS, partitions: int | None = None) -> DataFrame:
    """B1/B2: one OCR result per capture from ``(capture_id, provider, elapsed_ms, text, lines, warnings)``.

    Every attempt counts: they run in the order (provider rank, ``attempt_no``, ``elapsed_ms``), the first with text wins and
    the warnings of all before it are kept.  ``attempt_no`` (default 0) orders the retries of one provider; rows that
    agree in everything are one attempt.  Attempts of providers outside the order are ignored.  ``timeout_ms=None``
    turns the budget off (pure fallback).  Output columns: ``capture_id,
    ocr_provider, ocr_text, ocr_lines, ocr_warnings, ocr_elapsed_ms`` (time spent
    by the budget model).  Captures without any
    attempt get no row here; ``with_resolved_ocr`` fills them in.  ``partitions``: an explicit number of parts
    of the one shuffle (else Spark decides; attempts that are bucketed by ``capture_id`` need no shuffle).
    """
    if timeout_ms is not None and timeout_ms <= 0:
        raise ValueError("timeout_ms must be > 0")
    order = provider_order(provider, fallback)
    if not order:
        raise ValueError("OCR is disabled: use with_resolved_ocr(..., provider='disabled')")
    rank = _literal_map({p: i for i, p in enumerate(order)})
    number = F.coalesce(F.col("attempt_no").cast("long"), F.lit(0).cast("long")) if "attempt_no" in attempts.columns else F.lit(0).cast("long")
    ranked = attempts.select(
        "capture_id", "provider", rank[F.col("provider")].alias("_rank"), number.alias("_no"), F.coalesce(F.col("elapsed_ms").cast("long"), F.lit(0)).alias("elapsed_ms"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"), F.coalesce(F.col("lines"), empty()).alias("lines"),
        F.coalesce("warnings", empty()).alias("warnings")).where(F.col("_rank").isNotNull())
    if partitions:
        ranked = ranked.repartition(partitions, "capture_id")
    what = ["_rank", "_no", "elapsed_ms", "text", "lines", "warnings"]  # ties in the order compare whole attempts
    turn = Window.partitionBy("capture_id").orderBy(*what)  # the one sort; the windows below keep it
    tried = ranked.withColumn("_again", F.lag(F.struct(*what)).over(turn).eqNullSafe(F.struct(*what))).where(~F.col("_again"))
    tried = tried.withColumns({"_place": F.row_number().over(turn), **_spending(turn, timeout_ms)})
    last = F.min(F.when(F.col("_skip") | F.col("_ok"), F.col("_place"))).over(Window.partitionBy("capture_id"))
    tried = tried.withColumn("_last", last).where(F.col("_last").isNull() | (F.col("_place") <= F.col("_last")))
    said = F.struct(F.col("_place").alias("place"), _attempt_warnings().alias("warnings"))
    won = F.when(F.col("_ok"), F.struct("provider", "text", "lines"))
    folded = tried.groupBy("capture_id").agg(F.sort_array(F.collect_list(said)).alias("_said"), F.first(won, ignorenulls=True).alias("_won"),
                                             F.max("_spent").alias("_spent"))
    warnings = F.flatten(F.transform("_said", lambda w: w["warnings"]))
    done = F.col("_won").isNotNull()
    return folded.select(
        "capture_id",
        F.coalesce(F.col("_won.provider"), F.lit(order[0])).alias("ocr_provider"),
        F.coalesce(F.col("_won.text"), F.lit("")).alias("ocr_text"),
        F.coalesce(F.col("_won.lines"), empty()).alias("ocr_lines"),
        F.when(done | (F.size(warnings) > 0), warnings).otherwise(lit_array((R.OCR_NO_TEXT,))).alias("ocr_warnings"),
        F.col("_spent").alias("ocr_elapsed_ms"),
    )


def with_resolved_ocr(captures: DataFrame, attempts: DataFrame | None, provider: str = "auto",
                      fallback: Sequence[str] = R.OCR_FALLBACK_ORDER,
                      timeout_ms: int | None = R.OCR_TIMEOUT_MS, partitions: int | None = None) -> DataFrame:
    """Attach the resolved OCR result to every capture (left join on ``capture_id``).

    The few bytes of a capture stand for the work of its analysis, so the shuffle has an explicit number of parts that
    AQE does not coalesce: ``partitions``, the session's shuffle partitions by default; 0 leaves it to Spark (bucketed attempts).

    Captures with no attempt get the "no text" result of the first provider;
    ``provider='disabled'`` skips OCR entirely.  Any existing ``ocr_*`` columns
    of ``captures`` are replaced.
    """
    base = captures.drop("ocr_provider", "ocr_text", "ocr_lines", "ocr_warnings", "ocr_elapsed_ms")
    order = provider_order(provider, fallback)
    if not order:
        return base.withColumns({"ocr_provider": F.lit("disabled"), "ocr_text": F.lit(""),
                                 "ocr_lines": empty(), "ocr_warnings": lit_array((R.OCR_DISABLED,)),
                                 "ocr_elapsed_ms": F.lit(0).cast("long")})
    if partitions is None:
        partitions = int(captures.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    resolved = resolve_ocr(attempts, provider, fallback, timeout_ms, partitions)
    joined = base.join(resolved.hint("merge"), "capture_id", "left")  # resolved is dealt out by capture already
    missing = F.col("ocr_provider").isNull()
    return joined.withColumns({
        "ocr_provider": F.coalesce(F.col("ocr_provider"), F.lit(order[0])),
        "ocr_text": F.coalesce(F.col("ocr_text"), F.lit("")),
        "ocr_lines": F.coalesce(F.col("ocr_lines"), empty()),
        "ocr_warnings": F.when(missing, lit_array((R.OCR_NO_TEXT,))).otherwise(F.col("ocr_warnings")),
        "ocr_elapsed_ms": F.coalesce(F.col("ocr_elapsed_ms"), F.lit(0).cast("long")),
    })


class PerTask:
    """A factory of extractors in a chain: called once per task (load a model there)."""

    def __init__(self, factory: Callable[[], Callable[[bytes, str], object]]):
        self.factory = factory


@contextlib.contextmanager
def _time_limit(ms: float | None):
    """Raise ``TimeoutError`` in the running extractor after ``ms``, where the platform has timers for this thread."""
    if ms is None or threading.current_thread() is not threading.main_thread() or not hasattr(signal, "setitimer"):
        yield
        return

    def stop(*_):
        raise TimeoutError

    before = signal.signal(signal.SIGALRM, stop)
    signal.setitimer(signal.ITIMER_REAL, ms / 1000)
    try:
        yield
    finally:
        signal.setitimer(signal.ITIMER_REAL, 0)
        signal.signal(signal.SIGALRM, before)


def _read(found: object, provider: str) -> tuple[str, str, list[str]]:
    """An extractor's answer as provider, text and non-empty lines."""
    text, lines = (found.get("text"), found.get("lines")) if isinstance(found, dict) else (found, None)
    named = found.get("provider") if isinstance(found, dict) else None
    return named or provider, text if isinstance(text, str) else "", [x for x in (lines or []) if isinstance(x, str) and x]


def run_chain(chain: Sequence[tuple[str, Callable[[bytes, str], object]]], data: bytes, path: str, timeout_ms: int | None = None,
              clock: Callable[[], float] = time.monotonic) -> tuple[str, str, list[str], list[str], int]:
    """Provider, text, lines, warnings and milliseconds of one image: extractors in turn until one gives text.

    The rules of ``resolve_ocr``, with time measured: under a budget each attempt has the smaller of its provider's cap and
    the rest (the floor at least), one that takes longer is stopped and counts as timed out, and the chain ends when
    the rest falls below the floor.
    """
    warnings: list[str] = []
    spent = 0.0
    for provider, extractor in chain:
        limit = None
        if timeout_ms is not None:
            rest = int(max(0, timeout_ms - spent))
            if rest < R.OCR_MIN_ATTEMPT_MS:
                warnings.append(f"Skipped {provider}: remaining OCR budget {rest}ms is below {R.OCR_MIN_ATTEMPT_MS}ms")
                break
            limit = max(R.OCR_MIN_ATTEMPT_MS, min(rest, R.OCR_ATTEMPT_CAP_MS.get(provider, timeout_ms)))
        label = R.OCR_PROVIDER_LABEL.get(provider, provider)
        began, found, failure = clock(), "", None
        try:
            with _time_limit(limit):
                found = extractor(data, path)
        except TimeoutError:
            failure = "timed out"
        except Exception as exc:  # noqa: BLE001 - an image's failures become its warnings
            failure = str(exc).split("\n")[0].strip() or "OCR execution failed"
        took = (clock() - began) * 1000
        if limit is not None and took > limit:
            took, failure = limit, "timed out"
        spent += took
        named, text, lines = _read(found, provider)
        if failure is None and (text.strip(WS_CHARS) or lines):
            return named, text, lines, warnings, round(spent)
        warnings.append(f"{label} failed: {failure}" if failure else f"{label} returned no text")
    return chain[0][0], "", [], warnings, round(spent)


#: Bytes of images whose texts a worker holds at a time.
PART_BYTES = 4 << 20
_ADDED = ("ocr_provider", "ocr_text", "ocr_lines", "ocr_warnings", "ocr_elapsed_ms")


def _parts(sizes: Iterable[int], most: int) -> list[tuple[int, int]]:
    """Row ranges of at most ``most`` bytes, or of one row."""
    out, start, held, n = [], 0, 0, 0
    for n, size in enumerate(sizes, 1):
        if held and held + size > most:
            out.append((start, n - 1))
            start, held = n - 1, 0
        held += size
    return [*out, (start, n)] if n else out


def _extract_parts(batches: Iterable, steps: Sequence, keep: list[str], content: str, path: str, timeout_ms: int | None):
    """The frames of ``extract_text``: a batch of images goes out in parts, so its texts are never held all at once."""
    import pyarrow as pa

    ready = [(name, fn.factory() if isinstance(fn, PerTask) else fn) for name, fn in steps]
    for pdf in batches:
        for a, b in _parts((len(data) if data is not None else 0 for data in pdf[content]), PART_BYTES):
            part = pdf.iloc[a:b]
            rows = [run_chain(ready, bytes(data) if data is not None else b"", p, timeout_ms) for data, p in zip(part[content], part[path])]
            out = part[keep].copy()
            for name, values in zip(_ADDED, zip(*rows)):
                out[name] = list(values)
            yield out
        del pdf
        pa.default_memory_pool().release_unused()


def extract_text(images: DataFrame, extractor: Callable[[bytes, str], object] | None = None, provider: str = "custom",
                 content: str = "content", path: str = "file_path",
                 extractor_factory: Callable[[], Callable[[bytes, str], object]] | None = None,
                 chain: Sequence[tuple[str, Callable[[bytes, str], object] | PerTask]] | None = None,
                 timeout_ms: int | None = None) -> DataFrame:
    """Run text extractors over image bytes on the executors.

    ``extractor(data, path)`` returns a string, or a dict with ``text`` and ``lines`` (and optionally ``provider``).
    ``extractor_factory()`` instead builds it once per task.  ``chain`` names several, ``[(provider, extractor or
    PerTask(factory)), ...]``: they run in turn on the same row, the next only while there is no text, and the warnings of
    those before the winner are kept (``run_chain``).  ``timeout_ms`` is the budget of one image over the whole chain.

    All run inside one ``mapInPandas`` pass over the bytes; errors become warnings of their row and never fail the job.
    Columns pass through but for the bytes, which go no further; added are ``ocr_provider, ocr_text, ocr_lines, ocr_warnings,
    ocr_elapsed_ms`` (measured).  Null bytes are empty ones.  Images are large: the caller sizes batches by
    ``spark.sql.execution.arrow.maxRecordsPerBatch`` (no setting is changed here).
    """
    if [extractor, extractor_factory, chain].count(None) != 2:
        raise ValueError("give exactly one of extractor, extractor_factory and chain")
    steps = list(chain) if chain is not None else [(provider, extractor if extractor is not None else PerTask(extractor_factory))]
    if not steps:
        raise ValueError("the chain is empty")
    keep = [c for c in images.columns if c != content and c not in _ADDED]
    schema = images.select(*keep).schema.simpleString()[len("struct<"):-1]
    schema += ",ocr_provider:string,ocr_text:string,ocr_lines:array<string>,ocr_warnings:array<string>,ocr_elapsed_ms:bigint"

    def run(batches):
        return _extract_parts(batches, steps, keep, content, path, timeout_ms)

    return images.drop(*_ADDED).mapInPandas(run, schema=schema)


def utf8_extractor(data: bytes, path: str) -> dict:
    """A trivial extractor for text-bearing bytes: UTF-8 text, one line per LF."""
    text = data.decode("utf-8")
    return {"text": text, "lines": text.split("\n")}
