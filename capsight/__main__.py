"""Command line: analyse a folder of images with a user text extractor.

    python -m capsight analyze FOLDER --extractor [NAME=]pkg.module:function [--extractor ...] [--timeout-ms N]
        [--provider NAME] [--hint TEXT] [--store PATH] --out PATH [--modified-after TS]
        [--vision heuristic|disabled] [--max-summary-chars N] [--master URL]
    python -m capsight compare REQUESTS.csv FOLDER --extractor pkg.module:function --out PATH [...]

Several extractors run in turn on each image until one gives text; NAME is the provider they report.

Writes JSON lines to the folder ``--out``: one object per capture with the text block, the handoff block and the
normalized record as JSON; ``compare`` writes the comparisons (with records and block) and the members' analyses.
"""

from __future__ import annotations

import argparse
import importlib


def _load(spec: str):
    module, _, name = spec.partition(":")
    return getattr(importlib.import_module(module), name)


def _extractors(specs: list[str] | None, provider: str) -> list[tuple[str, object]]:
    """The chain of ``[NAME=]module:function`` arguments."""
    found = [spec.rpartition("=") for spec in specs or ["capsight.operators.ocr:utf8_extractor"]]
    return [(name or provider, _load(spec)) for name, _, spec in found]


def rendered(analyses):
    """Each analysis with its text block, its handoff block and the normalized record as JSON."""
    from pyspark.sql import functions as F

    from capsight.operators.analyze import ANALYSIS_COLUMNS, render_block
    from capsight.operators.handoff import render_handoff
    from capsight.sources.sinks import as_json
    normalized = [c for c in ANALYSIS_COLUMNS if c not in ("error", "message", "ocr_provider")]
    return analyses.select("file_path", "kind", "confidence", "title", "error", "message",
                           render_block().alias("image_block"), render_handoff().alias("handoff_block"), as_json(normalized).alias("normalized"))


def main(argv=None) -> None:
    p = argparse.ArgumentParser(prog="capsight")
    sub = p.add_subparsers(dest="cmd", required=True)
    a = sub.add_parser("analyze", help="analyse every image under a folder")
    a.add_argument("folder")
    a.add_argument("--extractor", action="append")
    a.add_argument("--provider", default="custom")
    a.add_argument("--timeout-ms", type=int)
    a.add_argument("--hint")
    a.add_argument("--store")
    a.add_argument("--out", required=True)
    a.add_argument("--modified-after")
    a.add_argument("--vision", default="heuristic", choices=("heuristic", "disabled"))
    a.add_argument("--max-summary-chars", type=int, default=4000)
    a.add_argument("--master")
    c = sub.add_parser("compare", help="compare groups of files: a CSV of group_id,pos,file_path")
    c.add_argument("requests")
    c.add_argument("folder")
    c.add_argument("--extractor", action="append")
    c.add_argument("--provider", default="custom")
    c.add_argument("--timeout-ms", type=int)
    c.add_argument("--hint")
    c.add_argument("--store")
    c.add_argument("--out", required=True)
    c.add_argument("--master")
    args = p.parse_args(argv)

    from pyspark.sql import SparkSession

    from capsight.plans.jobs import analyze_folder
    from capsight.session import ensure_checkpoint_dir

    builder = SparkSession.builder.appName("capsight")
    if args.master:
        builder = builder.master(args.master)
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    if args.cmd == "compare":
        from capsight.operators.compare import render_compare, with_member_lists
        from capsight.plans.jobs import compare_requests
        analyses = analyze_folder(spark, args.folder, chain=_extractors(args.extractor, args.provider), timeout_ms=args.timeout_ms,
                                  hint=args.hint, store_path=args.store)
        requests = spark.read.schema("group_id bigint, pos int, file_path string").csv(args.requests, header=True)
        compared, listed = compare_requests(requests, analyses)
        whole = with_member_lists(compared, listed)
        whole.select(*whole.columns, render_compare().alias("compare_block")).write.mode("overwrite").json(f"{args.out}/comparisons")
        asked = requests.join(rendered(analyses), "file_path", "left")
        asked.write.mode("overwrite").json(f"{args.out}/members")
        spark.stop()
        return
    df = analyze_folder(spark, args.folder, chain=_extractors(args.extractor, args.provider), timeout_ms=args.timeout_ms, hint=args.hint,
                        store_path=args.store, modified_after=args.modified_after, vision=args.vision,
                        max_summary_chars=args.max_summary_chars)
    rendered(df).write.mode("overwrite").json(args.out)
    spark.stop()


if __name__ == "__main__":
    main()
