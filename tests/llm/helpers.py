"""Rows with every edge the operators promise to handle, and brute-force versions."""

from __future__ import annotations

import collections
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PROSE = "the quick brown fox jumps over the lazy dog and runs on through the wood until it is dark again "


def prose(seed: int, words: int) -> str:
    base = PROSE.split()
    return " ".join(f"{base[(i * 7 + seed * 3 + i * i % 11) % len(base)]}{(i * 13 + seed) % 17 or ''}" for i in range(words))


def documents(spark: SparkSession) -> DataFrame:
    """Nulls in every column, empty, blank and very long texts, ties, repeated rows and columns that clash with internal names."""
    rows = [(i, prose(i, 20 + i), "en", f"src{i % 4}", 5) for i in range(24)]
    rows += [(100, None, "en", "src0", None), (101, "", None, "src1", 0), (102, " \n\t ", "de", None, 4), (103, prose(1, 21), None, None, 9),
             (104, prose(3, 60_000), "fr", "src0", 1), (105, "x" * 70_000, "en", "src2", 70_000), (None, prose(9, 30), "en", "src3", 2),
             (106, "one", "en", "src1", 3), (107, "one", "en", "src1", 3), (107, "one", "en", "src1", 3), (0, prose(0, 20), "en", "src0", 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return df.withColumns({c: F.lit(k) for k, c in enumerate(("size", "node", "score", "cid", "_key", "_quality", "_uid", "n", "path", "quality_score"))})


def words(text: str | None) -> list[bytes]:
    return re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())


def shingle_links(texts: dict, width: int = 5, percent: int = 75) -> dict:
    """``id -> (set size, smallest linked id, links)`` by comparing all pairs."""
    sets = {}
    for i, text in texts.items():
        w = words((text or "").translate({c: c + 32 for c in range(65, 91)}))
        sets[i] = {tuple(w[k:k + width]) for k in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set())
    parent, links = {i: i for i in sets}, collections.Counter()

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for i in sets:
        for j in sets:
            if i < j and sets[i] and sets[j]:
                common = len(sets[i] & sets[j])
                if 100 * common >= percent * (len(sets[i]) + len(sets[j]) - common):
                    links[i] += 1
                    links[j] += 1
                    a, b = root(i), root(j)
                    parent[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), root(i), links[i]) for i in sets}
