"""URL filter: a weighted vocabulary of strict and soft terms, counted by one Aho-Corasick automaton.

``judge`` adds the number of distinct strict and soft terms found in host and path.  A term counts only
between boundaries: the characters next to it are not ASCII letters or digits.  A url is blocked on one
strict term or on ``soft_limit`` distinct soft terms.  Host rules (``block``/``allow``) come first: a rule
``host/path`` fits the host and its subdomains when the path starts with ``/path``; the longest rule wins.

Stays one narrow stage: the automaton is built once per task from the vocabulary (a parameter), nothing is
shuffled or broadcast.  Null urls and urls without ``://`` have an empty host and path, match no rule and no
term, and are allowed.  Repeated rows are judged alike; other columns pass through untouched, and columns of
the input named like an output column are replaced by it.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from capsight.llm.common import table, workers_import

#: weight 2: strict, one hit blocks; weight 1: soft, several distinct hits block.
VOCABULARY: dict[str, int] = dict.fromkeys((
    "adult", "adults-only", "bets", "casino", "casinos", "escort", "escorts", "hentai", "nsfw", "payday-loan",
    "phishing", "poker", "porn", "porno", "sexcam", "sexcams", "slots", "spam", "torrent-cracks", "viagra",
    "warez", "webcam-girls", "xxx"), 2) | dict.fromkeys((
        "ad", "ads", "affiliate", "banner", "bet", "bonus", "buy", "cam", "cheap", "click", "clicks", "crack", "dating",
        "deal", "deals", "discount", "farm", "free", "girls", "jackpot", "keygen", "loan", "loans", "lottery", "nude",
        "offer", "offers", "pharmacy", "pill", "pills", "popup", "prize", "promo", "replica", "sex", "sexy", "sponsor",
        "track", "tracker", "tracking", "win", "winner"), 1)

#: (host, path, verdict)
RULES: tuple[tuple[str, str, str], ...] = (
    ("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_column(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), _UPPER, _LOWER), F.lit(""))


def path_column(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_columns(rules: Sequence[tuple[str, str, str]], host: Column, path: Column) -> tuple[Column, Column]:
    """The longest fitting rule as ``host/path`` text and its verdict; nulls if none fits."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: (len(r[0] + r[1]), r)):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name, verdict = F.when(fits, h + p).otherwise(name), F.when(fits, v).otherwise(verdict)
    return name, verdict


def _counter(vocabulary: Mapping[str, int]):
    """A pandas function ``texts -> strict, soft``: distinct terms between boundaries."""
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        import ahocorasick

        automaton = ahocorasick.Automaton()
        for term, weight in vocabulary.items():
            automaton.add_word(term, (term, weight))
        if vocabulary:
            automaton.make_automaton()

        def hits(text: str) -> tuple[int, int]:
            found = {}
            for end, (term, weight) in automaton.iter(text):
                at = end - len(term)
                before, after = text[at:at + 1] if at >= 0 else "", text[end + 1:end + 2]
                if not (before.isascii() and before.isalnum()) and not (after.isascii() and after.isalnum()):
                    found[term] = weight
            strict = sum(w >= 2 for w in found.values())
            return strict, len(found) - strict

        for texts in batches:
            yield pd.DataFrame([hits(t) if vocabulary else (0, 0) for t in texts], columns=["strict", "soft"], dtype="int64")
    return count


def judge(pages: DataFrame, url: str = "url", vocabulary: Mapping[str, int] = VOCABULARY,
          rules: Sequence[tuple[str, str, str]] = RULES, soft_limit: int = 2) -> DataFrame:
    """``pages`` with ``host, path, strict_hits, soft_hits, rule, verdict`` (``allow``/``block``)."""
    workers_import(pages.sparkSession)
    count = F.pandas_udf(_counter(vocabulary), "strict long, soft long")
    host, path = host_column(F.col(url)), path_column(F.col(url))
    hits = count(F.translate(F.concat(host, path), _UPPER, _LOWER))
    rule, verdict = rule_columns(rules, F.col("host"), F.col("path"))
    own = F.when((F.col("strict_hits") >= 1) | (F.col("soft_hits") >= soft_limit), "block").otherwise("allow")
    out = pages.withColumn("_hits", hits).withColumns({"host": host, "path": path})
    out = out.withColumns({"strict_hits": F.col("_hits.strict"), "soft_hits": F.col("_hits.soft")}).drop("_hits")
    return out.withColumns({"rule": rule, "verdict": F.coalesce(verdict, own)})


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = judge(table(spark, sf_dir, "pages"))
    return out.select("page_id", "host", "path", "rule", "verdict", "strict_hits", "soft_hits")


def _sql() -> str:
    """The same verdicts in DuckDB: a term counts if a boundary regex finds it."""
    def hits(weight: int) -> str:
        terms = [t for t, w in VOCABULARY.items() if w == weight]
        return " + ".join(f"regexp_matches(t, '(^|[^a-z0-9]){t}([^a-z0-9]|$)')::bigint" for t in terms)
    return f"""
WITH p AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN url[position('://' in url) + 3:] ELSE '' END AS r FROM pages
), q AS (
  SELECT page_id, translate(regexp_extract(r, '^[^/?#]*'), '{_UPPER}', '{_LOWER}') AS host,
         regexp_extract(regexp_replace(r, '^[^/?#]*', ''), '^[^?#]*') AS path FROM p
), c AS (
  SELECT *, translate(host || path, '{_UPPER}', '{_LOWER}') AS t, '.' || host AS d FROM q
), h AS (
  SELECT page_id, host, path, ({hits(2)})::bigint AS strict_hits, ({hits(1)})::bigint AS soft_hits,
    CASE WHEN ends_with(d, '.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
         WHEN ends_with(d, '.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
         WHEN ends_with(d, '.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
         WHEN ends_with(d, '.net') AND starts_with(path, '/') THEN 'net/' END AS rule FROM c
)
SELECT page_id, host, path, rule, strict_hits, soft_hits,
  CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
       WHEN strict_hits >= 1 OR soft_hits >= 2 THEN 'block' ELSE 'allow' END AS verdict
FROM h"""


QUERY = {"op3_url_filter": op3_url_filter}
ORACLE = {"op3_url_filter": _sql()}
