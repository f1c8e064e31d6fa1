"""JavaScript text semantics as Spark column expressions.

The rules being reproduced were written against JavaScript strings and regular
expressions.  Java (Spark) differs in three places that matter here:

* ``\\b`` - JS without the ``u`` flag uses an ASCII word boundary; Java treats Han
  characters as word characters.  ``B`` below is the ASCII boundary.
* ``\\s`` / ``trim()`` - JS includes the Unicode space separators, Java's ``\\s`` and
  Spark's ``trim`` are ASCII only.  ``W`` is the JS class, ``WS_CHARS`` the same
  set for ``btrim``.
* ``$`` - Java's ``$`` also matches before a final line terminator; ``\\z`` is used.

Every pattern is written once as a template with boundary (``{B}``, ``{LB}``,
``{RB}``, ``{LN}``, ``{RN}``), ``{W}``, ``{NW}``, ``{DOT}`` and ``{HAN}`` slots and
rendered for Java (Spark) or RE2 (DuckDB, used only by the test oracles).
Lengths are code points on both engines.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_WORD = "A-Za-z0-9_"

# JavaScript whitespace (String.prototype.trim and \s), as a character class
# and as a plain character set.
W = r"[\t-\r \x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}\x{feff}]"
NW = "[^" + W[1:]
WS_CHARS = (
    "\t\n\x0b\x0c\r \xa0 "
    + "".join(chr(c) for c in range(0x2000, 0x200B))
    + "    　﻿"
)
# JS "." (no s flag) excludes only these line terminators.
DOT = r"[^\n\r\x{2028}\x{2029}]"

# Boundary slots.  ``B`` is the general ASCII word boundary.  Next to a character
# the pattern itself fixes, a boundary reduces to one lookaround: ``LB``/``RB``
# sit before/after a word character, ``LN``/``RN`` before/after a non-word
# character.  Same meaning, far fewer steps per position in Java; RE2 uses \b.
_SLOTS = {
    "java": {
        "B": rf"(?:(?<![{_WORD}])(?=[{_WORD}])|(?<=[{_WORD}])(?![{_WORD}]))",
        "LB": rf"(?<![{_WORD}])", "RB": rf"(?![{_WORD}])",
        "LN": rf"(?<=[{_WORD}])", "RN": rf"(?=[{_WORD}])",
        "W": W, "NW": NW, "DOT": DOT, "HAN": r"\p{IsHan}",
    },
    # for texts known to be ASCII: the white space of the class as one bit set
    "ascii": {"W": r"[\t\n\x0b\f\r ]", "NW": r"[^\t\n\x0b\f\r ]"},
    "re2": {"B": r"\b", "LB": r"\b", "RB": r"\b", "LN": r"\b", "RN": r"\b",
            "W": W, "NW": NW, "DOT": DOT, "HAN": r"\p{Han}"},
}

# Pattern templates (see the module docstring for the slots).
PATTERNS = {
    "clock": r"{LB}\d{1,2}:\d{2}{RB}",
    "speaker": r"^[A-Za-z][A-Za-z0-9 _-]{1,20}\z",
    "heading": r"(?i)第{DOT}+章|第{DOT}+节|chapter|section|摘要|目录",
    "numbered": r"^\d+[.)]",
    "instruction": r"[:：-]|^\d+\.",
    "amount_han": r"(?i)(?:合计|实付|应付|总计)[^\d]{0,8}(\d+(?:\.\d{1,2})?)",
    "amount_en": r"(?i)(?:total|amount)[^\d]{0,8}(\d+(?:\.\d{1,2})?)",
    "date_dash": r"{LB}20\d{2}[/\-.]\d{1,2}[/\-.]\d{1,2}{RB}",
    "phone": r"{LB}1[3-9]\d{9}{RB}",
    "email": r"(?i)[A-Z0-9._%+-]+@[A-Z0-9.-]+\.[A-Z]{2,}",
    "url_http": r"(?i)https?://{NW}+",
    "url_www": r"(?i){LB}www\.{NW}+\.[A-Z]{2,}{RB}",
    "eleven_digits": r"{LB}\d{11}{RB}",
    "long_id": r"{LB}\d{15,19}{RB}",
    "digit_run_15": r"\d(?:{W}*\d){14}",
    "han": r"{HAN}",
    "receipt_total": r"(?i)total|合计|实付|应付",
    "receipt_date": r"(?i)日期|时间|date|time",
    "receipt_tax": r"(?i)税|tax|invoice|发票",
    "chart_trend": r"(?i)%|同比|环比|增长|下降|trend",
    "chart_metric": r"(?i)GMV|DAU|MAU|CTR|ROI|收入|成本|订单",
    "chart_rate": r"(?i)%|同比|环比|增长|下降",
    "section_marker": r"(?i)第{DOT}+章|section|chapter",
    "list_item": r"^{W}*(?:\d+[.)]|[-*•]){W}+",
    "tabular": r"{W}{2,}|\t",
    "tabular_line": r"{W}{2,}|\t|[:：]{W}*{NW}",
    "ends_with_number": r"\d\z",
    "han_or_latin": r"[{HAN}A-Za-z]",
    "metric": r"(?i){LB}(?:GMV|DAU|MAU|CTR|ROI|ARPU|CAC|LTV){RB}",
    "percent": r"-?\d+(?:\.\d+)?%",
    "period": r"(?i)(?:{LB}(?:Q[1-4]|20\d{2}[/-]\d{1,2}){RB}|{LN}(?:本周|本月|今日|昨天){RN})",
    "ws_run": r"{W}+",
}

# ASCII characters a match may begin with, and whether it may begin with another one: Java tries every alternative and every
# lookbehind at every position unless one look ahead rules them out.
STARTS = {
    "clock": ("0-9", False), "heading": ("cCsS", True), "section_marker": ("cCsS", True), "amount_han": ("", True), "amount_en": ("tTaA", False),
    "date_dash": ("2", False), "phone": ("1", False), "url_www": ("wW", False), "eleven_digits": ("0-9", False), "long_id": ("0-9", False),
    "metric": ("gGdDmMcCrRaAlL", False), "period": ("qQ2", True),
}


def render(template: str, dialect: str = "java") -> str:
    """Fill the slots of a pattern template for ``java`` or ``re2``."""
    out = template
    for key, value in _SLOTS[dialect].items():
        out = out.replace("{" + key + "}", value)
    return out


# A literal every match of the pattern contains: when the text lacks it, the
# pattern cannot match and the regex is not run at all.
REQUIRED = {"clock": ":", "email": "@", "url_http": "://", "percent": "%"}

# Patterns that are words in any case of ASCII letters (none holds a "k", which other letters have as their lower case).
WORDS = ("receipt_total", "receipt_date", "receipt_tax", "chart_trend", "chart_metric", "chart_rate")


def rx(name: str, dialect: str = "java") -> str:
    pattern = render(PATTERNS[name], dialect)
    if dialect == "re2" or name not in STARTS:
        return pattern
    ascii_, other = STARTS[name]
    return f"(?=[{ascii_ and f'[{ascii_}]'}{'[^\\x00-\\x7f]' * other}])(?:{pattern})"


# Han date, with ASCII-alphanumeric guards on both sides.  RE2 has no
# lookaround, so the oracle form consumes the guards and returns group 1.
DATE_HAN_JAVA = r"(?<![a-zA-Z0-9])\d{4}年\d{1,2}月\d{1,2}日(?![a-zA-Z0-9])"
REQUIRED[DATE_HAN_JAVA] = "年"
DATE_HAN_RE2 = r"(?:^|[^a-zA-Z0-9])(\d{4}年\d{1,2}月\d{1,2}日)(?:[^a-zA-Z0-9]|\z)"


# --- column helpers -----------------------------------------------------------

def js_trim(c: Column) -> Column:
    """``String.prototype.trim``: strip JS whitespace from both ends."""
    return F.btrim(c, F.lit(WS_CHARS))


def clean_lines(text: Column) -> Column:
    """Split on LF, trim each line, drop blank lines."""
    return F.filter(F.transform(F.split(text, "\n"), js_trim), lambda x: x != "")


def unique(arr: Column) -> Column:
    """First-seen order de-duplication that also drops empty strings."""
    return F.filter(F.array_distinct(arr), lambda x: x != "")


def guard(text: Column, name: str, value: Column, otherwise) -> Column:
    """``value`` only where ``text`` holds the pattern's required literal."""
    lit = REQUIRED.get(name)
    if lit is None:
        return value
    return F.when(F.contains(text, F.lit(lit)), value).otherwise(otherwise)


def once(value: Column, then) -> Column:
    """``then(value)`` with ``value`` computed once: the branches of a ``when`` would each compute it again."""
    return F.get(F.transform(F.array(value), then), 0)


def is_ascii(text: Column) -> Column:
    return F.octet_length(text) == F.length(text)


def has(c: Column, name: str) -> Column:
    if name in WORDS:
        return any_contains(F.lower(c), PATTERNS[name].removeprefix("(?i)").lower().split("|"))
    return guard(c, name, c.rlike(rx(name)), F.lit(False))


def extract_all(text: Column, name: str) -> Column:
    return guard(text, name, F.regexp_extract_all(text, F.lit(rx(name)), 0), F.array().cast("array<string>"))


def first_match(text: Column, *specs) -> Column:
    """First pattern with a match wins; its group (or the whole match), trimmed.

    ``specs`` are ``(name_or_java_pattern, group)`` pairs.  Empty results mean "no
    match", which is the same thing for every pattern used here (none can match
    blanks).
    """
    outs = []
    for p, g in specs:
        pattern = rx(p) if p in PATTERNS else p
        found = once(js_trim(F.regexp_extract(text, pattern, g)), lambda v: F.when(v != "", v))
        outs.append(guard(text, p, found, F.lit(None).cast("string")))
    return F.coalesce(*outs)


def _is_han(word: str) -> bool:
    return all("\u3400" <= ch <= "\u9fff" for ch in word)


def count_contains(text: Column, words, han_present: Column | None = None) -> Column:
    """How many of ``words`` occur in ``text`` as plain substrings.

    Keywords made of Han characters can only occur in a text holding a Han
    character; ``han_present`` (a precomputed test) skips those scans otherwise.
    """
    def total(ws):
        out = None
        for w in ws:
            term = F.when(F.contains(text, F.lit(w)), 1).otherwise(0)
            out = term if out is None else out + term
        return out if out is not None else F.lit(0)

    han = [w for w in words if _is_han(w)]
    other = [w for w in words if not _is_han(w)]
    if han_present is None or not han:
        return total(words)
    return total(other) + F.when(han_present, total(han)).otherwise(F.lit(0))


def any_contains(text: Column, words) -> Column:
    out = None
    for w in words:
        term = F.contains(text, F.lit(w))
        out = term if out is None else (out | term)
    return out


def lit_array(values) -> Column:
    return F.array(*[F.lit(v) for v in values]) if values else F.array().cast("array<string>")


def count_lines(lines: Column, pred) -> Column:
    return F.size(F.filter(lines, pred))


def cut(text: Column, limit: int, keep: int) -> Column:
    """Longer than ``limit`` code points -> first ``keep`` plus ``...``."""
    return F.when(F.length(text) <= limit, text).otherwise(F.concat(F.substring(text, 1, keep), F.lit("...")))


def or_none(arr: Column, sep: str = ", ") -> Column:
    """Join a list for a text block; ``(none)`` when empty."""
    return F.when(F.size(arr) > 0, F.array_join(arr, sep)).otherwise(F.lit("(none)"))


def per_context(fn):
    """Cache a zero-argument builder of column expressions per active SparkContext.

    The analysis builds a few thousand expression nodes through the Python
    bridge; they are immutable and refer to columns by name, so one set per
    context is reused by every job (driver-side planning time only).
    """
    cache: dict = {}

    def wrapper(*args):
        from pyspark import SparkContext
        sc = SparkContext._active_spark_context
        key = (sc.applicationId if sc is not None else None, args)
        if key not in cache:
            cache[key] = fn(*args)
        return cache[key]

    wrapper.__doc__ = fn.__doc__
    return wrapper
