"""Secret scan: candidates by pattern, a random forest that removes false positives. DataFrame operations only.

``candidates`` cuts every whole text at runs of ``RUN`` characters or more of key alphabets, tokens with dots, passwords in urls, and
values of ``SHORT`` characters or more that are assigned to a name with a keyword; each with its neighbourhood (up to ``NEAR`` characters each
side, whatever stands there) is a candidate.  A ``name=`` in front is no part of it.  Features are columns: length, shares and transitions of character classes, distinct
characters, dictionary coverage, path signs, words and signs around.  ``train`` fits a random forest (spark.ml) to labelled
findings; by default to ``labelled_findings``, a table of ``rows`` rows derived from a rule (formats of keys and tokens against
digests, identifiers, words, numbers, paths and placeholders).  Pass findings reviewed by people to train on those.  The forest has
``TREES`` trees of depth ``DEPTH`` at most, whatever the corpus.

``scan`` returns every candidate with its probability and verdict; ``redact`` replaces the secrets in the texts.  Starts are running sums
inside one document's candidates; texts are never shuffled by ``scan``.

Null and empty texts have no candidates.  Repeated rows give their findings once each in ``scan``; ``redact`` treats them alike.  Rows with a null id are
scanned and redacted too.  Empty tables give empty results.  Other columns pass through ``redact`` and are ignored by ``scan``.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from capsight.llm.common import fresh, table

ALPHABET = r"[A-Za-z0-9+/_\-]"
RUN = 16
SHORT = 6
NEAR = 60
TREES, DEPTH, ROWS, SEED = 40, 8, 6000, 5
THRESHOLD = 0.5
MASK = "[SECRET]"

DICTIONARY = (
    "access", "account", "after", "again", "allow", "and", "animal", "application", "array", "auch", "avec", "before", "build", "button", "change",
    "class", "client", "code", "color", "comment", "config", "content", "control", "count", "data", "database", "date", "debug", "default",
    "dem", "der", "des", "die", "directory", "document", "ein", "element", "ent", "entre", "error", "event", "example", "export", "factory",
    "field", "file", "for", "from", "function", "global", "group", "handler", "heit", "image", "import", "index", "information", "ing", "input",
    "instance", "international", "item", "keit", "language", "les", "lich", "list", "local", "manager", "ment", "message", "method", "model",
    "module", "name", "nicht", "number", "object", "oder", "option", "order", "over", "package", "page", "para", "path", "point", "pour",
    "process", "product", "project", "que", "query", "record", "request", "response", "result", "sch", "schema", "script", "server", "service",
    "session", "source", "status", "string", "system", "table", "target", "test", "that", "the", "this", "time", "tion", "type", "und",
    "ung", "update", "user", "util", "value", "vector", "version", "view", "with", "word", "world")

KEYWORD = r"(?i)(?:token|secret|passw(?:or)?d|passwd|pwd|api[_ -]?key|apikey|access[_ -]?key|auth(?:orization)?|bearer|credential|private[_ -]?key|client[_ -]?secret)"
HARMLESS = r"(?i)(?:commit|checksum|digest|sha-?\d*|md5|uuid|guid|etag|integrity|revision|hash|fingerprint|build|version|trace|span|request)"
PLACEHOLDER = r"(?i)(?:example|sample|dummy|changeme|placeholder|your|xxxx|0000|1234567|abcdef|redacted)"
PREFIX = r"^(?:AKIA|ASIA|ghp_|gho_|ghs_|github_pat_|glpat-|sk_live_|sk-|rk_live_|xox[abpr]-|AIza|eyJ|SG\.|npm_|pypi-)"

#: a keyword, the rest of its name and the sign of an assignment (bounded, as it is looked for backwards, and only behind a sign)
_NAMED = (r"(?<=[=:\s\"'`])(?<=[=:]|[=:]\s|[=:][\"'`]|[=:]\s[\"'`])(?<=(?i:token|secret|passw(?:or)?d|passwd|passphrase|pwd|api[_ -]?key|access[_ -]?key|auth|authorization|"
          r"credential|private[_ -]?key)[A-Za-z0-9_-]{0,40}[\"'`\]]{0,2}\s{0,2}(?:=|:|=>|:=|==)\s{0,1}[\"'`]{0,1})(?!(?i:bearer|basic|token)\s)")
#: characters that mark the candidates of a text in one pass; a text that holds one of them is scanned twice instead
OPEN, CLOSE = "\u0001", "\u0002"


def pattern(run: int = RUN) -> str:
    """The candidates: passwords in urls, tokens with dots, assigned values (quoted or not), runs of the key alphabet.

    Nothing is tried inside a word, but for a run at the end of the last candidate; so most places of a text cost one look back.
    """
    keys = rf"{ALPHABET}{{{run},}}(?:={{1,2}}(?![A-Za-z0-9+/_=\-]))?"
    quoted, bare = rf"(?<=[\"'`])[^\s\"'`]{{{SHORT},}}(?=[\"'`])", rf"[^\s\"'`<>,;]{{{SHORT - 1},}}[^\s\"'`<>,;.:!?)\]}}]"
    first = "|".join((
        r"(?<=:)(?<=://[^\s/:@]{0,60}:)[^\s/@\"'<>]{3,}(?=@)",
        r"(?:SG\.|eyJ)[A-Za-z0-9_-]{10,}(?:\.[A-Za-z0-9_-]{6,})+",
        f"{_NAMED}(?:{quoted}|{bare})",
        rf"(?<![+/_\-]){keys}"))
    return rf"(?<![A-Za-z0-9])(?:{first})|\G{keys}"


def _cut(text: Column, run: int) -> Column:
    """A text as ``[between, candidate, between, ..., between]``."""
    cut_at = pattern(run)
    marked = F.split(F.regexp_replace(text, f"({cut_at})", f"{OPEN}$1{CLOSE}"), f"[{OPEN}{CLOSE}]", -1)
    between, found = F.split(text, cut_at, -1), F.regexp_extract_all(text, F.lit(cut_at), F.lit(0))
    pairs = F.zip_with(between, found, lambda b, c: F.array(b, c))
    twice = F.filter(F.flatten(pairs), lambda x: x.isNotNull())
    return F.when(F.contains(text, F.lit(OPEN)) | F.contains(text, F.lit(CLOSE)), twice).otherwise(marked)


def _places(parts: Column, first: int) -> Column:
    """Every other part, from ``first`` on."""
    return F.filter(parts, lambda _, i: i % 2 == first)


def _share(text: Column, drop: str) -> Column:
    """Share of the text's characters that the class ``drop`` matches."""
    return F.lit(1.0) - F.length(F.regexp_replace(text, drop, "")) / F.greatest(F.length(text), F.lit(1))


def _rate(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern)) / F.greatest(F.length(text) - 1, F.lit(1))


def _flag(c: Column) -> Column:
    return F.coalesce(c.cast("double"), F.lit(0.0))


def features() -> dict[str, Column]:
    """Feature columns of ``candidate, before, after``."""
    c, before, after = F.col("candidate"), F.col("before"), F.col("after")
    lower = F.lower(c)
    return {
        "length": F.least(F.length(c), F.lit(200)).cast("double"),
        "digits": _share(c, "[0-9]"), "uppers": _share(c, "[A-Z]"), "lowers": _share(c, "[a-z]"), "signs": _share(c, "[^A-Za-z0-9]"),
        "hex": _flag(c.rlike("^(?:[0-9a-f]+|[0-9A-F]+)$")),
        "distinct": F.size(F.array_distinct(F.split(c, ""))) / F.least(F.length(c), F.lit(64)),
        "letter_digit": _rate(c, "[A-Za-z](?=[0-9])|[0-9](?=[A-Za-z])"), "case_turns": _rate(c, "[a-z](?=[A-Z])|[A-Z](?=[a-z])"),
        "vowel_turns": _rate(lower, "[aeiouy](?=[bcdfghjklmnpqrstvwxz])|[bcdfghjklmnpqrstvwxz](?=[aeiouy])"), "repeats": _rate(c, r"(.)(?=\1)"),
        "dictionary": _share(lower, "(?:" + "|".join(sorted(DICTIONARY, key=lambda w: (-len(w), w))) + ")"),
        "prefix": _flag(c.rlike(PREFIX)), "slashes": _rate(c, "/"), "dashes": _rate(c, "[-_]"),
        "path": _flag(before.rlike(r"[./:]$") | c.startswith("/") | after.rlike(r"^\.[A-Za-z]")),
        "in_word": _flag(before.rlike(r"[\p{L}\p{N}]$") | after.rlike(r"^[\p{L}\p{N}]")),
        "assigned": _flag(before.rlike(r"[=:]\s*[\"'`]?$")), "quoted": _flag(before.rlike("[\"'`]$") & after.rlike("^[\"'`]")),
        "keyword": _flag(before.rlike(KEYWORD + r"[^\n]{0,20}$") | c.rlike(KEYWORD + "[=_-]")),
        "harmless": _flag(before.rlike(HARMLESS + r"[^\n]{0,12}$")),
        "placeholder": _flag(c.rlike(PLACEHOLDER)),
        "in_url": _flag(before.rlike(r"://[^\s/:@]*:$") & after.startswith("@")),
        "reference": _flag(c.rlike(r"[()\[\]{}$]|^[A-Za-z_]+(?:\.[A-Za-z_]+)+$")),
    }


FEATURES = (
    "length", "digits", "uppers", "lowers", "signs", "hex", "distinct", "letter_digit", "case_turns", "vowel_turns", "repeats", "dictionary",
    "prefix", "slashes", "dashes", "path", "in_word", "assigned", "quoted", "keyword", "harmless", "placeholder",
    "in_url", "reference")


def candidates(docs: DataFrame, text: str = "text", key: str = "doc_id", run: int = RUN) -> DataFrame:
    """``doc_id, text_key, start, candidate, before, after`` of every run; ``start`` counts characters from 0."""
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("_text")).filter("_text IS NOT NULL")
    rows = rows.select("doc_id", F.monotonically_increasing_id().alias("_row"), F.xxhash64("_text").alias("text_key"), F.explode(F.array(_cut(F.col("_text"), run))).alias("_parts"))
    rows = rows.filter(F.size("_parts") > 1).withColumns({"_found": _places(F.col("_parts"), 1), "_between": _places(F.col("_parts"), 0)})
    found, between = F.col("_found"), F.col("_between")
    # the text's ends before and after each candidate, of which so many make up the neighbourhood
    rows = rows.withColumn("_ends", F.zip_with(between, found, lambda b, c: F.right(F.concat(b, F.coalesce(c, F.lit(""))), F.lit(NEAR))))
    rows = rows.withColumn("_tails", F.zip_with(found, F.slice(between, 2, F.size(found)), lambda c, b: F.left(F.concat(c, b), F.lit(NEAR))))
    some = NEAR // 3 + 1
    cut = F.transform(found, lambda c, i: F.struct(
        c.alias("candidate"), F.length(F.element_at(between, i + 1)).alias("gap"),
        F.right(F.concat(F.array_join(F.slice(F.col("_ends"), F.greatest(i - some, F.lit(0)) + 1, F.least(i, F.lit(some))), ""), F.element_at(between, i + 1)), F.lit(NEAR)).alias("before"),
        F.left(F.concat(F.element_at(between, i + 2), F.array_join(F.slice(F.col("_tails"), i + 2, some), "")), F.lit(NEAR)).alias("after")))
    each = rows.select("doc_id", "text_key", "_row", F.posexplode(cut).alias("_at", "_c"))
    upto = Window.partitionBy("_row").orderBy("_at").rowsBetween(Window.unboundedPreceding, Window.currentRow)  # one document
    start = F.sum(F.col("_c.gap") + F.length("_c.candidate")).over(upto) - F.length("_c.candidate")
    return each.withColumn("start", start.cast("long")).select("doc_id", "text_key", "start", "_c.candidate", "_c.before", "_c.after")


def labelled_findings(spark: SparkSession, rows: int = ROWS) -> DataFrame:
    """``candidate, before, after, label``: findings of a rule, half of them secrets, all from hashes of the row number."""
    r = spark.range(rows).select("id", F.sha2(F.concat(F.lit("finding"), F.col("id").cast("string")), 512).alias("hex"))
    key64 = F.translate(F.base64(F.unhex(F.col("hex"))), "\r\n", "")
    def pick(salt: int, *values) -> Column:
        return F.element_at(F.array(*(F.lit(v) if isinstance(v, str) else v for v in values)), (F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(len(values))) + 1).cast("int"))

    number = F.conv(F.substring("hex", 1, 12), 16, 10)
    word = F.array_join(F.transform(F.sequence(F.lit(0), F.pmod(F.xxhash64("id", F.lit(9)), F.lit(5)) + 4), lambda i: F.element_at(
        F.array(*map(F.lit, ("the", "an", "er", "in", "re", "nd", "on", "th", "at", "ou", "ti", "es", "or", "he", "ble", "tion", "ment", "eau", "que", "ung", "heit", "sch", "ver", "ado", "cion", "mente", "ou", "ie", "pa", "le"))),
        (F.pmod(F.xxhash64("id", i, F.lit(8)), F.lit(30)) + 1).cast("int"))), "")
    word = F.rpad(word, 16, "entation")
    secret = pick(1, F.substring("hex", 1, 32), F.substring("hex", 1, 40), F.upper(F.substring("hex", 1, 40)), F.substring("hex", 1, 64), F.substring(key64, 1, 24), F.substring(key64, 1, 40),
                  F.substring(key64, 1, 64), F.concat(F.lit("AKIA"), F.upper(F.substring("hex", 1, 16))), F.concat(F.lit("ghp_"), F.regexp_replace(F.substring(key64, 1, 40), "[+/=]", "a")),
                  F.concat(F.lit("sk_live_"), F.substring("hex", 1, 24)), F.concat(F.lit("xoxb-"), number, F.lit("-"), F.substring("hex", 1, 24)), F.concat(F.lit("AIza"), F.regexp_replace(F.substring(key64, 1, 35), "[+/=]", "b")))
    lead = pick(2, " token = \"", " TOKEN = \"", " api_key: ", " API_KEY=", " password = '", "secret=\"", " \"client_secret\": \"", " Authorization: Bearer ", " access key ", " aws_secret_access_key = ", " auth_token: ", " the secret is ")
    tail = pick(3, "\" the", "\"", "'", "\n", " and", ".", ",", "\"!! AND")
    neither = pick(4, word, F.upper(word), F.initcap(word), F.lpad(F.substring(number, 1, 16), 16, "4"), F.concat(number, F.substring(number, 1, 8)),
                   F.concat(F.lit("/usr/share/"), F.substring(word, 1, 9), F.lit("/"), F.substring(word, 3, 6)), F.concat_ws("-", F.substring(word, 1, 6), F.substring(word, 4, 5), F.substring(word, 2, 7)),
                   F.concat(F.lit("get"), F.initcap(F.substring(word, 1, 7)), F.lit("From"), F.initcap(F.substring(word, 5, 8))), F.concat_ws("_", F.lit("max"), F.substring(word, 2, 6), F.lit("request_count")),
                   F.concat_ws("-", F.substring("hex", 1, 8), F.substring("hex", 9, 4), F.substring("hex", 13, 4), F.substring("hex", 17, 4), F.substring("hex", 21, 12)),
                   F.substring("hex", 1, 40), F.substring("hex", 1, 64), F.substring("hex", 1, 32), F.repeat(F.substring("hex", 1, 1), 24), F.lit("----------------------------"),
                   F.lit("your_api_key_goes_here"), F.concat(F.lit("example-"), F.substring(word, 1, 14)), F.concat(F.lit("xxxxxxxxxxxxxxxx"), F.substring("hex", 1, 4)), F.lit("=================="))
    digest = neither.rlike("^(?:[0-9a-f]{32,}|[0-9a-f]{8}-)")
    plain = F.when(digest, pick(5, " commit ", " sha256:", " checksum ", " ETag: ", " build-hash ", " uuid ", " md5 = ")).otherwise(
        pick(6, " the ", " of ", " und ", ". ", "\n", " | ", " pour ", "é", " https://www.example.com/", " = ", ": ", " token of ", " password: "))
    after = F.when(digest, pick(10, " by", "\n", ",", " on main")).otherwise(pick(7, " the", ". ", ", ", "!! ", "ä", " | ", "\n", " de", ".html"))
    odd = F.pmod(F.col("id"), F.lit(2)) == 1
    # a third of the rows: short values of assignments and of urls
    leet = F.translate(F.substring(word, 1, 7), "oeat", "0347")
    password = pick(11, F.concat(F.initcap(F.substring(word, 1, 6)), F.substring(number, 1, 3)), F.concat(F.initcap(leet), pick(12, "&", "!", "#", "_", "."), F.substring("hex", 3, 2), F.lit("7")),
                    F.concat(F.substring(word, 1, 5), F.substring(number, 2, 1), F.substring(word, 4, 2)), F.concat(leet, F.lit("Pass"), F.substring(number, 1, 2)), F.concat(F.lit("8"), F.substring(key64, 2, 9)))
    dotted = F.concat(F.lit("SG."), F.regexp_replace(F.substring(key64, 1, 22), "[+/=]", "a"), F.lit("."), F.regexp_replace(F.substring(key64, 23, 43), "[+/=]", "b"))
    named = pick(13, " password = \"", " db_password=\"", " password: ", " DB_PASSWORD=", " passwd = '", " secret=\"", " pwd: ", " \"password\": \"", " token=", " api_key = '")
    value = pick(14, F.substring(word, 1, 8), F.initcap(F.substring(word, 1, 7)), F.concat(F.lit("self."), F.substring(word, 1, 6)), F.concat(F.lit("get"), F.initcap(F.substring(word, 1, 6)), F.lit("()")),
                 F.concat(F.lit("${"), F.upper(F.substring(word, 1, 6)), F.lit("}")), F.lit("required"), F.lit("changeme"), F.lit("example"), F.concat(F.lit("your_"), F.substring(word, 1, 6)),
                 F.concat_ws("_", F.substring(word, 1, 5), F.substring(word, 3, 5)), F.substring(number, 1, 6), F.lit("xxxxxxxx"))
    kind = F.pmod(F.xxhash64("id", F.lit(15)), F.lit(12))
    short, url = kind < 4, odd & (kind == 0)
    secret, neither = F.when(short & (kind == 1), dotted).when(short, password).otherwise(secret), F.when(short, value).otherwise(neither)
    lead = F.when(url, pick(16, " https://bob:", " postgres://admin:", " ftp://user:", "mysql://root:")).when(short, named).otherwise(lead)
    tail = F.when(url, pick(17, "@host", "@db.example.com/x", "@10.0.0.1:80")).otherwise(tail)
    plain, after = F.when(short, named).otherwise(plain), F.when(short, tail).otherwise(after)
    return r.select("id", F.when(odd, secret).otherwise(neither).alias("candidate"), F.when(odd, lead).otherwise(plain).alias("before"),
                    F.when(odd, tail).otherwise(after).alias("after"), odd.cast("double").alias("label"))


def train(findings: DataFrame, trees: int = TREES, depth: int = DEPTH, seed: int = SEED) -> RandomForestClassificationModel:
    """A forest for rows ``candidate, before, after, label`` (1: a secret); null texts are empty, null labels left out."""
    rows = findings.filter("label IS NOT NULL").select(*(F.coalesce(c, F.lit("")).alias(c) for c in ("candidate", "before", "after")), F.col("label").cast("double").alias("label"))
    rows = VectorAssembler(inputCols=list(FEATURES), outputCol="_features").transform(rows.withColumns(features())).select("_features", "label")
    return RandomForestClassifier(featuresCol="_features", labelCol="label", probabilityCol="_probability", rawPredictionCol="_raw", predictionCol="_class",
                                  numTrees=trees, maxDepth=depth, seed=seed, maxMemoryInMB=64).fit(rows)


def score(found: DataFrame, model: RandomForestClassificationModel, threshold: float = THRESHOLD) -> DataFrame:
    """``found`` with ``probability`` of a secret and ``is_secret``."""
    own = found.columns
    rows = VectorAssembler(inputCols=list(FEATURES), outputCol="_features").transform(found.withColumns(features()))
    out = model.transform(rows).withColumn("probability", F.element_at(vector_to_array("_probability"), 2))
    return out.select(*own, "probability", (F.col("probability") >= threshold).alias("is_secret"))


def scan(docs: DataFrame, model: RandomForestClassificationModel, text: str = "text", key: str = "doc_id", threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, text_key, start, candidate, before, after, probability, is_secret`` of every candidate."""
    return score(candidates(docs, text, key), model, threshold)


def redact(docs: DataFrame, found: DataFrame, text: str = "text", key: str = "doc_id", mask: str = MASK, run: int = RUN) -> DataFrame:
    """``docs`` with every run that ``found`` calls a secret of its text replaced; ``n_chars`` follows if present."""
    hash_, known = fresh(docs, "_key"), fresh(docs, "_secrets")
    secrets = found.filter("is_secret").groupBy(F.col("text_key").alias(hash_)).agg(F.collect_set("candidate").alias(known))  # of one text
    rows = docs.withColumn(hash_, F.xxhash64(text)).join(secrets, hash_, "left")
    parts = F.transform(_cut(F.col(text), run), lambda c, i: F.when((i % 2 == 1) & F.array_contains(known, c), mask).otherwise(c))
    out = rows.withColumn(text, F.when(F.col(known).isNull(), F.col(text)).otherwise(F.array_join(parts, "")))
    if "n_chars" in docs.columns and "n_chars" != text:
        out = out.withColumn("n_chars", F.when(F.col(known).isNull(), F.col("n_chars")).otherwise(F.length(text)).cast(dict(docs.dtypes)["n_chars"]))
    return out.select(*docs.columns)


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(table(spark, sf_dir, "documents"), train(labelled_findings(spark)))
    return found.select("doc_id", "start", F.length("candidate").cast("long").alias("length"), "candidate", "probability", "is_secret")


QUERY = {"op9_secret_scan": op9_secret_scan}
