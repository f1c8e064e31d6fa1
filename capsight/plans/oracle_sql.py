"""DuckDB restatements of the jobs, used as the correctness oracle.

These are plain SQL over the driver's base views (``documents``,
``conversations``); every statement inlines the fixture CTE.  They share only
*data* with the Spark jobs (keyword lists, constants, pattern templates rendered
for RE2) - the logic is written again in SQL, so a Spark-side slip shows up as a
mismatch.  DuckDB's ``\\b`` is already the ASCII boundary; lists keep order via
``list_filter(l, lambda v, i: list_position(l, v) = i)``.
"""

from __future__ import annotations

from capsight.functions import rules as R
from capsight.functions.text import DATE_HAN_RE2, WS_CHARS, rx
from capsight.sources.fixtures import CAPTURES_SQL, MESSAGES_SQL

WS = "(" + "||".join(f"chr({ord(c)})" for c in WS_CHARS) + ")"
EMPTY = "[]::VARCHAR[]"


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def p(name: str) -> str:
    return q(rx(name, "re2"))


def tr(x: str) -> str:
    return f"trim({x}, {WS})"


def arr(values) -> str:
    return "[" + ", ".join(q(v) for v in values) + "]::VARCHAR[]" if values else EMPTY


def uniq(col: str) -> str:
    return f"list_filter({col}, lambda v, i: v <> '' AND list_position({col}, v) = i)"


def clean_lines(x: str) -> str:
    return f"list_filter(list_transform(string_split({x}, chr(10)), lambda s: {tr('s')}), lambda s: s <> '')"


def nonnull(*items: str) -> str:
    return "list_filter([" + ", ".join(items) + "]::VARCHAR[], lambda x: x IS NOT NULL)"


def count_words(col: str, words) -> str:
    return "(" + " + ".join(f"(CASE WHEN contains({col}, {q(w)}) THEN 1 ELSE 0 END)" for w in words) + ")"


def any_words(col: str, words) -> str:
    return "(" + " OR ".join(f"contains({col}, {q(w)})" for w in words) + ")"


def joined(col: str, sep: str = "|") -> str:
    return f"array_to_string({col}, {q(sep)})"


def mime(path: str) -> str:
    parts = []
    for suffixes, m in R.MIME_BY_SUFFIX:
        cond = " OR ".join(f"ends_with(lower({path}), {q('.' + s)})" for s in suffixes)
        parts.append(f"WHEN {cond} THEN {q(m)}")
    return "CASE " + " ".join(parts) + f" ELSE {q(R.MIME_DEFAULT)} END"


def fixture_captures() -> str:
    return CAPTURES_SQL.replace("{documents}", "documents")


def fixture_messages() -> str:
    return MESSAGES_SQL.replace("{conversations}", "conversations")


def base_ctes() -> list[str]:
    """``caps``: fixture captures with mime; ``capsocr``: with OCR as given."""
    return [
        f"caps0 AS ({fixture_captures()})",
        f"caps AS (SELECT *, {mime('file_path')} AS mime_type FROM caps0)",
        "capsocr AS (SELECT *, 'fixture' AS ocr_provider, "
        f"{clean_lines('ocr_text')} AS ocr_lines, {EMPTY} AS ocr_warnings, "
        "CAST(NULL AS VARCHAR) AS message FROM caps)",
    ]


def _case(kind_col: str, mapping: dict, idx=None) -> str:
    parts = []
    for k, v in mapping.items():
        val = v if idx is None else v[idx]
        val = arr(val) if isinstance(val, tuple) else (q(val) if isinstance(val, str) else repr(val))
        parts.append(f"WHEN {kind_col} = {q(k)} THEN {val}")
    return "CASE " + " ".join(parts)


def analysis_ctes(src: str, prefix: str = "a", vision: str = "heuristic",
                  max_summary_chars: int = R.MAX_SUMMARY_CHARS) -> list[str]:
    """CTEs ``{prefix}1 .. {prefix}10`` and ``{prefix}``, which holds analysis + handoff columns."""
    a = prefix

    def lit(v) -> str:
        return q(v) if isinstance(v, str) else f"{v}::DOUBLE"

    def name_case(i: int) -> str:
        """CASE over the name rules returning field ``i`` of (kind, confidence, reason)."""
        body = " ".join(f"WHEN {any_words('_name_l', words)} THEN {lit((k, c, why)[i])}"
                        for k, c, why, words in R.NAME_RULES)
        return (f"CASE {body} WHEN starts_with(mime_type, 'image/') THEN {lit(R.NAME_IMAGE[i])} "
                f"ELSE {lit(R.NAME_FALLBACK[i])} END")

    c1 = (f"{a}1 AS (SELECT *, {tr('ocr_text')} AS _t, lower(file_name || ' ' || coalesce(hint, '')) AS _name_l, "
          f"{clean_lines('ocr_text')} AS _cl FROM {src})")
    c2 = (f"{a}2 AS (SELECT *, lower(file_name || ' ' || coalesce(hint, '') || ' ' || _t) AS _full, "
          f"{name_case(0)} AS name_kind, CAST({name_case(1)} AS DOUBLE) AS name_confidence, {name_case(2)} AS name_reason "
          f"FROM {a}1)")
    c3 = (f"{a}3 AS (SELECT *, "
          f"{count_words('_full', R.RECEIPT_WORDS)} AS n_receipt_words, "
          f"{count_words('_full', R.CHART_WORDS)} AS n_chart_words, "
          f"{count_words('_full', R.CHAT_WORDS)} AS n_chat_words, "
          f"{count_words('_full', R.DOC_WORDS)} AS n_doc_words, "
          f"len(_cl) AS n_lines, "
          f"len(list_filter(_cl, lambda l: regexp_matches(l, {p('clock')}))) AS n_clock_lines, "
          f"len(list_filter(_cl, lambda l: regexp_matches(l, {p('speaker')}))) AS n_speaker_lines, "
          f"len(list_filter(_cl, lambda l: regexp_matches(l, {p('numbered')}))) AS n_numbered_lines, "
          f"len(list_filter(_cl, lambda l: regexp_matches(l, {p('instruction')}))) AS n_instruction_lines, "
          f"len(list_filter(_cl, lambda l: regexp_matches(l, {p('heading')}))) > 0 AS has_heading, "
          f"len(list_filter(_cl, lambda l: length(l) >= 20)) > 0 AS has_long_line, "
          f"length(array_to_string(_cl, '')) AS joined_length FROM {a}2)")
    c4 = (f"{a}4 AS (SELECT *, CASE WHEN _t = '' THEN NULL "
          f"WHEN n_receipt_words >= {R.RECEIPT_LIKE_MIN} THEN {q(R.RECEIPT)} "
          f"WHEN n_clock_lines >= 1 OR n_speaker_lines >= 2 OR n_chat_words >= {R.CHAT_WORDS_MIN} THEN {q(R.CHAT)} "
          f"WHEN n_chart_words >= {R.CHART_LIKE_MIN} THEN {q(R.CHART)} "
          f"WHEN has_heading OR n_numbered_lines >= 2 OR (n_lines >= 4 AND n_instruction_lines >= 3) "
          f"OR (n_lines >= 5 AND has_long_line AND n_doc_words >= 1) "
          f"OR (n_lines >= 4 AND joined_length >= 40 AND n_doc_words >= 1) THEN {q(R.DOCUMENT)} "
          f"END AS text_kind FROM {a}3)")
    tconf = _case("text_kind", R.TEXT_RESULTS, 0) + " END"
    treason = _case("text_kind", R.TEXT_RESULTS, 1) + " END"
    c5 = (f"{a}5 AS (SELECT *, coalesce(text_kind, name_kind) AS kind, "
          f"CASE WHEN text_kind IS NULL THEN name_confidence "
          f"WHEN text_kind = name_kind THEN least({R.SAME_KIND_CAP}::DOUBLE, greatest(name_confidence, ({tconf})::DOUBLE)) "
          f"ELSE greatest(name_confidence, ({tconf})::DOUBLE) END AS confidence, "
          f"CASE WHEN text_kind IS NULL THEN [name_reason] ELSE [name_reason, {treason}] END AS _reasons0 "
          f"FROM {a}4)")
    first_line = f"list_filter(ocr_lines, lambda l: {tr('l')} <> '')[1]"

    def fm(*specs):
        return "coalesce(" + ", ".join(f"nullif({tr(f'regexp_extract(ocr_text, {pat}, {g})')}, '')" for pat, g in specs) + ")"

    kind_is = lambda k: f"kind = {q(k)}"
    if vision == "heuristic":
        entities_raw = (
            f"CASE WHEN {kind_is(R.RECEIPT)} THEN {arr(R.BASE_ENTITIES[R.RECEIPT])} || "
            + nonnull(f"CASE WHEN regexp_matches(ocr_text, {p('receipt_total')}) THEN 'total' END",
                      f"CASE WHEN regexp_matches(ocr_text, {p('receipt_date')}) THEN 'date' END",
                      f"CASE WHEN regexp_matches(ocr_text, {p('receipt_tax')}) THEN 'tax_or_invoice' END")
            + f" WHEN {kind_is(R.CHART)} THEN {arr(R.BASE_ENTITIES[R.CHART])} || "
            + nonnull(f"CASE WHEN regexp_matches(ocr_text, {p('chart_trend')}) THEN 'trend_indicator' END",
                      f"CASE WHEN regexp_matches(ocr_text, {p('chart_metric')}) THEN 'business_metric' END")
            + f" WHEN {kind_is(R.DOCUMENT)} THEN {arr(R.BASE_ENTITIES[R.DOCUMENT])} || "
            + nonnull("CASE WHEN coalesce(ocr_lines[1], '') <> '' THEN 'heading' END",
                      f"CASE WHEN len(list_filter(ocr_lines, lambda l: regexp_matches({tr('l')}, {p('numbered')}))) > 0 THEN 'numbered_list' END",
                      f"CASE WHEN len(list_filter(ocr_lines, lambda l: regexp_matches(l, {p('section_marker')}))) > 0 THEN 'section_marker' END")
            + f" ELSE {EMPTY} END")
        layout = (_case("kind", R.LAYOUT_HINTS) + f" ELSE {EMPTY} END")
        layout = (f"CASE WHEN {kind_is(R.DOCUMENT)} AND len(list_filter(ocr_lines, lambda l: regexp_matches(l, {p('list_item')}))) > 0 "
                  f"THEN {arr(R.LAYOUT_HINTS[R.DOCUMENT] + (R.LIST_LAYOUT_HINT,))} ELSE {layout} END")
        table_h = (f"CASE WHEN {kind_is(R.RECEIPT)} THEN {arr(R.RECEIPT_TABLE_HINTS)} "
                   f"WHEN {kind_is(R.DOCUMENT)} AND len(list_filter(ocr_lines, lambda l: regexp_matches(l, {p('tabular')}))) > 0 "
                   f"THEN {arr(R.DOCUMENT_TABLE_HINTS)} ELSE {EMPTY} END")
        chart_h = (f"CASE WHEN {kind_is(R.CHART)} THEN {arr((R.CHART_BASE_HINT,))} || "
                   + nonnull(f"CASE WHEN regexp_matches(ocr_text, {p('chart_rate')}) THEN {q(R.CHART_RATE_HINT)} END",
                             f"CASE WHEN regexp_matches(ocr_text, {p('chart_metric')}) THEN {q(R.CHART_METRIC_HINT)} END")
                   + f" ELSE {EMPTY} END")
        preview = (f"CASE WHEN kind IN ({q(R.DOCUMENT)}, {q(R.RECEIPT)}, {q(R.CHART)}) THEN list_slice(list_filter("
                   f"list_transform(ocr_lines, lambda l: {tr('l')}), lambda l: l <> '' AND (regexp_matches(l, {p('tabular_line')}) "
                   f"OR (regexp_matches(l, {p('ends_with_number')}) AND regexp_matches(l, {p('han_or_latin')})))), 1, {R.TABLE_PREVIEW_MAX}) "
                   f"ELSE {EMPTY} END")
        signals = (f"CASE WHEN {kind_is(R.CHART)} THEN "
                   f"list_transform(regexp_extract_all(ocr_text, {p('metric')}, 0), lambda m: 'metric:' || upper(m)) || "
                   f"list_transform(list_slice(regexp_extract_all(ocr_text, {p('percent')}, 0), 1, {R.CHART_PERCENTS_MAX}), lambda m: 'percent:' || m) || "
                   f"list_transform(list_slice(regexp_extract_all(ocr_text, {p('period')}, 0), 1, {R.CHART_PERIODS_MAX}), lambda m: 'period:' || m) "
                   f"ELSE {EMPTY} END")
        risks = nonnull(f"CASE WHEN {kind_is(R.RECEIPT)} THEN {q(R.RISK_FINANCIAL)} END",
                        f"CASE WHEN {kind_is(R.CHAT)} THEN {q(R.RISK_PRIVATE)} END",
                        f"CASE WHEN regexp_matches(ocr_text, {p('eleven_digits')}) THEN {q(R.RISK_PHONE)} END",
                        f"CASE WHEN regexp_matches(ocr_text, {p('email')}) THEN {q(R.RISK_EMAIL)} END",
                        f"CASE WHEN regexp_matches(regexp_replace(ocr_text, {p('ws_run')}, '', 'g'), {p('long_id')}) THEN {q(R.RISK_LONG_ID)} END")
        ui = _case("kind", R.UI_ELEMENTS) + f" ELSE {EMPTY} END"
        ws_run = p("ws_run")
        lead = tr(f"regexp_replace(ocr_text, {ws_run}, ' ', 'g')")
        c6 = (f"{a}6 AS (SELECT *, {uniq('_reasons0')} AS reasons, "
              f"CASE WHEN {kind_is(R.DOCUMENT)} AND {first_line} IS NOT NULL THEN {tr(first_line)} END AS kf_title, "
              f"CASE WHEN {kind_is(R.CHAT)} THEN {fm((p('clock'), 0))} END AS kf_latest_time, "
              f"CASE WHEN {kind_is(R.RECEIPT)} THEN {fm((p('amount_han'), 1), (p('amount_en'), 1))} END AS kf_amount, "
              f"CASE WHEN {kind_is(R.RECEIPT)} THEN {fm((p('date_dash'), 0), (q(DATE_HAN_RE2), 1))} END AS kf_date, "
              f"{fm((p('phone'), 0))} AS kf_phone, {fm((p('email'), 0))} AS kf_email, "
              f"{fm((p('url_http'), 0), (p('url_www'), 0))} AS kf_url, "
              f"{risks} AS risk_flags, {entities_raw} AS _entities0, {ui} AS ui_elements, "
              f"{layout} AS layout_hints, {table_h} AS table_hints, {chart_h} AS chart_hints, "
              f"{preview} AS _preview0, {signals} AS _signals0, {lead} AS _lead, "
              f"{EMPTY} AS vision_warnings FROM {a}5)")
        c7 = (f"{a}7 AS (SELECT *, {uniq('_entities0')} AS entities, {uniq('_preview0')} AS table_preview, "
              f"{uniq('_signals0')} AS chart_signals, "
              f"'Image ' || file_name || ' appears to be ' || kind || ' based on ' || coalesce(reasons[1], 'generic image heuristics') || '.' || "
              f"CASE WHEN _lead <> '' THEN ' OCR suggests: ' || CASE WHEN length(_lead) <= {R.OCR_LEAD_MAX} THEN _lead "
              f"ELSE substr(_lead, 1, {R.OCR_LEAD_CUT}) || '...' END ELSE '' END AS vision_summary FROM {a}6)")
    else:
        nulls = ", ".join(f"CAST(NULL AS VARCHAR) AS kf_{k}" for k in R.KEY_FIELD_NAMES)
        c6 = (f"{a}6 AS (SELECT *, {uniq('_reasons0')} AS reasons, {nulls}, {EMPTY} AS risk_flags, {EMPTY} AS ui_elements, "
              f"{EMPTY} AS layout_hints, {EMPTY} AS table_hints, {EMPTY} AS chart_hints, "
              f"{arr((R.VISION_DISABLED_WARNING,))} AS vision_warnings FROM {a}5)")
        c7 = (f"{a}7 AS (SELECT *, {EMPTY} AS entities, {EMPTY} AS table_preview, {EMPTY} AS chart_signals, "
              f"'Vision provider is disabled. File ' || file_name || ' was classified as ' || kind || '.' AS vision_summary "
              f"FROM {a}6)")
    keep = max(0, max_summary_chars - 3)
    lists = ("entities", "ui_elements", "risk_flags", "layout_hints", "table_hints", "chart_hints",
             "table_preview", "chart_signals")
    fail = "message IS NOT NULL"
    list_cols = ", ".join(f"CASE WHEN {fail} THEN {EMPTY} ELSE {c} END AS {c}_o" for c in lists)
    kf_cols = ", ".join(f"CASE WHEN {fail} THEN NULL ELSE kf_{k} END AS {k}_o" for k in R.KEY_FIELD_NAMES)
    c8 = (f"{a}8 AS (SELECT *, {fail} AS error_o, "
          f"CASE WHEN {fail} THEN {q(R.UNKNOWN)} ELSE kind END AS kind_o, "
          f"CASE WHEN {fail} THEN 0.0::DOUBLE ELSE confidence END AS confidence_o, "
          f"CASE WHEN {fail} THEN {EMPTY} ELSE reasons END AS reasons_o, "
          f"CASE WHEN {fail} THEN '' WHEN length(_s) <= {max_summary_chars} THEN _s ELSE substr(_s, 1, {keep}) || '...' END AS summary_o, "
          f"CASE WHEN {fail} THEN '' ELSE _t END AS ocr_text_o, "
          f"CASE WHEN {fail} THEN [message] ELSE ocr_warnings || vision_warnings END AS warnings_o, "
          f"CASE WHEN {fail} THEN '' ELSE file_name END AS src_file_name, "
          f"CASE WHEN {fail} THEN '' ELSE mime_type END AS src_mime_type, "
          f"CASE WHEN {fail} THEN 0 ELSE size_bytes END AS src_size_bytes, "
          f"{list_cols}, {kf_cols} "
          f"FROM (SELECT *, CASE WHEN _t <> '' THEN vision_summary || ' OCR extracted ' || CAST(length(_t) AS VARCHAR) "
          f"|| ' characters.' ELSE vision_summary END AS _s FROM {a}7))")
    tags0 = (f"['kind:' || kind_o] || list_transform(entities_o, lambda v: 'entity:' || v) || "
             f"list_transform(risk_flags_o, lambda v: 'risk:' || v) || "
             + nonnull("CASE WHEN len(table_preview_o) > 0 THEN 'shape:table' END",
                       "CASE WHEN len(chart_signals_o) > 0 THEN 'shape:chart' END",
                       "CASE WHEN ocr_text_o <> '' THEN 'has:ocr' END"))
    c9 = (f"{a}9 AS (SELECT *, CASE WHEN error_o THEN '' ELSE coalesce(title_o, CASE WHEN amount_o IS NOT NULL "
          f"THEN kind_o || ':' || amount_o END, kind_o || ':' || src_file_name) END AS title_h, "
          f"CASE WHEN error_o THEN {EMPTY} ELSE {tags0} END AS _tags0 FROM {a}8)")
    sd, sc, sm, sn = R.SAVE_DOCUMENT, R.SAVE_CHART, R.SAVE_CHAT, R.SAVE_NONE
    tag_u = uniq("_tags0")
    c10 = (f"{a}10 AS (SELECT *, {tag_u} AS tags_h FROM {a}9)")

    def save(i):
        vals = [(f"kind_o IN ({q(R.RECEIPT)}, {q(R.DOCUMENT)})", sd),
                (f"kind_o = {q(R.CHART)} OR list_contains(tags_h, 'shape:chart')", sc),
                (f"kind_o = {q(R.CHAT)}", sm)]
        fmt = (lambda v: q(v) if isinstance(v, str) else f"{v}::DOUBLE")
        body = " ".join(f"WHEN {cond} THEN {fmt(v[i])}" for cond, v in vals)
        return f"CASE {body} ELSE {fmt(sn[i])} END"

    c11 = (f"{a} AS (SELECT *, CASE WHEN error_o THEN 'none' ELSE {save(0)} END AS save_target, "
           f"CASE WHEN error_o THEN '' ELSE {save(1)} END AS save_reason, "
           f"CASE WHEN error_o THEN 0.0::DOUBLE ELSE greatest({save(2)}, confidence_o) END AS save_confidence "
           f"FROM {a}10)")
    return [c1, c2, c3, c4, c5, c6, c7, c8, c9, c10, c11]


def key_fields_text(prefix: str = "") -> str:
    parts = ", ".join(f"CASE WHEN {tr(f'coalesce({k}_o, chr(32))')} <> '' THEN '{k}=' || {k}_o END"
                      for k in R.KEY_FIELD_NAMES)
    return f"coalesce(nullif(array_to_string({nonnull(parts)}, '; '), ''), '(none)')"


def or_none(col: str, sep: str = ", ") -> str:
    return f"CASE WHEN len({col}) > 0 THEN array_to_string({col}, {q(sep)}) ELSE '(none)' END"


def render_block() -> str:
    lines = [
        q(R.IMAGE_HEADER),
        "'Kind: ' || kind_o",
        "'Summary: ' || summary_o",
        "'OCR: ' || CASE WHEN ocr_text_o <> '' THEN ocr_text_o ELSE '(none)' END",
        f"'Entities: ' || {or_none('entities_o')}",
        f"'UI: ' || {or_none('ui_elements_o')}",
        f"'KeyFields: ' || {key_fields_text()}",
        f"'Layout: ' || {or_none('layout_hints_o')}",
        f"'Table: ' || {or_none('table_hints_o')}",
        f"'Chart: ' || {or_none('chart_hints_o')}",
        f"'TablePreview: ' || {or_none('table_preview_o', ' | ')}",
        f"'ChartSignals: ' || {or_none('chart_signals_o')}",
        f"'Risks: ' || {or_none('risk_flags_o')}",
        "'Confidence: ' || printf('%.2f', confidence_o)",
        "CASE WHEN len(warnings_o) > 0 THEN 'Warnings: ' || array_to_string(warnings_o, ' | ') END",
    ]
    return f"CASE WHEN error_o THEN '' ELSE concat_ws(chr(10), {', '.join(lines)}) END"


def attempts_ctes() -> list[str]:
    """``att``: the fixture OCR attempts (needs ``caps``)."""
    return [
        "attempts0 AS (SELECT c.capture_id, pr.provider, pr.rank, 0 AS attempt_no, "
        "CAST((c.capture_id * 37 + pr.rank * 11) % 14000 AS BIGINT) AS elapsed_ms, "
        "CASE WHEN pr.rank = 0 AND c.capture_id % 3 <> 0 THEN '' ELSE c.ocr_text END AS text, "
        "CASE WHEN pr.rank = 0 AND c.capture_id % 3 <> 0 THEN 'no text' ELSE '' END AS warning "
        "FROM caps c CROSS JOIN (SELECT 'macos_vision' AS provider, 0 AS rank UNION ALL SELECT 'paddleocr', 1) pr)",
        f"att AS (SELECT capture_id, provider, attempt_no, elapsed_ms, text, {clean_lines('text')} AS lines, "
        "list_filter([warning], lambda w: w <> '') AS warnings FROM attempts0)",
    ]


def resolve_ctes(order: list[str], timeout_ms: int | None, out: str = "ocr", att: str = "att") -> list[str]:
    """A recursive fold over the ranked attempts; ``{out}`` has one row per capture."""
    rank_case = "CASE " + " ".join(f"WHEN provider = {q(pv)} THEN {i}" for i, pv in enumerate(order)) + " END"
    cap_case = ("CASE " + " ".join(f"WHEN a_provider = {q(pv)} THEN {c}" for pv, c in R.OCR_ATTEMPT_CAP_MS.items())
                + f" ELSE {timeout_ms or 0} END")
    label = ("CASE " + " ".join(f"WHEN a_provider = {q(pv)} THEN {q(lb)}" for pv, lb in R.OCR_PROVIDER_LABEL.items())
             + " ELSE a_provider END")
    if timeout_ms is None:
        remaining, skip, limit, timed_out = "0", "false", "0", "false"
    else:
        remaining = f"greatest(0, {timeout_ms} - greatest(0, spent))"
        skip = f"({remaining}) < {R.OCR_MIN_ATTEMPT_MS}"
        limit = f"greatest({R.OCR_MIN_ATTEMPT_MS}, least({remaining}, {cap_case}))"
        timed_out = f"a_elapsed > ({limit})"
    ok = f"(NOT ({skip}) AND NOT ({timed_out}) AND ({tr('a_text')} <> '' OR len(a_lines) > 0))"
    idle = "(stop OR done)"
    skip_msg = (f"'Skipped ' || a_provider || ': remaining OCR budget ' || CAST(({remaining}) AS VARCHAR) || "
                f"'ms is below {R.OCR_MIN_ATTEMPT_MS}ms'")
    step = (
        "SELECT capture_id, k + 1 AS k, "
        f"CASE WHEN {idle} THEN spent WHEN {skip} THEN spent WHEN {timed_out} THEN spent + ({limit}) "
        "ELSE spent + a_elapsed END AS spent, "
        f"CASE WHEN {idle} THEN stop ELSE {skip} END AS stop, "
        f"CASE WHEN {idle} THEN done ELSE {ok} END AS done, "
        f"CASE WHEN {idle} THEN provider WHEN {ok} THEN a_provider END AS provider, "
        f"CASE WHEN {idle} THEN text WHEN {ok} THEN a_text END AS text, "
        f"CASE WHEN {idle} THEN lines WHEN {ok} THEN a_lines END AS lines, "
        f"CASE WHEN {idle} THEN warnings WHEN {skip} THEN warnings || [{skip_msg}] "
        f"WHEN {timed_out} THEN warnings || [{label} || ' failed: timed out'] ELSE warnings || a_warnings END AS warnings "
        "FROM (SELECT f.*, r.provider AS a_provider, r.elapsed_ms AS a_elapsed, r.text AS a_text, "
        "r.lines AS a_lines, r.warnings AS a_warnings FROM fold f JOIN ranked r "
        "ON r.capture_id = f.capture_id AND r.k = f.k + 1) x"
    )
    return [
        f"ranked AS (SELECT *, row_number() OVER (PARTITION BY capture_id ORDER BY rk, attempt_no, elapsed_ms) AS k "
        f"FROM (SELECT *, {rank_case} AS rk FROM {att}) WHERE rk IS NOT NULL)",
        "fold AS (SELECT capture_id, 0 AS k, CAST(0 AS BIGINT) AS spent, false AS stop, false AS done, "
        "CAST(NULL AS VARCHAR) AS provider, CAST(NULL AS VARCHAR) AS text, CAST(NULL AS VARCHAR[]) AS lines, "
        f"{EMPTY} AS warnings FROM (SELECT DISTINCT capture_id FROM ranked) "
        f"UNION ALL {step})",
        f"{out} AS (SELECT capture_id, CASE WHEN done THEN provider ELSE {q(order[0])} END AS ocr_provider, "
        "CASE WHEN done THEN text ELSE '' END AS ocr_text, "
        f"CASE WHEN done THEN lines ELSE {EMPTY} END AS ocr_lines, "
        f"CASE WHEN done OR len(warnings) > 0 THEN warnings ELSE {arr((R.OCR_NO_TEXT,))} END AS ocr_warnings, "
        "spent AS ocr_elapsed_ms FROM fold WHERE (capture_id, k) IN (SELECT capture_id, max(k) FROM fold GROUP BY capture_id))",
    ]


def admission(path: str = "file_path", size: str = "size_bytes", mime_col: str = "mime_type",
              max_image_bytes: int = R.MAX_IMAGE_BYTES) -> str:
    return (f"CASE WHEN {size} = 0 THEN 'Image file is empty (0 bytes): ' || {path} "
            f"WHEN {size} > {max_image_bytes} THEN 'image too large: ' || CAST({size} AS VARCHAR) || ' bytes > {max_image_bytes}' "
            f"WHEN NOT starts_with({mime_col}, 'image/') THEN 'unsupported image type: ' || {path} END")


def job_ctes(timeout_ms: int | None = R.OCR_TIMEOUT_MS, order=None, vision: str = "heuristic",
                  hint: str | None = None) -> list[str]:
    """Admit, resolve attempts, analyse: the last CTE is ``a``."""
    order = list(order or R.OCR_FALLBACK_ORDER)
    src = "caps" if hint is None else f"(SELECT * REPLACE ({q(hint)} AS hint) FROM caps)"
    return (base_ctes() + attempts_ctes() + resolve_ctes(order, timeout_ms) + [
        f"adm AS (SELECT c.*, {admission()} AS message FROM {src} c)",
        "pin AS (SELECT adm.*, coalesce(o.ocr_provider, " + q(order[0]) + ") AS ocr_provider, "
        "coalesce(o.ocr_text, '') AS ocr_text2, coalesce(o.ocr_lines, []::VARCHAR[]) AS ocr_lines, "
        f"CASE WHEN o.capture_id IS NULL THEN {arr((R.OCR_NO_TEXT,))} ELSE o.ocr_warnings END AS ocr_warnings, "
        "coalesce(o.ocr_elapsed_ms, 0) AS ocr_elapsed_ms "
        "FROM adm LEFT JOIN ocr o ON o.capture_id = adm.capture_id)",
        "pin2 AS (SELECT * EXCLUDE (ocr_text, ocr_text2), ocr_text2 AS ocr_text FROM pin)",
    ] + analysis_ctes("pin2", vision=vision))


def handoff_json() -> str:
    """The handoff record as compact JSON; absent key fields are omitted."""
    kf = nonnull(*[f"CASE WHEN {k}_o IS NOT NULL THEN '\"{k}\":' || CAST(to_json({k}_o) AS VARCHAR) END"
                   for k in R.KEY_FIELD_NAMES])
    kf_json = f"json('{{' || array_to_string({kf}, ',') || '}}')"
    return (f"CAST(to_json(struct_pack(schema := {q(R.HANDOFF_SCHEMA)}, kind := kind_o, title := title_h, "
            "summary := summary_o, tags := tags_h, save_hints := struct_pack(suggested_target := save_target, "
            "reason := save_reason, confidence := save_confidence), "
            f"extracted := struct_pack(key_fields := {kf_json}, entities := entities_o, ui_elements := ui_elements_o, "
            "risk_flags := risk_flags_o, table_preview := table_preview_o, chart_signals := chart_signals_o), "
            "source := struct_pack(file_name := src_file_name, mime_type := src_mime_type, "
            "size_bytes := CAST(src_size_bytes AS BIGINT)))) AS VARCHAR)")


def media_pattern() -> str:
    from capsight.functions.text import W
    return q(R.MEDIA_PATH_PATTERN.replace("{W}", W))


def recent_media_ctes(max_messages: int, max_images: int, out: str = "media", by_turn: bool = False, given: str | None = None) -> list[str]:
    """Recent media per conversation (or per conversation and as-of turn)."""
    msgs = f"msgs AS ({given or fixture_messages()})"
    if by_turn:
        keys = "conv_id, as_of"
        win = ("SELECT a.conv_id, a.as_of, m.turn, m.text, row_number() OVER (PARTITION BY a.conv_id, a.as_of "
               "ORDER BY m.turn DESC, m.text DESC NULLS LAST) AS recency FROM (SELECT DISTINCT conv_id, turn AS as_of FROM msgs) a "
               "JOIN msgs m ON m.conv_id = a.conv_id AND m.turn <= a.as_of")
    else:
        keys = "conv_id"
        win = "SELECT conv_id, turn, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC, text DESC NULLS LAST) AS recency FROM msgs"
    return [
        msgs,
        f"rm AS ({win})",
        f"men AS (SELECT {keys}, recency, unnest(ps) AS raw, unnest(range(len(ps))) AS idx FROM "
        f"(SELECT *, regexp_extract_all(text, {media_pattern()}, 1) AS ps FROM rm WHERE recency <= {max_messages}))",
        f"men2 AS (SELECT {keys}, recency, idx, {tr('raw')} AS file_path FROM men WHERE {tr('raw')} <> '')",
        f"fs AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {keys}, file_path ORDER BY recency, idx) AS r "
        "FROM men2) WHERE r = 1)",
        f"kept AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY recency, idx) AS rn FROM fs) "
        f"WHERE rn <= {max_images})",
        f"{out} AS (SELECT {keys}, CAST(count(*) OVER (PARTITION BY {keys}) - rn + 1 AS INTEGER) AS media_pos, "
        "file_path FROM kept)",
    ]


def context_ctes(ocr_timeout_ms: int = R.OCR_TIMEOUT_MS, by_turn: bool = False) -> list[str]:
    """``entries``: one context entry per recent media row (per turn with ``by_turn``)."""
    limit = max(R.CONTEXT_MIN_TIMEOUT_MS, min(ocr_timeout_ms, R.CONTEXT_MAX_TIMEOUT_MS))
    base = "regexp_extract(m.file_path, '([^/]*)$', 1)"
    failed = lambda detail: (f"'[Image]' || chr(10) || 'Kind: analysis_failed' || chr(10) || 'Summary: Failed to analyze ' "
                             f"|| {base} || '.' || chr(10) || 'Warnings: ' || {detail}")
    timed = (f"'[Image]' || chr(10) || 'Kind: analysis_timed_out' || chr(10) || 'Summary: Auto image analysis timed out for ' "
             f"|| {base} || '; continuing without OCR-backed context.' || chr(10) || 'Warnings: auto_context_timeout_{limit}ms'")
    status = (f"CASE WHEN an.file_path IS NULL THEN 'analysis_failed' WHEN an.ocr_elapsed_ms > {limit} THEN 'analysis_timed_out' "
              f"WHEN NOT an.error_o AND {tr('an.blk')} <> '' THEN 'ok' ELSE 'analysis_failed' END")
    keys = "m.conv_id, m.as_of AS turn" if by_turn else "m.conv_id"
    ekeys = "conv_id, turn" if by_turn else "conv_id"
    return (recent_media_ctes(R.MAX_RECENT_MESSAGES, R.MAX_IMAGE_COUNT, by_turn=by_turn)
            + job_ctes(ocr_timeout_ms, hint=R.CONTEXT_HINT)
            + [f"an AS (SELECT file_path, error_o, message, ocr_elapsed_ms, {render_block()} AS blk, {handoff_json()} AS hj FROM a)",
               f"ent0 AS (SELECT {keys}, m.media_pos, m.file_path, {status} AS status, an.blk, an.hj, an.message, "
               "an.file_path IS NULL AS missing FROM media m LEFT JOIN an ON an.file_path = m.file_path)",
               f"entries AS (SELECT {ekeys}, media_pos, file_path, status, CASE WHEN status = 'ok' THEN blk || chr(10) || chr(10) "
               f"|| {q(R.HANDOFF_HEADER)} || chr(10) || hj WHEN status = 'analysis_timed_out' THEN {timed.replace('m.file_path', 'e.file_path')} "
               f"ELSE {failed("coalesce(message, CASE WHEN missing THEN 'file not found: ' || e.file_path END, 'structured analysis returned no image block')").replace('m.file_path', 'e.file_path')} END AS entry FROM ent0 e)"])
