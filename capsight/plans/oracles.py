"""Oracle statements (DuckDB) keyed like ``capsight.plans.queries.QUERIES``."""

from __future__ import annotations

from capsight.functions import rules as R
from capsight.plans import oracle_sql as O

ORACLES: dict[str, str] = {}


def _with(ctes: list[str], select: str) -> str:
    return "WITH RECURSIVE " + ",\n".join(ctes) + "\n" + select


def _an(select: str, vision: str = "heuristic") -> str:
    return _with(O.base_ctes() + O.analysis_ctes("capsocr", vision=vision), select)


def j(col: str) -> str:
    return f"array_to_string({col}, '|')"


ORACLES["c1_infer_mime"] = _with(O.base_ctes(), "SELECT capture_id, file_name, mime_type FROM caps")
ORACLES["c2_classify_by_name"] = _an("SELECT capture_id, name_kind, name_confidence, name_reason FROM a")
ORACLES["c3_text_signals"] = _an(
    "SELECT capture_id, "
    + ", ".join(f"CAST({c} AS BIGINT) AS {c}" for c in (
        "n_receipt_words", "n_chart_words", "n_chat_words", "n_doc_words", "n_lines", "n_clock_lines",
        "n_speaker_lines", "n_numbered_lines", "n_instruction_lines"))
    + ", has_heading, has_long_line, CAST(joined_length AS BIGINT) AS joined_length FROM a")
ORACLES["c4_classify_by_text"] = _an("SELECT capture_id, text_kind FROM a")
ORACLES["c5_refine"] = _an(f"SELECT capture_id, kind, confidence, {j('reasons')} AS reasons FROM a")

ORACLES["d1_key_fields"] = _an(
    "SELECT capture_id, kind, " + ", ".join(f"kf_{k} AS {k}" for k in R.KEY_FIELD_NAMES) + " FROM a")
for key, cols in (("d2_risk_flags", ("risk_flags",)), ("d3_entities", ("entities",)),
                  ("d4_ui_layout", ("ui_elements", "layout_hints")), ("d5_table_hints", ("table_hints",)),
                  ("d6_chart_hints", ("chart_hints",)), ("d7_table_preview", ("table_preview",)),
                  ("d8_chart_signals", ("chart_signals",))):
    ORACLES[key] = _an("SELECT capture_id, kind, " + ", ".join(f"{j(c)} AS {c}" for c in cols) + " FROM a")
ORACLES["d9_summary"] = _an("SELECT capture_id, vision_summary AS summary FROM a")

ORACLES["e1_normalize"] = _an(
    f"SELECT capture_id, summary_o AS summary, ocr_text_o AS ocr_text, {j('warnings_o')} AS warnings, "
    "src_file_name AS source_file_name, src_mime_type AS source_mime_type, "
    "CAST(src_size_bytes AS BIGINT) AS source_size_bytes FROM a")
ORACLES["e2_render_block"] = _an(f"SELECT capture_id, {O.render_block()} AS image_block FROM a")
ORACLES["e3_analyze_disabled"] = _an(
    f"SELECT capture_id, kind_o AS kind, summary_o AS summary, {j('warnings_o')} AS warnings, "
    f"title_h AS title, {j('tags_h')} AS tags FROM a", vision="disabled")

ORACLES["f1_title"] = _an("SELECT capture_id, title_h AS title FROM a")
ORACLES["f2_tags"] = _an(f"SELECT capture_id, {j('tags_h')} AS tags FROM a")
ORACLES["f3_save_hints"] = _an("SELECT capture_id, save_target, save_reason, save_confidence FROM a")
ORACLES["f4_handoff"] = _an(
    f"SELECT capture_id, kind_o AS kind, title_h AS title, summary_o AS summary, {j('tags_h')} AS tags, "
    f"save_target, save_confidence, {O.key_fields_text()} AS key_fields, "
    + ", ".join(f"{j(c + '_o')} AS {c}" for c in ("entities", "ui_elements", "risk_flags", "table_preview",
                                                  "chart_signals"))
    + ", src_file_name AS source_file_name, src_mime_type AS source_mime_type, "
    "CAST(src_size_bytes AS BIGINT) AS source_size_bytes FROM a")

# --- A, B, E3 -----------------------------------------------------------------------

ORACLES["a2_admit"] = _with(O.base_ctes(), f"SELECT capture_id, file_path, mime_type, ({O.admission()}) IS NOT NULL AS error, "
                            f"{O.admission()} AS message FROM caps")


def _ocr_select(src: str = "ocr") -> str:
    return (f"SELECT capture_id, ocr_provider, ocr_text, array_to_string(ocr_lines, chr(10)) AS ocr_lines, "
            f"{j('ocr_warnings')} AS ocr_warnings, ocr_elapsed_ms FROM {src}")


_B = O.base_ctes() + O.attempts_ctes()
ORACLES["b1_resolve_ocr"] = _with(_B + O.resolve_ctes(list(R.OCR_FALLBACK_ORDER), None), _ocr_select())
_REPEATED = (
    "rep AS (SELECT capture_id, provider, attempt_no, CASE WHEN attempt_no = 0 THEN 50 ELSE elapsed_ms END AS elapsed_ms, "
    "CASE WHEN attempt_no = 0 THEN '' WHEN attempt_no = 2 THEN text || ' again' ELSE text END AS text, "
    "CASE WHEN attempt_no = 0 THEN []::VARCHAR[] ELSE lines END AS lines, "
    "CASE WHEN attempt_no = 0 THEN ['first try of ' || provider || ' failed'] ELSE warnings END AS warnings FROM "
    "(SELECT * EXCLUDE (attempt_no), unnest(CASE WHEN capture_id % 5 = 0 THEN [0, 1] WHEN capture_id % 7 = 0 THEN [1, 2] ELSE [1] END) AS attempt_no FROM att))")
ORACLES["b1_repeated_attempts"] = _with(_B + [_REPEATED] + O.resolve_ctes(list(R.OCR_FALLBACK_ORDER), None, att="rep"), _ocr_select())
for _ms in (30000, 5000, 1000):
    ORACLES[f"b2_resolve_ocr_budget_{_ms}"] = _with(_B + O.resolve_ctes(list(R.OCR_FALLBACK_ORDER), _ms), _ocr_select())
ORACLES["b3_provider_order_paddleocr"] = _with(_B + O.resolve_ctes(["paddleocr", "macos_vision"], 30000), _ocr_select())
ORACLES["b3_provider_disabled"] = _with(O.base_ctes(), f"SELECT capture_id, 'disabled' AS ocr_provider, '' AS ocr_text, "
                                        f"'' AS ocr_lines, {O.q(R.OCR_DISABLED)} AS ocr_warnings, "
                                        "CAST(0 AS BIGINT) AS ocr_elapsed_ms FROM caps")
ORACLES["b4_clean_ocr"] = _with(_B, f"SELECT capture_id, provider, {O.tr('text')} AS clean_text, "
                                f"array_to_string({O.clean_lines('text')}, chr(10)) AS lines_text FROM att")
_extra = ("list_filter([CASE WHEN elapsed_ms > 8000 THEN 'slow attempt' END, ' ', 'elapsed ' || CAST(elapsed_ms AS VARCHAR), "
          "'a', 'b', 'c', 'd'], lambda x: x IS NOT NULL)")
_merged = f"list_filter(warnings || {_extra}, lambda w: {O.tr('w')} <> '')"
ORACLES["b5_merge_warnings"] = _with(_B, f"SELECT capture_id, provider, {j(_merged)} AS all_warnings, "
                                     f"{j(f'list_slice({_merged}, 1, 5)')} AS first_warnings FROM att")

FLAT_ANALYSIS = (
    f"SELECT capture_id, error_o AS error, message, kind_o AS kind, confidence_o AS confidence, "
    f"{j('reasons_o')} AS reasons, summary_o AS summary, ocr_provider, ocr_text_o AS ocr_text, "
    f"{j('warnings_o')} AS warnings, "
    + ", ".join(f"{j(c + '_o')} AS {c}" for c in ("entities", "ui_elements", "risk_flags", "layout_hints",
                                                   "table_hints", "chart_hints", "table_preview", "chart_signals"))
    + f", {O.key_fields_text()} AS key_fields, title_h AS title, {j('tags_h')} AS tags, save_target, save_confidence "
    "FROM a")
ORACLES["e3_analyze"] = _with(O.job_ctes(), FLAT_ANALYSIS)

# --- G. comparison ---------------------------------------------------------------------


def _compare_ctes() -> list[str]:
    ent_first = ("fv_{c} AS (SELECT f.group_id, unnest(f.{c}) AS v, unnest(range(len(f.{c}))) AS idx FROM m2 f "
                 "JOIN (SELECT group_id, min(pos) AS p FROM m2 GROUP BY group_id) mn ON f.group_id = mn.group_id AND f.pos = mn.p)")
    shared = ("sh_{c} AS (SELECT fv.group_id, string_agg(fv.v, ', ' ORDER BY fv.idx) AS shared FROM fv_{c} fv JOIN sz "
              "ON sz.group_id = fv.group_id WHERE (SELECT count(*) FROM m2 WHERE m2.group_id = fv.group_id "
              "AND list_contains(m2.{c}, fv.v)) = sz.n GROUP BY fv.group_id)")
    return O.job_ctes() + [
        "mem AS (SELECT group_id, pos, kind_o AS kind, title_h AS title, save_target, src_file_name AS file_name, "
        "entities_o AS entities, tags_h AS tags FROM a)",
        "sz AS (SELECT group_id, count(*) AS n FROM mem GROUP BY group_id HAVING count(*) >= 2)",
        "m2 AS (SELECT mem.* FROM mem JOIN sz USING (group_id))",
        "kd AS (SELECT group_id, string_agg(kind, ', ' ORDER BY fp) AS kinds, count(*) AS nk, "
        "min_by(kind, fp) AS first_kind FROM (SELECT group_id, kind, min(pos) AS fp FROM m2 GROUP BY ALL) GROUP BY group_id)",
        "ls AS (SELECT group_id, string_agg(kind, ' vs ' ORDER BY pos) AS kl, string_agg(title, ' vs ' ORDER BY pos) AS tl, "
        "string_agg(save_target, ' vs ' ORDER BY pos) AS sl, string_agg(file_name || ':' || kind, ' | ' ORDER BY pos) AS cl, "
        "count(DISTINCT title) AS nt, count(DISTINCT save_target) AS ns, bool_or(save_target = 'knowledge') AS ak, "
        "bool_or(save_target = 'memory') AS am FROM m2 GROUP BY group_id)",
        ent_first.format(c="entities"), ent_first.format(c="tags"),
        shared.format(c="entities"), shared.format(c="tags"),
        "cmp AS (SELECT sz.group_id, sz.n, kd.kinds, kd.nk, kd.first_kind, ls.*, coalesce(se.shared, '') AS shared_entities, "
        "coalesce(st.shared, '') AS shared_tags FROM sz JOIN kd USING (group_id) JOIN ls USING (group_id) "
        "LEFT JOIN sh_entities se ON se.group_id = sz.group_id LEFT JOIN sh_tags st ON st.group_id = sz.group_id)",
        "cmp2 AS (SELECT *, CASE WHEN nk = 1 THEN 'Compared ' || CAST(n AS VARCHAR) || ' images of the same kind: ' || first_kind || '.' "
        "ELSE 'Compared ' || CAST(n AS VARCHAR) || ' images across kinds: ' || kinds || '.' END AS summary, nk = 1 AS same_kind, "
        "array_to_string(list_filter([CASE WHEN nk = 1 THEN 'all images classified as ' || first_kind END, "
        "CASE WHEN shared_entities <> '' THEN 'shared entities: ' || shared_entities END, "
        "CASE WHEN shared_tags <> '' THEN 'shared tags: ' || shared_tags END], lambda x: x IS NOT NULL), ' | ') AS similarities, "
        "array_to_string(list_filter([CASE WHEN nk > 1 THEN 'kind mismatch: ' || kl END, "
        "CASE WHEN nt > 1 THEN 'titles differ: ' || tl END, CASE WHEN ns > 1 THEN 'save targets differ: ' || sl END], "
        "lambda x: x IS NOT NULL), ' | ') AS differences, "
        "CASE WHEN ak THEN 'knowledge' WHEN am THEN 'memory' ELSE 'none' END AS save_recommendation FROM cmp)",
    ]


ORACLES["g1_compare_groups"] = _with(_compare_ctes(), (
    "SELECT group_id, CAST(n AS BIGINT) AS n_members, summary, same_kind, kinds, similarities, "
    "array_to_string(list_filter([CASE WHEN nk > 1 THEN 'kind' END, CASE WHEN nt > 1 THEN 'title' END, "
    "CASE WHEN ns > 1 THEN 'save target' END], lambda x: x IS NOT NULL), ' | ') AS differs_in, save_recommendation FROM cmp2"))
ORACLES["g1_compared_members"] = _with(_compare_ctes(), "SELECT group_id, pos, kind, title, save_target, file_name FROM m2")
ORACLES["g2_shared_values"] = _with(_compare_ctes(), "SELECT group_id, shared_entities, shared_tags FROM cmp2")
ORACLES["g3_differences"] = _with(_compare_ctes(), "SELECT group_id, differences FROM cmp2")
ORACLES["g4_save_recommendation"] = _with(_compare_ctes(), "SELECT group_id, save_recommendation FROM cmp2")
ORACLES["g5_render_compare"] = _with(_compare_ctes(), (
    f"SELECT group_id, concat_ws(chr(10), {O.q(R.COMPARE_HEADER)}, 'Summary: ' || summary, "
    "'SameKind: ' || CASE WHEN same_kind THEN 'true' ELSE 'false' END, 'Kinds: ' || kinds, "
    "'Similarities: ' || CASE WHEN similarities <> '' THEN similarities ELSE '(none)' END, "
    "'Differences: ' || CASE WHEN differences <> '' THEN differences ELSE '(none)' END, "
    "'SaveRecommendation: ' || save_recommendation, 'Compared: ' || cl) AS compare_block FROM cmp2"))

_LABELS = (("kind", "kind mismatch: ", "kind", "nk > 1"), ("title", "titles differ: ", "title", "nt > 1"), ("save target", "save targets differ: ", "save_target", "ns > 1"))
_PIECES = " UNION ALL ".join(
    f"SELECT group_id, 6 AS line_no, CAST(list_position(diff, '{name}') - 1 AS BIGINT) * n + nth AS piece_no, "
    f"CASE WHEN nth > 0 THEN ' vs ' ELSE CASE WHEN list_position(diff, '{name}') = 1 THEN 'Differences: ' ELSE ' | ' END || '{label}' END || {col} AS piece "
    f"FROM placed WHERE list_contains(diff, '{name}')" for name, label, col, _ in _LABELS)
ORACLES["g5_compare_lines"] = _with(_compare_ctes() + [
    "differ AS MATERIALIZED (SELECT *, list_filter([" + ", ".join(f"CASE WHEN {when} THEN '{name}' END" for name, _, _, when in _LABELS) + "], lambda x: x IS NOT NULL) AS diff FROM cmp2)",
    "placed AS MATERIALIZED (SELECT m2.*, d.n, d.diff, row_number() OVER (PARTITION BY m2.group_id ORDER BY pos, file_name, m2.kind, m2.title, m2.save_target) - 1 AS nth "
    "FROM m2 JOIN differ d ON d.group_id = m2.group_id)"],
    f"SELECT group_id, 1 AS line_no, CAST(0 AS BIGINT) AS piece_no, {O.q(R.COMPARE_HEADER)} AS piece FROM differ "
    "UNION ALL SELECT group_id, 2, 0, 'Summary: ' || summary FROM differ UNION ALL SELECT group_id, 3, 0, 'SameKind: ' || CASE WHEN same_kind THEN 'true' ELSE 'false' END FROM differ "
    "UNION ALL SELECT group_id, 4, 0, 'Kinds: ' || kinds FROM differ "
    "UNION ALL SELECT group_id, 5, 0, 'Similarities: ' || CASE WHEN similarities <> '' THEN similarities ELSE '(none)' END FROM differ "
    "UNION ALL SELECT group_id, 6, 0, 'Differences: (none)' FROM differ WHERE len(diff) = 0 UNION ALL SELECT group_id, 7, 0, 'SaveRecommendation: ' || save_recommendation FROM differ "
    f"UNION ALL {_PIECES} UNION ALL SELECT group_id, 8, nth, CASE WHEN nth > 0 THEN ' | ' ELSE 'Compared: ' END || file_name || ':' || kind FROM placed")
# every pair of members written out, then gathered by the members' tag sets
ORACLES["g6_similar_classes"] = _with(O.job_ctes() + [
    "tagged AS MATERIALIZED (SELECT capture_id, capture_id // 24 AS group_id, list_sort(list_distinct(tags_h)) AS tags FROM a)",
    "pairs AS (SELECT x.group_id, x.capture_id, x.tags, y.capture_id AS other_id, y.tags AS other, len(list_intersect(x.tags, y.tags)) AS common "
    "FROM tagged x JOIN tagged y ON x.group_id = y.group_id AND x.capture_id <> y.capture_id)",
    "scored AS (SELECT *, common / CAST(len(tags) + len(other) - common AS DOUBLE) AS score FROM pairs WHERE common > 0)",
    "links AS (SELECT capture_id, count(*) AS n_linked FROM scored WHERE score >= 0.5 GROUP BY capture_id)",
    "best AS (SELECT group_id, tags, other AS best_tags, score AS best_similarity FROM (SELECT *, row_number() OVER (PARTITION BY group_id, tags ORDER BY score DESC, other) AS r "
    "FROM scored WHERE other <> tags) WHERE r = 1)"],
    "SELECT t.group_id, array_to_string(t.tags, '|') AS tags, count(*) AS n_members, CAST(max(coalesce(l.n_linked, 0)) AS BIGINT) AS n_linked, "
    "array_to_string(any_value(b.best_tags), '|') AS best_tags, any_value(b.best_similarity) AS best_similarity FROM tagged t LEFT JOIN links l USING (capture_id) "
    "LEFT JOIN best b ON b.group_id = t.group_id AND b.tags = t.tags GROUP BY t.group_id, t.tags")

# --- H. recent-media context ---------------------------------------------------------

ORACLES["h1_recent_media"] = _with(O.recent_media_ctes(8, 4), "SELECT conv_id, media_pos, file_path FROM media")
ORACLES["h1_recent_media_3_2"] = _with(O.recent_media_ctes(3, 2), "SELECT conv_id, media_pos, file_path FROM media")
ORACLES["h2_recent_media_by_turn"] = _with(O.recent_media_ctes(8, 4, by_turn=True),
                                           "SELECT conv_id, as_of AS turn, media_pos, file_path FROM media")
ORACLES["h2_recent_media_by_turn_3_2"] = _with(O.recent_media_ctes(3, 2, by_turn=True),
                                               "SELECT conv_id, as_of AS turn, media_pos, file_path FROM media")
ORACLES["h2_gapped"] = _with(
    O.recent_media_ctes(8, 4, by_turn=True, given=f"SELECT * REPLACE (turn * turn * 3 + conv_id % 5 AS turn) FROM ({O.fixture_messages()})"),
    "SELECT conv_id, as_of AS turn, media_pos, file_path FROM media")
_EPOCHS = (f"SELECT * REPLACE (CASE WHEN conv_id % 3 = 0 THEN -1 ELSE conv_id END AS conv_id, 1704067200000 + "
           f"CAST(floor((CASE WHEN conv_id % 3 = 0 THEN conv_id * 40 + turn ELSE turn END) / 3) AS BIGINT) * 60000 AS turn) FROM ({O.fixture_messages()})")
ORACLES["h1_epoch_ties"] = _with(O.recent_media_ctes(8, 4, given=_EPOCHS), "SELECT conv_id, media_pos, file_path FROM media")
ORACLES["h2_epoch_ties"] = _with(O.recent_media_ctes(8, 4, by_turn=True, given=_EPOCHS), "SELECT conv_id, as_of AS turn, media_pos, file_path FROM media")
ORACLES["h3_context_entries"] = _with(O.context_ctes(), "SELECT conv_id, media_pos, file_path, status, entry FROM entries")
ORACLES["h4_conversation_context"] = _with(O.context_ctes(), (
    "SELECT conv_id, CAST(count(*) AS BIGINT) AS n_entries, "
    + O.q("\n".join(R.CONTEXT_PREAMBLE) + "\n\n").replace("\n", "' || chr(10) || '")
    + " || string_agg(entry, chr(10) || chr(10) ORDER BY media_pos) AS context FROM entries GROUP BY conv_id"))

ORACLES["a3_unresolved_requests"] = _with(O.base_ctes() + [
    f"msgs AS ({O.fixture_messages()})",
    f"req AS (SELECT DISTINCT {O.tr('raw')} AS file_path FROM (SELECT unnest(regexp_extract_all(text, {O.media_pattern()}, 1)) "
    f"AS raw FROM msgs) WHERE {O.tr('raw')} <> '')",
], "SELECT file_path, 'file not found: ' || file_path AS message FROM req WHERE file_path NOT IN (SELECT file_path FROM caps)")

# --- I, K ------------------------------------------------------------------------------


def _fp(prefix: str = "") -> str:
    return (f"sha1(CAST(to_json(struct_pack(file_path := {prefix}file_path, size_bytes := CAST({prefix}size_bytes AS BIGINT), "
            f"modified_ms := CAST({prefix}modified_ms AS BIGINT), hint := coalesce({prefix}hint, ''), "
            f"ocr := struct_pack(provider := 'auto', fallback_order := {O.arr(R.OCR_FALLBACK_ORDER)}, "
            f"timeout_ms := {R.OCR_TIMEOUT_MS}), vision := struct_pack(provider := 'heuristic'), "
            f"max_summary_chars := {R.MAX_SUMMARY_CHARS})) AS VARCHAR))")


ORACLES["i1_fingerprint"] = _with(O.base_ctes(), f"SELECT capture_id, {_fp()} AS fingerprint FROM caps")
ORACLES["i2_analyze_incremental"] = _with(O.job_ctes(), (
    FLAT_ANALYSIS.replace(" FROM a", "") + f", {_fp()} AS fingerprint, (capture_id % 3 = 0 AND NOT error_o) AS from_store FROM a"))
_TWICE = FLAT_ANALYSIS.replace(" FROM a", "") + f", {_fp()} AS fingerprint, (capture_id % 3 = 0 AND NOT error_o) AS from_store FROM a"
ORACLES["i2_duplicate_captures"] = _with(O.job_ctes(), (
    _TWICE + " UNION ALL " + _TWICE.replace("SELECT capture_id,", "SELECT capture_id + 1000000000 AS capture_id,", 1) + " WHERE capture_id % 7 = 0"))
ORACLES["i3_retain_newest"] = _with(O.job_ctes(), (
    f"SELECT {_fp()} AS fingerprint, capture_id, CAST(modified_ms AS BIGINT) AS analyzed_ms FROM a WHERE NOT error_o "
    f"ORDER BY modified_ms DESC, fingerprint LIMIT 64"))
ORACLES["i3_compacted_store"] = ORACLES["i3_retain_newest"]
ORACLES["k1_kind_report"] = _with(O.job_ctes(), (
    "SELECT kind_o AS kind, save_target, CAST(GROUPING(kind_o, save_target) AS BIGINT) AS level, "
    "CAST(count(*) AS BIGINT) AS n_captures, CAST(sum(CASE WHEN error_o THEN 1 ELSE 0 END) AS BIGINT) AS n_failed, "
    "round(avg(confidence_o), 6) AS mean_confidence FROM a GROUP BY ROLLUP (kind_o, save_target)"))
ORACLES["k2_tag_report"] = _with(O.job_ctes(), (
    "SELECT 'tag' AS dimension, v AS value, CAST(count(*) AS BIGINT) AS n_captures FROM "
    "(SELECT unnest(list_distinct(tags_h)) AS v FROM a) GROUP BY v "
    "UNION ALL SELECT 'risk' AS dimension, v AS value, CAST(count(*) AS BIGINT) AS n_captures FROM "
    "(SELECT unnest(list_distinct(risk_flags_o)) AS v FROM a) GROUP BY v"))

# --- A4, B6, J ------------------------------------------------------------------------

_PAYLOADS = [
    "pay0 AS (SELECT capture_id, provider, elapsed_ms, CAST(to_json(struct_pack(provider := CASE WHEN capture_id % 5 = 0 THEN 'my-ocr' ELSE provider END, "
    "text := text, lines := list_transform(string_split(text, chr(10)), lambda l: struct_pack(text := l, score := 0.9::DOUBLE)))) AS VARCHAR) AS good, "
    "CAST(to_json(struct_pack(provider := provider, text := elapsed_ms)) AS VARCHAR) AS numeric_json FROM att)",
    "pay AS (SELECT capture_id, provider, elapsed_ms, 1 AS attempt_no, CASE WHEN capture_id % 7 = 0 THEN '}' || good ELSE good END AS payload FROM pay0 "
    "UNION ALL SELECT capture_id, provider, elapsed_ms, 0, numeric_json FROM pay0 WHERE capture_id % 11 = 0)",
    "par0 AS (SELECT capture_id, provider, elapsed_ms, attempt_no, json_valid(payload) AS ok, "
    "CASE provider WHEN 'paddleocr' THEN 'PaddleOCR' WHEN 'macos_vision' THEN 'macOS Vision OCR' END AS label, "
    "CASE WHEN json_valid(payload) AND json_type(payload, '$.provider') = 'VARCHAR' AND json_extract_string(payload, '$.provider') <> '' "
    "THEN json_extract_string(payload, '$.provider') ELSE provider END AS reported_provider, "
    "CASE WHEN json_valid(payload) AND json_type(payload, '$.text') = 'VARCHAR' THEN json_extract_string(payload, '$.text') ELSE '' END AS text, "
    "CASE WHEN json_valid(payload) AND json_type(payload, '$.lines') = 'ARRAY' THEN list_filter(list_transform("
    "CAST(json_extract(payload, '$.lines[*]') AS JSON[]), lambda it: CASE WHEN json_type(it, '$.text') = 'VARCHAR' "
    "THEN json_extract_string(it, '$.text') ELSE '' END), lambda s: length(s) > 0) ELSE []::VARCHAR[] END AS lines FROM pay)",
    f"par AS (SELECT *, CASE WHEN NOT ok THEN [label || ' failed: invalid JSON payload'] WHEN {O.tr('text')} = '' AND len(lines) = 0 "
    "THEN [label || ' returned no text'] ELSE []::VARCHAR[] END AS warnings FROM par0)",
]
ORACLES["a4_read_ocr_payloads"] = _with(_B + _PAYLOADS, (
    "SELECT capture_id, provider, CAST(attempt_no AS BIGINT) AS attempt_no, reported_provider, text, array_to_string(lines, chr(10)) AS lines, "
    "array_to_string(warnings, '|') AS warnings FROM par"))
ORACLES["b1_from_payloads"] = _with(_B + _PAYLOADS + O.resolve_ctes(list(R.OCR_FALLBACK_ORDER), None, att="par"), _ocr_select())
ORACLES["a1_image_listing"] = (
    "SELECT doc_id // 64 AS bucket, '.txt' AS suffix, " + f"'{R.MIME_DEFAULT}' AS mime_type, CAST(sum(strlen(coalesce(text, '')) + 1) AS BIGINT) AS size_bytes, "
    f"CASE WHEN sum(strlen(text) + 1) > {R.MAX_IMAGE_BYTES} THEN 'image too large' ELSE 'unsupported image type' END AS message FROM documents GROUP BY 1")
ORACLES["a6_json_results"] = _an(
    "SELECT capture_id, CAST(to_json(struct_pack(kind := kind_o, confidence := confidence_o, summary := summary_o, ocr_text := ocr_text_o, "
    "entities := entities_o, risk_flags := risk_flags_o, warnings := warnings_o, error := error_o)) AS VARCHAR) AS json FROM a")
ORACLES["b6_extract_text"] = _with(O.base_ctes(), (
    "SELECT capture_id, 'utf8' AS ocr_provider, ocr_text, "
    "CAST(len(list_filter(string_split(ocr_text, chr(10)), lambda s: length(s) > 0)) AS INTEGER) AS n_lines, "
    "CASE WHEN ocr_text = '' THEN 'utf8 returned no text' ELSE '' END AS ocr_warnings FROM caps"))
# The chain of extractors as a table of attempts, folded like any other.
_CHAIN = [
    "answers AS (SELECT capture_id, 'paddleocr' AS provider, CASE WHEN ends_with(file_path, '.png') THEN ocr_text ELSE '' END AS text, []::VARCHAR[] AS lines, "
    "ends_with(lower(file_path), '.tiff') AS refused FROM caps UNION ALL SELECT capture_id, 'utf8', ocr_text, "
    "list_filter(string_split(ocr_text, chr(10)), lambda s: length(s) > 0), false FROM caps)",
    "chain AS (SELECT capture_id, provider, 0 AS attempt_no, CAST(0 AS BIGINT) AS elapsed_ms, text, lines, "
    f"CASE WHEN refused THEN ['PaddleOCR failed: unsupported file type'] WHEN {O.tr('text')} <> '' OR len(lines) > 0 THEN []::VARCHAR[] "
    "WHEN provider = 'paddleocr' THEN ['PaddleOCR returned no text'] ELSE ['utf8 returned no text'] END AS warnings FROM answers)",
]
ORACLES["b6_extractor_chain"] = _with(O.base_ctes() + _CHAIN + O.resolve_ctes(["paddleocr", "utf8"], None, att="chain"), (
    f"SELECT capture_id, ocr_provider, ocr_text, CAST(len(ocr_lines) AS INTEGER) AS n_lines, {j('ocr_warnings')} AS ocr_warnings FROM ocr"))
_FLAT_OCR = FLAT_ANALYSIS
ORACLES["j1_stream_analyze"] = _an(_FLAT_OCR)
ORACLES["j2_stream_dedupe"] = _an(_FLAT_OCR.replace("SELECT capture_id,", f"SELECT {_fp()} AS fingerprint, capture_id,", 1))
ORACLES["j3_stream_context"] = ORACLES["h1_recent_media"]
ORACLES["j3_epoch_ties"] = ORACLES["h1_epoch_ties"]

# --- A5, A6, F5 ----------------------------------------------------------------------

ORACLES["f5_render_handoff"] = _an(f"SELECT capture_id, {O.q(R.HANDOFF_HEADER)} || chr(10) || {O.handoff_json()} AS handoff_block FROM a")
ORACLES["a6_write_results"] = _with(O.job_ctes(), (
    f"SELECT capture_id, {_fp()} AS fingerprint, kind_o AS kind, title_h AS title, {O.q(R.ANALYSIS_SCHEMA)} AS schema_id, "
    "CAST(modified_ms AS BIGINT) AS analyzed_ms FROM a WHERE NOT error_o"))

# Nested messages walked depth-first: array items by index, object members in
# the order of the document; string leaves at depth <= 8.
# Numbers only, plain text (no JSON) or a record, as the fixture deals them.
_NUMBERS_ONLY = "conv_id % 5 = 3 AND turn % 2 = 1"
_NESTED = (f"nm AS (SELECT conv_id, turn, CASE WHEN {_NUMBERS_ONLY} THEN CAST(to_json(struct_pack(turn := turn, \"values\" := [conv_id, 7])) AS VARCHAR) "
           "WHEN conv_id % 5 = 1 AND NOT json_valid(text) THEN CAST(to_json(text) AS VARCHAR) WHEN conv_id % 5 = 1 THEN text "
           "ELSE CAST(to_json(struct_pack(role := role, content := list_transform("
           "string_split(text, chr(10)), lambda l: struct_pack(type := 'text', text := l)), "
           "meta := struct_pack(turn := turn, channel := 'fixture'))) AS VARCHAR) END AS message FROM msgs)")
_WALK = (
    "walk(conv_id, turn, path, depth, j) AS ("
    "SELECT conv_id, turn, []::INTEGER[], 0, CAST(message AS JSON) FROM nm "
    "UNION ALL "
    "SELECT w.conv_id, w.turn, list_append(w.path, CAST(c.i AS INTEGER)), w.depth + 1, c.v FROM walk w, LATERAL ("
    "SELECT i - 1 AS i, json_extract(w.j, '$[' || CAST(i - 1 AS VARCHAR) || ']') AS v "
    "FROM range(1, CAST(json_array_length(w.j) AS BIGINT) + 1) t(i) WHERE json_type(w.j) = 'ARRAY' "
    "UNION ALL "
    "SELECT k.i - 1 AS i, json_extract(w.j, '$.\"' || k.key || '\"') AS v FROM "
    "(SELECT unnest(ks) AS key, unnest(range(1, len(ks) + 1)) AS i FROM (SELECT json_keys(w.j) AS ks) "
    "WHERE json_type(w.j) = 'OBJECT') k) c WHERE w.depth < 8)")
ORACLES["a5_message_chunks"] = _with([f"msgs AS ({O.fixture_messages()})", _NESTED, _WALK], (
    "SELECT conv_id, turn, CAST(row_number() OVER (PARTITION BY conv_id, turn ORDER BY path) - 1 AS INTEGER) AS chunk_pos, "
    "json_extract_string(j, '$') AS text FROM walk WHERE json_type(j) = 'VARCHAR'"))

ORACLES["h1_recent_media_nested"] = _with(
    O.recent_media_ctes(8, 4, given=f"SELECT conv_id, turn, CASE WHEN {_NUMBERS_ONLY} THEN '' ELSE text END AS text FROM ({O.fixture_messages()})"),
    "SELECT conv_id, media_pos, file_path FROM media")
ORACLES["g1_compare_requests"] = ORACLES["g1_compare_groups"]
ORACLES["h4_conversation_context_by_turn"] = _with(O.context_ctes(by_turn=True), (
    "SELECT conv_id, turn, CAST(count(*) AS BIGINT) AS n_entries, "
    + O.q("\n".join(R.CONTEXT_PREAMBLE) + "\n\n").replace("\n", "' || chr(10) || '")
    + " || string_agg(entry, chr(10) || chr(10) ORDER BY media_pos) AS context FROM entries GROUP BY conv_id, turn"))
