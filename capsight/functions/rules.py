"""Rule data shared by every job and by the DuckDB oracles.

FIXED VALUES: the keyword lists, confidences, reason texts, kind names, caps and
limits below must equal the behaviour being reproduced, so they are stated
plainly, in their natural order, in one place.  Nothing here is logic.
"""

# --- FIXED VALUES -----------------------------------------------------------

KINDS = (
    "chat_screenshot",
    "document_scan",
    "receipt_or_invoice",
    "photo_scene",
    "chart_or_dashboard",
    "mixed_unknown",
)

RECEIPT = "receipt_or_invoice"
CHAT = "chat_screenshot"
CHART = "chart_or_dashboard"
DOCUMENT = "document_scan"
PHOTO = "photo_scene"
UNKNOWN = "mixed_unknown"

# File-name classification: (kind, confidence, reason, keywords), first hit wins.
NAME_RULES = (
    (RECEIPT, 0.82, "matched receipt/invoice keywords",
     ("receipt", "invoice", "发票", "小票", "账单")),
    (CHAT, 0.80, "matched screenshot/chat keywords",
     ("screenshot", "截图", "screen", "chat", "telegram", "whatsapp")),
    (CHART, 0.78, "matched chart/dashboard keywords",
     ("chart", "dashboard", "图表", "报表", "panel")),
    (DOCUMENT, 0.76, "matched document keywords",
     ("scan", "document", "pdf", "doc", "文档", "扫描")),
)
NAME_IMAGE = (PHOTO, 0.52, "generic image mime type")
NAME_FALLBACK = (UNKNOWN, 0.30, "no strong heuristic match")

# Text classification keyword lists (substring tests, each keyword counts once).
RECEIPT_WORDS = ("合计", "实付", "应付", "金额", "税额", "invoice", "receipt", "tax",
                 "subtotal", "total", "订单号", "商户", "收款")
CHART_WORDS = ("同比", "环比", "增长", "下降", "趋势", "dashboard", "gmv", "dau", "mau",
               "ctr", "roi", "图表", "报表", "本周", "本月")
CHAT_WORDS = ("telegram", "whatsapp", "chatgpt", "message", "sender", "conversation info",
              "reply_to_current", "请输入消息", "发送", "对话", "消息")
DOC_WORDS = ("文档", "说明", "指南", "报告", "协议", "notice")

# Text classification outcomes: kind -> (confidence, reason).
TEXT_RESULTS = {
    RECEIPT: (0.88, "ocr matched receipt or invoice fields"),
    CHAT: (0.86, "ocr matched chat screenshot structure"),
    CHART: (0.82, "ocr matched dashboard or chart terminology"),
    DOCUMENT: (0.80, "ocr matched document-style heading or list structure"),
}
SAME_KIND_CAP = 0.98

# Mime types by lower-cased file suffix, in test order.
MIME_BY_SUFFIX = (
    (("png",), "image/png"),
    (("jpg", "jpeg"), "image/jpeg"),
    (("webp",), "image/webp"),
    (("gif",), "image/gif"),
    (("heic", "heif"), "image/heic"),
    (("bmp",), "image/bmp"),
    (("tiff", "tif"), "image/tiff"),
    (("avif",), "image/avif"),
    (("svg",), "image/svg+xml"),
)
MIME_DEFAULT = "application/octet-stream"

# Per-kind constant lists.
UI_ELEMENTS = {
    CHAT: ("message_list", "timestamp", "input_box"),
    CHART: ("header", "chart_area", "legend"),
}
LAYOUT_HINTS = {
    CHAT: ("top_bar", "message_stream", "composer"),
    DOCUMENT: ("page_block", "paragraph_flow"),
    RECEIPT: ("header", "line_items", "summary_footer"),
    CHART: ("header", "metric_cards", "visualization_region"),
}
LIST_LAYOUT_HINT = "list_structure"
RECEIPT_TABLE_HINTS = ("possible_line_items", "possible_totals_block")
DOCUMENT_TABLE_HINTS = ("possible_table_rows", "possible_column_alignment")
CHART_BASE_HINT = "trend_chart_candidate"
CHART_RATE_HINT = "contains_rate_or_growth_signal"
CHART_METRIC_HINT = "contains_business_metrics"
BASE_ENTITIES = {
    RECEIPT: ("merchant", "total", "date"),
    CHART: ("metric", "trend", "series"),
    DOCUMENT: ("title", "section"),
}
RISK_FINANCIAL = "contains_financial_fields"
RISK_PRIVATE = "may_contain_private_conversation"
RISK_PHONE = "contains_phone_number"
RISK_EMAIL = "contains_email"
RISK_LONG_ID = "contains_long_numeric_identifier"

KEY_FIELD_NAMES = ("title", "latest_time", "amount", "date", "phone", "email", "url")

OCR_LEAD_MAX = 140
OCR_LEAD_CUT = 137
TABLE_PREVIEW_MAX = 5
CHART_PERCENTS_MAX = 4
CHART_PERIODS_MAX = 4

# Save hints: (target, reason, confidence floor).
SAVE_DOCUMENT = ("knowledge", "document-like image with reusable extracted structure", 0.70)
SAVE_CHART = ("knowledge", "chart or dashboard image with reusable metrics and trend signals", 0.72)
SAVE_CHAT = ("memory", "conversation screenshot is usually session-specific context", 0.68)
SAVE_NONE = ("none", "generic image should only be saved on explicit request", 0.50)

VISION_DISABLED_WARNING = "Vision provider is disabled"

# Job defaults (the configuration defaults of the reproduced behaviour).
MAX_IMAGE_BYTES = 15 * 1024 * 1024
MAX_IMAGE_COUNT = 4
MAX_SUMMARY_CHARS = 4000
MAX_RECENT_MESSAGES = 8
OCR_TIMEOUT_MS = 30000
OCR_FALLBACK_ORDER = ("macos_vision", "paddleocr")
OCR_MIN_ATTEMPT_MS = 1500
OCR_ATTEMPT_CAP_MS = {"macos_vision": 12000, "paddleocr": 8000}
OCR_PROVIDER_LABEL = {"macos_vision": "macOS Vision OCR", "paddleocr": "PaddleOCR"}
OCR_NO_TEXT = "OCR returned no text"
OCR_DISABLED = "OCR provider is disabled"
CONTEXT_MIN_TIMEOUT_MS = 3000
CONTEXT_MAX_TIMEOUT_MS = 12000
CONTEXT_HINT = "auto_inbound_context"
CONTEXT_PREAMBLE = (
    "Auto-analyzed recent inbound images.",
    "Use these image blocks as high-priority visual context for the current turn.",
)
MESSAGE_MAX_DEPTH = 8

# Media marker inside message text; {W} stands for the JS whitespace class.
MEDIA_PATH_PATTERN = (
    r"(?i)\[media attached:{W}*([^\n|]+?\.(?:png|jpe?g|webp|gif|heic|heif|bmp|tiff?|avif|svg))"
    r"(?:{W}*\([^)]+\))?{W}*\|"
)

# Text block headers.
IMAGE_HEADER = "[Image]"
HANDOFF_HEADER = "[VisionHandoff]"
COMPARE_HEADER = "[ImageCompare]"

# Schema ids of our own records.
HANDOFF_SCHEMA = "capture/handoff@v1"
COMPARE_SCHEMA = "capture/compare@v1"
ANALYSIS_SCHEMA = "capture/analysis@v1"

# Thresholds of the text kinds.
RECEIPT_LIKE_MIN = 2
CHART_LIKE_MIN = 2
CHAT_WORDS_MIN = 2
CHAT_CLOCK_LINES_MIN = 1
CHAT_SPEAKER_LINES_MIN = 2
DOC_NUMBERED_LINES_MIN = 2
DOC_INSTRUCTIONS = (4, 3)  # lines, instruction lines
DOC_LONG_LINE = (5, 20)  # lines, characters of a long line
DOC_JOINED = (4, 40)  # lines, characters of all

# --- end of fixed values ----------------------------------------------------
