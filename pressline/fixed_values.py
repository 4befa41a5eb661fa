"""Fixed values of the data contract, stated plainly and kept in one place.

Everything here is vocabulary (word lists, thresholds, formats). Results depend on these exact
values, so they are data, not logic.
"""

# --- fixed values: state vocabularies -------------------------------------------------------
TOPIC_CLASSES = ["core", "adjacent", "irrelevant", "unknown"]
RELEVANT_TOPICS = ["core", "adjacent"]
CONTENT_DENSITIES = ["low", "medium", "high"]
TEXT_QUALITIES = ["poor", "usable", "strong"]
TEXT_STATUSES = ["completed", "low_context", "failed"]
TEXT_REASONS = [
    "missing_body", "sanitizer_exception", "post_cleanup_empty", "too_short", "title_only",
    "title_heavy", "template_heavy", "mostly_links", "truncated_to_low_context",
]
CURATE_STATUSES = ["approved", "rejected", "failed", "withdrawn"]
PUBLISH_ACTIONS = ["publish_link", "publish_summary"]
REJECT_ACTIONS = ["edit_rewrite", "reject_discard"]
DOWNSTREAM_ACTIONS = PUBLISH_ACTIONS + REJECT_ACTIONS
BRIEF_FORMATS = ["link_card", "structured_summary"]
TRANSLATION_STATUSES = ["pending", "completed", "failed", "stale"]
PUBLISH_STATUSES = ["published", "withdrawn"]
HEALTH_STATUSES = ["healthy", "degraded", "quarantined"]
TRIGGER_TYPES = ["scheduled", "manual", "recovery"]
RUN_STATUSES = ["running", "success", "partial_failure", "failed"]
ATTEMPT_OUTCOMES = ["success", "failed"]
DEDUP_RULES = ["guid", "url", "tp", "fh"]
MARKER_RULES = ["guid", "url", "tp", "fh", "th"]
DECISION_ACTORS = ["system", "operator"]
WRITER_TYPES_EDITED = ["human", "hybrid"]
WRITER_TYPES_GENERATED = ["AI", "machine"]
EMITTABLE_ERRORS = [
    "network_error", "timeout_error", "http_error_4xx", "http_error_5xx", "parse_error",
    "unexpected_error",
]
STORABLE_ERRORS = EMITTABLE_ERRORS + ["validation_error", "persistence_error"]
TIMELINESS_VALUES = ["current", "evergreen", "historical", "unclear"]
EVIDENCE_VALUES = [
    "physical_material", "radar_sensor", "video_photo", "eyewitness", "official_document",
    "scientific_paper", "media_report", "none",
]

# --- fixed values: thresholds ---------------------------------------------------------------
MIN_TITLE_HASH_LENGTH = 12
MIN_TEXT_LENGTH = 100
TITLE_REMAINDER_LIMIT = 40
LINK_TEXT_LIMIT = 0.7
BOILERPLATE_LIMIT = 3
DEGRADED_AFTER = 3
QUARANTINE_AFTER = 5
QUARANTINE_HOURS = 24
RETRY_LIMIT = 3
LATEST_LIMIT = 1000
HOME_LIMIT = 300
KEEP_SNAPSHOTS = 5
YIELD_THRESHOLD = 0.10
RELEVANCE_THRESHOLD = 0.40
ISOLATION_THRESHOLD = 0.50
DISABLE_YIELD = 0.05
AUTHORITY_CATEGORIES = [1, 3]
JA_TITLE_LIMIT = 120
MATURATION_HOURS = 2
RAW_RETENTION_DAYS = 14
RETENTION_EXCEPTIONS = ["investigation", "operator_frozen"]
DEFAULT_LANGUAGES = ["en", "zh", "ja"]
LATIN_WORDS_PER_MINUTE = 200
CJK_CHARS_PER_MINUTE = 300

# --- fixed values: click-tracking query parameters ------------------------------------------
TRACKING_PREFIX = "utm_"
TRACKING_PARAMS = ["fbclid", "gclid", "dclid", "msclkid", "mc_cid", "mc_eid", "igshid"]

# --- fixed values: typographic folds applied to titles before hashing -----------------------
FOLD_FROM = "‘’‚‛“”„‟–—―−"
FOLD_TO = "''''\"\"\"\"----"

# --- fixed values: boilerplate phrases of feed bodies ---------------------------------------
BOILERPLATE_PHRASES = [
    "read more", "click here", "all rights reserved", "subscribe to", "share on facebook",
    "share on twitter", "privacy policy", "terms of service", "cookie policy", "newsletter",
    "follow us on", "comment below",
]

# --- fixed values: presentation labels that must never appear inside content ----------------
UI_LABELS = [
    "Key Claim", "Evidence Level", "Objective Impact",
    "主要主張", "關鍵主張", "核心主張", "證據層級", "證據等級", "客觀影響", "實際影響",
    "主要な主張", "主張の要点", "証拠の水準", "証拠レベル", "証拠水準", "エビデンスレベル",
    "客観的な影響", "客観的影響", "目的上の影響",
]
# Label at the start of a value, and the stricter guard of translated fields; {labels} are alternatives.
LABEL_PREFIX = r"(?U)^[\s*_-]*({labels})[\s*_]*[:：]"
LABEL_GUARD = r"(?U)^\s*(?:[*\-+]\s+)?(?:\*\*|__|\*|_)?\s*(?:{labels})(?:\*\*|__|\*|_)?\s*[:：]"
BULLET_KEYS = ["key_claim", "evidence_level", "objective_impact"]
POST_LABELS = {
    "en": ["Key Claim", "Evidence Level", "Objective Impact"],
    "zh": ["關鍵主張", "證據等級", "客觀影響"],
    "ja": ["主要主張", "証拠レベル", "客観的影響"],
}

# --- fixed values: texts and formats --------------------------------------------------------
NOTE_EDITED = "This item is AI-assisted and human-curated."
NOTE_GENERATED = "This item is AI-generated."
NO_DATA = "[INSUFFICIENT_DATA]"
NOT_AVAILABLE = "N/A"
ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss'Z'"
SLUG_PATTERN = "^[a-z0-9][a-z0-9-]*$"
MONTH_PATTERN = "^[0-9]{4}-[0-9]{2}$"
ARCHIVE_FILE_PATTERN = "^[A-Za-z0-9][A-Za-z0-9._-]*[.]json$"
SNAPSHOT_ID_PATTERN = "^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}-[0-9]{2}-[0-9]{2}Z(-r[0-9]+)?$"
ISO_PATTERN = "^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}Z$"
DIGEST_PATTERN = "^sha256:[0-9a-f]{64}$"
SCHEDULE_MINUTES = {"hourly": 60, "daily": 1440, "slow": 4320}
