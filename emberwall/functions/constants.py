"""Fixed values that must equal the reference's for identical results.

Everything below is data, not logic: phrase lists, label names, action
sets and formats, stated plainly and in the reference's natural order.
"""

# ---------------------------------------------------------------------------
# FIXED VALUES (must match the reference exactly)
# ---------------------------------------------------------------------------

# Actions counted as blocked / allowed.
BLOCKED_ACTIONS = ("DENY", "DROP", "REJECT")
ALLOWED_ACTIONS = ("ALLOW", "ACCEPT")

# Null tokens of the CSV reader.
NULL_TOKENS = ("N/A", "NA", "")

# Attack phrases searched case-insensitively in `reason`.
ATTACK_REASON_PATTERNS = (
    "port scan", "ssh brute force", "brute force",
    "XSS attempt", "malware", "DDoS", "Potential DDoS",
    "SQL injection", "Suspicious SQL payload",
    "Multiple auth failures", "Known malicious domain",
    "Command injection", "Path traversal", "Buffer overflow", "Ransomware",
)

# Attack markers searched case-insensitively in `flags`.
ATTACK_FLAG_PATTERNS = ("SCAN", "AUTH_FAIL", "XSS", "MALWARE", "DDOS", "SQLI", "EXPLOIT")

# Severity phrases (matched on lower-cased reason).
HIGH_SEVERITY_PHRASES = (
    "ssh brute force", "brute force", "multiple auth failures",
    "malware", "known malicious domain",
    "sql injection", "suspicious sql payload",
    "ddos", "potential ddos",
)
MEDIUM_SEVERITY_PHRASES = ("port scan", "xss attempt")

# Severity markers (matched on upper-cased flags).
HIGH_SEVERITY_FLAGS = ("AUTH_FAIL", "MALWARE", "SQLI", "DDOS")
MEDIUM_SEVERITY_FLAGS = ("SCAN", "XSS")

# Phrases that make a normal record suspicious.
SUSPICIOUS_NORMAL_PHRASES = ("suspicious payload", "protocol violation", "state mismatch", "no policy")

# Attack type by first matching phrase group (lower-cased reason), in order.
ATTACK_TYPE_RULES = (
    ("sql_injection", ("sql injection", "suspicious sql payload")),
    ("brute_force_ssh", ("ssh brute force", "brute force", "multiple auth failures")),
    ("malware_download", ("malware", "known malicious domain")),
    ("ddos", ("ddos", "potential ddos")),
    ("port_scan", ("port scan",)),
    ("xss", ("xss attempt",)),
)
OTHER_ATTACK = "other_attack"

# Data-quality labels in emission order, with their severity tier.
BUG_LABELS = (
    ("CORRUPT_LINE", "High"),
    ("MALFORMED_TIMESTAMP", "High"),
    ("INVALID_IP_SRC", "High"),
    ("INVALID_IP_DST", "High"),
    ("NEGATIVE_BYTES", "Medium"),
    ("NONNUMERIC_PORT_SRC", "Medium"),
    ("NONNUMERIC_PORT_DST", "Medium"),
    ("MISSING_SRC_PORT", "Medium"),
    ("MISSING_DST_PORT", "Medium"),
    ("MISSING_SRC_IP", "Low"),
    ("MISSING_DST_IP", "Low"),
    ("MISSING_TIMESTAMP", "Low"),
    ("MISSING_PROTOCOL", "Low"),
    ("MISSING_ACTION", "Low"),
    ("MISSING_REASON", "Low"),
    ("MISSING_FIREWALL_ID", "Low"),
    ("INVALID_SESSION_ID", "Low"),
    ("MISSING_RULE_ID", "Low"),
)

# Bug severity markers searched in the joined label text (batch profile).
HIGH_BUG_MARKERS = ("CORRUPT_LINE", "MALFORMED_TIMESTAMP", "INVALID_IP")
MEDIUM_BUG_MARKERS = ("NEGATIVE_BYTES", "NONNUMERIC_PORT", "MISSING_SRC_PORT", "MISSING_DST_PORT")
LOW_BUG_MARKERS = (
    "MISSING_SRC_IP", "MISSING_DST_IP", "MISSING_TIMESTAMP", "MISSING_PROTOCOL",
    "MISSING_ACTION", "MISSING_REASON", "MISSING_FIREWALL_ID", "INVALID_SESSION_ID",
    "MISSING_RULE_ID",
)
# Bug severity markers of the API profile.
API_HIGH_BUG_MARKERS = ("CORRUPT_LINE", "MALFORMED", "INVALID_IP")

# Timestamp text that marks broken records.
CORRUPT_PREFIX = "CORRUPTED_LINE"
MALFORMED_TIMESTAMP_MARKS = ("99:99:99", "-13-", "-99T")
INVALID_IP_TEXT = "999.999.999.999"

# Formats.
STRICT_INPUT_TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss'Z'"
OUTPUT_TS_FORMAT = "yyyy-MM-dd HH:mm:ss"
ISO_MS_Z_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"
FALLBACK_DT = "unknown"
FALLBACK_HOUR = "00"
MAX_PORT = 65535

# Read-API defaults.
PAGE_SIZE = 100
DASHBOARD_PAGE_SIZE = 50
TIMELINE_HOURS = 168
TIMELINE_TAIL = 48
TOP_K = 50
PREVIEW_ROWS = 10
PREVIEW_COLUMNS = ("timestamp", "src_ip", "dst_ip", "log_type", "severity", "attack_type", "reason")

# Ingestion defaults.
INFER_ROWS = 10_000
CHUNK_BYTES = 50 * 1024 * 1024
UPSERT_BATCH_ROWS = 1000
PROGRESS_EVERY = 100_000
EXPECTED_TOTAL_DOCS = 14_721_375
TARGET_RPS = 8200
