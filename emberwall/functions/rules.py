"""Classification rules as Column builders (two profiles: ``batch`` and ``api``).

Every rule is a native expression, so a whole classification is one
projection inside whole-stage codegen; there is no Python UDF anywhere.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .constants import (
    ALLOWED_ACTIONS,
    API_HIGH_BUG_MARKERS,
    ATTACK_FLAG_PATTERNS,
    ATTACK_REASON_PATTERNS,
    ATTACK_TYPE_RULES,
    BLOCKED_ACTIONS,
    BUG_LABELS,
    CORRUPT_PREFIX,
    HIGH_BUG_MARKERS,
    HIGH_SEVERITY_FLAGS,
    HIGH_SEVERITY_PHRASES,
    INVALID_IP_TEXT,
    LOW_BUG_MARKERS,
    MALFORMED_TIMESTAMP_MARKS,
    MAX_PORT,
    MEDIUM_BUG_MARKERS,
    MEDIUM_SEVERITY_FLAGS,
    MEDIUM_SEVERITY_PHRASES,
    OTHER_ATTACK,
    SUSPICIOUS_NORMAL_PHRASES,
)
from .text import contains_any, is_blank

LABEL_NAMES = tuple(name for name, _ in BUG_LABELS)
API_LABEL_NAMES = (
    "CORRUPT_LINE", "MALFORMED_TIMESTAMP", "INVALID_IP_SRC", "INVALID_IP_DST",
    "MISSING_SRC_IP", "MISSING_DST_IP", "MISSING_TIMESTAMP", "MISSING_PROTOCOL",
    "MISSING_ACTION", "MISSING_REASON",
)


def _s(name: str) -> Column:
    return F.col(name).cast("string")


_DIGITS = "0123456789"
_ALNUM = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ" + _DIGITS


def has_non_digit(text: Column) -> Column:
    """Same truth as ``rlike('[^0-9]')`` without a regex: anything left after removing digits."""
    return F.length(F.translate(text, _DIGITS, "")) > 0


def _bad_port(port: Column) -> Column:
    # a non-digit anywhere, or above the port range; try_cast keeps text ports labelled
    return has_non_digit(port) | (port.try_cast("double") > F.lit(MAX_PORT))


def _invalid_ip(ip: Column) -> Column:
    # the reference's pattern is a regex (dots match anything); every match contains
    # '999', so the cheap byte search filters first and the regex runs on candidates only
    return F.when(ip.contains("999"), ip.rlike(INVALID_IP_TEXT)).otherwise(
        F.when(ip.isNotNull(), F.lit(False)))


def _valid_session(session: Column) -> Column:
    # exactly 12 characters, all ASCII letters or digits (the anchored regex, without one)
    return (F.length(session) == 12) & (F.length(F.translate(session, _ALNUM, "")) == 0)


def batch_label_conditions(ts: Column) -> list[tuple[str, Column]]:
    """The 18 batch-profile conditions, in emission order.

    ``ts`` is the timestamp text the time rules look at: the normalised
    value (``timestamp_mode="parsed"``, the reference's effective behaviour)
    or the original text (``"raw"``).
    """
    conds = {
        "CORRUPT_LINE": ts.startswith(CORRUPT_PREFIX),
        "MALFORMED_TIMESTAMP": contains_any(ts, MALFORMED_TIMESTAMP_MARKS),
        # the reference matches this as a regex, so its dots match any character
        "INVALID_IP_SRC": _invalid_ip(_s("src_ip")),
        "INVALID_IP_DST": _invalid_ip(_s("dst_ip")),
        "NEGATIVE_BYTES": F.col("bytes").cast("string").try_cast("double") < F.lit(0),
        "NONNUMERIC_PORT_SRC": _bad_port(_s("src_port")),
        "NONNUMERIC_PORT_DST": _bad_port(_s("dst_port")),
        "MISSING_SRC_PORT": F.col("src_port").isNull(),
        "MISSING_DST_PORT": F.col("dst_port").isNull(),
        "MISSING_SRC_IP": F.col("src_ip").isNull(),
        "MISSING_DST_IP": F.col("dst_ip").isNull(),
        "MISSING_TIMESTAMP": ts.isNull(),
        "MISSING_PROTOCOL": F.col("protocol").isNull(),
        "MISSING_ACTION": is_blank(_s("action")),
        "MISSING_REASON": is_blank(_s("reason")),
        "MISSING_FIREWALL_ID": is_blank(_s("firewall_id")),
        "INVALID_SESSION_ID": F.col("session_id").isNotNull() & ~_valid_session(_s("session_id")),
        "MISSING_RULE_ID": F.col("rule_id").isNull(),
    }
    return [(name, conds[name]) for name in LABEL_NAMES]


def api_label_conditions(ts: Column | None = None, src: Column | None = None,
                         dst: Column | None = None) -> list[tuple[str, Column]]:
    """The 10 API-profile conditions (null-safe: missing text counts as '').

    ``ts``/``src``/``dst`` may be given as already null-to-'' columns.
    """
    ts = F.coalesce(_s("timestamp"), F.lit("")) if ts is None else ts
    src = F.coalesce(_s("src_ip"), F.lit("")) if src is None else src
    dst = F.coalesce(_s("dst_ip"), F.lit("")) if dst is None else dst
    conds = {
        "CORRUPT_LINE": ts.contains(CORRUPT_PREFIX),
        "MALFORMED_TIMESTAMP": contains_any(ts, MALFORMED_TIMESTAMP_MARKS),
        "INVALID_IP_SRC": src.contains(INVALID_IP_TEXT),
        "INVALID_IP_DST": dst.contains(INVALID_IP_TEXT),
        "MISSING_SRC_IP": src == "",
        "MISSING_DST_IP": dst == "",
        "MISSING_TIMESTAMP": ts == "",
        "MISSING_PROTOCOL": is_blank(_s("protocol")),
        "MISSING_ACTION": is_blank(_s("action")),
        "MISSING_REASON": is_blank(_s("reason")),
    }
    return [(name, conds[name]) for name in API_LABEL_NAMES]


def label_columns(conditions: list[tuple[str, Column]]) -> list[Column]:
    """Each label as its own column (label text or null)."""
    return [F.when(cond, F.lit(name)) for name, cond in conditions]


def join_labels(conditions: list[tuple[str, Column]]) -> Column:
    """Non-null labels joined by ``|`` in order; none -> null."""
    return F.nullif(F.concat_ws("|", *label_columns(conditions)), F.lit(""))


def is_attack(reason: Column | None = None, flags: Column | None = None) -> Column:
    """Any attack phrase in reason OR any marker in flags, case-insensitive (three-valued)."""
    reason = _s("reason") if reason is None else reason
    flags = _s("flags") if flags is None else flags
    return contains_any(reason, ATTACK_REASON_PATTERNS, ignore_case=True) | contains_any(
        flags, ATTACK_FLAG_PATTERNS, ignore_case=True
    )


def is_attack_api() -> Column:
    """P8 as the API evaluates it: missing text is '' so the result is never null."""
    return is_attack(F.coalesce(_s("reason"), F.lit("")), F.coalesce(_s("flags"), F.lit("")))


def classify(bug_type: Column, attack: Column) -> Column:
    """Bug over Attack over Normal; a null attack test means Normal."""
    return (
        F.when(bug_type.isNotNull(), F.lit("Bug"))
        .when(attack, F.lit("Attack"))
        .otherwise(F.lit("Normal"))
    )


def classify_tier(bug_tier: Column, attack: Column) -> Column:
    """P9 from the labelling tier: any label fired <=> the tier is set."""
    return classify(bug_tier, attack)


def is_blocked(action: Column) -> Column:
    """Action in DENY/DROP/REJECT (case-sensitive)."""
    return action.isin(*BLOCKED_ACTIONS)


def is_allowed(action: Column) -> Column:
    """Action in ALLOW/ACCEPT (case-sensitive)."""
    return action.isin(*ALLOWED_ACTIONS)


def is_deny(action: Column) -> Column:
    """P25: blocked after upper-casing; null is not blocked."""
    return F.upper(F.coalesce(action.cast("string"), F.lit(""))).isin(*BLOCKED_ACTIONS)


def tier_from_conditions(conditions: list[tuple[str, Column]]) -> Column:
    """Bug severity tier straight from the label conditions; null for a clean record.

    Equal to testing the joined label text for the tier markers, but each
    condition is evaluated once instead of once per marker test, which keeps
    filters on ``severity`` (pushed below the projection) small enough for
    whole-stage codegen.
    """
    tier_of = dict(BUG_LABELS)
    expr = None
    for tier in ("High", "Medium", "Low"):
        group = [F.coalesce(c, F.lit(False)) for name, c in conditions if tier_of[name] == tier]
        if not group:
            continue
        cond = group[0]
        for g in group[1:]:
            cond = cond | g
        expr = F.when(cond, F.lit(tier)) if expr is None else expr.when(cond, F.lit(tier))
    return expr


def tier_from_text(bug_type: Column) -> Column:
    """Bug severity tier from joined label text, as the reference tests it ('' = clean)."""
    return (
        F.when(contains_any(bug_type, HIGH_BUG_MARKERS), F.lit("High"))
        .when(contains_any(bug_type, MEDIUM_BUG_MARKERS), F.lit("Medium"))
        .when(contains_any(bug_type, LOW_BUG_MARKERS), F.lit("Low"))
    )


def severity_batch(log_type: Column, reason: Column, flags: Column, action: Column, bug_type: Column,
                   bug_tier: Column | None = None) -> Column:
    """P12 on normalised columns (reason lower, flags/action upper, bug_type '' if none).

    ``bug_tier`` may carry the tier computed during labelling; otherwise it
    is read from the label text. A Bug without a known marker is Medium.
    """
    high_attack = contains_any(reason, HIGH_SEVERITY_PHRASES) | contains_any(flags, HIGH_SEVERITY_FLAGS)
    medium_attack = contains_any(reason, MEDIUM_SEVERITY_PHRASES) | contains_any(flags, MEDIUM_SEVERITY_FLAGS)
    attack_sev = (
        F.when(high_attack, F.lit("High")).when(medium_attack, F.lit("Medium")).otherwise(F.lit("Low"))
    )
    tier = tier_from_text(bug_type) if bug_tier is None else bug_tier
    bug_sev = F.coalesce(tier, F.lit("Medium"))
    # in the batch profile every blocked normal record is Medium, suspicious or not
    normal_sev = F.when(is_blocked(action), F.lit("Medium")).otherwise(F.lit("Low"))
    return (
        F.when(log_type == "Attack", attack_sev)
        .when(log_type == "Bug", bug_sev)
        .otherwise(normal_sev)
    )


def severity_api(log_type: Column, bug_type: Column, reason: Column | None = None, flags: Column | None = None,
                 action: Column | None = None) -> Column:
    """P16 on raw columns (or on given lower-cased reason / upper-cased flags and action)."""
    reason = F.lower(F.coalesce(_s("reason"), F.lit(""))) if reason is None else reason
    flags = F.upper(F.coalesce(_s("flags"), F.lit(""))) if flags is None else flags
    action = F.upper(F.coalesce(_s("action"), F.lit(""))) if action is None else action
    attack_sev = (
        F.when(contains_any(reason, HIGH_SEVERITY_PHRASES) | contains_any(flags, HIGH_SEVERITY_FLAGS), F.lit("High"))
        .when(contains_any(reason, MEDIUM_SEVERITY_PHRASES) | contains_any(flags, MEDIUM_SEVERITY_FLAGS), F.lit("Medium"))
        .otherwise(F.lit("Low"))
    )
    bug_sev = F.when(
        contains_any(F.coalesce(bug_type, F.lit("")), API_HIGH_BUG_MARKERS), F.lit("High")
    ).otherwise(F.lit("Medium"))
    suspicious = contains_any(reason, SUSPICIOUS_NORMAL_PHRASES)
    normal_sev = F.when(suspicious & action.isin(*BLOCKED_ACTIONS), F.lit("Medium")).otherwise(F.lit("Low"))
    return (
        F.when(log_type == "Attack", attack_sev)
        .when(log_type == "Bug", bug_sev)
        .otherwise(normal_sev)
    )


def attack_type_of(reason_lower: Column, fallback: Column) -> Column:
    """First matching attack family on lower-cased reason, else ``fallback``."""
    expr = None
    for name, phrases in ATTACK_TYPE_RULES:
        cond = contains_any(reason_lower, phrases)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr.otherwise(fallback)


def attack_type_batch(log_type: Column, reason_lower: Column) -> Column:
    """Only for Attack rows; no match -> null."""
    return F.when(log_type == "Attack", attack_type_of(reason_lower, F.lit(None).cast("string")))


def attack_type_api(attack: Column, reason: Column | None = None) -> Column:
    """Whenever the attack test holds (even for Bug rows); fallback other_attack."""
    reason = F.lower(F.coalesce(_s("reason"), F.lit(""))) if reason is None else reason
    return F.when(attack, attack_type_of(reason, F.lit(OTHER_ATTACK)))
