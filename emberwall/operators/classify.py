"""Record classification (P6-P19) as DataFrame transforms.

Classification is row-local: the whole flow is a single narrow projection
(no shuffle), so it scales linearly with executors and streams unchanged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import rules
from ..session import session_token
from ..functions.timefmt import normalize_timestamp

_EXPRS: dict = {}


def _memo(key, build):
    """Build a set of rule expressions once per SparkContext and reuse it.

    The expressions only reference columns by name (unresolved), so the
    same trees serve every DataFrame; this saves hundreds of driver-to-JVM
    calls per query plan.
    """
    token = session_token()
    if token is None:
        return build()
    k = (token, key)
    if k not in _EXPRS:
        _EXPRS[k] = build()
    return _EXPRS[k]


TIMESTAMP_MODES = ("parsed", "raw")
# internal column: bug severity tier carried from labelling to scoring
BUG_TIER = "_bug_tier"
BATCH_OUTPUTS = ("bug_type", "log_type", "severity", "attack_type")
API_OUTPUTS = ("log_type", "bug_type", "attack_type", "severity")


def _check_mode(timestamp_mode: str) -> None:
    if timestamp_mode not in TIMESTAMP_MODES:
        raise ValueError(f"timestamp_mode must be one of {TIMESTAMP_MODES}, got {timestamp_mode!r}")


def _rule_timestamp(timestamp_mode: str) -> Column:
    raw = F.col("timestamp").cast("string")
    return normalize_timestamp(raw) if timestamp_mode == "parsed" else raw


def bug_flags(df: DataFrame, timestamp_mode: str = "parsed", profile: str = "batch") -> DataFrame:
    """One column per data-quality label (label text or null).

    Label columns are named after the label in lower case.
    """
    _check_mode(timestamp_mode)
    conds = (
        rules.batch_label_conditions(_rule_timestamp(timestamp_mode))
        if profile == "batch"
        else rules.api_label_conditions()
    )
    return df.withColumns({name.lower(): F.when(c, F.lit(name)) for name, c in conds})


def with_bug_type(df: DataFrame, timestamp_mode: str = "parsed") -> DataFrame:
    """Labels joined by ``|`` (null when the record is clean)."""
    _check_mode(timestamp_mode)
    conds = rules.batch_label_conditions(_rule_timestamp(timestamp_mode))
    return df.withColumn("bug_type", rules.join_labels(conds))


_TS_NORM = "_ts_norm"


def _classify_stages(timestamp_mode: str):
    s1 = {
        _TS_NORM: normalize_timestamp(F.col("timestamp").cast("string")),
    }
    rule_ts = F.col(_TS_NORM) if timestamp_mode == "parsed" else F.col("timestamp").cast("string")
    conds = rules.batch_label_conditions(rule_ts)
    flag_cols = {f"_l{i}": F.coalesce(c, F.lit(False)) for i, (_, c) in enumerate(conds)}
    s2 = {**flag_cols, "_is_attack": rules.is_attack()}
    stored = [(name, F.col(f"_l{i}")) for i, (name, _) in enumerate(conds)]
    s3 = {"bug_type": rules.join_labels(stored), BUG_TIER: rules.tier_from_conditions(stored)}
    s4 = {"log_type": rules.classify_tier(F.col(BUG_TIER), F.col("_is_attack")), "timestamp": F.col(_TS_NORM)}
    drops = [_TS_NORM, *flag_cols]
    return s1, s2, s3, s4, drops


def classify_records(df: DataFrame, timestamp_mode: str = "parsed", keep_attack: bool = False) -> DataFrame:
    """P2 + P6-P10: normalised timestamp, ``bug_type`` and ``log_type`` (and P8's ``is_attack`` if asked for).

    Staged projections: (1) the normalised timestamp, (2) one boolean per label plus the attack test, (3) label text and
    severity tier from those booleans, (4) the class. Each rule is evaluated
    once per record: building the outputs straight from the conditions would
    re-evaluate them inside CASE branches and OR tails, where common
    subexpression elimination cannot reach. The optimizer keeps the stages
    apart because every boolean is used more than once.
    """
    _check_mode(timestamp_mode)
    s1, s2, s3, s4, drops = _memo(("classify", timestamp_mode), lambda: _classify_stages(timestamp_mode))
    out = df.withColumns(s1).withColumns(s2).withColumns(s3).withColumns(s4).drop(*drops)
    return out.withColumnRenamed("_is_attack", "is_attack") if keep_attack else out.drop("_is_attack")


def normalize_text(df: DataFrame) -> DataFrame:
    """Overwrite reason (lower), flags/action/protocol (upper); nulls become ''."""
    return df.withColumns(_memo(("normalize",), _normalize_exprs))


def _normalize_exprs() -> dict:
    blank = F.lit("")
    return {
        "log_type": F.coalesce(F.col("log_type"), F.lit("NORMAL")),
        "reason": F.lower(F.coalesce(F.col("reason").cast("string"), blank)),
        "flags": F.upper(F.coalesce(F.col("flags").cast("string"), blank)),
        "action": F.upper(F.coalesce(F.col("action").cast("string"), blank)),
        "bug_type": F.coalesce(F.col("bug_type"), blank),
        "protocol": F.upper(F.coalesce(F.col("protocol").cast("string"), blank)),
    }


def score_records(df: DataFrame) -> DataFrame:
    """P12 + P13 on a normalised frame (uses the labelling tier when present)."""
    has_tier = BUG_TIER in df.columns

    def build():
        lt = F.col("log_type")
        tier = F.col(BUG_TIER) if has_tier else None
        return {
            "severity": rules.severity_batch(lt, F.col("reason"), F.col("flags"), F.col("action"),
                                             F.col("bug_type"), tier),
            "attack_type": rules.attack_type_batch(lt, F.col("reason")),
        }

    return df.withColumns(_memo(("score", has_tier), build)).drop(BUG_TIER)


def analyze_batch(df: DataFrame, timestamp_mode: str = "parsed") -> DataFrame:
    """The batch classifier end to end (P2 -> P6..P13), one narrow plan.

    Output: the input columns (``timestamp``, ``reason``, ``flags``,
    ``action``, ``protocol`` rewritten) plus ``bug_type, log_type,
    severity, attack_type``.
    """
    return score_records(normalize_text(classify_records(df, timestamp_mode)))


def drop_corrupt(df: DataFrame) -> DataFrame:
    """Remove records whose labels include CORRUPT_LINE.

    The test is generated (as a row of one element): a plain filter would be pushed below the classifier and any dealing
    out of its input, with every rule written out in it, and there run on the few tasks that read the files.
    """
    corrupt = F.coalesce(F.col("bug_type"), F.lit("")).contains("CORRUPT_LINE")
    return df.select("*", F.explode(F.array(corrupt)).alias("__corrupt")).where(~F.col("__corrupt")).drop("__corrupt")


def _api_stages():
    blank = F.lit("")

    def txt(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), blank)

    s1 = {
        "_ts_s": txt("timestamp"), "_src_s": txt("src_ip"), "_dst_s": txt("dst_ip"),
        "_r_l": F.lower(txt("reason")),
        "_f_u": F.upper(txt("flags")), "_a_u": F.upper(txt("action")),
    }
    conds = rules.api_label_conditions(F.col("_ts_s"), F.col("_src_s"), F.col("_dst_s"))
    flag_cols = {f"_l{i}": F.coalesce(c, F.lit(False)) for i, (_, c) in enumerate(conds)}
    s2 = {**flag_cols, "_is_attack": rules.is_attack_api()}
    stored = [(name, F.col(f"_l{i}")) for i, (name, _) in enumerate(conds)]
    s3 = {"bug_type": rules.join_labels(stored)}
    s4 = {"log_type": F.when(F.col("bug_type").isNotNull(), F.lit("Bug"))
          .when(F.col("_is_attack"), F.lit("Attack")).otherwise(F.lit("Normal"))}
    s5 = {
        "attack_type": rules.attack_type_api(F.col("_is_attack"), F.col("_r_l")),
        "severity": rules.severity_api(F.col("log_type"), F.col("bug_type"), F.col("_r_l"), F.col("_f_u"),
                                       F.col("_a_u")),
    }
    drops = ["_is_attack", *s1, *flag_cols]
    return s1, s2, s3, s4, s5, drops


def analyze_api(df: DataFrame) -> DataFrame:
    """The API-profile analyser as a whole-frame transform.

    Adds ``log_type, bug_type, attack_type, severity``; input columns pass
    through untouched. Staged like ``classify_records``: normalised text
    once, then one boolean per label, then the outputs.
    """
    s1, s2, s3, s4, s5, drops = _memo(("api",), _api_stages)
    return df.withColumns(s1).withColumns(s2).withColumns(s3).withColumns(s4).withColumns(s5).drop(*drops)


CURATED_COLUMNS = (
    "id", "timestamp", "firewall_id", "src_ip", "dst_ip", "src_port", "dst_port",
    "protocol", "action", "bytes", "duration_ms", "rule_id", "session_id", "user_name",
    "reason", "status", "flags", "bug_type", "log_category", "severity",
)


def to_curated(classified: DataFrame, keep_attack_type: bool = True) -> DataFrame:
    """Type a classified frame into the curated-table schema (without ``created_at``).

    Text ports and byte counts that do not parse become null (``try_cast``).
    ``log_category`` is the class; ``attack_type`` is kept as an extra column.
    """
    def opt(name: str, typ: str) -> Column:
        if name in classified.columns:
            return F.col(name).cast("string").try_cast(typ)
        return F.lit(None).cast(typ)

    def text(name: str) -> Column:
        return F.col(name).cast("string") if name in classified.columns else F.lit(None).cast("string")

    cols = {
        "id": opt("id", "bigint"),
        "timestamp": F.try_to_timestamp(F.col("timestamp").cast("string"), F.lit("yyyy-MM-dd HH:mm:ss")),
        "firewall_id": text("firewall_id"),
        "src_ip": text("src_ip"),
        "dst_ip": text("dst_ip"),
        "src_port": opt("src_port", "int"),
        "dst_port": opt("dst_port", "int"),
        "protocol": text("protocol"),
        "action": text("action"),
        "bytes": opt("bytes", "bigint"),
        "duration_ms": opt("duration_ms", "int"),
        "rule_id": text("rule_id"),
        "session_id": text("session_id"),
        "user_name": text("user_name"),
        "reason": text("reason"),
        "status": text("status"),
        "flags": text("flags"),
        "bug_type": text("bug_type"),
        "log_category": F.col("log_type"),
        "severity": F.col("severity"),
    }
    out = [cols[c].alias(c) for c in CURATED_COLUMNS]
    if keep_attack_type:
        out.append(F.col("attack_type"))
    return classified.select(*out)

