"""Date/time parsing and formatting as native expressions.

All functions assume the session time zone is UTC (see ``session.ensure_utc``).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .constants import (
    FALLBACK_DT,
    FALLBACK_HOUR,
    ISO_MS_Z_FORMAT,
    OUTPUT_TS_FORMAT,
    STRICT_INPUT_TS_FORMAT,
)

_ISO_DATE_PREFIX = r"^\d{4}-\d{2}-\d{2}"


def normalize_timestamp(ts: Column) -> Column:
    """Strict ``yyyy-MM-ddTHH:mm:ssZ`` parse, reformatted; failure -> null."""
    parsed = F.try_to_timestamp(ts.cast("string"), F.lit(STRICT_INPUT_TS_FORMAT))
    return F.date_format(parsed, OUTPUT_TS_FORMAT)


def parse_iso(ts: Column, strict: bool = False) -> Column:
    """ISO-8601 with ``Z``, an offset or no zone (taken as UTC); bad -> null.

    ``strict=True`` fails the query on a bad value (the reference's behaviour,
    with ANSI mode on); null input stays null.
    """
    text = ts.cast("string")
    if strict:
        return F.when(text.isNotNull(), F.to_timestamp(F.when(text.rlike(_ISO_DATE_PREFIX), text)
                                                         .otherwise(F.concat(F.lit("invalid:"), text))))
    return F.when(text.rlike(_ISO_DATE_PREFIX), F.try_to_timestamp(text))


def first_present(*cols: Column) -> Column:
    """First value that is neither null nor empty (Python truthiness on text)."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in cols])


def partition_dt(ts: Column) -> Column:
    """P4 day part; ``unknown`` if no usable time."""
    return F.coalesce(F.date_format(ts, "yyyy-MM-dd"), F.lit(FALLBACK_DT))


def partition_hour(ts: Column) -> Column:
    """P4 hour part; ``00`` if no usable time."""
    return F.coalesce(F.date_format(ts, "HH"), F.lit(FALLBACK_HOUR))


def iso_ms_z(ts: Column) -> Column:
    """Instant as ISO-8601 with milliseconds and ``Z``."""
    return F.date_format(ts, ISO_MS_Z_FORMAT)


def relative_time(ts: Column, as_of: Column) -> Column:
    """Dashboard age label of ``ts`` seen at ``as_of``."""
    minutes = F.floor((F.unix_micros(as_of) - F.unix_micros(ts)) / F.lit(60_000_000))
    hours = F.floor(minutes / 60)
    return (
        F.when(ts.isNull(), F.lit("—"))
        .when(minutes < 1, F.lit("Just now"))
        .when(minutes < 60, F.concat(minutes.cast("string"), F.lit("m ago")))
        .when(hours < 24, F.concat(hours.cast("string"), F.lit("h ago")))
        .otherwise(F.date_format(ts, "yyyy-MM-dd"))
    )
