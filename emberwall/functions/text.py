"""String helpers that stay inside whole-stage codegen (no Python UDFs)."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from .constants import NULL_TOKENS


def literal_alternation(phrases: Iterable[str]) -> str:
    """One Java regex that finds any of ``phrases`` literally."""
    return "|".join(f"(?:{re.escape(p)})" for p in phrases)


def contains_any(col: Column, phrases: Iterable[str], ignore_case: bool = False) -> Column:
    """Substring search for any phrase; three-valued on null (like a regex find).

    Case-sensitive phrases are byte searches on the UTF-8 value; letters of
    either case are one fused regex with Unicode case folding.
    """
    phrases = list(phrases)
    if ignore_case:
        return col.rlike("(?iu)" + literal_alternation(phrases))
    expr = None
    for p in phrases:
        term = col.contains(p)
        expr = term if expr is None else (expr | term)
    return expr


def is_blank(col: Column) -> Column:
    """True for null or empty text (never null)."""
    return col.isNull() | (col == F.lit(""))


def null_token(col: Column, tokens: Iterable[str] = NULL_TOKENS) -> Column:
    """The CSV null tokens become null."""
    return F.when(~col.isin(*tokens), col)


def null_tokens(df, tokens: Iterable[str] = NULL_TOKENS, columns: Iterable[str] | None = None):
    """P1 over every string column (or ``columns``) in one projection."""
    targets = set(columns) if columns is not None else {
        f.name for f in df.schema.fields if f.dataType.simpleString() == "string"
    }
    return df.select(*[
        null_token(F.col(c), tokens).alias(c) if c in targets else F.col(c)
        for c in df.columns
    ])


def endpoint_label(ip: Column, port: Column) -> Column:
    """``ip:port``; an em dash for a missing ip, nothing for a missing port."""
    ip_text = F.when(is_blank(ip), F.lit("—")).otherwise(ip)
    return F.concat(ip_text, F.lit(":"), F.coalesce(port.cast("string"), F.lit("")))
