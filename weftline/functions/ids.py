"""Identifier helpers: pure column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: prefixes that mean another one
PREFIX_ALIASES = {"ORPHANET": "Orphanet", "ORPHA": "Orphanet", "MIM": "OMIM", "DO": "DOID"}


def curie_prefix(value: Column) -> Column:
    """What stands before the first colon, in its usual spelling; null without a colon."""
    raw = F.when(value.contains(":"), F.substring_index(value, ":", 1))
    out = raw
    for alias, name in PREFIX_ALIASES.items():
        out = F.when(raw == alias, F.lit(name)).otherwise(out)
    return out


def curie_local(value: Column) -> Column:
    """What stands after the first colon, or the whole value."""
    return F.regexp_replace(value, "^[^:]*:", "")


def curie(prefix: Column | str, local: Column) -> Column:
    return F.concat(F.lit(prefix) if isinstance(prefix, str) else prefix, F.lit(":"), local.cast("string"))


def strip_version(value: Column) -> Column:
    """Without a trailing version or isoform number: ``.3`` or ``-2``."""
    return F.regexp_replace(value, r"[.-]\d+$", "")


def edge_key(*parts: Column, kind: str = "") -> Column:
    """A surrogate key of an edge: its type, then SHA-256 over its ends."""
    digest = F.sha2(F.concat_ws("|", *parts), 256)
    return F.concat(F.lit(f"{kind}:"), digest) if kind else digest


def safe_key(value: Column) -> Column:
    """A document key without characters that stores reject."""
    return F.regexp_replace(F.trim(value), r"[^A-Za-z0-9_\-:.@()+,=;$!*'%]", "_")


def minted_id(prefix: str, key: Column) -> Column:
    """A stable id for a natural key: the same key always gets the same id."""
    return F.concat(F.lit(f"{prefix}:"), F.upper(F.substring(F.sha2(F.upper(F.trim(key)), 256), 1, 12)))


def ordered_pair(a: Column, b: Column) -> tuple[Column, Column]:
    """Undirected ends in canonical order."""
    return F.least(a, b), F.greatest(a, b)
