"""Surrogate keys and output-layer names."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed value: what the usual surrogate-key macro hashes in place of a missing part.
NULL_MARK = "_dbt_utils_surrogate_key_null_"

# Schema each model layer is written to.
LAYER_SCHEMAS = {
    "staging": "STAGING",
    "intermediate": "STAGING",
    "marts": "MARTS",
    "snapshots": "SNAPSHOTS",
}


def surrogate_key(*names: str) -> Column:
    """MD5 over the text of the named columns."""
    parts = [F.coalesce(F.col(name).cast("string"), F.lit(NULL_MARK)) for name in names]
    return F.md5(F.concat_ws("-", *parts))


def schema_name(custom: str | None, default: str) -> str:
    """A custom schema name is used as it stands; without one the target's default applies."""
    return default if custom is None else custom.strip()
