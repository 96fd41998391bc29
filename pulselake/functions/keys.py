"""Surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Stand-in for NULL parts and the text format of timestamps inside keys.
NULL_PART = "<null>"
TIMESTAMP_PART = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def key_text(moment: Column) -> Column:
    return F.date_format(moment, TIMESTAMP_PART)


def surrogate_key(*parts: Column) -> Column:
    """md5 over the parts joined by '-'; NULL parts count as a fixed text."""
    return F.md5(F.concat_ws("-", *(F.coalesce(p.cast("string"), F.lit(NULL_PART)) for p in parts)))
