"""Dead letters: invalid or unparsable records with reason and time."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulselake.config import Config, instant
from pulselake.functions.quality import ingress_error
from pulselake.operators.bronze import DEVICE_FIELDS, extract

CONTEXT = ["topic", "partition", "offset"]


def to_dead_letter(
    df: DataFrame, reason: Column, payload: Column, as_of: datetime | str | None = None
) -> DataFrame:
    """Records with a reason, as dead letters; source position columns are carried if present."""
    context = [c for c in CONTEXT if c in df.columns]
    return (
        df.withColumn("_error", reason)
        .where(F.col("_error").isNotNull())
        .select(
            payload.alias("original_payload"),
            F.col("_error").alias("error"),
            instant(as_of).alias("failed_at"),
            *context,
        )
    )


def with_error(envelope: DataFrame, cfg: Config = Config()) -> DataFrame:
    """Topic records with parsed ``payload`` and ``error`` (NULL when the record is valid).

    The generator keeps a later filter on ``error`` above the parse step; pushed below it, the
    filter would parse the JSON again for every field it names.
    """
    parsed = envelope.select("*", F.explode(F.array(F.try_parse_json("value"))).alias("payload"))
    fields = parsed.select("*", *extract("payload", DEVICE_FIELDS))
    malformed = F.when(
        F.col("value").isNotNull() & F.col("payload").isNull(), F.lit("Malformed JSON")
    )
    return fields.withColumn(
        "error", F.coalesce(malformed, ingress_error(cfg, F.col("payload")))
    ).select(*envelope.columns, "payload", "error")


def split_dead_letters(
    envelope: DataFrame, cfg: Config = Config(), as_of: datetime | str | None = None
) -> tuple[DataFrame, DataFrame]:
    """Valid topic records and the dead letters of the rest."""
    checked = with_error(envelope, cfg)
    valid = checked.where(F.col("error").isNull()).drop("payload", "error")
    return valid, to_dead_letter(checked, F.col("error"), F.col("value"), as_of)
