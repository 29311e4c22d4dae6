"""Streaming variants: token counts of arriving documents, first-writer dedupe of arriving senses."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexloom.functions import native


def token_windows(docs: DataFrame, time: str = "loaded_at", late: str = "1 day", width: str = "1 day") -> DataFrame:
    """``(start, normalized, n)`` per event-time window; documents later than ``late`` are left out.

    Works on a streaming and on a batch DataFrame; rows without a time are in no window.
    """
    t = docs.where(F.col(time).isNotNull()).withColumn("_t", F.col(time).cast("timestamp")).withWatermark("_t", late)
    words = t.select("_t", F.explode(native.tokens(F.col("text"))).alias("token"))
    norm = native.normalize_lookup(F.col("token"), composed=True)
    g = words.groupBy(F.window("_t", width), norm.alias("normalized")).agg(F.count(F.lit(1)).alias("n"))
    return g.select(F.col("window.start").alias("start"), "normalized", "n")


def first_senses(senses: DataFrame, time: str = "loaded_at", late: str = "1 day") -> DataFrame:
    """Each (lemma, definition) once within the watermark; state older than ``late`` is dropped."""
    t = senses.where(F.col(time).isNotNull()).withColumn("_t", F.col(time).cast("timestamp")).withWatermark("_t", late)
    return t.dropDuplicatesWithinWatermark(["lemma", "definition"]).drop("_t")
