"""Write semantics of the store: first writer wins, last writer wins, fallback layers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def insert_or_ignore(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key in write order.

    ``min_by`` is pre-aggregated before the shuffle, so a key that holds a third of all
    rows is one row per task by then. Null keys are keys of their own.
    """
    rest = [c for c in df.columns if c not in keys]
    row = F.min_by(F.struct(*[F.col(f"`{c}`") for c in rest]), F.struct(*[F.col(f"`{o}`") for o in order]))
    out = df.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(row.alias("_row"))
    return out.select(*[F.col(f"`{k}`") if k in keys else F.col(f"_row.`{k}`") for k in df.columns])


def insert_or_replace(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row of each key in write order; otherwise as :func:`insert_or_ignore`."""
    rest = [c for c in df.columns if c not in keys]
    row = F.max_by(F.struct(*[F.col(f"`{c}`") for c in rest]), F.struct(*[F.col(f"`{o}`") for o in order]))
    out = df.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(row.alias("_row"))
    return out.select(*[F.col(f"`{k}`") if k in keys else F.col(f"_row.`{k}`") for k in df.columns])


def source_rank(source: Column) -> Column:
    """Priority of a source: the order in which sources are written."""
    return (
        F.when(source.startswith("wiktionary"), 0)
        .when(source.startswith("wikidata"), 1)
        .when(source == "dal", 2)
        .when(source.startswith("extra:"), 4)
        .when(source.startswith("ruwiki"), 5)
        .otherwise(3)
    )


def layer_fallback(senses: DataFrame, key: str = "lemma", source: str = "source") -> DataFrame:
    """Rows of fallback layers only where no earlier layer defines the key.

    Extra files are never fallback: their rows stay and still count as a definition for
    the layers after them. Rows with a null key are dropped, a null source is the default layer.
    """
    rank = source_rank(F.coalesce(F.col(source), F.lit("")))
    rows = senses.where(F.col(key).isNotNull()).withColumn("_rank", rank)
    first = rows.groupBy(F.col(key).alias("_key")).agg(F.min("_rank").alias("_first"))
    kept = rows.join(first, F.col(key) == F.col("_key")).where("_rank = _first or _rank = 4")
    return kept.select(*senses.columns)
