"""Articles: grouping of senses, numbering, and byte offsets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexloom.functions import native


def fingerprint(definition: Column) -> Column:
    """What makes two definitions of an article the same: case, blanks and edge punctuation are ignored."""
    return F.regexp_replace(native.collapse(native.casefold(definition)), r"^[ .;,:\x{2014}-]+|[ .;,:\x{2014}-]+$", "")


def build_articles(senses: DataFrame) -> DataFrame:
    """``(lemma, article)``: distinct definitions in ``seq`` order, numbered if several.

    Rows without lemma or text are left out; copies fold before the grouping shuffle.
    """
    d = native.collapse(F.col("definition"))
    rows = senses.where("lemma is not null and seq is not null").select("lemma", "seq", d.alias("d")).where("d <> ''")
    first = rows.groupBy("lemma", fingerprint(F.col("d")).alias("fp")).agg(F.min(F.struct("seq", "d")).alias("s"))
    texts = F.transform(F.sort_array(F.collect_list("s")), lambda s: s["d"])
    numbered = F.array_join(F.transform("t", lambda x, i: F.concat((i + 1).cast("string"), F.lit(". "), x)), "\n")
    out = first.groupBy("lemma").agg(texts.alias("t"))
    return out.select("lemma", F.when(F.size("t") == 1, F.col("t")[0]).otherwise(numbered).alias("article"))


def split_article(article: Column) -> Column:
    """The definitions of an article body, without their numbers."""
    lines = F.filter(F.transform(F.split(article, "\n"), F.trim), lambda x: x != "")
    numbered = (F.size(lines) > 1) & F.forall(lines, lambda x: x.rlike(r"^\d+\.\s+"))
    plain = F.when(F.trim(article) != "", F.array(article)).otherwise(F.array().cast("array<string>"))
    return F.when(numbered, F.transform(lines, lambda x: F.regexp_replace(x, r"^\d+\.\s+", ""))).otherwise(plain)


def with_offsets(bodies: DataFrame, order: str, size: Column, partitions: int | None = None) -> DataFrame:
    """``bodies`` plus ``size`` and ``offset``, the exclusive prefix sum of sizes in ``order``.

    Two levels: range partitions are summed, the sums (one row per partition) are prefixed,
    and each partition runs its own window, so no task ever holds the whole order. The
    range bounds are found once: the partition number is the one that the sums use.
    """
    n = partitions or int(bodies.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = bodies.withColumn("size", size).repartitionByRange(n, order).withColumn("_part", F.spark_partition_id())
    from lexloom.runtime import Workspace

    ranged = Workspace(bodies.sparkSession, "offsets").keep(ranged, "ranged")
    sums = ranged.groupBy("_part").agg(F.sum("size").alias("s"))
    bases = sums.select(
        F.col("_part").alias("_p"),
        (F.sum("s").over(Window.orderBy("_part")) - F.col("s")).alias("_base"),  # one row per partition
    )
    inside = F.sum("size").over(Window.partitionBy("_part").orderBy(order)) - F.col("size")
    out = ranged.join(F.broadcast(bases), F.col("_part") == F.col("_p"))
    return out.withColumn("offset", F.col("_base") + inside).drop("_part", "_p", "_base")
