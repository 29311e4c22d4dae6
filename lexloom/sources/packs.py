"""Companion packs and extra terms."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexloom.functions import native, rules
from lexloom.sources.rejects import load_with_rejects


def read_pack(spark: SparkSession, path: str) -> DataFrame:
    """Lines of a pack file through the reject loader (see :mod:`lexloom.sources.rejects`)."""
    lines = spark.read.text(path).select(F.monotonically_increasing_id().alias("line_id"), F.col("value").alias("raw_line"))
    return load_with_rejects(lines)


def with_variants(entries: DataFrame) -> DataFrame:
    """Entries whose aliases also hold the typographic variants of the word and of each alias."""
    names = F.concat(F.array("word"), F.coalesce("aliases", F.array().cast("array<string>")))
    more = F.flatten(F.transform(names, lambda x: F.array(x)))
    out = entries.withColumn("_v", rules.list_rule("typographic_variants", F.col("word")))
    return out.withColumn("aliases", F.array_except(F.array_distinct(F.concat(more, "_v")), F.array("word"))).drop("_v")


def read_extra_json(spark: SparkSession, path: str) -> DataFrame:
    """``(word, definition, aliases)``: ``definitions`` may be a list or a string, or stand under other names."""
    text = spark.read.text(path).select("value", F.monotonically_increasing_id().alias("pos"))
    v = F.try_parse_json("value")
    one = lambda k: F.try_variant_get(v, f"$.{k}", "string")
    many = lambda k: F.try_variant_get(v, f"$.{k}", "array<string>")
    single = lambda k: F.when(one(k).isNotNull(), F.array(one(k)))
    defs = F.coalesce(many("definitions"), single("definitions"), many("glosses"), single("glosses"), single("definition"))
    rows = text.select("pos", one("word").alias("word"), F.posexplode(defs).alias("i", "definition"), many("aliases").alias("aliases"))
    return rows.where("word is not null and definition is not null")


def store_rows(entries: DataFrame, source: str) -> tuple[DataFrame, DataFrame]:
    """(senses, links) of entries: cleaned definitions, self links and alias links."""
    word = native.normalize_key(F.col("word"))
    rows = entries.select(word.alias("lemma"), rules.text_rule("clean_definition", F.col("definition")).alias("definition"), "aliases")
    rows = rows.where(native.is_lookup_key(F.col("lemma")) & (F.col("definition") != ""))
    senses = rows.select("lemma", "definition", F.lit(source).alias("source")).distinct()
    keys = F.concat(F.array("lemma"), F.coalesce("aliases", F.array().cast("array<string>")))
    links = rows.select(F.explode(keys).alias("k"), "lemma").select(native.normalize_key(F.col("k")).alias("k"), "lemma")
    links = links.where(native.is_lookup_key(F.col("k"))).select(F.explode(native.alias_candidates(F.col("k"))).alias("key"), "lemma")
    return senses, links.distinct()


def discover_extras(spark: SparkSession, folder: str) -> list[str]:
    """Paths of the extra files of a folder (``.tsv``, ``.jsonl``, ``.jsonl.gz``), sorted by name."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return []
    names = [f.getPath().toString() for f in fs.listStatus(p) if f.isFile()]
    return sorted(n for n in names if n.lower().endswith((".tsv", ".jsonl", ".jsonl.gz")))


def read_extra(spark: SparkSession, path: str) -> DataFrame:
    """``(lemma, definition, aliases, source, place)`` of an extra file, in file order; bad lines are left out."""
    name = path.rsplit("/", 1)[-1]
    if name.lower().endswith(".tsv"):
        rows = read_pack(spark, path).where("reason is null").select("word", "definition", "aliases", F.struct(F.col("line_id").alias("a"), F.lit(0).alias("b")).alias("place"))
    else:
        rows = read_extra_json(spark, path).select("word", "definition", "aliases", F.struct(F.col("pos").alias("a"), F.col("i").alias("b")).alias("place"))
    return rows.select(F.col("word").alias("lemma"), "definition", "aliases", F.lit(f"extra:{name}").alias("source"), "place")


def import_extra(store, path: str):
    """Append an extra file to a store. Aliases of a tab-separated line count only if its sense is new; others always."""
    from lexloom.operators import layers

    spark = store.senses.sparkSession
    rows = read_extra(spark, path)
    out, fresh = layers.add_senses(store, rows)
    named = rows.select(native.normalize_key(F.col("lemma")).alias("lemma"), "aliases")
    if path.lower().endswith(".tsv"):
        named = named.join(fresh.select("lemma").distinct(), "lemma", "left_semi")
    keys = named.select("lemma", F.explode(F.concat(F.array("lemma"), F.coalesce("aliases", F.array().cast("array<string>")))).alias("key"))
    return layers.add_links(out, keys)
