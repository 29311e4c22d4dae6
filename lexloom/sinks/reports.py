"""Reports of a build: quality tables, statistics, pack bundles with their manifest, candidate lists."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexloom.functions import native
from lexloom.operators import quality
from lexloom.runtime import Workspace
from lexloom.sinks import stardict

#: Titles of the companion packs by slug.
PACK_TITLES = {
    "russian_archaic": "Russian archaic words", "russian_literary": "Russian literary words", "french_phrases": "French phrases",
    "german_phrases": "German phrases", "latin_classical": "Latin phrases", "names": "Names",
}


def one_line(c: Column) -> Column:
    """A value for a tab-separated file: tabs and line breaks become blanks."""
    return F.trim(F.regexp_replace(F.coalesce(c.cast("string"), F.lit("")), r"[\t\r\n]+", " "))


def write_tsv(df: DataFrame, path: str) -> None:
    """A folder of tab-separated part files, each with a header; written by the executors."""
    df.select(*[one_line(F.col(f"`{c}`")).alias(c) for c in df.columns]).write.mode("overwrite").option("sep", "\t").option("header", True).option(
        "quote", ""
    ).csv(path)


def write_json(spark: SparkSession, value: dict, path: str) -> None:
    """A small JSON file (settings, totals)."""
    stardict._write_text(spark, path, json.dumps(value, ensure_ascii=False, indent=2, sort_keys=True) + "\n")


def quality_report(senses: DataFrame, folder: str, workspace: Workspace) -> dict:
    """Score all senses once and write ``report.json`` and the tables ``examples``, ``review`` and ``informational``.

    Only totals (buckets, flags, sources: few rows each by nature) come to the driver; the
    sources of a build are few, so their table is written beside the others as well.
    """
    spark = senses.sparkSession
    scored = workspace.keep(quality.score(quality.with_flags(senses)), "scored")
    by_source = scored.groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("score"), 2).alias("average"))
    report = {
        "totals": quality.totals(scored).first().asDict(),
        "buckets": {r["bucket"]: [r["n"], r["average"]] for r in quality.score_buckets(scored).collect()},
        "flags": {r["flag"]: r["n"] for r in quality.warning_counts(scored).collect()},
    }
    write_json(spark, report, f"{folder}/report.json")
    write_tsv(by_source, f"{folder}/sources")
    write_tsv(quality.flag_examples(scored), f"{folder}/examples")
    write_tsv(quality.review_queue(scored), f"{folder}/review")
    write_tsv(quality.informational_examples(scored), f"{folder}/informational")
    return report


def build_info(spark: SparkSession, folder: str, sources: list[str], statistics: dict, retired: tuple[str, ...] = ()) -> dict:
    """``BUILD_INFO.json`` and ``BUILD_STATS.json``; labels of retired sources are left out."""
    info = {"sources": sorted({s for s in sources if s and s not in retired})}
    write_json(spark, info, f"{folder}/BUILD_INFO.json")
    write_json(spark, statistics, f"{folder}/BUILD_STATS.json")
    return info


def pack_slug(name: Column) -> Column:
    """File name of a pack: folded case, blanks and hyphens as underscores."""
    return F.regexp_replace(native.casefold(native.strip(name)), r"[\s-]+", "_")


def pack_title(slug: str) -> str:
    return PACK_TITLES.get(slug, slug.replace("_", " ").capitalize())


def write_packs(entries: DataFrame, folder: str, workspace: Workspace) -> dict:
    """One bundle and ``PACK_INFO.json`` per pack of ``entries(word, definition, aliases, pack)``, and ``PACKS_MANIFEST.json``.

    The packs are few (they are products, listed by name); each is built by the executors.
    Entries without a pack are left out.
    """
    from lexloom.sources import packs

    spark = entries.sparkSession
    rows = workspace.keep(entries.where("pack is not null and word is not null").withColumn("slug", pack_slug(F.col("pack"))), "entries")
    manifest = {}
    for slug in sorted(r["slug"] for r in rows.select("slug").distinct().collect()):
        mine = packs.with_variants(rows.where(F.col("slug") == slug))
        senses, links = packs.store_rows(mine, f"pack:{slug}")
        senses = workspace.keep(senses.withColumn("seq", F.xxhash64("lemma", "definition")), f"senses-{slug}")
        bodies, index = stardict.index_records(senses, links, None, workspace)
        base = f"{folder}/{slug}/{slug}"
        info = {"slug": slug, "title": pack_title(slug), "entries": senses.count()} | stardict.write_bundle(bodies, index, base, pack_title(slug))
        write_json(spark, info, f"{folder}/{slug}/PACK_INFO.json")
        manifest[slug] = info
    write_json(spark, manifest, f"{folder}/PACKS_MANIFEST.json")
    return manifest


def candidate_table(groups: DataFrame) -> DataFrame:
    """Columns of the candidates file, best rank first in each part (see :func:`lexloom.operators.coverage.oov_groups`)."""
    return groups.select("rank", "candidate_key", "category", "action", "total", "share_percent", "forms").repartitionByRange("rank").sortWithinPartitions("rank")
