"""The alias graph: closure over undefined targets, pruning, lookups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexloom.runtime import Workspace


def clean_edges(links: DataFrame) -> DataFrame:
    """Distinct edges with two non-empty sides."""
    e = links.select(F.col("key").cast("string").alias("key"), F.col("lemma").cast("string").alias("lemma"))
    return e.where("key <> '' and lemma <> ''").distinct()


def defined_lemmas(senses: DataFrame) -> DataFrame:
    return senses.where("lemma is not null and definition is not null").select("lemma").distinct()


def resolve_aliases(edges: DataFrame, defined: DataFrame, workspace: Workspace) -> DataFrame:
    """``(key, lemma)``: every defined lemma a key leads to, directly or through undefined targets only.

    Paths double each round: ``hops`` holds the pairs joined by exactly 2^k steps over
    undefined targets, ``found`` what is reached in fewer steps. A round that finds nothing
    new has found everything (a longer shortest path would have a tail that is new), so the
    loop ends at the fixpoint, in cycles too, and a chain of n links never makes more than n
    hops a round. A popular defined lemma takes no part in the joins over targets.
    """
    marks = defined.select("lemma").distinct().withColumn("_d", F.lit(True))
    flagged = workspace.keep(edges.join(marks, "lemma", "left").select("key", "lemma", F.coalesce("_d", F.lit(False)).alias("_d")), "flagged")
    parts = [flagged.where("_d").select("key", "lemma")]
    sources = edges.select(F.col("key").alias("lemma")).distinct()
    hops = workspace.keep(flagged.where("not _d").select("key", "lemma").join(sources, "lemma", "left_semi").select("key", "lemma"), "hops")
    n = 0
    while True:
        found = parts[0]
        for p in parts[1:]:
            found = found.unionByName(p)
        step = hops.select("key", F.col("lemma").alias("via"))
        ends = found.select(F.col("key").alias("via"), "lemma")
        fresh = step.join(ends, "via").select("key", "lemma").distinct().join(found, ["key", "lemma"], "left_anti")
        fresh = workspace.keep(fresh, f"found{n}")
        if fresh.isEmpty():
            workspace.drop(fresh, hops)
            return found
        parts.append(fresh)
        further = step.join(hops.select(F.col("key").alias("via"), "lemma"), "via").select("key", "lemma").distinct()
        last, hops = hops, workspace.keep(further, f"hops{n}")
        workspace.drop(last)
        n += 1


def resolution_counts(edges: DataFrame, defined: DataFrame, resolved: DataFrame) -> DataFrame:
    """One row: edges that were added by following undefined targets, and edges that were dropped."""
    kept = prune_dangling(edges, defined)
    counts = [d.agg(F.count(F.lit(1)).alias(n)) for d, n in ((resolved, "r"), (kept, "k"), (edges, "e"))]
    r, k, e = (c.scalar() for c in counts)
    return edges.sparkSession.range(1).select((r - k).alias("propagated"), (e - k).alias("removed"))


def prune_dangling(edges: DataFrame, defined: DataFrame) -> DataFrame:
    """Edges whose target has a definition."""
    return edges.join(defined, "lemma", "left_semi").select("key", "lemma")


def ambiguous_keys(edges: DataFrame) -> DataFrame:
    """Keys with several lemmas: ``(key, n_lemmas, lemmas)``, lemmas sorted."""
    g = edges.groupBy("key").agg(F.count(F.lit(1)).alias("n_lemmas"), F.sort_array(F.collect_set("lemma")).alias("ls"))
    return g.where("n_lemmas > 1").select("key", "n_lemmas", F.array_join("ls", "|").alias("lemmas"))


def resolve_keys(edges: DataFrame, senses: DataFrame) -> DataFrame:
    """``(key, n_definitions)`` over all lemmas that a key leads to."""
    per = senses.where("lemma is not null and definition is not null").groupBy("lemma").agg(F.count(F.lit(1)).alias("n"))
    return edges.join(per, "lemma").groupBy("key").agg(F.sum("n").alias("n_definitions"))


def merge_overrides(edges: DataFrame, overrides: DataFrame) -> DataFrame:
    """Index entries ``(key, kind, body)``: an override suppresses the key's link group."""
    groups = edges.groupBy("key").agg(F.array_join(F.sort_array(F.collect_set("lemma")), "|").alias("body"))
    kept = groups.join(overrides.select("key"), "key", "left_anti")
    return kept.select("key", F.lit("links").alias("kind"), "body").unionByName(
        overrides.select("key", F.lit("override").alias("kind"), F.col("definition").alias("body"))
    )
