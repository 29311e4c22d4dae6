"""Composed builds: a dictionary bundle from a store, and coverage reports of books."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexloom.functions import native
from lexloom.operators import cleaning, coverage, dedupe, forms, graph, semantic
from lexloom.runtime import Workspace, spread
from lexloom.sinks import stardict
from lexloom.sources import packs


def build_dictionary(
    spark: SparkSession, senses: DataFrame, links: DataFrame, hints: DataFrame, base: str, title: str,
    extras: str | None = None, quality: bool = False, strict: bool = False,
) -> dict[str, int]:
    """Clean, dedupe, append extras, run the quality pass, resolve aliases, derive forms, write and validate a bundle."""
    ws = Workspace(spark, "build")
    clean = cleaning.with_clean(spread(senses.where("lemma is not null").select("lemma", "definition", "source", "seq")), "definition", "text")
    clean = native.keep_rows(clean, F.col("text") != "").select("lemma", F.col("text").alias("definition"), "source", "seq")
    store = semantic.Store(ws.keep(dedupe.insert_or_ignore(clean, ["lemma", "definition"], ["seq"]), "senses"), graph.clean_edges(links))
    for path in packs.discover_extras(spark, extras) if extras else ():
        out = packs.import_extra(store, path)
        store = semantic.Store(ws.keep(out.senses, "extra"), ws.keep(out.links, "extra_links"))
    if quality:
        store = semantic.semantic_pass(store, ws).store
    defined = ws.keep(graph.defined_lemmas(store.senses), "defined")
    self_links = defined.select(F.col("lemma").alias("key"), "lemma")
    edges = store.links.unionByName(self_links).distinct()
    edges = ws.keep(graph.resolve_aliases(edges, defined, ws), "links")
    overrides = ws.keep(forms.derive_overrides(hints, store.senses, edges).select("key", "definition"), "overrides")
    bodies, index = stardict.index_records(store.senses, edges, overrides, ws)
    return stardict.write_bundle(bodies, index, base, title) | stardict.validate(spark, base, strict)


def coverage_of(docs: DataFrame, keys: DataFrame, column: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(report, per text, classified unknown tokens) of texts against keys."""
    ws, known = Workspace(docs.sparkSession, "coverage"), coverage.known_keys(keys, column)
    corpus = coverage.token_counts(docs, known, ws, per_doc=False)
    by_file = coverage.coverage_by_file(coverage.token_counts(docs, known, ws))
    unknown = coverage.classify(coverage.unknown_tokens(corpus), coverage.variants(docs))
    return coverage.coverage_report(corpus), by_file, unknown


def review_of(docs: DataFrame, keys: DataFrame, column: str, core: DataFrame | None = None, morphology=None) -> DataFrame:
    """Candidates for the dictionary: unknown tokens of texts, classified, grouped and ranked, with the texts they occur in."""
    ws, known = Workspace(docs.sparkSession, "review"), coverage.known_keys(keys, column)
    per_doc = ws.keep(coverage.unknown_tokens(coverage.token_counts(docs, known, ws)), "per_doc")
    corpus = coverage.unknown_tokens(coverage.token_counts(docs, known, ws, per_doc=False))
    classified = ws.keep(coverage.classify(corpus, coverage.variants(docs), core, morphology), "classified")
    return coverage.oov_groups(classified, per_doc)
