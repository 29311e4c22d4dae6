"""The quality pass over a store of senses and links, as set operations on snapshots.

Every lookup of the pass sees the store as it was before the pass, so the result does not
depend on the order of rows; rows that end up equal fold into one (an unchanged row first,
then the one of smallest ``seq``).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexloom.functions import cleanup_patterns as C
from lexloom.functions import native
from lexloom.operators import about as about_phrases
from lexloom.operators import aliases, cleaning, normalize, quality
from lexloom.runtime import Workspace, spread


@dataclass
class Store:
    """``senses(lemma, definition, source, seq)`` and ``links(key, lemma)``."""

    senses: DataFrame
    links: DataFrame


@dataclass
class PassResult:
    store: Store
    rescue: DataFrame  # (lemma): words whose meaning went or stayed weak
    outcomes: DataFrame  # (seq, outcome, changes) of each row that was looked at


def spellings_of(keys: DataFrame) -> DataFrame:
    """Links ``(key, lemma)`` under every spelling of the key; invalid keys give none."""
    k = keys.select(native.normalize_key(F.col("key"), composed=True).alias("key"), "lemma")
    k = k.where(native.is_lookup_key(F.col("key")) & native.is_lookup_key(F.col("lemma")))
    return k.select(F.explode(native.alias_candidates(F.col("key"))).alias("key"), "lemma").distinct()


def clean_headword(lemma: Column) -> Column:
    """A headword without the part-of-speech mark that old dictionaries put behind it."""
    return native.strip(F.regexp_replace(native.normalize_key(lemma, composed=True), "(?iu)" + C.OLD_POS_SUFFIX, ""))


def migrate_headwords(store: Store, source: str = "dal") -> tuple[Store, DataFrame]:
    """Rename marked headwords of an old dictionary; drop them where the clean headword has a meaning already.

    Links to the old headword lead to the new one, but not from marked keys. Also returns
    ``(old, new, conflict)`` for each renamed headword.
    """
    old = store.senses.where((F.col("source") == source) & F.col("lemma").isNotNull()).select("lemma").distinct()
    moves = old.select(F.col("lemma").alias("old"), clean_headword(F.col("lemma")).alias("new"))
    moves = moves.where((F.col("old") != F.col("new")) & native.is_lookup_key(F.col("new")))
    lemmas = store.senses.where("lemma is not null").select(F.col("lemma").alias("new")).distinct().withColumn("conflict", F.lit(True))
    moves = moves.join(lemmas, "new", "left").select("old", "new", F.coalesce("conflict", F.lit(False)).alias("conflict"))
    mine = F.col("source") == source
    s = store.senses.join(moves, F.col("lemma") == F.col("old"), "left")
    s = s.where(~(mine & F.coalesce("conflict", F.lit(False))) | F.col("source").isNull())
    s = s.select(F.when(mine & F.col("new").isNotNull(), F.col("new")).otherwise(F.col("lemma")).alias("lemma"), "definition", "source", "seq")
    kept = store.links.join(moves.select(F.col("old").alias("lemma")), "lemma", "left_anti").select("key", "lemma")
    moved = store.links.join(moves, F.col("lemma") == F.col("old")).where(F.col("key") != F.col("old"))
    moved = moved.where(~F.col("key").rlike("(?iu)" + C.OLD_POS_SUFFIX)).select("key", F.col("new").alias("lemma"))
    own = moves.select(F.col("new").alias("key"), F.col("new").alias("lemma"))
    links = kept.unionByName(spellings_of(moved.unionByName(own))).distinct()
    return Store(s, links), moves


def _about_keys(text: Column) -> Column:
    """Words that a short gloss ``О X`` may refer to."""
    body = native.strip_chars(native.collapse(F.regexp_extract(text, "(?iuU)" + C.ABOUT_TARGET, 1)), " .;:—–-")
    inner = F.regexp_extract(body, "(?iuU)" + C.ABOUT_CLASS, 1)
    few = (inner != "") & (F.size(F.split(inner, " ")) <= 4)
    bare = lambda c: F.regexp_replace(c, "^[ «»\"']+|[ «»\"']+$", "")
    fits = (F.length(text) <= 100) & text.rlike("(?iuU)" + C.ABOUT_TARGET) & (body != "") & ~F.lower(body).rlike(C.ABOUT_NOT_TARGET)
    return F.when(fits, F.array_compact(F.array(bare(body), F.when(few, bare(inner)))))


def semantic_pass(store: Store, workspace: Workspace) -> PassResult:
    """Normalise the candidates, turn redirects into links, drop what has no meaning, fold copies."""
    store, _ = migrate_headwords(store)
    senses = workspace.keep(store.senses.where("lemma is not null and definition is not null"), "senses")
    links = workspace.keep(store.links, "links")
    lemmas = senses.select("lemma").distinct()
    picked = spread(quality.semantic_candidates(senses).select("seq", "lemma", "definition", "source"))
    norm = workspace.keep(normalize.normalize(picked), "normalized")
    phrases = workspace.keep(about_phrases.rewrite(norm.where("source like 'wiktionary%'"), links, lemmas), "phrases")
    changes = F.when(F.col("rewritten").isNotNull(), F.array_distinct(F.array_append("changes", F.lit("about_fragment_rewritten")))).otherwise(F.col("changes"))
    norm = norm.join(phrases, "seq", "left").select("seq", "lemma", "definition", "source", F.coalesce("rewritten", "text").alias("text"), changes.alias("changes"))

    src = F.coalesce("source", F.lit(""))
    shown = F.coalesce(F.nullif("text", F.lit("")), "definition")
    several = senses.groupBy("lemma").agg(F.count(F.lit(1)).alias("n_senses"))
    old = norm.select("*", quality.old_equivalence(quality.headword(F.col("lemma")), shown, src).alias("old"))
    formula = aliases.formula(F.col("text"))
    bare = F.regexp_extract("text", "(?iu)" + C.HISTORICAL_BARE, 1)
    is_bare = src.rlike(r"^wiktionary:(?:cu|orv|ru-old)") & (bare != "") & (native.casefold(bare) != native.casefold(F.col("lemma")))
    historical = F.struct(F.lit("historical-bare").alias("kind"), F.array(bare).alias("candidates"), F.lit("").alias("tail"), bare.alias("body"))
    rows = old.join(several, "lemma", "left").select(
        "seq", "lemma", "definition", "source", "text", "changes", "old", "n_senses",
        F.when(src.startswith("wiktionary"), _about_keys(F.col("text"))).alias("about"),
        F.when(F.col("text") != "", F.coalesce(formula, F.when(is_bare, historical))).alias("parsed"),
    )
    rows = workspace.keep(rows, "rows")

    keys = rows.where("about is not null").select("seq", "lemma", F.explode("about").alias("k"))
    keys = keys.select("seq", "lemma", native.normalize_key(F.col("k"), composed=True).alias("k")).where(native.is_lookup_key(F.col("k")))
    about = workspace.keep(aliases.lookup(keys, links, lemmas), "about")
    redirect = workspace.keep(aliases.resolve(rows.where("parsed is not null"), "parsed", links, lemmas), "redirect")

    hits = lambda d, n: d.groupBy("seq").agg(F.count(F.lit(1)).alias(n))
    j = rows.join(hits(about, "n_about"), "seq", "left").join(hits(redirect, "n_redirect"), "seq", "left")
    told = F.when(F.col("parsed").isNotNull(), aliases.fallback(F.col("parsed")))
    j = j.select("*", told.alias("told"))
    j = cleaning.with_clean(j, "told", "told_clean", markup=False)
    j = j.select("*", normalize.without_edge_quote(normalize.without_residue(F.col("told_clean"))).alias("told_bare"))
    final = F.when(F.col("told").isNotNull() & (F.col("told") != F.col("text")), F.when(quality.edge_quote(F.col("told_clean")), F.col("told_bare")).otherwise(normalize.without_residue(F.col("told_clean")))).otherwise(F.col("text"))
    outcome = (
        F.when(F.col("old") & (F.col("n_senses") > 1), "old_equivalence_duplicate")
        .when((F.col("text") != "") & F.col("n_about").isNotNull(), "about_alias")
        .when(F.col("n_redirect").isNotNull(), "textual_alias")
        .when(F.col("final") == "", "removed")
        .when(F.col("final") != F.col("definition"), "rewritten")
        .otherwise("kept")
    )
    done = workspace.keep(j.select("*", final.alias("final")).select("*", outcome.alias("outcome")).drop("told", "told_clean", "told_bare"), "done")

    gone = done.where(F.col("outcome").isin("old_equivalence_duplicate", "about_alias", "textual_alias", "removed")).select("seq")
    new = done.where("outcome = 'rewritten'").select("seq", F.col("final").alias("_new"))
    after = senses.join(gone, "seq", "left_anti").join(new, "seq", "left")
    after = after.select("lemma", F.coalesce("_new", "definition").alias("definition"), "source", "seq", F.col("_new").isNotNull().alias("_changed"))
    from lexloom.operators.dedupe import insert_or_ignore

    after = workspace.keep(insert_or_ignore(after, ["lemma", "definition"], ["_changed", "seq"]), "after")
    folded = done.where("outcome = 'rewritten'").join(after.select("seq"), "seq", "left_anti").select("seq").withColumn("_f", F.lit(True))
    outcomes = done.join(folded, "seq", "left").select("seq", F.when(F.col("_f"), "duplicate").otherwise(F.col("outcome")).alias("outcome"), "changes")

    linked = done.where("outcome in ('about_alias', 'textual_alias')").select("seq", "lemma", "outcome")
    more = linked.where("outcome = 'about_alias'").join(about, "seq").unionByName(linked.where("outcome = 'textual_alias'").join(redirect, "seq"))
    links = links.unionByName(spellings_of(more.select(F.col("lemma").alias("key"), F.col("target").alias("lemma")))).distinct()

    ours = F.coalesce("source", F.lit("")).rlike("^(?:wiktionary:|wikidata)")
    emptied = done.where(ours & (F.col("outcome") == "removed")).select("lemma")
    held = done.where(F.col("old") & (F.col("outcome") != "old_equivalence_duplicate")).select("lemma")
    left = done.where(ours & F.col("outcome").isin("kept", "rewritten")).select("seq", "lemma", F.col("final").alias("definition"), "source")
    weak = native.keep_rows(quality.with_flags(left), F.arrays_overlap("flags", F.array(*map(F.lit, C.WEAK_FLAGS)))).select("lemma")
    rescue = workspace.keep(emptied.unionByName(held).unionByName(weak).distinct(), "rescue")
    return PassResult(Store(after.drop("_changed"), links), rescue, outcomes)


def pass_statistics(result: PassResult) -> DataFrame:
    """``(name, n)``: how many rows had each outcome and each change."""
    o = result.outcomes
    return o.groupBy(F.col("outcome").alias("name")).agg(F.count(F.lit(1)).alias("n")).unionByName(
        native.unnest(o, F.col("changes"), "name").groupBy("name").agg(F.count(F.lit(1)).alias("n"))
    )


#: Warnings that make a single sense replaceable.
REPLACEABLE = (
    "very_short", "vague", "early_self_reference", "leading_parenthetical", "old_equivalence_placeholder", "url_residue", "broken_fragment",
)


def upgrade(store: Store, candidates: DataFrame, workspace: Workspace, source: str = "ruwiki-quality") -> tuple[Store, DataFrame]:
    """Replace weak single senses by clearly better candidates ``(key, definition)``.

    A key must lead to exactly one lemma with exactly one sense, of an open dictionary, with a
    warning; the candidate must score at least 78 and 12 more. Of several candidates for a
    sense the best wins, then the last in byte order. Also returns ``(seq, definition)`` of what changed.
    """
    lemmas = store.senses.where("definition is not null and lemma is not null").select("lemma").distinct()
    c = candidates.where("key is not null and definition <> ''").select(F.xxhash64("key", "definition").alias("seq"), F.col("key").alias("lemma"), "definition")
    keys = c.select("seq", F.lit("").alias("lemma"), native.normalize_key(F.col("lemma"), composed=True).alias("k")).where(native.is_lookup_key(F.col("k")))
    reach = aliases.lookup(keys, store.links, lemmas)
    single = reach.groupBy("seq").agg(F.count(F.lit(1)).alias("n"), F.min("target").alias("target")).where("n = 1")
    one = store.senses.where("definition is not null").groupBy("lemma").agg(
        F.count(F.lit(1)).alias("n"), F.min("seq").alias("old_seq"), F.min("definition").alias("old"), F.min("source").alias("old_source")
    ).where("n = 1 and (old_source like 'wiktionary:%' or old_source like 'wikidata%')")
    pairs = c.select("seq", "definition").join(single.select("seq", "target"), "seq").join(one, F.col("target") == F.col("lemma"))
    pairs = workspace.keep(pairs.select("old_seq", "lemma", "definition", "old", "old_source"), "pairs")
    old = pairs.select(F.col("old_seq").alias("seq"), "lemma", F.col("old").alias("definition"), F.col("old_source").alias("source")).distinct()
    old = quality.score(quality.with_flags(old)).select(F.col("seq").alias("old_seq"), F.col("score").alias("old_score"), "flags")
    # scores are written before they are joined: the optimizer would carry all tests through the joins
    weak = workspace.keep(native.keep_rows(old, F.arrays_overlap("flags", F.array(*map(F.lit, REPLACEABLE)))).drop("flags"), "weak")
    new = quality.score(quality.with_flags(pairs.select(F.col("old_seq").alias("seq"), "lemma", "definition", F.lit(source).alias("source"))))
    new = workspace.keep(new.select(F.col("seq").alias("old_seq"), F.col("text").alias("definition"), "score"), "scored")
    better = new.join(weak, "old_seq").where("score >= old_score + 12 and score >= 78")
    best = better.groupBy(F.col("old_seq").alias("seq")).agg(F.max_by("definition", F.struct("score", "definition")).alias("_new"))
    best = workspace.keep(best, "upgrades")
    s = store.senses.join(best, "seq", "left").select(
        "lemma", F.coalesce("_new", "definition").alias("definition"), F.when(F.col("_new").isNotNull(), F.lit(source)).otherwise(F.col("source")).alias("source"), "seq"
    )
    return Store(s, store.links), best.withColumnRenamed("_new", "definition")


def rescue(store: Store, wanted: DataFrame, pages: DataFrame, workspace: Workspace) -> Store:
    """Meanings for ``wanted(lemma)`` from encyclopedia leads ``pages(title, base_title, definition)``.

    A defined word may be upgraded by a page of its title or base title; an undefined one gets
    a sense only from a page of exactly its title whose text scores 70 or more.
    """
    pages = workspace.keep(pages.select("title", "base_title", "definition"), "pages")  # read twice, and joined
    wanted = wanted.select(F.col("lemma").alias("target")).distinct()
    exact = pages.join(wanted, F.col("title") == F.col("target"))
    base = pages.join(wanted, F.col("base_title") == F.col("target")).join(wanted.select(F.col("target").alias("_t")), F.col("title") == F.col("_t"), "left_anti")
    rows = exact.unionByName(base).select(F.xxhash64("title", "target").alias("seq"), F.col("title").alias("lemma"), "definition", F.lit("ruwiki-quality").alias("source"), "target")
    rows = workspace.keep(rows, "matches")
    norm = workspace.keep(native.keep_rows(normalize.normalize(spread(rows)), F.col("text") != ""), "candidates")
    keys = norm.select("seq", F.lit("").alias("lemma"), F.col("target").alias("k"))
    lemmas = store.senses.where("definition is not null and lemma is not null").select("lemma").distinct()
    known = aliases.lookup(keys, store.links, lemmas).select("seq").distinct()
    upgraded, _ = upgrade(store, norm.join(known, "seq", "left_semi").select(F.col("target").alias("key"), F.col("text").alias("definition")), workspace)
    fresh = workspace.keep(norm.join(known, "seq", "left_anti").where("lemma = target"), "fresh")
    scored = quality.score(quality.with_flags(fresh.select("seq", F.col("target").alias("lemma"), F.col("text").alias("definition"), F.lit("ruwiki-rescue").alias("source"))))
    bad = F.array(*map(F.lit, ("grammar_residue", "markup_residue", "placeholder_definition", "fragment")))
    good = native.keep_rows(scored, (F.col("score") >= 70) & ~F.arrays_overlap("flags", bad))
    # one page has one title, but titles may be delivered twice
    added = workspace.keep(good.groupBy("lemma").agg(F.max("text").alias("definition")), "rescued")
    top = upgraded.senses.agg(F.coalesce(F.max("seq"), F.lit(0)).alias("m"))
    from lexloom.operators.articles import with_offsets

    numbered = with_offsets(added, "lemma", F.lit(1).cast("long"))
    extra = numbered.select("lemma", "definition", F.lit("ruwiki-rescue").alias("source"), (top.scalar() + F.col("offset") + 1).alias("seq"))
    own = spellings_of(added.select(F.col("lemma").alias("key"), "lemma"))
    return Store(upgraded.senses.unionByName(extra), upgraded.links.unionByName(own).distinct())
