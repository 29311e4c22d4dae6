"""Layers of a store: each source is written after the ones before it, and may only fill gaps."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexloom.functions import native
from lexloom.functions import wiki_patterns as W
from lexloom.operators import cleaning
from lexloom.operators.dedupe import insert_or_ignore
from lexloom.operators.semantic import Store, spellings_of

#: Part-of-speech and language marks at the beginning of old dictionary articles.
OLD_MARKS = (
    "м ж ср об мн ед гл прил нареч мест предл союз част межд прич деепр франц нем лат греч англ итал исп польск татар тур "
    "араб перс голл церк слав стар древн монг фин швед норв"
).split()
_OLD_MARKS = rf"(?iu)^(?:\s*(?:{'|'.join(OLD_MARKS)})\.\s*[,;:]?)+\s*"


def probes(key: Column) -> Column:
    """Spellings under which a key counts as defined: itself, folded, folded with ё as е, folded without stress."""
    k = native.normalize_key(key, composed=True)
    low = native.casefold(k)
    return F.array_distinct(F.array(k, low, F.translate(low, "ё", "е"), native.casefold(native.strip_stress(k))))


def defined_keys(store: Store) -> DataFrame:
    """``(key)``: keys that lead to a lemma with a meaning."""
    lemmas = store.senses.where("lemma is not null and definition is not null").select("lemma").distinct()
    return store.links.join(lemmas, "lemma", "left_semi").select("key").distinct()


def is_defined(rows: DataFrame, store: Store, column: str = "lemma") -> DataFrame:
    """``rows`` plus ``defined``: whether any probe of the column leads to a meaning."""
    r = rows.withColumn("_id", F.xxhash64(F.col(column))).withColumn("_p", probes(F.col(column)))
    hit = r.select(F.col(column).alias("_k"), F.explode("_p").alias("key")).distinct().join(defined_keys(store), "key", "left_semi")
    hit = hit.select("_k").distinct().withColumn("_d", F.lit(True))
    return r.join(hit, F.col(column) == F.col("_k"), "left").withColumn("defined", F.coalesce("_d", F.lit(False))).drop("_id", "_p", "_k", "_d")


def add_senses(store: Store, rows: DataFrame, fallback: bool = False) -> tuple[Store, DataFrame]:
    """Write ``rows(lemma, definition, source, place)`` after the store; ``place`` orders them.

    Lemmas are normalised and checked, definitions cleaned, empty ones left out. With
    ``fallback`` only lemmas without a meaning are filled, each by its first row in order.
    Returns the store and the rows that were newly inserted (``lemma, definition, source, seq``).
    """
    r = rows.select(native.normalize_key(F.col("lemma")).alias("lemma"), "definition", "source", "place").where(native.is_lookup_key(F.col("lemma")))
    r = native.keep_rows(cleaning.with_clean(r, "definition", "text"), F.col("text") != "").select("lemma", F.col("text").alias("definition"), "source", "place")
    if fallback:
        have = store.senses.where("lemma is not null and definition is not null").select("lemma").distinct()
        r = insert_or_ignore(r.join(have, "lemma", "left_anti"), ["lemma"], ["place"])
    r = insert_or_ignore(r, ["lemma", "definition"], ["place"])
    r = r.join(store.senses.select("lemma", "definition"), ["lemma", "definition"], "left_anti")
    top = store.senses.agg(F.coalesce(F.max("seq"), F.lit(0)).alias("m"))
    from lexloom.operators.articles import with_offsets

    numbered = with_offsets(r.withColumn("_o", F.struct("place", "lemma", "definition")), "_o", F.lit(1).cast("long"))
    fresh = numbered.select("lemma", "definition", "source", (top.scalar() + F.col("offset") + 1).alias("seq"))
    return Store(store.senses.select("lemma", "definition", "source", "seq").unionByName(fresh), store.links), fresh


def add_links(store: Store, keys: DataFrame) -> Store:
    """Links ``(key, lemma)`` under all spellings of the key."""
    return Store(store.senses, store.links.unionByName(spellings_of(keys.select("key", "lemma"))).distinct())


# --- old dictionaries ------------------------------------------------------------------


def old_article_text(word: Column, article: Column, old: bool) -> Column:
    """An article of an old dictionary without its headword, marks and (``old``) examples, at most about 1400 characters."""
    t = native.strip(F.regexp_replace(F.regexp_replace(F.translate(article, "\0\r", " \n"), "[\t ]+", " "), r"\s*\n+\s*", " "))
    head = native.normalize_key(word, composed=True)
    rest = F.substring(t, F.length(head) + 1, F.length(t))
    begins = (head != "") & (F.lower(F.substring(t, F.lit(1), F.length(head))) == F.lower(head)) & rest.rlike(r"^\s*[,.;:—-]+")
    t = F.when(begins, F.regexp_replace(rest, r"^\s*[,.;:—-]+\s*", "")).otherwise(t)
    for _ in range(3):  # labels and marks stand in turns
        t = cleaning.without_labels(F.regexp_replace(cleaning.without_labels(t), _OLD_MARKS, ""))
    if not old:
        return t
    t = F.substring_index(t, "||", 1)
    t = F.rtrim(F.split(t, "[◆♦]", 2)[0])

    def cut(r: Column) -> Column:
        window = F.substring(r["t"], 1, 1400)
        at = F.length(window) - F.least(*[F.when(F.instr(F.reverse(window), c) > 0, F.instr(F.reverse(window), c)).otherwise(10**9) for c in (";", ".")]) + 1
        return F.when(F.length(r["t"]) <= 1400, r["t"]).otherwise(F.substring(r["t"], F.lit(1), F.when(at > 450, at).otherwise(F.lit(1400))))

    return native.bind({"t": t}, cut)


def import_dictionary(store: Store, entries: DataFrame, synonyms: DataFrame, source: str, old: bool = False, fallback: bool = True) -> tuple[Store, DataFrame]:
    """Import ``entries(idx_no, word, article)`` and ``synonyms(alias, idx_no)`` of a binary dictionary.

    Of a lemma that is not defined yet the first article that is not empty counts. Entries
    whose lemma is defined already add nothing, but their synonyms are linked; entries with an
    empty article or a bad key are rejected with their synonyms. Also returns one row of counts.
    """
    from lexloom.operators.semantic import clean_headword

    lemma = clean_headword(F.col("word")) if old else native.normalize_key(F.col("word"))
    e = entries.select("idx_no", lemma.alias("lemma"), "article")
    e = e.select("idx_no", F.when(native.is_lookup_key(F.col("lemma")), F.col("lemma")).alias("lemma"), "article")
    e = e.select("*", old_article_text(F.coalesce("lemma", F.lit("")), F.coalesce("article", F.lit("")), old).alias("_d"))
    e = cleaning.with_clean(e, "_d", "text").drop("_d")
    have = store.senses.where("lemma is not null and definition is not null").select("lemma").distinct().withColumn("_h", F.lit(True))
    e = e.join(have, "lemma", "left").withColumn("_h", F.coalesce("_h", F.lit(False)) & F.lit(fallback))
    good = e.where("lemma is not null and (_h or text <> '')")
    rows = good.where("not _h").select("lemma", F.col("text").alias("definition"), F.lit(source).alias("source"), F.col("idx_no").alias("place"))
    out, fresh = add_senses(store, rows, fallback)
    names = good.select("idx_no", "lemma", "_h")
    linked = synonyms.join(names.select("idx_no", "lemma"), "idx_no").select(F.col("alias").alias("key"), "lemma")
    own = names.where("not _h").select(F.col("lemma").alias("key"), "lemma")
    counts = e.agg(
        F.count(F.lit(1)).alias("source_entries"), F.count_if(F.expr("_h and lemma is not null")).alias("skipped_existing"),
        F.count_if(F.expr("lemma is null or (not _h and text = '')")).alias("rejected"),
    )
    return add_links(out, own.unionByName(linked)), counts


# --- encyclopedia ----------------------------------------------------------------------


def page_tests(title: Column, categories: Column) -> dict[str, Column]:
    """Whether a page may define its title: ``bad_title``, ``domain`` (a subject category), ``noise`` (people, works, places)."""
    cats = F.split(F.coalesce(categories, F.lit("")), "\n")
    return {
        "bad_title": (F.length(title) > 140) | title.contains(":") | title.rlike("(?iu)" + W.BAD_TITLE) | title.rlike("(?iu)" + W.BAD_QUALIFIER),
        "domain": F.exists(cats, lambda c: c.rlike("(?iu)" + W.DOMAIN)),
        "noise": F.exists(cats, lambda c: c.rlike("(?iu)" + W.NOISE)),
    }


def page_definitions(pages: DataFrame, need_domain: bool = True) -> DataFrame:
    """``(title, base_title, definition)`` of pages that define their title (see :func:`page_tests`); entities and persons give none."""
    from lexloom.sources.wiki import lead_definitions

    tests = page_tests(F.col("title"), F.col("categories"))
    ok = ~tests["bad_title"] & ~tests["noise"] & (tests["domain"] if need_domain else F.lit(True))
    kept = pages.where("title is not null").where(F.coalesce(ok, F.lit(False)))
    d = lead_definitions(kept.select("title", "lead"))
    return native.keep_rows(d, ~F.col("definition").rlike("(?iu)" + W.ENTITY_LEAD))


def import_pages(store: Store, pages: DataFrame, workspace, fallback: bool = True) -> Store:
    """Senses from encyclopedia pages ``(title, base_title, definition)``.

    A page whose title or base title is defined adds nothing but may upgrade a weak sense;
    others add a sense, found under title and base title.
    """
    from lexloom.operators.semantic import upgrade

    p = is_defined(pages, store, "title").withColumnRenamed("defined", "title_defined")
    p = workspace.keep(is_defined(p, store, "base_title"), "pages")
    taken = F.col("title_defined") | F.col("defined")
    old = p.where(taken).select(F.when(F.col("title_defined"), F.col("title")).otherwise(F.col("base_title")).alias("key"), "definition")
    new = p.where(~taken) if fallback else p
    out, fresh = add_senses(store, new.select(F.col("title").alias("lemma"), "definition", F.lit("ruwiki-lead").alias("source"), F.col("title").alias("place")))
    names = new.select(native.normalize_key(F.col("title"), composed=True).alias("lemma"), F.explode(F.array("title", "base_title")).alias("key"))
    out = add_links(out, names.join(fresh.select("lemma").distinct(), "lemma", "left_semi").distinct())
    return upgrade(out, old, workspace)[0] if fallback else out


def redirect_links(store: Store, pages: DataFrame) -> Store:
    """Links from redirect pages ``(title, redirect)`` whose target (without its section) is defined."""
    r = pages.where("ns = 0 and redirect is not null and title is not null")
    r = r.select(F.col("title").alias("key"), native.normalize_key(F.substring_index("redirect", "#", 1)).alias("lemma"))
    return add_links(store, is_defined(r.where(native.is_lookup_key(F.col("lemma"))), store).where("defined").select("key", "lemma"))


def import_entities(store: Store, rows: DataFrame, fallback: bool = True) -> Store:
    """Senses and links of lexeme entity rows (``kind, a, b, c, file_pos, item_pos``).

    An entity counts as defined by the store or by an earlier entity of the same file whose
    aliases hold its lemma. Words tied by aliases form groups; within a group the entities are
    taken in file order, so the first with a gloss wins and later ones only add links.
    """
    senses = rows.where("kind = 'sense'").select(F.col("a").alias("lemma"), F.col("b").alias("definition"), F.col("c").alias("source"), "file_pos", "item_pos")
    links = rows.where("kind = 'link'").select(F.col("a").alias("key"), F.col("b").alias("lemma"), "file_pos")
    place = F.struct("file_pos", "item_pos")
    if fallback:
        senses = is_defined(senses, store).where("not defined").drop("defined")
        # an earlier entity with a gloss gives this lemma a meaning through one of its forms
        told = senses.groupBy("file_pos").agg(F.min("lemma").alias("_l"))
        forms = links.join(told, "file_pos").select(F.explode(probes(F.col("key"))).alias("_k"), F.col("file_pos").alias("_at"))
        first = forms.groupBy("_k").agg(F.min("_at").alias("_at"))
        asked = senses.select("lemma", "file_pos").distinct().select("lemma", "file_pos", F.explode(probes(F.col("lemma"))).alias("_k"))
        late = asked.join(first, "_k").where("_at < file_pos").select("lemma", "file_pos").distinct()
        senses = senses.join(late, ["lemma", "file_pos"], "left_anti")
    out, fresh = add_senses(store, senses.select("lemma", "definition", "source", place.alias("place")))
    known = is_defined(links.select("lemma").distinct(), out).where("defined").select("lemma")
    direct = out.senses.where("definition is not null").select("lemma").distinct()
    ok = known.unionByName(direct).distinct()
    return add_links(out, links.select("key", "lemma").distinct().join(ok, "lemma", "left_semi"))


def base_title(title: Column) -> Column:
    return F.when(title.contains(" (") & title.endswith(")"), native.strip(F.substring_index(title, " (", 1))).otherwise(title)


def union_layers(layers: list[DataFrame]) -> DataFrame:
    """Layers one after the other, numbered: ``seq`` follows (layer, place)."""
    return reduce(lambda a, b: a.unionByName(b), [d.withColumn("layer", F.lit(i)) for i, d in enumerate(layers)])


