"""Corpus coverage: which tokens of texts a dictionary knows, and what is missing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexloom.functions import native
from lexloom.runtime import Workspace, spread

#: Lower-case abbreviations.
ABBREVIATIONS = (
    "авт акад арх библ бл букв вв гг гл госп гр губ диал доц др ед журн зам изд им иностр искл ист итд итп кв кг км "
    "кол коп край лат лит мл млн млрд м мес мин мн напр науч обл ок пер пл пос пр прим проф разг ред рис род руб св см "
    "ср ст стр сущ тд тел тер тп тыс тт ул уст фр чел шт экз яз"
).split()


def token_rows(docs: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc, pos, token, normalized)``; texts without tokens give no row."""
    slim = spread(docs.select(F.col(doc).alias("doc"), F.col(text).alias("text")))
    t = slim.select("doc", F.posexplode(native.tokens(F.col("text"))).alias("pos", "token"))
    return t.withColumn("normalized", folded(F.col("token")))


def folded(token: Column) -> Column:
    """Lookup form of a token: it has letters and digits only, so nothing but case and ё can change."""
    return F.replace(native.casefold(token), F.lit("ё"), F.lit("е"))


def folded_tokens(text: Column) -> Column:
    """Tokens of a text in lookup form.

    The text is folded as a whole, which cannot move a token border, except where it holds
    one of the two letters whose lower case is longer or depends on what surrounds it.
    """
    each = F.transform(native.tokens(text), folded)
    return F.when(text.rlike("[\u0130\u03a3]"), each).otherwise(native.tokens(folded(text)))


def known_keys(keys: DataFrame, column: str) -> DataFrame:
    """Distinct normalised keys with ``is_phrase``."""
    k = keys.where(F.col(column).isNotNull()).select(native.normalize_lookup(F.col(column)).alias("known")).distinct()
    return k.where("known <> ''").withColumn("is_phrase", F.col("known").contains(" "))


#: Cells of the filter of phrase beginnings: so many per phrase, within these bounds.
CELLS_PER_PHRASE, LEAST_CELLS, MOST_CELLS = 64, 1 << 16, 1 << 23


def phrase_filter(keys: DataFrame) -> DataFrame:
    """One row: ``cells``, booleans that mark the first two words of all phrases (at most 8 MB).

    It only spares work: a window that passes is still joined with the keys, and a filter that
    is too small for the dictionary lets more windows pass.
    """
    phrases = keys.where("is_phrase")
    n = LEAST_CELLS
    wanted = min(MOST_CELLS, CELLS_PER_PHRASE * phrases.count())
    while n < wanted:
        n *= 2
    w = F.split("known", " ")
    marks = phrases.select(_cell(w[0], w[1], n).cast("long").alias("id")).distinct().withColumn("m", F.lit(True))
    rows = keys.sparkSession.range(n).join(marks, "id", "left")  # at most MOST_CELLS rows
    packed = F.sort_array(F.collect_list(F.struct("id", F.coalesce("m", F.lit(False)).alias("m"))))
    return rows.agg(F.transform(packed, lambda x: x["m"]).alias("cells"))


def _cell(first: Column, second: Column, n: int) -> Column:
    return F.pmod(F.xxhash64(first, second), F.lit(n)).cast("int")


def counted_terms(docs: DataFrame, keys: DataFrame, workspace: Workspace, by: list[str], doc: str = "doc_id", text: str = "text") -> DataFrame:
    """``(*by, term, n)``: occurrences of folded tokens and of windows that may be known phrases.

    ``by`` is ``["doc"]`` or empty. Each text is tokenised once. Windows of 2 to 4 words
    (terms with a blank) are made only where two words begin a phrase (by the filter), and
    both kinds of terms are counted map-side before the one shuffle.
    """
    filt = workspace.keep(phrase_filter(keys), "filter")
    size = filt.select(F.size("cells")).first()[0]
    slim = spread(docs.select(F.col(doc).alias("doc"), F.col(text).alias("text")))

    def terms(s: Column) -> Column:
        w, cells, n = s["w"], s["cells"], F.size(s["w"])
        starts = F.filter(
            F.when(n > 1, F.sequence(F.lit(0), n - 2)).otherwise(F.array().cast("array<int>")),
            lambda i: F.get(cells, _cell(F.get(w, i), F.get(w, i + 1), size)),
        )
        runs = F.transform(starts, lambda i: F.transform(
            F.sequence(F.lit(2), F.least(F.lit(4), n - i)), lambda k: F.array_join(F.slice(w, i + 1, k), " ")
        ))
        return F.concat(w, F.flatten(runs))

    made = native.bind({"w": folded_tokens(F.coalesce("text", F.lit(""))), "cells": F.col("cells")}, terms)
    # the scalar stands outside the lambda for the analyser; the optimizer merges both projections
    found = slim.withColumn("cells", filt.scalar()).select("doc", made.alias("terms"))
    rows = found.select("doc", F.explode("terms").alias("term"))
    return workspace.keep(rows.groupBy(*by, "term").agg(F.count(F.lit(1)).alias("n")), "terms")


def token_counts(
    docs: DataFrame, keys: DataFrame, workspace: Workspace, per_doc: bool = True, doc: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``(doc, normalized, n, single_known, covered)`` of tokens that have a letter; without ``doc`` for the whole corpus.

    ``covered`` is how often a token lies in a known phrase of 2 to 4 words (overlapping
    phrases add up). For the corpus nothing is counted per text, and only distinct words
    and phrases meet the keys.
    """
    keys = workspace.keep(keys, "keys")
    by = ["doc"] if per_doc else []
    terms = counted_terms(docs, keys, workspace, by, doc, text)
    is_gram = F.col("term").contains(" ")
    words = terms.where(~is_gram & F.col("term").rlike(r"\p{L}")).select(*by, F.col("term").alias("normalized"), "n")
    hits = terms.where(is_gram).select(*by, F.col("term").alias("known"), "n")
    hits = hits.join(keys.where("is_phrase").select("known"), "known", "left_semi")
    cover = hits.select(*by, F.explode(F.split("known", " ")).alias("normalized"), "n")
    cover = cover.groupBy(*by, "normalized").agg(F.sum("n").alias("covered"))
    single = keys.where("not is_phrase").select(F.col("known").alias("normalized"), F.lit(True).alias("single_known"))
    # null docs are one text of their own
    both = words.join(cover, _same(words, cover, [*by, "normalized"]), "left").select(*[words[c] for c in [*by, "normalized", "n"]], cover["covered"])
    return both.join(single, "normalized", "left").select(
        *by, "normalized", "n", F.coalesce("single_known", F.lit(False)).alias("single_known"), F.coalesce("covered", F.lit(0)).alias("covered")
    )


def _same(a: DataFrame, b: DataFrame, columns: list[str]) -> Column:
    tests = [a[c].eqNullSafe(b[c]) for c in columns]
    out = tests[0]
    for t in tests[1:]:
        out = out & t
    return out


def _unknown() -> Column:
    return F.when(F.col("single_known"), F.lit(0)).otherwise(F.greatest(F.col("n") - F.col("covered"), F.lit(0)))


def coverage_by_file(counts: DataFrame) -> DataFrame:
    """Per text: tokens, distinct tokens, unknown tokens (by the text's own counts)."""
    return counts.groupBy("doc").agg(
        F.sum("n").alias("tokens_total"),
        F.count(F.lit(1)).alias("unique_tokens"),
        F.sum(_unknown()).alias("unknown_tokens"),
    )


def coverage_report(corpus: DataFrame) -> DataFrame:
    """One row of corpus counts: totals and the percentage of known tokens, 100.0 for an empty corpus."""
    total = corpus.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("tokens_total"),
        F.count(F.lit(1)).alias("unique_tokens"),
        F.coalesce(F.sum(_unknown()), F.lit(0)).alias("unknown_tokens"),
    )
    known = F.col("tokens_total") - F.col("unknown_tokens")
    return total.select(
        "tokens_total",
        "unique_tokens",
        known.alias("known_tokens"),
        "unknown_tokens",
        F.when(F.col("tokens_total") == 0, 100.0)
        .otherwise(F.round(known / F.col("tokens_total") * 100, 3))
        .alias("coverage_percent"),
    )


def unknown_tokens(counts: DataFrame) -> DataFrame:
    """``(normalized, count)`` of what the dictionary does not cover; with ``doc`` if the counts have it."""
    by = ["doc"] if "doc" in counts.columns else []
    return counts.select(*by, "normalized", _unknown().alias("count")).where("count > 0")


def variants(docs: DataFrame, k: int = 5, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """``(normalized, rank, token, n)``: the ``k`` most frequent surfaces; ties by first place in the corpus."""
    t = token_rows(docs, doc, text).drop("normalized").where(F.col("token").rlike(r"\p{L}"))
    n = t.groupBy("token").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("doc", "pos")).alias("first"))
    n = n.withColumn("normalized", folded(F.col("token")))
    w = Window.partitionBy("normalized").orderBy(F.desc("n"), "first")
    return n.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("normalized", "rank", "token", "n")


def roman_value(token: Column) -> Column:
    """Value of a token made of Roman digits only (any case), else null."""
    digits = F.split(F.upper(token), "")
    value = F.transform(
        F.filter(digits, lambda d: d != ""),
        lambda d: F.element_at(
            F.create_map(*[F.lit(x) for kv in (("I", 1), ("V", 5), ("X", 10), ("L", 50), ("C", 100), ("D", 500), ("M", 1000)) for x in kv]), d
        ),
    )
    pairs = F.transform(value, lambda v, i: F.when(v < F.coalesce(F.get(value, i + 1), F.lit(0)), -v).otherwise(v))
    total = F.aggregate(pairs, F.lit(0), lambda a, v: a + v)
    return F.when(token.rlike("^[IVXLCDMivxlcdm]+$"), total)


def classify(unknown: DataFrame, surfaces: DataFrame, core: DataFrame | None = None, morphology=None) -> DataFrame:
    """Triage of unknown tokens; the first matching test wins.

    ``(normalized, count, token, script, category, action, candidate, reason, confidence,
    candidate_key)``. ``surfaces`` is :func:`variants`; the most frequent surface decides, a
    token counts as a possible name only if all its surfaces are capitalised. ``morphology``
    is an optional function from the token column to a struct ``(lemma, known)``; ``core``
    (``lemma, definition``) tells which lemmas the dictionary defines.
    """
    s = surfaces.groupBy("normalized").agg(
        F.min_by("token", "rank").alias("token"),
        F.bool_and(F.col("token").rlike("^[А-ЯЁ][а-яё-]+$")).alias("all_capital"),
    )
    t, norm = F.col("token"), F.col("normalized")
    rows = unknown.join(s, "normalized")
    if morphology is None:
        rows = rows.withColumn("word_lemma", F.lit(None).cast("string")).withColumn("word_known", F.lit(False))
    else:
        rows = rows.withColumn("_m", morphology(t)).withColumn("word_lemma", folded(F.col("_m.lemma"))).withColumn("word_known", F.coalesce("_m.known", F.lit(False)))
    if core is None or morphology is None:
        rows = rows.withColumn("in_core", F.lit(False))
    else:
        defined = core.where("lemma is not null").select(native.normalize_lookup(F.col("lemma")).alias("word_lemma")).distinct()
        rows = rows.join(defined.withColumn("in_core", F.lit(True)), "word_lemma", "left").withColumn("in_core", F.coalesce("in_core", F.lit(False)))
    script = native.script_of(t)
    parts = F.split(norm, "-")
    repeated = norm.rlike(r"(?iu)^(.)\1{3,}$")
    stretched = repeated | ((F.size(parts) >= 3) & F.exists(parts, lambda p: F.length(p) == 1) & F.forall(parts, lambda p: p != ""))
    capitals = t.rlike("^[A-ZА-ЯЁ]{2,10}$")
    cases = (
        (roman_value(t).isNotNull(), "number", "ignore_numeric", False, "roman_numeral", "high"),
        (stretched, "noise", "ignore_typographic_variant", False, "stylised_spelling", "high"),
        (capitals, "abbreviation", "review_abbreviation_pack", True, "capitals", "high"),
        (norm.isin(ABBREVIATIONS), "abbreviation", "review_abbreviation_pack", True, "closed_list", "medium"),
        (script.isin("latin", "greek", "other-alphabet", "mixed"), "foreign", "review_separate_language_layer", True, "script", "high"),
        ((script == "cyrillic") & F.col("all_capital") & ~F.col("word_known") & (F.length(norm) >= 3),
         "name", "review_literary_name_layer", True, "capitalised_in_all_places", "possible"),
        (F.col("in_core") & (F.col("word_lemma") != norm), "word", "review_inflection_alias", True, "lemma_is_defined", "high"),
        (F.col("word_lemma").isNotNull(), "word", "review_lexicographic_entry", True, "lemma_by_morphology", "medium"),
    )

    def pick(i: int):
        out = None
        for case in cases:
            out = F.when(case[0], case[i]) if out is None else out.when(case[0], case[i])
        return out.otherwise(("word", "review_lexicographic_entry", True, "no_match", "possible")[i - 1])

    key = (
        F.when(roman_value(t).isNotNull(), F.concat(F.lit("roman:"), roman_value(t).cast("string")))
        .when((pick(2) == "review_inflection_alias") | ((pick(1) == "word") & F.col("word_lemma").isNotNull()), F.col("word_lemma"))
        .otherwise(norm)
    )
    return rows.select(
        "normalized", "count", "token", script.alias("script"), pick(1).alias("category"), pick(2).alias("action"), pick(3).alias("candidate"),
        pick(4).alias("reason"), pick(5).alias("confidence"), key.alias("candidate_key"),
    )


def oov_groups(classified: DataFrame, per_doc: DataFrame | None = None, most_forms: int | None = None) -> DataFrame:
    """Candidates by (category, action, candidate_key): ``total``, ``share_percent``, ``forms``, ``files``, ``rank``.

    ``forms`` lists the tokens by falling count, ``files`` (with ``per_doc``, the unknown
    tokens of each text) the texts by falling count. Ranks follow (total, key, category).
    The rank is global, but only over candidates that are one row each by then; it is built
    on range partitions (see :func:`lexloom.operators.articles.with_offsets`).
    """
    keys = ["category", "action", "candidate_key"]
    by_count = F.transform(F.sort_array(F.collect_list(F.struct((-F.col("count")).alias("c"), "normalized"))), lambda x: F.concat(x["normalized"], F.lit(":"), (-x["c"]).cast("string")))
    forms = by_count if most_forms is None else F.slice(by_count, 1, most_forms)
    g = classified.groupBy(*keys).agg(F.sum("count").alias("total"), F.array_join(forms, " ").alias("forms"))
    whole = classified.agg(F.sum("count").alias("whole"))
    g = g.withColumn("share_percent", F.round(100 * F.col("total") / whole.scalar(), 4))
    if per_doc is not None:
        members = classified.select("normalized", *keys)
        f = per_doc.join(members, "normalized").groupBy(*keys, "doc").agg(F.sum("count").alias("c"))
        files = F.transform(F.sort_array(F.collect_list(F.struct((-F.col("c")).alias("c"), "doc"))), lambda x: F.concat(x["doc"].cast("string"), F.lit(":"), (-x["c"]).cast("string")))
        g = g.join(f.groupBy(*keys).agg(F.array_join(files, " ").alias("files")), keys, "left")
    from lexloom.operators.articles import with_offsets

    placed = with_offsets(g.withColumn("_o", F.struct((-F.col("total")).alias("t"), "candidate_key", "category", "action")), "_o", F.lit(1).cast("long"))
    return placed.withColumn("rank", F.col("offset") + 1).drop("_o", "size", "offset")


def category_summary(classified: DataFrame) -> DataFrame:
    """``(category, forms, tokens)``."""
    return classified.groupBy("category").agg(F.count(F.lit(1)).alias("forms"), F.sum("count").alias("tokens"))
