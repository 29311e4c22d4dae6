"""Quality audit of definitions: flags, score, report tables, candidates for normalisation.

Each test is a column of its own in a chain of projections, so that it is evaluated once
however many flags build on it; costly patterns stand behind cheap ``contains`` guards.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexloom.functions import native
from lexloom.functions import patterns as P
from lexloom.operators import aliases
from lexloom.runtime import spread

_END = r"(?![\p{L}\p{N}_])"


def _like(c: Column, pattern: str) -> Column:
    return c.rlike("(?iu)" + pattern)


def _any(tests) -> Column:
    return reduce(lambda a, b: a | b, tests)


def compact(c: Column) -> Column:
    """Stripped text; blanks are collapsed only where two meet or a line breaks (a lone no-break space stays)."""
    t = native.strip(F.coalesce(c, F.lit("")))
    return F.when(t.rlike(r"  |[\n\r\t]"), native.collapse(t)).otherwise(t)


def _count(c: Column, char: str) -> Column:
    return F.length(c) - F.length(F.replace(c, F.lit(char), F.lit("")))


def edge_quote(t: Column) -> Column:
    """A quotation mark at an edge whose partner is missing."""
    odd = _count(t, '"') % 2 == 1
    out = F.when(
        t.startswith('"') | t.endswith('"'), odd & (t.rlike(r'(?:^|[\s\p{Z}.,;:!?)\]}])"$') | t.rlike(r'^"(?:$|[\p{L}\s\p{Z}])'))
    ).otherwise(F.lit(False))
    for a, b in (("«", "»"), ("„", "“"), ("“", "”"), ("‘", "’")):
        out = out | (t.startswith(a) & (_count(t, a) > _count(t, b))) | (t.endswith(b) & (_count(t, b) > _count(t, a)))
    return out


def headword(lemma: Column) -> Column:
    """Comparable form of a stored lemma: folded case, plain hyphens, no punctuation around it."""
    return native.strip_chars(native.casefold(native.normalize_key(F.coalesce(lemma, F.lit("")), composed=True)), " .,:;—–-")


def self_reference(head: Column, low: Column) -> Column:
    """The text (lower case) begins with its own headword (of 4 letters or more)."""
    probe = F.when(low.startswith("это "), F.substring(low, F.lit(5), F.length(low))).otherwise(low)
    rest = F.substring(probe, F.length(head) + 1, F.lit(1))
    return (F.length(head) >= 4) & probe.startswith(head) & (rest.isin("", "—", "–", ":", "-") | rest.rlike(r"[\s\p{Z}]"))


def old_equivalence(head: Column, text: Column, source: Column) -> Column:
    """``Headword (аналогично русскому слову ..)`` of the historical sources: the word itself, old letters or new."""

    def modern(x: Column) -> Column:
        return F.translate(x, "ѣі", "еи")

    pattern = "(?iu)" + P.OLD_EQUIVALENCE.replace("^.{1,120}?", "^(.{1,120}?)")
    left = headword(F.regexp_extract(text, pattern, 1))
    same = (left != "") & (head != "") & (modern(left) == modern(head))
    return source.rlike(P.OLD_SOURCES) & text.contains("(") & _like(text, P.OLD_EQUIVALENCE) & same


def historical_years(text: Column) -> Column:
    """Distinct years that read like dates of prose; a year after ``модель ..``, ``тип ..`` and the like is none."""
    found = F.regexp_extract_all(text, F.lit(f"(?s)(.{{0,36}}?)({P.YEAR_TOKEN})"), F.lit(0))
    dated = F.filter(found, lambda x: ~_like(F.substring(x, F.lit(1), F.length(x) - 4), P.MODEL_BEFORE))
    return F.array_distinct(F.transform(dated, lambda x: F.right(x, F.lit(4))))


def encyclopedic_date(lemma: Column, text: Column, low: Column) -> Column:
    """History of a thing rather than its meaning: a year that the headword does not name, with a history clause."""
    foreign = F.size(F.array_except(historical_years(text), historical_years(F.coalesce(lemma, F.lit(""))))) > 0
    words = (F.length(text) > 220) & low.rlike(rf"(?<![\p{{L}}\p{{N}}_])(?:{P.WIKI_HISTORY_WORDS})")
    return text.rlike(r"1[5-9]\d\d|20\d\d") & foreign & (_like(text, P.WIKI_HISTORY) | words)


def grammar_only(text: Column, low: Column) -> Column:
    """Grammar instead of a meaning; the patterns run only where a typical part is present."""
    plain = F.when(text.contains("[["), F.regexp_replace(text, r"\[\[(?:[^\]|]+\|)?([^\]]+)\]\]", "$1")).otherwise(text)
    hit = _any([_like(plain, p) for p in P.FORM_OF]) | _like(text, P.GRAMMAR)
    return F.when(_any([low.contains(h) for h in P.GRAMMAR_HINTS]), hit).otherwise(F.lit(False))


def flag_tests(c) -> dict[str, Column]:
    """One boolean for each flag, in flag order, of the columns made by :func:`with_flags`."""
    text, low, n, src = c("text"), c("low"), c("n"), c("src")
    onomastic, concise, redirect = c("onomastic"), c("concise"), c("redirect")
    about = low.rlike(P.ABOUT)
    bracket = F.substring(text, 1, 1).isin("(", "[")
    return {
        "onomastic_stub": onomastic,
        "very_short": (n < 8) & ~onomastic & ~concise,
        "very_long": n > 520,
        "grammar_residue": grammar_only(text, low),
        "markup_residue": text.contains("{{") | text.contains("[[") | (text.contains("<") & text.contains(">") & _like(text, P.MARKUP)),
        "leading_parenthetical": F.when(bracket, native.leading_group(text).isNotNull()).otherwise(F.lit(False)),
        "vague": low.rlike("^(?:свойство|способность|явление|процесс)") & _like(text, P.VAGUE),
        "early_self_reference": self_reference(c("head"), low) & ~concise & ~onomastic,
        "example_residue": text.contains("◆") | text.contains("◇") | text.contains("[НКРЯ]"),
        "placeholder_definition": (n <= 80) & c("meta"),
        "fragment": (n <= 100) & c("fragment"),
        "old_equivalence_placeholder": c("old"),
        "url_residue": (low.contains("http") | low.contains("www.")) & _like(text, P.URL),
        "redirect_residue": redirect,
        "about_fragment": (n <= 100) & about,
        "bad_residue": text.rlike(P.RESIDUE) | edge_quote(text),
    }


def with_flags(senses: DataFrame) -> DataFrame:
    """``seq, lemma, source, text, flags`` of every sense; an empty definition has the flag ``empty``."""
    base = spread(senses.select("seq", "lemma", "source", "definition"))
    step = base.select("seq", "lemma", "source", compact(F.col("definition")).alias("text"))
    text = F.col("text")
    step = step.select(
        "*",
        native.casefold(text).alias("low"),
        F.length(text).alias("n"),
        F.coalesce("source", F.lit("")).alias("src"),
        headword(F.col("lemma")).alias("head"),
        aliases.is_formula(text).alias("redirect"),
    )
    n, low = F.col("n"), F.col("low")
    plain = F.when(text.rlike(f"[{native.STRESS}]"), native.strip_stress(text)).otherwise(text)
    probe = native.strip(F.regexp_replace(text, r"\s*\([^()]{1,40}\)\s*[.!]?$", ""))
    step = step.select(
        "*",
        ((n <= 140) & _any([_like(plain, p) for p in P.ONOMASTIC])).alias("onomastic"),
        ((n <= 80) & _like(text, P.EMPTY_META)).alias("meta"),
        ((n <= 100) & _like(text, P.FRAGMENT)).alias("fragment"),
        old_equivalence(F.col("head"), text, F.col("src")).alias("old"),
        F.when(probe == "", text).otherwise(probe).alias("probe"),
    )
    letters = F.length(F.regexp_replace("probe", r"[^\p{L}]", ""))
    concise = (
        n.between(4, 45) & ~F.col("onomastic") & ~low.rlike(P.ABOUT) & ~F.col("redirect") & ~F.col("meta") & ~F.col("fragment")
    ) & F.when(n <= 45, F.col("probe").rlike(P.CONCISE) & (letters >= 3)).otherwise(F.lit(False))
    step = step.select("*", concise.alias("concise"))
    tests = flag_tests(F.col)
    step = step.select(
        "*", F.array_compact(F.array(*[F.when(F.coalesce(v, F.lit(False)), F.lit(k)) for k, v in tests.items()])).alias("first")
    )
    wiki = F.col("src").startswith("ruwiki")
    brackets = F.abs(_count(text, "(") - _count(text, ")")) >= 2
    more = F.when(wiki, F.array_compact(F.array(
        F.when(encyclopedic_date(F.col("lemma"), text, low), F.lit("encyclopedic_date")),
        F.when(_like(text, P.WIKI_TAIL) | brackets, F.lit("broken_fragment")),
    ))).otherwise(F.array().cast("array<string>"))
    found = F.when((F.size("first") == 0) & F.col("concise"), F.array(F.lit("concise_gloss"))).otherwise(F.col("first"))
    flags = F.when(n == 0, F.array(F.lit("empty"))).otherwise(F.concat(found, more))
    return step.select("seq", "lemma", "source", "text", flags.alias("flags"))


def score(flagged: DataFrame) -> DataFrame:
    """``flagged`` plus ``score`` (0 to 100)."""
    t, n = F.col("text"), F.length("text")

    def has(flag: str) -> Column:
        return F.array_contains("flags", flag)

    length = (
        F.when(n < 16, 42).when(n < 35, 60).when(n.between(45, 260), 80).when(n > 520, 52).when(n > 360, 64).otherwise(72)
    )
    base = F.when(has("onomastic_stub"), F.when(n >= 9, 64).otherwise(56)).when(has("concise_gloss"), 64).otherwise(length)
    loss = reduce(lambda a, b: a + b, [F.when(has(k), v).otherwise(0) for k, v in P.PENALTIES.items() if v])
    bonus = F.when(t.rlike("[.!?]$"), 3).otherwise(0) + F.when((n >= 55) & t.rlike("[;,—]"), 2).otherwise(0)
    value = F.greatest(F.lit(0), F.least(F.lit(100), base - loss + bonus))
    return flagged.withColumn("score", F.when(n == 0, 0).otherwise(value).cast("int"))


def score_buckets(scored: DataFrame) -> DataFrame:
    b = F.when(F.col("score") < 50, "0-49").when(F.col("score") < 70, "50-69").when(F.col("score") < 85, "70-84").otherwise("85-100")
    return scored.groupBy(b.alias("bucket")).agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("score"), 2).alias("average"))


def warning_counts(scored: DataFrame) -> DataFrame:
    return native.unnest(scored, F.col("flags"), "flag").groupBy("flag").agg(F.count(F.lit(1)).alias("n"))


def flag_examples(scored: DataFrame, most: int = 80) -> DataFrame:
    """The first ``most`` rows of each flag in (lemma, seq) order."""
    rows = native.unnest(scored, F.col("flags"), "flag", "lemma", "seq", "score").where("lemma is not null")
    w = Window.partitionBy("flag").orderBy("lemma", "seq")
    return rows.withColumn("place", F.row_number().over(w)).where(F.col("place") <= most)


def informational_examples(scored: DataFrame, most: int = 2000) -> DataFrame:
    """The first ``most`` rows with an informational flag, each in (lemma, seq) order."""
    some = F.array_intersect("flags", F.array(*map(F.lit, P.INFORMATIONAL)))
    rows = native.unnest(scored, some, "flag", "lemma", "seq", "text")
    w = Window.partitionBy("flag").orderBy("lemma", "seq")
    return rows.where("lemma is not null").withColumn("place", F.row_number().over(w)).where(F.col("place") <= most)


def review_queue(scored: DataFrame, most: int = 5000) -> DataFrame:
    """The ``most`` worst rows that have a warning; ties by (lemma, seq)."""
    warned = native.keep_rows(scored, F.size(F.array_except("flags", F.array(*[F.lit(x) for x in P.INFORMATIONAL]))) > 0)
    return warned.orderBy("score", "lemma", "seq").limit(most).select("score", "lemma", "seq", "source")


def totals(scored: DataFrame) -> DataFrame:
    """One row: number of definitions, mean score, rows with a warning, rows with informational flags only."""
    warned = F.size(F.array_except("flags", F.array(*[F.lit(x) for x in P.INFORMATIONAL]))) > 0
    return scored.select("score", warned.alias("w"), (F.size("flags") > 0).alias("any")).agg(
        F.count(F.lit(1)).alias("definitions"),
        F.round(F.avg("score"), 2).alias("average"),
        F.count_if("w").alias("with_warnings"),
        F.count_if(F.col("any") & ~F.col("w")).alias("informational_only"),
    )


def semantic_candidates(senses: DataFrame) -> DataFrame:
    """Rows that normalisation looks at; all others are never changed."""
    d, lemma, src = F.col("definition"), F.col("lemma"), F.coalesce(F.col("source"), F.lit(""))
    left, right = F.ltrim(d), F.rtrim(d)
    test = (
        (src == "dal")
        | src.startswith("ruwiki")
        | src.isin("wiktionary:cu", "wiktionary:orv", "wiktionary:ru-old")
        | (F.length(d) <= 40)
        | (F.length(d) > 520)
        | F.substring(left, 1, 1).isin("(", "[", "·", "•")
        | F.lower(d).contains("http://")
        | F.lower(d).contains("https://")
        | (native.casefold(F.substring(d, F.lit(1), F.length(lemma))) == native.casefold(lemma))
    )
    for s in P.CANDIDATE_STARTS:
        test = test | left.startswith(s)
    for s in P.CANDIDATE_PARTS:
        test = test | d.contains(s)
    for s in P.CANDIDATE_ENDS:
        test = test | right.endswith(s)
    return senses.where(d.isNotNull() & lemma.isNotNull()).where(F.coalesce(test, F.lit(False)))
