"""Glosses ``О X`` of several words, turned into ``X`` with the word forms the link graph proves.

Each word must lead to exactly one lemma. The last word is the head; adjectives before it
take its gender. A gloss with anything doubtful (an unknown or ambiguous word, a plural head,
an inflected noun before the head) stays as it is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexloom.functions import cleanup_patterns as C
from lexloom.functions import native
from lexloom.operators import aliases

#: Function words that stay as they are.
FUNCTION_WORDS = (
    "в во на над под к ко с со у от до из за по о об обо при без для про и или а но как так не ни же ли либо после перед "
    "между через ради около вокруг среди против вместо"
).split()
#: Endings of inflected adjectives, of adjectives in the dictionary, and what these become before a noun.
INFLECTED = r"(?iu)(?:ым|им|ом|ем|ую|юю|ого|его|ому|ему|ые|ие|ых|их|ыми|ими|ая|яя|ое|ее|ою|ею|ей)$"
ADJECTIVE = r"(?iu)(?:ый|ий|ой)$"
GENDERS = (
    (r"(?iu)[ая]$", (("ский$", "ская"), ("кий$", "кая"), ("ний$", "няя"), ("ий$", "яя"), ("(?:ый|ой)$", "ая"))),
    (r"(?iu)[ое]$", (("ский$", "ское"), ("кий$", "кое"), ("ний$", "нее"), ("ий$", "ее"), ("(?:ый|ой)$", "ое"))),
)
PLURAL = r"(?iu)(?:ах|ях|ами|ями|ов|ев)$"
PLURAL_OR_GENITIVE = r"(?iu)(?:ах|ях|ами|ями|ов|ев|ы|и)$"
_QUOTES = "«»\"'“”„‘’"


def _bare(token: Column) -> Column:
    return F.regexp_replace(token, f"^[{_QUOTES}]+|[{_QUOTES}]+$", "")


def _agreeing(target: Column, head: Column) -> Column:
    """An adjective of the dictionary in the gender of a noun; other words stay."""
    out = None
    for gender, endings in GENDERS:
        for ending, by in endings:
            test = head.rlike(gender) & target.rlike("(?iu)" + ending)
            new = F.regexp_replace(target, "(?iu)" + ending, by)
            out = F.when(test, new) if out is None else out.when(test, new)
    return F.when(target.rlike(ADJECTIVE), out.otherwise(target)).otherwise(target)


def _raised(word: Column, like: Column) -> Column:
    return F.when(F.substring(like, 1, 1).rlike(r"^\p{Lu}$"), native.capital(word)).otherwise(word)


def rewrite(rows: DataFrame, links: DataFrame, lemmas: DataFrame) -> DataFrame:
    """``(seq, rewritten)`` of the ``rows(seq, text)`` that can be rewritten without doubt."""
    t = F.col("text")
    body = native.strip_chars(native.collapse(F.regexp_extract(t, "(?iuU)" + C.ABOUT_TARGET, 1)), " .;:—–-")
    fit = rows.where((F.length(t) <= 100) & t.rlike("(?iuU)" + C.ABOUT_TARGET)).select("seq", body.alias("body"))
    fit = fit.where(~F.col("body").rlike(r"[,;:—–()\[\]?!]|\.\.\.")).select("seq", F.split("body", " ").alias("tokens"))
    fit = fit.where(F.size("tokens").between(2, 8))
    words = fit.select("seq", "tokens", F.posexplode("tokens").alias("i", "token")).withColumn("bare", _bare(F.col("token")))
    kept = F.lower("bare").isin(FUNCTION_WORDS) | ~F.col("bare").rlike(r"\p{L}")
    words = words.withColumn("kept", kept).withColumn("function_word", F.lower("bare").isin(FUNCTION_WORDS))
    # each word is looked up once, under its own hash
    asked = words.where("not kept").select(F.xxhash64("bare").alias("seq"), F.lit("").alias("lemma"), native.normalize_key(F.col("bare"), composed=True).alias("k"))
    asked = asked.where(native.is_lookup_key(F.col("k"))).distinct()
    known = aliases.lookup(asked, links, lemmas).groupBy(F.col("seq").alias("h")).agg(F.count(F.lit(1)).alias("n"), F.min("target").alias("target"))
    j = words.join(known, F.xxhash64("bare") == F.col("h"), "left")
    parts = F.sort_array(F.collect_list(F.struct("i", "token", "bare", "kept", "function_word", F.when(F.col("n") == 1, F.col("target")).alias("target"))))
    g = j.groupBy("seq").agg(parts.alias("w"))

    def before(w: Column, x: Column) -> Column:
        """A function word stands right before the word."""
        return F.coalesce(F.get(w, x["i"] - 1)["function_word"], F.lit(False))

    def capital(x: Column) -> Column:
        return F.substring(x["bare"], 1, 1).rlike(r"^\p{Lu}$")

    def moved(x: Column) -> Column:
        return x["target"] != x["bare"]

    def judge(r: Column) -> Column:
        w, lex = r["w"], r["lex"]
        head = F.get(lex, F.size(lex) - 1)
        plural = head["bare"].rlike(PLURAL_OR_GENITIVE) & ~head["target"].rlike("(?iu)[ыи]$") | head["bare"].rlike(PLURAL) & head["target"].rlike("(?iu)[ыи]$")

        def doubtful(x: Column) -> Column:
            adjective = x["target"].rlike(ADJECTIVE) & x["bare"].rlike(INFLECTED)
            parted = F.coalesce(F.get(w, x["i"] + 1)["function_word"], F.lit(False))
            return (x["i"] != head["i"]) & moved(x) & ~adjective & ~capital(x) & ~parted

        ok = (
            (F.size(lex) > 0) & F.forall(lex, lambda x: x["target"].isNotNull()) & F.exists(lex, moved) & ~plural
            & ~F.exists(lex, lambda x: (before(w, x) & moved(x) & ~capital(x)) | doubtful(x))
        )

        def shown(x: Column) -> Column:
            word = F.when(x["i"] == head["i"], x["target"]).otherwise(_agreeing(x["target"], head["target"]))
            return F.when(x["kept"], x["token"]).otherwise(F.replace(x["token"], x["bare"], _raised(word, x["bare"])))

        return F.when(ok, native.capital(F.array_join(F.transform(w, shown), " ")))

    lexical = F.filter("w", lambda x: ~x["kept"])
    made = g.select("seq", native.bind({"w": F.col("w"), "lex": lexical}, judge).alias("rewritten"))
    return native.keep_rows(made, F.col("rewritten").isNotNull())
