"""Display meanings of passive participles, derived from the meaning of their verb."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexloom.functions import native, rules
from lexloom.functions import patterns as P

_VERB = r"[А-ЯЁа-яё-]+(?:ть|ти|чь)"
CHAIN = rf"^({_VERB}(?:\s+(?:и|или)\s+{_VERB}){{0,2}})(\s+.+)$"
_OBJECT = r"^\s+(?:(?:что|кого)-(?:либо|нибудь|то))(?![\p{L}\p{N}_])"


def best_participles(links: DataFrame) -> DataFrame:
    """``(verb, participle)``: of a verb's forms with a participle ending the shortest; ё before е, then by letters."""
    key, low = F.col("key"), native.casefold(F.col("key"))
    ends = low.rlike(f"(?:{'|'.join(P.PARTICIPLE_ENDINGS)})$")
    fit = links.where("key is not null and lemma is not null").where(
        ends & ~key.contains(" ") & (F.length(key) <= 70) & (low != native.casefold(F.col("lemma")))
    )
    order = F.struct(F.length(key), F.when(low.contains("ё"), 0).otherwise(1), low, key)
    return fit.groupBy(F.col("lemma").alias("verb")).agg(F.min_by("key", order).alias("participle"))


def eligible_hints(hints: DataFrame, senses: DataFrame, kind: str = "passive") -> DataFrame:
    """``(key, target, definition)`` of hints whose key has no meaning of its own and whose target has exactly one."""
    h = hints.where(F.col("kind") == kind).where("key is not null and target is not null").select("key", "target").distinct()
    own = senses.where("definition is not null").select(F.col("lemma").alias("key")).distinct()
    one = senses.where("definition is not null").groupBy("lemma").agg(
        F.count(F.lit(1)).alias("n"), F.min("definition").alias("definition")
    ).where("n = 1")
    return h.join(own, "key", "left_anti").join(one, h.target == one.lemma).select("key", "target", "definition")


def derive_overrides(hints: DataFrame, senses: DataFrame, links: DataFrame, kind: str = "passive") -> DataFrame:
    """``(key, definition, source)`` for passive forms without a meaning of their own.

    The target must have exactly one sense whose text begins with infinitives; each of them
    is replaced by a participle that exists as a link, never by a made-up one. Of several
    targets of a key the last in byte order wins. Null keys and targets give no row.
    """
    rows = eligible_hints(hints, senses, kind)
    text = rules.text_rule("clean_definition", F.col("definition"))
    rows = rows.select("key", "target", text.alias("t")).where(F.col("t").rlike(CHAIN))
    verbs = F.split(F.regexp_extract("t", CHAIN, 1), r"\s+(?:и|или)\s+")
    rest = F.regexp_replace(F.regexp_extract("t", CHAIN, 2), _OBJECT, "")
    parts = rows.select("key", "target", F.regexp_extract("t", CHAIN, 1).alias("chain"), rest.alias("rest"), F.posexplode(verbs).alias("i", "verb"))
    best = best_participles(links).withColumnRenamed("verb", "pv")
    got = parts.join(best, native.casefold(F.col("verb")) == F.col("pv"), "left")
    g = got.groupBy("key", "target", "chain", "rest").agg(
        F.sort_array(F.collect_list(F.struct("i", "participle"))).alias("ps"), F.count("participle").alias("found"), F.count(F.lit(1)).alias("need")
    )
    g = g.where("found = need")
    joiner = F.when(F.col("chain").rlike(r"\s+или\s+"), F.lit(" или ")).otherwise(F.lit(" и "))
    body = F.concat(F.aggregate("ps", F.lit(""), lambda a, p: F.when(a == "", p["participle"]).otherwise(F.concat(a, joiner, p["participle"]))), F.col("rest"))
    done = g.select("key", "target", native.collapse(body).alias("b"))
    done = done.select("key", "target", F.concat(F.upper(F.substring("b", 1, 1)), F.expr("substring(b, 2)")).alias("definition"))
    return done.groupBy("key").agg(F.max_by("definition", "target").alias("definition")).withColumn("source", F.lit("derived"))
