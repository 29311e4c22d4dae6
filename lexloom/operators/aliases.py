"""Textual redirects (``то же, что ..``, ``см. ..``, ``вариант ..``) as alias formulas.

A formula is taken apart by column expressions in a chain of projections; texts that begin
with no redirect phrase leave the chain after two anchored patterns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexloom.functions import native
from lexloom.functions import patterns as P

_EDGE = r" .;:—–-"
_PREFIX = f"(?iu){P.ALIAS_PREFIX}"
_BARE = f"(?iu){P.ALIAS_BARE}"


def _edges(c: Column) -> Column:
    return F.regexp_replace(c, f"^[{_EDGE}]+|[{_EDGE}]+$", "")


def _row(text: Column) -> dict[str, Column]:
    """Kind and body of a compact text; null if it is no redirect."""
    full = text.rlike(_PREFIX)
    bare = ~full & text.rlike(_BARE)
    kind = F.when(full, native.casefold(native.collapse(F.regexp_extract(text, _PREFIX, 1)))).when(bare, F.lit("вариант"))
    body = F.when(full, F.regexp_extract(text, _PREFIX, 2)).when(bare, F.regexp_extract(text, _BARE, 1))
    return {"kind": kind, "body": _edges(native.collapse(body)), "bare": bare}


def formula(text: Column) -> Column:
    """``struct(kind, candidates, tail, body)`` of a redirect, else null; ``text`` is compact.

    ``candidates`` are the target words as keys, ``tail`` is the meaning that follows them.
    Long phrases after ``вариант формы`` are prose, not redirects.
    """

    def open_body(r: Column) -> Column:
        prose = r["kind"].startswith("вариант формы") & (F.size(F.split(r["body"], " ")) > 4)
        body = native.strip(F.regexp_replace(r["body"], f"(?iu){P.ALIAS_POS}", ""))
        return F.when(
            ~prose & (body != ""), native.bind({"kind": r["kind"], "bare": r["bare"], "body": body}, named)
        )

    def named(r: Column) -> Column:
        wants = r["kind"].rlike("^вариант (?:названия|именования|написания|имени)")
        name = F.when(wants, native.strip(F.regexp_extract(r["body"], P.ALIAS_NAMED, 1)))
        at_semicolon = F.regexp_extract(r["body"], r"(?s)^([^;]*);(.*)$", 2)
        at_comma = F.regexp_extract(r["body"], r"(?s)^([^,]*),(.*)$", 2)
        first_word = F.substring_index(r["body"], " ", 1)
        after_word = F.substring(r["body"], F.length(first_word) + 2, F.length(r["body"]))
        left_semicolon = native.strip(F.substring_index(r["body"], ";", 1))
        by_semicolon = r["body"].contains(";") & (left_semicolon != "") & (native.strip(at_semicolon) != "")
        by_comma = ~r["body"].contains(";") & r["body"].contains(",") & native.strip(at_comma).rlike(P.ALIAS_CLASS)
        by_word = (
            ~by_semicolon & ~by_comma & r["kind"].startswith("то же") & native.strip(after_word).rlike(P.ALIAS_CLASS)
            & ~first_word.contains(";") & native.is_lookup_key(native.normalize_key(first_word, composed=True))
        )
        is_named = F.coalesce(name, F.lit("")) != ""
        target = (
            F.when(is_named, name).when(by_semicolon, left_semicolon).when(by_comma, native.strip(F.substring_index(r["body"], ",", 1)))
            .when(by_word, first_word).otherwise(r["body"])
        )
        tail = (
            F.when(is_named, F.lit("")).when(by_semicolon, native.strip(at_semicolon)).when(by_comma, native.strip(at_comma))
            .when(by_word, native.strip(after_word)).otherwise(F.lit(""))
        )
        return native.bind({"kind": r["kind"], "bare": r["bare"], "body": r["body"], "target": target, "tail": tail}, split)

    def split(r: Column) -> Column:
        listed = r["kind"].startswith("см") & r["target"].rlike(P.ALIAS_LIST)
        words = (
            F.when(r["bare"], F.array(r["target"]))
            .when(listed, F.split(r["target"], r"(?iu)\s*,\s*|\s+или\s+|\s+и\s+"))
            .when(r["kind"].rlike("^(?:к|гипокор|уменьш|димин|см)"), F.split(r["target"], r"(?iu)\s*,\s*|\s+или\s+"))
            .when(r["kind"].startswith("то же"), F.split(r["target"], ","))
            .otherwise(F.array(r["target"]))
        )
        keys = F.filter(F.transform(words, lambda w: native.normalize_key(_edges(native.strip(w)), composed=True)), native.is_lookup_key)
        return native.bind(
            {"c": keys, "r": r},
            lambda x: F.when(
                (F.size(x["c"]) > 0) | (x["r"]["tail"] != ""),
                F.struct(x["r"]["kind"].alias("kind"), x["c"].alias("candidates"), x["r"]["tail"].alias("tail"), x["r"]["body"].alias("body")),
            ),
        )

    begins = text.rlike(f"(?iu){P.ALIAS_BEGIN}")
    return F.when(begins, native.bind(_row(text), lambda r: F.when(r["body"] != "", open_body(r))))


def is_formula(text: Column) -> Column:
    return formula(text).isNotNull()


def fallback(parsed: Column) -> Column:
    """The meaning a redirect carries itself when its targets have no article: its tail, or a long synonym phrase."""
    strip = lambda c: F.regexp_replace(c, r"^[ .;,:—–-]+|[ .;,:—–-]+$", "")
    tail, body = strip(parsed["tail"]), strip(parsed["body"])
    long_enough = parsed["kind"].startswith("то же") & (F.length(body) >= 12) & (body.contains(" ") | body.contains(","))
    text = F.when(tail != "", tail).when(long_enough, body)
    bad = text.rlike(f"(?iu){P.EMPTY_META}") | text.rlike(f"(?iu){P.FRAGMENT}")
    return F.when((text != "") & ~bad, native.capital(native.collapse(text)))


def target_key(candidate: Column) -> Column:
    """A candidate without superscripts, part-of-speech marks and the nouns ``слово``, ``имя``, ``название``."""
    strip = lambda c: F.regexp_replace(c, r"^[ .;,:—–-]+|[ .;,:—–-]+$", "")
    c = F.regexp_replace(strip(candidate), r"[ᴵᐟ¹²³⁴⁵⁶⁷⁸⁹⁰]+$", "")
    c = strip(F.regexp_replace(c, f"(?iu){P.ALIAS_POS}", ""))
    return native.strip(F.regexp_replace(c, r"(?iu)^(?:слово|слова|имя|имени|название)\s+", ""))


def resolve(rows: DataFrame, parsed: str, links: DataFrame, lemmas: DataFrame) -> DataFrame:
    """``(seq, target)``: lemmas with an article that the candidates of a formula lead to.

    ``rows`` has ``seq``, ``lemma`` and the struct column ``parsed``. A candidate is looked up
    under all its spellings, with and without a qualifier in brackets, as a lemma and as a
    link; the row's own lemma is no target.
    """
    c = rows.select("seq", "lemma", F.explode(f"{parsed}.candidates").alias("c")).select("seq", "lemma", target_key(F.col("c")).alias("c"))
    both = F.array_distinct(F.array("c", F.when(F.col("c").endswith(")"), F.regexp_replace("c", r" \(.*$", "")).otherwise(F.col("c"))))
    keys = c.select("seq", "lemma", F.explode(both).alias("k")).select("seq", "lemma", native.normalize_key(F.col("k"), composed=True).alias("k"))
    return lookup(keys.where(native.is_lookup_key(F.col("k"))), links, lemmas)


def lookup(keys: DataFrame, links: DataFrame, lemmas: DataFrame) -> DataFrame:
    """``(seq, target)`` of ``(seq, lemma, k)``: lemmas reachable from any spelling of ``k``, the own lemma left out."""
    forms = keys.select("seq", "lemma", F.explode(native.alias_candidates(F.col("k"))).alias("k")).distinct()
    direct = forms.join(lemmas.select(F.col("lemma").alias("target")), F.col("k") == F.col("target"))
    linked = forms.join(links.select(F.col("key").alias("k"), F.col("lemma").alias("target")), "k").join(
        lemmas.select(F.col("lemma").alias("target")), "target", "left_semi"
    )
    hits = direct.select("seq", "lemma", "target").unionByName(linked.select("seq", "lemma", "target"))
    own = native.normalize_key(F.col("lemma"), composed=True)
    return hits.where(native.normalize_key(F.col("target"), composed=True) != own).select("seq", "target").distinct()
