"""Display text of definitions as a chain of column expressions.

Only texts with entities, tags or composed characters go through Python (entities, NFC and
the HTML parser have no column expression); everything else stays in the JVM.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexloom.functions import native, rules
from lexloom.functions import patterns as P

_NEEDS_PYTHON = r"[&<]|" + native._NOT_NFC
_LINK = r"\[\[(?:[^\]|]+\|)?([^\]]+)\]\]"
_MARK = r"^(?:[#*:;-]+|\d+[.)])[\s\p{Z}]*"
_FORM_BEGIN = (
    r"(?iu)^\s*(?:страд|действ|прич|деепр|форма|словоформа|именительный|родительный|дательный|винительный|творительный|"
    r"предложный|единственное|множественное)"
)
_LABEL = rf"(?:{'|'.join(P.LABELS)})\."
_ONE = rf"(?:[\[(]{_LABEL}(?:\s*[,;/]\s*{_LABEL})*[\])]|{_LABEL}(?:\s*[,;/]\s*{_LABEL})*)\s*[:;,—-]?\s*"
LABELS = rf"(?iu)^(?:\s*{_ONE})+"
_IN_BRACKET = rf"\s*(?:{'|'.join(P.CONTEXT_STARTS)})(?![\p{{L}}\p{{N}}_])"
CONTEXT = rf"(?iu)^(?:\s*[\[(](?={_IN_BRACKET})(?=[^\])]*(?:{'|'.join(P.DOMAIN_ROOTS)}))[^\])]{{2,100}}[\])][ \s,;:—-]*)+"


def form_target(text: Column) -> Column:
    """Whether a text only names the word it is a form of."""
    hit = reduce(lambda a, b: a | b, [text.rlike("(?iu)" + p) for p in P.FORM_OF])
    return F.when(text.rlike(_FORM_BEGIN), hit).otherwise(F.lit(False))


def without_labels(text: Column) -> Column:
    """Without register and subject labels at the beginning, however many."""
    return F.regexp_replace(F.regexp_replace(text, LABELS, ""), "^[ ,;:—-]+", "")


def without_context(text: Column) -> Column:
    """Without brackets at the beginning that only tell the field of use."""
    return F.when(F.substring(text, 1, 1).isin("(", "["), F.regexp_replace(text, CONTEXT, "")).otherwise(text)


def capital_if_small(text: Column) -> Column:
    first = F.substring(text, 1, 1)
    return F.when(first.rlike(r"^\p{L}$") & (F.lower(first) == first), native.capital(text)).otherwise(text)


def _without_markup(df: DataFrame, keep: list[Column], raw: Column) -> DataFrame:
    """Entities, links, templates and tags; dashes and no-break spaces are folded."""
    t = F.col("_w")
    some = F.when(raw.rlike(_NEEDS_PYTHON), raw)
    step = df.select(*keep, F.coalesce(rules.text_rule("without_markup", some), native.strip(raw)).alias("_w"))
    inner = F.regexp_replace(t, _LINK, "$1")
    for _ in range(6):
        inner = F.regexp_replace(inner, r"\{\{[^{}]*\}\}", "")
    marked = t.contains("{{") | t.contains("[[") | t.contains("]]") | t.contains("__NOTOC__")
    step = step.select(*keep, F.when(marked, inner).otherwise(t).alias("_w"))
    cut = native.strip(F.substring_index(t, "{{", 1))
    plain = reduce(lambda c, m: F.replace(c, F.lit(m), F.lit(" ")), ("__NOTOC__", "[[", "]]"), F.when(t.contains("{{"), cut).otherwise(t))
    return step.select(*keep, native.strip(native._fold_signs(plain, native.KEY_DASHES)).alias("_w"))


def with_clean(df: DataFrame, column: str, out: str, markup: bool = True) -> DataFrame:
    """``df`` plus ``out``: the cleaned text of ``column``, ``""`` if it holds no meaning (or is null).

    Same results as :func:`lexloom.functions.rules.clean_definition`. ``markup=False`` is for
    texts that are known to hold none (because they were cleaned before).
    """
    keep = [F.col(f"`{c}`") for c in df.columns if c != out]
    raw = F.coalesce(F.col(f"`{column}`"), F.lit(""))
    t = F.col("_w")
    if markup:
        step = _without_markup(df, keep, raw)
    else:
        step = df.select(*keep, native.strip(raw).alias("_w"))
    bare = native.collapse(F.regexp_replace(t, _MARK, ""))
    step = step.select(*keep, F.regexp_replace(bare, r"^[ \t\r\n;,•]+|[ \t\r\n;,•]+$", "").alias("_w"))
    step = step.select(*keep, F.when(form_target(t), F.lit("")).otherwise(without_labels(t)).alias("_w"))
    step = step.select(*keep, capital_if_small(without_context(t)).alias("_w"))
    low = native.casefold(t)
    empty = low.isin(*P.PLACEHOLDERS) | ((F.length(t) < 220) & (form_target(t) | F.when(t.rlike(_FORM_BEGIN), t.rlike("(?iu)" + P.GRAMMAR)).otherwise(F.lit(False))))
    return step.select(*keep, F.when(empty, F.lit("")).otherwise(t).alias(out))
