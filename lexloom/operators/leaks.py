"""What must never be visible in a finished article: markup, labels, examples, grammar, placeholders."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexloom.functions import native
from lexloom.functions import patterns as P

#: Stems of subject names that betray a bracket of context.
CONTEXT_ROOTS = (
    "земельн прав юрид физик математ хим медиц биолог техник электр механ информат эконом финанс геол строит воен лингв"
).split()
_NAMES = "|".join(P.LABELS)
LABEL = rf"^(?:[\[(](?:{_NAMES})\.(?:\s*[,;/]\s*(?:{_NAMES})\.)*[\])]|(?:{_NAMES})\.)"
CONTEXT = (
    rf"^[\[(](?:{'|'.join(P.CONTEXT_STARTS)})[^\p{{L}}\p{{N}}_\])][^\])]{{0,90}}(?:{'|'.join(CONTEXT_ROOTS)})[^\])]{{0,60}}[\])]"
)
RESIDUE = r"[◆◇]|\[НКРЯ\]|\{\{|\[\["
FRAGMENT = r"^(?:гора|город|река|деревня|село|пос[ёе]лок|округ|область)\s+(?:в|на|из)$"


def line_faults(line: Column) -> dict[str, Column]:
    """Tests of one line of an article, without its number, by name."""
    like = lambda p: line.rlike("(?iu)" + p)
    return {
        "residue": like(RESIDUE),
        "html": like(P.MARKUP.removesuffix(r"|\{\{|\[\[")),
        "label": like(LABEL),
        "context": like(CONTEXT),
        "placeholder": like(P.EMPTY_META) | like(FRAGMENT),
        "grammar": reduce(lambda a, b: a | b, [like(p) for p in P.FORM_OF[:1]]) | like(P.GRAMMAR),
    }


def leaked_lines(articles: DataFrame, key: str = "lemma", article: str = "article") -> DataFrame:
    """``(key, line, fault)`` of every line that is no meaning; blank lines are passed over, a line may have several faults."""
    lines = articles.select(key, F.explode(F.split(F.coalesce(article, F.lit("")), r"\r?\n")).alias("line"))
    lines = lines.select(key, native.strip(F.regexp_replace("line", r"^\s*\d+\.\s*", "")).alias("line")).where("line <> ''")
    found = F.array_compact(F.array(*[F.when(v, F.lit(k)) for k, v in line_faults(F.col("line")).items()]))
    return native.unnest(lines.withColumn("_f", found), F.col("_f"), "fault", key, "line").select(key, "line", "fault")
