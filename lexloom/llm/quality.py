"""Problem 8: statistics that tell prose from lists, tables and junk, and the rules on them.

All statistics are native column expressions; the rule list is fitted on a bounded sample
of labelled documents, exported as one CASE expression and applied in the same scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexloom.llm import irep
from lexloom.runtime import Workspace, spread
from lexloom.sources.tables import table

#: A word is common if it makes up at least this share of all words; so there are at most 1000.
COMMON_SHARE = 0.001
#: Labelled documents used to fit; the ones of smallest hashed id.
MAX_LABELLED = 6000

#: Signs of ordinary writing.
_ORDINARY = r".,;:!?…«»„“”\"'’()—–\-"


def _words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def _lines(text: Column) -> Column:
    return F.filter(F.transform(F.split(text, r"[\r\n]+"), F.trim), lambda x: x != "")


def _bind(fields: dict[str, Column], body) -> Column:
    """``body`` of the fields, each evaluated once.

    The optimizer merges neighbouring projections and would repeat an expression at every
    use; a lambda variable is a value, so what it holds is computed one time per row.
    """
    row = F.struct(*[v.alias(k) for k, v in fields.items()])
    return F.transform(F.array(row), body)[0]


def _share(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part.cast("double") / whole).otherwise(F.lit(0.0))


def common_words(df: DataFrame, text_col: str = "text", share: float = COMMON_SHARE) -> list[str]:
    """Words that make up at least ``share`` of all words of the corpus, most frequent first.

    Counted over all texts with a map-side combine. At most ``1 / share`` words can reach
    the share, which bounds the result that comes to the driver.
    """
    words = spread(df.select(F.col(text_col).alias("t"))).select(F.explode(_words(F.col("t"))).alias("w"))
    counts = words.groupBy("w").agg(F.count(F.lit(1)).alias("n"))
    counts = Workspace(df.sparkSession, "words").keep(counts, "counts")  # read twice below
    total = counts.agg(F.sum("n")).first()[0] or 0
    top = counts.where(F.col("n") >= total * share).orderBy(F.desc("n"), "w")
    return [r["w"] for r in top.collect()]


#: The statistics the rules may use, in the order in which ties are broken.
FEATURES = (
    "mean_word_length", "symbol_ratio", "end_punct_share", "common_share", "digit_ratio", "words_per_line",
    "marked_line_share", "cell_line_share", "number_end_share", "distinct_word_rate", "run_share",
    "broken_word_share", "sign_rate", "comma_rate", "stop_rate", "separator_rate", "short_line_share",
    "distinct_line_share", "same_cells_share", "word_digit_share", "words_per_segment", "line_count",
)


def _formulas(q: Column, common: list[str], wanted) -> dict[str, Column]:
    """The wanted statistics over the parts of a text (see :func:`statistics_of`)."""
    x, signs, words, text_lines = q["p"]["text"], q["p"]["signs"], q["p"]["words"], q["p"]["lines"]
    n, lines, chars = q["n"], q["lines"], q["chars"]
    vis = chars + F.length(signs)

    def line_share(pattern: str) -> Column:
        return _share(F.size(F.filter(text_lines, lambda s: s.rlike(pattern))), lines)

    def signs_of(pattern: str) -> Column:
        return F.regexp_count(signs, F.lit(pattern))

    common_n = F.size(F.filter(words, lambda w: w.isin(common))) if common else F.lit(0)
    stats = {
        "word_count": n,
        "line_count": lines,
        "mean_word_length": _share(chars, n),
        "symbol_ratio": _share(signs_of(f"[^{_ORDINARY}]"), vis),
        "end_punct_share": line_share(r"[.!?…:;,»”\"')]$"),
        "common_share": _share(common_n, n),
        "digit_ratio": _share(F.regexp_count(x, F.lit("[0-9]")), vis),
        "words_per_line": _share(n, lines),
        "marked_line_share": line_share(r"^(?:[*•·–—+-]\s|\[[ xXхХ]?\]|\(?\p{N}{1,4}[.)]\s|\p{L}[.)]\s)"),
        "cell_line_share": line_share(r"\t\S|\S {3,}\S|\|.*\||^[^;]*;[^; ][^;]*;[^; ]|^\+-+\+|^[^,\s]+,[^,\s]+,[^,\s]"),
        "number_end_share": line_share(r"(?:\.{3,}|\s)\s*\p{N}+[|\s]*$"),
        "distinct_word_rate": _share(F.size(F.array_distinct(words)), F.least(n, F.lit(60))),
        "run_share": _share(F.length(x) - F.length(F.regexp_replace(x, r"(\S)\1{4,}", "")), vis),
        "broken_word_share": _share(
            F.regexp_count(x, F.lit(r"[^\p{L}\p{M}\p{Cf}\s'’ʼ—–.,;:\-|/](?<=\p{L}.)[^\s\p{L}]*\p{L}")), n
        ),
        "sign_rate": _share(F.length(signs), n),
        "comma_rate": _share(signs_of(","), n),
        "stop_rate": _share(F.regexp_count(x, F.lit(r"[.!?…](?<=[\p{L}»”\")].)(?=\s|$)")), n),
        "separator_rate": _share(signs_of("[|;]"), n),
        "short_line_share": _share(F.size(F.filter(text_lines, lambda s: F.length(s) < 36)), lines),
        "distinct_line_share": _share(F.size(F.array_distinct(text_lines)), lines),
        "same_cells_share": F.when(
            lines > 1,
            _bind(
                {"c": F.transform(text_lines, lambda s: F.regexp_count(s, F.lit(r"[|;\t,]| {3,}")))},
                lambda r: _share(F.size(F.filter(r["c"], lambda c: (c > 0) & (c == r["c"][1]))), lines),
            ),
        ).otherwise(F.lit(0.0)),
        "word_digit_share": _share(F.regexp_count(x, F.lit(r"[0-9](?:(?<=\p{L}.)|(?=\p{L}))")), n),
        "words_per_segment": _share(n, signs_of("[,;|.!?…:]") + lines),
    }
    return {k: stats[k] for k in wanted}


def statistics_of(text: Column, common: list[str], wanted, body) -> Column:
    """``body`` of a struct with the ``wanted`` statistics of ``text``; others are not computed."""
    t = F.coalesce(text.cast("string"), F.lit(""))
    parts = {
        "text": t,
        # what is left without letters, digits and blanks is short, so signs are counted there
        "signs": F.regexp_replace(t, r"[\p{L}\p{N}\s\p{Z}]+", ""),
        "words": _words(t),
        "lines": _lines(t),
    }

    def sizes(p: Column) -> Column:
        more = {
            "p": p,
            "n": F.size(p["words"]),
            "lines": F.size(p["lines"]),
            "chars": F.aggregate(p["words"], F.lit(0), lambda a, w: a + F.length(w)),
        }
        return _bind(more, lambda q: _bind(_formulas(q, common, wanted), body))

    return _bind(parts, sizes)


def text_statistics(df: DataFrame, common: list[str], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col`` and per-document statistics, one row per input row.

    ``word_count``, ``mean_word_length`` (characters), ``symbol_ratio`` (characters that are
    neither letters, digits, blanks nor ordinary punctuation), ``end_punct_share`` (lines
    that end in punctuation), ``common_share`` (words among the common ones), and the
    further ones named in ``FEATURES``. Null, empty and blank texts have zero counts and
    shares. Repeated rows stay repeated; other columns are ignored.
    """
    names = ("word_count", *FEATURES)
    s = statistics_of(F.col(text_col), common, names, lambda v: v)
    out = spread(df.select(id_col, text_col)).select(F.col(id_col), s.alias("s"))
    return out.select(F.col(id_col), *[F.col(f"s.{n}").alias(n) for n in names])


def fit_rules(
    docs: DataFrame,
    labels: DataFrame,
    common: list[str],
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "kind",
    max_labelled: int = MAX_LABELLED,
) -> irep.RuleList:
    """Rule list from at most ``max_labelled`` labelled documents (those of least hashed id)."""
    import numpy as np

    wanted = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("string").alias("label"))
    wanted = wanted.where("id is not null and label is not null")
    sample = wanted.orderBy(F.xxhash64("id"), "id", "label").limit(max_labelled)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    texts = rows.join(F.broadcast(sample), "id").where(F.length(F.trim("text")) > 0)  # at most max_labelled rows
    stats = text_statistics(texts, common, "id", "text")
    got = stats.join(F.broadcast(sample), "id").select("label", *FEATURES).toPandas()
    got = got.sort_values(["label", *FEATURES], kind="stable")
    return irep.fit(got[list(FEATURES)].to_numpy(np.float64), got["label"].to_numpy(), list(FEATURES))


def document_kinds(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", leave_out: str | None = None
) -> DataFrame:
    """``(id_col, kind)`` of every document that has text, by rules fitted on the labels.

    Null, empty and blank texts have no kind and no row. Without any label the result is
    empty. Documents of the kind ``leave_out`` give no row; they are left out by the
    generator that evaluates the kind, as a filter would be pushed down and evaluate it again.
    """
    common = common_words(docs, text_col)
    rules = fit_rules(docs, labels, common, id_col=id_col, text_col=text_col)
    texts = docs.select(id_col, text_col).where(F.col(text_col).rlike(r"[^\s\p{Z}\p{Cc}\p{Cf}]"))
    used = sorted({c.feature for r in rules.rules for c in r.conditions}) or [FEATURES[0]]
    kind = statistics_of(F.col(text_col), common, used, rules.column)
    kept = F.filter(F.array(kind), lambda k: k != F.lit(leave_out or ""))
    out = spread(texts).select(F.col(id_col), F.explode(kept).alias("kind"))
    return out if rules.default else out.limit(0)


def p8_found(spark: SparkSession, data_dir: str) -> DataFrame:
    """Documents that are for the most part not natural prose, with their kind."""
    docs, labels = table(spark, data_dir, "documents"), table(spark, data_dir, "doc_labels")
    return document_kinds(docs, labels, leave_out="prose")


def p8_stats(spark: SparkSession, data_dir: str) -> DataFrame:
    """The five named statistics of every document."""
    docs = table(spark, data_dir, "documents")
    return text_statistics(docs, common_words(docs)).select(
        "doc_id", "word_count", "mean_word_length", "symbol_ratio", "end_punct_share", "common_share"
    )
