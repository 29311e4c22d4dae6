"""Problem 2: one consistent spelling for strings that look the same.

For every character of a token the set of scripts that have a letter of this shape is
resolved; the sets are intersected across the token:

* one script left - the token is spelled in it (a mixed-script token is repaired, a plain
  one stays as it is);
* several left - a whole-script confusable, spelled in the first of ``SCRIPT_ORDER``;
* none left - the scripts are really mixed; each letter takes the first script of its own
  set, so that all spellings of the token still meet.

Every step depends on the shapes alone, never on which of the look-alikes was typed, so
two strings have the same canonical form exactly when they look the same under the rules.
Case, stress marks, other diacritics, and blank against hyphen stay different.
"""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexloom.llm.textwords import INVISIBLE
from lexloom.runtime import Workspace
from lexloom.sources.tables import table

SCRIPT_ORDER = ("latin", "cyrillic", "greek", "armenian", "cherokee")

#: Letters of one shape, as (latin, cyrillic, greek, armenian, cherokee), after the published list of
#: confusable characters; "" where a script has none, and several letters where one script has the shape more than once.
SAME_SHAPE = (
    ("aɑ", "а", "α", "", ""), ("b", "", "", "", "Ꮟ"), ("c", "с", "ϲ", "", ""), ("d", "ԁ", "", "", "Ꮷ"), ("e", "е", "", "", ""),
    ("gɡ", "", "", "ց", ""), ("h", "һ", "", "հ", "Ꮒ"), ("i", "і", "ι", "", ""), ("j", "ј", "ϳ", "յ", ""), ("l", "ӏ", "", "", ""),
    ("n", "", "", "ո", ""), ("o", "о", "ο", "օ", ""), ("p", "р", "ρ", "", ""), ("q", "ԛ", "", "զ", ""), ("s", "ѕ", "", "", ""),
    ("u", "", "υ", "ս", ""), ("v", "ѵ", "ν", "", ""), ("w", "ԝ", "", "", ""), ("x", "х", "", "", ""), ("y", "уү", "γ", "", "Ꭹ"),
    ("A", "А", "Α", "", "Ꭺ"), ("B", "В", "Β", "", "Ᏼ"), ("C", "С", "Ϲ", "", "Ꮯ"), ("D", "", "", "", "Ꭰ"), ("E", "Е", "Ε", "", "Ꭼ"),
    ("G", "Ԍ", "", "", "Ꮐ"), ("H", "Н", "Η", "", "Ꮋ"), ("I", "ІӀ", "Ι", "", ""), ("J", "Ј", "Ϳ", "", "Ꭻ"), ("K", "К", "Κ", "", "Ꮶ"),
    ("L", "", "", "", "Ꮮ"), ("M", "М", "Μ", "", "Ꮇ"), ("N", "", "Ν", "", ""), ("O", "О", "Ο", "Օ", ""), ("P", "Р", "Ρ", "", "Ꮲ"),
    ("Q", "Ԛ", "", "", ""), ("R", "", "", "", "ᎡᏒ"), ("S", "Ѕ", "", "Տ", "ᏕᏚ"), ("T", "Т", "Τ", "", "Ꭲ"), ("U", "", "", "Ս", ""),
    ("V", "Ѵ", "", "", "Ꮩ"), ("W", "Ԝ", "", "", "ᎳᏔ"), ("X", "Х", "Χ", "", ""), ("Y", "УҮ", "Υ", "", ""), ("Z", "", "Ζ", "", "Ꮓ"),
    ("ə", "ә", "", "", ""), ("Ə", "Ә", "", "", ""), ("ĸ", "к", "κ", "", ""), ("", "Г", "Γ", "", ""), ("", "П", "Π", "", ""),
    ("", "Ф", "Φ", "", ""), ("ʜ", "н", "", "", ""), ("ᴍ", "м", "", "", ""), ("ᴛ", "т", "", "", ""), ("ʙ", "в", "", "", ""),
    ("ɢ", "ԍ", "", "", ""),
)

#: Kinds of hyphen.
HYPHENS = "-˗‐‑‒–⁃−﹘﹣－"

#: Spellings of one form that a part of the pair join holds on its right side.
SPELLINGS_PER_PART = 256

_GONE = re.compile(f"[{INVISIBLE}\u034f\ufe00-\ufe0f\U000e0000-\U000e0fff]")
_BLANKS = re.compile(r"[^\S\n]")
_LETTERS = re.compile(r"[^\W\d_]+")
#: Decomposition types that change nothing but width or breaking; font variants (mathematical letters), ligatures and
#: signs of Roman numerals are spelled out as well.
_WIDTHS = ("<wide>", "<narrow>", "<noBreak>")


def _shape_table() -> dict[str, dict[str, str]]:
    table_: dict[str, dict[str, str]] = {}
    for row in SAME_SHAPE:
        options = {s: c[0] for s, c in zip(SCRIPT_ORDER, row) if c}
        for c in "".join(row):
            table_[c] = options
    return table_


_SHAPES = _shape_table()


@lru_cache(maxsize=65536)
def scripts_of(char: str) -> dict[str, str]:
    """Scripts that have this shape, with the letter each of them uses for it."""
    known = _SHAPES.get(char)
    if known is not None:
        return known
    name = unicodedata.name(char, "").split(" ")[0].lower()
    return {name: char} if name else {"unknown": char}


@lru_cache(maxsize=65536)
def _fold_char(char: str) -> str:
    """Width, hyphens, blanks and ligatures of one character."""
    if char in HYPHENS:
        return "-"
    d = unicodedata.decomposition(char)
    if d:
        kind, *codes = d.split(" ")
        if kind in _WIDTHS or kind == "<font>" or kind == "<compat>" and re.search("LIGATURE|ROMAN NUMERAL", unicodedata.name(char, "")):
            return "".join(_fold_char(chr(int(c, 16))) for c in codes)
    if char.isspace():
        return " "
    return char


@lru_cache(maxsize=200_000)
def resolve_token(token: str) -> tuple[str, str]:
    """(consistent spelling, verdict) of a run of letters.

    The verdict is ``single`` (already in one script), ``mixed`` (look-alikes of another
    script were replaced), ``whole`` (all letters exist in several scripts) or
    ``unresolved`` (no script has all the shapes).
    """
    common: set[str] | None = None
    for c in token:
        s = scripts_of(c)
        common = set(s) if common is None else common & s.keys()
        if not common:
            break
    if not common:
        return "".join(next(iter(scripts_of(c).values())) for c in token), "unresolved"
    script = min(common, key=lambda s: SCRIPT_ORDER.index(s) if s in SCRIPT_ORDER else 9)
    out = "".join(scripts_of(c)[script] for c in token)
    if len(common) > 1:
        return out, "whole"
    return out, "single" if out == token else "mixed"


_RUNS = re.compile(r"(?:[^\W\d_][\u0300-\u036f]*)+")
_MARK = re.compile(r"[\u0300-\u036f]+")


def consistent_form(text: str) -> str:
    """The one spelling that stands for everything that looks like ``text``."""
    s = text
    if not s.isascii():
        s = _GONE.sub("", s)
        s = "".join(map(_fold_char, s))
        s = unicodedata.normalize("NFD", s)
    else:
        s = _BLANKS.sub(" ", s)
    s = s.strip()
    if _MARK.search(s):

        def run(m):
            token = m.group()
            bare = _MARK.sub("", token)
            spelled = iter(resolve_token(bare)[0])
            return "".join(c if "\u0300" <= c <= "\u036f" else next(spelled) for c in token)

        return unicodedata.normalize("NFC", _RUNS.sub(run, s))
    return _LETTERS.sub(lambda m: resolve_token(m.group())[0], s)


def with_consistent_form(df: DataFrame, text_col: str, out_col: str = "form") -> DataFrame:
    """``df`` plus ``out_col``, the consistent spelling of ``text_col`` (null for null).

    Empty and invisible-only strings have the empty form. Long strings are handled whole.
    An existing column named ``out_col`` is an error rather than silently replaced.
    """
    if out_col in df.columns:
        raise ValueError(f"the input already has a column {out_col!r}")

    @F.pandas_udf("string")
    def form(s):
        return s.map(lambda x: None if x is None else consistent_form(x))

    return df.withColumn(out_col, form(F.col(text_col).cast("string")))


def _forms(values: DataFrame) -> DataFrame:
    """(form, value) of a one-column DataFrame, nulls left out, by Arrow batches."""

    def run(batches):
        import pyarrow as pa

        for b in batches:
            v = b.column(0)
            f = pa.array([consistent_form(x) for x in v.to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([f, v], names=["form", "value"])

    one = values.select(F.col(values.columns[0]).cast("string").alias("value")).where("value is not null")
    return one.mapInArrow(run, "form string, value string")


def same_looking_pairs(values: DataFrame, workspace: Workspace) -> DataFrame:
    """Distinct pairs ``(form_a, form_b)``, ``form_a < form_b``, of values that look the same.

    ``values`` has one string column; nulls are left out and repeats count once. Values are
    made distinct with a map-side combine before they are grouped by form, so a value that
    holds a third of all rows is one row by then. Only forms with two spellings or more reach
    the pair join, where the spellings of a large form are dealt over parts.
    """
    several = workspace.keep(_forms(values).dropDuplicates(["form", "value"]), "forms")
    count = several.groupBy("form").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    rows = workspace.keep(several.join(count, "form"), "several")
    workspace.drop(several)
    # the right side of a form with many spellings is dealt over as many parts as it has blocks of spellings
    part = F.pmod(F.xxhash64("value"), F.ceil(F.col("n") / SPELLINGS_PER_PART)).cast("int")
    a = rows.select("form", F.col("value").alias("form_a"), F.explode(F.sequence(F.lit(0), (F.ceil(F.col("n") / SPELLINGS_PER_PART) - 1).cast("int"))).alias("part"))
    b = rows.select("form", F.col("value").alias("form_b"), part.alias("part"))
    return a.join(b, ["form", "part"]).where("form_a < form_b").select("form_a", "form_b")


def spelling_classes(values: DataFrame, workspace: Workspace) -> DataFrame:
    """``(form, spellings, least)`` of forms with two spellings or more: how many there are, and the smallest.

    What :func:`same_looking_pairs` says in at most one row per form, for uses that need no pairs.
    """
    several = workspace.keep(_forms(values).dropDuplicates(["form", "value"]), "forms")
    return several.groupBy("form").agg(F.count(F.lit(1)).alias("spellings"), F.min("value").alias("least")).where("spellings > 1")


def lookup_strings(links: DataFrame, packs: DataFrame) -> DataFrame:
    """All strings that lookups compare: link keys, pack words and pack aliases."""
    return (
        links.select(F.col("key").cast("string").alias("value"))
        .unionByName(packs.select(F.col("word").cast("string").alias("value")))
        .unionByName(packs.select(F.explode("aliases").alias("value")))
    )


def p2_found(spark: SparkSession, data_dir: str) -> DataFrame:
    """Pairs of different strings that look the same."""
    values = lookup_strings(table(spark, data_dir, "links"), table(spark, data_dir, "pack_entries"))
    return same_looking_pairs(values, Workspace(spark, "p2"))


def p2_forms(spark: SparkSession, data_dir: str) -> DataFrame:
    """Every distinct string with its consistent form."""
    values = lookup_strings(table(spark, data_dir, "links"), table(spark, data_dir, "pack_entries"))
    return _forms(values.where("value is not null").distinct())


def p2_classes(spark: SparkSession, data_dir: str) -> DataFrame:
    """Forms with several spellings, one row each."""
    values = lookup_strings(table(spark, data_dir, "links"), table(spark, data_dir, "pack_entries"))
    return spelling_classes(values, Workspace(spark, "p2c"))
