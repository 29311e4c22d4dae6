"""Column expressions for lookup keys, tokens and scripts. All run inside the JVM except NFC."""

from __future__ import annotations

import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: Dashes that become a hyphen-minus, and blanks that become a space, in keys.
KEY_DASHES = "\u2010\u2011\u2012\u2013\u2212"
KEY_BLANKS = "\u00a0\u202f"
#: Coverage folds two more dashes.
LOOKUP_DASHES = KEY_DASHES + "\u2014\u2015"
STRESS = "\u0300\u0301\u0340\u0341"
MAX_KEY = 220

#: White space as Python's str.split sees it; valid in Java and RE2.
WS = r"[\t-\r\x1c- \x{85}\p{Z}]+"
#: A word: letters and digits, joined by single hyphens or apostrophes.
TOKEN = "[\\p{L}\\p{N}]+(?:[-'’][\\p{L}\\p{N}]+)*"
#: Letters that make a string a lookup key.
KEY_LETTER = r"[A-Za-z\x{c0}-\x{24f}\x{1e00}-\x{1eff}\x{370}-\x{3ff}\x{400}-\x{52f}]"
CYRILLIC = r"[\x{400}-\x{52f}]"
LATIN = r"[A-Za-z\x{c0}-\x{24f}\x{1e00}-\x{1eff}]"
GREEK = r"[\x{370}-\x{3ff}]"


def stress_table() -> tuple[str, str]:
    """Precomposed letters with a stress mark and the same letters without it (by rule)."""
    source, target = [], []
    for code in (*range(0xC0, 0x250), *range(0x370, 0x530), *range(0x1E00, 0x2000)):
        c = chr(code)
        d = unicodedata.normalize("NFD", c)
        if any(m in STRESS for m in d[1:]):
            bare = unicodedata.normalize("NFC", "".join(m for m in d if m not in STRESS))
            if len(bare) == 1:
                source.append(c)
                target.append(bare)
    return "".join(source), "".join(target)


STRESSED, UNSTRESSED = stress_table()

#: Text that NFC may change: combining marks and characters with a canonical singleton.
_NOT_NFC = r"[\x{300}-\x{36f}\x{374}\x{37e}\x{387}\x{483}-\x{487}\x{1f71}-\x{1fff}\x{2000}\x{2001}\x{2126}\x{212a}\x{212b}]"


@lru_cache(maxsize=1)
def _nfc():
    """The Arrow function, made at first use, as a return type needs a session to be parsed."""

    @F.pandas_udf(StringType())
    def compose(s):
        return s.map(lambda x: x if x is None else unicodedata.normalize("NFC", x))

    return compose


def nfc(c: Column) -> Column:
    """Canonical composition. Only text that may change is sent to Python; the rest stays in the JVM."""
    return F.coalesce(_nfc()(F.when(c.rlike(_NOT_NFC), c)), c)


def bind(fields: dict[str, Column], body) -> Column:
    """``body`` of the fields, each evaluated once per row.

    The optimizer merges neighbouring projections and then evaluates an expression at every
    use; what a lambda variable holds is computed one time.
    """
    row = F.struct(*[v.alias(k) for k, v in fields.items()])
    return F.transform(F.array(row), body)[0]


def keep_rows(df, condition: Column):
    """``df.where(condition)`` that stays where it is.

    A filter is pushed below the projections that compute its columns and evaluates them a
    second time; so is what an inner generator implies. Nothing is pushed below an outer one.
    """
    names = [F.col(f"`{c}`") for c in df.columns]
    hit = F.when(condition, F.array(F.lit(True)))
    return df.select(*names, F.explode_outer(hit).alias("_kept")).where("_kept").drop("_kept")


def unnest(df, items: Column, name: str, *columns: str):
    """``columns`` and one row for each item of an array that is computed once (see :func:`keep_rows`); items are not null."""
    return df.select(F.explode_outer(items).alias(name), *columns).where(F.col(name).isNotNull())


def casefold(c: Column) -> Column:
    return F.replace(F.lower(c), F.lit("ß"), F.lit("ss"))


def collapse(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, WS, " "))


def strip(c: Column) -> Column:
    """Without white space at both ends (Unicode blanks too)."""
    return F.regexp_replace(c, f"^{WS}|{WS}$", "")


def strip_chars(c: Column, chars: str) -> Column:
    """Without any of ``chars`` at both ends; a hyphen must come last."""
    return F.regexp_replace(c, f"^[{chars}]+|[{chars}]+$", "")


def capital(c: Column) -> Column:
    """The first letter in upper case."""
    return F.concat(F.upper(F.substring(c, 1, 1)), F.substring(c, F.lit(2), F.length(c)))


def leading_group(text: Column) -> Column:
    """``struct(meta, rest)`` of a text that begins with a balanced bracket of any depth, else null.

    Both parts have collapsed blanks; ``rest`` has no blanks or ``,;:`` and dashes before it.
    Null as well if a part is empty. Only texts that begin with a bracket are scanned.
    """
    t = F.regexp_replace(text, f"^{WS}", "")
    first = F.substring(t, 1, 1)

    def scan(chars: Column, opening: str, closing: str) -> Column:
        start = F.struct(F.lit(0).alias("depth"), F.lit(0).alias("at"), F.lit(0).alias("end"))

        def step(a: Column, c: Column) -> Column:
            depth = a["depth"] + F.when(c == opening, 1).when(c == closing, -1).otherwise(0)
            here = a["at"] + 1
            end = F.when((c == closing) & (depth == 0), here).otherwise(0)
            return F.when(a["end"] > 0, a).otherwise(F.struct(depth.alias("depth"), here.alias("at"), end.alias("end")))

        return F.aggregate(chars, start, step, lambda a: a["end"])

    end = F.when(first == "(", scan(F.split(t, ""), "(", ")")).when(first == "[", scan(F.split(t, ""), "[", "]"))

    def parts(s: Column) -> Column:
        meta = collapse(F.substring(s["t"], F.lit(2), s["end"] - 2))
        rest = F.regexp_replace(collapse(F.substring(s["t"], s["end"] + 1, F.length(s["t"]))), "^[ ,;:—–-]+", "")
        return F.when((s["end"] > 0) & (meta != "") & (rest != ""), F.struct(meta.alias("meta"), rest.alias("rest")))

    return F.when(first.isin("(", "["), bind({"t": t, "end": end}, parts))


def _fold_signs(c: Column, dashes: str) -> Column:
    return F.translate(c, dashes + KEY_BLANKS, "-" * len(dashes) + " " * len(KEY_BLANKS))


def normalize_key(c: Column, composed: bool = False) -> Column:
    """Stored form of a key: NFC, plain hyphens and single blanks. Case and ё stay; the em dash stays."""
    return collapse(_fold_signs(c if composed else nfc(c), KEY_DASHES))


def is_lookup_key(key: Column) -> Column:
    """Whether a normalised key can be looked up; false for null."""
    ok = (
        (F.length(key) > 0)
        & (F.length(key) <= MAX_KEY)
        & ~key.rlike(r"[\x00\r\n]")
        & ~key.startswith("-")
        & ~key.endswith("-")
        & key.rlike(KEY_LETTER)
    )
    return F.coalesce(ok, F.lit(False))


def normalize_lookup(c: Column, composed: bool = False) -> Column:
    """Form in which coverage compares words: all dashes, case and ё folded."""
    return F.replace(casefold(collapse(_fold_signs(c if composed else nfc(c), LOOKUP_DASHES))), F.lit("ё"), F.lit("е"))


def strip_stress(c: Column) -> Column:
    """Without stress marks; other marks (й, ё) survive."""
    return F.translate(F.regexp_replace(c, f"[{STRESS}]", ""), STRESSED, UNSTRESSED)


def alias_candidates(
    key: Column, *, use_case: bool = True, use_yo: bool = True, use_accent: bool = True, fast: bool = False
) -> Column:
    """Spellings under which a normalised key is also found, applied one upon the other.

    ``fast`` strips stress only if the key itself has a combining mark, so that a
    precomposed letter keeps its accent.
    """
    out = F.array(key)
    if use_case:
        out = F.array_distinct(F.concat(out, F.transform(out, casefold)))
    if use_yo:
        out = F.array_distinct(F.concat(out, F.transform(out, lambda x: F.translate(x, "ёЁ", "еЕ"))))
    if use_accent:
        with_accent = F.array_distinct(F.concat(out, F.transform(out, strip_stress)))
        out = F.when(key.rlike(r"[\x{300}-\x{36f}]"), with_accent).otherwise(out) if fast else with_accent
    return F.filter(out, is_lookup_key)


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(TOKEN), F.lit(0))


def script_of(token: Column) -> Column:
    """cyrillic, latin, greek, other-alphabet, mixed or numeric."""
    c, la, g = token.rlike(CYRILLIC), token.rlike(LATIN), token.rlike(GREEK)
    n = c.cast("int") + la.cast("int") + g.cast("int")
    return (
        F.when(n > 1, "mixed")
        .when(c, "cyrillic")
        .when(la, "latin")
        .when(g, "greek")
        .when(token.rlike(r"\p{L}"), "other-alphabet")
        .otherwise("numeric")
    )


def ngrams(words: Column, low: int = 1, high: int = 4) -> Column:
    """Runs of ``low`` to ``high`` neighbouring words, joined by blanks."""

    def of(w: Column, n: int) -> Column:
        none = F.array().cast("array<int>")
        starts = F.when(F.size(w) >= n, F.sequence(F.lit(1), F.size(w) - n + 1)).otherwise(none)
        return F.transform(starts, lambda i: F.array_join(F.slice(w, i, n), " "))

    return bind({"w": words}, lambda s: F.flatten(F.array(*[of(s["w"], n) for n in range(low, high + 1)])))


def base_title(title: Column) -> Column:
    """A page title without its qualifier in brackets."""
    return F.regexp_replace(title, r"\s+\([^()]*\)$", "")
