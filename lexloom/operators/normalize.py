"""Normalisation of stored definitions: an ordered list of rewriting steps, all of them column expressions.

A step is a name and an expression over the current text; the chain is a sequence of
projections, so each text is computed once and the whole list runs as one map stage. The
names of the steps that changed a text are collected beside it. An empty text passes
through unchanged.
"""

from __future__ import annotations

import unicodedata
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexloom.functions import cleanup_patterns as C
from lexloom.functions import native
from lexloom.functions import patterns as P
from lexloom.operators import cleaning, quality

_U = "(?iuU)"  # any case, Unicode classes
_EDGE = " ,;:—–-"



def _is(c: Column, pattern: str) -> Column:
    return c.rlike(_U + pattern)


def _drop(c: Column, pattern: str, by: str = "") -> Column:
    return F.regexp_replace(c, _U + pattern, by)


def _left(c: Column, chars: str = _EDGE) -> Column:
    return F.regexp_replace(c, f"^[{chars}]+", "")


def _right(c: Column, chars: str) -> Column:
    return F.regexp_replace(c, f"[{chars}]+$", "")


def _from(c: Column, start: Column | int) -> Column:
    return F.substring(c, F.lit(start) if isinstance(start, int) else start, F.length(c))


def _bare_table() -> tuple[str, str]:
    """Letters with diacritics and their bare letters, by canonical decomposition."""
    pairs = []
    for code in (*range(0xC0, 0x250), *range(0x370, 0x530), *range(0x1E00, 0x2000)):
        d = unicodedata.normalize("NFD", chr(code))
        if len(d) > 1 and all(unicodedata.category(m) == "Mn" for m in d[1:]):
            pairs.append((chr(code), d[0]))
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


_ACCENTED, _BARE = _bare_table()


def bare_spelling(c: Column) -> Column:
    """A spelling without case, diacritics and punctuation around it."""
    folded = native.casefold(native.normalize_key(c, composed=True))
    return native.strip_chars(F.translate(F.regexp_replace(folded, r"\p{Mn}", ""), _ACCENTED, _BARE), " .,:;—–-")


def _ascii_share(c: Column) -> Column:
    letters = F.length(F.regexp_replace(c, r"[^\p{L}]", ""))
    return F.when(letters >= 2, F.length(F.regexp_replace(c, "[^A-Za-z]", "")) / letters).otherwise(F.lit(0.0))


def _place(prose: Column, context: Column, source: Column) -> Column:
    """Prose with a context set behind it unless it is there already; encyclopedia sentences end in a point."""
    body = _right(prose, ".!? ")
    more = F.when(F.lower(body).contains(F.lower(context)), body).otherwise(F.concat_ws(" ", body, context))
    return F.concat(_right(more, ".!? "), F.when(source.startswith("ruwiki"), ".").otherwise(""))


def bracket_rules(text: Column, meta: Column, rest: Column, lemma: Column, source: Column) -> list[tuple[Column, Column]]:
    """(condition, new text) pairs for a text ``(meta) rest``; the first that holds is applied."""
    low, low_rest = native.casefold(meta), native.casefold(rest)
    bare_meta, bare_lemma = bare_spelling(meta), bare_spelling(lemma)
    words = lambda c: F.concat(F.lit(" "), F.regexp_replace(native.casefold(c), "[^а-яёa-z0-9]+", " "), F.lit(" "))
    heads = F.element_at(F.create_map(*[F.lit(x) for kv in C.DEPENDENT_HEADS.items() for x in kv]), low)
    is_about = low.rlike("^(?:о|об|обо) ")
    dependent = low_rest.rlike(C.DEPENDENT_REST)
    called = native.collapse(F.regexp_extract(rest, _U + C.CALLED, 1))
    expanded = native.strip_chars(native.collapse(F.regexp_extract(rest, _U + C.ABBREVIATION, 1)), " .;,:—–-")
    in_range = text.rlike(_U + C.YEAR_RANGE)
    verb = F.regexp_extract(rest, _U + C.VERB_WORD, 0)
    return [
        ((bare_meta == bare_lemma) | ((bare_lemma != "") & bare_meta.contains(bare_lemma) & (F.length(meta) <= F.length(lemma) + 12)), rest),
        (_is(rest, C.SEMANTIC_CLASS) & ((_ascii_share(meta) >= 0.7) | (meta.rlike(C.COMPACT_SPELLING) & ~low.rlike("^(?:в|во|у|о|об) "))), rest),
        ((F.length(native.strip(lemma)) >= 2) & words(meta).contains(words(lemma)) & _is(F.substring(rest, 1, 120), C.PLACE_OR_NAME), rest),
        (expanded != "", native.capital(expanded)),
        (in_range, F.concat(_right(native.collapse(F.regexp_extract(text, _U + C.YEAR_RANGE, 2)), ".!? "), F.lit(" "),
                            native.collapse(F.regexp_extract(text, _U + C.YEAR_RANGE, 1)), F.lit("."))),
        (_is(low, C.YEAR_BEGIN) & _is(rest, C.PLACE_BEGIN), rest),
        (_is(low, C.REGISTER_BEGIN), rest),
        (meta.rlike("(?U)" + C.ACRONYM) & (F.length(rest) >= 12), rest),
        (F.length(native.strip(F.regexp_extract(rest, _U + C.CALLED, 1))) >= 12, native.capital(native.strip_chars(called, _EDGE))),
        (low.rlike("|".join(P.DOMAIN_ROOTS)) | _is(low, C.MORE_DOMAINS), rest),
        (is_about & (F.length(rest) >= 4) & ~dependent, rest),
        (is_about & dependent & heads.isNotNull(), F.concat(heads, F.lit(", "), rest)),
        (_is(low, C.USAGE_BEGIN), rest),
        (_is(low, C.SLOT) & (verb != ""), native.capital(F.concat_ws(" ", verb, meta, F.when(F.length(rest) > F.length(verb), native.strip(_from(rest, F.length(verb) + 1)))))),
        (_is(low, C.KEPT_ADJECTIVE), native.capital(F.concat_ws(" ", meta, rest))),
        (meta.rlike(C.PREFIX_NOTE) & rest.rlike("^[A-Za-zА-Яа-яЁё]"), native.capital(F.concat(F.regexp_replace(meta, "-$", ""), rest))),
        (_is(low, C.LANGUAGE_BEGIN), rest),
        (low.rlike("^(?:вероятно|возможно) ") & (F.length(rest) >= 8), rest),
        (low.startswith("говорят ") & low_rest.startswith("или "), native.capital(_left(_from(rest, 5)))),
        (low.isin(*C.DROPPED_METAS) & (F.length(rest) >= 8), rest),
        (low.startswith("при ") & (F.length(rest) >= 8), _place(rest, F.when(F.lower(rest).contains(F.lower(native.strip(_from(meta, 5)))), F.lit("")).otherwise(F.concat(F.lit("при "), native.strip(_from(meta, 5)))), source)),
        (low.rlike("^(?:в|во|у|согласно) "), _place(rest, meta, source)),
        (low.isin(*C.JOINED_METAS), native.capital(F.concat_ws(" ", meta, rest))),
        (_is(rest, C.BAD_REMAINDER) & ~low.rlike("^(?:с|от|для) "), native.capital(F.concat_ws(", ", meta, rest))),
        (low.rlike(C.CULTURE), native.capital(F.concat(_right(rest, ".!? "), F.lit(", "), meta, F.when(source.startswith("ruwiki"), ".").otherwise("")))),
    ]


def removable_bracket(meta: Column, rest: Column, source: Column) -> Column:
    """A bracket of grammar, origin or spelling before a text that stands without it."""
    low = native.casefold(meta)
    kind = (
        _is(low, C.META_CONTENT) | meta.rlike(C.QUOTED_META) | _is(meta, C.SHIP)
        | ((source != "dal") & (_ascii_share(meta) >= 0.75) & (F.length(rest) >= 20))
    )
    return kind & ~_is(rest, C.BAD_REMAINDER)


def without_residue(text: Column) -> Column:
    """Without empty brackets, stray bullets, dangling colons and an unpaired quotation mark at an edge."""
    for _ in range(2):
        for pattern, by in (
            (r"(?U)(?<!\w)(?:\(\s*\)|\[\s*\])(?!\w)", " "), (r"^\s*[·•]\s*", ""), (r"\s+[·•]\s*$", ""),
            (r"\s+(?:[,;|]\s*)+:\s*(?=$|[A-Za-zА-Яа-яЁёІіѢѣѲѳѴѵ])", " "), (r":\s*$", ""), (r"\s+(?:[:;,|]\s*){2,}$", ""),
        ):
            text = F.regexp_replace(text, pattern, by)
        text = native.strip_chars(native.collapse(text), " ;,|•")
    return text


def without_edge_quote(text: Column) -> Column:
    cut = (
        F.when(text.endswith('"'), F.regexp_replace(text, r'"$', "")).when(text.rlike('^["«„‚“‘]'), _from(text, 2))
        .otherwise(F.regexp_replace(text, "[»“’”]$", ""))
    )
    return native.strip_chars(native.strip(cut), " ;,|•")


def about_rewritten(text: Column) -> Column:
    """``О том, кто ..`` as ``Тот, кто ..``, and ``Об отсутствии X`` as ``Отсутствие X`` for known nouns; else null."""
    t = quality.compact(text)
    out = None
    for pattern, by in C.ABOUT_CLAUSES:
        new = _drop(t, pattern, by)
        out = F.when(new != t, native.capital(new)) if out is None else out.when(new != t, native.capital(new))
    head = F.lower(F.regexp_extract(t, _U + C.ABOUT_NOMINAL, 1))
    rest = F.regexp_extract(t, _U + C.ABOUT_NOMINAL, 2)
    noun = F.element_at(F.create_map(*[F.lit(x) for kv in C.ABOUT_HEADS.items() for x in kv]), head)
    agrees = ~F.ltrim(rest).rlike("^[,:—–-]") & ~F.lower(F.ltrim(rest)).startswith("или ")
    body = F.regexp_replace(F.concat_ws(" ", noun, F.when(native.strip(rest) != "", native.collapse(rest))), r"\s+([,.;:])", "$1")
    return F.when(low_about(t), out.when(noun.isNotNull() & agrees, body))


def low_about(text: Column) -> Column:
    return F.lower(text).rlike("^(?:о|об|обо) ")


def shortened_old_article(text: Column) -> Column:
    """The core of an article of more than 520 characters: whole clauses of its first sentence, marked further senses."""
    parts = F.transform(F.split(text, _U.replace("i", "") + C.SENTENCE_BORDER), native.strip)

    def pack(clauses: Column) -> Column:
        """Clauses joined while they fit in 420 characters, until 320 are reached."""
        start = F.struct(F.lit("").alias("t"), F.lit(False).alias("done"))

        def step(a: Column, c: Column) -> Column:
            joined = F.when(a["t"] == "", c).otherwise(F.concat(a["t"], F.lit("; "), c))
            full = (a["t"] != "") & (F.length(joined) > 420)
            kept = F.when(a["done"] | full, a["t"]).otherwise(joined)
            return F.struct(kept.alias("t"), (a["done"] | full | (F.length(kept) >= 320)).alias("done"))

        return F.aggregate(clauses, start, step, lambda a: a["t"])

    def first_of(p: Column) -> Column:
        clauses = F.filter(F.transform(F.split(p[0], ";"), native.strip), lambda x: x != "")
        long_one = (F.length(p[0]) > 420) & p[0].contains(";")
        return F.when(long_one, F.concat(_right(pack(clauses), " .;:"), F.lit("."))).otherwise(p[0])

    def grow(r: Column) -> Column:
        start = F.struct(r["first"].alias("t"), F.lit(False).alias("done"))

        def step(a: Column, s: Column) -> Column:
            probe = F.regexp_replace(s, '^[ «"]+|[ «"]+$', "")
            stop = (
                a["done"] | (F.length(a["t"]) >= 420) | _is(probe, C.OLD_EXAMPLE) | (s.rlike('["«»]') & (F.length(s) > 80))
                | ~_is(probe, C.OLD_SECONDARY) | (_is(s, C.OLD_DERIVATIVE) & (F.length(a["t"]) >= 120))
                | (F.length(a["t"]) + 1 + F.length(s) > 420)
            )
            return F.struct(F.when(stop, a["t"]).otherwise(F.concat_ws(" ", a["t"], s)).alias("t"), stop.alias("done"))

        return F.aggregate(F.slice(r["parts"], 2, 2), start, step, lambda a: a["t"])

    short = native.bind({"parts": F.filter(parts, lambda x: x != "")}, lambda p: native.bind({"parts": p["parts"], "first": first_of(p["parts"])}, grow))
    return native.bind(
        {"s": native.strip(short)},
        lambda r: F.when((F.length(r["s"]) >= 20) & (F.length(text) - F.length(r["s"]) >= 80), r["s"]).otherwise(text),
    )


class Steps:
    """The chain under construction: a DataFrame with the current text in ``_t`` and the names of what changed it."""

    def __init__(self, rows: DataFrame) -> None:
        self.n = 0
        self.keep = [F.col(f"`{c}`") for c in rows.columns]
        self.df = rows.select(
            *self.keep, native.strip(F.coalesce("definition", F.lit(""))).alias("_t"), F.array().cast("array<string>").alias("_c")
        )
        self.t, self.lemma, self.source = F.col("_t"), F.coalesce("lemma", F.lit("")), F.coalesce("source", F.lit(""))
        self.wiki, self.old = self.source.startswith("ruwiki"), self.source == "dal"

    def step(self, name: str | None, new: Column, where: Column | None = None) -> None:
        """Set the text to ``new`` where the condition holds; a null keeps it. An empty text stays empty."""
        self.n += 1
        if self.n % 3 == 0:  # a lambda ends a stage of generated code, so that none grows too large to compile
            self.df = self.df.select(*self.keep, native.bind({"t": self.t}, lambda r: r["t"]).alias("_t"), "_c")
        test = self.t != "" if where is None else (self.t != "") & where
        made = F.when(test, F.coalesce(new, self.t)).otherwise(self.t)
        stage = self.df.select(*self.keep, "_t", "_c", made.alias("_n"))
        changes = F.col("_c") if name is None else F.when(F.col("_n") != F.col("_t"), F.array_append("_c", F.lit(name))).otherwise(F.col("_c"))
        self.df = stage.select(*self.keep, F.col("_n").alias("_t"), changes.alias("_c"))

    def reject(self, name: str, test: Column) -> None:
        """Empty the text where the test holds."""
        self.step(name, F.lit(""), F.coalesce(test, F.lit(False)))

    def clean(self, where: Column | None = None) -> None:
        """The cleaning chain over the current text."""
        done = cleaning.with_clean(self.df, "_t", "_n", markup=where is None)
        new = F.col("_n") if where is None else F.when(where, F.col("_n")).otherwise(F.col("_t"))
        self.df = done.select(*self.keep, new.alias("_t"), "_c")

    def group(self) -> None:
        """Take the leading bracket apart into ``_g``."""
        self.df = self.df.select(*self.keep, "_t", "_c", native.leading_group(self.t).alias("_g"))

    def drop_group(self, name: str, new: Column) -> None:
        made = self.df.select(*self.keep, "_t", "_c", F.when(F.col("_g").isNotNull(), new).alias("_n"))
        changed = F.col("_n").isNotNull()
        self.df = made.select(
            *self.keep, F.coalesce("_n", "_t").alias("_t"), F.when(changed, F.array_append("_c", F.lit(name))).otherwise(F.col("_c")).alias("_c")
        )


def normalize(rows: DataFrame) -> DataFrame:
    """``rows`` (with ``lemma, definition, source``) plus ``text`` and ``changes``.

    ``text`` is the normalised definition, ``""`` if nothing of a meaning is left; ``changes``
    are the distinct names of the steps that had an effect, sorted. Null definitions are empty.
    """
    s = Steps(rows)
    t = s.t
    s.step("example_tail_removed", F.rtrim(_drop(t, C.EXAMPLE_TAIL)), t.contains("◆") | t.contains("◇"))
    s.step("corpus_tail_removed", F.rtrim(_drop(t, C.CORPUS_TAIL)), t.contains("["))
    s.step("sense_reference_removed", F.regexp_replace(t, C.SENSE_REFERENCE, ""), t.contains("["))
    s.step("citation_removed", F.regexp_replace(t, C.CITATION, ""), t.contains("["))
    s.step("url_removed", native.strip_chars(_drop(t, C.URL), " ,;:—–-"), _is(t, P.URL))

    head, descriptor = (native.collapse(F.regexp_extract(t, C.TRAILING_DESCRIPTOR, i)) for i in (1, 2))
    key = lambda c: native.casefold(native.normalize_key(c, composed=True))
    s.step("trailing_descriptor_rewritten", native.capital(descriptor), t.contains("(") & t.rlike(C.TRAILING_DESCRIPTOR) & (key(head) == key(s.lemma)) & _is(descriptor, C.DESCRIPTOR_NOUN))
    at = F.regexp_instr(t, F.lit("(?U)" + C.NEXT_HEADWORD))
    s.step("dal_cluster_trimmed", F.rtrim(F.substring(t, F.lit(1), at - 1)), s.old & (F.length(t) >= 80) & (at > 35))

    base = F.regexp_replace(s.lemma, r" \(.*\)$", "")

    def after(name: Column) -> Column:
        """What follows the name if a dash, colon or ``это`` stands between."""
        fits = (name != "") & (F.lower(F.substring(F.ltrim(t), F.lit(1), F.length(name))) == F.lower(name))
        rest = _from(F.ltrim(t), F.length(name) + 1)
        sign, copula = r"^\s*(?:—|–|-|:)\s*", r"^\s+это\s+"
        return F.when(fits & rest.rlike(sign), F.regexp_replace(rest, sign, "")).when(fits & _is(rest, copula), _drop(rest, copula))

    s.step("headword_prefix_removed", F.coalesce(after(s.lemma), after(base)))
    s.step("empty_copula_removed", _drop(t, r"^\s*это\s+"), F.length(native.strip(_drop(t, r"^\s*это\s+"))) >= 12)

    s.group()
    meta, rest = F.col("_g.meta"), F.col("_g.rest")

    def first_rule(r: Column) -> Column:
        cases = bracket_rules(r["t"], r["g"]["meta"], r["g"]["rest"], r["lemma"], r["source"])
        return reduce(lambda a, c: a.when(*c), cases[1:], F.when(*cases[0]))

    # rare and large: kept out of the generated code of the stage
    made = native.bind({"t": t, "g": F.col("_g"), "lemma": s.lemma, "source": s.source}, first_rule)
    s.drop_group("leading_context_rewritten", F.when(F.col("_g").isNotNull(), made))
    labelled = F.array_contains("_c", "leading_metadata_removed")
    s.step("leading_metadata_removed", cleaning.without_context(t))
    for _ in range(2):
        s.group()
        s.drop_group("leading_metadata_removed", F.when(removable_bracket(meta, rest, s.source), rest))
    s.step(None, cleaning.without_labels(t), labelled)
    s.step("empty_copula_removed", _drop(t, r"^\s*это\s+"), F.length(native.strip(_drop(t, r"^\s*это\s+"))) >= 8)
    s.step("abbreviation_expanded", F.nullif(native.strip_chars(native.collapse(F.regexp_extract(t, _U + C.ABBREVIATION, 1)), " .;,:—–-"), F.lit("")), _is(t, C.ABBREVIATION))
    s.step("about_fragment_rewritten", about_rewritten(t))

    prefix = t
    for _ in range(3):
        prefix = _left(_drop(_drop(prefix, C.OLD_REGION), C.OLD_USAGE))
    touched = _is(t, C.OLD_REGION) | _is(t, C.OLD_USAGE)
    s.step("leading_metadata_removed", prefix, s.old & touched)
    guess, told = (F.regexp_extract(t, C.OLD_SPECULATION, i) for i in (1, 2))
    s.step("leading_metadata_removed", _left(told), s.old & guess.contains("?") & (F.length(native.strip(told)) >= 16))
    s.step("dal_long_compacted", shortened_old_article(t), s.old & (F.length(t) > 520))

    s.step(None, native.strip_chars(native.collapse(t), " ;,•"))
    s.clean()
    s.reject("broken_stub_removed", _is(native.strip(t), C.BROKEN_STUB) | (t.startswith("[") & ~t.contains("]")) | t.isin(*C.BROKEN_LITERALS))
    s.step("bad_residue_removed", without_residue(quality.compact(t)), t.rlike(P.RESIDUE))
    s.step("bad_residue_removed", without_edge_quote(t), quality.edge_quote(t))
    s.clean(F.array_contains("_c", "bad_residue_removed"))

    s.reject("nondefinition_removed", _is(t, C.ABOUT_IN_BRACKETS) | _is(t, P.EMPTY_META) | _is(t, P.FRAGMENT))
    own = native.casefold(native.normalize_key(s.lemma, composed=True))
    low = native.casefold(t)
    repeats = low.startswith("о ") & (own != "") & F.substring(low, 1, 100).contains(own)
    s.reject("nondefinition_removed", s.source.startswith("wiktionary") & (_is(t, C.ABOUT_PREAMBLE) | repeats))
    _encyclopedia(s)
    s.step(None, cleaning.capital_if_small(t))
    return s.df.select(*s.keep, F.col("_t").alias("text"), F.array_sort(F.array_distinct("_c")).alias("changes"))


def _encyclopedia(s: Steps) -> None:
    """Steps for encyclopedia sources only."""
    t, wiki, lemma = s.t, s.wiki, s.lemma
    s.reject("wikipedia_list_residue_removed", wiki & t.rlike("(?U)" + C.LIST_RESIDUE))
    ship = _is(lemma, C.SHIP)
    event = _is(F.substring(t, 1, 180), C.EVENT_WORD)
    noise = _is(F.substring(t, 1, 220), C.ENTITY_NOISE) & (~event | _is(lemma, C.EVENT_TITLE))
    s.reject("wikipedia_entity_noise_removed", wiki & (ship | noise))

    low = native.casefold(t)
    head = quality.headword(lemma)
    brackets = F.abs(quality._count(t, "(") - quality._count(t, ")")) >= 2
    warned = quality.encyclopedic_date(lemma, t, low) | quality.self_reference(head, low) | _is(t, C.DANGLING_TAIL) | brackets
    history = _is(t, C.ORPHAN_HISTORY)
    core = F.when(_is(t, C.ORPHAN_DATE), F.regexp_extract(t, _U + C.ORPHAN_DATE, 1)).when(history, F.regexp_extract(t, _U + C.ORPHAN_HISTORY, 1))
    core = _right(native.collapse(core), _EDGE)
    s.step("wikipedia_orphan_date_tail_removed", F.concat(_right(core, ".!?"), F.lit(".")), wiki & (warned | history) & (F.length(core) >= 8) & core.contains(" "))
    s.step("wikipedia_date_punctuation_fixed", _drop(t, C.DATE_SPACE, "$1$2"), wiki & (warned | history) & _is(t, C.DATE_SPACE))
    suffix = _from(t, F.length(head) + 1)
    s.reject("wikipedia_self_reference_removed", wiki & (head != "") & low.startswith(head) & suffix.rlike(C.BROKEN_SELF_REFERENCE))

    s.step("wikipedia_broken_tail_removed", _drop(t, C.EMPTY_ABBREVIATION, ", "), wiki)
    for pattern in (C.MEDIA_TAIL, C.SEE_TAIL):
        cut = _right(_drop(t, pattern), _EDGE)
        s.step("wikipedia_broken_tail_removed", cut, wiki & _is(t, pattern) & (F.length(cut) >= 12))
    s.group()
    s.drop_group("wikipedia_broken_fragment_removed", F.when(wiki & _is(F.col("_g.rest"), C.BAD_REMAINDER), F.lit("")))
    s.step("wikipedia_extra_sentences_removed", F.nullif(F.rtrim(F.regexp_extract(t, C.FIRST_SENTENCE, 1)), F.lit("")), wiki)

    foreign = F.size(F.array_except(quality.historical_years(t), quality.historical_years(lemma))) > 0
    clause = F.regexp_instr(t, F.lit(_U + C.HISTORY_CLAUSE))
    inline = F.regexp_instr(t, F.lit(_U + C.HISTORY_INLINE))
    place = F.when(clause > 0, clause).otherwise(inline)
    told = _right(F.substring(t, F.lit(1), place - 1), " ,;:—–-")
    plain = _right(native.casefold(told), ".!?")
    informative = (F.length(told) >= 12) & native.strip(plain).contains(" ") & ~plain.isin(*C.GENERIC_CORES)
    named = lemma.rlike("[A-Za-z0-9]|[А-ЯЁ]{2,}[-0-9]") & (F.length(told) >= 6)
    s.step("wikipedia_history_tail_removed", F.concat(_right(told, ".!?"), F.lit(".")), wiki & t.rlike(r"1[5-9]\d\d|20\d\d") & foreign & (place > 0) & (informative | named))
    kind = F.regexp_extract(t, _U + C.NAMED_CORE, 1)
    s.step("wikipedia_named_core_compacted", F.concat(native.capital(kind), F.lit(".")), wiki & (F.length(kind) >= 4) & (F.length(kind) <= 40) & lemma.rlike("[A-ZА-ЯЁ0-9]") & (F.size(quality.historical_years(t)) > 0))
    s.reject("wikipedia_broken_fragment_removed", wiki & (_is(t, C.DANGLING_TAIL) | (F.abs(quality._count(t, "(") - quality._count(t, ")")) >= 2)))
