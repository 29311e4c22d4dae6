"""Lexeme dumps: JSON lines of word entries and of nested lexeme entities."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexloom.functions import rules
from lexloom.runtime import spread

SCHEMA = "kind string, a string, b string, c string, file_pos long, item_pos int"
#: Form tags that are no word forms, and sense tags without meaning.
NOT_FORMS = frozenset(("romanization", "transliteration", "ipa", "audio", "hiragana", "katakana"))
GRAMMAR_TAGS = frozenset(("form-of", "alt-of"))


def _words(value) -> list[str]:
    """Words of a ``form_of`` field, which may be a string, an object or a list of both."""
    if isinstance(value, str):
        return [value]
    if isinstance(value, dict):
        return _words(value.get("word") or value.get("term"))
    if isinstance(value, list):
        return [w for v in value for w in _words(v)]
    return []


def entry_rows(record: dict, languages: frozenset[str]) -> list[tuple[str, str, str, str | None]]:
    """Rows (kind, a, b, c) of a word entry: ``sense`` (lemma, text, source), ``link`` (key, lemma), ``hint`` (key, target, kind)."""
    out: list[tuple[str, str, str, str | None]] = []
    word = rules.normalize_key(record.get("word") or record.get("title") or "")
    redirect = record.get("redirect")
    if record.get("pos") == "hard-redirect":
        if rules.is_cyrillic_phrase(word) and rules.is_cyrillic_phrase(redirect):
            out.append(("link", word, redirect, None))
        return out
    if record.get("lang_code") not in languages or not word:
        return out
    lexical, passive = 0, []
    for sense in record.get("senses") or []:
        glosses = sense.get("glosses") or []
        glosses = [glosses] if isinstance(glosses, str) else [g for g in glosses if isinstance(g, str)]
        tags = set(sense.get("tags") or ())
        structured = _words(sense.get("form_of")) + _words(sense.get("alt_of"))
        textual = next((t for t in map(rules.form_target, reversed(glosses)) if t), None)
        targets = list(dict.fromkeys([rules.normalize_key(w) for w in structured] + ([textual] if textual else [])))
        hint = "passive_participle" if {"passive", "participle"} <= tags or any(
            "страд" in g.casefold()[:12] for g in glosses
        ) else None
        for t in targets:
            out.append(("link", word, t, None))
            if hint:
                out.append(("hint", word, t, hint))
                passive.append(t)
        if structured or tags & GRAMMAR_TAGS or textual or not glosses:
            continue
        text = rules.clean_definition(glosses[-1])
        if text:
            lexical += 1
            out.append(("sense", word, text, f"wiktionary:{record['lang_code']}"))
    if lexical:
        out.append(("link", word, word, None))
    if isinstance(redirect, str) and redirect:
        out.append(("link", word, rules.normalize_key(redirect), None))
    for form in record.get("forms") or []:
        text, tags = (form, ()) if isinstance(form, str) else (form.get("form"), form.get("tags") or ())
        if NOT_FORMS & set(tags):
            continue
        for v in rules.form_variants(text):
            out.append(("link", v, word, None))
            if not lexical:
                out += [("hint", v, t, "passive_participle") for t in passive]
    return out


def _values(mapping, language: str = "ru") -> list[str]:
    """Texts of a language map: the language first, then its variants by tag."""
    found = []
    if isinstance(mapping, dict):
        tags = [t for t in mapping if t == language] + sorted(t for t in mapping if t.startswith(language + "-"))
        for t in tags:
            v = mapping[t]
            v = v.get("value") if isinstance(v, dict) else v
            if isinstance(v, str) and v.strip():
                found.append(rules.normalize_key(v))
    return list(dict.fromkeys(found))


def _items(value) -> list[dict]:
    items = value.values() if isinstance(value, dict) else value or []
    return [x for x in items if isinstance(x, dict)]


def entity_rows(record: dict, language_item: str = "Q7737") -> list[tuple[str, str, str, str | None]]:
    """Rows of a lexeme entity, as :func:`entry_rows`."""
    if record.get("language") != language_item:
        return []
    lemmas = _values(record.get("lemmas"))
    if not lemmas:
        return []
    lemma, out = lemmas[0], []
    for s in _items(record.get("senses")):
        for g in _values(s.get("glosses")):
            text = rules.clean_definition(g)
            if text:
                out.append(("sense", lemma, text, "wikidata"))
    out.append(("link", lemma, lemma, None))
    out += [("link", x, lemma, None) for x in lemmas[1:]]
    for f in _items(record.get("forms")):
        out += [("link", x, lemma, None) for x in _values(f.get("representations"))]
    return out


def _parse(lines: DataFrame, make) -> DataFrame:
    def run(batches):
        import pyarrow as pa

        for b in batches:
            rows = []
            for pos, line in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                try:
                    record = json.loads(line)
                except (ValueError, TypeError):
                    continue  # a broken line is skipped
                if isinstance(record, dict):
                    rows += [(*r, pos, i) for i, r in enumerate(make(record))]
            cols = list(zip(*rows)) if rows else [[]] * 6
            kinds = [pa.string()] * 4 + [pa.int64(), pa.int32()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(cols, kinds)], names=["kind", "a", "b", "c", "file_pos", "item_pos"]
            )

    return spread(lines).mapInArrow(run, SCHEMA)


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Text lines with a position that grows with the file order inside each split."""
    return spark.read.text(path).select(F.monotonically_increasing_id().alias("pos"), "value")


#: Sense tags that leave a gloss out of a pack.
NO_GLOSS_TAGS = frozenset(("form-of", "inflection", "no-gloss", "no definition"))


def gloss_rows(record: dict, languages: frozenset[str]) -> list[tuple[str, str, str, None]]:
    """Rows (``gloss``, word, text, None) of a word entry for packs: short glosses, no forms."""
    word = rules.normalize_key(record.get("word") or "")
    if record.get("lang_code") not in languages or not word:
        return []
    out = []
    for sense in record.get("senses") or []:
        if NO_GLOSS_TAGS & set(sense.get("tags") or ()):
            continue
        glosses = sense.get("glosses") or []
        text = rules.clean_gloss(glosses if isinstance(glosses, str) else next((g for g in glosses[::-1] if isinstance(g, str)), ""))
        if text:
            out.append(("gloss", word, text, None))
    return out


def extract_glosses(spark: SparkSession, path: str, languages, most: int = 3) -> DataFrame:
    """``(word, place, definition)``: the first ``most`` distinct glosses of each word, in dump order."""
    from pyspark.sql import Window

    langs = frozenset(languages)
    wanted = F.col("value").rlike(rf'"lang_code":\s*"(?:{"|".join(sorted(langs))})"')
    rows = _parse(_lines(spark, path).where(wanted), lambda r: gloss_rows(r, langs))
    g = rows.groupBy(F.col("a").alias("word"), F.col("b").alias("definition")).agg(F.min(F.struct("file_pos", "item_pos")).alias("_o"))
    place = F.row_number().over(Window.partitionBy("word").orderBy("_o"))
    return g.withColumn("place", place).where(F.col("place") <= most).select("word", "place", "definition")


def read_entries(spark: SparkSession, path: str, languages=("ru",)) -> DataFrame:
    """Rows of a word-entry dump (plain, ``.gz`` or ``.bz2``); other languages are dropped before parsing.

    A compressed file is one split, so its lines are dealt out before they are parsed.
    """
    langs = frozenset(languages)
    wanted = F.col("value").rlike(rf'"lang_code":\s*"(?:{"|".join(sorted(langs))})"') | F.col("value").contains("hard-redirect")
    return _parse(_lines(spark, path).where(wanted), lambda r: entry_rows(r, langs))


def read_entities(spark: SparkSession, path: str, language_item: str = "Q7737") -> DataFrame:
    """Rows of a lexeme entity dump: one JSON array with an entity per line."""
    lines = _lines(spark, path).where(F.col("value").contains(language_item))
    framed = lines.select("pos", F.regexp_replace("value", r"^\s*\[?\s*|\s*,?\s*\]?\s*$", "").alias("value"))
    return _parse(framed, lambda r: entity_rows(r, language_item))


def senses_of(rows: DataFrame) -> DataFrame:
    """``(lemma, definition, source, file_pos, item_pos)``, the first row of each (lemma, definition)."""
    s = rows.where("kind = 'sense'").select(
        F.col("a").alias("lemma"), F.col("b").alias("definition"), F.col("c").alias("source"), "file_pos", "item_pos"
    )
    from lexloom.operators.dedupe import insert_or_ignore

    return insert_or_ignore(s, ["lemma", "definition"], ["file_pos", "item_pos"])


def links_of(rows: DataFrame) -> DataFrame:
    return rows.where("kind = 'link'").select(F.col("a").alias("key"), F.col("b").alias("lemma")).distinct()


def hints_of(rows: DataFrame) -> DataFrame:
    return rows.where("kind = 'hint'").select(F.col("a").alias("key"), F.col("b").alias("target"), F.col("c").alias("kind")).distinct()
