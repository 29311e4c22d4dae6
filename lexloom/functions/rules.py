"""Text rules that no column expression can state; pure functions, wrapped for Arrow batches."""

from __future__ import annotations

import html
import unicodedata
from functools import lru_cache
from html.parser import HTMLParser

import pandas as pd
import regex as re
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from lexloom.functions import patterns as P

_I = re.IGNORECASE
_KEY_FOLD = {ord(c): "-" for c in "‐‑‒–−"} | {0xA0: " ", 0x202F: " "}
_LINK = re.compile(r"\[\[(?:[^\]|]*\|)?([^\]]+)\]\]")
_INNER_TEMPLATE = re.compile(r"\{\{[^{}]*\}\}")
_MARKUP = re.compile(rf"<({P.HTML_NAMES})(?:\s[^<>]*)?>.*?</\1\s*>|{P.MARKUP}", _I | re.S)
_FORM_OF = [re.compile(p, _I) for p in P.FORM_OF]
_LABEL = rf"(?:{'|'.join(P.LABELS)})\."
_LABELS = re.compile(rf"^(?:\s*(?:[\[(]{_LABEL}(?:\s*[,;/]\s*{_LABEL})*[\])]|{_LABEL}(?:\s*[,;/]\s*{_LABEL})*)\s*[:;,—-]?\s*)+", _I)
_CONTEXT = re.compile(
    rf"^(?:\s*[\[(](?=\s*(?:{'|'.join(P.CONTEXT_STARTS)})\b)(?=[^\])]*(?:{'|'.join(P.DOMAIN_ROOTS)}))[^\])]{{2,100}}[\])][ \s,;:—-]*)+", _I
)
_GRAMMAR = re.compile(P.GRAMMAR, _I)
_CYRILLIC_PHRASE = re.compile(r"[А-Яа-яЁёІіѢѣѲѳѴѵ]+(?:-[А-Яа-яЁёІіѢѣѲѳѴѵ]+)*(?:\s+[А-Яа-яЁёІіѢѣѲѳѴѵ]+(?:-[А-Яа-яЁёІіѢѣѲѳѴѵ]+)*){0,3}")
_PHRASE = re.compile(rf"{P.TARGET}(?:\s+{P.TARGET}){{0,3}}")


class _Text(HTMLParser):
    """Text of a document; some elements have none."""

    SILENT = frozenset(("script", "style", "binary", "stylesheet", "description", "coverpage"))

    def __init__(self, gap: str = " ", silent: bool = False) -> None:
        super().__init__(convert_charrefs=True)
        self.parts: list[str] = []
        self.depth, self.gap, self.silent = 0, gap, silent

    def _mute(self, tag: str) -> bool:
        return self.silent and (tag in self.SILENT or tag.endswith("-info"))

    def handle_starttag(self, tag, attrs):
        if self._mute(tag):
            self.depth += 1

    def handle_endtag(self, tag):
        if self._mute(tag) and self.depth:
            self.depth -= 1

    def handle_data(self, data):
        if not self.depth:
            self.parts.append(data)

    def text(self) -> str:
        return self.gap.join(self.parts)


def html_text(data: str | None, book: bool = False) -> str:
    """Text of HTML or FB2; ``book`` leaves out binaries and metadata. Broken markup is read as far as it goes."""
    p = _Text(silent=book)
    # <title> inside a body would switch the parser to raw text
    p.feed(re.sub(r"(?i)(</?)title\b", r"\1h1", data or ""))
    p.close()
    return p.text()


def normalize_key(value: str) -> str:
    return " ".join(unicodedata.normalize("NFC", value).translate(_KEY_FOLD).split())


def form_target(value: str | None) -> str | None:
    """The headword a purely grammatical gloss points to."""
    if not value:
        return None
    text = normalize_key(_LINK.sub(r"\1", html.unescape(value)))
    for rule in _FORM_OF:
        m = rule.match(text)
        if m:
            return m.group(1)
    return None


def without_markup(value: str | None) -> str:
    """A definition without entities, links, templates and HTML, in composed form."""
    text = unicodedata.normalize("NFC", html.unescape((value or "").strip()))
    text = _LINK.sub(r"\1", text)
    for _ in range(6):
        text, n = _INNER_TEMPLATE.subn("", text)
        if not n:
            break
    text = text.partition("{{")[0]
    for mark in ("__NOTOC__", "[[", "]]"):
        text = text.replace(mark, " ")
    return html_text(text) if "<" in text and _MARKUP.search(text) else text


def clean_definition(value: str | None) -> str:
    """Display text of a definition, ``""`` if it holds no meaning. Applying it twice changes nothing more."""
    text = without_markup(value).translate(_KEY_FOLD).strip()
    text = re.sub(r"^(?:[#*:;-]+|\d+[.)])\s*", "", text)
    text = " ".join(text.split()).strip(" ;,•")
    if form_target(text):
        return ""
    text = _LABELS.sub("", text).lstrip(" ,;:—-")
    text = _CONTEXT.sub("", text)
    if text and text[0].isalpha():
        text = text[0].upper() + text[1:]
    if text.casefold() in P.PLACEHOLDERS or len(text) < 220 and (form_target(text) or _GRAMMAR.match(text)):
        return ""
    return text


def clean_gloss(value: str | None) -> str:
    """A short foreign gloss for packs, ``""`` if it is grammar, a placeholder or too long."""
    text = re.sub(r"<[^>]+>", "", html.unescape(value or ""))
    cut = min((text.find(m) for m in P.EXTRACT_MARKERS if m in text), default=len(text))
    text = " ".join(text[:cut].split()).strip(" .;,:—–-")
    low = text.casefold()
    if not text or len(text) > 320 or low in ("см.", "см") or "аналогично русскому слову" in low:
        return ""
    if re.match(P.EXTRACT_GRAMMAR, text, _I) or re.match(P.EMPTY_META, text, _I):
        return ""
    return text


def form_variants(value: str | None) -> list[str]:
    """Word forms of a form cell: the note mark goes, commas separate, only phrases of up to 4 words stay.

    Stress marks stay, but are not looked at.
    """
    text = re.sub(r"\^?△", "", normalize_key(value or ""))
    forms = (part.strip(" ^") for part in text.split(","))
    return list(dict.fromkeys(f for f in forms if _PHRASE.fullmatch(without_stress(f))))


_STRESS = re.compile("[\u0300\u0301\u0340\u0341]")


def without_stress(value: str) -> str:
    """Without stress marks; й and ё keep theirs."""
    return unicodedata.normalize("NFC", _STRESS.sub("", unicodedata.normalize("NFD", value)))


def is_cyrillic_phrase(value: str | None) -> bool:
    return bool(value) and _CYRILLIC_PHRASE.fullmatch(value) is not None


#: Latin ligatures and how they are typed.
LIGATURES = {"æ": "ae", "Æ": "AE", "œ": "oe", "Œ": "OE"}
_CLUSTER = re.compile(r"\p{Latin}\p{M}+")


def without_latin_accents(value: str) -> str:
    """Latin letters without diacritics and ligatures; other scripts keep their marks."""
    spelled = "".join(LIGATURES.get(c, c) for c in value)
    bare = _CLUSTER.sub(lambda m: m.group()[0], unicodedata.normalize("NFD", spelled))
    return unicodedata.normalize("NFC", bare)


def typographic_variants(value: str) -> list[str]:
    """Other spellings a reader may type: without accents, with the other apostrophe; sorted."""
    accents = {value, without_latin_accents(value)}
    marks = ("'", "’")
    out = set(accents)
    for x in accents:
        for m in marks:
            out.add(re.sub("['’]", m, x))
    return sorted(x for x in out if x and x != value)


def without_blocks(text: str, opening: str, closing: str) -> str:
    """Text without nested ``opening .. closing`` blocks; an unclosed block runs to the end."""
    kept, depth, since = [], 0, 0
    for m in re.finditer(f"{re.escape(opening)}|{re.escape(closing)}", text):
        if m.group() == opening:
            if depth == 0:
                kept.append(text[since : m.start()])
            depth += 1
        elif depth:
            depth -= 1
            since = m.end()
    return "".join(kept) + (text[since:] if depth == 0 else "")


_PERSON = re.compile(r"\((?:[^()]*[;,\s])?(?:род\.|\d{1,2}\s+[а-я]+\s+1\d{3})", _I)


def wiki_lead(title: str | None, source: str | None, longest: int = 420) -> str:
    """Defining first sentence of an encyclopedia page, ``""`` if the lead does not define the title."""
    text = re.sub(r"<!--.*?-->", "", source or "", flags=re.S)
    text = re.split(r"^={2,}", text, maxsplit=1, flags=re.M)[0]
    text = without_blocks(without_blocks(text, "{{", "}}"), "{|", "|}")
    text = re.sub(r"<ref\b[^>]*/>|<ref\b.*?</ref>", "", text, flags=re.S | _I)
    text = re.sub(r"\[\[(?:файл|file|image|изображение|категория|category):[^\[\]]*\]\]", "", text, flags=_I)
    text = html.unescape(re.sub(r"'{2,}", "", _LINK.sub(r"\1", text)))
    text = re.sub(r"<[^<>]+>", "", text).replace("\xa0", " ")
    lead = next((p for p in (" ".join(x.split()) for x in text.split("\n\n")) if len(p) >= 30 and p[0] not in "|!*#"), "")
    if not lead or _PERSON.search(lead[:160]):
        return ""
    name = normalize_key(title or "")
    for head in (name, re.sub(r"\s+\([^()]*\)$", "", name)):
        if head and lead.casefold().startswith(head.casefold()):
            rest = lead[len(head) :].lstrip()
            rest = re.sub(r"^\([^()]*\)\s*", "", rest)
            m = re.match(r"(?:[—–:-]\s*(?:это\s+)?|(?:это|является|представляет собой)\s+)(.+)", rest, _I)
            if m:
                sentence = re.split(r"(?<=[.!?])\s+(?=[А-ЯЁA-Z])", m.group(1), maxsplit=1)[0]
                if len(sentence) > longest:
                    at = max(sentence.rfind(x, 250, longest) for x in ";,.")
                    sentence = sentence[: at if at > 0 else longest].rstrip(" ,;") + "."
                done = clean_definition(sentence)
                return done if len(done) >= 20 else ""
    return ""


@lru_cache(maxsize=None)
def _text_udf(name: str):
    fn = globals()[name]

    @F.pandas_udf(StringType())
    def run(s):
        # repeated values of a batch are worked out once
        found: dict[str | None, str | None] = {None: None}
        values = [None if x is None or x != x else x for x in s]
        for x in values:
            if x not in found:
                found[x] = fn(x)
        return pd.Series([found[x] for x in values], dtype=object)

    return run


def text_rule(name: str, c: Column) -> Column:
    """A one-argument rule of this module as a column; null stays null."""
    return _text_udf(name)(c)


@lru_cache(maxsize=None)
def _list_udf(name: str):
    fn = globals()[name]

    @F.pandas_udf(ArrayType(StringType()))
    def run(s):
        return s.map(lambda x: None if x is None else fn(x))

    return run


def list_rule(name: str, c: Column) -> Column:
    return _list_udf(name)(c)


@lru_cache(maxsize=1)
def _lead_udf():
    @F.pandas_udf(StringType())
    def run(title, lead):
        return title.combine(lead, lambda a, b: wiki_lead(a, b) if b is not None else None)

    return run


def lead_rule(title: Column, lead: Column) -> Column:
    return _lead_udf()(title, lead)
