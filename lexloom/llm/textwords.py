"""The word view of a text that comparisons between texts use."""

from __future__ import annotations

import re
import unicodedata

#: Combining stress marks, and characters that take no room on the line.
STRESS_MARKS = "\u0300\u0301\u0340\u0341"
INVISIBLE = (
    "\u00ad\u034f\u061c\u115f\u1160\u17b4\u17b5\u180e\u200b\u200c\u200d\u200e\u200f\u202a\u202b\u202c\u202d\u202e"
    "\u2060\u2061\u2062\u2063\u2064\u2066\u2067\u2068\u2069\u206a\u206b\u206c\u206d\u206e\u206f\u3164\ufeff\uffa0"
)

_DROP = re.compile(f"[{STRESS_MARKS}{INVISIBLE}\ufe00-\ufe0f]")
_GAP = re.compile(r"[\W_]+")
_MARKS = re.compile("[\u0300-\u036f]")


def normal_words(text: str | None) -> str:
    """Words of a text, joined and surrounded by single blanks; ``""`` if it has none.

    Letter case, punctuation, kind and amount of white space, stress marks, invisible
    characters and the difference of U+0451 and U+0435 are gone; a punctuation mark
    separates words. Compatibility forms are left as they are.
    """
    if not text:
        return ""
    s = text
    if not s.isascii():
        s = _DROP.sub("", s)
        if _MARKS.search(s):
            s = unicodedata.normalize("NFC", s)
        s = s.lower().replace("ё", "е")
        if "\u0307" in s:  # lower case of a dotted capital I
            s = s.replace("\u0307", "")
    else:
        s = s.lower()
    s = _GAP.sub(" ", s).strip(" ")
    return f" {s} " if s else ""
