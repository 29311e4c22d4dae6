"""Problem 1: markup residue. Segments of a text are labelled by a minimum cut.

A text is cut into delimiters that may be markup (HTML, Markdown, wiki, LaTeX) and the
runs between them. A classifier fitted on generated samples (:mod:`.markup_model`) gives
each delimiter two costs, which become its terminal capacities; neighbours and the two ends
of one construct (proximity in the document tree) are tied by smoothness edges. The minimum
cut then says at once which delimiters are markup and which runs belong to a construct that
is no content. Code and formulas are closed before: nothing inside them is labelled.

The cut is exact: segments whose own costs outweigh all their edges are settled first and
their edges folded into the neighbours (persistency), which settles nearly all of them;
augmenting paths solve what is left.
"""

from __future__ import annotations

import html
import re
import zlib
from bisect import bisect_right
from collections import deque
from html.entities import html5

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexloom.runtime import spread
from lexloom.sources.tables import table

#: Element names of HTML and of wiki extensions.
TAGS = frozenset(
    """a abbr address article aside audio b base bdi bdo big blockquote body br button caption center cite code col
    colgroup data dd del details dfn div dl dt em embed fieldset figcaption figure font footer form h1 h2 h3 h4 h5 h6
    head header hr html i iframe img input ins kbd label legend li link main map mark menu meta nav noscript object ol
    option p param picture pre progress q rp rt ruby s samp script section select small source span strike strong style
    sub summary sup svg table tbody td template textarea tfoot th thead time title tr tt u ul var video wbr
    ref references nowiki math chem syntaxhighlight gallery noinclude includeonly onlyinclude poem hiero score timeline
    imagemap indicator categorytree pagelist templatestyles""".split()
)
#: Elements whose inside is code, a formula, or no content.
CODE_TAGS = frozenset(("code", "pre", "syntaxhighlight", "tt", "nowiki"))
FORMULA_TAGS = frozenset(("math", "chem"))
DROPPED_TAGS = frozenset(("ref", "script", "style", "gallery", "timeline"))
#: LaTeX commands that are known without an argument.
COMMANDS = frozenset(
    """alpha beta gamma delta epsilon varepsilon zeta eta theta iota kappa lambda mu nu xi pi rho sigma tau upsilon phi
    varphi chi psi omega Gamma Delta Theta Lambda Xi Pi Sigma Phi Psi Omega sum prod int lim infty partial nabla cdot
    cdots ldots dots times div pm leq geq neq approx equiv rightarrow leftarrow Rightarrow Leftarrow to in subset cup cap
    forall exists quad qquad item noindent newline newpage par hline centering maketitle tableofcontents it bf em tt sc
    rm sf sl small large Large tiny bfseries itshape ttfamily left right frac sqrt""".split()
)
#: LaTeX commands by what becomes of their argument.
HEADING_COMMANDS = {"title": 1, "part": 1, "chapter": 1, "section": 1, "subsection": 2, "subsubsection": 3, "paragraph": 4}
TEXT_COMMANDS = frozenset(
    "textbf textit texttt textsc textsf textrm textsl textup textmd textnormal text emph underline uline mbox hbox caption "
    "author date item quad qquad noindent newline par ldots dots cdots it bf em tt sc rm sf sl small large Large tiny".split()
)
DROPPED_COMMANDS = frozenset(
    "cite citep citet ref eqref pageref label footnote footnotemark includegraphics vspace hspace index bibliography "
    "bibliographystyle documentclass usepackage input include".split()
)
SPACE_COMMANDS = {"quad": " ", "qquad": " ", "noindent": "", "newline": "\n", "par": "\n", "ldots": "…", "dots": "…", "cdots": "…"}
MATH_ENVIRONMENTS = frozenset("equation align gather math displaymath eqnarray multline array matrix pmatrix cases".split())
CODE_ENVIRONMENTS = frozenset(("verbatim", "lstlisting", "minted", "alltt"))
#: Template parameters that hold shown text.
TEXT_PARAMETERS = frozenset(("text", "title", "quote", "текст", "заглавие", "название", "цитата", "1", "2"))
#: Names of file and category links.
FILE_LINK = re.compile(r"(?i)\s*(?:file|image|category|файл|изображение|категория)\s*:")

_SEGMENT = re.compile(
    r"""(?P<comment><!--.*?(?:-->|\Z))
    |(?P<tag></?[A-Za-z][A-Za-z0-9-]*(?:\s(?:"[^"<]*"|'[^'<]*'|[^<>"'])*+)?/?>|</?[A-Za-z][A-Za-z0-9-]*(?:\s[^<>]*)?>)
    |(?P<entity>&(?:[A-Za-z][A-Za-z0-9]+|\#[0-9]+|\#[xX][0-9A-Fa-f]+);)
    |(?P<fence>^[ ]{0,3}(?:```+|~~~+)[^`\n]*$)
    |(?P<setext>(?<=\n)(?:={3,}|-{3,})[ \t]*$)
    |(?P<heading>^=+[^=\n](?:[^\n]*[^=\n])?=+[ \t]*$|^[ ]{0,3}\#+[ \t]+(?=\S))
    |(?P<ruler>^\|?[ ]*:?-{2,}:?[ ]*(?:\|[ ]*:?-{2,}:?[ ]*)+\|?[ \t]*$)
    |(?P<wtable>^\{\|[^\n]*|^\|\}|^\|[-+][^\n|]*$|^!(?=[ ]?\S)|^\|(?=[ ])(?![^\n]*\|[ \t]*$))
    |(?P<row>^\|[^\n]*\|[ \t]*$)
    |(?P<cell>\|\||!!)
    |(?P<list>^[ \t]*(?:[*#]+|[-+]|\d+[.)])[ \t]+(?=\S)|^[*\#]+(?=[^\s*\#])(?![^\n]*\*)|^[;:]+[ ]*(?=\S)|^>[ ]?(?=\S))
    |(?P<mdlink>!?\[[^\[\]\n]*\]\([^()\s]*(?:\s"[^"\n]*")?\))
    |(?P<note>\[\^[^\]\s]+\]:?)
    |(?P<wopen>\[\[|\{\{)|(?P<wclose>\]\]|\}\})
    |(?P<extlink>\[(?:https?|ftp)://[^\s\]]+[^\]\n]*\])
    |(?P<magic>__[A-ZА-ЯЁ]{3,}__)
    |(?P<env>\\(?:begin|end)[ ]?\{[A-Za-z]+\*?\})
    |(?P<math>\\[\[\]()])
    |(?P<group>\{\\[A-Za-z]+(?=\s))
    |(?P<command>\\[A-Za-z]+\*?(?P<arg>[ ]?[\[{])?)
    |(?P<script>[_^]\{[^{}\n]*\})
    |(?P<dollar>\$\$?)
    |(?P<quote>'{2,5})
    |(?P<star>\*{1,3})|(?P<under>_{1,3})|(?P<strike>~~)|(?P<tick>`+)""",
    re.X | re.M | re.S,
)
_PAIRED = {"star", "under", "strike", "quote"}
_TAG_NAME = re.compile(r"</?([A-Za-z][A-Za-z0-9-]*)")
_FORMULA = re.compile(r"[\\^_=+<>]|[A-Za-z0-9]")
_BRACE = re.compile(r"\\[{}]|[{}]")
_NAMED = re.compile(r"\s*([\w .-]+?)\s*=")
#: A necessary condition of every alternative above, for the scan (Java syntax).
PREFILTER = r"(?m)[<&\\\[\]{}*_`$#|~]|''|!!|^\s*(?:==|[-+:;!>]|\d+[.)]\s|---)"

#: Parameters of the model: weights of the edges, how near two delimiters are tied (characters), cost of a plain run.
NEAR, TIE_NEAR, TIE_MATES, TIE_INSIDE, RUN = 24, 2, 10, 14, 12


class Segment:
    __slots__ = ("kind", "text", "start", "end", "mate", "label", "i", "shut", "owner")

    def __init__(self, kind: str, text: str, start: int, end: int) -> None:
        self.kind, self.text, self.start, self.end = kind, text, start, end
        self.mate: Segment | None = None  # the other end of the construct
        self.label = False
        self.i = -1
        self.shut = False  # an end of a construct whose inside is closed
        self.owner: Segment | None = None  # the construct that hides this run


def _name(t: str) -> str:
    return _TAG_NAME.match(t).group(1).lower()


def _command_name(t: str) -> str:
    return t[1:].rstrip("*[{ ")


class _Closers:
    """Where the delimiter that closes a code or formula construct stands; misses are remembered."""

    def __init__(self, text: str) -> None:
        self.text, self.none = text, set()
        self._braces: dict[int, int] | None = None

    def _search(self, key, pattern: str, at: int, flags: int = 0):
        if key in self.none:
            return None
        m = re.compile(pattern, flags).search(self.text, at)
        if m is None:
            self.none.add(key)
            return None
        return m.start(), m.end()

    def of(self, kind: str, t: str, at: int):
        """Place of the closer for delimiter ``t`` that ends at ``at``, or None if it closes nothing."""
        text = self.text
        if kind == "tag":
            name = _name(t)
            if t[1] == "/" or t.endswith("/>") or name not in CODE_TAGS | FORMULA_TAGS:
                return None
            return self._search(("tag", name), rf"</{name}\s*>", at, re.I)
        if kind == "fence":
            mark = t.strip()[0]
            n = len(t.strip()) - len(t.strip().lstrip(mark))
            return self._search(("fence", mark, n), rf"^[ ]{{0,3}}{mark}{{{n},}}[ \t]*$", at, re.M)
        if kind == "tick":
            n = len(t)
            found = self._search(("tick", n), rf"(?<!`)`{{{n}}}(?!`)", at)
        elif kind == "math" and t in ("\\[", "\\("):
            return self._search(t, re.escape("\\]" if t == "\\[" else "\\)"), at)
        elif kind == "env" and t.startswith("\\begin"):
            name = t[t.find("{") + 1 : -1]
            if name.rstrip("*") not in MATH_ENVIRONMENTS | CODE_ENVIRONMENTS:
                return None
            return self._search(("env", name), rf"\\end ?\{{{re.escape(name)}\}}", at)
        elif kind == "dollar" and len(t) == 2:
            return self._search("$$", r"\$\$", at)
        elif kind == "dollar":
            if at >= len(text) or text[at].isspace():
                return None
            found = self._search("$", r"(?<!\\)\$", at)
            if found is None:
                return None
            lo, hi = found
            if text[lo - 1].isspace() or hi < len(text) and text[hi].isdigit() or not _FORMULA.search(text, at, lo):
                return None
        else:
            return None
        if found is None or not text[at : found[0]].strip() or "\n\n" in text[at : found[0]]:
            return None
        return found

    def brace(self, at: int) -> int | None:
        """Place of the brace that closes the one at ``at``."""
        if self._braces is None:
            self._braces, stack = {}, []
            for m in _BRACE.finditer(self.text):
                if m.group() == "{":
                    stack.append(m.start())
                elif m.group() == "}" and stack:
                    self._braces[stack.pop()] = m.start()
        return self._braces.get(at)


def _argument_end(text: str, at: int, closers: _Closers) -> int | None:
    """End of a formula command whose first brace is at ``at``: all its arguments and scripts."""
    end = closers.brace(at)
    while end is not None:
        nxt = end + 1
        if nxt < len(text) and text[nxt] in "_^" and nxt + 1 < len(text):
            nxt += 1
        if nxt < len(text) and text[nxt] == "{" and (more := closers.brace(nxt)) is not None:
            end = more
            continue
        return end + 1
    return None


def segments(text: str) -> list[Segment]:
    """Delimiters and runs of a text, in order; together they are the whole text."""
    out: list[Segment] = []
    closers = _Closers(text)
    ends: dict[int, Segment] = {}  # places of braces that close a command
    inside = 0  # up to here the braces belong to LaTeX arguments
    at = pos = 0

    def emit(kind: str, lo: int, hi: int) -> Segment:
        nonlocal at
        if lo > at:
            _split_run(text, at, lo, ends, out)
        s = Segment(kind, text[lo:hi], lo, hi)
        out.append(s)
        at = hi
        return s

    while (m := _SEGMENT.search(text, pos)) is not None:
        kind = m.lastgroup if m.lastgroup != "arg" else "command"
        lo, hi = m.span()
        t = m.group()
        if lo < inside and (t[0] == "{" and kind == "wopen" or t[0] == "}"):
            pos = lo + 1
            continue
        if kind == "command" and t[-1] == "{":
            name = _command_name(t)
            if name == "href" and (first := closers.brace(hi - 1)) is not None and text[first + 1 : first + 2] == "{":
                hi = first + 2
            elif name not in TEXT_COMMANDS and name not in HEADING_COMMANDS and name not in DROPPED_COMMANDS and (
                name in COMMANDS or name.startswith("math") or name.startswith("operatorname")
            ):
                end = _argument_end(text, hi - 1, closers)
                if end is not None:
                    s = emit("command", lo, end)
                    s.shut = True
                    pos = end
                    continue
            end = closers.brace(hi - 1)
            s = emit("command", lo, hi)
            if end is not None:
                ends[end] = s
                inside = max(inside, end + 1)
            pos = hi
            continue
        if kind == "group":
            s = emit(kind, lo, hi)
            if (end := closers.brace(lo)) is not None:
                ends[end] = s
                inside = max(inside, end + 1)
            pos = hi
            continue
        found = closers.of(kind, t, hi)
        s = emit(kind, lo, hi)
        pos = hi
        if found is not None:
            if found[0] > hi:
                out.append(Segment("code", text[hi : found[0]], hi, found[0]))
                at = found[0]
            e = emit(kind, *found)
            s.mate, e.mate = e, s
            s.shut = e.shut = True
            pos = found[1]
        elif hi == lo:
            pos = hi + 1
    if at < len(text):
        _split_run(text, at, len(text), ends, out)
    for i, s in enumerate(out):
        s.i = i
    return out


def _split_run(text: str, lo: int, hi: int, ends: dict[int, Segment], out: list[Segment]) -> None:
    """A plain run, cut at the braces that close commands."""
    if ends:
        for p in sorted(e for e in ends if lo <= e < hi):
            if p > lo:
                out.append(Segment("run", text[lo:p], lo, p))
            b = Segment("brace", "}", p, p + 1)
            b.mate = ends.pop(p)
            b.mate.mate = b
            out.append(b)
            lo = p + 1
    if hi > lo:
        out.append(Segment("run", text[lo:hi], lo, hi))


def _match(text: str, segs: list[Segment]) -> None:
    """Find the mates of the other delimiters: brackets, tags and environments nest, marks alternate."""
    stacks: dict[str, list[Segment]] = {}

    def close(key: str, s: Segment) -> None:
        if stacks.get(key):
            s.mate = stacks[key].pop()
            s.mate.mate = s

    for s in segs:
        k, t = s.kind, s.text
        if s.mate is not None:
            continue
        if k == "wopen":
            stacks.setdefault(t[0], []).append(s)
        elif k == "wclose":
            close("[" if t[0] == "]" else "{", s)
        elif k == "tag":
            if t[1] == "/":
                close("<" + _name(t), s)
            elif not t.endswith("/>"):
                stacks.setdefault("<" + _name(t), []).append(s)
        elif k == "env":
            name = t[t.find("{") :]
            if t.startswith("\\end"):
                close(name, s)
            else:
                stacks.setdefault(name, []).append(s)
        elif k in _PAIRED:
            before = text[s.start - 1] if s.start else " "
            after = text[s.end] if s.end < len(text) else " "
            opens = not after.isspace() and (k == "quote" or not before.isalnum())
            closes = not before.isspace() and (k == "quote" or not after.isalnum())
            st = stacks.get(t)
            if closes and st and "\n\n" not in text[st[-1].end : s.start]:
                close(t, s)
            elif opens:
                stacks[t] = [s]


def _siblings(text: str, segs: list[Segment]) -> dict[int, int]:
    """How many list or row markers of one family stand on neighbouring lines."""
    count: dict[int, int] = {}
    group: list[Segment] = []
    last = None

    def settle() -> None:
        for s in group:
            count[s.i] = len(group)

    for s in segs:
        if s.kind not in ("list", "row"):
            continue
        family = "d" if s.text[0] in ";:" else s.kind
        if last is None or last[0] != family or text.count("\n", last[1], s.start) > 1:
            settle()
            group = []
        group.append(s)
        last = (family, s.end - (1 if s.text.endswith("\n") else 0))
    settle()
    return count


def _flags(text: str, s: Segment, near: dict[int, int], wiki_table: bool) -> list[str]:
    """Properties of a delimiter and its surroundings, by kind."""
    k, t = s.kind, s.text
    before = text[s.start - 1] if s.start else " "
    after = text[s.end] if s.end < len(text) else " "
    out = ["mate"] if s.mate is not None else ["single"]
    if k == "tag":
        out.append("known" if _name(t) in TAGS else "unknown")
        if "=" in t or t.endswith("/>"):
            out.append("attr")
    elif k == "entity":
        n = t[1:]
        out.append("number" if n[0] == "#" else "known" if n in html5 or n.lower() in html5 else "unknown")
    elif k in ("list", "row"):
        mark = t.strip()[:1]
        out.append(f"n{min(near.get(s.i, 1), 3)}")
        out.append("digit" if mark.isdigit() else mark)
    elif k == "setext":
        out += [t[0], "under" if text[: s.start - 1].rsplit("\n", 1)[-1].strip() else "alone"]
    elif k == "heading":
        out += [t.lstrip()[0], "lines" if "\n" in text else "one"]
    elif k == "wtable":
        out += [t[:2].strip(), "table" if wiki_table else "bare"]
    elif k == "cell":
        head = text[text.rfind("\n", 0, s.start) + 1 : s.start][:1]
        out += [t, "table" if wiki_table and head in ("|", "!") else "bare"]
    elif k == "command":
        name = _command_name(t) if not s.shut else re.match(r"\\([A-Za-z]*)", t).group(1)
        known = name in COMMANDS or name in TEXT_COMMANDS or name in HEADING_COMMANDS or name in DROPPED_COMMANDS
        out.append("known" if known and len(name) > 1 else "unknown")
        if t[-1] in "{[" or s.shut:
            out.append("arg")
    elif k in ("wopen", "wclose", "math"):
        out.append(t[0] if k != "math" else t[1])
    elif k in _PAIRED or k in ("tick", "dollar"):
        out.append(f"len{min(len(t), 3)}")
        if s.mate is not None:
            lo, hi = sorted((s, s.mate), key=lambda x: x.start)
            out.append("filled" if text[lo.end : hi.start].strip() else "empty")
        else:
            out.append(("s" if before.isspace() else "w" if before.isalpha() else "d" if before.isdigit() else "p") + "_")
            out.append("_" + ("s" if after.isspace() else "w" if after.isalpha() else "d" if after.isdigit() else "p"))
    return out


def _features(text: str, segs: list[Segment]) -> list[tuple[str, ...] | None]:
    """Features of each delimiter (None for runs): its kind, single properties, all of them, and its company."""
    near = _siblings(text, segs)
    wiki_table = "{|" in text
    kinds = {s.kind for s in segs if s.kind not in ("run", "code", "brace", "star", "under", "list", "cell")}
    out: list[tuple[str, ...] | None] = []
    for s in segs:
        if s.kind in ("run", "code", "brace"):
            out.append(None)
            continue
        flags = _flags(text, s, near, wiki_table)
        company = "company" if kinds - {s.kind} else "lonely"
        out.append((s.kind, *(f"{s.kind}:{f}" for f in flags), f"{s.kind}={'+'.join(flags)}", company))
    return out


def delimiter_features(text: str) -> list[tuple[int, tuple[str, ...]]]:
    """(place, features) of each delimiter of a text."""
    segs = segments(text)
    _match(text, segs)
    return [(s.start, f) for s, f in zip(segs, _features(text, segs)) if f is not None]


def _hidden(text: str, segs: list[Segment]) -> list[tuple[int, int, Segment]]:
    """(start, end, construct) of text that shows nothing if its construct is markup."""
    out: list[tuple[int, int, Segment]] = []
    stack: list[tuple[Segment, list[int]]] = []
    for s in segs:
        if s.kind == "wopen" and s.mate is not None:
            stack.append((s, []))
        elif s.kind == "wclose" and s.mate is not None:
            while stack:
                opener, bars = stack.pop()
                if opener is s.mate:
                    _hide_link(text, opener, bars, out) if opener.text[0] == "[" else _hide_template(text, opener, bars, out)
                    break
        elif s.kind == "wopen" and s.text[0] == "{":
            line = text.find("\n", s.end)
            bar = text.find("|", s.end, line if line >= 0 else len(text))
            if bar >= 0:
                out.append((s.end, bar + 1, s))
        elif stack and "|" in s.text:
            at = s.text.find("|")
            while at >= 0:
                stack[-1][1].append(s.start + at)
                at = s.text.find("|", at + 1)
        elif s.mate is not None and s.mate.start > s.start and (
            s.kind == "tag" and _name(s.text) in DROPPED_TAGS or s.kind == "command" and _command_name(s.text) in DROPPED_COMMANDS
        ):
            out.append((s.end, s.mate.start, s))
    return out


def _hide_link(text: str, s: Segment, bars: list[int], out: list) -> None:
    if FILE_LINK.match(text, s.end, s.mate.start):
        out.append((s.end, s.mate.start, s))
    elif bars:
        out.append((s.end, bars[-1] + 1, s))


def _hide_template(text: str, s: Segment, bars: list[int], out: list) -> None:
    """Everything but the text a template shows: named text parameters, else the last unnamed one."""
    end = s.mate.start
    shown: list[tuple[int, int]] = []
    if bars and text.find("\n", s.end, end) < 0:
        last = None
        for lo, hi in zip(bars, [*bars[1:], end]):
            m = _NAMED.match(text, lo + 1, hi)
            if m is None:
                last = (lo + 1, hi)
            elif m.group(1).strip().lower() in TEXT_PARAMETERS:
                shown.append((m.end(), hi))
        if not shown and last is not None:
            shown.append(last)
    at = s.end
    for lo, hi in shown:
        out.append((at, lo, s))
        at = hi
    out.append((at, end, s))


def _cut_runs(segs: list[Segment], hidden: list[tuple[int, int, Segment]]) -> list[Segment]:
    """Segments with runs cut at the borders of hidden text; what lies inside knows its construct.

    Of nested constructs the outermost that hides the text owns it.
    """
    if not hidden:
        return segs
    spans: list[list] = []
    for lo, hi, s in sorted(hidden, key=lambda x: (x[0], -x[1])):
        if hi > lo and (not spans or hi > spans[-1][1]):
            spans.append([max(lo, spans[-1][1]) if spans else lo, hi, s])
    starts = [x[0] for x in spans]
    out: list[Segment] = []
    for s in segs:
        at = s.start
        while at < s.end:
            j = bisect_right(starts, at) - 1
            covered = j >= 0 and at < spans[j][1]
            stop = min(s.end, spans[j][1]) if covered else min(s.end, starts[j + 1] if j + 1 < len(starts) else s.end)
            if s.kind != "run":
                s.owner = spans[j][2] if covered else None
                out.append(s)
                break
            part = s if (at, stop) == (s.start, s.end) else Segment("run", s.text[at - s.start : stop - s.start], at, stop)
            part.owner = spans[j][2] if covered else None
            out.append(part)
            at = stop
    for i, s in enumerate(out):
        s.i = i
    return out


def _edges(text: str, segs: list[Segment]) -> list[dict[int, int]]:
    """Smoothness: delimiters near each other on a line, ends of one construct, hidden runs and their construct."""
    near: list[dict[int, int]] = [{} for _ in segs]

    def tie(a: Segment, b: Segment, w: int) -> None:
        near[a.i][b.i] = near[a.i].get(b.i, 0) + w
        near[b.i][a.i] = near[b.i].get(a.i, 0) + w

    last = None
    for s in segs:
        if s.kind in ("run", "code"):
            if s.owner is not None and s.kind == "run":
                tie(s, s.owner, TIE_INSIDE)
            continue
        if last is not None and s.start - last.end <= NEAR and "\n" not in text[last.end : s.start]:
            tie(last, s, TIE_NEAR)
        last = s
        if s.mate is not None and s.mate.start < s.start:
            tie(s.mate, s, TIE_MATES)
    return near


def minimum_cut(markup: list[int], content: list[int], near: list[dict[int, int]]) -> list[bool]:
    """Labels (True: markup) of least total cost.

    Cost: ``content[i]`` for a segment labelled markup, ``markup[i]`` for one labelled
    content, and the weight of each edge between different labels. Ties go to content.
    """
    n = len(markup)
    m, c = list(markup), list(content)
    label: list[bool | None] = [None] * n
    free = [sum(e.values()) for e in near]
    todo = deque(range(n))
    while todo:
        i = todo.popleft()
        if label[i] is not None:
            continue
        d = m[i] - c[i]
        if d > free[i] or d <= -free[i]:
            label[i] = d > 0
            for j, w in near[i].items():
                if label[j] is None:
                    free[j] -= w
                    if label[i]:
                        m[j] += w
                    else:
                        c[j] += w
                    todo.append(j)
    rest = [i for i in range(n) if label[i] is None]
    if rest:
        _max_flow(rest, m, c, near, label)
    return [bool(x) for x in label]


def _max_flow(rest, m, c, near, label) -> None:
    """Shortest augmenting paths on the unsettled segments; source side is markup."""
    s, t = -1, -2
    cap: dict[int, dict[int, int]] = {s: {}, t: {}}
    for i in rest:
        cap[i] = {j: w for j, w in near[i].items() if label[j] is None}
    for i in rest:
        base = min(m[i], c[i])
        cap[s][i], cap[i][t] = m[i] - base, c[i] - base
        cap[i][s] = cap[t][i] = 0
    while True:
        parent = {s: s}
        queue = deque([s])
        while queue and t not in parent:
            u = queue.popleft()
            for v, w in cap[u].items():
                if w > 0 and v not in parent:
                    parent[v] = u
                    queue.append(v)
        if t not in parent:
            break
        flow, v = None, t
        while v != s:
            w = cap[parent[v]][v]
            flow = w if flow is None or w < flow else flow
            v = parent[v]
        v = t
        while v != s:
            u = parent[v]
            cap[u][v] -= flow
            cap[v][u] = cap[v].get(u, 0) + flow
            v = u
    for i in rest:
        label[i] = i in parent


def label_segments(text: str, model=None) -> list[Segment]:
    """Segments of a text with their labels (a hidden run has the label of its construct)."""
    if model is None:
        from lexloom.llm.markup_model import cost_model

        model = cost_model()
    segs = segments(text)
    if all(s.kind == "run" for s in segs):
        return segs
    _match(text, segs)
    segs = _cut_runs(segs, _hidden(text, segs))
    pairs = [(0, 0) if s.kind == "brace" else (0, RUN) if f is None else model.costs(f) for s, f in zip(segs, _features(text, segs))]
    cut = minimum_cut([p[0] for p in pairs], [p[1] for p in pairs], _edges(text, segs))
    for s, x in zip(segs, cut):
        s.label = x
    return segs


def has_markup(text: str | None, model=None) -> bool:
    """Whether the cut labels any delimiter as markup. Null and empty texts have none."""
    return bool(text) and any(s.label and s.kind != "run" for s in label_segments(text, model))


_BLOCK = frozenset("p div section article blockquote ul ol dl table tr caption center pre hr br h1 h2 h3 h4 h5 h6 li dt dd".split())


class _Output:
    """Printed pieces; code and formulas keep their blanks, other text loses superfluous ones."""

    def __init__(self) -> None:
        self.parts: list[str] = []
        self.plain: list[str] = []

    def add(self, t: str) -> None:
        self.plain.append(t)

    def keep(self, t: str) -> None:
        self._flush()
        self.parts.append(t)

    def _flush(self) -> None:
        if self.plain:
            t = "".join(self.plain)
            self.plain = []
            t = re.sub(r"[ \t]{2,}", " ", t)
            t = re.sub(r"[ \t]+\n", "\n", t)
            self.parts.append(re.sub(r"\n{3,}", "\n\n", t))

    def raise_heading(self, level: int) -> None:
        """Make the last printed line a heading."""
        line = "".join(self.plain).rstrip("\n")
        head, nl, last = line.rpartition("\n")
        self.plain = [f"{head}{nl}{'#' * level} {last}"]

    def text(self) -> str:
        self._flush()
        return "".join(self.parts).strip()


def clean_text(text: str | None, model=None) -> str | None:
    """Readable text: markup is gone; headings (``#``), list items (``-``), code and formulas stay.

    Null stays null. A text without markup is returned as it is. Text that only tells how a
    construct is made (link targets, template names, references, scripts) is left out.
    """
    if text is None:
        return None
    segs = label_segments(text, model)
    if not any(s.label for s in segs):
        return text
    out = _Output()
    for s in segs:
        t, k = s.text, s.kind
        if s.owner is not None and s.owner.label:
            if k == "run" and s.owner.end < s.start and s.owner.mate is not None and s.end < s.owner.mate.start:
                out.add(" ")  # between two shown parts of a template
            continue
        if k == "run":
            if not s.label:
                out.add(t)
        elif k == "code":
            opener = segs[s.i - 1]
            if opener.kind == "tag" and opener.label and _name(opener.text) == "nowiki":
                out.add(t)
            else:
                out.keep(t)
        elif k == "brace":
            if not s.mate.label:
                out.add(t)
            elif s.mate.kind == "command" and _command_name(s.mate.text) in HEADING_COMMANDS:
                out.add("\n")
        elif not s.label:
            out.add(t)
        else:
            _print_markup(s, out)
    return out.text()


def _print_markup(s: Segment, out: _Output) -> None:
    """What a labelled delimiter leaves in the text."""
    t, k = s.text, s.kind
    if k == "setext":
        out.raise_heading(1 if t[0] == "=" else 2)
    elif k == "entity":
        u = html.unescape(t)
        out.add(u if u != t else html.unescape(t.lower()))
    elif k == "tag":
        _print_tag(s, out)
    elif k == "heading":
        body = t.strip()
        if body[0] == "=":
            level = min(len(body) - len(body.lstrip("=")), 6)
            out.add(f"{'#' * level} {body.strip('= ')}")
        else:
            out.add(body + " ")
    elif k == "fence":
        mark = "`" * max(3, len(t.strip()) - len(t.strip().lstrip(t.strip()[0])))
        out.keep(mark + ("" if s.mate is not None and s.mate.start < s.start else t.strip().strip("`~")))
    elif k == "list":
        mark = t.strip()
        out.add("> " if mark[0] == ">" else f"{mark} " if mark[0].isdigit() else "" if mark[0] == ";" else "- ")
    elif k == "row":
        out.add(" | ".join(x.strip() for x in t.strip().strip("|").split("|")))
    elif k == "cell":
        out.add(" | ")
    elif k == "mdlink":
        out.add(t[t.index("[") + 1 : t.index("](")])
    elif k == "extlink":
        out.add(t[1:-1].partition(" ")[2])
    elif k == "env":
        name = t[t.find("{") + 1 : -1].rstrip("*")
        if name in MATH_ENVIRONMENTS:
            out.keep("$$")
        elif name in CODE_ENVIRONMENTS:
            out.keep("```")
    elif k == "math":
        out.keep("$$" if t[1] in "[]" else "$")
    elif k in ("dollar", "tick"):
        out.keep(t) if s.shut else out.add(t if k == "dollar" else "")
    elif k == "script":
        out.keep(t)
    elif k == "command":
        _print_command(s, out)


def _print_tag(s: Segment, out: _Output) -> None:
    t = s.text
    name, closing = _name(t), t[1] == "/"
    if name in FORMULA_TAGS and s.shut:
        out.keep("$")
    elif name in CODE_TAGS and s.shut and name != "nowiki":
        inline = name in ("code", "tt")
        out.keep("`" if inline else "\n```" if closing else "```\n" if not out.parts and not out.plain else "\n```\n")
    elif name == "li" and not closing:
        out.add("\n- ")
    elif len(name) == 2 and name[0] == "h" and name[1].isdigit():
        out.add("\n" if closing else f"\n{'#' * int(name[1])} ")
    elif name in ("td", "th") and closing:
        out.add(" | ")
    elif name in _BLOCK:
        out.add("\n")


def _print_command(s: Segment, out: _Output) -> None:
    t = s.text
    name = _command_name(t)
    if s.shut:
        out.keep(t)
    elif name == "item":
        out.add("- " if t[-1] != "[" else "- [")
    elif name in HEADING_COMMANDS:
        out.add(f"\n{'#' * HEADING_COMMANDS[name]} ")
    elif name in SPACE_COMMANDS:
        out.add(SPACE_COMMANDS[name])
    elif name in TEXT_COMMANDS or name in DROPPED_COMMANDS or t[-1] == "{" and s.mate is not None:
        pass
    else:
        out.keep(t)  # a sign of a formula


# --- DataFrames ------------------------------------------------------------------------


def _inflate(data: bytes | None) -> str | None:
    if not data:
        return None
    try:
        return zlib.decompress(data).decode("utf-8", "replace")
    except zlib.error:
        return None


def _texts(spark: SparkSession, data_dir: str) -> tuple[DataFrame, DataFrame]:
    senses = table(spark, data_dir, "senses").select(
        F.lit("senses").alias("table_name"), F.col("seq").cast("string").alias("record_key"), F.col("definition").alias("body")
    )
    leads = table(spark, data_dir, "candidates").select(
        F.lit("candidates").alias("table_name"), F.col("title").alias("record_key"), F.col("lead_z").alias("body")
    )
    return senses.where("record_key is not null"), leads.where("record_key is not null and length(body) > 0")


def _map_texts(df: DataFrame, fn, out: str, kind: str) -> DataFrame:
    """``fn`` of each body (text, or a zlib stream of it) and of the fitted model, by Arrow batches."""
    from lexloom.llm.markup_model import cost_model

    model = cost_model()  # fitted on the driver, sent along with the function

    def run(batches):
        import pyarrow as pa

        for b in batches:
            body = b.column(2).to_pylist()
            if pa.types.is_binary(b.schema.field(2).type):
                body = [_inflate(x) for x in body]
            made = pa.array([fn(x, model) for x in body], pa.bool_() if kind == "boolean" else pa.string())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), made], names=["table_name", "record_key", out])

    return df.mapInArrow(run, f"table_name string, record_key string, {out} {kind}")


def records_with_markup(senses: DataFrame, leads: DataFrame) -> DataFrame:
    """Distinct ``(table_name, record_key)`` whose text holds markup.

    Null, empty and undecodable texts hold none; repeated deliveries of a title count once.
    """
    some = spread(senses.where(F.col("body").rlike(PREFILTER)))
    hits = _map_texts(some, has_markup, "hit", "boolean").unionByName(_map_texts(leads, has_markup, "hit", "boolean"))
    return hits.where("hit").select("table_name", "record_key").distinct()


def cleaned_records(senses: DataFrame, leads: DataFrame) -> DataFrame:
    """``(table_name, record_key, clean)``, one row per input row (repeated rows stay)."""
    plain = senses.where(~F.coalesce(F.col("body").rlike(PREFILTER), F.lit(False)))
    some = spread(senses.where(F.col("body").rlike(PREFILTER)))
    return (
        plain.withColumnRenamed("body", "clean")
        .unionByName(_map_texts(some, clean_text, "clean", "string"))
        .unionByName(_map_texts(leads, clean_text, "clean", "string"))
    )


def p1_found(spark: SparkSession, data_dir: str) -> DataFrame:
    """Records whose text holds at least one construct of markup."""
    return records_with_markup(*_texts(spark, data_dir))


def p1_clean(spark: SparkSession, data_dir: str) -> DataFrame:
    """Clean text of every definition and lead."""
    return cleaned_records(*_texts(spark, data_dir))
