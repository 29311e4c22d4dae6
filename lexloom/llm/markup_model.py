"""Costs of text segments: a log-linear classifier fitted on generated, labelled texts.

No labelled data exist, so the sample is made here: pieces of plain text, of notation that
merely looks like markup, and of markup constructs are put together at random, and each
delimiter takes the label of the piece it lies in. The sample is bounded (``SAMPLES``
texts, one fixed seed); the fit is convex and gives the same weights everywhere. The odds
of a segment become its two terminal capacities.
"""

from __future__ import annotations

import math
import random
from functools import lru_cache

import numpy as np

#: Texts in the generated sample.
SAMPLES = 9000
#: Capacity per unit of log-probability, and the largest capacity.
SCALE, MOST = 6.0, 40

_RU = "мера длины сосуд игра вода глина обряд часть свет уголь ремонт печать в на для и с по слово раствор лес зерно книга".split()
_EN = "measure vessel water part light seal for in of and the word stone river book art".split()
_ID = "main_index ris.png ustav a1 f_x dom temp_file key-1 http".split()

#: Hand-labelled pieces. ``@w`` word, ``@p`` phrase, ``@n`` number, ``@i`` identifier, ``@c`` capital word.
MARKUP = (
    "<b>@p</b>", "<i>@w", "</div>", "<br>", "<br/>", "<BR />", "<u >@p</u>", '<a href="@i">@p</a>', '<span class="@i">@p</span>',
    "<font color=red>@p</font>", "<ref>@p</ref>", '<ref name="@i"/>', "<nowiki>@p</nowiki>", "<math>x^2</math>", "<hr>",
    "<custom>@p</custom>", '<data-x y="@n">', "<img\nsrc=@i\nalt='@w'>", "<p>@p</p>", "<sup>@n</sup>", "<pre>@w @n\n@w</pre>",
    "<!-- @p -->", "&nbsp;", "&laquo;", "&#@n;", "&#xA0;", "&mdash;", "&amp;", "[[@w]]", "[[@w|@p]]", "[[@w", "@w]]", "[[#@c|@p]]",
    "[[Файл:@i|@w]]", "{{@w}}", "{{-}}", "{{@w|@p}}", "{{@w|@w=@p}}", "{{@w|", "@w}}", "''@p''", "'''@p'''", "'''@p", "@p'''",
    "**@p**", "**@w", "@w**", "*@p*", "_@p_", "__@p__", "***@w***", "~~@p~~", "~~@w", "`@i`", "`@p`", "``@i``", "[@p](@i)", "![@w](@i)",
    "[@w](#@i)", "[^@n]", "[^@n]: @p", "[https://@i @p]", "$x^2$", "$\\frac{a}{b}$", "$a_1 + b$", "$$\nx = \\sum_{i=1}^{n} x_i\n$$", "\\textbf{@p}",
    "\\textit{@p @p}", "\\emph{@w}", "\\underline{@p}", "\\cite{@i}", "\\alpha_{0}", "\\alpha", "\\frac{1}{2}", "\\section{@p}", "\\ldots", "\\footnote{@p}",
    "{\\it @p}", "{\\bf @p}", "\\(a_{i}+b\\)", "\\[ s = vt \\]", "x_{@n}", "__NOTOC__", "__TOC__",
)
MARKUP_BLOCKS = (
    "\n== @c ==\n@p", "\n===@c===\n@p", "\n\n## @c\n\n@p", "\n# @c\n@p", "\n\n@c\n=======\n@p", "\n\n@c\n-----\n@p", "\n- @p\n- @p", "\n* @p\n* @p\n* @p",
    "\n*@p\n*@p", "\n1. @p\n2. @p", "\n1) @p\n2) @p\n3) @p", "\n# @p\n# @p", "\n;@w\n:@p", "\n: @p\n: @p", "\n\n> @p\n> @p",
    "\n| @p | @p |\n|---|---|\n| @n | @n |", '\n{| class="@i"\n! @p\n|-\n| @p || @p\n|}', "\n{|\n! @w !! @w\n|-\n| @w || @w\n|}", "\n```\n@i = @n\n```",
    "\n```py\nprint(@w)\n```", "\n\\begin{itemize}\n\\item @p\n\\item @p\n\\end{itemize}", "\n\\begin{equation}\nx_{1}\n\\end{equation}",
)
NOTATION = (
    "t >@n° и <@n°", "@w == @w", "a == b", "[ср. выше]", "@w \\ @w", "(*)", "№ #@n", "<и> — <э>", "<@w>", "@n * @n = @n", "*@w > @w", "[0; 1)", "{0}",
    "{@n, @n}", "~@n", "≈@n", "@n | @n", "x < y и y > z", "@w & @w", "А & Б", "a:b::c:d", "-- @w", "@i", "main_index", "имя main_index и file_name", "@n $", "$ @n",
    "@n $ за штуку", "$@n и @n$", "$@n", "@n\" @w", "@w's", "C:\\@i", "\\ @w", "2^10", "x*y", "*@w", "* * *", "**", "[@n]", "[@w]", "(@w)[@n]", "x_1", "R&D;", "&@w;",
    "<3", "<@n", "-> @w", "=> @w", "|@w|", "@w/@w", "#@w", "#@n", "`@w", "'@w'", "{x | x > 0}", "<@w, @w>", "~@w", "a|b", "@w | @w", "@w!!", "*-@w-", "@w*", "_@w", "[-@n]",
    "a || b", "@n_@n", "f(x)", "<a> и <b>", "A<B", "*е > о", "@w''", "@n''", "@w@n", "%%", "{@w}", "[@p]", "{@p}",
)
NOTATION_BLOCKS = ("\n- @p", "\n@n. @p", "\n— @p\n— @p", "\n@n) @p", "\n-- @p", "\n* * *\n@p", "\n@p\n@p", "\n+ @n")


def _fill(piece: str, rng: random.Random) -> str:
    words = _RU if rng.random() < 0.7 else _EN
    out, i = [], 0
    while i < len(piece):
        if piece[i] == "@" and i + 1 < len(piece):
            k = piece[i + 1]
            if k == "w":
                out.append(rng.choice(words))
            elif k == "c":
                out.append(rng.choice(words).capitalize())
            elif k == "p":
                out.append(" ".join(rng.choice(words) for _ in range(rng.randint(1, 4))) + rng.choice(["", "", ".", ","]))
            elif k == "n":
                out.append(str(rng.randint(0, 1999)))
            else:
                out.append(rng.choice(_ID))
            i += 2
        else:
            out.append(piece[i])
            i += 1
    return "".join(out)


def sample(seed: int = 11, size: int = SAMPLES):
    """(text, spans of markup) pairs."""
    rng = random.Random(seed)
    for _ in range(size):
        plan = []
        for _ in range(rng.choice((1, 1, 2, 3))):
            if rng.random() < 0.55:
                plan.append((rng.choice(MARKUP), True))
            else:
                plan.append((rng.choice(NOTATION), False))
        tail = rng.random()
        if tail < 0.25:
            plan.append((rng.choice(MARKUP_BLOCKS), True))
        elif tail < 0.4:
            plan.append((rng.choice(NOTATION_BLOCKS), False))
        text, spans = _fill("@c @p", rng) + " ", []
        for piece, label in plan:
            done = _fill(piece, rng)
            if label:
                spans.append((len(text), len(text) + len(done)))
            text += done + ("" if piece[0] == "\n" else rng.choice([" ", " ", ", ", ". "])) + _fill("@p", rng) + " "
        yield text.rstrip(), spans


def vectors(features: list[tuple[str, ...]], names: dict[str, int]) -> np.ndarray:
    x = np.zeros((len(features), len(names) + 1), dtype=np.float64)
    x[:, -1] = 1.0
    for i, f in enumerate(features):
        for name in f:
            j = names.get(name)
            if j is not None:
                x[i, j] = 1.0
    return x


def fit_logistic(x: np.ndarray, y: np.ndarray, counts: np.ndarray, ridge: float = 0.3, steps: int = 40) -> np.ndarray:
    """Weights of a ridge-penalised logistic model by Newton steps; rows stand for ``counts`` equal ones."""
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1.0 / (1.0 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (counts * (p - y)) + ridge * w
        hess = (x * (counts * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(hess, grad)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


class CostModel:
    """Terminal capacities of segments by their features."""

    def __init__(self, names: dict[str, int], weights: np.ndarray) -> None:
        self.names = names
        self.weights = {n: float(weights[j]) for n, j in names.items()}
        self.bias = float(weights[-1])
        self._memo: dict[tuple[str, ...], tuple[int, int]] = {}

    def costs(self, features: tuple[str, ...]) -> tuple[int, int]:
        """(evidence for markup, evidence for content): scaled negative log-probabilities of the other label."""
        c = self._memo.get(features)
        if c is None:
            z = self.bias + sum(self.weights.get(f, 0.0) for f in features)
            markup = min(MOST, round(SCALE * math.log1p(math.exp(min(z, 30.0)))))
            content = min(MOST, round(SCALE * math.log1p(math.exp(min(-z, 30.0)))))
            c = self._memo[features] = (markup, content)
        return c


@lru_cache(maxsize=1)
def cost_model() -> CostModel:
    """The fitted model (fitted once per process, about a second; the driver sends it to the tasks)."""
    from lexloom.llm.markup import delimiter_features

    rows: dict[tuple[str, ...], list[int]] = {}
    for text, spans in sample():
        for at, feats in delimiter_features(text):
            rows.setdefault(feats, [0, 0])[any(a <= at < b for a, b in spans)] += 1
    keys = sorted(rows)
    names = {n: i for i, n in enumerate(sorted({f for k in keys for f in k}))}
    x = vectors([k for k in keys for _ in (0, 1)], names)
    y = np.array([v for _ in keys for v in (0.0, 1.0)])
    n = np.array([float(c) for k in keys for c in rows[k]])
    return CostModel(names, fit_logistic(x[n > 0], y[n > 0], n[n > 0]))
