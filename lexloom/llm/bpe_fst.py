"""Byte-level BPE as a lazily determinised finite-state transducer.

Why the greedy merge loop can be run left to right
--------------------------------------------------
Let ``enc(p)`` be the merge-loop encoding of a byte string ``p``. Two facts hold for a
proper merge list (checked by the tests against the merge loop itself):

* a token sequence is an encoding exactly when each adjacent pair ``(s, t)`` is
  *compatible*: ``enc(s + t) == [s, t]``;
* dropping the last token of ``enc(p)`` leaves an encoding of a shorter prefix.

So the last token of ``enc(p[:i+1])`` is the one token ``t`` that ends at ``i`` and is
compatible with the last token of ``enc(p[:i+1-len(t)])``. Which tokens can end at a
position is known from the longest suffix read so far that begins some token (the state of
an Aho-Corasick automaton), and the last tokens needed lie inside that suffix. The pair
(suffix, last tokens at its positions) is therefore a finite state; its transitions are
computed when they are first taken and kept (``_step``).

The token borders before the suffix can no longer change, so output is emitted with a
lookahead that is bounded by the longest token.
"""

from __future__ import annotations

import base64
import json
import os
import re
from functools import lru_cache

import regex

#: Fixed value: the published pre-tokenisation pattern of the byte-level vocabularies.
PRETOKEN_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

DEFAULT_FOLDER = "/opt/tokenizers"
START = -1


def vocabulary_path(name: str = "byte_bpe_50k.tiktoken", folder: str = DEFAULT_FOLDER) -> str:
    return os.path.join(folder, name)


def _byte_of_symbol() -> dict[str, int]:
    """The printable stand-ins that JSON vocabularies use for bytes."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table = {chr(b): b for b in shown}
    rest = [b for b in range(256) if b not in set(shown)]
    table.update({chr(256 + n): b for n, b in enumerate(rest)})
    return table


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to id, where a lower id is an earlier merge.

    Reads rank files (``base64 id`` lines) and byte-level JSON vocabularies.
    """
    if path.endswith(".json"):
        with open(path, encoding="utf-8") as f:
            model = json.load(f)
        special = {t["content"] for t in model.get("added_tokens", ())}
        sym = _byte_of_symbol()
        return {bytes(sym[c] for c in tok): i for tok, i in model["model"]["vocab"].items() if tok not in special}
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(i) for a, i in (line.split() for line in f if line.strip())}


def merge_loop(ranks: dict[bytes, int], piece: bytes) -> list[int]:
    """The defining (quadratic) encoder: always merge the adjacent pair of lowest rank."""
    parts = [piece[i : i + 1] for i in range(len(piece))]
    while len(parts) > 1:
        best, at = None, -1
        for i in range(len(parts) - 1):
            r = ranks.get(parts[i] + parts[i + 1])
            if r is not None and (best is None or r < best):
                best, at = r, i
        if best is None:
            break
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return [ranks[p] for p in parts]


class BpeTransducer:
    """Encoder of one vocabulary. States and transitions are made on demand.

    ``max_transitions`` and ``max_pieces`` bound the two caches; a full cache is emptied
    and refilled, which costs time but never changes a result.
    """

    def __init__(self, ranks: dict[bytes, int], max_transitions: int = 400_000, max_pieces: int = 200_000) -> None:
        self.ranks = ranks
        self.token = {i: t for t, i in ranks.items()}
        self.size = {i: len(t) for t, i in ranks.items()}
        self.starts = {t[:k] for t in ranks for k in range(1, len(t) + 1)}
        self.longest = max(map(len, ranks))
        self._compatible: dict[tuple[int, int], bool] = {}
        self._delta: dict[tuple[tuple, int], tuple] = {}
        self._pieces: dict[str, bytes] = {}
        self._pretokens: dict[str, bytes] = {}
        self.max_transitions, self.max_pieces = max_transitions, max_pieces
        self.split = regex.compile(PRETOKEN_PATTERN).findall
        self.initial = (b"", (START,))

    def compatible(self, s: int, t: int) -> bool:
        if s == START:
            return True
        key = (s, t)
        known = self._compatible.get(key)
        if known is None:
            if len(self._compatible) >= self.max_transitions:
                self._compatible.clear()
            known = self._compatible[key] = merge_loop(self.ranks, self.token[s] + self.token[t]) == [s, t]
        return known

    def _step(self, state: tuple, byte: int) -> tuple:
        """The state after one more byte; its last token is ``result[1][0]``."""
        suffix, last = state
        grown = suffix + bytes((byte,))
        found = None
        for start in range(len(grown)):  # longest candidate first
            t = self.ranks.get(grown[start:])
            if t is not None and self.compatible(last[len(grown) - start - 1], t):
                found = t
                break
        if found is None:
            raise ValueError(f"the vocabulary has no token for byte {byte}")
        while grown not in self.starts:
            grown = grown[1:]
        return grown, (found, *last[: len(grown)])

    def _advance(self, state: tuple, byte: int) -> tuple:
        key = (state, byte)
        nxt = self._delta.get(key)
        if nxt is None:
            if len(self._delta) >= self.max_transitions:
                self._delta.clear()
            nxt = self._delta[key] = self._step(state, byte)
        return nxt

    def encode_piece(self, piece: bytes) -> list[int]:
        """Ids of one pre-token. A short one is run through at once; a longer one is emitted by bounded lookahead."""
        if len(piece) > 4 * self.longest:
            return list(self.stream([piece]))
        state, ends = self.initial, []
        for b in piece:
            state = self._advance(state, b)
            ends.append(state[1][0])
        out, at = [], len(piece)
        while at:
            t = ends[at - 1]
            out.append(t)
            at -= self.size[t]
        out.reverse()
        return out

    def stream(self, chunks):
        """Ids of one pre-token that arrives in byte chunks, emitted as soon as they are settled.

        Only positions inside the current suffix can still start a token, so everything
        before the last border common to all of them is final.
        """
        state, ends, base, since = self.initial, [], 0, 0
        for chunk in chunks:
            for b in chunk:
                state = self._advance(state, b)
                ends.append(state[1][0])
                since += 1
                if since >= 2 * self.longest:
                    since = 0
                    settled = self._settled(ends, base, len(state[0]))
                    yield from settled[0]
                    ends, base = ends[settled[1] :], base + settled[1]
        yield from self._back(ends, len(ends))

    def _back(self, ends: list[int], at: int) -> list[int]:
        out = []
        while at > 0:
            out.append(ends[at - 1])
            at -= self.size[ends[at - 1]]
        return out[::-1]

    def _settled(self, ends: list[int], base: int, window: int) -> tuple[list[int], int]:
        n = len(ends)
        common: set[int] | None = None
        for at in range(max(0, n - window), n + 1):
            borders, p = {at}, at
            while p > 0:
                p -= self.size[ends[p - 1]]
                borders.add(p)
            common = borders if common is None else common & borders
        cut = max(common or {0})
        return self._back(ends, cut), cut

    # --- whole texts -----------------------------------------------------------------

    def _chunk_ids(self, chunk: str) -> bytes:
        """Little-endian int32 ids of a chunk that pre-tokenisation never joins to its neighbours."""
        import array
        import sys

        memo, out = self._pretokens, []
        for pre in self.split(chunk):
            ids = memo.get(pre)
            if ids is None:
                a = array.array("i", self.encode_piece(pre.encode("utf-8", "replace")))
                if sys.byteorder == "big":
                    a.byteswap()
                ids = a.tobytes()
                if len(pre) <= 64:
                    if len(memo) >= self.max_pieces:
                        memo.clear()
                    memo[pre] = ids
            out.append(ids)
        return b"".join(out)

    def encode_bytes(self, text: str) -> bytes:
        """Ids of a text as packed int32.

        A border before a single blank between two non-blank characters is always a
        pre-token border, so the text is cut there and each distinct chunk is run
        through the transducer once per worker.
        """
        if not text:
            return b""
        memo = self._pieces
        if _BLANK_PAIR(text):
            parts = _safe_chunks(text.split(" "))
        else:
            parts = text.replace(" ", "\0 ").split("\0") if "\0" not in text else _safe_chunks(text.split(" "))
        try:
            return b"".join([memo[p] for p in parts])
        except KeyError:
            pass
        if len(memo) >= self.max_pieces:
            memo.clear()
        out = []
        for p in parts:
            ids = memo.get(p)
            if ids is None:
                ids = self._chunk_ids(p)
                if len(p) <= 256:
                    memo[p] = ids
            out.append(ids)
        return b"".join(out)

    def encode(self, text: str | None) -> list[int]:
        """Ids of a text; null and empty texts have the empty list."""
        import array

        a = array.array("i")
        a.frombytes(self.encode_bytes(text or ""))
        return a.tolist()

    def decode(self, ids) -> str:
        """Text of ids; see :class:`Utf8Machine` for how broken bytes are shown."""
        m = Utf8Machine()
        return "".join(m.feed(self.token[i]) for i in ids) + m.finish()


#: A blank beside other white space; elsewhere each blank is a safe place to cut.
_BLANK_PAIR = re.compile(r" \s|\s ").search


def _safe_chunks(parts: list[str]) -> list[str]:
    """Rejoin pieces of ``text.split(' ')`` wherever the blank is not between two non-blanks."""
    out, cur = [], parts[0]
    for p in parts[1:]:
        if cur and not cur[-1].isspace() and p and not p[0].isspace():
            out.append(cur)
            cur = " " + p
        else:
            cur += " " + p
    out.append(cur)
    return [c for c in out if c]


class Utf8Machine:
    """Incremental UTF-8 decoder as an explicit state machine.

    ``feed`` returns the characters completed so far; bytes of an unfinished character
    wait for the next call. A byte that cannot continue gives U+FFFD for the broken part
    (maximal subpart rule) and is then read afresh.
    """

    def __init__(self) -> None:
        self.need = 0  # continuation bytes still expected
        self.low, self.high = 0x80, 0xBF  # bounds of the next continuation byte
        self.held = 0  # bits gathered

    def feed(self, data: bytes) -> str:
        out = []
        for b in data:
            if self.need:
                if self.low <= b <= self.high:
                    self.held = self.held << 6 | b & 0x3F
                    self.need -= 1
                    self.low, self.high = 0x80, 0xBF
                    if not self.need:
                        out.append(chr(self.held))
                    continue
                out.append("�")
                self.need, self.low, self.high = 0, 0x80, 0xBF
            if b < 0x80:
                out.append(chr(b))
            elif 0xC2 <= b <= 0xDF:
                self.need, self.held = 1, b & 0x1F
            elif 0xE0 <= b <= 0xEF:
                self.need, self.held = 2, b & 0x0F
                if b == 0xE0:
                    self.low = 0xA0
                elif b == 0xED:
                    self.high = 0x9F
            elif 0xF0 <= b <= 0xF4:
                self.need, self.held = 3, b & 0x07
                if b == 0xF0:
                    self.low = 0x90
                elif b == 0xF4:
                    self.high = 0x8F
            else:
                out.append("�")
        return "".join(out)

    def finish(self) -> str:
        """The end of input: an unfinished character becomes U+FFFD."""
        broken, self.need = self.need, 0
        self.low, self.high = 0x80, 0xBF
        return "�" if broken else ""


@lru_cache(maxsize=4)
def transducer(path: str) -> BpeTransducer:
    """One transducer per vocabulary file and Python worker."""
    return BpeTransducer(load_ranks(path))
