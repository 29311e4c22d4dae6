"""Problem 7: passages of evaluation items inside corpus documents.

Windows of ``width`` words are embedded by the CGK random walk, which turns edit distance
between word sequences into Hamming distance between embeddings; sampled positions of the
embedding make the hash keys (bit-sampling LSH); colliding windows are verified exactly.

With ``edits=0`` - what ``p7_found`` needs: a shared run of 12 words - equal windows have
equal embeddings, so one repetition already has recall 1. For ``edits=k`` the number of
repetitions is measured for the recall asked for (:func:`repetitions`), and items shorter
than the window are searched with windows of their own size.

Work per document is linear in its words and mostly numpy: words are hashed from the UTF-8
buffer, a bitmap of item words rules out windows that cannot be within ``edits`` of any
item window, and only the remaining windows walk. The item side is broadcast to the Python
workers only while its window count, which is counted first, stays under
``broadcast_windows``; beyond that, both sides are keyed and joined by a shuffle.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexloom.llm.textwords import normal_words
from lexloom.runtime import spread
from lexloom.sources.tables import table

WIDTH = 12
BROADCAST_WINDOWS = 400_000
BITMAP_BITS = 20
BLOCK_BYTES = 1 << 20
#: Items of fewer words are not searched with edits; a recall that needs more repetitions is refused.
LEAST_WORDS = 5
MOST_REPETITIONS = 400
#: Bits of the filter of item keys that the shuffled search sends to the document side.
FILTER_BITS = 1 << 26

_U = np.uint64
_POWERS = [np.ones(1, dtype=_U)]
_BASE = _U(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _powers(n: int) -> np.ndarray:
    if len(_POWERS[0]) < n:
        p = np.full(max(n, 64), _BASE, dtype=_U)
        p[0] = 1
        _POWERS[0] = np.cumprod(p)
    return _POWERS[0]


class Words:
    """Word hashes and word places of normalised texts laid end to end."""

    def __init__(self, texts: list[str]) -> None:
        blobs = [t.encode("utf-8") for t in texts]
        self.buffer = b"".join(blobs)
        data = np.frombuffer(self.buffer, dtype=np.uint8)
        ends = np.cumsum([len(b) for b in blobs], dtype=np.int64) if blobs else np.zeros(0, np.int64)
        blank = np.flatnonzero(data == 32)
        # a word lies between two blanks that are not neighbours
        if len(blank) > 1:
            gap = np.diff(blank) > 1
            self.start = blank[:-1][gap] + 1
            self.end = blank[1:][gap]
        else:
            self.start = self.end = np.zeros(0, np.int64)
        self.doc = np.searchsorted(ends, self.start, side="right")
        self.hash = np.empty(len(self.start), dtype=_U)
        upto = np.concatenate([[0], np.cumsum(self.end - self.start)])
        lo = 0
        while lo < len(self.start):  # blocks of about 1 MB keep the temporaries small
            hi = max(lo + 1, int(np.searchsorted(upto, upto[lo] + BLOCK_BYTES, side="right")) - 1)
            size = self.end[lo:hi] - self.start[lo:hi]
            inside = upto[lo:hi] - upto[lo]
            k = np.arange(int(size.sum())) - np.repeat(inside, size)
            at = np.repeat(self.start[lo:hi], size) + k
            terms = (data[at].astype(_U) + _U(1)) * _powers(int(size.max()) + 1)[k]
            self.hash[lo:hi] = _mix(np.add.reduceat(terms, inside))
            lo = hi

    def phrase(self, first: int, width: int) -> bytes:
        return self.buffer[self.start[first] : self.end[first + width - 1]]


def windows(words: Words, width: int) -> np.ndarray:
    """Index of the first word of each full window (windows stay inside one text)."""
    n = len(words.doc)
    if n < width:
        return np.zeros(0, np.int64)
    return np.flatnonzero(words.doc[: n - width + 1] == words.doc[width - 1 :])


def cgk(hashes: np.ndarray, first: np.ndarray, width: int, seed: int, length: int) -> np.ndarray:
    """CGK embeddings, one row per window: ``length`` (up to 3 * width) symbols.

    Step ``j`` copies the current word and moves on if the random bit of (``j``, word) is
    1; a window that is used up is padded with 0. Walks on windows at edit distance 1 fall
    into step again after a few moves, so their embeddings differ in few places.
    """
    i = np.zeros(len(first), dtype=np.int64)
    out = np.zeros((len(first), length), dtype=_U)
    for j in range(length):
        live = i < width
        sym = np.where(live, hashes[np.minimum(first + i, len(hashes) - 1)], _U(0)) if len(hashes) else out[:, j]
        out[:, j] = sym
        bit = _mix(sym ^ _U((0xD1B54A32D192ED03 * (seed * 1009 + j + 1)) & (2**64 - 1))) >> _U(63)
        i += (bit == 1) & live
    return out


@lru_cache(maxsize=64)
def hit_rates(edits: int, width: int, sampled: int, trials: int = 600, reps: int = 48) -> np.ndarray:
    """Share of repetitions in which a window meets its copy with ``edits`` random edits, one value per trial.

    Windows of distinct words are edited at random (a third each of substitutions, insertions
    and deletions, the copy cut or filled to ``width`` words), which is the hard case: equal
    words in a window only make walks fall into step sooner. The seed is fixed.
    """
    rng = np.random.default_rng(17 * edits + width)
    pairs = np.empty((2 * trials, width), dtype=_U)
    for i in range(trials):
        one = list(rng.integers(1, 2**63, size=width, dtype=np.int64))
        two = list(one)
        for _ in range(edits):
            at, kind, new = int(rng.integers(0, len(two))), int(rng.integers(0, 3)), int(rng.integers(1, 2**63))
            if kind == 0:
                two[at] = new
            elif kind == 1:
                two.insert(at, new)
            else:
                del two[at]
        two = (two + list(rng.integers(1, 2**63, size=edits, dtype=np.int64)))[:width]
        pairs[2 * i], pairs[2 * i + 1] = np.array(one, dtype=_U), np.array(two, dtype=_U)
    keys = lsh_keys(pairs.ravel(), np.arange(2 * trials) * width, width, edits, reps, sampled)
    return (keys[0::2] == keys[1::2]).mean(axis=1)


def repetitions(edits: int, width: int, sampled: int, recall: float) -> int:
    """How many LSH repetitions reach ``recall`` for windows at ``edits`` edits, from measured hit rates.

    Repetitions are independent, so a pair with hit rate ``p`` is missed by ``r`` of them with
    probability ``(1 - p) ** r``; the mean over the trials must not exceed ``1 - recall``.
    """
    if edits == 0:
        return 1
    missed = 1 - hit_rates(edits, width, sampled)
    r = 1
    while (missed**r).mean() > 1 - recall and r < MOST_REPETITIONS:
        r += 1
    if (missed**r).mean() > 1 - recall:
        raise ValueError(f"recall {recall} at {edits} edits in {width} words needs more than {MOST_REPETITIONS} repetitions")
    return r


def lsh_keys(hashes: np.ndarray, first: np.ndarray, width: int, edits: int, reps: int, sampled: int) -> np.ndarray:
    """Hash keys, shape (windows, reps): sampled places of an independent walk each."""
    out = np.zeros((len(first), reps), dtype=_U)
    for r in range(reps):
        rng = np.random.default_rng(7919 * (r + 1))
        # a walk over ``width`` words makes about twice as many moves
        places = np.sort(rng.choice(2 * width if edits else width, size=min(sampled, max(2, width // 2)), replace=False))
        walk = cgk(hashes, first, width, r, int(places[-1]) + 1)
        key = np.full(len(first), _U(r + 1))
        for p in places:
            key = _mix(key * _BASE ^ walk[:, p])
        out[:, r] = key
    return out


def edit_distance(a: list[bytes], b: list[bytes], most: int) -> int:
    """Word edit distance, or ``most + 1`` if it is larger."""
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(new[-1] + 1, row[j] + 1, row[j - 1] + (x != y)))
        if min(new) > most:
            return most + 1
        row = new
    return row[-1]


def text_blocks(batch, chars: int = BLOCK_BYTES):
    """The (ids, texts) of an Arrow batch in runs of about ``chars`` characters."""
    ids, texts, n = [], [], 0
    for i, t in zip(batch.column(0).to_pylist(), batch.column(1)):
        t = t.as_py()
        ids.append(i)
        texts.append(t)
        n += len(t or "")
        if n >= chars:
            yield ids, texts
            ids, texts, n = [], [], 0
    if ids:
        yield ids, texts


class _SizeIndex:
    """LSH table of item windows of one size."""

    def __init__(self, words: Words, first: np.ndarray, width: int, edits: int, recall: float, sampled: int) -> None:
        self.width, self.first = width, first
        self.reps = repetitions(edits, width, sampled, recall)
        keys = lsh_keys(words.hash, first, width, edits, self.reps, sampled)
        self.order = np.argsort(keys, axis=0, kind="stable")
        self.keys = np.take_along_axis(keys, self.order, axis=0)


def item_windows(words: Words, n_items: int, width: int, edits: int) -> dict[int, np.ndarray]:
    """First words of the item windows by size: ``width`` words, or with edits the whole item where it is shorter."""
    out = {width: windows(words, width)}
    if edits:
        starts = np.searchsorted(words.doc, np.arange(n_items))
        sizes = np.diff(np.append(starts, len(words.doc)))
        for size in np.unique(sizes[(sizes >= LEAST_WORDS) & (sizes < width)]):
            out[int(size)] = starts[sizes == size]
    return {k: v for k, v in out.items() if len(v)}


class ItemIndex:
    """LSH tables of all item windows, with an exact verifier."""

    def __init__(self, items: list[tuple[int, str]], width: int, edits: int, recall: float, sampled: int = 6) -> None:
        self.width, self.edits, self.sampled = width, edits, sampled
        self.words = Words([t for _, t in items])
        self.ids = np.array([i for i, _ in items], dtype=np.int64)
        found = item_windows(self.words, len(items), width, edits)
        self.sizes = [_SizeIndex(self.words, f, w, edits, recall, sampled) for w, f in sorted(found.items())]
        self.bitmap = np.zeros(1 << BITMAP_BITS, dtype=bool)
        self.bitmap[(self.words.hash >> _U(64 - BITMAP_BITS)).astype(np.int64)] = True

    def __len__(self) -> int:
        return sum(len(s.first) for s in self.sizes)

    def search(self, words: Words) -> set[tuple[int, int]]:
        """Pairs (text number, item id) that share a window."""
        known = self.bitmap[(words.hash >> _U(64 - BITMAP_BITS)).astype(np.int64)]
        upto = np.concatenate([[0], np.cumsum(known)])
        found: set[tuple[int, int]] = set()
        for size in self.sizes:
            first = windows(words, size.width)
            first = first[upto[first + size.width] - upto[first] >= size.width - self.edits]
            if len(first):
                self._search_size(words, first, size, found)
        return found

    def _search_size(self, words: Words, first: np.ndarray, size: _SizeIndex, found: set[tuple[int, int]]) -> None:
        keys = lsh_keys(words.hash, first, size.width, self.edits, size.reps, self.sampled)
        seen: set[tuple[int, int]] = set()  # window pairs that were verified
        for r in range(size.reps):
            low = np.searchsorted(size.keys[:, r], keys[:, r], side="left")
            high = np.searchsorted(size.keys[:, r], keys[:, r], side="right")
            for n in np.flatnonzero(high > low):
                at = int(first[n])
                doc = int(words.doc[at])
                for k in range(int(low[n]), int(high[n])):
                    w = int(size.first[size.order[k, r]])
                    pair = (doc, int(self.ids[self.words.doc[w]]))
                    if pair in found or (at, w) in seen:
                        continue
                    if self._same(words.phrase(at, size.width), self.words.phrase(w, size.width)):
                        found.add(pair)
                    elif self.edits:
                        seen.add((at, w))

    def _same(self, a: bytes, b: bytes) -> bool:
        if a == b:
            return True
        return self.edits > 0 and edit_distance(a.split(b" "), b.split(b" "), self.edits) <= self.edits


def leaked_items(
    docs: DataFrame,
    items: DataFrame,
    *,
    doc_id: str = "doc_id",
    doc_text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    width: int = WIDTH,
    edits: int = 0,
    recall: float = 0.95,
    broadcast_windows: int = BROADCAST_WINDOWS,
) -> DataFrame:
    """Distinct pairs ``(doc_id, item_id)`` that share ``width`` consecutive words within ``edits`` edits.

    Null and empty texts, and texts of fewer than ``width`` words, share nothing; with edits an
    item of ``LEAST_WORDS`` to ``width`` words is searched as a whole. Null ids are left out; repeated rows give a pair once. Very long texts are searched whole.
    """
    slim = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(doc_text).cast("string").alias("text"))
    slim = slim.where("doc_id is not null and length(text) > 0")
    side = items.select(F.col(item_id).cast("long").alias("item_id"), F.col(item_text).cast("string").alias("text"))
    side = side.where("item_id is not null and length(text) > 0").distinct()
    # an upper bound of the item windows: white-space separated parts are at most the characters
    size = side.agg(F.sum(F.length("text")).alias("n")).first()["n"] or 0
    if size <= 8 * broadcast_windows:
        rows = [(r["item_id"], normal_words(r["text"])) for r in side.toLocalIterator()]
        index = ItemIndex(rows, width, edits, recall)
        if len(index) <= broadcast_windows:
            return _search_broadcast(slim, index)
    return _search_shuffled(slim, side, width, edits, recall)


def _search_broadcast(docs: DataFrame, index: ItemIndex) -> DataFrame:
    held = docs.sparkSession.sparkContext.broadcast(index)

    def run(batches):
        import pyarrow as pa

        idx = held.value
        for b in batches:
            pairs = []
            for ids, texts in text_blocks(b):
                words = Words([normal_words(t) for t in texts])
                pairs += sorted({(ids[d], item) for d, item in idx.search(words)})
            if pairs:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([p[0] for p in pairs], pa.int64()), pa.array([p[1] for p in pairs], pa.int64())],
                    names=["doc_id", "item_id"],
                )

    return spread(docs).mapInArrow(run, "doc_id long, item_id long").distinct()


def _keyed(df: DataFrame, id_col: str, width: int, edits: int, recall: float, sizes=None, marked=None, sampled: int = 6) -> DataFrame:
    """``(id_col, size, k, phrase)`` of windows. Items choose their own sizes; documents use ``sizes``.

    With ``marked``, a broadcast bitmap of the item keys, only windows whose key is marked are
    sent, so nearly nothing of the corpus leaves the scan.
    """

    def run(batches):
        import pyarrow as pa

        bits = None if marked is None else marked.value
        for ids, texts in (block for b in batches for block in text_blocks(b)):
            ids = np.array(ids, dtype=np.int64)
            words = Words([normal_words(t) for t in texts])
            found = item_windows(words, len(texts), width, edits) if sizes is None else {w: windows(words, w) for w in sizes}
            for w, first in found.items():
                reps = repetitions(edits, w, sampled, recall)
                keys = lsh_keys(words.hash, first, w, edits, reps, sampled)
                for r in range(reps):
                    k, f = keys[:, r], first
                    if bits is not None:
                        place = (k % _U(FILTER_BITS)).astype(np.int64)
                        hit = (bits[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1
                        k, f = k[hit], f[hit]
                    if len(f):
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(ids[words.doc[f]], pa.int64()), pa.array(np.full(len(f), w, np.int32)), pa.array(k.astype(np.int64), pa.int64()),
                                pa.array([words.phrase(int(x), w) for x in f], pa.binary()),
                            ],
                            names=[id_col, "size", "k", f"{id_col}_w"],
                        )

    return df.mapInArrow(run, f"{id_col} long, size int, k long, {id_col}_w binary")


def _marks(keys: DataFrame) -> np.ndarray:
    """Bitmap of the keys, combined by the executors; at most ``FILTER_BITS`` bits (8 MB) come to the driver."""
    place = F.col("k").bitwiseAND(F.lit(FILTER_BITS - 1))  # FILTER_BITS is a power of two
    word = keys.select(place.alias("p")).select(F.shiftright("p", 3).alias("i"), F.call_function("shiftleft", F.lit(1), (F.col("p") % 8).cast("int")).alias("m"))
    bits = np.zeros(FILTER_BITS // 8, dtype=np.uint8)
    for b in word.groupBy("i").agg(F.bit_or("m").alias("m")).toArrow().to_batches():
        bits[b.column(0).to_numpy()] = b.column(1).to_numpy().astype(np.uint8)
    return bits


def _search_shuffled(docs: DataFrame, items: DataFrame, width: int, edits: int, recall: float) -> DataFrame:
    """Both sides keyed and joined by key; documents send only windows whose key an item has."""
    from lexloom.runtime import Workspace

    b = Workspace(docs.sparkSession, "items").keep(_keyed(items, "item_id", width, edits, recall).distinct(), "keys")
    sizes = [r["size"] for r in b.select("size").distinct().collect()]  # at most ``width`` sizes
    if not sizes:
        return docs.select("doc_id", F.lit(0).cast("long").alias("item_id")).limit(0)
    marked = docs.sparkSession.sparkContext.broadcast(_marks(b))
    a = _keyed(docs, "doc_id", width, edits, recall, sizes, marked).distinct()
    both = a.join(b, ["size", "k"])
    if edits == 0:
        both = both.where("doc_id_w = item_id_w")
    else:

        @F.pandas_udf("boolean")
        def near(x, y):
            import pandas as pd

            return pd.Series(
                [edit_distance(p.split(b" "), q.split(b" "), edits) <= edits for p, q in zip(x, y)], dtype=bool
            )

        both = both.where(near("doc_id_w", "item_id_w"))
    return both.select("doc_id", "item_id").distinct()


def exact_pairs(docs: list[tuple[int, str]], items: list[tuple[int, str]], width: int, edits: int) -> set[tuple[int, int]]:
    """The same pairs by comparing all windows (for measuring recall on samples)."""
    found = set()
    d, t = Words([normal_words(x) for _, x in docs]), Words([normal_words(x) for _, x in items])
    for size, first in item_windows(t, len(items), width, edits).items():
        mine = [(int(t.doc[f]), t.phrase(int(f), size).split(b" ")) for f in first]
        by_word: dict[bytes, list[int]] = {}
        for n, (_, w) in enumerate(mine):
            for x in set(w):
                by_word.setdefault(x, []).append(n)
        for f in windows(d, size):
            w = d.phrase(int(f), size).split(b" ")
            # windows within k edits have size - k words in common
            common: dict[int, int] = {}
            for x in set(w):
                for n in by_word.get(x, ()):
                    common[n] = common.get(n, 0) + 1
            for n, c in common.items():
                pair = (docs[int(d.doc[f])][0], items[mine[n][0]][0])
                if pair not in found and c >= len(set(mine[n][1])) - edits and edit_distance(w, mine[n][1], edits) <= edits:
                    found.add(pair)
    return found


def p7_found(spark: SparkSession, data_dir: str) -> DataFrame:
    """Documents and the items they leak: at least 12 consecutive words in common."""
    return leaked_items(table(spark, data_dir, "documents"), table(spark, data_dir, "eval_items"))


def p7_near(spark: SparkSession, data_dir: str) -> DataFrame:
    """Documents with a window of 12 words within one edit of a window of an item (recall 0.95 by construction)."""
    return leaked_items(table(spark, data_dir, "documents"), table(spark, data_dir, "eval_items"), edits=1)
