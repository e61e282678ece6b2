"""Periodic runs: stretches of words that repeat themselves at least ``EXPONENT`` times, found by internal
pattern matching.

A run of smallest period ``q`` is longer than two blocks of ``m`` words, ``m`` the power of two with
``m / 2 <= q < m``, so it holds one of the text's dyadic blocks (those that begin at multiples of
``m``). In such a run the block occurs again ``q`` words to its right or, if the run ends before that, to
its left; so it is enough to ask each block for its occurrences in the two neighbouring windows of
starts ``[b + m/2, b + m)`` and ``(b - m, b - m/2]``.

* Prefix doubling gives the rank of every stretch of ``2^k`` words and with the last ranks the suffix
  array; the suffixes that begin with a block are a range of it, found by its rank.
* A wavelet tree over the suffix array (one stable partition per bit of the positions) counts the
  positions below a bound in such a range and gives the next one (range successor).
* Two occurrences that overlap by half are a progression whenever there are more than two of them. Of
  a window with one or two occurrences each distance is a candidate for the period. Of a longer
  progression, whose step ``p`` is a period of the block, only the two distances count that map an end
  of the block's stretch of period ``p`` to that of the occurrences' stretch: a run that reaches beyond
  neither end would have period ``p``.
* A candidate is extended to both sides as far as its period holds, by comparing ranks from long to
  short stretches. What is long enough is a run; one stretch is found with its smallest period and
  perhaps with multiples of it, of which the smallest is kept.

All that is done in numpy for many texts at once: they are put one after the other, each followed by a
word of its own, which no run can span. The work is map-only; a task holds the ranks of one batch of
``_BATCH`` words, or of one text if that is longer.

Words are what ASCII white space parts. NULL and empty texts have no words and no runs; texts of any length
are taken whole; of runs equal in length the first, then that of the smaller period comes first; rows
that repeat are answered each; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickweir.llm.words import Vocabulary, split

EXPONENT = 4
SHORTEST = 6
_BATCH = 1 << 18


# ---------------------------------------------------------------- suffix array and wavelet tree


class Ranks:
    """Ranks of all stretches of ``2^k`` words of a text, the text's end counting as less than any word,
    and its suffix array. No two stretches of the longest kind are equal. ``text`` has every number from
    0 to its greatest; none of its parts that matter is longer than ``longest``."""

    def __init__(self, text: np.ndarray, longest: int):
        self.size = len(text)
        self.levels = [text.astype(np.int32)]
        width = 1
        while width < longest and int(self.levels[-1].max(initial=0)) + 1 < self.size:
            before = self.levels[-1]
            key = before.astype(np.int64) * (self.size + 1)
            key[: self.size - width] += before[width:] + 1
            self.levels.append(self._dense(key))
            width *= 2
        self.suffixes = np.argsort(self.levels[-1], kind="stable").astype(np.int64)

    def _dense(self, key: np.ndarray) -> np.ndarray:
        order = np.argsort(key)
        ordered = key[order]
        rank = np.empty(self.size, dtype=np.int32)
        rank[order] = np.cumsum(np.concatenate([[0], ordered[1:] != ordered[:-1]]))
        return rank

    def ranges(self, level: int, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of the suffixes that begin with the stretch of ``2^level`` words at each place: where in the
        suffix array they begin and end."""
        ordered = self.levels[level][self.suffixes]
        wanted = self.levels[level][places]
        return np.searchsorted(ordered, wanted, "left"), np.searchsorted(ordered, wanted, "right")

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """For each pair of different places, how many words from there on are equal."""
        a, b = a.copy(), b.copy()
        start = a.copy()
        for level in range(len(self.levels) - 1, -1, -1):
            rank, width = self.levels[level], 1 << level
            inside = np.flatnonzero((a < self.size) & (b < self.size))
            same = inside[rank[a[inside]] == rank[b[inside]]]
            a[same] += width
            b[same] += width
        return a - start

    def common_before(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The same backwards: how many words that end just before are equal."""
        a, b = a.copy(), b.copy()
        start = a.copy()
        for level in range(len(self.levels) - 1, -1, -1):
            rank, width = self.levels[level], 1 << level
            inside = np.flatnonzero((a >= width) & (b >= width))
            same = inside[rank[a[inside] - width] == rank[b[inside] - width]]
            a[same] -= width
            b[same] -= width
        return start - a


class WaveletTree:
    """Positions in the order of the suffix array, one level per bit, from high to low."""

    def __init__(self, values: np.ndarray):
        self.bits = max(1, int(len(values)).bit_length())
        self.zeros: list[np.ndarray] = []  # how many zero bits lie before each place of a level
        values = values.astype(np.int32)
        for bit in range(self.bits - 1, -1, -1):
            one = ((values >> bit) & 1).astype(bool)
            self.zeros.append(np.concatenate([[0], np.cumsum(~one)]).astype(np.int32))
            values = np.concatenate([values[~one], values[one]])

    def below(self, low: np.ndarray, high: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """How many positions of each range are less than its bound; bounds are at most the size."""
        low, high, found = low.astype(np.int64), high.astype(np.int64), np.zeros(len(low), dtype=np.int64)
        for level, zeros in enumerate(self.zeros):
            one = ((bound >> (self.bits - 1 - level)) & 1).astype(bool)
            left, right = zeros[low], zeros[high]
            found += np.where(one, right - left, 0)
            low = np.where(one, zeros[-1] + low - left, left)
            high = np.where(one, zeros[-1] + high - right, right)
        return found

    def nth(self, low: np.ndarray, high: np.ndarray, n: np.ndarray) -> np.ndarray:
        """The ``n``-th least position of each range, from 0. With ``n`` from ``below`` this is the successor."""
        low, high, n, value = low.astype(np.int64), high.astype(np.int64), n.astype(np.int64), np.zeros(len(low), dtype=np.int64)
        for level, zeros in enumerate(self.zeros):
            left, right = zeros[low], zeros[high]
            one = n >= right - left
            n = np.where(one, n - (right - left), n)
            value = value * 2 + one
            low = np.where(one, zeros[-1] + low - left, left)
            high = np.where(one, zeros[-1] + high - right, right)
        return value


# ---------------------------------------------------------------- runs


def _candidates(ranks: Ranks, tree: WaveletTree, level: int, blocks: np.ndarray, low: np.ndarray, high: np.ndarray
                ) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of a block and a possible period, from the occurrences in both neighbouring windows."""
    width = 1 << level
    half = width // 2
    some, periods = [], []
    for first, last in ((blocks + half, blocks + width), (blocks - width + 1, blocks - half + 1)):
        first, last = np.clip(first, 0, ranks.size), np.clip(last, 0, ranks.size)
        n = tree.below(low, high, first)
        many = tree.below(low, high, last) - n
        for nth in (0, 1):
            at = np.flatnonzero((many > nth) & (many <= 2))
            some.append(blocks[at])
            periods.append(np.abs(tree.nth(low[at], high[at], n[at] + nth) - blocks[at]))
        at = np.flatnonzero(many > 2)
        if len(at):
            block, one = blocks[at], tree.nth(low[at], high[at], n[at])
            step = tree.nth(low[at], high[at], n[at] + 1) - one
            # The stretches of period ``step`` around the block and around its occurrences.
            for end in (ranks.common, ranks.common_before):
                away = end(one, one + step) - end(block, block + step)
                shift = one - block + away if end == ranks.common else one - block - away
                some.append(block)
                periods.append(np.abs(shift))
    block, period = np.concatenate(some), np.concatenate(periods)
    fits = (period >= half) & (period < width)
    return block[fits], period[fits]


def _repeated_inside(order: np.ndarray, keys: np.ndarray, text: np.ndarray, blocks: np.ndarray, width: int) -> np.ndarray:
    """Whether the first word of each block comes again in its second half, as any period asks for."""
    ends = np.searchsorted(keys, text[blocks] * np.int64(len(text) + 1) + blocks + width) - 1
    return order[ends] >= blocks + width // 2


def find(text: np.ndarray, longest: int | None = None, exponent: int = EXPONENT, shortest: int = SHORTEST) -> np.ndarray:
    """The runs of a sequence that has every number from 0 to its greatest: rows of start, length and
    period, by start, then period. No stretch of more than ``longest`` occurs twice or is periodic (texts
    put together are parted by numbers of their own). ``exponent`` is 4 at least."""
    if exponent < 4:
        raise ValueError("blocks are sure to lie in runs of four periods or more")
    none = np.zeros((0, 3), dtype=np.int64)
    size = len(text)
    longest = min(size, longest or size)
    if longest < max(2, shortest):
        return none
    order = np.argsort(text, kind="stable").astype(np.int64)
    keys = text[order] * np.int64(size + 1) + order
    ranks = Ranks(text, longest)
    tree: WaveletTree | None = None
    found = [none]
    for level in range(1, len(ranks.levels)):
        width = 1 << level
        if 2 * width > longest:
            break
        blocks = np.arange(0, size - width + 1, width)
        blocks = blocks[_repeated_inside(order, keys, text, blocks, width)]
        low, high = ranks.ranges(level, blocks)
        more = high - low > 1
        blocks, low, high = blocks[more], low[more], high[more]
        if not len(blocks):
            continue
        tree = tree or WaveletTree(ranks.suffixes)
        block, period = _candidates(ranks, tree, level, blocks, low, high)
        start = block - ranks.common_before(block, block + period)
        length = block + period + ranks.common(block, block + period) - start
        whole = length >= np.maximum(shortest, exponent * period)
        found.append(np.stack([start, length, period], axis=1)[whole])
    runs = np.concatenate(found)
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    first = np.ones(len(runs), dtype=bool)
    first[1:] = (runs[1:, :2] != runs[:-1, :2]).any(axis=1)
    runs = runs[first]
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def find_all(texts: list[list[bytes]]) -> list[np.ndarray]:
    """The runs of each of several texts, given as words."""
    vocabulary = Vocabulary()
    numbers = [vocabulary.numbers(words) for words in texts]
    sizes = np.array([len(n) for n in numbers], dtype=np.int64)
    begins = np.concatenate([[0], np.cumsum(sizes + 1)])
    last = len(vocabulary.words)  # words that end the texts, each another
    parts = [part for i, n in enumerate(numbers) for part in (n, np.array([last + i], dtype=np.int64))]
    runs = find(np.concatenate(parts or [np.zeros(0, np.int64)]), int(sizes.max(initial=0)))
    cuts = np.searchsorted(runs[:, 0], begins)
    out = []
    for i in range(len(texts)):
        own = runs[cuts[i]: cuts[i + 1]].copy()
        own[:, 0] -= begins[i]
        out.append(own)
    return out


def kept(n: int, runs: np.ndarray) -> np.ndarray:
    """Which of ``n`` words stay when every run is cut down to its first period."""
    change = np.zeros(n + 1, dtype=np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(change)[:n] == 0


# ---------------------------------------------------------------- on Spark


def _batches(texts: list[list[bytes]]) -> Iterator[tuple[int, int]]:
    first = held = 0
    for i, words in enumerate(texts):
        if held and held + len(words) > _BATCH:
            yield first, i
            first, held = i, 0
        held += len(words) + 1
    yield first, len(texts)


def _mapped(docs: DataFrame, schema: str, prepare: Callable | None, row: Callable) -> DataFrame:
    """``row(words, runs)`` of each document, with its id in front."""

    def mapped(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [part.split()[0] for part in schema.split(", ")]
        for batch in batches:
            ids, given = batch["doc_id"].tolist(), batch["text"].tolist()
            for i in range(0, len(given), 500):
                words = [split(text) for text in given[i: i + 500]]
                if prepare:
                    words = [prepare(doc_id, w) for doc_id, w in zip(ids[i: i + 500], words)]
                for a, b in _batches(words):
                    rows = [row(w, r) for w, r in zip(words[a:b], find_all(words[a:b]))]
                    out = pd.DataFrame(rows, columns=names[1:])
                    out.insert(0, "doc_id", pd.array([None if x is None else int(x) for x in ids[i + a: i + b]], dtype="Int64"))
                    yield out

    # Ids go as text: pandas would turn numbers with NULLs among them into doubles.
    return docs.select(F.col("doc_id").cast("long").cast("string").alias("doc_id"), "text").mapInPandas(mapped, schema)


def periodic_runs(docs: DataFrame, prepare: Callable | None = None) -> DataFrame:
    """``doc_id, n_words, runs, collapsed`` for each row of ``docs``: the runs as an array of ``start, length,
    period``, and the text in which every run is cut down to its first period, its words joined by one space.
    ``prepare(doc_id as text, words)`` may change the words first."""
    schema = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"

    def row(words: list[bytes], runs: np.ndarray) -> tuple:
        held = [{"start": s, "length": n, "period": p} for s, n, p in runs.tolist()]
        return len(words), held, collapsed(words, runs).decode()

    return _mapped(docs, schema, prepare, row)


def collapsed(words: list[bytes], runs: np.ndarray) -> bytes:
    if not len(runs):
        return b" ".join(words)
    stay = kept(len(words), runs).tolist()
    return b" ".join([w for w, k in zip(words, stay) if k])


def digests(docs: DataFrame, prepare: Callable | None = None) -> DataFrame:
    """Of each row of ``docs``: the number of runs, its longest run, and digests of all runs and of the collapsed text."""
    schema = ("doc_id long, n_runs long, start long, length long, period long, exponent_milli long, "
              "runs_sha256 string, collapsed_sha256 string")

    def row(words: list[bytes], runs: np.ndarray) -> tuple:
        top = (None,) * 4
        if len(runs):
            s, n, p = runs[np.lexsort((runs[:, 2], runs[:, 0], -runs[:, 1]))[0]].tolist()
            top = s, n, p, 1000 * n // p
        lines = "".join(f"{s},{n},{p}\n" for s, n, p in runs.tolist())
        return (len(runs), *top, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(collapsed(words, runs)).hexdigest())

    return _mapped(docs, schema, prepare, row)
