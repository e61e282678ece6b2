"""Benchmark decontamination by the q-gram lemma.

A passage of ``n`` characters that occurs with at most ``e`` edits shares at least
``n - q + 1 - e * q`` of its q-grams with the place where it occurs, and the diagonals (place in the
document less place in the passage) of these q-grams lie within ``e`` of each other. Diagonals are
counted in bands of ``2 * (e + 1)`` that overlap by half, so some band holds them all. Bands that reach
the bound are verified by an alignment that is held to the band's diagonals.

Passages and documents are compared in lower case, runs of white space as one space; spans are given in
code points of the text as it is.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_BASE = np.uint64(0x9E3779B97F4A7C15)
_SPREAD = np.uint64(0xD6E8FEB86659FD93)
_BITMAP = 22
LEAKS = "array<struct<item_id:long,start:long,end:long,edits:int>>"


@dataclass(frozen=True)
class Settings:
    """``rate``: edits allowed per character. ``block_chars``: passages are sent to the executors in
    blocks of about so many characters; each block is compared with all documents. ``segment``: a long
    document is taken in stretches of so many characters that overlap by more than any passage."""

    q: int = 8
    rate: float = 0.1
    block_chars: int = 1 << 22
    segment: int = 1 << 18


def normal(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Code points in lower case with single spaces, and where in the text each was."""
    raw = text or ""
    lower = raw.lower()
    if len(lower) != len(raw):  # a few letters become longer
        lower = "".join(c if len(c.lower()) != 1 else c.lower() for c in raw)
    points = np.frombuffer(lower.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    space = (points == 32) | ((points >= 9) & (points <= 13)) | (points == 0xA0)
    keep = np.ones(len(points), dtype=bool)
    keep[1:] = ~(space[1:] & space[:-1])
    places = np.flatnonzero(keep)
    return np.where(space, 32, points)[places].astype(np.uint32), places


def _grams(points: np.ndarray, q: int) -> np.ndarray:
    """A hash of each q-gram, by doubling; q is a power of two."""
    value, factor, width = points.astype(np.uint64) + np.uint64(1), _BASE, 1
    if len(points) < q:
        return np.zeros(0, np.uint64)
    while width < q:
        value = value[:-width] * factor + value[width:]
        factor, width = np.uint64(int(factor) ** 2 % (1 << 64)), 2 * width
    value = value * _SPREAD
    return value ^ (value >> np.uint64(29))


class Index:
    """Where each q-gram occurs in which passage. Passages of fewer than ``q`` characters are left out:
    no q-gram can find them."""

    def __init__(self, items: list[tuple[int, str]], settings: Settings):
        self.settings, q = settings, settings.q
        self.items, self.points, grams, of, at = [], [], [], [], []
        for item_id, text in items:
            points = normal((text or "").strip())[0]
            if len(points) < q:
                continue
            found = _grams(points, q)
            grams.append(found)
            of.append(np.full(len(found), len(self.points)))
            at.append(np.arange(len(found)))
            self.items.append(item_id)
            self.points.append(points)
        join = lambda parts, kind: np.concatenate(parts) if parts else np.zeros(0, kind)
        flat, of, at = join(grams, np.uint64), join(of, np.int64), join(at, np.int64)
        order = np.argsort(flat, kind="stable")
        self.keys, self.first, self.many = np.unique(flat[order], return_index=True, return_counts=True)
        self.of, self.at = of[order], at[order]
        self.bitmap = np.zeros(1 << _BITMAP, dtype=bool)
        self.bitmap[self.keys >> np.uint64(64 - _BITMAP)] = True
        length = np.array([len(p) for p in self.points], dtype=np.int64)
        self.length = length
        self.edits = np.minimum((settings.rate * length).astype(np.int64), (length - q) // q) if len(length) else length
        self.bound = length - q + 1 - self.edits * q
        self.longest = int((length + 4 * (self.edits + 1)).max()) if len(length) else 0

    def leaks(self, text: str | None) -> list[dict]:
        if not text or not self.points:
            return []
        points, places = normal(text)
        best: dict[tuple[int, int], tuple[int, int, int, int]] = {}
        step = max(self.settings.segment, 4 * self.longest)
        for begin in range(0, len(points), step):
            part = points[begin: begin + step + self.longest]
            for item, lo, hi, edits in self._in(part):
                best[item, begin + lo] = min(best.get((item, begin + lo), (edits, item, begin + lo, begin + hi)), (edits, item, begin + lo, begin + hi))
        kept: list[tuple[int, int, int, int]] = []
        for edits, item, lo, hi in sorted(best.values()):  # bands overlap: of alignments that do, the best stays
            if not any(item == i and lo < h and l < hi for _, i, l, h in kept):
                kept.append((edits, item, lo, hi))
        return [{"item_id": self.items[i], "start": int(places[lo]), "end": int(places[hi - 1]) + 1, "edits": edits}
                for edits, i, lo, hi in sorted(kept, key=lambda x: (x[1], x[2]))]

    def _in(self, part: np.ndarray) -> list[tuple[int, int, int, int]]:
        """``(item, from, to, edits)`` of verified places; one item may come several times."""
        grams = _grams(part, self.settings.q)
        at = np.flatnonzero(self.bitmap[grams >> np.uint64(64 - _BITMAP)])
        if not len(at):
            return []
        key = np.minimum(np.searchsorted(self.keys, grams[at]), len(self.keys) - 1)
        same = self.keys[key] == grams[at]
        at, key = at[same], key[same]
        if not len(at):
            return []
        many = self.many[key]
        ends = np.cumsum(many)
        entry = np.arange(ends[-1]) - np.repeat(ends - many, many) + np.repeat(self.first[key], many)
        item = self.of[entry]
        diagonal = np.repeat(at, many) - self.at[entry] + self.longest
        half = self.edits[item] + 1
        band = diagonal // half
        code = np.concatenate([band, band - 1]) * len(self.points) + np.concatenate([item, item])
        found, which, count = np.unique(code, return_inverse=True, return_counts=True)
        enough = count >= self.bound[found % len(self.points)]
        if not enough.any():
            return []
        # What repeats in the document hits one place of the passage many times; the bound is on places.
        left = np.flatnonzero(enough[which])
        span = int(self.length.max())
        places = np.unique(which[left] * span + np.tile(self.at[entry], 2)[left]) // span
        places = np.bincount(places, minlength=len(found))
        out = []
        for value in found[places >= self.bound[found % len(self.points)]].tolist():
            i = value % len(self.points)
            low = value // len(self.points) * int(self.edits[i] + 1) - self.longest
            hit = aligned(self.points[i], part, low, 2 * int(self.edits[i] + 1), int(self.edits[i]))
            if hit:
                out.append((i, *hit))
        return out


def _banded(passage: np.ndarray, part: np.ndarray, low: int, width: int, anchor: int | None = None) -> np.ndarray:
    """Least edits of the whole passage for each last diagonal ``low .. low + width``; a place of the
    document is a diagonal more than the place in the passage. ``anchor``: the only first diagonal."""
    padded = np.zeros(len(passage) + width + 1, dtype=np.uint32)
    a, b = max(0, low), min(len(part), low + len(padded))
    if b > a:
        padded[a - low: b - low] = part[a:b]
    steps = np.arange(width + 1)
    cost = np.zeros(width + 1, dtype=np.int64)
    if anchor is not None:
        cost = np.abs(steps - anchor) + np.where(steps < anchor, 1 << 20, 0)
    for i, point in enumerate(passage):
        moved = cost + (padded[i: i + width + 1] != point)
        moved[:-1] = np.minimum(moved[:-1], cost[1:] + 1)
        cost = np.minimum.accumulate(moved - steps) + steps
    return cost


def aligned(passage: np.ndarray, part: np.ndarray, low: int, width: int, edits: int) -> tuple[int, int, int] | None:
    """``(from, to, edits)`` of the best place of the passage on these diagonals, if good enough."""
    for shift in range(width + 1):  # a verbatim place needs no table
        a = low + shift
        if a >= 0 and a + len(passage) <= len(part) and part[a] == passage[0] and (part[a: a + len(passage)] == passage).all():
            return a, a + len(passage), 0
    cost = _banded(passage, part, low, width)
    last = int(cost.argmin())
    if cost[last] > edits:
        return None
    end = low + last + len(passage)
    back = _banded(passage[::-1], part[max(0, end - len(passage) - width): end][::-1], -(width // 2), width, width // 2)
    start = end - (len(passage) + int(back.argmin()) - width // 2)
    return max(0, start), min(end, len(part)), int(cost[last])


# ---------------------------------------------------------------- on Spark


def blocks(benchmark: DataFrame, settings: Settings) -> Iterator[list[tuple[int, str]]]:
    """Passages in blocks of a bounded number of characters, one block on the driver at a time. A row
    with a NULL id or text is left out; repeated rows count once."""
    rows = benchmark.select(F.col("item_id").cast("long"), "text").dropna().distinct()
    total = rows.agg(F.sum(F.length("text")).alias("n")).first()["n"] or 0
    parts = -(-total // settings.block_chars)
    for part in range(parts):
        chosen = rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == part)
        yield sorted((r["item_id"], r["text"]) for r in chosen.collect())


def _searched(sent, settings: Settings):
    """A function of texts that looks for the passages of one block, whose size ``block_chars`` bounds."""

    @F.pandas_udf(LEAKS)
    def leaks(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        index = Index(sent.value, settings)
        for texts in batches:
            yield pd.Series([index.leaks(t) for t in texts.tolist()], dtype="object")

    return leaks


def leaks_column(text: Column, benchmark: DataFrame, settings: Settings = Settings()) -> Column:
    """For each text the places where passages occur: ``item_id, start, end, edits`` by item and place.
    NULL and empty texts, and an empty benchmark, give an empty array."""
    context = benchmark.sparkSession.sparkContext
    columns = [_searched(context.broadcast(block), settings)(text) for block in blocks(benchmark, settings)]
    empty = F.array().cast(LEAKS)
    return F.concat(empty, *columns) if columns else empty


def contaminations(docs: DataFrame, benchmark: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One row per place of a passage in a row of ``docs``: ``doc_id, item_id, start, end, edits``."""
    found = docs.select("doc_id", leaks_column(F.col("text"), benchmark, settings).alias("leaks"))
    return found.select("doc_id", F.inline("leaks"))


def clean(docs: DataFrame, benchmark: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Rows of ``docs``, with all their columns, in whose text no passage occurs."""
    name = "_leaks"
    while name in docs.columns:
        name += "_"
    marked = docs.withColumn(name, F.size(leaks_column(F.col("text"), benchmark, settings)))
    return marked.where(F.col(name) == 0).drop(name)
