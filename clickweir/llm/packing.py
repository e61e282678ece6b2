"""Packing of token pieces into sequences of a fixed length: best fit, longest first, after linear
grouping has placed what it places well. On the given texts that is little (62 of 11 562 pieces; see README).

1. Documents become token ids; those longer than a sequence are cut into full pieces.
2. Pieces of at least ``1 / SMALL`` of a sequence are large. By falling length they are dealt into
   groups of equal cardinality, and each length is rounded up to the largest of its group.
3. A linear programme over configurations of these few sizes (column generation: a simplex basis
   with one row per size, priced by a knapsack over the capacity) says how often to use which.
4. Actual pieces take the places of the rounded ones, longest first in each group, where the room
   they leave is none or at least ``1 / GAP`` of a sequence.
5. Pieces that were left over by rounding down, and then the small ones, go by best fit, longest
   first, into the sequences with the least room that is enough.

Pieces of one length are interchangeable. So steps 2 to 5 work on the histogram of lengths, which has
at most as many rows as a sequence has tokens, however large the input is; the result is a table of
runs: ``count`` pieces of some length, from rank ``lo`` on, go to sequences from ``first`` on at one
offset. Spark ranks the pieces of each length and joins them with the runs.
"""

from __future__ import annotations

import base64
import bisect
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from clickweir.llm import common

SMALL = 8
GROUPS = 24
GAP = 8

# Fixed values of the vocabulary: how text is parted before merging, and its one special token.
_PARTS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_SPECIAL = {"<|endoftext|>": 50256}


# ---------------------------------------------------------------- tokens


@lru_cache(maxsize=2)
def _encoding(ranks_path: str) -> tiktoken.Encoding:
    with open(ranks_path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("pieces", pat_str=_PARTS, mergeable_ranks=ranks, special_tokens=_SPECIAL)


def encode(text: str | None, ranks_path: str) -> list[int]:
    """Ids of a text. Long texts are taken a line at a time where that changes nothing: a line break
    between two characters that are not white space is always a token of its own."""
    encoding = _encoding(ranks_path)
    if not text:
        return []
    if len(text) < 1 << 16:
        return encoding.encode(text, allowed_special="all")
    ids: list[int] = []
    for i, line in enumerate(re.split(r"(?<=\S)\n(?=\S)", text)):
        if i:
            ids += encoding.encode("\n")
        ids += encoding.encode(line, allowed_special="all")
    return ids


PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, ids array<int>"


def pieces(docs: DataFrame, ranks_path: str, capacity: int = 2048, separator: int = 0, with_ids: bool = False) -> DataFrame:
    """One row per piece of each row of ``docs``: ids of the text (NULL: empty) and the separator.
    Only longer documents are cut: the first piece takes what the full ones leave. ``ids`` is NULL
    unless asked for. The file of the vocabulary must be at ``ranks_path`` on every executor."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["doc_id"].tolist(), batch["text"].tolist()):
                ids = np.array([*encode(text, ranks_path), separator], dtype="<u4")
                first = len(ids) % capacity or capacity
                bounds = [0, *range(first, len(ids) + 1, capacity)]
                for number, (a, b) in enumerate(zip(bounds, bounds[1:])):
                    rows.append((doc_id, number, a, b - a, zlib.crc32(ids[a:b].tobytes()), ids[a:b].astype(np.int32) if with_ids else None))
            frame = pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32", "ids"])
            frame["doc_id"] = frame["doc_id"].astype("Int64")
            yield frame

    return docs.select(F.col("doc_id").cast("long"), "text").mapInPandas(cut, PIECES)


# ---------------------------------------------------------------- the plan, on the histogram


class Bins:
    """Runs of alike sequences ``(room, first sequence, count)`` and the runs of pieces placed so far."""

    def __init__(self, capacity: int):
        self.capacity, self.next = capacity, 0
        self.rooms: list[int] = []
        self.runs: dict[int, list[tuple[int, int]]] = {}
        self.placed: list[tuple[int, int, int, int, int]] = []  # length, lo, count, first, offset

    def fresh(self, count: int) -> int:
        self.next += count
        return self.next - count

    def add(self, room: int, first: int, count: int) -> None:
        if room and count:
            if room not in self.runs:
                bisect.insort(self.rooms, room)
                self.runs[room] = []
            self.runs[room].append((first, count))

    def take(self, length: int) -> tuple[int, int, int] | None:
        """A run of the sequences with the least room that is enough."""
        at = bisect.bisect_left(self.rooms, length)
        if at == len(self.rooms):
            return None
        room = self.rooms[at]
        first, count = self.runs[room].pop()
        if not self.runs[room]:
            del self.runs[room]
            self.rooms.pop(at)
        return room, first, count

    def best_fit(self, length: int, lo: int, count: int) -> None:
        while count:
            run = self.take(length)
            room, first, many = run or (self.capacity, 0, -(-count // (self.capacity // length)))
            if run is None:
                first = self.fresh(many)
            each = room // length
            full = min(many, count // each)
            for slot in range(each if full else 0):
                self.placed.append((length, lo, full, first, self.capacity - room + slot * length))
                lo += full
            count -= full * each
            self.add(room - each * length, first, full)
            first, many = first + full, many - full
            if many and count and count < each:
                for slot in range(count):
                    self.placed.append((length, lo, 1, first, self.capacity - room + slot * length))
                    lo += 1
                self.add(room - count * length, first, 1)
                first, many, count = first + 1, many - 1, 0
            self.add(room, first, many)


def groups_of(histogram: list[tuple[int, int]], count: int) -> list[list[tuple[int, int, int]]]:
    """Lengths by falling order in groups of equal cardinality, as runs ``(length, lo, count)``; ``lo``
    is the rank among the pieces of that length."""
    total = sum(n for _, n in histogram)
    size = -(-total // count) if total else 1
    out: list[list[tuple[int, int, int]]] = [[]]
    room = size
    for length, n in sorted(histogram, reverse=True):
        lo = 0
        while n:
            if not room:
                out.append([])
                room = size
            take = min(room, n)
            out[-1].append((length, lo, take))
            lo, n, room = lo + take, n - take, room - take
    return [g for g in out if g]


def _knapsack(sizes: np.ndarray, worth: np.ndarray, capacity: int) -> np.ndarray:
    """How many of each size make the configuration of most worth."""
    best, chosen = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    smallest = int(sizes.min())
    for room in range(smallest, capacity + 1):
        fits = sizes <= room
        value = np.where(fits, best[room - np.minimum(sizes, room)] + worth, -1.0)
        at = int(value.argmax())
        if value[at] > best[room - 1] + 1e-12:
            best[room], chosen[room] = value[at], at
        else:
            best[room] = best[room - 1]
    counts, room = np.zeros(len(sizes), dtype=np.int64), capacity
    while room >= smallest:
        if best[room] <= best[room - 1] + 1e-12:
            room -= 1
            continue
        counts[chosen[room]] += 1
        room -= int(sizes[chosen[room]])
    return counts


def configurations(sizes: np.ndarray, demand: np.ndarray, capacity: int, rounds: int = 400) -> list[tuple[np.ndarray, float]]:
    """A basic optimal solution of: as few sequences as possible whose configurations hold ``demand``
    pieces of each size. It has at most as many configurations as there are sizes."""
    basis = np.diag((capacity // sizes).astype(float))
    level = demand / np.diag(basis)
    for _ in range(rounds):
        worth = np.linalg.solve(basis.T, np.ones(len(sizes)))
        column = _knapsack(sizes, np.maximum(worth, 0), capacity).astype(float)
        if worth @ column <= 1 + 1e-9:
            break
        change = np.linalg.solve(basis, column)
        ratio = np.where(change > 1e-9, level / np.where(change > 1e-9, change, 1), np.inf)
        out = int(ratio.argmin())
        step = ratio[out]
        level = np.maximum(level - step * change, 0)
        basis[:, out], level[out] = column, step
    return [(basis[:, i].astype(np.int64), float(level[i])) for i in range(len(sizes))]


def plan(histogram: list[tuple[int, int]], capacity: int = 2048) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """Runs ``(length, lo, count, first, offset)`` for all pieces, and the number of sequences."""
    bins = Bins(capacity)
    for length, n in histogram:
        if length == capacity:
            bins.placed.append((length, 0, n, bins.fresh(n), 0))
    large = [(l, n) for l, n in histogram if capacity // SMALL <= l < capacity]
    rest: list[tuple[int, int, int]] = [(l, 0, n) for l, n in histogram if l < capacity // SMALL]
    groups = groups_of(large, GROUPS)
    if groups:
        merged: dict[int, list[tuple[int, int, int]]] = {}
        for group in groups:  # groups that round up to one length are one size
            merged.setdefault(group[0][0], []).extend(group)
        sizes = np.array(sorted(merged, reverse=True))
        queues = [list(reversed(merged[s])) for s in sizes]
        demand = np.array([sum(n for _, _, n in q) for q in queues], dtype=float)
        for column, level in configurations(sizes, demand, capacity):
            rest += _substitute(bins, column, int(level + 1e-9), queues)
        rest += [run for queue in queues for run in queue]
    for length, lo, n in sorted(rest, reverse=True):
        bins.best_fit(length, lo, n)
    return bins.placed, bins.next


def _substitute(bins: Bins, column: np.ndarray, count: int, queues: list[list[tuple[int, int, int]]]) -> list[tuple[int, int, int]]:
    """Fill ``count`` sequences of one configuration with the longest pieces left of its groups. Those
    that would leave a little room, too small for most of the small pieces, are not used: their
    pieces are returned and go by best fit with the rest."""
    places = [g for g, n in enumerate(column) for _ in range(n)]
    count = min([count, *(sum(n for _, _, n in queues[g]) // int(column[g]) for g in set(places))]) if places else 0
    back: list[tuple[int, int, int]] = []
    if not count:
        return back
    slots = [_drawn(queues[g], count) for g in places]
    cuts = sorted({at for slot in slots for at, *_ in slot} | {count})
    for a, b in zip(cuts, cuts[1:]):
        runs = []
        for slot in slots:
            at, length, lo = next(x for x in reversed(slot) if x[0] <= a)
            runs.append((length, lo + a - at, b - a))
        offset = sum(length for length, _, _ in runs)
        if 0 < bins.capacity - offset < bins.capacity // GAP:
            back += runs
            continue
        first = bins.fresh(b - a)
        bins.add(bins.capacity - offset, first, b - a)
        for length, lo, n in reversed(runs):
            offset -= length
            bins.placed.append((length, lo, n, first, offset))
    return back


def _drawn(queue: list[tuple[int, int, int]], count: int) -> list[tuple[int, int, int]]:
    """The next ``count`` pieces of a group, as ``(place, length, lo)`` where the length changes."""
    out, at = [], 0
    while at < count:
        length, lo, n = queue.pop()
        take = min(n, count - at)
        out.append((at, length, lo))
        if take < n:
            queue.append((length, lo + take, n - take))
        at += take
    return out


# ---------------------------------------------------------------- on Spark


def ranked(cut: DataFrame, parts: int) -> DataFrame:
    """``cut`` with ``rank``, from 0 within each length. Pieces of one length are numbered in
    ``parts`` shares by a hash of id and piece; a share begins where the ones before it end."""
    share = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(parts)).cast("int")
    rows = cut.withColumn("share", share)
    sizes = rows.groupBy("length", "share").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("share").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("length", "share", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("begin"))
    within = Window.partitionBy("length", "share").orderBy("doc_id", "piece", "ids_crc32")
    numbered = rows.withColumn("within", F.row_number().over(within) - 1)
    return numbered.join(starts, ["length", "share"]).withColumn(
        "rank", F.col("begin") + F.col("within")).drop("share", "begin", "within")


def pack(cut: DataFrame, capacity: int = 2048, per_share: int = 50_000) -> DataFrame:
    """``cut`` (rows of ``pieces``, other columns kept) with ``sequence_id`` and ``offset``. Every row is placed once; places in
    a sequence are without gaps. Rows that are repeated are placed as often as they occur; an empty
    table gives an empty result. Pieces of one length, which may be most of the table, are numbered in shares of
    about ``per_share``. Of pieces of one length, those of smaller share, then doc_id, piece and ids come first."""
    spark = cut.sparkSession
    counts = cut.groupBy("length").agg(F.count("*").alias("n")).collect()  # at most ``capacity`` rows
    placed, _ = plan(sorted((r["length"], r["n"]) for r in counts), capacity)
    # At most a few runs per length and configuration, whatever the number of pieces.
    runs = spark.createDataFrame(
        pd.DataFrame(placed, columns=["length", "lo", "many", "first", "offset"], dtype="int64"),
        "length long, lo long, many long, first long, offset long")
    runs = runs.withColumnRenamed("length", "of")
    parts = max([64, *(-(-r["n"] // per_share) for r in counts)])
    rows = ranked(cut, parts)
    hit = (F.col("length") == F.col("of")) & (F.col("rank") >= F.col("lo")) & (F.col("rank") < F.col("lo") + F.col("many"))
    return rows.join(F.broadcast(runs), hit).withColumn(
        "sequence_id", F.col("first") + F.col("rank") - F.col("lo")).drop("of", "lo", "many", "first", "rank")


def packed_documents(docs: DataFrame, ranks_path: str, capacity: int = 2048, with_ids: bool = False) -> DataFrame:
    """Token pieces of ``docs`` with their places; the pieces are stored first, so each document is
    tokenized once."""
    cut = common.stored(pieces(docs, ranks_path, capacity, with_ids=with_ids), "pieces")
    return pack(cut, capacity)
