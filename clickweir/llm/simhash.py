"""Near-duplicates by SimHash: 64-bit fingerprints, exact comparison in tiles, classes of linked ones.

Fingerprints that differ in at most ``radius`` bits are linked. Cut into ``bands`` bit fields, two
linked fingerprints agree in at least ``bands - radius`` of them, so each goes, once per choice of
that many fields, into the group of its bits there, and linked ones meet in some group: nothing is
lost, whatever ``bands`` is. With six bands and radius four that makes 15 copies of 16 bytes, and
groups of some thousand among 10^10 fingerprints; more bands make more copies and smaller groups.

A group is dealt into tiles of bounded size. Each pair of tiles is one unit of work: numpy takes the
exclusive-or of all its pairs and counts bits, and a pair of tiles whose population counts differ by
more than the radius throughout is never formed. A unit returns no list of pairs but, for each
fingerprint that is not the least of those it is linked to in the unit, that least one. Classes are
then found by contraction of these links, in tables.

Equal fingerprints are merged before all this, so copies cost nothing here.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickweir.llm import common

_BITS = 64
_SIGN = 1 << 63


# ---------------------------------------------------------------- fingerprints


def shingle_hashes(text: bytes | None, size: int, seed: int = 42) -> np.ndarray:
    """Hashes of the shingles of a text in order, as unsigned numbers; of a text without words none."""
    words = (text or b"").lower().split()
    if not words:
        return np.zeros(0, dtype=np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    last = max(0, len(words) - size)
    hashed = xxhash.xxh64_intdigest
    return np.array([hashed(joined[a:b], seed) for a, b in zip(starts[: last + 1].tolist(), ends[-(last + 1):].tolist())], dtype=np.uint64)


def fingerprint(text: bytes | None, size: int = 4, seed: int = 42) -> int:
    """As an unsigned number. A-Z are lower-cased, words are what ASCII white space parts, shingles of
    ``size`` words are counted as often as they occur; a text of fewer words is one shingle, and a
    text without words (or NULL) has fingerprint zero."""
    return majority(shingle_hashes(text, size, seed))


def majority(hashes: np.ndarray) -> int:
    """The bits that over half of some hashes have, as an unsigned number."""
    if not len(hashes):
        return 0
    ones = np.zeros(_BITS, dtype=np.int64)
    for i in range(0, len(hashes), 1 << 14):
        part = hashes[i: i + (1 << 14)].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = np.packbits((2 * ones > len(hashes)).astype(np.uint8), bitorder="little")
    return int(bits.view("<u8")[0])


def fingerprints(docs: DataFrame, size: int = 4, keep: list[str] | None = None) -> DataFrame:
    """``doc_id, fp`` of each row (or other columns to ``keep``); ``fp`` holds the 64 bits as a signed long."""

    @F.pandas_udf("long")
    def signed(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            found = np.array([fingerprint(t, size) for t in texts.tolist()], dtype=np.uint64)
            yield pd.Series(found.view(np.int64))

    return docs.select(*(keep or ["doc_id"]), signed(F.col("text").cast("binary")).alias("fp"))


# ---------------------------------------------------------------- links


def _fields(bands: int) -> list[int]:
    """Bit masks of the fields, as unsigned numbers."""
    cuts = [round(i * _BITS / bands) for i in range(bands + 1)]
    return [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(cuts, cuts[1:])]


def _signed(value: int) -> int:
    return value - (1 << _BITS) if value & _SIGN else value


def tile_links(left: np.ndarray, right: np.ndarray | None, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints of a pair of tiles (or within one) that are linked to a lesser one, directly or
    through others of the pair, and the least one each is linked to so. Rows are taken in blocks."""
    values = left if right is None else np.concatenate([left, right])
    parent = np.arange(len(values))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    other = values if right is None else right
    shift = 0 if right is None else len(left)
    counts = np.bitwise_count(other).astype(np.int16)
    order = np.argsort(counts, kind="stable")
    ranked, other = counts[order], other[order]
    block = max(1, (1 << 20) // max(1, len(other)))
    mine = np.bitwise_count(left).astype(np.int16)
    by_count = np.argsort(mine, kind="stable")
    for i in range(0, len(left), block):
        rows = by_count[i: i + block]
        low = np.searchsorted(ranked, mine[rows[0]] - radius, "left")
        high = np.searchsorted(ranked, mine[rows[-1]] + radius, "right")
        near = np.bitwise_count(left[rows][:, None] ^ other[None, low:high]) <= radius
        for a, b in zip(*np.nonzero(near)):
            x, y = root(rows[a]), root(shift + order[low + b])
            if x != y:
                least, most = (x, y) if values[x] < values[y] else (y, x)
                parent[most] = least
    found = np.fromiter((root(i) for i in range(len(values))), np.int64, len(values))
    moved = np.flatnonzero(values != values[found])
    return values[moved], values[found[moved]]


def links(distinct: DataFrame, radius: int = 4, bands: int = 6, tile: int = 2048) -> DataFrame:
    """``a, b`` (b the lesser as unsigned numbers) joining all distinct fingerprints ``fp`` that lie
    within ``radius`` bits of each other, directly or by a chain of such pairs."""
    fields = _fields(bands)
    masks = [sum(fields[i] for i in kept) for kept in combinations(range(bands), bands - radius)]
    keys = F.array(*[F.struct(F.lit(i).cast("short").alias("choice"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("bits"))
                     for i, m in enumerate(masks)])
    spread = distinct.select("fp", F.explode(keys).alias("k")).select("fp", "k.choice", "k.bits")
    sizes = spread.groupBy("choice", "bits").agg(F.count("*").alias("n")).where("n > 1")
    sizes = common.stored(sizes, "simhash-groups")
    member = spread.join(sizes, ["choice", "bits"])
    # One tile per group as a rule. In a larger group a fingerprint's tile follows from its population
    # count and a hash, and pairs of tiles whose counts are too far apart are not formed; the others
    # are compared under a key of their own.
    slots = F.ceil(F.col("n") / tile).cast("int")
    step = F.when(F.col("slots") > 1, F.floor(F.bit_count("fp") / (radius + 1)).cast("int")).otherwise(F.lit(0))
    member = member.withColumn("slots", slots).withColumn("step", step).withColumn(
        "own", F.col("step") * F.col("slots") + F.pmod(F.xxhash64("fp"), F.col("slots")).cast("int"))
    steps = F.when(F.col("slots") > 1, F.sequence(F.greatest(F.col("step") - 1, F.lit(0)), F.col("step") + 1)).otherwise(F.array(F.lit(0)))
    others = F.flatten(F.transform(steps, lambda c: F.transform(
        F.sequence(F.lit(0), F.col("slots") - 1), lambda h: c * F.col("slots") + h)))
    pairs = F.transform(others, lambda t: F.struct(F.least(t, F.col("own")).alias("i"), F.greatest(t, F.col("own")).alias("j")))
    unit = member.select("fp", "choice", "bits", "own", F.explode(pairs).alias("p")).select(
        "fp", "choice", "bits", F.col("p.i").alias("i"), F.col("p.j").alias("j"), "own")
    # Units share tasks by a hash, so a task has many small ones; it handles them one by one.
    keyed = unit.withColumn("unit", F.xxhash64("choice", "bits", "i", "j"))
    partitions = int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = keyed.repartition(partitions, "unit").sortWithinPartitions("unit", "choice", "bits", "i", "j")

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        for batch in batches:
            if not len(batch):
                continue
            cut = _last_unit(batch)
            if cut:
                held.append(batch.iloc[:cut])
                yield _units(pd.concat(held), radius)
                held = []
            elif held and not _same_unit(held[-1], batch):
                yield _units(pd.concat(held), radius)
                held = []
            held.append(batch.iloc[cut:])
        if held:
            yield _units(pd.concat(held), radius)

    return dealt.mapInPandas(compare, "a long, b long").distinct()


_UNIT = ["choice", "bits", "i", "j"]


def _last_unit(batch: pd.DataFrame) -> int:
    """Where the last unit of a sorted batch begins."""
    keys = batch[_UNIT].to_numpy()
    changed = np.flatnonzero((keys[1:] != keys[:-1]).any(1))
    return int(changed[-1]) + 1 if len(changed) else 0


def _same_unit(before: pd.DataFrame, after: pd.DataFrame) -> bool:
    return bool((before[_UNIT].iloc[-1].to_numpy() == after[_UNIT].iloc[0].to_numpy()).all())


def _units(rows: pd.DataFrame, radius: int) -> pd.DataFrame:
    keys, values = rows[_UNIT].to_numpy(), rows["fp"].to_numpy().view(np.uint64)
    own = rows["own"].to_numpy()
    starts = np.concatenate([[0], np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1, [len(keys)]])
    many, few = [], []
    for s, e in zip(starts[:-1].tolist(), starts[1:].tolist()):
        if e - s < 2:
            continue
        i, j = keys[s, 2], keys[s, 3]
        if i == j:
            a, b = tile_links(values[s:e], None, radius)
        else:
            first = own[s:e] == i
            if not first.any() or first.all():
                continue
            a, b = tile_links(values[s:e][first], values[s:e][~first], radius)
        if len(a):
            many.append(a)
            few.append(b)
    if not many:
        return pd.DataFrame({"a": np.zeros(0, np.int64), "b": np.zeros(0, np.int64)})
    return pd.DataFrame({"a": np.concatenate(many).view(np.int64), "b": np.concatenate(few).view(np.int64)})


# ---------------------------------------------------------------- classes


def classes(edges: DataFrame) -> DataFrame:
    """``node, root``: for every end of an edge ``(a, b)`` the least node (as a signed number) of its
    connected class. Each round points every node to its least neighbour, goes three steps further along
    these paths and contracts the edges; nodes go down by a constant factor per round. Every step is a
    join or an aggregation of tables that are written in the shared folder."""
    left = common.stored(edges.select("a", "b").where("a <> b").distinct(), "links")
    found: DataFrame | None = None
    while not left.isEmpty():
        both = left.union(left.select("b", "a"))
        up = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("root"))
        near = common.stored(up, "nearest")
        up = common.stored(_followed(_followed(_followed(near, near), near), near), "parents")  # one plan, not three
        common.superseded(near)
        before, left = left, common.stored(
            _renamed(_renamed(left, up, "a"), up, "b").where("a <> b").distinct(), "links")
        common.superseded(before)
        common.tidy(edges.sparkSession)
        if found is None:
            found = up
            continue
        before, found = found, common.stored(_followed(found, up).unionByName(
            up.join(found.select("node"), "node", "left_anti")), "classes")
        common.superseded(before)
        common.superseded(up)
    return left.select(F.col("a").alias("node"), F.col("b").alias("root")) if found is None else found


def _followed(pointers: DataFrame, up: DataFrame) -> DataFrame:
    step = up.select(F.col("node").alias("root"), F.col("root").alias("next"))
    return pointers.join(step, "root", "left").select("node", F.coalesce("next", "root").alias("root"))


def _renamed(edges: DataFrame, up: DataFrame, end: str) -> DataFrame:
    to = up.select(F.col("node").alias(end), "root")
    other = "b" if end == "a" else "a"
    named = edges.join(to, end, "left").select(F.coalesce("root", end).alias(end), other)
    return named.select("a", "b")


def near_duplicates(docs: DataFrame, radius: int = 4, size: int = 4) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, fp, fingerprint, component_id``, the last the smallest
    doc_id that can be reached over links, itself included. Rows with a NULL id take part (their id
    is NULL in the result and never the smallest, unless all of their class are NULL). Other columns
    are ignored; an empty table gives an empty result."""
    return _classed(docs, ["doc_id"], radius, size).select("doc_id", "fp", hexadecimal("fp").alias("fingerprint"), "component_id")


def _classed(docs: DataFrame, keep: list[str], radius: int, size: int) -> DataFrame:
    printed = common.stored(fingerprints(docs, size, keep), "fingerprints")
    groups = common.stored(printed.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct-fingerprints")
    roots = classes(links(groups.select("fp"), radius))
    rooted = groups.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))
    smallest = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = common.stored(rooted.join(smallest, "root").select("fp", "root", "component_id"), "named-fingerprints")
    return printed.join(named, "fp").select(*keep, "fp", "root", "component_id")


def representatives(docs: DataFrame, radius: int = 4, size: int = 4) -> DataFrame:
    """One row of each class, with all its columns: that with the smallest doc_id (NULL comes last), then
    with the least hash of all columns. Of rows that are equal throughout one stays."""
    classed = _classed(docs.select("doc_id", "text", row_hash(docs).alias("row")), ["doc_id", "row"], radius, size)
    return firsts(docs, classed)


def row_hash(docs: DataFrame) -> Column:
    return F.xxhash64(*[F.col(c) for c in docs.columns])


def firsts(docs: DataFrame, classed: DataFrame) -> DataFrame:
    """The first row of each class ``root`` of ``classed`` (``doc_id, row, root``, one row per row of ``docs``)."""
    row = row_hash(docs)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row")).alias("first")
    kept = common.stored(classed.groupBy("root").agg(first).select(
        F.col("first.doc_id").alias("kept_id"), F.col("first.row").alias("kept_row")), "representatives")
    names = {c: f"c{i}" for i, c in enumerate(docs.columns)}  # columns may have any names
    rows = docs.select(row.alias("row"), *[F.col(c).alias(n) for c, n in names.items()])
    # Ids are compared in a way that is no key of the join, so that the rows, dealt by their hash alone, need not move again.
    id_ = F.col(names["doc_id"]).cast("long")
    same = (F.col("row") == F.col("kept_row")) & F.when(id_.isNull(), F.col("kept_id").isNull()).otherwise(
        F.coalesce(F.try_subtract(id_, F.col("kept_id")) == 0, F.lit(False)))
    return rows.join(kept, same, "left_semi").dropDuplicates(["row", names["doc_id"]]).select(
        *[F.col(n).alias(c) for c, n in names.items()])


def hexadecimal(name: str) -> Column:
    return F.lower(F.lpad(F.hex(F.col(name)), 16, "0"))
