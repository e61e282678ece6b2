"""Near-duplicates by the overlap of shingle sets: pairs of documents whose sets of five-word shingles have
a Jaccard similarity of at least 0.8, all of them, and the classes that these pairs join.

First come the pairs that SimHash names: the sets of five-word shingles whose fingerprints are linked by the bands and
tiles of ``simhash``, four bits apart at most. They are compared as whole sets, as all pairs here, and those that are
similar make the first classes. But of similar sets many have fingerprints further apart, so the rest is
found in a way that misses none, which goes by the classes there are.

Put in one order, the same for all documents, two sets that are that similar share a shingle among the
first ``n - ceil(0.8 n) + 1`` of each (n: size of the set). So documents that share none of these
cannot be a pair, and all others are compared as whole sets; nothing is estimated. The order puts
frequent shingles last, by a table of fixed size that counts those of all documents by their hash. It
decides how many pairs are compared, not which are found.

Documents that share such a shingle form a group. In some rounds one pivot of each group is compared with
all others of it and taken out, and groups whose members are already of one class are left; so a large
group of near copies is joined without its square of pairs. Of what remains, groups of up to ``_SMALL``
are compared pair by pair, so at most half that many pairs per row. Larger ones, of documents that are
unlike each other, are dealt into tiles of that size; each pair of tiles is one unit of work, from which
only pairs come out that pass the next test.

Each set has a sketch of parities, about as many as it has members: bit ``i`` says whether an odd number of
its hashes fall on ``i``. Where the sketches of two sets differ, the sets do, so pairs whose sketches differ
in more than a ninth of both sizes cannot be similar; what passes is compared as whole sets. These are made for the documents of
such pairs alone, and no text is shuffled: a bitmap of fixed size tells the tasks which documents those
are (it may let others through, which a join takes out).

Words are those of ``simhash``; a text of fewer than five words is one shingle, texts without words are
equal. Equal sets are merged before all this.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickweir.llm import common, simhash

SIZE = 5
TENTHS = 8
_CELLS = 1 << 20
_DEPTH = 3
_STARS = 4
_SMALL = 64
_TILE = 1024
_HASHES = 1 << 16, 1 << 20
_SPREAD = 8
_BITS = 512
_MARKS = 26


def shingle_set(text: bytes | None, size: int = SIZE) -> np.ndarray:
    """Distinct hashes of the shingles of a text, ascending, as unsigned numbers."""
    return np.unique(simhash.shingle_hashes(text, size))


def prefix(found: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """The first hashes of a set, one of which any similar set has among its own first ones. They are in the
    order of the ``ranks`` of their cells, then of the hashes themselves."""
    most = len(found) - -(-TENTHS * len(found) // 10) + 1 if len(found) else 0
    return found[np.lexsort((found, ranks[cells(found, len(ranks))]))[:most]]


def cells(found: np.ndarray, width: int) -> np.ndarray:
    """The cells of a table of ``width`` (a power of two) that hashes fall on."""
    return (found >> np.uint64(65 - width.bit_length())).astype(np.int64)


def _digest(found: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(found.astype("<u8").tobytes())


def _mapped(docs: DataFrame, schema: str, row) -> DataFrame:
    """``row(shingle hashes, other columns...)`` of each row of ``docs``, whose last column is the text; in small batches."""

    def mapped(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [part.split()[0] for part in schema.split(",")]
        for batch in batches:
            for i in range(0, len(batch), 500):
                part = batch.iloc[i: i + 500]
                columns = [part[c].tolist() for c in part.columns]
                rows = [row(simhash.shingle_hashes(text, SIZE), *rest) for text, *rest in zip(columns[-1], *columns[:-1])]
                yield pd.DataFrame(rows, columns=names)

    return docs.mapInPandas(mapped, schema)


def frequencies(docs: DataFrame, width: int = _CELLS) -> np.ndarray:
    """A rank for each cell of a table of fixed size: how often the shingles of all documents fall on it, as
    an eighth of a power of two. Each task counts its own texts, and the tables are added as a tree."""

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = np.zeros(width, dtype=np.int64)
        for batch in batches:
            for text in batch["text"].tolist():
                found = cells(shingle_set(text), width)
                if len(found) < width >> 6:
                    np.add.at(table, found, 1)
                else:
                    table += np.bincount(found, minlength=width)
        yield pd.DataFrame({"counts": [table.tobytes()]})

    def added(x: np.ndarray | None, y: np.ndarray | None) -> np.ndarray | None:
        return y if x is None else x if y is None else x + y

    tables_ = docs.select(F.col("text").cast("binary").alias("text")).mapInPandas(counted, "counts binary")
    total = tables_.rdd.map(lambda r: np.frombuffer(r["counts"], np.int64)).treeAggregate(None, added, added, _DEPTH)
    return np.zeros(width, np.uint8) if total is None else np.minimum(255, np.round(8 * np.log2(1.0 + total))).astype(np.uint8)


def _printed(found: np.ndarray, ranks: np.ndarray) -> tuple:
    """What stands for a set: its digest, its size, its first hashes and its sketch."""
    return _long(_digest(found)), len(found), prefix(found, ranks).view(np.int64), sketch(found)


def _long(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _similar(a: Column, b: Column, common_: Column) -> Column:
    """Jaccard similarity of at least 0.8, of two sets of sizes ``a`` and ``b`` with so many in common."""
    return (10 + TENTHS) * common_ >= TENTHS * (a + b)


def sketch(found: np.ndarray) -> np.ndarray:
    """Parities of how many hashes fall on each bit, as signed numbers of 64 bits; the number of bits is a
    power of two, ``_BITS`` at least, so that the longer of two sketches can be folded."""
    bits = max(_BITS, 1 << max(0, len(found) - 1).bit_length())
    ones = np.bincount((found & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(ones.astype(np.uint8)).view(np.int64)


def folded(found: np.ndarray, words: int) -> np.ndarray:
    """A sketch of as many numbers."""
    while len(found) > words:
        found = found[: len(found) // 2] ^ found[len(found) // 2:]
    return found


def _folded(longer: str, other: str) -> Column:
    """A sketch at the length of another one that has as many bits, or half of them."""
    half = F.size(longer) / 2
    left, right = F.slice(F.col(longer), F.lit(1), half.cast("int")), F.slice(F.col(longer), half.cast("int") + 1, half.cast("int"))
    return F.when(F.size(longer) > F.size(other), F.zip_with(left, right, lambda x, y: x.bitwiseXOR(y))).otherwise(F.col(longer))


def _may_be_similar(a: str, b: str) -> Column:
    """Whether sizes and sketches (columns ``m, p`` and ``n, q``) leave a similarity of 0.8 possible. Sizes that
    do differ in sketch length by one fold at most."""
    apart = F.aggregate(
        F.zip_with(_folded(a, b), _folded(b, a), lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)
    return F.when(alike(F.col("m"), F.col("n")), 9 * apart <= F.col("m") + F.col("n")).otherwise(False)


def alike(m: Column, n: Column) -> Column:
    return 10 * F.least(m, n) >= TENTHS * F.greatest(m, n)


class Sets:
    """Whole sets of shingles of those documents for which they were asked."""

    def __init__(self, docs: DataFrame, distinct: DataFrame):
        self.docs, self.distinct = docs, distinct
        self.parts: list[DataFrame] = []

    def all(self) -> DataFrame:
        out = self.parts[0]
        for part in self.parts[1:]:
            out = out.union(part)
        return out

    def ask(self, wanted: DataFrame) -> None:
        """Make the sets of the ``fp`` of ``wanted`` that are not there yet."""
        new = self.distinct.select("fp", "row").join(wanted, "fp", "left_semi")
        for part in self.parts:
            new = new.join(part.select("fp"), "fp", "left_anti")
        new = common.stored(new, "wanted-sets")
        mask = (1 << _MARKS) - 1
        place = F.col("row").bitwiseAND(F.lit(mask))
        marks = new.groupBy(F.shiftright(place, 6).alias("at")).agg(
            F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), place.bitwiseAND(F.lit(63)).cast("int"))).alias("bits")).toPandas()
        words = np.zeros(1 << (_MARKS - 6), dtype=np.int64)  # the rows above are at most so many
        words[marks["at"].to_numpy(np.int64)] = marks["bits"].to_numpy(np.int64)
        sent = self.docs.sparkSession.sparkContext.broadcast(words)

        def made(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                row = batch["row"].to_numpy(np.int64)
                at = row & mask
                batch = batch[(sent.value[at >> 6] >> (at & 63)) & 1 == 1]
                for i in range(0, len(batch), 500):
                    part = batch.iloc[i: i + 500]
                    sets = [shingle_set(text) for text in part["text"].tolist()]
                    yield pd.DataFrame({"row": part["row"].tolist(), "hashes": [s.view(np.int64) for s in sets]})

        texts = self.docs.select(simhash.row_hash(self.docs).alias("row"), F.col("text").cast("binary").alias("text"))
        found = texts.mapInPandas(made, "row long, hashes array<long>").dropDuplicates(["row"])
        self.parts.append(common.stored(found.join(new, "row").select("fp", "hashes"), "member-sets"))
        common.superseded(new)


def _dealt(members: DataFrame, tiles: Column, key: str, *columns: str) -> DataFrame:
    """Members of groups ``key`` once for each pair ``i, j`` of tiles that their own is in."""
    own = F.pmod(F.xxhash64("fp", F.lit(1)), F.col("tiles")).cast("int")
    spread = members.withColumn("tiles", tiles.cast("int")).withColumn("own", own).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    return spread.select(key, F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "fp", "n", "class", *columns)


def _facing(at: np.ndarray, first: np.ndarray, one: bool) -> Iterator[tuple[int, slice | np.ndarray]]:
    """Places in ``at`` and of what each is compared with: in one tile all that follow, else those of the other tile."""
    if one:
        yield from ((k, slice(k + 1, None)) for k in range(len(at) - 1))
    else:
        others = np.flatnonzero(~first[at])
        yield from ((k, others) for k in np.flatnonzero(first[at]))


def _tiled(groups: DataFrame) -> DataFrame:
    """``a, b``: of the pairs of members of large groups (``h, fp, n, class, sketch, many``) that pass the test, a forest for
    each unit, which joins the same members."""
    dealt = _dealt(groups, F.ceil(F.col("many") / _TILE), "h", "sketch")

    def compare(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        first, one = (rows["own"] == key[1]).to_numpy(), key[1] == key[2]
        fp, size, kind = (rows[c].to_numpy(np.int64) for c in ("fp", "n", "class"))
        sketches = [np.asarray(x, np.int64) for x in rows["sketch"].tolist()]
        length, label = np.array([len(x) for x in sketches]), np.arange(len(rows))
        out = [np.zeros((0, 2), dtype=np.int64)]
        for words in np.unique(length):  # sizes that are alike differ by one fold at most
            at = np.flatnonzero((length == words) | (length == 2 * words))
            bits = np.stack([folded(sketches[x], words) for x in at]).view(np.uint64)
            for k, facing in _facing(at, first, one):
                x, right = at[k], at[facing]
                both = size[right] + size[x]
                apart = np.bitwise_count(bits[facing] ^ bits[k]).sum(axis=1, dtype=np.int64)
                near = 10 * np.minimum(size[right], size[x]) >= TENTHS * np.maximum(size[right], size[x])
                folds = (length[right] == words) | (length[x] == words)
                hit = right[near & folds & (9 * apart <= both) & (kind[right] != kind[x]) & (label[right] != label[x])]
                labels, place = np.unique(label[hit], return_index=True)
                if len(labels):
                    hit = hit[place]
                    label[np.isin(label, labels)] = label[x]
                    out.append(np.stack([np.minimum(fp[hit], fp[x]), np.maximum(fp[hit], fp[x])], axis=1))
        pairs = np.concatenate(out)
        return pd.DataFrame({"a": pairs[:, 0], "b": pairs[:, 1]})

    return dealt.groupBy("h", "i", "j").applyInPandas(compare, "a long, b long")


def _compared(members: DataFrame) -> DataFrame:
    """``a, b``: of the similar pairs within parts (``part, fp, n, class, hashes``) a forest for each unit, which joins the same classes.
    Parts of some size are dealt into ``_SPREAD`` tiles, for as many tasks as these have pairs, and into more where a tile would be large."""
    few, most = _HASHES
    tiles = F.greatest(F.least(F.ceil(F.sum("n") / few), F.lit(_SPREAD)), F.ceil(F.sum("n") / most), F.ceil(F.count("*") / (2 * _TILE)), F.lit(1))
    sizes = members.groupBy("part").agg(tiles.alias("tiles"))
    dealt = _dealt(members.join(sizes, "part"), F.col("tiles"), "part", "hashes")

    def compare(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        first, one = (rows["own"] == key[1]).to_numpy(), key[1] == key[2]
        fp, size, kind = (rows[c].to_numpy(np.int64) for c in ("fp", "n", "class"))
        kind = kind.copy()
        sets = [np.asarray(x, np.int64).view(np.uint64) for x in rows["hashes"].tolist()]
        width = min(1 << 15, max(1 << 12, 8 << int(size.max()).bit_length()))  # finer than the sketches; what passes is compared in any case
        bits = np.stack([np.packbits((np.bincount((s & np.uint64(width - 1)).astype(np.int64), minlength=width) & 1).astype(np.uint8))
                         for s in sets]).view(np.uint64)
        out = []
        for x, facing in _facing(np.arange(len(rows)), first, one):
            right = np.arange(len(rows))[facing]
            right = right[(kind[right] != kind[x]) & (10 * np.minimum(size[right], size[x]) >= TENTHS * np.maximum(size[right], size[x]))]
            apart = np.bitwise_count(bits[right] ^ bits[x]).sum(axis=1, dtype=np.int64)
            passed = 9 * apart <= size[right] + size[x]
            for y in right[passed][np.argsort(apart[passed], kind="stable")]:
                if kind[y] == kind[x]:
                    continue
                common_ = len(np.intersect1d(sets[x], sets[y], assume_unique=True))
                if (10 + TENTHS) * common_ >= TENTHS * int(size[x] + size[y]):
                    out.append((min(fp[x], fp[y]), max(fp[x], fp[y])))
                    kind[kind == kind[y]] = kind[x]
        pairs = np.array(out, dtype=np.int64).reshape(-1, 2)
        return pd.DataFrame({"a": pairs[:, 0], "b": pairs[:, 1]})

    return dealt.groupBy("part", "i", "j").applyInPandas(compare, "a long, b long")


def nominated(distinct: DataFrame) -> DataFrame:
    """``a, b``: pairs of ``fp`` (of ``distinct``: ``fp, print``) whose SimHash fingerprints ``print`` are linked. Of sets that
    have one fingerprint each is paired with the least, and of linked fingerprints the least sets are."""
    least = common.stored(distinct.groupBy("print").agg(F.min("fp").alias("least")), "fingerprint-sets")
    same = distinct.select("fp", "print").join(least, "print").where("fp <> least").select(F.col("least").alias("a"), F.col("fp").alias("b"))
    linked = simhash.links(least.select(F.col("print").alias("fp")))
    for end in "ab":
        linked = linked.withColumnRenamed(end, "print").join(least.withColumnRenamed("least", f"of_{end}"), "print").drop("print")
    return same.union(linked.select(F.least("of_a", "of_b").alias("a"), F.greatest("of_a", "of_b").alias("b")))


def links(docs: DataFrame, distinct: DataFrame) -> DataFrame:
    """``a, b``: pairs of ``fp`` (of the stored ``distinct``: ``fp, row, n, first, sketch, print``) that are similar; enough
    of them to join all that are similar directly or by a chain."""
    sets = Sets(docs, distinct)

    def verified(pairs: DataFrame) -> DataFrame:
        """Those of some pairs ``a, b`` that are similar."""
        mine = distinct.select(F.col("fp").alias("a"), F.col("n").alias("m"), F.col("sketch").alias("p"))
        other = distinct.select(F.col("fp").alias("b"), "n", F.col("sketch").alias("q"))
        likely = common.stored(pairs.distinct().join(mine, "a").join(other, "b").where(_may_be_similar("p", "q")).select("a", "b"), "likely-pairs")
        sets.ask(likely.select(F.explode(F.array("a", "b")).alias("fp")).distinct())
        of_a, of_b = (sets.all().select(F.col("fp").alias(e), F.col("hashes").alias(f"of_{e}")) for e in "ab")
        both = F.size(F.array_intersect("of_a", "of_b"))
        similar = common.stored(likely.join(of_a, "a").join(of_b, "b").where(
            _similar(F.size("of_a"), F.size("of_b"), both)).select("a", "b"), "similar-pairs")
        common.superseded(likely)
        return similar

    found = verified(nominated(distinct))
    common.tidy(docs.sparkSession)
    classed = distinct.select("fp", "n", "first").join(simhash.classes(found).withColumnRenamed("node", "fp"), "fp", "left")
    spread = classed.select("fp", "n", F.explode("first").alias("h"), F.coalesce("root", "fp").alias("class"))
    shared = common.stored(
        distinct.select(F.explode("first").alias("h")).groupBy("h").agg(F.count("*").alias("many")).where("many > 1").select("h"), "shared-shingles")
    left = common.stored(spread.join(shared, "h").select("h", "fp", "n", "class"), "shingle-groups")
    common.superseded(shared)
    common.tidy(docs.sparkSession)

    for turn in range(_STARS + 1):
        sizes = left.groupBy("h").agg(F.count("*").alias("many"), F.min("class").alias("low"), F.max("class").alias("high"))
        open_ = common.stored(sizes.where("low <> high").select("h", "many"), "open-groups")
        most = open_.agg(F.max("many").alias("most")).first()["most"]
        if most is None:
            break
        if turn == _STARS or most <= 3:  # pivots are for groups of near copies; two or three members are pairs anyway
            rest = left.join(open_, "h")
            small = rest.where(F.col("many") <= _SMALL)
            x = small.select("h", F.col("fp").alias("a"), F.col("n").alias("m"), F.col("class").alias("mine"))
            y = small.select("h", F.col("fp").alias("b"), "n", "class")
            pairs = x.join(y, "h").where((F.col("a") < F.col("b")) & (F.col("mine") != F.col("class")) & alike(F.col("m"), F.col("n"))).select("a", "b")
            found = found.union(verified(pairs))
            if most > _SMALL:
                large = rest.where(F.col("many") > _SMALL)
                forest = common.stored(_tiled(large.join(distinct.select("fp", "sketch"), "fp")).distinct(), "candidates")
                parts = simhash.classes(forest).select(F.col("node").alias("fp"), F.col("root").alias("part"))
                members = common.stored(large.select("fp", "n", "class").distinct().join(parts, "fp"), "parts")
                sets.ask(members.select("fp"))
                found = found.union(common.stored(_compared(members.join(sets.all(), "fp")).distinct(), "similar-pairs"))
                for part in [forest, members]:
                    common.superseded(part)
            break
        pivots = left.join(open_, "h").groupBy("h").agg(
            F.min(F.struct(F.xxhash64("fp", F.lit(turn)).alias("order"), "fp", "n", "class")).alias("pivot"))
        held = common.stored(left.join(pivots, "h").where("fp <> pivot.fp"), "held")
        common.superseded(left)
        common.superseded(open_)
        pairs = held.where((F.col("class") != F.col("pivot.class")) & alike(F.col("n"), F.col("pivot.n")))
        found = found.union(verified(pairs.select(F.least("fp", "pivot.fp").alias("a"), F.greatest("fp", "pivot.fp").alias("b"))))
        roots = simhash.classes(found).withColumnRenamed("node", "fp")
        left = common.stored(held.select("fp", "n", "h").join(roots, "fp", "left").select(
            "fp", "n", "h", F.coalesce("root", "fp").alias("class")), "shingle-groups")
        common.superseded(held)
        common.tidy(docs.sparkSession)
    for part in [left, distinct, *sets.parts]:
        common.superseded(part)
    return found


def representatives(docs: DataFrame) -> DataFrame:
    """One row of each class, with all its columns: that with the smallest doc_id (NULL comes last), then
    with the least hash of all columns. Of rows that are equal throughout one stays. An empty table
    gives an empty result."""
    sent = docs.sparkSession.sparkContext.broadcast(frequencies(docs))
    common.tidy(docs.sparkSession)  # the tables that were added up
    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), simhash.row_hash(docs).alias("row"), F.col("text").cast("binary").alias("text"))
    rows = common.stored(_mapped(
        given.select("row", "text"), "row long, fp long, n int, first array<long>, sketch array<long>, print long",
        lambda hashes, row: (row, *_printed(np.unique(hashes), sent.value), _long(simhash.majority(hashes)))), "printed-sets")
    named = common.stored(rows.select("row", "fp").distinct(), "named-sets")
    distinct = common.stored(rows.groupBy("fp").agg(
        F.min("row").alias("row"), F.min("n").alias("n"), F.first("first").alias("first"), F.first("sketch").alias("sketch"),
        F.min("print").alias("print")), "shingle-sets")
    common.superseded(rows)
    common.tidy(docs.sparkSession)
    roots = simhash.classes(links(docs, distinct)).withColumnRenamed("node", "fp")
    of_rows = named.join(roots, "fp", "left").select("row", F.coalesce("root", "fp").alias("root"))
    return simhash.firsts(docs, given.select("doc_id", "row").join(of_rows, "row"))
