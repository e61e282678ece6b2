"""Document fingerprints as Merkle trees, in SQL expressions.

Leaves are sentences (or stretches of at most ``LEAF`` characters of one), paragraphs are lines, sections
are what blank lines part. A node is the hash of its children in order; the root goes into the
fingerprint, so equal texts have equal fingerprints. Branches that differ say where texts differ, and
how many of their leaves two trees have in common says how alike they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from clickweir.llm import common

LEAF = 48
_GAP = r"\n[ \t]*\n"
_SENTENCE = rf"[^.!?\n]{{1,{LEAF}}}[.!?\s]*|[.!?\s]+"


def sections(text: Column) -> Column:
    """``array<struct<hash, paragraphs: array<struct<hash, leaves: array<string>>>>>``: the hashes of each
    section, of its paragraphs and of their leaves."""
    def paragraphs(part: Column) -> Column:
        hashed = F.transform(F.split(part, "\n", -1), lambda line: F.transform(
            F.regexp_extract_all(line, F.lit(_SENTENCE), F.lit(0)), lambda x: F.sha2(x, 256)))
        return F.transform(hashed, lambda inner: F.struct(_node("p", inner).alias("hash"), inner.alias("leaves")))
    gaps = F.regexp_extract_all(text, F.lit(_GAP), F.lit(0))
    parts = F.arrays_zip(
        F.transform(F.split(text, _GAP, -1), paragraphs).alias("held"), F.concat(gaps, F.array(F.lit(""))).alias("gap"))
    # White space in the blank line after a section is part of its hash, so nothing of the text is in no hash.
    return F.transform(parts, lambda x: F.struct(
        _node("s", F.concat(F.transform(x["held"], lambda p: p["hash"]), F.filter(F.array(x["gap"]), lambda g: F.length(g) > 2))).alias("hash"),
        x["held"].alias("paragraphs")))


def leaves(tree: Column) -> Column:
    """Hashes of the leaves of a tree, in order; of that of an empty text none."""
    return F.flatten(F.flatten(F.transform(tree, lambda s: F.transform(s["paragraphs"], lambda p: p["leaves"]))))


def _node(kind: str, children: Column) -> Column:
    return F.sha2(F.concat(F.lit(kind), F.array_join(children, ",")), 256)


def root(tree: Column) -> Column:
    """Hash over the sections of a tree; 64 hexadecimal digits."""
    return _node("r", F.transform(tree, lambda s: s["hash"]))


def likeness(left: Column, right: Column) -> Column:
    """Twice the distinct leaves that two texts have in common over the distinct leaves of both (0 to 1); 1
    for two empty ones."""
    left, right = F.array_distinct(left), F.array_distinct(right)
    all_ = F.size(left) + F.size(right)
    return F.when(all_ == 0, F.lit(1.0)).otherwise(2 * F.size(F.array_intersect(left, right)) / all_)


def differing(left: Column, right: Column) -> Column:
    """``array<struct<section, paragraph>>``: places (from 0) of the paragraphs that are not the same in both
    trees, those that only one tree has included. Sections of equal hash are not looked into."""
    def places(a: Column, b: Column) -> Column:
        return F.sequence(F.lit(0), F.greatest(F.size(a), F.size(b), F.lit(1)) - 1)

    def in_section(i: Column) -> Column:
        mine, other = F.get(left, i), F.get(right, i)
        lines = F.transform(places(mine["paragraphs"], other["paragraphs"]), lambda j: F.struct(
            i.alias("section"), j.alias("paragraph"),
            (~F.get(mine["paragraphs"], j)["hash"].eqNullSafe(F.get(other["paragraphs"], j)["hash"])).alias("differs")))
        kept = F.filter(lines, lambda x: x["differs"])
        return F.when(mine["hash"].eqNullSafe(other["hash"]), F.slice(kept, 1, 0)).otherwise(kept)
    return F.flatten(F.transform(places(left, right), in_section))


def fingerprints(docs: DataFrame) -> DataFrame:
    """``docs`` (text NULL: empty) as ``doc_id, fingerprint, tree``; each row by itself."""
    text = F.coalesce(F.col("text"), F.lit(""))
    tree = sections(text)
    return docs.select("doc_id", tree.alias("tree")).select("doc_id", root(F.col("tree")).alias("fingerprint"), "tree")


# ---------------------------------------------------------------- the next document


def successors(ids: DataFrame, width: int = 1000, most: int = 1000) -> DataFrame:
    """``id, slice, next``: of distinct numbers ``id`` (no NULLs) the next smaller one, NULL for the
    smallest. Numbers are ordered in slices of about ``width`` of them; what follows the smallest of a
    slice is found in the same way from the slices, of which there are ever fewer."""
    bounds = ids.agg(F.min("id").alias("low"), F.max("id").alias("high"), F.count("*").alias("n")).first()
    if not bounds["n"]:
        return ids.select("id", F.lit(None).cast("long").alias("slice"), F.lit(None).cast("long").alias("next"))
    step = max(1, (bounds["high"] - bounds["low"] + 1) * width // bounds["n"])
    low = bounds["low"]
    sliced = ids.withColumn("slice", F.floor((F.col("id") - F.lit(low)) / F.lit(step)).cast("long"))
    if bounds["n"] <= most:
        return sliced.withColumn("next", F.lag("id").over(Window.partitionBy(F.lit(0)).orderBy("id")))
    ends = common.stored(sliced.groupBy("slice").agg(F.min("id").alias("least"), F.max("id").alias("most")), "slices")
    below = successors(ends.select(F.col("slice").alias("id")), width, most).select(F.col("id").alias("at"), F.col("next").alias("below"))
    linked = ends.join(below, ends["slice"] == below["at"], "left").select("slice", "least", "below")
    tops = ends.select(F.col("slice").alias("top_of"), F.col("most").alias("top"))
    jumps = linked.join(tops, linked["below"] == tops["top_of"], "left").select(F.col("slice").alias("of"), "top")
    within = sliced.withColumn("next", F.lag("id").over(Window.partitionBy("slice").orderBy("id")))
    return within.join(jumps, within["slice"] == jumps["of"]).select("id", "slice", F.coalesce("next", "top").alias("next"))


def with_next(docs: DataFrame, width: int = 200) -> DataFrame:
    """``doc_id, text, next_text``: the text of the document with the next smaller doc_id, of the smallest
    that of the largest; alone, its own. Texts are shuffled once, by slices of doc_ids, and ordered
    within these; the first document of each slice is sent to the slice above it as well.

    A NULL text is empty. Rows with a NULL doc_id have no place in the order: their next is the largest.
    Rows that repeat a doc_id follow each other by the hash of their text."""
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    ids = rows.where("doc_id IS NOT NULL")
    bounds = ids.agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.count("*").alias("n")).first()
    if not bounds["n"]:
        return rows.withColumn("next_text", F.col("text"))
    low, high, step = bounds["low"], bounds["high"], max(1, (bounds["high"] - bounds["low"] + 1) * width // bounds["n"])
    slice_ = F.floor((F.col("doc_id") - F.lit(low)) / F.lit(step)).cast("long")
    tops = common.stored(ids.groupBy(slice_.alias("slice")).agg(F.max("doc_id").alias("top")), "slice-tops")
    order = successors(tops.select(F.col("slice").alias("id"))).select(F.col("id").alias("above"), F.col("next").alias("slice"))
    # The largest document goes to the lowest slice, whose last document it follows.
    visits = tops.join(order, "slice").select(F.col("top").alias("visitor"), F.col("above").alias("to")).union(
        docs.sparkSession.range(1).select(F.lit(high).cast("long").alias("visitor"), F.lit(0).cast("long").alias("to")))
    visits = common.stored(visits, "visits")
    own = ids.select("doc_id", "text", slice_.alias("slice"), F.lit(0).alias("visiting"), F.xxhash64("text").alias("tie"))
    first = F.row_number().over(Window.partitionBy("visitor", "to").orderBy(F.desc("tie"))) == 1
    guests = ids.join(visits, ids["doc_id"] == visits["visitor"]).select(
        "doc_id", "text", "to", F.lit(1).alias("visiting"), F.xxhash64("text").alias("tie"), "visitor")
    guests = guests.withColumn("first", first).where("first").select("doc_id", "text", F.col("to").alias("slice"), "visiting", "tie")
    follow = Window.partitionBy("slice").orderBy("visiting", F.desc("doc_id"), F.desc("tie"))
    placed = own.union(guests).withColumn("next_text", F.lead("text").over(follow)).where("visiting = 0").select("doc_id", "text", "next_text")
    lost = rows.where("doc_id IS NULL")
    largest = ids.where(F.col("doc_id") == high).groupBy().agg(F.max_by("text", F.xxhash64("text")).alias("next_text"))
    return placed.union(lost.crossJoin(F.broadcast(largest)).select("doc_id", "text", "next_text"))


def compared(docs: DataFrame) -> DataFrame:
    """Each document, its edited text (the last half replaced by the beginning of the next document) and
    how alike the trees are: ``doc_id, n_chars, edited, fingerprint, edited_fingerprint, near_edited,
    near_next, changed`` (the paragraphs that the edit changed)."""
    rows = with_next(docs)
    size = F.length("text")
    half = F.floor(size / 2).cast("int")
    edited = F.concat(F.left("text", size - half), F.left("next_text", half))
    rows = rows.select("doc_id", "text", "next_text", edited.alias("edited"), size.cast("long").alias("n_chars"))
    rows = rows.select(
        "doc_id", "n_chars", "edited", sections(F.col("text")).alias("tree"), sections(F.col("edited")).alias("edited_tree"),
        sections(F.col("next_text")).alias("next_tree"))
    own = leaves(F.col("tree"))
    return rows.select(
        "doc_id", "n_chars", "edited", root(F.col("tree")).alias("fingerprint"), root(F.col("edited_tree")).alias("edited_fingerprint"),
        likeness(own, leaves(F.col("edited_tree"))).alias("near_edited"), likeness(own, leaves(F.col("next_tree"))).alias("near_next"),
        differing(F.col("tree"), F.col("edited_tree")).alias("changed"))
