"""Secret scans: candidate strings from texts, and a random forest that removes the false ones.

Everything is SQL expressions. A text is split at its candidates, so candidate ``i`` stands between the
gaps ``i`` and ``i + 1`` and its neighbouring words are the ends of these. The forest is trained on
labelled findings with Spark's own classifier and written out as one expression per tree, so scoring
and masking happen inside the scan, without a join or a shuffle, and texts are put together again from
gaps and candidates.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickweir.llm import common

CANDIDATE = r"[A-Za-z0-9+/_-]{16,}={0,2}"
MASK = "<SECRET>"

# The public formats of some issuers' keys.
_ISSUED = (
    ("access_key_id", r"^(AKIA|ASIA)[0-9A-Z]{16}$"),
    ("hosting_token", r"^gh[pousr]_[A-Za-z0-9]{30,}$"),
    ("chat_token", r"^xox[abprs]-[A-Za-z0-9-]{10,}$"),
    ("api_key", r"^(sk|rk|pk)[-_](live[-_]|test[-_])?[A-Za-z0-9]{16,}$"),
    ("map_key", r"^AIza[0-9A-Za-z_-]{35}$"),
    ("web_token", r"^eyJ[A-Za-z0-9_-]{10,}$"),
)
_NAMED = r"(?i)(pass(word|wd|phrase)?|pwd|secret|token|api[_-]?key|access[_-]?key|auth|credential|private[_-]?key)[\"']?\s*(=|:|=>|is)?\s*[\"']?$"
_ASSIGNED = r"[=:]\s*[\"']?$"
_HASH_WORD = r"(?i)(sha-?(1|256|512)|md5|commit|uuid|guid|checksum|digest|etag|revision)\W{0,4}$"
Tree = float | tuple
_TEST_PATH = r"(?i)(^|/)(tests?|examples?|fixtures?|docs?|samples?)(/|$)"

FEATURES = [
    "length", "digits", "uppers", "lowers", "turns", "distinct", "covered", "hex", "vowels", "slashes",
    "named", "assigned", "quoted", "after_path", "hash_word", "address", "test_path",
]


@dataclass(frozen=True)
class Settings:
    """``dictionary``: how many of the commonest letter triples of the corpus' short words count as
    dictionary; ``per_class`` bounds the labelled findings that are trained on."""

    dictionary: int = 4000
    per_class: int = 6000
    trees: int = 24
    depth: int = 6
    least: float = 0.5
    seed: int = 11


def _share(text: Column, kind: str) -> Column:
    return 1 - F.length(F.regexp_replace(text, kind, "")) / F.length(text)


def dictionary(docs: DataFrame, settings: Settings = Settings()) -> list[str]:
    """The commonest letter triples in words of 3 to 8 letters, counted over all texts."""
    words = docs.select(F.explode(F.split(F.lower("text"), r"\P{L}+")).alias("w")).where(F.length("w").between(3, 8))
    counted = words.groupBy("w").agg(F.count("*").alias("n"))
    triples = counted.select("n", F.explode(F.transform(
        F.sequence(F.lit(1), F.length("w") - 2), lambda i: F.substring(F.col("w"), i, F.lit(3)))).alias("t"))
    top = triples.groupBy("t").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "t").limit(settings.dictionary)
    return [r["t"] for r in top.collect()]


def candidates(text: Column, triples: list[str], path: Column | None = None) -> Column:
    """``array<struct>`` of the candidates of a text in order, with their features; NULL for NULL."""
    gaps = F.split(text, CANDIDATE, -1)
    zipped = F.arrays_zip(
        F.regexp_extract_all(text, F.lit(CANDIDATE), F.lit(0)).alias("value"), gaps.alias("before"),
        F.slice(gaps, 2, 1 << 30).alias("after"))
    # Each candidate gets its own neighbourhood first, so that what follows never goes back to the text.
    around = F.transform(F.filter(zipped, lambda x: x["value"].isNotNull()), lambda x: F.struct(
        x["value"].alias("value"), F.right(x["before"], F.lit(40)).alias("before"), F.left(x["after"], F.lit(20)).alias("after")))
    test = F.coalesce(path.rlike(_TEST_PATH), F.lit(False)) if path is not None else F.lit(False)

    def described(x: Column) -> Column:
        value, before, after = x["value"], x["before"], x["after"]
        size = F.length(value)
        classes = F.translate(value, "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-=", "A" * 26 + "a" * 26 + "0" * 10 + "_" * 5)
        runs = F.length(F.regexp_replace(classes, r"(.)\1*", "$1"))
        lower = F.lower(value)
        # All triples: those that begin at every third letter from the first, the second and the third on.
        known = sum((F.size(F.filter(
            F.regexp_extract_all(F.substring(lower, k, 1 << 30), F.lit("(?s)..."), F.lit(0)), lambda t: t.isin(triples)))
            for k in (1, 2, 3)), F.lit(0)) if triples else F.lit(0)
        flag = lambda c: c.cast("double")
        values = {
            "length": size.cast("double"), "digits": _share(value, "[0-9]"), "uppers": _share(value, "[A-Z]"),
            "lowers": _share(value, "[a-z]"), "turns": runs / size,
            "distinct": F.size(F.array_distinct(F.split(value, ""))) / size, "covered": known / (size - 2),
            "hex": flag(value.rlike("^[0-9a-f]+$") | value.rlike("^[0-9A-F]+$")), "vowels": _share(lower, "[aeiou]"),
            "slashes": _share(value, "/"), "named": flag(before.rlike(_NAMED)), "assigned": flag(before.rlike(_ASSIGNED)),
            "quoted": flag(before.rlike("[\"']$") & after.rlike("^[\"']")), "after_path": flag(before.rlike(r"[/.\\]$")),
            "hash_word": flag(before.rlike(_HASH_WORD)), "address": flag(after.rlike(r"^[@.]\w") | before.rlike(r"@$")),
            "test_path": flag(test),
        }
        kind = F.coalesce(*[F.when(value.rlike(p), F.lit(k)) for k, p in _ISSUED],
                          F.when(before.rlike(_NAMED), F.lit("assigned")), F.lit("string"))
        return F.struct(value.alias("value"), kind.alias("kind"), *[values[n].alias(n) for n in FEATURES])

    return F.transform(around, described)


def labelled(findings: DataFrame) -> DataFrame:
    """``findings`` (columns of a candidate) with ``label`` where a reviewer's rule is sure: 1 for an issuer's
    format or a value with digits that is assigned to a name of a secret; 0 for plain words, numbers
    alone, addresses and named digests. Others are dropped. The forest sees neither rule."""
    issued = F.col("kind").isin([k for k, _ in _ISSUED])
    sure = issued | ((F.col("named") == 1) & (F.col("assigned") == 1) & F.col("digits").between(0.05, 0.95))
    words = (F.col("digits") == 0) & (F.col("named") == 0)
    false = words | (F.col("digits") == 1) | (F.col("hash_word") == 1) | (F.col("address") == 1)
    return findings.withColumn("label", F.when(sure, 1.0).when(false, 0.0)).where("label IS NOT NULL")


def fit(labels: DataFrame, settings: Settings = Settings()) -> list[Tree]:
    """Trees over the features, trained on at most ``per_class`` findings of each label (``value``, features,
    ``label``), chosen by a hash; equal values count once, so that copies do not crowd out others. With
    one class or none, a single tree that gives every candidate the same."""
    once = labels.groupBy("value").agg(*[F.first(F.struct(*FEATURES, "label"), True).alias("x")]).select("value", "x.*")
    order = [F.xxhash64("value"), F.col("value")]
    parts = [once.where(F.col("label") == k).orderBy(*order).limit(settings.per_class) for k in (0.0, 1.0)]
    sample = common.stored(parts[0].union(parts[1]).select(*FEATURES, "label"), "labelled-findings")
    seen = {r["label"] for r in sample.select("label").distinct().collect()}
    if len(seen) < 2:
        return [float(seen.pop() if seen else 1.0)]
    ready = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(sample)
    forest = RandomForestClassifier(
        numTrees=settings.trees, maxDepth=settings.depth, seed=settings.seed, featureSubsetStrategy="sqrt").fit(ready)
    return [_nested(tree) for tree in re.split(r"\n\s*Tree \d+ \(weight [0-9.]+\):\n", forest.toDebugString)[1:]]


def _nested(printed: str) -> Tree:
    """The printed form of a tree as ``(feature, limit, at most, above)`` or the value of a leaf."""
    lines = [line.strip() for line in printed.splitlines() if line.strip()]

    def node(at: int) -> tuple[Tree, int]:
        if lines[at].startswith("Predict"):
            return float(lines[at].split(":")[1]), at + 1
        feature, limit = re.match(r"If \(feature (\d+) <= ([-0-9.eE]+)\)", lines[at]).groups()
        low, at = node(at + 1)
        high, at = node(at + 1)
        return (FEATURES[int(feature)], float(limit), low, high), at

    return node(0)[0]


def scored(found: Column, trees: list[Tree]) -> Column:
    """``array<double>``: for each candidate the share of trees that take it for a secret."""
    def votes(c: Column) -> Column:
        total = F.lit(0.0)
        for tree in trees:
            total = total + _vote(tree, c)
        return total / len(trees)

    return F.transform(found, votes)


def _vote(tree: Tree, c: Column) -> Column:
    if isinstance(tree, float):
        return F.lit(tree)
    feature, limit, low, high = tree
    return F.when(c[feature] <= limit, _vote(low, c)).otherwise(_vote(high, c))


def trained(docs: DataFrame, settings: Settings = Settings()) -> tuple[list[str], list[Tree]]:
    """Dictionary and trees for a corpus, from its own labelled findings."""
    triples = dictionary(docs, settings)
    found = docs.select(F.inline(candidates(F.col("text"), triples)))
    return triples, fit(labelled(found), settings)


def _marked(docs: DataFrame, triples: list[str], trees: list[Tree], path: Column | None) -> DataFrame:
    taken = set(docs.columns)
    names = [next(n for n in (f"_{k}{'_' * i}" for i in range(99)) if n not in taken) for k in ("found", "scores")]
    return (
        docs.withColumn(names[0], candidates(F.col("text"), triples, path))
        .withColumn(names[1], scored(F.col(names[0]), trees)), *names)


def findings(docs: DataFrame, triples: list[str], trees: list[Tree], settings: Settings = Settings(), path: Column | None = None) -> DataFrame:
    """One row per secret: ``doc_id, ordinal`` (which candidate of its text, from 0), ``kind, value, score``.
    NULL and empty texts have none; repeated rows give repeated findings."""
    marked, found, scores = _marked(docs.select("doc_id", "text"), triples, trees, path)
    rows = marked.select("doc_id", F.posexplode(F.arrays_zip(
        F.transform(found, lambda c: F.struct(c["value"].alias("value"), c["kind"].alias("kind"))).alias("c"), F.col(scores).alias("s"))))
    return rows.select("doc_id", F.col("pos").alias("ordinal"), "col.c.kind", "col.c.value", F.col("col.s").alias("score")).where(
        F.col("score") >= settings.least)


def masked(docs: DataFrame, triples: list[str], trees: list[Tree], settings: Settings = Settings(), path: Column | None = None) -> DataFrame:
    """``docs``, all rows and columns, with each secret in ``text`` replaced by a mark. Texts without one
    stay as they are, also NULL and empty ones."""
    marked, found, scores = _marked(docs, triples, trees, path)
    gaps = F.split(F.col("text"), CANDIDATE, -1)
    parts = F.transform(gaps, lambda gap, i: F.concat(gap, F.coalesce(
        F.when(F.get(F.col(scores), i) >= settings.least, F.lit(MASK)).otherwise(F.get(F.col(found), i)["value"]), F.lit(""))))
    any_ = F.exists(F.col(scores), lambda s: s >= settings.least)
    return marked.withColumn("text", F.when(any_, F.array_join(parts, "")).otherwise(F.col("text"))).drop(found, scores)
