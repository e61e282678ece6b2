import hashlib
import time

from pyspark.sql import functions as F

from clickweir.llm import secrets

TREES = [("digits", 0.2, 0.0, 1.0), ("turns", 0.3, 0.0, 1.0), ("covered", 0.5, 1.0, 0.0)]


def test_features_come_from_the_right_neighbours(spark):
    text = 'see http://a.b/cccccccccccccccccccc then token = "04dbebab91ab85687d33" and sha1: 18948d4f84d217db5fc21cae4d2a'
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    found = docs.select(F.inline(secrets.candidates(F.col("text"), ["ccc"]))).collect()
    assert [r["value"] for r in found] == ["b/cccccccccccccccccccc", "04dbebab91ab85687d33", "18948d4f84d217db5fc21cae4d2a"]
    assert [r["named"] for r in found] == [0, 1, 0] and [r["quoted"] for r in found] == [0, 1, 0]
    assert [r["hash_word"] for r in found] == [0, 0, 1] and found[0]["covered"] > 0.8


def test_votes_equal_the_trees_by_hand(spark):
    values = ["04dbebab91ab85687d33", "abcdefghijklmnopqrst", "AAAAAAAAAA1111111111"]
    docs = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "doc_id long, text string")
    found = secrets.candidates(F.col("text"), ["abc"])
    rows = docs.select(found.alias("c"), secrets.scored(found, TREES).alias("s")).collect()
    def vote(tree, c):
        return tree if isinstance(tree, float) else vote(tree[2] if c[tree[0]] <= tree[1] else tree[3], c)
    assert [r["s"] for r in rows] == [[sum(vote(t, c) for t in TREES) / 3 for c in r["c"]] for r in rows]


def test_forest_learns_and_is_read_back(spark):
    rows = spark.range(400).select(
        F.sha1(F.col("id").cast("string")).alias("k"), F.col("id")).select(
        F.when(F.col("id") % 2 == 0, F.concat(F.lit("token = "), "k")).otherwise(
            F.concat(F.lit("some "), F.translate("k", "0123456789", "abcdefghij"))).alias("text"), F.col("id").alias("doc_id"))
    triples, trees = secrets.trained(rows)
    assert len(trees) == secrets.Settings().trees
    found = secrets.findings(rows, triples, trees)
    assert found.select("doc_id").distinct().count() == 200 and found.where("doc_id % 2 = 1").count() == 0
    assert secrets.masked(rows, triples, trees).where(F.col("text") == "token = <SECRET>").count() == 200


def test_masking_keeps_all_else(spark, documents):
    trees = [("digits", 0.1, 0.0, 1.0)]
    got = secrets.masked(documents, [], trees)
    assert got.columns == documents.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, documents.collect()))
    docs = spark.createDataFrame([(1, "a 04dbebab91ab85687d33 é 04dbebab91ab85687d33", "x"), (1, "", "y")], "doc_id long, text string, _found string")
    assert {r["text"] for r in secrets.masked(docs, [], trees).collect()} == {"a <SECRET> é <SECRET>", ""}
    assert secrets.findings(documents, [], trees).count() == 0 and secrets.findings(docs, [], trees).count() == 2


def test_training_on_nothing(spark, documents):
    for docs in (documents, documents.limit(0)):
        triples, trees = secrets.trained(docs)
        assert secrets.findings(docs, triples, trees).count() == 0


def test_covered_counts_every_triple(spark):
    values = ["abcabcabcabcabcabc", "ABCxabcyabcabababca", "x" * 16, "abc" + "z" * 20 + "abc"]
    docs = spark.createDataFrame([(v,) for v in values], "text string")
    rows = docs.select("text", F.inline(secrets.candidates(F.col("text"), ["abc", "bca", "zab"]))).collect()
    for r in rows:
        low = r["text"].lower()
        known = sum(low[i: i + 3] in ("abc", "bca", "zab") for i in range(len(low) - 2))
        assert r["covered"] == known / (len(low) - 2)


def test_a_very_long_candidate(spark):
    """A data address of a megabyte takes seconds; its features are linear in its length."""
    long = "".join(hashlib.sha1(str(i).encode()).hexdigest() for i in range(25_000))
    docs = spark.createDataFrame([(1, f"data:{long}==")], "doc_id long, text string")
    start = time.monotonic()
    (row,) = docs.select(F.inline(secrets.candidates(F.col("text"), ["abc", "123"]))).collect()
    assert row["length"] == 1_000_002 and time.monotonic() - start < 60
