import random
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from clickweir.llm import merkle, queries


@pytest.mark.parametrize("ids", [[], [5], list(range(-3, 40)), [1, 2, 3, 10**15, 10**15 + 1, 10**18], [i * i for i in range(90)]])
def test_successors(spark, ids):
    frame = spark.createDataFrame([(i,) for i in ids], "id long")
    got = {r["id"]: r["next"] for r in merkle.successors(frame, width=3, most=4).collect()}
    assert got == {b: a for a, b in zip([None, *ids], ids)}


def test_next_texts(spark):
    rows = [(i * 7 % 101, f"text {i}") for i in range(101)] + [(500, None)]
    got = {r["doc_id"]: (r["text"], r["next_text"]) for r in merkle.with_next(spark.createDataFrame(rows, "doc_id long, text string"), width=5).collect()}
    order = sorted(rows, reverse=True)
    want = {a[0]: (a[1] or "", b[1] or "") for a, b in zip(order, order[1:] + order[:1])}
    assert got == want


def test_repeated_ids_and_null_ids(spark, documents):
    got = merkle.with_next(documents).collect()
    assert len(got) == 8 and all(r["next_text"] is not None for r in got)
    (lost,) = [r for r in got if r["doc_id"] is None]
    assert lost["next_text"] == documents.where("doc_id = 6").first()["text"]
    assert merkle.with_next(documents.limit(0)).count() == 0
    alone = merkle.compared(documents.where("doc_id = 6")).first()
    assert alone["near_next"] == 1.0
    nulls = documents.where("doc_id IS NULL")
    assert merkle.compared(nulls).count() == 1


def test_edits_and_roots(spark, documents):
    rows = {r["doc_id"]: r for r in merkle.compared(documents.where("doc_id <> 4")).collect()}
    texts = {r["doc_id"]: r["text"] or "" for r in documents.collect() if r["doc_id"] not in (None, 4)}
    order = sorted(texts, reverse=True)
    for a, b in zip(order, order[1:] + order[:1]):
        half = len(texts[a]) // 2
        assert rows[a]["edited"] == texts[a][: len(texts[a]) - half] + texts[b][:half]
        assert (rows[a]["fingerprint"] == rows[a]["edited_fingerprint"]) == (rows[a]["edited"] == texts[a])
        assert 0 <= rows[a]["near_edited"] <= 1 and rows[a]["n_chars"] == len(texts[a])
    assert rows[0]["fingerprint"] == rows[1]["fingerprint"]


def test_tree_by_hand_and_branches(spark):
    h = lambda s: sha256(s.encode()).hexdigest()
    paragraph = lambda leaves: h("p" + ",".join(map(h, leaves)))
    text, other = "One. Two.\nThree.\n\nFour.", "One. Two.\nThird.\n\nFour."
    p = [paragraph(["One. ", "Two."]), paragraph(["Three."]), paragraph(["Four."])]
    root = h("r" + ",".join([h("s" + ",".join(p[:2])), h("s" + p[2])]))
    df = spark.createDataFrame([(1, text), (2, other)], "doc_id long, text string")
    prints = {r["doc_id"]: r for r in merkle.fingerprints(df).collect()}
    assert prints[1]["fingerprint"] == root != prints[2]["fingerprint"]
    trees = spark.createDataFrame([(text, other)], "a string, b string").select(
        merkle.differing(merkle.sections(F.col("a")), merkle.sections(F.col("b"))).alias("d")).first()["d"]
    assert [(x["section"], x["paragraph"]) for x in trees] == [(0, 1)]


def test_deleted_ends_are_reported_and_counted(spark, tmp_path):
    pairs = [("a.\nb.\nc.\n\nd.", "a.\nb.\n\nd."), ("a.\n\nb.\nc.", "a."), ("a.", "a.\n\nb."), ("a.", "a.")]
    rows = spark.createDataFrame(pairs, "a string, b string").select(
        merkle.differing(merkle.sections(F.col("a")), merkle.sections(F.col("b"))).alias("d")).collect()
    assert [[(x["section"], x["paragraph"]) for x in r["d"]] for r in rows] == [[(0, 2)], [(1, 0), (1, 1)], [(1, 0)], []]
    spark.createDataFrame([(1, "x.\ny.\nz.\nw."), (2, "x.\ny.\nq.\nr.")], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: r["n_changed"] for r in queries.op9_document_fingerprints(spark, str(tmp_path)).collect()}
    assert got == {1: 2, 2: 2}


def test_roots_are_equal_for_equal_texts_only(spark):
    pick = random.Random(8)
    texts = {"".join(pick.choices("ab. \n\n\t", k=pick.randint(0, 14))) for _ in range(10_000)}
    texts |= {"a b.\n\nc d.", "a b.\n \nc d.", "a b.\n\t\t\nc d.", "a b.\n\n\nc d.", "\n \n", "\n\t\n", "\n\n"}
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(sorted(texts))], "doc_id long, text string")
    found = merkle.fingerprints(rows.union(rows)).select("doc_id", "fingerprint").distinct()
    assert found.count() == len(texts) == found.select("fingerprint").distinct().count()
