import random

import numpy as np
import pytest

from clickweir.llm import decontamination as dc

PASSAGES = [(1, "The quick brown fox jumps over the lazy dog near the old river bank."), (2, "Ünd wieder ging die Sönne auf über dem stillen Tal der Väter."),
            (3, "short"), (None, "a passage without id that is long enough"), (4, None)]


def edits(passage, text):
    """Least edits of the passage anywhere in the text."""
    cost = np.zeros(len(text) + 1, dtype=int)
    for p in passage:
        new = np.empty_like(cost)
        new[0] = cost[0] + 1
        for j, c in enumerate(text, 1):
            new[j] = min(cost[j - 1] + (p != c), cost[j] + 1, new[j - 1] + 1)
        cost = new
    return cost.min()


def changed(passage, count, pick):
    letters = list(passage)
    for _ in range(count):
        at = pick.randrange(len(letters))
        match pick.choice("sid"):
            case "s":
                letters[at] = pick.choice("abcdeéx ")
            case "i":
                letters.insert(at, pick.choice("abcdeéx"))
            case _:
                del letters[at]
    return "".join(letters)


def test_finds_what_the_whole_table_finds():
    pick = random.Random(3)
    index = dc.Index([p for p in PASSAGES if None not in p], dc.Settings())
    for n in range(120):
        item, passage = PASSAGES[n % 2]
        allowed = int(index.edits[n % 2])
        noise = lambda: "".join(pick.choices("the fox river tal ", k=pick.randrange(0, 60)))
        text = noise() + changed(passage, pick.randrange(0, 2 * allowed), pick) + noise()
        plain = "".join(chr(c) for c in dc.normal(text)[0])
        best = edits("".join(chr(c) for c in dc.normal(passage)[0]), plain)
        got = [x for x in index.leaks(text) if x["item_id"] == item]
        assert bool(got) == (best <= allowed), (text, best)
        if got:
            assert min(x["edits"] for x in got) == best


def test_spans_are_those_of_the_text():
    index = dc.Index([PASSAGES[0]], dc.Settings())
    inside = PASSAGES[0][1].upper().replace(" ", " \n ")
    text = "İ \U0001f600 before. " + inside + " after"
    (leak,) = index.leaks(text)
    assert text[leak["start"]: leak["end"]] == inside and leak["edits"] == 0
    twice = index.leaks(PASSAGES[0][1] * 2)
    assert [x["start"] for x in twice] == [0, len(PASSAGES[0][1])]


def test_long_texts_are_searched_throughout():
    index = dc.Index([PASSAGES[0]], dc.Settings(segment=500))
    text = "no leak here, only words. " * 900
    for at in (0, 499, 700, 11_111, len(text)):
        (leak,) = index.leaks(text[:at] + PASSAGES[0][1] + text[at:])
        assert leak["start"] == at
    assert index.leaks(text) == [] == index.leaks(None) == index.leaks("")


def test_on_spark_in_blocks(spark, documents):
    passages = spark.createDataFrame([*PASSAGES, PASSAGES[0]], "item_id long, text string")
    rows = [(10, "x " + PASSAGES[0][1] + " y " + PASSAGES[1][1], 0.0, "", 0, ""), (None, PASSAGES[1][1], 0.0, "", 0, "")]
    docs = documents.union(spark.createDataFrame(rows, documents.schema))
    for block in (40, 1 << 20):
        settings = dc.Settings(block_chars=block)
        got = sorted((r["doc_id"] or 0, r["item_id"]) for r in dc.contaminations(docs, passages, settings).collect())
        assert got == [(0, 2), (10, 1), (10, 2)]
        kept = dc.clean(docs.withColumnRenamed("fp", "_leaks"), passages, settings)
        assert kept.count() == 8 and "_leaks" in kept.columns
    assert dc.clean(docs, passages.limit(0)).count() == 10 and dc.contaminations(docs.limit(0), passages).count() == 0


@pytest.mark.parametrize("length", [8, 9, 16, 40, 400])
def test_bound_is_at_least_one(length):
    index = dc.Index([(1, "ab cd efgh" * 40)[:1] + (("abcdefghij" * 40)[:length],)], dc.Settings())
    assert index.bound[0] >= 1
