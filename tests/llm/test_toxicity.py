import random
import tracemalloc

import numpy as np
import pytest

from clickweir.llm import toxicity

SETTINGS = toxicity.Settings(per_class=300, buckets=1 << 14, rounds=3)


def corpus(seed, count):
    pick, rows = random.Random(seed), []
    plain = ["".join(pick.choices("aeioulmnrst", k=pick.randrange(2, 8))) for _ in range(400)]
    for i in range(count):
        words = pick.choices(plain, k=pick.randrange(5, 80))
        if i % 4 == 0:
            for _ in range(max(1, len(words) // 25)):
                words.insert(pick.randrange(len(words)), "grob" + "".join(pick.choices("aeiounxk", k=3)))
        rows.append((" ".join(words), int(i % 4 == 0)))
    return rows


@pytest.fixture(scope="module")
def model():
    texts, label = zip(*corpus(1, 800))
    return toxicity.train(list(texts), np.array(label), 0.25, SETTINGS)


def test_held_out_accuracy_on_unseen_spellings(model):
    texts, label = zip(*corpus(2, 400))
    found = np.array(toxicity.Scorer(model, 10_000).scores(list(texts))) >= 0.5
    assert (found == np.array(label)).mean() > 0.95


def test_subwords_are_shared_and_marked():
    ids, starts = toxicity.subwords(["stupid", "stupiid"], 1 << 16)
    first, second = set(ids[starts[0]:starts[1]].tolist()), set(ids[starts[1]:starts[2]].tolist())
    assert len(first & second) >= 5 and first != second
    assert len(toxicity.subwords(["a"], 64)[0]) == 2  # itself and its marked form


def test_scores_do_not_hang_on_batches_or_cache(model):
    texts = [t for t, _ in corpus(3, 60)]
    once = toxicity.Scorer(model, 10_000).scores(texts)
    assert np.allclose(once, [toxicity.Scorer(model, 1).scores([t])[0] for t in texts])


def test_score_keeps_all_rows(spark, documents, model):
    got = toxicity.score(documents, model, SETTINGS).collect()
    assert len(got) == 8 and all(0 <= r["score"] <= 1 for r in got)
    empty = {r["score"] for r in got if not (r["text"] or "").strip()}
    assert len(empty) == 1
    assert toxicity.score(documents.limit(0), model, SETTINGS).count() == 0


def test_fit_without_labels_or_documents(spark, documents):
    labels = spark.createDataFrame([(None, 1), (4, None), (3, 1), (3, 0)], "doc_id long, toxic int")
    for docs, given in ((documents, labels), (documents, labels.limit(0)), (documents.limit(0), labels)):
        model = toxicity.fit(docs, given, SETTINGS)
        assert all(0 <= r["score"] <= 1 for r in toxicity.score(documents, model, SETTINGS).collect())


def test_training_holds_little_beyond_what_it_keeps(monkeypatch):
    """N-grams of many distinct words are made a part at a time, and are the same ones."""
    pick = random.Random(6)
    texts = [" ".join("".join(pick.choices("abcdefghijkl", k=9)) for _ in range(1500)) for _ in range(60)]
    tracemalloc.start()
    bags = toxicity._Bags(texts, SETTINGS)
    held, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert peak - held < 4 * bags.ids.nbytes
    monkeypatch.setattr(toxicity, "_PART", 7)
    other = toxicity._Bags(texts[:3], SETTINGS)
    monkeypatch.setattr(toxicity, "_PART", 1 << 30)
    whole = toxicity._Bags(texts[:3], SETTINGS)
    assert (other.ids == whole.ids).all() and (other.starts == whole.starts).all()
    assert not len(toxicity._Bags([], SETTINGS).ids)
