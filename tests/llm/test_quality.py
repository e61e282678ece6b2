import random

import numpy as np

from clickweir.llm import quality


def text(good, pick):
    words = ["".join(pick.choices("aeioulmnrst", k=pick.randrange(2, 9))) for _ in range(pick.randrange(30, 200))]
    if not good:
        words = [w + "###" for w in words] if pick.random() < 0.5 else [w for w in words[:9] for _ in range(12)]
    return (" ".join(words) + ".").encode()


def test_learns_from_positives_and_a_mixture():
    pick = random.Random(4)
    measured = lambda kinds: np.array([quality.features(text(k, pick)) for k in kinds])
    kinds = np.array([pick.random() < 0.7 for _ in range(1500)])
    model = quality.train(measured([True] * 700), measured(kinds), quality.Settings(epochs=30))
    assert abs(model.prior - kinds.mean()) < 0.12
    truth = np.array([pick.random() < 0.7 for _ in range(600)])
    assert ((quality.judged(model, measured(truth)) >= 0.5) == truth).mean() > 0.95


def test_prior_of_known_mixtures():
    random_ = np.random.default_rng(0)
    for share in (0.3, 0.6, 0.9):
        good = random_.normal(2, 1, 4000)
        mixed = np.where(random_.random(6000) < share, random_.normal(2, 1, 6000), random_.normal(-3, 1, 6000))
        assert abs(quality.estimated_prior(good, mixed) - share) < 0.06


def test_features_of_awkward_texts(texts):
    for t in texts:
        found = quality.features(None if t is None else t.encode())
        assert found.shape == (quality.FEATURES,) and np.isfinite(found).all()
    assert not quality.features(None).any() and not quality.features(b" ").any()


def test_score_keeps_all_rows(spark, documents):
    labels = spark.createDataFrame([(i, 1) for i in range(7)] + [(None, 1), (5, None)], "doc_id long, quality int")
    for given in (labels, labels.limit(0)):
        got = quality.score(documents, quality.fit(documents, given, quality.Settings(epochs=2))).collect()
        assert len(got) == 8 and all(0 <= r["score"] <= 1 for r in got)
    model = quality.fit(documents.limit(0), labels.limit(0))
    assert quality.score(documents.limit(0), model).count() == 0
