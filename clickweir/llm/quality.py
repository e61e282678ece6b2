"""Quality by positive-unlabelled learning.

Trusted documents are positives; any others are unlabelled, a mixture of good and bad. The share of
good ones in it (the class prior) is estimated from how a first classifier ranks both kinds: among
the best-ranked, positives and unlabelled thin out in proportion to that share. A small network is
then trained in numpy to minimise the non-negative unbiased risk: what unlabelled documents cost as
negatives, less what the good ones among them must have cost, which is held at or above zero.

Labels of bad documents are never used.
"""

from __future__ import annotations

import operator
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickweir.llm import common

_MARKS = b"!?.,;:|#$%&*/<>{}=_-\"'()"
FEATURES = 20 + len(_MARKS)


@dataclass(frozen=True)
class Settings:
    """``trusted`` and ``unlabelled`` bound the documents whose features are collected for training."""

    trusted: int = 6000
    unlabelled: int = 8000
    hidden: int = 24
    epochs: int = 60
    batch: int = 256
    rate: float = 3e-3
    decay: float = 1e-4
    seed: int = 5


@dataclass(frozen=True)
class Model:
    prior: float
    mean: np.ndarray
    scale: np.ndarray
    layers: list[np.ndarray]


def features(text: bytes | None) -> np.ndarray:
    """Measures of a whole text in UTF-8: how long, how varied and how repetitive its words, pairs of words
    and lines are, and its shares of kinds of characters. An empty text has zeros."""
    data, out = text or b"", np.zeros(FEATURES)
    words = data.split()
    if not words:
        return out
    n, size = len(words), len(data)
    counts = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    lines = [x for x in data.split(b"\n") if x.strip()]
    distinct = len(set(words))
    twice = sum(map(operator.eq, words, words[1:]))
    pairs = len(set(zip(words, words[1:])))
    lengths = np.fromiter(map(len, words), np.int64, n)
    marked = sum(not w[-1:].isalnum() and w[-1] < 128 for w in words) / n
    upper, lower = counts[65:91].sum(), counts[97:123].sum()
    out[:20] = (
        np.log1p(n), np.log1p(len(lines)), distinct / n, distinct / np.sqrt(n), twice / n, pairs / max(1, n - 1),
        len(set(lines)) / len(lines), lengths.mean(), lengths.std(), np.log1p(lengths.max()), (lengths > 25).mean(),
        upper / size, upper / max(1, upper + lower), counts[48:58].sum() / size, counts[128:].sum() / size,
        (counts[32] + counts[9:14].sum()) / size, marked, np.log1p(n / len(lines)),
        (lengths <= 2).mean(), np.log1p(twice))
    out[20:] = np.sqrt(counts[np.frombuffer(_MARKS, np.uint8)] / size)
    return out


# ---------------------------------------------------------------- training


def _started(sizes: list[int], random: np.random.Generator) -> list[np.ndarray]:
    layers = []
    for a, b in zip(sizes, sizes[1:]):
        layers += [random.normal(0, np.sqrt(1 / a), (a, b)), np.zeros(b)]
    return layers


def _forward(x: np.ndarray, layers: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    hidden = np.tanh(x @ layers[0] + layers[1])
    return (hidden @ layers[2] + layers[3])[:, 0], hidden


def _sigmoid(value: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(value, -30, 30)))


def _fit(good: np.ndarray, mixed: np.ndarray, prior: float | None, settings: Settings) -> list[np.ndarray]:
    """Adam steps. With a prior: the non-negative risk with the logistic loss; without: good against mixed
    alone, each half of the loss."""
    random = np.random.default_rng(settings.seed)
    layers = _started([good.shape[1], settings.hidden, 1], random)
    first, second, step = [np.zeros_like(v) for v in layers], [np.zeros_like(v) for v in layers], 0
    batches = max(1, len(mixed) // settings.batch)
    for _ in range(settings.epochs):
        g, m = random.permutation(len(good)), random.permutation(len(mixed))
        for part_g, part_m in zip(np.array_split(g, batches), np.array_split(m, batches)):
            if not len(part_g) or not len(part_m):
                continue
            x = np.concatenate([good[part_g], mixed[part_m]])
            value, hidden = _forward(x, layers)
            chance, k = _sigmoid(value), len(part_g)
            slope = np.zeros(len(x))
            if prior is None:
                slope[:k], slope[k:] = (chance[:k] - 1) / k, chance[k:] / (len(x) - k)
            else:
                bad_of_good = np.logaddexp(0, value[:k]).mean() * prior
                bad_of_mixed = np.logaddexp(0, value[k:]).mean()
                if bad_of_mixed - bad_of_good >= 0:
                    slope[:k] = prior * (chance[:k] - 1) / k - prior * chance[:k] / k
                    slope[k:] = chance[k:] / (len(x) - k)
                else:  # the estimate of the negatives' risk went below zero: undo, do not go on
                    slope[:k] = prior * chance[:k] / k
                    slope[k:] = -chance[k:] / (len(x) - k)
            back = (slope[:, None] @ layers[2].T) * (1 - hidden ** 2)
            grads = [x.T @ back, back.sum(0), hidden.T @ slope[:, None], np.array([slope.sum()])]
            step += 1
            for v, d, a, b in zip(layers, grads, first, second):
                d = d + settings.decay * v
                a += 0.1 * (d - a)
                b += 0.001 * (d * d - b)
                v -= settings.rate * (a / (1 - 0.9 ** step)) / (np.sqrt(b / (1 - 0.999 ** step)) + 1e-8)
    return layers


def estimated_prior(good: np.ndarray, mixed: np.ndarray) -> float:
    """Share of good ones in the mixture from the values that one classifier gives to both, on rows it has not
    seen: the least ratio of the parts above a limit, with an allowance for small counts."""
    limits = np.quantile(good, np.linspace(0.02, 0.9, 89))
    above_good = 1 - np.searchsorted(np.sort(good), limits, "left") / len(good)
    above_mixed = 1 - np.searchsorted(np.sort(mixed), limits, "left") / len(mixed)
    allowance = np.sqrt(np.log(40) / 2) * (1 / np.sqrt(len(good)) + 1 / np.sqrt(len(mixed)))
    best = int(np.argmin((above_mixed + allowance) / above_good))
    return float(np.clip(above_mixed[best] / above_good[best], 0.01, 0.99))


def train(good: np.ndarray, mixed: np.ndarray, settings: Settings = Settings()) -> Model:
    """On features of trusted and of unlabelled texts. Without either, a model that scores all alike."""
    if not len(good) or not len(mixed):
        return Model(0.5, np.zeros(FEATURES), np.ones(FEATURES), _started([FEATURES, settings.hidden, 1], np.random.default_rng(0))[:2] + [np.zeros((settings.hidden, 1)), np.zeros(1)])
    mean, scale = mixed.mean(0), mixed.std(0) + 1e-6
    good, mixed = np.clip((good - mean) / scale, -6, 6), np.clip((mixed - mean) / scale, -6, 6)
    prior = []
    for k in range(2):
        taught_g, taught_m = np.arange(len(good)) % 2 == k, np.arange(len(mixed)) % 2 == k
        if not taught_g.any() or taught_g.all() or not taught_m.any() or taught_m.all():
            prior.append(0.5)
            continue
        layers = _fit(good[taught_g], mixed[taught_m], None, settings)
        prior.append(estimated_prior(_forward(good[~taught_g], layers)[0], _forward(mixed[~taught_m], layers)[0]))
    share = float(np.mean(prior))
    return Model(share, mean, scale, _fit(good, mixed, share, settings))


def judged(model: Model, found: np.ndarray) -> np.ndarray:
    return _sigmoid(_forward(np.clip((found - model.mean) / model.scale, -6, 6), model.layers)[0])


# ---------------------------------------------------------------- on Spark


def _measured(text: Column) -> Column:
    @F.pandas_udf("array<double>")
    def measured(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([features(t) for t in texts.tolist()], dtype="object")

    return measured(text.cast("binary"))


def fit(docs: DataFrame, labels: DataFrame, settings: Settings = Settings(), column: str = "quality") -> Model:
    """Train on bounded samples: trusted documents are those labelled 1 outside the held-out fold
    (``crc32(doc_id as text) mod 4 = 2``), unlabelled ones are any, chosen by a hash of the id, whatever
    labels they have. Rows without an id teach nothing."""
    keep = common.fold("doc_id", 4) != 2
    trusted = common.labelled_sample(labels.where(F.col(column) > 0), column, keep, settings.trusted).select("doc_id", F.lit(1).alias("kind"))
    ids = docs.select("doc_id").where("doc_id IS NOT NULL").distinct()
    mixed = ids.orderBy(F.xxhash64(F.concat(F.lit("unlabelled"), F.col("doc_id").cast("string"))), "doc_id").limit(
        settings.unlabelled).select("doc_id", F.lit(0).alias("kind"))
    chosen = common.stored(trusted.union(mixed), "sample")
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # at most trusted + unlabelled ids
    sample = rows.select("doc_id", "kind", _measured(F.col("text")).alias("x")).toPandas()
    sample = sample.sort_values(["kind", "doc_id"]).sample(frac=1, random_state=settings.seed)
    parts = [np.array(sample.loc[sample["kind"] == k, "x"].tolist(), dtype=float).reshape(-1, FEATURES) for k in (1, 0)]
    return train(*parts, settings)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``score`` (0 to 1) in place of any column of that name; only ``text`` is an input. NULL
    texts are scored as empty ones; rows that repeat stay; an empty table gives an empty result."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            found = np.array([features(t) for t in texts.tolist()]).reshape(-1, FEATURES)
            yield pd.Series(judged(sent.value, found), dtype="float64")

    return docs.withColumn("score", scored(F.col("text").cast("binary")))
