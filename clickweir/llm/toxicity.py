"""Toxicity by subword bags: the embeddings of all character n-grams of a short window of words are
averaged and go into a linear softmax; embeddings and softmax are trained together in numpy.

A document is toxic if some part of it is, so labels of documents are turned into labels of windows
in rounds: in the first, every window of a toxic document counts as toxic; later only those that the
last model finds toxic, and the likeliest one of each document. A document's score comes from its
likeliest windows, by a logistic curve fitted on labelled documents that training has not seen.

With two classes the softmax of an average is the average of one number per n-gram. Scoring
therefore carries one float per n-gram bucket (a table of fixed size) instead of the embeddings.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickweir.llm import common

_SIZES = (3, 4, 5)
_EDGES = ".,;:!?\"'()[]{}<>|*#$%&"
_TOP = 3
_LEAST = -12.0
_PART = 1 << 13  # words whose n-grams are made at a time


@dataclass(frozen=True)
class Settings:
    """``per_class`` bounds the labelled documents that are collected for training, and
    ``sample_words`` the words taken from each (evenly spread windows). Scoring has no such bounds."""

    per_class: int = 1600
    sample_words: int = 1600
    window: int = 4
    buckets: int = 1 << 17
    width: int = 12
    rounds: int = 5
    epochs: int = 3
    rate: float = 0.2
    batch: int = 512
    cache_words: int = 400_000
    seed: int = 7


@dataclass(frozen=True)
class Model:
    """``weights``: what a bucket adds to the log odds; ``curve``: intercept and slopes for the
    likeliest window, the mean of the likeliest three and the logarithm of the window count."""

    weights: np.ndarray
    bias: float
    curve: np.ndarray
    window: int


def words_of(text: str | None) -> list[str]:
    return (text or "").lower().split()


def subwords(words: list[str], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket ids of the n-grams of each word, edges marked, and of the word itself; and where each
    word's ids begin (one more entry than words)."""
    bare = [w.strip(_EDGES) or w for w in words]
    marked = "".join(f"\x02{w}\x03" for w in bare)
    points = np.frombuffer(marked.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    lengths = np.fromiter((len(w) + 2 for w in bare), np.int64, len(bare))
    owner = np.repeat(np.arange(len(bare)), lengths)
    ids = [np.fromiter((zlib.crc32(w.encode("utf-8", "surrogatepass")) for w in bare), np.uint32, len(bare))]
    owners = [np.arange(len(bare))]
    for size in _SIZES:
        if len(points) < size:
            break
        whole = owner[: len(points) - size + 1] == owner[size - 1:]
        code = np.full(len(whole), size, dtype=np.uint32)
        for at in range(size):
            code = (code ^ points[at: at + len(whole)]) * np.uint32(16777619)
        ids.append(code[whole])
        owners.append(owner[: len(whole)][whole])
    flat, owned = np.concatenate(ids), np.concatenate(owners)
    flat = (flat ^ (flat >> np.uint32(15))) % np.uint32(buckets)
    order = np.argsort(owned, kind="stable")
    starts = np.concatenate([[0], np.cumsum(np.bincount(owned, minlength=len(bare)))])
    return flat[order].astype(np.int64), starts


# ---------------------------------------------------------------- training


class _Bags:
    """Windows as stretches of one array of word numbers, and the n-gram ids of each distinct word."""

    def __init__(self, texts: list[str], settings: Settings):
        number: dict[str, int] = {}
        words, sizes, owners = [], [], []
        for doc, text in enumerate(texts):
            found = words_of(text)
            step = max(1, -(-len(found) // settings.sample_words))
            starts = np.arange(0, len(found), settings.window)[::step]
            kept = [w for at in starts.tolist() for w in found[at: at + settings.window]]
            words.append(np.fromiter((number.setdefault(w, len(number)) for w in kept), np.int32, len(kept)))
            sizes.append(np.minimum(settings.window, len(found) - starts))
            owners.append(np.full(len(starts), doc))
        join = lambda parts, kind: np.concatenate(parts).astype(kind) if parts else np.zeros(0, kind)
        self.words, self.sizes, self.owner = join(words, np.int32), join(sizes, np.int64), join(owners, np.int64)
        self.cuts = np.cumsum(self.sizes) - self.sizes
        # A part of the distinct words at a time: the n-grams of all at once would take ten times what is kept of them.
        distinct, kept_ids, counts = list(number), [], []
        for at in range(0, len(distinct), _PART):
            ids, starts = subwords(distinct[at: at + _PART], settings.buckets)
            kept_ids.append(ids.astype(np.int32))
            counts.append(np.diff(starts))
        self.ids = join(kept_ids, np.int32)
        self.starts = np.concatenate([[0], np.cumsum(join(counts, np.int64))])

    def expand(self, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """N-gram ids of the chosen windows in a row, and how many each window has."""
        sizes = self.sizes[chosen]
        words = self.words[_stretches(self.cuts[chosen], sizes)]
        count = self.starts[words + 1] - self.starts[words]
        return self.ids[_stretches(self.starts[words], count)], np.add.reduceat(count, np.cumsum(sizes) - sizes)


def _stretches(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The numbers ``first .. first + count - 1`` of all stretches in a row."""
    ends = np.cumsum(count)
    return np.arange(ends[-1]) - np.repeat(ends - count, count) + np.repeat(first, count)


def _log_odds(bags: _Bags, weights: np.ndarray, bias: float) -> np.ndarray:
    """Of every window."""
    total = np.add.reduceat(weights[bags.ids], bags.starts[:-1])
    count = np.diff(bags.starts)
    return np.add.reduceat(total[bags.words], bags.cuts) / np.add.reduceat(count[bags.words], bags.cuts) + bias


class _Trainer:
    """Embeddings, softmax layer and their squared-gradient sums (Adagrad)."""

    def __init__(self, settings: Settings):
        self.random = np.random.default_rng(settings.seed)
        self.settings = settings
        self.embed = self.random.normal(0, 0.1, (settings.buckets, settings.width)).astype(np.float32)
        self.layer = self.random.normal(0, 0.1, (settings.width, 2)).astype(np.float32)
        self.bias = np.zeros(2, np.float32)
        self.sums = [np.full(x.shape, 1e-6, np.float32) for x in (self.embed, self.layer, self.bias)]

    def step(self, ids: np.ndarray, sizes: np.ndarray, label: np.ndarray, weight: np.ndarray) -> None:
        cuts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        mean = np.add.reduceat(self.embed[ids], cuts) / sizes[:, None]
        out = mean @ self.layer + self.bias
        out = np.exp(out - out.max(1, keepdims=True))
        out /= out.sum(1, keepdims=True)
        out[np.arange(len(label)), label] -= 1
        out *= (weight / weight.sum())[:, None]
        back = np.repeat((out @ self.layer.T) / sizes[:, None], sizes, axis=0)
        seen, place = np.unique(ids, return_inverse=True)
        grad = np.stack([np.bincount(place, back[:, k], len(seen)) for k in range(back.shape[1])], 1)
        scale = float(len(label))  # per-example steps for the embeddings, as each n-gram is rare in a batch
        grad = (grad * scale).astype(np.float32)
        self.sums[0][seen] += grad * grad
        self.embed[seen] -= self.settings.rate * grad / np.sqrt(self.sums[0][seen])
        for value, total, g in ((self.layer, self.sums[1], mean.T @ out), (self.bias, self.sums[2], out.sum(0))):
            total += g * g
            value -= 0.1 * g / np.sqrt(total)

    def run(self, bags: _Bags, chosen: np.ndarray, label: np.ndarray) -> None:
        weight = np.where(label == 1, 0.5 / max(1, (label == 1).sum()), 0.5 / max(1, (label == 0).sum()))
        for _ in range(self.settings.epochs):
            order = self.random.permutation(len(chosen))
            for i in range(0, len(order), self.settings.batch):
                part = order[i: i + self.settings.batch]
                self.step(*bags.expand(chosen[part]), label[part], weight[part])

    def collapsed(self) -> tuple[np.ndarray, float]:
        return self.embed @ (self.layer[:, 1] - self.layer[:, 0]), float(self.bias[1] - self.bias[0])


def _summary(odds: np.ndarray) -> tuple[float, float, float]:
    """What the curve sees of a document's windows."""
    if not len(odds):
        return _LEAST, _LEAST, 0.0
    best = np.sort(np.partition(odds, -_TOP)[-_TOP:] if len(odds) > _TOP else odds)[::-1]
    return float(max(best[0], _LEAST)), float(max(best.mean(), _LEAST)), float(np.log1p(len(odds)))


def _logistic(x: np.ndarray, label: np.ndarray, weight: np.ndarray, ridge: float = 1e-3) -> np.ndarray:
    """Newton steps of a weighted, slightly shrunk logistic regression; the intercept comes first."""
    design, value = np.column_stack([np.ones(len(x)), x]), np.zeros(x.shape[1] + 1)
    for _ in range(40):
        chance = 1 / (1 + np.exp(-np.clip(design @ value, -30, 30)))
        slope = design.T @ (weight * (label - chance)) - ridge * weight.sum() * value
        curve = (design * (weight * chance * (1 - chance))[:, None]).T @ design
        value = value + np.linalg.solve(curve + np.eye(len(value)) * ridge * weight.sum(), slope)
    return value


def train(texts: list[str], label: np.ndarray, share: float, settings: Settings = Settings()) -> Model:
    """Fit on texts with 0/1 labels, of which ``share`` are 1 where the model is to be used. Every
    fifth text is kept for the curve. Without texts of both classes the model says ``share`` to all."""
    label = np.asarray(label, dtype=np.int64)
    flat = Model(np.zeros(settings.buckets, np.float32), 0.0, np.array([np.log((share + 1e-3) / (1 - share + 1e-3)), 0, 0, 0]), settings.window)
    bags = _Bags(texts, settings)
    if not len(bags.sizes) or len(set(label.tolist())) < 2:
        return flat
    apart = np.arange(len(texts)) % 5 == 4
    if len(set(label[~apart].tolist())) < 2 or len(set(label[apart].tolist())) < 2:
        apart = np.zeros(len(texts), dtype=bool)
    trainer, random = _Trainer(settings), np.random.default_rng(settings.seed)
    of = label[bags.owner]
    mine = np.flatnonzero(~apart[bags.owner])
    toxic, clean = mine[of[mine] == 1], mine[of[mine] == 0]
    if not len(toxic) or not len(clean):
        return flat
    most = 6 * settings.per_class
    for round_ in range(settings.rounds):
        if round_ == 0:
            good = random.permutation(toxic)[:most]
            bad = random.permutation(clean)[:most]
        else:
            odds = _log_odds(bags, *trainer.collapsed())
            order = toxic[np.lexsort((-odds[toxic], bags.owner[toxic]))]
            best = np.r_[True, bags.owner[order][1:] != bags.owner[order][:-1]]
            good = random.permutation(order[best | (odds[order] > 0)])[:2 * most]
            hard = clean[np.argsort(-odds[clean], kind="stable")[: most // 2]]
            bad = np.concatenate([hard, random.permutation(clean)[:most]])
        chosen = np.concatenate([good, bad])
        trainer.run(bags, chosen, np.r_[np.ones(len(good), np.int64), np.zeros(len(bad), np.int64)])
    weights, bias = trainer.collapsed()
    odds = _log_odds(bags, weights, bias)
    judged = apart if apart.any() else ~apart
    by = np.argsort(bags.owner, kind="stable")
    cuts = np.searchsorted(bags.owner[by], np.arange(len(texts) + 1))
    x = np.array([_summary(odds[by[cuts[i]: cuts[i + 1]]]) for i in np.flatnonzero(judged)])
    y = label[judged]
    weight = np.where(y == 1, share / max(1, y.sum()), (1 - share) / max(1, (1 - y).sum())) * len(y)
    return Model(weights.astype(np.float32), bias, _logistic(x, y, weight), settings.window)


# ---------------------------------------------------------------- scoring


class Scorer:
    """Scores texts; keeps what it knows of words, up to a bound, from one batch to the next."""

    def __init__(self, model: Model, cache_words: int):
        self.model, self.most = model, cache_words
        self.clear()

    def clear(self) -> None:
        self.number: dict[str, int] = {}
        self.total, self.count = np.zeros(0, np.float64), np.zeros(0, np.int64)

    def learn(self, words: set[str]) -> None:
        fresh = [w for w in words if w not in self.number]
        if not fresh:
            return
        ids, starts = subwords(fresh, len(self.model.weights))
        self.number.update(zip(fresh, range(len(self.total), len(self.total) + len(fresh))))
        self.total = np.concatenate([self.total, np.add.reduceat(self.model.weights[ids].astype(np.float64), starts[:-1])])
        self.count = np.concatenate([self.count, np.diff(starts)])

    def one(self, words: list[str]) -> float:
        odds = np.zeros(0)
        if words:
            coded = np.fromiter(map(self.number.__getitem__, words), np.int64, len(words))
            cuts = np.arange(0, len(words), self.model.window)
            odds = np.add.reduceat(self.total[coded], cuts) / np.add.reduceat(self.count[coded], cuts) + self.model.bias
        value = self.model.curve[0] + np.dot(self.model.curve[1:], _summary(odds))
        return float(1 / (1 + np.exp(-np.clip(value, -30, 30))))

    def scores(self, texts: list[str | None]) -> list[float]:
        out = []
        for i in range(0, len(texts), 200):
            split = [words_of(t) for t in texts[i: i + 200]]
            if len(self.number) > self.most:
                self.clear()
            self.learn(set().union(*split))
            out += [self.one(words) for words in split]
        return out


def fit(docs: DataFrame, labels: DataFrame, settings: Settings = Settings(), column: str = "toxic") -> Model:
    """Train on a bounded sample of the labelled documents outside the held-out fold
    (``crc32(doc_id as text) mod 5 = 0``). Documents without label, text or id teach nothing."""
    learnable = common.fold("doc_id", 5) != 0
    chosen = common.labelled_sample(labels, column, learnable, settings.per_class)
    rows = (
        docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # at most 2 * per_class ids
        .groupBy("doc_id").agg(F.max("label").alias("label"), F.max("text").alias("text"))
        .toPandas().sort_values("doc_id")
    )
    share = (
        labels.where(learnable & F.col(column).isNotNull())
        .agg(F.avg((F.col(column) > 0).cast("double")).alias("share")).first()["share"]
    )
    order = np.random.default_rng(settings.seed).permutation(len(rows))
    texts, label = rows["text"].fillna("").tolist(), rows["label"].to_numpy()
    return train([texts[i] for i in order], label[order] if len(rows) else np.zeros(0), 0.0 if share is None else share, settings)


def score(docs: DataFrame, model: Model, settings: Settings = Settings()) -> DataFrame:
    """``docs`` with ``score`` (0 to 1) in place of any column of that name; only ``text`` is an input.
    NULL and empty texts get the score of a document without windows. Rows are neither lost nor merged,
    so repeated rows and ids stay. An empty table gives an empty result."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = Scorer(sent.value, settings.cache_words)
        for texts in batches:
            yield pd.Series(scorer.scores(texts.tolist()), dtype="float64")

    return docs.withColumn("score", scored(F.col("text")))
