"""Language of web pages by Bayesian evidence fusion.

The evidence of a page is its text (letter triples, with counts per language from labelled documents),
the language its markup declares, the suffix of its host name and the language segment of its path.
The prior is that of its host, smoothed towards its domain and that towards all pages. What values
the markup, suffix and segment have in each language, and how languages are spread over hosts, is
counted over all pages in grouped aggregations, each page weighing as its text says. A page's own
share is taken out of the prior it gets.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickweir.llm import common


@dataclass(frozen=True)
class Settings:
    """``buckets``: letter triples are hashed into so many counts. ``full``: triples are not independent, so
    the likelihood of a long text counts as that of at most so many. ``pull``: pages that the wider prior
    is worth. ``soft``: added to each count of a declared value."""

    buckets: int = 1 << 15
    full: float = 60.0
    pull: float = 5.0
    soft: float = 0.5


@dataclass(frozen=True)
class Model:
    """``logs``: logarithm of the probability of each bucket, a row per language."""

    languages: list[str]
    logs: np.ndarray


def triples(text: str | None, buckets: int) -> np.ndarray:
    """Buckets of the letter triples of a text in lower case; anything that is no letter is a space."""
    points = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    letter = (points >= 97) & (points <= 122) | (points >= 0xC0) & (points != 0xD7) & (points != 0xF7)
    points = np.where(letter, points, np.uint32(32))
    if len(points) < 3:
        return np.zeros(0, np.int64)
    code = (points[:-2] * np.uint32(31) + points[1:-1]) * np.uint32(1009) + points[2:]
    code = code * np.uint32(2654435761)
    return (code >> np.uint32(32 - buckets.bit_length() + 1)).astype(np.int64)[(points[1:-1] != 32) | (points[2:] != 32)]


def fit(docs: DataFrame, settings: Settings = Settings()) -> Model:
    """Counts over all documents with a ``lang``. Each task adds up its own texts first and sends at most
    ``buckets`` numbers per language; what is collected has as many, whatever the input."""

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch["lang"].tolist(), batch["text"].tolist()):
                total = totals.setdefault(lang, np.zeros(settings.buckets, np.int64))
                total += np.bincount(triples(text, settings.buckets), minlength=settings.buckets)
        for lang, total in totals.items():
            seen = np.flatnonzero(total)
            yield pd.DataFrame({"lang": lang, "bucket": seen, "n": total[seen]})

    rows = docs.where("lang IS NOT NULL").select("lang", "text").mapInPandas(counted, "lang string, bucket long, n long")
    summed = rows.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    languages = sorted(summed["lang"].unique().tolist())
    counts = np.zeros((len(languages), settings.buckets))
    place = {lang: i for i, lang in enumerate(languages)}
    counts[summed["lang"].map(place).to_numpy(dtype=int), summed["bucket"].to_numpy(dtype=int)] = summed["n"].to_numpy()
    counts += 0.1
    return Model(languages, np.log(counts / counts.sum(1, keepdims=True)).astype(np.float32))


def visible(html: Column) -> Column:
    """Text of a page without scripts, styles, comments and tags."""
    bare = F.regexp_replace(html, r"(?is)<script\b.*?</script\s*>|<style\b.*?</style\s*>|<!--.*?-->|<[^>]*>", " ")
    return F.regexp_replace(bare, r"&#?\w{1,8};", " ")


def address(url: Column) -> dict[str, Column]:
    """Host, domain (its last two labels), suffix (its last) and the language segment a path begins with."""
    host = F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][\w+.-]*://(?:[^/?#@]*@)?([^/:?#]*)", 1))
    return {
        "host": host, "domain": F.substring_index(host, ".", -2), "suffix": F.substring_index(host, ".", -1),
        "segment": F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[^?#]*?://[^/]*/([A-Za-z]{2})(?:[/-]|$)", 1)),
    }


def declared(html: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(html, F.lit("")), r"(?i)<html\b[^>]*?\blang\s*=\s*[\"']?([A-Za-z]{2,3})", 1))


def likelihoods(text: Column, sent, settings: Settings) -> Column:
    @F.pandas_udf("array<double>")
    def likely(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        logs = sent.value.logs
        for texts in batches:
            out = []
            for text in texts.tolist():
                found = triples(text, settings.buckets)
                n = len(found)
                out.append((logs[:, found].sum(1, dtype=np.float64) / n * min(n, settings.full)).tolist() if n else [0.0] * len(logs))
            yield pd.Series(out, dtype="object")

    return likely(text)


def _normal(logs: Column) -> Column:
    """Probabilities from logarithms that lack a common factor."""
    most = F.array_max(logs)
    raw = F.transform(logs, lambda x: F.exp(x - most))
    total = F.aggregate(raw, F.lit(0.0), lambda a, x: a + x)
    return F.transform(raw, lambda x: x / total)


def _sums(count: int, name: str, weight: str) -> list[Column]:
    return [F.array(*[F.sum(F.col(name)[i]) for i in range(count)]).alias(weight)]


def identify(pages: DataFrame, model: Model, settings: Settings = Settings()) -> DataFrame:
    """One row per row of ``pages``: ``page_id, lang, probability, text_lang, declared, host``. A page without
    text is judged by the other evidence, one without any by the prior; NULL html and url are empty.
    Ties go to the language that comes first. Without languages or pages there are no rows with a
    language, or none at all."""
    count = len(model.languages)
    parts = address(F.col("url"))
    if not count:
        nothing = F.lit(None).cast("string")
        return pages.select("page_id", nothing.alias("lang"), F.lit(0.0).alias("probability"), nothing.alias("text_lang"),
                            declared(F.col("html")).alias("declared"), parts["host"].alias("host"))
    sent = pages.sparkSession.sparkContext.broadcast(model)  # a fixed number of buckets per language
    seen = pages.select(
        "page_id", *[c.alias(n) for n, c in parts.items()], declared(F.col("html")).alias("declared"),
        likelihoods(visible(F.coalesce(F.col("html"), F.lit(""))), sent, settings).alias("logs"))
    seen = common.stored(seen.withColumn("weights", _normal(F.col("logs"))), "page-evidence")
    sums = _sums(count, "weights", "sums")
    total = seen.groupBy().agg(*sums, F.count("*").alias("n")).select(
        F.transform(F.coalesce("sums", F.array_repeat(F.lit(0.0), count)), lambda x: (x + 1) / (F.col("n") + count)).alias("overall"),
        F.coalesce("sums", F.array_repeat(F.lit(0.0), count)).alias("all_sums"))
    total = common.stored(total, "overall")
    # Hosts with the sums of their domains: one row per host.
    hosts = seen.groupBy("host", "domain").agg(*sums, F.count("*").alias("n"))
    hosts = common.stored(hosts, "hosts")
    domains = hosts.groupBy("domain").agg(*_sums(count, "sums", "domain_sums"), F.sum("n").alias("domain_n"))
    hosts = common.stored(hosts.join(domains, "domain").select("host", "sums", "n", "domain_sums", "domain_n"), "host-priors")
    rows = seen.join(hosts, "host").join(F.broadcast(total))  # ``total`` is one row
    for name in ("declared", "suffix", "segment"):
        kinds = seen.groupBy(name).agg(*_sums(count, "weights", f"{name}_sums"))
        kinds = kinds.withColumn(f"{name}_kinds", F.lit(1))
        number = kinds.groupBy().agg(F.count("*").alias(f"{name}_number"))
        kinds = common.stored(kinds.join(F.broadcast(number)).drop(f"{name}_kinds"), f"kinds-{name}")
        rows = rows.join(kinds, name)
    pull, soft = settings.pull, settings.soft

    def fused(x: Column, i: Column) -> Column:
        at = lambda c: F.get(F.col(c), i)
        own = at("weights")
        domain = (at("domain_sums") - own + pull * at("overall")) / (F.col("domain_n") - 1 + pull)
        host = (at("sums") - own + pull * domain) / (F.col("n") - 1 + pull)
        value = x + F.log(F.greatest(host, F.lit(1e-12)))
        for name in ("declared", "suffix", "segment"):
            share = (at(f"{name}_sums") - own + soft) / (at("all_sums") - own + soft * F.col(f"{name}_number"))
            value = value + F.log(F.greatest(share, F.lit(1e-12)))
        return value

    rows = rows.withColumn("fused", _normal(F.transform("logs", fused)))
    names = F.array(*[F.lit(x) for x in model.languages])
    best = lambda c: F.get(names, F.array_position(F.col(c), F.array_max(c)).cast("int") - 1)
    return rows.select("page_id", best("fused").alias("lang"), F.array_max("fused").alias("probability"),
                       best("weights").alias("text_lang"), "declared", "host")
