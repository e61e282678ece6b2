import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from clickweir.llm import queries, runs
from clickweir.llm.common import table


def brute_force(words):
    """Every stretch that is long enough and cannot be extended, with its smallest period."""
    n, found = len(words), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            if i + q - start >= max(6, 4 * q):
                found.setdefault((start, i + q - start), q)  # a longer period of the same stretch is a multiple
    return sorted(((s, length, q) for (s, length), q in found.items()), key=lambda r: (r[0], r[2]))


def texts_of(pick):
    """Texts with runs of all kinds: nested, next to each other, with almost periodic roots."""
    letters = pick.choice(["a", "ab", "abc", "abcdefghij"])
    out = []
    while len(out) < pick.choice([3, 30, 200, 700]):
        root = pick.choices(letters, k=pick.choice([1, 1, 2, 3, 5, 8, 13, 21, 34]))
        if pick.random() < 0.4:
            root = root[:1] * pick.randint(1, 30) + root[-1:]
        if pick.random() < 0.2:
            root = root * pick.randint(2, 5) + root[:1]
        times = pick.choice([1, 2, 4, 4, 5, 9])
        out += root * times + root[: pick.randint(0, len(root))]
    return out


@pytest.mark.parametrize("seed", range(6))
def test_runs_equal_brute_force(seed):
    pick = random.Random(seed)
    texts = [texts_of(pick) for _ in range(60)] + [[], ["a"], ["a"] * 6, ["a"] * 5, list("ab") * 500]
    texts += [list(texts[0]), list(texts[1]) * 2]  # repeated texts do not disturb each other
    found = runs.find_all([[w.encode() for w in t] for t in texts])
    for t, got in zip(texts, found):
        assert [tuple(r) for r in got.tolist()] == brute_force(t)


def test_roots_that_nearly_repeat():
    """Blocks that have a short period themselves, in runs whose period is long."""
    for head in range(1, 40):
        for root in (["a"] * head + ["b"], ["a", "b"] * head + ["a"], ["a"] * head + ["b"] + ["a"] * (head // 2) + ["c"]):
            for times in (4, 5):
                for shift in range(0, 6):
                    text = list("xyzuvw"[:shift]) + root * times + root[: head // 3] + ["z"]
                    got = runs.find_all([[w.encode() for w in text]])[0]
                    assert [tuple(r) for r in got.tolist()] == brute_force(text), (root, times, shift)


def test_wavelet_tree():
    pick = np.random.default_rng(5)
    for n in (1, 2, 7, 64, 1000):
        values = pick.permutation(n)
        tree = runs.WaveletTree(values)
        low = pick.integers(0, n, 200)
        high = low + pick.integers(0, n - low + 1)
        bound = pick.integers(0, n + 1, 200)
        below = tree.below(low, high, bound)
        assert below.tolist() == [int((values[a:b] < x).sum()) for a, b, x in zip(low, high, bound)]
        some = np.flatnonzero(below < high - low)
        following = tree.nth(low[some], high[some], below[some])
        assert following.tolist() == [min(v for v in values[low[i]: high[i]].tolist() if v >= bound[i]) for i in some]


def test_suffix_array_and_extensions():
    pick = np.random.default_rng(6)
    text = np.unique(pick.integers(0, 3, 300), return_inverse=True)[1]
    ranks = runs.Ranks(text, len(text))
    suffixes = [text[i:].tolist() for i in range(len(text))]
    assert [suffixes[i] for i in ranks.suffixes] == sorted(suffixes)
    a, b = pick.integers(0, 300, (2, 500))
    a, b = a[a != b], b[a != b]

    def same(x, y):
        return next((i for i, (u, v) in enumerate(zip(x, y)) if u != v), min(len(x), len(y)))

    assert ranks.common(a, b).tolist() == [same(suffixes[i], suffixes[j]) for i, j in zip(a, b)]
    assert ranks.common_before(a, b).tolist() == [same(text[:i][::-1], text[:j][::-1]) for i, j in zip(a, b)]


def test_one_very_long_text():
    words = [b"a"] * 200_000 + [b"b"] + [b"c", b"d"] * 50_000
    assert runs.find_all([words])[0].tolist() == [[0, 200_000, 1], [200_001, 100_000, 2]]


def by_hand(doc_id, text):
    words = re.findall("[^\x20\x09-\x0d]+", text or "")
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[a + (i - a) % p] if i >= a else w for i, w in enumerate(words)]
    found = brute_force(words)
    out = {s + i for s, n, q in found for i in range(q, n)}
    top = min(found, key=lambda r: (-r[1], r[0], r[2]), default=None)
    return {
        "doc_id": doc_id, "n_runs": len(found), "start": top and top[0], "length": top and top[1], "period": top and top[2],
        "exponent_milli": top and 1000 * top[1] // top[2],
        "runs_sha256": hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in found).encode()).hexdigest(),
        "collapsed_sha256": hashlib.sha256(" ".join(w for i, w in enumerate(words) if i not in out).encode()).hexdigest(),
    }


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    got = {r["doc_id"]: r.asDict() for r in queries.op11_periodic_runs(spark, folder).collect()}
    texts = {r["doc_id"]: r["text"] for r in table(spark, folder, "documents").collect()}
    short = {i: t for i, t in texts.items() if len(t or "") < 20_000}
    assert set(got) == set(texts) and len(short) > 0.9 * len(texts)
    for i, text in short.items():
        assert got[i] == by_hand(i, text)
    assert sum(r["n_runs"] > 0 for r in got.values()) > 5


def test_awkward_rows(spark, documents):
    rows = runs.periodic_runs(documents).collect()
    assert len(rows) == documents.count() and sum(r["doc_id"] is None for r in rows) == 1
    long = next(r for r in rows if r["n_words"] == 12_000)
    assert [tuple(x) for x in long["runs"]] == [(0, 12_000, 3)] and long["collapsed"] == "a. b. c!"
    assert {r["n_words"] for r in rows if not r["runs"]} >= {0, 1}
    assert runs.digests(documents.limit(0)).count() == 0
    nulls = [r for r in runs.digests(documents).collect() if r["n_runs"] == 0]
    assert all(r["start"] is None and r["runs_sha256"] == hashlib.sha256(b"").hexdigest() for r in nulls)
