import random
import re

import numpy as np
import pytest

import corpus_pipeline
from clickweir.llm import overlap, simhash


def by_hand(text):
    words = re.findall("[^\x20\x09-\x0d]+", (text or "").lower())
    return {" ".join(words[i: i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute_force(rows):
    """Least ids of the classes that pairs of Jaccard similarity 0.8 or more join."""
    sets, parent = [by_hand(t) for _, t in rows], list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a == b or 10 * len(a & b) >= 8 * len(a | b):
                parent[root(i)] = root(j)
    return sorted({min(rows[j][0] for j in range(len(rows)) if root(j) == root(i)) for i in range(len(rows))})


@pytest.fixture(scope="module")
def corpus():
    """Edited copies at all distances, a line that most texts have, a large group of near copies, short texts."""
    pick, words = random.Random(4), [f"w{i}" for i in range(4000)]
    line = " ".join(pick.choices(words, k=30))
    texts = []
    for _ in range(40):
        own = pick.choices(words, k=pick.randint(3, 400))
        for edits in (0, 1, 2, 3, 5, 8, 12):
            changed = list(own)
            for at in pick.sample(range(len(own)), min(edits, len(own))):
                changed[at] = pick.choice(words)
            texts.append(" ".join(changed) + (f"\n{line}" if pick.random() < 0.7 else ""))
    base = pick.choices(words, k=200)
    for _ in range(120):
        changed = list(base)
        for at in pick.sample(range(200), pick.randint(1, 8)):
            changed[at] = pick.choice(words)
        texts.append(" ".join(changed))
    texts += ["", None, " ", "one two", "One  two", line, line]
    pick.shuffle(texts)
    return [(i, t) for i, t in enumerate(texts)]


@pytest.mark.parametrize("stars,small", [(0, 64), (0, 5), (4, 64), (1, 5)])
def test_stage_equals_brute_force(spark, corpus, monkeypatch, stars, small):
    """Without pivots and with some; in small tiles too."""
    monkeypatch.setattr(overlap, "_STARS", stars)
    monkeypatch.setattr(overlap, "_SMALL", small)
    docs = spark.createDataFrame(corpus, "doc_id long, text string").repartition(3)
    got = sorted(r["doc_id"] for r in corpus_pipeline.near_duplicate_stage(spark, docs, "").collect())
    assert got == brute_force(corpus)


def test_similar_sets_share_a_first_shingle():
    pick = np.random.default_rng(3)
    for n in [*range(1, 30), 200]:
        a = np.unique(pick.integers(0, 1 << 63, n, dtype=np.uint64))
        for kept in range(n + 1):
            b = np.unique(np.concatenate([a[pick.permutation(n)[:kept]], pick.integers(0, 1 << 63, pick.integers(0, 5), dtype=np.uint64)]))
            ranks = pick.integers(0, 5, 1 << 6).astype(np.uint8)
            if 10 * len(np.intersect1d(a, b)) >= 8 * len(np.union1d(a, b)):
                assert len(np.intersect1d(overlap.prefix(a, ranks), overlap.prefix(b, ranks)))


def test_frequencies_count_all_documents(spark):
    """Ranks by a table of few cells equal those counted by hand, hashes of all bits fall on its cells, no rows give no ranks."""
    texts = [" ".join(f"w{i % k}" for i in range(40)) for k in range(1, 30)] + ["", None, "a b"]
    docs = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    counts = np.zeros(16)
    for t in texts:
        for h in overlap.shingle_set(t.encode() if t else None):
            counts[int(h) >> 60] += 1
    assert overlap.frequencies(docs, 16).tolist() == np.round(8 * np.log2(1 + counts)).tolist()
    assert not overlap.frequencies(docs.limit(0), 16).any()


def test_sketches_never_reject_similar_sets():
    pick = np.random.default_rng(4)
    for n in [1, 2, 5, 40, 300, 1020, 3000]:
        a = np.unique(pick.integers(0, 1 << 63, n, dtype=np.uint64))
        for share in (0, 0.02, 0.05, 0.1, 0.11, 0.2):
            b = np.unique(np.concatenate([a[int(share * n):], pick.integers(0, 1 << 63, int(share * n), dtype=np.uint64)]))
            mine, other = overlap.sketch(a), overlap.sketch(b)
            words = min(len(mine), len(other))
            apart = int(np.bitwise_count((overlap.folded(mine, words) ^ overlap.folded(other, words)).view(np.uint64)).sum())
            assert apart <= len(np.setxor1d(a, b))
            if 10 * len(np.intersect1d(a, b)) >= 8 * len(np.union1d(a, b)):
                assert 9 * apart <= len(a) + len(b)


def test_simhash_names_pairs_of_the_stage(spark, corpus, monkeypatch):
    """The stage compares what op6's bands and tiles link, in classes as by hand: no set is left out that is linked."""
    asked, real = [], overlap.nominated

    def noted(distinct):
        out = real(distinct)
        asked.append(({r["fp"]: r["print"] % (1 << 64) for r in distinct.collect()}, [(r["a"], r["b"]) for r in out.collect()]))
        return out

    monkeypatch.setattr(overlap, "nominated", noted)
    docs = spark.createDataFrame(corpus, "doc_id long, text string").repartition(3)
    got = sorted(r["doc_id"] for r in corpus_pipeline.near_duplicate_stage(spark, docs, "").collect())
    assert got == brute_force(corpus)
    (prints, pairs), = asked
    assert prints and pairs and all(a < b for a, b in pairs)
    fps = sorted(prints)

    def classes(edges):
        root = {x: x for x in fps}
        for a, b in edges:
            low, high = sorted((root[a], root[b]))
            root = {x: low if r == high else r for x, r in root.items()}
        return root

    near = [(a, b) for i, a in enumerate(fps) for b in fps[i + 1:] if (prints[a] ^ prints[b]).bit_count() <= 4]
    assert classes(pairs) == classes(near)
    texts = {simhash.fingerprint((t or "").encode(), overlap.SIZE) for _, t in corpus}
    assert set(prints.values()) <= texts


def test_one_shingle_in_all_documents(spark):
    """Unlike documents that all begin with the same words, and a few near copies among them."""
    pick = random.Random(9)
    rows = [(i, "one and the same line " + " ".join(f"w{pick.randrange(10**6)}" for _ in range(3))) for i in range(300)]
    rows += [(1000 + i, t + " more") for i, t in rows[:20]] + [(2000, rows[0][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted(r["doc_id"] for r in overlap.representatives(docs).collect())
    assert got == brute_force(rows)


def test_long_texts_of_either_side_of_a_fold(spark):
    """Sketches of 1024 and 2048 bits meet."""
    pick = random.Random(10)
    words = [f"w{i}" for i in range(5000)]
    base = pick.choices(words, k=1000)
    rows = [(0, " ".join(base)), (1, " ".join(base + pick.choices(words, k=60))), (2, " ".join(base[:900] + pick.choices(words, k=400))),
            (3, " ".join(base + pick.choices(words, k=240)))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(r["doc_id"] for r in overlap.representatives(docs).collect()) == brute_force(rows)


def test_ids_that_are_null_repeated_or_extreme(spark):
    """NULL ids come last, equal rows stay once, rows of one id with other texts stay, and no difference of ids overflows."""
    low, high = -(1 << 63), (1 << 63) - 1
    a, b, c, d = (" ".join(f"{x}{i}" for i in range(20)) for x in "abcd")
    rows = [(None, a), (5, a), (low, b), (high, b), (None, c), (None, c), (7, d), (7, d), (7, a + b), (high, c + d)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted(((r["doc_id"], r["text"]) for r in overlap.representatives(docs).collect()), key=str)
    assert got == sorted([(5, a), (low, b), (None, c), (7, d), (7, a + b), (high, c + d)], key=str)


@pytest.mark.parametrize("tile,hashes", [(1024, (1 << 16, 1 << 20)), (7, (200, 3000))])
def test_large_groups_of_near_copies_list_no_square_of_pairs(spark, corpus, monkeypatch, tile, hashes):
    """Edited copies of one text, most pairs of them a little too far apart: what comes out of the groups is at most a pair for each row
    of a unit, and what comes out of the parts joins the classes by hand; in one tile and in many."""
    monkeypatch.setattr(overlap, "_TILE", tile, raising=False)
    monkeypatch.setattr(overlap, "_HASHES", hashes, raising=False)
    monkeypatch.setattr(overlap, "_STARS", 0)
    made = {}

    def noted(name, real):
        def run(rows):
            out = real(rows)
            made[name] = rows.count(), out.collect()
            return out
        return run

    monkeypatch.setattr(overlap, "_tiled", noted("groups", overlap._tiled))
    monkeypatch.setattr(overlap, "_compared", noted("parts", getattr(overlap, "_compared", None)), raising=False)
    pick, words = random.Random(6), [f"w{i}" for i in range(9000)]
    base = pick.choices(words, k=400)
    rows = []
    for i in range(130):
        changed = list(base)
        for at in pick.sample(range(400), pick.randint(4, 7)):
            changed[at] = pick.choice(words)
        rows.append((i, " ".join(changed)))
    rows += [(1000 + i, t) for i, t in corpus]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted(r["doc_id"] for r in overlap.representatives(docs).collect())
    assert got == brute_force(rows)
    asked, pairs = made["groups"]
    tiles = -(-len(rows) // tile)
    assert pairs and len(pairs) < asked * tiles
    asked, pairs = made["parts"]
    assert pairs and len(pairs) < asked * tiles
