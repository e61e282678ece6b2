import random
import re

import numpy as np
import pytest
import xxhash

from clickweir.llm import simhash


def by_hand(text, size=4):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall("[^\x20\x09-\x0d]+", lower)
    if not words:
        return 0
    shingles = [" ".join(words[i: i + size]) for i in range(max(1, len(words) - size + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(values, radius):
    left, out = set(range(len(values))), [None] * len(values)
    while left:
        todo = [min(left)]
        left.remove(todo[0])
        for i in todo:
            near = [j for j in left if (values[i] ^ values[j]).bit_count() <= radius]
            todo += near
            left -= set(near)
        for i in todo:
            out[i] = todo[0]
    return out


def test_fingerprints(texts):
    pick = random.Random(1)
    more = [" ".join(pick.choices(["Aa", "É", "b\x0bc", "\x1fq", "x y", "zz."], k=n)) for n in range(40)]
    for t in [*texts, *more]:
        assert simhash.fingerprint(None if t is None else t.encode()) == by_hand(t)


def clouds(seed, centres, each, chain=0):
    pick, values = random.Random(seed), []
    for _ in range(centres):
        c = pick.getrandbits(64)
        values += [c ^ sum(1 << b for b in pick.sample(range(64), pick.randrange(0, 7))) for _ in range(each)]
    c = pick.getrandbits(64)
    for _ in range(chain):
        c ^= sum(1 << b for b in pick.sample(range(64), 4))
        values.append(c)
    return sorted(set(values))


@pytest.mark.parametrize("bands,tile", [(5, 2048), (6, 2048), (6, 16), (7, 8)])
def test_links_lose_nothing(spark, bands, tile):
    values = clouds(bands * tile, 30, 12, chain=25) + [0, (1 << 64) - 1, 1]
    signed = [simhash._signed(v) for v in values]
    frame = spark.createDataFrame([(v,) for v in signed], "fp long").repartition(4)
    edges = simhash.links(frame, 4, bands, tile)
    roots = {r["node"]: r["root"] for r in simhash.classes(edges).collect()}
    got = [roots.get(v, v) for v in signed]
    want = components(values, 4)
    assert len(set(zip(got, want))) == len(set(got)) == len(set(want))


def test_tiles_equal_all_pairs():
    values = np.array(clouds(5, 20, 20), dtype=np.uint64)
    a, b = simhash.tile_links(values, None, 4)
    assert (b < a).all()
    half = len(values) // 2
    for left, right in ((values, None), (values[:half], values[half:])):
        a, b = simhash.tile_links(left, right, 4)
        linked = {(int(x), int(y)) for x, y in zip(a, b)}
        pool = values if right is None else np.concatenate([left, right])
        pairs = ((i, j) for i in range(len(pool)) for j in range(i) if (right is None or (i >= half) != (j >= half)))
        parent = {int(v): int(v) for v in pool}
        def root(x):
            while parent[x] != x:
                x = parent[x]
            return x
        for i, j in pairs:
            if (int(pool[i]) ^ int(pool[j])).bit_count() <= 4:
                x, y = sorted((root(int(pool[i])), root(int(pool[j]))))
                parent[y] = x
        assert linked == {(v, root(v)) for v in parent if root(v) != v}


def test_classes_of_chains_and_stars(spark):
    edges = [(i + 1, i) for i in range(100, 160)] + [(500 + i, 7) for i in range(50)] + [(7, 3), (9, 9)]
    roots = {r["node"]: r["root"] for r in simhash.classes(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(roots[i] == 100 for i in range(100, 161)) and roots[520] == roots[7] == 3
    assert simhash.classes(spark.createDataFrame([], "a long, b long")).count() == 0


def test_near_duplicates(spark, documents):
    got = simhash.near_duplicates(documents).collect()
    assert len(got) == 8
    assert {r["component_id"] for r in got if r["fingerprint"] == "0" * 16} == {0}  # NULL, empty, white space
    assert {r["component_id"] for r in got if r["doc_id"] in (3, 4)} == {3}
    kept = simhash.representatives(documents)
    assert kept.columns == documents.columns and sorted(r["doc_id"] for r in kept.collect()) == [0, 3, 5, 6]
    assert simhash.near_duplicates(documents.limit(0)).count() == simhash.representatives(documents.limit(0)).count() == 0


def test_ids_that_are_null_lose_no_class(spark):
    rows = [(None, "one two three four five"), (None, "six seven eight nine ten"), (None, "six seven eight nine ten")]
    assert simhash.representatives(spark.createDataFrame(rows, "doc_id long, text string")).count() == 2
