import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from clickweir.llm import packing

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def test_ids_are_those_of_the_tokenizer(texts):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    pick = random.Random(1)
    strange = ["".join(pick.choices(" \n\t\r aZ9é²½Ⅷ語'’s<|endoftext|>_.-\U0001f600́", k=60)) for _ in range(300)]
    long = "\n".join(pick.choices(["ein satz.", "", " two ", "trois\r", "x" * 50, "<|endoftext|>"], k=9000))
    for t in [*texts, *strange, "a<|endoftext|>b", long]:
        assert packing.encode(t, RANKS) == tokenizer.encode(t or "", add_special_tokens=False).ids


@pytest.mark.parametrize("kind", ["uniform", "long", "one", "empty", "half", "full"])
def test_plan_places_all_without_overlap(kind):
    pick = random.Random(2)
    lengths = {"uniform": [pick.randint(1, 100) for _ in range(3000)], "long": [pick.randint(30, 60) for _ in range(997)],
               "one": [7], "empty": [], "half": [50] * 33 + [51] * 10 + [1] * 5, "full": [100] * 4 + [99]}[kind]
    counts = sorted({n: lengths.count(n) for n in lengths}.items())
    placed, sequences = packing.plan(counts, 100)
    spans, seen = {}, {}
    for length, lo, count, first, offset in placed:
        for i in range(count):
            spans.setdefault(first + i, []).append((offset, offset + length))
            seen.setdefault(length, []).append(lo + i)
    assert {n: sorted(r) for n, r in seen.items()} == {n: list(range(c)) for n, c in counts}
    for held in spans.values():
        held.sort()
        assert held[0][0] == 0 and all(a[1] == b[0] for a, b in zip(held, held[1:])) and held[-1][1] <= 100
    assert sorted(spans) == list(range(sequences))
    least = -(-sum(lengths) // 100)
    assert sequences <= 1 + least * {"long": 1.35, "half": 1.35, "uniform": 1.02}.get(kind, 1)


def test_configurations_meet_demand():
    sizes, demand = np.array([51, 34, 21, 12]), np.array([40.0, 100.0, 70.0, 200.0])
    found = packing.configurations(sizes, demand, 100)
    assert all((column * sizes).sum() <= 100 for column, _ in found)
    assert np.allclose(sum(column * level for column, level in found), demand)
    assert sum(level for _, level in found) <= 40 + 60 / 2 + 27  # 51 + 34 + 12, 34 + 34 + 12 + 12, four of 21 and one of 12


def test_packed_rows(spark, documents):
    got = packing.packed_documents(documents, RANKS, capacity=64, with_ids=True).collect()
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    by = {}
    for r in got:
        assert zlib.crc32(np.array(r["ids"], dtype="<u4").tobytes()) == r["ids_crc32"] and len(r["ids"]) == r["length"]
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for held in by.values():
        held.sort()
        assert [o for o, _ in held] == [sum(n for _, n in held[:i]) for i in range(len(held))] and sum(n for _, n in held) <= 64
    ids = tokenizer.encode(documents.where("doc_id = 5").first()["text"], add_special_tokens=False).ids + [0]
    mine = sorted((r["piece"], r["start"], r["ids"]) for r in got if r["doc_id"] == 5)
    assert [x for _, _, part in mine for x in part] == ids and [len(p) for _, _, p in mine[1:]] == [64] * (len(mine) - 1)
    assert sum(r["doc_id"] == 4 for r in got) == 2 and sum(r["doc_id"] is None for r in got) == 1
    assert packing.packed_documents(documents.limit(0), RANKS).count() == 0
