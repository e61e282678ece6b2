import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from clickweir.llm import queries, windows
from clickweir.llm.common import table


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(queries.words_path())


def padding(length, capacity):
    return 0 if length & (length - 1) == 0 else capacity - length


def least_cost(places, penalties, capacity, overhead, least):
    """The least cost of all choices of cuts, each tried."""
    at, cost = [0, *places], {0: 0}
    for p, extra in zip(places, penalties):
        cost[p] = min(
            cost[q] + (padding(p - q, capacity) if p - q >= least else capacity - (p - q)) for q in at if p - capacity <= q < p) + extra + overhead
    return cost[places[-1]]


def cost_of(cuts, places, penalties, capacity, overhead, least):
    charged = dict(zip(places, penalties))
    lengths = np.diff([0, *cuts])
    assert lengths.max() <= capacity and set(cuts) <= set(places) and cuts[-1] == places[-1]
    return sum(padding(int(n), capacity) if n >= least else capacity - int(n) for n in lengths) + sum(charged[c] + overhead for c in cuts)


def test_cuts_are_the_best_ones():
    pick = random.Random(1)
    for _ in range(300):
        capacity, overhead = pick.choice([4, 16, 64]), pick.choice([0, 1, 30])
        gaps = [pick.randint(1, capacity) for _ in range(pick.randint(1, 40))]
        places = np.cumsum(gaps)
        penalties = np.array([pick.choice([0, 2, 9]) for _ in gaps])
        least = pick.choice([1, 1, 3, capacity // 2])
        cuts = windows.best_cuts(places, penalties, capacity, overhead, least).tolist()
        args = places.tolist(), penalties.tolist(), capacity, overhead, least
        assert cost_of(cuts, *args) == least_cost(*args)


def test_a_stretch_may_be_cut_everywhere_it_must():
    ends, sentences = np.array([10, 5000, 5001]), np.array([3, 10, 700])
    places, penalties = windows.allowed(ends, sentences, 512, last=False)
    charged = dict(zip(places.tolist(), penalties.tolist()))
    assert np.diff([0, *places]).max() <= windows.STEP
    assert charged[10] == charged[5000] == charged[5001] == 0 and charged[3] == charged[700] == windows.SENTENCE


def test_ids_are_the_tokenizers(tokenizer):
    pick = random.Random(2)
    some = "ab'sS tTdD.,!?\x1c\x1d\x85  　\n\t́éE9ΣσςİIı​﻿\x0b\x0c\x00<|endoftext|>\U0001f600"
    texts = [None, "", " \n", "don't 'tis'll  ﬁ ẞ Ǆ", "x<|endoftext|>y <|ENDOFTEXT|>", "ΑΣ. ΑΣ́ é İ", "Wait... no!?\"", "a" * 5000]
    texts += [" ".join(f"{chr(i)}x{chr(i)}, {chr(i).upper()}." for i in range(0xC0, 0x250))]
    texts += ["".join(pick.choice(some) for _ in range(40)) for _ in range(300)]
    encoder = windows.Encoder(queries.words_path())
    for _ in range(2):  # the second time everything is remembered
        for text, ids in zip(texts, encoder.encode(texts, 2)):
            assert ids.tolist() == [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2], text


def check(rows, texts, tokenizer, capacity, separator):
    """Every id of every document is in one piece, sequences have no gaps; returns share of padding."""
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    assert set(by_doc) == set(texts)
    for doc_id, held in by_doc.items():
        want = np.array([*tokenizer.encode(texts[doc_id] or "", add_special_tokens=False).ids, separator], dtype="<u4")
        held.sort(key=lambda r: r["start"])
        assert [r["start"] for r in held] == np.cumsum([0, *[r["length"] for r in held[:-1]]]).tolist()
        assert sum(r["length"] for r in held) == len(want) == held[0]["doc_tokens"]
        for r in held:
            assert r["ids_crc32"] == zlib.crc32(want[r["start"]: r["start"] + r["length"]].tobytes())
    lost = total = 0
    for held in by_sequence.values():
        held.sort(key=lambda r: r["offset"])
        assert [r["offset"] for r in held] == np.cumsum([0, *[r["length"] for r in held[:-1]]]).tolist()
        length = sum(r["length"] for r in held)
        assert 0 < length <= capacity and min(r["length"] for r in held) > 0
        lost, total = lost + padding(length, capacity), total + length
    return lost / total


@pytest.mark.parametrize("capacity", [8, 512])
def test_pieces(spark, tokenizer, monkeypatch, capacity):
    """Several stretches in one task; sequences follow the order of the documents."""
    monkeypatch.setattr(windows, "STRETCH", 12)
    pick = random.Random(3)
    texts = {i: " ".join(pick.choices(["the", "end.", "runs", "so!", "on"], k=pick.choice([0, 1, 7, 40, 900]))) for i in range(80)}
    stream = windows.Stream(capacity, windows.Encoder(queries.words_path()).ends_sentence, 0)
    encoder, rows = windows.Encoder(queries.words_path()), []
    for i, text in texts.items():
        stream.add(i, encoder.encode([text], 7)[0])
        if stream.open >= windows.STRETCH * capacity:
            rows += stream.settle(last=False)
    rows = [dict(zip(windows._NAMES, row)) for row in rows + stream.settle(last=True)]
    assert not stream.open and not stream.docs
    check(rows, texts, tokenizer, capacity, 7)
    order = [(r["doc_id"], r["start"]) for r in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"]))]
    assert order == sorted(order)


def test_query(spark, tokenizer):
    folder = "/root/testdata/sf0.001"
    rows = [r.asDict() for r in queries.op12_packing(spark, folder).collect()]
    texts = {r["doc_id"]: r["text"] for r in table(spark, folder, "documents").collect()}
    assert check(rows, texts, tokenizer, 4096, 2) < 0.02


def test_awkward_rows(spark, documents):
    path = queries.words_path()
    rows = windows.packed(documents, path, with_ids=True).collect()
    whole = [r for r in rows if r["start"] == 0]
    assert len(whole) == documents.count()  # repeated rows are packed as often
    assert sum(r["doc_id"] is None for r in whole) == 1
    assert all(len(r["ids"]) == r["length"] for r in rows)
    assert max(r["doc_tokens"] for r in rows) > 4096 and min(r["doc_tokens"] for r in rows) == 1
    assert windows.packed(documents.limit(0), path).count() == 0
    large = spark.createDataFrame([(None, "a"), ((1 << 60) + 1, "b")], "doc_id long, text string")
    assert {r["doc_id"] for r in windows.packed(large, path).collect()} == {None, (1 << 60) + 1}
