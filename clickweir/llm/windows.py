"""Packing in the order of the documents: sequences are windows of one stream of token ids, and dynamic
programming chooses where to cut it.

The stream of a task is the ids of its documents one after the other, each followed by a separator. A
window may end where a document ends (free), where a sentence ends (``SENTENCE`` tokens of penalty),
or, so that long stretches without either can be cut, at every ``STEP``-th token in between (``ANYWHERE``).
A window of ``n`` ids costs the padding up to ``capacity``, none where ``n`` is a power of two, and
``OVERHEAD``. (Powers below an eighth of ``capacity`` are taken at the end of a stream only, where they
hold its rest; elsewhere they would just make many sequences.) The least cost up to a cut at ``p`` is then

    cost(p) = penalty(p) + OVERHEAD + min over cuts q in [p - capacity, p) of cost(q) + capacity - (p - q)

so the best ``q`` is the least ``cost(q) + q`` in a sliding window, which a monotone queue keeps at its
head; windows of a power of two are looked up, at most twelve per cut. Each cut enters and leaves the
queue once.

A task works on some hundred windows at a time and holds one such stretch. The last ``HELD`` windows of a
stretch are not settled but decided again together with the ids that follow, so a stretch's end costs
nothing; only the end of a task may. No row is moved: a sequence never crosses tasks.

Ids come from the tokenizer itself. Neither its normaliser nor its patterns see across ASCII white space,
so it encodes each distinct stretch of other characters once (up to ``_REMEMBERED`` at a time), and texts
are put together from these.

NULL and empty texts are the separator alone; a text of any length is cut like others (a task holds the
ids of one stretch and of one text); rows that repeat are packed as often as they occur; a NULL doc_id
stays NULL; ties between cuts go to the later one; an empty table gives an empty result; columns other
than ``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import deque
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from clickweir.llm.words import Growing, Vocabulary, split

SENTENCE = 16
ANYWHERE = 64
OVERHEAD = 256
STEP = 64
STRETCH = 256
HELD = 8
_REMEMBERED = 3 << 19


# ---------------------------------------------------------------- cuts


def best_cuts(places: np.ndarray, penalties: np.ndarray, capacity: int, overhead: int = OVERHEAD, least: int = 1) -> np.ndarray:
    """The cuts of least cost among ``places`` (ascending, the last is the end, no two neighbours further
    apart than ``capacity``), the end included. The stream begins at 0, which is not listed. Windows of
    ``least`` ids or more may go without padding, if they are a power of two."""
    at = np.concatenate([[0], places]).astype(np.int64)
    index = np.full(int(at[-1]) + 1, -1, dtype=np.int64)
    index[at] = np.arange(len(at))
    froms, tos = [], []
    power = 1 << max(0, least - 1).bit_length()
    while power < capacity:
        back = at - power
        found = np.flatnonzero(back >= 0)
        earlier = index[back[found]]
        tos.append(found[earlier >= 0])
        froms.append(earlier[earlier >= 0])
        power *= 2
    to, source = np.concatenate(tos or [[]]).astype(np.int64), np.concatenate(froms or [[]]).astype(np.int64)
    order = np.argsort(to, kind="stable")
    to, source = [*to[order].tolist(), -1], source[order].tolist()

    where, extra = at.tolist(), [0, *(penalties + overhead).tolist()]
    costs, parents = [0.0] * len(where), [0] * len(where)
    queue = deque([(0.0, 0)])  # cost + place, and the cut, the least in front
    short = 0
    for i in range(1, len(where)):
        here = where[i]
        low = here - capacity
        while where[queue[0][1]] < low:
            queue.popleft()
        cost, parent = queue[0]
        cost += capacity - here
        while to[short] == i:
            other = source[short]
            if costs[other] < cost:
                cost, parent = costs[other], other
            short += 1
        cost += extra[i]
        costs[i], parents[i] = cost, parent
        rank = cost + here
        while queue and queue[-1][0] >= rank:
            queue.pop()
        queue.append((rank, i))
    cuts, i = [], len(where) - 1
    while i:
        cuts.append(where[i])
        i = parents[i]
    return np.array(cuts[::-1], dtype=np.int64)


def merged(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The distinct numbers of two arrays, ascending."""
    both = np.sort(np.concatenate([a, b]), kind="stable")
    return both[np.concatenate([[True], both[1:] != both[:-1]])]


def allowed(ends: np.ndarray, sentences: np.ndarray, capacity: int, last: bool) -> tuple[np.ndarray, np.ndarray]:
    """Where a stream may be cut, and the penalties: at the ``ends`` of documents (ascending, the last
    is that of the stream), at ``sentences`` (ascending), and evenly where these leave long gaps. The
    ``last`` stretch may also be cut so that its rest falls into powers of two."""
    total = int(ends[-1])
    marks = merged(ends, sentences)
    before = np.concatenate([[0], marks[:-1]])
    step = min(STEP, capacity)
    many = np.maximum(marks - before - 1, 0) // step
    first = np.repeat(before, many)
    nth = np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many) + 1
    more = first + nth * step
    if last:
        powers = 1 << np.arange(int(capacity).bit_length())
        more = np.concatenate([more, total - total % powers])
        more = more[more > 0]
    places = merged(marks, more)
    penalties = np.full(len(places), ANYWHERE, dtype=np.int64)
    penalties[np.searchsorted(places, sentences)] = SENTENCE
    penalties[np.searchsorted(places, ends)] = 0
    return places, penalties


# ---------------------------------------------------------------- tokens


# Small letters that the tokenizer's normaliser leaves as one letter each, and marks that may follow.
_LETTERS = "[a-zß-öø-įı-ſ]+"
_PLAIN = re.compile(f"({_LETTERS})([.,;:!?]*)")


class Encoder:
    """Token ids of texts, by a tokenizer that sees nothing across ASCII white space, and for which a run
    of letters is one word in any case, and marks after it are another.

    Stretches without white space are numbered as they are met. Each is two atoms, letters and marks, or
    the stretch as it is and nothing; each atom is encoded once."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.ends_word, self.ends_sentence = np.zeros(size, dtype=bool), np.zeros(size, dtype=bool)
        for token, number in self.tokenizer.get_vocab(with_added_tokens=False).items():
            self.ends_word[number] = token.endswith("</w>")
            self.ends_sentence[number] = token.endswith("</w>") and any(c in ".!?" for c in token[:-4])
        self.forget()

    def forget(self) -> None:
        self.stretches, self.atoms = Vocabulary(), Vocabulary()
        self.first, self.second = Growing(np.int32), Growing(np.int32)  # the atoms of each stretch
        self.begin, self.size, self.ids = Growing(np.int64), Growing(np.int64), Growing(np.uint32)  # of each atom
        self.atoms[""]  # number 0
        self._encode_atoms(self.atoms.words)

    def encode(self, texts: list[str | None], separator: int) -> list[np.ndarray]:
        """The ids of each text and the separator."""
        if self.first.used > _REMEMBERED:
            self.forget()
        numbers = [self.stretches.numbers(split(text)) for text in texts]
        if len(self.stretches.words) > self.first.used:
            self._learn(self.stretches.words[self.first.used:])
        return [self._joined(n, separator) for n in numbers]

    def _learn(self, new: list[bytes]) -> None:
        known, atoms = len(self.atoms.words), self.atoms
        text = b"\n".join(new).decode()
        first, second = [], []
        for small, given in zip(text.lower().split("\n"), text.split("\n")):
            plain = _PLAIN.fullmatch(small)
            word, marks = plain.groups() if plain else (given, "")
            first.append(atoms[word])
            second.append(atoms[marks])
        self.first.extend(first)
        self.second.extend(second)
        self._encode_atoms(atoms.words[known:])

    def _encode_atoms(self, new: list[str]) -> None:
        letters, others = [], []
        for i, atom in enumerate(new):
            (letters if re.fullmatch(_LETTERS, atom) else others).append(i)
        begin, size = np.zeros(len(new), np.int64), np.zeros(len(new), np.int64)
        for a in range(0, len(letters), 4096):
            some = letters[a: a + 4096]
            joined = " ".join([new[i] for i in some])
            ids = np.array(self.tokenizer.encode_batch_fast([joined], add_special_tokens=False)[0].ids, dtype=np.uint32)
            stops = np.flatnonzero(self.ends_word[ids]) + 1
            size[some] = np.diff(stops, prepend=0)
            begin[some] = self.ids.used + stops - size[some]
            self.ids.extend(ids)
        for a in range(0, len(others), 1024):
            some = others[a: a + 1024]
            found = self.tokenizer.encode(" ".join([new[i] for i in some]), add_special_tokens=False)
            # Tokens belong to the atom in which they begin.
            ends = np.cumsum([len(new[i]) + 1 for i in some])
            size[some] = np.bincount(np.searchsorted(ends, [b for b, _ in found.offsets], "right"), minlength=len(some))
            begin[some] = self.ids.used + np.cumsum(size[some]) - size[some]
            self.ids.extend(np.array(found.ids, dtype=np.uint32))
        self.begin.extend(begin)
        self.size.extend(size)

    def _joined(self, numbers: np.ndarray, separator: int) -> np.ndarray:
        atoms = np.stack([self.first.values[numbers], self.second.values[numbers]], axis=1).ravel()
        atoms = atoms[atoms > 0]
        sizes = self.size.values[atoms]
        stops = np.cumsum(sizes)
        shift = np.repeat(self.begin.values[atoms] - (stops - sizes), sizes)
        return np.append(self.ids.values[shift + np.arange(len(shift))], np.uint32(separator))


@lru_cache(maxsize=1)
def encoder(path: str) -> Encoder:
    return Encoder(path)


# ---------------------------------------------------------------- a task


class Stream:
    """The open end of a task's stream, and the windows settled so far."""

    def __init__(self, capacity: int, ends_sentence: np.ndarray, first: int):
        self.capacity, self.ends_sentence, self.next = capacity, ends_sentence, first
        self.docs: list[tuple] = []  # doc_id, its ids, how many of them are settled
        self.open = 0

    def add(self, doc_id, ids: np.ndarray) -> None:
        self.docs.append((doc_id, ids, 0))
        self.open += len(ids)

    def settle(self, last: bool) -> list[tuple]:
        """Pieces of the windows that are decided: all if this is the ``last`` of the stream, else all
        but some at its end."""
        if not self.open:
            return []
        done = np.array([d[2] for d in self.docs])
        ends = np.cumsum([len(ids) for _, ids, _ in self.docs]) - np.cumsum(done)
        begins = np.concatenate([[0], ends[:-1]])
        flat = np.concatenate([ids[n:] for _, ids, n in self.docs]).astype("<u4")
        sentences = np.flatnonzero(self.ends_sentence[flat]) + 1
        least = 1 if last else self.capacity // 8
        cuts = best_cuts(*allowed(ends, sentences, self.capacity, last), self.capacity, least=least)
        if not last:
            cuts = cuts[cuts <= self.open - HELD * self.capacity]
            if not len(cuts):
                return []
        until = int(cuts[-1])
        stops = merged(ends[ends <= until], cuts)
        starts = np.concatenate([[0], stops[:-1]])
        doc, window = np.searchsorted(ends, starts, "right"), np.searchsorted(cuts, starts, "right")
        window_begin = np.concatenate([[0], cuts])[window]
        raw = memoryview(flat.tobytes())
        rows = [
            (self.docs[d][0], a - b + n, e - a, zlib.crc32(raw[4 * a: 4 * e]), len(self.docs[d][1]), self.next + w, a - o, flat[a:e])
            for d, a, e, b, n, w, o in zip(doc.tolist(), starts.tolist(), stops.tolist(), begins[doc].tolist(),
                                           done[doc].tolist(), window.tolist(), window_begin.tolist())]
        self.next += len(cuts)
        gone = int(np.searchsorted(ends, until, "right"))
        self.docs = self.docs[gone:]
        if self.docs and until > begins[gone]:
            doc_id, ids, n = self.docs[0]
            self.docs[0] = doc_id, ids, n + until - int(begins[gone])
        self.open -= until
        return rows


SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids array<int>"
_NAMES = [part.split()[0] for part in SCHEMA.split(", ")]


def packed(docs: DataFrame, path: str, capacity: int = 4096, separator: int = 2, with_ids: bool = False) -> DataFrame:
    """One row per piece of each row of ``docs``: where it starts in its document and how long it is, and
    its sequence and place there. ``ids`` is NULL unless asked for. The tokenizer's file must be at
    ``path`` on every executor. Sequences have a task's number in their upper bits."""

    def frame(rows: list[tuple]) -> pd.DataFrame:
        out = pd.DataFrame(rows, columns=_NAMES)
        out["doc_id"] = pd.array([row[0] for row in rows], dtype="Int64")
        out["ids"] = out["ids"].map(lambda ids: ids.astype(np.int32)) if with_ids else None
        return out

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tokens = encoder(path)
        stream = Stream(capacity, tokens.ends_sentence, TaskContext.get().partitionId() << 40)
        for batch in batches:
            ids, texts = batch["doc_id"].tolist(), batch["text"].tolist()
            for i in range(0, len(texts), 200):
                for doc_id, found in zip(ids[i: i + 200], tokens.encode(texts[i: i + 200], separator)):
                    stream.add(None if doc_id is None else int(doc_id), found)
                if stream.open >= STRETCH * capacity:
                    yield frame(stream.settle(last=False))
        yield frame(stream.settle(last=True))

    # Ids go as text: pandas would turn numbers with NULLs among them into doubles.
    return docs.select(F.col("doc_id").cast("long").cast("string").alias("doc_id"), "text").mapInPandas(pack, SCHEMA)
