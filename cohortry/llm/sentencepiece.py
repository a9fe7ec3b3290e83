"""Unigram encoding of text into pieces, and decoding, over a double-array trie.

Pieces and log scores come from a model file or a list. A text is marked (a space becomes the whitespace mark, one mark in
front), and a Viterbi pass finds the pieces with the highest sum of scores; a character that no piece covers falls back
to the pieces of its bytes. Pieces have the mark at their front only, so a best path never crosses the front of a marked
word, and each distinct word is solved once and remembered; all new words of a batch are solved together in numpy.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from cohortry.llm.common import out_batch, slices, texts

MARK = "▁"
#: How far below the lowest piece's score a character of unknown bytes scores.
UNKNOWN_PENALTY = 10.0
#: Bytes of text a task works on at a time: enough for the new words of a batch to be solved together.
SLICE = 1_000_000
#: Distinct words a Python worker remembers before it starts afresh.
MEMORY_WORDS = 200_000


@dataclass(frozen=True)
class Pieces:
    """A vocabulary: text, score and kind of each id; kinds are normal, byte, and other (never produced)."""

    names: list[str]
    scores: np.ndarray
    is_byte: np.ndarray
    is_normal: np.ndarray


def from_scores(names: list[str], scores: list[float]) -> Pieces:
    """A vocabulary of pieces with their log scores; names like <0x0A> are bytes and others in angle brackets are not produced."""
    is_byte = np.array([bool(re.fullmatch(r"<0x[0-9A-F]{2}>", n)) for n in names])
    other = np.array([bool(re.fullmatch(r"<[a-z/]+>", n)) for n in names])
    return Pieces(list(names), np.array(scores, np.float64), is_byte, ~is_byte & ~other)


def fields(message: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Numbers and values of a protocol buffer's fields; those of fixed width are passed over."""
    at = 0

    def number() -> int:
        nonlocal at
        out = shift = 0
        while True:
            byte = message[at]
            at, out, shift = at + 1, out | (byte & 127) << shift, shift + 7
            if byte < 128:
                return out

    while at < len(message):
        key = number()
        if key & 7 == 0:
            yield key >> 3, number()
        elif key & 7 == 2:
            size = number()
            at += size
            yield key >> 3, message[at - size : at]
        else:
            at += 8 if key & 7 == 1 else 4


def is_unigram(model: bytes) -> bool:
    """Whether a model file says that it is of the unigram type, which is also what one says that names no type."""
    trainer = next((value for field, value in fields(model) if field == 2), b"")
    return next((value for field, value in fields(trainer) if field == 3), 1) == 1


def from_file(path: str) -> Pieces:
    """The vocabulary of a model file."""
    with open(path, "rb") as file:
        return from_model(file.read())


def from_model(content: bytes) -> Pieces:
    """The vocabulary of a model file's content. A unigram model's scores are taken as they are.

    The scores of a merge-based model are ranks and no log probabilities; they become those of Zipf's law,
    ``-log(rank + 1) - log(H)`` with ``H`` the harmonic number of the vocabulary.
    """
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_proto=content)
    size = model.get_piece_size()
    scores = np.array([model.get_score(i) for i in range(size)])
    is_byte = np.array([model.is_byte(i) for i in range(size)])
    is_normal = np.array([not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i)) for i in range(size)])
    if not is_unigram(content):
        rank = np.where(is_normal, -scores, 0.0)
        rank = np.where(is_normal, rank - rank[is_normal].min() + 1, 1.0)
        scores = np.where(is_normal, -np.log(rank) - np.log((1 / np.arange(1, is_normal.sum() + 1)).sum()), 0.0)
    return Pieces([model.id_to_piece(i) for i in range(size)], scores, is_byte, is_normal)


class Trie:
    """A double-array trie over byte strings: state s goes on byte c to ``base[s] + c`` if ``check`` there is s."""

    def __init__(self, keys: list[bytes], values: list[int]):
        order = sorted(range(len(keys)), key=keys.__getitem__)
        keys, values = [keys[i] for i in order], [values[i] for i in order]
        size = 1 << 16
        self.base, self.check, self.value = np.zeros(size, np.int32), np.full(size, -1, np.int32), np.full(size, -1, np.int32)
        self.check[0], free = -2, 1
        work = [(0, 0, len(keys), 0)]
        while work:
            state, low, high, depth = work.pop()
            if low < high and len(keys[low]) == depth:
                self.value[state] = values[low]
                low += 1
            if low == high:
                continue
            children: list[tuple[int, int, int]] = []
            i = low
            while i < high:
                c, j = keys[i][depth], i
                while j < high and keys[j][depth] == c:
                    j += 1
                children.append((c, i, j))
                i = j
            codes = [c for c, _, _ in children]
            at, found = max(1, free - codes[0]), False
            while not found:
                while at + 5000 >= len(self.check):
                    grow = len(self.check)
                    self.base, self.check, self.value = (np.concatenate([a, np.full(grow, f, np.int32)]) for a, f in ((self.base, 0), (self.check, -1), (self.value, -1)))
                fits = np.logical_and.reduce([self.check[at + c : at + c + 4096] == -1 for c in codes])
                at, found = at + int(fits.argmax() if fits.any() else 4096), bool(fits.any())
            codes = np.array(codes)
            self.base[state] = at
            self.check[at + codes] = state
            if self.check[free] != -1:
                free += int((self.check[free:] == -1).argmax()) if (self.check[free : free + 64] != -1).all() else int((self.check[free : free + 64] == -1).argmax())
            work += [(at + c, i, j, depth + 1) for c, i, j in children]

    def step(self, states: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """The next state of each, -1 for none."""
        at = self.base[states] + codes
        return np.where(self.check[at] == states, at, -1)


class Encoder:
    """Encodes and decodes texts with one vocabulary."""

    def __init__(self, pieces: Pieces):
        self.pieces = pieces
        ids = np.flatnonzero(pieces.is_normal).tolist()
        marked = [pieces.names[i] for i in ids]
        if any(MARK in n.lstrip(MARK) for n in marked):
            raise ValueError("a piece has the whitespace mark behind another character")
        self.trie = Trie([n.encode() for n in marked], ids)
        self.byte_ids = np.full(256, -1, np.int64)
        for i in np.flatnonzero(pieces.is_byte):
            self.byte_ids[int(pieces.names[i][1:-1], 16)] = i
        if (self.byte_ids < 0).any():
            raise ValueError("the vocabulary lacks pieces of single bytes")
        self.unknown = float(pieces.scores[pieces.is_normal].min()) - UNKNOWN_PENALTY
        self.raw = [bytes([int(n[1:-1], 16)]) if b else n.replace(MARK, " ").encode() for n, b in zip(pieces.names, pieces.is_byte, strict=True)]
        self.seen: dict[str, tuple[bytes, float, int]] = {}

    def solve(self, words: list[str]) -> list[tuple[bytes, float, int]]:
        """Ids (as little-endian 32-bit integers), score and number of ids of each marked word, all words in step.

        Words are sorted by length, so that those still going are always the first ones of the arrays.
        """
        raw = [w.encode() for w in words]
        order = sorted(range(len(raw)), key=lambda i: -len(raw[i]))
        lengths = np.array([len(raw[i]) for i in order], np.int64)
        firsts = np.concatenate([[0], np.cumsum(lengths)])[:-1]
        data = np.frombuffer(b"".join(raw[i] for i in order) + b"\0", np.uint8)
        n, longest = len(order), int(lengths[0]) if len(lengths) else 0
        at = np.concatenate([[0], np.cumsum(lengths + 1)])[:-1]  # a word's places among all places
        best = np.full(int((lengths + 1).sum()), -np.inf)
        back, piece = np.zeros(len(best), np.int64), np.full(len(best), -1, np.int64)
        best[at] = 0.0
        scores = self.pieces.scores
        for i in range(longest):
            live = int(np.searchsorted(-lengths, -i, side="left"))  # longer than i
            head = data[firsts[:live] + i]
            begins = (head & 0xC0) != 0x80
            who = np.flatnonzero(begins & (best[at[:live] + i] > -np.inf))
            here = best[at[who] + i]
            size = 1 + (head[who] >= 0xC0).astype(np.int64) + (head[who] >= 0xE0) + (head[who] >= 0xF0)
            to, total = at[who] + i + size, here + self.unknown
            single = np.zeros(len(who), bool)
            state, walk, j = np.zeros(len(who), np.int64), np.arange(len(who)), i
            while len(walk):
                state = self.trie.step(state, data[firsts[who[walk]] + j])
                j += 1
                on = state >= 0
                state, walk = state[on], walk[on]
                found = self.trie.value[state]
                end = found >= 0
                w, v = walk[end], found[end]
                single[w[j - i == size[w]]] = True
                place, sum_ = at[who[w]] + j, here[w] + scores[v]
                better = sum_ > best[place]
                best[place[better]], back[place[better]], piece[place[better]] = sum_[better], i, v[better]
                more = j < lengths[who[walk]]
                state, walk = state[more], walk[more]
            plain = ~single & (total > best[to])
            best[to[plain]], back[to[plain]], piece[to[plain]] = total[plain], i, -1
        out: list[tuple[bytes, float, int]] = [(b"", 0.0, 0)] * n
        best_, back_, piece_, at_ = best.tolist(), back.tolist(), piece.tolist(), at.tolist()
        for k, i in enumerate(order):
            ids, j = [], len(raw[i])
            while j > 0:
                p, b = piece_[at_[k] + j], back_[at_[k] + j]
                ids += [p] if p >= 0 else self.byte_ids[list(raw[i][b:j][::-1])].tolist()
                j = b
            out[i] = (np.array(ids[::-1], "<i4").tobytes(), best_[at_[k] + len(raw[i])], len(ids))
        return out

    def encode(self, some: list[str]) -> list[tuple[bytes, float, int]]:
        """Ids (bytes of little-endian 32-bit integers), score and number of ids of each text."""
        # a space that follows a space or opens the text leaves an empty word: its mark stands alone before the next word
        split = [[w for w in _words(t)] if t else [] for t in some]
        if len(self.seen) > MEMORY_WORDS:
            self.seen.clear()
        new = list({w for ws in split for w in ws}.difference(self.seen))
        for start in range(0, len(new), 50_000):
            part = new[start : start + 50_000]
            self.seen.update(zip(part, self.solve(part), strict=True))
        get, out = self.seen.__getitem__, []
        for ws in split:
            got = list(map(get, ws))
            out.append((b"".join([g[0] for g in got]), sum([g[1] for g in got]), sum([g[2] for g in got])))
        return out

    def decode(self, ids: np.ndarray) -> str:
        """The text of the ids; bytes are put together, invalid UTF-8 is replaced, and the mark put in front is taken away."""
        raw = b"".join(map(self.raw.__getitem__, ids.tolist()))
        text = raw.decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text


_RUNS = re.compile(f"{MARK}+[^{MARK}]*")


def _words(text: str) -> list[str]:
    """The marked text cut before each run of marks; with lone spaces only, that is a split at spaces."""
    if "  " in text or MARK in text or text[0] == " " or text[-1] == " ":
        return _RUNS.findall(MARK + text.replace(" ", MARK))
    return (MARK + text.replace(" ", f" {MARK}")).split(" ")


_ENCODERS: dict[str, Encoder] = {}


def _encoders(path: str) -> Callable[[], Encoder]:
    """A function, called in each task, that gives the encoder of a model file; it is kept in the Python worker from task to
    task. Only the driver reads the file."""
    with open(path, "rb") as file:
        content = file.read()
    name = hashlib.sha256(content).hexdigest()

    def make() -> Encoder:
        if name not in _ENCODERS:
            _ENCODERS[name] = Encoder(from_model(content))
        return _ENCODERS[name]

    return make


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``ids`` (array of int), ``score`` (sum of the pieces' log scores) and ``decoded`` of every row.

    Decoding gives the text back, except that a whitespace mark in the text itself comes back as a space. A null or
    empty text has no ids, score 0 and decodes to the empty text. Repeated rows stay repeated, null ids stay null, an
    empty table gives no rows, and further columns are left behind.
    """
    make = _encoders(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = make()
        for batch in batches:
            for piece in slices(batch, limit=SLICE):
                coded = encoder.encode(piece.column("text").to_pylist())
                ids = [np.frombuffer(c[0], "<i4") for c in coded]
                yield out_batch(doc_id=piece.column("doc_id"), ids=pa.array(ids, pa.list_(pa.int32())), score=np.array([c[1] for c in coded], float), decoded=pa.array([encoder.decode(i) for i in ids]))

    return texts(docs, id_col, text_col).mapInArrow(run, "doc_id long, ids array<int>, score double, decoded string")


def digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``n_tokens``, ``ids_crc32`` (of the ids as little-endian 32-bit integers), ``score`` and ``round_trip``
    (whether decoding gave the text back) of every row; rows are treated as in :func:`encode`."""

    make = _encoders(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = make()
        for batch in batches:
            for piece in slices(batch, limit=SLICE):
                some = piece.column("text").to_pylist()
                coded = encoder.encode(some)
                same = [encoder.decode(np.frombuffer(c[0], "<i4")) == t.replace(MARK, " ") for c, t in zip(coded, some, strict=True)]
                yield out_batch(doc_id=piece.column("doc_id"), n_tokens=np.array([c[2] for c in coded], np.int64), ids_crc32=np.array([zlib.crc32(c[0]) for c in coded], np.int64), score=np.array([c[1] for c in coded], float), round_trip=np.array(same, bool))

    return texts(docs, id_col, text_col).mapInArrow(run, "doc_id long, n_tokens long, ids_crc32 long, score double, round_trip boolean")
