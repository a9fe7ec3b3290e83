"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment of words.

A seed is a pair of words of an item, next to each other or with one word between them; a document holds it if its words
hold the pair likewise. Whatever aligns with an item at the threshold has many such pairs in common with it, so each
item needs only its rarest ones, by their counts over all documents, and several of them close together. Around them the
document is aligned with the item. Test items are taken in blocks of bounded size, so that a block's words can be sent
to every task.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortry.llm.common import free_name, out_batch, slices, texts
from cohortry.llm.wordhash import FACTOR, mix, word_hashes

MATCH, MISMATCH, GAP = 2.0, -1.0, -1.0
#: How far apart a seed's words stand at most; consecutive matches of an alignment further apart cost a whole match.
REACH = 2
#: Pairs of a place in a text and a place in an item that are held at a time, whole texts at a time.
PLACES = 1_000_000
#: Alignments that are worked out side by side, and cells of their tables at most.
TOGETHER, CELLS = 64, 4_000_000


@dataclass(frozen=True)
class Block:
    """Words of a block's items one after the other, where each item begins, and the seeds with their items and places.

    ``least`` is how many of an item's seeds a leak holds, ``shift`` how many words it can move against the item; ``gaps``
    are those that any seed has.
    """

    ids: np.ndarray
    words: np.ndarray
    first: np.ndarray
    seeds: np.ndarray
    seed_item: np.ndarray
    seed_at: np.ndarray
    least: np.ndarray
    shift: np.ndarray
    gaps: tuple[int, ...]

    def with_seeds(self, kept: np.ndarray) -> Block:
        return replace(self, seeds=self.seeds[kept], seed_item=self.seed_item[kept], seed_at=self.seed_at[kept])


def seed_hashes(words: np.ndarray, gap: int) -> np.ndarray:
    """Hashes of each word with the one ``gap`` later, whatever the gap; a gap of 0 is the word alone."""
    return mix(words + np.uint64(gap)) if gap == 0 else mix(mix(words[:-gap]) * np.uint64(FACTOR) + words[gap:])


def shared_pairs(sizes: np.ndarray, threshold: float) -> np.ndarray:
    """Of how many places of an item at least the pair that begins there is in any text that aligns with it.

    An alignment of ``p`` matches and a share of ``threshold`` pays for at most ``2 p - 2 threshold n`` other words. Of its
    ``p - 1`` steps from match to match, one longer than ``REACH`` words pays for two at least, so ``threshold n - 1`` are
    not longer.
    """
    return np.maximum(np.ceil(threshold * sizes - 1 - 1e-9), 0).astype(np.int64)


def make_block(ids: list[int], item_texts: list[str], threshold: float) -> Block:
    """A block with all seeds; items too short for pairs have their single words instead."""
    words, first, *_ = word_hashes(pa.array(item_texts, pa.string()))
    sizes = np.diff(first)
    of, shared = np.repeat(np.arange(len(ids)), sizes), shared_pairs(sizes, threshold)
    place = np.arange(len(words)) - first[of]
    found = []
    for gap in range(REACH + 1):
        at = np.flatnonzero((place + gap < sizes[of]) & ((shared[of] > 0) == (gap > 0)))
        found.append((seed_hashes(words, gap)[at] if len(at) else np.zeros(0, np.uint64), of[at], place[at]))
    seeds, items, places = (np.concatenate(x) for x in zip(*found, strict=True))
    shift = np.ceil(2 * (1 - threshold) * sizes).astype(np.int64)
    gaps = tuple(gap for gap, (some, _, _) in enumerate(found) if len(some))
    block = Block(np.array(ids, np.int64), words, first, seeds, items, places, np.maximum(1, shared // 3), shift, gaps)
    return block.with_seeds(np.argsort(seeds, kind="stable"))


def keep_rarest(block: Block, counts: np.ndarray, threshold: float) -> Block:
    """The block with the seeds of each item's rarest places only, as many as must share ``least`` with any leak."""
    sizes = np.diff(block.first)
    place = block.first[block.seed_item] + block.seed_at
    cost = np.bincount(place, counts, len(block.words))
    of = np.repeat(np.arange(len(sizes)), sizes)
    rank = np.empty(len(cost), np.int64)
    rank[np.lexsort((cost, of))] = np.arange(len(cost)) - block.first[of]
    shared = shared_pairs(sizes, threshold)
    # an item's last word begins no pair; it costs nothing and so comes first
    wanted = np.where(shared > 0, sizes - shared + block.least, sizes)
    return block.with_seeds(np.flatnonzero(rank[place] < wanted[block.seed_item]))


def blocks(items: DataFrame, id_col: str, text_col: str, threshold: float, block_bytes: int) -> Iterator[Block]:
    """The items in blocks of about ``block_bytes`` of text, dealt by a hash of the id; null texts and ids are left out."""
    rows = items.select(F.col(id_col).cast("long").alias("item_id"), F.col(text_col).alias("text")).where("item_id is not null and text is not null")
    count = 1 + (rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // block_bytes
    for b in range(count):
        got = sorted((r.item_id, r.text) for r in rows.where(F.pmod(F.xxhash64("item_id"), F.lit(count)) == b).collect())
        if got:
            yield make_block([i for i, _ in got], [t for _, t in got], threshold)


class Seeds:
    """Looks the seeds of a block that has any up; a table of bits turns most others away at once."""

    def __init__(self, block: Block):
        self.block, self.known = block, np.unique(block.seeds)
        self.shift = np.uint64(64 - min(25, max(16, len(self.known).bit_length() + 5)))
        self.table = np.zeros(1 << (64 - int(self.shift)), bool)
        self.table[(self.known >> self.shift).astype(np.int64)] = True

    def found(self, words: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Texts, places among all words and numbers in ``known`` of all the seeds that the texts hold."""
        texts_at, places, numbers = [], [], []
        for gap in self.block.gaps:
            hashes = seed_hashes(words, gap) if len(words) > gap else np.zeros(0, np.uint64)
            maybe = np.flatnonzero(self.table[(hashes >> self.shift).astype(np.int64)])
            number = np.minimum(np.searchsorted(self.known, hashes[maybe]), len(self.known) - 1)
            hit = self.known[number] == hashes[maybe]
            at, number = maybe[hit], number[hit]
            of = np.searchsorted(first, at, side="right") - 1
            inside = at + gap < first[of + 1]
            texts_at.append(of[inside])
            places.append(at[inside])
            numbers.append(number[inside])
        of, at, number = (np.concatenate(x) for x in (texts_at, places, numbers))
        order = np.argsort(at, kind="stable")
        return of[order], at[order], number[order]


def may_reach(item: np.ndarray, region: np.ndarray, threshold: float) -> bool:
    """Whether the words leave room for an alignment of share ``threshold``: it matches that share of the item's words at
    least, and all its matches lie within ``3 - 2 * threshold`` times the item's length, since every other word costs 1."""
    least = threshold * len(item) - 1e-9
    inside = np.isin(region, item)
    if inside.sum() < least or np.isin(item, region[inside]).sum() < least:
        return False
    span = int(np.ceil((3 - 2 * threshold) * len(item)))
    sums = np.concatenate([[0], np.cumsum(inside)])
    return len(region) <= span or (sums[span:] - sums[:-span]).max() >= least


def align(items: list[np.ndarray], regions: list[np.ndarray]) -> list[tuple[float, int, int]]:
    """Best local alignment of each item with its region, side by side: score, and the first word and the word after the
    last in the region.

    Smith-Waterman with a linear gap cost, one word of the regions at a time; gaps along the items are closed by a running
    maximum. Shorter items and regions are filled up with words that match nothing. Of equal scores the one that ends
    first in the region wins.
    """
    count, m, length = len(items), max(map(len, items)), max(map(len, regions))
    steps = np.arange(m + 1) * -GAP
    same = np.zeros((length, count, m), bool)
    for k, (item, region) in enumerate(zip(items, regions, strict=True)):
        same[: len(region), k, : len(item)] = region[:, None] == item
    row, origin = np.zeros((count, m + 1)), np.zeros((count, m + 1), np.int64)
    score, begin, end = np.zeros(count), np.zeros(count, np.int64), np.zeros(count, np.int64)
    each, columns = np.arange(count), np.arange(m + 1)
    for i in range(length):
        diagonal = row[:, :-1] + np.where(same[i], MATCH, MISMATCH)
        above = row[:, 1:] + GAP
        new, start = np.zeros((count, m + 1)), np.full((count, m + 1), i + 1)
        new[:, 1:] = np.maximum(diagonal, above)
        start[:, 1:] = np.where(diagonal >= above, np.where(row[:, :-1] > 0, origin[:, :-1], i), origin[:, 1:])
        start = np.where(new > 0, start, i + 1)
        lifted = np.maximum(new, 0.0) + steps
        top = np.maximum.accumulate(lifted, axis=1)
        source = np.maximum.accumulate(np.where(lifted == top, columns, 0), axis=1)
        row = top - steps
        origin = np.take_along_axis(start, source, axis=1)
        k = row.argmax(axis=1)
        better = np.flatnonzero(row[each, k] > score)
        score[better], begin[better], end[better] = row[better, k[better]], origin[better, k[better]], i + 1
    return list(zip(score.tolist(), begin.tolist(), end.tolist(), strict=True))


def align_all(items: list[np.ndarray], regions: list[np.ndarray]) -> list[tuple[float, int, int]]:
    """``align`` for any number of pairs, those of like sizes together, so many at a time that memory stays bounded."""
    out: list[tuple[float, int, int]] = [(0.0, 0, 0)] * len(items)
    order, width = sorted(range(len(items)), key=lambda k: len(regions[k])), max(map(len, items), default=1)
    while order:
        fit = max(1, min(TOGETHER, CELLS // (len(regions[order[-1]]) * width + 1)))
        some, order = order[-fit:], order[:-fit]
        for k, got in zip(some, align([items[k] for k in some], [regions[k] for k in some]), strict=True):
            out[k] = got
    return out


def regions(block: Block, first: np.ndarray, doc: np.ndarray, begin: np.ndarray, item: np.ndarray) -> tuple[np.ndarray, ...]:
    """Texts, items, first words and ends of the stretches where a leak can be, and where an unchanged copy would begin.

    ``begin`` is where the item would begin in the text for a seed to stand in its place. A leak's seeds, ``least`` or
    more of them, begin within ``shift`` words of one another.
    """
    sizes = np.diff(block.first)
    order = np.lexsort((begin, item, doc))
    doc, begin, item = doc[order], begin[order], item[order]
    least, shift = block.least[item], block.shift[item]
    last = np.minimum(np.arange(len(doc)) + least - 1, len(doc) - 1)
    enough = (np.arange(len(doc)) + least <= len(doc)) & (doc[last] == doc) & (item[last] == item) & (begin[last] - begin <= shift)
    covered = np.zeros(len(doc) + 1, np.int64)
    np.add.at(covered, np.flatnonzero(enough), 1)
    np.add.at(covered, last[enough] + 1, -1)
    kept = np.cumsum(covered[:-1]) > 0
    doc, begin, item, shift = doc[kept], begin[kept], item[kept], shift[kept]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (item[1:] != item[:-1]) | (begin[1:] - begin[:-1] > shift[1:])
    heads = np.flatnonzero(new)
    lasts = begin[np.append(heads[1:], len(doc)) - 1] if len(doc) else begin[:0]
    doc, item, begin = doc[heads], item[heads], begin[heads]
    return doc, item, np.maximum(first[doc], begin - block.shift[item]), np.minimum(first[doc + 1], lasts + sizes[item] + block.shift[item]), begin


def count_seeds(rows: DataFrame, block: Block) -> np.ndarray:
    """How often each of the block's seeds occurs in all texts, in the block's order."""
    shared = rows.sparkSession.sparkContext.broadcast(block)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seeds = Seeds(shared.value)
        n = np.zeros(len(seeds.known), np.int64)
        for batch in batches:
            for piece in slices(batch):
                words, first, *_ = word_hashes(piece.column("text"))
                n += np.bincount(seeds.found(words, first)[2], minlength=len(n))
        at = np.flatnonzero(n)
        yield out_batch(seed=at.astype(np.int64), n=n[at])

    counted = rows.mapInArrow(run, "seed long, n long").groupBy("seed").agg(F.sum("n").alias("n")).toArrow()  # a row for each seed of the block at most
    known, at = np.unique(block.seeds, return_inverse=True)
    counts = np.zeros(len(known), np.int64)
    counts[counted.column("seed").to_numpy()] = counted.column("n").to_numpy()
    return counts[at]


def leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text", threshold: float = 0.5, block_bytes: int = 4_000_000) -> DataFrame:
    """Documents that hold a copy or an edited copy of an item: ``doc_id``, ``item_id``, ``score``, ``first_word``, ``last_word``.

    ``score`` is the best alignment's score as a share of the item's own (1: word for word); all pairs of ``threshold`` or
    more are found. Words are runs without blanks and ASCII punctuation, A-Z lower-cased; places count words from 0, last
    included. Items of one or two words are looked for by their single words. Null texts and items are without words;
    repeated rows and a null id are reported as they come; empty tables give no rows.
    """
    rows = texts(docs, id_col, text_col)
    context = docs.sparkSession.sparkContext
    schema = "doc_id long, item_id long, score double, first_word int, last_word int"
    out = docs.sparkSession.createDataFrame([], schema)
    for whole in blocks(items, item_id, item_text, threshold, block_bytes):
        if not len(whole.seeds):
            continue
        shared = context.broadcast(keep_rarest(whole, count_seeds(rows, whole), threshold))

        def search(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            block = shared.value
            seeds, sizes, vocabulary = Seeds(block), np.diff(block.first), np.unique(block.words)
            low = np.searchsorted(block.seeds, seeds.known)
            many_of = np.searchsorted(block.seeds, seeds.known, side="right") - low
            for batch in batches:
                for piece in slices(batch):
                    words, first, *_ = word_hashes(piece.column("text"))
                    of, at, number = seeds.found(words, first)
                    if not len(at):
                        continue
                    inside = np.concatenate([[0], np.cumsum(np.isin(words, vocabulary))])
                    best: dict[tuple[int, int], tuple[float, int, int]] = {}

                    def take(d: int, it: int, start: int, got: tuple[float, int, int], best=best, first=first) -> None:
                        share = got[0] / (MATCH * sizes[it])
                        if share >= threshold and share > best.get((d, it), (0.0,))[0]:
                            best[d, it] = (share, start + got[1] - int(first[d]), start + got[2] - 1 - int(first[d]))

                    before = np.concatenate([[0], np.cumsum(many_of[number])])
                    one = 0
                    while one < len(at):
                        two = max(int(np.searchsorted(before, before[one] + PLACES, side="right")) - 1, one + 1)
                        two = int(np.searchsorted(of, of[two])) if two < len(of) and of[two] != of[one] else int(np.searchsorted(of, of[min(two, len(of)) - 1], side="right"))
                        lo, many = low[number[one:two]], many_of[number[one:two]]
                        pick = np.repeat(lo - (np.cumsum(many) - many), many) + np.arange(many.sum())
                        held = regions(block, first, np.repeat(of[one:two], many), np.repeat(at[one:two], many) - block.seed_at[pick], block.seed_item[pick])
                        one = two
                        open_ = []
                        for d, it, start, stop, same in (tuple(map(int, x)) for x in zip(*held, strict=True)):
                            if inside[stop] - inside[start] < threshold * sizes[it] - 1e-9:
                                continue
                            item_words = block.words[block.first[it] : block.first[it + 1]]
                            if same >= start and same + sizes[it] <= stop and np.array_equal(words[same : same + sizes[it]], item_words):
                                take(d, it, start, (MATCH * sizes[it], same - start, same - start + int(sizes[it])))  # word for word: no alignment is better
                            elif may_reach(item_words, words[start:stop], threshold):
                                open_.append((d, it, start, item_words, words[start:stop]))
                        for (d, it, start, *_), got in zip(open_, align_all([x[3] for x in open_], [x[4] for x in open_]), strict=True):
                            take(d, it, start, got)
                    if best:
                        ids = piece.column("doc_id").take(pa.array([d for d, _ in best]))
                        score, begun, ended = (np.array(x) for x in zip(*best.values(), strict=True))
                        yield out_batch(doc_id=ids, item_id=block.ids[[i for _, i in best]], score=score.astype(float), first_word=begun.astype(np.int32), last_word=ended.astype(np.int32))

        out = out.unionByName(rows.mapInArrow(search, schema))
    return out


def clean(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that hold no leak; rows with a null id stay."""
    leak = free_name(docs, "leak")
    found = leaks(docs, items, id_col, text_col, **options).select(F.col("doc_id").alias(leak)).distinct()
    return docs.join(found, F.col(id_col).cast("long") == F.col(leak), "left_anti")
