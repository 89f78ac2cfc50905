"""Benchmark decontamination by the q-gram lemma.

A *stretch* is any run of ``LENGTH`` characters of a benchmark item, at whatever place it starts; a shorter item is one
stretch. A stretch of n characters leaks into a document if some part of the document is within its edit budget k, one edit
in ``PER_EDIT`` characters. By the q-gram lemma such a part shares at least ``n + 1 - q (k + 1)`` of the stretch's q-grams,
at places whose diagonals (place in the document less place in the item) span at most k + 1. Diagonals are counted in bands
of 2 (k + 1) that overlap by half, so one band holds them all. q-grams are kept once for each place of an item, not for each
stretch: a window slides over the places found in a band and marks all starts whose stretch reaches the bound. These
stretches are held against the same bound for short grams of ``FINE`` characters, and those left are verified by a banded
alignment; nothing else is. Budgets are lowered for short items until the bound is at least 1, which loses no match within
the budget.

Case and the width of white space do not count. Items of fewer than ``LEAST`` characters say too little and are never
matched. Null and empty texts and items match nothing. Repeated rows give repeated results. Documents are read once for
each block of ``BLOCK_CHARS`` of the benchmark and never shuffled; work in a document grows with its length.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronoloom.llm.common import written

Q = 10
LENGTH = 96
PER_EDIT = 12
LEAST = 30
BLOCK_CHARS = 4_000_000
SLOTS = 1 << 22
#: Filler between texts, wider than any band and stretch; no character has its number.
GAP, FILLER = 4 * LENGTH, 0xFFFFFFFF
#: Characters looked through at a time.
GROUP_CHARS = 100_000
#: Rows taken out of an Arrow batch at a time.
SLICE = 256
#: Stretches verified in one go, and starts of stretches whose short grams are counted in one go.
VERIFIED = 20_000
STARTS = 2_000
FINE = 3
BASE = np.uint64(0x9E3779B97F4A7C15)

#: Stands for the items without an id, which are looked for as one.
NO_ID = -(1 << 63)
LEAK = "doc_id bigint, item_id bigint, doc_start bigint, doc_end bigint, patterns int, edits int"


@lru_cache(maxsize=1)
def _folding() -> np.ndarray:
    """Lower case of every character where that is one character; white space becomes a space."""
    table = np.arange(0x110000, dtype=np.uint32)
    for code in range(0x10000):
        sign = chr(code)
        if sign.isspace():
            table[code] = 32
        elif len(low := sign.lower()) == 1:
            table[code] = ord(low)
    return table


def normal(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Folded code points with runs of space as one, and where in the text each stood."""
    points = _folding()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]
    keep = np.ones(len(points), bool)
    keep[1:] = (points[1:] != 32) | (points[:-1] != 32)
    return points[keep], np.flatnonzero(keep)


def _grams(points: np.ndarray) -> np.ndarray:
    """Hash of the q-gram at each place, put together from its halves."""
    if len(points) < Q:
        return np.zeros(0, np.uint64)
    single = points.astype(np.uint64) + np.uint64(1)
    total, size = single, 1
    with np.errstate(over="ignore"):
        for digit in f"{Q:b}"[1:]:
            total = total[:-size] * np.uint64(pow(int(BASE), size, 1 << 64)) + total[size:]
            size *= 2
            if digit == "1":
                total = total[:-1] * BASE + single[size:]
                size += 1
        total *= BASE
    return total ^ (total >> np.uint64(32))


class Patterns:
    """A block of benchmark items, ready to be looked up. Items are laid end to end, ``LENGTH`` apart."""

    def __init__(self, items: list[tuple[int, str]]):
        texts = [(NO_ID if item_id is None else item_id, normal(text.strip())[0]) for item_id, text in items]
        texts = [(item_id, folded) for item_id, folded in texts if len(folded) >= LEAST]
        self.item = np.array([item_id for item_id, _ in texts], np.int64)
        self.length = np.array([len(folded) for _, folded in texts], np.int64)
        self.size = np.minimum(self.length, LENGTH)
        self.budget = np.maximum(0, np.minimum(self.size // PER_EDIT, self.size // Q - 1))
        self.least = self.size + 1 - Q * (self.budget + 1)
        self.base = np.cumsum(self.length + LENGTH) - self.length - LENGTH
        self.points = np.full(int((self.length + LENGTH).sum()) + LENGTH, FILLER, np.uint32)
        for base, (_, folded) in zip(self.base, texts):
            self.points[base : base + len(folded)] = folded
        grams = [_grams(folded) for _, folded in texts] or [np.zeros(0, np.uint64)]
        hashes = np.concatenate(grams)
        order = np.argsort(hashes, kind="stable")
        self.hashes = hashes[order]
        sizes = [len(g) for g in grams[: len(texts)]]
        self.owner = np.repeat(np.arange(len(texts)), sizes)[order]
        self.place = np.concatenate([base + np.arange(n) for base, n in zip(self.base, sizes)] or [np.zeros(0, np.int64)])[order]
        self.slots = np.zeros(SLOTS, bool)
        self.slots[self.hashes & np.uint64(SLOTS - 1)] = True

    def candidates(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Runs of starts whose stretches reach the bound: item, first diagonal of the band, first and last start."""
        none = np.zeros((4, 0), np.int64)
        grams = _grams(points)
        at = np.flatnonzero(self.slots[grams & np.uint64(SLOTS - 1)])
        if not len(at) or len(at) < self.least.min():
            return none
        low = np.searchsorted(self.hashes, grams[at], "left")
        count = np.searchsorted(self.hashes, grams[at], "right") - low
        total = int(count.sum())
        if total < self.least.min():
            return none
        which = np.repeat(low - np.cumsum(count) + count, count) + np.arange(total)
        owner, place = self.owner[which], self.place[which]
        # Diagonals within the item, from 0 on.
        longest = int(self.length.max())
        diagonal = np.repeat(at, count) - (place - self.base[owner]) + longest
        band = diagonal // (self.budget[owner] + 1)
        # A gram of the item counts once for a band, however often the document has it there.
        bits = len(self.points).bit_length()
        key = ((band + 1) << bits) + place
        key = np.unique(np.concatenate([key, key - (1 << bits)]))
        place = key & ((1 << bits) - 1)
        owner = np.searchsorted(self.base, place, "right") - 1
        # The grams from one to the last of as many as the bound asks for must fit into one stretch.
        last = np.arange(len(key)) + self.least[owner] - 1
        far = last >= len(key)
        last[far] = len(key) - 1
        span = self.size[owner] - Q
        good = np.flatnonzero(~far & (key[last] - key <= span))
        owner, last = owner[good], last[good]
        begin = self.base[owner]
        low = np.maximum(place[last] - span[good] - begin, 0)
        high = np.minimum(place[good] - begin, self.length[owner] - self.size[owner])
        band = (key[good] >> bits) - 1
        # Runs of one item and band that touch become one.
        new = np.ones(len(good), bool)
        new[1:] = (owner[1:] != owner[:-1]) | (band[1:] != band[:-1]) | (low[1:] > high[:-1] + 1)
        first = np.flatnonzero(new)
        end = np.r_[first[1:], len(good)] - 1 if len(good) else first
        owner, band, low, high = owner[first], band[first], low[first], high[end]
        return owner, band * (self.budget[owner] + 1) - longest, low, high

    def stretches(self, points: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Item, start and first diagonal of stretches that also reach the bound for short grams, some at a time."""
        found, held = [], 0
        for owner, diagonal, low, high in zip(*(x.tolist() for x in self.candidates(points))):
            size, step = int(self.size[owner]), int(self.budget[owner]) + 1
            own = self.points[self.base[owner] : self.base[owner] + self.length[owner]]
            steps = np.arange(2 * step)
            for start in range(low, high + 1, STARTS):
                stop = min(high + 1, start + STARTS)
                rows = np.arange(start, stop - 1 + size)
                # A place of a band may lie outside of the text; nothing is equal there.
                where = rows[:, None] + diagonal + steps
                same = points[np.clip(where, 0, len(points) - 1)] == own[rows][:, None]
                same = np.logical_and.reduce([same[i : len(rows) - FINE + 1 + i] for i in range(FINE)])
                total = np.concatenate([[0], np.cumsum(same.any(axis=1))])
                enough = total[size - FINE + 1 :] - total[: stop - start] >= size + 1 - FINE * step
                starts = start + np.flatnonzero(enough)
                if len(starts):
                    found.append((np.full(len(starts), owner), starts, np.full(len(starts), diagonal)))
                    held += len(starts)
                if held >= VERIFIED:
                    yield tuple(map(np.concatenate, zip(*found)))
                    found, held = [], 0
        if found:
            yield tuple(map(np.concatenate, zip(*found)))

    def edits(
        self, points: np.ndarray, owner: np.ndarray, first: np.ndarray, diagonal: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        """Fewest edits between each stretch and a part of the text in its band, and where that part ends."""
        budget, size, begin = self.budget[owner], self.size[owner], self.base[owner] + first
        most = int(budget.max())
        steps = np.arange(2 * (most + 1) + 2 * most + 1, dtype=np.int16)
        start = diagonal + first - budget
        offset = start[:, None] + steps[None, :]
        row = np.zeros(offset.shape, np.int16)
        best = np.full(len(owner), LENGTH + 1)
        end = np.zeros(len(owner), np.int64)
        for i in range(int(size.max())):
            live = i < size
            there = points[np.clip(offset + i, 0, len(points) - 1)]
            new = row + (there != self.points[begin + i][:, None])
            new[:, :-1] = np.minimum(new[:, :-1], row[:, 1:] + 1)
            new = np.minimum.accumulate(new - steps, axis=1) + steps
            row = np.where(live[:, None], new, row)
            done = i == size - 1
            if done.any():
                at = row[done].argmin(axis=1)
                best[done] = row[done, :].min(axis=1)
                end[done] = start[done] + at + i + 1
        return best, end

    def leaks(self, texts: list[str]) -> list[tuple[int, int, int, int, int, int]]:
        """Items found in texts: index of the text, item, first and last place, number of stretches, edits of the best.

        The texts are laid end to end with gaps that no band can cross.
        """
        gap = np.full(GAP, FILLER, np.uint32)
        parts, places, starts, at = [gap], [], [], GAP
        for text in texts:
            points, place = normal(text)
            starts.append(at)
            places.append(place)
            parts += [points, gap]
            at += len(points) + GAP
        points = np.concatenate(parts)
        found: dict[tuple[int, int], list[int]] = {}
        seen: dict[tuple[int, int], set[tuple[int, int]]] = {}
        for item, first, diagonal in self.stretches(points):
            edits, ends = self.edits(points, item, first, diagonal)
            good = np.flatnonzero(edits <= self.budget[item])
            owners = np.searchsorted(starts, ends[good] - 1, "right") - 1
            for i, owner in zip(good.tolist(), owners.tolist()):
                key = owner, int(self.item[item[i]])
                end = int(min(max(ends[i] - starts[owner], 1), len(places[owner])))
                begin = min(max(0, end - int(self.size[item[i]]) - int(edits[i])), end - 1)
                span = [int(places[owner][begin]), int(places[owner][end - 1]) + 1, int(edits[i])]
                old = found.setdefault(key, span)
                found[key] = [min(old[0], span[0]), max(old[1], span[1]), min(old[2], span[2])]
                seen.setdefault(key, set()).add((int(item[i]), int(first[i])))
        return [(*key, a, b, len(seen[key]), e) for key, (a, b, e) in sorted(found.items())]


def groups(texts: list[str | None]) -> Iterator[tuple[int, list[str]]]:
    """Runs of texts of about ``GROUP_CHARS``, a longer text by itself, with the index of the first."""
    first, size = 0, 0
    for i, text in enumerate(texts):
        length = len(text or "")
        if i > first and size + length > GROUP_CHARS:
            yield first, [t or "" for t in texts[first:i]]
            first, size = i, 0
        size += length
    if first < len(texts):
        yield first, [t or "" for t in texts[first:]]


def blocks(benchmark: DataFrame) -> Iterator[list[tuple[int, str]]]:
    """Items in blocks of bounded size, by ``item_id``."""
    block, size = [], 0
    rows = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), "text")
    rows = rows.filter("text IS NOT NULL").distinct().orderBy("item_id", "text")
    for row in rows.toLocalIterator():
        if block and size + len(row["text"]) > BLOCK_CHARS:
            yield block
            block, size = [], 0
        block.append((row["item_id"], row["text"]))
        size += len(row["text"])
    if block:
        yield block


def _finder(items: list[tuple[int, str]]) -> Callable:
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        patterns = Patterns(items)
        for batch in batches:
            out = []
            for low in range(0, batch.num_rows, SLICE):
                part = batch.slice(low, SLICE)
                ids = part.column(0).to_pylist()
                for first, texts in groups(part.column(1).to_pylist()):
                    found = patterns.leaks(texts)
                    out += [(ids[first + i], None if item == NO_ID else item, *leak) for i, item, *leak in found]
            columns = list(zip(*out)) or [()] * 6
            kinds = [pa.int64()] * 4 + [pa.int32()] * 2
            names = ["doc_id", "item_id", "doc_start", "doc_end", "patterns", "edits"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    return find


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id``, ``item_id``, the stretch of the text (code points, end exclusive), stretches found (``patterns``), fewest
    edits.

    One row for each document and item found in it; documents without a leak have none. Items without an id count as one,
    with a null ``item_id``.
    """
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    out = None
    for items in blocks(benchmark):
        part = texts.mapInArrow(_finder(items), LEAK)
        out = part if out is None else out.unionAll(part)
    return docs.sparkSession.createDataFrame([], LEAK) if out is None else written(out, "leaks")


def _cleaner(items: list[tuple[int, str]], at: int) -> Callable:
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        patterns = Patterns(items)
        for batch in batches:
            for low in range(0, batch.num_rows, SLICE):
                part = batch.slice(low, SLICE)
                clean = np.ones(part.num_rows, bool)
                for first, texts in groups(part.column(at).to_pylist()):
                    clean[[first + leak[0] for leak in patterns.leaks(texts)]] = False
                yield part.filter(pa.array(clean))

    return keep


def decontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without a leak, with all their columns; no shuffle."""
    at = docs.columns.index("text")
    for items in blocks(benchmark):
        docs = docs.mapInArrow(_cleaner(items, at), docs.schema)
    return docs
