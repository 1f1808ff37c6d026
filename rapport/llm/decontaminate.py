"""Benchmark decontamination by greedy string tiling."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rapport.llm.common import MULTIPLIER, chunks, keep_rows, mix, small_batches, text_bytes, word_hashes, words_of
from rapport.operators.joins import split_join
from rapport.sources.sinks import stored

# Benchmark text searched in one pass over the documents; more text takes more passes.
BLOCK_BYTES = 8 << 20


def rolling(words: np.ndarray, width: int) -> np.ndarray:
    """Karp-Rabin hash of every run of ``width`` words."""
    n = max(len(words) - width + 1, 0)
    out = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(width):
            out = out * MULTIPLIER + words[k : n + k]
    return mix(out)


@dataclass
class Index:
    """Words of benchmark items and where each run of ``width`` of them occurs."""

    ids: list
    words: list[np.ndarray]
    width: int
    seeds: np.ndarray  # sorted hashes of runs
    item: np.ndarray  # item and place of each run
    place: np.ndarray
    present: np.ndarray  # flags by the hash's low bits
    sizes: np.ndarray  # words of each item

    @classmethod
    def of(cls, items: list[tuple], width: int) -> Index:
        words = []
        for _, text in items:
            joined, starts, ends, _ = words_of([text], single=True)
            words.append(word_hashes(joined, starts, ends))
        runs = [rolling(w, width) for w in words]
        seeds = np.concatenate([*runs, np.empty(0, np.uint64)])
        item = np.repeat(np.arange(len(items)), [len(r) for r in runs])
        place = np.concatenate([*[np.arange(len(r)) for r in runs], np.empty(0, np.int64)])
        order = np.argsort(seeds, kind="stable")
        present = np.zeros(1 << max(16, int(16 * len(seeds)).bit_length()), bool)
        present[seeds & np.uint64(len(present) - 1)] = True
        return cls([i for i, _ in items], words, width, seeds[order], item[order], place[order], present, np.array([len(w) for w in words], np.int64))

    def shared(self, words: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Runs of ``words``, none across two texts, that items hold: place, and from where to where in ``seeds``."""
        none = np.empty(0, np.int64)
        if len(words) < self.width or not len(self.seeds):
            return none, none, none
        runs = rolling(words, self.width)
        at = np.flatnonzero(self.present[runs & np.uint64(len(self.present) - 1)])
        at = at[owner[at] == owner[at + self.width - 1]]
        low, high = (np.searchsorted(self.seeds, runs[at], side) for side in ("left", "right"))
        known = low < high
        return at[known], low[known], high[known]

    def hits(self, words: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places of shared runs in ``words``; and each place (item, place in the item) that holds any of them, once."""
        at, low, high = self.shared(words, owner)
        which = spread(low, high)
        return at, self.item[which], self.place[which]


def spread(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Numbers of all ranges from ``low`` to ``high``, of ranges that repeat once."""
    low, first = np.unique(low, return_index=True)
    many = high[first] - low
    return np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many - low, many)


INVERSE = np.uint64(pow(int(MULTIPLIER), -1, 1 << 64))


class Runs:
    """Words in a row with Karp-Rabin hashes of any length, and which of them are free."""

    def __init__(self, words: np.ndarray, free: np.ndarray, breaks: np.ndarray):
        self.words, self.free = words, free
        # No run goes on behind these places.
        self.breaks = np.append(breaks, len(words) - 1)
        with np.errstate(over="ignore"):
            powers = np.multiply.accumulate(np.full(len(words), MULTIPLIER))
            self.sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(words * powers, dtype=np.uint64)))
            self.back = np.multiply.accumulate(np.full(len(words), INVERSE))

    def measure(self) -> int:
        """Find how far a free run reaches from every place; return the longest."""
        stop = np.where(self.free, len(self.words), np.arange(len(self.words)))
        stop[self.breaks] = np.minimum(stop[self.breaks], self.breaks + 1)
        self.reach = np.minimum.accumulate(stop[::-1])[::-1] - np.arange(len(self.words))
        return int(self.reach.max(initial=0))

    def hashes(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Places of free runs of a length, and their hashes."""
        at = np.flatnonzero(self.reach >= length)
        with np.errstate(over="ignore"):
            return at, (self.sums[at + length] - self.sums[at]) * self.back[at]


def tile(text: np.ndarray, item: np.ndarray, i: np.ndarray, j: np.ndarray, width: int) -> list[tuple[int, int, int]]:
    """Greedy string tiling: tiles (place, place in item, length).

    ``i`` and ``j`` are where shared runs of ``width`` words start in the text and in the item;
    nothing else is looked at. The longest run that both have free is found by halving the
    range of its length, by hashes of all free runs of one length. All of that length are marked,
    the earliest first, then the next shorter are looked for, down to ``width`` words. No word of
    text or item is in two tiles. Memory is in proportion to the text and the item, however often
    their words repeat.
    """
    if not len(i) or not len(j):
        return []
    pos = np.unique((np.unique(i)[:, None] + np.arange(width)).ravel())
    left = Runs(text[pos], np.ones(len(pos), bool), np.flatnonzero(np.diff(pos) != 1))
    right = Runs(item, np.zeros(len(item), bool), np.empty(0, np.int64))
    right.free[(np.unique(j)[:, None] + np.arange(width)).ravel()] = True
    tiles: list[tuple[int, int, int]] = []
    longest = len(item)
    while True:
        longest = min(longest, left.measure(), right.measure())
        low = width - 1
        while low < longest:
            middle = (low + longest + 1) // 2
            if np.isin(left.hashes(middle)[1], right.hashes(middle)[1]).any():
                low = middle
            else:
                longest = middle - 1
        if low < width:
            return tiles
        tiles += [(int(pos[a]), b, low) for a, b in marked(left, right, low)]
        longest = low - 1


def marked(left: Runs, right: Runs, length: int) -> list[tuple[int, int]]:
    """Mark common free runs of a length, the earliest of ``left`` with the earliest of ``right``; return their places."""
    at, hashes = left.hashes(length)
    to, others = right.hashes(length)
    order = np.argsort(others, kind="stable")
    to, others = to[order], others[order]
    begin, end = (np.searchsorted(others, hashes, side) for side in ("left", "right"))
    known = np.flatnonzero(begin < end)
    next_of: dict[int, int] = {}
    found, done, free = [], 0, right.free
    for a, s, e in zip(at[known].tolist(), begin[known].tolist(), end[known].tolist()):
        if a < done:
            continue
        # A run overlaps one of the same length that was marked if either of its ends does.
        p = next_of.get(s, s)
        while p < e and not (free[to[p]] and free[to[p] + length - 1]):
            p += 1
        next_of[s] = p
        while p < e:
            b = int(to[p])
            # An equal hash must be equal words.
            if free[b] and free[b + length - 1] and (left.words[a : a + length] == right.words[b : b + length]).all():
                left.free[a : a + length] = False
                free[b : b + length] = False
                found.append((a, b))
                done = a + length
                break
            p += 1
    return found


def covered(indexes: list[Index], texts: list[bytes | None], least: float) -> list[list[tuple]]:
    """Per text the items whose words are tiled to a share of ``least`` or more: (id, share)."""
    out: list[list[tuple]] = [[] for _ in texts]
    for begin, end in chunks(texts):
        joined, starts, ends, owner = words_of(texts[begin:end], single=True)
        words = word_hashes(joined, starts, ends)
        for index in indexes:
            for k, id, share in _found(index, words, owner, least):
                out[begin + k].append((id, share))
    return out


def _found(index: Index, words: np.ndarray, owner: np.ndarray, least: float) -> list[tuple]:
    """Items of one index in joined texts: (text, id, share)."""
    out = []
    at, low, high = index.shared(words, owner)
    cuts = np.flatnonzero(np.diff(owner[at])) + 1
    for s, e in zip([0, *cuts.tolist()], [*cuts.tolist(), len(at)]):
        # Each place of the index once, however often the text repeats a run.
        which = spread(low[s:e], high[s:e])
        items = index.item[which]
        names, many = np.unique(items, return_counts=True)
        for k in names[many * index.width >= least * index.sizes[names]].tolist():
            wanted, of_item = index.words[k], which[items == k]
            # Words that any shared run reaches: tiles cannot cover more.
            reach = np.zeros(len(wanted), bool)
            reach[(index.place[of_item][:, None] + np.arange(index.width)).ravel()] = True
            if reach.sum() < least * len(wanted):
                continue
            here = at[s:e][np.isin(low[s:e], np.searchsorted(index.seeds, index.seeds[of_item]))]
            tiles = tile(words, wanted, here, index.place[of_item], index.width)
            share = sum(t[2] for t in tiles) / len(wanted)
            if share >= least:
                out.append((int(owner[at[s]]), index.ids[k], share))
    return out


def _blocks(benchmark: DataFrame, width: int, size: int | None = None) -> tuple[int, Iterator]:
    """How many blocks of about ``size`` bytes of text the benchmark has, and the indexes of each as a broadcast value.

    Items of fewer words than ``width`` have an index by their number of words.
    """
    spark = benchmark.sparkSession
    items = benchmark.select(F.col("item_id").cast("long").alias("id"), F.lower("text").cast("binary").alias("text"))
    items = items.where("text is not null")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-total // (size or BLOCK_BYTES))

    def build():
        for block in range(n):
            part = items.where(F.pmod(F.xxhash64("id", "text"), F.lit(n)) == block).distinct().collect()
            part = sorted(((r.id, bytes(r.text)) for r in part), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
            seeds: dict[int, list] = {}
            for id, text in part:
                seeds.setdefault(min(width, len(words_of([text], single=True)[1])), []).append((id, text))
            yield spark.sparkContext.broadcast([Index.of(items, n) for n, items in sorted(seeds.items()) if n])

    return n, build()


def _found_rows(rows: DataFrame, indexes: Iterator, least: float) -> DataFrame:
    """Rows (row, item_ids, coverage) of those of ``rows(row, text)`` that hold an item: one pass for each block.

    What a pass finds is written and its block given up before the next one goes out, so a
    task holds one block at a time.
    """
    parts = []
    for index in indexes:

        def run(batches, index=index):
            for batch in batches:
                found = covered(index.value, text_bytes(batch.column(1)), least)
                some = [k for k, f in enumerate(found) if f]
                ids = pa.array([[i for i, _ in found[k]] for k in some], pa.list_(pa.int64()))
                best = pa.array([max(c for _, c in found[k]) for k in some], pa.float64())
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(some, pa.int64())), ids, best], ["row", "item_ids", "coverage"])

        parts.append(stored(rows.select("row", "text").mapInArrow(run, "row long, item_ids array<long>, coverage double"), "found-items"))
        index.unpersist()
    found = reduce(DataFrame.union, parts)
    return found.groupBy("row").agg(F.flatten(F.collect_list("item_ids")).alias("item_ids"), F.max("coverage").alias("coverage"))


def _lowered(text: str = "text") -> Column:
    return F.lower(F.col(text)).cast("binary")


def contamination(docs: DataFrame, benchmark: DataFrame, least: float = 0.8, width: int = 5) -> DataFrame:
    """Benchmark items found in every document: (doc_id, contaminated, item_ids, coverage).

    Words are runs of letters and digits in lower case; in scripts without blanks between
    words each letter is one. Documents and items that share a run
    of ``width`` words (found by rolling hashes) are tiled greedily: longest common run
    first, none overlapping, none shorter than ``width``. An item is in a document if tiles
    cover ``least`` of the item's words, in whatever order they stand there. ``item_ids``
    are the found items in rising order, ``coverage`` the largest share (0 if none).

    Every row of ``docs`` gives one row; a null or empty text is not contaminated, a null id
    stays null. An item of fewer words than ``width`` is found where all of them stand in a
    row. Items with a null text or without words are not searched; one with a null id is, and
    gives a null in ``item_ids``. Repeated items count once. The benchmark goes to all tasks in blocks of
    bounded size. One block takes one pass, and documents are not shuffled; of several each has a
    pass of its own, and what they found is joined to the rows' numbers.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        _lowered().alias("text"),
        F.array().cast("array<long>").alias("item_ids"),
        F.lit(0.0).alias("coverage"),
    )
    n, indexes = _blocks(benchmark, width)
    if n > 1:
        numbered = stored(rows.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text"), "searched")
        found = _found_rows(numbered, indexes, least)
        rows = split_join(numbered.select("row", "doc_id"), found, "row", "left")
        rows = rows.withColumns({"item_ids": F.coalesce("item_ids", F.array().cast("array<long>")), "coverage": F.coalesce("coverage", F.lit(0.0))})
        indexes = iter(())
    for index in indexes:

        def run(batches, index=index):
            for batch in batches:
                found = covered(index.value, text_bytes(batch.column(1)), least)
                ids = [old + [i for i, _ in new] for old, new in zip(batch.column(2).to_pylist(), found)]
                best = [max([old, *[c for _, c in new]]) for old, new in zip(batch.column(3).to_pylist(), found)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(ids, pa.list_(pa.int64())), pa.array(best, pa.float64())],
                    ["doc_id", "text", "item_ids", "coverage"],
                )

        rows = rows.mapInArrow(run, "doc_id long, text binary, item_ids array<long>, coverage double")
    return rows.select(
        "doc_id", (F.size("item_ids") > 0).alias("contaminated"), F.array_sort(F.array_distinct("item_ids")).alias("item_ids"), "coverage"
    )


def keep_clean(docs: DataFrame, benchmark: DataFrame, least: float = 0.8, width: int = 5) -> DataFrame:
    """Rows of ``docs``, all columns as they are, that hold no benchmark item."""
    n, indexes = _blocks(benchmark, width)
    if n > 1:
        plain = [f"c{k}" for k in range(len(docs.columns))]
        rows = docs.select("*", _lowered().alias("_text"), F.monotonically_increasing_id().alias("_row"))
        rows = stored(rows.toDF(*plain, "text", "row"), "searched")
        found = _found_rows(rows, indexes, least)
        return split_join(rows.drop("text"), found.select("row"), "row", "left_anti").select(*plain).toDF(*docs.columns)
    for index in indexes:
        docs = keep_rows(docs, _lowered(), lambda texts, index=index: [not f for f in covered(index.value, texts, least)])
    return docs
