"""Tiling of texts whose words repeat, and benchmarks of several blocks."""

import random
import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

from rapport.llm import common, decontaminate


def plain_tiles(text, item, width):
    """Greedy string tiling by comparing every pair of places."""
    free_t, free_i, tiles = [True] * len(text), [True] * len(item), []
    while True:
        best = (0, 0, 0)
        for a in range(len(text)):
            for b in range(len(item)):
                n = 0
                while a + n < len(text) and b + n < len(item) and text[a + n] == item[b + n] and free_t[a + n] and free_i[b + n]:
                    n += 1
                best = max(best, (n, -a, -b))
        n, a, b = best[0], -best[1], -best[2]
        if n < width:
            return tiles
        for k in range(n):
            free_t[a + k] = free_i[b + k] = False
        tiles.append((a, b, n))


@pytest.mark.parametrize("seed", range(40))
def test_every_tile_equals_brute_force(seed):
    rng = random.Random(seed)
    letters = "abcd"[: rng.randint(1, 4)]
    item = [rng.choice(letters) for _ in range(rng.randrange(3, 25))]
    text = [rng.choice(letters + "e") for _ in range(rng.randrange(3, 25))]
    a, b = sorted(rng.sample(range(len(item) + 1), 2))
    text[len(text) // 2 : len(text) // 2] = item[a:b]
    width = rng.randint(1, 4)
    index = decontaminate.Index.of([(1, " ".join(item).encode())], width)
    words = common.word_hashes(*common.words_of([" ".join(text).encode()])[:3])
    at, _, place = index.hits(words, np.zeros(len(words), np.int64))
    assert decontaminate.tile(words, index.words[0], at, place, width) == plain_tiles(text, item, width)


@pytest.mark.parametrize("unit", ["a", "a b", "a b a c", "a a b"])
def test_repeated_words_take_memory_in_proportion(unit):
    item, text = (unit + " ") * (10_000 // len(unit.split())), (unit + " ") * (100_000 // len(unit.split()))
    index = decontaminate.Index.of([(7, item.encode())], 5)
    tracemalloc.start()
    found = decontaminate.covered([index], [b"x y z " + text.encode(), b"nothing"], 0.8)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found == [[(7, 1.0)], []] and peak < 100e6


def test_several_blocks_find_what_one_finds(spark, monkeypatch):
    rng = random.Random(9)
    words = [f"w{i}" for i in range(400)]
    items = [(None if i == 3 else i, " ".join(rng.choice(words) for _ in range(rng.choice([3, 20, 40])))) for i in range(30)]
    texts = [(i, " ".join([*(rng.choice(words) for _ in range(50)), *(items[rng.randrange(30)][1].split() if i % 2 else [])])) for i in range(60)]
    texts += [(5, texts[5][1]), (None, items[4][1]), (70, None), (71, "")]
    docs = spark.createDataFrame(texts, "doc_id long, text string").select("*", F.lit("!").alias("row"), F.lit("!").alias("c1"))
    benchmark = spark.createDataFrame(items, "item_id long, text string")

    def both():
        found = decontaminate.contamination(docs, benchmark).collect()
        return sorted(map(tuple, found), key=repr), sorted(map(tuple, decontaminate.keep_clean(docs, benchmark).collect()), key=repr)

    one = both()
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 900)
    assert decontaminate._blocks(benchmark, 5)[0] > 3
    assert both() == one and sum(r[1] for r in one[0]) >= 31 and len(one[1]) < 40
    assert decontaminate.keep_clean(docs, benchmark).columns == docs.columns
