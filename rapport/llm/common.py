"""What several corpus operators share: words of Arrow batches, text keys, components."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rapport.operators.joins import split_join
from rapport.sources.sinks import stored

# White space that separates words: blank, tab, line feed, vertical tab, form feed, return.
WORD = r"[^\x20\x09-\x0D]+"

# Bytes of text handled at a time inside a task, whatever the size of an Arrow batch.
CHUNK_BYTES = 1 << 20
# Bytes of rows that go to a Python worker at once; a longer text goes alone.
BATCH_BYTES = 8 << 20


def small_batches(spark: SparkSession) -> None:
    """Bound what a Python worker gets at once by bytes, as texts may be long.

    Sets the session's limit on Arrow batches, unless it is lower already.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = int(spark.conf.get(key).rstrip("b"))
    if now <= 0 or now > BATCH_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def not_word(joined: np.ndarray) -> np.ndarray:
    """Flag per byte of UTF-8: is it no part of a letter, digit or other word character.

    ASCII other than letters and digits separates words, and so do the signs U+00A0 to
    U+00BF and the general punctuation U+2000 to U+207F (dashes, quotes, wide blanks).
    """
    ascii_word = np.zeros(256, bool)
    ascii_word[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
    gap = ~ascii_word[joined]
    two = np.flatnonzero(joined[:-1] == 0xC2)
    two = two[joined[two + 1] < 0xC0]
    three = np.flatnonzero(joined[:-2] == 0xE2)
    three = three[(joined[three + 1] & 0xFE) == 0x80]
    for at in (two, two + 1, three, three + 1, three + 2):
        gap[at] = True
    return gap


def chunks(texts: list[bytes | None], limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose texts together hold about ``limit`` bytes; one text may hold more."""
    start, held = 0, 0
    for i, text in enumerate(texts):
        held += len(text or b"")
        if held >= limit:
            yield start, i + 1
            start, held = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def text_bytes(column: pa.Array | pa.ChunkedArray) -> list[bytes | None]:
    """UTF-8 bytes of a string or binary column."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if pa.types.is_string(column.type):
        column = column.cast(pa.binary())
    return column.to_pylist()


def keep_rows(docs: DataFrame, read: Column, decide: Callable[[list[bytes | None]], list[bool]]) -> DataFrame:
    """Rows of ``docs`` that ``decide`` keeps by the texts in ``read``, columns as they are.

    Columns go by place, so any names do, also equal ones and such with dots.
    """
    small_batches(docs.sparkSession)
    names = docs.columns
    plain = [f"c{k}" for k in range(len(names))]
    schema = T.StructType([T.StructField(p, f.dataType) for p, f in zip(plain, docs.schema)])

    def run(batches):
        for batch in batches:
            keep = pa.array(decide(text_bytes(batch.column(len(plain)))), pa.bool_())
            yield batch.select(range(len(plain))).filter(keep)

    rows = docs.select("*", read.cast("binary").alias("_read")).toDF(*plain, "read")
    return rows.mapInArrow(run, schema).toDF(*names)


# Letters of scripts without blanks between words, as code points: South-East Asian, Tibetan,
# kana, Han; and their punctuation.
SINGLE = [(0x0E00, 0x1000), (0x1000, 0x10A0), (0x1780, 0x1800), (0x1950, 0x19E0), (0x1A20, 0x1AB0), (0x3005, 0x3008),
          (0x3040, 0x3130), (0x3190, 0x31C0), (0x31F0, 0x3200), (0x3400, 0x4DC0), (0x4E00, 0xA000), (0xA9E0, 0xAA80),
          (0xF900, 0xFB00), (0xFF66, 0xFFA0), (0x1B000, 0x1B170), (0x20000, 0x40000)]
MARKS = [(0x0E4F, 0x0E50), (0x0E5A, 0x0E5C), (0x0F08, 0x0F15), (0x104A, 0x1050), (0x17D4, 0x17DB), (0x3000, 0x3005),
         (0x3008, 0x3020), (0x3030, 0x3031), (0x30FB, 0x30FC), (0xFF01, 0xFF10), (0xFF1A, 0xFF21), (0xFF3B, 0xFF41), (0xFF5B, 0xFF66)]


def single_letters(joined: np.ndarray, gap: np.ndarray) -> np.ndarray:
    """Flag per byte: does a new word start here as a letter of ``SINGLE`` starts or ends; ``MARKS`` become gaps."""
    cut = np.zeros(len(joined), bool)
    for low, high, n in ((0xE0, 0xF0, 3), (0xF0, 0xF8, 4)):
        at = np.flatnonzero((joined >= low) & (joined < high))
        at = at[at + n < len(joined)]
        point = joined[at].astype(np.int64) & (0xFF >> (n + 1))
        for k in range(1, n):
            point = point << 6 | (joined[at + k] & 0x3F)
        one = np.zeros(len(at), bool)
        for a, b in SINGLE:
            one |= (point >= a) & (point < b)
        cut[at[one]] = cut[at[one] + n] = True
        for a, b in MARKS:
            mark = at[(point >= a) & (point < b)]
            for k in range(n):
                gap[mark + k] = True
    return cut


def words_of(texts: list[bytes | None], single: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words of several texts at once: bytes, word starts, word ends, text of each word.

    Texts are joined by a line feed, so no word spans two of them. With ``single`` a letter of
    a script without blanks between words is a word.
    """
    joined = np.frombuffer(b"\n".join([t or b"" for t in texts]) + b"\n", np.uint8)
    gap = not_word(joined)
    cut = single_letters(joined, gap) if single and (joined >= 0xE0).any() else np.zeros(len(joined), bool)
    gap_before = np.concatenate(([True], gap[:-1]))
    starts = np.flatnonzero(~gap & (gap_before | cut))
    ends = np.flatnonzero((gap | cut) & ~gap_before)
    lengths = np.fromiter((len(t or b"") + 1 for t in texts), np.int64, len(texts))
    owner = np.searchsorted(np.cumsum(lengths), starts, side="right")
    return joined, starts, ends, owner


MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def mix(values: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (the finaliser of splitmix64, fixed constants)."""
    with np.errstate(over="ignore"):
        v = values.astype(np.uint64)
        v = (v ^ (v >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        v = (v ^ (v >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return v ^ (v >> np.uint64(31))


def word_hashes(joined: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every word, from its bytes and their places in the word."""
    if not len(starts):
        return np.empty(0, np.uint64)
    with np.errstate(over="ignore"):
        lengths = ends - starts
        first = np.concatenate(([0], np.cumsum(lengths)[:-1]))
        place = np.arange(int(lengths.sum()), dtype=np.int64) - np.repeat(first, lengths)
        letters = joined[place + np.repeat(starts, lengths)].astype(np.uint64) + np.uint64(1)
        odd = mix(np.arange(int(lengths.max()), dtype=np.uint64) + np.uint64(1)) | np.uint64(1)
        return mix(np.add.reduceat(letters * odd[place], first) + lengths.astype(np.uint64) * MULTIPLIER)


def components(edges: DataFrame, label: str = "links") -> DataFrame:
    """Smallest node reachable from every node of ``edges(a, b)``: rows (node, component).

    Large-star and small-star steps by turns (Kiveris and others, 2014): every node sends
    its larger neighbours, then all its smaller ones, to its smallest neighbour. Each step
    combines minima before the shuffle and joins back with a join whose hot keys split, so
    a hub costs no more than its edges. Each round is written to the shared folder. Nodes
    must not be null; an edge from a node to itself makes it a component of its own.
    """
    spark = edges.sparkSession

    def both(e: DataFrame) -> DataFrame:
        return e.union(e.select("b", "a")).toDF("a", "b")

    def star(e: DataFrame) -> DataFrame:
        low = e.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("low"))
        return split_join(e, low, "a")

    def summary(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count("a"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = stored(edges.distinct(), label)
    before = summary(edges)
    while True:
        apart = edges.where("a <> b")
        large = star(both(apart)).where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        large = large.where("a <> b").distinct()
        small = star(large)
        small = small.select(F.col("b").alias("a"), F.col("low").alias("b")).union(small.select("a", F.col("low").alias("b")))
        edges = stored(small.where("a <> b").union(edges.where("a = b")).distinct(), label)
        after = summary(edges)
        if after == before:
            break
        before = after
    joined = edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("component"))
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return joined.union(roots).groupBy("node").agg(F.min("component").alias("component"))
