"""SimHash fingerprints and near-duplicate groups within a few differing bits."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rapport.llm.common import components, small_batches, text_bytes
from rapport.operators.joins import split_join
from rapport.sources.sinks import stored

BYTES = 8
SEED = 42
# Shingles hashed at a time: bounds the bit table of one very long text.
HASHES_AT_ONCE = 1 << 16


def fingerprint(text: bytes | None, shingle: int) -> int:
    """64 bits, each set if it is set in over half the hashes of the text's shingles."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    width = min(shingle, len(words))
    digest = xxhash.xxh64_intdigest
    ones, n = np.zeros(64, np.int64), len(words) - width + 1
    for at in range(0, n, HASHES_AT_ONCE):
        to = min(n, at + HASHES_AT_ONCE)
        spans = zip(starts[at:to].tolist(), ends[at + width - 1 : to + width - 1].tolist())
        hashes = np.array([digest(joined[a:b], SEED) for a, b in spans], ">u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (id, fp, row): the fingerprint of each whole text as a signed 64-bit number, a hash of id and text."""

    def run(batches):
        for batch in batches:
            fps = [fingerprint(t, shingle) for t in text_bytes(batch.column(1))]
            column = np.array(fps, np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(column, pa.int64()), batch.column(2)], ["id", "fp", "row"])

    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id).cast("long").alias("id"), F.col(text).cast("binary").alias("text"), row_hash(id, text).alias("row"))
    return rows.mapInArrow(run, "id long, fp long, row long")


def row_hash(id: str, text: str) -> Column:
    return F.xxhash64(F.col(id).cast("long"), F.col(text).cast("binary"))


def bucket_links(values: np.ndarray, distance: int, shared: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of a posting list within ``distance`` bits, as places (i, j) with i < j.

    The list's members agree in ``shared`` bytes, so they differ in the 16 bits of two
    bytes at most. Short lists compare all their members; a longer one looks up, for each
    member, the few values in reach, so its work is linear in its length however many
    members it has (65,536 at most). Each pair's shared bytes are tallied before its bits
    are counted.
    """
    n = len(values)
    if n <= 64:
        i, j = np.triu_indices(n, 1)
    else:
        spread = np.bitwise_or.reduce(values ^ values[0])
        free = [np.uint64(1 << b) for b in range(64) if int(spread) >> b & 1]
        order = np.argsort(values)
        ranked = values[order]
        found = []
        for k in range(1, distance + 1):
            for bits in combinations(free, k):
                other = ranked ^ np.bitwise_or.reduce(np.array(bits, np.uint64))
                at = np.minimum(np.searchsorted(ranked, other), n - 1)
                hit = np.flatnonzero((ranked[at] == other) & (ranked < other))
                found.append((order[hit], order[at[hit]]))
        i = np.concatenate([f[0] for f in found])
        j = np.concatenate([f[1] for f in found])
    differ = values[i] ^ values[j]
    tally = (differ.view(np.uint8).reshape(-1, BYTES) == 0).sum(axis=1)
    i, j, differ = i[tally >= shared], j[tally >= shared], differ[tally >= shared]
    near = np.bitwise_count(differ) <= distance
    return i[near], j[near]


def fingerprint_links(classes: DataFrame, distance: int) -> DataFrame:
    """All pairs of distinct fingerprints within ``distance`` bits: rows (a, b) of their ``rep``.

    Inverted index over byte positions. Fingerprints that differ in d bits share at least
    8 - d bytes at their places. Posting lists are kept for every choice of that many
    positions, so a pair first meets in a list when its tally has reached the guaranteed
    minimum; it is then verified bit by bit. ``classes`` holds one row (fp, rep) per
    distinct fingerprint. A list is read as a sorted run, never as a nested value, and
    holds 2^(8 d) members at most.
    """
    if not 0 < distance <= 2:
        raise ValueError("distance must be 1 or 2")
    shared = BYTES - distance
    masks = [sum(0xFF << 8 * p for p in keep) for keep in combinations(range(BYTES), shared)]
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    lists = F.explode(F.array(*[F.struct(F.lit(n).alias("n"), F.lit(m).alias("m")) for n, m in enumerate(signed)]))
    rows = classes.select("fp", "rep", lists.alias("list"))
    rows = rows.select(
        F.xxhash64(F.col("list.n"), F.col("fp").bitwiseAND(F.col("list.m"))).alias("key"), "fp", "rep"
    )
    # Two different lists may share a hash: their members then fail the tally.
    rows = rows.repartition("key").sortWithinPartitions("key")

    def run(batches):
        rest = None
        for batch in batches:
            key, fp, rep = (batch.column(c).to_numpy(zero_copy_only=False) for c in range(3))
            if rest is not None:
                key, fp, rep = (np.concatenate(x) for x in zip(rest, (key, fp, rep)))
            last = np.searchsorted(key, key[-1]) if len(key) else 0
            rest = key[last:], fp[last:], rep[last:]
            yield from links(key[:last], fp[:last], rep[:last])
        if rest is not None:
            yield from links(*rest)

    def links(key, fp, rep):
        if not len(key):
            return
        edges = np.flatnonzero(np.diff(key)) + 1
        starts = np.concatenate(([0], edges))
        ends = np.concatenate((edges, [len(key)]))
        several = ends - starts > 1
        a, b = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for s, e in zip(starts[several].tolist(), ends[several].tolist()):
            i, j = bucket_links(fp[s:e].view(np.uint64), distance, shared)
            a.append(rep[s:e][i])
            b.append(rep[s:e][j])
        a, b = np.concatenate(a), np.concatenate(b)
        if len(a):
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return rows.mapInArrow(run, "a long, b long")


def near_duplicates(
    docs: DataFrame, shingle: int = 3, distance: int = 2, id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Fingerprint and group of every document: rows (id, fingerprint, component_id).

    Words are what ASCII white space separates, A-Z in lower case; a text of fewer words
    than ``shingle`` is one shingle; a null, empty or blank text has fingerprint zero and
    links like any other. Groups are connected by links of at most ``distance`` differing
    bits; ``component_id`` is the smallest id of the group. Equal fingerprints are folded
    into one class first, so a third of all documents may be copies. Repeated ids give
    repeated rows. A null id keeps its fingerprint; it names no group, so a group of null
    ids only has a null ``component_id``. No rows give no rows. Only ``id`` and ``text``
    are read of the columns.
    """
    fps = stored(fingerprints(docs, shingle, id, text).select("id", "fp"), "fingerprints")
    classes = stored(fps.dropna(subset=["id"]).groupBy("fp").agg(F.min("id").alias("rep")), "classes")
    groups = components(fingerprint_links(classes, distance), "fingerprint-links")
    named = classes.join(groups, classes.rep == groups.node, "left")
    named = named.select("fp", F.coalesce("component", "rep").alias("component_id"))
    rows = split_join(fps, named, "fp", "left")
    return rows.select(
        F.col("id").alias(id), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_one(docs: DataFrame, shingle: int = 3, distance: int = 2, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one document of each near-duplicate group, the one with the smallest id.

    All columns stay as they are. Groups are those of fingerprints, so rows without an id are
    copies like any other and stay only where their group has no id (one of them, by the
    text's hash), and rows that share an id but not their text are documents of their own.
    Rows that repeat the kept id and text come out once. Rows with neither an id nor a text
    cannot be told apart and all stay.
    """
    known = docs.where(F.col(id).isNotNull() | F.col(text).isNotNull())
    fps = stored(fingerprints(known, shingle, id, text), "fingerprints")
    # The best row of each fingerprint: smallest id, null ids last, then the smallest hash.
    best = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "row")).alias("best")
    classes = stored(fps.groupBy("fp").agg(best), "classes")
    groups = components(fingerprint_links(classes.select("fp", F.col("fp").alias("rep")), distance), "fingerprint-links")
    named = classes.join(groups, classes.fp == groups.node, "left")
    named = named.groupBy(F.coalesce("component", "fp").alias("component")).agg(F.min("best").alias("best"))
    rows = fps.groupBy("row").count()
    rows = stored(rows.join(named.select("best.row", F.lit(True).alias("stays")), "row", "left"), "near-duplicates")
    mark = "_row_hash"
    while mark in map(str.lower, docs.columns):
        mark += "_"
    hashed = docs.withColumn(mark, row_hash(id, text))
    kept = hashed.join(rows.where("stays is null").select(F.col("row").alias(mark)), mark, "left_anti")
    repeated = stored(rows.where("stays and count > 1").select(F.col("row").alias(mark)), "repeated")
    if repeated.isEmpty():
        return kept.drop(mark)
    once = kept.join(repeated, mark, "left_semi").dropDuplicates([mark])
    return kept.join(repeated, mark, "left_anti").unionByName(once).drop(mark)
