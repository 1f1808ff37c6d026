"""Quality by importance resampling with hashed n-gram models."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rapport.llm.common import MULTIPLIER, chunks, mix, small_batches, text_bytes, word_hashes, words_of
from rapport.sources.sinks import stored

BUCKETS = 1 << 14
SEED = 11
# The target model is fitted to this many labelled documents at most, drawn by hash. The raw
# model covers all documents.
MAX_TARGET_DOCS = 50_000


def buckets(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hash buckets of all words and word pairs of some texts, and the text of each."""
    joined, starts, ends, owner = words_of(texts)
    words = word_hashes(joined, starts, ends)
    with np.errstate(over="ignore"):
        pairs = mix(words[:-1] * MULTIPLIER + words[1:])
    inside = owner[:-1] == owner[1:]
    grams = np.concatenate((words, pairs[inside]))
    return (grams % np.uint64(BUCKETS)).astype(np.int64), np.concatenate((owner, owner[:-1][inside]))


def _read(docs: DataFrame) -> DataFrame:
    small_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.lower("text").cast("binary").alias("text"))


def models(docs: DataFrame, target: DataFrame) -> np.ndarray:
    """Log ratio of the target's to the raw text's probability, per bucket.

    Raw counts cover all documents, target counts those whose id is in ``target``. Each task
    sends one count per bucket; the driver gets one row per bucket. One is added to each.
    """
    spark = docs.sparkSession
    drawn = target.select(F.col("doc_id").cast("long").alias("doc_id")).dropna().distinct()
    drawn = drawn.orderBy(F.xxhash64(F.lit(SEED), "doc_id"), "doc_id").limit(MAX_TARGET_DOCS)
    wanted = spark.sparkContext.broadcast(np.sort(np.array([r.doc_id for r in drawn.collect()], np.int64)))

    def run(batches):
        raw, aim = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
        for batch in batches:
            texts = text_bytes(batch.column(1))
            ids = np.array([-1 if i is None else i for i in batch.column(0).to_pylist()], np.int64)
            there = batch.column(0).is_valid().to_numpy(zero_copy_only=False) & np.isin(ids, wanted.value)
            for begin, end in chunks(texts):
                at, owner = buckets(texts[begin:end])
                raw += np.bincount(at, minlength=BUCKETS)
                aim += np.bincount(at[there[begin:end][owner]], minlength=BUCKETS)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(BUCKETS), pa.int64()), pa.array(raw), pa.array(aim)], ["bucket", "raw", "aim"]
        )

    counts = _read(docs).mapInArrow(run, "bucket long, raw long, aim long")
    rows = counts.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("aim").alias("aim")).collect()
    raw, aim = np.ones(BUCKETS), np.ones(BUCKETS)
    for r in rows:
        raw[r.bucket] += r.raw
        aim[r.bucket] += r.aim
    return np.log(aim / aim.sum()) - np.log(raw / raw.sum())


def weighed(docs: DataFrame, ratio: np.ndarray) -> DataFrame:
    """Rows (doc_id, n_grams, log_weight): the log importance weight of every whole text."""
    sent = docs.sparkSession.sparkContext.broadcast(ratio)

    def run(batches):
        for batch in batches:
            texts = text_bytes(batch.column(1))
            n, total = np.zeros(len(texts), np.int64), np.zeros(len(texts))
            for begin, end in chunks(texts):
                at, owner = buckets(texts[begin:end])
                n[begin:end] = np.bincount(owner, minlength=end - begin)
                total[begin:end] = np.bincount(owner, sent.value[at], end - begin)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n), pa.array(total)], ["doc_id", "n_grams", "log_weight"])

    return _read(docs).mapInArrow(run, "doc_id long, n_grams long, log_weight double")


def gumbel(seed: int, id: str = "doc_id") -> Column:
    """Standard Gumbel noise from a hash of the id."""
    u = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), id), 11).cast("double") + 0.5) / float(1 << 53)
    return -F.log(-F.log(u))


def kth_largest(rows: DataFrame, columns: list[str], k: int) -> list[int] | None:
    """Values of the ``k``-th largest row (from 1) by some long columns, None if there are fewer rows.

    Counts rows by 16 bits of a column at a time, among those that agree with what is known,
    so any number of rows and any ``k`` cost a few passes and 65,536 counts at most each.
    """
    found, pool, left = [], rows, k
    for column in columns:
        known = None
        for shift in (48, 32, 16, 0):
            part = F.shiftright(column, shift)
            near = pool if known is None else pool.where(F.shiftright(column, shift + 16) == known)
            counts = sorted((tuple(r) for r in near.groupBy(part).count().collect()), reverse=True)
            for known, n in counts:
                if n >= left:
                    break
                left -= n
            else:
                return None
        found.append(known)
        pool = pool.where(F.col(column) == known)
        if n == left:
            break
    return found


def resample(docs: DataFrame, target: DataFrame, share: float = 0.5, seed: int = SEED) -> DataFrame:
    """Importance resampling: (doc_id, n_grams, log_weight, kept) for every document.

    Words (letters and digits, lower case) and word pairs are hashed into buckets; the log
    weight of a text is the sum, over its n-grams, of the log ratio of their probability in
    the target documents to that in all documents. Gumbel noise, drawn from the id, is added,
    and the ``share`` of rows with the largest sums is kept: a sample without replacement
    in proportion to the weights.

    A null or blank text has no n-grams and weight 0. A null id takes the noise of null. Rows
    alike in id and weight are kept alike, so ties at the edge can add repeated rows; other
    ties go to the smaller id. No target documents leave the raw model's evenness as target;
    an empty table gives no rows. Other columns are not read.
    """
    rows = stored(weighed(docs, models(docs, target)), "weights")
    fine = F.greatest(F.lit(-2e9), F.least(F.lit(2e9), F.col("log_weight") + gumbel(seed)))
    order = F.floor(fine * float(1 << 32)).cast("long")
    rows = rows.withColumn("order", order).withColumn("before", F.bitwise_not(F.coalesce("doc_id", F.lit((1 << 63) - 1))))
    total = rows.count()
    k = int(round(total * share))
    edge = kth_largest(rows, ["order", "before"], k)
    if not k:
        kept = F.lit(False)
    elif edge is None:
        kept = F.lit(True)
    elif len(edge) == 1:
        kept = F.col("order") >= edge[0]
    else:
        kept = (F.col("order") > edge[0]) | ((F.col("order") == edge[0]) & (F.col("before") >= edge[1]))
    return rows.select("doc_id", "n_grams", "log_weight", kept.alias("kept"))
