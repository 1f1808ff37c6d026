"""Bounded outbound batches.

A status or a group may cover most people, so a key is first split into hash
buckets of a bounded expected size, and only rows of one bucket are numbered
together. The number of buckets follows the key's row count, so batch numbers and the
rows that share one change as a key grows; every row is in one batch all the same.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rapport.sources.sinks import stored

BATCHES_PER_BUCKET = 50


SLOT = ["_buckets", "_bucket", "_slot"]


def _sizes(df: DataFrame, key: str, n: int) -> DataFrame:
    """Rows and number of buckets of every key."""
    rows = df.groupBy(F.col(key).alias("_key")).agg(F.count(F.lit(1)).alias("_rows"))
    return rows.withColumn("_buckets", F.ceil(F.col("_rows") / F.lit(n * BATCHES_PER_BUCKET)))


def _slots(df: DataFrame, key: str, id: str, n: int, repeated: bool, sizes: DataFrame | None = None) -> DataFrame:
    """Rows with their bucket and their slot of ``n`` rows inside it; only those of keys in ``sizes``, if given."""
    spread = [F.col(id), F.spark_partition_id()] if repeated else [F.col(id)]
    df = df.withColumn("_spread", F.xxhash64(*spread))
    # Joined null-safe: rows come out clustered on derived columns and not on the
    # key, so the window below shuffles them by (key, bucket) and a hot key is split.
    sizes = (_sizes(df, key, n) if sizes is None else sizes).select("_key", "_buckets")
    rows = df.join(sizes, F.col(key).eqNullSafe(F.col("_key")), "inner").drop("_key")
    rows = rows.withColumn("_bucket", F.pmod("_spread", "_buckets")).drop("_spread")
    w = Window.partitionBy(key, "_bucket").orderBy(id)
    return rows.withColumn("_slot", F.floor((F.row_number().over(w) - 1) / F.lit(n)))


def _batch_no() -> Column:
    # slots interleave over the buckets, so numbers never collide
    return F.col("_slot") * F.col("_buckets") + F.col("_bucket")


def bounded_batches(df: DataFrame, key: str, id: str, n: int = 1000, repeated: bool = False) -> DataFrame:
    """Add ``batch_no``: at most ``n`` rows of one key share a number.

    Every row is kept and gets exactly one number. Numbers are unique inside a
    key but not consecutive. Set ``repeated`` when one id may occur on very many
    rows of a key: buckets then also depend on the input partition of a row, so
    copies spread out, and which batch a row lands in follows the partitioning.

    ``df`` is read twice, once to size the buckets; pass a stored table when it
    is costly to compute.
    """
    return _slots(df, key, id, n, repeated).withColumn("batch_no", _batch_no()).drop(*SLOT)


def collect_batches(
    df: DataFrame,
    key: str,
    id: str,
    item: Column,
    name: str,
    n: int = 1000,
    same: tuple[str, ...] = (),
    repeated: bool = False,
) -> DataFrame:
    """One row per batch with its items as an array of at most ``n``.

    ``same`` lists columns that are constant inside a key. Most keys fit into one
    batch and only need a grouping; rows of the others are numbered, and grouped by
    the bucket they were numbered in, which needs no further shuffle. The few keys
    that need several batches are counted and stored at once, so that their size is
    known: unless they are many, rows are told apart by a copy of them in every task
    and are shuffled once only, for the grouping. ``df`` is read three times; pass a
    stored table when it is costly to compute.
    """
    keys = list(dict.fromkeys((key, *same)))
    counted = [F.count(F.lit(1)).alias("batch_size"), F.collect_list(item).alias(name)]
    large = stored(_sizes(df, key, n).where(F.col("_rows") > n), "large-keys")
    here = F.col(key).eqNullSafe(F.col("_key"))
    one = df.join(large, here, "left_anti").groupBy(*keys).agg(*counted)
    several = _slots(df, key, id, n, repeated, large).groupBy(*keys, *SLOT).agg(*counted)
    return one.withColumn("batch_no", F.lit(0).cast("bigint")).unionByName(
        several.withColumn("batch_no", _batch_no().cast("bigint")).drop(*SLOT)
    )


def payloads(
    df: DataFrame,
    key: str,
    id: str,
    person: Column,
    n: int = 1000,
    name: str = "people",
    targets: dict[str, tuple[str, str]] | None = None,
) -> DataFrame:
    """One JSON payload per batch: ``{"name": ..., "locked": true, name: [person, ...]}``.

    ``targets`` gives the tag id a key's payloads are sent to and the tag name they
    carry; without it, or for a key it lacks, the id is null and the name is the key.
    """
    targets = targets or {}
    label = F.coalesce(*[F.when(F.col(key) == k, text) for k, (_, text) in targets.items()], F.col(key))
    tag = F.coalesce(*[F.when(F.col(key) == k, tag) for k, (tag, _) in targets.items()], F.lit(None).cast("string"))
    payload = F.struct(label.alias("name"), F.lit(True).alias("locked"), F.col("_people").alias(name))
    return collect_batches(df, key, id, person, "_people", n).select(
        key, tag.alias("tag_id"), "batch_no", "batch_size", F.to_json(payload).alias("payload_json")
    )
