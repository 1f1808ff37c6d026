"""Repeated status sync: each micro-batch sends only what the log lacks."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from rapport.operators import anti, split_join
from rapport.plans.sync import STATUS_KEYS
from rapport.sources import sinks

LOG_SCHEMA = "alloy_sos_id string, voting_status string, run string, epoch bigint"
# Buckets of a new log. A bucket is what an epoch reads for one of its keys.
BUCKETS = 64


def bucket_of(key: str | Column, buckets: int) -> Column:
    """Bucket of a person's id."""
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def log_folder(spark: SparkSession, log_path: str, buckets: int = BUCKETS) -> tuple[str, int]:
    """Folder below which a log keeps its buckets, and how many there are: a log keeps the number it began with."""
    known = [int(name.removeprefix("buckets=")) for name in sinks.folders(spark, log_path) if name.startswith("buckets=")]
    buckets = known[0] if known else buckets
    return f"{log_path}/buckets={buckets}", buckets


def read_log(spark: SparkSession, log_path: str, only: list[int] | None = None) -> DataFrame:
    """All statuses sent, with the run and epoch that sent them; those of some buckets if ``only`` names them.

    Other buckets are not even listed.
    """
    root, buckets = log_folder(spark, log_path)
    present = set(sinks.folders(spark, root))
    paths = [p for p in (f"bucket={b}" for b in (range(buckets) if only is None else only)) if p in present]
    if not paths:
        return spark.createDataFrame([], LOG_SCHEMA)
    rows = spark.read.schema(f"{LOG_SCHEMA}, bucket int").option("basePath", root)
    return rows.parquet(*[f"{root}/{p}" for p in paths]).drop("bucket")


def unsent(spark: SparkSession, out: DataFrame, log_path: str, sent: str, run: str, epoch: int) -> DataFrame:
    """Rows of ``out`` that neither the tag history nor any other run or epoch of the log has.

    Only the buckets in which the batch has keys are read of both. Their numbers come to the
    driver, one for each bucket at most.
    """
    root, buckets = log_folder(spark, log_path)
    touched = sorted(r.bucket for r in out.select(bucket_of("alloy_sos_id", buckets).alias("bucket")).distinct().collect())
    log = read_log(spark, log_path, touched).where((F.col("run") != run) | (F.col("epoch") < epoch))
    before = spark.read.schema("alloy_sos_id string, voting_status string, bucket int").parquet(sent)
    before = before.where(F.col("bucket").isin(touched)) if touched else before.limit(0)
    known = before.select(*STATUS_KEYS).unionByName(log.select(*STATUS_KEYS))
    return anti(out, split_join(known, out, STATUS_KEYS, "left_semi"), STATUS_KEYS)


def stream_delta(
    source: DataFrame,
    statuses: Callable[[DataFrame], DataFrame],
    present: DataFrame,
    log_path: str,
    checkpoint: str,
    buckets: int = BUCKETS,
) -> StreamingQuery:
    """Turn a stream of status rows into a log of statuses sent.

    ``statuses`` maps a micro-batch to distinct (alloy_sos_id, voting_status);
    ``present`` is what the tag history already shows, stored once for all epochs.
    Both are kept in buckets of the person's id, and an epoch reads only the buckets
    that its own keys fall in, so what it costs follows from its batch and the size of
    a bucket, not from the length of the log. Every epoch writes its own folder in each
    bucket, named by the run, which is the checkpoint's own id, and the epoch. It reads
    the other folders first, also those of earlier runs, so a replay after a lost driver
    or executor writes the same rows again in place, and a new checkpoint neither
    overwrites the log nor sends twice.
    """
    spark = source.sparkSession
    root, buckets = log_folder(spark, log_path, buckets)
    sent = sinks.scratch(spark, "present")
    known = present.select(*STATUS_KEYS).dropna("any").distinct().withColumn("bucket", bucket_of("alloy_sos_id", buckets))
    known.repartition("bucket").write.partitionBy("bucket").parquet(sent)
    # The log exists from the start, so that the first epoch can read it.
    sinks.make_folder(spark, root)

    def send(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        run = json.loads(spark.read.text(f"{checkpoint}/metadata").first().value)["id"]
        out = sinks.stored(statuses(batch).select(*STATUS_KEYS).dropna("any").distinct(), "batch")
        new = unsent(spark, out, log_path, sent, run, epoch)
        named = new.select(*STATUS_KEYS, bucket_of("alloy_sos_id", buckets).alias("bucket"), F.lit(run).alias("run"), F.lit(epoch).alias("epoch"))
        # A replay finds the same rows, and so replaces the folders that a broken attempt left.
        writer = named.repartition("bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("bucket", "run", "epoch").parquet(root)

    return (
        source.writeStream.foreachBatch(send)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
