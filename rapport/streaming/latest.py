"""Latest row per key, kept fresh from a stream."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from rapport.operators import latest_one
from rapport.sources import sinks

# Epochs after which the changes are folded into one state.
FOLD_EVERY = 20


# Keys are kept by an embedded store on the executors' disks, not on their heap; what changes in
# an epoch goes to the checkpoint, not the whole store.
STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Session settings for the time in which a stream starts; it keeps its own copy of them."""
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def stream_latest(
    source: DataFrame, keys: list[str], order: list[str], sink: str, checkpoint: str, fold_every: int = FOLD_EVERY
) -> StreamingQuery:
    """Stream the latest row of each changed key to ``sink``, one folder per epoch.

    The streaming state is one row per key, on disk (``STATE``); a checkpoint that began with
    another store stays with it. ``order`` lists the timestamp and then a unique column, which
    makes the latest row definite; late rows lose against the state and need no watermark.
    Every ``fold_every`` epochs the changes so far are folded into a full state of the sink. The
    state is published first; what it replaces goes only at the next fold, so a reader
    that looked just before still finds all it saw, for as long as ``fold_every`` epochs take.
    A reader sees one state and less than twice that many folders of changes on disk. A replayed
    epoch overwrites its own folder; one that was folded already is part of the state and left out.
    """
    rest = [c for c in source.columns if c not in keys and c not in order]
    row = F.struct(*order, *rest)
    latest = source.groupBy(*keys).agg(F.max(row).alias("row")).select(*keys, "row.*")
    schema = latest.schema

    def publish(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        states = sinks.numbered(spark, f"{sink}/state", "epoch")
        if states and states[-1] >= epoch:
            return
        batch.write.mode("overwrite").parquet(f"{sink}/changes/epoch={epoch}")
        if (epoch + 1) % fold_every == 0:
            read_latest(spark, sink, schema, keys).write.mode("overwrite").parquet(f"{sink}/state/epoch={epoch}")
            before = states[-1] if states else -1
            for kind in ("state", "changes"):
                for old in sinks.numbered(spark, f"{sink}/{kind}", "epoch"):
                    if old < before or (old == before and kind == "changes"):
                        sinks.delete(spark, f"{sink}/{kind}/epoch={old}")

    with settings(source.sparkSession, STATE):
        return (
            latest.writeStream.outputMode("update")
            .foreachBatch(publish)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )


def read_latest(spark: SparkSession, sink: str, schema: StructType, keys: list[str]) -> DataFrame:
    """Current state: for each key the row of its newest epoch since the last full state."""
    states = sinks.numbered(spark, f"{sink}/state", "epoch")[-1:]
    since = states[0] if states else -1
    epochs = [n for n in sinks.numbered(spark, f"{sink}/changes", "epoch") if n > since]
    paths = [f"{sink}/state/epoch={n}" for n in states] + [f"{sink}/changes/epoch={n}" for n in epochs]
    if not paths:
        return spark.createDataFrame([], schema)
    parts = [spark.read.schema(schema).parquet(p).withColumn("epoch", F.lit(n).cast("long")) for p, n in zip(paths, states + epochs)]
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    return latest_one(rows, keys, [F.col("epoch").desc()]).drop("epoch")
