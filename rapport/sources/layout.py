"""How tables lie in storage: events in a folder per day, edges in buckets of a key.

A filter on the day then reads the folders of those days only, and a join or a count by the
bucketed key needs no shuffle of that table.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rapport.sources import sinks


def write_by_day(df: DataFrame, root: str, day: str) -> None:
    """Replace a table by one folder per value of ``day``; other folders below ``root`` go.

    Rows of a day are brought together, so a day has few files, and a day with most of the rows
    is still written by several tasks.
    """
    df.hint("rebalance", day).write.mode("overwrite").partitionBy(day).parquet(root)


def read_by_day(spark: SparkSession, root: str, schema: StructType, first: dt.date | None = None, last: dt.date | None = None) -> DataFrame:
    """A table of ``write_by_day``, of all days or those from ``first`` to ``last``; the first column of type date is the day."""
    rows = spark.read.schema(schema).parquet(root)
    day = F.col(next(f.name for f in schema if f.dataType.typeName() == "date"))
    if first is not None:
        rows = rows.where(day >= F.lit(first))
    return rows if last is None else rows.where(day <= F.lit(last))


def refresh_days(df: DataFrame, root: str, day: str, time: str) -> list[dt.date]:
    """Bring a table of events up to date: write anew the days that have events later than all in it.

    The watermark is the table's own latest ``time``, looked up in its last folder. Days with
    later rows in ``df`` are written as a whole, others are not touched, and of ``df`` only
    rows from the watermark's day on are read to find them. An event that arrives with a time
    before the watermark is written with its day if that has a later one too; else ``write_by_day``
    is needed. Returns the days written.
    """
    spark = df.sparkSession
    days = sorted(name.removeprefix(f"{day}=") for name in sinks.folders(spark, root) if name.startswith(f"{day}=2") or name.startswith(f"{day}=1"))
    if not days:
        write_by_day(df, root, day)
        return [r[0] for r in df.select(day).distinct().orderBy(day).collect()]
    last = dt.date.fromisoformat(days[-1])
    latest = spark.read.schema(df.schema).parquet(root).where(F.col(day) == F.lit(last)).agg(F.max(time)).first()[0]
    later = df.where((F.col(day) >= F.lit(last)) & (F.col(time) > F.lit(latest)))
    new = [r[0] for r in later.select(day).distinct().orderBy(day).collect()]
    if new:
        rows = df.where((F.col(day) >= F.lit(new[0])) & F.col(day).isin(new)).hint("rebalance", day)
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(day).parquet(root)
    return new


def write_buckets(df: DataFrame, table: str, key: str, buckets: int, path: str | None = None) -> None:
    """Create or replace a catalog table whose rows lie in buckets of ``key``, sorted by it.

    Joins and counts by the key read it without a shuffle; such a join cannot be split, so this
    suits keys of which none is hot.
    """
    writer = df.repartition(buckets, key).write.mode("overwrite").format("parquet").bucketBy(buckets, key).sortBy(key)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table)
