"""Table scans with declared schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from rapport.schemas import TABLES


def load(spark: SparkSession, root: str, name: str, schema: T.StructType | None = None) -> DataFrame:
    """Parquet table ``root/name`` with its declared schema, so no footer is read to plan."""
    return spark.read.schema(schema or TABLES[name]).parquet(f"{root}/{name}")


def stream(spark: SparkSession, path: str, schema: T.StructType, files_per_epoch: int | None = None) -> DataFrame:
    """File stream over one Parquet table, be it a folder or a single file.

    A plain path makes the file source insist on a folder; a pattern matching
    only that path does not. ``files_per_epoch`` bounds what one micro-batch reads.
    """
    reader = spark.readStream.schema(schema)
    if files_per_epoch:
        reader = reader.option("maxFilesPerTrigger", files_per_epoch)
    return reader.parquet(f"{path[:-1]}[{path[-1]}]")


def register(df: DataFrame, name: str) -> DataFrame:
    """Expose a DataFrame to SQL under a view name."""
    df.createOrReplaceTempView(name)
    return df
