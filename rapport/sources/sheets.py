"""Sheets whose own row order matters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rapport.sources.files import MISSING, read_csv
from rapport.sources.sinks import stored


def read_numbered(spark: SparkSession, path: str, schema: T.StructType, name: str = "row_no", missing: str = MISSING) -> DataFrame:
    """CSV with its own row order in column ``name``, from 1 on, through the files in order of their names.

    Every split knows its file and where in it it starts, and its rows come in order; so the
    rows are counted by split, the counts summed up in order of file and place, and a row's
    number is that of its split's first row and its place in the split. Rows are not sorted, and
    what is ordered has one row for each split. The file is read once; header and blank lines
    have no number.
    """
    place = {"_file": F.col("_metadata.file_path"), "_start": F.col("_metadata.file_block_start"), "_at": F.monotonically_increasing_id()}
    rows = stored(read_csv(spark, path, schema, missing).select("*", *[c.alias(n) for n, c in place.items()]), "numbered-rows")
    splits = rows.groupBy("_file", "_start").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    before = F.sum("_rows").over(Window.orderBy("_file", "_start").rowsBetween(Window.unboundedPreceding, -1))
    splits = splits.select("_file", "_start", (F.coalesce(before, F.lit(0)) - F.col("_first")).alias("_shift"))
    numbered = rows.join(splits, ["_file", "_start"])
    return numbered.select(*schema.names, (F.col("_at") + F.col("_shift") + 1).alias(name))
