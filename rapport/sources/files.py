"""CSV and nested JSON files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rapport.schemas import ID_LABEL, ORG, RESULTS, VOLUNTEERS


# Fixed value: how the statistics tools that exchange these files spell a missing value.
MISSING = "NA"


def read_csv(spark: SparkSession, path: str, schema: T.StructType, missing: str = MISSING) -> DataFrame:
    """CSV with a header row. Blank fields and ``missing`` are null, quoted blanks are ''.

    A line that does not fit the schema fails the read.
    """
    return spark.read.schema(schema).csv(path, header=True, enforceSchema=False, nullValue=missing, mode="FAILFAST")


def write_csv(df: DataFrame, path: str, missing: str = MISSING) -> None:
    """CSV with a header row that keeps null (``missing``) and '' (quoted) apart."""
    df.write.mode("overwrite").csv(path, header=True, nullValue=missing)


def read_sheet(spark: SparkSession, path: str, view: str, schema: T.StructType) -> DataFrame:
    """An exported sheet used as a table: CSV, also registered under a view name."""
    df = read_csv(spark, path, schema)
    df.createOrReplaceTempView(view)
    return df


def read_id_labels(spark: SparkSession, path: str) -> DataFrame:
    """Two-column id, label sheet without its blank rows."""
    return read_csv(spark, path, ID_LABEL).where("id IS NOT NULL AND trim(id) <> ''")


def _documents(spark: SparkSession, path: str, schema: T.DataType, whole_file: bool) -> DataFrame:
    text = spark.read.text(path, wholetext=whole_file).where("trim(value) <> ''")
    return text.select(F.from_json("value", schema, {"mode": "FAILFAST"}).alias("doc"))


def read_org(spark: SparkSession, path: str, whole_file: bool = False) -> DataFrame:
    """Organiser JSON as rows (doc: map pod -> leaders). A broken document fails the read.

    One JSON object per line lets Spark split the input; ``whole_file`` reads a
    file holding a single pretty-printed object, which one task must parse.
    """
    return _documents(spark, path, ORG, whole_file)


def read_volunteers(spark: SparkSession, path: str, whole_file: bool = False) -> DataFrame:
    """Volunteer JSON as rows (doc: struct of users), one object per line or file."""
    return _documents(spark, path, VOLUNTEERS, whole_file)


def read_results(spark: SparkSession, path: str) -> DataFrame:
    """Bulk-update responses, one JSON object per line, next to the tag they answer."""
    schema = T.StructType([T.StructField("tag", T.StringType()), *RESULTS.fields])
    return spark.read.schema(schema).json(path, mode="FAILFAST")


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write_lines(lines: DataFrame, path: str) -> None:
    """Text lines, compressed: JSON repeats its names on every line. Readers of text unpack them."""
    lines.write.text(path, compression="gzip")
