"""Report, table and log sinks.

Every write goes to a folder all executors share. ``scratch`` hands out fresh
folders under the one the session names in ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.types import StructType

from rapport.sources.files import write_csv


def scratch_root(spark: SparkSession) -> str:
    """Folder of this application's intermediate tables.

    It lies below ``spark.checkpoint.dir``. A session without that setting uses its
    warehouse folder, which executors share as well.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    root = root or spark.conf.get("spark.sql.warehouse.dir")
    return f"{root.rstrip('/')}/rapport-{spark.sparkContext.applicationId}"


def scratch(spark: SparkSession, label: str) -> str:
    """A fresh folder path for one intermediate table."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def _folder(spark: SparkSession, path: str):
    """File system and path object of a folder, whichever file system holds it."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def delete(spark: SparkSession, path: str) -> None:
    """Remove a folder."""
    files, folder = _folder(spark, path)
    files.delete(folder, True)


def make_folder(spark: SparkSession, path: str) -> None:
    """Create a folder unless it is there."""
    files, folder = _folder(spark, path)
    files.mkdirs(folder)


def folders(spark: SparkSession, root: str, finished: bool = False) -> list[str]:
    """Names of the folders below ``root``; only of those written to their end if ``finished``."""
    files, folder = _folder(spark, root)
    if not files.exists(folder):
        return []
    found = [entry.getPath() for entry in files.listStatus(folder) if entry.isDirectory()]
    done = spark._jvm.org.apache.hadoop.fs.Path
    return [p.getName() for p in found if not finished or files.exists(done(p, "_SUCCESS"))]


def files(spark: SparkSession, root: str, prefix: str) -> list[str]:
    """Names of the files in a folder that begin with ``prefix``, sorted."""
    system, folder = _folder(spark, root)
    names = [entry.getPath().getName() for entry in system.listStatus(folder) if entry.isFile()]
    return sorted(name for name in names if name.startswith(prefix))


def numbered(spark: SparkSession, root: str, key: str, finished: bool = True) -> list[int]:
    """Numbers n of the folders ``root/key=n`` that were written to the end, rising; of all if not ``finished``."""
    names = folders(spark, root, finished)
    return sorted(int(name.removeprefix(f"{key}=")) for name in names if name.startswith(f"{key}="))


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write an intermediate result that several later steps read, and read it back.

    The copy lives in shared storage, so losing an executor costs no recomputation.
    """
    return stored_at(df, scratch(df.sparkSession, label))


def stored_at(df: DataFrame, path: str) -> DataFrame:
    """``stored`` with a path of the caller's, who can delete the copy after use."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_report(
    df: DataFrame, root: str, name: str, format: str = "parquet", order: list[Column | str] | None = None
) -> str:
    """Replace one named report: clear it, then write it, sorted by ``order`` if given."""
    path = f"{root}/{name}"
    rows = df.orderBy(*order) if order else df
    if format == "csv":
        write_csv(rows, path)
    else:
        rows.write.mode("overwrite").format(format).save(path)
    return path


def save_table(df: DataFrame, table: str, path: str | None = None) -> None:
    """Create or replace a catalog table from a query; ``path`` puts it in shared storage."""
    writer = df.write.mode("overwrite").format("parquet")
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table)


# --- tables that are replaced as a whole --------------------------------------------------
#
# Versions of a table are folders ``version=n``. The last one that was written to its end is
# the table, for any session that looks: no name has to be moved, and a failed write leaves
# the table as it was.


def version_path(spark: SparkSession, root: str) -> str:
    """Folder of a table's current version; of its first one if there is none yet."""
    return f"{root}/version={max(numbered(spark, root, 'version'), default=0)}"


def read_version(spark: SparkSession, root: str, schema: StructType) -> DataFrame:
    """The table's current version."""
    return spark.read.schema(schema).parquet(version_path(spark, root))


def replace_version(spark: SparkSession, df: DataFrame, root: str, keep: int = 2) -> DataFrame:
    """Replace a table by a query, which may read it, and return the new version.

    Spark refuses to overwrite what it is reading, so the result goes to a new folder. The
    last ``keep`` versions stay, for readers that began before; older ones are removed. A
    folder that a killed writer left unfinished is passed over, and removed with the versions
    older than it. Of two writers at once the one that ends last fails and leaves nothing, as
    it may have read what the other replaced.
    """
    every = numbered(spark, root, "version", finished=False)
    done = numbered(spark, root, "version")
    path = f"{root}/version={max(every, default=-1) + 1}"
    df.write.parquet(path)
    others = [n for n in numbered(spark, root, "version") if n not in done and f"{root}/version={n}" != path]
    if others:
        delete(spark, path)
        raise RuntimeError(f"version {others[-1]} of {root} was written meanwhile")
    kept = done[len(done) + 1 - keep :] if keep > 1 else []
    for old in every:
        if old not in kept and (old in done or old < min(kept, default=max(every) + 1)):
            delete(spark, f"{root}/version={old}")
    return spark.read.schema(df.schema).parquet(path)


def append_log(df: DataFrame, root: str, day: str | None = None) -> None:
    """Append rows to a log's current version, a folder per log day if ``day`` names a column."""
    writer = df.write.mode("append")
    if day:
        writer = writer.partitionBy(day)
    writer.parquet(version_path(df.sparkSession, root))


def compact_log(spark: SparkSession, root: str, schema: StructType, keys: list[str]) -> DataFrame:
    """Rewrite a log without repeated keys; later appends go to the new version.

    Appenders must pause meanwhile: what they add to the old version is not carried over.
    """
    return replace_version(spark, read_version(spark, root, schema).select(*keys).distinct(), root)


def route(df: DataFrame, by: str, path: str) -> None:
    """Send one result to a folder per value in a single pass over it.

    Rows keep their tasks, so a value holding most rows is written by many tasks.
    """
    df.write.mode("overwrite").partitionBy(by).parquet(path)
