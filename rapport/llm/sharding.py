"""Shards of near equal size by longest-processing-time scheduling."""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rapport.sources.sinks import stored

LAW = "bytes"
# Small groups are packed by hash until a pack holds about this share of a shard, so that
# what the scheduler sees is bounded: shards * PACKS large groups and as many packs.
PACKS = 2048
# Rows of a shard are numbered in this many parts.
CELLS = 1024


def schedule(sizes: list[tuple[int, object]], shards: int) -> dict:
    """Shard of every job: largest first, each to the least-loaded shard, lowest number on ties."""
    loads = [(0, shard) for shard in range(shards)]
    where = {}
    for size, key in sorted(sizes, key=lambda job: (-job[0], job[1])):
        load, shard = loads[0]
        heapq.heapreplace(loads, (load + size, shard))
        where[key] = shard
    return where


def assign(rows: DataFrame, shards: int) -> DataFrame:
    """Add ``shard`` to rows with columns grp (long) and size; equal ``grp`` stay together.

    A group of at least 1 / (shards * PACKS) of all bytes is a job of its own; there are at
    most shards * PACKS of them. All smaller groups go by hash into shards * PACKS packs, which
    are jobs. The jobs go through the heap on the driver, and their shards back to the tasks:
    both are bounded by the parameters whatever the number of rows. ``rows`` is read twice.
    """
    spark, packs = rows.sparkSession, shards * PACKS
    groups = stored(rows.groupBy("grp").agg(F.sum("size").alias("size")), "shard-groups")
    total = groups.agg(F.sum("size")).first()[0] or 0
    large = F.col("size") * packs >= F.lit(total)
    pack = F.pmod(F.xxhash64("grp"), F.lit(packs))
    alone = groups.where(large).select(F.lit(True).alias("alone"), F.col("grp").alias("job"), "size")
    packed = groups.where(~large).groupBy(pack.alias("job")).agg(F.sum("size").alias("size"))
    jobs = alone.unionByName(packed.select(F.lit(False).alias("alone"), "job", "size")).collect()
    where = schedule([(j["size"], (j["alone"], j["job"])) for j in jobs], shards)

    def side(name: str, flag: bool) -> DataFrame:
        found = [(job, shard) for (alone, job), shard in where.items() if alone == flag]
        return F.broadcast(spark.createDataFrame(found, f"{name} long, {name}_shard int"))

    both = rows.join(side("alone", True), F.col("grp") == F.col("alone"), "left")
    both = both.join(side("packed", False), pack == F.col("packed"), "left")
    shard = F.coalesce("alone_shard", "packed_shard").alias("shard")
    return both.select(*rows.columns, shard)


def numbered(rows: DataFrame, order: list[Column]) -> DataFrame:
    """Add ``slot``: rows of a ``shard`` counted from 0 without gaps, in parts of the shard.

    A part's first number is the count of rows in the parts before it; parts number their
    own rows by ``order``. The table of parts has shards * CELLS rows at most.
    """
    rows = rows.withColumn("cell", F.pmod(F.xxhash64(*order), F.lit(CELLS)).cast("int"))
    before = Window.partitionBy("shard").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = rows.groupBy("shard", "cell").agg(F.count(F.lit(1)).alias("n"))
    cells = cells.select("shard", "cell", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    inside = F.row_number().over(Window.partitionBy("shard", "cell").orderBy(*order)) - 1
    slots = rows.withColumn("inside", inside).join(F.broadcast(cells), ["shard", "cell"])
    return slots.withColumn("slot", F.col("first") + F.col("inside")).drop("cell", "inside", "first")


def shard(docs: DataFrame, shards: int = 16) -> DataFrame:
    """Shard and slot of every row: (doc_id, size, text_crc32, law, shard, slot, grown_shard).

    The law is ``bytes``: UTF-8 bytes of the text plus 1 (null: 1) are near equal over shards
    as far as groups of equal texts, which stay together, allow; null texts are one group. A
    group larger than a shard's share has a shard with little else. Two texts whose 64-bit
    hashes agree stay together too. ``grown_shard`` is null, as the law is not ``key``.

    Every row counts, repeated rows included; a null id stays null, an empty table gives no
    rows. Columns other than doc_id and text are not read.
    """
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 1
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        size.alias("size"),
        F.crc32(F.col("text").cast("binary")).alias("text_crc32"),
        F.xxhash64("text").alias("grp"),
    )
    rows = stored(rows, "shard-rows")
    placed = stored(assign(rows, shards), "shard-placed")
    out = numbered(placed, [F.col("doc_id"), F.col("grp"), F.col("size")])
    return out.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit(LAW).alias("law"),
        "shard",
        F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
