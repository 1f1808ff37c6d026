"""One large pretty-printed JSON object, read by many tasks.

A file that maps keys to lists of records is a single JSON value, which a JSON reader hands to one
task. Its lines can be read in parallel, though: outside of strings every line opens and closes some
brackets, so the depth before a line is the sum over all lines before it, and from the depth follows
where a record begins.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rapport.schemas import ORG
from rapport.sources.sinks import files, scratch, stored

# Executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

STRING = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"'
# A sign that JSON never holds as it is.
BETWEEN = "\x01"
# What a split gives: whole records, ends and beginnings of records that go over its borders, its last name.
RECORD, HEAD, TAIL, KEY = range(4)


def _many(text: Column, letters: str) -> Column:
    return F.length(text) - F.length(F.translate(text, letters, ""))


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with their split and the brackets each opens; most have none and need no further look."""
    place = {"_file": F.col("_metadata.file_path"), "_start": F.col("_metadata.file_block_start")}
    text = spark.read.text(path).select("value", *[c.alias(n) for n, c in place.items()])
    bare = F.regexp_replace("value", STRING, "")
    any_bracket = reduce(lambda a, b: a | b, [F.contains("value", F.lit(c)) for c in "{}[]"])
    return text.withColumn("_step", F.when(any_bracket, _many(bare, "{[") - _many(bare, "}]")).otherwise(0))


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records and parts of records in the lines of each split, which come in order."""
    split = depth = key = None
    parts: list[bytes] = []
    begun, many, seen = False, 0, False
    out: list[tuple] = []

    def close(whole: bool) -> None:
        """End the record at hand."""
        nonlocal parts, many
        if parts:
            kind = (RECORD if whole else TAIL) if begun else HEAD
            text = b"".join(parts)
            out.append((split, many, kind, key if begun else None, text.rstrip().removesuffix(b",") if whole else text))
            many, parts = many + 1, []

    def end() -> None:
        close(depth is None or depth <= 2)
        if seen:
            out.append((split, many, KEY, key, None))

    def batch() -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary()]
        columns = [pa.array(c, k).cast(pa.string() if k == pa.binary() else k) for c, k in zip(zip(*out), kinds)]
        out.clear()
        return pa.RecordBatch.from_arrays(columns, ["split", "no", "kind", "key_line", "text"])

    for rows in batches:
        splits, before, steps, opens, text = rows.columns
        splits, steps = splits.to_numpy(), steps.to_numpy()
        opens = opens.to_numpy(zero_copy_only=False)
        ends = np.frombuffer(text.buffers()[1], np.int32)[text.offset : text.offset + len(text) + 1]
        data = text.buffers()[2]
        cuts = [0, *(np.flatnonzero(np.diff(splits)) + 1).tolist(), len(splits)]
        for low, high in zip(cuts[:-1], cuts[1:]):
            if low == high:
                continue
            if splits[low] != split:
                end()
                split, depth, key = int(splits[low]), before[low].as_py(), None
                begun, many, seen = False, 0, False
            sums = depth + np.cumsum(steps[low:high])
            depths = sums - steps[low:high]
            new = (depths == 2) & opens[low:high]
            names = depths == 1
            inside = new | (depths > 2)
            # Where a record begins, where lines of records end, and names of lists.
            stops = np.flatnonzero(new | names | (inside != np.concatenate(([bool(parts)], inside[:-1]))))
            for at, to in zip([0, *stops.tolist()], [*stops.tolist(), high - low]):
                if new[at] if at < high - low else False:
                    close(True)
                    begun = True
                if at == to:
                    continue
                found = data[int(ends[low + at]) : int(ends[low + to])].to_pybytes()
                if inside[at]:
                    parts.append(found)
                else:
                    close(True)
                    if names[at] and found.lstrip().startswith(b'"'):
                        key, seen = found, True
            depth = int(sums[-1])
        if out:
            yield batch()
    end()
    if out:
        yield batch()


def read_records(spark: SparkSession, path: str, record: T.StructType) -> DataFrame:
    """Rows (key, record) of files that each hold one object of lists of records.

    Lines may be indented in any way, but a record must begin on a line of its own, as pretty
    printers have it. A record is put together from its lines by one task and must fit there; a
    file of any size is read by as many tasks as it has splits. Keys with an empty list give no row.
    Files whose brackets do not match, and records that do not fit ``record``, fail the read.

    The files are read twice: for the depth that each split begins with, then for its records.
    Only the parts of records that go over the end of a split are shuffled.
    """
    lines = _lines(spark, path)
    sums = stored(lines.groupBy("_file", "_start").agg(F.sum("_step").alias("open")), "splits")
    broken = sums.groupBy("_file").agg(F.sum("open").alias("open")).where("open <> 0").first()
    if broken:
        raise ValueError(f"MALFORMED: brackets of {broken[0]} do not match")
    # One row for each split, of which there are few.
    every = Window.orderBy("_file", "_start")
    earlier = Window.partitionBy("_file").orderBy("_start").rowsBetween(Window.unboundedPreceding, -1)
    splits = stored(
        sums.select(
            "_file",
            "_start",
            F.row_number().over(every).cast("long").alias("split"),
            F.dense_rank().over(Window.orderBy("_file")).cast("long").alias("file"),
            F.coalesce(F.sum("open").over(earlier), F.lit(0)).alias("_depth"),
        ),
        "depths",
    )
    depth = F.coalesce("_depth", F.raise_error(F.lit("files were split otherwise before")).cast("long"))
    # A copy of the splits in every task: lines must keep their order.
    placed = lines.join(F.broadcast(splits), ["_file", "_start"], "left")
    opens = F.contains("value", F.lit("{")) & F.col("value").rlike(r"^\s*\{")
    rows = placed.select("split", depth.alias("depth"), F.col("_step").cast("long"), opens.alias("opens"), F.concat("value", F.lit("\n")).alias("text"))
    found = rows.mapInArrow(_pieces, "split long, no long, kind int, key_line string, text string")
    parsed = lambda text: F.from_json(text, record, {"mode": "FAILFAST"})
    complete = F.col("kind") == RECORD
    found = stored(
        found.select(
            "split", "no", "kind", "key_line", F.when(complete, parsed(F.col("text"))).alias("record"), F.when(~complete, F.col("text")).alias("text")
        ),
        "records",
    )
    # The name that goes on from earlier splits of the file.
    keys = found.where(F.col("kind") == KEY).select("split", "key_line")
    of_file = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    carried = splits.select("split", "file").join(keys, "split", "left")
    carried = stored(carried.select("split", "file", F.last("key_line", True).over(of_file).alias("_carried")), "keys")
    name = F.from_json(F.concat(F.lit("["), F.regexp_extract(F.coalesce("key_line", "_carried"), STRING, 0), F.lit("]")), "array<string>")[0]
    named = found.where(F.col("kind") != KEY).join(carried, "split").withColumn("key", name)
    # A part goes on with the last record that began before it.
    order = Window.partitionBy("file").orderBy("split", "no")
    cut = named.where(~complete).withColumn("_owner", F.sum((F.col("kind") == TAIL).cast("long")).over(order))
    ordered = F.array_sort(F.collect_list(F.struct("split", "no", "text")))
    joined = cut.groupBy("file", "_owner").agg(F.max(F.when(F.col("kind") == TAIL, F.col("key"))).alias("key"), ordered.alias("_parts"))
    joined = joined.select("key", parsed(F.array_join(F.col("_parts")["text"], "")).alias("record"))
    return named.where(complete).select("key", "record").unionByName(joined).where("key IS NOT NULL")


def read_pretty_org(spark: SparkSession, path: str) -> DataFrame:
    """Organiser JSON from pretty-printed objects, as rows (doc: map pod -> leaders), one for each leader."""
    return read_records(spark, path, ORG.valueType.elementType).select(F.create_map("key", F.array("record")).alias("doc"))


def write_pretty_org(docs: DataFrame, path: str) -> None:
    """Organiser documents as one pretty-printed object in one file, as other tools exchange it.

    Leaders are sorted and printed by many tasks. The one task that writes the file copies what
    these have printed, row by row, and holds a leader at a time.
    """
    spark = docs.sparkSession
    leaders = docs.select(F.explode("doc").alias("pod", "leaders")).select("pod", F.explode("leaders").alias("leader"))
    leaders = stored(leaders.withColumn("no", F.monotonically_increasing_id()), "leaders")
    pods = leaders.groupBy("pod").agg(F.min("no").alias("first"), F.max("no").alias("last"))
    pods = pods.crossJoin(pods.agg(F.min("pod").alias("first_pod"), F.max("pod").alias("last_pod")))
    quoted = F.regexp_extract(F.to_json(F.array("pod")), r"^\[(.*)\]$", 1)
    head = F.concat(F.when(F.col("pod") == F.col("first_pod"), "{\n").otherwise(""), quoted, F.lit(": [\n"))
    end = F.when(F.col("pod") < F.col("last_pod"), "\n],").otherwise("\n]\n}")
    pods = pods.withColumn("no", F.explode(F.array_distinct(F.array("first", "last"))))
    marks = stored(pods.select("no", F.when(F.col("no") == F.col("first"), head).alias("head"), F.when(F.col("no") == F.col("last"), end).alias("end")), "marks")
    rows = leaders.join(marks, "no", "left").orderBy("pod", "no")
    # Two blanks of an indent are a tab, which makes a sixth less to write.
    printed = F.regexp_replace(F.to_json("leader", {"pretty": "true"}), r"(?dm)(?:^|\G)  ", "\t")
    text = F.concat(F.coalesce("head", F.lit("")), printed, F.coalesce("end", F.lit(",")))
    parts = scratch(spark, "sorted")
    rows.select(text.alias("value")).write.text(parts, compression="gzip", lineSep=BETWEEN)
    # Files are numbered in order, and one that is compressed this way is read by one task.
    sorted_rows = [spark.read.text(f"{parts}/{name}", lineSep=BETWEEN) for name in files(spark, parts, "part-")]
    whole = reduce(DataFrame.unionAll, sorted_rows) if sorted_rows else spark.createDataFrame([], "value string")
    whole.coalesce(1).write.text(path)
