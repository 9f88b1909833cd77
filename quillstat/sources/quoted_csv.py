"""CSV with quoted newlines, read by many tasks per file.

A newline is inside quotes exactly if an odd number of quote marks stands before
it in its file (a doubled quote counts twice).  So

1. one scan counts the quote marks of every byte range that Spark cuts the files
   into, and a running sum per file tells which ranges begin inside quotes;
2. a second scan re-cuts each range into records in the task that reads it; what
   a range begins with of a record from before, or leaves open, is a fragment;
3. fragments (at most two a range) are put together per file, and every record
   is parsed by Spark's own CSV parser.

Only the ranges that begin inside quotes are sent to the tasks, eight bytes
each: at 128 MB a range, at most 6.4 MB for 100 TB.  The files must be quoted as RFC 4180 has it: a quote
mark inside an unquoted field would turn the sense of the quotes that follow.
Records come in no particular order, as in any scan of several tasks.
"""

from __future__ import annotations

import csv
import io
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillstat.session import ship_package

PARTS = "file string, start long, part int, header boolean, record string"
WHOLE, HEAD, TAIL = 0, 1, 2   # a record; the end of one begun in an earlier range; the beginning of one left open


def _lines(spark: SparkSession, path) -> DataFrame:
    """Physical lines with their file, the start of the byte range, and whether their quote marks are odd."""
    line = F.col("value")
    return spark.read.option("lineSep", "\n").text(path).select(
        line, F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
        ((F.length(line) - F.length(F.replace(line, F.lit('"'), F.lit("")))) % 2).alias("odd"))


def _begin_inside(lines: DataFrame) -> np.ndarray:
    """Sorted numbers of the ranges that begin inside quotes."""
    ranges = lines.groupBy("file", "start").agg((F.sum("odd") % 2).alias("odd"))
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    inside = ranges.withColumn("inside", F.sum("odd").over(before) % 2).where("inside = 1")
    return np.sort(inside.select(F.xxhash64("file", "start").alias("range")).toArrow().column("range").to_numpy())


def _recut(inside):
    def recut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        here, held, kind, header = None, [], WHOLE, False   # the range read, its unfinished lines and what they are

        def left_open():
            if not held:
                return []
            return [(*here[:2], HEAD if kind == HEAD else TAIL, header, "\n".join(held))]

        for pdf in batches:
            out = []
            for value, file, start, number, odd in zip(pdf["value"], pdf["file"], pdf["start"], pdf["range"], pdf["odd"]):
                if here is None or here[2] != number:
                    out += left_open()
                    here, held, header = (file, start, number), [], start == 0
                    at = np.searchsorted(inside.value, number)
                    open_ = bool(at < len(inside.value) and inside.value[at] == number)
                    kind = HEAD if open_ else WHOLE
                held.append(value)
                open_ ^= bool(odd)
                if not open_:
                    out.append((file, start, kind, header, "\n".join(held)))
                    held, kind, header = [], WHOLE, False
            yield pd.DataFrame(out, columns=["file", "start", "part", "header", "record"])
        yield pd.DataFrame(left_open(), columns=["file", "start", "part", "header", "record"])
    return recut


def _joined(parts: DataFrame) -> DataFrame:
    """Fragments of a record, in the order of their ranges, as one record."""
    along = Window.partitionBy("file").orderBy("start", "part").rowsBetween(Window.unboundedPreceding, 0)
    numbered = parts.where(F.col("part") != WHOLE).withColumn("n", F.sum((F.col("part") == TAIL).cast("int")).over(along))
    pieces = F.array_sort(F.collect_list(F.struct("start", "part", "record")))
    return (numbered.groupBy("file", "n").agg(F.max("header").alias("header"), pieces.alias("p"))
            .select("header", F.array_join(F.col("p.record"), "\n").alias("record")))


def _header(spark: SparkSession, lines: DataFrame) -> list[str]:
    """The names in the first record of the first file that has one."""
    for name in sorted(lines.inputFiles()):
        first, n = spark.read.option("lineSep", "\n").text(name).where("_metadata.file_block_start = 0").select("value"), 1
        while True:
            got = [r["value"] for r in first.limit(n).collect()]
            text = ""
            for k, line in enumerate(got):
                text += line if k == 0 else "\n" + line
                if text.count('"') % 2 == 0:
                    return next(csv.reader(io.StringIO(text.lstrip("﻿").rstrip("\r"), newline="")), [])
            if len(got) < n:
                break
            n *= 16
    return []


def read_quoted_csv(spark: SparkSession, path) -> DataFrame:
    """All fields as text, as ``multiLine`` reads them; files are split over tasks.

    Every file begins with the same header.  Empty lines between records are
    skipped; no file, or only empty ones, gives no rows (and without a header no
    columns).  A quote that is never closed makes the rest of its file one record.
    """
    ship_package(spark)
    lines = _lines(spark, path)
    names = _header(spark, lines)
    if not names:
        return spark.createDataFrame([], "")
    inside = spark.sparkContext.broadcast(_begin_inside(lines))
    parts = lines.withColumn("range", F.xxhash64("file", "start")).mapInPandas(_recut(inside), PARTS)
    records = parts.where(F.col("part") == WHOLE).select("header", "record").unionByName(_joined(parts))
    body = (records.where(~F.col("header")).select(F.regexp_replace("record", r"\r$", "").alias("record")).where("record != ''"))
    schema = ", ".join(f"c{i} string" for i in range(len(names)))
    return (body.select(F.from_csv("record", schema, {"escape": '"', "multiLine": "true"}).alias("r")).select("r.*").toDF(*names))
