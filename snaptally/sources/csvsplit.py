"""CSV files larger than one task: one file over many tasks, each row at its exact position.

The text source gives a file's lines by Spark's own byte-range splits. In a file whose quotes
only enclose cells, a line starts a record if the quotes before it are even in number. So the
odd lines (those with an odd number of quotes) of each split are counted, summed over the splits
before it, and then every split knows by itself where its records start:

* a split without odd or blank lines that starts outside quotes is *straight*: every line is a
  record, numbered by its place in the split. Its text is not moved;
* the lines of any other split are ordered within it (a window over one split), and a record's
  lines are put together by the record's number, whichever splits they stand in.

A record's number is the records of the splits before plus its place in its own: ``row_pos`` and
the ids made of it are those of reading the file in one piece.

The quote rule is proven per file, not assumed: each record must be cells of RFC 4180 from its
first to its last character. If all are, the records are the only reading of the file (the first
starts at its start; each next one where the one before ends). Any other file (a quote inside a
bare cell, text after a closing quote, an open quote at the end, mixed line ends, a record over
``MAX_RECORD``) is named to the caller, which reads it whole, as small files are. Cells are made
by ``from_csv`` with the options of the whole-file reader.

Null and empty cells, short and long rows: as the whole-file reader gives them (tested on both).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, DataFrameReader, Window
from pyspark.sql import functions as F

from ..session import materialise

MAX_RECORD = 64 << 20  # bytes of one record; a file with a greater one is read whole, as a stream
CELL = r'(?:"[^"]*+(?:""[^"]*+)*+"|[^",]*+)'
RECORD = rf"\A{CELL}(?:,{CELL})*+\z"
SPLIT = ["url", "block"]


def _before(of: str, window) -> Column:
    """The sum of ``of`` over the rows before this one."""
    return F.coalesce(F.sum(of).over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))


def read_records(reader: DataFrameReader, path, over: int) -> tuple[DataFrame, DataFrame, list[str]]:
    """``(records, splits, urls of files with a record over MAX_RECORD)`` of the files over ``over`` bytes.

    Records: ``url, rec`` (from 1 per file), ``text``, ``multi`` (of several lines)."""
    meta = F.col("_metadata")
    quotes = F.octet_length("value") - F.octet_length(F.replace("value", F.lit('"'), F.lit("")))
    lines = materialise(
        reader.option("lineSep", "\n").text(path).where(meta.file_size > over)
        .select(meta.file_path.alias("url"), meta.file_block_start.alias("block"),
                F.monotonically_increasing_id().alias("id"), (quotes % 2).cast("long").alias("odd"),
                F.col("value").isin("", "\r").alias("blank"), "value"), "csv-lines")
    files = Window.partitionBy("url").orderBy("block")  # one row per split of a file
    splits = (lines.groupBy(*SPLIT)
              .agg(F.min("id").alias("first"), F.count("*").alias("n"), F.sum("odd").alias("odds"),
                   F.count_if("blank").alias("blanks"), F.count_if(F.col("value") == "\r").alias("returns"))
              .withColumn("open", _before("odds", files) % 2)
              .withColumn("bent", (F.col("odds") > 0) | (F.col("blanks") > 0) | (F.col("open") > 0)))
    splits = materialise(splits, "csv-splits")
    placed = lines.join(splits.select(*SPLIT, "first", "open", "bent"), SPLIT)

    within = Window.partitionBy(*SPLIT).orderBy("id")
    bent = (placed.where("bent").withColumn("inside", (F.col("open") + _before("odd", within)) % 2 > 0)
            .where(F.col("inside") | ~F.col("blank"))
            .withColumn("k", F.sum(F.when(F.col("inside"), 0).otherwise(1)).over(
                within.rowsBetween(Window.unboundedPreceding, 0)))
            .select(*SPLIT, "id", "k", "value"))
    bent = materialise(bent, "csv-bent")
    starts = F.when(F.col("bent"), F.coalesce("k", F.lit(0))).otherwise(F.col("n"))
    splits = materialise(splits.join(bent.groupBy(*SPLIT).agg(F.max("k").alias("k")), SPLIT, "left")
                         .withColumn("starts", starts).withColumn("base", _before("starts", files)), "csv-starts")

    base = splits.select(*SPLIT, "base")
    bent = bent.join(base, SPLIT).withColumn("rec", F.col("base") + F.col("k"))
    # names of files, as many as the listing on the driver holds at most
    long = (bent.groupBy("url", "rec").agg(F.sum(F.octet_length("value") + 1).alias("size"))
            .where(F.col("size") > MAX_RECORD).select("url").distinct())
    long = [r.url for r in long.collect()]
    joined = (bent.where(~F.col("url").isin(long)).groupBy("url", "rec")
              .agg(F.sort_array(F.collect_list(F.struct("block", "id", "value"))).alias("parts"))
              .select("url", "rec", F.array_join("parts.value", "\n").alias("text"), (F.size("parts") > 1).alias("multi")))
    straight = (placed.where(~F.col("bent")).join(base, SPLIT)
                .select("url", (F.col("base") + F.col("id") - F.col("first") + 1).alias("rec"),
                        F.col("value").alias("text"), F.lit(False).alias("multi")))
    return straight.unionByName(joined), splits, long


def read_cells(records: DataFrame, splits: DataFrame, long: list[str], names: list[str],
               options: dict, cells: Column) -> tuple[DataFrame, list[str]]:
    """``(url, _id, cells of the plain files, urls of the others)``. ``cells`` makes the array of
    the columns ``names``, which are parsed with ``options``."""
    ends = F.endswith("text", F.lit("\r"))
    body = F.when(ends, F.regexp_replace("text", r"\r\z", "")).otherwise(F.col("text"))
    rows = records.select("url", F.col("rec").alias("_id"), "multi", ends.alias("cr"), body.alias("body"))
    good = F.col("body").rlike(RECORD) & ~F.col("body").rlike(r"[\r\x00]")
    schema = ", ".join(f"{c} string" for c in names)
    rows = (rows.select("url", "_id", "multi", "cr", good.alias("good"), F.from_csv("body", schema, options).alias("row"))
            .select("url", "_id", "multi", "cr", "good", "row.*"))
    stored = materialise(rows.select("url", "_id", "multi", "cr", "good", cells.alias("cells")), "csv-cells")

    blank = splits.groupBy("url").agg(F.sum("blanks").alias("blanks"), F.sum("returns").alias("returns"))
    files = (stored.groupBy("url")
             .agg(F.bool_and("good").alias("good"), F.count("*").alias("n"), F.count_if("cr").alias("crs"),
                  F.min_by("multi", "_id").alias("multi"), F.max_by("cr", "_id").alias("last")).join(blank, "url"))
    unix = (F.col("crs") == 0) & (F.col("returns") == 0)
    # the last line may have no end; the first one shows the reader which ends the file has
    windows = ((F.col("crs") >= F.col("n") - 1) & ((F.col("crs") == F.col("n")) | ~F.col("last"))
               & (F.col("blanks") == 0) & ~F.col("multi"))
    odd = files.where(~(F.col("good") & (unix | windows))).select("url")
    rest = sorted({*long, *(r.url for r in odd.collect())})
    return stored.where(~F.col("url").isin(rest)).select("url", "_id", "cells"), rest
