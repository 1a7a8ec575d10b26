"""CSV records with line breaks inside quotes, cut in parallel.

A line break ends a record only outside quotes, and whether a line starts outside depends on everything before it.
Each line is therefore a function from "starts outside / inside quotes" to "ends outside / inside". Runs of an even
number of quotes never matter. An odd run at the start of a field swaps the two states; any other odd run leaves the
text outside. So a line either swaps, keeps, or sets the state, and such functions compose in any grouping:

1. lines are read by byte range (Spark's line reader, any number of tasks a file) and numbered within their range;
2. windows within a range give each line's state under both assumptions about the range's start;
3. one row a range is composed along the file: the true starting state, and the record that is still open there;
4. one-line records pass on as they are; only the lines of longer ones are grouped and joined.

The text is shuffled once, by range. A field without a closing quote runs to the end of its file, as in any reader, and is one record.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

OUTSIDE, INSIDE = 0, 1


def _compose(swaps: Column, fixed: Column, w) -> tuple[Column, Column]:
    """Running (swap count, offset of the last fixed state) of functions given as swap parity and fixed end state or null."""
    total = F.sum(swaps).over(w)
    return total, F.last(F.pmod(fixed - total, F.lit(2)), ignorenulls=True).over(w)


def _line_function(value: Column) -> tuple[Column, Column]:
    """(swap parity, end state where the line fixes it or null) of one line."""
    odd = F.regexp_replace(value, '""', "")
    fixes = odd.rlike('[^,]"')
    tail = F.regexp_replace(odd, '(?s)^.*[^,]"', "")
    swaps = F.length(tail) - F.length(F.regexp_replace(tail, ',"', ",")) + F.startswith(tail, F.lit('"')).cast("int")
    parity = F.pmod(swaps, F.lit(2))
    return F.when(fixes, 0).otherwise(parity), F.when(fixes, parity)


def _states(lines: DataFrame) -> DataFrame:
    """Per line and assumed state of its range's start: state before and after it, and the line that starts its record."""
    within = Window.partitionBy("file", "block").orderBy("id")
    running = within.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    swaps, fixed = _line_function(F.col("value"))
    df = lines.withColumns({"_swaps": swaps, "_fixed": fixed})
    total, offset = _compose(F.col("_swaps"), F.col("_fixed"), running)
    df = df.withColumns({"line": F.row_number().over(within), "_total": total, "_offset": offset})
    blank = F.col("value") == ""
    for s in (OUTSIDE, INSIDE):
        df = df.withColumn(f"after{s}", F.pmod(F.coalesce("_offset", F.lit(s)) + F.col("_total"), F.lit(2)))
    for s in (OUTSIDE, INSIDE):
        df = df.withColumn(f"before{s}", F.lag(f"after{s}", 1, s).over(within))
    for s in (OUTSIDE, INSIDE):
        starts = F.when((F.col(f"before{s}") == OUTSIDE) & ~blank, F.col("line"))
        df = df.withColumn(f"start{s}", F.last(starts, ignorenulls=True).over(running))
    return df.drop("_swaps", "_fixed", "_total", "_offset", "id")


def _range_starts(states: DataFrame) -> DataFrame:
    """Per byte range: its starting state, the start of the record open there, and the start of the file's first record."""
    ends = states.groupBy("file", "block").agg(
        *[F.max_by(f"after{s}", "line").alias(f"after{s}") for s in (OUTSIDE, INSIDE)],
        *[F.max(f"start{s}").alias(f"last{s}") for s in (OUTSIDE, INSIDE)],
        *[F.min(f"start{s}").alias(f"first{s}") for s in (OUTSIDE, INSIDE)])
    along = Window.partitionBy("file").orderBy("block")
    running = along.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    fixes = F.col("after0") == F.col("after1")
    total, offset = _compose(F.when(fixes, 0).otherwise(F.col("after0")), F.when(fixes, F.col("after0")), running)
    df = ends.withColumns({"_total": total, "_offset": offset})
    df = df.withColumn("_after", F.pmod(F.coalesce("_offset", F.lit(OUTSIDE)) + F.col("_total"), F.lit(2)))
    df = df.withColumn("state", F.lag("_after", 1, OUTSIDE).over(along))

    def chosen(name: str) -> Column:
        line = F.when(F.col("state") == OUTSIDE, F.col(f"{name}0")).otherwise(F.col(f"{name}1"))
        return F.when(line.isNotNull(), F.struct("block", line.alias("line")))

    earlier = along.rowsBetween(Window.unboundedPreceding, -1)
    return df.select("file", "block", "state", F.last(chosen("last"), ignorenulls=True).over(earlier).alias("open"),
                     F.min(chosen("first")).over(Window.partitionBy("file")).alias("header"))


def csv_records(spark: SparkSession, paths: list[str], header: bool = True) -> DataFrame:
    """The records of the files as (file, record): texts that may hold line breaks inside quotes.

    Lines end with LF or CRLF, and a CRLF inside a record reads as LF, as in Spark's own reader; blank lines between records are skipped; with ``header`` each file's first record is left out.
    """
    meta = F.col("_metadata")
    lines = spark.read.option("lineSep", "\n").text(paths).select(
        meta["file_path"].alias("file"), meta["file_block_start"].alias("block"), F.monotonically_increasing_id().alias("id"),
        F.regexp_replace("value", r"\r\z", "").alias("value"))
    states = _states(lines)
    df = states.join(_range_starts(states), ["file", "block"])
    outside = F.col("state") == OUTSIDE

    def of(name: str) -> Column:
        return F.when(outside, F.col(f"{name}0")).otherwise(F.col(f"{name}1"))

    start = F.when(of("start").isNotNull(), F.struct("block", of("start").alias("line"))).otherwise(F.col("open"))
    df = df.select("file", "block", "line", "value", "header", start.alias("start"), of("before").alias("before"), of("after").alias("after"))
    df = df.where((F.col("before") == INSIDE) | (F.col("value") != ""))
    if header:
        df = df.where(F.col("start") != F.col("header"))
    whole = (F.col("before") == OUTSIDE) & (F.col("after") == OUTSIDE)
    joined = (df.where(~whole).groupBy("file", "start").agg(F.sort_array(F.collect_list(F.struct("block", "line", "value"))).alias("parts"))
              .select("file", F.array_join(F.col("parts.value"), "\n").alias("record")))
    return df.where(whole).select("file", F.col("value").alias("record")).unionByName(joined)


def parse_records(records: DataFrame, columns: list[str]) -> DataFrame:
    """The records' fields as string columns, and ``_file``."""
    ddl = ", ".join(f"`{c.replace('`', '``')}` STRING" for c in columns)
    row = F.from_csv("record", ddl, {"quote": '"', "escape": '"', "mode": "PERMISSIVE", "multiLine": "true"})
    return records.select(row.alias("row"), F.col("file").alias("_file")).select("row.*", "_file")
