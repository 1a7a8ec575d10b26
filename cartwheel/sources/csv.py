"""Product CSV readers.

Files are scanned as all-string columns (types are cast once, after the
union). One multi-file CSV scan maps columns by position, so each category is a
scan of its own, tagged with its name as a constant (a path carried with every row and cut
row by row costs more than the parsing), and the scans are unioned by name.
With line breaks inside fields, files are grouped by header instead: a group is one shuffle.
"""

from __future__ import annotations

import re
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.functions.scalars import null_tokens
from cartwheel.sources.csv_records import csv_records, parse_records

# Files that are not per-category data (fixed values of the reference layout).
SKIP_FILES = {"Amazon-Products.csv", "Stores.csv"}
COMBINED_CSV = "Amazon-Products.csv"
# Folders of one write partitioned by category, ``source_category=<category>.csv``: special characters stand as %XX.
PARTITION = "source_category="
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"

CSV_OPTIONS = {"header": "true", "inferSchema": "false", "mode": "PERMISSIVE", "escape": '"', "quote": '"',
               "encoding": "UTF-8"}


def _options(multi_line: bool) -> dict[str, str]:
    return CSV_OPTIONS | {"multiLine": str(multi_line).lower()}


def list_paths(spark: SparkSession, folder: str, suffix: str = ".csv") -> list[str]:
    """Top-level entries of ``folder`` ending in ``suffix`` (files, or folders of part files), sorted.

    Listing goes through Spark's file index (``binaryFile`` without its
    content column), so it works on any Hadoop file system; part files are reduced to
    their entries before anything comes back (one path per category).
    """
    base = re.escape(folder.rstrip("/").split(":", 1)[-1].lstrip("/"))
    entry = F.regexp_extract("path", rf"^(.*?{base}/+[^/]+)", 1)
    found = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
             .select(entry.alias("entry")).where(F.col("entry").endswith(suffix)).distinct())
    return sorted(r["entry"] for r in found.collect())


def _stem(name: str) -> str:
    return name.rsplit("/", 1)[-1].rsplit(".", 1)[0]


def category_of(path: str) -> str | None:
    """The category a file or folder is named for: ``<category>.csv``, or the folder ``partitionBy`` names (null: its mark)."""
    stem = _stem(path.rstrip("/"))
    if not stem.startswith(PARTITION):
        return stem
    value = unquote(stem.removeprefix(PARTITION))
    return None if value == NULL_PARTITION else value


def header_of(spark: SparkSession, path: str, multi_line: bool = True) -> tuple[str, ...]:
    """Column names of one CSV (Spark reads only its first record)."""
    return tuple(spark.read.options(**_options(multi_line)).csv(path).columns)


def _scan(spark: SparkSession, paths: list[str], multi_line: bool) -> DataFrame:
    """``multi_line`` cuts records at line breaks outside quotes (``csv_records``); without it every line is a record."""
    if multi_line:
        columns = spark.read.options(**_options(True)).csv(paths[0]).columns
        return parse_records(csv_records(spark, paths), columns)
    df = spark.read.options(**_options(False)).csv(paths)
    return df.select(*[F.col(f"`{c}`") for c in df.columns], F.col("_metadata.file_path").alias("_file"))


def _apply_null_tokens(df: DataFrame) -> DataFrame:
    return df.select(*[null_tokens(F.col(f"`{c}`")).alias(c) if c != "_file" else F.col(c) for c in df.columns])


def _tagged_scans(spark: SparkSession, paths: list[str], header_groups: bool) -> DataFrame:
    """One scan a category, every line a record, with ``source_category`` as a constant."""
    frames, schema = [], None
    for path in paths:
        reader = spark.read.options(**_options(False))
        df = (reader if schema is None else reader.schema(schema)).csv(path)
        if not header_groups:
            schema = df.schema
        frames.append(_apply_null_tokens(df).withColumn("source_category", F.lit(category_of(path)).cast("string")))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def read_category_csvs(spark: SparkSession, paths: list[str], header_groups: bool = True,
                       multi_line: bool = True) -> DataFrame:
    """S1 + S3 + U1: per-category CSVs tagged with their file stem as ``source_category``.

    ``paths`` are files (or Spark output folders) named ``<category>.csv``; without ``multi_line`` also the folders of one
    write partitioned by ``source_category``. Without ``header_groups`` every file has
    the columns of the first.
    """
    if not paths:
        raise FileNotFoundError("no category CSV files")
    if not multi_line:
        return _tagged_scans(spark, paths, header_groups)
    groups: dict[tuple[str, ...], list[str]] = {}
    for p in paths:
        groups.setdefault(header_of(spark, p, multi_line) if header_groups else (), []).append(p)
    frames = [_scan(spark, ps, multi_line) for ps in groups.values()]
    df = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    df = _apply_null_tokens(df)
    stem = F.regexp_extract(F.col("_file"), r"([^/]+)\.csv(/[^/]*)?$", 1)
    return df.withColumn("source_category", stem).drop("_file")


def read_combined_csv(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """The single combined file; ``source_category`` := main_category, else ``"All"``."""
    df = _apply_null_tokens(_scan(spark, [path], multi_line)).drop("_file")
    src = F.col("main_category") if "main_category" in df.columns else F.lit("All")
    return df.withColumn("source_category", src)


def read_products(spark: SparkSession, folder: str, skip: set[str] | None = None, multi_line: bool = True) -> DataFrame:
    """S1 with the S2 fallback: category files if any, else the combined file, else an error.

    Pass ``multi_line=False`` for folders known to have no line breaks inside fields: that saves a shuffle of the text.
    """
    skip = SKIP_FILES if skip is None else skip
    entries = list_paths(spark, folder)
    cats = [p for p in entries if p.rstrip("/").rsplit("/", 1)[-1] not in skip]
    if cats:
        return read_category_csvs(spark, cats, multi_line=multi_line)
    combined = [p for p in entries if p.rstrip("/").rsplit("/", 1)[-1] == COMBINED_CSV]
    if combined:
        return read_combined_csv(spark, combined[0], multi_line)
    raise FileNotFoundError(f"No CSV files found in {folder}")
