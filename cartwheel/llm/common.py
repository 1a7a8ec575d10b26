"""Small helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.session import scratch_dir

WORD_GAP = r"[\x20\x09-\x0D]+"  # what separates words in `[^\x20\x09-\x0D]+`


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet under the shared checkpoint folder and read back.

    Cuts the lineage at a table every executor can read, so later stages neither
    repeat the work nor depend on the executors that did it.
    """
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def id_text(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The two columns the document operators read, as (doc_id bigint, text string)."""
    return df.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def words(text: str | Column) -> Column:
    """Words `[^\\x20\\x09-\\x0D]+` of a text, in order (null text: no words)."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), WORD_GAP), lambda w: w != "")


def texts(batch: pa.RecordBatch, column: str) -> list[str | None]:
    return batch.column(batch.schema.get_field_index(column)).to_pylist()


def extended(batch: pa.RecordBatch, extra: dict[str, pa.Array]) -> pa.RecordBatch:
    """The batch with further columns appended; its own columns pass untouched."""
    return pa.RecordBatch.from_arrays([*batch.columns, *extra.values()], names=[*batch.schema.names, *extra])


def batches_of(batches: Iterator[pa.RecordBatch], column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Cut batches so that each holds about ``limit`` bytes of ``column`` (one row at least)."""
    for batch in batches:
        sizes = pc.binary_length(batch.column(batch.schema.get_field_index(column))).to_pylist()
        start = held = 0
        for i, n in enumerate(sizes):
            if i > start and held + (n or 0) > limit:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += n or 0
        if start < len(sizes):
            yield batch.slice(start)
