"""Corpus pipeline: documents in, a source mix of clean, distinct, decontaminated documents out.

``STAGES`` are (name, function) pairs; each function takes (spark, docs, sf_dir), works
on all the rows its predecessor kept, and returns the columns of ``docs`` (the
last one appends the mix). ``run`` writes each stage as Parquet under the shared
checkpoint folder and rereads it as the next one's documents. Every stage keeps
extra columns, takes empty tables, and treats null ids, null texts and repeated rows as
the operator it calls says.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.llm import decontaminate, language, line_dedup, mixing, simhash
from cartwheel.llm.common import staged, table
from cartwheel.session import configure

#: SQL cannot express trained models, patience alignment or SimHash: the tests hold the stages against plain code.
ORACLE_SQL = None

HAS_WORD = r"[^\x20\x09-\x0D]"


def counted(docs: DataFrame) -> DataFrame:
    """``n_chars``, where the table has it, follows the text."""
    return docs.withColumn("n_chars", F.char_length("text").cast("bigint")) if "n_chars" in docs.columns else docs


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a letter: the model gives each of them some language. Without labelled rows there is no model, and they stay too."""
    configure(spark)
    model = language.fit(docs.where(~language.held_out()))
    if not model.langs:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    found = language.identify(docs, model, lang_out="__lang_pred", score_out="__lang_score")
    return found.where(F.col("__lang_pred") != language.UNDETERMINED).select(*docs.columns)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the line blocks an earlier document has; documents that were nothing else go."""
    configure(spark)
    found = line_dedup.dedup_lines(docs, spans_out="__removed_lines")
    emptied = (F.size("__removed_lines") > 0) & ~F.coalesce(F.col("text").rlike(HAS_WORD), F.lit(False))
    return counted(found.where(~emptied)).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component (shingles of 4 words, at most 4 differing bits)."""
    configure(spark)
    return simhash.keep_one(docs)


def decontaminate_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages of the benchmark; documents that were nothing else go."""
    configure(spark)
    return counted(decontaminate.remove_benchmark(docs, table(spark, sf_dir, "benchmark"))).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents the mix draws from, with size, source_size, target and the words taken of each."""
    configure(spark)
    return mixing.mixed_documents(docs)


STAGES = [
    ("language", identify_language),
    ("lines", dedup_lines),
    ("near_duplicates", drop_near_duplicates),
    ("benchmark", decontaminate_texts),
    ("mix", mix_sources),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
