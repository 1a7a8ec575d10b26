"""Registered queries of the training-data operators and their SQL (where SQL can express them)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cartwheel.llm import (decontaminate, divergence, language, line_dedup, merkle, mixing, phrases, pii, secret_scan, simhash, sketches,
                           token_files, urls)
from cartwheel.llm.common import table

SPARK: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(key: str, sql: str | None = None):
    def deco(fn):
        SPARK[key] = fn
        if sql is not None:
            ORACLE[key] = sql
        return fn
    return deco


@register("op1_decontaminate", decontaminate.REPORT_SQL)
def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.decontamination_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@register("op2_fingerprints")
def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sketches.fingerprint_report(table(spark, sf_dir, "documents"))


@register("op3_urls")
def op3_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.url_report(table(spark, sf_dir, "pages"))


@register("op4_secrets")
def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secret_report(table(spark, sf_dir, "documents"))


@register("op5_pii")
def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data_report(table(spark, sf_dir, "documents"))


@register("op6_simhash")
def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_dedup_report(table(spark, sf_dir, "documents"))


@register("op7_mix")
def op7_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(table(spark, sf_dir, "documents"))


@register("op8_language")
def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.language_report(table(spark, sf_dir, "documents"))


@register("op9_lines")
def op9_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_report(table(spark, sf_dir, "documents"))


@register("op10_phrases", phrases.REPORT_SQL)
def op10_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.repeats_report(table(spark, sf_dir, "documents"))


@register("op11_merkle", merkle.REPORT_SQL)
def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest_report(table(spark, sf_dir, "documents"))


@register("op12_divergence", divergence.REPORT_SQL)
def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.divergence_report(table(spark, sf_dir, "documents"))


@register("op13_tokens")
def op13_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_report(table(spark, sf_dir, "documents"))
