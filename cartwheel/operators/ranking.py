"""Ranking, top-k, samples and option lists.

Group-wise top-k is written as ``row_number() <= k`` so Catalyst plans a
partial WindowGroupLimit before the shuffle; global top-k is
``orderBy().limit()`` → TakeOrderedAndProject. A unique tie-break key is
always appended to the sort (the reference leaves ties to chance).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.operators.clean import plausible_discount
from cartwheel.session import ensure_checkpointing


def _asc(cols: list[str]) -> list[Column]:
    return [F.asc_nulls_last(c) for c in cols]


def top_per_group(df: DataFrame, group: str, order: list[Column], k: int) -> DataFrame:
    """W1 core: the first ``k`` rows per group by ``order``."""
    w = Window.partitionBy(group).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= F.lit(k)).drop("_rn")


def top_deals(products: DataFrame, k: int = 5, group: str = "source_category", pct: str = "discount_pct",
              columns: list[str] | None = None, tiebreak: list[str] | None = None) -> DataFrame:
    """Per category the ``k`` highest plausible discounts (0 < pct ≤ 95).

    Output sorted by category asc, pct desc (then the tie-break key).
    """
    cols = columns or [c for c in ["source_category", "name", "actual_price", "discount_price", "discount_pct",
                                   "ratings"] if c in products.columns]
    order = [F.desc_nulls_last(pct)] + _asc(tiebreak or [])
    top = top_per_group(products.where(plausible_discount(pct)), group, order, k)
    return top.orderBy(F.asc(group), *order).select(*cols)


def top_rated(rated: DataFrame, k: int = 10, min_n: int = 100, score: str = "wilson_score",
              n: str = "no_of_ratings", columns: list[str] | None = None,
              tiebreak: list[str] | None = None) -> DataFrame:
    """Best score among products with at least ``min_n`` ratings."""
    cols = columns or ["name", "source_category", "discount_price", "ratings", "no_of_ratings", "wilson_score"]
    return (rated.where(F.col(n) >= F.lit(min_n))
            .orderBy(F.desc_nulls_last(score), *_asc(tiebreak or [])).limit(k).select(*cols))


def top_deals_global(products: DataFrame, k: int = 12, pct: str = "discount_pct", n: str = "rating_count",
                     columns: list[str] | None = None, tiebreak: list[str] | None = None) -> DataFrame:
    """By discount then rating count, both descending, nulls last."""
    cols = columns or ["title", "category", "price", "discount_pct", "rating", "rating_count"]
    return (products.orderBy(F.desc_nulls_last(pct), F.desc_nulls_last(n), *_asc(tiebreak or []))
            .limit(k).select(*cols))


def best_quality(products: DataFrame, k: int = 15, score: str = "wilson_score", columns: list[str] | None = None,
                 tiebreak: list[str] | None = None) -> DataFrame:
    """T4: by score descending, nulls last."""
    cols = columns or ["title", "category", "price", "rating", "rating_count", "wilson_score"]
    return products.orderBy(F.desc_nulls_last(score), *_asc(tiebreak or [])).limit(k).select(*cols)


def stable_sample(df: DataFrame, n: int, key: str, seed: int = 0) -> DataFrame:
    """T5: fixed-size reproducible sample: the ``n`` rows with the smallest seeded md5 of ``key``.

    Independent of partitioning and file order, and of the engine; planned as TakeOrderedAndProject.
    """
    h = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")).cast("binary"))
    return df.withColumn("_h", h).orderBy("_h", key).limit(n).drop("_h")


def top_topics(docs: DataFrame, n: int, topic: str = "topic", noise: int = -1) -> DataFrame:
    """The ``n`` largest topics, noise excluded."""
    return (docs.where(F.col(topic) != F.lit(noise)).groupBy(topic).agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.desc("count"), F.asc(topic)).limit(n))


def category_universe(products: DataFrame, reviews: DataFrame, category: str = "category") -> DataFrame:
    """Distinct non-null categories of products ∪ reviews, sorted."""
    p = products.select(F.col(category).cast("string").alias("category"))
    r = reviews.select(F.col(category).cast("string").alias("category"))
    return p.union(r).where(F.col("category").isNotNull()).distinct().orderBy("category")


def filter_options(products: DataFrame, reviews: DataFrame, categories: list[str] | None = None,
                   category: str = "category", subcategory: str = "subcategory",
                   topic: str = "topic_label") -> DataFrame:
    """U4: option lists for the product keyword and review topic pickers.

    Subcategories lower-cased and stripped, minus ``unknown``; topics stripped;
    both restricted to the chosen categories. Long form: (kind, option).
    """
    p = products.where(F.col(category).isin(list(categories))) if categories else products
    r = reviews.where(F.col(category).isin(list(categories))) if categories else reviews
    from cartwheel.functions.scalars import ustrip
    subs = (p.select(F.lower(ustrip(F.col(subcategory).cast("string"))).alias("option"))
            .where((F.col("option") != F.lit("")) & (F.col("option") != F.lit("unknown")))
            .select(F.lit("product_keyword").alias("kind"), "option"))
    tops = (r.select(ustrip(F.col(topic).cast("string")).alias("option"))
            .where(F.col("option") != F.lit(""))
            .select(F.lit("review_topic").alias("kind"), "option"))
    return subs.union(tops).distinct().orderBy("kind", "option")


def sorted_index(df: DataFrame, order: list[Column], out: str = "index") -> DataFrame:
    """0-based position of every row in a global sort, computed without a single-task window.

    ``orderBy`` range-partitions and sorts; the sorted rows are checkpointed in the shared
    folder with their partition and place, so the sizes and the positions are taken from the same sort.
    A row's position is its place inside its partition plus the sizes of the earlier
    partitions (one row per partition). The sort must be total (append a unique key) for the
    index to be reproducible.
    """
    ensure_checkpointing(df.sparkSession)
    s = (df.orderBy(*order).withColumn("_pid", F.spark_partition_id())
         .withColumn("_mid", F.monotonically_increasing_id()).checkpoint(eager=True))
    parts = s.groupBy("_pid").agg(F.min("_mid").alias("_first"), F.count(F.lit(1)).alias("_n"))
    earlier = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("_offset", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
    return (s.join(parts.drop("_n"), "_pid")
            .withColumn(out, F.col("_mid") - F.col("_first") + F.col("_offset"))
            .drop("_pid", "_mid", "_first", "_offset"))
