"""Dashboard filters (F8-F11, F13) and id-set semi joins."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _terms(queries: list[str] | None) -> list[str]:
    return [q.strip().lower() for q in (queries or []) if q and q.strip()]


def category_filter(df: DataFrame, categories: list[str] | None, category: str = "category") -> DataFrame:
    """``isin`` unless the list is empty."""
    return df.where(F.col(category).isin(list(categories))) if categories else df


def filter_products(products: DataFrame, categories: list[str] | None = None, min_rating: float = 0.0,
                    min_discount: float = 0.0, price_range: tuple[float, float] | None = None,
                    queries: list[str] | None = None, category: str = "category", rating: str = "rating",
                    pct: str = "discount_pct", price: str = "price", title: str = "title") -> DataFrame:
    """F8: categories, min rating / discount (null counts as 0), inclusive price range,
    any term as a literal substring of the lower-cased title."""
    out = category_filter(products, categories, category)
    out = out.where(F.coalesce(F.col(rating), F.lit(0.0)) >= F.lit(float(min_rating)))
    out = out.where(F.coalesce(F.col(pct), F.lit(0.0)) >= F.lit(float(min_discount)))
    if price_range is not None:
        out = out.where(F.coalesce(F.col(price), F.lit(0.0)).between(float(price_range[0]), float(price_range[1])))
    terms = _terms(queries)
    if terms:
        text = F.lower(F.col(title).cast("string"))
        out = out.where(reduce(lambda a, b: a | b, [F.coalesce(F.contains(text, F.lit(t)), F.lit(False))
                                                     for t in terms]))
    return out


def filter_reviews(reviews: DataFrame, categories: list[str] | None = None, sentiments: list[str] | None = None,
                   min_rating: float = 0.0, min_similarity: float = 0.0, category: str = "category",
                   sentiment: str = "sentiment", rating: str = "rating", similarity: str = "similarity") -> DataFrame:
    """categories, sentiment labels, rating only when > 0, similarity (null = 0)."""
    out = category_filter(reviews, categories, category)
    if sentiments:
        out = out.where(F.col(sentiment).isin(list(sentiments)))
    if min_rating > 0:
        out = out.where(F.coalesce(F.col(rating), F.lit(0.0)) >= F.lit(float(min_rating)))
    return out.where(F.coalesce(F.col(similarity), F.lit(0.0)) >= F.lit(float(min_similarity)))


def topic_filter(reviews: DataFrame, topics: list[str] | None, topic: str = "topic_label") -> DataFrame:
    """keep reviews whose topic label is listed (no list → all)."""
    return reviews.where(F.col(topic).isin(list(topics))) if topics else reviews


def semi_join(df: DataFrame, ids: DataFrame, key: str = "product_id", ids_key: str | None = None) -> DataFrame:
    """Rows of ``df`` whose key occurs in ``ids`` (a left-semi join, never a collected list)."""
    right = ids.select(F.col(ids_key or key).alias(key))
    return df.join(right, on=key, how="left_semi")


def reviews_of_products(reviews: DataFrame, products: DataFrame, key: str = "product_id") -> DataFrame:
    """Reviews of the filtered products."""
    return semi_join(reviews, products, key)


def products_of_reviews(products: DataFrame, reviews: DataFrame, key: str = "product_id") -> DataFrame:
    """Products of the filtered reviews."""
    return semi_join(products, reviews, key)
