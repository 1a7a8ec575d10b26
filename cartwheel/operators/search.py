"""Keyword search over reviews."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.functions import scalars as S
from cartwheel.operators.filters import filter_reviews


def query_terms(query: str) -> list[str]:
    """Lower-cased white-space separated terms of the query."""
    return [t for t in (query or "").lower().split() if t]


def keyword_search(reviews: DataFrame, query: str, k: int | None = None, categories: list[str] | None = None,
                   sentiments: list[str] | None = None, min_rating: float = 0.0, min_similarity: float = 0.0,
                   text: str = "review_text", topic: str = "topic_label", similarity: str = "similarity",
                   tiebreak: list[str] | None = None) -> DataFrame:
    """F9 filters, then score = +1 per term in the text, +1.5 per term in the topic, + similarity.

    An empty query ranks by similarity alone. Rows below ``min_similarity``
    (null = 0) are dropped; the ``k`` best are returned (all when ``k`` is None).
    """
    out = filter_reviews(reviews, categories, sentiments, min_rating, 0.0)
    terms = query_terms(query)
    score = S.keyword_score(text, topic, similarity, terms) if terms else F.coalesce(F.col(similarity), F.lit(0.0))
    out = out.withColumn("query_score", score).where(F.coalesce(F.col(similarity), F.lit(0.0))
                                                     >= F.lit(float(min_similarity)))
    ordered = out.orderBy(F.desc("query_score"), *[F.asc_nulls_last(c) for c in (tiebreak or [])])
    return ordered.limit(k) if k is not None else ordered
