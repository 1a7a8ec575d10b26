"""Histograms and bounds.

Bins are computed as column arithmetic and counted with ``groupBy`` — no
array is split out per category (A24 is absorbed). Per-group ranges are a
small aggregate joined back; its size is the number of groups, and AQE
broadcasts it only when its measured size is under the threshold.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwheel.functions import scalars as S
from cartwheel.operators.quantiles import grouped_quantiles


def _edge(lo: Column, hi: Column, i: Column, bins: int) -> Column:
    return lo + i.cast("double") * ((hi - lo) / F.lit(float(bins)))


def equal_width_histogram(df: DataFrame, value: str | Column, group: str, bins: int,
                          digits: int | None = None) -> DataFrame:
    """Per-group equal-width histogram between the group's own min and max (last bin closed).

    A group whose values are all equal gets the range (v − 0.5, v + 0.5), as
    NumPy does. Output: group, bin, lower, upper, count (empty bins omitted).
    """
    v = df.select(F.col(group).alias("g"), (S.col_of(value) if not isinstance(value, str) else F.col(value))
                  .cast("double").alias("v")).where(F.col("v").isNotNull())
    rng = v.groupBy("g").agg(F.min("v").alias("mn"), F.max("v").alias("mx"))
    rng = rng.select("g", F.when(F.col("mn") == F.col("mx"), F.col("mn") - F.lit(0.5)).otherwise(F.col("mn"))
                     .alias("lo"),
                     F.when(F.col("mn") == F.col("mx"), F.col("mx") + F.lit(0.5)).otherwise(F.col("mx"))
                     .alias("hi"))
    j = v.join(rng, on="g", how="inner")
    raw = F.floor((F.col("v") - F.col("lo")) * (F.lit(float(bins)) / (F.col("hi") - F.col("lo"))))
    j = j.withColumn("bin", F.least(raw, F.lit(bins - 1)).cast("int"))
    out = j.groupBy("g", "bin", "lo", "hi").agg(F.count(F.lit(1)).alias("count"))
    lower, upper = _edge(F.col("lo"), F.col("hi"), F.col("bin"), bins), \
        _edge(F.col("lo"), F.col("hi"), F.col("bin") + 1, bins)
    if digits is not None:
        lower, upper = F.round(lower, digits), F.round(upper, digits)
    return (out.select(F.col("g").alias(group), F.col("bin").cast("bigint").alias("bin"),
                       lower.alias("lower"), upper.alias("upper"), "count")
            .orderBy(group, "bin"))


def price_histogram(products: DataFrame, group: str = "source_category", price: str = "discount_price",
                    bins: int = 40, digits: int | None = None) -> DataFrame:
    """A17 + C9: log10(max(price, 1)) of positive prices, ``bins`` bins per category."""
    p = products.where(F.col(price).isNotNull() & (F.col(price) > F.lit(0)))
    p = p.select(group, S.log10_clipped(price).alias("log_price"))
    return equal_width_histogram(p, "log_price", group, bins, digits)


def length_histogram(docs: DataFrame, group: str = "category", length: str = "text_len", bins: int = 50,
                     digits: int | None = None) -> DataFrame:
    """log10(max(length, 1)) per category, ``bins`` bins."""
    d = docs.select(group, S.log10_clipped(length).alias("log_len"))
    return equal_width_histogram(d, "log_len", group, bins, digits)


def fixed_histogram(df: DataFrame, value: str, group: str, lo: float, hi: float, bins: int) -> DataFrame:
    """Fixed equal-width bins on [lo, hi]; out-of-range values dropped; last bin closed."""
    norm = float(bins) / (hi - lo)
    v = df.where(F.col(value).isNotNull() & F.col(value).between(lo, hi))
    b = F.least(F.floor((F.col(value) - F.lit(lo)) * F.lit(norm)), F.lit(bins - 1)).cast("bigint")
    return (v.groupBy(group, b.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
            .orderBy(group, "bin"))


def rating_histogram(products: DataFrame, group: str = "source_category", rating: str = "ratings",
                     lo: float = 1.0, hi: float = 5.0, bins: int = 29) -> DataFrame:
    """30 edges from 1 to 5 (29 bins)."""
    return fixed_histogram(products, rating, group, lo, hi, bins)


def rating_histogram_01(products: DataFrame, group: str = "category", rating: str = "rating") -> DataFrame:
    """Ratings rounded to 0.1, counted per category (bins 1.0 … 5.0)."""
    r = F.round(F.col(rating), 1)
    return (products.where(F.col(rating).isNotNull() & (r >= F.lit(1.0)) & (r < F.lit(5.05)))
            .groupBy(group, r.alias("rating_01")).agg(F.count(F.lit(1)).alias("count"))
            .orderBy(group, "rating_01"))


def star_distribution(reviews: DataFrame, group: str = "category", rating: str = "rating") -> DataFrame:
    """Counts of int(rating) for 1..5 per category, zeros shown (one wide row per category)."""
    star = F.col(rating).cast("double").cast("bigint")
    return (reviews.where(F.col(rating).isNotNull()).groupBy(group)
            .agg(*[F.count_if(star == F.lit(s)).alias(f"stars_{s}") for s in range(1, 6)])
            .orderBy(group))


def percentile_bounds(df: DataFrame, value: str, lo_pct: float = 1.0, hi_pct: float = 99.0,
                      pad: float = 0.03, digits: int | None = None) -> DataFrame:
    """Exact interpolated percentiles of ``value`` padded by ``pad`` of their span (one row)."""
    q = grouped_quantiles(df, value, [], [lo_pct / 100.0, hi_pct / 100.0], names=["_lo", "_hi"])
    lo, hi = F.col("_lo"), F.col("_hi")
    span = (hi - lo) * F.lit(pad)
    out = [lo - span, hi + span]
    if digits is not None:
        out = [F.round(c, digits) for c in out]
    return q.select(out[0].alias("lower"), out[1].alias("upper"))
