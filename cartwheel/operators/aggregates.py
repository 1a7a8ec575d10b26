"""Grouped summaries (A1-A16, A23), the category join J3 and the N:1 lookups J1/J2.

Every aggregate is a ``groupBy().agg()`` with partial (map-side) aggregation,
so a hot key is combined before the shuffle. Lookups aggregate the large side
first and join afterwards, so a product holding a third of all reviews turns
into a handful of rows before it meets the join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.functions import scalars as S
from cartwheel.operators import quantiles as QT

# Reference rounding (digits) of each summary; callers may ask for more.
CATEGORY_STATS_DIGITS = {"price_mean": 2, "avg_discount_pct": 2, "avg_rating": 3}


def _round(c: Column, digits: int | None) -> Column:
    return F.round(c, digits) if digits is not None else c


def category_stats(products: DataFrame, key: str | None = None, *, price: str = "discount_price",
                   pct: str = "discount_pct", rating: str = "ratings", count: str = "no_of_ratings",
                   digits: dict[str, int | None] | None = None, median_digits: int | None = None) -> DataFrame:
    """A1: per sub-category (else source category), null keys out.

    count, min/max/mean/exact median price, mean discount, mean rating,
    sum of rating counts; ordered by count desc (key asc breaks ties).
    """
    d = {**CATEGORY_STATS_DIGITS, **(digits or {})}
    cols = set(products.columns)
    key = key or ("sub_category" if "sub_category" in cols else "source_category")
    aggs = [F.count(F.lit(1)).alias("product_count")]
    if price in cols:
        aggs += [F.min(price).alias("price_min"), F.max(price).alias("price_max"),
                 _round(F.avg(price), d["price_mean"]).alias("price_mean")]
    if pct in cols:
        aggs.append(_round(F.avg(pct), d["avg_discount_pct"]).alias("avg_discount_pct"))
    if rating in cols:
        aggs.append(_round(F.avg(rating), d["avg_rating"]).alias("avg_rating"))
    if count in cols:
        aggs.append(F.sum(count).alias("total_ratings"))
    keyed = products.where(F.col(key).isNotNull())
    out = keyed.groupBy(key).agg(*aggs)
    if price in cols:
        # Exact interpolated median without buffering a whole group (see operators.quantiles).
        med = QT.median_by(keyed, price, [key], "price_median")
        out = out.join(med.select(key, _round(F.col("price_median"), median_digits).alias("price_median")), key,
                       "left")
        head = ["product_count", "price_min", "price_max", "price_mean", "price_median"]
        out = out.select(key, *head, *[c for c in out.columns if c not in head and c != key])
    return out.orderBy(F.desc("product_count"), F.asc(key))


def avg_discount_by_category(products: DataFrame, key: str = "source_category", pct: str = "discount_pct",
                             top: int | None = 20, digits: int | None = 1, ascending: bool = False,
                             out: str = "avg_disc") -> DataFrame:
    """A3: mean of plausible discounts (0 ≤ pct ≤ 95) per category.

    Pipeline form: descending, first ``top``; dashboard form: all, ascending.
    """
    g = (products.where(F.col(pct).isNotNull() & F.col(pct).between(0, 95))
         .groupBy(key).agg(_round(F.avg(pct), digits).alias(out)))
    order = [F.asc(out) if ascending else F.desc(out), F.asc(key)]
    g = g.orderBy(*order)
    return g.limit(top) if top is not None else g


def subcategory_top(products: DataFrame, source: str = "source_category", sub: str = "sub_category",
                    price: str = "discount_price", top: int = 20, digits: int = 0) -> DataFrame:
    """A4 + C21: count and median price per (source, sub); the ``top`` largest with bar labels."""
    keyed = products.where(F.col(sub).isNotNull())
    counts = keyed.groupBy(source, sub).agg(F.count(F.lit(1)).alias("count"))
    med = QT.median_by(keyed, price, [source, sub], "median_price")
    g = (counts.join(med, [source, sub], "left")
         .select(source, sub, "count", F.round("median_price", digits).alias("median_price"))
         .orderBy(F.desc("count"), F.asc(source), F.asc(sub)).limit(top))
    return g.withColumn("label", S.bar_label(source, sub, 35))


def monthly_sentiment(reviews: DataFrame, category: str = "category", ts: str = "timestamp",
                      rating: str = "rating", digits: int | None = 3) -> DataFrame:
    """A5: per category and calendar month: mean sentiment (from the rating) and non-null count."""
    base = (reviews.select(F.col(category).alias("category"), S.month_start(ts).alias("dt"),
                           S.rating_to_sentiment(rating).alias("sentiment"))
            .where(F.col("dt").isNotNull()))
    return (base.groupBy("category", "dt")
            .agg(_round(F.avg("sentiment"), digits).alias("avg_sentiment"),
                 F.count("sentiment").alias("review_count"))
            .orderBy(F.asc_nulls_first("category"), F.asc("dt")))


def sentiment_timeline(reviews: DataFrame, month: str = "review_month", category: str = "category",
                       score: str = "sentiment_score", review_id: str = "review_id",
                       digits: int | None = None) -> DataFrame:
    """Per month and category: mean score and review count; null months and categories out."""
    base = (reviews.where(F.col(month).isNotNull() & F.col(category).isNotNull())
            .select(S.month_start(month).alias("review_month"), F.col(category).alias("category"),
                    F.col(score).alias("score"), F.col(review_id).alias("rid")))
    return (base.groupBy("review_month", "category")
            .agg(_round(F.avg("score"), digits).alias("avg_sentiment"), F.count("rid").alias("reviews"))
            .orderBy("review_month", "category"))


def topic_summary(reviews: DataFrame, topic: str = "topic_label", review_id: str = "review_id",
                  rating: str = "rating", score: str = "sentiment_score", sentiment: str | None = None,
                  digits: tuple[int | None, int | None, int | None] = (2, 2, 1)) -> DataFrame:
    """Per topic (null kept): count, mean rating, mean sentiment, share positive in %."""
    label = F.col(sentiment) if sentiment else S.sentiment_label(score)
    pos = F.when(label == F.lit("positive"), F.lit(1.0)).otherwise(F.lit(0.0))
    return (reviews.groupBy(topic)
            .agg(F.count(review_id).alias("reviews"),
                 _round(F.avg(rating), digits[0]).alias("avg_rating"),
                 _round(F.avg(score), digits[1]).alias("avg_sentiment"),
                 _round(F.avg(pos) * F.lit(100.0), digits[2]).alias("positive_share"))
            .orderBy(F.desc("reviews"), F.asc_nulls_last(topic)))


def product_category_summary(products: DataFrame, category: str = "category", pct: str = "discount_pct",
                             rating: str = "rating", product_id: str = "product_id") -> DataFrame:
    """Per category: mean discount, mean rating, product count."""
    return (products.where(F.col(category).isNotNull()).groupBy(category)
            .agg(F.avg(pct).alias("avg_discount"), F.avg(rating).alias("avg_product_rating"),
                 F.count(product_id).alias("products")))


def review_category_summary(reviews: DataFrame, category: str = "category", score: str = "sentiment_score",
                            rating: str = "rating", review_id: str = "review_id") -> DataFrame:
    """Per category: mean sentiment, mean rating, review count."""
    return (reviews.where(F.col(category).isNotNull()).groupBy(category)
            .agg(F.avg(score).alias("avg_sentiment"), F.avg(rating).alias("avg_review_rating"),
                 F.count(review_id).alias("reviews")))


def category_points(products: DataFrame, reviews: DataFrame, category: str = "category") -> DataFrame:
    """Product and review summaries joined on category (inner)."""
    p = product_category_summary(products, category)
    r = review_category_summary(reviews, category)
    return p.join(r, on=category, how="inner")


def pearson(x: str | Column, y: str | Column) -> Column:
    """Pearson r; null when undefined (one point, constant side). Rows must have both values."""
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))


def discount_sentiment_correlation(points: DataFrame, x: str = "avg_discount", y: str = "avg_sentiment",
                                   digits: int | None = None) -> DataFrame:
    """A10: one row: number of points and r over the category points (pairwise complete)."""
    p = points.where(F.col(x).isNotNull() & F.col(y).isNotNull() & ~F.isnan(x) & ~F.isnan(y))
    return p.agg(F.count(F.lit(1)).alias("n_points"), _round(pearson(x, y), digits).alias("correlation"))


def linear_trend(points: DataFrame, x: str = "avg_discount", y: str = "avg_sentiment", n_points: int = 50,
                 digits: int | None = None) -> DataFrame:
    """Least-squares line over the points and ``n_points`` evenly spaced samples min→max.

    Empty unless there are ≥ 2 finite points and x is not constant.
    """
    p = points.where(F.col(x).isNotNull() & F.col(y).isNotNull() & ~F.isnan(x) & ~F.isnan(y))
    fit = p.agg(F.count(F.lit(1)).alias("n"), F.try_divide(F.covar_pop(x, y), F.var_pop(x)).alias("slope"),
                F.avg(x).alias("mx"), F.avg(y).alias("my"), F.min(x).alias("x0"), F.max(x).alias("x1"),
                F.var_pop(x).alias("vx"))
    fit = fit.where((F.col("n") >= 2) & (F.col("vx") > 0) & F.col("slope").isNotNull())
    step = (F.col("x1") - F.col("x0")) / F.lit(float(n_points - 1))
    pts = fit.select("*", F.explode(F.sequence(F.lit(0), F.lit(n_points - 1))).alias("point"))
    xs = F.when(F.col("point") == n_points - 1, F.col("x1")).otherwise(F.col("x0") + F.col("point") * step)
    pts = pts.withColumn("x", xs)
    intercept = F.col("my") - F.col("slope") * F.col("mx")
    return pts.select(F.col("point").cast("bigint").alias("point"), _round(F.col("x"), digits).alias("x"),
                      _round(F.col("slope") * F.col("x") + intercept, digits).alias("y"),
                      _round(F.col("slope"), digits).alias("slope"), _round(intercept, digits).alias("intercept"))


def product_families(products: DataFrame, top: int = 20, sort_mode: str = "rating_desc", title: str = "title",
                     count: str = "rating_count", category: str = "category", order_key: str = "product_id",
                     max_tokens: int = 3) -> DataFrame:
    """A12 + C20 + C21: Σ rating counts per title family; top ``top``; two sort modes.

    The family's category is that of its first product by ``order_key``
    (the reference takes the first non-null in file order).
    """
    fam = (products.where(F.col(title).isNotNull() & F.col(count).isNotNull())
           .select(S.product_family(title, max_tokens).alias("family"), F.col(count).alias("rc"),
                   F.col(category).alias("cat"), F.col(order_key).alias("ok"))
           .where(F.col("family") != F.lit("")))
    g = (fam.groupBy("family")
         .agg(F.sum("rc").alias("rating_count"),
              F.min_by("cat", F.when(F.col("cat").isNotNull(), F.col("ok"))).alias("category"))
         .orderBy(F.desc("rating_count"), F.asc("family")).limit(top))
    g = g.withColumn("short_title", S.bar_label("category", "family", 55))
    if sort_mode == "category_family":
        return g.orderBy(F.asc_nulls_last("category"), F.asc("family"))
    return g.orderBy(F.desc("rating_count"), F.asc("family"))


def dedupe_first(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Keep the first row per key by ``order`` (nulls last), then by the row's own columns.

    One combinable aggregate: a key with a third of all rows is reduced before the shuffle.
    """
    def rank(columns: list[str]) -> list[Column]:
        return [x for c in columns for x in (F.col(c).isNull(), F.col(c))]

    place = F.struct(*[x.alias(f"k{i}") for i, x in enumerate(rank([*order, *df.columns]))])
    return df.groupBy(F.col(key).alias("_key")).agg(F.min_by(F.struct(*df.columns), place).alias("_row")).select("_row.*")


def review_volume(products: DataFrame, reviews: DataFrame, categories: list[str] | None,
                  categories_all: list[str] | None = None, product_id: str = "product_id",
                  month: str = "review_month", count: str = "rating_count", category: str = "category",
                  subcategory: str = "subcategory", dedupe_order: list[str] | None = None,
                  digits: int | None = None) -> DataFrame:
    """A13 (J1, J5, W4, W5): rating-count-weighted review volume per month and group.

    Each review weighs its product's rating count / the product's number of
    reviews (≥ 1) after filters. With no category choice (or all of them)
    the group is the product category; with a strict subset, only those
    product categories are kept and the group is the subcategory.

    Reviews are first counted per (product, month) with map-side combine, so
    a product with a third of all reviews becomes a few rows before the join.
    """
    subset = bool(categories) and (categories_all is None or set(categories) != set(categories_all))
    group = "prod_subcategory" if subset else "prod_category"
    lookup = dedupe_first(products.select(*dict.fromkeys([product_id, count, category, subcategory, *(dedupe_order or [])])),
                          product_id, dedupe_order or [])
    lookup = lookup.select(F.col(product_id), F.col(count).alias("rc"), F.col(category).alias("prod_category"),
                           F.col(subcategory).alias("prod_subcategory"))
    per = (reviews.where(F.col(month).isNotNull() & F.col(product_id).isNotNull())
           .groupBy(product_id, S.month_start(month).alias("month")).agg(F.count(F.lit(1)).alias("c")))
    m = per.join(lookup, on=product_id, how="left")
    if subset:
        m = m.where(F.col("prod_category").isin(list(categories)))
    m = m.where(F.col("rc").isNotNull() & F.col(group).isNotNull())
    n = F.sum("c").over(Window.partitionBy(product_id))
    m = m.withColumn("volume", F.col("c") * (F.col("rc") / F.greatest(n, F.lit(1)).cast("double")))
    return (m.groupBy("month", F.col(group).alias("group"))
            .agg(_round(F.sum("volume"), digits).alias("volume"))
            .orderBy("month", "group"))


def discount_timeline(products: DataFrame, reviews: DataFrame, product_id: str = "product_id",
                      month: str = "review_month", pct: str = "discount_pct", category: str = "category",
                      dedupe_order: list[str] | None = None, digits: int | None = None) -> DataFrame:
    """A14 (J2): mean product discount per review month and review category, with n."""
    lookup = dedupe_first(products.select(*dict.fromkeys([product_id, pct, *(dedupe_order or [])])), product_id,
                          dedupe_order or []).select(product_id, pct)
    per = (reviews.where(F.col(month).isNotNull() & F.col(category).isNotNull())
           .groupBy(product_id, S.month_start(month).alias("month"), F.col(category).alias("category"))
           .agg(F.count(product_id).alias("c")))
    m = per.join(lookup, on=product_id, how="left").where(F.col(pct).isNotNull() & ~F.isnan(pct))
    return (m.groupBy("month", "category")
            .agg(_round(F.try_divide(F.sum(F.col("c") * F.col(pct)), F.sum("c").cast("double")), digits)
                 .alias("avg_discount"), F.sum("c").alias("n"))
            .orderBy("month", "category"))


def kpis(products: DataFrame, reviews: DataFrame, topic: str = "topic_label", rating: str = "rating",
         score: str = "sentiment_score", approx: bool = False, digits: int | None = None) -> DataFrame:
    """A15 + A16: one row: products, reviews, distinct topics, mean product rating, mean sentiment.

    Both inputs are tagged and unioned, then reduced in one aggregate (no join).
    """
    p = products.select(F.lit(True).alias("_p"), F.col(rating).cast("double").alias("_r"),
                        F.lit(None).cast("string").alias("_t"), F.lit(None).cast("double").alias("_s"))
    r = reviews.select(F.lit(False).alias("_p"), F.lit(None).cast("double").alias("_r"),
                       F.col(topic).cast("string").alias("_t"), F.col(score).cast("double").alias("_s"))
    distinct = F.approx_count_distinct("_t") if approx else F.count_distinct("_t")
    return p.unionByName(r).agg(F.count_if(F.col("_p")).alias("products"),
                                F.count_if(~F.col("_p")).alias("reviews"), distinct.alias("topics"),
                                _round(F.avg("_r"), digits).alias("avg_rating"),
                                _round(F.avg("_s"), digits).alias("avg_sentiment"))


def price_bounds(products: DataFrame, price: str = "price", default: float = 1000.0) -> DataFrame:
    """Max price, default when there is none."""
    return products.agg(F.coalesce(F.max(F.col(price).cast("double")), F.lit(default)).alias("max_price"))
