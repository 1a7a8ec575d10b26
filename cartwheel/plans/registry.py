"""Driver-facing query catalogue: one Spark plan and one DuckDB oracle per key.

Each Spark callable takes ``(spark, sf_dir)`` and returns a lazy DataFrame
over the whole driver tables. Oracles are self-contained SQL over the
pre-registered base tables; fixture views are inlined as CTEs.

Oracle parity (SURVEY §7.4): floating averages and sums are rounded to 6
digits on both sides because the engines add in different orders; the
operators' own defaults keep the reference's rounding.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.functions import scalars as S
from cartwheel.operators import aggregates as A
from cartwheel.operators import clean as C
from cartwheel.operators import filters as FL
from cartwheel.operators import histograms as H
from cartwheel.operators import ranking as R
from cartwheel.plans import views as V

Q = Callable[[SparkSession, str], DataFrame]
SPARK: dict[str, Q] = {}
ORACLE: dict[str, str] = {}

D6 = 6  # oracle parity digits
Z2 = repr(S.WILSON_Z * S.WILSON_Z)
OFFER_TIEBREAK = ["l_orderkey", "l_linenumber", "product_id", "l_suppkey", "actual_price", "discount_price"]
DEFAULT_CATEGORIES = ["ECONOMY", "LARGE", "MEDIUM"]  # first three of the category universe


def register(key: str, sql: str | None = None):
    def deco(fn: Q) -> Q:
        SPARK[key] = fn
        if sql is not None:
            ORACLE[key] = sql
        return fn
    return deco


# ---- shared inputs ---------------------------------------------------------

def products(spark: SparkSession, sf: str) -> DataFrame:
    """Clean products: the offers view through F1's derivations (C4)."""
    return C.with_discounts(V.offers(spark, sf))


PRODUCTS_CTE = ("products AS (SELECT *, round((actual_price - discount_price) / nullif(actual_price, 0) "
                "* CAST(100 AS DOUBLE), 2) AS discount_pct, actual_price - discount_price AS savings FROM offers)")


def with_products(sql: str, *extra: str) -> str:
    ctes = [f"offers AS ({V.OFFERS_SQL})", PRODUCTS_CTE] + [f"{n} AS ({V.VIEW_SQL[n]})" for n in extra]
    return "WITH " + ",\n".join(ctes) + "\n" + sql


def dash_products(spark: SparkSession, sf: str) -> DataFrame:
    """Dashboard products: product_dim plus the rating score (null where undefined)."""
    p = V.product_dim(spark, sf)
    return p.withColumn("wilson_score", F.when(C.rated("rating_count", "rating"),
                                               S.wilson_center("rating", "rating_count")))


def dash_reviews(spark: SparkSession, sf: str) -> DataFrame:
    """Dashboard reviews: reviews_v with the sentiment label (C8) and month (C17)."""
    r = V.reviews_v(spark, sf)
    return r.withColumns({"sentiment": S.sentiment_label("sentiment_score"), "review_month": F.col("review_ts")})


WILSON_SQL = (f"round((rating / CAST(5 AS DOUBLE) + {Z2}::DOUBLE / (CAST(2 AS DOUBLE) * CAST(rating_count AS DOUBLE))) "
              f"/ (CAST(1 AS DOUBLE) + {Z2}::DOUBLE / CAST(rating_count AS DOUBLE)), 4)")
DASH_PRODUCTS_CTE = (f"dp AS (SELECT *, CASE WHEN rating_count IS NOT NULL AND rating_count > 0 AND rating IS NOT NULL "
                     f"THEN {WILSON_SQL} END AS wilson_score FROM product_dim)")
SENT_SQL = ("CASE WHEN sentiment_score > 0.18::DOUBLE THEN 'positive' WHEN sentiment_score < -0.18::DOUBLE "
            "THEN 'negative' ELSE 'neutral' END")
DASH_REVIEWS_CTE = f"dr AS (SELECT *, {SENT_SQL} AS sentiment, review_ts AS review_month FROM reviews_v)"


def with_dash(sql: str) -> str:
    ctes = [f"product_dim AS ({V.PRODUCT_DIM_SQL})", f"reviews_v AS ({V.REVIEWS_V_SQL})",
            DASH_PRODUCTS_CTE, DASH_REVIEWS_CTE]
    return "WITH " + ",\n".join(ctes) + "\n" + sql


# ---- A1/A2: category statistics ----------------------------------------------

@register("category_stats", with_products(f"""
SELECT sub_category, count(*) AS product_count, min(discount_price) AS price_min, max(discount_price) AS price_max,
       round(avg(discount_price), {D6}) AS price_mean, round(median(discount_price), {D6}) AS price_median,
       round(avg(discount_pct), {D6}) AS avg_discount_pct, round(avg(ratings), {D6}) AS avg_rating,
       CAST(sum(no_of_ratings) AS BIGINT) AS total_ratings
FROM products WHERE sub_category IS NOT NULL GROUP BY sub_category"""))
def q_category_stats(spark, sf):
    return A.category_stats(products(spark, sf), digits={k: D6 for k in A.CATEGORY_STATS_DIGITS}, median_digits=D6)


# A2 is A1 with the lower median (the value at rank n/2, as the sketch returns it) instead of the interpolated one.
@register("category_stats_sql", ORACLE["category_stats"].replace(
    f"round(median(discount_price), {D6})", "quantile_disc(discount_price, 0.5)"))
def q_category_stats_sql(spark, sf):
    from cartwheel.plans.sql import category_stats_sql
    products(spark, sf).createOrReplaceTempView("products")
    return category_stats_sql(spark, "products", digits=D6)


# ---- W1/W2: top deals ------------------------------------------------------

TOP_DEALS_ORACLE = with_products("""
SELECT source_category, name, actual_price, discount_price, discount_pct, ratings FROM (
  SELECT *, row_number() OVER (PARTITION BY source_category ORDER BY discount_pct DESC NULLS LAST,
            l_orderkey, l_linenumber, product_id, l_suppkey, actual_price, discount_price) AS rn
  FROM products WHERE discount_pct > 0 AND discount_pct <= 95) t
WHERE rn <= 5""")


@register("top_deals", TOP_DEALS_ORACLE)
def q_top_deals(spark, sf):
    return R.top_deals(products(spark, sf), k=5, tiebreak=OFFER_TIEBREAK)


@register("top_deals_sql", TOP_DEALS_ORACLE)
def q_top_deals_sql(spark, sf):
    from cartwheel.plans.sql import top_deals_sql
    products(spark, sf).createOrReplaceTempView("products")
    return top_deals_sql(spark, "products", k=5, tiebreak=OFFER_TIEBREAK)


# ---- C5/C6/F5/T2-T4: scores and global top-k ----------------------------------

@register("wilson_scores", with_dash(f"""
SELECT product_id, rating, rating_count, {WILSON_SQL} AS wilson_score,
       round((rating / CAST(5 AS DOUBLE) + {Z2}::DOUBLE / (CAST(2 AS DOUBLE) * CAST(rating_count AS DOUBLE))
              - {S.WILSON_Z!r}::DOUBLE * sqrt(rating / CAST(5 AS DOUBLE) * (CAST(1 AS DOUBLE) - rating / CAST(5 AS DOUBLE))
                / CAST(rating_count AS DOUBLE) + {Z2}::DOUBLE / (CAST(4 AS DOUBLE) * CAST(rating_count AS DOUBLE)
                * CAST(rating_count AS DOUBLE))))
             / (CAST(1 AS DOUBLE) + {Z2}::DOUBLE / CAST(rating_count AS DOUBLE)), 4) AS wilson_lower,
       least(greatest(rating / CAST(5 AS DOUBLE) * (CAST(1 AS DOUBLE) - CAST(1 AS DOUBLE)
             / sqrt(CAST(rating_count AS DOUBLE))), CAST(0 AS DOUBLE)), CAST(1 AS DOUBLE)) AS quality
FROM product_dim WHERE rating_count IS NOT NULL AND rating_count > 0 AND rating IS NOT NULL"""))
def q_wilson_scores(spark, sf):
    p = V.product_dim(spark, sf).where(C.rated("rating_count", "rating"))
    return p.select("product_id", "rating", "rating_count",
                    S.wilson_center("rating", "rating_count").alias("wilson_score"),
                    S.wilson_lower("rating", "rating_count").alias("wilson_lower"),
                    S.damped_quality("rating", "rating_count").alias("quality"))


@register("top_rated", with_dash("""
SELECT title, category, price, rating, rating_count, wilson_score FROM dp
WHERE wilson_score IS NOT NULL AND rating_count >= 100
ORDER BY wilson_score DESC, product_id LIMIT 10"""))
def q_top_rated(spark, sf):
    p = dash_products(spark, sf).where(F.col("wilson_score").isNotNull())
    return R.top_rated(p, k=10, min_n=100, n="rating_count", tiebreak=["product_id"],
                       columns=["title", "category", "price", "rating", "rating_count", "wilson_score"])


@register("best_quality", with_dash("""
SELECT title, category, price, rating, rating_count, wilson_score FROM dp
ORDER BY wilson_score DESC NULLS LAST, product_id LIMIT 15"""))
def q_best_quality(spark, sf):
    return R.best_quality(dash_products(spark, sf), k=15, tiebreak=["product_id"])


@register("top_deals_global", with_dash("""
SELECT title, category, price, discount_pct, rating, rating_count FROM dp
ORDER BY discount_pct DESC NULLS LAST, rating_count DESC NULLS LAST, product_id LIMIT 12"""))
def q_top_deals_global(spark, sf):
    return R.top_deals_global(dash_products(spark, sf), k=12, tiebreak=["product_id"])


# ---- A3/A4: category bars ---------------------------------------------------

@register("avg_discount_top20", with_products(f"""
SELECT source_category, round(avg(discount_pct), {D6}) AS avg_disc FROM products
WHERE discount_pct IS NOT NULL AND discount_pct >= 0 AND discount_pct <= 95
GROUP BY source_category ORDER BY avg_disc DESC, source_category LIMIT 20"""))
def q_avg_discount_top20(spark, sf):
    return A.avg_discount_by_category(products(spark, sf), top=20, digits=D6)


@register("subcategory_top20", with_products("""
SELECT source_category, sub_category, count(*) AS count, round(median(discount_price), 0) AS median_price,
       concat('[', substr(source_category, 1, 3), '] ', substr(sub_category, 1, 35)) AS label
FROM products WHERE sub_category IS NOT NULL GROUP BY source_category, sub_category
ORDER BY count DESC, source_category, sub_category LIMIT 20"""))
def q_subcategory_top20(spark, sf):
    return A.subcategory_top(products(spark, sf), top=20)


# ---- A17-A23: histograms and bounds -----------------------------------------

def _hist_sql(source: str, group: str, value: str, bins: int) -> str:
    return f"""
v AS (SELECT {group} AS g, CAST({value} AS DOUBLE) AS v FROM {source} WHERE {value} IS NOT NULL),
r0 AS (SELECT g, min(v) AS mn, max(v) AS mx FROM v GROUP BY g),
r AS (SELECT g, CASE WHEN mn = mx THEN mn - 0.5::DOUBLE ELSE mn END AS lo,
             CASE WHEN mn = mx THEN mx + 0.5::DOUBLE ELSE mx END AS hi FROM r0),
b AS (SELECT v.g, lo, hi, CAST(least(floor((v - lo) * (CAST({bins} AS DOUBLE) / (hi - lo))), {bins - 1}) AS BIGINT) AS bin
      FROM v JOIN r ON v.g = r.g)
SELECT g AS {group}, bin, round(lo + CAST(bin AS DOUBLE) * ((hi - lo) / CAST({bins} AS DOUBLE)), {D6}) AS lower,
       round(lo + CAST(bin + 1 AS DOUBLE) * ((hi - lo) / CAST({bins} AS DOUBLE)), {D6}) AS upper, count(*) AS count
FROM b GROUP BY g, bin, lo, hi"""


@register("price_histogram", with_products(
    ", lp AS (SELECT source_category, log10(greatest(discount_price, CAST(1 AS DOUBLE))) AS log_price FROM products "
    "WHERE discount_price IS NOT NULL AND discount_price > 0),"
    + _hist_sql("lp", "source_category", "log_price", 40)).replace("\n,", ","))
def q_price_histogram(spark, sf):
    return H.price_histogram(products(spark, sf), bins=40, digits=D6)


@register("rating_histogram", with_products("""
SELECT source_category, CAST(least(floor((ratings - CAST(1 AS DOUBLE)) * CAST(7.25 AS DOUBLE)), 28) AS BIGINT) AS bin,
       count(*) AS count
FROM products WHERE ratings IS NOT NULL AND ratings BETWEEN 1 AND 5 GROUP BY 1, 2"""))
def q_rating_histogram(spark, sf):
    return H.rating_histogram(products(spark, sf))


@register("rating_histogram_01", with_dash("""
SELECT category, round(rating, 1) AS rating_01, count(*) AS count FROM product_dim
WHERE rating IS NOT NULL AND round(rating, 1) >= 1.0 AND round(rating, 1) < 5.05 GROUP BY 1, 2"""))
def q_rating_histogram_01(spark, sf):
    return H.rating_histogram_01(V.product_dim(spark, sf))


@register("length_histogram", "WITH ld AS (SELECT lang AS category, log10(greatest(CAST(length(text) AS DOUBLE), "
          "CAST(1 AS DOUBLE))) AS log_len FROM documents WHERE text IS NOT NULL),"
          + _hist_sql("ld", "category", "log_len", 50))
def q_length_histogram(spark, sf):
    d = V.table(spark, sf, "documents").where(F.col("text").isNotNull())
    d = d.select(F.col("lang").alias("category"), S.text_length("text").alias("text_len"))
    return H.length_histogram(d, bins=50, digits=D6)


@register("star_distribution", with_dash("""
SELECT category, """ + ", ".join(f"count(*) FILTER (WHERE CAST(trunc(rating) AS BIGINT) = {s}) AS stars_{s}"
                                  for s in range(1, 6)) + """
FROM reviews_v WHERE rating IS NOT NULL GROUP BY category"""))
def q_star_distribution(spark, sf):
    return H.star_distribution(V.reviews_v(spark, sf))


@register("percentile_bounds", with_products(f"""
, q AS (SELECT quantile_cont(discount_price, 0.01) AS lo, quantile_cont(discount_price, 0.99) AS hi FROM products)
SELECT round(lo - (hi - lo) * 0.03::DOUBLE, {D6}) AS lower, round(hi + (hi - lo) * 0.03::DOUBLE, {D6}) AS upper FROM q
""").replace("\n, q AS", ", q AS"))
def q_percentile_bounds(spark, sf):
    return H.percentile_bounds(products(spark, sf), "discount_price", digits=D6)


@register("price_bounds", with_dash("SELECT coalesce(max(price), 1000.0::DOUBLE) AS max_price FROM product_dim"))
def q_price_bounds(spark, sf):
    return A.price_bounds(V.product_dim(spark, sf))


# ---- A5-A7, A15, U3, U4: review summaries -------------------------------------

@register("monthly_sentiment", with_dash(f"""
SELECT category, CAST(date_trunc('month', review_ts) AS DATE) AS dt,
       round(avg(least(greatest((rating - CAST(3 AS DOUBLE)) / CAST(2 AS DOUBLE), CAST(-1 AS DOUBLE)), CAST(1 AS DOUBLE))), {D6})
       AS avg_sentiment, count(rating) AS review_count
FROM reviews_v WHERE review_ts IS NOT NULL GROUP BY 1, 2"""))
def q_monthly_sentiment(spark, sf):
    return A.monthly_sentiment(V.reviews_v(spark, sf), ts="review_ts", digits=D6)


@register("sentiment_timeline", with_dash(f"""
SELECT CAST(date_trunc('month', review_ts) AS DATE) AS review_month, category,
       round(avg(sentiment_score), {D6}) AS avg_sentiment, count(review_id) AS reviews
FROM reviews_v WHERE review_ts IS NOT NULL AND category IS NOT NULL GROUP BY 1, 2"""))
def q_sentiment_timeline(spark, sf):
    return A.sentiment_timeline(dash_reviews(spark, sf), digits=D6)


@register("topic_summary", with_dash(f"""
SELECT topic_label, count(review_id) AS reviews, round(avg(rating), {D6}) AS avg_rating,
       round(avg(sentiment_score), {D6}) AS avg_sentiment,
       round(avg(CASE WHEN sentiment = 'positive' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) * 100.0::DOUBLE, {D6})
       AS positive_share
FROM dr GROUP BY topic_label"""))
def q_topic_summary(spark, sf):
    return A.topic_summary(dash_reviews(spark, sf), sentiment="sentiment", digits=(D6, D6, D6))


@register("kpis", with_dash(f"""
SELECT (SELECT count(*) FROM product_dim) AS products, (SELECT count(*) FROM reviews_v) AS reviews,
       (SELECT count(DISTINCT topic_label) FROM reviews_v) AS topics,
       (SELECT round(avg(rating), {D6}) FROM product_dim) AS avg_rating,
       (SELECT round(avg(sentiment_score), {D6}) FROM reviews_v) AS avg_sentiment"""))
def q_kpis(spark, sf):
    return A.kpis(V.product_dim(spark, sf), V.reviews_v(spark, sf), digits=D6)


@register("category_universe", with_dash("""
SELECT DISTINCT category FROM (SELECT category FROM product_dim UNION ALL SELECT category FROM reviews_v) u
WHERE category IS NOT NULL"""))
def q_category_universe(spark, sf):
    return R.category_universe(V.product_dim(spark, sf), V.reviews_v(spark, sf))


@register("filter_options", with_dash(f"""
SELECT DISTINCT kind, option FROM (
  SELECT 'product_keyword' AS kind, lower(trim(subcategory)) AS option FROM product_dim
  WHERE category IN ({", ".join(repr(c) for c in DEFAULT_CATEGORIES)})
  UNION ALL
  SELECT 'review_topic' AS kind, trim(topic_label) AS option FROM reviews_v
  WHERE category IN ({", ".join(repr(c) for c in DEFAULT_CATEGORIES)})) o
WHERE option IS NOT NULL AND option <> '' AND NOT (kind = 'product_keyword' AND option = 'unknown')"""))
def q_filter_options(spark, sf):
    return R.filter_options(V.product_dim(spark, sf), V.reviews_v(spark, sf), DEFAULT_CATEGORIES)


# ---- A12: product families ----------------------------------------------------

FAMILY_SQL = r"""
fam AS (SELECT array_to_string(list_slice(string_split_regex(
          regexp_replace(trim(title), '(^|\s+)\d+(\s+\d+)*$', ''), '\s+'), 1, 3), ' ') AS family,
          rating_count AS rc, category AS cat, product_id AS ok
        FROM product_dim WHERE title IS NOT NULL AND rating_count IS NOT NULL),
g AS (SELECT family, CAST(sum(rc) AS BIGINT) AS rating_count, arg_min(cat, ok) FILTER (WHERE cat IS NOT NULL) AS category
      FROM fam WHERE trim(family) <> '' GROUP BY family ORDER BY rating_count DESC, family LIMIT 20)
SELECT family, rating_count, category, concat('[', substr(category, 1, 3), '] ', substr(family, 1, 55)) AS short_title
FROM g"""


@register("product_families", with_dash("," + FAMILY_SQL).replace("\n,", ","))
def q_product_families(spark, sf):
    return A.product_families(V.product_dim(spark, sf), top=20, sort_mode="rating_desc")


@register("product_families_by_category", with_dash("," + FAMILY_SQL).replace("\n,", ","))
def q_product_families_by_category(spark, sf):
    return A.product_families(V.product_dim(spark, sf), top=20, sort_mode="category_family")


# ---- A13/A14: review-to-product lookups ------------------------------------------

def _volume_sql(subset: bool) -> str:
    group = "prod_subcategory" if subset else "prod_category"
    extra = (f"AND l.prod_category IN ({', '.join(repr(c) for c in DEFAULT_CATEGORIES)})" if subset else "")
    return with_dash(f"""
, m AS (SELECT r.product_id, CAST(date_trunc('month', r.review_ts) AS DATE) AS month, l.rc, l.{group} AS grp
       FROM reviews_v r LEFT JOIN (SELECT product_id, rating_count AS rc, category AS prod_category,
                                          subcategory AS prod_subcategory FROM product_dim) l
       ON r.product_id = l.product_id
       WHERE r.review_ts IS NOT NULL AND l.rc IS NOT NULL AND l.{group} IS NOT NULL {extra}),
n AS (SELECT product_id, count(*) AS n FROM m GROUP BY product_id)
SELECT month, grp AS "group", round(sum(CAST(rc AS DOUBLE) / CAST(greatest(n, 1) AS DOUBLE)), {D6}) AS volume
FROM m JOIN n ON m.product_id = n.product_id GROUP BY 1, 2""").replace("\n, m AS", ", m AS")


@register("review_volume_category", _volume_sql(False))
def q_review_volume_category(spark, sf):
    return A.review_volume(V.product_dim(spark, sf), dash_reviews(spark, sf), None, digits=D6)


@register("review_volume_subcategory", _volume_sql(True))
def q_review_volume_subcategory(spark, sf):
    universe = None  # a strict subset of categories selects the subcategory view
    return A.review_volume(V.product_dim(spark, sf), dash_reviews(spark, sf), DEFAULT_CATEGORIES, universe,
                           digits=D6)


@register("discount_timeline", with_dash(f"""
SELECT CAST(date_trunc('month', r.review_ts) AS DATE) AS month, r.category,
       round(avg(p.discount_pct), {D6}) AS avg_discount, count(r.product_id) AS n
FROM reviews_v r LEFT JOIN product_dim p ON r.product_id = p.product_id
WHERE r.review_ts IS NOT NULL AND p.discount_pct IS NOT NULL AND r.category IS NOT NULL GROUP BY 1, 2"""))
def q_discount_timeline(spark, sf):
    return A.discount_timeline(V.product_dim(spark, sf), dash_reviews(spark, sf), digits=D6)


# ---- A8-A11, J3: correlation lab ------------------------------------------------

POINTS_SQL = """
, pts AS (SELECT p.category, p.avg_discount, r.avg_sentiment FROM
  (SELECT category, avg(discount_pct) AS avg_discount FROM product_dim WHERE category IS NOT NULL GROUP BY 1) p
  JOIN (SELECT category, avg(sentiment_score) AS avg_sentiment FROM reviews_v WHERE category IS NOT NULL GROUP BY 1) r
  ON p.category = r.category
  WHERE p.avg_discount IS NOT NULL AND r.avg_sentiment IS NOT NULL)"""


@register("category_points", with_dash(f"""
, p AS (SELECT category, round(avg(discount_pct), {D6}) AS avg_discount, round(avg(rating), {D6}) AS avg_product_rating,
               count(product_id) AS products FROM product_dim WHERE category IS NOT NULL GROUP BY 1),
r AS (SELECT category, round(avg(sentiment_score), {D6}) AS avg_sentiment, round(avg(rating), {D6}) AS avg_review_rating,
             count(review_id) AS reviews FROM reviews_v WHERE category IS NOT NULL GROUP BY 1)
SELECT coalesce(p.category, r.category) AS category, avg_discount, avg_product_rating, products, avg_sentiment, avg_review_rating, reviews,
       p.category IS NOT NULL AND r.category IS NOT NULL AS is_point
FROM p FULL JOIN r ON p.category = r.category""").replace("\n, p AS", ", p AS"))
def q_category_points(spark, sf):
    """A8 and A9 with all their columns, and which categories J3 keeps."""
    prods, revs = V.product_dim(spark, sf), V.reviews_v(spark, sf)
    kept = A.category_points(prods, revs).select("category", F.lit(True).alias("_kept"))
    both = A.product_category_summary(prods).join(A.review_category_summary(revs), "category", "full").join(kept, "category", "left")
    means = ["avg_discount", "avg_product_rating", "avg_sentiment", "avg_review_rating"]
    return both.select("category", *[F.round(c, D6).alias(c) for c in means], "products", "reviews", F.coalesce("_kept", F.lit(False)).alias("is_point"))


@register("category_correlation", with_dash(POINTS_SQL + f"""
SELECT count(*) AS n_points,
       round(covar_pop(avg_discount, avg_sentiment) / nullif(stddev_pop(avg_discount) * stddev_pop(avg_sentiment), 0),
             {D6}) AS correlation FROM pts""").replace("\n, pts AS", ", pts AS"))
def q_category_correlation(spark, sf):
    pts = A.category_points(V.product_dim(spark, sf), V.reviews_v(spark, sf))
    return A.discount_sentiment_correlation(pts, digits=D6)


@register("category_trend", with_dash(POINTS_SQL + f"""
, fit AS (SELECT count(*) AS n, covar_pop(avg_discount, avg_sentiment) / nullif(var_pop(avg_discount), 0) AS slope,
                avg(avg_discount) AS mx, avg(avg_sentiment) AS my, min(avg_discount) AS x0, max(avg_discount) AS x1,
                var_pop(avg_discount) AS vx FROM pts),
ok AS (SELECT * FROM fit WHERE n >= 2 AND vx > 0 AND slope IS NOT NULL),
xs AS (SELECT *, CAST(i AS BIGINT) AS point,
       CASE WHEN i = 49 THEN x1 ELSE x0 + CAST(i AS DOUBLE) * ((x1 - x0) / CAST(49 AS DOUBLE)) END AS x
       FROM ok, range(50) t(i))
SELECT point, round(x, {D6}) AS x, round(slope * x + (my - slope * mx), {D6}) AS y, round(slope, {D6}) AS slope,
       round(my - slope * mx, {D6}) AS intercept FROM xs""").replace("\n, pts AS", ", pts AS").replace("\n, fit AS", ", fit AS"))
def q_category_trend(spark, sf):
    pts = A.category_points(V.product_dim(spark, sf), V.reviews_v(spark, sf))
    return A.linear_trend(pts, digits=D6)


# ---- F8-F11, J4: dashboard filters ---------------------------------------------

FILTER_ARGS = dict(categories=DEFAULT_CATEGORIES, min_rating=3.5, min_discount=10.0, price_range=(0.0, 1500.0))
PRODUCT_TERMS = ["red", "small"]
CAT_LIST = ", ".join(repr(c) for c in DEFAULT_CATEGORIES)
FP_SQL = (f"SELECT * FROM dp WHERE category IN ({CAT_LIST}) AND coalesce(rating, 0) >= 3.5 "
          f"AND coalesce(discount_pct, 0) >= 10 AND coalesce(price, 0) BETWEEN 0 AND 1500 "
          f"AND (contains(lower(title), 'red') OR contains(lower(title), 'small'))")


@register("filter_products", with_dash(f"SELECT product_id, title, category, price, discount_pct, rating FROM ({FP_SQL}) f"))
def q_filter_products(spark, sf):
    out = FL.filter_products(dash_products(spark, sf), queries=PRODUCT_TERMS, **FILTER_ARGS)
    return out.select("product_id", "title", "category", "price", "discount_pct", "rating")


@register("filter_reviews", with_dash(f"""
SELECT review_id, product_id, category, rating, sentiment, similarity FROM dr
WHERE category IN ({CAT_LIST}) AND sentiment IN ('positive', 'neutral', 'negative')
  AND coalesce(rating, 0) >= 3.5 AND coalesce(similarity, 0) >= 0.45"""))
def q_filter_reviews(spark, sf):
    out = FL.filter_reviews(dash_reviews(spark, sf), DEFAULT_CATEGORIES, ["positive", "neutral", "negative"],
                            min_rating=3.5, min_similarity=0.45)
    return out.select("review_id", "product_id", "category", "rating", "sentiment", "similarity")


@register("reviews_of_products", with_dash(f"""
SELECT review_id, product_id, category, topic_label FROM dr
WHERE category IN ({CAT_LIST}) AND product_id IN (SELECT product_id FROM ({FP_SQL}) f)"""))
def q_reviews_of_products(spark, sf):
    prods = FL.filter_products(dash_products(spark, sf), queries=PRODUCT_TERMS, **FILTER_ARGS)
    revs = FL.category_filter(dash_reviews(spark, sf), DEFAULT_CATEGORIES)
    return FL.reviews_of_products(revs, prods).select("review_id", "product_id", "category", "topic_label")


@register("products_of_topics", with_dash(f"""
SELECT product_id, title, category FROM ({FP_SQL}) f
WHERE product_id IN (SELECT product_id FROM dr WHERE category IN ({CAT_LIST})
                     AND topic_label IN ('topic_1', 'topic_3'))"""))
def q_products_of_topics(spark, sf):
    prods = FL.filter_products(dash_products(spark, sf), queries=PRODUCT_TERMS, **FILTER_ARGS)
    revs = FL.topic_filter(FL.category_filter(dash_reviews(spark, sf), DEFAULT_CATEGORIES), ["topic_1", "topic_3"])
    return FL.products_of_reviews(prods, revs).select("product_id", "title", "category")
