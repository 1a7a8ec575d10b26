"""Composite flows (X1-X5): one call builds every panel of a flow as lazy DataFrames.

X1 (shared plan, several outputs): the clean products frame is written
once under the checkpoint folder and every panel reads it; a lost executor costs nothing of it.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.functions import scalars as S
from cartwheel.operators import aggregates as A
from cartwheel.operators import clean as C
from cartwheel.operators import filters as FL
from cartwheel.operators import histograms as H
from cartwheel.operators import ranking as R
from cartwheel.operators import search as SR
from cartwheel.plans import sql as Q
from cartwheel.session import shuffles_released, written
from cartwheel.sources import csv as CSV
from cartwheel.sources import parquet as P


# ---- X2: structured flow -------------------------------------------------------

def structured(spark: SparkSession, products_folder: str, out_folder: str | None = None,
               tiebreak: list[str] | None = None, multi_line: bool = True, digits: int | None = None) -> dict[str, DataFrame]:
    """S1 → U1 → F1 → {A1, W1, C5 → T2, A3, A4, A17, A18} → S6; ``digits`` replaces the panels' own rounding."""
    products = written(C.clean_products(CSV.read_products(spark, products_folder, multi_line=multi_line)), "products")
    tb = tiebreak or ["name", "actual_price", "discount_price"]
    rated = products.where(C.rated()).withColumn("wilson_score", S.wilson_center("ratings", "no_of_ratings"))
    shown = {} if digits is None else {"digits": digits}
    stats = {} if digits is None else {"digits": {k: digits for k in A.CATEGORY_STATS_DIGITS}, "median_digits": digits}
    panels = {
        "category_stats": A.category_stats(products, **stats),
        "top_deals": R.top_deals(products, 5, tiebreak=tb),
        "top_rated": R.top_rated(rated, 10, 100, tiebreak=tb),
        "avg_discount": A.avg_discount_by_category(products, **shown),
        "subcategory_top": A.subcategory_top(products),
        "price_histogram": H.price_histogram(products, **shown),
        "rating_histogram": H.rating_histogram(products),
    }
    if out_folder:
        scored = F.when(C.rated(), S.wilson_center("ratings", "no_of_ratings"))
        P.write_products(products.withColumn("wilson_score", scored), f"{out_folder}/products")
    return panels


# ---- X5: SQL flow ----------------------------------------------------------------

def sql_flow(spark: SparkSession, products: DataFrame, folder: str, table: str,
             tiebreak: list[str] | None = None, digits: int = 2) -> dict[str, DataFrame]:
    """S6 → S8 → {A2, W2} through ``spark.sql``."""
    P.write_products(products, folder)
    Q.register_table(spark, table, folder, ddl=None)
    return {"products": Q.sql(spark, f"SELECT * FROM {table}"),
            "category_stats_sql": Q.category_stats_sql(spark, table, digits=digits),
            "top_deals_sql": Q.top_deals_sql(spark, table, tiebreak=tiebreak)}


# ---- X4: dashboard flow ----------------------------------------------------------

@dataclass
class DashboardParams:
    """One parameter set of the dashboard (defaults are the reference's widget defaults)."""
    categories: list[str] | None = None  # None = the first three of the category universe
    product_query: list[str] = field(default_factory=list)
    review_query: list[str] = field(default_factory=list)
    min_rating: float = 3.5
    min_discount: float = 10.0
    price_range: tuple[float, float] | None = None  # None = (0, max price)
    min_similarity: float = 0.45
    sentiments: list[str] = field(default_factory=lambda: ["positive", "neutral", "negative"])
    sort_mode: str = "rating_desc"


def default_categories(products: DataFrame, reviews: DataFrame, n: int = 3) -> tuple[list[str], list[str]]:
    """(first n, all) of the category universe — a short list, one row per category."""
    universe = [r[0] for r in R.category_universe(products, reviews).collect()]
    return universe[:n], universe


def dashboard(products: DataFrame, reviews: DataFrame, params: DashboardParams,
              review_key: str = "review_id", digits: int | None = None) -> dict[str, DataFrame]:
    """S5 → F8/F9 → J4 → {A15, A13, A6, A14, E1, A7, A12, A10/A11} with one parameter set.

    ``digits`` replaces the panels' own rounding.

    ``products`` and ``reviews`` are conformed dashboard frames (see
    ``sources.parquet``); reviews carry ``sentiment`` and ``review_month``.
    """
    if params.categories is None:
        cats, universe = default_categories(products, reviews)
    else:
        cats = params.categories
        universe = None if not cats else default_categories(products, reviews)[1]
    price_range = params.price_range
    if price_range is None:
        hi = A.price_bounds(products).first()[0]
        price_range = (0.0, max(float(hi), 1.0))
    prods = FL.filter_products(products, cats, params.min_rating, params.min_discount, price_range,
                               params.product_query)
    revs = FL.category_filter(reviews, cats)
    viz_reviews = FL.reviews_of_products(revs, prods) if params.product_query else revs
    if params.review_query:
        topics_reviews = FL.topic_filter(viz_reviews, params.review_query)
        viz_products = FL.products_of_reviews(prods, topics_reviews)
    else:
        topics_reviews, viz_products = viz_reviews, prods
    points = A.category_points(viz_products, topics_reviews)
    topic_digits = {} if digits is None else {"digits": (digits, digits, digits)}
    return {
        "kpis": A.kpis(prods, revs, digits=digits),
        "review_volume": A.review_volume(products, viz_reviews, cats, universe, digits=digits),
        "sentiment_timeline": A.sentiment_timeline(topics_reviews, digits=digits),
        "discount_timeline": A.discount_timeline(viz_products, topics_reviews, digits=digits),
        "search": SR.keyword_search(revs, " ".join(params.review_query), None, cats, params.sentiments,
                                    params.min_rating, params.min_similarity, tiebreak=[review_key]),
        "topic_summary": A.topic_summary(topics_reviews, sentiment="sentiment", **topic_digits),
        "product_families": A.product_families(prods, sort_mode=params.sort_mode),
        "correlation": A.discount_sentiment_correlation(points, digits=digits),
        "trend": A.linear_trend(points, digits=digits),
    }


def panel_values(panels: dict[str, DataFrame], shape: dict[str, tuple[list[str], list[str]]], digits: int = 6) -> DataFrame:
    """The panels' rows in long form (panel, key, measure, value): ``shape`` names each panel's key and measure columns.

    Key columns are joined by ``|`` (null: ``-``); values are doubles rounded to ``digits``, null where the panel's are.
    """
    frames = []
    for name, (keys, measures) in shape.items():
        key = F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("-")) for k in keys]) if keys else F.lit("")
        cells = F.array(*[F.struct(F.lit(m).alias("measure"), F.round(F.col(m).cast("double"), digits).alias("value")) for m in measures])
        frames.append(panels[name].select(F.lit(name).alias("panel"), key.alias("key"), F.inline(cells)))
    return reduce(DataFrame.unionByName, frames)


def panel_counts(panels: dict[str, DataFrame]) -> DataFrame:
    """Union of per-panel row counts (one small aggregate per panel)."""
    frames = [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("panel"), "rows")
              for name, df in panels.items()]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


# ---- X3: review flow ----------------------------------------------------------------

def reviews_flow(spark: SparkSession, paths: dict[str, str], out_folder: str, dim: int = 64, min_cluster_size: int = 50,
                 min_samples: int = 10, k: int = 5, max_rows: int | None = None,
                 category_queries: list[tuple[str, str]] | None = None) -> dict[str, DataFrame]:
    """S4 → W3 → C10… → F6 → F7 → C7 → {A5 → S7, E2 → S10 → E6/E7, E8 → E10 → E9 → E13/E14 → E18 → E17}.

    Reviews are persisted once (X1) and feed every branch; the vector table is
    written partitioned by IVF cell, the monthly series as Parquet. Topics are density clusters of the
    vectors' five-dimensional map, −1 what belongs to none; both maps use one neighbour search.
    """
    from cartwheel.operators import hierarchy as HI
    from cartwheel.operators import manifold as MF
    from cartwheel.operators import topics as T
    from cartwheel.operators import vectors as VX
    from cartwheel.sources import jsonl as J

    reviews = J.load_reviews(spark, paths, max_rows=max_rows)
    reviews = written(reviews, "reviews")
    docs = J.review_docs(reviews)
    monthly = A.monthly_sentiment(reviews, ts="timestamp")
    P.write_monthly(monthly, f"{out_folder}/monthly")
    rows = written(P.embedded_rows(docs, "review_text", dim=dim), "review-vectors")
    indexed, cents = VX.build_ivf(rows)
    table = VX.write_vector_table(indexed.drop("cell_cos"), f"{out_folder}/vectors")
    queries = VX.query_frame(spark, VX.SEARCH_QUERIES, dim=dim)
    asked = category_queries or VX.CATEGORY_QUERIES
    cat_queries = VX.query_frame(spark, [q for _, q in asked], dim=dim).withColumn(
        "q_category", F.element_at(F.array(*[F.lit(c) for c, _ in asked]),
                                   (F.col("qid") + 1).cast("int")))
    # Topic assignments and map points feed several panels: keep each once.
    vectors = table.select(F.xxhash64("id").alias("key"), "id", "embedding")
    near = written(MF.nearest(vectors, id_col="key"), "neighbours")
    names = [f"u{i}" for i in range(1, 6)]
    reduced = MF.manifold_map(vectors, k=5, id_col="key", names=names, near=near).select("key", F.array(*names).alias("embedding"))
    found = HI.hdbscan_topics(written(reduced, "reduced"), min_cluster_size, min_samples, id_col="key")
    topics = written(vectors.join(found, "key"), "topics")
    coords = MF.manifold_map(topics, k=2, min_dist=0.05, id_col="key", near=near).drop("key")
    topics = topics.drop("key")
    labelled = docs.join(topics.select("id", "topic"), "id")
    info = T.topic_info(labelled.select("topic", F.col("review_text").alias("text")))
    with shuffles_released(spark):
        T.review_topic_points(docs.withColumnRenamed("id", "review_id"), coords.withColumnRenamed("id", "review_id"), info,
                              key="review_id").write.parquet(f"{out_folder}/reviews")
        points = spark.read.parquet(f"{out_folder}/reviews")
        T.document_map(points, docs.select(F.col("id").alias("review_id"), F.col("review_text").alias("text")),
                       "review_id").write.parquet(f"{out_folder}/document_map")
    return {
        "reviews": reviews,
        "monthly": spark.read.parquet(f"{out_folder}/monthly"),
        "vectors": table,
        "search": VX.knn_exact(queries, table, k=k),
        "category_search": VX.search_in_category(cat_queries, table, k=k),
        "topics": topics,
        "review_points": points,
        "document_map": spark.read.parquet(f"{out_folder}/document_map"),
    }
