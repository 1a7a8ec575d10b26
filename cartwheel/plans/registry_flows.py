"""Driver keys for the composite flows (X1-X5, T1) and the price cleaners on lineitem."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import functions as F

from cartwheel.functions import scalars as S
from cartwheel.operators import clean as C
from cartwheel.operators import vectors as VX
from cartwheel.plans import fixtures as FX
from cartwheel.plans import flows as FW
from cartwheel.plans import views as V
from cartwheel.plans.registry import (CAT_LIST, D6, DASH_REVIEWS_CTE, DEFAULT_CATEGORIES, FP_SQL, OFFER_TIEBREAK, ORACLE,
                                      PRODUCT_TERMS, SENT_SQL, WILSON_SQL, dash_products, dash_reviews, register, with_dash, with_products)
from cartwheel.session import scratch_dir
from cartwheel.sources import parquet as P

GROUP_A = ", ".join(repr(c) for c in FX.GROUP_A)
OFFER_WILSON_SQL = WILSON_SQL.replace("rating_count", "no_of_ratings").replace("rating ", "ratings ")
NBSP = " "


# ---- C1-C4, F1 on lineitem text ---------------------------------------------------

@register("clean_prices", f"""
SELECT concat('item ', CAST(l_orderkey AS VARCHAR), '-', CAST(l_linenumber AS VARCHAR)) AS name,
       l_returnflag AS main_category, CASE WHEN l_linestatus = 'O' THEN NULL ELSE l_linestatus END AS sub_category,
       l_returnflag AS source_category,
       CASE WHEN l_quantity < 10 THEN NULL ELSE l_quantity / CAST(10 AS DOUBLE) END AS ratings,
       CASE WHEN l_partkey % 9 = 0 THEN NULL ELSE l_partkey * 7 END AS no_of_ratings,
       l_extendedprice * (1 - l_discount) AS discount_price, l_extendedprice AS actual_price,
       round((l_extendedprice - l_extendedprice * (1 - l_discount)) / nullif(l_extendedprice, 0) * CAST(100 AS DOUBLE), 2)
         AS discount_pct,
       l_extendedprice - l_extendedprice * (1 - l_discount) AS savings
FROM lineitem""")
def q_clean_prices(spark, sf):
    li = V.table(spark, sf, "lineitem")
    ln = F.col("l_linenumber")
    raw = li.select(
        F.concat(F.lit("item "), F.col("l_orderkey").cast("string"), F.lit("-"), ln.cast("string")).alias("name"),
        F.col("l_returnflag").alias("main_category"),
        F.when(F.col("l_linestatus") == "O", F.lit("N/A")).otherwise(F.col("l_linestatus")).alias("sub_category"),
        F.col("l_returnflag").alias("source_category"),
        F.when(F.col("l_quantity") < 10, F.lit("Get"))
        .otherwise(F.concat((F.col("l_quantity") / F.lit(10.0)).cast("string"), F.lit(" out of 5 stars")))
        .alias("ratings"),
        F.when(F.col("l_partkey") % 9 == 0, F.lit("None"))
        .otherwise(F.format_number(F.col("l_partkey") * 7, 0)).alias("no_of_ratings"),
        F.concat(F.when(ln % 2 == 0, F.lit("€")).otherwise(F.lit("$")),
                 (F.col("l_extendedprice") * (F.lit(1) - F.col("l_discount"))).cast("string")).alias("discount_price"),
        F.concat(F.when(ln % 2 == 1, F.lit(NBSP)).otherwise(F.lit("")), F.lit("₹"),
                 F.format_number("l_extendedprice", 2), F.lit(" ")).alias("actual_price"))
    raw = raw.select(*[F.when(F.col(c).isin(list(S.NULL_TOKENS)), F.lit(None)).otherwise(F.col(c))
                       .alias(c) for c in raw.columns])
    return C.clean_products(raw)


# ---- X1/X2: structured flow ---------------------------------------------------------

def _values_sql(panels: dict[str, str], shape: dict[str, tuple[list[str], list[str]]]) -> str:
    """``flows.panel_values`` in SQL: one SELECT a panel over the panel's own statement."""
    parts = []
    for name, (keys, measures) in shape.items():
        key = "concat_ws('|', " + ", ".join(f"coalesce(CAST({k} AS VARCHAR), '-')" for k in keys) + ")" if keys else "''"
        names = ", ".join(f"'{m}'" for m in measures)
        values = ", ".join(f"round(CAST({m} AS DOUBLE), 6)" for m in measures)
        parts.append(f"SELECT '{name}' AS panel, {key} AS key, unnest([{names}]) AS measure, unnest([{values}]) AS value FROM ({panels[name]}) t")
    return "\nUNION ALL\n".join(parts)


STATS = ["product_count", "price_min", "price_max", "price_mean", "price_median", "avg_discount_pct", "avg_rating", "total_ratings"]
# Rows that tie in every column of the flow's order may differ in the others: those two panels show what the order decides.
STRUCTURED_SHAPE = {
    "category_stats": (["sub_category"], STATS),
    "top_deals": (["source_category", "name"], ["actual_price", "discount_price", "discount_pct"]),
    "top_rated": (["name"], ["discount_price", "wilson_score"]),
    "avg_discount": (["source_category"], ["avg_disc"]),
    "subcategory_top": (["label", "source_category", "sub_category"], ["count", "median_price"]),
    "price_histogram": (["source_category", "bin"], ["lower", "upper", "count"]),
    "rating_histogram": (["source_category", "bin"], ["count"]),
}
# The offers as their CSVs read back: quoted names, and no main category in the layout without one.
READ_BACK_SQL = f"""SELECT * REPLACE (CASE WHEN l_linenumber = 1 THEN concat(name, ', "special" edition') ELSE name END AS name,
                        CASE WHEN source_category IN ({GROUP_A}) THEN main_category END AS main_category) FROM ({V.OFFERS_SQL}) raw"""


def _read_back(sql: str) -> str:
    return sql.replace(V.OFFERS_SQL, READ_BACK_SQL)


STRUCTURED_ORACLE = _values_sql({
    "category_stats": _read_back(ORACLE["category_stats"]),
    "top_deals": _read_back(ORACLE["top_deals"]).replace(", ".join(OFFER_TIEBREAK), "name, actual_price, discount_price"),
    "top_rated": _read_back(with_products(f"""
SELECT name, discount_price, {OFFER_WILSON_SQL} AS wilson_score FROM products
WHERE no_of_ratings >= 100 AND ratings IS NOT NULL ORDER BY wilson_score DESC, name, actual_price, discount_price LIMIT 10""")),
    "avg_discount": _read_back(ORACLE["avg_discount_top20"]),
    "subcategory_top": _read_back(ORACLE["subcategory_top20"]),
    "price_histogram": _read_back(ORACLE["price_histogram"]),
    "rating_histogram": _read_back(ORACLE["rating_histogram"]),
}, STRUCTURED_SHAPE)


@register("flow_structured", STRUCTURED_ORACLE)
def q_flow_structured(spark, sf):
    offers = V.offers(spark, sf)
    folder = scratch_dir(spark, "flow-structured")
    FX.write_category_csvs(offers, f"{folder}/in")
    panels = FW.structured(spark, f"{folder}/in", f"{folder}/out", multi_line=False, digits=D6)
    return FW.panel_values(panels, STRUCTURED_SHAPE)


@register("flow_artifact", V.with_views(f"""
SELECT md5(concat(name, chr(1), source_category)) AS product_id, name AS title, main_category AS category, sub_category AS subcategory,
       discount_price AS price, actual_price AS list_price, ratings AS rating, no_of_ratings AS rating_count,
       CASE WHEN no_of_ratings > 0 AND ratings IS NOT NULL THEN {OFFER_WILSON_SQL} END AS wilson_score
FROM (SELECT * REPLACE (CASE WHEN l_linenumber = 1 THEN concat(name, ', "special" edition') ELSE name END AS name,
                        CASE WHEN source_category IN ({GROUP_A}) THEN main_category END AS main_category) FROM offers)""", "offers"))
def q_flow_artifact(spark, sf):
    """X2 -> S6 -> S5: the exported products, rated and partitioned, as the dashboard's loader reads them."""
    offers = V.offers(spark, sf)
    folder = scratch_dir(spark, "flow-artifact")
    FX.write_category_csvs(offers, f"{folder}/in")
    FW.structured(spark, f"{folder}/in", f"{folder}/out", multi_line=False)
    return P.conform_products(spark.read.parquet(f"{folder}/out/products")).drop("discount_pct")


# ---- X5: SQL flow --------------------------------------------------------------------

SQL_SHAPE = {
    "products": (["l_orderkey", "l_linenumber", "product_id", "l_suppkey", "name", "source_category", "sub_category"],
                 ["ratings", "no_of_ratings", "discount_price", "actual_price", "discount_pct"]),
    "category_stats_sql": (["sub_category"], STATS),
    "top_deals_sql": (["source_category", "name"], ["actual_price", "discount_price", "discount_pct", "ratings"]),
}


@register("flow_sql", _values_sql({
    "products": with_products("SELECT * FROM products"),
    "category_stats_sql": ORACLE["category_stats_sql"],
    "top_deals_sql": ORACLE["top_deals_sql"],
}, SQL_SHAPE))
def q_flow_sql(spark, sf):
    from cartwheel.plans.registry import products
    folder = scratch_dir(spark, "flow-sql")
    prods = C.keep_existing(products(spark, sf), C.PRODUCT_COLUMNS + ["l_orderkey", "l_linenumber", "product_id",
                                                                      "l_suppkey"])
    table = f"cw_products_{uuid.uuid4().hex[:10]}"
    panels = FW.sql_flow(spark, prods, f"{folder}/products", table, tiebreak=OFFER_TIEBREAK, digits=D6)
    return FW.panel_values(panels, SQL_SHAPE)


# ---- X4: dashboard flow -----------------------------------------------------------------

DASH_PARAMS = dict(categories=DEFAULT_CATEGORIES, product_query=PRODUCT_TERMS, review_query=["topic_1", "topic_3"],
                   min_rating=3.5, min_discount=10.0, price_range=(0.0, 1500.0), min_similarity=0.45)
TOPICS = "'topic_1', 'topic_3'"
DASH_SHAPE = {
    "kpis": ([], ["products", "reviews", "topics", "avg_rating", "avg_sentiment"]),
    "review_volume": (["month", '"group"'], ["volume"]),
    "sentiment_timeline": (["review_month", "category"], ["avg_sentiment", "reviews"]),
    "discount_timeline": (["month", "category"], ["avg_discount", "n"]),
    "search": (["review_id", "category", "topic_label", "sentiment"], ["rating", "similarity", "query_score"]),
    "topic_summary": (["topic_label"], ["reviews", "avg_rating", "avg_sentiment", "positive_share"]),
    "product_families": (["family", "category", "short_title"], ["rating_count"]),
    "correlation": ([], ["n_points", "correlation"]),
    "trend": (["point"], ["x", "y", "slope", "intercept"]),
}


def _dash_panel(key: str, products: str, reviews: str) -> str:
    """The oracle of a single operator over the flow's filtered products and reviews."""
    body = ORACLE[key].split(DASH_REVIEWS_CTE, 1)[1].strip()
    body = f"WITH {body[1:]}" if body.startswith(",") else body
    for name, filtered in (("product_dim", products), ("reviews_v", reviews), ("dr", reviews)):
        body = re.sub(rf"\b(FROM|JOIN) {name}\b", rf"\1 {filtered}", body)
    return body


_SEARCH_SQL = f"""
SELECT rv.*, (CASE WHEN contains(lower(coalesce(d.text, 'None')), 'topic_1') THEN 1.0 ELSE 0.0 END
              + CASE WHEN contains(lower(coalesce(rv.topic_label, 'None')), 'topic_1') THEN 1.5 ELSE 0.0 END
              + CASE WHEN contains(lower(coalesce(d.text, 'None')), 'topic_3') THEN 1.0 ELSE 0.0 END
              + CASE WHEN contains(lower(coalesce(rv.topic_label, 'None')), 'topic_3') THEN 1.5 ELSE 0.0 END)::DOUBLE
             + coalesce(rv.similarity, 0) AS query_score
FROM rv LEFT JOIN documents d ON rv.doc_id = d.doc_id
WHERE coalesce(rv.rating, 0) >= 3.5 AND coalesce(rv.similarity, 0) >= 0.45"""
DASH_ORACLE = with_dash(f""", fp AS ({FP_SQL}),
rv AS (SELECT * FROM dr WHERE category IN ({CAT_LIST})),
vr AS (SELECT * FROM rv WHERE product_id IN (SELECT product_id FROM fp)),
tr AS (SELECT * FROM vr WHERE topic_label IN ({TOPICS})),
vp AS (SELECT * FROM fp WHERE product_id IN (SELECT product_id FROM tr))
""" + _values_sql({
    "kpis": _dash_panel("kpis", "fp", "rv"),
    "review_volume": _dash_panel("review_volume_subcategory", "dp", "vr"),
    "sentiment_timeline": _dash_panel("sentiment_timeline", "fp", "tr"),
    "discount_timeline": _dash_panel("discount_timeline", "vp", "tr"),
    "search": _SEARCH_SQL,
    "topic_summary": _dash_panel("topic_summary", "fp", "tr"),
    "product_families": _dash_panel("product_families", "fp", "rv"),
    "correlation": _dash_panel("category_correlation", "vp", "tr"),
    "trend": _dash_panel("category_trend", "vp", "tr"),
}, DASH_SHAPE)).replace("\n, fp AS", ", fp AS")


@register("flow_dashboard", DASH_ORACLE)
def q_flow_dashboard(spark, sf):
    docs = V.table(spark, sf, "documents").select("doc_id", F.col("text").alias("review_text"))
    reviews = dash_reviews(spark, sf).join(docs, "doc_id", "left")
    panels = FW.dashboard(dash_products(spark, sf), reviews, FW.DashboardParams(**DASH_PARAMS), digits=D6)
    return FW.panel_values(panels, {name: ([k.strip('"') for k in keys], measures) for name, (keys, measures) in DASH_SHAPE.items()})


# ---- X3: review flow ----------------------------------------------------------------------

# E7 in its default form: two categories that occur, one that does not.
FLOW_CATEGORY_QUERIES = [("en", "ththe ing of the"), ("de", "schung der die"), ("nowhere", "of the")]


REVIEWS_SHAPE = {
    "reviews": (["id", "category"], ["rating", "helpful_vote", "text_len"]),
    "monthly": (["category", "dt"], ["avg_sentiment", "review_count"]),
    "review_points": (["review_id", "category", "sentiment"], ["rating", "sentiment_score", "placed"]),
}
REVIEWS_COUNTED = ["vectors", "search", "category_search", "topics", "document_map"]


def _reviews_flow_oracle() -> str:
    from cartwheel.plans.registry_io import _jsonl_expected
    asked = ", ".join(f"'{c}'" for c, _ in FLOW_CATEGORY_QUERIES)
    score = "least(greatest((rating - CAST(3 AS DOUBLE)) / CAST(2 AS DOUBLE), CAST(-1 AS DOUBLE)), CAST(1 AS DOUBLE))"
    panels = {
        "reviews": "SELECT * FROM kept",
        "monthly": f"""SELECT category, CAST(date_trunc('month', timestamp) AS DATE) AS dt, round(avg({score}), 3) AS avg_sentiment,
                              count(rating) AS review_count FROM kept GROUP BY 1, 2""",
        "review_points": f"SELECT *, {SENT_SQL} AS sentiment FROM (SELECT id AS review_id, category, rating, round({score}, 4) AS sentiment_score, 1 AS placed FROM kept) r",
    }
    n = "(SELECT count(*) FROM kept)"
    rows = {"vectors": n, "search": f"{len(VX.SEARCH_QUERIES)} * least(5, {n})", "topics": n, "document_map": n,
            "category_search": f"(SELECT sum(least(5, n)) FROM (SELECT count(*) AS n FROM kept WHERE category IN ({asked}) GROUP BY category) c)"}
    counts = "".join(f"\nUNION ALL SELECT '{name}', '', 'rows', CAST({rows[name]} AS DOUBLE)" for name in REVIEWS_COUNTED)
    return f"WITH kept AS ({_jsonl_expected()})\n" + _values_sql(panels, REVIEWS_SHAPE) + counts


@register("flow_reviews", _reviews_flow_oracle())
def q_flow_reviews(spark, sf):
    """The reviews, their months and their dashboard rows by value; vectors, hits and topics (their numbers are the fit's own) by rows."""
    docs = V.table(spark, sf, "documents")
    folder = scratch_dir(spark, "flow-reviews")
    paths = FX.write_review_files(docs, f"{folder}/in")
    panels = FW.reviews_flow(spark, paths, f"{folder}/out", category_queries=FLOW_CATEGORY_QUERIES)
    placed = (F.col("x").isNotNull() & F.col("y").isNotNull() & F.col("topic_label").isNotNull()).cast("int")
    values = FW.panel_values(panels | {"review_points": panels["review_points"].withColumn("placed", placed)}, REVIEWS_SHAPE)
    counts = FW.panel_counts({name: panels[name] for name in REVIEWS_COUNTED})
    return values.unionByName(counts.select("panel", F.lit("").alias("key"), F.lit("rows").alias("measure"), F.col("rows").cast("double").alias("value")))
