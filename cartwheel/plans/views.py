"""Fixture views over the driver's test tables.

The SQL text is shared verbatim by Spark and the DuckDB oracle; it uses
integer arithmetic only, so both engines produce the same bits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
               "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]

OFFERS_SQL = """
SELECT l_orderkey, l_linenumber, l_suppkey, l_partkey AS product_id,
       p_name AS name, p_type AS main_category, p_type AS source_category,
       CASE WHEN l_partkey % 40 = 0 THEN NULL ELSE p_brand END AS sub_category,
       CASE WHEN (l_orderkey + l_linenumber) % 17 = 0 THEN NULL
            ELSE CAST(10 + (l_partkey * 7 + l_orderkey) % 41 AS DOUBLE) / CAST(10 AS DOUBLE) END AS ratings,
       CASE WHEN l_linenumber = 7 THEN NULL
            ELSE CAST((l_orderkey * 13 + l_suppkey) % 3000 AS BIGINT) END AS no_of_ratings,
       CASE WHEN (l_orderkey + l_partkey) % 101 = 0 THEN CAST(0 AS DOUBLE) ELSE l_extendedprice END AS actual_price,
       l_extendedprice * CAST(105 - (l_partkey * 31 + l_suppkey * 7 + l_linenumber) % 110 AS DOUBLE)
                       / CAST(100 AS DOUBLE) AS discount_price
FROM lineitem JOIN part ON l_partkey = p_partkey
"""

PRODUCT_DIM_SQL = """
SELECT p_partkey AS product_id,
       concat(p_name, ' ', CAST(p_partkey % 50 AS STRING)) AS title,
       p_type AS category, p_brand AS subcategory,
       p_retailprice AS list_price,
       p_retailprice * CAST(100 - (p_partkey * 37) % 75 AS DOUBLE) / CAST(100 AS DOUBLE) AS price,
       CASE WHEN p_partkey % 29 = 0 THEN NULL ELSE CAST((p_partkey * 37) % 75 AS DOUBLE) END AS discount_pct,
       CASE WHEN p_partkey % 19 = 0 THEN NULL
            ELSE CAST(10 + (p_partkey * 11) % 41 AS DOUBLE) / CAST(10 AS DOUBLE) END AS rating,
       CASE WHEN p_partkey % 23 = 0 THEN NULL ELSE CAST(12 + (p_partkey * 97) % 25000 AS BIGINT) END AS rating_count
FROM part
"""

REVIEWS_V_SQL = """
SELECT o_orderkey AS review_id, o_custkey AS product_id,
       CASE o_orderkey % 7 WHEN 0 THEN 'ECONOMY' WHEN 1 THEN 'LARGE' WHEN 2 THEN 'MEDIUM' WHEN 3 THEN 'PROMO'
                           WHEN 4 THEN 'SMALL' WHEN 5 THEN 'STANDARD' ELSE 'UNLISTED' END AS category,
       CAST(1 + o_orderkey % 5 AS DOUBLE) AS rating,
       CAST((o_orderkey * 53) % 201 - 100 AS DOUBLE) / CAST(100 AS DOUBLE) AS sentiment_score,
       CASE WHEN o_orderkey % 29 = 0 THEN NULL ELSE o_orderdate END AS review_ts,
       CAST(o_orderkey % 10 AS BIGINT) AS topic_id,
       CASE WHEN o_orderkey % 10 = 9 THEN NULL
            ELSE concat('topic_', CAST(o_orderkey % 10 AS STRING)) END AS topic_label,
       CASE WHEN o_orderkey % 31 = 0 THEN NULL
            ELSE CAST((o_orderkey * 37) % 101 AS DOUBLE) / CAST(100 AS DOUBLE) END AS similarity,
       CAST(o_orderkey % (SELECT count(*) FROM documents) AS BIGINT) AS doc_id
FROM orders
"""

VIEW_SQL = {"offers": OFFERS_SQL, "product_dim": PRODUCT_DIM_SQL, "reviews_v": REVIEWS_V_SQL}


def with_views(sql: str, *names: str) -> str:
    """Prefix ``sql`` with the named fixture views as CTEs (for the oracle)."""
    ctes = ",\n".join(f"{n} AS ({VIEW_SQL[n]})" for n in names)
    return f"WITH {ctes}\n{sql}" if names else sql


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table, registered as a temp view of the same name."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    df.createOrReplaceTempView(name)
    return df


def register_base(spark: SparkSession, sf_dir: str, names: list[str] | None = None) -> None:
    for n in names or BASE_TABLES:
        table(spark, sf_dir, n)


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A fixture view (offers, product_dim, reviews_v) over the tables in ``sf_dir``."""
    needs = {"offers": ["lineitem", "part"], "product_dim": ["part"], "reviews_v": ["orders", "documents"]}[name]
    register_base(spark, sf_dir, needs)
    df = spark.sql(VIEW_SQL[name])
    df.createOrReplaceTempView(name)
    return df


def offers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "offers")


def product_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "product_dim")


def reviews_v(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "reviews_v")
