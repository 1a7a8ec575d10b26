"""SQL flow (X5, A2, W2, S8, S9): the reference's SQL mirror run through ``spark.sql``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Column layout of the clean products table (fixed DDL of the SQL mirror).
PRODUCTS_DDL = """
    name            STRING,
    main_category   STRING,
    sub_category    STRING,
    source_category STRING,
    ratings         DOUBLE,
    no_of_ratings   BIGINT,
    discount_price  DOUBLE,
    actual_price    DOUBLE,
    discount_pct    DOUBLE,
    savings         DOUBLE
"""


def register_table(spark: SparkSession, name: str, path: str, ddl: str | None = PRODUCTS_DDL,
                   partitioned_by: list[str] | None = None) -> DataFrame:
    """Idempotent external table over staged Parquet.

    With ``ddl=None`` the schema (and Hive-style partition folders) is read
    from the files.
    """
    cols = f"({ddl})" if ddl else ""
    parts = f"PARTITIONED BY ({', '.join(partitioned_by)})" if partitioned_by else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} {cols} USING parquet {parts} LOCATION '{path}'")
    if any(c.isPartition for c in spark.catalog.listColumns(name)):
        # Partition folders are registered in the catalog (metadata only).
        spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
    return spark.table(name)


def sql(spark: SparkSession, text: str) -> DataFrame:
    """Run a SQL text; an empty result keeps its schema."""
    return spark.sql(text)


def category_stats_sql(spark: SparkSession, table: str = "products", digits: int = 2,
                       rating_digits: int | None = None, accuracy: int = 10_000) -> DataFrame:
    """A2: category statistics in SQL; the median is ``percentile_approx`` (a sketch of rank error 1/accuracy)."""
    measures = {
        "product_count": "count(*)", "price_min": "min(discount_price)", "price_max": "max(discount_price)",
        "price_mean": f"round(avg(discount_price), {digits})",
        "price_median": f"percentile_approx(discount_price, 0.5, {accuracy})",
        "avg_discount_pct": f"round(avg(discount_pct), {digits})",
        "avg_rating": f"round(avg(ratings), {digits if rating_digits is None else rating_digits})",
        "total_ratings": "sum(no_of_ratings)",
    }
    columns = ", ".join(f"{expr} AS {name}" for name, expr in measures.items())
    return spark.sql(f"SELECT sub_category, {columns} FROM {table} WHERE sub_category IS NOT NULL GROUP BY sub_category")


def top_deals_sql(spark: SparkSession, table: str = "products", k: int = 5,
                  tiebreak: list[str] | None = None) -> DataFrame:
    """Top discounts per category by ROW_NUMBER (plus a unique tie-break)."""
    order = ", ".join(["discount_pct DESC", *(f"{c} ASC NULLS LAST" for c in tiebreak or [])])
    shown = "source_category, name, actual_price, discount_price, discount_pct, ratings"
    return spark.sql(f"""
        SELECT {shown} FROM (
            SELECT {shown}, row_number() OVER best AS place FROM {table} WHERE discount_pct > 0 AND discount_pct <= 95
            WINDOW best AS (PARTITION BY source_category ORDER BY {order}))
        WHERE place <= {int(k)}""")
