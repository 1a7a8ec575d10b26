"""Product and review cleaning (F1-F7, F12): projections and predicates only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from cartwheel.functions import scalars as S
from cartwheel.session import written

# Clean product columns, in the reference's order.
PRODUCT_COLUMNS = ["name", "main_category", "sub_category", "source_category", "ratings", "no_of_ratings",
                   "discount_price", "actual_price", "discount_pct", "savings"]


def _is_text(df: DataFrame, c: str) -> bool:
    return isinstance(df.schema[c].dataType, StringType)


def keep_existing(df: DataFrame, keep: list[str]) -> DataFrame:
    """ordered keep-list ∩ schema (metadata only, no job)."""
    return df.select(*[c for c in keep if c in df.columns])


def drop_nulls(df: DataFrame, subset: list[str]) -> DataFrame:
    """drop rows null in any listed column that exists."""
    present = [c for c in subset if c in df.columns]
    return df.dropna(how="any", subset=present) if present else df


def clean_products(raw: DataFrame, digits: int = 2) -> DataFrame:
    """clean whichever price/rating/count columns exist, derive pct and savings, keep, drop nulls.

    Text columns go through C1-C3; columns that are already numeric are kept.
    """
    cols = set(raw.columns)
    exprs: dict[str, Column] = {}
    for c in ("discount_price", "actual_price"):
        if c in cols:
            exprs[c] = S.clean_price(c) if _is_text(raw, c) else S.nan_to_null(F.col(c).cast("double"))
    if "ratings" in cols:
        exprs["ratings"] = S.clean_rating("ratings") if _is_text(raw, "ratings") else \
            S.nan_to_null(F.col("ratings").cast("double"))
    if "no_of_ratings" in cols:
        exprs["no_of_ratings"] = S.clean_count("no_of_ratings") if _is_text(raw, "no_of_ratings") else \
            F.col("no_of_ratings").cast("bigint")
    df = raw.withColumns(exprs) if exprs else raw
    if "discount_price" in cols and "actual_price" in cols:
        df = df.withColumns({"discount_pct": S.discount_pct("actual_price", "discount_price", digits),
                             "savings": S.savings("actual_price", "discount_price")})
    df = keep_existing(df, PRODUCT_COLUMNS)
    return drop_nulls(df, ["discount_price", "name"])


def with_discounts(df: DataFrame, list_price: str = "actual_price", price: str = "discount_price",
                   digits: int = 2) -> DataFrame:
    """C4 on typed columns: add discount_pct and savings."""
    return df.withColumns({"discount_pct": S.discount_pct(list_price, price, digits),
                           "savings": S.savings(list_price, price)})


def plausible_discount(pct: str = "discount_pct", strict_low: bool = True) -> Column:
    """0 < pct ≤ 95 (deals) or 0 ≤ pct ≤ 95 (averages)."""
    c = F.col(pct)
    low = c > F.lit(0) if strict_low else c >= F.lit(0)
    return c.isNotNull() & low & (c <= F.lit(95))


def rated(n: str = "no_of_ratings", rating: str = "ratings") -> Column:
    """rating count present and positive, rating present."""
    return F.col(n).isNotNull() & (F.col(n) > F.lit(0)) & F.col(rating).isNotNull()


def quality_gate(reviews: DataFrame, text: str = "text", rating: str = "rating", verified: str = "verified",
                 min_chars: int = 50, verified_only: bool = False) -> DataFrame:
    """stripped text of ≥ ``min_chars`` code points (before truncation), rating present, optional verified."""
    t = S.ustrip(F.coalesce(F.col(text), F.lit("")))
    cond = (F.length(t) >= F.lit(max(min_chars, 1))) & F.col(rating).isNotNull()
    if verified_only:
        cond = cond & F.coalesce(F.col(verified), F.lit(False))
    return reviews.where(cond)


PARTIAL_LIMIT = 1000  # largest k for which Spark limits groups before the shuffle (spark.sql.optimizer.windowGroupLimitThreshold)


def cap_per_category(reviews: DataFrame, n: int | None, category: str = "category",
                     ordinal: str = "ordinal", partial_limit: int = PARTIAL_LIMIT) -> DataFrame:
    """the first ``n`` kept rows per category in file order.

    Up to ``partial_limit`` this is a WindowGroupLimit: every map task keeps at most ``n`` rows per
    category before the shuffle. Above it the rows are range-partitioned by (category, ordinal) and
    written with their partition; running counts say which parts of a category stay whole, and only
    the part the cut falls into is numbered. No category is sorted in one task either way.
    """
    if n is None:
        return reviews
    if n <= partial_limit:
        w = Window.partitionBy(category).orderBy(F.asc(ordinal))
        return reviews.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")
    parts = int(reviews.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = written(reviews.repartitionByRange(parts, category, ordinal).withColumn("_part", F.spark_partition_id()), "cap")
    earlier = Window.partitionBy(category).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = (dealt.groupBy(category, "_part").agg(F.count(F.lit(1)).alias("_n"))
              .withColumn("_left", F.lit(n) - F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
              .select(F.col(category).alias("_cat"), F.col("_part").alias("_of"), "_n", "_left").where(F.col("_left") > 0))
    held = dealt.join(counts, dealt[category].eqNullSafe(counts["_cat"]) & (F.col("_part") == F.col("_of")))
    whole = held.where(F.col("_n") <= F.col("_left"))
    cut = held.where(F.col("_n") > F.col("_left"))
    place = F.row_number().over(Window.partitionBy(category, "_part").orderBy(F.asc(ordinal)))
    cut = cut.withColumn("_rn", place).where(F.col("_rn") <= F.col("_left")).drop("_rn")
    return whole.unionByName(cut).select(*reviews.columns)
