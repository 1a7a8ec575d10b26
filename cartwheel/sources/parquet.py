"""Parquet sources and sinks (S5-S7, S10, S11) and the schema conformer."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Dashboard column aliases and defaults (fixed values of the reference loader).
PRODUCT_ALIASES = {"name": "title", "discount_price": "price", "discounted_price": "price", "actual_price": "list_price",
                   "main_category": "category", "sub_category": "subcategory", "ratings": "rating",
                   "no_of_ratings": "rating_count", "discount_percentage": "discount_pct"}
REVIEW_ALIASES = {"text": "review_text", "review": "review_text", "score": "rating", "topic": "topic_label",
                  "umap_x": "x", "umap_y": "y", "month": "review_month", "date": "review_month"}
PRODUCT_COLUMNS = {"product_id": "string", "title": "string", "category": "string", "subcategory": "string",
                   "price": "double", "list_price": "double", "discount_pct": "double", "rating": "double",
                   "rating_count": "bigint", "wilson_score": "double"}
REVIEW_COLUMNS = {"review_id": "string", "product_id": "string", "category": "string", "rating": "double",
                  "sentiment": "string", "sentiment_score": "double", "review_text": "string", "topic_id": "bigint",
                  "topic_label": "string", "x": "double", "y": "double", "review_month": "timestamp",
                  "similarity": "double"}


def normalize_name(name: str) -> str:
    """strip, lower, space and dash → underscore."""
    return re.sub(r"[ \-]", "_", str(name).strip().lower())


def conform(df: DataFrame, columns: dict[str, str], aliases: dict[str, str] | None = None,
            defaults: dict[str, object] | None = None) -> DataFrame:
    """Normalise names, merge aliases into their columns, add missing columns, project in order.

    Metadata only: no job runs. Several columns of one target (after normalising, or as aliases) are
    coalesced: the target's own name first, then the aliases as listed. Missing columns get
    ``defaults[c]`` or null, typed.
    """
    held: dict[str, list[Column]] = {}
    for c in df.columns:
        held.setdefault(normalize_name(c), []).append(F.col(f"`{c}`"))
    out = []
    for c, t in columns.items():
        names = [c, *(old for old, new in (aliases or {}).items() if new == c and old not in columns)]
        found = [x.cast(t) for n in names for x in held.get(n, [])]
        out.append((F.coalesce(*found) if found else F.lit((defaults or {}).get(c)).cast(t)).alias(c))
    return df.select(*out)


def product_key(name: Column, category: Column) -> Column:
    """The key of a product without one: md5 of its name and source category."""
    return F.md5(F.concat_ws("\u0001", F.coalesce(name, F.lit("")), F.coalesce(category, F.lit(""))).cast("binary"))


def conform_products(df: DataFrame, defaults: dict[str, object] | None = None) -> DataFrame:
    """S5, product side: ``PRODUCT_COLUMNS`` with a generated ``product_id`` where the artifact has none."""
    names = {normalize_name(c): c for c in df.columns}
    if "product_id" not in names:
        part = lambda *keys: next((F.col(f"`{names[k]}`").cast("string") for k in keys if k in names), F.lit(""))
        df = df.withColumn("product_id", product_key(part("name", "title"), part("source_category", "main_category", "category")))
    return conform(df, PRODUCT_COLUMNS, PRODUCT_ALIASES, defaults)


def read_parquet_conformed(spark: SparkSession, path: str, columns: dict[str, str],
                           aliases: dict[str, str] | None = None, defaults: dict[str, object] | None = None) -> DataFrame:
    """``read.parquet`` + conform."""
    return conform(spark.read.parquet(path), columns, aliases, defaults)


def write_products(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Clean products, partitioned by source category (category filters prune files)."""
    df.write.mode(mode).partitionBy("source_category").parquet(path)


def write_monthly(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Monthly sentiment series."""
    df.write.mode(mode).parquet(path)


# Field limits of the reference's vector collection (fixed values); applied only when a caller passes them.
VECTOR_LIMITS = {"title": 2048, "body": 16384, "asin": 64, "category": 64, "timestamp": 32}


def vector_rows(docs: DataFrame, vectors: DataFrame, key: str = "id", embedding: str = "embedding",
                limits: dict[str, int] | None = None) -> DataFrame:
    """S10 + J6: align documents and vectors by key (equi-join); ``limits`` cuts text fields, never the key."""
    j = docs.join(vectors.select(key, embedding), on=key, how="inner")
    cut = {c: n for c, n in (limits or {}).items() if c != key}
    return j.select(*[F.substring(F.col(c).cast("string"), 1, cut[c]).alias(c) if c in cut else F.col(c) for c in docs.columns],
                    F.col(embedding).cast("array<float>").alias(embedding))


def embedded_rows(docs: DataFrame, text: str, dim: int = 64, embedding: str = "embedding", encoder=None) -> DataFrame:
    """S10 where the vector comes from the row itself: embedded in place, without a join."""
    from cartwheel.operators.vectors import hash_embed
    return hash_embed(docs, text, dim=dim, out=embedding, encoder=encoder)


def alignment_report(docs: DataFrame, vectors: DataFrame, key: str = "id") -> DataFrame:
    """Counts of matched keys and of keys present on one side only (anti joins both ways)."""
    d, v = docs.select(key).distinct(), vectors.select(key).distinct()
    matched = d.join(v, key, "inner").agg(F.count(F.lit(1)).alias("n")).select(F.lit("matched").alias("kind"), "n")
    only_d = d.join(v, key, "left_anti").agg(F.count(F.lit(1)).alias("n")).select(F.lit("docs_only").alias("kind"), "n")
    only_v = v.join(d, key, "left_anti").agg(F.count(F.lit(1)).alias("n")).select(F.lit("vectors_only").alias("kind"),
                                                                                   "n")
    return matched.unionByName(only_d).unionByName(only_v)


def write_vectors(rows: DataFrame, path: str, key: str = "id") -> DataFrame:
    """Drop and recreate the collection; report what is present afterwards.

    One row: rows present, distinct keys present, and rows whose vector is
    missing or empty (the reference's insert would reject them).
    """
    rows.write.mode("overwrite").parquet(path)
    present = rows.sparkSession.read.parquet(path)
    return present.agg(F.count(F.lit(1)).alias("present"), F.count_distinct(key).alias("keys"),
                       F.count_if(F.col("embedding").isNull() | (F.size("embedding") == 0)).alias("empty_vectors"))


def upsert_vectors(existing: DataFrame, updates: DataFrame, key: str = "id", sequence: str | None = None,
                   embedding: str = "embedding") -> tuple[DataFrame, DataFrame]:
    """(merged table, rejected updates). The update with the largest ``sequence`` wins its key.

    Updates are reduced to one per key before they meet the table, which keeps the rows of all other
    keys (an anti join; stored vectors are not sorted or grouped). Updates with a null key or a null or
    empty vector are rejects and never win. Without ``sequence`` keys must not repeat within
    ``updates``; equal sequences go to the larger row.
    """
    bad = F.col(key).isNull() | F.col(embedding).isNull() | (F.size(embedding) == 0)
    rejects, good = updates.where(bad), updates.where(~bad)
    if sequence is not None:
        row = F.struct(*[F.col(c) for c in updates.columns])
        good = good.groupBy(F.col(key).alias("_key")).agg(F.max_by(row, F.struct(F.col(sequence), row)).alias("_r")).select("_r.*")
    keep = existing.join(good.select(key), key, "left_anti")
    extra = [c for c in updates.columns if c not in existing.columns]
    return keep.unionByName(good.drop(*extra), allowMissingColumns=True), rejects


def write_upsert(spark: SparkSession, path: str, updates: DataFrame, out: str, **options) -> DataFrame:
    """S11 as a sink: the merged table to ``out/vectors`` and the rejects to ``out/rejects``; returns the table as read back."""
    merged, rejects = upsert_vectors(spark.read.parquet(path), updates, **options)
    merged.write.parquet(f"{out}/vectors")
    rejects.write.parquet(f"{out}/rejects")
    return spark.read.parquet(f"{out}/vectors")
