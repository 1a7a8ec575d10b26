"""Driver keys for readers, sinks, conformers and review records."""

from __future__ import annotations

from pyspark.sql import functions as F

from cartwheel.functions import scalars as S
from cartwheel.operators import aggregates as A
from cartwheel.operators import clean as C
from cartwheel.plans import fixtures as FX
from cartwheel.plans import views as V
from cartwheel.plans.registry import D6, products, register, with_products
from cartwheel.session import scratch_dir
from cartwheel.sources import csv as CSV
from cartwheel.sources import jsonl as J
from cartwheel.sources import parquet as P

# Python str.strip() white space, for RE2 in the oracle.
_WS = r"[\s\x{0b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def duck_ustrip(x: str) -> str:
    return f"regexp_replace({x}, '^{_WS}+|{_WS}+$', '', 'g')"


CATEGORIES_SQL = "SELECT DISTINCT source_category FROM offers"
GROUP_A_SQL = ", ".join(repr(c) for c in FX.GROUP_A)
CLEAN_COLS = ("name, main_category, sub_category, source_category, ratings, no_of_ratings, discount_price, "
              "actual_price, round((actual_price - discount_price) / nullif(actual_price, 0) * CAST(100 AS DOUBLE), 2) "
              "AS discount_pct, actual_price - discount_price AS savings")
RENDERED_NAME = "CASE WHEN l_linenumber = 1 THEN concat(name, ', \"special\" edition') ELSE name END"


@register("csv_ingest", V.with_views(f"""
SELECT {CLEAN_COLS} FROM (
  SELECT {RENDERED_NAME} AS name,
         CASE WHEN source_category IN ({GROUP_A_SQL}) THEN main_category END AS main_category,
         sub_category, source_category, ratings, no_of_ratings, discount_price, actual_price FROM offers) p""",
                                      "offers"))
def q_csv_ingest(spark, sf):
    offers = V.offers(spark, sf)
    folder = scratch_dir(spark, "csv")
    FX.write_category_csvs(offers, folder)
    return C.clean_products(CSV.read_products(spark, folder, multi_line=False))


@register("csv_combined", V.with_views(f"""
SELECT {CLEAN_COLS} FROM (
  SELECT {RENDERED_NAME} AS name, main_category, sub_category, main_category AS source_category,
         ratings, no_of_ratings, discount_price, actual_price FROM offers) p""", "offers"))
def q_csv_combined(spark, sf):
    folder = scratch_dir(spark, "csv-combined")
    FX.write_combined_csv(V.offers(spark, sf), folder, with_main=True)
    return C.clean_products(CSV.read_products(spark, folder, multi_line=False))


def _jsonl_expected() -> str:
    k = "(doc_id % 20)"
    text = f"CASE WHEN {k} = 5 THEN concat(chr(160), text, chr(160)) ELSE text END"
    raw = duck_ustrip(text)
    title = (f"CASE WHEN {k} % 4 IN (0, 1) THEN '' ELSE {duck_ustrip('substr(text, 1, 30)')} END")
    asin_key = f"CASE WHEN {k} = 17 THEN '' ELSE concat('A', CAST(doc_id AS VARCHAR)) END"
    asin = (f"CASE WHEN doc_id % 3 = 1 THEN concat('P', CAST(doc_id % 50 AS VARCHAR)) "
            f"WHEN {k} = 17 THEN 'UNKNOWN' ELSE concat('A', CAST(doc_id AS VARCHAR)) END")
    user = "concat('u', CAST(doc_id % 97 AS VARCHAR))"
    rating = f"CASE WHEN {k} IN (13, 15) THEN NULL ELSE CAST(doc_id % 5 + 1 AS DOUBLE) END"
    verified = f"CASE WHEN {k} = 2 THEN true WHEN {k} = 9 THEN false ELSE doc_id % 3 <> 0 END"
    ts = f"CASE WHEN {k} = 19 THEN epoch_ms(0) ELSE epoch_ms(1600000000000 + doc_id * 259200000) END"
    helpful = f"CASE WHEN {k} IN (8, 10) THEN 0 ELSE doc_id % 7 END"
    return f"""
WITH l AS (SELECT lang AS category, doc_id, {raw} AS raw_text, {title} AS title, {asin_key} AS asin_key,
                  {asin} AS asin, {user} AS user_id, {rating} AS rating, {verified} AS verified, {ts} AS ts,
                  CAST({helpful} AS BIGINT) AS helpful_vote
           FROM documents WHERE {k} NOT IN (3, 7, 11)),
o AS (SELECT *, row_number() OVER (PARTITION BY category ORDER BY doc_id) AS ordinal FROM l),
h AS (SELECT *, md5(concat(user_id, ':', asin_key, ':', CAST(ordinal AS VARCHAR))) AS hx FROM o)
SELECT category, CAST(ordinal AS BIGINT) AS ordinal,
       concat(substr(hx, 1, 8), '-', substr(hx, 9, 4), '-', substr(hx, 13, 4), '-', substr(hx, 17, 4), '-',
              substr(hx, 21, 12)) AS id,
       sha256(concat_ws(chr(1), category, user_id, asin_key, raw_text)) AS content_id,
       asin, title, raw_text AS text, rating, ts AS timestamp, helpful_vote, verified,
       CAST(length(raw_text) AS BIGINT) AS text_len
FROM h WHERE length(raw_text) >= 50 AND rating IS NOT NULL"""


@register("jsonl_ingest", _jsonl_expected())
def q_jsonl_ingest(spark, sf):
    docs = V.table(spark, sf, "documents")
    paths = FX.write_review_files(docs, scratch_dir(spark, "jsonl"))
    return J.load_reviews(spark, paths)


@register("jsonl_rejects", """
SELECT lang AS category, count(*) FILTER (WHERE doc_id % 20 = 3) AS blank,
       count(*) FILTER (WHERE doc_id % 20 IN (7, 11)) AS malformed,
       count(*) FILTER (WHERE doc_id % 20 NOT IN (3, 7, 11)) AS parsed
FROM documents GROUP BY lang""")
def q_jsonl_rejects(spark, sf):
    docs = V.table(spark, sf, "documents")
    paths = FX.write_review_files(docs, scratch_dir(spark, "jsonl-rej"))
    return J.reject_counts(J.parse_lines(J.read_lines(spark, paths)))


@register("parquet_sinks", with_products(f"""
SELECT source_category, count(*) AS products, round(sum(discount_price), {D6}) AS total_price,
       CAST(sum(no_of_ratings) AS BIGINT) AS total_ratings, count(discount_pct) AS with_pct
FROM products GROUP BY source_category"""))
def q_parquet_sinks(spark, sf):
    folder = scratch_dir(spark, "sinks")
    cleaned = C.keep_existing(products(spark, sf), C.PRODUCT_COLUMNS)
    P.write_products(cleaned, f"{folder}/products")
    back = spark.read.parquet(f"{folder}/products")
    return (back.groupBy("source_category")
            .agg(F.count(F.lit(1)).alias("products"), F.round(F.sum("discount_price"), D6).alias("total_price"),
                 F.sum("no_of_ratings").alias("total_ratings"), F.count("discount_pct").alias("with_pct")))


@register("monthly_sink", V.with_views(f"""
SELECT category, CAST(date_trunc('month', review_ts) AS DATE) AS dt,
       round(avg(least(greatest((rating - CAST(3 AS DOUBLE)) / CAST(2 AS DOUBLE), CAST(-1 AS DOUBLE)), CAST(1 AS DOUBLE))), 3)
       AS avg_sentiment, count(rating) AS review_count
FROM reviews_v WHERE review_ts IS NOT NULL GROUP BY 1, 2""", "reviews_v"))
def q_monthly_sink(spark, sf):
    folder = scratch_dir(spark, "monthly")
    P.write_monthly(A.monthly_sentiment(V.reviews_v(spark, sf), ts="review_ts"), f"{folder}/monthly")
    return spark.read.parquet(f"{folder}/monthly")


# ---- S5, U1, F2, F3, F13 ------------------------------------------------------

@register("conform_columns", """
SELECT md5(concat(c_name, chr(1), c_mktsegment)) AS product_id, c_name AS title, c_mktsegment AS category, 'Unknown' AS subcategory,
       CASE WHEN c_custkey % 3 = 0 THEN c_acctbal + 1 ELSE c_acctbal END AS price, c_acctbal + 2 AS list_price,
       CAST(NULL AS DOUBLE) AS discount_pct, CAST(c_nationkey AS DOUBLE) AS rating, c_custkey AS rating_count,
       CAST(NULL AS DOUBLE) AS wilson_score
FROM customer""")
def q_conform_columns(spark, sf):
    """S5, product side: messy names, two aliases of one column, a generated key."""
    cust = V.table(spark, sf, "customer")
    messy = cust.select(F.col("c_name").alias(" Name "), F.col("c_mktsegment").alias("Main-Category"),
                        F.when(F.col("c_custkey") % 3 != 0, F.col("c_acctbal")).alias("Discount Price"),
                        (F.col("c_acctbal") + 1).alias("discounted_price"), (F.col("c_acctbal") + 2).alias("Actual Price"),
                        F.col("c_nationkey").alias("RATINGS"), F.col("c_custkey").alias("no of ratings"))
    return P.conform_products(messy, {"subcategory": "Unknown"})


@register("conform_reviews", V.with_views("""
SELECT CAST(review_id AS VARCHAR) AS review_id, CAST(product_id AS VARCHAR) AS product_id, category, rating,
       CAST(NULL AS VARCHAR) AS sentiment, sentiment_score, CAST(NULL AS VARCHAR) AS review_text, topic_id, topic_label,
       CAST(NULL AS DOUBLE) AS x, CAST(NULL AS DOUBLE) AS y, CAST(review_ts AS TIMESTAMP) AS review_month, similarity
FROM reviews_v""", "reviews_v"))
def q_conform_reviews(spark, sf):
    """S5, review side: a written artifact with its own names, read back through the conformer; missing columns are null."""
    r = V.reviews_v(spark, sf)
    path = f"{scratch_dir(spark, 'reviews')}/artifact"
    r.select("review_id", "product_id", "category", F.col("rating").alias("Score"), "sentiment_score", "topic_id",
             F.col("topic_label").alias("topic"), "similarity", F.col("review_ts").alias("Date")).write.parquet(path)
    return P.read_parquet_conformed(spark, path, P.REVIEW_COLUMNS, P.REVIEW_ALIASES)


@register("diagonal_union", """
SELECT id, name, acctbal, segment, nation, greatest(coalesce(n_orders, 1), 1) AS n_orders FROM (
  SELECT c_custkey AS id, c_name AS name, c_acctbal AS acctbal, c_mktsegment AS segment, CAST(NULL AS INTEGER) AS nation,
         CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_custkey % 5 END AS n_orders FROM customer
  UNION ALL
  SELECT s_suppkey, s_name, s_acctbal, NULL, s_nationkey, NULL FROM supplier) u
WHERE id IS NOT NULL AND name IS NOT NULL""")
def q_diagonal_union(spark, sf):
    c = V.table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("acctbal"),
        F.col("c_mktsegment").alias("segment"),
        F.when(F.col("c_custkey") % 7 == 0, F.lit(None)).otherwise(F.col("c_custkey") % 5).alias("n_orders"))
    s = V.table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("acctbal"),
        F.col("s_nationkey").alias("nation"))
    u = c.unionByName(s, allowMissingColumns=True)
    u = C.drop_nulls(C.keep_existing(u, ["id", "name", "acctbal", "segment", "nation", "n_orders", "missing"]),
                     ["id", "name"])
    return u.withColumn("n_orders", S.count_default("n_orders"))


# ---- F6, F7, C10-C14, C18, C19 on the documents and conversations tables ------------

@register("review_gate", f"""
SELECT doc_id, CAST(length({duck_ustrip('text')}) AS BIGINT) AS text_len FROM documents
WHERE length({duck_ustrip('text')}) >= 50 AND doc_id % 13 <> 0 AND doc_id % 3 <> 0""")
def q_review_gate(spark, sf):
    d = V.table(spark, sf, "documents").select(
        "doc_id", "text", F.when(F.col("doc_id") % 13 == 0, F.lit(None)).otherwise(F.col("doc_id") % 5 + 1)
        .alias("rating"), (F.col("doc_id") % 3 != 0).alias("verified"))
    g = C.quality_gate(d, min_chars=50, verified_only=True)
    return g.select("doc_id", S.text_length(S.ustrip("text")).alias("text_len"))


@register("review_cap", f"""
SELECT conv_id, turn, role FROM (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS rn FROM conversations
  WHERE length({duck_ustrip('text')}) >= 50) t WHERE rn <= 3""")
def q_review_cap(spark, sf):
    conv = V.table(spark, sf, "conversations").withColumn("rating", F.lit(1.0))
    kept = C.quality_gate(conv, min_chars=50)
    return C.cap_per_category(kept, 3, category="conv_id", ordinal="turn").select("conv_id", "turn", "role")


@register("review_records", f"""
WITH d AS (SELECT doc_id, source AS category, {duck_ustrip('text')} AS t, concat('u', CAST(doc_id % 97 AS VARCHAR)) AS u,
                  concat('A', CAST(doc_id AS VARCHAR)) AS a, CAST(doc_id % 5 + 1 AS DOUBLE) AS rating,
                  CASE WHEN doc_id % 4 = 0 THEN '' ELSE substr(text, 1, 10) END AS title0 FROM documents),
r AS (SELECT *, t AS body, md5(concat(u, ':', a, ':', CAST(doc_id AS VARCHAR))) AS hx,
             CASE WHEN title0 = '' THEN substr(t, 1, 120) ELSE title0 END AS title FROM d)
SELECT doc_id, concat(substr(hx, 1, 8), '-', substr(hx, 9, 4), '-', substr(hx, 13, 4), '-', substr(hx, 17, 4), '-',
                      substr(hx, 21, 12)) AS id,
       title, category, round(least(greatest((rating - CAST(3 AS DOUBLE)) / CAST(2 AS DOUBLE), CAST(-1 AS DOUBLE)),
                                    CAST(1 AS DOUBLE)), 4) AS sentiment_score,
       regexp_replace(concat(title, '. ', body), '^[ .]+|[ .]+$', '', 'g') AS review_text,
       CAST(length(body) AS BIGINT) AS text_len
FROM r""")
def q_review_records(spark, sf):
    d = V.table(spark, sf, "documents")
    d = d.select("doc_id", F.col("source").alias("category"), S.ustrip("text").alias("t"),
                 F.concat(F.lit("u"), (F.col("doc_id") % 97).cast("string")).alias("u"),
                 F.concat(F.lit("A"), F.col("doc_id").cast("string")).alias("a"),
                 (F.col("doc_id") % 5 + 1).cast("double").alias("rating"),
                 F.when(F.col("doc_id") % 4 == 0, F.lit("")).otherwise(F.substring("text", 1, 10)).alias("title0"))
    body = F.col("t")
    title = S.title_fallback("title0", body, J.TITLE_FALLBACK_CHARS)
    return d.select("doc_id", S.stable_id("u", "a", "doc_id").alias("id"), title.alias("title"), "category",
                    S.rating_to_sentiment("rating", 4).alias("sentiment_score"),
                    S.compose_review_text(title, body).alias("review_text"),
                    S.text_length(body).alias("text_len"))


# ---- S4 parsing, C15, C16, C23 on events -----------------------------------------

@register("parse_events_json", """
SELECT event_id, event_type, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events""")
def q_parse_events_json(spark, sf):
    e = J.parse_lines(V.table(spark, sf, "events").withColumnRenamed("props", "line"))
    return e.select("event_id", "event_type", S.lenient_bigint(F.col("rec").getItem("k")).alias("k"))


@register("epoch_to_ts", """
SELECT event_id, epoch_ms(epoch_us(ts) // 1000) AS ts_ms, CAST(date_trunc('month', ts) AS DATE) AS month,
       epoch_us(ts) // 1000 AS epoch_ms, CAST(strftime(ts, '%Y-%m-%dT%H:%M:%S') AS TIMESTAMP) AS ts_iso FROM events""")
def q_epoch_to_ts(spark, sf):
    e = V.table(spark, sf, "events")
    ms = F.unix_millis(F.col("ts").cast("timestamp"))
    iso = F.date_format(F.col("ts"), "yyyy-MM-dd'T'HH:mm:ss")
    return e.select("event_id", S.epoch_ms_to_ts(ms.cast("string")).alias("ts_ms"), S.month_start("ts").alias("month"),
                    ms.alias("epoch_ms"), S.iso_to_ts(iso).alias("ts_iso"))
