"""Properties: top-k bounds, histogram totals, volume conservation, search recall, components, partition invariance."""

import math
import random

import pytest
from pyspark.sql import functions as F

from cartwheel.operators import aggregates as A
from cartwheel.operators import components as CC
from cartwheel.operators import histograms as H
from cartwheel.operators import ranking as R
from cartwheel.operators import topics as T
from cartwheel.operators import vectors as VX
from cartwheel.plans import registry as REG
from cartwheel.plans import views as V
from tests.conftest import SF_SMALL


def planted(spark, centres=5, per=60, far=30, dim=16, seed=11):
    """5 centres × 60 unit vectors around them + 30 far points (fixed integer seeds)."""
    rnd = random.Random(seed)

    def unit(v):
        n = math.sqrt(sum(x * x for x in v))
        return [x / n for x in v]
    cs = [unit([rnd.gauss(0, 1) for _ in range(dim)]) for _ in range(centres)]
    rows, i = [], 0
    for c_id, c in enumerate(cs):
        for _ in range(per):
            rows.append((i, unit([x + rnd.gauss(0, 0.08) for x in c]), c_id))
            i += 1
    for _ in range(far):
        rows.append((i, unit([rnd.gauss(0, 1) for _ in range(dim)]), -1))
        i += 1
    df = spark.createDataFrame(rows, "id bigint, embedding array<double>, label int")
    qs = spark.createDataFrame([(j, c) for j, c in enumerate(cs)], "qid int, qvec array<double>")
    return df, qs, rows


def test_top_deals_bounds(spark):
    p = REG.products(spark, SF_SMALL)
    top = R.top_deals(p, k=5, tiebreak=REG.OFFER_TIEBREAK)
    per = top.groupBy("source_category").count().collect()
    assert all(r["count"] <= 5 for r in per)
    inc = top.groupBy("source_category").agg(F.min("discount_pct").alias("lo"))
    exc = p.where((F.col("discount_pct") > 0) & (F.col("discount_pct") <= 95))
    worse = exc.join(inc, "source_category").where(F.col("discount_pct") > F.col("lo")).count()
    kept = top.count()
    assert worse <= kept  # every row strictly above the cut-off is among the kept rows


def test_histogram_totals(spark):
    p = REG.products(spark, SF_SMALL)
    ph = H.price_histogram(p).agg(F.sum("count")).first()[0]
    assert ph == p.where(F.col("discount_price") > 0).count()
    rh = H.rating_histogram(p).agg(F.sum("count")).first()[0]
    assert rh == p.where(F.col("ratings").between(1, 5)).count()
    bins = H.price_histogram(p).agg(F.min("bin"), F.max("bin")).first()
    assert bins[0] >= 0 and bins[1] <= 39


def test_review_volume_conserves_rating_counts(spark):
    prods, revs = V.product_dim(spark, SF_SMALL), REG.dash_reviews(spark, SF_SMALL)
    vol = A.review_volume(prods, revs, None).agg(F.sum("volume")).first()[0]
    reviewed = revs.where(F.col("review_month").isNotNull()).select("product_id").distinct()
    expect = (prods.join(reviewed, "product_id", "left_semi")
              .where(F.col("rating_count").isNotNull() & F.col("category").isNotNull())
              .agg(F.sum("rating_count")).first()[0])
    assert math.isclose(vol, expect, rel_tol=1e-9)


def test_ann_recall_on_planted_clusters(spark):
    df, qs, _ = planted(spark)
    exact = VX.knn_exact(qs, df, k=10)
    indexed, cents = VX.build_ivf(df, n_cells=8)
    approx = VX.knn_ann(qs, indexed, cents, k=10, nprobe=3)
    assert VX.recall_at_k(approx, exact).first()["recall"] >= 0.98
    assert approx.groupBy("qid").count().agg(F.max("count")).first()[0] == 10


def _union_find(n_ids, pairs):
    parent = {i: i for i in n_ids}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x
    for a, b in pairs:
        ra, rb = find(a), find(b)
        if ra != rb:
            parent[max(ra, rb)] = min(ra, rb)
    return {i: find(i) for i in n_ids}


def test_threshold_components_equal_brute_force(spark):
    df, _, rows = planted(spark, far=30)
    t = 0.9
    pairs = [(a[0], b[0]) for ai, a in enumerate(rows) for b in rows[ai + 1:]
             if sum(x * y for x, y in zip(a[1], b[1])) >= t]
    expect = _union_find([r[0] for r in rows], pairs)
    got = {r["id"]: r["component"] for r in CC.threshold_components(df, t, n_cells=6).collect()}
    assert got == expect
    degree = dict.fromkeys([r[0] for r in rows], 1)
    for a, b in pairs:
        degree[a] += 1
        degree[b] += 1
    graph = CC.ThresholdGraph(df, t, n_cells=6, block=16)
    nodes = {r["node"]: r["deg"] for r in graph.degrees().collect()}
    assert {r["id"]: nodes[r["node"]] for r in graph.members.collect()} == degree


def test_dense_group_has_linear_output(spark):
    import numpy as np
    rng = np.random.default_rng(4)
    x = np.ones((20_000, 8)) + rng.normal(scale=0.01, size=(20_000, 8))
    df = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())] + [(20_000, x[0].tolist())], "id bigint, embedding array<double>")
    graph = CC.ThresholdGraph(df, 0.99)
    links = graph.run("forest").count()
    assert links < 4 * 20_000
    assert CC.threshold_components(df, 0.99).where("component <> 0").count() == 0


def test_components_limit_raises(spark):
    chain = spark.createDataFrame([(i, i + 1) for i in range(64)], "a bigint, b bigint")
    with pytest.raises(RuntimeError):
        CC.connected_components(chain, max_rounds=1)
    assert CC.connected_components(chain).where("component <> 0").count() == 0


def test_density_topics_find_planted_clusters(spark):
    df, _, rows = planted(spark)
    out = T.density_topics(df, eps_cos=0.9, min_samples=5, min_cluster_size=20, n_cells=6).join(df, "id")
    by_label = {r["label"]: r["n"] for r in out.where(F.col("label") >= 0).groupBy("label")
                .agg(F.count_distinct("topic").alias("n")).collect()}
    assert all(v == 1 for v in by_label.values()) and len(by_label) == 5
    assert out.where(F.col("label") >= 0).select("topic").distinct().count() == 5
    assert out.where((F.col("label") == -1) & (F.col("topic") != -1)).count() == 0


def test_ctfidf_independent_of_partitioning(spark):
    docs = V.table(spark, SF_SMALL, "documents").select(F.col("source").alias("topic"), "text")
    a = {tuple(r) for r in T.topic_keywords(docs, n=8, digits=9).collect()}
    b = {tuple(r) for r in T.topic_keywords(docs.repartition(1), n=8, digits=9).collect()}
    c = {tuple(r) for r in T.topic_keywords(docs.repartition(7, "text"), n=8, digits=9).collect()}
    assert a == b == c


def test_stable_sample_is_stable(spark):
    d = V.table(spark, SF_SMALL, "documents")
    s1 = [r[0] for r in R.stable_sample(d, 25, "doc_id", seed=3).select("doc_id").collect()]
    s2 = [r[0] for r in R.stable_sample(d.repartition(5), 25, "doc_id", seed=3).select("doc_id").collect()]
    assert s1 == s2 and len(s1) == 25 and len(set(s1)) == 25


def test_hash_embed_unit_norm(spark):
    d = V.table(spark, SF_SMALL, "documents").select("doc_id", "text")
    e = VX.hash_embed(d, dim=64)
    norms = e.select(F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x * x)).alias("n"))
    bad = norms.where(F.abs(F.col("n") - 1.0) > 1e-5).count()
    assert bad == 0 and e.count() == d.count()


def test_empty_inputs_give_empty_outputs(spark):
    revs = REG.dash_reviews(spark, SF_SMALL).limit(0)
    assert A.topic_summary(revs, sentiment="sentiment").count() == 0
    assert A.sentiment_timeline(revs).count() == 0
    assert A.linear_trend(A.category_points(V.product_dim(spark, SF_SMALL), revs)).count() == 0
    assert A.discount_sentiment_correlation(A.category_points(V.product_dim(spark, SF_SMALL), revs)) \
        .first()["correlation"] is None


def test_correlation_constant_and_single_point(spark):
    pts = spark.createDataFrame([("a", 1.0, 0.5), ("b", 1.0, 0.7)], "category string, avg_discount double, "
                                                                    "avg_sentiment double")
    assert A.discount_sentiment_correlation(pts).first()["correlation"] is None
    assert A.linear_trend(pts).count() == 0
    one = pts.limit(1)
    assert A.discount_sentiment_correlation(one).first()["correlation"] is None


@pytest.mark.parametrize("scale", [0.001, 1.0, 1e9])
def test_grouped_quantiles_equal_exact_percentile(spark, scale):
    from cartwheel.operators.quantiles import grouped_quantiles
    rnd = random.Random(5)
    rows = [(rnd.choice(["a", "b", None, "hot"]) if i % 3 else "hot", scale * rnd.choice([-1, 1]) * rnd.randint(0, 40) if i % 11 else None)
            for i in range(3000)]
    df = spark.createDataFrame(rows, "g string, v double")
    probs = [0.0, 0.01, 0.25, 0.5, 0.99, 1.0]
    got = {r["g"]: [r[f"q{i}"] for i in range(len(probs))]
           for r in grouped_quantiles(df, "v", ["g"], probs).collect()}
    want = {r["g"]: list(r["p"]) for r in df.where(F.col("v").isNotNull()).groupBy("g")
            .agg(F.percentile("v", F.array(*[F.lit(p) for p in probs])).alias("p")).collect()}
    assert set(got) == set(want)
    for g in want:
        assert all(math.isclose(x, y, rel_tol=1e-12, abs_tol=1e-9) for x, y in zip(got[g], want[g])), g


def test_quantiles_of_values_crowded_into_one_bucket(spark):
    from cartwheel.operators.quantiles import RADIX, grouped_quantiles
    df = spark.range(300_000).selectExpr("(id * 7919 % 300007) / 300007.0 / 1000 AS v", "id % 2 AS g")
    probs = [0.0, 0.01, 0.5, 0.999, 1.0]
    got = grouped_quantiles(df, "v", [], probs)
    want = df.agg(F.percentile("v", F.array(*[F.lit(p) for p in probs])).alias("p")).first()["p"]
    assert all(math.isclose(x, y, rel_tol=1e-12) for x, y in zip(got.first(), want))
    extremes = spark.createDataFrame([(x,) for x in (-1e308, -1e308, 0.0, -0.0, 1e-320, 5e-324, 1e308, 1.7e308, float("inf"))], "v double")
    assert list(grouped_quantiles(extremes, "v", [], [0.0, 0.5, 0.875, 1.0]).first()) == [-1e308, 5e-324, 1.7e308, math.inf]
    assert RADIX <= 1 << 16


def test_knn_exact_equals_brute_force_with_string_ids(spark):
    df, qs, rows = planted(spark, far=30)
    corpus = df.select(F.concat(F.lit("r"), F.col("id").cast("string")).alias("rid"), "embedding",
                       (F.col("id") % 3).cast("string").alias("cat"))
    qcat = qs.withColumn("q_category", (F.col("qid") % 3).cast("string"))
    got = {(r["qid"], r["rid"]): r["rank"] for r in
           VX.knn_exact(qcat, corpus, k=7, id_col="rid", q_category="q_category", category="cat").collect()}
    qv = {r["qid"]: r["qvec"] for r in qs.collect()}
    want = {}
    for q, v in qv.items():
        scored = sorted(((-sum(a * b for a, b in zip(v, e)), f"r{i}") for i, e, _ in rows if i % 3 == q % 3))
        for rank, (_, rid) in enumerate(scored[:7], start=1):
            want[(q, rid)] = rank
    assert got == want


def test_dataframe_and_sql_forms_agree(spark):
    from cartwheel.operators import aggregates as AG
    from cartwheel.plans import sql as Q
    p = REG.products(spark, SF_SMALL)
    p.createOrReplaceTempView("products_diff")
    cols = ["sub_category", "product_count", "price_min", "price_max", "price_mean", "avg_discount_pct",
            "avg_rating", "total_ratings"]
    df_form = {tuple(r) for r in AG.category_stats(p).select(*cols).collect()}
    sql_form = {tuple(r) for r in Q.category_stats_sql(spark, "products_diff", digits=2, rating_digits=3)
                .select(*cols).collect()}
    assert df_form == sql_form
    a = [tuple(r) for r in R.top_deals(p, 5, tiebreak=REG.OFFER_TIEBREAK).collect()]
    b = [tuple(r) for r in Q.top_deals_sql(spark, "products_diff", 5, tiebreak=REG.OFFER_TIEBREAK).collect()]
    assert a == b


def test_sorted_index_matches_global_row_number(spark):
    from pyspark.sql import Window
    df = spark.range(0, 5000, numPartitions=5).select((F.col("id") * 7919 % 97).alias("size"),
                                                      F.col("id").alias("cluster"))
    a = {r["cluster"]: r["index"] for r in R.sorted_index(df, [F.desc("size"), F.asc("cluster")]).collect()}
    w = Window.orderBy(F.desc("size"), F.asc("cluster"))
    b = {r["cluster"]: r["i"] for r in df.withColumn("i", F.row_number().over(w) - 1).collect()}
    assert a == b


def test_knn_exact_query_blocks_agree(spark):
    c = V.table(spark, SF_SMALL, "embeddings").select(F.col("vec_id").alias("id"), "embedding", "label")
    q = VX.label_centroids(c)
    whole = sorted(tuple(r) for r in VX.knn_exact(q, c, k=5, digits=9).collect())
    blocked = sorted(tuple(r) for r in VX.knn_exact(q, c, k=5, digits=9, query_values=64 * 3, corpus_values=64 * 40).collect())
    assert whole == blocked and len(whole) > 0


def test_knn_exact_answers_every_query(spark):
    import numpy as np
    c = V.table(spark, SF_SMALL, "embeddings").select(F.col("vec_id").alias("id"), "embedding").limit(60)
    vecs = [[float(x) for x in r.embedding] for r in c.collect()]
    q = spark.range(50_000).select(F.col("id").alias("qid"), F.concat(F.lit("wide "), F.col("id").cast("string")).alias("note"),
                                   F.transform(F.sequence(F.lit(0), F.lit(63)), lambda i: F.sin(F.col("id") * 0.37 + i)).alias("qvec"))
    got = VX.knn_exact(q, c, k=2)
    counts = got.agg(F.count(F.lit(1)), F.count_distinct("qid")).first()
    assert tuple(counts) == (100_000, 50_000)
    for r in got.where("rank = 1 AND qid % 9973 = 0").collect():
        v = np.sin(r.qid * 0.37 + np.arange(64))
        assert abs(max(np.array(vecs) @ v) - r.score) < 1e-9


def test_sorted_index_keeps_wide_rows(spark):
    df = spark.range(60_000).select((F.col("id") * 7919 % 60_000).alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("wide"))
    out = R.sorted_index(df, [F.asc("k")])
    assert out.where(F.col("k") == F.col("index")).count() == 60_000


def test_upsert_last_sequence_wins(spark):
    from cartwheel.sources import parquet as P
    ex = spark.createDataFrame([(1, [1.0]), (2, [1.0])], "id bigint, embedding array<double>")
    rows = [(1, [2.0], 1), (1, [3.0], 2), (3, [9.0], 1), (3, None, 5), (None, [4.0], 1)]
    for up in (rows, rows[::-1]):
        merged, rejects = P.upsert_vectors(ex, spark.createDataFrame(up, "id bigint, embedding array<double>, seq int"), sequence="seq")
        assert {r.id: list(r.embedding) for r in merged.collect()} == {1: [3.0], 2: [1.0], 3: [9.0]}
        assert rejects.count() == 2


def test_lookup_keeps_the_first_of_repeated_products(spark):
    prods = spark.createDataFrame([(1, 10.0, 2), (1, 30.0, 1), (2, None, 1), (2, 50.0, 2)], "product_id bigint, discount_pct double, seq int")
    revs = spark.sql("SELECT explode(array(1L, 1L, 2L)) AS product_id, timestamp'2024-03-05' AS review_month, 'c' AS category")
    row = A.discount_timeline(prods, revs, dedupe_order=["seq"]).first()
    assert (row.avg_discount, row.n) == (30.0, 2)


def test_cap_per_category_without_partial_limit(spark):
    from cartwheel.operators.clean import cap_per_category
    df = spark.range(4000).select(F.when(F.col("id") % 3 > 0, "hot").when(F.col("id") % 7 > 0, "b").alias("category"),
                                  (F.col("id") * 7919 % 4000).alias("ordinal"))
    few = sorted(cap_per_category(df, 700).collect(), key=str)
    assert few == sorted(cap_per_category(df, 700, partial_limit=10).collect(), key=str) and len(few) > 1400
