"""Driver keys for search, vectors and topics."""

from __future__ import annotations

from pyspark.sql import functions as F

from cartwheel.operators import components as CC
from cartwheel.operators import encoder as EN
from cartwheel.operators import hierarchy as HI
from cartwheel.operators import manifold as MF
from cartwheel.operators import quantized as QZ
from cartwheel.operators import ranking as R
from cartwheel.operators import search as SR
from cartwheel.operators import substrings as SU
from cartwheel.operators import topics as T
from cartwheel.operators import vectors as VX
from cartwheel.functions import scalars as S
from cartwheel.plans import views as V
from cartwheel.plans.registry import CAT_LIST, D6, DEFAULT_CATEGORIES, dash_reviews, register, with_dash
from cartwheel.session import scratch_dir, written
from cartwheel.sources import parquet as P
from cartwheel.sources import vector_store as VS

EV_SQL = """ev AS (SELECT vec_id, label, CAST(x AS DOUBLE) AS x, i FROM
        (SELECT vec_id, label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i FROM embeddings))"""
CENTROID_SQL = EV_SQL + """,
c AS (SELECT label, i, avg(x) AS m FROM ev GROUP BY label, i),
n AS (SELECT label, sqrt(sum(m * m)) AS nrm FROM c GROUP BY label),
q AS (SELECT c.label AS qid, c.i, CASE WHEN n.nrm = 0 THEN 0 ELSE c.m / n.nrm END AS qv FROM c JOIN n ON c.label = n.label)"""


def corpus(spark, sf):
    return V.table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), "embedding", "label")


KNN_SQL = f"""
WITH {CENTROID_SQL},
s AS (SELECT q.qid, ev.vec_id, sum(q.qv * ev.x) AS score FROM q JOIN ev ON q.i = ev.i GROUP BY q.qid, ev.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY round(score, {D6}) DESC, vec_id) AS rank FROM s)
SELECT qid, vec_id AS id, round(score, {D6}) AS score, CAST(rank AS BIGINT) AS rank FROM r WHERE rank <= 5"""


@register("knn_exact", KNN_SQL)
def q_knn_exact(spark, sf):
    c = corpus(spark, sf)
    out = VX.knn_exact(VX.label_centroids(c), c, k=5, digits=D6)
    return out.withColumn("rank", F.col("rank").cast("bigint"))


# Query category of each label centroid: (label + 5) % 12, so two query categories do not occur.
UNIT_SQL = EV_SQL + """,
nr AS (SELECT vec_id, sqrt(sum(x * x)) AS nrm FROM ev GROUP BY vec_id),
u AS (SELECT ev.vec_id, i, CASE WHEN nrm = 0 THEN 0 ELSE x / nrm END AS x FROM ev JOIN nr ON ev.vec_id = nr.vec_id)"""


@register("knn_pruned", f"""
WITH {UNIT_SQL},
s AS (SELECT a.vec_id AS qid, b.vec_id AS id, sum(a.x * b.x) AS score FROM u a JOIN u b ON a.i = b.i WHERE a.vec_id % 10 = 0 GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY round(score, {D6}) DESC, id) AS rank FROM s)
SELECT qid, id, round(score, {D6}) AS score, rank FROM r WHERE rank <= 5""")
def q_knn_pruned(spark, sf):
    """E4/J7 with pruned cells: every tenth vector asks the whole table."""
    c = corpus(spark, sf)
    asked = c.where("id % 10 = 0").select(F.col("id").alias("qid"), F.col("embedding").alias("qvec"))
    return QZ.knn_pruned(asked, QZ.build_cells(c), k=5, digits=D6).withColumn("rank", F.col("rank").cast("bigint"))


@register("knn_codes_recall", """
SELECT count(*) AS queries, true AS recall_at_least_09, CAST(5 AS BIGINT) AS hits_each FROM embeddings WHERE vec_id % 10 = 0""")
def q_knn_codes_recall(spark, sf):
    """E5: recall@5 of the search by codes against the exact search, every tenth vector asking the whole table."""
    c = corpus(spark, sf)
    asked = c.where("id % 10 = 0").select(F.col("id").alias("qid"), F.col("embedding").alias("qvec"))
    cells = QZ.build_cells(c)
    books = QZ.fit_codebooks(cells)
    found = written(QZ.knn_codes(asked, cells, QZ.encode(cells, books), books, k=5), "found")
    recall = VX.recall_at_k(found, QZ.knn_pruned(asked, cells, k=5))
    per = found.groupBy("qid").agg(F.count(F.lit(1)).alias("n")).agg(F.count(F.lit(1)).alias("queries"), F.min("n").cast("bigint").alias("hits_each"))
    return per.join(recall, F.lit(True)).select("queries", (F.col("recall") >= 0.9).alias("recall_at_least_09"), "hits_each")


@register("search_in_category", f"""
WITH {CENTROID_SQL},
qc AS (SELECT DISTINCT qid, CAST((qid + 5) % 12 AS VARCHAR) AS qcat FROM q),
g AS (SELECT * FROM qc WHERE qcat IN (SELECT DISTINCT CAST(label AS VARCHAR) FROM embeddings)),
s AS (SELECT q.qid, ev.vec_id, sum(q.qv * ev.x) AS score FROM q JOIN g ON q.qid = g.qid
      JOIN ev ON q.i = ev.i AND CAST(ev.label AS VARCHAR) = g.qcat GROUP BY q.qid, ev.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY round(score, {D6}) DESC, vec_id) AS rank FROM s)
SELECT qid, vec_id AS id, round(score, {D6}) AS score, CAST(rank AS BIGINT) AS rank FROM r WHERE rank <= 5""")
def q_search_in_category(spark, sf):
    c = corpus(spark, sf)
    qs = VX.label_centroids(c).withColumn("q_category", ((F.col("qid") + 5) % 12).cast("string"))
    out = VX.search_in_category(qs, c, k=5, category="label", filter_hits=True, digits=D6)
    return out.withColumn("rank", F.col("rank").cast("bigint"))


def _ann(spark, sf, nprobe):
    c = corpus(spark, sf)
    indexed, cents = VX.build_ivf(c)
    table = VX.write_vector_table(indexed.drop("cell_cos"), f"{scratch_dir(spark, 'ivf')}/vectors")
    return VX.knn_ann(VX.label_centroids(c), table, cents, k=5, nprobe=nprobe or len(cents), digits=D6)


@register("knn_ann", KNN_SQL)
def q_knn_ann(spark, sf):
    """E3 + E5 with every cell probed: the index loses no row, so the hits are the exact ones."""
    return _ann(spark, sf, None).withColumn("rank", F.col("rank").cast("bigint"))


@register("knn_ann_recall", "SELECT count(DISTINCT label) AS queries, 5 * count(DISTINCT label) AS hits, true AS recall_over_half FROM embeddings")
def q_knn_ann_recall(spark, sf):
    """E5 at a quarter of the cells against E4: complete hit lists, most of them the exact hits."""
    c = corpus(spark, sf)
    indexed, cents = VX.build_ivf(c, n_cells=16)
    approx = VX.knn_ann(VX.label_centroids(c), indexed, cents, k=5, nprobe=4).checkpoint(eager=True)
    exact = VX.knn_exact(VX.label_centroids(c), c, k=5)
    recall = VX.recall_at_k(approx, exact).select((F.col("recall") > 0.5).alias("recall_over_half"))
    counts = approx.agg(F.count_distinct("qid").alias("queries"), F.count(F.lit(1)).alias("hits"))
    return counts.join(recall, F.lit(True))  # one row each


EMBED_SQL = r"""tok AS (SELECT {key} AS key, md5(unnest(regexp_extract_all(lower({text}), '[\p{{L}}\p{{N}}_]{{2,}}'))) AS m FROM {source}),
cnt AS (SELECT key, CAST(concat('0x', substr(m, 1, 8)) AS BIGINT) % 64 AS i,
               CAST(sum(CASE WHEN substr(m, 9, 1) < '8' THEN 1 ELSE -1 END) AS DOUBLE) AS x FROM tok GROUP BY 1, 2),
nrm AS (SELECT key, sqrt(sum(x * x)) AS n FROM cnt GROUP BY key),
vec AS (SELECT key, i, x / n AS x FROM cnt JOIN nrm USING (key) WHERE n > 0)"""


def embed_sql(prefix: str, source: str, key: str, text: str) -> str:
    """CTEs of the signed hash embedding in SQL; the last one, ``<prefix>vec``, has (key, i, x)."""
    sql = EMBED_SQL.format(source=source, key=key, text=text)
    for name in ("tok", "cnt", "nrm", "vec"):
        sql = sql.replace(f"{name} AS (", f"{prefix}{name} AS (").replace(f"FROM {name}", f"FROM {prefix}{name}").replace(
            f"JOIN {name}", f"JOIN {prefix}{name}")
    return sql


QUERIES_SQL = ", ".join(f"(CAST({i} AS BIGINT), '{t}')" for i, t in enumerate(VX.SEARCH_QUERIES))


@register("search_batch", f"""
WITH {embed_sql('d', 'documents', 'doc_id', 'text')},
{embed_sql('q', f'(VALUES {QUERIES_SQL}) v(qid, query)', 'qid', 'query')},
s AS (SELECT q.key AS qid, d.key AS id, round(sum(q.x * d.x), {D6}) AS score FROM qvec q JOIN dvec d USING (i) GROUP BY 1, 2),
a AS (SELECT qid, id, coalesce(score, 0) AS score FROM (SELECT qid, doc_id AS id FROM (SELECT DISTINCT qid FROM s) CROSS JOIN documents) LEFT JOIN s USING (qid, id)),
r AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, id) AS rank FROM a)
SELECT qid, id, score, CAST(rank AS BIGINT) AS rank FROM r WHERE rank <= 5""")
def q_search_batch(spark, sf):
    """The reference's eight query texts against the hash-embedded documents."""
    docs = VX.hash_embed(V.table(spark, sf, "documents").select(F.col("doc_id").alias("id"), "text"), dim=64, double=True)
    docs = written(docs, "embedded")  # the search counts its rows before it joins them: embedded once
    hits = VX.knn_exact(VX.query_frame(spark, VX.SEARCH_QUERIES, dim=64, double=True), docs, k=5, digits=D6)
    return hits.withColumn("rank", F.col("rank").cast("bigint"))


@register("hash_embed", f"""
WITH {embed_sql('d', 'documents', 'doc_id', 'text')}
SELECT key AS doc_id, i, round(x, {D6}) AS x FROM dvec WHERE x <> 0""")
def q_hash_embed(spark, sf):
    """E2 in long form: (doc_id, i, x) of every bucket that is not zero."""
    d = V.table(spark, sf, "documents").select("doc_id", "text")
    e = VX.hash_embed(d, "text", dim=64, double=True).select("doc_id", F.posexplode("embedding").alias("i", "x"))
    return e.where("x <> 0").select("doc_id", F.col("i").cast("bigint").alias("i"), F.round("x", D6).alias("x"))


ENCODER_DIM = 16


@register("encoder_embed", f"""
WITH tok AS (SELECT doc_id AS doc, unnest(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}_]{{2,}}')) AS term FROM documents),
tf AS (SELECT doc, term, CAST(count(*) AS DOUBLE) AS tf FROM tok GROUP BY 1, 2),
kept AS (SELECT term, ln((1 + (SELECT count(*) FROM documents)) / CAST(count(*) + 1 AS DOUBLE)) + 1 AS idf
         FROM tf GROUP BY term HAVING count(*) >= {EN.MIN_DOCS} ORDER BY count(*) DESC, term LIMIT {EN.MAX_TERMS}),
raw AS (SELECT doc, term, tf, idf, tf * idf AS w FROM tf JOIN kept USING (term)),
len AS (SELECT doc, sqrt(sum(w * w)) AS n FROM raw GROUP BY doc),
a AS (SELECT doc, term, raw.w / n AS w FROM raw JOIN len USING (doc)),
r AS (SELECT term, i, CASE WHEN substr(md5(concat(CAST(i AS VARCHAR), ':', term)), 1, 1) < '8' THEN 1.0 ELSE -1.0 END::DOUBLE AS x
      FROM kept, range({ENCODER_DIM}) g(i)),
y AS (SELECT doc, i, sum(w * x) AS x FROM a JOIN r USING (term) GROUP BY 1, 2),
f AS (SELECT term, i, sum(w * x) AS x FROM a JOIN y USING (doc) GROUP BY 1, 2),
e AS (SELECT doc, i, sum(raw.w * f.x) AS x FROM raw JOIN f USING (term) GROUP BY 1, 2),
nrm AS (SELECT doc, sqrt(sum(x * x)) AS n FROM e GROUP BY doc)
SELECT doc AS doc_id, i, round(x / n, {D6}) + 0.0::DOUBLE AS x FROM e JOIN nrm USING (doc) WHERE n > 0""")
def q_encoder_embed(spark, sf):
    """E2 through a model fitted on the whole table (the plain range, which SQL can follow), in long form."""
    d = V.table(spark, sf, "documents").select("doc_id", "text")
    path = f"{scratch_dir(spark, 'encoder')}/model"
    EN.fit(d, path, key="doc_id", dim=ENCODER_DIM, orthonormal=False)
    e = VX.hash_embed(d, "text", encoder=EN.load(spark, path, ENCODER_DIM, double=True))
    e = e.where(F.exists("embedding", lambda x: x != 0)).select("doc_id", F.posexplode("embedding").alias("i", "x"))
    return e.select("doc_id", F.col("i").cast("bigint").alias("i"), (F.round("x", D6) + F.lit(0.0)).alias("x"))


@register("vector_merge", """
WITH up AS (SELECT CASE WHEN s = 3 THEN vec_id + 1000000 ELSE vec_id END AS id, CASE WHEN vec_id % 50 = 0 THEN NULL ELSE embedding END AS embedding,
                   label + 100 * s AS label, s AS seq FROM embeddings, (VALUES (1), (2), (3)) v(s) WHERE vec_id % 9 = 4 OR vec_id % 100 = 0),
ok AS (SELECT id, max_by(embedding, seq) AS embedding, max_by(label, seq) AS label FROM up WHERE embedding IS NOT NULL GROUP BY id),
now AS (SELECT id, label, embedding FROM ok UNION ALL SELECT vec_id, label, embedding FROM embeddings WHERE vec_id NOT IN (SELECT id FROM ok))
SELECT id, label, round(list_sum(CAST(embedding AS DOUBLE[])), 4) + 0.0::DOUBLE AS total FROM now""")
def q_vector_merge(spark, sf):
    """S11 into the bucketed store: a batch of changed and new keys, some without vector, and the rows as read back."""
    c = corpus(spark, sf)
    folder = f"{scratch_dir(spark, 'store')}/vectors"
    VS.write_store(c, folder)
    up = (c.where("id % 9 = 4 OR id % 100 = 0").withColumn("seq", F.explode(F.array(*[F.lit(i) for i in (3, 1, 2)])))
          .select(F.when(F.col("seq") == 3, F.col("id") + 1000000).otherwise(F.col("id")).alias("id"),
                  F.when(F.col("id") % 50 == 0, F.lit(None)).otherwise(F.col("embedding")).alias("embedding"),
                  (F.col("label") + 100 * F.col("seq")).alias("label"), "seq"))
    VS.merge_store(spark, folder, up, sequence="seq")
    total = F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x.cast("double"))
    return VS.read_store(spark, folder).select("id", "label", (F.round(total, 4) + F.lit(0.0)).alias("total"))


@register("vector_upsert", """
WITH up AS (SELECT vec_id AS id, CASE WHEN vec_id % 50 = 0 THEN NULL ELSE embedding END AS embedding, label + 100 * s AS label, s AS seq
            FROM embeddings, (VALUES (1), (2), (3)) v(s) WHERE label % 3 = 0 AND (s < 3 OR vec_id % 2 = 0)),
ok AS (SELECT id, max_by(label, seq) AS label FROM up WHERE embedding IS NOT NULL GROUP BY id)
SELECT id, label, false AS rejected, CAST(1 AS BIGINT) AS n FROM ok
UNION ALL SELECT vec_id, label, false, 1 FROM embeddings WHERE vec_id NOT IN (SELECT id FROM ok)
UNION ALL SELECT id, max(label), true, count(*) FROM up WHERE embedding IS NULL GROUP BY id""")
def q_vector_upsert(spark, sf):
    """A batch with two or three updates per key, some without vector, written over the stored table."""
    c = corpus(spark, sf)
    folder = scratch_dir(spark, "upsert")
    c.write.parquet(f"{folder}/stored")
    up = (c.where(F.col("label") % 3 == 0).withColumn("seq", F.explode(F.array(*[F.lit(i) for i in (3, 1, 2)])))
          .where((F.col("seq") < 3) | (F.col("id") % 2 == 0))
          .select("id", F.when(F.col("id") % 50 == 0, F.lit(None)).otherwise(F.col("embedding")).alias("embedding"),
                  (F.col("label") + 100 * F.col("seq")).alias("label"), "seq"))
    merged = P.write_upsert(spark, f"{folder}/stored", up, f"{folder}/out", sequence="seq")
    rejects = spark.read.parquet(f"{folder}/out/rejects").groupBy("id").agg(F.max("label").alias("label"), F.count(F.lit(1)).alias("n"))
    return merged.select("id", "label", F.lit(False).alias("rejected"), F.lit(1).cast("bigint").alias("n")).unionByName(
        rejects.select("id", "label", F.lit(True).alias("rejected"), "n"))


@register("search_guarded", f"""
WITH {CENTROID_SQL},
g AS (SELECT DISTINCT qid FROM q WHERE CAST((qid + 5) % 12 AS VARCHAR) IN (SELECT DISTINCT CAST(label AS VARCHAR) FROM embeddings)),
s AS (SELECT q.qid, ev.vec_id, sum(q.qv * ev.x) AS score FROM q JOIN g ON q.qid = g.qid JOIN ev ON q.i = ev.i GROUP BY q.qid, ev.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY round(score, {D6}) DESC, vec_id) AS rank FROM s)
SELECT qid, vec_id AS id, round(score, {D6}) AS score, CAST(rank AS BIGINT) AS rank FROM r WHERE rank <= 5""")
def q_search_guarded(spark, sf):
    """E7 as the reference runs it: the category only decides whether a query runs."""
    c = corpus(spark, sf)
    qs = VX.label_centroids(c).withColumn("q_category", ((F.col("qid") + 5) % 12).cast("string"))
    out = VX.search_in_category(qs, c, k=5, category="label", digits=D6)
    return out.withColumn("rank", F.col("rank").cast("bigint"))


@register("embedding_alignment", """
SELECT 'matched' AS kind, count(*) AS n FROM (SELECT DISTINCT doc_id FROM labels) l
  WHERE doc_id IN (SELECT vec_id FROM embeddings)
UNION ALL SELECT 'docs_only', count(*) FROM (SELECT DISTINCT doc_id FROM labels) l
  WHERE doc_id NOT IN (SELECT vec_id FROM embeddings)
UNION ALL SELECT 'vectors_only', count(*) FROM (SELECT DISTINCT vec_id FROM embeddings) e
  WHERE vec_id NOT IN (SELECT doc_id FROM labels)""")
def q_embedding_alignment(spark, sf):
    docs = V.table(spark, sf, "labels").select(F.col("doc_id").alias("id"))
    return P.alignment_report(docs, corpus(spark, sf))


@register("vector_table", """
SELECT doc_id AS id, source AS category, CAST(length(text) AS BIGINT) AS body_chars, CAST(64 AS BIGINT) AS dims, true AS nearest
FROM documents""")
def q_vector_table(spark, sf):
    """S10 + E3: documents with their vectors and IVF cell; ``nearest``: no other centroid is closer than the cell's."""
    docs = V.table(spark, sf, "documents").select(F.col("doc_id").alias("id"), F.col("text").alias("body"),
                                                  F.col("source").alias("category"))
    path = scratch_dir(spark, "vector-table")
    P.embedded_rows(docs, "body", dim=64).write.parquet(path)
    indexed, cents = VX.build_ivf(spark.read.parquet(path), n_cells=8)
    unit = S.l2_normalize("embedding", as_float=False)
    best = F.array_max(F.transform(VX.centroid_literal(cents), lambda c: S.dot(c["c"], F.col("_u"))))
    return (indexed.withColumn("_u", unit)
            .select("id", "category", F.char_length("body").cast("bigint").alias("body_chars"),
                    F.size("embedding").cast("bigint").alias("dims"), (F.abs(best - F.col("cell_cos")) < 1e-6).alias("nearest")))


@register("vector_write", """
SELECT count(*) AS present, count(DISTINCT doc_id) AS keys, CAST(0 AS BIGINT) AS empty_vectors FROM documents""")
def q_vector_write(spark, sf):
    """Documents with their vectors, written, counted back."""
    docs = V.table(spark, sf, "documents").select(F.col("doc_id").alias("id"), F.col("text").alias("body"),
                                                  F.col("source").alias("category"))
    return P.write_vectors(P.embedded_rows(docs, "body", dim=64), f"{scratch_dir(spark, 'vectors')}/collection")


# ---- topics over documents (source as topic) -------------------------------------

TOKENS_SQL = r"""t AS (SELECT source AS topic, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}_]{2,}')) AS term
      FROM documents),
tc AS (SELECT topic, term, count(*) AS tf FROM t GROUP BY 1, 2),
tot AS (SELECT topic, sum(tf) AS words FROM tc GROUP BY 1),
av AS (SELECT floor(avg(words)) AS a FROM tot),
fr AS (SELECT term, sum(tf) AS f FROM tc GROUP BY 1),
w AS (SELECT tc.topic, tc.term, tc.tf, (CAST(tc.tf AS DOUBLE) / CAST(tot.words AS DOUBLE))
             * ln(1 + CAST(av.a AS DOUBLE) / CAST(fr.f AS DOUBLE)) AS weight
      FROM tc JOIN tot ON tc.topic = tot.topic JOIN fr ON tc.term = fr.term CROSS JOIN av),
r AS (SELECT *, row_number() OVER (PARTITION BY topic ORDER BY weight DESC, term) AS rank FROM w)"""


def docs_by_source(spark, sf):
    return V.table(spark, sf, "documents").select(F.col("source").alias("topic"), "text")


@register("topic_keywords", f"""
WITH {TOKENS_SQL}
SELECT topic, CAST(rank AS BIGINT) AS rank, term, round(weight, {D6}) AS weight FROM r WHERE rank <= 8""")
def q_topic_keywords(spark, sf):
    out = T.topic_keywords(docs_by_source(spark, sf), n=8, digits=D6)
    return out.withColumn("rank", F.col("rank").cast("bigint"))


@register("topic_info", f"""
WITH {TOKENS_SQL},
sz AS (SELECT source AS topic, count(*) AS count FROM documents GROUP BY 1),
lb AS (SELECT topic, string_agg(term, '_' ORDER BY rank) AS words FROM r WHERE rank <= 4 GROUP BY 1)
SELECT sz.topic, sz.count, concat_ws('_', sz.topic, lb.words) AS name FROM sz LEFT JOIN lb ON sz.topic = lb.topic""")
def q_topic_info(spark, sf):
    return T.topic_info(docs_by_source(spark, sf))


@register("top_topics", """
SELECT topic, count(*) AS count FROM (SELECT CAST(substr(source, 4) AS BIGINT) - 1 AS topic FROM documents) d
WHERE topic <> -1 GROUP BY topic ORDER BY count DESC, topic LIMIT 12""")
def q_top_topics(spark, sf):
    d = V.table(spark, sf, "documents").select((F.substring("source", 4, 10).cast("bigint") - 1).alias("topic"))
    return R.top_topics(d, 12)


@register("topic_similarity", f"""
WITH {TOKENS_SQL},
s AS (SELECT x.topic AS topic_a, y.topic AS topic_b, sum(x.weight * y.weight) AS g FROM w x JOIN w y ON x.term = y.term
      GROUP BY 1, 2),
d AS (SELECT topic_a AS topic, g AS d FROM s WHERE topic_a = topic_b)
SELECT topic_a, topic_b, round(g / (sqrt(da.d) * sqrt(db.d)), {D6}) AS similarity
FROM s JOIN d da ON s.topic_a = da.topic JOIN d db ON s.topic_b = db.topic""")
def q_topic_similarity(spark, sf):
    return T.topic_similarity(docs_by_source(spark, sf), top=60, digits=D6)


# ---- vector topics --------------------------------------------------------------

GRAPH_SQL = EV_SQL + """,
nr AS (SELECT vec_id, sqrt(sum(x * x)) AS nr FROM ev GROUP BY vec_id),
pairs AS (SELECT a.vec_id AS a, b.vec_id AS b, sum(a.x * b.x) AS dot FROM ev a JOIN ev b ON a.i = b.i AND a.vec_id < b.vec_id
          GROUP BY 1, 2),
edges AS (SELECT p.a, p.b, p.dot / (na.nr * nb.nr) AS cos FROM pairs p JOIN nr na ON p.a = na.vec_id JOIN nr nb ON p.b = nb.vec_id
          WHERE p.dot / (na.nr * nb.nr) >= 0.35),
und AS (SELECT a AS s, b AS t, cos FROM edges UNION ALL SELECT b, a, cos FROM edges)"""


@register("threshold_components", f"""
WITH RECURSIVE {GRAPH_SQL},
cc(node, comp) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT u.t, cc.comp FROM cc JOIN und u ON cc.node = u.s)
SELECT node AS id, min(comp) AS component FROM cc GROUP BY node""")
def q_threshold_components(spark, sf):
    return CC.threshold_components(corpus(spark, sf), 0.35)


@register("density_topics", f"""
WITH RECURSIVE {GRAPH_SQL},
core AS (SELECT s AS node FROM und GROUP BY s HAVING count(*) + 1 >= 3),
cu AS (SELECT u.s, u.t FROM und u WHERE u.s IN (SELECT node FROM core) AND u.t IN (SELECT node FROM core)),
cc(node, comp) AS (SELECT node, node FROM core UNION SELECT cu.t, cc.comp FROM cc JOIN cu ON cc.node = cu.s),
cl AS (SELECT node, min(comp) AS cluster FROM cc GROUP BY node),
bo AS (SELECT s AS node, cluster, cos, row_number() OVER (PARTITION BY s ORDER BY cos DESC, t) AS rn
       FROM und JOIN cl ON und.t = cl.node WHERE s NOT IN (SELECT node FROM core)),
me AS (SELECT node, cluster, 1.0::DOUBLE AS strength FROM cl UNION ALL SELECT node, cluster, cos FROM bo WHERE rn = 1),
big AS (SELECT cluster, row_number() OVER (ORDER BY count(*) DESC, cluster) - 1 AS topic FROM me GROUP BY cluster HAVING count(*) >= 5)
SELECT e.vec_id AS id, CAST(coalesce(big.topic, -1) AS BIGINT) AS topic,
       round(CASE WHEN big.topic IS NULL THEN 0 ELSE me.strength END, {D6}) AS strength
FROM embeddings e LEFT JOIN me ON e.vec_id = me.node LEFT JOIN big ON me.cluster = big.cluster""")
def q_density_topics(spark, sf):
    out = T.density_topics(corpus(spark, sf), eps_cos=0.35, min_samples=3, min_cluster_size=5)
    return out.select("id", F.col("topic").cast("bigint").alias("topic"), F.round("strength", D6).alias("strength"))


def hierarchy_sql(least_size: int, samples: int) -> str:
    """E10 + E12 by rows in the order of Prim's algorithm: a component at any distance is a run of rows between larger steps."""
    return f"""
WITH RECURSIVE e AS (SELECT vec_id AS id, row_number() OVER (ORDER BY vec_id) AS k, CAST(embedding AS DOUBLE[]) AS v FROM embeddings WHERE embedding IS NOT NULL),
d AS (SELECT a.k AS a, b.k AS b, sqrt(list_sum(list_transform(list_zip(a.v, b.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))) AS d FROM e a JOIN e b ON a.k <> b.k),
core AS (SELECT a, max(d) AS core FROM (SELECT a, d, row_number() OVER (PARTITION BY a ORDER BY d) AS rn FROM d) WHERE rn <= {samples} GROUP BY a),
m AS (SELECT d.a, list(greatest(d.d, x.core, y.core) ORDER BY d.b) AS w FROM (SELECT a, b, d FROM d UNION ALL SELECT k, k, 0 FROM e) d
      JOIN core x ON x.a = d.a JOIN core y ON y.a = d.b GROUP BY d.a),
prim(step, cur, w, best) AS (
  SELECT 0, CAST(1 AS BIGINT), CAST(NULL AS DOUBLE), list_transform(m.w, lambda x, i: CASE WHEN i = 1 THEN NULL ELSE x END) FROM m WHERE a = 1
  UNION ALL
  SELECT p.step + 1, p.at, p.low, list_transform(list_zip(p.best, m.w), lambda z, i: CASE WHEN z[1] IS NULL OR i = p.at THEN NULL ELSE least(z[1], z[2]) END)
  FROM (SELECT step, best, list_min(best) AS low, CAST(list_position(best, list_min(best)) AS BIGINT) AS at FROM prim WHERE list_min(best) IS NOT NULL) p
  JOIN m ON m.a = p.at),
s AS (SELECT step AS i, w FROM prim WHERE step > 0),
n AS (SELECT count(*) AS n FROM prim),
run AS (SELECT DISTINCT coalesce((SELECT max(j.i) FROM s j WHERE j.i < s.i AND j.w > s.w), 0) AS l,
               coalesce((SELECT min(j.i) FROM s j WHERE j.i > s.i AND j.w > s.w), n.n) AS r, s.w FROM s CROSS JOIN n),
cut AS (SELECT run.l, run.r, run.w, s.i AS b FROM run JOIN s ON s.i > run.l AND s.i < run.r AND s.w = run.w UNION ALL SELECT l, r, w, l FROM run),
kid AS (SELECT l, r, w, b AS kl, coalesce(lead(b) OVER (PARTITION BY l, r ORDER BY b), r) AS kr FROM cut),
split AS (SELECT l, r, w FROM kid WHERE kr - kl >= {least_size} GROUP BY l, r, w HAVING count(*) >= 2),
head AS (SELECT kl AS l, kr AS r, w AS birth FROM kid JOIN split USING (l, r, w) WHERE kr - kl >= {least_size}
         UNION ALL SELECT 0, n, NULL FROM n WHERE n >= {least_size}),
fall AS (SELECT i.i AS p, min(run.w) AS w FROM (SELECT step AS i FROM prim) i JOIN run ON run.l <= i.i AND i.i < run.r AND run.r - run.l >= {least_size} GROUP BY i.i),
dead AS (SELECT h.l, h.r, max(split.w) AS w FROM head h JOIN split ON split.l >= h.l AND split.r <= h.r GROUP BY h.l, h.r),
own AS (SELECT h.l, h.r, sum(1 / greatest(f.w, coalesce(dead.w, 0), 1e-9)) - count(*) / greatest(min(h.birth), 1e-9) AS own,
               CASE WHEN min(dead.w) IS NULL THEN min(f.w) ELSE min(dead.w) END AS low
        FROM head h JOIN fall f ON f.p >= h.l AND f.p < h.r LEFT JOIN dead ON dead.l = h.l AND dead.r = h.r WHERE h.birth IS NOT NULL GROUP BY h.l, h.r),
ranked AS (SELECT *, row_number() OVER (ORDER BY r - l, l) AS k FROM own),
up AS (SELECT c.k, (SELECT min(p.k) FROM ranked p WHERE p.l <= c.l AND p.r >= c.r AND p.k > c.k) AS up FROM ranked c),
tree AS (SELECT ranked.*, coalesce(c.kids, []) AS kids FROM ranked LEFT JOIN (SELECT up, list(k) AS kids FROM up GROUP BY up) c ON c.up = ranked.k),
fold(k, best, keep) AS (
  SELECT CAST(0 AS BIGINT), CAST([] AS DOUBLE[]), CAST([] AS BOOLEAN[])
  UNION ALL
  SELECT t.k, list_append(f.best, greatest(t.own, coalesce(list_sum(list_transform(t.kids, lambda c: f.best[c])), 0))),
         list_append(f.keep, t.own >= coalesce(list_sum(list_transform(t.kids, lambda c: f.best[c])), 0))
  FROM fold f JOIN tree t ON t.k = f.k + 1),
kept AS (SELECT ranked.* FROM ranked JOIN (SELECT unnest(keep) AS keep, generate_subscripts(keep, 1) AS k FROM fold WHERE k = (SELECT max(k) FROM fold)) x USING (k) WHERE x.keep),
top AS (SELECT * FROM kept c WHERE NOT EXISTS (SELECT 1 FROM kept o WHERE o.k > c.k AND o.l <= c.l AND o.r >= c.r)),
inside AS (SELECT e.id, top.l, greatest(top.low, 1e-9) / greatest(f.w, top.low, 1e-9) AS strength
           FROM fall f JOIN top ON f.p >= top.l AND f.p < top.r JOIN prim ON prim.step = f.p JOIN e ON e.k = prim.cur),
topic AS (SELECT l, row_number() OVER (ORDER BY count(*) DESC, min(id)) - 1 AS topic FROM inside GROUP BY l)
SELECT o.vec_id AS id, CAST(coalesce(topic.topic, -1) AS BIGINT) AS topic, round(coalesce(i.strength, 0), {D6}) AS strength
FROM embeddings o LEFT JOIN inside i ON i.id = o.vec_id LEFT JOIN topic ON topic.l = i.l"""


@register("hdbscan_topics", hierarchy_sql(5, 3))
def q_hdbscan_topics(spark, sf):
    """E10 + E12 with noise, on the whole vector table."""
    out = HI.hdbscan_topics(corpus(spark, sf), min_cluster_size=5, min_samples=3)
    return out.select("id", F.col("topic").cast("bigint").alias("topic"), F.round("strength", D6).alias("strength"))


@register("kmeans_topics", "SELECT vec_id AS id, label, true AS assigned FROM embeddings")
def q_kmeans_topics(spark, sf):
    """E11 + E12; topic numbers are the fit's own, so a row states that it has one of the k and a cosine."""
    out = T.kmeans_topics(corpus(spark, sf), k=10)
    return out.select("id", "label", (F.col("topic").between(0, 9) & (F.abs("strength") <= 1 + 1e-9)).alias("assigned"))


@register("pca_map", """
SELECT i AS component, (SELECT count(*) FROM embeddings) AS n, true AS uncorrelated, true AS ordered
FROM range(1, 6) t(i)""")
def q_pca_map(spark, sf):
    """E8 as its invariants: per component, no correlation with the later ones and no less variance than the next."""
    names = [f"u{i}" for i in range(1, 6)]
    pts = T.pca_map(corpus(spark, sf), k=5, names=names)
    moments = pts.agg(F.count(F.lit(1)).alias("n"), *[F.covar_pop(a, b).alias(f"{a}{b}") for a in names for b in names])
    rows = []
    for i, a in enumerate(names):
        small = [F.abs(F.col(f"{a}{b}")) <= 1e-6 * F.col(f"{a}{a}") for b in names[i + 1:]]
        flat = F.lit(True)
        for x in small:
            flat = flat & x
        down = F.col(f"{a}{a}") >= F.col(f"{names[i + 1]}{names[i + 1]}") if i + 1 < len(names) else F.lit(True)
        rows.append(F.struct(F.lit(i + 1).cast("bigint").alias("component"), F.col("n").alias("n"), flat.alias("uncorrelated"),
                             down.alias("ordered")))
    return moments.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


MAP_NEIGHBOURS_SQL = EV_SQL + """,
pr AS (SELECT a.vec_id AS id, b.vec_id AS o, sqrt(sum((a.x - b.x) * (a.x - b.x))) AS d FROM ev a JOIN ev b ON a.i = b.i AND a.vec_id <> b.vec_id GROUP BY 1, 2),
nb AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY d, o) AS rank FROM pr)"""


@register("nearest_neighbours", f"""
WITH {MAP_NEIGHBOURS_SQL}
SELECT id, o AS other, rank, round(d, {D6}) AS distance FROM nb WHERE rank <= 15""")
def q_nearest_neighbours(spark, sf):
    """The exact neighbour graph the map of E8/E9 is built on."""
    near = MF.nearest(corpus(spark, sf), 15)
    return near.select("id", F.posexplode("near").alias("at", "m")).select(
        "id", F.col("m.o").alias("other"), (F.col("at") + 1).cast("bigint").alias("rank"), F.round("m.d", D6).alias("distance"))


@register("manifold_map", "SELECT count(*) AS n, true AS placed, true AS keeps_more_neighbours_than_a_linear_map FROM embeddings")
def q_manifold_map(spark, sf):
    """Five dimensions. The vectors are nearly without structure, so the map is held against the linear one of as many dimensions."""
    c, names = corpus(spark, sf), [f"u{i}" for i in range(1, 6)]
    points = written(MF.manifold_map(c, k=5, names=names), "points")
    trust = MF.trustworthiness(c, points, names)
    linear = MF.trustworthiness(c, written(T.pca_map(c, k=5, names=names), "linear"), names).select(F.col("trust").alias("other"))
    finite = points.agg(F.count(F.lit(1)).alias("n"), (F.count(F.when(~F.isnan(F.col("u1") + F.col("u5")), 1)) == F.count(F.lit(1))).alias("placed"))
    return (finite.join(trust.select("trust"), F.lit(True)).join(linear, F.lit(True))
            .select("n", "placed", (F.col("trust") > F.col("other")).alias("keeps_more_neighbours_than_a_linear_map")))


@register("topic_map", "SELECT count(*) AS docs, true AS at_most_k, true AS centred FROM embeddings")
def q_topic_map(spark, sf):
    """E16 as its invariants: topic sizes add up to the documents, and their weighted mean is the points' mean."""
    c = corpus(spark, sf)
    pts = T.pca_map(T.kmeans_topics(c, k=10).select("id", "embedding", "topic"), k=2).checkpoint(eager=True)
    m = T.topic_map(pts).agg(F.sum("size").alias("docs"), (F.count(F.lit(1)) <= 10).alias("at_most_k"),
                             (F.sum(F.col("x") * F.col("size")) / F.sum("size")).alias("mx"))
    mean = pts.agg(F.avg("x").alias("px"))
    return m.join(mean, F.lit(True)).select("docs", "at_most_k", (F.abs(F.col("mx") - F.col("px")) < 1e-9).alias("centred"))


@register("document_map", """
SELECT doc_id AS id, substr(text, 1, 100) AS hover, true AS placed FROM documents""")
def q_document_map(spark, sf):
    """Every document with its hover text and a point."""
    d = V.table(spark, sf, "documents")
    vecs = VX.hash_embed(d.select(F.col("doc_id").alias("id"), "text"), dim=64)
    pts = T.pca_map(T.kmeans_topics(vecs, k=8).select("id", "embedding", "topic"), k=2)
    out = T.document_map(pts, d.select(F.col("doc_id").alias("id"), "text"), "id")
    return out.select("id", "hover", (F.col("x").isNotNull() & F.col("y").isNotNull() & F.col("topic").isNotNull()).alias("placed"))


@register("stable_sample", "SELECT doc_id, source FROM documents ORDER BY md5(concat('3:', CAST(doc_id AS VARCHAR))), doc_id LIMIT 100")
def q_stable_sample(spark, sf):
    return R.stable_sample(V.table(spark, sf, "documents").select("doc_id", "source"), 100, "doc_id", seed=3)


# ---- E1: keyword search ------------------------------------------------------------

SEARCH_QUERY = "topic_1 the"


KEYWORD_SQL = with_dash(f"""
, s AS (SELECT dr.review_id, dr.category, dr.rating, dr.sentiment, dr.topic_label, dr.similarity,
             (CASE WHEN contains(lower(coalesce(d.text, 'None')), 'topic_1') THEN 1.0 ELSE 0.0 END
              + CASE WHEN contains(lower(coalesce(dr.topic_label, 'None')), 'topic_1') THEN 1.5 ELSE 0.0 END
              + CASE WHEN contains(lower(coalesce(d.text, 'None')), 'the') THEN 1.0 ELSE 0.0 END
              + CASE WHEN contains(lower(coalesce(dr.topic_label, 'None')), 'the') THEN 1.5 ELSE 0.0 END)::DOUBLE
             + coalesce(dr.similarity, 0) AS query_score
      FROM dr LEFT JOIN documents d ON dr.doc_id = d.doc_id
      WHERE dr.category IN ({CAT_LIST}) AND dr.sentiment IN ('positive', 'neutral', 'negative')
        AND coalesce(dr.rating, 0) >= 3.5 AND coalesce(dr.similarity, 0) >= 0.45)
SELECT review_id, category, rating, sentiment, topic_label, similarity, round(query_score, {D6}) AS query_score
FROM s ORDER BY query_score DESC, review_id LIMIT 100""").replace("\n, s AS", ", s AS")


@register("keyword_search", KEYWORD_SQL)
def q_keyword_search(spark, sf):
    docs = V.table(spark, sf, "documents").select("doc_id", F.col("text").alias("review_text"))
    reviews = dash_reviews(spark, sf).join(docs, "doc_id", "left")
    out = SR.keyword_search(reviews, SEARCH_QUERY, k=100, categories=DEFAULT_CATEGORIES,
                            sentiments=["positive", "neutral", "negative"], min_rating=3.5, min_similarity=0.45,
                            tiebreak=["review_id"])
    return out.select("review_id", "category", "rating", "sentiment", "topic_label", "similarity",
                      F.round("query_score", D6).alias("query_score"))


@register("keyword_search_indexed", KEYWORD_SQL)
def q_keyword_search_indexed(spark, sf):
    """E1 through the trigram index of the documents: the same rows and scores."""
    docs = V.table(spark, sf, "documents").select("doc_id", "text")
    path = scratch_dir(spark, "trigrams")
    SU.build_index(docs, path, key="doc_id")
    out = SU.keyword_search_indexed(dash_reviews(spark, sf), docs, path, SEARCH_QUERY, k=100, categories=DEFAULT_CATEGORIES,
                                    sentiments=["positive", "neutral", "negative"], min_rating=3.5, min_similarity=0.45,
                                    tiebreak=["review_id"])
    return out.select("review_id", "category", "rating", "sentiment", "topic_label", "similarity",
                      F.round("query_score", D6).alias("query_score"))


SUBSTRINGS = ["izmo", "ld bo", "l ring"]  # the end of a word, and across two words


@register("title_search_indexed", f"""
SELECT p_partkey AS product_id, p_name AS title FROM part
WHERE {" OR ".join(f"contains(lower(p_name), '{t}')" for t in SUBSTRINGS)}""")
def q_title_search_indexed(spark, sf):
    """F8's title filter through the trigram index of the products."""
    titles = V.table(spark, sf, "part").select(F.col("p_partkey").alias("product_id"), F.col("p_name").alias("title"))
    path = scratch_dir(spark, "trigrams")
    SU.build_index(titles, path, key="product_id", text="title")
    return SU.containing(titles, path, SUBSTRINGS, key="product_id", text="title")
