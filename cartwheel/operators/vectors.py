"""Vector search (E2-E7, J7, C22): embedding, exact and IVF k-nearest neighbours.

Scale notes
* Exact search is a block join: queries and corpus rows are dealt into blocks by a hash of
  their ids, every query block meets every corpus block in a group of its own (one matrix
  product), and only the group's best k rows per query leave it. Blocks hold a bounded
  number of values, so neither the queries nor the corpus pass through the driver or one task.
* With a category (or an IVF cell) the block key starts with it: a query meets only the rows
  of its own category, and a large category is many blocks.
* Top-k per query is ``row_number() <= k`` over those partial lists, planned with a
  partial WindowGroupLimit.
"""

from __future__ import annotations

import hashlib
import json
import math

from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.functions import scalars as S

# Reference search queries (fixed values): eight general, three per category.
SEARCH_QUERIES = [
    "stopped working after a few months, terrible quality",
    "battery drains too fast, disappointing",
    "easy to set up, works exactly as described",
    "great value for the price, highly recommend",
    "shipping was damaged and packaging broken",
    "too small, sizing runs very small",
    "noisy compressor keeps me awake at night",
    "excellent customer service resolved my issue quickly",
]
CATEGORY_QUERIES = [
    ("Appliances", "energy consumption too high, electricity bill increased"),
    ("Electronics", "screen flickering and display issues after update"),
    ("Clothing_Shoes_and_Jewelry", "material feels cheap and itchy, not as pictured"),
]

TOKEN_PATTERN = r"[\p{L}\p{N}_]{2,}"
QUERY_VALUES = 500_000  # vector values of a query block
CORPUS_VALUES = 4_000_000  # vector values of a corpus block
SLICE_VALUES = 1_000_000  # scores of a block of queries computed at once
CELL_ROWS = 2000  # corpus rows of an IVF cell, on average


# ---- E2: embedding -----------------------------------------------------------

def tokens(text: str | Column) -> Column:
    """Lower-cased word tokens of two or more letters/digits (the topic model's default pattern)."""
    return F.regexp_extract_all(F.lower(S.col_of(text)), F.lit(TOKEN_PATTERN), 0)


def _hashed(dim: int, out: str, double: bool):
    """mapInArrow: token lists to unit vectors; a token adds +1 or -1 to one bucket, both from its md5."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    def run(batches):
        for rb in batches:
            if rb.num_rows == 0:
                continue
            tokens_ = rb.column("_tok")
            sizes = pc.fill_null(pc.list_value_length(tokens_), 0).to_numpy(zero_copy_only=False)
            coded = pc.list_flatten(tokens_).dictionary_encode()
            marks = [hashlib.md5(t.encode("utf-8")).hexdigest() for t in coded.dictionary.to_pylist()]
            bucket = np.array([int(m[:8], 16) % dim for m in marks], np.int64)
            sign = np.array([1.0 if int(m[8], 16) < 8 else -1.0 for m in marks])
            code = coded.indices.to_numpy(zero_copy_only=False)
            rows = np.repeat(np.arange(rb.num_rows), sizes)
            x = np.bincount(rows * dim + bucket[code], weights=sign[code], minlength=rb.num_rows * dim) if len(code) \
                else np.zeros(rb.num_rows * dim)
            x = x.reshape(rb.num_rows, dim)
            norm = np.sqrt((x * x).sum(axis=1))
            x = (x / np.where(norm > 0, norm, 1.0)[:, None]).astype(np.float64 if double else np.float32)
            vec = pa.ListArray.from_arrays(pa.array(np.arange(0, x.size + 1, dim, dtype=np.int32)), pa.array(x.ravel()))
            at = rb.schema.get_field_index("_tok")
            yield pa.RecordBatch.from_arrays([c for i, c in enumerate(rb.columns) if i != at] + [vec],
                                             names=[n for n in rb.schema.names if n != "_tok"] + [out])
    return run


def hash_embed(df: DataFrame, text: str = "text", dim: int = 64, prefix: str = "", out: str = "embedding",
               encoder=None, double: bool = False) -> DataFrame:
    """Text → unit vector (float, or ``double``). Default encoder: signed feature hashing of word tokens, L2-normalised.

    Bucket (first 8 hex digits of the token's md5, modulo ``dim``) and sign (its ninth) are the
    same in every engine. A text without tokens, or whose tokens cancel, is the zero vector.
    ``encoder`` may be a callable ``(DataFrame, text_col, out_col) -> DataFrame`` that
    runs a real model (e.g. an iterator pandas UDF loading the model once per worker).
    """
    src = F.concat(F.lit(prefix), S.col_of(text)) if prefix else S.col_of(text)
    if encoder is not None:
        return encoder(df.withColumn("_text", src), "_text", out).drop("_text")
    kept = df.drop(out)
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema), f"`{out}` array<{'double' if double else 'float'}>"])
    return kept.withColumn("_tok", tokens(src)).mapInArrow(_hashed(dim, out, double), schema)


# ---- E4/E6/E7: exact search ----------------------------------------------------

def literal_rows(rows: list[dict], ddl: str) -> Column:
    """A small, bounded list of rows as one constant array (folded to a literal by the optimizer)."""
    return F.from_json(F.lit(json.dumps(rows)), f"array<struct<{ddl}>>")


def _best(q: "np.ndarray", score: "np.ndarray", ids: "np.ndarray", k: int) -> "np.ndarray":
    """Positions of the ``k`` best rows of each query: score descending, id ascending."""
    import numpy as np
    order = np.lexsort((ids, -score, q))
    first = np.concatenate([[True], q[order][1:] != q[order][:-1]]) if len(order) else np.zeros(0, bool)
    start = np.maximum.accumulate(np.where(first, np.arange(len(order)), 0))
    return order[np.arange(len(order)) - start < k]


def _block_topk(k: int, digits: int | None, schema):
    """cogroup applyInArrow: one query block against one corpus block, ``k`` best rows per query."""
    import numpy as np
    import pyarrow as pa

    def run(queries: pa.Table, rows: pa.Table) -> pa.Table:
        if not queries.num_rows or not rows.num_rows:
            return schema.empty_table()
        qm = vector_matrix(queries.column("_qv").combine_chunks())
        cm = vector_matrix(rows.column("_v").combine_chunks())
        keys, ids = np.unique(np.asarray(rows.column("_id").to_pylist()), return_inverse=True)  # codes sort as ids do
        step = max(1, SLICE_VALUES // len(qm))  # a slice's scores, and the copies made of them, do not grow with the queries
        held = [np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64)]
        for at in range(0, len(cm), step):
            sim = qm @ cm[at:at + step].T
            if digits is not None:
                sim = np.round(sim, digits)
            if sim.shape[1] > k:  # everything from the k-th best score up, ties included
                floor = np.partition(sim, sim.shape[1] - k, axis=1)[:, sim.shape[1] - k]
                q, j = np.nonzero(sim >= floor[:, None])
            else:
                q, j = (x.ravel() for x in np.indices(sim.shape))
            held = [np.concatenate(p) for p in zip(held, (q, sim[q, j], ids[at + j]), strict=True)]
            keep = _best(*held, k)
            held = [p[keep] for p in held]
        q, score, code = held
        return pa.Table.from_arrays([queries.column("_qid").combine_chunks().take(pa.array(q)),
                                     pa.array(keys[code].tolist(), schema.field(1).type), pa.array(score)], schema=schema)
    return run


def _arrow_type(dt):
    """Arrow type of the Spark key types a search result carries."""
    import pyarrow as pa
    from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType
    for spark_type, arrow_type in ((LongType, pa.int64()), (IntegerType, pa.int32()),
                                   (StringType, pa.string()), (DoubleType, pa.float64())):
        if isinstance(dt, spark_type):
            return arrow_type
    raise TypeError(f"unsupported key type {dt.simpleString()}")


def knn_exact(queries: DataFrame, corpus: DataFrame, k: int = 5, qid: str = "qid", qvec: str = "qvec",
              id_col: str = "id", vec: str = "embedding", digits: int | None = None,
              query_values: int = QUERY_VALUES, corpus_values: int = CORPUS_VALUES, q_category: str | None = None,
              category: str | None = None) -> DataFrame:
    """E4 (J7): for each query the ``k`` corpus rows with the highest dot product (cosine on unit vectors).

    Every query row is answered, however many there are: blocks are a hash of the ids, so both
    sides agree on them in every run. Ties go to the smaller id; with ``digits`` scores are rounded
    before they are ranked. With ``q_category``/``category`` a query only scores rows of its
    own category (null categories match nothing). Rows without vector take no part. Output: qid, id, score, rank.
    """
    import pyarrow as pa

    q = queries.where(F.col(qvec).isNotNull()).select(
        F.col(qid).alias("_qid"), F.col(qvec).alias("_qv"), *([F.col(q_category).cast("string").alias("_key")] if q_category else []))
    c = corpus.where(F.col(vec).isNotNull()).select(
        F.col(id_col).alias("_id"), F.col(vec).alias("_v"), *([F.col(category).cast("string").alias("_key")] if q_category else []))
    width = F.greatest(F.max(F.size("_qv")), F.lit(1))
    if q_category:
        per = q.groupBy("_key").agg(F.ceil(F.count(F.lit(1)) * width / query_values).cast("int").alias("_nq"), width.alias("_d"))
        sizes = (per.join(c.groupBy("_key").agg(F.count(F.lit(1)).alias("_n")), "_key")
                 .select("_key", "_nq", F.ceil(F.col("_n") * F.col("_d") / corpus_values).cast("int").alias("_nc")))
        q, c, nq, nc = q.join(sizes, "_key"), c.join(sizes, "_key"), F.col("_nq"), F.col("_nc")
        keys = ["_key", "_qb", "_cb"]
    else:
        n, d = q.agg(F.count(F.lit(1)), width).first()
        nq = F.lit(max(1, -(-n * (d or 1) // query_values)))
        nc = F.lit(max(1, -(-c.count() * (d or 1) // corpus_values)))
        keys = ["_qb", "_cb"]
    parts = [x for x in keys if x == "_key"]
    left = (q.withColumn("_qb", F.pmod(F.xxhash64("_qid", F.lit(11)), nq).cast("int"))
            .select(*parts, "_qid", "_qv", "_qb", F.explode(F.sequence(F.lit(0), nc - 1)).alias("_cb")))
    right = (c.withColumn("_cb", F.pmod(F.xxhash64("_id", F.lit(13)), nc).cast("int"))
             .select(*parts, "_id", "_v", "_cb", F.explode(F.sequence(F.lit(0), nq - 1)).alias("_qb")))
    schema = pa.schema([("qid", _arrow_type(queries.schema[qid].dataType)),
                        (id_col, _arrow_type(corpus.schema[id_col].dataType)), ("score", pa.float64())])
    ddl = (f"qid {queries.schema[qid].dataType.simpleString()}, `{id_col}` {corpus.schema[id_col].dataType.simpleString()}, "
           "score double")
    scored = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(_block_topk(k, digits, schema), ddl)
    w = Window.partitionBy("qid").orderBy(F.desc("score"), F.asc(id_col))
    return scored.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= F.lit(k))


def label_centroids(corpus: DataFrame, label: str = "label", vec: str = "embedding",
                    out: str = "qvec") -> DataFrame:
    """Unit-normalised mean vector per label (a query set derived from the corpus).

    Vector means are MLlib ``Summarizer`` aggregates: partial per task, merged per label.
    """
    m = corpus.groupBy(label).agg(Summarizer.mean(array_to_vector(vec)).alias("_m"))
    return m.select(F.col(label).alias("qid"),
                    S.l2_normalize(vector_to_array("_m", "float64"), as_float=False).alias(out))


def write_vector_table(indexed: DataFrame, path: str) -> DataFrame:
    """S10 + E3: the indexed vectors written partitioned by ``cell``; returns the table as read back.

    A probe that joins on ``cell`` then reads only the probed cells'
    folders (dynamic partition pruning) — the cell column is the index.
    """
    indexed.write.mode("overwrite").partitionBy("cell").parquet(path)
    return indexed.sparkSession.read.parquet(path)


def query_frame(spark, texts: list[str], dim: int = 64, prefix: str = "", double: bool = False) -> DataFrame:
    """The fixed query texts embedded with the corpus encoder."""
    q = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "qid bigint, query string")
    return hash_embed(q, "query", dim=dim, prefix=prefix, out="qvec", double=double)


def search_in_category(queries: DataFrame, corpus: DataFrame, k: int = 5, category: str = "category",
                       q_category: str = "q_category", filter_hits: bool = False, **kw) -> DataFrame:
    """A query runs only if its category occurs in the corpus (the guard, a semi join).

    The reference does not restrict hits to the category; ``filter_hits=True`` does.
    """
    present = corpus.select(F.col(category).cast("string").alias(q_category)).distinct()
    guarded = queries.withColumn(q_category, F.col(q_category).cast("string")).join(present, on=q_category,
                                                                                     how="left_semi")
    if filter_hits:
        corpus = corpus.withColumn("_cat", F.col(category).cast("string"))
        return knn_exact(guarded, corpus, k, q_category=q_category, category="_cat", **kw)
    return knn_exact(guarded, corpus, k, **kw)


# ---- E3/E5: IVF index ----------------------------------------------------------

def fit_cells(corpus: DataFrame, n_cells: int, vec: str = "embedding", seed: int = 7, max_iter: int = 5):
    """K-means centroids over the whole corpus (MLlib, distributed). Returns the model.

    Cells only partition the corpus (search re-ranks exactly), so a few Lloyd
    iterations from a random start are enough.
    """
    data = corpus.select(array_to_vector(vec).alias("features"))
    return KMeans(k=n_cells, seed=seed, maxIter=max_iter, initMode="random").fit(data)


def centroids_of(model) -> list[dict]:
    """Unit-normalised centroids of a fitted model: [{cell, c}] — n_cells × dim values."""
    out = []
    for i, c in enumerate(model.clusterCenters()):
        v = [float(x) for x in c]
        norm = math.sqrt(sum(x * x for x in v)) or 1.0
        out.append({"cell": i, "c": [x / norm for x in v]})
    return out


def centroid_literal(centroids: list[dict]) -> Column:
    """Centroids as one constant array of (cell, c)."""
    return literal_rows(centroids, "cell:int,c:array<double>")


def vector_matrix(column) -> "np.ndarray":
    """An Arrow list column of equal-length vectors as an (n × d) float64 matrix, without per-row objects."""
    import numpy as np
    import pyarrow.compute as pc

    n = len(column)
    if n == 0:
        return np.zeros((0, 0))
    lengths = pc.list_value_length(column).to_numpy(zero_copy_only=False)
    flat = pc.list_flatten(column).to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    d = int(lengths.max())
    if (lengths == d).all():
        return flat.reshape(n, d)
    out = np.zeros((n, d))
    starts = np.concatenate(([0], np.cumsum(lengths)[:-1]))
    for i, (s0, ln) in enumerate(zip(starts, lengths)):
        out[i, :ln] = flat[s0:s0 + ln]
    return out


def _nearest_cell(centroids: "np.ndarray", vec: str):
    """mapInArrow: nearest centroid by cosine and the cosine itself (one matrix product per batch).

    Other columns pass through as Arrow arrays, untouched by Python.
    """
    import numpy as np
    import pyarrow as pa

    def run(batches):
        for rb in batches:
            if rb.num_rows == 0:
                continue
            x = vector_matrix(rb.column(vec))
            norms = np.linalg.norm(x, axis=1)
            cos = (x @ centroids.T) / np.where(norms > 0, norms, 1.0)[:, None]
            cell = cos.argmax(axis=1)
            best = cos[np.arange(len(cell)), cell]
            yield pa.RecordBatch.from_arrays(
                list(rb.columns) + [pa.array(cell.astype("int32")), pa.array(best)],
                names=list(rb.schema.names) + ["cell", "cell_cos"])
    return run


def assign_cells(corpus: DataFrame, centroids: list[dict], vec: str = "embedding") -> DataFrame:
    """Nearest centroid by cosine; adds ``cell`` and ``cell_cos``.

    The centroids (cells × dim values) travel with the task; each Arrow
    batch is scored against all of them with one NumPy matrix product.
    """
    import numpy as np
    from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

    c = np.array([x["c"] for x in centroids], dtype=np.float64)
    schema = StructType(corpus.schema.fields + [StructField("cell", IntegerType()),
                                                StructField("cell_cos", DoubleType())])
    return corpus.where(F.col(vec).isNotNull()).mapInArrow(_nearest_cell(c, vec), schema)


def build_ivf(corpus: DataFrame, n_cells: int | None = None, vec: str = "embedding", cell_rows: int = CELL_ROWS,
              seed: int = 7) -> tuple[DataFrame, list[dict]]:
    """(indexed corpus with ``cell``, centroids). ``n_cells`` defaults to one per ``cell_rows`` rows, √n at least.

    Fit and assignment both read ``corpus``: pass a written table when its plan is costly.
    """
    if n_cells is None:
        n = corpus.count()
        n_cells = max(1, int(math.sqrt(max(n, 1))), n // cell_rows)
    cents = centroids_of(fit_cells(corpus, n_cells, vec, seed))
    return assign_cells(corpus, cents, vec), cents


def knn_ann(queries: DataFrame, indexed: DataFrame, centroids: list[dict], k: int = 5, nprobe: int = 4,
            qid: str = "qid", qvec: str = "qvec", id_col: str = "id", vec: str = "embedding",
            digits: int | None = None) -> DataFrame:
    """E5: probe the ``nprobe`` nearest cells per query, re-rank their members exactly, keep ``k``.

    The corpus is semi-joined with the probed cells — on a table partitioned by ``cell``
    that prunes whole folders — and each (query, cell) probe meets its cell's blocks only.
    """
    arr = centroid_literal(centroids)
    probes = queries.select(qid, qvec, F.explode(F.transform(arr, lambda s: F.struct(
        s["cell"].alias("cell"), S.dot(s["c"], F.col(qvec)).alias("ccos")))).alias("_p"))
    probes = probes.select(qid, qvec, F.col("_p.cell").alias("cell"), F.col("_p.ccos").alias("ccos"))
    wp = Window.partitionBy(qid).orderBy(F.desc("ccos"), F.asc("cell"))
    probes = probes.withColumn("_r", F.row_number().over(wp)).where(F.col("_r") <= nprobe).select(qid, qvec, "cell")
    cand = indexed.join(probes.select("cell").distinct(), "cell", "left_semi")
    return knn_exact(probes, cand, k, qid=qid, qvec=qvec, id_col=id_col, vec=vec, digits=digits,
                     q_category="cell", category="cell")


def recall_at_k(approx: DataFrame, exact: DataFrame, id_col: str = "id") -> DataFrame:
    """Share of exact top-k hits that the approximate search returned, per query and overall."""
    hit = exact.select("qid", id_col).join(approx.select("qid", id_col).withColumn("_h", F.lit(1)),
                                            on=["qid", id_col], how="left")
    return hit.agg(F.avg(F.coalesce(F.col("_h"), F.lit(0)).cast("double")).alias("recall"))
