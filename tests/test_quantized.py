"""Search over cells: pruned exact search equals the plain one, codes keep recall and their candidate floor."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from cartwheel.operators import quantized as Q
from cartwheel.operators import vectors as VX


def clustered(spark, n=1200, dim=16, seed=0, groups=24):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(groups, dim))
    x = centres[rng.integers(0, groups, n)] + rng.normal(scale=0.15, size=(n, dim))
    x[7] = x[5]  # copies tie
    queries = centres[:12] + rng.normal(scale=0.1, size=(12, dim))
    frame = lambda rows, a, b: spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(rows)], f"{a} bigint, {b} array<double>")
    return frame(x, "id", "embedding"), frame(queries, "qid", "qvec"), x, queries


def plain(x, q, k, digits=6):
    unit = lambda m: m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-300)
    s = np.round(unit(q) @ unit(x).T, digits)
    return {i: [int(j) for j in np.lexsort((np.arange(len(x)), -r))[:k]] for i, r in enumerate(s)}


def answers(df):
    out = {}
    for r in df.collect():
        out.setdefault(r.qid, {})[r["rank"]] = r.id
    return {q: [v[i] for i in sorted(v)] for q, v in out.items()}


@pytest.mark.parametrize("k", [1, 5, 60])
def test_pruned_search_is_exact(spark, k):
    df, qs, x, q = clustered(spark)
    cells = Q.build_cells(df, n_cells=24)
    assert answers(Q.knn_pruned(qs, cells, k=k, digits=6)) == plain(x, q, k)


def test_most_cells_are_skipped_on_clustered_rows(spark):
    df, qs, _, _ = clustered(spark)
    assert Q.skipped_share(qs, Q.build_cells(df, n_cells=24), k=5) > 0.7


def test_unstructured_rows_stay_exact(spark):
    rng = np.random.default_rng(1)
    x, q = rng.normal(size=(300, 12)), rng.normal(size=(9, 12))
    x[3] = 0
    df = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)] + [(999, None)], "id bigint, embedding array<double>")
    qs = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(q)] + [(77, None)], "qid bigint, qvec array<double>")
    assert answers(Q.knn_pruned(qs, Q.build_cells(df, n_cells=9), k=5, digits=6)) == plain(x, q, 5)


def test_codes_recall_and_floor(spark):
    df, qs, x, q = clustered(spark, seed=3)
    cells = Q.build_cells(df, n_cells=24)
    books = Q.fit_codebooks(cells, subspaces=8, values=64)
    codes = Q.encode(cells, books)
    assert codes.count() == len(x) and codes.where(F.octet_length("code") != 8).count() == 0
    want = plain(x, q, 5)
    got = answers(Q.knn_codes(qs, cells, codes, books, k=5))
    assert np.mean([len(set(got[i]) & set(want[i])) / 5 for i in want]) >= 0.9
    wide = Q.knn_codes(qs, cells, codes, books, k=50).groupBy("qid").count().collect()
    assert [r["count"] for r in wide] == [50] * 12  # the floor is met for every query


def test_edges(spark):
    df, qs, x, q = clustered(spark, n=40)
    for part in (df.limit(0), df.where("id = 3"), df.where("id < 3")):
        cells = Q.build_cells(part)
        n = part.count()
        assert Q.knn_pruned(qs, cells, k=5).count() == 12 * n
        books = Q.fit_codebooks(cells)
        assert Q.knn_codes(qs, cells, Q.encode(cells, books), books).count() == 12 * n
    assert Q.knn_pruned(qs.limit(0), Q.build_cells(df), k=5).count() == 0
    assert VX.knn_exact(qs, df, k=2).count() == 24


def test_a_query_is_sent_once_a_block(spark, monkeypatch):
    """Blocks of few rows, several to a large cell: the same hits, and as many probes as blocks, not as cells."""
    monkeypatch.setattr(Q, "LEAST_ROWS", 60)
    monkeypatch.setattr(Q, "CODE_ROWS", 60)
    monkeypatch.setattr(Q, "CORPUS_VALUES", 60 * 12)
    monkeypatch.setattr(Q, "QUERY_VALUES", 12 * 5)
    rng = np.random.default_rng(4)
    x, q = rng.normal(size=(400, 12)), rng.normal(size=(12, 12))
    x[100:300] = x[100]  # a cell larger than a block
    df = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "id bigint, embedding array<double>")
    qs = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(q)], "qid bigint, qvec array<double>")
    cells = Q.build_cells(df, n_cells=40)
    at = Q.layout(cells, 60)
    assert cells.size.max() > 60 and sum(cells.size) == 400 and 7 <= len(at.members) < 20
    assert sorted({int(c) for m in at.members for c in m}) == list(range(len(cells.size)))
    none = qs.select(F.lit(-1).cast("bigint").alias("qid"), F.lit(5).alias("rank"), F.lit(0.0).alias("score"))
    every = Q.second_probes(Q._unit_queries(qs, "qid", "qvec"), cells, none, 5, 1, at)
    assert every.groupBy("qid", "block").count().where("count > 1").isEmpty() and every.count() <= 12 * len(at.members)
    assert answers(Q.knn_pruned(qs, cells, k=5, digits=6)) == plain(x, q, 5)
    books = Q.fit_codebooks(cells, subspaces=12, values=256)
    got, best = answers(Q.knn_codes(qs, cells, Q.encode(cells, books), books, k=5)), plain(x, q, 5)
    near = lambda i, ids: (x[ids] @ q[i]) / np.linalg.norm(x[ids], axis=1)
    assert all(len(v) == 5 for v in got.values()) and np.mean([near(i, got[i]) >= near(i, best[i][-1:]) - 1e-6 for i in best]) >= 0.9
