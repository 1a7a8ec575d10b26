"""What a task holds or reads stays bounded as its table grows."""

import tracemalloc

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from cartwheel.operators import components as CC
from cartwheel.operators import quantized as QZ
from cartwheel.operators import vectors as VX
from cartwheel.plans import fixtures as FX
from cartwheel.session import SHUFFLE_CLEANUP, written
from cartwheel.sources import jsonl as J


def lists(x):
    return pa.ListArray.from_arrays(pa.array(np.arange(0, x.size + 1, x.shape[1], dtype=np.int32)), pa.array(x.ravel()))


def peak(fn):
    tracemalloc.start()
    out = fn()
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    return out, most


def test_scores_of_a_query_block_are_sliced():
    rng = np.random.default_rng(0)
    q, c = rng.normal(size=(6000, 4)), rng.normal(size=(4000, 4))
    schema = pa.schema([("qid", pa.int64()), ("id", pa.int64()), ("score", pa.float64())])
    queries = pa.table({"_qid": np.arange(6000), "_qv": lists(q)})
    rows = pa.table({"_id": np.arange(4000), "_v": lists(c)})
    out, most = peak(lambda: VX._block_topk(3, None, schema)(queries, rows))
    assert most < 100e6  # all scores are 192 MB
    got = {}
    for r in out.to_pylist():
        got.setdefault(r["qid"], []).append((-r["score"], r["id"]))
    best = np.sort(-(q @ c.T), axis=1)[:, :3]
    assert all(np.allclose([s for s, _ in sorted(got[i])], best[i]) for i in range(6000))


def test_scores_of_cells_are_sliced():
    rng = np.random.default_rng(5)
    q, x = rng.normal(size=(6000, 4)), rng.normal(size=(4000, 4))
    cell = rng.integers(0, 3, 4000)
    at = QZ.Layout([np.array([0, 1, 2])], np.zeros(3, np.int64), np.ones(3, np.int64))
    schema = pa.schema([("qid", pa.int64()), ("id", pa.int64()), ("score", pa.float64())])
    bits = np.packbits(np.ones((6000, 3), bool), axis=1)
    queries = pa.table({"qid": np.arange(6000), "qvec": lists(q), "low": pa.array([None] * 6000, pa.float64()), "cells": pa.array([b.tobytes() for b in bits], pa.binary())})
    rows = pa.table({"id": np.arange(4000), "embedding": lists(x), "cell": pa.array(cell, pa.int32())})
    vectors_of = lambda t: lambda places: x[places]
    out, most = peak(lambda: QZ._best_of_block(at, 3, None, schema, vectors_of)((pa.scalar(0), pa.scalar(0)), queries, rows))
    assert most < 150e6  # all scores are 192 MB
    best = np.sort(-(q @ x.T), axis=1)[:, :3]
    got = {}
    for r in out.to_pylist():
        got.setdefault(r["qid"], []).append((-r["score"], r["id"]))
    assert all(np.allclose([s for s, _ in sorted(got[i])], best[i]) for i in range(6000))


def test_queries_choose_cells_in_slices():
    rng = np.random.default_rng(6)
    unit = lambda m: m / np.linalg.norm(m, axis=1)[:, None]
    cells = QZ.Cells(None, unit(rng.normal(size=(1000, 16))), np.full(1000, 1.5), np.full(1000, 500))
    rb = pa.RecordBatch.from_arrays([pa.array(np.arange(2000)), lists(unit(rng.normal(size=(2000, 16)))), pa.array(np.zeros(2000))], names=["qid", "qvec", "low"])
    def largest():
        return max((b.num_rows, b.nbytes) for b in QZ._probes(cells, 50, True, QZ.layout(cells, 50_000))([rb]))
    (rows, size), most = peak(largest)
    assert rows <= QZ.PROBE_ROWS and size < 1e6 and most < 100e6  # by cell: 2 million rows, 256 MB, in one batch


def test_tiles_of_cosines_are_sliced():
    rng = np.random.default_rng(1)
    x, y = rng.normal(size=(4000, 3)), rng.normal(size=(5000, 3))
    x, y = (v / np.linalg.norm(v, axis=1)[:, None] for v in (x, y))
    left = pa.table({"id": np.arange(4000), "w": rng.integers(1, 4, 4000), "name": np.arange(4000), "_v": lists(x)})
    right = pa.table({"id": np.arange(4000, 9000), "w": rng.integers(1, 4, 5000), "name": np.arange(4000, 9000), "_v": lists(y)})
    key = (pa.scalar(0), pa.scalar(1))
    close = x @ y.T >= 0.9
    for kind in ("degree", "forest", "border"):
        out, most = peak(lambda: CC._tiles(kind, 0.9)(key, left, right))  # noqa: B023
        assert most < 100e6  # all cosines are 160 MB
        if kind == "degree":
            want = np.concatenate([close @ right["w"].to_numpy(), left["w"].to_numpy() @ close])
            got = dict(zip(out["a"].to_pylist(), out["b"].to_pylist()))
            assert [got.get(i, 0) for i in range(9000)] == want.tolist()
        elif kind == "forest":
            assert out.num_rows < 9000
        else:
            got = dict(zip(out["a"].to_pylist(), out["b"].to_pylist()))
            want = np.where(close, x @ y.T, -2).argmax(axis=1) + 4000
            assert got == {i: int(want[i]) for i in np.flatnonzero(close.any(axis=1)).tolist()}


def test_tiles_grow_with_the_table(spark, monkeypatch):
    monkeypatch.setattr(CC, "BLOCK_ROWS", 10)
    x = np.random.default_rng(3).normal(size=(800, 3))
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "id bigint, embedding array<double>")
    graph = CC.ThresholdGraph(df, 0.5)
    assert graph.nodes.select("tile").distinct().count() <= 2 * CC.CELLS  # 80 tiles of 10


def test_a_language_is_several_files_with_ordinals_running_on(spark, tmp_dir):
    docs = spark.createDataFrame([(i, f"text {i} " + "word " * 20, "en" if i % 5 else "de") for i in range(400)], "doc_id bigint, text string, lang string")
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        paths = FX.write_review_files(docs, f"{tmp_dir}/in")
        parsed = J.parse_lines(J.read_lines(spark, paths))
        assert parsed.where("category = 'en'").select("file").distinct().count() > 1
        rows = J.with_ordinals(parsed).select("category", "ordinal", F.col("rec").getItem("text").alias("text")).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    for lang in ("en", "de"):
        kept = [i for i in range(400) if ("en" if i % 5 else "de") == lang and i % 20 not in (3, 7, 11)]
        got = sorted((r.ordinal, int(r.text.split()[1])) for r in rows if r.category == lang)
        assert got == list(enumerate(kept, 1))


def test_a_written_table_leaves_no_shuffle_files(spark):
    import glob
    import os
    import time

    top = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    held = lambda: {f for d in top for f in glob.glob(f"{d}/*/shuffle_*.data") if os.path.getsize(f)}
    before = held()
    old = spark.conf.get(SHUFFLE_CLEANUP, None)
    out = written(spark.range(50_000).withColumn("g", F.col("id") % 7919).groupBy("g").agg(F.collect_list("id").alias("ids")), "sums")
    until = time.time() + 20
    while held() - before and time.time() < until:
        time.sleep(0.5)
    assert not held() - before
    assert out.count() == 7919 and spark.conf.get(SHUFFLE_CLEANUP, None) == old
