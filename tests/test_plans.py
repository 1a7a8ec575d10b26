"""Physical-plan assertions: pruning, pushdown, partial top-k, and where Python runs."""

import contextlib
import io
import re

import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL

PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "MapInArrow", "FlatMapGroupsInPandas",
                "FlatMapGroupsInArrow", "FlatMapCoGroupsInPandas", "FlatMapCoGroupsInArrow")
# Keys whose plan may run Python: signed hash embedding, the fitted encoder, and dense linear algebra in bounded Arrow batches
# or blocks with NumPy inside tasks — vector scoring (exact/IVF search, cell and topic assignment), the exact cosine-threshold pair
# blocks (components, DBSCAN), the trees and layouts of vector blocks (HDBSCAN, the non-linear map) and the topic Gram matrix. Everything else stays in the JVM.
PYTHON_ALLOWED = {"topic_similarity", "threshold_components", "density_topics", "knn_exact", "search_in_category",
                  "knn_ann", "search_batch", "vector_table", "flow_reviews", "kmeans_topics", "topic_map",
                  "document_map", "knn_ann_recall", "search_guarded", "hash_embed", "vector_write",
                  "hdbscan_topics", "nearest_neighbours", "manifold_map", "knn_pruned", "knn_codes_recall", "encoder_embed"}
# The training-data operators have their own tests (tests/llm).
KEYS = [k for k in E.queries() if not re.match(r"op\d+_|pipeline", k)]


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_top_deals_partial_window_limit(spark):
    p = plan(E.queries()["top_deals"](spark, SF_SMALL))
    assert p.count("WindowGroupLimit") >= 2  # partial before the exchange, final after it


def test_scan_pruning_and_pushdown(spark):
    p = plan(E.queries()["filter_products"](spark, SF_SMALL))
    assert "PushedFilters: [In(p_type" in p
    assert "p_size" not in p.split("ReadSchema:")[1].split("\n")[0]
    cs = plan(E.queries()["category_stats"](spark, SF_SMALL))
    schema = cs.split("ReadSchema:")[1].split("\n")[0]
    assert "l_shipdate" not in schema and "l_tax" not in schema


def test_ivf_probe_prunes_cells(spark):
    p = plan(E.queries()["knn_ann"](spark, SF_SMALL))
    lines = [x for x in p.splitlines() if x.startswith("PartitionFilters:")]
    assert any("dynamicpruning" in x and "cell" in x for x in lines)


def test_global_topk_is_take_ordered(spark):
    assert "TakeOrderedAndProject" in plan(E.queries()["top_rated"](spark, SF_SMALL))


@pytest.mark.parametrize("key", [k for k in KEYS if k not in PYTHON_ALLOWED])
def test_no_python_in_plan(spark, key):
    p = plan(E.queries()[key](spark, SF_SMALL))
    assert not any(n in p for n in PYTHON_NODES), key
