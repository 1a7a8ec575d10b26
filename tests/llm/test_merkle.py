import hashlib
import zlib

import pytest

from cartwheel.llm import merkle as M

SF = "/root/testdata/sf0.01"


def sha(text):
    return hashlib.sha256(text.encode("utf-8")).hexdigest()


def plain_leaf(row):
    value = lambda v: "-" if v is None else f"{len(str(v).encode('utf-8'))}:{v}"
    return sha("".join(value(row[c]) for c in ("doc_id", "source", "lang", "n_chars", "text")))


def plain_tree(nodes):
    """(the last node, for each node its sibling lists and the function that folds it)."""
    paths = [[] for _ in nodes]
    where = list(range(len(nodes)))
    while len(nodes) > 1:
        for i, at in enumerate(where):
            run = at // 16 * 16
            paths[i].append((nodes[run:at], nodes[at + 1:run + 16]))
        nodes = [sha("".join(nodes[i:i + 16])) for i in range(0, len(nodes), 16)]
        where = [at // 16 for at in where]
    return nodes[0], paths


def plain_report(rows):
    by = {}
    for r in rows:
        by.setdefault(r["source"], []).append(r)
    order = sorted(by, key=lambda s: (s is not None, (s or "").encode("utf-8")))
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    trees = {}
    for s in order:
        part = sorted(by[s], key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, plain_leaf(r)))
        trees[s] = (part, *plain_tree([plain_leaf(r) for r in part]))
    root, tops = plain_tree([trees[s][1] for s in order]) if order else (None, [])
    out = []
    for k, s in enumerate(order):
        part, subroot, paths = trees[s]
        for r, path in zip(part, paths):
            shown = dict(r)
            if r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0 and r["text"] is not None:
                shown["text"] = r["text"].translate(low)
            node = plain_leaf(shown)
            for left, right in path + tops[k]:
                node = sha("".join(left) + node + "".join(right))
            proof = "".join("".join(a) + "".join(b) for a, b in path + tops[k])
            out.append((r["doc_id"], plain_leaf(r), subroot, root, sha(proof), node, node == root))
    return out


def rows_of(df):
    key = lambda t: tuple((x is not None, x if x is not None else 0) for x in t)
    return sorted((tuple(r[c] for c in ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")) for r in df.collect()), key=key)


def plain_rows(docs):
    key = lambda t: tuple((x is not None, x if x is not None else 0) for x in t)
    return sorted(plain_report([r.asDict() for r in docs.collect()]), key=key)


def test_documents_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = rows_of(M.manifest_report(docs))
    assert got == plain_rows(docs)
    assert 0 < sum(r[-1] for r in got) < len(got)


def test_several_superblocks_and_many_small_sources(spark):
    hot = spark.range(9000).selectExpr("id * 3 AS doc_id", "'hot' AS source", "'en' AS lang", "id AS n_chars", "concat('Text ', id) AS text")
    small = spark.range(600).selectExpr("id AS doc_id", "concat('s', id div 2) AS source", "'en' AS lang", "id AS n_chars", "'A' AS text")
    docs = hot.unionByName(small).repartition(7)
    assert rows_of(M.manifest_report(docs)) == plain_rows(docs)


@pytest.mark.parametrize("count", [1, 16, 17, 4096, 4097])
def test_one_source_of_edge_sizes(spark, count):
    docs = spark.range(count).selectExpr("id AS doc_id", "'s' AS source", "'en' AS lang", "1L AS n_chars", "'X' AS text")
    assert rows_of(M.manifest_report(docs)) == plain_rows(docs)
    got = M.manifest(docs).collect()
    assert [(r.source, r.n) for r in got] == [("s", count)] and got[0].subroot == got[0].root


def test_edges(spark):
    long = "Long Word " * 60_000
    docs = spark.createDataFrame(
        [(None, None, None, None, None, "x", 1), (1, "b", "en", 3, "abc", "x", 1), (1, "b", "en", 3, "abc", "y", 2), (1, "b", "en", 3, "ABC", "y", 2),
         (2, "é", "fr", 0, "", "", 3), (10, "é", "fr", None, long, "", 3), (-7, "a", None, 5, "ÄBC d", "", 4), (None, "a", "en", 5, "X", "", 4),
         (2 ** 53 + 1, "a", "en", 5, "X", "", 4), (2 ** 53, "a", "en", 5, "X", "", 4), (1, None, "en", 1, "a", "", 5)],
        "doc_id bigint, source string, lang string, n_chars bigint, text string, digest string, tree bigint")
    assert rows_of(M.manifest_report(docs)) == plain_rows(docs)
    assert M.manifest_report(docs.limit(0)).count() == 0 and M.manifest(docs.limit(0)).count() == 0


def test_any_changed_field_is_caught(spark):
    from pyspark.sql import functions as F
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    other = M.leaf("doc_id", "source", "lang", F.col("n_chars") + 1, "text")
    got = M.prove(docs, F.when(F.col("doc_id") == 7, other)).where(~F.col("verified")).collect()
    assert [r.doc_id for r in got] == [7]
