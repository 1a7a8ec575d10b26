import hashlib
import re

import pytest
from pyspark.sql import functions as F

from cartwheel.llm import sketches as K

SF = "/root/testdata/sf0.01"


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    return {tuple(w[i:i + 5]) for i in range(max(len(w) - 4, 1))} if w else set()


def jaccard(a, b):
    a, b = shingles(a), shingles(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def test_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    order = sorted(texts)
    rows = K.fingerprint_report(docs).collect()
    assert len(rows) == len(texts)
    errors, by_text = [], {}
    for r in rows:
        text = texts[r.doc_id]
        nxt = texts[order[(order.index(r.doc_id) + 1) % len(order)]]
        half = len(text) // 2
        edited = text[:len(text) - half] + nxt[:half]
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        errors += [r.near_edited - jaccard(text, edited), r.near_next - jaccard(text, nxt)]
        assert by_text.setdefault(text, r.fingerprint) == r.fingerprint
        n = len(shingles(text))
        assert abs(r.shingles - n) <= (0 if n < K.K else 0.5 * n)
    assert max(map(abs, errors)) < 0.2 and sum(e * e for e in errors) / len(errors) < 0.0015


def test_estimates(spark):
    a, b = " ".join(f"a{i}" for i in range(900)), " ".join(f"a{i}" for i in range(300, 1500))
    df = spark.createDataFrame([(a, b)], "a string, b string").select(K.sketch("a").alias("a"), K.sketch("b").alias("b"),
                                                                      K.sketch(F.lit(a + " " + b)).alias("u"))
    r = df.select(K.resemblance("a", "b").alias("j"), K.containment("a", "b").alias("c"), K.distinct_shingles("b").alias("n")).first()
    assert abs(r.j - 596 / 1496) < 0.13 and abs(r.c - 596 / 896) < 0.2 and abs(r.n - 1196) < 350
    parts = spark.createDataFrame([(1, a), (1, b), (2, None), (3, "x y")], "k int, t string")
    merged = {r.k: r.sketch for r in K.merge_parts(parts, "k", "t").collect()}
    want = df.select(K.merge("a", "b").alias("m")).first().m
    assert merged[1] == want and len(merged[3]) == 1


@pytest.mark.parametrize("parts", ["1", "5"])
def test_edges(spark, parts):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        long = "w " * 40_000
        docs = spark.createDataFrame([(-5, "ab c", "x"), (7, None, "x"), (7, "é𝄞 zz", "x"), (9, "", "x"), (9, "", "x"), (10, long, ""), (None, "abcd", ""),
                                      (2**40, "last one", "")], "doc_id bigint, text string, sketch string")
        rows = K.fingerprint_report(docs).collect()
        assert len(rows) == 8
        sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
        got = {(r.doc_id, r.n_chars): r for r in rows}
        assert got[-5, 4].edited_sha256 == sha("ab")  # the next id is 7, whose smallest text is empty
        assert got[7, 5].edited_sha256 == sha("é𝄞 ") and got[7, 0].edited_sha256 == sha("")
        assert got[9, 0].near_edited == 1.0 and got[9, 0].fingerprint == "" and got[9, 0].near_next == 0.0
        assert got[10, 80_000].edited_sha256 == sha(long[:40_000] + "last one")
        assert got[2**40, 8].edited_sha256 == sha("last" + "ab c") and got[None, 4].edited_sha256 == sha("abab")
        assert K.fingerprint_report(docs.limit(0)).count() == 0
        one = K.fingerprint_report(docs.where("doc_id = 10")).first()
        assert one.near_next == 1.0
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_texts_are_shuffled_once_and_no_python(spark):
    df = K.fingerprint_report(spark.read.parquet(f"{SF}/documents.parquet"))
    df.write.format("noop").mode("overwrite").save()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
