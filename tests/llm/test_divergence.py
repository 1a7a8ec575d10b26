import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cartwheel.llm import divergence as D

SF = "/root/testdata/sf0.01"
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_terms(text):
    return [t.translate(LOW) for t in re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", text or "")]


def plain_report(rows, threshold=30):
    """rows: (text, lang, source)."""
    docs = [(plain_terms(t), lang or "", source or "") for t, lang, source in rows]
    seen = defaultdict(Counter)
    count = defaultdict(Counter)
    for terms, lang, source in docs:
        seen[lang].update(set(terms))
        count[lang, source].update(terms)
    out = []
    for lang in seen:
        kept = sorted(t for t, n in seen[lang].items() if n >= threshold)
        groups = sorted(s for a, s in count if a == lang)
        share = lambda c: {t: 1 + 10 ** 9 * (c[t] + 5) // (sum(c[k] for k in kept) + 5 * len(kept)) for t in kept}
        p = {s: share(count[lang, s]) for s in groups}
        q = share(sum((count[lang, s] for s in groups), Counter()))
        for s in groups:
            pairs = [(-sum(abs(p[s][t] - p[o][t]) for t in kept), o.encode(), o) for o in groups if o != s]
            terms = [(q[t] - p[s][t], t.encode(), t) for t in kept if count[lang, s][t] and p[s][t] > q[t]]
            for part, found in (("pair", pairs), ("term", sorted(terms)[:50])):
                out += [(lang, s, part, item, -v, r) for r, (v, _, item) in enumerate(sorted(found), 1)]
    return sorted(out)


def got(df):
    return sorted((r.lang, r.source, r.part, r["item"], r.value, r["rank"]) for r in df.collect())


def rows_of(docs):
    return [(r.text, r.lang, r.source) for r in docs.collect()]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(st.one_of(st.characters(codec="utf-8"), st.sampled_from("aB ZÄ1@[`{\x7f")), max_size=30)), max_size=6))
def test_terms_of_any_texts(texts):
    doc, terms = D.split_terms(pa.array([t or "" for t in texts], pa.string()))
    found = [(int(d), t.decode()) for d, t in zip(doc, terms.to_pylist(), strict=True)]
    assert found == [(i, t) for i, text in enumerate(texts) for t in plain_terms(text)]


def test_documents_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert got(D.divergence_report(docs)) == plain_report(rows_of(docs))


@pytest.mark.parametrize("chunk_bytes,bits", [(1, 1 << 23), (20_000, 64), (1 << 20, 128)])
def test_small_chunks_and_a_crowded_bitmap(spark, chunk_bytes, bits):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(250).repartition(3)
    assert got(D.divergence(docs, threshold=7, chunk_bytes=chunk_bytes, bits=bits)) == plain_report(rows_of(docs), 7)


def test_many_buckets_and_salts(spark, monkeypatch):
    monkeypatch.setattr(D, "BUCKET_TERMS", 5)
    monkeypatch.setattr(D, "MERGE_PAIRS", 40)
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(250).repartition(3)
    assert got(D.divergence(docs, threshold=7, chunk_bytes=30_000)) == plain_report(rows_of(docs), 7)


def test_shares_are_exact_for_large_counts():
    counts, divisor = [0, 1, 12_345_678_901_234, 8 * 10 ** 15], 8 * 10 ** 15 + 35
    assert D.shares(np.array(counts), np.int64(divisor)).tolist() == [1 + 10 ** 9 * (c + 5) // divisor for c in counts]


def test_edges(spark):
    long = "é" * 3000 + "X" * 100_001
    rows = ([(long, "en", "a")] * 30 + [(long + "x", "en", "b")] * 29 + [(None, None, None), ("", "", ""), ("1 2 3", "xx", "only"), ("The the THE", "de", None)]
            + [("Tie tied TIED", "en", s) for s in ("b", "c", "ä") for _ in range(15)] + [("word", None, "q")] * 31 + [("Ünit \x00unit", "de", f"s{i % 3}") for i in range(33)]
            + [("none kept here", "fr", f"s{i}") for i in range(4)])
    docs = spark.createDataFrame([(*r, i, 0) for i, r in enumerate(rows)], "text string, lang string, source string, rank int, value int")
    found = got(D.divergence_report(docs))
    assert found == plain_report(rows)
    assert {r[3] for r in found if r[:3] == ("en", "a", "term")} == {long.lower()}
    assert [r for r in found if r[0] == "xx"] == [] and {r[4] for r in found if r[0] == "fr"} == {0}
    assert D.divergence_report(docs.limit(0)).count() == 0
