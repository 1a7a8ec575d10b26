import random

import duckdb
import pytest

from cartwheel.llm import phrases as P

SF = "/root/testdata/sf0.01"


def brute(rows, window):
    docs = [(i, (t or "").encode().split()) for i, t in rows]
    starts = {}
    for i, w in docs:
        if i is not None:
            for k in range(len(w) - window + 1):
                key = tuple(w[k:k + window])
                starts[key] = min(starts.get(key, i), i)
    out = []
    for i, w in docs:
        gone = {k + j for k in range(len(w) - window + 1) for j in range(window)
                if i is not None and starts[tuple(w[k:k + window])] < i}
        out.append((i, len(w), len(gone), b" ".join(x for k, x in enumerate(w) if k not in gone).decode()))
    return sorted(out, key=str)


def got(df):
    return sorted(((r.doc_id, r.n_words, sum(s["end"] - s["start"] for s in r.spans), r.kept) for r in df.collect()), key=str)


def test_documents_equal_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    want = sorted(con.execute(P.REPORT_SQL).fetchall())
    df = P.repeats_report(spark.read.parquet(f"{SF}/documents.parquet"))
    assert sorted(map(tuple, df.collect())) == want
    assert sum(r[2] for r in want) > 1000


@pytest.mark.parametrize("seed", range(4))
def test_random_documents_equal_brute_force(spark, seed):
    rng = random.Random(seed)
    passages = [[rng.choice("abcde") + rng.choice("xyz") for _ in range(rng.randint(3, 9))] for _ in range(12)]
    rows = []
    for i in range(150):
        w = [x for _ in range(rng.randint(0, 5)) for x in rng.choice(passages)]
        rows.append((rng.choice([None, i, i, i, i % 20]), rng.choice([" ", "\n", "  "]).join(w) if w else rng.choice([None, "", " "])))
    rows += [(3, rows[5][1])] * 3
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    out = P.remove_repeats(df, window=4, shard_bytes=300, range_windows=20, automaton_phrases=7)
    assert got(out) == brute(rows, 4)


def test_edges(spark):
    long = " ".join(f"w{i}" for i in range(30_000))
    rows = [(1, long, 5), (2, "x " + long + " ü", 5), (3, "too short", 5), (4, None, 5), (None, long, 5), (2, "x " + long + " ü", 5)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, n_words int")
    out = got(P.remove_repeats(docs))
    assert out == brute([r[:2] for r in rows], 13) and (2, 30_002, 30_000, "x ü") in out
    assert P.repeats_report(docs.limit(0)).count() == 0


def test_texts_are_shuffled_once(spark):
    df = P.remove_repeats(spark.read.parquet(f"{SF}/documents.parquet"))
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    final = text.split("Initial Plan")[0]
    assert final.count("FlatMap") == 4 and final.count("ReusedExchange") >= 2
