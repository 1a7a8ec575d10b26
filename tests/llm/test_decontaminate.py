import duckdb
import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from cartwheel.llm import decontaminate as D

SF = "/root/testdata/sf0.01"


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 4), min_size=1, max_size=60))
def test_suffix_array_orders_suffixes(symbols):
    symbols = np.array([*symbols, 0])
    order = D.suffix_array(symbols)
    zeros = {p: i for i, p in enumerate(np.flatnonzero(symbols == 0))}
    # every separator is a sign of its own, smaller than any word, in order of position
    full = [[(0, zeros[q]) if symbols[q] == 0 else (1, symbols[q]) for q in range(p, len(symbols))] for p in range(len(symbols))]
    assert list(order) == sorted(range(len(symbols)), key=lambda p: full[p])


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 3), min_size=1, max_size=80), st.lists(st.integers(1, 3), min_size=1, max_size=5))
def test_search_and_locate(symbols, phrase):
    index = D.FMIndex(np.array(symbols), sample=4)
    low, high = index.search(np.array([phrase]))
    found = sorted(index.locate(np.arange(low[0], high[0])))
    assert found == [i for i in range(len(symbols)) if symbols[i:i + len(phrase)] == phrase]


def brute(docs, items, window):
    pieces = {}
    for item, w in items:
        for i in range(max(len(w) - window, 0) + 1):
            if p := tuple(w[i:i + window]):
                pieces.setdefault(p, set()).add(item)
    out = []
    for d in docs:
        hit, found = set(), set()
        for p, names in pieces.items():
            for i in range(len(d) - len(p) + 1):
                if tuple(d[i:i + len(p)]) == p:
                    hit |= set(range(i, i + len(p)))
                    found |= names
        out.append((len(hit), sorted(found)))
    return out


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.sampled_from([b"a", b"b", b"c", b"d"]), max_size=12), min_size=1, max_size=5),
       st.lists(st.lists(st.sampled_from([b"a", b"b", b"c"]), max_size=6), max_size=4))
def test_shards_against_brute_force(docs, items):
    items = [(str(i), w) for i, w in enumerate(items)]
    got = D.search_shard(docs, D.Phrases(items, 3))
    assert [(int(sum(b - a for a, b in s)), i) for s, i in got] == brute(docs, items, 3)


def test_report_equals_sql(spark):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = sorted(con.execute(D.REPORT_SQL).fetchall())
    got = D.decontamination_report(spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/benchmark.parquet"))
    assert sorted(tuple(r) for r in got.collect()) == want
    assert sum(r[5] for r in want) > 0


def test_blocks_and_edges(spark):
    long = " ".join(f"w{i % 50}" for i in range(30_000))
    docs = spark.createDataFrame([(1, "One two, THREE four", "x", 9), (1, "One two, THREE four", "x", 9), (2, None, None, None), (None, "", "", 0),
                                  (3, "ÄÖ é one two three four five six seven eight nine ten eleven", "", 0), (4, long, "", 0)],
                                 "doc_id bigint, text string, items string, n_words int")
    bench = spark.createDataFrame([(7, "three FOUR"), (7, "three FOUR"), (8, None), (9, "--"), (None, "two-three"),
                                   (10, "one two three four five six seven eight nine ten x"), (11, "w48 w49 w0")], "item_id int, text string")
    whole = sorted(D.decontamination_report(docs, bench).collect(), key=str)
    blocks = D.find_benchmark(docs, bench, block_words=3)  # several passes
    assert blocks.columns == ["doc_id", "text", "n_words", "spans", "items"]
    cut = sorted(((r.doc_id, r.n_words, sum(s["end"] - s["start"] for s in r.spans), D.items_digest(r["items"])) for r in blocks.collect()), key=str)
    assert len(whole) == 6 and cut == sorted(((r.doc_id, r.n_words, r.n_hit, r.items_sha256) for r in whole), key=str)
    by = {r.doc_id: r for r in whole}
    assert by[1].n_hit == 3 and by[1].items_sha256 == D.items_digest(["7", ""])
    assert by[2].n_words == 0 and not by[None].contaminated
    assert by[3].n_hit == 10 and by[3].n_items == 3 and by[4].n_hit == 3 * 599
    assert D.decontamination_report(docs.limit(0), bench).count() == 0
    assert D.decontamination_report(docs, bench.limit(0)).where("contaminated").count() == 0


def test_removed_text():
    assert D.decontaminated_text("Ä one, TWO three.", [{"start": 1, "end": 3}]) == "Ä  three."
    assert D.decontaminated_text(None, []) is None
