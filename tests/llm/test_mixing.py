import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from cartwheel.llm import mixing as M

SF = "/root/testdata/sf0.01"


def plain_targets(sizes):
    """Share by weight, stop at three times the size, share the excess again until none is above."""
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: [5, 2, 1][i % 3] for i, s in enumerate(names)}
    full, left = {}, float(sum(sizes.values()))
    while True:
        open_ = [s for s in names if s not in full]
        share = {s: left * weight[s] / sum(weight[t] for t in open_) for s in open_}
        over = [s for s in open_ if share[s] > 3 * sizes[s] + 1e-9]
        if not over:
            return full | share
        for s in over:
            full[s] = 3.0 * sizes[s]
            left -= full[s]


def test_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = M.mix_report(docs).collect()
    given = {r.doc_id: (r.source, len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))) for r in docs.collect()}
    assert {r.doc_id: r["size"] for r in rows} == {d: n for d, (_, n) in given.items()} and len(rows) == len(given)
    sizes = Counter()
    for s, n in given.values():
        sizes[s] += n
    want, taken = plain_targets(sizes), defaultdict(int)
    for r in rows:
        s = given[r.doc_id][0]
        assert r.source_size == sizes[s] and r.target == pytest.approx(want[s])
        assert 0 <= r.taken <= 3 * r["size"]
        taken[s] += r.taken
    for s, t in want.items():
        assert abs(taken[s] - t) <= 2 * M.BLOCK + 1, s
    assert sorted(map(tuple, rows)) == sorted(map(tuple, M.mix_report(docs.repartition(7)).collect()))


@pytest.mark.parametrize("n", [1, 2, 3, 10, 97, 1000])
def test_permutation_is_a_bijection(spark, n):
    df = M.with_permuted(spark.range(n), "p", F.col("id"), F.lit(n).cast("bigint"), F.lit(7))
    got = [r.p for r in df.orderBy("id").collect()]
    assert sorted(got) == list(range(n))
    if n >= 97:
        other = [r.p for r in M.with_permuted(spark.range(n), "p", F.col("id"), F.lit(n).cast("bigint"), F.lit(8)).orderBy("id").collect()]
        assert got != other and sum(a == i for i, a in enumerate(got)) < 12


def test_blocks_and_shards(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(200)
    plan = M.mix(docs, shard_slots=64)
    draws = plan.draws.collect()
    places = sorted(r.shard * 64 + r.slot for r in draws)
    assert places == list(range(len(draws)))  # every slot of every shard is filled once
    uses = Counter((r.src, r.block) for r in draws)
    blocks = defaultdict(list)
    for p in plan.pieces.collect():
        blocks[p.src, p.block].append(p)
    for src in {s for s, _ in blocks}:
        own = [b for s, b in blocks if s == src]
        assert sorted(own) == list(range(len(own)))
        counts = [uses[src, b] for b in own]
        assert max(counts) - min(counts) <= 1  # all blocks before any again
        lengths = [sum(p.n_words for p in blocks[src, b]) for b in sorted(own)]
        assert all(n == M.BLOCK for n in lengths[:-1]) and 0 < lengths[-1] <= M.BLOCK
    assert M.packed(plan).agg(F.sum("n_words")).first()[0] == M.taken_words(plan).agg(F.sum("taken")).first()[0]
    # the sources of a shard vary, as draws do
    assert len({tuple(sorted(Counter(r.src for r in draws if r.shard == s).items())) for s in (0, 1, 2)}) > 1


def test_edges(spark):
    docs = spark.createDataFrame([(1, "a b c", "s", 9), (1, "a b c", "s", 9), (2, None, "s", 0), (3, " \t", None, 0), (None, "x" + " y" * 5000, None, 0),
                                  (4, "", "only-empty", 0), (5, " lead trail ", "é", 0)], "doc_id bigint, text string, source string, size int")
    rows = M.mix_report(docs).collect()
    assert len(rows) == 7
    sizes = {"s": 6, None: 5001, "only-empty": 0, "é": 2}
    want = plain_targets(sizes)
    by = defaultdict(list)
    for r in rows:
        by[r.doc_id].append(r)
    assert [r["size"] for r in by[1]] == [3, 3] and by[5][0]["size"] == 2 and by[None][0]["size"] == 5001
    assert by[2][0].taken == by[3][0].taken == by[4][0].taken == 0
    assert by[4][0].target == 0 and by[None][0].target == pytest.approx(want[None])
    assert sum(r.taken for r in by[1]) == pytest.approx(want["s"], abs=6)
    assert M.mix_report(docs.limit(0)).count() == 0
    assert {r.taken for r in M.mix_report(docs.where("doc_id in (2, 4)")).collect()} == {0}
