import hashlib
import random

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from cartwheel.llm import line_dedup as L

SF = "/root/testdata/sf0.01"


@settings(max_examples=400, deadline=None)
@given(st.lists(st.integers(0, 6), max_size=12), st.lists(st.integers(0, 6), max_size=12))
def test_alignment_is_common_and_rising(a, b):
    out = L.patience(a, b)
    assert all(a[i] == b[k] for i, k in out)
    assert all(x < y and p < q for (x, p), (y, q) in zip(out, out[1:]))
    if len(set(a)) == len(a) and len(set(b)) == len(b) and [x for x in a if x in b] == [x for x in b if x in a]:
        assert len(out) == len(set(a) & set(b))
    if a == b:
        assert len(out) == len(a)


def test_rising_is_longest():
    rng = random.Random(1)
    for _ in range(50):
        p = rng.sample(range(30), 12)
        pairs = list(enumerate(p))
        best = max(sum(1 for _ in s) for s in ([x] for x in p))
        lengths = [1] * 12
        for i in range(12):
            lengths[i] = 1 + max((lengths[j] for j in range(i) if p[j] < p[i]), default=0)
            best = max(best, lengths[i])
        assert len(L.longest_rising(pairs)) == best


def plain_common(a, b):
    """(length, pairs that go on a run) of the best common subsequence, by the full table."""
    best = [[(0, 0)] * (len(b) + 1) for _ in range(len(a) + 1)]
    last = [[None] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a, 1):
        for k, y in enumerate(b, 1):
            if x == y:
                n, r = max([best[i - 1][k - 1]] + [(n, r + 1) for n, r in [last[i - 1][k - 1] or (-1, 0)]])
                last[i][k] = (n + 1, r)
            best[i][k] = max([best[i - 1][k], best[i][k - 1]] + [last[i][k]] * (x == y))
    return best[-1][-1]


@settings(max_examples=600, deadline=None)
@given(st.lists(st.integers(0, 4), max_size=14), st.lists(st.integers(0, 4), max_size=14))
def test_longest_common_equals_the_full_table(a, b):
    out = L.longest_common(a, b)
    assert all(a[i] == b[k] for i, k in out)
    assert all(x < y and p < q for (x, p), (y, q) in zip(out, out[1:]))
    assert (len(out), sum(v == (u[0] + 1, u[1] + 1) for u, v in zip(out, out[1:]))) == plain_common(a, b)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=7), st.lists(st.integers(0, 3), max_size=7))
def test_repeated_lines_are_aligned_in_full(a, b):
    a, b = a + a, b + b  # no line is unique on either side
    assert len(L.patience(a, b)) == plain_common(a, b)[0]


def test_blocks_repeated_in_either_document():
    c, d, e, p, q, r = range(6)
    assert L.common_blocks([p], [c, p, d, p, e], [9] * 5, 8) in ([(1, 1)], [(3, 3)])
    assert L.common_blocks([c, p, d, p, e], [q, p, r], [1, 9, 1], 8) == [(1, 1)]
    assert L.common_blocks([p, q], [c, p, d, p, q, p, e, q, r], [5] * 9, 8) == [(3, 4)]
    block = list(range(10, 400))
    assert len(L.patience([c, *block, d], [e, *block, p, *block, q])) == len(block)


def brute(rows, rare, link, words):
    """Texts after the links the operator documents: lines by ``rare`` and ``link``, shortest runs by ``words``.

    Documents are distinct (id, text); they order by id, null last, then by the text's XXH64, signed.
    """
    mark = lambda t: int(np.uint64(xxhash.xxh64_intdigest(t, 42)).view(np.int64))
    docs = sorted({(i is None, i or 0, t) for i, t in rows if t is not None}, key=lambda d: (d[0], d[1], mark(d[2])))
    keyed = {d: L.line_keys(d[2]) for d in docs}
    lines, runs = {}, {}
    for d in docs:
        _, keys, sizes = keyed[d]
        for a, n in enumerate(sizes):
            if n >= link:
                lines.setdefault(keys[a], {})[d] = 1
            for b in range(a + 1, min(len(sizes), a + words)):
                if sum(sizes[a:b + 1]) >= words and min(sum(sizes[a:b]), sum(sizes[a + 1:b + 1])) < words:
                    runs.setdefault(tuple(keys[a:b + 1]), {})[d] = 1
    pairs = {(w[0], b) for w in map(list, [*lines.values(), *runs.values()]) for b in w[1:]}
    pairs |= {(a, b) for w in map(list, lines.values()) if len(w) <= rare for x, a in enumerate(w) for b in w[x + 1:]}
    gone = {d: set() for d in docs}
    for a, b in pairs:
        at, keys, sizes = keyed[b]
        for first, last in L.common_blocks(keyed[a][1], keys, sizes, words):
            gone[b] |= set(range(at[first], at[last] + 1))
    return {d: "\n".join(x for n, x in enumerate(d[2].split("\n")) if n not in gone[d]) for d in docs}


@pytest.mark.parametrize("seed", range(3))
def test_random_documents_equal_brute_force(spark, seed):
    rng = random.Random(seed)
    lines = [" ".join(rng.choice("abcdefgh") for _ in range(rng.randint(0, 5))) for _ in range(40)]
    rows = [(rng.choice([i, i, i, None]), "\n".join(rng.choice(lines) for _ in range(rng.randint(0, 9)))) for i in range(80)]
    rows += [rows[3], rows[3], (500, None)]
    want = brute(rows, 3, 2, 4)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    src = docs.withColumnRenamed("text", "body").selectExpr("doc_id", "body", "body AS was", "1 AS removed_lines", "doc_id AS mark")
    out = L.dedup_lines(src, text_col="body", rare=3, link_words=2, min_words=4)
    assert out.columns == ["doc_id", "body", "was", "mark", "removed_lines"]
    got = out.collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.body == (None if r.was is None else want[r.doc_id is None, r.doc_id or 0, r.was])


def test_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = {r.doc_id: r.text for r in docs.collect()}
    got = L.line_report(docs).collect()
    want = brute(list(rows.items()), L.RARE, L.LINK_WORDS, L.BLOCK_WORDS)
    assert len(got) == len(rows) and sum(r.n_removed for r in got) > 50
    for r in got:
        text = want[False, r.doc_id, rows[r.doc_id]]
        assert r.kept_sha256 == hashlib.sha256(text.encode()).hexdigest() and r.n_lines == rows[r.doc_id].count("\n") + 1
    clean = [r for r in got if not r.n_removed]
    assert len(clean) > 0.6 * len(got)


def test_copies_and_edges(spark):
    body = "one two three four five\nsix seven eight nine ten\n\neleven twelve thirteen fourteen"
    long = "\n".join(f"line number {i} of a very long text" for i in range(20_000))
    rows = [(i, body) for i in range(1, 30)] + [(40, body + "\nan ending of its own that stays"), (41, None), (42, ""), (43, "\n \n"), (None, body),
                                                (50, long), (51, long.upper() + "\nlast words")]
    got = {r.doc_id: r for r in L.line_report(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got[1].n_removed == 0 and all(got[i].n_removed == 4 for i in [*range(2, 30), 40, None])
    assert got[41].n_removed == got[42].n_removed == got[43].n_removed == got[50].n_removed == 0
    assert got[51].n_removed == 20_000 and got[51].kept_chars == len("last words")
    assert L.line_report(spark.createDataFrame(rows, "doc_id bigint, text string").limit(0)).count() == 0


@settings(max_examples=400, deadline=None)
@given(st.lists(st.integers(1, 9), max_size=14))
def test_runs_cover_every_block(sizes):
    keys = list(range(len(sizes)))
    runs = [range(a, b + 1) for a in keys for b in keys[a:] if sum(sizes[a:b + 1]) >= 8
            and (sum(sizes[a:b]) < 8 or sum(sizes[a + 1:b + 1]) < 8)]
    many = [r for r in runs if len(r) > 1]
    assert sorted(L.run_keys(keys, sizes, 8)) == sorted(L.run_keys(list(r), [8 if len(r) == 1 else 1] * len(r), len(r))[0] for r in many)
    for a in keys:
        for b in keys[a:]:
            if sum(sizes[a:b + 1]) >= 8:
                assert {x for r in runs if r[0] >= a and r[-1] <= b for x in r} == set(range(a, b + 1))


def test_blocks_of_frequent_lines_meet_a_document_that_has_them(spark):
    one, two, tail = "first line of five words", "second line of five words", "short tail"
    tiny = "\n".join(f"tiny {i}" for i in range(6))
    rows = [(1, f"{one}\nstands alone here"), (2, f"{two}\nstands alone there")]
    rows += [(i, f"own words of {i}\n{one}\n{two}\nmore words of {i}") for i in range(10, 31)]
    rows += [(i, f"{one}\n{two}\n{tail}\nlast words of {i}") for i in range(40, 60)]
    rows += [(i, f"words of {i} above\n{tiny}\nwords of {i} below") for i in range(60, 80)]
    got = {r.doc_id: r.n_removed for r in L.line_report(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert [got[i] for i in (1, 2, 10, 40, 60)] == [0, 0, 0, 2, 0]
    assert {got[i] for i in range(11, 31)} == {2} and {got[i] for i in range(41, 60)} == {3} and {got[i] for i in range(61, 80)} == {6}
