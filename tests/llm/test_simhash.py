import itertools
import re

import numpy as np
import pytest
import xxhash

from cartwheel.llm import simhash as H

SF = "/root/testdata/sf0.01"


def plain_fingerprint(text):
    found = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    pieces = [found[i:i + 4] for i in range(max(len(found) - 3, 1))] if found else []
    hashes = [xxhash.xxh64_intdigest(" ".join(p), 42) for p in pieces]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(ids, fps, limit=4):
    root = list(range(len(ids)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    values = np.array(fps, np.uint64)
    for i in range(len(ids)):
        for j in np.flatnonzero(np.bitwise_count(values[i] ^ values[i + 1:]) <= limit):
            root[find(i + 1 + int(j))] = find(i)
    out = {}
    for i, d in enumerate(ids):
        out[find(i)] = min(out.get(find(i), d), d)
    return {d: out[find(i)] for i, d in enumerate(ids)}


def test_documents_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = H.near_dedup_report(docs).collect()
    texts = {r.doc_id: r.text for r in docs.collect()}
    fps = {d: plain_fingerprint(t) for d, t in texts.items()}
    assert {r.doc_id: r.fingerprint for r in got} == {d: f"{f:016x}" for d, f in fps.items()}
    assert {r.doc_id: r.component_id for r in got} == plain_components(list(fps), list(fps.values()))


@pytest.mark.parametrize("chunk", [5, 100, 4096])
def test_links_of_dense_groups(spark, chunk):
    rng = np.random.default_rng(chunk)
    flip = lambda x, n: int(x) ^ sum(1 << int(b) for b in rng.choice(64, n, replace=False))
    centres = rng.integers(0, 1 << 64, 6, dtype=np.uint64)
    fps = sorted({flip(c, int(rng.integers(0, 4))) for c in centres for _ in range(60)}
                 | {int(x) for x in rng.integers(0, 1 << 64, 300, dtype=np.uint64)})
    rows = spark.createDataFrame([(int(np.uint64(f).view(np.int64)),) for f in fps], "fp bigint")
    links = [(int(np.int64(r.a).view(np.uint64)), int(np.int64(r.b).view(np.uint64)))
             for r in H.close_links(rows, "fp", chunk=chunk).collect()]
    assert all((a ^ b).bit_count() <= 4 for a, b in links)
    root = {f: f for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in links:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    want = plain_components(fps, fps)
    groups = lambda of: {frozenset(g) for _, g in itertools.groupby(sorted(fps, key=of), key=of)}
    assert groups(find) == groups(want.get)


def test_one_large_group_stays_linear():
    rng = np.random.default_rng(2)
    centre = int(rng.integers(0, 1 << 63))
    fps = np.unique(np.array([centre ^ (1 << int(a)) ^ (1 << int(b)) for a, b in rng.integers(0, 64, (20_000, 2))], np.uint64))
    links = H.forest(fps, None, 4)
    assert len(links) == len(fps) - 1


def test_edges(spark):
    long = " ".join(f"w{i}" for i in range(50_000))
    docs = spark.createDataFrame([(5, None, "x"), (4, "", "y"), (4, "", "y"), (9, " \n", "z"), (7, "A b", ""), (8, "a\tB", ""), (None, "a b", ""),
                                  (3, long, ""), (2, long.upper(), ""), (None, "solo text of nobody else", "")],
                                 "doc_id bigint, text string, fingerprint string")
    rows = H.near_dedup_report(docs).collect()
    assert len(rows) == 10
    by = {(r.doc_id, r.fingerprint): r.component_id for r in rows}
    assert [by[d, "0" * 16] for d in (5, 4, 9)] == [4, 4, 4]
    short = f"{plain_fingerprint('a b'):016x}"
    assert by[7, short] == by[8, short] == by[None, short] == 7
    assert by[None, f"{plain_fingerprint('solo text of nobody else'):016x}"] is None
    assert len({(r.fingerprint, r.component_id) for r in rows if r.doc_id in (2, 3)}) == 1
    assert H.near_dedup_report(docs.limit(0)).count() == 0
