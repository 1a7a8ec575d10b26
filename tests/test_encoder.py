"""The fitted encoder against NumPy over the whole matrix, its orthonormal range, and one load per worker."""

import hashlib
import random
import re

import numpy as np
import pytest

from cartwheel.operators import encoder as EN
from cartwheel.operators import vectors as VX

DIM = 6


@pytest.fixture(scope="module")
def texts():
    rnd = random.Random(3)
    topics = [[f"{a}{i}" for i in range(12)] for a in ("sea", "sky", "land")]
    made = [" ".join(rnd.choice(topics[i % 3]) for _ in range(rnd.randrange(3, 30))) for i in range(90)]
    return [*made, "", None, "alone", "sea1 " * 70_000]


def words(text):
    return re.findall(r"\w{2,}", (text or "").lower())


def brute(texts, passes, orthonormal, max_terms=10**6):
    docs = [words(t) for t in texts]
    seen = {w: sum(w in d for d in map(set, docs)) for w in {w for d in docs for w in d}}
    terms = sorted((w for w in seen if seen[w] >= EN.MIN_DOCS), key=lambda w: (-seen[w], w))[:max_terms]
    idf = np.array([np.log((1 + len(docs)) / (1 + seen[w])) + 1 for w in terms])
    raw = np.array([[d.count(w) for w in terms] for d in docs]) * idf
    length = np.sqrt((raw * raw).sum(axis=1, keepdims=True))
    a = raw / np.where(length > 0, length, 1)
    f = np.array([[1.0 if hashlib.md5(f"{j}:{w}".encode()).hexdigest()[0] < "8" else -1.0 for j in range(DIM)] for w in terms])
    for _ in range(passes):
        f = a.T @ (a @ f)
    if orthonormal:
        value, vector = np.linalg.eigh(f.T @ f)
        f = f @ (vector / np.sqrt(value))
    x = raw @ f
    norm = np.sqrt((x * x).sum(axis=1, keepdims=True))
    return x / np.where(norm > 0, norm, 1), f


def table(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "id bigint, text string")


@pytest.mark.parametrize("passes,orthonormal,max_terms", [(1, False, 100), (1, True, 100), (2, False, 100), (1, False, 10)])
def test_vectors_equal_numpy(spark, tmp_dir, texts, passes, orthonormal, max_terms):
    docs = table(spark, texts).repartition(3)
    EN.fit(docs, tmp_dir, dim=DIM, passes=passes, orthonormal=orthonormal, max_terms=max_terms)
    got = {r.id: r.embedding for r in VX.hash_embed(docs, encoder=EN.load(spark, tmp_dir, DIM, double=True)).collect()}
    want, _ = brute(texts, passes, orthonormal, max_terms)
    got = np.array([got[i] for i in range(len(texts))])
    if orthonormal:  # a basis is free up to signs and turns: what it says about pairs is not
        got, want = got @ got.T, want @ want.T
    assert np.abs(got - want).max() < 1e-7


def test_only_documents_of_several_rows_are_shuffled_by_term(spark, tmp_dir, texts, monkeypatch):
    names = []
    real = EN.written
    monkeypatch.setattr(EN, "written", lambda df, name: names.append(name) or real(df, name))
    EN.fit(table(spark, texts), tmp_dir, dim=DIM)
    assert names == ["terms", "factors"]


@pytest.mark.parametrize("passes", [1, 2])
def test_rows_with_one_key_are_one_document(spark, tmp_dir, texts, passes):
    """A null key is a key; cutting a text at a space changes no factor."""
    rows = [x for i, t in enumerate(texts) for key in [None if i == 5 else i]
            for x in ([(key, p) for p in (t[:t.index(" ")], t[t.index(" "):], "")] if i % 3 == 2 and t and " " in t else [(key, t)])]
    docs = spark.createDataFrame(rows, "id bigint, text string").repartition(4)
    EN.fit(docs, tmp_dir, dim=DIM, passes=passes, orthonormal=False)
    held = spark.read.parquet(tmp_dir).orderBy("term").collect()
    _, want = brute(texts, passes, False)
    terms = {w for t in texts for w in words(t)}
    assert len(held) == len(want) and {r.term for r in held} <= terms
    got = {tuple(np.round(r.factor, 6) + 0.0) for r in held}
    assert got == {tuple(np.round(f, 6) + 0.0) for f in want}


def test_columns_are_orthonormal_and_topics_apart(spark, tmp_dir, texts):
    docs = table(spark, texts)
    encoder = EN.fit(docs, tmp_dir, dim=DIM, passes=2)
    f = np.array([r.factor for r in spark.read.parquet(tmp_dir).collect()])
    assert np.abs(f.T @ f - np.eye(DIM)).max() < 1e-6
    rows = {r.id: np.array(r.embedding) for r in VX.hash_embed(docs, encoder=encoder).collect()}
    same = np.mean([rows[i] @ rows[j] for i in range(90) for j in range(i) if i % 3 == j % 3])
    other = np.mean([rows[i] @ rows[j] for i in range(90) for j in range(i) if i % 3 != j % 3])
    assert same > 0.8 and other < 0.3


def test_prefix_and_texts_without_known_words(spark, tmp_dir, texts):
    docs = table(spark, ["", None, "unheard of", "sky1"])
    encoder = EN.fit(table(spark, texts), tmp_dir, dim=DIM)
    bare = [r.embedding for r in VX.hash_embed(docs, encoder=encoder).orderBy("id").collect()]
    assert all(x == [0.0] * DIM for x in bare[:3]) and abs(np.linalg.norm(bare[3]) - 1) < 1e-6
    said = [r.embedding for r in VX.hash_embed(docs, prefix="sky2 ", encoder=encoder).orderBy("id").collect()]
    assert abs(np.linalg.norm(said[0]) - 1) < 1e-6 and said[0] == said[2] and said[3] != bare[3]


def test_empty_table(spark, tmp_dir):
    docs = table(spark, [])
    assert VX.hash_embed(docs, encoder=EN.fit(docs, tmp_dir, dim=DIM)).count() == 0
    later = VX.hash_embed(table(spark, ["some words"]), encoder=EN.load(spark, tmp_dir, DIM)).collect()
    assert later[0].embedding == [0.0] * DIM


def test_a_worker_builds_the_model_once():
    class Sent:
        reads = 0

        @property
        def value(self):
            Sent.reads += 1
            return ["aa", "bb"], np.eye(2)

    sent = Sent()
    first, again = EN.model_of("m", sent), EN.model_of("m", sent)
    assert first is again and Sent.reads == 1


def test_too_large_a_model_is_refused(spark, tmp_dir, texts):
    with pytest.raises(ValueError):
        EN.fit(table(spark, texts), tmp_dir, dim=4096, max_terms=100_000)
