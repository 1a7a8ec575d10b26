import numpy as np
import pytest

from cartwheel.llm import language as L

SF = "/root/testdata/sf0.01"


def test_model_accuracy_on_held_out_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = L.language_report(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) == docs.count()
    held = [r for r in rows if r.held_out]
    assert 0.2 < len(held) / len(rows) < 0.5
    assert np.mean([r.lang == r.lang_pred for r in held]) > 0.98
    assert all(0 <= r.score <= 1 for r in rows)


def test_ngrams_do_not_cross_texts():
    alone, s, e = L.grams([L.letters("Straße ab")])
    both, s2, e2 = L.grams([L.letters("zzz"), L.letters("Straße ab"), b"", L.letters("q")])
    assert (both[:, s2[1]:e2[1]] == alone[:, s[0]:e[0]]).all()


@pytest.mark.parametrize("text", [None, "", " 12 !? ", "\n"])
def test_letters_of_wordless_texts(text):
    assert L.letters(text) == b""


def test_margins_equal_sums_over_ngrams():
    rng = np.random.default_rng(1)
    model = L.Model(["de", "en"], [("de", "en", "germanic")], rng.normal(size=(L.BUCKETS, 1)).astype(np.float32), np.array([0.25]))
    cleaned = [L.letters(t) for t in ("one", None, "two three", "été", "x")]
    feats, s, e = L.grams(cleaned)
    want = [0.25 + (model.weights[feats[:, a:b].ravel(), 0].astype(float).sum() * 25 / (b - a) if b > a else 0)
            for a, b in zip(s, e)]
    assert np.allclose(model.margins(cleaned)[:, 0], want, atol=1e-4)


def test_edge_rows(spark):
    schema = "doc_id bigint, text string, lang string, score string, lang_pred int"
    rows = [(i, t, g, "x", 1) for i, (t, g) in enumerate([("the cat sat on", "en"), ("der hund lief", "de"), ("le chat est la", "fr"),
                                                         ("el perro corre", "es")] * 12)]
    rows += [(None, "the cat", "en", None, None), (900, None, "en", "", 0), (901, "", None, "", 0), (902, "123", "de", "", 0),
             (903, "the cat", None, "", 0), (903, "the cat", None, "", 0)]
    docs = spark.createDataFrame(rows, schema)
    out = L.language_report(docs).collect()
    assert len(out) == len(rows)
    got = {r.doc_id: r for r in out}
    assert [got[i].lang_pred for i in (900, 901, 902)] == ["und"] * 3 and got[900].score == 0
    assert got[903].lang_pred == "en" and got[None].held_out and got[None].lang_pred == "en"
    empty = L.language_report(docs.limit(0))
    assert empty.count() == 0
    unlabelled = L.language_report(docs.where("doc_id = 0").selectExpr("doc_id", "text", "cast(null as string) AS lang"))
    assert [r.lang_pred for r in unlabelled.collect()] == ["und"]
    one = L.identify(docs.where("doc_id = 0"), L.Model(["en"], [], np.zeros((L.BUCKETS, 0), np.float32), np.zeros(0)))
    assert one.columns == ["doc_id", "text", "lang", "lang_pred", "score"] and one.first().lang_pred == "en"


def test_copies_count_once_in_the_sample(spark):
    few = {"en": ["the cat sat on the mat", "the dog lay on the rug"], "de": ["der hund lief nach haus", "die katze lag auf dem tisch"]}
    rows = [(t, g) for g, found in few.items() for t in found * 2000] + [(f"le chat est la {chr(97 + i)}{i}", "fr") for i in range(25)]
    docs = spark.createDataFrame(rows, "text string, lang string")
    model = L.fit(docs, per_language=10)
    assert model.predict([t for found in few.values() for t in found])[0] == ["en", "en", "de", "de"]
    counts = {"en": 2, "de": 2, "fr": 25}
    got = [(r.lang, r.text) for r in L.sample(docs.selectExpr("*", "xxhash64(text) AS mark"), counts, 10).collect()]
    assert len(got) == len(set(got)) == 14 and {t for g, t in got if g == "en"} == set(few["en"])


def test_limit_of_marks_has_no_smallest_rate():
    assert L.mark_limit(5, 900) == L.mark_limit(900, 900) == 2**63 - 1
    for n in (1000, 10**9, 10**12):
        assert abs((L.mark_limit(n, 900) + 2**63 + 1) / 2**64 * n - 900) < 0.01
