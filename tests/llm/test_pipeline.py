import re

import corpus_pipeline as P
from cartwheel.llm import decontaminate, line_dedup, simhash
from tests.llm.test_line_dedup import brute
from tests.llm.test_mixing import plain_targets
from tests.llm.test_simhash import plain_components, plain_fingerprint

SF = "/root/testdata/sf0.01"


def test_stages_against_plain_code(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before = {r.doc_id: r for r in docs.collect()}
    for name, stage in P.STAGES[:-1]:
        out = P.staged(stage(spark, docs, SF), f"test-{name}")
        assert out.columns == docs.columns and out.schema.simpleString() == docs.schema.simpleString()
        after = {r.doc_id: r for r in out.collect()}
        assert out.count() == len(after)
        if name == "language":
            assert set(after) == {d for d, r in before.items() if any(c.isalpha() for c in r.text or "")}
            assert all(after[d] == before[d] for d in after)
        elif name == "lines":
            want = brute([(d, r.text) for d, r in before.items()], line_dedup.RARE, line_dedup.LINK_WORDS, line_dedup.BLOCK_WORDS)
            want = {d[1]: t for d, t in want.items()}
            assert set(after) == {d for d, t in want.items() if t.split() or t == before[d].text}
            assert all(r.text == want[d] and r.n_chars == len(r.text) for d, r in after.items())
        elif name == "near_duplicates":
            comp = plain_components(list(before), [plain_fingerprint(r.text) for r in before.values()])
            assert set(after) == set(comp.values()) and len(after) < len(before)
            assert all(after[d] == before[d] for d in after)
        else:
            left = decontaminate.decontamination_report(out, spark.read.parquet(f"{SF}/benchmark.parquet"))
            assert left.where("contaminated").count() == 0
            changed = [d for d in after if after[d].text != before[d].text]
            assert 0 < len(changed) < 0.2 * len(before) and len(after) >= len(before) - 5
            hits = {r.doc_id: r for r in decontaminate.decontamination_report(docs, spark.read.parquet(f"{SF}/benchmark.parquet")).collect()}
            for d, r in hits.items():
                if d in after:
                    assert len(decontaminate.words_of(after[d].text)) == r.n_words - r.n_hit
        docs, before = out, after
    rows = P.mix_sources(spark, docs, SF).collect()
    sizes, taken = {}, {}
    for r in before.values():
        sizes[r.source] = sizes.get(r.source, 0) + len(re.findall(r"[^\x20\x09-\x0D]+", r.text))
    for r in rows:
        assert (r.text, r.source) == (before[r.doc_id].text, before[r.doc_id].source) and 0 < r.taken <= 3 * r["size"]
        taken[r.source] = taken.get(r.source, 0) + r.taken
    for s, t in plain_targets(sizes).items():
        assert abs(taken[s] - t) <= 70


def test_edge_rows_pass_every_stage(spark):
    long = " ".join(f"word{i}" for i in range(20_000))
    rows = [(1, "The cat sat on the mat and looked at the dog", "en", "a", 1, "x"), (1, "The cat sat on the mat and looked at the dog", "en", "a", 1, "x"),
            (2, None, None, None, None, None), (3, "", "de", "b", 0, ""), (None, "Der Hund lief über die Straße", "de", None, 5, "y"),
            (None, "Der Hund lief über die Straße", "de", None, 5, "z"), (5, long, "en", "b", 9, ""), (6, "12 34 !?", "en", "b", 9, "")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, taken string")
    for name, stage in P.STAGES:
        assert stage(spark, docs.limit(0), SF).count() == 0, name
        out = stage(spark, docs, SF)
        assert set(docs.columns) <= set(out.columns), name
        assert out.count() <= len(rows), name
    kept = simhash.keep_one(docs).collect()
    assert sorted((r.doc_id or 0) for r in kept) == [0, 1, 2, 5, 6]
    mixed = P.mix_sources(spark, docs, SF).collect()
    assert {r.doc_id for r in mixed} <= {1, None, 5, 6} and all(isinstance(r.taken, int) for r in mixed)
    assert P.run(spark, "/root/testdata/sf0.001").count() > 0


def test_unlabelled_documents_with_letters_stay(spark):
    rows = [(1, "The cat sat", None, "a", 1), (2, "Straße", None, "a", 1), (3, "12 !?", None, "a", 1), (4, None, None, "a", 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    out = P.identify_language(spark, docs, SF)
    assert out.columns == docs.columns and sorted(r.doc_id for r in out.collect()) == [1, 2]
