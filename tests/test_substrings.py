"""The trigram index finds what the scan finds, and reads only the folders of its trigrams."""

import contextlib
import io
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cartwheel.operators import search as SR
from cartwheel.operators import substrings as SU

ALPHABET = ["a", "b", "ß", "É", " ", "日", "𝄞", "%", "_"]


@pytest.fixture(scope="module")
def texts(spark):
    rnd = random.Random(5)
    made = ["".join(rnd.choice(ALPHABET) for _ in range(rnd.randrange(0, 60))) for _ in range(400)]
    rows = [*enumerate(made), (400, None), (401, ""), (402, "ab" * 50_000), (403, "None of it"), (7, "twice aab"), (None, "aab without an id")]
    return spark.createDataFrame(rows, "id bigint, text string").cache()


@pytest.fixture(scope="module")
def index(spark, texts):
    from cartwheel.session import scratch_dir
    path = scratch_dir(spark, "grams")
    SU.build_index(texts, path, parts=16)
    return path


def plain(rows, terms):
    """The scan in Python."""
    found = []
    for r in rows:
        text = ("None" if r.text is None else r.text).lower()
        if any(t.lower() in text for t in terms):
            found.append((r.id, r.text))
    return sorted(found, key=repr)


@pytest.mark.parametrize("terms", [["aab"], ["É日a", "%_%"], ["bab𝄞"], ["ab" * 40], ["none"], ["zzz"], ["a"], ["日 "], ["aab", "x"], ["AAB", "aab"]])
def test_found_rows_equal_the_scan(texts, index, terms):
    got = [(r.id, r.text) for r in SU.containing(texts, index, terms).collect()]
    assert sorted(got, key=repr) == plain(texts.collect(), terms)


def test_no_terms_keep_every_row(texts, index):
    assert SU.containing(texts, index, []).count() == texts.count()


def test_trigrams_of_a_text(spark):
    got = spark.createDataFrame([("abcab日",), ("ab",), ("",), ("aaaa",)], "t string").select(SU.grams(F.col("t")).alias("g")).collect()
    assert [r.g for r in got] == [["abc", "bca", "cab", "ab日"], [], [], ["aaa"]]


def test_index_holds_every_trigram_of_every_text_in_few_rows(spark, texts, index):
    held = spark.read.parquet(f"{index}/postings")
    got = sorted((r.gram, i) for r in held.collect() for i in r.ids)
    want = sorted((g, r.id) for r in texts.where("id is not null").select("id", SU.grams(SU.searched("text")).alias("g")).collect() for g in r.g)
    assert got == want
    assert held.count() < len(want) / 2  # a row per trigram and block, not per trigram and text
    counts = {r.gram: r.n for r in spark.read.parquet(f"{index}/counts").collect()}
    assert sum(counts.values()) == len(want) and all(counts[g] > 0 for g, _ in want)


@pytest.mark.parametrize("block", [1, 500, 1 << 30])
def test_blocks_of_any_size_and_alphabet(monkeypatch, block):
    monkeypatch.setattr(SU, "BLOCK_BYTES", block)
    rnd = random.Random(6)
    wide = [chr(c) for c in range(70_000) if not 0xD800 <= c < 0xE000]  # 17 bits: 5,000 texts are too many to number at once
    made = ["".join(wide[14 * i:14 * i + 14]) for i in range(5000)] if block > 500 else []
    made += ["", "ab", "\x00\x00\x00\x00", "a\x00", "abc\x00\x00", "aaaa", *("".join(rnd.choice(ALPHABET) for _ in range(rnd.randrange(80))) for _ in range(50))]
    batch = pa.RecordBatch.from_pydict({"id": pa.array([f"k{i}" for i in range(len(made))]), "text": pa.array(made, pa.string())}).slice(1)
    got = sorted((r["gram"], i) for out in SU._cut([batch]) for r in out.to_pylist() for i in r["ids"] if r["n"] == len(r["ids"]))
    assert got == sorted({(t[j:j + 3], f"k{i}") for i, t in enumerate(made) if i for j in range(len(t) - 2)})


def test_lookup_prunes_folders_and_pushes_the_trigrams(spark, index):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        SU.postings(spark, index, "aab").explain("formatted")
    lines = buf.getvalue().splitlines()
    assert any(x.startswith("PartitionFilters") and "part" in x for x in lines)
    assert any(x.startswith("PushedFilters") and "gram" in x for x in lines)


@pytest.mark.parametrize("query", ["aab one", "aab aab", "a", "", "zzz", "none"])
def test_keyword_search_equals_the_scan(spark, texts, index, query):
    docs = texts.where("id is not null").dropDuplicates(["id"])
    path = f"{index}-{abs(hash(query))}"
    SU.build_index(docs, path, parts=4)
    reviews = spark.range(300).select(
        F.col("id").alias("review_id"), (F.col("id") * 7 % 430).alias("doc_id"), F.lit("c").alias("category"), F.lit("positive").alias("sentiment"),
        F.lit(4.0).alias("rating"), F.when(F.col("id") % 5 > 0, F.concat(F.lit("Topic one "), F.col("id") % 3)).alias("topic_label"),
        F.when(F.col("id") % 4 > 0, (F.col("id") % 10) / 10.0).alias("similarity"))
    reviews = reviews.union(reviews.limit(1).withColumn("doc_id", F.lit(None).cast("bigint")).withColumn("review_id", F.lit(999).cast("bigint")))
    scan = SR.keyword_search(reviews.join(docs.select(F.col("id").alias("doc_id"), F.col("text").alias("review_text")), "doc_id", "left"), query)
    fast = SU.keyword_search_indexed(reviews, docs.withColumnRenamed("id", "doc_id"), path, query)
    rows = lambda df: sorted((r.review_id, round(r.query_score, 9)) for r in df.collect())
    assert rows(fast) == rows(scan)


def test_empty_table(spark, tmp_dir):
    none = spark.createDataFrame([], "id bigint, text string")
    SU.build_index(none, tmp_dir)
    assert SU.containing(none, tmp_dir, ["abc"]).count() == 0
