"""C-rows on literal edge rows."""

import hashlib
import math

import pytest
from pyspark.sql import functions as F

from cartwheel.functions import scalars as S


def one(spark, expr, value, ddl="v string"):
    return spark.createDataFrame([(value,)], ddl).select(expr.alias("r")).first()["r"]


@pytest.mark.parametrize("text,expected", [
    ("₹12,999", 12999.0), ("$129.99", 129.99), (" € 1,234.50 ", 1234.5), ("£0", 0.0),
    ("1.0d", None), ("12f", None), ("", None), ("abc", None), (None, None), ("1.5E3", 1500.0),
])
def test_clean_price(spark, text, expected):
    assert one(spark, S.clean_price("v"), text) == expected


@pytest.mark.parametrize("text,expected", [
    ("4.2", 4.2), ("4.2 out of 5 stars", 4.2), ("Get", None), ("", None), ("5", 5.0), (".5", None),
])
def test_clean_rating(spark, text, expected):
    assert one(spark, S.clean_rating("v"), text) == expected


@pytest.mark.parametrize("text,expected", [("1,234", 1234), ("12.0", None), ("text", None), ("", None), ("7", 7)])
def test_clean_count(spark, text, expected):
    assert one(spark, S.clean_count("v"), text) == expected


def test_null_tokens(spark):
    rows = [(t,) for t in ["", "NA", "N/A", "null", "None", "ok"]]
    out = spark.createDataFrame(rows, "v string").select(S.null_tokens("v").alias("r")).collect()
    assert [r["r"] for r in out] == [None] * 5 + ["ok"]


def test_discount_pct_zero_list_price(spark):
    df = spark.createDataFrame([(0.0, 5.0), (200.0, 150.0)], "lp double, p double")
    out = df.select(S.discount_pct("lp", "p").alias("d"), S.savings("lp", "p").alias("s")).collect()
    assert out[0]["d"] is None and out[1]["d"] == 25.0 and out[1]["s"] == 50.0


def test_wilson_center_matches_formula(spark):
    r, n = 4.2, 250
    z2 = 1.96 ** 2
    p = r / 5.0
    expected = round((p + z2 / (2 * n)) / (1 + z2 / n), 4)
    df = spark.createDataFrame([(r, n)], "r double, n bigint")
    got = df.select(S.wilson_center("r", "n").alias("w"), S.wilson_lower("r", "n").alias("lo")).first()
    assert got["w"] == expected
    assert got["lo"] < got["w"]


def test_damped_quality_and_sentiment(spark):
    df = spark.createDataFrame([(5.0, 1), (1.0, 4), (4.0, 100)], "r double, n bigint")
    out = df.select(S.damped_quality("r", "n").alias("q"), S.rating_to_sentiment("r").alias("s"),
                    S.sentiment_label(S.rating_to_sentiment("r")).alias("l")).collect()
    assert [o["q"] for o in out] == [0.0, 1.0 / 5 * 0.5, 4.0 / 5 * 0.9]
    assert [o["s"] for o in out] == [1.0, -1.0, 0.5]
    assert [o["l"] for o in out] == ["positive", "negative", "positive"]


@pytest.mark.parametrize("score,label", [(0.18, "neutral"), (0.1801, "positive"), (-0.18, "neutral"),
                                         (-0.19, "negative")])
def test_sentiment_threshold(spark, score, label):
    assert one(spark, S.sentiment_label("v"), score, "v double") == label


def test_stable_id_matches_md5_layout(spark):
    digest = hashlib.md5(b"u1:B00X:7").hexdigest()
    expected = f"{digest[:8]}-{digest[8:12]}-{digest[12:16]}-{digest[16:20]}-{digest[20:32]}"
    df = spark.createDataFrame([("u1", "B00X", 7)], "u string, a string, o bigint")
    assert df.select(S.stable_id("u", "a", "o").alias("i")).first()["i"] == expected


def test_unicode_strip_and_lengths(spark):
    text = "   a\U0001F600b \x1c\n"
    assert one(spark, S.ustrip("v"), text) == text.strip()
    assert one(spark, S.text_length("v"), "a\U0001F600b") == 3


def test_compose_and_title_fallback(spark):
    df = spark.createDataFrame([("", "Body text here."), ("Great", "Works. "), (". Odd .", "x")], "t string, b string")
    out = df.select(S.title_fallback("t", "b", 4).alias("t2"),
                    S.compose_review_text(S.title_fallback("t", "b", 4), "b").alias("c")).collect()
    assert out[0]["t2"] == "Body"
    assert [o["c"] for o in out] == [f"{t}. {b}".strip(" .") for t, b in [("Body", "Body text here."),
                                                                        ("Great", "Works. "), (". Odd .", "x")]]


@pytest.mark.parametrize("title,family", [
    ("small ring 17", "small ring"), ("Super Blender 3000 Pro 2 4", "Super Blender 3000"),
    ("123 456", ""), ("  alpha beta gamma delta 9", "alpha beta gamma"), ("x1 2", "x1"),
])
def test_product_family(spark, title, family):
    tokens = title.split()
    while tokens and tokens[-1].isdigit():
        tokens.pop()
    assert " ".join(tokens[:3]).strip() == family
    assert one(spark, S.product_family("v"), title) == family


def test_epoch_and_iso(spark):
    df = spark.createDataFrame([("1700000000123.7",), ("0",), ("bad",)], "v string")
    out = df.select(S.epoch_ms_to_ts("v").alias("t")).collect()
    assert out[0]["t"].microsecond == 123000 and out[1]["t"].year == 1970 and out[2]["t"] is None
    iso = spark.createDataFrame([("2023-05-01T10:00:00.5+00:00",), ("nope",)], "v string")
    got = iso.select(S.iso_to_ts("v").alias("t")).collect()
    assert got[0]["t"] is not None and got[1]["t"] is None


def test_dot_and_normalize(spark):
    df = spark.createDataFrame([([3.0, 4.0], [1.0, 0.0]), ([0.0, 0.0], [1.0, 1.0])], "a array<double>, b array<double>")
    out = df.select(S.dot("a", "b").alias("d"), S.l2_normalize("a", as_float=False).alias("n")).collect()
    assert out[0]["d"] == 3.0 and out[0]["n"] == [0.6, 0.8] and out[1]["n"] == [0.0, 0.0]


def test_keyword_score(spark):
    df = spark.createDataFrame([("The battery died", "battery_life", 0.5), (None, None, None)],
                               "t string, p string, s double")
    out = df.select(S.keyword_score("t", "p", "s", ["battery", "died"]).alias("k")).collect()
    assert out[0]["k"] == 1 + 1.5 + 1 + 0.5 and out[1]["k"] == 0.0


def test_log10_clipped(spark):
    assert one(spark, S.log10_clipped("v"), 0.5, "v double") == 0.0
    assert math.isclose(one(spark, S.log10_clipped("v"), 1000.0, "v double"), 3.0)
