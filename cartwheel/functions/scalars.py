"""Scalar column expressions (cleaning, scores, ids, text shaping).

All functions take and return ``Column`` objects and stay inside the JVM
(whole-stage codegen); none of them is a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference for equal results.
# Null tokens of the product CSV reader, in the reference's order.
NULL_TOKENS = ["", "NA", "N/A", "null", "None"]
# Currency symbols removed from price text, plus comma and white space.
CURRENCY_CHARS = "₹$€£,"
# Z value of the rating score (95 % two-sided).
WILSON_Z = 1.96
# Sentiment label threshold and labels.
SENTIMENT_THRESHOLD = 0.18
SENTIMENT_LABELS = ("positive", "neutral", "negative")

# Python's str.strip()/split() white space: the Unicode White_Space set plus
# the four separator controls U+001C..U+001F. Java's (?U)\s covers the former.
_WS = r"[\s\x{1c}-\x{1f}]"
# The same set without U+001C..U+001F, as characters: what Java's (?U)\s matches.
_SPACES = "".join(map(chr, [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
_NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
_INTEGER = r"^[+-]?[0-9]+$"


def col_of(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nan_to_null(c: str | Column) -> Column:
    c = col_of(c)
    return F.when(F.isnan(c), F.lit(None)).otherwise(c)


def null_tokens(c: str | Column, tokens: list[str] = NULL_TOKENS) -> Column:
    """S3: listed tokens become null (the CSV reader takes only one nullValue)."""
    c = col_of(c)
    return F.when(c.isin(tokens), F.lit(None).cast("string")).otherwise(c)


def lenient_double(c: str | Column) -> Column:
    """Text → double; anything that is not a plain decimal number → null.

    Spark's cast accepts suffixes such as ``1.0d``; the regex refuses them (no match is the empty text, which is
    no number). The input is evaluated once.
    """
    return F.regexp_extract(col_of(c).cast("string"), _NUMBER, 0).try_cast("double")


def lenient_bigint(c: str | Column) -> Column:
    return F.regexp_extract(col_of(c).cast("string"), _INTEGER, 0).try_cast("bigint")


def ustrip(c: str | Column) -> Column:
    """Strip Unicode white space at both ends (Python ``str.strip()``)."""
    return F.regexp_replace(col_of(c), r"(?U)^" + _WS + r"+|" + _WS + r"+\z", "")


# ---- C1-C4: product cleaning -------------------------------------------------

def clean_price(c: str | Column) -> Column:
    """Drop currency symbols, commas and white space; lenient double."""
    return lenient_double(F.translate(col_of(c).cast("string"), CURRENCY_CHARS + _SPACES, ""))


def clean_rating(c: str | Column) -> Column:
    """Leading decimal number of text such as ``4.2 out of 5 stars``."""
    return F.regexp_extract(col_of(c).cast("string"), r"^([0-9]+\.?[0-9]*)", 1).try_cast("double")


def clean_count(c: str | Column) -> Column:
    """Drop commas; lenient bigint (``12.0`` → null)."""
    return lenient_bigint(F.translate(col_of(c).cast("string"), ",", ""))


def discount_pct(list_price: str | Column, price: str | Column, digits: int = 2) -> Column:
    """C4: (list − price) / list · 100, rounded; zero list price → null."""
    lp, p = col_of(list_price), col_of(price)
    return F.round(F.try_divide(lp - p, lp) * F.lit(100.0), digits)


def savings(list_price: str | Column, price: str | Column) -> Column:
    return col_of(list_price) - col_of(price)


# ---- C5-C9: scores and labels ------------------------------------------------

def wilson_center(rating: str | Column, n: str | Column, z: float = WILSON_Z, scale: float = 5.0,
                  digits: int | None = 4) -> Column:
    """The score the reference calls Wilson: centre (p + z²/2n) / (1 + z²/n), p = rating/5."""
    z2 = F.lit(z * z)
    nn = col_of(n).cast("double")
    p = col_of(rating) / F.lit(scale)
    out = (p + z2 / (F.lit(2.0) * nn)) / (F.lit(1.0) + z2 / nn)
    return F.round(out, digits) if digits is not None else out


def wilson_lower(rating: str | Column, n: str | Column, z: float = WILSON_Z, scale: float = 5.0,
                 digits: int | None = 4) -> Column:
    """Wilson lower bound: the centre minus the margin, for p = rating/5."""
    z2 = F.lit(z * z)
    nn = col_of(n).cast("double")
    p = col_of(rating) / F.lit(scale)
    margin = F.lit(z) * F.sqrt(p * (F.lit(1.0) - p) / nn + z2 / (F.lit(4.0) * nn * nn))
    out = (p + z2 / (F.lit(2.0) * nn) - margin) / (F.lit(1.0) + z2 / nn)
    return F.round(out, digits) if digits is not None else out


def clip(c: Column, lo: float, hi: float) -> Column:
    return F.least(F.greatest(c, F.lit(lo)), F.lit(hi))


def damped_quality(rating: str | Column, n: str | Column) -> Column:
    """clip(rating/5 · (1 − 1/√n), 0, 1)."""
    r, nn = col_of(rating), col_of(n).cast("double")
    return clip(r / F.lit(5.0) * (F.lit(1.0) - F.lit(1.0) / F.sqrt(nn)), 0.0, 1.0)


def rating_to_sentiment(rating: str | Column, digits: int | None = None) -> Column:
    """clip((rating − 3) / 2, −1, 1)."""
    out = clip((col_of(rating) - F.lit(3.0)) / F.lit(2.0), -1.0, 1.0)
    return F.round(out, digits) if digits is not None else out


def sentiment_label(score: str | Column, threshold: float = SENTIMENT_THRESHOLD) -> Column:
    """> t positive, < −t negative, else neutral."""
    s = col_of(score)
    return (F.when(s > F.lit(threshold), F.lit("positive"))
            .when(s < F.lit(-threshold), F.lit("negative"))
            .otherwise(F.lit("neutral")))


def log10_clipped(c: str | Column) -> Column:
    """log10(max(x, 1))."""
    return F.log10(F.greatest(col_of(c).cast("double"), F.lit(1.0)))


def count_default(c: str | Column) -> Column:
    """null rating counts shown as at least 1."""
    return F.greatest(F.coalesce(col_of(c), F.lit(1)), F.lit(1))


# ---- C10-C19: review records -------------------------------------------------

def stable_id(user: str | Column, asin: str | Column, ordinal: str | Column) -> Column:
    """md5 of ``user:asin:ordinal`` formatted 8-4-4-4-12."""
    h = F.md5(F.concat_ws(":", col_of(user).cast("string"), col_of(asin).cast("string"),
                          col_of(ordinal).cast("string")))
    return F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.substring(h, 13, 4),
                       F.substring(h, 17, 4), F.substring(h, 21, 12))


def truncate(c: str | Column, n: int | None = None) -> Column:
    """First n code points; the whole text without ``n``."""
    return col_of(c) if n is None else F.substring(col_of(c), 1, n)


def title_fallback(title: str | Column, text: str | Column, n: int = 120) -> Column:
    """Empty title → first n characters of the text."""
    t = col_of(title)
    return F.when(t.isNull() | (t == F.lit("")), truncate(text, n)).otherwise(t)


def compose_review_text(title: str | Column, body: str | Column) -> Column:
    """C14: ``"title. body"`` stripped of blanks and dots at both ends."""
    joined = F.concat(F.coalesce(col_of(title), F.lit("")), F.lit(". "), F.coalesce(col_of(body), F.lit("")))
    return F.regexp_replace(joined, r"^[ .]+|[ .]+\z", "")


def epoch_ms_to_ts(c: str | Column) -> Column:
    """Epoch milliseconds (number or numeric text) → UTC timestamp; bad → null.

    Fractions are truncated toward zero as Python's ``int()`` does.
    """
    v = lenient_double(col_of(c))
    return F.timestamp_millis(v.cast("bigint"))


def iso_to_ts(c: str | Column) -> Column:
    """ISO-8601 text (optional fraction and offset) → timestamp; bad → null."""
    return F.try_to_timestamp(col_of(c))


def month_start(c: str | Column) -> Column:
    """C17: calendar month start as a DATE."""
    return F.date_trunc("month", col_of(c)).cast("date")


def text_length(c: str | Column) -> Column:
    """Length in code points, as BIGINT."""
    return F.length(col_of(c)).cast("bigint")


# ---- C20-C21: product families and bar labels --------------------------------

def product_family(title: str | Column, max_tokens: int = 3) -> Column:
    """C20: title tokens without the trailing all-digit tokens, first ``max_tokens`` joined by a space."""
    t = ustrip(col_of(title))
    no_digits = F.regexp_replace(t, r"(?U)(^|" + _WS + r"+)\d+(" + _WS + r"+\d+)*$", "")
    tokens = F.split(no_digits, r"(?U)" + _WS + r"+")
    return ustrip(F.array_join(F.slice(tokens, 1, max_tokens), " "))


def bar_label(category: str | Column, name: str | Column, name_chars: int) -> Column:
    """``[cat] name`` with the category cut to 3 and the name to ``name_chars`` characters."""
    return F.concat(F.lit("["), F.substring(col_of(category), 1, 3), F.lit("] "),
                    F.substring(col_of(name), 1, name_chars))


# ---- C22: vectors -----------------------------------------------------------

def dot(a: str | Column, b: str | Column) -> Column:
    """Dot product of two equal-length numeric arrays, in double."""
    prods = F.zip_with(col_of(a), col_of(b), lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(prods, F.lit(0.0), lambda acc, x: acc + x)


def l2_norm(a: str | Column) -> Column:
    return F.sqrt(F.aggregate(col_of(a), F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double")))


def l2_normalize(a: str | Column, as_float: bool = True) -> Column:
    """Unit-normalise an array; the zero vector stays zero.

    The norm is bound once, as a field beside the array: an expression inside the element's lambda would be
    computed again for every element.
    """
    arr = col_of(a)
    t = "float" if as_float else "double"
    both = F.array(F.struct(arr.alias("v"), l2_norm(arr).alias("n")))
    unit = F.transform(both, lambda b: F.transform(b["v"], lambda x: F.coalesce(F.try_divide(x.cast("double"), b["n"]), F.lit(0.0)).cast(t)))
    return F.when(arr.isNotNull(), unit[0])


# ---- C24: keyword score -----------------------------------------------------

def keyword_score(text: str | Column, topic: str | Column, similarity: str | Column,
                  terms: list[str], text_weight: float = 1.0, topic_weight: float = 1.5) -> Column:
    """+1 per term found in the text, +1.5 per term in the topic label, plus similarity.

    Terms are literal substrings matched on lower-cased text; a null text or label is read as the word
    ``None``, as the reference's string conversion does.
    """
    lt = F.lower(F.coalesce(col_of(text).cast("string"), F.lit("None")))
    lp = F.lower(F.coalesce(col_of(topic).cast("string"), F.lit("None")))
    score = F.lit(0.0)
    for term in terms:
        score = score + F.when(F.contains(lt, F.lit(term)), F.lit(text_weight)).otherwise(F.lit(0.0))
        score = score + F.when(F.contains(lp, F.lit(term)), F.lit(topic_weight)).otherwise(F.lit(0.0))
    return score + F.coalesce(col_of(similarity), F.lit(0.0))
