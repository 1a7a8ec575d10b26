"""Secret scans: patterns for known forms, and a randomness test battery for unknown ones.

Patterns give the base spans. Further candidates are long tokens with a digit; the
encoding of each is inferred from its characters (hex, base-32, base-36, base-64).
Three tests compare it with ordinary text in that alphabet: chi-squared uniformity of
its symbols, the number of runs of character classes, and the serial correlation
of neighbouring codes. Their scores combine into one p-value (how likely ordinary
text would look so random), which length-weighted Benjamini-Hochberg control over
all candidates of the corpus accepts or not: a longer token, whose tests say more,
gets more of the error budget. DataFrame and SQL functions only.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.common import staged

# Base patterns. The last two state the least length, as a shorter greedy match would be dropped whole.
ASSIGN = (r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
ASSIGN_VALUE = 6
BASE_KINDS = ["assign", "access", "hex"]
RANDOM_KIND = "random"

TOKEN = r"[A-Za-z0-9+/_-]{20,}={0,2}"
# Per inferred encoding: alphabet size, repeat rate (sum of squared frequencies) of ordinary text written in it.
ENCODINGS = {"hex": (16, 0.14), "base32": (32, 0.07), "base36": (36, 0.07), "base64": (64, 0.06)}
TEXT_CHANGES = 0.15  # class changes per character of ordinary identifiers and words
TEXT_SERIAL = 0.4  # their serial correlation
TEST_CORRELATION = 0.3  # between the three scores
UNIFORM_Z = 4.0  # a token further from uniform than this is not random, whatever its p-value
FDR = 0.01
# The Chebyshev fit erfc(x) = t exp(-x*x + P(t)), t = 1 / (1 + x/2), x >= 0.
ERFC_POLYNOMIAL = [-1.26551223, 1.00002368, 0.37409196, 0.09678418, -0.18628806, 0.27886807, -1.13520398, 1.48851587, -0.82215223, 0.17087277]
BINS_PER_DECADE, MAX_DECADES = 20, 60
BLOCK = 256  # items whose array grows item by item

SPAN = "struct<start:int,end:int,kind:string>"


def in_blocks(items: Column, state: Column, step, made: str) -> Column:
    """What ``step`` appends to the array ``made`` of ``state``, item by item, in time linear in the items.

    Appending copies the array, so a block of ``BLOCK`` items appends to an array of its own, which then joins the others as one element.
    """
    starts = F.sequence(F.lit(1), F.greatest(F.size(items), F.lit(1)), F.lit(BLOCK))
    empty = F.filter(state[made], lambda _: F.lit(False))
    start = F.struct(state.alias("state"), F.array(empty).alias("blocks"))
    both = F.transform(F.array(items), lambda held: F.aggregate(
        F.transform(starts, lambda at: F.slice(held, at, BLOCK)), start,
        lambda acc, block: F.aggregate(block, acc["state"], step, lambda s: F.struct(
            s.withField(made, empty).alias("state"), F.concat(acc["blocks"], F.array(s[made])).alias("blocks"))),
        lambda acc: F.flatten(acc["blocks"])))
    return both[0]


def located(matches: Column, pieces: Column) -> Column:
    """Start and end (code points) of each match, from the matches and the texts between them."""
    pairs = F.zip_with(F.slice(pieces, 1, F.size(matches)), matches,
                       lambda p, m: F.struct(F.char_length(p).alias("gap"), F.char_length(m).alias("len")))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("out"))

    def step(acc: Column, x: Column) -> Column:
        here = acc["at"] + x["gap"]
        span = F.struct(here.alias("start"), (here + x["len"]).alias("end"))
        return F.struct((here + x["len"]).alias("at"), F.concat(acc["out"], F.array(span)).alias("out"))

    return in_blocks(pairs, start, step, "out")


def off_base(token: Column, base: Column) -> Column:
    """Numbers (from 0) of the tokens no base span overlaps: one walk over both, by start. Tokens do not overlap each other."""
    events = F.sort_array(F.concat(
        F.transform(base, lambda b: F.struct(b["start"].alias("start"), F.lit(-1).alias("number"), b["end"].alias("end"))),
        F.transform(token, lambda c, i: F.struct(c["start"].alias("start"), i.alias("number"), c["end"].alias("end")))))
    start = F.struct(F.lit(0).alias("reach"), F.lit(0).alias("until"), F.lit(-1).alias("last"), F.array().cast("array<int>").alias("out"))

    def step(acc: Column, x: Column) -> Column:
        is_base = x["number"] < 0
        # A token is let go when the next one comes; a base span that starts before its end takes it back.
        done = F.concat(acc["out"], F.array(acc["last"]))
        clear = F.when(x["start"] >= acc["reach"], x["number"]).otherwise(-1)
        taken = F.when(x["start"] < acc["until"], F.lit(-1)).otherwise(acc["last"])
        return F.struct(F.when(is_base, F.greatest(acc["reach"], x["end"])).otherwise(acc["reach"]).alias("reach"),
                        F.when(is_base, acc["until"]).otherwise(x["end"]).alias("until"),
                        F.when(is_base, taken).otherwise(clear).alias("last"),
                        F.when(is_base, acc["out"]).otherwise(done).alias("out"))

    flush = F.array(F.struct(F.lit(2147483647).alias("start"), F.size(token).alias("number"), F.lit(2147483647).alias("end")))
    return F.filter(in_blocks(F.concat(events, flush), start, step, "out"), lambda i: i >= 0)


def with_spans(df: DataFrame, out: str, pattern: str) -> DataFrame:
    """``df`` with the matches of ``pattern`` in ``text`` (``out``_text) and their places (``out``)."""
    found = df.withColumn(f"{out}_text", F.regexp_extract_all("text", F.lit(f"({pattern})"), 0))
    some = F.size(f"{out}_text") > 0
    places = located(F.col(f"{out}_text"), F.split("text", pattern, -1))
    return found.withColumn(out, F.when(some, places).otherwise(F.array().cast("array<struct<start:int,end:int>>")))


def normal_cdf(z: Column) -> Column:
    """The normal distribution function; its relative error stays under 2e-7 in the lower tail, where the control works."""
    x = F.abs(F.greatest(F.least(z, F.lit(30.0)), F.lit(-30.0))) / math.sqrt(2)
    t = 1.0 / (1.0 + 0.5 * x)
    poly = F.lit(0.0)
    for c in reversed(ERFC_POLYNOMIAL):
        poly = poly * t + c
    tail = 0.5 * t * F.exp(poly - x * x)
    return F.when(z < 0, tail).otherwise(1.0 - tail)


def of_encoding(encoding: Column, value: dict[str, float]) -> Column:
    return F.coalesce(*[F.when(encoding == k, F.lit(float(v))) for k, v in value.items()])


def inferred_encoding(token: Column) -> Column:
    return (F.when(token.rlike("^([0-9a-f]+|[0-9A-F]+)$"), "hex").when(token.rlike("^[A-Z2-7]+=*$"), "base32")
            .when(token.rlike("^([a-z0-9]+|[A-Z0-9]+)$"), "base36").otherwise("base64"))


def let(value: Column, body) -> Column:
    """``body`` over a value that is computed once: inside a lambda nothing else keeps a repeated expression from being run again."""
    return F.transform(F.array(value), body)[0]


def battery(token: Column) -> Column:
    """Struct of a token's encoding, length, test scores (z) against ordinary text, distance from uniform, p-value."""
    return let(F.struct(token.alias("token"), inferred_encoding(token).alias("encoding"),
                        F.filter(F.split(token, ""), lambda c: c != "").alias("symbols")),
               lambda seen: let(_measures(seen), lambda m: let(_scores(m), lambda z: F.struct(
                   m["encoding"].alias("encoding"), m["n"].cast("int").alias("n"), z["chi_z"].alias("chi_z"), z["runs_z"].alias("runs_z"),
                   z["serial_z"].alias("serial_z"), z["uniform_z"].alias("uniform_z"),
                   let((z["chi_z"] + z["runs_z"] + z["serial_z"]) / math.sqrt(3 + 6 * TEST_CORRELATION), normal_cdf).alias("p")))))


def _measures(seen: Column) -> Column:
    """Sums over a token's symbols; no lambda holds an expression over the whole token but the token itself."""
    token, encoding, symbols = seen["token"], seen["encoding"], seen["symbols"]
    squares = F.aggregate(F.array_distinct(symbols), F.lit(0.0), lambda acc, c: acc + F.pow(
        (F.char_length(token) - F.char_length(F.replace(token, c, F.lit("")))).cast("double"), F.lit(2.0)))
    classes = F.regexp_replace(F.regexp_replace(F.regexp_replace(token, "[A-Z]", "U"), "[a-z]", "l"), "[0-9]", "d")
    runs = F.char_length(F.regexp_replace(classes, r"(.)\1*", "x"))
    zero = F.lit(0.0)
    # Sums of the codes, their squares and neighbours' products, in one walk.
    start = F.struct(zero.alias("before"), zero.alias("total"), zero.alias("squared"), zero.alias("products"))
    sums = F.aggregate(symbols, start, lambda acc, c: let(F.ascii(c).cast("double"), lambda v: F.struct(
        v.alias("before"), (acc["total"] + v).alias("total"), (acc["squared"] + v * v).alias("squared"),
        (acc["products"] + acc["before"] * v).alias("products"))))
    ends = F.ascii(F.element_at(symbols, 1)).cast("double") + F.ascii(F.element_at(symbols, -1)).cast("double")
    return F.struct(encoding.alias("encoding"), F.char_length(token).cast("double").alias("n"), squares.alias("squares"), runs.alias("runs"),
                    sums.alias("sums"), ends.alias("ends"), of_encoding(encoding, {k: a for k, (a, _) in ENCODINGS.items()}).alias("size"),
                    of_encoding(encoding, {k: r for k, (_, r) in ENCODINGS.items()}).alias("repeat"))


def _scores(m: Column) -> Column:
    n, size = m["n"], m["size"]
    chi = size / n * m["squares"] - n
    text_chi = size * (1 + (n - 1) * m["repeat"]) - n
    chi_z = (chi - text_chi) / F.sqrt(2 * (size - 1) + 4 * F.greatest(text_chi - size + 1, F.lit(0.0)))
    uniform_z = (chi - (size - 1)) / F.sqrt(2 * (size - 1))
    runs_z = (1 + (n - 1) * TEXT_CHANGES - m["runs"]) / F.sqrt(n * TEXT_CHANGES)
    total = m["sums"]["total"]
    mean = total / n
    spread = m["sums"]["squared"] - total * mean
    serial = (m["sums"]["products"] - mean * (2 * total - m["ends"]) + (n - 1) * mean * mean) / F.greatest(spread, F.lit(1e-9))
    serial_z = (F.when(spread > 1e-6, serial).otherwise(1.0) - TEXT_SERIAL) * F.sqrt(n)
    return F.struct(chi_z.alias("chi_z"), runs_z.alias("runs_z"), serial_z.alias("serial_z"), uniform_z.alias("uniform_z"))


def proposals(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per input row: doc_id, ``base`` spans and the ``candidates`` with their tests. Texts stay behind."""
    df = docs.select(F.col(id_col).cast("bigint").alias("doc_id"),
                     F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    df = with_spans(df, "assign", ASSIGN)
    df = df.withColumn("value", F.when(F.size("assign") > 0, F.regexp_extract_all("text", F.lit(ASSIGN), 2))
                       .otherwise(F.array().cast("array<string>")))
    for name, pattern in (("access", ACCESS), ("hex", HEX), ("token", TOKEN)):
        df = with_spans(df, name, pattern)

    def named(spans: Column, kind: str) -> Column:
        return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"),
                                                     F.lit(kind).alias("kind")))

    long = F.filter(F.zip_with("assign", "value", lambda s, v: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), F.char_length(v).alias("n"))), lambda s: s["n"] >= ASSIGN_VALUE)
    base = F.concat(named(long, "assign"), named(F.col("access"), "access"), named(F.col("hex"), "hex"))
    df = df.select("doc_id", base.alias("base"), F.filter(F.zip_with("token", "token_text", lambda s, t: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), t.alias("text"))),
        lambda c: c["text"].rlike("[0-9]")).alias("token"))
    # The tokens are bound, so that no lambda finds them again for each number.
    free = F.transform(F.array("token"), lambda held: F.transform(off_base(held, F.col("base")), lambda i: F.get(held, i)))[0]
    return df.select("doc_id", "base", F.transform(free, lambda c: F.struct(
        c["start"].alias("start"), c["end"].alias("end"), battery(c["text"]).alias("test"))).alias("candidates"))


def accepted_level(found: DataFrame, fdr: float = FDR) -> tuple[float, float]:
    """Largest weighted p-value accepted, and the mean length the weights are relative to.

    Benjamini-Hochberg over the p-values of all candidates, divided by length over
    mean length, counted in bins of the logarithm: the driver gets one row per bin,
    and a bin counts as its upper end, so the control is at least as strict.
    """
    tests = found.select(F.explode("candidates.test").alias("t")).select("t.n", "t.p", "t.uniform_z")
    m, mean = tests.agg(F.count(F.lit(1)), F.avg("n")).first()
    if not m:
        return 0.0, 1.0
    weighted = F.least(F.col("p") * mean / F.col("n"), F.lit(1.0))
    digits = F.least(-F.log10(F.greatest(weighted, F.lit(10.0 ** -MAX_DECADES))), F.lit(float(MAX_DECADES)))
    bins = (tests.where(F.col("uniform_z") <= UNIFORM_Z)
            .groupBy(F.floor(digits * BINS_PER_DECADE).cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("k")).collect())
    level, below = 0.0, 0
    for row in sorted(bins, key=lambda r: -r["bin"]):
        below += row["k"]
        upper = 10.0 ** (-row["bin"] / BINS_PER_DECADE)
        if upper <= fdr * below / m:
            level = upper
    return level, float(mean)


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", fdr: float = FDR) -> DataFrame:
    """One row per input row: doc_id and ``spans`` (start, end, kind; code points, end exclusive), by start, then kind.

    Kinds: assign, access, hex (patterns) and random (tokens the battery accepts,
    off the base spans). Null and empty texts have none; repeated rows each get
    their row. One pass over the texts writes the proposals; the accepted level
    comes from all of them.
    """
    found = staged(proposals(docs, id_col, text_col), "secrets")
    level, mean = accepted_level(found, fdr)
    random = F.filter("candidates", lambda c: (c["test"]["p"] * mean / c["test"]["n"] <= level)
                      & (c["test"]["uniform_z"] <= UNIFORM_Z))
    added = F.transform(random, lambda c: F.struct(c["start"].alias("start"), c["end"].alias("end"),
                                                   F.lit(RANDOM_KIND).alias("kind")))
    ranks = F.create_map(*[F.lit(x) for i, k in enumerate([*BASE_KINDS, RANDOM_KIND]) for x in (k, i)])
    ranked = F.transform(F.concat("base", added), lambda s: F.struct(
        s["start"].alias("start"), F.element_at(ranks, s["kind"]).alias("rank"), s["end"].alias("end"), s["kind"].alias("kind")))
    spans = F.transform(F.sort_array(ranked), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"),
                                                                s["kind"].alias("kind")))
    return found.select("doc_id", spans.alias("spans"))


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def _is_kind(kind: str):
    return lambda span: span["kind"] == kind


def secret_report(docs: DataFrame) -> DataFrame:
    """Contract of ``op4_secrets``: counts of the base kinds, digest of the base spans, all spans."""
    counts = [F.size(F.filter("spans", _is_kind(k))).cast("bigint").alias(f"n_{k}") for k in BASE_KINDS]
    base = F.filter("spans", lambda s: s["kind"] != RANDOM_KIND)
    return find_secrets(docs).select("doc_id", *counts, F.sha2(_joined(base), 256).alias("base_sha256"),
                                     _joined(F.col("spans")).alias("spans"))
