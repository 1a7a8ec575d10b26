import hashlib
import math
import random
import re
import string
import time

from pyspark.sql import functions as F

from cartwheel.llm import secret_scan as S

SF = "/root/testdata/sf0.01"
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def plain(text):
    text = text or ""
    found = [(m.start(), 0, m.end(), "assign") for m in ASSIGN.finditer(text) if len(m.group(2)) >= 6]
    found += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m.group()) >= 20]
    found += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m.group()) >= 24]
    return [f"{k}:{a}:{b}" for a, _, b, k in sorted(found)]


def check(rows, texts):
    for r, text in zip(rows, texts, strict=True):
        want = plain(text)
        assert r.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest(), text
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(w.startswith(k) for w in want) for k in S.BASE_KINDS]
        assert [s for s in r.spans.split(",") if s and not s.startswith("random")] == want


def test_documents_against_plain_patterns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = S.secret_report(docs).collect()
    assert len(rows) == len(texts) and sum(r.n_assign + r.n_access for r in rows) > 0
    check(rows, [texts[r.doc_id] for r in rows])


def test_composed_texts(spark):
    rng = random.Random(5)
    parts = ["password=", "Token: ", "api_key ='", "secret", "\"", "=", ":", " ", "é𝄞", "abc", "abcdef", "AKIA", "ABCDEFGHIJ0123456", "0123456789ab", "f" * 13,
             "\n", "token=token:abcdef", "apiKEY", "passwd"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 12))) for _ in range(600)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    check(S.secret_report(docs).orderBy("doc_id").collect(), texts)


def test_battery_tells_random_tokens_from_text(spark):
    rng = random.Random(3)
    pick = lambda alphabet, n: "".join(rng.choice(alphabet) for _ in range(n))
    b64 = string.ascii_letters + string.digits + "+/"
    secrets = [pick(b64, rng.choice([32, 40, 64])) for _ in range(60)]
    secrets = [s for s in secrets if any(c.isdigit() for c in s)]
    clean = [f"the_quick_brown_fox_{i:04d}" for i in range(200)] + [f"aaaaaaaaaaaaaaaaaaaaaaaa{i}" for i in range(100)]
    clean += [f"documentation/chapter{i}/section{i + 1}" for i in range(100)]
    texts = [f"Ä see {t} now" for t in secrets + clean]
    rows = S.secret_report(spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")).orderBy("doc_id").collect()
    hit = ["random:" in r.spans for r in rows]
    assert sum(hit[:len(secrets)]) > 0.8 * len(secrets)
    assert sum(hit[len(secrets):]) <= 0.02 * len(clean)
    first = next(i for i in range(len(secrets)) if hit[i])
    kind, a, b = rows[first].spans.split(":")
    assert texts[first][int(a):int(b)] == secrets[first]


def test_p_values_hold_in_the_tail(spark):
    zs = [z / 4 for z in range(-104, 33)]
    rows = spark.createDataFrame([(z,) for z in zs], "z double").select("z", S.normal_cdf(F.col("z")).alias("p")).collect()
    for r in rows:
        assert abs(r.p / (0.5 * math.erfc(-r.z / math.sqrt(2))) - 1) < 2e-7, r.z


def test_edges(spark):
    long = "word " * 60_000 + "password=abcdef12"
    docs = spark.createDataFrame([(1, None, "s", 2), (2, "", "s", 2), (3, "token=abcdefg", "s", 2), (3, "token=abcdefg", "s", 2),
                                  (None, "AKIA" + "A" * 16, None, None), (4, long, "", 1)], "doc_id int, text string, spans string, n_hex int")
    rows = {r.doc_id: r for r in S.secret_report(docs).collect()}
    assert S.secret_report(docs).count() == 6
    assert rows[1].spans == rows[2].spans == "" and rows[3].spans == "assign:0:13" and rows[None].spans == "access:0:20"
    assert rows[4].spans == f"assign:{len(long) - 17}:{len(long)}"
    assert S.secret_report(docs.limit(0)).count() == 0
    nodes = S.find_secrets(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in nodes and "Arrow" not in nodes


def test_very_long_tokens_stay_linear(spark):
    big = ["x1" + "a" * 300_000 + " token=" + "b" * 200_000, "f" * 300_000, "AKIA" + "Z" * 300_000, "password" + " " * 200_000 + "= abcdefgh"]
    rows = S.secret_report(spark.createDataFrame(list(enumerate(big)), "doc_id int, text string")).orderBy("doc_id").collect()
    check(rows, big)


def test_many_matches_stay_linear(spark):
    big = ["token=abcdefgh " * 40_000, "tok1" * 6 + " ", ("0123456789abcdefGHIJ01 " + "secret: zyxwvu9876 ") * 15_000, "f0" * 13 + ("-" + "e1" * 13) * 8_000]
    docs = spark.createDataFrame(list(enumerate(big)), "doc_id int, text string")
    began = time.monotonic()
    check(S.secret_report(docs).orderBy("doc_id").collect(), big)
    assert time.monotonic() - began < 60


def test_tokens_off_the_base_spans(spark):
    rng = random.Random(11)
    rows = []
    for i in range(400):
        at, tokens = 0, []
        for _ in range(rng.choice([0, 1, 5, 300])):
            at += rng.randint(0, 6)
            tokens.append((at, at := at + rng.randint(1, 5)))
        base = [(a, a + rng.randint(1, 6)) for a in (rng.randint(0, at + 5) for _ in range(rng.choice([0, 1, 40])))]
        rows.append((i, tokens, base))
    kind = "array<struct<start:int,end:int>>"
    got = spark.createDataFrame(rows, f"id int, token {kind}, base {kind}").select("id", S.off_base(F.col("token"), F.col("base")).alias("free"))
    for r in got.collect():
        _, tokens, base = rows[r.id]
        assert r.free == [j for j, (a, e) in enumerate(tokens) if not any(x < e and a < y for x, y in base)], rows[r.id]
