import hashlib
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from cartwheel.llm import pii

PLAIN = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def plain(text):
    """The contract read literally: leftmost non-overlapping matches, failing ones dropped."""
    def ok(kind, m):
        digits = re.sub(r"\D", "", m)
        return {"email": True, "ip": all(int(p) <= 255 for p in m.split(".")) if kind == "ip" else True,
                "card": 13 <= len(digits) <= 19 and pii.luhn(digits),
                "phone": 9 <= len(digits) <= 15}[kind]
    return [(k, *m.span()) for k, p in PLAIN.items() for m in p.finditer(text) if ok(k, m.group())]


def base(text):
    return [(s["kind"], s["start"], s["end"]) for s in pii.spans_of(text, 0.5) if s["kind"] in pii.BASE_KINDS]


@settings(max_examples=600, deadline=None)
@given(st.text(alphabet="a@.b-1 2+()0é5", max_size=60))
def test_base_spans_equal_the_plain_patterns(text):
    assert base(text) == plain(text)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["4111 1111 1111 1111", "4111-1111-1111-1112", "1.2.3.4.5.6.7.8", "256.1.1.1", "a.b@c.d.e",
                                 "@", "+1 (202) 555-0143", "+44", " ", "x", "é", "007.08.9.255", "."]), max_size=9))
def test_base_spans_on_composed_texts(parts):
    text = "".join(parts)
    assert base(text) == plain(text)


def test_added_kinds_need_checksum_or_context():
    kinds = lambda t: [s["kind"] for s in pii.spans_of(t, 0.5)]
    assert "iban" in kinds("pay DE89 3704 0044 0532 0130 00 now")
    assert "iban" not in kinds("pay DE89 3704 0044 0532 0130 01 now")
    assert kinds("ssn 123-45-6789.") == ["ssn"]
    assert kinds("part 123-45-6789.") == []


def test_long_texts_stay_linear():
    for text in ("a" * 300_000, "1" * 300_000, "1." * 150_000, "@" * 300_000, "+" * 100_000 + "1 " * 100_000):
        pii.spans_of(text, 0.5)


def test_report_rows(spark):
    t = "mail é x.y@z.org or +1 202 555 0143, 10.0.0.1"
    docs = spark.createDataFrame([(1, t, "k", 3.0), (1, t, "k", 3.0), (2, None, None, None), (None, "", "x", 1.0)],
                                 "doc_id bigint, text string, spans string, n_email double")
    rows = sorted(pii.personal_data_report(docs).collect(), key=lambda r: (r.doc_id is None, r.doc_id))
    joined = ",".join(f"{k}:{a}:{b}" for k, a, b in plain(t))
    assert len(rows) == 4 and rows[0] == rows[1]
    assert (rows[0].n_email, rows[0].n_ip, rows[0].n_card, rows[0].n_phone) == (1, 1, 0, 1)
    assert rows[0].base_sha256 == hashlib.sha256(joined.encode()).hexdigest() and rows[0].spans == joined
    assert rows[2].spans == "" and rows[3].base_sha256 == hashlib.sha256(b"").hexdigest()
    assert pii.personal_data_report(docs.limit(0)).count() == 0
    red = pii.redact(pii.find_personal_data(docs)).where("doc_id = 1").first().text
    assert red == "mail é [email] or [phone], [ip]"


def test_accounts_end_at_their_country_s_length():
    found = lambda t: [t[s["start"]:s["end"]] for s in pii.spans_of(t, 0.5) if s["kind"] == "iban"]
    be, es, at = "BE68 5390 0754 7034", "ES91 2100 0418 4502 0005 1332", "AT61 1904 3002 3457 3201"
    for number in (be, es, at, be.replace(" ", ""), "DE89 3704 0044 0532 0130 00", "NO93 8601 1117 947"):
        for after in ("", ",", " BIC", " BIC KREDBEBB", " KREDBEBB", " 2024", " 2024 2025 2026 2027", " now"):
            assert found(f"IBAN {number}{after}") == [number], after
    assert found(f"{be} {es} {at} {be}") == [be, es, at, be]
    assert found(f"REF12 AB12 3456 7890 {be} BIC") == [be]
    assert found(f"{be}ABC") == found(f"{be}1 BIC") == found("BE68 5390 0754 7035 BIC") == []
    pii.spans_of("AB12" * 80_000 + " AB12" * 80_000, 0.5)
