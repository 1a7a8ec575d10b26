"""Personal data: patterns propose spans, checksums confirm them, context words adjust the score.

Proposals are linear-time scans (no pattern can backtrack over a long text):
e-mail addresses grow outwards from each ``@``, dotted numbers are cut from
digit chains. Validators: Luhn for cards, part range for addresses, digit count
for phones, mod-97 for bank account numbers (IBAN), area rules for social
security numbers. A span's score is its kind's prior, plus what a passed
checksum adds, plus what a context word nearby adds. The four base kinds are kept
whenever their validator passes; the added kinds need ``min_score``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.common import extended, id_text, texts

BASE_KINDS = ["email", "ip", "card", "phone"]
ADDED_KINDS = ["iban", "ssn"]
KINDS = BASE_KINDS + ADDED_KINDS

# Prior score of a proposal, gain of a passed checksum, and context words (lower case) per kind.
PRIOR = {"email": 0.9, "ip": 0.6, "card": 0.4, "phone": 0.5, "iban": 0.2, "ssn": 0.3}
CHECKED = {"email": 0.0, "ip": 0.0, "card": 0.4, "phone": 0.0, "iban": 0.5, "ssn": 0.0}
CONTEXT_GAIN = 0.2
CONTEXT = {
    "email": ["email", "e-mail", "mail", "contact", "contacto", "courriel"],
    "ip": ["ip", "address", "server", "host", "adresse", "dirección"],
    "card": ["card", "visa", "mastercard", "credit", "karte", "carte", "tarjeta"],
    "phone": ["phone", "tel", "call", "mobile", "telefon", "téléphone", "teléfono"],
    "iban": ["iban", "account", "bank", "konto", "compte", "cuenta"],
    "ssn": ["ssn", "social", "security"],
}
CONTEXT_CHARS = 40  # characters looked at on either side of a span

DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
CHAIN = re.compile(r"[0-9]+(?:\.[0-9]+)*")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
SSN = re.compile(r"(?<![0-9-])([0-9]{3})-([0-9]{2})-([0-9]{4})(?![0-9-])")
DIGIT = re.compile(r"[0-9]")
# Characters of an account number by country; one of another country is a whole proposal.
IBAN_SIZES = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV",
    29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}
IBAN_SIZE = {country: n for n, found in IBAN_SIZES.items() for country in found.split()}

SPANS = "array<struct<kind:string,start:int,end:int,score:double>>"
ARROW_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()),
                                  ("score", pa.float64())]))


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def mod97(account: str) -> bool:
    """ISO 7064 check of an account number without spaces."""
    moved = account[4:] + account[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def emails(text: str) -> Iterator[tuple[int, int]]:
    end = 0
    for m in DOMAIN.finditer(text):
        at = start = m.start()
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        if start < at:
            end = m.end()
            yield start, end


def addresses(text: str) -> Iterator[tuple[int, int]]:
    for m in CHAIN.finditer(text):
        parts, at = m.group().split("."), m.start()
        for i in range(0, len(parts) - 3, 4):
            four = parts[i:i + 4]
            end = at + sum(map(len, four)) + 3
            if all(len(p := x.lstrip("0")) < 4 and int(p or 0) <= 255 for x in four):
                yield at, end
            at = end + 1


def cards(text: str) -> Iterator[tuple[int, int]]:
    for m in CARD.finditer(text):
        if len(m.group()) <= 37:  # 19 digits and 18 separators at most
            digits = re.sub("[^0-9]", "", m.group())
            if 13 <= len(digits) <= 19 and luhn(digits):
                yield m.span()


def phones(text: str) -> Iterator[tuple[int, int]]:
    for m in PHONE.finditer(text):
        if 9 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
            yield m.span()


def accounts(text: str) -> Iterator[tuple[int, int]]:
    at = 0
    while m := IBAN.search(text, at):
        ends = [i + 1 for i, c in enumerate(m.group()) if c != " "]
        size = IBAN_SIZE.get(m.group()[:2], len(ends))
        at = m.start() + 4  # another one may begin inside what this one is not
        if 15 <= size <= min(34, len(ends)):
            end = m.start() + ends[size - 1]
            # The rest of the match is what follows: words or numbers after a space.
            if (end == m.end() or text[end] == " ") and mod97(text[m.start():end].replace(" ", "")):
                yield m.start(), end
                at = end


def security_numbers(text: str) -> Iterator[tuple[int, int]]:
    for m in SSN.finditer(text):
        area, group, serial = m.groups()
        if area not in ("000", "666") and area < "900" and group != "00" and serial != "0000":
            yield m.span()


PROPOSE = {"email": emails, "ip": addresses, "card": cards, "phone": phones, "iban": accounts, "ssn": security_numbers}


def score(text: str, kind: str, start: int, end: int) -> float:
    near = f"{text[max(0, start - CONTEXT_CHARS):start]} {text[end:end + CONTEXT_CHARS]}".lower()
    found = set(re.findall(r"[\w-]+", near)).intersection(CONTEXT[kind])
    return round(min(1.0, PRIOR[kind] + CHECKED[kind] + (CONTEXT_GAIN if found else 0.0)), 3)


def spans_of(text: str | None, min_score: float) -> list[dict]:
    """Spans of one text, by kind as listed, then start (code points, end exclusive)."""
    if not text:
        return []
    digits = DIGIT.search(text) is not None
    found: list[dict] = []
    taken: list[tuple[int, int]] = []
    for kind in KINDS:
        if (kind == "email" and "@" not in text) or (kind != "email" and not digits):
            continue
        for start, end in PROPOSE[kind](text):
            s = score(text, kind, start, end)
            if kind in BASE_KINDS:
                taken.append((start, end))
            elif s < min_score or any(a < end and start < b for a, b in taken):
                continue
            found.append({"kind": kind, "start": start, "end": end, "score": s})
    return found


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       min_score: float = 0.5) -> DataFrame:
    """One row per input row: doc_id, text and its ``spans`` (kind, start, end, score).

    A map over Arrow batches: no shuffle, each text is scanned whole in its own
    task. Null and empty texts have no spans; repeated rows each get their row.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = pa.array([spans_of(t, min_score) for t in texts(batch, "text")], ARROW_SPANS)
            yield extended(batch, {"spans": spans})

    return id_text(docs, id_col, text_col).mapInArrow(run, f"doc_id bigint, text string, spans {SPANS}")


def redact(found: DataFrame) -> DataFrame:
    """``find_personal_data`` output with each span replaced by its kind in brackets (null text stays null)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, spans in zip(texts(batch, "text"), texts(batch, "spans"), strict=True):
                at, parts = 0, []
                for s in sorted(spans or [], key=lambda s: (s["start"], -s["end"])):
                    if s["start"] >= at:
                        parts += [text[at:s["start"]], f"[{s['kind']}]"]
                        at = s["end"]
                out.append(text and "".join([*parts, text[at:]]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], names=["doc_id", "text"])

    return found.select("doc_id", "text", "spans").mapInArrow(run, "doc_id bigint, text string")


def spans_text(spans: str) -> F.Column:
    """``kind:start:end`` of each span, comma-joined in the order of the array."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"),
                                                                s["end"].cast("string"))), ",")


def _is_kind(kind: str):
    return lambda span: span["kind"] == kind


def personal_data_report(docs: DataFrame) -> DataFrame:
    """Contract of ``op5_pii``: counts of the base kinds, digest of the base spans, all spans."""
    found = find_personal_data(docs).select("doc_id", "spans")
    base = F.filter("spans", lambda s: s["kind"].isin(BASE_KINDS))
    counts = [F.size(F.filter("base", _is_kind(k))).cast("bigint").alias(f"n_{k}") for k in BASE_KINDS]
    scores = F.array_join(F.transform("spans", lambda s: s["score"].cast("string")), ",")
    return (found.withColumn("base", base)
            .select("doc_id", *counts, F.sha2(spans_text("base"), 256).alias("base_sha256"),
                    spans_text("spans").alias("spans"), scores.alias("scores")))
