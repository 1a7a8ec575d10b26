"""Substring dedup: recurring passages found by window hashes, located by sharded Aho-Corasick automata.

Documents are dealt into shards by a hash. (1) Each shard reports the hashes of its
windows (``WINDOW`` consecutive words), packed into a row per hash range. (2) Each range
finds the hashes that recur and asks the shard of the first document with one to
send those words to every other shard that has it. (3) The asked shards cut the
passages (maximal runs of such windows) out of the first documents' words, which
confirms them. (4) Each shard compiles the passages it got into Aho-Corasick automata and
streams all its documents through them. The automata's phrases are every second part of
a passage, of half a window each, so that every window holds one whole; where a phrase
occurs, document and passage are compared word by word around it, and agreements as long as a window
are removed if the passage's document has the smaller id. The texts are shuffled
once: all four steps read the same exchange.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.common import texts

WINDOW = 13
SHARD_BYTES = 2_000_000  # text of a shard, on average
RANGE_WINDOWS = 1_000_000  # windows of a hash range, on average
AUTOMATON_PHRASES = 40_000  # phrases compiled into one automaton
CODEC = "zstd"
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str | None) -> list[bytes]:
    """Words `[^\\x20\\x09-\\x0D]+`, unchanged, as UTF-8 (null: none)."""
    return text.encode("utf-8", "replace").split() if text else []


def window_hashes(docs: list[list[bytes]], window: int) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash of every window of every document, and the document's number, in order."""
    sizes = np.array([len(d) for d in docs], np.int64)
    total = int(sizes.sum())
    if total < window:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    word = np.fromiter(map(xxhash.xxh64_intdigest, itertools.chain.from_iterable(docs)), np.uint64, total)
    n = total - window + 1
    h = np.zeros(n, np.uint64)
    for j in range(window):
        h *= MULTIPLIER
        h += word[j:j + n]
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    of = np.repeat(np.arange(len(docs)), sizes)[:n]
    inside = np.arange(n) + window <= np.cumsum(sizes)[of]
    return h[inside], of[inside]


def pack(a: np.ndarray) -> bytes:
    """Numbers as compressed byte planes."""
    planes = np.ascontiguousarray(a.view(np.uint8).reshape(len(a), a.itemsize).T)
    return pa.compress(planes.tobytes(), codec=CODEC, asbytes=True)


def unpack(data: bytes, n: int, kind) -> np.ndarray:
    size = np.dtype(kind).itemsize
    raw = pa.decompress(data, decompressed_size=n * size, codec=CODEC, asbytes=True)
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(size, n).T).view(kind).ravel()


def starts_of(*keys: np.ndarray) -> np.ndarray:
    """First row of each run of rows that agree in all keys."""
    n = len(keys[0])
    new = np.zeros(n, bool)
    new[:1] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(new)


def equal_runs(*keys: np.ndarray) -> list[tuple[int, int]]:
    """[start, end) of each run of rows that agree in all keys."""
    starts = starts_of(*keys).tolist()
    return list(zip(starts, [*starts[1:], len(keys[0])][:len(starts)], strict=True))


def _by_id(table: pa.Table) -> list[tuple[int, str | None]]:
    """(doc_id, text) of the rows with an id, in order of id."""
    rows = zip(texts(table, "doc_id"), texts(table, "text"), strict=True)
    return sorted(((i, t) for i, t in rows if i is not None), key=lambda r: r[0])


# (1) shard -> rows (range, shard, n, hashes, docs, firsts): sorted hash steps, first document of each, ids, whether it recurs here
REPORT = "range int, shard int, n int, steps binary, owners binary, n_docs int, docs binary"


def _report(window: int, range_bits: int):
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        rows = _by_id(table)
        ids = np.array([i for i, _ in rows], np.int64)
        h, of = window_hashes([words_of(t) for _, t in rows], window)
        order = np.argsort(h)
        h, of = h[order], of[order]
        first = starts_of(h)
        # Documents are numbered in order of id.
        owner = np.minimum.reduceat(of, first) if len(first) else of
        here = ids[np.maximum.reduceat(of, first)] > ids[owner] if len(first) else np.zeros(0, bool)
        h = h[first]
        ranges = (h >> np.uint64(64 - range_bits)).astype(np.int64)
        out = []
        for a, b in equal_runs(ranges):
            held, code = np.unique(owner[a:b], return_inverse=True)
            out.append({"range": int(ranges[a]), "shard": key[0].as_py(), "n": int(b - a),
                        "steps": pack(np.diff(h[a:b], prepend=np.uint64(0))),
                        "owners": pack((code * 2 + here[a:b]).astype(np.uint32)),
                        "n_docs": len(held), "docs": pack(ids[held])})
        return pa.Table.from_pylist(out, schema=pa.schema([
            ("range", pa.int32()), ("shard", pa.int32()), ("n", pa.int32()), ("steps", pa.binary()), ("owners", pa.binary()),
            ("n_docs", pa.int32()), ("docs", pa.binary())]))
    return run


# (2) range -> rows (shard asked, documents, shards to send to, low 32 bits of the hashes), parallel arrays
REQUEST = "shard int, docs array<bigint>, targets array<int>, hashes array<int>"
ARROW_REQUEST = pa.schema([("shard", pa.int32()), ("docs", pa.list_(pa.int64())), ("targets", pa.list_(pa.int32())),
                           ("hashes", pa.list_(pa.int32()))])


def _request(table: pa.Table) -> pa.Table:
    h, doc, shard, here = [], [], [], []
    for r in table.to_pylist():
        h.append(np.cumsum(unpack(r["steps"], r["n"], np.uint64), dtype=np.uint64))
        code = unpack(r["owners"], r["n"], np.uint32)
        doc.append(unpack(r["docs"], r["n_docs"], np.int64)[code >> 1])
        shard.append(np.full(r["n"], r["shard"], np.int32))
        here.append((code & 1).astype(bool))
    h, doc, shard, here = (np.concatenate(x) for x in (h, doc, shard, here))
    order = np.argsort(h)
    sorted_h = h[order]
    alike = np.zeros(len(h), bool)
    alike[1:] = sorted_h[1:] == sorted_h[:-1]
    alike[:-1] |= alike[1:]
    order = order[alike | here[order]]  # most hashes occur once
    h, doc, shard, here = h[order], doc[order], shard[order], here[order]
    order = np.lexsort((doc, h))
    h, doc, shard, here = h[order], doc[order], shard[order], here[order]
    first = np.zeros(len(h), bool)
    first[starts_of(h)] = True
    owner = np.maximum.accumulate(np.where(first, np.arange(len(h)), 0))  # the entry with the smallest document
    asks = ~first | here  # other shards that have it, and the owner's own if a later document there does
    o = owner[asks]
    asked, docs, targets, low = shard[o], doc[o], shard[asks], h[asks].astype(np.uint32).view(np.int32)
    order = np.lexsort((low, targets, docs, asked))
    asked, docs, targets, low = asked[order], docs[order], targets[order], low[order]
    spans = equal_runs(asked)
    return pa.Table.from_arrays([
        pa.array([asked[a] for a, _ in spans], pa.int32()), *(pa.array([x[a:b] for a, b in spans], t.type)
                                 for x, t in zip((docs, targets, low), list(ARROW_REQUEST)[1:], strict=True))],
        schema=ARROW_REQUEST)


# (3) shard + requests -> rows (shard to send to, document, passage)
PASSAGE = "shard int, first_doc bigint, passage string"
ARROW_PASSAGE = pa.schema([("shard", pa.int32()), ("first_doc", pa.int64()), ("passage", pa.string())])


def runs_of(found: np.ndarray) -> Iterator[tuple[int, int]]:
    """[first, last] of each run of consecutive numbers."""
    cuts = np.flatnonzero(np.diff(found) != 1) + 1
    for part in np.split(found, cuts):
        if len(part):
            yield int(part[0]), int(part[-1])


def _cut(window: int):
    def run(key: tuple[pa.Scalar, ...], table: pa.Table, requests: pa.Table) -> pa.Table:
        out: tuple[list, list, list] = ([], [], [])
        if requests.num_rows:
            flat = [np.concatenate([c.flatten().to_numpy() for c in requests.column(name).chunks]) for name in ("docs", "targets", "hashes")]
            order = np.lexsort((flat[1], flat[0]))
            docs, targets, low = (x[order] for x in flat)
            asked: dict[int, list[tuple[int, np.ndarray]]] = {}
            for a, b in equal_runs(docs, targets):
                asked.setdefault(int(docs[a]), []).append((int(targets[a]), low[a:b]))
            for doc, text in _by_id(table):
                if doc in asked:
                    found = words_of(text)
                    h = window_hashes([found], window)[0].astype(np.uint32).view(np.int32)
                    for target, wanted in asked[doc]:
                        for a, b in runs_of(np.flatnonzero(np.isin(h, wanted))):
                            out[0].append(target)
                            out[1].append(doc)
                            out[2].append(b" ".join(found[a:b + window]).decode("utf-8", "replace"))
        return pa.Table.from_arrays([pa.array(x, f.type) for x, f in zip(out, ARROW_PASSAGE, strict=True)], schema=ARROW_PASSAGE)
    return run


# (4) shard + passages -> documents with what is removed
RESULT = "doc_id bigint, n_words bigint, spans array<struct<start:int,end:int>>, kept string"
ARROW_RESULT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()),
                          ("spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))), ("kept", pa.string())])


BASE = 64  # an automaton node has at most so many next letters


def spelled(codes: np.ndarray, digits: int) -> str:
    """Word numbers as a text: ``digits`` letters a word, each digit from letters of its own."""
    places = [(codes // BASE ** j) % BASE + 256 + BASE * j for j in reversed(range(digits))]
    return np.stack(places, axis=1).astype("<u4").tobytes().decode("utf-32-le")


def automata(passages: list[np.ndarray], part: int, digits: int, limit: int):
    """Automata of at most ``limit`` phrases; a phrase's value lists its places (passage, first word)."""
    places: dict[str, list[tuple[int, int]]] = {}

    def compiled() -> ahocorasick.Automaton:
        machine = ahocorasick.Automaton()
        for phrase, where in places.items():
            machine.add_word(phrase, where)
        machine.make_automaton()
        return machine

    for k, codes in enumerate(passages):
        text = spelled(codes, digits)
        for p in range(0, len(codes) - part + 1, part):
            places.setdefault(text[p * digits:(p + part) * digits], []).append((k, p))
        if len(places) >= limit:
            yield compiled()
            places = {}
    if places:
        yield compiled()


def agreements(doc: np.ndarray, passage: np.ndarray, shift: int, window: int) -> list[tuple[int, int]]:
    """[start, end) in ``doc`` of runs of at least ``window`` words equal to the passage's, ``shift`` words earlier there."""
    low, high = max(0, shift), min(len(doc), len(passage) + shift)
    differ = (doc[low:high] != passage[low - shift:high - shift]).nonzero()[0]
    if high - low - len(differ) < window:
        return []
    edge = np.empty(len(differ) + 2, np.int64)
    edge[0], edge[-1], edge[1:-1] = -1, high - low, differ
    runs = (edge[1:] - edge[:-1] > window).nonzero()[0]
    return [(low + int(edge[i]) + 1, low + int(edge[i + 1])) for i in runs]


def _locate(window: int, limit: int):
    part = (window + 1) // 2  # any window holds a whole part that starts at a multiple of it

    def run(key: tuple[pa.Scalar, ...], table: pa.Table, passages: pa.Table) -> pa.Table:
        codes: dict[bytes, int] = {}
        number = codes.setdefault
        given = list(zip(texts(passages, "first_doc"), texts(passages, "passage"), strict=True))
        firsts = [doc for doc, _ in given]
        cut = [np.array([number(w, len(codes) + 1) for w in words_of(p)], np.int64) for _, p in given]
        ids = texts(table, "doc_id")
        docs = [words_of(t) for t in texts(table, "text")]
        covers: list[np.ndarray | None] = [None] * len(docs)
        if cut:
            get = codes.get
            digits = max(1, -(-len(codes).bit_length() // 6))
            seqs = [np.array([get(w, 0) for w in d], np.int64) for d in docs]  # 0 is a word of no passage
            spelt = [spelled(s, digits) if len(s) >= window else "" for s in seqs]
            for machine in automata(cut, part, digits, limit):
                for k, doc in enumerate(ids):
                    if doc is None or not spelt[k]:
                        continue
                    met = {(p, (end + 1) // digits - part - at) for end, where in machine.iter(spelt[k])
                           for p, at in where if firsts[p] < doc}
                    for p, shift in met:
                        for a, b in agreements(seqs[k], cut[p], shift, window):
                            if covers[k] is None:
                                covers[k] = np.zeros(len(seqs[k]) + 1, np.int32)
                            covers[k][a] += 1
                            covers[k][b] -= 1
        spans, kept = [], []
        for d, cover in zip(docs, covers, strict=True):
            if cover is None:
                spans.append([])
                kept.append(b" ".join(d))
                continue
            gone = np.cumsum(cover[:-1]) > 0
            edge = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(np.int8), [0]]))).reshape(-1, 2)
            spans.append([{"start": int(a), "end": int(b)} for a, b in edge])
            kept.append(b" ".join([d[i] for i in np.flatnonzero(~gone)]))
        return pa.Table.from_arrays([
            table.column("doc_id").cast(pa.int64()), pa.array([len(d) for d in docs], pa.int64()),
            pa.array(spans, ARROW_RESULT.field("spans").type),
            pa.array([k.decode("utf-8", "replace") for k in kept], pa.string())], schema=ARROW_RESULT)
    return run


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                   shard_bytes: int = SHARD_BYTES, range_windows: int = RANGE_WINDOWS,
                   automaton_phrases: int = AUTOMATON_PHRASES) -> DataFrame:
    """One row per input row: doc_id, n_words, removed spans (word positions, end exclusive) and the kept text.

    A word goes if a window over it also starts in a document with a smaller id.
    Null and empty texts have no words; rows that share an id never remove each
    other's words; a row without id neither removes nor loses any. Shards hold
    about ``shard_bytes`` of text (a longer text is a shard's one large row), hash
    ranges about ``range_windows`` windows; automata are compiled in parts. A
    passage that many documents share is reported once per shard, not once per
    document, and cut out of its first document only.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(-(-size // shard_bytes), int(spark.conf.get("spark.sql.shuffle.partitions")))
    range_bits = min(24, max(4, (size // 5 // range_windows).bit_length()))
    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("doc_id", "text"), F.lit(shards)).cast("int"))
    by_shard = dealt.groupBy("shard")
    reports = by_shard.applyInArrow(_report(window, range_bits), REPORT)
    requests = reports.groupBy("range").applyInArrow(_request, REQUEST)
    passages = by_shard.cogroup(requests.groupBy("shard")).applyInArrow(_cut(window), PASSAGE)
    return by_shard.cogroup(passages.groupBy("shard")).applyInArrow(_locate(window, automaton_phrases), RESULT)


def repeats_report(docs: DataFrame) -> DataFrame:
    """Contract of ``op10_phrases``: doc_id, n_words, n_removed, digest of the kept words."""
    gone = F.aggregate("spans", F.lit(0).cast("bigint"), lambda acc, s: acc + (s["end"] - s["start"]))
    return remove_repeats(docs).select("doc_id", "n_words", gone.alias("n_removed"), F.sha2("kept", 256).alias("kept_sha256"))


REPORT_SQL = r"""
WITH d AS (SELECT doc_id, row_number() OVER () AS rid, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
places AS (SELECT rid, doc_id, i, array_to_string(w[i:i + 12], ' ') AS phrase
           FROM (SELECT rid, doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d WHERE len(w) >= 13)),
firsts AS (SELECT phrase, min(doc_id) AS first_doc FROM places GROUP BY phrase HAVING min(doc_id) < max(doc_id)),
gone AS (SELECT DISTINCT rid, unnest(range(i, i + 13)) AS k FROM places JOIN firsts USING (phrase) WHERE first_doc < doc_id),
lost AS (SELECT rid, list(k) AS ks FROM gone GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(len(ks), 0) AS BIGINT) AS n_removed,
       sha256(array_to_string(CASE WHEN ks IS NULL THEN w ELSE list_filter(w, lambda x, i: NOT list_contains(ks, i)) END, ' ')) AS kept_sha256
FROM d LEFT JOIN lost USING (rid)"""
