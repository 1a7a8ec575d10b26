"""Benchmark decontamination: an FM-index per training shard, searched backwards for every test phrase.

Documents are read as words; a task gathers whole documents into shards of about
``SHARD_WORDS`` words. Each shard's words (those the benchmark knows; any other
word is a separator no phrase can cross) are suffix-sorted, their
Burrows-Wheeler transform goes into a wavelet matrix, and all phrases of the
benchmark walk backwards through its ranks at once. Occurrences are located by
stepping to sampled suffix positions and merged into removal spans.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.common import batches_of, extended, staged, texts

SHARD_WORDS = 1_000_000  # words indexed at once in a task
SHARD_BYTES = 8_000_000  # text gathered at once in a task
BLOCK_WORDS = 2_000_000  # benchmark words searched in one pass over the documents
SAMPLE = 16  # every so many suffix positions are kept for locating
WINDOW = 10

# A-Z in lower case; ASCII signs other than letters and digits part words.
FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c > 127 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))
NOT_WORD = rb"[\x00-\x2F\x3A-\x60\x7B-\x7F]"


def words_of(text: str | None) -> list[bytes]:
    """Words `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` after lower-casing A-Z, as UTF-8 (null: none)."""
    return text.encode("utf-8", "replace").translate(FOLD).split() if text else []


# ---- phrases ---------------------------------------------------------------

class Phrases:
    """Distinct windows of a block of benchmark items, by length, over a vocabulary of word numbers (from 1)."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int = WINDOW):
        self.vocabulary: dict[bytes, int] = {}
        number = self.vocabulary.setdefault
        owners: dict[tuple[int, ...], set[str]] = {}
        for item, found in items:
            seq = [number(w, len(self.vocabulary) + 1) for w in found]
            for i in range(max(len(seq) - window, 0) + 1):
                if piece := tuple(seq[i:i + window]):
                    owners.setdefault(piece, set()).add(item)
        keys = sorted(owners, key=lambda p: (len(p), p))
        self.owners = [sorted(owners[k]) for k in keys]
        self.groups = []  # (first phrase number, phrases as rows of word numbers)
        start = 0
        for size in sorted({len(k) for k in keys}):
            rows = [k for k in keys if len(k) == size]
            self.groups.append((start, np.array(rows, np.int32).reshape(-1, size)))
            start += len(rows)


# ---- the index -------------------------------------------------------------

def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Suffixes in order; 0 is a separator that ends a suffix, equal ones order by position.

    The last symbol must be 0. Sorts by four symbols, then doubles the compared
    length for suffixes that are still tied.
    """
    n = len(symbols)
    bits = max(int(symbols.max()).bit_length(), 1)
    step = max(1, min(4, 60 // bits))
    key = symbols.astype(np.int64)
    open_ = symbols > 0  # no separator so far
    for j in range(1, step):
        shifted = np.zeros(n, np.int64)
        shifted[:max(n - j, 0)] = symbols[j:]
        key = (key << bits) | np.where(open_, shifted, 0)
        open_ &= shifted > 0
    order = np.argsort(key, kind="stable")
    sorted_key = key[order]
    first = np.concatenate([[True], sorted_key[1:] != sorted_key[:-1]])
    group = np.maximum.accumulate(np.where(first, np.arange(n), 0))
    ended = ~open_[order]
    group = np.where(ended, np.arange(n), group)  # ties that met a separator are settled by position
    rank = np.empty(n, np.int64)
    rank[order] = group
    while True:
        same = group[1:] == group[:-1]
        tied = np.flatnonzero(np.concatenate([same, [False]]) | np.concatenate([[False], same]))
        if not len(tied):
            return order
        at = order[tied]
        follow = rank[at + step]
        sub = np.lexsort((follow, group[tied]))
        order[tied] = at[sub]
        old, follow = group[tied], follow[sub]
        fresh = np.concatenate([[True], (old[1:] != old[:-1]) | (follow[1:] != follow[:-1])])
        group[tied] = np.maximum.accumulate(np.where(fresh, tied, 0))
        rank[order[tied]] = group[tied]
        step *= 2


class BitRank:
    """Bits with ranks: 64-bit words and the ones before each."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros(-(-(len(bits) + 1) // 64) * 64, np.uint8)
        padded[:len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        counts = np.bitwise_count(self.words).astype(np.int64)
        self.before = np.concatenate([[0], np.cumsum(counts)[:-1]])
        self.zeros = len(bits) - int(counts.sum())

    def ones(self, i: np.ndarray) -> np.ndarray:
        """Ones among the first ``i`` bits."""
        mask = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[i >> 6] + np.bitwise_count(self.words[i >> 6] & mask)

    def at(self, i: np.ndarray) -> np.ndarray:
        return (self.words[i >> 6] >> (i & 63).astype(np.uint64)) & np.uint64(1)


class WaveletMatrix:
    """Ranks and access of a sequence over 2**bits symbols, one bit plane a level."""

    def __init__(self, seq: np.ndarray, bits: int):
        self.levels = []
        self.bits = bits
        for level in reversed(range(bits)):
            plane = ((seq >> level) & 1).astype(np.uint8)
            self.levels.append(BitRank(plane))
            seq = np.concatenate([seq[plane == 0], seq[plane == 1]])
        symbols = np.arange(1 << bits)
        self.base = self._walk(symbols, np.zeros(1 << bits, np.int64))  # where each symbol's run starts

    def _walk(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        for k, plane in enumerate(self.levels):
            ones = plane.ones(i)
            i = np.where((symbol >> (self.bits - 1 - k)) & 1, plane.zeros + ones, i - ones)
        return i

    def rank(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """Occurrences of ``symbol`` before ``i``."""
        return self._walk(symbol, i) - self.base[symbol]

    def access(self, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at ``i`` and its rank there."""
        symbol = np.zeros(len(i), np.int64)
        for plane in self.levels:
            bit, ones = plane.at(i).astype(np.int64), plane.ones(i)
            symbol = symbol * 2 + bit
            i = np.where(bit, plane.zeros + ones, i - ones)
        return symbol, i - self.base[symbol]


class FMIndex:
    """Backward search and locate over a word sequence with separators (0)."""

    def __init__(self, symbols: np.ndarray, sample: int = SAMPLE):
        symbols = np.concatenate([symbols, [0]]).astype(np.int64)
        order = suffix_array(symbols)
        self.n = len(symbols)
        bits = max(int(symbols.max()).bit_length(), 1)
        before = symbols[order - 1]  # position 0 wraps to the closing separator
        self.wavelet = WaveletMatrix(before, bits)
        self.less = np.concatenate([[0], np.cumsum(np.bincount(symbols, minlength=1 << bits))])
        # Sampled: every ``sample``-th position, and the start of each run, so no walk crosses a separator.
        kept = (order % sample == 0) | (before == 0)
        self.kept = BitRank(kept.astype(np.uint8))
        self.positions = order[kept]

    def search(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix interval [low, high) of each phrase (rows of word numbers, all of one length)."""
        low, high = np.zeros(len(rows), np.int64), np.full(len(rows), self.n)
        live = np.arange(len(rows))
        for j in reversed(range(rows.shape[1])):
            c = rows[live, j].astype(np.int64)
            inside = c < len(self.less) - 1
            live, c = live[inside], c[inside]
            lo = self.less[c] + self.wavelet.rank(c, low[live])
            hi = self.less[c] + self.wavelet.rank(c, high[live])
            found = hi > lo
            dead = np.ones(len(rows), bool)
            dead[live[found]] = False
            live = live[found]
            low[live], high[live] = lo[found], hi[found]
            low[dead] = high[dead] = 0
        return low, high

    def locate(self, at: np.ndarray) -> np.ndarray:
        """Text position of each suffix: step back until a sampled one, then add the steps."""
        out, steps, todo = np.empty(len(at), np.int64), np.zeros(len(at), np.int64), np.arange(len(at))
        at = at.copy()
        while len(todo):
            hit = self.kept.at(at[todo]).astype(bool)
            done = todo[hit]
            out[done] = self.positions[self.kept.ones(at[done])] + steps[done]
            todo = todo[~hit]
            symbol, rank = self.wavelet.access(at[todo])
            at[todo] = self.less[symbol] + rank
            steps[todo] += 1
        return out


# ---- documents -------------------------------------------------------------

def search_shard(docs: list[list[bytes]], phrases: Phrases) -> list[tuple[np.ndarray, list[str]]]:
    """Per document: merged removal spans (rows of first word, word after the last) and items found."""
    number = phrases.vocabulary.get
    symbols = np.array([number(w, 0) for d in docs for w in [*d, b""]], np.int64)
    result: list[tuple[np.ndarray, list[str]]] = [(np.empty((0, 2), np.int64), []) for _ in docs]
    if not symbols.any():
        return result
    index = FMIndex(symbols)
    starts = np.concatenate([[0], np.cumsum([len(d) + 1 for d in docs])])
    cover = np.zeros(len(symbols) + 1, np.int32)
    items: dict[int, set[str]] = {}
    for first, rows in phrases.groups:
        low, high = index.search(rows)
        hits = high - low
        which = np.repeat(np.arange(len(rows)), hits)
        if not len(which):
            continue
        at = np.arange(len(which)) - np.repeat(np.cumsum(hits) - hits, hits) + np.repeat(low, hits)
        position = index.locate(at)
        np.add.at(cover, position, 1)
        np.add.at(cover, position + rows.shape[1], -1)
        of = np.searchsorted(starts, position, side="right") - 1
        for doc, phrase in np.unique(np.stack([of, which + first], 1), axis=0):
            items.setdefault(int(doc), set()).update(phrases.owners[phrase])
    covered = np.cumsum(cover[:-1]) > 0
    edge = np.flatnonzero(np.diff(np.concatenate([[0], covered.astype(np.int8), [0]]))).reshape(-1, 2)
    of = np.searchsorted(starts, edge[:, 0], side="right") - 1
    for doc, found in items.items():
        result[doc] = (edge[of == doc] - starts[doc], sorted(found))
    return result


def merged(old: list[dict] | None, new: np.ndarray) -> list[dict]:
    """Union of the spans found by earlier blocks and by this one."""
    out: list[dict] = []
    for start, end in sorted([(s["start"], s["end"]) for s in old or []] + [(int(a), int(b)) for a, b in new]):
        if out and start <= out[-1]["end"]:
            out[-1]["end"] = max(end, out[-1]["end"])
        else:
            out.append({"start": start, "end": end})
    return out


SPANS = "array<struct<start:int,end:int>>"
ARROW_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


def _pass(phrases, text_col: str, names: tuple[str, str, str], merge: bool):
    """One map over Arrow batches: whole documents gathered into shards, indexed and searched."""
    n_words, spans, items = names

    def flush(parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs = [[words_of(t) for t in texts(p, text_col)] for p in parts]
        found = iter(search_shard([d for p in docs for d in p], phrases.value))
        for part, own in zip(parts, docs, strict=True):
            rows = [next(found) for _ in own]
            old_spans = texts(part, spans) if merge else [None] * len(rows)
            old_items = texts(part, items) if merge else [None] * len(rows)
            if merge:
                part = part.drop_columns([n_words, spans, items])
            yield extended(part, {
                n_words: pa.array([len(d) for d in own], pa.int64()),
                spans: pa.array([merged(o, s) for o, (s, _) in zip(old_spans, rows, strict=True)], ARROW_SPANS),
                items: pa.array([sorted({*(o or []), *i}) for o, (_, i) in zip(old_items, rows, strict=True)],
                                pa.list_(pa.string()))})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for part in batches_of(batches, text_col, SHARD_BYTES // 4):
            held.append(part)
            size += part.column(part.schema.get_field_index(text_col)).nbytes
            if size >= SHARD_BYTES:
                yield from flush(held)
                held, size = [], 0
        if held:
            yield from flush(held)

    return run


def blocks_of(benchmark: DataFrame, item_col: str, text_col: str, limit: int) -> Iterator[list[tuple[str, list[bytes]]]]:
    """The benchmark in blocks of at most ``limit`` words (an item at least), streamed through the driver."""
    rows = benchmark.select(F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("item"),
                            F.col(text_col).cast("string").alias("text")).distinct()
    block, held = [], 0
    for r in rows.toLocalIterator():
        found = words_of(r["text"])
        if block and held + len(found) > limit:
            yield block
            block, held = [], 0
        if found:
            block.append((r["item"], found))
            held += len(found)
    if block:
        yield block


def find_benchmark(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
                   item_text_col: str = "text", window: int = WINDOW, block_words: int = BLOCK_WORDS,
                   names: tuple[str, str, str] = ("n_words", "spans", "items")) -> DataFrame:
    """``docs`` with word count, removal spans (word positions, end exclusive) and found items appended.

    One row per input row; null and empty texts have no words and no spans, an
    item without words has no windows, and items that repeat count once. The
    benchmark is the stated query set: it is searched in blocks of at most
    ``block_words`` words, each block broadcast for one pass over the documents
    (nothing is shuffled); passes after the first start from the written result
    of the one before. Columns called ``names`` in ``docs`` are replaced.
    """
    n_words, spans, items = names
    kept = docs.drop(*names)
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema),
                        f"`{n_words}` bigint", f"`{spans}` {SPANS}", f"`{items}` array<string>"])
    out, sc = None, docs.sparkSession.sparkContext
    shared = None
    for block in blocks_of(benchmark, item_col, item_text_col, block_words):
        if out is not None:
            out = staged(out, "benchmark-block")
            shared.destroy()
        shared = sc.broadcast(Phrases(block, window))
        source = kept if out is None else out
        out = source.mapInArrow(_pass(shared, text_col, names, out is not None), schema)
    if out is None:
        out = kept.mapInArrow(_pass(sc.broadcast(Phrases([], window)), text_col, names, False), schema)
    return out


def decontaminated_text(text: str | None, spans: list[dict]) -> str | None:
    """The text without the words of the spans (characters from the first word's start to the last one's end)."""
    if not spans or not text:
        return text
    flat = np.frombuffer(text.encode("utf-8", "replace").translate(FOLD), np.uint8) != 32
    edge = np.flatnonzero(np.diff(np.concatenate([[0], flat.astype(np.int8), [0]]))).reshape(-1, 2)
    raw, at, parts = text.encode("utf-8", "replace"), 0, []
    for s in spans:
        parts.append(raw[at:edge[s["start"], 0]])
        at = edge[s["end"] - 1, 1]
    return b"".join([*parts, raw[at:]]).decode("utf-8")


def remove_benchmark(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """``docs`` with the benchmark's passages cut out of ``text_col``; documents that were nothing else are dropped."""
    names = ("__n_words", "__spans", "__items")
    found = find_benchmark(docs, benchmark, text_col, names=names, **options)
    left = F.aggregate("__spans", F.col("__n_words"), lambda acc, s: acc - (s["end"] - s["start"]))
    found = found.where((F.size("__spans") == 0) | (left > 0)).drop("__n_words", "__items")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(text_col)
            cut = [decontaminated_text(t, s) for t, s in zip(texts(batch, text_col), texts(batch, "__spans"), strict=True)]
            columns = [pa.array(cut, pa.string()) if i == at else c for i, c in enumerate(batch.columns)][:-1]
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names[:-1])

    kept = found.drop("__spans")
    return found.mapInArrow(run, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema))


def decontamination_report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Contract of ``op1_decontaminate``: per document words, hit words, items found and whether any."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = find_benchmark(rows, benchmark)
    hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda acc, s: acc + (s["end"] - s["start"]))
    return found.select("doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("bigint").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (hit > 0).alias("contaminated"))


REPORT_SQL = r"""
WITH d AS (SELECT doc_id, row_number() OVER () AS rid, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
windows AS (SELECT DISTINCT item, least(len(w), 10) AS size, array_to_string(w[i:i + 9], ' ') AS phrase
            FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT size FROM windows),
places AS (SELECT rid, size, i, array_to_string(w[i:i + size - 1], ' ') AS phrase
           FROM (SELECT rid, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM d, sizes WHERE len(w) >= size)),
hits AS (SELECT p.rid, p.i, p.size, x.item FROM places p JOIN windows x USING (size, phrase)),
covered AS (SELECT rid, count(DISTINCT k) AS n_hit FROM (SELECT rid, unnest(range(i, i + size)) AS k FROM hits) GROUP BY rid),
found AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT rid, item FROM hits) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (rid) LEFT JOIN found USING (rid)"""


def items_digest(items: list[str]) -> str:
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
