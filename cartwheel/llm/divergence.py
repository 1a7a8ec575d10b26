"""Source divergence audit: how far the word use of a language's sources lies apart, over its kept terms.

Terms that few documents have are found by iceberg prefix refinement, without counting all terms. Documents are first
reduced to chunks: the distinct terms of a few thousand documents, and which documents have which. Then byte prefixes of
2, 4, 8, … bytes are counted level by level: chunks count their documents per (language, prefix), the
counts are added, and prefixes below the threshold are discarded with everything they start. Terms that
a prefix covers whole are complete and exactly counted; the rest is refined until nothing longer is left.
What survives a level goes to the chunks as a bitmap of fixed size (checksums of language and
prefix), so nothing that grows with the vocabulary is broadcast: two prefixes that share a bit cost
work at the next level, never a wrong count.

Counts per source travel as blocks of (language, bucket of terms) in arrays, are merged by key in two steps (salted
first, so that no group grows with the corpus), and a block compares all its sources in one
matrix. All arithmetic is on integers.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.llm.common import batches_of, staged

THRESHOLD = 30
SMOOTHING = 5
SCALE = 1_000_000_000
TOP_TERMS = 50
FIRST_BYTES = 2
FILTER_BITS = 1 << 23
CHUNK_BYTES = 4 << 20
BUCKET_TERMS = 4096
MERGE_PAIRS = 4_000_000
MATRIX_VALUES = 4_000_000

CHUNK = ("mark bigint, n_pairs bigint, langs array<string>, sources array<string>, doc_lang binary, doc_source binary, terms binary, term_ends binary, "
         "term_lang binary, doc_ends binary, codes binary, counts binary")
LEVEL = "lang string, prefix binary, complete boolean, n bigint"
BLOCK = "lang string, bucket int, salt int, sources array<string>, terms binary, term_ends binary, source_of binary, term_of binary, counts binary"
PARTIAL = "lang string, part string, source string, item string, value bigint"


# ---- terms -------------------------------------------------------------------

IN_TERM = np.zeros(256, bool)  # `[^\x00-\x40\x5B-\x60\x7B-\x7F]`: ASCII letters and all other bytes of UTF-8
IN_TERM[65:91] = IN_TERM[97:123] = IN_TERM[128:] = True


def split_terms(texts: pa.StringArray) -> tuple[np.ndarray, pa.Array]:
    """(row, term) of every occurrence, in order; only A-Z are lower-cased."""
    ends = np.frombuffer(texts.buffers()[1], np.int32, len(texts) + 1 + texts.offset)[texts.offset:].astype(np.int64)
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[ends[0]:ends[-1]]
    ends = ends - ends[0]
    inside = IN_TERM[data]
    before, after = np.concatenate([[False], inside[:-1]]), np.concatenate([inside[1:], [False]])
    if len(data):
        before[ends[:-1][ends[:-1] < len(data)]] = False  # terms end with their text
        after[ends[1:][ends[1:] > 0] - 1] = False
    else:
        before = after = inside
    starts, stops = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    lowered = np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)
    offsets = np.concatenate([[0], np.cumsum(stops - starts)]).astype(np.int64)
    terms = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(lowered[inside])])
    return np.searchsorted(ends, starts, "right") - 1, terms


def packed(terms: pa.Array) -> tuple[bytes, bytes]:
    """Bytes of the terms and their ends."""
    sizes = pc.binary_length(terms).to_numpy(zero_copy_only=False).astype(np.int64)
    return b"".join(terms.to_pylist()), np.cumsum(sizes).astype("<i4").tobytes()


def rows_in(batch: pa.RecordBatch | pa.Table) -> Iterator[dict]:
    """The rows one by one; binary values stay in Arrow's memory."""
    columns = [(n, pa.types.is_binary(batch.schema.field(n).type), batch.column(n)) for n in batch.schema.names]
    for i in range(batch.num_rows):
        yield {n: c[i].as_buffer() if raw else c[i].as_py() for n, raw, c in columns}


def unpacked(data: pa.Buffer | bytes, ends: pa.Buffer | bytes) -> pa.Array:
    offsets = np.concatenate([[0], np.frombuffer(ends, "<i4")]).astype(np.int64)
    return pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def ints(data: pa.Buffer | bytes) -> np.ndarray:
    return np.frombuffer(data, "<i4").astype(np.int64)


def coded(column: pa.ChunkedArray) -> tuple[np.ndarray, list[str]]:
    found = pc.fill_null(column.combine_chunks(), "").dictionary_encode()
    return found.indices.to_numpy(zero_copy_only=False).astype(np.int64), found.dictionary.to_pylist()


def chunk_of(rows: pa.Table) -> dict:
    """A chunk: distinct (language, term) entries, and for each document its entries and how often it has them."""
    doc, terms = split_terms(pc.fill_null(rows.column("text").combine_chunks(), ""))
    lang, langs = coded(rows.column("lang"))
    source, sources = coded(rows.column("source"))
    found = terms.dictionary_encode()
    width = max(len(found.dictionary), 1)
    entry, which = np.unique(lang[doc] * width + found.indices.to_numpy(zero_copy_only=False), return_inverse=True)
    pair, counts = np.unique(doc * max(len(entry), 1) + which, return_counts=True)
    data, ends = packed(found.dictionary.take(pa.array(entry % width)))
    doc_of, code = np.divmod(pair, max(len(entry), 1))
    as_bytes = lambda x: x.astype("<i4").tobytes()
    return {"n_pairs": len(pair), "langs": langs, "sources": sources, "doc_lang": as_bytes(lang), "doc_source": as_bytes(source),
            "terms": data, "term_ends": ends, "term_lang": as_bytes(entry // width),
            "doc_ends": as_bytes(np.searchsorted(doc_of, np.arange(rows.num_rows), "right")), "codes": as_bytes(code), "counts": as_bytes(counts)}


def arrow_schema(ddl: str) -> pa.Schema:
    types = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary(), "boolean": pa.bool_(),
             "array<string>": pa.list_(pa.string())}
    return pa.schema([(n, types[t]) for n, t in (c.split() for c in ddl.split(", "))])


def _chunks(chunk_bytes: int):
    schema = arrow_schema(CHUNK)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0

        def flush() -> pa.RecordBatch:
            row = chunk_of(pa.Table.from_batches(held))
            mark = zlib.crc32(row["codes"], zlib.crc32(row["terms"]))  # any number will do that a retried task repeats
            return pa.RecordBatch.from_pylist([row | {"mark": mark}], schema)

        for batch in batches_of(batches, "text", chunk_bytes):
            n = pc.sum(pc.binary_length(batch.column("text"))).as_py() or 0
            if held and (size + n > chunk_bytes or sum(b.num_rows for b in held) > 100_000):
                yield flush()
                held, size = [], 0
            held.append(batch)
            size += n
        if held:
            yield flush()
    return run


class Chunk:
    """A chunk as read back (only the columns that were read)."""

    def __init__(self, row: dict):
        self.langs, self.sources = row["langs"], row.get("sources")
        self.terms, self.term_lang = unpacked(row["terms"], row["term_ends"]), ints(row["term_lang"])
        self.doc_ends, self.codes = ints(row["doc_ends"]), ints(row["codes"])

    def docs(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.doc_ends)), np.diff(self.doc_ends, prepend=0))

    def passing(self, bits: np.ndarray, entries: np.ndarray, size: int | None) -> np.ndarray:
        """Those of the entries whose (language, first ``size`` bytes) is marked."""
        prefixes = self.terms.take(pa.array(entries))
        prefixes = (prefixes if size is None else pc.binary_slice(prefixes.cast(pa.binary()), 0, size)).dictionary_encode()
        values = prefixes.dictionary.to_pylist()
        width = max(len(values), 1)
        key, which = np.unique(self.term_lang[entries] * width + prefixes.indices.to_numpy(zero_copy_only=False), return_inverse=True)
        start = [zlib.crc32(x.encode("utf-8") + b"\x00") for x in self.langs]
        place = np.array([zlib.crc32(values[k % width], start[k // width]) for k in key.tolist()], np.int64) % (8 * len(bits))
        return entries[((bits[place >> 3] >> (place & 7).astype(np.uint8)) & 1).astype(bool)[which]]


# ---- iceberg levels ------------------------------------------------------------

def _count_prefixes(size: int, previous: int, shared):
    """mapInArrow over chunks: documents per (language, prefix of ``size`` bytes) among terms longer than ``previous``."""
    schema = arrow_schema(LEVEL)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in rows_in(batch):
                chunk = Chunk(row)
                length = pc.binary_length(chunk.terms).to_numpy(zero_copy_only=False)
                alive = np.flatnonzero(length > previous)
                if shared is not None:
                    alive = chunk.passing(np.frombuffer(shared.value, np.uint8), alive, previous)
                if not len(alive):
                    continue
                prefix = pc.binary_slice(chunk.terms.take(pa.array(alive)).cast(pa.binary()), 0, size).dictionary_encode()
                width = len(prefix.dictionary)
                key, which = np.unique((chunk.term_lang[alive] * 2 + (length[alive] <= size)) * width
                                       + prefix.indices.to_numpy(zero_copy_only=False), return_inverse=True)
                group = np.full(len(length), -1, np.int64)
                group[alive] = which
                found = group[chunk.codes]
                held = np.flatnonzero(found >= 0)
                pair = np.unique(chunk.docs()[held] * len(key) + found[held])  # a document counts once for a prefix
                n = np.bincount(pair % len(key), minlength=len(key))
                mark = key // width
                yield pa.RecordBatch.from_arrays([
                    pa.DictionaryArray.from_arrays(pa.array(mark // 2), pa.array(chunk.langs, pa.string())).cast(pa.string()),
                    prefix.dictionary.take(pa.array(key % width)), pa.array((mark % 2).astype(bool)), pa.array(n.astype(np.int64))], schema=schema)
    return run


def marks(found: DataFrame, bits: int) -> np.ndarray | None:
    """Bitmap of (lang, prefix); None if there is none. At most ``bits`` / 64 numbers come to the driver."""
    key = F.concat(F.col("lang").cast("binary"), F.unhex(F.lit("00")), F.col("prefix"))
    place = found.select((F.crc32(key) % bits).alias("_p"))
    words = place.groupBy(F.expr("_p div 64").alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(_p % 64 as int))")).alias("b")).collect()
    if not words:
        return None
    out = np.zeros(bits // 64, np.int64)
    out[[r["w"] for r in words]] = [r["b"] for r in words]
    return out.view(np.uint8)


def kept_terms(chunks: DataFrame, threshold: int = THRESHOLD, first: int = FIRST_BYTES, bits: int = FILTER_BITS) -> DataFrame:
    """(lang, term binary, n_docs) of terms in at least ``threshold`` documents of a language, by prefix refinement."""
    spark = chunks.sparkSession
    read = chunks.select("langs", "terms", "term_ends", "term_lang", "doc_ends", "codes")
    kept, size, previous, shared = None, first, 0, None
    while True:
        found = read.mapInArrow(_count_prefixes(size, previous, shared), LEVEL).groupBy("lang", "prefix", "complete").agg(F.sum("n").alias("n"))
        found = staged(found.where(F.col("n") >= threshold), f"prefixes-{size}")
        whole = found.where("complete").select("lang", F.col("prefix").alias("term"), F.col("n").alias("n_docs"))
        kept = whole if kept is None else kept.unionByName(whole)
        left = marks(found.where("not complete"), bits)
        if left is None:
            return kept
        shared = spark.sparkContext.broadcast(left.tobytes())
        size, previous = size * 2, size


# ---- counts per source -----------------------------------------------------------

def merged(sources: list[list[str]], terms: list[pa.Array], source_of: list[np.ndarray], term_of: list[np.ndarray],
           counts: list[np.ndarray]) -> tuple[list[str], pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """One block from several: its sources, terms and (source, term, count), counts added."""
    names = sorted({s for x in sources for s in x})
    number = {s: i for i, s in enumerate(names)}
    found = pa.chunked_array(terms, pa.large_binary()).combine_chunks().dictionary_encode()
    code = found.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    width = max(len(found.dictionary), 1)
    keys, at = [], 0
    for own, t, s, w in zip(sources, terms, source_of, term_of, strict=True):
        of = np.array([number[x] for x in own], np.int64)
        keys.append(of[s] * width + code[at + w])
        at += len(t)
    key, which = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.zeros(len(key), np.int64)
    np.add.at(total, which, np.concatenate(counts))
    return names, found.dictionary, key // width, key % width, total


def block_row(lang: str, bucket: int, salt: int, sources: list[str], terms: pa.Array, source_of, term_of, counts) -> dict:
    data, ends = packed(terms)
    return {"lang": lang, "bucket": bucket, "salt": salt, "sources": sources, "terms": data, "term_ends": ends,
            "source_of": source_of.astype("<i4").tobytes(), "term_of": term_of.astype("<i4").tobytes(), "counts": counts.astype("<i8").tobytes()}


def _blocks(shared, buckets: int, salts: int):
    """mapInArrow over chunks: counts per (source, marked term), a row per (language, bucket of terms)."""
    schema = arrow_schema(BLOCK)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in rows_in(batch):
                chunk = Chunk(row)
                entries = chunk.passing(np.frombuffer(shared.value, np.uint8), np.arange(len(chunk.terms)), None)
                group = np.full(len(chunk.terms), -1, np.int64)
                group[entries] = np.arange(len(entries))
                found = group[chunk.codes]
                held = np.flatnonzero(found >= 0)
                if not len(held):
                    continue
                pair = ints(row["doc_source"])[chunk.docs()[held]] * len(entries) + found[held]
                key, which = np.unique(pair, return_inverse=True)
                total = np.bincount(which, weights=ints(row["counts"])[held]).astype(np.int64)  # exact below 2⁵³
                terms = chunk.terms.take(pa.array(entries))
                home = chunk.term_lang[entries] * buckets + np.array([zlib.crc32(t) % buckets for t in terms.to_pylist()], np.int64)
                source, term = np.divmod(key, len(entries))
                order = np.argsort(home[term], kind="stable")
                edges = np.flatnonzero(np.diff(home[term[order]], prepend=-1))
                out = []
                for a, b in zip(edges, [*edges[1:], len(order)], strict=True):
                    at = order[a:b]
                    own, of = np.unique(term[at], return_inverse=True)
                    lang, bucket = divmod(int(home[own[0]]), buckets)
                    used, s = np.unique(source[at], return_inverse=True)
                    out.append(block_row(chunk.langs[lang], bucket, row["mark"] % salts, [chunk.sources[x] for x in used], terms.take(pa.array(own)),
                                         s, of, total[at]))
                for at in range(0, len(out), 64):
                    yield pa.RecordBatch.from_pylist(out[at:at + 64], schema)
    return run


def _merge(rows: pa.Table, kept: pa.Array | None = None) -> pa.Table:
    schema = arrow_schema(BLOCK)
    given = list(rows_in(rows))
    names, terms, s, t, n = merged([r["sources"] for r in given], [unpacked(r["terms"], r["term_ends"]) for r in given],
                                   [ints(r["source_of"]) for r in given], [ints(r["term_of"]) for r in given],
                                   [np.frombuffer(r["counts"], "<i8") for r in given])
    if kept is not None:  # terms that only shared a bit with a kept one go
        stay = pc.is_in(terms, kept).to_numpy(zero_copy_only=False)
        new = np.cumsum(stay) - 1
        at = stay[t]
        terms, s, t, n = terms.filter(pa.array(stay)), s[at], new[t[at]], n[at]
    return pa.Table.from_pylist([block_row(given[0]["lang"], given[0]["bucket"], 0, names, terms, s, t, n)], schema)


def _merge_kept(rows: pa.Table, kept: pa.Table) -> pa.Table:
    if not rows.num_rows or not kept.num_rows:
        return arrow_schema(BLOCK).empty_table()
    return _merge(rows, kept.column("term").combine_chunks().cast(pa.large_binary()))


def source_counts(chunks: DataFrame, kept: DataFrame, bits: int = FILTER_BITS) -> DataFrame:
    """Blocks (as BLOCK) with the exact counts of the kept terms in every source; a bucket holds about BUCKET_TERMS terms."""
    terms, pairs = kept.count(), chunks.agg(F.sum("n_pairs")).first()[0] or 0
    found = marks(kept.select("lang", F.col("term").alias("prefix")), bits)
    if found is None:
        return chunks.sparkSession.createDataFrame([], BLOCK)
    buckets = -(-terms // BUCKET_TERMS)
    salts = -(-pairs // (buckets * MERGE_PAIRS))
    shared = chunks.sparkSession.sparkContext.broadcast(found.tobytes())
    blocks = chunks.drop("n_pairs", "doc_lang").mapInArrow(_blocks(shared, buckets, salts), BLOCK)
    blocks = blocks.groupBy("lang", "bucket", "salt").applyInArrow(lambda t: _merge(t), BLOCK)
    homes = kept.select("lang", F.expr(f"cast(crc32(term) % {buckets} as int)").alias("bucket"), "term")
    return staged(blocks.groupBy("lang", "bucket").cogroup(homes.groupBy("lang", "bucket")).applyInArrow(_merge_kept, BLOCK), "source-counts")


# ---- divergence --------------------------------------------------------------------

def shares(counts: np.ndarray, divisor: np.ndarray) -> np.ndarray:
    """1 + floor(SCALE · (counts + SMOOTHING) / divisor), by long division in base 1000 (counts below 2⁵³)."""
    rest, out = counts + SMOOTHING, np.zeros(counts.shape, np.int64)
    for _ in range(3):
        digit, rest = np.divmod(rest * 1000, divisor)
        out = out * 1000 + digit
    return out + 1


def _compare(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """mapInArrow over blocks with their language's groups: summed differences per pair, best terms per source."""
    schema = arrow_schema(PARTIAL)
    for batch in rows:
        for r in rows_in(batch):
            groups = sorted(r["groups"], key=lambda g: g["source"].encode("utf-8"))
            names = [g["source"] for g in groups]
            number = {s: i for i, s in enumerate(names)}
            smooth = SMOOTHING * r["n_terms"]
            divisor = np.array([g["n"] + smooth for g in groups], np.int64)
            whole = np.int64(sum(g["n"] for g in groups) + smooth)
            terms = unpacked(r["terms"], r["term_ends"])
            of = np.array([number[s] for s in r["sources"]], np.int64)
            source, term, n = of[ints(r["source_of"])], ints(r["term_of"]), np.frombuffer(r["counts"], "<i8")
            summed = np.zeros((len(names), len(names)), np.int64)
            best: list[list[tuple[int, bytes]]] = [[] for _ in names]
            step = max(1, MATRIX_VALUES // len(names))
            for at in range(0, len(terms), step):
                width = min(step, len(terms) - at)
                mine = (term >= at) & (term < at + width)
                count = np.zeros((len(names), width), np.int64)
                count[source[mine], term[mine] - at] = n[mine]
                p = shares(count, divisor[:, None])
                q = shares(count.sum(axis=0), whole)
                for i in range(len(names) - 1):
                    summed[i, i + 1:] += np.abs(p[i + 1:] - p[i]).sum(axis=1)
                words = terms.slice(at, width).to_pylist()
                for i in range(len(names)):
                    over = np.flatnonzero((count[i] > 0) & (p[i] > q))
                    gain = p[i, over] - q[over]
                    if len(over) > TOP_TERMS:
                        high = gain >= np.partition(gain, len(gain) - TOP_TERMS)[len(gain) - TOP_TERMS]
                        over, gain = over[high], gain[high]
                    best[i] = sorted([*best[i], *((-int(g), words[k]) for g, k in zip(gain, over, strict=True))])[:TOP_TERMS]
            a, b = np.triu_indices(len(names), 1)
            out = [(r["lang"], "pair", names[i], names[j], int(summed[i, j])) for i, j in zip(a, b, strict=True)]
            out += [(r["lang"], "term", names[i], t.decode("utf-8"), -g) for i, found in enumerate(best) for g, t in found]
            for k in range(0, len(out), 10_000):
                yield pa.RecordBatch.from_pylist([dict(zip(schema.names, x, strict=True)) for x in out[k:k + 10_000]], schema)


def divergence(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", threshold: int = THRESHOLD,
               chunk_bytes: int = CHUNK_BYTES, bits: int = FILTER_BITS) -> DataFrame:
    """Rows (lang, source, part, item, value, rank): distances between the sources of a language, and each source's marked terms.

    Null text, language and source count as ''; every row is a document, also a repeated one; a language without kept
    terms has pairs of value 0 and no terms; a language with one source has no pairs; a text without separators is one term,
    however long. An empty table gives no rows. Only the named columns are read.
    """
    rows = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((text_col, "text"), (lang_col, "lang"), (source_col, "source"))])
    chunks = staged(rows.mapInArrow(_chunks(chunk_bytes), CHUNK), "term-chunks")
    kept = kept_terms(chunks, threshold, FIRST_BYTES, bits)
    blocks = source_counts(chunks, kept, bits)
    # N of a group: its counts, added block by block.
    n = blocks.mapInArrow(_totals, "lang string, source string, n bigint").groupBy("lang", "source").agg(F.sum("n").alias("n"))
    groups = staged(rows.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("n_docs")).join(n, ["lang", "source"], "left")
                    .select("lang", "source", F.coalesce("n", F.lit(0)).alias("n")), "groups")
    of_lang = groups.groupBy("lang").agg(F.collect_list(F.struct("source", "n")).alias("groups"))
    of_lang = of_lang.join(kept.groupBy("lang").agg(F.count(F.lit(1)).alias("n_terms")), "lang")
    found = staged(blocks.drop("salt").join(of_lang, "lang").mapInArrow(_compare, PARTIAL), "differences")
    summed = found.where("part = 'pair'").groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    summed = summed.unionByName(summed.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value"))
    # Every pair of a language's sources is a row of the report, whether or not the language kept a term.
    pairs = groups.select("lang", "source").join(groups.select("lang", F.col("source").alias("item")), "lang").where("source <> item")
    pairs = pairs.join(summed, ["lang", "source", "item"], "left").select("lang", "source", F.lit("pair").alias("part"), "item", F.coalesce("value", F.lit(0)).alias("value"))
    order = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), F.asc("item"))
    terms = found.where("part = 'term'").select("lang", "source", "part", "item", "value")
    ranked = lambda df: df.withColumn("rank", F.row_number().over(order))
    return ranked(pairs).unionByName(ranked(terms).where(F.col("rank") <= TOP_TERMS))


def _totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for r in rows_in(batch):
            total = np.zeros(len(r["sources"]), np.int64)
            np.add.at(total, ints(r["source_of"]), np.frombuffer(r["counts"], "<i8"))
            yield pa.RecordBatch.from_pydict({"lang": [r["lang"]] * len(total), "source": r["sources"], "n": pa.array(total)})


def divergence_report(docs: DataFrame) -> DataFrame:
    """Contract of ``op12_divergence``."""
    return divergence(docs)


REPORT_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, coalesce(text, '') AS text, coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents),
occ AS (SELECT rid, lang, source, translate(unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
               'abcdefghijklmnopqrstuvwxyz') AS term FROM d),
kept AS (SELECT lang, term FROM occ GROUP BY lang, term HAVING count(DISTINCT rid) >= 30),
v AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
grp AS (SELECT DISTINCT lang, source FROM d),
cnt AS (SELECT lang, source, term, count(*) AS c FROM occ JOIN kept USING (lang, term) GROUP BY ALL),
dense AS (SELECT g.lang, g.source, k.term, coalesce(c.c, 0) AS c FROM grp g JOIN kept k ON k.lang = g.lang
          LEFT JOIN cnt c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
p AS (SELECT dense.lang, source, term, c, 1 + (1000000000 * (CAST(c AS HUGEINT) + 5)) // (sum(c) OVER (PARTITION BY dense.lang, source) + 5 * v.v) AS p
      FROM dense JOIN v ON v.lang = dense.lang),
lc AS (SELECT lang, term, sum(c) AS c FROM dense GROUP BY lang, term),
q AS (SELECT lc.lang, term, 1 + (1000000000 * (CAST(c AS HUGEINT) + 5)) // (sum(c) OVER (PARTITION BY lc.lang) + 5 * v.v) AS q FROM lc JOIN v ON v.lang = lc.lang),
pair AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f.f, 0) AS value FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source
         LEFT JOIN (SELECT x.lang, x.source AS s, y.source AS o, sum(abs(x.p - y.p)) AS f FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term GROUP BY ALL) f
         ON f.lang = a.lang AND f.s = a.source AND f.o = b.source),
term AS (SELECT p.lang, p.source, 'term' AS part, p.term AS item, p.p - q.q AS value FROM p JOIN q ON q.lang = p.lang AND q.term = p.term WHERE c > 0 AND p.p > q.q),
r AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM (SELECT * FROM pair UNION ALL SELECT * FROM term))
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM r WHERE part = 'pair' OR rank <= 50"""
