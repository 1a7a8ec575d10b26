"""SimHash near-dedup: fingerprints linked when they differ in few bits.

Fingerprints are 64-bit majority votes over the hashes of word shingles. To find
all pairs within ``max_distance`` bits, a fingerprint is split into ``n_blocks``
blocks; by the pigeonhole principle a close pair agrees on at least
``n_blocks - max_distance`` of them, so rows are keyed by every such choice of
blocks and only rows of one key are compared. Equal fingerprints are one row
before that. Keys with many rows are cut into chunks and compared chunk against
chunk; each comparison returns a spanning forest of its links, never the pairs.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.common import batches_of, extended, staged, texts
from cartwheel.operators.components import connected_components

BITS = 64
SEED = 42
SHINGLE = 4
MAX_DISTANCE = 4
N_BLOCKS = 7  # keys of 3 blocks (27 bits or more): 35 rows a fingerprint
CHUNK = 2048  # fingerprints of one key compared at once
BATCH_BYTES = 2_000_000
SLICE = 1 << 15  # hashes turned into bits at once


def shingle_hashes(text: str | None, shingle: int = SHINGLE) -> np.ndarray:
    """XXH64 of every run of ``shingle`` words (space-joined, A-Z lower-cased), repeats included."""
    found = text.encode("utf-8", "replace").lower().split() if text else []
    if not found:
        return np.zeros(0, np.uint64)
    joined = b" ".join(found)
    ends = list(itertools.accumulate(len(w) + 1 for w in found))
    digest = xxhash.xxh64_intdigest
    if len(found) <= shingle:
        return np.array([digest(joined, SEED)], np.uint64)
    starts = [0, *ends]
    return np.fromiter((digest(joined[a:b - 1], SEED) for a, b in zip(starts, ends[shingle - 1:])), np.uint64,
                       len(found) - shingle + 1)


def fingerprints(hashes: list[np.ndarray]) -> np.ndarray:
    """Per text the bits set in over half of its hashes (none: zero)."""
    sizes = np.array([len(h) for h in hashes], np.int64)
    flat = np.concatenate([*hashes, np.zeros(0, np.uint64)])
    ends = np.cumsum(sizes)
    counts = np.zeros((len(hashes), BITS), np.int64)
    for at in range(0, len(flat), SLICE):
        part = flat[at:at + SLICE]
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        first, last = np.searchsorted(ends, [at, at + len(part) - 1], side="right")
        rows = first + np.flatnonzero(sizes[first:last + 1])
        cuts = np.maximum(ends[rows] - sizes[rows] - at, 0)
        counts[rows] += np.add.reduceat(bits, cuts, axis=0, dtype=np.int64)
    voted = (2 * counts > sizes[:, None]).astype(np.uint8)
    return np.packbits(voted, axis=1, bitorder="little").view(np.uint64).ravel()


def with_fingerprint(docs: DataFrame, text_col: str = "text", out: str = "fingerprint",
                     shingle: int = SHINGLE) -> DataFrame:
    """``docs`` with the fingerprint (bigint, the 64 bits) appended; texts without words get zero."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches_of(batches, text_col, BATCH_BYTES):
            found = fingerprints([shingle_hashes(t, shingle) for t in texts(part, text_col)])
            yield extended(part, {out: pa.array(found.view(np.int64), pa.int64())})

    kept = docs.drop(out)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema)
    return kept.mapInArrow(run, f"{schema}, `{out}` bigint")


def block_keys(fp: str, max_distance: int, n_blocks: int) -> Column:
    """All keys of a fingerprint: a choice of blocks (its number) and the bits in them."""
    if not max_distance < n_blocks <= BITS:
        raise ValueError("more blocks than differing bits are needed")
    cuts = [round(i * BITS / n_blocks) for i in range(n_blocks + 1)]
    masks = [((1 << b) - (1 << a)) for a, b in itertools.pairwise(cuts)]
    signed = lambda m: m - (1 << BITS) if m >> (BITS - 1) else m
    keys = [F.struct(F.lit(i).alias("choice"), F.col(fp).bitwiseAND(F.lit(signed(sum(c))).cast("bigint")).alias("bits"))
            for i, c in enumerate(itertools.combinations(masks, n_blocks - max_distance))]
    return F.explode(F.array(*keys))


def forest(left: np.ndarray, right: np.ndarray | None, limit: int) -> list[tuple[int, int]]:
    """Links within ``limit`` bits among ``left`` (or between both sides), thinned to a spanning forest."""
    nodes = left if right is None else np.concatenate([left, right])
    root = np.arange(len(nodes))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    links = []
    other, shift = (left, 0) if right is None else (right, len(left))
    for at in range(0, len(left), 256):
        close = np.bitwise_count(left[at:at + 256, None] ^ other[None, :]) <= limit
        a, b = np.nonzero(close)
        a, b = a + at, b + shift
        apart = root[a] != root[b]  # most links of a dense group join what is joined already
        for i, j in zip(a[apart], b[apart], strict=True):
            x, y = find(i), find(j)
            if x != y:
                root[max(x, y)] = min(x, y)
                links.append((int(nodes[i]), int(nodes[j])))
        root = root[root]
    return links


def close_in_groups(keys: np.ndarray, side: np.ndarray, fps: np.ndarray, limit: int) -> list[tuple[int, int]]:
    """Links within each run of equal keys; small runs are compared by offset, all at once."""
    links: list[tuple[int, int]] = []
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    sizes = np.diff(np.append(starts, len(keys)))
    small = np.repeat(sizes <= 64, sizes)
    for offset in range(1, min(64, int(sizes.max(initial=0)))):
        a = np.flatnonzero((keys[offset:] == keys[:-offset]) & small[offset:])
        a = a[(np.bitwise_count(fps[a] ^ fps[a + offset]) <= limit) & ((side[a] != side[a + offset]) | (side[a] == 0))]
        links += zip(fps[a].tolist(), fps[a + offset].tolist(), strict=True)
    for s, n in zip(starts[sizes > 64], sizes[sizes > 64], strict=True):
        own, sides = fps[s:s + n], side[s:s + n]
        if sides.any():  # 1 and 2: two chunks against each other
            links += forest(own[sides == 1], own[sides == 2], limit)
        else:
            links += forest(own, None, limit)
    return links


def close_links(unique: DataFrame, fp: str, max_distance: int = MAX_DISTANCE, n_blocks: int = N_BLOCKS,
                chunk: int = CHUNK) -> DataFrame:
    """Links (a, b) between distinct fingerprints whose closure is that of all pairs within ``max_distance``.

    ``unique`` is read several times: pass a written table. Groups of more than
    ``chunk`` rows are cut into chunks by a hash and every two chunks meet in a
    group of their own, so no task holds more than two chunks of a key at once
    and a group returns fewer links than it has rows.
    """
    rows = unique.select(F.col(fp).alias("fp"), block_keys(fp, max_distance, n_blocks).alias("key"))
    rows = rows.select("fp", F.col("key.choice").alias("choice"), F.col("key.bits").alias("bits"))
    large = (rows.groupBy("choice", "bits").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > chunk)
             .select("choice", "bits", F.ceil(F.col("n") / chunk).cast("int").alias("chunks")))
    cut = (rows.join(large, ["choice", "bits"], "left")
           .withColumn("chunks", F.coalesce("chunks", F.lit(1)))
           .withColumn("own", F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int"))
           .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
           .select("choice", "bits", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"),
                   F.when(F.col("own") == F.col("other"), 0).when(F.col("own") < F.col("other"), 1).otherwise(2)
                   .cast("int").alias("side"), "fp"))
    # A hash names the group; rows that share it by chance are compared too, and links are verified anyway.
    keyed = cut.select(F.xxhash64("choice", "bits", "x", "y").alias("k"), "side", "fp")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)]
        for batch in itertools.chain(batches, [None]):
            if batch is None:
                now, rest = rest, []
            else:
                own = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)]
                both = [np.concatenate([r, o.astype(r.dtype, copy=False) if r.dtype != np.uint64 else o.view(np.uint64)])
                        for r, o in zip(rest, own, strict=True)]
                if not len(both[0]):
                    continue
                # The last key may go on in the next batch.
                whole = int(np.searchsorted(both[0], both[0][-1]))
                now, rest = [x[:whole] for x in both], [x[whole:] for x in both]
            links = close_in_groups(*now, max_distance)
            flat = np.array(links, np.uint64).reshape(-1, 2).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(flat[:, 0]), pa.array(flat[:, 1])], names=["a", "b"])

    parts = max(int(unique.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    return (keyed.repartition(parts, "k").sortWithinPartitions("k", "side")
            .mapInArrow(run, "a bigint, b bigint").distinct())


def _groups(rows: DataFrame, shingle: int, max_distance: int, n_blocks: int) -> DataFrame:
    """(doc_id, mark, text) rows to (doc_id, mark, fingerprint, component_id, group); ``group`` names the component."""
    marked = staged(with_fingerprint(rows, shingle=shingle).select("doc_id", "mark", "fingerprint"), "simhash")
    unique = staged(marked.groupBy("fingerprint").agg(F.min("doc_id").alias("first")), "simhash-distinct")
    parts = connected_components(close_links(unique, "fingerprint", max_distance, n_blocks))
    linked = unique.join(parts.withColumnRenamed("node", "fingerprint"), "fingerprint", "left")
    named = linked.withColumn("group", F.coalesce("component", "fingerprint"))
    smallest = named.groupBy("group").agg(F.min("first").alias("component_id"))
    of = named.join(smallest, "group").select("fingerprint", "component_id", "group")
    return marked.join(of, "fingerprint")


def _marked(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.col(text_col).cast("string")
    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.xxhash64(text).alias("mark"), text.alias("text"))


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                max_distance: int = MAX_DISTANCE, n_blocks: int = N_BLOCKS) -> DataFrame:
    """One row per input row: doc_id, fingerprint (bigint) and component_id, the smallest doc_id reachable.

    Texts without words (null, empty) have fingerprint zero and link like any
    other. Repeated rows get their row each. A null doc_id is larger than any
    other: the component of null ids alone is null. Fingerprints are written once
    under the checkpoint folder; only distinct ones are compared.
    """
    rows = _groups(_marked(docs, id_col, text_col), shingle, max_distance, n_blocks)
    return rows.select("doc_id", "fingerprint", "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
             max_distance: int = MAX_DISTANCE, n_blocks: int = N_BLOCKS) -> DataFrame:
    """``docs`` with one row of each component: that of the smallest id (null last), then of the smallest text mark.

    Of rows that repeat id and text one stays.
    """
    rows = _groups(_marked(docs, id_col, text_col), shingle, max_distance, n_blocks)
    first = rows.groupBy("group").agg(F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "mark")).alias("keep"))
    keep = first.select(F.col("keep.doc_id").alias("__keep_id"), F.col("keep.mark").alias("__keep_mark"))
    named = docs.withColumns({"__id": F.col(id_col).cast("bigint"), "__mark": F.xxhash64(F.col(text_col).cast("string"))})
    return (named.join(keep, F.col("__id").eqNullSafe(F.col("__keep_id")) & (F.col("__mark") == F.col("__keep_mark")), "left_semi")
            .dropDuplicates(["__id", "__mark"]).select(*docs.columns))


def hex_digits(fp: str) -> Column:
    return F.lower(F.lpad(F.hex(fp), BITS // 4, "0"))


def near_dedup_report(docs: DataFrame) -> DataFrame:
    """Contract of ``op6_simhash``: doc_id, fingerprint (16 hex digits) and component_id."""
    return near_groups(docs).select("doc_id", hex_digits("fingerprint").alias("fingerprint"), "component_id")


def expected_rows(n_blocks: int = N_BLOCKS, max_distance: int = MAX_DISTANCE) -> int:
    """Keys per distinct fingerprint."""
    return math.comb(n_blocks, n_blocks - max_distance)
