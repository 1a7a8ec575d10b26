"""Literal substring search through a trigram index.

The index is a Parquet table of postings (trigram, ids of a block of texts that hold it), partitioned by a hash of the trigram
and sorted by it, and a table of trigram counts. A task cuts a block of texts at once, with NumPy on their code points, so what is
shuffled is a row per trigram and block and not one per trigram and text. A term is looked up by its rarest trigrams: their postings, read from a few folders and row groups,
are intersected by counting, and what is left is verified on the text. Terms shorter than a trigram have no posting to go by,
and the texts are scanned for them.

Texts are lower-cased and a null text is read as ``None``, as the keyword search reads it. Ids are keys: rows that repeat an id
are found if any of them holds the trigrams and are verified one by one. Rows with a null id are always verified.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.functions import scalars as S
from cartwheel.operators.filters import filter_reviews
from cartwheel.operators.search import query_terms

GRAM = 3
PARTS = 64  # folders of the postings
PROBES = 4  # rarest trigrams of a term that are intersected
BLOCK_BYTES = 4 << 20  # of the texts cut at once


def searched(text: str | Column) -> Column:
    """The text as terms are matched on it."""
    return F.lower(F.coalesce(S.col_of(text).cast("string"), F.lit("None")))


def grams(text: Column) -> Column:
    """Distinct trigrams (code points) of a text, in time linear in its length."""
    pick = lambda c: F.transform(F.sequence(F.lit(0), F.size(c) - GRAM), lambda i: F.concat(*[c[i + j] for j in range(GRAM)]))
    bound = F.transform(F.array(F.split(text, "")), lambda c: F.array_distinct(pick(c)))  # the characters are split once
    return F.when(F.char_length(text) >= GRAM, bound[0]).otherwise(F.array().cast("array<string>"))


def part_of(gram: Column, parts: int) -> Column:
    return F.pmod(F.xxhash64(gram), F.lit(parts)).cast("int")


def _lettered(points: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """The different code points, each one's number, and the bits such a number takes."""
    seen = np.zeros(int(points.max(initial=0)) + 1, bool)
    seen[points] = True
    letters = np.flatnonzero(seen)
    return letters, np.cumsum(seen, dtype=np.int64) - 1, max(len(letters) - 1, 1).bit_length()


def _pairs(points: np.ndarray, sizes: np.ndarray):
    """Distinct (trigram, text) of texts given by their code points, by trigram: (characters of the trigrams, first pair of each, texts)."""
    letters, number, bits = _lettered(points)
    shift = (len(sizes) - 1).bit_length()
    letter = number[points]
    pair = np.repeat(np.arange(len(sizes)), sizes)
    row = pair[:max(len(pair) - GRAM + 1, 0)]
    whole = row == pair[GRAM - 1:]  # not across two texts
    pair = np.zeros(len(row), np.int64)
    for j in range(GRAM):
        pair = pair << bits | letter[j:j + len(row)]
    pair = (pair << shift | row)[whole]
    pair.sort()
    pair = pair[np.concatenate([[True], pair[1:] != pair[:-1]])[:len(pair)]]
    gram = pair >> shift
    first = np.flatnonzero(np.concatenate([[True], gram[1:] != gram[:-1]])[:len(gram)])
    held = gram[first]
    chars = np.stack([letters[held >> bits * j & (1 << bits) - 1] for j in reversed(range(GRAM))], axis=1)
    return chars, first, pair & (1 << shift) - 1


def _blocks(texts) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(start, end, code points, sizes) of runs of texts: of ``BLOCK_BYTES`` or one text, and with pairs that 63 bits can number."""
    import pyarrow.compute as pc

    total = np.concatenate([[0], np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False), dtype=np.int64)])
    sizes = pc.utf8_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
    start = 0
    while start < len(texts):
        end = max(start + 1, int(np.searchsorted(total, total[start] + BLOCK_BYTES, "right")) - 1)
        points = np.frombuffer("".join(texts.slice(start, end - start).to_pylist()).encode("utf-32-le"), "<u4")
        bits = _lettered(points)[2]
        while end > start + 1 and GRAM * bits + (end - start - 1).bit_length() > 63:
            end = start + (end - start) // 2
        part = sizes[start:end]
        yield start, end, points[:part.sum()], part
        start = end


def _cut(batches):
    """mapInArrow: (id, text) to (gram, n, ids), a row per trigram and block of texts."""
    import pyarrow as pa

    for rb in batches:
        ids, texts = rb.column("id"), rb.column("text")
        for start, end, points, sizes in _blocks(texts):
            chars, first, row = _pairs(points, sizes)
            if not len(first):
                continue
            said = np.ascontiguousarray(chars, "<u4").tobytes().decode("utf-32-le")
            bounds = np.append(first, len(row))
            lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), ids.slice(start, end - start).take(pa.array(row)))
            yield pa.RecordBatch.from_arrays([pa.array([said[i:i + GRAM] for i in range(0, len(said), GRAM)], pa.string()),
                                              pa.array(np.diff(bounds), pa.int64()), lists], names=["gram", "n", "ids"])


def build_index(df: DataFrame, path: str, key: str = "id", text: str = "text", parts: int = PARTS) -> None:
    """Postings to ``path/postings`` and counts to ``path/counts``; a common trigram's folder is cut into several files."""
    texts = df.where(F.col(key).isNotNull()).select(F.col(key).alias("id"), searched(text).alias("text"))
    rows = texts.mapInArrow(_cut, f"gram string, n bigint, ids array<{df.schema[key].dataType.simpleString()}>")
    rows = rows.withColumn("part", part_of(F.col("gram"), parts)).hint("rebalance", "part")
    rows.sortWithinPartitions("part", "gram").write.partitionBy("part").parquet(f"{path}/postings")
    held = df.sparkSession.read.schema(rows.schema).parquet(f"{path}/postings")
    counts = held.groupBy("part", "gram").agg(F.sum("n").alias("n"))
    counts.sortWithinPartitions("gram").withColumn("parts", F.lit(parts)).write.parquet(f"{path}/counts")


def postings(spark: SparkSession, path: str, term: str, kind: str = "bigint", probes: int = PROBES) -> DataFrame | None:
    """Ids (of the type ``kind``) whose texts hold the term's rarest trigrams; None for a term shorter than a trigram."""
    wanted = sorted({term[i:i + GRAM] for i in range(len(term) - GRAM + 1)})
    if not wanted:
        return None
    known = spark.read.parquet(f"{path}/counts").where(F.col("gram").isin(wanted)).collect()  # at most a row for each trigram of the term
    rarest = sorted(known, key=lambda r: (r.n, r.gram))[:probes]
    table = spark.read.schema(f"gram string, ids array<{kind}>, part int").parquet(f"{path}/postings")
    if len(known) < len(wanted):  # some trigram of the term is in no text
        return table.where(F.lit(False)).select(F.explode("ids").alias("id"))
    hit = table.where(F.col("part").isin(sorted({r.part for r in rarest})) & F.col("gram").isin([r.gram for r in rarest]))
    # A (trigram, id) pair repeats only where rows repeat an id.
    return hit.select("gram", F.explode("ids").alias("id")).groupBy("id").agg(F.count_distinct("gram").alias("n")).where(F.col("n") == len(rarest)).select("id")


def containing(df: DataFrame, path: str, terms: list[str], key: str = "id", text: str = "text", probes: int = PROBES) -> DataFrame:
    """Rows of ``df`` that contain any of the terms (F8's literal substrings), through the index of ``df``."""
    terms = sorted({t.lower() for t in terms if t})
    if not terms:
        return df
    holds = reduce(lambda a, b: a | b, [F.contains(searched(text), F.lit(t)) for t in terms])
    kind = df.schema[key].dataType.simpleString()
    found = [postings(df.sparkSession, path, t, kind, probes) for t in terms]
    if any(f is None for f in found):
        return df.where(holds)
    ids = reduce(DataFrame.union, found).distinct().withColumnRenamed("id", "__id")
    near = df.join(ids, F.col(key) == F.col("__id"), "left_semi")
    return near.unionByName(df.where(F.col(key).isNull())).where(holds)


def keyword_search_indexed(reviews: DataFrame, docs: DataFrame, path: str, query: str, k: int | None = None,
                           categories: list[str] | None = None, sentiments: list[str] | None = None, min_rating: float = 0.0,
                           min_similarity: float = 0.0, on: str = "doc_id", text: str = "text", topic: str = "topic_label",
                           similarity: str = "similarity", tiebreak: list[str] | None = None) -> DataFrame:
    """E1 with the index: the rows and scores of ``search.keyword_search`` over reviews joined with ``docs`` by ``on``.

    Only the texts the index names are read; every other review is scored from its topic and similarity.
    ``on`` is a key of ``docs``. A review without a document is scored on the word ``None``, as one with a null text.
    """
    out = filter_reviews(reviews, categories, sentiments, min_rating, min_similarity)
    terms = query_terms(query)
    weight = {t: terms.count(t) for t in sorted(set(terms))}  # a repeated term counts each time
    score = F.coalesce(F.col(similarity), F.lit(0.0))
    if weight:
        label = searched(topic)
        score = score + sum((F.when(F.contains(label, F.lit(t)), F.lit(1.5 * n)).otherwise(F.lit(0.0)) for t, n in weight.items()), F.lit(0.0))
        texts = docs.where(F.col(on).isNotNull()).select(F.col(on).alias("__doc"), F.col(text).alias("__text"))
        near = containing(texts, path, list(weight), "__doc", "__text")
        hits = near.select("__doc", sum((F.when(F.contains(searched("__text"), F.lit(t)), F.lit(float(n))).otherwise(F.lit(0.0))
                                         for t, n in weight.items()), F.lit(0.0)).alias("__hits"))
        missing = float(sum(n for t, n in weight.items() if t in "none"))
        if missing:  # only then does it matter whether a review's document is there
            hits = texts.select("__doc").join(hits, "__doc", "left").withColumn("__hits", F.coalesce("__hits", F.lit(0.0)))
        out = out.join(hits, F.col(on) == F.col("__doc"), "left").drop("__doc")
        score = score + F.coalesce(F.col("__hits"), F.lit(missing))
    out = out.withColumn("query_score", score)
    out = out.drop("__hits") if weight else out
    ordered = out.orderBy(F.desc("query_score"), *[F.asc_nulls_last(c) for c in (tiebreak or [])])
    return ordered.limit(k) if k is not None else ordered
