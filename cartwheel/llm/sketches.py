"""Document fingerprints: bottom-k sketches of shingle hashes.

A sketch is the ``k`` smallest distinct hashes of a text's word shingles, in
order. Sketches of parts merge into the sketch of the union, and estimate the
number of distinct shingles, resemblance (Jaccard) and containment. DataFrame and
SQL functions only; hashes compare as signed integers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.llm.common import WORD_GAP, staged

K = 128
SHINGLE = 5
NO_HASHES = "array<bigint>"


def shingle_hashes(text: str | Column, shingle: int = SHINGLE) -> Column:
    """Hash of every run of ``shingle`` words; a shorter text is one run, a text without words has none."""
    word_hashes = F.transform(F.filter(F.split(F.coalesce(text, F.lit("")), WORD_GAP), lambda w: w != ""),
                              lambda w: F.xxhash64(w))

    def runs(h: Column) -> Column:
        long = F.transform(F.sequence(F.lit(1), F.size(h) - shingle + 1), lambda i: F.xxhash64(
            *[F.get(h, i + j - 1) for j in range(shingle)]))
        return F.when(F.size(h) >= shingle, long).when(F.size(h) > 0, F.array(F.xxhash64(h))).otherwise(
            F.array().cast(NO_HASHES))

    return F.flatten(F.transform(F.array(word_hashes), runs))


def sketch(text: str | Column, k: int = K, shingle: int = SHINGLE) -> Column:
    """The ``k`` smallest distinct shingle hashes, ascending."""
    return F.slice(F.sort_array(F.array_distinct(shingle_hashes(text, shingle))), 1, k)


def merge(a: str | Column, b: str | Column, k: int = K) -> Column:
    """Sketch of the union of two parts (of their shingles; runs across the parts' border are neither's)."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def distinct_shingles(s: str | Column, k: int = K) -> Column:
    """Estimated distinct shingles: exact below ``k``, else (k - 1) over the k-th hash's share of the hash range."""
    s = F.col(s) if isinstance(s, str) else s
    share = (F.element_at(s, -1).cast("double") + 2.0 ** 63) / 2.0 ** 64
    return F.when(F.size(s) < k, F.size(s).cast("double")).otherwise((k - 1) / F.greatest(share, F.lit(2.0 ** -64)))


def resemblance(a: str | Column, b: str | Column, k: int = K) -> Column:
    """Estimated Jaccard similarity, 0 to 1: the share of the union's sketch that both sketches hold (both empty: 1)."""
    union = merge(a, b, k)
    both = F.size(F.array_intersect(union, F.array_intersect(a, b)))
    return F.when(F.size(union) == 0, 1.0).otherwise(both / F.size(union))


def containment(a: str | Column, b: str | Column, k: int = K) -> Column:
    """Estimated share of a's shingles that b has (a empty: 1)."""
    shared = resemblance(a, b, k) * distinct_shingles(merge(a, b, k), k)
    mine = distinct_shingles(a, k)
    return F.when(mine == 0, 1.0).otherwise(F.least(F.lit(1.0), shared / mine))


def merge_parts(parts: DataFrame, key: str, text_col: str, k: int = K, shingle: int = SHINGLE) -> DataFrame:
    """One sketch per key over all its texts: (key, sketch). Each task keeps ``k`` hashes of a key before the shuffle.

    Hashes are reduced per (key, slice of the hash range) first, so a key with a
    third of all rows is spread over many tasks.
    """
    hashes = parts.select(F.col(key).alias("key"), F.explode(sketch(text_col, k, shingle)).alias("h")).distinct()
    ranked = Window.partitionBy("key", "slice").orderBy("h")
    sliced = hashes.withColumn("slice", F.pmod(F.xxhash64("h"), F.lit(64)))
    kept = sliced.withColumn("r", F.row_number().over(ranked)).where(F.col("r") <= k)
    return kept.groupBy("key").agg(F.slice(F.sort_array(F.collect_list("h")), 1, k).alias("sketch")).withColumnRenamed("key", key)


def as_text(s: str | Column) -> Column:
    """The fingerprint as a string: the hashes in hex, comma-joined."""
    return F.array_join(F.transform(s, lambda h: F.lower(F.hex(h))), ",")


# ---- neighbours by id ------------------------------------------------------

def neighbours(ids: DataFrame) -> DataFrame:
    """(id, n) rows with distinct ids: each id with ``prev_id`` and its ``prev_n``; the first one's is the last.

    Ids are range-partitioned and written once; each partition looks inside itself,
    and the borders come from one row per partition.
    """
    parts = int(ids.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = staged(ids.repartitionByRange(parts, "id").withColumn("part", F.spark_partition_id()), "ids-by-range")
    me = F.struct("id", "n")
    rows = ranged.withColumn("prev", F.lag(me).over(Window.partitionBy("part").orderBy("id")))
    last = ranged.groupBy("part").agg(F.max(me).alias("last"))
    by_part = Window.orderBy("part")
    whole = by_part.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    border = last.select("part", F.coalesce(F.lag("last").over(by_part), F.last("last").over(whole)).alias("border"))
    return rows.join(border, "part").select("id", F.coalesce("prev", "border").alias("prev")).select(
        "id", F.col("prev.id").alias("prev_id"), F.col("prev.n").alias("prev_n"))


def fingerprint_report(docs: DataFrame, k: int = K, shingle: int = SHINGLE) -> DataFrame:
    """Contract of ``op2_fingerprints``: each document against its edited text and the next document.

    The edited text puts the start of the next document over the last half. Null
    texts count as empty. Rows that share an id are one place in the order: each of
    them is compared with the next id, and the smallest of their texts stands for
    them to the id before. A row without id has no place; it is its own next.
    """
    # A cast or alias of the id would keep Spark from seeing that both joins shuffle the same rows.
    whole = docs if dict(docs.dtypes)["doc_id"] == "bigint" else docs.withColumn("doc_id", F.col("doc_id").cast("bigint"))
    rows = whole.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    placed = rows.where("doc_id IS NOT NULL")
    ids = placed.groupBy(F.col("doc_id").alias("id")).agg(F.max(F.char_length("text")).alias("n"))
    to = staged(neighbours(ids), "neighbours").select(
        F.col("id").alias("doc_id"), F.col("prev_id").alias("to_id"), F.floor(F.col("prev_n") / 2).cast("int").alias("need"))
    # What each document hands to the one before: no more text than that one's last half, and its own sketch.
    # Both joins read the texts by id, so they are shuffled once.
    handed = (placed.join(to, "doc_id").groupBy("doc_id", "to_id", "need").agg(F.min("text").alias("next_text"))
              .select(F.col("to_id").alias("doc_id"), F.expr("left(next_text, need)").alias("head"),
                      sketch("next_text", k, shingle).alias("next_sketch")))
    own = sketch("text", k, shingle).alias("sketch")
    alone = rows.where("doc_id IS NULL").select("doc_id", "text", F.col("text").alias("head"), sketch("text", k, shingle).alias("next_sketch"))
    paired = placed.join(handed, "doc_id").select("doc_id", "text", "head", "next_sketch").unionByName(alone)
    edited = F.concat(F.expr("left(text, char_length(text) - cast(floor(char_length(text) / 2) as int))"),
                      F.expr("left(head, cast(floor(char_length(text) / 2) as int))"))
    both = paired.select("doc_id", F.char_length("text").cast("bigint").alias("n_chars"), own, "next_sketch",
                         edited.alias("edited"))
    both = both.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "sketch", "next_sketch",
                       sketch("edited", k, shingle).alias("edited_sketch"))
    return both.select("doc_id", "n_chars", "edited_sha256", as_text("sketch").alias("fingerprint"),
                       as_text("edited_sketch").alias("edited_fingerprint"),
                       resemblance("sketch", "edited_sketch", k).alias("near_edited"),
                       resemblance("sketch", "next_sketch", k).alias("near_next"),
                       distinct_shingles("sketch", k).alias("shingles"),
                       containment("edited_sketch", "sketch", k).alias("edited_inside"))
