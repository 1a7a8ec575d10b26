"""Mixing sources to target weights: fixed-length token blocks drawn by source through index permutations.

Each source's documents, in a hashed order, form one stream of words that is cut
into blocks of ``block`` words. Water-filling turns the weights into target sizes
(no source above ``cap`` times its size). The output is a row of slots, ``shard_slots``
to an output shard. Slots draw sources: the counts of a shard are a multinomial draw
conditioned on the corpus totals (a pseudorandom permutation of all slots deals
them out), so a source's total is its target and not merely near it on average. The
n-th slot of a source takes the block a pseudorandom permutation of its block
numbers has at n, a new permutation each time all blocks are used up, and blocks are
joined by that number. DataFrame and SQL functions only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.llm.common import WORD_GAP, staged

WEIGHTS = [5, 2, 1]  # of the sources in order, repeating
CAP = 3
BLOCK = 32
SHARD_SLOTS = 4096
ROUNDS = 4
WALKS = 64
BUCKET_ROWS = 250  # documents of a bucket, on average
BUCKETS_A_RANGE = 1024  # buckets summed together, and then their sums
CHUNK_SLOTS = 50_000  # slots made by one row


def word_count(text: str | Column) -> Column:
    """Words `[^\\x20\\x09-\\x0D]+` (null: 0)."""
    parts = F.split(F.coalesce(text, F.lit("")), WORD_GAP)
    outer = F.when(parts[0] == "", 1).otherwise(0) + F.when((F.size(parts) > 1) & (F.element_at(parts, -1) == ""), 1).otherwise(0)
    return (F.size(parts) - outer).cast("bigint")


def source_key(source: str | Column) -> Column:
    """A text that orders as the source does, null last, and joins like any other."""
    source = F.col(source) if isinstance(source, str) else source
    return F.when(source.isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), source.cast("string")))


# ---- permutations ----------------------------------------------------------

def _rounds(x: Column, n: Column, seed: Column) -> Column:
    """A bijection of [0, a*b), a*b >= n: x is (left, right) in a mixed radix; halves add hashes of each other."""
    a = F.ceil(F.sqrt(n.cast("double"))).cast("bigint")
    b = F.ceil(n / a).cast("bigint")
    start = F.struct(F.floor(x / b).cast("bigint").alias("l"), F.pmod(x, b).alias("r"))

    def turn(acc: Column, i: Column) -> Column:
        odd = i % 2 == 1
        return F.struct(
            F.when(odd, F.pmod(acc["l"] + F.pmod(F.xxhash64(seed, i, acc["r"]), a), a)).otherwise(acc["l"]).alias("l"),
            F.when(odd, acc["r"]).otherwise(F.pmod(acc["r"] + F.pmod(F.xxhash64(seed, i, acc["l"]), b), b)).alias("r"))

    done = F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, lambda acc, i: turn(acc, i))
    return F.transform(F.array(done), lambda d: d["l"] * b + d["r"])[0]


def with_permuted(df: DataFrame, out: str, x: Column, n: Column, seed: Column) -> DataFrame:
    """``df`` with a pseudorandom permutation of 0..n-1 at ``x`` (a bijection for every n and seed).

    Values outside are walked on until they fall inside; fewer than sqrt(n) lie
    outside, so the walk ends within ``WALKS`` steps (certain below 4096, and of odds
    under (1/64)**64 to fail above).
    """
    first = df.withColumns({"__x": x, "__n": n, "__seed": seed}).withColumn(
        "__v", _rounds(F.col("__x"), F.col("__n"), F.col("__seed")))
    walk = F.aggregate(F.sequence(F.lit(1), F.lit(WALKS)), F.col("__v"), lambda v, _: F.when(
        v < F.col("__n"), v).otherwise(_rounds(v, F.col("__n"), F.col("__seed"))))
    value = F.when(F.col("__v") < F.col("__n"), F.col("__v")).otherwise(walk)
    return first.withColumn(out, value).drop("__x", "__n", "__seed", "__v")


# ---- targets ---------------------------------------------------------------

def source_targets(sizes: DataFrame, weights: list[int] = WEIGHTS, cap: float = CAP, block: int = BLOCK) -> DataFrame:
    """Per source key: size, target, blocks, draws (slots) and first slot. ``sizes``: (src, size) rows.

    Water-filling: targets are weight times one level, at most ``cap`` times the
    size; ordered by the level at which a source is full, the level is fixed by the
    first source that is not. The windows run over one row per source.
    """
    everything = Window.partitionBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    by_name = Window.partitionBy().orderBy("src")
    by_full = Window.partitionBy().orderBy("full_at", "src")
    before, after = by_full.rowsBetween(Window.unboundedPreceding, -1), by_full.rowsBetween(0, Window.unboundedFollowing)
    per = sizes.groupBy("src").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(by_name) - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), F.pmod(rank, F.lit(len(weights))) + 1)
    rows = per.withColumn("weight", weight.cast("double"))
    rows = rows.withColumns({"limit": F.col("source_size") * float(cap), "total": F.sum("source_size").over(everything)})
    rows = rows.withColumn("full_at", F.col("limit") / F.col("weight"))
    level = (F.col("total") - F.coalesce(F.sum("limit").over(before), F.lit(0.0))) / F.sum("weight").over(after)
    rows = rows.withColumn("level", level)
    rows = rows.withColumn("level", F.max(F.when(F.col("level") <= F.col("full_at"), F.col("level"))).over(everything))
    rows = rows.withColumn("target", F.least("limit", F.col("weight") * F.col("level")))
    n_blocks = F.ceil(F.col("source_size") / block).cast("bigint")
    rows = rows.withColumn("blocks", n_blocks)
    draws = F.when(F.col("source_size") == 0, 0).otherwise(F.least(
        F.col("blocks") * int(cap), F.round(F.col("target") * F.col("blocks") / F.col("source_size")).cast("bigint")))
    rows = rows.withColumn("draws", draws.cast("bigint"))
    first = F.sum("draws").over(by_name.rowsBetween(Window.unboundedPreceding, 0)) - F.col("draws")
    return rows.withColumn("first_slot", first).select("src", "source_size", "target", "blocks", "draws", "first_slot")


# ---- the mix ---------------------------------------------------------------

@dataclass
class Mix:
    """``documents``: doc_id, src, size, start (its first word's place in the source's stream), source_size, target;
    ``draws``: shard, slot, src, block; ``pieces``: src, block, start, doc_id, from_word, n_words."""
    documents: DataFrame
    draws: DataFrame
    pieces: DataFrame


def _before(n: str, within: list[str], order: str) -> Column:
    w = Window.partitionBy(*within).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(n).over(w), F.lit(0))


def bucket_starts(marked: DataFrame) -> DataFrame:
    """Where each (source, bucket) begins in its source's stream: sums of ranges of buckets, then of buckets in a range."""
    sums = (marked.groupBy("src", "bucket").agg(F.sum("size").alias("n"))
            .withColumn("range", F.floor(F.col("bucket") / BUCKETS_A_RANGE)))
    ranges = (sums.groupBy("src", "range").agg(F.sum("n").alias("range_n"))
              .withColumn("range_start", _before("range_n", ["src"], "range")).drop("range_n"))
    inside = sums.withColumn("inside", _before("n", ["src", "range"], "bucket"))
    return inside.join(ranges, ["src", "range"]).select("src", "bucket", (F.col("range_start") + F.col("inside")).alias("bucket_start"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: list[int] = WEIGHTS, cap: int = CAP, block: int = BLOCK, shard_slots: int = SHARD_SLOTS,
        seed: int = 42, carry: tuple[str, ...] = ()) -> Mix:
    """Plan the mix of whole documents; ``carry`` names small columns kept in ``documents``.

    Texts leave the plan at once: only (id, source, size) is written and shuffled.
    Null or empty texts have size 0 and are never taken; null is a source of its
    own, last in order; rows that repeat are documents of their own. Offsets are
    sums in three steps (ranges of buckets, buckets, documents of a bucket), so a source
    with a third of all rows is spread over many tasks.
    """
    spark = docs.sparkSession
    sized = staged(docs.select(F.col(id_col).cast("bigint").alias("doc_id"), source_key(source_col).alias("src"),
                               word_count(F.col(text_col).cast("string")).alias("size"), *carry), "mix-sizes")
    rows = sized.count()
    buckets = max(1, -(-rows // BUCKET_ROWS))
    marked = sized.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "size", F.lit(seed)), F.lit(buckets)))
    starts = bucket_starts(marked)
    in_bucket = Window.partitionBy("src", "bucket").orderBy("doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    placed = (marked.withColumn("__end", F.sum("size").over(in_bucket)).join(starts, ["src", "bucket"])
              .withColumn("start", F.col("bucket_start") + F.col("__end") - F.col("size")))
    targets = staged(source_targets(marked, weights, cap, block), "mix-targets")
    documents = placed.join(targets.select("src", "source_size", "target"), "src").select(
        "doc_id", "src", "size", "start", "source_size", "target", *carry)

    # Slots: chunks of a source's draws first, dealt over the tasks, then one row per draw.
    total = targets.agg(F.sum("draws")).first()[0] or 0
    chunks = (targets.where("draws > 0").withColumn("from_draw", F.explode(F.sequence(
        F.lit(0).cast("bigint"), F.col("draws") - 1, F.lit(CHUNK_SLOTS).cast("bigint"))))
        .repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "src", "from_draw"))
    until = F.least(F.col("draws"), F.col("from_draw") + CHUNK_SLOTS) - 1
    draws = chunks.select("src", "blocks", "first_slot", F.explode(F.sequence(F.col("from_draw"), until)).alias("n"))
    draws = with_permuted(draws, "place", F.col("first_slot") + F.col("n"), F.lit(max(total, 1)).cast("bigint"), F.lit(seed))
    epoch = F.floor(F.col("n") / F.col("blocks"))
    draws = with_permuted(draws, "block", F.pmod("n", F.col("blocks")), F.col("blocks"), F.xxhash64("src", epoch, F.lit(seed)))
    draws = draws.select(F.floor(F.col("place") / shard_slots).cast("bigint").alias("shard"),
                         F.pmod("place", F.lit(shard_slots)).alias("slot"), "src", "block")

    end = F.col("start") + F.col("size")
    pieces = placed.where("size > 0").withColumn("block", F.explode(F.sequence(
        F.floor(F.col("start") / block), F.floor((end - 1) / block))))
    low, high = F.greatest(F.col("start"), F.col("block") * block), F.least(end, (F.col("block") + 1) * block)
    pieces = pieces.select("src", "block", "start", "doc_id", "size", (low - F.col("start")).alias("from_word"),
                           (high - low).alias("n_words"))
    return Mix(documents, draws, pieces)


def packed(plan: Mix) -> DataFrame:
    """The mixed corpus as references: shard, slot, doc_id, from_word, n_words (a block may hold several pieces)."""
    return plan.draws.hint("merge").join(plan.pieces.hint("merge"), ["src", "block"]).select("shard", "slot", "doc_id", "from_word", "n_words")


def taken_words(plan: Mix) -> DataFrame:
    """``documents`` with the words the mix takes of each, repeats counted (``taken``)."""
    times = plan.draws.groupBy("src", "block").agg(F.count(F.lit(1)).alias("times"))
    # Made-up rows have no statistics: without the hints the planner takes them for tiny and broadcasts them.
    sums = (plan.pieces.hint("merge").join(times.hint("merge"), ["src", "block"]).groupBy("src", "start")
            .agg(F.sum(F.col("n_words") * F.col("times")).alias("taken")))
    # A document with words is the only one at its place; those without words share it and are not taken.
    sized = F.when(F.col("size") > 0, F.col("start"))
    return (plan.documents.withColumn("__at", sized)
            .join(sums.withColumnsRenamed({"start": "__at"}).hint("merge"), ["src", "__at"], "left")
            .withColumn("taken", F.coalesce("taken", F.lit(0)).cast("bigint")).drop("__at", "start"))


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The documents the mix takes words of, with size, source_size, target and taken appended.

    Documents it takes nothing of (all without words) are left out. Rows that
    repeat id, text and source are returned once, with the words taken of all of
    them. Columns of those names in ``docs`` are replaced.
    """
    new = ["size", "source_size", "target", "taken"]
    marked = docs.drop(*new).withColumns({"__mark": F.xxhash64(F.col(text_col), F.col(source_col))})
    taken = taken_words(mix(marked, id_col, text_col, source_col, carry=("__mark",)))
    per = taken.groupBy(F.col("doc_id").alias("__doc_id"), F.col("__mark").alias("__of")).agg(
        F.max("size").alias("size"), F.max("source_size").alias("source_size"), F.max("target").alias("target"),
        F.sum("taken").alias("taken")).where("taken > 0")
    return (marked.withColumn("__id", F.col(id_col).cast("bigint"))
            .join(per, F.col("__id").eqNullSafe(F.col("__doc_id")) & (F.col("__mark") == F.col("__of")))
            .dropDuplicates(["__id", "__mark"]).select(*[c for c in docs.columns if c not in new], *new))


def mix_report(docs: DataFrame) -> DataFrame:
    """Contract of ``op7_mix``: doc_id, size, source_size, target, taken."""
    return taken_words(mix(docs)).select("doc_id", "size", "source_size", "target", "taken")
