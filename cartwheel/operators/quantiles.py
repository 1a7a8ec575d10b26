"""Exact interpolated quantiles per group by refinement.

Spark's ``percentile``/``median`` keep every distinct value of a group in one aggregation buffer,
which a group holding a third of all rows cannot afford. Here two plain aggregates, both
combined before their shuffle, do the work:

1. rows per (group, bucket), a bucket being a rising function of the value (``bucket_of``), with its least and
   greatest value; running counts over a group's buckets say in which buckets the target ranks lie;
2. rows per (group, bucket, slot) of those buckets only, a slot being one of ``RADIX`` equal steps between the bucket's least
   and greatest value, so that a column whose values crowd into one bucket is parted all the same;
3. rows per (group, bucket, slot, value) of the target slots; running counts over them, started at the
   rows before the slot, give the values at ranks ⌊(n−1)p⌋ and ⌈(n−1)p⌉.

They are interpolated as ``(hi_rank − pos)·lo + (pos − lo_rank)·hi`` (the same formula as
Spark's exact percentile). Running counts are windows over counts, which spill, never
over rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

STEPS = 256  # buckets per unit of the logarithm
RADIX = 65536  # slots of a bucket


def bucket_of(v: Column) -> Column:
    """A whole number that never falls as the value rises: signed logarithm in ``STEPS`` steps."""
    size = F.floor(F.log1p(F.least(F.abs(v), F.lit(1e300))) * STEPS).cast("bigint")
    return F.when(v < 0, -size).otherwise(size)


def _same(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join on ``keys`` where null keys match each other (group keys may be null)."""
    r = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    return left.join(r, [left[k].eqNullSafe(r[f"_r_{k}"]) for k in keys]).drop(*[f"_r_{k}" for k in keys])


def _running(df: DataFrame, within: list[str], order: str, n: str) -> Column:
    """Rows before this one's, within the keys."""
    w = Window.partitionBy(*within).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(n).over(w), F.lit(0))


def grouped_quantiles(df: DataFrame, value: str, groups: list[str], probs: list[float],
                      names: list[str] | None = None) -> DataFrame:
    """Exact linear-interpolated quantiles of ``value`` per group (nulls and NaN ignored).

    Output: groups + one column per probability (``names`` or ``q<i>``);
    groups with no values are absent. Without groups the whole column is one.
    """
    names = names or [f"q{i}" for i in range(len(probs))]
    v = df.select(*groups, F.col(value).cast("double").alias("_v")).where(F.col("_v").isNotNull() & ~F.isnan("_v"))
    v = v.withColumn("_bucket", bucket_of(F.col("_v")))
    def ranks(p: float) -> tuple[Column, Column, Column]:
        pos = (F.col("_total") - F.lit(1)).cast("double") * F.lit(float(p))
        return pos, F.floor(pos), F.ceil(pos)

    def holds(rank: Column) -> Column:
        return (F.col("_before") <= rank) & (rank < F.col("_before") + F.col("_n"))

    def targets(per: DataFrame) -> DataFrame:
        wanted = F.lit(False)
        for p in probs:
            wanted = wanted | holds(ranks(p)[1]) | holds(ranks(p)[2])
        return per.where(wanted)

    measures = [F.count(F.lit(1)).alias("_n"), F.min("_v").alias("_least"), F.max("_v").alias("_most")]
    per = v.groupBy(*groups, "_bucket").agg(*measures)
    per = per.withColumns({"_before": _running(per, groups, "_bucket", "_n"),
                           "_total": F.sum("_n").over(Window.partitionBy(*groups))})
    # The chosen buckets, and then slots, are a few rows per group.
    chosen = targets(per).select(*groups, "_bucket", F.col("_before").alias("_start"), "_total", "_least", "_most")
    rows = _same(v, chosen, [*groups, "_bucket"])
    share = F.try_divide(F.col("_v") - F.col("_least"), F.col("_most") - F.col("_least"))  # null: one value, or a span beyond doubles
    rows = rows.withColumn("_slot", F.coalesce(F.least(F.floor(share * RADIX), F.lit(RADIX - 1)), F.lit(0)).cast("bigint")).drop("_least", "_most")
    within = [*groups, "_bucket", "_start", "_total"]
    slots = rows.groupBy(*within, "_slot").agg(F.count(F.lit(1)).alias("_n"))
    slots = targets(slots.withColumn("_before", F.col("_start") + _running(slots, [*groups, "_bucket"], "_slot", "_n")))
    slots = slots.select(*groups, "_bucket", "_slot", F.col("_before").alias("_from"))
    fine = _same(rows, slots, [*groups, "_bucket", "_slot"]).groupBy(*within, "_slot", "_from", "_v").agg(F.count(F.lit(1)).alias("_n"))
    fine = fine.withColumn("_before", F.col("_from") + _running(fine, [*groups, "_bucket", "_slot"], "_v", "_n"))
    picked = []
    for i, p in enumerate(probs):
        _, lo, hi = ranks(p)
        picked += [F.max(F.when(holds(lo), F.col("_v"))).alias(f"_lo{i}"), F.max(F.when(holds(hi), F.col("_v"))).alias(f"_hi{i}")]
    ends = fine.groupBy(*groups).agg(F.max("_total").alias("_total"), *picked).where(F.col("_total") > 0)
    outs = []
    for i, (p, name) in enumerate(zip(probs, names, strict=True)):
        pos, lo, hi = ranks(p)
        outs.append(F.when(lo == hi, F.col(f"_lo{i}")).otherwise(
            (hi - pos) * F.col(f"_lo{i}") + (pos - lo) * F.col(f"_hi{i}")).alias(name))
    return ends.select(*groups, *outs)


def median_by(df: DataFrame, value: str, groups: list[str], out: str = "median") -> DataFrame:
    """Exact interpolated median per group."""
    return grouped_quantiles(df, value, groups, [0.5], [out])
