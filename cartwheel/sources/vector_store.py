"""S11 as a merge: vectors in hash buckets, where an upsert rewrites only the buckets it touches.

``data/commit=<id>/bucket=<b>/`` holds Parquet rows and ``manifests/version=<n>/`` one row per bucket: the commit whose files
hold the bucket in that version. A version exists once its manifest, a single file, is in place; data of a write that failed
before that are in no manifest, so readers go on with the version before and the write can simply be run again.

One writer at a time: two that publish the same version are told so (the second raises), and the first one's files stay as they are.
Equal ids share a bucket. Rows with a null key are rejects of an upsert and are not stored by ``write_store`` either.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cartwheel.session import written
from cartwheel.sources.parquet import upsert_vectors

BUCKETS = 64  # of a new store; about 128 MB a bucket keeps an upsert of a few keys cheap
MANIFEST = "bucket int, buckets int, commit string, layout string, version int"


def bucket_of(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def versions(spark: SparkSession, path: str) -> DataFrame:
    """One row per version and bucket."""
    return spark.read.schema(MANIFEST).parquet(f"{path}/manifests")


def manifest(spark: SparkSession, path: str, version: int | None = None) -> list[Row]:
    """The manifest of a version (default: the newest): one row per bucket, whatever the number of vectors."""
    held = versions(spark, path)
    if version is None:
        version = held.agg(F.max("version")).first()[0]
    rows = held.where(F.col("version") == F.lit(version)).collect()
    if not rows:
        raise FileNotFoundError(f"no version {version} of a vector store in {path}")
    if len(rows) != rows[0].buckets:
        raise RuntimeError(f"version {version} of {path} was published twice")
    return rows


def read_store(spark: SparkSession, path: str, version: int | None = None, buckets: list[int] | None = None) -> DataFrame:
    """The rows of a version, or of some of its buckets; a reader keeps its version while others publish new ones."""
    rows = manifest(spark, path, version)
    layout = StructType.fromJson(json.loads(rows[0].layout))
    wanted = set(range(rows[0].buckets) if buckets is None else buckets)
    folders = [f"{path}/data/commit={r.commit}/bucket={r.bucket}" for r in rows if r.commit and r.bucket in wanted]
    return spark.read.schema(layout).parquet(*sorted(folders)) if folders else spark.createDataFrame([], layout)


def _put(rows: DataFrame, path: str, key: str, buckets: int) -> tuple[str, set[int]]:
    """Rows written under a commit of their own; the buckets that got files."""
    commit = uuid.uuid4().hex
    folder = f"{path}/data/commit={commit}"
    # Rebalancing brings a bucket's rows together and still cuts a large bucket into several tasks and files.
    dealt = rows.where(F.col(key).isNotNull()).withColumn("bucket", bucket_of(key, buckets)).hint("rebalance", "bucket")
    dealt.write.partitionBy("bucket").parquet(folder)
    filled = rows.sparkSession.read.schema(dealt.schema).parquet(folder).select("bucket").distinct().collect()
    return commit, {r.bucket for r in filled}


def _publish(spark: SparkSession, path: str, version: int, layout: str, commits: list[str | None]) -> None:
    rows = [(b, len(commits), c, layout, version) for b, c in enumerate(commits)]
    one = spark.createDataFrame(rows, MANIFEST).coalesce(1)
    one.write.mode("append").partitionBy("version").parquet(f"{path}/manifests")
    manifest(spark, path, version)  # raises where another writer published this version too


def write_store(rows: DataFrame, path: str, key: str = "id", buckets: int = BUCKETS) -> None:
    """A new store, its version 0."""
    commit, filled = _put(rows, path, key, buckets)
    _publish(rows.sparkSession, path, 0, rows.schema.json(), [commit if b in filled else None for b in range(buckets)])


def merge_store(spark: SparkSession, path: str, updates: DataFrame, key: str = "id", sequence: str | None = None,
                embedding: str = "embedding") -> DataFrame:
    """Updates merged as ``upsert_vectors`` does, into a new version; returns the rejected updates.

    Only the touched buckets are read and written; the others keep the files they have. Updates without
    a good row publish nothing.
    """
    held = sorted(manifest(spark, path), key=lambda r: r.bucket)
    n = held[0].buckets
    updates = written(updates, "updates")  # read for its buckets, for the merge and for the rejects
    good = updates.where(F.col(key).isNotNull() & (F.size(embedding) > 0))
    touched = {r.bucket for r in good.select(bucket_of(key, n).alias("bucket")).distinct().collect()}
    old = read_store(spark, path, held[0].version, sorted(touched))
    merged, rejects = upsert_vectors(old, updates, key, sequence, embedding)
    if touched:
        commit, _ = _put(merged, path, key, n)
        _publish(spark, path, held[0].version + 1, held[0].layout, [commit if r.bucket in touched else r.commit for r in held])
    return rejects
