"""The bucketed vector store: untouched buckets keep their files, and a version is old or new, never half."""

import pytest
from pyspark.sql import functions as F

from cartwheel.sources import vector_store as VS
from cartwheel.sources.parquet import upsert_vectors

SCHEMA = "id bigint, embedding array<float>, label int"


def rows(spark, ids, label=0):
    return spark.createDataFrame([(i, [float(i or 0), 1.0], label) for i in ids], SCHEMA)


def held(df):
    return sorted((r.id, tuple(r.embedding), r.label) for r in df.collect())


def files(df):
    return {r.f for r in df.select(F.input_file_name().alias("f")).distinct().collect()}


def test_merge_equals_the_plain_upsert(spark, tmp_dir):
    base = rows(spark, range(200))
    VS.write_store(base, tmp_dir, buckets=8)
    up = spark.createDataFrame([(3, [1.0], 5, 1), (3, [2.0], 6, 2), (900, [3.0], 7, 1), (None, [4.0], 8, 1), (4, [], 9, 1), (5, None, 9, 1)],
                               SCHEMA + ", seq int")
    rejects = VS.merge_store(spark, tmp_dir, up, sequence="seq")
    plain, bad = upsert_vectors(base, up, sequence="seq")
    assert held(VS.read_store(spark, tmp_dir)) == held(plain)
    assert sorted(r.label for r in rejects.collect()) == sorted(r.label for r in bad.collect()) == [8, 9, 9]
    assert held(VS.read_store(spark, tmp_dir, version=0)) == held(base)


def test_untouched_buckets_keep_their_files(spark, tmp_dir):
    VS.write_store(rows(spark, range(500)), tmp_dir, buckets=16)
    before = files(VS.read_store(spark, tmp_dir))
    VS.merge_store(spark, tmp_dir, rows(spark, [7], 1))
    now = files(VS.read_store(spark, tmp_dir))
    assert len(before) == 16 and len(now - before) == 1 and len(before - now) == 1


def test_failed_writes_leave_the_old_version(spark, tmp_dir, monkeypatch):
    VS.write_store(rows(spark, range(50)), tmp_dir, buckets=4)
    monkeypatch.setattr(VS, "_publish", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        VS.merge_store(spark, tmp_dir, rows(spark, [1, 2], 9))
    assert held(VS.read_store(spark, tmp_dir)) == held(rows(spark, range(50)))
    monkeypatch.undo()
    VS.merge_store(spark, tmp_dir, rows(spark, [1, 2], 9))
    assert sum(r[2] == 9 for r in held(VS.read_store(spark, tmp_dir))) == 2


def test_two_writers_of_one_version_are_told(spark, tmp_dir):
    VS.write_store(rows(spark, range(20)), tmp_dir, buckets=4)
    layout = VS.manifest(spark, tmp_dir)[0].layout
    VS._publish(spark, tmp_dir, 1, layout, [None] * 4)
    with pytest.raises(RuntimeError):
        VS._publish(spark, tmp_dir, 1, layout, [None] * 4)


def test_empty_tables_null_keys_and_repeats(spark, tmp_dir):
    VS.write_store(rows(spark, []), f"{tmp_dir}/a", buckets=4)
    assert held(VS.read_store(spark, f"{tmp_dir}/a")) == []
    VS.merge_store(spark, f"{tmp_dir}/a", rows(spark, []))
    assert VS.manifest(spark, f"{tmp_dir}/a")[0].version == 0  # nothing to publish
    VS.merge_store(spark, f"{tmp_dir}/a", rows(spark, [1, 2]))
    assert len(held(VS.read_store(spark, f"{tmp_dir}/a"))) == 2
    VS.write_store(rows(spark, [None, 1, 1, 2]), f"{tmp_dir}/b", buckets=4)
    assert [r[0] for r in held(VS.read_store(spark, f"{tmp_dir}/b"))] == [1, 1, 2]


def test_missing_version(spark, tmp_dir):
    VS.write_store(rows(spark, [1]), tmp_dir, buckets=2)
    with pytest.raises(FileNotFoundError):
        VS.read_store(spark, tmp_dir, version=5)
