"""Records with quoted line breaks: cut in many tasks, they equal the one-task reader's."""

import csv
import io
import os
import random

import pytest

from cartwheel.sources import csv as CSV
from cartwheel.sources.csv_records import csv_records


@pytest.fixture()
def small_splits(spark):
    keep = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    for k, v in keep.items():
        spark.conf.set(k, v)


def put(folder: str, name: str, text: str) -> str:
    path = f"{folder}/{name}"
    local = path.split(":", 1)[-1] if path.startswith("file:") else path
    os.makedirs(os.path.dirname(local), exist_ok=True)
    with open(local, "w", encoding="utf-8", newline="") as f:
        f.write(text)
    return path


def content(seed: int, rows: int, end: str = "\n", columns: int = 3) -> str:
    rnd = random.Random(seed)
    bits = ["a", "kettle", '"', '""', ",", end, end + end, '",', ',"', "é", " ", "₹1,999", ""]
    out = io.StringIO()
    w = csv.writer(out, lineterminator=end, quoting=csv.QUOTE_MINIMAL)
    w.writerow(["name", "ratings", "no_of_ratings"][:columns])
    for i in range(rows):
        w.writerow([f"{i}"] + ["".join(rnd.choice(bits) for _ in range(rnd.randrange(7))) for _ in range(columns - 1)])
    return out.getvalue()


def one_task(spark, path):
    return spark.read.options(**CSV.CSV_OPTIONS, multiLine="true").csv(path)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("seed", range(2))
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_equals_the_one_task_reader(spark, tmp_dir, small_splits, seed, end):
    path = put(tmp_dir, "c.csv", content(seed, 400, end))
    got = CSV._scan(spark, [path], True)
    assert csv_records(spark, [path]).count() == 400
    assert spark.read.text(path).rdd.getNumPartitions() > 4
    assert rows(got.drop("_file")) == rows(one_task(spark, path))


def test_quotes_inside_unquoted_fields_open_nothing(spark, tmp_dir, small_splits):
    body = "".join(f'{i},5" screen,"two\nlines {i}"\n{i},say ""hi"",x"\n{i},"a"b,c\n' for i in range(200))
    path = put(tmp_dir, "d.csv", "name,ratings,no_of_ratings\n" + body)
    got = CSV._scan(spark, [path], True).drop("_file")
    assert rows(got) == rows(one_task(spark, path)) and got.count() == 600


def test_record_over_many_ranges_blank_lines_and_header(spark, tmp_dir, small_splits):
    long = "\n".join(f"line {i}" for i in range(1000))
    text = f'\n\nname,"rat\nings"\n\n1,"{long}"\n\n\n2,x\n3,"open\nto the end'
    path = put(tmp_dir, "e.csv", text)
    got = sorted(r["record"] for r in csv_records(spark, [path]).collect())
    assert got == ["1,\"" + long + "\"", "2,x", '3,"open\nto the end']
    kept = [r["record"] for r in csv_records(spark, [path], header=False).collect()]
    assert len(kept) == 4 and 'name,"rat\nings"' in kept


def test_many_files_and_layouts(spark, tmp_dir, small_splits):
    want = []
    for i in range(139):
        n = 2 + i % 2
        text = content(i, 6, columns=n)
        put(f"{tmp_dir}/in", f"cat {i}.csv", text)
        want += [r[0] for r in list(csv.reader(io.StringIO(text, newline="")))[1:]]
    got = CSV.read_products(spark, f"{tmp_dir}/in")
    assert sorted(r["name"] for r in got.collect()) == sorted(want)
    assert got.select("source_category").distinct().count() == 139


def test_empty_files(spark, tmp_dir):
    path = put(tmp_dir, "f.csv", "name,ratings\n")
    assert CSV._scan(spark, [path], True).count() == 0
    assert csv_records(spark, [put(tmp_dir, "g.csv", "")]).count() == 0
