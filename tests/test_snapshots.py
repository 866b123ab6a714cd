"""Versions of stored tables: readers during writes, failed writes, races, key ranges, removal."""

import threading

import pytest
from pyspark.sql import functions as F

from policylake.sources import snapshots, tables


def numbers(spark, n, start=0):
    return spark.range(start, start + n).select(F.col("id").alias("k"), (F.col("id") % 7).alias("v"))


def test_versions_stay_whole(spark, tmp_path):
    root, path = str(tmp_path), tables.table_path(str(tmp_path), "z.t")
    tables.write_table(numbers(spark, 100), root, "z.t", "replace", "k")
    old = tables.read_table(spark, root, "z.t")
    tables.write_table(numbers(spark, 30, 500), root, "z.t", "replace", "k")
    tables.write_table(numbers(spark, 5, 1000), root, "z.t", "append", "k")
    assert old.count() == 100  # opened before the replacement
    assert [tables.read_table(spark, root, "z.t", v).count() for v in snapshots.versions(spark, path)] == [100, 30, 35]
    assert tables.read_table(spark, root, "z.t").agg(F.min("k"), F.max("k")).first() == (500, 1004)
    with pytest.raises(ValueError, match="no version 9"):
        tables.read_table(spark, root, "z.t", 9)
    # From the table itself, which could not be overwritten in place.
    tables.write_table(tables.read_table(spark, root, "z.t").filter("k < 510"), root, "z.t", "replace", "k")
    assert tables.read_table(spark, root, "z.t").count() == 10
    assert snapshots.remove_old_versions(spark, path, keep=2) == [1, 2]
    assert [tables.read_table(spark, root, "z.t", v).count() for v in snapshots.versions(spark, path)] == [35, 10]


def test_a_failed_write_leaves_the_old_version(spark, tmp_path):
    root = str(tmp_path)
    tables.write_table(numbers(spark, 50), root, "z.t", "replace", "k")
    broken = numbers(spark, 50).withColumn("v", F.when(F.col("k") < 49, F.col("v")).otherwise(F.raise_error(F.lit("broken")).cast("long")))
    with pytest.raises(Exception, match="broken"):
        tables.write_table(broken, root, "z.t", "replace", "k")
    with pytest.raises(ValueError, match="null or repeated"):
        tables.write_table(numbers(spark, 2, 49), root, "z.t", "append", "k")
    assert tables.read_table(spark, root, "z.t").count() == 50


def test_two_writers(spark, tmp_path, monkeypatch):
    root, path = str(tmp_path), tables.table_path(str(tmp_path), "z.t")
    tables.write_table(numbers(spark, 10), root, "z.t", "replace", "k")
    taken = snapshots.read_version(spark, path)
    assert not snapshots.commit(spark, path, taken)
    write, other = snapshots.write_folder, []

    def overtaken(df, where, key):
        name = write(df, where, key)
        if other:
            start = other.pop()
            tables.write_table(numbers(spark, 10, start), root, "z.t", "append", "k")
        return name

    monkeypatch.setattr(snapshots, "write_folder", overtaken)
    other.append(200)
    tables.write_table(numbers(spark, 10, 100), root, "z.t", "append", "k")
    assert tables.read_table(spark, root, "z.t").count() == 30
    other.append(305)
    with pytest.raises(ValueError, match="null or repeated"):  # the other one added the same keys meanwhile
        tables.write_table(numbers(spark, 10, 300), root, "z.t", "append", "k")
    assert tables.read_table(spark, root, "z.t").groupBy("k").count().filter("count > 1").isEmpty()


def test_a_reader_during_replacements(spark, tmp_path):
    root, seen, stop = str(tmp_path), [], threading.Event()
    tables.write_table(numbers(spark, 100), root, "z.t", "replace")

    def read():
        while not stop.is_set():
            seen.append(tables.read_table(spark, root, "z.t").count())

    reader = threading.Thread(target=read)
    reader.start()
    try:
        for n in (200, 300, 400):
            tables.write_table(numbers(spark, n), root, "z.t", "replace")
    finally:
        stop.set()
        reader.join()
    assert seen and set(seen) <= {100, 200, 300, 400} and seen == sorted(seen)


def test_an_append_reads_few_files(spark, tmp_path):
    root, path = str(tmp_path), tables.table_path(str(tmp_path), "z.t")
    for start in range(0, 4000, 500):
        tables.write_table(numbers(spark, 500, start), root, "z.t", "append", "k")
    version = snapshots.read_version(spark, path)
    every = snapshots.index_of(spark, path, version)
    assert every.agg(F.sum("rows")).first()[0] == 4000 and every.count() >= 8
    fresh = numbers(spark, 20, 9000).select("k")
    assert snapshots.files_that_may_hold(spark, path, version, fresh) == []
    ends = numbers(spark, 3).unionByName(numbers(spark, 3, 3990)).select("k")  # far apart: what lies between is no candidate
    assert 2 <= len(snapshots.files_that_may_hold(spark, path, version, ends)) <= 3
    assert tables._present_keys(spark, path, version, ends) != []
    assert tables._present_keys(spark, path, version, fresh) == []


def test_a_plain_folder_becomes_a_versioned_table(spark, tmp_path):
    root, path = str(tmp_path), tables.table_path(str(tmp_path), "z.t")
    numbers(spark, 10).write.parquet(path)
    assert tables.read_table(spark, root, "z.t").count() == 10
    with pytest.raises(ValueError, match="null or repeated"):
        tables.write_table(numbers(spark, 10, 5), root, "z.t", "append", "k")
    tables.write_table(numbers(spark, 10, 10), root, "z.t", "append", "k")
    assert tables.read_table(spark, root, "z.t").count() == 20 == spark.read.parquet(path).count() + 10
    tables.write_table(numbers(spark, 7), root, "z.t", "replace", "k")
    assert snapshots.remove_old_versions(spark, path) == [1]
    assert tables.read_table(spark, root, "z.t").count() == 7 and spark.read.parquet(f"{path}/_data/*").count() == 7


def test_columns_keep_their_values_under_new_names(spark, tmp_path):
    root, path = str(tmp_path), tables.table_path(str(tmp_path), "z.t")
    tables.write_table(numbers(spark, 3), root, "z.t", "replace", "k")
    snapshots.rename_columns(spark, path, {"v": "w"})
    more = numbers(spark, 2, 10).withColumnRenamed("v", "W").withColumn("extra", F.lit("e"))
    with pytest.raises(ValueError, match="differ"):
        tables.write_table(more, root, "z.t", "append", "k")
    tables.write_table(more, root, "z.t", "append", "k", add_columns=True)
    tables.write_table(numbers(spark, 1, 20).select("k", F.lit("f").alias("v")), root, "z.t", "append", "k", add_columns=True)  # v again: a new column
    now = tables.read_table(spark, root, "z.t")
    assert now.columns == ["k", "w", "extra", "v"]
    assert {tuple(r) for r in now.collect()} == {(0, 0, None, None), (1, 1, None, None), (2, 2, None, None), (10, 3, "e", None), (11, 4, "e", None), (20, None, None, "f")}
    assert tables.read_table(spark, root, "z.t", 1).columns == ["k", "v"]
    assert snapshots.schema_changes(spark, path, 1, 4) == [(2, "v", "w", "renamed"), (3, None, "extra", "added"), (4, None, "v", "added")]
    assert snapshots.schema_changes(spark, path, 4, 2) == [(3, "extra", None, "removed"), (4, "v", None, "removed")]
    with pytest.raises(ValueError, match="repeated"):
        tables.write_table(more.limit(1), root, "z.t", "append", "k", add_columns=True)
    with pytest.raises(ValueError, match="one name"):
        snapshots.rename_columns(spark, path, {"w": "EXTRA"})
    with pytest.raises(ValueError, match="no columns"):
        snapshots.rename_columns(spark, path, {"nothing": "x"})
