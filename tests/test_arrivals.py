"""CSV files of several headers in batch and stream, and claims that several batches bring."""

import gzip
import os

from pyspark.sql import types as T

from policylake.sources import ingest
from policylake.streaming import arrivals

TARGET = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType()), T.StructField("amount", T.DoubleType())])


def files(folder):
    folder.mkdir()
    (folder / "a.csv").write_text('id,name,amount\n1,"one, first",1.5\n2,two,x\n')
    (folder / "b.csv").write_text("AMOUNT,other,id\n3.5,z,3\n")
    (folder / "c.csv").write_text("name\nnobody\n")
    (folder / "empty.csv").write_text("")
    (folder / "_hidden.csv").write_text("id\n9\n")
    with gzip.open(folder / "d.csv.gz", "wt") as f:
        f.write("name,id\nfour,4\n")
    return str(folder)


WHOLE = {(1, "one, first", 1.5), (2, "two", None), (3, None, 3.5), (None, "nobody", None), (4, "four", None)}


def test_csv_files_of_several_headers(spark, tmp_path):
    path = files(tmp_path / "in")
    groups = ingest.csv_headers(spark, path)
    assert {h: len(f) for h, f in groups.items()} == {("id", "name", "amount"): 1, ("AMOUNT", "other", "id"): 1, ("name",): 1, ("name", "id"): 1}
    assert {c.lower() for c in ingest.csv_header(spark, path)} == {"id", "name", "amount", "other"}
    rows = ingest.conform(ingest.read_csv(spark, path), TARGET)
    assert {tuple(r) for r in rows.collect()} == WHOLE
    assert ingest.read_csv(spark, str(tmp_path / "none")) is None


def test_streamed_files_of_several_headers(spark, tmp_path):
    path, out, bad, state = files(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "bad"), str(tmp_path / "state")
    arrivals.append_files(arrivals.csv_files(spark, path), TARGET, out, bad, state).awaitTermination()
    (tmp_path / "in" / "e.csv").write_text("id,name,more\n5,five,m,too many\n6,six,m\n")
    arrivals.append_files(arrivals.csv_files(spark, path), TARGET, out, bad, state).awaitTermination()
    got = arrivals.read_arrivals(spark, out, TARGET)
    assert {tuple(r)[:3] for r in got.collect()} == {r for r in WHOLE if r[0] != 2} | {(6, "six", None)}
    assert got.filter("arrival_batch = 1").count() == 1
    refused = spark.read.option("mergeSchema", True).parquet(bad)
    assert {r["reason"] for r in refused.collect()} == {"amount", "corrupt line"}


def test_a_claim_comes_once(spark, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))

    def deliver(ids):
        spark.createDataFrame([(i, "x") for i in ids], "claimid string, v string").coalesce(1).write.mode("append").parquet(source)
        stream = arrivals.first_arrivals(spark.readStream.schema("claimid string, v string").parquet(source))
        query = stream.writeStream.option("checkpointLocation", state).trigger(availableNow=True).format("parquet").start(out)
        query.awaitTermination()

    deliver(["c1", "c2", None, "c2"])
    deliver([" C1 ", "c3", None])  # a restart in between: the state comes from the checkpoint
    deliver(["c3", "c2"])
    assert sorted(r["claim_id"] for r in spark.read.parquet(out).collect()) == ["c1", "c2", "c3"]
    assert os.path.isdir(f"{state}/state")
    assert spark.read.parquet(out).columns == ["claim_id", "v"]
