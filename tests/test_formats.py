import datetime as dt
import json
import os

import zstandard
from pyspark.sql import functions as F

from cladeflow.operators import lineage, nested
from cladeflow.sources import formats, writers
from cladeflow.streaming import arrivals
from tests.tree_example import BRANCH_SCHEMA, SEQUENCES, branch_rows, tree_document


def test_fasta(spark, tmp_path):
    (tmp_path / "a.fasta").write_text(">x y z\nACGT\nAC GT\n\n>empty\n>w|3\r\nAC\r\n")
    (tmp_path / "b.fasta").write_text("")
    got = {(r.id, r.description, r.seq) for r in formats.read_fasta(spark, str(tmp_path / "*.fasta")).collect()}
    assert got == {("x", "y z", "ACGTACGT"), ("empty", "", ""), ("w|3", "", "AC")}


def test_fasta_of_many_splits(spark, tmp_path):
    want = {f"n{i}": "ACGT" * (i % 50) for i in range(2000)}
    (tmp_path / "big.fasta").write_text("".join(f">{n}\n{s}\n" for n, s in want.items()))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "20k")
        df = formats.read_fasta(spark, str(tmp_path))
        assert df.rdd.getNumPartitions() > 3
        assert {r.id: r.seq for r in df.collect()} == want
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_branches_round_trip(spark, tmp_path):
    rows = branch_rows() + [("t_0001", "c", "new", "?", None, None)]
    links = lineage.tree_links(spark.createDataFrame(rows, BRANCH_SCHEMA))
    writers.write_branches(links, str(tmp_path / "branches"))
    back = formats.read_branches(spark, str(tmp_path / "branches"))
    same = links.select("parent", "child", "hamming", F.col("split").alias("train_test"))
    assert {tuple(r) for r in back.collect()} == {tuple(r) for r in same.collect()}


def test_tree_files(spark, tmp_path):
    (tmp_path / "t_0001.json").write_text(json.dumps(tree_document()))
    (tmp_path / "t_0001_root-sequence.json").write_text('{"nuc": "ACGT"}')
    docs = formats.read_tree_documents(spark, str(tmp_path))
    assert [r.dataset for r in docs.collect()] == ["t_0001"]
    assert nested.nodes_table(nested.flatten_documents(docs)).count() == len(SEQUENCES)
    assert [tuple(r) for r in formats.read_root_sequences(spark, str(tmp_path)).collect()] == [("t_0001", "nuc", "ACGT")]
    (tmp_path / ".DS_Store").write_text("x")
    assert formats.list_files(spark, str(tmp_path)).count() == 2
    names = spark.createDataFrame([("a",), ("b",)], "dataset string")
    assert [r.dataset for r in formats.new_datasets(names, names.where("dataset = 'a'")).collect()] == ["b"]


def test_write_files(spark, tmp_path):
    rows = spark.createDataFrame([("d/a.fasta", ">x\nA\n"), ("d/b.fasta", ""), (None, "x"), ("d/c.fasta", None)], "file_path string, content string")
    assert {tuple(r) for r in writers.write_files(rows, str(tmp_path)).collect()} == {("d/a.fasta", 5), ("d/b.fasta", 0)}
    assert sorted(os.listdir(tmp_path / "d")) == ["a.fasta", "b.fasta"]
    writers.write_files(rows, str(tmp_path / "z"), compress=True).collect()
    assert zstandard.ZstdDecompressor().decompress((tmp_path / "z/d/a.fasta.zst").read_bytes()) == b">x\nA\n"


def test_streams(spark, tmp_path):
    day = lambda d: dt.datetime(2024, 1, d)
    row = lambda i, text, d: (i, "p", "d", "forwards-train", "a.fasta", text, len(text), day(d))
    folder, table = tmp_path / "in", str(tmp_path / "table")
    put = lambda n, rows: spark.createDataFrame(rows, arrivals.SCHEMA).coalesce(1).write.parquet(str(folder / f"batch={n}"))
    put(1, [row(1, ">x\nA", 1), row(1, ">x\nA", 1), row(2, ">x\nC", 2)])
    put(2, [row(3, ">x\nG", 25), row(4, "", 26)])
    stream = arrivals.file_stream(spark, str(folder))
    query = arrivals.arrival_counts(stream).writeStream.outputMode("append").format("memory").queryName("arrived").option("checkpointLocation", str(tmp_path / "c1")).trigger(availableNow=True).start()
    query.awaitTermination(120)
    got = {(r.start.day, r.n_files) for r in spark.table("arrived").collect()}
    assert got <= {(1, 1), (2, 1), (25, 1), (26, 1)} and {(1, 1), (2, 1)} <= got
    versions = []
    read = lambda: spark.read.parquet(versions[-1]) if versions else None

    def write(df):
        versions_path = f"{table}-{len(versions)}"
        df.write.parquet(versions_path)
        versions.append(versions_path)

    merge = arrivals.keep_current(["forwards-train"], read, write)
    query = stream.writeStream.foreachBatch(merge).option("checkpointLocation", str(tmp_path / "c2")).trigger(availableNow=True).start()
    query.awaitTermination(120)
    merge(spark.read.schema(arrivals.SCHEMA).parquet(str(folder)), 9)
    assert [r.file_id for r in spark.read.parquet(versions[-1]).collect()] == [3]


def test_summary_round_trip(spark, tmp_path):
    entries = spark.createDataFrame([('a"b', '{"n":1}'), ("c", '{"n":2,"m":{"k":1.5}}'), (None, "{}")], "dataset string, entry string")
    writers.write_summary(entries, str(tmp_path / "summary"))
    assert {tuple(r) for r in formats.read_summary(spark, str(tmp_path / "summary")).collect()} == {tuple(r) for r in entries.where("dataset is not null").collect()}
    (tmp_path / "one.json").write_text(json.dumps({"x": {"n": 1}, "y": {}}, indent=2))
    assert {r.dataset: json.loads(r.entry) for r in formats.read_summary(spark, str(tmp_path / "one.json")).collect()} == {"x": {"n": 1}, "y": {}}


def test_fasta_and_metadata_files(spark, tmp_path):
    records = spark.createDataFrame([(">a\nACGT\n",), (">b\nAC\n",), (">empty\n",)], "record string")
    writers.write_fasta(records, str(tmp_path / "f"))
    assert {(r.id, r.seq) for r in formats.read_fasta(spark, str(tmp_path / "f")).collect()} == {("a", "ACGT"), ("b", "AC"), ("empty", "")}
    lines = spark.createDataFrame([(1, 5, "b"), (1, -1, "head"), (1, 2, "a"), (2, -1, "h2")], "record_id long, place long, line string")
    writers.write_metadata(lines, str(tmp_path / "m"))
    text = "".join(f.read_text() for f in sorted((tmp_path / "m" / "record_id=1").glob("*.txt")))
    assert text.split() == ["head", "a", "b"]


def test_files_by_address(spark, tmp_path):
    rows = spark.createDataFrame([("d/a.fasta", "x")], "file_path string, content string")
    writers.write_files(rows, f"file://{tmp_path}/out").collect()
    assert (tmp_path / "out/d/a.fasta").read_text() == "x" and os.listdir(tmp_path / "out/d") == ["a.fasta"]
