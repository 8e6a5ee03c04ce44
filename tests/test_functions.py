from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cladeflow.functions import names, sequences


def one(spark, column, **values):
    return spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} {'int' if isinstance(v, int) else 'string'}" for k, v in values.items())).select(column).first()[0]


def test_names(spark):
    assert one(spark, names.clean_name("n"), n="hCoV-19/A/1/hCoV-19/") == "A/1/hCoV-19/"
    assert one(spark, names.file_stem("n"), n='hCoV-19/A b:c*d?"<>|\\e') == "Abcde"
    assert one(spark, names.label("n"), n=" \t vel-3 ") == "VEL-3"
    assert [one(spark, names.split_of("n"), n=v) for v in (" Test ", "", "  ", None, "TRAIN")] == ["test", "train", "train", "train", "train"]
    assert one(spark, names.is_tip_name("n"), n="hCoV-19/NODE_1") is False
    assert one(spark, names.publish_prefix("n"), n="rdrp-abc-xs_001") == "trajectories/rdrp-abc-xs/subtrees/rdrp-abc-xs_001"
    assert one(spark, names.publish_prefix("n"), n="rdrp-a1-xs_001") == "trajectories/rdrp-a1-xs_001"
    assert one(spark, names.publish_prefix("n"), n="fam-xs_001") == "trajectories/fam-xs_001"


def naive(a, b):
    return sum(x != y and x not in "-N" and y not in "-N" for x, y in zip(a, b))


@settings(max_examples=3, deadline=None)
@given(st.lists(st.tuples(st.text("ACGTN-a", max_size=12), st.text("ACGTN-a", max_size=12)), min_size=20, max_size=60))
def test_masked_hamming(spark, pairs):
    df = spark.createDataFrame(pairs, "a string, b string")
    got = df.select("a", "b", sequences.masked_hamming("a", "b").alias("h"), sequences.masked_hamming("b", "a").alias("r")).collect()
    assert all(r.h == r.r == naive(r.a, r.b) for r in got)


def test_hamming_edges(spark):
    assert one(spark, sequences.masked_hamming("a", "b"), a="", b="A") == 0
    assert one(spark, sequences.masked_hamming("a", "b"), a=None, b="A") is None
    assert one(spark, sequences.masked_hamming("a", "b"), a="ACGT-N", b="AGGTAA") == 1


def test_sequences(spark):
    assert one(spark, sequences.trim("s", "b", "e"), s="ABCDEF", b=2, e=4) == "BCD"
    df = spark.createDataFrame([("ABCDEF", 2, None)], "s string, b int, e int")
    assert df.select(sequences.trim("s", "b", "e")).first()[0] == "ABCDEF"
    assert one(spark, sequences.strip_stops("s"), s="MK*L**") == "MK*L"
    assert one(spark, sequences.has_inner_stop("s"), s="MK*L**") is True
    assert one(spark, sequences.has_inner_stop("s"), s="MKL**") is False
    assert [one(spark, sequences.mutation_position("m"), m=m) for m in ("A12T", "AxT", "G-1", "", "A", "C12", None)] == [12, None, None, None, None, 1, None]
    text = one(spark, sequences.fasta_record(F.lit("h|0"), F.col("s")), s="A" * 120)
    assert text == ">h|0\n" + "A" * 60 + "\n" + "A" * 60 + "\n"
    assert one(spark, sequences.fasta_record(F.lit("h"), F.col("s")), s="A" * 61) == ">h\n" + "A" * 60 + "\nA\n"


def test_substituted(spark):
    df = spark.createDataFrame([("ACGT", [(1, "T"), (4, "-"), (9, "A")])], "s string, c array<struct<pos:int,base:string>>")
    assert df.select(sequences.substituted(F.col("s"), F.col("c"))).first()[0] == "TCG-"


def test_count_mutations(spark):
    df = spark.createDataFrame([(["A1C", "A5G", "AxT"], 2, 9)], "m array<string>, b int, e int")
    assert df.select(sequences.count_mutations("m", "b", "e")).first()[0] == 1
    assert df.select(sequences.count_mutations("m", "b", F.lit(None))).first()[0] == 3
