import json

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cladeflow.functions.distances import each_with_each, side_by_side
from cladeflow.functions.sequences import masked_hamming
from cladeflow.operators import lineage, pairs, summaries
from cladeflow.plans import reference


def naive(a, b):
    return sum(x != y and x not in "-N" and y not in "-N" for x, y in zip(a, b))


def text(letters):
    return st.lists(st.text(letters, max_size=200), min_size=1, max_size=12)


@settings(max_examples=200, deadline=None)
@given(text("ACGTN-acgtn*"), text("ACGTN-") | text("ACé\U0001f600-N\0"))
def test_distances_of_many(a, b):
    first, second, both = pa.array(a, pa.string()), pa.array(b, pa.string()), pa.array([*a, *b], pa.string())
    want = [[naive(x, y) for y in b] for x in a]
    assert each_with_each(first, second).tolist() == want
    x, y = (i.ravel() for i in np.indices((len(a), len(b))))
    assert side_by_side(both, x, len(a) + y).tolist() == np.ravel(want).tolist()


def sequences(spark, n, length):
    """n tips of two datasets, some sequences shorter, some masked, some missing or empty."""
    seq = F.array_join(F.transform(F.sequence(F.lit(1), length - F.col("id") % 3), lambda k: F.substring(F.lit("ACGTacgtN-"), (F.abs(F.xxhash64("id", k)) % 10).cast("int") + 1, F.lit(1))), "")
    rows = spark.range(n).select(F.col("id").alias("seq_id"), F.concat(F.lit("t_"), F.col("id") % 2).alias("dataset"), F.format_string("tip%05d", "id").alias("name"),
        F.when(F.col("id") % 17 == 3, "").when(F.col("id") % 17 == 4, None).otherwise(seq).alias("seq"))
    return rows.cache()


def test_all_pairs_are_measured_by_blocks(spark):
    alignment = sequences(spark, 400, 70)
    tips = alignment.select("dataset", F.col("name").alias("tip"))
    made = pairs.every_pair(tips, ["dataset"], "tip", alignment)
    assert "zip_with" not in made._jdf.queryExecution().toString().lower()  # no letters of single pairs in arrays: 20 microseconds each
    named = pairs.pairs_within(tips, "dataset", "tip")
    seqs = alignment.where("seq <> ''").select("dataset", "name", "seq")
    want = named.join(seqs.toDF("dataset", "tip1", "a"), ["dataset", "tip1"]).join(seqs.toDF("dataset", "tip2", "b"), ["dataset", "tip2"])
    want = want.select("dataset", "tip1", "tip2", masked_hamming("a", "b").alias("hamming"))
    assert "zip_with" in want._jdf.queryExecution().toString().lower()
    assert made.schema == want.select(made.columns).schema and sorted(made.collect()) == sorted(want.collect())
    assert made.count() > 30_000


def test_drawn_pairs_are_measured_in_bunches(spark, monkeypatch):
    monkeypatch.setattr(pairs, "BUNCH", 700)
    alignment = sequences(spark, 250, 70)
    tips = alignment.select("dataset", F.col("name").alias("tip")).where("dataset = 't_0' or seq_id < 20")
    counted = {}
    for limit in (None, 0, 5_000, 2_000):  # t_0 has 7,750 pairs: all, none, most of them, a sample; t_1 has 45
        made = summaries.bunch_stats(pairs.distances_within(tips, alignment, limit, 7), "a")
        assert "zip_with" not in made._jdf.queryExecution().toString().lower()
        want = summaries.pair_stats(pairs.with_sequences(pairs.pairs_within(tips, "dataset", "tip", limit, 7), alignment), "a")
        assert made.dtypes == want.dtypes and sorted(made.collect()) == sorted(want.collect())
        counted[limit] = {r.dataset: r.a_pairs for r in made.collect()}
    assert counted[0] == {} and counted[None]["t_0"] > counted[5_000]["t_0"] > counted[2_000]["t_0"] > 1_000 and counted[2_000]["t_1"] > 0


def test_numbers_are_drawn_without_a_shuffle_of_them(spark):
    groups = spark.createDataFrame([("k1", 150_000), ("k2", 1_000_000), ("k3", 150_001)], "key string, total long")
    made = pairs.drawn_numbers(groups, "key", 100_000, 42).where("key <> 'k2'")
    exchanges = [line for line in made._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange" in line]
    assert exchanges and all("REPARTITION_BY_NUM" in line for line in exchanges)
    sparse = pairs.drawn_numbers(groups.where("key = 'k2'"), "key", 1_000, 42)
    number = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit("42"), F.lit("k2"), F.col("id").cast("string"))), 1, 15), 16, 10).cast("long") % 1_000_000
    first = list(dict.fromkeys(r[0] for r in spark.range(4_000).select("id", number.alias("n")).orderBy("id").select("n").collect()))[:1_000]
    assert sorted(r.idx for r in sparse.collect()) == sorted(first)


def test_summary_walks_the_paths_once(spark, data_dir, monkeypatch):
    walks = []
    for name in ("forward_frames", "path_steps"):
        walk = getattr(lineage, name, None)
        monkeypatch.setattr(lineage, name, lambda *a, walk=walk: walks.append(1) or walk(*a), raising=False)
    entries = {r.dataset: json.loads(r.entry) for r in reference.summary_document(spark, data_dir).collect()}
    assert len(walks) == 1 and any(e["pairwise_train_pairs"] for e in entries.values())
