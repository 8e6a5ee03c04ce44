import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from cladeflow.llm import splits

TARGETS = [("train", 0.8), ("validation", 0.1), ("test", 0.1)]


def naive_components(nodes, links):
    up = {n: n for n in nodes}

    def find(n):
        while up[n] != n:
            n = up[n]
        return n

    for a, b in links:
        if a in up and b in up:
            up[find(a)] = find(b)
    groups = defaultdict(set)
    for n in nodes:
        groups[find(n)].add(n)
    return {frozenset(g) for g in groups.values()}


@pytest.mark.parametrize("seed", range(2))
def test_components(spark, seed):
    rng = random.Random(seed)
    nodes = [f"n{i}" for i in range(150)]
    links = [(f"n{i}", f"n{i + 1}") for i in range(60)] + [(rng.choice(nodes), rng.choice(nodes)) for _ in range(25)]
    links += [(None, "n1"), ("n1", "n1"), ("n2", "unknown"), links[0]]
    got = splits.components(spark.createDataFrame([(n,) for n in nodes + ["n1", None]], "node string"), spark.createDataFrame(links, "a string, b string"))
    groups = defaultdict(set)
    for r in got.collect():
        groups[r.component].add(r.node)
    assert {frozenset(g) for g in groups.values()} == naive_components(nodes, [x for x in links if None not in x])
    assert sum(map(len, groups.values())) == len(nodes)


def test_splits_keep_groups_together(spark):
    rng = random.Random(5)
    rows = [("d%d" % rng.randrange(40), f"t{i}", rng.choice([None, *"ABCDE"]), rng.choice(["train", "train", "test"])) for i in range(3000)]
    rows += [("d0", "two", "A", "train"), ("d0", "two", "B", "train"), ("d1", "half", None, "test"), ("d1", "half", "C", "test")]
    entities = spark.createDataFrame(rows, "dataset string, name string, clade string, split string")
    targets = spark.createDataFrame(TARGETS, "split_name string, proportion double")
    got = splits.grouped_splits(entities, targets).collect()
    assert len(got) == len(rows)
    seen = defaultdict(set)
    for r in got:
        if r.clade is not None:
            seen[r.dataset, r.clade].add(r.new_split)
        seen["tip", r.dataset, r.name].add(r.new_split)
    assert all(len(s) == 1 and None not in s for s in seen.values())
    assert seen["d0", "A"] == seen["d0", "B"]
    share = Counter(r.new_split for r in got)
    assert abs(share["train"] / len(rows) - 0.8) < 0.1 and min(share["validation"], share["test"]) > 0.03 * len(rows)
    want = {(d, c) for d, c in {(r[0], r[2]) for r in rows if r[2]} if len({r[3] for r in rows if (r[0], r[2]) == (d, c)}) > 1}
    assert {tuple(r) for r in splits.scattered_groups(entities).collect()} == want


def test_dirt(spark):
    metadata = spark.createDataFrame(
        [("d", "hCoV-19/a", " x "), ("d", "a", "X"), ("d", "NODE_1", "X"), (None, "b", "X"), ("d", None, "X"), ("d", "c", None)],
        "dataset string, name string, clade_membership string",
    ).withColumn("split", F.lit("clash"))
    branches = spark.createDataFrame([("d", "a", "TEST ", 1), ("d", "a", "", 0), ("d", None, "test", 1)], "dataset string, child string, train_test string, exported_at int")
    got = {tuple(r) for r in splits.tip_entities(metadata, branches).collect()}
    assert got == {("d", "a", "X", "test"), ("d", "c", None, "train")}
    empty = splits.tip_entities(metadata.limit(0), branches.limit(0))
    assert splits.grouped_splits(empty, spark.createDataFrame(TARGETS, "split_name string, proportion double")).count() == 0
    assert splits.scattered_groups(empty).count() == 0
