"""Test clades grown from random seed tips until a share of the tips is reached.

Whether a seed counts depends on all seeds before it, so seeds are taken in chunks of their random
order. In a chunk, seeds that earlier clades cover are dropped by a join, and one task a dataset decides
on the rest of the chunk, on a bounded number of intervals of tip numbers.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cladeflow.operators.dense_ids import ordinals
from cladeflow.operators.intervals import interval_blocks, point_blocks
from cladeflow.operators.lineage import MUTATIONS_BACK, TEST_PROPORTION, below, walk_back, with_settings
from cladeflow.session import written

# Defaults of the settings.
MAX_CLADE_PROPORTION = 0.01
SEED = 42
#: Seeds of a dataset that one round decides on.
CHUNK = 4096

_ACCEPTED = "dataset string, clade_root string, low long, size long, added long"


def decide(seeds: list[tuple[int, int, int, int]], missing: int) -> list[tuple[int, int]]:
    """[(place in seeds, tips added)] of the accepted seeds, in order, until `missing` tips are added.

    A seed is (tip number, low, size, tips of its clade that earlier rounds marked), its clade within the
    size cap. A seed that an accepted clade covers is skipped.
    """
    clades: list[tuple[int, int, int]] = []  # low, end, tips that this clade brought
    accepted = []
    for no, (tip, low, size, marked) in enumerate(seeds):
        if missing <= 0:
            break
        if any(a <= tip < b for a, b, _ in clades):
            continue
        inner = sum(n for a, b, n in clades if low <= a and b <= low + size)
        added = size - marked - inner
        clades = [c for c in clades if not (low <= c[0] and c[1] <= low + size)] + [(low, low + size, size - marked)]
        accepted.append((no, added))
        missing -= added
    return accepted


def _checked(name: str, right: Column) -> Column:
    """The setting, or an error that names it where it is out of range; null stands for the default."""
    return F.when(F.col(name).isNull() | right, F.col(name)).otherwise(F.raise_error(F.concat(F.lit(f"{name} is out of range: "), F.col(name).cast("string"))))


def random_clades(nodes: DataFrame, links: DataFrame, tips: DataFrame, analyses: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """dataset, node, split: all nodes below the accepted clade roots are test, the others train.

    Tips are seeds in the order of md5(seed:name). From a seed the tree is walked back until the branches'
    distances reach mutations_back; the clade found is skipped if it holds more than
    int(tips * max_clade_proportion) tips. nodes: placed_nodes() of the links. The last clade may overshoot max(1, int(tips * test_proportion)).
    """
    if chunk < 1:
        raise ValueError("chunk must be at least 1")
    for name in ("test_proportion", "max_clade_proportion"):
        analyses = analyses.withColumn(name, _checked(name, F.col(name).between(0, 1)))
    analyses = analyses.withColumn("mutations_back", _checked("mutations_back", F.col("mutations_back") >= 0))
    value = lambda name, default: F.coalesce(name, F.lit(default)).alias(name)
    settings = analyses.select(
        "analysis",
        value("test_proportion", TEST_PROPORTION),
        value("max_clade_proportion", MAX_CLADE_PROPORTION),
        value("seed", SEED),
        value("mutations_back", MUTATIONS_BACK),
    )
    numbered = nodes.where("size = 1").select("dataset", F.col("node").alias("tip"), F.col("leaf_at").alias("no"), F.col("n_tips").alias("n"))
    spans = nodes.select("dataset", F.col("node").alias("clade_root"), F.col("leaf_at").alias("low"), F.col("n_leaves").alias("size"))
    goal = with_settings(numbered.select("dataset", "n").distinct(), settings).select(
        "dataset",
        F.coalesce("seed", F.lit(SEED)).alias("seed"),
        F.greatest(F.lit(1), F.floor(F.col("n") * F.coalesce("test_proportion", F.lit(TEST_PROPORTION)))).alias("goal"),
        F.floor(F.col("n") * F.coalesce("max_clade_proportion", F.lit(MAX_CLADE_PROPORTION))).alias("cap"),
    )
    goal = written(goal, "goal")
    seeds = walk_back(links, tips, analyses).join(spans, ["dataset", "clade_root"]).join(numbered.select("dataset", "tip", "no"), ["dataset", "tip"])
    seeds = seeds.join(goal, "dataset").withColumn("lot", F.md5(F.concat_ws(":", F.col("seed").cast("string"), "tip")))
    order = ordinals(seeds, ["dataset"], ["lot", "tip"], "turn").select("dataset", "tip", "turn")
    seeds = written(seeds.join(order, ["dataset", "tip"]).select("dataset", "tip", "turn", "no", "clade_root", "low", "size", "cap"), "seeds")
    accepted = seeds.sparkSession.createDataFrame([], _ACCEPTED)
    last = seeds.agg(F.max("turn")).first()[0]
    start = 0
    while last is not None and start <= last:
        here = seeds.where(F.col("turn").between(start, start + chunk - 1) & (F.col("size") <= F.col("cap")))
        blocks = interval_blocks(accepted.select("dataset", F.col("low").alias("a_low"), F.col("size").alias("a_size")), "a_low", "a_size").distinct()
        tips_at = point_blocks(numbered.select("dataset", "no", "n"), "no", "n")
        marked = written(tips_at.join(blocks, ["dataset", "level", "block"]).select("dataset", "no").distinct(), "marked")
        open_seeds = here.join(marked, ["dataset", "no"], "left_anti")
        within = interval_blocks(open_seeds, "low", "size").join(
            point_blocks(marked.join(numbered.select("dataset", "no", "n"), ["dataset", "no"]), "no", "n").select("dataset", F.col("no").alias("m"), "level", "block"),
            ["dataset", "level", "block"],
        )
        inner = within.groupBy("dataset", "tip").agg(F.count("*").alias("marked"))
        gone = accepted.groupBy("dataset").agg(F.sum("added").alias("gone"))
        ready = open_seeds.join(inner, ["dataset", "tip"], "left").join(goal.select("dataset", "goal"), "dataset").join(gone, "dataset", "left")
        ready = ready.fillna(0, ["marked", "gone"]).where("gone < goal")

        def run(pdf: pd.DataFrame) -> pd.DataFrame:
            pdf = pdf.sort_values("turn")
            rows = list(zip(pdf.no, pdf.low, pdf["size"], pdf.marked))
            got = decide(rows, int(pdf.goal.iloc[0] - pdf.gone.iloc[0]))
            out = pdf.iloc[[no for no, _ in got]][["dataset", "clade_root", "low", "size"]].copy()
            out["added"] = [added for _, added in got]
            return out

        fresh = ready.groupBy("dataset").applyInPandas(run, _ACCEPTED)
        accepted = written(accepted.unionByName(fresh), "accepted")
        start += chunk
        done = accepted.groupBy("dataset").agg(F.sum("added").alias("gone")).join(goal, "dataset").where("gone >= goal").count()
        if done == goal.count():
            break
    test = below(nodes, accepted.select("dataset", F.col("clade_root").alias("node"))).withColumn("split", F.lit("test"))
    return nodes.select("dataset", "node").join(test, ["dataset", "node"], "left").select("dataset", "node", F.coalesce("split", F.lit("train")).alias("split"))
