"""Splits that keep related records together, from connected components.

Records and the groups that they name form a graph. Its components are found by breadth-first search from
many seeds at once: the adjacency lists stay partitioned by node, a frontier of labelled nodes is joined
with them, and where two searches meet, their labels become a link of a small graph, which is solved the
same way. Whole components are then laid out by hash and cut at the wanted shares.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cladeflow.functions.names import clean_name, is_tip_name, label
from cladeflow.llm.overlap import node_splits
from cladeflow.session import Steps

#: Of the nodes with neighbours one in so many starts a search at once.
SEED_EVERY = 8
#: Slices of the hash order for the running sum over components.
SLICES = 4096


def components(nodes: DataFrame, links: DataFrame, level: int = 0) -> DataFrame:
    """(node, component) for every node; links are (a, b), in any direction, repeated or not.

    component is the smallest hash among the component's searches, with the node it started from, as text, so
    equal inputs have equal components. Links to unknown nodes, nulls and self-links are left out. A node without links
    is a component of its own.
    """
    spark, steps = nodes.sparkSession, Steps(nodes.sparkSession, f"components{level}")
    nodes = steps.put("nodes", nodes.select("node").dropna().distinct())
    both = links.select("a", "b").dropna().where("a <> b")
    both = both.join(nodes.toDF("a"), "a", "left_semi").join(nodes.toDF("b"), "b", "left_semi")
    edges = steps.put("edges", both.unionByName(both.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    lot = F.xxhash64("node", F.lit(level))
    name = F.concat_ws(" ", F.format_string("%016x", lot), "node")
    linked, seen = steps.measured("linked", edges.select(F.col("a").alias("node")).distinct(), n=F.count("*"))
    alone = nodes.join(linked, "node", "left_anti").select("node", name.alias("label"))
    if not seen["n"]:
        return alone.withColumnRenamed("label", "component")
    fresh = linked.where(F.pmod(lot, F.lit(SEED_EVERY)) == 0).select("node", name.alias("label"))
    fronts: list[str] = []
    while True:  # a round writes the nodes that it labels, and reads all labels in one scan
        slot = f"front{len(fronts)}"
        frontier, seen = steps.measured(slot, fresh, n=F.count("*"))
        fronts.append(steps.held[slot])
        labelled = spark.read.schema(frontier.schema).parquet(*fronts)
        if seen["n"]:
            reached = frontier.join(edges.toDF("node", "next"), "node").groupBy(F.col("next").alias("node")).agg(F.min("label").alias("label"))
            fresh = reached.join(labelled.select("node"), "node", "left_anti").select("node", "label")
            continue
        # what no search reached: every node that drew the lowest lot among its unlabelled neighbours starts one
        rest = linked.join(labelled.select("node"), "node", "left_anti").withColumn("lot", F.struct(lot.alias("h"), "node"))
        rest, seen = steps.measured("rest", rest, n=F.count("*"))
        if not seen["n"]:
            break
        around = edges.toDF("node", "next").join(rest.select(F.col("node").alias("next"), F.col("lot").alias("other")), "next")
        least = around.groupBy("node").agg(F.min("other").alias("least"))
        fresh = rest.join(least, "node", "left").where("least is null or lot < least").select("node", name.alias("label"))
    ends = edges.join(labelled.toDF("a", "label_a"), "a").join(labelled.toDF("b", "label_b"), "b")
    met = ends.where("label_a < label_b").select(F.col("label_a").alias("a"), F.col("label_b").alias("b")).distinct()
    met, seen = steps.measured("met", met, n=F.count("*"))
    labels = labelled.select(F.col("label").alias("node")).distinct()
    if seen["n"]:
        merged = components(labels, met, level + 1)
        merged = merged.groupBy("component").agg(F.min("node").alias("first")).join(merged, "component").select(F.col("node").alias("label"), "first")
        labelled = labelled.join(merged, "label").select("node", F.col("first").alias("label"))
    return alone.unionByName(labelled).withColumnRenamed("label", "component")


def assign_splits(members: DataFrame, targets: DataFrame, key: str = "component") -> DataFrame:
    """(key, new_split) for every component, whole, in the order of their hashes.

    members: one row per record with its component. targets: split_name, proportion (a few rows, scaled to
    sum up to 1). A component lies in the split that the middle of its stretch of the running record count falls
    into. The running sum is taken within slices of the hash range and shifted by the slices before, so no
    task sees more than a slice. No targets, no rows.
    """
    sizes = members.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n"))
    order = F.xxhash64(key)
    placed = sizes.withColumn("order", order).withColumn("slice", F.pmod(F.shiftright(order, 48), F.lit(SLICES)))
    within = Window.partitionBy("slice").orderBy("order", key).rowsBetween(Window.unboundedPreceding, -1)
    before = Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = placed.groupBy("slice").agg(F.sum("n").alias("slice_n"))
    slices = slices.select("slice", F.coalesce(F.sum("slice_n").over(before), F.lit(0)).alias("shift"))
    at = placed.withColumn("inside", F.coalesce(F.sum("n").over(within), F.lit(0))).join(F.broadcast(slices), "slice")
    middle = (F.col("shift") + F.col("inside") + F.col("n") / 2) / F.col("total")
    running = Window.orderBy(F.col("proportion").desc(), "split_name")
    whole = Window.partitionBy()
    bounds = targets.where("proportion > 0").select(
        F.col("split_name").alias("new_split"),
        (F.sum("proportion").over(running) / F.sum("proportion").over(whole)).alias("high"),
        ((F.sum("proportion").over(running) - F.col("proportion")) / F.sum("proportion").over(whole)).alias("low"),
        (F.row_number().over(running) == F.count("*").over(whole)).alias("last"),
    )
    total = sizes.agg(F.sum("n").alias("total"))
    spot = at.crossJoin(F.broadcast(total)).select(key, middle.alias("middle"))
    return spot.join(F.broadcast(bounds), (F.col("middle") >= F.col("low")) & ((F.col("middle") < F.col("high")) | F.col("last"))).select(key, "new_split")


def tip_entities(metadata: DataFrame, branches: DataFrame) -> DataFrame:
    """dataset, name, clade, split: the distinct rows of the tips, clade null where none is given.

    The split is the tip's present one; of its rows in branches the one exported last counts.
    """
    tips = metadata.where(is_tip_name("name") & F.col("dataset").isNotNull()).select(
        "dataset", clean_name("name").alias("name"), label("clade_membership").alias("clade")
    )
    return tips.distinct().join(node_splits(branches), ["dataset", "name"], "left").select("dataset", "name", "clade", F.coalesce("split", F.lit("train")).alias("split"))


def grouped_splits(entities: DataFrame, targets: DataFrame) -> DataFrame:
    """dataset, name, clade, split, component, new_split for every row of entities.

    All tips of one dataset with one clade are in one component, and so are clades that share a tip (exports
    may differ). A tip without a clade is a component of its own unless another of its rows has one.
    """
    tip = F.to_json(F.struct(F.lit("tip").alias("k"), "dataset", "name"))
    group = F.to_json(F.struct(F.lit("clade").alias("k"), "dataset", "clade"))
    keyed = entities.select("*", tip.alias("tip"), F.when(F.col("clade").isNotNull(), group).alias("group"))
    # a tip with one group adds nothing to the graph; with several it links the first to each other
    firsts = keyed.groupBy("tip").agg(F.min("group").alias("home"))
    homes = keyed.join(firsts, "tip").select(*entities.columns, F.coalesce("home", "tip").alias("home"), "group")
    steps = Steps(entities.sparkSession, "entities")
    homes = steps.put("homes", homes)
    nodes = homes.select(F.col("home").alias("node")).unionAll(homes.where("group is not null").select("group"))
    links = homes.where("group is not null and group <> home").select(F.col("home").alias("a"), F.col("group").alias("b"))
    found = steps.put("found", components(nodes, links))
    rows = homes.join(found.select(F.col("node").alias("home"), "component"), "home")
    once = rows.select("dataset", "name", "component").distinct()
    return rows.join(assign_splits(once, targets), "component", "left").select(*entities.columns, "component", "new_split")


def scattered_groups(entities: DataFrame) -> DataFrame:
    """dataset, clade_membership of the groups whose tips lie in more than one split."""
    groups = entities.where("clade is not null").groupBy("dataset", "clade").agg(F.min("split").alias("low"), F.max("split").alias("high"))
    return groups.where("low <> high").select("dataset", F.col("clade").alias("clade_membership"))
