"""Parent-child rows to hierarchies: cycles by peeling, everything else by Euler tours.

Cycles. Links are peeled from both ends: a link to a node without children, or from a node without
parents, lies on no cycle. Between peelings, links in a row are spliced: a node with one parent and one
child is taken out and its parent linked to its child, if it drew a lower lot than both (no two of
these are neighbours), so that the number of rounds grows with the logarithm of the depth and not with the depth. What is left
is a core in which every node has several parents or children; its strong components are found by colours,
with a row a node or link. A spliced node is on a cycle exactly if the link that took its place is.

Hierarchies. Without the cycle nodes and with one parent a node the links form a forest. Every node
contributes an arc down to it and an arc up from it; the arcs of a tree form one list, the Euler tour,
and pointer jumping ranks all lists at once. Entry and exit ranks give depth, root and descendants;
ancestors come from interval containment, joined over dyadic blocks of the entry ranks.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cladeflow.functions.names import clean_name
from cladeflow.operators.dense_ids import dense_ids
from cladeflow.operators.intervals import interval_blocks, point_blocks
from cladeflow.operators.jumping import along_paths, last_known, summed
from cladeflow.session import Steps, written


def named_links(branches: DataFrame) -> DataFrame:
    """The distinct links (dataset, parent, child) of a branch table, names without prefix.

    Rows whose dataset, parent or child is null, and repeated rows, add no link.
    """
    return (
        branches.select("dataset", clean_name("parent").alias("parent"), clean_name("child").alias("child")).dropna().distinct()
    )


def numbered(links: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Links as (u, v) by node number, and the table (dataset, node, id) of the numbers."""
    nodes = links.select("dataset", F.col("parent").alias("node")).unionAll(links.select("dataset", F.col("child").alias("node")))
    ids = dense_ids(nodes, ["dataset", "node"], "id")
    parents = ids.select("dataset", F.col("node").alias("parent"), F.col("id").alias("u"))
    children = ids.select("dataset", F.col("node").alias("child"), F.col("id").alias("v"))
    return links.join(parents, ["dataset", "parent"]).join(children, ["dataset", "child"]).select("u", "v"), ids


def _lot(node: str, turn: int) -> Column:
    return F.xxhash64(F.col(node), F.lit(turn))


def cycle_ids(edges: DataFrame) -> DataFrame:
    """The id of every node that is its own ancestor, once.

    edges: distinct (u, v). Self-links count. An empty input gives no rows.
    """
    links = _peeled(edges)
    return written(links.select(F.col("u").alias("id")).distinct(), "cycles")  # a link on a cycle starts at a node on it


def _peeled(edges: DataFrame) -> DataFrame:
    """The links (u, v) that lie on cycles, repeated or not.

    A round takes two jobs, one for the nodes' degrees and one for the links that stay; the counts that end the
    loop are taken on the way.
    """
    spark = edges.sparkSession
    steps = Steps(spark, "peel")
    loop = F.col("u") == F.col("v")
    edges, seen = steps.measured("edges0", edges, left=F.count_if(~loop), loops=F.count_if(loop))
    spliced: list[str] = []
    looped: list[DataFrame] = [edges.where("u = v")] if seen["loops"] else []
    turn = 0
    while seen["left"]:
        turn += 1
        true = edges.where("u <> v")
        ends = true.select(F.col("v").alias("id"), F.col("u").alias("pred"), F.lit(None).cast("long").alias("succ"))
        ends = ends.unionAll(true.select(F.col("u").alias("id"), F.lit(None).cast("long"), F.col("v")))
        degree = ends.groupBy("id").agg(
            F.count("pred").alias("n_in"), F.count("succ").alias("n_out"), F.min("pred").alias("pred"), F.min("succ").alias("succ")
        )
        chain = (F.col("n_in") == 1) & (F.col("n_out") == 1)
        out = chain & (_lot("id", turn) < _lot("pred", turn)) & (_lot("id", turn) < _lot("succ", turn))
        state = F.when(out, 2).when((F.col("n_in") == 0) | (F.col("n_out") == 0), 0).otherwise(1).cast("byte")
        degree = degree.select("id", state.alias("state"), F.when(out, F.col("pred")).alias("pred"), F.when(out, F.col("succ")).alias("succ"), chain.alias("chain"))
        degree, nodes = steps.measured(f"degree{turn}", degree, out=F.count_if(F.col("state") == 2), ends=F.count_if(F.col("state") == 0), chains=F.count_if("chain"))
        if not nodes["out"] and not nodes["ends"] and not nodes["chains"]:
            break  # every node left has several parents or several children
        gone = degree.where("state <> 1").select("id")
        kept = true.join(gone.withColumnRenamed("id", "u"), "u", "left_anti").join(gone.withColumnRenamed("id", "v"), "v", "left_anti").select("u", "v")
        picked = degree.where("state = 2").select("id", "pred", "succ")
        if nodes["out"]:
            spliced.append(steps.held[f"degree{turn}"])
            kept = kept.unionAll(picked.select(F.col("pred").alias("u"), F.col("succ").alias("v"))).distinct()
        edges, seen = steps.measured(f"edges{turn}", kept, left=F.count_if(~loop), loops=F.count_if(loop))
        if seen["loops"]:
            looped.append(edges.where("u = v"))
    turning = looped + ([_turning_links(edges.where("u <> v"), steps)] if seen["left"] else [])
    if not turning:
        return spark.createDataFrame([], "u long, v long")
    # a spliced node is on a cycle exactly if the link that took its place is, and then so are its own two links
    bridges = spark.read.schema(degree.schema).parquet(*spliced).where("state = 2").select("id", "pred", "succ") if spliced else None
    links, found = steps.measured("turning0", reduce(DataFrame.unionAll, turning).select("u", "v").distinct(), n=F.count("*"))
    every = [links]
    bridges = steps.put("bridges", bridges) if bridges is not None and found["n"] else None
    while bridges is not None and found["n"]:
        mid, found = steps.measured(f"turning{len(every)}", bridges.join(links.toDF("pred", "succ"), ["pred", "succ"]), n=F.count("*"))
        before, behind = F.struct(F.col("pred").alias("u"), F.col("id").alias("v")), F.struct(F.col("id").alias("u"), F.col("succ").alias("v"))
        links = mid.select(F.explode(F.array(before, behind)).alias("l")).select("l.*").distinct()
        every.append(links)
    return reduce(DataFrame.unionAll, every)


def _turning_links(edges: DataFrame, steps: Steps) -> DataFrame:
    """The links (u, v) that lie on cycles, of the peeled core (distinct links without loops), by colours.

    The lowest lot that reaches a node colours it; the node that drew it is the colour's root, and the nodes of the colour
    from which the root can be reached make up a component. These leave; links between colours are on no cycle and
    leave as well; the rest is peeled and coloured anew. Every table holds a row a node or link, never one a pair of nodes.
    """
    lot = F.struct(F.xxhash64("id", F.lit(0)).alias("lot"), F.col("id").alias("root"))
    nodes = edges.select(F.col("u").alias("id")).unionAll(edges.select(F.col("v"))).distinct()
    colour = steps.put("colour", nodes.select("id", lot.alias("c")))
    front, seen = steps.measured("front", colour, n=F.count("*"))
    while seen["n"]:
        told = front.join(edges, F.col("id") == F.col("u")).groupBy(F.col("v").alias("id")).agg(F.min("c").alias("told"))
        better = told.join(colour, "id").where("told < c").select("id", F.col("told").alias("c"))
        front, seen = steps.measured("front", better, n=F.count("*"))
        if seen["n"]:
            lower = front.select("id", F.col("c").alias("told"))
            colour = steps.put("colour", colour.join(lower, "id", "left").select("id", F.coalesce("told", "c").alias("c")))
    of = colour.select("id", F.col("c.root").alias("root"))
    inside = edges.join(of.toDF("u", "root"), "u").join(of.toDF("v", "other"), "v").where("root = other")
    inside = steps.put("inside", inside.select("u", "v", "root"))
    layer, seen = steps.measured("back", inside.select(F.col("root").alias("id"), F.col("root").alias("component")).distinct(), n=F.count("*"))
    reached = [layer]
    while seen["n"]:
        above = inside.join(layer.toDF("v", "component"), "v").select(F.col("u").alias("id"), F.col("root").alias("component")).distinct()
        known = reduce(DataFrame.unionAll, reached).select("id")
        layer, seen = steps.measured(f"back{len(reached)}", above.join(known, "id", "left_anti"), n=F.count("*"))
        reached.append(layer)
    whole = steps.put("components", reduce(DataFrame.unionAll, reached))
    ends = whole.select(F.col("id").alias("u"), F.col("component").alias("a")), whole.select(F.col("id").alias("v"), F.col("component").alias("b"))
    found = steps.put("found", inside.join(ends[0], "u").join(ends[1], "v").where("a = b").select("u", "v"))
    gone = whole.select("id")
    rest = inside.join(gone.toDF("u"), "u", "left_anti").join(gone.toDF("v"), "v", "left_anti").select("u", "v")
    rest, seen = steps.measured("rest", rest, n=F.count("*"))
    return found.unionAll(_peeled(rest)) if seen["n"] else found


def cycle_nodes(branches: DataFrame) -> DataFrame:
    """(dataset, node) of each node that is its own ancestor by the rows of its dataset.

    A row that names a node as its own parent counts; nodes below a cycle don't. Nulls add no link.
    """
    edges, ids = numbered(named_links(branches))
    return ids.join(cycle_ids(edges), "id").select("dataset", "node")


def forest(branches: DataFrame, names: DataFrame | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(nodes, links, cycles): every node off the cycles, one link to a parent for each that has one.

    nodes: id, dataset, node, below_cycle. links: id, parent_id. cycles: dataset, node.
    names (dataset, name) adds nodes that no link mentions. Of several parents a node takes the one
    exported last, then the first by name; a parent on a cycle counts only if there is no other, and then
    the node becomes a root with below_cycle set.
    """
    links = named_links(branches)
    mentioned = links.select("dataset", F.col("parent").alias("node")).unionAll(links.select("dataset", F.col("child").alias("node")))
    alone = branches.select("dataset", clean_name("child").alias("node"))
    everything = mentioned.unionAll(alone)
    if names is not None:
        everything = everything.unionAll(names.select("dataset", clean_name("name").alias("node")))
    steps = Steps(branches.sparkSession, "forest")
    ids = dense_ids(everything, ["dataset", "node"], "id")
    parents = ids.select("dataset", F.col("node").alias("parent"), F.col("id").alias("u"))
    children = ids.select("dataset", F.col("node").alias("child"), F.col("id").alias("v"))
    dated = branches.select("dataset", clean_name("parent").alias("parent"), clean_name("child").alias("child"), "exported_at")
    dated = dated.groupBy("dataset", "parent", "child").agg(F.max("exported_at").alias("seen")).dropna(subset=["dataset", "parent", "child"])
    edges = steps.put("dated", dated.join(parents, ["dataset", "parent"]).join(children, ["dataset", "child"]).select("u", "v", "seen"))
    found = cycle_ids(edges.select("u", "v"))
    off = edges.join(found.select(F.col("id").alias("v")), "v", "left_anti")
    marked = off.join(found.select(F.col("id").alias("u"), F.lit(True).alias("on_cycle")), "u", "left")
    best = marked.groupBy("v").agg(
        F.max_by("u", F.struct(F.col("on_cycle").isNull(), "seen", -F.col("u"))).alias("u"),
        F.min(F.coalesce("on_cycle", F.lit(False))).alias("below_cycle"),
    )
    best = steps.put("parents", best)
    nodes = ids.join(found.select("id"), "id", "left_anti").join(best.where("below_cycle").select(F.col("v").alias("id"), "below_cycle"), "id", "left")
    nodes = steps.put("nodes", nodes.select("id", "dataset", "node", F.coalesce("below_cycle", F.lit(False)).alias("below_cycle")))
    tree = best.where("not below_cycle").select(F.col("v").alias("id"), F.col("u").alias("parent_id"))
    return nodes, tree, ids.join(found, "id").select("dataset", "node")


def tour_ranks(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """(id, root_id, depth, entry, size, n_leaves, leaf_entry) by ranking the Euler tours of all trees at once.

    nodes: id; links: id, parent_id, one parent a node. entry is the node's pre-order rank in its tree, siblings in
    the order of their ids; entry + size - 1 is the last entry rank below it. n_leaves counts the nodes without
    children below it, itself included, leaf_entry those before it in its tree. Nodes on a cycle or below one are in no tree and
    are left out. A node may have any number of
    children: sibling order comes from consecutive numbers over all links, not from one group a parent.
    """
    steps = Steps(nodes.sparkSession, "tour")
    order = dense_ids(links.select("parent_id", "id"), ["parent_id", "id"], "pos")
    follows = order.select(F.col("parent_id").alias("p"), F.col("id").alias("next_id"), (F.col("pos") - 1).alias("pos"))
    sibling = order.join(follows, "pos", "left").select("id", "parent_id", F.when(F.col("p") == F.col("parent_id"), F.col("next_id")).alias("next_id"))
    first = links.groupBy(F.col("parent_id").alias("id")).agg(F.min("id").alias("first_id"))
    around = nodes.select("id").join(first, "id", "left").join(sibling, "id", "left")
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    leaf = F.col("first_id").isNull().cast("long")
    arc = lambda at, ahead, down, leaves: F.struct(
        at.alias("arc"), ahead.alias("next"), down.alias("downs"), leaves.alias("leaves"), one.alias("hops"), at.alias("last")
    )
    down = arc(F.col("id") * 2, F.coalesce(F.col("first_id") * 2, F.col("id") * 2 + 1), one, leaf)
    up = arc(F.col("id") * 2 + 1, F.coalesce(F.col("next_id") * 2, F.col("parent_id") * 2 + 1), none, none)
    arcs = around.select(F.explode(F.array(down, up)).alias("a")).select("a.*")
    ranked = along_paths(arcs, ["arc"], ["next"], {"downs": summed, "leaves": summed, "hops": summed, "last": last_known})
    # both arcs of a node meet by its id
    ahead = lambda kind, c: F.max(F.when(F.col("arc") % 2 == kind, F.col(c)))
    at = ranked.groupBy(F.shiftright("arc", 1).alias("id")).agg(
        ahead(0, "downs").alias("d"), ahead(0, "hops").alias("h"), ahead(0, "leaves").alias("l"), ahead(1, "downs").alias("d_out"), ahead(1, "leaves").alias("l_out"),
        F.shiftright(F.max("last"), 1).alias("root_id"),
    )
    at = steps.put("ranks", at)
    whole = at.where("id = root_id").select("root_id", F.col("d").alias("n_tree"), F.col("l").alias("l_tree"))
    return at.join(whole, "root_id").selectExpr(
        "id", "root_id", "h - 2 * d as depth", "n_tree - d as entry", "d - d_out as size", "l - l_out as n_leaves", "l_tree - l as leaf_entry"
    )


def ancestor_pairs(ranks: DataFrame) -> DataFrame:
    """(id, ancestor_id, hops) of every node and each of its ancestors, itself included (hops 0).

    Interval containment as an equality join: an interval of entry ranks is at most two dyadic blocks a
    level, a single rank lies in one block a level, and exactly one of the blocks of each ancestor is among
    them. No pair is met that is not a result.
    """
    spans = ranks.selectExpr("root_id", "id as ancestor_id", "depth as a_depth", "entry", "size")
    blocks = interval_blocks(spans, "entry", "size").drop("entry", "size")
    sizes = ranks.where("id = root_id").selectExpr("root_id", "size as n_tree")
    points = point_blocks(ranks.join(sizes, "root_id").select("root_id", "id", "depth", "entry", "n_tree"), "entry", "n_tree")
    return points.join(blocks, ["root_id", "level", "block"]).selectExpr("id", "ancestor_id", "depth - a_depth as hops")


def hierarchy(branches: DataFrame, names: DataFrame | None = None) -> DataFrame:
    """dataset, node, parent, root, depth, path (names from the root to the node), n_descendants, entry, exit, below_cycle.

    One row per node off the cycles; nodes on cycles are those of cycle_nodes(). See forest() for nodes with
    several parents, nulls and nodes without links.
    """
    nodes, links, _ = forest(branches, names)
    ranks = tour_ranks(nodes, links)
    label = nodes.select("id", "dataset", "node", "below_cycle")
    above = ancestor_pairs(ranks).join(label.select(F.col("id").alias("ancestor_id"), F.col("node").alias("a_node")), "ancestor_id")
    paths = above.groupBy("id").agg(F.sort_array(F.collect_list(F.struct((-F.col("hops")).alias("at"), "a_node"))).alias("steps"))
    paths = paths.select("id", F.transform("steps", lambda x: x["a_node"]).alias("path"))
    return (
        label.join(ranks, "id")
        .join(paths, "id")
        .select(
            "dataset",
            "node",
            F.when(F.col("depth") > 0, F.element_at("path", -2)).alias("parent"),
            F.element_at("path", 1).alias("root"),
            "depth",
            "path",
            (F.col("size") - 1).alias("n_descendants"),
            "entry",
            (F.col("entry") + F.col("size") - 1).alias("exit"),
            "below_cycle",
        )
    )


def descendants(branches: DataFrame) -> DataFrame:
    """dataset, node, descendant, hops: every node with each node below it, nodes on cycles left out."""
    nodes, links, _ = forest(branches)
    pairs = ancestor_pairs(tour_ranks(nodes, links)).where("hops > 0")
    upper = nodes.select(F.col("id").alias("ancestor_id"), "dataset", "node")
    lower = nodes.select("id", F.col("node").alias("descendant"))
    return pairs.join(upper, "ancestor_id").join(lower, "id").select("dataset", "node", "descendant", "hops")
