"""Trees given by a branch table: paths, clades and splits.

Depths, clade sizes and membership come from ranks and pointer jumping, with a row a node; walks up a tree from
jumps of doubling length. Only what returns whole paths builds the closure, pairs of nodes and their ancestors.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cladeflow.functions.names import clean_name
from cladeflow.functions.sequences import masked_hamming
from cladeflow.operators.dense_ids import dense_ids, running_before
from cladeflow.operators.hierarchy import tour_ranks
from cladeflow.operators.intervals import interval_blocks, point_blocks
from cladeflow.operators.jumping import along_paths, first_known, last_known, summed
from cladeflow.session import Steps, fresh_path, remove, written, written_at

# The defaults of the analyses' settings.
MUTATIONS_BACK = 5
TEST_PROPORTION = 0.1
TOLERANCE = 0.5


def tree_links(branches: DataFrame) -> DataFrame:
    """dataset, parent, child, hamming (null where missing), split (null where blank): one parent a child.

    Of several rows of a child the one exported last counts, then the larger parent, distance and label.
    Rows without dataset, parent or child and self-links are left out; names lose their prefix.
    """
    rows = branches.select(
        "dataset",
        clean_name("parent").alias("parent"),
        clean_name("child").alias("child"),
        F.trim("hamming").try_cast("int").alias("hamming"),
        F.nullif(F.lower(F.trim("train_test")), F.lit("")).alias("split"),
        "exported_at",
    ).where("dataset is not null and parent is not null and child is not null and parent <> child")
    last = rows.groupBy("dataset", "child").agg(F.max(F.struct("exported_at", "parent", "hamming", "split")).alias("r"))
    return last.select("dataset", F.col("r.parent").alias("parent"), "child", F.col("r.hamming").alias("hamming"), F.col("r.split").alias("split"))


def tips_of(links: DataFrame) -> DataFrame:
    """dataset, tip, split: children that are no parents; split is train where none is given."""
    parents = links.select("dataset", F.col("parent").alias("child")).distinct()
    return links.join(parents, ["dataset", "child"], "left_anti").select("dataset", F.col("child").alias("tip"), F.coalesce("split", F.lit("train")).alias("split"))


def closure(links: DataFrame, starts: DataFrame | None = None) -> DataFrame:
    """dataset, node, anc, hops: every node with itself (hops 0) and each ancestor, by pointer doubling.

    starts (dataset, node) limits the nodes to walk up from. Nodes on a cycle or below one reach no root and
    are left out. The number of rounds is the logarithm of the depth; a round writes the pairs that are
    new in it. A round in which no node runs out of ancestors ends the loop: then only cycles are left,
    as a path to a root would hold a node of every smaller depth.
    """
    spark = links.sparkSession
    root, rounds, held = fresh_path(spark, "closure"), 0, None
    jump = written_at(links.select("dataset", F.col("child").alias("node"), F.col("parent").alias("up")), f"{root}/jump-0")
    nodes = jump.select("dataset", "node").union(jump.select("dataset", "up")).distinct() if starts is None else starts.select("dataset", "node").distinct()
    pairs = written_at(nodes.select("dataset", "node", F.col("node").alias("anc"), F.lit(0).cast("long").alias("hops")), f"{root}/pairs-0")
    left, step = jump.count(), 1
    while left:
        rounds += 1
        further = jump.select("dataset", F.col("node").alias("anc"), F.col("up").alias("top"))
        new = pairs.join(further, ["dataset", "anc"]).select("dataset", "node", F.col("top").alias("anc"), (F.col("hops") + step).alias("hops"))
        written_at(new.select(*pairs.columns), f"{root}/pairs-{rounds}")
        pairs = spark.read.schema(pairs.schema).parquet(*[f"{root}/pairs-{k}" for k in range(rounds + 1)])  # one scan for all
        top = jump.select("dataset", F.col("node").alias("up"), F.col("up").alias("top"))
        jump = written_at(jump.join(top, ["dataset", "up"]).select("dataset", "node", F.col("top").alias("up")), f"{root}/jump-{rounds}")
        if held:
            remove(spark, held)
        held = f"{root}/jump-{rounds - 1}"
        before, left = left, jump.count()
        if left == before:
            return pairs.join(jump.select("dataset", "node"), ["dataset", "node"], "left_anti")
        step *= 2
    return pairs


def _upward(links: DataFrame) -> DataFrame:
    """dataset, node, up: every node with its parent, null for a root."""
    children = links.select("dataset", F.col("child").alias("node"), F.col("parent").alias("up"))
    parents = links.select("dataset", F.col("parent").alias("node")).distinct()
    roots = parents.join(children.select("dataset", "node"), ["dataset", "node"], "left_anti")
    return children.unionByName(roots.withColumn("up", F.lit(None).cast("string")))


def depths(links: DataFrame) -> DataFrame:
    """dataset, node, depth, root. Nodes on a cycle or below one reach no root and are left out."""
    step = F.col("up").isNotNull().cast("long")
    rows = _upward(links).select("*", step.alias("depth"), F.col("node").alias("root"))
    return along_paths(rows, ["dataset", "node"], ["dataset", "up"], {"depth": summed, "root": last_known})


def ranked_nodes(links: DataFrame) -> DataFrame:
    """dataset, node, id, root_id, depth, entry, size, n_leaves, leaf_entry, as tour_ranks() has them.

    Siblings are in the order of their names. Nodes on a cycle or below one are left out. A written table.
    """
    nodes = links.select("dataset", F.col("child").alias("node")).unionAll(links.select("dataset", "parent"))
    ids = written(dense_ids(nodes, ["dataset", "node"], "id"), "ids")
    up, down = ids.toDF("dataset", "parent", "parent_id"), ids.toDF("dataset", "child", "id")
    numbered = written(links.join(up, ["dataset", "parent"]).join(down, ["dataset", "child"]).select("id", "parent_id"), "numbered")
    return written(ids.join(tour_ranks(ids, numbered), "id"), "ranked")


def placed_nodes(links: DataFrame) -> DataFrame:
    """ranked_nodes() with at and leaf_at, the node's pre-order number and the number of its first leaf within the dataset,
    whose trees follow each other in the order of their roots' names, and n_tips, the dataset's number of leaves."""
    ranked = ranked_nodes(links)
    trees = ranked.where("id = root_id").select("dataset", "root_id", "size", "n_leaves")
    placed = running_before(running_before(trees, ["dataset", "root_id"], "size", "at0"), ["dataset", "root_id"], "n_leaves", "leaf0")
    placed = written(placed, "trees")
    first = placed.groupBy("dataset").agg(F.min("at0").alias("at1"), F.min("leaf0").alias("leaf1"), F.sum("n_leaves").alias("n_tips"))
    shifts = placed.join(first, "dataset").selectExpr("root_id", "at0 - at1 as at0", "leaf0 - leaf1 as leaf0", "n_tips")
    whole = ranked.join(shifts, "root_id").selectExpr(*ranked.columns, "at0 + entry as at", "leaf0 + leaf_entry as leaf_at", "n_tips")
    return written(whole, "nodes")


def below(nodes: DataFrame, roots: DataFrame) -> DataFrame:
    """dataset, node: the nodes of placed_nodes() that are among the roots (dataset, node) or below one of them."""
    spans = interval_blocks(nodes.join(roots.select("dataset", "node").distinct(), ["dataset", "node"], "left_semi").select("dataset", "at", "size"), "at", "size")
    top = nodes.groupBy("dataset").agg((F.max("at") + 1).alias("top"))
    points = point_blocks(nodes.join(top, "dataset").select("dataset", "node", "at", "top"), "at", "top")
    return points.join(spans.select("dataset", "level", "block").distinct(), ["dataset", "level", "block"], "left_semi").select("dataset", "node").distinct()


def clade_sizes(nodes: DataFrame) -> DataFrame:
    """dataset, node, n_tips, n_nodes below and including each node of ranked_nodes()."""
    return nodes.select("dataset", "node", F.col("n_leaves").alias("n_tips"), F.col("size").alias("n_nodes"))


def analysis_of(dataset: str = "dataset"):
    """The analysis of a dataset `{analysis}_{serial}`."""
    return F.regexp_replace(F.col(dataset), r"_\d+$", "")


def with_settings(df: DataFrame, analyses: DataFrame) -> DataFrame:
    """df (with dataset) and the settings of its analysis; analyses is the fixed table of a few rows."""
    return df.withColumn("analysis", analysis_of()).join(F.broadcast(analyses), "analysis", "left").drop("analysis")


def walk_back(links: DataFrame, tips: DataFrame, analyses: DataFrame) -> DataFrame:
    """dataset, tip, clade_root: the first node from the tip up at which the distances of the branches add up to
    mutations_back; the root if they never do. A branch without a distance counts 0.

    Jumps of doubling length are tabled with the distance they cover and the most gone on the way; a tip takes
    the longest jumps that stay below mutations_back, then shorter ones. Tips below a cycle reach no root and are left out.
    """
    back = analyses.select("analysis", F.coalesce("mutations_back", F.lit(MUTATIONS_BACK)).alias("back"))
    wanted = F.coalesce("back", F.lit(MUTATIONS_BACK)).cast("long").alias("back")
    d = F.coalesce("hamming", F.lit(0)).cast("long")
    steps = Steps(links.sparkSession, "lifting")
    jump = with_settings(links.select("dataset", F.col("child").alias("node"), F.col("parent").alias("up"), d.alias("gone"), d.alias("peak")), back)
    jump, seen = steps.measured("jump0", jump.select("dataset", "node", "up", "gone", "peak", wanted), n=F.count("*"))
    jumps = []
    while seen["n"]:
        jumps.append(jump)
        further = jump.select("dataset", F.col("node").alias("up"), F.col("up").alias("_up"), F.col("gone").alias("_gone"), F.col("peak").alias("_peak"))
        longer = jump.join(further, ["dataset", "up"]).select(
            "dataset", "node", F.col("_up").alias("up"), (F.col("gone") + F.col("_gone")).alias("gone"), F.greatest("peak", F.col("gone") + F.col("_peak")).alias("peak"), "back"
        )
        before = seen["n"]
        jump, seen = steps.measured(f"jump{len(jumps)}", longer, n=F.count("*"))
        if seen["n"] >= before and jump.count() == jumps[-1].count():  # none came to its end: only cycles are left
            tips = tips.join(jump.select("dataset", F.col("node").alias("tip")), ["dataset", "tip"], "left_anti")
            break
    at = tips.select("dataset", "tip", F.col("tip").alias("at"), F.lit(0).cast("long").alias("so_far"))
    for level in reversed(range(len(jumps))):
        near = jumps[level].where("peak < back").select("dataset", F.col("node").alias("at"), "up", "gone", "peak", "back")
        go = F.col("so_far") + F.col("peak") < F.col("back")
        at = at.join(near, ["dataset", "at"], "left").select(
            "dataset", "tip", F.when(go, F.col("up")).otherwise(F.col("at")).alias("at"), F.when(go, F.col("so_far") + F.col("gone")).otherwise(F.col("so_far")).alias("so_far")
        )
        if level % 6 == 0:
            at = steps.put("at", at)
    return at.select("dataset", "tip", F.col("at").alias("clade_root"))


def monophyletic_split(nodes: DataFrame, tips: DataFrame, analyses: DataFrame, tolerance: float = TOLERANCE) -> DataFrame:
    """dataset, node, split: one whole clade a dataset is test, the one whose tip count is nearest to the target.

    nodes: placed_nodes(). The target is max(1, int(tips * test_proportion)). Clades whose count is off by more than the
    tolerance are no candidates; ties go to the first in pre-order. A dataset without a candidate is all train.
    """
    if not 0 <= tolerance:
        raise ValueError("tolerance must not be negative")
    total = tips.groupBy("dataset").agg(F.count("*").alias("total"))
    share = analyses.select("analysis", F.coalesce("test_proportion", F.lit(TEST_PROPORTION)).alias("share"))
    part = F.floor(F.col("total") * F.coalesce("share", F.lit(TEST_PROPORTION)))
    target = with_settings(total, share).select("dataset", F.greatest(F.lit(1).cast("long"), part).alias("target"))
    off = F.abs(F.col("n_leaves") - F.col("target"))
    near = nodes.join(target, "dataset").where((F.col("n_leaves") >= F.col("target") * (1 - tolerance)) & (F.col("n_leaves") <= F.col("target") * (1 + tolerance)))
    best = near.groupBy("dataset").agg(F.min(F.struct(off.alias("off"), "at", "size")).alias("b")).selectExpr("dataset", "b.at as low", "b.at + b.size as high")
    test = (F.col("at") >= F.col("low")) & (F.col("at") < F.col("high"))
    return nodes.join(best, "dataset", "left").select("dataset", "node", F.when(test, F.lit("test")).otherwise(F.lit("train")).alias("split"))


def clade_roots(links: DataFrame) -> DataFrame:
    """dataset, clade_root: test nodes whose parent is train; a root without a label is train."""
    above = links.select("dataset", F.col("child").alias("parent"), F.col("split").alias("parent_split"))
    joined = links.join(above, ["dataset", "parent"], "left")
    return joined.where("split = 'test' and coalesce(parent_split, 'train') = 'train'").select("dataset", F.col("child").alias("clade_root"))


def clade_membership(links: DataFrame, tips: DataFrame) -> DataFrame:
    """dataset, tip, clade_root: the nearest test-clade root from each test tip up. Tips below a cycle have none."""
    marked = clade_roots(links).select("dataset", F.col("clade_root").alias("node"), F.col("clade_root").alias("first"))
    rows = _upward(links).join(marked, ["dataset", "node"], "left")
    found = along_paths(rows, ["dataset", "node"], ["dataset", "up"], {"first": first_known}).where("first is not null")
    own = tips.where("split = 'test'").select("dataset", F.col("tip").alias("node"))
    return found.join(own, ["dataset", "node"], "left_semi").select("dataset", F.col("node").alias("tip"), F.col("first").alias("clade_root"))


def node_sequences(alignment: DataFrame) -> DataFrame:
    """dataset, name, seq: of several rows of a node the one with the largest seq_id; null sequences are none."""
    rows = alignment.where("dataset is not null and name is not null and seq is not null")
    last = rows.groupBy("dataset", clean_name("name").alias("name")).agg(F.max_by("seq", "seq_id").alias("seq"))
    return last


def branch_hamming(links: DataFrame, alignment: DataFrame) -> DataFrame:
    """dataset, parent, child, hamming, split: distances from the sequences, null where either is missing."""
    seqs = node_sequences(alignment).withColumn("seq", F.upper("seq"))
    joined = links.drop("hamming").join(seqs.toDF("dataset", "child", "c_seq"), ["dataset", "child"], "left").join(
        seqs.toDF("dataset", "parent", "p_seq"), ["dataset", "parent"], "left"
    )
    return joined.select("dataset", "parent", "child", masked_hamming("p_seq", "c_seq").alias("hamming"), "split")


def forward_frames(pairs: DataFrame, links: DataFrame, tips: DataFrame, alignment: DataFrame) -> DataFrame:
    """dataset, split, tip, pos, node, cum_dist: the path of each tip with the distance gone so far.

    Paths start at the root, those of test tips at the first test node from the root, where the distance
    restarts at 0. Frames without a step (other than first and tip) and frames without a sequence are left
    out, the distance of the latter counts on.
    """
    return frames_with_sequence(path_steps(pairs, links, tips), alignment)


def frames_with_sequence(steps: DataFrame, alignment: DataFrame) -> DataFrame:
    """The frames of path_steps() that have a sequence."""
    present = node_sequences(alignment).where("seq <> ''").select("dataset", F.col("name").alias("node"))
    return steps.join(present, ["dataset", "node"], "left_semi").select("dataset", "split", "tip", "pos", "node", "cum_dist")


def path_steps(pairs: DataFrame, links: DataFrame, tips: DataFrame) -> DataFrame:
    """forward_frames() with the frames that have no sequence; each tip has one at its end."""
    own = tips.select("dataset", F.col("tip").alias("node"), F.col("split").alias("tip_split"))
    frames = pairs.join(own, ["dataset", "node"])
    branch = links.select("dataset", F.col("child").alias("anc"), F.coalesce("hamming", F.lit(0)).alias("d"), F.col("split").alias("anc_split"))
    tip = Window.partitionBy("dataset", "node")
    frames = frames.join(branch, ["dataset", "anc"], "left").withColumn("first", F.max(F.when((F.col("tip_split") == "test") & (F.col("anc_split") == "test"), F.col("hops"))).over(tip))
    kept = frames.where("first is null or hops <= first").withColumn("top", F.max("hops").over(tip))
    kept = kept.withColumn("d", F.when(F.col("hops") == F.col("top"), 0).otherwise(F.coalesce("d", F.lit(0))))
    gone = kept.withColumn("cum_dist", F.sum("d").over(tip.orderBy(F.col("hops").desc()).rowsBetween(Window.unboundedPreceding, 0)))
    steps = gone.where("hops = top or hops = 0 or d > 0")
    return steps.select(
        "dataset", F.col("tip_split").alias("split"), F.col("node").alias("tip"), (F.col("top") - F.col("hops")).alias("pos"), F.col("anc").alias("node"), "cum_dist"
    )
