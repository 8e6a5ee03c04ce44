import json
import random

import pytest
from pyspark.sql import functions as F

from cladeflow.operators import documents, lineage, pairs, random_clades, summaries
from tests.tree_example import BRANCH_SCHEMA, DAY, LINKS, SEQUENCES, branch_rows, tree_document

ANALYSES = "analysis string, gene string, trim_begin int, trim_end int, test_proportion double, mutations_back int, max_clade_proportion double, seed int"


@pytest.fixture(scope="module")
def tree(spark):
    links = lineage.tree_links(spark.createDataFrame(branch_rows(), BRANCH_SCHEMA)).cache()
    alignment = spark.createDataFrame([(i, "t_0001", n, s) for i, (n, s) in enumerate(SEQUENCES.items())], "seq_id long, dataset string, name string, seq string")
    return links, lineage.tips_of(links), lineage.closure(links).cache(), alignment


def settings(spark, **values):
    row = {"analysis": "t", "gene": "nuc", "trim_begin": None, "trim_end": None, "test_proportion": 0.1, "mutations_back": 5, "max_clade_proportion": 0.01, "seed": 42} | values
    return spark.createDataFrame([tuple(row.values())], ANALYSES)


def test_closure_and_sizes(tree):
    links, tips, closed, _ = tree
    assert closed.count() == sum(r.depth + 1 for r in lineage.depths(links).collect())
    assert {r.node: r.depth for r in lineage.depths(links).collect()}["E"] == 4
    sizes = {r.node: r.n_tips for r in lineage.clade_sizes(lineage.ranked_nodes(links)).collect()}
    assert sizes == {"a": 6, "b": 5, "c": 3, "d": 2, "x": 2, **dict.fromkeys("EFGHYZ", 1)}


def test_branch_distances(tree):
    links, _, _, alignment = tree
    got = {(r.parent, r.child): r.hamming for r in lineage.branch_hamming(links, alignment).collect()}
    assert got == {(p, c): h for p, c, h in LINKS}
    stats = summaries.branch_stats(links).first()
    assert (stats.n_branches, stats.n_zero, stats.min_hamming, stats.max_hamming, stats.sum_hamming) == (10, 3, 0, 2, 8)


def test_frames(tree):
    links, tips, closed, alignment = tree
    rows = lineage.forward_frames(closed, links, tips, alignment).collect()
    paths = {}
    for r in sorted(rows, key=lambda r: r.pos):
        paths.setdefault(r.tip, []).append((r.node, r.cum_dist))
    assert paths == {
        "E": [("a", 0), ("b", 1), ("c", 2), ("E", 3)],
        "F": [("a", 0), ("b", 1), ("c", 2), ("F", 2)],
        "G": [("a", 0), ("b", 1), ("c", 2), ("G", 2)],
        "H": [("a", 0), ("H", 1)],
        "Y": [("x", 0), ("Y", 1)],
        "Z": [("x", 0), ("Z", 2)],
    }


@pytest.mark.parametrize("back,want", [(0, "EFGHYZ"), (2, "cccaxZ"), (5, "aaaaaa")])
def test_walk_back(spark, tree, back, want):
    # the example counts mutations, of which masked ones are some
    links = tree[0].withColumn("hamming", F.when(F.col("child").isin("F", "G"), 1).otherwise(F.col("hamming")))
    got = {r.tip: r.clade_root for r in lineage.walk_back(links, tree[1], settings(spark, mutations_back=back)).collect()}
    assert got == dict(zip("EFGHYZ", want))


def test_monophyletic(spark, tree):
    nodes = lineage.placed_nodes(tree[0])
    got = lineage.monophyletic_split(nodes, tree[1], settings(spark, test_proportion=0.34)).where("split = 'test'").collect()
    assert {r.node for r in got} == {"d", "E", "F"}  # d and x tie, d comes first
    with pytest.raises(ValueError):
        lineage.monophyletic_split(nodes, tree[1], settings(spark), tolerance=-1)
    few = lineage.monophyletic_split(nodes, tree[1], settings(spark, test_proportion=0.01)).where("split = 'test'").collect()
    assert [r.node for r in few] == ["H"]  # at least one tip, the first in pre-order by names


def test_clades_and_pairs(tree):
    links, tips, closed, alignment = tree
    assert [r.clade_root for r in lineage.clade_roots(links).collect()] == ["x"]
    members = lineage.clade_membership(links, tips)
    assert {(r.tip, r.clade_root) for r in members.collect()} == {("Y", "x"), ("Z", "x")}
    train = pairs.with_sequences(pairs.pairs_within(tips.where("split = 'train'"), "dataset", "tip", 100), alignment)
    got = {frozenset((r.tip1, r.tip2)): r.hamming for r in train.collect()}
    assert got == {frozenset(k): v for k, v in {"EF": 1, "EG": 1, "EH": 4, "FG": 0, "FH": 3, "GH": 3}.items()}
    test = pairs.with_sequences(pairs.pairs_within_clades(members, 100), alignment).collect()
    assert [({r.tip1, r.tip2}, r.hamming) for r in test] == [({"Y", "Z"}, 2)]


def test_cycles_dirt_and_empty(spark):
    rows = branch_rows() + [("t_0001", "p", "q", "1", "", DAY), ("t_0001", "q", "p", "1", "", DAY), ("t_0001", "q", "below", "?", None, DAY)]
    rows += [(None, "a", "b", "1", "", DAY), ("t_0001", None, "b", "1", "", DAY), ("t_0001", "z", None, "1", "", None), ("t_0001", "s", "s", "1", "", DAY)]
    rows += [("t_0001", "old", "H", "9", "test", None), ("t_0001", "hCoV-19/a", "hCoV-19/H", "1", "train", DAY)]
    df = spark.createDataFrame(rows, BRANCH_SCHEMA).withColumn("anc", F.lit(1)).withColumn("node", F.lit(None).cast("string"))
    links = lineage.tree_links(df)
    assert {(r.parent, r.child): r.hamming for r in links.where("parent not in ('p', 'q')").collect()} == {(p, c): h for p, c, h in LINKS}
    assert {r.node for r in lineage.closure(links).collect()} == set(SEQUENCES)
    assert summaries.branch_stats(links).first().n_missing == 1
    empty = lineage.tree_links(spark.createDataFrame([], BRANCH_SCHEMA))
    assert lineage.closure(empty).count() == 0 and lineage.tips_of(empty).count() == 0
    assert lineage.ranked_nodes(empty).count() == lineage.depths(empty).count() == lineage.clade_membership(empty, lineage.tips_of(empty)).count() == 0
    assert lineage.walk_back(empty, lineage.tips_of(empty), settings(spark)).count() == 0
    for made in (lineage.depths(links), lineage.ranked_nodes(links)):
        assert {r.node for r in made.collect()} == set(SEQUENCES)
    walked = lineage.walk_back(links, lineage.tips_of(links), settings(spark)).collect()
    assert {r.tip for r in walked} == set("EFGHYZ")
    assert pairs.pairs_within(lineage.tips_of(empty), "dataset", "tip", 5).count() == 0


def test_unrank_is_a_bijection(spark):
    n = 60
    numbers = spark.range(n * (n - 1) // 2).withColumnRenamed("id", "idx")
    j, i = pairs.unrank(F.col("idx"))
    got = {(r.j, r.i) for r in numbers.select(j.alias("j"), i.alias("i")).collect()}
    assert got == {(j, i) for i in range(n) for j in range(i)}
    far = spark.createDataFrame([(49_999_999_999_999,)], "idx long").select(pairs.unrank(F.col("idx"))[1]).first()[0]
    assert far == 10_000_000


@pytest.mark.parametrize("total,limit,want", [(10, 10, 10), (10, 7, 7), (1000, 40, 40), (0, 5, 0), (9, 0, 0)])
def test_drawn_numbers(spark, total, limit, want):
    groups = spark.createDataFrame([("k", total)], "key string, total long")
    got = [r.idx for r in pairs.drawn_numbers(groups, "key", limit, 1).collect()]
    assert len(got) == len(set(got)) == want and all(0 <= g < total for g in got)


def naive_random_clades(children, parent, distance, tips_in_order, order, share, back, cap):
    def below(n):
        return {n}.union(*(below(c) for c in children.get(n, [])))

    tip_set = set(tips_in_order)
    goal, most = max(1, int(len(tip_set) * share)), int(len(tip_set) * cap)
    test = set()
    for seed in order:
        if len(test & tip_set) >= goal:
            break
        if seed in test:
            continue
        at, gone = seed, 0
        while at in parent:
            gone += distance[at]
            if gone >= back:
                break
            at = parent[at]
        clade = below(at)
        if len(clade & tip_set) <= most:
            test |= clade
    return test


@pytest.mark.parametrize("seed", range(3))
def test_random_clades_against_naive(spark, seed):
    import hashlib

    rng = random.Random(seed)
    rows, children, parent, distance = [], {}, {}, {}
    for i in range(1, 90):
        p = f"n{rng.randrange(max(0, i - 12), i):03d}"
        c = f"n{i:03d}"
        children.setdefault(p, []).append(c)
        parent[c], distance[c] = p, rng.choice([0, 0, 1, 2])
        rows.append(("t_0001", p, c, str(distance[c]), "", DAY))
    tips = [c for c in parent if c not in children]
    order = sorted(tips, key=lambda t: hashlib.md5(f"{seed}:{t}".encode()).hexdigest())
    want = naive_random_clades(children, parent, distance, tips, order, 0.3, 2, 0.4)
    links = lineage.tree_links(spark.createDataFrame(rows, BRANCH_SCHEMA))
    cfg = settings(spark, test_proportion=0.3, mutations_back=2, max_clade_proportion=0.4, seed=seed)
    nodes = lineage.placed_nodes(links)
    got = random_clades.random_clades(nodes, links, lineage.tips_of(links), cfg, chunk=4096 if seed else 7)
    assert {r.node for r in got.where("split = 'test'").collect()} == want


def test_documents(spark):
    cut = json.dumps(tree_document())[:-20]
    colors = tree_document()
    colors["meta"]["colorings"] = [
        {"key": "k", "type": "categorical", "scale": [["u", "#1"], ["v", "#2"], ["u", "#3"]]},
        {"key": "n", "type": "continuous", "scale": [["u", "#1"]]},
    ]
    rows = [(1, "t", "t_0001", json.dumps(tree_document())), (2, "t", "t_0002", cut), (3, "t", "t_0003", None), (4, "t", "t_0004", json.dumps(colors))]
    auspice = spark.createDataFrame(rows, "record_id long, analysis string, dataset string, tree_json string").withColumn("gene", F.lit("clash"))
    side = spark.createDataFrame([("t_0004", "S", "CC")], "dataset string, gene string, seq string")
    cfg = settings(spark, trim_begin=2, trim_end=6)
    got = documents.reconstructed_sequences(auspice, side, cfg).collect()
    assert {r.name: r.seq for r in got} == SEQUENCES and {r.record_id for r in got} == {1}  # a sidecar without the gene doesn't fall back
    origins = {r.record_id: r.origin for r in documents.root_sequences(auspice, side, cfg).collect()}
    assert origins[1] == "document" and origins[4] is None
    counts = {r.node_path: (r.n_entries, r.n_counted) for r in documents.mutation_counts(auspice, cfg).where("record_id = 1").collect()}
    assert counts["0.0"] == (1, 0) and counts["0.0.0"] == (1, 1)
    assert {(r.field, r.n_nodes) for r in documents.metadata_fields(auspice).where("record_id = 1").collect()} == {("clade_membership", 11)}
    assert {(r.record_id, r.title, r.value, r.color) for r in documents.color_map(auspice).collect()} == {(4, "k", "u", "#3"), (4, "k", "v", "#2")}


def test_upsert(spark):
    old = spark.createDataFrame([("a", 1), ("b", 2)], "dataset string, n int")
    new = spark.createDataFrame([("b", 3), ("c", 4)], "dataset string, n int")
    assert {tuple(r) for r in summaries.upsert(old, new).collect()} == {("a", 1), ("b", 3), ("c", 4)}


def test_splits_are_closed_under_descendants(spark, tree):
    split = random_clades.random_clades(lineage.placed_nodes(tree[0]), tree[0], tree[1], settings(spark, test_proportion=0.5, mutations_back=1, max_clade_proportion=0.5))
    test = {r.node for r in split.where("split = 'test'").collect()}
    assert test and {r.node for r in tree[2].collect() if r.anc in test} == test


def test_settings_out_of_range(spark, tree):
    for wrong in ({"test_proportion": 1.5}, {"max_clade_proportion": -0.1}, {"mutations_back": -1}):
        with pytest.raises(Exception, match="out of range"):
            random_clades.random_clades(lineage.placed_nodes(tree[0]), tree[0], tree[1], settings(spark, **wrong)).collect()


def test_deep_ladder(spark):
    """A ladder of 5,000 nodes: everything but whole paths stays near its number of rows."""
    n = 5_000
    links = spark.range(n).selectExpr("'t_1' as dataset", "format_string('n%06d', id) as parent", "format_string('n%06d', id + 1) as child", "1 as hamming", "'test' as split")
    nodes = lineage.ranked_nodes(links)
    got = nodes.agg(F.max("depth"), F.sum("size"), F.max("n_leaves")).first()
    assert tuple(got) == (n, (n + 1) * (n + 2) // 2, 1)
    assert lineage.depths(links).agg(F.max("depth")).first()[0] == n
    tips = lineage.tips_of(links)
    assert lineage.walk_back(links, tips, settings(spark, mutations_back=4_000)).first().clade_root == "n001001"
    assert lineage.clade_membership(links, tips).first().clade_root == "n000001"


def test_every_pair_without_a_limit(spark, tree, monkeypatch):
    links, tips, _, alignment = tree
    monkeypatch.setattr(pairs, "BLOCK", 2)
    monkeypatch.setattr(pairs, "STRIDE", 4)
    train = tips.where("split = 'train'")
    named = {(r.tip1, r.tip2) for r in pairs.pairs_within(train, "dataset", "tip").collect()}
    assert named == {(a, b) for a in "EFGH" for b in "EFGH" if a < b}
    got = {(r.tip1, r.tip2): r.hamming for r in pairs.every_pair(train, ["dataset"], "tip", alignment).collect()}
    assert got == {("E", "F"): 1, ("E", "G"): 1, ("E", "H"): 4, ("F", "G"): 0, ("F", "H"): 3, ("G", "H"): 3}
    without = alignment.where("name <> 'F'")
    assert {(r.tip1, r.tip2) for r in pairs.every_pair(train, ["dataset"], "tip", without).collect()} == {p for p in got if "F" not in p}
    members = lineage.clade_membership(links, tips)
    assert [(r.clade_root, r.tip1, r.tip2, r.hamming) for r in pairs.every_pair(members, ["dataset", "clade_root"], "tip", alignment).collect()] == [("x", "Y", "Z", 2)]
    assert pairs.pairs_within_clades(members).count() == 1
    assert pairs.every_pair(train.limit(0), ["dataset"], "tip", alignment).count() == 0
    with pytest.raises(ValueError):
        pairs.pairs_within(train, "dataset", "tip", -1)


def test_pair_files(spark, tree):
    rows = spark.createDataFrame([("t_0001", "hCoV-19/A b", "E", 4, "A" * 61, "")], "dataset string, tip1 string, tip2 string, hamming int, seq1 string, seq2 string")
    made = pairs.pair_files(rows, "pairwise-test").first()
    assert made.file_path == "pairwise-test/Ab__E.fasta"
    assert made.content == ">hCoV-19/A b|0\n" + "A" * 60 + "\nA\n>E|4\n"
    kept = pairs.with_sequences(pairs.pairs_within(tree[1].where("split = 'test'"), "dataset", "tip", 9), tree[3], keep=True).first()
    assert (kept.seq1, kept.seq2, kept.hamming) == (SEQUENCES["Y"], SEQUENCES["Z"], 2)


def test_merge_keeps_other_columns(spark):
    old = spark.createDataFrame([("a", 1, 5), ("b", 2, 6)], "dataset string, n int, m int")
    new = spark.createDataFrame([("b", None, 7), ("c", 4, 8)], "dataset string, n int, k int")
    got = {r.dataset: (r.n, r.m, r.k) for r in summaries.merge(old, new).collect()}
    assert got == {"a": (1, 5, None), "b": (None, 6, 7), "c": (4, None, 8)}


def test_summary_entries(spark):
    names = "n_tips n_train n_test min_distance max_distance sum_distance min_depth max_depth sum_depth n_branches n_zero min_hamming max_hamming sum_hamming".split()
    names += "n_sequences sequence_length n_test_clades train_pairs train_min train_max train_sum test_pairs test_min test_max test_sum".split()
    values = [6, 4, 2, 1, 3, 11, 2, 4, 18, 10, 3, 0, 2, 8, 11, 8, 1, 6, 0, 4, 12, 0, None, None, None]
    row = spark.createDataFrame([("t_0001", *values)], "dataset string, " + ", ".join(f"{n} long" for n in names))
    urls = spark.createDataFrame([("t_0001", "u")], "dataset string, url string")
    got = json.loads(summaries.entries(row, urls).first().entry)
    assert got["url"] == "u" and got["hamming_from_root"] == {"min": 1, "max": 3, "mean": 1.83} and got["pairwise_train_hamming"]["mean"] == 2.0
    assert got["pairwise_test_pairs"] == 0 and "pairwise_test_hamming" not in got


def test_metadata_lines(spark):
    document = {"strain": "hCoV-19/r", "attr": {"k": {"value": "x"}, "div": 1}, "children": [{"name": "a", "node_attrs": {"clade": {"value": 2}, "j": {"value": "y\u00e9"}}}, {"name": "NODE_2", "node_attrs": {"late": {"value": 3}}}]}
    df = spark.createDataFrame([(1, json.dumps(document)), (2, '{"name":"alone"}'), (3, "{"), (4, None)], "record_id long, tree_json string")
    lines = {}
    for r in documents.metadata_lines(df).orderBy("record_id", "place").collect():
        lines.setdefault(r.record_id, []).append(r.line)
    assert lines[1] == ["name\tparent\tclade\tj\tk", "a\tr\t2\ty\u00e9\t", "NODE_2\tr\t\t\t", "r\tNone\t\t\tx"]
    assert lines[2] == ["name\tparent", "alone\tNone"] and set(lines) == {1, 2}
    assert documents.metadata_lines(df.limit(0)).count() == 0
    fields = {r.field for r in documents.metadata_fields(df, None).where("record_id = 1").collect()}
    assert fields == {"clade", "j", "k"}


def test_sequences_of_odd_documents(spark):
    node = lambda name, muts, *children: {"name": name, "branch_attrs": {"mutations": muts}, "children": list(children)}
    deep = node("r", {"nuc": ["A1T"]}, node("a", {"nuc": ["A1C", "A1G", "x", "", 5, None, "A99C", "A 2 T", "A+3C"], "S": ["A4T"]}, node("b", {"nuc": ["G1A"]}), None, node("c", "odd")), node("d", {"nuc": "odd"}))
    df = spark.createDataFrame([(1, "t_1", json.dumps({"version": "v2", "root_sequence": {"nuc": "AAAA"}, "tree": deep})), (2, "t_2", "{")], "record_id long, dataset string, tree_json string")
    side = spark.createDataFrame([], "dataset string, gene string, seq string")
    got = {r.node_path: r.seq for r in documents.reconstructed_sequences(df, side, settings(spark)).collect()}
    assert got == {"0": "AAAA", "0.0": "GTCA", "0.0.0": "ATCA", "0.0.2": "GTCA", "0.1": "AAAA"}
