import datetime as dt
import json
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from cladeflow.operators import compaction, hierarchy, hot_keys, nested, shards
from cladeflow.operators.dense_ids import dense_ids, ordinals, running_before
from cladeflow.operators.intervals import interval_blocks, point_blocks
from tests.tree_example import BRANCH_SCHEMA, DAY, tree_document


# ------------------------------------------------------------------------------------------ dense keys


@pytest.mark.parametrize("keys_limit", [hot_keys.BROADCAST_KEYS, 0])
def test_dense_key_stats(spark, monkeypatch, keys_limit):
    monkeypatch.setattr(hot_keys, "BROADCAST_KEYS", keys_limit)
    monkeypatch.setattr(hot_keys, "BLOCK", 4)
    monkeypatch.setattr(hot_keys, "BLOCKS_HELD", 2)
    rng = random.Random(1)
    rows = [("hot" if rng.random() < 0.6 else rng.choice(["", None, *[f"k{i}" for i in range(30)]]), rng.choice([None, *range(-9, 9)]), rng.choice("abc")) for _ in range(3000)]
    df = spark.createDataFrame(rows, "k string, v long, d string").withColumn("code", F.lit("clash")).withColumn("block", F.lit(0))
    got = hot_keys.dense_key_stats(df, F.col("k"), "key", {"total": F.col("v")}, {"low": F.col("v")}, {"high": F.col("v")}, {"n_d": F.col("d")})
    groups = defaultdict(list)
    for k, v, d in rows:
        groups[k].append((v, d))
    want = {}
    for k, g in groups.items():
        v = [x for x, _ in g if x is not None]
        want[k] = (len(g), sum(v), min(v, default=None), max(v, default=None), len({d for _, d in g}))
    del want[None]
    assert {r.key: (r.rows, r.total, r.low, r.high, r.n_d) for r in got.collect()} == want
    assert {r.key for r in hot_keys.keys_above_share(df, F.col("k"), "key", 0.3).collect()} == {"hot"}
    assert hot_keys.dense_key_stats(df.limit(0), F.col("k"), "key").count() == 0


def test_numbering(spark):
    rows = [("b", 2), ("a", 1), ("a", 3), ("b", 2), (None, 1), ("c", None)]
    df = spark.createDataFrame(rows, "g string, v int").withColumn("other", F.lit(1))
    assert [(r.g, r.v, r.i) for r in dense_ids(df, ["g", "v"], "i").orderBy("i").collect()] == [("a", 1, 0), ("a", 3, 1), ("b", 2, 2)]
    assert {(r.g, r.v, r.o, r.n) for r in ordinals(df, ["g"], ["v"], "o").collect()} == {("a", 1, 0, 2), ("a", 3, 1, 2), ("b", 2, 0, 1)}
    sums = running_before(spark.range(100), ["id"], "id", "before").collect()
    assert all(r.before == r.id * (r.id - 1) // 2 for r in sums)
    assert dense_ids(df.limit(0), ["g"], "i").count() == 0


def test_interval_blocks(spark):
    rng = random.Random(2)
    spans = [(i, rng.randrange(64), rng.randrange(0, 30)) for i in range(60)]
    left = interval_blocks(spark.createDataFrame(spans, "s long, low long, size long"), "low", "size")
    right = point_blocks(spark.range(100).withColumn("top", F.lit(128).cast("long")), "id", "top")
    got = [(r.s, r.id) for r in left.join(right, ["level", "block"]).select("s", "id").collect()]
    assert sorted(got) == sorted((s, p) for s, low, size in spans for p in range(low, min(100, low + size)))


# ------------------------------------------------------------------------------------ nested documents


def chain(depth):
    text = '{"name":"t"}'
    for i in range(depth):
        text = '{"name":"n%d","children":[%s]}' % (i, text)
    return '{"version":"v2","tree":' + text + "}"


def test_nested_documents(spark):
    odd = {
        "strain": "r", "attr": {"div": 1.5, "num": {"value": "x"}}, "branch_attrs": None,
        "children": [None, {"children": [], "branch_attrs": {"mutations": {"nuc": ["A1C", None, 5, "A1C"], "S": "no list"}}}, {"name": "n", "node_attrs": ["no object"]}],
    }
    rows = [(1, json.dumps(odd)), (2, json.dumps(tree_document())[:-1]), (3, None), (4, ""), (5, "[1]"), (6, '{"meta":{}}'), (7, '{"tree":null}'), (8, chain(3000)), (9, chain(3000)[:-1]), (1, json.dumps(odd))]
    df = spark.createDataFrame(rows, "record_id long, tree_json string").withColumn("pre", F.lit(0)).withColumn("item", F.lit("clash"))
    items = nested.flatten_documents(df).cache()
    assert {r.record_id for r in items.select("record_id").distinct().collect()} == {1, 8}
    first = items.where("record_id = 1")
    nodes = Counter((r.node_path, r.sibling_no, r.name) for r in nested.nodes_table(first).collect())
    assert nodes == {("0", 0, "r"): 2, ("0.1", 1, ""): 2, ("0.2", 2, "n"): 2}
    muts = Counter((r.node_path, r.item_no, r.item) for r in nested.mutations_table(first).collect())
    assert muts == {("0.1", 0, "nuc:A1C"): 2, ("0.1", 1, "nuc:null"): 2, ("0.1", 2, "nuc:5"): 2, ("0.1", 3, "nuc:A1C"): 2}
    assert {(r.field, r.value, r.shape) for r in nested.attributes_table(first).collect()} == {("div", "1.5", "plain"), ("num", "x", "text")}
    assert items.where("record_id = 8").count() == 3001
    assert nested.flatten_documents(df.limit(0)).count() == 0


def test_interval_labels_contain_what_they_carry(spark):
    df = spark.createDataFrame([(1, json.dumps(tree_document()))], "record_id long, tree_json string")
    items = nested.flatten_documents(df)
    nodes = {r.pre: r for r in nested.nodes_table(items).collect()}
    for r in items.collect():
        around = [n for n in nodes.values() if n.pre < r.pre and r.post < n.post]
        assert (max(n.pre for n in around) if around else None) == r.parent_pre


def test_tables_made_apart_have_the_same_labels(spark):
    rows = [(1, json.dumps(tree_document())), (2, json.dumps({"strain": "r", "attr": {"div": 1, "x": None}, "children": [tree_document()["tree"]]}))]
    df = spark.createDataFrame(rows, "record_id long, tree_json string")
    nodes = nested.nodes_table(nested.flatten_documents(df, ("node",)))
    spans = {(r.record_id, r.pre): r for r in nodes.collect()}
    for kind, made in (("attribute", nested.attributes_table), ("mutation", nested.mutations_table)):
        items = made(nested.flatten_documents(df, (kind,))).collect()
        assert items
        for r in items:
            node = spans[r.record_id, r.node_pre]
            around = [n for n in spans.values() if n.record_id == r.record_id and n.pre < r.pre < n.post]
            assert node.node_path == r.node_path and max(n.pre for n in around) == r.node_pre


@pytest.mark.parametrize("word", ["NaN", "Infinity", "-Infinity"])
def test_no_constants_at_any_depth(word):
    for depth in (0, 3000):
        text = '{"a":' * depth + '{"a":%s}' + "}" * depth
        assert nested.parse_document(text % word) is None and nested.parse_document(text % "1") is not None


def test_half_surrogates_and_deep_values(spark):
    deep = '{"name":"n\\ud800","node_attrs":{"x":{"value":' + "[" * 3000 + "]" * 3000 + "}}}"
    df = spark.createDataFrame([(1, deep)], "record_id long, tree_json string")
    got = {r.item_kind: r.item for r in nested.flatten_documents(df).collect()}
    assert got == {"node": "n?", "attribute": "[" * 3000 + "]" * 3000}


@pytest.mark.parametrize("text", ["[1, 2.5e3, -0, true, null, \"a\\u00e9\\\"\"]", '{"a": {"b": []}, "c": {}}', " 3 "])
def test_parse_deep(text):
    assert nested.parse_deep(text) == json.loads(text)


@pytest.mark.parametrize("text", ["", "[1,]", '{"a" 1}', "[1] 2", '{"a": 1', "{1: 2}", "[1 2]", "nul"])
def test_parse_deep_rejects(text):
    with pytest.raises(ValueError):
        nested.parse_deep(text)


# ------------------------------------------------------------------------------------------- compaction

FILES = "file_id long, dataset string, kind string, file_name string, file_text string, modified_at timestamp"


def test_current_files_and_compaction(spark):
    day = lambda d: dt.datetime(2024, 1, d)
    rows = [
        (1, "d", "forwards-train", "a.fasta", ">x\nA", day(1)), (2, "d", "forwards-train", "a.fasta", ">x\nC", day(2)),
        (3, "d", "forwards-train", "a.fasta", "", day(3)), (4, "d", "forwards-train", "a.fasta.part", ">x\nC", day(3)),
        (5, "d", "forwards-test", "b.fasta", ">x\nA", day(1)), (6, "d", "pairwise-train", "a.fasta", "junk\n>y|0\n" + "A" * 200_000, None),
        (7, "e", "forwards-train", "t.fasta", ">x\nA", day(1)), (8, "e", "forwards-train", "t.fasta", ">x\nA", day(1)),
        (9, None, "forwards-train", "a.fasta", ">x\nA", day(1)), (10, "d", None, "a.fasta", ">x\nA", day(1)), (11, "d", "forwards-train", None, None, None),
    ]
    df = spark.createDataFrame(rows, FILES).repartition(4)
    current = compaction.current_files(df, ["forwards-train", "pairwise-train"])
    assert {r.file_id for r in current.collect()} == {2, 6, 8}
    back, listing = compaction.compact(current.unionByName(current), 1 << 20, "test")
    assert Counter(r.file_id for r in back.collect()) == {2: 2, 6: 2, 8: 2}
    assert listing.count() == 1
    assert compaction.compact(df.limit(0), 1 << 20, "none")[0].count() == 0


def test_compaction_reaches_its_size(spark):
    df = spark.range(200_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("t")).repartition(64)
    target = 1 << 20
    back, listing = compaction.compact(df, target, "sized")
    sizes = [r.n_bytes for r in listing.collect()]
    assert back.count() == 200_000 and 4 <= len(sizes) <= 64
    assert target / 2.5 < sum(sizes) / len(sizes) < target * 2.5


def test_checksum_sees_lost_and_repeated_rows(spark):
    df = spark.range(10).withColumn("n", F.lit(None).cast("int"))
    whole = compaction.multiset_checksum(df)
    assert whole == compaction.multiset_checksum(df.repartition(3))
    assert whole != compaction.multiset_checksum(df.where("id <> 3").unionByName(df.where("id = 4")))


# -------------------------------------------------------------------------------------------- hierarchy


def graph(spark, links, dataset="t"):
    return spark.createDataFrame([(dataset, p, c, "1", "", DAY) for p, c in links], BRANCH_SCHEMA)


def naive_cycles(links):
    ahead = defaultdict(set)
    for p, c in links:
        if p is not None and c is not None:
            ahead[p].add(c)
    found = set()
    for s in list(ahead):
        seen, front = set(), set(ahead[s])
        while front:
            seen |= front
            front = set().union(*(ahead.get(n, set()) for n in front)) - seen
        if s in seen:
            found.add(s)
    return found


@pytest.mark.parametrize("seed", range(4))
def test_cycles_against_naive(spark, seed):
    rng = random.Random(seed)
    links = [(f"n{rng.randrange(max(0, i - 4), i)}", f"n{i}") for i in range(1, 70)]
    links += [(f"n{rng.randrange(70)}", f"n{rng.randrange(70)}") for _ in range(4 * seed)] + [("n3", "n3"), (None, "n5"), ("n6", None)]
    links += [(f"c{i}", f"c{(i + 1) % 41}") for i in range(41)] + [("c7", "c7"), ("c9", "below"), ("c1", "c30")]
    got = {r.node for r in hierarchy.cycle_nodes(graph(spark, links)).collect()}
    assert got == naive_cycles(links)


def test_cycles_of_a_dense_core(spark):
    """Strong components in which every node has several parents or children, with one-way links between them."""
    rng = random.Random(9)
    links = [(f"{c}{rng.randrange(60)}", f"{c}{rng.randrange(60)}") for c in "abc" for _ in range(180)]
    links += [(f"a{k}", f"d{k % 7}") for k in range(30)] + [(f"d{k}", f"b{k}") for k in range(7) for _ in range(2)] + [(f"d{k}", f"c{k + 1}") for k in range(7)]
    got = {r.node for r in hierarchy.cycle_nodes(graph(spark, links)).collect()}
    assert got == naive_cycles(links) and not any(n.startswith("d") for n in got)


def test_cycles_of_nothing(spark):
    assert hierarchy.cycle_nodes(graph(spark, []).limit(0)).count() == 0
    assert hierarchy.cycle_nodes(graph(spark, [("a", "b"), ("a", "b"), ("b", "c")])).count() == 0


def test_hierarchy(spark):
    links = [("r", "a"), ("r", "hCoV-19/b"), ("a", "c"), ("a", "d"), ("p", "q"), ("q", "p"), ("q", "u"), ("u", "v"), ("b", "d"), (None, "alone"), ("p", "c")]
    names = spark.createDataFrame([("t", "extra"), ("t", None), ("t", "r")], "dataset string, name string")
    got = {r.node: r for r in hierarchy.hierarchy(graph(spark, links), names).collect()}
    assert set(got) == {"r", "a", "b", "c", "d", "u", "v", "alone", "extra"}
    assert got["d"].path == ["r", "a", "d"] and got["c"].path == ["r", "a", "c"]  # a comes before b; p is on a cycle
    assert (got["r"].n_descendants, got["r"].depth, got["r"].entry, got["r"].exit) == (4, 0, 0, 4)
    assert got["u"].below_cycle and got["u"].parent is None and got["v"].root == "u" and got["v"].depth == 1
    for x in got.values():
        for y in got.values():
            inside = x.root == y.root and x.entry <= y.entry <= x.exit
            assert inside == (x.node in y.path)
    pairs = {(r.node, r.descendant, r.hops) for r in hierarchy.descendants(graph(spark, links)).collect()}
    assert pairs == {(n, x.node, len(x.path) - 1 - k) for x in got.values() for k, n in enumerate(x.path[:-1])}


# ----------------------------------------------------------------------------------------------- shards


def test_shards(spark):
    import io
    import tarfile

    import zstandard

    rows = [(i, "d", "forwards-train", f"f{i:02d}.fasta", f">x{i}\nA", DAY) for i in range(25)]
    df = spark.createDataFrame(rows, FILES)
    assigned = shards.shard_assignment(df, 42, 10)
    assert Counter(r.shard for r in assigned.collect()) == {"forwards-train-000.tar.zst": 10, "forwards-train-001.tar.zst": 10, "forwards-train-002.tar.zst": 5}
    assert {tuple(r) for r in assigned.collect()} == {tuple(r) for r in shards.shard_assignment(df.repartition(7), 42, 10).collect()}
    held = {}
    for r in shards.shard_payloads(df, assigned).collect():
        raw = zstandard.ZstdDecompressor().decompress(bytes(r.payload), max_output_size=1 << 24)
        assert len(raw) == r.n_raw
        with tarfile.open(fileobj=io.BytesIO(raw)) as tar:
            held |= {m.name: tar.extractfile(m).read().decode() for m in tar}
    assert held == {r[3]: r[4] for r in rows}
    payloads = shards.shard_payloads(df, assigned)
    totals = shards.shard_totals(payloads).first()
    assert (totals.n_shards, totals.n_files) == (3, 25) and totals.ratio == totals.raw_bytes / totals.packed_bytes
    assert shards.shard_totals(payloads.withColumn("payload", F.lit(b""))).first().ratio == 0
    assert shards.shard_assignment(df, 42, 100, flat=True).first().shard == "trajectories-000.tar.zst"
    with pytest.raises(ValueError):
        shards.shard_assignment(df, 42, 0)


def test_fraction_sample(spark):
    df = spark.createDataFrame([("d", f"n{i}") for i in range(29)] + [("e", "only")], "dataset string, name string")
    assert Counter(r.dataset for r in shards.fraction_sample(df, ["dataset"], "name", 0.2).collect()) == {"d": 5, "e": 1}
    with pytest.raises(ValueError):
        shards.fraction_sample(df, ["dataset"], "name", 0)
