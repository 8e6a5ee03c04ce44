import json

import pytest
from pyspark.sql import functions as F

from cladeflow.operators import documents, nested
from cladeflow.plans import pipeline
from cladeflow.sources import formats
from tests.test_lineage import settings
from tests.tree_example import DAY, LINKS, SEQUENCES, tree_document

SCHEMA = "record_id long, analysis string, dataset string, schema_version string, fetched_at timestamp, tree_json string"


def test_from_documents(spark):
    old = tree_document()
    old["tree"]["children"] = []
    rows = [(1, "t", "t_0001", "v2", DAY, json.dumps(tree_document())), (2, "t", "t_0001", None, None, json.dumps(old)), (3, "t", "t_0001", "v2", DAY, json.dumps(tree_document())[:90])]
    auspice = spark.createDataFrame(rows, SCHEMA)
    side = spark.createDataFrame([], "dataset string, gene string, seq string")
    cfg = settings(spark, test_proportion=0.34)
    made = pipeline.provision(auspice, side, cfg, "monophyletic")
    assert {(r.parent, r.child): r.hamming for r in made.links.collect()} == {(p, c): h for p, c, h in LINKS}
    assert {r.name: r.seq for r in made.alignment.collect()} == SEQUENCES
    assert {r.child for r in made.links.where("split = 'test'").collect()} == {"d", "E", "F"}
    frames = made.frames().where("tip = 'E'").orderBy("pos").collect()
    assert [(r.node, r.cum_dist) for r in frames] == [("d", 0), ("E", 1)]
    assert [{r.tip1, r.tip2} for r in made.test_pairs(10).collect()] == [{"E", "F"}]
    assert made.train_pairs(100).count() == made.train_pairs().count() == 6
    assert {r.name for r in made.alignment_records(tips_only=True).collect()} == set("EFGHYZ")
    assert made.alignment_records().where("name = 'E'").first().record == ">E\nCGTAAAAA\n"
    with pytest.raises(ValueError):
        pipeline.provision(auspice, side, cfg, "other")
    labelled = documents.annotated_documents(auspice, made.splits)
    again = {r.record_id: json.loads(r.tree_json) for r in labelled.collect()}
    assert set(again) == {1, 2} and again[1]["meta"]["colorings"][0]["key"] == "train_test"
    values = nested.attributes_table(nested.flatten_documents(labelled)).where("field = 'train_test' and record_id = 1 and value = 'test'")
    assert values.count() == 3
    twice = documents.annotated_documents(labelled.withColumn("dataset", F.lit("t_0001")), made.splits)
    assert {r.record_id: json.loads(r.tree_json) for r in twice.collect()} == again


def test_prefixed_names_labelled(spark):
    text = json.dumps(tree_document()).replace('"name": "E"', '"name": "hCoV-19/E"').replace('"name": "G"', '"name": "hCoV-19/G"')
    auspice = spark.createDataFrame([(1, "t", "t_0001", "v2", DAY, text)], SCHEMA)
    side = spark.createDataFrame([], "dataset string, gene string, seq string")
    made = pipeline.provision(auspice, side, settings(spark, test_proportion=0.34), "monophyletic")
    for splits in (made.splits, made.splits.withColumn("node", F.concat(F.lit("hCoV-19/"), "node"))):
        labelled = documents.annotated_documents(auspice, splits)
        rows = nested.attributes_table(nested.flatten_documents(labelled)).where("field = 'train_test'").select("node_path", "value")
        nodes = nested.nodes_table(nested.flatten_documents(labelled, ("node",)))
        got = {r.name: r.value for r in nodes.join(rows, "node_path").collect()}
        assert {n for n, v in got.items() if v == "test"} == {"d", "hCoV-19/E", "F"} and got["hCoV-19/G"] == "train"


def test_write_deep():
    value = {"a": [1, 2.5, None, True, "é\""], "b": {}, "c": [], "d": {"e": [[{}]]}}
    assert json.loads(nested.write_deep(value)) == value
    deep: list = []
    for _ in range(5000):
        deep = [deep]
    assert nested.write_deep(deep) == "[" * 5001 + "]" * 5001


def test_settings_and_sources(spark, tmp_path):
    (tmp_path / "c.json").write_text(json.dumps({"analysis": {"a-xs": {"dataset": "x", "gene": "nuc", "trim_begin": 1}}}))
    row = formats.read_analyses(spark, str(tmp_path / "c.json")).first()
    assert (row.analysis, row.gene, row.trim_begin, row.seed) == ("a-xs", "nuc", 1, None)
    assert formats.read_analyses(spark, str(tmp_path / "c.json"), ["a-xs"]).count() == 1 and formats.read_analyses(spark, str(tmp_path / "c.json"), []).count() == 0
    with pytest.raises(ValueError):
        formats.read_analyses(spark, str(tmp_path / "c.json"), ["none"])
    assert formats.resolve_source("s3://b/k") == "s3a://b/k" and formats.resolve_source("file:///x") == "file:///x"
    with pytest.raises(ValueError):
        formats.resolve_source("https://x")
    for name in ("fam/subtrees/fam_001.json", "fam/subtrees/other_002.json", "off/subtrees/off_1.json"):
        (tmp_path / "s" / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / "s" / name).write_text("{}")
    assert [r.dataset for r in formats.discover_subtrees(spark, str(tmp_path / "s"), ["fam"]).collect()] == ["fam-xs_001"]
