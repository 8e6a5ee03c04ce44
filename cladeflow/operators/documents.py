"""What a run takes from its tree documents besides the nodes: sequences, mutation counts, fields, colors."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cladeflow.functions.names import clean_name
from cladeflow.functions.sequences import mutation_position
from cladeflow.operators import nested
from cladeflow.operators.lineage import analysis_of
from cladeflow.session import written

# Fixed values.
KNOWN_FIELDS = ["clade_membership", "clade", "S1_mutations", "family_name"]
FIELD_SAMPLE = 100
DEFAULT_GENE = "nuc"
_PLACE = re.compile(r"[+-]?\d{1,9}")
_COLORINGS = "array<struct<key:string,title:string,type:string,scale:array<array<string>>>>"


def complete_documents(auspice: DataFrame, nodes: DataFrame) -> DataFrame:
    """The rows of auspice whose document is complete and holds a tree."""
    return auspice.join(nodes.where("depth = 0").select("record_id"), "record_id", "left_semi")


def genes(auspice: DataFrame, analyses: DataFrame) -> DataFrame:
    """record_id, dataset, gene, trim_begin, trim_end by the analysis's settings."""
    settings = F.broadcast(analyses.select("analysis", F.col("gene").alias("g"), "trim_begin", "trim_end"))
    rows = auspice.select("record_id", "dataset").withColumn("analysis", analysis_of()).join(settings, "analysis", "left")
    return rows.select("record_id", "dataset", F.coalesce("g", F.lit(DEFAULT_GENE)).alias("gene"), "trim_begin", "trim_end")


def root_sequences(auspice: DataFrame, sidecars: DataFrame, analyses: DataFrame) -> DataFrame:
    """record_id, gene, seq, origin: the sidecar's sequence if the dataset has a sidecar, else the document's own.

    A sidecar without the gene doesn't fall back to the document. seq and origin are null where there is
    none; of several sidecar rows of a gene the largest sequence counts.
    """
    wanted = genes(auspice, analyses).join(auspice.select("record_id", "tree_json"), "record_id")
    inline = F.from_json(F.get_json_object("tree_json", "$.root_sequence"), "map<string,string>")
    has = sidecars.select("dataset", F.lit(True).alias("has_sidecar")).distinct()
    seqs = sidecars.groupBy("dataset", "gene").agg(F.max("seq").alias("side_seq"))
    joined = wanted.join(has, "dataset", "left").join(seqs, ["dataset", "gene"], "left")
    own = F.try_element_at(inline, F.col("gene"))
    seq = F.when(F.col("has_sidecar"), F.col("side_seq")).otherwise(own)
    origin = F.when(seq.isNull(), None).when(F.col("has_sidecar"), "sidecar").otherwise("document")
    return joined.select("record_id", "gene", F.nullif(seq, F.lit("")).alias("seq"), origin.alias("origin"))


def _changes(node: dict, gene: str, length: int) -> list[tuple[int, str]]:
    """(place from 0, base) of a node's well-formed mutations of the gene within the sequence, in their order."""
    found = []
    for of, _, entry in nested.mutations_of(node):
        entry = nested.as_text(entry)
        if of == gene and _PLACE.fullmatch(entry[1:-1].strip()) and 1 <= int(entry[1:-1]) <= length:
            found.append((int(entry[1:-1]) - 1, entry[-1]))
    return found


def node_sequences_of(root: dict, gene: str, seq: str) -> Iterator[tuple[str, str, str]]:
    """(node_path, name, sequence) of every node: one walk that puts changes in on the way down and takes them back on the way up."""
    bases, stack = list(seq), [(root, "0", None)]
    while stack:
        node, path, undo = stack.pop()
        if undo is not None:
            for at, base in reversed(undo):
                bases[at] = base
            continue
        undo = []
        for at, base in _changes(node, gene, len(bases)) if path != "0" else ():
            undo.append((at, bases[at]))
            bases[at] = base
        stack.append((node, path, undo))
        yield path, nested.node_name(node), "".join(bases)
        children = node.get("children")
        if isinstance(children, list):
            stack += [(c, f"{path}.{no}", None) for no, c in reversed(list(enumerate(children))) if isinstance(c, dict)]


def reconstructed_sequences(auspice: DataFrame, sidecars: DataFrame, analyses: DataFrame) -> DataFrame:
    """record_id, node_path, name, seq: every node's sequence from the root's and the mutations on its path.

    Of mutations at one site the deepest counts, then the later entry. The root's own mutations don't
    apply, nor do malformed ones or those beyond the sequence. Documents without a root sequence, broken ones and those
    without a tree give no rows. A document is walked once; a node costs its changes and its sequence.
    """
    roots = root_sequences(auspice, sidecars, analyses).where("seq is not null").distinct()
    rows = auspice.where("tree_json is not null").select("record_id", "tree_json").repartition("record_id").join(roots.select("record_id", "gene", "seq"), "record_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["record_id", "node_path", "name", "seq"]
        for batch in batches:
            made, chars = [], 0
            for record, text, gene, seq in zip(*(batch.column(c) for c in ("record_id", "tree_json", "gene", "seq"))):
                root = nested.root_of(nested.parse_document(text.as_py()))
                for row in node_sequences_of(root, gene.as_py(), seq.as_py()) if root is not None else ():
                    made.append((record.as_py(), *row))
                    chars += len(row[0]) + len(row[2]) + 60
                    if chars > nested.BATCH_CHARS:
                        ids, *columns = zip(*made)
                        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), *map(nested.strings, columns)], names)
                        made, chars = [], 0
            if made:
                ids, *columns = zip(*made)
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), *map(nested.strings, columns)], names)

    return rows.mapInArrow(run, "record_id long, node_path string, name string, seq string")


def mutation_counts(auspice: DataFrame, analyses: DataFrame) -> DataFrame:
    """record_id, node_path, n_entries, n_counted: entries of the analysis's gene a branch that has any.

    n_counted are those within the trimmed region where both bounds are given (malformed ones not), else all.
    """
    muts = nested.mutations_table(nested.flatten_documents(auspice, ("node", "mutation")))
    at = muts.join(genes(auspice, analyses).drop("dataset"), ["record_id", "gene"])
    pos = mutation_position(F.expr("substr(item, length(gene) + 2)"))
    bounded = F.col("trim_begin").isNotNull() & F.col("trim_end").isNotNull()
    counted = ~bounded | F.coalesce(pos.between(F.col("trim_begin"), F.col("trim_end")), F.lit(False))
    return at.groupBy("record_id", "node_path").agg(F.count("*").alias("n_entries"), F.count_if(counted).alias("n_counted"))


def metadata_fields(auspice: DataFrame, sample: int | None = FIELD_SAMPLE) -> DataFrame:
    """record_id, field, n_nodes: the columns of a document's metadata table.

    Fields with a text value on one of the first `sample` nodes in post-order (all nodes for None), and the known ones, as far
    as a node carries them as object with `value`; n_nodes counts those nodes. The sample of 100 is a fixed value of the format.
    """
    return _fields(written(nested.flatten_documents(auspice, ("node", "attribute")), "fields"), sample)


def _fields(items: DataFrame, sample: int | None) -> DataFrame:
    attributes = nested.attributes_table(items).where("shape <> 'plain'")
    text = attributes.where("shape = 'text'")
    if sample is not None:
        rank = F.row_number().over(Window.partitionBy("record_id").orderBy("post"))
        early = items.where("item_kind = 'node'").select("record_id", F.col("pre").alias("node_pre"), rank.alias("rank")).where(F.col("rank") <= sample)
        text = text.join(early, ["record_id", "node_pre"], "left_semi")
    counts = attributes.groupBy("record_id", "field").agg(F.count("*").alias("n_nodes"))
    known = counts.where(F.col("field").isin(KNOWN_FIELDS))
    return counts.join(text.select("record_id", "field").distinct(), ["record_id", "field"], "left_semi").unionByName(known).distinct()


def metadata_lines(auspice: DataFrame, sample: int | None = FIELD_SAMPLE) -> DataFrame:
    """record_id, place, line of every document's metadata table: a header (place -1) and its nodes in post-order (place: post).

    Columns are name, parent and the fields of metadata_fields() in their order; a missing value is empty, a missing parent `None`.
    """
    items = written(nested.flatten_documents(auspice, ("node", "attribute")), "fields")
    nodes = nested.nodes_table(items).withColumn("name", clean_name("name"))
    fields = _fields(items, sample)
    heads = nodes.where("depth = 0").select("record_id").distinct().join(fields, "record_id", "left")
    heads = heads.groupBy("record_id").agg(F.sort_array(F.collect_set("field")).alias("fields"))
    values = nested.attributes_table(items).where("shape <> 'plain'").select("record_id", F.col("node_pre").alias("pre"), "field", "value")
    held = values.groupBy("record_id", "pre").agg(F.map_from_entries(F.collect_list(F.struct("field", "value"))).alias("held"))
    above = nodes.select("record_id", F.col("pre").alias("parent_pre"), F.col("name").alias("parent"))
    whole = nodes.join(above, ["record_id", "parent_pre"], "left").join(held, ["record_id", "pre"], "left").join(heads, "record_id")
    cells = F.transform("fields", lambda f: F.coalesce(F.try_element_at("held", f), F.lit("")))
    line = F.array_join(F.concat(F.array(F.col("name"), F.coalesce("parent", F.lit("None"))), cells), "\t")
    head = F.array_join(F.concat(F.array(F.lit("name"), F.lit("parent")), F.col("fields")), "\t")
    return heads.select("record_id", F.lit(-1).cast("long").alias("place"), head.alias("line")).unionByName(whole.select("record_id", F.col("post").alias("place"), line.alias("line")))


def color_map(auspice: DataFrame) -> DataFrame:
    """record_id, field, title, value, color of the categorical colorings with a scale.

    A later coloring of a field replaces an earlier one, a later color of a value the earlier; a missing
    title is the field. Broken documents give no rows.
    """
    nodes = nested.nodes_table(nested.flatten_documents(auspice, ("node",)))
    parsed = complete_documents(auspice, nodes).select("record_id", F.posexplode(F.from_json(F.get_json_object("tree_json", "$.meta.colorings"), _COLORINGS)).alias("no", "c"))
    used = parsed.where("c.type = 'categorical' and c.scale is not null")
    last = used.groupBy("record_id", F.col("c.key").alias("field")).agg(F.max_by("c", "no").alias("c"))
    scale = last.select("record_id", "field", F.coalesce("c.title", "field").alias("title"), F.posexplode("c.scale").alias("at", "s"))
    return scale.groupBy("record_id", "field", "title", F.col("s")[0].alias("value")).agg(F.max_by(F.col("s")[1], "at").alias("color"))


# The coloring that shows a split.
SPLIT_COLORING = {"key": "train_test", "title": "Train/Test Split", "type": "categorical", "scale": [["train", "#4C78A8"], ["test", "#E45756"]]}


def annotated_documents(auspice: DataFrame, splits: DataFrame) -> DataFrame:
    """record_id, tree_json with `train_test` on every named node and among the colorings.

    splits: dataset, node, split; a node without one is train. Names are compared without prefix. A coloring that
    is there already is replaced in its place. Documents that are broken or hold no tree give no rows; a `meta` or
    `colorings` of another type is replaced. Labels meet the flattened nodes in a join, and a document gets the
    numbers of its own test nodes only.
    """
    nodes = nested.nodes_table(nested.flatten_documents(auspice, ("node",))).where("name <> ''").select("record_id", "pre", clean_name("name").alias("node"))
    test = splits.where("split = 'test'").select("dataset", clean_name("node").alias("node")).distinct()
    marked = nodes.join(auspice.select("record_id", "dataset").distinct(), "record_id").join(test, ["dataset", "node"], "left_semi")
    numbers = marked.groupBy("record_id").agg(F.collect_set("pre").alias("test"))  # fewer than the document has nodes
    rows = auspice.select("record_id", "tree_json").join(numbers, "record_id", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = [], []
            for record, text, numbers in zip(*(batch.column(c).to_pylist() for c in ("record_id", "tree_json", "test"))):
                document = nested.parse_document(text)
                root = nested.root_of(document)
                if root is None:
                    continue
                held = set(numbers or ())
                found = [(pre, node) for pre, node in nested.numbered_nodes(root) if nested.node_name(node)]
                for pre, node in found:  # after the walk, as the label is an attribute too
                    if not isinstance(node.get("node_attrs"), dict):
                        node["node_attrs"] = {}
                    node["node_attrs"]["train_test"] = {"value": "test" if pre in held else "train"}
                if document is not root:
                    meta = document["meta"] = document["meta"] if isinstance(document.get("meta"), dict) else {}
                    colorings = list(meta["colorings"]) if isinstance(meta.get("colorings"), list) else []
                    at = [k for k, c in enumerate(colorings) if isinstance(c, dict) and c.get("key") == "train_test"]
                    if at:
                        colorings[at[0]] = colorings[at[0]] | SPLIT_COLORING
                    else:
                        colorings.append(SPLIT_COLORING)
                    meta["colorings"] = colorings
                ids.append(record)
                texts.append(nested.write_deep(document))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), nested.strings(texts)], ["record_id", "tree_json"])

    return rows.mapInArrow(run, "record_id long, tree_json string")
