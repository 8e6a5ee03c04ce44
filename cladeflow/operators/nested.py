"""Nested tree documents as flat tables, linked by depth-first interval labels.

One depth-first walk a document numbers everything it meets: a node gets `pre` when it is entered and
`post` when it is left, its attributes and mutations get numbers in between, before its children. An
item belongs to the innermost node whose interval holds its number, and one node lies below another
exactly if its interval lies within the other's.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from json.decoder import scanstring

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ITEMS = (
    "record_id long, pre long, post long, parent_pre long, depth int, node_path string, "
    "item_kind string, item_no int, field string, item string, shape string"
)
#: Characters of output text that a task gathers before it passes a batch on.
BATCH_CHARS = 8_000_000

_SPACE = re.compile(r"[ \t\n\r]*")
_NUMBER = re.compile(r"-?(?:0|[1-9]\d*)(?:\.\d+)?(?:[eE][+-]?\d+)?")
_WORDS = {"true": True, "false": False, "null": None}


def parse_deep(text: str):
    """JSON of any depth, with an explicit stack; ValueError unless the text is one whole document."""
    stack: list = []  # open containers; for objects with the key whose value comes next
    i = _SPACE.match(text, 0).end()
    while True:
        # a value starts at i
        ch = text[i : i + 1]
        opened = False
        if ch == "{" or ch == "[":
            value: object = {} if ch == "{" else []
            i = _SPACE.match(text, i + 1).end()
            if text[i : i + 1] == ("}" if ch == "{" else "]"):
                i += 1
            else:
                stack.append([value, None])
                opened = True
        elif ch == '"':
            value, i = scanstring(text, i + 1, True)
        elif m := _NUMBER.match(text, i):
            value, i = (float if re.search("[.eE]", m[0]) else int)(m[0]), m.end()
        else:
            for word, value in _WORDS.items():
                if text.startswith(word, i):
                    i += len(word)
                    break
            else:
                raise ValueError(f"no value at {i}")
        while not opened:
            i = _SPACE.match(text, i).end()
            if not stack:
                if i != len(text):
                    raise ValueError(f"text after the document at {i}")
                return value
            box, key = stack[-1]
            if isinstance(box, dict):
                box[key] = value
            else:
                box.append(value)
            ch, i = text[i : i + 1], _SPACE.match(text, i + 1).end()
            if ch == ",":
                break
            if ch != ("}" if isinstance(box, dict) else "]"):
                raise ValueError(f"container not closed at {i}")
            value = box
            stack.pop()
        if isinstance(stack[-1][0], dict):
            if text[i : i + 1] != '"':
                raise ValueError(f"no key at {i}")
            stack[-1][1], i = scanstring(text, i + 1, True)
            i = _SPACE.match(text, i).end()
            if text[i : i + 1] != ":":
                raise ValueError(f"no colon at {i}")
            i = _SPACE.match(text, i + 1).end()


def _no_constant(word: str):
    raise ValueError(f"{word} is no JSON")


def parse_document(text: str | None):
    """The document, or None where the text is null or not one complete JSON document. NaN and Infinity are no JSON."""
    if text is None:
        return None
    try:
        return json.loads(text, parse_constant=_no_constant)
    except RecursionError:
        try:
            return parse_deep(text)
        except ValueError:
            return None
    except ValueError:
        return None


def root_of(document) -> dict | None:
    """The root node: `tree` of a v2 document, the document itself in v1."""
    if not isinstance(document, dict):
        return None
    if "tree" in document:
        return document["tree"] if isinstance(document["tree"], dict) else None
    return None if {"version", "meta"} & document.keys() else document


def node_name(node: dict) -> str:
    for key in ("name", "strain"):
        if isinstance(node.get(key), str):
            return node[key]
    return ""


def write_deep(document) -> str:
    """Compact JSON of any depth."""
    out, stack = [], [document]
    text = lambda v: json.dumps(v, ensure_ascii=False)
    while stack:
        value = stack.pop()
        if isinstance(value, tuple):  # a finished piece of text
            out.append(value[0])
        elif isinstance(value, dict):
            parts: list = [("{",)]
            for no, (key, inner) in enumerate(value.items()):
                parts += [("," * (no > 0) + text(key) + ":",), inner]
            stack += reversed([*parts, ("}",)])
        elif isinstance(value, list):
            parts = [("[",)]
            for no, inner in enumerate(value):
                parts += [("," * (no > 0),), inner]
            stack += reversed([*parts, ("]",)])
        else:
            out.append(text(value))
    return "".join(out)


def as_text(value) -> str:
    if isinstance(value, str):
        return value
    return write_deep(value) if isinstance(value, (dict, list)) else json.dumps(value, ensure_ascii=False)


def clean_text(text: str | None) -> str | None:
    """Half a surrogate pair, which JSON may hold and columns can't, becomes a question mark."""
    return text if text is None else text.encode("utf-8", "replace").decode("utf-8")


def strings(values) -> pa.Array:
    try:
        return pa.array(values, pa.string())
    except UnicodeEncodeError:
        return pa.array([clean_text(v) for v in values], pa.string())


def _attributes(node: dict):
    """(field, value, shape) of node_attrs (v2) or attr (v1); an object's `value` stands for the object.

    shape is text or other for the `value` of an object, plain for what isn't wrapped so.
    """
    for key in ("node_attrs", "attr"):
        fields = node.get(key)
        if isinstance(fields, dict):
            for field, value in fields.items():
                shape = "plain"
                if isinstance(value, dict) and "value" in value:
                    value = value["value"]
                    shape = "text" if isinstance(value, str) else "other"
                if value is not None:
                    yield field, value, shape


def mutations_of(node: dict):
    branch = node.get("branch_attrs")
    genes = branch.get("mutations") if isinstance(branch, dict) else None
    if isinstance(genes, dict):
        for gene, entries in genes.items():
            if isinstance(entries, list):
                for no, entry in enumerate(entries):
                    yield gene, no, entry


def walk(root: dict, kinds: set[str]) -> Iterator[tuple]:
    """The items of one tree, a node when it is left, all others when they are met.

    The clock runs over all items whatever the kinds asked for, so tables made apart have the same labels.
    """
    attributes, mutations, nodes = "attribute" in kinds, "mutation" in kinds, "node" in kinds
    clock = 0
    stack = [(root, None, 0, "0", 0, None)]  # node or its finished row, parent's pre, depth, path, sibling position
    while stack:
        node, parent_pre, depth, path, position, entered = stack.pop()
        if entered is not None:
            if nodes:
                yield entered, clock, parent_pre, depth, path, "node", position, None, node_name(node), None
            clock += 1
            continue
        pre = clock
        clock += 1
        stack.append((node, parent_pre, depth, path, position, pre))
        for no, (field, value, shape) in enumerate(_attributes(node)):
            if attributes:
                yield clock, clock, pre, depth, path, "attribute", no, field, as_text(value), shape
            clock += 1
        for gene, no, entry in mutations_of(node):
            if mutations:
                yield clock, clock, pre, depth, path, "mutation", no, gene, f"{gene}:{as_text(entry)}", None
            clock += 1
        children = node.get("children")
        if isinstance(children, list):
            for no in range(len(children) - 1, -1, -1):
                if isinstance(children[no], dict):
                    stack.append((children[no], pre, depth + 1, f"{path}.{no}", no, None))


def numbered_nodes(root: dict) -> Iterator[tuple[int, dict]]:
    """(pre, node) of every node in pre-order, by the clock of walk()."""
    clock, stack = 0, [root]
    while stack:
        node = stack.pop()
        if node is None:
            clock += 1
            continue
        pre = clock
        clock += 1 + sum(1 for _ in _attributes(node)) + sum(1 for _ in mutations_of(node))
        stack.append(None)
        children = node.get("children")
        if isinstance(children, list):
            stack += [c for c in reversed(children) if isinstance(c, dict)]
        yield pre, node


def flatten_documents(
    df: DataFrame, kinds: tuple[str, ...] = ("node", "attribute", "mutation"), id_column: str = "record_id", json_column: str = "tree_json"
) -> DataFrame:
    """One row per node, attribute and mutation of each document that is complete JSON.

    Columns: record_id; pre and post (the interval label); parent_pre (of the parent node, or of the node
    that carries the item; null for the root); depth; node_path (`0`, `0.2`, ...); item_kind; item_no
    (position among siblings, fields, or the gene's entries); field (attribute name or gene); item (name,
    value or `gene:entry`). Null, empty and broken texts, and documents without a tree, give no rows;
    children that are no objects are no nodes but keep their position. Labels don't depend on the kinds. Documents fetched twice give rows
    under each record_id. Other columns of df are ignored.

    Documents are spread over the tasks by id, as their sizes are very uneven; a document is parsed in
    one task.
    """
    wanted = set(kinds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in ITEMS.split(", ")]
        types = [pa.int64()] * 4 + [pa.int32(), pa.string(), pa.string(), pa.int32(), pa.string(), pa.string(), pa.string()]

        def batch_of(rows: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([strings(c) if t == pa.string() else pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

        rows, chars = [], 0
        for batch in batches:
            for record, text in zip(batch.column(0), batch.column(1)):
                root = root_of(parse_document(text.as_py()))
                if root is None:
                    continue
                record = record.as_py()
                for row in walk(root, wanted):
                    rows.append((record, *row))
                    chars += 60 + len(row[4]) + len(row[8])
                    if chars > BATCH_CHARS:
                        yield batch_of(rows)
                        rows, chars = [], 0
        if rows:
            yield batch_of(rows)

    spread = df.select(F.col(id_column).cast("long").alias("record_id"), F.col(json_column).alias("tree_json")).where(
        F.col("tree_json").isNotNull()
    )
    return spread.repartition("record_id").mapInArrow(run, ITEMS)


def nodes_table(items: DataFrame) -> DataFrame:
    return items.where("item_kind = 'node'").select(
        "record_id", "pre", "post", "parent_pre", "depth", "node_path", F.col("item_no").alias("sibling_no"), F.col("item").alias("name")
    )


def attributes_table(items: DataFrame) -> DataFrame:
    return items.where("item_kind = 'attribute'").select(
        "record_id", "pre", F.col("parent_pre").alias("node_pre"), "node_path", "field", F.col("item").alias("value"), "shape"
    )


def mutations_table(items: DataFrame) -> DataFrame:
    return items.where("item_kind = 'mutation'").select(
        "record_id", "pre", F.col("parent_pre").alias("node_pre"), "node_path", F.col("field").alias("gene"), "item_no", "item"
    )
