"""The worked example: a tree of eleven nodes with two test tips below x, and its sequences."""

import datetime as dt

SEQUENCES = {
    "a": "AAAAAAAA", "b": "CAAAAAAA", "c": "CGAAAAAA", "d": "CGAAAAAA", "E": "CGTAAAAA", "F": "CGANAAAA", "G": "CGAA-AAA",
    "H": "AAAAACAA", "x": "CAAAAAGA", "Y": "CAAAAAGT", "Z": "CAAAAAAC",
}
MUTATIONS = {
    "b": ["A1C"], "c": ["A2G"], "d": [], "E": ["A3T"], "F": ["A4N"], "G": ["A5-"], "H": ["A6C"], "x": ["A7G"], "Y": ["A8T"], "Z": ["G7A", "A8C"],
}
LINKS = [
    ("a", "b", 1), ("b", "c", 1), ("c", "d", 0), ("d", "E", 1), ("d", "F", 0), ("c", "G", 0), ("b", "x", 1), ("x", "Y", 1), ("x", "Z", 2), ("a", "H", 1),
]
TEST = {"x", "Y", "Z"}
BRANCH_SCHEMA = "dataset string, parent string, child string, hamming string, train_test string, exported_at timestamp"
DAY = dt.datetime(2024, 1, 1)


def branch_rows(dataset="t_0001"):
    return [(dataset, p, c, str(h), "test" if c in TEST else "train", DAY) for p, c, h in LINKS]


def tree_document():
    children = {}
    for p, c, _ in LINKS:
        children.setdefault(p, []).append(c)

    def node(name):
        out = {"name": name, "branch_attrs": {"mutations": {"nuc": MUTATIONS.get(name, [])}}, "node_attrs": {"clade_membership": {"value": name.lower()}}}
        if name in children:
            out["children"] = [node(c) for c in children[name]]
        return out

    return {"version": "v2", "meta": {"colorings": []}, "root_sequence": {"nuc": "AAAAAAAA"}, "tree": node("a")}
