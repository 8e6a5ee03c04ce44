import importlib
import os
import sys

import duckdb
import pytest

import __spark_entry__ as entry

CHEAP = ["edges", "tips", "branch_stats", "branches_tsv", "clade_roots", "stop_filter_trim", "sanitize_name", "publish_paths", "p1_found", "p2_found", "p4_found"]


def test_registry():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert {"p1_found", "p2_found", "p4_found", "p5_found", "forward_frames"} <= set(entry.queries())


def test_entry_without_the_subpackage(monkeypatch):
    for name in [m for m in sys.modules if m.startswith("cladeflow.llm")]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, "cladeflow.llm", None)
    monkeypatch.delattr("cladeflow.llm", raising=False)
    try:
        alone = importlib.reload(entry)
        assert "p1_found" in alone.queries() and "p7_ids" not in alone.queries()
    finally:
        monkeypatch.undo()
        importlib.reload(entry)


def test_entry_query(spark, data_dir):
    assert set(entry.entry(spark).columns) == {"dataset", "split", "tip", "pos", "node", "cum_dist"}


@pytest.mark.parametrize("name", CHEAP)
def test_against_sql(spark, data_dir, name):
    con = duckdb.connect()
    for file in os.listdir(data_dir):
        con.execute(f"create view {file.split('.')[0]} as select * from '{data_dir}/{file}'")
    got = entry.queries()[name](spark, data_dir)
    want = con.execute(entry.oracle_sql()[name])
    names = [d[0] for d in want.description]
    assert sorted(names) == sorted(got.columns)
    order = lambda rows: sorted(map(str, rows))
    assert order(tuple(r[c] for c in names) for r in got.collect()) == order(want.fetchall())
