"""Queries p1, p2, p4 and p5: the general data problems on the project's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cladeflow.functions.names import is_tip_name, label
from cladeflow.operators import compaction, hierarchy, hot_keys, nested
from cladeflow.plans.reference import LABELS, MUTATIONS, NODES
from cladeflow.sources.tables import table

#: Problem 1's share of the rows, and problem 4's kinds and target file size in capacities.
HEAVY_SHARE = 0.04
COMPACTED_KINDS = ["forwards-train", "pairwise-train"]
TARGET_CONTAINER = "file_large"


def p1_found(spark: SparkSession, data_dir: str) -> DataFrame:
    rows = table(spark, data_dir, "metadata").select("clade_membership")
    return hot_keys.keys_above_share(rows, label("clade_membership"), "clade_membership", HEAVY_SHARE)


def p1_clades(spark: SparkSession, data_dir: str) -> DataFrame:
    """Per clade: rows, tips, datasets, dated rows, first and last complete collection date."""
    day = F.unix_date(F.try_to_date("collection_date", "yyyy-MM-dd"))
    stats = hot_keys.dense_key_stats(
        table(spark, data_dir, "metadata"),
        label("clade_membership"),
        "clade",
        sums={"n_tips": F.coalesce(is_tip_name("name").cast("int"), F.lit(0)), "n_dated": day.isNotNull().cast("int")},
        lows={"first_day": day},
        highs={"last_day": day},
        distincts={"n_datasets": F.col("dataset")},
    )
    return stats.select(
        "clade",
        F.col("rows").alias("n_rows"),
        "n_tips",
        "n_datasets",
        "n_dated",
        F.date_from_unix_date(F.col("first_day").cast("int")).cast("string").alias("first_date"),
        F.date_from_unix_date(F.col("last_day").cast("int")).cast("string").alias("last_date"),
    )


def p2_found(spark: SparkSession, data_dir: str) -> DataFrame:
    items = nested.flatten_documents(table(spark, data_dir, "auspice"), ("node", "mutation"))
    return items.select("record_id", "node_path", "item_kind", F.col("item_no").cast("long").alias("item_no"), "item")


def p2_nodes(spark: SparkSession, data_dir: str) -> DataFrame:
    return nested.nodes_table(nested.flatten_documents(table(spark, data_dir, "auspice"), ("node",)))


def p2_attributes(spark: SparkSession, data_dir: str) -> DataFrame:
    return nested.attributes_table(nested.flatten_documents(table(spark, data_dir, "auspice"), ("attribute",)))


def p2_mutations(spark: SparkSession, data_dir: str) -> DataFrame:
    return nested.mutations_table(nested.flatten_documents(table(spark, data_dir, "auspice"), ("mutation",)))


def _compacted(spark: SparkSession, data_dir: str) -> tuple[DataFrame, DataFrame]:
    target = table(spark, data_dir, "capacities").where(F.col("container_name") == TARGET_CONTAINER).first()["capacity"]
    return compaction.compact(compaction.current_files(table(spark, data_dir, "result_files"), COMPACTED_KINDS), target, "results")


def p4_found(spark: SparkSession, data_dir: str) -> DataFrame:
    return _compacted(spark, data_dir)[0].select("file_id")


def p4_listing(spark: SparkSession, data_dir: str) -> DataFrame:
    """The consolidated files themselves: name, bytes and records of each."""
    files = _compacted(spark, data_dir)[1]
    return files.select(F.element_at(F.split("path", "/"), -1).alias("file"), "n_bytes", "n_records")


def p4_files(spark: SparkSession, data_dir: str) -> DataFrame:
    """Per record of the consolidated files: its identity and a digest of its text as read back."""
    rows = _compacted(spark, data_dir)[0]
    return rows.select("file_id", "dataset", "kind", "file_name", F.md5("file_text").alias("digest"), F.length("file_text").alias("n_chars"))


def p5_found(spark: SparkSession, data_dir: str) -> DataFrame:
    return hierarchy.cycle_nodes(table(spark, data_dir, "branches"))


def p5_hierarchy(spark: SparkSession, data_dir: str) -> DataFrame:
    return hierarchy.hierarchy(table(spark, data_dir, "branches"), table(spark, data_dir, "metadata").select("dataset", "name"))


def p5_descendants(spark: SparkSession, data_dir: str) -> DataFrame:
    return hierarchy.descendants(table(spark, data_dir, "branches"))


QUERIES = {
    f.__name__: f
    for f in (p1_found, p1_clades, p2_found, p2_nodes, p2_attributes, p2_mutations, p4_found, p4_files, p4_listing, p5_found, p5_hierarchy, p5_descendants)
}

_LABEL = "upper(regexp_replace(clade_membership, '^\\s+|\\s+$', '', 'g'))"
_VALID = """select * from result_files where kind in ('forwards-train', 'pairwise-train') and dataset is not null
  and ends_with(file_name, '.fasta') and regexp_matches(file_text, '(^|\\n)>')"""
_LATEST = f"""select * from ({_VALID})
  qualify row_number() over (partition by dataset, kind, file_name order by modified_at desc nulls last, file_id desc) = 1"""
_LINKS = """select distinct dataset, regexp_replace(parent, '^hCoV-19/', '') as p, regexp_replace(child, '^hCoV-19/', '') as c
  from branches where dataset is not null and parent is not null and child is not null"""
#: A node on a cycle is reached again from itself; the walk keeps each (start, node) once, so it ends.
_CYCLES = f"""with recursive links as ({_LINKS}),
  reach(dataset, s, n) as (select dataset, p, c from links union
    select r.dataset, r.s, l.c from reach r join links l on l.dataset = r.dataset and l.p = r.n)
  select distinct dataset, s as node from reach where s = n"""
#: One parent a node off the cycles: one off the cycles before one on them, then the last exported, then the first by name.
_FOREST = f"""{_CYCLES.rpartition("select distinct")[0].rstrip()},
  cyc as (select distinct dataset, s as node from reach where s = n),
  every as (select dataset, p as node from links union select dataset, c from links
    union select dataset, regexp_replace(child, '^hCoV-19/', '') from branches where dataset is not null and child is not null@MORE@),
  dated as (select dataset, regexp_replace(parent, '^hCoV-19/', '') as p, regexp_replace(child, '^hCoV-19/', '') as c, max(exported_at) as seen
    from branches where dataset is not null and parent is not null and child is not null group by 1, 2, 3),
  best as (select d.dataset, d.c, d.p, k.node is not null as below from dated d left join cyc k on k.dataset = d.dataset and k.node = d.p
    where not exists (select 1 from cyc x where x.dataset = d.dataset and x.node = d.c)
    qualify row_number() over (partition by d.dataset, d.c order by k.node is not null, seen desc nulls last, d.p) = 1),
  nodes as (select e.dataset, e.node, coalesce(b.below, false) as below, case when not b.below then b.p end as up from every e
    left join best b on b.dataset = e.dataset and b.c = e.node
    where not exists (select 1 from cyc x where x.dataset = e.dataset and x.node = e.node)),
  walk(dataset, node, below, path) as (select dataset, node, below, [node] from nodes where up is null
    union all select n.dataset, n.node, n.below, list_append(w.path, n.node) from walk w join nodes n on n.dataset = w.dataset and n.up = w.node),
  pairs as (select dataset, node, path[i] as anc, len(path) - i as hops from walk, unnest(range(1, len(path) + 1)) as t(i))"""
_NAMED = "\n    union select dataset, regexp_replace(name, '^hCoV-19/', '') from metadata where dataset is not null and name is not null"

ORACLE = {
    "p5_hierarchy": f"""{_FOREST.replace("@MORE@", _NAMED)},
      sizes as (select dataset, anc as node, count(*) as n from pairs group by 1, 2),
      ranked as (select w.*, n, row_number() over (partition by w.dataset, path[1] order by path) - 1 as entry from walk w join sizes s using (dataset, node))
      select dataset, node, case when len(path) > 1 then path[-2] end as parent, path[1] as root, len(path) - 1 as depth, path, n - 1 as n_descendants,
        entry, entry + n - 1 as exit, below as below_cycle from ranked""",
    "p5_descendants": f"""{_FOREST.replace("@MORE@", "")} select dataset, anc as node, node as descendant, hops from pairs where hops > 0""",
    "p1_found": f"""select {_LABEL} as clade_membership from metadata where clade_membership is not null
        group by 1 having count(*) >= 0.04 * (select count(*) from metadata)""",
    "p1_clades": f"""select {_LABEL} as clade, count(*) as n_rows,
        count(*) filter (not starts_with(regexp_replace(name, '^hCoV-19/', ''), 'NODE_')) as n_tips,
        count(distinct dataset) as n_datasets, count(d) as n_dated, cast(min(d) as varchar) as first_date, cast(max(d) as varchar) as last_date
        from (select *, try_cast(case when regexp_full_match(collection_date, '\\d{{4}}-\\d{{2}}-\\d{{2}}') then collection_date end as date) as d from metadata)
        where clade_membership is not null group by 1""",
    "p2_found": f"""{NODES}{MUTATIONS} select record_id, node_path, 'node' as item_kind, cast(no as bigint) as item_no,
        coalesce(n->>'$.name', n->>'$.strain', '') as item from nodes
        union all select record_id, node_path, 'mutation', item_no, gene || ':' || entry from muts""",
    "p2_nodes": f"""{LABELS} select r.record_id, r.pre, r.post, u.pre as parent_pre, r.depth, r.node_path, r.no as sibling_no, coalesce(r.n->>'$.name', r.n->>'$.strain', '') as name
        from labelled r left join labelled u on u.record_id = r.record_id and r.depth > 0 and u.node_path = regexp_replace(r.node_path, '\\.\\d+$', '')""",
    "p2_attributes": f"""{LABELS} select a.record_id, l.pre + 1 + item_no as pre, l.pre as node_pre, a.node_path, field, value, shape from attrs a join labelled l using (record_id, node_path)""",
    "p2_mutations": f"""{LABELS} select m.record_id, l.pre + 1 + n_attrs + row_number() over (partition by m.record_id, m.node_path order by gene_no, item_no) - 1 as pre, l.pre as node_pre,
        m.node_path, gene, item_no, gene || ':' || entry as item from (select record_id, node_path, gene_no, gene, cast(e.key as bigint) as item_no,
          case when json_type(e.value) = 'VARCHAR' then e.value->>'$' else cast(e.value as varchar) end as entry from (select record_id, node_path, g.key as gene, g.rowid as gene_no, g.value as l
            from nodes, json_each(n, '$.branch_attrs.mutations') as g where json_type(n, '$.branch_attrs.mutations') = 'OBJECT'), json_each(l) as e where json_type(l) = 'ARRAY') m
        join labelled l using (record_id, node_path)""",
    "p4_found": f"select file_id from ({_LATEST})",
    "p4_files": f"select file_id, dataset, kind, file_name, md5(file_text) as digest, length(file_text) as n_chars from ({_LATEST})",
    "p5_found": _CYCLES,
}
