"""From tree documents to everything that is derived from them, for all datasets at once."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cladeflow.functions.names import clean_name
from cladeflow.functions.sequences import fasta_record, has_inner_stop, strip_stops, trim
from cladeflow.operators import documents, lineage, nested, pairs, random_clades
from cladeflow.plans.reference import FRAMES, LABELS, MONOPHYLETIC, MUTATION_COUNTS, NODE_SEQUENCES, RANDOM_CLADES, WALKED, hamming, walk
from cladeflow.session import written
from cladeflow.sources.tables import table

STRATEGIES = {"random-clades", "monophyletic"}


@dataclass
class Provision:
    """The tables of a run: see the fields; each has a column dataset."""

    links: DataFrame  # parent, child, hamming, split
    splits: DataFrame  # node, split
    alignment: DataFrame  # seq_id, name, seq
    tips: DataFrame  # tip, split

    def alignment_records(self, tips_only: bool = False) -> DataFrame:
        """dataset, name, record: the alignment as FASTA records, of the tips alone or of all nodes."""
        rows = self.alignment.join(self.tips.select("dataset", F.col("tip").alias("name")), ["dataset", "name"], "left_semi") if tips_only else self.alignment
        return rows.select("dataset", "name", fasta_record(F.col("name"), F.col("seq")).alias("record"))

    def frames(self) -> DataFrame:
        up = lineage.closure(self.links, self.tips.withColumnRenamed("tip", "node"))
        return lineage.forward_frames(up, self.links, self.tips, self.alignment)

    def train_pairs(self, limit: int | None = None, seed: int = 42) -> DataFrame:
        train = self.tips.where("split = 'train'")
        return pairs.with_sequences(pairs.pairs_within(train, "dataset", "tip", limit, seed), self.alignment)

    def test_pairs(self, limit: int | None = None, seed: int = 42) -> DataFrame:
        members = written(lineage.clade_membership(self.links, self.tips), "members")
        return pairs.with_sequences(pairs.pairs_within_clades(members, limit, seed), self.alignment)


def current_documents(auspice: DataFrame, nodes: DataFrame) -> DataFrame:
    """record_id, dataset of each dataset's complete document fetched last (of equal times the largest record_id)."""
    complete = documents.complete_documents(auspice, nodes).where("dataset is not null")
    last = complete.groupBy("dataset").agg(F.max(F.struct("fetched_at", "record_id")).alias("last"))
    return last.select(F.col("last.record_id").alias("record_id"), "dataset")


def provision(auspice: DataFrame, sidecars: DataFrame, analyses: DataFrame, strategy: str = "random-clades", tolerance: float = lineage.TOLERANCE) -> Provision:
    """Split the tips of every dataset's current document, rebuild and trim sequences, measure the branches.

    Nodes without a name are left out and their children become roots; of nodes with one name in a dataset
    the last in pre-order counts. The split counts mutations, the branches count differing positions.
    """
    if strategy not in STRATEGIES:
        raise ValueError(f"strategy must be one of {sorted(STRATEGIES)}")
    nodes = written(nested.nodes_table(nested.flatten_documents(auspice, ("node",))), "nodes")
    current = written(current_documents(auspice, nodes), "current")
    rows = auspice.join(current.select("record_id"), "record_id", "left_semi")
    named = nodes.where("name <> ''").join(current, "record_id").withColumn("name", clean_name("name"))
    counts = documents.mutation_counts(rows, analyses).select("record_id", "node_path", F.col("n_counted").cast("int").alias("n"))
    above = named.select("record_id", F.col("pre").alias("parent_pre"), F.col("name").alias("parent"))
    branch = named.join(above, ["record_id", "parent_pre"]).join(counts, ["record_id", "node_path"], "left")
    best = branch.groupBy("dataset", F.col("name").alias("child")).agg(F.max_by(F.struct("parent", F.coalesce("n", F.lit(0)).alias("n")), "pre").alias("b"))
    counted = best.select("dataset", F.col("b.parent").alias("parent"), "child", F.col("b.n").alias("hamming"), F.lit(None).cast("string").alias("split"))
    counted = written(counted.where("parent <> child"), "counted")
    ranked = lineage.placed_nodes(counted)
    tips = lineage.tips_of(counted)
    if strategy == "monophyletic":
        splits = lineage.monophyletic_split(ranked, tips, analyses, tolerance)
    else:
        splits = random_clades.random_clades(ranked, counted, tips, analyses)
    splits = written(splits, "splits")
    labelled = counted.drop("split").join(splits.withColumnRenamed("node", "child"), ["dataset", "child"], "left")
    seqs = documents.reconstructed_sequences(rows, sidecars, analyses).join(current, "record_id").join(nodes.select("record_id", "node_path", "pre"), ["record_id", "node_path"])
    bounds = analyses.select("analysis", "trim_begin", "trim_end")
    kept = lineage.with_settings(seqs.where(F.col("name") != "").where(~has_inner_stop("seq")), bounds)
    alignment = kept.select(F.col("pre").alias("seq_id"), "dataset", clean_name("name").alias("name"), trim(strip_stops("seq"), "trim_begin", "trim_end").alias("seq"))
    alignment = written(alignment, "alignment")
    links = written(lineage.branch_hamming(labelled, alignment), "links")
    return Provision(links, splits, alignment, lineage.tips_of(links))


def _of(spark: SparkSession, data_dir: str, strategy: str) -> Provision:
    return provision(*(table(spark, data_dir, t) for t in ("auspice", "root_sequences", "analyses")), strategy)


def provisioned_branches(spark: SparkSession, data_dir: str) -> DataFrame:
    return _of(spark, data_dir, "random-clades").links


def provisioned_frames(spark: SparkSession, data_dir: str) -> DataFrame:
    return _of(spark, data_dir, "monophyletic").frames()


def provisioned_documents(spark: SparkSession, data_dir: str) -> DataFrame:
    """Digest and length of each document labelled with its split."""
    auspice = table(spark, data_dir, "auspice")
    made = documents.annotated_documents(auspice, _of(spark, data_dir, "monophyletic").splits)
    return made.select("record_id", F.length("tree_json").alias("n_chars"), F.md5("tree_json").alias("digest"))


QUERIES = {f.__name__: f for f in (provisioned_branches, provisioned_frames, provisioned_documents)}
#: Each dataset's current document, its named nodes and their branches with mutations counted; no labels yet.
_CURRENT = """current as (select a.record_id, a.dataset from auspice a where a.dataset is not null and a.record_id in (select record_id from nodes)
    qualify row_number() over (partition by a.dataset order by fetched_at desc nulls last, a.record_id desc) = 1)"""
_COUNTED = f"""(select dataset, parent, child, hamming, cast(null as varchar) as split from (select * from ({LABELS}, {_CURRENT},
    named as (select l.record_id, c.dataset, l.node_path, l.depth, l.pre, regexp_replace(coalesce(n->>'$.name', n->>'$.strain', ''), '^hCoV-19/', '') as name
      from labelled l join current c using (record_id) where coalesce(n->>'$.name', n->>'$.strain', '') <> ''),
    counts as ({MUTATION_COUNTS})
    select v.dataset, u.name as parent, v.name as child, cast(coalesce(k.n_counted, 0) as integer) as hamming from named v
    join named u on u.record_id = v.record_id and v.depth > 0 and u.node_path = regexp_replace(v.node_path, '\\.\\d+$', '')
    left join counts k on k.record_id = v.record_id and k.node_path = v.node_path
    qualify row_number() over (partition by v.dataset, v.name order by v.pre desc) = 1)) where parent <> child)"""
_TRIMMED = f"""select dataset, name, arg_max(seq, pre) as seq from (select * from ({LABELS}, {_CURRENT}, whole as ({NODE_SEQUENCES})
    select c.dataset, regexp_replace(w.name, '^hCoV-19/', '') as name, l.pre,
      case when trim_begin is not null and trim_end is not null then substr(rtrim(w.seq, '*'), trim_begin, trim_end - trim_begin + 1) else rtrim(w.seq, '*') end as seq
    from whole w join current c on c.record_id = w.record_id join labelled l on l.record_id = w.record_id and l.node_path = w.node_path
    left join analyses a on a.analysis = regexp_replace(c.dataset, '_\\d+$', '') where w.name <> '' and not contains(rtrim(w.seq, '*'), '*'))) group by 1, 2"""


def _labelled(steps: str) -> str:
    """The branches with the splits that the steps make, and distances from the sequences."""
    return f"""(select * from ({walk(_COUNTED, _TRIMMED)}{steps} select l.dataset, l.parent, l.child,
      case when a.seq is not null and b.seq is not null then {hamming('upper(b.seq)', 'upper(a.seq)')} end as hamming, s.split from links l
    left join splits s on s.dataset = l.dataset and s.node = l.child
    left join seqs a on a.dataset = l.dataset and a.name = l.child left join seqs b on b.dataset = l.dataset and b.name = l.parent))"""


ORACLE = {
    "provisioned_branches": f"select * from {_labelled(WALKED + RANDOM_CLADES)}",
    "provisioned_frames": f"{walk(_labelled(MONOPHYLETIC), _TRIMMED)}{FRAMES} select dataset, split, tip, pos, node, cast(cum_dist as bigint) as cum_dist from frames",
}
