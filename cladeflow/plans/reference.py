"""Queries of the lineage pipeline on the project's tables, each with its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cladeflow.functions.names import clean_name, file_stem, is_tip_name, publish_prefix
from cladeflow.functions.sequences import fasta_record, has_inner_stop, strip_stops, trim
from cladeflow.operators import documents, lineage, pairs, random_clades, shards, summaries
from cladeflow.operators.compaction import current_files
from cladeflow.session import written
from cladeflow.sources.tables import table

# Kinds of result files, and the pair limits of the workflow.
KINDS = ["forwards-train", "forwards-test", "pairwise-train", "pairwise-test"]
TRAIN_LIMIT, TEST_LIMIT = 100_000, 50_000
#: Limits of the sampled queries, low enough that every larger dataset is sampled.
SAMPLE_LIMIT, CLADE_SAMPLE_LIMIT = 200, 10
SHARD_SIZE = 10
SAMPLE_FRACTION = 0.2
SEED = 42


class Tree:
    """The tables that most queries start from; closure() is written once for each use."""

    def __init__(self, spark: SparkSession, data_dir: str) -> None:
        self.spark, self.data_dir = spark, data_dir
        self.links = written(lineage.tree_links(self.table("branches")), "links")
        self.tips = lineage.tips_of(self.links)

    def table(self, name: str) -> DataFrame:
        return table(self.spark, self.data_dir, name)

    def closure(self) -> DataFrame:
        return lineage.closure(self.links)

    def nodes(self) -> DataFrame:
        return lineage.ranked_nodes(self.links)

    def placed(self) -> DataFrame:
        return lineage.placed_nodes(self.links)

    def tip_closure(self) -> DataFrame:
        return lineage.closure(self.links, self.tips.withColumnRenamed("tip", "node"))


def edges(spark: SparkSession, data_dir: str) -> DataFrame:
    return lineage.tree_links(table(spark, data_dir, "branches"))


def tips(spark: SparkSession, data_dir: str) -> DataFrame:
    return lineage.tips_of(lineage.tree_links(table(spark, data_dir, "branches")))


def closure_depth(spark: SparkSession, data_dir: str) -> DataFrame:
    return lineage.depths(Tree(spark, data_dir).links)


def descendants(spark: SparkSession, data_dir: str) -> DataFrame:
    pairs_ = Tree(spark, data_dir).closure()
    return pairs_.where("hops > 0").select("dataset", F.col("anc").alias("node"), F.col("node").alias("descendant"), "hops")


def traversal_ranks(spark: SparkSession, data_dir: str) -> DataFrame:
    """Pre- and post-order rank of every node in its tree, siblings in the order of their names."""
    post = F.col("entry") + F.col("size") - 1 - F.col("depth")
    return Tree(spark, data_dir).nodes().select("dataset", "node", F.col("entry").alias("preorder"), post.alias("postorder"))


def clade_tip_count(spark: SparkSession, data_dir: str) -> DataFrame:
    return lineage.clade_sizes(Tree(spark, data_dir).nodes())


def branch_hamming(spark: SparkSession, data_dir: str) -> DataFrame:
    links = lineage.tree_links(table(spark, data_dir, "branches"))
    return lineage.branch_hamming(links, table(spark, data_dir, "alignment"))


def branch_stats(spark: SparkSession, data_dir: str) -> DataFrame:
    return summaries.branch_stats(lineage.tree_links(table(spark, data_dir, "branches")))


def branch_histogram(spark: SparkSession, data_dir: str) -> DataFrame:
    return summaries.branch_histogram(lineage.tree_links(table(spark, data_dir, "branches")))


def branches_tsv(spark: SparkSession, data_dir: str) -> DataFrame:
    """Lines of the branch table as written: `?` for a missing distance, nothing for a missing label."""
    links = lineage.tree_links(table(spark, data_dir, "branches"))
    line = F.concat_ws("\t", "parent", "child", F.coalesce(F.col("hamming").cast("string"), F.lit("?")), F.coalesce("split", F.lit("")))
    return links.select("dataset", line.alias("line"))


def walk_back(spark: SparkSession, data_dir: str) -> DataFrame:
    tree = Tree(spark, data_dir)
    return lineage.walk_back(tree.links, tree.tips, tree.table("analyses"))


def monophyletic_split(spark: SparkSession, data_dir: str) -> DataFrame:
    tree = Tree(spark, data_dir)
    return lineage.monophyletic_split(tree.placed(), tree.tips, tree.table("analyses"))


def random_clade_split(spark: SparkSession, data_dir: str) -> DataFrame:
    tree = Tree(spark, data_dir)
    return random_clades.random_clades(tree.placed(), tree.links, tree.tips, tree.table("analyses"))


def clade_roots(spark: SparkSession, data_dir: str) -> DataFrame:
    return lineage.clade_roots(lineage.tree_links(table(spark, data_dir, "branches")))


def clade_membership(spark: SparkSession, data_dir: str) -> DataFrame:
    tree = Tree(spark, data_dir)
    return lineage.clade_membership(tree.links, tree.tips)


def forward_frames(spark: SparkSession, data_dir: str) -> DataFrame:
    tree = Tree(spark, data_dir)
    return lineage.forward_frames(tree.tip_closure(), tree.links, tree.tips, tree.table("alignment"))


def fasta_render(spark: SparkSession, data_dir: str) -> DataFrame:
    """Forward path files: dataset, split, file_name, and length and digest of the text, one row a tip with frames."""
    frames = forward_frames(spark, data_dir)
    seqs = lineage.node_sequences(table(spark, data_dir, "alignment")).withColumnRenamed("name", "node")
    header = F.concat_ws("|", "node", F.col("cum_dist").cast("string"))
    parts = frames.join(seqs, ["dataset", "node"]).groupBy("dataset", "split", "tip").agg(
        F.sort_array(F.collect_list(F.struct("pos", fasta_record(header, F.col("seq")).alias("r")))).alias("parts")
    )
    text = F.array_join(F.transform("parts", lambda p: p["r"]), "")
    return parts.select("dataset", "split", F.concat(file_stem("tip"), F.lit(".fasta")).alias("file_name"), F.length(text).alias("n_chars"), F.md5(text).alias("digest"))


def pairs_all(spark: SparkSession, data_dir: str) -> DataFrame:
    """All pairs of the train tips of each dataset, without a limit."""
    tree = Tree(spark, data_dir)
    train = tree.tips.where("split = 'train'")
    return pairs.every_pair(train, ["dataset"], "tip", tree.table("alignment"))


def pairs_sampled(spark: SparkSession, data_dir: str) -> DataFrame:
    tree = Tree(spark, data_dir)
    train = tree.tips.where("split = 'train'")
    return pairs.with_sequences(pairs.pairs_within(train, "dataset", "tip", SAMPLE_LIMIT, SEED), tree.table("alignment"))


def _clade_pairs(spark: SparkSession, data_dir: str, limit: int) -> DataFrame:
    tree = Tree(spark, data_dir)
    members = written(lineage.clade_membership(tree.links, tree.tips), "members")
    return pairs.with_sequences(pairs.pairs_within_clades(members, limit, SEED), tree.table("alignment"))


def pairs_within_clade(spark: SparkSession, data_dir: str) -> DataFrame:
    return _clade_pairs(spark, data_dir, TEST_LIMIT)


def pairs_sampled_by_clade(spark: SparkSession, data_dir: str) -> DataFrame:
    return _clade_pairs(spark, data_dir, CLADE_SAMPLE_LIMIT)


def pair_files(spark: SparkSession, data_dir: str) -> DataFrame:
    """Pair files of sampled train pairs and of test pairs within clades: path, and length and digest of the text."""
    tree = Tree(spark, data_dir)
    train = pairs.pairs_within(tree.tips.where("split = 'train'"), "dataset", "tip", SAMPLE_LIMIT, SEED)
    members = written(lineage.clade_membership(tree.links, tree.tips), "members")
    test = pairs.pairs_within_clades(members, CLADE_SAMPLE_LIMIT, SEED).drop("clade_root")
    made = [pairs.pair_files(pairs.with_sequences(p, tree.table("alignment"), keep=True), kind) for p, kind in ((train, "pairwise-train"), (test, "pairwise-test"))]
    return made[0].unionByName(made[1]).select("dataset", "file_path", F.length("content").alias("n_chars"), F.md5("content").alias("digest"))


def alignment_fasta(spark: SparkSession, data_dir: str) -> DataFrame:
    """Records of the alignment as written, stop codons treated as in stop_filter_trim: length and digest of each."""
    rows = stop_filter_trim(spark, data_dir).where("seq is not null and name is not null")
    record = fasta_record(F.col("name"), F.col("seq"))
    return rows.select("seq_id", "dataset", is_tip_name("name").alias("is_tip"), F.length(record).alias("n_chars"), F.md5(record).alias("digest"))


def metadata_table(spark: SparkSession, data_dir: str) -> DataFrame:
    """The metadata tables of all documents, line by line, each with its own header."""
    return documents.metadata_lines(table(spark, data_dir, "auspice"))


def stop_filter_trim(spark: SparkSession, data_dir: str) -> DataFrame:
    """Sequences without trailing stops, those with inner stops dropped, trimmed to the analysis's region."""
    bounds = table(spark, data_dir, "analyses").select("analysis", "trim_begin", "trim_end")
    rows = table(spark, data_dir, "alignment").where(~has_inner_stop("seq"))
    rows = lineage.with_settings(rows, bounds)
    return rows.select("seq_id", "dataset", clean_name("name").alias("name"), trim(strip_stops("seq"), "trim_begin", "trim_end").alias("seq"))


def metadata_rows(spark: SparkSession, data_dir: str) -> DataFrame:
    """Metadata lines of the latest export: missing values empty, but a missing parent is `None`."""
    rows = table(spark, data_dir, "metadata").where("dataset is not null and name is not null")
    columns = ["parent", "clade_membership", "clade", "country", "collection_date", "family_name", "S1_mutations"]
    last = rows.groupBy("dataset", clean_name("name").alias("name")).agg(F.max(F.struct("exported_at", *columns)).alias("r"))
    parent = F.coalesce(clean_name("r.parent"), F.lit("None"))
    line = F.concat_ws("\t", "name", parent, *(F.coalesce(F.col(f"r.{c}"), F.lit("")) for c in columns[1:]))
    return last.select("dataset", "name", line.alias("line"))


def summary(spark: SparkSession, data_dir: str) -> DataFrame:
    """One row a dataset: paths, branches, sequences, test clades, train and test pairs."""
    tree = Tree(spark, data_dir)
    steps = written(lineage.path_steps(tree.tip_closure(), tree.links, tree.tips), "steps")
    frames = lineage.frames_with_sequence(steps, tree.table("alignment"))
    # a tip's last frame may be missing, its distance isn't
    last = steps.where("tip = node").select("dataset", "tip", F.col("cum_dist").alias("distance"))
    stats = summaries.path_stats(frames, tree.tips, last)
    seqs = lineage.node_sequences(tree.table("alignment")).where("seq <> ''").groupBy("dataset").agg(
        F.count("*").alias("n_sequences")
    )
    record = tree.table("alignment").where("dataset is not null and name is not null and seq <> ''")
    seqs = seqs.join(record.groupBy("dataset").agg(F.min_by(F.length("seq"), "seq_id").alias("sequence_length")), "dataset", "left")
    members = written(lineage.clade_membership(tree.links, tree.tips), "members")
    clades = members.groupBy("dataset").agg(F.count_distinct("clade_root").alias("n_test_clades"))
    test = summaries.pair_stats(pairs.with_sequences(pairs.pairs_within_clades(members, TEST_LIMIT, SEED), tree.table("alignment")), "test")
    train = summaries.bunch_stats(pairs.distances_within(tree.tips.where("split = 'train'"), tree.table("alignment"), TRAIN_LIMIT, SEED), "train")
    wide = stats.join(summaries.branch_stats(tree.links), "dataset")
    for part in (seqs, clades, train, test):
        wide = wide.join(part, "dataset", "left")
    return wide.fillna(0, ["n_sequences", "sequence_length", "n_test_clades", "train_pairs", "test_pairs"])


def summary_document(spark: SparkSession, data_dir: str) -> DataFrame:
    """The summary as it is written: a JSON object a dataset."""
    return summaries.entries(summary(spark, data_dir))


def dataset_upsert(spark: SparkSession, data_dir: str) -> DataFrame:
    """Branch statistics as of the last export merged over those of the datasets' first exports."""
    branches = table(spark, data_dir, "branches")
    first = branches.groupBy("dataset").agg(F.min("exported_at").alias("first"), F.max("exported_at").alias("last"))
    old = branches.join(first, "dataset").where("exported_at = first").select(*branches.columns)
    again = branches.join(first.where("first < last"), "dataset", "left_semi")
    return summaries.upsert(summaries.branch_stats(lineage.tree_links(old)), summaries.branch_stats(lineage.tree_links(again)))


def root_sequences(spark: SparkSession, data_dir: str) -> DataFrame:
    auspice = table(spark, data_dir, "auspice")
    nodes = documents.nested.nodes_table(documents.nested.flatten_documents(auspice, ("node",)))
    complete = documents.complete_documents(auspice, nodes)
    return documents.root_sequences(complete, table(spark, data_dir, "root_sequences"), table(spark, data_dir, "analyses"))


def node_sequences(spark: SparkSession, data_dir: str) -> DataFrame:
    return documents.reconstructed_sequences(*(table(spark, data_dir, t) for t in ("auspice", "root_sequences", "analyses")))


def mutation_count_region(spark: SparkSession, data_dir: str) -> DataFrame:
    return documents.mutation_counts(table(spark, data_dir, "auspice"), table(spark, data_dir, "analyses"))


def metadata_fields(spark: SparkSession, data_dir: str) -> DataFrame:
    return documents.metadata_fields(table(spark, data_dir, "auspice"))


def color_map(spark: SparkSession, data_dir: str) -> DataFrame:
    return documents.color_map(table(spark, data_dir, "auspice"))


def shard_assignment(spark: SparkSession, data_dir: str) -> DataFrame:
    files = current_files(table(spark, data_dir, "result_files"), KINDS)
    return shards.shard_assignment(files, SEED, SHARD_SIZE)


def shard_contents(spark: SparkSession, data_dir: str) -> DataFrame:
    """dataset, shard, n_files, n_raw, payload: the shards themselves."""
    files = written(current_files(table(spark, data_dir, "result_files"), KINDS), "files")
    return shards.shard_payloads(files, shards.shard_assignment(files, SEED, SHARD_SIZE))


def shard_sizes(spark: SparkSession, data_dir: str) -> DataFrame:
    """dataset, shard, n_files, n_raw of the shards as packed."""
    return shard_contents(spark, data_dir).drop("payload")


def shard_totals(spark: SparkSession, data_dir: str) -> DataFrame:
    return shards.shard_totals(shard_contents(spark, data_dir))


def fraction_sample(spark: SparkSession, data_dir: str) -> DataFrame:
    names = table(spark, data_dir, "alignment").where(is_tip_name("name") & (F.length("seq") > 0))
    return shards.fraction_sample(names.select("dataset", clean_name("name").alias("name")), ["dataset"], "name", SAMPLE_FRACTION, SEED)


def sanitize_name(spark: SparkSession, data_dir: str) -> DataFrame:
    rows = table(spark, data_dir, "metadata").where("name is not null")
    return rows.select("dataset", "name", file_stem("name").alias("stem")).distinct()


def publish_paths(spark: SparkSession, data_dir: str) -> DataFrame:
    rows = table(spark, data_dir, "metadata").where("dataset is not null")
    return rows.groupBy("dataset").agg(F.count("*").alias("n_rows")).select("dataset", publish_prefix("dataset").alias("prefix"), "n_rows")


QUERIES = {
    f.__name__: f
    for f in (
        forward_frames, edges, tips, closure_depth, descendants, traversal_ranks, clade_tip_count, branch_hamming, branch_stats,
        branch_histogram, branches_tsv, walk_back, monophyletic_split, random_clade_split, clade_roots, clade_membership, fasta_render,
        pairs_all, pairs_sampled, pairs_within_clade, pairs_sampled_by_clade, pair_files, stop_filter_trim, alignment_fasta, metadata_rows, metadata_table,
        summary, summary_document, dataset_upsert,
        root_sequences, node_sequences, mutation_count_region, metadata_fields, color_map, shard_assignment, shard_contents, shard_sizes, shard_totals,
        fraction_sample, sanitize_name, publish_paths,
    )
}

# ---------------------------------------------------------------------------------------------------- SQL


def _links(source: str = "branches") -> str:
    return f"""(select dataset, parent, child, hamming, split from (
    select dataset, regexp_replace(parent, '^hCoV-19/', '') as parent, regexp_replace(child, '^hCoV-19/', '') as child,
      try_cast(trim(hamming) as integer) as hamming, nullif(lower(trim(train_test)), '') as split, exported_at
    from {source} where dataset is not null and parent is not null and child is not null) where parent <> child
  qualify row_number() over (partition by dataset, child order by exported_at desc nulls last, parent desc,
    hamming desc nulls last, split desc nulls last) = 1)"""


_CURRENT_SEQUENCES = """select dataset, regexp_replace(name, '^hCoV-19/', '') as name, arg_max(seq, seq_id) as seq from alignment
    where dataset is not null and name is not null and seq is not null group by 1, 2"""


def base(links: str) -> str:
    return f"""with recursive links as {links},
  tips as (select dataset, child as tip, coalesce(split, 'train') as split from links l
    where not exists (select 1 from links p where p.dataset = l.dataset and p.parent = l.child))"""


def walk(links: str, sequences: str = _CURRENT_SEQUENCES) -> str:
    """Trees of links and everything that hangs on their paths."""
    return f"""{base(links)},
  walk(dataset, node, path) as (
    select distinct dataset, parent, [parent] from links l
      where not exists (select 1 from links p where p.dataset = l.dataset and p.child = l.parent)
    union all select l.dataset, l.child, list_append(w.path, l.child) from walk w join links l on l.dataset = w.dataset and l.parent = w.node),
  pairs as (select dataset, node, path[i] as anc, len(path) - i as hops from walk, unnest(range(1, len(path) + 1)) as t(i)),
  sizes as (select p.dataset, p.anc as node, count(t.tip) as n_tips, count(*) as n_nodes from pairs p
    left join tips t on t.dataset = p.dataset and t.tip = p.node group by 1, 2),
  settings as (select * from analyses),
  seqs as ({sequences}),
  roots as (select l.dataset, l.child as clade_root from links l left join links p on p.dataset = l.dataset and p.child = l.parent
    where l.split = 'test' and coalesce(p.split, 'train') = 'train'),
  members as (select p.dataset, p.node as tip, arg_min(p.anc, p.hops) as clade_root from pairs p
    join tips t on t.dataset = p.dataset and t.tip = p.node and t.split = 'test'
    join roots r on r.dataset = p.dataset and r.clade_root = p.anc group by 1, 2)"""


_BASE, _WALK = base(_links()), walk(_links())


def hamming(a: str, b: str) -> str:
    """Each position's two letters as one string, those equal or masked dropped."""
    return f"""len(list_filter(range(1, least(length({a}), length({b})) + 1),
      lambda i: {a}[i] <> {b}[i] and {a}[i] not in ('-', 'N') and {b}[i] not in ('-', 'N')))"""


FRAMES = """,
  marked as (select p.*, t.split as tip_split, l.split as anc_split, coalesce(l.hamming, 0) as d0 from pairs p
    join tips t on t.dataset = p.dataset and t.tip = p.node left join links l on l.dataset = p.dataset and l.child = p.anc),
  cut as (select *, max(case when tip_split = 'test' and anc_split = 'test' then hops end) over (partition by dataset, node) as first from marked),
  kept as (select *, max(hops) over (partition by dataset, node) as top from cut where first is null or hops <= first),
  gone as (select *, case when hops = top then 0 else d0 end as d,
    sum(case when hops = top then 0 else d0 end) over (partition by dataset, node order by hops desc rows unbounded preceding) as cum_dist from kept),
  frames as (select g.dataset, tip_split as split, g.node as tip, top - hops as pos, anc as node, cum_dist from gone g
    join seqs s on s.dataset = g.dataset and s.name = g.anc and s.seq <> '' where hops = top or hops = 0 or d > 0)"""
WALKED = """,
  climbed as (select p.dataset, p.node, p.anc, p.hops, l.child is not null as has_parent,
    sum(coalesce(l.hamming, 0)) over (partition by p.dataset, p.node order by p.hops) as gone,
    coalesce(a.mutations_back, 5) as back from pairs p join tips t on t.dataset = p.dataset and t.tip = p.node
    left join links l on l.dataset = p.dataset and l.child = p.anc
    left join settings a on a.analysis = regexp_replace(p.dataset, '_\\d+$', '')),
  walked as (select dataset, node as tip, coalesce(arg_min(anc, hops) filter (has_parent and gone >= back), arg_max(anc, hops)) as clade_root
    from climbed group by 1, 2)"""
RANDOM_CLADES = """,
        cfg as (select w.dataset, count(*) as n, greatest(1, cast(floor(count(*) * coalesce(any_value(a.test_proportion), 0.1)) as bigint)) as goal,
          cast(floor(count(*) * coalesce(any_value(a.max_clade_proportion), 0.01)) as bigint) as cap, coalesce(any_value(a.seed), 42) as seed
          from walked w left join settings a on a.analysis = regexp_replace(w.dataset, '_\\d+$', '') group by 1),
        clades as (select p.dataset, p.anc as clade_root, list(p.node) as held from pairs p join tips t on t.dataset = p.dataset and t.tip = p.node group by 1, 2),
        seeds as (select w.dataset, w.tip, w.clade_root, c.held, goal, cap, row_number() over (partition by w.dataset order by md5(seed || ':' || w.tip), w.tip) as turn
          from walked w join cfg using (dataset) join clades c on c.dataset = w.dataset and c.clade_root = w.clade_root),
        taken(dataset, turn, test, roots) as (select dataset, cast(0 as bigint), cast([] as varchar[]), cast([] as varchar[]) from cfg
          union all select dataset, turn, case when ok then list_distinct(list_concat(test, held)) else test end, case when ok then list_append(roots, clade_root) else roots end
          from (select t.dataset, s.turn, t.test, t.roots, s.held, s.clade_root, len(t.test) < s.goal and not list_contains(t.test, s.tip) and len(s.held) <= s.cap as ok
            from taken t join seeds s on s.dataset = t.dataset and s.turn = t.turn + 1)),
        roots2 as (select dataset, unnest(roots) as r from taken qualify row_number() over (partition by dataset order by turn desc) = 1),
        splits as (select p.dataset, p.node, case when max(case when r is not null then 1 else 0 end) = 1 then 'test' else 'train' end as split
        from pairs p left join roots2 x on x.dataset = p.dataset and x.r = p.anc group by 1, 2)"""
MONOPHYLETIC = """, goal as (select t.dataset, greatest(1, cast(floor(count(*) * coalesce(any_value(a.test_proportion), 0.1)) as bigint)) as target from tips t
          left join settings a on a.analysis = regexp_replace(t.dataset, '_\\d+$', '') group by 1),
        best as (select s.dataset, s.node from sizes s join goal g on g.dataset = s.dataset join walk w on w.dataset = s.dataset and w.node = s.node
          where n_tips >= target * 0.5 and n_tips <= target * 1.5
          qualify row_number() over (partition by s.dataset order by abs(n_tips - target), w.path) = 1),
        splits as (select p.dataset, p.node, case when max(case when b.node is not null then 1 else 0 end) = 1 then 'test' else 'train' end as split
        from pairs p left join best b on b.dataset = p.dataset and b.node = p.anc group by 1, 2)"""
_NUMBER = "('0x' || substr(md5('42:' || key || ':' || d), 1, 15))::bigint % total"


def _drawn(limit: int | None) -> str:
    """groups(key, total) to numbers(key, idx)."""
    if limit is None:
        return """
  numbers as (select key, i as idx from groups, unnest(range(0, total)) as t(i))"""
    return f"""
  every as (select key, i as idx from groups, unnest(range(0, total)) as t(i) where total <= {limit}),
  dense as (select key, i as idx from groups, unnest(range(0, total)) as t(i) where total > {limit} and total <= {2 * limit}
    qualify row_number() over (partition by key order by md5('42:' || key || ':' || i)) <= {limit}),
  sparse as (select key, idx from (select key, {_NUMBER} as idx, min(d) as d from groups, unnest(range(0, {4 * limit})) as t(d)
    where total > {2 * limit} group by 1, 2) qualify row_number() over (partition by key order by d) <= {limit}),
  numbers as (select * from every union all select * from dense union all select * from sparse)"""


def _train_pair_steps(limit: int | None) -> str:
    return f"""{_WALK},
  ord as (select dataset, tip, row_number() over (partition by dataset order by tip) - 1 as o, count(*) over (partition by dataset) as n
    from tips where split = 'train'),
  groups as (select dataset as key, any_value(n) * (any_value(n) - 1) // 2 as total from ord group by 1),
  {_drawn(limit)},
  ji as (select key, idx, cast(floor((1 + sqrt(1 + 8 * idx)) / 2) as bigint) as i from numbers),
  picked as (select key as dataset, a.tip as tip1, b.tip as tip2 from ji join ord b on b.dataset = key and b.o = i
    join ord a on a.dataset = key and a.o = idx - i * (i - 1) // 2),
  train_pairs as (select p.dataset, tip1, tip2, {hamming('x.seq', 'y.seq')} as hamming, x.seq as seq1, y.seq as seq2 from picked p
  join seqs x on x.dataset = p.dataset and x.name = tip1 and x.seq <> '' join seqs y on y.dataset = p.dataset and y.name = tip2 and y.seq <> '')"""


def _train_pairs(limit: int | None) -> str:
    return f"{_train_pair_steps(limit)} select dataset, tip1, tip2, hamming from train_pairs"


def _stem(name: str) -> str:
    return f"""regexp_replace(regexp_replace({name}, '^hCoV-19', ''), '[/\\\\:*?"<>| ]', '', 'g')"""


def _record(header: str, seq: str) -> str:
    """A FASTA record of lines of 60 characters."""
    return f"""'>' || {header} || chr(10) || regexp_replace({seq}, '(.{{60}})', '\\1' || chr(10), 'g') || case when length({seq}) % 60 = 0 then '' else chr(10) end"""


def _pair_files(steps: str, source: str, kind: str) -> str:
    return f"""select dataset, file_path, length(t) as n_chars, md5(t) as digest from ({steps} select dataset, '{kind}/' || {_stem('tip1')} || '__' || {_stem('tip2')} || '.fasta' as file_path,
    {_record("tip1 || '|0'", 'seq1')} || {_record("tip2 || '|' || hamming", 'seq2')} as t from {source})"""


def _clade_pair_steps(limit: int) -> str:
    return f""",
  ord as (select dataset, clade_root, tip, row_number() over (partition by dataset, clade_root order by tip) - 1 as o,
    count(*) over (partition by dataset, clade_root) as m from members),
  clades as (select dataset, clade_root, any_value(m) * (any_value(m) - 1) // 2 as pairs from ord where m >= 2 group by 1, 2),
  placed as (select *, sum(pairs) over (partition by dataset order by clade_root rows unbounded preceding) - pairs as low from clades),
  groups as (select dataset as key, cast(sum(pairs) as bigint) as total from clades group by 1),
  {_drawn(limit)},
  located as (select n.key as dataset, p.clade_root, n.idx - p.low as idx from numbers n join placed p on p.dataset = n.key and n.idx >= p.low and n.idx < p.low + p.pairs),
  ji as (select *, cast(floor((1 + sqrt(1 + 8 * idx)) / 2) as bigint) as i from located),
  test_pairs as (select q.dataset, q.clade_root, a.tip as tip1, b.tip as tip2, {hamming('x.seq', 'y.seq')} as hamming, x.seq as seq1, y.seq as seq2 from ji q
    join ord b on b.dataset = q.dataset and b.clade_root = q.clade_root and b.o = q.i
    join ord a on a.dataset = q.dataset and a.clade_root = q.clade_root and a.o = q.idx - q.i * (q.i - 1) // 2
    join seqs x on x.dataset = q.dataset and x.name = a.tip and x.seq <> '' join seqs y on y.dataset = q.dataset and y.name = b.tip and y.seq <> '')"""


_STATS = """count(*) as n_branches, count(*) filter (coalesce(hamming, 0) = 0) as n_zero, min(coalesce(hamming, 0)) as min_hamming,
  max(coalesce(hamming, 0)) as max_hamming, cast(sum(coalesce(hamming, 0)) as bigint) as sum_hamming,
  count(*) filter (hamming is null) as n_missing, count(hamming) as n_known, min(hamming) as min_known"""
_FILES = """(select * from result_files where kind in ('forwards-train', 'forwards-test', 'pairwise-train', 'pairwise-test') and dataset is not null
  and ends_with(file_name, '.fasta') and regexp_matches(file_text, '(^|\\n)>')
  qualify row_number() over (partition by dataset, kind, file_name order by modified_at desc nulls last, file_id desc) = 1)"""
#: Nodes of complete documents, found level by level.
NODES = """with recursive docs as (select record_id, dataset, cast(tree_json as json) as j from auspice where json_valid(tree_json)),
  tops as (select record_id, case when json_exists(j, '$.tree') then j->'$.tree'
    when not json_exists(j, '$.meta') and not json_exists(j, '$.version') then j end as n from docs where json_type(j) = 'OBJECT'),
  nodes(record_id, node_path, no, depth, n) as (select record_id, '0', 0, 0, n from tops where json_type(n) = 'OBJECT'
    union all select p.record_id, p.node_path || '.' || i, i, p.depth + 1, json_extract(p.n, '$.children[' || i || ']')
    from nodes p, unnest(range(0, cast(coalesce(json_array_length(p.n, '$.children'), 0) as bigint))) as t(i)
    where json_type(p.n, '$.children') = 'ARRAY' and json_type(json_extract(p.n, '$.children[' || i || ']')) = 'OBJECT')"""
MUTATIONS = """,
  genes as (select record_id, node_path, depth, g.key as gene, g.value as l from nodes, json_each(n, '$.branch_attrs.mutations') as g
    where json_type(n, '$.branch_attrs.mutations') = 'OBJECT'),
  muts as (select record_id, node_path, depth, gene, cast(e.key as bigint) as item_no, e.value->>'$' as entry from genes, json_each(l) as e
    where json_type(l) = 'ARRAY')"""
#: A node's label: what the nodes before it in pre-order carry, and the nodes left by then, come before it.
LABELS = f"""{NODES}{MUTATIONS},
  raw as (select record_id, node_path, 1 as src, f.rowid as spot, f.key as field, f.value as v from nodes, json_each(n, '$.node_attrs') as f where json_type(n, '$.node_attrs') = 'OBJECT'
    union all select record_id, node_path, 2, f.rowid, f.key, f.value from nodes, json_each(n, '$.attr') as f where json_type(n, '$.attr') = 'OBJECT'),
  attrs as (select record_id, node_path, field, case when json_type(x) = 'VARCHAR' then x->>'$' else cast(x as varchar) end as value,
      case when not wrapped then 'plain' when json_type(x) = 'VARCHAR' then 'text' else 'other' end as shape,
      row_number() over (partition by record_id, node_path order by src, spot) - 1 as item_no
    from (select *, json_type(v) = 'OBJECT' and json_exists(v, '$.value') as wrapped, case when json_type(v) = 'OBJECT' and json_exists(v, '$.value') then v->'$.value' else v end as x from raw)
    where json_type(x) <> 'NULL'),
  n_attr as (select record_id, node_path, count(*) as n from attrs group by 1, 2), n_mut as (select record_id, node_path, count(*) as n from muts group by 1, 2),
  keyed as (select k.*, coalesce(a.n, 0) as n_attrs, coalesce(a.n, 0) + coalesce(m.n, 0) as carried, list_transform(string_split(k.node_path, '.'), lambda x: cast(x as bigint)) as k
    from nodes k left join n_attr a using (record_id, node_path) left join n_mut m using (record_id, node_path)),
  up(record_id, node_path, anc, carried) as (select record_id, node_path, node_path, carried from keyed union all
    select record_id, node_path, regexp_replace(anc, '\\.\\d+$', ''), carried from up where contains(anc, '.')),
  sizes as (select record_id, anc as node_path, sum(2 + carried) as size from up group by 1, 2),
  labelled as (select record_id, node_path, no, depth, n, n_attrs, cast(pre as bigint) as pre, cast(pre + size - 1 as bigint) as post from (
    select k.*, size, sum(1 + carried) over (partition by record_id order by k.k) - 1 - carried + row_number() over (partition by record_id order by k.k) - 1 - depth as pre
    from keyed k join sizes using (record_id, node_path)))"""
_WANTED = """,
  wanted as (select d.record_id, d.dataset, coalesce(a.gene, 'nuc') as gene, a.trim_begin, a.trim_end from docs d
    join (select distinct record_id from nodes) k using (record_id)
    left join analyses a on a.analysis = regexp_replace(d.dataset, '_\\d+$', ''))"""
_ROOTS = _WANTED + """,
  roots as (select w.record_id, w.gene, nullif(case when h.dataset is not null then s.seq else d.j->>('$.root_sequence.' || w.gene) end, '') as seq,
      h.dataset is not null as side from wanted w join docs d using (record_id)
    left join (select distinct dataset from root_sequences) h on h.dataset = w.dataset
    left join (select dataset, gene, max(seq) as seq from root_sequences group by 1, 2) s on s.dataset = w.dataset and s.gene = w.gene)"""
_POSITION = "try_cast(case when regexp_full_match(substr(entry, 2, greatest(length(entry) - 2, 0)), '[+-]?\\d+') then substr(entry, 2, greatest(length(entry) - 2, 0)) end as integer)"
_PARENT = "regexp_replace(node_path, '\\.\\d+$', '')"

NODE_SEQUENCES = f"""{NODES}{MUTATIONS}{_ROOTS},
        up(record_id, node_path, anc, hops) as (select record_id, node_path, node_path, 0 from nodes union all
          select record_id, node_path, regexp_replace(anc, '\\.\\d+$', ''), hops + 1 from up where contains(anc, '.')),
        hits as (select u.record_id, u.node_path, {_POSITION} as pos, right(entry, 1) as base, hops, item_no from up u
          join muts m on m.record_id = u.record_id and m.node_path = u.anc and m.depth > 0 join roots r on r.record_id = m.record_id and r.gene = m.gene and r.seq is not null),
        last as (select record_id, node_path, map(list(pos), list(base)) as c from (select * from hits where pos is not null
          qualify row_number() over (partition by record_id, node_path, pos order by hops, item_no desc) = 1) group by 1, 2)
        select n.record_id, n.node_path, coalesce(n.n->>'$.name', n.n->>'$.strain', '') as name, case when c is null then r.seq else
          array_to_string(list_transform(range(1, length(r.seq) + 1), lambda i: coalesce(c[cast(i as integer)], r.seq[i])), '') end as seq
        from nodes n join roots r on r.record_id = n.record_id and r.seq is not null left join last l on l.record_id = n.record_id and l.node_path = n.node_path"""
MUTATION_COUNTS = f"""{NODES}{MUTATIONS}{_WANTED} select m.record_id, node_path, count(*) as n_entries,
        count(*) filter (trim_begin is null or trim_end is null or coalesce({_POSITION} between trim_begin and trim_end, false)) as n_counted
        from muts m join wanted w on w.record_id = m.record_id and w.gene = m.gene group by 1, 2"""

ORACLE = {
    "edges": f"select * from {_links()}",
    "tips": f"{_BASE} select * from tips",
    "closure_depth": f"{_WALK} select dataset, node, len(path) - 1 as depth, path[1] as root from walk",
    "descendants": f"{_WALK} select dataset, anc as node, node as descendant, hops from pairs where hops > 0",
    "traversal_ranks": f"""{_WALK}, sized as (select w.dataset, w.node, w.path, s.n_nodes,
        row_number() over (partition by w.dataset, w.path[1] order by w.path) - 1 as preorder from walk w join sizes s on s.dataset = w.dataset and s.node = w.node)
        select dataset, node, preorder, preorder + n_nodes - len(path) as postorder from sized""",
    "clade_tip_count": f"{_WALK} select * from sizes",
    "branch_hamming": f"""{_WALK} select l.dataset, l.parent, l.child, case when a.seq is not null and b.seq is not null then
        {hamming('upper(b.seq)', 'upper(a.seq)')} end as hamming, l.split from links l
        left join seqs a on a.dataset = l.dataset and a.name = l.child left join seqs b on b.dataset = l.dataset and b.name = l.parent""",
    "branch_stats": f"select dataset, {_STATS} from {_links()} group by 1",
    "branch_histogram": f"""select dataset, low, high, count(*) as n from {_links()} l
        join (values (0, 1), (1, 5), (5, 10), (10, 20), (20, 50), (50, 100), (100, 200), (200, 500), (500, 1000)) b(low, high)
        on l.hamming >= low and l.hamming < high group by 1, 2, 3""",
    "branches_tsv": f"""select dataset, concat_ws(chr(9), parent, child, coalesce(cast(hamming as varchar), '?'), coalesce(split, '')) as line from {_links()}""",
    "walk_back": f"{_WALK}{WALKED} select * from walked",
    "random_clade_split": f"{_WALK}{WALKED}{RANDOM_CLADES} select * from splits",
    "monophyletic_split": f"{_WALK}{MONOPHYLETIC} select * from splits",
    "clade_roots": f"{_WALK} select * from roots",
    "clade_membership": f"{_WALK} select * from members",
    "forward_frames": f"{_WALK}{FRAMES} select dataset, split, tip, pos, node, cast(cum_dist as bigint) as cum_dist from frames",
    "fasta_render": f"""{_WALK}{FRAMES}, texts as (select f.dataset, f.split, f.tip, string_agg('>' || f.node || '|' || cast(cum_dist as bigint) || chr(10) ||
          regexp_replace(s.seq, '(.{{60}})', '\\1' || chr(10), 'g') || case when length(s.seq) % 60 = 0 then '' else chr(10) end, '' order by pos) as t
        from frames f join seqs s on s.dataset = f.dataset and s.name = f.node group by 1, 2, 3)
        select dataset, split, regexp_replace(regexp_replace(tip, '^hCoV-19', ''), '[/\\\\:*?"<>| ]', '', 'g') || '.fasta' as file_name, length(t) as n_chars, md5(t) as digest from texts""",
    "pairs_all": _train_pairs(None),
    "pair_files": f"""{_pair_files(_train_pair_steps(SAMPLE_LIMIT), 'train_pairs', 'pairwise-train')} union all
        {_pair_files(_WALK + _clade_pair_steps(CLADE_SAMPLE_LIMIT), 'test_pairs', 'pairwise-test')}""",
    "pairs_sampled": _train_pairs(SAMPLE_LIMIT),
    "pairs_within_clade": f"{_WALK}{_clade_pair_steps(TEST_LIMIT)} select dataset, clade_root, tip1, tip2, hamming from test_pairs",
    "pairs_sampled_by_clade": f"{_WALK}{_clade_pair_steps(CLADE_SAMPLE_LIMIT)} select dataset, clade_root, tip1, tip2, hamming from test_pairs",
    "stop_filter_trim": """select seq_id, dataset, regexp_replace(name, '^hCoV-19/', '') as name,
        case when trim_begin is not null and trim_end is not null then substr(rtrim(seq, '*'), trim_begin, trim_end - trim_begin + 1) else rtrim(seq, '*') end as seq
        from alignment left join analyses on analysis = regexp_replace(dataset, '_\\d+$', '') where not contains(rtrim(seq, '*'), '*')""",
    "metadata_rows": """select dataset, name, concat_ws(chr(9), name, coalesce(regexp_replace(parent, '^hCoV-19/', ''), 'None'), coalesce(clade_membership, ''), coalesce(clade, ''),
          coalesce(country, ''), coalesce(collection_date, ''), coalesce(family_name, ''), coalesce(S1_mutations, '')) as line
        from (select * replace (regexp_replace(name, '^hCoV-19/', '') as name) from metadata where dataset is not null and name is not null)
        qualify row_number() over (partition by dataset, name order by exported_at desc nulls last, parent desc nulls last, clade_membership desc nulls last,
          clade desc nulls last, country desc nulls last, collection_date desc nulls last, family_name desc nulls last, S1_mutations desc nulls last) = 1""",
    "summary": f"""{_WALK}{FRAMES}{_clade_pair_steps(TEST_LIMIT)},
        depth as (select dataset, tip, count(*) as depth from frames group by 1, 2),
        far as (select dataset, node as tip, cum_dist as distance from gone where hops = 0),
        ps as (select t.dataset, count(*) as n_tips, count(*) filter (t.split <> 'test') as n_train, count(*) filter (t.split = 'test') as n_test,
          min(distance) as min_distance, max(distance) as max_distance, sum(distance) as sum_distance, min(coalesce(depth, 0)) as min_depth,
          max(coalesce(depth, 0)) as max_depth, sum(coalesce(depth, 0)) as sum_depth from tips t join far using (dataset, tip) left join depth using (dataset, tip) group by 1),
        bs as (select dataset, {_STATS} from links group by 1),
        ss as (select dataset, count(*) as n_sequences from seqs where seq <> '' group by 1),
        fl as (select dataset, arg_min(length(seq), seq_id) as sequence_length from alignment where dataset is not null and name is not null and seq <> '' group by 1),
        trs as (select dataset, count(*) as train_pairs, min(hamming) as train_min, max(hamming) as train_max, cast(sum(hamming) as bigint) as train_sum from ({_train_pairs(TRAIN_LIMIT)}) group by 1),
        cs as (select dataset, count(distinct clade_root) as n_test_clades from members group by 1),
        ts as (select dataset, count(*) as test_pairs, min(hamming) as test_min, max(hamming) as test_max, sum(hamming) as test_sum from test_pairs group by 1)
        select dataset, n_tips, n_train, n_test, cast(min_distance as bigint) as min_distance, cast(max_distance as bigint) as max_distance, cast(sum_distance as bigint) as sum_distance,
          min_depth, max_depth, cast(sum_depth as bigint) as sum_depth, n_branches, n_zero, min_hamming, max_hamming, sum_hamming, n_missing, n_known, min_known,
          coalesce(n_sequences, 0) as n_sequences, coalesce(sequence_length, 0) as sequence_length, coalesce(n_test_clades, 0) as n_test_clades,
          coalesce(train_pairs, 0) as train_pairs, train_min, train_max, train_sum, coalesce(test_pairs, 0) as test_pairs, test_min, test_max, cast(test_sum as bigint) as test_sum
        from ps join bs using (dataset) left join ss using (dataset) left join fl using (dataset) left join trs using (dataset) left join cs using (dataset) left join ts using (dataset)""",
    "dataset_upsert": f"""with ends as (select dataset, min(exported_at) as f, max(exported_at) as l from branches group by 1),
        old as (select b.* from branches b join ends e on e.dataset = b.dataset and b.exported_at = e.f),
        again as (select b.* from branches b join ends e on e.dataset = b.dataset and e.f < e.l)
        select dataset, {_STATS} from {_links('again')} group by 1 union all
        select dataset, {_STATS} from {_links('old')} where dataset not in (select dataset from again) group by 1""",
    "root_sequences": f"{NODES}{_ROOTS} select record_id, gene, seq, case when seq is null then null when side then 'sidecar' else 'document' end as origin from roots",
    "node_sequences": NODE_SEQUENCES,
    "mutation_count_region": MUTATION_COUNTS,
    "metadata_fields": f"""{NODES}, keyed as (select record_id, node_path, n, list_transform(string_split(node_path, '.'), lambda x: cast(x as bigint)) as k from nodes),
        early as (select record_id, node_path from keyed qualify row_number() over (partition by record_id order by list_append(k, 9223372036854775807)) <= 100),
        fields as (select record_id, node_path, f.key as field, json_type(f.value, '$.value') as kind from nodes, json_each(n, '$.node_attrs') as f
          where json_type(n, '$.node_attrs') = 'OBJECT' and json_type(f.value) = 'OBJECT' and json_type(f.value, '$.value') <> 'NULL'
          union all select record_id, node_path, f.key, json_type(f.value, '$.value') from nodes, json_each(n, '$.attr') as f
          where json_type(n, '$.attr') = 'OBJECT' and json_type(f.value) = 'OBJECT' and json_type(f.value, '$.value') <> 'NULL')
        select record_id, field, count(*) as n_nodes from fields f group by 1, 2
        having field in ('clade_membership', 'clade', 'S1_mutations', 'family_name') or exists (select 1 from fields g join early e
          on e.record_id = g.record_id and e.node_path = g.node_path where g.record_id = f.record_id and g.field = f.field and g.kind = 'VARCHAR')""",
    "color_map": f"""{NODES}, parsed as (select record_id, cast(c.key as bigint) as no, c.value as c from docs join (select distinct record_id from nodes) using (record_id),
          json_each(j, '$.meta.colorings') as c where json_type(j, '$.meta.colorings') = 'ARRAY'),
        last as (select record_id, c->>'$.key' as field, arg_max(c, no) as c from parsed where c->>'$.type' = 'categorical' and json_type(c, '$.scale') = 'ARRAY' group by 1, 2)
        select record_id, field, coalesce(c->>'$.title', field) as title, s.value->>'$[0]' as value, arg_max(s.value->>'$[1]', cast(s.key as bigint)) as color
        from last, json_each(c, '$.scale') as s group by 1, 2, 3, 4""",
    "shard_assignment": f"""select dataset, kind, file_name, kind || '-' || lpad(cast((row_number() over (partition by dataset, kind order by md5('42:' || file_name), file_name) - 1) // 10 as varchar), 3, '0') || '.tar.zst' as shard from {_FILES}""",
    "shard_sizes": f"""select dataset, shard, count(*) as n_files, cast(ceil((sum(512 + ceil(strlen(file_text) / 512.0) * 512) + 1024) / 10240.0) * 10240 as bigint) as n_raw from (
        select dataset, file_text, kind || '-' || lpad(cast((row_number() over (partition by dataset, kind order by md5('42:' || file_name), file_name) - 1) // 10 as varchar), 3, '0') || '.tar.zst' as shard from {_FILES})
        group by 1, 2""",
    "alignment_fasta": f"""select seq_id, dataset, not starts_with(name, 'NODE_') as is_tip, length(t) as n_chars, md5(t) as digest from (select *, {_record('name', 'seq')} as t from (
        select seq_id, dataset, regexp_replace(name, '^hCoV-19/', '') as name,
          case when trim_begin is not null and trim_end is not null then substr(rtrim(seq, '*'), trim_begin, trim_end - trim_begin + 1) else rtrim(seq, '*') end as seq
        from alignment left join analyses on analysis = regexp_replace(dataset, '_\\d+$', '') where not contains(rtrim(seq, '*'), '*') and name is not null))""",
    "metadata_table": f"""{LABELS}, early as (select record_id, node_path from labelled qualify row_number() over (partition by record_id order by post) <= 100),
        shown as (select distinct a.record_id, a.field from attrs a where shape <> 'plain' and (field in ('clade_membership', 'clade', 'S1_mutations', 'family_name')
          or exists (select 1 from attrs g join early e on e.record_id = g.record_id and e.node_path = g.node_path where g.record_id = a.record_id and g.field = a.field and g.shape = 'text'))),
        named as (select *, regexp_replace(coalesce(n->>'$.name', n->>'$.strain', ''), '^hCoV-19/', '') as name from labelled),
        cells as (select n.record_id, n.node_path, n.post, n.name, coalesce(u.name, 'None') as parent, s.field, coalesce(a.value, '') as value from named n
          left join named u on u.record_id = n.record_id and n.depth > 0 and u.node_path = regexp_replace(n.node_path, '\\.\\d+$', '')
          left join shown s on s.record_id = n.record_id left join attrs a on a.record_id = n.record_id and a.node_path = n.node_path and a.field = s.field and a.shape <> 'plain')
        select record_id, post as place, concat_ws(chr(9), any_value(name), any_value(parent), string_agg(case when field is not null then value end, chr(9) order by field)) as line from cells group by 1, 2
        union all select record_id, -1, concat_ws(chr(9), 'name', 'parent', string_agg(field, chr(9) order by field)) from (select distinct record_id, field from cells) group by 1""",
    "fraction_sample": """select dataset, name from (select dataset, name, row_number() over (partition by dataset order by md5('42:' || name), name) as rn, count(*) over (partition by dataset) as n
        from (select distinct dataset, regexp_replace(name, '^hCoV-19/', '') as name from alignment where dataset is not null and length(seq) > 0
          and not starts_with(regexp_replace(name, '^hCoV-19/', ''), 'NODE_'))) where rn <= greatest(1, floor(n * 0.2))""",
    "sanitize_name": """select distinct dataset, name, regexp_replace(regexp_replace(name, '^hCoV-19', ''), '[/\\\\:*?"<>| ]', '', 'g') as stem from metadata where name is not null""",
    "publish_paths": """select dataset, 'trajectories/' || case when regexp_full_match(dataset, 'rdrp-[a-z]+-xs_\\d+')
        then regexp_replace(dataset, '_\\d+$', '') || '/subtrees/' || dataset else dataset end as prefix, count(*) as n_rows from metadata where dataset is not null group by 1, 2""",
}
