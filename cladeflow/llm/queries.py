"""Queries p3, p6, p7, p8 and p9: the training-data problems on the project's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cladeflow.llm import mojibake, overlap, packing, splits, tokens
from cladeflow.sources.tables import table


def _new_splits(spark: SparkSession, data_dir: str) -> DataFrame:
    entities = splits.tip_entities(table(spark, data_dir, "metadata"), table(spark, data_dir, "branches"))
    return splits.grouped_splits(entities, table(spark, data_dir, "split_targets"))


def p3_found(spark: SparkSession, data_dir: str) -> DataFrame:
    return splits.scattered_groups(_new_splits(spark, data_dir))


def p3_assigned(spark: SparkSession, data_dir: str) -> DataFrame:
    return _new_splits(spark, data_dir)


def _overlaps(spark: SparkSession, data_dir: str) -> tuple[DataFrame, DataFrame]:
    tips = overlap.tip_sequences(table(spark, data_dir, "alignment"), table(spark, data_dir, "branches"))
    return overlap.cross_split_pairs(tips)


def p6_found(spark: SparkSession, data_dir: str) -> DataFrame:
    pairs = overlap.expanded_pairs(*_overlaps(spark, data_dir))
    ids = F.least("held_out_id", "training_id"), F.greatest("held_out_id", "training_id")
    return pairs.select(ids[0].alias("seq_id_1"), ids[1].alias("seq_id_2")).distinct()


def p6_report(spark: SparkSession, data_dir: str) -> DataFrame:
    return overlap.overlap_report(*_overlaps(spark, data_dir))


def p7_ids(spark: SparkSession, data_dir: str) -> DataFrame:
    return tokens.encode_corpus(table(spark, data_dir, "documents"))


def p7_decoded(spark: SparkSession, data_dir: str) -> DataFrame:
    """Every document's text, decoded from its ids."""
    return tokens.decode_corpus(p7_ids(spark, data_dir))


def p8_assigned(spark: SparkSession, data_dir: str) -> DataFrame:
    items = tokens.token_counts(table(spark, data_dir, "documents")).withColumnRenamed("n_tokens", "size")
    return packing.pack(items, table(spark, data_dir, "capacities").where("unit_name = 'tokens'"))


def p8_fill(spark: SparkSession, data_dir: str) -> DataFrame:
    return packing.fill_report(p8_assigned(spark, data_dir))


def p9_found(spark: SparkSession, data_dir: str) -> DataFrame:
    return mojibake.garbled_documents(table(spark, data_dir, "documents"))


def p9_restored(spark: SparkSession, data_dir: str) -> DataFrame:
    return mojibake.restored_documents(table(spark, data_dir, "documents"))


QUERIES = {
    f.__name__: f for f in (p3_found, p3_assigned, p6_found, p6_report, p7_ids, p7_decoded, p8_assigned, p8_fill, p9_found, p9_restored)
}

_TIPS = """select distinct dataset, regexp_replace(name, '^hCoV-19/', '') as name,
  upper(regexp_replace(clade_membership, '^\\s+|\\s+$', '', 'g')) as clade from metadata
  where dataset is not null and not starts_with(regexp_replace(name, '^hCoV-19/', ''), 'NODE_')"""
_SPLITS = """select dataset, name, max(struct_pack(at := exported_at, s := s)).s as split from (
  select dataset, regexp_replace(child, '^hCoV-19/', '') as name, exported_at,
    coalesce(nullif(lower(regexp_replace(train_test, '\\s+', '', 'g')), ''), 'train') as s
  from branches where dataset is not null and child is not null) group by 1, 2"""

#: Every test row against every train row. With `-` as N, masked positions differ exactly where one of the two is masked, which
#: the rows' masks tell by themselves.
_NEAR = f"""with tips as (select a.seq_id, a.dataset, coalesce(s.split, 'train') as split, replace(upper(a.seq), '-', 'N') as seq,
    regexp_replace(replace(upper(a.seq), '-', 'N'), '[^N]', '0', 'g') as mask
    from alignment a left join ({_SPLITS}) s on s.dataset = a.dataset and s.name = regexp_replace(a.name, '^hCoV-19/', '')
    where length(a.seq) > 0 and not starts_with(regexp_replace(a.name, '^hCoV-19/', ''), 'NODE_')),
  cut as (select a.seq_id as a_id, b.seq_id as b_id, a.dataset as a_set, b.dataset as b_set, greatest(length(a.seq), length(b.seq)) as longer,
    least(length(a.seq), length(b.seq)) as n, substr(a.seq, 1, n) as x, substr(b.seq, 1, n) as y, substr(a.mask, 1, n) as p, substr(b.mask, 1, n) as q
    from tips a join tips b on a.split = 'test' and b.split = 'train' and least(length(a.seq), length(b.seq)) * 5 >= greatest(length(a.seq), length(b.seq)) * 4),
  seen as (select *, hamming(p, q) as one, n - (2 * n - length(replace(p, 'N', '')) - length(replace(q, 'N', '')) + hamming(p, q)) // 2 as comparable, hamming(x, y) - hamming(p, q) as differing from cut),
  near as (select * from seen where comparable >= 1 and comparable * 5 >= longer * 4 and differing * 100 <= comparable)"""

ORACLE = {
    "p6_found": f"{_NEAR} select distinct least(a_id, b_id) as seq_id_1, greatest(a_id, b_id) as seq_id_2 from near",
    "p6_report": f"""{_NEAR} select 'test' as split, a_set as dataset, count(*) as n_pairs, count(distinct a_id) as n_rows, count(*) filter (differing = 0) as n_equal from near group by 2
        union all select 'train', b_set, count(*), count(distinct b_id), count(*) filter (differing = 0) from near group by 2""",
    "p7_decoded": "select doc_id, coalesce(text, '') as text from documents where doc_id is not null",
    "p3_found": f"""select t.dataset, t.clade as clade_membership from ({_TIPS}) t
        left join ({_SPLITS}) s on s.dataset = t.dataset and s.name = t.name
        where t.clade is not null group by 1, 2 having count(distinct coalesce(s.split, 'train')) > 1""",
}
