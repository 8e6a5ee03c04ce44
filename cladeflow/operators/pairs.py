"""Pairs of tips, all of them or a sample of given size, without building more pairs than asked for.

A pair is a number: with the members of a group numbered 0 to n-1, number i(i-1)/2 + j stands for the
members j < i. Samples draw numbers and turn them into pairs, so their cost is that of the sample.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from cladeflow.functions.distances import each_with_each, side_by_side
from cladeflow.functions.names import file_stem
from cladeflow.functions.sequences import fasta_record, masked_hamming
from cladeflow.operators.dense_ids import ordinals, running_before
from cladeflow.operators.intervals import interval_blocks, point_blocks
from cladeflow.operators.lineage import node_sequences
from cladeflow.session import written

#: A group whose draws bring too few numbers is drawn again with so many times as many.
DRAWS = 4
#: Numbers that one row is turned into at once, and items of a block when all pairs are measured.
STRIDE, BLOCK = 65_536, 128
#: Pairs that are measured at once, and parts per shuffle partition in which numbers are drawn.
BUNCH, PARTS = 32_768, 4


def pair_count(n: Column) -> Column:
    return F.floor(n * (n - 1) / 2)


def unrank(idx: Column) -> tuple[Column, Column]:
    """(j, i) of a pair number, j < i; the root's rounding is put right by one step either way."""
    guess = F.floor((1 + F.sqrt(1 + 8 * idx.cast("double"))) / 2)
    low = lambda i: F.floor(i * (i - 1) / 2)
    i = F.when(low(guess) > idx, guess - 1).when(low(guess + 1) <= idx, guess + 1).otherwise(guess)
    return (idx - low(i)).cast("long"), i.cast("long")


def drawn_numbers(groups: DataFrame, key: str, limit: int | None, seed: int) -> DataFrame:
    """(key, idx): up to `limit` distinct numbers below `total` for each row (key, total) of groups.

    All of them if there are no more than limit or limit is None; else drawn by hash of seed, key and draw number, each
    number once, in the order of its first draw. Of up to twice the limit, all are put in the order of their hashes.
    A group's numbers are drawn and ordered in the task that its row was sent to: no number is shuffled.
    """
    hashed = lambda d: F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key), d.cast("string")))
    if limit is not None and limit < 0:
        raise ValueError("limit must not be negative")
    span = lambda low, high, step: F.explode(F.sequence(F.lit(low).cast("long"), high, F.lit(step).cast("long")))

    def number(g: DataFrame, upto: Column) -> DataFrame:  # in two steps, as a group's numbers may be too many for one row
        starts = g.where("total > 0").withColumn("_low", span(0, upto, STRIDE)).withColumn("_high", F.least(F.col("_low") + STRIDE - 1, upto))
        return starts.withColumn("d", F.explode(F.sequence("_low", "_high"))).drop("_low", "_high")

    if limit is None:
        return number(groups, F.col("total") - 1).select(key, F.col("d").alias("idx"))
    every = groups.where(F.col("total") <= limit)
    groups = groups.select(key, "total").repartition(PARTS * int(groups.sparkSession.conf.get("spark.sql.shuffle.partitions")), key)
    dense = groups.where((F.col("total") > limit) & (F.col("total") <= 2 * limit))
    sparse = groups.where(F.col("total") > 2 * limit)
    all_of = number(every, F.col("total") - 1).select(key, F.col("d").alias("idx"))
    ranked = number(dense, F.col("total") - 1).withColumn("rn", F.row_number().over(Window.partitionBy(key).orderBy(hashed(F.col("d")))))
    most_of = ranked.where(F.col("rn") <= limit).select(key, F.col("d").alias("idx"))
    # as many draws as bring the limit on average, and a margin; which numbers come first doesn't depend on how many are drawn
    mean = -F.col("total") * F.log1p(-F.lit(limit) / F.col("total"))
    draws = F.ceil(mean + 8 * F.sqrt(mean) + 8)
    while True:
        tried = number(sparse, (draws - 1).cast("long"))
        idx = F.conv(F.substring(hashed(F.col("d")), F.lit(1), F.lit(15)), 16, 10).cast("long") % F.col("total")
        first = tried.select(key, "d", idx.alias("idx")).groupBy(key, "idx").agg(F.min("d").alias("d"))
        some = first.withColumn("rn", F.row_number().over(Window.partitionBy(key).orderBy("d"))).where(F.col("rn") <= limit)
        some = written(some.select(key, "idx"), "draws")
        short = some.groupBy(key).agg(F.count("*").alias("n")).where(F.col("n") < limit).limit(1).count()
        if not short:
            return all_of.unionByName(most_of).unionByName(some)
        draws = draws * DRAWS


def with_sequences(pairs: DataFrame, alignment: DataFrame, keep: bool = False) -> DataFrame:
    """The pairs (dataset, tip1, tip2 and others) with hamming, and with seq1 and seq2 if they are to be kept.

    Pairs that miss a sequence are dropped, letters compare as they are.
    """
    seqs = node_sequences(alignment).where("seq <> ''")
    joined = pairs.join(seqs.toDF("dataset", "tip1", "seq1"), ["dataset", "tip1"]).join(seqs.toDF("dataset", "tip2", "seq2"), ["dataset", "tip2"])
    return joined.select(*pairs.columns, masked_hamming("seq1", "seq2").alias("hamming"), *(["seq1", "seq2"] if keep else []))


def every_pair(members: DataFrame, groups: list[str], item: str, alignment: DataFrame) -> DataFrame:
    """groups, tip1, tip2, hamming of all pairs of each group's items that have a sequence, tip1 before tip2 in their order.

    groups hold dataset. The result is as large as there are pairs, the sequences on the way aren't: blocks of items meet blocks, so
    that a sequence is sent once a block and not once a pair.
    """
    seqs = node_sequences(alignment).where("seq <> ''").select("dataset", F.col("name").alias(item), "seq")
    numbered = written(ordinals(members.join(seqs.select("dataset", item), ["dataset", item], "left_semi"), groups, [item], "ord"), "ordinals")
    held = numbered.join(seqs, ["dataset", item]).withColumn("block", F.floor(F.col("ord") / BLOCK))
    blocks = held.groupBy(*groups, "block").agg(F.max("n").alias("n"), F.collect_list(F.struct("ord", F.col(item).alias("tip"), "seq")).alias("items"))
    blocks = written(blocks, "blocks")
    last = F.floor((F.col("n") - 1) / BLOCK)
    low = blocks.select(*groups, F.col("items").alias("items1"), F.explode(F.sequence("block", last)).alias("block"))
    met = low.join(blocks.select(*groups, "block", F.col("items").alias("items2")), [*groups, "block"]).select(*groups, "items1", "items2")
    made = [StructField("tip1", StringType()), StructField("tip2", StringType()), StructField("hamming", IntegerType())]
    return met.mapInArrow(_met(groups), StructType([*(met.schema[g] for g in groups), *made]))


def _met(groups: list[str]):
    """Rows (groups, items1, items2) to those of all pairs of an item of the one and a later one of the other, a batch a row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                one, two = (batch.column(c)[k].values for c in ("items1", "items2"))
                ord1, ord2 = (side.field("ord").to_numpy(zero_copy_only=False) for side in (one, two))
                a, b = np.nonzero(ord1[:, None] < ord2)
                of = np.full(len(a), k)
                hamming = each_with_each(one.field("seq"), two.field("seq"))[a, b]
                columns = [batch.column(g).take(pa.array(of)) for g in groups]
                columns += [one.field("tip").take(pa.array(a)), two.field("tip").take(pa.array(b)), pa.array(hamming, pa.int32())]
                yield pa.RecordBatch.from_arrays(columns, [*groups, "tip1", "tip2", "hamming"])

    return run


def pair_files(pairs: DataFrame, kind: str) -> DataFrame:
    """dataset, file_path, content: a FASTA file of two records a pair, the first at distance 0.

    pairs: dataset, tip1, tip2, hamming, seq1, seq2. file_path is `{kind}/{stem1}__{stem2}.fasta`.
    """
    record = lambda tip, far, seq: fasta_record(F.concat_ws("|", tip, far.cast("string")), F.col(seq))
    path = F.concat(F.lit(f"{kind}/"), file_stem("tip1"), F.lit("__"), file_stem("tip2"), F.lit(".fasta"))
    return pairs.select("dataset", path.alias("file_path"), F.concat(record("tip1", F.lit(0), "seq1"), record("tip2", F.col("hamming"), "seq2")).alias("content"))


def pairs_within(members: DataFrame, group: str, item: str, limit: int | None = None, seed: int = 42) -> DataFrame:
    """(group, tip1, tip2) of up to `limit` pairs of each group's items (None: all), tip1 before tip2 in their order."""
    numbered = written(ordinals(members, [group], [item], "ord"), "ordinals")
    totals = numbered.groupBy(group).agg(F.max("n").alias("n")).select(group, pair_count(F.col("n")).cast("long").alias("total"))
    return _named(drawn_numbers(totals, group, limit, seed), numbered, group, item)


def distances_within(members: DataFrame, alignment: DataFrame, limit: int | None = None, seed: int = 42) -> DataFrame:
    """dataset, n, low, high, total: number, minimum, maximum and sum of the distances of pairs_within() of the datasets' tips,
    those that miss a sequence left out; a dataset may have several rows, each of them of some of its pairs.

    Pairs stay numbers, and bunches of numbers meet the sequences of the tips that are named in them: a sequence is sent once a
    bunch and not once a pair, and no pair is a row.
    """
    numbered = written(ordinals(members, ["dataset"], ["tip"], "ord"), "ordinals")
    totals = written(numbered.groupBy("dataset").agg(F.max("n").alias("n")).select("dataset", pair_count(F.col("n")).cast("long").alias("total")).where("total > 0"), "totals")
    every = totals if limit is None else totals.where(F.col("total") <= limit)
    starts = F.explode(F.sequence(F.lit(0).cast("long"), F.col("total") - 1, F.lit(BUNCH).cast("long")))
    stretch = every.select("dataset", "total", starts.alias("bunch")).select("dataset", "bunch", F.least(F.col("bunch") + BUNCH, "total").alias("to"), F.lit(None).cast("array<bigint>").alias("numbers"))
    bunches = stretch
    if limit is not None:
        more = totals.where(F.col("total") > limit)
        share = F.floor(F.col("total") / F.ceil(F.lit(limit) / BUNCH)) + 1 if limit else F.col("total")
        drawn = drawn_numbers(more, "dataset", limit, seed).join(more.select("dataset", share.cast("long").alias("share")), "dataset")
        held = drawn.groupBy("dataset", F.floor(F.col("idx") / F.col("share")).alias("bunch")).agg(F.collect_list("idx").alias("numbers"))
        bunches = stretch.unionByName(held.select("dataset", "bunch", F.lit(None).cast("long").alias("to"), "numbers"))
    bunches = written(bunches, "bunches")
    named = bunches.mapInArrow(_named_in, "dataset string, bunch long, ord long")
    seqs = node_sequences(alignment).where("seq <> ''").select("dataset", F.col("name").alias("tip"), "seq")
    sent = named.join(numbered.join(seqs, ["dataset", "tip"]).select("dataset", "ord", "seq"), ["dataset", "ord"]).select("dataset", "bunch", "ord", "seq")
    both = bunches.groupBy("dataset", "bunch").cogroup(sent.groupBy("dataset", "bunch"))
    return both.applyInArrow(_bunch_distances, "dataset string, n long, low int, high int, total long")


def _places(bunch: int, to: int | None, numbers: pa.Scalar) -> tuple[np.ndarray, np.ndarray]:
    """The members (j, i), j < i, of a bunch's pairs, as unrank() has them."""
    idx = np.arange(bunch, to) if to is not None else numbers.values.to_numpy(zero_copy_only=False)
    i = np.floor((1 + np.sqrt(1 + 8 * idx.astype(np.float64))) / 2).astype(np.int64)
    i -= i * (i - 1) // 2 > idx
    i += i * (i + 1) // 2 <= idx
    return idx - i * (i - 1) // 2, i


def _named_in(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k in range(batch.num_rows):
            bunch, to = batch.column("bunch")[k].as_py(), batch.column("to")[k].as_py()
            ords = np.unique(np.concatenate(_places(bunch, to, batch.column("numbers")[k])))
            dataset = batch.column("dataset").take(pa.array(np.full(len(ords), k)))
            yield pa.RecordBatch.from_arrays([dataset, pa.array(np.full(len(ords), bunch)), pa.array(ords)], ["dataset", "bunch", "ord"])


def _bunch_distances(bunches: pa.Table, sent: pa.Table) -> pa.Table:
    rows = []
    sent = sent.sort_by("ord").combine_chunks()
    ords = sent.column("ord").to_numpy()
    for k in range(bunches.num_rows if len(ords) else 0):
        bunch, to = bunches.column("bunch")[k].as_py(), bunches.column("to")[k].as_py()
        pair = _places(bunch, to, bunches.column("numbers")[k])
        first, second = (np.minimum(np.searchsorted(ords, p), len(ords) - 1) for p in pair)
        kept = (ords[first] == pair[0]) & (ords[second] == pair[1])
        if kept.any():
            d = side_by_side(sent.column("seq").chunk(0), first[kept], second[kept])
            rows.append((bunches.column("dataset")[k].as_py(), len(d), int(d.min()), int(d.max()), int(d.sum(dtype=np.int64))))
    types = {"dataset": pa.string(), "n": pa.int64(), "low": pa.int32(), "high": pa.int32(), "total": pa.int64()}
    return pa.table([pa.array([r[c] for r in rows], t) for c, t in enumerate(types.values())], list(types))


def _named(numbers: DataFrame, numbered: DataFrame, group: str, item: str) -> DataFrame:
    j, i = unrank(F.col("idx"))
    at = numbers.select(group, j.alias("j"), i.alias("i"))
    first = numbered.select(group, F.col("ord").alias("j"), F.col(item).alias("tip1"))
    second = numbered.select(group, F.col("ord").alias("i"), F.col(item).alias("tip2"))
    return at.join(first, [group, "j"]).join(second, [group, "i"]).select(group, "tip1", "tip2")


def pairs_within_clades(membership: DataFrame, limit: int | None = None, seed: int = 42) -> DataFrame:
    """(dataset, clade_root, tip1, tip2): up to `limit` pairs a dataset (None: all), within its clades.

    The pair numbers of a dataset's clades follow one another; a drawn number is located in the clade
    whose stretch of numbers holds it.
    """
    clade = F.to_json(F.struct("dataset", "clade_root")).alias("clade")
    numbered = written(ordinals(membership.select(clade, "tip"), ["clade"], ["tip"], "ord"), "ordinals")
    clades = membership.select("dataset", "clade_root", clade).groupBy("dataset", "clade_root", "clade").agg(F.count("*").alias("m"))
    clades = clades.where("m >= 2").select("dataset", "clade_root", "clade", pair_count(F.col("m")).cast("long").alias("pairs"))
    placed = running_before(clades, ["dataset", "clade_root"], "pairs", "before")
    starts = placed.groupBy("dataset").agg(F.min("before").alias("start"), F.sum("pairs").cast("long").alias("total"))
    placed = placed.join(starts, "dataset").select("dataset", "clade_root", "clade", "pairs", "total", (F.col("before") - F.col("start")).alias("low"))
    numbers = drawn_numbers(starts.select("dataset", "total"), "dataset", limit, seed).join(starts.select("dataset", "total"), "dataset")
    spans = interval_blocks(placed.select("dataset", "clade_root", "clade", "low", "pairs"), "low", "pairs")
    located = point_blocks(numbers, "idx", "total").join(spans, ["dataset", "level", "block"])
    local = located.select("clade", "dataset", "clade_root", (F.col("idx") - F.col("low")).alias("idx"))
    j, i = unrank(F.col("idx"))
    at = local.select("dataset", "clade_root", "clade", j.alias("j"), i.alias("i"))
    first = numbered.select("clade", F.col("ord").alias("j"), F.col("tip").alias("tip1"))
    second = numbered.select("clade", F.col("ord").alias("i"), F.col("tip").alias("tip2"))
    return at.join(first, ["clade", "j"]).join(second, ["clade", "i"]).select("dataset", "clade_root", "tip1", "tip2")
