"""Statistics of datasets: tips, paths, branches and pairs, and the merge into earlier summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Lower bounds of the histogram's bins; the last bound closes the last bin.
BINS = [0, 1, 5, 10, 20, 50, 100, 200, 500, 1000]


def branch_stats(links: DataFrame) -> DataFrame:
    """Per dataset: branches, zero branches, min, max, sum with missing distances as 0; and over the known alone.

    Means are left as sum and count, so that they can be rounded where they are shown.
    """
    d = F.coalesce("hamming", F.lit(0))
    return links.groupBy("dataset").agg(
        F.count("*").alias("n_branches"),
        F.count_if(d == 0).alias("n_zero"),
        F.min(d).alias("min_hamming"),
        F.max(d).alias("max_hamming"),
        F.sum(d).alias("sum_hamming"),
        F.count_if(F.col("hamming").isNull()).alias("n_missing"),
        F.count("hamming").alias("n_known"),
        F.min("hamming").alias("min_known"),
    )


def branch_histogram(links: DataFrame) -> DataFrame:
    """dataset, low, high, n: known distances per half-open bin; empty bins, and 1000 and more, don't appear."""
    bins = F.array(*[F.struct(F.lit(a).alias("low"), F.lit(b).alias("high")) for a, b in zip(BINS, BINS[1:])])
    binned = links.where(F.col("hamming").between(0, BINS[-1] - 1)).withColumn(
        "bin", F.filter(bins, lambda b: (F.col("hamming") >= b["low"]) & (F.col("hamming") < b["high"]))[0]
    )
    return binned.groupBy("dataset", F.col("bin.low").alias("low"), F.col("bin.high").alias("high")).agg(F.count("*").alias("n"))


def path_stats(frames: DataFrame, tips: DataFrame, tip_distances: DataFrame) -> DataFrame:
    """Per dataset: tips, train and test tips, distance of the tips and frames a path (min, max, sum).

    tip_distances: dataset, tip, distance of every tip's path. A path without frames has depth 0.
    """
    depth = frames.groupBy("dataset", "tip").agg(F.count("*").alias("depth"))
    each = tips.join(tip_distances, ["dataset", "tip"]).join(depth, ["dataset", "tip"], "left").fillna(0, ["depth"])
    return each.groupBy("dataset").agg(
        F.count("*").alias("n_tips"),
        F.count_if(F.col("split") != "test").alias("n_train"),
        F.count_if(F.col("split") == "test").alias("n_test"),
        F.min("distance").alias("min_distance"),
        F.max("distance").alias("max_distance"),
        F.sum("distance").alias("sum_distance"),
        F.min("depth").alias("min_depth"),
        F.max("depth").alias("max_depth"),
        F.sum("depth").alias("sum_depth"),
    )


def pair_stats(pairs: DataFrame, prefix: str) -> DataFrame:
    """Per dataset with pairs: their number and their distances' min, max and sum, names prefixed."""
    return pairs.groupBy("dataset").agg(
        F.count("*").alias(f"{prefix}_pairs"),
        F.min("hamming").alias(f"{prefix}_min"),
        F.max("hamming").alias(f"{prefix}_max"),
        F.sum("hamming").alias(f"{prefix}_sum"),
    )


def bunch_stats(bunches: DataFrame, prefix: str) -> DataFrame:
    """pair_stats() of the pairs that the rows (dataset, n, low, high, total) of distances_within() stand for."""
    return bunches.groupBy("dataset").agg(
        F.sum("n").alias(f"{prefix}_pairs"), F.min("low").alias(f"{prefix}_min"), F.max("high").alias(f"{prefix}_max"), F.sum("total").alias(f"{prefix}_sum")
    )


def merge(previous: DataFrame, fresh: DataFrame, key: str = "dataset") -> DataFrame:
    """Every key of both: the columns of fresh where fresh has the key, the others as they were. Columns that only one has are kept.

    upsert() replaces whole rows, this sets single columns.
    """
    both = [c for c in previous.columns if c in fresh.columns and c != key]
    renamed = fresh.select(key, F.lit(True).alias("_fresh"), *(F.col(c).alias(f"_{c}" if c in both else c) for c in fresh.columns if c != key))
    joined = previous.join(renamed, key, "full")
    chosen = [F.when(F.col("_fresh"), F.col(f"_{c}")).otherwise(F.col(c)).alias(c) if c in both else c for c in previous.columns]
    return joined.select(*chosen, *(c for c in fresh.columns if c not in previous.columns))


def entries(summary: DataFrame, urls: DataFrame | None = None) -> DataFrame:
    """dataset, entry: one JSON object a dataset, as the summary document holds them under its name.

    summary: path_stats(), branch_stats() and pair_stats() of train and test joined. Means are rounded to two places, half to even;
    statistics of no pairs are left out. urls: dataset, url.
    """
    spread = lambda name, low, high, total, n: F.when(
        F.col(n) > 0, F.struct(F.col(low).alias("min"), F.col(high).alias("max"), F.bround(F.col(total) / F.col(n), 2).alias("mean"))
    ).alias(name)
    count = lambda c: F.coalesce(c, F.lit(0))
    rows = summary.join(urls, "dataset", "left") if urls is not None else summary.withColumn("url", F.lit(None).cast("string"))
    entry = F.struct(
        "url", F.col("n_tips").alias("num_tips"), count("n_sequences").alias("num_nodes"), count("sequence_length").alias("sequence_length"),
        spread("hamming_from_root", "min_distance", "max_distance", "sum_distance", "n_tips"), spread("path_depth", "min_depth", "max_depth", "sum_depth", "n_tips"),
        F.col("n_branches").alias("total_branches"), F.col("n_zero").alias("zero_distance_branches"), spread("per_branch_hamming", "min_hamming", "max_hamming", "sum_hamming", "n_branches"),
        F.col("n_train").alias("train_tips"), F.col("n_test").alias("test_tips"),
        count("train_pairs").alias("pairwise_train_pairs"), count("test_pairs").alias("pairwise_test_pairs"), count("n_test_clades").alias("pairwise_test_clades"),
        spread("pairwise_train_hamming", "train_min", "train_max", "train_sum", "train_pairs"), spread("pairwise_test_hamming", "test_min", "test_max", "test_sum", "test_pairs"),
    )
    return rows.select("dataset", F.to_json(entry).alias("entry"))


def upsert(previous: DataFrame, current: DataFrame, key: str = "dataset") -> DataFrame:
    """The current rows, and the previous rows of keys that current has none of; both have the same columns."""
    kept = previous.join(current.select(key), key, "left_anti")
    return current.unionByName(kept)
