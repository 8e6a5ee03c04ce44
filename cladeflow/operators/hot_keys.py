"""Per-key results when a few keys hold most rows: dense accumulator arrays.

The keys are dictionary-encoded, every task adds its own share of the rows into numpy arrays indexed by
the code (bincount and scatter-minimum/-maximum), and the arrays are summed block by block. A task's
load is its share of the input, whatever the keys are; no row is ever sent to a task for its key.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cladeflow.operators.dense_ids import dense_ids
from cladeflow.session import written

#: Codes of one accumulator block.
BLOCK = 4096
#: Blocks that a task holds before it passes them on; bounds its memory at any number of keys.
BLOCKS_HELD = 256
#: The dictionary is broadcast up to this many keys and joined by shuffle beyond, with keys salted that hold more rows than a
#: shuffle partition should.
BROADCAST_KEYS = 200_000

_LOW, _HIGH = np.iinfo(np.int64).min, np.iinfo(np.int64).max


def _accumulator(sums: list[str], lows: list[str], highs: list[str]):
    fill = dict.fromkeys(sums, 0) | dict.fromkeys(lows, _HIGH) | dict.fromkeys(highs, _LOW)

    def flush(blocks: dict[int, dict[str, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        for block, arrays in blocks.items():
            used = np.flatnonzero(arrays["rows"])
            columns = [pa.array(np.full(len(used), block, np.int64)), pa.array(used.astype(np.int64))]
            columns += [pa.array(arrays[m][used]) for m in fill]
            yield pa.RecordBatch.from_arrays(columns, ["block", "slot", *fill])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks: dict[int, dict[str, np.ndarray]] = {}
        for batch in batches:
            codes = batch.column("code").to_numpy(zero_copy_only=False).astype(np.int64)
            values = {m: batch.column(m).fill_null(fill[m]).to_numpy(zero_copy_only=False).astype(np.int64) for m in fill}
            for block in np.unique(codes // BLOCK):
                if block not in blocks:
                    if len(blocks) >= BLOCKS_HELD:
                        yield from flush(blocks)
                        blocks.clear()
                    blocks[block] = {m: np.full(BLOCK, v, np.int64) for m, v in fill.items()}
                mine = codes // BLOCK == block
                slots = codes[mine] % BLOCK
                for m in sums:
                    taken = values[m][mine]
                    if abs(taken).sum(dtype=np.float64) < 2**53:
                        blocks[block][m] += np.bincount(slots, weights=taken, minlength=BLOCK).astype(np.int64)
                    else:
                        np.add.at(blocks[block][m], slots, taken)
                for m in lows:
                    np.minimum.at(blocks[block][m], slots, values[m][mine])
                for m in highs:
                    np.maximum.at(blocks[block][m], slots, values[m][mine])
        yield from flush(blocks)

    return run, "block long, slot long, " + ", ".join(f"{m} long" for m in fill)


def dense_key_stats(
    df: DataFrame,
    key: Column,
    key_name: str,
    sums: dict[str, Column] | None = None,
    lows: dict[str, Column] | None = None,
    highs: dict[str, Column] | None = None,
    distincts: dict[str, Column] | None = None,
) -> DataFrame:
    """Row count (`rows`), integer sums, minima, maxima and distinct counts per key.

    Rows whose key is null belong to no key. Null values add nothing; a minimum or maximum of nulls only
    is null. Repeated rows count as often as they occur. An empty input gives an empty result. Columns
    of df other than those in the expressions are ignored, whatever their names.
    """
    sums, lows, highs, distincts = sums or {}, lows or {}, highs or {}, distincts or {}
    work = df.select(
        key.alias("_key"),
        *(c.cast("long").alias(n) for n, c in {**sums, **lows, **highs}.items()),
        *(c.alias(n) for n, c in distincts.items()),
    ).where("_key is not null")
    keys = written(dense_ids(work, ["_key"], "code"), "keys")
    small = keys.count() <= BROADCAST_KEYS
    result = _scatter(work, keys, small, list(sums), list(lows), list(highs))
    for name in distincts:
        pairs = work.select("_key", name).dropna().distinct()
        found = _scatter(pairs, keys, small, [], [], []).select("code", F.col("rows").alias(name))
        result = result.join(found, "code", "left").fillna(0, [name])
    return keys.join(result, "code").select(
        F.col("_key").alias(key_name), "rows", *sums, *lows, *highs, *distincts
    )


def _scatter(work: DataFrame, keys: DataFrame, small: bool, sums: list[str], lows: list[str], highs: list[str]) -> DataFrame:
    values = work.select("_key", *sums, *lows, *highs).withColumn("rows", F.lit(1).cast("long"))
    if small:
        coded = values.join(F.broadcast(keys), "_key")
    else:
        salts = int(work.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        counts = values.groupBy("_key").agg(F.count("*").alias("_n"))
        hot = counts.crossJoin(F.broadcast(counts.agg(F.sum("_n").alias("_all")))).where(F.col("_n") * salts > F.col("_all"))
        hot = written(hot.select("_key", F.lit(True).alias("_hot")), "hot")  # fewer keys than partitions
        every = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
        salted = keys.join(F.broadcast(hot), "_key", "left").select(*keys.columns, F.explode(every).alias("_salt"))
        one = F.when(F.col("_hot"), F.pmod(F.spark_partition_id(), F.lit(salts))).otherwise(F.lit(0))
        coded = values.join(F.broadcast(hot), "_key", "left").withColumn("_salt", one).join(salted, ["_key", "_salt"])
    run, schema = _accumulator(["rows", *sums], lows, highs)
    parts = coded.select("code", "rows", *sums, *lows, *highs).mapInArrow(run, schema)
    summed = parts.groupBy("block", "slot").agg(
        *(F.sum(m).alias(m) for m in ["rows", *sums]),
        *(F.min(m).alias(m) for m in lows),
        *(F.max(m).alias(m) for m in highs),
    )
    clear = lambda m, empty: F.when(F.col(m) != F.lit(int(empty)), F.col(m)).alias(m)
    return summed.select(
        (F.col("block") * BLOCK + F.col("slot")).alias("code"),
        "rows",
        *sums,
        *(clear(m, _HIGH) for m in lows),
        *(clear(m, _LOW) for m in highs),
    )


def keys_above_share(df: DataFrame, key: Column, key_name: str, share: float) -> DataFrame:
    """The keys that at least the given share of all rows carry, rows without a key included in the whole."""
    stats = dense_key_stats(df, key, key_name)
    total = df.agg(F.count("*").alias("_total"))
    return stats.crossJoin(F.broadcast(total)).where(F.col("rows") >= F.col("_total") * F.lit(share)).select(key_name)
