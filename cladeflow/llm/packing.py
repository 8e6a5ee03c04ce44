"""Items into containers of fixed capacity, by best-two-fit, shard by shard.

The items are spread by hash over shards of a bounded number of items, each packed by one task. A bin is
filled greedily with the largest item that fits; then its smallest item is replaced by two unpacked
items, if two fit the gap that this opens and fill it better. A shard leaves at most one badly filled
bin, whatever the number of shards. An item above the capacity is cut into full containers and a rest,
which is packed like any item.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cladeflow.session import written

#: Items that one task packs, about.
SHARD_ITEMS = 25_000
#: Partitions that the groups are hashed into, at least.
PARTITIONS = 64

ASSIGNED = "container_name string, capacity long, shard int, bin_no long, doc_id long, piece_no int, n_pieces int, start long, size long"


def best_two_fit(sizes: list[int], capacity: int) -> list[list[int]]:
    """Bins as lists of item numbers; each size is 1 to capacity, every item is in one bin."""
    waiting: dict[int, list[int]] = {}
    for item, size in enumerate(sizes):
        waiting.setdefault(size, []).append(item)
    present = 0  # bit s is set while an item of size s waits
    for size in waiting:
        present |= 1 << size

    def largest(limit: int) -> int:
        """The largest waiting size up to limit, 0 if none."""
        return (present & ((1 << (limit + 1)) - 1)).bit_length() - 1 if limit > 0 and present & ((1 << (limit + 1)) - 1) else 0

    def take(size: int) -> int:
        nonlocal present
        item = waiting[size].pop()
        if not waiting[size]:
            present &= ~(1 << size)
        return item

    def put(size: int, item: int) -> None:
        nonlocal present
        waiting[size].append(item)
        present |= 1 << size

    bins = []
    while present:
        gap, packed = capacity, []
        while size := largest(gap):
            packed.append((size, take(size)))
            gap -= size
        if gap and len(packed) > 1 and present:
            small, item = min(packed)
            room, best = gap + small, (small, 0, 0)
            first = largest(room // 2)
            while first and 2 * first <= room:
                second = largest(room - first)
                if second == first and len(waiting[first]) < 2:
                    second = largest(first - 1)
                if second and first + second > best[0]:
                    best = (first + second, first, second)
                if best[0] == room:
                    break
                first = largest(first - 1)
            if best[1]:
                packed.remove((small, item))
                put(small, item)
                packed += [(s, take(s)) for s in best[1:]]
        bins.append([item for _, item in packed])
    return bins


def pack(items: DataFrame, containers: DataFrame, shard_items: int = SHARD_ITEMS) -> DataFrame:
    """Assign every item to bins of every container.

    items: doc_id, size (long); containers: container_name, capacity (a few rows). One row per piece:
    container_name, capacity, bin_id, doc_id, piece_no (from 0), n_pieces, start (offset of the piece within
    its item), size. Items of size 0 or null come out with size 0 in bin 0 of their shard; repeated rows are items
    of their own; rows without doc_id are left out. An item is divided only if it exceeds the capacity: into
    full pieces and a rest. Containers whose capacity is null or below 1 hold nothing and give no rows.
    """
    items = written(items.select("doc_id", "size"), "items")  # measured once, for the number of shards and for packing
    shards = max(1, -(-items.count() // shard_items))
    bounded = containers.where("capacity >= 1").select("container_name", F.col("capacity").cast("long").alias("capacity"))
    sized = items.where("doc_id is not null").select("doc_id", F.greatest(F.coalesce("size", F.lit(0)), F.lit(0)).cast("long").alias("whole"))
    each = sized.withColumn("shard", F.pmod(F.xxhash64("doc_id"), F.lit(shards)).cast("int")).crossJoin(F.broadcast(bounded))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        capacity = int(pdf.capacity.iloc[0])
        pdf = pdf.sort_values(["whole", "doc_id"], kind="stable")
        n_full = pdf.whole // capacity
        rest = pdf.whole - n_full * capacity
        pieces = n_full + ((rest > 0) | (pdf.whole == 0))
        out = pdf.loc[pdf.index.repeat(pieces)].reset_index(drop=True)
        out["n_pieces"] = pieces.repeat(pieces).to_numpy()
        out["piece_no"] = out.groupby(["doc_id", pdf.index.repeat(pieces)]).cumcount()
        out["start"] = out.piece_no * capacity
        out["size"] = (out.whole - out.start).clip(upper=capacity)
        partial = np.flatnonzero((out["size"] > 0) & (out["size"] < capacity))
        bins = best_two_fit(out["size"].to_numpy()[partial].tolist(), capacity)
        bin_no = np.zeros(len(out), np.int64)
        for no, packed in enumerate(bins):
            bin_no[partial[packed]] = no
        full = (out["size"] == capacity).to_numpy()
        bin_no[full] = np.arange(len(bins), len(bins) + full.sum())
        out["bin_no"] = bin_no
        return out[[c.split()[0] for c in ASSIGNED.split(", ")]]

    # a shard's items are few bytes but much work: runtime merging by size must leave the groups apart
    key = ["container_name", "capacity", "shard"]
    packed = each.repartition(max(PARTITIONS, 4 * shards), *key).groupBy(*key).applyInPandas(run, ASSIGNED)
    return packed.select(
        "container_name", "capacity", F.format_string("%d-%d", "shard", "bin_no").alias("bin_id"), "doc_id", "piece_no", "n_pieces", "start", "size"
    )


def fill_report(assigned: DataFrame) -> DataFrame:
    """container_name, n_bins, n_pieces, used, share: how full the bins of each container are."""
    by_bin = assigned.groupBy("container_name", "capacity", "bin_id").agg(F.sum("size").alias("used"), F.count("*").alias("n"))
    return by_bin.groupBy("container_name").agg(
        F.count("*").alias("n_bins"),
        F.sum("n").alias("n_pieces"),
        F.sum("used").alias("used"),
        (F.sum("used") / F.sum("capacity")).alias("share"),
    )
