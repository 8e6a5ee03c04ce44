"""Running sums and consecutive numbers over a whole table, without a global sort in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cladeflow.session import written


def running_before(df: DataFrame, order: list[str], value: str, name: str) -> DataFrame:
    """df with `name`: the sum of `value` over all rows before, in the order of the columns, which must be unique.

    Rows are range-partitioned, summed up within each partition and shifted by the totals of the
    partitions before; only those totals (one row a partition) pass through one task. The result is a
    written table. An empty df gives an empty one.
    """
    ranged = df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id())
    within = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    summed = written(ranged.withColumn("_sum", F.coalesce(F.sum(value).over(within), F.lit(0))), "running")
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    totals = summed.groupBy("_part").agg(F.sum(value).alias("_total"))
    shifts = totals.select("_part", F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_shift"))
    shifted = summed.join(F.broadcast(shifts), "_part")
    return shifted.select(*df.columns, (F.col("_shift") + F.col("_sum")).cast("long").alias(name))


def dense_ids(df: DataFrame, columns: list[str], id_name: str) -> DataFrame:
    """The distinct rows of `columns` (none null) with ids 0, 1, 2, ... in the columns' order.

    Rows with a null in any of the columns get no id. An empty input gives an empty table.
    """
    distinct = df.select(*columns).dropna().distinct().withColumn("_one", F.lit(1).cast("long"))
    return running_before(distinct, columns, "_one", id_name).drop("_one")


def ordinals(df: DataFrame, group: list[str], columns: list[str], name: str) -> DataFrame:
    """Like dense_ids over group + columns, but counted from 0 within each group, with n, the group's size."""
    ids = dense_ids(df, group + columns, "_id")
    first = ids.groupBy(*group).agg(F.min("_id").alias("_first"), F.count("*").alias("n"))
    return ids.join(first, group).select(*group, *columns, (F.col("_id") - F.col("_first")).alias(name), "n")
