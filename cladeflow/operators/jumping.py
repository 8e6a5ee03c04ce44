"""Pointer jumping over linked lists and paths to a root, any number of them at once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cladeflow.session import Steps

Combine = Callable[[Column, Column], Column]


def summed(a: Column, b: Column) -> Column:
    return a + b


def first_known(a: Column, b: Column) -> Column:
    return F.coalesce(a, b)


def last_known(a: Column, b: Column) -> Column:
    return F.coalesce(b, a)


def along_paths(rows: DataFrame, key: list[str], ahead: list[str], values: dict[str, Combine]) -> DataFrame:
    """(key, values): each value combined over the rows from `key` along `ahead` to the end of its path.

    rows: one row per key; `ahead` names the columns of the next row's key (a column of both is the same all along a
    path), the last of them null at the end of a path. A round
    doubles the stretch that a row covers, so the number of rounds is the logarithm of the longest path. A row is
    written once it has reached the end, and only looked up from then on. Rows on a cycle or leading into one never
    reach an end and are left out: a round that brings no row to its end leaves only such rows, as a longer
    path would hold a row of every smaller distance. So are paths to a key that has no row.
    """
    spark, steps = rows.sparkSession, Steps(rows.sparkSession, "jumps")
    unended, turn, paths = F.col(ahead[-1]).isNotNull(), 0, []
    moving = [a for a in ahead if a not in key]
    state = rows.select(*key, *moving, *values)
    while True:
        written, seen = steps.measured(f"{turn}", state.withColumn("_turn", F.lit(turn)), left=F.count_if(unended), ended=F.count_if(~unended))
        paths.append(steps.held[f"{turn}"])
        every = spark.read.schema(written.schema).parquet(*paths)  # one scan for all rounds
        if not seen["left"] or not seen["ended"]:
            return every.where(~unended).select(*key, *values)
        latest = F.col("_turn") == turn
        further = [F.col(a).alias(f"_{a}") for a in moving] + [F.col(v).alias(f"_{v}") for v in values]
        target = every.where(~unended | latest).select(*(F.col(k).alias(a) for k, a in zip(key, ahead)), *further)
        jumped = written.where(unended).drop("_turn").join(target, ahead)
        state = jumped.select(*key, *(F.col(f"_{a}").alias(a) for a in moving), *(f(F.col(v), F.col(f"_{v}")).alias(v) for v, f in values.items()))
        turn += 1
