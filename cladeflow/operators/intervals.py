"""Points in intervals as an equality join: both are written as dyadic blocks.

An interval [low, low + size) is at most two blocks a level; a point lies in one block a level, and in
exactly one of the blocks of each interval that holds it. So no pair is met that is not a result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def interval_blocks(df: DataFrame, low: str, size: str) -> DataFrame:
    """df with level and block, one row per block of its interval; rows of size below 1 vanish."""
    keep = df.columns
    levels = df.where(f"{size} >= 1").selectExpr(*keep, f"explode(sequence(0, cast(floor(log2({size})) as int))) as level")
    bounds = levels.selectExpr(
        *keep, "level",
        f"shiftright({low} + shiftleft(1L, level) - 1, level) as _lo", f"shiftright({low} + {size}, level) as _hi",
    ).where("_lo < _hi")
    return bounds.selectExpr(
        *keep, "level", "explode(filter(array(if(_lo % 2 = 1, _lo, null), if(_hi % 2 = 1, _hi - 1, null)), b -> b is not null)) as block"
    )


def point_blocks(df: DataFrame, point: str, top: str) -> DataFrame:
    """df with level and block, one row a level up to that of the largest interval size `top`."""
    return df.selectExpr(*df.columns, f"explode(sequence(0, cast(floor(log2({top})) as int))) as level").selectExpr(
        *df.columns, "level", f"shiftright({point}, level) as block"
    )
