"""Window features of long series in overlapping blocks of time.

A plain window puts a whole series into one task, so no more tasks work than
there are series. Here a series is cut into blocks of days; each block also
gets the last rows of the one before it, a halo as long as the widest frame, so
frames of a block are complete, and blocks of one series run side by side.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfspan.operators.joins import attach
from shelfspan.schemas import NEVER_SOLD_DAYS, SERIES

BLOCK = "_block"


def in_blocks(
    df: DataFrame, compute: Callable[[DataFrame, tuple[str, ...]], DataFrame], halo: int, days: int = 90, keys: Sequence[str] = SERIES, date: str = "date",
) -> DataFrame:
    """``compute(df, keys)`` by blocks of ``days`` days; it must not look further back than ``halo`` days.

    ``compute`` gets keys with the block behind them and uses them for all its
    windows. A row is copied once for each later block whose halo it is in, so
    blocks shorter than the halo work too.
    """
    if days < 1 or halo < 0:
        raise ValueError("blocks hold at least one day, halos none or more")
    day = F.unix_date(F.col(date).cast("date"))
    first, last = F.floor(day / days), F.floor((day + halo) / days)
    placed = df.withColumn("_home", first).withColumn(BLOCK, F.explode(F.sequence(F.col("_home"), last)))
    done = compute(placed, (*keys, BLOCK))
    return done.where(F.col(BLOCK) == F.col("_home")).drop("_home", BLOCK)


def add_last_sale(df: DataFrame, days: int = 90, keys: Sequence[str] = SERIES, target: str = "demand", date: str = "date") -> DataFrame:
    """Days since the last sale, with no bound on how far back it is.

    Inside a block a frame finds it; what lies before the block is the last
    sale of all earlier blocks, of which a series has one row a block.
    """
    placed = df.withColumn(BLOCK, F.floor(F.unix_date(F.col(date).cast("date")) / days))
    sold = F.when(F.col(target) > 0, F.col(date))
    ends = placed.groupBy(*keys, BLOCK).agg(F.max(sold).alias("_end"))
    before = Window.partitionBy(*keys).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(*keys, BLOCK, F.max("_end").over(before).alias("_carried"))
    joined = attach(placed, carried, [*keys, BLOCK])
    inside = Window.partitionBy(*keys, BLOCK).orderBy(date).rowsBetween(Window.unboundedPreceding, -1)
    latest = F.coalesce(F.max(sold).over(inside), F.col("_carried"))
    gap = F.coalesce(F.datediff(F.col(date), latest), F.lit(NEVER_SOLD_DAYS))
    return joined.withColumn("days_since_last_sale", gap).drop(BLOCK, "_carried")


def widest(*frames: Sequence[int], shift: int = 0) -> int:
    """The halo that lags and trailing frames of the given lengths need."""
    return max((n for frame in frames for n in frame), default=0) + shift
