"""Bounded windows over series of any length.

A window over a whole series puts that series into one task. That is fine for monthly
panels, where the calendar bounds a series, but not for a finer grain in which one series
may hold a third of all rows. ``on_blocks`` cuts every series into blocks of equal length
and lends each block the rows its frames reach into, so the result is the same and no
window partition exceeds ``block_rows`` plus the borrowed rows.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonalis.functions import fixed
from zonalis.operators.features import SERIES, add_window_features
from zonalis.operators.selection import running_start


def on_blocks(
    df: DataFrame,
    function: Callable[..., DataFrame],
    before: int,
    after: int = 0,
    block_rows: int = 50_000,
    keys: tuple[str, ...] = SERIES,
) -> DataFrame:
    """``function(df, keys=...)`` with frames of at most ``before`` and ``after`` rows.

    Rows get their place in the global (series, date) order from range partitions, which
    split a hot series by date.
    """
    if max(before, after) > block_rows:
        raise ValueError("a block must be at least as long as the frames reach")
    placed = running_start(df.withColumn("one", F.lit(1)), [*keys, "date"], "one", "place").drop("one")
    home = F.floor(F.col("place") / block_rows)
    offset = F.col("place") % block_rows
    lent = F.array_compact(
        F.array(
            F.col("home"),
            F.when(offset >= block_rows - before, F.col("home") + 1),
            F.when((offset < after) & (F.col("home") > 0), F.col("home") - 1),
        )
    )
    copied = placed.withColumn("home", home).withColumn("block", F.explode(lent))
    done = function(copied, keys=(*keys, "block"))
    return done.filter(F.col("home") == F.col("block")).drop("home", "block", "place")


def window_features(panel: DataFrame, block_rows: int = 50_000) -> DataFrame:
    """The feature windows block by block."""
    return on_blocks(panel, add_window_features, before=max(fixed.LAG_STEPS), block_rows=block_rows)
