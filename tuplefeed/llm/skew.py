"""Joins of rows with one row per key, where some keys hold a large part of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key is hot when more than one in so many rows has it; so there are at most so many hot keys.
SHARE = 1000


def join_counted(rows: DataFrame, groups: DataFrame, keys: list[str], size: str, how: str = "inner") -> DataFrame:
    """``rows`` joined with ``groups``, which has one row per key and in ``size`` how many of the rows hold it.

    Hot keys are fewer than ``SHARE`` whatever the input, so their rows are broadcast; a key of the
    shuffled join holds at most one in ``SHARE`` rows. ``how`` is inner or left. Both sides should
    be written tables, since they are read twice. Keys are not null.
    """
    total = rows.count()
    is_hot = F.col(size) * SHARE > total
    hot = F.broadcast(groups.where(is_hot))
    of_hot = rows.join(hot, keys)
    rest = rows.join(F.broadcast(groups.where(is_hot).select(*keys)), keys, "left_anti")
    return of_hot.unionByName(rest.join(groups.where(~is_hot), keys, how))
