"""Joins with a table of groups, some of which hold a large part of all rows."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Most groups that are sent to every executor, and the least size of such a group.
HOT_KEYS = 50_000
HOT_ROWS = 1_000


def attach(rows: DataFrame, groups: DataFrame, keys: list[str], size: str, hot_keys: int = HOT_KEYS, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Left join ``rows`` with ``groups`` (one row per key, ``size``: how many rows share it); null keys meet.

    Groups of more than ``hot_rows`` rows and more than a ``hot_keys``-th of
    all rows are sent to every executor, so their rows stay where they are;
    there are fewer than ``hot_keys`` of them, whatever the data. All others
    are shuffled, and no task gets more of one key than that bound. Both
    tables are read twice: have them written.
    """
    total, largest = groups.agg(F.sum(size), F.max(size)).first()
    bound = max(hot_rows, (total or 0) // hot_keys)
    side = groups.select(*[F.col(k).alias(f"_{k}") for k in keys], *[c for c in groups.columns if c not in keys])
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
    columns = [*rows.columns, *[c for c in groups.columns if c not in keys]]
    if (largest or 0) <= bound:
        return rows.join(side, same, "left").select(*columns)
    hot = F.broadcast(side.filter(F.col(size) > bound))
    cool = rows.join(hot, same, "left_anti").join(side.filter(F.col(size) <= bound), same, "left")
    return rows.join(hot, same).select(*columns).unionByName(cool.select(*columns))
