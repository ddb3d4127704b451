"""Joins of many rows with one row per key, where one key may hold a third of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key with more than one ``HOT_SHARE``-th of all rows is hot, so there are fewer hot keys than this.
HOT_SHARE = 1000


def join_groups(rows: DataFrame, groups: DataFrame, key: str, count: str) -> DataFrame:
    """Inner join of ``rows`` with ``groups`` on ``key``; ``groups`` has one row per key and its number of rows.

    Hot keys (fewer than ``HOT_SHARE`` by their definition, whatever the input) go to the
    rows by broadcast, so their rows are not moved; the others are joined by an exchange in
    which no key has more than a small share.  Both inputs are read twice: pass written tables.
    Rows with a null key find no partner.
    """
    total = groups.agg(F.sum(count)).first()[0] or 0
    is_hot = F.col(count) * HOT_SHARE > F.lit(total)
    hot = F.broadcast(groups.filter(is_hot))
    by_broadcast = rows.join(hot, key)
    cold_rows = rows.join(hot.select(key), key, "left_anti")
    return by_broadcast.unionByName(cold_rows.join(groups.filter(~is_hot), key))
