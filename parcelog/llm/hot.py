"""Joins in which a few keys may hold much of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

#: A key is hot from one row in so many on, so there are at most so many hot keys, and they can be broadcast.
SHARE = 1000


def join_hot(left: DataFrame, right: DataFrame, key: str, total: int, how: str = "inner") -> DataFrame:
    """``left`` joined (inner or left) with ``right``, which has a row for each key and, in ``n``, how many rows of
    ``left`` bear it; ``total`` is the number of rows of ``left``. Rows of hot keys stay where they are, the others
    are dealt by key. Both tables are read twice. ``n`` is left out."""
    hot = F.col("n") * SHARE > total
    few = F.broadcast(right.filter(hot).drop("n"))  # SHARE rows at most
    near = left.join(few, key)
    far = left.join(few.select(key), key, "left_anti").join(right.filter(~hot).drop("n"), key, how)
    return near.unionByName(far.select(*near.columns))
