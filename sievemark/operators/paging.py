"""Pages by key: rows after a cursor, in order, and the cursor of the next page."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

MOST = 100


def page(rows: DataFrame, key: str, cursor=None, limit: int = 20, descending: bool = False, **equal) -> DataFrame:
    """The next `limit` rows beyond the cursor, with next_cursor (null on the last page). One row more than the limit is read, which tells whether there are more."""
    if not 1 <= limit <= MOST:
        raise ValueError(f"limit has to lie between 1 and {MOST}")
    for column, value in equal.items():
        rows = rows.where(F.col(column).eqNullSafe(value))
    if cursor is not None:
        rows = rows.where(F.col(key) < cursor if descending else F.col(key) > cursor)
    order = F.col(key).desc() if descending else F.col(key).asc()
    found = rows.orderBy(order).limit(limit + 1).withColumn("_place", F.row_number().over(Window.orderBy(order)))
    whole = Window.partitionBy()
    last = F.max(F.when(F.col("_place") == limit, F.col(key))).over(whole)
    return found.withColumn("next_cursor", F.when(F.max("_place").over(whole) > limit, last)).where(F.col("_place") <= limit).drop("_place")


def series(run_ids: list[str]) -> list[str]:
    """The runs of a series in the caller's order; two to ten different ones."""
    if not 2 <= len(run_ids) <= 10 or len(set(run_ids)) != len(run_ids) or not all(0 < len(r) <= 128 for r in run_ids):
        raise ValueError("a series takes two to ten different runs")
    return run_ids
