"""Positions and prefix sums within groups of any size.

A plain window puts a whole group into one task. Here rows are range-partitioned by group and order, each partition
holds a stretch of a group, and what came before a stretch is added from a small table with one row per group and
partition. A group with a third of all rows is spread over a third of the partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .durable import Scratch


def stretches(df: DataFrame, group: str, order: list[Column], sums: list[str], totals: dict[str, Column], scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """``df`` with ``__part``, written; and one row per group and part with ``__before`` rows, ``__before_<sum>``, and the
    named aggregates over the whole group."""
    parted, _ = scratch.put(df.repartitionByRange(F.col(group), *order).withColumn("__part", F.spark_partition_id()))
    own = parted.groupBy(group, "__part").agg(
        F.count(F.lit(1)).alias("__n"), *[F.sum(c).alias(f"__sum_{c}") for c in sums], *[e.alias(f"__agg_{k}") for k, e in totals.items()]
    )
    whole = Window.partitionBy(group)
    earlier = whole.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    parts = own.select(
        group,
        "__part",
        F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__before"),
        *[F.coalesce(F.sum(f"__sum_{c}").over(earlier), F.lit(0)).alias(f"__before_{c}") for c in sums],
        F.sum("__n").over(whole).alias("group_rows"),
        *[F.sum(f"__sum_{c}").over(whole).alias(f"group_{c}") for c in sums],
        *[F.max(f"__agg_{k}").over(whole).alias(k) for k in totals],
    )
    return parted, parts


def positions(
    df: DataFrame,
    group: str,
    order: list[Column],
    sums: list[str] | None = None,
    totals: dict[str, Column] | None = None,
    keep: Column | None = None,
    scratch: Scratch | None = None,
) -> DataFrame:
    """Adds ``position`` (from 1), ``before_<c>`` (sum of ``c`` over the rows before) and group figures.

    ``order`` must be total. ``totals``: aggregates that are maxima (``max`` of a flag). ``keep``: condition over the
    group figures; groups that don't meet it are left out. Rows with a NULL group form a group. Empty in, empty out.
    """
    sums, totals = sums or [], totals or {}
    scratch = scratch or Scratch(df.sparkSession, "positions")
    parted, parts = stretches(df, group, order, sums, totals, scratch)
    if keep is not None:
        parts = parts.where(keep)
    local = Window.partitionBy(group, "__part").orderBy(*order)
    upto = local.rowsBetween(Window.unboundedPreceding, -1)
    ranked = parted.withColumns(
        {"__rank": F.row_number().over(local)} | {f"__local_{c}": F.coalesce(F.sum(c).over(upto), F.lit(0)) for c in sums}
    )
    parts = parts.withColumnsRenamed({group: "__group", "__part": "__at"})
    joined = ranked.join(parts, ranked[group].eqNullSafe(parts["__group"]) & (ranked["__part"] == parts["__at"]))
    out = joined.withColumns(
        {"position": F.col("__rank") + F.col("__before")} | {f"before_{c}": F.col(f"__local_{c}") + F.col(f"__before_{c}") for c in sums}
    )
    return out.drop(*[c for c in out.columns if c.startswith("__")])
