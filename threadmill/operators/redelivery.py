"""At-least-once delivery: exactly one copy of each message stays."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import rx
from ..functions.slang import quoted


def identifier(c: str | Column) -> Column:
    """Identifier without surrounding white space; a blank one is none."""
    bare = rx.strip(c)
    return F.when(bare != "", bare)


def keep_first(df: DataFrame, key: str, time: str, tie: str, columns: list[str] | None = None) -> DataFrame:
    """The first row of each key by time (NULL last), then by ``tie``; ``key`` comes back without surrounding white space.

    Rows without a key are left out. Equal rows in every respect: one of them. The rank filter of 1 runs in each map
    task before the shuffle (window group limit), so of a key that a third of all rows share one row per task is moved.
    """
    own = df.withColumn("__key", identifier(quoted(key))).where("__key IS NOT NULL")
    own = own.select("__key", F.col(quoted(time)).alias("__time"), F.col(quoted(tie)).alias("__tie"), *[quoted(c) for c in columns or df.columns if c != key])
    order = Window.partitionBy("__key").orderBy(F.col("__time").asc_nulls_last(), F.col("__tie").asc_nulls_last())
    own = own.withColumn("__rank", F.row_number().over(order)).where("__rank = 1")
    return own.withColumnRenamed("__key", key).drop("__rank", "__time", "__tie")


def surplus(df: DataFrame, key: str, time: str, tie: str) -> DataFrame:
    """``tie`` values (unique per delivery) of the rows that ``keep_first`` leaves out. The second shuffle goes by the
    unique delivery number, so no key is hot in it. An empty table gives an empty result."""
    own = df.where(identifier(quoted(key)).isNotNull()).select(F.col(quoted(tie)))
    kept = keep_first(df, key, time, tie, [tie])
    return own.join(kept.select(quoted(tie)), tie, "left_anti")


def new_messages(batch: DataFrame, stored: DataFrame, key: str, time: str, tie: str) -> DataFrame:
    """Of a new batch: one copy of each message whose identifier isn't stored yet (anti-join against ``stored[key]``).

    Stored identifiers are made distinct in the map tasks, so one that the store repeats is no hot key."""
    known = stored.select(identifier(quoted(key)).alias(key)).where(F.col(quoted(key)).isNotNull()).distinct()
    return keep_first(batch, key, time, tie).join(known, key, "left_anti")
