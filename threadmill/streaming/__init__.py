"""The row-wise operators run unchanged on a stream; these are the ones that need state."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import chatml, text
from ..operators.clean import pinned
from ..operators.messages import clean_content
from ..operators.redelivery import identifier


def first_deliveries(stream: DataFrame, key: str = "message_id", time: str = "timestamp", delay: str = "1 hour") -> DataFrame:
    """First arrival of each message within ``delay``; rows without a key are left out. State is bounded by the watermark."""
    own = stream.withColumn(key, identifier(key)).where(F.col(key).isNotNull())
    return own.withWatermark(time, delay).dropDuplicatesWithinWatermark([key])


def new_chains(stream: DataFrame, col: str, time: str, delay: str = "1 hour") -> DataFrame:
    own = stream.withColumn("chain_hash", chatml.chain_hash(col)).where("chain_hash IS NOT NULL")
    return own.withWatermark(time, delay).dropDuplicatesWithinWatermark(["chain_hash"])


def cleaned_messages(stream: DataFrame, delay: str = "1 hour") -> DataFrame:
    """The message filter on a stream: bots, empty contents and contents without a word out, content cleaned, one row per id
    within the delay."""
    own = stream.where(~F.col("author_bot").eqNullSafe(True) & F.col("content").isNotNull() & text.has_word("content", text.STOP_WORDS))
    own = pinned(own, content=clean_content("content"))
    own = first_deliveries(own.where(F.trim("content") != ""), delay=delay)
    return own.where(F.col("guild_id").isNotNull())


def message_rate(stream: DataFrame, window: str = "10 minutes", time: str = "timestamp", delay: str = "1 hour") -> DataFrame:
    """Messages per channel and tumbling window."""
    return stream.withWatermark(time, delay).groupBy(F.window(time, window), "channel_id").agg(F.count("*").alias("n"))
