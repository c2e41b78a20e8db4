"""Raw messages: cleaning, filtering and one row per message id."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import rx, text
from ..functions.slang import quoted
from .clean import pinned

IDS = ["message_id", "message_reference_message_id", "guild_id", "channel_id", "author_id"]
#: What is cut out of a message. Mentions come longest form first, so leftmost-first equals leftmost-longest.
NOISE = (
    rf"^<@!?[0-9]+>{rx.S}*|<@!?[0-9]+>|<@&[0-9]+>|<#[0-9]+>|<a?:{rx.W}+:[0-9]+>|\{{[^}}]+\}}|https?://{rx.NOT_S}+|"
    rf"\[[^\]]+\]\([^)]+\)|^[.\-!,;:]+{rx.S}*{rx.W}*|```|\"|\\"
)
COMMAND = rf"^(?:[.\-]{{1,2}}|[!,:;]){rx.S}*{rx.W}+"


def clean_content(c: str | Column) -> Column:
    return rx.sub(c, NOISE)


def filter_messages(df: DataFrame, mode: str = "actual", tie: str | None = None) -> DataFrame:
    """Messages of people with something to say: content cleaned, one row per message id (earliest, NULL times last),
    then only rows with a guild.

    ``mode="documented"`` also drops commands, which the actual rule never does. ``tie``: column that decides equal times.
    The guild filter stays above the ranking: it must not change which copy survives.
    """
    own = df.where(~F.col("author_bot").eqNullSafe(True)) if "author_bot" in df.columns else df
    own = own.where(F.col("content").isNotNull() & (F.col("content") != "") & text.has_word("content", text.STOP_WORDS))
    extra = [F.col(quoted(tie)).alias("__tie")] if tie else []
    own = own.select(*[F.col(c).cast("string").alias(c) for c in IDS], "content", "timestamp", *extra)
    own = pinned(own, content=clean_content("content"))
    own = own.where(F.trim("content") != "")
    if mode == "documented":
        own = own.where(~rx.found("content", COMMAND))
    elif mode != "actual":
        raise ValueError(f"mode must be actual or documented, not {mode!r}")
    order = [F.col("timestamp").asc_nulls_last(), *([F.col("__tie")] if tie else []), F.col("content"), F.col("channel_id")]
    own = own.withColumn("__rank", F.row_number().over(Window.partitionBy("message_id").orderBy(*order)))
    return own.where("__rank = 1 AND guild_id IS NOT NULL").drop("__rank", "__tie")
