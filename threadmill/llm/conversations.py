"""Message rows to conversations along their references."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import rx
from ..operators import hierarchy, ranking
from ..operators.durable import Scratch
from ..operators.redelivery import identifier

BLANK = rf"\A[{rx.SPACES}\x{{200b}}-\x{{200d}}\x{{2060}}\x{{feff}}]*\z"


def solid(content: str | Column) -> Column:
    """Whether there is more than white space and zero-width spaces. NULL: false."""
    return F.coalesce(~rx.found(content, BLANK), F.lit(False))


def message_nodes(df: DataFrame, scratch: Scratch) -> DataFrame:
    own = df.select(
        "message_id",
        "message_reference_message_id",
        "timestamp",
        "delivery_id",
        F.unix_micros("timestamp").alias("sent"),
        identifier("author_id").alias("author"),
        solid("content").alias("solid"),
    )
    nodes = hierarchy.nodes_of(own, "message_id", "message_reference_message_id", "timestamp", "delivery_id", ["sent", "author", "solid"], scratch)
    return nodes.withColumn("is_top", F.col("parent").isNull())


SPEC = hierarchy.Spec(top=["author", "is_top"], peak=["sent"], keep=["author", "solid"])


def members(nodes: DataFrame, found: DataFrame) -> DataFrame:
    """``conv_id, message_id, depth, sent, role, solid`` of every message whose chain ends at one without reference.

    Pointer doubling carries the root's author down and the latest time along the chain up to the message, which is the
    time a message counts with. Chains that end at a missing message or in a circle are left out.
    """
    below = found.where("top_is_top")
    same = F.coalesce(F.col("author") == F.col("top_author"), F.lit(False))
    answers = below.select(
        F.col("root").alias("conv_id"),
        F.col("id").alias("message_id"),
        "depth",
        F.col("peak_sent").alias("sent"),
        F.when(same, F.lit("user")).otherwise(F.lit("assistant")).alias("role"),
        "solid",
    )
    tops = nodes.where("is_top").select(
        F.col("id").alias("conv_id"), F.col("id").alias("message_id"), F.lit(0).alias("depth"), "sent", F.lit("user").alias("role"), "solid"
    )
    return answers.unionByName(tops)


def conversations(df: DataFrame) -> DataFrame:
    """``conv_id, turn_no, message_id, role``: the turns of all conversations that have a turn of each role.

    ``df``: deliveries with the columns of the message table; only the kept copy of each message counts, rows without
    message id never do. Blank messages are no turns but hold their answers. Turns go by time (a NULL time of the root
    first), distance from the root, message id as a number, message id as text. Numbering works on stretches of a
    conversation, so one with a third of all rows needs no task of its own. An empty table gives an empty result.
    """
    scratch = Scratch(df.sparkSession, "conversations")
    nodes = message_nodes(df, scratch)
    turns = members(nodes, hierarchy.resolve(nodes, SPEC, scratch)).where("solid").withColumn("number", F.expr("try_cast(message_id AS decimal(38,0))"))
    order = [F.col("sent").asc_nulls_first(), F.col("depth").asc(), F.col("number").asc_nulls_last(), F.col("message_id").asc()]
    totals = {"has_user": F.max(F.col("role") == "user"), "has_assistant": F.max(F.col("role") == "assistant")}
    ranked = ranking.positions(turns, "conv_id", order, totals=totals, keep=F.col("has_user") & F.col("has_assistant"), scratch=scratch)
    return ranked.select("conv_id", F.col("position").cast("int").alias("turn_no"), "message_id", "role")


def left_out(df: DataFrame) -> DataFrame:
    """``cause, messages``: how many kept messages are in no conversation, by cause: ``circle``, ``missing`` (the chain
    ends at a message that isn't there), ``blank`` (part of a conversation, but no turn), ``one_sided`` (the
    conversation lacks a role)."""
    scratch = Scratch(df.sparkSession, "conversations")
    nodes = message_nodes(df, scratch)
    found = hierarchy.resolve(nodes, SPEC, scratch)
    lost = found.where("root IS NULL OR NOT top_is_top").select(F.when(F.col("root").isNull(), F.lit("circle")).otherwise(F.lit("missing")).alias("cause"))
    # Messages whose own reference is missing are roots to the hierarchy; they carry a reference all the same.
    heads = nodes.where("NOT is_top").join(found.select("id"), "id", "left_anti").select(F.lit("missing").alias("cause"))
    all_ = members(nodes, found)
    blank = all_.where("NOT solid").select(F.lit("blank").alias("cause"))
    sides = all_.where("solid").groupBy("conv_id").agg(F.count("*").alias("n"), F.count_if(F.col("role") == "user").alias("u"))
    one = sides.where("u = 0 OR u = n").agg(F.sum("n").alias("messages")).select(F.lit("one_sided").alias("cause"), F.coalesce("messages", F.lit(0)).alias("messages"))
    counted = lost.unionByName(heads).unionByName(blank).groupBy("cause").agg(F.count("*").alias("messages"))
    return counted.unionByName(one)
