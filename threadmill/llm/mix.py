"""A training mix in which each source has its target share of the tokens.

Each text of a source gets an exponential key divided by its quality weight (weighted sampling without replacement by
sorted keys). A source's budget is spent in whole epochs first; the rest goes to the texts with the smallest keys, by
running sums of their sizes. Running sums are taken over stretches of a source, so a source with a third of all rows
needs no task of its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..operators import ranking
from ..operators.durable import Scratch
from . import bpe

SEED = 7


#: Listed sources up to which a table of them is broadcast.
BROADCAST = 10_000


def listed(table: DataFrame) -> DataFrame:
    """A table with one row per listed source: broadcast if its rows are as few as they should be."""
    return F.broadcast(table) if table.limit(BROADCAST + 1).count() <= BROADCAST else table


def quality(tokens: Column, text: Column) -> Column:
    """Weight of a text in (0, 1]: its share of letters, and less for very short texts."""
    letters = F.regexp_count(text, F.lit(r"\p{L}")) / F.greatest(F.length(text), F.lit(1))
    return F.greatest(letters * F.least(tokens / F.lit(32.0), F.lit(1.0)), F.lit(0.01))


def texts(documents: DataFrame, targets: DataFrame, scratch: Scratch) -> DataFrame:
    """``source, doc_id, tokens, key`` of one document per distinct text of a listed source, written.

    A text that several documents have, in one source or more, is one text: it belongs to the listed source of its
    smallest doc_id, so its repeats stay within one cap. Texts without tokens can't be drawn.
    """
    own = documents.select("doc_id", "source", "text").where(F.col("text").isNotNull() & (F.col("text") != ""))
    own = own.join(listed(targets.select("source").distinct()), "source")
    first = own.groupBy(F.sha2("text", 256).alias("digest")).agg(F.min("doc_id").alias("doc_id"))
    own = own.join(first, "doc_id", "left_semi").withColumn("tokens", bpe.counter()(F.col("text")).cast("bigint"))
    # of repeated ids one row, the same in every run
    own = own.groupBy("doc_id").agg(F.min(F.struct("source", "tokens", quality(F.col("tokens"), F.col("text")).alias("weight"))).alias("x"))
    own, _ = scratch.put(own.select("x.source", "doc_id", "x.tokens", "x.weight"))
    # a uniform number from the id: the same in every run, wherever the row is
    u = (F.shiftrightunsigned(F.xxhash64("doc_id", F.lit(SEED)), 11).cast("double") + 0.5) / F.lit(float(1 << 53))
    return own.where("tokens > 0").withColumn("key", -F.log(u) / F.col("weight"))


def budgets(own: DataFrame, targets: DataFrame, total_tokens: int | None) -> list[dict]:
    """Token budget of each listed source: one row per source reaches the driver.

    Shares are relative to the sources that have texts. Without ``total_tokens`` the mix is as large as the scarcest
    source allows at its cap; a larger total is cut to that size, since shares come before size.
    """
    sizes = {r["source"]: (r["tokens"], r["texts"]) for r in own.groupBy("source").agg(F.sum("tokens").alias("tokens"), F.count("*").alias("texts")).collect()}
    rows = targets.groupBy("source").agg(F.max("target_share").alias("share"), F.max("max_repeats").alias("cap")).where("source IS NOT NULL").collect()
    there = {r["source"]: r for r in rows if sizes.get(r["source"], (0, 0))[0] > 0 and (r["share"] or 0) > 0 and (r["cap"] or 0) > 0}
    norm = sum(r["share"] for r in there.values())
    most = min((sizes[s][0] * r["cap"] / (r["share"] / norm) for s, r in there.items()), default=0.0)
    total = min(most, float(total_tokens)) if total_tokens is not None else most
    out = []
    for r in rows:
        have, n = sizes.get(r["source"], (0, 0))
        budget = total * there[r["source"]]["share"] / norm if r["source"] in there else 0.0
        epochs = min(int(budget // have), r["cap"]) if have else 0
        rest = budget - epochs * have if epochs < (r["cap"] or 0) else 0.0
        out.append({"source": r["source"], "target_share": float(r["share"] or 0), "max_repeats": int(r["cap"] or 0), "available": int(have), "texts": int(n), "budget": float(budget), "epochs": int(epochs), "rest": float(rest)})
    return out


SCHEMA = "source string, target_share double, max_repeats int, available bigint, texts bigint, budget double, epochs int, rest double"


def mix(documents: DataFrame, targets: DataFrame, total_tokens: int | None = None) -> DataFrame:
    """``source, doc_id, tokens, uses``: how often each text is in the mix, 1 to the source's cap; texts not drawn are left out.

    A text is in the fractional part if its middle lies within what is left of the budget, so a source misses its budget
    by half a text at most. Sources that aren't listed, or are listed without texts, contribute nothing.
    """
    return _mix(documents, targets, total_tokens)[0]


def _mix(documents: DataFrame, targets: DataFrame, total_tokens: int | None) -> tuple[DataFrame, DataFrame]:
    spark = documents.sparkSession
    scratch = Scratch(spark, "mix")
    own = texts(documents, targets, scratch)
    plan = spark.createDataFrame(budgets(own, targets, total_tokens), SCHEMA)
    ranked = ranking.positions(own, "source", [F.col("key"), F.col("doc_id")], sums=["tokens"], scratch=scratch)
    ranked = ranked.join(listed(plan.select("source", "epochs", "rest")), "source")
    drawn = F.col("before_tokens") + F.col("tokens") / 2 <= F.col("rest")
    uses = F.col("epochs") + F.when(drawn & (F.col("rest") > 0), 1).otherwise(0)
    return ranked.select("source", "doc_id", "tokens", uses.cast("int").alias("uses")).where("uses > 0"), plan


def shares(documents: DataFrame, targets: DataFrame, total_tokens: int | None = None) -> DataFrame:
    """``source, target_share, actual_share, tokens, texts, most_uses, max_repeats``: a row per listed source."""
    drawn, plan = _mix(documents, targets, total_tokens)
    got = drawn.groupBy("source").agg(F.sum(F.col("tokens") * F.col("uses")).alias("tokens"), F.count("*").alias("texts"), F.max("uses").alias("most_uses"))
    got = plan.select("source", "target_share", "max_repeats").join(got, "source", "left").na.fill(0, ["tokens", "texts", "most_uses"])
    # a row per listed source: one partition holds them all
    out = got.withColumn("total", F.sum("tokens").over(Window.partitionBy(F.lit(1))))
    return out.select("source", "target_share", F.coalesce(F.try_divide("tokens", "total"), F.lit(0.0)).alias("actual_share"), "tokens", "texts", "most_uses", "max_repeats")
