"""The cleaning stages on DataFrames: transform and reject, slang, resample, structural check, end tags, conversation dedup."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import chatml, predicates, rx, slang, text
from ..functions.slang import quoted
from .durable import Scratch


def need(df: DataFrame, *names: str) -> None:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"column not found: {', '.join(missing)}; there are: {', '.join(df.columns)}")


def pinned(df: DataFrame, **columns: Column) -> DataFrame:
    """``df`` with costly columns computed once.

    The optimiser copies an expression into every place that refers to its column, filters below included, which
    multiplies chains of regular expressions. It doesn't reach through a generator, so the columns come out of one.
    """
    rest = [quoted(c) for c in df.columns if c not in columns]
    new = F.inline(F.array(F.struct(*[v.alias(k) for k, v in columns.items()])))
    order = [quoted(c) for c in df.columns] + [quoted(c) for c in columns if c not in df.columns]
    return df.select(*rest, new).select(*order)


def trim_and_reject(df: DataFrame, col: str = "text", code_mode: str = "actual", tokens: Column | None = None, max_tokens: float | None = None) -> DataFrame:
    """Transformed rows with a nullable ``reason``; good rows have none. Rows whose text is NULL or becomes empty vanish."""
    need(df, col)
    own = pinned(df.where(F.col(quoted(col)).isNotNull()), **{col: text.transform_chain(quoted(col))}).where(F.col(quoted(col)) != "")
    own = pinned(own, __turns=chatml.turns(quoted(col)))
    why = predicates.reason(F.col(quoted(col)), F.col("__turns"), code_mode, tokens, max_tokens)
    return pinned(own, reason=why).drop("__turns")


def split_reason(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good without the reason column, bad with the reason in front)."""
    rest = [quoted(c) for c in df.columns if c != "reason"]
    return df.where("reason IS NULL").select(*rest), df.where("reason IS NOT NULL").select("reason", *rest)


def stage_counts(df: DataFrame, stages: Cleaned) -> DataFrame:
    """``stage, rows``: rows of the input and of each stage, one row a stage. Each stage is counted where it is, so nothing
    but counts is moved."""
    named = [("processed", df), *[(n, getattr(stages, n)) for n in ("good", "bad", "changes", "resampled", "done", "invalid")]]
    return reduce(DataFrame.unionByName, [d.agg(F.count("*").alias("rows")).select(F.lit(n).alias("stage"), "rows") for n, d in named])


def kept_counts(before: DataFrame, after: DataFrame) -> DataFrame:
    """``processed, kept, removed`` of an operator that leaves rows out."""
    all_ = before.agg(F.count("*").alias("processed"), F.lit(0).alias("kept"))
    both = all_.unionByName(after.agg(F.lit(0).alias("processed"), F.count("*").alias("kept")))
    return both.agg(*[F.sum(c).alias(c) for c in ("processed", "kept")]).withColumn("removed", F.col("processed") - F.col("kept"))


def reason_histogram(df: DataFrame) -> DataFrame:
    return df.groupBy("reason").agg(F.count("*").alias("n"))


def resample(df: DataFrame, col: str = "text", row_id: str = "row_id", n: int | None = None, seed: int | None = None, length: Column | None = None) -> DataFrame:
    """``text, tokens`` and the other columns, longest first; within a length by seeded hash of the row id, or by row id.

    Rows stay whole and the order is the same in every run. NULL texts are dropped. With ``n`` the plan is a top-k per
    partition and one merge, else a range sort."""
    need(df, col, row_id)
    tie = F.xxhash64(F.col(quoted(row_id)), F.lit(seed)) if seed is not None else F.col(quoted(row_id))
    own = df.where(F.col(quoted(col)).isNotNull()).drop("tokens")
    rest = [quoted(c) for c in own.columns if c != col]
    own = pinned(own, tokens=(length if length is not None else text.token_len(quoted(col))).cast("int")).select(quoted(col), "tokens", *rest)
    own = own.orderBy(F.col("tokens").desc(), tie, F.col(quoted(row_id)))
    return own.limit(n) if n is not None else own


def invalid_reason(c: Column) -> Column:
    """Why a conversation is structurally unsound, else NULL."""
    roles = rx.all_of(c, chatml.TURN, 1)
    first = F.get(roles, F.lit(0))
    other = F.when(first == "user", F.lit("assistant")).otherwise(F.lit("user"))
    checked = F.transform(roles, lambda r, i: F.struct(i.alias("i"), F.when(i % 2 == 0, first).otherwise(other).alias("want"), r.alias("got")))
    off = F.get(F.filter(checked, lambda x: x["want"] != x["got"]), F.lit(0))
    end = F.concat(F.lit(" — "), text.preview(c))
    return (
        F.when(~F.contains(c, F.lit(chatml.EOT)), F.concat(F.lit("missing <|end_of_text|>"), end))
        .when(F.size(roles) == 0, F.concat(F.lit("no valid chat turns found"), end))
        .when(off.isNotNull(), F.concat(F.lit("turn "), off["i"].cast("string"), F.lit(" expected "), off["want"], F.lit(", got "), off["got"], end))
        .when(~F.endswith(rx.strip(c), F.lit(chatml.EOT)), F.concat(F.lit("<|end_of_text|> not at end"), end))
    )


def validate(df: DataFrame, col: str = "text", row_id: str = "row_id") -> DataFrame:
    """Adds ``reason``: NULL if the end token closes the text and user and assistant take turns, else ``id: what — start``."""
    need(df, col, row_id)
    own = df.where(F.col(quoted(col)).isNotNull())
    why = invalid_reason(F.col(quoted(col)))
    return pinned(own, reason=F.concat(F.col(quoted(row_id)).cast("string"), F.lit(": "), why))


def fix_end(df: DataFrame, col: str = "text") -> DataFrame:
    need(df, col)
    return df.withColumn(col, text.fix_end(quoted(col)))


def dedupe_chats(df: DataFrame, col: str = "text", row_id: str = "row_id", mode: str = "actual", length: Column | None = None) -> DataFrame:
    """One row per final message (``actual``: the first by row id), or per chain before it (``documented``: the longest
    final message, then the first). Rows without a message are dropped.

    A row-number filter of 1 is cut down on the map side before the shuffle, so a final message that a third of all rows
    share arrives as one row per map task. The key is hashed: long messages aren't shuffled twice.
    """
    need(df, col, row_id)
    own = pinned(df, __m=chatml.messages(quoted(col))).where(F.size("__m") > 0)
    order = [F.col(quoted(row_id)).asc_nulls_last(), F.xxhash64(*[F.col(quoted(c)) for c in df.columns])]
    if mode == "actual":
        own = own.withColumn("__key", F.sha2(F.element_at("__m", -1), 256))
    elif mode == "documented":
        own = own.withColumn("__key", F.sha2(F.array_join(F.slice("__m", F.lit(1), F.size("__m") - 1), "\n"), 256))
        order.insert(0, (length if length is not None else text.token_len(F.element_at("__m", -1))).desc())
    else:
        raise ValueError(f"mode must be actual or documented, not {mode!r}")
    own = own.withColumn("__rank", F.row_number().over(Window.partitionBy("__key").orderBy(*order)))
    return own.where("__rank = 1").drop("__m", "__key", "__rank")


def new_chains(df: DataFrame, known: DataFrame, col: str = "text") -> DataFrame:
    """Rows whose chain hash isn't among ``known.hash``: the incremental form. Rows without a message are dropped."""
    own = pinned(df, __hash=chatml.chain_hash(quoted(col))).where("__hash IS NOT NULL")
    return own.join(known.select(F.col("hash").alias("__hash")).distinct(), "__hash", "left_anti").drop("__hash")


@dataclass
class Cleaned:
    good: DataFrame
    bad: DataFrame
    changes: DataFrame
    resampled: DataFrame
    done: DataFrame
    invalid: DataFrame


def four_stages(
    df: DataFrame, col: str = "text", row_id: str = "row_id", n: int | None = None, seed: int | None = 0, code_mode: str = "actual",
    length: Callable[[Column], Column] | None = None, max_tokens: float | None = None, scratch: Scratch | None = None,
) -> Cleaned:
    """All four stages as one lazy plan; every stage is a DataFrame of its own.

    ``length``: tokens of a text, by default words and punctuation marks (``tokens.tokenizer_len`` for a tokenizer file).
    With it, rows that it fails on are rejected as TOKEN_ERROR; with ``max_tokens`` longer ones as TOO_LONG. ``scratch``:
    the first stage, by far the costliest, is written there once for all stages that are read from it."""
    count = length or (text.token_len if max_tokens is not None else None)
    trimmed = trim_and_reject(df, col, code_mode, count(F.col(quoted(col))) if count else None, max_tokens)
    good, bad = split_reason(scratch.put(trimmed)[0] if scratch else trimmed)
    changes = slang.slang_changes(good, row_id)
    plain = pinned(good, **{c: slang.replace_slang(quoted(c)) for c in slang.string_columns(good)})
    resampled = resample(plain, col, row_id, n, seed, length(F.col(quoted(col))) if length else None)
    done, invalid = split_reason(validate(resampled, col, row_id))
    return Cleaned(good, bad, changes, resampled, done, invalid)
