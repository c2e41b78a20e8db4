"""Whole-word slang expansion. An upper-case letter anywhere in the slang word gives a capitalised replacement."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import rx

# Slang and its replacement.
SLANG = {
    "2nite": "tonight",
    "kewl": "cool",
    "kool": "cool",
    "ttyl": "bye",
    "lawl": "lol",
    "yur": "youre",
    "cuz": "because",
    "thx": "thanks",
    "l8r": "later",
    "gr8": "great",
    "ur": "your",
    "b4": "before",
    "u": "you",
    "r": "are",
    "b": "be",
}


def replace_slang(c: str | Column, rules: dict[str, str] | None = None) -> Column:
    out = rx.col(c)
    for short, long in (rules or SLANG).items():
        whole = f"(?<!{rx.W}){rx.literal(short)}(?!{rx.W})"
        out = rx.sub(out, whole, long)
        out = rx.sub(out, f"(?iu){whole}", long.capitalize())
    return out


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def replace_slang_everywhere(df: DataFrame, rules: dict[str, str] | None = None) -> DataFrame:
    """Every string column, ids included. NULL stays NULL."""
    own = set(string_columns(df))
    return df.select(*[replace_slang(quoted(c), rules).alias(c) if c in own else F.col(quoted(c)) for c in df.columns])


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def slang_changes(df: DataFrame, row_id: str, rules: dict[str, str] | None = None) -> DataFrame:
    """(row, column, original, cleaned): a row for each cell that slang expansion changes. One scan, no shuffle."""
    own = [c for c in string_columns(df) if c != row_id]
    schema = "row string, column string, original string, cleaned string"
    if not own:
        return df.sparkSession.createDataFrame([], schema)
    cells = F.array(
        *[F.struct(F.lit(c).alias("column"), F.col(quoted(c)).alias("original"), replace_slang(quoted(c), rules).alias("cleaned")) for c in own]
    )
    long = df.select(F.col(quoted(row_id)).alias("row"), F.explode(cells).alias("cell")).select("row", "cell.*")
    return long.where(~F.col("original").eqNullSafe(F.col("cleaned")))
