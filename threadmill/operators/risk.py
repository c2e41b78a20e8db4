"""Risk filter: drop rows or redact cells that match the look-alike patterns."""

from __future__ import annotations

import unicodedata
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import fuzzy, rx
from ..functions.slang import quoted
from .clean import pinned

TEXT_COLUMNS = ["text", "content", "message"]
REDACTION = "[REDACTED]"
LEET = ("013457$@", "oieastsa")


@F.pandas_udf(T.StringType())
def _nfkc(s: pd.Series) -> pd.Series:
    return s.map(lambda x: unicodedata.normalize("NFKC", x), na_action="ignore")


def nfkc(c: Column) -> Column:
    """Compatibility form. Spark has no built-in for it; only texts beyond ASCII go through Python, in Arrow batches."""
    return F.coalesce(_nfkc(F.when(rx.found(c, r"[^\x00-\x7F]"), c)), c)


def normalize_text(c: str | Column, ascii_only: bool = False) -> Column:
    """Compatibility form, lower case, leet folded, white-space runs to one space; NULL becomes the empty text."""
    c = rx.col(c)
    out = F.translate(F.lower(c if ascii_only else nfkc(c)), *LEET)
    return F.coalesce(rx.sub(out, f"{rx.S}+", " "), F.lit(""))


def has_pii(c: str | Column) -> Column:
    """Contact data; the costly pattern only where there is what it needs."""
    return F.coalesce(rx.found(c, fuzzy.PII_NEEDS) & rx.found(c, fuzzy.PII), F.lit(False))


def has_terms(norm: Column, bare: Column) -> Column:
    """Any alternative of the whole pattern in the normalised text. ``bare``: the text without what only stands between
    letters. Look-alike patterns back-track much, so each group of terms is only tried on texts that have its letters in
    order; ``And`` leaves the right side out where the left is false."""
    found = (rx.found(bare, need) & rx.found(norm, pattern) for need, pattern in fuzzy.groups())
    pii = rx.found(norm, fuzzy.PII_NEEDS) & rx.found(norm, "(?iu)" + fuzzy.PII)
    return F.coalesce(reduce(lambda a, b: a | b, found) | pii, F.lit(False))


def bare(norm: Column) -> Column:
    return rx.sub(norm, fuzzy.ONLY_BETWEEN)


def matches_risk(c: str | Column, norm: Column | None = None, stripped: Column | None = None) -> Column:
    """Contact data in the text as it is, or any pattern in its normalised form. NULL: false."""
    c = rx.col(c)
    norm = norm if norm is not None else normalize_text(c)
    return has_pii(c) | (c.isNotNull() & has_terms(norm, stripped if stripped is not None else bare(norm)))


def redact(c: str | Column, norm: Column | None = None, token: str = REDACTION, stripped: Column | None = None) -> Column:
    """Contact data replaced; then, where the normalised text matches, all patterns replaced in the text that is not
    normalised, so a match that only normalising brings out stays. NULL stays NULL."""
    c = rx.col(c)
    norm = norm if norm is not None else normalize_text(c)
    text = F.when(rx.found(c, fuzzy.PII_NEEDS), rx.sub(c, fuzzy.PII, token)).otherwise(c)
    return F.when(has_terms(norm, stripped if stripped is not None else bare(norm)), rx.sub(text, fuzzy.union(), token)).otherwise(text)


def detect_text_columns(df: DataFrame, preferred: list[str] | None = None) -> list[str]:
    """Preferred names that exist, else the first string column, else the first column; none for a frame without columns."""
    names = [c for c in preferred or TEXT_COLUMNS if c in df.columns]
    strings = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return names or strings[:1] or df.columns[:1]


def risk_filter(df: DataFrame, cols: list[str] | None = None, action: str = "drop") -> DataFrame:
    """``drop``: rows without a match in any of the columns. ``redact``: all rows, matches replaced.

    Columns that don't exist are ignored; if none is left they are detected. Columns that aren't strings never match.
    A map-only plan: one scan, no shuffle.
    """
    if action not in ("drop", "redact"):
        raise ValueError(f"action must be drop or redact, not {action!r}")
    own = [c for c in cols or [] if c in df.columns] or detect_text_columns(df)
    strings = [f.name for f in df.schema.fields if f.name in own and isinstance(f.dataType, T.StringType)]
    if not strings:
        return df
    prefix = "__norm"
    while any(c.startswith(prefix) for c in df.columns):
        prefix += "_"
    columns, norms = df.columns, [f"{prefix}{i}" for i in range(len(strings))]
    wide = pinned(df, **{n: normalize_text(quoted(c)) for n, c in zip(norms, strings)})
    wide = pinned(wide, **{f"{n}_bare": bare(F.col(n)) for n in norms})
    if action == "drop":
        hit = reduce(lambda a, b: a | b, [matches_risk(quoted(c), F.col(n), F.col(f"{n}_bare")) for n, c in zip(norms, strings)])
        return wide.where(~hit).select(*[quoted(c) for c in columns])
    new = {c: redact(quoted(c), F.col(n), stripped=F.col(f"{n}_bare")) for n, c in zip(norms, strings)}
    return wide.select(*[new[c].alias(c) if c in new else F.col(quoted(c)) for c in columns])
