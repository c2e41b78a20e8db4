"""Token lengths by a tokenizer file, for resampling and the length limits; ``text.token_len`` is the stand-in without one."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import rx


@lru_cache(maxsize=4)
def _load(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def tokenizer_len(c: str | Column, path: str, special: bool = True, longest: int | None = None) -> Column:
    """Number of tokens; with ``longest`` no more than that. NULL where the text is NULL or the tokenizer fails on it.
    ``path`` must be readable by all executors; it is loaded once per worker."""

    def one(text: str | None) -> int | None:
        try:
            n = None if text is None else len(_load(path).encode(text, add_special_tokens=special).ids)
        except Exception:  # noqa: BLE001
            return None
        return n if n is None or longest is None else min(n, longest)

    @F.pandas_udf(T.IntegerType())
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            yield pd.Series([one(t) for t in s], dtype="Int32")

    return count(rx.col(c))
