"""Command line: ``python -m threadmill.plans TOOL -p INPUT [-o OUTPUT]``."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from .. import sources
from ..functions import tokens
from ..operators import clean, messages, risk
from ..operators.durable import Scratch


def parse(argv: list[str] | None = None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="threadmill")
    p.add_argument("tool", choices=["filter", "clean", "risk", "unique", "end-tags"])
    p.add_argument("-p", "--path", required=True, help="file or directory of shards")
    p.add_argument("-o", "--out", default="", help="output; by default beside the input")
    p.add_argument("-tc", "--text-col", default="text")
    p.add_argument("--cols", nargs="*", help="columns for the risk filter")
    p.add_argument("--action", choices=["drop", "redact"], default="drop")
    p.add_argument("--mode", choices=["actual", "documented"], default="actual")
    p.add_argument("--delimiter", default=",")
    p.add_argument("--quotechar", default='"')
    p.add_argument("--target-size", type=int)
    p.add_argument("--seed", type=int, default=0)
    p.add_argument("--tokenizer", help="tokenizer file, readable by all executors; without one tokens are words and marks")
    p.add_argument("--max-tokens", type=float, help="longer conversations are rejected")
    p.add_argument("--code-mode", choices=["actual", "documented"], default="actual")
    p.add_argument("--tie", help="column that decides between deliveries of one time")
    return p.parse_args(argv)


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    a = parse(argv)
    spark = spark or SparkSession.builder.appName("threadmill").getOrCreate()
    dialect = {"sep": a.delimiter, "quote": a.quotechar}
    df = sources.read_shards(spark, a.path, **dialect)
    out = lambda ending: a.out or sources.output_path(a.path, ending)
    if a.tool == "end-tags":
        sources.write(clean.fix_end(df, a.text_col), out("_fixed"), **dialect)
    elif a.tool == "risk":
        sources.write(risk.risk_filter(df, a.cols, a.action), out("_safe"), **dialect)
    elif a.tool == "filter":
        sources.write(messages.filter_messages(df, a.mode, a.tie), out("_filtered"), **dialect)
    else:
        if "row_id" not in df.columns:
            df = df.withColumn("row_id", F.monotonically_increasing_id())
        if a.tool == "unique":
            sources.write(clean.dedupe_chats(df, a.text_col, mode=a.mode), out("_deduped"), **dialect)
        else:
            length = (lambda c: tokens.tokenizer_len(c, a.tokenizer)) if a.tokenizer else None
            done = clean.four_stages(df, a.text_col, n=a.target_size, seed=a.seed, code_mode=a.code_mode, length=length, max_tokens=a.max_tokens, scratch=Scratch(spark, "stages"))
            for name in ("good", "bad", "done"):
                sources.write(getattr(done, name), out(f"_{name}"), **dialect)
            for name in ("changes", "resampled", "invalid"):
                sources.write_if_any(getattr(done, name), out(f"_{name}"), **dialect)
            for r in clean.stage_counts(df, done).collect():  # one row a stage
                print(r["stage"], r["rows"])


if __name__ == "__main__":
    main()
