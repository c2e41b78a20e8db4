"""Queries over the test tables and, where SQL can say the same, the SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.durable import spread
from ..operators.redelivery import keep_first
from ..plans.queries import q, s_all, s_found, s_strip, s_sub
from . import abuse, bpe, conversations, formatdup, language, mix, pairs, pii

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def kept(spark: SparkSession, d: str) -> DataFrame:
    return keep_first(table(spark, d, "filter_me"), "message_id", "timestamp", "delivery_id", ["content"])


def records(spark: SparkSession, d: str) -> DataFrame:
    """``src, rec_id, text`` of the kept messages and the exported conversations."""
    own = kept(spark, d).select(F.lit("filter_me").alias("src"), F.col("message_id").alias("rec_id"), F.col("content").alias("text"))
    return own.unionByName(table(spark, d, "dump").select(F.lit("dump").alias("src"), F.col("row_id").cast("string").alias("rec_id"), "text"))


def all_pairs(spark: SparkSession, d: str) -> DataFrame:
    done, resampled = spread(table(spark, d, "done")), spread(table(spark, d, "resampled"))
    return pairs.pairs(done, "done").unionByName(pairs.pairs(resampled, "resampled"))


def documents(spark: SparkSession, d: str) -> DataFrame:
    return spread(table(spark, d, "documents"))


def p4_rates(spark: SparkSession, d: str) -> DataFrame:
    """Rates per source of dump, by the flags that p4_found gives: one model for all records."""
    flags = abuse.scores(records(spark, d), table(spark, d, "abuse_labels")).where("src = 'dump'")
    own = table(spark, d, "dump").select(F.col("row_id").cast("string").alias("rec_id"), "source")
    return abuse.rates(own.join(flags, "rec_id"))


def queries() -> dict[str, Query]:
    return {
        "p1_found": lambda s, d: pii.mentions(records(s, d), "text", "src", "rec_id"),
        "p1_redacted": lambda s, d: records(s, d).withColumn("text", pii.redact("text")),
        "p2_found": lambda s, d: conversations.conversations(table(s, d, "filter_me")),
        "p2_left_out": lambda s, d: conversations.left_out(table(s, d, "filter_me")),
        "p3_found": lambda s, d: pairs.found(all_pairs(s, d), table(s, d, "documents")),
        "p3_scores": lambda s, d: pairs.scored(all_pairs(s, d), table(s, d, "documents")),
        "p5_found": lambda s, d: formatdup.copies(table(s, d, "dump")),
        "p5_collapsed": lambda s, d: formatdup.collapsed(table(s, d, "dump")),
        "p8_ids": lambda s, d: documents(s, d).select("doc_id", bpe.encode("text").alias("ids")),
        "p4_found": lambda s, d: abuse.found(records(s, d), table(s, d, "abuse_labels")),
        "p4_passages": lambda s, d: abuse.passages(records(s, d), table(s, d, "abuse_labels")),
        "p4_scores": lambda s, d: abuse.scores(records(s, d), table(s, d, "abuse_labels")),
        "p4_rates": p4_rates,
        "p9_mix": lambda s, d: mix.mix(documents(s, d), table(s, d, "mix_targets")),
        "p9_shares": lambda s, d: mix.shares(documents(s, d), table(s, d, "mix_targets")),
        "p10_found": lambda s, d: language.found(documents(s, d)),
        "p10_languages": lambda s, d: language.languages(documents(s, d)),
        "p10_segments": lambda s, d: language.segments(documents(s, d)),
        "p8_decoded": lambda s, d: documents(s, d).select("doc_id", bpe.decoder()(bpe.encode("text")).alias("text")),
    }


def s_turns() -> str:
    """The turns of p2_found by recursion over the kept copies."""
    name, parent, author = (f"nullif({s_strip(c)}, '')" for c in ("message_id", "message_reference_message_id", "author_id"))
    return f"""WITH RECURSIVE ids AS (SELECT {name} AS id, {parent} AS parent, {author} AS author, content, "timestamp" AS ts, delivery_id FROM filter_me),
      ranked AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY ts ASC NULLS LAST, delivery_id) AS rn FROM ids WHERE id IS NOT NULL),
      kept AS (SELECT id, parent, author, ts, content IS NOT NULL AND NOT {s_found("content", conversations.BLANK)} AS solid FROM ranked WHERE rn = 1),
      tree AS (SELECT id, id AS root, 0 AS depth, ts AS sent, author AS top, 'user' AS role, solid FROM kept WHERE parent IS NULL
        UNION ALL SELECT k.id, t.root, t.depth + 1, CASE WHEN t.sent IS NULL OR k.ts > t.sent THEN coalesce(k.ts, t.sent) ELSE t.sent END, t.top,
          CASE WHEN k.author = t.top THEN 'user' ELSE 'assistant' END, k.solid FROM kept k JOIN tree t ON k.parent = t.id),
      turns AS (SELECT *, row_number() OVER (PARTITION BY root ORDER BY sent ASC NULLS FIRST, depth, try_cast(id AS HUGEINT) ASC NULLS LAST, id) AS n,
        count(*) FILTER (role = 'user') OVER (PARTITION BY root) AS users, count(*) OVER (PARTITION BY root) AS all_turns FROM tree WHERE solid)
      SELECT root AS conv_id, CAST(n AS INTEGER) AS turn_no, id AS message_id, role FROM turns WHERE users > 0 AND users < all_turns"""


def s_copies() -> str:
    """The pairs of p5_found: every value of every row cut up on its own, rows with equal tuples or equal letters joined by
    spreading the smallest id (more often than any chain of the tables is long)."""

    def letters(x: str) -> str:
        return s_sub(f"replace(translate(lower(upper({x})), 'ςẞ', 'σß'), 'ß', 'ss')", r"[^\p{L}\p{N}]+")

    solid = lambda x: s_found(x, formatdup.HAS_LETTER)
    field = lambda x, n: letters(f"regexp_extract({x}, {q(formatdup.FIELD)}, {n})")
    spread = "min(label) OVER (PARTITION BY {}) AS label"
    rounds = "".join(f", s{i + 1} AS (SELECT row_id, tuple, letters, {spread.format(('letters', 'tuple')[i % 2])} FROM s{i})" for i in range(8))
    return f"""WITH vals AS (SELECT row_id, text, list_concat([array_to_string({s_all("text", formatdup.TAG)}, '')], string_split_regex(text, {q(formatdup.TAG)})) AS v FROM dump WHERE text IS NOT NULL),
      own AS (SELECT row_id, text, unnest(v) AS value, unnest(range(len(v))) AS pos FROM vals WHERE len(list_filter(v[2:], lambda x: {solid("x")})) > 0),
      cuts AS (SELECT *, CASE WHEN {s_found("value", "[:=]")} THEN list_filter(string_split_regex(value, {q(formatdup.CUT)}), lambda x: {solid("x")}) ELSE [] END AS cut FROM own WHERE {solid("value")}),
      marked AS (SELECT *, array_to_string(list_transform(cut, lambda x: CASE WHEN {s_found("x", formatdup.FIELD)} THEN '1' ELSE '0' END), '') AS marks FROM cuts),
      placed AS (SELECT *, CASE WHEN {s_found("marks", "11$")} THEN length(regexp_extract(marks, '^(.*?)1+$', 1)) END AS head FROM marked),
      told AS (SELECT row_id, pos, CASE WHEN head IS NULL THEN {letters("value")} ELSE {letters("array_to_string(cut[1:head], '')")} || chr(1) ||
        array_to_string(list_sort(list_transform(cut[head + 1:], lambda x: {field("x", 1)} || '=' || {field("x", 2)})), chr(1)) END AS piece FROM placed),
      tuples AS (SELECT row_id, string_agg(CASE WHEN pos > 0 THEN 'x' ELSE 't' END || piece, chr(2) ORDER BY pos) AS tuple FROM told GROUP BY row_id),
      s0 AS (SELECT row_id, tuple, {letters("text")} AS letters, row_id AS label FROM tuples JOIN vals USING (row_id)){rounds}
      SELECT label AS keep_id, row_id FROM s8 WHERE label <> row_id"""


def oracle_sql() -> dict[str, str]:
    return {"p2_found": s_turns(), "p5_found": s_copies()}
