"""Queries over the test tables, one per operator, and the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import sources
from ..functions import chatml, predicates, rx, slang, text
from ..operators import clean, hierarchy, messages, redelivery, risk
from ..operators.durable import Scratch, spread

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def wide(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """For queries that spend far more time on a row than reading it takes."""
    return spread(table(spark, folder, name))


def scalar(f: Callable[[Column], Column], name: str = "dump", key: str = "row_id", col: str = "text", out: str = "result") -> Query:
    return lambda spark, d: wide(spark, d, name).select(key, f(F.col(col)).alias(out))


# ---- SQL pieces -------------------------------------------------------------------------------------------------------


def q(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


def s_sub(x: str, pattern: str, to: str = "") -> str:
    return f"regexp_replace({x}, {q(pattern)}, {q(to)}, 'g')"


def s_found(x: str, pattern: str) -> str:
    return f"regexp_matches({x}, {q(pattern)})"


def s_all(x: str, pattern: str, group: int = 0) -> str:
    return f"regexp_extract_all({x}, {q(pattern)}, {group})"


def s_strip(x: str) -> str:
    return s_sub(x, rx.STRIP)


def s_map(xs: str, f: Callable[[str], str], v: str = "v") -> str:
    return f"list_transform({xs}, lambda {v}: {f(v)})"


def s_keep(xs: str, f: Callable[[str], str], v: str = "w") -> str:
    return f"list_filter({xs}, lambda {v}: {f(v)})"


def s_any(xs: str, f: Callable[[str], str], v: str = "a") -> str:
    return f"(len(list_filter({xs}, lambda {v}: {f(v)})) > 0)"


def s_lines(x: str) -> str:
    return f"string_split_regex({s_strip(x)}, {q(rx.NL)})"


def s_solid(x: str) -> str:
    return s_keep(s_map(s_lines(x), s_strip, "sl"), lambda v: f"{v} <> ''", "sk")


S_ROLES = s_all("text", chatml.TURN, 1)
S_MSGS = s_map(s_all("text", chatml.TURN, 2), s_strip, "sm")
S_MESSAGES = s_map(s_all("text", chatml.MESSAGE, 1), s_strip, "sm")
S_EOT = f"suffix({s_strip('text')}, '{chatml.EOT}')"


def s_render(msgs: str, sep: str) -> str:
    return f"array_to_string(list_transform(list_zip({S_ROLES}, {msgs}), lambda z: '<|im_start|>' || z[1] || chr(10) || z[2] || '<|im_end|>'), {sep})"


def s_hash_angle() -> str:
    msgs = s_map(S_MSGS, lambda v: f"translate({s_sub(v, '(?m)^#+')}, '<>', '')", "ha")
    return (
        f"CASE WHEN text IS NULL THEN NULL WHEN text = '' THEN '' WHEN {S_EOT} THEN {s_render(msgs, 'chr(10)')} || '{chatml.EOT}' ELSE {s_render(msgs, q(''))} END"
    )


def s_has_word(x: str) -> str:
    stop = "[" + ", ".join(q(w) for w in text.STOP_WORDS) + "]"
    return s_any(s_all(f"lower({x})", f"{rx.W}+"), lambda v: f"NOT list_contains({stop}, {v})")


def s_slang(x: str) -> str:
    for short, long in slang.SLANG.items():
        for pattern, new in ((short, long), (f"(?i:{short})", long.capitalize())):
            for _ in range(2):  # neighbours share the character between them
                x = s_sub(x, f"(^|{rx.NOT_W}){pattern}($|{rx.NOT_W})", rf"\1{new}\2")
    return x


def s_tests() -> list[tuple[str, str]]:
    """Each reject predicate over ``text``, ``msgs`` and ``weird`` (messages of foreign script)."""

    def msgs(f: Callable[[str], str]) -> str:
        return s_any("msgs", f, "mm")

    def count(xs: str, f: Callable[[str], str], v: str) -> str:
        return f"len(list_filter({xs}, lambda {v}: {f(v)}))"

    bullet = predicates.BULLET_LINE
    plain = s_sub("text", chatml.STRUCTURAL)
    service = rf"(?i)(?:^|{rx.NOT_W})(?:{predicates.SERVICE_WORDS})(?:{rx.NOT_W}|$)"
    numbered = lambda v: (
        f"CASE WHEN {s_found(v, bullet)} THEN {s_found(f'regexp_replace({v}, {q(bullet)}, {q(chr(0)[:0])})', predicates.NUMBER_START)}"
        f" ELSE {s_found(v, rf'^{rx.S}*(?:[xX]{rx.S}*)?\p{{Nd}}+')} END"
    )
    return [
        ("CARD_TRADE", f"length({s_strip('text')}) >= 10 AND ({s_found(s_strip('text'), r'^\p{Nd}{13,16}')} OR {s_found(s_strip('text'), predicates.TRADE.replace('(?iu)', '(?i)'))})"),
        ("EMOJI_SPAM", s_found("text", f"{rx.EMOJI}{rx.S}*{rx.EMOJI}")),
        ("BULLETPOINT_LIST", msgs(lambda v: f"len({s_lines(v)}) > 2 AND {count(s_lines(v), lambda l: s_found(l, bullet), 'bl')} / len({s_lines(v)}) >= 0.5")),
        ("LF_HINT", s_found("text", rf"(?i)(?:^|{rx.NOT_W})LF\p{{Nd}}*(?:{rx.NOT_W}|$)")),
        ("FAKE_TOKEN", s_found(plain, "<[a-zA-Z0-9_]*>")),
        ("DOUBLE_DASH", s_found("text", f"[—–-]{rx.W}")),
        ("PERCENT_ENCODING", s_found("text", "%[0-9a-fA-F]{2}")),
        ("NONLATIN", "len(weird) > 0"),
        ("SINGLE_WORD_LINES", msgs(lambda v: f"len({s_solid(v)}) > 4 AND {count(s_solid(v), lambda l: f'len(regexp_extract_all({l}, {q(rx.NOT_S + chr(43))})) <= 2', 'wl')} >= 2")),
        ("SERVICE_AD", f"len({s_lines('text')}) >= 4 AND {count(s_lines('text'), lambda l: s_found(l, bullet), 'b1')} >= 2 AND {count(s_lines('text'), lambda l: s_found(l, service), 'b2')} >= 2 AND contains(lower(text), 'accepting') AND contains(lower(text), 'offering')"),
        ("MULTI_NEWLINES", msgs(lambda v: f"contains({v}, chr(10) || chr(10) || chr(10))")),
        ("DISCORD_TIMESTAMP", msgs(lambda v: s_found(v, r"<[tT]:\p{Nd}{10}:[a-zA-Z]>"))),
        ("DUPLICATE_LINES_ONLY", msgs(lambda v: f"len({s_solid(v)}) >= 2 AND len(list_distinct({s_solid(v)})) = 1")),
        ("NUMBERED_LINE_BLOCK", msgs(lambda v: f"len({s_solid(v)}) > 4 AND {count(s_solid(v), numbered, 'nl')} >= 2")),
        ("NUMERIC_ONLY_LINE", msgs(lambda v: s_any(s_solid(v), lambda l: s_found(l, rf"\A[{rx.DIGITS}]+\z"), "dl"))),
        ("NWORD", s_found(plain, f"(?i){predicates.SLUR}")),
        ("CP_REFERENCE", s_found(plain, rf"(?i)(?:^|{rx.NOT_W}){predicates.MINORS}(?:{rx.NOT_W}|$)")),
    ]


def s_with_messages(source: str) -> str:
    clean_msgs = s_map("msgs", lambda v: s_sub(v, chatml.STRUCTURAL), "cm")
    foreign = predicates.FOREIGN.replace(r"\p{Cn}\p{Cs}", "")
    weird = s_keep(clean_msgs, lambda v: f"length({v}) > 0 AND len(regexp_extract_all({v}, {q(foreign)})) / length({v}) >= 0.3", "wm")
    return f"WITH m AS (SELECT row_id, text, {S_MSGS} AS msgs FROM {source} WHERE text IS NOT NULL), w AS (SELECT row_id, text, msgs, {weird} AS weird FROM m)"


def s_reason(source: str = "dump") -> str:
    label = "CASE " + " ".join(f"WHEN {s_found('weird[1]', f'[{r}]')} THEN '{n.upper()}'" for r, n in predicates.SCRIPTS) + " ELSE 'OTHER' END"
    whens = " ".join(f"WHEN {t} THEN " + (f"'NONLATIN_SPAM_' || {label}" if n == "NONLATIN" else f"'{n}'") for n, t in s_tests())
    return f"{s_with_messages(source)} SELECT row_id, text, CASE {whens} END AS reason FROM w"


#: A message for each reject predicate. The tables hold few of them, so every second text (by length) gets one in front.
TRIGGERS = {
    "CARD_TRADE": "i have two cards, looking for a third", "EMOJI_SPAM": "\U0001f600 \U0001f680", "BULLETPOINT_LIST": "- tea\n- salt\n- rice",
    "LF_HINT": "LF3 players tonight", "FAKE_TOKEN": "see <that_token> here", "DOUBLE_DASH": "a well-known place", "PERCENT_ENCODING": "look at a%20b",
    "NONLATIN": "привет, как дела", "SINGLE_WORD_LINES": "one\ntwo\nthree\nfour\nfive", "SERVICE_AD": "- accepting orders\n- offering help\n- dm me\n- prices inside",
    "MULTI_NEWLINES": "up\n\n\ndown", "DISCORD_TIMESTAMP": "starts <t:1700000000:R>", "DUPLICATE_LINES_ONLY": "again\nagain", "NUMBERED_LINE_BLOCK": "1 a\n2 b\nx3 c\n4 d\ne",
    "NUMERIC_ONLY_LINE": "a\n42\nb", "NWORD": "the river Niger is long", "CP_REFERENCE": "a law against child pornography",
}


def _one_reason(label: str) -> Query:
    test = dict(predicates.ORDER)["NONLATIN_SPAM" if label == "NONLATIN" else label]
    front = f"<|im_start|>user\n{TRIGGERS[label]}<|im_end|>\n"

    def run(spark: SparkSession, d: str) -> DataFrame:
        df = wide(spark, d, "dump").where("text IS NOT NULL").withColumn("text", F.when(F.length("text") % 2 == 0, F.concat(F.lit(front), "text")).otherwise(F.col("text")))
        df = clean.pinned(df.select("row_id", "text"), turns=chatml.turns("text"))
        return df.select("row_id", test(F.col("text"), F.col("turns")).alias("result"))

    return run


def s_one_reason(label: str) -> str:
    front = f"<|im_start|>user\n{TRIGGERS[label]}<|im_end|>\n"
    source = f"(SELECT row_id, CASE WHEN length(text) % 2 = 0 THEN {q(front)} || text ELSE text END AS text FROM dump)"
    return f"{s_with_messages(source)} SELECT row_id, {dict(s_tests())[label]} AS result FROM w"


def s_chain(source: str, out: str = "text") -> str:
    """The first stage's transforms, one subquery each."""
    steps = [
        "replace(text, '||', '')", s_hash_angle(), s_sub("text", f"@{rx.NOT_S}+{rx.S}*"),
        s_sub(s_sub("replace(text, chr(129344), '')", r"(?m):[ \t]*$"), r"(?m)^[ \t]*[.,]+"), s_sub("text", rx.EMOJI),
        s_sub(s_sub(s_sub("text", rf"\.{rx.S}*,", ","), r",\.", "."), ",{2,}", ","), s_strip(s_sub(s_sub("text", " {2,}", " "), " ([.,!?;])", r"\1")),
    ]
    for i, step in enumerate(steps):
        source = f"(SELECT row_id, {step} AS {'text' if i + 1 < len(steps) else out} FROM {source})"
    return f"SELECT * FROM {source}"


def s_invalid(source: str) -> str:
    pre = f"SELECT row_id, text, {S_ROLES} AS roles FROM {source} WHERE text IS NOT NULL"
    want = "CASE WHEN (i - 1) % 2 = 0 THEN roles[1] WHEN roles[1] = 'user' THEN 'assistant' ELSE 'user' END"
    off = f"list_filter(list_transform(range(1, len(roles) + 1), lambda i: struct_pack(i := i - 1, want := {want}, got := roles[i])), lambda x: x.want <> x.got)"
    end = "' — ' || replace(left(text, 120), chr(10), ' ')"
    return (
        f"WITH t AS ({pre}), o AS (SELECT *, {off} AS off FROM t) SELECT row_id, row_id || ': ' || CASE "
        f"WHEN NOT contains(text, '{chatml.EOT}') THEN 'missing <|end_of_text|>' || {end} "
        f"WHEN len(roles) = 0 THEN 'no valid chat turns found' || {end} "
        f"WHEN len(off) > 0 THEN 'turn ' || off[1].i || ' expected ' || off[1].want || ', got ' || off[1].got || {end} "
        f"WHEN NOT {S_EOT} THEN '<|end_of_text|> not at end' || {end} END AS reason FROM o"
    )


def s_code_line(v: str) -> str:
    """Marks of code, or a word that opens a line of code."""
    words = "|".join(rx.literal(w) for w in predicates.CODE_WORDS)
    opening = s_found(f"{v} || ' '", rf"(?i)^{rx.S}*(?:{words}){rx.NOT_W}")
    return f"({s_found(v, r'[;{}=<>#\[\]()]')} OR {opening} OR {s_found(v, r'\+\+')})"


S_CLEANED = f"""
  SELECT CAST(message_id AS VARCHAR) AS message_id, message_reference_message_id, guild_id, channel_id, author_id,
    {s_sub("content", messages.NOISE)} AS content, "timestamp", delivery_id
  FROM filter_me WHERE author_bot IS NOT TRUE AND content IS NOT NULL AND content <> '' AND {s_has_word("content")}"""


def s_messages(documented: bool) -> str:
    more = f" AND NOT {s_found('content', messages.COMMAND)}" if documented else ""
    return f"""WITH c AS ({S_CLEANED}), r AS (SELECT *, row_number() OVER (PARTITION BY message_id ORDER BY "timestamp" ASC NULLS LAST, delivery_id) AS rn
      FROM c WHERE trim(content, ' ') <> ''{more})
      SELECT message_id, message_reference_message_id, guild_id, channel_id, author_id, content, epoch_us("timestamp") AS sent_us FROM r WHERE rn = 1 AND guild_id IS NOT NULL"""


S_KEPT = f"""ids AS (SELECT delivery_id, "timestamp" AS ts, nullif({s_strip("message_id")}, '') AS id, nullif({s_strip("message_reference_message_id")}, '') AS parent FROM filter_me),
  ranked AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY ts ASC NULLS LAST, delivery_id) AS rn FROM ids WHERE id IS NOT NULL),
  kept AS (SELECT id, parent FROM ranked WHERE rn = 1)"""
S_TREE = f"""WITH RECURSIVE {S_KEPT},
  roots AS (SELECT k.id FROM kept k LEFT JOIN kept p ON k.parent = p.id WHERE p.id IS NULL),
  tree AS (SELECT id, id AS root, 0 AS depth, id AS path FROM roots
    UNION ALL SELECT k.id, t.root, t.depth + 1, t.path || '/' || k.id FROM kept k JOIN tree t ON k.parent = t.id)"""

S_TRIMMED = s_reason(f"({s_chain('dump')} WHERE text <> '')")

# ---- queries ----------------------------------------------------------------------------------------------------------


def _trimmed(spark: SparkSession, d: str) -> DataFrame:
    return clean.trim_and_reject(wide(spark, d, "dump"))


def _reject_raw(spark: SparkSession, d: str) -> DataFrame:
    df = wide(spark, d, "dump").where("text IS NOT NULL").withColumn("turns", chatml.turns("text"))
    return df.select("row_id", predicates.reason(F.col("text"), F.col("turns")).alias("reason"))


def _nodes(spark: SparkSession, d: str) -> DataFrame:
    return hierarchy.nodes_of(table(spark, d, "filter_me"), "message_id", "message_reference_message_id", "timestamp", "delivery_id")


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return redelivery.surplus(table(spark, d, "filter_me"), "message_id", "timestamp", "delivery_id")


def p6_kept(spark: SparkSession, d: str) -> DataFrame:
    return redelivery.keep_first(table(spark, d, "filter_me"), "message_id", "timestamp", "delivery_id").select("message_id", "delivery_id", "batch_no")


def p6_new_batch(spark: SparkSession, d: str) -> DataFrame:
    df = table(spark, d, "filter_me")
    fresh = redelivery.new_messages(df.where("batch_no > 0"), df.where("batch_no = 0"), "message_id", "timestamp", "delivery_id")
    return fresh.select("message_id", "delivery_id")


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    found = hierarchy.resolve(_nodes(spark, d))
    return found.select(F.col("id").alias("message_id"), F.coalesce("root", F.lit("cycle")).alias("root_id"), "depth")


def p7_paths(spark: SparkSession, d: str) -> DataFrame:
    h = hierarchy.hierarchy(_nodes(spark, d))
    return h.select(F.col("id").alias("message_id"), F.coalesce("root", F.lit("cycle")).alias("root_id"), "depth", F.array_join("path", "/").alias("path"))


def p7_below(spark: SparkSession, d: str) -> DataFrame:
    return hierarchy.descendants(_nodes(spark, d)).select(F.col("id").alias("message_id"), F.col("below").alias("below_id"), "distance")


def _messages(spark: SparkSession, d: str, mode: str) -> DataFrame:
    """Times as microseconds: a number means the same in every engine and time zone."""
    df = messages.filter_messages(table(spark, d, "filter_me"), mode, "delivery_id")
    return df.withColumn("timestamp", F.unix_micros("timestamp")).withColumnRenamed("timestamp", "sent_us")


def resample_all(spark: SparkSession, d: str) -> DataFrame:
    return clean.resample(table(spark, d, "dump").select("row_id", "text")).select("row_id", "tokens")


def _four_stages(spark: SparkSession, d: str) -> tuple[DataFrame, clean.Cleaned]:
    df = wide(spark, d, "dump").select("row_id", "text", "source")
    return df, clean.four_stages(df)


def _stage_counts(spark: SparkSession, d: str) -> DataFrame:
    df = wide(spark, d, "dump").select("row_id", "text", "source")
    return clean.stage_counts(df, clean.four_stages(df, scratch=Scratch(spark, "stages")))


def _unique_counts(spark: SparkSession, d: str) -> DataFrame:
    return clean.kept_counts(table(spark, d, "dump"), clean.dedupe_chats(table(spark, d, "dump")))


def _message_counts(spark: SparkSession, d: str) -> DataFrame:
    df = table(spark, d, "filter_me")
    return clean.kept_counts(df, messages.filter_messages(df, tie="delivery_id"))


def _too_long(spark: SparkSession, d: str) -> DataFrame:
    df = wide(spark, d, "dump").select("row_id", "text")
    return clean.trim_and_reject(df, tokens=text.token_len("text"), max_tokens=LONGEST).select("row_id", "reason")


#: Tokens from which the query of long conversations rejects.
LONGEST = 60


def _csv_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """Conversations written as CSV in another dialect and read again: quotes, separators and line breaks inside fields."""
    path = f"{Scratch(spark, 'round-trip').root}/dump.csv"
    sources.write_csv(wide(spark, d, "dump").select("row_id", "text", "source"), path, sep=";", quote="'")
    return sources.read_csv(spark, path, sep=";", quote="'", drop_null="text")


def _shards_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """A folder of Parquet and CSV shards with different columns, read as one frame."""
    root = Scratch(spark, "shards").root
    df = table(spark, d, "done").withColumn("row_id", F.col("row_id").cast("string"))
    sources.write(df.select("row_id", "text"), f"{root}/a.parquet")
    sources.write(table(spark, d, "resampled").select("row_id", "source"), f"{root}/b.csv")
    sources.write(table(spark, d, "dump").select("row_id", "source"), f"{root}/c.csv")
    return sources.read_shards(spark, root).select("row_id", "text", "source")


def _counts(spark: SparkSession, d: str) -> DataFrame:
    df = clean.validate(table(spark, d, "resampled"))
    return df.agg(F.count("*").alias("total"), F.count_if(F.col("reason").isNull()).alias("valid"), F.count("reason").alias("invalid"))


def queries() -> dict[str, Query]:
    t = text
    return {
        "p6_found": p6_found,
        "p6_kept": p6_kept,
        "p6_new_batch": p6_new_batch,
        "p7_found": p7_found,
        "p7_paths": p7_paths,
        "p7_below": p7_below,
        "messages_filter": lambda s, d: _messages(s, d, "actual"),
        "messages_filter_documented": lambda s, d: _messages(s, d, "documented"),
        "messages_clean_content": scalar(messages.clean_content, "filter_me", "delivery_id", "content"),
        "messages_has_word": scalar(lambda c: t.has_word(c, t.STOP_WORDS), "filter_me", "delivery_id", "content"),
        "chat_turns": lambda s, d: wide(s, d, "dump").select("row_id", F.posexplode(chatml.turns("text"))).select("row_id", F.col("pos").alias("turn"), "col.role", "col.msg"),
        "chat_messages": lambda s, d: wide(s, d, "dump").select("row_id", F.posexplode(chatml.messages("text")).alias("n", "msg")),
        "chat_chain_hash": scalar(chatml.chain_hash),
        "chat_final_message": scalar(chatml.final_message),
        "chat_rebuild": scalar(lambda c: F.when(F.size(chatml.turns(c)) > 0, chatml.render(chatml.turns(c)))),
        "strip_double_pipe": scalar(t.strip_double_pipe),
        "strip_hash_and_angle": scalar(t.strip_hash_and_angle),
        "strip_at_mentions": scalar(t.strip_at_mentions, "filter_me", "delivery_id", "content"),
        "strip_flower_and_trailing_colon": scalar(t.strip_flower_and_trailing_colon, "filter_me", "delivery_id", "content"),
        "strip_emojis": scalar(t.strip_emojis, "filter_me", "delivery_id", "content"),
        "clean_commas_and_periods": scalar(t.clean_commas_and_periods),
        "normalize_spacing": scalar(t.normalize_spacing),
        "strip_structural_tags": scalar(chatml.strip_structural),
        "transform_chain": scalar(t.transform_chain),
        "fix_end": scalar(t.fix_end),
        "preview": scalar(t.preview),
        "slang": scalar(slang.replace_slang, "filter_me", "delivery_id", "content"),
        "slang_changes": lambda s, d: slang.slang_changes(wide(s, d, "filter_me").select("delivery_id", "content", "guild_id"), "delivery_id"),
        "slang_everywhere": lambda s, d: slang.replace_slang_everywhere(wide(s, d, "documents").select("doc_id", "text", "lang", "source")),
        "reject_reason": _reject_raw,
        "trim_and_reject": lambda s, d: _trimmed(s, d).select("row_id", "text", "reason"),
        "reason_histogram": lambda s, d: clean.reason_histogram(_trimmed(s, d)),
        "code_like_lines": scalar(predicates.count_code_like_lines, "filter_me", "delivery_id", "content"),
        "token_len": scalar(t.token_len, "documents", "doc_id"),
        "resample": resample_all,
        "resample_top": lambda s, d: clean.resample(table(s, d, "dump").select("row_id", "text"), n=200).select("row_id", "tokens"),
        "validate": lambda s, d: clean.validate(wide(s, d, "resampled")).select("row_id", "reason"),
        "validate_counts": _counts,
        "done": lambda s, d: clean.validate(wide(s, d, "resampled")).where("reason IS NULL").select("row_id", "text", "tokens", "source"),
        "dedupe_chats": lambda s, d: clean.dedupe_chats(table(s, d, "dump")).select("row_id"),
        "dedupe_chats_documented": lambda s, d: clean.dedupe_chats(table(s, d, "dump"), mode="documented").select("row_id"),
        "new_chains": lambda s, d: clean.new_chains(
            table(s, d, "resampled"), table(s, d, "done").select(chatml.chain_hash("text").alias("hash"))
        ).select("row_id"),
        "risk_normalize": scalar(risk.normalize_text, "filter_me", "delivery_id", "content"),
        "risk_pii": scalar(risk.has_pii, "filter_me", "delivery_id", "content"),
        "risk_drop": lambda s, d: risk.risk_filter(wide(s, d, "filter_me"), ["content"]).select("delivery_id"),
        "risk_redact": lambda s, d: risk.risk_filter(wide(s, d, "filter_me"), ["content"], "redact").select("delivery_id", "content"),
        "stages_done": lambda s, d: _four_stages(s, d)[1].done.select("row_id", "text", "tokens"),
        "stages_invalid": lambda s, d: _four_stages(s, d)[1].invalid.select("row_id", "reason"),
        "stage_counts": _stage_counts,
        "unique_counts": _unique_counts,
        "message_counts": _message_counts,
        "too_long": _too_long,
        "csv_round_trip": _csv_round_trip,
        "shards_round_trip": _shards_round_trip,
        **{f"reject_{label.lower()}": _one_reason(label) for label in TRIGGERS},
    }


def oracle_sql() -> dict[str, str]:
    def one(expr: str, name: str = "dump", key: str = "row_id") -> str:
        return f"SELECT {key}, {expr} AS result FROM {name}"

    def msg(expr: str) -> str:
        return one(expr, "filter_me", "delivery_id")

    stripped = s_sub(s_sub("text", " {2,}", " "), " ([.,!?;])", r"\1")
    tokens = f"len({s_all('text', text.TOKEN)})"
    good = f"WITH g AS (SELECT row_id, {s_slang('text')} AS text FROM ({S_TRIMMED}) WHERE reason IS NULL)"
    dedup = "ROW_NUMBER() OVER (PARTITION BY {k} ORDER BY {o})"
    with_m = f"WITH m AS (SELECT row_id, {S_MESSAGES} AS m FROM dump WHERE text IS NOT NULL), k AS (SELECT * FROM m WHERE len(m) > 0)"
    cell = lambda c: f"SELECT CAST(delivery_id AS VARCHAR) AS row, '{c}' AS column, {c} AS original, {s_slang(c)} AS cleaned FROM filter_me"
    return {
        "p6_found": f"WITH {S_KEPT} SELECT delivery_id FROM ranked WHERE rn > 1",
        "p6_kept": f"WITH {S_KEPT} SELECT id AS message_id, delivery_id, batch_no FROM ranked JOIN (SELECT delivery_id, batch_no FROM filter_me) USING (delivery_id) WHERE rn = 1",
        "p6_new_batch": f"""WITH {S_KEPT}, b AS (SELECT i.id, i.delivery_id, i.ts, f.batch_no FROM ids i JOIN filter_me f USING (delivery_id) WHERE i.id IS NOT NULL),
            n AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY ts ASC NULLS LAST, delivery_id) AS rn FROM b WHERE batch_no > 0)
            SELECT id AS message_id, delivery_id FROM n WHERE rn = 1 AND id NOT IN (SELECT id FROM b WHERE batch_no = 0)""",
        "p7_found": f"""{S_TREE} SELECT k.id AS message_id, coalesce(t.root, 'cycle') AS root_id, coalesce(t.depth, -1) AS depth
            FROM kept k LEFT JOIN tree t ON k.id = t.id WHERE t.depth IS NULL OR t.depth > 0""",
        "p7_paths": f"""{S_TREE} SELECT k.id AS message_id, coalesce(t.root, 'cycle') AS root_id, coalesce(t.depth, -1) AS depth, t.path
            FROM kept k LEFT JOIN tree t ON k.id = t.id""",
        "p7_below": f"""{S_TREE}, l AS (SELECT id, depth, string_split(path, '/') AS p FROM tree WHERE depth > 0)
            SELECT p[CAST(i AS BIGINT)] AS message_id, id AS below_id, CAST(depth - i + 1 AS INTEGER) AS distance FROM (SELECT *, unnest(range(1, depth + 1)) AS i FROM l)""",
        "messages_filter": s_messages(False),
        "messages_filter_documented": s_messages(True),
        "messages_clean_content": msg(s_sub("content", messages.NOISE)),
        "messages_has_word": msg(s_has_word("content")),
        "chat_turns": f"SELECT row_id, CAST(unnest(range(len(r))) AS INTEGER) AS turn, unnest(r) AS role, unnest(m) AS msg FROM (SELECT row_id, {S_ROLES} AS r, {S_MSGS} AS m FROM dump)",
        "chat_messages": f"SELECT row_id, CAST(unnest(range(len(m))) AS INTEGER) AS n, unnest(m) AS msg FROM (SELECT row_id, {S_MESSAGES} AS m FROM dump)",
        "chat_chain_hash": f"SELECT row_id, CASE WHEN len(m) > 0 THEN sha1(array_to_string(m, chr(10))) END AS result FROM (SELECT row_id, {S_MESSAGES} AS m FROM dump)",
        "chat_final_message": f"SELECT row_id, CASE WHEN len(m) > 0 THEN m[-1] END AS result FROM (SELECT row_id, {S_MESSAGES} AS m FROM dump)",
        "chat_rebuild": one(f"CASE WHEN len({S_ROLES}) > 0 THEN {s_render(S_MSGS, 'chr(10)')} || '{chatml.EOT}' END"),
        "strip_double_pipe": one("replace(text, '||', '')"),
        "strip_hash_and_angle": one(s_hash_angle()),
        "strip_at_mentions": msg(s_sub("content", f"@{rx.NOT_S}+{rx.S}*")),
        "strip_flower_and_trailing_colon": msg(s_sub(s_sub("replace(content, chr(129344), '')", r"(?m):[ \t]*$"), r"(?m)^[ \t]*[.,]+")),
        "strip_emojis": msg(s_sub("content", rx.EMOJI)),
        "clean_commas_and_periods": one(s_sub(s_sub(s_sub("text", rf"\.{rx.S}*,", ","), r",\.", "."), ",{2,}", ",")),
        "normalize_spacing": one(s_strip(stripped)),
        "strip_structural_tags": one(s_sub("text", chatml.STRUCTURAL)),
        "fix_end": one(s_sub("text", text.END_RUN, r"\1\2")),
        "preview": one("replace(left(text, 120), chr(10), ' ')"),
        "slang": msg(s_slang("content")),
        "slang_changes": f"SELECT * FROM ({cell('content')} UNION ALL {cell('guild_id')}) WHERE original IS DISTINCT FROM cleaned",
        "slang_everywhere": f"SELECT doc_id, {s_slang('text')} AS text, {s_slang('lang')} AS lang, {s_slang('source')} AS source FROM documents",
        "reject_reason": f"SELECT row_id, reason FROM ({s_reason()})",
        "transform_chain": s_chain("dump", "result"),
        "trim_and_reject": S_TRIMMED,
        "reason_histogram": f"SELECT reason, count(*) AS n FROM ({S_TRIMMED}) GROUP BY reason",
        "stages_done": f"{good} SELECT row_id, text, CAST({tokens} AS INTEGER) AS tokens FROM g JOIN ({s_invalid('g')}) USING (row_id) WHERE reason IS NULL",
        "stages_invalid": f"{good} SELECT row_id, reason FROM ({s_invalid('g')}) WHERE reason IS NOT NULL",
        "stage_counts": f"""{good}, v AS ({s_invalid('g')}), t AS ({S_TRIMMED}), c AS (SELECT CAST(row_id AS VARCHAR) AS id, 'text' AS k, text AS o, {s_slang('text')} AS n FROM t WHERE reason IS NULL
            UNION ALL SELECT CAST(t.row_id AS VARCHAR), 'source', d.source, {s_slang('d.source')} FROM t JOIN dump d ON t.row_id = d.row_id WHERE reason IS NULL)
            SELECT 'processed' AS stage, count(*) AS rows FROM dump UNION ALL SELECT 'good', count(*) FROM t WHERE reason IS NULL UNION ALL SELECT 'bad', count(reason) FROM t
            UNION ALL SELECT 'changes', count(*) FROM c WHERE o IS DISTINCT FROM n UNION ALL SELECT 'resampled', count(*) FROM g
            UNION ALL SELECT 'done', count(*) FROM v WHERE reason IS NULL UNION ALL SELECT 'invalid', count(reason) FROM v""",
        "unique_counts": f"WITH u AS (SELECT DISTINCT m[-1] FROM (SELECT {S_MESSAGES} AS m FROM dump WHERE text IS NOT NULL) WHERE len(m) > 0), n AS (SELECT (SELECT count(*) FROM dump) AS p, (SELECT count(*) FROM u) AS k) SELECT p AS processed, k AS kept, p - k AS removed FROM n",
        "message_counts": f"WITH n AS (SELECT (SELECT count(*) FROM filter_me) AS p, (SELECT count(*) FROM ({s_messages(False)})) AS k) SELECT p AS processed, k AS kept, p - k AS removed FROM n",
        "too_long": f"SELECT row_id, CASE WHEN reason IS NULL AND {tokens} > {LONGEST} THEN 'TOO_LONG' ELSE reason END AS reason FROM ({S_TRIMMED})",
        "csv_round_trip": "SELECT CAST(row_id AS VARCHAR) AS row_id, text, source FROM dump WHERE text IS NOT NULL",
        "shards_round_trip": """SELECT CAST(row_id AS VARCHAR) AS row_id, text, NULL AS source FROM done UNION ALL SELECT CAST(row_id AS VARCHAR), NULL, source FROM resampled
            UNION ALL SELECT CAST(row_id AS VARCHAR), NULL, source FROM dump""",
        "code_like_lines": msg(f"len({s_keep(s_lines('content'), s_code_line, 'cl')})"),
        **{f"reject_{label.lower()}": s_one_reason(label) for label in TRIGGERS},
        "token_len": one(tokens, "documents", "doc_id"),
        "resample": f"SELECT row_id, CAST({tokens} AS INTEGER) AS tokens FROM dump WHERE text IS NOT NULL",
        "resample_top": f"SELECT row_id, CAST({tokens} AS INTEGER) AS tokens FROM dump WHERE text IS NOT NULL ORDER BY 2 DESC, 1 LIMIT 200",
        "validate": s_invalid("resampled"),
        "validate_counts": f"SELECT count(*) AS total, count(*) - count(reason) AS valid, count(reason) AS invalid FROM ({s_invalid('resampled')})",
        "done": f"SELECT row_id, text, tokens, source FROM resampled JOIN ({s_invalid('resampled')}) USING (row_id) WHERE reason IS NULL",
        "dedupe_chats": f"{with_m}, r AS (SELECT row_id, {dedup.format(k='m[-1]', o='row_id')} AS rn FROM k) SELECT row_id FROM r WHERE rn = 1",
        "dedupe_chats_documented": f"{with_m}, r AS (SELECT row_id, {dedup.format(k='array_to_string(m[1:len(m)-1], chr(10))', o=f'len({s_all("m[-1]", text.TOKEN)}) DESC, row_id')} AS rn FROM k) SELECT row_id FROM r WHERE rn = 1",
        "new_chains": f"WITH r AS (SELECT row_id, {S_MESSAGES} AS m FROM resampled), k AS (SELECT {S_MESSAGES} AS m FROM done) SELECT row_id FROM r WHERE len(m) > 0 AND array_to_string(m, chr(10)) NOT IN (SELECT array_to_string(m, chr(10)) FROM k WHERE len(m) > 0)",
    }
