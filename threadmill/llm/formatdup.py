"""Records that are equal but for formatting: one stays, with the number of its copies.

A record is a run of values: what lies between its tags, and the tags. Each distinct value is canonicalised once: cut into
a head and labelled fields, each reduced to its letters and digits, each distinct reduced piece an integer. A record
becomes a tuple of such integers in which the fields of a value are sorted, and records are grouped by these tuples.
Texts with the same letters can still differ in their tuples, because punctuation shows the fields of one and not of the
other; groups that share a text's letters are joined.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import rx
from ..functions.slang import quoted
from ..operators.clean import pinned
from ..operators.durable import Scratch

TAG = r"<\|(?i:im_start\|>\p{L}*|im_end\|>|end_of_text\|>)"
#: A label: up to four short words; then the sign and a value.
FIELD = rf"(?s)\A[{rx.SPACES}*_•·>~`-]*(\p{{L}}[\p{{L}}\p{{N}}]*(?:[{rx.SPACES}_]+[\p{{L}}\p{{N}}]+){{0,3}})[{rx.SPACES}*_`]*[:=][{rx.SPACES}*_`]*(.*[\p{{L}}\p{{N}}].*)\z"
#: What can stand between fields.
CUT = rf"[\r\n;|,]+|{rx.S}/{rx.S}"


def letters(c: Column) -> Column:
    """Letters and digits in order, case folded: upper before lower case, and the one letter whose capital is two."""
    folded = F.replace(F.translate(F.lower(F.upper(c)), "ςẞ", "σß"), F.lit("ß"), F.lit("ss"))
    return F.when(rx.found(c, r"[^\x00-\x7f]"), rx.sub(folded, r"[^\p{L}\p{N}]+")).otherwise(rx.sub(F.lower(c), "[^a-z0-9]+"))


HAS_LETTER = r"[\p{L}\p{N}]"


def values_of(text: Column) -> Column:
    """array<string>: all tags of a text run together, then what lies between them, as it is."""
    return F.concat(F.array(F.array_join(F.regexp_extract_all(text, F.lit(TAG), F.lit(0)), "")), F.split(text, TAG))


def code(c: Column) -> Column:
    return F.unhex(F.md5(c))


def canonical(values: DataFrame) -> DataFrame:
    """``code, pieces`` of each ``value``: array<struct<slot,value>>. Slot 0: letters in place; slot 1: a field, whose place
    doesn't matter.

    A value lists fields if from some piece on all pieces are labelled and there are two at least. Pieces without a letter
    or digit don't count. Label and content of a field are kept apart: the pair counts, not the run of letters.
    """
    listed = F.when(rx.found("value", "[:=]"), F.filter(F.split("value", CUT), lambda p: rx.found(p, HAS_LETTER))).otherwise(F.array())
    own = pinned(values, cut=listed)
    own = pinned(own, marks=F.array_join(F.transform("cut", lambda p: F.when(rx.found(p, FIELD), F.lit("1")).otherwise(F.lit("0"))), ""))
    first = F.when(rx.found("marks", "11$"), F.length(F.regexp_extract("marks", "^(.*?)1+$", 1)))
    own = pinned(own, first=first)
    pair = lambda p: F.concat(letters(F.regexp_extract(p, FIELD, 1)), F.lit("="), letters(F.regexp_extract(p, FIELD, 2)))
    head = F.when(F.col("first").isNull(), F.col("value")).otherwise(F.array_join(F.slice("cut", F.lit(1), F.col("first")), ""))
    fields = F.when(F.col("first").isNull(), F.array().cast("array<string>")).otherwise(F.slice("cut", F.col("first") + 1, F.size("cut")))
    slot = lambda n, v: F.struct(F.lit(n).alias("slot"), v.alias("value"))
    pieces = F.filter(F.concat(F.array(slot(0, letters(head))), F.transform(fields, lambda p: slot(1, pair(p)))), lambda x: x["value"] != "")
    return pinned(own.select(code(F.col("value")).alias("code"), "value", "cut", "first"), pieces=pieces).select("code", "pieces")


def encoded(own: DataFrame, scratch: Scratch) -> DataFrame:
    """``record, row_id, letters`` (digest of the text's letters), ``tuple`` (digest of its integers), written."""
    values = own.select(F.explode("values").alias("value")).where(rx.found("value", HAS_LETTER)).distinct()
    dictionary, _ = scratch.put(canonical(values))
    pieces = dictionary.select("code", F.posexplode("pieces").alias("n", "piece")).select("code", "n", "piece.*")
    numbers, _ = scratch.put(pieces.select("value").distinct().withColumn("id", F.monotonically_increasing_id()))
    # places only count outside fields
    told = pieces.join(numbers, "value").select("code", F.struct("slot", F.when(F.col("slot") == 0, F.col("n")).otherwise(F.lit(0)).alias("n"), "id").alias("piece"))
    rewritten, _ = scratch.put(told.groupBy("code").agg(F.array_sort(F.collect_list("piece")).alias("ids")))
    records, _ = scratch.put(own.select(
        F.monotonically_increasing_id().alias("record"), "row_id", code(letters(F.col("text"))).alias("letters"), F.transform("values", code).alias("codes")
    ))
    at = records.select("record", F.posexplode("codes").alias("at", "code")).join(rewritten, "code")
    # place among the values that count, so that an empty message more or less changes nothing
    tuples = at.groupBy("record").agg(F.array_sort(F.collect_list(F.struct((F.col("at") > 0).alias("in_text"), "at", "ids"))).alias("tuple"))
    tuples = tuples.select("record", code(F.to_json(F.transform("tuple", lambda t: F.struct(t["in_text"].alias("t"), t["ids"].alias("i"))))).alias("tuple"))
    return scratch.put(records.select("record", "row_id", "letters").join(tuples, "record"))[0]


def groups(df: DataFrame, row_id: str = "row_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(``row_id, key`` of every record that counts, ``key, keep_id, copies`` of every group).

    NULL texts and texts that have no letter or digit besides their tags are left out. Repeated row ids count as copies.
    A group of any size is reduced in the map tasks and never gathered. An empty table gives empty results.
    """
    scratch = Scratch(df.sparkSession, "formatdup")
    own = df.select(F.col(quoted(row_id)).alias("row_id"), F.col(quoted(text)).alias("text"))
    own = pinned(own.where("text IS NOT NULL"), values=values_of(F.col("text")))
    own = own.where(F.exists(F.slice("values", 2, 1 << 30), lambda v: rx.found(v, HAS_LETTER)))
    records = encoded(own, scratch)
    # groups of equal tuples, joined where they share a text's letters: the smallest label spreads until nothing changes
    links, _ = scratch.put(records.select("letters", "tuple").distinct())
    labels, _ = scratch.put(links.groupBy("tuple").agg(F.min("letters").alias("label")))
    while True:
        near = links.join(labels, "tuple").groupBy("letters").agg(F.min("label").alias("label"))
        new, _ = scratch.put(links.join(near, "letters").groupBy("tuple").agg(F.min("label").alias("new")).join(labels, "tuple").select("tuple", F.col("new").alias("label"), (F.col("new") != F.col("label")).alias("moved")))
        labels = new.select("tuple", "label")
        if new.where("moved").isEmpty():
            break
    keyed, _ = scratch.put(records.select("row_id", "tuple").join(labels, "tuple").select("row_id", F.col("label").alias("key")))
    sets = keyed.groupBy("key").agg(F.min("row_id").alias("keep_id"), F.count("*").alias("copies"))
    return keyed, sets


def copies(df: DataFrame, row_id: str = "row_id", text: str = "text") -> DataFrame:
    """``keep_id, row_id`` for every record but the first of its group."""
    keyed, sets = groups(df, row_id, text)
    return keyed.join(sets.where("copies > 1"), "key").where("row_id <> keep_id").select("keep_id", "row_id")


def collapsed(df: DataFrame, row_id: str = "row_id", text: str = "text") -> DataFrame:
    """``row_id, copies`` of the record that stays of each group, groups of one included."""
    return groups(df, row_id, text)[1].select(F.col("keep_id").alias("row_id"), "copies")
