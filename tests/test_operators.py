"""Frame operators: filtering, dedup, validation, resampling, risk, redelivery, hierarchies, positions, sources, streams."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from threadmill import sources, streaming
from threadmill.functions import fuzzy, lexicon, rx, slang
from threadmill.operators import clean, hierarchy, messages, ranking, redelivery, risk

T0 = dt.datetime(2024, 1, 1)
MSG = "delivery_id long, message_id string, message_reference_message_id string, guild_id string, channel_id string, author_id string, content string, timestamp timestamp, author_bot boolean"


def msg(n, i, content="hello world", t=0, guild="g", bot=False, ref=None):
    return (n, i, ref, guild, "c", "a", content, None if t is None else T0 + dt.timedelta(seconds=t), bot)


def rows(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=str)


def test_filter_messages(spark):
    df = spark.createDataFrame(
        [
            msg(1, "m1", "<@!12>  !play hello", 5), msg(2, "m1", "later copy here", 9), msg(3, "m2", bot=True), msg(4, "m3", "the of and"),
            msg(5, "m4", '"{x}"'), msg(6, "m5", "no guild words", guild=None), msg(7, "m6", None), msg(8, "m7", "!play hello", None), msg(9, "m8", "see https://x.y [a](b) ok", bot=None),
        ],
        MSG,
    )
    out = rows(messages.filter_messages(df, tie="delivery_id"), "message_id", "content")
    assert out == [("m1", "!play hello"), ("m7", " hello"), ("m8", "see   ok")]
    assert [m for m, _ in rows(messages.filter_messages(df, "documented", "delivery_id"), "message_id", "content")] == ["m1", "m7", "m8"]
    assert messages.filter_messages(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        messages.filter_messages(df, "other")


def chat(*m, end=True):
    return "\n".join(f"<|im_start|>{r}\n{x}<|im_end|>" for r, x in m) + ("<|end_of_text|>" if end else "")


def test_dedupe(spark):
    a, b, c = chat(("user", "q"), ("assistant", "same")), chat(("user", "other"), ("assistant", "same")), chat(("user", "q"), ("assistant", "same but longer"))
    df = spark.createDataFrame([(3, a), (1, b), (2, c), (4, None), (5, "no message"), (6, a)], "row_id long, text string")
    assert rows(clean.dedupe_chats(df), "row_id") == [(1,), (2,)]
    assert rows(clean.dedupe_chats(df, mode="documented"), "row_id") == [(1,), (2,)]
    assert clean.dedupe_chats(df.limit(0)).count() == 0
    known = spark.createDataFrame([("x",)], "hash string")
    assert clean.new_chains(df, known).count() == 4


def test_validate(spark):
    good = chat(("user", "q"), ("assistant", "a"))
    cases = [good, chat(("user", "q"), end=False), "x<|end_of_text|>", chat(("user", "q"), ("user", "a")), good + " tail", None]
    df = spark.createDataFrame(list(enumerate(cases)), "row_id long, text string")
    got = {r["row_id"]: r["reason"] for r in clean.validate(df).collect()}
    assert got[0] is None and got[1].startswith("1: missing <|end_of_text|> — ") and "no valid chat turns" in got[2]
    assert "turn 1 expected assistant, got user" in got[3] and "not at end" in got[4] and 5 not in got


def test_resample_and_split(spark):
    df = spark.createDataFrame([(1, "a b", "x"), (2, "a b c", "y"), (3, None, "z"), (4, "d e", "w")], "row_id long, text string, extra string")
    out = clean.resample(df)
    assert out.columns == ["text", "tokens", "row_id", "extra"] and [r["row_id"] for r in out.collect()] == [2, 1, 4]
    assert [r["extra"] for r in clean.resample(df, n=1).collect()] == ["y"]
    assert sorted(r["row_id"] for r in clean.resample(df, seed=1).collect()) == [1, 2, 4]
    with pytest.raises(ValueError):
        clean.resample(df, "nothing")


def test_four_stages(spark):
    ok = chat(("user", "hello there friend"), ("assistant", "u r fine"))
    df = spark.createDataFrame([(1, ok), (2, chat(("user", "well-known"), ("assistant", "x"))), (3, "gone"), (4, None)], "row_id long, text string")
    c = clean.four_stages(df)
    assert rows(c.good, "row_id") == [(1,)] and rows(c.bad, "row_id", "reason") == [(2, "DOUBLE_DASH")]
    assert rows(c.changes, "row", "column") == [(1, "text")] and "you are fine" in c.done.collect()[0]["text"] and c.invalid.count() == 0


def test_slang_leaves_other_types(spark):
    df = spark.createDataFrame([(1, "u", None, 2.0)], "row_id long, a string, `b c` string, d double")
    assert slang.replace_slang_everywhere(df).collect()[0]["a"] == "you"
    assert rows(slang.slang_changes(df, "row_id"), "row", "column", "original", "cleaned") == [(1, "a", "u", "you")]


def test_risk(spark):
    df = spark.createDataFrame([(1, "mail me: a.b@c.de"), (2, "HITLER"), (3, "h1tler here"), (4, "plain words"), (5, None), (6, "kill")], "i long, text string")
    assert rows(risk.risk_filter(df, ["text"]), "i") == [(4,), (5,), (6,)]
    red = dict(rows(risk.risk_filter(df.where("i < 5"), action="redact"), "i", "text"))
    assert red[1] == "mail me: [REDACTED]" and red[2] == "[REDACTED]" and red[4] == "plain words"
    assert risk.risk_filter(df.limit(0)).count() == 0
    assert risk.detect_text_columns(df) == ["text"] and risk.detect_text_columns(df.select("i")) == ["i"]
    with pytest.raises(ValueError):
        risk.risk_filter(df, action="x")


def test_fuzzy_word(spark):
    df = spark.createDataFrame([("b-o-t n e t", True), ("bbbotnnnet", True), ("b....otnet", False), ("bot", False)], "t string, want boolean")
    got = df.select("want", F.col("t").rlike("(?iu)" + fuzzy.fuzzy_any(["botnet"])).alias("got")).collect()
    assert all(r["want"] == r["got"] for r in got)
    # the possessive repetition: a class that holds the next letter eats it
    assert spark.range(1).select(F.lit("kill").rlike("(?iu)" + fuzzy.fuzzy_any(["kill"]))).collect()[0][0] is False


def test_normalize_text(spark):
    df = spark.createDataFrame([("Ｈ3LLO  x",), (None,)], "t string")
    assert [r[0] for r in df.select(risk.normalize_text("t")).collect()] == ["hello x", ""]


def test_redelivery(spark):
    df = spark.createDataFrame([msg(1, " m ", t=5), msg(2, "m", t=5), msg(3, "m", t=None), msg(4, None), msg(5, " "), msg(6, "n", t=None), msg(7, "m", t=1)], MSG)
    assert rows(redelivery.surplus(df, "message_id", "timestamp", "delivery_id"), "delivery_id") == [(1,), (2,), (3,)]
    assert rows(redelivery.keep_first(df, "message_id", "timestamp", "delivery_id"), "message_id", "delivery_id") == [("m", 7), ("n", 6)]
    fresh = redelivery.new_messages(df, df.where("delivery_id = 6"), "message_id", "timestamp", "delivery_id")
    assert rows(fresh, "message_id") == [("m",)]
    assert redelivery.surplus(df.limit(0), "message_id", "timestamp", "delivery_id").count() == 0


def test_hierarchy_against_walking(spark):
    rng = random.Random(5)
    parent = {f"n{i}": (f"n{rng.randrange(max(0, i - 3), i)}" if i and rng.random() < 0.9 else rng.choice([None, "missing"])) for i in range(300)}
    parent |= {"c1": "c2", "c2": "c3", "c3": "c1", "d": "c1", "self": "self"}
    want = {}
    for n in parent:
        path, at = [n], parent[n]
        while at in parent and at not in path:
            path.append(at)
            at = parent[at]
        if at in parent:
            want[n] = (None, -1, None)
        else:
            want[n] = (path[-1], len(path) - 1, path[::-1])
    nodes = spark.createDataFrame(list(parent.items()), "id string, parent string")
    got = {r["id"]: (r["root"], r["depth"], r["path"]) for r in hierarchy.hierarchy(nodes).collect()}
    assert got == want
    below = {(r["id"], r["below"], r["distance"]) for r in hierarchy.descendants(nodes).collect()}
    assert below == {(p[2][i], n, p[1] - i) for n, p in want.items() if p[2] for i in range(p[1])}
    assert hierarchy.resolve(nodes.limit(0)).count() == 0
    assert hierarchy.resolve(nodes.where("parent IS NULL")).count() == 0


def test_long_chain_and_hot_parent(spark):
    nodes = spark.createDataFrame([("0", None)] + [(str(i), str(i - 1)) for i in range(1, 700)] + [(f"w{i}", "3") for i in range(2000)], "id string, parent string")
    r = hierarchy.resolve(nodes)
    assert r.agg(F.max("depth")).collect()[0][0] == 699 and r.where("root <> '0'").count() == 0 and r.count() == 2699


def test_positions(spark):
    data = [("g" if i % 3 else f"s{i}", i, i % 5) for i in range(400)]
    df = spark.createDataFrame(data, "g string, o long, n long")
    got = ranking.positions(df, "g", [F.col("o")], sums=["n"], totals={"top": F.max("o")}).collect()
    assert len(got) == 400
    for r in got:
        before = [x for x in data if x[0] == r["g"] and x[1] < r["o"]]
        assert r["position"] == len(before) + 1 and r["before_n"] == sum(x[2] for x in before)
    assert ranking.positions(df.limit(0), "g", [F.col("o")]).count() == 0


def test_sources(spark, tmp_path):
    df = spark.createDataFrame([(1, 'a "q",\nline', None), (2, "b", "x")], "row_id long, text string, more string")
    sources.write(df.select("row_id", "text"), f"{tmp_path}/d/a.csv")
    sources.write(df, f"{tmp_path}/d/b.parquet")
    back = sources.read_shards(spark, f"{tmp_path}/d")
    assert rows(back.select(F.col("row_id").cast("long").alias("row_id"), "text"), "row_id", "text") == sorted([(1, 'a "q",\nline'), (2, "b")] * 2)
    with pytest.raises(ValueError):
        sources.write(df, f"{tmp_path}/x.txt")
    with pytest.raises(FileNotFoundError):
        sources.read_shards(spark, f"{tmp_path}/none")
    assert sources.write_if_any(df.limit(0), f"{tmp_path}/e.csv") is False
    assert sources.output_path("a/b.csv", "_fixed") == "a/b_fixed.csv"


def test_command_line(spark, tmp_path):
    from threadmill.plans.__main__ import main

    sources.write(spark.createDataFrame([("a , <|im_end|>",)], "text string"), f"{tmp_path}/in.csv")
    main(["end-tags", "-p", f"{tmp_path}/in.csv", "-o", f"{tmp_path}/out.csv"], spark)
    assert sources.read_csv(spark, f"{tmp_path}/out.csv").collect()[0]["text"] == "a<|im_end|>"


def test_stream(spark, tmp_path):
    spark.createDataFrame([msg(1, "m", t=1), msg(2, "m", t=2), msg(3, "n", t=3, guild=None), msg(4, "o", bot=True)], MSG).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(MSG).parquet(f"{tmp_path}/in")
    q = streaming.cleaned_messages(stream).writeStream.format("memory").queryName("cleaned").trigger(availableNow=True).start()
    q.awaitTermination(60)
    assert [r["message_id"] for r in spark.table("cleaned").collect()] == ["m"]


# ---- risk filter --------------------------------------------------------------------------------------------------------


def spoiled(rng, word):
    """A term under look-alikes, repetitions and characters in between."""
    out = ""
    for c in word:
        forms = lexicon.LOOKALIKES.get(c, c)
        for _ in range(rng.choice([1, 1, 1, 1, 2, 3])):
            out += rng.choice(forms) if rng.random() < 0.3 else c
            out += "".join(rng.choice(" .-_!|*+°") for _ in range(rng.choice([0, 0, 0, 0, 1, 2, 3, 4])))
    return out


def risky_texts(n, seed=5):
    rng = random.Random(seed)
    terms = [w for _, lists in lexicon.LEXICON for words in lists for w in words] + lexicon.TWO_LETTER_PHRASES
    other = ["hello", "the lamp", "555-123-4567", "a@b.com", "1.2.3.4", "here's his address", "0x" + "ab" * 20, "2021-2022", "ſ K ı", "é"]
    texts = []
    for _ in range(n):
        parts = []
        for _ in range(rng.randint(1, 4)):
            kind = rng.random()
            if kind < 0.4:
                parts.append(spoiled(rng, rng.choice(terms)))
            elif kind < 0.7:
                parts.append("".join(rng.choice("abcdeilkmnoprstuxyz !|10$@.-7é") for _ in range(rng.randint(1, 14))))
            else:
                parts.append(rng.choice(other))
        texts.append(" ".join(parts))
    return texts


def restated():
    """The terms as one pattern of another engine, from the description: each letter stands for its look-alikes, may be
    repeated possessively a hundred times with up to three other characters before each, and up to three may follow."""
    import re

    between = r"[\W_]{0,3}"

    def letter(c):
        forms = "".join(dict.fromkeys(lexicon.LOOKALIKES.get(c, c)))
        one = "[" + "".join(map(re.escape, forms)) + "]" if len(forms) > 1 else re.escape(forms)
        return f"{one}(?:{between}?{one}){{0,100}}+"

    def term(words):
        return between.join(letter(c) for w in words.split() for c in w)

    wanted = [t for _, lists in lexicon.LEXICON for words in lists for t in words]
    exact = [r"\b" + r"\s+".join(p.split()) + r"\b" for p in lexicon.TWO_LETTER_PHRASES]
    return re.compile("|".join([*map(term, wanted), *exact]), re.I)


def test_risk_groups_equal_the_whole_pattern_and_a_restatement(spark):
    texts = risky_texts(1500)
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string").withColumn("n", risk.normalize_text("t"))
    whole = F.coalesce(rx.found("t", fuzzy.PII) | rx.found("n", fuzzy.union()), F.lit(False))
    terms_only = "(?iu)" + "|".join(p for p in fuzzy.alternatives() if p != fuzzy.PII)
    got = df.select("i", "n", whole.alias("whole"), risk.matches_risk("t", F.col("n")).alias("fast"), rx.found("n", terms_only).alias("terms")).collect()
    assert [r["i"] for r in got if r["whole"] != r["fast"]] == []
    assert 0.3 < sum(r["whole"] for r in got) / len(got) < 0.95
    again = restated()
    assert [r["n"] for r in got[:300] if r["terms"] != bool(again.search(r["n"]))] == []


def test_risk_filter_handles_nulls_and_odd_columns(spark):
    df = spark.createDataFrame([(None, 1), ("", 2), ("k1ds", 3), ("hello there " * 4_000, 4), ("a@b.com", 5)], "`text` string, `__norm_0` int")
    assert sorted(r[1] for r in risk.risk_filter(df.withColumnRenamed("__norm_0", "n`o")).collect()) == [1, 2, 4]
    red = {r[1]: r[0] for r in risk.risk_filter(df, action="redact").collect()}
    assert red[1] is None and red[2] == "" and "k1ds" not in red[3] and red[5] == "[REDACTED]"
    assert risk.risk_filter(df.limit(0)).count() == 0


def test_hot_parents_are_looked_up_without_a_shuffle(spark, monkeypatch):
    nodes = [(f"n{i}", None if i == 0 else "n0" if i % 3 else f"n{i - 1}") for i in range(400)] + [("x", "y"), ("y", "x"), ("z", "x"), ("q", "gone")]
    df = spark.createDataFrame(nodes, "id string, parent string")
    want = rows(hierarchy.hierarchy(df), "id", "root", "depth", "path")
    monkeypatch.setattr(hierarchy, "HOT_FROM", 0)
    monkeypatch.setattr(hierarchy, "HOT", 8)
    assert rows(hierarchy.hierarchy(df), "id", "root", "depth", "path") == want


def test_tables_and_counts(spark):
    df = spark.createDataFrame([(1, "<|im_start|>user\na<|im_end|><|end_of_text|>"), (2, None)], "row_id long, text string")
    sources.save_table(df, "kept_chats")
    assert rows(sources.read_table(spark, "kept_chats"), "row_id", "text") == rows(df, "row_id", "text")
    assert rows(clean.kept_counts(df, clean.dedupe_chats(df)), "processed", "kept", "removed") == [(2, 1, 1)]
    stages = {r["stage"]: r["rows"] for r in clean.stage_counts(df, clean.four_stages(df, max_tokens=3)).collect()}
    assert stages["processed"] == 2 and stages["good"] + stages["bad"] == 1 and stages["bad"] == 1


def test_new_messages_with_a_repeated_store(spark):
    stored = spark.createDataFrame([(1, "a", None)] * 5 + [(2, None, None)], "n long, id string, t timestamp")
    batch = spark.createDataFrame([(3, " a ", None), (4, "b", None), (5, "b", T0), (6, None, T0)], "n long, id string, t timestamp")
    assert rows(redelivery.new_messages(batch, stored, "id", "t", "n"), "id", "n") == [("b", 5)]


def test_shared_folder_is_needed_on_a_cluster(monkeypatch):
    from threadmill.operators import durable

    class Context:
        master = "spark://host:7077"

        class _jsc:
            @staticmethod
            def sc():
                return type("C", (), {"getCheckpointDir": staticmethod(lambda: type("O", (), {"isDefined": staticmethod(lambda: False)}))})

    class Session:
        sparkContext = Context

        class conf:
            @staticmethod
            def get(*_):
                return None

    with pytest.raises(RuntimeError):
        durable.shared_folder(Session)
