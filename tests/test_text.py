"""Scalar transforms and predicates on hand-made cases."""

import random
import re

import pytest
from pyspark.sql import functions as F

from threadmill.functions import chatml, predicates, rx, slang, text

U = lambda *m: "\n".join(f"<|im_start|>{'user' if i % 2 == 0 else 'assistant'}\n{x}<|im_end|>" for i, x in enumerate(m)) + "<|end_of_text|>"


def col(spark, f, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, text string")
    return [r["r"] for r in df.select("i", f(F.col("text")).alias("r")).orderBy("i").collect()]


CASES = [
    (text.strip_double_pipe, "a||b|c", "ab|c"),
    (text.strip_hash_and_angle, "x<|im_start|>user\n## hi <b>\n#you<|im_end|>", "<|im_start|>user\n hi b\nyou<|im_end|>"),
    (text.strip_hash_and_angle, "no turns", ""),
    (text.strip_hash_and_angle, "no turns<|end_of_text|> ", "<|end_of_text|>"),
    (text.strip_at_mentions, "hi @bob  you", "hi you"),
    (text.strip_at_mentions, "hi @bob<|im_end|>\nyou", "hi you"),
    (text.strip_flower_and_trailing_colon, "\U0001f940a: \n ..b", "a\nb"),
    (text.strip_emojis, "a\U0001f600b\U0001f1f5\U0001f1f9c1️⃣d", "abcd"),
    (text.clean_commas_and_periods, "a. ,b,.c,,,d", "a,b.c,d"),
    (text.normalize_spacing, "  a   b , c :d ", "a b, c :d"),
    (chatml.strip_structural, "<|im_start|>user x<|im_end|><end_of_text>", "<|im_start|>user x"),
    (text.fix_end, "a ,: b , <|im_end|>", "a ,: b<|im_end|>"),
    (text.fix_end, "a , :<|im_end|>c :<|im_end|>", "a , :<|im_end|>c<|im_end|>"),
    (text.preview, "a\nb", "a b"),
    (slang.replace_slang, "u Ur b4 THX éu gr8_ r", "you Your before Thanks éu gr8_ are"),
    (chatml.final_message, U("a", " b "), "b"),
    (chatml.final_message, "x", None),
]


@pytest.mark.parametrize("f,given,want", CASES)
def test_transform(spark, f, given, want):
    assert col(spark, f, [given]) == [want]
    assert col(spark, f, [None]) == [None]


def test_empty_message_runs_on(spark):
    t = col(spark, chatml.turns, ["<|im_start|>user\n<|im_end|>\n<|im_start|>assistant\nhi<|im_end|>"])[0]
    assert len(t) == 1 and "assistant" in t[0]["msg"]


def test_fix_end_against_plain_python(spark):
    rng = random.Random(3)
    texts = ["".join(rng.choice([",", ":", " ", "\n", "a", "<|im_end|>", "0"]) for _ in range(rng.randint(1, 14))) for _ in range(800)]

    def plain(s):
        def one(m):
            run = m[1]
            i = run.rfind(":")
            kept = i >= 0 and run[:i].strip() != ""
            return m[0] if kept else m[2]

        return re.sub(r"([,\s:]+)(<\|im_end\|>)", one, s)

    assert col(spark, text.fix_end, texts) == [plain(s) for s in texts]


REASONS = [
    ("CARD_TRADE", U("my long text with want in it", "ok then")),
    ("EMOJI_SPAM", U("look \U0001f600 \U0001f600 here", "fine")),
    ("BULLETPOINT_LIST", U("• one\n• two\nthree", "fine")),
    ("DOUBLE_DASH", U("well-known thing", "fine")),
    ("PERCENT_ENCODING", U("see %20 there", "fine")),
    ("NONLATIN_SPAM_CYRILLIC", U("привет друзья", "fine")),
    ("SINGLE_WORD_LINES", U("one\ntwo\nthree words here\nfour words are here\nfive words are here", "fine")),
    ("MULTI_NEWLINES", U("first\n\n\nsecond", "fine")),
    ("DUPLICATE_LINES_ONLY", U("same line here\nsame line here", "fine")),
    ("NUMERIC_ONLY_LINE", U("see this line\n²", "fine")),
    ("CP_REFERENCE", U("child  porn", "fine")),
    (None, U("all good now", "fine")),
]


@pytest.mark.parametrize("want,given", REASONS)
def test_reason(spark, want, given):
    f = lambda c: predicates.reason(c, chatml.turns(c))
    assert col(spark, f, [given]) == [want]


def test_lf_and_numbers(spark):
    assert col(spark, predicates.lf_hint, ["LF: a", "lf5", "LF5a", "LF:5a", "elf", "x LF"]) == [True, True, False, True, False, True]
    block = lambda c: predicates.numbered_line_block(chatml.turns(c))
    assert col(spark, block, [U("- 1 a\nx2 b\nc c c\nd d d\ne e e"), U("- a\n1 b\nc c\nd d\ne e")]) == [True, False]


def test_reason_is_first_and_tokens_come_last(spark):
    f = lambda c: predicates.reason(c, chatml.turns(c), tokens=F.length(c), max_tokens=5)
    assert col(spark, f, [U("well-known %20", "fine"), U("all good now", "fine")]) == ["DOUBLE_DASH", "TOO_LONG"]


def test_space_class_is_python_space(spark):
    chars = [chr(i) for i in range(0x3100) if not 0xD800 <= i < 0xE000]
    got = col(spark, lambda c: rx.found(c, rf"\A{rx.S}\z"), chars)
    assert [c for c, g in zip(chars, got) if g != c.isspace()] == []


def test_tokenizer_len(spark):
    import os

    from threadmill.functions.tokens import tokenizer_len

    path = "/opt/tokenizers/byte_bpe_50k.json"
    if not os.path.exists(path):
        pytest.skip("no tokenizer file here")
    assert col(spark, lambda c: tokenizer_len(c, path), ["hello world", "", None]) == [2, 0, None]
    assert col(spark, lambda c: tokenizer_len(c, path, longest=1), ["hello world"]) == [1]
    assert col(spark, lambda c: tokenizer_len(c, "/nowhere"), ["x"]) == [None]
