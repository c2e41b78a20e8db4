"""Reject predicates of the first cleaning stage and their ordered reason chain.

Each predicate is a boolean ``Column`` over the transformed text. ``reason`` puts them in the order in which the first
that holds names the row. NULL text: every predicate is NULL, the reason NULL.
"""

from __future__ import annotations

import keyword
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import chatml, rx

# Symbols that open a list line.
BULLETS = (
    "-*+>•‣◦▪▫‒–—·○●♦✓✔∘☑☐☒⬤◆◇■□🔹🔸➡➤➣➢➔➛➜➝➞➟⇨→⇢⇒«»‹›➥➦➧➨➩➪➫➬➭➮➯"
    "✦✧✩✪✫✬✭✮✯★☆✰✱✲✳✴✵✶✷✸✹☀☁☂☃☄✡❖❥❦❧❃❋⁂※『』「」【】〈〉《》🔘🔺🔻🔼🔽🔷🔶🞜🞛🞚🞙"
)
#: List lines may also open with these two; trade posts take the further marks as separators.
LIST_ONLY, TRADE_ONLY = "`⤷﹡", ":.,"
# Words of trade posts.
TRADE_WORDS = "id|hp|pr|evs?|ex|ga|tl|sts|ec|mi|gx|v(?:max|star)?|lf|ft|ss|cg|wtt?|iv|have|want|trading|h|looking for|for trade"
# Words of service offers.
SERVICE_WORDS = (
    "vouches?|payment first|dm me|prices?|accounts?|slots?|trials?|full gears?|lft|lf|1v1|1v2|2v1|2v2|3v3|4v4|5v5|6v6|7v7"
)
# Script blocks in the order in which they give a label.
SCRIPTS = (
    (r"\x{0400}-\x{052f}", "Cyrillic"),
    (r"\x{0590}-\x{05ff}", "Hebrew"),
    (r"\x{0600}-\x{06ff}", "Arabic"),
    (r"\x{0750}-\x{077f}", "Arabic Supplement"),
    (r"\x{0900}-\x{097f}", "Devanagari"),
    (r"\x{0980}-\x{09ff}", "Bengali"),
    (r"\x{0e00}-\x{0e7f}", "Thai"),
    (r"\x{1100}-\x{11ff}", "Hangul Jamo"),
    (r"\x{3040}-\x{30ff}", "Hiragana/Katakana"),
    (r"\x{3400}-\x{4dbf}", "CJK Ext A"),
    (r"\x{4e00}-\x{9fff}", "CJK"),
    (r"\x{ac00}-\x{d7af}", "Hangul Syllables"),
    (r"\x{a640}-\x{a69f}", "Cyrillic Ext B"),
    (r"\x{2de0}-\x{2dff}", "Cyrillic Ext A"),
    (r"\x{2e80}-\x{2eff}", "CJK Radicals"),
    (r"\x{3000}-\x{303f}", "CJK Symbols"),
    (r"\x{31a0}-\x{31bf}", "Bopomofo Extended"),
    (r"\x{31f0}-\x{31ff}", "Katakana Extensions"),
    (r"\x{3100}-\x{312f}", "Bopomofo"),
)
SCRIPT_SHARE = 0.3
# Two phrases that are never let through, look-alike letters included.
SLUR = r"n[ìíîïĩīįıɨɩɪіί1|i]g{1,3}[e3]"
MINORS = rf"child{rx.S}+(?:porn|pornography)"


def _class(symbols: str) -> str:
    return "".join(dict.fromkeys(rx.literal(s) for s in symbols))


BULLET_LINE = f"^{rx.S}*[{_class(BULLETS + LIST_ONLY)}]"
TRADE_EDGE = f"[{rx.SPACES}{_class(BULLETS + TRADE_ONLY)}]"
TRADE = rf"(?iu)(?:^|{TRADE_EDGE})(?:{TRADE_WORDS})(?:{TRADE_EDGE}|$)"
#: The same for Java: letters and digits, most of a text, are ruled out before the long class of edges is looked through.
_QUICK_EDGE = rf"(?: |(?![a-zA-Z0-9]){TRADE_EDGE})"
QUICK_TRADE = rf"(?iu)(?:^|{_QUICK_EDGE})(?:{TRADE_WORDS})(?:{_QUICK_EDGE}|$)"
NUMBER_START = rf"^{rx.S}*\p{{Nd}}+"
#: Words that open a line of code; a parameter of ``count_code_like_lines``.
CODE_WORDS = [
    *sorted(keyword.kwlist),
    *"void int long float double char bool struct enum template namespace const let var function typeof new delete this switch case".split(),
    *"echo sudo chmod mkdir grep export source docker kubectl npm pip cargo javac gcc make".split(),
]


def code_like_line(words: list[str] | None = None) -> Callable[[Column], Column]:
    opening = rf"(?iu)^{rx.S}*(?:{'|'.join(rx.literal(w) for w in words or CODE_WORDS)}){rx.NOT_W}"
    return lambda l: rx.found(l, r"[;{}=<>#\[\]()]") | rx.found(F.concat(l, F.lit(" ")), opening)


def count_code_like_lines(c: str | Column, words: list[str] | None = None) -> Column:
    line = code_like_line(words)
    return F.size(F.filter(rx.lines(c), lambda l: line(l) | rx.found(l, r"\+\+")))


def _msgs(turns: Column) -> Column:
    return F.transform(turns, lambda t: t["msg"])


def _count(lines: Column, test: Callable[[Column], Column]) -> Column:
    return F.size(F.filter(lines, test))


def card_trade(text: Column) -> Column:
    body = rx.strip(text)
    return (F.length(body) >= 10) & (rx.found(body, r"^\p{Nd}{13,16}") | rx.found(body, QUICK_TRADE))


def code_like(text: Column, turns: Column, mode: str = "actual") -> Column:
    """``actual``: never holds, since the test looks for whole turns inside a message. ``documented``: a message with
    more than two lines of code."""
    if mode == "actual":
        return F.lit(False)
    line = code_like_line()
    return F.exists(_msgs(turns), lambda m: _count(rx.lines(m), line) > 2)


def emoji_spam(text: Column) -> Column:
    return rx.found(text, rx.NON_ASCII) & rx.found(text, f"{rx.EMOJI}{rx.S}*{rx.EMOJI}")


def bulletpoint_list(turns: Column) -> Column:
    def bullety(m: Column) -> Column:
        own = rx.lines(m)
        return rx.found(m, rx.NL_CHAR) & (F.size(own) > 2) & (_count(own, lambda l: rx.found(l, BULLET_LINE)) / F.size(own) >= 0.5)

    return F.exists(_msgs(turns), bullety)


def lf_hint(text: Column) -> Column:
    return rx.found(text, rf"(?iu)(?:^|{rx.NOT_W})LF\p{{Nd}}*(?:{rx.NOT_W}|$)")


def fake_token(text: Column) -> Column:
    return rx.found(chatml.strip_structural(text), "<[a-zA-Z0-9_]*>")


def double_dash(text: Column) -> Column:
    return rx.found(text, f"[—–-]{rx.W}")


def percent_encoding(text: Column) -> Column:
    return rx.found(text, "%[0-9a-fA-F]{2}")


FOREIGN = "[" + r"\p{M}\p{Cf}\p{Cn}\p{Cs}" + "".join(r for r, _ in SCRIPTS) + "]"


def nonlatin_script(turns: Column, share: float = SCRIPT_SHARE) -> Column:
    """Label of the first message with that share of marks, format characters or letters of the listed scripts; else NULL."""
    clean = F.transform(_msgs(turns), chatml.strip_structural)
    first = F.get(
        F.filter(clean, lambda m: rx.found(m, rx.NON_ASCII) & (F.regexp_count(m, F.lit(FOREIGN)) / F.length(m) >= share)), F.lit(0)
    )
    label = F.coalesce(*[F.when(rx.found(first, f"[{r}]"), F.lit(name.upper())) for r, name in SCRIPTS], F.lit("OTHER"))
    return F.when(first.isNotNull(), label)


def single_word_lines(turns: Column) -> Column:
    def short(m: Column) -> Column:
        own = rx.solid_lines(m)
        return rx.found(m, rx.NL_CHAR) & (F.size(own) > 4) & (_count(own, lambda l: F.regexp_count(l, F.lit(f"{rx.NOT_S}+")) <= 2) >= 2)

    return F.exists(_msgs(turns), short)


def service_ad(text: Column) -> Column:
    own, low = rx.lines(text), F.lower(text)
    words = rf"(?iu)(?:^|{rx.NOT_W})(?:{SERVICE_WORDS})(?:{rx.NOT_W}|$)"
    both = F.contains(low, F.lit("accepting")) & F.contains(low, F.lit("offering"))
    listed = (F.size(own) >= 4) & (_count(own, lambda l: rx.found(l, BULLET_LINE)) >= 2) & (_count(own, lambda l: rx.found(l, words)) >= 2)
    # CASE keeps what the parts of a conjunction share from being computed ahead of its first part
    return F.when(both, listed).otherwise(both)


def multi_newlines(turns: Column) -> Column:
    return F.exists(_msgs(turns), lambda m: F.contains(m, F.lit("\n\n\n")))


def discord_timestamp(turns: Column) -> Column:
    return F.exists(_msgs(turns), lambda m: rx.found(m, r"<[tT]:\p{Nd}{10}:[a-zA-Z]>"))


def duplicate_lines_only(turns: Column) -> Column:
    def same(m: Column) -> Column:
        own = rx.solid_lines(m)
        return rx.found(m, rx.NL_CHAR) & (F.size(own) >= 2) & (F.size(F.array_distinct(own)) == 1)

    return F.exists(_msgs(turns), same)


def numbered_line_block(turns: Column) -> Column:
    def numbered(l: Column) -> Column:
        return F.when(rx.found(l, BULLET_LINE), rx.found(rx.sub(l, BULLET_LINE), NUMBER_START)).otherwise(
            rx.found(l, rf"^{rx.S}*(?:[xX]{rx.S}*)?\p{{Nd}}+")
        )

    def block(m: Column) -> Column:
        own = rx.solid_lines(m)
        return rx.found(m, rx.NL_CHAR) & (F.size(own) > 4) & (_count(own, numbered) >= 2)

    return F.exists(_msgs(turns), block)


NUMERIC_LINE = rf"(?:\A|{rx.NL_CHAR}){rx.S}*[{rx.DIGITS}]+{rx.S}*(?:{rx.NL_CHAR}|\z)"


def numeric_only_line(turns: Column) -> Column:
    return F.exists(_msgs(turns), lambda m: rx.found(m, NUMERIC_LINE))


def slur(text: Column) -> Column:
    return rx.found(chatml.strip_structural(text), f"(?iu){SLUR}")


def minors(text: Column) -> Column:
    return rx.found(chatml.strip_structural(text), rf"(?iu)(?:^|{rx.NOT_W}){MINORS}(?:{rx.NOT_W}|$)")


def consecutive_emojis_any_side(turns: Column) -> Column:
    return F.exists(_msgs(turns), emoji_spam)


#: (label, predicate over text and turns) in the order in which they are tried. NONLATIN_SPAM has its script appended.
ORDER: tuple[tuple[str, Callable[[Column, Column], Column]], ...] = (
    ("CARD_TRADE", lambda t, _: card_trade(t)),
    ("CODE_LIKE", lambda t, u: code_like(t, u)),
    ("EMOJI_SPAM", lambda t, _: emoji_spam(t)),
    ("BULLETPOINT_LIST", lambda _, u: bulletpoint_list(u)),
    ("LF_HINT", lambda t, _: lf_hint(t)),
    ("FAKE_TOKEN", lambda t, _: fake_token(t)),
    ("DOUBLE_DASH", lambda t, _: double_dash(t)),
    ("PERCENT_ENCODING", lambda t, _: percent_encoding(t)),
    ("NONLATIN_SPAM", lambda _, u: nonlatin_script(u).isNotNull()),
    ("SINGLE_WORD_LINES", lambda _, u: single_word_lines(u)),
    ("SERVICE_AD", lambda t, _: service_ad(t)),
    ("MULTI_NEWLINES", lambda _, u: multi_newlines(u)),
    ("DISCORD_TIMESTAMP", lambda _, u: discord_timestamp(u)),
    ("DUPLICATE_LINES_ONLY", lambda _, u: duplicate_lines_only(u)),
    ("NUMBERED_LINE_BLOCK", lambda _, u: numbered_line_block(u)),
    ("NUMERIC_ONLY_LINE", lambda _, u: numeric_only_line(u)),
    ("NWORD", lambda t, _: slur(t)),
    ("CP_REFERENCE", lambda t, _: minors(t)),
)


def reason(
    text: Column,
    turns: Column,
    code_mode: str = "actual",
    tokens: Column | None = None,
    max_tokens: float | None = None,
) -> Column:
    """Label of the first predicate that holds, else NULL. CASE branches are lazy, so later ones only run where needed.
    With ``tokens``: NULL tokens give TOKEN_ERROR, more than ``max_tokens`` TOO_LONG, both after all others."""
    out = None
    for label, test in ORDER:
        holds = code_like(text, turns, code_mode) if label == "CODE_LIKE" else test(text, turns)
        value = F.concat(F.lit("NONLATIN_SPAM_"), nonlatin_script(turns)) if label == "NONLATIN_SPAM" else F.lit(label)
        out = F.when(holds, value) if out is None else out.when(holds, value)
    if tokens is not None:
        out = out.when(tokens.isNull(), F.lit("TOKEN_ERROR"))
        if max_tokens is not None:
            out = out.when(tokens > max_tokens, F.lit("TOO_LONG"))
    return out
