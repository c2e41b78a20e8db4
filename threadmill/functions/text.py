"""Scalar text transforms of the first cleaning stage, each a ``Column -> Column`` function. NULL stays NULL."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import chatml, rx


def strip_double_pipe(c: str | Column) -> Column:
    return F.replace(rx.col(c), F.lit("||"), F.lit(""))


def strip_hash_and_angle(c: str | Column) -> Column:
    """Rebuilds the text from its user and assistant turns; ``#`` runs at line starts and all angle brackets inside
    messages go. Anything outside such turns is lost; a text without turns becomes empty, or a bare end token."""
    clean = F.transform(
        chatml.turns(c),
        lambda t: F.struct(t["role"].alias("role"), F.translate(rx.sub(t["msg"], "(?md)^#+"), "<>", "").alias("msg")),
    )
    closed = F.endswith(rx.strip(c), F.lit(chatml.EOT))
    return F.when(rx.col(c) == "", rx.col(c)).when(closed, chatml.render(clean)).otherwise(chatml.render(clean, "", ""))


def strip_at_mentions(c: str | Column) -> Column:
    """Deletes ``@`` with all that follows up to white space, and that white space; this can take an adjacent end tag along."""
    return rx.sub(c, f"@{rx.NOT_S}+{rx.S}*")


def strip_flower_and_trailing_colon(c: str | Column) -> Column:
    out = F.replace(rx.col(c), F.lit("\U0001f940"), F.lit(""))
    return rx.sub(rx.sub(out, r"(?md):[ \t]*$"), r"(?md)^[ \t]*[.,]+")


def strip_emojis(c: str | Column) -> Column:
    """No emoji is all ASCII, so plain texts are passed on as they are."""
    c = rx.col(c)
    return F.when(rx.found(c, rx.NON_ASCII), rx.sub(c, rx.EMOJI)).otherwise(c)


def clean_commas_and_periods(c: str | Column) -> Column:
    steps = ((rf"\.{rx.S}*,", ","), (r",\.", "."), (r",{2,}", ","))
    return reduce(lambda x, s: rx.sub(x, *s), steps, rx.col(c))


def normalize_spacing(c: str | Column) -> Column:
    return rx.strip(rx.sub(rx.sub(c, " {2,}", " "), " ([.,!?;])", "$1"))


#: Order matters: tags are rebuilt before mentions go, emojis go before bullets are looked for.
CHAIN = (
    strip_double_pipe,
    strip_hash_and_angle,
    strip_at_mentions,
    strip_flower_and_trailing_colon,
    strip_emojis,
    clean_commas_and_periods,
    normalize_spacing,
)


def transform_chain(c: str | Column) -> Column:
    return reduce(lambda x, f: f(x), CHAIN, rx.col(c))


def preview(c: str | Column, n: int = 120) -> Column:
    return F.translate(F.substring(rx.col(c), 1, n), "\n", " ")


#: Runs of blanks, commas and colons before an end tag. Group 1 is a run that stays, since its last colon has
#: another comma or colon before it inside the run; group 2 is the tag alone.
END_RUN = rf"([,:{rx.SPACES}]*[,:]{rx.S}*:[,{rx.SPACES}]*<\|im_end\|>)|[,:{rx.SPACES}]+(<\|im_end\|>)"


def fix_end(c: str | Column) -> Column:
    return rx.sub(c, END_RUN, "$1$2")


def has_word(c: str | Column, stop: list[str]) -> Column:
    """Whether a text has a word that is no stop word."""
    words = rx.all_of(F.lower(rx.col(c)), f"{rx.W}+")
    known = F.array(*[F.lit(w) for w in stop])
    return F.exists(words, lambda w: ~F.array_contains(known, w))


# English stop words of the reference database's text search.
STOP_WORDS = """i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her hers
herself it its itself they them their theirs themselves what which who whom this that these those am is are was were be
been being have has had having do does did doing a an the and but if or because as until while of at by for with about
against between into through during before after above below to from up down in out on off over under again further then
once here there when where why how all any both each few more most other some such no nor not only own same so than too
very s t can will just don should now""".split()


#: What a default token is: a run of word characters, or any other character that is no white space.
TOKEN = rf"{rx.W}+|[^\p{{L}}\p{{N}}_{rx.SPACES}]"


def token_len(c: str | Column) -> Column:
    """Number of words and punctuation marks: the stand-in where no tokenizer file is given."""
    return F.regexp_count(rx.col(c), F.lit(TOKEN))
