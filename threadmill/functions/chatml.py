"""Columns over tagged conversations (``<|im_start|>role``, message, ``<|im_end|>``, closing ``<|end_of_text|>``)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import rx

START, END, EOT = "<|im_start|>", "<|im_end|>", "<|end_of_text|>"
#: User and assistant turns. The message needs a character, so an empty one runs on into the next turn.
TURN = rf"(?s)<\|im_start\|>(user|assistant){rx.S}+(.+?)<\|im_end\|>"
#: Any role; empty messages allowed.
MESSAGE = r"(?s)<\|im_start\|>.*?\n(.*?)<\|im_end\|>"
#: End tags and wholly piped start tags; ordinary start tags are not among them.
STRUCTURAL = r"<\|?(?:im_start\|user|im_start\|assistant|im_end|end_of_text)\|?>"


def turns(text: str | Column) -> Column:
    """array<struct<role,msg>> of the user and assistant turns, messages stripped; NULL text gives NULL, no turn an empty array."""
    return F.arrays_zip(
        rx.all_of(text, TURN, 1).alias("role"),
        F.transform(rx.all_of(text, TURN, 2), rx.strip).alias("msg"),
    ).cast("array<struct<role:string,msg:string>>")


def messages(text: str | Column) -> Column:
    """array<string> of all messages of any role, stripped."""
    return F.transform(rx.all_of(text, MESSAGE, 1), rx.strip)


def render(parts: Column, separator: str = "\n", closing: str = EOT) -> Column:
    """The inverse of ``turns``: struct<role,msg> elements as one tagged text."""
    blocks = F.transform(parts, lambda t: F.concat(F.lit(START), t["role"], F.lit("\n"), t["msg"], F.lit(END)))
    return F.concat(F.array_join(blocks, separator), F.lit(closing))


def chain_hash(text: str | Column) -> Column:
    """SHA-1 of the messages joined by line breaks, roles left out; NULL if there is no message."""
    m = messages(text)
    return F.when(F.size(m) > 0, F.sha1(F.array_join(m, "\n")))


def final_message(text: str | Column) -> Column:
    """Last message of any role; NULL if there is none."""
    m = messages(text)
    return F.when(F.size(m) > 0, F.element_at(m, -1))


def strip_structural(text: str | Column) -> Column:
    return rx.sub(text, STRUCTURAL)
