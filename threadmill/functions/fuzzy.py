"""Compiles words into look-alike-aware patterns (Java dialect).

Each letter becomes a class of its look-alikes, which may repeat, and up to three characters that are no letters or
digits may stand between letters. The repetition is possessive: a word in which a letter's class contains the next
letter can therefore not match its own plain spelling. That is kept, as matches must stay the same.
"""

from __future__ import annotations

from . import rx
from .lexicon import LEXICON, LOOKALIKES, TWO_LETTER_PHRASES

GAP = r"[^\p{L}\p{N}]{0,3}"
REPEAT = 100


def letter_class(ch: str) -> str:
    forms = dict.fromkeys(LOOKALIKES.get(ch.lower(), ch))
    if len(forms) == 1:
        return rx.literal(ch)
    return "[" + "".join(rx.literal(f) for f in forms) + "]"


def fuzzy_word(word: str, gap: str = GAP, repeat: int = REPEAT) -> str:
    units = (f"{u}(?:{gap}?{u}){{0,{repeat}}}+" for u in map(letter_class, word))
    return gap.join(units)


def fuzzy_any(words: list[str], gap: str = GAP, bounded: bool = False) -> str:
    """Alternation in the given order. Several words: spaces are optional. One word: an s or z may follow."""
    plural = f"(?:{letter_class('s')}|{letter_class('z')})?"
    forms = [gap.join(fuzzy_word(w, gap) for w in p.split()) if " " in p else fuzzy_word(p, gap) + plural for p in words]
    body = "(?:" + "|".join(forms) + ")"
    return f"{rx.B}{body}{rx.B}" if bounded else body


_D, _S, _B = r"\p{Nd}", rx.S, rx.B
# Contact and identity data as the risk filter knows it.
PII = "|".join(
    (
        rf"({_B}{_D}{{3}}[-.{rx.SPACES}]?{_D}{{2}}[-.{rx.SPACES}]?{_D}{{4}}{_B})",
        rf"({_B}(?:\+?{_D}{{1,3}}[-.{rx.SPACES}]?)?(?:\(?{_D}{{3}}\)?[-.{rx.SPACES}]?)?{_D}{{3}}[-.{rx.SPACES}]?{_D}{{4}}{_B})",
        r"([a-z0-9._%+-]+@[a-z0-9.-]+\.[a-z]{2,})",
        rf"({_B}(?:(?:25[0-5]|2[0-4]{_D}|1?{_D}?{_D})(?:\.(?!\n?\z)|(?=\n?\z))){{4}}{_B})",
        rf"({_B}0x[a-fA-F0-9]{{40}}{_B})",
        rf"({_B}[13][a-km-zA-HJ-NP-Z1-9]{{25,34}}{_B})",
        rf"{_B}(here('s| is){_S}+(his|her|their){_S}+address|post{_S}+(his|her|their){_S}+address|i['’ ]?ll{_S}+dox{_S}+you|swat{_S}+you){_B}",
    )
)
REMOTE = rf"{_B}({'|'.join(f'{_S}+'.join(p.split()) for p in TWO_LETTER_PHRASES)}){_B}"


def alternatives() -> list[str]:
    """The alternatives of all categories in their order."""
    parts = []
    for name, lists in LEXICON:
        if name == "pii":
            parts.append(PII)
        elif name == "malware":
            parts += [fuzzy_any(lists[0]), REMOTE, fuzzy_any(lists[1])]
        else:
            parts += [fuzzy_any(words) for words in lists]
    return parts


def union() -> str:
    """All categories in their order, ignoring case; for replacement the order of alternatives counts."""
    return "(?iu)" + "|".join(alternatives())


# ---- what a match needs -------------------------------------------------------------------------------------------------

#: Look-alikes that are no letters or digits: they can stand for a letter or for nothing.
_EITHER = "".join(sorted({c for forms in LOOKALIKES.values() for c in forms if not c.isalnum()}))
_EITHER_INSIDE = "".join(map(rx.literal, _EITHER))
#: What can only stand between letters; texts are looked at without it.
ONLY_BETWEEN = rf"[^\p{{L}}\p{{N}}{_EITHER_INSIDE}]+"
#: What a text with contact data holds: four digits close together, an at sign, a long run, or a word of the phrases.
PII_NEEDS = r"@|\p{Nd}(?:[^\p{Nd}]{0,2}\p{Nd}){3}|[a-zA-Z0-9]{26}|(?iu:address|dox|swat)"


def needs(words: list[str]) -> str:
    """Pattern that every text in which ``fuzzy_any(words)`` matches also matches, once ``ONLY_BETWEEN`` is cut out: the
    letters' classes in order, with any repetition. The words share their beginnings, so few branches are tried."""
    tree: dict = {}
    for w in words:
        at = tree
        # characters that can only stand between letters have been cut out; elongation makes equal neighbours one
        letters = [c for c in w if c.isalnum() or c in _EITHER]
        for i, c in enumerate(letters):
            if not i or c != letters[i - 1]:
                at = at.setdefault(c, {})
        at[""] = {}

    def render(node: dict) -> str:
        if "" in node:
            return ""
        # repetitions of a letter can have others between them that stand for nothing
        branches = [f"{letter_class(c)}[{letter_class(c).strip('[]')}{_EITHER_INSIDE}]*{render(sub)}" for c, sub in sorted(node.items())]
        return branches[0] if len(branches) == 1 else "(?:" + "|".join(branches) + ")"

    return "(?iu)" + render(tree)


def groups() -> list[tuple[str, str]]:
    """(what a match needs, pattern) for all terms, in groups by first letter and by whether they are short; a text
    matches ``union`` without contact data if and only if it matches one of the patterns."""
    own: dict[tuple[str, bool], list[str]] = {}
    for _, lists in LEXICON:
        for words in lists:
            for w in dict.fromkeys(words):
                own.setdefault((w[0], len(w) < 4), []).append(w)
    out = [(needs(list(dict.fromkeys(words))), "(?iu)" + fuzzy_any(list(dict.fromkeys(words)))) for _, words in sorted(own.items())]
    return [*out, (needs(TWO_LETTER_PHRASES), "(?iu)" + REMOTE)]
