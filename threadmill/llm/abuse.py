"""Abusive, hateful and sexually explicit language: a score per text and category, the passages, and rates per source.

Every token has a log-odds score per category: counts in training rows under a Dirichlet prior that holds background
frequencies and a general lexicon; pairs of neighbouring tokens and classes of words near each other add to it. The
heaviest run of tokens (maximum-scoring segment, one linear pass over all tokens of a batch at once) is what a text is
judged by. How high such a maximum gets by chance grows with the logarithm of the length: extreme-value statistics, their
rate solved from the corpus-wide token scores and their constant fitted to the corpus' own maxima, turn it into an
expected number of chance hits. The cutoff of each category is chosen by cross-validation over groups of labelled rows.

Training rows are the whole labelled table and all sentences that label themselves: nobody disguises
an innocent word, so a word that the corpus writes in several kinds of disguise (look-alike letters, digits for letters,
hidden characters, full-width forms, letters spelled out) is an offensive one, and a sentence that holds it in disguise
uses it offensively. All texts are searched for such words and all their sentences train the model (self-training in
``ROUNDS`` rounds, counts added up in the tasks). All texts are scored whole.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter, defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import rx
from ..functions.slang import quoted
from ..operators.durable import Scratch

CATEGORIES = ("abuse", "hate", "sexual")
#: Rounds of self-training.
ROUNDS = 2
#: A word is evaded if it comes in this many kinds of disguise and in disguise for this share of its occurrences.
KINDS, SHARE = 3, 0.002

# Words that insult, threaten, degrade, name groups, or are sexual, in several languages, without accents.
INSULTS = """idiot idiots idiota idioot imbecile imbecil cretin moron morons stupid dumb dumbass dimwit retard loser losers pathetic
worthless scum scumbag coward asshole bastard bitch cunt dickhead jerk prick twat tosser wanker fuck fucking fucker shit stfu gtfo
arschloch trottel vollidiot hurensohn wichser idiotin dumm spast fotze abschaum dreck maul fresse scheisse
connard connasse salope encule abruti ordure gueule merde degage minable
pendejo cabron gilipollas estupido basura mierda puta largate
stronzo coglione feccia cazzo stupido klootzak eikel kut kurwa debil suka otario lixo caralho porra merda idioten
идиот дебил тварь мудак сука урод""".split()
MILD = "ugly fat pig cow rat snake dog clown worm disgusting filthy dirty gross lying lazy drunk trash shame ashamed".split()
VIOLENCE = "kill beat hurt stab shoot hunt smash slap punch strangle break crush destroy find murder choke burn toten umbringen schlagen matar matare uccidere tuer frapper doden doda zabic убью".split()
YOU = "you your yourself u ur du dich dir dein deine deinen tu te toi ton tes eres tus tua sei ti je jij jou jouw ты тебя тебе voce".split()
GROUPS = """immigrants immigrant refugees refugee foreigners foreigner migrants migrant muslims muslim jews jew christians gays gay lesbians
blacks gypsies gypsy arabs africans mexicans asians believers infidels women disabled auslander fluchtlinge juden etrangers immigres refugies
inmigrantes extranjeros refugiados stranieri immigrati rifugiati""".split()
DEGRADE = """vermin parasite parasites cockroaches rats pigs animal animals savage savages subhuman subhumans inferior primitive thief thieves
criminals scum filth filthy dirty lazy disease breed stupid ungeziefer parasiten basura parasitos parasiti""".split()
#: The call to get out, in ten languages.
OUT = "deport deported expel banned raus dehors fuera fora fuori eruit ut precz вон".split()
SEXUAL = """nude nudes naked nipples breasts thighs sex sexy horny aroused cum cumming pussy cock dick tits boobs erection blowjob handjob moan
moaning lick panties lingerie undress fetish kinky masturbate orgasm erotic porn strip threesome anal penis vagina thong nacktbilder nackt geil titten schwanz ficken
desnudo desnuda caliente follar polla tetas nu nue baiser bite sucer nudo nuda scopare pelado pelada gostosa
naakt neuken naken knulla naga голая секс""".split()
NEGATION = "not aren't isn't ain't don't nicht kein pas jamais niet nie inte не".split()

# ---- tokens under disguise ----------------------------------------------------------------------------------------------

_LOOKALIKE = str.maketrans("аеорсухіѕјԁһκνтмвнкьгз", "aeopcyxisjdhkvtmbhkbr3")
_LEET = str.maketrans("013457$@!€", "oieastsaie")
_HIDDEN = re.compile("[​-‏⁠﻿­]")
_SPELLED = re.compile(r"(?<![^\W_])([^\W\d_]([ ._*\-])[^\W_](?:\2[^\W_])+)(?![^\W_])")
TOKEN = re.compile(r"[^\W_]+(?:[*#$@!'’][^\W_]+)*")
_MARKS = re.compile(r"[̀-ͯ]")
_CHAT = re.compile(r"<\|im_(?:start\|>\w*|end\|>)|<\|end_of_text\|>|<[@#a:][^>\s]{1,60}>|https?://\S+")
_RUN = re.compile(r"(.)\1+")
_RUN3 = re.compile(r"(.)\1{2,}")


def plain(text: str) -> str:
    """Lower case, compatibility forms, without accents and hidden characters."""
    if text.isascii():
        return text.lower()
    t = _HIDDEN.sub("", unicodedata.normalize("NFKC", text)).lower()
    return _MARKS.sub("", unicodedata.normalize("NFD", t)).replace("ß", "ss").replace("ı", "i")


def raw_tokens(text: str) -> list[str]:
    """Tokens as written; letters spelled out one by one become a word."""
    t = plain(text)
    if "<" in t or "://" in t:
        t = _CHAT.sub(" . ", t)
    if _SPELLED.search(t):
        t = _SPELLED.sub(lambda m: re.sub(r"[ ._*\-]", "", m[1]), t)
    return TOKEN.findall(t)


#: What a text must hold for ``evasions`` to find anything in it, for the JVM: each alternative begins with a character
#: that few texts have, or with a separator. Spelled-out words are told by their last two letters.
EVASION = (
    r"[0-9]\p{L}|[0-9](?<=\p{L}.)|[$@!€](?<=\p{L}.)\p{L}|([ ._*\-])[\p{L}\p{N}]\1[\p{L}\p{N}](?![\p{L}\p{N}])|"
    r"[\x{ff01}-\x{ff5e}\x{200b}-\x{200f}\x{2060}\x{feff}\x{ad}]|[\p{IsCyrillic}\p{IsGreek}](?:(?=\p{IsLatin})|(?<=\p{IsLatin}.))"
)
_STRETCH = re.compile(r"(?<=[.!?])\s+|\n+")
_ODD_WORD = re.compile("[^\\W_]+(?:[$@!€​-‏⁠﻿­][^\\W_]+)*")
_FOREIGN = re.compile("[Ͱ-ԯ]")
_LATIN = re.compile("[A-Za-zÀ-ɏ]")
_WIDE = re.compile("[！-～]")
_DIGIT = re.compile("[0-9$@!€]")


def evasions(text: str) -> list[tuple[str, str, str]]:
    """(plain form, kind of disguise, sentence) of every word that may be disguised. A digit that may be i or l gives both."""
    out = []
    for s in _STRETCH.split(_CHAT.sub(" . ", text)):
        odd = [(re.sub(r"[ ._*\-]", "", m[1]), "spelled") for m in _SPELLED.finditer(s)]
        for w in _ODD_WORD.findall(_SPELLED.sub(" . ", s)):
            if w.isascii() and w.isalpha():
                continue
            if _HIDDEN.search(w):
                odd.append((w, "hidden"))
            elif _WIDE.search(w):
                odd.append((w, "wide"))
            elif _FOREIGN.search(w) and _LATIN.search(w):
                odd.append((w, "mixed"))
            elif _DIGIT.search(w) and any(c.isalpha() for c in w):
                odd.append((w, "leet"))
        for w, kind in odd:
            p = plain(w).translate(_LOOKALIKE)
            for f in {p.translate(_LEET), p.replace("1", "l").translate(_LEET)}:
                if len(f) > 2 and f.isalpha():
                    out.append((f, kind, s.strip()))
    return out


@dataclass
class Lexicon:
    """Brings a disguised token back to a word that matters; any other token stays."""

    words: frozenset[str]
    common: frozenset[str]

    def __post_init__(self) -> None:
        self.squeezed = {_RUN.sub(r"\1", w): w for w in sorted(self.words, reverse=True) if len(w) > 2}
        self.masked: dict[str, str] = {}
        for w in sorted(self.words):
            if len(w) > 2:
                for i in range(len(w)):
                    self.masked.setdefault(w[:i] + "?" + w[i + 1 :], w)

    def restore(self, t: str) -> str:
        t = t.replace("’", "'")
        if t in self.words or t in self.common:
            return t
        forms = [t]
        if not t.isascii():
            forms.append(t.translate(_LOOKALIKE))
        for f in list(forms):
            if not f.isalpha():
                forms.append(f.translate(_LEET))
                forms.append(f.replace("1", "l").translate(_LEET))
        for f in forms:
            for g in (f, _RUN3.sub(r"\1\1", f), _RUN3.sub(r"\1", f)):
                if g in self.words:
                    return g
            if len(f) > 3 and _RUN.search(f):
                w = self.squeezed.get(_RUN.sub(r"\1", f))
                # one letter twice inside a short word makes another word
                if w and (len(w) > 6 or _RUN3.search(f) or f[-1] == f[-2]):
                    return w
            if "*" in f or "#" in f:
                w = self.masked.get(re.sub(r"[*#]", "?", f))
                if w:
                    return w
        return t


# ---- model --------------------------------------------------------------------------------------------------------------

_CLASS = [("INSULT", INSULTS), ("MILD", MILD), ("VIOL", VIOLENCE), ("YOU", YOU), ("GROUP", GROUPS), ("DEGRADE", DEGRADE), ("OUT", OUT), ("SEX", SEXUAL), ("NOT", NEGATION)]
#: Log-odds that a lexicon word has by itself, by category, and how many training rows that is worth.
PRIOR = {"abuse": {"INSULT": 2.2, "MILD": 0.7, "VIOL": 0.3}, "hate": {"GROUP": 1.5, "DEGRADE": 0.4}, "sexual": {"SEX": 2.0}}
PRIOR_ROWS = 6
#: Words of two classes within a few tokens: what the pair adds.
NEAR = [
    ("abuse", "YOU", "INSULT", 3, 1.8), ("abuse", "NOT", "INSULT", 2, -5.0), ("abuse", "YOU", "MILD", 3, 1.0), ("abuse", "VIOL", "YOU", 2, 2.4),
    ("abuse", "MILD", "MILD", 2, 1.5), ("hate", "GROUP", "DEGRADE", 8, 2.0), ("hate", "DEGRADE", "GROUP", 8, 2.0), ("hate", "GROUP", "OUT", 8, 2.0),
    ("hate", "OUT", "GROUP", 8, 2.0), ("sexual", "SEX", "YOU", 4, 0.6), ("sexual", "SEX", "SEX", 6, 1.8),
]
#: Weight of the background prior, in tokens, and what every token costs a segment.
STRENGTH, DRIFT = 150.0, 0.1
FLOOR, CAP = -2.0, 3.5
#: What words and pairs of a single sentence can contribute, and what each doubling of their neighbours adds.
BOUND1, BOUND2, DOUBLED = 1.2, 1.6, 0.8
#: Share of tokens that are offensive, to which the share of a word's offensive uses is compared.
BASE = 0.05
#: Share of offensive uses at which an ordinary word or pair speaks neither for nor against.
EVEN = 0.25
#: Wanted number of chance hits a text; cross-validation may ask for a higher cutoff.
CHANCE = 0.015
#: A category whose score is less than this part of another's, by some of the same words, is only that one's echo. At 1
#: a passage is of the one category that it speaks for most.
ECHO = 1.0
#: Weight of held-out recall against precision: the labelled table has far more offensive rows than a corpus.
BETA = 0.5


@dataclass
class Model:
    lexicon: Lexicon
    ids: dict[str, int]
    unigram: np.ndarray
    pair_keys: np.ndarray
    pair_scores: np.ndarray
    alone: np.ndarray
    classes: np.ndarray
    prior: np.ndarray
    lam: np.ndarray = field(default_factory=lambda: np.ones(3))
    logk: np.ndarray = field(default_factory=lambda: np.zeros(3))
    least: np.ndarray = field(default_factory=lambda: np.full(3, -np.inf))
    cut: np.ndarray = field(default_factory=lambda: np.zeros(3))

    def __post_init__(self) -> None:
        self.known: dict[str, int] = {}

    def __getstate__(self) -> dict:
        return self.__dict__ | {"known": {}}

    def id(self, t: str) -> int:
        i = self.known.get(t)
        if i is None:
            i = self.ids.get(self.lexicon.restore(t), 0)
            if len(self.known) < 1 << 18:
                self.known[t] = i
        return i

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of all texts, each text opened by -1, and where each begins."""
        ids: list[int] = []
        starts = []
        known = self.known
        for t in texts:
            starts.append(len(ids))
            ids.append(-1)
            if t:
                for w in raw_tokens(t):
                    i = known.get(w)
                    ids.append(self.id(w) if i is None else i)
        return np.array(ids, dtype=np.int64), np.array(starts, dtype=np.int64)

    def token_scores(self, ids: np.ndarray) -> np.ndarray:
        """(tokens, categories); text openings score 0."""
        n = len(ids)
        safe = np.where(ids < 0, 0, ids)
        s = self.alone[safe]
        if n > 1 and len(self.pair_keys):
            key = safe[:-1] * len(self.unigram) + safe[1:]
            at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
            hit = (self.pair_keys[at] == key) & (ids[:-1] > 0) & (ids[1:] > 0)
            # a known pair is a second estimate of the same log-odds
            s[1:][hit] = 0.5 * (self.unigram[safe[1:][hit]] + self.pair_scores[at[hit]])
        doc = np.cumsum(ids < 0)
        cls = self.classes[safe]
        for c, a, b, width, bonus in NEAR:
            ia, ib, k = _BIT[a], _BIT[b], CATEGORIES.index(c)
            is_b = (cls & ib) > 0
            if not is_b.any():
                continue
            seen = np.zeros(n, dtype=bool)
            where = np.flatnonzero(is_b)
            for d in range(1, width + 1):
                ok = where[where >= d]
                seen[ok] |= ((cls[ok - d] & ia) > 0) & (doc[ok - d] == doc[ok])
            s[seen, k] += bonus
        s[ids < 0] = 0
        return s

    def best(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        return self.best_of(*self.encode(texts))

    def best_of(self, ids: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Highest segment score of each text and category, and the number of tokens of each text."""
        s = self.token_scores(ids)
        doc = np.cumsum(ids < 0) - 1
        length = np.diff(np.append(starts, len(ids))) - 1
        out = np.zeros((len(starts), len(CATEGORIES)))
        for k in range(len(CATEGORIES)):
            # one running minimum over all texts: each text lies far below the one before, so minima don't cross over
            run = np.cumsum(s[:, k]) - doc * 1e6
            low = np.minimum.accumulate(run)
            out[:, k] = np.maximum.reduceat(run - low, starts) if len(starts) else 0
        return out, length

    def normal(self, best: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Scores on the scale of the extreme-value law: free of the length, one unit a factor e of chance hits."""
        return np.where(best > 0, self.lam * best - np.log(np.maximum(length, 1))[:, None], -np.inf)

    def judge(self, ids: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """``normal`` scores of texts, those of echoes taken out."""
        z = self.normal(*self.best_of(ids, starts))
        doc = np.cumsum(ids < 0) - 1
        several = np.isfinite(z).sum(axis=1) > 1
        mine = several[doc] if len(ids) else several
        if mine.any():
            ids = ids[mine]
            s, doc, n = self.token_scores(ids), np.cumsum(ids < 0) - 1, np.arange(len(ids))
            spans = []
            for k in range(len(CATEGORIES)):
                run = np.cumsum(s[:, k]) - doc * 1e6
                low = np.minimum.accumulate(run)
                top = np.maximum.reduceat(run - low, np.flatnonzero(ids < 0))
                at = np.flatnonzero(run - low == top[doc])
                end = at[np.unique(doc[at], return_index=True)[1]]
                spans.append((np.maximum.accumulate(np.where(run == low, n, 0))[end], end))
            part = z[several]
            echo = np.zeros(part.shape, dtype=bool)
            for k, (a, b) in enumerate(spans):
                for j, (c, d) in enumerate(spans):
                    if j != k:
                        echo[:, k] |= (a < d) & (c < b) & (part[:, k] < ECHO * part[:, j])
            z[several] = np.where(echo, -np.inf, part)
        return z

    def calibrate(self, logk: np.ndarray) -> None:
        """``logk``: constants of the extreme-value law. The cutoff is where ``CHANCE`` hits a text are expected, or higher
        where cross-validation says so."""
        self.logk = np.asarray(logk, dtype=float)
        self.cut = np.maximum(self.logk - math.log(CHANCE), self.least)

    def passages(self, text: str) -> list[tuple[str, int, int, float]]:
        """(category, first token, last token, score): every significant maximal segment, by one linear scan."""
        ids, starts = self.encode([text])
        s = self.token_scores(ids)
        z = self.judge(ids, starts)[0]
        out = []
        for k, c in enumerate(CATEGORIES):
            if z[k] < self.cut[k]:
                continue
            need = (self.cut[k] + math.log(max(len(ids) - 1, 1))) / self.lam[k]
            out += [(c, a - 1, b - 1, float(v)) for a, b, v in maximal_segments(s[:, k]) if v >= need]
        return out


_BIT = {name: 1 << i for i, (name, _) in enumerate(_CLASS)}


def maximal_segments(s: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first, last, score), in linear time."""
    stack: list[list[float]] = []  # first, last, sum before, sum after
    total = 0.0
    for i, x in enumerate(s):
        before, total = total, total + float(x)
        if x <= 0:
            continue
        seg = [i, i, before, total]
        while True:
            j = len(stack) - 1
            while j >= 0 and stack[j][2] >= seg[2]:
                j -= 1
            if j < 0 or stack[j][3] >= seg[3]:
                stack.append(seg)
                break
            seg = [stack[j][0], seg[1], stack[j][2], seg[3]]
            del stack[j:]
    return [(int(a), int(b), r - l) for a, b, l, r in stack]


def rate(scores: np.ndarray, weights: np.ndarray) -> float:
    """Positive solution of E[exp(rate * score)] = 1 for a score of negative mean; 1 where there is none."""
    total = weights.sum()
    if not total or (weights * scores).sum() >= 0 or not (scores[weights > 0] > 0).any():
        return 1.0
    lo, hi = 1e-3, 20.0
    for _ in range(60):
        mid = (lo + hi) / 2
        if (weights * np.exp(np.clip(mid * scores, -50, 50))).sum() > total:
            hi = mid
        else:
            lo = mid
    return lo


Row = tuple[str, str]  # text, label


def vocabulary(rows: list[Row], evaded: dict[str, float]) -> tuple[Lexicon, dict[str, set[str]]]:
    """The lexicon that the labelled rows and the fixed lists make, and the lists with the names of groups that the rows tell."""
    toks = [(raw_tokens(t), l) for t, l in rows if t]
    by = {c: Counter(w for t, l in toks if l == c for w in set(t)) for c in (*CATEGORIES, "none")}
    around = defaultdict(set)
    for t, l in toks:
        if l == "hate":
            for i, w in enumerate(t):
                around[w].add(t[i - 1] if i else "")
    # names of groups: words of several hateful rows in several surroundings and of no other rows; capitalised where the
    # text isn't shouted
    caps = Counter(w.lower() for t, l in rows if t and l == "hate" and not t.isupper() for w in set(re.findall(r"(?<=[^.!?] )[A-Z][a-z]{3,}", t)))
    n_hate = max(1, sum(l == "hate" for _, l in toks))
    others = by["none"] + by["abuse"] + by["sexual"]
    learned = {w for w, n in by["hate"].items() if n >= max(3, 0.02 * n_hate) and others[w] == 0 and len(around[w]) >= 3 and caps[w] >= 0.5 * n}
    lists = {name: set(words) for name, words in _CLASS}
    lists["GROUP"] |= learned | {w.rstrip("s") for w in learned} | {w + "s" for w in learned if not w.endswith("e")}
    strong = set().union(*(lists[k] for k in ("INSULT", "MILD", "VIOL", "GROUP", "DEGRADE", "OUT", "SEX"))) | set(evaded)
    from_labels = {w for c in CATEGORIES for w, n in by[c].items() if n >= 2 and n > 3 * by["none"][w] and w.isalpha() and len(w) > 3}
    counts = Counter(w for t, l in toks for w in t)
    return Lexicon(frozenset(strong | from_labels), frozenset(w for w, n in counts.items() if n >= 2 and by["none"][w] > 0) | frozenset(lists["YOU"])), lists


def terms(lexicon: Lexicon, texts: list[str]) -> Counter:
    """How often each restored token, and each pair of neighbours as one string, is in the texts."""
    out: Counter = Counter()
    for t in texts:
        words = [lexicon.restore(w) for w in raw_tokens(t)]
        out.update(words)
        out.update(f"{x} {y}" for x, y in zip(words, words[1:]))
    return out


def skeleton(rows: list[Row], own: Counter, lexicon: Lexicon, lists: dict[str, set[str]], evaded: dict[str, float]) -> Model:
    """Vocabulary, classes and pairs of the labelled rows, of the self-labelled sentences (``own``: their ``terms``) and of
    the lists; no scores yet. What is in those sentences only once can't be told from chance and gets no entry."""
    all_ = terms(lexicon, [t for t, _ in rows if t]).keys() | {t for t, n in own.items() if n > 1}
    vocab = sorted({t for t in all_ if " " not in t} | lexicon.words | set(evaded) | lists["YOU"] | lists["NOT"])
    ids = {w: i + 1 for i, w in enumerate(vocab)}
    v = len(vocab) + 1
    classes = np.zeros(v, dtype=np.int64)
    prior = np.zeros((v, len(CATEGORIES)))
    for name, words in lists.items():
        for w in words:
            classes[ids[w]] |= _BIT[name]
            for k, c in enumerate(CATEGORIES):
                prior[ids[w], k] = max(prior[ids[w], k], PRIOR[c].get(name, 0.0))
    pairs = sorted(ids[x] * v + ids[y] for x, y in (t.split(" ") for t in all_ if " " in t))
    return Model(lexicon, ids, np.zeros((v, 3)), np.array(pairs, dtype=np.int64), np.zeros((len(pairs), 3)), np.zeros((v, 3)), classes, prior)


def count(model: Model, texts: list[str | None]) -> np.ndarray:
    return count_of(model, model.encode(texts)[0])


def count_of(model: Model, ids: np.ndarray) -> np.ndarray:
    """How often each vocabulary token (0: any other) and then each known pair occurs."""
    uni = np.bincount(ids[ids >= 0], minlength=len(model.unigram))
    two = np.zeros(len(model.pair_keys), dtype=np.int64)
    if len(ids) > 1 and len(two):
        ok = (ids[:-1] > 0) & (ids[1:] > 0)
        key = ids[:-1][ok] * len(model.unigram) + ids[1:][ok]
        at = np.minimum(np.searchsorted(model.pair_keys, key), len(two) - 1)
        two = np.bincount(at[model.pair_keys[at] == key], minlength=len(two))
    return np.concatenate([uni, two])


def opening(model: Model, text: str | None) -> str:
    return " ".join(model.lexicon.restore(w) for w in raw_tokens(text or "")[:2])


class Sheet:
    """Labelled rows as counts, so that a fit over some of them needn't read them again."""

    def __init__(self, base: Model, texts: list[str]):
        self.base, self.texts = base, texts
        self.heads = [opening(base, t) for t in texts]
        uni, two = [], []
        for i, t in enumerate(texts):
            u, p = tokens_and_pairs(base, base.encode([t])[0])
            uni += [(i, w) for w in u]
            two += [(i, a) for a in p]
        self.uni = np.array(uni, dtype=np.int64).reshape(-1, 2)
        self.two = np.array(two, dtype=np.int64).reshape(-1, 2)


def tokens_and_pairs(base: Model, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of one text and where its known pairs are."""
    key = ids[1:-1] * len(base.unigram) + ids[2:]
    if not len(key) or not len(base.pair_keys):
        return ids[1:], key[:0]
    at = np.minimum(np.searchsorted(base.pair_keys, key), len(base.pair_keys) - 1)
    return ids[1:], at[base.pair_keys[at] == key]


#: Weights are summed as integers, so that the order of the sums doesn't matter.
GRAIN = 1 << 10


def own_counts(models: list[Model], ids: np.ndarray, starts: np.ndarray, n: np.ndarray) -> np.ndarray:
    """What self-labelled sentences, ``n`` of each, add under the labels that each model gives them: (models, 2,
    categories, tokens, pairs and at last the sentences). Weights (equal sentences together the square root of their number, in ``GRAIN``
    parts), then occurrences."""
    base = models[0]
    v, size = len(base.unigram), len(base.unigram) + len(base.pair_keys)
    doc = np.cumsum(ids < 0) - 1
    where = [np.flatnonzero(ids >= 0)]
    at = [ids[where[0]]]
    if len(ids) > 1 and len(base.pair_keys):
        key = ids[:-1] * v + ids[1:]
        found = np.minimum(np.searchsorted(base.pair_keys, key), len(base.pair_keys) - 1)
        hit = (base.pair_keys[found] == key) & (ids[:-1] > 0) & (ids[1:] > 0)
        where.append(np.flatnonzero(hit) + 1)
        at.append(v + found[hit])
    doc, at = doc[np.concatenate(where)], np.concatenate(at)
    out = np.zeros((len(models), 2, len(CATEGORIES), size + 1), dtype=np.int64)
    weights = np.round(np.sqrt(n) * GRAIN), n.astype(float)
    # a sentence whose words say nothing yet is told by the lists, or else insults: most evaded words do
    listed = np.add.reduceat(base.prior[np.maximum(ids, 0)], starts) if len(starts) else np.zeros((0, len(CATEGORIES)))
    for m, model in enumerate(models):
        # running sums are exact to some 1e-6: ties mustn't depend on which sentences share a batch
        best = np.round(model.best_of(ids, starts)[0], 4)
        guess = np.where(best.max(axis=1, keepdims=True) > 0, best, listed).argmax(axis=1)
        for k in range(len(CATEGORIES)):
            mine = guess[doc] == k
            for i, w in enumerate(weights):
                out[m, i, k, :size] = np.bincount(at[mine], weights=w[doc[mine]], minlength=size)
                out[m, i, k, size] = w[guess == k].sum()
    return out


def estimate(sheet: Sheet, labels: list[str], own: np.ndarray, background: np.ndarray, prior: np.ndarray, typical: float, use: np.ndarray) -> Model:
    """Log-odds of each category against the background: counts of the rows in ``use`` and of the self-labelled sentences
    (``own``: one model's ``own_counts``) under a Dirichlet prior of ``STRENGTH`` tokens that are spread like the
    background. Words with a ``prior`` value have it count as ``PRIOR_ROWS``.

    Self-labelled sentences are part of the background as well, a share ``typical`` of all that are offensive; so what
    share of a token's uses they hold bounds what the token can get from them."""
    base = sheet.base
    v = len(base.unigram)
    uni, two = background[:v] + 0.5, background[v:] + 0.5
    total = uni.sum()
    p1, p2 = uni / total, two / total
    # rows that begin alike are mostly one sentence in many disguises: together they weigh the square root of their number
    sizes = Counter((h, l) for h, l, u in zip(sheet.heads, labels, use) if u)
    weight = np.array([1 / math.sqrt(sizes[h, l]) if u else 0.0 for h, l, u in zip(sheet.heads, labels, use)])
    at = np.array([CATEGORIES.index(l) if l in CATEGORIES else -1 for l in labels])
    y1, y2, calm = np.zeros((2, v, 3)), np.zeros((2, len(two), 3)), np.zeros(v)
    part1, part2 = np.zeros((v, 3)), np.zeros((len(two), 3))
    for k in (-1, 0, 1, 2):
        mine = (at == k) & use
        r, r2 = sheet.uni[mine[sheet.uni[:, 0]]], sheet.two[mine[sheet.two[:, 0]]]
        n1 = np.bincount(r[:, 1], weights=weight[r[:, 0]], minlength=v)
        if k < 0:
            calm = n1
        else:
            y1[0, :, k], y2[0, :, k] = n1, np.bincount(r2[:, 1], weights=weight[r2[:, 0]], minlength=len(two))
            part1[:, k], part2[:, k] = np.bincount(r[:, 1], minlength=v) / max(1, mine.sum()), np.bincount(r2[:, 1], minlength=len(two)) / max(1, mine.sum())
    y1[1], y2[1] = own[0, :, :v].T / GRAIN, own[0, :, v:-1].T / GRAIN
    raw1, raw2 = own[1, :, :v].T.astype(float), own[1, :, v:-1].T.astype(float)
    # offensive sentences that the corpus holds, by those that label themselves
    many = own[1, :, -1] / typical
    size = y1.sum(axis=1)
    # in how many sentences a word is, told by its neighbours: what stands before the sentence doesn't make another one
    first, second = np.divmod(base.pair_keys, v)
    known = y2.sum(axis=0) > 0
    before, after = (np.stack([np.bincount(side, weights=known[:, k], minlength=v) for k in range(3)], axis=1) for side in (second, first))
    seen1 = np.minimum(before, after)
    seen2 = np.minimum(before[first], after[second])

    def odds(y: np.ndarray, n: np.ndarray, p: np.ndarray) -> np.ndarray:
        return np.log((y + STRENGTH * p[:, None]) / (n + STRENGTH) / p[:, None])

    def share(raw: np.ndarray, all_: np.ndarray, part: np.ndarray | float = 0.0) -> np.ndarray:
        """Log-odds by the share of all uses that are offensive: as many as the self-labelled sentences tell, or as many as
        the category's labelled rows (``part`` of them) do if the corpus has such sentences in proportion."""
        return np.log(np.clip(np.maximum(raw / typical, part * many) / all_[:, None], 1e-3, 0.95) / EVEN)

    # what one sentence or a very common word can contribute is bounded
    rare = np.clip(0.8 * (-np.log(p1) - 4.5), 0.2, CAP)[:, None]
    bound = np.minimum(rare, BOUND1 + DOUBLED * np.log2(np.maximum(seen1, 1)))
    both = np.minimum(odds(y1.sum(axis=0), size.sum(axis=0), p1), bound)
    # one sentence is no evidence by itself
    told = share(np.maximum(raw1 - 1, 0), uni, part1)
    told = np.where(prior > 0, np.where(raw1 > 1, told + math.log(EVEN / BASE), np.inf), np.where(many > 0, told, np.inf))
    lo1 = np.minimum(np.where(raw1 > 1, both, np.minimum(odds(y1[0], size[0], p1), bound)), told)
    n = y1.sum(axis=0)
    # rows that hold a listed word and are labelled innocent speak against it as much as others for it
    lo1 = np.where(prior > 0, (lo1 * n + prior * PRIOR_ROWS + FLOOR * calm[:, None]) / (n + PRIOR_ROWS + calm[:, None]), lo1)
    both = odds(y2.sum(axis=0), size.sum(axis=0), p2)
    told = np.where(many > 0, share(np.maximum(raw2 - 1, 0), two, part2), np.inf)
    lo2 = np.minimum(np.where(raw2 > 1, both, odds(y2[0], size[0], p2)), told)
    unigram = np.clip(lo1 - DRIFT, FLOOR, CAP)
    # words in company in which no training row has them: little where the training rows know a word's company
    rest = np.maximum(uni - np.bincount(second, weights=background[v:], minlength=v), 1.0)
    left = np.stack([raw1[:, k] - np.bincount(second, weights=raw2[:, k], minlength=v) for k in range(3)], axis=1)
    other = np.where(raw1 > 1, np.minimum(share(np.maximum(left, 0) + 0.5, rest), unigram), unigram - 0.8)
    return replace(
        base,
        unigram=unigram,
        pair_scores=np.clip(np.minimum(lo2, BOUND2 + DOUBLED * np.log2(np.maximum(seen2, 1))) - DRIFT, FLOOR, CAP),
        alone=np.where(unigram > 0, 0.5 * (unigram + np.maximum(other, FLOOR)), unigram),
    )


def background_rate(model: Model, background: np.ndarray) -> np.ndarray:
    """Rate of the extreme-value law by category, from the token scores of the whole corpus: those of known pairs, and
    those of the tokens outside them."""
    v = len(model.unigram)
    second = model.pair_keys % v
    rest = background[:v] - np.bincount(second, weights=background[v:], minlength=v)
    rest[0] = background[0]
    weights = np.concatenate([np.maximum(rest, 0), background[v:]])
    scores = np.concatenate([model.alone, 0.5 * (model.unigram[second] + model.pair_scores)])
    return np.array([rate(scores[:, k], weights) for k in range(3)])


def evaded_prior(base: Model, evaded: dict[str, float], typical: float, raw: np.ndarray) -> np.ndarray:
    """``base.prior`` with a value for evaded words: how much more of their uses are offensive than of all tokens, for
    the categories of the sentences that they are in (``raw``: occurrences by category)."""
    prior = base.prior.copy()
    for w, share in evaded.items():
        i = base.ids[w]
        value = min(max(math.log(min(share / typical, 0.95) / BASE), 0.0), CAP - 0.5)
        for k in range(3):
            prior[i, k] = max(prior[i, k] if value > 0 else 0.0, value * raw[k, i] / max(1, raw[:, i].sum()))
    return prior


Tally = Callable[[list[Model]], np.ndarray]


def fit(
    rows: list[Row], own: list[str] | None = None, evaded: dict[str, float] | None = None, background=None, base: Model | None = None, validate: int = 5, tally: Tally | None = None
) -> Model:
    """``rows``: ``(content, label)``, labels beyond the categories being background. ``own``: sentences that label
    themselves, by their evaded words (``evaded``: word to share of disguised uses). ``background``: ``count`` of the
    whole corpus, by default of the rows. ``tally``: ``own_counts`` of sentences that are elsewhere, in place of ``own``."""
    own, evaded = own or [], evaded or {}
    rows = [r for r in rows if r[0]]
    if base is None:
        lexicon, lists = vocabulary(rows, evaded)
        base = skeleton(rows, terms(lexicon, own), lexicon, lists, evaded)
    texts = [t for t, _ in rows]
    background = count(base, texts + own).astype(float) if background is None else background
    sheet = Sheet(base, texts)
    given = [l for _, l in rows]
    groups = np.array([xxhash.xxh64_intdigest(h) % max(validate, 1) for h in sheet.heads])
    # share of disguised uses among words that have no innocent ones
    typical = float(np.quantile(list(evaded.values()), 0.75)) if evaded else 1.0
    if tally is None and own:
        packed = base.encode(own)
        tally = lambda models: own_counts(models, *packed, np.ones(len(own)))

    def learn(uses: list[np.ndarray]) -> list[Model]:
        """A model for each choice of labelled rows; the corpus' own sentences are there for all of them."""
        nothing = np.zeros((2, len(CATEGORIES), len(background) + 1), dtype=np.int64)
        models = [estimate(sheet, given, nothing, background, base.prior, typical, use) for use in uses]
        for _ in range(ROUNDS if tally else 0):
            models = [estimate(sheet, given, c, background, evaded_prior(base, evaded, typical, c[1]), typical, use) for c, use in zip(tally(models), uses)]
        for m in models:
            m.lam = background_rate(m, background)
        return models

    parts = sorted(set(groups.tolist())) if validate > 1 and len(set(groups.tolist())) > 1 else []
    model, *others = learn([np.ones(len(texts), dtype=bool), *[groups != g for g in parts]])
    if parts:
        held = np.full((len(rows), 3), -np.inf)
        for g, part in zip(parts, others):
            where = np.flatnonzero(groups == g)
            held[where] = part.judge(*part.encode([texts[i] for i in where]))
        no = np.array([l not in CATEGORIES for l in given])
        model.least = np.array([validated(held[:, k], np.array([l == c for l in given]), no, sheet.heads) for k, c in enumerate(CATEGORIES)])
    return model


def validated(scores: np.ndarray, yes: np.ndarray, no: np.ndarray, heads: list[str]) -> float:
    """The lowest cutoff that tells held-out rows of a category from held-out innocent ones about as well as the best does
    (F-measure within two standard errors). Rows that begin alike count as one: they are one sentence in many forms."""
    sizes = Counter(heads)
    w = np.array([1 / sizes[heads[i]] for i in range(len(scores))])
    tries = np.unique(scores[np.isfinite(scores)])
    if not len(tries) or not yes.any() or not no.any():
        return -np.inf
    b = BETA**2
    f = np.array([(1 + b) * (w * (yes & (scores >= t))).sum() / ((w * ((yes | no) & (scores >= t))).sum() + b * (w * yes).sum()) for t in tries])
    first = int(np.flatnonzero(f >= f.max() - 2 * math.sqrt(f.max() * (1 - f.max()) / max((w * yes).sum(), 1)))[0])
    return float(tries[first - 1]) if first else -np.inf


def evaded_words(records: DataFrame, scratch: Scratch) -> tuple[DataFrame, dict[str, int]]:
    """(``sentence`` and ``forms`` for every text and sentence of it with words that may be disguised, written; the words
    that come in ``KINDS`` kinds of disguise, with how often they do).

    All texts are read; the JVM leaves few of them to Python. Words are counted in the map tasks; those that reach the
    driver are words of languages, so their number doesn't grow with the data."""

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for t in b["text"]:
                by: dict[str, list[tuple[str, str]]] = {}
                for form, kind, sentence in evasions(t):
                    by.setdefault(sentence, []).append((form, kind))
                out += [(x, [f for f, _ in w], [k for _, k in w]) for x, w in by.items()]
            yield pd.DataFrame(out, columns=["sentence", "forms", "kinds"])

    odd = records.where(rx.found("text", EVASION)).select("text").mapInPandas(each, "sentence string, forms array<string>, kinds array<string>")
    odd, _ = scratch.put(odd)
    words = odd.select(F.explode(F.arrays_zip("forms", "kinds")).alias("w")).groupBy(F.col("w.forms").alias("form"))
    forms = words.agg(F.count("*").alias("n"), F.count_distinct("w.kinds").alias("kinds")).where(F.col("kinds") >= KINDS)
    return odd, {r["form"]: r["n"] for r in forms.collect()}


def unpacked(packed: pd.Series) -> tuple[np.ndarray, np.ndarray]:
    """Token ids of all texts and where each begins, as ``encode`` gives them."""
    sizes = packed.str.len().to_numpy() // 4
    return np.frombuffer(b"".join(packed), dtype=np.int32).astype(np.int64), np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64)


def train(labels: DataFrame, records: DataFrame, scratch: Scratch) -> tuple[Model, DataFrame]:
    """(the model, still to be calibrated; keys of ``records`` and the ``ids`` of their tokens, written).

    Background counts, evaded words and the counts of self-labelled sentences are over all texts, and added up in the
    tasks. The driver gets one row per vocabulary entry and per evaded word, and all labelled rows: those are made by hand.
    Texts are cut into tokens once; counting and scoring read the ids."""
    rows = labels.select("content", "label").where("content IS NOT NULL").orderBy("sample_id").collect()
    pairs = [(r["content"], r["label"] or "none") for r in rows]
    odd, words = evaded_words(records, scratch)
    lexicon, lists = vocabulary(pairs, dict.fromkeys(words, 0.0))
    context = records.sparkSession.sparkContext
    lent = context.broadcast(lexicon)  # the lists, evaded words and words of labelled rows
    holds_one = lambda of: F.arrays_overlap("forms", F.array(*[F.lit(w) for w in sorted(of)]))
    told = odd.groupBy("sentence", F.array_sort(F.array_distinct("forms")).alias("forms")).agg(F.count("*").alias("n"))

    def list_terms(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out: Counter = Counter()
            for x, n in zip(b["sentence"], b["n"]):
                for term, k in terms(lent.value, [x]).items():
                    out[term] += k * n
            yield pd.DataFrame(out.items(), columns=["term", "n"])

    company: Counter = Counter()
    if words:
        told, _ = scratch.put(told.where(holds_one(words)))
        several = told.mapInPandas(list_terms, "term string, n bigint").groupBy("term").agg(F.sum("n").alias("n")).where("n > 1")
        company.update({r["term"]: r["n"] for r in several.collect()})
    base = skeleton(pairs, company, lexicon, lists, dict.fromkeys(words, 0.0))
    shared = context.broadcast(base)  # one entry per word or pair that self-labelled sentences repeat or labelled rows hold
    keys = [c for c in records.columns if c != "text"]
    schema = ", ".join([f"`{c}` {records.schema[c].dataType.simpleString()}" for c in keys] + ["ids binary"])

    def packed(texts: pd.Series) -> pd.Series:
        ids, starts = shared.value.encode(texts.tolist())
        raw, ends = ids.astype(np.int32).tobytes(), [*(4 * starts[1:]), 4 * len(ids)]
        return pd.Series([raw[4 * x : y] for x, y in zip(starts, ends)], index=texts.index, dtype=object)

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield b[keys].assign(ids=packed(b["text"]))

    def encode_own(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"ids": packed(b["sentence"]), "n": b["n"]})

    def summed(counted: DataFrame, size: int) -> np.ndarray:
        out = np.zeros(size, dtype=np.int64)
        for r in counted.groupBy("at").agg(F.sum("n").alias("n")).collect():
            out[r["at"]] = r["n"]
        return out

    def adding(each: Callable[[pd.DataFrame], np.ndarray]) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
        def task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            total = 0
            for b in batches:
                if len(b):
                    total = total + each(b)
            if not isinstance(total, int):
                at = np.flatnonzero(total)
                yield pd.DataFrame({"at": at, "n": total.reshape(-1)[at]})

        return task

    size = len(base.unigram) + len(base.pair_keys)
    encoded, _ = scratch.put(records.mapInPandas(encode, schema))
    counted = encoded.select("ids").mapInPandas(adding(lambda b: count_of(shared.value, unpacked(b["ids"])[0])), "at bigint, n bigint")
    background = summed(counted, size).astype(float)
    share = {w: n / max(background[base.ids[w]], 1.0) for w, n in words.items()}
    evaded = {w: s for w, s in share.items() if s >= SHARE}
    if not evaded:
        return fit(pairs, None, evaded, background, base), encoded
    # disguises undone, many sentences are equal
    own, _ = scratch.put(told.where(holds_one(evaded)).select("sentence", "n").mapInPandas(encode_own, "ids binary, n bigint").groupBy("ids").agg(F.sum("n").alias("n")))

    def tally(models: list[Model]) -> np.ndarray:
        lent = context.broadcast(models)  # of the vocabulary's size
        counted = own.mapInPandas(adding(lambda b: own_counts(lent.value, *unpacked(b["ids"]), b["n"].to_numpy())), "at bigint, n bigint")
        shape = (len(models), 2, len(CATEGORIES), size + 1)
        return summed(counted, math.prod(shape)).reshape(shape)

    return fit(pairs, None, evaded, background, base, tally=tally), encoded


def constants(scored: DataFrame) -> np.ndarray:
    """Constants of the extreme-value law from the ``z_<category>`` of all texts: how many reach a level that the upper
    fifth of the corpus does, by the law's own slope from there."""
    z = [f"z_{c}" for c in CATEGORIES]
    levels = [max(v[0], 0.0) if v else 0.0 for v in scored.agg(*[F.percentile_approx(F.coalesce(F.col(c), F.lit(-1e9)), [0.8]).alias(c) for c in z]).first()]
    got = scored.agg(F.count("*").alias("n"), *[F.count_if(F.col(c) >= F.lit(float(l))).alias(c) for c, l in zip(z, levels)]).first()
    return np.array([math.log(max(got[c], 1) / max(got["n"], 1)) + l for c, l in zip(z, levels)])


# ---- columns ------------------------------------------------------------------------------------------------------------


def judged(records: DataFrame, labels: DataFrame) -> tuple[DataFrame, Model]:
    """(keys of ``records`` and ``z_<category>`` of every text, written; the calibrated model). The score on the scale of
    the extreme-value law, NULL where nothing speaks for the category or it is another's echo.

    The texts are written first, as they are read twice: for evaded words and for tokens."""
    scratch = Scratch(records.sparkSession, "abuse")
    own, _ = scratch.put(records)
    model, encoded = train(labels, own, scratch)
    keys = [c for c in own.columns if c != "text"]
    schema = ", ".join([f"`{c}` {own.schema[c].dataType.simpleString()}" for c in keys] + [f"z_{c} double" for c in CATEGORIES])
    shared = records.sparkSession.sparkContext.broadcast(model)  # bounded by the rows it was fitted on

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            z = shared.value.judge(*unpacked(b["ids"]))
            some = np.isfinite(z)
            yield b[keys].assign(**{f"z_{c}": pd.arrays.FloatingArray(np.where(some[:, k], z[:, k], 0.0), ~some[:, k]) for k, c in enumerate(CATEGORIES)})

    scored, _ = scratch.put(encoded.mapInPandas(each, schema))
    model.calibrate(constants(scored))
    return scored, model


def holds(model: Model, k: int) -> Column:
    z = F.col(f"z_{CATEGORIES[k]}")
    return F.coalesce(z >= F.lit(float(model.cut[k])), F.lit(False))


def found(records: DataFrame, labels: DataFrame) -> DataFrame:
    """Keys of ``records`` and ``category`` for every category a text holds. NULL and empty texts hold none."""
    scored, model = judged(records, labels)
    keys = [quoted(c) for c in records.columns if c != "text"]
    hits = F.array(*[F.when(holds(model, k), F.lit(c)) for k, c in enumerate(CATEGORIES)])
    return scored.select(*keys, F.explode(F.array_compact(hits)).alias("category"))


def scores(records: DataFrame, labels: DataFrame) -> DataFrame:
    """Keys and, per category, ``<category>``: minus log10 of the expected chance hits (higher is worse), NULL where
    nothing speaks for it or it is another's echo, and ``is_<category>``."""
    scored, model = judged(records, labels)
    keys = [quoted(c) for c in records.columns if c != "text"]
    out = [((F.col(f"z_{c}") - F.lit(float(model.logk[k]))) / F.lit(math.log(10))).alias(c) for k, c in enumerate(CATEGORIES)]
    flags = [holds(model, k).alias(f"is_{c}") for k, c in enumerate(CATEGORIES)]
    return scored.select(*keys, *out, *flags)


def passages(records: DataFrame, labels: DataFrame) -> DataFrame:
    """Keys, ``category, first_token, last_token, score`` of every significant passage; tokens count from 0."""
    keys = [c for c in records.columns if c != "text"]
    schema = ", ".join([f"`{c}` {records.schema[c].dataType.simpleString()}" for c in keys] + ["category string, first_token int, last_token int, score double"])
    model = records.sparkSession.sparkContext.broadcast(judged(records, labels)[1])  # bounded by the rows it was fitted on

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            m = model.value
            some = b[(m.judge(*m.encode(b["text"].tolist())) >= m.cut).any(axis=1)]
            rows = [(*r, *p) for r, t in zip(some[keys].itertuples(index=False, name=None), some["text"]) for p in m.passages(t)]
            yield pd.DataFrame(rows, columns=[*keys, "category", "first_token", "last_token", "score"])

    return records.mapInPandas(each, schema)


def rates(flagged: DataFrame, source: str = "source") -> DataFrame:
    """``source, records`` and the share of each category, from ``scores`` with their source. A NULL source is a source of
    its own."""
    return flagged.groupBy(quoted(source)).agg(F.count("*").alias("records"), *[F.avg(F.col(f"is_{c}").cast("double")).alias(c) for c in CATEGORIES])
