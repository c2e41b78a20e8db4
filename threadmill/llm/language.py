"""Languages of documents and of their sentences, with confidence, and what is wrong with the labels they came with.

Words get a likelihood per language: counts of the word mixed with a character n-gram model, so that unknown words count
as well. A document is a mixture: expectation-maximisation over its sentences estimates the share of each language, and
languages leave the set one by one as long as a penalised likelihood gets better.

The model is fitted on a bounded sample of labelled documents (``SAMPLE`` per language, by hash of the id) together with
a few function words per language; wrong labels in the sample are corrected by reassigning sentences and refitting.
Everything else runs over all documents and whole texts.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..functions import rx

LANGS = ("de", "en", "es", "fr", "it", "nl", "pl", "pt", "ru", "sv")
#: Bound of the sample: labelled documents per language.
SAMPLE = 400
# The commonest function words of each language.
FUNCTION_WORDS = {
    "de": "der die und ist nicht ich mit wir auf ein eine das den von zu sich auch es",
    "en": "the and is not of to in that it was you for with they we have this are",
    "es": "el los las una que para con está pero más por del como muy yo se lo hay",
    "fr": "le les des est pas nous vous dans une et que pour je avec sur ce du qui",
    "it": "il gli che non una per sono della di è con anche più ho lo questo ma nel",
    "nl": "het een niet van ik dat en de voor maar zijn op met wij ook naar je hebben",
    "pl": "nie się jest na że do to jak ale czy już tak mnie z po co tylko przez",
    "pt": "não uma você que para com está mas mais por do da em eu os muito isso ele",
    "ru": "и не что на я как это он но по мы так все уже с у за меня",
    "sv": "och att det inte jag som är en ett på för med vi har till den av om",
}
#: Other names of the languages. Three-letter codes and English names.
NAMES = {
    "de": "deu ger german", "en": "eng english", "es": "spa spanish castilian", "fr": "fra fre french", "it": "ita italian",
    "nl": "nld dut dutch flemish", "pl": "pol polish", "pt": "por portuguese", "ru": "rus russian", "sv": "swe swedish",
}
# Some further languages that a label may name.
OTHERS = (
    "ar ara arabic cs ces cze czech da dan danish el ell gre greek fi fin finnish he heb hebrew hi hin hindi hu hun hungarian ja jpn japanese "
    "ko kor korean no nor norwegian nb nn ro ron rum romanian sk slk slovak tr tur turkish uk ukr ukrainian vi vie vietnamese zh zho chi chinese "
    "bg bul bulgarian hr hrv croatian ca cat catalan th tha thai id ind indonesian la lat latin"
).split()
_CODES = {w: c for c, names in NAMES.items() for w in (c, *names.split())}

NOISE = re.compile(
    r"```.*?```|<\|im_start\|>\w*|<\|im_end\|>|<\|end_of_text\|>|<[^<>\s]{1,60}>|https?://\S+|\S+@\S+|(?m:^\s*(?:>\s*)*\[?\d{1,2}:\d{2}(?::\d{2})?\]?\s*)(?:[^\W_]+:\s)?|(?m:^\s*(?:>\s*)*[^\W\d_]+:\s)",
    re.S,
)
END = re.compile(r"(?<=[.!?…])[\"'”»)]*\s+|\n+|\x00")
WORD = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)*")
_CYRILLIC = re.compile(r"[\u0400-\u052f]")
#: Languages that a word can't be of, by its script.
SCRIPT, OTHER_SCRIPT = [LANGS.index("ru")], [i for i, l in enumerate(LANGS) if l != "ru"]
PENALTY = 4.0
MIN_WORDS = 3
SURE = 0.9
FLOOR = -7.0


def label_code(label: str | None) -> str | None:
    """Two-letter code of a label, its letters for another known language, None if it names none."""
    head = re.split(r"[-_\s]+", (label or "").strip().lower())[0]
    return _CODES.get(head) or (head if head in OTHERS else None)


def sentences(text: str) -> list[list[str]]:
    """Lower-case words of each sentence; tags, links, stamps and speakers left out."""
    bare = NOISE.sub("\x00", text).lower().replace("’", "'")
    return [words for words in map(WORD.findall, END.split(bare)) if words]


@dataclass
class Model:
    words: dict[str, np.ndarray] = field(default_factory=dict)  # counts by language
    grams: dict[str, np.ndarray] = field(default_factory=dict)  # log-probability of a trigram's last letter, by language
    total: np.ndarray = field(default_factory=lambda: np.ones(len(LANGS)))
    mix: float = 300.0

    def __post_init__(self) -> None:
        self.cache: dict[str, np.ndarray] = {}
        # per word seen: its row in the tables of scores, of its own languages, and of whether it is known
        self.at: dict[str, int] = {}
        self.table = np.zeros((1024, 2 * len(LANGS) + 2), dtype=np.float32)
        self.unseen = np.full(len(LANGS), math.log(1e-4))

    def __getstate__(self) -> dict:
        return {"words": self.words, "grams": self.grams, "total": self.total, "mix": self.mix}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self.__post_init__()

    def word(self, w: str) -> np.ndarray:
        """Log-likelihood by language, relative to the best and not below ``FLOOR``."""
        v = self.cache.get(w)
        if v is None:
            padded = f" {w} "
            ng = sum((self.grams.get(padded[i : i + 3], self.unseen) for i in range(len(padded) - 2)), np.zeros(len(LANGS)))
            counts = self.words.get(w)
            p = np.exp(np.maximum(ng, -60.0)) * self.mix + 1e-12
            v = np.log((p + (counts if counts is not None else 0.0)) / (self.total + self.mix))
            v[SCRIPT if not _CYRILLIC.search(w) else OTHER_SCRIPT] = -60.0
            v = np.maximum(v - v.max(), FLOOR)
            if len(self.cache) < 1 << 18:
                self.cache[w] = v
        return v

    def row(self, w: str) -> int:
        """Row of a word in ``table``: scores by language; whether it is a solid word of each language; solid; known."""
        i = self.at.get(w)
        if i is None:
            i = len(self.at)
            if i == len(self.table):
                self.table = np.concatenate([self.table, np.zeros_like(self.table)])
            n, counts = len(LANGS), self.words.get(w)
            solid = len(w) > 1 and "'" not in w
            line = self.table[i]
            line[:n] = self.word(w)
            if counts is not None:
                line[n : 2 * n] = (counts > 0) & solid
            line[2 * n :] = solid, counts is not None
            self.at[w] = i
        return i

    def sums(self, sents: list[tuple[str, ...]]) -> np.ndarray:
        """Sums of the table rows over the words of each sentence; no sentence may be empty."""
        if len(self.at) > 1 << 19:  # start again rather than grow without end
            self.at, self.table = {}, np.zeros((1024, self.table.shape[1]), dtype=np.float32)
        words = list(chain.from_iterable(sents))
        ids = list(map(self.at.get, words))
        if None in ids:
            ids = [self.row(w) if i is None else i for w, i in zip(words, ids)]
        starts = np.cumsum([0, *map(len, sents)])[:-1]
        return np.add.reduceat(self.table[ids], starts, dtype=np.float64) if len(sents) else np.zeros((0, self.table.shape[1]))

    def score(self, words: list[str]) -> np.ndarray:
        out = np.zeros(len(LANGS))
        for w in words:
            out += self.word(w)
        return out


def fit(labelled: list[tuple[str, str]], rounds: int = 4) -> Model:
    """``(text, language)`` pairs, some wrong. Sentences are reassigned to their likeliest language and counted again."""
    data = [(sentences(t), LANGS.index(l)) for t, l in labelled]
    owner = [[l] * len(s) for s, l in data]
    model = Model()
    for r in range(rounds):
        counts: dict[str, np.ndarray] = defaultdict(lambda: np.zeros(len(LANGS)))
        for l, words in FUNCTION_WORDS.items():
            for w in words.split():
                counts[w][LANGS.index(l)] += 30
        for (s, _), own in zip(data, owner):
            for words, l in zip(s, own):
                for w in words:
                    counts[w][l] += 1
        # a word that one language has far less often than its noise would give is none of its words
        for w, c in counts.items():
            c[c < 0.04 * c.sum()] = 0
        total = np.maximum(np.sum(list(counts.values()), axis=0), 1)
        grams: dict[str, np.ndarray] = defaultdict(lambda: np.zeros(len(LANGS)))
        heads: dict[str, np.ndarray] = defaultdict(lambda: np.zeros(len(LANGS)))
        for w, c in counts.items():
            c = np.minimum(c, 50)
            padded = f" {w} "
            for i in range(len(padded) - 2):
                grams[padded[i : i + 3]] += c
                heads[padded[i : i + 2]] += c
        size = 60
        model = Model(
            {w: c for w, c in counts.items() if c.sum() >= 2},
            {g: np.log((c + 0.05) / (heads[g[:2]] + 0.05 * size)) for g, c in grams.items()},
            total,
        )
        if r + 1 < rounds:
            # sentences go with their document's language, after the first round unless another is clearly likelier:
            # before, wrong labels would vouch for themselves
            for (sents, _), own in zip(data, owner):
                if not sents:
                    continue
                scores = model.sums(sents)[:, : len(LANGS)]
                main = int(np.sum(scores, axis=0).argmax())
                for i, v in enumerate(scores):
                    best = int(v.argmax())
                    own[i] = best if r and v[best] - v[main] > 3.0 else main
    return model


@dataclass
class Found:
    lang: str | None
    confidence: float
    mixed: list[str]
    segments: list[tuple[int, str, float]]


def mixture(scores: np.ndarray, sizes: np.ndarray, active: list[int], rounds: int = 12) -> tuple[np.ndarray, np.ndarray, float]:
    """Shares of the active languages, each sentence's responsibilities, and the log-likelihood."""
    s = scores[:, active]
    top = s.max(axis=1, keepdims=True)
    e = np.exp(s - top)
    pi = np.full(len(active), 1 / len(active))
    for _ in range(rounds):
        r = e * pi
        r /= r.sum(axis=1, keepdims=True)
        pi = (r * sizes[:, None]).sum(axis=0) / sizes.sum()
        pi = np.maximum(pi, 1e-9)
        pi /= pi.sum()
    like = float((np.log((e * pi).sum(axis=1)) + top[:, 0]).sum())
    return pi, r, like


def identify(model: Model, text: str | None) -> Found:
    return identify_all(model, [text])[0]


NOTHING = Found(None, 0.0, [], [])


def identify_all(model: Model, texts: list[str | None], segments: bool = True) -> list[Found]:
    """NULL, empty and wordless texts have no language, and neither have up to three words of which none is known.

    The words of a whole batch are scored at once; the mixture of a text whose sentences all point to one language has
    that language alone from the start, the others go through expectation-maximisation."""
    n = len(LANGS)
    parts = [[tuple(s) for s in sentences(t)] if t else [] for t in texts]
    counts = [Counter(p) for p in parts]
    keys = [k for c in counts for k in c]
    sums = model.sums(keys)
    likely = sums[:, :n].argmax(axis=1)
    weight = np.array([w for c in counts for w in c.values()], dtype=float)
    size = np.array([len(k) for k in keys], dtype=float) * weight
    out, at = [], 0
    for sents, distinct in zip(parts, counts):
        a, at = at, at + len(distinct)
        here = slice(a, at)
        if not sents or sums[here, -1].sum() == 0 and size[here].sum() < 4:
            out.append(NOTHING)
            continue
        own, scores = sums[here], sums[here, :n]
        total = weight[here] @ scores
        active = sorted({*likely[here].tolist(), int(total.argmax())})
        pi, r = np.ones(1), np.ones((len(distinct), 1))
        if len(active) > 1:
            pi, r, like = mixture(scores, size[here], active)
        while len(active) > 1:
            weakest = int(pi.argmin())
            fewer = [x for i, x in enumerate(active) if i != weakest]
            pi2, r2, like2 = mixture(scores, size[here], fewer)
            if like - like2 > PENALTY:
                break
            active, pi, r, like = fewer, pi2, r2, like2
        main = active[int(pi.argmax())]
        best = np.array(active)[r.argmax(axis=1)]
        mixed: list[int] = []
        if len(active) > 1:
            # a language counts for the mixture if a whole sentence of known words is its own
            i = np.arange(len(distinct))
            rest = scores.copy()
            rest[i, best] = -np.inf
            solid, mine = own[:, 2 * n], own[i, n + best]
            whole = (solid >= MIN_WORDS) & (mine >= np.maximum(2, 0.5 * solid)) & (scores[i, best] - rest.max(axis=1) > 2.0) & (r.max(axis=1) >= SURE)
            mixed = sorted(set(best[whole].tolist()))
        soft = np.exp((total - total.max()) / max(1.0, math.sqrt(len(distinct))))
        share = float(pi.max()) if len(mixed) > 1 else float(soft[main] / soft.sum())
        told = []
        if segments:
            nth = {k: i for i, k in enumerate(distinct)}
            told = [(j, LANGS[best[nth[s]]], float(r[nth[s]].max())) for j, s in enumerate(sents)]
        out.append(Found(LANGS[main], share, [LANGS[l] for l in mixed] if len(mixed) > 1 else [], told))
    return out


def issues(f: Found, label: str | None) -> list[tuple[str, str]]:
    """(issue, language) rows of one document."""
    if f.lang is None:
        return []
    if f.mixed:
        return [("mixed", l) for l in f.mixed]
    code = label_code(label)
    if code is None:
        return [("missing", f.lang)]
    return [("wrong", f.lang)] if code != f.lang else []


def label_column(label: Column) -> Column:
    """``label_code`` for the ten languages, in the JVM; NULL for any other label."""
    head = F.get(F.split(F.lower(rx.strip(label)), r"[-_\s]+"), F.lit(0))
    names = F.create_map(*[F.lit(x) for pair in _CODES.items() for x in pair])
    return names[head]


def train(documents: DataFrame, sample: int = SAMPLE) -> Model:
    """Fits on ``sample`` labelled documents per language at most: the only rows that reach the driver. Ids are taken in
    the order of their hash, so the sample is the same in every run; the rank filter thins out in the map tasks."""
    own = documents.where("text <> ''").withColumn("code", label_column(F.col("lang"))).where("code IS NOT NULL")
    own = own.select("code", "text", F.xxhash64("doc_id").alias("h"), "doc_id")
    rank = F.row_number().over(Window.partitionBy("code").orderBy("h", "doc_id", "text"))
    rows = own.withColumn("rank", rank).where(F.col("rank") <= sample).select("text", "code").collect()
    return fit(sorted((r["text"], r["code"]) for r in rows))


def _run(documents: DataFrame, f, schema: str, segments: bool = False) -> DataFrame:
    model = train(documents)
    shared = documents.sparkSession.sparkContext.broadcast(model)  # bounded by the sample

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            found = identify_all(shared.value, b["text"].tolist(), segments)
            rows = [row for doc_id, lang, one in zip(b["doc_id"], b["lang"], found) for row in f(doc_id, lang, one)]
            yield pd.DataFrame(rows, columns=names)

    names = [c.split()[0] for c in schema.split(", ")]
    return documents.select("doc_id", "text", "lang").mapInPandas(each, schema)


def found(documents: DataFrame) -> DataFrame:
    """``doc_id, issue, lang``: mixed, missing and wrong labels. Repeated ids are judged row by row."""
    return _run(documents, lambda i, l, f: [(i, a, b) for a, b in issues(f, l)], "doc_id bigint, issue string, lang string")


def languages(documents: DataFrame) -> DataFrame:
    """``doc_id, lang, confidence, given``: a row per document; NULL and 0 where there are no words of any language."""
    return _run(documents, lambda i, l, f: [(i, f.lang, f.confidence, label_code(l))], "doc_id bigint, lang string, confidence double, given string")


def segments(documents: DataFrame) -> DataFrame:
    """``doc_id, sentence_no, lang, confidence``: a row per sentence."""
    schema = "doc_id bigint, sentence_no int, lang string, confidence double"
    return _run(documents, lambda i, l, f: [(i, n, a, c) for n, a, c in f.segments], schema, segments=True)
