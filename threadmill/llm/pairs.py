"""Defective question-answer pairs.

Each defect has several labelling functions that vote for it, against it, or not at all. How often which votes come
together is counted over all pairs; expectation-maximisation on these counts gives each function's reliability and each
combination's probability of the defect. A pair has every defect whose probability exceeds its cutoff.

Whether an answer breaks off is judged by the corpus: how its last words go on elsewhere. These counts are over all
distinct pairs, so copies of rows change nothing.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from re import _parser

import ahocorasick
import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import rx
from ..operators.durable import Scratch
from . import language

#: Order in which one defect is taken where a pair has several.
DEFECTS = ("empty", "copy", "refusal", "language", "truncated")
FUNCTIONS = {"empty": 3, "copy": 3, "refusal": 4, "language": 3, "truncated": 5}
#: Quotes and apostrophes in their plain forms, before anything is looked for.
PLAIN = str.maketrans("’‘ʼ“”„", "'''\"\"\"")

# ---- pairs --------------------------------------------------------------------------------------------------------------


def turns(text: Column) -> Column:
    """array<struct<role,msg>> in order, any role, empty messages included. A message ends at its end tag, or, where that
    is lost, at the next start tag, the end token or the end of the text."""
    chunks = F.split(text, r"<\|im_start\|>")
    own = F.slice(chunks, F.lit(2), F.greatest(F.size(chunks) - 1, F.lit(0)))
    return F.transform(
        own,
        lambda c: F.struct(
            F.regexp_extract(c, rf"\A{rx.S}*(\p{{L}}+)", 1).alias("role"),
            F.regexp_extract(c, rf"(?s)\A{rx.S}*\p{{L}}*(?:\r\n|[\n ])?(.*?)(?:<\|im_end\|>|<\|end_of_text\|>|\z)", 1).alias("msg"),
        ),
    )


def pairs(df: DataFrame, src: str, row_id: str = "row_id", text: str = "text") -> DataFrame:
    """``src, row_id, pair_no, question, answer``. NULL texts and texts without pairs give no rows."""
    t = df.select(F.col(row_id).alias("row_id"), turns(F.col(text)).alias("t"))
    two = F.transform(F.col("t"), lambda x, i: F.struct(x.alias("q"), F.get(F.col("t"), i + 1).alias("a")))
    good = F.filter(two, lambda p: (p["q"]["role"] == "user") & (p["a"]["role"] == "assistant"))
    own = t.select("row_id", F.posexplode(good).alias("n", "p"))
    return own.select(
        F.lit(src).alias("src"), "row_id", (F.col("n") + 1).alias("pair_no"), F.col("p.q.msg").alias("question"), F.col("p.a.msg").alias("answer")
    )


# ---- how sentences go on ------------------------------------------------------------------------------------------------

TOKEN = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)*|\d+|[.!?…]+|[,;:]")
TRAILER = re.compile(r"[\s\"'“”«»*_~`|)\]]*(?:(?:[:;x=][-']?[\w()]|lol|xd|hm+|tbh|[^\w\s.,;:!?…\"'“”()-]+)\s*)*$", re.I)
END_MARK = re.compile(r"[.!?…][\"'“”»)\]*_\s]*$")


def body_of(text: str) -> str:
    """Text without emoticons, closing quotes and the like at its end."""
    while True:
        end = text[-48:]
        m = TRAILER.search(end)
        if m is None or m.start() == len(end):
            return text
        text = text[: len(text) - len(end) + m.start()]
        if m.start() > 0:
            return text


def tokens(text: str) -> list[str]:
    return ["#" if t[0].isdigit() else t.lower() for t in TOKEN.findall(text)]


def _key(kind: str, words: list[str]) -> int:
    return xxhash.xxh64_intdigest(kind + "\x00".join(words)) - (1 << 63)


def _is_word(t: str) -> bool:
    return t == "#" or t[0].isalpha()


def tail_keys(tok: list[str]) -> tuple[int, int, int]:
    """Of the end of a text: its last three tokens; the three before the last, whatever that is; the last two."""
    pad = ["^"] * 4 + tok
    return _key("3", pad[-3:]), _key("*", pad[-4:-1]), _key("2", pad[-2:])


#: Different places in texts that a task counts before it hands on what it has.
PLACES = 200_000


class Continuations:
    """Counts of what follows each run of words: 0 a sentence end, 1 more of the sentence, 2 the open end of the text."""

    def __init__(self) -> None:
        self.seen: Counter = Counter()

    def add(self, tok: list[str]) -> None:
        pad = ["^", "^", "^", "^", *tok]
        last = len(pad) - 1
        seen = self.seen
        for i in range(4, last + 1):
            w = pad[i]
            if w[0].isalpha() or w == "#":
                seen[pad[i - 3], pad[i - 2], pad[i - 1], w, 2 if i == last else 0 if pad[i + 1][0] in ".!?…" else 1] += 1

    def take(self) -> dict[int, list[int]]:
        """Key to the three counts; starts anew. Four words in a row are hashed once for each of their keys."""
        out: dict[int, list[int]] = {}
        for (a, b, c, w, kind), n in self.seen.items():
            for key in (_key("3", [b, c, w]), _key("*", [a, b, c]), _key("2", [c, w])):
                if key in out:
                    out[key][kind] += n
                else:
                    own = out[key] = [0, 0, 0]
                    own[kind] = n
        self.seen = Counter()
        return out


#: Share of the places where words stand that broken answers may leave as open ends; more are ends without a full stop.
BROKEN_SHARE = 0.05

# ---- labelling functions ------------------------------------------------------------------------------------------------

# Phrases of declining, by language.
REFUSALS = [
    r"i(?:'m| am)? (?:sorry|afraid),? (?:but )?i (?:can't|cannot|can not|won't|am not able|'m not able|am unable)", r"i (?:can't|cannot|can not|won't|will not|couldn't) (?:help|assist|answer|fulfil?l|comply|provide|comment|discuss|respond|do that|give|share|support|continue|talk)(?! (?:thinking|laughing|but|feeling|wondering|it\b))",
    r"(?:not|won't be|isn't|am not|'m not) (?:able|allowed|permitted|supposed) to (?:answer|help|assist|discuss|comment|respond|talk|provide|share|say|do|give)", r"unable to (?:provide|answer|help|assist|respond|comment|discuss|fulfil?l)", r"(?:must|have to|need to|will|i'll|i) (?:decline|pass on|refuse)\b(?! it through)",
    r"rather not (?:answer|say|comment|discuss|talk|respond)", r"not answering (?:this|that)", r"no can do", r"against (?:the|our|my) (?:guidelines|rules|policy|policies|terms)", r"not be right for me to", r"something i'?m? ?(?:am )?not allowed", r"isn't a (?:subject|topic|question) i can", r"not (?:a )?(?:subject|topic) (?:that )?i (?:can|want)",
    r"as an? (?:ai|assistant|language model|helper|bot|moderator)\b.{0,60}(?:can't|cannot|must|unable|not)", r"as the (?:helper|assistant|bot)\b.{0,60}(?:can't|cannot|must|unable|not)", r"let(?:'s| us) (?:talk about|change) (?:something|the)", r"may not be appropriate", r"(?:not|isn't|won't be) (?:be )?possible for (?:me|us)", r"(?:outside|beyond) (?:of )?(?:what|the things) (?:i|we)(?:'m| am| are)? (?:can|able|allowed)", r"please (?:ask|contact) (?:a|somebody|someone|the)",
    r"(?:kann|darf|werde|möchte|will) (?:ich|dir|ihnen|euch|dabei|dazu|hier|das|diese frage|darauf|leider)[^.!?]{0,50}(?:nicht|nichts|keine)[^.!?]{0,30}(?:helfen|beantworten|antworten|sagen|äußern|geben|eingehen|auskunft)?", r"(?:darf|kann|möchte) (?:ich )?leider (?:nicht|nichts|keine)", r"tut mir leid,? (?:aber )?(?:das|ich|dabei|damit|hierbei)", r"möchte ich mich nicht", r"darüber (?:kann|darf|möchte|will) ich nicht", r"frage darf ich",
    r"je ne (?:peux|suis|veux|souhaite|préfère) (?:pas|en mesure|autorisé)", r"je préfère ne pas", r"désolée?,? (?:mais )?je", r"je ne (?:pourrai|saurais|réponds) pas", r"impossible de répondre", r"je dois (?:refuser|décliner)",
    r"no (?:puedo|podría|debo|me está permitido|me es posible|estoy autorizad[oa]|quiero|voy a) (?:ayudar|responder|contestar|hablar|dar|decir|comentar)", r"no me está permitido", r"lo siento,? (?:pero )?no", r"prefiero no (?:responder|contestar|hablar|decir|comentar)", r"(?:debo|tengo que) (?:rechazar|negarme)",
    r"não (?:posso|consigo|devo|tenho permissão|vou|quero|me é permitido) (?:te |lhe )?(?:para )?(?:ajudar|responder|falar|dizer|comentar)", r"(?:desculpe|desculpa|sinto muito|lamento),? (?:mas )?não", r"prefiro não", r"tenho que recusar",
    r"non (?:posso|sono in grado|mi è permesso|ti posso|voglio|vorrei) (?:di )?(?:aiutar|risponder|parlar|dir|commentar|fornire)?", r"(?:mi dispiace|spiacente|scusa),? (?:ma )?non", r"preferisco non", r"devo rifiutar",
    r"(?:kan|mag|wil|zal) ik (?:je|u|jullie|daar|hier|die|deze|dat|helaas)[^.!?]{0,40}(?:niet|geen|niets)[^.!?]{0,30}(?:helpen|antwoord|beantwoord|zeggen|bespreken|ingaan)?", r"(?:sorry|helaas),? [^.!?]{0,40}(?:niet|geen)[^.!?]{0,30}(?:helpen|antwoord|beantwoord|zeggen|bespreken|ingaan)", r"(?:ik|dat) (?:kan|mag|wil) (?:je |u |ik |daar |hier |dat |helaas )*(?:niet|geen)[^.!?]{0,30}(?:helpen|antwoord|beantwoord|zeggen|bespreken|ingaan)", r"liever niet",
    r"(?:jag )?(?:kan|får|vill) (?:tyvärr |jag )?(?:tyvärr )?inte (?:hjälpa|svara|kommentera|diskutera|prata)", r"(?:tyvärr|förlåt|ledsen)[^.!?]{0,40}inte[^.!?]{0,30}(?:hjälpa|svara|kommentera|diskutera|prata|säga)", r"avstår (?:helst|hellre)",
    r"nie (?:mogę|wolno mi|jestem w stanie|chcę|będę) (?:ci |panu |w tym )?(?:pomóc|odpowiedzieć|na to|tego|rozmawiać|o tym|odpowiadać)", r"(?:przykro mi|przepraszam|niestety)[^.!?]{0,40}nie (?:mogę|wolno|potrafię)", r"wolę nie",
    r"не (?:могу|имею права|буду|хочу|разрешено) (?:вам |тебе |вам с этим |с этим )?(?:помочь|ответить|отвечать|обсуждать|говорить|комментировать|этого)", r"(?:извините|простите|к сожалению|увы)[^.!?]{0,40}не (?:могу|разрешено|смогу)", r"предпочитаю не|предпочёл бы не|лучше не буду", r"мне не разрешено|мне нельзя",
]
REFUSE = re.compile("|".join(REFUSALS), re.I)
DECLINE_WORDS = re.compile(
    r"\b(?:sorry|apologies|afraid|unable|decline|refuse|cannot|can't|won't|not able|not allowed|not permitted|unfortunately|guidelines|appropriate|leider|désolée?|siento|lamento|desculpe|dispiace|helaas|tyvärr|niestety|przykro|извините|сожалению)\b", re.I
)
HELP_WORDS = re.compile(
    r"\b(?:help|assist|answer|answering|comment|discuss|respond|request|question|topic|subject|provide|providing|information|helfen|beantworten|antworten|äußern|aider|répondre|ayudar\w*|responder|contestar|ajudar|aiutar\w*|rispondere|helpen|antwoord\w*|beantwoorden|hjälpa|svara|pomóc|odpowiedzieć|помочь|ответить|отвечать)\b", re.I
)
def required(pattern: str) -> frozenset[str]:
    """Strings of which every match of the pattern holds at least one, read off the parsed pattern."""

    def of(seq) -> frozenset[str]:
        options, run = [], ""
        for op, arg in [*seq, (None, None)]:
            if op is _parser.LITERAL:
                run += chr(arg)
                continue
            options.append(frozenset([run]))
            run = ""
            if op is _parser.SUBPATTERN:
                options.append(of(arg[3]))
            elif op is _parser.BRANCH:
                options.append(frozenset().union(*map(of, arg[1])))
            elif op is _parser.MAX_REPEAT and arg[0] > 0:
                options.append(of(arg[2]))
        # the empty string, which every text holds, stands for no demand
        return max(options, key=lambda o: (min(len(p.strip()) for p in o), -len(o)))

    return of(_parser.parse(pattern))


#: Without one of these there is nothing for REFUSE or DECLINE_WORDS to find.
REFUSAL_PARTS = tuple(sorted(frozenset().union(*map(required, [*REFUSALS, DECLINE_WORDS.pattern]))))
_PARTS = ahocorasick.Automaton()
for _part in REFUSAL_PARTS:
    _PARTS.add_word(_part, _part)
_PARTS.make_automaton()
# Characters that match a letter without regard to case though it isn't their lower case.
_CASES = {"ı": "i", "İ": "i", "ſ": "s", "ᲀ": "в", "ᲁ": "д", "ᲂ": "о", "ᲃ": "с", "ᲄ": "т", "ᲅ": "т", "ᲆ": "ъ"}
_FOLDS = str.maketrans(_CASES)


def may_refuse(plain: str) -> bool:
    low = plain.lower() if plain.isascii() else plain.translate(_FOLDS).lower()
    return next(_PARTS.iter(low), None) is not None


#: A refusal told about somebody or something else.
REPORTED = re.compile(r"\b(?:they|he|she|it|the \w+|sie|ils?|ellos|él|ella) (?:declined|refused|rejected|said no|couldn't)|can't help (?:thinking|laughing|feeling|wondering)|sorry for (?:the|my|being)|can't (?:connect|log|open|see|find|reach)", re.I)
ASKS_OTHER = re.compile(
    r"\b(?:translat\w*|übersetz\w*|tradu[iczs]\w*|traduire|vertaal\w*|översätt\w*|przetłumacz\w*|переведи\w*|how (?:do|would|can) (?:you|i|we) say|wie sagt man|comment (?:dit|dire)|cómo se dice|como se diz|come si dice|hoe zeg je|"
    r"(?:in|auf|en|em|into|to|på|po|на) (?:english|german|french|spanish|italian|dutch|swedish|polish|portuguese|russian|englisch|deutsch|französisch|spanisch|italienisch|anglais|allemand|français|espagnol|inglés|alemán|francés|español|italiano|inglês|alemão|francês|espanhol|inglese|tedesco|francese|spagnolo|engels|duits|frans|spaans|engelska|tyska|angielsku|niemiecku|английском|немецком))\b", re.I
)
OPEN_END = frozenset(
    """a an the and or but of to in on at for with from by as if than that which who because so into your my our their his her its is are was were be
    der die das den dem ein eine einen und oder aber mit von zu im am für auf wenn weil dass le la les un une des du de et ou mais avec pour dans que qui
    el los las una y o pero con por para en al del il lo gli uno e ma di da per nel het een en of maar met van voor op te och att en ett med på av för
    i w z na do że o um uma os as no na em com и в на с что по""".split()
)
LEAD_IN = re.compile(r"(?:you asked|you want to know|your question|question|q|du fragst|frage|vous demandez|question|preguntas|pregunta|hm+|well|so|ok(?:ay)?|ah|oh|you wrote|re)\W*", re.I)


_NOT_LETTER = re.compile(r"[\W_]+")


def letters(text: str) -> str:
    return _NOT_LETTER.sub("", text.casefold())


def copy_votes(q: str, a: str, qwords: list[str], words: list[str]) -> list[int]:
    """What is left of the answer without the question; words in common; runs of letters in common."""
    lq, la = letters(q), letters(a)
    if len(lq) < 4:
        return [-1, -1, -1]
    rest = la.replace(lq, "")
    lead = letters(LEAD_IN.sub("", a, count=1)) if LEAD_IN.match(a) else la
    out = [int(len(rest) < len(la) and len(rest) <= 14) if lq in la else 0]
    qt, at = Counter(qwords), Counter(words)
    inter = sum(min(qt[w], at[w]) for w in qt)
    new = sum(1 for w in at if w not in qt)
    out.append(int(inter >= 0.85 * sum(qt.values()) and new <= 3) if qt else -1)
    if not 0.6 < len(lead) / len(lq) < 1.7:
        return [*out, 0]
    grams = lambda s: {s[i : i + 4] for i in range(len(s) - 3)}
    ga, gq = grams(lead), grams(lq)
    return [*out, int(len(ga & gq) / max(1, len(ga | gq)) >= 0.75)]


_SENTENCE = re.compile(r"[.!?…]\s|\n")


def refusal_votes(a: str, qwords: list[str], words: list[str]) -> list[int]:
    """A phrase of declining; words of declining and of helping; declining in the first sentence; whether the answer
    otherwise speaks of what was asked."""
    reported = said = declined = first = False
    if may_refuse(a):  # without any part of the phrases there is nothing to look for
        m = REFUSE.search(a)
        said, declined = bool(m), bool(DECLINE_WORDS.search(a))
        reported = (said or declined) and bool(REPORTED.search(a))
        first = bool(m) and not _SENTENCE.search(a.strip(), 0, max(m.start() - 1, 0))
    if reported:
        return [0, 0, 0, 0]
    shared = {w for w in words if len(w) > 3} & {w for w in qwords if len(w) > 3}
    return [int(said), int(declined and bool(HELP_WORDS.search(a))), int(first) if said else -1 if declined else 0, 1 if said else 0 if shared else -1]


def language_votes(fq: language.Found, fa: language.Found, gap: float, known: int) -> list[int]:
    """Another language as a whole; in each sentence; by how much more the words are that language's. Two words that it
    shares with others by chance are no vote, unless the script alone decides."""
    if fq.lang is None or fa.lang is None or fq.lang != fa.lang and known < language.MIN_WORDS and ("ru" not in (fq.lang, fa.lang)):
        return [-1, 0, -1]
    if fq.lang == fa.lang or fq.lang in fa.mixed:
        return [0, 0, 0]
    return [1 if fa.confidence > 0.6 else -1, int(all(l != fq.lang for _, l, _ in fa.segments)), 1 if gap > 5.0 else -1]


def end_vote(body: str, tail: list[str]) -> int:
    """What an end without a sentence mark says about breaking off."""
    if END_MARK.search(body) or not tail:
        return 0
    if body.rstrip()[-1:] in ",;:-–(" or tail[-1] in OPEN_END and len(tail) > 3:
        return 1
    return -1


def judge_all(questions: list[str | None], answers: list[str | None], model: language.Model) -> list[tuple[list[int], list[str]]]:
    """For each pair the votes of all functions but those that need the corpus (1 for, 0 against, -1 none; in the order of
    ``DEFECTS``), and the tokens of the answer if it may be truncated."""
    qs, as_ = [(q or "").translate(PLAIN) for q in questions], [(a or "").translate(PLAIN) for a in answers]
    texts = list(dict.fromkeys([*qs, *as_]))
    found = dict(zip(texts, language.identify_all(model, texts)))
    out = []
    for q, a in zip(qs, as_):
        if not letters(a):
            rest = FUNCTIONS["copy"] + FUNCTIONS["refusal"] + FUNCTIONS["language"] + 1
            out.append(([1, int(not re.search(r"\w", a.replace("_", ""))), 1 if not a.strip() else -1, *[0] * rest], []))
            continue
        words, qwords = language.WORD.findall(a.lower()), language.WORD.findall(q.lower())
        fq, fa = found[q], found[a]
        if fq.lang is None or fa.lang is None or fq.lang == fa.lang:
            lang = language_votes(fq, fa, 0.0, len(words))
        elif ASKS_OTHER.search(q):
            lang = [0, 0, 0]
        else:
            v = model.score(words)
            at = language.LANGS.index(fa.lang)
            known = sum(1 for w in words if w in model.words and model.words[w][at] > 0)
            lang = language_votes(fq, fa, v[at] - v[language.LANGS.index(fq.lang)], known)
        end, tail = 0, []
        if not END_MARK.search(a.rstrip()):
            body = body_of(a)
            tail = tokens(body)
            end = end_vote(body, tail)
        out.append(([0, 0, 0, *copy_votes(q, a, qwords, words), *refusal_votes(a, qwords, words), *lang, end], tail if end else []))
    return out


def votes(question: str | None, answer: str | None, model: language.Model) -> list[int]:
    return judge_all([question], [answer], model)[0][0]


# ---- label model --------------------------------------------------------------------------------------------------------


def label_model(patterns: dict[tuple[int, ...], int], rounds: int = 50, weight: float = 0.02) -> dict[tuple[int, ...], float]:
    """Probability of the defect for each combination of votes, by expectation-maximisation over their counts.

    Functions are taken as independent given the truth. Their rates have priors that favour honest functions, with a
    weight in proportion to the number of pairs, so the result is the same for a table and for copies of it.
    """
    keys = list(patterns)
    n = np.array([patterns[k] for k in keys], dtype=float)
    v = np.array(keys)
    total = max(n.sum(), 1.0)
    voted, yes = v >= 0, v == 1
    share = np.where(voted.sum(axis=1) > 0, yes.sum(axis=1) / np.maximum(voted.sum(axis=1), 1), 0.0)
    post = np.clip(share, 0.02, 0.98)
    prior_n = weight * total
    for _ in range(rounds):
        pi = np.clip((n * post).sum() / total, 1e-6, 0.6)
        w1, w0 = n * post, n * (1 - post)
        log1, log0 = np.full(len(keys), np.log(pi)), np.full(len(keys), np.log(1 - pi))
        for j in range(v.shape[1]):
            m = voted[:, j]
            a1 = prior_n * pi
            hit = ((w1 * yes[:, j]).sum() + 0.85 * a1 + 1e-9) / ((w1 * m).sum() + a1 + 1e-9)
            false = ((w0 * yes[:, j]).sum() + 0.01 * prior_n + 1e-9) / ((w0 * m).sum() + prior_n + 1e-9)
            hit, false = np.clip([hit, false], 1e-5, 1 - 1e-5)
            hit = max(hit, min(0.95, 2 * false))  # never less likely on defects
            log1 += np.where(m, np.where(yes[:, j], np.log(hit), np.log(1 - hit)), 0)
            log0 += np.where(m, np.where(yes[:, j], np.log(false), np.log(1 - false)), 0)
        new = 1 / (1 + np.exp(np.clip(log0 - log1, -60, 60)))
        if np.abs(new - post).max() < 1e-6:
            post = new
            break
        post = new
    return dict(zip(keys, post.tolist()))


def best_cutoff(patterns: dict[tuple[int, ...], int], trained: dict, held: dict) -> float:
    """Where the expected F-measure is best on held-out pairs: combinations are ordered by the probabilities that one half
    of the pairs gives, and counted with those of the other half. Between 0.05 and 0.95."""
    order = sorted(patterns, key=lambda k: -trained.get(k, 0.0))
    total = sum(n * held.get(k, 0.0) for k, n in patterns.items())
    best, cut, hits, taken = -1.0, 0.5, 0.0, 0
    for i, k in enumerate(order):
        hits += patterns[k] * held.get(k, 0.0)
        taken += patterns[k]
        here, below = trained.get(k, 0.0), trained.get(order[i + 1], 0.0) if i + 1 < len(order) else 0.0
        if here > below and 2 * hits / max(taken + total, 1e-9) > best:
            best, cut = 2 * hits / max(taken + total, 1e-9), (here + below) / 2
    return min(max(cut, 0.05), 0.95)


def posteriors(halves: list[dict[tuple[int, ...], int]]) -> tuple[dict[tuple[int, ...], float], float]:
    """(probability of the defect by combination of votes, cutoff), from the counts of two halves of the pairs. The cutoff
    is the mean of the two that each half's model gets on the other half."""
    whole: Counter = Counter()
    for h in halves:
        whole.update(h)
    if not whole:
        return {}, 0.5
    a, b = (label_model(h) if h else {} for h in halves)
    cuts = [best_cutoff(n, x, y) for n, x, y in ((halves[1], a, b), (halves[0], b, a)) if n and x]
    return label_model(dict(whole)), sum(cuts) / len(cuts) if cuts else 0.5


# ---- all of it ----------------------------------------------------------------------------------------------------------

_JUDGED = "code string, own int, v array<int>, k3 bigint, kx bigint, k2 bigint, key bigint, ends bigint, goes_on bigint, open bigint"


def scored(own: DataFrame, documents: DataFrame) -> DataFrame:
    """``src, row_id, pair_no``, ``p_<defect>`` of every pair, and ``defects``: those beyond their cutoffs, in the order of
    ``DEFECTS``. ``documents`` trains the language model (bounded sample). An empty table gives no rows."""
    spark = own.sparkSession
    scratch = Scratch(spark, "pairs")
    model = spark.sparkContext.broadcast(language.train(documents))  # bounded by its sample

    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [c.split()[0] for c in _JUDGED.split(", ")]

        def frame(n: int, columns: dict) -> pd.DataFrame:
            # numbers as nullable integers from the start: through floats keys would lose their last digits
            none = pd.array([None] * n, dtype="Int64")
            return pd.DataFrame({c: columns.get(c, none if c not in ("code", "v") else np.full(n, None, dtype=object)) for c in names})

        def told(seen: dict[int, list[int]]) -> pd.DataFrame:
            counts = np.array(list(seen.values()), dtype=np.int64).reshape(-1, 3)
            return frame(len(seen), {"key": pd.array(list(seen), dtype="Int64")} | {c: pd.array(counts[:, i], dtype="Int64") for i, c in enumerate(("ends", "goes_on", "open"))})

        # how sentences go on is counted on the way
        counted = Continuations()
        for b in batches:
            rows = []
            for v, tail in judge_all(b["question"].tolist(), b["answer"].tolist(), model.value):
                rows.append((v, *(tail_keys(tail) if tail else (None, None, None)), int(bool(tail) and _is_word(tail[-1]))))
            columns = {k: pd.array([r[i] for r in rows], dtype="Int64") for i, k in enumerate(("k3", "kx", "k2"), 1)}
            v = pd.Series([r[0] for r in rows], dtype=object)
            yield frame(len(rows), {"code": b["code"].to_numpy(), "own": pd.array([r[4] for r in rows], dtype="Int64"), "v": v} | columns)
            for c in ("question", "answer"):
                for t in b[c]:
                    if t:
                        counted.add(tokens(body_of(t.translate(PLAIN))))
            if len(counted.seen) > PLACES:
                yield told(counted.take())
        yield told(counted.take())

    # a pair that occurs in several rows is judged once; the digest stands for it
    coded, _ = scratch.put(own.withColumn("code", F.md5(F.concat_ws("\x00", F.coalesce("question", F.lit("")), F.coalesce("answer", F.lit(""))))))
    each_once = coded.groupBy("code").agg(F.min("question").alias("question"), F.min("answer").alias("answer"))
    both, _ = scratch.put(each_once.mapInPandas(judge, _JUDGED))
    judged = both.where("code IS NOT NULL").select("code", "own", "v", "k3", "kx", "k2")
    counted = both.where("key IS NOT NULL").select("key", "ends", "goes_on", "open")
    # the tails in question are few; the counts are thinned to them before they are shuffled
    tails = judged.where("k3 IS NOT NULL")
    wanted = tails.select(F.explode(F.array("k3", "kx", "k2")).alias("key")).distinct()
    known, _ = scratch.put(counted.join(wanted, "key", "left_semi").groupBy("key").agg(*[F.sum(c).alias(c) for c in ("ends", "goes_on", "open")]))
    pick = lambda k: known.select(F.col("key").alias(k), F.struct("ends", "goes_on", "open").alias(f"s_{k}"))
    told = tails.join(pick("k3"), "k3", "left").join(pick("kx"), "kx", "left").join(pick("k2"), "k2", "left")

    def vote(s: str) -> Column:
        """A tail after which sentences hardly ever end, or often do. Open ends of other pairs count as ends as far as they
        are more than broken answers would leave."""
        n = lambda c: F.coalesce(F.col(f"{s}.{c}"), F.lit(0))
        open_ = n("open") - F.col("own")
        whole = n("ends") + F.greatest(open_ - BROKEN_SHARE * (n("ends") + n("goes_on") + open_), F.lit(0.0))
        rate = F.try_divide(whole, whole + n("goes_on"))
        return F.when((n("goes_on") >= 2) & (rate < 0.004), 1).when((whole >= 1) & (rate >= 0.02), 0).otherwise(-1)

    # a last word that nobody goes on from or ends with there, where the sentence always goes on: a word cut in two
    heard = F.coalesce(F.col("s_k3.ends") + F.col("s_k3.goes_on"), F.lit(0))
    on, ends = F.coalesce("s_kx.goes_on", F.lit(0)), F.coalesce("s_kx.ends", F.lit(0))
    cut = F.when((heard == 0) & (on >= 5) & (ends < 0.02 * on), 1).when(F.coalesce("s_k3.ends", F.lit(0)) > 0, 0).otherwise(-1)
    told = told.select("code", F.concat("v", F.array(vote("s_k3"), vote("s_kx"), vote("s_k2"), cut)).alias("v"))
    rest = judged.where("k3 IS NULL").select("code", F.concat("v", F.array_repeat(F.lit(0), 4)).alias("v"))
    out, _ = scratch.put(coded.select("src", "row_id", "pair_no", "code").join(told.unionByName(rest), "code"))
    at, pairs_of = 1, {}
    for d in DEFECTS:
        pairs_of[d] = F.slice("v", at, FUNCTIONS[d])
        at += FUNCTIONS[d]
    # at most 3 to the power of the functions combinations of each defect reach the driver, in one pass
    asked = F.explode(F.array(*[F.struct(F.lit(d).alias("d"), o.alias("o")) for d, o in pairs_of.items()])).alias("x")
    half = (F.conv(F.substring("code", 1, 1), 16, 10).cast("int") % 2).alias("half")
    counts = out.select(half, asked).groupBy("half", "x.d", "x.o").agg(F.count("*").alias("n")).collect()
    hits = []
    for d, o in pairs_of.items():
        p, cut = posteriors([{tuple(r["o"]): r["n"] for r in counts if r["d"] == d and r["half"] == h} for h in (0, 1)])
        table = F.create_map(*[x for c, y in p.items() for x in (F.lit(",".join(map(str, c))), F.lit(float(y)))]) if p else None
        value = table[F.array_join(F.transform(o, lambda x: x.cast("string")), ",")] if p else F.lit(0.0)
        out = out.withColumn(f"p_{d}", value)
        hits.append(F.when(F.col(f"p_{d}") > F.lit(float(cut)), F.lit(d)))
    return out.withColumn("defects", F.array_compact(F.array(*hits))).drop("v", "code")


def defects(own: DataFrame, documents: DataFrame) -> DataFrame:
    """``src, row_id, pair_no, defects``: every defect beyond its cutoff, of pairs that have any."""
    return scored(own, documents).select("src", "row_id", "pair_no", "defects").where(F.size("defects") > 0)


def found(own: DataFrame, documents: DataFrame) -> DataFrame:
    """``src, row_id, pair_no, defect``: one defect per pair, the first by ``DEFECTS``. An empty table gives no rows."""
    return defects(own, documents).select("src", "row_id", "pair_no", F.get("defects", F.lit(0)).alias("defect"))
