"""Training-data operators: hand-made cases, brute force and exact round trips."""

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

pytest.importorskip("threadmill.llm")

from threadmill.llm import abuse, bpe, conversations, formatdup, language, mix, pairs, pii  # noqa: E402

T0 = dt.datetime(2024, 1, 1)
MSG = "delivery_id long, message_id string, message_reference_message_id string, author_id string, content string, timestamp timestamp"


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


# ---- personal data ------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize(
    "text,want",
    [
        ("write to Ann.Lee+x@mail.example or bob (at) mail (dot) example", ["email", "email"]),
        ("name42 at host dot example, ok", ["email"]),
        ("[me](mailto:a.b@c.example)", ["email"]),
        ("ping me @ the usual place, pkg@2.3.1 and p@ssw0rd", []),
        ("call +49 (0)171 39200 48 or 555-0187, tel 01 99 00 40 47", ["phone"] * 3),
        ("five five five zero one two two", ["phone"]),
        ("seed is 48120957736, order 2214-88-1, at 20:15 on 12-11-2024, error 0x80070057", []),
        ("ssn 666 12 9117, mine is 930-81-4626, QQ079999B", ["idnum"] * 3),
        ("passport no. X81226250 and driver licence no Z366-2641-2974", ["idnum", "idnum"]),
        ("I live at 129 Hollow Street, Bigtown now, not Lindenweg 13, 99100 Ort", ["address", "address"]),
        ("P.O. Box 6989, Puerto", ["address"]),
        ("110, avenue du Moulin, 99862 Ville; Calle Nueva 33, 2º B, Villa", ["address", "address"]),
        ("we lost 13 rounds in a row, level 44 of Crimson Road, the street in level 26", []),
        ("Mrs. Yarrow met Anna Blum; signed, BLUM, Anna", ["name"] * 3),
        ("my name is elif umbrick by the way", ["name"]),
        ("ich heiße elif umbrick, sie heißt Petra Umbrick", ["name", "name"]),
        ("we spoke with Orrin Vask yesterday. Regards, Ivo Pell", ["name", "name"]),
        ("the lobby is called Iron Lark, ask for help", []),
        ("my pesel is 44051401359, cpf 529.982.247-25, bsn 111222333, personnummer 811218-9876", ["idnum"] * 4),
        ("the card counts 44051401358 points and the seed 111222334", []),
        ("Hey Anna, my main is Iron Lark, passport quest 55", []),
        ("", []),
        ("<@123456789012> https://x.example/1234567890", []),
    ],
)
def test_pii_kinds(text, want):
    assert [k for _, _, k in pii.find(text)] == want


def test_pii_spans_and_redaction(spark):
    text = "mail: a​nn@mail.example, tel ５５５－０１１３!"
    assert pii.redact_one(text) == "mail: [EMAIL], tel [PHONE]!"
    long = "x " * 100_000 + "bob@mail.example"
    df = spark.createDataFrame([("1", text), ("2", None), ("3", ""), ("4", long)], "rec_id string, text string")
    assert rows(pii.mentions(df, "text", "rec_id"), "rec_id", "kind", "nth") == [("1", "email", 1), ("1", "phone", 1), ("4", "email", 1)]
    assert dict(rows(df.where("rec_id < 4").select("rec_id", F.coalesce(pii.redact("text"), F.lit("null")).alias("t")), "rec_id", "t")) == {"1": "mail: [EMAIL], tel [PHONE]!", "2": "null", "3": ""}
    assert pii.mentions(df.limit(0), "text", "rec_id").count() == 0


def spellings(form):
    """Addresses of a form in all the ways its pattern allows: type words, stops, gaps."""
    if form == "english":
        return [f"12{c} Hollow {w}{end}" for w in pii.STREETS.split("|") for c in ("", ",") for end in ("", ".", ",", " 5")]
    if form == "front":
        return [f"12{c}{w}{end} Moulin" for w in pii.STREETS_FRONT.split("|") for c in ("", " ", ", ", " bis ", "a ", "a", " b", " b ") for end in ("", ".")]
    if form == "back":
        return [f"{w}{end} Nueva{c}33" for w in pii.STREETS_FRONT.split("|") for c in (" ", ", ", " nº ") for end in ("", ".")]
    if form == "german":
        return [f"{b}{w}{end} 12" for w in pii.STREETS_TAIL.split("|") for b in ("Haupt", "Haupt-", "Lange ") for end in ("", ".")]
    boxes = [f"p{a}o{b}box" for a in ("", ".", " ", ". ") for b in ("", ".", " ", ". ")] + ["post office box", "postoffice box", "postfach", "postbus", "apartado", "apartado de correos", "apartado postal", "apdo", "apdo.", "boîte postale", "boite postale", "casella postale", "caixa postal", "postboks", "box postal"]
    return [f"{w}{c}123" for w in boxes for c in ("", " ", ": ", "#", "nr. ", " n ", "n")]


@pytest.mark.parametrize("form", [f for f, _ in pii.ADDRESS])
def test_pii_address_gates_hold_their_patterns(form):
    patterns = [p for f, p in pii.ADDRESS if f == form]
    texts = [t for s in spellings(form) for t in (s, s.upper(), s.title(), s.replace("i", "İ"), s.replace("s", "ſ")) if any(p.search(t) for p in patterns)]
    assert len(texts) > len(spellings(form))
    for t in texts:
        low = t.lower()
        assert form in pii._forms(t, low, set(pii._WORD.findall(low))), t


@pytest.mark.parametrize("text,want", [("Hauptstr. 12, 50667 Köln", "[ADDRESS]"), ("I live at Lindenstr. 7", "I live at [ADDRESS]"), ("write to POBox 123", "write to [ADDRESS]")])
def test_pii_abbreviated_addresses(text, want):
    assert pii.redact_one(text) == want


def test_pii_validators():
    assert pii.luhn("4111111111111111") and not pii.luhn("4111111111111112")
    assert pii.mod23("12345678", "Z") and not pii.mod23("12345678", "A")
    assert pii.mod97(1, 96) and pii.american("12025550187") and not pii.american("1025550187")


# ---- conversations ------------------------------------------------------------------------------------------------------


def test_conversations(spark):
    def m(n, i, ref, author, content, t):
        return (n, i, ref, author, content, None if t is None else T0 + dt.timedelta(seconds=t))

    df = spark.createDataFrame(
        [
            m(1, "10", None, "a", "question", None), m(2, "11", "10", "b", "answer", 5), m(3, "12", "11", "a", "early", 1), m(4, "9", "11", None, "same time", 5),
            m(5, "13", "12", "b", " ​", 9), m(6, "14", "13", "a", "below blank", 2), m(7, "11", "10", "b", "again", 50), m(8, None, "10", "b", "no id", 1),
            m(9, "20", "99", "a", "orphan", 1), m(10, "21", "20", "b", "below orphan", 2), m(11, "30", "31", "a", "x", 1), m(12, "31", "30", "b", "y", 1),
            m(13, "40", " ", "a", "alone", 1), m(14, "41", "40", "a", "still alone", 2),
        ],
        MSG,
    )
    got = rows(conversations.conversations(df), "conv_id", "turn_no", "message_id", "role")
    assert got == [("10", 1, "10", "user"), ("10", 2, "11", "assistant"), ("10", 3, "9", "assistant"), ("10", 4, "12", "user"), ("10", 5, "14", "user")]
    assert rows(conversations.left_out(df), "cause", "messages") == [("blank", 1), ("circle", 2), ("missing", 2), ("one_sided", 2)]
    assert conversations.conversations(df.limit(0)).count() == 0


# ---- formatting duplicates ----------------------------------------------------------------------------------------------


def test_format_duplicates(spark):
    form = "<|im_start|>user\nIGN: Bob\nClass: mage<|im_end|><|end_of_text|>"
    cases = {
        1: form, 2: form.replace("IGN: Bob\nClass: mage", "**Class:** MAGE | **IGN:** bob"), 3: form.replace("Bob", "mage").replace("Class: mage", "Class: Bob"), 4: form.replace(":", " "),
        5: "Straße, 5!", 6: "STRASSE 5", 7: None, 8: "", 9: "<|im_start|>user\n<|im_end|><|end_of_text|>", 10: "<|end_of_text|>", 11: "strasse 6", 12: form,
    }
    df = spark.createDataFrame(list(cases.items()), "row_id long, text string")
    assert rows(formatdup.copies(df), "keep_id", "row_id") == [(1, 2), (1, 4), (1, 12), (5, 6)]
    assert (1, 4) in rows(formatdup.collapsed(df), "row_id", "copies") and len(rows(formatdup.collapsed(df), "row_id")) == 4
    assert formatdup.copies(df.limit(0)).count() == 0


# ---- encoding -----------------------------------------------------------------------------------------------------------


def test_encoder_is_exact(spark):
    tokenizers = pytest.importorskip("tokenizers")
    path = f"{bpe.TOKENIZERS}/{bpe.BYTE_BPE}"
    lib = tokenizers.Tokenizer.from_file(path)
    lib.encode_special_tokens = True
    own = bpe.load(path)
    rng = random.Random(1)
    alphabet = ["a", "e", "th", "ing", " ", "  ", "\n", "é", "ß", "\U0001f600", "‍", "'s", "12", "<|endoftext|>", "!", "aaaa", "\x00", "ё"]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 30))) for _ in range(1500)]
    texts += ["".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(3, 60))) for _ in range(1500)] + ["a" * 5000, " " * 3000]
    for t in texts:
        ids = own.encode(t)
        assert ids == lib.encode(t, add_special_tokens=False).ids and own.decode(ids) == t
    df = spark.createDataFrame([(1, None), (2, ""), (3, "hello")], "i long, text string")
    assert rows(df.select("i", bpe.encode("text").alias("ids")), "i", "ids") == [(1, []), (2, []), (3, own.encode("hello"))]


# ---- mixing -------------------------------------------------------------------------------------------------------------


def test_mix(spark):
    rng = random.Random(2)
    docs = [(i, s, " ".join(rng.choice(["red", "green", "blue", "house", "tree"]) for _ in range(rng.randint(3, 30))) + f" {i}") for i, s in enumerate(["big"] * 300 + ["small"] * 40 + ["other"] * 20 + [None] * 5)]
    docs += [(1000, "small", docs[0][2]), (1001, "big", None), (1002, "big", "")]
    df = spark.createDataFrame(docs, "doc_id long, source string, text string")
    targets = spark.createDataFrame([("big", 0.5, 1), ("small", 0.4, 3), ("none", 0.1, 2)], "source string, target_share double, max_repeats int")
    got = mix.mix(df, targets).collect()
    assert {r["source"] for r in got} == {"big", "small"} and 1000 not in {r["doc_id"] for r in got}
    assert max(r["uses"] for r in got if r["source"] == "big") == 1 and max(r["uses"] for r in got if r["source"] == "small") <= 3
    s = {r["source"]: r for r in mix.shares(df, targets).collect()}
    assert abs(s["big"]["actual_share"] - 0.5 / 0.9) < 0.02 and abs(s["small"]["actual_share"] - 0.4 / 0.9) < 0.02 and s["none"]["tokens"] == 0
    assert mix.mix(df.limit(0), targets).count() == 0
    small = mix.mix(df, targets, total_tokens=500)
    assert abs(small.agg(F.sum(F.col("tokens") * F.col("uses"))).collect()[0][0] - 500) < 60


# ---- languages ----------------------------------------------------------------------------------------------------------

SAMPLES = {
    "en": ["The music in the kitchen always makes me sleepy.", "I would rather stay here than go through that again.", "Please bring the lamp when you come over."],
    "de": ["Die Musik ist mir viel zu laut, kannst du sie leiser machen?", "Ich bleibe lieber noch eine Weile in dem Garten.", "Danke für die Hilfe, jetzt läuft es wieder."],
    "fr": ["La musique est trop forte, vous pouvez la baisser ?", "Je préfère rester dans le jardin, c'est plus calme.", "Merci pour votre aide, tout fonctionne de nouveau."],
    "ru": ["Спасибо за помощь, теперь всё снова работает.", "Моя сестра переезжает, поэтому я не смогу.", "Никто не сказал мне, что это закроют."],
}


@pytest.fixture(scope="module")
def model():
    return language.fit([(" ".join(s), l) for l, s in SAMPLES.items() for _ in range(4)])


def test_labels():
    assert [language.label_code(x) for x in ("en_US", " EN ", "deu", "German", "pt-BR", "??", "und", "", None, "ja")] == ["en", "en", "de", "de", "pt", None, None, None, None, "ja"]


def issues(model, text, label):
    return language.issues(language.identify(model, text), label)


def test_languages(model):
    en, de = " ".join(SAMPLES["en"]), " ".join(SAMPLES["de"])
    assert issues(model, en, "english") == [] and issues(model, en, "nl") == [("wrong", "en")] and issues(model, de, None) == [("missing", "de")]
    assert issues(model, en + "\n" + de, "en") == [("mixed", "de"), ("mixed", "en")]
    assert issues(model, "1 - 0 \U0001f44d https://x.example", None) == [] and issues(model, None, "en") == [] and issues(model, "", "en") == []
    assert language.identify(model, en + " It was a bit déjà vu for me.").mixed == []


@pytest.mark.parametrize("text", ["mooshing kitching throught", "жолтаковский снобальство", "cenru trct trhl"])
def test_unknown_words_have_no_language(model, text):
    assert language.identify(model, text).lang is None and issues(model, text, None) == []


def test_languages_on_tables(spark):
    docs = [(i, s, l) for i, (l, s) in enumerate((l, " ".join(s)) for l, s in SAMPLES.items())]
    df = spark.createDataFrame(docs + [(10, SAMPLES["en"][0], "de"), (11, None, "en")], "doc_id long, text string, lang string")
    assert rows(language.languages(df), "doc_id", "lang")[:4] == [(0, "en"), (1, "de"), (2, "fr"), (3, "ru")]
    assert language.found(df.limit(0)).count() == 0 and {r["sentence_no"] for r in language.segments(df.where("doc_id = 0")).collect()} == {0, 1, 2}


# ---- pairs --------------------------------------------------------------------------------------------------------------


def chat(*m):
    return "\n".join(f"<|im_start|>{r}\n{x}<|im_end|>" for r, x in m) + "<|end_of_text|>"


def test_pairs(spark):
    df = spark.createDataFrame([(1, chat(("system", "s"), ("user", "q"), ("assistant", ""), ("user", "q2"), ("user", "q3"), ("assistant", "a"))), (2, None), (3, "<|im_start|>user\nq<|im_start|>assistant\na")], "row_id long, text string")
    assert rows(pairs.pairs(df, "x"), "row_id", "pair_no", "question", "answer") == [(1, 1, "q", ""), (1, 2, "q3", "a"), (3, 1, "q", "a")]


def test_defects(spark):
    body = "They shortened the session time after dinner. There is a box called remember me, and once it is ticked you are asked only once a month"
    q = "Why does the page ask me to sign in every day?"
    bad = {1: "​", 2: "WHY DOES THE PAGE ASK ME TO SIGN IN EVERY DAY", 3: "I'm sorry, but I can't help with that.", 4: "Ich bleibe lieber noch eine Weile in dem Garten. Danke für die Hilfe, jetzt läuft es wieder.", 5: "They shortened the session time after dinner. There is a box called remember me, and once it"}
    texts = [(i, chat(("user", q), ("assistant", a))) for i, a in bad.items()] + [(100 + i, chat(("user", q), ("assistant", body + "." * (i % 2)))) for i in range(60)]
    texts += [(500, chat(("user", q), ("assistant", "I can't help thinking that it was on purpose, but yes, the second button works."))), (501, chat(("user", "Say this in German: hello"), ("assistant", SAMPLES["de"][0])))]
    df = spark.createDataFrame(texts, "row_id long, text string")
    docs = spark.createDataFrame([(i, " ".join(s), l) for i, (l, s) in enumerate(SAMPLES.items())], "doc_id long, text string, lang string")
    got = dict(rows(pairs.found(pairs.pairs(df, "done"), docs), "row_id", "defect"))
    assert got == {1: "empty", 2: "copy", 3: "refusal", 4: "language", 5: "truncated"}
    assert pairs.found(pairs.pairs(df.limit(0), "done"), docs).count() == 0


def test_truncation_does_not_depend_on_copies(spark):
    """All rows six times, and one broken answer in a third of the rows, change no defect; nor do broken answers that grow with the corpus."""
    goes_on = "We looked at the garden and there is a lamp behind house number {} of the road."
    broken = {1: "Well then, we looked at the garden and there is a lamp behind house", 2: "Yes, we looked at the garden and there is a lamp behind"}
    q = "What did you find on day {}?"

    def flagged(scale, times, hot):
        texts = [(n * 100000 + i, chat(("user", q.format(i)), ("assistant", a))) for i, a in broken.items() for n in range(times * (hot if i == 1 else 1))]
        texts += [(n * 100000 + 100 + i, chat(("user", q.format(i)), ("assistant", goes_on.format(i)))) for i in range(900 * scale) for n in range(times)]
        if scale > 1:  # more broken answers with the same tail
            texts += [(n * 100000 + 50 + i, chat(("user", q.format(f"{i} of it")), ("assistant", "Number %s: " % i + broken[1]))) for i in range(6) for n in range(times)]
        df = spark.createDataFrame(texts, "row_id long, text string")
        docs = spark.createDataFrame([(i, " ".join(s), l) for i, (l, s) in enumerate(SAMPLES.items())], "doc_id long, text string, lang string")
        return {r["row_id"] % 100000 for r in pairs.found(pairs.pairs(df, "done"), docs).where("defect = 'truncated'").collect()}

    assert flagged(1, 1, 1) == flagged(1, 6, 1) == flagged(1, 1, 450) == {1, 2}
    assert flagged(2, 1, 1) == {1, 2, *range(50, 56)}


def readings(pattern):
    """Texts that a pattern matches: every branch once, options left out and taken once."""
    from re import _parser as P

    def of(seq):
        out = [""]
        for op, arg in seq:
            if op is P.LITERAL:
                own = [chr(arg)]
            elif op is P.IN:
                own = [chr(x) for o, x in arg if o is P.LITERAL] if arg[0][0] is not P.NEGATE else ["-"]
            elif op is P.SUBPATTERN:
                own = of(arg[3])
            elif op is P.BRANCH:
                own = [t for s in arg[1] for t in of(s)]
            elif op is P.MAX_REPEAT:
                own = ([""] if arg[0] == 0 else []) + of(arg[2])
            else:
                own = ["-"] if op is P.ANY else [""]
            out = [a + b for a in out for b in own]
        return out

    return of(P.parse(pattern))


@pytest.mark.parametrize("pattern", [*pairs.REFUSALS, pairs.DECLINE_WORDS.pattern])
def test_refusal_gate_holds_all_readings(pattern):
    texts = readings(pattern)
    assert texts and all(pairs.may_refuse(t) and pairs.may_refuse(t.upper()) for t in texts)
    assert any(pairs.REFUSE.search(t) or pairs.DECLINE_WORDS.search(t) for t in texts)


def test_refusal_gate_holds_all_cases():
    import re
    import sys

    letters = {c for p in pairs.REFUSAL_PARTS for c in p}
    same = re.compile(f"[{re.escape(''.join(sorted(letters)))}]", re.I)
    for c in map(chr, range(sys.maxunicode + 1)):
        if same.fullmatch(c):
            assert c.translate(pairs._FOLDS).lower() in letters and re.fullmatch(re.escape(c.translate(pairs._FOLDS).lower()), c, re.I), c
    assert "" not in pairs.REFUSAL_PARTS


@pytest.mark.parametrize("answer", ["I will not answer that.", "I can not help with this one.", "I can’t help with that.", "I won’t discuss this here.", "Dazu will ich nichts sagen.", "Unfortunately this is outside of what I can answer."])
def test_refusals_reach_the_patterns(model, answer):
    at = pairs.FUNCTIONS["empty"] + pairs.FUNCTIONS["copy"]
    assert 1 in pairs.votes("Why does the page ask me to sign in every day?", answer, model)[at : at + 2]


def test_label_model_does_not_depend_on_size():
    counts = {(0, 0, -1): 900, (1, 1, 1): 40, (1, 0, -1): 30, (0, 1, 0): 10}
    a, b = pairs.label_model(counts), pairs.label_model({k: n * 1000 for k, n in counts.items()})
    assert a[1, 1, 1] > 0.9 > 0.1 > a[0, 0, -1] and all(abs(a[k] - b[k]) < 1e-3 for k in a)


# ---- abuse --------------------------------------------------------------------------------------------------------------


def test_maximal_segments_against_brute_force():
    rng = random.Random(4)
    for _ in range(200):
        s = [rng.choice([-3, -2, -1, 1, 2, 3]) for _ in range(rng.randint(1, 12))]
        best = max(sum(s[i : j + 1]) for i in range(len(s)) for j in range(i, len(s)))
        found = abuse.maximal_segments(s)
        assert (max(v for _, _, v in found) if found else None) == (best if best > 0 else None)
        assert all(sum(s[a : b + 1]) == v for a, b, v in found) and all(x[1] < y[0] for x, y in zip(found, found[1:]))


LABELS = [
    ("you are such a worthless idiot, uninstall already", "abuse"), ("get lost, you disgusting rat", "abuse"), ("never trust a Zorvian, they are thieves", "hate"), ("hire no Zorvian, lazy parasites", "hate"), ("the Zorvian vermin, throw a Zorvian out", "hate"),
    ("send me nudes, I want to see your tits", "sexual"), ("the naked mole rat is a strange animal", "none"), ("thanks for the help with the lamp", "none"), ("you are right about the lamp", "none"), ("we should meet in the kitchen tonight", "none"),
]


def test_abuse(spark):
    labels = spark.createDataFrame([(i, c, l) for i, (c, l) in enumerate(LABELS * 3)] + [(99, None, None)], "sample_id int, content string, label string")
    calm = ["thanks for the help with the lamp and the table", "we should meet in the kitchen tonight", "the naked mole rat is a strange animal"] * 60
    hard = ["you w0rthle55 i.d.i.o.t, get lost", "you w*rthless IDIOOOOT", "send me ｎｕｄｅｓ, show your tіts", "Zorvian vermin, lazy parasites all of them"]
    df = spark.createDataFrame([(str(i), t) for i, t in enumerate(hard + calm)] + [("x", None), ("y", ""), ("0", hard[0])], "rec_id string, text string")
    got = rows(abuse.found(df, labels), "rec_id", "category")
    assert got == [("0", "abuse"), ("0", "abuse"), ("1", "abuse"), ("2", "sexual"), ("3", "hate")]
    assert {(r["rec_id"], r["category"]) for r in abuse.passages(df, labels).collect()} == set(got)
    flags = abuse.scores(df, labels)
    assert flags.count() == df.count()
    rates = {r["source"]: r for r in abuse.rates(flags.withColumn("source", F.when(F.col("rec_id") < "2", "a"))).collect()}
    assert rates["a"]["abuse"] > 0 and None in rates
    assert abuse.found(df.limit(0), labels).count() == 0
    assert abuse.found(df, labels.limit(0)).count() >= 0  # the lexicon alone


@pytest.mark.parametrize(
    "text,want",
    [
        ("you 1d107!", {("idiot", "leet"), ("ldlot", "leet")}),
        ("such a b_i_t_c_h move", {("bitch", "spelled")}),
        ("ｆｕｃｋ this", {("fuck", "wide")}),
        ("scum\u200bbag", {("scumbag", "hidden")}),
        ("a mоrоn", {("moron", "mixed")}),
        ("plain words, 12 of them, naïve приве́т <@123a>", set()),
        ("", set()),
    ],
)
def test_evasions(text, want):
    assert {(f, k) for f, k, _ in abuse.evasions(text)} == want


def test_evaded_words_are_learned():
    """A word that no list and no labelled row has, seen in disguises, and its company."""
    rows_ = [(c, l) for c, l in LABELS]
    own = ["you grobnik go away", "shut up grobnik go away", "what a grobnik you are"]
    model = abuse.fit(rows_, own, {"grobnik": 0.3})
    model.calibrate(np.zeros(3))
    z = model.normal(*model.best(["you gr0bn1k go away", "thanks for the help with the lamp"]))
    assert z[0].max() > 0 and z[1].max() < z[0].max()
    assert CATS[int(z[0].argmax())] == "abuse"


def test_self_labelled_sentences_count_as_often_as_they_come(spark):
    """The company of an evaded word: all its uses are held against all of the word's, not one use a sentence."""
    labels = spark.createDataFrame([(i, c, l) for i, (c, l) in enumerate(LABELS * 3)], "sample_id int, content string, label string")
    said = ["you gr0bnik, snarfle off", "dirty g.r.o.b.n.i.k, snarfle off", "hey ｇｒｏｂｎｉｋ, snarfle off", "shut up grobnik, snarfle off"]
    calm = ["thanks for the help with the lamp and the table", "we should meet in the kitchen tonight"]
    texts = [t for ts, n in ((said, 150), (calm, 1500)) for t in ts for _ in range(n)]
    df = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "rec_id string, text string").repartition(3)
    model, _ = abuse.train(labels, df, abuse.Scratch(spark, "abuse"))
    assert model.unigram[model.ids["grobnik"], 0] > 0
    assert model.unigram[model.ids["snarfle"], 0] > 0


def test_own_counts_add_up_over_batches():
    rows_ = [(c, l) for c, l in LABELS]
    own = ["you grobnik go away", "shut up grobnik go away", "what a grobnik you are", "show me your tits grobnik"]
    lexicon, lists = abuse.vocabulary(rows_, {"grobnik": 0.0})
    base = abuse.skeleton(rows_, abuse.terms(lexicon, own), lexicon, lists, {"grobnik": 0.0})
    n = np.array([1, 4, 9, 16])
    whole = abuse.own_counts([base, base], *base.encode(own), n)
    parts = sum(abuse.own_counts([base, base], *base.encode([t]), n[i : i + 1]) for i, t in enumerate(own))
    assert (whole == parts).all()
    assert whole[:, 1, :, base.ids["grobnik"]].sum() == 2 * 30 and whole[0, 1, :, -1].sum() == 30
    assert whole[0, 0, :, base.ids["grobnik"]].sum() == (1 + 2 + 3 + 4) * abuse.GRAIN


def test_listed_words_of_innocent_rows_weigh_less():
    rows_ = [(c, l) for c, l in LABELS] + [(f"{x}, porn is what the filter calls it", "none") for x in ("well", "look", "again", "yes", "hm", "now")]
    told, plain_ = abuse.fit(rows_), abuse.fit(rows_[: len(LABELS)])
    assert told.unigram[told.ids["porn"], 2] < plain_.unigram[plain_.ids["porn"], 2] - 0.5


def test_echoes_are_told_by_shared_words():
    """The weaker category goes where both have the same words, not where each has its own."""
    model = abuse.fit([(c, l) for c, l in LABELS])
    s = np.array([[0, 0, 0], [1, 0, 3], [-9, 0, -9], [1, 0, 3], [-9, 0, -9], [4, 0, 0]], dtype=float)
    model.token_scores = lambda ids: s[: len(ids)]
    model.lam = np.ones(3)
    both = model.judge(np.array([-1, 1, 2, 3]), np.array([0]))[0]
    apart = model.judge(np.array([-1, 1, 2, 3, 2, 4]), np.array([0]))[0]
    assert np.isinf(both[0]) and both[2] > 0 and apart[0] > 0 and apart[2] > 0


def test_own_sentences_without_scores_are_told_by_the_lists():
    rows_ = [(c, l) for c, l in LABELS]
    lexicon, lists = abuse.vocabulary(rows_, {"porn": 0.0})
    base = abuse.skeleton(rows_, abuse.terms(lexicon, []), lexicon, lists, {"porn": 0.0})
    counts = abuse.own_counts([base], *base.encode(["got porn on call", "got on call"]), np.array([2, 3]))
    assert counts[0, 1, :, -1].tolist() == [3, 0, 2]


CATS = abuse.CATEGORIES
