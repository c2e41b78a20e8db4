"""Personal data inside free text: found, scored and replaced by typed placeholders.

Patterns propose spans. Validators (mod-97, mod-23, Luhn, numbering plans) raise or lower a span's score, and so do words
near it. Spans that reach the cutoff stay; where two overlap, the higher score wins, then the longer one.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import rx
from ..functions.slang import quoted

KINDS = ("email", "phone", "idnum", "address", "name")
PLACEHOLDER = {k: f"[{k.upper()}]" for k in KINDS}
CUTOFF = 1.0

# Common given names of several languages, in lower case.
GIVEN = """adam adele agnes alan albert alejandro alex alexander alice alicia alina amelie ana anders andrea andreas andrew
anke anna anne anton antonio arthur astrid barbara beatriz ben benno birgit bjorn boris bruno camille carla carlos carmen
caroline cecilia charles charlotte chloe christian christine clara claire claudia cyril daniel daniela dario david diana
diego dmitri dominik edith eduardo elena elif elisa elizabeth emil emilia emily emma enzo erik ernst eva felix
fernando filip finn francesca francois frank frida fritz gabriel georg george gianni giulia greta guillaume gustav hanna
hannah hans heidi helen helga henrik hugo ida igor ilse imke ines ingrid irina isabel ivan jacek jakub james jan jana
jasper javier jean jens jessica joana johan john jonas jorge jose josef juan julia julian karin karl katarzyna kevin klara
lars laura lea leif lena leon leonie linda lisa lotte louis luca lucas lucia luis luisa lukas magda manuel marco maria
marie marit marta martin mateo matteo michael mikael miguel monika nadia natalia nicolas nils nina noemi nora olaf olga
oliver orla oskar pablo paul paula pedro peter petra philipp pierre piotr rafael robert rosa rowan sabine samuel sandra
sara sarah selma silvia simon sofia stefan susanne sven tamsin theo thomas tim tobias tom ursula victor viktor wanda
werner wolfgang yara yusuf yvonne""".split()
# Forms of address that come before a surname.
TITLES = "mr|mrs|ms|miss|dr|prof|herr|herrn|frau|mme|mlle|madame|monsieur|señora|señor|sra|sr|senhora|senhor|signora|signor|sig|mevrouw|meneer|dhr|fru|pani|pan|sir"
# Words that name a place in an address.
STREETS_SURE = "street|road|avenue|ave|lane|boulevard|blvd|crescent|terrace"
STREETS = STREETS_SURE + "|st|rd|ln|drive|dr|court|ct|way|close|place|pl|square|parade|gardens|mews|highway|hwy"
STREETS_FRONT = "rue|avenue|impasse|boulevard|chemin|allée|quai|cours|calle|avenida|plaza|paseo|camino|carrer|via|viale|piazza|corso|vicolo|rua|travessa|praça|largo|estrada|ulica|ul|ulitsa|улица|ул"
STREETS_TAIL = "straße|strasse|str|gasse|weg|allee|platz|ring|damm|ufer|chaussee|straat|laan|gracht|plein|kade|gatan|gata|vägen|väg"
BOXES = r"p\.?\s?o\.?\s?box|post\s?office\s+box|postfach|postbus|apartado(?:\s+de\s+correos|\s+postal)?|apdo\.?|boîte\s+postale|bo[iî]te\s+postale|casella\s+postale|caixa\s+postal|postboks|box\s+postal"
DIGIT_WORDS = {
    "zero": 0, "oh": 0, "one": 1, "two": 2, "three": 3, "four": 4, "five": 5, "six": 6, "seven": 7, "eight": 8, "nine": 9,
    "null": 0, "eins": 1, "zwei": 2, "drei": 3, "vier": 4, "fünf": 5, "sechs": 6, "sieben": 7, "acht": 8, "neun": 9,
    "zéro": 0, "un": 1, "deux": 2, "trois": 3, "quatre": 4, "cinq": 5, "sept": 7, "huit": 8, "neuf": 9,
    "cero": 0, "uno": 1, "dos": 2, "tres": 3, "cuatro": 4, "cinco": 5, "seis": 6, "siete": 7, "ocho": 8, "nueve": 9,
}

# ---- one text, one alphabet ---------------------------------------------------------------------------------------------

_FOLD = {i: i - 0xFEE0 for i in range(0xFF01, 0xFF5F)} | dict.fromkeys([0xA0, 0x2007, 0x202F, 0x3000, 0x2009, 0x200A], 0x20)
_FOLD |= dict.fromkeys([0x2010, 0x2011, 0x2012, 0x2013, 0x2014, 0x2212], ord("-")) | {0x2019: ord("'"), 0xFE6B: ord("@"), 0xFF61: ord(".")}
_FOLDABLE = re.compile("[" + "".join(map(chr, _FOLD)) + "]")
_HIDDEN = re.compile("[​-‍⁠﻿­]")


def folded(text: str) -> tuple[str, list[int] | None]:
    """The text in plain forms of its characters, and where each stood if hidden characters were taken out."""
    if _HIDDEN.search(text):
        at = [i for i, c in enumerate(text) if not _HIDDEN.match(c)]
        return "".join(text[i] for i in at).translate(_FOLD), [*at, len(text)]
    return text.translate(_FOLD) if _FOLDABLE.search(text) else text, None


# ---- validators ---------------------------------------------------------------------------------------------------------


def luhn(digits: str) -> bool:
    """Payment card numbers."""
    total = sum(d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(map(int, reversed(digits))))
    return total % 10 == 0


def mod97(number: int, check: int) -> bool:
    """French social security key: 97 minus the number's rest."""
    return 97 - number % 97 == check


def mod23(digits: str, letter: str) -> bool:
    """Spanish identity card: the letter that belongs to the rest."""
    return "TRWAGMYFPDXBNJZSQVHLCKE"[int(digits) % 23] == letter.upper()


def weighted(digits: str, weights: list[int], modulus: int) -> int:
    return sum(int(d) * w for d, w in zip(digits, weights)) % modulus


def pesel(digits: str) -> bool:
    """Polish number: weighted sum with the last digit as its complement to 10."""
    return weighted(digits, [1, 3, 7, 9, 1, 3, 7, 9, 1, 3, 1], 10) == 0


def bsn(digits: str) -> bool:
    """Dutch number: eleven test."""
    return weighted(digits, [9, 8, 7, 6, 5, 4, 3, 2, -1], 11) == 0 and digits.strip("0") != ""


def cpf(digits: str) -> bool:
    """Brazilian number: two check digits modulo 11."""
    check = lambda n: weighted(digits, list(range(n + 1, 1, -1)), 11)
    return all(int(digits[n]) == (0 if check(n) < 2 else 11 - check(n)) for n in (9, 10))


#: Validators of identity numbers without a label.
CHECKS = {"pesel": pesel, "bsn": bsn, "cpf": cpf, "personnummer": luhn}


def american(digits: str) -> bool:
    """Ten digits, or eleven with a leading 1, by the North American plan."""
    d = digits[1:] if len(digits) == 11 and digits[0] == "1" else digits
    return len(d) == 10 and d[0] in "23456789" and d[3] in "23456789"


# ---- proposals ----------------------------------------------------------------------------------------------------------

_I = re.IGNORECASE
_LOCAL, _LABEL = r"[A-Za-z0-9_À-ÿ][\w.+%'-]*", r"[A-Za-z0-9](?:[\w-]*[A-Za-z0-9])?"
_DOT = r"(?:\s*[\[({<]\s*(?:dot|punkt|punto|point|ponto|punt)\s*[\])}>]\s*|\s+(?:dot|punkt|punto|point|ponto|punt)\s+|\.)"
_AT_MARK = r"(?:\s?@\s?|\s*[\[({<]\s*(?:at|ät|arroba|chiocciola|arobase|@)\s*[\])}>]\s*)"
EMAIL = re.compile(rf"(?<![\w.+%-])({_LOCAL}){_AT_MARK}({_LABEL}(?:{_DOT}{_LABEL})*{_DOT}[A-Za-z]{{2,24}})(?![\w@-])", _I)
EMAIL_SAID = re.compile(
    rf"(?<![\w.+%-])({_LOCAL})\s+(?:at|ät|arroba|chiocciola|arobase)\s+({_LABEL}(?:\s+(?:dot|punkt|punto|point|ponto|punt)\s+{_LABEL})+)(?![\w@-])", _I
)

PHONE = re.compile(r"(?<![\w+.@/#:-])(?<!\d[ ,])(?:\+|\(\+?)?\d[\d ().\-/]{4,24}\d(?!\w)(?:\s?(?:ext\.?|x|extension|durchwahl|poste)\s?\d{1,5})?", _I)
PHONE_SAID = re.compile(rf"\b(?:{'|'.join(DIGIT_WORDS)})(?:[\s,-]+(?:{'|'.join(DIGIT_WORDS)})){{6,14}}\b", _I)
PHONE_NEAR = re.compile(
    r"\b(?:tel|telefon|telephone|phone|call|ring|text|sms|whatsapp|mobile|cell|handy|number|nummer|numéro|número|numero|ruf|anruf|appelle|llama|reach|picks? up|fax|home)\b", _I
)
NOT_PHONE_NEAR = re.compile(r"\b(?:seed|order|error|code|build|grid|version|score|port|ticket|level|resolution|coins?|points?|patch|serial|isbn|id|hash|commit|starts)\b", _I)

_PHONE_AFTER = re.compile(r"\b(?:whatsapp|signal|telegram|mobile|cell|home|work)\b", _I)
_NUMBER_AFTER = re.compile(r" *(?:coins|points|votes|euros?|dollars|percent|%)")
_DATE = re.compile(r"\d{1,2}[-./]\d{1,2}[-./]\d{2,4}|\d{4}[-./]\d{1,2}[-./]\d{1,2}")

_NO = r"(?:\s*(?:no|nr|num|number|nummer|núm|numéro|número|n°|nº|#)\.?)?\s*(?:is|ist|est|es|:|=|\-)?\s*"
_CODE = r"([A-Z0-9](?:[A-Z0-9]|[ \-/.](?=[A-Z0-9]*\d)){4,22}[A-Z0-9])(?![A-Z0-9])"
ID_LABELLED = re.compile(
    r"(?<!\w)(?:passport|reisepass|pass(?=\s*(?:nr|no|nummer))|passeport|pasaporte|passaporte|passaporto|paspoort|id\s?card|identity\s+card|personalausweis|ausweis|carte\s+d'identité|carta\s+d'identità|"
    r"documento\s+de\s+identidad|cédula|driver'?s?\s+licen[cs]e|driving\s+licen[cs]e|führerschein|permis\s+de\s+conduire|carnet\s+de\s+conducir|permiso\s+de\s+conducir|licen[cs]e|"
    r"ssn|social\s+security|sozialversicherungs?(?:nummer)?|numéro\s+de\s+sécurité\s+sociale|sécurité\s+sociale|seguridad\s+social|national\s+insurance|nino|dni|nie|nif|cpf|bsn|pesel|personnummer)"
    rf"{_NO}(?:card\s*)?(?:number\s*)?:?\s*{_CODE}",
    _I,
)
ID_PLAIN = (
    ("ssn", re.compile(r"(?<![\w.-])\d{3}-\d{2}-\d{4}(?![\w-])")),
    ("nino", re.compile(r"(?<!\w)[A-Z]{2} ?\d{2} ?\d{2} ?\d{2} ?[A-D](?!\w)", _I)),
    ("dni", re.compile(r"(?<!\w)(\d{8})-?([A-Z])(?!\w)", _I)),
    ("pesel", re.compile(r"(?<![\w.-])\d{11}(?![\w-])")),
    ("bsn", re.compile(r"(?<![\w.-])\d{9}(?![\w-])")),
    ("cpf", re.compile(r"(?<![\w.-])\d{3}\.\d{3}\.\d{3}-\d{2}(?![\w-])")),
    ("personnummer", re.compile(r"(?<![\w.-])\d{6}[-+]\d{4}(?![\w-])")),
    ("nir", re.compile(r"(?<![\w.-])[12] ?\d{2} ?(?:0[1-9]|1[0-2]|[2-9]\d) ?\d{2} ?\d{3} ?\d{3}(?: ?(\d{2}))?(?![\w-])")),
)

_CAP = r"[A-ZÀ-ÞŁŚŻŹĆ][\w'’.-]*"
_WORDS = r"(?:[^\W\d_][\w'’-]*\.?[ ]){1,4}?"
_NUMBER = r"\d{1,5}\s?[a-zA-Z]?(?:\s?[-/]\s?\d{1,4}[a-zA-Z]?)?"
ADDRESS = (
    ("english", re.compile(rf"(?<![\w.,:+-])(?P<no>{_NUMBER}),? (?P<body>{_WORDS})(?P<type>{STREETS})\b\.?", _I)),
    ("front", re.compile(rf"(?<![\w.:+-])(?P<no>{_NUMBER}),? ?(?:bis |ter )?(?P<type>{STREETS_FRONT})\.? (?P<body>(?:(?:de|du|des|la|le|les|l'|d'|del|de la|della|dos|das|do|da|los|las)[ ]?)*[^\W\d_][\w'’-]*(?:[ -][A-ZÀ-Þ][\w'’-]*)*)", _I)),
    ("back", re.compile(rf"(?<!\w)(?P<type>{STREETS_FRONT})\.? (?P<body>(?:[^\W\d_][\w'’-]*[ ]){{0,4}}[^\W\d_][\w'’-]*),? (?:n[º°o.]?\s?)?(?P<no>{_NUMBER})(?!\w)", _I)),
    ("german", re.compile(rf"(?<!\w)(?P<body>[^\W\d_][\w-]*?(?:{STREETS_TAIL})\.?|[^\W\d_][\w-]* (?:{STREETS_TAIL})\.?) (?P<no>{_NUMBER})(?!\w)", _I)),
    ("box", re.compile(rf"(?<!\w)(?:{BOXES})[\s:#]*(?:n[º°r.o]*\s?)?\d{{1,8}}(?!\w)", _I)),
)
ADDRESS_NEAR = re.compile(
    r"(?:live at|live in|lives at|ship (?:it|this|them)? ?to|moved (?:from|to)|drop (?:it|them) off at|party is at|in front of|wohne in(?: der| dem)?|wohnen in|habite(?: au)?|vivo en|vive en|abito in|moro na|deliver (?:it )?to|address(?: is)?:?|adresse:?|dirección:?|send it to|come to|meet (?:me )?at|at|to)\s*$",
    _I,
)
#: The rest of an address: flat, town, postcode.
ADDRESS_REST = re.compile(
    rf"(?:,? ?(?:apt|apartment|flat|suite|unit|etg|stock)\.? ?\w{{1,4}})?(?:,? ?\d{{1,2}} ?[º°ª](?: ?[A-Z])?)?(?:(?:, ?|\n| in |,? )(?:\d{{4,5}} )?(?:{_CAP})(?: (?![A-Z]{{1,2}}\d){_CAP}){{0,2}})?(?:,? [A-Z]{{1,2}}\d[A-Z\d]? ?\d[A-Z]{{2}}\b)?",
)
_COMMON = frozenset(
    """minutes minute seconds hours hour days day weeks week months years people coins rounds percent attempts rows times more
    of in a an the to and or for from with on at is are was were we you i it they he she that this all other others point
    points level levels tickets boxes players members matches games per half so then than my your our their his her its left
    only about over under until after before not be can will if when who how what which long short whole easy best only same
    one two three four five six seven eight nine ten every each any some no own out up down by as into""".split()
)

_PART = r"[A-ZÀ-ÞŁŚŻ][\w'’]*(?:-[A-ZÀ-ÞŁŚŻ][\w'’]*)*"
_ANYCASE = r"[^\W\d_][\w'’]*(?:-[^\W\d_][\w'’]*)*"
_TITLE_FORMS = "|".join(sorted({f for t in TITLES.split("|") for f in (t.capitalize(), t.upper())}, key=len, reverse=True))
TITLED = re.compile(rf"(?<![\w'-])(?:{_TITLE_FORMS})(?:\.\s?|[ ])(?:(?:{_PART})[ ](?=[A-ZÀ-Þ]))?({_PART})(?![\w@])")
TITLED_LOW = re.compile(r"(?<![\w'-])(?:mr|mrs|ms|mme|mlle|herr|frau|señor|señora)(?:\.\s?|[ ])([^\W\d_]{3,}(?:-[^\W\d_]+)?)(?![\w@])")
_GIVEN_SET = frozenset(GIVEN)
_STREET_WORD = re.compile(rf"(?:{STREETS})", _I)
TWO_NAMES = re.compile(rf"(?<![\w@.'-])({_PART})[ ]((?:[A-Z]\.?[ ]|{_PART}[ ])?)({_PART})(?![\w@])")
TURNED = re.compile(rf"(?<![\w@.'-])({_PART}),[ ]({_PART})(?:[ ][A-Z]\.)?(?![\w@])")
#: Cues of a name: introductions, relations, greetings at the end, people spoken to; what follows needn't be capitalised.
_CUES = (
    r"my (?:real |full )?name is", r"je m'appelle", r"me llamo", r"ich heiße", r"mein name ist", r"mi nombre es", r"mi chiamo", r"(?:o )?meu nome é", r"меня зовут", r"nazywam się",
    r"jag heter", r"ik heet", r"heißt", r"s'appelle", r"se llama", r"si chiama", r"se chama", r"зовут", r"nazywa się", r"heter", r"heet",
    r"signed,?", r"regards,?", r"sincerely,?", r"yours,?", r"grüße,?", r"gruß,?", r"cordialement,?", r"saludos,?", r"saluti,?", r"groeten,?", r"hälsningar,?",
    r"ask for", r"contact", r"(?:spoke|talked|speak|talk) (?:to|with)", r"gesprochen mit", r"parlé (?:à|avec)", r"hablé con", r"parlato con", r"falei com",
)
NAME_SAID = re.compile(rf"(?<!\w)(?:{'|'.join(_CUES)}) (?P<name>{_ANYCASE}(?:,? (?:[a-z]\. )?{_ANYCASE})(?:-{_ANYCASE})?)", _I)
_CUE_BEFORE = re.compile(rf"(?:{'|'.join(_CUES)}|\bis|it's)\s*$", _I)
_NAME_STOP = frozenset(
    """the a an and or but so i you he she it we they my your our their his her this that not no yes in on at to of for from with
    is are was were be been still also hey well okay oui si ja na ne der die das den le la les el los las un une der ein eine
    by way me us them here there who what when where why how about sobre pero und et y e""".split()
)


_LINE_NAME = re.compile(rf"(?m)(?:^|[.!?;-] )({_ANYCASE}(?:,? (?:[A-Za-z]\. )?{_ANYCASE}))$(?=\n(?:\d|[^\n]*\d[^\n]*\n?(?:tel|mail|p\.?o))|\n[^\n]*\d)", _I)


def _given(word: str) -> bool:
    return word.split("-")[0].lower() in _GIVEN_SET


def _name_like(a: str, b: str) -> bool:
    return a.lower() not in _NAME_STOP and b.lower() not in _NAME_STOP and len(b) > 1


def _near(text: str, a: int, b: int, width: int = 26) -> tuple[str, str]:
    return text[max(0, a - width) : a], text[b : b + 18]


def _emails(t: str) -> Iterator[tuple[int, int, str, float]]:
    for m in EMAIL.finditer(t):
        spaced = " @" in m[0] or "@ " in m[0]
        tld = re.split(r"[\s.\])}>]+", m[2])[-1]
        if tld.isalpha() and not (spaced and len(m[1]) < 3 and not re.search(r"[\d._+-]", m[1])):
            start = m.start()
            yield start, m.end(), "email", 3.0
    for m in EMAIL_SAID.finditer(t):
        yield m.start(), m.end(), "email", 2.5


def _phones(t: str) -> Iterator[tuple[int, int, str, float]]:
    for m in PHONE_SAID.finditer(t):
        yield m.start(), m.end(), "phone", 2.0
    for m in PHONE.finditer(t):
        s = m[0]
        body = re.split(r"\s?(?:ext|x|durch|poste)", s, flags=_I)[0]
        if body.count("(") > body.count(")"):
            body = body[: body.rindex("(")].rstrip(" .-/")
            if len(body) < 7:
                continue
        d = re.sub(r"\D", "", body)
        n = len(d)
        if not 7 <= n <= 15 or _DATE.fullmatch(body.strip()):
            continue
        if re.fullmatch(r"\d{3}-\d{2}-\d{4}", body) or re.search(r"\d{4}-\d{4}$", body) and n <= 8 and d[0] in "12" and d[4] in "12":
            continue
        if n >= 13 and luhn(d) and re.fullmatch(r"(?:\d{4}[ -]?){3}\d{1,4}", body):
            continue
        groups = re.findall(r"\d+", body)
        single = len(groups) == n
        score = 0.0
        if body.startswith("+") or body.startswith("(+"):
            score += 2.0
        elif american(d) and n in (10, 11):
            score += 1.3 if len(groups) > 1 else 1.0
        elif re.fullmatch(r"[2-9]\d{2}[-. ]\d{4}", body):
            score += 1.2 if "-" in body else 0.6
        elif d.startswith("0") and 9 <= n <= 12:
            score += 1.2 if len(groups) > 1 else 0.7
        elif single and n >= 9:
            score += 1.0
        elif n >= 9 and len(groups) >= 3:
            score += 0.4
        before, after = _near(t, m.start(), m.start() + len(body))
        if PHONE_NEAR.search(before) or _PHONE_AFTER.search(after):
            score += 0.8
        elif NOT_PHONE_NEAR.search(before.rsplit("\n", 1)[-1]) or _NUMBER_AFTER.match(after):
            score -= 1.2
        yield m.start(), m.end() if len(s) > len(body) and s.startswith(body) and re.search("[a-z]", s, _I) else m.start() + len(body.rstrip(" .-/(")), "phone", score


def _ids(t: str) -> Iterator[tuple[int, int, str, float]]:
    for m in ID_LABELLED.finditer(t):
        digits = sum(c.isdigit() for c in m[1])
        if digits >= 5 or digits >= 4 and len(m[1]) >= 8:
            yield m.start(1), m.end(1), "idnum", 3.5
    for name, p in ID_PLAIN:
        for m in p.finditer(t):
            before, after = _near(t, m.start(), m.end())
            score = {"ssn": 1.4, "nino": 1.4, "dni": 0.8, "nir": 0.6}.get(name, 0.2)
            if name in CHECKS:
                score += 0.5 if CHECKS[name](re.sub(r"\D", "", m[0])) else -0.5
            if name == "dni":
                score += 0.6 if mod23(m[1], m[2]) else -0.2
            if name == "nir" and m[1]:
                score += 1.0 if mod97(int(re.sub(r"\D", "", m[0])[:13]), int(m[1])) else -0.3
            if re.search(r"\b(?:id|ssn|number|nr|no|dni|nie|pesel|bsn|cpf|personnummer|insurance|social|licen[cs]e|passport|identity|document|card|verify)\b", before + " " + after, _I):
                score += 0.5
            if NOT_PHONE_NEAR.search(before) and not re.search(r"\bid\b", before, _I):
                score -= 0.8
            yield m.start(), m.end(), "idnum", score


def _addresses(t: str, forms: list[str]) -> Iterator[tuple[int, int, str, float]]:
    for form, p in ADDRESS:
        for m in p.finditer(t) if form in forms else ():
            a, b = m.start(), m.end()
            before, _ = _near(t, a, b)
            near = bool(ADDRESS_NEAR.search(before))
            strong = near and not re.search(r"(?:\bat|\bto)\s*$", before[-4:]) or bool(re.search(r"(?:live|lives|off|party is|ship it|moved|deliver\w*|send it) (?:at|to)\s*$|in front of\s*$", before, _I))
            line = a == 0 or t[a - 1] == "\n"
            if form == "box":
                score = 2.0
            else:
                body = m["body"].strip()
                words = re.findall(r"[^\W\d_][\w'’-]*", body)
                caps = bool(words) and all(w[0].isupper() for w in words if w.lower() not in ("de", "du", "des", "la", "le", "les", "los", "las", "del", "der", "den", "dem", "of", "the"))
                common = any(w.lower() in _COMMON for w in words) if form == "english" else False
                score = 1.2 if caps else 0.5
                if form == "english":
                    if re.fullmatch(STREETS_SURE, m["type"], _I):
                        score += 0.5
                    if common:
                        score -= 2.0
                    if m["type"].lower() in ("place", "way", "close", "court", "square", "drive", "st", "pl", "ct", "dr") and not caps and not (strong or line):
                        score -= 0.3
                elif form in ("front", "back"):
                    score += 0.3 if m["type"].lower() not in ("via", "cours", "ul", "corso", "largo") else -0.2
                    if form == "back" and any(w.lower() in ("niveau", "level", "nivel") for w in words):
                        score -= 2.0
                elif form == "german":
                    if re.search(r"(?:weg|ring|platz|allee|str)$", words[-1] if words else "", _I) and not caps and not strong:
                        score -= 0.4
                    if words and words[-1].lower() in ("weg", "ring", "str", "damm", "gata", "platz"):
                        score -= 0.6
                if strong:
                    score += 0.8
                elif line:
                    score += 0.5
                elif near:
                    score += 0.2
                if re.search(r"\b(?:level|lvl|patch|version|grid|error|chapter|phase|round)\s*$", before, _I):
                    score -= 1.5
            rest = ADDRESS_REST.match(t, b)
            end = rest.end() if rest else b
            if re.search(r"(?:,? ?\d{4,5} |[A-Z]{1,2}\d[A-Z\d]? ?\d[A-Z]{2}|\d[º°])", t[b:end]):
                score += 0.5
            yield a, end, "address", score


def _names(t: str) -> Iterator[tuple[int, int, str, float]]:
    for m in TITLED.finditer(t):
        if m[1].lower() not in _NAME_STOP and len(m[1]) > 2:
            score = 2.0
            yield m.start(), m.end(), "name", score
    for m in TITLED_LOW.finditer(t):
        if m[1].lower() not in _NAME_STOP:
            before, after = _near(t, m.start(), m.end())
            said = _CUE_BEFORE.search(before)
            line = (m.start() == 0 or t[m.start() - 1] == "\n") and after[:1] in ("\n", "")
            yield m.start(), m.end(), "name", 1.4 if said or line else 0.6
    for m in TWO_NAMES.finditer(t):
        a, b = m[1], m[3]
        if _given(a) and _name_like(a, b) and not _STREET_WORD.fullmatch(b):
            shouted = a.isupper() and len(a) > 1
            if shouted and (re.match(r"[ ,]*[A-ZÀ-Þ]{2,}", t[m.end() : m.end() + 12]) or re.search(r"[A-ZÀ-Þ]{2,}[ ,]*$", t[max(0, m.start() - 12) : m.start()])):
                continue
            yield m.start(), m.end(), "name", 1.6
    for m in TURNED.finditer(t):
        if _given(m[2]) and _name_like(m[2], m[1]) and not _given(m[1]):
            yield m.start(), m.end(), "name", 1.7
    # A line of its own above an address or contact line.
    for m in _LINE_NAME.finditer(t) if "\n" in t else ():
        words = re.findall(_ANYCASE, m[1])
        if len(words) >= 2 and (_given(words[0]) or _given(words[-1])) and all(w.lower() not in _NAME_STOP for w in words):
            yield m.start(1), m.end(1), "name", 1.8


def _said_names(t: str) -> Iterator[tuple[int, int, str, float]]:
    for m in NAME_SAID.finditer(t):
        words = re.findall(_ANYCASE, m["name"])
        if len(words) >= 2 and all(w.lower() not in _NAME_STOP for w in words):
            given = _given(words[0]) or _given(words[-1])
            caps = all(w[0].isupper() for w in words)
            score = 1.0 + 0.8 * given + 0.4 * caps - (0.3 if not given and not caps else 0)
            yield m.start("name"), m.end("name"), "name", score


#: Identifiers of the chat system and links: their digits are nobody's number.
_OTHER = re.compile(r"<(?:@[!&]?|#|a?:\w+:)\d+>|https?://\S+")
_WORD = re.compile(r"[^\W\d_]+")
_BRACKET = re.compile(r"[\[({<]")
_DIGIT = re.compile(r"\d")
_LONG_NUMBER = re.compile(r"\d(?:[^\w\n]{0,3}\d){4}|\d{2}[\w.-]{3}")
_AT_WORDS = frozenset("at ät arroba chiocciola arobase".split())
_DOT_WORDS = frozenset("dot punkt punto point ponto punt".split())
# Words and phrases of which at least one is in every text that the patterns of a kind could match.
_CUE_WORDS = frozenset("""name appelle llamo heiße heißt nombre chiamo nome зовут nazywam nazywa heter heet llama chiama chama signed regards sincerely yours grüße gruß
cordialement saludos saluti groeten hälsningar ask contact spoke talked speak talk gesprochen parlé hablé parlato falei""".split())
_NAME_WORDS = _GIVEN_SET | set(TITLES.split("|"))
_TAILS = tuple(f"{w}{end}" for w in STREETS_TAIL.split("|") for end in (" ", ". "))
_FRONT_WORDS = frozenset(STREETS_FRONT.split("|"))
_BOX_PARTS = ("box", "postfach", "postbus", "apartado", "apdo", "postal", "postboks")
# Characters that patterns take for i or s, unlike lower().
_ODD_CASE = re.compile("[İıſ]")
_ENGLISH_WORDS = frozenset(STREETS.split("|"))
_DIGIT_WORD_SET = frozenset(DIGIT_WORDS)


def _forms(t: str, low: str, words: set[str]) -> list[str]:
    """Forms of address that a text could hold, given its lower case and words."""
    if not t.isascii() and _ODD_CASE.search(t):
        return [f for f, _ in ADDRESS]
    there = {
        "english": not words.isdisjoint(_ENGLISH_WORDS),
        # a letter of the house number may stand right before the street
        "front": not words.isdisjoint(_FRONT_WORDS) or any(w[1:] in _FRONT_WORDS for w in words),
        "back": not words.isdisjoint(_FRONT_WORDS),
        "german": any(w in low for w in _TAILS),
        "box": any(w in low for w in _BOX_PARTS),
    }
    return [f for f, yes in there.items() if yes]


def find(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of every mention, in order, none overlapping.

    Which patterns run depends on the words and digits that are there; most texts have none of them.
    """
    t, at = (text, None) if text.isascii() else folded(text)
    if "<" in t or "://" in t:
        t = _OTHER.sub(lambda m: " " * (m.end() - m.start()), t)
    low = t.lower()
    words = set(_WORD.findall(low))
    spans: list[tuple[float, int, int, str]] = []
    if "@" in t or not words.isdisjoint(_AT_WORDS) and (not words.isdisjoint(_DOT_WORDS) or _BRACKET.search(t)):
        spans += [(s, a, b, k) for a, b, k, s in _emails(t)]
    said = not words.isdisjoint(_DIGIT_WORD_SET)
    if _DIGIT.search(t):
        if _LONG_NUMBER.search(t):
            spans += [(s, a, b, k) for a, b, k, s in (*_phones(t), *_ids(t))]
            said = False
        forms = _forms(t, low, words)
        if forms:
            spans += [(s, a, b, k) for a, b, k, s in _addresses(t, forms)]
    if said:
        spans += [(2.0, m.start(), m.end(), "phone") for m in PHONE_SAID.finditer(t)]
    if not words.isdisjoint(_NAME_WORDS):
        spans += [(s, a, b, k) for a, b, k, s in _names(t)]
    if not words.isdisjoint(_CUE_WORDS):
        spans += [(s, a, b, k) for a, b, k, s in _said_names(t)]
    spans = [s for s in spans if s[0] >= CUTOFF]
    if not spans:
        return []
    rank = {"email": 0, "idnum": 1, "phone": 2, "address": 3, "name": 4}
    taken: list[tuple[int, int, str]] = []
    # An e-mail address holds against what stands inside it; then score, then length.
    for s, a, b, k in sorted(spans, key=lambda x: (x[3] != "email", -x[0], x[1] - x[2], rank[x[3]])):
        if all(b <= c or d <= a for c, d, _ in taken):
            taken.append((a, b, k))
    taken.sort()
    return [(at[a], at[b - 1] + 1, k) for a, b, k in taken] if at else taken


# ---- columns ------------------------------------------------------------------------------------------------------------


SPANS = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("kind", T.StringType())]))


@F.pandas_udf(SPANS)
def _find(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for s in batches:
        yield pd.Series([None if t is None else [{"start": a, "end": b, "kind": k} for a, b, k in find(t)] for t in s], dtype=object)


@F.pandas_udf(T.StringType())
def _redact(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for s in batches:
        yield pd.Series([None if t is None else redact_one(t) for t in s], dtype=object)


def redact_one(text: str) -> str:
    out, last = [], 0
    for a, b, k in find(text):
        out += [text[last:a], PLACEHOLDER[k]]
        last = b
    return "".join([*out, text[last:]])


def redact(c: str | Column) -> Column:
    """Every mention replaced by its placeholder, all else unchanged. NULL stays NULL, texts of any length are read whole."""
    return _redact(rx.col(c))


def mentions(df: DataFrame, text: str, *keys: str) -> DataFrame:
    """``keys, kind, nth``: a row per mention, counted from 1 within text and kind by place. Texts without one, NULL and
    empty texts give no rows."""
    own = df.select(*[quoted(k) for k in keys], F.col(quoted(text)).alias("__text")).where("__text <> ''")
    # nth is counted inside the array, so there is nothing to sort or shuffle; no filter on the spans, which would run
    # the Python function once more below itself
    out = own.withColumn("__spans", _find(F.col("__text")))
    out = out.select(*[quoted(k) for k in keys], F.explode(F.transform("__spans", _numbered)).alias("__m"))
    return out.select(*[quoted(k) for k in keys], F.col("__m.kind").alias("kind"), F.col("__m.nth").alias("nth"))


def _numbered(span: Column, i: Column) -> Column:
    earlier = F.filter(F.slice(F.col("__spans"), F.lit(1), i + 1), lambda o: o["kind"] == span["kind"])
    return F.struct(span["kind"].alias("kind"), F.size(earlier).alias("nth"))
