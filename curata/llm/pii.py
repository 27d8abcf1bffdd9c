"""Problem 8: personal information in free text, by anchor expansion.

One Aho-Corasick pass over the text, in lower case and with every digit written as 0, finds anchors: at-signs in all their spellings, schemes, shapes
of numbers, identifier and account cues, words for streets, titles, carriers of names, the lexicon's name words and starts of sentences. Nothing
else searches the whole text. Around each anchor a deterministic local parser expands to the boundaries of an email address, telephone number,
identity or account number, street address or name, and validates its form. Overlapping pieces go to the kind that comes first in KINDS, then to
the longer piece.
"""

from __future__ import annotations

import base64
import re
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from . import encode

KINDS = ("email", "id_number", "phone", "address", "name")

# --- email -----------------------------------------------------------------------------------------------------------------------------------
AT_MARKS = ("@", " at ", "(at)", "[at]", "{at}", "<at>", "( at )", "[ at ]", "arroba", " chez ", "(ät)", "[ät]")
_AT = re.compile(r"\s?@\s?|\s?[\[({<]\s?(?:at|@|arroba|ät)\s?[\])}>]\s?|\s(?:at|arroba|chez)\s", re.IGNORECASE)
_DOT = r"(?:\.|\s?[\[({<]\s?(?:dot|punkt|point|punto|\.)\s?[\])}>]\s?|\s(?:dot|punkt|point|punto)\s)"
_LABEL = r"[^\W_](?:[\w-]{0,61}[^\W_])?"
_DOMAIN = re.compile(rf"{_LABEL}(?:{_DOT}{_LABEL})+(?![\w@])", re.IGNORECASE)
_DOT_ANY = re.compile(_DOT, re.IGNORECASE)
_SPELLED_DOT = re.compile(r"\b(?:dot|punkt|point|punto)\b", re.IGNORECASE)
_TOP = re.compile(r"[^\W\d_]{2,}$")
#: An at-sign behind this ends the user part of an address on the web.
_AUTHORITY = re.compile(r"\w://[^\s/@]*$")
# Endings of files and of code that stand behind an at-sign.
NOT_DOMAINS = frozenset(("jit", "py", "cu", "json"))

# --- numbers ---------------------------------------------------------------------------------------------------------------------------------
# Words that introduce an identity number.
ID_CUES = ("ssn", "social security", "soc. sec", "nino", "national insurance", "ni number", "nir", "sécu", "sécurité sociale", "securite sociale", "steuer-id", "steuer-identifikation", "idnr", "ausweis", "dni", "nie", "nif", "pasaporte", "passport", "reisepass", "passeport", "tax id", "id card", "identity card", "carte d'identité", "personalausweis", "versicherungsnummer", "seguridad social", "codice fiscale", "bsn")
# Words that introduce an account number.
ACCOUNT_CUES = ("iban", "account no", "account number", "acct no", "sort code", "routing number", "kontonummer", "konto-nr", "numéro de compte", "número de cuenta", "card number", "kartennummer")
# Words that introduce a telephone number.
PHONE_CUES = ("tel", "tél", "phone", "hotline", "call", "fax", "mobil", "móvil", "handy", "cell", "number is", "número es", "numéro est", "nummer ist", "llama al", "appelez le", "joignable au", "erreichbar unter", "desk on", "anrufen", "reach me", "ring ", "whatsapp", "contact")
#: How numbers begin or go on, with 0 for any digit: one of these stands in every number that a parser below accepts without a cue.
SHAPES = ("00 00", "00-00", "00.00", "00/00", "00 /", "0) 0", "0)0", "0 (0", "+0", "+(", "000000", "0-0000000", "0 00 00 00")
_ID_FORMS = [
    re.compile(p)
    for p in (
        r"(?<![\w.-])\d{3}-\d{2}-\d{4}(?![\w-]|\.\d)",
        r"(?<![\w.-])(?<!\d )\d{3} \d{2} \d{4}(?![\w-]|\.\d| \d)",
        r"(?<![\w-])[A-Za-z]{2} ?\d{2} ?\d{2} ?\d{2} ?[A-Da-d](?![\w-])",
        r"(?<![\w.-])[12] \d{2} \d{2} (?:\d{2} \d{3} \d{3}|\d{5} \d{3}|\d{2}\d{3} ?\d{3})(?: \d{2})?(?![\w-]| \d)",
        r"(?<![\w.+-])(?<!\d )\d{2} \d{3} \d{3} \d{3}(?![\w-]| \d)",
        r"(?<![\w.-])\d{8}-?[A-Z](?![\w-])",
        r"(?<![\w.-])[XYZxyz]-?\d{7}-?[A-Za-z](?![\w-])",
    )
]
_IBAN = re.compile(r"(?<![\w-])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![\w-])")
#: What may stand between a cue and its number: the rest of the cue's word, marks, a verb, a word for number.
_CUE_GAP = re.compile(r"[\w.()]*[\s:.#°ºª=\"'(–-]*(?:(?:is|was|ist|lautet|est|es|è)\b[\s:]*)?(?:(?:no|nr|nº|núm|num|number|nummer|numéro|code)\b\.?[\s:.#°=-]*)?(?:(?:is|was|ist|lautet|est|es|è)\b[\s:]*)?", re.IGNORECASE)
#: After a cue also numbers without marks, with up to three letters before or after: at least seven digits.
_CUED_ID = re.compile(r"(?<!\w)(?:[A-Z]{1,3}[ -]?|[a-z]{1,2})?\d(?:[ .-]?\d){6,16}(?:-?[A-Za-z]| [A-Z])?(?![\w-])")
_CUED_ACCOUNT = re.compile(r"(?<!\w)\d(?:[ -]?\d){5,18}(?![\w-])")
_NUMBER = re.compile(r"(?<![\w.,/-])(?:\+|\(\+?)?\d(?:[\d]|[ .()/-](?=[\d( /-]))*\d(?![\w])(?!-\w|\.\d)")
# Words whose number is no telephone or identity number.
LABELS = ("ticket", "issue", "table", "page", "line", "row", "row id", "seed", "run", "build", "version", "step", "offset", "shape", "size", "port", "index", "sequence", "sweep")
_LABELLED = re.compile(rf"(?<![^\W_])(?:{'|'.join(LABELS)})s?[ \t#:=\"'(]{{0,3}}$", re.IGNORECASE)
_IN_NUMBER = frozenset("0123456789 .()/+-")

# --- addresses -------------------------------------------------------------------------------------------------------------------------------
_CAP = r"[A-ZÀ-ÖØ-ÞŒ][\w'’]*(?:-[A-ZÀ-ÖØ-ÞŒ]?[\w'’]+)*"
# Words for streets by language.
EN_STREETS = "Street St Road Rd Lane Ln Avenue Ave Drive Dr Way Close Court Ct Terrace Crescent Rise Row Walk Mews Place Pl Square Sq Boulevard Blvd Hill Gate Gardens Grove Parade Wharf Yard Path Circle Green View Park Quay Bank".split()
FR_STREETS = "rue avenue av boulevard bd quai chemin impasse allée place cours passage sentier route square".split()
ES_STREETS = "Calle C/ Avenida Avda Av Plaza Pza Paseo Pº Camino Ronda Travesía Carrera Callejón Glorieta Rambla".split()
IT_STREETS = "Via Viale Piazza Corso Vicolo Rua Travessa Praça".split()
DE_STREETS = "straße strasse str weg allee ring gasse platz ufer damm steig pfad hof chaussee graben markt".split()
_NO = r"(?:n\.?\s?[º°o]\.?\s?|nº\s?|núm\.?\s?|num\.?\s?|#)?"
_EN = re.compile(rf"(?<![\w.,/-])(?<!\d )\d{{1,5}}[A-Za-z]?,? (?:{_CAP} ){{1,4}}(?:{'|'.join(EN_STREETS)})\b(?:(?<=\bSt)\.|(?<=\bRd)\.|(?<=\bAve)\.|(?<=\bLn)\.|(?<=\bDr)\.|(?<=\bCt)\.|(?<=\bPl)\.|(?<=\bSq)\.|(?<=\bBlvd)\.)?")
_FR = re.compile(rf"(?<![\w.,/-])\d{{1,4}}(?: ?(?i:bis|ter|quater)\b|[A-Za-z]\b)?,? (?i:{'|'.join(FR_STREETS)})\b\.? (?i:(?:de la|de l['’]|des|du|de|d['’]|aux|au|à la)\s?)?{_CAP}(?: (?i:(?:de la|de l['’]|des|du|de|d['’]|et)\s?)?{_CAP})*")
_ES = re.compile(rf"(?<!\w)(?:{'|'.join(re.escape(s) for s in ES_STREETS)})\.?\s(?:(?:de las|de los|de la|del|de|las|los|la|el)\s)?{_CAP}(?:\s(?:(?:de las|de los|de la|del|de|y)\s)?{_CAP})*,?\s{_NO}\d{{1,4}}(?:\s?[A-Za-z]\b(?!\w))?")
_IT = re.compile(rf"(?<!\w)(?:{'|'.join(IT_STREETS)})\s(?:(?:della|delle|degli|dello|dei|del|di|da|das|dos|do|de)\s)?{_CAP}(?:\s{_CAP})*,?\s\d{{1,4}}(?:/?[A-Za-z]\b)?(?![\w.]\d)")
_DE = re.compile(rf"(?<![\w-])(?:[A-ZÀ-ÖØ-Þ][\w-]*?(?:{'|'.join(DE_STREETS)})|(?:[A-ZÀ-ÖØ-Þ][\w-]*[ -])+(?:{'|'.join(s.capitalize() for s in DE_STREETS)}))\b\.? ?\d{{1,4}}(?:\s?[a-zA-Z]\b)?(?![\w.]\d)")
# Small words that may follow an address; before any other word in lower case, "36 Fast Lane samples", it is a count and a name of a thing.
_AFTER_ADDRESS = re.compile(r" +(?!(?:in|at|by|near|on|from|to|until|till|before|after|since|for|with|this|next|last|every|each|when|where|which|while|as|or|and|if|but|ist|hat|im|am|bei|und|oder|bis|ab|seit|est|à|au|en|et|ou|le|la|dans|depuis|avant|es|está|y|o|desde|hasta|antes|cerca)\b)[a-zà-öø-ÿ]+\b")

# --- names -----------------------------------------------------------------------------------------------------------------------------------
# Titles; they introduce a name and are no part of it.
TITLES = "Mr Mrs Ms Miss Mx Dr Prof Herr Frau Hr Fr Mme Mlle M Monsieur Madame Sr Sra Srta Don Doña D Dª Dña Dipl.-Ing Ing Maître Me Sir Lady".split()
_PART = r"(?:[A-ZÀ-ÖØ-ÞŒ][a-zß-öø-ÿœ'’]+|[A-ZÀ-ÖØ-ÞŒ]{2,})"
_FULL = rf"{_PART}(?:-{_PART})*"
_INITIAL = r"[A-ZÀ-ÖØ-Þ]\."
_TITLE = rf"(?:{'|'.join(sorted(map(re.escape, TITLES), key=len, reverse=True))})\.?"
_NAME = re.compile(rf"(?:{_FULL}, {_FULL}(?: {_INITIAL})?|{_FULL}, {_INITIAL}|(?:{_INITIAL} ?)+{_FULL}|{_FULL}(?: {_INITIAL})+ {_FULL}|{_FULL} {_FULL}|{_FULL} {_INITIAL}(?!\w))")
_CAPITAL = re.compile("[A-ZÀ-ÖØ-ÞŒ]")
_WORDS = re.compile(_FULL + "|" + _INITIAL)
_IS_INITIAL = re.compile(_INITIAL)
_TITLED = re.compile(rf"(?<!\w){_TITLE} $")
# Fields that hold a name, and phrases before one.
FIELDS = ("from", "to", "cc", "bcc", "signed-off-by", "reviewed-by", "co-authored-by", "acked-by", "tested-by", "reported-by", "author", "authors", "assignee", "assignees", "owner", "responsable", "bearbeiter", "bearbeiterin", "verfasser", "auteur", "autor", "autora", "reviewer", "contact", "name", "nom", "nombre", "sender", "maintainer")
PHRASES = ("spoke to", "spoke with", "talked to", "met with", "reviewed with", "reviewed by", "approved by", "assigned to", "on behalf of", "booked by", "signed by", "written by", "thanks to", "thank you", "thank you,", "ask", "met", "call", "my name is", "merci à", "demandez à", "je m'appelle", "danke an", "dank an", "fragen sie", "ich heiße", "gracias a", "hablé con", "pregunta a", "me llamo", "wende dich an", "grazie a")
_BEFORE = re.compile(
    rf"(?:^|[\s\"'#>*\-\[(])(?:{'|'.join(FIELDS)})\"?\s?[:=]\s?\"?$"
    r"|(?:^|\n)\s*(?:[-*]\s|\[[\d:]+\]\s\w+\s)?(?:\w+:\s)?[—–]\s$"
    rf"|\b(?:{'|'.join(PHRASES)})\s(?:{_TITLE}\s)?$",
    re.IGNORECASE,
)
#: Verbs by which a mail names its writer.
_WRITES = re.compile(r"\s(?:wrote|writes|schrieb|schreibt|escribió|escribe|a écrit|écrit|ha scritto)\s?:", re.IGNORECASE)
WRITES = ("wrote:", "writes:", "schrieb:", "schreibt:", "escribió:", "escribe:", "écrit :", "écrit:", "scritto:")
#: Between a name and what belongs to it in records: a mail address, number or street follows.
_CARRIED = re.compile(r"\s?<|\s?\|\s?|;\s?")
CLOSINGS = ("cordialement", "bien à vous", "mit freundlichen grüßen", "viele grüße", "beste grüße", "un saludo", "saludos", "atentamente", "regards", "cheers", "thanks", "sincerely", "yours", "best", "cordiali saluti")
_CLOSING = re.compile(rf"(?:^|\n)\s*(?:\w+:\s)?(?:[-*]\s|\[[\d:]+\]\s\w+\s)?(?:best |kind )?(?:{'|'.join(CLOSINGS)})[^\n]{{0,20}},?\s*\n+\s*(?:[-—–]\s*)?(?:\[[\d:]+\]\s\w+\s)?(?:\w+:\s)?$", re.IGNORECASE)
#: What stands at the head of a line of a list, log or chat.
_HEAD = re.compile(r"[ \t]*(?:[-*>]\s|\[[\d:.]+\]\s\w+\s|\w+:\s)*")
_LOWER_NEXT = re.compile(r" [a-zà-öø-ÿ]{2,}")
SENTENCE_ENDS = (". ", "! ", "? ", "\n")
# Levels of log lines, and German words that stand before a noun at the start of a sentence, where nouns have a capital too.
LEVELS = frozenset("INFO WARN WARNING DEBUG ERROR TRACE FATAL NOTICE CRITICAL".split())
GERMAN_BEFORE_NOUN = frozenset(
    "der die das den dem des ein eine einen einem einer eines kein keine keinen keiner mein meine dein deine sein seine ihr ihre unser unsere euer eure beide beiden alle allen viele vielen einige einigen manche mancher jede jeder jedes jeden"
    " diese dieser dieses diesen jene jener jenes welche welcher welches solche solcher mehrere wenige zur zum im am beim vom ins ans aufs bei mit nach von zu aus für gegen ohne um durch auf an in über unter vor hinter neben zwischen seit bis wegen trotz während".split()
)
#: A word whose lower case the vocabulary ranks before this is too usual to begin a name.
USUAL = 6000


class Dictionary:
    """What public tokenizers' vocabularies say of a word: their merges are ranked by how often a piece occurs, so a word that is one piece in lower case
    is an ordinary word. A vocabulary that is missing or empty is an error: without it every word would pass as unusual, and other names come out."""

    def __init__(self, *rank_files: str):
        self.ranks = []
        for path in rank_files:
            with open(path, "rb") as f:
                self.ranks.append({base64.b64decode(t): int(r) for t, r in map(bytes.split, f)})
            if not self.ranks[-1]:
                raise ValueError(f"no ranks in {path}")

    @lru_cache(maxsize=100_000)
    def usual(self, word: str) -> bool:
        """Among the most frequent words of one of the vocabularies."""
        low = (" " + word.lower()).encode()
        return any(r.get(low, USUAL) < USUAL for r in self.ranks)

    @lru_cache(maxsize=100_000)
    def proper(self, word: str) -> bool:
        """A word that the vocabularies don't have in lower case, or have more often with a capital."""
        low, cap = (" " + word.lower()).encode(), (" " + word.capitalize()).encode()
        return bool(self.ranks) and low not in self.ranks[0] and all(r.get(low, 1 << 30) >= r.get(cap, 1 << 29) for r in self.ranks)


@lru_cache(maxsize=2)
def dictionary(*rank_files: str) -> Dictionary:
    return Dictionary(*rank_files)


_ZEROS = {ord(c): "0" for c in "123456789"}


class Anchors:
    """The automaton of all anchors, once for each worker."""

    def __init__(self, lexicon: list[tuple[str, str]], rank_files: tuple[str, ...] = (encode.RANK_FILE, encode.MULTI_RANK_FILE)):
        self.names = {t.lower() for t, _ in lexicon if t}
        self.dictionary = dictionary(*rank_files)
        kinds: dict[str, tuple[str, ...]] = {}

        def add(kind, words):
            for w in words:
                kinds[w.lower()] = (*kinds.get(w.lower(), ()), kind)

        add("email", AT_MARKS)
        add("scheme", ("mailto:", "tel:"))
        add("id", ID_CUES)
        add("account", ACCOUNT_CUES)
        add("number", SHAPES)
        add("phone", PHONE_CUES)
        add("en", [f" {w}" for w in EN_STREETS])
        add("fr", [f"{w} " for w in FR_STREETS] + [f"{w}. " for w in FR_STREETS])
        add("es", [f"{w} " for w in ES_STREETS] + [f"{w}. " for w in ES_STREETS])
        add("it", [f"{w} " for w in IT_STREETS])
        add("de", DE_STREETS)
        add("before", [f"{t}{e}" for t in TITLES for e in (" ", ". ")])
        add("before", [f"{f}{e}" for f in FIELDS for e in (":", " :", '":', "=", " =")] + [f"{p} " for p in PHRASES] + ["— ", "– "])
        add("writes", WRITES)
        add("closing", CLOSINGS)
        add("name", self.names)
        add("start", SENTENCE_ENDS)
        self.automaton = ahocorasick.Automaton()
        for word, of in kinds.items():
            self.automaton.add_word(word.translate(_ZEROS), (len(word), of))
        self.automaton.make_automaton()

    def places(self, text: str) -> dict[str, list[tuple[int, int]]]:
        """Start and end of each anchor, by kind, in the order of their ends."""
        low = text.lower()
        if len(low) != len(text):  # a letter whose lower case is longer stays as it is
            low = "".join(c.lower() if len(c.lower()) == 1 else c for c in text)
        out: dict[str, list[tuple[int, int]]] = {}
        for last, (n, of) in self.automaton.iter(low.translate(_ZEROS)):
            for kind in of:
                out.setdefault(kind, []).append((last + 1 - n, last + 1))
        return out


def _emails(text: str, anchors: list[tuple[int, int]]):
    """From each at-sign to both sides: the local part to the left, labels and dots to the right."""
    done = 0
    for start, end in anchors:
        if start < done:
            continue
        at = next((m for p in (start - 2, start - 1, start) if p >= 0 and (m := _AT.match(text, p)) and m.end() >= end), None)
        if at is None:
            continue
        first = at.start()
        while first > done and (text[first - 1].isalnum() or text[first - 1] in "_.+%-"):
            first -= 1
        while first < at.start() and text[first] in ".":
            first += 1
        if not 1 <= at.start() - first <= 64 or text[at.start() - 1] == "." or _AUTHORITY.search(text, max(0, first - 300), at.start()):
            continue
        domain = _DOMAIN.match(text, at.end())
        if domain is None or (at.group().strip().lower() in ("at", "arroba", "chez") and not _SPELLED_DOT.search(domain.group())):
            continue
        last = _DOT_ANY.split(domain.group())[-1]
        if _TOP.search(last) and last.lower() not in NOT_DOMAINS:
            done = domain.end()
            yield first, done


def _valid_iban(value: str) -> bool:
    """The check digits of an international account number."""
    bare = value.replace(" ", "")
    return 15 <= len(bare) <= 34 and int("".join(str(int(c, 36)) for c in bare[4:] + bare[:4])) % 97 == 1


def is_phone(number: str, cued: bool) -> bool:
    """The form of a telephone number: international, or national with the usual groups; bare digits only with a leading zero or a cue."""
    digits = re.sub(r"\D", "", number)
    groups = re.findall(r"\d+", number)
    shape = [len(g) for g in groups]
    if number.count("(") != number.count(")"):
        return False
    if number.startswith(("+", "(+")) or (number.startswith("00") and len(digits) >= 11):
        return 9 <= len(digits) <= 16
    if len(shape) == 1:
        return (len(digits) == 10 and digits[0] == "0") or (cued and 9 <= len(digits) <= 12)
    if shape in ([3, 3, 4], [1, 3, 3, 4]):
        return shape[0] == 3 or digits[0] == "1"
    if digits[0] == "0" or number.startswith("(0"):
        return 9 <= len(digits) <= 12 and shape[0] <= 5 and max(shape) <= 9
    if shape in ([3, 3, 3], [3, 2, 2, 2], [2, 3, 2, 2]):
        return cued or shape == [3, 3, 3]
    return cued and 9 <= len(digits) <= 12 and len(shape) <= 5


def _numbers(text: str, places: dict[str, list[tuple[int, int]]]):
    """start, end, place in KINDS. Each shape, cue or scheme is expanded to the whole stretch of digits and their marks around it, once."""
    done = passed = 0
    for start, end in sorted(places.get("number", []) + [(e, e) for _, e in places.get("scheme", [])]):
        if end <= done:
            continue
        first = start
        while first > done and text[first - 1] in _IN_NUMBER:
            first -= 1
        done = end
        while done < len(text) and text[done] in _IN_NUMBER:
            done += 1
        first, last = max(0, first - 4), min(len(text), done + 8)  # room for letters and for what must not follow
        for form in _ID_FORMS:
            for m in form.finditer(text, first, last):
                if not _LABELLED.search(text, max(0, m.start() - 20), m.start()):
                    yield m.start(), m.end(), 1
        for m in _NUMBER.finditer(text, first, last):
            value, at = m.group(), m.start()
            if len(value) < 9:
                continue
            if value.startswith("(") and value.count("(") > value.count(")"):
                value, at = value[1:], at + 1
            before = text[max(passed, at - 40) : at].lower()  # a cue before another number belongs to that
            passed = m.end()
            if not _LABELLED.search(before) and is_phone(value, any(c in before for c in PHONE_CUES)):
                yield at, at + len(value), 2
    for kind, form in (("id", _CUED_ID), ("account", _CUED_ACCOUNT)):
        for _, end in places.get(kind, []):
            gap = _CUE_GAP.match(text, end)
            for at in {gap.end() if gap else end, end}:
                if m := form.match(text, at):
                    yield m.start(), m.end(), 1
                elif kind == "account" and (m := _IBAN.match(text, at)) and _valid_iban(m.group()):
                    yield m.start(), m.end(), 1
    passed = 0
    for start, _ in places.get("number", []):  # behind a country's letters, its check digits and perhaps a bank's letters
        if start < passed:
            continue
        word = passed = _word_start(text, start)
        while passed < len(text) and text[passed].isalnum():
            passed += 1
        begins = [start - 2, word]
        if word > 1 and text[word - 1] == " " and text[word - 2].isupper():
            begins.append(_words_back(text, word, 2))
        for at in begins:
            if at >= 0 and text[at : at + 2].isupper() and (m := _IBAN.match(text, at)) and _valid_iban(m.group()):
                yield m.start(), m.end(), 1


def _words_back(text: str, at: int, words: int) -> int:
    """Start of the so-manieth word before a place, on the same line."""
    for _ in range(words):
        while at > 0 and text[at - 1] == " ":
            at -= 1
        while at > 0 and text[at - 1] not in " \n":
            at -= 1
    return at


def _addresses(text: str, places: dict[str, list[tuple[int, int]]]):
    """Around each word for a street, in the forms of its language."""
    found = []
    for start, end in places.get("en", []):
        if text[start + 1 : start + 2].isupper() and not text[end : end + 1].isalnum():
            first = _words_back(text, start, 5)
            found += [m for m in _EN.finditer(text, first, min(len(text), end + 1)) if m.end() >= end]
    for start, _ in places.get("fr", []):
        first = _words_back(text, start, 2)
        found += [m for p in range(first, start) if text[p].isdigit() and (m := _FR.match(text, p)) and m.end() > start]
    for kind, form in (("es", _ES), ("it", _IT)):
        for start, _ in places.get(kind, []):
            if text[start].isupper() and (m := form.match(text, start)):
                found.append(m)
    for start, end in places.get("de", []):
        if _DE_NUMBER.match(text, end):
            for first in {_words_back(text, start, n) for n in (0, 1, 2, 3)} | {_word_start(text, start)}:
                if m := _DE.match(text, first):
                    if m.end() > end:
                        found.append(m)
    for m in found:
        if not _AFTER_ADDRESS.match(text, m.end()):
            yield m.start(), m.end()


_DE_NUMBER = re.compile(r"\.? ?\d")


def _word_start(text: str, at: int) -> int:
    while at > 0 and (text[at - 1].isalnum() or text[at - 1] in "_-"):
        at -= 1
    return at


def _windows(text: str, places: dict[str, list[tuple[int, int]]], carried: list[int]):
    """Stretches in which a name may begin, from the anchors that point at names; ordered and merged."""
    out = []
    for s, e in places.get("name", []):
        if text[s].isupper() and not text[e : e + 1].isalnum() and not (s and text[s - 1].isalnum()):
            first = _word_start(text, s)
            out.append((_words_back(text, first, 2), s + 1))
    out += [(e, e + 3) for _, e in places.get("before", []) if text[e : e + 3].strip(' "')[:1].isupper()]
    out += [(_words_back(text, s, 4), s) for s, _ in places.get("writes", [])]
    out += [(_words_back(text, s, 5), s) for s in carried]
    for _, e in places.get("closing", []):
        line = text.find("\n", e)
        if 0 <= line < e + 24:
            m = _HEAD.match(text, line + 1)
            out.append((m.end(), m.end() + 1))
    end = -1
    merged: list[list[int]] = []
    for s, e in sorted(out):
        if s <= end:
            merged[-1][1] = end = max(end, e)
        else:
            merged.append([s, e])
            end = e
    return merged


def _names(text: str, places: dict[str, list[tuple[int, int]]], carried: list[int], anchors: Anchors):
    """Names by form, with evidence: a lexicon word in them, a title, a field or phrase before, a verb of writing, mail address, number or street behind,
    a place of their own; or, at the start of a sentence, a form of name of words that no vocabulary has in lower case."""
    ends = {p for p in carried}
    usual, proper = anchors.dictionary.usual, anchors.dictionary.proper

    def known_word(part: str) -> bool:
        low = part.lower()
        return low in anchors.names or any(p in anchors.names for p in low.split("-"))

    def parse(m):
        """The words of a form of name at m, without those that are titles or usual words; None with the place to go on from otherwise."""
        words = _WORDS.findall(m.group())
        title = words[0].rstrip(".") in TITLES
        if words[0] in LEVELS:
            return None
        # M. and D. are initials unless a whole name follows
        if title and (not _IS_INITIAL.fullmatch(words[0]) or _NAME.match(text, m.start() + len(words[0]) + 1)):
            return None
        if not _IS_INITIAL.fullmatch(words[0]) and usual(words[0]) and not known_word(words[0]):
            return None
        return words

    for first, last in _windows(text, places, carried):
        at = first
        while capital := _CAPITAL.search(text, at, last):
            at = capital.end()
            m = _NAME.match(text, at - 1)
            if m is None:
                continue
            start, end = m.span()
            if start and (text[start - 1].isalnum() or text[start - 1] in "_@/`"):
                continue
            words = parse(m)
            if words is None:
                at = start + len(_WORDS.match(text, start).group())
                continue
            if text[end : end + 1].isalnum() or text[end : end + 1] in ("_", "("):
                continue
            line = text[max(0, start - 80) : start]
            titled, before = _TITLED.search(line), _BEFORE.search(line)
            gap = _CARRIED.match(text, end)
            after = _WRITES.match(text, end) or (gap and gap.end() in ends)
            full = [w for w in words if not _IS_INITIAL.fullmatch(w)]
            known = [w for w in full if known_word(w)]
            plain = [w for w in full if not known_word(w) and usual(w)]
            alone = _HEAD.fullmatch(text, text.rfind("\n", 0, start) + 1, start) and (end == len(text) or text[end] == "\n")
            sure = len(known) >= 2 or titled or before or after or (known and len(known) * 2 >= len(full))
            sure = sure or (alone and (known or _CLOSING.search(text[max(0, start - 120) : start])))
            if sure and not plain:
                yield start, end
                at = end
    for at in [0, *(e for _, e in places.get("start", []))]:
        begin = _HEAD.match(text, at).end()
        if text[begin : begin + 1].isupper() and (m := _NAME.match(text, begin)) and _LOWER_NEXT.match(text, m.end()) and (words := parse(m)):
            full = [w for w in words if not _IS_INITIAL.fullmatch(w)]
            if "," not in m.group() and any(map(proper, full[-1].split("-"))) and not any(usual(w) for w in full) and words[0].lower() not in GERMAN_BEFORE_NOUN:
                yield m.span()


def pieces(text: str | None, anchors: Anchors) -> list[tuple[int, int, str]]:
    """start, end, kind of every piece, in the order of the text."""
    if not text:
        return []
    places = anchors.places(text)
    spans = [(s, e, 0) for s, e in _emails(text, places["email"])] if "email" in places else []
    spans += _numbers(text, places)
    spans += [(s, e, 3) for s, e in _addresses(text, places)]
    spans += [(s, e, 4) for s, e in _names(text, places, [s for s, _, _ in spans], anchors)]
    out: list[tuple[int, int, str]] = []
    taken = bytearray(len(text))
    for s, e, k in sorted(set(spans), key=lambda x: (x[2], x[0] - x[1], x[0])):
        if not any(taken[s:e]):
            taken[s:e] = b"\1" * (e - s)
            out.append((s, e, KINDS[k]))
    return sorted(out)


def mask(text: str | None, found: list[tuple[int, int, str]]) -> str | None:
    """The text with [EMAIL], [PHONE], [ID_NUMBER], [ADDRESS] or [NAME] in place of each piece; null stays null."""
    if text is None:
        return None
    out, at = [], 0
    for s, e, kind in found:
        out += [text[at:s], f"[{kind.upper()}]"]
        at = e
    return "".join([*out, text[at:]])


def _lexicon(name_lexicon: DataFrame) -> list[tuple[str, str]]:
    """The lexicon, a fixed list; more than 200,000 words aren't taken for one."""
    rows = [(r[0], r[1]) for r in name_lexicon.where("token is not null").select("token", "kind").limit(200_001).collect()]
    if len(rows) > 200_000:
        raise ValueError("name_lexicon has more than 200,000 rows")
    return rows


def scan(documents: DataFrame, name_lexicon: DataFrame) -> DataFrame:
    """doc_id, kinds, vals, masked of every document: one narrow pass over whole texts."""
    lexicon = documents.sparkSession.sparkContext.broadcast(_lexicon(name_lexicon))

    def run(iterator):
        anchors = Anchors(lexicon.value)
        for batch in iterator:
            kinds, values, masked = [], [], []
            for text in batch.column(1).to_pylist():
                got = pieces(text, anchors)
                kinds.append([k for _, _, k in got])
                values.append([text[s:e] for s, e, _ in got])
                masked.append(mask(text, got))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(kinds, pa.list_(pa.string())), pa.array(values, pa.list_(pa.string())), pa.array(masked, pa.string())], ["doc_id", "kinds", "vals", "masked"])

    return documents.select("doc_id", "text").mapInArrow(run, "doc_id long, kinds array<string>, vals array<string>, masked string")


def found(documents: DataFrame, name_lexicon: DataFrame) -> DataFrame:
    """doc_id, kind, value of every piece, distinct; null and empty texts have none; rows with a null id are left out."""
    rows = scan(documents.where("doc_id is not null"), name_lexicon).selectExpr("doc_id", "inline(arrays_zip(kinds, vals))")
    return rows.selectExpr("doc_id", "kinds as kind", "vals as value").distinct()


def masked(documents: DataFrame, name_lexicon: DataFrame) -> DataFrame:
    """doc_id and the text with placeholders, one row for each row of documents."""
    return scan(documents, name_lexicon).select("doc_id", "masked")
