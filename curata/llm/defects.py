"""Problem 1: responses and reasonings that are no proper answer to their prompt, by ordered rules."""

from __future__ import annotations

import re
from collections import Counter
from functools import cached_property

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shingles import WORD

# Stand-ins that say nothing, as their letters and digits in lower case.
STAND_INS = frozenset(
    "none null nil na empty nooutput noanswer noresponse nocontent noreply todo tbd tba fixme undefined nan placeholder pending void blank missing"
    " answer response output reply leer keine keineantwort keineausgabe vide aucune aucunereponse aucuneréponse vacio vacío ninguna sinrespuesta nessuna vuoto nenhuma vazio".split()
)

# Frequent function words of each language; a word of several languages counts for each.
FUNCTION_WORDS = {
    "en": "the of and to in is that it for on with as are this be at by from or an was which we you not but its if when has have so then each all how after before into than does do",
    "de": "der die das und ist nicht ein eine einen einem einer mit von den dem des zu auf für wenn wir sich im dass durch man nach bis auch oder noch nur wie über werden wird bei aus als an um es sind dadurch danach zuerst obwohl warum gib",
    "fr": "le la les de des du et est un une que qui dans pour sur avec ne pas ce cette ces au aux par plus il elle nous vous on se si mais ou donc puis après avant quand sans sont être à même",
    "es": "el la los las de del y es un una que en por para con no se su al lo como más pero si este esta cuando hay sin son ya qué cómo entre después antes porque ahora hasta aunque",
    "it": "il lo la gli le di del della dei e è un una che in per con non si su al da come più ma se questo questa quando sono dal nel alla anche ho dopo poi sulla",
    "pt": "o a os as de do da dos das e é um uma que em por para com não se no na ao como mais mas este esta quando são pelo isso já foi antes depois por agora",
    "nl": "de het een en van is dat niet op te zijn met voor aan er om dan of bij nog naar uit ook wordt maar we dit als door over",
}
_LANGUAGES = tuple(FUNCTION_WORDS)
_FUNCTION: dict[str, tuple[str, ...]] = {}
for _language, _words in FUNCTION_WORDS.items():
    for _word in _words.split():
        _FUNCTION[_word] = (*_FUNCTION.get(_word, ()), _language)

# Names by which a prompt may ask for a language.
LANGUAGE_NAMES = {
    "en": "english englisch englischer anglais inglés ingles inglese inglês",
    "de": "german deutsch deutscher allemand alemán aleman tedesco alemão",
    "fr": "french französisch französischer français francais francés frances francese francês",
    "es": "spanish spanisch spanischer espagnol español espanol castellano spagnolo espanhol",
    "it": "italian italienisch italien italiano",
    "pt": "portuguese portugiesisch portugais portugués portugues português portoghese",
    "nl": "dutch niederländisch néerlandais neerlandés olandese holandês",
}
_NAMED = {w: k for k, names in LANGUAGE_NAMES.items() for w in names.split()}

# Phrases by which a speaker declines, by language.
REFUSALS = re.compile(
    r"""
      \b(?:can['’]?t|cannot|can\ not|could\ not|couldn['’]?t|won['’]?t|will\ not|am\ unable\ to|[’']m\ unable\ to|am\ not\ able\ to|[’']m\ not\ able\ to|not\ going\ to|not\ allowed\ to|not\ permitted\ to)\ (?:be\ )?
        (?:help|helping|assist|answer|answering|provid\w+|writ\w+|produc\w+|continu\w+|complet\w+|compl(?:y|ying)|fulfil\w*|giv\w+|shar\w+|support|do\ (?:this|that)|creat\w+|generat\w+|proceed|engage|discuss)\b
    | \b(?:must|have\ to|need\ to|will)\ (?:respectfully\ )?(?:decline|refuse|pass\ on\ this)\b
    | \bI\ (?:decline|refuse)\ to\b
    | \brather\ not\ (?:give|answer|help|provide|write|say|do)\b
    | \bleave\ this\ (?:question|request|task|one)\ unanswered\b
    | \bnot\ something\ I\ (?:can|may|am\ able\ to)\b
    | \boutside\ (?:of\ )?what\ I\ (?:may|can|am\ allowed\ to)\b
    | \bnot\ comfortable\ (?:with\ )?(?:help|answer|provid|writ|giv)\w*
    | \b(?:kann|darf|werde|möchte|will)\ ich\b[^.!?\n]{0,60}\bnicht\ (?:helfen|bearbeiten|schreiben|beantworten|liefern|erstellen|geben|ausführen|weiterhelfen|antworten|übernehmen)\b
    | \bich\ (?:kann|darf|werde|möchte|will)\b[^.!?\n]{0,60}\bnicht\ (?:helfen|bearbeiten|schreiben|beantworten|liefern|erstellen|geben|ausführen|weiterhelfen|antworten|übernehmen)\b
    | \bmuss\ ich\b[^.!?\n]{0,60}\bablehnen\b | \bich\ muss\b[^.!?\n]{0,60}\bablehnen\b | \blehne\ ich\b[^.!?\n]{0,60}\bab\b | \bich\ lehne\b[^.!?\n]{0,60}\bab\b
    | \bist\ es\ mir\ nicht\ möglich\b | \bbin\ ich\ nicht\ in\ der\ Lage\b | \bich\ bin\ nicht\ in\ der\ Lage\b | \bsehe\ ich\ mich\ (?:nicht\ imstande|außerstande)\b
    | \bje\ dois\ (?:refuser|décliner)\b | \bje\ (?:refuse|préfère\ ne\ pas)\b | \bm['’]est\ impossible\ d
    | \bje\ ne\ (?:peux|puis|vais|suis|pourrai|saurais)\ pas\ (?:vous\ |y\ )?(?:aider|répondre|fournir|écrire|rédiger|donner|traiter|continuer|en\ mesure|autorisé|produire)
    | \b(?:no\ puedo|no\ podré|no\ voy\ a|no\ me\ es\ posible|no\ estoy\ en\ condiciones\ de|me\ resulta\ imposible)\ (?:ayudar|responder|escribir|proporcionar|dar|continuar|atender|ofrecer|facilitar|realizar|hacer)\w*
    | \bprefiero\ no\b | \b(?:debo|tengo\ que)\ (?:rechazar|declinar|negarme)\b | \bme\ niego\ a\b
    | \bnon\ posso\ (?:aiut|rispond|forni|scriv|continu)\w* | \bpreferisco\ non\b | \bdevo\ (?:rifiutare|declinare)\b
    | \bnão\ (?:posso|vou|consigo)\ (?:ajud|respond|fornec|escrev|continu)\w* | \bprefiro\ não\b | \b(?:devo|tenho\ de|tenho\ que)\ (?:recusar|declinar)\b
    """,
    re.IGNORECASE | re.VERBOSE,
)
#: One of these stands in every match of REFUSALS, in lower case.
_TRIGGERS = ahocorasick.Automaton()
for _trigger in (
    "can't |can’t |cant |cannot |can not |could not |couldn't |couldn’t |couldnt |won't |won’t |wont |will not |unable to |not able to |not going to |not allowed |not permitted |decline|refuse|pass on this|rather not |unanswered"
    "|not something i |what i |not comfortable | ich |ich |muss|mir nicht|je dois |je refuse|je préfère|impossible|je ne |no puedo |no podré |no voy |no me es |no estoy |me resulta |prefiero |debo |tengo que |me niego |non posso |preferisco |devo |não |prefiro |tenho "
).split("|"):
    _TRIGGERS.add_word(_trigger, True)
_TRIGGERS.make_automaton()
# Further phrases, searched for only where one of FURTHER_TRIGGERS stands.
FURTHER_REFUSALS = re.compile(
    r"""
      \b(?:goes|is|would\ be)\ against\ my\ (?:guidelines|policy|policies|principles|rules|programming)\b
    | \bdo(?:n['’]?t|\ not)\ have\ the\ (?:ability|permission|authority)\ to\b
    | \bне\ (?:могу|смогу|буду|имею\ права)\ (?:вам\ )?(?:с\ этим\ )?(?:помочь|ответить|выполнить|предоставить|написать|отвечать|помогать)
    | (?:お手伝い|お答え|お応え|対応|回答|提供|お役に立つこと)(?:は|が)?(?:でき|いたしかね|致しかね)(?:ません|ます)
    | (?:我|我们)?(?:无法|不能|不可以)(?:帮助|回答|提供|协助|满足|完成)
    """,
    re.IGNORECASE | re.VERBOSE,
)
FURTHER_TRIGGERS = ("against my ", "have the ability", "have the permission", "have the authority", "не могу", "не смогу", "не буду", "не имею", "でき", "かね", "无法", "不能", "不可以")
#: A refusal is the whole answer: text with that many words beside it is none.
REFUSAL_WORDS = 60

_ASCII_LETTER, _NOT_ASCII = re.compile("[A-Za-z]"), re.compile(r"[^\x00-\x7f]")
_THINK = re.compile(r"<think>\s*</think>", re.IGNORECASE)
_FENCE = re.compile(r"^[ \t]*(```|~~~)", re.MULTILINE)
_BLOCK = re.compile(r"(?s)(```|~~~).*?(?:\1|\Z)")
_INLINE = re.compile(r"`[^`\n]*`")
_HIDDEN = "​‌‍⁠﻿­"
_HIDDEN_ANY = re.compile(f"[{_HIDDEN}]")
_SENTENCE_END = ".!?…。！？"
_CLOSERS = "\"'”’»“)]}*_>）」』"
_ANSWER_LINE = re.compile(r"(?:####\s*\S.*|\\boxed\{.*\}|[-+$€£]?\s*\d[\d.,:/ ]*\s*%?)$")
_ASSIGNED = re.compile(r"[`*]?[\w.\[\]]+[`*]?\s*[=:]\s*\S+[`*]?$")


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


def visible(text: str | None) -> str:
    """The text without outer white space and invisible characters."""
    return _HIDDEN_ANY.sub("", text or "").strip()


def is_empty(text: str) -> bool:
    """Nothing, or a stand-in: no letter or digit outside code fences, empty thinking or empty brackets, or one of STAND_INS."""
    inner = _THINK.sub("", text)
    inner = re.sub(r"(?m)^[ \t]*(```|~~~)[\w+-]*[ \t]*$", "", inner)
    bare = "".join(words_of(inner))
    if not bare:
        return "`" not in inner.replace("```", "") if inner.strip() else True
    return bare in STAND_INS and len(inner.strip()) < 40


class Prompt:
    """What the rules need of a prompt, worked out once for both fields."""

    def __init__(self, text: str):
        self.text, self.words = text, words_of(text)

    @cached_property
    def vocabulary(self) -> set[str]:
        return set(self.words)

    @cached_property
    def tongue(self) -> tuple[str | None, str | None, set[str]]:
        """Language, script, and the languages that the prompt names."""
        own = prose(self.text)
        words = words_of(own)
        return language_of(words)[0], "latin" if own.isascii() else script_of(own), {_NAMED[w] for w in words if w in _NAMED}


def is_copy(text_words: list[str], prompts: list[Prompt]) -> bool:
    """At least six words, nine tenths of whose three-word sequences, or with about the prompt's length nearly all words, are a prompt's."""
    if len(text_words) < 6:
        return False
    for p in prompts:
        # with 0.88 of the sequences known, at least 0.8 of the words of six or more are
        if len(p.words) < 3 or sum(map(p.vocabulary.__contains__, text_words)) < 0.8 * len(text_words):
            continue
        prompt = p.words
        grams = list(zip(text_words, text_words[1:], text_words[2:]))
        known = set(zip(prompt, prompt[1:], prompt[2:]))
        if sum(g in known for g in grams) >= 0.88 * len(grams):
            return True
        if len(prompt) >= 10 and 0.8 <= len(text_words) / len(prompt) <= 1.25:
            shared = sum((Counter(text_words) & Counter(prompt)).values())
            if shared >= 0.95 * max(len(text_words), len(prompt)):
                return True
    return False


def prose(text: str) -> str:
    """The text without code blocks and code spans."""
    return _INLINE.sub(" ", _BLOCK.sub(" ", text))


def language_of(words: list[str]) -> tuple[str | None, Counter]:
    """The language with most function words, if it has three or more, and the counts of all."""
    score: Counter = Counter()
    for w in map(_FUNCTION.get, words):
        if w:
            for k in w:
                score[k] += 1
    if not score:
        return None, score
    top = score.most_common(2)
    if top[0][1] < 3 or (len(top) > 1 and top[1][1] == top[0][1]):
        return None, score
    return top[0][0], score


def script_of(text: str) -> str | None:
    """Script of most letters, by Unicode block: 'latin', 'greek', 'cyrillic', 'hebrew', 'arabic', 'cjk' or 'other'; None with under ten letters."""
    count = Counter({"latin": len(_ASCII_LETTER.findall(text))})
    for c in _NOT_ASCII.findall(text):
        if c.isalpha():
            o = ord(c)
            count["latin" if o < 0x250 or 0x1E00 <= o < 0x1F00 else "greek" if 0x370 <= o < 0x400 else "cyrillic" if 0x400 <= o < 0x530 else "hebrew" if 0x590 <= o < 0x600 else "arabic" if 0x600 <= o < 0x780 else "cjk" if 0x2E80 <= o < 0xA000 or 0xAC00 <= o < 0xD7B0 or 0xF900 <= o < 0xFB00 or o >= 0x20000 else "other"] += 1
    return count.most_common(1)[0][0] if sum(count.values()) >= 10 else None


def other_language(text: str, prompts: list[Prompt]) -> bool:
    """Prose in a language, or script, that is neither that of a prompt nor one a prompt asks for by name."""
    body = prose(text)
    script = "latin" if body.isascii() else script_of(body)
    language, score = language_of(words_of(body))
    seen = False
    for prompt in prompts:
        own_language, own_script, asked = prompt.tongue
        if language in asked:
            return False
        if own_script is None or script is None:
            continue
        if own_script != script:
            seen = seen or not asked
            continue
        if own_language is None or language is None or own_language == language:
            return False
        if score[language] < 1.5 * score[own_language] or score[language] < 4:
            return False
        seen = True
    return seen


_OPEN, _PAIRS = "([{（「『", {")": "(", "]": "[", "}": "{", "）": "（", "」": "「", "』": "『"}
_OPENER, _BRACKET = re.compile("[(\\[{（「『“«]"), re.compile("[(\\[{（「『)\\]}）」』]")
#: Enumerations such as "a)" and smileys close nothing; words in code spans and blocks count as no delimiters.
_LONE = re.compile(r"(?:^|[\s(])[\w]{1,3}\)|[:;]-?[()]")


def unclosed(text: str) -> bool:
    """A thought, bracket or quotation that is opened and never closed. Closers without an opener don't count."""
    if "<think" in text and text.count("<think>") > text.count("</think>"):
        return True
    return bool(_OPENER.search(text)) and _open_marks(text) and _open_marks(_LONE.sub(" ", prose(text)))


def _open_marks(text: str) -> bool:
    waiting: list[str] = []
    for c in _BRACKET.findall(text):
        if c in _OPEN:
            waiting.append(c)
        elif waiting and waiting[-1] == _PAIRS[c]:
            waiting.pop()
    return bool(waiting) or (text.count("“") > text.count("”") and "„" not in text) or text.count("«") > text.count("»")


def is_truncated(text: str, prompts: list[Prompt]) -> bool:
    """Ends inside code (an open fence or code span) or inside a sentence."""
    if len(_FENCE.findall(text)) % 2:
        return True
    last = text.rsplit("\n", 1)[-1].strip()
    if last.endswith(("```", "~~~")):
        return False
    end = last.rstrip(_CLOSERS + "`")
    if not end or end[-1] in _SENTENCE_END or last[-1] in _SENTENCE_END:
        return False
    if _ANSWER_LINE.fullmatch(last) or _ASSIGNED.fullmatch(last):
        return False
    if last.endswith("`") and last.count("`") % 2 == 0 and last.startswith("`"):
        return False
    if last.count("`") % 2 and "```" not in last:
        return True
    n = len(words_of(text))
    if n <= 3:  # a brief answer
        return last[-1] in ",;:([{=+-–—/\\"
    return not any(p.text.endswith(last) and len(last) > 10 for p in prompts)


def is_refusal(text: str, n_words: int) -> bool:
    """Declines to answer, with little beside it: sentences without such a phrase have no more than REFUSAL_WORDS words and 0.6 of all."""
    if "```" in text:
        return False
    low = text.lower()
    usual = next(_TRIGGERS.iter(low), None) is not None
    further = any(t in low for t in FURTHER_TRIGGERS)

    def declines(part: str) -> bool:
        return bool(usual and REFUSALS.search(part)) or bool(further and FURTHER_REFUSALS.search(part))

    if not declines(text):
        return False
    rest = sum(len(words_of(s)) for s in re.split(r"(?<=[.!?])\s+", text) if not declines(s))
    return rest <= REFUSAL_WORDS and rest <= n_words * 0.6


def prompts_of(*texts: str | None) -> list[Prompt]:
    return [Prompt(p) for p in map(visible, texts) if p]


def defects_of(field: str, text: str | None, prompts: list[Prompt], every: bool = False) -> list[str]:
    """Every defect of a field, in the order of the rules. A rule that explains the whole text (empty, copy, refusal) ends the list, so that a field has
    one row for what is wrong with it; with `every` all rules are tried and each that is triggered comes out."""
    body = visible(text)
    if not body:
        return ["empty"] if field == "response" else []
    if is_empty(body):
        return ["empty"]
    text_words = words_of(body)
    out = []
    for name, rule in (("copy", lambda: is_copy(text_words, prompts)), ("refusal", lambda: is_refusal(body, len(text_words)))):
        if rule():
            out.append(name)
            if not every:
                return out
    if bool(prompts) and other_language(body, prompts):
        out.append("language")
    if unclosed(body) or is_truncated(body, prompts):
        out.append("truncated")
    return out


def found(trajectory: DataFrame, every: bool = False) -> DataFrame:
    """traj_id, field, defect: one row for each defect of a response or reasoning; with `every`, of all that its rules trigger.

    A null or blank response is 'empty', a null or blank reasoning no defect; a missing prompt leaves out the rules that need one; a repair
    row's task (metadata.prompt_meta.prompt) counts as a prompt beside its wrapper. Rows with a null id are left out; a row given twice yields
    its rows once. Whole texts are read; an empty table gives no rows.
    """

    def run(iterator):
        for batch in iterator:
            columns = [batch.column(k).to_pylist() for k in range(5)]
            out = []
            for key, prompt, response, reasoning, task in zip(*columns):
                prompts = prompts_of(prompt, task)
                for field, text in (("response", response), ("reasoning", reasoning)):
                    out.extend((key, field, d) for d in defects_of(field, text, prompts, every))
            yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.int64()), *(pa.array([o[k] for o in out], pa.string()) for k in (1, 2))], ["traj_id", "field", "defect"])

    rows = trajectory.where("traj_id is not null").select("traj_id", "prompt", "response", "reasoning", F.col("metadata.prompt_meta.prompt").alias("task"))
    return rows.mapInArrow(run, "traj_id long, field string, defect string").distinct()
