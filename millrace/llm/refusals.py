"""Which answers decline or skip and tell nothing else.

A sentence declines if it fits a phrase of the dictionary, or by its composition: it denies (cannot, decline,
outside, keine ...), it speaks of answering or of the request (reply, comment, question, policy ...), it has a
speaker, and next to no word is left that would tell something. The classes of words are dictionaries of stems
for English, German, Spanish and French; for other languages there are phrases. Words of the question and
identifiers tell nothing new.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

from millrace.llm.languages import FUNCTION_WORDS

# Phrases that decline, in lower case.
PHRASES = re.compile(
    "|".join(
        (
            # English
            r"\b(?:i|we)(?:'m| am| are|'re)? (?:(?:really|simply|just|also) )?(?:can't|cannot|can not|could not|couldn't|won't|will not|would not|wouldn't|unable|not able|not allowed|not permitted|not going|not comfortable|uncomfortable|do not feel|don't feel|must decline|have to decline|decline|refuse|will pass|would rather not|abstain|must refuse)\b",
            r"\bi'd rather not\b|\brather not (?:reply|answer|say)",
            r"\bnot possible for (?:me|us)\b|\bno way for (?:me|us)\b|\bimpossible for (?:me|us)\b",
            r"\boutside what i may\b|\bbeyond what i (?:can|may)\b",
            r"\bno answer (?:will|can) be (?:given|provided)\b|\brequest (?:was |is )?(?:not fulfilled|declined|denied|refused|rejected)\b",
            r"^\W*(?:declined|refused|skip|skipped|skipping|pass)\b(?=\W|$)",
            r"\bno comments?\b",
            # German
            r"\b(?:kann|könnte|möchte|darf|werde|will) ich (?:\w+ ){0,3}?(?:nicht|nichts|keine)\b|\bich (?:kann|möchte|darf|werde|will) (?:\w+ ){0,4}?(?:nicht|nichts|keine)\b",
            r"\b(?:lehne|muss) (?:ich )?(?:es |das |diese \w+ )?(?:leider )?(?:ab\b|ablehnen)|\bkeine auskunft\b|\bkeine antwort geben\b",
            # Spanish
            r"\bno (?:puedo|podemos|voy a|quiero|debo|me es posible|es posible para mí)\b|\bprefiero no\b|\b(?:debo|tengo que) (?:rechazar|declinar)\b|\bme niego\b|\brechazo (?:esta|esa|la)\b|\bdeclino\b",
            # French
            r"\bje ne (?:peux|puis|veux|souhaite|suis|vais|saurais)\b.*\b(?:pas|rien|en mesure|aider|répondre)\b|\bje ne (?:peux|puis|saurais)\b|\bm'est impossible\b|\bje (?:dois|préfère|refuse|décline)\b.*(?:décliner|refuser|ne pas|répondre|demande|parler)|\bje refuse\b",
        )
    )
)
# Phrases that decline where the speaker is named or nothing else is told; of agents in a model they tell something.
BARE_PHRASES = re.compile(r"\bunable to (?:help|answer|say|comment|assist|comply)\b|\bcan(?:'t|not) (?:help|assist|answer|comply)\b|\bnicht (?:beantworten|helfen|antworten)\b")
# Phrases that decline in further languages (Italian, Portuguese, Dutch, Polish, Russian, Chinese, Japanese, Korean).
ELSEWHERE = re.compile(
    r"\bnon (?:posso|possiamo|sono in grado|intendo|voglio|desidero|mi è possibile|sono autorizzat\w|ho accesso|dispongo)\b|\bmi rifiuto\b|\bpreferisco non\b|\bdevo (?:rifiutare|declinare)\b"
    r"|\bnão (?:posso|podemos|consigo|vou|quero|devo|estou autorizad\w|tenho (?:acesso|permissão)|me é possível)\b|\brecuso\b|\bprefiro não\b"
    r"|\b(?:kan|mag|wil|zal) ik\b.*\b(?:niet|geen)\b|\bik (?:kan|mag|wil|zal)\b.*\b(?:niet|geen)\b|\bik weiger\b"
    r"|\bnie (?:mogę|możemy|jestem w stanie|chcę|będę|wolno mi)\b|\bodmawiam\b"
    r"|\bне (?:могу|можем|буду|хочу|имею)\b|\bотказываюсь\b|\bне в состоянии\b"
    r"|(?:无法|無法|不能|不便|不会|不會|拒绝|拒絕|不予)(?:回答|提供|帮助|協助|协助|评论|評論|回应|讨论|透露|满足)|(?:お答え|回答|お手伝い|対応|お話し)(?:でき|することはでき|は致しかね|いたしかね)|(?:답변|도움|도와).*수 없"
)
#: Words of a sentence in one of these languages, at most: a longer one tells something besides.
ELSEWHERE_WORDS = 18
#: Words that stand neither in a dictionary nor in the question, at most, in a sentence with a phrase that declines.
TOLD_WORDS = 5
# Polite openings and endings that tell nothing.
COURTESY = re.compile(
    "|".join(
        (
            r"^\W*(?:i'm |i am )?(?:so |very )?sorry\b[^.]{0,40}$|^\W*(?:my )?apologies\b.{0,30}$|^\W*i apologi[sz]e\b.{0,40}$|^\W*unfortunately\W*$|^\W*regrettably\W*$|^\W*(?:no|nein|non|yes|hello|hi|ok|okay)\W*$",
            r"\bplease (?:ask|try|rephrase|contact|consult)\b|\btry (?:rephrasing|asking|again|another)\b|\bis there anything else\b|\blet me know if\b|\bhope you understand\b|\bmay want to (?:consult|ask|try)\b|\bthank(?:s| you) for\b.{0,40}$|\banything else (?:i can|you)\b|\bfeel free to\b|\bi must be honest\b.{0,5}$",
            r"^\W*(?:es )?tut mir leid\W*$|\bbitte (?:stellen|fragen|haben sie verständnis|formulieren|versuchen)\b|\bhoffe auf ihr verständnis\b|^\W*leider\W*$",
            r"^\W*lo siento\W*$|\bpor favor\b.{0,60}$|^\W*lamentablemente\W*$|\bespero que (?:lo )?(?:entienda|comprenda)\b",
            r"^\W*(?:je suis )?désolée?\W*$|\bveuillez\b|\bj'espère que vous comprenez\b|^\W*malheureusement\W*$|^\W*je regrette\W*$|\bn'hésitez pas\b",
            r"^\W*(?:mi dispiace|desculpe|lamento|helaas|przepraszam|извините|к сожалению|抱歉|对不起|申し訳ありません(?:が)?|죄송합니다)\W*$",
        )
    )
)
# Stems by what their words do in a sentence that declines. A star stands for any ending.
STEMS = {
    "deny": (
        "cannot can't not won't couldn't wouldn't don't doesn't isn't shouldn't unable no never declin* refus* reject* den(?:y|ied|ies|ying) skip* unanswered outside beyond against prohibit* forbid* restrict* withhold* disallow* impossible unwilling uncomfortable pass abstain* nothing rather "
        "nicht nichts kein* nie niemals ablehn* abgelehnt lehne verweiger* verzichte* unbeantwortet außerhalb gegen untersag* verboten unmöglich überspring* weder enthalte "
        "no nunca ni tampoco rechaz* declin* niego negarme omit* absten* imposible incapaz fuera contra prohib* impid* prefiero "
        "non mi rifiuto rifiutare declinare não recuso prefiro niet geen weiger odmawiam не отказываюсь "
        "ne n' pas rien jamais aucun* refus* déclin* incapable hors contraire interdit* abstien* dépass* préfère"
    ),
    "act": (
        "answer* repl(?:y|ies|ying) respon[ds]* help* assist* comment* discuss* address* say* tell talk* speak* speculat* provid* elaborat* fulfil* comply* disclos* reveal* engag* weigh proceed unanswered know "
        "antwort* beantwort* helf* hilf* weiterhelfen sagen äußern äußere kommentier* auskunft auskünfte angaben sprechen mitteil* eingehen stellung nennen unbeantwortet weiß "
        "respond* contest* ayud* comentar* hablar decir ofrec* proporcion* opin* atend* tratar facilit* saber sé "
        "répon[ds]* aid* commenter parler dire fournir discut* exprim* aborder prononcer sais"
    ),
    "about": (
        "question* request* prompt* inquir* quer(?:y|ies) topic* subject matter* scope polic(?:y|ies) guideline* ai assistant language information detail* knowledge access expertise remit permission competence* "
        "frage* anfrage* thema themen aufgabenbereich* zuständig* richtlinie* information* einzelheiten details ki sprachmodell assistent* zugriff kenntnis* befug* "
        "pregunta* solicitud* petición tema* asunto alcance ámbito política* normas información detalle* ia asistente lenguaje acceso conocimiento* competenc* permiso consulta "
        "demande* sujet cadre champ domaine portée règles politique* détail* assistant* langage accès connaissance* compétence* autorisation requête"
    ),
    "speaker": (
        "i i'm i'd i've i'll me my mine we we're we'll us our sorry afraid unfortunately regrettably sadly apolog* ich mir mich mein* wir uns unser* leider bedau* leid "
        "yo mi mis me puedo podemos debo tengo dispongo quiero estoy nosotros nos nuestr* siento lamento lamentable* je j' m' moi mes mon ma nous notre désolé* regrette malheureusement"
    ),
    "rest": (
        "something anything leave have fall* currently given one hope understand* thank* please ask* try* other another else kindly however honest must possible able allowed permitted comfortable like want going go here present moment time point way free let consult feel text model about with regarding concerning further more any enough hello hi yes ok okay "
        "entschuldig* verzeih* tut bitte dank* hoffe verständnis gern* möglich lage erlaubt gestattet lassen liegt fällt dazu hierzu darüber muss möchte darf kann könnte werde will machen geben eine einen meines meiner nein hierüber davon worüber "
        "disculp* perdón gracias favor espero entiend* comprend* capaz posible autorizad* permitid* otra otro eso esa ese ello modelo "
        "merci veuillez espère compren* possible mesure droit autorisé* capable pouvoir peux puis dois autre* excus* ai suis hésitez cela ça cet en y modèle suis"
    ),
}


def _matcher(stems: str) -> re.Pattern:
    return re.compile("(?:" + "|".join(s[:-1] + r".*" if s.endswith("*") else s for s in dict.fromkeys(stems.split())) + r")\Z")


_CLASSES = [(name, _matcher(stems)) for name, stems in STEMS.items()]
_FUNCTION = {w for ws in FUNCTION_WORDS.values() for w in ws}
_WORD = re.compile(r"[^\W\d_]+(?:'(?:t|m|d|s|re|ll|ve)\b|')?")
_BREAK = re.compile(r"(?<=[.!?])[\"')\]]*\s+|(?<=[。！？])|\n+")
_CODE = re.compile(r"`[^`]*`")
_IDEOGRAMS = re.compile(r"[\u3040-\u30ff\u4e00-\u9fff\uac00-\ud7af]")
_NONE: frozenset[str] = frozenset()


@lru_cache(65536)
def _class_of(word: str) -> frozenset[str]:
    out = frozenset(name for name, m in _CLASSES if m.match(word))
    return out or (frozenset(("function",)) if word in _FUNCTION else _NONE)


def _sentences(text: str) -> Iterator[str]:
    """One after another, since most texts are told from a refusal by their first sentence."""
    at = 0
    for m in _BREAK.finditer(text):
        yield text[at : m.start()]
        at = m.end()
    yield text[at:]


def _declines(sentence: str, words: list[str], classes: list[frozenset[str]], has: set[str], known: set[str]) -> bool:
    told = [w for w, c in zip(words, classes, strict=True) if not c]
    new = sum(w not in known for w in told)
    if new <= TOLD_WORDS and (PHRASES.search(sentence) or (("speaker" in has or not told) and BARE_PHRASES.search(sentence))):
        return True
    if "act" not in has and "about" not in has:
        return False
    if "speaker" in has:
        return new <= 2
    return not told and "act" in has and ("about" in has or words[0] in ("cannot", "unable"))


def is_refusal(text: str, question: str | None = None) -> bool:
    """Every sentence declines or is a courtesy, and one declines."""
    declines = False
    known: set[str] | None = None
    for s in _sentences(text.lower().replace("’", "'")):
        s = _CODE.sub("x", s) if "`" in s else s
        words = _WORD.findall(s)
        if not words:
            continue
        classes = [_class_of(w) for w in words]
        has: set[str] = set().union(*classes)
        elsewhere = not s.isascii() and _IDEOGRAMS.search(s)
        if "deny" in has or elsewhere:
            if known is None:
                known = set(_WORD.findall(question.lower())) if question else set()
            if ("deny" in has and _declines(s, words, classes, has, known)) or (len(words) <= ELSEWHERE_WORDS and ELSEWHERE.search(s)):
                declines = True
                continue
        elif "rest" not in has and "speaker" not in has:
            return False
        if not COURTESY.search(s):
            return False
    return declines
