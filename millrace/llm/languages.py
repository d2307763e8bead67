"""Which language a text is in.

Letters of another script decide at once. Else function words vote: those of four languages in full, of further
languages the ones that tell it apart. Where too few of them stand, profiles of character trigrams decide,
fitted on a sample text of each language, if one of them fits clearly better than all others.
"""

from __future__ import annotations

import math
import re
from collections import Counter

# Frequent function words.
FUNCTION_WORDS = {
    "en": "the of and to in is that it for on with as at by from this be are was were not or an have has had but they their which when if then than would could will can may what how why where who does do did should only over after before while until more most each every many other into out up no there these those its you your we our i me my".split(),
    "de": "der die das und ist nicht ein eine einer eines dem den des von mit auf für im in zu zum zur sich als auch es an bei nach aus wie wenn aber oder nur noch wird werden war sind hat haben ich sie er wir man warum wodurch was welche welcher wann obwohl falls sobald während bis erst schon ohne wer dazu hierzu diese dieser dieses alle alles mehr unter über".split(),
    "fr": "le la les des du de et est ne pas un une en que qui dans pour par sur au aux avec ce cette ces se son sa ses il elle on nous vous je mais ou où comme plus sans dès quand comment pourquoi si tandis surtout d'une d'un puis ici l' d' n' qu' peu sous afin même alors être ont sont presque rien".split(),
    "es": "el la los las de del y es no un una unos en que se por para con su sus al lo como más pero o ya muy sin sobre este esta estos cada vez cuando cómo qué por cuándo mientras antes solo sólo hasta si donde dónde porque también entre ni yo me casi nada poco aquí rato después todo vuelva vale".split(),
}
_WORD = re.compile(r"[^\W\d_]+(?:['’](?=[^\W\d_]))?")
_NOISE = re.compile(r"```.*?(?:```|$)|`[^`\n]*`?|\"[^\"]*\"|“[^”]*”|«[^»]*»|„[^“”]*[“”]|<[^<>\n]*>|https?://\S+", re.S)
#: Words before the first of . ! ? : that are put aside as an opening.
OPENING_WORDS = 2
_OPENING = re.compile(r"^\W*(?:\w+\W+){0,%d}?\w+\s*[.!:?]+(?=\s)" % (OPENING_WORDS - 1))
_WEIGHT: dict[str, dict[str, float]] = {}
for _lang, _words in FUNCTION_WORDS.items():
    for _w in set(_words):
        _WEIGHT.setdefault(_w, {})[_lang] = 1.0
for _w, _by in _WEIGHT.items():
    _n = len(_by)
    for _lang in _by:
        _by[_lang] = 1.0 / _n  # a word of several languages speaks for each of them a little



# Frequent words of further languages that the four above don't have.
FURTHER_WORDS = {
    "it": "il lo gli di che non è sono della del dei delle nel nella degli perché più anche questo quando ogni hanno alla dal dalla molto senza fino ma viene vengono sempre quindi loro ed agli ai".split(),
    "pt": "o os um uma não é são do da dos das no na nos nas em pelo pela mais também quando cada até com porque isso este esta seu sua ele ela mas muito sem ao aos já então".split(),
    "nl": "het een van en niet dat zijn voor met wordt worden door maar ook naar bij deze dit als dan uit om aan zij heeft hebben wanneer elke geen over nog wel tot".split(),
    "pl": "i w nie na się jest że do z to jak są przez od ale po dla czy gdy gdzie tylko który która które oraz ich jego może każdy".split(),
    "sv": "och att det som en på är av för med den till inte har de ett om men var när från vid eller efter också då alla sig blir varje".split(),
    "da": "og at det som en på er af for med den til ikke har de et om men var når fra ved eller efter også da alle sig bliver hver".split(),
    "ro": "și în nu este care sunt pe la din cu pentru mai dar când fiecare lor după această acest până fără prin".split(),
    "cs": "a se na je že v není s jako jsou do pro ale když po od jen která který které jejich nebo každý také při".split(),
    "tr": "ve bir bu için ile da de değil olarak gibi daha çok her olan sonra ama ne kadar kadar ise zaman".split(),
    "fi": "ja on ei se että ovat mutta kun joka niin myös tai jos sen kuin jokainen sitten ennen jälkeen".split(),
    "id": "yang dan di tidak ini itu untuk dengan dari pada adalah ke akan oleh jika setiap karena mereka saat".split(),
}
# Sample texts that the profiles of trigrams are fitted on.
SAMPLES = {
    "en": "The sheep eat the grass that grows back after some time, and the wolves hunt the sheep whenever they are hungry. Each animal loses a little energy with every step, so those which find nothing to eat will die soon. When there are too many wolves the herd shrinks, and then the hunters starve as well. People who watch this world can change how fast the grass grows, how many animals are born and what happens at the borders. Most of the time both groups rise and fall one after another, but sometimes one of them is gone for good.",
    "de": "Die Schafe fressen das Gras, das nach einiger Zeit wieder wächst, und die Wölfe jagen die Schafe, sobald sie Hunger haben. Jedes Tier verliert bei jedem Schritt etwas Energie, deshalb sterben bald alle, die nichts zu fressen finden. Wenn es zu viele Wölfe gibt, schrumpft die Herde, und dann verhungern auch die Jäger. Wer diese Welt beobachtet, kann ändern, wie schnell das Gras wächst, wie viele Tiere geboren werden und was an den Grenzen geschieht. Meistens steigen und fallen beide Gruppen nacheinander, aber manchmal verschwindet eine von ihnen für immer.",
    "fr": "Les moutons mangent l'herbe qui repousse après un certain temps, et les loups chassent les moutons dès qu'ils ont faim. Chaque animal perd un peu d'énergie à chaque pas, de sorte que ceux qui ne trouvent rien à manger meurent bientôt. Quand il y a trop de loups, le troupeau diminue, puis les chasseurs meurent de faim à leur tour. Celui qui observe ce monde peut changer la vitesse à laquelle l'herbe pousse, le nombre d'animaux qui naissent et ce qui se passe aux frontières. Le plus souvent les deux groupes montent et descendent l'un après l'autre, mais parfois l'un d'eux disparaît pour toujours.",
    "es": "Las ovejas comen la hierba que vuelve a crecer después de algún tiempo, y los lobos cazan a las ovejas cuando tienen hambre. Cada animal pierde un poco de energía con cada paso, así que pronto mueren los que no encuentran nada que comer. Cuando hay demasiados lobos el rebaño disminuye, y entonces también los cazadores pasan hambre. Quien observa este mundo puede cambiar la rapidez con que crece la hierba, cuántos animales nacen y qué ocurre en los bordes. La mayoría de las veces los dos grupos suben y bajan uno tras otro, pero a veces uno de ellos desaparece para siempre.",
    "it": "Le pecore mangiano l'erba che ricresce dopo qualche tempo, e i lupi cacciano le pecore quando hanno fame. Ogni animale perde un po' di energia a ogni passo, perciò presto muoiono quelli che non trovano nulla da mangiare. Quando ci sono troppi lupi il gregge diminuisce, e allora anche i cacciatori soffrono la fame. Chi osserva questo mondo può cambiare la velocità con cui cresce l'erba, quanti animali nascono e che cosa succede ai confini. Il più delle volte i due gruppi salgono e scendono uno dopo l'altro, ma qualche volta uno di loro scompare per sempre.",
    "pt": "As ovelhas comem a erva que volta a crescer depois de algum tempo, e os lobos caçam as ovelhas quando têm fome. Cada animal perde um pouco de energia a cada passo, por isso morrem em breve os que não encontram nada para comer. Quando há lobos demais o rebanho diminui, e então também os caçadores passam fome. Quem observa este mundo pode mudar a rapidez com que a erva cresce, quantos animais nascem e o que acontece nas fronteiras. Na maioria das vezes os dois grupos sobem e descem um depois do outro, mas às vezes um deles desaparece para sempre.",
    "nl": "De schapen eten het gras dat na enige tijd weer groeit, en de wolven jagen op de schapen zodra zij honger hebben. Elk dier verliest bij iedere stap een beetje energie, daarom sterven de dieren die niets te eten vinden al snel. Wanneer er te veel wolven zijn wordt de kudde kleiner, en dan verhongeren ook de jagers. Wie naar deze wereld kijkt kan veranderen hoe snel het gras groeit, hoeveel dieren er geboren worden en wat er aan de randen gebeurt. Meestal stijgen en dalen beide groepen na elkaar, maar soms verdwijnt een van hen voorgoed.",
}
# Ranges of letters of other scripts.
_SCRIPTS = {
    "greek": "\u0370-\u03ff", "cyrillic": "\u0400-\u052f", "hebrew": "\u0590-\u05ff", "arabic": "\u0600-\u06ff\u0750-\u077f", "indic": "\u0900-\u0dff", "thai": "\u0e00-\u0e7f",
    "japanese": "\u3040-\u30ff", "han": "\u3400-\u4dbf\u4e00-\u9fff", "korean": "\u1100-\u11ff\uac00-\ud7af",
}
_SCRIPT = re.compile("|".join(f"(?P<{name}>[{span}]+)" for name, span in _SCRIPTS.items()))
#: Letters of other scripts count this often, since their words have fewer.
SCRIPT_WEIGHT = 2
#: Trigrams that a text needs for a decision by profiles, and by how much the best profile must fit better than the second, in the mean of a trigram and in all (natural logarithms).
LEAST_TRIGRAMS, LEAST_GAIN, LEAST_TOTAL = 12, 0.35, 6.0
#: Below this number of votes, or of different words that vote, the profiles are asked first.
FEW_VOTES = 3


def _trigrams(text: str) -> list[str]:
    t = f" {' '.join(_WORD.findall(text.lower()))} "
    return [t[i : i + 3] for i in range(len(t) - 2)]


def _profiles() -> tuple[list[str], dict[str, list[float]], list[float]]:
    counts = {lang: Counter(_trigrams(t)) for lang, t in SAMPLES.items()}
    kinds = len(set().union(*counts.values()))
    size = {lang: sum(c.values()) for lang, c in counts.items()}
    rate = lambda n, lang: math.log((n + 0.3) / (size[lang] + 0.3 * kinds))
    table = {g: [rate(counts[lang][g], lang) for lang in SAMPLES] for g in set().union(*counts.values())}
    return list(SAMPLES), table, [rate(0, lang) for lang in SAMPLES]


_LANGS, _PROFILE, _UNSEEN = _profiles()


def by_profile(text: str) -> str | None:
    """The language whose trigrams fit clearly best, null if none does or the text is too short."""
    grams = _trigrams(text)
    seen = [_PROFILE[g] for g in grams if g in _PROFILE]
    if len(grams) < LEAST_TRIGRAMS or len(seen) < len(grams) / 2:
        return None
    score = [sum(x) for x in zip(*seen, strict=True)]
    order = sorted(range(len(score)), key=score.__getitem__, reverse=True)
    gain = score[order[0]] - score[order[1]]
    return _LANGS[order[0]] if gain >= LEAST_TOTAL and gain >= LEAST_GAIN * len(seen) else None


def by_script(text: str) -> str | None:
    """The script most of the letters are in, null for Latin; Japanese if any kana stand beside Han."""
    other: Counter[str] = Counter()
    for m in _SCRIPT.finditer(text):
        other[m.lastgroup] += len(m.group())
    if not other:
        return None
    latin = sum(map(len, _WORD.findall(text))) - sum(other.values())
    if SCRIPT_WEIGHT * sum(other.values()) <= latin:
        return None
    return "japanese" if other["japanese"] else other.most_common(1)[0][0]


_FURTHER: dict[str, list[str]] = {}
for _lang, _words in FURTHER_WORDS.items():
    for _w in set(_words):
        _FURTHER.setdefault(_w, []).append(_lang)


def by_function_words(text: str) -> str | None:
    """One of the four languages whose function words are known in full, null where too few speak clearly for one."""
    votes = dict.fromkeys(FUNCTION_WORDS, 0.0)
    for w in _WORD.findall(_NOISE.sub(" ", text).lower()):
        for lang, x in _WEIGHT.get(w.replace("’", "'"), {}).items():
            votes[lang] += x
    first, second = sorted(votes, key=votes.get, reverse=True)[:2]
    return first if votes[first] >= 1.5 and votes[first] >= 1.6 * votes[second] else None


def language_of(text: str | None) -> str | None:
    """A language's two letters or a script's name; null where nothing speaks clearly for one.

    Code, identifiers, quotations, markup and a short opening don't count.
    """
    if not text:
        return None
    t = _NOISE.sub(" ", text).strip()
    m = _OPENING.match(t)
    if m and len(t) > m.end():
        t = t[m.end() :]
    if not t.isascii() and (script := by_script(t)):
        return script
    votes = dict.fromkeys(FUNCTION_WORDS, 0.0)
    further: Counter[str] = Counter()
    kinds: set[str] = set()
    for w in _WORD.findall(t.lower()):
        w = w.replace("’", "'")
        if w in _WEIGHT:
            kinds.add(w)
            for lang, x in _WEIGHT[w].items():
                votes[lang] += x
        for lang in _FURTHER.get(w, ()):
            further[lang] += 1
    order = sorted(votes, key=votes.get, reverse=True)
    best, second = votes[order[0]], votes[order[1]]
    lang, n = further.most_common(1)[0] if further else (None, 0)
    if (max(best, n) < FEW_VOTES or len(kinds) < FEW_VOTES) and (fits := by_profile(t)):
        return fits
    if lang:
        if n >= 2 and n >= 1.6 * best:
            return lang
    return order[0] if best >= 1.5 and best >= 1.6 * second else None
