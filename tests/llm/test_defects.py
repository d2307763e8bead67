import pytest

from millrace.llm import defects
from millrace.llm.languages import language_of

Q = "How does raising `alpha-rate` above 12 change the way foxes respond to `beta-cost` when no hares are left?"
SOUND = [
    "A higher `alpha-rate` delays the hares. The reset in `beta-cost` clears it for all foxes.",
    "Yes.", "No.", "`alpha-rate`", "Only `alpha-rate`.", "About 12 ticks.", "None of the foxes do.",
    "I cannot stress this enough: look at the code first. The foxes fall back on `alpha-rate`.",
    "Unfortunately the plot hides it, yet the code is clear. The hares vanish after a while.",
    "The relevant settings are:\n- `alpha-rate`\n- `beta-cost`",
    "The foxes wait.\n```\nto alpha-rate\n  set beta-cost 0\nend\n```",
    "The foxes wait. (This was tested twice.)",
    'A foreign note puts it like this: "En la mitad norte del mundo abundan los zorros." The foxes wait for the hares and then move on.',
    Q + " A simple test is to freeze `beta-cost` at 12 and watch whether the foxes still react to the others.",
]
BAD = {
    "empty": [None, "", " \n\t", "​", "—", "**", "[]", "N/A.", "Answer:", "<answer></answer>", '{"answer": ""}', "```\n```", "(empty)", "..."],
    "refusal": ["I'm sorry, but I can't help with that. Please ask something else.", "SKIP", '{"skip": true, "reason": "X"}', "Je dois décliner cette demande.", "Diese Frage möchte ich nicht beantworten.", "Lo siento, no puedo ayudar con eso.", "I will pass on this one.", "No. I refuse to speculate about foxes."],
    "copied_question": [Q, Q.lower(), f"You asked: {Q}", f'"{Q}"', f"{Q} {Q}", Q.replace("?", "."), Q.replace("respond", "resspond")],
    "truncated": ["A higher `alpha-rate` delays the hares. The reset in `beta-cost` clears", "The foxes wait. In `alpha-rate` the", "The foxes wait. (see the hares", "The foxes wait for,", "The hares leave…", "The foxes wait. There are two.\n1. foxes first.\n2.", "It runs:\n```\nto go\n  ask", '{"question": "q", "answer": "The foxes'],
    "other_language": ["Später wachsen die Füchse, während die Hasen zurückgehen. Ohne die Hasen ändert sich wenig.", "Sure! Sans les lièvres, presque rien ne change. Plus tard, les renards augmentent."],
}


@pytest.fixture(scope="module")
def endings():
    texts = [s for s in SOUND if len(s) > 40] * 3
    from collections import Counter

    n, o = Counter(), Counter()
    for t in texts:
        seen, over = defects.contexts(t)
        n.update(seen[:-1])
        o.update(over[:-1])
    return defects.Endings([(*c, n[c], o[c]) for c in n])


@pytest.mark.parametrize("answer", SOUND)
def test_sound(answer, endings):
    assert defects.defect_of(Q, answer, endings) is None


@pytest.mark.parametrize("kind,answer", [(k, a) for k, v in BAD.items() for a in v])
def test_defects(kind, answer, endings):
    assert defects.defect_of(Q, answer, endings) == kind


def test_over_a_table(spark, rows):
    data = [(i, Q, a) for i, a in enumerate(SOUND + BAD["empty"])] + [(99, None, "Später wachsen die Füchse, während die Hasen gehen."), (100, "", "x" * 300_000 + ".")]
    df = spark.createDataFrame(data, "response_id long, question string, answer string").selectExpr("*", "1 as defect")
    got = rows(defects.find_defects(df, "response_id", "question", "answer"))
    assert got == sorted(((len(SOUND) + i, "empty") for i in range(len(BAD["empty"]))), key=str)
    assert defects.find_defects(df.limit(0), "response_id", "question", "answer").count() == 0


def test_languages():
    assert language_of("The foxes of the north are not in the plot.") == "en"
    assert language_of("Die Füchse im Norden sind nicht auf der Karte.") == "de"
    assert language_of("Les renards du nord ne sont pas sur la carte.") == "fr"
    assert language_of("Los zorros del norte no están en el mapa.") == "es"
    assert language_of("`alpha`") is None and language_of(None) is None


# Written for this test; none of them stands in the tables.
DECLINED = [
    "As an AI language model, I do not have access to that information.",
    "I'm afraid that is something I have to leave unanswered.",
    "This question falls outside my scope.",
    "Sorry, no comment on this one.",
    "It is against policy to reply to this.",
    "Cannot provide details about it.",
    "Answering this would go against my guidelines.",
    "I don't have enough information to answer. Please try another question.",
    "Dazu kann ich leider keine Angaben machen.",
    "Das liegt außerhalb meines Aufgabenbereichs.",
    "Ich muss diese Frage unbeantwortet lassen.",
    "No dispongo de esa información.",
    "Esta pregunta está fuera de mi alcance.",
    "Cette question dépasse mes compétences.",
    "Je n'ai pas le droit d'en parler.",
    "Non posso rispondere a questa domanda.",
    "Não posso ajudar com isso.",
    "Ik kan deze vraag niet beantwoorden.",
    "Я не могу ответить на этот вопрос.",
    "抱歉，我无法回答这个问题。",
]
TOLD = [
    "The foxes cannot answer the call of the hares.",
    "It cannot help because `beta-cost` is zero.",
    "No, the question of the hares does not change it.",
    "We cannot see the hares because `vision` is low, so they starve.",
    "The reporter does not provide details about energy.",
    "Nothing else.",
    "The hares refuse to move, and so the foxes starve within 12 ticks.",
]


@pytest.mark.parametrize("answer", DECLINED)
def test_refusals_of_other_wording(answer, endings):
    assert defects.defect_of(Q, answer, endings) == "refusal"


@pytest.mark.parametrize("answer", TOLD)
def test_denials_that_tell_something(answer, endings):
    assert defects.defect_of(Q, answer, endings) is None


FOREIGN = [
    "Gli agenti si muovono a caso e perdono energia a ogni passo. Quando non ci sono lepri, le volpi muoiono.",
    "As lebres comem a relva e as raposas caçam as lebres. Quando não há lebres, as raposas morrem.",
    "Лисы охотятся на зайцев, пока не кончится энергия. Потом они умирают.",
    "狐狸追逐野兔，直到能量耗尽。然后它们会死去。",
    "キツネはウサギを追いかけます。エネルギーがなくなると死にます。",
    "De vossen jagen op de hazen zolang er energie is, en daarna sterven zij.",
    "Lisy polują na zające, gdy są głodne, i tracą energię z każdym krokiem.",
    "Schafe fressen Gras.",
]


@pytest.mark.parametrize("answer", FOREIGN)
def test_answers_in_further_languages(answer, endings):
    assert defects.defect_of(Q, answer, endings) == "other_language"


def test_short_texts_and_same_language():
    assert [language_of(t) for t in ("Schafe fressen Gras.", "Sheep eat grass quickly.", "Los lobos cazan ovejas.", "energy", "12")] == ["de", "en", "es", None, None]
    assert language_of("Лисы охотятся на зайцев.") == "cyrillic" and language_of("It uses the letter π for the angle.") == "en"


def test_all_contexts_are_kept_and_their_number_is_bounded(spark):
    marks = "".join(chr(c) for c in range(0x2500, 0x2600))
    df = spark.createDataFrame([(f"The {m} fox {m}{m} waits. It",) for m in marks], "t string")
    got = defects.count_endings(df)
    assert {c[1] for c in got} | {c[2] for c in got} <= {"^", "the", "m", "w", ".", "it"}
    assert sum(c[3] for c in got) == 256 * 7
