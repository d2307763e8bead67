import random

import numpy as np

from millrace.llm import subjects

R = random.Random(8)
TERMS = {"water": ["deep river", "cold lake", "high tide", "salt marsh", "spring flood"], "stone": ["old granite", "loose gravel", "red clay", "hard basalt", "white chalk"], "trade": ["market price", "loan default", "wage offer", "import duty", "tax bracket"]}
FRAMES = ["The plot compares the {} with the {} over time.", "Most readers ask why the {} matters more than the {}.", "Nothing here explains how the {} arises from the {}."]
PLAIN = ["Press the setup button and then watch the view.", "The slider starts at 12.", "This note was typed in a hurry.", "Set `alpha-rate` to 7 and press go again."]


def document(own):
    out = []
    for s in own:
        for _ in range(4):
            a, b = R.sample(TERMS[s], 2)
            out.append(R.choice(FRAMES).format(a, b))
    out += R.choices(PLAIN, k=3 if own else 6)
    R.shuffle(out)
    text = "## Notes\n\n" + " ".join(out)
    return text + ("\n\nto go\n  ask turtles [ set cold-lake 1 ]\nend" if R.random() < 0.3 else "")


def data(n):
    labels = [set(R.sample(list(TERMS), R.choice([0, 1, 1, 2]))) for _ in range(n)]
    return [document(sorted(x)) for x in labels], labels


def test_held_out_accuracy():
    texts, labels = data(240)
    m = subjects.fit(texts[:180], ["s"] * 180, labels[:180], list(TERMS))
    got = [{m.subjects[j] for j in np.flatnonzero(p)} for p in m.predict(texts[180:], ["s"] * 60)]
    assert sum(g == w for g, w in zip(got, labels[180:], strict=True)) >= 57


def test_running_text():
    s, seen = subjects.running_sentences("# Head\r\n<p>One river. Two lakes!</p>\n```\ncode here.\n```\nto go\n  tick\nend\nQ&A\n&nbsp;Three tides.")
    assert s == ["One river.", "Two lakes!", "Three tides."] and seen["code"] and seen["markup"] and seen["heading"]
    assert subjects.running_sentences(None)[0] == [] and subjects.running_sentences(" \n")[0] == []


def test_over_a_table(spark):
    texts, labels = data(80)
    docs = spark.createDataFrame([(i, t, "s") for i, t in enumerate(texts)] + [(900, None, None), (901, "", "s"), (902, "x " * 50_000, "s")], "doc_id long, text string, source string").selectExpr("*", "1 as subject")
    lab = spark.createDataFrame([(i, s) for i, x in enumerate(labels) for s in (x or {None})] + [(None, "water"), (5000, "stone")], "doc_id long, subject string")
    got = {(r["doc_id"], r["subject"]) for r in subjects.subjects_of(docs, lab, list(TERMS)).collect()}
    want = {(i, s) for i, x in enumerate(labels) for s in x}
    assert len(got & want) >= 0.95 * len(want) and len(got - want) <= 0.05 * len(want) and not {d for d, _ in got} & {900, 901, 902}
    assert subjects.subjects_of(docs.limit(0), lab, list(TERMS)).count() == 0
    assert subjects.subjects_of(docs, lab.limit(0), list(TERMS)).count() == 0
