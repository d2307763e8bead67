"""Queries and operators pass over all rows and whole texts."""

import random
import re
from collections import Counter

from pyspark.sql import functions as F

from millrace.functions import lexical
from millrace.operators import planner, srcparse
from millrace.plans import catalogue, views


def test_old_line_ends(spark):
    texts = ["to a ; x\nend\nto b\nend", "to a ; x\r\nend\r\nto b\r\nend", "to a ; x\rend\rto b\rend"]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select(srcparse.procedures(srcparse.strip_comments("t")), F.length(srcparse.strip_comments("t"))).collect()
    assert {(tuple(r[0]), r[1]) for r in got} == {(("a", "b"), len("to a \nend\nto b\nend"))}


def brute_core(text):
    """The source parser's procedures and unresolved widget candidates as a loop."""
    code = re.split(r"@#\$#@#\$#@", re.sub(r"\r\n?", "\n", text or ""))[0]
    code = re.sub(r'("[^"]*(?:"|$))|;[^\n]*', lambda m: m.group(1) or "", code)
    name = srcparse.ID
    procs = re.findall(rf"(?mi)^\s*to(?:-report)?\s+({name})", code)
    own = [n for b in re.findall(r"(?is)\bglobals\s*\[(.*?)\]", code) + re.findall(rf"(?is)\b{name}-own\s*\[(.*?)\]", code) for n in re.findall(name, b)]
    local = re.findall(rf"(?i)\blet\s+({name})", code)
    known = {n.lower() for n in procs + own + local} | set(srcparse.RESERVED)
    left = Counter(t.lower() for t in re.findall(name, re.sub(r'"[^"]*"', " ", code)) if t.lower() not in known)
    score = {t: 3 * ("-" in t) + 2 * t.endswith("?") + 2 * (n >= 2) + 2 * any(t.startswith(p) for p in srcparse.PREFIXES) + 2 * (t in ("vision", "visualization")) for t, n in left.items()}
    return sorted(set(procs), key=lambda x: (x.lower(), x)), {(t, n, score[t]) for t, n in left.items() if score[t] >= 3}


SOURCE = (
    'globals [ total-count max-age ]\nbreed [ cows cow ]\ncows-own [ energy hungry? ]\n; to ghost\nto setup\n  clear-all\n  let herd count cows\n  show "a; not a comment"\nend\n\n'
    'to-report mean-energy [ group other-group ]\n  report mean [ energy ] of group\nend\n\nto go\n  ask cows [ graze-field grass-rate graze-field ]\n  tick\nend\n'
    "@#$#@#$#@\nSLIDER\n1\n2\ngrass-rate\ngrass-rate\n0\n100\n\nSWITCH\n1\n2\nshow-energy?\nshow-energy?\n0\n\nMONITOR\n1\n2\nmean-energy\n"
    "@#$#@#$#@\n## WHAT IS IT?\n\nCows graze on grass that grows back at a given rate.\n"
)


def test_a_whole_source(spark, rows):
    df = spark.createDataFrame([("pasture", SOURCE), ("nothing", None)], "name string, text string")
    x = srcparse.core_of(df, "text").select("name", *[F.array_join(c, "|") for c in ("procedures", "reporters", "variables", "breeds", "widgets", "locals", "literals")], "summary")
    assert rows(x) == [
        ("nothing", "", "", "", "", "", "", "", ""),
        ("pasture", "go|mean-energy|setup", "mean-energy", "energy|hungry?|max-age|total-count", "cows|cow", "grass-rate|show-energy?", "herd", "a; not a comment", "Cows graze on grass that grows back at a given rate."),
    ]
    left = srcparse.widget_candidates(srcparse.unresolved(df, "name", "text", [*srcparse.RESERVED, "show", "group", "other-group"]))
    assert rows(left.select("name", "token", "n", "score")) == [("pasture", "cows-own", 1, 3), ("pasture", "graze-field", 2, 5)]
    got = df.filter("name = 'pasture'").select(srcparse.signatures(srcparse.strip_comments(srcparse.sections("text")["code"])), srcparse.control_names(srcparse.sections("text")["interface"], "slider")).first()
    assert [(g["kind"], g["name"], g["inputs"]) for g in got[0]] == [("to", "setup", []), ("to-report", "mean-energy", ["group", "other-group"]), ("to", "go", [])]
    assert got[1] == ["grass-rate"]


def test_source_queries_read_documents(spark, tmp_path):
    texts = [(1, "globals [ total-count max-age ]\nto setup\n  set graze-rate max-age\n  show hidden-level\nend"), (2, None), (3, "globals [ a-b ]\rto go ; old-note\r  set a-b wolf-age? + wolf-age?\rend")]
    spark.createDataFrame([(i, t, "Wolf Pack") for i, t in texts], "doc_id long, text string, model_name string").write.parquet(str(tmp_path / "documents.parquet"))
    q = catalogue.queries()
    core = {r["doc_id"]: (r["procedures"], r["widgets"]) for r in q["q_source_core"](spark, str(tmp_path)).collect()}
    assert core == {i: ("|".join(brute_core(t)[0]), "w-wolf-pack-on?|w-wolf-pack-rate" if t else "") for i, t in texts}
    left = {(r["doc_id"], r["token"], r["n"], r["score"]) for r in q["q_unresolved"](spark, str(tmp_path)).collect()}
    assert left == {(i, *x) for i, t in texts for x in brute_core(t)[1]} and len(left) >= 3


def brute_selection(rows, total, targets, strict):
    """The four passes as a loop over all tasks."""
    dims = list(targets)
    rows = sorted(rows, key=lambda r: (r["priority"] is None, -(r["priority"] or 0), r["task_key"]))
    used, chosen = Counter(), []
    for dropped in [[], ["extension_family"], ["extension_family", "provider_hint"], dims][: 3 if strict else 4]:
        for r in rows:
            if len(chosen) < total and r["task_key"] not in chosen and not any(r[d] in targets[d] and used[d, r[d]] >= targets[d][r[d]] for d in dims if d not in dropped):
                chosen.append(r["task_key"])
                used.update((d, r[d]) for d in dims)
    return chosen


def test_selection_brings_few_tasks_to_the_driver(spark, monkeypatch):
    r = random.Random(3)
    rows = [{"task_key": f"t{i:04d}", "route_mode": r.choice("abc"), "extension_family": r.choice(["x", "y", None]), "provider_hint": r.choice("pq"), "priority": r.choice([None, *map(float, range(5))])} for i in range(600)]
    df = spark.createDataFrame([tuple(x.values()) for x in rows], "task_key string, route_mode string, extension_family string, provider_hint string, priority double").cache()
    targets = {"route_mode": {"a": 7, "b": 4}, "extension_family": {"x": 2}, "provider_hint": {"p": 9}}
    collected = []
    plain = type(df).collect
    monkeypatch.setattr(type(df), "collect", lambda self: collected.append(plain(self)) or collected[-1])
    for total, strict in ((12, False), (30, True), (30, False), (590, False)):
        collected.clear()
        picked = planner.select_tasks(df, total, targets, strict=strict)
        assert len(collected) == 1 and len(collected[0]) <= min(600, 12 * total)
        assert [x["task_key"] for x in sorted(plain(picked), key=lambda x: x["selected"])] == brute_selection(rows, total, targets, strict)
        if total == 12:
            assert len(collected[0]) < 150


def test_pipeline_takes_all_tasks(spark, monkeypatch):
    d = "/root/testdata/sf0.001"
    tasks = views.tasks(spark, d).count()
    assert sum(r["n"] for r in catalogue.queries()["q_pipeline_whole"](spark, d).collect()) == tasks > 600
    seen = []
    monkeypatch.setattr(catalogue.runner, "run", lambda *a, **k: seen.append((a[6:8], k)) or [])
    catalogue.queries()["q_runner_echo"](spark, d)
    assert seen == [((10_000, 1000), {})]


def test_phrases_in_both_quotes_and_keywords(spark):
    one = spark.createDataFrame([("Say \"One  Two\" or 'Slow Fox' but 'a b c d e f' never.",)], "t string")
    assert one.select(lexical.quoted_phrases("t", single=True)).first()[0] == ["one two", "slow fox"]
    assert one.select(lexical.quoted_phrases("t")).first()[0] == ["one two"]
    assert one.select(lexical.word_ngrams(F.lit("slow fox runs far"), 2, 3, ["far"])).first()[0] == ["runs far", "fox runs far"]
