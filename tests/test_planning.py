import hashlib
from itertools import product

from pyspark.sql import functions as F

from millrace.operators import audit, capacity, gates, planner, profiles, prompts, routing, srcparse, support

PROFILE = "model_name string, core array<string>, summary string, families array<struct<name:string,identifiers:array<string>,concepts:array<string>>>, cues array<string>, themes array<string>"
CORE = "setup go determine-behavior grievance estimated-arrest-probability active? jail-term risk-aversion perceived-hardship k threshold agents cops government-legitimacy vision initial-cop-density".split()
FAMILIES = [("broadcast_media", ["media-influence", "media-signal", "social-influence-weight"], ["broadcast media", "global signal", "media influence"]), ("network_layer", ["homophily-index", "network-density"], ["social network"])]


def profile(spark):
    return spark.createDataFrame([("rebellion", CORE, "The rebellion model simulates citizen uprising against a central authority.", FAMILIES, ["extend the model", "you could add"], ["quantum mechanics"])], PROFILE)


def test_routes(spark):
    df = spark.createDataFrame(
        [
            (1, "rebellion", "How does `determine-behavior` use `grievance`?", "It compares `grievance` with `threshold` of `agents`."),
            (2, "rebellion", "How could one add a broadcast media layer?", "Use `media-influence`."),
            (3, "rebellion", "What are financial derivatives?", "Contracts between two parties."),
            (4, "unknown", "x", "y"),
            (5, "rebellion", "Does a hexagonal grid help?", "`grievance`"),
            (6, "rebellion", None, None),
            (7, "rebellion", "How is the degree distribution?", "Long tailed."),
        ],
        "i int, model_name string, question string, answer string",
    )
    got = {r["i"]: (r["route"], r["family"]) for r in routing.route(df, profile(spark)).collect()}
    assert got[1][0] in ("core_paraphrase", "core_repair") and got[1][1] is None
    assert got[2] == ("anchored_extension", "broadcast_media")
    assert got[3] == ("skip", None) and got[4] == ("skip", None) and got[5] == ("skip", None) and got[6] == ("skip", None)
    assert got[7] == ("anchored_extension", "network_layer")


def test_vocabulary_gate(spark):
    cases = [
        ("core_paraphrase", None, "The `grievance` rises.", None),
        ("core_paraphrase", None, "See `fake-procedure`.", "UNKNOWN_CORE_IDENTIFIER"),
        ("core_repair", None, "We record a hypothesis with `fake-procedure`.", None),
        ("core_paraphrase", None, "See `media-influence`.", "UNAPPROVED_EXTENSION_IDENTIFIER"),
        ("core_paraphrase", None, "A broadcast media channel.", "EXTENSION_CONTENT_IN_CORE_MODE"),
        ("core_paraphrase", None, "Like quantum mechanics.", "DISALLOWED_THEME"),
        ("anchored_extension", "broadcast_media", "To extend the model, you could add a `media-influence` to `grievance`.", None),
        ("anchored_extension", "broadcast_media", "`media-influence` drives `grievance`.", "EXTENSION_REQUIRES_FRAMING"),
        ("anchored_extension", "broadcast_media", "You could add `media-influence` and `homophily-index` to `grievance`.", "CROSS_FAMILY_EXTENSION_IDENTIFIER"),
        ("anchored_extension", "broadcast_media", "You could add it. The model already has media-influence, like `media-influence` and `grievance`.", "BASE_MODEL_MISREPRESENTATION"),
        ("nonexistent", None, "x", "UNKNOWN_MODE"),
    ]
    df = spark.createDataFrame([(i, "rebellion", "q", a, m, f) for i, (m, f, a, _) in enumerate(cases)], "i int, model_name string, question string, answer string, route_mode string, extension_family string")
    got = {r["i"]: r["reason"] for r in gates.validate_vocabulary(df, profile(spark), []).collect()}
    assert got == {i: c[3] for i, c in enumerate(cases)}


def test_reply_parsing(spark):
    raw = ['{"question": "q", "answer": "a"}', '{"question": "q", "answer": "a", "x": {"skip": 1}}', "nope", "[1]", '{"answer": "a"}', '{"skip": true}', '{"question": 1, "answer": "a"}', "x" * 50_001, None]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(raw)], "i int, r string")
    got = {r[0]: r[1] for r in df.select("i", gates.parse_reply("r")["error"]).collect()}
    assert got == {0: None, 1: None, 2: "bad_json", 3: "not_an_object", 4: "missing_key", 5: "skip", 6: "not_a_string", 7: "too_long", 8: "NO_RESPONSE"}


def test_support_pools_match_all_pairs(spark, rows):
    seeds = [(f"s{i}", f"m{i % 2}", i % 3 if i % 5 else None, f"L{i % 2}") for i in range(12)]
    recs = [(f"r{i:03d}", ("corpus", "seed", "accepted_synth")[i % 3], f"s{i % 12}", None if i % 4 else f"s{(i + 1) % 12}", f"m{i % 2}", i % 3, f"L{i % 2}") for i in range(120)]
    s = spark.createDataFrame(seeds, "seed_id string, model_name string, class_id int, level string")
    r = spark.createDataFrame(recs + recs[:9], "record_id string, source string, source_id string, seed_id string, model_name string, class_id int, level string")
    want = []
    for sid, m, c, lv in seeds:
        best = {}
        for rid, src, made, own, rm, rc, rl in recs:
            if rm == m and src in ("corpus", "seed") and own != sid and not (src == "seed" and made == sid):
                best[rid] = max(best.get(rid, 0), 50 + 40 * (c is not None and c == rc) + 5 * (lv == rl) + {"corpus": 8, "seed": 3}[src])
        want += [(sid, rid, sc) for rid, sc in sorted(best.items(), key=lambda x: (-x[1], x[0]))[:5]]
    assert rows(support.support_pools(s, r, 5).select("seed_id", "record_id", "score")) == sorted(want, key=str)


def test_tasks_are_keyed_and_capped(spark):
    s = spark.createDataFrame([("s1", "m", 1, "A", "L1", "core_repair", None), ("s2", "m", 1, None, "L1", "skip", None), ("s3", "m", 1, "B", "L1", "freeform_extension", None), ("s4", "m", 1, "B", "L1", "core_paraphrase", None)], "seed_id string, model_name string, class_id int, tier string, level string, route_mode string, extension_family string")
    p = spark.createDataFrame([("s1", f"r{i}", "corpus", "same_model", 58, i) for i in range(1, 6)], "seed_id string, record_id string, source string, relation string, score int, rank int")
    t = planner.enumerate_tasks(s, p).collect()
    assert {r["seed_id"] for r in t} == {"s1", "s4"}
    mine = [r for r in t if r["seed_id"] == "s1"]
    assert len(mine) == 5 and len({r["task_key"] for r in t}) == len(t)
    assert {r["support_relation"] for r in t if r["seed_id"] == "s4"} == {"seed_only"}
    r = mine[0]
    assert r["task_key"] == hashlib.sha1("|".join(["s1", "core_repair", "", r["transform_type"], r["support_record_id"], r["provider_hint"], "v1"]).encode()).hexdigest()


def test_selection_never_breaks_quotas_in_strict_mode(spark):
    rows = [(f"t{i:03d}", m, f, float(i % 9)) for i, (m, f) in enumerate(product(("a", "b", None), ("x", None, "y", "z") * 10))]
    df = spark.createDataFrame(rows, "task_key string, route_mode string, extension_family string, priority double")
    targets = {"route_mode": {"a": 5, "b": 7}, "extension_family": {"x": 3}}
    got = planner.select_tasks(df, 40, targets, strict=True).collect()
    assert sum(r["route_mode"] == "a" for r in got) <= 5 and sum(r["route_mode"] == "b" for r in got) <= 7
    assert len(planner.select_tasks(df, 100, targets).collect()) == 100
    assert planner.target_counts(10, {"a": 0.35, "b": 0.65}) == {"a": 3, "b": 7}


def test_capacity(spark):
    m = capacity.feature_matrix([spark.createDataFrame([("a", 10), ("b", 20), ("c", 30)], "model_name string, n_seed_anchors int"), spark.createDataFrame([("a", 1.0), ("d", 9.0)], "model_name string, support_pool_avg_size double")])
    x = {r["model_name"]: r for r in capacity.scaled(m, ["n_seed_anchors", "n_core_breeds"]).collect()}
    assert [x[k]["norm_n_seed_anchors"] for k in "abcd"] == [0.0, 0.5, 1.0, 0.0] and x["a"]["norm_n_core_breeds"] == 0.0
    r = {r["model_name"]: r for r in capacity.report(m).collect()}
    assert r["a"]["dedup_risk"] == 0.1 and r["d"]["dedup_risk"] == 0.0
    df = spark.createDataFrame([(0.72,), (0.71,), (0.45,), (0.44,)], "e double")
    assert [r[0] for r in df.select(capacity.bucket(F.col("e"))).collect()] == ["high_capacity", "mid_capacity", "mid_capacity", "low_capacity"]


def test_profiles(spark, rows):
    r = spark.createDataFrame([("m", "`a` `b`", "`a`"), ("m", "`a` `c`", None), (None, "`z`", "")], "model_name string, question string, answer string")
    p = profiles.derive_profiles(r, core=2, family=1, families=1).first()
    assert p["core"] == ["a", "b"] and p["families"][0]["identifiers"] == ["c"]


def test_comments_and_sections(spark):
    df = spark.createDataFrame([('show "a;b" ; gone\nto x ; more\n"open ; kept',), (None,)], "t string")
    got = [r[0] for r in df.select(srcparse.strip_comments("t")).collect()]
    assert got == ['show "a;b" \nto x \n"open ; kept', ""]
    s = spark.createDataFrame([("a@#$#@#$#@b@#$#@#$#@c@#$#@#$#@d@#$#@#$#@e",)], "t string").select(srcparse.sections("t").alias("s")).first()["s"]
    assert (s["code"], s["interface"], s["info"], s["extra"]) == ("a", "b", "c", ["d", "e"])


def test_nearest_class(spark):
    v = spark.createDataFrame([(1, [1.0, 0.0], 0), (2, [0.0, 1.0], 1), (3, [0.0, 1.0], 0), (4, None, 0), (5, [0.0, 0.0], None)], "i int, embedding array<float>, label int")
    c = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0])], "label int, centre array<double>")
    got = {r["i"]: r["reason"] for r in gates.nearest_class(v, c, "i").collect()}
    assert got == {1: None, 2: None, 3: "WRONG_CLASS_NEIGHBORHOOD", 4: "GATE1_BACKEND_ERROR", 5: "GATE1_BACKEND_ERROR"}


def test_smaller_pieces(spark, rows):
    from millrace.operators import audit, enrich, prompts

    ex = spark.createDataFrame([("e", 1, None), ("f", 2, "b"), ("g", 9, None)], "id string, class_id int, tier string")
    cl = spark.createDataFrame([(1, None, 0.79), (2, "a", 0.9)], "class_id int, tier string, p10 double")
    assert rows(enrich.with_class_tier(ex, cl).select("id", "tier")) == [("e", "B"), ("f", "B"), ("g", None)]
    one = spark.createDataFrame([("See `A b`, [foo-bar] and x-y.",)], "t string")
    assert sorted(one.select(audit.marked_terms("t")).first()[0]) == sorted(["a b", "foo-bar", "foo-bar", "x-y"])
    assert one.select(profiles.with_defaults(F.array(F.lit("You Could"), F.lit("new")), ["you could", "extend"])).first()[0] == ["you could", "extend", "new"]
    assert one.select(srcparse.merged_widgets(F.array(F.lit("b"), F.lit("A")), F.array(F.lit("a")))).first()[0] == ["A", "b"]
    t = spark.createDataFrame([(1,), (2,), (3,)], "k int")
    c = spark.createDataFrame([("1", "x"), ("2", " ")], "custom_id string, content string")
    assert rows(prompts.join_results(t, c, "k")) == [(1, "x", None), (2, None, "NO_RESPONSE"), (3, None, "NO_RESPONSE")]
    got = prompts.embed(spark.createDataFrame([("ab",), (None,)], "question string"), lambda xs: [[len(x), 1.0] for x in xs]).collect()
    assert {r["question"]: r["embedding"] for r in got} == {"ab": [2.0, 1.0], None: None}
    core = srcparse.core_of(spark.createDataFrame([("m", "to go\nend")], "name string, text string"), "text")
    assert core.select(srcparse.fallback_summary(F.col("name"))).first()[0] == "The model m has procedures such as go."


FRAMED = [
    "Extending the original model with a signal.",
    "Adding a new variable to the agents.",
    "The model has no `trade` feature.",
    "Introducing a `mood` variable changes this.",
    "Add to `nodes-own` a field.",
    "In an extension of the model this works.",
    "A state_refinement extension would help.",
    "We'll introduce a layer.",
    "Modify the `setup` procedure first.",
]
UNFRAMED = ["The agents move at random.", "It rises with `grievance`.", None, ""]


def test_framing(spark):
    df = spark.createDataFrame([(t,) for t in FRAMED + UNFRAMED], "a string")
    a = F.coalesce("a", F.lit(""))
    got = [r[0] for r in df.select(gates.has_framing(a, F.lower(a), F.array().cast("array<string>"))).collect()]
    assert got == [True] * len(FRAMED) + [False] * len(UNFRAMED)


def test_anchor_by_two_words_of_the_summary(spark):
    cases = [("You could add `media-influence`: citizens then meet a central authority.", None), ("You could add `media-influence`: citizens then meet.", "INSUFFICIENT_CORE_ANCHOR"), (None, "INSUFFICIENT_CORE_ANCHOR"), ("You could record the peak of `media-influence` in the original code.", None)]
    df = spark.createDataFrame([(i, "rebellion", None, a, "anchored_extension", "broadcast_media") for i, (a, _) in enumerate(cases)], "i int, model_name string, question string, answer string, route_mode string, extension_family string").withColumn("core", F.lit(1))
    p = profile(spark).withColumn("core", F.array(F.lit("zzz-core")))
    got = {r["i"]: r["reason"] for r in gates.validate_vocabulary(df, p, []).collect()}
    assert got[0] is None and got[1] == got[2] == "INSUFFICIENT_CORE_ANCHOR" and got[3] == "EXTENSION_REQUIRES_FRAMING"


def test_prompts_carry_their_content(spark):
    schema = "task_key string, model_name string, route_mode string, extension_family string, transform_type string, level string, tier string, question string, answer string, support_question string, support_answer string"
    rows_ = [
        ("a", "rebellion", "core_paraphrase", None, "lexical_paraphrase", "L3", "C", "Why does it rise?", "Because of `grievance`.", "Other question?", "Other answer."),
        ("b", "rebellion", "core_repair", None, "made_up", "L2", None, "Q?", "A.", None, None),
        ("c", "rebellion", "anchored_extension", "broadcast_media", None, None, "A", "Q?", None, None, None),
        ("d", "rebellion", "skip", None, None, None, None, "Q?", "A.", None, None),
        ("e", "rebellion", "anchored_extension", "gone", None, None, None, "Q?", "A.", None, None),
        ("f", "unknown", "core_repair", None, None, None, None, "Q?", "A.", None, None),
        ("g", None, None, None, None, None, None, None, None, None, None),
    ]
    got = {r["task_key"]: r for r in prompts.prompts(spark.createDataFrame(rows_, schema).withColumn("core", F.lit(1)), profile(spark)).collect()}
    a, b, c = (got[k]["prompt"] for k in "abc")
    assert "core_paraphrase" in a and "Do not add extensions" in a and "SEED_CONFLICT" not in a and "Why does it rise?" in a and "Because of `grievance`." in a
    assert "Support question: Other question?\nSupport answer: Other answer." in a and prompts.OBJECTIVES["lexical_paraphrase"] in a and prompts.STYLES["L3"] in a and "- determine-behavior" in a and "citizen uprising" in a
    assert prompts.SKIP in b and "Take `made_up`" in b and "Support question" not in b and prompts.STYLES["L2"] in b
    assert "media-signal" in c and "global signal" in c and "you could add" in c and "homophily-index" not in c and "social network" not in c and "OBJECTIVE" not in c
    assert [got[k]["prompt_error"] for k in "defg"] == ["NO_TEMPLATE", "MISSING_FAMILY", "MISSING_MODEL_PROFILE", "NO_TEMPLATE"] and all(got[k]["prompt"] is None for k in "defg")
    by_kind = profile(spark).withColumns({"procedures": F.array(F.lit("go")), "breeds": F.array(F.lit("cops"))})
    assert "- procedures: go\n- breeds: cops" in prompts.prompts(spark.createDataFrame(rows_[:1], schema), by_kind).first()["prompt"]


def test_audit_classes(spark, rows):
    recs = spark.createDataFrame([("r1", "m", "How does `core-a` use lone and [b-c]?", "`b-c` is new; odd-one is seen, as is miss."), ("r2", "m", None, "miss and lit and tick"), ("r3", None, "`x-y`", ""), ("r4", "none", "`x-y`", "")], "record_id string, model_name string, question string, answer string")
    prof = spark.createDataFrame([("m", ["core-a", "lone"])], "model_name string, core array<string>")
    hints = spark.createDataFrame([("m", "Miss", "unresolved"), ("m", "lit", "aux"), ("m", None, "aux"), (None, "lit", "aux")], "model_name string, term string, kind string")
    got = {r["term"]: (r["n"], r["class"]) for r in audit.classified_terms(recs, prof, ["tick"], hints).collect()}
    assert got == {"core-a": (2, "core"), "lone": (1, "core"), "b-c": (4, "extension_candidate"), "odd-one": (1, "drift"), "miss": (2, "parser_miss")}
    ex = rows(audit.examples(recs, audit.classified_terms(recs, prof, [], hints), 1).select("term", "record_id"))
    assert ("miss", "r1") in ex and ("core-a", "r1") in ex
    p = {r["phrase"]: r["n"] for r in audit.phrase_uses(spark.createDataFrame([("m", "The state of the 'old agents' use network links", None)], "model_name string, question string, answer string")).collect()}
    assert p["old agents"] == 1 and p["network links"] == 1 and "use network" not in p and p["state agents"] == 1


def test_nearest_class_of_odd_vectors(spark):
    e = spark.createDataFrame([(1, [1.0, 0.0], 0), (2, [0.0, 2.0], 1), (3, None, 1), (4, [0.0, 0.0], 0), (5, [1.0], None), (6, [1.0, None], None), (7, [float("nan"), 1.0], None), (8, [1.0, 1.0], None)], "vec_id long, embedding array<float>, label int")
    c = spark.createDataFrame([(0, [3.0, 0.0]), (1, [0.0, 1.0]), (2, [0.0, 0.0]), (None, [1.0, 1.0])], "label int, centre array<double>")
    got = {r["vec_id"]: (r["best_label"], r["reason"]) for r in gates.nearest_class(e, c, "vec_id").collect()}
    bad = (None, "GATE1_BACKEND_ERROR")
    assert got == {1: (0, None), 2: (1, None), 3: bad, 4: bad, 5: bad, 6: bad, 7: bad, 8: (1, "LOW_CLASS_MARGIN")}
    none = gates.nearest_class(e, c.limit(0), "vec_id").collect()
    assert len(none) == 8 and all(r["reason"] == "GATE1_BACKEND_ERROR" for r in none)
    plan = gates.nearest_class(e, c, "vec_id")._jdf.queryExecution().analyzed().toString()
    assert "3.0" not in plan  # no centre stands in the plan


def test_pools_of_seeds_with_many_records_of_their_own(spark, rows):
    """A seed whose own versions fill the head of every pool draws from further down, and nobody else's pool grows for it."""
    recs = [(f"a{i:04d}", "corpus", None, "big" if i < 400 else None, "m", 1, "L1") for i in range(430)] + [("z", "corpus", None, None, "n", 1, "L1")]
    r = spark.createDataFrame(recs, "record_id string, source string, source_id string, seed_id string, model_name string, class_id int, level string")
    s = spark.createDataFrame([("big", "m", 1, "L1"), ("other", "m", 1, "L1"), ("few", "n", 1, "L1"), ("none", "q", 1, "L1")], "seed_id string, model_name string, class_id int, level string")
    got = rows(support.support_pools(s, r, 5).select("seed_id", "rank", "record_id"))
    want = [("big", i + 1, f"a{400 + i:04d}") for i in range(5)] + [("few", 1, "z")] + [("other", i + 1, f"a{i:04d}") for i in range(5)]
    assert got == sorted(want, key=str)


def test_capacity_steers_the_plan(spark):
    s = spark.createDataFrame([("s1", "rich", 1, "A", "L1", "core_repair", None), ("s2", "poor", 1, "A", "L1", "core_repair", None), ("s3", "new", 1, "A", "L1", "core_repair", None)], "seed_id string, model_name string, class_id int, tier string, level string, route_mode string, extension_family string")
    p = spark.createDataFrame([(f"s{k}", f"r{k}{i}", "corpus", "same_model", 58, i) for k in (1, 2, 3) for i in range(1, 6)], "seed_id string, record_id string, source string, relation string, score int, rank int")
    c = spark.createDataFrame([("rich", 0.9, "high_capacity", 7, 30), ("poor", 0.1, "low_capacity", 2, 10)], "model_name string, effective_capacity double, capacity_bucket string, cap_core_repair int, cap_total int")
    plain = {r["task_key"]: r["priority"] for r in planner.enumerate_tasks(s, p).collect()}
    got = planner.enumerate_tasks(s, p, capacities=c).collect()
    n = {k: [r for r in got if r["seed_id"] == k] for k in ("s1", "s2", "s3")}
    assert [len(x) for x in n.values()] == [7, 2, 5] and [x[0]["model_bucket"] for x in n.values()] == ["high_capacity", "low_capacity", "high_volume"]
    for r in n["s3"]:
        assert r["priority"] == plain[r["task_key"]]
    shared = next(r for r in n["s2"] if r["task_key"] in plain)
    assert shared["priority"] < plain[shared["task_key"]] * 0.11


def test_family_quota_holds_its_mode_only(spark):
    t = spark.createDataFrame([(f"t{i}", "core_repair" if i % 2 else "anchored_extension", "x", float(10 - i)) for i in range(10)], "task_key string, route_mode string, extension_family string, priority double")
    one = planner.select_tasks(t, 6, {"route_mode": {}, "extension_family": {"x": 1}}, strict=True, only_in={"extension_family": ("route_mode", "anchored_extension")})
    first = [r["task_key"] for r in one.orderBy("selected").collect()]
    assert first == ["t0", "t1", "t3", "t5", "t7", "t9"]


def test_histograms_and_chunks(spark, rows):
    from millrace.operators import telemetry

    t = spark.createDataFrame([(i, "ab"[i % 2], f"s{i % 5}" if i else None) for i in range(20)], "i int, mode string, seed string")
    h = rows(telemetry.histograms(t, ["mode", "seed"], {"seed": 2}))
    assert h == [("mode", "a", 10), ("mode", "b", 10), ("seed", "s1", 4), ("seed", "s2", 4), ("total", None, 20)]
    big = spark.range(1000).select("id", F.when(F.col("id") < 900, "hot").when(F.col("id") < 990, "x").alias("who"), F.lit(1).alias("chunk"))
    c = telemetry.chunks(big.repartition(7), 50, "who", [F.col("id").desc()])
    assert rows(c.groupBy("who", "chunk").count().groupBy("who").agg(F.count("*"), F.max("count"), F.min("count"))) == sorted([("hot", 18, 50, 50), ("x", 2, 50, 40), (None, 1, 10, 10)], key=str)
    assert c.filter("who = 'hot' and chunk = 0").agg(F.min("id"), F.max("id")).first() == (850, 899)
