"""The core's queries by name, with the SQL that gives the same rows."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.functions import lexical, numbers, text
from millrace.operators import audit, capacity, dedup, enrich, gates, greedy, heavy_keys, normalize, planner, profiles, prompts, routing, runner, srcparse, support, telemetry
from millrace.plans import sql as S
from millrace.plans import views
from millrace.session import durable, shared_folder
from millrace.sources import files
from millrace.sources.tables import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def put(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return put


_text = "coalesce(question, '') || chr(10) || coalesce(answer, '')"
_quote = lambda p: "'" + p.replace("'", "''") + "'"
_matches = lambda x, p: f"regexp_matches({x}, {_quote(p)})"


def joined(x, by: str = "|"):
    return F.array_join(x, by)


# Keys of very many rows

PAIRS = f"""SELECT coalesce(lower(regexp_replace({S.strip('model_name')}, '{S.WS}+', '_', 'g')), 'unknown') model_name,
    coalesce(model_bucket, 'unknown') model_bucket, seed_id, task_key, CASE WHEN isnan(priority) THEN NULL ELSE priority END q FROM planned_tasks"""


def _pairs(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "planned_tasks")
    return t.select(F.coalesce(text.snake("model_name"), F.lit("unknown")).alias("model_name"), F.coalesce("model_bucket", F.lit("unknown")).alias("model_bucket"), "seed_id", "priority", "task_key")


@query(f"""WITH p AS ({PAIRS}), b AS (SELECT *, row_number() OVER (PARTITION BY model_name, model_bucket ORDER BY q DESC NULLS LAST, task_key) k FROM p)
    SELECT model_name, model_bucket, count(*) AS n_rows, count(DISTINCT seed_id) AS n_seeds, max(task_key) FILTER (k = 1) AS best_task FROM b GROUP BY 1, 2""")
def p3_totals(spark: SparkSession, d: str) -> DataFrame:
    """Rows, seeds and best task of every pair of model and bucket."""
    out = heavy_keys.key_totals(_pairs(spark, d), ["model_name", "model_bucket"], "seed_id", "priority", "task_key")
    return out.select("model_name", "model_bucket", F.col("rows").alias("n_rows"), F.col("distinct").alias("n_seeds"), F.col("best").alias("best_task"))


@query(f"WITH p AS ({PAIRS}) SELECT model_name, model_bucket FROM p GROUP BY 1, 2 HAVING count(*) * 50 >= (SELECT count(*) FROM planned_tasks)")
def p3_found(spark: SparkSession, d: str) -> DataFrame:
    total = table(spark, d, "planned_tasks").count()  # from the files' footers
    out = heavy_keys.key_totals(_pairs(spark, d), ["model_name", "model_bucket"])
    return out.filter(F.col("rows") * 50 >= total).select("model_name", "model_bucket")


# Normalisation


@query(f"SELECT DISTINCT record_id, {S.key('question')} AS question_key, {S.nz('answer')} AS answer, {S.model('model_name')} AS model_name FROM records")
def q_norm_text(spark: SparkSession, d: str) -> DataFrame:
    r = table(spark, d, "records")
    return r.select("record_id", text.text_key("question").alias("question_key"), text.blank_to_null("answer").alias("answer"), text.model_key("model_name").alias("model_name")).distinct()


@query(f"WITH {S.NORMAL} SELECT DISTINCT record_id, source, source_id, model_name, question, answer, seed_id, class_id, level, tier, global_id FROM normal")
def q_normalize_records(spark: SparkSession, d: str) -> DataFrame:
    return views.normal(spark, d).select("record_id", "source", "source_id", "model_name", "question", "answer", "seed_id", "class_id", "level", "tier", "global_id").distinct()


@query(f"""SELECT DISTINCT record_id, nullif({S.squeeze("regexp_extract(list_filter(tags, lambda t: regexp_matches(t, '(?is)^level:(.+)$'))[1], '(?is)^level:(.+)$', 1)")}, '') AS level,
    {S.model("regexp_extract(list_filter(tags, lambda t: regexp_matches(t, '(?is)^model:(.+)$'))[1], '(?is)^model:(.+)$', 1)")} AS model FROM records""")
def q_tags_extract(spark: SparkSession, d: str) -> DataFrame:
    level = text.squeeze(lexical.tag_value("tags", "level"))
    return table(spark, d, "records").select("record_id", F.when(level != "", level).alias("level"), text.model_key(lexical.tag_value("tags", "model")).alias("model")).distinct()


MESSAGES = f"SELECT seed_id, {S.nz('seed_q')} AS q, {S.nz('seed_a')} AS a, question, answer FROM routed_seeds"


@query(f"SELECT DISTINCT seed_id, coalesce(q, {S.nz('question')}) AS question, coalesce(a, {S.nz('answer')}) AS answer FROM ({MESSAGES})")
def q_messages_qa(spark: SparkSession, d: str) -> DataFrame:
    """Explicit sides first, each missing one from the first message of its role."""
    r = table(spark, d, "routed_seeds")
    m = F.array(F.struct(F.lit("system").alias("role"), F.lit("note").alias("content")), F.struct(F.lit("user").alias("role"), F.col("question").alias("content")), F.struct(F.lit("assistant").alias("role"), F.col("answer").alias("content")))
    x = r.select("seed_id", F.col("seed_q").alias("_q"), F.col("seed_a").alias("_a"), m.alias("messages")).withColumnsRenamed({"_q": "question", "_a": "answer"})
    q, a = normalize.question_answer(x)
    return x.select("seed_id", q.alias("question"), a.alias("answer")).distinct()


@query(f"""WITH {S.NORMAL}, i AS (SELECT source, unnest(list_filter([CASE WHEN record_id IS NULL THEN 'MISSING_ID' END, CASE WHEN model_name IS NULL THEN 'MISSING_MODEL' END,
    CASE WHEN question IS NULL THEN 'MISSING_QUESTION' END, CASE WHEN answer IS NULL THEN 'MISSING_ANSWER' END], lambda x: x IS NOT NULL)) AS issue FROM normal)
    SELECT source, issue, count(*) AS n FROM i GROUP BY 1, 2""")
def q_issues(spark: SparkSession, d: str) -> DataFrame:
    return views.normal(spark, d).select("source", F.explode("issues").alias("issue")).groupBy("source", "issue").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT record_id, count(*) AS n FROM records WHERE record_id IS NOT NULL GROUP BY 1 HAVING count(*) > 1")
def q_dup_ids(spark: SparkSession, d: str) -> DataFrame:
    return normalize.duplicate_ids(table(spark, d, "records"), "record_id")


@query(f"""WITH {S.NORMAL}, x AS (SELECT source, model_name, list_filter([CASE WHEN record_id IS NULL THEN 'MISSING_ID' END, CASE WHEN model_name IS NULL THEN 'MISSING_MODEL' END,
    CASE WHEN question IS NULL THEN 'MISSING_QUESTION' END, CASE WHEN answer IS NULL THEN 'MISSING_ANSWER' END], lambda x: x IS NOT NULL) AS issues FROM normal)
    SELECT 'raw' AS kind, source AS name, count(*) AS n FROM x GROUP BY 2 UNION ALL SELECT 'normalized_ok', source, count(*) FILTER (len(issues) = 0) FROM x GROUP BY 2
    UNION ALL SELECT 'issue', concat_ws(':', source, issue), count(*) FROM (SELECT source, unnest(issues) AS issue FROM x) GROUP BY 2
    UNION ALL SELECT 'model', coalesce(model_name, 'unknown'), count(*) FROM x WHERE source IN ('corpus', 'seed') GROUP BY 2""")
def q_consistency_report(spark: SparkSession, d: str) -> DataFrame:
    return normalize.consistency_report(views.normal(spark, d))


@query(f"WITH {S.LAST} SELECT record_id, source, model_name, class_id, level, tier, ingested_at FROM last")
def q_last_record(spark: SparkSession, d: str) -> DataFrame:
    return views.records(spark, d).select("record_id", "source", "model_name", "class_id", "level", "tier", "ingested_at")


@query("""SELECT source, record_id, CAST(NULL AS VARCHAR) AS seed_id FROM anchor_records UNION ALL SELECT source, record_id, NULL FROM support_entries
    UNION ALL SELECT NULL, NULL, seed_id FROM routed_seeds""")
def q_union_sources(spark: SparkSession, d: str) -> DataFrame:
    return normalize.union_sources([table(spark, d, "anchor_records").select("source", "record_id"), table(spark, d, "support_entries").select("source", "record_id"), table(spark, d, "routed_seeds").select("seed_id")])


@query(f"""WITH {S.LAST}, side AS (SELECT source_id AS k, question AS q, answer AS a FROM last WHERE source = 'seed' AND source_id IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY source_id ORDER BY ingested_at DESC NULLS LAST, question DESC NULLS LAST, answer DESC NULLS LAST) = 1),
    s AS (SELECT DISTINCT seed_id, {S.nz('seed_q')} AS q0, {S.nz('seed_a')} AS a0 FROM routed_seeds),
    x AS (SELECT seed_id, q0, a0, k, coalesce(q0, q) AS question, coalesce(a0, a) AS answer FROM s LEFT JOIN side ON seed_id = k)
    SELECT seed_id, question, answer, CASE WHEN q0 IS NOT NULL AND a0 IS NOT NULL THEN 'complete' WHEN k IS NULL THEN 'miss' WHEN question IS NULL OR answer IS NULL THEN 'part' ELSE 'filled' END AS fill FROM x""")
def q_seed_join(spark: SparkSession, d: str) -> DataFrame:
    """Missing sides of seeds from the last record of the seed."""
    s = table(spark, d, "routed_seeds").select("seed_id", text.blank_to_null("seed_q").alias("question"), text.blank_to_null("seed_a").alias("answer")).distinct()
    side = views.records(spark, d).filter("source = 'seed'").select("source_id", "question", "answer", "ingested_at")
    return normalize.fill_from(s, side, "seed_id", "source_id", ["question", "answer"], [F.col("ingested_at")])


IDS = f"""list_distinct_keep AS (SELECT record_id, source_id, list_filter([nullif(source_id, ''), seed_id, global_id, record_id, CASE WHEN contains(record_id, '::') THEN nullif({S.strip("substr(record_id, strpos(record_id, '::') + 2)")}, '') END], lambda x: x IS NOT NULL) AS raw FROM last),
    ids AS (SELECT record_id, list_filter(raw, lambda x, i: list_position(raw, x) = i) AS ids FROM list_distinct_keep)"""


@query(f"WITH {S.LAST}, {IDS} SELECT record_id, array_to_string(ids, '|') AS ids FROM ids")
def q_candidate_ids(spark: SparkSession, d: str) -> DataFrame:
    return views.records(spark, d).select("record_id", joined(enrich.candidate_ids()).alias("ids"))


@query(f"""WITH {S.LAST}, {IDS}, {S.SEEDS}, e AS (SELECT record_id, unnest(ids) AS id, generate_subscripts(ids, 1) - 1 AS place FROM ids),
    h AS (SELECT e.record_id, e.place, s.class_id AS c, s.tier AS t FROM e JOIN seeds s ON s.seed_id = e.id QUALIFY row_number() OVER (PARTITION BY e.record_id ORDER BY e.place) = 1)
    SELECT l.record_id, coalesce(l.class_id, h.c) AS class_id, coalesce(l.tier, h.t) AS tier, h.record_id IS NOT NULL AS matched, coalesce(l.class_id <> h.c, false) AS conflict FROM last l LEFT JOIN h USING (record_id)""")
def q_enrich_priority_join(spark: SparkSession, d: str) -> DataFrame:
    """Class and tier of the first of a record's ids that the seeds know; what is there is kept."""
    r = views.records(spark, d).select("record_id", "source_id", "seed_id", "global_id", "class_id", "tier")
    hit = enrich.join_first_id(r, views.seeds(spark, d).select("seed_id", "class_id", "tier"), "seed_id")
    return enrich.fill_only(hit, ["class_id", "tier"], "class_id").select("record_id", "class_id", "tier", "matched", "conflict")


@query("""SELECT CASE WHEN p IS NULL THEN NULL WHEN isnan(p) THEN 'C' WHEN p >= 0.82 THEN 'A' WHEN p >= 0.78 THEN 'B' ELSE 'C' END AS tier, count(*) AS n FROM (SELECT priority / 2 AS p FROM planned_tasks) GROUP BY 1""")
def q_tier(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "planned_tasks").groupBy(numbers.tier_of(F.col("priority") / 2).alias("tier")).agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT route_mode, v AS value, CASE WHEN lower(v) IN ('1', 'true', 'yes', 'y') THEN true WHEN lower(v) IN ('0', 'false', 'no', 'n') THEN false END AS flag, TRY_CAST(v AS DOUBLE) AS number, count(*) AS n
    FROM (SELECT route_mode, CASE WHEN class_id % 4 = 0 THEN 'Yes' WHEN class_id % 4 = 1 THEN '0' WHEN class_id % 4 = 2 THEN 'n' ELSE class_id::VARCHAR END AS v FROM routed_seeds) GROUP BY ALL""")
def q_coerce(spark: SparkSession, d: str) -> DataFrame:
    c = F.col("class_id")
    v = F.when(c % 4 == 0, "Yes").when(c % 4 == 1, "0").when(c % 4 == 2, "n").otherwise(c.cast("string"))
    x = table(spark, d, "routed_seeds").select("route_mode", v.alias("value"))
    return x.groupBy("route_mode", "value", numbers.to_bool("value").alias("flag"), numbers.to_float("value").alias("number")).agg(F.count(F.lit(1)).alias("n"))


# Terms


@query(f"WITH {S.LAST} SELECT record_id, {S.joined(f'list_sort(list_distinct({S.term_list("question")}))')} AS terms FROM last")
def q_terms_set(spark: SparkSession, d: str) -> DataFrame:
    return views.records(spark, d).select("record_id", joined(lexical.terms("question")).alias("terms"))


@query(f"WITH {S.LAST}, x AS (SELECT unnest({S.term_list('question')}) AS term FROM last) SELECT term, count(*) AS n FROM x GROUP BY 1")
def q_term_counts(spark: SparkSession, d: str) -> DataFrame:
    return views.records(spark, d).select(F.explode(lexical.term_list("question")).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {S.COUNTS} SELECT model_name, term, n FROM identifiers")
def q_identifier_counts(spark: SparkSession, d: str) -> DataFrame:
    return profiles.identifier_counts(views.records(spark, d))


@query(f"WITH {S.LAST} SELECT record_id, {S.joined(f'list_sort(list_distinct([t for t in {S.tokens("answer")} if len(t) >= 5]))')} AS keywords FROM last")
def q_summary_keywords(spark: SparkSession, d: str) -> DataFrame:
    return views.records(spark, d).select("record_id", joined(lexical.summary_keywords("answer")).alias("keywords"))


@query(rf"""WITH {S.LAST}, x AS (SELECT record_id, [s for s in [{S.strip("p")} for p in string_split_regex(regexp_replace(coalesce(answer, ''), '([.!?])\s+', '\1' || chr(10), 'g'), '\n+')] if s <> ''] AS s FROM last)
    SELECT record_id, len(s)::BIGINT AS n, s[1] AS first_sentence FROM x""")
def q_sentences(spark: SparkSession, d: str) -> DataFrame:
    s = lexical.sentences("answer")
    return views.records(spark, d).select("record_id", F.size(s).cast("long").alias("n"), F.try_element_at(s, F.lit(1)).alias("first_sentence"))


@query(f"""WITH {S.LAST}, t AS (SELECT {S.tokens('question')} AS t FROM last), g AS (SELECT unnest(flatten([[array_to_string(t[i:i + n - 1], ' ') for i in range(1, len(t) - n + 2)] for n in [2, 3, 4]])) AS gram FROM t)
    SELECT gram, count(*) AS n FROM g GROUP BY 1""")
def q_ngrams(spark: SparkSession, d: str) -> DataFrame:
    """All runs of words, rare ones too."""
    g = views.records(spark, d).select(F.explode(lexical.word_ngrams("question")).alias("gram"))
    return g.groupBy("gram").agg(F.count(F.lit(1)).alias("n"))


PHRASES = ["switch is turned on", "which bends at tick", "random cells", "every tenth tick", "gives way"]


@query(f"WITH {S.LAST} SELECT record_id, {S.joined(f'''list_sort([p for p in {S.words(PHRASES)} if contains({S.key("coalesce(question, '') || ' ' || coalesce(answer, '')")}, p)])''')} AS phrases FROM last")
def q_phrase_hits(spark: SparkSession, d: str) -> DataFrame:
    t = F.concat(F.coalesce("question", F.lit("")), F.lit(" "), F.coalesce("answer", F.lit("")))
    return views.records(spark, d).select("record_id", joined(lexical.phrases_in(t, lexical.words_literal(PHRASES))).alias("phrases"))


@query(rf"""WITH x AS (SELECT response_id, unnest([{S.key("substr(p, 2, len(p) - 2)")} for p in regexp_extract_all(coalesce(answer, ''), '"[^"\n]{{1,120}}"|\x27[^\x27\n]{{1,120}}\x27')]) AS phrase FROM responses)
    SELECT response_id, phrase FROM x WHERE phrase <> '' AND len(string_split(phrase, ' ')) <= 5""")
def q_quoted_phrases(spark: SparkSession, d: str) -> DataFrame:
    """Phrases in quotes of both kinds."""
    return table(spark, d, "responses").select("response_id", F.explode(lexical.quoted_phrases("answer", single=True)).alias("phrase"))


@query(f"""WITH {S.LAST}, {IDS}, {S.SEEDS}, e AS (SELECT record_id, unnest(ids) AS id, generate_subscripts(ids, 1) - 1 AS place FROM ids),
    h AS (SELECT e.record_id, s.class_id AS c FROM e JOIN seeds s ON s.seed_id = e.id QUALIFY row_number() OVER (PARTITION BY e.record_id ORDER BY place) = 1)
    SELECT count(h.record_id) AS matched, count(*) - count(h.record_id) AS unmatched, count(*) FILTER (l.class_id <> h.c) AS conflicts FROM last l LEFT JOIN h USING (record_id)""")
def q_enrich_report(spark: SparkSession, d: str) -> DataFrame:
    return enrich.report(q_enrich_priority_join(spark, d))[0]


# Source texts

_ID = srcparse.ID
CODE = r"""regexp_replace(regexp_replace(text, '\r\n?', chr(10), 'g'), '("[^"]*(?:"|$))|;[^\n]*', '\1', 'g')"""
_names = lambda x: f"[q.x for q in list_sort(list_distinct([{{'l': lower(i), 'x': i}} for i in {x}]))]"
_first = lambda x: f"list_filter({x}, lambda q, k: list_position([lower(y) for y in {x}], lower(q)) = k)"
_all = lambda pattern, group=1, of="code": f"regexp_extract_all({of}, {_quote(pattern)}, {group})"
_inner = lambda pattern: f"flatten([{_all(f'({_ID})', 1, 'b')} for b in {_all(pattern)}])"
_pair = r"(?i)\b(?:directed-link-|undirected-link-)?breed\s*\[\s*(" + _ID + r")\s+(" + _ID + r")\s*\]"
_sig = rf"(?mi)^\s*(to(?:-report)?)\s+({_ID})[ \t]*(?:\[([^\]]*)\])?"
#: The parts that the parser must find again in the sources that _sources() makes of the documents.
PARSED = rf"""s AS (SELECT doc_id, text, {CODE} AS code, 'w-' || regexp_replace(lower(coalesce(model_name, '')), '[^a-z]+', '-', 'g') AS w FROM documents),
    c AS (SELECT doc_id, text, code, CASE WHEN text IS NULL THEN [] ELSE [w || '-rate'] END AS sliders, CASE WHEN text IS NULL THEN [] ELSE [w || '-on?'] END AS switches, {_all(rf'(?mi)^\s*to(?:-report)?\s+({_ID})')} AS procedures, {_all(rf'(?mi)^\s*to-report\s+({_ID})')} AS reporters,
        list_concat({_inner(r'(?is)\bglobals\s*\[(.*?)\]')}, {_inner(r'(?is)\b' + _ID + r'-own\s*\[(.*?)\]')}) AS variables, flatten([[z[1], z[2]] for z in list_zip({_all(_pair, 1)}, {_all(_pair, 2)})]) AS pairs,
        list_concat({_all(rf'(?i)\blet\s+({_ID})')}, flatten([string_split_regex(a, '\s+') for a in {_all(rf'->\s*({_ID}(?:\s+{_ID})*)')}])) AS locals,
        [t for t in [{S.strip('t')} for t in {_all('"([^"\n]*)"')}] if t <> '' and not list_contains(['horizontal', 'vertical', 'n/a', 'nil'], lower(t))] AS literals,
        [{{'k': z[1], 'n': z[2], 'i': regexp_extract_all(z[3], '({_ID})', 1)}} for z in list_zip({_all(_sig, 1)}, {_all(_sig, 2)}, {_all(_sig, 3)})] AS sigs,
        list_filter([array_to_string([l for l in [{S.strip('l')} for l in string_split(p, chr(10))] if l <> ''], ' ') for p in string_split_regex(regexp_replace(coalesce(text, ''), '\r\n?', chr(10), 'g'), '\n[ \t]*(?:\n[ \t]*)+')],
            lambda p: p <> '' AND NOT starts_with(p, '#') AND NOT (len(string_split_regex(p, '\s+')) <= 4 AND upper(p) = p) AND len(string_split_regex(p, '\s+')) >= 8) AS info FROM s),
    parsed AS (SELECT *, {_first('pairs')} AS breeds, list_concat(sliders, switches) AS widgets FROM c)"""


def _sources(spark: SparkSession, d: str) -> DataFrame:
    """Every document as a source of three sections: its text as code, an interface of three widgets named after its model, its text as information."""
    w = F.concat(F.lit("w-"), F.regexp_replace(F.lower(F.coalesce("model_name", F.lit(""))), "[^a-z]+", "-"))
    widgets = F.concat(F.lit("ignored\nSLIDER\n1\n2\n"), w, F.lit("-rate\n"), w, F.lit("-rate\n0\n100\n\nSWITCH\n1\n2\n"), w, F.lit("-on?\n"), w, F.lit("-on?\n0\n\nMONITOR\n1\n2\n"), w, F.lit("\n"))
    cut = F.lit(srcparse.SEPARATOR)
    return table(spark, d, "documents").select("doc_id", F.concat("text", cut, widgets, cut, "text").alias("text"))


@query(f"WITH {PARSED} SELECT doc_id, array_to_string(procedures, '|') AS procedures, array_to_string([lower(g.k) || ' ' || g.n || '(' || coalesce(array_to_string(g.i, ','), '') || ')' for g in sigs], '|') AS signatures, len(code)::BIGINT AS code_chars FROM parsed WHERE text IS NOT NULL")
def q_procedures(spark: SparkSession, d: str) -> DataFrame:
    """Procedures with kind and inputs in all documents, whatever their line ends, comments removed first."""
    t = text.evaluated(table(spark, d, "documents").filter("text is not null").select("doc_id", "text"), {"code": srcparse.strip_comments("text")})
    shown = F.transform(srcparse.signatures(F.col("code")), lambda g: F.concat(g["kind"], F.lit(" "), g["name"], F.lit("("), F.array_join(g["inputs"], ","), F.lit(")")))
    return t.select("doc_id", joined(srcparse.procedures(F.col("code"))).alias("procedures"), joined(shown).alias("signatures"), F.length("code").cast("long").alias("code_chars"))


@query(f"""WITH {PARSED} SELECT doc_id, {", ".join(f"coalesce(array_to_string({x}, '|'), '') AS {n}" for n, x in (
    ("procedures", _names("procedures")), ("reporters", _names("reporters")), ("variables", _names("variables")), ("breeds", "breeds"), ("widgets", _names("widgets")), ("locals", _names("locals")), ("literals", _names("literals")), ("sliders", "sliders"), ("switches", "switches")))},
    coalesce(info[1], '') AS summary FROM parsed""")
def q_source_core(spark: SparkSession, d: str) -> DataFrame:
    """What the source parser reads from all documents; null texts give empty lists."""
    x = srcparse.core_of(_sources(spark, d), "text")
    kinds = {k + "s" if k == "slider" else k + "es": srcparse.control_names(srcparse.sections("text")["interface"], k) for k in ("slider", "switch")}
    return x.withColumns(kinds).select("doc_id", *[joined(F.col(c)).alias(c) for c in ("procedures", "reporters", "variables", "breeds", "widgets", "locals", "literals", "sliders", "switches")], "summary")


_score_of = (
    "CASE WHEN contains(token, '-') THEN 3 ELSE 0 END + CASE WHEN ends_with(token, '?') THEN 2 ELSE 0 END + CASE WHEN n >= 2 THEN 2 ELSE 0 END + CASE WHEN "
    + " OR ".join(f"starts_with(token, '{p}')" for p in srcparse.PREFIXES)
    + " THEN 2 ELSE 0 END + CASE WHEN token IN ('vision', 'visualization') THEN 2 ELSE 0 END"
)
UNRESOLVED = f"""{PARSED}, known AS (SELECT doc_id, [lower(k) for k in list_concat(procedures, variables, breeds, widgets, locals, flatten([['create-' || b, 'create-ordered-' || b, 'hatch-' || b, 'sprout-' || b, b || '-here'] for b in breeds]))] AS known,
        [lower(t) for t in regexp_extract_all(regexp_replace(code, '"[^"]*"', ' ', 'g'), '({_ID})', 1)] AS tokens FROM parsed WHERE text IS NOT NULL),
    u AS (SELECT doc_id, unnest(list_filter(tokens, lambda t: NOT list_contains(known, t))) AS token FROM known),
    unresolved AS (SELECT doc_id, token, count(*) AS n FROM u WHERE NOT list_contains({S.words(srcparse.RESERVED)}, token) GROUP BY 1, 2)"""


@query(f"WITH {UNRESOLVED} SELECT doc_id, token, n, score FROM (SELECT *, {_score_of} AS score FROM unresolved) WHERE score >= 3")
def q_unresolved(spark: SparkSession, d: str) -> DataFrame:
    """Widget candidates among the unresolved names of all documents."""
    return srcparse.widget_candidates(srcparse.unresolved(_sources(spark, d), "doc_id", "text")).select("doc_id", "token", "n", "score")


@query(f"""WITH {UNRESOLVED}, v AS (SELECT doc_id, list(token ORDER BY token) AS tokens, list(token ORDER BY token) FILTER ({_score_of} >= 3) AS candidates FROM unresolved GROUP BY 1)
    SELECT doc_id, coalesce(array_to_string({_names('widgets')}, '|'), '') AS interface_widgets, coalesce(array_to_string(candidates, '|'), '') AS widget_candidates, coalesce(array_to_string(tokens[1:20], '|'), '') AS unresolved FROM parsed LEFT JOIN v USING (doc_id)""")
def q_widget_review(spark: SparkSession, d: str) -> DataFrame:
    x = srcparse.widget_review(_sources(spark, d), "doc_id", "text")
    return x.select("doc_id", *[joined(F.col(c)).alias(c) for c in ("interface_widgets", "widget_candidates", "unresolved")])


# Profiles and audit


@query(f"WITH {S.PROFILES} SELECT model_name, array_to_string(core, '|') AS core, concat_ws(';', array_to_string(f1, '|'), array_to_string(f2, '|'), array_to_string(f3, '|')) AS families FROM profiles")
def q_profiles(spark: SparkSession, d: str) -> DataFrame:
    fams = F.array_join(F.transform("families", lambda f: joined(f["identifiers"])), ";")
    return views.profiles(spark, d).select("model_name", joined("core").alias("core"), fams.alias("families"))


@query(f"""WITH {S.PROFILES}, a AS (SELECT * FROM profiles WHERE model_name < 'm'), b AS (SELECT * FROM profiles WHERE model_name > 'g')
    SELECT coalesce(a.model_name, b.model_name) AS model_name, len(a.core)::INT AS core, ((b.f1 IS NOT NULL)::INT + (b.f2 IS NOT NULL)::INT + (b.f3 IS NOT NULL)::INT) AS families FROM a FULL JOIN b ON a.model_name = b.model_name""")
def q_full_outer_profiles(spark: SparkSession, d: str) -> DataFrame:
    p = durable(views.profiles(spark, d))
    m = profiles.merge_profiles(p.filter("model_name < 'm'"), p.filter("model_name > 'g'"))
    return m.select("model_name", F.when(F.col("core").isNotNull(), F.size("core")).alias("core"), F.size("families").alias("families"))


@query(f"""WITH {S.LAST}, a AS (SELECT DISTINCT model_name, unnest({S.ticked('question')}) AS term FROM last WHERE model_name IS NOT NULL), b AS (SELECT DISTINCT model_name, unnest({S.ticked('answer')}) AS term FROM last WHERE model_name IS NOT NULL),
    x AS (SELECT coalesce(a.model_name, b.model_name) AS model_name, a.term AS ta, b.term AS tb FROM a FULL JOIN b ON a.model_name = b.model_name AND a.term = b.term)
    SELECT model_name, coalesce(string_agg(ta, '|' ORDER BY ta) FILTER (tb IS NULL), '') AS only_now, coalesce(string_agg(tb, '|' ORDER BY tb) FILTER (ta IS NULL), '') AS only_before, coalesce(string_agg(ta, '|' ORDER BY ta) FILTER (ta = tb), '') AS both,
        count(*) FILTER (tb IS NULL) AS n_only_now, count(*) FILTER (ta IS NULL) AS n_only_before, count(*) FILTER (ta IS NOT NULL AND tb IS NOT NULL) AS n_both FROM x GROUP BY 1""")
def q_core_diff(spark: SparkSession, d: str) -> DataFrame:
    r = views.records(spark, d).filter("model_name is not null")
    side = lambda c: r.select("model_name", F.explode(lexical.backticked_identifiers(c)).alias("term"))
    x = profiles.compare_identifiers(side("question"), side("answer"))
    return x.withColumns({c: joined(F.col(c)) for c in ("only_now", "only_before", "both")})


_record_text = "coalesce(question, '') || chr(10) || coalesce(answer, '')"
_plain = lambda x: f"[lower(t) for t in regexp_extract_all({x}, '{lexical.IDENTIFIER}', 1)]"
_marked = lambda x: rf"""list_concat([{S.key('t')} for t in {S.spans(x)}], [lower(b) for b in [{S.strip('b')} for b in regexp_extract_all({x}, '\[([^\]]+)\]', 1)] if regexp_matches(b, '{lexical.SINGLE_IDENTIFIER}')], [t for t in {_plain(x)} if contains(t, '-') or ends_with(t, '?')])"""
_runs = lambda t: f"flatten([[array_to_string({t}[i:i + n - 1], ' ') for i in range(1, len({t}) - n + 2) if list_has_any({t}[i:i + n - 1], {S.words(audit.PHRASE_KEYWORDS)})] for n in [2, 3, 4]])"
AUDIT = rf"""{S.PROFILES}, texts AS (SELECT model_name, record_id, left(coalesce(question, ''), 220) AS example, {_record_text} AS text FROM last WHERE model_name IS NOT NULL),
    {PARSED.replace('FROM documents)', ', model_name FROM documents)').replace('SELECT doc_id, text, code, CASE', 'SELECT doc_id, model_name, text, code, CASE')},
    {UNRESOLVED[len(PARSED) + 2:].replace('known AS (SELECT doc_id,', 'known AS (SELECT doc_id, model_name,').replace('FROM parsed WHERE text', "FROM (SELECT * REPLACE ([] AS widgets) FROM parsed) WHERE text")},
    hints AS (SELECT model, term, bool_or(aux) AS aux, bool_or(NOT aux) AS unresolved FROM (SELECT {S.model('model_name')} AS model, lower(unnest(literals)) AS term, true AS aux FROM parsed UNION ALL SELECT {S.model('k.model_name')}, token, false FROM unresolved JOIN known k USING (doc_id)) WHERE model IS NOT NULL GROUP BY 1, 2),
    uses AS (SELECT model_name, term, count(*) FILTER (m = 1) AS marked, count(*) FILTER (m = 0) AS plain FROM (SELECT model_name, unnest({_marked('text')}) AS term, 1 AS m FROM texts UNION ALL SELECT model_name, unnest([t for t in {_plain('text')} if not contains(t, '-') and not ends_with(t, '?')]), 0 FROM texts) WHERE term <> '' GROUP BY 1, 2),
    met AS (SELECT u.model_name, u.term, list_contains(p.core, u.term) AS is_core, coalesce(h.aux, false) AS aux, coalesce(h.unresolved, false) AS unresolved, marked + CASE WHEN list_contains(p.core, u.term) OR coalesce(h.unresolved, false) THEN plain ELSE 0 END AS n FROM uses u JOIN profiles p ON u.model_name = p.model_name LEFT JOIN hints h ON u.model_name = h.model AND u.term = h.term),
    classified AS (SELECT model_name, term, n, CASE WHEN is_core THEN 'core' WHEN aux OR list_contains({S.words(routing.ALLOW)}, term) THEN 'supported' WHEN unresolved THEN 'parser_miss' WHEN n >= 2 THEN 'extension_candidate' ELSE 'drift' END AS class FROM met WHERE n > 0),
    top AS (SELECT *, CAST(row_number() OVER (PARTITION BY model_name, class ORDER BY n DESC, term) AS INT) AS rank FROM classified),
    phrases AS (SELECT model_name, unnest(list_concat([p for p in [{S.key("substr(p, 2, len(p) - 2)")} for p in regexp_extract_all(text, '"[^"\n]{{1,120}}"|\x27[^\x27\n]{{1,120}}\x27')] if p <> '' and len(string_split(p, ' ')) <= 5], {_runs('w')})) AS phrase
        FROM (SELECT model_name, text, [t for t in {_plain('text')} if not list_contains({S.words(lexical.STOPWORDS + audit.MORE_STOPWORDS)}, t)] AS w FROM texts)),
    phrase_uses AS (SELECT model_name, phrase, count(*) AS n FROM phrases GROUP BY 1, 2)"""
SUPPORT = f"""{AUDIT}, f AS (SELECT model_name, 'family_1' AS family, unnest(f1) AS term FROM profiles UNION ALL SELECT model_name, 'family_2', unnest(f2) FROM profiles UNION ALL SELECT model_name, 'family_3', unnest(f3) FROM profiles),
    fi AS (SELECT f.model_name, family, coalesce(sum(n), 0)::BIGINT AS unsupported, coalesce(sum(n) FILTER (class = 'extension_candidate'), 0)::BIGINT AS candidates, coalesce(sum(n) FILTER (class = 'parser_miss'), 0)::BIGINT AS parser_misses
        FROM f LEFT JOIN classified c ON f.model_name = c.model_name AND f.term = c.term AND c.class NOT IN ('core', 'supported') GROUP BY 1, 2),
    fc AS (SELECT g.model_name, family, coalesce(sum(n), 0)::BIGINT AS phrases FROM (SELECT DISTINCT model_name, family, replace(term, '-', ' ') AS phrase FROM f) g LEFT JOIN phrase_uses u ON g.model_name = u.model_name AND g.phrase = u.phrase GROUP BY 1, 2),
    support AS (SELECT *, unsupported + candidates + phrases AS support FROM fi JOIN fc USING (model_name, family))"""


def _audit(spark: SparkSession, d: str) -> DataFrame:
    return audit.classified_terms(views.records(spark, d), views.profiles(spark, d), routing.ALLOW, views.source_hints(spark, d))


@query(f"WITH {SUPPORT} SELECT model_name, family, unsupported, candidates, parser_misses, phrases, support FROM support")
def q_family_support(spark: SparkSession, d: str) -> DataFrame:
    """What the audit's unsupported terms and phrases have on each family of a model."""
    return profiles.family_support(views.profiles(spark, d), _audit(spark, d), audit.phrase_uses(views.records(spark, d)))


@query(f"""WITH {S.PROFILES}, s AS (SELECT model_name, list_distinct(list_concat(f1, core[1:2])) AS ids FROM profiles), c AS (SELECT * FROM profiles WHERE model_name < 'p')
    SELECT s.model_name, c.model_name IS NULL AS missing_core, coalesce(array_to_string(list_sort(list_intersect(s.ids, c.core)), '|'), '') AS overlap FROM s LEFT JOIN c ON s.model_name = c.model_name""")
def q_spec_validation(spark: SparkSession, d: str) -> DataFrame:
    p = durable(views.profiles(spark, d))
    spec = F.array(F.struct(F.lit("made").alias("name"), F.concat(F.coalesce(F.try_element_at("families", F.lit(1))["identifiers"], F.array().cast("array<string>")), F.slice("core", 1, 2)).alias("identifiers"), F.array().cast("array<string>").alias("concepts")))
    x = profiles.validate_specs(p.filter("model_name < 'p'"), p.select("model_name", spec.alias("families")))
    return x.select("model_name", "missing_core", joined("overlap").alias("overlap"))


@query(f"WITH {SUPPORT} SELECT model_name, family, support, CAST(row_number() OVER (ORDER BY support DESC, model_name, family) AS INT) AS place FROM support QUALIFY place <= 100")
def q_extension_summary(spark: SparkSession, d: str) -> DataFrame:
    return profiles.extension_summary(q_family_support(spark, d).select("model_name", "family", "support"))


@query(f"WITH {AUDIT} SELECT model_name, class, count(*) AS terms, sum(n)::BIGINT AS uses FROM classified GROUP BY 1, 2")
def q_audit_terms(spark: SparkSession, d: str) -> DataFrame:
    return _audit(spark, d).groupBy("model_name", "class").agg(F.count(F.lit(1)).alias("terms"), F.sum("n").alias("uses"))


@query(f"WITH {AUDIT} SELECT model_name, class, term, n, rank FROM top WHERE rank <= 10")
def q_audit_topk(spark: SparkSession, d: str) -> DataFrame:
    return audit.top_terms(_audit(spark, d), 10).select("model_name", "class", "term", "n", "rank")


@query(f"""WITH {AUDIT}, rolled AS (SELECT class, term, sum(n)::BIGINT AS n FROM top WHERE rank <= 50 GROUP BY 1, 2)
    SELECT class, term, n, CAST(row_number() OVER (PARTITION BY class ORDER BY n DESC, term) AS INT) AS rank FROM rolled QUALIFY rank <= 100""")
def q_audit_rollup(spark: SparkSession, d: str) -> DataFrame:
    return audit.roll_up(audit.top_terms(_audit(spark, d), 50), 100).select("class", "term", "n", "rank")


@query(f"WITH {AUDIT} SELECT model_name, sum(n)::BIGINT AS n FROM classified WHERE class NOT IN ('core', 'supported') GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20")
def q_audit_pressure(spark: SparkSession, d: str) -> DataFrame:
    return audit.pressure(_audit(spark, d))


@query(f"WITH {AUDIT} SELECT model_name, phrase, n, CAST(row_number() OVER (PARTITION BY model_name ORDER BY n DESC, phrase) AS INT) AS rank FROM phrase_uses QUALIFY rank <= 100")
def q_audit_phrases(spark: SparkSession, d: str) -> DataFrame:
    """The most used phrases of each model: quoted ones, and runs of terms that have a keyword."""
    p = audit.phrase_uses(views.records(spark, d)).select("model_name", F.lit("phrase").alias("class"), F.col("phrase").alias("term"), "n")
    return audit.top_terms(p, 100).select("model_name", F.col("term").alias("phrase"), "n", "rank")


@query(f"""WITH {AUDIT}, e AS (SELECT model_name, record_id, example, unnest(list_distinct(list_concat({_marked('text')}, {_plain('text')}))) AS term FROM texts WHERE record_id IS NOT NULL),
    r AS (SELECT *, row_number() OVER (PARTITION BY model_name, term ORDER BY record_id, example) AS r FROM e QUALIFY r <= 3)
    SELECT model_name, term, class, record_id, example FROM r JOIN classified USING (model_name, term)""")
def q_audit_examples(spark: SparkSession, d: str) -> DataFrame:
    """The first records that hold each exact term, of every class."""
    return audit.examples(views.records(spark, d), _audit(spark, d))


# Routing


def _family_score(f: str) -> str:
    phrases = f"list_distinct([replace(i, '-', ' ') for i in {f}])"
    split = f"list_distinct(flatten([string_split(replace(i, '-', ' '), ' ') for i in {f}]))"
    return (
        f"{routing.W_ID} * len([i for i in list_distinct({f}) if list_contains(terms, i)]) + {routing.W_PHRASE} * len([i for i in {phrases} if i <> '' and contains(low, i)])"
        f" + {routing.W_TOKEN} * len([i for i in {split} if not list_contains({S.words(lexical.STOPWORDS)}, i) and list_contains(terms, i)])"
    )


_rule = lambda mode, why, fam="NULL": f"{{'r': '{mode}', 'w': {why}, 'f': CAST({fam} AS VARCHAR)}}"


ROUTED = f"""{S.PROFILES}, {S.SEEDS}, x AS (SELECT s.seed_id, s.model_name, p.model_name AS pm, coalesce(p.core, []) AS core, coalesce(p.f1, []) AS f1, coalesce(p.f2, []) AS f2, coalesce(p.f3, []) AS f3, {_text} AS text FROM seeds s LEFT JOIN profiles p USING (model_name)),
    y AS (SELECT *, list_distinct({S.term_list('text')}) AS terms, {S.key('text')} AS low, list_distinct(list_concat(f1, f2, f3)) AS ext FROM x),
    z AS (SELECT *, len([t for t in terms if list_contains(core, t)]) AS hits, len([t for t in terms if not list_contains(core, t) and not list_contains(ext, t) and not list_contains({S.words(routing.ALLOW)}, t)]) / greatest(1, len(terms)) AS unknown,
        len([t for t in terms if list_contains(ext, t)]) AS ids, len([i for i in ext if i <> '' and contains(low, replace(i, '-', ' '))]) AS concepts, list_has_any(terms, {S.words(routing.INTENT)}) AS intent,
        list_filter([{{'s': {_family_score('f1')}, 'b': 0, 'n': 'family_1', 'k': len(f1)}}, {{'s': {_family_score('f2')}, 'b': -1, 'n': 'family_2', 'k': len(f2)}}, {{'s': {_family_score('f3')}, 'b': -2, 'n': 'family_3', 'k': len(f3)}}], lambda q: q.k > 0) AS fams FROM y),
    b AS (SELECT *, coalesce(list_max([q.s for q in fams]), 0) AS score, list_sort(fams, 'DESC')[1].n AS top FROM z),
    c AS (SELECT *, CASE WHEN score > 0 THEN top END AS fam, CASE WHEN {_matches('text', routing.HEX_GRID)} THEN 'seed_requires_hex_grid' WHEN {_matches('text', routing.PATHOGENS)} AND NOT contains(array_to_string(core, ' '), 'sick?') AND NOT contains(array_to_string(core, ' '), 'infected') THEN 'seed_requires_multi_pathogen' END AS bad FROM b),
    d AS (SELECT *, CASE WHEN pm IS NULL THEN {_rule('skip', "'missing_model_profile'")} WHEN bad IS NOT NULL THEN {_rule('skip', "'scope_mismatch:' || bad")}
        WHEN fam IS NOT NULL AND (score >= {routing.STRONG} OR (intent AND score >= {routing.WEAK})) THEN {_rule('anchored_extension', "'strong_extension_family_match'", 'fam')}
        WHEN hits >= {routing.PARAPHRASE_HITS} AND score = 0 AND unknown <= {routing.PARAPHRASE_UNKNOWN} THEN {_rule('core_paraphrase', "'strong_core_match'")}
        WHEN hits >= {routing.REPAIR_HITS} AND score = 0 AND unknown <= {routing.REPAIR_UNKNOWN} THEN {_rule('core_repair', "'core_match_with_noise'")}
        WHEN fam IS NOT NULL AND score >= {routing.WEAK} AND (intent OR ids > 0 OR concepts > 0) THEN {_rule('anchored_extension', "'mixed_core_extension_content'", 'fam')}
        WHEN hits >= 1 AND unknown > {routing.REPAIR_UNKNOWN} AND {_matches('text', routing.MODIFICATION)} THEN {_rule('freeform_extension', "'extension_intent_with_weak_core_anchor'")}
        WHEN hits >= 1 THEN {_rule('core_repair', "'weak_core_anchor'")} ELSE {_rule('skip', "'insufficient_anchor'")} END AS rule FROM c)"""


@query(f"""WITH {ROUTED}
    SELECT seed_id, rule.r AS route, rule.w AS route_reason, rule.f AS family, hits::INT AS core_hits, score::INT AS best_family_score, round(unknown, 6) AS unknown_ratio, intent AS extension_intent FROM d""")
def q_route(spark: SparkSession, d: str) -> DataFrame:
    x = routing.route(views.seeds(spark, d), views.profiles(spark, d))
    return x.select("seed_id", "route", "route_reason", "family", "core_hits", "best_family_score", F.round("unknown_ratio", 6).alias("unknown_ratio"), "extension_intent")


@query(f"""WITH {ROUTED}, e AS (SELECT model_name, rule.r AS route, rule.w AS route_reason, rule.f AS family FROM d) SELECT 'total' AS kind, CAST(NULL AS VARCHAR) AS key, CAST(NULL AS VARCHAR) AS key2, count(*) AS n FROM e
    UNION ALL SELECT 'route', route, NULL, count(*) FROM e GROUP BY 2 UNION ALL SELECT 'family', family, NULL, count(*) FROM e WHERE family IS NOT NULL GROUP BY 2 UNION ALL SELECT 'route_reason', route_reason, NULL, count(*) FROM e GROUP BY 2
    UNION ALL SELECT 'model_name', model_name, NULL, count(*) FROM e WHERE model_name IS NOT NULL GROUP BY 2 UNION ALL SELECT 'model_name+route', model_name, route, count(*) FROM e WHERE model_name IS NOT NULL GROUP BY 2, 3""")
def q_route_summary(spark: SparkSession, d: str) -> DataFrame:
    """What the routes come to: in all, by mode, family, reason and model, and by model and mode."""
    x = routing.route(views.seeds(spark, d), views.profiles(spark, d))
    return telemetry.summary(x, ["route", "family", "route_reason", "model_name"], [("model_name", "route")])


# Support, tasks, capacity

POOLED = """cand AS (SELECT s.seed_id, r.record_id, r.source, CASE WHEN s.class_id = r.class_id THEN 'same_class_same_model' ELSE 'same_model' END AS relation,
        50 + CASE WHEN s.class_id = r.class_id THEN 40 ELSE 0 END + CASE WHEN s.level = r.level THEN 5 ELSE 0 END + CASE r.source WHEN 'corpus' THEN 8 WHEN 'seed' THEN 3 ELSE 0 END AS score
        FROM seeds s JOIN last r ON s.model_name = r.model_name WHERE r.source IN ('corpus', 'seed') AND r.seed_id IS DISTINCT FROM s.seed_id AND NOT (r.source = 'seed' AND r.source_id = s.seed_id)),
    pool AS (SELECT *, CAST(row_number() OVER (PARTITION BY seed_id ORDER BY score DESC, record_id) AS INT) AS rank FROM cand QUALIFY rank <= 12)"""
POOL = f"{S.LAST}, {S.SEEDS}, {POOLED}"


def _pools(spark: SparkSession, d: str) -> DataFrame:
    return support.support_pools(views.seeds(spark, d), views.records(spark, d))


@query(f"WITH {POOL} SELECT seed_id, record_id, source, relation, score, rank FROM pool")
def q_support_pool(spark: SparkSession, d: str) -> DataFrame:
    return _pools(spark, d)


@query(f"""WITH {POOL}, n AS (SELECT seed_id, count(record_id) AS n FROM seeds LEFT JOIN pool USING (seed_id) GROUP BY 1)
    SELECT 'pools' AS kind, 'seeds' AS key, count(*)::DOUBLE AS value FROM n UNION ALL SELECT 'pools', 'avg_size', round(avg(n), 4) FROM n UNION ALL SELECT 'pools', 'min_size', min(n) FROM n UNION ALL SELECT 'pools', 'max_size', max(n) FROM n
    UNION ALL SELECT 'relation', relation, count(*) FROM pool GROUP BY 2 UNION ALL SELECT 'source', source, count(*) FROM pool GROUP BY 2""")
def q_pool_summary(spark: SparkSession, d: str) -> DataFrame:
    return support.pool_summary(_pools(spark, d), views.seeds(spark, d))


PLAN = planner.Plan()
_modes = "MAP {" + ", ".join(f"'{m}': {S.words(t)}" for m, t in PLAN.transforms.items()) + "}"
_n = lambda d: "MAP {" + ", ".join(f"'{k}': {v}" for k, v in d.items()) + "}"
_share = "MAP {" + ", ".join(f"'{k}': {round(v * 100)}" for k, v in PLAN.alternate_share.items()) + "}"
_key = lambda *c: " || '|' || ".join(f"coalesce({x}, '')" for x in c)


def _planned(worth: str, room: str, more: str = "") -> str:
    """The planner in SQL: what multiplies a priority, a seed's cap, and further tables for the seeds."""
    return f"""c AS (SELECT s.*, unnest(({_modes})[s.route_mode]) AS transform_type, p.record_id AS support_record_id,
        coalesce(p.source, 'seed_only') AS support_source, coalesce(p.relation, 'seed_only') AS support_relation, coalesce(p.score, 0)::DOUBLE AS support_score
        FROM (SELECT * FROM seeds {more}) s LEFT JOIN pool p ON s.seed_id = p.seed_id AND p.rank <= ({_n(PLAN.supports)})[s.route_mode] WHERE s.route_mode IN {tuple(PLAN.transforms)}),
    h AS (SELECT *, CASE WHEN route_mode = 'anchored_extension' AND {S.sha1_mod(_key('seed_id', 'route_mode', 'extension_family', 'transform_type', 'support_record_id'), 100)} < coalesce(({_share})[extension_family], 0) THEN '{PLAN.alternate}' ELSE '{PLAN.provider}' END AS provider_hint FROM c),
    k AS (SELECT *, sha1({_key('seed_id', 'route_mode', 'extension_family', 'transform_type', 'support_record_id', 'provider_hint')} || '|v1') AS task_key,
        round_even((coalesce(({_n(PLAN.tier_weight)})[coalesce(tier, 'C')], 0.5) + coalesce(({_n(PLAN.route_weight)})[route_mode], 0.7) + support_score / 100 + CASE WHEN support_source = 'corpus' THEN 0.05 ELSE 0 END - CASE WHEN support_relation = 'seed_only' THEN 0.08 ELSE 0 END) * {worth}
        + ({S.sha1_mod(_key('seed_id', 'route_mode', 'extension_family', 'support_record_id', 'provider_hint'), 1000)}) / 1000000.0, 6) AS priority,
        row_number() OVER (PARTITION BY seed_id ORDER BY support_score DESC, transform_type, coalesce(support_record_id, '')) AS r FROM h),
    capped AS (SELECT * FROM k WHERE r <= {room}),
    planned AS (SELECT *, row_number() OVER (PARTITION BY support_record_id ORDER BY seed_id, r) AS s FROM capped QUALIFY support_record_id IS NULL OR s <= 60)"""


TASKS = f"{POOL}, {_planned('1.0', f'({_n(PLAN.tasks)})[route_mode]')}"


def _tasks(spark: SparkSession, d: str) -> DataFrame:
    return planner.enumerate_tasks(views.seeds(spark, d), _pools(spark, d), PLAN)


@query(f"WITH {TASKS} SELECT task_key, seed_id, transform_type, support_record_id, provider_hint, round(priority * 1e6)::BIGINT AS micro_priority FROM planned")
def q_tasks(spark: SparkSession, d: str) -> DataFrame:
    return _tasks(spark, d).select("task_key", "seed_id", "transform_type", "support_record_id", "provider_hint", F.round(F.col("priority") * 1e6).cast("long").alias("micro_priority"))


HISTOGRAMS = ["route_mode", "extension_family", "provider_hint", "tier", "transform_type", "support_relation", "model_name", "seed_id"]


@query(f"""WITH {TASKS}, a AS (SELECT 'total' AS kind, CAST(NULL AS VARCHAR) AS key, count(*) AS n FROM planned UNION ALL {" UNION ALL ".join(f"SELECT '{c}', {c}, count(*) FROM planned WHERE {c} IS NOT NULL GROUP BY 2" for c in HISTOGRAMS)})
    SELECT kind, key, n FROM a QUALIFY kind NOT IN ('model_name', 'seed_id') OR row_number() OVER (PARTITION BY kind ORDER BY n DESC, key) <= 50""")
def q_task_summary(spark: SparkSession, d: str) -> DataFrame:
    """How many planned tasks have each value of each column, of models and seeds the first 50."""
    return telemetry.histograms(_tasks(spark, d), HISTOGRAMS, {"model_name": 50, "seed_id": 50})


@query(f"""WITH {S.SEEDS}, n AS (SELECT model_name, count(*) AS n FROM seeds WHERE route_mode <> 'skip' AND model_name IS NOT NULL GROUP BY 1), r AS (SELECT *, row_number() OVER (ORDER BY n DESC, model_name) AS r FROM n)
    SELECT model_name, CASE WHEN r <= 8 THEN 'high_volume' WHEN r <= 20 THEN 'mid_volume' ELSE 'long_tail' END AS model_bucket FROM r""")
def q_model_buckets(spark: SparkSession, d: str) -> DataFrame:
    return planner.model_buckets(views.seeds(spark, d))


@query(f"""WITH {S.TASKS}, x AS (SELECT task_key, {S.sha1_mod(_key('seed_id', 'route_mode', 'extension_family', 'transform_type', 'support_record_id'), 100)} AS percent, {S.sha1_mod(_key('seed_id', 'provider_hint'), 1000)} AS mille FROM tasks)
    SELECT task_key, percent, mille FROM x""")
def q_hash_split(spark: SparkSession, d: str) -> DataFrame:
    """The deterministic split by hash of every task."""
    c = lambda *n: numbers.joined_key(*[F.col(x) for x in n])
    return views.tasks(spark, d).select("task_key", numbers.sha1_mod(c("seed_id", "route_mode", "extension_family", "transform_type", "support_record_id"), 100).alias("percent"), numbers.sha1_mod(c("seed_id", "provider_hint"), 1000).alias("mille"))


QUOTA = {"core_repair": 700, "core_paraphrase": 200, "anchored_extension": 100}


@query(f"""WITH {S.TASKS}, r AS (SELECT task_key, route_mode, row_number() OVER (PARTITION BY route_mode ORDER BY CASE WHEN isnan(priority) THEN NULL ELSE priority END DESC NULLS LAST, task_key) AS r FROM tasks)
    SELECT task_key, route_mode FROM r WHERE r <= coalesce(({_n(QUOTA)})[route_mode], 9e18)""")
def q_quota_cut(spark: SparkSession, d: str) -> DataFrame:
    p = F.when(~F.isnan("priority"), F.col("priority"))
    return planner.quota_cut(views.tasks(spark, d).select("task_key", "route_mode", "priority"), "route_mode", QUOTA, [p.desc_nulls_last(), F.col("task_key")]).select("task_key", "route_mode")


@query()
def q_select_greedy(spark: SparkSession, d: str) -> DataFrame:
    t = views.tasks(spark, d).select("task_key", "route_mode", "tier", "extension_family", "provider_hint", F.when(~F.isnan("priority"), F.col("priority")).alias("priority"))
    targets = {"route_mode": planner.target_counts(500, {"core_repair": 0.5, "core_paraphrase": 0.3, "anchored_extension": 0.2}), "tier": {"A": 150, "C": 250}, "extension_family": {"memory_layer": 10}, "provider_hint": {"prov-nano": 400}}
    return planner.select_tasks(t, 500, targets, only_in={"extension_family": ("route_mode", "anchored_extension")})


FEATURES = f"""{S.PROFILES}, {S.SEEDS},
    f1 AS (SELECT model_name, count(DISTINCT seed_id) AS n_seed_anchors, count(DISTINCT class_id) AS n_classes_covered, count(*) FILTER (route_mode = 'core_repair') AS n_core_repair FROM seeds WHERE model_name IS NOT NULL GROUP BY 1),
    f2 AS (SELECT model_name, count(*) AS n_corpus_records FROM last WHERE model_name IS NOT NULL GROUP BY 1),
    f3 AS (SELECT model_name, len(core) AS n_core_procedures, (f1 IS NOT NULL)::INT + (f2 IS NOT NULL)::INT + (f3 IS NOT NULL)::INT AS n_extension_families, coalesce(len(f1), 0) + coalesce(len(f2), 0) + coalesce(len(f3), 0) AS n_extension_identifiers FROM profiles),
    m AS (SELECT * FROM f1 FULL JOIN f2 USING (model_name) FULL JOIN f3 USING (model_name))"""


def _matrix(spark: SparkSession, d: str) -> DataFrame:
    r, s = views.records(spark, d), views.seeds(spark, d)
    return capacity.feature_matrix([capacity.seed_features(s).select("model_name", "n_seed_anchors", "n_classes_covered", "n_core_repair"), capacity.corpus_features(r).select("model_name", "n_corpus_records"), capacity.profile_features(profiles.derive_profiles(r))])


@query(f"WITH {FEATURES} SELECT model_name, n_seed_anchors, n_classes_covered, n_core_repair, n_corpus_records, n_core_procedures::INT AS n_core_procedures, n_extension_families, n_extension_identifiers::INT AS n_extension_identifiers FROM m")
def q_capacity_features(spark: SparkSession, d: str) -> DataFrame:
    return _matrix(spark, d)


_norm = lambda c: f"CASE WHEN {c} IS NULL THEN 0.0 WHEN max({c}) OVER () <= min({c}) OVER () THEN 1.0 ELSE ({c} - min({c}) OVER ())::DOUBLE / (max({c}) OVER () - min({c}) OVER ()) END"
_made = ("n_seed_anchors", "n_corpus_records", "n_classes_covered", "n_core_procedures", "n_extension_families", "n_extension_identifiers")
_score = " + ".join(f"{capacity.WEIGHTS[c]} * {_norm(c)}" for c in _made)


@query(f"""WITH {FEATURES}, s AS (SELECT model_name, {_score} AS score FROM m)
    SELECT model_name, round(score, 5) AS capacity_score, round_even(10 + 20 * score * 0.9, 0)::INT AS cap_total, CASE WHEN score * 0.9 >= 0.72 THEN 'high_capacity' WHEN score * 0.9 >= 0.45 THEN 'mid_capacity' ELSE 'low_capacity' END AS capacity_bucket FROM s""")
def q_capacity(spark: SparkSession, d: str) -> DataFrame:
    m = durable(_matrix(spark, d))
    score = capacity.scaled(m, list(capacity.WEIGHTS)).select("model_name", F.round(capacity.weighted_score(), 5).alias("capacity_score"))
    return capacity.report(m).select("model_name", "cap_total", "capacity_bucket").join(score, "model_name")


_capacities = f"""s AS (SELECT model_name, round_even(({_score}), 6) AS score FROM m), capacities AS (SELECT model_name, eff, CASE WHEN eff >= {capacity.HIGH} THEN 'high_capacity' WHEN eff >= {capacity.MID} THEN 'mid_capacity' ELSE 'low_capacity' END AS bucket
    FROM (SELECT model_name, round_even(score * (1 - {capacity.LOW_SUPPORT}), 6) AS eff FROM s))"""
_room = "CASE route_mode " + " ".join(f"WHEN '{m}' THEN coalesce(round_even({capacity.CAPS[f'cap_{m}'][0]} + {capacity.CAPS[f'cap_{m}'][1] - capacity.CAPS[f'cap_{m}'][0]} * eff, 0)::INT, {n})" for m, n in PLAN.tasks.items()) + " END"


@query(f"""WITH {FEATURES}, {_capacities}, {POOLED}, {_planned('coalesce(eff, 1.0)', _room, 'LEFT JOIN capacities USING (model_name)')}
    SELECT task_key, seed_id, coalesce(bucket, 'long_tail') AS model_bucket, floor(priority * 1e3)::BIGINT AS milli_priority FROM planned""")
def q_tasks_capacity(spark: SparkSession, d: str) -> DataFrame:
    """The plan by what each model can yield: its own caps, weights and buckets."""
    t = planner.enumerate_tasks(views.seeds(spark, d), _pools(spark, d), PLAN, capacity.report(durable(_matrix(spark, d))))
    return t.select("task_key", "seed_id", "model_bucket", F.floor(F.col("priority") * 1e3).cast("long").alias("milli_priority"))


@query(f"""WITH {POOL}, z AS (SELECT model_name, seed_id, count(*) AS n FROM pool JOIN seeds USING (seed_id) GROUP BY 1, 2), u AS (SELECT model_name, record_id, count(*) AS n FROM pool JOIN seeds USING (seed_id) GROUP BY 1, 2),
    a AS (SELECT model_name, round(avg(n), 4) AS avg_size, median(n)::DOUBLE AS median_size, max(n) AS max_size FROM z GROUP BY 1), b AS (SELECT model_name, round(avg(n), 4) AS reuse_avg, max(n) AS reuse_max FROM u GROUP BY 1)
    SELECT * FROM a JOIN b USING (model_name)""")
def q_pool_features(spark: SparkSession, d: str) -> DataFrame:
    x = capacity.pool_features(_pools(spark, d), views.seeds(spark, d))
    return x.select("model_name", F.col("support_pool_avg_size").alias("avg_size"), F.col("support_pool_median_size").alias("median_size"), F.col("support_pool_max_size").alias("max_size"), "reuse_avg", "reuse_max")


# Gates

REPLY = """CASE response_id % 8 WHEN 0 THEN '{"question": "a", "answer": "b"}' WHEN 1 THEN '{"question": "a", "answer": "b", "more": [1]}' WHEN 2 THEN 'no json' WHEN 3 THEN '["question"]' WHEN 4 THEN '{"question": "a"}'
    WHEN 5 THEN '{"skip": null, "question": "a", "answer": "b"}' WHEN 6 THEN '{"question": 1, "answer": "b"}' ELSE NULL END"""


@query("""SELECT response_id, CASE response_id % 8 WHEN 0 THEN NULL WHEN 1 THEN NULL WHEN 2 THEN 'bad_json' WHEN 3 THEN 'not_an_object' WHEN 4 THEN 'missing_key' WHEN 5 THEN 'skip' WHEN 6 THEN 'not_a_string' ELSE 'NO_RESPONSE' END AS error,
    CASE WHEN response_id % 8 < 2 THEN 'b' END AS answer FROM responses""")
def q_parse_json(spark: SparkSession, d: str) -> DataFrame:
    x = table(spark, d, "responses").select("response_id", F.expr(REPLY).alias("raw"))
    r = gates.parse_reply("raw")
    return x.select("response_id", r["error"].alias("error"), r["answer"].alias("answer"))


@query("""WITH c AS (SELECT label, list(v ORDER BY i) AS c FROM (SELECT label, i, avg(v) AS v FROM (SELECT label, unnest(embedding)::DOUBLE AS v, generate_subscripts(embedding, 1) AS i FROM embeddings WHERE label IS NOT NULL) GROUP BY 1, 2) GROUP BY 1),
    s AS (SELECT vec_id, e.label AS own, c.label, list_cosine_similarity(e.embedding::DOUBLE[], c.c) AS s FROM embeddings e, c), r AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY s DESC, label DESC) AS r FROM s),
    t AS (SELECT vec_id, any_value(own) AS own, max(label) FILTER (r = 1) AS best_label, max(s) FILTER (r = 1) AS s1, max(s) FILTER (r = 2) AS s2 FROM r GROUP BY 1)
    SELECT vec_id, best_label, round(s1, 5) AS similarity, CASE WHEN own IS NOT NULL AND best_label <> own THEN 'WRONG_CLASS_NEIGHBORHOOD' WHEN s1 < 0.65 THEN 'LOW_EMBED_SIM' WHEN s1 - coalesce(s2, -1) < 0.01 THEN 'LOW_CLASS_MARGIN' END AS reason FROM t""")
def q_gate1_knn(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "embeddings")
    x = gates.nearest_class(e, gates.class_centres(e), "vec_id")
    return x.select("vec_id", "best_label", F.round("similarity", 5).alias("similarity"), "reason")


def _gated(spark: SparkSession, d: str) -> DataFrame:
    t = views.tasks(spark, d).select("task_key", text.strip("route_mode").alias("route_mode"), "extension_family")
    r = table(spark, d, "responses").withColumn("model_name", text.model_key("model_name"))
    return gates.validate_vocabulary(r.join(t, "task_key", "left"), views.profiles(spark, d), routing.ALLOW)


_none_of = lambda *xs: " and ".join(f"not list_contains({x}, u)" for x in xs)



#: The vocabulary gate in SQL over rows g (id, m, mode, fam, a, q) and the profiles; it ends with gated (id, mode, reason).
VOCABULARY = f"""p AS (SELECT *, list_distinct(list_concat(coalesce(f1, []), coalesce(f2, []), coalesce(f3, []))) AS ext FROM profiles),
    t AS (SELECT *, q || chr(10) || a AS text FROM g),
    x AS (SELECT t.*, p.model_name AS pm, p.core, p.ext, CASE fam WHEN 'family_1' THEN coalesce(f1, []) WHEN 'family_2' THEN coalesce(f2, []) WHEN 'family_3' THEN coalesce(f3, []) ELSE [] END AS own_family, list_distinct({S.ticked('text')}) AS used, {S.key('text')} AS low, {S.key('a')} AS ak,
        list_concat([m, replace(m, '_', '-')], list_filter(string_split(m, '_'), lambda w: len(w) >= 3)) AS own FROM t LEFT JOIN p ON t.m = p.model_name),
    y AS (SELECT *, [u for u in used if list_contains(ext, u)] AS ue, [u for u in used if {_none_of('core', 'ext', 'own', S.words(routing.ALLOW))}] AS un, {_matches('ak', gates.any_phrase(gates.FRAMING_CUES))} OR {_matches('a', gates.any_of(gates.FRAMING))} AS framed,
        [{S.key('q')} for q in string_split_regex(regexp_replace(a, '([.!?])\\s+', '\\1' || chr(10), 'g'), '\\n+')] AS s FROM x),
    z AS (SELECT *, list_filter(s, lambda q: {_matches('q', gates.any_phrase(gates.CLAIMS))} AND NOT {_matches('q', gates.any_phrase(gates.SAFE))} AND len(list_filter(list_concat(ue, un), lambda u: contains(q, u))) > 0) AS claims FROM y),
    gated AS (SELECT id, mode, q, a, CASE WHEN pm IS NULL THEN 'MISSING_MODEL_PROFILE'
        WHEN mode IN ('core_paraphrase', 'core_repair') THEN CASE WHEN len(un) > 0 AND NOT (mode = 'core_repair' AND (framed OR {_matches('a', gates.any_of(gates.PROPOSAL))})) THEN 'UNKNOWN_CORE_IDENTIFIER' WHEN len(ue) > 0 THEN 'UNAPPROVED_EXTENSION_IDENTIFIER'
            WHEN len([e for e in ext if contains(low, replace(e, '-', ' '))]) > 0 THEN 'EXTENSION_CONTENT_IN_CORE_MODE' END
        WHEN mode IN ('anchored_extension', 'freeform_extension') THEN CASE WHEN len(un) > 0 AND NOT framed THEN 'UNAPPROVED_EXTENSION_IDENTIFIER' WHEN fam IS NOT NULL AND len([u for u in ue if not list_contains(own_family, u)]) > 0 THEN 'CROSS_FAMILY_EXTENSION_IDENTIFIER'
            WHEN len(ue) + len(un) > 0 AND NOT framed THEN 'EXTENSION_REQUIRES_FRAMING' WHEN len(claims) > 0 THEN 'BASE_MODEL_MISREPRESENTATION'
            WHEN NOT {_matches('low', gates.any_phrase(gates.ANCHORS))} AND len([c for c in core if contains(low, c)]) = 0 THEN 'INSUFFICIENT_CORE_ANCHOR' END
        ELSE 'UNKNOWN_MODE' END AS reason FROM z)"""


@query(f"""WITH {S.PROFILES}, {S.TASKS}, g AS (SELECT response_id AS id, {S.model('r.model_name')} AS m, {S.strip('t.route_mode')} AS mode, t.extension_family AS fam, coalesce(r.answer, '') AS a, coalesce(r.question, '') AS q FROM responses r LEFT JOIN tasks t ON r.task_key = t.task_key),
    {VOCABULARY} SELECT mode AS route_mode, reason, count(*) AS n FROM gated GROUP BY 1, 2""")
def q_gate2(spark: SparkSession, d: str) -> DataFrame:
    return _gated(spark, d).groupBy("route_mode", "reason").agg(F.count(F.lit(1)).alias("n"))


HASHED = f"""hashed AS (SELECT response_id, sha256({S.key("coalesce(question, '')")}) AS q, sha256({S.key("coalesce(question, '')")} || chr(10) || '---' || chr(10) || {S.key("coalesce(answer, '')")}) AS qa FROM responses)"""


@query(f"WITH {HASHED} SELECT response_id, q AS q_hash, qa AS qa_hash FROM hashed")
def q_hashes(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "responses").select("response_id", numbers.q_hash("question").alias("q_hash"), numbers.qa_hash("question", "answer").alias("qa_hash"))


GATE3 = f"""{HASHED}, f AS (SELECT *, first_value(qa) OVER (PARTITION BY q ORDER BY response_id) AS first_qa, row_number() OVER (PARTITION BY q ORDER BY response_id) AS r FROM hashed),
    verdicts AS (SELECT response_id, CASE WHEN r = 1 THEN 'ACCEPTED' WHEN qa = first_qa THEN 'EXACT_QA_DUP' ELSE 'QUESTION_TEMPLATE_DUP' END AS verdict FROM f)"""


@query(f"WITH {GATE3} SELECT response_id, verdict FROM verdicts")
def q_gate3_exact(spark: SparkSession, d: str) -> DataFrame:
    return dedup.gate_duplicates(table(spark, d, "responses"), "response_id").select("response_id", "verdict")


@query(f"""WITH {S.LAST}, hist AS (SELECT sha256({S.key("coalesce(question, '')")}) AS q, min(sha256({S.key("coalesce(question, '')")} || chr(10) || '---' || chr(10) || {S.key("coalesce(answer, '')")})) AS qa FROM last WHERE source = 'accepted_synth' GROUP BY 1), {HASHED},
    f AS (SELECT h.*, hist.qa AS old, first_value(h.qa) OVER (PARTITION BY h.q ORDER BY response_id) AS first_qa, row_number() OVER (PARTITION BY h.q ORDER BY response_id) AS r FROM hashed h LEFT JOIN hist ON h.q = hist.q)
    SELECT response_id, CASE WHEN old IS NULL AND r = 1 THEN 'ACCEPTED' WHEN qa = coalesce(old, first_qa) THEN 'EXACT_QA_DUP' ELSE 'QUESTION_TEMPLATE_DUP' END AS verdict FROM f""")
def q_gate3_history(spark: SparkSession, d: str) -> DataFrame:
    old = views.records(spark, d).filter("source = 'accepted_synth'")
    return dedup.gate_duplicates(table(spark, d, "responses"), "response_id", history=old).select("response_id", "verdict")


NEAR = 0.985


@query(f"""WITH RECURSIVE c AS (SELECT a.vec_id AS earlier, b.vec_id AS later FROM embeddings a, embeddings b WHERE a.vec_id < b.vec_id AND list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) >= {NEAR}),
    o AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) AS r, coalesce(es, []) AS es FROM embeddings LEFT JOIN (SELECT later, list(earlier) AS es FROM c GROUP BY 1) ON later = vec_id),
    s AS (SELECT 0::BIGINT AS r, []::BIGINT[] AS acc UNION ALL SELECT o.r, CASE WHEN list_has_any(acc, es) THEN acc ELSE list_append(acc, vec_id) END FROM s JOIN o ON o.r = s.r + 1),
    f AS (SELECT acc FROM s ORDER BY r DESC LIMIT 1)
    SELECT vec_id, list_contains(acc, vec_id) AS accepted, list_min([x for x in es if list_contains(acc, x)]) AS by FROM o, f""")
def q_gate3_near(spark: SparkSession, d: str) -> DataFrame:
    """Vectors admitted in order unless an admitted earlier one is at least NEAR similar."""
    e = table(spark, d, "embeddings")
    some = e.filter("embedding is not null").select("embedding").first()
    size = len(some[0]) if some else 1
    pairs = greedy.cosine_pairs(e, "vec_id", "embedding", NEAR, size)
    return greedy.admit_in_order(e, pairs, "vec_id")


# Logs, quotas, tranches

EVENTS = """ev AS (SELECT r.response_id, r.tranche, r.model_name, r.seed_id, CASE WHEN j.task_key IS NULL THEN 'accepted' ELSE 'rejected' END AS status, j.reason FROM responses r LEFT JOIN (SELECT task_key, max(reason) AS reason FROM rejected WHERE task_key IS NOT NULL GROUP BY 1) j USING (task_key))"""


def _events(spark: SparkSession, d: str) -> DataFrame:
    j = table(spark, d, "rejected").filter("task_key is not null").groupBy("task_key").agg(F.max("reason").alias("reason")).withColumn("hit", F.lit(True))
    r = table(spark, d, "responses").join(j, "task_key", "left")
    return r.select("response_id", "tranche", "model_name", "seed_id", F.when(F.col("hit"), "rejected").otherwise("accepted").alias("status"), "reason")


@query(f"""WITH {EVENTS} SELECT 'total' AS kind, CAST(NULL AS VARCHAR) AS key, CAST(NULL AS VARCHAR) AS key2, count(*) AS n FROM ev UNION ALL SELECT 'status', status, NULL, count(*) FROM ev GROUP BY 2
    UNION ALL SELECT 'reason', reason, NULL, count(*) FROM ev WHERE reason IS NOT NULL GROUP BY 2 UNION ALL SELECT 'model_name', model_name, NULL, count(*) FROM ev WHERE model_name IS NOT NULL GROUP BY 2
    UNION ALL SELECT 'model_name+status', model_name, status, count(*) FROM ev WHERE model_name IS NOT NULL GROUP BY 2, 3
    UNION ALL SELECT 'model_name+reason', model_name, reason, count(*) FROM ev WHERE model_name IS NOT NULL AND reason IS NOT NULL GROUP BY 2, 3""")
def q_telemetry_summary(spark: SparkSession, d: str) -> DataFrame:
    return telemetry.summary(_events(spark, d), ["status", "reason", "model_name"], [("model_name", "status"), ("model_name", "reason")])


@query(f"""WITH {EVENTS}, a AS (SELECT tranche, count(*) AS total, count(*) FILTER (reason = 'BAD_JSON') AS bad_json, count(*) FILTER (reason IN ('LLM_ERROR', 'NO_RESPONSE')) AS failed,
        count(*) FILTER (reason IN ('QUESTION_TEMPLATE_DUP', 'NEAR_DUP_QUESTION')) AS template_dup, count(*) FILTER (status = 'accepted') AS accepted FROM ev GROUP BY 1)
    SELECT *, CASE WHEN total = 0 THEN 'EMPTY_TRANCHE' WHEN bad_json / total > 0.05 THEN printf('BAD_JSON_RATE=%.2f%%', bad_json / total * 100) WHEN failed / total > 0.05 THEN printf('LLM_ERROR_RATE=%.2f%%', failed / total * 100)
        WHEN template_dup / total > 0.25 THEN printf('TEMPLATE_DUP_RATE=%.2f%%', template_dup / total * 100) WHEN accepted / total < 0.75 THEN printf('ACCEPTANCE_RATE=%.2f%%', accepted / total * 100) END AS stop_reason FROM a""")
def q_stop_condition(spark: SparkSession, d: str) -> DataFrame:
    return telemetry.tranche_stops(_events(spark, d))


@query(f"""WITH {EVENTS} SELECT model_name, count(*) AS events, round(count(*) FILTER (status = 'accepted') / count(*), 6) AS accept_rate, round(count(*) FILTER (status <> 'accepted') / count(*), 6) AS reject_rate,
    round(count(*) FILTER (reason IN {tuple(capacity.DEDUP)}) / count(*), 6) AS dedup_rate, round(count(*) FILTER (reason IN {tuple(capacity.BAD_MODEL)}) / count(*), 6) AS bad_model_rate FROM ev WHERE model_name IS NOT NULL GROUP BY 1""")
def q_telemetry_features(spark: SparkSession, d: str) -> DataFrame:
    x = telemetry.rates(_events(spark, d), "model_name", {"dedup": capacity.DEDUP, "bad_model": capacity.BAD_MODEL})
    return x.select("model_name", "events", *[F.round(c, 6).alias(c) for c in ("accept_rate", "reject_rate", "dedup_rate", "bad_model_rate")])


SMALL = {"per_model": 40, "per_mode": {"core_paraphrase": 0.30, "core_repair": 0.20, "anchored_extension": 0.50}, "per_family": 5, "per_seed_per_mode": 2, "per_seed_per_family": 1}


@query(f"""WITH {S.SEEDS}, hist AS (SELECT coalesce(s.model_name, 'unknown') m, coalesce(s.route_mode, 'unknown') o, coalesce(s.extension_family, 'unknown') f, coalesce(s.seed_id, 'unknown') s FROM responses r JOIN seeds s ON r.seed_id = s.seed_id),
    c AS (SELECT seed_id, coalesce(model_name, 'unknown') m, coalesce(route_mode, 'unknown') o, coalesce(extension_family, 'unknown') f, coalesce(seed_id, 'unknown') s FROM seeds),
    x AS (SELECT c.*, (SELECT count(*) FROM hist h WHERE h.m = c.m) AS a, (SELECT count(*) FROM hist h WHERE h.m = c.m AND h.o = c.o) AS b, (SELECT count(*) FROM hist h WHERE h.f = c.f) AS d, (SELECT count(*) FROM hist h WHERE h.s = c.s AND h.o = c.o) AS e, (SELECT count(*) FROM hist h WHERE h.s = c.s AND h.f = c.f) AS g FROM c)
    SELECT seed_id, CASE WHEN a >= 40 THEN 'MODEL_QUOTA' WHEN b >= (MAP {{'core_paraphrase': 12, 'core_repair': 8, 'anchored_extension': 20}})[o] THEN 'MODE_QUOTA' WHEN f <> 'unknown' AND d >= 5 THEN 'FAMILY_QUOTA' WHEN e >= 2 THEN 'SEED_MODE_QUOTA' WHEN f <> 'unknown' AND g >= 1 THEN 'SEED_FAMILY_QUOTA' END AS refused FROM x""")
def q_quota_admission(spark: SparkSession, d: str) -> DataFrame:
    s = views.seeds(spark, d)
    hist = table(spark, d, "responses").select("seed_id").join(s.select("seed_id", "model_name", "route_mode", "extension_family"), "seed_id")
    return telemetry.admit(s, hist, SMALL).select("seed_id", "refused")


@query(f"WITH {S.TASKS} SELECT route_mode, count(*) AS n FROM tasks WHERE task_key NOT IN (SELECT task_key FROM responses WHERE task_key IS NOT NULL) GROUP BY 1")
def q_resume_antijoin(spark: SparkSession, d: str) -> DataFrame:
    return telemetry.unseen(views.tasks(spark, d), table(spark, d, "responses"), "task_key").groupBy("route_mode").agg(F.count(F.lit(1)).alias("n"))


@query(f"""WITH {S.TASKS}, q AS (SELECT task_key, route_mode, CASE WHEN isnan(priority) THEN NULL ELSE priority END AS p FROM tasks), r AS (SELECT *, row_number() OVER (PARTITION BY route_mode ORDER BY p DESC NULLS LAST, task_key) AS r FROM q)
    SELECT task_key, route_mode FROM r WHERE r <= coalesce((MAP {{'core_repair': 120, 'core_paraphrase': 80}})[route_mode], 9e18) ORDER BY p DESC NULLS LAST, task_key LIMIT 300""")
def q_tranche_pick(spark: SparkSession, d: str) -> DataFrame:
    t = views.tasks(spark, d).select("task_key", "route_mode", F.when(~F.isnan("priority"), F.col("priority")).alias("p"))
    return telemetry.pick_tranche(t, 300, [F.col("p").desc_nulls_last(), F.col("task_key")], "route_mode", {"core_repair": 120, "core_paraphrase": 80}).select("task_key", "route_mode")


@query(f"""WITH {S.TASKS}, c AS (SELECT provider_hint, floor((row_number() OVER (PARTITION BY provider_hint ORDER BY task_key) - 1) / 500)::BIGINT AS chunk FROM tasks) SELECT provider_hint, chunk, count(*) AS n FROM c GROUP BY 1, 2""")
def q_chunk500(spark: SparkSession, d: str) -> DataFrame:
    c = telemetry.chunks(views.tasks(spark, d).select("task_key", "provider_hint"), 500, "provider_hint", [F.col("task_key")])
    return c.groupBy("provider_hint", "chunk").agg(F.count(F.lit(1)).alias("n"))


@query(f"""WITH {S.TASKS}, r AS (SELECT DISTINCT task_key FROM responses) SELECT provider_hint, count(*) AS asked, count(r.task_key) AS collected, round(count(r.task_key) / count(*), 6) AS rate FROM tasks t LEFT JOIN r ON t.task_key = r.task_key GROUP BY 1""")
def q_collection_rate(spark: SparkSession, d: str) -> DataFrame:
    x = telemetry.collection_rate(views.tasks(spark, d).select("task_key", "provider_hint"), table(spark, d, "responses"), "task_key", "provider_hint")
    return x.withColumn("rate", F.round("rate", 6))


@query(f"""WITH {S.TASKS}, {S.SEEDS} SELECT t.task_key, t.route_mode, s.question, s.tier IS NULL AS no_tier FROM tasks t LEFT JOIN seeds s ON t.seed_id = s.seed_id""")
def q_task_seed_join(spark: SparkSession, d: str) -> DataFrame:
    """Tasks with the text of their seed; the task's own columns count."""
    t = views.tasks(spark, d).select("task_key", "seed_id", "route_mode")
    return runner.attach(t, views.seeds(spark, d)).select("task_key", "route_mode", "question", F.col("tier").isNull().alias("no_tier"))


@query(f"""WITH {S.LAST}, l AS (SELECT DISTINCT seed_id, record_id FROM support_entries WHERE record_id IS NOT NULL) SELECT l.seed_id, l.record_id, last.question FROM l LEFT JOIN last USING (record_id)""")
def q_support_lookup(spark: SparkSession, d: str) -> DataFrame:
    """Support entries with the text of their record."""
    l = table(spark, d, "support_entries").filter("record_id is not null").select("seed_id", "record_id").distinct()
    return prompts.support_texts(l, views.records(spark, d), "record_id").select("seed_id", "record_id", F.col("support_question").alias("question"))


# Prompts


def _short(x: str, n: int) -> str:
    t = S.strip(f"coalesce({x}, '')")
    return f"CASE WHEN len({t}) > {n} THEN regexp_replace(left({t}, {n - 1}), '{S.WS}+$', '') || '…' ELSE {t} END"


@query(f"""SELECT DISTINCT seed_id, CASE WHEN seed_q IS NULL AND seed_a IS NULL THEN '' ELSE 'Support question: ' || {_short('seed_q', 60)} || chr(10) || 'Support answer: ' || {_short('seed_a', 90)} END AS block FROM routed_seeds""")
def q_support_block(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "routed_seeds").select("seed_id", prompts.support_block(F.col("seed_q"), F.col("seed_a"), 60, 90).alias("block")).distinct()


@query(r"SELECT response_id, regexp_replace(left('token=' || task_key || ' ' || coalesce(answer, ''), 200), '(?:sk-|key-|token[=:])\S+', '[REDACTED]', 'g') AS safe FROM responses")
def q_redact(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "responses").select("response_id", prompts.redact(F.concat(F.lit("token="), "task_key", F.lit(" "), F.coalesce("answer", F.lit("")))).alias("safe"))


_case = lambda x, values, other: f"CASE {x} " + " ".join(f"WHEN '{k}' THEN {_quote(v)}" for k, v in values.items()) + f" ELSE {other} END"
_bullets = lambda x: f"CASE WHEN len({x}) > 0 THEN array_to_string(['- ' || i for i in {x}], chr(10)) ELSE '- None' END"
_level = "coalesce(nullif(upper(level), ''), 'L3')"
_objective = _case("transform_type", prompts.OBJECTIVES, "'Take `' || transform_type || '` as a guide to the style.'")
_values = {
    "model_name": "coalesce(m, '')", "level": "coalesce(level, '')", "tier": "coalesce(tier, '')", "family": "coalesce(fam, '')", "transform": "coalesce(transform_type, '')",
    "style": _case(_level, prompts.STYLES, f"'Style: ' || {_level} || '. Keep the answer useful for teaching and technically correct.'"), "summary": "''", "core": _bullets("core"), "concepts": _bullets("[replace(i, '-', ' ') for i in ids]"), "identifiers": _bullets("ids"), "cues": "'- None'",
    "objective": f"CASE WHEN coalesce(transform_type, '') = '' THEN '' ELSE 'OBJECTIVE:' || chr(10) || {_objective} || chr(10) || chr(10) END",
    "support": f"CASE WHEN sq IS NULL AND sa IS NULL THEN '' ELSE 'Support question: ' || {_short('sq', 220)} || chr(10) || 'Support answer: ' || {_short('sa', 420)} || chr(10) || chr(10) END", "question": "coalesce(question, '')", "answer": "coalesce(answer, '')",
}
_prompt = "CASE mode " + " ".join(f"WHEN '{m}' THEN " + " || ".join(_quote(t) if kind == "text" else f"({_values[t]})" for kind, t in prompts.layout(m)) for m in prompts.MODES) + " END"


@query(f"""WITH {S.PROFILES}, {S.TASKS}, {S.SEEDS}, x AS (SELECT t.task_key, {S.model('t.model_name')} AS m, t.level, t.tier, {S.strip('t.route_mode')} AS mode, CASE WHEN t.extension_family IN ('family_1', 'family_2', 'family_3') THEN t.extension_family ELSE 'family_1' END AS fam, t.transform_type,
        s.question, s.answer, r.question AS sq, r.answer AS sa FROM tasks t LEFT JOIN seeds s ON t.seed_id = s.seed_id LEFT JOIN last r ON t.support_record_id = r.record_id),
    y AS (SELECT x.*, p.model_name AS pm, list_sort(p.core) AS core, CASE fam WHEN 'family_1' THEN f1 WHEN 'family_2' THEN f2 ELSE f3 END AS ids FROM x LEFT JOIN profiles p ON x.m = p.model_name),
    z AS (SELECT *, CASE WHEN mode IS NULL OR mode NOT IN {prompts.MODES} THEN 'NO_TEMPLATE' WHEN pm IS NULL THEN 'MISSING_MODEL_PROFILE' WHEN mode = 'anchored_extension' AND ids IS NULL THEN 'MISSING_FAMILY' END AS prompt_error FROM y)
    SELECT task_key, CASE WHEN prompt_error IS NULL THEN {_prompt} END AS prompt, prompt_error FROM z""")
def q_prompts(spark: SparkSession, d: str) -> DataFrame:
    """The prompt of every task, with its seed, its support record and the first family of its model where its own is not derived from the records."""
    t = views.tasks(spark, d).withColumns({"model_name": text.model_key("model_name"), "route_mode": text.strip("route_mode"), "extension_family": F.when(F.col("extension_family").isin("family_1", "family_2", "family_3"), F.col("extension_family")).otherwise("family_1")})
    t = t.select("task_key", "seed_id", "model_name", "level", "tier", "route_mode", "extension_family", "transform_type", "support_record_id")
    full = prompts.support_texts(runner.attach(t, views.seeds(spark, d).select("seed_id", "question", "answer")), views.records(spark, d))
    return prompts.prompts(full, views.profiles(spark, d)).select("task_key", "prompt", "prompt_error")


@query("SELECT response_id::VARCHAR AS custom_id, answer AS content FROM responses WHERE response_id % 5 NOT IN (1, 2) AND answer IS NOT NULL")
def q_batch_results(spark: SparkSession, d: str) -> DataFrame:
    """Result lines of a batch service, written and parsed again: lost ids and failed requests drop out."""
    body = F.to_json(F.struct(F.array(F.struct(F.struct(F.col("answer").alias("content")).alias("message"))).alias("choices")))
    line = F.to_json(F.struct(F.when(F.col("response_id") % 5 != 1, F.col("response_id").cast("string")).alias("custom_id"), F.struct(F.when(F.col("response_id") % 5 == 2, 500).otherwise(200).alias("status_code"), body.alias("body")).alias("response")))
    return prompts.results(table(spark, d, "responses").filter("answer is not null").select(line.alias("value")))


# Pipeline and streams


@query(f"""WITH {GATE3}, r AS (SELECT *, CASE WHEN question IS NULL OR {S.strip('question')} = '' THEN 'NO_QUESTION' END AS bad FROM responses)
    SELECT tranche, coalesce(bad, verdict) AS outcome, count(*) AS n FROM r JOIN verdicts USING (response_id) GROUP BY 1, 2""")
def q_pipeline_echo(spark: SparkSession, d: str) -> DataFrame:
    """Responses through an echo generator, the JSON gate and the duplicate gate: outcomes by tranche."""
    r = prompts.echo(table(spark, d, "responses").select("response_id", "tranche", "question", "answer"))
    parsed = r.withColumn("p", gates.parse_reply("reply")).select("response_id", "tranche", F.col("p.question").alias("question"), F.col("p.answer").alias("answer"))
    out = dedup.gate_duplicates(parsed, "response_id").withColumn("outcome", F.when(text.blank_to_null("question").isNull(), "NO_QUESTION").otherwise(F.col("verdict")))
    return out.groupBy("tranche", "outcome").agg(F.count(F.lit(1)).alias("n"))


def _to_run(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    t = views.tasks(spark, d).select("task_key", "seed_id", text.model_key("model_name").alias("model_name"), text.strip("route_mode").alias("route_mode"), "extension_family", "transform_type", "level", F.when(~F.isnan("priority"), F.col("priority")).alias("priority"))
    return t, views.seeds(spark, d).drop("model_name", "route_mode", "extension_family", "level")


@query(f"""WITH {S.PROFILES}, {S.TASKS}, {S.SEEDS}, w AS (SELECT t.task_key AS id, {S.model('t.model_name')} AS m, {S.strip('t.route_mode')} AS mode, t.extension_family AS fam, coalesce(s.answer, '') AS a, coalesce(s.question, '') AS q FROM tasks t LEFT JOIN seeds s ON t.seed_id = s.seed_id),
    e AS (SELECT w.*, CASE WHEN mode IS NULL OR mode NOT IN {prompts.MODES} THEN 'NO_TEMPLATE' WHEN model_name IS NULL THEN 'MISSING_MODEL_PROFILE' WHEN mode = 'anchored_extension' AND (CASE fam WHEN 'family_1' THEN f1 WHEN 'family_2' THEN f2 WHEN 'family_3' THEN f3 END) IS NULL THEN 'MISSING_FAMILY' END AS prompt_error FROM w LEFT JOIN profiles ON m = model_name),
    g AS (SELECT id, m, mode, fam, a, q FROM e WHERE prompt_error IS NULL), {VOCABULARY},
    told AS (SELECT *, CASE WHEN {S.strip('q')} = '' THEN 'BAD_JSON' ELSE reason END AS why, {S.key('q')} AS qk, {S.key('q')} || chr(10) || '---' || chr(10) || {S.key('a')} AS qa FROM gated),
    dup AS (SELECT id, CASE WHEN row_number() OVER w = 1 THEN NULL WHEN qa = first_value(qa) OVER w THEN 'EXACT_QA_DUP' ELSE 'QUESTION_TEMPLATE_DUP' END AS verdict FROM told WHERE why IS NULL WINDOW w AS (PARTITION BY qk ORDER BY id))
    SELECT mode AS route_mode, coalesce(why, verdict, 'ACCEPTED') AS outcome, count(*) AS n FROM told LEFT JOIN dup USING (id) GROUP BY 1, 2 UNION ALL SELECT mode, prompt_error, count(*) FROM e WHERE prompt_error IS NOT NULL GROUP BY 1, 2""")
def q_pipeline_whole(spark: SparkSession, d: str) -> DataFrame:
    """All tasks in one pass through seed, prompt, echo generator and the gates of reply, vocabulary and duplicates: how many end where."""
    t, s = _to_run(spark, d)
    p = durable(views.profiles(spark, d))
    full = durable(prompts.prompts(runner.attach(t, s), p))
    gated = runner.gate(prompts.echo(full.filter("prompt_error is null")), p, routing.ALLOW, None)
    ends = gated.select("route_mode", F.coalesce("reason", F.lit("ACCEPTED")).alias("outcome"))
    ends = ends.unionByName(full.filter("prompt_error is not null").select("route_mode", F.col("prompt_error").alias("outcome")))
    return ends.groupBy("route_mode", "outcome").agg(F.count(F.lit(1)).alias("n"))


@query()
def q_runner_echo(spark: SparkSession, d: str) -> DataFrame:
    """Tranches of planned tasks through the whole loop with an echo generator, until a limit is passed: what each tranche did."""
    t, s = _to_run(spark, d)
    folder = f"{shared_folder(spark)}/runs-{uuid.uuid4().hex}"
    out = runner.run(spark, durable(t), durable(s), durable(views.profiles(spark, d)), prompts.echo, folder, 10_000, 1000, routing.ALLOW)
    return spark.createDataFrame([(r["tranche"], r["total"], r["accepted"], r["stop_reason"]) for r in out], "tranche int, total long, accepted long, stop_reason string")


@query("SELECT tranche, provider, count(*) AS n FROM responses GROUP BY 1, 2")
def q_stream_telemetry(spark: SparkSession, d: str) -> DataFrame:
    """Counts kept by a stream over the responses, as they stand when all there is has been read."""
    from millrace.streaming import logs

    base = f"{shared_folder(spark)}/stream-{uuid.uuid4().hex}"
    schema = table(spark, d, "responses").schema
    logs.run_to_table(logs.count_by(logs.read_stream(spark, f"{d}/responses.parquet*", schema), "tranche", "provider"), f"{base}/out", f"{base}/state")
    return spark.read.parquet(f"{base}/out")


@query(f"SELECT count(DISTINCT sha256({S.key("coalesce(question, '')")})) AS questions FROM responses")
def q_stream_dedup(spark: SparkSession, d: str) -> DataFrame:
    """Distinct questions that a stream lets through."""
    from millrace.streaming import logs

    base = f"{shared_folder(spark)}/stream-{uuid.uuid4().hex}"
    schema = table(spark, d, "responses").schema
    kept = logs.first_questions(logs.read_stream(spark, f"{d}/responses.parquet*", schema).select("response_id", "question"))
    logs.run_to_table(kept, f"{base}/out", f"{base}/state", "append")
    return spark.read.parquet(f"{base}/out").agg(F.count(F.lit(1)).alias("questions"))


# Files, written and read again


def _folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


@query("SELECT response_id, task_key, tranche::INT AS tranche, answer FROM responses WHERE answer IS NOT NULL OR task_key IS NOT NULL")
def q_jsonl(spark: SparkSession, d: str) -> DataFrame:
    """Responses as JSON lines with blank and corrupt lines among them, read back tolerantly."""
    at = _folder(spark, "jsonl")
    r = table(spark, d, "responses").filter("answer is not null or task_key is not null").select("response_id", "task_key", F.col("tranche").cast("int").alias("tranche"), "answer")
    files.write_jsonl(r, at)
    spark.range(40).select(F.when(F.col("id") % 2 == 0, "").otherwise('{"response_id": 1, "answer').alias("value")).write.mode("append").text(at)
    return files.read_jsonl(spark, at, "response_id long, task_key string, tranche int, answer string", tolerant=True)


@query("SELECT 'not json ' || response_id AS text FROM responses WHERE response_id % 7 = 0")
def q_corrupt_lines(spark: SparkSession, d: str) -> DataFrame:
    at = _folder(spark, "corrupt")
    r = table(spark, d, "responses")
    r.select(F.when(F.col("response_id") % 7 == 0, F.concat(F.lit("not json "), F.col("response_id").cast("string"))).otherwise(F.to_json(F.struct("response_id"))).alias("value")).write.text(at)
    return files.corrupt_lines(spark, at).select("text")


@query("SELECT subject AS key, min(title) AS title FROM subjects WHERE subject IS NOT NULL GROUP BY 1")
def q_document(spark: SparkSession, d: str) -> DataFrame:
    """A fixed table as one JSON document and back."""
    at = _folder(spark, "document")
    files.write_document(table(spark, d, "subjects").filter("subject is not null").select("subject", "title"), at, "subject")
    return files.read_document(spark, at, "struct<title:string>").select("key", "value.title")


@query("SELECT coalesce(regexp_replace(regexp_replace(coalesce(reason, 'unknown'), '[^A-Za-z0-9._-]+', '_', 'g'), '^_+|_+$', '', 'g'), '') AS part, count(*) AS n FROM rejected GROUP BY 1")
def q_write_by(spark: SparkSession, d: str) -> DataFrame:
    """One folder of JSON lines per reason, named safely."""
    at = _folder(spark, "by")
    r = table(spark, d, "rejected").select("task_key", "reason")
    files.write_by(r, at, "reason")
    back = spark.read.schema("task_key string, reason string, _part string").option("basePath", at).json(f"{at}/*") if r.limit(1).count() else r.withColumn("_part", F.lit(""))
    return back.groupBy(F.col("_part").alias("part")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT task_key AS line FROM responses WHERE task_key IS NOT NULL")
def q_write_lines(spark: SparkSession, d: str) -> DataFrame:
    at = _folder(spark, "lines")
    files.write_lines(table(spark, d, "responses").filter("task_key is not null"), "task_key", at)
    return spark.read.text(at).select(F.col("value").alias("line"))


@query("SELECT tranche::INT AS tranche, response_id, seed_id FROM responses WHERE tranche BETWEEN 0 AND 999")
def q_tranche_logs(spark: SparkSession, d: str) -> DataFrame:
    """Logs of all tranches, each in its folder, read as one table."""
    at = _folder(spark, "tranches")
    r = table(spark, d, "responses").filter("tranche between 0 and 999").select(F.col("tranche").cast("int").alias("n"), "response_id", "seed_id")
    for n in sorted(x[0] for x in r.select("n").distinct().collect()):  # a fixed number of tranches
        files.write_jsonl(r.filter(F.col("n") == n).drop("n"), f"{files.tranche_folder(at, n)}/log", fresh=True)
    if not files.exists(spark, f"{at}/tranche_*/log"):
        return r.select(F.col("n").alias("tranche"), "response_id", "seed_id")
    return files.all_tranches(spark, at, "log", "response_id long, seed_id string").select("tranche", "response_id", "seed_id")


@query(rf"""SELECT lower(replace(p, ' ', '_')) AS model_name, text FROM (SELECT n_name AS p, 'nation ' || n_nationkey AS text FROM nation)""")
def q_source_files(spark: SparkSession, d: str) -> DataFrame:
    """Source files below a folder, named by their stem: one file for each row of a fixed table."""
    at = _folder(spark, "sources")
    fs = spark.sparkContext._jvm.org.apache.hadoop.fs
    for r in table(spark, d, "nation").filter("n_name is not null and n_nationkey is not null").select("n_name", "n_nationkey").collect():  # 25 rows
        path = fs.Path(f"{at}/{r['n_nationkey'] % 3}/{r['n_name']}.txt")
        out = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(path)
        out.write(bytearray(f"nation {r['n_nationkey']}", "utf-8"))
        out.close()
    if not files.exists(spark, f"{at}/*/*.txt"):
        return spark.createDataFrame([], "model_name string, text string")
    return files.read_sources(spark, at, "*.txt").select("model_name", "text")


# Requests, replies and metadata


@query("SELECT seed_id, coalesce(tier, CASE WHEN p10 IS NULL THEN NULL WHEN p10 >= 0.82 THEN 'A' WHEN p10 >= 0.78 THEN 'B' ELSE 'C' END) AS tier FROM (SELECT {0} AS seed_id, upper({1}) AS tier, class_id FROM routed_seeds) s LEFT JOIN (SELECT class_id, 0.7 + (class_id % 16) / 100.0 AS p10 FROM records WHERE class_id IS NOT NULL GROUP BY class_id) c USING (class_id)".format(S.nz("seed_id"), S.nz("tier")))
def q_class_tier(spark: SparkSession, d: str) -> DataFrame:
    """Seeds with the tier of their class, where they have none of their own."""
    s = table(spark, d, "routed_seeds").select(text.blank_to_null("seed_id").alias("seed_id"), "tier", "class_id")
    name = enrich.first_present(table(spark, d, "records"), ["cluster_id", "class_id", "class"])
    classes = table(spark, d, "records").filter(F.col(name).isNotNull()).groupBy(F.col(name).alias("class_id")).agg(F.lit(None).cast("string").alias("tier"))
    return enrich.with_class_tier(s, classes.withColumn("p10", 0.7 + (F.col("class_id") % 16) / 100.0)).select("seed_id", "tier")


@query("""SELECT task_key AS custom_id, '{"custom_id":"' || task_key || '","method":"POST","url":"/v1/chat/completions","body":{"model":"small","messages":[{"role":"user","content":"' || task_key || '"}],"temperature":0.7,"max_completion_tokens":1024}}' AS request
    FROM (SELECT DISTINCT task_key FROM planned_tasks WHERE task_key IS NOT NULL)""")
def q_requests(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "planned_tasks").filter("task_key is not null").select("task_key", F.col("task_key").alias("prompt")).distinct()
    return prompts.requests(t, "task_key", "small")


@query(rf"""WITH {S.TASKS}, c AS (SELECT task_key AS id, min(answer) AS content FROM responses WHERE task_key IS NOT NULL GROUP BY 1) SELECT task_key, CASE WHEN {S.strip('content')} <> '' THEN content END AS reply, CASE WHEN content IS NULL OR {S.strip('content')} = '' THEN 'NO_RESPONSE' END AS reply_error FROM tasks LEFT JOIN c ON task_key = id""")
def q_join_results(spark: SparkSession, d: str) -> DataFrame:
    """Every task with the answer collected for it."""
    got = table(spark, d, "responses").filter("task_key is not null").groupBy(F.col("task_key").alias("custom_id")).agg(F.min("answer").alias("content"))
    return prompts.join_results(views.tasks(spark, d).select("task_key"), got, "task_key")


def _client(prompt: str) -> str:
    """A generator for the query below: no request ends in 7, and one that ends in 3 is asked in vain."""
    if prompt.endswith("7"):
        raise ValueError("no such model")
    if prompt.endswith("3"):
        raise ValueError("400 bad request")
    return prompt.upper()


@query("""SELECT response_id, CASE WHEN task_key IS NOT NULL AND right(task_key, 1) NOT IN ('3', '7') THEN upper(task_key) END AS reply, CASE WHEN task_key IS NULL THEN 'NO_PROMPT' WHEN right(task_key, 1) = '7' THEN 'no such model' WHEN right(task_key, 1) = '3' THEN '400 bad request' END AS reply_error FROM responses""")
def q_generate(spark: SparkSession, d: str) -> DataFrame:
    """Replies of a client that fails for some; what isn't transient is not asked again."""
    return prompts.generate(table(spark, d, "responses").select("response_id", F.col("task_key").alias("prompt")), _client).select("response_id", "reply", "reply_error")


@query("SELECT response_id, CASE WHEN question IS NOT NULL THEN len(question)::DOUBLE END AS size FROM responses")
def q_embed(spark: SparkSession, d: str) -> DataFrame:
    """Vectors of a client for every question; here of its length."""
    e = prompts.embed(table(spark, d, "responses").select("response_id", "question"), lambda xs: [[float(len(x))] for x in xs])
    return e.select("response_id", F.col("embedding")[0].cast("double").alias("size"))


def _listed(label: str, x: str, n: int) -> str:
    return f"CASE WHEN len({x}) > 0 THEN '{label}' || array_to_string({x}[1:{n}], ', ') END"


@query(f"""WITH {PARSED}, p AS (SELECT doc_id, list_filter([{_listed('breeds ', 'breeds', 4)}, {_listed('procedures such as ', _names('procedures'), 5)}, {_listed('variables like ', _names('variables'), 5)}, {_listed('controls such as ', _names('widgets'), 5)}], lambda x: x IS NOT NULL) AS parts,
        [q.x for q in list_sort(list_distinct([{{'l': lower(i), 'x': i}} for i in {_first('list_concat(widgets, procedures)')}]))] AS merged FROM parsed)
    SELECT doc_id, 'The model m' || doc_id || CASE WHEN len(parts) > 0 THEN ' has ' || array_to_string(parts, '; ') || '.' ELSE ' has no names that can be read from its source.' END AS summary, coalesce(array_to_string(merged, '|'), '') AS merged FROM p""")
def q_fallback_summary(spark: SparkSession, d: str) -> DataFrame:
    """The sentence on a source that has no information of its own, and its widgets and procedures as one list."""
    x = srcparse.core_of(_sources(spark, d), "text")
    name = F.concat(F.lit("m"), F.col("doc_id").cast("string"))
    code = srcparse.strip_comments(srcparse.sections("text")["code"])
    return x.select("doc_id", srcparse.fallback_summary(name).alias("summary"), joined(srcparse.merged_widgets(srcparse.control_names(srcparse.sections("text")["interface"]), srcparse.procedures(code))).alias("merged"))


# Joins and groupings of the general tables


@query("""SELECT r_name, n_name, c_mktsegment, count(*) AS orders, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY GROUPING SETS ((), (r_name), (r_name, n_name), (c_mktsegment))""")
def q_star_rollup(spark: SparkSession, d: str) -> DataFrame:
    t = lambda n: table(spark, d, n)
    x = t("lineitem").join(t("orders"), F.col("l_orderkey") == F.col("o_orderkey")).join(t("customer"), F.col("o_custkey") == F.col("c_custkey")).join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(t("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    cols = ("r_name", "n_name", "c_mktsegment")
    g = x.groupingSets([[], [F.col("r_name")], [F.col("r_name"), F.col("n_name")], [F.col("c_mktsegment")]], *cols)
    return g.agg(F.count(F.lit(1)).alias("orders"), F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"))


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
