"""Pieces of SQL that the oracles share; each mirrors a column expression."""

from __future__ import annotations

from millrace.functions.lexical import IDENTIFIER, STOPWORDS

WS = r"[\s\x0b\x1c-\x1f\x85\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')"


def squeeze(x: str) -> str:
    return f"regexp_replace({strip(x)}, '{WS}+', ' ', 'g')"


def key(x: str) -> str:
    return f"lower({squeeze(x)})"


def nz(x: str) -> str:
    return f"nullif({strip(x)}, '')"


def model(x: str) -> str:
    return f"nullif(replace(lower({strip(x)}), ' ', '_'), '')"


def words(xs) -> str:
    return "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in xs) + "]"


def spans(x: str) -> str:
    return f"regexp_extract_all(coalesce({x}, ''), '`([^`]+)`', 1)"


def tokens(x: str) -> str:
    return f"[lower(t) for t in regexp_extract_all(coalesce({x}, ''), '{IDENTIFIER}', 1) if not list_contains({words(STOPWORDS)}, lower(t))]"


def term_list(x: str) -> str:
    return f"list_concat([{key('t')} for t in {spans(x)}], {tokens(x)})"


def ticked(x: str) -> str:
    return rf"[lower(t) for t in [{strip('s')} for s in regexp_extract_all(regexp_replace(coalesce({x}, ''), '```[\s\S]*?```', '', 'g'), '`([^`]+)`', 1)] if regexp_matches(t, '^[A-Za-z_][A-Za-z0-9_\-]*\??$')]"


def joined(x: str) -> str:
    return f"array_to_string({x}, '|')"


def sha1_mod(x: str, m: int) -> str:
    out = "0"
    for k in range(5):
        out = f"(({out}) * {2**32 % m} + ('0x' || substr(sha1({x}), {8 * k + 1}, 8))::BIGINT) % {m}"
    return out


NORMAL = f"""normal AS (SELECT {nz('record_id')} AS record_id, {nz('source')} AS source, coalesce({nz('source_id')}, {nz('global_id')}, '') AS source_id,
    coalesce({model('model_name')}, {model("regexp_extract(list_filter(tags, lambda t: regexp_matches(t, '(?is)^model:(.+)$'))[1], '(?is)^model:(.+)$', 1)")}) AS model_name,
    {nz('question')} AS question, {nz('answer')} AS answer, {nz('seed_id')} AS seed_id, class_id,
    coalesce({nz('level')}, nullif({squeeze("regexp_extract(list_filter(tags, lambda t: regexp_matches(t, '(?is)^level:(.+)$'))[1], '(?is)^level:(.+)$', 1)")}, '')) AS level,
    upper({nz('tier')}) AS tier, {nz('global_id')} AS global_id, ingested_at FROM records)"""

LAST = f"""{NORMAL}, last AS (SELECT * FROM normal WHERE record_id IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY record_id ORDER BY ingested_at DESC NULLS LAST, source DESC NULLS LAST, source_id DESC NULLS LAST, model_name DESC NULLS LAST, question DESC NULLS LAST, answer DESC NULLS LAST, seed_id DESC NULLS LAST, class_id DESC NULLS LAST, level DESC NULLS LAST, tier DESC NULLS LAST, global_id DESC NULLS LAST) = 1)"""

COUNTS = f"""{LAST}, counts AS (SELECT model_name, unnest(list_distinct(list_concat({ticked('question')}, {ticked('answer')}))) AS term FROM last WHERE model_name IS NOT NULL),
    identifiers AS (SELECT model_name, term, count(*) AS n FROM counts GROUP BY 1, 2)"""

PROFILES = f"""{COUNTS}, leads AS (SELECT *, row_number() OVER (PARTITION BY model_name ORDER BY n DESC, term) AS r FROM identifiers),
    profiles AS (SELECT model_name, list(term ORDER BY r) FILTER (r <= 20) AS core, list(term ORDER BY r) FILTER (r BETWEEN 21 AND 25) AS f1, list(term ORDER BY r) FILTER (r BETWEEN 26 AND 30) AS f2,
        list(term ORDER BY r) FILTER (r BETWEEN 31 AND 35) AS f3 FROM leads WHERE r <= 35 GROUP BY 1)"""

SEEDS = f"""seeds AS (SELECT {nz('seed_id')} AS seed_id, {model('model_name')} AS model_name, class_id, {nz('level')} AS level, upper({nz('tier')}) AS tier, route_mode, {nz('extension_family')} AS extension_family,
    coalesce({nz('seed_q')}, {nz('question')}) AS question, coalesce({nz('seed_a')}, {nz('answer')}) AS answer FROM routed_seeds WHERE {nz('seed_id')} IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY {nz('seed_id')} ORDER BY route_mode DESC NULLS LAST, extension_family DESC NULLS LAST, model_name DESC NULLS LAST, class_id DESC NULLS LAST, level DESC NULLS LAST, tier DESC NULLS LAST, question DESC NULLS LAST, answer DESC NULLS LAST) = 1)"""

TASKS = """tasks AS (SELECT * FROM planned_tasks WHERE task_key IS NOT NULL QUALIFY row_number() OVER (PARTITION BY task_key ORDER BY planned_at DESC NULLS LAST, CASE WHEN isnan(priority) THEN NULL ELSE priority END DESC NULLS LAST,
    seed_id DESC NULLS LAST, route_mode DESC NULLS LAST, provider_hint DESC NULLS LAST, tier DESC NULLS LAST, model_name DESC NULLS LAST, level DESC NULLS LAST, transform_type DESC NULLS LAST, extension_family DESC NULLS LAST, support_record_id DESC NULLS LAST) = 1)"""
