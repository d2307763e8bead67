"""The queries of the training-data operators, over their whole tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.text import strip
from millrace.llm import cap, defects, mixing, near, proportions, segments, subjects, tokens, topn
from millrace.llm.components import components
from millrace.llm.shingles import has_text, word_key
from millrace.llm.tasks import category, latest
from millrace.session import durable, shared_folder
from millrace.sources.tables import table

DIMS = ["route_mode", "tier", "provider_hint"]
RATE = 0.1


def _distinct_tasks(spark: SparkSession, d: str) -> DataFrame:
    """One row per task_key, its latest plan; among rows planned at once the one with categories filled in."""
    t = table(spark, d, "planned_tasks").select("task_key", "planned_at", "tier_route_key", *DIMS)
    tier = F.coalesce(F.upper(category("tier")), F.upper(F.nullif(strip(F.split_part("tier_route_key", F.lit("::"), F.lit(1))), F.lit(""))))
    provider = F.replace(category("provider_hint"), F.lit("_"), F.lit("-"))
    t = t.select("task_key", "planned_at", category("route_mode").alias("route_mode"), tier.alias("tier"), provider.alias("provider_hint"))
    return latest(t, "task_key", "planned_at", *[F.col(c) for c in DIMS])


def p1_sample(spark: SparkSession, d: str) -> DataFrame:
    tasks = _distinct_tasks(spark, d).drop("planned_at")
    return proportions.sample_to_targets(tasks, F.col("task_key"), DIMS, table(spark, d, "sample_targets"), RATE)


def p1_report(spark: SparkSession, d: str) -> DataFrame:
    return proportions.target_report(_distinct_tasks(spark, d), DIMS, table(spark, d, "sample_targets"), RATE)


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return topn.top_n(table(spark, d, "support_entries"), "seed_id", "record_id", "score", 12, full_only=True).select("seed_id", "record_id")


def p2_top(spark: SparkSession, d: str) -> DataFrame:
    return topn.top_n(table(spark, d, "support_entries"), "seed_id", "record_id", "score", 12)


CAP = 60


def _capped(spark: SparkSession, d: str, **how) -> DataFrame:
    t = table(spark, d, "planned_tasks").select("task_key", "seed_id", "support_record_id", "class_id", "priority", "planned_at")
    quality = F.when(~F.isnan("priority"), F.col("priority"))
    t = latest(t.withColumn("priority", quality), "task_key", "planned_at", F.col("priority"), F.col("seed_id"), F.col("support_record_id"))
    order = [F.col("priority").desc_nulls_last(), F.col("seed_id").asc_nulls_last(), F.col("task_key").asc()]
    return cap.cap_per_contributor(t, "support_record_id", order=order, cap=CAP, **how)


#: Width of a band of quality, and the bands on either side of 0 at most: what lies beyond shares the outermost band, where it is ranked like the rest.
BAND, BANDS = 0.25, 64


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    band = F.least(F.greatest(F.floor(F.col("priority") / BAND), F.lit(-BANDS)), F.lit(BANDS))
    return _capped(spark, d, stratum=band, weight=F.coalesce(band, F.lit(-BANDS - 1)), best_first=True, over_only=True).select("support_record_id", "task_key")


def p7_by_month(spark: SparkSession, d: str) -> DataFrame:
    """The cap split over the months of planning in proportion to their tasks."""
    month = F.date_format("planned_at", "yyyy-MM")
    return _capped(spark, d, stratum=month).select("support_record_id", "task_key", month.alias("month"), "stratum_slots", "stratum_rank")


NEAR_QUESTION = 0.55


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    """The responses that are not new, by tranche, against records, earlier accepted responses and rejected tasks.

    The index is started from the records; then every tranche probes it and appends what it accepts.
    """
    key = F.when(has_text("question"), word_key(F.col("question"))).alias("key")
    responses = table(spark, d, "responses").select("response_id", "task_key", F.col("tranche").cast("int").alias("tranche"), key)
    rejected = table(spark, d, "rejected").filter("task_key is not null").groupBy("task_key").agg(F.min(F.coalesce(F.col("tranche"), F.lit(2**31 - 1))).alias("first_rejected"))
    known = responses.join(rejected.hint("merge"), "task_key", "left").withColumn("id", F.xxhash64("key"))
    records = table(spark, d, "records").filter(~F.col("source").eqNullSafe("rejected_synth")).select(key).filter("key is not null")
    history = durable(records.withColumn("id", F.xxhash64("key")).dropDuplicates(["id"]))
    # Equal sequences of words are told by their hash; a sequence is accepted by the records or the first tranche that accepts it.
    asked = known.filter("first_rejected is null and key is not null").select("id", F.col("tranche").alias("accepted"))
    same = history.select("id", F.lit(-1).alias("accepted")).unionByName(asked).groupBy("id").agg(F.min("accepted").alias("same_from"))
    x = known.join(same.hint("merge"), "id", "left")
    has_key = F.col("key").isNotNull()
    kind = F.when(F.col("first_rejected") < F.col("tranche"), "retried").when(has_key & (F.col("same_from") < F.col("tranche")), "same")
    base = f"{shared_folder(spark)}/batches-{uuid.uuid4().hex}"
    x = x.select("response_id", "tranche", "id", kind.alias("kind"), F.when(kind.isNull() & has_key & F.col("tranche").isNotNull(), F.col("key")).alias("key"), (F.col("first_rejected").isNull() & (F.col("same_from") == F.col("tranche"))).alias("accepted"))
    x.repartition("tranche", F.pmod("id", F.lit(16))).write.partitionBy("tranche").parquet(f"{base}/tranches")
    x = spark.read.schema("response_id long, id long, kind string, key string, accepted boolean, tranche int").parquet(f"{base}/tranches")

    # The strings of every batch are cut once, each question once in a batch.
    open_ = x.filter("key is not null").groupBy("tranche", "id").agg(F.first("key").alias("key"), F.max("accepted").alias("accepted"))
    segments.strings(open_, ("accepted", "tranche")).repartition("tranche").write.partitionBy("tranche").parquet(f"{base}/strings")
    cut = spark.read.schema("id long, size int, runs array<long>, accepted boolean, tranche int").parquet(f"{base}/strings")

    index = segments.SegmentIndex(spark, f"{base}/index", NEAR_QUESTION)
    index.create(history)
    tranches = sorted(r[0] for r in x.filter("key is not null").select("tranche").distinct().collect())  # a fixed number of batches
    for n in tranches:
        own = x.filter((F.col("tranche") == n) & F.col("key").isNotNull())
        batch = cut.filter(F.col("tranche") == n).drop("tranche")
        near_ids = index.near_strings(batch).select("id").distinct()
        own.select("response_id", "id").join(near_ids.hint("merge"), "id", "left_semi").select("response_id").write.mode("append").parquet(f"{base}/near")
        if n != tranches[-1]:
            index.append_strings(batch.filter("accepted"))
    index.close(delete=True)
    found = spark.read.schema("response_id long").parquet(f"{base}/near") if tranches else x.limit(0).select("response_id")
    return x.filter("kind is not null").select("response_id", "kind").unionByName(found.withColumn("kind", F.lit("near")))


def _defects(spark: SparkSession, d: str) -> DataFrame:
    return defects.find_defects(table(spark, d, "responses"), "response_id", "question", "answer")


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return _defects(spark, d)


def p5_reasons(spark: SparkSession, d: str) -> DataFrame:
    """(defect, reason, responses): what the log of rejections says of each kind of defect, and of sound responses."""
    reasons = table(spark, d, "rejected").filter("task_key is not null").groupBy("task_key").agg(F.max("reason").alias("reason"))
    r = table(spark, d, "responses").select("response_id", "task_key")
    x = r.join(_defects(spark, d), "response_id", "left").join(reasons.withColumn("logged", F.lit(True)), "task_key", "left")
    reason = F.when(F.col("logged"), F.coalesce(F.upper(strip("reason")), F.lit("none given"))).otherwise("not logged")
    return x.groupBy(F.coalesce("defect", F.lit("sound")).alias("defect"), reason.alias("reason")).agg(F.count(F.lit(1)).alias("responses"))


ALIKE = 0.5
#: Groups of more copies than this are shown by their first record (see near.record_pairs; None is the exact way). The SQL has the same rule.
EXPAND = 100


def _similar(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """(class pairs, members): members has one row per record and class, with the class' size and first record."""
    r = table(spark, d, "records").filter(has_text("question") & has_text("answer") & F.col("record_id").isNotNull())
    r = r.select("record_id", F.concat_ws(" ", "question", "answer").alias("text"))
    pairs = durable(near.similar_classes(r.select("text"), ALIKE, rows=table(spark, d, "records").count()))
    own = near.class_ids(r, "record_id", "text").distinct()
    sizes = own.groupBy("id").agg(F.count(F.lit(1)).alias("copies"), F.min("record_id").alias("first"))
    return pairs, own.join(sizes, "id")


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    pairs, members = _similar(spark, d)
    involved = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    members = durable(members.join(involved.withColumn("linked", F.lit(True)), "id", "left").filter("linked or copies > 1"))
    return near.record_pairs(pairs, members, EXPAND)


def p6_groups(spark: SparkSession, d: str) -> DataFrame:
    """(record_id, group_id, copy_of, copies, links): each record with its group, the first record of its text, the copies of it and its links to other texts."""
    pairs, members = _similar(spark, d)
    groups = components(pairs)
    links = pairs.select(F.explode(F.array("a", "b")).alias("id")).groupBy("id").agg(F.count(F.lit(1)).alias("links"))
    x = members.join(groups.withColumnRenamed("node", "id"), "id", "left").join(links, "id", "left")
    x = x.withColumn("component", F.coalesce("component", "id"))
    names = x.groupBy("component").agg(F.min("record_id").alias("group_id"))
    return x.join(names, "component").select("record_id", "group_id", F.col("first").alias("copy_of"), "copies", F.coalesce("links", F.lit(0)).alias("links"))


def p8_ids(spark: SparkSession, d: str) -> DataFrame:
    return tokens.encode(table(spark, d, "documents"), "doc_id", "text")


def _mixed(spark: SparkSession, d: str) -> tuple[DataFrame, list[dict]]:
    # Sizes are made once and kept, since the plan, the copies and the report read them.
    sized = durable(tokens.count_tokens(table(spark, d, "documents"), ["doc_id", "source"], "text"))
    plan = mixing.plan_mix(sized, table(spark, d, "source_targets"), "source", "tokens")
    return mixing.mix_sources(sized, plan, "source", F.col("doc_id"), "tokens"), plan


def p9_mix(spark: SparkSession, d: str) -> DataFrame:
    return _mixed(spark, d)[0]


def p9_report(spark: SparkSession, d: str) -> DataFrame:
    return mixing.mix_report(*_mixed(spark, d), "source", "tokens")


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    names = sorted(r[0] for r in table(spark, d, "subjects").select("subject").distinct().collect() if r[0])  # a fixed list
    return subjects.subjects_of(table(spark, d, "documents"), table(spark, d, "subject_labels"), names)


def p10_composition(spark: SparkSession, d: str) -> DataFrame:
    """(subject, source, documents): how many documents of each source deal with each subject, `none` included."""
    docs = table(spark, d, "documents").select("doc_id", "source")
    x = docs.join(p10_found(spark, d), "doc_id", "left")
    return x.groupBy(F.coalesce("subject", F.lit("none")).alias("subject"), "source").agg(F.count(F.lit(1)).alias("documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (p1_sample, p1_report, p2_found, p2_top, p4_found, p5_found, p5_reasons, p6_found, p6_groups, p7_found, p7_by_month, p8_ids, p9_mix, p9_report, p10_found, p10_composition)}


_words = lambda x: f"regexp_extract_all(lower({x}), '[\\p{{L}}\\p{{N}}]+')"
_runs = lambda w: f"list_distinct([{w}[i] || ' ' || {w}[i + 1] || ' ' || {w}[i + 2] for i in range(1, len({w}) - 1)])"
_blank = lambda x: f"coalesce(regexp_matches({x}, '[^\\s\\x0b\\x1c-\\x1f\\x85\\x{{a0}}\\x{{1680}}\\x{{2000}}-\\x{{200a}}\\x{{2028}}\\x{{2029}}\\x{{202f}}\\x{{205f}}\\x{{3000}}]'), false)"


def oracle_sql() -> dict[str, str]:
    return {
        "p4_found": f"""
            WITH rej AS (SELECT task_key, min(coalesce(tranche, 2147483647)) AS first FROM rejected WHERE task_key IS NOT NULL GROUP BY 1),
            r AS (SELECT response_id, tranche, first, CASE WHEN {_blank('question')} THEN {_words('question')} END AS w FROM responses LEFT JOIN rej USING (task_key)),
            acc AS (SELECT w, min(t) AS t FROM (SELECT {_words('question')} AS w, -1 AS t FROM records WHERE source IS DISTINCT FROM 'rejected_synth' AND {_blank('question')}
                UNION ALL SELECT w, tranche FROM r WHERE first IS NULL AND w IS NOT NULL) GROUP BY 1),
            a AS (SELECT w, t, len(s) AS n, unnest(s) AS s FROM (SELECT w, t, {_runs('w')} AS s FROM acc)), b AS (SELECT response_id, tranche, w, len(s) AS n, unnest(s) AS s FROM (SELECT response_id, tranche, w, {_runs('w')} AS s FROM r WHERE w IS NOT NULL)),
            p AS (SELECT b.response_id, count(*) AS c, any_value(a.n) AS na, any_value(b.n) AS nb FROM a JOIN b ON a.s = b.s AND a.t < b.tranche AND a.w <> b.w GROUP BY b.response_id, a.w),
            near AS (SELECT DISTINCT response_id FROM p WHERE 100 * c >= 55 * (na + nb - c)),
            k AS (SELECT r.response_id, CASE WHEN first < r.tranche THEN 'retried' WHEN acc.t < r.tranche THEN 'same' WHEN near.response_id IS NOT NULL THEN 'near' END AS kind
                FROM r LEFT JOIN acc ON r.w = acc.w LEFT JOIN near ON r.response_id = near.response_id)
            SELECT response_id, kind FROM k WHERE kind IS NOT NULL""",
        "p6_found": f"""
            WITH d AS (SELECT DISTINCT record_id, {_words("question || ' ' || answer")} AS w FROM records WHERE record_id IS NOT NULL AND {_blank('question')} AND {_blank('answer')}),
            c AS (SELECT w, count(*) AS copies, min(record_id) AS first, row_number() OVER (ORDER BY w) AS k FROM d WHERE len(w) >= 3 GROUP BY w),
            m AS (SELECT record_id, k, copies, first FROM d JOIN c USING (w)),
            s AS (SELECT k, len(s) AS n, unnest(s) AS s FROM (SELECT k, {_runs('w')} AS s FROM c)),
            p AS (SELECT a.k AS ka, b.k AS kb FROM s a JOIN s b ON a.s = b.s AND a.k < b.k GROUP BY 1, 2 HAVING 2 * count(*) >= any_value(a.n) + any_value(b.n) - count(*)),
            shown AS (SELECT * FROM m WHERE copies <= {EXPAND} OR record_id = first),
            r AS (SELECT a.record_id AS ra, b.record_id AS rb FROM p JOIN shown a ON a.k = ka JOIN shown b ON b.k = kb
                UNION SELECT a.record_id, b.record_id FROM m a JOIN m b ON a.k = b.k AND a.record_id < b.record_id WHERE a.copies <= {EXPAND} OR a.record_id = a.first)
            SELECT DISTINCT least(ra, rb) AS record_a, greatest(ra, rb) AS record_b FROM r WHERE ra <> rb""",
        "p6_groups": f"""
            WITH RECURSIVE d AS (SELECT DISTINCT record_id, {_words("question || ' ' || answer")} AS w FROM records WHERE record_id IS NOT NULL AND {_blank('question')} AND {_blank('answer')}),
            c AS (SELECT w, count(*) AS copies, min(record_id) AS first, row_number() OVER (ORDER BY w) AS k FROM d WHERE len(w) >= 3 GROUP BY w),
            s AS (SELECT k, len(s) AS n, unnest(s) AS s FROM (SELECT k, {_runs('w')} AS s FROM c)),
            p AS (SELECT a.k AS a, b.k AS b FROM s a JOIN s b ON a.s = b.s AND a.k < b.k GROUP BY 1, 2 HAVING 2 * count(*) >= any_value(a.n) + any_value(b.n) - count(*)),
            e AS (SELECT a, b FROM p UNION ALL SELECT b, a FROM p),
            reach AS (SELECT k AS u, k AS v FROM c UNION SELECT r.u, e.b FROM reach r JOIN e ON r.v = e.a),
            g AS (SELECT u AS k, min(first) AS group_id FROM reach JOIN c ON reach.v = c.k GROUP BY 1),
            l AS (SELECT a AS k, count(*) AS links FROM e GROUP BY 1)
            SELECT d.record_id, g.group_id, c.first AS copy_of, c.copies, coalesce(links, 0) AS links FROM d JOIN c USING (w) JOIN g ON c.k = g.k LEFT JOIN l ON c.k = l.k""",
        "p2_found": """
            WITH b AS (SELECT seed_id, record_id, max(score) s FROM support_entries WHERE score IS NOT NULL AND record_id IS NOT NULL GROUP BY 1, 2),
            r AS (SELECT *, row_number() OVER (PARTITION BY seed_id ORDER BY s DESC, record_id) k, count(*) OVER (PARTITION BY seed_id) n FROM b)
            SELECT seed_id, record_id FROM r WHERE n > 12 AND k <= 12""",
        "p2_top": """
            WITH b AS (SELECT seed_id, record_id, max(score) score FROM support_entries WHERE score IS NOT NULL AND record_id IS NOT NULL GROUP BY 1, 2)
            SELECT seed_id, record_id, score, CAST(row_number() OVER (PARTITION BY seed_id ORDER BY score DESC, record_id) AS INT) AS rank FROM b
            QUALIFY row_number() OVER (PARTITION BY seed_id ORDER BY score DESC, record_id) <= 12""",
        "p7_found": """
            WITH t AS (SELECT *, CASE WHEN isnan(priority) THEN NULL ELSE priority END q FROM planned_tasks WHERE task_key IS NOT NULL),
            l AS (SELECT * FROM t QUALIFY row_number() OVER (PARTITION BY task_key ORDER BY planned_at DESC NULLS LAST, q DESC NULLS LAST, seed_id DESC NULLS LAST, support_record_id DESC NULLS LAST) = 1),
            r AS (SELECT support_record_id, task_key, row_number() OVER (PARTITION BY support_record_id ORDER BY q DESC NULLS LAST, seed_id ASC NULLS LAST, task_key) k, count(*) OVER (PARTITION BY support_record_id) n
                  FROM l WHERE support_record_id IS NOT NULL)
            SELECT support_record_id, task_key FROM r WHERE n > 60 AND k <= 60""",
        # Whole numbers only: 60 slots by the months' tasks, the rest to the largest remainders, equal ones by month.
        "p7_by_month": """
            WITH t AS (SELECT *, CASE WHEN isnan(priority) THEN NULL ELSE priority END q FROM planned_tasks WHERE task_key IS NOT NULL),
            l AS (SELECT *, strftime(planned_at, '%Y-%m') AS month FROM t QUALIFY row_number() OVER (PARTITION BY task_key ORDER BY planned_at DESC NULLS LAST, q DESC NULLS LAST, seed_id DESC NULLS LAST, support_record_id DESC NULLS LAST) = 1),
            c AS (SELECT support_record_id, month, count(*) AS n FROM l WHERE support_record_id IS NOT NULL GROUP BY 1, 2),
            o AS (SELECT *, sum(n) OVER (PARTITION BY support_record_id) AS total FROM c QUALIFY total > 60),
            f AS (SELECT *, 60 * n // total AS low, row_number() OVER (PARTITION BY support_record_id ORDER BY (60 * n) % total DESC, month ASC NULLS FIRST) AS place, 60 - sum(60 * n // total) OVER (PARTITION BY support_record_id) AS spare FROM o),
            s AS (SELECT support_record_id, month, (low + CASE WHEN place <= spare THEN 1 ELSE 0 END)::BIGINT AS slots FROM f),
            r AS (SELECT support_record_id, month, task_key, row_number() OVER (PARTITION BY support_record_id, month ORDER BY q DESC NULLS LAST, seed_id ASC NULLS LAST, task_key) AS k FROM l)
            SELECT r.support_record_id, r.task_key, r.month, s.slots AS stratum_slots, r.k::INT AS stratum_rank FROM r JOIN s ON r.support_record_id = s.support_record_id AND r.month IS NOT DISTINCT FROM s.month WHERE r.k <= s.slots
            UNION ALL SELECT support_record_id, task_key, month, NULL, NULL FROM l WHERE support_record_id IS NULL OR support_record_id NOT IN (SELECT support_record_id FROM o)""",
    }
