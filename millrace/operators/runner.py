"""Tranche by tranche: pick, prompt, generate, gate, log; stop when a limit is passed, and resume where the logs end."""

from __future__ import annotations

import json
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.text import blank_to_null
from millrace.operators import dedup, gates, greedy, prompts, telemetry
from millrace.session import durable
from millrace.sources import files

LOG = "task_key string, seed_id string, model_name string, route_mode string, question string, answer string, reason string"


def attach(tasks: DataFrame, seeds: DataFrame) -> DataFrame:
    """Tasks with their seed's columns; where both have a column the task's value counts. A missing seed leaves nulls."""
    own = [c for c in seeds.columns if c not in tasks.columns]
    return tasks.join(seeds.select("seed_id", *[c for c in own if c != "seed_id"]), "seed_id", "left")


def gate(replied: DataFrame, profiles: DataFrame, allow: list[str], history: DataFrame | None, order: str = "task_key", nearest: Callable[[DataFrame], DataFrame] | None = None, conflicts: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Rows with question and answer of the reply and `reason`, the first gate that fails, null if accepted.

    In this order: the reply, where given the class that its question's vector is nearest to, the vocabulary,
    duplicates, and where given near duplicates. nearest gives (order, reason) of the rows it gets, as
    nearest_class does; conflicts gives (earlier, later) pairs of rows too much alike, as cosine_pairs does, of
    which a later one is NEAR_DUP_QUESTION if an earlier one is accepted.
    """
    names = [c for c in replied.columns if c not in ("question", "answer", "reply", "reply_error", "prompt", "prompt_error", "reason")]
    x = replied.withColumn("_p", gates.parse_reply("reply")).select(*names, F.col("_p.question").alias("question"), F.col("_p.answer").alias("answer"), F.col("_p.error").alias("_bad"))
    bad = F.when(F.col("_bad") == "NO_RESPONSE", "NO_RESPONSE").when(F.col("_bad") == "skip", "MODEL_SKIP").when(F.col("_bad").isNotNull(), "BAD_JSON").when(blank_to_null("question").isNull(), "BAD_JSON")
    x = x.withColumn("_bad", bad)
    if nearest is not None:
        x = durable(x)
        far = nearest(x.filter("_bad is null")).select(F.col(order).alias("_k"), F.col("reason").alias("_far"))
        x = x.join(far, F.col(order) == F.col("_k"), "left").withColumn("_bad", F.coalesce("_bad", "_far")).drop("_k", "_far")
    checked = durable(gates.validate_vocabulary(x, profiles, allow).withColumn("reason", F.coalesce("_bad", "reason")).drop("_bad"))
    sound = dedup.gate_duplicates(checked.filter("reason is null"), order, history=history)
    sound = sound.withColumn("reason", F.when(F.col("verdict") != "ACCEPTED", F.col("verdict"))).drop("verdict")
    if conflicts is not None:
        sound = durable(sound)
        fresh = sound.filter("reason is null")
        late = greedy.admit_in_order(fresh, conflicts(fresh), order).filter("not accepted").select(F.col(order).alias("_k"))
        sound = sound.join(late, F.col(order) == F.col("_k"), "left").withColumn("reason", F.coalesce("reason", F.when(F.col("_k").isNotNull(), "NEAR_DUP_QUESTION"))).drop("_k")
    return checked.filter("reason is not null").unionByName(sound)


def by_provider(generators: dict[str, Callable[[DataFrame], DataFrame]]) -> Callable[[DataFrame], DataFrame]:
    """A generator that hands every row to that of its provider_hint; rows of other providers, null among them, go without a reply."""

    def generate(df: DataFrame) -> DataFrame:
        parts = [g(df.filter(F.col("provider_hint") == name)) for name, g in generators.items()]
        parts.append(df.filter(~F.coalesce(F.col("provider_hint").isin(list(generators)), F.lit(False))).withColumn("reply", F.lit(None).cast("string")))
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p, allowMissingColumns=True)
        return out

    return generate


def _logs(spark: SparkSession, folder: str, kind: str) -> DataFrame:
    """What was logged so far; only where no such log exists is it empty, any other failure to read is raised."""
    if not files.exists(spark, f"{folder}/tranche_*/{kind}"):
        return spark.createDataFrame([], LOG + ", tranche int")
    return files.all_tranches(spark, folder, kind, LOG)


def run(spark: SparkSession, tasks: DataFrame, seeds: DataFrame, profiles: DataFrame, generate: Callable[[DataFrame], DataFrame] | dict[str, Callable[[DataFrame], DataFrame]], folder: str, target: int, size: int, allow: list[str] = (), max_tranches: int | None = None, nearest: Callable[[DataFrame], DataFrame] | None = None, conflicts: Callable[[DataFrame], DataFrame] | None = None) -> list[dict]:
    """Runs tranches until `target` rows are accepted, no task is left, or a tranche's rates pass a limit; returns their summaries.

    generate adds `reply` to the rows it gets; a dict has one for each provider_hint. nearest and conflicts: see
    gate. Everything a tranche did is written before the next begins: the accepted and rejected rows, an event
    of each, what was asked of whom and how long it took, and the summary. A later call goes on with the tasks
    that no log has. A tranche has at most twice the tasks still wanted.
    """
    generate = by_provider(generate) if isinstance(generate, dict) else generate
    out: list[dict] = []
    accepted, rejected = _logs(spark, folder, "accepted"), _logs(spark, folder, "rejected")
    number = max([r[0] + 1 for x in (accepted, rejected) for r in x.select("tranche").distinct().collect()], default=0)
    have = accepted.count()
    while have < target and (max_tranches is None or len(out) < max_tranches):
        done = accepted.select("task_key").unionByName(rejected.select("task_key"))
        left = telemetry.unseen(tasks, done, "task_key")
        picked = durable(telemetry.pick_tranche(left, min(size, 2 * (target - have)), [F.col("priority").desc_nulls_last(), F.col("task_key")]))
        if not picked.limit(1).count():
            break
        began = time.time()
        full = prompts.prompts(attach(picked, seeds), profiles)
        replied = durable(generate(full))
        gated = durable(gate(replied, profiles, list(allow), accepted if have else None, nearest=nearest, conflicts=conflicts))
        cols = [c.split(" ")[0] for c in LOG.split(", ")]
        base = files.tranche_folder(folder, number)
        for kind, cond in (("accepted", "reason is null"), ("rejected", "reason is not null")):
            files.write_jsonl(gated.filter(cond).select(*cols), f"{base}/{kind}", fresh=True)
        status = F.when(F.col("reason").isNull(), "accepted").otherwise("rejected").alias("status")
        events = gated.select(F.lit(number).alias("tranche"), "task_key", "seed_id", "model_name", "route_mode", status, "reason")
        files.write_jsonl(events, f"{base}/telemetry", fresh=True)
        who = F.col("provider_hint") if "provider_hint" in replied.columns else F.lit(None).cast("string")
        asked = replied.groupBy(F.coalesce(who, F.lit("unknown")).alias("provider")).agg(F.count(F.lit(1)).alias("requests"), F.count("reply").alias("replies"))  # one row per provider
        meta = {"tranche": number, "began": began, "seconds": round(time.time() - began, 3), "providers": {r["provider"]: {"requests": r["requests"], "replies": r["replies"]} for r in asked.collect()}}
        summary = telemetry.tranche_stops(events).first().asDict()
        for name, content in (("batch_meta", meta), ("summary", summary)):
            spark.createDataFrame([(json.dumps(content),)], "value string").coalesce(1).write.mode("overwrite").text(f"{base}/{name}")
        out.append(summary)
        accepted, rejected = _logs(spark, folder, "accepted"), _logs(spark, folder, "rejected")
        have += summary["accepted"]
        number += 1
        if summary["stop_reason"]:
            break
    return out
