"""Prompt texts and requests, assembled from columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import as_col, evaluated, strip


def shorten(x: Column | str, n: int) -> Column:
    """Stripped; beyond n characters cut to n - 1, stripped at the end, with an ellipsis."""
    t = strip(F.coalesce(as_col(x), F.lit("")))
    cut = F.regexp_replace(F.substring(t, 1, n - 1), r"(?U)\s+$", "")
    return F.when(F.length(t) > n, F.concat(cut, F.lit("…"))).otherwise(t)


def bullets(xs: Column) -> Column:
    return F.when(F.size(xs) > 0, F.array_join(F.transform(xs, lambda x: F.concat(F.lit("- "), x)), "\n")).otherwise("- None")


def support_block(question: Column, answer: Column, q_chars: int = 220, a_chars: int = 420) -> Column:
    """The support pair in a fixed layout; empty where both are null."""
    text = F.concat(F.lit("Support question: "), shorten(question, q_chars), F.lit("\nSupport answer: "), shorten(answer, a_chars))
    return F.when(question.isNull() & answer.isNull(), "").otherwise(text)


def redact(x: Column | str) -> Column:
    """The first 200 characters with keys and tokens blacked out."""
    return F.regexp_replace(F.substring(as_col(x), 1, 200), r"(?:sk-|key-|token[=:])\S+", "[REDACTED]")


# The form of the reply, and the modes that have a template.
PAIR = '{"question": "...", "answer": "..."}'
SKIP = '{"skip":"SEED_CONFLICT"}'
MODES = ("core_paraphrase", "core_repair", "anchored_extension")
#: What a transform asks for. Others are named as they are.
OBJECTIVES = {
    "lexical_paraphrase": "Say the same in other words and other sentences; the meaning stays where it is.",
    "syntactic_reframe": "Ask and answer from another angle, in another build of sentences, on the same technical content.",
    "mechanism_focus_shift": "Put the mechanism, what causes what, in front; model and target stay the same.",
    "measurement_reframe": "Put in front what is to be measured or tracked; the mechanism below it stays.",
    "experiment_design_reframe": "Make the answer an experiment on this model, with what it is expected to show.",
    "limitation_reframe": "Make a limit or caveat of the answer plain, without leaving the topic.",
    "unsupported_identifier_repair": "Put the nearest names and mechanisms of the source in the place of those that it does not have.",
    "mechanism_grounding_repair": "Explain by what the base model does where the seed tells of mechanisms it has not; the question's intent stays.",
    "core_operationalization_repair": "Tell more plainly how the source carries it out, and leave out what it does not support.",
    "extension_reframing": "Tell the extension's idea again as one whole, and say that its names are additions and not source code.",
    "extension_operationalization": "Tell how the extension would be built in, what is added and what it changes.",
    "extension_compare_baseline": "Hold the original model against the extended one, and say what belongs to which.",
    "extension_experiment_design": "Tell how to test the extension, with one experiment against the original model.",
    "extension_limitation_analysis": "Put the extension's limits, assumptions or calibration in front, and say that it is proposed.",
}
STYLES = {
    "L3": "Style: L3, coaching in science. Have exactly one hypothesis, exactly one experiment and exactly one limitation.",
    "L2": "Style: L2, a clear technical explanation. Have one main cause, one concrete test or example and one caveat.",
}
_RULES = {
    "core_paraphrase": ["Use only what the original model has.", "Do not make up identifiers beyond the core listed below.", "Identifiers of the model stay in back-ticks, unchanged."],
    "core_repair": ["Use only what the original model has.", "Replace identifiers and mechanisms that it does not have by the nearest right ones of the core.", "Do not make up identifiers beyond the core listed below.", "Identifiers of the model stay in back-ticks, unchanged."],
    "anchored_extension": ["Tell the original model and what is proposed apart.", "Identifiers of an extension may stand in back-ticks only if the family below lists them.", "Do not write of them as if they were in the source.", "Stay anchored to the original model."],
}
_TASK = {
    "core_paraphrase": "Write a new natural variant of the seed that is true to the original model. Do not add extensions, layers or mechanisms.",
    "core_repair": f"Rewrite the seed into the nearest pair that is right for the original model. Keep no unsupported detail. If there is no right answer within the core, reply {SKIP}.",
    "anchored_extension": "Write a natural variant of the seed that is anchored to the original model and may use the family above. Frame every new state, variable, link or metric as an addition.",
}


def layout(mode: str) -> list[tuple[str, str]]:
    """The template of a mode: pieces of text, and names of values to be put in between. Both the columns and the SQL are made of it."""
    reply = f"{PAIR} or {SKIP}" if mode == "core_repair" else PAIR
    rules = "\n".join(f"- {r}" for r in [f"Reply with JSON only: {reply}", "No fences, no preamble, no comment.", "Keep it technically correct.", *_RULES[mode]])
    out = [("text", f"You write training pairs on models and their source code.\n\nRULES:\n{rules}\n\nCONTEXT:\n- model_name: "), ("value", "model_name"), ("text", "\n- level: "), ("value", "level"), ("text", "\n- tier: "), ("value", "tier"), ("text", f"\n- mode: {mode}\n")]
    if mode == "anchored_extension":
        out += [("text", "- extension_family: "), ("value", "family"), ("text", "\n")]
    out += [("text", "- transform_type: "), ("value", "transform"), ("text", "\n\n"), ("value", "style"), ("text", "\n\nBASE MODEL:\n"), ("value", "summary"), ("text", "\n\nCORE IDENTIFIERS:\n"), ("value", "core"), ("text", "\n\n")]
    if mode == "anchored_extension":
        out += [("text", "EXTENSION CONCEPTS:\n"), ("value", "concepts"), ("text", "\n\nEXTENSION IDENTIFIERS:\n"), ("value", "identifiers"), ("text", "\n\nFRAMING:\n"), ("value", "cues"), ("text", "\n\n")]
    out += [("value", "objective"), ("value", "support"), ("text", f"TASK:\n{_TASK[mode]}\n\nSEED QUESTION:\n"), ("value", "question"), ("text", "\n\nSEED ANSWER:\n"), ("value", "answer"), ("text", f"\n\nOUTPUT:\nOne JSON object: {reply}")]
    return out


def prompts(tasks: DataFrame, profiles: DataFrame) -> DataFrame:
    """tasks with `prompt`, or with `prompt_error` and a null prompt where a mode has no template, or the profile or family is missing.

    tasks: model_name, route_mode, extension_family, transform_type, and where they are there level, tier, the
    seed's seed_q / seed_a or question / answer, and support_question / support_answer (see support_texts). Only
    the named family of the profile is shown. Null values are empty texts, a null level is L3. Profile columns
    procedures, variables, breeds and widgets are listed by kind where they are there, else core as one list.
    """
    none = F.array().cast("array<string>")
    have = lambda *names: F.coalesce(*[F.col(f"`{c}`").cast("string") for c in names if c in tasks.columns], F.lit(""))
    kinds = [c for c in ("procedures", "variables", "breeds", "widgets") if c in profiles.columns]
    listed = [F.concat(F.lit(f"- {c}: "), F.array_join(F.coalesce(c, none), ", ")) for c in kinds]
    core = F.concat_ws("\n", *listed) if listed else bullets(F.array_sort(F.coalesce("core", none)))
    p = profiles.select(F.col("model_name").alias("_m"), core.alias("_core"), F.coalesce("summary", F.lit("")).alias("_summary"), F.col("families").alias("_fam"), bullets(F.coalesce("cues", none)).alias("_cues"))
    names = tasks.columns
    x = tasks.join(p, F.col("model_name") == F.col("_m"), "left")
    fam = F.try_element_at(F.filter("_fam", lambda f: f["name"] == F.col("extension_family")), F.lit(1))
    x = evaluated(x, {"_own": fam})
    level = F.coalesce(F.nullif(F.upper(have("level")), F.lit("")), F.lit("L3"))
    style = F.concat(F.lit("Style: "), level, F.lit(". Keep the answer useful for teaching and technically correct."))
    for name, text in STYLES.items():
        style = F.when(level == name, text).otherwise(style)
    transform = have("transform_type")
    objective = F.concat(F.lit("Take `"), transform, F.lit("` as a guide to the style."))
    for name, text in OBJECTIVES.items():
        objective = F.when(transform == name, text).otherwise(objective)
    objective = F.when(transform == "", "").otherwise(F.concat(F.lit("OBJECTIVE:\n"), objective, F.lit("\n\n")))
    given = [F.col(c) if c in tasks.columns else F.lit(None).cast("string") for c in ("support_question", "support_answer")]
    block = support_block(*given)
    value = {
        "model_name": have("model_name"), "level": have("level"), "tier": have("tier"), "family": have("extension_family"), "transform": transform, "style": style,
        "summary": F.col("_summary"), "core": F.col("_core"), "concepts": bullets(F.coalesce(F.col("_own.concepts"), none)), "identifiers": bullets(F.coalesce(F.col("_own.identifiers"), none)), "cues": F.col("_cues"),
        "objective": objective, "support": F.when(block == "", "").otherwise(F.concat(block, F.lit("\n\n"))), "question": have("seed_q", "question"), "answer": have("seed_a", "answer"),
    }
    mode = F.col("route_mode")
    error = F.when(~F.coalesce(mode.isin(list(MODES)), F.lit(False)), "NO_TEMPLATE").when(F.col("_m").isNull(), "MISSING_MODEL_PROFILE").when((mode == "anchored_extension") & F.col("_own").isNull(), "MISSING_FAMILY")
    body = F.lit(None).cast("string")
    for m in MODES:
        body = F.when(mode == m, F.concat(*[F.lit(t) if kind == "text" else value[t] for kind, t in layout(m)])).otherwise(body)
    return x.select(*[F.col(f"`{c}`") for c in names], F.when(error.isNull(), body).alias("prompt"), error.alias("prompt_error"))


def support_texts(tasks: DataFrame, records: DataFrame, key: str = "support_record_id") -> DataFrame:
    """tasks with support_question and support_answer, the texts of the record that a task leans on; null where there is none.

    records: record_id (unique), question, answer.
    """
    side = records.select(F.col("record_id").alias("_sid"), F.col("question").alias("support_question"), F.col("answer").alias("support_answer"))
    names = [c for c in tasks.columns if c not in ("support_question", "support_answer")]
    return tasks.select(*names).join(side, F.col(key) == F.col("_sid"), "left").drop("_sid")


def requests(prompted: DataFrame, key: str, model: str, temperature: float = 0.7, max_tokens: int = 1024) -> DataFrame:
    """(custom_id, request): one JSON request per prompt that is not null."""
    message = F.array(F.struct(F.lit("user").alias("role"), F.col("prompt").alias("content")))
    body = F.struct(F.lit(model).alias("model"), message.alias("messages"), F.lit(temperature).alias("temperature"), F.lit(max_tokens).alias("max_completion_tokens"))
    whole = F.struct(F.col(key).alias("custom_id"), F.lit("POST").alias("method"), F.lit("/v1/chat/completions").alias("url"), body.alias("body"))
    return prompted.filter("prompt is not null").select(F.col(key).alias("custom_id"), F.to_json(whole).alias("request"))


RESULT = "custom_id string, response struct<status_code:int,body:string>"
BODY = "choices array<struct<message:struct<content:string>>>"


def results(lines: DataFrame, column: str = "value") -> DataFrame:
    """(custom_id, content) of result lines; without id, with a status of 400 or more, with a bad body or without choices they are dropped."""
    r = lines.select(F.from_json(column, RESULT).alias("r")).select("r.*").filter("custom_id is not null and coalesce(response.status_code, 200) < 400")
    c = r.select("custom_id", F.from_json("response.body", BODY).alias("b")).filter(F.size("b.choices") > 0)
    return c.select("custom_id", F.col("b.choices")[0]["message"]["content"].alias("content"))


def echo(df: DataFrame) -> DataFrame:
    """df with `reply`: its own pair as JSON, the deterministic generator for tests and dry runs."""
    return df.withColumn("reply", F.to_json(F.struct(F.coalesce("question", F.lit("")).alias("question"), F.coalesce("answer", F.lit("")).alias("answer"))))


def generate(df: DataFrame, client, column: str = "prompt", attempts: int = 3) -> DataFrame:
    """df with `reply` by a client, a callable str -> str that workers can import; transient errors are tried again, others give null and `reply_error`.

    A lost task runs again, so the client must be idempotent for a prompt; write the result before it is used.
    """
    import time
    from collections.abc import Iterator

    import pandas as pd

    transient = ("429", "500", "502", "503", "504", "timeout", "timed out", "connection")

    def ask(prompt: str | None) -> tuple[str | None, str | None]:
        if prompt is None:
            return None, "NO_PROMPT"
        for k in range(attempts):
            try:
                return client(prompt), None
            except Exception as e:  # noqa: BLE001
                if k + 1 == attempts or not any(t in str(e).lower() for t in transient):
                    return None, str(e)[:200]
                time.sleep(2**k)
        return None, "NO_RESPONSE"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            got = [ask(p if isinstance(p, str) else None) for p in pdf[column]]
            yield pdf.assign(reply=[g[0] for g in got], reply_error=[g[1] for g in got])

    schema = ", ".join(f"`{n}` {t}" for n, t in df.dtypes) + ", reply string, reply_error string"
    return df.mapInPandas(run, schema)


def join_results(tasks: DataFrame, collected: DataFrame, key: str) -> DataFrame:
    """Every task with the `reply` collected for it, NO_RESPONSE in `reply_error` where there is none or a blank one."""
    side = collected.select(F.col("custom_id").alias("_id"), F.col("content").alias("_content")).dropDuplicates(["_id"])
    x = tasks.join(side, tasks[key].cast("string") == side["_id"], "left")
    reply = F.when(strip("_content") != "", F.col("_content"))
    return x.select(*[tasks[c] for c in tasks.columns], reply.alias("reply"), F.when(reply.isNull(), "NO_RESPONSE").alias("reply_error"))


def embed(df: DataFrame, client, column: str = "question", out: str = "embedding") -> DataFrame:
    """df with the vector that a client, a callable list[str] -> list of vectors that workers can import, gives each text; null texts get null."""
    from collections.abc import Iterator

    import pandas as pd

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            ask = [t for t in pdf[column] if isinstance(t, str)]
            got = iter(client(ask) if ask else [])
            yield pdf.assign(**{out: [list(map(float, next(got))) if isinstance(t, str) else None for t in pdf[column]]})

    return df.mapInPandas(run, ", ".join(f"`{n}` {t}" for n, t in df.dtypes) + f", `{out}` array<float>")
