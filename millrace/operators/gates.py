"""Gates that a generated pair must pass: JSON, nearest class, vocabulary."""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from millrace.functions.lexical import backticked_identifiers, sentences, summary_keywords, words_literal
from millrace.functions.text import as_col, evaluated, text_key
from millrace.operators.profiles import extension_concepts, extension_ids

MAX_CHARS = 50_000
# What presents something as an extension.
FRAMING_CUES = ["extend the model", "you could add", "you could introduce", "as an extension", "in an extended version", "if you modify the model", "beyond the original code", "not part of the original code", "replace the original", "refine the original"]
_Q = "['\"`]"
FRAMING = (
    rf"extend\w*\s+the\s+(?:original\s+)?{_Q}?(?:\w+[\s_-]+)*model{_Q}?",
    rf"extend\w*\s+(?:the\s+(?:original|{_Q}[\w\s_-]+{_Q})\s*(?:model)?|it)\b",
    rf"extend\w*\s+the\s+original\s+{_Q}\w+{_Q}\s+model",
    r"you\s+could\s+(?:add|introduce|extend)",
    r"if\s+you\s+modify\s+the\s+model",
    r"in\s+an\s+extens(?:ion|ded\s+version)\s+of\s+the",
    r"beyond\s+the\s+original",
    r"as\s+an\s+extension",
    r"proposed\s+extension",
    r"(?:replace|refine)\s+the\s+original",
    r"not\s+(?:part\s+of|in)\s+the\s+original\s+(?:code|model)",
    r"add(?:ing)?\s+(?:a\s+)?(?:new\s+)?(?:turtle[_-]?own\s+)?(?:variable|procedure|reporter|breed|state|mechanism)",
    r"implement\s+(?:the\s+)?(?:this\s+)?extension",
    r"modif(?:y|ying|ied)\s+(?:the\s+)?(?:original\s+)?(?:model|code)",
    r"introduc(?:e|ing)\s+(?:a\s+)?(?:new\s+)?(?:\w+\s+)*(?:variable|procedure|slider|parameter|mechanism|attribute)",
    rf"introduc(?:e|ing)\s+(?:a\s+)?{_Q}?\w+{_Q}?\s+(?:machine|variable|attribute)",
    r"(?:we\s+can|you\s+can|let'?s|we'?ll)\s+(?:introduc(?:e|ing)|extend)",
    rf"(?:add(?:ing)?|a\s+new)\s+(?:a\s+)?{_Q}\w[\w-]*{_Q}\s*(?:variable|attribute|parameter|slider)?",
    rf"add\s+(?:to\s+)?{_Q}?\w+[_-]own{_Q}?",
    rf"modif(?:y|ying)\s+the\s+{_Q}\w+{_Q}\s+procedure",
    r"(?:state[_\s](?:refinement|machine)|behavioral?|\w+_\w+)\s+extension",
    rf"(?:there\s+is\s+no|has\s+no|does\s+not\s+have|lacks)\s+(?:explicit\s+)?(?:{_Q}?[\w-]+{_Q}?\s+){{0,3}}(?:feature|mechanism|variable|procedure)",
)
PROPOSAL = (
    r"(?:define|declare|create|introduce|add)\s+(?:a\s+)?(?:new\s+)?(?:global|variable|turtle|patch|reporter|procedure|metric)",
    r"turtles-own\s*\[",
    r"patches-own\s*\[",
    r"globals\s*\[",
    r"to-report\b",
    r"implement\s+(?:the\s+)?(?:this\s+)?(?:by|via|as|in)",
    r"measure\s+(?:the\s+)?(?:this\s+)?(?:by|via|as|using)",
    r"track\s+(?:a\s+)?(?:new\s+)?(?:variable|metric|count|value)",
    r"record\s+(?:the\s+)?(?:final|peak|max|min|mean|total)",
    r"hypothesis",
    r"experiment",
)
# What claims that something is there already, and what takes the claim back.
CLAIMS = ["the model already", "the original model already", "the base model already", "already uses", "already tracks", "already contains", "already includes", "already has", "the existing code", "the original code", "built-in", "currently defined", "is defined in the model", "is tracked in the model", "is in the original model", "the model uses", "the model tracks", "the model contains", "the model includes", "the model has"]
SAFE = ["you could add", "you could introduce", "extend the model", "extend the original model", "in an extended version", "as an extension", "if you modify the model", "not part of the original code", "beyond the original code", "replace the original", "refine the original"]
#: What a text must hold, in lower case, for the pattern at the same place to match: most texts are told by these alone.
FRAMING_STEMS = (
    ["extend"], ["extend"], ["extend"], ["could"], ["modify"], ["extens"], ["beyond"], ["extension"], ["extension"], ["replace", "refine"], ["original"],
    ["variable", "procedure", "reporter", "breed", "state", "mechanism"], ["implement"], ["modif"], ["introduc"], ["introduc"], ["introduc", "extend"], ["add", "new"], ["own"], ["modif"], ["extension"], ["feature", "mechanism", "variable", "procedure"],
)
ANCHORS = ["original model", "base model", "original code", "extend the original model"]
SUMMARY_WORDS = 2


def any_of(patterns) -> str:
    """One pattern, regardless of case, for several."""
    return "(?i)" + "|".join(f"(?:{p})" for p in patterns)


def any_phrase(phrases) -> str:
    """One pattern for several plain phrases; they hold letters, blanks and hyphens only."""
    return "|".join(phrases)


def holds(text: Column, phrases) -> Column:
    """Whether text has one of several plain phrases: a search for each costs less than one pattern for all."""
    return functools.reduce(lambda a, b: a | b, [F.contains(text, F.lit(p)) for p in phrases])


def parse_reply(raw: Column | str) -> Column:
    """struct(ok, error, question, answer) of a raw reply that should be a JSON object with two strings.

    Checked in this order: too long, no JSON, no object, a key `skip` (whatever its value), a key missing, a
    value that is no string. Spark's parser takes NaN and repeated keys for no JSON.
    """
    text = as_col(raw)
    v = F.try_parse_json(text)
    shape = F.schema_of_variant(v)
    kind = lambda k: F.schema_of_variant(F.try_variant_get(v, f"$.{k}", "variant"))
    has_skip = shape.rlike(r"(?:^OBJECT<|, )`?skip`?: ")
    err = (
        F.when(text.isNull(), "NO_RESPONSE")
        .when(F.length(text) > MAX_CHARS, "too_long")
        .when(v.isNull(), "bad_json")
        .when(~shape.startswith("OBJECT<"), "not_an_object")
        .when(has_skip, "skip")
        .when(kind("question").isNull() | kind("answer").isNull(), "missing_key")
        .when((kind("question") != "STRING") | (kind("answer") != "STRING"), "not_a_string")
    )
    get = lambda k: F.when(err.isNull(), F.try_variant_get(v, f"$.{k}", "string"))
    return F.struct(err.isNull().alias("ok"), err.alias("error"), get("question").alias("question"), get("answer").alias("answer"))


def cosine(a: Column, b: Column) -> Column:
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, t: s + t)
    return F.try_divide(dot(a, b), F.sqrt(dot(a, a) * dot(b, b)))


def class_centres(vectors: DataFrame, vector: str = "embedding", label: str = "label") -> DataFrame:
    """(label, centre): the mean vector of every class, summed by position."""
    x = vectors.filter(F.col(label).isNotNull()).select(label, F.posexplode(vector).alias("i", "v"))
    m = x.groupBy(label, "i").agg(F.avg(F.col("v").cast("double")).alias("v"))
    return m.groupBy(label).agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "v"))), lambda s: s["v"]).alias("centre"))


def nearest_class(vectors: DataFrame, centres: DataFrame, key: str, vector: str = "embedding", label: str = "label", threshold: float = 0.65, margin: float = 0.01, most: int = 10_000, most_bytes: int = 64 << 20) -> DataFrame:
    """(key, best_label, similarity, margin, reason): each vector against all class centres, in one pass.

    The centres, one row per class, at most `most` and `most_bytes` of numbers (more are an error), are one
    matrix that goes to every executor; a batch of vectors is multiplied with it. reason:
    WRONG_CLASS_NEIGHBORHOOD, LOW_EMBED_SIM, LOW_CLASS_MARGIN or null. Null vectors, vectors without length or of
    another size, and vectors with null or NaN values have no scores and reason GATE1_BACKEND_ERROR. Equal
    scores: the greater label first. Null labels and null centres are no class.
    """
    n = centres.filter(F.col(label).isNotNull() & F.col("centre").isNotNull())
    classes, size = n.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("centre")), F.lit(0))).first()
    if classes > most or classes * size * 8 > most_bytes:
        raise ValueError(f"{classes} classes of {size} numbers are more than {most} or {most_bytes} bytes")
    rows = sorted(n.collect(), key=lambda r: r[label], reverse=True)
    matrix = np.array([[np.nan if v is None else v for v in r["centre"]] + [np.nan] * (size - len(r["centre"])) for r in rows], float).reshape(len(rows), size)
    with np.errstate(all="ignore"):
        unit = matrix / np.linalg.norm(matrix, axis=1, keepdims=True)
    alive = np.isfinite(unit).all(axis=1)
    sent = vectors.sparkSession.sparkContext.broadcast((unit[alive], [r[label] for r, ok in zip(rows, alive, strict=True) if ok]))
    kinds = dict(vectors.dtypes)
    key_type, label_type = vectors.schema[key].dataType, vectors.schema[label].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit, labels = sent.value
        for batch in batches:
            x = np.full((batch.num_rows, unit.shape[1] or 1), np.nan)
            lists = batch.column(1)
            whole = np.flatnonzero(pc.fill_null(pc.equal(pc.list_value_length(lists), unit.shape[1]), False).to_numpy(zero_copy_only=False))
            if unit.shape[1] and len(whole):
                x[whole] = np.array(lists.take(pa.array(whole)).flatten().to_numpy(zero_copy_only=False), float).reshape(len(whole), -1)
            first, second = np.full(len(x), -1), np.full(len(x), np.nan)
            s1 = np.full(len(x), np.nan)
            with np.errstate(all="ignore"):
                x /= np.linalg.norm(x, axis=1, keepdims=True)
            good = np.flatnonzero(np.isfinite(x).all(axis=1)) if len(labels) else np.zeros(0, np.int64)
            for lo in range(0, len(good), max(1, 4_000_000 // max(1, len(labels)))):  # a block of scores of some 32 MB
                at = good[lo : lo + max(1, 4_000_000 // max(1, len(labels)))]
                score = x[at] @ unit.T
                first[at] = score.argmax(axis=1)
                s1[at] = score[np.arange(len(at)), first[at]]
                if len(labels) > 1:
                    score[np.arange(len(at)), first[at]] = -np.inf
                    second[at] = score.max(axis=1)
            known = pa.array([labels[k] if k >= 0 else None for k in first], pa_label)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), known, pa.array(s1, from_pandas=True), pa.array(second, from_pandas=True)], ["k", "own", "best", "s1", "s2"])

    pa_label = to_arrow_type(label_type)
    x = vectors.select(key, F.col(vector).cast("array<double>"), label).mapInArrow(run, f"k {key_type.simpleString()}, own {kinds[label]}, best {kinds[label]}, s1 double, s2 double")
    gap = F.col("s1") - F.coalesce("s2", F.lit(-1.0))
    reason = F.when(F.col("s1").isNull(), "GATE1_BACKEND_ERROR").when(F.col("own").isNotNull() & (F.col("best") != F.col("own")), "WRONG_CLASS_NEIGHBORHOOD").when(F.col("s1") < threshold, "LOW_EMBED_SIM").when(gap < margin, "LOW_CLASS_MARGIN")
    return x.select(F.col("k").alias(key), F.col("best").alias("best_label"), F.col("s1").alias("similarity"), gap.alias("margin"), reason.alias("reason"))


def has_framing(answer: Column, answer_key: Column, cues: Column) -> Column:
    """answer_key: text_key of the answer, made once."""
    told = holds(answer_key, FRAMING_CUES)
    for stems, pattern in zip(FRAMING_STEMS, FRAMING, strict=True):
        told = told | (holds(answer_key, stems) & answer.rlike(any_of([pattern])))
    return told | F.exists(cues, lambda c: F.contains(answer_key, c))


def validate_vocabulary(df: DataFrame, profiles: DataFrame, allow: list[str], mode: str = "route_mode", family: str = "extension_family") -> DataFrame:
    """df with `reason`: why the pair does not fit its mode and model, null if it does; the first check that fails counts.

    df: model_name, question, answer and the two named columns. Checks of core modes: unknown identifiers,
    extension identifiers, extension concepts, themes; of extension modes: unknown identifiers without framing,
    identifiers of another family, missing framing, claims that an extension is there already, no anchor in the
    model (an identifier, a phrase, or two words of its summary), themes. The model's own name and its words
    count as known. Null texts are empty; a row without profile is MISSING_MODEL_PROFILE.

    Keys, identifiers and sentences are made once per row and kept as columns, which Spark does not merge back
    into the expressions that read them.
    """
    none = F.array().cast("array<string>")
    p = profiles.select(F.col("model_name").alias("_m"), *[F.col(c).alias(f"_p_{c}") for c in ("core", "families", "cues", "themes")], summary_keywords("summary").alias("_summary"))
    p = evaluated(p, {"_p_ext": F.coalesce(extension_ids("_p_families"), none), "_concepts": F.coalesce(extension_concepts("_p_families"), none)})
    names = df.columns
    x = df.join(p, F.col("model_name") == F.col("_m"), "left")
    answer = F.coalesce("answer", F.lit(""))
    text = F.concat(F.coalesce("question", F.lit("")), F.lit("\n"), answer)
    name = F.coalesce(F.lower("model_name"), F.lit(""))
    own_name = F.array_union(F.array(name, F.replace(name, F.lit("_"), F.lit("-"))), F.filter(F.split(name, "_"), lambda w: F.length(w) >= 3))
    x = evaluated(x, {"_low": text_key(text), "_akey": text_key(answer), "_used": F.array_distinct(backticked_identifiers(text)), "_core": F.coalesce("_p_core", none), "_ext": F.coalesce("_p_ext", none), "_own": own_name})
    x = evaluated(
        x,
        {
            "_used_ext": F.array_intersect("_used", "_ext"),
            "_unknown": F.array_except(F.array_except(F.array_except("_used", "_core"), "_ext"), F.array_union("_own", words_literal(allow))),
            "_framed": has_framing(answer, F.col("_akey"), F.coalesce("_p_cues", none)),
            "_themed": F.exists(F.coalesce("_p_themes", none), lambda t: (t != "") & F.contains(F.col("_low"), t)),
        },
    )
    is_core = F.col(mode).isin("core_paraphrase", "core_repair")
    is_ext = F.col(mode).isin("anchored_extension", "freeform_extension")
    own_family = F.flatten(F.transform(F.filter("_p_families", lambda f: f["name"] == F.col(family)), lambda f: f["identifiers"]))
    proposed = F.col("_framed") | answer.rlike(any_of(PROPOSAL))
    unknown = F.size("_unknown") > 0
    core_reason = (
        F.when(unknown & ~((F.col(mode) == "core_repair") & proposed), "UNKNOWN_CORE_IDENTIFIER")
        .when(F.size("_used_ext") > 0, "UNAPPROVED_EXTENSION_IDENTIFIER")
        .when(F.exists(F.coalesce("_concepts", none), lambda c: (c != "") & F.contains(F.col("_low"), c)), "EXTENSION_CONTENT_IN_CORE_MODE")
        .when(F.col("_themed"), "DISALLOWED_THEME")
    )
    used = F.array_union("_used_ext", "_unknown")  # framed unknown ones count as proposals
    # Most answers claim nothing, which the whole answer's key tells; only the others are cut into sentences.
    told = F.exists(
        F.transform(sentences("answer"), text_key),
        lambda s: s.rlike(any_phrase(CLAIMS)) & ~s.rlike(any_phrase(SAFE)) & F.exists(used, lambda u: F.contains(s, u)),
    )
    claimed = holds(F.col("_akey"), CLAIMS) & told
    words = F.size(F.filter(F.coalesce("_summary", none), lambda w: F.contains(F.col("_low"), w)))
    anchored = holds(F.col("_low"), ANCHORS) | F.exists("_core", lambda c: F.contains(F.col("_low"), c)) | (words >= SUMMARY_WORDS)
    ext_reason = (
        F.when(unknown & ~F.col("_framed"), "UNAPPROVED_EXTENSION_IDENTIFIER")
        .when(F.col(family).isNotNull() & (F.size(F.array_except("_used_ext", F.coalesce(own_family, none))) > 0), "CROSS_FAMILY_EXTENSION_IDENTIFIER")
        .when((F.size(used) > 0) & ~F.col("_framed"), "EXTENSION_REQUIRES_FRAMING")
        .when(claimed, "BASE_MODEL_MISREPRESENTATION")
        .when(~anchored, "INSUFFICIENT_CORE_ANCHOR")
        .when(F.col("_themed"), "DISALLOWED_THEME")
    )
    reason = F.when(F.col("_m").isNull(), "MISSING_MODEL_PROFILE").when(is_core, core_reason).when(is_ext, ext_reason).otherwise("UNKNOWN_MODE")
    return x.select(*[F.col(f"`{c}`") for c in names], reason.alias("reason"))
