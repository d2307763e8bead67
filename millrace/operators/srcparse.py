"""Model source files: one text of three sections to declared names, procedures, widgets and a summary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import as_col, evaluated, strip

# Formats.
SEPARATOR = "@#$#@#$#@"
ID = r"[A-Za-z_][A-Za-z0-9_\-]*\??"
WIDGETS = ["GRAPHICS-WINDOW", "BUTTON", "PLOT", "TEXTBOX", "CHOOSER", "SLIDER", "SWITCH", "MONITOR", "INPUTBOX", "OUTPUT", "CC-WINDOW"]
CONTROLS = ["SLIDER", "SWITCH", "CHOOSER", "INPUTBOX"]
IGNORED = ["nil", "horizontal", "vertical", "observer", "turtle", "patch", "link", "true", "false"]
PREFIXES = ["initial-", "num-", "max-", "min-", "show-", "plot-", "vision", "movement"]
#: Words of the modelling language itself; a session passes its own list.
RESERVED = "to to-report end breed globals turtles-own patches-own links-own let set report if ifelse while repeat foreach map filter stop tick reset-ticks clear-all ask of with one-of n-of count sum mean max min random patch patches turtle turtles self myself other neighbors hatch sprout die move-to fd rt lt distance face setxy true false not and or who color pcolor size label diffuse create-turtles ticks".split()


CORE_COLUMNS = ("procedures", "variables", "breeds", "widgets", "locals")


def none() -> Column:
    return F.array().cast("array<string>")


def sections(text: Column | str) -> Column:
    """struct(code, interface, info, extra): the parts between separators; missing ones are empty."""
    parts = F.split(F.coalesce(as_col(text), F.lit("")), r"@#\$#@#\$#@")
    at = lambda k: F.coalesce(F.try_element_at(parts, F.lit(k)), F.lit(""))
    return F.struct(at(1).alias("code"), at(2).alias("interface"), at(3).alias("info"), F.slice(parts, 4, 1_000_000).alias("extra"))


def unix_lines(text: Column | str) -> Column:
    """Each line end, of whatever kind, one line feed."""
    return F.regexp_replace(as_col(text), r"\r\n?", "\n")


def strip_comments(code: Column | str) -> Column:
    """Everything from a semicolon to the line's end removed, but not inside quotes, which may span lines. Line ends become line feeds."""
    return F.regexp_replace(F.coalesce(unix_lines(code), F.lit("")), r'("[^"]*(?:"|$))|;[^\n]*', "$1")


def found(code: Column, pattern: str, group: int = 1) -> Column:
    return F.regexp_extract_all(code, F.lit(pattern), F.lit(group))


def first_seen(names: Column) -> Column:
    """Distinct regardless of case, the first spelling kept, in order."""
    low = F.transform(names, F.lower)
    return F.filter(names, lambda x, i: F.array_position(low, F.lower(x)) == i + 1)


def sorted_names(names: Column) -> Column:
    """Distinct spellings, ordered by lower case, then by spelling."""
    return F.transform(F.array_sort(F.transform(F.array_distinct(names), lambda x: F.struct(F.lower(x).alias("low"), x.alias("name")))), lambda s: s["name"])


def breeds(code: Column) -> Column:
    """Plural and singular names of all breeds and link breeds, first spelling, in order."""
    pairs = r"(?i)\b(?:directed-link-|undirected-link-)?breed\s*\[\s*(" + ID + r")\s+(" + ID + r")\s*\]"
    both = F.arrays_zip(found(code, pairs, 1).alias("a"), found(code, pairs, 2).alias("b"))
    return first_seen(F.flatten(F.transform(both, lambda p: F.array(p["a"], p["b"]))))


def declared(code: Column) -> Column:
    """struct(globals, own): names in globals[...] and in all ...-own[...] blocks, sorted."""
    names = lambda blocks: F.flatten(F.transform(blocks, lambda b: F.regexp_extract_all(b, F.lit(f"({ID})"), F.lit(1))))
    return F.struct(sorted_names(names(found(code, r"(?is)\bglobals\s*\[(.*?)\]"))).alias("globals"), sorted_names(names(found(code, r"(?is)\b" + ID + r"-own\s*\[(.*?)\]"))).alias("own"))


def procedures(code: Column) -> Column:
    """Names after `to` and `to-report` at a line's start, in order."""
    return found(code, rf"(?dmi)^\s*to(?:-report)?\s+({ID})")


def reporters(code: Column) -> Column:
    return found(code, rf"(?dmi)^\s*to-report\s+({ID})")


def signatures(code: Column) -> Column:
    """array of struct(kind, name, inputs): every procedure in order, `to` or `to-report`, with the names of its inputs."""
    pattern = rf"(?dmi)^\s*(to(?:-report)?)\s+({ID})[ \t]*(?:\[([^\]]*)\])?"
    zipped = F.arrays_zip(found(code, pattern, 1).alias("kind"), found(code, pattern, 2).alias("name"), found(code, pattern, 3).alias("inputs"))
    return F.transform(zipped, lambda p: F.struct(F.lower(p["kind"]).alias("kind"), p["name"].alias("name"), F.regexp_extract_all(p["inputs"], F.lit(f"({ID})"), F.lit(1)).alias("inputs")))


def local_names(code: Column) -> Column:
    """Names made by let and by lambda arguments, sorted."""
    args = F.flatten(F.transform(found(code, rf"->\s*({ID}(?:\s+{ID})*)"), lambda s: F.split(s, r"\s+")))
    return sorted_names(F.concat(found(code, rf"(?i)\blet\s+({ID})"), args))


def string_literals(code: Column) -> Column:
    """Distinct non-blank literals but for four that mean nothing, sorted."""
    lits = F.transform(found(code, r'"([^"\n]*)"'), strip)
    return sorted_names(F.filter(lits, lambda s: (s != "") & ~F.lower(s).isin("horizontal", "vertical", "n/a", "nil")))


def breed_words(names: Column) -> Column:
    """Words that the language derives from a breed's plural name."""
    return F.flatten(F.transform(names, lambda b: F.array(F.concat(F.lit("create-"), b), F.concat(F.lit("create-ordered-"), b), F.concat(F.lit("hatch-"), b), F.concat(F.lit("sprout-"), b), F.concat(b, F.lit("-here")))))


def info_paragraph(info: Column | str) -> Column:
    """The first paragraph of eight or more words that is no heading, its lines joined; empty if none."""
    paragraphs = F.transform(F.split(F.regexp_replace(F.coalesce(as_col(info), F.lit("")), r"\r\n?", "\n"), r"\n[ \t]*(?:\n[ \t]*)+"), lambda p: F.array_join(F.filter(F.transform(F.split(p, "\n"), strip), lambda s: s != ""), " "))
    n = lambda p: F.size(F.split(p, r"\s+"))
    good = F.filter(paragraphs, lambda p: (p != "") & ~p.startswith("#") & ~((n(p) <= 4) & (F.upper(p) == p)) & (n(p) >= 8))
    return F.coalesce(F.try_element_at(good, F.lit(1)), F.lit(""))


def interface_blocks(interface: Column | str) -> Column:
    """Blocks of lines, each from a widget's header line to before the next; lines before the first are dropped."""
    text = F.concat(F.lit("\n"), F.regexp_replace(F.coalesce(as_col(interface), F.lit("")), r"\r\n?", "\n"))
    parts = F.split(text, r"\n(?=[ \t]*(?:" + "|".join(WIDGETS) + r")[ \t]*(?:\n|$))")
    return F.transform(F.slice(parts, 2, 1_000_000), lambda p: F.split(p, "\n"))


def controls(interface: Column | str) -> Column:
    """array of struct(kind, name): the variable of each control widget, its second identifier line, else its first, in order."""
    def one(b: Column) -> Column:
        lines = F.filter(F.transform(F.slice(b, 2, 1_000_000), strip), lambda s: s.rlike(f"^{ID}$") & ~F.lower(s).isin(IGNORED))
        return F.struct(F.lower(strip(b[0])).alias("kind"), F.coalesce(F.try_element_at(lines, F.lit(2)), F.try_element_at(lines, F.lit(1))).alias("name"))

    blocks = F.filter(interface_blocks(interface), lambda b: strip(b[0]).isin(CONTROLS))
    return F.filter(F.transform(blocks, one), lambda c: c["name"].isNotNull())


def control_names(interface: Column | str, kind: str | None = None) -> Column:
    """The names of all controls, or of those of one kind (slider, switch, chooser, inputbox); first spelling, in order."""
    all_ = controls(interface)
    return first_seen(F.transform(F.filter(all_, lambda c: c["kind"] == kind) if kind else all_, lambda c: c["name"]))


def core_of(df: DataFrame, text: str) -> DataFrame:
    """df with procedures, reporters, variables, breeds, widgets, locals, literals and summary of each source text."""
    x = evaluated(df, {"_s": sections(text)})
    x = evaluated(x, {"_c": strip_comments(F.col("_s.code"))})
    c = F.col("_c")
    x = x.withColumns({"procedures": sorted_names(procedures(c)), "reporters": sorted_names(reporters(c)), "variables": sorted_names(F.concat(declared(c)["globals"], declared(c)["own"])), "breeds": breeds(c), "widgets": sorted_names(control_names(F.col("_s.interface"))), "locals": local_names(c), "literals": string_literals(c)})
    return x.withColumn("summary", info_paragraph(F.col("_s.info"))).drop("_s", "_c")


def _tokens(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, literals, widgets, _known, _tokens): what a source declares, and all identifiers of its code, in lower case."""
    x = core_of(df.select(key, text), text).withColumn("_c", strip_comments(sections(text)["code"]))
    known = F.transform(F.concat("procedures", "variables", "breeds", "widgets", "locals", breed_words(F.col("breeds"))), F.lower)
    tokens = F.transform(F.regexp_extract_all(F.regexp_replace("_c", r'"[^"]*"', " "), F.lit(f"({ID})"), F.lit(1)), F.lower)
    return evaluated(x.select(key, "_c", "literals", *CORE_COLUMNS), {"_known": known, "_tokens": tokens}, drop=("_c", "procedures", "variables", "breeds", "locals"))


def unresolved(df: DataFrame, key: str, text: str, reserved: list[str] = RESERVED) -> DataFrame:
    """(key, token, n): identifiers of the code, in lower case, that are declared nowhere and are no word of the language."""
    left = _tokens(df, key, text).select(key, F.explode(F.filter("_tokens", lambda t: ~F.array_contains("_known", t))).alias("token"))
    return left.filter(~F.col("token").isin(reserved)).groupBy(key, "token").agg(F.count(F.lit(1)).alias("n"))


def source_terms(df: DataFrame, key: str, text: str, reserved: list[str] = RESERVED) -> DataFrame:
    """(key, term, kind) in lower case: `aux` for the literals and widgets of a source, `unresolved` for the identifiers that it declares nowhere; each source is parsed once."""
    words = F.array(*[F.lit(w) for w in reserved]) if reserved else none()
    aux = F.transform(F.array_union("literals", "widgets"), lambda t: F.struct(F.lower(t).alias("term"), F.lit("aux").alias("kind")))
    open_ = F.transform(F.array_except(F.array_except("_tokens", "_known"), words), lambda t: F.struct(t.alias("term"), F.lit("unresolved").alias("kind")))
    return _tokens(df, key, text).select(key, F.inline(F.concat(aux, open_)))


def widget_score(token: Column, n: Column) -> Column:
    """How much a token looks like the name of a widget; 3 or more is a candidate."""
    yes = lambda c, v: F.when(c, v).otherwise(0)
    prefix = F.lit(False)
    for p in PREFIXES:
        prefix = prefix | token.startswith(p)
    return yes(F.contains(token, F.lit("-")), 3) + yes(token.endswith("?"), 2) + yes(n >= 2, 2) + yes(prefix, 2) + yes(token.isin("vision", "visualization"), 2)


def widget_candidates(tokens: DataFrame) -> DataFrame:
    return tokens.withColumn("score", widget_score(F.col("token"), F.col("n"))).filter("score >= 3")


def widget_review(df: DataFrame, key: str, text: str, reserved: list[str] = RESERVED, first: int = 20) -> DataFrame:
    """(key, interface_widgets, widget_candidates, unresolved): per source the widgets of its interface, the names of its code that look like further ones, and the first names that are declared nowhere, each sorted."""
    left = unresolved(df, key, text, reserved).withColumn("score", widget_score(F.col("token"), F.col("n")))
    names = left.groupBy(key).agg(F.array_sort(F.collect_list(F.when(F.col("score") >= 3, F.col("token")))).alias("widget_candidates"), F.slice(F.array_sort(F.collect_list("token")), 1, first).alias("unresolved"))
    x = df.select(key, sorted_names(control_names(sections(text)["interface"])).alias("interface_widgets")).join(names, key, "left")
    return x.select(key, "interface_widgets", *[F.coalesce(c, none()).alias(c) for c in ("widget_candidates", "unresolved")])


def fallback_summary(name: Column) -> Column:
    """A sentence on the model from what core_of found, for sources without an info paragraph."""
    part = lambda label, c, n: F.when(F.size(c) > 0, F.concat(F.lit(label), F.array_join(F.slice(c, 1, n), ", ")))
    parts = F.filter(F.array(part("breeds ", "breeds", 4), part("procedures such as ", "procedures", 5), part("variables like ", "variables", 5), part("controls such as ", "widgets", 5)), lambda p: p.isNotNull())
    return F.when(F.size(parts) > 0, F.concat(F.lit("The model "), name, F.lit(" has "), F.array_join(parts, "; "), F.lit("."))).otherwise(F.concat(F.lit("The model "), name, F.lit(" has no names that can be read from its source.")))


def merged_widgets(*names: Column) -> Column:
    """All names, distinct regardless of case with the first spelling kept, sorted."""
    return sorted_names(first_seen(F.concat(*names)))
