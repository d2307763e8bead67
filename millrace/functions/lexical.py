"""Terms, phrases and sentences of a text, as column expressions. Three tokenisers that must not be mixed up.

`identifier_tokens` drops a trailing question mark unless a word character follows it, `backtick_spans` keeps
what stands between the marks, and `backticked_identifiers` keeps only spans that are one identifier.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.functions.text import as_col, blank_to_null, strip, text_key

# Words that carry no term.
STOPWORDS = (
    "the a an of to for in on at by with and or is are was were be as from that this these those it its their them what how why when where which do does did "
    "can could would should into about than then if we you your our they he she i my me also not only more less same different new old model netlogo"
).split()
# Patterns.
IDENTIFIER = r"\b([a-zA-Z_][a-zA-Z0-9_\-]*\??)\b"
SINGLE_IDENTIFIER = r"^[A-Za-z_][A-Za-z0-9_\-]*\??$"
FENCED = r"```[\s\S]*?```"


def words_literal(words: list[str]) -> Column:
    return F.array(*[F.lit(w) for w in words]) if words else F.array().cast("array<string>")


def backtick_spans(x: Column | str) -> Column:
    return F.regexp_extract_all(F.coalesce(as_col(x), F.lit("")), F.lit("`([^`]+)`"), F.lit(1))


def identifier_tokens(x: Column | str) -> Column:
    return F.regexp_extract_all(F.coalesce(as_col(x), F.lit("")), F.lit(IDENTIFIER), F.lit(1))


def term_list(x: Column | str) -> Column:
    """All terms in order, repeats included: normalised backtick spans, then identifier tokens that are no stop words."""
    spans = F.transform(backtick_spans(x), text_key)
    tokens = F.filter(F.transform(identifier_tokens(x), F.lower), lambda t: ~t.isin(STOPWORDS))
    return F.concat(spans, tokens)


def terms(x: Column | str) -> Column:
    """The distinct terms, sorted."""
    return F.array_sort(F.array_distinct(term_list(x)))


def backticked_identifiers(x: Column | str) -> Column:
    """Spans that are one identifier, lower case, outside fenced blocks; repeats included."""
    spans = F.transform(backtick_spans(F.regexp_replace(F.coalesce(as_col(x), F.lit("")), FENCED, "")), strip)
    return F.transform(F.filter(spans, lambda s: s.rlike(SINGLE_IDENTIFIER)), F.lower)


def phrases_in(x: Column | str, phrases: Column) -> Column:
    """The phrases (already keys) that the text's key contains, distinct and sorted. Plain substrings, no word borders."""
    t = text_key(F.coalesce(as_col(x), F.lit("")))
    return F.array_sort(F.array_distinct(F.filter(phrases, lambda p: (p != "") & F.contains(t, p))))


def summary_keywords(x: Column | str) -> Column:
    """Distinct identifier tokens of five or more characters that are no stop words, sorted."""
    kept = F.filter(F.transform(identifier_tokens(x), F.lower), lambda t: (F.length(t) >= 5) & ~t.isin(STOPWORDS))
    return F.array_sort(F.array_distinct(kept))


def sentences(x: Column | str) -> Column:
    """Parts between sentence ends and line ends, stripped, blank ones dropped."""
    parts = F.split(F.coalesce(as_col(x), F.lit("")), r"(?<=[.!?])\s+|\n+")
    return F.filter(F.transform(parts, strip), lambda s: s != "")


def runs_of(tokens: Column, low: int, high: int, told: Column | None = None) -> Column:
    """Runs of low to high successive tokens, joined by blanks; with `told`, an array of truth values beside the tokens, those where one is true."""
    none = F.array().cast("array<string>")

    def grams(t: Column, n: int) -> Column:
        # sequence(1, 0) counts down, so short lists are told apart first.
        at = F.sequence(F.lit(1), F.size(t) - (n - 1))
        if told is not None:
            at = F.filter(at, lambda i: F.array_contains(F.slice(told, i, F.lit(n)), True))
        return F.when(F.size(t) >= n, F.transform(at, lambda i: F.array_join(F.slice(t, i, F.lit(n)), " "))).otherwise(none)

    return F.concat(none, *[grams(tokens, n) for n in range(low, high + 1)])


def word_ngrams(x: Column | str, low: int = 2, high: int = 4, keywords: list[str] | None = None) -> Column:
    """Runs of low to high successive identifier tokens that are no stop words; with `keywords`, those that have one of them."""
    tokens = F.filter(F.transform(identifier_tokens(x), F.lower), lambda t: ~t.isin(STOPWORDS))
    return runs_of(tokens, low, high, F.transform(tokens, lambda t: t.isin(keywords)) if keywords is not None else None)


def quoted_phrases(x: Column | str, max_chars: int = 120, max_words: int = 5, single: bool = False) -> Column:
    """Keys of the phrases of one to max_words words in double quotes, or with `single` in double or single quotes."""
    pattern = f'"[^"\\n]{{1,{max_chars}}}"' + (f"|'[^'\\n]{{1,{max_chars}}}'" if single else "")
    quoted = F.regexp_extract_all(F.coalesce(as_col(x), F.lit("")), F.lit(pattern), F.lit(0))
    spans = F.transform(quoted, lambda q: text_key(F.substr(q, F.lit(2), F.length(q) - 2)))
    return F.filter(spans, lambda s: (s != "") & (F.size(F.split(s, " ")) <= max_words))


def tag_value(tags: Column | str, name: str) -> Column:
    """What follows `name:` in the first tag that has it, in any case."""
    pattern = f"(?is)^{name}:(.+)$"
    hits = F.filter(F.coalesce(as_col(tags), F.array().cast("array<string>")), lambda t: t.rlike(pattern))
    return F.regexp_extract(F.try_element_at(hits, F.lit(1)), pattern, 1)


def first_message(messages: Column | str, role: str) -> Column:
    """The first non-blank content of a role."""
    hit = F.filter(as_col(messages), lambda m: (m["role"] == role) & blank_to_null(m["content"]).isNotNull())
    return blank_to_null(F.try_element_at(hit, F.lit(1))["content"])
