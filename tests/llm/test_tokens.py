import os

import pytest
import regex
from hypothesis import given, settings
from hypothesis import strategies as st

from millrace.llm import tokens
from millrace.llm.automaton import Automaton, build, to_bytes

pytestmark = pytest.mark.skipif(not os.path.exists(tokens.VOCABULARY), reason="no vocabulary here")
ODD = [None, "", " ", "\n", "a" * 30_000, " \n\n  x", "<|endoftext|>", "日本語🙂🙂", "don't we'll", "﻿x\x01y", "ab" * 5000, "é é", "1234567890" * 50, "\t\t\r\n end", "word " * 3000]


@pytest.fixture(scope="module")
def ranks():
    return tokens.read_ranks(tokens.VOCABULARY)


@pytest.fixture(scope="module")
def exact(ranks):
    import tiktoken

    return tiktoken.Encoding("own", pat_str=tokens.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


def test_whole_texts_equal_another_encoder(spark, exact):
    data = list(enumerate(ODD)) + [(1, "again")]
    df = spark.createDataFrame(data, "doc_id long, text string").selectExpr("*", "1 as ids")
    got = sorted((r["doc_id"], tuple(r["ids"])) for r in tokens.encode(df, "doc_id", "text").collect())
    assert got == sorted((i, tuple(exact(t or ""))) for i, t in data)
    n = {r["doc_id"]: r["tokens"] for r in tokens.count_tokens(df.filter("text is null or text <> 'again'"), ["doc_id"], "text").collect()}
    assert n == {i: len(exact(t or "")) for i, t in enumerate(ODD)}
    assert tokens.encode(df.limit(0), "doc_id", "text").count() == 0


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(max_size=40), max_size=8))
def test_any_text(ranks, exact, tmp_path_factory, texts):
    f = tmp_path_factory.mktemp("a") / "lexicon"
    words = {w.encode() for t in texts[:3] for w in regex.findall(tokens.PATTERN, t)}
    f.write_bytes(to_bytes(build({w: tokens.merge(w, ranks) for w in words})))
    tools = (Automaton(str(f)), ranks, regex.compile(tokens.PATTERN), {})
    ids = [i for _, x in tokens.encode_texts(texts, tools) for i in x.tolist()]
    assert ids == [i for t in texts for i in exact(t)]


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.binary(min_size=1, max_size=6), st.lists(st.integers(0, 9), min_size=1, max_size=3), max_size=40), st.lists(st.binary(max_size=6), max_size=10))
def test_automaton_holds_exactly_its_words(tmp_path_factory, words, others):
    f = tmp_path_factory.mktemp("a") / "x"
    f.write_bytes(to_bytes(build(words)))
    a = Automaton(str(f))
    ask = list(words) + others
    for w, r in zip(ask, a.ranks(ask).tolist(), strict=True):
        assert (a.output(r) if r >= 0 else None) == words.get(w)


def test_automaton_shares_suffixes():
    words = {f"{a}ing".encode(): [i] for i, a in enumerate(("walk", "talk", "sing", "play", "read"))}
    assert len(build(words)["base"]) < sum(map(len, words))
