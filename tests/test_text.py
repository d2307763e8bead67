from pyspark.sql import functions as F

from millrace.functions import lexical, numbers, text


def one(spark, value, col, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(col.alias("v")).first()[0]


def test_keys(spark):
    assert one(spark, "  A\t b C \n", text.text_key("x")) == "a b c"
    assert one(spark, " \t", text.blank_to_null("x")) is None
    assert one(spark, " Harbor  Queue ", text.model_key("x")) == "harbor__queue"
    assert one(spark, " Harbor \t Queue ", text.snake("x")) == "harbor_queue"
    assert one(spark, None, text.text_key("x")) is None
    assert one(spark, "x" * 200_000 + " ", text.squeeze("x")) == "x" * 200_000


def test_tokens_lose_a_last_question_mark_but_spans_keep_it(spark):
    assert one(spark, "sick? true, foo-bar- baz?x", lexical.identifier_tokens("x")) == ["sick", "true", "foo-bar", "baz?", "x"]
    assert one(spark, "`sick?` and ```\n`no`\n``` `two words`", lexical.backticked_identifiers("x")) == ["sick?"]
    assert one(spark, None, lexical.terms("x")) == []


def test_ngrams_of_short_lists(spark):
    assert one(spark, "alpha", lexical.word_ngrams("x")) == []
    assert one(spark, "alpha beta gamma", lexical.word_ngrams("x")) == ["alpha beta", "beta gamma", "alpha beta gamma"]


def test_sentences_and_tags(spark):
    assert one(spark, "One. Two! Three\nfour", lexical.sentences("x")) == ["One.", "Two!", "Three", "four"]
    assert one(spark, ["a", "LEVEL: L2 ", "level:L3"], lexical.tag_value("x", "level"), "array<string>") == " L2 "


def test_tier_nan_is_c(spark):
    got = [one(spark, v, numbers.tier_of("x"), "double") for v in (0.85, 0.82, 0.80, 0.78, 0.70, float("nan"), None)]
    assert got == ["A", "A", "B", "B", "C", "C", None]


def test_sha1_mod_equals_big_numbers(spark):
    import hashlib

    for s in ("", "a|b", "é"):
        n = int(hashlib.sha1(s.encode()).hexdigest(), 16)
        assert one(spark, s, numbers.sha1_mod(F.col("x"), 100)) == n % 100
        assert one(spark, s, numbers.sha1_mod(F.col("x"), 1000)) == n % 1000


def test_coercion_and_lerp(spark):
    assert [one(spark, v, numbers.to_bool("x")) for v in ("true", "0", " Y ", "maybe", None)] == [True, False, True, None, None]
    assert one(spark, 0.5, numbers.lerp_int(2, 7, F.col("x")), "double") == 4
