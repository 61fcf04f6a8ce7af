import pytest
from pyspark.sql import functions as F

from pulse.functions import text as T
from pulse.functions.wordlists import SEED_LEMMAS
from pulse.operators.datasets import length_filter
from pulse.operators.lexicon import apply_lexicon, drop_listed, lemma_counts, unlisted_words


def one(spark, expr, text):
    df = spark.createDataFrame([(text,)], "t string")
    return df.select(expr(F.col("t"))).first()[0]


@pytest.mark.parametrize("profile, text, clean", [
    ("serving", "See https://a.b/c?d=1 NOW, ok?", "see now ok "),
    ("serving", "http://only.example", " "),
    ("serving", "x http://a b", "x b"),
    ("serving", "Café \U0001f600 1-2", "caf 1 2"),
    ("serving", "", ""),
    ("serving", None, None),
    ("batch", "Wait... \"what\"?! (no)\n- x; y: z's", "wait... \"what\"?! no - x; y: z s"),
    ("training", "ahttp://x b, it's #1", "a b, it's 1"),
    ("training", "http://x\ny", " y"),
    ("emotion", "I think the cat, the dog and HE", "think cat, dog"),
    ("emotion", "the, x", "the, x"),
])
def test_clean(spark, profile, text, clean):
    stop = ["i", "the", "and", "he"]
    assert one(spark, lambda c: T.clean(c, profile, stop), text) == clean


def test_unknown_profile():
    with pytest.raises(ValueError, match="unknown profile"):
        T.clean(F.lit("x") if False else None, "other")


@pytest.mark.parametrize("text, full", [
    ("they’re here, don't", "they are here, do not"),
    ("CAN'T Won't shan't", "can not will not shall not"),
    ("can't can't can't", "can not can not can not"),
    ("it's a cat's day; that's it", "it is a cat's day; that is it"),
    ("I'm, you'd, we'll, I've", "I am, you would, we will, I have"),
    ("5'm x'mas o'clock", "5'm x'mas o'clock"),
    ("plain", "plain"),
    ("", ""),
    (None, None),
])
def test_expand_contractions(spark, text, full):
    assert one(spark, T.expand_contractions, text) == full


@pytest.mark.parametrize("text, n", [
    ("", 0), ("   ", 0), (" a  b ", 2), ("a b　c\x1cd", 4), ("one", 1), (None, None),
])
def test_token_count(spark, text, n):
    assert one(spark, T.token_count, text) == n


def test_tokens_split_punctuation(spark):
    assert one(spark, T.tokens, "post-grad, it's .") == ["post", "-", "grad", ",", "it", "'", "s", "."]


def test_normalize_batch(spark):
    text = "Its students don’t care bc the mice were loud - https://x.y/z\nWas it us?"
    assert one(spark, lambda c: T.normalize(c, "batch", SEED_LEMMAS), text) == (
        "it student do not care because the mouse were loud - wa it u ?")


def test_drop_stopwords_keeps_repeats(spark):
    assert one(spark, lambda c: T.drop_stopwords(c, ["the"]), " b the b  a the,") == "b b a the,"


def test_length_filter_bounds(spark):
    texts = [" ".join(["w"] * n) for n in (0, 1, 2, 1000, 1001)]
    df = spark.createDataFrame([(t,) for t in texts] + [(None,)], "text string")
    assert sorted(r.text_len for r in length_filter(df).collect()) == [2, 1000]


def test_filters_do_not_repeat_text_work(spark):
    df = spark.createDataFrame([("a b c",)], "text string")
    cleaned = df.withColumn("text", T.clean(F.col("text"), "serving"))
    plan = length_filter(cleaned)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_replace(regexp_replace(") == 1


def test_lexicon_table(spark):
    rows = spark.createDataFrame(
        [(1, ["cannot", "mice", "x"]), (2, []), (3, ["x", "x"])], "id int, w array<string>")
    # the token mice is listed twice
    lexicon = spark.createDataFrame(
        [("cannot", "can not"), ("mice", "mouse"), ("mice", "zz")], "token string, replacement string")
    out = {r.id: r.w for r in apply_lexicon(rows, "id", "w", lexicon).collect()}
    assert out == {1: ["can", "not", "mouse", "x"], 2: [], 3: ["x", "x"]}


def test_listed_words(spark):
    rows = spark.createDataFrame([(1, "a b a c"), (2, "")], "id int, t string")
    listed = spark.createDataFrame([("a",), ("a",)], "word string")
    assert {r.id: r.t for r in drop_listed(rows, "id", "t", listed).collect()} == {1: "b c", 2: ""}
    counts = spark.createDataFrame([("a", 3), ("mice", 2), ("mouse", 1)], "word string, n long")
    assert sorted(r.word for r in unlisted_words(counts, listed).collect()) == ["mice", "mouse"]
    lexicon = spark.createDataFrame([("mice", "mouse")], "token string, replacement string")
    assert {(r.word, r.n) for r in lemma_counts(counts, lexicon).collect()} == {("a", 3), ("mouse", 3)}


def test_words_are_matched_by_numbers(spark):
    from pulse.functions.wordarrays import looked_up, tallied

    rows = [(["a", "b", "a", None], ["a", "c"], ["x", "y"]), ([], ["a"], ["z"]), (None, ["a"], ["z"]), (["c", "a"], [], []), (["b", "a"], ["b"], ["w"])]
    df = spark.createDataFrame(rows, "w array<string>, t array<string>, v array<string>").coalesce(1)
    got = df.select(looked_up(F.col("w"), F.col("t"), F.col("v"), "string").alias("l"), tallied(F.col("w")).alias("n")).collect()
    assert [r.l for r in got] == [["x", None, "x", None], [], [], [None, None], ["w", None]]
    assert [[tuple(p) for p in r.n] for r in got] == [[("a", 2), ("b", 1), (None, 1)], [], [], [("c", 1), ("a", 1)], [("b", 1), ("a", 1)]]


def test_long_and_short_lists_drop_the_same_words(spark, monkeypatch):
    from pulse.operators import lexicon

    rows = spark.createDataFrame([(1, "a b  a c"), (2, ""), (3, None), (4, "a"), (5, "d")], "id int, t string")
    listed = spark.createDataFrame([("a",), ("a",), (None,), ("c",)], "word string")
    want = {1: "b", 2: "", 3: "", 4: "", 5: "d"}
    short = drop_listed(rows, "id", "t", listed)
    assert {r.id: r.t for r in short.collect()} == want
    assert "Exchange" not in short._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(lexicon, "SHORT_LIST", 1)
    long = drop_listed(rows, "id", "t", listed)
    assert {r.id: r.t for r in long.collect()} == want
    # the words of a text are not searched one by one in a map
    assert "map_from_entries" not in long._jdf.queryExecution().executedPlan().toString()
