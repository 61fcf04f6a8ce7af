"""Labels, vectors, scorers, evaluation, encoding, entities."""

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from pulse.functions.labels import EMOTIONS, SENTIMENTS, decode, encode_labels
from pulse.functions.vectors import argmax, linear, one_hot, softmax

from pulse.operators.encoding import build_vocab, encode
from pulse.operators.entities import entity_counts, extract, mentions, mentions_in
from pulse.operators.evaluate import best_run, last_is_best, metrics, report
from pulse.operators.scoring import column_model, python_model, score, with_predictions, word_logits
from pulse.operators.train import Fitted, baseline, fit
from pulse.plans.dashboard import enrich


def test_label_codings(spark):
    df = spark.createDataFrame([(-1,), (0,), (1,), (7,), (None,)], "v int")
    rows = df.select(encode_labels(F.col("v")), decode(F.col("v")), decode(F.col("v"), EMOTIONS)).collect()
    assert [r[0] for r in rows] == [2, 0, 1, None, None]
    assert [r[1] for r in rows] == [None, "neutral", "positive", None, None]
    assert [r[2] for r in rows] == [None, "Sadness", "Joy", None, None]


def test_vectors(spark):
    df = spark.createDataFrame([([1000.0, 1000.0, -5.0], 2), ([0.0, 3.0, 3.0], None)], "z array<double>, y int")
    rows = df.select(
        softmax(F.col("z"), 3).alias("p"), argmax(F.col("z")).alias("k"), one_hot(F.col("y"), 3).alias("h"),
        linear(F.col("z"), [[1, 0, 0], [0, 0.5, 1]], [0.0, 1.0]).alias("l")).collect()
    assert np.allclose(rows[0].p, [0.5, 0.5, 0]) and abs(sum(rows[1].p) - 1) < 1e-12
    assert [r.k for r in rows] == [0, 1]
    assert [r.h for r in rows] == [[0.0, 0.0, 1.0], None]
    assert rows[1].l == [0.0, 5.5]


def test_word_logits_count_repeats(spark):
    df = spark.createDataFrame([(["a", "b", "a", "x"],), ([],)], "w array<string>")
    z = word_logits(F.col("w"), {"a": (1, 0), "b": (0, 2)}, (0.5, 0))
    assert [r[0] for r in df.select(z).collect()] == [[2.5, 2.0], [0.5, 0.0]]


def test_python_scorer(spark):
    # a local class travels by value
    class LengthScorer:
        name = "length"

        def load(self):
            return lambda texts: np.stack([texts.str.len(), -texts.str.len()], axis=1)

    df = spark.createDataFrame([(1, "ab"), (2, "")], "id int, clean_text string")
    out = with_predictions(score(df, LengthScorer()), names=("long", "short"))
    assert [(r.id, r.logits, r.sentiment_labels) for r in out.orderBy("id").collect()] == [
        (1, [2.0, -2.0], "long"), (2, [0.0, -0.0], "long")]


def test_metrics_by_hand(spark):
    z = np.array([[2.0, 0.1, 0.0], [0.6, 0.7, 0.1], [0.0, 0.2, 0.4], [0.1, 0.9, 0.3]])
    y = [0, 0, 2, 1]
    df = spark.createDataFrame([(int(a), list(map(float, b))) for a, b in zip(y, z)], "y int, z array<double>")
    p = np.exp(z) / np.exp(z).sum(1, keepdims=True)
    hot = np.eye(3)[y] > 0
    for cut, cells in (("logit", z), ("probability", p)):
        row = metrics(df, "y", "z", 3, cut).first()
        tp, called = ((cells > 0.5) & hot).sum(), (cells > 0.5).sum()
        pr, re = tp / called, tp / len(y)
        assert np.allclose(list(row), [
            -np.log(p[range(4), y]).mean(), (z.argmax(1) == y).mean(), pr, re, 2 * pr * re / (pr + re)])


def test_report_with_a_class_never_predicted(spark):
    df = spark.createDataFrame([(0, 0), (0, 1), (1, 1), (2, 1)], "y int, p int")
    rows = {r.label: tuple(r)[1:] for r in report(df, "y", "p", SENTIMENTS).collect()}
    assert rows["negative"] == (0.0, 0.0, 0.0, 1.0)
    assert np.allclose(rows["neutral"], (1.0, 0.5, 2 / 3, 2))
    assert np.allclose(rows["positive"], (1 / 3, 1.0, 0.5, 1))
    assert rows["accuracy"] == (0.5, 0.5, 0.5, 0.5)
    assert np.allclose(rows["macro avg"], (4 / 9, 0.5, 7 / 18, 4))
    assert np.allclose(rows["weighted avg"], (7 / 12, 0.5, 11 / 24, 4))


def test_model_selection(spark):
    runs = spark.createDataFrame(
        [("a", 1, 0.5), ("a", 2, 0.9), ("b", 1, 0.9), ("b", 2, 0.8), ("b", 3, None)],
        "run string, epoch int, val_accuracy double")
    assert tuple(best_run(runs).first()) == ("b", 1, 0.9)
    assert {r.run: r.keep for r in last_is_best(runs.dropna()).collect()} == {"a": True, "b": False}


def test_fit_remembers_profile(spark, tmp_path):
    rows = [("good fine", 1), ("bad awful", 0), ("good nice", 1), ("awful poor", 0)] * 4 + [(None, 1)]
    df = spark.createDataFrame(rows, "clean_text string, label int")
    fitted = fit(df, "training", estimator=baseline("clean_text", 64, 5))
    with pytest.raises(ValueError, match="trained on 'training'"):
        fitted.predict(df, "serving")
    fitted.save(str(tmp_path / "m"))
    again = Fitted.load(spark, str(tmp_path / "m"))
    out = with_predictions(again.predict(df.dropna(), "training"))
    # the third class never occurred, and is never predicted
    assert out.where("class_predictions <> label").count() == 0
    assert {len(r.logits) for r in out.collect()} == {3}


def test_encoding(spark):
    df = spark.createDataFrame(
        [(1, ["b", "a", "b"]), (2, []), (3, list("abcdefghij")), (4, None)], "id int, w array<string>")
    vocab = build_vocab(df, "w", 7)
    assert [(r.token, r.id) for r in vocab.orderBy("id").collect()] == [("b", 5), ("a", 6)]
    out = {r.id: (r.input_ids, r.attention_mask) for r in encode(df, "id", "w", vocab, 6).collect()}
    assert out[1] == ([2, 5, 6, 5, 3, 0], [1, 1, 1, 1, 1, 0])
    assert out[2] == out[4] == ([2, 3, 0, 0, 0, 0], [1, 1, 0, 0, 0, 0])
    assert out[3] == ([2, 6, 5, 1, 1, 3], [1] * 6)


GAZETTEER = {"New York": "GPE", "York": "GPE", "New York Times": "ORG", "Times Square": "GPE",
             "Monday": "DATE", "A": "PERSON"}
TEXTS = [
    ("New York Times in York, New York", ["New York Times", "York", "New York"]),
    ("New York Times Square", ["New York Times", "Times Square"]),
    ("new york A A Monday", ["A", "A"]),
    ("", []),
    (None, []),
    ("York", ["York"]),
]


def test_entities_inline_and_joined(spark):
    rows = [(i, t) for i, (t, _) in enumerate(TEXTS)]
    df = spark.createDataFrame(rows, "id int, t string")
    table = spark.createDataFrame(list(GAZETTEER.items()), "phrase string, type string")
    joined = {r.id: r.named_entities for r in extract(df, "id", ["t"], table).collect()}
    inline = df.select("id", mentions_in(F.coalesce("t", F.lit("")), GAZETTEER).alias("e")).collect()
    for i, (_, want) in enumerate(TEXTS):
        assert joined[i] == want
    assert {r.id: r.e for r in inline} == joined
    counts = {(r.phrase, r.type): r.n for r in entity_counts(mentions(df, "id", ["t"], table)).collect()}
    assert counts[("New York Times", "ORG")] == 2 and ("Monday", "DATE") not in counts


def test_one_way_for_gazetteers_of_any_size(spark):
    df = spark.createDataFrame(list(enumerate(t for t, _ in TEXTS)), "id int, t string")
    table = spark.createDataFrame(list(GAZETTEER.items()), "phrase string, type string")
    large = table.union(spark.range(5000).select(F.concat(F.lit("First"), "id", F.lit(" last")), F.lit("ORG")))
    for gazetteer in (table, large):
        out = {r.id: r.named_entities for r in extract(df, "id", ["t"], gazetteer).collect()}
        assert [out[i] for i in range(len(TEXTS))] == [want for _, want in TEXTS]


def constant(value):
    class Constant:  # local, so that it travels to the workers by value
        name = "m"

        def load(self):
            return lambda batch: [[value, 0.0, 0.0]] * len(batch)

    return Constant()


def test_a_model_trained_anew_under_its_name_is_loaded(spark):
    df = spark.createDataFrame([("a",)], "clean_text string")
    for value in (1.0, 2.0, 1.0):
        assert score(df, constant(value)).first().logits == [value, 0.0, 0.0]


def test_jobs_take_any_model(spark):
    df = spark.createDataFrame([("GOOD day",), (None,)], "comment_text string")
    models = [python_model(constant(3.0)), column_model(lambda t: F.array(F.lit(3.0), F.lit(0.0), F.lit(0.0)))]
    got = [[(r.clean_text, r.class_predictions, r.sentiment_labels) for r in enrich(df, m).collect()] for m in models]
    assert got[0] == got[1] and got[0][0][1:] == (0, "neutral")


def test_a_fitted_model_brings_its_cleaning(spark, tmp_path):
    rows = spark.createDataFrame([("fine dogs", 1), ("bad cats", 2)] * 10, "clean_text string, label int")
    fitted = fit(rows, "training", lemmas={"dogs": "dog"})
    fitted.save(str(tmp_path / "m"))
    model = type(fitted).load(spark, str(tmp_path / "m")).as_model()
    assert (model.profile, model.lemmas) == ("training", {"dogs": "dog"})
    got = enrich(spark.createDataFrame([("fine dogs",)], "comment_text string"), model).first()
    assert got.clean_text == "fine dog" and got.sentiment_labels == "positive"


def test_metrics_leave_out_rows_without_a_class_or_logits(spark):
    rows = [(0, [2.0, 0.0, 0.0]), (3, [0.0, 0.0, 1.0]), (-1, [0.0, 0.0, 1.0]), (None, [0.0, 0.0, 1.0]), (1, [1.0]), (1, None)]
    got = metrics(spark.createDataFrame(rows, "y int, z array<double>"), "y", "z", 3, left_out="skipped").first()
    assert got.skipped == 5 and got.accuracy == 1.0 and got.recall == 1.0 and got.precision == 1.0


def test_entities_of_several_columns_keep_order(spark):
    df = spark.createDataFrame([(1, "A", None, "York A")], "id int, t string, b string, c string")
    table = spark.createDataFrame([("A", "PERSON"), ("A", "ORG"), ("York", "GPE")], "phrase string, type string")
    assert extract(df, "id", ["t", "b", "c"], table).first().named_entities == ["A", "A", "York", "A", "A"]


def _executed(df):
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    return re.sub(r"#\d+L?", "", plan.split("== Initial Plan ==")[0])


def test_dictionaries_and_words_are_looked_up_in_one_flow(spark, tmp_path):
    from pulse.functions.text import clean, split_words
    from pulse.operators.bayes import fit_bayes
    from pulse.operators.lexicon import apply_lexicon

    rows = [(i, f"Some words, no {i % 7} words") for i in range(50)] + [(50, None), (51, "")]
    spark.createDataFrame(rows, "id long, text string").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t")).select("id", clean(F.col("text")).alias("clean_text"))
    lexicon = spark.createDataFrame([("words", "word"), ("no", "not any")], "token string, replacement string")
    rewritten = apply_lexicon(df.select("id", split_words(F.col("clean_text")).alias("w")), "id", "w", lexicon)
    model = fit_bayes(df.withColumn("label", (F.col("id") % 3).cast("int")), "serving")
    for out in (rewritten, model.predict(df, "id")):
        plan = _executed(out)
        assert plan.count("regexp_replace(regexp_replace(text") == 1 and plan.count("[id,text]") == 1
        assert plan.count("Exchange hashpartitioning") == 1 and out.count() == 52
    got = {r.id: r.w for r in rewritten.collect()}
    assert got[0] == ["some", "word", "not", "any", "0", "word"] and got[50] == [] == got[51]


def test_bayes_keeps_every_column_and_row(spark):
    from pulse.operators.bayes import fit_bayes

    df = spark.createDataFrame([(1, "a b a", 0, "x"), (2, "b", 1, None), (3, None, 2, "z"), (4, "", 0, "w"), (5, "new", 1, "v")],
                               "id long, clean_text string, word int, z0 string")
    model = fit_bayes(df, "serving", label_col="word")
    out = model.predict(df, "id")
    assert out.columns == [*df.columns, "logits"]
    rows = {r.id: r for r in out.collect()}
    assert {i: (r.clean_text, r.word, r.z0) for i, r in rows.items()} == {r.id: (r.clean_text, r.word, r.z0) for r in df.collect()}
    assert rows[3].logits == rows[4].logits == list(model.priors)
    weight = {r.word: r for r in model.words.collect()}
    assert abs(rows[1].logits[0] - (model.priors[0] + 2 * weight["a"].z0 + weight["b"].z0)) < 1e-12


def test_greedy_mentions_do_not_overlap(spark):
    texts = ["New York Times Square York", "York New York Times in Times Square", "", None, "A A A B A", "New York Times Square Garden"]
    phrases = {"New York": "GPE", "New York Times": "ORG", "Times Square": "GPE", "Square Garden": "ORG", "A A": "ORG", "A": "PERSON", "York": "GPE"}
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    table = spark.createDataFrame([*phrases.items(), ("A A", "GPE")], "phrase string, type string")

    def greedy(text):
        words, at, out = (text or "").split(), 0, []
        while at < len(words):
            size = next((n for n in (3, 2, 1) if at + n <= len(words) and " ".join(words[at:at + n]) in phrases), 0)
            if size:
                found = " ".join(words[at:at + size])
                out += [(at, size, found)] * (2 if found == "A A" else 1)
            at += size or 1
        return out

    got = {}
    for r in mentions(df, "id", ["t"], table, overlap="greedy").collect():
        got.setdefault(r.id, []).append((r.start, r.size, r.phrase))
    assert {i: sorted(v) for i, v in got.items()} == {i: greedy(t) for i, t in enumerate(texts) if greedy(t)}
    lists = {r.id: r.named_entities for r in extract(df, "id", ["t"], table, overlap="greedy").collect()}
    assert lists == {i: [p for _, _, p in greedy(t)] for i, t in enumerate(texts)}
    covered = {r.id: r.named_entities for r in extract(df, "id", ["t"], table).collect()}
    assert covered[0] == ["New York Times", "Times Square", "York"] and lists[0] == ["New York Times", "York"]
    with pytest.raises(ValueError):
        extract(df, "id", ["t"], table, overlap="none")


def test_mentions_meet_their_text_in_one_exchange(spark, tmp_path):
    spark.createDataFrame([(i, "York and New York") for i in range(40)], "id long, t string").write.parquet(str(tmp_path / "t"))
    table = spark.createDataFrame([("New York", "GPE"), ("York", "GPE")], "phrase string, type string")
    plan = _executed(extract(spark.read.parquet(str(tmp_path / "t")), "id", ["t"], table))
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("[id,t]") == 1 + plan.count("Project [id,t]")


def test_lemmas_of_the_corpus_itself(spark):
    from pulse.operators.lexicon import own_lemmas

    rows = [(1, "Cats and a cat", 7), (2, "Dogs only dogs, children", 8), (3, None, 9), (4, "", 1), (5, "bus buses", 2)]
    df = spark.createDataFrame(rows, "id long, comment_text string, values int")
    model = column_model(lambda t: F.array(F.lit(0.0), F.lit(0.0), F.lit(0.0)), rewrite=own_lemmas("id", {"children": "child"}))
    got = {r.id: (r.clean_text, r["values"]) for r in enrich(df, model).collect()}
    # the stem of dogs is no word here; a lexicon from elsewhere knows it
    assert got == {1: ("cat and a cat", 7), 2: ("dogs only dogs child", 8), 3: ("", 9), 4: ("", 1), 5: ("bus bus", 2)}
    known = spark.createDataFrame([("dog",)], "word string")
    other = column_model(lambda t: F.array(F.lit(0.0)), names=("only",), rewrite=own_lemmas("id", known=known))
    assert {r.id: r.clean_text for r in enrich(df, other).collect()}[2] == "dog only dog children"


def test_bayes_looks_up_distinct_words_of_a_text(spark):
    from pulse.operators.bayes import fit_bayes

    df = spark.createDataFrame([(1, "a b " * 500, 0), (2, "b", 1), (3, "new " * 9 + "a", 2)], "id long, clean_text string, label int")
    model = fit_bayes(df.where("id < 3"), "serving")
    out = model.predict(df, "id")
    rows = {r.id: r.logits for r in out.collect()}
    z = {r.word: [r.z0, r.z1, r.z2] for r in model.words.collect()}
    assert all(abs(rows[1][i] - model.priors[i] - 500 * (z["a"][i] + z["b"][i])) < 1e-9 for i in range(3))
    assert all(abs(rows[3][i] - model.priors[i] - z["a"][i]) < 1e-9 for i in range(3))
    # words are counted in their row before they are spread
    assert "tally(" in out._jdf.queryExecution().executedPlan().toString()
