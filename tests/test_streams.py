"""Streams with state, totals per period, and models that gather rows."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from pulse.operators.aggregates import label_pivot
from pulse.operators.bayes import fit_bayes
from pulse.operators.epochs import Settings, fit_epochs
from pulse.operators.scoring import python_model
from pulse.plans.queries.scores import WordScorer
from pulse.session import shared_dir, whole_tables
from pulse.streaming import jobs
from pulse.streaming.jobs import (
    add_to_totals, batch_rows, first_arrivals, latest, live_job, newer_versions, period_view, run_batches, score_arrivals,
)
from pulse.streaming.live import drain, stream_score, table_stream

COMMENTS = "id long, comment_text string, comment_created timestamp_ntz, sentiment_labels string"


def day(n, hour=0):
    return dt.datetime(2024, 1, 1) + dt.timedelta(days=n, hours=hour)


def pulls(spark, parts, schema=COMMENTS):
    folder = shared_dir(spark, "pulls")
    for rows in parts:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)
    return table_stream(spark, folder, spark.createDataFrame([], schema).schema, files_per_batch=1)


def row(i, n, label="neutral", text="some words"):
    return (i, text, day(n), label)


def test_overlapping_pulls_give_each_comment_once_with_bounded_state(spark):
    parts = [[row(i, i // 10) for i in range(max(0, p * 40 - 25), p * 40 + 40)] for p in range(8)]
    parts[3].append((None, "no time", None, None))
    parts[5] += parts[5][:9]  # repeated within a pull
    stream = first_arrivals(pulls(spark, parts), "id", delay="5 days")
    progress, got = [], []
    writer = stream.writeStream.option("checkpointLocation", shared_dir(spark, "s")).trigger(availableNow=True)
    query = writer.foreachBatch(lambda batch, n: got.extend(r.id for r in batch.collect())).start()
    query.awaitTermination()
    progress = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    assert sorted(got) == list(range(320))
    assert max(progress) < 200  # entries of some days, not of all 32


def test_edits_win_and_repeats_do_not_come_again(spark):
    schema = "id long, v long, edited timestamp_ntz, t string"
    parts = [
        [(1, 1, day(0), "a"), (2, 1, day(0), "b"), (3, 5, day(0), "c"), (None, 1, day(0), "x"), (4, None, day(0), "x")],
        [(1, 1, day(0), "a"), (2, 2, day(1), "b2"), (2, 3, day(1), "b3"), (3, 4, day(1), "old")],
        [(2, 3, day(1), "b3"), (1, 2, day(2), "a2")],
    ]
    stream = newer_versions(pulls(spark, parts, schema), "id", "v", delay="10 days")
    batches = []
    run_batches(stream, shared_dir(spark, "s"), lambda b, n: batches.append(sorted((r.id, r.v, r.t) for r in b.collect())))
    assert [b for b in batches if b] == [[(1, 1, "a"), (2, 1, "b"), (3, 5, "c")], [(2, 2, "b2"), (2, 3, "b3"), (3, 4, "old")], [(1, 2, "a2")]]
    rows = spark.createDataFrame([r for b in batches for r in b], "id long, v long, t string")
    assert sorted(map(tuple, latest(rows, "id", "v").collect())) == [(1, 2, "a2"), (2, 3, "b3"), (3, 5, "c")]


def test_forgotten_keys_leave_the_state(spark):
    schema = "id long, v long, edited timestamp_ntz"
    stream = newer_versions(pulls(spark, [[(i, 1, day(i * 3)) for i in range(p * 20, p * 20 + 20)] for p in range(6)], schema), "id", "v", delay="3 days")
    query = stream.writeStream.option("checkpointLocation", shared_dir(spark, "s")).foreachBatch(lambda b, n: b.count()).trigger(availableNow=True).start()
    query.awaitTermination()
    assert [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]][-1] < 60


def labelled(n=300):
    rng = np.random.default_rng(2)
    names = [None, "negative", "neutral", "positive", "mixed"]
    return [row(i, int(rng.integers(0, 60)), names[int(rng.integers(5))]) for i in range(n)] + [(n, "no time", None, "neutral"), row(n + 1, 400, None)]


@pytest.mark.parametrize("snapshot", [50, 2])
def test_totals_of_files_late_rows_and_repeated_batches_are_those_of_the_table(spark, monkeypatch, snapshot):
    monkeypatch.setattr(jobs, "SNAPSHOT", snapshot)
    rows = labelled()
    parts = [[r for r in rows if r[0] % 5 == p and r[0] != 7] for p in range(5)] + [[rows[7]]]
    sink = shared_dir(spark, "totals")

    def each(batch, number):
        for _ in range(2 if number in (1, 4) else 1):
            add_to_totals(batch, number, sink, "comment_created", "sentiment_labels", "W")
        # a batch that was cut off while it was written is not read
        spark.range(1).selectExpr("id AS n").write.mode("overwrite").parquet(f"{sink}/batch=9999999999")
        jobs.delete_folder(spark, f"{sink}/batch=9999999999/_SUCCESS")

    run_batches(pulls(spark, parts), shared_dir(spark, "s"), each)
    for other in (None, "other"):
        want = label_pivot(spark.createDataFrame(rows, COMMENTS), other=other)
        got = period_view(spark, sink, other=other)
        assert got.columns == want.columns and [f.dataType for f in got.schema] == [f.dataType for f in want.schema]
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert len(whole_tables(spark, f"{sink}/batch=*")) <= (6 if snapshot == 50 else 4)


def test_a_batch_repeated_after_a_failure_counts_once(spark):
    rows, sink, state = labelled(), shared_dir(spark, "totals"), shared_dir(spark, "s")
    stream = pulls(spark, [rows[:100], rows[100:200], rows[200:]])

    def failing(batch, number):
        add_to_totals(batch, number, sink, "comment_created", "sentiment_labels", "D")
        if number == 1:
            raise RuntimeError("lost")

    with pytest.raises(Exception, match="lost"):
        run_batches(stream, state, failing)
    run_batches(stream, state, lambda b, n: add_to_totals(b, n, sink, "comment_created", "sentiment_labels", "D"))
    want = label_pivot(spark.createDataFrame(rows, COMMENTS), period="D")
    assert sorted(map(tuple, period_view(spark, sink).collect())) == sorted(map(tuple, want.collect()))


def models(spark):
    texts = spark.createDataFrame([(i, ["good fine", "awful bad", "plain words"][i % 3], [1, 2, 0][i % 3], ["train", "val"][i % 7 == 0]) for i in range(60)],
                                  "id long, clean_text string, label int, split string")
    bayes = fit_bayes(texts, "serving")
    epochs = fit_epochs(texts, "id", shared_dir(spark, "epochs"), "serving", Settings(epochs=3, batch_rows=100, rate=0.3, bits=8))
    return {"bayes": bayes.as_model("id"), "epochs": epochs.as_model(), "python": python_model(WordScorer())}


def test_every_kind_of_model_scores_a_stream(spark):
    rows = [row(i, 0, text=t) for i, t in enumerate(["Good, fine!", "awful", "bad bad plain", None, ""])]
    table = spark.createDataFrame(rows, COMMENTS)
    for name, model in models(spark).items():
        folder = shared_dir(spark, "scored")
        out = score_arrivals(pulls(spark, [rows[:3], rows[3:]]), model, folder, shared_dir(spark, "s"))
        from pulse.functions.binding import once
        from pulse.functions.text import normalize

        want = model.apply(once(table, clean_text=normalize(F.col("comment_text"), model.profile, model.lemmas))).collect()
        got = {r.id: r for r in out.collect()}
        assert {r.id: r.logits for r in want} == {i: r.logits for i, r in got.items()} and len(got) == 5
        assert {r.sentiment_labels for r in got.values()} <= {"neutral", "positive", "negative"}
        if name != "bayes":
            rowwise = drain(stream_score(pulls(spark, [rows]), model=model).select("id", "logits"), "t").collect()
            assert {r.id: r.logits for r in rowwise} == {r.id: r.logits for r in want}
    assert score_arrivals(pulls(spark, [[]]).where("false"), models(spark)["python"], shared_dir(spark, "n"), shared_dir(spark, "s")).count() == 0


def test_live_job_from_pulls_to_the_period_table(spark):
    rows = [row(i, i // 20, text=["good fine", "awful bad", "plain"][i % 3]) for i in range(90)]
    folder, model = shared_dir(spark, "live"), models(spark)["bayes"]
    live_job(pulls(spark, [rows[:40], rows[25:70], rows[60:]]).drop("sentiment_labels"), folder, model, "id", delay="30 days")
    scored = batch_rows(spark, f"{folder}/scored", "id long, sentiment_labels string, comment_created timestamp_ntz")
    assert sorted(r.id for r in scored.collect()) == list(range(90))
    want = label_pivot(scored, period="D")
    got = period_view(spark, f"{folder}/totals")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and got.count() == 5
