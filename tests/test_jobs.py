"""Files, nested posts, streams, whole jobs."""

import datetime as dt
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from pulse.plans.batch_job import run
from pulse.plans.dashboard import REPORT, dashboard
from pulse.plans.training import train_and_evaluate, training_rows
from pulse.operators.scoring import word_logits
from pulse.functions.text import split_words
from pulse.session import shared_dir
from pulse.sources.feed import POSTS, flatten_posts, join_posts
from pulse.sources.files import SCORED_COMMENT, parse_lines, read_jsonl, read_labelled_csv, write_csv
from pulse.streaming.live import drain, stream_label_counts, stream_score, table_stream

WEIGHTS = {"good": (0.0, 1.0, 0.0), "bad": (0.0, 0.0, 1.0)}
BIAS = (0.5, 0.0, 0.0)


def logits(text):
    return word_logits(split_words(text), WEIGHTS, BIAS)


def test_csv_round_trip_of_awkward_texts(spark, tmp_path):
    rows = [('a, "quoted"\nline', 1), ("", 0), (None, -1), ("back\\slash", None)]
    df = spark.createDataFrame(rows, "text string, sentiment int")
    write_csv(df, str(tmp_path / "c"))
    out = {(r.text or "", r.sentiment) for r in read_labelled_csv(spark, str(tmp_path / "c")).collect()}
    assert out == {(t or "", s) for t, s in rows}


LINES = ['{"text": "a", "label": 0}', '{"text": "b"}', "", "{broken", '{"label": 1, "text": null}',
         '{"text": "c", "label": 2}']


def test_quarantine(spark, tmp_path):
    (tmp_path / "l.jsonl").write_text("\n".join(LINES) + "\n")
    good, bad = read_jsonl(spark, str(tmp_path / "l.jsonl"))
    assert {tuple(r) for r in good.collect()} == {("a", 0), (None, 1), ("c", 2)}
    assert sorted(r.reason for r in bad.collect()) == ["malformed", "malformed", "missing label"]


def test_stop_at_first_malformed_line(spark, tmp_path):
    lines = ['{"text": "t%d", "label": 1}' % i for i in range(2000)]
    lines[1500] = lines[1700] = "{"
    (tmp_path / "a.jsonl").write_text("\n".join(lines))
    (tmp_path / "b.jsonl").write_text(LINES[0])
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")  # many splits of one file
    try:
        good, _ = read_jsonl(spark, str(tmp_path), on_bad="stop")
        assert sorted(r.text for r in good.collect()) == sorted(f"t{i}" for i in range(1500))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_stop_fails_on_a_missing_field(spark, tmp_path):
    (tmp_path / "l.jsonl").write_text("\n".join(LINES))
    with pytest.raises(Exception, match="missing label"):
        read_jsonl(spark, str(tmp_path / "l.jsonl"), on_bad="stop")[0].collect()
    (tmp_path / "m.jsonl").write_text("\n".join([LINES[0], "{", LINES[1]]))
    assert read_jsonl(spark, str(tmp_path / "m.jsonl"), on_bad="stop")[0].count() == 1


def test_parse_lines_keeps_other_columns(spark):
    df = spark.createDataFrame([(7, '{"text": "a", "label": 0}')], "id int, line string")
    good, bad = parse_lines(df, "line", read_jsonl.__defaults__[0])
    assert good.first().asDict() == {"id": 7, "text": "a", "label": 0} and bad.count() == 0


def test_flatten_posts(spark):
    comments = [(0, "pinned", 1712351545, True), (1, "one", 1712351546, False), (2, "two", 1712351547, None)]
    rows = [("p", "c", "T", "S", 1712351545, 3, comments), ("q", "c", "U", "", 1712351545, 2, [])]
    out = flatten_posts(spark.createDataFrame(rows, POSTS), 2)
    assert [(r.post_title, r.comment_text, r.comment_created) for r in out.collect()] == [
        ("T", "one", "2024-04-05 21:12:26")]
    assert flatten_posts(spark.createDataFrame(rows, POSTS)).count() == 2


def test_hot_post_is_split_over_tasks(spark):
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        comments = spark.range(0, 60000, 1, 8).select(
            F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 997).alias("post_id"), "id")
        posts = spark.range(997).select(F.col("id").alias("post_id"), F.lit("t").alias("post_title"))
        out = join_posts(posts, comments)
        assert len(out.collect()) == 60000
        assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def fake_session(master, root):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default: root if key == "spark.checkpoint.dir" else default),
        sparkContext=SimpleNamespace(master=master))


def test_shared_dir_follows_the_session():
    on_cluster = fake_session("yarn", "hdfs://somewhere/")
    a, b = shared_dir(on_cluster, "x"), shared_dir(on_cluster, "x")
    assert a.startswith("hdfs://somewhere/pulse/x-") and a != b
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(fake_session("yarn", None), "x")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(fake_session("local[2]", None), "x")


@pytest.fixture()
def event_files(spark, tmp_path):
    """Five files, the last one holding a row weeks late."""
    start = dt.datetime(2024, 1, 1)
    folder = str(tmp_path / "events")
    rows = []
    for f in range(5):
        part = [(start + dt.timedelta(days=7 * f + d), ("positive", "negative", "other")[d % 3]) for d in range(7)]
        if f == 4:
            part.append((start, "positive"))
        spark.createDataFrame(part, "comment_created timestamp_ntz, sentiment_labels string").coalesce(1).write.mode(
            "append").parquet(folder)
        rows += part
    return folder, rows


def test_stream_equals_batch_in_complete_mode(spark, event_files):
    folder, rows = event_files
    schema = spark.read.parquet(folder).schema
    stream = table_stream(spark, folder, schema, files_per_batch=1)
    out = drain(stream_label_counts(stream, period="W"), "t", "complete").collect()
    want = {}
    for ts, label in rows:
        if label:
            week = (ts - dt.timedelta(days=ts.weekday())).date()
            want[week, label] = want.get((week, label), 0) + 1
    assert {(r.period_date, r.label): r.n for r in out} == want


def test_late_rows_are_dropped_in_append_mode(spark, event_files):
    folder, _ = event_files
    schema = spark.read.parquet(folder).schema
    stream = table_stream(spark, folder, schema, files_per_batch=1)
    out = drain(stream_label_counts(stream, period="W", watermark="1 day"), "t").collect()
    got = {(r.period_date, r.label): r.n for r in out}
    assert got[dt.date(2024, 1, 1), "positive"] == 3  # the late fourth is not counted
    assert dt.date(2024, 1, 29) not in {d for d, _ in got}  # its window is still open


def test_stream_without_input_gives_an_empty_table(spark, event_files):
    folder, _ = event_files
    schema = spark.read.parquet(folder).schema
    for mode in ("append", "complete"):
        stream = table_stream(spark, folder, schema, glob="nothing*")
        assert drain(stream_label_counts(stream), "t", mode).count() == 0


def test_months_are_no_stream_window(spark):
    with pytest.raises(ValueError, match="roll months up"):
        stream_label_counts(spark.createDataFrame([], "comment_created timestamp, sentiment_labels string"), period="M")


def test_stream_score(spark, tmp_path):
    folder = str(tmp_path / "c")
    spark.createDataFrame([("It's GOOD",), ("bad, bad",), ("hm",)], "comment_text string").write.parquet(folder)
    stream = table_stream(spark, folder, spark.read.parquet(folder).schema)
    out = drain(stream_score(stream, WEIGHTS, BIAS).drop("logits"), "t").collect()
    assert {(r.clean_text, r.sentiment_labels) for r in out} == {
        ("it is good", "positive"), ("bad bad", "negative"), ("hm", "neutral")}


@pytest.fixture()
def landed(spark):
    posts = spark.createDataFrame(
        [(1, "In Paris", "Paris and London"), (2, None, "")], "post_id int, post_title string, post_text string")
    comments = spark.createDataFrame(
        [(1, "It's good in London", dt.datetime(2024, 4, 14, 23, 59)), (1, "bad", dt.datetime(2024, 4, 15)),
         (2, "hm\n\"x\"", dt.datetime(2024, 4, 1)), (9, "orphan", dt.datetime(2024, 4, 1))],
        "post_id int, comment_text string, comment_created timestamp_ntz")
    return posts, comments


def test_dashboard(landed):
    d = dashboard(*landed, logits, {"Paris": "GPE", "London": "GPE"}, "W", show_text_analysis=True)
    assert tuple(d.report.columns) == REPORT
    rows = {r.comment_text: r for r in d.report.collect()}
    assert len(rows) == 3
    good = rows["It's good in London"]
    assert (good.sentiment_labels, good.period_int) == ("positive", 2)
    assert good.named_entities == ["Paris", "Paris", "London", "London"]
    assert rows['hm\n"x"'].named_entities == []
    assert d.counts.count() == 3 and d.over_time.count() == 3
    assert {r.word for r in d.words.collect()} == {"good", "london", "bad", "hm", "x"}
    assert d.lengths.agg(F.sum("n")).first()[0] == 3 and d.density.count() == 200
    plain = dashboard(*landed, logits, {}, "W")
    assert plain.words is None and plain.report.count() == 3


def test_batch_job_writes_raw_and_cleaned(spark, landed, tmp_path):
    run(landed[1], logits, str(tmp_path))
    raw = read_labelled_csv(spark, str(tmp_path / "raw_comments"), SCORED_COMMENT[:2])
    cleaned = read_labelled_csv(spark, str(tmp_path / "cleaned_comments"), SCORED_COMMENT)
    assert raw.columns == ["comment_text", "comment_created"] and raw.count() == 4
    rows = {r.comment_text: r for r in cleaned.collect()}
    assert rows['hm\n"x"'].clean_text == 'hm " x "'
    assert (rows["bad"].class_predictions, rows["bad"].period_date, rows["bad"].period_int) == (
        2, dt.date(2024, 4, 15), 3)


def test_training_job(spark):
    rows = [(i, *(("good fine day", 1), ("bad awful day", -1), ("plain old day", 0), ("odd", 5), ("x", 1))[i % 5])
            for i in range(400)]
    df = training_rows(spark.createDataFrame(rows, "id int, text string, sentiment int"), "id", 1)
    assert df.count() == 240  # unknown labels and one-word texts are gone
    _, overall, per_class = train_and_evaluate(df)
    assert overall.first().accuracy == 1.0
    assert per_class.where("label = 'negative'").first().f1 == 1.0
