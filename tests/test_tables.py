"""Periods, counts, top rows, samples."""

import datetime as dt
import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from pulse.functions.periods import epoch_to_string, parse_timestamp, period_start
from pulse.operators.aggregates import label_counts, label_pivot, length_density, length_hist, top_words
from pulse.operators.datasets import exact_sample, exact_split, hash_sample, split
from pulse.operators.periods import with_period
from pulse.operators.topn import drop_stickied, top_n_per_group, top_n_per_post, top_posts

# Synthetic comments with the weekly counts of the published sample: (day, label, how many).
SAMPLE = [
    ("2024-04-04 21:14:26", "negative", 3), ("2024-04-06 04:38:05", "negative", 3),
    ("2024-04-06 09:57:59", "neutral", 1), ("2024-04-07 23:59:59", "positive", 6),
    ("2024-04-08 00:00:00", "negative", 1), ("2024-04-14 16:10:13", "negative", 3),
    ("2024-04-14 18:35:58", "positive", 4), ("2024-04-16 23:53:01", "neutral", 1),
]


@pytest.fixture(scope="module")
def sample(spark):
    rows = [(t, s) for t, s, n in SAMPLE for _ in range(n)] + [(None, "neutral")]
    df = spark.createDataFrame(rows, "t string, sentiment_labels string")
    return df.withColumn("comment_created", parse_timestamp(F.col("t")))


def test_weekly_table(sample):
    rows = [tuple(r) for r in label_pivot(sample).orderBy("period_int").collect()]
    assert rows == [
        (1, dt.date(2024, 4, 1), 6, 1, 6, 13),
        (2, dt.date(2024, 4, 8), 4, 0, 4, 8),
        (3, dt.date(2024, 4, 15), 0, 1, 0, 1),
    ]


def test_counts_with_and_without_zeros(sample):
    assert label_counts(sample).count() == 6
    filled = label_counts(sample, zero_fill=True)
    assert filled.count() == 9 and filled.where("n = 0").count() == 3


def test_row_periods_keep_rows_without_time(sample):
    out = with_period(sample, "comment_created", "W")
    assert out.columns[-2:] == ["period_date", "period_int"]
    assert Counter(r.period_int for r in out.collect()) == {1: 13, 2: 8, 3: 1, None: 1}


def test_rank_does_not_gather_rows(sample):
    plan = with_period(sample, "comment_created", "D")._jdf.queryExecution().executedPlan().toString()
    # one partition ranks the distinct starts, behind an aggregation, and is broadcast
    rows, starts = plan.split("BroadcastExchange", 1)
    assert "SinglePartition" not in rows and starts.count("SinglePartition") == 1
    assert "HashAggregate" in starts.split("SinglePartition", 1)[1]


@pytest.mark.parametrize("period, day", [
    ("D", "2024-04-14"), ("W", "2024-04-08"), ("M", "2024-04-01")])
def test_period_start(spark, period, day):
    ts = F.lit("2024-04-14 23:59:59").cast("timestamp_ntz")
    assert str(spark.range(1).select(period_start(ts, period)).first()[0]) == day


def test_epoch_in_zone(spark):
    row = spark.range(1).select(
        epoch_to_string(F.lit(1712351545)), epoch_to_string(F.lit(1712351545.9), "America/New_York"),
        epoch_to_string(F.lit(None).cast("long")), parse_timestamp(F.lit("no time"))).first()
    assert tuple(row) == ("2024-04-05 21:12:25", "2024-04-05 17:12:25", None, None)


def texts_of(spark, lengths):
    return spark.createDataFrame([(" ".join(["w"] * n),) for n in lengths], "clean_text string")


def test_histogram_like_numpy(spark):
    rng = random.Random(1)
    lengths = [rng.randint(1, 97) for _ in range(500)]
    n, edges = np.histogram(lengths, bins=30)
    rows = length_hist(texts_of(spark, lengths)).orderBy("bin").collect()
    assert [r.n for r in rows] == n.tolist()
    assert np.allclose([r.bin_lo for r in rows] + [rows[-1].bin_hi], edges)


def test_histogram_of_equal_lengths(spark):
    rows = length_hist(texts_of(spark, [4, 4, 4]), bins=2).orderBy("bin").collect()
    assert [(r.bin_lo, r.bin_hi, r.n) for r in rows] == [(3.5, 4.0, 0), (4.0, 4.5, 3)]
    assert length_hist(texts_of(spark, [1]).where("false")).count() == 0


def test_density_like_kernel_sum(spark):
    lengths = [1, 2, 2, 5, 9, 9, 9, 20]
    x = np.array(lengths, float)
    grid = np.linspace(1, 20, 200)
    h = x.std(ddof=1) * len(x) ** -0.2
    want = np.exp(-0.5 * ((grid[:, None] - x) / h) ** 2).sum(1) / (len(x) * h * math.sqrt(2 * math.pi))
    rows = length_density(texts_of(spark, lengths)).orderBy("point").collect()
    assert np.allclose([r.x for r in rows], grid)
    assert np.allclose([r.density for r in rows], want * len(x) * 19 / 30)
    assert length_density(texts_of(spark, [3, 3])).count() == 0


def test_top_words_ties(spark):
    df = spark.createDataFrame([(2, "b a"), (1, "c b a c")], "id int, clean_text string")
    assert [r.word for r in top_words(df, n=3).collect()] == ["a", "b", "c"]
    seen = top_words(df, n=3, ties="first_seen", order_col="id")
    assert [r.word for r in seen.collect()] == ["c", "b", "a"]
    assert [r.word for r in top_words(df, stopwords=["a"]).collect()] == ["b", "c"]


def test_top_posts(spark):
    day = dt.datetime(2024, 1, 20)
    rows = [(i, "a" if i % 2 else "b", day - dt.timedelta(days=i), float(i // 4)) for i in range(20)]
    posts = spark.createDataFrame(rows, "post_id int, community string, created timestamp_ntz, score double")
    best = [r.post_id for r in top_posts(posts, "a", day, "week", 3).collect()]
    assert best == [5, 1, 3]  # post 7 is exactly a week old


def test_slice_comes_before_pinned_filter(spark):
    rows = [("p", 0, True), ("p", 1, False), ("p", 2, False), ("q", 0, False)]
    df = spark.createDataFrame(rows, "post_id string, rank int, stickied boolean")
    out = drop_stickied(top_n_per_post(df, 2, [F.asc("rank")]))
    assert sorted((r.post_id, r["rank"]) for r in out.collect()) == [("p", 1), ("q", 0)]


@pytest.mark.parametrize("n", [1, 5, 1200])
def test_hot_group_top_n(spark, n):
    # a third of all rows in one group, and more rows asked for than the optimizer's group limit
    df = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50 + 1).alias("g"),
        F.pmod(F.xxhash64("id"), F.lit(1000)).alias("v"), "id").repartition(7)
    out = top_n_per_group(df, ["g"], [F.desc("v"), F.asc("id")], n, spread=3)
    got = {(r.g, r.rn): r.id for r in out.collect()}
    pdf = df.toPandas().sort_values(["g", "v", "id"], ascending=[True, False, True])
    want = {}
    for g, part in pdf.groupby("g"):
        for rank, i in enumerate(part.id.head(n), 1):
            want[(g, rank)] = i
    assert got == want


def ids(df):
    return sorted(r.id for r in df.collect())


def test_samples_ignore_partitioning(spark):
    df = spark.range(1001)
    for f in (hash_sample, exact_sample):
        assert ids(f(df.repartition(2), "id", 0.5, 1)) == ids(f(df.repartition(9), "id", 0.5, 1))
    assert ids(hash_sample(df, "id", 0.5, 1)) != ids(hash_sample(df, "id", 0.5, 2))
    assert [hash_sample(df, "id", f, 1).count() for f in (0.0, 1.0)] == [0, 1001]


@pytest.mark.parametrize("rows, fraction, size", [
    (1001, 0.5, 500), (1003, 0.5, 502), (10, 0.0, 0), (10, 1.0, 10), (1, 0.5, 0), (0, 0.5, 0)])
def test_exact_sample_size(spark, rows, fraction, size):
    assert exact_sample(spark.range(rows), "id", fraction, 3).count() == size


def test_split_is_total_and_stable(spark):
    small, large = split(spark.range(500), "id", 9), split(spark.range(2000), "id", 9)
    part = {r.id: r.split for r in large.collect()}
    assert all(part[r.id] == r.split for r in small.collect())
    shares = Counter(part.values())
    assert sum(shares.values()) == 2000
    assert abs(shares["test"] - 200) < 60 and abs(shares["val"] - 360) < 80


def test_exact_split_sizes(spark):
    df = spark.range(1000).withColumn(
        "label", F.when(F.col("id") < 334, "hot").when(F.col("id") < 340, F.lit(None)).otherwise("cold"))
    assert Counter(r.split for r in exact_split(df, "id", 5).collect()) == {
        "test": 100, "val": 180, "train": 720}
    by = Counter((r.label, r.split) for r in exact_split(df, "id", 5, stratify="label").collect())
    assert by == {
        ("hot", "test"): 34, ("hot", "val"): 60, ("hot", "train"): 240,
        ("cold", "test"): 66, ("cold", "val"): 119, ("cold", "train"): 475,
        (None, "test"): 1, (None, "val"): 1, (None, "train"): 4,
    }
    two = exact_split(df, "id", 2018, test=0.2, val=0.0)
    assert Counter(r.split for r in two.collect()) == {"test": 200, "train": 800}


def test_periods_agree_and_no_label_is_lost(spark):
    days = [dt.datetime(2024, 1, 1) + dt.timedelta(days=7 * k) for k in range(4)]
    df = spark.createDataFrame(list(zip(days, [None, "positive", "mixed", "negative"])), "comment_created timestamp, sentiment_labels string")
    ranked = {r.comment_created: r.period_int for r in with_period(df).collect()}
    pivot = {r.period_int: r for r in label_pivot(df, other="other").collect()}
    assert list(ranked.values()) == [1, 2, 3, 4] and sorted(pivot) == [2, 3, 4]
    assert (pivot[3].other, pivot[3].total, pivot[2].other) == (1, 1, 0)
    assert {(r.period_int, r.label, r.n) for r in label_counts(df).collect()} == {(2, "positive", 1), (3, "mixed", 1), (4, "negative", 1)}


def test_large_n_of_a_hot_group_is_cut_in_many_tasks(spark):
    df = spark.range(6000).select((F.col("id") % 10 == 0).cast("int").alias("g"), "id")
    out = top_n_per_group(df, ["g"], [F.asc("id")], 1500)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning(g") == 2 and "_part" in plan
    got = {(r.g, r.id): r.rn for r in out.collect()}
    want = [(g, [i for i in range(6000) if (i % 10 == 0) == bool(g)][:1500]) for g in (0, 1)]
    assert got == {(g, i): k + 1 for g, ids in want for k, i in enumerate(ids)}


def test_calendar_has_every_period_between_the_bounds(spark):
    from datetime import datetime

    from pulse.operators.aggregates import label_calendar

    rows = [(datetime(2024, 1, 31), "neutral"), (datetime(2024, 4, 2), "negative"), (datetime(2024, 4, 30), "odd"), (datetime(2024, 4, 1), None), (None, "neutral")]
    df = spark.createDataFrame(rows, "comment_created timestamp_ntz, sentiment_labels string")
    got = sorted((r.period_int, str(r.period_date), r.label, r.n) for r in label_calendar(df, period="M").collect())
    want = [(i, f"2024-0{i}-01", label, 0) for i in range(1, 5) for label in ("negative", "neutral", "positive")]
    want = [w for w in want if w[:1] + w[2:3] not in ((1, "neutral"), (4, "negative"))] + [(1, "2024-01-01", "neutral", 1), (4, "2024-04-01", "negative", 1), (4, "2024-04-01", "odd", 1)]
    assert got == sorted(want)
    assert label_calendar(df, period="D").count() == 3 * 91 + 1 and label_calendar(df, period="W").count() == 3 * 14 + 1
    assert label_calendar(df.where("false")).collect() == []
