"""Files read by ranges."""

import random
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulse.operators.topn import top_posts
from pulse.plans.queries import QUERIES
from pulse.sources.feed import join_posts
from pulse.sources.files import read_labelled_csv, write_csv
from pulse.sources.layout import deal_texts, land_comments, land_posts
from pulse.sources.splitcsv import read_split_csv, split_records

ROW = T.StructType([T.StructField("id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("day", T.DateType())])


@pytest.fixture
def ranges(spark):
    """Ranges of the given size, for a test."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}

    def of(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        spark.conf.set("spark.sql.files.openCostInBytes", "0")

    yield of
    for k, v in old.items():
        spark.conf.set(k, v)


def written(tmp_path, texts, end="\n", last=True):
    body = "id,text,day" + end + end.join(f"{i},{t},2024-01-0{1 + i % 9}" for i, t in enumerate(texts)) + (end if last else "")
    (tmp_path / "one.csv").write_bytes(body.encode())
    return str(tmp_path / "one.csv")


def quoted(text):
    return '"' + text.replace('"', '""') + '"'


ODD = ["plain", "", '""', quoted('a "b" c'), quoted("x\ny"), quoted("\n\n"), quoted('"'), quoted('"\n"'), quoted("a,b\nc,d"), quoted("é\U0001f600\n日本"),
       quoted("long " * 30 + "\n" + "lines " * 30), quoted("\r\nkept"), quoted(" spaces \n"), quoted('""\n""')]


def both(spark, path, schema=ROW):
    a, b = read_split_csv(spark, path, schema), read_labelled_csv(spark, path, schema)
    return sorted(a.collect(), key=str), sorted(b.collect(), key=str)


@pytest.mark.parametrize("size", [23, 61, 997, 40000])
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_ranges_give_the_rows_of_the_whole_file(spark, ranges, tmp_path, size, end):
    rng = random.Random(size)
    texts = [rng.choice(ODD) for _ in range(size if size < 100 else 120)]
    path = written(tmp_path, texts, end)
    ranges(size)
    a, b = both(spark, path)
    # the whole file's reader turns the file's own line ends into line feeds, inside texts too
    kept = [r if r.text is None or end == "\n" else (r.id, r.text.replace("\r\n", "\n"), r.day) for r in a]
    assert [tuple(r) for r in kept] == [tuple(r) for r in b] and len(a) == len(texts)
    assert sum('\r\n' in (r.text or "") for r in a) == sum("\r\n" in t for t in texts)
    if size < 100:
        assert split_records(spark, path).rdd.getNumPartitions() > 4


def test_a_text_over_many_ranges_and_no_last_line_break(spark, ranges, tmp_path):
    path = written(tmp_path, ["a", quoted("one\n" * 200), "b", quoted("two" * 200)], last=False)
    ranges(64)
    a, b = both(spark, path)
    assert a == b and len(a) == 4


def test_empty_lines_short_records_and_a_long_header(spark, ranges, tmp_path):
    (tmp_path / "one.csv").write_text('id,"te\n\nxt",day\n\n1,a\n\n\n2,"b\n\n",2024-01-01\n3\n')
    for size in (9, 1000):
        ranges(size)
        a, b = both(spark, str(tmp_path / "one.csv"))
        assert a == b and len(a) == 3


def test_many_files_each_with_a_header(spark, ranges, tmp_path):
    rows = [(i, 'say "hi"\n' * (i % 5) + str(i), None) for i in range(60)]
    path = str(tmp_path / "many")
    write_csv(spark.createDataFrame(rows, ROW).repartition(5), path)
    (tmp_path / "many" / "empty.csv").write_text("")
    ranges(100)
    a, b = both(spark, path)
    assert a == b and len(a) == 60


def test_lines_that_must_move_are_put_in_order(spark, ranges, tmp_path):
    path = written(tmp_path, [quoted(f"a\n{i}\nb") for i in range(60)])
    ranges(50)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        a, b = both(spark, path)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert a == b and len(a) == 60


def test_only_parts_at_borders_are_moved(spark, ranges, tmp_path):
    path = written(tmp_path, [quoted(f"a\n{i}") for i in range(200)])
    ranges(500)
    plan = split_records(spark, path)._jdf.queryExecution().executedPlan().toString()
    scan = plan[plan.index("MapInArrow"):plan.index("FileScan text")]
    assert "Exchange" not in scan and "BroadcastHashJoin" in scan
    assert plan.count("FileScan text") == 1
    # what is sorted file by file has no text
    window = plan[plan.index("Window"):]
    assert "text" not in window[:window.index("FileScan parquet")]


def test_the_split_csv_query_gathers_no_table_in_one_task(spark, ranges, tmp_path, monkeypatch):
    from pulse.plans.queries import files

    rows = [(i, f"of the {i} the end" if i % 7 else None, "en") for i in range(400)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(6).write.parquet(str(tmp_path / "documents.parquet"))
    ranges(4000)
    paths, real = [], files.read_split_csv
    monkeypatch.setattr(files, "read_split_csv", lambda spark, path, schema: paths.append(path) or real(spark, path, schema))
    got = {tuple(r) for r in files.csv_split_read(spark, str(tmp_path)).collect()}
    assert got == {(i, t and t.replace(" the ", ' "the"\n'), lang) for i, t, lang in rows}
    written = spark.read.text(paths[0]).select("_metadata.file_path").distinct().count()
    assert written > 1


# --- layout


def test_bucketed_posts_join_without_an_exchange_and_prune_their_days(spark):
    start = datetime(2024, 1, 1)
    rows = [(i, ["a", "b"][i % 2], start + timedelta(hours=5 * i), i % 17, f"t{i}") for i in range(300)] + [(900, None, None, 1, "t")]
    posts = spark.createDataFrame(rows, "post_id long, community string, created timestamp_ntz, score int, post_title string")
    comments = spark.createDataFrame([(i % 310, i) for i in range(2000)], "post_id long, comment long")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        landed, turns = land_posts(posts, 4), land_comments(comments, 4)
        out = join_posts(landed, turns).select("post_id", "comment", "post_title")
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "SortMergeJoin" in plan and plan.count("Bucketed: true") == 2
        want = join_posts(posts, comments).select("post_id", "comment", "post_title")
        assert sorted(map(tuple, out.collect())) == sorted(map(tuple, want.collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert landed.count() == 301
    as_of = datetime(2024, 2, 1)
    top = top_posts(landed, "a", as_of, "week", 5, day_col="day")
    plain = top_posts(posts, "a", as_of, "week", 5)
    assert [r.post_id for r in top.collect()] == [r.post_id for r in plain.collect()]
    scan = top._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in scan and "day" in scan.split("PartitionFilters: [")[1].split("]")[0]
    read = landed.where((F.col("community") == "a") & (F.col("day") >= as_of.date() - timedelta(days=7)) & (F.col("day") <= as_of.date()))
    folders = {r[0].rsplit("/", 2)[1] for r in read.select("_metadata.file_path").distinct().collect()}
    assert folders == {f"day={(as_of - timedelta(days=d)).date()}" for d in range(8)}


@pytest.mark.parametrize(("most", "unit"), [(40, "month"), (20, "quarter"), (7, "year"), (3, "year")])
def test_posts_of_many_days_are_landed_in_few_folders(spark, most, unit):
    start = datetime(2024, 1, 1)
    rows = [(i, ["a", "b"][i % 2], start + timedelta(hours=31 * i), i % 17, f"t{i}") for i in range(300)] + [(900, None, None, 1, "t")]
    posts = spark.createDataFrame(rows, "post_id long, community string, created timestamp_ntz, score int, post_title string")
    comments = spark.createDataFrame([(i % 310, i) for i in range(2000)], "post_id long, comment long")
    landed, turns = land_posts(posts, 2, most_folders=most), land_comments(comments, 2)
    files = [r[0] for r in landed.select("_metadata.file_path").distinct().collect()]
    assert len({f.rsplit("/", 1)[0] for f in files}) <= most and len(files) <= 2 * most
    assert landed.schema["day"].metadata["folder"] == unit
    assert sorted(map(tuple, landed.select(*posts.columns).collect()), key=str) == sorted(rows, key=str)
    assert landed.where("day <> cast(created as date)").count() == 0
    out = join_posts(landed, turns).select("post_id", "comment", "post_title")
    want = join_posts(posts, comments).select("post_id", "comment", "post_title")
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, want.collect()))
    for as_of, back in ((datetime(2024, 7, 2, 5), "week"), (datetime(2025, 1, 1, 12), "day"), (datetime(2024, 3, 31), "month")):
        top, plain = top_posts(landed, "a", as_of, back, 5, day_col="day"), top_posts(posts, "a", as_of, back, 5)
        assert [r.post_id for r in top.collect()] == [r.post_id for r in plain.collect()]
        scan = top._jdf.queryExecution().executedPlan().toString()
        assert "folder" in scan.split("PartitionFilters: [")[1].split("]")[0]


def test_a_post_text_repeated_with_every_comment_is_written_about_once(spark, tmp_path):
    rng = random.Random(4)
    texts = ["\n".join(rng.randbytes(1000).hex() for _ in range(20)) for _ in range(200)] + [None, "", "one line", "\n"]
    rows = [(i, t, "en", "s", 0) for i, t in enumerate(texts)] + [(0, texts[0], "en", "s", 0)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int").repartition(2).write.parquet(str(tmp_path / "documents.parquet"))
    made = str(tmp_path / "made")
    QUERIES["flatten_posts_all"](spark, str(tmp_path)).write.parquet(made)
    read = {}
    for r in spark.read.parquet(made).collect():
        read.setdefault((r.post_id, r.post_text), []).append(r.comment_text)
    want = {}
    for i, t, *_ in rows:
        want.setdefault((str(i), t), []).extend((t or "").split("\n")[1:])
    assert {k: sorted(v) for k, v in read.items()} == {k: sorted(v) for k, v in want.items() if v}
    assert sum(p.stat().st_size for p in Path(made).glob("*.parquet")) < 2.5 * sum(len(t or "") for t in texts)


def test_dealt_texts_keep_their_rows(spark):
    none = spark.createDataFrame([], "id int, selftext string")
    assert deal_texts(none, least=3).rdd.getNumPartitions() == 3 and deal_texts(none).count() == 0
    rows = [(None, "é" * 50), (1, None), (1, None), (2, ""), (2, "x" * 1000)]
    out = deal_texts(spark.createDataFrame(rows, "id int, selftext string"), part_bytes=300)
    assert sorted(map(tuple, out.collect()), key=str) == sorted(rows, key=str) and out.rdd.getNumPartitions() == 4
