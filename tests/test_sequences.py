"""Sub-words, positions, padded batches."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulse.operators.padded import batches_of, score_padded, sequence_model
from pulse.operators.positions import glue_by_position, with_position
from pulse.operators.scoring import with_predictions
from pulse.operators.subwords import encode_subwords, pieces, read_vocab, subword_vocab
from pulse.plans.queries.scores import ClassCounter

# --- positions


@pytest.fixture
def small_ranges(spark):
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    old = [spark.conf.get(k) for k in keys]
    for k, v in zip(keys, ("300", "0")):
        spark.conf.set(k, v)
    yield
    for k, v in zip(keys, old):
        spark.conf.set(k, v)


def test_positions_follow_files_and_lines(spark, small_ranges, tmp_path):
    rows = [(i, "x" * (i * 7 % 50)) for i in range(200)]
    spark.createDataFrame(rows, "id long, t string").repartitionByRange(4, "id").sortWithinPartitions("id").write.csv(str(tmp_path / "a"))
    read = spark.read.schema("id long, t string").csv(str(tmp_path / "a"))
    out = with_position(read)
    assert out.rdd.getNumPartitions() > 8
    assert sorted((r.position, r.id) for r in out.collect()) == [(i, i) for i in range(200)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "hashpartitioning" not in plan


def test_tables_side_by_side(spark, small_ranges, tmp_path):
    for name, n, parts in (("a", 150, 3), ("b", 150, 5), ("c", 149, 2)):
        spark.createDataFrame([(i, i * 2) for i in range(n)], f"{name} long, {name}2 long").repartitionByRange(parts, name).sortWithinPartitions(name).write.parquet(str(tmp_path / name))
    a, b, c = (spark.read.parquet(str(tmp_path / n)) for n in "abc")
    got = glue_by_position(a, b)
    assert got.columns == ["position", "a", "a2", "b", "b2"]
    assert sorted(map(tuple, got.collect())) == [(i, i, 2 * i, i, 2 * i) for i in range(150)]
    with pytest.raises(Exception, match="tables differ in length"):
        glue_by_position(a, c).collect()


# --- sub-words


def greedy(word, vocab, unknown=1):
    out, at = [], 0
    if not word or len(word) > 100:
        return [unknown]
    while at < len(word):
        mark = "##" if at else ""
        end = next((e for e in range(len(word), at, -1) if mark + word[at:e] in vocab), None)
        if end is None:
            return [unknown]
        out.append(vocab[mark + word[at:end]])
        at = end
    return out


def some_vocab(rng):
    parts = ["".join(rng.choice("abc") for _ in range(rng.randrange(1, 5))) for _ in range(40)]
    return {t: i + 5 for i, t in enumerate(dict.fromkeys([*parts, *["##" + p for p in parts[10:]], "é", "##日本"]))}


def test_pieces_are_the_longest_from_the_left(spark):
    rng = random.Random(5)
    vocab = some_vocab(rng)
    words = {"".join(rng.choice("abcd" if rng.random() < 0.1 else "abc") for _ in range(rng.randrange(1, 30))) for _ in range(300)}
    words |= {"", "é日本", "日本", "a" * 100, "a" * 101, "abc" * 40, "\U0001f600"}
    table = spark.createDataFrame([*vocab.items(), ("a", 9000), (None, 3)], "token string, id int")
    got = {r.token: r.ids for r in pieces(spark.createDataFrame([(w,) for w in words] * 2 + [(None,)], "token string"), table).collect()}
    assert got == {w: greedy(w, vocab) for w in words}
    assert pieces(spark.createDataFrame([], "token string"), table).collect() == []
    assert [r.ids for r in pieces(spark.createDataFrame([("ab",)], "token string"), table.where("false")).collect()] == [[1]]


def test_sequences_of_pieces_are_wrapped_cut_and_padded(spark):
    vocab = {"play": 5, "##ing": 6, "##s": 7, "a": 8}
    table = spark.createDataFrame(list(vocab.items()), "token string, id int")
    rows = [(1, ["a", "playing", "plays"]), (2, []), (3, None), (4, ["xyz", "a"]), (5, ["playing"] * 9), (6, ["a"] * 300)]
    out = encode_subwords(spark.createDataFrame(rows, "id long, w array<string>"), "id", "w", table, 8)
    got = {r.id: (r.input_ids, sum(r.attention_mask)) for r in out.collect()}
    assert got == {1: ([2, 8, 5, 6, 5, 7, 3, 0], 7), 2: ([2, 3] + [0] * 6, 2), 3: ([2, 3] + [0] * 6, 2), 4: ([2, 1, 8, 3, 0, 0, 0, 0], 4),
                   5: ([2, 5, 6, 5, 6, 5, 6, 3], 8), 6: ([2] + [8] * 6 + [3], 8)}


def test_vocabulary_files_and_untrained_vocabularies(spark, tmp_path, small_ranges):
    tokens = ["[PAD]", "[UNK]", *[f"token{i}" for i in range(300)], "##x"]
    (tmp_path / "vocab.txt").write_text("\n".join(tokens) + "\n")
    assert {r.id: r.token for r in read_vocab(spark, str(tmp_path / "vocab.txt")).collect()} == dict(enumerate(tokens))
    words = spark.createDataFrame([("the", 5), ("a", 6)], "token string, id int")
    got = {r.token: r.id for r in subword_vocab(words, "ab").collect()}
    assert got == {"the": 5, "a": 6, "##the": 11, "##a": 12, "b": 15, "##b": 16}


# --- padded batches


def sequences(spark, n=900, seed=1):
    rng = random.Random(seed)
    size = lambda: min(2000, int(rng.paretovariate(0.8) * 5))
    rows = [(i, [rng.randrange(1000) for _ in range(size())], "x") for i in range(n)]
    rows += [(n, [], "e"), (n + 1, None, None)] + [(n + 2 + i, [7] * 40, "copy") for i in range(400)]
    return spark.createDataFrame(rows, "id long, ids array<int>, logits_like string"), rows


def test_padded_batches_score_as_rows_do(spark):
    df, rows = sequences(spark)
    out = score_padded(df.repartition(5), "ids", ClassCounter(), limit=512, cells=4096, width_col="width")
    got = {r.id: r for r in out.collect()}
    assert out.columns == ["id", "ids", "logits_like", "logits", "width"] and len(got) == len(rows)
    for i, ids, tag in rows:
        used = (ids or [])[:512]
        assert got[i].logits == [float(sum(x % 3 == c for x in used)) for c in range(3)] and got[i].ids == ids and got[i].logits_like == tag
    used = sum(min(512, len(ids or [])) for _, ids, _ in rows)
    assert used / sum(r.width for r in got.values()) > 0.85  # less than 15 % padding
    # in table order it would be far more
    plain = sum(max(min(512, len(ids or [])) for _, ids, _ in rows[a:a + 64]) * 64 for a in range(0, len(rows), 64))
    assert used / plain < 0.6
    assert score_padded(df.where("false"), "ids", ClassCounter()).collect() == []


def test_one_length_is_spread_over_tasks(spark):
    df = spark.range(4000).select("id", F.array_repeat(F.lit(3), 30).alias("ids"))
    sizes = score_padded(df, "ids", ClassCounter()).groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) == 4 and max(r["count"] for r in sizes) < 2000


def test_batches_stay_within_their_cells():
    rng = np.random.default_rng(0)
    sizes = np.sort(rng.integers(0, 512, 500))
    parts = batches_of(sizes, 3000)
    assert [a for a, _ in parts] == [0, *[b for _, b in parts[:-1]]] and parts[-1][1] == 500
    assert all((b - a) * max(sizes[a:b].max(), 1) <= 3000 for a, b in parts)
    assert batches_of(np.array([], int), 10) == [] and batches_of(np.array([50, 60]), 10) == [(0, 1), (1, 2)]


def test_a_sequence_model_in_a_job(spark):
    texts = spark.createDataFrame([(1, "good good words"), (2, ""), (3, None)], "id long, clean_text string")
    model = sequence_model(ClassCounter(), 14)
    out = with_predictions(model.apply(texts), names=model.names)
    assert out.columns == ["id", "clean_text", "logits", "class_predictions", "sentiment_labels"]
    assert {r.id: sum(r.logits) for r in out.collect()} == {1: 3.0, 2: 0.0, 3: 0.0}
