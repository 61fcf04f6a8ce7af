"""Training by epochs: gradients, schedules, early stops, lost drivers."""

import hashlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pulse.operators import epochs
from pulse.operators.epochs import Settings, fit_epochs, gradient_sums, hashed_words, rate_at
from pulse.operators.evaluate import best_run, last_is_best
from pulse.plans.training import train_by_epochs
from pulse.session import shared_dir, whole_tables

BITS = 6


def number(word, bits=BITS):
    return int(hashlib.md5(word.encode()).hexdigest()[:8], 16) >> (32 - bits)


def labelled(spark, n=400, seed=0, classes=3):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        y = int(rng.integers(classes))
        words = [f"c{y}w{rng.integers(5)}" if rng.random() < 0.5 else f"any{rng.integers(20)}" for _ in range(rng.integers(1, 12))]
        rows.append((i, " ".join(words), y, ["train", "train", "train", "val", "test"][i % 5]))
    return spark.createDataFrame(rows + [(n, None, 1, "train"), (n + 1, "no class", None, "train"), (n + 2, "far", 7, "train"), (n + 3, "", 0, "train")],
                                 "id long, clean_text string, label int, split string")


def dense(rows):
    x = np.zeros((len(rows), (1 << BITS) + 1))
    for r, row in enumerate(rows):
        w = row.clean_text.split()
        for word in w:
            x[r, number(word)] += 1 / np.sqrt(len(w))
        x[r, -1] = 1
    return x, np.array([row.label for row in rows])


def plain_gradient(x, y, weights):
    z = x @ weights
    p = np.exp(z - z.max(axis=1, keepdims=True))
    p /= p.sum(axis=1, keepdims=True)
    loss = -np.log(p[np.arange(len(y)), y]).mean()
    right = (z.argmax(axis=1) == y).mean()
    p[np.arange(len(y)), y] -= 1
    return x.T @ p / len(y), loss, right


def used(spark, split="train"):
    return [r for r in labelled(spark).where(F.col("split") == split).collect() if r.clean_text is not None and r.label in (0, 1, 2)]


def test_gradient_loss_and_accuracy_against_numpy(spark):
    rows = used(spark)
    x, y = dense(rows)
    weights = np.random.default_rng(1).standard_normal((x.shape[1], 3))
    df = spark.createDataFrame([(r.label, r.clean_text) for r in rows], "y int, t string")
    words = df.select("y", hashed_words(F.filter(F.split("t", " "), lambda w: w != ""), BITS).alias("words"))
    got, facts = gradient_sums(words.repartition(5), weights)
    want, loss, right = plain_gradient(x, y, weights)
    assert np.abs(got - want).max() < 1e-9 and abs(facts["loss"] - loss) < 1e-9 and facts["accuracy"] == right and facts["rows"] == len(y)
    # to the last digit, however the rows lie
    assert all((gradient_sums(words.repartition(n), weights)[0] == got).all() for n in (1, 3))
    none, facts = gradient_sums(words.where("false"), weights)
    assert not none.any() and facts["rows"] == 0


def trained(spark, folder, run="run", rows=None, **kw):
    kw = {"epochs": 4, "batch_rows": 60, "bits": BITS, "rate": 0.05, **kw}
    return fit_epochs(labelled(spark) if rows is None else rows, "id", folder, "training", Settings(**kw), run)


@pytest.mark.parametrize("optimizer", ["sgd", "adam"])
def test_run_of_one_batch_against_numpy(spark, optimizer):
    model = trained(spark, shared_dir(spark, "t"), epochs=3, batch_rows=10**6, optimizer=optimizer, decay_steps=1, decay=0.5, patience=None)
    x, y = dense(used(spark))
    xv, yv = dense(used(spark, "val"))
    w, m, v = (np.zeros((x.shape[1], 3)) for _ in range(3))
    kept = []
    for step in range(1, 4):
        g, loss, _ = plain_gradient(x, y, w)
        rate = 0.05 * 0.5 ** (step - 1)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = w - (rate * g if optimizer == "sgd" else rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-7 / np.sqrt(1 - 0.999**step)))
        _, val_loss, right = plain_gradient(xv, yv, w)
        kept.append((step, step, rate, loss, val_loss, right, w))
    rows = model.history.orderBy("epoch").collect()
    for r, (e, s, rate, loss, val_loss, right, _) in zip(rows, kept, strict=True):
        assert (r.epoch, r.steps, r.rate) == (e, s, rate) and abs(r.loss - loss) < 1e-7 and abs(r.val_loss - val_loss) < 1e-7 and r.val_accuracy == right
    best = min(kept, key=lambda k: (-k[5], k[0]))
    assert model.epoch == best[0] and np.abs(model.weights - best[6]).max() < 1e-6


def test_learning_separates_classes_and_scores_rows(spark):
    model = trained(spark, shared_dir(spark, "t"), epochs=6)
    last = model.history.orderBy(F.desc("epoch")).first()
    assert last.val_accuracy > 0.85 and last.val_loss < 0.7
    scored = model.predict(labelled(spark).where("split = 'test'")).collect()
    x, y = dense(scored)
    assert np.abs(np.array([r.logits for r in scored]) - x @ model.weights).max() < 1e-9


def test_a_lost_driver_gives_the_same_weights(spark, monkeypatch):
    whole = trained(spark, shared_dir(spark, "t"))
    folder = shared_dir(spark, "t")
    steps, real = [], epochs.gradient_sums

    def failing(rows, weights, gradient=True):
        steps.append(1)
        if len(steps) == 14:
            raise KeyboardInterrupt
        return real(rows, weights, gradient)

    monkeypatch.setattr(epochs, "gradient_sums", failing)
    with pytest.raises(KeyboardInterrupt):
        trained(spark, folder)
    monkeypatch.setattr(epochs, "gradient_sums", real)
    kept = len(whole_tables(spark, f"{folder}/run/epoch=*"))
    assert 0 < kept < 4
    # a table that was being written does not count
    spark.range(1).write.parquet(f"{folder}/run/epoch=00004")
    place = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/run/epoch=00004/_SUCCESS")
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, False)
    again = trained(spark, folder, rows=labelled(spark).repartition(7))
    assert (again.weights == whole.weights).all() and again.epoch == whole.epoch
    assert again.history.drop("run").collect() == whole.history.drop("run").collect()
    # an ended run returns at once; other settings are refused
    monkeypatch.setattr(epochs, "_save", lambda *a: pytest.fail("trained again"))
    assert (trained(spark, folder).weights == whole.weights).all()
    with pytest.raises(ValueError):
        trained(spark, folder, rate=0.5)


def test_rates_fall_in_steps_or_gradually():
    steps = Settings(rate=1.0, decay=0.5, decay_steps=10)
    assert [rate_at(steps, s) for s in (0, 9, 10, 25)] == [1.0, 1.0, 0.5, 0.25]
    assert rate_at(Settings(rate=1.0, decay=0.5, decay_steps=10, staircase=False), 5) == 0.5**0.5


def test_early_stop(spark):
    # labels of the validation rows are turned, so learning makes its loss worse
    rows = labelled(spark).withColumn("label", F.when(F.col("split") == "val", (F.col("label") + 1) % 3).otherwise(F.col("label")))
    model = trained(spark, shared_dir(spark, "t"), rows=rows, epochs=9, patience=2)
    losses = [r.val_loss for r in model.history.orderBy("epoch").collect()]
    assert len(losses) == 3 and losses == sorted(losses)
    assert not epochs._stale([{"val_loss": v} for v in (3, 2, 2.5, 1)], 2) and epochs._stale([{"val_loss": v} for v in (3, 1, 2, 1)], 2)


def test_without_rows_or_validation(spark):
    none = trained(spark, shared_dir(spark, "t"), rows=labelled(spark).where("false"))
    assert none.history.count() == 0 and none.epoch == 0 and not none.weights.any()
    blind = trained(spark, shared_dir(spark, "t"), rows=labelled(spark).where("split = 'train'"), epochs=2)
    assert blind.epoch == 2 and [r.val_loss for r in blind.history.collect()] == [None, None]
    assert none.predict(labelled(spark)).count() == 404


def test_job_keeps_the_best_run_and_reports(spark):
    runs = {"slow": Settings(epochs=2, batch_rows=120, rate=1e-4, bits=BITS), "fast": Settings(epochs=2, batch_rows=120, rate=0.1, bits=BITS)}
    kept, history, overall, per_class = train_by_epochs(labelled(spark), "id", shared_dir(spark, "t"), runs)
    assert kept.epoch == best_run(history).first().epoch and best_run(history).first().run == "fast"
    assert overall.first().accuracy > 0.6 and per_class.count() == 6
    assert {r.run for r in last_is_best(history).collect()} == set(runs)
    only, _, _, _ = train_by_epochs(labelled(spark), "id", shared_dir(spark, "t"), runs, last_only=True)
    assert only is None or only.epoch == 2


def test_a_batch_reads_its_own_files(spark):
    folder = shared_dir(spark, "t")
    trained(spark, folder, epochs=1)
    plan = spark.read.parquet(f"{folder}/run/rows").where("batch = 2")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(batch" in plan


def test_hashed_words():
    z, row, ids, scale = epochs.logits(pa.array([[1, 1, 0], [], None], pa.list_(pa.int32())), np.arange(6.0).reshape(3, 2))
    assert z.shape == (3, 2) and np.allclose(z[1], [4, 5]) and np.allclose(z[0, 0], 4 + 4 / np.sqrt(3)) and len(ids) == 3


def test_small_batches_are_steps_of_one_stage(spark, monkeypatch):
    plans, real = [], epochs.gradient_sums

    def seen(rows, weights, gradient=True):
        plans.append((gradient, rows.rdd.getNumPartitions()))
        return real(rows, weights, gradient)

    monkeypatch.setattr(epochs, "gradient_sums", seen)
    old = spark.conf.get("spark.sql.files.openCostInBytes"), spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
    try:
        trained(spark, shared_dir(spark, "t"), epochs=1)
    finally:
        spark.conf.set("spark.sql.files.openCostInBytes", old[0])
        spark.conf.set("spark.sql.files.maxPartitionBytes", old[1])
    steps = [n for gradient, n in plans if gradient]
    assert len(steps) > 4 and set(steps) == {1}


def test_runs_of_a_job_go_on_side_by_side(spark, monkeypatch):
    import threading

    from pulse.plans import training

    meet, real = threading.Barrier(2, timeout=60), training.fit_epochs
    monkeypatch.setattr(training, "fit_epochs", lambda *a, **kw: meet.wait() >= 0 and real(*a, **kw))
    runs = {n: Settings(epochs=1, batch_rows=10**6, rate=r, bits=BITS) for n, r in (("slow", 1e-4), ("fast", 0.1))}
    _, history, _, _ = train_by_epochs(labelled(spark), "id", shared_dir(spark, "t"), runs)
    assert sorted(r.run for r in history.collect()) == ["fast", "slow"]
