"""Classifier evaluation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.vectors import argmax, log_sum_exp, softmax


def _ratio(a: Column, b: Column) -> Column:
    """``a / b``, 0 where ``b`` is 0."""
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def _f1(precision: Column, recall: Column) -> Column:
    return _ratio(F.lit(2.0) * precision * recall, precision + recall)


def metrics(
    df: DataFrame, y_col: str, logits_col: str, n: int = 3, cut: str = "logit",
    left_out: str | None = None,
) -> DataFrame:
    """One row: ``loss, accuracy, precision, recall, f1``, from a single pass.

    Loss is the cross-entropy of the logits. Precision and recall are counted over all cells of
    the one-hot matrix, a cell being predicted when it exceeds 0.5. ``cut='logit'`` compares the
    raw logits, as a training run that monitors a model without a softmax layer does;
    ``'probability'`` compares the probabilities. Rows without a class among the ``n``, or without
    ``n`` logits, are left out; ``left_out`` names a column that counts them.
    """
    if cut not in ("logit", "probability"):
        raise ValueError("cut must be 'logit' or 'probability'")
    y, z = F.col("y"), F.col("z")
    rows = df.select(F.col(y_col).cast("int").alias("y"), F.col(logits_col).alias("z"))
    fit = F.coalesce((y >= 0) & (y < n) & (F.size(z) == n), F.lit(False))
    rows = rows.select(F.when(fit, y).alias("y"), F.when(fit, z).alias("z"))
    cells = z if cut == "logit" else softmax(z, n)
    rows = rows.select("y", "z", cells.alias("cells"))
    hot = [F.col("cells")[i] > 0.5 for i in range(n)]
    hits = sum((F.when(hot[i] & (y == i), 1).otherwise(0) for i in range(n)), F.lit(0))
    called = F.when(y.isNotNull(), sum((hot[i].cast("int") for i in range(n)), F.lit(0)))
    sums = rows.agg(
        F.avg(log_sum_exp(z, n) - F.get(z, y)).alias("loss"),
        F.avg((argmax(z) == y).cast("double")).alias("accuracy"),
        F.sum(hits).alias("tp"),
        F.sum(called).alias("called"),
        F.count(y).alias("rows"),
        F.count_if(y.isNull()).alias("left_out"),
    )
    out = sums.select(
        *([F.col("left_out").alias(left_out)] if left_out else []), "loss", "accuracy",
        _ratio(F.col("tp"), F.col("called")).alias("precision"),
        _ratio(F.col("tp"), F.col("rows")).alias("recall"),
    )
    return out.withColumn("f1", _f1(F.col("precision"), F.col("recall")))


def report(df: DataFrame, y_col: str, pred_col: str, names: Sequence[str]) -> DataFrame:
    """``label, precision, recall, f1, support``: a row per class, then accuracy and averages.

    All counts come from one pass that leaves a single row per task. The accuracy row repeats
    the accuracy in every column, as report frames built from nested dictionaries do.
    """
    rows = df.select(F.col(y_col).cast("int").alias("y"), F.col(pred_col).cast("int").alias("p"))
    rows = rows.where(F.col("y").isNotNull() & F.col("p").isNotNull())
    y, p = F.col("y"), F.col("p")
    counts = rows.agg(
        *[f for i in range(len(names)) for f in (
            F.count_if((y == i) & (p == i)).alias(f"tp{i}"),
            F.count_if(p == i).alias(f"called{i}"),
            F.count_if(y == i).alias(f"support{i}"),
        )],
        F.count_if(y == p).alias("right"),
        F.count(F.lit(1)).alias("total"),
    )
    classes = counts
    for i in range(len(names)):
        classes = classes.withColumns({
            f"precision{i}": _ratio(F.col(f"tp{i}"), F.col(f"called{i}")),
            f"recall{i}": _ratio(F.col(f"tp{i}"), F.col(f"support{i}")),
        }).withColumn(f"f1{i}", _f1(F.col(f"precision{i}"), F.col(f"recall{i}")))

    def line(label: str, precision: Column, recall: Column, f1: Column, support: Column) -> Column:
        return F.struct(
            F.lit(label).alias("label"), precision.alias("precision"), recall.alias("recall"),
            f1.alias("f1"), support.cast("double").alias("support"),
        )

    def total(terms: Sequence[Column]) -> Column:
        return sum(terms[1:], terms[0])

    def average(weighted: bool) -> list[Column]:
        weights = [F.col(f"support{i}") if weighted else F.lit(1) for i in range(len(names))]
        return [
            _ratio(total([F.col(f"{m}{i}") * weights[i] for i in range(len(names))]), total(weights))
            for m in ("precision", "recall", "f1")
        ]

    accuracy = _ratio(F.col("right"), F.col("total"))
    lines = [
        line(name, *[F.col(f"{m}{i}") for m in ("precision", "recall", "f1", "support")])
        for i, name in enumerate(names)
    ]
    lines.append(line("accuracy", accuracy, accuracy, accuracy, accuracy))
    lines.append(line("macro avg", *average(False), F.col("total")))
    lines.append(line("weighted avg", *average(True), F.col("total")))
    return classes.select(F.inline(F.array(*lines)))


def best_run(runs: DataFrame) -> DataFrame:
    """The row of ``(run, epoch, val_accuracy)`` to keep: best accuracy, the earliest on ties."""
    best = F.min(F.struct((-F.col("val_accuracy")).alias("loss"), "epoch", "run")).alias("b")
    return runs.where(F.col("val_accuracy").isNotNull()).agg(best).select(
        "b.run", "b.epoch", (-F.col("b.loss")).alias("val_accuracy")
    )


def last_is_best(runs: DataFrame) -> DataFrame:
    """``run, best, last, keep`` per run: keep the model only if its last epoch was its best."""
    return runs.groupBy("run").agg(
        F.max("val_accuracy").alias("best"), F.max_by("val_accuracy", "epoch").alias("last")
    ).withColumn("keep", F.col("best") == F.col("last"))
