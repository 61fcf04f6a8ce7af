"""Softmax regression over hashed words, trained by epochs of distributed mini-batches.

A step is one job: every task adds up the gradient of its rows of the batch, and the parts are summed by weight
in a shuffle, so that the driver gets at most one number per weight, however many rows a batch has.
Contributions are whole numbers of 2^-32. Their sums do not depend on the order in which tasks end, so a run
gives the same weights on any cluster, and when it is taken up again after its driver was lost.

Rows are encoded once and written by batch; a step reads its own files only. After every epoch the weights,
the optimizer's state and the history are written beside them.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import asdict, dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.hashing import key_hash
from ..functions.labels import SENTIMENTS
from ..functions.text import profile as known_profile
from ..functions.text import split_words
from ..session import ship_package, whole_tables
from .scoring import Model

#: Contributions to a gradient are whole numbers of this part of one.
PART = 2.0**32
#: Batches of at most so many rows, which lie in one file each, are one task: its step is a job of one stage, without a shuffle.
SMALL_BATCH = 8192
#: Cells of a sum that are not weights.
_LOSS, _ROWS, _RIGHT = -1, -2, -3
_RUN = "run string, epoch int, steps long, rate double, loss double, val_loss double, val_accuracy double"


@dataclass(frozen=True)
class Settings:
    """How a run goes. The rate falls by ``decay`` every ``decay_steps`` steps, at once or (``staircase`` off) gradually.

    Training stops when the validation loss has not fallen for ``patience`` epochs.
    """

    epochs: int = 15
    batch_rows: int = 128
    rate: float = 0.05
    decay: float = 0.9
    decay_steps: int = 1000
    staircase: bool = True
    patience: int | None = 3
    optimizer: str = "adam"
    bits: int = 14
    seed: int = 0


def hashed_words(words: Column, bits: int) -> Column:
    """Words as numbers below ``2^bits``, by their md5. Nothing is looked up, so no vocabulary has to fit anywhere."""
    if not 1 <= bits <= 24:
        raise ValueError("bits must lie in 1 to 24")

    def number(w: Column) -> Column:
        return F.shiftright(F.conv(F.substring(F.md5(w), 1, 8), 16, 10).cast("long"), 32 - bits).cast("int")

    return F.transform(words, number)


def rate_at(settings: Settings, step: int) -> float:
    """Learning rate of a step, the first being 0."""
    part = step / settings.decay_steps
    return settings.rate * settings.decay ** (np.floor(part) if settings.staircase else part)


def logits(words: pa.ListArray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Logits of rows of word numbers; with the words' rows and numbers, and each row's weight of a word.

    A word counts ``1 / sqrt(words of the row)`` each time; the last row of ``weights`` is the bias.
    """
    words = words.combine_chunks() if isinstance(words, pa.ChunkedArray) else words
    size = np.asarray(words.value_lengths().fill_null(0)).astype(np.int64)
    row, ids = np.repeat(np.arange(len(size)), size), np.asarray(words.flatten()).astype(np.int64)
    scale = 1 / np.sqrt(np.maximum(size, 1))
    z = [np.bincount(row, weights[ids, c], len(size)) * scale + weights[-1, c] for c in range(weights.shape[1])]
    return np.stack(z, axis=1), row, ids, scale


def _probabilities(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _sums(batches: Iterator[pa.RecordBatch], weights: np.ndarray, gradient: bool) -> Iterator[pa.RecordBatch]:
    """Per task: the gradient's cells that are not zero, the loss, the rows, and how many are right."""
    total = np.zeros(weights.shape, np.int64)
    loss = rows = right = 0
    for batch in batches:
        y = np.asarray(batch.column(0)).astype(np.int64)
        if not len(y):
            continue
        z, row, ids, scale = logits(batch.column(1), weights)
        at = np.arange(len(y))
        top = z.max(axis=1)
        each = np.log(np.exp(z - top[:, None]).sum(axis=1)) + top - z[at, y]
        loss += int(np.rint(each * PART).astype(np.int64).sum())
        rows += len(y)
        right += int((z.argmax(axis=1) == y).sum())
        if gradient:
            off = _probabilities(z)
            off[at, y] -= 1
            total[-1] += np.rint(off * PART).astype(np.int64).sum(axis=0)
            np.add.at(total, ids, np.rint(off * scale[:, None] * PART).astype(np.int64)[row])
    cells = np.flatnonzero(total)
    if rows:
        yield pa.RecordBatch.from_pydict({
            "cell": pa.array(np.concatenate([cells, [_LOSS, _ROWS, _RIGHT]]), pa.int64()),
            "v": pa.array(np.concatenate([total.ravel()[cells], [loss, rows, right]]), pa.int64()),
        })


def gradient_sums(rows: DataFrame, weights: np.ndarray, gradient: bool = True) -> tuple[np.ndarray, dict[str, float]]:
    """Mean gradient over ``rows(y, words)``, and ``rows``, ``loss`` and ``accuracy``; one job."""
    shared = rows.sparkSession.sparkContext.broadcast(weights)
    parts = rows.select("y", "words").mapInArrow(lambda it: _sums(it, shared.value, gradient), "cell long, v long")
    found = parts.groupBy("cell").agg(F.sum("v").alias("v")).toArrow()
    shared.unpersist()
    cells, values = np.asarray(found.column("cell")), np.asarray(found.column("v"))
    facts = dict(zip(cells[cells < 0].tolist(), values[cells < 0].tolist()))
    n = facts.get(_ROWS, 0)
    out = np.zeros(weights.size)
    out[cells[cells >= 0]] = values[cells >= 0] / PART / max(n, 1)
    if not n:
        return out.reshape(weights.shape), {"rows": 0, "loss": float("nan"), "accuracy": float("nan")}
    return out.reshape(weights.shape), {"rows": n, "loss": facts[_LOSS] / PART / n, "accuracy": facts[_RIGHT] / n}


@dataclass
class _State:
    """What an epoch starts from."""

    weights: np.ndarray
    mean: np.ndarray
    square: np.ndarray
    step: int = 0
    history: list[dict] = field(default_factory=list)

    def update(self, gradient: np.ndarray, settings: Settings) -> None:
        rate = rate_at(settings, self.step)
        self.step += 1
        if settings.optimizer == "sgd":
            self.weights = self.weights - rate * gradient
            return
        # The usual decay rates of adaptive moments, and what keeps the root from zero
        b1, b2, least = 0.9, 0.999, 1e-7
        self.mean = b1 * self.mean + (1 - b1) * gradient
        self.square = b2 * self.square + (1 - b2) * gradient**2
        far = rate * np.sqrt(1 - b2**self.step) / (1 - b1**self.step)
        self.weights = self.weights - far * self.mean / (np.sqrt(self.square) + least)


def _save(spark: SparkSession, folder: str, state: _State, facts: dict) -> None:
    cells = pa.table({
        "cell": pa.array(np.arange(state.weights.size)), "w": pa.array(state.weights.ravel()),
        "mean": pa.array(state.mean.ravel()), "square": pa.array(state.square.ravel()),
        "facts": pa.array([json.dumps({**facts, "step": state.step, "history": state.history})] + [None] * (state.weights.size - 1), pa.string()),
    })
    spark.createDataFrame(cells).coalesce(1).write.mode("overwrite").parquet(f"{folder}/epoch={len(state.history):05d}")


def _load(spark: SparkSession, path: str, shape: tuple[int, int], facts: dict) -> _State:
    cells = spark.read.parquet(path).toArrow().sort_by("cell")
    kept = json.loads(next(f for f in cells.column("facts").to_pylist() if f))
    if any(kept[k] != v for k, v in facts.items()):
        raise ValueError(f"{path} is of a run with other settings: {kept}")
    weights, mean, square = (np.array(cells.column(c)).reshape(shape) for c in ("w", "mean", "square"))
    return _State(weights, mean, square, kept["step"], kept["history"])


@dataclass(frozen=True)
class Trained:
    """Weights of one epoch of a run, the cleaning its texts had, and the run's ``history``, a row per epoch."""

    weights: np.ndarray
    profile: str
    names: tuple[str, ...]
    epoch: int
    history: DataFrame
    lemmas: Mapping[str, str] | None = None

    def predict(self, df: DataFrame, text_col: str = "clean_text") -> DataFrame:
        """Add ``logits``. A row is scored by itself, so this works on streams too."""
        ship_package(df.sparkSession)
        shared = df.sparkSession.sparkContext.broadcast(self.weights)
        bits = (len(self.weights) - 1).bit_length() - 1

        @F.arrow_udf("array<double>")
        def scored(words: pa.Array) -> pa.Array:
            z = logits(words, shared.value)[0]
            ends = np.arange(len(z) + 1, dtype=np.int32) * z.shape[1]
            return pa.ListArray.from_arrays(pa.array(ends), pa.array(z.ravel()))

        words = hashed_words(split_words(F.col(text_col)), bits)
        return df.withColumn("logits", scored(words))

    def as_model(self) -> Model:
        """The model as every job and stream takes it."""
        return Model(self.predict, self.profile, self.lemmas, self.names)


def fit_epochs(
    rows: DataFrame, key: str, folder: str, profile: str, settings: Settings = Settings(), run: str = "run",
    text_col: str = "clean_text", label_col: str = "label", split_col: str = "split", names: Sequence[str] = SENTIMENTS,
    lemmas: Mapping[str, str] | None = None,
) -> Trained:
    """Train on the ``train`` rows and watch the ``val`` rows; the weights are those of the epoch with the best accuracy there.

    Of equal epochs the first counts; without ``val`` rows it is the last one. ``folder`` must be one that all executors reach. Called again with the same folder and settings, a run that was cut off goes on after its last
    whole epoch, and one that had ended returns at once. Rows without text, or without a class among the names, are left out; ``key`` tells which batch a row is in.
    """
    known_profile(profile)
    if settings.optimizer not in ("adam", "sgd"):
        raise ValueError("optimizer must be 'adam' or 'sgd'")
    spark = rows.sparkSession
    ship_package(spark)
    k, own = len(names), f"{folder}/{run}"
    label = F.col(label_col).cast("int")
    fine = rows.where(F.col(text_col).isNotNull() & label.between(0, k - 1) & F.col(split_col).isin("train", "val"))
    if not whole_tables(spark, f"{own}/rows"):
        n = fine.where(F.col(split_col) == "train").count()
        batches = max(1, -(-n // settings.batch_rows))
        place = F.floor(F.conv(F.substring(key_hash(F.col(key), settings.seed), 1, 8), 16, 10).cast("long") * batches / 2**32).cast("int")
        batch = F.when(F.col(split_col) == "val", F.lit(-1)).otherwise(F.coalesce(place, F.lit(0))).alias("batch")
        encoded = fine.select(label.alias("y"), hashed_words(split_words(F.col(text_col)), settings.bits).alias("words"), batch)
        # few batches are spread over many tasks, of many batches each goes to one
        parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
        spread = F.pmod(F.hash("words"), F.lit(max(1, parts // batches)))
        encoded.repartition(parts, "batch", spread).write.mode("overwrite").partitionBy("batch").parquet(f"{own}/rows")
    written = spark.read.schema("y int, words array<int>, batch int").parquet(f"{own}/rows")
    batches = 1 + (written.agg(F.max("batch")).first()[0] or 0)
    # how long a run goes on may be changed between two sittings
    facts = {"classes": k, "batches": batches, **{n: v for n, v in asdict(settings).items() if n not in ("epochs", "patience")}}
    shape = ((1 << settings.bits) + 1, k)
    state = _State(*(np.zeros(shape) for _ in range(3)))
    if epochs := whole_tables(spark, f"{own}/epoch=*"):
        state = _load(spark, epochs[-1], shape, facts)
    held = written.where("batch = -1")
    alone = settings.batch_rows <= SMALL_BATCH and int(spark.conf.get("spark.sql.shuffle.partitions")) // batches <= 1
    while len(state.history) < settings.epochs and not _stale(state.history, settings.patience):
        epoch = len(state.history) + 1
        loss = n = 0
        for b in np.random.default_rng([settings.seed, epoch]).permutation(batches):
            rows_of = written.where(F.col("batch") == int(b))
            gradient, seen = gradient_sums(rows_of.coalesce(1) if alone else rows_of, state.weights)
            if not seen["rows"]:
                continue
            rate = rate_at(settings, state.step)
            state.update(gradient, settings)
            loss, n = loss + seen["loss"] * seen["rows"], n + seen["rows"]
        if not n:
            break  # nothing to learn from
        val = gradient_sums(held, state.weights, gradient=False)[1]
        known = val["rows"] > 0
        state.history.append({
            "epoch": epoch, "steps": state.step, "rate": float(rate), "loss": loss / n,
            "val_loss": val["loss"] if known else None, "val_accuracy": val["accuracy"] if known else None})
        _save(spark, own, state, facts)
    scored = [h for h in state.history if h["val_accuracy"] is not None]
    best = min(scored, key=lambda h: (-h["val_accuracy"], h["epoch"]))["epoch"] if scored else len(state.history)
    if best not in (0, len(state.history)):
        state.weights = _load(spark, f"{own}/epoch={best:05d}", shape, facts).weights
    history = spark.createDataFrame([tuple({"run": run, **h}.values()) for h in state.history], _RUN)
    return Trained(state.weights, profile, tuple(names), best, history, lemmas)


def _stale(history: list[dict], patience: int | None) -> bool:
    """Has the validation loss not fallen for ``patience`` epochs?"""
    losses = [h["val_loss"] for h in history if h["val_loss"] is not None]
    return patience is not None and len(losses) > patience and min(losses[-patience:]) >= min(losses[:-patience])
