"""Scores to predictions, and the slot for a classifier."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass
from typing import Any, Protocol

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.binding import let, once
from ..functions.labels import SENTIMENTS, decode
from ..functions.text import normalize
from ..functions.vectors import argmax, confidence, softmax
from ..session import ship_package


class Scorer(Protocol):
    """A classifier that Python workers load themselves."""

    name: str
    """Names the model; each worker process keeps the latest scorer of a name loaded."""

    def load(self) -> Callable[[pd.Series], Any]:
        """Return a function from a batch of inputs to an (inputs x classes) array of logits."""


_loaded: dict[str, tuple[str, Callable[[pd.Series], Any]]] = {}


def _predictor(scorer: Scorer, version: str) -> Callable[[pd.Series], Any]:
    """Workers outlive a query, so a model trained anew under the same name must not be taken for the old one."""
    if _loaded.get(scorer.name, ("",))[0] != version:
        _loaded[scorer.name] = version, scorer.load()
    return _loaded[scorer.name][1]


def score(df: DataFrame, scorer: Scorer, input_col: str = "clean_text") -> DataFrame:
    """Add ``logits`` computed by any Python model.

    Only ``input_col`` travels to Python, in Arrow batches of bounded size
    (``spark.sql.execution.arrow.maxRecordsPerBatch``); the other columns stay where they are.
    """
    ship_package(df.sparkSession)
    version = hashlib.sha256(cloudpickle.dumps(scorer)).hexdigest()

    @F.pandas_udf("array<double>")
    def logits(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        predict = _predictor(scorer, version)
        for batch in batches:
            yield pd.Series(list(np.asarray(predict(batch), dtype="float64")), dtype=object)

    return df.withColumn("logits", logits(F.col(input_col)))


@dataclass(frozen=True)
class Model:
    """A classifier as every job takes it.

    ``apply`` adds ``logits`` to a frame with ``clean_text``. The model knows how texts must be
    cleaned for it, so jobs cannot clean them in another way than it was trained on. ``rewrite`` is a last step of
    that over whole frames, for lexicons that are tables (see :func:`.lexicon.own_lemmas`).
    """

    apply: Callable[[DataFrame], DataFrame]
    profile: str = "serving"
    lemmas: Mapping[str, str] | None = None
    names: tuple[str, ...] = SENTIMENTS
    rewrite: Callable[[DataFrame], DataFrame] | None = None

    def cleaned(self, df: DataFrame, text_col: str) -> DataFrame:
        """``df`` with ``clean_text`` as the model wants it."""
        out = once(df, clean_text=normalize(F.col(text_col), self.profile, self.lemmas))
        return self.rewrite(out) if self.rewrite else out


def column_model(
    logits: Callable[[Column], Column], profile: str = "serving",
    lemmas: Mapping[str, str] | None = None, names: Sequence[str] = SENTIMENTS,
    rewrite: Callable[[DataFrame], DataFrame] | None = None,
) -> Model:
    """A model that is a column expression over the clean text."""
    return Model(lambda df: df.withColumn("logits", logits(F.col("clean_text"))), profile, lemmas, tuple(names), rewrite)


def python_model(
    scorer: Scorer, profile: str = "serving", lemmas: Mapping[str, str] | None = None,
    names: Sequence[str] = SENTIMENTS,
) -> Model:
    """A model that Python workers load themselves."""
    return Model(lambda df: score(df, scorer), profile, lemmas, tuple(names))


def as_model(
    model: Model | Callable[[Column], Column], profile: str, lemmas: Mapping[str, str] | None
) -> Model:
    """``model`` itself, or a plain column function with the cleaning the job would use."""
    return model if isinstance(model, Model) else column_model(model, profile, lemmas)


def word_logits(
    words: Column, weights: Mapping[str, Sequence[float]], bias: Sequence[float]
) -> Column:
    """Logits of a linear bag-of-words classifier: bias plus the weights of the words present.

    Repeated words count each time. A hashed test drops unweighted words before any lookup.
    """

    def logit(known: Column, c: int) -> Column:
        table = F.create_map(*[x for w, v in weights.items() for x in (F.lit(w), F.lit(float(v[c])))])
        return F.aggregate(known, F.lit(float(bias[c])), lambda acc, w: acc + table[w])

    return let(
        F.filter(words, lambda w: w.isin(list(weights))),
        lambda known: F.array(*[logit(known, c) for c in range(len(bias))]),
    )


def with_predictions(
    df: DataFrame, logits_col: str = "logits", names: Sequence[str] = SENTIMENTS
) -> DataFrame:
    """Add ``class_predictions`` and ``sentiment_labels``; the first class wins ties."""
    scored = df.withColumn("class_predictions", argmax(F.col(logits_col)))
    return scored.withColumn("sentiment_labels", decode(F.col("class_predictions"), names))


def with_probabilities(df: DataFrame, names: Sequence[str], logits_col: str = "logits") -> DataFrame:
    """Add one probability column per class name, and ``Overall_Score``, the largest of them."""
    p = df.withColumn("_p", softmax(F.col(logits_col), len(names)))
    cells = {name: F.col("_p")[i] for i, name in enumerate(names)}
    return p.withColumns({**cells, "Overall_Score": confidence(F.col("_p"))}).drop("_p")


def score_frame(
    texts: DataFrame, scores: DataFrame, key: str, names: Sequence[str],
    text_col: str = "text", logits_col: str = "logits",
) -> DataFrame:
    """``key, Text``, one probability per class and ``Overall_Score``.

    Texts and scores meet on a row key: tables have no row positions to glue by.
    """
    scored = with_probabilities(scores.select(key, logits_col), names, logits_col).drop(logits_col)
    return texts.select(key, F.col(text_col).alias("Text")).join(scored, key)
