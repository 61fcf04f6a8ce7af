"""Multinomial naive Bayes over word counts: fitted by counting, scored by a join."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.binding import once
from ..functions.labels import SENTIMENTS
from ..functions.text import split_words
from ..functions.wordarrays import tallied
from ..session import ship_package
from ..settle import settle
from .scoring import Model


@dataclass(frozen=True)
class Bayes:
    """``words(word, z0, z1, ...)`` with each class's log probability of a word, and the classes' log priors."""

    words: DataFrame
    priors: tuple[float, ...]
    profile: str
    names: tuple[str, ...]
    lemmas: Mapping[str, str] | None = None

    def predict(self, df: DataFrame, key: str, text_col: str = "clean_text") -> DataFrame:
        """Add ``logits``: the prior and the words that training saw, each as often as it occurs.

        A row's distinct words are looked up with their counts, and their numbers summed where they are, then by ``key``, which must be unique.
        A row's columns travel with its first word, so nothing is joined with itself and texts are worked on
        once. A text without known words has the priors.
        """
        z = [f"z{i}" for i in range(len(self.priors))]
        rows = once(df.select(key, F.struct(*df.columns).alias("_row"), text_col), _words=split_words(F.col(text_col)))
        ship_package(df.sparkSession)
        rows = rows.withColumn("_words", tallied(F.col("_words")))
        asked = F.transform("_words", lambda w, i: F.struct(w["word"].alias("word"), w["n"].alias("_n"), F.when(i == 0, F.col("_row")).alias("_own")))
        alone = F.array(F.struct(F.lit(None).cast("string").alias("word"), F.lit(None).cast("long").alias("_n"), F.col("_row").alias("_own")))
        spread = rows.select(F.col(key).alias("_key"), F.inline(F.when(F.size("_words") > 0, asked).otherwise(alone)))
        known = spread.join(self.words, "word", "left").where(F.col("_own").isNotNull() | F.col(z[0]).isNotNull())
        sums = known.groupBy("_key").agg(F.first("_own", ignorenulls=True).alias("_row"), *[F.sum(F.col("_n") * F.col(c)).alias(c) for c in z])
        logits = F.array(*[F.lit(p) + F.coalesce(F.col(c), F.lit(0.0)) for c, p in zip(z, self.priors)])
        return sums.select(*[F.col("_row").getField(c).alias(c) for c in df.columns], logits.alias("logits"))

    def as_model(self, key: str) -> Model:
        """The model as jobs take it, for rows with the unique column ``key``."""
        return Model(lambda df: self.predict(df, key), self.profile, self.lemmas, self.names)


def fit_bayes(
    df: DataFrame, profile: str, text_col: str = "clean_text", label_col: str = "label",
    names: Sequence[str] = SENTIMENTS, smoothing: float = 1.0, lemmas: Mapping[str, str] | None = None,
) -> Bayes:
    """Fit on rows with a text and a class 0 to ``len(names) - 1``.

    Words are counted per class in one aggregation, a row per word; the driver sees totals only.
    Every class and every word gets ``smoothing`` besides its count.
    """
    k = len(names)
    rows = df.select(F.col(text_col).alias("t"), F.col(label_col).cast("int").alias("y")).where(
        F.col("t").isNotNull() & F.col("y").between(0, k - 1))
    rows = settle(rows, "bayes-rows")
    n = rows.agg(F.count(F.lit(1)), *[F.count_if(F.col("y") == i) for i in range(k)]).first()
    words = rows.select("y", F.explode(split_words(F.col("t"))).alias("word"))
    counts = settle(words.groupBy("word").agg(*[F.count_if(F.col("y") == i).alias(f"n{i}") for i in range(k)]), "bayes-counts")
    total = counts.agg(F.count(F.lit(1)), *[F.coalesce(F.sum(f"n{i}"), F.lit(0)) for i in range(k)]).first()

    def part(i: int) -> Column:
        return F.log((F.col(f"n{i}") + F.lit(float(smoothing))) / F.lit(float(total[1 + i] + smoothing * total[0])))

    table = counts.select("word", *[part(i).alias(f"z{i}") for i in range(k)])
    priors = df.sparkSession.range(1).select(*[F.log(F.lit((n[1 + i] + smoothing) / (n[0] + smoothing * k))) for i in range(k)]).first()
    return Bayes(settle(table, "bayes-words"), tuple(priors), profile, tuple(names), lemmas)
