"""The training job: labelled texts to a model and its evaluation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.ml import Estimator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.binding import once
from ..functions.labels import EMOTIONS, SENTIMENTS, encode_labels
from ..functions.text import clean, normalize
from ..functions.wordlists import STOPWORDS
from ..operators.bayes import Bayes, fit_bayes
from ..operators.datasets import length_filter, split
from ..operators.epochs import Settings, Trained, fit_epochs
from ..operators.evaluate import best_run, last_is_best, metrics, report
from ..operators.scoring import score_frame, with_predictions
from ..operators.train import Fitted, fit
from ..session import ship_package
from ..settle import settle

PROFILE = "training"
RUNS_AT_ONCE = 4


def training_rows(
    df: DataFrame, key: str, seed: str | int, lemmas: Mapping[str, str] | None = None
) -> DataFrame:
    """``df(key, text, sentiment)`` cleaned, without length outliers, coded and split."""
    cleaned = once(df, clean_text=normalize(F.col("text"), PROFILE, lemmas))
    coded = length_filter(cleaned, "clean_text").withColumn("label", encode_labels(F.col("sentiment")))
    return split(coded.where(F.col("label").isNotNull()), key, seed)


def train_and_evaluate(
    rows: DataFrame, estimator: Estimator | None = None, candidates: Mapping[str, Estimator] | None = None,
    profile: str = PROFILE, names: Sequence[str] = SENTIMENTS, lemmas: Mapping[str, str] | None = None,
) -> tuple[Fitted, DataFrame, DataFrame]:
    """Fit on the train rows; overall metrics and class report on the test rows.

    Of several ``candidates`` (name -> estimator) the one with the best accuracy on the validation
    rows is kept. ``profile`` and ``lemmas`` tell how ``rows`` were cleaned; the model keeps them.
    Fitting passes over its rows many times, so they are cleaned once and written first.
    """
    rows = settle(rows.select("clean_text", "label", "split"), "training")
    train, val, test = (rows.where(F.col("split") == part) for part in ("train", "val", "test"))
    fitted = {name: fit(train, profile, names=names, estimator=e, lemmas=lemmas)
              for name, e in (candidates or {"only": estimator}).items()}
    kept = next(iter(fitted))
    if len(fitted) > 1:
        runs = [(name, 1, metrics(f.predict(val, profile), "label", "logits", len(names)).first().accuracy)
                for name, f in fitted.items()]  # a row per candidate
        best = best_run(rows.sparkSession.createDataFrame(runs, "run string, epoch int, val_accuracy double")).first()
        kept = best.run if best else kept
    held = with_predictions(fitted[kept].predict(test, profile), names=names)
    return (
        fitted[kept],
        metrics(held, "label", "logits", len(names)),
        report(held, "label", "class_predictions", names),
    )


def train_by_epochs(
    rows: DataFrame, key: str, folder: str, runs: Mapping[str, Settings], last_only: bool = False, profile: str = PROFILE,
    names: Sequence[str] = SENTIMENTS, lemmas: Mapping[str, str] | None = None,
) -> tuple[Trained | None, DataFrame, DataFrame | None, DataFrame | None]:
    """Several runs by epochs: the model to keep, a row per run and epoch, overall metrics and class report on the test rows.

    Kept is the epoch with the best accuracy on the validation rows over all runs. With ``last_only`` a run counts only if its last epoch was its
    best, and there may be none to keep. A call that was cut off goes on where it was, in the same ``folder``.
    The steps of a run follow each other, each a small job; so up to ``RUNS_AT_ONCE`` runs go on side by side.
    """
    rows = settle(rows.select(key, "clean_text", "label", "split"), "training")
    ship_package(rows.sparkSession)  # once, before several ask for it
    with ThreadPoolExecutor(min(RUNS_AT_ONCE, max(1, len(runs)))) as pool:
        begun = {name: pool.submit(fit_epochs, rows, key, folder, profile, s, name, names=names, lemmas=lemmas) for name, s in runs.items()}
    trained = {name: run.result() for name, run in begun.items()}
    history = reduce(DataFrame.unionByName, [t.history for t in trained.values()])
    counted = history
    if last_only:
        counted = history.join(last_is_best(history).where("keep").select("run"), "run", "left_semi")
    best = best_run(counted).first()
    if not best or best.run is None:
        return None, history, None, None
    kept = trained[best.run]
    held = settle(with_predictions(kept.predict(rows.where(F.col("split") == "test")), names=names), "epoch-scores")
    return kept, history, metrics(held, "label", "logits", len(names)), report(held, "label", "class_predictions", names)


def emotion_job(
    rows: DataFrame, key: str, seed: str | int = 2018, names: Sequence[str] = EMOTIONS
) -> tuple[Bayes, DataFrame, DataFrame]:
    """``rows(key, text, label)``, as read from JSON lines, to a model, its score frame and its report.

    A fifth of the rows is held out; both tables are about those.
    """
    whole = rows.where(F.col("text").isNotNull() & F.col("label").isNotNull())
    cleaned = once(whole, clean_text=clean(F.col("text"), "emotion", STOPWORDS))
    parts = settle(split(cleaned, key, seed, test=0.2, val=0.0), "emotions")
    model = fit_bayes(parts.where(F.col("split") == "train"), "emotion", names=names)
    held = settle(with_predictions(model.predict(parts.where(F.col("split") == "test"), key), names=names), "emotion-scores")
    frame = score_frame(held.select(key, "text"), held.select(key, "logits"), key, names)
    return model, frame, report(held, "label", "class_predictions", names)
