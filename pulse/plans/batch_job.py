"""The batch job: fetched comments to two CSV tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame

from ..operators.periods import with_period
from ..operators.scoring import Model
from ..sources.files import write_csv
from .dashboard import enrich

CLEANED = ("comment_text", "comment_created", "clean_text", "class_predictions",
           "sentiment_labels", "period_date", "period_int")


def cleaned_comments(
    comments: DataFrame, model: Model | Callable[[Column], Column], period: str = "W",
    lemmas: Mapping[str, str] | None = None,
) -> DataFrame:
    """``comments(comment_text, comment_created)`` dated, cleaned and scored.

    Dated first: finding the periods then reads the times only.
    """
    dated = with_period(comments, "comment_created", period)
    return enrich(dated, model, "batch", lemmas).select(*CLEANED)


def run(
    comments: DataFrame, model: Model | Callable[[Column], Column], folder: str, period: str = "W",
    lemmas: Mapping[str, str] | None = None,
) -> None:
    """Write ``raw_comments`` as they came and ``cleaned_comments`` with all derived columns."""
    write_csv(comments.select("comment_text", "comment_created"), f"{folder}/raw_comments")
    write_csv(cleaned_comments(comments, model, period, lemmas), f"{folder}/cleaned_comments")
