"""Everything the dashboard shows for one request, as tables."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.wordlists import STOPWORDS
from ..operators.aggregates import label_counts, label_pivot, length_density, length_hist, top_words
from ..operators.entities import mentions_in
from ..operators.periods import with_period
from ..operators.scoring import Model, as_model, with_predictions
from ..operators.topn import drop_stickied, top_n_per_post, top_posts
from ..settle import settle

REPORT = ("comment_text", "sentiment_labels", "comment_created", "period_int", "post_title",
          "named_entities")


@dataclass(frozen=True)
class Dashboard:
    report: DataFrame
    over_time: DataFrame
    counts: DataFrame
    words: DataFrame | None = None
    lengths: DataFrame | None = None
    density: DataFrame | None = None


def tag_posts(posts: DataFrame, gazetteer: Mapping[str, str]) -> DataFrame:
    """Posts with ``post_entities``: mentions in the title, then in the text.

    Done before the join with the comments, so each post is searched once.
    """
    found = F.concat(
        mentions_in(F.coalesce("post_title", F.lit("")), gazetteer),
        mentions_in(F.coalesce("post_text", F.lit("")), gazetteer),
    )
    return posts.withColumn("post_entities", found)


def enrich(
    comments: DataFrame, model: Model | Callable[[Column], Column], profile: str = "serving",
    lemmas: Mapping[str, str] | None = None,
) -> DataFrame:
    """Add clean text, logits, class and label to comments.

    ``model`` brings its own cleaning; ``profile`` and ``lemmas`` are for a plain column function.
    """
    model = as_model(model, profile, lemmas)
    return with_predictions(model.apply(model.cleaned(comments, "comment_text")), names=model.names)


def with_entities(
    posts: DataFrame, comments: DataFrame, gazetteer: Mapping[str, str]
) -> DataFrame:
    """Comments with their post's columns and ``named_entities``: title, post text, own text.

    Both sides are searched where they lie; one join brings them together.
    """
    own = mentions_in(F.coalesce("comment_text", F.lit("")), gazetteer)
    joined = comments.withColumn("own_entities", own).join(tag_posts(posts, gazetteer), "post_id")
    return joined.withColumn("named_entities", F.concat("post_entities", "own_entities"))


def comment_report(
    posts: DataFrame, comments: DataFrame, model: Model | Callable[[Column], Column],
    gazetteer: Mapping[str, str], period: str = "D", lemmas: Mapping[str, str] | None = None,
) -> DataFrame:
    """Every comment with label, period number, post title and entities.

    Beside the report columns, ``post_id`` and ``clean_text`` stay available. Periods come
    first: finding them must read the times only, not clean texts.
    """
    scored = enrich(with_period(comments, "comment_created", period), model, lemmas=lemmas)
    return with_entities(posts, scored, gazetteer)


def dashboard(
    posts: DataFrame, comments: DataFrame, model: Model | Callable[[Column], Column],
    gazetteer: Mapping[str, str], period: str = "D", show_text_analysis: bool = False,
    n_words: int = 20, bins: int = 30, stopwords: Iterable[str] = STOPWORDS,
) -> Dashboard:
    """``posts(post_id, post_title, post_text)`` and ``comments(post_id, comment_text,
    comment_created)`` to the tables shown.

    All tables come from the scored comments, so those are computed once and written; each
    table then reads the columns it needs. Only the report joins the posts.
    """
    asked = comments.join(posts.select("post_id"), "post_id", "left_semi")
    columns = ("post_id", "comment_text", "comment_created", "clean_text", "sentiment_labels")
    scored = settle(enrich(asked, model).select(*columns), "scored")
    dated = with_period(scored, "comment_created", period)
    shown = with_entities(posts, dated, gazetteer).select(*REPORT)
    over_time, counts = (f(scored, period=period) for f in (label_counts, label_pivot))
    if not show_text_analysis:
        return Dashboard(shown, over_time, counts)
    return Dashboard(
        shown, over_time, counts,
        top_words(scored, n=n_words, stopwords=stopwords),
        length_hist(scored, bins=bins),
        length_density(scored, bins=bins),
    )


def dashboard_for(
    posts: DataFrame, comments: DataFrame, model: Model | Callable[[Column], Column], community: str,
    as_of: datetime, time_filter: str = "month", num_posts: int = 10, num_comments: int = 5,
    gazetteer: Mapping[str, str] | None = None, **shown,
) -> Dashboard:
    """A request from end to end: the best posts of a community, their first comments, all tables.

    ``posts(post_id, community, created, score, post_title, post_text)`` and ``comments(post_id, rank,
    stickied, comment_text, comment_created)``. The slice of ``num_comments + 2`` comes before pinned
    ones are dropped, so a post may show fewer or more than asked. ``shown`` goes to :func:`dashboard`.
    """
    chosen = settle(top_posts(posts, community, as_of, time_filter, num_posts), "posts")
    own = comments.join(chosen.select("post_id"), "post_id", "left_semi")
    first = top_n_per_post(own, num_comments + 2, [F.asc("rank")])
    return dashboard(chosen, drop_stickied(first).drop("rn"), model, gazetteer or {}, **shown)
