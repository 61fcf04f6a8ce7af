"""Dictionaries that are tables: stop words, lemmas, contractions of any size.

For a dictionary of a few hundred entries the column functions in :mod:`pulse.functions.text`
do the same without a join.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.binding import once
from ..functions.text import split_words
from ..functions.wordarrays import looked_up
from ..session import ship_package
from ..settle import settle


#: A list of at most so many words is compared with every word in place.
SHORT_LIST = 10_000


def lookup_tokens(
    df: DataFrame, key: str, words: Column, table: DataFrame, value: str,
    default: Callable[[Column], Column], keep: Sequence[str] = (), into: str = "values",
) -> DataFrame:
    """``key``, the columns of ``keep``, and the array ``into``: each row's tokens looked up in ``table(token, value)``, order kept.

    Tokens the table does not hold become ``default`` of the token. Only distinct tokens of a row
    are looked up. The row's own tokens travel with the first of them, so texts are worked on once and
    nothing is joined with itself; what the look-up does not find falls out before anything is gathered by key.
    A row without tokens gets an empty array. ``key`` must be unique.
    """
    rows = once(df, _words=words).select(key, F.struct("_words", *keep).alias("_all"), "_words")
    entries = table.select(F.col("token").alias("_token"), F.col(value).alias("_value"))
    asked = F.transform(F.array_distinct("_words"), lambda w, i: F.struct(
        w.alias("_token"), (i == 0).alias("_first"), F.when(i == 0, F.col("_all")).alias("_own")))
    alone = F.array(F.struct(F.lit(None).cast("string").alias("_token"), F.lit(True).alias("_first"), F.col("_all").alias("_own")))
    spread = rows.select(key, F.inline(F.when(F.size("_words") > 0, asked).otherwise(alone)))
    found = spread.join(entries, "_token", "left").where(F.col("_first") | F.col("_value").isNotNull())
    pair = F.when(F.col("_value").isNotNull(), F.struct("_token", "_value"))
    whole = found.groupBy(key).agg(F.first("_own", ignorenulls=True).alias("_own"), F.collect_list(pair).alias("_known"))
    own, kind = F.col("_own._words"), dict(table.dtypes)[value]
    # a row's words are matched with what was found for it by numbers: a map would be searched from its beginning for each of them
    ship_package(df.sparkSession)
    whole = whole.withColumn("_values", looked_up(own, F.col("_known._token"), F.col("_known._value"), kind))
    values = F.zip_with(own, "_values", lambda w, v: F.coalesce(v, default(w)))
    none = F.array().cast(f"array<{kind}>")
    return whole.select(key, *[F.col("_own").getField(c).alias(c) for c in keep], F.coalesce(values, none).alias(into))


def apply_lexicon(df: DataFrame, key: str, tokens_col: str, lexicon: DataFrame) -> DataFrame:
    """``key`` and ``tokens_col`` with tokens replaced through ``lexicon(token, replacement)``.

    A replacement of several words becomes several tokens. Of two entries for a token the
    smaller counts. The lexicon is written first, so that the join is planned by its true size.
    """
    entries = lexicon.groupBy("token").agg(F.min("replacement").alias("replacement"))
    table = settle(entries, "lexicon")
    out = lookup_tokens(df, key, F.col(tokens_col), table, "replacement", lambda w: w)
    words = F.flatten(F.transform("values", lambda v: F.split(v, " ")))
    return out.select(key, words.alias(tokens_col))


def drop_listed(df: DataFrame, key: str, text_col: str, listed: DataFrame) -> DataFrame:
    """``key`` and ``text_col`` without the words of the table ``listed(word)``.

    Up to ``SHORT_LIST`` words are compared where the texts are, and no text moves. A longer list is looked up by a join.
    """
    marked = listed.select(F.col("word").alias("token"), F.lit("").alias("gone")).distinct()
    marked = settle(marked, "listed")
    short = [r.token for r in marked.where(F.col("token").isNotNull()).select("token").limit(SHORT_LIST + 1).collect()]
    if len(short) <= SHORT_LIST:
        kept = F.filter(split_words(F.col(text_col)), lambda w: ~w.isin(short))
        return df.select(key, F.coalesce(F.array_join(kept, " "), F.lit("")).alias(text_col))
    out = lookup_tokens(df, key, split_words(F.col(text_col)), marked, "gone", lambda w: w)
    kept = F.filter("values", lambda v: v != "")
    return out.select(key, F.array_join(kept, " ").alias(text_col))


# Plural endings and what they stand for, tried in this order.
NOUN_ENDINGS = (
    ("ies", "y"), ("ves", "f"), ("ves", "fe"), ("ses", "s"), ("xes", "x"), ("ches", "ch"), ("shes", "sh"),
    ("men", "man"), ("s", ""),
)


def noun_lemmas(words: DataFrame, known: DataFrame, irregular: Mapping[str, str] | None = None) -> DataFrame:
    """A lexicon ``token, replacement`` for those of ``words(word)`` that are regular plurals.

    An ending is taken off only if what is left is in the table ``known(word)``; the first ending
    whose stem is known counts. ``irregular`` forms go first and need not be known.
    """
    irregular = dict(irregular or {})
    own = words.select("word").where(F.col("word").isNotNull()).distinct()
    regular = own.where(~F.col("word").isin(list(irregular))) if irregular else own
    stems = F.array(*[
        F.when(F.col("word").endswith(end) & (F.length("word") > len(end)), F.struct(
            F.lit(i).alias("rank"), F.concat(F.expr(f"left(word, length(word) - {len(end)})"), F.lit(stem)).alias("stem")))
        for i, (end, stem) in enumerate(NOUN_ENDINGS)])
    tried = regular.select("word", F.explode(F.array_compact(stems)).alias("s")).select("word", "s.rank", "s.stem")
    found = tried.join(known.select(F.col("word").alias("stem")).distinct(), "stem", "left_semi")
    best = found.groupBy("word").agg(F.min_by("stem", "rank").alias("replacement"))
    lexicon = best.select(F.col("word").alias("token"), "replacement")
    if irregular:
        fixed = F.create_map(*[F.lit(x) for pair in irregular.items() for x in pair])
        lexicon = lexicon.union(own.where(F.col("word").isin(list(irregular))).select("word", F.element_at(fixed, F.col("word"))))
    return lexicon


def own_lemmas(
    key: str, irregular: Mapping[str, str] | None = None, known: DataFrame | None = None, text_col: str = "clean_text",
) -> Callable[[DataFrame], DataFrame]:
    """A last cleaning step: nouns to forms that the corpus itself has, or the table ``known(word)``.

    The frame is written, its distinct words are rewritten once (:func:`noun_lemmas`), and the texts look theirs up. ``key``
    must be unique. A null text becomes an empty one.
    """

    def rewrite(df: DataFrame) -> DataFrame:
        rows = settle(df, "cleaned")
        words = settle(rows.select(F.explode_outer(split_words(F.col(text_col))).alias("word")).where(F.col("word").isNotNull()).distinct(), "own-words")
        lexicon = settle(noun_lemmas(words, words if known is None else known, irregular), "own-lemmas")
        others = [c for c in df.columns if c not in (key, text_col)]
        out = lookup_tokens(rows, key, split_words(F.col(text_col)), lexicon, "replacement", lambda w: w, others, "_rewritten")
        return out.select(*[F.array_join("_rewritten", " ").alias(c) if c == text_col else c for c in df.columns])

    return rewrite


def unlisted_words(counts: DataFrame, listed: DataFrame) -> DataFrame:
    """Word counts without the words of ``listed(word)``.

    It takes counts, not texts: after the aggregation every word is one row, so no word is hot.
    """
    return counts.join(listed.select("word"), "word", "left_anti")


def lemma_counts(counts: DataFrame, lexicon: DataFrame) -> DataFrame:
    """Word counts summed per lemma; counting lemmas does not need the texts rebuilt."""
    named = lexicon.groupBy(F.col("token").alias("word")).agg(F.min("replacement").alias("replacement"))
    joined = counts.join(named, "word", "left")
    lemma = F.coalesce("replacement", "word").alias("word")
    return joined.groupBy(lemma).agg(F.sum("n").alias("n"))
