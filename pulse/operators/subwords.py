"""Sub-word encoding by greedy longest match against a given vocabulary.

Only the distinct words of the corpus are cut into pieces, so the work grows with the vocabulary of the texts,
not with their length; rows then look their words up.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..settle import settle
from .encoding import CLS, PAD, SEP, SPECIALS, UNK
from .lexicon import lookup_tokens
from .positions import with_position

#: What a piece begins with that continues a word; words of more characters are unknown.
MARK, LONGEST_WORD = "##", 100


def read_vocab(spark: SparkSession, path: str) -> DataFrame:
    """``token, id`` from a vocabulary file with a token per line; the first line is id 0."""
    lines = with_position(spark.read.text(path), "id")
    return settle(lines.select(F.col("value").alias("token"), F.col("id").cast("int")), "vocab")


def pieces(words: DataFrame, vocab: DataFrame, mark: str = MARK, unknown: int = UNK) -> DataFrame:
    """``token, ids`` for the distinct, non-null ``words(token)``.

    From the left, the longest piece of ``vocab(token, id)`` is taken again and again; pieces after the first carry
    ``mark``. A word of which some rest has no piece is one ``unknown``, and so is one of over 100 characters. Of two ids for a piece the smaller counts.
    Words that are pieces themselves need no cutting.
    """
    table = settle(vocab.where(F.col("token").isNotNull()).groupBy("token").agg(F.min("id").cast("int").alias("id")), "pieces")
    longest = table.agg(F.max(F.length("token"))).first()[0] or 0
    own = words.select("token").where(F.col("token").isNotNull()).distinct()
    known = settle(own.join(table, "token", "left"), "words")
    rest = known.where(F.col("id").isNull()).select("token", F.length("token").alias("size"))
    places = rest.where(F.col("size").between(1, LONGEST_WORD)).select("token", "size", F.explode(F.sequence(F.lit(1), "size")).alias("at"))
    tried = places.select("token", "size", "at", F.explode(F.sequence(F.lit(1), F.least(F.lit(max(1, longest)), F.col("size") - F.col("at") + 1))).alias("long"))
    part = F.expr("substring(token, at, long)")
    named = tried.select(F.col("token").alias("word"), "size", "at", "long", F.when(F.col("at") == 1, part).otherwise(F.concat(F.lit(mark), part)).alias("token"))
    found = named.join(table, "token").groupBy("word", "size").agg(
        F.sort_array(F.collect_list(F.struct("at", (-F.col("long")).alias("minus"), "id"))).alias("found"))
    # by place, the longest first: what begins where the last one ended is taken, the others are passed over
    start = F.struct(F.lit(1).alias("next"), F.array().cast("array<int>").alias("ids"))
    walked = F.aggregate("found", start, lambda s, p: F.when(p["at"] == s["next"], F.struct(
        (s["next"] - p["minus"]).alias("next"), F.concat(s["ids"], F.array(p["id"])).alias("ids"))).otherwise(s))
    cut = found.select("word", "size", walked.alias("w")).where(F.col("w.next") == F.col("size") + 1).select("word", F.col("w.ids").alias("ids"))
    joined = known.join(cut, F.col("token") == F.col("word"), "left")
    return joined.select("token", F.coalesce(F.when(F.col("id").isNotNull(), F.array("id")), F.col("ids"), F.array(F.lit(unknown))).alias("ids"))


def encode_subwords(
    df: DataFrame, key: str, tokens_col: str, vocab: DataFrame, max_len: int = 128, mark: str = MARK,
    marks: tuple[int, int, int, int] = (PAD, UNK, CLS, SEP),
) -> DataFrame:
    """``key, input_ids, attention_mask``, both of length ``max_len``: class mark, at most ``max_len - 2`` pieces, separator, padding.

    ``marks`` are the vocabulary's ids of padding, unknown, class mark and separator. A row without tokens, or without a text, has the marks only.
    """
    pad, unknown, first, last = marks
    head = F.slice(F.col(tokens_col), 1, max_len - 2)  # a token is one piece at least
    words = df.select(F.explode_outer(head).alias("token"))
    table = settle(pieces(words, vocab, mark, unknown), "subwords")
    ids = lookup_tokens(df, key, head, table, "ids", lambda _: F.array(F.lit(unknown)))
    body = ids.select(key, F.slice(F.flatten("values"), 1, max_len - 2).alias("body"))
    used = F.size("body") + 2
    whole = F.concat(F.array(F.lit(first)), F.col("body"), F.array(F.lit(last)), F.array_repeat(F.lit(pad), F.lit(max_len) - used))
    mask = F.concat(F.array_repeat(F.lit(1), used), F.array_repeat(F.lit(0), F.lit(max_len) - used))
    return body.select(key, whole.alias("input_ids"), mask.alias("attention_mask"))


def subword_vocab(words: DataFrame, characters: str, mark: str = MARK) -> DataFrame:
    """A vocabulary ``token, id`` without any training, for tables that bring none.

    The tokens of a word vocabulary ``words(token, id)`` keep their ids and may also continue a word; ``characters`` are pieces
    both ways, so that no word of them is unknown. Ids go on after the specials and words.
    """
    letters = words.sparkSession.createDataFrame([(c, i) for i, c in enumerate(characters)], "token string, place int")
    size = words.agg(F.coalesce(F.max("id"), F.lit(len(SPECIALS) - 1)).alias("size"))
    top = size.scalar()
    both = words.select("token", F.col("id")).union(words.select(F.concat(F.lit(mark), "token"), F.col("id") + top))
    singles = letters.select("token", (2 * top + 1 + 2 * F.col("place")).alias("id")).union(
        letters.select(F.concat(F.lit(mark), "token"), 2 * top + 2 + 2 * F.col("place")))
    return both.union(singles).groupBy("token").agg(F.min("id").cast("int").alias("id"))
