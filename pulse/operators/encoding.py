"""Vocabulary and fixed-length sequence encoding, at word level."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..settle import settle
from .lexicon import lookup_tokens

# Special tokens; their ids are their positions, padding being 0.
SPECIALS = ("[PAD]", "[UNK]", "[CLS]", "[SEP]", "[MASK]")
PAD, UNK, CLS, SEP = (SPECIALS.index(s) for s in ("[PAD]", "[UNK]", "[CLS]", "[SEP]"))


def build_vocab(df: DataFrame, tokens_col: str, size: int = 30_522) -> DataFrame:
    """``token, id, n``: the most frequent tokens, so many that with the specials there are
    ``size`` ids. Ties go to the smaller token.

    Ids are numbered after the cut, on at most ``size`` rows.
    """
    # a plain explode would have the optimizer test the array for emptiness first, by
    # tokenising the text once more
    words = df.select(F.explode_outer(tokens_col).alias("token")).where(F.col("token").isNotNull())
    counts = words.groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    best = [F.desc("n"), F.asc("token")]
    kept = counts.orderBy(*best).limit(size - len(SPECIALS))
    rank = F.row_number().over(W.orderBy(*best))
    numbered = kept.withColumn("id", (rank + len(SPECIALS) - 1).cast("int"))
    return settle(numbered.select("token", "id", "n"), "vocab")


def encode(
    df: DataFrame, key: str, tokens_col: str, vocab: DataFrame, max_len: int = 128
) -> DataFrame:
    """``key, input_ids, attention_mask``, both of length ``max_len``.

    As a sequence model wants it: class mark, at most ``max_len - 2`` token ids, separator,
    padding. The cut comes before the tokens are looked up, so no more is shuffled than is kept.
    """
    head = F.slice(F.col(tokens_col), 1, max_len - 2)
    ids = lookup_tokens(df, key, head, vocab, "id", lambda _: F.lit(UNK))
    body = F.concat(F.array(F.lit(CLS)), F.col("values"), F.array(F.lit(SEP)))
    used = F.size("values") + 2
    pad = F.array_repeat(F.lit(PAD), F.lit(max_len) - used)
    mask = F.concat(F.array_repeat(F.lit(1), used), F.array_repeat(F.lit(0), F.lit(max_len) - used))
    return ids.select(key, F.concat(body, pad).alias("input_ids"), mask.alias("attention_mask"))
