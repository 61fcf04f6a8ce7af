"""Scoring of token sequences in padded batches of nearly equal length.

A model that takes a matrix per batch pays for its longest row. Rows are therefore dealt out by length: a range of
lengths goes to a task, which fills batches in order of length. Every row keeps its columns, so
nothing is joined afterwards.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence
from typing import Protocol

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.binding import once
from ..functions.labels import SENTIMENTS
from ..functions.text import split_words
from ..session import ship_package
from .encoding import PAD
from .epochs import hashed_words
from .scoring import Model, _predictor

#: Tokens of a row that a model reads at most, and cells of a batch, padding included.
LIMIT, CELLS = 512, 1 << 15


class SequenceScorer(Protocol):
    """A classifier of padded sequences that Python workers load themselves."""

    name: str

    def load(self) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
        """Return a function from ids and mask, both (rows x width), to a (rows x classes) array of logits."""


def batches_of(sizes: np.ndarray, cells: int) -> list[tuple[int, int]]:
    """Consecutive rows that make a batch, each at most ``cells`` times rows by longest row, and at least one row."""
    out, begin, width = [], 0, 0
    for i, n in enumerate(sizes.tolist()):
        wider = max(width, n, 1)
        if i > begin and wider * (i + 1 - begin) > cells:
            out.append((begin, i))
            begin, wider = i, max(n, 1)
        width = wider
    return out + ([(begin, len(sizes))] if len(sizes) > begin else [])


def padded(tokens: pa.ListArray, pad: int = PAD) -> tuple[np.ndarray, np.ndarray]:
    """Ids and mask of a batch as matrices."""
    sizes = np.asarray(tokens.value_lengths().fill_null(0)).astype(np.int64)
    mask = np.arange(max(int(sizes.max(initial=0)), 1)) < sizes[:, None]
    ids = np.full(mask.shape, pad, np.int32)
    ids[mask] = np.asarray(tokens.flatten())
    return ids, mask.astype(np.int8)


def score_padded(
    df: DataFrame, tokens_col: str, scorer: SequenceScorer, limit: int = LIMIT, cells: int = CELLS,
    pad: int = PAD, width_col: str | None = None,
) -> DataFrame:
    """Add ``logits`` for the token ids in ``tokens_col``, of which the first ``limit`` are read.

    ``width_col`` names a column for the width of the row's batch: 1 - sum(tokens read) / sum(width) is the share
    of padding. A null or empty row is one of padding only. Rows of one length are spread by a hash of all their
    columns, a key among them, so no length is too frequent for a task: the place of a row depends on the row alone, and
    a task that is run again gets the same rows. Tasks hold a batch of rows at a time.
    """
    ship_package(df.sparkSession)
    version = hashlib.sha256(cloudpickle.dumps(scorer)).hexdigest()
    tokens = F.slice(F.col(tokens_col), 1, limit)
    # a null array's size is null, or less than none in older settings
    size = F.greatest(F.coalesce(F.size("_tokens"), F.lit(0)), F.lit(0))
    sized = df.select(*df.columns, tokens.alias("_tokens")).select(
        "*", size.alias("_n"), F.xxhash64(*df.columns).alias("_spread"))
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = sized.repartitionByRange(parts, "_n", "_spread").sortWithinPartitions("_n").drop("_n", "_spread")
    extra = [T.StructField(width_col, T.IntegerType())] if width_col else []
    schema = T.StructType([*df.schema.fields, T.StructField("logits", T.ArrayType(T.DoubleType())), *extra])
    kept = len(df.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        predict = _predictor(scorer, version)
        for batch in batches:
            tokens = batch.column(kept)
            for a, b in batches_of(np.asarray(tokens.value_lengths().fill_null(0)), cells):
                ids, mask = padded(tokens[a:b], pad)
                z = np.asarray(predict(ids, mask), dtype=np.float64)
                ends = pa.array(np.arange(b - a + 1, dtype=np.int32) * z.shape[1])
                made = [pa.ListArray.from_arrays(ends, pa.array(z.ravel()))]
                if width_col:
                    made.append(pa.array(np.full(b - a, ids.shape[1], np.int32)))
                yield pa.RecordBatch.from_arrays([*(batch.column(i)[a:b] for i in range(kept)), *made], names=schema.names)

    return dealt.mapInArrow(run, schema)


def sequence_model(
    scorer: SequenceScorer, bits: int, profile: str = "serving", names: Sequence[str] = SENTIMENTS, limit: int = LIMIT,
) -> Model:
    """A sequence scorer as jobs take it; it reads the hashed words of the clean text."""

    def apply(df: DataFrame) -> DataFrame:
        words = once(df, _words=hashed_words(split_words(F.col("clean_text")), bits))
        return score_padded(words, "_words", scorer, limit).drop("_words")

    return Model(apply, profile, None, tuple(names))
