"""Severity of toxic language by cumulative-link ordinal regression over sparse text features.

Model: ``P(grade > k) = sigmoid(w . x - t_k)`` with one weight vector for all ordered thresholds
``t_0 <= t_1 <= ...``. The expected severity is the sum of these probabilities. Features are the
words of a text and their first four to six bytes (which catch inflected forms), counted and
damped; those that depend most on the grade are kept.

Edge cases: a null or empty text has no features and gets the severity of a text without any of
them. Labels that are null, or of unknown documents, are left out; of several labels for one
document the highest counts. Without labels of two grades nothing is learned and every severity
is 0. Rows are scored one by one, so repeated rows and any further columns stay as they are; a
column named like one of the results is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..settle import settle
from . import arrow, words

#: Labelled rows that the fit looks at, about, at most (by the hash of their id).
SAMPLE_ROWS = 8000
#: Features kept: at most so many, each in this many sampled documents or more, and with a chi-square
#: statistic that chance does not reach among millions of features.
VOCABULARY, LEAST_DOCUMENTS, LEAST_CHI_SQUARE = 1024, 4, 20.0
#: Documents with this expected severity or more are toxic.
LIMIT = 0.5

_OUTSIDE = np.ones(256, bool)
for _lo, _hi in ((48, 58), (65, 91), (97, 123), (128, 256)):
    _OUTSIDE[_lo:_hi] = False
_PREFIXES = (4, 5, 6)


@dataclass(frozen=True)
class Ordinal:
    """Sorted feature hashes, their weights, and the ordered thresholds (none: nothing learned)."""

    features: np.ndarray
    weights: np.ndarray
    thresholds: np.ndarray

    def severity(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Expected severity and most likely grade for values of ``w . x``."""
        if not len(self.thresholds):
            return np.zeros(len(x)), np.zeros(len(x), np.int32)
        over = 1 / (1 + np.exp(-np.clip(x[:, None] - self.thresholds, -40, 40)))
        ends = np.ones((len(x), 1))
        grades = np.hstack([ends, over]) - np.hstack([over, 0 * ends])
        return over.sum(axis=1), grades.argmax(axis=1).astype(np.int32)


def _features(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Feature hashes of a batch (a row per word, a column per kind; 0: none), the row of each word, words per row."""
    body, rows = words.texts(column)
    body = words.LOWER[body]
    starts, ends, first = words.bounds(body, rows, _OUTSIDE)
    each = np.diff(first)
    found = np.zeros((1 + len(_PREFIXES), len(starts)), np.uint64)
    if len(starts):
        found[0] = words.hashes(body, starts, ends)
        for k, n in enumerate(_PREFIXES, 1):
            long = np.flatnonzero(ends - starts >= n)
            found[k, long] = words.hashes(body, starts[long], starts[long] + n) ^ np.uint64(n)
    return found, np.repeat(np.arange(len(each)), each), each


def _counts(found: np.ndarray, row: np.ndarray, wanted: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, feature and number of occurrences of every feature (or every wanted one; then its index)."""
    flat, at = found.reshape(-1), np.tile(row, len(found))
    if wanted is None:
        keep = flat != 0
    else:
        maybe = np.zeros(1 << 20, bool)
        maybe[(wanted >> np.uint64(44)).astype(np.int64)] = True
        keep = maybe[(flat >> np.uint64(44)).astype(np.int64)]
    flat, at = flat[keep], at[keep]
    if wanted is not None:
        place = np.searchsorted(wanted, flat)
        place[place == len(wanted)] = 0
        same = wanted[place] == flat if len(wanted) else np.zeros(len(flat), bool)
        flat, at = place[same].astype(np.uint64), at[same]
    order = np.lexsort((flat, at))
    flat, at = flat[order], at[order]
    new = np.flatnonzero(np.r_[True, (flat[1:] != flat[:-1]) | (at[1:] != at[:-1])]) if len(flat) else np.zeros(0, np.int64)
    return at[new], flat[new], np.diff(np.r_[new, len(flat)])


def _likeness(codes: np.ndarray, row: np.ndarray, n: int) -> list[pa.Array]:
    """For each row, two least hashes of its runs of three words (of its row number where it has none)."""
    runs = words.windows(codes, 3)
    whole = row[:len(runs)] == row[2:] if len(runs) else np.zeros(0, bool)
    runs, at = runs[whole], row[:len(runs)][whole]
    made = []
    for salt in (np.uint64(1), np.uint64(2)):
        least = words.mix(np.arange(n).astype(np.uint64) + salt) | np.uint64(1 << 63)
        np.minimum.at(least, at, words.mix(runs ^ salt) >> np.uint64(1))
        made.append(pa.array(least.view(np.int64)))
    return made


def _value(count: np.ndarray) -> np.ndarray:
    return np.log1p(count)


def fit_ordinal(row, feature, value, grades, n_features, steps=400, rate=0.1, ridge=1e-5) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds that maximise the penalised likelihood (full gradients, Adam).

    ``row``, ``feature``, ``value``: the sparse matrix; ``grades``: 0 to K - 1 for each row, all occurring.
    Thresholds are a first value and positive steps, which keeps them in order.
    """
    n, k = len(grades), int(grades.max())
    share = np.array([(grades > j).mean() for j in range(k)])
    start = -np.log(share / (1 - share))
    p = np.concatenate([np.zeros(n_features), start[:1], np.log(np.maximum(np.diff(start), 0.1))])
    m, v = np.zeros_like(p), np.zeros_like(p)
    sigmoid = lambda z: 1 / (1 + np.exp(-np.clip(z, -40, 40)))
    for step in range(1, steps + 1):
        w, t = p[:n_features], np.cumsum(np.concatenate([p[n_features:n_features + 1], np.exp(p[n_features + 1:])]))
        x = np.bincount(row, w[feature] * value, n)
        high = np.ones((n, k + 2))  # P(grade > j) for j = -1 .. k
        high[:, 1:-1], high[:, -1] = sigmoid(x[:, None] - t), 0
        slope = high * (1 - high)
        i = np.arange(n)
        chance = np.maximum(high[i, grades] - high[i, grades + 1], 1e-12)
        d_low, d_up = slope[i, grades] / chance, slope[i, grades + 1] / chance
        g_x = -(d_low - d_up) / n
        g_t = np.array([(np.where(grades == j + 1, d_low, 0) - np.where(grades == j, d_up, 0)).sum() for j in range(k)]) / n
        tail = np.cumsum(g_t[::-1])[::-1]
        g = np.concatenate([np.bincount(feature, g_x[row] * value, n_features) + ridge * w, tail[:1], tail[1:] * np.exp(p[n_features + 1:])])
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        p = p - rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return p[:n_features], np.cumsum(np.concatenate([p[n_features:n_features + 1], np.exp(p[n_features + 1:])]))


def graded(labels: DataFrame, key: str = "doc_id", grade: str = "toxic", rows: int = SAMPLE_ROWS) -> DataFrame:
    """A bounded sample of labels, about ``rows``: one row per document, by the hash of its key."""
    one = labels.where(F.col(key).isNotNull() & F.col(grade).isNotNull()).groupBy(key).agg(F.max(grade).cast("int").alias("grade"))
    return arrow.sampled(one, key, rows)


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", grade: str = "toxic",
        rows: int = SAMPLE_ROWS, split_top: bool = True) -> Ordinal:
    """Fit to a sample of at most ``rows`` labelled documents.

    ``split_top``: labels that only tell toxic from clean get a third grade. Labelled texts in which
    features typical of toxic ones weigh more than in the median one are graded 2 instead of 1.
    """
    spark = docs.sparkSession
    arrow.prepare(spark)
    picked = F.broadcast(graded(labels, key, grade, rows))  # about ``rows`` rows of two numbers
    joined = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text")).join(picked.withColumnRenamed(key, "key"), "key").select("grade", "text")

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found, row, each = _features(b["text"])
            at, feature, count = _counts(found, row, None)
            cuts = np.searchsorted(at, np.arange(len(each) + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([
                b["grade"], pa.ListArray.from_arrays(cuts, pa.array(feature.view(np.int64))),
                pa.ListArray.from_arrays(cuts, pa.array(count.astype(np.int32))), *_likeness(found[0], row, len(each))],
                ["grade", "feature", "count", "like_a", "like_b"])

    # copies would make every word of one text look typical: near copies mostly agree in one of two least hashes.
    # Which one stays follows from the rows alone, so a fit gives the same weights again
    spread_rows = joined.mapInArrow(spread, "grade int, feature array<long>, count array<int>, like_a long, like_b long")
    columns, place = ("grade", "feature", "count", "like_a", "like_b"), F.xxhash64("grade", "feature", "count", "like_a", "like_b")
    for like in ("like_a", "like_b"):
        spread_rows = spread_rows.groupBy(F.col(like).alias("like")).agg(F.min_by(F.struct(*columns), place).alias("row")).select("row.*")
    sample = settle(spread_rows.select("grade", "feature", "count"), "toxicity-sample")
    total, high = sample.agg(F.count("*"), F.sum((F.col("grade") > 0).cast("long"))).first()
    if not total or not high or high == total:
        return Ordinal(np.zeros(0, np.uint64), np.zeros(0), np.zeros(0))
    per = sample.select(F.explode("feature").alias("f"), (F.col("grade") > 0).cast("long").alias("y")).groupBy("f").agg(F.count("*").alias("d"), F.sum("y").alias("p"))
    d, p = F.col("d").cast("double"), F.col("p").cast("double")
    chi = F.pow(p * float(total) - d * float(high), 2.0) * float(total) / (d * (F.lit(float(total)) - d) * float(high * (total - high)) + 1.0)
    top = per.where((d >= LEAST_DOCUMENTS) & (chi >= LEAST_CHI_SQUARE)).orderBy(chi.desc(), "f").limit(VOCABULARY).select("f", "d", "p").collect()
    order = sorted(top, key=lambda r: np.int64(r.f).view(np.uint64))
    vocabulary = np.array([r.f for r in order], np.int64).view(np.uint64)
    typical = np.array([r.p * total > r.d * high for r in order], bool)


    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary.view(np.int64)
        by_value = np.argsort(known)
        for b in batches:
            lists, counts = b["feature"], b["count"].flatten().to_numpy()
            flat = lists.flatten().to_numpy()
            of = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
            place = np.minimum(np.searchsorted(known[by_value], flat), len(known) - 1)
            hit = known[by_value][place] == flat
            cuts = np.searchsorted(of[hit], np.arange(len(lists) + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([
                b["grade"], pa.ListArray.from_arrays(cuts, pa.array(by_value[place[hit]].astype(np.int32))),
                pa.ListArray.from_arrays(cuts, pa.array(counts[hit].astype(np.int32)))], ["grade", "at", "count"])

    if not len(vocabulary):
        return Ordinal(np.zeros(0, np.uint64), np.zeros(0), np.zeros(0))
    # at most ``rows`` rows of at most VOCABULARY entries
    kept = sample.select("grade", "feature", "count").mapInArrow(pick, "grade int, at array<int>, count array<int>").collect()
    grades = np.array([r.grade for r in kept])
    row = np.repeat(np.arange(len(kept)), [len(r.at) for r in kept])
    feature = np.array([x for r in kept for x in r.at], np.int64)
    count = np.array([x for r in kept for x in r["count"]], float)
    if split_top and grades.max() == 1:
        share = np.bincount(row, typical[feature] * _value(count), len(kept))
        toxic = grades == 1
        if len(np.unique(share[toxic])) > 1:
            grades = grades + (toxic & (share > np.median(share[toxic])))
    seen, grades = np.unique(grades, return_inverse=True)
    w, t = fit_ordinal(row, feature, _value(count), grades, len(vocabulary))
    return Ordinal(vocabulary, w, t)


def _scores(model: Ordinal, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    found, row, each = _features(column)
    at, feature, count = _counts(found, row, model.features)
    x = np.bincount(at, model.weights[feature.astype(np.int64)] * _value(count), len(each)) if len(at) else np.zeros(len(each))
    return model.severity(x)


def score(docs: DataFrame, model: Ordinal, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Add ``expected_severity``, ``grade`` and ``toxic`` to every row, with the columns to ``keep`` (default all); no shuffle."""
    arrow.prepare(docs.sparkSession)
    made = ("expected_severity", "grade", "toxic")
    kept = [c for c in (docs.columns if keep is None else keep) if c not in made]
    own = docs.select(kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            severity, grade = _scores(model, b.column(len(kept)))
            yield pa.RecordBatch.from_arrays([*map(b.column, range(len(kept))), pa.array(severity), pa.array(grade), pa.array(severity >= LIMIT)], [*kept, *made])

    schema = T.StructType([*own.schema, T.StructField(made[0], T.DoubleType()), T.StructField(made[1], T.IntegerType()), T.StructField(made[2], T.BooleanType())])
    return docs.select(*kept, F.col(text).cast("string").alias("_text_to_score")).mapInArrow(run, schema)


def keep_clean(docs: DataFrame, model: Ordinal, text: str = "text") -> DataFrame:
    """The rows of ``docs`` below the severity limit, with their columns as they are; no shuffle."""
    arrow.prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array(_scores(model, b[text])[0] < LIMIT))

    return docs.mapInArrow(run, docs.schema)
