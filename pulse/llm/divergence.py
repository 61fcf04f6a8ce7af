"""How far the sources of a language are from each other, and which terms set each of them apart.

Occurrences of terms are counted per source where the texts are, and summed by (language, source, term). Terms of
enough documents stay. Each source then holds them as arrays of (term number, count), sorted by number and
cut into segments, so that no array grows with the corpus. A task co-groups two handfuls of sources of one
segment and prices every unordered pair of them by one merge: the terms that both have are found by galloping
through the longer array, and those of one side or of neither follow from the counts of the sides, in both directions.
All arithmetic is in whole numbers.

Defined results: null text, language and source are ''. Repeated rows count as documents of their own. A source
without terms has pairs like any other; a language without terms has pairs of value 0. Equal values rank by
the item's bytes. Counts may sum to 9e15 in a language, beyond which the shares no longer fit 64 bits; pair sums hold while
a language has fewer than 2e9 terms. Very long texts are read in pieces of some :data:`PIECE` bytes, cut between terms. The number of pairs grows with the square of a language's sources: they are
the result. Further columns of the input are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..settle import settle
from .arrow import prepare
from .vectors import flat

#: Documents of a language that a term must be in, and how many terms of a source are ranked.
LEAST_DOCUMENTS, TERMS = 3, 200
#: Terms of a segment, sources of a handful, entries a task counts before it hands them on, bytes of a text read at once.
SEGMENT, HANDFUL, HELD, PIECE = 1 << 16, 8, 400_000, 1 << 20
#: Parts that a share is told in.
UNIT = 1_000_000_000

# After lower-casing, terms are runs of ASCII letters and of bytes of other characters.
_TERM = re.compile(rb"[a-z\x80-\xff]+")
_OUTSIDE = re.compile(rb"[^a-z\x80-\xff]")

_COUNTED = "lang string, source string, term string, n long, docs long"
_PRICED = "lang string, source string, item string, value long"


def _pieces(text: bytes) -> Iterator[bytes]:
    at = 0
    while len(text) - at > PIECE:
        cut = _OUTSIDE.search(text, at + PIECE)
        if not cut:
            break
        yield text[at:cut.start()]
        at = cut.start()
    yield text[at:] if at else text


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences and documents per (language, source, term), some entries more than once; a source's own row has the term ''."""
    groups: dict[tuple, tuple[Counter, Counter]] = {}
    held = 0

    def drain() -> Iterator[pa.RecordBatch]:
        for (lang, source), (counts, documents) in groups.items():
            terms = [b"", *counts]
            yield pa.RecordBatch.from_pydict({
                "lang": pa.array([lang] * len(terms), pa.string()), "source": pa.array([source] * len(terms), pa.string()),
                "term": pa.array(terms, pa.binary()).cast(pa.string()),
                "n": pa.array([0, *counts.values()], pa.int64()), "docs": pa.array([0, *(documents[t] for t in counts)], pa.int64()),
            })
        groups.clear()

    for batch in batches:
        langs, sources = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for lang, source, text in zip(langs, sources, flat(batch.column(2)).cast(pa.binary()).to_pylist()):
            if (lang, source) not in groups:
                groups[lang, source] = Counter(), Counter()
                held += 1
            counts, documents = groups[lang, source]
            held -= len(counts)
            seen: set[bytes] = set()
            for piece in _pieces(text.lower()):
                terms = _TERM.findall(piece)
                counts.update(terms)
                seen.update(terms)
            documents.update(seen)
            held += len(counts)
            if held > HELD:
                yield from drain()
                held = 0
    yield from drain()


def counted(df: DataFrame, text_col: str, lang_col: str, source_col: str) -> DataFrame:
    """Occurrences ``n`` and documents ``docs`` per ``lang``, ``source``, ``term``; every source has a row of the term ''."""
    prepare(df.sparkSession)
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (lang_col, source_col, text_col)]
    found = df.select(*[p.alias(n) for p, n in zip(parts, ("lang", "source", "text"))]).mapInArrow(_counted, _COUNTED)
    return found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(n: np.ndarray | int, total: int, terms: int) -> np.ndarray:
    """1 + floor(UNIT * (n + 1) / (total + terms)), by three digits of the quotient at a time."""
    rest, quotient = np.asarray(n, np.int64) + 1, 0
    for _ in range(3):
        rest = rest * 1000
        quotient = quotient * 1000 + rest // (total + terms)
        rest = rest % (total + terms)
    return quotient + 1


def distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """floor((p - q)^2 / q)."""
    return (p - q) * (p - q) // q


def common(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in two ascending arrays of the numbers that both hold.

    The shorter one is walked in steps of some numbers; for each step the other is galloped through, in strides that
    double until they pass the step's last number, and only that stretch is searched. The cost follows
    the shorter array and the logarithm of the gaps.
    """
    if len(a) > len(b):
        return common(b, a)[::-1]
    at_a, at_b, low = [], [], 0
    step = 256
    for begin in range(0, len(a), step):
        wanted = a[begin:begin + step]
        stride, high = step, low
        while high < len(b) and b[high] <= wanted[-1]:
            high, stride = high + stride, 2 * stride
        stretch = b[low:high]
        if len(stretch):
            place = np.searchsorted(stretch, wanted)
            there = np.flatnonzero(stretch[np.minimum(place, len(stretch) - 1)] == wanted)
            at_a.append(begin + there)
            at_b.append(low + place[there])
            low += int(place[-1])
        if low >= len(b):
            break
    empty = np.zeros(0, np.int64)
    return np.concatenate([empty, *at_a]), np.concatenate([empty, *at_b])


class _Side:
    """One source's terms of a segment."""

    def __init__(self, source: str, total: int, terms: int, numbers: np.ndarray, counts: np.ndarray):
        self.source, self.numbers = source, numbers
        self.p = share(counts, total, terms)
        self.absent = share(0, total, terms)
        #: Few different counts, however many terms: what one side has alone is priced by these.
        self.prices, self.times = np.unique(self.p, return_counts=True)


def priced(a: _Side, b: _Side, kept: int) -> tuple[int, int]:
    """Value of ``a`` against ``b`` and of ``b`` against ``a``, over a segment of ``kept`` terms."""
    at_a, at_b = common(a.numbers, b.numbers)
    p, q = a.p[at_a], b.p[at_b]
    neither = kept - len(a.numbers) - len(b.numbers) + len(at_a)

    def value(a, p, b, q):
        only_a = (distance(a.prices, b.absent) * a.times).sum() - distance(p, b.absent).sum()
        only_b = (distance(a.absent, b.prices) * b.times).sum() - distance(a.absent, q).sum()
        return int(distance(p, q).sum() + only_a + only_b + neither * distance(a.absent, b.absent))

    return value(a, p, b, q), value(b, q, a, p)


def _sides(table: pa.Table) -> list[_Side]:
    out = []
    for r in range(table.num_rows):
        row = {n: table.column(n)[r] for n in ("source", "total", "terms", "entries")}
        entries = row["entries"].values
        number, count = (np.asarray(entries.field(n)) for n in ("id", "n"))
        out.append(_Side(row["source"].as_py(), row["total"].as_py(), row["terms"].as_py(), number, count))
    return out


def _pairs(left: pa.Table, right: pa.Table) -> pa.Table:
    """Values of every unordered pair of sources, both ways, from two handfuls or from one with itself."""
    here, there = _sides(left), _sides(right)
    out = []
    within = here and there and left.column("i")[0].as_py() == left.column("j")[0].as_py()
    for a in here:
        for b in there:
            if within and a.source >= b.source:
                continue
            one, other = priced(a, b, left.column("kept")[0].as_py())
            out += [(a.source, b.source, one), (b.source, a.source, other)]
    lang = left.column("lang")[0].as_py() if out else None
    return pa.table({
        "lang": pa.array([lang] * len(out), pa.string()), "source": pa.array([x[0] for x in out], pa.string()),
        "item": pa.array([x[1] for x in out], pa.string()), "value": pa.array([x[2] for x in out], pa.int64()),
    })


def _share(n: str, total: str, terms: str) -> Column:
    """:func:`share` as a column."""
    whole = f"({total} + {terms})"
    first = f"(({n} + 1) * 1000)"
    second = f"(({first} % {whole}) * 1000)"
    third = f"(({second} % {whole}) * 1000)"
    return F.expr(f"1 + ({first} div {whole}) * 1000000 + ({second} div {whole}) * 1000 + ({third} div {whole})")


def audit(df: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """Columns ``lang``, ``source``, ``part``, ``item``, ``value``, ``rank``.

    Part ``pair`` has for each source every other source of its language, with the sum over the language's terms of
    :func:`distance` between their shares; part ``term`` has the :data:`TERMS` terms in which a source exceeds its
    language most.
    """
    numbered = counted(df, text_col, lang_col, source_col).withColumn("number", F.monotonically_increasing_id())
    counts = settle(numbered, "term-counts")
    everywhere = W.partitionBy("lang", "term")
    summed = counts.where("term <> ''").select(
        "lang", "source", "term", "n", "number",
        F.sum("docs").over(everywhere).alias("docs"), F.sum("n").over(everywhere).alias("lang_n"), F.min("number").over(everywhere).alias("id"),
    )
    entries = settle(summed.where(F.col("docs") >= LEAST_DOCUMENTS).drop("docs"), "term-entries")
    langs = entries.groupBy("lang").agg(
        F.sum("n").alias("lang_total"), F.sum((F.col("id") == F.col("number")).cast("long")).alias("terms"))
    totals = entries.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    sources = counts.where("term = ''").select("lang", "source").join(totals, ["lang", "source"], "left").join(langs, "lang", "left")
    filled = [F.coalesce(c, F.lit(0)).alias(c) for c in ("total", "terms", "lang_total")]
    handfuls = F.ceil(F.count("*").over(W.partitionBy("lang")) / HANDFUL).cast("int")
    segments = F.greatest(F.lit(1), F.ceil(F.coalesce("terms", F.lit(0)) / SEGMENT)).cast("int")
    sources = settle(sources.select("lang", "source", *filled, handfuls.alias("handfuls"), segments.alias("segments")), "sources")
    return _all_pairs(entries, sources).unionByName(_own_terms(entries, sources))


def _all_pairs(entries: DataFrame, sources: DataFrame) -> DataFrame:
    of_lang = sources.groupBy("lang").agg(F.max("segments").alias("segments"))
    cut = F.pmod(F.xxhash64("id"), "segments").cast("int").alias("segment")
    placed = entries.join(of_lang, "lang").select("lang", "source", "id", "n", "number", cut)
    kept = placed.where("id = number").groupBy("lang", "segment").agg(F.count("*").alias("kept"))
    arrays = placed.groupBy("lang", "source", "segment").agg(F.sort_array(F.collect_list(F.struct("id", "n"))).alias("entries"))
    every = sources.select("*", F.explode(F.sequence(F.lit(0), F.col("segments") - 1)).alias("segment"))
    hand = F.pmod(F.xxhash64("source"), "handfuls").cast("int")
    held = settle(every.join(arrays, ["lang", "source", "segment"], "left").join(kept, ["lang", "segment"], "left").select(
        "lang", "source", "segment", "total", "terms", hand.alias("hand"), "handfuls", F.coalesce("kept", F.lit(0)).alias("kept"),
        F.coalesce("entries", F.array().cast("array<struct<id:bigint,n:bigint>>")).alias("entries"),
    ).where("terms > 0"), "term-arrays")
    columns = ["lang", "segment", "source", "total", "terms", "kept", "entries"]
    key = ["lang", "segment", "i", "j"]
    left = held.select(*columns, F.col("hand").alias("i"), F.explode(F.sequence(F.col("hand"), F.col("handfuls") - 1)).alias("j"))
    # both sides come from one table: the right one's columns need an identity of their own
    right = held.select(*[F.col(c).alias(c) for c in columns], F.explode(F.sequence(F.lit(0), F.col("hand"))).alias("i"), F.col("hand").alias("j"))
    found = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(_pairs, _PRICED)
    # a language without terms has nothing to price, only pairs
    bare = sources.where("terms = 0")
    none = bare.alias("a").join(bare.alias("b"), F.expr("a.lang = b.lang AND a.source <> b.source")).selectExpr(
        "a.lang AS lang", "a.source AS source", "b.source AS item", "0L AS value")
    values = found.unionByName(none).groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    return _ranked(values, "pair")


def _own_terms(entries: DataFrame, sources: DataFrame) -> DataFrame:
    both = entries.join(sources, ["lang", "source"]).select(
        "lang", "source", F.col("term").alias("item"), _share("n", "total", "terms").alias("p"), _share("lang_n", "lang_total", "terms").alias("q"))
    values = both.where("p > q").select("lang", "source", "item", F.expr("((p - q) * (p - q)) div q").alias("value"))
    return _ranked(values, "term").where(F.col("rank") <= TERMS)


def _ranked(values: DataFrame, part: str) -> DataFrame:
    order = W.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return values.select("lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(order).alias("rank"))
