"""Quality of documents by weak supervision: rules vote, and how far each is trusted is estimated.

Every rule votes good, bad or abstains. Expectation maximisation over the observed patterns of votes
estimates, without labels, the share of good documents and how often each rule votes each way on good
and on bad ones. A document is kept by its posterior probability of being good, not by passing every
rule. Documents that fail the base limits are judged by those alone and left out of the estimate.
Patterns of votes are counted in one job; there are at most 3^8, whatever the number of documents, and
the steps of the estimation run over these counts. The posterior is a column expression. DataFrame functions only.

Three kinds of evidence have two rules each (word length, symbols, repeats), although the estimate takes rules to
be independent given quality. They are kept apart on purpose: faults hardly ever meet in one document, so where each kind has
one rule no two votes agree on anything, one group of documents explains the counts as well as two, and the estimate keeps all.

Edge cases: a null text has no words; documents without words get no vote from the rules that
divide by words or characters. All rules abstaining leaves the share of good documents as the
posterior, weighed by how often each rule abstains on either kind. A posterior of exactly ``LIMIT`` keeps
the document. Repeated rows count as often as they occur. Texts are never cut, however long. An empty
table gives no rows. Columns besides id and text are never read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.binding import let, once
from ..settle import settle

#: Words of a window for repeats, least words, largest share of repeated words in percent.
WINDOW, LEAST_WORDS, MOST_REPEATED = 8, 20, 30
#: Documents with this posterior probability or more are kept.
LIMIT = 0.5
#: Steps of the estimation at most, the change at which it ends, and what each count starts from.
STEPS, CLOSE, PRIOR_COUNT = 30, 1e-5, 1.0

_SPACE = "[\\x20\\x09-\\x0D]+"

#: Rules: a measure, and where it votes bad and good (below or above; between the two it abstains).
#: (measure, bad if below, good if above) or (measure, good if below, bad if above)
RULES: list[tuple[str, str, float, float]] = [
    ("word_length", "rising", 2.5, 3.0),
    ("word_length", "falling", 9.0, 12.0),
    ("symbol_share", "falling", 0.01, 0.05),
    ("symbol_runs", "falling", 0.02, 0.15),
    ("repeated_line_share", "falling", 0.1, 0.3),
    ("repeated_word_share", "falling", 0.1, 0.3),
    ("capital_share", "falling", 0.1, 0.3),
    ("exclamations", "falling", 0.05, 0.3),
]


def _repeat_words(words: Column) -> Column:
    """Words that lie in a window found twice or more in the same array."""
    def wider(h: Column, by: int) -> Column:
        return F.transform(h, lambda x, i: F.xxhash64(x, F.get(h, i + by)))

    def covered(h: Column) -> Column:
        ordered = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("p"))))

        def twice(s: Column) -> Column:
            return F.transform(F.filter(s, lambda x, i: (F.get(s, i - 1)["h"] == x["h"]) | (F.get(s, i + 1)["h"] == x["h"])), lambda x: x["p"])

        start = F.struct(F.lit(-WINDOW).alias("p"), F.lit(0).cast("long").alias("n"))
        return let(ordered, lambda s: F.aggregate(
            F.sort_array(twice(s)), start, lambda a, p: F.struct(p.alias("p"), (a["n"] + F.least(F.lit(WINDOW), p - a["p"])).alias("n")), lambda a: a["n"]))

    def count(h: Column) -> Column:
        return F.when(F.size(F.array_distinct(h)) < F.size(h), covered(h)).otherwise(F.lit(0).cast("long"))

    hashed = let(F.transform(words, lambda x: F.xxhash64(x)), lambda a: let(wider(a, 1), lambda b: let(wider(b, 2), lambda c: let(
        F.slice(wider(c, 4), 1, F.size(words) - (WINDOW - 1)), count))))
    return F.when(F.size(words) > WINDOW, hashed).otherwise(F.lit(0).cast("long"))


def measured(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, the base counts and the measures the rules look at."""
    value = F.coalesce(F.col(text).cast("string"), F.lit(""))

    def counts(t: Column) -> Column:
        lines = F.filter(F.split(t, "\n", -1), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
        words = F.array_remove(F.split(t, _SPACE, -1), "")
        of_words = let(words, lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"), F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            _repeat_words(w).alias("n_repeat_words")))
        of_lines = let(lines, lambda x: F.struct(F.size(x).cast("long").alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines")))
        return F.struct(of_words.alias("w"), of_lines.alias("l"), F.regexp_count(t, F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
                        F.regexp_count(t, F.lit("[#*$%&|<>]+")).alias("n_runs"), F.length(F.regexp_replace(t, "[^A-Z]+", "")).alias("n_capitals"),
                        F.length(F.regexp_replace(t, "[^!]+", "")).alias("n_exclamations"))

    made = once(docs.select(F.col(key).cast("long").alias("doc_id"), value.alias("t")), c=let(F.col("t"), counts))
    made = made.select("doc_id", "c.w.*", "c.l.*", "c.n_symbols", "c.n_runs", "c.n_capitals", "c.n_exclamations")
    of = lambda a, b: F.try_divide(F.col(a), F.col(b))
    return made.withColumns({
        "word_length": of("word_chars", "n_words"), "symbol_share": of("n_symbols", "word_chars"), "capital_share": of("n_capitals", "word_chars"),
        "repeated_line_share": of("n_dup_lines", "n_lines"), "repeated_word_share": of("n_repeat_words", "n_words"),
        "symbol_runs": of("n_runs", "n_words"), "exclamations": of("n_exclamations", "n_words")})


def vote(rule: tuple[str, str, float, float]) -> Column:
    """1: good, -1: bad, 0: abstains (as it does where there is nothing to measure)."""
    name, way, low, high = rule
    below, above = (-1, 1) if way == "rising" else (1, -1)
    return F.when(F.col(name) < low, below).when(F.col(name) > high, above).otherwise(0)


def _posterior(names: list[str], odds: float, ratios: list[dict[int, float]]) -> Column:
    """Probability of good, from the log odds of good and each rule's log ratio for its vote."""
    total = F.lit(odds)
    for name, ratio in zip(names, ratios):
        total = total + F.when(F.col(name) == 1, ratio[1]).when(F.col(name) == -1, ratio[-1]).otherwise(ratio[0])
    return 1 / (1 + F.exp(-F.greatest(F.lit(-700.0), F.least(F.lit(700.0), total))))


def fit(counts: dict[tuple[int, ...], int], clamp: bool = True) -> tuple[float, list[dict[int, float]]]:
    """Log odds of good and, for each rule, the log ratio of each vote, from the number of documents per pattern of votes.

    ``clamp`` keeps a vote from speaking against itself: a good vote that is commoner on bad documents, or a bad one on
    good documents, weighs nothing.
    """
    total, rules = sum(counts.values()), range(len(next(iter(counts))))
    each = [{v: sum(n for p, n in counts.items() if p[j] == v) for v in (-1, 0, 1)} for j in rules]
    # it starts from the belief that a bad vote is mostly right
    good, share = {p: 0.1 if min(p) < 0 else 0.9 for p in counts}, None
    for _ in range(STEPS):
        weight = {p: n * good[p] for p, n in counts.items()}
        on_good = math.fsum(weight.values())
        before, share = share, (on_good + PRIOR_COUNT) / (total + 2 * PRIOR_COUNT)
        ratios = []
        for j in rules:
            seen = {v: math.fsum(w for p, w in weight.items() if p[j] == v) for v in (-1, 0, 1)}
            ratio = {v: math.log((seen[v] + PRIOR_COUNT) / (on_good + 3 * PRIOR_COUNT)
                                 / ((each[j][v] - seen[v] + PRIOR_COUNT) / (total - on_good + 3 * PRIOR_COUNT))) for v in (-1, 0, 1)}
            if clamp:
                ratio[1], ratio[-1] = max(ratio[1], 0.0), min(ratio[-1], 0.0)
            ratios.append(ratio)
        odds = math.log(share / (1 - share))
        at = {p: odds + sum(r[v] for r, v in zip(ratios, p)) for p in counts}
        good = {p: 1 / (1 + math.exp(-max(-700.0, min(700.0, x)))) for p, x in at.items()}
        if before is not None and abs(share - before) < CLOSE:
            break
    return odds, ratios


def estimate(patterns: DataFrame, names: list[str]) -> Column | None:
    """The posterior as a column expression over the votes; None for no patterns. ``patterns``: votes and ``n``, a row per pattern."""
    counts = {tuple(r[c] for c in names): r["n"] for r in patterns.collect()}  # at most 3 to the power of the rules
    return _posterior(names, *fit(counts)) if counts else None


def judged(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: ``doc_id``, the base counts, ``base_failed``, ``kept``, ``quality`` (posterior) and the votes."""
    names = [f"vote_{i}" for i in range(len(RULES))]
    rows = measured(docs, key, text)
    rows = settle(rows.withColumns({n: vote(r) for n, r in zip(names, RULES)}), "quality-votes")
    failed = (F.col("n_words") < LEAST_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MOST_REPEATED)
    good = estimate(rows.where(~failed).groupBy(*names).agg(F.count("*").alias("n")), names)
    good = F.lit(None).cast("double") if good is None else good
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"),
                       (~failed & F.coalesce(good >= LIMIT, F.lit(False))).alias("kept"), good.alias("quality"), *names)
