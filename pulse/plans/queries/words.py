"""Word frequencies and length statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from ...functions.binding import once
from ...functions.text import clean, split_words
from ...functions.wordlists import STOPWORDS
from ...operators.aggregates import length_density, length_hist, top_words, word_counts
from ...operators.lexicon import NOUN_ENDINGS, lemma_counts, noun_lemmas, unlisted_words
from ...settle import settle
from .base import TEXTS_SQL, documents, query, quoted, table, texts, words_sql
from .cleaning import LEXICON_SQL, clean_sql, lexicon


def _cleaned(spark, sf):
    return documents(spark, sf).select("doc_id", clean(F.col("text"), "serving").alias("clean_text"))


_WORDS = f"SELECT unnest({words_sql(clean_sql('text', 'serving'))}) AS word FROM documents"
_COUNTS = f"counts AS (SELECT word, count(*) AS n FROM ({_WORDS}) GROUP BY word)"


@query("word_freq", f"WITH {_COUNTS} SELECT word, n FROM counts")
def word_freq(spark, sf):
    return word_counts(_cleaned(spark, sf))


@query(
    "top_words",
    f"""WITH {_COUNTS} SELECT word, n FROM counts WHERE word NOT IN ({quoted(STOPWORDS)})
    ORDER BY n DESC, word LIMIT 20""",
)
def top(spark, sf):
    return top_words(_cleaned(spark, sf), stopwords=STOPWORDS)


@query(
    "top_words_first_seen",
    f"""WITH w AS (SELECT doc_id, {words_sql(clean_sql('text', 'serving'))} AS w FROM documents),
    spread AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS pos FROM w),
    counts AS (SELECT word, count(*) AS n, min({{'d': doc_id, 'p': pos}}) AS seen FROM spread GROUP BY word)
    SELECT word, n FROM counts ORDER BY n DESC, seen LIMIT 2000""",
)
def top_first_seen(spark, sf):
    # deep enough to reach the words that tie
    return top_words(_cleaned(spark, sf), n=2000, ties="first_seen", order_col="doc_id")


@query(
    "stopword_anti",
    f"""WITH {_COUNTS}, listed AS (SELECT unnest({words_sql(clean_sql('text', 'serving'))}) AS word FROM benchmark)
    SELECT word, n FROM counts WHERE word NOT IN (SELECT word FROM listed)""",
)
def stopword_anti(spark, sf):
    words = split_words(clean(F.col("text"), "serving"))
    listed = table(spark, sf, "benchmark").select(F.explode(words).alias("word")).distinct()
    return unlisted_words(word_counts(_cleaned(spark, sf)), listed)


@query(
    "lemma_freq",
    f"""WITH {_COUNTS}, {LEXICON_SQL}
    SELECT coalesce(replacement, word) AS word, CAST(sum(n) AS BIGINT) AS n
    FROM counts LEFT JOIN lexicon ON word = token GROUP BY 1""",
)
def lemma_freq(spark, sf):
    return lemma_counts(word_counts(_cleaned(spark, sf)), lexicon(spark, sf))


_LENGTHS = f"""{TEXTS_SQL},
    lengths AS (SELECT CAST(len({words_sql('text')}) AS DOUBLE) AS x FROM texts),
    b AS (SELECT min(x) AS lo, max(x) AS hi, CAST(count(*) AS DOUBLE) AS n, stddev_samp(x) AS sd FROM lengths)"""


def _hist_sql(bins: int) -> str:
    return f"""WITH {_LENGTHS},
    binned AS (SELECT least(CAST(floor((x - lo) / ((hi - lo) / {bins}.0::DOUBLE)) AS BIGINT), {bins - 1}) AS bin
        FROM lengths, b)
    SELECT CAST(i AS INTEGER) AS bin, round(lo + i * ((hi - lo) / {bins}.0::DOUBLE), 6) AS bin_lo,
        round(lo + (i + 1) * ((hi - lo) / {bins}.0::DOUBLE), 6) AS bin_hi, count(bin) AS n
    FROM range({bins}) AS r(i) CROSS JOIN b LEFT JOIN binned ON bin = i GROUP BY i, lo, hi"""


def _register(name: str, bins: int) -> None:
    @query(name, _hist_sql(bins))
    def run(spark, sf):
        out = length_hist(texts(spark, sf), "text", bins)
        return out.select("bin", F.round("bin_lo", 6).alias("bin_lo"), F.round("bin_hi", 6).alias("bin_hi"), "n")


_register("length_hist", 30)
_register("length_hist_10", 10)


@query(
    "length_density",
    f"""WITH {_LENGTHS},
    counts AS (SELECT x, count(*) AS c FROM lengths GROUP BY x),
    grid AS (SELECT CAST(i AS INTEGER) AS point, lo + i::DOUBLE * ((hi - lo) / 199::DOUBLE) AS g,
        sd * pow(n, -0.2::DOUBLE) AS h, (hi - lo) / 30::DOUBLE AS w FROM range(200) AS r(i), b)
    SELECT point, round(g, 6) AS x,
        round(sum(c * exp(-0.5::DOUBLE * ((g - counts.x) / h) * ((g - counts.x) / h)))
            / (h * sqrt(2 * pi())) * w, 6) AS density
    FROM grid, counts GROUP BY point, g, h, w""",
)
def density(spark, sf):
    out = length_density(texts(spark, sf), "text")
    return out.select("point", F.round("x", 6).alias("x"), F.round("density", 6).alias("density"))


# Forms that no ending explains.
IRREGULAR = {"children": "child", "people": "person", "feet": "foot", "mice": "mouse"}

STEMS_SQL = ", ".join(
    f"({i}, CASE WHEN ends_with(word, '{end}') AND length(word) > {len(end)} THEN left(word, length(word) - {len(end)}) || '{stem}' END)"
    for i, (end, stem) in enumerate(NOUN_ENDINGS))


@query(
    "lemma_rules",
    f"""WITH w AS (SELECT DISTINCT unnest({words_sql(clean_sql('text', 'training'))}) AS word FROM documents),
    s AS (SELECT word, rank, stem FROM w, LATERAL (VALUES {STEMS_SQL}) AS v(rank, stem) WHERE stem IN (SELECT word FROM w)
        AND word NOT IN ({quoted(IRREGULAR)}))
    SELECT word AS token, arg_min(stem, rank) AS replacement FROM s GROUP BY word
    UNION ALL SELECT word, CASE word {' '.join(f"WHEN '{k}' THEN '{v}'" for k, v in IRREGULAR.items())} END FROM w
    WHERE word IN ({quoted(IRREGULAR)})""",
)
def lemma_rules(spark, sf):
    rows = once(documents(spark, sf).select("text"), clean_text=clean(F.col("text"), "training"))
    words = settle(word_counts(rows).select("word"), "words")
    return noun_lemmas(words, words, IRREGULAR)
