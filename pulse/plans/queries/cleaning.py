"""Text normalisation."""

from __future__ import annotations

from pyspark.sql import functions as F

from ...functions import text as T
from ...functions.wordlists import ENDINGS, IS_HOSTS, SEED_LEMMAS, SLANG, STOPWORDS, WHOLE_WORDS
from ...operators.datasets import length_filter
from ...operators.lexicon import apply_lexicon, drop_listed
from .base import TEXTS_SQL, documents, query, quoted, table, texts, words_sql


def _keep(name: str) -> str:
    return {"serving": "", "batch": '.;:!?"-', "training": ".,;:!?''\"-", "emotion": ".,;:!?''\"-"}[name]


def clean_sql(text: str, name: str) -> str:
    junk = f"[^a-zA-Z0-9{_keep(name)}]"
    if name in ("serving", "batch"):
        out = f"regexp_replace({text}, 'http\\S+|{junk}', ' ', 'g')"
    else:
        out = f"regexp_replace(regexp_replace({text}, 'http\\S+', '', 'g'), '{junk}', ' ', 'g')"
    if name == "emotion":
        return (
            f"array_to_string(list_filter({words_sql(f'lower({out})')}, "
            f"lambda w: w NOT IN ({quoted(STOPWORDS)})), ' ')"
        )
    return f"regexp_replace(lower({out}), ' +', ' ', 'g')"


def _register(name: str) -> None:
    @query(f"clean_{name}", f"WITH {TEXTS_SQL} SELECT id, {clean_sql('text', name)} AS clean_text FROM texts")
    def run(spark, sf):
        out = T.clean(F.col("text"), name, STOPWORDS)
        return texts(spark, sf).select("id", out.alias("clean_text"))


for _name in T.PROFILES:
    _register(_name)

_TOKEN = "[a-z0-9]+|[.,;:!?''\"-]"


def tokens_sql(cleaned: str) -> str:
    return f"regexp_extract_all({cleaned}, '{_TOKEN}')"


@query(
    "tokenize",
    f"""WITH {TEXTS_SQL} SELECT id, array_to_string({tokens_sql(clean_sql('text', 'training'))}, ' ') AS tokens
    FROM texts""",
)
def tokenize(spark, sf):
    out = T.tokens(T.clean(F.col("text"), "training"))
    return texts(spark, sf).select("id", F.array_join(out, " ").alias("tokens"))


@query("token_count", f"WITH {TEXTS_SQL} SELECT id, CAST(len({words_sql('text')}) AS INTEGER) AS n FROM texts")
def token_count(spark, sf):
    return texts(spark, sf).select("id", T.token_count(F.col("text")).alias("n"))


@query(
    "length_filter",
    f"""WITH {TEXTS_SQL}, sized AS (SELECT id, CAST(len({words_sql('text')}) AS INTEGER) AS text_len FROM texts)
    SELECT id, text_len FROM sized WHERE text_len BETWEEN 2 AND 1000""",
)
def lengths(spark, sf):
    return length_filter(texts(spark, sf)).select("id", "text_len")


@query(
    "drop_stopwords",
    f"""WITH {TEXTS_SQL} SELECT id, array_to_string(list_filter({words_sql('lower(text)')},
    lambda w: w NOT IN ({quoted(STOPWORDS)})), ' ') AS kept FROM texts""",
)
def drop_stopwords(spark, sf):
    out = T.drop_stopwords(F.lower("text"), STOPWORDS)
    return texts(spark, sf).select("id", out.alias("kept"))


# Documents hold no apostrophes: some are written into them, straight and curly.
APOSTROPHES_SQL = """replace(replace(replace(text, 'nt ', 'n''t '), 're ', '’re '), ' it ', ' it''s ')"""


def _with_apostrophes(col):
    out = F.replace(F.replace(col, F.lit("nt "), F.lit("n't ")), F.lit("re "), F.lit("’re "))
    return F.replace(out, F.lit(" it "), F.lit(" it's "))


def expand_sql(text: str) -> str:
    edge = r"[^\p{L}\p{N}_]"
    out = f"replace({text}, '’', '''')"
    for word, full in WHOLE_WORDS.items():
        word = word.replace("'", "''")
        # the edges are consumed, so neighbouring matches take a second round
        for _ in range(2):
            out = rf"regexp_replace({out}, '(^|{edge})(?i:{word})({edge}|$)', '\1{full}\2', 'g')"
    for ending, full in ENDINGS.items():
        ending = ending.replace("'", "''")
        out = rf"regexp_replace({out}, '([a-zA-Z])(?i:{ending})({edge}|$)', '\1{full}\2', 'g')"
    for _ in range(2):
        out = rf"regexp_replace({out}, '(^|{edge})(?i:({'|'.join(IS_HOSTS)})''s)({edge}|$)', '\1\2 is\3', 'g')"
    return out


@query(
    "expand_contractions",
    f"SELECT doc_id, {expand_sql(APOSTROPHES_SQL)} AS expanded FROM documents",
)
def expand(spark, sf):
    out = T.expand_contractions(_with_apostrophes(F.col("text")))
    return documents(spark, sf).select("doc_id", out.alias("expanded"))


def lemma_sql(token: str, slang: bool) -> str:
    listed = {**SEED_LEMMAS, **SLANG} if slang else SEED_LEMMAS
    pairs = ", ".join(f"'{k}': '{v}'" for k, v in listed.items())
    return f"coalesce(MAP {{{pairs}}}[{token}], {token})"


def normalize_sql(text: str, name: str, lemmas: bool = True) -> str:
    serving = name in ("serving", "batch")
    cleaned = clean_sql(expand_sql(text) if serving else text, name)
    if not lemmas:
        slang = "CASE t " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in SLANG.items()) + " ELSE t END" if serving else "t"
        return f"array_to_string(list_transform({tokens_sql(cleaned)}, lambda t: {slang}), ' ')"
    return f"array_to_string(list_transform({tokens_sql(cleaned)}, lambda t: {lemma_sql('t', serving)}), ' ')"


@query(
    "normalize_batch",
    f"SELECT doc_id, {normalize_sql(APOSTROPHES_SQL, 'batch')} AS clean_text FROM documents",
)
def normalize_batch(spark, sf):
    out = T.normalize(_with_apostrophes(F.col("text")), "batch", SEED_LEMMAS)
    return documents(spark, sf).select("doc_id", out.alias("clean_text"))


# A dictionary table read off the conversations: words in -s lose the s, words in -nd split.
LEXICON_SQL = r"""lexicon AS (
    SELECT DISTINCT token, CASE WHEN token LIKE '%s' THEN regexp_replace(token, 's$', '')
        ELSE regexp_replace(token, 'nd$', ' nd') END AS replacement
    FROM (SELECT unnest(regexp_extract_all(lower(text), '[a-z0-9]+')) AS token FROM conversations)
    WHERE length(token) > 3 AND (token LIKE '%s' OR token LIKE '%nd'))"""


def lexicon(spark, sf):
    found = F.regexp_extract_all(F.lower("text"), F.lit("[a-z0-9]+"), F.lit(0))
    words = table(spark, sf, "conversations").select(F.explode(found).alias("token")).distinct()
    plural = F.col("token").endswith("s")
    words = words.where((F.length("token") > 3) & (plural | F.col("token").endswith("nd")))
    replaced = F.when(plural, F.regexp_replace("token", "s$", "")).otherwise(
        F.regexp_replace("token", "nd$", " nd")
    )
    return words.withColumn("replacement", replaced)


@query(
    "lexicon_normalize",
    f"""WITH {LEXICON_SQL},
    words AS (SELECT doc_id, {tokens_sql(clean_sql('text', 'training'))} AS w FROM documents),
    spread AS (SELECT doc_id, unnest(w) AS token, generate_subscripts(w, 1) AS pos FROM words),
    mapped AS (SELECT doc_id, string_agg(coalesce(replacement, token), ' ' ORDER BY pos) AS clean_text
        FROM spread LEFT JOIN lexicon USING (token) GROUP BY doc_id)
    SELECT doc_id, coalesce(clean_text, '') AS clean_text FROM documents LEFT JOIN mapped USING (doc_id)""",
)
def lexicon_normalize(spark, sf):
    words = T.tokens(T.clean(F.col("text"), "training")).alias("w")
    rows = documents(spark, sf).select("doc_id", words)
    out = apply_lexicon(rows, "doc_id", "w", lexicon(spark, sf))
    return out.select("doc_id", F.array_join("w", " ").alias("clean_text"))


@query(
    "drop_listed",
    f"""WITH listed AS (
        SELECT DISTINCT unnest({words_sql('lower(text)')}) AS word FROM benchmark),
    words AS (SELECT doc_id, {words_sql('lower(text)')} AS w FROM documents),
    spread AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS pos FROM words),
    kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY pos) AS kept
        FROM spread ANTI JOIN listed USING (word) GROUP BY doc_id)
    SELECT doc_id, coalesce(kept, '') AS kept FROM documents LEFT JOIN kept USING (doc_id)""",
)
def listed_words(spark, sf):
    listed = table(spark, sf, "benchmark").select(F.explode(T.split_words(F.lower("text"))).alias("word"))
    rows = documents(spark, sf).select("doc_id", F.lower("text").alias("kept"))
    return drop_listed(rows, "doc_id", "kept", listed.distinct())
