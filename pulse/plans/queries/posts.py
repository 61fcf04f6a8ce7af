"""Posts, their comments, and entities in them."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from ...operators.entities import TYPES, entity_counts, extract, mentions, mentions_in, raw_words
from ...operators.topn import drop_stickied, top_n_per_post, top_posts
from ...functions.wordlists import SEED_LEMMAS
from ...operators.lexicon import NOUN_ENDINGS, own_lemmas
from ...operators.scoring import column_model, python_model
from ..batch_job import CLEANED, cleaned_comments
from ..dashboard import comment_report, dashboard_for
from ...session import discard_at_exit, shared_dir
from ...sources.feed import flatten_posts, join_posts, read_posts
from ...sources.layout import deal_texts, land_comments, land_posts
from .base import dealt, documents, query, quoted, table, words_sql, ORACLES
from .cleaning import normalize_sql
from .words import IRREGULAR, STEMS_SQL
from .scores import _NAME_SQL, WordScorer, class_sql, text_logits, word_logits_sql


@query(
    "top_posts",
    """SELECT event_id AS post_id, value AS score FROM events
    WHERE event_type = 'view' AND ts > TIMESTAMP '2024-01-20' - INTERVAL 7 DAY AND ts <= TIMESTAMP '2024-01-20'
    ORDER BY value DESC, event_id LIMIT 10""",
)
def top(spark, sf):
    posts = table(spark, sf, "events").select(
        F.col("event_id").alias("post_id"), F.col("event_type").alias("community"),
        F.col("ts").alias("created"), F.col("value").alias("score"),
    )
    return top_posts(posts, "view", datetime(2024, 1, 20), "week", 10).select("post_id", "score")


@query(
    "topn_per_post",
    """SELECT user_id, event_id, rn FROM (SELECT user_id, event_id,
        CAST(row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id) AS INTEGER) AS rn FROM events)
    WHERE rn <= 7""",
)
def topn(spark, sf):
    order = [F.desc("value"), F.asc("event_id")]
    rows = table(spark, sf, "events").select("user_id", "event_id", "value")
    return top_n_per_post(rows, 7, order, "user_id").select("user_id", "event_id", "rn")


@query(
    "topn_large",
    """SELECT event_type, event_id, rn FROM (SELECT event_type, event_id,
        CAST(row_number() OVER (PARTITION BY event_type ORDER BY value DESC, event_id) AS INTEGER) AS rn FROM events)
    WHERE rn <= 1500""",
)
def topn_large(spark, sf):
    order = [F.desc("value"), F.asc("event_id")]
    rows = table(spark, sf, "events").select("event_type", "event_id", "value")
    return top_n_per_post(rows, 1500, order, "event_type").select("event_type", "event_id", "rn")


@query(
    "topn_then_filter",
    """SELECT conv_id, turn, text FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS rn
    FROM conversations) WHERE rn <= 3 AND role <> 'system'""",
)
def topn_then_filter(spark, sf):
    rows = table(spark, sf, "conversations").withColumn("stickied", F.col("role") == "system")
    return drop_stickied(top_n_per_post(rows, 3, [F.asc("turn")], "conv_id")).select("conv_id", "turn", "text")


# Documents stand in for nested posts: their lines are the comments, the first one pinned.
_LINES_SQL = """lines AS (SELECT doc_id, source, unnest(string_split(text, chr(10))) AS body,
    generate_subscripts(string_split(text, chr(10)), 1) - 1 AS i FROM documents)"""


@query(
    "flatten_posts",
    f"""WITH {_LINES_SQL}
    SELECT CAST(doc_id AS VARCHAR) AS post_id, source AS post_title,
        strftime(epoch_ms((1704067200 + doc_id) * 1000), '%Y-%m-%d %H:%M:%S') AS post_created, body AS comment_text,
        strftime(epoch_ms((1704067200 + doc_id + i) * 1000), '%Y-%m-%d %H:%M:%S') AS comment_created
    FROM lines WHERE i < 5 AND i > 0""",
)
def flatten(spark, sf):
    return flatten_posts(_nested(documents(spark, sf)), 5).select("post_id", "post_title", "post_created", "comment_text", "comment_created")


def _nested(docs):
    made = F.lit(1704067200) + F.col("doc_id")
    lines = F.transform(F.split("text", "\n", -1), lambda line, i: F.struct(
        i.alias("rank"), line.alias("body"), (made + i).alias("created_utc"), (i == 0).alias("stickied")))
    return docs.select(
        F.col("doc_id").cast("string").alias("post_id"), F.col("source").alias("title"),
        F.col("text").alias("selftext"), made.alias("created_utc"), lines.alias("comments"),
    )


@query(
    "read_feed",
    f"""WITH {_LINES_SQL}, good AS (SELECT * FROM lines WHERE lang IN ('en', 'fr'))
    SELECT CAST(doc_id AS VARCHAR) AS post_id, body AS comment_text, CAST(NULL AS VARCHAR) AS reason FROM good WHERE i > 0
    UNION ALL SELECT CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR), CASE lang WHEN 'de' THEN 'malformed' ELSE 'missing community' END FROM documents WHERE lang NOT IN ('en', 'fr')
    """.replace("source, unnest", "source, lang, unnest"),
)
def read_feed(spark, sf):
    """Nested posts from JSON lines, some of them broken or without their community."""
    posts = _nested(documents(spark, sf)).join(table(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("post_id"), "lang"), "post_id")
    fields = ["post_id", "title", "selftext", "created_utc", F.lit(1).alias("score"), "comments"]
    whole = F.to_json(F.struct(*fields, F.col("lang").alias("community")))
    line = F.when(F.col("lang") == "de", F.concat(F.lit("{"), whole)).when(F.col("lang") == "es", F.to_json(F.struct(*fields))).otherwise(whole)
    path = shared_dir(spark, "feed")
    posts.select(line.alias("value")).write.text(path)
    discard_at_exit(spark, path)
    good, bad = read_posts(spark, path)
    shown = flatten_posts(good).select("post_id", "comment_text", F.lit(None).cast("string").alias("reason"))
    return shown.unionByName(bad.select("reason"), allowMissingColumns=True)


@query(
    "flatten_posts_all",
    f"""WITH {_LINES_SQL}
    SELECT CAST(lines.doc_id AS VARCHAR) AS post_id, lines.source AS post_title, documents.text AS post_text,
        strftime(epoch_ms((1704067200 + lines.doc_id) * 1000), '%Y-%m-%d %H:%M:%S') AS post_created, body AS comment_text,
        strftime(epoch_ms((1704067200 + lines.doc_id + i) * 1000), '%Y-%m-%d %H:%M:%S') AS comment_created
    FROM lines JOIN documents USING (doc_id) WHERE i > 0""",
)
def flatten_all(spark, sf):
    docs = deal_texts(table(spark, sf, "documents"), "text", int(spark.conf.get("spark.sql.shuffle.partitions")))
    return flatten_posts(_nested(docs)).select(
        "post_id", "post_title", "post_text", "post_created", "comment_text", "comment_created")


@query(
    "join_posts",
    """SELECT doc_id AS post_id, turn, source AS post_title, conversations.text AS comment_text
    FROM conversations JOIN documents ON doc_id = conv_id""",
)
def joined(spark, sf):
    posts = table(spark, sf, "documents").select(F.col("doc_id").alias("post_id"), F.col("source").alias("post_title"))
    rows = table(spark, sf, "conversations").select(
        F.col("conv_id").alias("post_id"), "turn", F.col("text").alias("comment_text")
    )
    return join_posts(posts, rows).select("post_id", "turn", "post_title", "comment_text")


def _landed(spark, sf):
    """Posts and comments as tables laid out for the join and the look-back."""
    posts = table(spark, sf, "documents").select(
        F.col("doc_id").alias("post_id"), F.col("lang").alias("community"), F.col("source").alias("post_title"),
        (F.lit("2024-01-20").cast("timestamp_ntz") - F.make_dt_interval(mins=(F.col("doc_id") * 7).cast("int"))).alias("created"), F.col("n_chars").alias("score"))
    turns = table(spark, sf, "conversations").select(F.col("conv_id").alias("post_id"), "turn", F.col("text").alias("comment_text"))
    return land_posts(posts, 8), land_comments(turns, 8)


@query("join_posts_bucketed", ORACLES["join_posts"])
def joined_by_buckets(spark, sf):
    posts, turns = _landed(spark, sf)
    return join_posts(posts, turns).select("post_id", "turn", "post_title", "comment_text")


@query(
    "top_posts_landed",
    """SELECT doc_id AS post_id, n_chars AS score FROM documents
    WHERE lang = 'en' AND TIMESTAMP '2024-01-20' - to_minutes(doc_id * 7) > TIMESTAMP '2024-01-20' - INTERVAL 1 DAY
    ORDER BY n_chars DESC, doc_id LIMIT 10""",
)
def top_landed(spark, sf):
    posts, _ = _landed(spark, sf)
    return top_posts(posts, "en", datetime(2024, 1, 20), "day", 10, day_col="day").select("post_id", "score")


_WORD = r"regexp_extract_all({text}, '[\p{{L}}\p{{N}}]+')"

# Openings of the benchmark texts stand in for a gazetteer table; some types are not wanted.
_ALL_TYPES = (*TYPES, "DATE", "CARDINAL")
_GAZETTEER_SQL = f"""g AS (SELECT item_id, 1 + item_id % 3 AS n, {_WORD.format(text='text')} AS w FROM benchmark),
    gazetteer AS (SELECT DISTINCT array_to_string(w[1:n], ' ') AS phrase, n,
        [{quoted(_ALL_TYPES)}][1 + item_id % 9] AS type FROM g WHERE len(w) >= n AND item_id % 9 < {len(TYPES)}),
    words AS (SELECT doc_id, {_WORD.format(text='text')} AS w FROM documents),
    t AS (SELECT doc_id, unnest(w) AS t1, generate_subscripts(w, 1) AS pos FROM words),
    t3 AS (SELECT doc_id, pos, t1, lead(t1, 1) OVER o AS t2, lead(t1, 2) OVER o AS t3 FROM t
        WINDOW o AS (PARTITION BY doc_id ORDER BY pos)),
    grams AS (SELECT doc_id, pos, 1 AS n, t1 AS phrase FROM t3
        UNION ALL SELECT doc_id, pos, 2, t1 || ' ' || t2 FROM t3 WHERE t2 IS NOT NULL
        UNION ALL SELECT doc_id, pos, 3, t1 || ' ' || t2 || ' ' || t3 FROM t3 WHERE t3 IS NOT NULL),
    hits AS (SELECT doc_id, pos, grams.n, phrase, type FROM grams JOIN gazetteer USING (phrase)),
    whole AS (SELECT * FROM hits h WHERE NOT EXISTS (SELECT 1 FROM hits o WHERE o.doc_id = h.doc_id
        AND o.n > h.n AND o.pos <= h.pos AND o.pos + o.n >= h.pos + h.n))"""


def gazetteer(spark, sf):
    items = table(spark, sf, "benchmark").select("item_id", raw_words(F.col("text")).alias("w"))
    n = (1 + F.col("item_id") % 3).cast("int")
    types = F.array(*[F.lit(t) for t in _ALL_TYPES])
    kind = F.element_at(types, (1 + F.col("item_id") % len(_ALL_TYPES)).cast("int"))
    return items.where(F.size("w") >= n).select(
        F.array_join(F.slice("w", F.lit(1), n), " ").alias("phrase"), kind.alias("type")
    )


@query(
    "entity_extract",
    f"""WITH {_GAZETTEER_SQL}, lists AS (
        SELECT doc_id, string_agg(phrase, '|' ORDER BY pos, type) AS entities, count(*) AS n FROM whole GROUP BY doc_id)
    SELECT doc_id, coalesce(entities, '') AS entities, CAST(coalesce(n, 0) AS INTEGER) AS n
    FROM documents LEFT JOIN lists USING (doc_id)""",
)
def entity_extract(spark, sf):
    found = extract(documents(spark, sf), "doc_id", ["text"], gazetteer(spark, sf))
    return found.select("doc_id", F.array_join("named_entities", "|").alias("entities"),
                        F.size("named_entities").alias("n"))


@query("entity_counts", f"WITH {_GAZETTEER_SQL} SELECT phrase, type, count(*) AS n FROM whole GROUP BY ALL")
def counts(spark, sf):
    return entity_counts(mentions(documents(spark, sf), "doc_id", ["text"], gazetteer(spark, sf)))


@query(
    "entity_greedy",
    f"""WITH RECURSIVE {_GAZETTEER_SQL},
    best AS (SELECT doc_id, pos, max(n) AS n FROM hits GROUP BY doc_id, pos),
    after AS (SELECT b.doc_id, b.pos, min(f.pos) AS follows FROM best b LEFT JOIN best f ON b.doc_id = f.doc_id AND f.pos >= b.pos + b.n GROUP BY b.doc_id, b.pos),
    chain AS (SELECT doc_id, min(pos) AS pos FROM best GROUP BY doc_id
        UNION ALL SELECT chain.doc_id, follows FROM chain JOIN after ON after.doc_id = chain.doc_id AND after.pos = chain.pos WHERE follows IS NOT NULL)
    SELECT doc_id, CAST(pos - 1 AS INTEGER) AS start, phrase, type FROM chain JOIN best USING (doc_id, pos) JOIN hits USING (doc_id, pos, n)""",
)
def entity_greedy(spark, sf):
    """Mentions that do not overlap, from the left."""
    found = mentions(documents(spark, sf), "doc_id", ["text"], gazetteer(spark, sf), overlap="greedy")
    return found.select("doc_id", "start", "phrase", "type")


# A small phrase list; DATE is not a reported type.
PHRASES = {
    "The": "ORG", "of the": "GPE", "and of the": "WORK_OF_ART", "the": "PRODUCT", "de la": "PERSON",
    "La": "NORP", "in": "DATE", "Der": "EVENT", "que": "PERSON", "to": "ORG", "to the": "GPE",
}


def _phrases_sql(text: str, key: str, source: str) -> str:
    """CTE ``found(key, entities)`` for the fixed phrase list."""
    allowed = {p: t for p, t in PHRASES.items() if t in TYPES}
    grams = "UNION ALL ".join(
        f"SELECT k, pos, {n} AS n, {' || chr(32) || '.join(f't{i + 1}' for i in range(n))} AS phrase FROM {source}_t3 "
        for n in (1, 2, 3)
    )
    return f"""{source}_w AS (SELECT {key} AS k, {_WORD.format(text=text)} AS w FROM {source}),
    {source}_t AS (SELECT k, unnest(w) AS t1, generate_subscripts(w, 1) AS pos FROM {source}_w),
    {source}_t3 AS (SELECT k, pos, t1, lead(t1, 1) OVER o AS t2, lead(t1, 2) OVER o AS t3 FROM {source}_t
        WINDOW o AS (PARTITION BY k ORDER BY pos)),
    {source}_hits AS (SELECT * FROM ({grams}) WHERE phrase IN ({quoted(allowed)})),
    {source}_whole AS (SELECT * FROM {source}_hits h WHERE NOT EXISTS (SELECT 1 FROM {source}_hits o
        WHERE o.k = h.k AND o.n > h.n AND o.pos <= h.pos AND o.pos + o.n >= h.pos + h.n)),
    {source}_found AS (SELECT k, string_agg(phrase, '|' ORDER BY pos) AS entities FROM {source}_whole GROUP BY k)"""


@query(
    "entity_inline",
    f"""WITH {_phrases_sql('text', 'doc_id', 'documents')}
    SELECT doc_id, coalesce(entities, '') AS entities FROM documents LEFT JOIN documents_found ON doc_id = k""",
)
def entity_inline(spark, sf):
    found = mentions_in(F.col("text"), PHRASES)
    return documents(spark, sf).select("doc_id", F.array_join(found, "|").alias("entities"))


# Documents as posts, conversation turns as their comments, dated by an event.
_REPORT_SQL = """c AS (SELECT conv_id * 8 + turn AS comment_id, conv_id AS post_id, text AS comment_text, ts
        FROM conversations JOIN events ON event_id = conv_id * 8 + turn)"""


def _posts(spark, sf):
    return documents(spark, sf).select(
        F.col("doc_id").alias("post_id"),
        F.concat(F.initcap("lang"), F.lit(" The "), "source").alias("post_title"),
        F.col("text").alias("post_text"),
    )


def _comments(spark, sf):
    turns = dealt(table(spark, sf, "conversations")).withColumn("comment_id", F.col("conv_id") * 8 + F.col("turn"))
    times = table(spark, sf, "events").select(F.col("event_id").alias("comment_id"), F.col("ts").alias("comment_created"))
    return turns.join(times, "comment_id").select(
        "comment_id", F.col("conv_id").alias("post_id"), F.col("text").alias("comment_text"), "comment_created"
    )


@query(
    "comment_report",
    f"""WITH {_REPORT_SQL},
    p AS (SELECT doc_id AS post_id, upper(lang[1]) || lang[2:] || ' The ' || source AS post_title, text AS post_text
        FROM documents),
    {_phrases_sql('post_title', 'post_id', 'p')},
    p2 AS (SELECT * FROM p), {_phrases_sql('post_text', 'post_id', 'p2')},
    {_phrases_sql('comment_text', 'comment_id', 'c')},
    cleaned AS (SELECT *, {normalize_sql('comment_text', 'serving')} AS clean_text FROM c),
    scored AS (SELECT *, {word_logits_sql(words_sql('clean_text'))} AS z FROM cleaned)
    SELECT comment_id, comment_text, {_NAME_SQL.format(y=class_sql('z'))} AS sentiment_labels,
        strftime(ts, '%Y-%m-%d %H:%M:%S') AS comment_created,
        CAST(dense_rank() OVER (ORDER BY CAST(ts AS DATE)) AS INTEGER) AS period_int, post_title,
        concat_ws('|', pf.entities, p2f.entities, cf.entities) AS named_entities
    FROM scored JOIN p USING (post_id) LEFT JOIN p_found pf ON pf.k = post_id
        LEFT JOIN p2_found p2f ON p2f.k = post_id LEFT JOIN c_found cf ON cf.k = comment_id""",
)
def report(spark, sf):
    return _shown(comment_report(_posts(spark, sf), _comments(spark, sf), text_logits, PHRASES, "D", SEED_LEMMAS))


def _shown(out):
    return out.select(
        "comment_id", "comment_text", "sentiment_labels",
        F.date_format("comment_created", "yyyy-MM-dd HH:mm:ss").alias("comment_created"),
        "period_int", "post_title", F.array_join("named_entities", "|").alias("named_entities"),
    )


# The lexicon: regular plurals whose stem is a word of the comments, and some irregular forms.
_OWN_SQL = f"""words AS (SELECT DISTINCT unnest({words_sql('plain')}) AS word FROM cleaned),
    stems AS (SELECT word, rank, stem FROM words, LATERAL (VALUES {STEMS_SQL}) AS v(rank, stem) WHERE stem IN (SELECT word FROM words)
        AND word NOT IN ({quoted(IRREGULAR)})),
    lexicon AS (SELECT word AS token, arg_min(stem, rank) AS replacement FROM stems GROUP BY word
        UNION ALL SELECT word, CASE word {' '.join(f"WHEN '{k}' THEN '{v}'" for k, v in IRREGULAR.items())} END FROM words WHERE word IN ({quoted(IRREGULAR)})),
    spread AS (SELECT comment_id, unnest({words_sql('plain')}) AS token, generate_subscripts({words_sql('plain')}, 1) AS pos FROM cleaned),
    rewritten AS (SELECT comment_id, string_agg(coalesce(replacement, token), ' ' ORDER BY pos) AS clean_text FROM spread LEFT JOIN lexicon USING (token) GROUP BY comment_id)"""


@query(
    "comment_report_lemmas",
    f"""WITH {_REPORT_SQL}, cleaned AS (SELECT comment_id, {normalize_sql('comment_text', 'serving', lemmas=False)} AS plain FROM c), {_OWN_SQL},
    whole AS (SELECT comment_id, coalesce(clean_text, '') AS clean_text FROM cleaned LEFT JOIN rewritten USING (comment_id)),
    scored AS (SELECT *, {word_logits_sql(words_sql('clean_text'))} AS z FROM whole)
    SELECT comment_id, clean_text, {_NAME_SQL.format(y=class_sql('z'))} AS sentiment_labels FROM scored""",
)
def report_lemmas(spark, sf):
    """Comments scored on texts whose nouns were brought to forms that the comments themselves have."""
    model = column_model(text_logits, rewrite=own_lemmas("comment_id", IRREGULAR))
    return comment_report(_posts(spark, sf), _comments(spark, sf), model, {}, "D").select("comment_id", "clean_text", "sentiment_labels")


@query("comment_report_python", ORACLES["comment_report"])
def report_python(spark, sf):
    out = comment_report(_posts(spark, sf), _comments(spark, sf), python_model(WordScorer(), lemmas=SEED_LEMMAS), PHRASES, "D")
    return _shown(out)


@query(
    "cleaned_comments",
    f"""WITH {_REPORT_SQL}, cleaned AS (SELECT *, {normalize_sql('comment_text', 'batch')} AS clean_text FROM c),
    scored AS (SELECT *, {word_logits_sql(words_sql('clean_text'))} AS z FROM cleaned)
    SELECT comment_text, strftime(ts, '%Y-%m-%d %H:%M:%S') AS comment_created, clean_text,
        {class_sql('z')} AS class_predictions, {_NAME_SQL.format(y=class_sql('z'))} AS sentiment_labels,
        CAST(date_trunc('week', ts) AS DATE) AS period_date,
        CAST(dense_rank() OVER (ORDER BY date_trunc('week', ts)) AS INTEGER) AS period_int FROM scored""",
)
def cleaned(spark, sf):
    out = cleaned_comments(_comments(spark, sf), text_logits, "W", SEED_LEMMAS).select(*CLEANED)
    return out.withColumn("comment_created", F.date_format("comment_created", "yyyy-MM-dd HH:mm:ss"))


# A request: posts of a language by length, the first turns of each, without the system's.
_REQUEST_SQL = f"""p AS (SELECT doc_id AS post_id, source AS post_title FROM documents
        WHERE lang = 'en' AND TIMESTAMP '2024-01-20' - to_minutes(doc_id) > TIMESTAMP '2024-01-20' - INTERVAL 1 MONTH
        ORDER BY n_chars DESC, doc_id LIMIT 150),
    asked AS (SELECT conv_id AS post_id, conv_id * 8 + turn AS comment_id, role, text AS comment_text, ts, post_title,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS rn
        FROM conversations JOIN events ON event_id = conv_id * 8 + turn JOIN p ON p.post_id = conv_id),
    cleaned AS (SELECT *, {normalize_sql('comment_text', 'serving')} AS clean_text FROM asked WHERE rn <= 4 AND role <> 'system'),
    scored AS (SELECT *, {_NAME_SQL.format(y=class_sql('z'))} AS label FROM (
        SELECT *, {word_logits_sql(words_sql('clean_text'))} AS z FROM cleaned))"""


def _request(spark, sf):
    posts = table(spark, sf, "documents").select(
        F.col("doc_id").alias("post_id"), F.col("lang").alias("community"), F.col("n_chars").alias("score"),
        (F.lit("2024-01-20").cast("timestamp_ntz") - F.make_dt_interval(mins=F.col("doc_id").cast("int"))).alias("created"),
        F.col("source").alias("post_title"), F.lit("").alias("post_text"),
    )
    turns = table(spark, sf, "conversations").select("conv_id", "turn", (F.col("role") == "system").alias("stickied"))
    ranked = _comments(spark, sf).join(turns.withColumn("comment_id", F.col("conv_id") * 8 + F.col("turn")), "comment_id")
    return dashboard_for(posts, ranked.withColumn("rank", F.col("turn")), column_model(text_logits, lemmas=SEED_LEMMAS), "en", datetime(2024, 1, 20), "month", 150, 2,
                         period="W", show_text_analysis=True, stopwords=())


@query(
    "request_counts",
    f"""WITH {_REQUEST_SQL}
    SELECT CAST(dense_rank() OVER (ORDER BY CAST(date_trunc('week', ts) AS DATE)) AS INTEGER) AS period_int,
        CAST(date_trunc('week', ts) AS DATE) AS period_date, count(*) FILTER (label = 'negative') AS negative,
        count(*) FILTER (label = 'neutral') AS neutral, count(*) FILTER (label = 'positive') AS positive, count(*) AS total
    FROM scored GROUP BY date_trunc('week', ts)""",
)
def request_counts(spark, sf):
    return _request(spark, sf).counts


@query(
    "request_report",
    f"""WITH {_REQUEST_SQL} SELECT comment_text, label AS sentiment_labels, strftime(ts, '%Y-%m-%d %H:%M:%S') AS comment_created,
        CAST(dense_rank() OVER (ORDER BY date_trunc('week', ts)) AS INTEGER) AS period_int, post_title FROM scored""",
)
def request_report(spark, sf):
    return _request(spark, sf).report.drop("named_entities").withColumn(
        "comment_created", F.date_format("comment_created", "yyyy-MM-dd HH:mm:ss"))


@query(
    "request_words",
    f"""WITH {_REQUEST_SQL} SELECT word, count(*) AS n FROM (SELECT unnest({words_sql('clean_text')}) AS word FROM scored)
    GROUP BY word ORDER BY n DESC, word LIMIT 20""",
)
def request_words(spark, sf):
    return _request(spark, sf).words
