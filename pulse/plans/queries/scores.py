"""Label codings, score vectors, evaluation."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from ...functions.binding import once
from ...functions.labels import EMOTIONS, SENTIMENTS, decode, encode_labels
from ...functions.text import clean, split_words
from ...functions.vectors import argmax, confidence, linear, one_hot, softmax
from ...operators.evaluate import best_run, last_is_best, metrics, report
from ...operators.scoring import score, score_frame, with_predictions, word_logits
from ...operators.epochs import hashed_words
from ...operators.padded import LIMIT, score_padded
from ...operators.positions import glue_by_position
from ...session import shared_dir
from .base import LOGITS_SQL, documents, logits, query, table, words_sql
from .cleaning import clean_sql

_NAME_SQL = "CASE {y} WHEN 0 THEN 'neutral' WHEN 1 THEN 'positive' WHEN 2 THEN 'negative' END"


@query("decode_labels", f"SELECT vec_id, {_NAME_SQL.format(y='label')} AS name FROM embeddings")
def decode_labels(spark, sf):
    return table(spark, sf, "embeddings").select("vec_id", decode(F.col("label")).alias("name"))


@query(
    "decode_emotions",
    "SELECT vec_id, ['Sadness', 'Joy', 'Love', 'Anger', 'Fear', 'Surprise'][label + 1] AS name FROM embeddings",
)
def decode_emotions(spark, sf):
    return table(spark, sf, "embeddings").select("vec_id", decode(F.col("label"), EMOTIONS).alias("name"))


@query(
    "encode_labels",
    "SELECT vec_id, CASE label - 1 WHEN -1 THEN 2 WHEN 0 THEN 0 WHEN 1 THEN 1 END AS y FROM embeddings",
)
def encode(spark, sf):
    return table(spark, sf, "embeddings").select("vec_id", encode_labels(F.col("label") - 1).alias("y"))


def softmax_sql(z: str) -> str:
    """Struct-free softmax of three cells, as a list."""
    top = f"list_max({z})"
    return f"""[{', '.join(f'exp({z}[{i}] - {top}) / (exp({z}[1] - {top}) + exp({z}[2] - {top}) + exp({z}[3] - {top}))'
                           for i in (1, 2, 3))}]"""


_P_SQL = f"{LOGITS_SQL}, probs AS (SELECT *, {softmax_sql('z')} AS p FROM logits)"


@query(
    "softmax",
    f"WITH {_P_SQL} SELECT vec_id, round(p[1], 6) AS p0, round(p[2], 6) AS p1, round(p[3], 6) AS p2 FROM probs",
)
def probabilities(spark, sf):
    p = logits(spark, sf).select("vec_id", softmax(F.col("z"), 3).alias("p"))
    return p.select("vec_id", *[F.round(F.col("p")[i], 6).alias(f"p{i}") for i in range(3)])


@query(
    "argmax_label",
    f"""WITH {LOGITS_SQL}, best AS (SELECT vec_id, CAST(list_position(z, list_max(z)) - 1 AS INTEGER) AS y FROM logits)
    SELECT vec_id, y AS class_predictions, {_NAME_SQL.format(y='y')} AS sentiment_labels FROM best""",
)
def argmax_label(spark, sf):
    out = with_predictions(logits(spark, sf), "z")
    return out.select("vec_id", "class_predictions", "sentiment_labels")


@query("overall_score", f"WITH {_P_SQL} SELECT vec_id, round(list_max(p), 6) AS overall FROM probs")
def overall_score(spark, sf):
    p = logits(spark, sf).select("vec_id", softmax(F.col("z"), 3).alias("p"))
    return p.select("vec_id", F.round(confidence(F.col("p")), 6).alias("overall"))


@query(
    "one_hot",
    f"""WITH {LOGITS_SQL} SELECT vec_id, CAST(y = 0 AS INTEGER)::DOUBLE AS y0,
    CAST(y = 1 AS INTEGER)::DOUBLE AS y1, CAST(y = 2 AS INTEGER)::DOUBLE AS y2 FROM logits""",
)
def hot(spark, sf):
    h = logits(spark, sf).select("vec_id", one_hot(F.col("y"), 3).alias("h"))
    return h.select("vec_id", *[F.col("h")[i].alias(f"y{i}") for i in range(3)])


# Fixed weights of the linear scorer, by rule.
WEIGHTS = [[((7 * i + 3 * c) % 11 - 5) / 10 for i in range(64)] for c in range(3)]
BIAS = [0.1, 0.0, -0.1]

_LINEAR_SQL = f"""WITH x AS (SELECT vec_id, list_transform(embedding, lambda v: v::DOUBLE) AS v FROM embeddings),
    scored AS (SELECT vec_id, [{', '.join(f"list_dot_product(v, {w}::DOUBLE[]) + {b}" for w, b in zip(WEIGHTS, BIAS, strict=True))}] AS z FROM x)
    SELECT vec_id, round(z[1], 6) AS z0, round(z[2], 6) AS z1, round(z[3], 6) AS z2,
        CAST(list_position(z, list_max(z)) - 1 AS INTEGER) AS class_predictions FROM scored"""


def _shown(scored):
    cells = [F.round(F.col("logits")[i], 6).alias(f"z{i}") for i in range(3)]
    return scored.select("vec_id", *cells, argmax(F.col("logits")).alias("class_predictions"))


@query("score_linear", _LINEAR_SQL)
def score_linear(spark, sf):
    x = F.col("embedding").cast("array<double>")
    return _shown(table(spark, sf, "embeddings").select("vec_id", linear(x, WEIGHTS, BIAS).alias("logits")))


class LinearScorer:
    """The linear scorer as a Python model, to exercise the slot for one."""

    name = "linear-64"

    def load(self):
        w, b = np.asarray(WEIGHTS), np.asarray(BIAS)
        return lambda batch: np.stack(batch.to_list()).astype("float64") @ w.T + b


@query("score_python", _LINEAR_SQL)
def score_python(spark, sf):
    rows = table(spark, sf, "embeddings").select("vec_id", "embedding")
    return _shown(score(rows, LinearScorer(), "embedding"))


# Fixed weights of the word scorer: neutral, positive, negative.
WORD_WEIGHTS = {
    "the": (0.5, 0.0, 0.0), "of": (0.25, 0.5, 0.0), "and": (0.0, 0.75, 0.25), "in": (0.0, 0.0, 0.5),
    "de": (0.0, 0.25, 0.75), "la": (0.25, 0.25, 0.25), "der": (0.0, 0.5, 0.5), "que": (0.5, 0.0, 0.75),
}
WORD_BIAS = (0.5, 0.25, 0.0)


def text_logits(text):
    return word_logits(split_words(text), WORD_WEIGHTS, WORD_BIAS)


class WordScorer:
    """The word scorer as a Python model: any job must give the same rows with it."""

    name = "words"

    def load(self):
        def predict(texts):
            rows = np.tile(np.array(WORD_BIAS), (len(texts), 1))
            for row, text in zip(rows, texts):
                for w in (text or "").split():
                    if w in WORD_WEIGHTS:
                        row += WORD_WEIGHTS[w]
            return rows

        return predict


def word_logits_sql(words: str) -> str:
    def cell(c: int) -> str:
        terms = " + ".join(
            f"{v[c]} * len(list_filter({words}, lambda w: w = '{k}'))" for k, v in WORD_WEIGHTS.items()
        )
        return f"({WORD_BIAS[c]} + {terms})::DOUBLE"

    return f"[{', '.join(cell(c) for c in range(3))}]"


def class_sql(z: str) -> str:
    return f"CAST(list_position({z}, list_max({z})) - 1 AS INTEGER)"


@query(
    "score_words",
    f"""WITH w AS (SELECT doc_id, {words_sql(clean_sql('text', 'serving'))} AS w FROM documents),
    scored AS (SELECT doc_id, {word_logits_sql('w')} AS z FROM w)
    SELECT doc_id, {class_sql('z')} AS class_predictions, {_NAME_SQL.format(y=class_sql('z'))} AS sentiment_labels
    FROM scored""",
)
def score_words(spark, sf):
    rows = documents(spark, sf).withColumn("clean_text", clean(F.col("text"), "serving"))
    out = with_predictions(rows.withColumn("logits", text_logits(F.col("clean_text"))))
    return out.select("doc_id", "class_predictions", "sentiment_labels")


@query(
    "score_frame",
    f"""WITH {_P_SQL} SELECT vec_id AS row_id, text AS "Text", round(p[1], 6) AS neutral, round(p[2], 6) AS positive,
    round(p[3], 6) AS negative, round(list_max(p), 6) AS "Overall_Score" FROM probs JOIN documents ON doc_id = vec_id""",
)
def frame(spark, sf):
    text = documents(spark, sf).select(F.col("doc_id").alias("row_id"), "text")
    scores = logits(spark, sf).select(F.col("vec_id").alias("row_id"), F.col("z").alias("logits"))
    out = score_frame(text, scores, "row_id", SENTIMENTS)
    return out.select("row_id", "Text", *[F.round(c, 6).alias(c) for c in (*SENTIMENTS, "Overall_Score")])


@query(
    "score_frame_head",
    f"""WITH {_P_SQL} SELECT vec_id AS row_id, round(list_max(p), 6) AS "Overall_Score"
    FROM probs JOIN documents ON doc_id = vec_id ORDER BY row_id LIMIT 5""",
)
def frame_head(spark, sf):
    return frame(spark, sf).orderBy("row_id").limit(5).select("row_id", "Overall_Score")


def _metrics_sql(cells: str) -> str:
    return f"""WITH {_P_SQL},
    cells AS (SELECT y, z, {cells} AS c FROM probs),
    sums AS (SELECT avg(list_max(z) + ln(exp(z[1] - list_max(z)) + exp(z[2] - list_max(z)) + exp(z[3] - list_max(z)))
            - z[y + 1]) AS loss,
        avg(CASE WHEN {class_sql('z')} = y THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS accuracy,
        sum(CASE WHEN c[y + 1] > 0.5 THEN 1 ELSE 0 END)::DOUBLE AS tp,
        sum(len(list_filter(c, lambda v: v > 0.5)))::DOUBLE AS called, count(*)::DOUBLE AS n FROM cells),
    pr AS (SELECT loss, accuracy, CASE WHEN called > 0 THEN tp / called ELSE 0 END AS p,
        CASE WHEN n > 0 THEN tp / n ELSE 0 END AS r FROM sums)
    SELECT round(loss, 6) AS loss, round(accuracy, 6) AS accuracy, round(p, 6) AS precision, round(r, 6) AS recall,
        round(CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END, 6) AS f1 FROM pr"""


# The logits are small; scaled up, some cross the cut.
def _scaled(spark, sf):
    return logits(spark, sf).withColumn("z", F.transform("z", lambda v: v * 5.0))


_SCALED = ("embedding[1]::DOUBLE, embedding[2]::DOUBLE, embedding[3]::DOUBLE",
           "embedding[1]::DOUBLE * 5.0, embedding[2]::DOUBLE * 5.0, embedding[3]::DOUBLE * 5.0")


@query(
    "eval_metrics_left_out",
    _metrics_sql("z").replace("label % 3 AS y", "label % 5 AS y").replace("FROM probs)", "FROM probs WHERE y < 3)").replace(
        "SELECT round(loss, 6)", "SELECT (SELECT count(*) FROM probs WHERE y > 2) AS left_out, round(loss, 6)"),
)
def metrics_left_out(spark, sf):
    # classes 3 and 4 are not among the three that the logits are for
    rows = logits(spark, sf).withColumn("y", F.col("label") % 5)
    out = metrics(rows, "y", "z", 3, left_out="left_out")
    return out.select("left_out", *[F.round(c, 6).alias(c) for c in out.columns[1:]])


def _register(name: str, cut: str, cells: str) -> None:
    @query(name, _metrics_sql(cells).replace(*_SCALED))
    def run(spark, sf):
        out = metrics(_scaled(spark, sf), "y", "z", 3, cut)
        return out.select(*[F.round(c, 6).alias(c) for c in out.columns])


_register("eval_metrics", "logit", "z")
_register("eval_metrics_probability", "probability", "p")


def report_sql(head: str, names) -> str:
    """The class report over the CTE ``rows(y, p)`` that ``head`` ends with."""
    listed = ", ".join(f"({i}, '{n}')" for i, n in enumerate(names))
    return f"""WITH {head},
    names(i, label) AS (VALUES {listed}),
    per AS (SELECT i, label, count(*) FILTER (y = i AND p = i)::DOUBLE AS tp, count(*) FILTER (p = i)::DOUBLE AS called,
        count(*) FILTER (y = i)::DOUBLE AS support FROM names, rows GROUP BY i, label),
    pr AS (SELECT label, support, CASE WHEN called > 0 THEN tp / called ELSE 0.0::DOUBLE END AS precision,
        CASE WHEN support > 0 THEN tp / support ELSE 0.0::DOUBLE END AS recall FROM per),
    f AS (SELECT label, precision, recall, CASE WHEN precision + recall > 0
        THEN 2 * precision * recall / (precision + recall) ELSE 0.0::DOUBLE END AS f1, support FROM pr),
    acc AS (SELECT count(*) FILTER (y = p)::DOUBLE / count(*) AS a FROM rows),
    lines AS (SELECT label, precision, recall, f1, support FROM f
        UNION ALL SELECT 'accuracy', a, a, a, a FROM acc
        UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), sum(support) FROM f
        UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
            sum(f1 * support) / sum(support), sum(support) FROM f)
    SELECT label, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1,
        round(support, 6) AS support FROM lines"""


def _report_sql(y: str, p: str, names) -> str:
    return report_sql(f"{LOGITS_SQL}, rows AS (SELECT {y} AS y, {p} AS p FROM logits)", names)


def _rounded(out):
    return out.select("label", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1", "support")])


@query("classification_report", _report_sql("y", class_sql("z"), SENTIMENTS))
def class_report(spark, sf):
    rows = logits(spark, sf).withColumn("pred", argmax(F.col("z")))
    return _rounded(report(rows, "y", "pred", SENTIMENTS))


@query("classification_report_emotions", _report_sql("label % 6", f"({class_sql('z')} + label) % 5", EMOTIONS))
def emotion_report(spark, sf):
    # the last emotion is never predicted: zero denominators
    rows = logits(spark, sf).select((F.col("label") % 6).alias("y"), ((argmax(F.col("z")) + F.col("label")) % 5).alias("p"))
    return _rounded(report(rows, "y", "p", EMOTIONS))


_RUNS_SQL = """runs AS (SELECT event_type AS run, CAST(day(ts) AS INTEGER) AS epoch,
    avg(CASE WHEN value > 10 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS val_accuracy FROM events GROUP BY ALL)"""


def _runs(spark, sf):
    hit = F.avg((F.col("value") > 10).cast("double")).alias("val_accuracy")
    keys = (F.col("event_type").alias("run"), F.dayofmonth("ts").alias("epoch"))
    return table(spark, sf, "events").groupBy(*keys).agg(hit)


@query(
    "best_run",
    f"""WITH {_RUNS_SQL} SELECT run, epoch, round(val_accuracy, 6) AS val_accuracy
    FROM runs ORDER BY runs.val_accuracy DESC, epoch, run LIMIT 1""",
)
def best(spark, sf):
    return best_run(_runs(spark, sf)).withColumn("val_accuracy", F.round("val_accuracy", 6))


@query(
    "last_is_best",
    f"""WITH {_RUNS_SQL} SELECT run, round(max(val_accuracy), 6) AS best,
    round(max_by(val_accuracy, epoch), 6) AS last, max(val_accuracy) = max_by(val_accuracy, epoch) AS keep
    FROM runs GROUP BY run""",
)
def last_best(spark, sf):
    out = last_is_best(_runs(spark, sf))
    return out.select("run", F.round("best", 6).alias("best"), F.round("last", 6).alias("last"), "keep")


@query(
    "glue_by_position",
    f"""WITH {LOGITS_SQL}, t AS (SELECT doc_id, text, row_number() OVER (ORDER BY doc_id) - 1 AS position FROM documents),
    s AS (SELECT vec_id, round(z[1], 6) AS z0, row_number() OVER (ORDER BY vec_id) - 1 AS position FROM logits)
    SELECT position, doc_id, text, vec_id, z0 FROM t JOIN s USING (position) WHERE position < least((SELECT count(*) FROM t), (SELECT count(*) FROM s))""",
)
def glued(spark, sf):
    """Texts and scores written apart, as CSV and parquet of other splits, and laid side by side."""
    scores = logits(spark, sf).select("vec_id", F.round(F.col("z")[0], 6).alias("z0"))
    texts = table(spark, sf, "documents").select("doc_id", "text")
    # both tables as long as the shorter one
    ids = [df.agg(F.count("*")).scalar() for df in (texts, scores)]
    least = F.least(*ids)
    paths = shared_dir(spark, "texts"), shared_dir(spark, "scores")
    for df, key, path, parts in ((texts, "doc_id", paths[0], 5), (scores, "vec_id", paths[1], 3)):
        df.where(F.col(key) < least).repartitionByRange(parts, key).sortWithinPartitions(key).write.parquet(path)
    return glue_by_position(spark.read.parquet(paths[0]), spark.read.parquet(paths[1]))


class ClassCounter:
    """Counts the ids of each class modulo three; reads the mask."""

    name = "class-counter"

    def load(self):
        return lambda ids, mask: np.stack([((ids % 3 == c) & (mask == 1)).sum(axis=1) for c in range(3)], axis=1)


@query(
    "score_padded",
    f"""WITH w AS (SELECT doc_id, ({words_sql(clean_sql('text', 'serving'))})[1:{LIMIT}] AS w FROM documents),
    ids AS (SELECT doc_id, list_transform(w, lambda t: (('0x' || md5(t)[1:8])::BIGINT >> 18) % 3) AS c FROM w),
    s AS (SELECT doc_id, len(c) AS n, [CAST(len(list_filter(c, lambda x: x = 0)) AS DOUBLE), CAST(len(list_filter(c, lambda x: x = 1)) AS DOUBLE),
        CAST(len(list_filter(c, lambda x: x = 2)) AS DOUBLE)] AS z FROM ids)
    SELECT doc_id, CAST(n AS INTEGER) AS n, z[1] AS z0, z[2] AS z1, z[3] AS z2, {_NAME_SQL.format(y="list_position(z, list_max(z)) - 1")} AS sentiment_labels FROM s""",
)
def scored_in_padded_batches(spark, sf):
    words = hashed_words(split_words(clean(F.col("text"), "serving")), 14)
    rows = once(documents(spark, sf).select("doc_id", "text"), words=words).drop("text")
    out = with_predictions(score_padded(rows, "words", ClassCounter()))
    z = [F.col("logits")[c].alias(f"z{c}") for c in range(3)]
    return out.select("doc_id", F.least(F.size("words"), F.lit(LIMIT)).alias("n"), *z, "sentiment_labels")
