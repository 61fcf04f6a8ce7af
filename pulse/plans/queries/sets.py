"""Samples, splits, sequence encoding, training."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ...functions.text import clean, normalize, tokens
from ...functions.binding import once
from ...operators.bayes import fit_bayes
from ...operators.datasets import exact_sample, exact_split, hash_sample, split
from ...operators.encoding import build_vocab, encode
from ...operators.epochs import Settings, fit_epochs
from ...operators.scoring import with_predictions
from ...operators.subwords import encode_subwords, pieces, subword_vocab
from ...operators.train import baseline, fit
from ...settle import settle
from ...functions.labels import EMOTIONS
from ...session import discard_at_exit, shared_dir
from ...sources.files import read_jsonl
from ..training import PROFILE, emotion_job, train_and_evaluate, train_by_epochs, training_rows
from .base import documents, query, table, words_sql
from .cleaning import clean_sql, tokens_sql
from .scores import report_sql


def _docs(spark, sf):
    return documents(spark, sf).select("doc_id", "lang")


def _below(seed: str, fraction: float) -> str:
    return f"substr(md5('{seed}:' || doc_id), 1, 8) < '{round(fraction * 2**32):08x}'"


@query("hash_sample", f"SELECT doc_id FROM documents WHERE {_below('7', 0.5)}")
def sample(spark, sf):
    return hash_sample(_docs(spark, sf), "doc_id", 0.5, 7).select("doc_id")


@query(
    "exact_sample",
    """SELECT doc_id FROM (SELECT doc_id, row_number() OVER (ORDER BY md5('7:' || doc_id)) AS rn,
    count(*) OVER () AS n FROM documents) WHERE rn <= round_even(n * 0.5::DOUBLE, 0)""",
)
def sample_exact(spark, sf):
    return exact_sample(_docs(spark, sf), "doc_id", 0.5, 7).select("doc_id")


@query(
    "split_72_18_10",
    f"""SELECT doc_id, CASE WHEN {_below('s/test', 0.1)} THEN 'test' WHEN {_below('s/val', 0.2)} THEN 'val'
    ELSE 'train' END AS split FROM documents""",
)
def split_three(spark, sf):
    return split(_docs(spark, sf), "doc_id", "s").select("doc_id", "split")


@query(
    "split_80_20",
    f"SELECT doc_id, CASE WHEN {_below('2018/test', 0.2)} THEN 'test' ELSE 'train' END AS split FROM documents",
)
def split_two(spark, sf):
    return split(_docs(spark, sf), "doc_id", 2018, test=0.2, val=0.0).select("doc_id", "split")


def _exact_sql(by: str) -> str:
    return f"""WITH a AS (SELECT doc_id, lang, row_number() OVER ({by} ORDER BY md5('s/test:' || doc_id)) AS rn,
        count(*) OVER ({by}) AS n FROM documents),
    t AS (SELECT doc_id, lang, rn <= ceil(n * 0.1::DOUBLE) AS is_test FROM a),
    b AS (SELECT doc_id, row_number() OVER ({by} ORDER BY md5('s/val:' || doc_id)) AS rn,
        count(*) OVER ({by}) AS n FROM t WHERE NOT is_test)
    SELECT doc_id, 'test' AS split FROM t WHERE is_test
    UNION ALL SELECT doc_id, CASE WHEN rn <= ceil(n * 0.2::DOUBLE) THEN 'val' ELSE 'train' END FROM b"""


@query("split_exact", _exact_sql(""))
def split_exact(spark, sf):
    return exact_split(_docs(spark, sf), "doc_id", "s").select("doc_id", "split")


@query("split_stratified", _exact_sql("PARTITION BY lang"))
def split_stratified(spark, sf):
    return exact_split(_docs(spark, sf), "doc_id", "s", stratify="lang").select("doc_id", "split")


_VOCAB_SIZE = 5000
_VOCAB_SQL = f"""words AS (SELECT doc_id, {tokens_sql(clean_sql('text', 'training'))} AS w FROM documents),
    counts AS (SELECT token, count(*) AS n FROM (SELECT unnest(w) AS token FROM words) GROUP BY token),
    vocab AS (SELECT token, CAST(4 + row_number() OVER (ORDER BY n DESC, token) AS INTEGER) AS id, n
        FROM counts ORDER BY n DESC, token LIMIT {_VOCAB_SIZE - 5})"""


def _tokens(spark, sf):
    out = tokens(clean(F.col("text"), "training"))
    return documents(spark, sf).select("doc_id", out.alias("w"))


@query("build_vocab", f"WITH {_VOCAB_SQL} SELECT token, id, n FROM vocab")
def vocab(spark, sf):
    return build_vocab(_tokens(spark, sf), "w", _VOCAB_SIZE)


def _encode_sql(length: int) -> str:
    return f"""WITH {_VOCAB_SQL},
    cut AS (SELECT doc_id, w[1:{length - 2}] AS w FROM words),
    spread AS (SELECT doc_id, unnest(w) AS token, generate_subscripts(w, 1) AS pos FROM cut),
    ids AS (SELECT doc_id, list(coalesce(id, 1) ORDER BY pos) AS body FROM spread LEFT JOIN vocab USING (token)
        GROUP BY doc_id),
    full_ids AS (SELECT doc_id, coalesce(body, []) AS body FROM documents LEFT JOIN ids USING (doc_id))
    SELECT doc_id,
        array_to_string(list_resize(list_concat(list_concat([2], body), [3]), {length}, 0), ' ') AS input_ids,
        repeat('1 ', len(body) + 2) || repeat('0 ', {length - 2} - len(body)) AS attention_mask FROM full_ids"""


def _register(name: str, length: int) -> None:
    @query(name, _encode_sql(length))
    def run(spark, sf):
        rows = _tokens(spark, sf)
        out = encode(rows, "doc_id", "w", build_vocab(rows, "w", _VOCAB_SIZE), length)
        mask = F.concat(F.array_join("attention_mask", " "), F.lit(" "))
        return out.select("doc_id", F.array_join("input_ids", " ").alias("input_ids"), mask.alias("attention_mask"))


_register("encode_sequences", 128)
_register("encode_sequences_300", 300)

_LETTERS = "abcdefghijklmnopqrstuvwxyz0123456789.,;:!?"
_SUBWORDS_SQL = f"""{_VOCAB_SQL}, small AS (SELECT token, id FROM vocab WHERE id < 605), top AS (SELECT coalesce(max(id), 4) AS top FROM small),
    letters AS (SELECT unnest(string_split('{_LETTERS}', '')) AS token, unnest(range({len(_LETTERS)})) AS place),
    pieces AS (SELECT token, CAST(min(id) AS INTEGER) AS id FROM (
        SELECT token, id FROM small UNION ALL SELECT '##' || token, id + top FROM small, top
        UNION ALL SELECT token, 2 * top + 1 + 2 * place FROM letters, top UNION ALL SELECT '##' || token, 2 * top + 2 + 2 * place FROM letters, top) GROUP BY token),
    own AS (SELECT token FROM counts WHERE length(token) <= 100),
    tried AS (SELECT token AS word, p, unnest(range(1, length(token) - p + 2)) AS n FROM (SELECT token, unnest(range(1, length(token) + 1)) AS p FROM own)),
    best AS (SELECT word, p, max(n) AS n, arg_max(id, n) AS id FROM tried JOIN pieces ON pieces.token = CASE WHEN p > 1 THEN '##' ELSE '' END || substring(word, p, n) GROUP BY word, p),
    walk AS (SELECT token AS word, 1::BIGINT AS p, CAST([] AS INTEGER[]) AS ids FROM own
        UNION ALL SELECT walk.word, walk.p + best.n, list_append(walk.ids, best.id) FROM walk JOIN best ON best.word = walk.word AND best.p = walk.p),
    cut AS (SELECT counts.token, coalesce(ids, [1]) AS ids FROM counts LEFT JOIN (SELECT word, ids FROM walk WHERE p = length(word) + 1) ON word = token)"""


def _subwords(spark, sf):
    rows = _tokens(spark, sf)
    return rows, subword_vocab(build_vocab(rows, "w", 605).select("token", "id"), _LETTERS)


@query("subword_pieces", f"WITH RECURSIVE {_SUBWORDS_SQL} SELECT token, array_to_string(ids, ' ') AS ids FROM cut")
def subword_pieces(spark, sf):
    rows, own = _subwords(spark, sf)
    return pieces(rows.select(F.explode_outer("w").alias("token")), own).select("token", F.array_join("ids", " ").alias("ids"))


@query("encode_subwords", f"""WITH RECURSIVE {_SUBWORDS_SQL},
    spread AS (SELECT doc_id, unnest(w) AS token, generate_subscripts(w, 1) AS pos FROM words),
    ids AS (SELECT doc_id, flatten(list(ids ORDER BY pos))[1:126] AS body FROM spread JOIN cut USING (token) GROUP BY doc_id),
    full_ids AS (SELECT doc_id, coalesce(body, []) AS body FROM documents LEFT JOIN ids USING (doc_id))
    SELECT doc_id, array_to_string(list_resize(list_concat(list_concat([2], body), [3]), 128, 0), ' ') AS input_ids,
        repeat('1 ', len(body) + 2) || repeat('0 ', 126 - len(body)) AS attention_mask FROM full_ids""")
def subword_sequences(spark, sf):
    rows, own = _subwords(spark, sf)
    out = encode_subwords(rows, "doc_id", "w", own, 128)
    mask = F.concat(F.array_join("attention_mask", " "), F.lit(" "))
    return out.select("doc_id", F.array_join("input_ids", " ").alias("input_ids"), mask.alias("attention_mask"))


# Document labels stand in for stored sentiments.
_SENTIMENT_SQL = "CASE WHEN toxic = 1 THEN -1 ELSE quality END"


def _labelled(spark, sf):
    labels = table(spark, sf, "labels")
    sentiment = F.when(F.col("toxic") == 1, -1).otherwise(F.col("quality")).alias("sentiment")
    return documents(spark, sf).select("doc_id", "text").join(
        labels.select("doc_id", sentiment), "doc_id"
    )


@query(
    "training_rows",
    f"""WITH l AS (SELECT doc_id, array_to_string({tokens_sql(clean_sql('text', 'training'))}, ' ') AS clean_text,
        {_SENTIMENT_SQL} AS s FROM documents JOIN labels USING (doc_id)),
    sized AS (SELECT *, CAST(len({words_sql('clean_text')}) AS INTEGER) AS text_len FROM l)
    SELECT doc_id, clean_text, text_len, CASE s WHEN -1 THEN 2 ELSE s END AS label,
        CASE WHEN {_below('s/test', 0.1)} THEN 'test' WHEN {_below('s/val', 0.2)} THEN 'val' ELSE 'train' END AS split
    FROM sized WHERE text_len BETWEEN 2 AND 1000""",
)
def rows_for_training(spark, sf):
    rows = training_rows(_labelled(spark, sf), "doc_id", "s")
    return rows.select("doc_id", "clean_text", "text_len", "label", "split")


@query("score_ml")
def score_ml(spark, sf):
    """Every document scored by a small fitted model: no SQL."""
    labelled = training_rows(_labelled(spark, sf), "doc_id", "s").select("clean_text", "label")
    fitted = fit(settle(labelled, "labelled"), PROFILE, estimator=baseline("clean_text", 1 << 12, 5))
    rows = documents(spark, sf).select("doc_id", normalize(F.col("text"), PROFILE).alias("clean_text"))
    scored = with_predictions(fitted.predict(rows, PROFILE))
    return scored.select("doc_id", "class_predictions", "sentiment_labels")


@query("train_eval")
def train_eval(spark, sf):
    """Fits a model: no SQL."""
    _, overall, per_class = train_and_evaluate(training_rows(_labelled(spark, sf), "doc_id", "s"))
    summary = overall.select(F.lit("overall").alias("label"), "precision", "recall", "f1", "loss", "accuracy")
    return per_class.unionByName(summary, allowMissingColumns=True)


_NB_SQL = f"""l AS (SELECT doc_id, {{clean}} AS clean_text, {_SENTIMENT_SQL} AS s FROM documents JOIN labels USING (doc_id)),
    sized AS (SELECT *, CAST(len({words_sql('clean_text')}) AS INTEGER) AS text_len FROM l),
    r AS (SELECT doc_id, clean_text, CASE s WHEN -1 THEN 2 ELSE s END AS y, CASE WHEN {_below('s/test', 0.1)} THEN 'test'
        WHEN {_below('s/val', 0.2)} THEN 'val' ELSE 'train' END AS split FROM sized WHERE text_len BETWEEN 2 AND 1000),
    p AS (SELECT {', '.join(f'ln((count(*) FILTER (y = {i}) + 1.0::DOUBLE) / (count(*) + 3.0::DOUBLE)) AS p{i}' for i in range(3))} FROM r WHERE split = 'train'),
    c AS (SELECT word, {', '.join(f'count(*) FILTER (y = {i}) AS n{i}' for i in range(3))}
        FROM (SELECT y, unnest({words_sql('clean_text')}) AS word FROM r WHERE split = 'train') GROUP BY word),
    w AS (SELECT word, {', '.join(f'ln((n{i} + 1.0::DOUBLE) / ((sum(n{i}) OVER ()) + count(*) OVER ())::DOUBLE) AS z{i}' for i in range(3))} FROM c)""".replace(
    "{clean}", f"array_to_string({tokens_sql(clean_sql('text', 'training'))}, ' ')")


_BITS, _EPOCHS = 10, 3
_K = range(3)


def _epochs_sql(end: str) -> str:
    """Whole-batch descent over hashed words, epoch by epoch; weights, then what ``end`` selects of them."""
    parts = [_NB_SQL.split("p AS (")[0].rstrip().rstrip(","), f"""x AS (SELECT doc_id, split, y, (('0x' || md5(word)[1:8])::BIGINT >> {32 - _BITS})::INTEGER AS f, 1 / sqrt(len(w)) AS v
            FROM (SELECT doc_id, split, y, w, unnest(w) AS word FROM (SELECT doc_id, split, y, {words_sql('clean_text')} AS w FROM r WHERE split <> 'test'))
        UNION ALL SELECT doc_id, split, y, {1 << _BITS}, 1.0 FROM r WHERE split <> 'test'),
    b AS (SELECT doc_id, split, y, f, sum(v) AS v FROM x GROUP BY ALL), size AS (SELECT count(*) AS n FROM r WHERE split = 'train'), w0 AS (SELECT DISTINCT f, 0.0::DOUBLE AS a0, 0.0::DOUBLE AS a1, 0.0::DOUBLE AS a2 FROM b)"""]
    for e in range(_EPOCHS + 1):
        total = ' + '.join(f'exp(z{c} - greatest(z0, z1, z2))' for c in _K)
        parts.append(f"""z{e} AS (SELECT doc_id, split, y, {', '.join(f'sum(v * a{c}) AS z{c}' for c in _K)} FROM b JOIN w{e} USING (f) GROUP BY ALL),
    p{e} AS (SELECT *, {', '.join(f'exp(z{c} - greatest(z0, z1, z2)) / ({total}) AS p{c}' for c in _K)},
        ln({total}) + greatest(z0, z1, z2) - CASE y WHEN 0 THEN z0 WHEN 1 THEN z1 ELSE z2 END AS loss, list_position([z0, z1, z2], greatest(z0, z1, z2)) - 1 = y AS hit FROM z{e}),
    w{e + 1} AS (SELECT f, {', '.join(f'a{c} - {0.9 ** e}::DOUBLE * coalesce(g{c}, 0) AS a{c}' for c in _K)} FROM w{e} LEFT JOIN (
        SELECT f, {', '.join(f'sum(v * (p{c} - CASE b.y WHEN {c} THEN 1 ELSE 0 END)) / (SELECT n FROM size) AS g{c}' for c in _K)}
        FROM b JOIN p{e} USING (doc_id) WHERE b.split = 'train' GROUP BY f) USING (f))""")
    return f"WITH {', '.join(parts)} {end}"


_EPOCH_RUNS_SQL = _epochs_sql(" UNION ALL ".join(f"""SELECT 'plain' AS run, {e} AS epoch, {e}::BIGINT AS steps, round({0.9 ** (e - 1)}::DOUBLE, 6) AS rate,
    (SELECT round(avg(loss), 5) FROM p{e - 1} WHERE split = 'train') AS loss, (SELECT round(avg(loss), 5) FROM p{e} WHERE split = 'val') AS val_loss,
    (SELECT round(avg(CASE WHEN hit THEN 1.0::DOUBLE ELSE 0 END), 5) FROM p{e} WHERE split = 'val') AS val_accuracy""" for e in range(1, _EPOCHS + 1)))


@query("epoch_runs", _EPOCH_RUNS_SQL)
def epoch_runs(spark, sf):
    """Three epochs of one batch each, with a falling rate."""
    rows = training_rows(_labelled(spark, sf), "doc_id", "s").select("doc_id", "clean_text", "label", "split")
    folder = shared_dir(spark, "epochs")
    settings = Settings(epochs=_EPOCHS, batch_rows=1 << 40, rate=1.0, decay_steps=1, optimizer="sgd", bits=_BITS, patience=None)
    trained = fit_epochs(rows, "doc_id", folder, PROFILE, settings, "plain")
    discard_at_exit(spark, folder)
    return trained.history.select("run", "epoch", "steps", F.round("rate", 6).alias("rate"), *[F.round(c, 5).alias(c) for c in ("loss", "val_loss", "val_accuracy")])


@query("epoch_report")
def epoch_report(spark, sf):
    """Two runs by mini-batches, the better one's report: no SQL."""
    folder = shared_dir(spark, "epochs")
    runs = {"slow": Settings(epochs=3, batch_rows=2000, rate=0.002, bits=12), "fast": Settings(epochs=3, batch_rows=2000, rate=0.02, bits=12)}
    _, _, overall, per_class = train_by_epochs(training_rows(_labelled(spark, sf), "doc_id", "s"), "doc_id", folder, runs)
    discard_at_exit(spark, folder)
    summary = overall.select(F.lit("overall").alias("label"), "precision", "recall", "f1", "loss", "accuracy")
    return per_class.unionByName(summary, allowMissingColumns=True)


def _bayes(spark, sf):
    rows = training_rows(_labelled(spark, sf), "doc_id", "s").select("doc_id", "clean_text", "label", "split")
    rows = settle(rows, "bayes-training")
    return rows, fit_bayes(rows.where(F.col("split") == "train"), PROFILE)


@query(
    "score_nb",
    f"""WITH {_NB_SQL}, t AS (SELECT doc_id, unnest({words_sql('clean_text')}) AS word
        FROM (SELECT doc_id, array_to_string({tokens_sql(clean_sql('text', 'training'))}, ' ') AS clean_text FROM documents)),
    s AS (SELECT doc_id, sum(z0) AS z0, sum(z1) AS z1, sum(z2) AS z2 FROM t JOIN w USING (word) GROUP BY doc_id)
    SELECT doc_id, round(p0 + coalesce(z0, 0), 3) AS z0, round(p1 + coalesce(z1, 0), 3) AS z1, round(p2 + coalesce(z2, 0), 3) AS z2
    FROM documents LEFT JOIN s USING (doc_id), p""",
)
def score_nb(spark, sf):
    _, model = _bayes(spark, sf)
    rows = once(documents(spark, sf).select("doc_id", "text"), clean_text=normalize(F.col("text"), PROFILE))
    scored = model.predict(rows, "doc_id")
    return scored.select("doc_id", *[F.round(F.col("logits")[i], 3).alias(f"z{i}") for i in range(3)])


@query(
    "train_nb_eval",
    f"""WITH {_NB_SQL}, t AS (SELECT doc_id, unnest({words_sql('clean_text')}) AS word FROM r WHERE split <> 'train'),
    s AS (SELECT doc_id, sum(z0) AS z0, sum(z1) AS z1, sum(z2) AS z2 FROM t JOIN w USING (word) GROUP BY doc_id),
    z AS (SELECT split, y, [p0 + coalesce(z0, 0), p1 + coalesce(z1, 0), p2 + coalesce(z2, 0)] AS z
        FROM r LEFT JOIN s USING (doc_id), p WHERE split <> 'train')
    SELECT split, count(*) AS n, round(avg(CASE WHEN list_position(z, list_max(z)) - 1 = y THEN 1.0 ELSE 0.0 END), 6)::DOUBLE AS accuracy FROM z GROUP BY split""",
)
def train_nb_eval(spark, sf):
    rows, model = _bayes(spark, sf)
    held = with_predictions(model.predict(rows.where(F.col("split") != "train"), "doc_id"))
    right = (F.col("class_predictions") == F.col("label")).cast("double")
    return held.groupBy("split").agg(F.count("*").alias("n"), F.round(F.avg(right), 6).alias("accuracy"))


_N = range(len(EMOTIONS))
# Documents as JSON lines: some are broken, some lack the label.
_EMOTION_SQL = f"""r AS (SELECT doc_id, {clean_sql('text', 'emotion')} AS clean_text, doc_id % 6 AS y, {_below('2018/test', 0.2)} AS held
        FROM documents WHERE doc_id % 50 NOT IN (7, 8)),
    p AS (SELECT {', '.join(f'ln((count(*) FILTER (y = {i}) + 1.0::DOUBLE) / (count(*) + 6.0::DOUBLE)) AS p{i}' for i in _N)} FROM r WHERE NOT held),
    c AS (SELECT word, {', '.join(f'count(*) FILTER (y = {i}) AS n{i}' for i in _N)}
        FROM (SELECT y, unnest({words_sql('clean_text')}) AS word FROM r WHERE NOT held) GROUP BY word),
    w AS (SELECT word, {', '.join(f'ln((n{i} + 1.0::DOUBLE) / ((sum(n{i}) OVER ()) + count(*) OVER ())::DOUBLE) AS z{i}' for i in _N)} FROM c),
    t AS (SELECT doc_id, unnest({words_sql('clean_text')}) AS word FROM r WHERE held),
    s AS (SELECT doc_id, {', '.join(f'sum(z{i}) AS z{i}' for i in _N)} FROM t JOIN w USING (word) GROUP BY doc_id),
    z AS (SELECT doc_id, y, [{', '.join(f'p{i} + coalesce(z{i}, 0)' for i in _N)}] AS z FROM r LEFT JOIN s USING (doc_id), p WHERE held),
    rows AS (SELECT y, list_position(z, list_max(z)) - 1 AS p FROM z)"""


@query("emotion_job_report", report_sql(_EMOTION_SQL, EMOTIONS))
def emotion_report(spark, sf):
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("label", T.IntegerType())])
    label = (F.col("doc_id") % 6).cast("int").alias("label")
    kind = F.col("doc_id") % 50
    whole = F.to_json(F.struct(F.col("doc_id").alias("id"), "text", label))
    line = F.when(kind == 7, F.concat(F.lit("{broken "), whole)).when(kind == 8, F.to_json(F.struct(F.col("doc_id").alias("id"), "text"))).otherwise(whole)
    path = shared_dir(spark, "emotions")
    documents(spark, sf).select(line.alias("value")).write.text(path)
    discard_at_exit(spark, path)
    good, _ = read_jsonl(spark, path, schema)
    _, _, out = emotion_job(good, "id")
    return out.select("label", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1", "support")])
