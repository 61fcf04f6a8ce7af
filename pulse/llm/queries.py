"""The operators of this package over the given tables, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import discard_at_exit
from . import decontaminate, divergence, linededup, minhash, packing, pii, quality, sharding, substrings, topk, toxicity, warc, whitening
from .arrow import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return add


@query("op1_line_dedup", f"""
    WITH d AS (SELECT row_number() OVER () AS row, * FROM documents),
    l AS (SELECT row, source, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM d),
    hosts AS (SELECT source, count(*) AS pages FROM d GROUP BY source),
    often AS (SELECT l.source, trim(line) AS line FROM l JOIN hosts ON l.source IS NOT DISTINCT FROM hosts.source WHERE trim(line) <> ''
        GROUP BY l.source, trim(line) HAVING count(DISTINCT row) >= {linededup.LEAST_PAGES} AND count(DISTINCT row) > max(pages) * CAST({linededup.RATIO} AS DOUBLE)),
    marked AS (SELECT l.row, l.pos, l.line, often.line IS NOT NULL AS goes FROM l LEFT JOIN often ON l.source IS NOT DISTINCT FROM often.source AND trim(l.line) = often.line),
    whole AS (SELECT row, count(*) AS n, count(*) FILTER (goes) AS g, count(*) FILTER (NOT goes AND trim(line) <> '') AS f,
        string_agg(line, chr(10) ORDER BY pos) FILTER (NOT goes) AS cut FROM marked GROUP BY row)
    SELECT doc_id, source, coalesce(n, 0) AS n_lines, CASE WHEN f > 0 THEN g ELSE 0 END AS n_dropped, CASE WHEN f > 0 THEN cut ELSE text END AS text
    FROM d LEFT JOIN whole ON d.row = whole.row""")
def op1_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Documents without the lines that over a tenth of their source's documents share."""
    done = linededup.drop_lines(table(spark, sf, "documents"), F.col("source"))
    return done.select("page.doc_id", "page.source", "n_lines", "n_dropped", "text")


@query("op3_toxicity")
def op3_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    """Expected severity of every document, learned from the labelled ones."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf, "labels"))
    return toxicity.score(docs, model, keep=["doc_id"])


@query("op6_minhash")
def op6_minhash(spark: SparkSession, sf: str) -> DataFrame:
    """Near-duplicate documents over three words at a similarity of 0.85."""
    return minhash.near_duplicates(table(spark, sf, "documents"), length=3, percent=85)


_WORDS = "regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"


@query("op9_decontaminate", f"""
    WITH d AS (SELECT doc_id, coalesce({_WORDS}, []) AS w FROM documents),
    b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS w FROM benchmark WHERE text IS NOT NULL AND item_id IS NOT NULL),
    i AS (SELECT DISTINCT item, k, array_to_string(list_slice(w, p, p + k - 1), ' ') AS win
        FROM (SELECT item, w, least({decontaminate.LENGTH}, len(w)) AS k, unnest(range(1, len(w) - least({decontaminate.LENGTH}, len(w)) + 2)) AS p FROM b WHERE len(w) > 0)),
    t AS (SELECT doc_id, k, p, array_to_string(list_slice(w, p, p + k - 1), ' ') AS win
        FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS p FROM d, (SELECT DISTINCT k FROM i) WHERE len(w) >= k)),
    m AS (SELECT t.doc_id, t.p, t.k, i.item FROM t JOIN i ON t.k = i.k AND t.win = i.win),
    c AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + k)) AS q FROM m) GROUP BY doc_id),
    n AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM m) GROUP BY doc_id)
    SELECT d.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
        sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
    FROM d LEFT JOIN c USING (doc_id) LEFT JOIN n USING (doc_id)""")
def op9_decontaminate(spark: SparkSession, sf: str) -> DataFrame:
    """Documents that hold ten consecutive words of a benchmark item."""
    return decontaminate.contamination(table(spark, sf, "documents"), table(spark, sf, "benchmark")).drop("spans")


def vocabulary() -> tuple[str, int]:
    """File of the public vocabulary that sequences are packed with, and the id that ends a document."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json"), 2


@query("op8_packing")
def op8_packing(spark: SparkSession, sf: str) -> DataFrame:
    """Documents in sequences of 4096 ids."""
    return packing.pack(table(spark, sf, "documents"), *vocabulary())


_RUNS = "coalesce(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+'), [])"


@query("op7_substring_dedup", f"""
    WITH d AS (SELECT doc_id, {_RUNS} AS w FROM documents),
    t AS (SELECT doc_id, p, array_to_string(list_slice(w, p, p + {substrings.LENGTH} - 1), ' ') AS win
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - {substrings.LENGTH} + 2)) AS p FROM d WHERE len(w) >= {substrings.LENGTH})),
    f AS (SELECT doc_id, p FROM (SELECT doc_id, p, row_number() OVER (PARTITION BY win ORDER BY doc_id, p) AS r FROM t) WHERE r > 1),
    c AS (SELECT DISTINCT doc_id, unnest(range(p, p + {substrings.LENGTH})) AS q FROM f),
    x AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS q FROM d),
    k AS (SELECT x.doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY x.q) AS kept FROM x LEFT JOIN c ON x.doc_id = c.doc_id AND x.q = c.q WHERE c.q IS NULL GROUP BY x.doc_id)
    SELECT d.doc_id, len(w) AS n_words, len(w) - coalesce(k.n, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
    FROM d LEFT JOIN k USING (doc_id)""")
def op7_substring_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Documents without the words of passages of twenty words that start earlier."""
    done = substrings.remove_repeats(table(spark, sf, "documents"))
    return done.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


@query("op4_sharding")
def op4_sharding(spark: SparkSession, sf: str) -> DataFrame:
    """Documents in forty shards of nearly equal bytes."""
    return sharding.shard(table(spark, sf, "documents"), 40)


@query("op5_warc")
def op5_warc(spark: SparkSession, sf: str) -> DataFrame:
    """Pages written to packaged archives and read back from them."""
    pages = table(spark, sf, "pages")
    folder = warc.fresh_folder(pages)
    archives = warc.write_archives(pages, folder)
    if not archives.isEmpty():
        discard_at_exit(spark, folder)
    return warc.read_archives(archives).drop("url")


@query("op2_quality_rules")
def op2_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    """Documents kept by rules whose reliability is estimated from their votes."""
    return quality.judged(table(spark, sf, "documents"))


@query("op10_pii")
def op10_pii(spark: SparkSession, sf: str) -> DataFrame:
    """Personal data in documents: the fixed patterns and what the tagger adds."""
    docs = table(spark, sf, "documents")
    return pii.find(docs, pii.fit(docs))


@query("op11_topk", """
    WITH v AS (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda c: floor(64 * CAST(c AS DOUBLE))) AS x FROM embeddings
        WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
    s AS (SELECT q.r, q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.x, c.x) AS BIGINT) AS score
        FROM v q JOIN v c ON q.r <> c.r WHERE q.vec_id % 20 = 0),
    o AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s)
    SELECT query_id, rank, vec_id, score FROM o WHERE rank <= 20""")
def op11_topk(spark: SparkSession, sf: str) -> DataFrame:
    """The twenty best inner products of every twentieth vector with all others."""
    return topk.search(table(spark, sf, "embeddings"), "vec_id", "embedding", F.col("vec_id") % 20 == 0, k=20)


_TERMS = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"
_SHARE = "1 + (CAST(1000000000 AS HUGEINT) * ({n} + 1)) // ({total} + {terms})"


@query("op12_divergence", f"""
    WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, {_TERMS} AS w FROM documents),
    e AS (SELECT r, lang, source, unnest(w) AS term FROM d),
    k AS (SELECT lang, term, count(*) AS n FROM e GROUP BY lang, term HAVING count(DISTINCT r) >= {divergence.LEAST_DOCUMENTS}),
    v AS (SELECT lang, count(*) AS terms, sum(n) AS total FROM k GROUP BY lang),
    g AS (SELECT DISTINCT lang, source FROM d),
    c AS (SELECT e.lang, e.source, e.term, count(*) AS n FROM e JOIN k ON e.lang = k.lang AND e.term = k.term GROUP BY e.lang, e.source, e.term),
    t AS (SELECT g.lang, g.source, coalesce(sum(c.n), 0) AS total FROM g LEFT JOIN c ON g.lang = c.lang AND g.source = c.source GROUP BY g.lang, g.source),
    p AS (SELECT t.lang, t.source, k.term, coalesce(c.n, 0) AS n, {_SHARE.format(n="coalesce(c.n, 0)", total="t.total", terms="v.terms")} AS p,
            {_SHARE.format(n="k.n", total="v.total", terms="v.terms")} AS q
        FROM t JOIN k ON t.lang = k.lang JOIN v ON t.lang = v.lang LEFT JOIN c ON c.lang = t.lang AND c.source = t.source AND c.term = k.term),
    f AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
        FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY a.lang, a.source, b.source),
    u AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(f.value, 0) AS BIGINT) AS value
        FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
        UNION ALL SELECT lang, source, 'term', term, CAST((p - q) * (p - q) // q AS BIGINT) FROM p WHERE n > 0 AND p > q),
    o AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM u)
    SELECT lang, source, part, item, value, rank FROM o WHERE part = 'pair' OR rank <= {divergence.TERMS}""")
def op12_divergence(spark: SparkSession, sf: str) -> DataFrame:
    """How far every source is from the others of its language, and the terms that set it apart."""
    return divergence.audit(table(spark, sf, "documents"))


@query("op13_whitening")
def op13_whitening(spark: SparkSession, sf: str) -> DataFrame:
    """Embeddings along their sixteen widest directions, each of unit variance."""
    return whitening.whiten(table(spark, sf, "embeddings"), "vec_id", "embedding")
