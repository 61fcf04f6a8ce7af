"""Every text preparation query over whole tables: against its SQL, or against brute force."""

import base64
import collections
import hashlib
import os
import re
import zlib

import numpy as np
import pytest

import checking
from pulse.llm.queries import ORACLES, QUERIES, vocabulary

FOLDER = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return checking.connect(FOLDER)


@pytest.fixture(scope="module")
def docs(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows_as_sql(spark, con, name):
    assert checking.difference(QUERIES[name](spark, FOLDER), con, ORACLES[name]) is None


def split(text):
    return [w for w in re.split("[\x20\x09-\x0d]+", text or "") if w]


def low(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def test_every_operator_has_one_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_quality_counts(spark, docs):
    rows = QUERIES["op2_quality_rules"](spark, FOLDER).collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    for r in rows:
        text, w = docs[r.doc_id], split(docs[r.doc_id])
        seen = collections.Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
        covered = {i + k for i in range(len(w) - 7) if seen[tuple(w[i:i + 8])] > 1 for k in range(8)}
        lines = [x for x in text.split("\n") if split(x)]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (
            len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))
        assert r.base_failed == (len(w) < 20 or 100 * len(covered) > 30 * len(w))
        assert not (r.base_failed and r.kept)


def test_quality_is_what_plain_estimation_gives(spark):
    """Document by document, in matrices, from the query's own votes; the clamp decides no document."""
    from pulse.llm import quality

    rows = [r for r in QUERIES["op2_quality_rules"](spark, FOLDER).collect() if not r.base_failed]
    names = [f"vote_{i}" for i in range(len(quality.RULES))]
    votes = np.array([[r[n] for n in names] for r in rows])
    for clamp in (True, False):
        good, share = np.where((votes < 0).any(axis=1), 0.1, 0.9), None
        for _ in range(quality.STEPS):
            before, share = share, (good.sum() + 1) / (len(good) + 2)
            total = np.full(len(good), np.log(share) - np.log1p(-share))
            for j in range(votes.shape[1]):
                for v in (-1, 0, 1):
                    cast = votes[:, j] == v
                    ratio = np.log((good[cast].sum() + 1) / (good.sum() + 3)) - np.log(((1 - good)[cast].sum() + 1) / ((1 - good).sum() + 3))
                    total[cast] += max(ratio, 0) if clamp and v == 1 else min(ratio, 0) if clamp and v == -1 else ratio
            good = 1 / (1 + np.exp(-total))
            if before is not None and abs(share - before) < quality.CLOSE:
                break
        if clamp:
            assert np.allclose(good, [r.quality for r in rows], atol=1e-9)
        assert [bool(x >= quality.LIMIT) for x in good] == [r.kept for r in rows]


def test_a_tie_is_kept(spark):
    from pulse.llm import quality

    df = spark.createDataFrame([(1, -1, 5)], "a int, b int, n long")
    odds, ratios = quality.fit({(1, -1): 5})
    assert len(ratios) == 2 and np.isfinite(odds)
    even = df.select(quality._posterior(["a"], 0.0, [{-1: -1.0, 0: 0.0, 1: 0.0}]).alias("p")).first().p
    assert even == quality.LIMIT and even >= quality.LIMIT


def test_quality_agrees_with_labels(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    rows = [r for r in QUERIES["op2_quality_rules"](spark, "/root/testdata/sf0.01").collect() if r.doc_id in labels and not r.base_failed]
    good, bad = ([r.kept for r in rows if labels[r.doc_id] == q] for q in (1, 0))
    assert np.mean(good) > 0.99 and np.mean(bad) < 0.2


def test_toxicity_on_labels_it_has_not_seen(spark):
    from pyspark.sql import functions as F
    from pulse.llm import toxicity

    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    held = F.pmod(F.xxhash64("doc_id"), F.lit(4)) == 0
    model = toxicity.fit(docs, labels.where(~held))
    rows = toxicity.score(docs, model, keep=["doc_id"]).withColumnRenamed("toxic", "found").join(labels.where(held), "doc_id").collect()
    toxic, clean = ([r.found for r in rows if r.toxic == t] for t in (1, 0))
    assert np.mean(toxic) > 0.85 and np.mean(clean) < 0.005
    assert {r.grade for r in rows} == {0, 1, 2}


def test_shards_are_even_and_gapless(spark, docs):
    rows = QUERIES["op4_sharding"](spark, FOLDER).collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    by, slots = collections.Counter(), collections.defaultdict(list)
    for r in rows:
        assert (r.size, r.text_crc32) == (len(docs[r.doc_id].encode()) + 16, zlib.crc32(docs[r.doc_id].encode()))
        by[r.shard] += r.size
        slots[r.shard].append(r.slot)
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())
    mean, most = sum(by.values()) / 40, max(r.size for r in rows)
    assert all(abs(by[s] - mean) <= most + 1 for s in range(40))


def test_archives_round_trip(spark):
    pages = spark.read.parquet(f"{FOLDER}/pages.parquet").collect()
    rows = {r.page_id: r for r in QUERIES["op5_warc"](spark, FOLDER).collect()}
    last = {}
    for p in pages:
        last[p.html] = max(p.page_id, last.get(p.html, -1))
    assert len(rows) == len(pages)
    for p in pages:
        r, first = rows[p.page_id], last[p.html]
        assert (r.payload_bytes, r.payload_digest) == (len(p.html.encode()), base64.b32encode(hashlib.sha1(p.html.encode()).digest()).decode())
        assert (r.record_type, r.refers_to) == (("response", None) if first == p.page_id else ("revisit", first))


def test_near_duplicates_by_brute_force(spark, docs):
    sets = {}
    for i, text in docs.items():
        w = split(low(text))
        sets[i] = {tuple(w[k:k + 3]) for k in range(len(w) - 2)} if len(w) >= 3 else {tuple(w)} if w else set()
    up = {i: i for i in docs}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                up[max(x, y)] = min(x, y)
    rows = QUERIES["op6_minhash"](spark, FOLDER).collect()
    assert {(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in rows} == {(i, len(s), root(i), root(i) == i) for i, s in sets.items()}


def test_packing_covers_every_id_once(spark, docs):
    from tokenizers import Tokenizer

    path, end = vocabulary()
    tok = Tokenizer.from_file(path)
    ids = {i: np.array(tok.encode(t, add_special_tokens=False).ids + [end], "<u4") for i, t in docs.items()}
    rows = QUERIES["op8_packing"](spark, FOLDER).collect()
    by_doc, by_sequence = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        own = ids[r.doc_id]
        assert r.doc_tokens == len(own) and r.ids_crc32 == zlib.crc32(own[r.start:r.start + r.length].tobytes())
        by_doc[r.doc_id].append((r.start, r.length))
        by_sequence[r.sequence_id].append((r.offset, r.length))
    for parts, size in [(by_doc[i], len(x)) for i, x in ids.items()] + [(x, None) for x in by_sequence.values()]:
        at = 0
        for start, length in sorted(parts):
            assert start == at and length > 0
            at += length
        assert at == size if size is not None else at <= 4096
    assert sum(r.length for r in rows) > 0.95 * 4096 * (len(by_sequence) - 1)


def luhn(digits):
    doubled = [int(c) * (2 if i % 2 else 1) for i, c in enumerate(digits[::-1])]
    return sum(x // 10 + x % 10 for x in doubled) % 10 == 0


def plain_spans(text):
    """The patterns as they are stated."""
    count = lambda s: len(re.sub("[^0-9]", "", s))
    rules = {
        "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
        "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(p) <= 255 for p in s.split("."))),
        "card": (r"[0-9]([\x20-]?[0-9])+", lambda s: 16 <= count(s) <= 19 and luhn(re.sub("[^0-9]", "", s))),
        "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 8 <= count(s) <= 15),
    }
    return {k: [m.span() for m in re.finditer(p, text or "") if good(m[0])] for k, (p, good) in rules.items()}


def test_base_patterns_of_personal_data(spark, docs):
    some = collections.Counter()
    for r in QUERIES["op10_pii"](spark, FOLDER).collect():
        own = plain_spans(docs[r.doc_id])
        text = ",".join(f"{k}:{a}:{b}" for k in own for a, b in own[k])
        assert r.base_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [len(own[k]) for k in own]
        assert set(filter(None, text.split(","))) <= set(r.spans.split(","))
        some.update({k: len(v) for k, v in own.items()})
    assert all(some[k] > 0 for k in ("email", "ip", "card", "phone"))


def test_the_tagger_on_documents_it_has_not_seen(spark):
    """Alone against the patterns' spans, and against rewritten spans that the patterns miss; clean documents stay without spans."""
    from pyspark.sql import functions as F
    from pulse.llm import pii

    table = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text")
    held = F.pmod(F.xxhash64("doc_id"), F.lit(4)) == 0
    tagger = pii.fit(table.where(~held))
    unseen = [r.text for r in table.where(held & F.col("text").rlike("[0-9@]")).collect()]
    rng = np.random.default_rng(5)
    rewritten, marks = [], []
    for text in unseen:
        out, at, own, size = [], 0, [], 0
        for a, b, k in sorted((a, b, k) for k, kind in enumerate(pii.KINDS) for a, b in plain_spans(text)[kind]):
            if a >= at:
                value = pii._rewritten(text[a:b], k, rng)
                out += [text[at:a], value]
                size += a - at
                own.append((pii.KINDS[k], size, size + len(value)))
                size, at = size + len(value), b
        rewritten.append("".join([*out, text[at:]]))
        marks.append(own)
    alone = found = planted = caught = clean = wrong = 0
    no_patterns = lambda text: {k: [] for k in pii.KINDS}
    for text, changed, own in zip(unseen, rewritten, marks):
        base = {(k, a, b) for k, spans in plain_spans(text).items() for a, b in spans}
        got = set(pii.spans_of(text, tagger, no_patterns))
        alone, found = alone + len(base), found + len(base & got)
        clean += not base
        wrong += bool({x for x in got - base if not any(x[1] < e and s < x[2] for _, s, e in base)})
        seen = {(k, a, b) for k, spans in plain_spans(changed).items() for a, b in spans}
        hidden = {m for m in own if not any(m[1] < e and s < m[2] for _, s, e in seen)}
        planted, caught = planted + len(hidden), caught + len(hidden & set(pii.spans_of(changed, tagger)))
    assert alone > 100 and found / alone > 0.9
    assert planted > 50 and caught / planted > 0.85
    assert wrong <= 0.02 * len(unseen)
    # over a whole table that holds them, through the query's operator
    some = spark.createDataFrame([(i, t) for i, t in enumerate(rewritten)], "doc_id long, text string")
    rows = pii.find(some, tagger).collect()
    assert sum(r.n_added for r in rows) >= caught and len(rows) == len(rewritten)
    assert all(r.spans == ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(pii.spans_of(rewritten[r.doc_id], tagger), key=lambda x: (pii.KINDS.index(x[0]), x[1]))) for r in rows)


def test_whitening_by_brute_force(spark):
    table = spark.read.parquet(f"{FOLDER}/embeddings.parquet").collect()
    codes = {r.vec_id: [int(np.floor(64 * float(c))) + 1_000_000 for c in r.embedding] for r in table}
    fit = np.array(sorted({tuple(x) for x in codes.values()}), dtype=object)
    n, sums = len(fit), fit.sum(axis=0)
    centred = np.array([[float(n * v - s) / n for v, s in zip(x, sums)] for x in fit])
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    rows = {(r.vec_id, r.component): r for r in QUERIES["op13_whitening"](spark, FOLDER).collect()}
    assert set(rows) == {(i, k) for i in codes for k in range(1, 17)}
    for k in range(16):
        own = [float(n * v - s) / n for v, s in zip(codes[0], sums)] @ vectors[:, k]
        sign = np.sign(own) * np.sign(rows[0, k + 1].whitened)
        for i, x in codes.items():
            r = rows[i, k + 1]
            want = np.array([float(n * v - s) / n for v, s in zip(x, sums)]) @ vectors[:, k] / np.sqrt(values[k])
            assert abs(sign * r.whitened - want) < 1e-9
            assert r.deviation == sum((n * v - s) ** 2 for v, s in zip(x, sums)) and r.n == n
            assert abs(r.explained - values[k] / values.sum()) < 1e-12 and r.identity_error < 1e-12
