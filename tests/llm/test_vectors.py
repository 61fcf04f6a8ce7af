"""Vector search, source audit and whitening on small and awkward input."""

import itertools
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pulse.llm import divergence, topk, vectors, whitening

VECTORS = "vec_id long, embedding array<double>, label int, row long, n int, codes string, length int"
NAN, INF = float("nan"), float("inf")


def table(spark, rows):
    """Vectors with ids, and further columns whose names the operators use inside."""
    return spark.createDataFrame([(i, v, 1, 2, 3, "x", 4) for i, v in rows], VECTORS)


AWKWARD = [
    (0, [1.0, 2.0]), (1, None), (2, [1.0, None]), (3, [NAN, 1.0]), (4, [1.0, -INF]), (None, [1.0, 2.0]), (0, [1.0, 2.0]), (5, [-1.0, 0.5]),
    (6, []), (7, []), (8, [1.0, 2.0, 3.0]), (9, [0.0, 1.0, 0.0]), (20, [3e300, -3e300]), (40, [0.015625, 0.0]),
]


# --- codes


def test_codes_are_exact_and_narrow():
    made = {m.shape[1]: (rows.tolist(), m.tolist()) for rows, m in vectors.codes(pa.array([v for _, v in AWKWARD], pa.list_(pa.float64())), 64)}
    assert made[2] == ([0, 5, 6, 7, 12, 13], [[64, 128], [64, 128], [64, 128], [-64, 32], [2**53, -(2**53)], [1, 0]])
    assert made[0][0] == [8, 9] and made[3] == ([10, 11], [[64, 128, 192], [0, 64, 0]])
    assert [vectors.width(np.array([x])) for x in (0, 127, -128, 128, 32767, 1 << 15, 1 << 31, 1 << 53)] == [1, 1, 2, 2, 2, 4, 8, 8]


# --- top k


def plain_top(rows, asked, k):
    fine = [(r, i, [max(-(2.0**53), min(2.0**53, np.floor(64 * x))) for x in v]) for r, (i, v) in enumerate(rows)
            if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for r, i, v in fine:
        if asked(i):
            found = sorted((-min(2**63 - 1, max(1 - 2**63, sum(int(x) * int(y) for x, y in zip(v, w)))), j is None, j or 0)
                           for s, j, w in fine if s != r and len(w) == len(v))
            out += [(i, rank + 1, None if none else j, -minus) for rank, (minus, none, j) in enumerate(found[:k])]
    return sorted(out, key=str)


def searched(spark, rows, k=20, every=1):
    got = topk.search(table(spark, rows), "vec_id", "embedding", F.col("vec_id") % every == 0, k)
    return sorted((tuple(r) for r in got.select("query_id", "rank", "vec_id", "score").collect()), key=str)


def test_search_of_awkward_vectors(spark):
    for k in (1, 3, 20):
        assert searched(spark, AWKWARD, k) == plain_top(AWKWARD, lambda i: i is not None, k)
    assert searched(spark, []) == [] and searched(spark, [(1, None)]) == [] and searched(spark, [(0, [1.0])]) == []
    with pytest.raises(ValueError):
        searched(spark, AWKWARD, 0)


@pytest.mark.parametrize("kind", ["small", "wide", "hot"])
def test_search_over_many_tiles_shards_and_groups(spark, monkeypatch, kind):
    rng = random.Random(kind)
    size = {"small": 4.0, "wide": 3e6, "hot": 1.0}[kind]
    rows = [(rng.randrange(900), [rng.uniform(-size, size) for _ in range(5)]) for _ in range(700)]
    if kind == "hot":  # half of the rows are one vector, and scores tie everywhere
        rows = [(i, [0.5] * 5 if rng.random() < 0.5 else [round(x) / 64 for x in v]) for i, v in rows]
    for name, value in (("BLOCK", 16), ("GROUP_CELLS", 150), ("SHARD", 50), ("LEAST_SHARD", 20), ("TILE", (8, 40)), ("FAN", 3)):
        monkeypatch.setattr(topk, name, value)
    assert searched(spark, rows, 7, 5) == plain_top(rows, lambda i: i % 5 == 0, 7)


def test_products_stay_exact_in_every_number_type():
    rng = np.random.default_rng(1)
    for top in (10, 10**6, 10**8, 2**53):
        codes = rng.integers(-top, top, (30, 6), endpoint=True)
        codes[0] = top
        ids, none = np.arange(30), np.zeros(30, bool)
        lists = topk._Lists(4, ids, none, np.arange(30), codes, top)
        lists.meet(ids, none, np.arange(30), codes, top)
        for q in range(30):
            exact = sorted((-max(1 - 2**63, min(2**63 - 1, sum(int(a) * int(b) for a, b in zip(codes[q], codes[c])))), c) for c in range(30) if c != q)
            assert list(zip((-lists.score[q]).tolist(), lists.their[q].tolist())) == exact[:4]


def test_lists_stay_small_where_all_scores_tie(spark, monkeypatch):
    monkeypatch.setattr(topk, "LEAST_SHARD", 100)
    rows = [(i, [0.25, 0.25]) for i in range(1000)]
    got = searched(spark, rows, 20, 500)
    assert got == plain_top(rows, lambda i: i % 500 == 0, 20)


# --- divergence


def plain_audit(rows, least=3, unit=10**9):
    docs = [(lang or "", source or "", [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")])
            for text, lang, source in rows]
    out = []
    for lang in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == lang]
        among = Counter(t for d in own for t in set(d[2]))
        kept = [t for t in among if among[t] >= least]
        def shares(ds):
            c = Counter(t for d in ds for t in d[2])
            total = sum(c[t] for t in kept)
            return {t: (c[t], 1 + unit * (c[t] + 1) // (total + len(kept))) for t in kept}
        groups, whole = {s: shares([d for d in own if d[1] == s]) for s in {d[1] for d in own}}, shares(own)
        f = lambda p, q: (p - q) ** 2 // q
        for s, p in groups.items():
            pairs = [(-sum(f(p[t][1], groups[o][t][1]) for t in kept), o.encode(), o) for o in groups if o != s]
            terms = [(-f(p[t][1], whole[t][1]), t.encode(), t) for t in kept if p[t][0] > 0 and p[t][1] > whole[t][1]]
            out += [(lang, s, "pair", o, -v, r + 1) for r, (v, _, o) in enumerate(sorted(pairs))]
            out += [(lang, s, "term", t, -v, r + 1) for r, (v, _, t) in enumerate(sorted(terms)[:200])]
    return sorted(out)


def audited(spark, rows):
    wide = [(*r, 1, 2, "x", 3) for r in rows]
    df = spark.createDataFrame(wide, "text string, lang string, source string, n long, docs long, term string, id long")
    return sorted(tuple(r) for r in divergence.audit(df).select("lang", "source", "part", "item", "value", "rank").collect())


def corpus(seed, n=300, sources=12, words=60):
    rng = random.Random(seed)
    return [(" ".join(f"W{chr(97 + rng.randrange(26))}{chr(97 + int(rng.paretovariate(1)) % words % 26)}é" for _ in range(rng.randrange(30))),
             rng.choice(["en", "de"]), f"s{int(rng.paretovariate(0.7)) % sources}") for _ in range(n)]


def test_audit_by_brute_force(spark, monkeypatch):
    odd = [(None, None, None), ("", "en", "s1"), ("One, two; ONE two", None, ""), ("one", "", None), ("one two", "", "b"), ("12 34", "xx", "a"), ("", "xx", "b"), (None, "xx", "c"),
           ("x" * 3000 + " one " + "é" * 3000, "", "b"), ("日本 \U0001f600 one", "", "c")]
    rows = corpus(1) + odd + odd
    want = plain_audit(rows)
    assert audited(spark, rows) == want
    for name, value in (("SEGMENT", 7), ("HANDFUL", 2), ("HELD", 40), ("PIECE", 20)):
        monkeypatch.setattr(divergence, name, value)
    assert audited(spark, rows) == want


def test_audit_of_nothing_and_of_one_source(spark):
    assert audited(spark, []) == []
    assert audited(spark, [("a b", "en", "s")] * 3) == []  # no other source, and no term above the language's share


def test_ranked_terms_are_cut(spark):
    # every word is a term of its own, and each source has more than are ranked
    words = ["".join(x) for x in itertools.product("abcdefg", repeat=3)]
    rows = [(" ".join(words[:300]), "en", "s")] * 3 + [(" ".join(words[40:]), "en", "t")] * 4
    got = audited(spark, rows)
    assert got == plain_audit(rows)


def test_galloping_finds_what_both_hold():
    rng = np.random.default_rng(0)
    for n, m, top in ((0, 5, 9), (1, 1, 2), (3, 5000, 9000), (5000, 4000, 6000), (700, 700, 700), (2000, 90_000, 10**6)):
        a, b = (np.sort(rng.choice(top, min(x, top), replace=False)).astype(np.int64) for x in (n, m))
        at_a, at_b = divergence.common(a, b)
        assert a[at_a].tolist() == b[at_b].tolist() == np.intersect1d(a, b).tolist()


def test_shares_hold_for_counts_of_a_large_corpus():
    for n, total, terms in ((0, 0, 1), (10**13, 3 * 10**13, 10**9), (9 * 10**14, 9 * 10**14, 10**9), (5, 7, 3)):
        assert int(divergence.share(n, total, terms)) == 1 + 10**9 * (n + 1) // (total + terms)


# --- whitening


def whitened(spark, rows, **kw):
    return whitening.whiten(table(spark, rows), "vec_id", "embedding", **kw).collect()


def test_whitening_of_awkward_vectors(spark):
    rows = whitened(spark, AWKWARD)
    # of length two the far vector leaves the second direction below the precision; of three there are two vectors; empty ones have none
    assert Counter(r.vec_id for r in rows) == {0: 2, None: 1, 5: 1, 20: 1, 40: 1, 8: 1, 9: 1}
    assert {r.n for r in rows if r.vec_id in (8, 9)} == {2} and {r.n for r in rows if r.vec_id == 0} == {4}
    assert all(r.deviation is None for r in rows if r.vec_id == 20)
    assert {r.deviation for r in rows if r.vec_id in (8, 9)} == {64**2 + 64**2 + 192**2}
    assert whitened(spark, []) == [] and whitened(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])]) == [] and whitened(spark, [(1, None)]) == []


def test_offset_costs_no_digits(spark):
    rng = np.random.default_rng(3)
    x = rng.integers(-40, 40, (300, 6)) * np.array([9, 7, 5, 3, 2, 1]) / 64
    near = {(r.vec_id, r.component): r for r in whitened(spark, list(enumerate(x.tolist())))}
    far = {(r.vec_id, r.component): r for r in whitened(spark, list(enumerate((x + 2.0**40).tolist())))}
    assert set(near) == set(far) and len(near) == 1800
    for key, r in near.items():
        assert abs(abs(r.whitened) - abs(far[key].whitened)) < 1e-9 and abs(r.explained - far[key].explained) < 1e-12 and far[key].identity_error < 1e-9


def test_copies_count_once(spark):
    rng = np.random.default_rng(4)
    x = rng.integers(-64, 64, (100, 4)) / 64
    once = {(r.vec_id, r.component): abs(r.whitened) for r in whitened(spark, list(enumerate(x.tolist())))}
    more = whitened(spark, list(enumerate(x.tolist())) + [(0, x[0].tolist())] * 500)
    assert len(more) == 600 * 4 and {r.n for r in more} == {100}
    assert all(abs(abs(r.whitened) - once[r.vec_id, r.component]) < 1e-9 for r in more)


@pytest.mark.parametrize("size,wanted,spectrum", [
    (300, 16, "flat"), (300, 16, "steep"), (200, 5, "pairs"), (64, 16, "flat"), (20, 16, "steep"), (3, 16, "flat"), (150, 8, "low"), (90, 4, "none"),
])
def test_jacobi_davidson_against_a_full_solver(size, wanted, spectrum):
    rng = np.random.default_rng(size)
    values = {"flat": 1 + np.linspace(0, 0.5, size), "steep": 10.0 ** -np.linspace(0, 9, size), "pairs": np.repeat(np.arange(size / 2) + 1.0, 2)[:size],
              "low": np.where(np.arange(size) < 5, np.arange(size) + 1.0, 0), "none": np.zeros(size)}[spectrum]
    turn = np.linalg.qr(rng.standard_normal((size, size)))[0]
    matrix = (turn * values) @ turn.T
    matrix = (matrix + matrix.T) / 2
    products = []

    def product(block):
        products.append(block.shape[1])
        return matrix @ block

    found, directions = whitening.jacobi_davidson(product, size, wanted)
    k = min(size, wanted)
    want = np.sort(values)[::-1][:k]
    top = max(want[0], 1e-300)
    assert np.abs(found - want).max() <= 1e-12 * top
    assert np.linalg.norm(matrix @ directions - directions * found, axis=0).max() <= 1e-13 * top + 1e-300
    assert np.abs(directions.T @ directions - np.eye(k)).max() < 1e-12
    assert len(products) < 300


def test_minres_solves_what_a_direct_solver_does():
    rng = np.random.default_rng(9)
    a = rng.standard_normal((12, 12))
    a = a + a.T
    b = rng.standard_normal((12, 3))
    assert np.abs(whitening.minres(lambda v: a @ v, b, 14) - np.linalg.solve(a, b)).max() < 1e-6
