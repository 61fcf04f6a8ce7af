"""The operators on small and awkward input: nulls, empty and long texts, ties, repeats, no rows, clashing columns."""

import io
import math
import random
import re
import zipfile

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulse.llm import components, decontaminate, linededup, minhash, packing, pii, quality, sharding, substrings, tagger, toxicity, warc
from pulse.llm.queries import vocabulary

DOCS = "doc_id long, text string, lang string, source string, n_chars long, n_words long, kept boolean, range long, h string"


def frame(spark, texts, source="s"):
    """Documents with ids from 0 (or given), and further columns whose names the operators use inside."""
    rows = [(x if isinstance(x, tuple) else (i, x)) for i, x in enumerate(texts)]
    return spark.createDataFrame([(i, t, "en", source, None, -1, None, 7, "x") for i, t in rows], DOCS)


def prose(n, seed, words=300):
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(words)}" for _ in range(n))


AWKWARD = [None, "", " \n\t ", "one", "two words", prose(30, 1), prose(30, 1), (5, prose(30, 1)), (None, "no id"), (None, prose(30, 1)), prose(30000, 2), "x" * 5000, "é ü 日本 \U0001f600"]


@pytest.fixture(scope="module")
def awkward(spark):
    return frame(spark, AWKWARD).cache()


OPERATORS = {
    "lines": lambda d: linededup.drop_lines(d, F.col("source")),
    "quality": quality.judged,
    "shards": lambda d: sharding.shard(d, 7),
    "near": lambda d: minhash.near_duplicates(d),
    "keep_one": minhash.keep_one,
    "repeats": substrings.remove_repeats,
    "pack": lambda d: packing.pack(d, *vocabulary()),
    "passages": lambda d: decontaminate.contamination(d, d.select(F.col("doc_id").alias("item_id"), "text").where("doc_id = 4")),
    "unseen": lambda d: decontaminate.keep_unseen(d, d.select(F.col("doc_id").alias("item_id"), "text").where("doc_id = 4")),
    "private": lambda d: pii.find(d, pii.fit(d)),
    "toxic": lambda d: toxicity.score(d, toxicity.fit(d, d.select("doc_id", F.lit(0).alias("toxic")))),
    "warc": lambda d: warc.read_archives(warc.write_archives(d, warc.fresh_folder(d), key="doc_id", url="source", payload="text")),
}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_awkward_rows_and_no_rows(spark, awkward, name):
    rows = OPERATORS[name](awkward).collect()
    if name not in ("pack", "unseen", "keep_one"):
        assert len(rows) == len(AWKWARD)
    assert OPERATORS[name](awkward.where("false")).collect() == []


# --- lines


def test_boilerplate_goes_by_site(spark):
    own = [f"only {i}" for i in range(10)]
    df = frame(spark, [f"menu\n{x}\n\nmenu " for x in own]).union(frame(spark, [f"menu\n{x}" for x in own[:3]], "other"))
    got = linededup.drop_lines(df, F.col("source"), ratio=0.5, least=5).select("page.source", "text", "n_lines", "n_dropped").collect()
    assert sorted(r.text for r in got if r.source == "s") == sorted(f"{x}\n" for x in own)
    assert all(r.n_dropped == 0 for r in got if r.source == "other")  # too few pages


def test_repeated_pages_are_not_emptied(spark):
    df = frame(spark, ["same\npage"] * 8 + ["same\nown"] * 2)
    got = linededup.drop_lines(df, F.col("source"), ratio=0.5, least=5).select("text").collect()
    assert sorted(r.text for r in got) == ["own"] * 2 + ["same\npage"] * 8


# --- quality


def test_estimate_trusts_the_rules_that_agree(spark):
    rng, rows = random.Random(1), []
    for _ in range(4000):
        good = rng.random() < 0.7
        vote = lambda p: (1 if good else -1) if rng.random() < p else (-1 if good else 1)
        rows.append((vote(0.95), vote(0.9), vote(0.9), vote(0.5), 1 if good else 0))
    df = spark.createDataFrame(rows, "a int, b int, c int, d int, y int")
    names = ["a", "b", "c", "d"]
    good = quality.estimate(df.groupBy(names).agg(F.count("*").alias("n")), names)
    hit = df.agg(F.avg(((good >= 0.5).cast("int") == F.col("y")).cast("int"))).first()[0]
    assert hit > 0.96
    assert quality.estimate(df.where("false").groupBy(names).agg(F.count("*").alias("n")), names) is None


# --- toxicity


def test_ordinal_grades_share_weights():
    rng = np.random.default_rng(0)
    x = rng.integers(0, 6, 3000)
    grades = np.digitize(x + rng.normal(0, 0.5, 3000), [1.5, 3.5])
    w, t = toxicity.fit_ordinal(np.arange(3000), np.zeros(3000, int), x.astype(float), grades, 1, steps=1500)
    assert t[0] < t[1] and abs(t[0] / w[0] - 1.5) < 0.2 and abs(t[1] / w[0] - 3.5) < 0.2
    severity, grade = toxicity.Ordinal(np.zeros(1, np.uint64), w, t).severity(np.array([0.0, 2.5 * w[0], 5 * w[0]]))
    assert list(grade) == [0, 1, 2] and severity[0] < 0.3 < 0.8 < severity[1] < 1.2 < severity[2]


def test_toxic_rows_go_and_columns_stay(spark):
    bad = [f"{prose(40, i)} vile{i % 3} filth" for i in range(40)]
    df = frame(spark, bad + [prose(40, 100 + i) for i in range(200)])
    labels = df.select("doc_id", (F.col("doc_id") < 40).cast("int").alias("toxic")).where("doc_id % 2 = 0")
    kept = toxicity.keep_clean(df, toxicity.fit(df, labels.union(labels).union(spark.createDataFrame([(None, 1), (3, None)], "doc_id long, toxic int"))))
    assert kept.columns == df.columns and sorted(r.doc_id for r in kept.collect()) == list(range(40, 240))


# --- shards


def test_a_heavy_text_is_cut_and_others_stay_together(spark):
    df = frame(spark, ["hot text here"] * 3000 + [f"{prose(5, i % 900)}" for i in range(3000)])
    rows = sharding.shard(df, 10).collect()
    size = {s: sum(r.size for r in rows if r.shard == s) for s in range(10)}
    assert max(size.values()) - min(size.values()) < 0.05 * sum(size.values()) / 10
    text = {r.doc_id: r.text for r in df.collect()}
    homes = {}
    for r in rows:
        homes.setdefault(text[r.doc_id], set()).add(r.shard)
    assert len(homes.pop("hot text here")) >= 4 and all(len(x) == 1 for x in homes.values())


def test_overfull_ranges_are_subdivided(spark, monkeypatch):
    monkeypatch.setattr(sharding, "SAMPLES", 1)  # a sample too thin to divide evenly
    df = frame(spark, [prose(20, i) for i in range(2000)])
    rows = sharding.shard(df, 5).collect()
    size = [sum(r.size for r in rows if r.shard == s) for s in range(5)]
    assert max(size) - min(size) < 400


def test_written_shards_hold_all_rows_in_order(spark, tmp_path):
    df = frame(spark, [prose(20, i) for i in range(200)])
    put = {r.doc_id: r for r in sharding.write_shards(df, str(tmp_path / "out"), 4).collect()}
    back = spark.read.parquet(str(tmp_path / "out"))
    assert {(r.doc_id, r.text, r.shard, r.slot) for r in back.collect()} == {(r.doc_id, r.text, put[r.doc_id].shard, put[r.doc_id].slot) for r in df.collect()}


# --- archives


def test_equal_payloads_are_revisited(spark):
    rows = [(1, "a"), (9, "a"), (5, "a"), (3, None), (4, ""), (7, "b"), (None, "b"), (None, "c")]
    df = spark.createDataFrame([(i, "http://x/ y\n", t) for i, t in rows], "page_id long, url string, html string")
    got = warc.read_archives(warc.write_archives(df, warc.fresh_folder(df)), payload=True).collect()
    assert sorted((str(r.page_id), r.record_type, r.refers_to) for r in got) == sorted([
        ("1", "revisit", 9), ("9", "response", None), ("5", "revisit", 9), ("3", "revisit", 4), ("4", "response", None),
        ("7", "response", None), ("None", "revisit", 7), ("None", "response", None)])
    assert {r.payload_bytes for r in got if r.page_id in (1, 9)} == {1}
    assert {bytes(r.payload) for r in got if r.page_id == 9} == {b"a"}
    least = warc.read_archives(warc.write_archives(df, warc.fresh_folder(df), least=2)).collect()
    assert {r.record_type for r in least} == {"response"}


@pytest.mark.parametrize("limit", [None, 10])
def test_zip64_directories_are_read(monkeypatch, limit):
    if limit:
        monkeypatch.setattr(zipfile, "ZIP64_LIMIT", limit)
        monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", 1)
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w") as z:
        for name in ("archive/a", "indexes/b"):
            with z.open(name, "w", force_zip64=bool(limit)) as f:
                f.write(name.encode() * 5)
        z.comment = b"PK\x05\x06 a comment that looks like an end record"
    assert (b"PK\x06\x06" in data.getvalue()) == bool(limit)
    for name, (place, size, method) in warc.directory(data).items():
        assert method == 0 and data.getvalue()[place:place + size] == name.encode() * 5
    with pytest.raises(ValueError):
        warc.directory(io.BytesIO(b"no archive"))


def test_a_payload_that_differs_from_its_digest_is_refused():
    data = warc.record(1, "u", b"hello")
    assert warc.parse(data)["payload"] == b"hello"
    with pytest.raises(ValueError):
        warc.parse(data.replace(b"hello", b"jello"))


# --- near duplicates


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(100, 300)] + [(5, 900 + i) for i in range(50)] + [(7, 7), (-4, 2)]
    got = {r.node: r.component for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert {got[i] for i in range(100, 301)} == {100} and {got[900 + i] for i in range(50)} == {5} and got[2] == -4 and 7 not in got


def brute(texts, length, percent):
    sets = [{tuple(w[k:k + length]) for k in range(max(1, len(w) - length + 1))} if (w := (t or "").lower().split()) else set() for t in texts]
    up = list(range(len(texts)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for a in range(len(sets)):
        for b in range(a):
            if sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                up[max(x, y)] = min(x, y)
    return [root(i) for i in range(len(texts))]


@pytest.mark.parametrize("block", [3000, 8])
def test_a_large_group_of_near_copies(spark, monkeypatch, block):
    monkeypatch.setattr(minhash, "BLOCK", block)
    rng, base, texts = random.Random(4), prose(120, 7).split(), []
    for _ in range(60):  # most are like the original, few like each other
        w = list(base)
        for _ in range(rng.randrange(1, 9)):
            w[rng.randrange(len(w))] = f"new{rng.randrange(10**6)}"
        texts.append(" ".join(w))
    texts += [prose(100, 50 + i) for i in range(20)] + [texts[3], texts[3].upper(), None, "", "a b"]
    want = brute(texts, 3, 85)
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(frame(spark, texts), length=3, percent=85).collect()}
    assert got == dict(enumerate(want))


def test_rows_of_a_split_bucket_grow_with_its_members(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 500)
    few = lambda m: spark.range(m).select(
        F.lit(1).alias("key"), "id", F.lit(100).cast("long").alias("n"), F.lit(0).cast("long").alias("head"), F.when(F.col("id") % 1000 == 7, F.col("id")).otherwise(0).alias("comp"))
    for m in (10_000, 20_000):
        assert minhash.dealt(few(m)).count() <= m + (m // 1000) * (m // 500 + 2)
    got = minhash.dealt(few(5000)).select("id", "comp", "side", F.struct("i", "j").alias("cell")).collect()
    cells = {}
    for r in got:
        cells.setdefault(r.cell, []).append(r)
    met = {(a.id, b.id) for c, x in cells.items() for a in x if a.comp for b in x if a.id != b.id and (c.i == c.j or a.side != b.side)}
    assert met == {(a, b) for a in range(7, 5000, 1000) for b in range(5000) if a != b}  # each outsider with all
    assert minhash.dealt(few(400)).groupBy("i", "j").count().collect() == [(0, 0, 400)]
    assert minhash.dealt(few(5)).count() == 0  # one component


def test_a_block_without_the_head_compares_its_smallest_member():
    sets = [np.arange(100, dtype=np.uint64) + np.uint64(k) for k in (0, 1, 5000)]
    sketches = [minhash.signature(np.sort(x << np.uint64(44)), 64).astype(np.uint8) for x in sets]
    bands = np.array([[9, 1], [9, 2], [9, 3]])
    found = lambda *head: minhash.link_members(9, (20, 30, 40), np.array([20, 30, 40]), np.zeros(3), sets, bands, sketches, 85, *head)
    assert found() == [(20, 30)]
    assert found(7) == [(20, 30)]
    assert found(20) == []  # the head's pairs were all looked at before


def test_bands_miss_next_to_nothing():
    for percent in (80, 85, 90):
        rows, bands = minhash.bands_for(percent)
        assert (1 - (percent / 100) ** rows) ** bands <= minhash.MISS


def test_circulant_signatures_estimate_similarity():
    rng = np.random.default_rng(1)
    shared, a, b = (rng.integers(0, 2**64, n, dtype=np.uint64) for n in (800, 100, 100))
    x, y = (minhash.signature(np.concatenate([shared, z]), 512) for z in (a, b))
    assert abs((x == y).mean() - 0.8) < 0.08


# --- repeated passages


def brute_removed(rows, length):
    seen, out = {}, []
    for i, text in sorted(rows):
        w = (text or "").split()
        gone = set()
        for k in range(len(w) - length + 1):
            if seen.setdefault(tuple(w[k:k + length]), (i, k)) != (i, k):
                gone.update(range(k, k + length))
        out.append((i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return out


def test_repeated_passages_by_brute_force(spark):
    passage, texts = prose(25, 99), []
    for i in range(60):
        texts.append(f"{prose(30, i)} {passage if i % 3 == 0 else ''} {prose(10, i % 7)}\n{prose(22, 500 + i % 5)}")
    texts += [texts[4], texts[4], "loop " * 50, "loop " * 30, prose(19, 3), prose(19, 3), None, ""]
    got = substrings.remove_repeats(frame(spark, texts)).collect()
    assert sorted((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in got) == brute_removed(list(enumerate(texts)), 20)


def test_a_full_sketch_changes_nothing(spark, monkeypatch):
    monkeypatch.setattr(substrings, "LEAST_BITS", 6)
    monkeypatch.setattr(substrings, "MOST_BITS", 6)
    texts = [f"{prose(40, i % 9)} {prose(15, i)}" for i in range(40)]
    got = substrings.remove_repeats(frame(spark, texts)).collect()
    assert sorted((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in got) == brute_removed(list(enumerate(texts)), 20)


def test_packed_cells_come_back():
    for cells in ([], [0], [254], [255], [510, 511, 100000], list(range(0, 5000, 7))):
        assert list(substrings._unpack(substrings._pack(np.array(cells, np.int64)))) == cells


# --- packing


def test_words_have_the_ids_of_whole_texts():
    from tokenizers import Tokenizer

    path, _ = vocabulary()
    tok, words = Tokenizer.from_file(path), packing.Words(path)
    text = "Don't stop, l'été 123 4.5 ÀÉ éa ß x 日本語 😀! <|endoftext|>a ΣΑΣ, İstanbul ﬁ a_b #$%& it's I'LL " + prose(50, 3)
    want = tok.encode(text, add_special_tokens=False).ids
    for _ in range(2):  # new and known words
        ids, cuts = words.encode(pa.array([text, None, "", "Don't"]))
        assert ids[:cuts[1]].tolist() == want and cuts[1] == cuts[2] == cuts[3]
        assert ids[cuts[3]:].tolist() == tok.encode("Don't", add_special_tokens=False).ids
    words.used = packing.KNOWN_IDS + 1  # full: it starts anew
    assert words.encode(pa.array([text]))[0].tolist() == want


def test_displaced_words_are_read_again(monkeypatch):
    from tokenizers import Tokenizer

    monkeypatch.setattr(packing, "KNOWN", 4)
    path, _ = vocabulary()
    tok, words = Tokenizer.from_file(path), packing.Words(path)
    for seed in range(3):
        text = prose(60, seed)
        assert words.encode(pa.array([text]))[0].tolist() == tok.encode(text, add_special_tokens=False).ids


def test_combinations_fill_the_window_and_least_squares_finds_a_mix():
    sets = packing.combinations(6)
    assert sorted(sets) == sorted([(6,), (5, 1), (4, 2), (3, 3), (4, 1, 1), (3, 2, 1), (2, 2, 2)])
    a = np.array([[1, 2, 0], [0, 1, 1.0]])
    x = packing.nnls(a, a @ np.array([3.0, 0.0, 2.0]))
    assert (x >= 0).all() and np.allclose(a @ x, [3, 2])
    histogram = np.zeros(257, np.int64)
    histogram[[100, 156, 64, 128]] = 50, 50, 80, 40
    places, taken, n = packing.plan(histogram)
    assert (taken <= histogram).all() and n >= 85


def test_checksum_of_a_tail():
    import zlib

    data = bytes(range(256)) * 9
    for cut in (0, 1, 256, 1000, len(data) - 1):
        assert packing.tail_crc(zlib.crc32(data[:cut]), zlib.crc32(data), len(data) - cut) == zlib.crc32(data[cut:])


def test_lengths_that_no_plan_fits_are_cut(spark):
    df = frame(spark, [prose(1500, i) for i in range(12)])  # all of one length beyond half a window
    rows = packing.pack(df, *vocabulary()).collect()
    n = len({r.sequence_id for r in rows})
    assert sum(r.length for r in rows) > 0.9 * 4096 * (n - 1)


def test_rows_without_an_id_are_spread(spark, monkeypatch):
    monkeypatch.setattr(packing, "RANKED", 20)
    monkeypatch.setattr(packing, "GREEDY", 20 * 1501)
    df = frame(spark, [(None, prose(1000, 1))] * 300 + [(7, prose(1000, 2))] * 300 + [(i, prose(1000, i)) for i in range(100, 400)])
    cut = packing.settle(packing.pieces(df, *vocabulary()).withColumn("row", F.monotonically_increasing_id()), "pieces").cache()
    most = max(r["count"] for r in packing._salted(cut, 900).groupBy("bin", "salt", "part").count().collect())
    assert most <= packing.OVERFULL * 20
    left, groups = packing._grouped(cut, 900 * 1501)
    got = left.groupBy("group").agg(F.count("*").alias("n"), F.sum("length").alias("t")).collect()
    assert sum(r.n for r in got) == cut.count() and max(r.t for r in got) <= packing.OVERFULL * packing.GREEDY
    assert all(0 <= r.group < groups for r in got)
    rows = packing.pack(df, *vocabulary()).collect()
    size = {}
    for r in rows:
        size.setdefault(r.sequence_id, []).append((r.offset, r.offset + r.length))
    assert all(b <= c for x in size.values() for (_, b), (c, _) in zip(sorted(x), sorted(x)[1:]))
    assert sum(r.length for r in rows) == cut.agg(F.sum("length")).first()[0]


# --- benchmark passages


def test_passages_and_their_places(spark, monkeypatch):
    item = "The quick brown-fox jumps over 12 lazy dogs and then sleeps"
    bench = spark.createDataFrame([(1, item), (2, "Short ÉTÉ item"), (3, None), (None, item), (4, "..."), (10, item)], "item_id long, text string")
    text = "é! 'THE quick, brown fox; jumps over 12 lazy dogs and THEN' sleeps. short ÉTÉ item? short étÉ item"
    df = frame(spark, [text, None, "quick brown fox jumps over 12 lazy dogs", "", text])
    for chars in (1 << 20, 20):
        monkeypatch.setattr(decontaminate, "BLOCK_CHARS", chars)
        rows = {r.doc_id: r for r in decontaminate.contamination(df, bench).collect()}
        r = rows[0]
        assert (r.n_words, r.n_hit, r.n_items, r.contaminated) == (19, 12 + 3, 3, True)
        parts = [text[int(a):int(b)] for a, b in (x.split(":") for x in r.spans.split(","))]
        assert " ".join(parts) == "THE quick, brown fox; jumps over 12 lazy dogs and THEN' sleeps. short ÉTÉ item"
        assert [rows[k].n_hit for k in (1, 2, 3, 4)] == [0, 0, 0, 15]
        assert sorted(x.doc_id for x in decontaminate.keep_unseen(df, bench).collect()) == [1, 2, 3]
    none = decontaminate.contamination(df, bench.where("false")).collect()
    assert len(none) == 5 and not any(x.contaminated for x in none)


def test_a_benchmark_of_many_blocks_is_one_step_and_not_collected(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK_CHARS", 400)
    monkeypatch.setattr(decontaminate, "CHUNK_BYTES", 1)
    items = [prose(12, 900 + i) for i in range(40)]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    texts = [f"{prose(8, i)} {items[i % 40]} {items[(i + 7) % 40]} end" for i in range(50)] + [prose(30, 5), None]
    df, rows = frame(spark, texts), {}
    assert len(decontaminate._blocks(bench, "item_id", "text")) > 5
    for name, chunk in (("small", 1), ("large", 1 << 26)):
        monkeypatch.setattr(decontaminate, "CHUNK_BYTES", chunk)
        found = decontaminate.contamination(df, bench)
        assert found._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 1
        rows[name] = sorted(map(str, found.collect()))
        got = {r.doc_id: (r.n_items, r.n_hit) for r in found.collect()}
        assert got == {i: (2, 24) if i < 50 else (0, 0) for i in range(52)}
        assert sorted(r.doc_id for r in decontaminate.keep_unseen(df, bench).collect()) == [50, 51]
    assert rows["small"] == rows["large"]


# --- personal data


def test_base_spans_equal_the_plain_patterns():
    email, ip = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
    rng = random.Random(5)
    for _ in range(3000):
        text = "".join(rng.choice("a@.b1-+2 @.(5") for _ in range(rng.randrange(40)))
        got = pii.base_spans(text)
        assert got["email"] == [m.span() for m in email.finditer(text)]
        assert got["ip"] == [m.span() for m in ip.finditer(text) if all(int(x) <= 255 for x in m[0].split("."))]
    assert pii.base_spans("4111 1111 1111 1111, +1 (555) 010-9999 1.2.3.256")["card"] == [(0, 19)]
    pii.base_spans("1" * 200000 + "@" * 1000 + "a" * 200000)  # no retries


def test_gradients_of_the_tagger():
    rng = np.random.default_rng(0)
    model = tagger.Tagger.new(3, 1)
    model.weights = {k: v.astype(np.float64) for k, v in model.weights.items()}
    x, y = rng.integers(0, 20, (4, 7)), rng.integers(0, 3, (4, 7))
    _, g = model.gradients(x, y)
    for name in model.weights:
        w = model.weights[name]
        at = np.unravel_index(np.abs(g[name]).argmax(), w.shape)
        keep, losses = w[at], []
        for d in (1e-5, -1e-5):
            w[at] = keep + d
            losses.append(model.gradients(x, y)[0])
        w[at] = keep
        assert abs((losses[0] - losses[1]) / 2e-5 - g[name][at]) < 1e-4, name


def test_the_tagger_adds_what_patterns_miss(spark):
    rng, texts = random.Random(2), []
    for i in range(400):
        value = rng.choice([f"u{i}@mail{i % 7}.example.com", f"10.{i % 200}.3.{i % 90}", f"+1 ({rng.randrange(200, 999)}) 555-{rng.randrange(1000, 9999)}"])
        texts.append(f"{prose(8, i)} {value} {prose(8, i + 1000)}")
    model = pii.fit(frame(spark, texts))
    rows = {r.doc_id: r for r in pii.find(frame(spark, [f"{prose(9, 1)} call 212-555-1234 {prose(9, 2)}", prose(40, 3), texts[0], None]), model).collect()}
    assert rows[0].n_phone == 0 and rows[0].n_added >= 1 and rows[0].spans.startswith("phone:")
    assert rows[1].spans == "" and rows[2].spans and rows[3].n_email == 0


def test_windows_of_one_span_are_reconciled():
    text = "x" * 40 + " 212-555-1234 " + "y" * 60
    found = [(41, 48, 3, 0.99, True), (41, 53, 3, 0.97, False), (45, 53, 3, 0.99, True), (41, 53, 1, 0.96, False)]
    assert pii.reconcile(found, [], text) == [(41, 53, 3)]
    assert pii.reconcile(found, [(50, 60)], text) == []


# --- names and tasks


def test_columns_that_clash_with_inner_names(spark, tmp_path):
    df = frame(spark, ["a b c d e f", "a b c d e f", "other words here"]).withColumns({c: F.lit(9) for c in ("_gone", "_id", "shard", "slot", "Shard_")})
    assert sorted(r.doc_id for r in minhash.keep_one(df).collect()) == [0, 2]
    assert minhash.keep_one(df).columns == df.columns
    put = sharding.write_shards(df, str(tmp_path / "s"), 2)
    back = spark.read.parquet(str(tmp_path / "s"))
    assert set(df.columns) <= set(back.columns) and {(r.shard, r.slot, r._id) for r in back.collect()} == {(9, 9, 9)}
    assert {(r.doc_id, r.shard) for r in put.collect()} == {(r.doc_id, r["shard__"]) for r in back.collect()}


def test_archives_are_read_by_many_tasks(spark, tmp_path):
    df = spark.range(400).select(F.col("id").alias("page_id"), F.lit("u").alias("url"), F.concat(F.lit("html "), "id").alias("html")).repartition(40)
    out = warc.read_archives(warc.write_archives(df, warc.fresh_folder(df)))
    busy = out.groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true" and out.rdd.getNumPartitions() == 4
    assert len(busy) >= 3 and sum(r["count"] for r in busy) == 400


def test_windows_of_one_first_hash_are_told_apart(spark, monkeypatch):
    texts = [" ".join(f"d{d}w{i}" for i in range(20)) for d in range(4)] + [" ".join(f"d1w{i}" for i in range(20)) + " more"]
    df = frame(spark, texts)
    h, at, _ = substrings._windows(pa.array(texts), 20)
    g = substrings._second(pa.array(texts), 20, at)
    assert len(set(g.tolist())) == len(set(h.tolist())) == 5 and not set(g.tolist()) & set(h.tolist())
    found = spark.createDataFrame([(1, 10, 0), (1, 11, 1), (1, 10, 2), (2, 10, 3)], "h long, g long, id long")
    monkeypatch.setattr(substrings, "_candidates", lambda *a: found)
    monkeypatch.setattr(substrings, "_remove", lambda length: lambda batches: (pa.RecordBatch.from_pydict({
        "doc_id": b["id"], "n_words": pa.array([len(x or []) for x in b["later"].to_pylist()], pa.int64()),
        "n_removed": pa.array([0] * b.num_rows, pa.int64()), "kept_text": pa.array([""] * b.num_rows)}) for b in batches))
    marked = {r.doc_id: r.n_words for r in substrings.remove_repeats(df).collect()}
    assert marked == {0: 0, 1: 0, 2: 1, 3: 0, 4: 0}


def test_light_texts_are_whole_where_ranges_are_thin(spark, monkeypatch):
    monkeypatch.setattr(sharding, "RANGES_PER_SHARD", 300)
    monkeypatch.setattr(sharding, "GROUP_SHARE", 0.4)
    texts = [f"group {g} " + "x" * (g % 7) for g in range(25)] * 40 + [f"own {i}" for i in range(200)]
    for shards in (2, 5):
        rows = sharding.shard(frame(spark, texts), shards).collect()
        of = {}
        for r in rows:
            of.setdefault(texts[r.doc_id], set()).add(r.shard)
        assert all(len(x) == 1 for x in of.values()) and {r.shard for r in rows} == set(range(shards))
    calls = []
    real = sharding._sample
    monkeypatch.setattr(sharding, "_sample", lambda rows, rate, salt: calls.append(rate) or real(rows, rate, salt))
    monkeypatch.setattr(sharding, "MOST_RANGES", 4)
    sharding.shard(frame(spark, texts), 2).collect()
    assert calls and all(math.isfinite(c) for c in calls)


def test_severity_is_fitted_alike_however_rows_lie(spark):
    rng = random.Random(3)
    texts = [prose(30, i) + (" vile awful" if i % 3 == 0 else "") for i in range(90)]
    texts += [t.replace("w1 ", "w2 ") for t in texts[:40]] + texts[:20]
    docs = frame(spark, texts)
    labels = spark.createDataFrame([(i, int("vile" in t and rng.random() < 0.9)) for i, t in enumerate(texts)], "doc_id long, toxic int")
    fits = [toxicity.fit(docs.repartition(n, "doc_id"), labels.repartition(m)) for n, m in ((1, 1), (7, 3), (4, 8))]
    for other in fits[1:]:
        assert all((np.asarray(getattr(fits[0], f)) == np.asarray(getattr(other, f))).all() for f in fits[0].__dataclass_fields__)
    assert len(fits[0].features) and len(fits[0].thresholds)
