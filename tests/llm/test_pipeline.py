"""The pipeline stage by stage, each against brute force on what its predecessor kept."""

import os
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline as pipeline
from pulse.llm.linededup import LEAST_PAGES, RATIO

FOLDER = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    """What every stage returned, written and read again."""
    docs, made = spark.read.parquet(f"{FOLDER}/documents.parquet"), []
    made.append(docs)
    for name, stage in pipeline.STAGES:
        path = str(tmp_path_factory.mktemp(name) / "out")
        stage(spark, made[-1], FOLDER).write.parquet(path)
        made.append(spark.read.parquet(path))
    return made


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def words(text):
    return [w for w in re.split("[\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]


def test_stages_are_named_and_registered():
    assert [n for n, _ in pipeline.STAGES] == ["toxicity", "line_dedup", "near_dedup", "decontamination", "packing"]
    assert "pipeline" in entry.queries()


def test_all_but_the_last_keep_the_columns(steps):
    for made in steps[1:5]:
        assert made.dtypes == steps[0].dtypes


def test_toxic_documents_go_and_clean_ones_stay(spark, steps):
    toxic = {r.doc_id for r in spark.read.parquet(f"{FOLDER}/labels.parquet").where("toxic = 1").collect()}
    before, after = texts(steps[0]), texts(steps[1])
    labelled = {r.doc_id for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    assert all(after[i] == before[i] for i in after)
    assert not (labelled - toxic) & (set(before) - set(after))


def test_lines_go_by_share_of_the_source(steps):
    rows, after = steps[1].collect(), {r.doc_id: r for r in steps[2].collect()}
    pages, seen = {}, {}
    for r in rows:
        pages[r.source] = pages.get(r.source, 0) + 1
        for line in {x.strip(" ") for x in r.text.split("\n")} - {""}:
            seen[r.source, line] = seen.get((r.source, line), 0) + 1
    for r in rows:
        goes = lambda x: seen.get((r.source, x.strip(" ")), 0) >= LEAST_PAGES and seen[r.source, x.strip(" ")] > RATIO * pages[r.source]
        kept = [x for x in r.text.split("\n") if not goes(x)]
        want = "\n".join(kept) if any(x.strip(" ") for x in kept) else r.text
        assert after[r.doc_id].text == want and after[r.doc_id].n_chars == (len(want) if want != r.text else r.n_chars)


def test_one_document_of_each_group_stays(steps):
    before, after = texts(steps[2]), texts(steps[3])
    sets = {i: {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if (w := words(t)) else set() for i, t in before.items()}
    up = {i: i for i in before}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                up[max(x, y)] = min(x, y)
    assert set(after) == {i for i in before if root(i) == i}


def test_documents_with_passages_go(spark, steps):
    split = lambda t: re.findall("[0-9a-z\x80-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    windows = set()
    for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect():
        w = split(r.text)
        windows |= {tuple(w[k:k + 10]) for k in range(max(1, len(w) - 9))} if w else set()
    sizes = {len(x) for x in windows}
    before = texts(steps[3])
    hit = {i for i, t in before.items() for w in [split(t)] if any(tuple(w[k:k + n]) in windows for n in sizes for k in range(len(w) - n + 1))}
    assert set(texts(steps[4])) == set(before) - hit


def test_all_that_is_left_is_packed(steps):
    rows, left = steps[5].collect(), texts(steps[4])
    assert {r.doc_id for r in rows} == set(left)
    total = {}
    for r in rows:
        total[r.doc_id] = total.get(r.doc_id, 0) + r.length
        assert r.offset + r.length <= 4096
    assert all(total[r.doc_id] == r.doc_tokens for r in rows)


def test_awkward_documents_pass_through(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(0)
    rows = [(None, None, None, None, None), (1, "", None, "s", 0), (2, "a b c\n" * 3000, "en", "s", None), (2, "a b c\n" * 3000, "en", "s", None), (3, " ", "en", None, 1)]
    df = spark.createDataFrame(rows, docs.schema).withColumns({"kept": F.lit(True), "id": F.lit("x"), "component": F.lit(1)})
    for given in (df, df.where("false")):
        out = given
        for k, (_, stage) in enumerate(pipeline.STAGES):
            path = str(tmp_path / f"{k}-{given is df}")
            stage(spark, out, FOLDER).write.parquet(path)
            out = spark.read.parquet(path)
            assert k == 4 or out.columns == df.columns
        assert {r.doc_id for r in out.collect()} == ({None, 1, 2, 3} if given is df else set())
