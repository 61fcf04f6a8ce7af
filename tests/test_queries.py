"""Every registered query against its SQL, over whole tables."""

import os

import pytest

import __spark_entry__ as entry
import checking
from pulse.plans.queries import ORACLES, QUERIES

FOLDER = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return checking.connect(FOLDER)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows_as_sql(spark, con, name):
    df = entry.queries()[name](spark, FOLDER)
    assert checking.difference(df, con, ORACLES[name]) is None


def test_every_query_without_sql_is_known():
    assert set(QUERIES) - set(ORACLES) == {"epoch_report", "score_ml", "train_eval"}


def test_training_gives_a_full_report(spark):
    rows = entry.queries()["train_eval"](spark, FOLDER).collect()
    assert [r.label for r in rows] == [
        "neutral", "positive", "negative", "accuracy", "macro avg", "weighted avg", "overall"]


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["period_int", "period_date", "negative", "neutral", "positive", "total"]
    assert df.count() > 0
