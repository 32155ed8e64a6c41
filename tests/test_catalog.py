"""Every catalogue query against its SQL on the smallest tables."""

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tools")]

import __spark_entry__  # noqa: E402
import check_oracles  # noqa: E402
from careflow import catalog  # noqa: E402

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not there")


@pytest.fixture(scope="module")
def con():
    return check_oracles.connect(SF)


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0


def test_every_query_has_sql():
    assert set(catalog.QUERIES) == set(catalog.ORACLES)
    assert set(catalog.QUERIES) <= set(__spark_entry__.queries())
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, con, name):
    assert check_oracles.compare(spark, con, SF, name) is None


@pytest.mark.parametrize("name", [
    n for n in sorted(catalog.QUERIES) if n.startswith("keyword_semijoin") and "beginning" not in n])
def test_every_passage_is_searched_as_a_whole(spark, tmp_path, name):
    passages = ["shared beginning of one", "shared beginning of two", "another passage"]
    texts = [f"so {p} it is" for p in passages] + ["shared beginning of none", "another pass", None]
    for table, rows, schema in (
            ("documents", [(i, t, "en") for i, t in enumerate(texts)], "doc_id long, text string, lang string"),
            ("benchmark", list(enumerate(passages)), "item_id long, text string")):
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{table}.parquet")
    assert sorted(r.doc_id for r in catalog.QUERIES[name](spark, str(tmp_path)).collect()) == [0, 1, 2]
