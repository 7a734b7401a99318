"""The text queries with SQL agree with it on the smallest tables, and the others run."""

import pytest

from sheafwork.llm.queries import LLM
from tests.test_oracle import SF, agrees, duck  # noqa: F401


@pytest.mark.parametrize("name", sorted(LLM.oracles))
def test_query(spark, duck, name):  # noqa: F811
    agrees(spark, duck, name)


@pytest.mark.parametrize("name", sorted(set(LLM.queries) - set(LLM.oracles)))
def test_runs(spark, name):
    assert LLM.queries[name](spark, SF).count() >= 0


@pytest.mark.parametrize("name, columns", [("p1_found", ["filename", "item_name"]), ("p3_found", ["filename", "field_name"]), ("p4_found", ["filename_a", "filename_b"]), ("p6_found", ["filename", "item_name"]), ("p7_found", ["filename", "item_name", "line_no"]), ("p8_found", ["doc_id"]), ("p10_found", ["doc_id"])])
def test_found_columns(spark, name, columns):
    df = LLM.queries[name](spark, SF)
    assert df.columns == columns and df.count() == df.distinct().count()
