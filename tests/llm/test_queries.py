import re

import pytest

import __spark_entry__ as entry
from reconlake.llm.queries import ORACLES, QUERIES


def test_each_operator_has_one_query():
    assert sorted(int(re.match(r"op(\d+)_\w+$", q)[1]) for q in QUERIES) == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())
    assert set(ORACLES) <= set(entry.oracle_sql()) and "pipeline" not in entry.oracle_sql()


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_key_matches_oracle(spark, key):
    from tools.check_oracles import check
    res = check(spark, "/root/testdata/sf0.001", [key], verbose=False)[key]
    assert res.get("ok"), res
