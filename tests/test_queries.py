import pytest

import __spark_entry__ as entry
from hypsogrid.plans import all_oracles, all_queries
from oracle import same


@pytest.mark.parametrize("name", sorted(all_oracles()))
def test_against_sql(spark, sf_dir, name):
    same(all_queries()[name](spark, sf_dir), all_oracles()[name], sf_dir)


def test_entry(spark):
    assert entry.entry(spark).columns == ["event_id", "u", "v", "height"]
