"""The subpackage's queries next to their SQL, where they have some."""

import pytest

from compare import connect, difference
from millrace import llm

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(llm.ORACLE))
def test_query_agrees_with_sql(spark, name):
    assert difference(spark, connect(FOLDER), FOLDER, name) is None


def test_every_operator_has_one_query():
    numbers = sorted(int(name[2:].split("_")[0]) for name in llm.QUERIES)
    assert numbers == list(range(1, 14))
