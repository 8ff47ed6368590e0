"""Every registered query against its SQL, on the smallest tables."""

import pytest

from tools.check_oracle import compare, connect
from workload.queries import ORACLES, QUERIES


@pytest.fixture(scope="module")
def duck(folder):
    return connect(folder)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(name, spark, folder, duck):
    rows = [r.asDict() for r in QUERIES[name](spark, folder).collect()]
    if name in ORACLES:
        result = duck.execute(ORACLES[name])
        names = [d[0] for d in result.description]
        assert compare(rows, result.fetchall(), names) is None
    else:
        assert rows


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
