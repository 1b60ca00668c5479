"""Every query with SQL gives the same rows as its SQL in DuckDB."""

import pytest

from lagline.queries import load_all
from tests.compare import connect, difference

REGISTRY = load_all()
WITH_SQL = [n for n, q in REGISTRY.items() if q.sql]


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("name", WITH_SQL)
def test_same_rows_as_sql(spark, con, sf, name):
    assert difference(spark, con, name, REGISTRY[name], sf) is None


def test_every_surveyed_group_is_registered():
    wanted = (
        [f"s{i}" for i in range(1, 12)] + [f"p{i}" for i in range(1, 14)] + ["d1", "d2"]
        + [f"c{i}" for i in range(1, 13)] + [f"a{i}" for i in range(1, 21)] + [f"f{i}" for i in range(1, 11)]
        + [f"l{i}" for i in range(1, 11)] + [f"m{i}" for i in range(1, 18)] + [f"t{i}" for i in range(1, 7)]
    )
    have = {n.split("_")[0] for n in REGISTRY}
    assert [w for w in wanted if w not in have] == []
