"""Every relation and registered query against its SQL twin, on the smallest scale."""

from __future__ import annotations

import pytest

from checks.compare import TESTDATA, compare, connect
from checks.queries import ORACLES, QUERIES
from checks.relations import SPARK_SQL, Relations, duck_query

SF_DIR = f"{TESTDATA}/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", list(SPARK_SQL))
def test_relation(spark, con, name):
    def build(session, sf_dir):
        return Relations(session, sf_dir)(name)

    good, text = compare(spark, con, name, build, duck_query(f"SELECT * FROM {name}", name), SF_DIR)
    assert good, text


def test_every_query_has_a_twin():
    assert set(ORACLES) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_twin(spark, con, name):
    frames = []

    def build(session, sf_dir):
        frames.append(QUERIES[name](session, sf_dir))
        return frames[0]

    good, text = compare(spark, con, name, build, ORACLES[name], SF_DIR)
    assert good, text
    # No plan pairs everything with everything.
    plan = frames[0]._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
