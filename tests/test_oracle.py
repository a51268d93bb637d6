"""Every registered query against its SQL, on the smallest driver tables."""

import pathlib
import sys

import pytest

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1] / "tools"))

import __spark_entry__ as entry  # noqa: E402
import compare  # noqa: E402

from ledgerline.workload import oracle  # noqa: E402
from ledgerline.workload.queries import QUERIES  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not pathlib.Path(SF_DIR).is_dir(), reason="driver tables are not here")


@pytest.fixture(scope="module")
def duck():
    return compare.duck(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(oracle.oracle_sql())
    assert set(QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    assert compare.difference(spark, duck, SF_DIR, name, entry.oracle_sql()[name]) is None


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_stays_in_the_engine(spark, name):
    plan = entry.queries()[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    for word in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "NestedLoop", "SinglePartition, REPARTITION"):
        assert word not in plan
