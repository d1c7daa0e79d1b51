"""Plan guard: no registered query pairs all rows, neither in its result's plan nor
in one that a checkpoint cuts off."""

import pytest
from pyspark.sql import functions as F

from conftest import SF
from plan_guard import offences, plan_of, plans
from shelfwise.plans import REGISTRY


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_no_cross_joins(spark, name):
    assert [o for plan in plans(REGISTRY[name].build, spark, SF) for o in offences(plan)] == []


def test_the_guard_sees_what_it_should(spark):
    some = spark.range(5)
    assert offences(plan_of(some.crossJoin(some.toDF("x")))) != []
    listed = some.select(F.explode(F.array(*[F.lit(i) for i in range(200)])))
    assert offences(plan_of(listed)) == ["exploded literals"]
