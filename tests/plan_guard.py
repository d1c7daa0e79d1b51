"""Plans of queries, those before a checkpoint included."""

import re

from shelfwise import session

PAIRING = ("CartesianProduct", "BroadcastNestedLoopJoin")
#: A literal list of so many entries that is exploded is a join with driver rows.
LONG_LIST = 100


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def plans(build, spark, folder) -> list[str]:
    """The plan of a query's result and of every frame it cuts on the way."""
    seen = []
    session.BEFORE_CUT.append(lambda df: seen.append(plan_of(df)))
    try:
        return [plan_of(build(spark, folder)), *seen]
    finally:
        session.BEFORE_CUT.pop()


def offences(plan: str) -> list[str]:
    found = [name for name in PAIRING if name in plan]
    found += ["exploded literals" for x in re.findall(r"Generate explode\(\[([^\]]*)\]", plan) if x.count(",") >= LONG_LIST]
    return found
